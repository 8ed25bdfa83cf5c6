"""The preprocessing chains on invented rows of the data sets' schemas: 19
bank features, 39 coupon columns, the 50 bike features, the advertising
training set."""

import datetime as dt

from pyspark.sql import functions as F

from featurelab.operators import recipes as RC
from test_encoding import BIKE_COLUMNS

# Own bank rows: the data set's columns (a fixed schema), five invented clients
BANK_COLUMNS = ["age", "job", "marital", "education", "default", "housing", "loan", "contact", "month",
                "day_of_week", "duration", "campaign", "pdays", "previous", "poutcome", "emp.var.rate",
                "cons.price.idx", "cons.conf.idx", "euribor3m", "nr.employed", "y"]
BANK_ROWS = [
    (23, "student", "single", "high.school", "no", "no", "no", "cellular", "oct", "fri", 77, 2, 6, 1, "success",
     -1.8, 93.4, -41.0, 0.7, 5017, "yes"),
    (35, "services", "married", "professional.course", "unknown", "yes", "no", "telephone", "nov", "mon", 150, 1, 999, 0,
     "nonexistent", -0.1, 92.9, -36.4, 4.2, 5195, "no"),
    (44, "retired", "divorced", "basic.6y", "no", "no", "yes", "cellular", "mar", "wed", 412, 5, 31, 2, "failure",
     1.4, 94.5, -47.1, 4.9, 5228, "no"),
    (58, "blue-collar", "married", "illiterate", "no", "yes", "yes", "telephone", "sep", "tue", 95, 3, 30, 1, "success",
     -2.9, 92.2, -31.4, 0.8, 4991, "yes"),
    (71, "retired", "single", "basic.9y", "no", "no", "no", "cellular", "apr", "thu", 260, 1, 999, 0, "nonexistent",
     -1.7, 94.0, -39.8, 0.9, 4963, "yes"),
]
BANK = dict(zip(BANK_COLUMNS, map(list, zip(*BANK_ROWS))))


def frame(spark, cols: dict):
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame(cols))


def test_bank_recipe_shape_and_buckets(spark):
    df = frame(spark, BANK)
    assert len(df.columns) == 21
    out = RC.bank_features(df, scale=False)
    feats = [c for c in out.columns if c != "label"]
    assert len(feats) == 19 and "pdays" not in feats and "duration" not in feats
    rows = out.orderBy("age").collect()
    assert [r["pdays_bucketed"] for r in rows] == [1, 0, 2, 1, 0]
    assert [r["label"] for r in rows] == [1, 0, 0, 1, 1]
    assert [r["job"] for r in rows] == [3, 2, 1, 0, 1]  # sorted codes
    assert [r["month"] for r in rows] == [3, 2, 1, 4, 0]
    scaled = RC.bank_features(df).agg(F.avg("age").alias("m"), F.stddev_pop("age").alias("s")).first()
    assert abs(scaled.m) < 1e-9 and abs(scaled.s - 1) < 1e-9


# One invented coupon request (the data set's columns and code words)
COUPON_ROW = {
    "destination": "Work", "passanger": "Friend(s)", "weather": "Rainy", "temperature": 55, "time": "6PM",
    "coupon": "Carry out & Take away", "expiration": "2h", "gender": "Male", "age": "36", "maritalStatus": "Single",
    "has_children": 0, "education": "Associates degree", "occupation": "Sales & Related",
    "income": "$62500 - $74999", "Bar": "1~3", "CoffeeHouse": "gt8", "CarryAway": "less1",
    "RestaurantLessThan20": "never", "Restaurant20To50": "4~8", "toCoupon_GEQ15min": 0, "toCoupon_GEQ25min": 1,
    "direction_same": 1,
}
COUPON_39 = [f"col_{i}" for i in range(27)] + [
    "time", "expiration", "age", "education", "income", "Bar", "CoffeeHouse", "CarryAway",
    "Restaurant20To50", "toCoupon_GEQ15min", "toCoupon_GEQ25min", "direction_same"]


def test_coupon_recipe_39_columns(spark):
    df = frame(spark, {k: [v] for k, v in COUPON_ROW.items()})
    out = RC.coupon_features(df)
    assert out.columns == COUPON_39
    r = out.first()
    assert sum(r[f"col_{i}"] for i in range(27)) == 5
    assert (r["time"], r["expiration"], r["age"], r["education"], r["income"]) == (3, 0, 2, 3, 5)
    assert (r["Bar"], r["CoffeeHouse"], r["CarryAway"], r["Restaurant20To50"]) == (2, 4, 1, 3)


def test_coupon_recipe_training_frame_keeps_label_last(spark):
    row = dict(COUPON_ROW, car=None, toCoupon_GEQ5min=1, direction_opp=1, Y=1)
    rows = {k: [v, v] for k, v in row.items()}  # an exact duplicate row is dropped
    rows["age"] = ["below21", "below21"]
    df = frame(spark, rows)
    out = RC.coupon_features(df)
    assert out.columns == COUPON_39 + ["Y"] and out.count() == 1
    assert out.first()["age"] == 0


def test_bike_recipe_golden_columns(spark):
    rows = []
    for i in range(24 * 12):
        rows.append((i, "2011-01-01", 1 + i % 4, i % 2, 1 + i % 12, i % 24, i % 2, i % 7, (i + 1) % 2,
                     1 + i % 4, 0.5, 0.4, 0.6, 0.1, 3, 10, 13 + i))
    df = spark.createDataFrame(rows, "instant int, dteday string, season int, yr int, mnth int, hr int, "
                                     "holiday int, weekday int, workingday int, weathersit int, temp double, "
                                     "atemp double, hum double, windspeed double, casual int, registered int, "
                                     "cnt int")
    out = RC.bike_features(df)
    assert [c for c in out.columns if c != "label"] == BIKE_COLUMNS
    assert out.where(F.col("label").isNull()).count() == 0


def test_advertising_training_set(spark):
    camp = spark.createDataFrame(
        [("c1", ch, "2023-01-05", 10, cost, 100) for ch, cost in
         [("search_engine", 1.0), ("social_media", 2.0), ("video", 3.0), ("email", 4.0)]]
        + [("c1", "search_engine", "not a date", 1, 99.0, 1),
           ("c2", "video", "2023-02-01", 1, 5.0, 1)],
        "CAMPAIGN string, CHANNEL string, DATE string, TOTAL_CLICKS int, TOTAL_COST double, ADS_SERVED int")
    rev = spark.createDataFrame([(2023, 1, 10.0), (2023, 1, 5.0), (2023, 2, 7.0)],
                                "YEAR int, MONTH int, REVENUE double")
    out = RC.advertising_training_set(camp, rev).collect()
    # February lacks three channels and is dropped; January is complete
    assert len(out) == 1
    r = out[0].asDict()
    assert r == {"REVENUE": 15.0, "SEARCH_ENGINE": 1.0, "SOCIAL_MEDIA": 2.0, "VIDEO": 3.0, "EMAIL": 4.0}
    keyed = RC.advertising_training_set(camp, rev, keep_keys=True).first()
    assert (keyed["YEAR"], keyed["MONTH"]) == (2023, 1)


def test_credit_recipe_and_store_rows(spark):
    from featurelab.operators.store import feature_schema
    row = {"CREDIT_REQUEST_ID": [1001, 1002], "CREDIT_AMOUNT": [1000, 2000], "CREDIT_DURATION": [12, 24],
           "PURPOSE": ["Vehicle", "Holiday"], "INSTALLMENT_COMMITMENT": [2, 3],
           "OTHER_PARTIES": ["none", "Guarantor"], "CREDIT_STANDING": ["good", "bad"], "CREDIT_SCORE": [1, 0],
           "CHECKING_BALANCE": [10.5, 0.0], "SAVINGS_BALANCE": [100.0, 5.0], "EXISTING_CREDITS": [1, 2],
           "ASSETS": ["Home", "Other"], "HOUSING": ["own", "free"], "QUALIFICATION": ["skilled", "x"],
           "JOB_HISTORY": [3, 1], "AGE": [35, 50], "SEX": ["M", "F"], "MARITAL_STATUS": ["Single", "Married"],
           "NUM_DEPENDENTS": [1, 0], "RESIDENCE_SINCE": [4, 2], "OTHER_PAYMENT_PLANS": ["bank", "none"]}
    df = frame(spark, row)
    enc = {r.CREDIT_REQUEST_ID: r for r in RC.credit_features(df).collect()}
    assert enc[1001].PURPOSE_CODE == 2 and enc[1002].PURPOSE_CODE == 0
    assert enc[1002].OTHER_PARTIES_CODE == 1 and enc[1001].CREDIT_STANDING_CODE == 1
    rows = RC.credit_store_rows(df, dt.datetime(2024, 1, 1))
    schema = feature_schema([c for c in rows.columns if c not in ("entity_id", "feature_timestamp")])
    assert rows.columns == [f.name for f in schema.fields] and len(rows.columns) == 22
    assert rows.where(F.col("entity_id") == "1001").first()["sex_code"] == 1.0
    assert [r.d for r in spark.createDataFrame([(1,), (0,)], "p int")
            .select(RC.credit_decode(F.col("p")).alias("d")).collect()] == ["Approved", "Denied"]
