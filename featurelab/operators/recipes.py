"""The reference's preprocessing chains, composed from the operators.

Each recipe takes the raw DataFrame of one of the reference's datasets
(schemas in FIXTURES.md) and returns what its training script hands to the
model.  Fitted pieces (label codes, modes, scaling) come from the frame they
are given, or from ``fitted`` statistics of a training split.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.functions.columns import map_lookup, pandas_concat, qcol, yes_no_flag
from featurelab.operators import aggregate as A
from featurelab.operators import encode as E

# ---------------------------------------------------------------- bank

# The bank data set's categorical columns
BANK_CATEGORICAL = ["job", "marital", "education", "default", "housing", "loan", "contact", "month",
                    "day_of_week", "poutcome"]


def bank_features(df: DataFrame, scale: bool = True) -> DataFrame:
    """Label-encode the categoricals, bucket ``pdays`` (999 -> 0, <= 30 -> 1,
    else 2), drop ``pdays`` and ``duration``, map ``y`` to 1/0 and scale the
    19 features (population std).  Returns the features, then ``label``."""
    from featurelab.plans.core import bucket_with_sentinel
    enc = E.fit_label_encoder(df, BANK_CATEGORICAL).transform(df)
    enc = enc.withColumn("pdays_bucketed", bucket_with_sentinel(qcol("pdays"))).drop("pdays", "duration")
    features = [c for c in enc.columns if c != "y"]
    out = enc.withColumn("label", yes_no_flag(qcol("y"))).drop("y")
    if scale:
        out = E.fit_standard_scaler(out, features).transform(out)
    return out.select(*[qcol(c) for c in features], "label")


# ---------------------------------------------------------------- coupon

# Age bands and ordinal code books of the coupon data set
AGE_BANDS = {"below21": "<21", "21": "21-30", "26": "21-30", "31": "31-40", "36": "31-40",
             "41": "41-50", "46": "41-50", "50plus": ">50"}
FREQUENCY = {"never": 0, "less1": 1, "1~3": 2, "4~8": 3, "gt8": 4}
COUPON_ORDINALS = {
    "expiration": {"2h": 0, "1d": 1},
    "age": {"<21": 0, "21-30": 1, "31-40": 2, "41-50": 3, ">50": 4},
    "education": {"Some High School": 0, "High School Graduate": 1, "Some college - no degree": 2,
                  "Associates degree": 3, "Bachelors degree": 4,
                  "Graduate degree (Masters or Doctorate)": 5},
    "Bar": FREQUENCY, "CoffeeHouse": FREQUENCY, "CarryAway": FREQUENCY, "Restaurant20To50": FREQUENCY,
    "income": {"Less than $12500": 0, "$12500 - $24999": 1, "$25000 - $37499": 2, "$37500 - $49999": 3,
               "$50000 - $62499": 4, "$62500 - $74999": 5, "$75000 - $87499": 6, "$87500 - $99999": 7,
               "$100000 or More": 8},
    "time": {"7AM": 0, "10AM": 1, "2PM": 2, "6PM": 3, "10PM": 4},
}
COUPON_HASHED = ["passanger_destination", "marital_hasChildren", "occupation", "coupon",
                 "temperature_weather"]
COUPON_DROPPED_FIRST = ["car", "toCoupon_GEQ5min", "direction_opp"]


def coupon_features(df: DataFrame, modes: Mapping | None = None, n_components: int = 27,
                    dedupe: bool = True) -> DataFrame:
    """Coupon preprocessing: drop unused columns, fill NULLs with the (train)
    modes, dedupe, band ages, build the three interaction texts, apply the
    ordinal code books (unmapped -> NULL), then hash the five high-cardinality
    texts into ``n_components`` counters.  39 columns without the label
    (``Y`` is kept last when present)."""
    d = df.drop(*[c for c in COUPON_DROPPED_FIRST if c in df.columns])
    cols = d.columns
    fill = dict(modes) if modes is not None else A.fit_modes(d, cols)
    d = A.apply_fill(d, fill)
    if dedupe:
        d = A.dedupe_rows(d)
    d = d.withColumn("age", map_lookup(qcol("age").cast("string"), AGE_BANDS, ">50"))
    d = d.withColumns({
        "passanger_destination": pandas_concat("-", "passanger", "destination"),
        "marital_hasChildren": pandas_concat("-", "maritalStatus", "has_children"),
        "temperature_weather": pandas_concat("-", "temperature", "weather")})
    d = d.drop("passanger", "destination", "maritalStatus", "has_children", "temperature", "weather",
               "gender", "RestaurantLessThan20")
    d = d.withColumns({c: map_lookup(qcol(c), book).cast("int") for c, book in COUPON_ORDINALS.items()
                       if c in d.columns})
    label = ["Y"] if "Y" in d.columns else []
    x = d.select(*[c for c in d.columns if c not in label], *label)
    out = E.hashing_encode(x, COUPON_HASHED, n_components)
    return out.select(*[c for c in out.columns if c not in label], *label)


# ---------------------------------------------------------------- bike demand

BIKE_RENAMES = {"weathersit": "weather", "yr": "year", "mnth": "month", "hr": "hour", "hum": "humidity",
                "cnt": "count"}
BIKE_CATEGORICAL = ["season", "month", "hour", "holiday", "weekday", "workingday", "weather"]
BIKE_UNUSED = ["atemp", "windspeed", "casual", "registered", "count"]


def bike_features(df: DataFrame, one_hot: E.OneHot | None = None) -> DataFrame:
    """Rename, drop, log target, one-hot with the first category dropped:
    the 50 features of the demand model, then ``label`` = ln(count)."""
    from featurelab.sources.files import drop_columns, rename_columns
    d = rename_columns(df, BIKE_RENAMES)
    d = drop_columns(d, ["instant", "dteday", "year"])
    d = d.withColumn("label", F.when(F.col("count") > 0, F.ln("count")))
    oh = one_hot or E.fit_one_hot(d, BIKE_CATEGORICAL)
    out = oh.transform(d)
    return out.drop(*BIKE_UNUSED)


# ---------------------------------------------------------------- advertising

# Spend channels and their column names
CHANNELS = {"search_engine": "SEARCH_ENGINE", "social_media": "SOCIAL_MEDIA", "video": "VIDEO",
            "email": "EMAIL"}


def advertising_training_set(campaign: DataFrame, revenue: DataFrame, keep_keys: bool = False) -> DataFrame:
    """Monthly spend per channel (pivot) joined to monthly revenue, rows with
    any gap dropped: the advertising model's training set."""
    from featurelab.plans.core import parse_date_lenient
    c = campaign.withColumn("_d", parse_date_lenient(F.col("DATE").cast("string")))
    c = c.select(F.year("_d").alias("YEAR"), F.month("_d").alias("MONTH"), "CHANNEL", "TOTAL_COST")
    spend = A.pivot_sum(c, ["YEAR", "MONTH"], "CHANNEL", list(CHANNELS), "TOTAL_COST", rename=CHANNELS)
    rev = A.group_sum(revenue, ["YEAR", "MONTH"], "REVENUE", "REVENUE")
    out = A.drop_any_null(rev.join(spend, ["YEAR", "MONTH"], "inner"))
    return out if keep_keys else out.drop("YEAR", "MONTH")


# ---------------------------------------------------------------- credit

# Credit code books (a value outside a book encodes as 0)
CREDIT_CODES = {
    "PURPOSE": {"Consumer Goods": 1, "Vehicle": 2, "Tuition": 3, "Business": 4, "Repairs": 5},
    "OTHER_PARTIES": {"Guarantor": 1, "Co-Applicant": 2},
    "QUALIFICATION": {"unskilled": 1, "skilled": 2, "highly skilled": 3},
    "CREDIT_STANDING": {"good": 1},
    "ASSETS": {"Vehicle": 1, "Investments": 2, "Home": 3},
    "HOUSING": {"rent": 1, "own": 2},
    "MARITAL_STATUS": {"Married": 1, "Single": 2},
    "OTHER_PAYMENT_PLANS": {"bank": 1, "stores": 2},
    "SEX": {"M": 1},
}
CREDIT_NUMERIC = ["CREDIT_AMOUNT", "CREDIT_DURATION", "INSTALLMENT_COMMITMENT", "CREDIT_SCORE",
                  "CHECKING_BALANCE", "SAVINGS_BALANCE", "EXISTING_CREDITS", "JOB_HISTORY"]
CREDIT_DEMOGRAPHIC = ["AGE", "NUM_DEPENDENTS", "RESIDENCE_SINCE"]


def credit_features(df: DataFrame) -> DataFrame:
    """Dictionary-encode the nine text columns to ``<NAME>_CODE`` (default
    0) and drop the texts."""
    codes = {f"{c}_CODE": map_lookup(qcol(c), book, 0).cast("int") for c, book in CREDIT_CODES.items()}
    return df.withColumns(codes).drop(*CREDIT_CODES)


def credit_store_rows(df: DataFrame, batch_ts) -> DataFrame:
    """Feature-table rows (FS1, FS2): entity id from the request id, one
    ingestion time for the batch, 20 double features in the table's order."""
    from featurelab.operators.store import check_required
    enc = credit_features(df)
    feats = (CREDIT_NUMERIC + [f"{c}_CODE" for c in ["PURPOSE", "OTHER_PARTIES", "QUALIFICATION",
                                                       "CREDIT_STANDING", "ASSETS", "HOUSING",
                                                       "MARITAL_STATUS", "OTHER_PAYMENT_PLANS"]]
             + CREDIT_DEMOGRAPHIC + ["SEX_CODE"])
    out = enc.select(qcol("CREDIT_REQUEST_ID").cast("string").alias("entity_id"),
                     F.lit(batch_ts).cast("timestamp").alias("feature_timestamp"),
                     *[qcol(c).try_cast("double").alias(c.lower()) for c in feats])
    return check_required(out)


def credit_decode(prediction):
    """1 -> 'Approved', anything else -> 'Denied' (P8)."""
    return F.when(prediction == 1, "Approved").otherwise("Denied")
