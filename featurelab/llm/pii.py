"""Format-preserving pseudonyms for personal data (operator 3), in DataFrame
functions only.

Every match of ``PATTERN`` is validated (Luhn, calendar, number ranges) and
then moved within its own format by a keyed Feistel permutation: the value is
two numbers (l, r) below fixed moduli, and each round adds a keyed SHA-256
number of one half to the other.  A permutation of the format maps equal
values to equal pseudonyms and different ones to different ones, in every
document.  A match that fails its validation stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelab.llm.common import text_rows

ROUNDS = 8
# The first day of the date domain and its length, one whole
# cycle of the calendar (400 years, 146,097 days = 27 x 5411)
FIRST_DAY, DATE_L, DATE_R = "1800-01-01", 27, 5411
# An SSN has 898 areas (001-899 without 666), 99 groups, 9999 serials
SSN_AREAS, SSN_REST = 898, 99 * 9999

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
MONTH = (r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?"
         r"|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)")
# Written dates: shape and the patterns it is read by, the first that gives a
# day; a/b/yyyy is read month first where it can be
DATES = [
    (r"\d{4}/\d{2}/\d{2}", ["yyyy/MM/dd"]),
    (r"\d{2}/\d{2}/\d{4}", ["MM/dd/yyyy", "dd/MM/yyyy"]),
    (r"\d{1,2}/\d{1,2}/\d{4}", ["M/d/yyyy", "d/M/yyyy"]),
    (r"\d{2}\.\d{2}\.\d{4}", ["dd.MM.yyyy", "MM.dd.yyyy"]),
    (r"\d{1,2}\.\d{1,2}\.\d{4}", ["d.M.yyyy", "M.d.yyyy"]),
    (r"\d{2}-\d{2}-\d{4}", ["dd-MM-yyyy", "MM-dd-yyyy"]),
    (rf"\d{{1,2}} {MONTH} \d{{4}}", ["d MMMM yyyy", "d MMM yyyy"]),
    (rf"{MONTH} \d{{1,2}}, \d{{4}}", ["MMMM d, yyyy", "MMM d, yyyy"]),
]
NATIONAL = r"(?:1[ .-])?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .-])[2-9]\d{2}[ .-]\d{4}"
SECRET_KEY = (r"(?i:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?)")
# the key, then a quoted value after = or :, or an unquoted one right after =
SECRET_HEAD = rf"{SECRET_KEY}(?:[\"']? ?[=:] ?[\"']|=)"
# words before a dotted number that make it a section or a version, not an address
NUMBERED = r"(?i:section|chapter|clause|article|figure|table|version|release|build|ver\.|sec\.|no\.|\u00a7)"
SHAPES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)++",
    "phone": r"(?<![\w+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)",
    "ip": rf"(?<![\w.])(?<!{NUMBERED} ){OCTET}(?:\.{OCTET}){{3}}(?![\w]|\.\d)",
    "date": r"(?<![\w-])\d{4}-\d{2}-\d{2}(?:(?=T\d)|(?![\w-]))",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19})(?![\w-])",
    "aws_key": r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)",
    "secret": rf"{SECRET_HEAD}(?:(?<=[\"'])[^\"'\n]{{1,256}}|(?<==)[^\s\"'`,;&<>(){{}}\[\]]{{4,256}}+)",
    "international": r"(?<![\w+])\+[2-9](?:\)?[ .-]?\(?\d){7,14}(?!\d)",
    "national": rf"(?<![\w+.-]){NATIONAL}(?![\w-])",
    "card_4_6_5": r"(?<![\w-])\d{4}(?<gap>[ -])\d{6}\k<gap>\d{5}(?![\w-])",
    "written_date": rf"(?<![\w/.-])(?:{'|'.join(shape for shape, _ in DATES)})(?![\w/-]|\.\d)",
}
PATTERN = "|".join(SHAPES.values())


def keyed_number(key: Column, kind: str, turn: Column, half: Column) -> Column:
    """15 hexadecimal digits of a keyed SHA-256, as a long."""
    text = F.concat_ws("|", key, F.lit(kind), turn.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, mod_left: Column, mod_right: Column, key: Column,
            kind: str) -> Column:
    """struct(l, r): the keyed permutation of pairs (l < mod_left, r < mod_right)."""
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        even = F.pmod(i, F.lit(2)) == 0
        return F.struct(
            F.when(even, F.pmod(s["l"] + keyed_number(key, kind, i, s["r"]), mod_left)).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise(F.pmod(s["r"] + keyed_number(key, kind, i, s["l"]), mod_right)).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _padded(c: Column, width: int | Column) -> Column:
    w = F.lit(width) if isinstance(width, int) else width
    return F.lpad(c.cast("string"), w, F.lit("0"))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit counted once."""
    places = F.reverse(F.transform(F.split(digits, ""), lambda d: F.when(d == "", F.lit(0)).otherwise(d.cast("int"))))
    doubled = F.transform(places, lambda d, i: F.when(F.pmod(i, F.lit(2)) == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d)


def _card(m: Column, key: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    body = F.length(digits) - 1
    half = F.floor(body / 2).cast("int")
    rest = (body - half).cast("int")
    pair = feistel(_long(F.substr(digits, F.lit(1), half)), _long(F.substr(digits, half + 1, rest)),
                   F.pow(F.lit(10), half).cast("bigint"), F.pow(F.lit(10), rest).cast("bigint"), key, "card")
    moved = F.transform(F.array(pair), lambda p: F.concat(_padded(p["l"], half), _padded(p["r"], rest)))
    whole = F.transform(moved, lambda b: F.concat(
        b, F.pmod(F.lit(10) - F.pmod(luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")))
    gap = F.substr(m, F.lit(5), F.lit(1))
    shaped = F.transform(whole, lambda d: F.when(
        gap.isin(" ", "-"), F.concat_ws("", F.substr(d, F.lit(1), F.lit(4)), gap, F.substr(d, F.lit(5), F.lit(4)), gap,
                                        F.substr(d, F.lit(9), F.lit(4)), gap, F.substr(d, F.lit(13), F.lit(4)))).otherwise(d))
    shaped = F.when(F.length(digits) == 15, F.transform(whole, lambda d: F.when(
        gap.isin(" ", "-"), F.concat_ws("", F.substr(d, F.lit(1), F.lit(4)), gap, F.substr(d, F.lit(5), F.lit(6)), gap,
                                        F.substr(d, F.lit(11), F.lit(5)))).otherwise(d))).otherwise(shaped)
    return F.when(F.pmod(luhn_sum(digits), F.lit(10)) == 0, shaped[0]).otherwise(m)


def _in_place(m: Column, digits: Column, skip: int) -> Column:
    """``m`` with its digits after the first ``skip`` replaced one by one."""
    chars = F.filter(F.split(m, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("out"), F.lit(-skip).alias("n"))

    def put(s: Column, c: Column) -> Column:
        is_digit = c.between("0", "9") & (F.length(c) == 1)
        put_new = is_digit & (s["n"] >= 0)
        return F.struct(F.concat(s["out"], F.when(put_new, F.substr(digits, s["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
                        (s["n"] + F.when(is_digit, 1).otherwise(0)).alias("n"))

    return F.aggregate(chars, start, put, lambda s: s["out"])


def _ten_digits(ten: Column, key: Column) -> Column:
    """The pseudonym of a North American number's ten digits, the same for all
    its spellings.  Area code and exchange stay within 200-999; numbers with an
    area code, or else an exchange, under 200 stay among those."""
    area, rest = _long(F.substring(ten, 1, 3)), _long(F.substring(ten, 4, 7))
    low, valid = area < 200, rest >= 2_000_000
    first = F.when(low, 0).otherwise(200).cast("bigint")
    second = F.when(~low & valid, 2_000_000).otherwise(0).cast("bigint")
    sizes = (F.when(low, 200).otherwise(800).cast("bigint"),
             F.when(low, 10_000_000).when(valid, 8_000_000).otherwise(2_000_000).cast("bigint"))
    pair = feistel(area - first, rest - second, *sizes, key, "national")
    return F.transform(F.array(pair), lambda p: F.concat(_padded(p["l"] + first, 3), _padded(p["r"] + second, 7)))[0]


def _national(m: Column, key: Column) -> Column:
    """With or without the country's digit."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    new = F.array(_ten_digits(F.substr(digits, F.length(digits) - 9, F.lit(10)), key))
    return F.transform(new, lambda d: F.when(F.length(digits) == 11, _in_place(m, d, 1)).otherwise(_in_place(m, d, 0)))[0]


def _international(m: Column, key: Column) -> Column:
    """The first two digits, which hold the country or its zone, stay."""
    digits = F.substring(F.regexp_replace(m, "[^0-9]", ""), 3, 13)
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = (F.length(digits) - half).cast("int")
    pair = feistel(_long(F.substr(digits, F.lit(1), half)), _long(F.substr(digits, half + 1, rest)),
                   F.pow(F.lit(10), half).cast("bigint"), F.pow(F.lit(10), rest).cast("bigint"), key, "international")
    return F.transform(F.array(pair), lambda p: _in_place(m, F.concat(_padded(p["l"], half), _padded(p["r"], rest)), 2))[0]


def _ip(m: Column, key: Column) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    word = F.lit(65_536).cast("bigint")
    pair = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], word, word, key, "ip")
    return F.transform(F.array(pair), lambda p: F.concat_ws(
        ".", F.floor(p["l"] / 256).cast("string"), F.pmod(p["l"], F.lit(256)).cast("string"),
        F.floor(p["r"] / 256).cast("string"), F.pmod(p["r"], F.lit(256)).cast("string")))[0]


def _date(m: Column, key: Column, form: str = "yyyy-MM-dd") -> Column:
    day = F.date_diff(F.try_to_date(m, form), F.to_date(F.lit(FIRST_DAY))).cast("bigint")
    inside = day.between(0, DATE_L * DATE_R - 1)
    pair = feistel(F.floor(day / DATE_R), F.pmod(day, F.lit(DATE_R)), F.lit(DATE_L).cast("bigint"),
                   F.lit(DATE_R).cast("bigint"), key, "date")
    moved = F.transform(F.array(pair), lambda p: F.date_format(
        F.date_add(F.to_date(F.lit(FIRST_DAY)), (p["l"] * DATE_R + p["r"]).cast("int")), form))[0]
    return F.when(inside, moved).otherwise(m)


def _written_date(m: Column, key: Column) -> Column:
    """Moved as the same day in ISO form is, and written as it was."""
    out = m
    for shape, forms in reversed(DATES):
        read = F.coalesce(*[F.when(F.try_to_date(m, f).isNotNull(), _date(m, key, f)) for f in forms], m)
        out = F.when(m.rlike(f"^{shape}$"), read).otherwise(out)
    return out


def _secret(m: Column, key: Column) -> Column:
    head = F.regexp_extract(m, f"^{SECRET_HEAD}", 0)
    value = F.substr(m, F.length(head) + 1, F.length(m))
    return F.concat(head, F.substr(_hex(value, key, "secret"), F.lit(1), F.greatest(F.length(value), F.lit(16))))


def _ssn(m: Column, key: Column) -> Column:
    area, group, serial = (_long(F.substring(m, a, n)) for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    left = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = feistel(left, (group - 1) * 9999 + serial - 1, F.lit(SSN_AREAS).cast("bigint"),
                   F.lit(SSN_REST).cast("bigint"), key, "ssn")
    moved = F.transform(F.array(pair), lambda p: F.concat_ws(
        "-", _padded(p["l"] + 1 + F.when(p["l"] >= 665, 1).otherwise(0), 3),
        _padded(F.floor(p["r"] / 9999) + 1, 2), _padded(F.pmod(p["r"], F.lit(9999)) + 1, 4)))[0]
    return F.when(valid, moved).otherwise(m)


def _hex(m: Column, key: Column, kind: str) -> Column:
    """64 hexadecimal digits that stand for ``m``; texts without a bounded
    format of digits get a keyed digest instead of a permutation."""
    return F.sha2(F.concat_ws("|", key, F.lit(kind), m), 256)


def pseudonym(m: Column, key: Column) -> Column:
    """Pseudonym of one match, by its shape; ``m`` itself if not valid."""
    digits = r"^\d+$"
    return (F.when(m.rlike(f"^{SECRET_HEAD}"), _secret(m, key))
            .when(F.contains(m, F.lit("@")), F.concat(
                F.lit("u"), F.substring(_hex(F.lower(m), key, "email"), 1, 16), F.lit("@example.invalid")))
            .when(F.startswith(m, F.lit("+")) & ~F.startswith(m, F.lit("+1")), _international(m, key))
            .when(F.startswith(m, F.lit("+1")) | m.rlike(f"^{NATIONAL}$"), _national(m, key))
            .when(m.rlike("^(?:" + "|".join(shape for shape, _ in DATES) + ")$"), _written_date(m, key))
            .when(F.startswith(m, F.lit("AKIA")), F.concat(
                F.lit("AKIA"), F.upper(F.substring(_hex(m, key, "aws"), 1, 16))))
            .when(F.contains(m, F.lit(".")), _ip(m, key))
            .when(m.rlike(r"^\d{4}-\d{2}-\d{2}$"), _date(m, key))
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), _ssn(m, key))
            .when(m.rlike(r"^\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}$") | m.rlike(r"^\d{4}[ -]\d{6}[ -]\d{5}$")
                  | (m.rlike(digits) & F.length(m).between(13, 19) & (F.pmod(luhn_sum(m), F.lit(10)) == 0)),
                  _card(m, key))
            .otherwise(m))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, n_found, n_replaced) of every whole text.

    Handled: card numbers (Luhn; also in groups of 4-4-4-4 and 4-6-5), phone
    numbers (+1, other +country, North American without country code), social
    security numbers, IPv4 addresses and dates (ISO, also before a time;
    ``DATES``) by permutation within the format; e-mail addresses, access keys
    and the values of password, token or key settings by a keyed digest.  A
    date of two readings (03/04/2024) is read as ``DATES`` says, so in that one
    form two values may share a pseudonym.  A pseudonymised card is again a valid card, a date a date.
    A null text stays null with counts 0, an empty one empty; repeated rows
    are kept; an empty table gives an empty result; other columns are not
    read.
    """
    t = F.col("t")
    k = F.lit(key)
    src = text_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")))
    # one cheap look for what any shape needs spares some texts the full pattern
    found = src.withColumn("m", F.when(t.rlike("[0-9@=:]|AKIA"), F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0)))
                           .otherwise(F.array().cast("array<string>")))
    new = found.withColumn("p", F.transform("m", lambda m: pseudonym(m, k)))
    gaps = F.split(t, PATTERN, -1)
    joined = F.array_join(F.zip_with(gaps, F.col("p"), lambda g, p: F.concat(g, F.coalesce(p, F.lit("")))), "")
    changed = F.aggregate(F.zip_with("m", "p", lambda a, b: F.when(a == b, 0).otherwise(1)), F.lit(0), lambda a, x: a + x)
    any_ = F.size("m") > 0
    return new.select(
        F.col("id").alias(id_col), F.when(any_, joined).otherwise(t).alias(text_col),
        F.when(any_, F.size("m")).otherwise(0).cast("bigint").alias("n_found"),
        F.when(any_, changed).otherwise(0).cast("bigint").alias("n_replaced"))
