"""Column-expression helpers.

All of these return ``Column`` objects built from ``pyspark.sql.functions``:
they stay inside whole-stage codegen and never call back into Python.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round4(c: str | Column, scale: int = 4) -> Column:
    """Round a double to ``scale`` places as ``round(x * 10^s) / 10^s``.

    Rounding the scaled binary value (not its shortest decimal text) makes a
    value like 57448.33475 round the same way in every engine that compares
    with us.
    """
    m = float(10 ** scale)
    r = F.round(col_(c).cast("double") * F.lit(m), 0) / F.lit(m)
    # a zero is always +0.0: engines disagree on the sign of a rounded
    # near-zero value whose last bits differ
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def round4_sql(expr: str, scale: int = 4) -> str:
    """SQL twin of ``round4``: rounded, with the zero's sign normalised."""
    r = f"round({expr}, {scale})"
    return f"(CASE WHEN {r} = 0 THEN CAST(0 AS DOUBLE) ELSE {r} END)"


def bround_py(c: str | Column, scale: int = 2) -> Column:
    """Python's ``round`` (half-even), e.g. a served prediction (P25)."""
    return F.bround(col_(c).cast("double"), scale)


def pandas_str(c: str | Column) -> Column:
    """``astype(str)`` as pandas does it: a missing value becomes ``nan``."""
    return F.coalesce(col_(c).cast("string"), F.lit("nan"))


def pandas_concat(sep: str, *cols: str | Column) -> Column:
    """``a.astype(str) + sep + b.astype(str)``.

    ``concat`` would give NULL and ``concat_ws`` would skip the value; pandas
    writes the text ``nan``.
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(pandas_str(c))
    return F.concat(*parts)


def map_lookup(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup through a ``create_map`` literal with a default.

    ``default=None`` leaves unmapped values NULL (the coerce rule of P6).
    """
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    # try_element_at gives NULL for a missing key even under ANSI
    looked = F.try_element_at(F.create_map(*items), col_(c)) if items else F.lit(None)
    if default is None:
        return looked
    return F.coalesce(looked, F.lit(default))


def yes_no_flag(c: str | Column, yes: str = "yes") -> Column:
    """``1 if x == yes else 0``; a missing value gives 0."""
    return F.coalesce((col_(c) == F.lit(yes)).cast("int"), F.lit(0))


def md5_prefix_int(c: Column, hex_digits: int = 8) -> Column:
    """First ``hex_digits`` hex digits of md5(text) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(c), 1, hex_digits), 16, 10).cast("bigint")


def md5_mod_sql(text_sql: str, n: int) -> str:
    """SQL text of ``int(md5(text).hexdigest(), 16) % n`` without 128-bit
    integers: the digest is read as four 32-bit digits d0..d3 and reduced by
    Horner's rule, ``r <- (r * 2^32 + d) mod n``; every intermediate stays
    below ``n * 2^32``, well inside a bigint."""
    h = f"md5({text_sql})"
    r = "CAST(0 AS BIGINT)"
    for i in range(4):
        d = f"CAST(conv(substring({h}, {1 + 8 * i}, 8), 16, 10) AS BIGINT)"
        r = f"pmod({r} * {1 << 32} + {d}, {n})"
    return r


def md5_mod(c: Column | str, n: int) -> Column:
    """``int(md5(text).hexdigest(), 16) % n`` (see ``md5_mod_sql``).

    Built from one SQL text (a single expression parse) rather than dozens
    of separate column calls; ``c`` is a column name or a Column."""
    if isinstance(c, str):
        return F.expr(md5_mod_sql(quote(c), n))
    return _md5_mod_column(c, n)


def _md5_mod_column(c: Column, n: int) -> Column:
    h = F.md5(c)
    r = F.lit(0).cast("bigint")
    for i in range(4):
        d = F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint")
        r = F.pmod(r * F.lit(1 << 32) + d, F.lit(n))
    return r


def quote(name: str) -> str:
    """Back-quoted column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def stable_unit(key: Column, seed: int = 42, resolution: int = 1_000_000) -> Column:
    """Deterministic value in [0, resolution) from md5(key || seed).

    Independent of partitioning and row order, so a split or a sample
    computed with it is the same at 2 or 2000 partitions and on a retry.
    """
    return F.pmod(md5_prefix_int(F.concat(key.cast("string"), F.lit(str(seed)))),
                  F.lit(resolution))


def null_if_key_mod(c: str | Column, key: str | Column, mod: int, rem: int = 0) -> Column:
    """Inject a NULL by a fixed rule (``key % mod == rem``) for null tests."""
    return F.when(F.pmod(col_(key), F.lit(mod)) == rem, F.lit(None)).otherwise(col_(c))


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def ratio(num: Column, den: Column) -> Column:
    """0/0 -> 0 as the metric libraries report it (M1)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def copy_ids(n: Column) -> Column:
    """``[0, 1, ..., n-1]`` (empty for n <= 0): explode it to make n copies.

    ``sequence(0, n - 1)`` alone would count *down* for n = 0 and give two
    elements.
    """
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(
        F.array().cast("array<int>"))


def assert_rows(df, cond: Column, message: str, carrier: str):
    """Fail the job on any row where ``cond`` is false.

    The assertion is folded into a column that stays in the output (a
    separate, later dropped column would be pruned and never evaluated).
    """
    t = df.schema[carrier].dataType
    return df.withColumn(carrier, F.coalesce(F.assert_true(cond, message).cast(t), F.col(carrier)))


def qcol(name: str) -> Column:
    """Column by exact name, dots included (``emp.var.rate`` is one column,
    not a nested field)."""
    return F.col("`" + name.replace("`", "``") + "`")
