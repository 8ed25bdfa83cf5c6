"""Text operators (P16, P20, P21, P24, K7, K11, M7) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse_ws(c: Column) -> Column:
    """``" ".join(s.split())``: runs of whitespace become one space, ends trimmed."""
    return F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"^ | $", "")


def short_text(c: Column, n: int) -> Column:
    """One-line preview: whitespace collapsed; longer than n -> first n-1
    characters plus three dots (so n+2 characters long) (P16)."""
    s = collapse_ws(F.coalesce(c.cast("string"), F.lit("None")))
    return F.when(F.length(s) <= n, s).otherwise(F.concat(F.substring(s, 1, n - 1), F.lit("...")))


def word_count(c: Column) -> Column:
    """Whitespace tokens of the whole text; blank text counts 0."""
    t = collapse_ws(c)
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(t, " ")))


def tokens(c: Column) -> Column:
    """Whitespace tokens of the whole text (empty array for blank text)."""
    t = collapse_ws(c)
    return F.when(F.coalesce(t, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def strip_tags(html: Column) -> Column:
    """Drop markup (anything between < and >), collapse whitespace."""
    return collapse_ws(F.regexp_replace(html, r"<[^>]*>", " "))


def items_of(c: Column, pattern: str, names: list[str]) -> Column:
    """Array of structs from free text (P21): one per match of ``pattern``, its
    groups 1, 2, ... under ``names``.  Every match has every group (an empty
    one is ''), so the groups' arrays line up."""
    return F.arrays_zip(*[F.regexp_extract_all(c, F.lit(pattern), F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


def json_object_text(c: Column) -> Column:
    """Outermost {...} of a model reply, markdown fences and preamble dropped (P20)."""
    return F.regexp_extract(c, r"(?s)(\{.*\})", 1)


def chunk_starts(n_tokens: Column, size: int, overlap: int) -> Column:
    """Start offsets of windows of ``size`` tokens overlapping by ``overlap``.

    A window is kept when it holds at least one token the previous window
    did not, so no chunk lies wholly inside the one before it (K7)."""
    stride = size - overlap
    last = F.greatest(F.lit(0), F.ceil((n_tokens - F.lit(size)) / F.lit(stride)).cast("int"))
    return F.when(n_tokens <= 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(0), last * F.lit(stride), F.lit(stride)))


def chunk_rows(df, keys, text: Column, size: int = 512, overlap: int = 100):
    """One row per chunk of the whole text's whitespace tokens (K7):
    (keys..., chunk_id, start, tokens).  The start offsets are exploded and
    each chunk is a ``slice``, so everything runs in generated code (no
    per-row lambda)."""
    t = df.select(*keys, tokens(text).alias("_tok"))
    st = t.select(*keys, "_tok", F.posexplode(chunk_starts(F.size("_tok"), size, overlap))
                  .alias("chunk_id", "start"))
    return st.select(*keys, "chunk_id", "start", F.slice("_tok", F.col("start") + 1, size).alias("tokens"))
