"""Token counts by batch encoding in Arrow functions (operator 6).

Only lengths leave the worker.  Long texts are split at safe boundaries and
the pieces of many texts are packed into batches of about equal bytes, so a
batch's memory does not depend on the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.llm.common import text_rows

MARK = "▁"  # stands for a space inside the library's pieces


@lru_cache(maxsize=4)
def counter(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """(batch length function, whether a space is a safe boundary) of a
    vocabulary file: ``.model`` by sentencepiece, ``.json`` by tokenizers."""
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        # safe if no piece holds a space after another character, each text
        # gets one leading space, and spaces are kept as they are
        inside = any(MARK in p.lstrip(MARK) for p in pieces)
        plain = (sp.encode("a", out_type=str)[0].startswith(MARK)
                 and sp.encode("a  b") == sp.encode("a") + sp.encode(" b")
                 and "".join(sp.encode(" a ", out_type=str)) == f"{MARK}{MARK}a{MARK}")
        return (lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]), plain and not inside
    if path.endswith(".json"):
        from tokenizers import Tokenizer
        tk = Tokenizer.from_file(path)
        tk.no_truncation()
        tk.no_padding()
        return (lambda texts: [len(e.ids) for e in tk.encode_batch(texts, add_special_tokens=False)]), False
    raise ValueError(f"{path}: expected a .model or .json vocabulary")


def split_safely(text: str, max_chars: int) -> list[str]:
    """Pieces whose token counts add up to the text's: cut at a space between
    two ASCII letters or digits.  The space itself is dropped, since the
    library puts one before every text.  A stretch without such a space stays
    whole, whatever its length."""
    pieces, start, n = [], 0, len(text)
    while n - start > max_chars:
        at = start + max_chars
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 >= n:
                at = -1
                break
            a, b = text[at - 1], text[at + 1]
            if a.isascii() and b.isascii() and a.isalnum() and b.isalnum():
                break
            at += 1
        if at < 0:
            break
        pieces.append(text[start:at])
        start = at + 1
    pieces.append(text[start:])
    return pieces


def count_batch(texts: list[str | None], path: str, max_chars: int, batch_bytes: int) -> np.ndarray:
    """Token count of each text; pieces are encoded in batches of about
    ``batch_bytes``."""
    lengths, safe = counter(path)
    total = np.zeros(len(texts), dtype=np.int64)
    owner: list[int] = []
    batch: list[str] = []
    held = 0

    def flush() -> None:
        nonlocal owner, batch, held
        if batch:
            np.add.at(total, owner, lengths(batch))
        owner, batch, held = [], [], 0

    for i, t in enumerate(texts):
        for piece in (split_safely(t, max_chars) if safe and t else [t or ""]):
            if held and held + len(piece) > batch_bytes:
                flush()
            owner.append(i)
            batch.append(piece)
            held += len(piece)
    flush()
    return total


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096, max_chars: int = 16_384, batch_bytes: int = 1 << 20) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) of every whole text.

    Null and empty texts count 0 bytes and 0 tokens.  Repeated rows are kept;
    an empty table gives an empty result; other columns are not read.
    """
    src = text_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("t").to_pylist()
            n = count_batch(texts, path, max_chars, batch_bytes)
            size = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)],
                ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed("id", id_col))
