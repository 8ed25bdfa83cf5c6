"""Byte-pair encoding and decoding by batched numpy merge rounds (operator 2).

``WordBPE`` reads the public ``tokenizers`` JSON of a BPE with word ends.  A
batch of texts is normalised and cut into words; the words not met before in
this worker are laid end to end in one flat symbol array and merged in rounds.
A round finds every adjacent pair's rank by binary search over the sorted pair
keys, takes each word's lowest rank, and merges all its occurrences from the
left.  Words without a mergeable pair leave the array.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.llm.common import text_rows

NO_RANK = np.int64(1) << 40
CACHE_WORDS = 800_000  # words a worker remembers before it starts anew
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPECIAL = " "  # marks a special token among stretches, which hold no space


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: a printable Latin-1 byte is itself, the others are numbered
    from U+0100 in byte order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each (start, length), end to end."""
    shift = start - (np.cumsum(length) - length)
    return np.repeat(shift, length) + np.arange(int(length.sum()))


class WordBPE:
    """Encoder and decoder for one vocabulary file.  Supports what the file
    format's word-level byte BPE states: NFC, white-space folding, lower case,
    a splitting pattern, byte alphabet, end-of-word suffix and special tokens
    that are cut out of the raw text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or spec["decoder"] is not None or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: not a word-end byte BPE of the supported form")
        vocab = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for t, i in [*vocab.items(), *special.items()]:
            self.tokens[i] = t
        self.special = special
        longest_first = sorted(special, key=len, reverse=True)
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")
        alphabet = byte_alphabet()
        suffix = model["end_of_word_suffix"] or ""
        self.inner = np.array([vocab[c] for c in alphabet], dtype=np.int64)
        self.last = np.array([vocab[c + suffix] for c in alphabet], dtype=np.int64)
        n = np.int64(len(self.tokens))
        self.size = n
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * int(n) + vocab[b] for a, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made_by_rank = keys[order], order.astype(np.int64), made
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        space = r"[\t-\r \x85\xa0  -     　]"
        self.spaces = regex.compile(space + "+")
        # \s as the Unicode White_Space property, which the file's pattern means
        self.words = regex.compile(pattern.replace(r"^\s", "^" + space[1:-1]))
        self.forget()

    def chunks(self, text: str) -> list[str]:
        """Normalised stretches between white space; the splitting pattern
        never crosses white space, so each stretch is cut on its own."""
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        # letter by letter: a final capital sigma has no special lower case
        text = text.replace("Σ", "σ").lower()
        if any(c in text for c in SEPARATORS):  # Python's white space, not the pattern's
            return self.spaces.split(text)
        return text.split()

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NO_RANK if it has none."""
        pair = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.rank[at], NO_RANK)

    def merge(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all words end to end, number of each): all words are
        merged together in rounds."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(lens)
        sym[ends - 1] = self.last[flat[ends - 1]]
        rank = np.full(len(sym), NO_RANK)
        rank[:-1] = self.pair_ranks(sym[:-1], sym[1:])
        rank[ends - 1] = NO_RANK  # no pair across two words
        names, n_out, parts = np.arange(len(raw)), np.zeros(len(raw), np.int64), []
        while len(names):
            starts = ends - lens
            low = np.minimum.reduceat(rank, starts)
            done = low == NO_RANK
            if done.any():
                gone = np.repeat(done, lens)
                parts.append((names[done], sym[gone]))
                n_out[names[done]] = lens[done]
                sym, rank = sym[~gone], rank[~gone]
                lens, names, low = lens[~done], names[~done], low[~done]
                ends = np.cumsum(lens)
                if not len(names):
                    break
            word_of = np.repeat(np.arange(len(names)), lens)
            hit = rank == low[word_of]
            # occurrences that overlap (a a a) merge from the left: every other
            # one of a run of neighbouring hits
            index = np.arange(len(hit))
            first = hit.copy()
            first[1:] &= ~hit[:-1]
            run_start = np.maximum.accumulate(np.where(first, index, -1))
            hit &= (index - run_start) % 2 == 0
            places = np.flatnonzero(hit)
            sym[places] = self.made_by_rank[rank[places]]
            keep = np.ones(len(sym), dtype=bool)
            keep[places + 1] = False
            lens = lens - np.bincount(word_of[places + 1], minlength=len(names))
            ends = np.cumsum(lens)
            sym, rank = sym[keep], rank[keep]
            # only pairs beside a merged symbol have a new rank
            at = places - np.arange(len(places))
            touched = np.concatenate([at, at - 1])
            touched = touched[(touched >= 0) & (touched < len(sym) - 1)]
            rank[touched] = self.pair_ranks(sym[touched], sym[touched + 1])
            rank[ends - 1] = NO_RANK
        # back into the order of the words
        out_ends = np.cumsum(n_out)
        out = np.zeros(int(out_ends[-1]) if len(out_ends) else 0, np.uint32)
        for who, ids in parts:
            out[ranges(out_ends[who] - n_out[who], n_out[who])] = ids
        return out, n_out

    def learn(self, fresh: list[str]) -> None:
        """Encode new stretches and remember them: ids in one flat array,
        (start, length) by number."""
        words, counts = [], []
        for c in fresh:
            w = self.words.findall(c)
            words += w
            counts.append(len(w))
        ids, n = self.merge(words) if words else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        per_word = np.concatenate([[0], np.cumsum(n)])
        last = np.cumsum(np.array(counts, dtype=np.int64))
        stop = per_word[last]
        start = np.concatenate([[0], stop[:-1]])
        base = len(self.ids)
        self.number.update(zip(fresh, range(len(self.start), len(self.start) + len(fresh))))
        self.ids = np.concatenate([self.ids, ids])
        self.start = np.concatenate([self.start, start + base])
        self.length = np.concatenate([self.length, stop - start])

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def encode_batch(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text (uint32); a null text has none."""
        if len(self.number) > CACHE_WORDS:
            self.forget()
        flat: list[str] = []  # stretches of all texts; a special token stands for itself
        ends = []
        for t in texts:
            if t and any(p in t for p in self.special):
                for p in self.special_cut.split(t):
                    flat.extend([SPECIAL + p] if p in self.special else self.chunks(p))
            elif t:
                flat.extend(self.chunks(t))
            ends.append(len(flat))
        fresh = list(set(flat).difference(self.number))
        cut = [c for c in fresh if c.startswith(SPECIAL) and c[len(SPECIAL):] in self.special]
        if cut:
            fresh = [c for c in fresh if c not in set(cut)]
        # the flat arrays of a round hold about a million symbols at once
        group, n = [], 0
        for c in fresh:
            group.append(c)
            n += len(c)
            if n > 1_000_000:
                self.learn(group)
                group, n = [], 0
        if group:
            self.learn(group)
        for c in cut:
            self.number[c] = len(self.start)
            self.start = np.append(self.start, len(self.ids))
            self.length = np.append(self.length, 1)
            self.ids = np.append(self.ids, np.uint32(self.special[c[len(SPECIAL):]]))
        idx = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        length = self.length[idx]
        ids = self.ids[ranges(self.start[idx], length)]
        at = np.concatenate([[0], np.cumsum(length)])[np.array(ends, dtype=np.int64)]
        return np.split(ids, at[:-1]) if len(at) else []

    def decode(self, ids: Sequence[int]) -> str:
        """Token texts joined by spaces, as the format does without a decoder;
        special tokens are kept."""
        return " ".join(map(self.tokens.__getitem__, ids))


_LOADED: dict[str, WordBPE] = {}


def load(path: str) -> WordBPE:
    """One instance per worker process."""
    if path not in _LOADED:
        _LOADED[path] = WordBPE(path)
    return _LOADED[path]


def byte_slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of about ``max_bytes`` of text, one row at least."""
    size = np.cumsum([len(v) if v else 0 for v in batch.column(column).to_pylist()])
    start = 0
    while start < batch.num_rows:
        base = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, base + max_bytes, side="right")))
        yield batch.slice(start, end - start)
        start = end


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           slice_bytes: int = 2 << 20) -> DataFrame:
    """(id_col, ids array<int>): the token ids of every whole text, one row per
    input row.  Null and empty texts give an empty array; an empty table gives
    an empty result; other columns are not read."""
    src = text_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for b in byte_slices(batch, "t", slice_bytes):
                ids = bpe.encode_batch(b.column("t").to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["id", "ids"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text): the decoded text of every row; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            texts = [bpe.decode(x or ()) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    src = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, text string").select(F.col("id").alias(id_col), "text")


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  slice_bytes: int = 2 << 20) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    The ids are encoded and decoded in one Arrow pass and only their digests
    leave the worker: SHA-256 of the ids as little-endian unsigned 32-bit
    integers, and of the decoded text in UTF-8.  Nulls count as empty texts,
    repeated rows are kept, an empty table gives an empty result.
    """
    src = text_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for b in byte_slices(batch, "t", slice_bytes):
                ids = bpe.encode_batch(b.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays([
                    b.column("id"), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(bpe.decode(x.tolist()).encode()).hexdigest() for x in ids])],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))
