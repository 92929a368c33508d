"""Byte-level text helpers, vectorised over Arrow batches.

Words are maximal runs of bytes outside `[\\x20\\x09-\\x0D]`; the texts of a
batch are processed as one buffer in slices of about `SLICE` bytes, so the
cost per document is small and the memory of a task is bounded by the
largest single text. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 1 << 20

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0..P^(n-1) and their inverses modulo 2^64 (grown on demand)."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, p in enumerate((_P, _P_INV)):
            a = np.full(size, p, np.uint64)
            a[0] = 1
            _powers[k] = np.cumprod(a, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(buf: np.ndarray, lower: bool = False, second: bool = False) -> np.ndarray:
    """S with S[j]-S[i] = sum of byte values times P^position over [i, j).

    second: other byte values, for the second half of a 128-bit key.
    """
    pw, _ = powers(len(buf) + 1)
    values = _BYTE_LOWER if lower else _BYTE
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((mix64(values) if second else values)[buf] * pw[:len(buf)], out=out[1:])
    return out


def span_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of bytes [start, end), equal for equal strings wherever they stand."""
    _, inv = powers(len(s))
    return mix64((s[end] - s[start]) * inv[start] + (end - start).astype(np.uint64))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array and the row offsets into them."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes each (one row at least)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of a slice: row, byte range and hash of each."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool = False):
        n = len(buf)
        self.rows = len(offsets) - 1
        word = ~_WS[buf]
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        before[first] = False
        after = np.zeros(n, bool)
        after[:-1] = word[1:]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        after[last] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.prefix = prefix_hash(buf, lower)
        self.hash = span_hash(self.prefix, self.start, self.end)
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        #: first word of each row; row r holds words first[r]:first[r+1]
        self.first = np.searchsorted(self.row, np.arange(self.rows + 1))

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def chain(h: np.ndarray, n: int, m: int) -> np.ndarray:
    """Order-sensitive hash of h[i..i+n) for i < m."""
    acc = np.full(m, n, np.uint64)
    for k in range(n):
        acc = mix64(acc * np.uint64(0x2545F4914F6CDD1D) + h[k:k + m])
    return acc


def grams(w: Words, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(index of first word, hash) of each n-word run within one row.

    short=True also gives a row of 1..n-1 words its whole sequence as one run.
    """
    total = len(w.hash)
    m = max(0, total - n + 1)
    g = chain(w.hash, n, m) if m else np.zeros(0, np.uint64)
    at = np.flatnonzero(w.row[:m] == w.row[n - 1:n - 1 + m])
    g = g[at]
    if short and n > 1:
        cnt, parts_at, parts_g = w.count(), [at], [g]
        for k in range(1, n):
            f = w.first[:-1][cnt == k]
            if len(f):
                acc = np.full(len(f), k, np.uint64)
                for i in range(k):
                    acc = mix64(acc * np.uint64(0x2545F4914F6CDD1D) + w.hash[f + i])
                parts_at.append(f)
                parts_g.append(acc)
        at, g = np.concatenate(parts_at), np.concatenate(parts_g)
        order = np.argsort(at, kind="stable")
        at, g = at[order], g[order]
    return at, g


def map_slices(df: DataFrame, fn: Callable, schema: str, text: str = "text",
               size: int = SLICE) -> DataFrame:
    """mapInArrow over slices: fn(batch, buf, offsets) -> dict of column lists.

    `df` must hold only the columns that `fn` needs; `batch` is the slice of
    the record batch that `buf` and `offsets` describe.
    """
    names = [c.strip().split(" ")[0] for c in _split_schema(schema)]

    def run(batches):
        types = None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            buf, off = buffer_of(texts)
            for i, j in slices(off, size):
                out = fn(batch.slice(i, j - i), buf[off[i]:off[j]], off[i:j + 1] - off[i])
                if out is None:
                    continue
                types = types or _arrow_types(schema)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in
                     zip((out[c] for c in names), types)], names)

    return df.mapInArrow(run, schema)


def _split_schema(schema: str) -> list[str]:
    parts, depth, cur = [], 0, ""
    for ch in schema:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(cur)
            cur = ""
        else:
            cur += ch
    return [*parts, cur]


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
          "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
          "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
          "array<float>": pa.list_(pa.float32()), "array<double>": pa.list_(pa.float64())}


def _arrow_types(schema: str) -> list[pa.DataType]:
    return [_TYPES.get(p.strip().split(" ", 1)[1].strip()) for p in _split_schema(schema)]


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Arrow list column from flat values and the length of each row."""
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the two columns an operator reads, under fixed names."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, z (compressed UTF-8), n_bytes: texts that are going to be shuffled."""
    def run(batch, buf, off):
        raw = buf.tobytes()
        return {"doc_id": batch.column(0), "n_bytes": np.diff(off),
                "z": [pa.compress(raw[a:b], "zstd", asbytes=True) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]}

    return map_slices(docs, run, "doc_id long, n_bytes long, z binary")
