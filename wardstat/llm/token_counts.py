"""Token counts without token ids (operator 12).

A sentencepiece BPE model merges neighbouring symbols only into pieces of its
vocabulary, so nothing merges across two characters that stand side by side
in no piece. A text is cut at every such place; what lies between is a
pre-token, and the text's count is the sum of its pre-tokens' counts.

1. Texts are taken in chunks of about `CHUNK` bytes. A chunk becomes one row
   for each of its distinct pre-tokens and one row with its sparse matrix of
   (pre-token, document, frequency); both are written once.
2. The chunks' pre-tokens are dealt and sorted by pre-token, so that pieces
   are counted once per distinct pre-token of the whole corpus as its rows
   pass by. One pre-token has one row a chunk at most, however often it
   stands there: that bounds the rows of a frequent one.
3. The counts go back to their chunks and meet the matrix there, which gives
   the sum of every document. No ids of a text are made.

Defined results: a null or empty text has no bytes and no tokens; rows that
repeat an id are counted each for itself, rows with a null id too; an empty
table gives an empty result; other columns are ignored. The model must leave
the text as it is but for spaces (identity normalisation, dummy prefix, no
user-defined symbols); another one is refused.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._store import keep
from wardstat.llm._text import buffer_of, id_text, slices

CHUNK = 8 << 20
PART = 1 << 20            # bytes of a chunk that are split at a time
PACK = 1 << 20            # counts that a task gathers before it sends them to their chunks
SPACE = "▁"
LIMIT = 4096
_PROBE = "A  ﬁ é　  x\tÅ "


@lru_cache(maxsize=4)
def _model(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def _pairs(path: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Class of each code point (0: never beside another one), which classes
    stand side by side in some piece, and a character that is in no piece."""
    sp = _model(path)
    if sp.normalize(_PROBE) != SPACE + _PROBE.replace(" ", SPACE):
        raise ValueError(f"{path}: the model changes texts before it splits them")
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    chars = sorted({c for p in pieces if len(p) > 1 for c in p})
    of = np.zeros(0x110000, np.uint16)
    of[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
    joined = np.zeros((len(chars) + 1,) * 2, bool)
    for p in pieces:
        at = of[[ord(c) for c in p]]
        joined[at[:-1], at[1:]] = True
    used = set("".join(pieces))
    return of, joined, next(c for c in map(chr, range(1, 0xD800)) if c not in used)


def pre_tokens(path: str, buf: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of the texts in a buffer, and the row of each."""
    of, joined, _ = _pairs(path)
    code = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=first[1:])
    at = first[off]  # first code point of each row
    some = at[:-1] < at[1:]
    code = np.insert(np.where(code == 32, ord(SPACE), code), at[:-1][some], ord(SPACE)).astype(np.uint32)
    if not len(code):
        return [], np.zeros(0, np.int64)
    starts = at[:-1][some] + np.arange(some.sum())
    cls = of[code]
    cut = np.ones(len(code) + 1, bool)
    cut[1:-1] = ~joined[cls[:-1], cls[1:]]
    cut[starts] = True
    edge = np.flatnonzero(cut)
    s = code.tobytes().decode("utf-32-le")
    e = edge.tolist()
    row = np.flatnonzero(some)[np.searchsorted(starts, edge[:-1], "right") - 1]
    return [s[a:b] for a, b in zip(e[:-1], e[1:])], row


def _matrix(path: str, buf: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pre-tokens in order, and (pre-token, row, frequency), sorted.
    Texts are split a part at a time: only distinct pre-tokens are held."""
    index: dict[str, int] = {}
    entries, times = [], []
    for i, j in slices(off, PART):
        tokens, row = pre_tokens(path, buf[off[i]:off[j]], off[i:j + 1] - off[i])
        code, words = pd.factorize(np.array(tokens, object))
        number = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
        entry, n = np.unique(number[code] * len(off) + row + i, return_counts=True)  # a row is in one part
        entries.append(entry)
        times.append(n)
    distinct = sorted(index)
    place = np.empty(len(index), np.int64)
    place[[index[w] for w in distinct]] = np.arange(len(index))
    entry = np.concatenate(entries)
    code, row = place[entry // len(off)], entry % len(off)
    order = np.lexsort((row, code))
    return distinct, code[order], row[order], np.concatenate(times)[order]


def _planes(*arrays: np.ndarray) -> bytes:
    """Numbers below 2^32, byte plane by byte plane, compressed."""
    raw = b"".join(np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays)
    return pa.compress(raw, "zstd", asbytes=True)


def _unplanes(z: bytes, *lengths: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(z, decompressed_size=4 * sum(lengths), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for n in lengths:
        out.append(np.ascontiguousarray(raw[at:at + 4 * n].reshape(4, n).T).view("<u4").ravel().astype(np.int64))
        at += 4 * n
    return out


_CHUNKS = "token string, place long, chunk long, ids array<long>, n_bytes array<long>, n_entries long, matrix binary"
#: a place is 20 bits of partition, 15 of chunk within it, 28 of pre-token
#: within that: a text, which Spark holds to 2^31 bytes, has fewer of them
_CHUNK, _AT = 15, 28


def chunks(docs: DataFrame, path: str, size: int = CHUNK) -> DataFrame:
    """Rows (token, place) of distinct pre-tokens, and one row with the
    documents and the matrix of every chunk (its token is null). The place is
    the chunk and the number of the pre-token in it."""
    schema = pa.schema([("token", pa.string()), ("place", pa.int64()), ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())),
                        ("n_bytes", pa.list_(pa.int64())), ("n_entries", pa.int64()), ("matrix", pa.binary())])

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        if part >> 63 - _CHUNK - _AT:
            raise ValueError("more partitions than a place can name; read the table in larger ones")
        chunk = part << _CHUNK
        for batch in batches:
            buf, off = buffer_of(batch.column(batch.schema.get_field_index("text")))
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for i, j in slices(off, size):
                distinct, code, row, n = _matrix(path, buf[off[i]:off[j]], off[i:j + 1] - off[i])
                k, n_rows = len(distinct), j - i
                matrix = _planes(np.bincount(code, minlength=k), row, n)
                if chunk >> _CHUNK != part:
                    raise ValueError("more chunks than a place can name; read the table in smaller partitions")
                one = [pa.array([None] * k, t) for t in schema.types[2:]]
                last = [[chunk], [ids.slice(i, n_rows).to_pylist()], [np.diff(off[i:j + 1])], [len(n)], [matrix]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*distinct, None], pa.string()), pa.array([*range(chunk << _AT, (chunk << _AT) + k), None], pa.int64()),
                     *[pa.concat_arrays([a, pa.array(b, a.type)]) for a, b in zip(one, last)]], schema=schema)
                chunk += 1

    return docs.mapInArrow(run, _CHUNKS)


def count_pieces(tokens: DataFrame, path: str) -> DataFrame:
    """(chunk, k, at, n): packed counts of the pre-tokens of (token, place)."""
    def packed(places: list[np.ndarray], counts: list[np.ndarray]):
        place, n = np.concatenate(places), np.concatenate(counts)
        order = np.argsort(place)
        place, n = place[order], n[order]
        cut = np.flatnonzero(np.r_[True, (place[1:] >> _AT) != (place[:-1] >> _AT), True])
        parts = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
        return pa.RecordBatch.from_arrays(
            [pa.array(place[cut[:-1]] >> _AT), pa.array(np.diff(cut)),
             pa.array([_planes(np.diff(place[a:b] & ((1 << _AT) - 1), prepend=0), n[a:b]) for a, b in parts], pa.binary())],
            ["chunk", "k", "counts"])

    def run(batches):
        sp, guard = _model(path), _pairs(path)[2]
        extra = len(sp.encode(guard))  # the model's own prefix ends before the guard
        places, counts, last, held = [], [], (None, 0), 0
        for batch in batches:
            code = batch.column(0).dictionary_encode()
            words = code.dictionary.to_pylist()
            fresh = [w for w in words if w != last[0]]  # the last one of the batch before is counted
            got = dict(zip(fresh, map(len, sp.encode([guard + w for w in fresh], num_threads=1))))
            n = np.array([got[w] - extra if w in got else last[1] for w in words], np.int64)
            if words:
                last = words[-1], int(n[-1])
            places.append(np.asarray(batch.column(1)))
            counts.append(n[np.asarray(code.indices)])
            held += batch.num_rows
            if held >= PACK:
                yield packed(places, counts)
                places, counts, held = [], [], 0
        if held:
            yield packed(places, counts)

    dealt = tokens.repartition("token").sortWithinPartitions("token")
    return dealt.mapInArrow(run, "chunk long, k long, counts binary")


def _sums(meta: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    m = meta.iloc[0]
    n = np.zeros(int(counts["k"].sum()), np.int64)
    for k, z in zip(counts["k"].tolist(), counts["counts"]):
        gap, v = _unplanes(z, k, k)
        n[np.cumsum(gap)] = v
    k = int(m["n_entries"])
    per, row, times = _unplanes(m["matrix"], len(n), k, k)
    total = np.bincount(row, weights=times * np.repeat(n, per), minlength=len(m["ids"])).astype(np.int64)
    return pd.DataFrame({"doc_id": pd.array(m["ids"], "Int64"), "n_bytes": m["n_bytes"], "n_tokens": total})


def token_counts(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document for the
    sentencepiece model at `path`, which every executor can read."""
    table = keep(spark, chunks(id_text(docs, id_col, text_col), path), "pre-tokens", "zstd")
    counts = count_pieces(table.where("token is not null").select("token", "place"), path)
    meta = table.where("token is null").select(F.col("chunk").alias("of"), "ids", "n_bytes", "n_entries", "matrix")
    out = meta.groupBy("of").cogroup(counts.groupBy("chunk")).applyInPandas(_sums, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
