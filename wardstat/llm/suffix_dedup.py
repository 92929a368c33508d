"""Exact substring dedup by distributed prefix doubling (operator 7).

A byte is removed if it lies in a string of `length` bytes that also starts
earlier (smaller doc_id, or the same document further left). Ranks of
prefixes grow by doubling: a prefix of h = length/2 bytes is ranked first,
then the pair of ranks at offset h ranks `length` bytes; a position leaves
as soon as its rank is unique.

Round 1 (h bytes). Of the h+1 prefixes inside a string of `length` bytes the
smallest stands for it (leftmost if equal), so two equal strings are stood
for by equal prefixes. Consecutive starts with the same smallest prefix form
one row, an extent: about one row for every 25 bytes. Spark counts
the prefixes; those found once leave, with all the starts they stand for.

Round 2 (2h bytes). Extents equal as a whole are equal start by start: all
but the earliest are removed without looking further. Where one prefix has
several different extents, the earliest of each kind is opened: its starts
are sorted by their pair of ranks at offset h, and all but the earliest of
each pair are removed. This sort runs within the partition of the prefix;
a prefix with more than `HOT` kinds is spread over the cluster by the pairs
of ranks instead.

Ranks are 64-bit fingerprints of the bytes, so equal strings get equal ranks
in any task; the final comparison uses 128 bits. Tables of extents travel by
equi-joins that AQE splits where one prefix is frequent; counts and minima
are combined before the shuffle. Texts travel compressed.

Defined results: null or empty texts have no bytes; texts below `length`
bytes are left whole; rows that repeat an id are the same document (equal
places in them count as one); rows with a null id are left whole; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._store import keep, release
from wardstat.llm._text import id_text, map_slices, mix64, packed_texts, powers, prefix_hash, span_hash

LENGTH = 100
PIECE = 1 << 18           # bytes worked on at a time
HOT = 2000                # kinds of extents of one rank that one task settles
SETTLE = 50_000           # opened extents of a task
PLACE = np.uint64(24)     # bits of a place within a piece


def _names(s: np.ndarray, h: int, n: int) -> np.ndarray:
    """Fingerprints of the h bytes at positions 0..n-h."""
    inv = powers(len(s))[1]
    return mix64((s[h:n + 1] - s[:n - h + 1]) * inv[:n - h + 1] + np.uint64(h))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    size, m = 1, x
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:len(x) - w + 1], m[w - size:w - size + len(x) - w + 1]) if size < w else m


def extents_of(buf: np.ndarray, off: np.ndarray, length: int):
    """Extents of the rows of a slice: row, first start, starts, rank of the
    prefix that stands for them, fingerprint of all their bytes."""
    h = length // 2
    out = []
    for a in range(0, len(buf), PIECE):
        b = buf[a:a + PIECE + length - 1]  # starts a .. a+PIECE-1
        n = len(b)
        if n < length:
            break
        s = prefix_hash(b)
        name = _names(s, h, n)
        packed = ((name >> PLACE) << PLACE) | np.arange(len(name), dtype=np.uint64)
        low = _sliding_min(packed, length - h + 1)            # by start
        place = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        start = np.arange(len(place))
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))[a:a + len(place)]
        ok = a + start + length <= off[1:][row]
        ok &= start < PIECE
        start, place, row = start[ok], place[ok], row[ok]
        if not len(start):
            continue
        new = np.ones(len(start), bool)
        new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(start)))
        lo = start[first]
        out.append((row[first], a + lo - off[:-1][row[first]], count, name[place[first]],
                    span_hash(s, lo, lo + count - 1 + length)))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def extents(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, lo, n, rank, whole) of every text."""
    def run(batch, buf, off):
        row, lo, n, rank, whole = extents_of(buf, off, length)
        return {"doc_id": batch.column(0).take(pa.array(row)), "lo": lo.astype(np.int64), "n": n.astype(np.int64),
                "rank": rank.view(np.int64), "whole": whole.view(np.int64)}

    return map_slices(docs.where(F.col("doc_id").isNotNull()), run,
                      "doc_id long, lo long, n long, rank long, whole long", size=PIECE)


def _open(lists: DataFrame, length: int) -> DataFrame:
    """The bytes of opened extents (rank, doc_id, lo, bytes); of those whose
    rank has more than HOT kinds, the single starts with their pair of ranks
    (doc_id, lo, r1, r2) instead."""
    h = length // 2

    def run(batches):
        for t in batches:
            col = {c: t.column(t.schema.get_field_index(c)) for c in t.schema.names}
            out = {c: [] for c in ("rank", "doc", "lo", "bytes", "r1", "r2")}
            for r in range(t.num_rows):
                raw = pa.decompress(col["z"][r].as_py(), col["n_bytes"][r].as_py(), "zstd", asbytes=True)
                lo, n, rank, hot = (col[c][r].values.to_numpy(zero_copy_only=False) for c in ("lo", "n", "rank", "hot"))
                ok = lo + n - 1 + length <= len(raw)
                lo, n, rank, hot = lo[ok], n[ok], rank[ok], hot[ok].astype(bool)
                for a, m in zip(lo[~hot].tolist(), n[~hot].tolist()):
                    out["bytes"].append(raw[a:a + m - 1 + length])
                s = np.zeros(0, np.int64)
                if hot.any():
                    k = n[hot]
                    s = np.unique(np.repeat(lo[hot], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k))
                    p = prefix_hash(np.frombuffer(raw, np.uint8))
                    out["r1"] += [None] * int((~hot).sum()) + span_hash(p, s, s + h).view(np.int64).tolist()
                    out["r2"] += [None] * int((~hot).sum()) + span_hash(p, s + h, s + length).view(np.int64).tolist()
                else:
                    out["r1"] += [None] * len(lo)
                    out["r2"] += [None] * len(lo)
                out["bytes"] += [None] * len(s)
                out["rank"] += rank[~hot].tolist() + [None] * len(s)
                out["lo"] += lo[~hot].tolist() + s.tolist()
                out["doc"] += [r] * (int((~hot).sum()) + len(s))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["rank"], pa.int64()), col["doc_id"].take(pa.array(out["doc"], pa.int64())),
                 pa.array(out["lo"], pa.int64()), pa.array(out["bytes"], pa.binary()),
                 pa.array(out["r1"], pa.int64()), pa.array(out["r2"], pa.int64())], ["rank", "doc_id", "lo", "bytes", "r1", "r2"])

    return lists.mapInArrow(run, "rank long, doc_id long, lo long, bytes binary, r1 long, r2 long")


def _settle(opened: DataFrame, length: int) -> DataFrame:
    """(doc_id, lo, hi) of the starts that are not the earliest of their pair
    of ranks. Equal strings have equal ranks in round 1, so all that can be
    equal is in one partition, of about SETTLE extents."""
    h = length // 2

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches).combine_chunks()
        raw = t.column("bytes").to_pylist()
        size = np.array([len(b) for b in raw], np.int64)
        buf = np.frombuffer(b"".join(raw), np.uint8)
        begin = np.cumsum(size) - size
        doc, lo = t.column("doc_id").to_numpy(), t.column("lo").to_numpy()
        parts = []
        step = 1 << 14
        for a in range(0, len(raw), step):  # ranks of a bounded number of bytes at a time
            b = min(a + step, len(raw))
            k = size[a:b] - length + 1
            of = np.repeat(np.arange(a, b), k)
            within = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            s = prefix_hash(buf[begin[a]:begin[b - 1] + size[b - 1]])
            x = begin[of] - begin[a] + within
            parts.append((span_hash(s, x, x + h), span_hash(s, x + h, x + length), doc[of], lo[of] + within))
        r1, r2, d, p = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((p, d, r2, r1))
        r1, r2, d, p = r1[order], r2[order], d[order], p[order]
        # the first of each pair of ranks, and places equal to it, stay
        first = np.ones(len(r1), bool)
        first[1:] = (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])
        lead = np.flatnonzero(first)[np.cumsum(first) - 1]
        later = (d != d[lead]) | (p != p[lead])
        d, p = d[later], p[later]
        order = np.lexsort((p, d))
        d, p = d[order], p[order]
        new = np.ones(len(d), bool)  # neighbouring starts make one range
        new[1:] = (d[1:] != d[:-1]) | (p[1:] > p[:-1] + length)
        at = np.flatnonzero(new)
        end = np.append(at[1:], len(d)) - 1
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(d[at]), pa.array(p[at]), pa.array(p[end] + length)], ["doc_id", "lo", "hi"])

    parts = max(1, -(-opened.count() // SETTLE))
    return (opened.repartition(parts, "rank").select("doc_id", "lo", "bytes")
            .mapInArrow(run, "doc_id long, lo long, hi long"))


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, lo, hi): byte ranges, possibly overlapping, that occur earlier."""
    d = id_text(docs, id_col, text_col)
    rows = extents(d, length)
    # round 1: ranks of half the length; a rank found once leaves
    twice = rows.groupBy("rank").count().where("count > 1").select("rank")
    alive = keep(spark, rows.join(twice.hint("shuffle_hash"), "rank", "left_semi"), "extents")
    release(spark)

    # round 2: equal extents first, then the starts of different ones
    kinds = keep(spark, alive.groupBy("rank", "whole").agg(F.min(F.struct("doc_id", "lo")).alias("least"),
                                                           F.first("n").alias("n"), F.count("*").alias("k")), "kinds")
    release(spark)
    copies = (alive.join(kinds.where("k > 1").select("rank", "whole", "least"), ["rank", "whole"])
              .where(F.struct("doc_id", "lo") != F.col("least"))
              .select("doc_id", "lo", (F.col("lo") + F.col("n") - 1 + length).alias("hi")))
    copies = keep(spark, copies, "copies")
    release(spark)
    mixed = (kinds.groupBy("rank").agg(F.count("*").alias("m")).where("m > 1")
             .select("rank", (F.col("m") > HOT).alias("hot")))
    lists = (kinds.join(mixed, "rank").select("rank", "hot", "least.doc_id", "least.lo", "n").groupBy("doc_id")
             .agg(*[F.collect_list(c).alias(c) for c in ("lo", "n", "rank", "hot")]))
    opened = keep(spark, _open(lists.join(packed_texts(d.where(F.col("doc_id").isNotNull())), "doc_id"), length), "opened")
    release(spark)
    starts = opened.where("bytes is null")
    earliest = (starts.groupBy("r1", "r2").agg(F.min(F.struct("doc_id", "lo")).alias("least"), F.count("*").alias("k"))
                .where("k > 1").select("r1", "r2", "least"))
    later = (starts.join(earliest, ["r1", "r2"]).where(F.struct("doc_id", "lo") != F.col("least"))
             .select("doc_id", "lo", (F.col("lo") + length).alias("hi")))
    later = later.unionAll(_settle(opened.where("bytes is not null"), length))
    return copies.unionAll(later)


def _merge(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the ranges."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > hi[:-1]
    return lo[new], hi[np.append(np.flatnonzero(new)[1:] - 1, len(hi) - 1)]


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes that are left) -- one row per row of `docs`."""
    per_doc = spans.groupBy("doc_id").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    rows = packed_texts(id_text(docs, id_col, text_col)).join(per_doc, "doc_id", "left")

    def run(batches):
        for t in batches:
            z, size, los, his = (t.column(t.schema.get_field_index(c)) for c in ("z", "n_bytes", "lo", "hi"))
            removed, runs, kept = [], [], []
            for r in range(t.num_rows):
                b = pa.decompress(z[r].as_py(), size[r].as_py(), "zstd", asbytes=True)
                lo = hi = np.zeros(0, np.int64)
                if los[r].is_valid:
                    lo, hi = _merge(los[r].values.to_numpy(), his[r].values.to_numpy())
                    lo, hi = lo[lo < len(b)], np.minimum(hi[lo < len(b)], len(b))
                    keep_from = [0, *hi.tolist()]
                    b = b"".join(b[x:y] for x, y in zip(keep_from, [*lo.tolist(), len(b)]))
                removed.append(int((hi - lo).sum()))
                runs.append(len(lo))
                kept.append(b)
            yield pa.RecordBatch.from_arrays(
                [t.column(t.schema.get_field_index("doc_id")), size, pa.array(removed, pa.int64()),
                 pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def dedup_substrings(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Find the repeated strings of all of `docs` and take them out."""
    spans = keep(spark, repeated_spans(spark, docs, length), "spans")
    release(spark)
    return remove_spans(docs, spans)
