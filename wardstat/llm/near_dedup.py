"""MinHash near-dedup with SuperMinHash signatures (operator 4).

Per document: distinct n-word shingles, hashed. SuperMinHash gives every
element one random rank per position of a random permutation, so the values
of a signature are correlated ranks of a lower variance than independent
minima, and a document stops as soon as no later rank can win a position.
Signatures are cut into bands; documents that share a band are candidates,
confirmed on their full shingle sets; confirmed links are grouped by
connected components.

Copies with the same shingle set are folded into one representative first.
In a band every member is compared with one leader; members that stay in
another component than their leader are compared with the whole band too, in
blocks, so that no link inside a band is lost, whatever its size.

Defined results: text null, empty or blank -> empty set, linked with
nothing; fewer words than a shingle -> the whole sequence is the only
shingle; rows that repeat an id are one document per row with that id's
component (sets of all its rows count); a null id gets a null component and
is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._graph import components
from wardstat.llm._store import keep
from wardstat.llm._text import Words, grams, id_text, list_array, map_slices, mix64

BANDS, ROWS = 25, 4
BLOCK = 1 << 14
BAND_BLOCK = 4096


def superminhash(elements: np.ndarray, m: int) -> np.ndarray:
    """Signature of m values (round << 32 | rank) of a set of 64-bit hashes."""
    h = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(elements), BLOCK):
        _fold(elements[i:i + BLOCK], h)
    return h


def _fold(x: np.ndarray, h: np.ndarray) -> None:
    m, n = len(h), len(x)
    perm, at = None, np.arange(n)
    for j in range(m):
        r = mix64(x + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        k = (j + (((r & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32))).astype(np.int64)
        if j == 0:
            pos = k
        else:
            if perm is None:  # the swap of round 0
                perm = np.tile(np.arange(m, dtype=np.uint16), (n, 1))
                perm[at, k0] = 0
                perm[:, 0] = k0
            pos = perm[at, k].astype(np.int64)
            perm[at, k] = perm[:, j]
            perm[:, j] = pos
        np.minimum.at(h, pos, (r >> np.uint64(32)) | np.uint64(j << 32))
        k0 = k
        if int(h.max()) < (j + 1) << 32:  # later rounds give larger values only
            break


def signature_table(docs: DataFrame, n: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_hash, sig (one byte of each value), bands (keys)."""
    m = bands * rows
    seed = mix64(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batch, buf, off):
        w = Words(buf, off, lower=True)
        at, g = grams(w, n, short=True)
        cut = np.searchsorted(w.row[at], np.arange(w.rows + 1))
        count, total, sig, keys = [], [], [], []
        for r in range(w.rows):
            u = np.unique(g[cut[r]:cut[r + 1]])
            count.append(len(u))
            total.append(int(mix64(u).sum(dtype=np.uint64).astype(np.int64)) if len(u) else 0)
            if len(u):
                h = superminhash(u, m)
                k = h.reshape(bands, rows)
                acc = seed.copy()
                for c in range(rows):
                    acc = mix64(acc * np.uint64(0x2545F4914F6CDD1D) + k[:, c])
                keys.append(acc.view(np.int64))
                sig.append((mix64(h) & np.uint64(255)).astype(np.uint8).tobytes())
            else:
                keys.append(np.zeros(0, np.int64))
                sig.append(b"")
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        return {"doc_id": batch.column(0), "n_shingles": count, "set_hash": total, "sig": sig,
                "bands": list_array(flat, np.array([len(k) for k in keys], np.int64))}

    return map_slices(docs, run, "doc_id long, n_shingles long, set_hash long, sig binary, bands array<long>")


def shingle_sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, shingles (distinct hashes)."""
    def run(batch, buf, off):
        w = Words(buf, off, lower=True)
        at, g = grams(w, n, short=True)
        cut = np.searchsorted(w.row[at], np.arange(w.rows + 1))
        sets = [np.unique(g[cut[r]:cut[r + 1]]).view(np.int64) for r in range(w.rows)]
        return {"doc_id": batch.column(0),
                "shingles": list_array(np.concatenate(sets), np.array([len(s) for s in sets], np.int64))}

    return map_slices(docs, run, "doc_id long, shingles array<long>")


def _likely(pairs: DataFrame, bar: int) -> DataFrame:
    """Pairs (a, b) whose signatures agree in `bar` positions or more."""
    def run(batches):
        for t in batches:
            if t.num_rows:
                x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8).reshape(t.num_rows, -1)
                        for c in (2, 3))
                ok = (x == y).sum(axis=1) >= bar
                if ok.any():
                    yield pa.RecordBatch.from_arrays([t.column(0).filter(pa.array(ok)), t.column(1).filter(pa.array(ok))], ["a", "b"])

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of the full sets."""
    out = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
           .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (out.select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb") - both).alias("o"))
            .where(F.lit(100) * F.col("i") >= F.lit(percent) * F.col("o")).select("a", "b").distinct())


def _meet_apart(named: DataFrame, sigs: DataFrame, sets: DataFrame, bar: int, percent: int) -> DataFrame:
    """Links between members that are apart from their band's leader and the
    rest of the band, compared in blocks of at most about BAND_BLOCK members
    by BAND_BLOCK apart ones. A pair is compared in the first band whose key
    it shares; a pair that a link found in the same block already joins is passed over.
    Only links leave a task.
    """
    n_apart = named.groupBy("key").agg(F.sum(F.col("apart").cast("int")).alias("k")).where("k > 0")
    full = (named.join(n_apart, "key")
            .withColumn("ny", F.ceil(F.col("n") / BAND_BLOCK)).withColumn("nx", F.ceil(F.col("k") / BAND_BLOCK)))
    at = lambda m: F.pmod(F.xxhash64("doc_id"), F.col(m))
    every = lambda m: F.sequence(F.lit(0).cast("long"), F.col(m) - 1)
    y = full.withColumn("y", at("ny")).withColumn("x", F.explode(every("nx"))).withColumn("asks", F.lit(False))
    x = full.where("apart").withColumn("x", at("nx")).withColumn("y", F.explode(every("ny"))).withColumn("asks", F.lit(True))
    cols = ["key", "x", "y", "band", "doc_id", "c", "apart", "asks"]
    both = (x.select(cols).unionAll(y.select(cols)).join(sigs, "doc_id").join(sets, "doc_id")
            .select(*cols, "sig", "bands", "shingles"))

    def meet(pdf):
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)
        band = int(pdf["band"].iloc[0])
        bands = np.stack(pdf["bands"].to_list())
        asks = pdf["asks"].to_numpy(bool)
        doc, c = pdf["doc_id"].to_numpy(np.int64), pdf["c"].to_numpy(np.int64).copy()
        other = np.flatnonzero(~asks)
        apart = pdf["apart"].to_numpy(bool)
        shingles, seen, out = pdf["shingles"].to_list(), {}, []

        def as_set(i):
            if i not in seen:
                seen[i] = set(shingles[i].tolist())
            return seen[i]

        for i in np.flatnonzero(asks):
            same = (sig[other] == sig[i])
            ok = (same.sum(axis=1) >= bar) & (c[other] != c[i]) & ~(apart[other] & (doc[other] >= doc[i]))
            hit = other[ok]
            if not len(hit):
                continue
            first = (bands[hit] == bands[i]).argmax(axis=1)
            hit, match = hit[first == band], same.sum(axis=1)[ok][first == band]
            for j in hit[np.argsort(-match, kind="stable")].tolist():
                if c[j] == c[i]:
                    continue
                p, q = as_set(i), as_set(j)
                both_n = len(p & q)
                if 100 * both_n >= percent * (len(p) + len(q) - both_n):
                    out.append((int(doc[i]), int(doc[j])))
                    lo, hi = min(c[i], c[j]), max(c[i], c[j])
                    c[c == hi] = lo
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return both.groupBy("key", "x", "y").applyInPandas(meet, "a long, b long").distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame, n: int = 5, percent: int = 80,
                    bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept -- one row per input row.

    At a similarity of 0.8, 25 bands of 4 rows miss a pair with a
    probability of 2e-6; a pair is skipped before the exact check only if
    its signatures agree in under 3/4 of the expected positions less one
    tenth (4.5 standard deviations).
    """
    d = id_text(docs, id_col, text_col)
    sig = keep(spark, signature_table(d, n, bands, rows), "signatures")
    bar = int(bands * rows * (percent / 100 - 0.18))

    real = sig.where("n_shingles > 0 and doc_id is not null")
    groups = real.groupBy("set_hash", "n_shingles").agg(F.min("doc_id").alias("rep"))
    copies = (real.join(groups, ["set_hash", "n_shingles"]).where("doc_id <> rep")
              .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct())
    reps = keep(spark, real.join(groups, ["set_hash", "n_shingles"]).where("doc_id = rep")
                .dropDuplicates(["set_hash", "n_shingles"]).select("doc_id", "sig", "bands"), "representatives")

    posts = reps.select(F.posexplode("bands").alias("band", "key"), "doc_id")
    sizes = posts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keep(spark, posts.join(sizes, "key"), "bands")
    # the leader of a band is the member that shares its bands with most others:
    # in a group of copies, one close to what they were copied from
    weight = shared.groupBy("doc_id").agg(F.sum("n").alias("w"))
    leaders = (shared.join(weight, "doc_id").groupBy("key")
               .agg(F.max(F.struct("w", -F.col("doc_id"))).alias("m")).select("key", (-F.col("m.col2")).alias("leader")))
    members = keep(spark, shared.join(leaders, "key"), "members")

    sigs = reps.select("doc_id", "sig")
    stars = members.where("doc_id <> leader").select(F.col("doc_id").alias("a"), F.col("leader").alias("b")).distinct()
    likely = _likely(stars.join(sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("x")), "a")
                     .join(sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("y")), "b"), bar)
    # the ids are hashed, so that the texts need no sort, at any size
    ids = members.select("doc_id").distinct().hint("shuffle_hash")
    sets = keep(spark, shingle_sets(d.join(ids, "doc_id", "left_semi"), n), "sets")
    links = keep(spark, _confirmed(likely, sets, percent), "links")

    comp = components(spark, links)
    label = comp.select(F.col("id").alias("doc_id"), "component")
    named = (members.join(label, "doc_id", "left").withColumn("c", F.coalesce("component", "doc_id"))
             .join(label.select(F.col("doc_id").alias("leader"), F.col("component").alias("lc")), "leader", "left")
             .withColumn("apart", F.col("c") != F.coalesce("lc", "leader")))
    # every member has met its leader; a band of two holds no other pair
    named = named.where("n > 2 and doc_id <> leader")
    named = keep(spark, named.select("key", "band", "n", "doc_id", "c", "apart"), "named")
    links2 = keep(spark, _meet_apart(named, reps, sets, bar, percent), "links")

    final = components(spark, links.unionAll(links2).unionAll(copies))
    return (sig.select("doc_id", "n_shingles").join(final.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                    F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept")))
