"""Reversible line dedup: sharded cuckoo filters over exact reference counts (operator 10).

The index holds, in the shared folder,

* `refs/<generation>`: one signed row (+1 inserted, -1 deleted) for each
  line key and document -- the exact reference counts;
* `frequent/<generation>`: the keys that `min_docs` documents or more hold,
  with their count and the largest document;
* `filters/<generation>`: a cuckoo filter for each shard of the frequent
  keys. Fingerprints leave a filter when their key falls below `min_docs`,
  so documents can be taken out again.

`apply` asks the filters first, so that only references to lines that may be
frequent are shuffled to the exact table, which decides. Filters reach the
tasks only if they are within `FILTER_BYTES` together; beyond that all
references go to the exact table, with the same result.

A key is the line stripped of `[\\x20\\x09-\\x0D]`, A-Z lower-cased, as a
128-bit hash; keys below `min_chars` code points stay where they are. A
frequent key loses its lines everywhere but in the largest doc_id.

Defined results: null or empty text -> one empty line; a line twice in a
document counts that document once and loses both; rows that repeat an id
are one document; rows with a null id neither count nor lose lines; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._store import keep
from wardstat.llm._text import Words, id_text, map_slices, mix64, prefix_hash, span_hash
from wardstat.session import path_exists, scratch_dir

MIN_CHARS, MIN_DOCS = 40, 5
FILTER_BYTES = 32 << 20
KEYS_PER_SHARD = 50_000


class Cuckoo:
    """Cuckoo filter of 64-bit keys: 16-bit fingerprints, four to a bucket."""

    SLOTS, KICKS = 4, 500

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def build(cls, keys: np.ndarray) -> Cuckoo:
        size = 1 << max(1, int(np.ceil(len(keys) / (0.75 * cls.SLOTS))).bit_length())
        while True:
            f = cls(np.zeros((size, cls.SLOTS), np.uint16))
            if f.insert(keys):
                return f
            size *= 2

    @classmethod
    def load(cls, blob: bytes) -> Cuckoo:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray):
        h = mix64(keys.astype(np.int64).view(np.uint64))
        fp = (h >> np.uint64(48)).astype(np.uint16)
        fp[fp == 0] = 1
        i = (h & np.uint64(len(self.table) - 1)).astype(np.int64)
        return fp, i, self._other(i, fp)

    def _other(self, i, fp):
        x = mix64(np.asarray(fp).astype(np.uint64)) & np.uint64(len(self.table) - 1)
        return i ^ x.astype(np.int64)

    def insert(self, keys: np.ndarray) -> bool:
        """False if an item found no place (the filter is then too small)."""
        fp, i, j = self._places(keys)
        order = np.argsort(i, kind="stable")
        b = i[order]
        slot = np.arange(len(b)) - np.searchsorted(b, b)  # rank within the bucket
        free = slot < self.SLOTS
        free[free] &= self.table[b[free], slot[free]] == 0
        self.table[b[free], slot[free]] = fp[order[free]]
        rest = order[~free]
        return all(self._place_one(*x) for x in zip(fp[rest].tolist(), i[rest].tolist(), j[rest].tolist()))

    def _place_one(self, f: int, a: int, c: int) -> bool:
        for at in (a, c):
            hole = np.flatnonzero(self.table[at] == 0)
            if len(hole):
                self.table[at, hole[0]] = f
                return True
        at = c
        for k in range(self.KICKS):
            s = (k + f) % self.SLOTS
            f, self.table[at, s] = int(self.table[at, s]), f
            at = int(self._other(np.array([at]), np.array([f]))[0])
            hole = np.flatnonzero(self.table[at] == 0)
            if len(hole):
                self.table[at, hole[0]] = f
                return True
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were inserted before, one fingerprint each."""
        for f, a, c in zip(*(x.tolist() for x in self._places(keys))):
            for at in (a, c):
                hit = np.flatnonzero(self.table[at] == f)
                if len(hit):
                    self.table[at, hit[0]] = 0
                    break

    def contains(self, keys: np.ndarray) -> np.ndarray:
        fp, i, j = self._places(keys)
        return (self.table[i] == fp[:, None]).any(axis=1) | (self.table[j] == fp[:, None]).any(axis=1)


class _Lines:
    """Lines of a slice: row, byte range, code points and 128-bit key of the stripped line."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        rows = len(off) - 1
        nl = np.flatnonzero(buf == 10)
        # each row starts a line, each newline starts the next one
        begin = np.concatenate([off[:-1], nl + 1])
        row = np.concatenate([np.arange(rows), np.searchsorted(off, nl, "right") - 1])
        # by row, then by place (a newline may end its row: its next line is empty)
        order = np.lexsort((begin, row))
        self.begin, self.row = begin[order], row[order]
        self.end = np.empty_like(self.begin)
        self.end[:-1] = self.begin[1:] - 1
        last = np.searchsorted(self.row, np.arange(rows), "right") - 1
        self.end[last] = off[1:]
        self.first = np.searchsorted(self.row, np.arange(rows + 1))
        w = Words(buf, off, lower=True)
        a = np.searchsorted(w.start, self.begin)
        b = np.searchsorted(w.start, self.end) - 1
        self.some = a <= b
        s, e = w.start[a[self.some]], w.end[b[self.some]]
        points = np.zeros(len(buf) + 1, np.int32)
        np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
        n = len(self.begin)
        self.chars = np.zeros(n, np.int64)
        self.chars[self.some] = points[e] - points[s]
        self.k1, self.k2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.k1[self.some] = span_hash(prefix_hash(buf, True), s, e).view(np.int64)
        self.k2[self.some] = span_hash(prefix_hash(buf, True, second=True), s, e).view(np.int64)


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, k1, k2): the long keys of every document, each once."""
    def run(batch, buf, off):
        ln = _Lines(buf, off)
        ok = ln.chars >= min_chars
        key = np.unique(np.stack([ln.row[ok], ln.k1[ok], ln.k2[ok]], axis=1), axis=0)
        return {"doc_id": batch.column(0).take(pa.array(key[:, 0])), "k1": key[:, 1], "k2": key[:, 2]}

    return map_slices(docs.where("doc_id is not null"), run, "doc_id long, k1 long, k2 long")


class LineIndex:
    """Incremental index; every method leaves a complete new generation behind."""

    def __init__(self, spark: SparkSession, path: str | None = None, min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS, keys_per_shard: int = KEYS_PER_SHARD):
        self.spark, self.path = spark, path or scratch_dir(spark, "llm-lines")
        self.min_chars, self.min_docs, self.per_shard = min_chars, min_docs, keys_per_shard
        self.gen = 0
        while path_exists(spark, f"{self.path}/filters/{self.gen + 1}/_SUCCESS"):
            self.gen += 1

    def _read(self, kind: str, gens) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{kind}/{g}" for g in gens])

    def refs(self) -> DataFrame:
        """Live references (k1, k2, doc_id)."""
        return (self._read("refs", range(1, self.gen + 1)).groupBy("k1", "k2", "doc_id")
                .agg(F.sum("sign").alias("n")).where("n > 0").drop("n"))

    def frequent(self) -> DataFrame:
        return self._read("frequent", [self.gen])

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Add documents that the index does not hold yet."""
        keys = line_keys(id_text(docs, id_col, text_col), self.min_chars)
        self._advance(keys.withColumn("sign", F.lit(1)))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Take documents out again, whatever they were inserted with."""
        gone = ids.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
        held = self._read("refs", range(1, self.gen + 1)).join(gone, "doc_id", "left_semi")
        back = held.groupBy("k1", "k2", "doc_id").agg(F.sum("sign").alias("n")).where("n > 0")
        self._advance(back.select("doc_id", "k1", "k2", (-F.col("n")).cast("int").alias("sign")))

    def _advance(self, change: DataFrame) -> None:
        g = self.gen + 1
        change.write.mode("overwrite").parquet(f"{self.path}/refs/{g}")
        self.gen = g
        refs = self.refs()
        if g > 1:  # only keys that changed are counted anew
            touched = self._read("refs", [g]).select("k1", "k2").distinct()
            refs = refs.join(touched, ["k1", "k2"], "left_semi")
        now = (refs.groupBy("k1", "k2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keep_doc"))
               .where(F.col("n_docs") >= self.min_docs))
        if g > 1:
            old = self._read("frequent", [g - 1])
            now = now.unionAll(old.join(touched, ["k1", "k2"], "left_anti").select(now.columns))
        now.write.mode("overwrite").parquet(f"{self.path}/frequent/{g}")
        self._filters(g)

    def _filters(self, g: int) -> None:
        """New filters: built at first or when shards are added, else changed in place."""
        now = self._read("frequent", [g])
        old = self._read("filters", [g - 1]) if g > 1 else None
        had = old.agg(F.max("shards")).first()[0] or 0 if old is not None else 0
        shards = max(1, -(-now.count() // self.per_shard), had)
        out = f"{self.path}/filters/{g}"
        schema = "shard long, shards long, blob binary"

        def of(df):
            return df.withColumn("shard", F.pmod("k1", F.lit(shards)))

        def build(key, pdf):
            f = Cuckoo.build(np.unique(pdf["k1"].to_numpy(np.int64)))
            return pd.DataFrame({"shard": [key[0]], "shards": [shards], "blob": [f.dump()]})

        if had != shards:
            made = of(now.select("k1")).groupBy("shard").applyInPandas(build, schema)
        else:
            before = self._read("frequent", [g - 1]).select("k1").distinct()
            after = now.select("k1").distinct()
            delta = of(after.join(before, "k1", "left_anti").withColumn("sign", F.lit(1))
                       .unionAll(before.join(after, "k1", "left_anti").withColumn("sign", F.lit(-1))))

            def change(key, pdf, filters):
                f = Cuckoo.load(filters["blob"].iloc[0]) if len(filters) else Cuckoo.build(np.zeros(0, np.int64))
                f.delete(pdf.loc[pdf["sign"] < 0, "k1"].to_numpy(np.int64))
                full = not f.insert(pdf.loc[pdf["sign"] > 0, "k1"].to_numpy(np.int64))
                return pd.DataFrame({"shard": [key[0]], "shards": [-1 if full else shards], "blob": [f.dump()]})

            made = keep(self.spark, delta.groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(change, schema), "filters")
            if made.where("shards < 0").limit(1).count():  # a filter is full: build them all anew, larger
                made = of(now.select("k1")).groupBy("shard").applyInPandas(build, schema)
        made.write.mode("overwrite").parquet(out)

    def candidates(self) -> DataFrame:
        """Live references whose key the filters may hold."""
        refs = self._read("refs", range(1, self.gen + 1))
        filters = self._read("filters", [self.gen])
        size, shards = filters.agg(F.sum(F.length("blob")), F.max("shards")).first()
        if size is None:
            return self.refs().limit(0)
        if size <= FILTER_BYTES:
            blobs = self.spark.sparkContext.broadcast(
                {r["shard"]: bytes(r["blob"]) for r in filters.select("shard", "blob").toLocalIterator()})

            def probe(batches):
                loaded = {s: Cuckoo.load(b) for s, b in blobs.value.items()}
                for t in batches:
                    k = t.column(t.schema.get_field_index("k1")).to_numpy()
                    shard = np.mod(k, shards)
                    hit = np.zeros(len(k), bool)
                    for s in np.unique(shard):
                        if s in loaded:
                            at = shard == s
                            hit[at] = loaded[s].contains(k[at])
                    if hit.any():
                        yield t.filter(pa.array(hit))

            refs = refs.select("doc_id", "k1", "k2", "sign").mapInArrow(probe, "doc_id long, k1 long, k2 long, sign int")
        return refs.groupBy("k1", "k2", "doc_id").agg(F.sum("sign").alias("n")).where("n > 0").drop("n")

    def drops(self) -> DataFrame:
        """doc_id, keys (k1, k2 in turn) that the document loses."""
        hit = (self.candidates().join(self.frequent().select("k1", "k2", "keep_doc"), ["k1", "k2"])
               .where("doc_id <> keep_doc"))
        return hit.groupBy("doc_id").agg(F.flatten(F.collect_list(F.array("k1", "k2"))).alias("keys"))

    def apply(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, text (lines left), n_lines, n_dropped, row (the input row) -- one row per row of `docs`."""
        rows = (docs.select(F.struct(*[c for c in docs.columns if c != text_col]).alias("row"),
                            F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                .join(self.drops(), "doc_id", "left").select("doc_id", "text", "keys", "row"))
        min_chars = self.min_chars

        def run(batch, buf, off):
            keys = batch.column(2)
            n_lines = 1 + np.diff(np.searchsorted(np.flatnonzero(buf == 10), off))
            dropped = np.zeros(len(off) - 1, np.int64)
            texts = batch.column(1).fill_null("")
            todo = np.flatnonzero(keys.is_valid().to_numpy(zero_copy_only=False))
            if len(todo):
                texts = texts.to_pylist()
                for r in todo.tolist():
                    part = buf[off[r]:off[r + 1]]
                    ln = _Lines(part, np.array([0, len(part)]))
                    flat = keys[r].values.to_numpy()
                    gone = set(zip(flat[0::2].tolist(), flat[1::2].tolist()))
                    lose = [c >= min_chars and (x, y) in gone for c, x, y in
                            zip(ln.chars.tolist(), ln.k1.tolist(), ln.k2.tolist())]
                    dropped[r] = sum(lose)
                    raw = part.tobytes()
                    texts[r] = b"\n".join(raw[a:b] for a, b, x in zip(ln.begin.tolist(), ln.end.tolist(), lose) if not x).decode()
            return {"doc_id": batch.column(0), "text": texts, "n_lines": n_lines, "n_dropped": dropped, "row": batch.column(3)}

        kind = rows.schema["row"].dataType.simpleString()
        return map_slices(rows, run, f"doc_id long, text string, n_lines long, n_dropped long, row {kind}")


def dedup_lines(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Index all of `docs` and apply the index to them."""
    index = LineIndex(spark, min_chars=min_chars, min_docs=min_docs)
    index.insert(docs)
    return index.apply(docs)
