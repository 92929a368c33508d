"""Benchmark decontamination by latent semantic retrieval (operator 9).

1. Every text becomes a row of 16-bit word ids (A-Z lower-cased, ASCII
   punctuation stripped at both ends), written once to the shared folder.
2. Passage frequencies of the ids over all passages give the IDF weights.
3. Distributed randomised SVD of the TF-IDF passage matrix A: every task
   adds up A'(A O) for a Gaussian O, the sums meet in two levels, a QR step
   on the driver gives a basis Q (65,536 x RANK, a fixed size); a second
   pass adds up (A Q)'(A Q), whose eigenvectors and eigenvalues turn Q into
   right singular vectors and whitened coordinates.
4. Every half-overlapping passage of every text is compared by cosine with
   the benchmark queries (in blocks of `BLOCK` queries); passages above
   `COSINE` that share as many words as a leak must (`need`) are candidates.
5. A common subsequence is never longer than the number of words of the
   stretch that stand in the item. Where no stretch around the passage has
   `PARAPHRASE` of the item's length of them, the candidate goes: first by
   counts of half passages, for all items at once, then word by word.
6. A candidate is a leak if the longest common subsequence of the item and a
   stretch of 1.5 times its length around the passage covers `VERBATIM` of the item, or if it
   covers `PARAPHRASE` and the item's answer covers `ANSWER` of its words.
   The answer is the column `answer` if the benchmark has one, else the
   item's last quarter.

Defined results: null, empty or blank texts and items match nothing; null
ids of documents or items match nothing; repeated rows give the same match
once; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._store import keep
from wardstat.llm._text import Words, buffer_of, id_text, map_slices, span_hash

IDS = 1 << 16
RANK = 48
HALF = 16                 # passages are 2 * HALF words, half overlapping
QUERY_WORDS = 64          # longer items are searched in parts of this size
BLOCK = 2048
COSINE, SHARED = 0.2, 0.5
VERBATIM, PARAPHRASE, ANSWER = 0.9, 0.7, 0.5
TASK_BYTES = 32 << 20     # word ids that a task adds up
FAN = 64                  # partial sums that meet in one group
BLOCKS = 64               # row blocks in which partial sums travel

_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def word_ids(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-bit id of every word, and the first word of each row."""
    w = Words(buf, off, lower=True)
    mark = _PUNCT[buf]
    at = np.flatnonzero(mark[w.start] | mark[w.end - 1])  # few words have one; the others keep their hash
    if len(at):
        s, e = w.start[at], w.end[at]
        for _ in range(3):
            s += mark[s] & (e - s > 1)
            e -= mark[e - 1] & (e - s > 1)
        w.hash[at] = span_hash(w.prefix, s, e)
    return (w.hash >> np.uint64(48)).astype(np.uint16), w.first


def id_table(docs: DataFrame) -> DataFrame:
    def run(batch, buf, off):
        ids, first = word_ids(buf, off)
        return {"doc_id": batch.column(0), "ids": [ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]}

    return map_slices(docs.where("doc_id is not null"), run, "doc_id long, ids binary")


def passages(ids: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive pieces of `size` words of every row as a matrix (padded
    with word id 0), its mask of real words, and the row of each piece."""
    n = np.array([len(b) // 2 for b in ids], np.int64)
    flat = np.frombuffer(b"".join(ids), np.uint16)
    k = -(-n // size)
    row = np.repeat(np.arange(len(n)), k)
    j = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
    start = (np.cumsum(n) - n)[row] + j * size
    left = n[row] - j * size
    mask = np.arange(size) < left[:, None]
    at = np.minimum(start[:, None] + np.arange(size), max(len(flat) - 1, 0))
    m = flat[at] if len(flat) else np.zeros((0, size), np.uint16)
    return np.where(mask, m, 0).astype(np.uint16), mask, row


def _parts(batches, size: int, words: int = 1 << 16):
    """Passage matrices of about `words` words (whole texts) from the id table."""
    for t in batches:
        ids = t.column(t.schema.get_field_index("ids")).to_pylist()
        lo, n = 0, 0
        for i, b in enumerate(ids):
            n += len(b) // 2
            if n >= words or i == len(ids) - 1:
                yield t, lo, ids, *passages(ids[lo:i + 1], size)
                lo, n = i + 1, 0


def _add_up(parts: DataFrame, tasks: int) -> DataFrame:
    """Sum the float32 vectors of all tasks by block, FAN of them at a time,
    so that no group grows with the input."""
    def add(key, pdf):
        total = np.zeros(len(pdf["v"].iloc[0]) // 4)
        for b in pdf["v"]:
            total += np.frombuffer(b, np.float32)
        return pd.DataFrame({"block": [key[0]], "salt": [key[1]], "v": [total.astype(np.float32).tobytes()]})

    while tasks > 1:
        parts = (parts.withColumn("salt", F.floor(F.col("salt") / FAN).cast("int")).groupBy("block", "salt")
                 .applyInPandas(add, "block int, salt int, v binary"))
        tasks = -(-tasks // FAN)
    return parts.select("block", "v")


def _few(table: DataFrame) -> tuple[DataFrame, int]:
    """The ids in tasks of about TASK_BYTES: what a task adds up has a fixed
    size, so small tasks would send more than they read."""
    size = table.agg(F.sum(F.length("ids"))).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES))
    return table.select("ids").coalesce(tasks), tasks


def _sums(table: DataFrame, step, width: int) -> np.ndarray:
    """(IDS, width) sums of what `step` adds to an accumulator in every task."""
    def run(batches):
        from pyspark import TaskContext
        acc = np.zeros((IDS, width), np.float64 if width == 1 else np.float32)
        for _, _, _, m, mask, _ in _parts(batches, 2 * HALF):
            step(acc, m, mask)
        salt = TaskContext.get().partitionId()
        rows = IDS // BLOCKS
        for b in range(BLOCKS):
            v = acc[b * rows:(b + 1) * rows].astype(np.float32)
            if v.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([salt], pa.int32()), pa.array([v.tobytes()])], ["block", "salt", "v"])

    few, tasks = _few(table)
    out = np.zeros((BLOCKS, IDS // BLOCKS * width))
    for r in _add_up(few.mapInArrow(run, "block int, salt int, v binary"), tasks).toLocalIterator():
        out[r["block"]] = np.frombuffer(r["v"], np.float32)  # BLOCKS rows, a fixed size
    return out.reshape(IDS, width)


def frequencies(table: DataFrame) -> tuple[np.ndarray, int]:
    """Number of passages that hold each id, over all passages; number of passages."""
    def step(acc, m, mask):
        s = np.sort(np.where(mask, m.astype(np.int32), IDS), axis=1)
        new = np.ones(s.shape, bool)
        new[:, 1:] = s[:, 1:] != s[:, :-1]
        acc[:, 0] += np.bincount(s[new], minlength=IDS + 1)[:IDS]

    df = _sums(table, step, 1)[:, 0]
    n = table.agg(F.sum(F.ceil(F.length("ids") / (4 * HALF)))).first()[0]
    return df, int(n or 0)


def latent_space(table: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 3) -> np.ndarray:
    """Word vectors (IDS, rank): IDF times right singular vectors over singular values."""
    rng = np.random.default_rng(seed)
    omega = (rng.normal(size=(IDS, rank)) * idf[:, None]).astype(np.float32)
    sc = table.sparkSession.sparkContext
    w0, weight = sc.broadcast(omega), sc.broadcast(idf.astype(np.float32))

    def range_step(acc, m, mask):
        y = _embed(m, mask, w0.value)
        f = m[mask]
        p = np.nonzero(mask)[0]
        order = np.argsort(f, kind="stable")
        f = f[order]
        cut = np.flatnonzero(np.r_[True, f[1:] != f[:-1]]) if len(f) else np.zeros(0, np.int64)
        if len(cut):
            acc[f[cut]] += _sum_runs(y, p[order], cut) * weight.value[f[cut], None]

    q, _ = np.linalg.qr(_sums(table, range_step, rank))
    words = (q * idf[:, None]).astype(np.float32)
    w1 = sc.broadcast(words)

    def gram(batches):
        from pyspark import TaskContext
        g = np.zeros((rank, rank))
        for _, _, _, m, mask, _ in _parts(batches, 2 * HALF):
            y = _embed(m, mask, w1.value)
            g += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()),
                                          pa.array([g.astype(np.float32).tobytes()])], ["block", "salt", "v"])

    few, tasks = _few(table)
    got = _add_up(few.mapInArrow(gram, "block int, salt int, v binary"), tasks).collect()  # one row
    g = np.frombuffer(got[0]["v"], np.float32).reshape(rank, rank).astype(np.float64) if got else np.eye(rank)
    value, vector = np.linalg.eigh(g)
    value, vector = value[::-1], vector[:, ::-1]
    sigma = np.sqrt(np.maximum(value, 1e-9 * max(value[0], 1e-9)))
    return (words @ (vector / sigma)).astype(np.float32)


def _embed(m: np.ndarray, mask: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Sum of the word vectors of each passage."""
    y = np.zeros((len(m), words.shape[1]), np.float32)
    for j in range(m.shape[1]):  # column by column: no three-dimensional copy
        x = words.take(m[:, j], 0)
        x[np.flatnonzero(~mask[:, j])] = 0
        y += x
    return y


def _sum_runs(y: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows y[at[first[i]:first[i+1]]]: the k-th rows of all runs at
    once while many runs have one, the few long ones each for itself."""
    n, out, k = np.diff(np.append(first, len(at))), y.take(at[first], 0), 1
    live = np.flatnonzero(n > 1)
    while len(live) > 256:
        out[live] += y.take(at[first[live] + k], 0)
        k += 1
        live = live[n[live] > k]
    for i in live.tolist():
        out[i] += y.take(at[first[i] + k:first[i] + n[i]], 0).sum(axis=0)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def places(a: list[int]) -> dict[int, int]:
    """Where each word of `a` stands, as bits."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def lcs(a: list[int], b: list[int], masks: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence, bit-parallel over `a` (`masks`: its places)."""
    masks = places(a) if masks is None else masks
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        if y in masks:
            u = v & masks[y]
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def need(part: np.ndarray, words: int, parts: int) -> int:
    """Distinct words of a query that some passage holds wherever the verdict
    accepts a stretch: PARAPHRASE of the item's words over the passages that
    cover the stretch and the item's `parts` queries, less repeats. Never more
    than `SHARED` of them."""
    size = words + words // 2 + 2
    # a passage starts at most HALF - 1 words before the stretch; each further one or part adds a piece
    pieces = -(-(size + HALF - 1) // (2 * HALF)) + parts - 1
    left = -(-int(np.ceil(PARAPHRASE * words - 1e-9)) // pieces)
    count = np.sort(np.unique(part, return_counts=True)[1])[::-1]
    distinct = int(np.searchsorted(np.cumsum(count), left)) + 1
    return max(1, min(distinct, int(np.ceil(SHARED * min(len(count), 2 * HALF)))))


class Items:
    """Benchmark items of one block: ids of words, queries, answers."""

    def __init__(self, item_ids, words: list[np.ndarray], answers: list[np.ndarray | None]):
        self.item_ids, self.words, self.answers = item_ids, [w.tolist() for w in words], []
        self.query_item, parts = [], []
        for i, w in enumerate(words):
            a = answers[i]
            self.answers.append((a if a is not None and len(a) else w[-max(1, len(w) // 4):]).tolist())
            n = max(1, -(-len(w) // QUERY_WORDS))
            for p in np.array_split(w, n):
                self.query_item.append(i)
                parts.append(p)
        self.query_item = np.array(self.query_item)
        self.places = [(places(w), places(a)) for w, a in zip(self.words, self.answers)]
        self.parts = parts
        #: words that a passage must share, by query
        self.need = np.array([need(p, len(words[i]), int(n)) for p, i, n in
                              zip(parts, self.query_item, np.bincount(self.query_item, minlength=1)[self.query_item])])
        self.holds = np.zeros((IDS,), np.int32)  # id -> dense row of `held`, 0: in no query
        used = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        self.holds[used] = np.arange(1, len(used) + 1)
        self.held = np.zeros((len(used) + 1, len(words)), np.uint8)  # words of each item
        for q, p in enumerate(parts):
            self.held[self.holds[p], self.query_item[q]] = 1
        size = np.array([len(w) for w in words], np.int64)
        #: length of the stretches of an item, and words of one that must stand in the item
        self.stretch = size + size // 2 + 2
        self.least = np.ceil(PARAPHRASE * size - 1e-9).astype(np.int64)

    def counts(self, dense: np.ndarray) -> np.ndarray:
        """Words of every item in each half passage (rows of `held`)."""
        out = np.empty((len(dense), len(self.words)), np.int16)
        for k in range(0, len(self.words), 256):
            part = np.ascontiguousarray(self.held[:, k:k + 256])
            out[:, k:k + 256] = part[dense.ravel()].reshape(*dense.shape, -1).sum(axis=1, dtype=np.uint8)
        return out

    def within_reach(self, count: np.ndarray, row: np.ndarray) -> np.ndarray:
        """(half passage, item): some stretch around it has half passages with
        enough of the item's words. `row`: the text of each half passage."""
        start, end = np.searchsorted(row, row, "left"), np.searchsorted(row, row, "right")
        at = np.arange(len(row))
        out = np.empty(count.shape, bool)
        size = np.array([len(w) for w in self.words])
        halves = -(-(size + size // 2 + 1) // HALF) + 1  # that a stretch can touch
        reach = -(-2 * size // HALF) + 1
        # sums that wrap around still give the differences, which are smaller
        kind = np.uint16 if size.max(initial=0) < 1 << 14 else np.uint32
        total = np.zeros((len(count) + 1, len(self.words)), kind)
        np.cumsum(count, axis=0, dtype=kind, out=total[1:])
        for h, r in sorted(set(zip(halves.tolist(), reach.tolist()))):  # items of like length at once
            i = np.flatnonzero((halves == h) & (reach == r))
            mine = np.ascontiguousarray(total[:, i])
            sums = mine[np.minimum(at + h, end)] - mine[:-1]
            good = np.zeros((len(row) + 1, len(i)), kind)
            np.cumsum(sums >= self.least[i].astype(kind), axis=0, dtype=kind, out=good[1:])
            out[:, i] = good[np.minimum(at + r + 2, end)] != good[np.maximum(at - r, start)]
        return out

    def word_by_word(self, dense: np.ndarray, row: np.ndarray, p: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Which candidates (half passage p, item i) have a stretch of the
        text around them with enough of the item's words."""
        flat, out = dense.ravel(), np.zeros(len(p), bool)
        first, last = np.searchsorted(row, row, "left") * HALF, np.searchsorted(row, row, "right") * HALF
        for item in np.unique(i).tolist():
            mine = np.flatnonzero(i == item)
            reach, size = 2 * len(self.words[item]), int(self.stretch[item])
            held = np.append(self.held[:, item], 0).astype(np.int32)
            for k in range(0, len(mine), 4096):
                m = mine[k:k + 4096]
                at = (p[m] * HALF - reach)[:, None] + np.arange(2 * reach + 2 * HALF)
                inside = (at >= first[p[m], None]) & (at < last[p[m], None])
                word = np.where(inside, flat[np.clip(at, 0, len(flat) - 1)], -1)
                total = np.zeros((len(m), at.shape[1] + 1), np.int32)
                np.cumsum(held[word], axis=1, out=total[:, 1:])
                size_here = min(size, at.shape[1])
                out[m] = ((total[:, size_here:] - total[:, :-size_here]) >= self.least[item]).any(axis=1)
        return out

    def verdict(self, i: int, region: np.ndarray) -> tuple[float, float] | None:
        """The best (lcs, answer) of half as long again as the item anywhere in
        the region, if it makes a leak: a longer stretch would hold much of a
        short item by chance."""
        w, best = self.words[i], None
        size = int(self.stretch[i])
        held = np.concatenate([[0], np.cumsum(self.held[self.holds[region], i], dtype=np.int64)])
        starts = np.arange(0, max(1, len(region) - size + 1 + len(w) // 4), max(1, len(w) // 4))
        starts = np.minimum(starts, len(region))
        enough = held[np.minimum(starts + size, len(region))] - held[starts] >= self.least[i]
        for a in starts[enough].tolist():
            part = region[a:a + size].tolist()
            full = lcs(w, part, self.places[i][0]) / len(w)
            if full >= PARAPHRASE:
                answer = lcs(self.answers[i], part, self.places[i][1]) / len(self.answers[i])
                if (full >= VERBATIM or answer >= ANSWER) and (best is None or (full, answer) > best):
                    best = full, answer
        return best


def _search(table: DataFrame, words: np.ndarray, items: Items) -> DataFrame:
    """Matches of one block of items with all passages."""
    sc = table.sparkSession.sparkContext
    space, held = sc.broadcast(words), sc.broadcast(items)

    def run(batches):
        it, vec = held.value, space.value
        queries = _unit(np.stack([vec[p].sum(axis=0) for p in it.parts])).T.astype(np.float32)
        for t, lo, ids, m, mask, row in _parts(batches, HALF):
            if not len(m):
                continue
            half = _embed(m, mask, vec)
            # passage i: halves i and i+1 if both belong to one text
            pair = np.zeros(len(m), bool)
            pair[:-1] = row[:-1] == row[1:]
            whole = half.copy()
            whole[:-1][pair[:-1]] += half[1:][pair[:-1]]
            whole = _unit(whole)
            dense = it.holds[m] * mask
            count = it.counts(dense)
            both = count.copy()  # words of the whole passage that stand in the item
            both[:-1][pair[:-1]] += count[1:][pair[:-1]]
            may = it.within_reach(count, row).take(it.query_item, 1) & (both.take(it.query_item, 1) >= it.need.astype(np.int16))
            hit_p, hit_q = np.nonzero((whole @ queries >= COSINE) & may)
            words = np.zeros((len(m), 2 * HALF), np.int32)
            words[:, :HALF] = dense
            words[:-1, HALF:][pair[:-1]] = dense[1:][pair[:-1]]
            words.sort(axis=1)
            words[:, 1:][words[:, 1:] == words[:, :-1]] = 0  # each word of the passage once
            ok = np.zeros(len(hit_p), bool)
            for a in range(0, len(hit_p), 1 << 15):
                p, q = hit_p[a:a + (1 << 15)], hit_q[a:a + (1 << 15)]
                ok[a:a + (1 << 15)] = it.held[words[p], it.query_item[q, None]].sum(axis=1, dtype=np.uint8) >= it.need[q]
            ok[ok] = it.word_by_word(dense, row, hit_p[ok], it.query_item[hit_q[ok]])
            if not ok.any():
                continue
            cos = np.einsum("ij,ij->i", whole[hit_p[ok]], queries[:, hit_q[ok]].T)
            first = np.searchsorted(row, row, "left")
            found: dict = {}
            done: set = set()
            for p, q, c in zip(hit_p[ok].tolist(), hit_q[ok].tolist(), cos.tolist()):
                i = int(it.query_item[q])
                r = int(row[p])
                text = np.frombuffer(ids[lo + r], np.uint16)
                at = (p - int(first[p])) * HALF
                reach = 2 * len(it.words[i])
                a, b = max(0, at - reach), min(len(text), at + 2 * HALF + reach)
                if (r, i, a) in done:
                    continue
                done.add((r, i, a))
                v = it.verdict(i, text[a:b])
                if v and v > found.get((r, i), ((-1.0, -1.0), 0))[0]:
                    found[r, i] = (v, c)
            if found:
                doc = t.column(t.schema.get_field_index("doc_id"))
                yield pa.RecordBatch.from_arrays(
                    [doc.take(pa.array([lo + r for r, _ in found])),
                     pa.array([it.item_ids[i] for _, i in found], pa.int64()),
                     pa.array([x[1] for x in found.values()], pa.float64()),
                     pa.array([x[0][0] for x in found.values()], pa.float64()),
                     pa.array([x[0][1] for x in found.values()], pa.float64())],
                    ["doc_id", "item_id", "cosine", "lcs", "answer"])

    return table.mapInArrow(run, "doc_id long, item_id long, cosine double, lcs double, answer double")


def benchmark_items(bench: DataFrame, id_col: str = "item_id", text_col: str = "text",
                    answer_col: str = "answer") -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """The stated query set: (id, word ids, word ids of the answer) of every item with a word, one after another."""
    cols = [F.col(id_col).cast("long"), F.col(text_col).cast("string")]
    cols.append(F.col(answer_col).cast("string") if answer_col in bench.columns else F.lit(None).cast("string"))
    rows = bench.select(*[c.alias(n) for c, n in zip(cols, ("id", "text", "answer"))]).where("id is not null").distinct()
    for i, text, answer in rows.orderBy("id", "text", "answer").toLocalIterator():
        words, ans = (word_ids(*buffer_of(pa.array([x], pa.string())))[0] for x in (text, answer))
        if len(words):
            yield i, words, ans if len(ans) else None


def find_leaks(spark: SparkSession, docs: DataFrame, bench: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", rank: int = RANK) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer): every document that holds an item, or a paraphrase of it."""
    table = keep(spark, id_table(id_text(docs, id_col, text_col)), "word-ids")
    df, n = frequencies(table)
    idf = np.log((1 + n) / (1 + df))
    words = latent_space(table, idf, rank)
    items, out = benchmark_items(bench), None
    while part := list(islice(items, BLOCK)):  # the driver holds one block
        got = _search(table, words, Items(*map(list, zip(*part))))
        if out is not None or len(part) == BLOCK:
            got = keep(spark, got, "leaks")
        out = got if out is None else out.unionAll(got)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, lcs double, answer double")
    return out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("cosine", "lcs", "answer")])
