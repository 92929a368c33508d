"""Language ID with a byte convolutional network (operator 5).

Windows of `WINDOW` bytes go through filters of widths 2, 3 and 4 on one-hot
bytes, max pooling over the window, a rectifier and a softmax layer. The
network is trained in numpy on the driver from a bounded sample of labelled
rows (`PER_LANG` documents of each language, `PER_DOC` windows of each).

Every text is cut into consecutive windows from its first to its last byte;
the window logits are averaged by their bytes. A filter on one-hot bytes is
a table lookup, so tasks look up pairs of bytes in tables of 65,536 rows and
add: no multiplication runs over the text.

Defined results: text null or without a letter -> `und`, score 0; no
labelled row at all -> `und` for every document; null or blank lang is not
learned from; null ids are predicted but not learned from; repeated rows
give a row each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._text import buffer_of, map_slices, slices

WINDOW, WIDTHS, FILTERS = 128, (2, 3, 4), 16
PER_LANG, PER_DOC, MAX_LANGS = 300, 6, 1000
STEPS, BATCH, RATE = 220, 192, 0.01
UNKNOWN = "und"


def cut(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive zero-padded windows of every row: bytes, row, length."""
    size = np.diff(off)
    n = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = off[:-1][row] + k * WINDOW
    length = np.minimum(WINDOW, off[1:][row] - start)
    at = start[:, None] + np.arange(WINDOW)
    pad = np.arange(WINDOW) >= length[:, None]
    w = buf[np.minimum(at, len(buf) - 1)] if len(buf) else np.zeros((0, WINDOW), np.uint8)
    w[pad] = 0
    return w, row, length


class ByteCNN:
    def __init__(self, labels: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        d = FILTERS * len(WIDTHS)
        self.out = rng.normal(0, 0.2, (d, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def pool(self, w: np.ndarray):
        """Largest activation of each filter over the window, and where."""
        act, arg = [], []
        for width, t in zip(WIDTHS, self.tables):
            m = w.shape[1] - width + 1
            a = t[0][w[:, :m]]
            for j in range(1, width):
                a = a + t[j][w[:, j:j + m]]
            k = a.argmax(axis=1)
            arg.append(k)
            act.append(np.take_along_axis(a, k[:, None], 1)[:, 0])
        return np.concatenate(act, 1), arg

    def fit(self, w: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 5) -> ByteCNN:
        """Adam on the cross-entropy; a filter learns at its largest position only."""
        rng = np.random.default_rng(seed)
        params = [*self.tables, self.out, self.bias]
        m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        share = 1 / np.maximum(1, np.bincount(y, minlength=len(self.labels)))
        p_row = share[y] / share[y].sum()
        for step in range(1, steps + 1):
            pick = rng.choice(len(y), min(BATCH, len(y)), p=p_row)
            x, t = w[pick], y[pick]
            z, arg = self.pool(x)
            h = np.maximum(z, 0)
            logit = h @ self.out + self.bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(t)), t] -= 1
            p /= len(t)
            grads = []
            dz = (p @ self.out.T) * (z > 0)
            rows, cols = np.arange(len(t))[:, None], np.broadcast_to(np.arange(FILTERS), (len(t), FILTERS))
            for i, (width, table) in enumerate(zip(WIDTHS, self.tables)):
                g = np.zeros_like(table)
                dk = dz[:, i * FILTERS:(i + 1) * FILTERS]
                for j in range(width):
                    np.add.at(g[j], (x[rows, arg[i] + j], cols), dk)
                grads.append(g)
            grads += [h.T @ p + 1e-4 * self.out, p.sum(0)]
            for q, g, a, b in zip(params, grads, m1, m2):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                q -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
        return self

    def pair_tables(self):
        """Tables over byte pairs: (2: ab), (3: ab, c), (4: ab, cd)."""
        t2, t3, t4 = self.tables
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, FILTERS)
        return pair(t2[0], t2[1]), pair(t3[0], t3[1]), t3[2], pair(t4[0], t4[1]), pair(t4[2], t4[3])

    def logits(self, w: np.ndarray, tables, part: int = 256) -> np.ndarray:
        ab2, ab3, c3, ab4, cd4 = tables
        out = np.empty((len(w), len(self.labels)), np.float32)
        for i in range(0, len(w), part):
            x = w[i:i + part]
            p = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
            acts = [_top(ab2.take(p, 0)),
                    _top(ab3.take(p[:, :-1], 0) + c3.take(x[:, 2:], 0)),
                    _top(ab4.take(p[:, :-2], 0) + cd4.take(p[:, 2:], 0))]
            out[i:i + part] = np.maximum(np.concatenate(acts, 1), 0) @ self.out + self.bias
        return out


def _top(a: np.ndarray) -> np.ndarray:
    """Maximum over axis 1 by halves (contiguous, so vectorised)."""
    n = a.shape[1]
    while n > 1:
        h = (n + 1) // 2
        a = np.maximum(a[:, :h], a[:, n - h:n])
        n = h
    return a[:, 0]


def training_rows(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """About `per_lang` documents of each language: an even hash sample, every
    language whole if it has fewer. `docs` has doc_id, text, lang."""
    d = docs.where("lang is not null and trim(lang) <> '' and doc_id is not null").where(F.col("text").rlike(r"\p{L}"))
    sizes = d.groupBy("lang").count()
    share = F.least(F.lit(1.0), F.lit(1.2 * per_lang) / F.col("count"))
    return (d.join(F.broadcast(sizes.limit(MAX_LANGS + 1)), "lang")
            .where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 24)) < share * (1 << 24)))


def learn(labelled: DataFrame, per_lang: int = PER_LANG, per_doc: int = PER_DOC) -> ByteCNN | None:
    """Train on windows drawn from the whole texts of the sampled rows.

    At most 1.2 * per_lang * per_doc windows of WINDOW bytes per language
    come to the driver; more than MAX_LANGS languages are refused.
    """
    def windows(batches):
        for t in batches:
            buf, off = buffer_of(t.column(2))
            keep_w, keep_l = [], []
            for i, j in slices(off):
                w, row, _ = cut(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                first = np.searchsorted(row, np.arange(j - i + 1))
                for r in range(j - i):
                    n = first[r + 1] - first[r]
                    for k in range(min(n, per_doc)):  # spread over the text
                        keep_w.append(w[first[r] + k * n // min(n, per_doc)].tobytes())
                        keep_l.append(t.column(1)[i + r].as_py())
            yield pa.RecordBatch.from_arrays([t_ for t_ in (pa.array(keep_l, pa.string()), pa.array(keep_w, pa.binary()))], ["lang", "w"])

    rows = training_rows(labelled, per_lang).select("doc_id", "lang", "text")
    got = rows.mapInArrow(windows, "lang string, w binary").toArrow()
    if got.num_rows == 0:
        return None
    lang = np.array(got.column(0).to_pylist())
    w = np.frombuffer(b"".join(got.column(1).to_pylist()), np.uint8).reshape(-1, WINDOW)
    # an order of its own, by all bytes: rows arrive as partitions finish
    order = np.lexsort([*w.T[::-1], lang])
    lang, w = lang[order], w[order]
    labels, y = np.unique(lang, return_inverse=True)
    if len(labels) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    return ByteCNN([str(x) for x in labels]).fit(w, y)


def predict(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id", text_col: str = "text",
            carry: bool = False) -> DataFrame:
    """doc_id, lang_pred, score -- one row per row of `docs`; with `carry`
    also row, a struct of all columns of the input row."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []))
    if model is None:
        return d.drop("text").withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    d = d.withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    cache: list = []

    def run(batch, buf, off):
        if not cache:
            cache.append(model.pair_tables())
        rows = len(off) - 1
        w, row, length = cut(buf, off)
        weight = np.zeros((rows, len(model.labels)))
        if len(w):
            z = model.logits(w, cache[0]).astype(np.float64) * length[:, None]
            has = np.unique(row)
            weight[has] = np.add.reduceat(z, np.searchsorted(row, has), axis=0) / np.diff(off)[has, None]
        p = np.exp(weight - weight.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        ok = batch.column(batch.schema.get_field_index("letters")).to_numpy(zero_copy_only=False).astype(bool)
        names = np.array(model.labels, object)[best]
        names[~ok] = UNKNOWN
        return {"doc_id": batch.column(0), "lang_pred": names.tolist(),
                "score": np.where(ok, p[np.arange(rows), best], 0.0),
                **({"row": batch.column(2)} if carry else {})}

    schema = "doc_id long, lang_pred string, score double"
    if carry:
        schema += f", row {d.schema['row'].dataType.simpleString()}"
    return map_slices(d, run, schema, size=1 << 19)


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2: never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled rows that are not held out, predict every row."""
    model = learn(_labelled(docs, id_col, text_col, lang_col))
    return predict(docs, model, id_col, text_col).withColumn("held_out", held_out("doc_id"))


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.where(~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"))


def recognised(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """The rows of `docs`, unchanged, whose language is told better than by chance.

    Decided row by row in the pass that predicts, without a join: of two rows
    of one id only the one that is rejected goes. Rejected are texts that are
    null or have no letter, and, with several learned languages, texts whose
    best language is no likelier than one among that many. Without any label
    no language is known and no row is left.
    """
    model = learn(_labelled(docs, id_col, text_col, lang_col))
    keep = F.col("lang_pred") != UNKNOWN
    if model is not None and len(model.labels) > 1:
        keep = keep & (F.col("score") * len(model.labels) > 1 + 1e-6)
    rows = predict(docs, model, id_col, text_col, carry=True).where(keep)
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
