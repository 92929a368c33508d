"""Toxicity by weak supervision (operator 2).

1. A bounded hash sample of rows comes to the driver as sets of hashed
   features (words, their beginnings of 4 to 7 bytes): at most about
   `PER_CLASS` labelled rows of each class and `UNLABELLED` rows without a
   label that may be learned from.
2. Voters: lexicon voters are the features that a half of the labelled rows
   ties most to the toxic class; pattern voters look at shouting,
   exclamations and disguised words.
3. A generative label model (two classes, one Bernoulli rate per voter and
   class) is fitted by EM to the votes on all rows of the sample; a given
   label is one more voter, of accuracy `GOLD`. Voters that fire together
   beyond what the class explains share their weight: a voter's log ratio is
   divided by one plus its correlations (from `SHARED`) with the others.
4. A logistic classifier on the features is trained on the posterior labels.
   It scores every whole text: the sum of the weights of its distinct
   features.

Labels are learned only from rows whose crc32(doc_id) modulo 5 is not 0.
Defined results: a null or empty text scores as a text without features;
without a toxic label or without a clean one to learn from, every score is
the share of toxic labels (0 if there are none); null labels are ignored, a
row labelled twice counts as toxic if one label is; rows with a null id are
scored but not learned from; repeated rows give a row each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._text import Words, id_text, list_array, map_slices, mix64, prefix_hash, span_hash

DIMS = 1 << 20
PER_CLASS, UNLABELLED = 2000, 1500
BEGINNINGS = (4, 5, 6, 7)
VOTERS, MIN_SUPPORT = 200, 4
TELLING = 3.0             # z-score from which a feature enters the classifier
PATTERNS = ("shouting", "exclamations", "disguised", "insistent")
GOLD = 0.98               # trust in a given label
SHARED = 0.3              # correlation from which voters share their weight
MIN_GAIN = np.log(6.0)    # a lexicon voter is six times likelier in toxic texts
EPOCHS, RATE, RIDGE = 120, 0.05, 1e-4

_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every word and of its beginnings, not yet distinct."""
    w = Words(buf, off, lower=True)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, e = w.start.copy(), w.end.copy()
    for _ in range(3):
        s += _PUNCT[buf[s]] & (e - s > 1)
        e -= _PUNCT[buf[e - 1]] & (e - s > 1)
    p = prefix_hash(buf, True)
    rows, ids = [w.row], [span_hash(p, s, e)]
    for k in BEGINNINGS:
        long = e - s > k
        rows.append(w.row[long])
        ids.append(mix64(span_hash(p, s[long], s[long] + k) + np.uint64(k)))
    return np.concatenate(rows), (np.concatenate(ids) & np.uint64(DIMS - 1)).astype(np.int64)


def distinct(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((rows << 20) | ids)
    return key >> 20, key & (DIMS - 1)


def patterns(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Votes of the pattern voters, one bit each, in the order of PATTERNS."""
    def count(flag):
        c = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(flag, out=c[1:])
        return c[off[1:]] - c[off[:-1]]

    upper, letter = (buf >= 65) & (buf <= 90), _LETTER[buf]
    bang = (buf == 33)
    run = np.zeros(len(buf), bool)
    run[1:] = bang[1:] & bang[:-1]
    inner = np.zeros(len(buf), bool)  # a symbol or digit between two letters
    if len(buf) > 2:
        odd = np.isin(buf, np.frombuffer(b"*@$#0134", np.uint8))
        inner[1:-1] = odd[1:-1] & letter[:-2] & letter[2:]
    n = np.maximum(1, count(letter))
    votes = [10 * count(upper) > 3 * n, count(run) >= 3, count(inner) >= 2, 50 * count(bang) > n]
    return sum(v.astype(np.int64) << k for k, v in enumerate(votes))


def sample_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
                unlabelled: int = UNLABELLED) -> DataFrame:
    """doc_id, text, toxic (null: unlabelled) of the rows to learn from."""
    learnable = ~held_out("doc_id")
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where("doc_id is not null and toxic is not null").where(learnable)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two classes
    hashed = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 24))
    share = F.lit(0.0)
    for c in (0, 1):
        share = F.when(F.col("toxic") == c, min(1.0, per_class / max(1, n.get(c, 0)))).otherwise(share)
    picked = lab.where(hashed < share * (1 << 24))
    total = max(1, docs.count())
    d = docs.where("doc_id is not null")
    labelled = d.join(F.broadcast(picked), "doc_id")  # about 2 * per_class rows
    # labels are drawn apart, so the rest counts as unlabelled whatever its label is
    other = (d.where(learnable).where(F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 24)) < min(1.0, unlabelled / total) * (1 << 24))
             .join(F.broadcast(picked.select("doc_id")), "doc_id", "left_anti").withColumn("toxic", F.lit(None).cast("int")))
    return labelled.select("doc_id", "text", "toxic").unionAll(other.select("doc_id", "text", "toxic"))


class LabelModel:
    """Two classes, a rate for each voter and class, weights for correlated voters."""

    def __init__(self, votes: np.ndarray, known: np.ndarray, steps: int = 12):
        """votes: rows x voters of 0/1; known: 0, 1 or -1 (no label)."""
        gold = np.where(known == 1, GOLD, 1 - GOLD)
        labelled = known >= 0
        post, rows = gold, labelled
        for _ in range(steps):
            p, v = post[rows], votes[rows]
            self.rate1 = (p @ v + 0.2) / (p.sum() + 1)
            self.rate0 = ((1 - p) @ v + 0.2) / ((1 - p).sum() + 1)
            self.prior = float(np.clip(p.mean(), 0.01, 0.99))
            self.weight = self._weights(v, p)
            post = np.where(labelled, gold, self.posterior(votes))
            rows = np.ones(len(votes), bool)  # from now on the rows without a label too

    def _weights(self, v: np.ndarray, p: np.ndarray) -> np.ndarray:
        """1 / (1 + sum of positive correlations that the class leaves)."""
        r = v - p[:, None] * self.rate1 - (1 - p)[:, None] * self.rate0
        sd = np.sqrt((r * r).mean(0)) + 1e-3
        c = np.maximum(r.T @ r / len(r) / np.outer(sd, sd), 0)
        np.fill_diagonal(c, 0)
        c[c < SHARED] = 0
        return 1 / (1 + c.sum(1))

    def accuracy(self) -> np.ndarray:
        """Chance that a firing voter is right."""
        hit = self.prior * self.rate1
        return hit / (hit + (1 - self.prior) * self.rate0)

    def posterior(self, votes: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """Chance of the toxic class by the votes, and a given label as one more voter."""
        on = self.weight * np.log(self.rate1 / self.rate0)
        off = self.weight * np.log((1 - self.rate1) / (1 - self.rate0))
        z = np.log(self.prior / (1 - self.prior)) + votes @ on + (1 - votes) @ off
        if known is not None:
            z = z + np.where(known < 0, 0, np.where(known == 1, 1, -1) * np.log(GOLD / (1 - GOLD)))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Classifier:
    """Logistic weights of hashed features."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, n: int, target: np.ndarray):
        # features that differ between the classes by more than chance
        df = np.bincount(ids, minlength=DIMS)
        toxic = np.bincount(ids, target[rows], DIMS)
        expected = df * target.mean()
        z = (toxic - expected) / np.sqrt(np.maximum(expected * (1 - target.mean()), 1e-9))
        use = ((np.abs(z) >= TELLING) & (df >= 3))[ids]
        vocab, col = np.unique(ids[use], return_inverse=True)
        row = rows[use]
        share = np.where(target > 0.5, 0.5 / max(1e-9, (target > 0.5).mean()), 0.5 / max(1e-9, (target <= 0.5).mean()))
        w, b = np.zeros(len(vocab)), 0.0
        m1, m2, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
        for t in range(1, EPOCHS + 1):
            z = np.bincount(row, w[col], n) + b
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * share / n
            gw = np.bincount(col, g[row], len(w)) + RIDGE * w
            gb = g.sum()
            m1 += 0.1 * (gw - m1)
            m2 += 0.01 * (gw * gw - m2)
            mb += 0.1 * (gb - mb)
            vb += 0.01 * (gb * gb - vb)
            a, c = 1 - 0.9 ** t, 1 - 0.99 ** t
            w -= RATE * (m1 / a) / (np.sqrt(m2 / c) + 1e-8)
            b -= RATE * (mb / a) / (np.sqrt(vb / c) + 1e-8)
        self.weights = np.zeros(DIMS, np.float32)
        self.weights[vocab] = w
        self.bias = b


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS,
          unlabelled: int = UNLABELLED) -> tuple[LabelModel, Classifier] | float:
    """The two models, or the share of toxic labels if there is nothing to tell apart."""
    def run(batch, buf, off):
        r, f = distinct(*features(buf, off))
        return {"doc_id": batch.column(0), "toxic": batch.column(2), "votes": patterns(buf, off),
                "ids": list_array(f, np.bincount(r, minlength=len(off) - 1))}

    got = map_slices(sample_rows(docs, labels, per_class, unlabelled), run,
                     "doc_id long, toxic int, votes long, ids array<long>").toArrow().sort_by("doc_id")
    y = np.array([-1 if v is None else v for v in got.column("toxic").to_pylist()], np.int64)
    if not ((y == 1).any() and (y == 0).any()):
        return float((y == 1).sum() / max(1, (y >= 0).sum()))
    lists = got.column("ids").to_pylist()
    rows = np.repeat(np.arange(len(y)), [len(x) for x in lists])
    ids = np.concatenate([np.asarray(x, np.int64) for x in lists])
    # the lexicon comes from one half of the labelled rows, the label model meets all
    half = (y >= 0) & (np.arange(len(y)) % 2 == 0)
    if not ((y[half] == 1).any() and (y[half] == 0).any()):
        half = y >= 0
    pos = np.bincount(ids[(half & (y == 1))[rows]], minlength=DIMS)
    neg = np.bincount(ids[(half & (y == 0))[rows]], minlength=DIMS)
    n1, n0 = (half & (y == 1)).sum(), (half & (y == 0)).sum()
    gain = np.log((pos + 0.5) / (n1 + 1)) - np.log((neg + 0.5) / (n0 + 1))
    gain[pos < min(MIN_SUPPORT, max(1, n1 // 4))] = -np.inf
    gain[gain < MIN_GAIN] = -np.inf
    gain = gain * np.sqrt(np.maximum(pos, 1))  # sure and frequent ones first
    lexicon = np.argsort(-gain, kind="stable")[:VOTERS]
    lexicon = lexicon[gain[lexicon] > 0]
    slot = np.full(DIMS, -1)
    slot[lexicon] = np.arange(len(lexicon))
    votes = np.zeros((len(y), len(lexicon) + len(PATTERNS)))
    hit = slot[ids] >= 0
    votes[rows[hit], slot[ids[hit]]] = 1
    bits = np.array(got.column("votes").to_pylist(), np.int64)
    for k in range(len(PATTERNS)):
        votes[:, len(lexicon) + k] = bits >> k & 1
    model = LabelModel(votes, y)
    return model, Classifier(rows, ids, len(y), model.posterior(votes, y))


def score(docs: DataFrame, classifier: Classifier | float) -> DataFrame:
    """doc_id, score -- one row per row of `docs` (doc_id, text)."""
    if not isinstance(classifier, Classifier):
        return docs.select("doc_id", F.lit(float(classifier)).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(classifier)  # DIMS floats, a fixed size

    def run(batch, buf, off):
        c = held.value
        rows, ids = features(buf, off)
        use = c.weights[ids] != 0
        rows, ids = distinct(rows[use], ids[use])
        z = c.bias + np.bincount(rows, c.weights[ids], len(off) - 1)
        return {"doc_id": batch.column(0), "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}

    return map_slices(docs, run, "doc_id long, score double")


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 5, is 0: never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    d = id_text(docs, id_col, text_col)
    got = learn(spark, d, labels)
    out = score(d, got[1] if isinstance(got, tuple) else got)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
