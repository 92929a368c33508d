"""Quality rules as a short-circuit cascade (operator 3).

`plan_order` runs every rule on a bounded hash sample (`SAMPLE` documents at
most on average), measures seconds per document and the share it rejects,
and orders the rules by rejections per second. `cascade` then evaluates rule
after rule, each only on the documents that all rules before it passed. A
document is kept if no rule fails it, so the order changes the work and
never the verdict.

Words are maximal runs of `[^\\x20\\x09-\\x0D]`; case counts. Defined results:
null, empty or blank texts have no words and fail the base rule; rows with a
null id and repeated rows get a row each; an empty table gives an empty
result and leaves the rules in their written order; other columns are
ignored.
"""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._text import Words, buffer_of, grams, id_text, map_slices, mix64, prefix_hash, slices, span_hash

SAMPLE = 2000
GRAM = 5


def _flags(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL = _flags(b"#*$%&|<>")
_UPPER = _flags(bytes(range(65, 91)))
_LETTER = _flags(bytes([*range(65, 91), *range(97, 123)]))
_BANG = _flags(b"!")
#: letters for a rule on words: ASCII letters and all bytes beyond ASCII
_WORDLY = _LETTER | _flags(bytes(range(128, 256)))


def _count(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Set flags within each row."""
    c = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


class Texts:
    """A slice of texts; what several rules need is worked out once."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off, self._made = buf, off, {}

    def __len__(self):
        return len(self.off) - 1

    def _once(self, name, fn):
        if name not in self._made:
            self._made[name] = fn()
        return self._made[name]

    def only(self, rows: np.ndarray) -> Texts:
        size = np.diff(self.off)[rows]
        off = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.off[:-1][rows] - off[:-1], size) + np.arange(off[-1])
        return Texts(self.buf[at], off)

    @property
    def words(self) -> Words:
        return self._once("words", lambda: Words(self.buf, self.off))

    def n_words(self):
        return self.words.count()

    def word_chars(self):
        def fn():
            points = np.zeros(len(self.buf) + 1, np.int64)
            np.cumsum((self.buf & 0xC0) != 0x80, out=points[1:])
            w = self.words
            return np.bincount(w.row, points[w.end] - points[w.start], len(self)).astype(np.int64)
        return self._once("word_chars", fn)

    def n_symbols(self):
        return _count(_SYMBOL[self.buf], self.off)

    def lines(self):
        """(lines with a word, those equal to an earlier one) of each row."""
        def fn():
            nl = np.flatnonzero(self.buf == 10)
            begin = np.concatenate([self.off[:-1], nl + 1])
            row = np.concatenate([np.arange(len(self)), np.searchsorted(self.off, nl, "right") - 1])
            order = np.lexsort((begin, row))
            begin, row = begin[order], row[order]
            end = np.empty_like(begin)
            end[:-1] = begin[1:] - 1
            end[np.searchsorted(row, np.arange(len(self)), "right") - 1] = self.off[1:]
            w = self.words
            some = np.searchsorted(w.start, begin) < np.searchsorted(w.start, end)
            begin, end, row = begin[some], end[some], row[some]
            h = mix64(span_hash(prefix_hash(self.buf), begin, end) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            total = np.bincount(row, minlength=len(self))
            first = np.unique(h, return_index=True)[1]
            return total, total - np.bincount(row[first], minlength=len(self))
        return self._once("lines", fn)

    def n_repeat_words(self):
        """Words covered by 5-word windows that occur twice or more in the row."""
        def fn():
            w = self.words
            at, g = grams(w, GRAM)
            if not len(at):
                return np.zeros(len(self), np.int64)
            h = mix64(g + w.row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(h)
            s = h[order]
            same = s[1:] == s[:-1]
            twice = np.zeros(len(at), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            edge = np.zeros(len(w.hash) + GRAM + 1, np.int64)
            edge[at[twice]] += 1
            edge[at[twice] + GRAM] -= 1
            covered = np.cumsum(edge)[:len(w.hash)] > 0
            return np.bincount(w.row[covered], minlength=len(self))
        return self._once("repeat", fn)


# Each rule says which texts of a slice fail; whole numbers only.

def _base(t: Texts):
    return (t.n_words() < 10) | (100 * t.n_repeat_words() > 20 * t.n_words())


def _word_length(t: Texts):
    return (t.word_chars() < 2 * t.n_words()) | (t.word_chars() > 15 * t.n_words())


def _symbols(t: Texts):
    return 10 * t.n_symbols() > t.n_words()


def _dup_lines(t: Texts):
    total, dup = t.lines()
    return 10 * dup > 5 * total


def _capitals(t: Texts):
    return 10 * _count(_UPPER[t.buf], t.off) > 6 * _count(_LETTER[t.buf], t.off)


def _exclamations(t: Texts):
    return 2 * _count(_BANG[t.buf], t.off) > t.n_words()


def _alphabetic(t: Texts):
    c = np.zeros(len(t.buf) + 1, np.int64)
    np.cumsum(_WORDLY[t.buf], out=c[1:])
    w = t.words
    has = c[w.end] > c[w.start]
    return 10 * np.bincount(w.row[has], minlength=len(t)) < 6 * t.n_words()


RULES = {"base": _base, "word_length": _word_length, "symbols": _symbols, "dup_lines": _dup_lines,
         "capitals": _capitals, "exclamations": _exclamations, "alphabetic": _alphabetic}


def plan_order(spark: SparkSession, docs: DataFrame, rules: dict = RULES, sample: int = SAMPLE,
               id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """Rule names by rejections per second, measured on a bounded sample."""
    d = id_text(docs, id_col, text_col)
    share = min(1.0, sample / max(1, docs.count()))

    def run(batches):
        total = {n: [0, 0, 0.0] for n in rules}
        for t in batches:
            buf, off = buffer_of(t.column(1))
            for i, j in slices(off):
                for name, rule in rules.items():
                    texts = Texts(buf[off[i]:off[j]], off[i:j + 1] - off[i])  # nothing shared: full cost of each
                    t0 = time.perf_counter()
                    bad = rule(texts)
                    total[name][2] += time.perf_counter() - t0
                    total[name][0] += j - i
                    total[name][1] += int(bad.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total)), *(pa.array([v[k] for v in total.values()], ty) for k, ty in
                                      enumerate((pa.int64(), pa.int64(), pa.float64())))], ["rule", "n", "bad", "s"])

    got = (d.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 24)) < share * (1 << 24))
           .mapInArrow(run, "rule string, n long, bad long, s double")
           .groupBy("rule").agg(F.sum("bad").alias("bad"), F.sum("s").alias("s")).collect())  # one row a rule
    rate = {r["rule"]: (r["bad"] + 0.5) / (r["s"] + 1e-9) if r["s"] else 0.0 for r in got}
    return sorted(rules, key=lambda n: -rate.get(n, 0.0))


def _verdict(texts: Texts, order: list[str], rules: dict) -> np.ndarray:
    """Position in `order` of the rule that failed each text, -1 if none did."""
    failed = np.full(len(texts), -1)
    rows, t = np.arange(len(texts)), texts  # texts still in, and a slice that holds just them
    for k, name in enumerate(order):
        if not len(rows):
            break
        bad = rules[name](t)
        if bad.any():
            failed[rows[bad]] = k
            rows, t = rows[~bad], t.only(np.flatnonzero(~bad))
    return failed


def cascade(docs: DataFrame, order: list[str], rules: dict = RULES, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, kept, failed_rule (the first in `order`), and the counts of the base rule."""
    def run(batch, buf, off):
        t = Texts(buf, off)
        failed = _verdict(t, order, rules)
        return {"doc_id": batch.column(0), "n_words": t.n_words(), "word_chars": t.word_chars(),
                "n_symbols": t.n_symbols(), "n_dup_lines": t.lines()[1], "n_repeat_words": t.n_repeat_words(),
                "base_failed": _base(t), "kept": failed < 0,
                "failed_rule": pa.array([order[k] if k >= 0 else None for k in failed], pa.string())}

    return map_slices(id_text(docs, id_col, text_col), run,
                      "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                      "n_repeat_words long, base_failed boolean, kept boolean, failed_rule string")


def quality(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Plan the order on a sample, then run the cascade over all documents."""
    return cascade(docs, plan_order(spark, docs, sample=sample))
