"""Spelling variants by a bit-sliced position index (operator 13).

1. Words and their counts come from all texts by one partial aggregation.
2. Of two words that differ by one code point the shorter (or equal) has
   length l. Cut l into three parts: two of them are the same in both words,
   counted from the front before the edit and from the back after it. Every
   word goes to the groups (l, part left out, the rest) for l its length and
   one less, so two near words always meet, and a group holds words that
   agree in two thirds of their letters. Groups above `GROUP` words are cut
   into blocks; every word of the group is a query to every block.
3. A task reads its groups in order, some thousands of words at a time, and
   builds bitsets over them for every (position, letter). For all queries at
   once it goes letter by letter through the words of 64 at a time: a set of
   words that agree so far, one of words with one letter replaced, and one of
   words with one letter more, whose positions are shifted by one.
4. Links are made distinct and give every word its near words and its form;
   roots are found by pointer doubling.

Defined results: a null or empty text has no words; rows that repeat an id
count each for itself, a null id is an empty one in the deletion rule; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._store import keep
from wardstat.llm._text import id_text

GROUP = 4096             # words of one block of a group
CELLS = 1 << 23          # bits of one index: positions x letters x words
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, drop: int | None = 31) -> DataFrame:
    """(word, n) over all texts; where `drop` divides the crc32 of
    "<doc_id>:<run>", the run loses one code point."""
    low = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    words = docs.select("doc_id", F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("word"))
    if drop:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word").cast("binary"))
        k = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.col("word").substr(F.lit(1), k), F.col("word").substr(k + 2, F.length("word")))
        words = words.withColumn("h", h).withColumn("word", F.when(F.col("h") % drop == 0, cut).otherwise(F.col("word")))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def group_rows(words: DataFrame, shortest: int) -> DataFrame:
    """(l, key, word): the groups of every word; `l` is the shorter length."""
    size = F.length("word")
    rows = words.select("word", F.explode(F.when(size > shortest, F.array(size, size - 1)).otherwise(F.array(size))).alias("l"))
    cut = [F.floor(F.col("l") * j / 3).cast("int") for j in range(4)]
    keys = F.array(*[F.concat(F.lit(str(j)), F.col("word").substr(F.lit(1), cut[j]),
                              F.when(cut[j + 1] < F.col("l"), F.expr(f"right(word, l - int(floor(l * {j + 1} / 3)))")).otherwise(""))
                     for j in range(3)])
    return rows.select("l", F.explode(keys).alias("key"), "word")


def blocks(groups: DataFrame, size: int = GROUP) -> DataFrame:
    """(l, key, block, query, word): index words (query 0) in one block each,
    queries (words of length l) in every block of their group."""
    large = groups.groupBy("l", "key").count().where(F.col("count") > size)
    parts = groups.join(large, ["l", "key"], "left").withColumn("parts", F.coalesce(F.ceil(F.col("count") / size), F.lit(1)).cast("int"))
    home = F.struct(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("block"), F.lit(0).alias("query"))
    every = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda b: F.struct(b.alias("block"), F.lit(1).alias("query")))
    roles = F.when(F.length("word") == F.col("l"), F.concat(F.array(home), every)).otherwise(F.array(home))
    return parts.select("l", "key", "word", F.explode(roles).alias("r")).select("l", "key", "r.block", "r.query", "word")


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points of the words as a matrix, 0 beyond the end."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


class Index:
    """Bitsets over words of length `size` and one more, by (position, letter)."""

    def __init__(self, words: list[str], size: int):
        code = _codes(words, size + 1)
        self.size, self.lanes = size, -(-len(words) // 64)
        self.letters, at = np.unique(code, return_inverse=True)
        at = at.reshape(code.shape)
        bits = np.zeros((size + 1, len(self.letters), 64 * self.lanes), bool)
        bits[np.arange(size + 1)[:, None], at.T, np.arange(len(words))] = True
        self.sets = np.packbits(bits, axis=2, bitorder="little").view("<u8").reshape(size + 1, len(self.letters), self.lanes)
        longer = np.zeros(64 * self.lanes, bool)
        longer[:len(words)] = code[:, size] != 0
        self.longer = np.packbits(longer, bitorder="little").view("<u8")

    def near(self, queries: list[str], first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs one edit apart; query i looks at words first[i]..last[i]-1."""
        lo, hi = first // 64, -(-last // 64)
        n = np.maximum(hi - lo, 0)
        q = np.repeat(np.arange(len(queries)), n)
        lane = np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n) + lo[q]
        code = _codes(queries, self.size)
        at = np.searchsorted(self.letters, code)
        at = np.minimum(at, len(self.letters) - 1)
        none = self.letters[at] != code  # a letter that no word of the index has
        begin = np.clip(first[q] - 64 * lane, 0, 64).astype(np.uint64)
        end = np.clip(last[q] - 64 * lane, 0, 64).astype(np.uint64)
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        low = np.where(end == 64, full, (np.uint64(1) << (end & np.uint64(63))) - np.uint64(1))
        same = low & ~((np.uint64(1) << (begin & np.uint64(63))) - np.uint64(1))
        replaced = np.zeros(len(q), np.uint64)
        longer = np.zeros(len(q), np.uint64)
        for i in range(self.size):
            c, gone = at[q, i], none[q, i]
            here = np.where(gone, np.uint64(0), self.sets[i, c, lane])
            shifted = np.where(gone, np.uint64(0), self.sets[i + 1, c, lane])
            longer = (longer | same) & shifted
            replaced = (replaced & here) | (same & ~here)
            same &= here
        more = self.longer[lane]
        found = (replaced & ~more) | ((longer | same) & more)
        some = np.flatnonzero(found)
        bit = np.unpackbits(found[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, b = np.nonzero(bit)
        return q[some[k]], 64 * lane[some[k]] + b


def _near_in(batches):
    """Links of the groups of one task, read in the order (l, key, block, query)."""
    out_type = pa.schema([("word", pa.string()), ("near", pa.string())])
    words, queries = [], []      # index words of the groups at hand, queries (word, first, last)
    size = group = None          # l, current group
    first = 0

    def flush():
        if not (words and queries):
            return None
        index = Index(words, size)
        q, w = index.near([x[0] for x in queries], np.array([x[1] for x in queries], np.int64), np.array([x[2] for x in queries], np.int64))
        a = pa.array([queries[i][0] for i in q.tolist()] + [words[i] for i in w.tolist()], pa.string())
        b = pa.array([words[i] for i in w.tolist()] + [queries[i][0] for i in q.tolist()], pa.string())
        return pa.RecordBatch.from_arrays([a, b], schema=out_type) if len(a) else None

    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("l", "key", "block", "query", "word")]
        for ell, key, block, query, word in zip(*cols):
            if (ell, key, block) != group:
                # between groups: start a new index once this one is full or the length changes
                if ell != size or len(words) >= GROUP or len(words) * (ell + 1) * 64 > CELLS:
                    got = flush()
                    if got is not None:
                        yield got
                    words, queries, size = [], [], ell
                group, first = (ell, key, block), len(words)
            if not query:
                words.append(word)
            else:
                queries.append((word, first, len(words)))
                if len(queries) >= 4 * GROUP:  # a large group's queries come in many batches
                    got = flush()
                    if got is not None:
                        yield got
                    queries = []
    got = flush()
    if got is not None:
        yield got


def near_words(words: DataFrame, shortest: int, group: int = GROUP) -> DataFrame:
    """(word, near): every ordered pair of different words one edit apart."""
    rows = blocks(group_rows(words, shortest), group)
    dealt = rows.repartition("l", "key", "block").sortWithinPartitions("l", "key", "block", "query")
    return dealt.mapInArrow(_near_in, "word string, near string").distinct()


def _roots(spark: SparkSession, forms: DataFrame, most: int, factor: int) -> DataFrame:
    """(word, root) of the words with a form. Counts grow by `factor` on every
    step, which bounds the longest chain and with it the number of doublings."""
    steps = max(1, int(math.log(max(most, factor), factor)) + 1)
    out = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        out = keep(spark, out.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return out


def spelling_variants(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shortest: int = 7, least: int = 2, factor: int = 10, drop: int | None = 31,
                      group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least
    `shortest` code points and `least` occurrences. The form is the near word
    of largest n (ties: smallest), if that is at least `factor` times the word's."""
    counts = word_counts(id_text(docs, id_col, text_col), drop)
    words = keep(spark, counts.where((F.length("word") >= shortest) & (F.col("n") >= least)), "words")
    links = near_words(words.select("word"), shortest, group)
    most = words.agg(F.max("n")).first()[0] or 1
    named = links.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    per = named.groupBy("word").agg(F.count("*").alias("n_near"), F.max("near_n").alias("top"),
                                    F.min_by("near", F.struct(-F.col("near_n"), F.col("near"))).alias("near"))
    form = F.when(F.col("top") >= factor * F.col("n"), F.col("near"))
    out = keep(spark, words.join(per, "word", "left").select(
        "word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(form.isNotNull(), F.col("top")).alias("form_n")), "forms")
    roots = _roots(spark, out.where("form is not null"), most, factor)
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
