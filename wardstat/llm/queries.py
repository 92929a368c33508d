"""Registered queries of the operators, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm.decontaminate import find_leaks
from wardstat.llm.hard_negatives import clean, hard_negatives
from wardstat.llm.language_id import identify
from wardstat.llm.license_scan import SHINGLE, TEMPLATES, scan, size_class, template_words
from wardstat.llm.line_dedup import dedup_lines
from wardstat.llm.near_dedup import near_duplicates
from wardstat.llm.packing import pack
from wardstat.llm.passage_dedup import near_passages
from wardstat.llm.quality_rules import quality
from wardstat.llm.spelling_variants import spelling_variants
from wardstat.llm.suffix_dedup import dedup_substrings
from wardstat.llm.token_counts import token_counts
from wardstat.llm.toxicity import toxicity
from wardstat.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    def run(spark, sf_dir):
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: words `[^\x20\x09-\x0D]+` of A-Z-lower-cased text, in SQL
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


@query
def op4_minhash_near_dedup(spark, sf_dir):
    """4-word shingles, Jaccard 0.8 or more, whole documents table."""
    return near_duplicates(spark, table(spark, sf_dir, "documents"), n=4, percent=80)


ORACLE_SQL["op4_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
      WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * i >= 80 * (x.n + y.n - i)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(id, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT u.b, r.c FROM r JOIN u ON r.id = u.a),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, m.c = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN m ON m.id = w.doc_id
"""


@query
def op10_line_dedup(spark, sf_dir):
    """Keys of 40 code points or more in 5 documents or more; whole documents table."""
    out = dedup_lines(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL["op10_line_dedup"] = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS xs FROM documents),
l AS (SELECT doc_id, unnest(xs) AS x, unnest(range(len(xs))) AS i FROM s),
k AS (SELECT doc_id, i, x, {_LOWER.format("trim(x, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))")} AS key FROM l),
f AS (SELECT key, max(doc_id) AS keep_doc FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(f.keep_doc <> k.doc_id, false) AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query
def op5_language_id(spark, sf_dir):
    """Language of every whole text; learned from rows that are not held out."""
    return identify(spark, table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query
def op9_benchmark_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item: all documents against all items."""
    return find_leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of five permitted lengths."""
    return pack(spark, table(spark, sf_dir, "documents"))


@query
def op3_quality_rules(spark, sf_dir):
    """Rule counts and the cascade's verdict for every document."""
    return quality(spark, table(spark, sf_dir, "documents")).drop("failed_rule")


ORACLE_SQL["op3_quality_rules"] = f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g FROM p),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
c AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM w),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup FROM l
      WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, t, ws, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN d USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 5 * n_lines
    OR 10 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 6 * length(regexp_replace(t, '[^A-Za-z]', '', 'g'))
    OR 2 * length(regexp_replace(t, '[^!]', '', 'g')) > n_words
    OR 10 * len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) < 6 * n_words) AS kept
FROM m
"""


@query
def op7_suffix_array_dedup(spark, sf_dir):
    """Bytes of repeated 100-byte strings, over all documents."""
    out = dedup_substrings(spark, table(spark, sf_dir, "documents"), 100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL["op7_suffix_array_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM d),
p AS (SELECT doc_id, unnest(range(n - 99)) AS i, h FROM n WHERE n >= 100),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS m FROM p)
      QUALIFY row_number() OVER (PARTITION BY m ORDER BY doc_id, i) > 1),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS s FROM f),
q AS (SELECT doc_id, i, sum(s) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g),
r AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM q GROUP BY doc_id, k),
x AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since FROM r),
a AS (SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS last,
        list({'since': since, 'lo': lo} ORDER BY lo) AS parts FROM x GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN parts IS NULL THEN h ELSE
    array_to_string(list_transform(parts, lambda y: substr(h, 2 * y.since + 1, 2 * (y.lo - y.since))), '')
    || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM n LEFT JOIN a USING (doc_id)
"""


@query
def op2_toxicity(spark, sf_dir):
    """Toxicity score of every whole text."""
    return toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_license_scan(spark, sf_dir):
    """License notices found in all documents."""
    return scan(spark, table(spark, sf_dir, "documents"))


_TEMPLATE_ROWS = ", ".join(
    f"('{k}', {template_words(v)}, {min(SHINGLE, len(template_words(v)))}, {size_class(len(template_words(v)))})"
    for k, v in TEMPLATES.items())

ORACLE_SQL["op6_license_scan"] = f"""
WITH t(template, ws, n, w) AS (VALUES {_TEMPLATE_ROWS}),
ts AS (SELECT template, n, w, list_distinct(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i+n-1], ' '))) AS s FROM t),
d AS (SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS ws FROM documents),
k AS (SELECT DISTINCT n FROM t),
g AS (SELECT doc_id, n, list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i+n-1], ' ')) AS gs FROM d, k),
s AS (SELECT doc_id, n, unnest(range(1, len(gs) + 1)) AS i, unnest(gs) AS g FROM g),
x AS (SELECT template, n, w, len(s) AS n_template, unnest(s) AS g FROM ts),
h AS (SELECT doc_id, template, x.n, w, n_template, i, s.g FROM s JOIN x ON s.g = x.g AND s.n = x.n),
v AS (SELECT *, unnest(range(0, (i - 1) // (w // 2) + 1)) AS win FROM h),
c AS (SELECT doc_id, template, win * (w // 2) AS first, n_template, count(DISTINCT g) AS n_shared FROM v
      WHERE i - 1 >= win * (w // 2) AND i - 1 + n <= win * (w // 2) + w GROUP BY ALL)
SELECT doc_id, template, max(n_shared) AS n_shared, CAST(max(n_template) AS BIGINT) AS n_template,
       CAST(min(first) AS BIGINT) AS first_word, count(DISTINCT first) AS n_windows
FROM c WHERE 100 * n_shared >= 80 * n_template GROUP BY doc_id, template
"""


@query
def op1_substring_dedup(spark, sf_dir):
    """Documents that share near-duplicate passages of 50 words or more."""
    return near_passages(spark, table(spark, sf_dir, "documents"))


@query
def op11_hard_negative_mining(spark, sf_dir):
    """Hard negatives of all vectors whose id is divisible by 100, against all vectors."""
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    rows = clean(vectors)
    return hard_negatives(spark, rows, rows.where("id % 100 = 0"))


ORACLE_SQL["op11_hard_negative_mining"] = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
      FROM r a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""


@query
def op12_token_counts(spark, sf_dir):
    """Tokens of every whole text for the 32k piece model."""
    import public_tokenizers
    return token_counts(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_spelling_variants(spark, sf_dir):
    """Words of all documents with the frequent words that they are variants of."""
    return spelling_variants(spark, table(spark, sf_dir, "documents"))


#: crc32 byte by byte; its table is made by the rule of the reversed polynomial
ORACLE_SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE t AS (SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c
    FROM (SELECT unnest(range(256)) AS i))),
o AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS n FROM o GROUP BY ALL),
x AS (SELECT w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS b FROM c),
h AS (SELECT w, n, xor(list_reduce(range(len(b) // 2), lambda c, k:
        xor(c // 256, t[xor(c % 256, CAST('0x' || b[2 * k + 1:2 * k + 2] AS BIGINT)) + 1]), 4294967295), 4294967295) AS h FROM x, t),
r AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM r WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS (SELECT DISTINCT word, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
k AS (SELECT word, word AS cut FROM v UNION ALL SELECT word, cut FROM d),
e AS (SELECT DISTINCT a.word, b.word AS near FROM k a JOIN k b ON a.cut = b.cut AND a.word <> b.word
      WHERE abs(length(a.word) - length(b.word)) = 1 OR length(a.word) = length(b.word) AND
        list_sum(list_transform(range(1, length(a.word) + 1), lambda i: CAST(a.word[i] <> b.word[i] AS INT))) = 1),
g AS (SELECT e.word, near, v.n AS near_n, count(*) OVER (PARTITION BY e.word) AS n_near FROM e JOIN v ON v.word = near
      QUALIFY row_number() OVER (PARTITION BY e.word ORDER BY v.n DESC, encode(near)) = 1),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * v.n THEN near END AS form,
        CASE WHEN near_n >= 10 * v.n THEN near_n END AS form_n FROM v LEFT JOIN g USING (word)),
z AS (SELECT word, word AS at, 0 AS step FROM f UNION ALL SELECT z.word, f.form, step + 1 FROM z JOIN f ON f.word = z.at WHERE f.form IS NOT NULL)
SELECT f.word, form, arg_max(z.at, step) AS root, n, n_near, form_n FROM f JOIN z ON z.word = f.word GROUP BY f.word, form, n, n_near, form_n
"""
