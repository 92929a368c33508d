"""Operators 11 to 13 against brute force, with awkward rows."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF001
from wardstat.llm import hard_negatives as hn
from wardstat.llm import spelling_variants as sv
from wardstat.llm import token_counts as tc
from wardstat.llm.queries import QUERIES

DOC = "doc_id long, text string"
VEC = "vec_id long, embedding array<double>, label int"


# --- op11 ------------------------------------------------------------------

def mined(rows, anchors, positives=5, negatives=10):
    """(anchor, positive, rank) -> (negative, scores), plainly."""
    out = {}
    for aid, alabel, a in anchors:
        def score(v):
            return sum(p * q for p, q in zip(a, v))
        best = sorted({(-score(v), i) for i, label, v in rows if label == alabel and i != aid})[:positives]
        for neg_p, pid in best:
            p = -neg_p
            found = sorted({(-score(v), i) for i, label, v in rows
                            if label != alabel and 30 * p <= 100 * score(v) <= 90 * p})[:negatives]
            for rank, (s, i) in enumerate(found, 1):
                out[aid, pid, rank] = (i, p, -s)
    return out


def run_mining(spark, rows, **kw):
    table = hn.clean(spark.createDataFrame(rows, VEC))
    got = hn.hard_negatives(spark, table, table.where("id % 4 = 0"), **kw).collect()
    out = {(r["anchor_id"], r["positive_id"], r["rank"]): (r["negative_id"], r["positive_score"], r["negative_score"]) for r in got}
    assert len(out) == len(got)
    return out


def clean_rows(rows):
    out = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        out.append((i, label, tuple(int(np.floor(256 * x)) for x in v)))
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("kw", [{}, {"tree": 4, "pass_bytes": 4000}])
def test_hard_negatives_against_brute_force(spark, kw):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(3, 6))
    rows = [(i, [float(x) for x in centre[i % 3] + rng.normal(size=6) * 0.3], int(rng.integers(0, 3))) for i in range(160)]
    rows += [(400 + i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(12)]  # ties of vectors and scores
    rows += rows[:20]                                                               # repeated rows
    rows += [(500, [0.5, 0.5], 1), (501, [1.0], 0), (502, [], 1), (504, [], 0)]     # other lengths
    rows += [(600, None, 1), (601, [float("nan")] * 6, 1), (602, [float("inf")] + [0.0] * 5, 0), (603, [None] + [1.0] * 5, 0),
             (604, [1.0] * 6, None), (None, [1.0] * 6, 1)]                           # take no part
    part = clean_rows(rows)
    want = mined(part, [r for r in part if r[0] % 4 == 0])
    assert len(want) > 1000
    assert run_mining(spark, rows, **kw) == want


def test_hard_negatives_of_large_components_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(1, 2**21, 3)], i % 2) for i in range(40)]
    part = clean_rows(rows)
    assert max(abs(x) for _, _, v in part for x in v) ** 2 > 2**53
    assert run_mining(spark, rows) == mined(part, [r for r in part if r[0] % 4 == 0])


def test_bounds_spare_scores_of_close_anchors():
    rng = np.random.default_rng(7)
    centre = rng.normal(size=16) * 300
    anchors = np.floor(centre + rng.normal(size=(50, 16)) * 4).astype(np.int64)
    parent, length, level = hn.spanning_tree(anchors)
    assert (parent >= 0).sum() == 49 and level[0] == 0
    for c, p in enumerate(parent):
        assert p < 0 or (length[c] >= np.linalg.norm(anchors[c] - anchors[p]) and level[c] == level[p] + 1)
    forest = hn.Forest([{"dims": 16, "n": 50, "no": np.arange(50).tobytes(), "id": np.arange(50).tobytes(),
                         "label": np.zeros(50, np.int64).tobytes(), "length": length.tobytes(), "parent": parent.tobytes(),
                         "level": level.tobytes(), "v": anchors.tobytes()}])
    x = np.floor(rng.normal(size=(2000, 16)) * 100).astype(np.int64)
    exact = anchors @ x.T
    least, scored, right = np.quantile(exact, 0.99), 0, 0
    for at, mask, s in hn.sweep(forest, x, lambda at, low, high: high >= least):
        scored += mask.sum()
        assert (s[mask] == exact[at][mask]).all()
        assert not (exact[at] >= least)[~mask].any()  # nothing wanted is left out
        right += (exact[at] >= least).sum()
    assert right <= scored < exact.size / 5


def test_hard_negatives_of_nothing(spark):
    assert run_mining(spark, []) == {}
    assert run_mining(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == {}
    assert run_mining(spark, [(0, [1.0], 1), (1, [1.0], 0)]) == {}


def test_clashing_columns_are_ignored(spark):
    rows = [(i, [float(i % 5), 1.0], i % 2, "x", 1, 2, "y") for i in range(12)]
    df = spark.createDataFrame(rows, VEC + ", id string, no int, tree int, v string")
    table = hn.clean(df)
    part = clean_rows([r[:3] for r in rows])
    got = hn.hard_negatives(spark, table, table.where("id % 4 = 0")).count()
    assert got == len(mined(part, [r for r in part if r[0] % 4 == 0]))


# --- op12 ------------------------------------------------------------------

def piece_path():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def check_counts(spark, rows):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_path())
    got = tc.token_counts(spark, spark.createDataFrame(rows, DOC), piece_path()).collect()
    want = [(i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in rows]
    assert sorted([(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got], key=str) == sorted(want, key=str)
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)


def test_token_counts_of_awkward_texts(spark):
    texts = [None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "\n\n a\tb", "▁", "▁a ▁", "<s>x</s><0x0A><unk>", "ﬁ é é",
             "日本語のテキスト 混ぜる", "\x00\x01", "🙂🙂 👩‍👩‍👧", "x" * 30000, "ab" * 20000 + " c", "the " * 20000, "　 "]
    rows = list(enumerate(texts)) + [(3, "again"), (3, "again"), (None, "no id"), (None, None)]
    check_counts(spark, rows)


def test_token_counts_of_random_texts(spark):
    rng = random.Random(3)
    chars = "ab  ▁\n\t.,-_'eéñß日本한🙂0123456789<>/THEing"
    check_counts(spark, [(i, "".join(rng.choice(chars) for _ in range(rng.randrange(200)))) for i in range(400)])


def test_token_counts_of_documents(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_path())
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op12_token_counts"](spark, SF001).collect()}
    assert got == {r["doc_id"]: len(sp.encode(r["text"] or "")) for r in docs}


def test_token_counts_of_nothing(spark):
    got = tc.token_counts(spark, spark.createDataFrame([], DOC + ", token string, chunk int"), piece_path())
    assert got.count() == 0 and got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


# --- op13 ------------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(rows, shortest=7, least=2, factor=10, drop=31):
    import re
    n = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if drop and h % drop == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    words = [w for w in n if len(w) >= shortest and n[w] >= least]
    near = defaultdict(list)
    for a in words:
        for b in words:
            if a != b and one_edit(a, b):
                near[a].append(b)
    form = {}
    for w in words:
        if near[w]:
            b = min(near[w], key=lambda x: (-n[x], x))
            if n[b] >= factor * n[w]:
                form[w] = b
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def table_of(df):
    got = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("group", [sv.GROUP, 3])
def test_variants_against_brute_force(spark, group):
    """Chains of forms, hot groups cut into blocks, repeats, letters beyond ASCII."""
    rng = random.Random(9)
    bases = ["aaaaaaa", "banana" * 2, "Überraschung", "façades", "spelling", "spellings", "ABABABAB", "é" * 8, "ÿÀÿÀÿÀÿ"]
    words = []
    for b in bases:
        for _ in range(40):
            w, k = list(b), rng.randrange(len(b))
            kind = rng.randrange(4)
            if kind == 1:
                w[k] = rng.choice("abéz")
            elif kind == 2:
                del w[k]
            elif kind == 3:
                w.insert(k, rng.choice("abéz"))
            words += ["".join(w)] * (2 if kind else 9)
    words += ["chained"] * 400 + ["chaimed"] * 40 + ["chaimet"] * 4 + ["short", "six" * 2]
    rng.shuffle(words)
    rows = [(i if i % 9 else None, " ".join(words[k:k + 25]) + rng.choice([".", "\n", "×", "7"])) for i, k in enumerate(range(0, len(words), 25))]
    rows += [(1, None), (2, ""), (3, "123 !?"), (5, "z" * 5000 + " " + "z" * 5000 + " " + "z" * 4999 + "y " + "z" * 4999 + "y")] + rows[:3]
    for drop in (None, 5):
        want = variants(rows, drop=drop)
        assert len(want) > 100
        if not drop:
            assert want["chaimet"][:2] == ("chaimed", "chained")
        got = sv.spelling_variants(spark, spark.createDataFrame(rows, DOC), drop=drop, group=group)
        assert table_of(got) == want


def test_index_finds_every_pair():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice((7, 8)))) for _ in range(600)})
    index = sv.Index(words, 7)
    queries = [w for w in words if len(w) == 7] + ["zzzzzzz"]
    q, w = index.near(queries, np.zeros(len(queries), np.int64), np.full(len(queries), len(words)))
    got = sorted((queries[i], words[j]) for i, j in zip(q, w))
    assert got == sorted((a, b) for a in queries for b in words if a != b and one_edit(a, b))


def test_variants_of_documents_and_of_nothing(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").limit(60).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    got = table_of(sv.spelling_variants(spark, spark.createDataFrame(rows, DOC)))
    assert got == variants(rows)
    empty = spark.createDataFrame([], DOC + ", word string, n int, l int, key string")
    assert sv.spelling_variants(spark, empty).collect() == []
