"""Operators against brute force on small fixtures, and held-out accuracy."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF001, SF01
from wardstat.llm import (_text, decontaminate, language_id, license_scan, line_dedup, near_dedup, packing, passage_dedup,
                          quality_rules, suffix_dedup, toxicity)
from wardstat.llm._graph import components
from wardstat.llm._text import buffer_of
from wardstat.llm.queries import QUERIES

DOC = "doc_id long, text string"
RNG = random.Random(11)
VOCAB = [f"{a}{b}" for a in ("al", "be", "co", "du", "en", "fi") for b in ("ra", "lo", "mi", "nu", "ter", "vox", "zed")]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def edit(text, k, rng=RNG):
    w = text.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = rng.choice(VOCAB) + str(rng.randrange(999))
    return " ".join(w)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}


# --- op4 -------------------------------------------------------------------

def test_superminhash_estimates_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64)
    b = np.concatenate([a[:240], rng.integers(0, 2**63, 60, dtype=np.uint64)])
    same = np.mean(near_dedup.superminhash(a, 256) == near_dedup.superminhash(b, 256))
    assert abs(same - 240 / 360) < 0.1
    assert (near_dedup.superminhash(a, 64) == near_dedup.superminhash(rng.permutation(a), 64)).all()


def test_near_duplicates_against_brute_force(spark):
    """One large group of near copies whose links are hit and miss, and strangers."""
    base, rng = prose(60), random.Random(3)
    texts = [edit(base, rng.randrange(7), rng) for _ in range(60)] + [prose(50, rng) for _ in range(10)] + [base, base]
    sets = [{tuple(t.split()[i:i + 4]) for i in range(len(t.split()) - 3)} for t in texts]
    comp = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 80 * len(a | b) and comp[i] != comp[j]:
                lo, hi = sorted((comp[i], comp[j]))
                comp = [lo if c == hi else c for c in comp]
    got = near_dedup.near_duplicates(spark, spark.createDataFrame(list(enumerate(texts)), DOC), n=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(comp))
    assert 1 < len(set(comp)) < len(texts)


def test_pair_meets_where_an_earlier_band_agrees_by_its_bytes_only(spark):
    """Two members share band 1; the bytes of band 0 are equal, its keys are not."""
    named = spark.createDataFrame([(7, 1, 3, i, i, True) for i in (1, 2)],
                                  "key long, band int, n long, doc_id long, c long, apart boolean")
    reps = spark.createDataFrame([(1, bytearray(8), [5, 7]), (2, bytearray(8), [6, 7])], "doc_id long, sig binary, bands array<long>")
    sets = spark.createDataFrame([(i, list(range(10))) for i in (1, 2)], "doc_id long, shingles array<long>")
    got = near_dedup._meet_apart(named, reps, sets, 4, 80).collect()
    assert [(r["a"], r["b"]) for r in got] == [(2, 1)]


# --- op10 ------------------------------------------------------------------

def test_cuckoo_filter():
    keys = np.random.default_rng(2).integers(-2**62, 2**62, 5000)
    f = line_dedup.Cuckoo.build(keys)
    assert f.contains(keys).all()
    f.delete(keys[:2500])
    g = line_dedup.Cuckoo.load(f.dump())
    assert g.contains(keys[2500:]).all() and g.contains(keys[:2500]).mean() < 0.01


def test_line_index_is_reversible(spark):
    lines = [f"{prose(8)} line number {i} of a pool" for i in range(12)]
    docs = [(i, "\n".join(random.Random(i).sample(lines, 5))) for i in range(30)]

    def brute(kept):
        held = defaultdict(set)
        for i, t in kept:
            for x in t.split("\n"):
                held[x].add(i)
        return {i: "\n".join(x for x in t.split("\n") if len(held[x]) < 5 or max(held[x]) == i) for i, t in kept}

    def got(ix, kept):
        return {r["doc_id"]: r["text"] for r in ix.apply(spark.createDataFrame(kept, DOC)).collect()}

    ix = line_dedup.LineIndex(spark, keys_per_shard=5)
    ix.insert(spark.createDataFrame(docs[:18], DOC))
    assert got(ix, docs[:18]) == brute(docs[:18])
    ix.insert(spark.createDataFrame(docs[18:], DOC))
    assert got(ix, docs) == brute(docs)
    ix.delete(spark.createDataFrame([(i,) for i in range(10, 30)], "doc_id long"))
    assert got(line_dedup.LineIndex(spark, ix.path), docs[:10]) == brute(docs[:10])
    plain = line_dedup.LineIndex(spark, ix.path)
    line_dedup.FILTER_BYTES, kept = 0, line_dedup.FILTER_BYTES  # the way without filters
    try:
        assert got(plain, docs[:10]) == brute(docs[:10])
    finally:
        line_dedup.FILTER_BYTES = kept


# --- op7 -------------------------------------------------------------------

@pytest.mark.parametrize("hot", (1, 2000))
def test_repeated_strings_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(5)
    p, q = prose(40, rng), "ünï " * 60
    docs = [(1, prose(30, rng) + p + prose(10, rng)), (2, p[20:] + q), (3, p + " " + p), (4, q[7:] + p[:150]), (5, prose(60, rng)),
            (6, p[:99]), (7, "x" * 400), (8, None), (9, q + p + q)]
    seen, want = set(), {}
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = True
            seen.add(b[s:s + 100])
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        want[i] = (len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone]))
    got = suffix_dedup.dedup_substrings(spark, spark.createDataFrame(docs, DOC)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got} == want


# --- op3 -------------------------------------------------------------------

def test_cascade_verdict_does_not_depend_on_the_order(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names = list(quality_rules.RULES)
    a = {r["doc_id"]: r["kept"] for r in quality_rules.cascade(docs, names).collect()}
    b = {r["doc_id"]: r["kept"] for r in quality_rules.cascade(docs, names[::-1]).collect()}
    assert a == b and set(a.values()) == {True, False}
    assert sorted(quality_rules.plan_order(spark, docs)) == sorted(names)


# --- op5, op2: held-out accuracy ------------------------------------------

def test_language_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in QUERIES["op5_language_id"](spark, SF01).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got)
    assert np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in got]) > 0.97


def test_label_model_finds_accuracy_and_correlation():
    rng = np.random.default_rng(0)
    y = (rng.random(3000) < 0.3).astype(int)
    vote = lambda hit, miss: (rng.random(3000) < np.where(y == 1, hit, miss)).astype(float)
    good, weak = vote(0.8, 0.05), vote(0.4, 0.3)
    votes = np.stack([good, good, weak, vote(0.7, 0.1)], 1)  # the first two always agree
    m = toxicity.LabelModel(votes, np.where(np.arange(3000) < 300, y, -1))
    assert m.accuracy()[0] > m.accuracy()[2] and abs(m.rate1[0] - 0.8) < 0.1
    assert m.weight[0] < 0.6 < m.weight[3]
    assert ((m.posterior(votes) > 0.5) == y)[300:].mean() > 0.85


def test_toxicity_held_out(spark):
    rng = random.Random(8)
    bad = ["grubbish", "snarlo", "vexoid"]
    rows = [(i, prose(60, rng) + (" " + " ".join(rng.choices(bad, k=3)) if i % 4 == 0 else "") + " " + prose(20, rng)) for i in range(800)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 800)], "doc_id long, quality int, toxic int")
    got = [r for r in toxicity.toxicity(spark, spark.createDataFrame(rows, DOC), labels).collect() if r["held_out"]]
    assert len(got) > 100 and np.mean([(r["doc_id"] % 4 == 0) == r["predicted"] for r in got]) > 0.95


# --- op6 -------------------------------------------------------------------

def test_license_scan(spark):
    mit = license_scan.TEMPLATES["mit"]
    near = mit.replace("merge, publish", "merge or publish")
    docs = [(1, prose(40) + " " + mit.upper() + " " + prose(30)), (2, prose(9) + "\n" + near), (3, prose(200)),
            (4, "permission is hereby granted to nobody"), (5, prose(3) + " All rights  reserved. " + prose(90))]
    got = {(r["doc_id"], r["template"]): r for r in license_scan.scan(spark, spark.createDataFrame(docs, DOC)).collect()}
    assert set(got) == {(1, "mit"), (2, "mit"), (5, "all-rights-reserved")}
    assert got[1, "mit"]["n_shared"] == got[1, "mit"]["n_template"] > got[2, "mit"]["n_shared"]


@pytest.mark.parametrize("words", (5, 11, 40, 300))
def test_band_setting_guarantees_retrieval(words):
    w = license_scan.size_class(words)
    t = words - 4
    need = -(-t * 80 // 100)
    least = need / ((w - 4) + t - need)
    assert w >= 2 * words and 1 - (1 - least) ** license_scan.bands_of(w, 5, t) >= 0.999


# --- op1 -------------------------------------------------------------------

def test_near_passages(spark):
    rng = random.Random(6)
    p, q = prose(80, rng), prose(90, rng)
    docs = [(i, prose(rng.randrange(20, 90), rng) + " " + (p if i % 3 == 0 else edit(q, 3, rng) if i % 3 == 1 else "") + " " + prose(40, rng))
            for i in range(1, 31)]
    got = {r["doc_id"]: r for r in passage_dedup.near_passages(spark, spark.createDataFrame(docs, DOC)).collect()}
    assert {i for i in got if i % 3 == 0} == set(range(3, 31, 3)) and not {i for i in got if i % 3 == 2}
    assert {got[i]["class_id"] for i in got if i % 3 == 0} == {3}
    assert len({i for i in got if i % 3 == 1}) >= 8
    words = docs[2][1].lower().split()
    span = got[3]["spans"][0]
    # the span holds the passage, give or take what 0.8 lets in at its ends
    assert " ".join(p.split()[30:50]) in " ".join(words[span["first"]:span["last"] + 1]) and 49 <= span["last"] - span["first"] < 120


# --- op9 -------------------------------------------------------------------

def test_leaks_verbatim_and_paraphrased(spark):
    rng = random.Random(9)

    def prose(n, rng):  # of more words than elsewhere
        return " ".join(rng.choice(VOCAB) + rng.choice(VOCAB) for _ in range(n))

    items = [(i, prose(rng.randrange(15, 70), rng)) for i in range(12)]
    docs = []
    for i, t in items:
        w = t.split()
        loose = [x for k, x in enumerate(w) if k % 9 != 4]  # words left out
        docs += [(10 * i, prose(150, rng) + " " + t + ". " + prose(90, rng)), (10 * i + 1, prose(60, rng) + " " + " ".join(loose)),
                 (10 * i + 2, prose(200, rng))]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(
        spark, spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(10 * i + k, i) for i, _ in items for k in (0, 1)}
    assert len(want & got) >= 0.9 * len(want) and not {x for x in got if x[0] % 10 == 2}


@pytest.mark.parametrize("words", (12, 33, 64, 100))
def test_spread_paraphrases_become_candidates(words):
    """An accepted stretch, its words spread evenly, shares enough with some passage at any offset."""
    item = np.arange(1, words + 1, dtype=np.uint16)
    it = decontaminate.Items([1], [item], [None])
    size, kept = words + words // 2 + 2, -(-7 * words // 10)
    stretch = np.full(size, 60000)
    stretch[np.linspace(0, size - 1, kept).astype(int)] = item[np.linspace(0, words - 1, kept).astype(int)]
    assert decontaminate.lcs(item.tolist(), stretch.tolist()) >= 0.7 * words
    for offset in range(32):
        text = np.concatenate([np.full(64 + offset, 60000), stretch, np.full(64, 60000)])
        held = [set(text[a:a + 32].tolist()) for a in range(0, len(text), 16)]
        assert any(len(h & set(p.tolist())) >= n for h in held for p, n in zip(it.parts, it.need))


def test_lcs():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 14))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.lcs(a, b) == t[-1][-1]


def test_lcs_with_places_of_the_item():
    rng = random.Random(2)
    for _ in range(20):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        assert decontaminate.lcs(a, b, decontaminate.places(a)) == decontaminate.lcs(a, b)


def test_sums_of_short_and_long_runs(monkeypatch):
    rng = np.random.default_rng(4)
    y, n = rng.normal(size=(50, 3)).astype(np.float32), np.array([1, 300, 2, 24, 23, 1, 77])
    at, first = rng.integers(0, 50, n.sum()), np.cumsum(n) - n
    got = decontaminate._sum_runs(y, at, first)
    assert np.allclose(got, [y[at[a:a + k]].sum(axis=0) for a, k in zip(first, n)], atol=1e-4)


def test_words_are_hashed_once(monkeypatch):
    """A word with punctuation at its ends has the id of the word without; one pass over the bytes."""
    calls, real = [], _text.prefix_hash
    monkeypatch.setattr(_text, "prefix_hash", lambda *a, **k: calls.append(1) or real(*a, **k))
    monkeypatch.setattr(decontaminate, "prefix_hash", _text.prefix_hash, raising=False)
    ids, first = decontaminate.word_ids(*buffer_of(pa.array(["Cat, (dog) ... \u00e9!", "", 'cat dog . "((\u00e9))"'])))
    assert first.tolist() == [0, 4, 4, 8] and ids[:4].tolist() == ids[4:].tolist() and len(calls) == 1


@pytest.mark.parametrize("words", (20, (1 << 14) - 1, 1 << 14))
def test_stretches_within_reach(words):
    """Sums that wrap around find the stretches that plain sums find."""
    rng = np.random.default_rng(7)
    it = decontaminate.Items([1, 2], [np.arange(1, words + 1), np.arange(5, 25)], [None, None])
    m = rng.integers(1, 60, (600, decontaminate.HALF)).astype(np.uint16) if words == 20 else (
        np.arange(6000 * decontaminate.HALF).reshape(-1, decontaminate.HALF) % (words + 9000)).astype(np.uint16)
    row = np.sort(rng.integers(0, 3, len(m)))
    count = it.counts(it.holds[m])
    got = it.within_reach(count, row)
    for i, w in enumerate(it.words):
        halves, reach = -(-(len(w) + len(w) // 2 + 1) // decontaminate.HALF) + 1, -(-2 * len(w) // decontaminate.HALF) + 1
        total = np.concatenate([[0], np.cumsum(count[:, i], dtype=np.int64)])
        for p in range(0, len(m), 7):
            a, b = np.searchsorted(row, row[p], "left"), np.searchsorted(row, row[p], "right")
            at = np.arange(max(a, p - reach), min(b, p + reach + 2))
            assert got[p, i] == (total[np.minimum(at + halves, b)] - total[at] >= it.least[i]).any()


def test_query_finds_every_verbatim_item(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF01}/benchmark.parquet").collect()
    flat = lambda t: re.sub(r"\s+", " ", (t or "").lower())
    want = {(d["doc_id"], b["item_id"]) for d in docs for b in items if flat(b["text"]) in flat(d["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_benchmark_decontamination"](spark, SF01).collect()}
    assert want and len(want & got) >= 0.98 * len(want)


# --- op8 -------------------------------------------------------------------

def test_packing_against_brute_force():
    rng = random.Random(2)
    n = np.array(sorted((rng.randrange(1, 1025) for _ in range(400)), reverse=True))
    sizes = (128, 256, 512, 1024)
    b, off, size = packing.pack_pieces(n, sizes)
    room, used, opened = [], [], []
    for i, x in enumerate(n.tolist()):
        fit = min(((r, k) for k, r in enumerate(room) if r >= x), default=None)
        if fit:
            assert room[b[i]] == fit[0]
        else:
            assert b[i] == len(room)
            rest = n[i + 1:]
            s = min((s for s in sizes if s >= x),
                    key=lambda s: (packing.cost(s) / min(s, x + int(rest[rest <= s - x].sum())), s))
            room.append(s)
            used.append(0)
            opened.append(s)
        assert off[i] == used[b[i]]
        room[b[i]] -= x
        used[b[i]] += x
    assert size.tolist() == [min(min(s for s in sizes if s >= u), o) for u, o in zip(used, opened)]


def test_packing_places_every_token_once(spark):
    got = QUERIES["op8_best_fit_packing"](spark, SF01).toPandas()
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: len(re.findall(rb"[^\x20\x09-\x0D]+", (r["text"] or "").encode())) + 1 for r in docs}
    assert got.groupby("doc_id").n_tokens.sum().to_dict() == want
    for _, g in got.sort_values("bin_offset").groupby("bin_id"):
        assert (g.bin_offset.to_numpy()[1:] == (g.bin_offset + g.n_tokens).to_numpy()[:-1]).all()
        assert g.n_tokens.sum() <= g.bin_size.iloc[0] and g.bin_size.iloc[0] in packing.SIZES


# --- pipeline --------------------------------------------------------------

def test_pipeline_against_its_parts(spark):
    """The rows of run() from brute-force stages: what goes, and what is packed."""
    import corpus_pipeline as cp
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs if any(c.isalpha() for c in r["text"] or "")}
    strip = " \t\n\x0b\x0c\r"
    low = lambda x: x.encode().lower().decode()
    held = defaultdict(set)
    for i, t in texts.items():
        for x in t.split("\n"):
            held[low(x.strip(strip))].add(i)
    gone = lambda x, i: len(k := low(x.strip(strip))) >= 40 and len(held[k]) >= 5 and max(held[k]) != i
    texts = {i: "\n".join(x for x in t.split("\n") if not gone(x, i)) for i, t in texts.items()}
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    comp = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                lo, hi = sorted((comp[i], comp[j]))
                comp = {k: lo if c == hi else c for k, c in comp.items()}
    texts = {i: t for i, t in texts.items() if comp[i] == i}
    flat = lambda t: re.sub(r"\s+", " ", t.lower())
    items = [flat(r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = {i: len(t.encode().split()) + 1 for i, t in texts.items() if not any(b in flat(t) for b in items)}
    got = cp.run(spark, SF001).toPandas()
    assert got.groupby("doc_id").n_tokens.sum().to_dict() == want


def test_kept_hashes_are_of_the_text_left(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (2, None)], DOC)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark, docs).collect()}
    assert got == {1: "a\nb", 2: ""} and hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_language_windows_cover_the_text():
    buf = np.frombuffer(("x" * 300 + "yz").encode(), np.uint8)
    w, row, n = language_id.cut(buf, np.array([0, 300, 300, 302]))
    assert n.tolist() == [128, 128, 44, 2] and row.tolist() == [0, 0, 0, 2] and bytes(w[3][:2]) == b"yz"
