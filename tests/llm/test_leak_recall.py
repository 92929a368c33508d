"""Benchmark decontamination against brute force over all stretches: verbatim
and paraphrased leaks, of the whole operator and of the cosine search alone."""
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF01
from wardstat.llm import decontaminate as D
from wardstat.llm._store import keep
from wardstat.llm._text import buffer_of, id_text

DOC = "doc_id long, text string"
ITEM = "item_id long, text string"


def ids_of(text):
    return D.word_ids(*buffer_of(pa.array([text], pa.string())))[0]


def paraphrase(words, rng, strangers):
    """Some words left out, some replaced, some put in between."""
    out = []
    for w in words:
        x = rng.random()
        if x < 0.08:
            continue
        out.append(rng.choice(strangers) if x < 0.16 else w)
        if rng.random() < 0.12:
            out.append(rng.choice(strangers))
    return " ".join(out)


@pytest.fixture(scope="module")
def case(spark):
    """A third of the documents as they are; some with an item, some with a paraphrase of one put in."""
    rng = random.Random(4)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
            if r["text"] and r["doc_id"] % 3 == 0 and len(r["text"]) < 8000]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").select("item_id", "text").collect()]
    strangers = [w for _, t in docs for w in t.split()]
    put = []
    for k, (i, text) in enumerate(items):
        for j in range(3):
            host = docs[(7 * k + 13 * j) % len(docs)][1].split()
            cut = rng.randrange(len(host) + 1)
            put.append((10_000 + 10 * k + j, " ".join(host[:cut]) + " " + (text if j == 0 else paraphrase(text.split(), rng, strangers))
                        + " " + " ".join(host[cut:])))
    return docs + put, items


@pytest.fixture(scope="module")
def truth(case):
    """Pairs that the verdict accepts on some stretch, at any start."""
    docs, items = case
    out = {}
    for d, text in docs:
        t = ids_of(text)
        for i, item in items:
            w = ids_of(item)
            size = len(w) + len(w) // 2 + 2
            answer = w[-max(1, len(w) // 4):].tolist()
            held = np.concatenate([[0], np.cumsum(np.isin(t, w))])
            starts = np.arange(max(1, len(t) - size + 1))
            count = held[np.minimum(starts + size, len(t))] - held[starts]
            for a in starts[count >= math.ceil(D.PARAPHRASE * len(w) - 1e-9)].tolist():  # no other can hold it
                part = t[a:a + size].tolist()
                full = D.lcs(w.tolist(), part) / len(w)
                if full >= D.VERBATIM or full >= D.PARAPHRASE and D.lcs(answer, part) / len(answer) >= D.ANSWER:
                    out[d, i] = max(full, out.get((d, i), 0.0))
    return out


def test_recall_of_the_operator(spark, case, truth):
    docs, items = case
    got = {(r["doc_id"], r["item_id"]) for r in
           D.find_leaks(spark, spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).collect()}
    assert got <= set(truth)  # nothing that brute force does not accept
    verbatim = {p for p, full in truth.items() if full >= D.VERBATIM}
    loose = set(truth) - verbatim
    assert len(verbatim) >= 40 and len(loose) >= 20
    print(f"recall: verbatim {len(got & verbatim)}/{len(verbatim)}, paraphrased {len(got & loose)}/{len(loose)}")
    assert len(got & verbatim) >= 0.98 * len(verbatim)
    assert len(got & loose) >= 0.9 * len(loose)


def test_recall_of_the_cosine_search_alone(spark, case, truth):
    docs, items = case
    table = keep(spark, D.id_table(id_text(spark.createDataFrame(docs, DOC))), "recall")
    df, n = D.frequencies(table)
    words = D.latent_space(table, np.log((1 + n) / (1 + df)))
    texts, by_item = dict(docs), dict(items)
    found = 0
    for d, i in truth:
        m, mask, _ = D.passages([ids_of(texts[d]).tobytes()], D.HALF)
        half = D._embed(m, mask, words)
        half[:-1] += half[1:]
        w = ids_of(by_item[i])
        queries = D._unit(np.stack([words[p].sum(axis=0) for p in np.array_split(w, max(1, -(-len(w) // D.QUERY_WORDS)))]))
        found += bool((D._unit(half) @ queries.T >= D.COSINE).any())
    print(f"cosine search alone: {found}/{len(truth)}")
    assert found >= 0.9 * len(truth)


def test_word_bound_loses_no_stretch(case):
    """Where the exact counts say no, brute force finds no leak."""
    docs, items = case
    it = D.Items([i for i, _ in items], [ids_of(t) for _, t in items], [None] * len(items))
    rng = random.Random(6)
    kept = 0
    for d, text in rng.sample(docs, 60):
        t = ids_of(text)
        m, mask, row = D.passages([t.tobytes()], D.HALF)
        dense = it.holds[m] * mask
        p, i = np.divmod(np.arange(len(m) * len(items)), len(items))
        may = it.within_reach(it.counts(dense), row)
        exact = it.word_by_word(dense, row, p, i).reshape(len(m), len(items))
        assert not (exact & ~may).any()  # the coarse bound keeps what the exact one keeps
        kept += exact.any(axis=0).sum()
        for k, (_, item) in enumerate(items):
            if not exact[:, k].any():
                w = ids_of(item)
                size = int(it.stretch[k])
                at = rng.randrange(max(1, len(t) - size + 1))
                assert D.lcs(w.tolist(), t[at:at + size].tolist()) < D.PARAPHRASE * len(w)
    assert 0 < kept < 0.2 * 60 * len(items)
