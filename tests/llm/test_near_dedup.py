"""Near-duplicates against all pairs, components against a union-find, and the posterior bounds."""

from __future__ import annotations

import random

import numpy as np
import pytest

from strata.llm import near_dedup as near
from strata.llm.common import table
from strata.llm.components import components


def _least(pairs, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def _expected(texts, width):
    sets = {}
    for i, t in texts:
        if i is not None:
            sets.setdefault(i, []).append(near.shingle_set(t, width))
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b])]
    return _least(links, ids)


@pytest.mark.parametrize("width", [2, 5])
def test_classes_equal_all_pairs(documents, texts, width):
    rows = near.classes(documents, width).collect()
    assert len(rows) == len(texts)
    expected = _expected(texts, width)
    for r in rows:
        assert r["component_id"] == expected.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    sizes = sorted((r["doc_id"] or -1, r["n_shingles"]) for r in rows)
    assert sizes == sorted((i or -1, len(near.shingle_set(t, width))) for i, t in texts)


def test_hub_with_spokes_and_chains(spark):
    """Spokes alike to the hub but not to each other, and a chain whose ends are unlike."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = [(1000, " ".join(base))]
    for k in range(60):
        w = list(base)
        for at in rng.sample(range(300), 14):
            w[at] = f"x{k}_{at}"
        rows.append((k, " ".join(w)))
    chain = [f"c{i}" for i in range(200)]
    for k in range(8):
        chain[k * 20:k * 20 + 10] = [f"d{k}_{i}" for i in range(10)]
        rows.append((2000 + k, " ".join(chain)))
    got = {r["doc_id"]: r["component_id"] for r in near.classes(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == _expected(rows, 2)


def test_keep_one(documents, no_documents, texts):
    kept = near.keep_one(documents)
    assert kept.columns == documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    expected = _expected(texts, 5)
    assert sorted(i for i in ids if i is not None) == sorted(i for i in expected if expected[i] == i)
    assert ids.count(None) == 2
    assert near.keep_one(no_documents).count() == 0 and near.classes(no_documents).count() == 0


def test_ids_that_repeat_with_different_texts(spark):
    """Every text of a repeated id is searched, and unlike texts of a kept id all stay."""
    rng = random.Random(6)
    base = [[f"{k}_{rng.randrange(10_000)}" for _ in range(200)] for k in range(12)]

    def near_copy(k, n=0):
        return " ".join(base[k] + [f"more{n}"])

    text = [" ".join(b) for b in base]
    rows = [(1, text[k]) for k in range(6)] + [(10 + k, near_copy(k)) for k in range(6)]  # near copies of each text of one id
    rows += [(30, near_copy(6)), (31, text[6]), (31, text[7]), (32, near_copy(7)), (32, near_copy(8)), (33, text[8])]  # a chain by ids
    rows += [(40, text[9]), (40, near_copy(9)), (40, text[10]), (40, ""), (40, None), (41, text[11]), (41, text[11])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = _expected(rows, 2)
    assert set(expected.values()) == {1, 30, 40, 41}
    assert {(r["doc_id"], r["component_id"]) for r in near.classes(docs, 2).where("n_shingles > 0").collect()} == set(expected.items())
    kept = sorted((r["doc_id"], r["text"] or "") for r in near.keep_one(docs, 2).collect())
    assert kept == sorted([(1, t) for t in text[:6]] + [(30, near_copy(6)), (40, text[9]), (40, text[10]), (40, ""), (41, text[11])])


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    expected = _expected([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 2)
    assert {r["doc_id"]: r["component_id"] for r in near.classes(docs, 2).collect()} == expected


def test_components(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(5, None)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    pairs = [p for p in pairs if p[1] is not None]
    least = _least(pairs, {x for p in pairs for x in p})
    assert got == {n: c for n, c in least.items() if n != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pruning_keeps_similar_pairs_and_drops_unlike_ones():
    bounds = near.prune_bounds()
    assert [n for n, _ in bounds] == list(range(near.BATCH, near.N_HASHES + 1, near.BATCH))
    rng = np.random.default_rng(1)
    left = rng.integers(0, 256, (20_000, near.N_HASHES), dtype=np.uint8)

    def partner(similarity):
        same = rng.random(left.shape) < similarity
        return np.where(same, left, rng.integers(0, 256, left.shape, dtype=np.uint8))

    assert len(near.survivors(left, partner(0.8), bounds)) >= len(left) - 2
    assert len(near.survivors(left, partner(0.5), bounds)) == 0
