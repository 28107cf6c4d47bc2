"""SimHash classes against all pairs, the embedding's bound, and grids that lose no pair."""

from __future__ import annotations

import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash_dedup as sim
from strata.llm.common import table


def plain_print(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) if w]
    shingles = [words[i:i + 4] for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows):
    """``{(doc_id, print): least id}`` over rows with an id."""
    nodes = sorted({(i, p) for i, p in rows if i is not None})
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, y in itertools.combinations(nodes, 2):
        if x[0] == y[0] or (x[1] ^ y[1]).bit_count() <= 4:
            a, b = root(x), root(y)
            up[max(a, b)] = min(a, b)
    return {n: root(n)[0] for n in nodes}


def check(documents, rows):
    prints = [(i, plain_print(t)) for i, t in rows]
    expected = plain_classes(prints)
    got = sorted((r["doc_id"] is None, r["doc_id"], r["fingerprint"], r["component_id"]) for r in documents.collect())
    assert got == sorted((i is None, i, f"{p:016x}", expected.get((i, p))) for i, p in prints)


def test_awkward_rows(documents, texts, no_documents):
    check(sim.classes(documents), texts)
    assert sim.classes(no_documents).count() == 0


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    check(sim.classes(docs), [tuple(r) for r in docs.collect()])


def test_long_texts_are_read_whole(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefghij") for _ in range(700))
    monkeypatch.setattr(sim, "_SLICE", 50)
    assert sim.fingerprint(text) == plain_print(text)
    assert sim.fingerprint(None) == sim.fingerprint(" \n") == 0


def flipped(rng, value, n):
    for b in rng.sample(range(64), n):
        value ^= 1 << b
    return value


def test_embedding_bounds_the_distance_and_grids_meet(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(2000):
        a = rng.getrandbits(64)
        pairs.append((sim._signed(a), sim._signed(flipped(rng, a, rng.randrange(0, 12)))))

    def counts(value):
        return [(value >> s & 3).bit_count() for s in range(0, 64, 2)]

    frame = spark.createDataFrame(pairs, "a long, b long").select(
        "a", "b", sim.embedding(F.col("a")).alias("x"), sim.embedding(F.col("b")).alias("y"))
    frame = frame.withColumn("apart", sim._bits_apart(F.col("x"), F.col("y")))
    assert len(sim.GRIDS) == 70
    for r in frame.collect():
        a, b = r["a"] % (1 << 64), r["b"] % (1 << 64)
        assert r["apart"] == sum(abs(p - q) for p, q in zip(counts(a), counts(b), strict=True)) <= (a ^ b).bit_count()
        if (a ^ b).bit_count() <= 4:
            assert any(r["x"] & m == r["y"] & m for m in sim.GRIDS)


@pytest.mark.parametrize("spread", [2, 5, 9])
def test_dense_groups_and_chains(spark, spread):
    """Prints scattered around a few centres: links by stars, between components, and through chains."""
    rng = random.Random(spread)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints |= {flipped(rng, centre, rng.randrange(0, spread + 1)) for _ in range(150)}
    step = rng.getrandbits(64)
    for _ in range(40):
        prints.add(step := flipped(rng, step, 4))
    nodes = [sim._signed(p) for p in sorted(prints)]
    found = {r["node"]: r["component"] for r in sim.link_classes(spark.createDataFrame([(p,) for p in nodes], "print long")).collect()}
    expected = plain_classes([(p, p % (1 << 64)) for p in nodes])
    assert {p: found.get(p, p) for p in nodes} == {p: expected[(p, p % (1 << 64))] for p in nodes}
