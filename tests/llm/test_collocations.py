"""Collocations against plain counting, and the parse against the sequence it cuts."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pytest

from strata.llm import collocations as co
from strata.llm.common import table


def plain(rows, least, top):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for k in range(1, 6):
                counts.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {key: n for key, n in counts.items() if n >= least}
    out = {}
    for (lang, p), a in found.items():
        if len(p) < 2:
            continue
        if any(g[0] == lang and len(g[1]) > len(p) and 100 * n >= 100 * a and any(g[1][i:i + len(p)] == p for i in range(len(g[1]) - len(p) + 1))
               for g, n in found.items()):
            continue
        cuts = []
        for c in range(1, len(p)):
            left, right = found[lang, p[:c]], found[lang, p[c:]]
            cuts.append((1000 * a * total[lang] // (left * right), c, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, left, right, total[lang], -score)
            for lang, some in out.items() for i, (score, a, p, left, right) in enumerate(sorted(some)[:top])}


def prose(rng, n):
    words = ["the", "The", "of", "a", "new", "York", "city", "état", "x-y", "日本", "in"]
    fixed = ["New York city of the", "état\tof a", "in the new", "a a a a a a"]
    return " ".join(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) + rng.choice(["", "", "", ",", ".", " ;", "\n", "  "]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = [prose(rng, rng.choice([1, 5, 60, 200])) for _ in range(120)]
    texts += texts[:20] + [prose(rng, 30) + " " + texts[21] + " " + prose(rng, 30) for _ in range(10)]
    texts += [None, "", " \t ", "...", ". , ;", "a" * 5000, "b " * 4000, "a.b.c." * 50, "it is   one\x1cword \x85x"]
    return [(rng.choice(["en", "en", "fr", None, "und", ""]), t) for t in texts]


def run(spark, rows, **args):
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    return {tuple(r) for r in co.collocations(frame, **args).collect()}


@pytest.mark.parametrize("least,top", [(5, 2000), (20, 7)])
def test_equals_plain_counting(spark, rows, least, top):
    expected = plain(rows, least, top)
    assert len(expected) > 10 and run(spark, rows, least=least, top=top) == expected


def test_small_slices_caches_and_filters(spark, rows, monkeypatch):
    """Bounds of memory change nothing: tiny slices and sums, and filters that let nearly everything through.

    Functions sent to tasks take a module's names as they are in the worker, so the driver's parts are patched here.
    """
    expected = [list(co.chunks_of(t)) for _, t in rows]
    monkeypatch.setattr(co, "_SLICE", 7)
    assert [list(co.chunks_of(t)) for _, t in rows] == expected
    monkeypatch.setattr(co, "filter_of", lambda keys: co.np.full(1 << co.FILTER_BITS - 5, 0xFFFFFFFF, co.np.uint32))
    assert run(spark, rows, least=5) == plain(rows, 5, 2000)


def test_chunks_overlap_by_a_window_and_follow_content():
    rng = random.Random(3)
    text = " ".join(str(rng.randrange(50)) for _ in range(5000))
    chunks = [c.split(b" ") for c, _ in co.chunks_of(text)]
    joined = chunks[0] + [w for c in chunks[1:] for w in c[co.WINDOW:]]
    assert joined == text.encode().split() and all(a[-co.WINDOW:] == b[:co.WINDOW] for a, b in zip(chunks, chunks[1:], strict=False))
    moved = {c for c, _ in co.chunks_of("some words before " + text)}
    assert len(moved & {c for c, _ in co.chunks_of(text)}) >= len(chunks) - 2


def test_sql_and_clashing_columns(spark):
    path = "/root/testdata/sf0.001"
    docs = table(spark, path, "documents")
    for name in ("phrase", "f", "k", "rank", "chunk", "n"):
        docs = docs.withColumn(name, docs["text"])
    got = {tuple(r) for r in co.collocations(docs, least=20).collect()}
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    assert got and got == set(db.sql(co.oracle_sql(least=20)).fetchall())


def test_empty_table(no_documents):
    assert co.collocations(no_documents).count() == 0


def test_products_beyond_64_bits(spark):
    big = 40_000_000_000
    rows = [("en", "", 0, 9 * big), ("en", "a", 1, 3 * big), ("en", "b", 1, 2 * big), ("en", "a b", 2, big)]
    r = co.scored(spark.createDataFrame(rows, "lang string, phrase string, k int, f long")).collect()
    assert [tuple(x) for x in r] == [("en", "a b", big, 3 * big, 2 * big, 9 * big, 1000 * 9 * big * big // (6 * big * big))]
