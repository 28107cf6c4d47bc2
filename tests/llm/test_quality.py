"""Quality rules and the quality classifier."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strata.llm import quality_classifier as knn
from strata.llm import quality_rules as rules
from strata.llm.common import table

SF = "/root/testdata/sf0.001"


def _base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if n[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def _chain(*parts):
    """Spark's xxhash64 of several strings: each is hashed with the hash before as seed."""
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed=seed)
    return (seed - (1 << 64) if seed >= 1 << 63 else seed) % rules.N_BUCKETS


def _grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return ([_chain("word", x) for x in w] + [_chain("end", x[-2:]) for x in w]
            + [_chain("pair", a, b) for a, b in zip(w, w[1:], strict=False)])


def test_rules_equal_brute_force(spark, documents, labels, texts):
    got = rules.score(documents, labels).collect()
    assert len(got) == len(texts)
    judged = {}
    for r in labels.collect():
        if r["doc_id"] is not None:
            judged.setdefault(r["doc_id"], []).append(r["quality"] == 1 and (r["toxic"] or 0) == 0)
    trusted = {i for i, v in judged.items() if all(v)}
    raw, target = Counter(), Counter()
    for i, t in texts:
        g = Counter(_grams(t))
        raw.update(g)
        if i in trusted:
            target.update(g)
    total = sum(raw.values()) + rules.N_BUCKETS
    target_total = sum(target.values()) + rules.N_BUCKETS
    ratio = {}
    for b in range(rules.N_BUCKETS):
        share = (raw[b] + 1) / total
        ratio[b] = math.log((target[b] + rules.N_BUCKETS * share) / target_total) - math.log(share)
    expected = Counter()
    for i, t in texts:
        g = _grams(t)
        mean = sum(ratio[b] for b in g) / len(g) if g else 0.0
        expected[(i, *_base(t), not _base(t)[-1] and mean >= rules.MIN_RATIO, round(mean, 9))] += 1
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                    r["base_failed"], r["kept"], round(r["ratio"], 9)) for r in got) == expected


def test_rules_keep_columns_and_empty_tables(documents, no_documents, labels):
    kept = rules.keep_passing(documents, labels)
    assert kept.columns == documents.columns and 0 < kept.count() < documents.count()
    assert rules.keep_passing(no_documents, labels).count() == 0
    assert rules.score(documents, labels.limit(0)).where("ratio != 0").count() == 0


def test_rules_plan_has_no_python(documents, labels):
    plan = rules.score(documents, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rules_count_without_a_function_call_per_ngram(documents, labels):
    plan = rules.count_ngrams(documents, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "xxhash64" in plan


def _repeats_found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = rules.with_rules(docs, np.zeros(rules.N_BUCKETS), docs["doc_id"]).collect()
    return {r["_k0"]: r["n_repeat_words"] for r in got}


def test_windows_with_one_hash_are_compared_by_words(spark, monkeypatch):
    rows = list(enumerate(["a b c a b c", "a b c d e f a b c", "a b c d e f", "a a a a", "a b", "", "x y x y x z y x y " * 9, None]))
    expected = {i: _base(t)[4] for i, t in rows}
    assert _repeats_found(spark, rows) == expected
    with monkeypatch.context() as m:  # more words than there are places
        m.setattr(rules, "PLACE_BITS", 2)
        assert _repeats_found(spark, rows) == expected
    # every window has the same hash
    same = rules._window_hashes
    monkeypatch.setattr(rules, "_window_hashes", lambda pairs: F.transform(same(pairs), lambda h: F.lit(0).cast("bigint")))
    assert _repeats_found(spark, rows) == expected


def test_classifier_defined_results(documents, no_documents, labels, texts):
    rows = knn.classify(documents, labels).collect()
    assert len(rows) == len(texts)
    by_id = {}
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        by_id.setdefault(r["doc_id"], []).append(r["score"])
    assert by_id[0] == by_id[20] == by_id[21] and by_id[50][0] == by_id[50][1]
    assert by_id[30] == by_id[31] == by_id[32]
    assert knn.classify(no_documents, labels).count() == 0
    assert {r["score"] for r in knn.classify(documents, labels.limit(0)).collect()} == {0.5}
    assert knn.keep_good(documents, labels).columns == documents.columns


def test_sample_takes_a_repeated_id_once(spark):
    docs = spark.createDataFrame([(1, f"text {i:03}") for i in range(300)] + [(i, f"other {i}") for i in range(2, 40)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1)] * 50 + [(i, i % 2) for i in range(2, 40)], "doc_id long, quality int")
    got = [tuple(r) for r in knn.labelled_sample(docs, marks, per_class=100).collect()]
    learned = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 5]
    assert sorted(got) == [(i, "text 000" if i == 1 else f"other {i}", i % 2) for i in learned] and 1 in learned
    few = knn.labelled_sample(docs, marks, per_class=5).collect()
    assert len(few) == 10 and len({r["_id"] for r in few}) == 10


def _first_votes(cosines, k):
    """Neighbours in the order of their cosines to five places, then of the sample."""
    return sorted(range(len(cosines)), key=lambda j: (-round(cosines[j] * 1e5), j))[:k]


def test_votes_equal_brute_force():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.4, (60, 40)).astype(np.float32)
    counts[20:30] = counts[5]  # ties, some of them for the last vote
    model = knn.fit_knn(counts[:40], (rng.random(40) > 0.4).astype(float), n_dims=8, k=5)
    got = model.score(counts)
    points, docs = model.vectors, model.embed(counts)
    for d, score in zip(docs, got, strict=True):
        cosine = points @ d
        near = _first_votes(cosine, 6)
        if 0 < cosine[near[4]] - cosine[near[5]] < 2e-5:
            continue  # rounding may order these two either way
        w = [max(float(cosine[j]), 0) ** 8 for j in near[:5]]
        expected = (sum(a * model.labels[j] for a, j in zip(w, near, strict=False)) + 1e-6 * model.prior) / (sum(w) + 1e-6)
        assert abs(score - expected) < 1e-3


def _shape(word):
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word]
    return "".join(c for i, c in enumerate(kinds) if i == 0 or kinds[i - 1] != c)


def _terms(text):
    """Term counts of a whole text, by plain loops."""
    def slot(value):
        return zlib.crc32(value.encode()) % knn.N_TERMS

    words = (text or "").split()
    row = np.zeros(knn.N_TERMS)
    if not words:
        return row
    plain, shapes = [slot(w.lower()) for w in words], [slot("shape:" + _shape(w)) for w in words]
    for at in plain + shapes:
        row[at] += 1
    for x, y in zip(shapes, shapes[1:], strict=False):
        row[(x * 31 + y * 17 + 7) % knn.N_TERMS] += 1
    row[slot("again:word")] += sum(x == y for x, y in zip(plain, plain[1:], strict=False))
    row[slot(f"share:{8 * max(Counter(plain).values()) // len(words)}")] += len(words) // 8 + 1
    return row


def test_shapes_and_terms_are_of_whole_words():
    word = "aB" * 20 + "1"
    assert knn.word_shape(word) == _shape(word) and len(_shape(word)) == 41
    assert knn.word_shape(word) != knn.word_shape(word[:-1])
    text = f"Ab1-2 {word} {word[:-1]} the The the 12 ## a1a1a1a1a1a1a1a1 {'x1' * 500}"
    assert (knn.Terms().counts(text) == _terms(text)).all()


def test_classifier_equals_brute_force(spark):
    """The whole query by plain Python: sample, terms, exact singular vectors, all cosines."""
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    texts = dict(docs.select("doc_id", "text").collect())
    per_class = 30
    pool = {1: [], 0: []}
    for r in labels.collect():
        i = r["doc_id"]
        if i is not None and r["quality"] in pool and zlib.crc32(str(i).encode()) % 5 and texts.get(i) is not None:
            h = xxhash.xxh64_intdigest(str(i).encode(), seed=42)
            pool[r["quality"]].append((h - (1 << 64) if h >= 1 << 63 else h, i))
    sample = sorted((i, q) for q, found in pool.items() for _, i in sorted(found)[:per_class])
    assert len(sample) == 2 * per_class

    def unit(m):
        size = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(size > 0, size, 1)

    counts = np.stack([_terms(texts[i]) for i, _ in sample])
    idf = np.log((1 + len(sample)) / (1 + (counts > 0).sum(axis=0))) + 1
    rows = unit(np.log1p(counts) * idf)
    basis = np.linalg.svd(rows, full_matrices=False)[2].T
    vectors, marks = unit(rows @ basis), [q for _, q in sample]
    border = 0
    got = knn.classify(docs, labels, per_class=per_class).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        own = unit((np.log1p(_terms(texts[r["doc_id"]])) * idf)[None])
        cosine = vectors @ unit(own @ basis)[0]
        near = _first_votes(cosine, knn.NEIGHBOURS + 1)
        if cosine[near[-2]] - cosine[near[-1]] < 1e-4:
            border += 1
            continue  # single precision may order these two either way
        w = [max(float(cosine[j]), 0) ** 8 for j in near[:-1]]
        expected = (sum(a * marks[j] for a, j in zip(w, near, strict=False)) + 1e-6 * np.mean(marks)) / (sum(w) + 1e-6)
        assert abs(r["score"] - expected) < 2e-3
    assert border < len(got) // 10


def test_classifier_held_out_ranking(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    rows = knn.classify(docs, labels).where("held_out").join(labels, "doc_id").select("score", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) > 0.97 * len(good) * len(bad)
