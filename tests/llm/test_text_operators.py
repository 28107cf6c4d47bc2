"""Language identification, fingerprints and chat formatting."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import chat_format as chat
from strata.llm import fingerprints as prints
from strata.llm import language_id as lang
from strata.llm.common import table


# --- language ---------------------------------------------------------------

def test_kernel_counts_shared_ngrams():
    make = lang.Presence()

    def grams(text):
        letters = re.sub(r"\s+", " ", " " + "".join(c.lower() if c.isalpha() else " " for c in text) + " ")
        return {letters[i:i + n] for n in lang.ORDERS for i in range(len(letters) - n + 1)}

    rng = random.Random(1)
    for _ in range(30):
        a, b = ("".join(rng.choice("abcdeñß 1.") for _ in range(rng.randrange(2, 60))) for _ in range(2))
        x, y = make.bits(a), make.bits(b)
        if x is None or y is None:
            assert not any(c.isalpha() for c in (a if x is None else b))
            continue
        # hashing can only join n-grams
        assert 0 <= len(grams(a)) - x.sum() <= 3
        assert abs(int((x & y).sum()) - len(grams(a) & grams(b))) <= 4


def test_long_texts_are_seen_whole(monkeypatch):
    make = lang.Presence()
    text = "abc" * 400 + " xyz"
    whole = make.bits(text)
    monkeypatch.setattr(lang, "_LONG", 50)
    assert (make.bits(text) == whole).all()


def test_scores_equal_plain_ridge_regression():
    rng = np.random.default_rng(2)
    bits = rng.random((60, lang.N_BITS)) < 0.01
    for k in range(3):
        bits[k::3, k * 40:(k + 1) * 40] |= rng.random((20, 40)) < 0.6
    names = ["a", "b", "c"] * 20
    model = lang.fit_kernel(bits, names, n_landmarks=30)
    unit = bits / np.sqrt(bits.sum(axis=1, keepdims=True))
    marks = model.landmarks.T.astype(float)
    k_nm, k_mm = unit @ marks.T, marks @ marks.T
    target = (np.array(names)[:, None] == np.array(["a", "b", "c"])).astype(float) / 20
    # min |K w - y|^2 / 20 + ridge w' K_mm w, solved in the dual weights
    w = np.linalg.solve(k_nm.T @ k_nm / 20 + lang.RIDGE * k_mm, k_nm.T @ target)
    assert np.abs(model.kernels(bits) @ model.weights - k_nm @ w).max() < 1e-2
    best, _ = model.predict(bits)
    assert (best == np.arange(60) % 3).mean() > 0.95


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = lang.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) > 0.97 * len(rows)


def test_language_sample_takes_a_repeated_id_once(spark):
    learned = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 3 != 1][:500]
    rows = [(i, f"text {i}", "en") for i in learned] + [(learned[0], f"z {k}", "en") for k in range(2000)] + [(learned[1], "de", "de"), (learned[0], None, "en")]
    got = lang.learning_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    english = [(r["_id"], r["_text"]) for r in got if r["_lang"] == "en"]
    assert len(english) == lang.PER_LANGUAGE == len({i for i, _ in english}) and all(t == f"text {i}" for i, t in english)
    assert [(r["_id"], r["_text"]) for r in got if r["_lang"] == "de"] == [(learned[1], "de")]


def _signed_hash(i):
    h = xxhash.xxh64_intdigest(str(i).encode(), seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


def _presence(text):
    """Numbers of the presence bits of a whole text, by plain loops; None without a letter."""
    letters = re.sub(" +", " ", " " + "".join(c.lower()[0] if c.isalpha() and c.lower()[0].isalpha() else " " for c in text or "") + " ")
    if letters == " ":
        return None
    found = set()
    for n in lang.ORDERS:
        for i in range(len(letters) - n + 1):
            h = 0
            for m, c in enumerate(letters[i:i + n], 1):
                h = (((h * 0x01000193) & 0xFFFFFFFF) ^ ord(c)) * 0x9E3779B1 + m & 0xFFFFFFFF
            found.add((h ^ h >> 15) % lang.N_BITS)
    return found


def test_languages_equal_brute_force(spark):
    """The whole query by plain Python: sample, presence sets, kernels, one-versus-rest ridge regression."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang")
    rows = docs.collect()
    sets = {r["doc_id"]: _presence(r["text"]) for r in rows}
    learnable = [(r["doc_id"], r["lang"]) for r in rows if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    names = sorted({x for _, x in learnable})
    sample = sorted(s for x in names for s in sorted((s for s in learnable if s[1] == x), key=lambda s: _signed_hash(s[0]))[:lang.PER_LANGUAGE])
    sample = [s for s in sample if sets[s[0]]]
    turn, seen = [], Counter()
    for _, x in sample:
        turn.append((seen[x], names.index(x)))
        seen[x] += 1
    chosen = sorted(range(len(sample)), key=lambda k: turn[k])[:lang.N_LANDMARKS]
    marks = [sets[sample[k][0]] for k in chosen]

    def kernel(x, y):
        return len(x & y) / (len(x) * len(y)) ** 0.5

    k_nm = np.array([[kernel(sets[i], m) for m in marks] for i, _ in sample])
    k_mm = np.array([[kernel(x, m) for m in marks] for x in marks])
    weigh = np.array([1 / seen[x] for _, x in sample])[:, None]
    target = np.array([[x == y for y in names] for _, x in sample], float)
    w = np.linalg.lstsq(k_nm.T @ (k_nm * weigh) + lang.RIDGE * k_mm, k_nm.T @ (target * weigh), rcond=None)[0]
    got = lang.identify(docs).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(sets)
    for r in got:
        if sets[r["doc_id"]] is None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        scores = np.array([kernel(sets[r["doc_id"]], m) for m in marks]) @ w
        assert abs(r["score"] - min(max(scores.max(), 0), 1)) < 5e-3
        assert scores[names.index(r["lang_pred"])] > scores.max() - 5e-3


def test_a_hot_language_is_shared_by_tasks(spark, monkeypatch):
    learned = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, f"text {i}", "en" if i % 10 else "de") for i in learned]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    got = {(r["_id"], r["_lang"]) for r in lang.learning_sample(docs).collect()}
    expected = set()
    for x in ("en", "de"):
        expected |= {(i, x) for i in sorted((i for i, _, own in rows if own == x), key=_signed_hash)[:lang.PER_LANGUAGE]}
    assert got == expected
    monkeypatch.setattr(lang, "_SALTS", 1)
    assert {(r["_id"], r["_lang"]) for r in lang.learning_sample(docs).collect()} == expected


def test_language_defined_results(spark, documents, no_documents, texts):
    rows = lang.identify(documents).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "de", "und")
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    unknown = Counter((i, t) for i, t in texts if not any(c.isalpha() for c in t or ""))
    assert Counter(r["doc_id"] for r in rows if r["lang_pred"] == "und") == Counter(i for i, _ in unknown.elements())
    assert lang.identify(no_documents).count() == 0
    unlabelled = lang.identify(documents.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}


# --- fingerprints -----------------------------------------------------------

def _print(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r["p"] for r in prints.with_fingerprint(df.coalesce(1), F.col("t"), "p").collect()]


def test_fingerprint_is_a_multiset_hash(spark):
    a, b, again, more, empty, blank = _print(spark, "x\ny\nz", "z\n\nx\ny", "x\ny\nz\nx", "w", None, "\n\n")
    assert a == b and a != again and empty == blank == "0" * prints.HEX_LENGTH
    df = spark.createDataFrame([(a, more, again)], "a string, b string, c string")
    x = _print(spark, "x")[0]
    both = _print(spark, "x\ny\nz\nw")[0]
    row = df.select(prints.combine(F.col("a"), F.col("b")).alias("sum"), prints.combine(F.col("c"), F.lit(x), -1).alias("less")).first()
    assert row["sum"] == both and row["less"] == a


def test_likeness_follows_shared_paragraphs(spark):
    rng = random.Random(5)
    lines = [f"line {i} {rng.random()}" for i in range(400)]
    for n in (1, 4, 40, 200):
        for shared in (0, n // 2, n):
            own, other = lines[:n], lines[:shared] + lines[200:200 + n - shared]
            a, b = _print(spark, "\n".join(own), "\n".join(other))
            near = spark.createDataFrame([(a, b)], "a string, b string").select(prints.likeness(F.col("a"), F.col("b"))).first()[0]
            true = shared / (2 * n - shared)
            assert abs(near - true) < 0.15 and (near == 1.0) == (shared == n)


@pytest.mark.parametrize("n, other_n", [(1000, 1000), (5000, 5000), (20_000, 20_000), (5000, 10), (20_000, 3000)])
def test_likeness_holds_on_long_documents(spark, n, other_n):
    for shared in (0, min(n, other_n) // 2):
        own = [f"own {i}" for i in range(n)]
        a, b = _print(spark, "\n".join(own), "\n".join(own[:shared] + [f"other {i}" for i in range(other_n - shared)]))
        near = spark.createDataFrame([(a, b)], "a string, b string").select(prints.likeness(F.col("a"), F.col("b"))).first()[0]
        assert abs(near - shared / (n + other_n - shared)) < 0.15 and near <= min(n, other_n) / max(n, other_n) + 1e-6


def test_thinned_lanes_are_homomorphic(spark):
    parts = ["\n".join(f"{k} {i}" for i in range(n)) for k, n in enumerate((900, 3000))]
    a, b, both = _print(spark, *parts, "\n".join(parts))
    assert len(both) > prints.HEX_LENGTH + 7 * 128
    df = spark.createDataFrame([(a, b, both)], "a string, b string, c string")
    row = df.select(prints.combine(F.col("a"), F.col("b")).alias("sum"), prints.combine(F.col("c"), F.col("b"), -1).alias("less")).first()
    assert row["sum"] == both and row["less"] == a


def test_edits_equal_brute_force(documents, no_documents, texts):
    rows = prints.edits(documents).collect()
    assert len(rows) == len(texts)
    order = sorted(((i if i is not None else -(1 << 63), t or "") for i, t in texts))
    expected = Counter()
    for k, (i, t) in enumerate(order):
        cut = len(t) // 2
        edited = t[:len(t) - cut] + order[(k + 1) % len(order)][1][:cut]
        expected[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"] if r["doc_id"] is not None else -(1 << 63), r["n_chars"], r["edited_sha256"]) for r in rows) == expected
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["fingerprint"] == by_id[20]["fingerprint"] and by_id[20]["near_next"] == 1.0
    assert prints.edits(no_documents).count() == 0


def test_edits_plan_has_no_python(documents):
    assert not re.search("Python|Pandas|Arrow", prints.edits(documents)._jdf.queryExecution().executedPlan().toString())


# --- chat -------------------------------------------------------------------

def test_escapes_are_reversible():
    rng = random.Random(1)

    def junk(n):
        return "".join(rng.choice("<|\\\\ni\n") for _ in range(rng.randrange(n)))

    for _ in range(5000):
        text, role = junk(14), junk(6)
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        out, start, end = chat.segment(role, text)
        assert chat.parse(out) == (role, text) and start is None
        out, start, end = chat.segment("assistant", text)
        assert chat.unescape(out[start:end]) == text


def test_layouts_are_chosen_by_their_paths():
    user, bot = "hi", "yo"
    records = {
        "turn": {"role": "user", "text": user}, "messages": {"messages": [{"role": "user", "content": user}, {"role": "assistant", "content": bot}]},
        "from_value": {"conversations": [{"from": "human", "value": user}, {"from": "gpt", "value": bot}]},
        "prompt_response": {"prompt": user, "response": bot}, "prompt_completion": {"prompt": user, "completion": bot},
        "instruction": {"instruction": user, "output": bot}, "instruction_input": {"instruction": user, "input": "", "output": bot},
        "system_prompt_response": {"system": None, "prompt": user, "response": bot}, "question_answer": {"question": user, "answer": bot},
    }
    assert set(records) == {x.name for x in chat.LAYOUTS} and len(chat.BY_FINGERPRINT) == len(chat.LAYOUTS)
    for name, record in records.items():
        got, turns = chat.turns_of(json.dumps(record | {"id": 7, "meta": {"role": "x", "layout": [1]}}))
        assert got == name
        if name == "turn":
            assert turns == [("user", user)]
        else:
            assert turns[-2:] == [("user", user), ("assistant", bot)]
    for junk in (None, "", "[1]", "{", '{"a": 1}', '{"messages": []}', '{"prompt": "x"}'):
        assert chat.turns_of(junk) == (chat.UNKNOWN, [])


def test_conversations_read_back(spark):
    rows = [(1, 0, "system", None), (1, 1, "user", "<|im_end|>"), (1, 2, "assistant", "a\n<|im_start|>assistant"), (2, 0, None, "x"),
            (2, 0, "assistant", ""), (3, 5, "as\nsistant", "q"), (3, None, "assistant", "first"), (None, 0, "user", "u"), (None, 1, "assistant", "🙂")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(chat.canonical_turns(chat.as_records(df)))).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        turns = sorted(((t if t is not None else -1, ro or "", x or "") for c, t, ro, x in rows if c == conv))
        whole = "".join(f"{ro}\n{x}\n" for _, ro, x in turns)
        loss = "".join(x for _, ro, x in turns if ro == "assistant")
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == sum(len(chat.segment(ro, x)[0]) for _, ro, x in turns)
    assert chat.digests(chat.formatted(chat.canonical_turns(chat.as_records(df.limit(0))))).count() == 0


def test_records_take_every_layout_and_keep_roles(spark):
    said = [("system", "be"), ("user", "a\n\nb"), ("assistant", "c"), ("human", "d"), ("gpt", None), ("user", None), ("assistant", "e"), ("user", "f"), ("user", "g")]
    rows = [(conv, turn, *x) for conv in range(9) for turn, x in enumerate(said)]
    rows += [(conv + 9, 0, *x) for conv in range(9) for x in said]  # turns that repeat a number
    turns = chat.canonical_turns(chat.as_records(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")))
    assert {r["layout"] for r in turns.select("layout").distinct().collect()} == {x.name for x in chat.LAYOUTS}
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(turns)).collect()}
    for conv in range(18):
        kept = said if conv < 9 else sorted(said, key=lambda x: (x[0], x[1] or ""))
        whole = "".join(f"{r}\n{t or ''}\n" for r, t in kept)
        assert (got[conv]["n_turns"], got[conv]["turns_sha256"]) == (len(said), hashlib.sha256(whole.encode()).hexdigest())


def test_unknown_records_are_refused(spark):
    df = spark.createDataFrame([(1, 0, '{"a": 1}')], "conv_id long, position long, record string")
    turns = chat.canonical_turns(df)
    assert [(r["layout"], r["text"]) for r in turns.collect()] == [(chat.UNKNOWN, '{"a": 1}')]
    with pytest.raises(Exception, match="matches no layout"):
        chat.formatted(turns).collect()
