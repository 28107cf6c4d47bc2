"""Token ids, the transducer, packing, token files and edit-aware counts against the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import bpe_transducer as bpe
from strata.llm import packing, token_counts, token_files
from strata.llm.common import table
from strata.llm.tokens import ByteEncoder, WordEncoder, load_tokenizer, tokenizer_path

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
ODD = ["a  b", "  a b  ", " a\n b", "a \n\n b\tc d", "x\x1c y \x1c z", "don't  DO 's  it we'll", "<|endoftext|> a <|endoftext|>b,<|startoftext|>",
       "́ e ́ Å", "Å b  ", "ΑΣ ΑΣ. ΑΣ1", "\n", " ", "a½,b ½ ²x_y __a1b2", "İstanbul, İ.", "é́a, é́.", "日本語。テスト abc日本!",
       "a,́b", "", "a" * 3000, "ab" * 2000, "!" * 1500, "日" * 1500, "=" * 777 + "-" * 999]


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(2)
    out = [r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").select("text").collect()] + ODD
    for _ in range(300):
        letters = rng.choice(["abcdefghijklmnopqrstuvwxyz", "ath", "!?.-=*# '", "日本é́̈ñß😀👍🏽 \n"])
        out.append("".join(rng.choice(letters) for _ in range(rng.randrange(1, 200))))
    return out


def test_word_ids_equal_library(samples):
    enc, tok = WordEncoder(WORD), load_tokenizer(WORD)
    for t in samples:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_latin_words_equal_library():
    enc, tok = WordEncoder(WORD), load_tokenizer(WORD)
    assert enc._letters is not None  # words of Latin-1 letters are encoded from ranks
    rng = random.Random(4)
    letters = "aeinorst" * 3 + "abcdefghijklmnopqrstuvwxyzABCXYZ" + "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿÀÉÜßÑ"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(5000)] + list(letters)
    words += [w.removesuffix("</w>") for w in tok.get_vocab()]
    joined = [" ".join(words[i:i + 7]) + rng.choice([".\n", ",\n\n", "\n", "."]) + words[i] for i in range(0, len(words), 7)]
    for t, found in zip(words + joined, tok.encode_batch(words + joined, add_special_tokens=False), strict=True):
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == found.ids


def test_byte_ids_equal_library(samples):
    enc, tok = ByteEncoder(BYTE), load_tokenizer(BYTE)
    for t in samples:
        assert enc.encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids


# --- transducer -------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(WORD)


def test_transducer_equals_library(samples, encoder):
    tok = load_tokenizer(WORD)
    for t in samples:
        ids = encoder.encode(t)
        assert ids == tok.encode(t, add_special_tokens=False).ids
        assert bpe.Decoder(encoder.m).feed(ids) == tok.decode(ids, skip_special_tokens=False)


def test_decoder_is_incremental(samples, encoder):
    for t in samples[:120]:
        ids = encoder.encode(t)
        for spaced in (True, False):
            whole = bpe.Decoder(encoder.m, spaced)
            expected = whole.feed(ids) + whole.finish()
            piecewise = bpe.Decoder(encoder.m, spaced)
            assert "".join([piecewise.feed([i]) for i in ids] + [piecewise.finish()]) == expected


def test_running_text_holds_the_pre_tokens(encoder):
    d = bpe.Decoder(encoder.m, spaced=False)
    assert d.feed(encoder.encode("Hello, 日本 é 🙂!")) + d.finish() == "hello , 日本 é 🙂! "


def test_window_stays_within_the_lookahead(encoder):
    bound = 2 * encoder.m.lookahead + 1
    rng = random.Random(8)
    for letters in ("a", "ath", "!?=", "abcdefghijklmnopqrstuvwxyz"):
        t = bpe.WordTransducer(encoder.m)
        for _ in range(40):
            t.feed("".join(rng.choice(letters) for _ in range(100)))
            assert len(t.buffer) <= bound and len(t.last) <= bound


def test_slices_of_any_size_give_the_same_ids(samples, encoder, monkeypatch):
    rng = random.Random(9)
    tok = load_tokenizer(WORD)
    unspaced = ["".join(rng.choice(letters) for _ in range(2000)) for letters in
                ("abcthe", "!?.'", "a1'r", "'redvlmst", "\u1100\u1161\u11a8\uac00", "e\u0301\u0327\u0915\u093c", "\u0130\u03a3i\u0307")]
    unspaced += ["ab" * 300 + "<|endoftext|>" + "!" * 500 + "<|endoftext|>\u0301x", "a\u0301" * 400 + "\u0301" * 300 + "b", "x" + " " * 400 + "y"]
    expected = [tok.encode(t, add_special_tokens=False).ids for t in samples + unspaced]
    for size in (1, 7, 16, 100):
        monkeypatch.setattr(bpe, "SLICE", size)
        assert [encoder.encode(t) for t in samples + unspaced] == expected


def test_memory_does_not_grow_with_a_text_without_spaces(encoder):
    peaks = []
    for n in (60_000, 300_000):
        text = "thecatsa" * (n // 8)
        sum(map(len, encoder.stream(text[:20_000])))
        tracemalloc.start()
        assert sum(map(len, encoder.stream(text))) > 0
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0] + 100_000 and peaks[1] < 4_000_000


@pytest.mark.parametrize("seed", range(60))
def test_lookahead_of_small_merge_lists(seed, tmp_path):
    rng = random.Random(seed)
    letters = "abc"[:rng.choice([1, 2, 2, 3])]
    names, merges = [*letters, *(c + bpe.END for c in letters)], []
    for _ in range(rng.randint(1, 14)):
        left, right = rng.choice([n for n in names if not n.endswith(bpe.END)]), rng.choice(names)
        if left + right not in names and len(left + right) < 20:
            names.append(left + right)
            merges.append([left, right])
    path = tmp_path / "merges.json"
    path.write_text(json.dumps({"model": {"vocab": {n: i for i, n in enumerate(names)}, "merges": merges}, "added_tokens": []}))
    m = bpe.Merges(str(path))
    for _ in range(150):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 80)))
        cut = rng.randint(1, len(text))
        ends = [set(np.cumsum([m.size[i] for i in _plain_bpe(m, list(t))]).tolist()) for t in (text[:cut], text)]
        assert {e for e in ends[0] if e <= cut - m.lookahead} == {e for e in ends[1] if e <= cut - m.lookahead}
        t = bpe.WordTransducer(m)
        got = [i for c in text[:-1] for i in t.feed(c)] + t.finish(text[-1])
        assert got == _plain_bpe(m, [*text[:-1], text[-1] + bpe.END])


def _plain_bpe(m, symbols):
    ids = [m.vocab[s] for s in symbols]
    while True:
        best = min(((m.rank[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in m.rank), default=None)
        if best is None:
            return ids
        i = best[1]
        ids[i:i + 2] = [next(w for w, p in ((m.vocab[m.names[ids[i]] + m.names[ids[i + 1]]], None),))]


def test_compatibility_equals_plain_merging(encoder):
    m = encoder.m
    rng = random.Random(6)
    inner = [t for n, t in m.usable.items() if not n.endswith(bpe.END)]
    for _ in range(1500):
        a, b = rng.choice(inner), rng.choice(list(m.usable.values()))
        name = m.names[b]
        ends = name.endswith(bpe.END)
        symbols = list(m.names[a]) + list(name.removesuffix(bpe.END))
        if ends:
            symbols[-1] += bpe.END
        assert m.compatible(a, b) == (_plain_bpe(m, symbols) == [a, b])


def test_round_trip_rows(documents, no_documents, texts, encoder):
    tok = load_tokenizer(WORD)
    expected = Counter()
    for i, t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        special = encoder._special
        parts = special.splititer(t or ""), special.findall(t or "") + [""]
        running = "".join("".join(w + " " for w in encoder._pre.findall(encoder._normal(part))) + s for part, s in zip(*parts, strict=True))
        expected[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
                 len(running), hashlib.sha256(running.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe.round_trip(documents).collect()) == expected
    assert bpe.round_trip(no_documents).count() == 0
    rows = bpe.transduce(documents).collect()
    assert Counter((r["doc_id"], len(r["ids"])) for r in rows) == Counter((e[0], e[1]) for e, c in expected.items() for _ in range(c))


# --- packing ----------------------------------------------------------------

def test_pack_keeps_every_token(documents, no_documents, texts):
    tok = load_tokenizer(BYTE)
    rows = packing.pack(documents).collect()
    expected = Counter()
    for i, t in texts:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % 1024 or 1024
        at = 0
        for k, n in enumerate([first] + [1024] * ((len(ids) - first) // 1024)):
            expected[i, k, at, n, zlib.crc32(ids[at:at + n].tobytes())] += 1
            at += n
    assert Counter(tuple(r)[:5] for r in rows) == expected
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(no_documents).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.choice([16, 64, 256]))
    histogram = np.zeros(size + 1, np.int64)
    lengths = rng.integers(1, size + 1, int(rng.choice([0, 1, 50, 5000])))
    if seed % 2:
        lengths = np.minimum(lengths, rng.integers(1, size // 3 + 1, len(lengths)))
    np.add.at(histogram, lengths, 1)
    plan = packing.make_plan(histogram)
    rank = np.zeros(len(lengths), np.int64)
    for n in np.unique(lengths):
        rank[lengths == n] = np.arange((lengths == n).sum())
    where, offset = plan.place(lengths, rank)
    used = defaultdict(list)
    for s, o, n in zip(where, offset, lengths, strict=True):
        used[int(s)].append((int(o), int(n)))
    for places in used.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= size
    assert len(used) == plan.n_sequences
    decreasing = sum(n for _, n in packing.best_fit_decreasing(histogram, size))
    assert plan.n_sequences <= max(decreasing, -(-int(lengths.sum()) // size) * 1.02 + 1)


def test_fit_is_non_negative_and_close():
    rng = np.random.default_rng(2)
    histogram = np.zeros(65, np.int64)
    rows = packing.patterns(np.arange(1, 65), 64)
    assert (rows.sum(axis=1) == 64).all() and len(np.unique(rows, axis=0)) == len(rows)
    for r, n in zip(rows[rng.choice(len(rows), 40, replace=False)], rng.integers(1, 500, 40), strict=True):
        np.add.at(histogram, r[r > 0], n)
    x = packing.fit_repeats(rows, histogram.astype(float))
    fitted = np.zeros(65)
    for c in range(3):
        fitted += np.bincount(rows[:, c], weights=x, minlength=65)
    assert (x >= 0).all() and np.abs(fitted - histogram)[1:].sum() < 0.05 * histogram.sum()


# --- files ------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 40, 3000])
def test_codes_are_optimal_prefix_codes_and_decode(n):
    rng = np.random.default_rng(n)
    counts = rng.integers(1, 1000, n) ** 2
    counts[:n // 2] = 1
    bits = token_files.code_lengths(counts)
    assert bits.max() <= token_files.MAX_BITS and (n == 1 or (2.0 ** -bits).sum() == 1.0)
    heap = sorted(counts.tolist())
    cost = 0  # Huffman's cost, which no limit of 20 bits disturbs here
    while len(heap) > 1:
        a, b = heap.pop(0), heap.pop(0)
        cost += a + b
        heap.append(a + b)
        heap.sort()
    if n > 1 and bits.max() < token_files.MAX_BITS:
        assert int((bits * counts).sum()) == cost
    ids = np.sort(rng.choice(60_000, n, replace=False))
    codes = token_files.Codes.of(ids, bits)
    documents = [ids[rng.integers(0, n, size)] for size in (1, 255, 256, 257, 7, 70_000, 1, 513)]
    payload, marks, at = b"", [], 0
    for bits_of_doc, own in token_files.encode_documents(documents, *codes.encoder()):
        payload, marks, at = payload + bits_of_doc, [*marks, *(own + at)], at + 8 * len(bits_of_doc)
    back = token_files.decode_block(payload, marks, np.array([len(d) for d in documents]), *codes.decoder())
    assert (back == np.concatenate(documents)).all()


def test_length_limit_binds():
    counts = np.array([1 << i for i in range(30)])
    bits = token_files.code_lengths(counts, 6)
    assert bits.max() == 6 and (2.0 ** -bits.astype(float)).sum() <= 1.0


def test_files_round_trip(spark, documents, no_documents, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 500)
    token_files.write_ids(documents, str(tmp_path / "a"))
    tok = load_tokenizer(WORD)
    rows = sorted(token_files.read_ids(spark, str(tmp_path / "a")).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == Counter(
        (i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in texts)
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert order == sorted(order)
    assert spark.read.parquet(str(tmp_path / "a" / "blocks")).count() > 3
    digests = {(r["start"], r["ids_crc32"]) for r in token_files.read_digests(spark, str(tmp_path / "a")).collect()}
    assert digests == {(r["start"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in rows}
    token_files.write_ids(no_documents, str(tmp_path / "b"))
    assert token_files.read_ids(spark, str(tmp_path / "b")).count() == 0


# --- edits ------------------------------------------------------------------

@pytest.fixture(scope="module")
def pre():
    return token_counts.PreTokens(tokenizer_path(token_counts.VOCABULARY))


def test_edits_equal_a_full_recount(pre):
    rng = random.Random(3)
    letters = ["ab ", "'re", "'", "  ", " ", "\n", "a", "1", "!?", "don't", " \n ", "é", "日本"]
    touched = size = 0
    for _ in range(250):
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 30, 400, 2000])))
        tree = token_counts.CountTree.of_text(text, pre)
        for _ in range(5):
            start, removed = rng.randrange(0, len(text) + 2), rng.choice([0, 1, 3, 10, 50])
            added = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 20, 600])))
            tree.edit(start, removed, added)
            cut = min(start, len(text))
            text = text[:cut] + added + text[cut + removed:]
            words = pre.cut(text)
            assert [w for b in tree.blocks for w in b] == words and tree.text() == text
            assert tree.n_tokens == sum(len(pre._encode(w)) for w in words) and tree.n_chars == len(text)
            assert tree.leaves() == (text, list(map(len, words)), [len(pre._encode(w)) for w in words])
            if len(text) > 2000:
                touched, size = touched + tree.encoded_chars - len(added), size + len(text)
            tree.encoded_chars = 0
    assert touched < 0.05 * size


def test_redactions_rows(spark, pre):
    rows = [(1, "mail a.b@c.de now"), (2, None), (3, "call +49 171 2345678 or 10.0.0.1"), (None, "nothing"), (3, "x" * 40 + " " + "ab12" * 10)]
    trees = token_counts.build_trees(spark.createDataFrame(rows, "doc_id long, text string"))
    got = token_counts.redacted_counts(trees).collect()
    after = ["mail [MAIL] now", "", "call [NUMBER] or [ADDRESS]", "nothing", "x" * 40 + " [KEY]"]
    expected = Counter((i, len(pre._encode(t or "")), len(pre._encode(a)), len(a)) for (i, t), a in zip(rows, after, strict=True))
    assert Counter((r["doc_id"], r["n_tokens"], r["edited_tokens"], r["edited_chars"]) for r in got) == expected
    assert Counter((r["doc_id"], r["text"]) for r in token_counts.redacted(trees).collect()) == Counter(
        (i, a) for (i, _), a in zip(rows, after, strict=True))


def test_a_restored_tree_encodes_only_what_edits_touch(pre):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(20_000))
    leaves = token_counts.CountTree.of_text(text, pre).leaves()

    class Counting(token_counts.PreTokens):
        asked = 0

        def __getitem__(self, word):
            self.asked += len(word)
            return len(self._encode(word))

        def cut(self, _):
            raise AssertionError("a kept tree is not cut again")

    counting = Counting(tokenizer_path(token_counts.VOCABULARY))
    for _ in range(3):  # each round restores the tree that the one before left
        tree = token_counts.CountTree.of_leaves(*leaves, counting)
        counting.asked = 0
        for _ in range(10):
            at = rng.randrange(len(text))
            tree.edit(at, 4, "xyz 1")
            text = text[:at] + "xyz 1" + text[at + 4:]
        assert tree.n_tokens == len(pre._encode(text)) and tree.text() == text
        assert counting.asked == tree.encoded_chars < 10 * 60
        leaves = tree.leaves()


def test_edits_join_the_kept_trees(spark, documents, no_documents, texts, pre):
    trees = token_counts.build_trees(documents)
    assert Counter((r["doc_id"], r["text"], sum(r["tokens"])) for r in trees.collect()) == Counter(
        (i, t or "", len(pre._encode(t or ""))) for i, t in texts)
    rounds = [[(0, 2, 3, 5, "one"), (0, 1, 0, 2, "two 'r"), (50, 0, None, 4, None), (999, 0, 0, 1, "x"), (None, 0, 0, 1, "x"), (30, 0, 7, 9, "new")],
              [(0, 0, 6, 1, "e"), (40, 0, 20_000, 10**9, " end"), (41, 0, 15_000, 1, " ")]]
    now = {i: t or "" for i, t in texts}  # ids with one text
    for edits in rounds:
        frame = spark.createDataFrame(edits, "doc_id long, seq int, start int, removed int, added string")
        trees = token_counts.apply_edits(trees, frame.withColumn("text", F.lit("clash")))
        for i, _, at, gone, new in sorted(edits, key=lambda e: (e[0] or 0, e[1])):
            if i in now and i is not None:
                at = min(at or 0, len(now[i]))
                now[i] = now[i][:at] + (new or "") + now[i][at + gone:]
        rows = trees.collect()
        assert len(rows) == len(texts)
        for r in rows:
            if r["doc_id"] not in (None, 51):
                assert (r["text"], r["n_tokens"], r["n_chars"]) == (now[r["doc_id"]], len(pre._encode(r["text"])), len(r["text"]))
        assert sum(r["encoded_chars"] for r in rows) < 500 * len(edits) + 31_000
    assert token_counts.apply_edits(token_counts.build_trees(no_documents), frame).count() == 0
    assert {r["n_edits"] for r in token_counts.apply_edits(trees, frame.limit(0)).collect()} == {0}


def test_a_third_of_the_rows_under_one_id(spark, pre):
    rows = [(7 if k % 3 == 0 else k, f"text {k} a b c") for k in range(300)]
    trees = token_counts.build_trees(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    edits = spark.createDataFrame([(7, 0, 0, 4, "TEXT")], "doc_id long, seq int, start int, removed int, added string")
    got = token_counts.apply_edits(trees, edits).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((i, t.replace("text", "TEXT") if i == 7 else t) for i, t in rows)
    assert all(r["n_tokens"] == len(pre._encode(r["text"])) for r in got)
