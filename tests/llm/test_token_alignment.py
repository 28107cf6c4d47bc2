"""Alignment against the libraries and a plain all-pairs version, counting of keys against Counter."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import key_counts
from strata.llm import token_alignment as ta
from strata.llm.common import table
from strata.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path(ta.VOCABULARY_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(ta.VOCABULARY_B))


def byte_chars():
    """The character of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


def plain(rows, libraries):
    a_lib, b_lib = libraries
    chars = byte_chars()

    def b_bytes(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece[:3] == "<0x" else piece.replace("▁", " ").encode()

    docs, held = [], defaultdict(set)
    for k, (doc_id, text) in enumerate(rows):
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_lib.encode(text or "")
        in_a, in_b = [bytes(chars[c] for c in a_lib.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
        whole = b" " + (text or "").encode()
        if not text or b"".join(in_a) != whole or b"".join(in_b) != whole:
            docs.append((doc_id, 0, 0, [], []))
            continue
        ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in (in_a, in_b)]
        common = sorted(ends[0] & ends[1])
        groups, at, i, j = [], 0, 0, 0
        for end in common:
            group, size_a, size_b = ([], []), at, at
            while size_a < end:
                group[0].append(a[i])
                size_a += len(in_a[i])
                i += 1
            while size_b < end:
                group[1].append(b[j])
                size_b += len(in_b[j])
                j += 1
            groups.append(group)
            at = end
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        for pair in links:
            held[pair].add(k)
        docs.append((doc_id, len(a), len(b), groups, links))
    best = Counter()
    for (x, _), ks in held.items():
        best[x] = max(best[x], len(ks))
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(len(held[p]) == best[p[0]] for p in links),
                    sum(len(held[p]) for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def check(frame, rows, libraries):
    assert sorted(map(tuple, frame.collect()), key=key) == sorted(plain(rows, libraries), key=key)


HARD = ["<|endoftext|> </s><s> <unk>", "<0x41> ▁ x", "▁", " two  spaces ", "tab\tand\r\nline", "é ﬁ ½ 　 wide", "\u0000 a", "𝔘𝔫𝔦 🙂🙂",
        "ሀሁሂ", " ", "a" * 3000, "日本語" * 400, "x   y", "İstanbul"]


@pytest.mark.parametrize("hot", [ta.HOT, 40, 0])
def test_awkward_rows(spark, documents, texts, libraries, hot):
    rows = texts + [(100 + k, t) for k, t in enumerate(HARD)]
    extra = spark.createDataFrame([(100 + k, t) for k, t in enumerate(HARD)], "doc_id long, text string")
    check(ta.align(documents.select("doc_id", "text").unionByName(extra), hot), rows, libraries)


def test_given_documents_and_clashing_columns(spark, libraries):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for name in ("row", "key", "pairs", "of"):
        docs = docs.withColumn(name, docs["text"])
    check(ta.align(docs, 3000), rows, libraries)


def test_empty_table(no_documents):
    assert ta.align(no_documents).count() == 0


def test_common_ends():
    rng = random.Random(1)
    for _ in range(300):
        a, b = (sorted(rng.sample(range(1, 400), rng.choice([0, 1, 3, 40, 300]))) for _ in range(2))
        both = [x for x in a if x in set(b)]
        assert ta.common_ends(a, b) == ([a.index(x) for x in both], [b.index(x) for x in both])


def test_pieces_of_words_are_those_of_the_text(spark, libraries):
    encoder = ta.PieceEncoder(tokenizer_path(ta.VOCABULARY_B))
    assert encoder._by_word
    given = [r["text"] or "" for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    for at in range(0, len(given + HARD), 100):
        part = (given + HARD)[at:at + 100]
        assert encoder.encode(part) == libraries[1].encode(part)


def test_links_in_slices(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = [rng.integers(1, 6, 50) for _ in range(2)]
    sizes[0][7], sizes[1][7] = 40, 30
    ids = [rng.integers(0, 9, s.sum()) for s in sizes]
    ends = [np.cumsum(s) for s in sizes]
    expected = Counter()
    for g in range(50):
        for x in ids[0][ends[0][g] - sizes[0][g]:ends[0][g]].tolist():
            expected.update(x * 100 + y for y in ids[1][ends[1][g] - sizes[1][g]:ends[1][g]].tolist())
    for limit in (1 << 22, 60, 13):
        monkeypatch.setattr(ta, "_LINKS", limit)
        keys, times = ta.linked(*ids, *ends, 100)
        assert dict(zip(keys.tolist(), times.tolist(), strict=True)) == expected and (np.diff(keys.astype(int)) > 0).all()


def test_key_counts(spark):
    rng = random.Random(4)
    rows = [(rng.choice([5, 6, (1 << 64) - 1 - rng.randrange(50), rng.getrandbits(64), rng.randrange(3000)]), rng.randrange(1, 4)) for _ in range(5000)]
    expected = Counter()
    for k, n in rows:
        expected[k] += n

    def keys_of(batch):
        return batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().astype(np.uint64)

    frame = spark.createDataFrame([(k - (1 << 64) if k >> 63 else k, n) for k, n in rows], "k long, m long").repartition(5)
    for least in (1, 3):
        got = {r["key"] % (1 << 64): r["n"] for r in key_counts.count_keys(frame, keys_of, least).collect()}
        assert got == {k: n for k, n in expected.items() if n >= least}


def test_tally_gives_rows_on_the_way():
    tally = key_counts.Tally(7, most=100)
    got = Counter()
    rng = np.random.default_rng(5)
    total, batches = Counter(), []
    for _ in range(60):
        keys = rng.integers(0, 1 << 40, 30).astype(np.uint64) if rng.random() < 0.5 else rng.integers(0, 20, 30).astype(np.uint64)
        total.update(keys.tolist())
        batches += tally.add(keys, np.ones(30, np.uint64))
    batches += tally.rest()
    for b in batches:
        for of, n, keys, counts in zip(*[c.to_pylist() for c in b.columns], strict=True):
            quotient = np.cumsum(key_counts.from_planes(keys, n), dtype=np.uint64)
            for q, c in zip(quotient.tolist(), key_counts.from_planes(counts, n).tolist(), strict=True):
                got[q * 7 + of] += c
    assert len(batches) > 2 and got == total


def test_ids_spell_a_text_or_not():
    """The check that ids are a text's bytes, laid out from the table of all tokens, against joined tokens."""
    both = ta.aligner(tokenizer_path(ta.VOCABULARY_A), tokenizer_path(ta.VOCABULARY_B))
    long = "día 東京 x " * 20_000  # more tokens than are laid out at a time
    for text in ("a", "Ünder the  sea\n", long):
        (a, b), = both.encode([text])
        whole = np.frombuffer(b" " + text.encode(), np.uint8)
        assert both._a.decode_bytes(a.tolist()) == b"".join(both._bytes_b[i] for i in b.tolist()) == whole.tobytes()
        for ids, length in ((a, both._length_a), (b, both._length_b)):
            assert both._spell(ids, length, whole)
            assert not both._spell(ids[:-1], length, whole) and not both._spell(ids, length, whole[:-1])
            assert not both._spell(np.concatenate([ids, ids[-1:]]), length, whole) and not both._spell(ids, length, whole ^ 1)


def test_words_of_a_text_give_its_ids(monkeypatch):
    both = ta.Aligner(tokenizer_path(ta.VOCABULARY_A), tokenizer_path(ta.VOCABULARY_B))
    monkeypatch.setattr(ta, "REMEMBERED", 40)  # words are forgotten on the way
    rng, parts = random.Random(4), ["a", "Bc", " ", "  ", "\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "'s", " 've", "é", "漢", "23", "!", "▁", "w" * 60]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(600)] + [" ", "a ", " a", "a  b", "a\n \n b", "it 's a"]
    for start in range(0, len(texts), 20):
        part = texts[start:start + 20]
        cut = [ta.words_of_text(t) for t in part]
        assert [" ".join(words) for words in cut] == part
        assert [x.tolist() for x in both._words_a.ids(part, cut)] == [both._a.encode_ordinary(" " + t) for t in part]
        assert [x.tolist() for x in both._b.ids(part, cut)] == both._b.model.encode(part)
    assert len(both._words_a) <= 60 and not any(len(w) > ta.LONGEST_REMEMBERED for w in both._words_a)
