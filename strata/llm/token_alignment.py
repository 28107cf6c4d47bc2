"""Alignment of two tokenizers' tokens by galloping intersection of their ends.

A text is encoded by A (space and text, byte-level BPE) and B (text, a piece model
that adds the space), special tokens' strings being plain text.  Both cut the same
bytes, so the sorted byte offsets at which tokens end are intersected: the shorter
list drives, and each of its ends is searched in the longer one from where the last
search stopped, in steps that double and then by bisection (:func:`common_ends`).
Common indices cut both token lists into groups; the differences of the common
indices' ranks are the groups' sizes, and every A token of a group is linked with
every B token of it.

The count of an id pair is the number of documents that hold it linked.

1. One pass encodes and aligns each whole text, and writes its digests with its
   distinct id pairs and how often each occurs.
2. The pairs are counted over all documents (:mod:`strata.llm.key_counts`); the
   highest count of each A id has one row per id of the vocabulary.
3. Counts go back to the documents: the most frequent pairs, at most ``HOT``, are
   broadcast; all others are joined by pair.  So what is broadcast has a fixed
   bound, what is shuffled is rare by definition, and both ways give the same sums.

Defined results: a text that is null, empty or whose joined tokens of A or B are
not the bytes of the space and the text has no tokens: zeros and an empty
``groups_sha256``; rows that repeat a doc_id are documents of their own and each
counts; a null doc_id is kept; an empty table gives no rows.  Texts are read whole;
the links of a group that is very large (``_LINKS``) come from its distinct ids.
Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.key_counts import count_keys, from_planes, planes, summed
from strata.llm.tokens import byte_encoder, tokenizer_path

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT = 1 << 21  # pairs whose counts are broadcast: at most so many, 16 bytes each
_LINKS = 1 << 22  # links laid out at a time
_TOKENS = 1 << 16  # tokens of group text hashed at a time
_BEYOND = 1 << 62  # greater than any end
_CUT = re.compile(r"(?<=\S) ")
_SPACES = re.compile(r"^ |\s ").search
REMEMBERED, LONGEST_REMEMBERED = 400_000, 48  # words whose pieces a task remembers


# --- one text ---------------------------------------------------------------

def common_ends(a: Sequence[int], b: Sequence[int]) -> tuple[list[int], list[int]]:
    """Indices ``i`` and ``j`` with ``a[i] == b[j]`` in two strictly ascending lists of positive numbers."""
    swap = len(a) > len(b)
    short, long = (b, [*a, _BEYOND]) if swap else (a, [*b, _BEYOND])
    of_short, of_long, at, last = [], [], 0, len(long) - 1
    for i, end in enumerate(short):
        if long[at] < end:  # gallop: the end lies behind long[at]
            at += 1
            if long[at] < end:
                low, step = at, 2
                while low + step < last and long[low + step] < end:
                    low += step
                    step += step
                at = bisect_left(long, end, low + 1, min(low + step, last))
        if long[at] == end:
            of_short.append(i)
            of_long.append(at)
            at += 1
    return (of_long, of_short) if swap else (of_short, of_long)


def linked(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked pairs (``a * size_b + b``, ascending) and how many links each has.

    ``ends_a`` and ``ends_b`` are the numbers of tokens up to the end of each group.
    """
    n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
    start_a, start_b = ends_a - n_a, ends_b - n_b
    links = n_a * n_b
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    large = links > _LINKS
    for g in np.flatnonzero(large):
        (own_a, m_a), (own_b, m_b) = (np.unique(x, return_counts=True) for x in (ids_a[start_a[g]:ends_a[g]], ids_b[start_b[g]:ends_b[g]]))
        for a, m in zip(own_a.tolist(), m_a.tolist(), strict=True):
            keys.append(np.uint64(a * size_b) + own_b.astype(np.uint64)), counts.append((m * m_b).astype(np.uint64))
    small = np.flatnonzero(~large)
    cuts = np.searchsorted(np.cumsum(links[small]), np.arange(_LINKS, int(links[small].sum()) + _LINKS, _LINKS), side="right")
    for part in np.split(small, np.unique(cuts)):
        if not len(part):
            continue
        tokens = np.repeat(start_a[part] - (np.cumsum(n_a[part]) - n_a[part]), n_a[part]) + np.arange(n_a[part].sum())
        each = np.repeat(n_b[part], n_a[part])  # B tokens of each A token
        first = np.repeat(np.repeat(start_b[part], n_a[part]) - (np.cumsum(each) - each), each)
        of_b = ids_b[first + np.arange(each.sum())].astype(np.uint64)
        key, n = np.unique(np.repeat(ids_a[tokens].astype(np.uint64) * np.uint64(size_b), each) + of_b, return_counts=True)
        keys.append(key), counts.append(n.astype(np.uint64))
    if len(keys) == 2:
        return keys[1], counts[1]
    return summed(np.concatenate(keys), np.concatenate(counts))


def words_of_text(text: str) -> list[str]:
    """The parts of a text between spaces that follow a character other than white space."""
    return _CUT.split(text) if _SPACES(text) else text.split(" ")


class RememberedWords(dict):
    """Packed ids of words; words recur, so their ids are remembered."""

    def __init__(self, encode_each: Callable[[list[str]], Iterable[list[int]]]):
        super().__init__()
        self._encode_each = encode_each

    def ids(self, texts: list[str], cut: list[list[str] | None]) -> list[np.ndarray]:
        """Ids of each text, by its words or, without any, as a whole; the words that are new are encoded in one call."""
        met = set(chain.from_iterable(words for words in cut if words))
        new = [w for w in met if w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(met)
        self.update(zip(new, (array("i", ids).tobytes() for ids in self._encode_each(new)), strict=True))
        out = [np.array(*self._encode_each([text]), np.int64) if words is None
               else np.frombuffer(b"".join(map(self.__getitem__, words)), np.intc).astype(np.int64)
               for text, words in zip(texts, cut, strict=True)]
        for word in new:
            if len(word) > LONGEST_REMEMBERED:
                del self[word]
        return out


class PieceEncoder:
    """Ids of a piece model, by word.

    Where no piece of the vocabulary has a space behind another character, no merge
    reaches over the end of a word.  So texts are cut where a space follows another
    character; that space is the one the model adds to the next part, and an empty
    part (a space at the end) is the space's id.  Texts of other vocabularies, and
    such as hold the sign that stands for the space, are encoded whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self._by_word = "▁" in pieces and not any(re.search("[^▁]▁", p) for p in pieces)
        self._space = [self.model.piece_to_id("▁")]
        self._words = RememberedWords(lambda words: (ids if word else self._space for word, ids in zip(words, self.model.encode(words, num_threads=1), strict=True)))

    def ids(self, texts: list[str], cut: list[list[str]]) -> list[np.ndarray]:
        """Ids of each text that is not empty."""
        return self._words.ids(texts, [words if self._by_word and "▁" not in text else None for text, words in zip(texts, cut, strict=True)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        held = [text for text in texts if text]
        found = iter(self.ids(held, [words_of_text(text) for text in held]))
        return [next(found).tolist() if text else [] for text in texts]


class Aligner:
    """Encodes texts by both vocabularies and aligns their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self._a = byte_encoder(path_a)._ranks
        #: every space behind another character begins a pre-token, and it stays with the word that follows
        self._words_a = RememberedWords(lambda words: (self._a.encode_ordinary(" " + word) for word in words))
        self._b = PieceEncoder(path_b)
        self.size_a, self.size_b = self._a.n_vocab, self._b.model.get_piece_size()
        self._bytes_b = [self._piece(i) for i in range(self.size_b)]
        bytes_a = [b""] * self.size_a
        for i in range(self.size_a):
            try:
                bytes_a[i] = self._a.decode_single_token_bytes(i)
            except KeyError:  # an id that is free
                pass
        self._length_a, self._length_b = np.array(list(map(len, bytes_a))), np.array(list(map(len, self._bytes_b)))
        #: each id's bytes one after the other, and where they start
        self._flat = {id(n): (np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(n) - n)
                      for n, tokens in ((self._length_a, bytes_a), (self._length_b, self._bytes_b))}
        names_a, names_b = ([str(i) for i in range(n)] for n in (self.size_a, self.size_b))
        #: a token's text and what follows it: inside a group, at the end of its A side, of its B side
        self._written = np.array([f"{n}," for n in names_a] + [f"{n}|" for n in names_a] + [f"{n}," for n in names_b] + [f"{n};" for n in names_b], "S")

    def _piece(self, i: int) -> bytes:
        piece = self._b.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._b.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both for each text; None where their bytes are not the space and the text."""
        held = [text for text in texts if text]
        cut = [words_of_text(text) for text in held]
        found = zip(self._words_a.ids(held, cut), self._b.ids(held, cut), strict=True)
        for text in texts:
            if not text:
                yield None
                continue
            whole = np.frombuffer(b" " + text.encode(), np.uint8)
            ids = next(found)
            same = all(self._spell(x, n, whole) for x, n in zip(ids, (self._length_a, self._length_b), strict=True))
            yield ids if same else None

    def _spell(self, ids: np.ndarray, length: np.ndarray, whole: np.ndarray) -> bool:
        """Whether the ids' bytes are the ``whole``."""
        flat, start = self._flat[id(length)]
        for at in range(0, max(len(ids), 1), _TOKENS):
            part = ids[at:at + _TOKENS]
            n = length[part]
            total = int(n.sum())
            found = flat[np.arange(total) + np.repeat(start[part] - (np.cumsum(n) - n), n)]
            if not np.array_equal(found, whole[:total]):
                return False
            whole = whole[total:]
        return not len(whole)

    def digest(self, ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> str:
        """SHA-256 of the groups as text."""
        sizes_a, sizes_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        last_a, last_b = ids_a.copy(), ids_b + 2 * self.size_a
        last_a[ends_a - 1] += self.size_a
        last_b[ends_b - 1] += self.size_b
        codes[np.arange(len(ids_a)) + np.repeat(ends_b - sizes_b, sizes_a)] = last_a
        codes[np.arange(len(ids_b)) + np.repeat(ends_a, sizes_b)] = last_b
        out = hashlib.sha256()
        for at in range(0, len(codes), _TOKENS):
            text = self._written[codes[at:at + _TOKENS]].view(np.uint8)
            text = text[text != 0]  # without what fills up the shorter ones
            out.update(text if at + _TOKENS < len(codes) else text[:-1])  # the last separator goes
        return out.hexdigest()

    def align(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of A and B tokens up to the end of each group."""
        offsets = (np.cumsum(n[ids]).tolist() for n, ids in ((self._length_a, ids_a), (self._length_b, ids_b)))
        of_a, of_b = common_ends(*offsets)
        return np.array(of_a, np.int64) + 1, np.array(of_b, np.int64) + 1


@functools.lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this Python worker."""
    return Aligner(path_a, path_b)


# --- the corpus -------------------------------------------------------------

_ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs int, pairs binary, times binary")


def aligned(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per row its digests, and its distinct pairs (differences, in byte planes) with their numbers of links."""
    paths = path_a or tokenizer_path(VOCABULARY_A), path_b or tokenizer_path(VOCABULARY_B)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(*paths)
        kinds = [pa.int64()] * 5 + [pa.string(), pa.int32(), pa.binary(), pa.binary()]
        names = [c.split()[0] for c in _ALIGNED.split(", ")]
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part, rows = batch.slice(start, 64), []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), both.encode(texts), strict=True):
                    if ids is None:
                        rows.append((doc_id, 0, 0, 0, 0, "", 0, b"", b""))
                        continue
                    ends = both.align(*ids)
                    pairs, times = linked(*ids, *ends, both.size_b)
                    rows.append((doc_id, len(ids[0]), len(ids[1]), len(ends[0]), int(times.sum()), both.digest(*ids, *ends),
                                 len(pairs), planes(np.diff(pairs, prepend=np.uint64(0))), planes(times)))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ALIGNED)


def _pairs_of(n: int, data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, n), dtype=np.uint64)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``key, n``: in how many of the :func:`aligned` rows each pair is linked."""
    def keys_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        held = [_pairs_of(n, data) for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if n]
        keys = np.concatenate(held) if held else np.zeros(0, np.uint64)
        return keys, np.ones(len(keys), np.uint64)

    return count_keys(rows.where("n_pairs > 0").select("n_pairs", "pairs"), keys_of)


def _hot_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent pairs, at most ``most``, ascending, and their counts.

    Whole steps of frequency (an eighth of an octave) are taken from the top while they fit.
    """
    step = F.floor(8 * F.log2("n")).cast("int")
    held, least = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs")).collect(), reverse=True):  # at most 8 * 63 rows
        held += row["pairs"]
        if held > most:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = counts.where(step >= least).toArrow()
    keys, n = got.column("key").to_numpy().astype(np.uint64), got.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def align(documents: DataFrame, hot: int = HOT, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``documents``."""
    import sentencepiece

    spark = documents.sparkSession
    path_b = path_b or tokenizer_path(VOCABULARY_B)
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = written(aligned(documents, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = written(pair_counts(rows), "pair-counts")
    id_a = F.floor(F.col("key") / size_b).cast("long")
    highest = dict(counts.groupBy(id_a.alias("a")).agg(F.max("n").alias("n")).collect())  # at most one row per id of A
    best = np.zeros(max(highest, default=0) + 1, np.int64)
    best[list(highest)] = list(highest.values())
    sent = spark.sparkContext.broadcast((*_hot_pairs(counts, hot), best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, top = sent.value
        for batch in batches:
            n_best, count_sum, cold, cold_times = [], [], [], []
            for size, data, times in zip(*[batch.column(i).to_pylist() for i in (6, 7, 8)], strict=True):
                pairs, times = _pairs_of(size, data), from_planes(times, size).astype(np.int64)
                at = np.searchsorted(keys, pairs)
                known = at < len(keys)
                known[known] = keys[at[known]] == pairs[known]
                count, m = n[at[known]], times[known]
                n_best.append(int(m[count == top[(pairs[known] // np.uint64(size_b)).astype(np.int64)]].sum()))
                count_sum.append(int((count * m).sum()))
                cold.append(pairs[~known].astype(np.int64)), cold_times.append(times[~known])
            cols = [batch.column(i) for i in (*range(6), 9)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(cold, pa.list_(pa.int64())),
                 pa.array(cold_times, pa.list_(pa.int64()))],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row", "n_best", "count_sum", "cold", "times"])

    part = written(rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, row long, "
                                        "n_best long, count_sum long, cold array<long>, times array<long>"), "hot-counts")
    cold = part.select("row", F.explode(F.arrays_zip("cold", "times")).alias("c")).select("row", F.col("c.cold").alias("key"), "c.times")
    tops = spark.createDataFrame([(int(a), int(n)) for a, n in highest.items()], "a long, top long")
    ranked = counts.select("key", "n", id_a.alias("a")).join(tops, "a").select("key", "n", (F.col("n") == F.col("top")).alias("is_best"))
    more = cold.join(ranked, "key").groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    return part.join(more, F.col("row") == F.col("of"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
