"""Phrase collocations by prefix-free parsing.

Texts are lower-cased (A-Z) and cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
at spaces and tabs into words.  Per language (null: ``und``) ``n`` is the number of
words and ``f`` of a phrase the number of its contiguous occurrences within pieces.

1. **Parsing.**  A document becomes one sequence of words and piece ends.  Where a
   hash of the next ``WINDOW`` tokens is 0 modulo ``TRIGGER`` a chunk ends and the next
   begins; a chunk also holds the window that ended it, so neighbours overlap by
   ``WINDOW`` tokens.  Cuts depend on content alone: documents that share a passage
   share its chunks.  Distinct chunks with their frequencies are the dictionary.
2. **Counting** happens inside distinct chunks, weighted by their frequency.  A
   phrase of up to ``LONGEST = WINDOW + 1`` words belongs to the chunk whose own part (all
   but the window at its end) it begins in, so overlaps count once.
   a. Hashes (40 bits) of words and pairs are counted (:mod:`strata.llm.key_counts`);
      those that reach ``LEAST`` set bits of a filter of fixed size.
   b. The same for phrases of three to five words all of whose pairs pass the
      filter: a frequent phrase has frequent parts.
   c. Phrases that pass both filters are counted by their words.  Hashes and
      filters only ever let too much through, so these counts are exact.
3. **Scores** are joins on the table of frequent phrases: every part of a candidate
   is at least as frequent as the candidate, so it is in that table.

Hot words, pairs and passages are summed inside a task before any shuffle; the
filters have 2**26 bits each, whatever the input.  With more frequent phrases than
they can tell apart more is counted by words, and the result stays the same.

Defined results: null and empty texts have no words; rows that repeat a doc_id are
documents of their own; repeated texts count as often as they occur; a language
without candidates has no rows; an empty table gives none.  Texts are read whole, in
slices.  Ties in score and frequency are ordered by the phrase's UTF-8 bytes.
Other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.key_counts import DEALT, Tally, merged, n_ranges
from strata.operators.sizing import broadcast_if_small

LEAST, LONGEST, TOP = 100, 5, 2000  # fixed by the contract
UNKNOWN = "und"  # fixed by the contract
WINDOW = LONGEST - 1
TRIGGER = 32
KEY_BITS, FILTER_BITS = 40, 26
WORD_CACHE = 400_000
_SLICE = 1 << 20  # bytes of a text parsed at a time
_HELD = 1 << 25  # bytes of chunks, or 1 / 64 as many phrases, summed before they are given on
_BATCH = 1 << 22  # bytes of chunks whose phrases are found at a time
_SALTS = 32

_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes(0x2E if b in _ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word -> 64-bit hash; remembers a bounded number."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


@functools.lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    """The word hashes of this Python worker."""
    return _Hashes()


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a ^ b) * _MIX
    out ^= out >> np.uint64(29)
    return out


# --- parsing ----------------------------------------------------------------

def _slices(data: bytes) -> Iterator[bytes]:
    """The normalised text in parts that end where words do."""
    at, size = 0, _SLICE
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in b" \t" + _ENDS:
            end += 1
        yield data[at:end].translate(_PLAIN).replace(b".", b" . ")
        size, at = 2 * size, end


def chunks_of(text: str | None) -> Iterator[tuple[bytes, bool]]:
    """The chunks of a text, each with whether it is the last one (which ends in no window)."""
    pending: list[bytes] = []  # tokens from the start of the open chunk
    for part in _slices((text or "").encode("utf-8", "surrogatepass")):
        tokens = pending + part.split()
        starts = [0]
        if len(tokens) > WINDOW:
            h = _hashes().of(tokens)
            ahead = h[:len(h) - WINDOW + 1].copy()
            for k in range(1, WINDOW):
                ahead = _mixed(ahead, h[k:len(h) - WINDOW + 1 + k])
            cuts = np.flatnonzero(ahead % np.uint64(TRIGGER) == 0)
            starts += cuts[cuts > 0].tolist()
        for a, b in zip(starts, starts[1:], strict=False):
            yield b" ".join(tokens[a:b + WINDOW]), False
        pending = tokens[starts[-1]:]
    if pending:
        yield b" ".join(pending), True


def dictionary(documents: DataFrame) -> DataFrame:
    """``lang, chunk, last, n``: distinct chunks and their frequencies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        size = 0

        def rows() -> pa.RecordBatch:
            keys = list(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
                 pa.array([k[2] for k in keys], pa.bool_()), pa.array([held[k] for k in keys], pa.int64())],
                names=["lang", "chunk", "last", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for chunk, last in chunks_of(text):
                    before = len(held)
                    held[lang, chunk, last] += 1
                    size += len(chunk) if len(held) > before else 0
                    if size >= _HELD:
                        yield rows()
                        held.clear()
                        size = 0
        if held:
            yield rows()

    parsed = documents.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").mapInArrow(
        run, "lang string, chunk binary, last boolean, n long")
    return parsed.groupBy("lang", "chunk", "last").agg(F.sum("n").alias("n"))


# --- phrases of chunks ------------------------------------------------------

class _Numbers(dict):
    """Numbers of the words of a batch, as they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return len(self) - 1


@dataclass
class Tokens:
    """The tokens of a batch of chunks, one after the other, each chunk followed by a piece end."""

    words: list[bytes]
    numbers: dict[bytes, int]  # of the distinct words
    word: np.ndarray  # each token's word's number
    langs: list[str]
    lang: np.ndarray  # number of each token's language
    weight: np.ndarray  # frequency of its chunk
    own: np.ndarray  # whether phrases that begin here belong to the chunk
    end: np.ndarray  # whether it is a piece end
    start_hash: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> "Tokens":
        chunks = batch.column(1).to_pylist()
        words = (b" . ".join(chunks) + b" .").split(b" ")
        numbers = _Numbers()
        word = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        sizes = np.array([c.count(b" ") for c in chunks], np.int64) + 2
        langs, lang = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        last = batch.column(2).to_numpy(zero_copy_only=False)
        place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        own = place < np.repeat(np.where(last, sizes - 1, sizes - 1 - WINDOW), sizes)
        h = _hashes().of(list(numbers))[word]
        return Tokens(words, numbers, word, langs.tolist(), np.repeat(lang, sizes), np.repeat(batch.column(3).to_numpy(), sizes), own,
                      word == numbers[b"."], h)

    def levels(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``n, valid, key`` for n = 1, 2, ...: whether n words without a piece end begin at a token, and their key."""
        seeds = np.array([_hashes()[b". " + x.encode()] for x in self.langs], np.uint64)[self.lang]
        now, valid, n = _mixed(self.start_hash, seeds), ~self.end, 1
        while True:
            yield n, valid, now >> np.uint64(64 - KEY_BITS)
            ahead = np.zeros_like(self.start_hash)
            ahead[:-n or None] = self.start_hash[n:]
            inside = np.zeros(len(valid), bool)
            inside[:-n or None] = ~self.end[n:]
            now, valid, n = _mixed(now, ahead), valid & inside, n + 1


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``_BATCH`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= _BATCH:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _filter_bits(key: Column) -> Column:
    """The two bits of a key."""
    return F.array(key.bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), F.shiftright(key, KEY_BITS - FILTER_BITS))


def filter_of(keys: DataFrame) -> np.ndarray:
    """A filter of ``2**FILTER_BITS`` bits that the keys pass; the driver gets at most its words."""
    bit = keys.select(F.explode(_filter_bits(F.col("key"))).alias("bit"))
    of = F.expr("shiftleft(1, CAST(bit & 31 AS INT))")
    words = bit.groupBy(F.shiftright("bit", 5).cast("int").alias("word")).agg(F.bit_or(of).alias("bits")).toArrow()
    out = np.zeros(1 << FILTER_BITS - 5, np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.int32).view(np.uint32)
    return out


def passes(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each key's two bits are set."""
    out = np.ones(len(key), bool)
    for bit in (key & np.uint64((1 << FILTER_BITS) - 1), key >> np.uint64(KEY_BITS - FILTER_BITS)):
        out &= (bits[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)
    return out


def _frequent_keys(chunks: DataFrame, lengths: tuple[int, ...], pairs=None, least: int = LEAST) -> DataFrame:
    """``key, n`` of phrases of these lengths that are found ``least`` times or more.

    With ``pairs`` (a broadcast filter) only phrases all of whose pairs pass it are counted.
    """
    ranges = n_ranges(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(ranges)
        for batch in _together(batches):
            tokens = Tokens.of(batch)
            frequent = None
            for n, valid, key in tokens.levels():
                if n > max(lengths):
                    break
                if pairs is not None and n == 2:
                    pair = valid.copy()
                    pair[valid] = passes(pairs.value, key[valid])
                    frequent = pair.copy()
                elif frequent is not None:
                    frequent[:2 - n] &= pair[n - 2:]
                    frequent[2 - n:] = False
                if n in lengths:
                    at = np.flatnonzero(tokens.own & valid & (True if frequent is None else frequent))
                    yield from tally.add(key[at], tokens.weight[at].astype(np.uint64))
        yield from tally.rest()

    return merged(chunks.mapInArrow(run, DEALT), ranges, least)


def _numbered(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct code a place where it stands, and each code's number among the distinct ones."""
    order = np.argsort(code)
    new = np.concatenate([[True], code[order[1:]] != code[order[:-1]]]) if len(code) else np.zeros(0, bool)
    number = np.empty(len(code), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _phrase_sums(tokens: Tokens, short: np.ndarray, long: np.ndarray) -> Iterator[tuple[tuple[str, bytes], int]]:
    """``(lang, phrase), n`` of a batch's phrases that pass the filters; the empty phrase has the number of words."""
    numbers = tokens.numbers
    total = np.bincount(tokens.lang, weights=tokens.weight * (tokens.own & ~tokens.end), minlength=len(tokens.langs))
    yield from (((x, b""), int(t)) for x, t in zip(tokens.langs, total.tolist(), strict=True))
    at, code = np.flatnonzero(tokens.own & ~tokens.end), None
    for n, valid, key in tokens.levels():
        if n > LONGEST or not len(at):
            break
        keep = valid[at]
        keep[keep] = passes(short if n <= 2 else long, key[at[keep]])
        at = at[keep]
        # the phrase's number: that of its words but the last one, with the last one's
        code = (tokens.lang[at] if code is None else code[keep]) * len(numbers) + tokens.word[at + n - 1]
        first, code = _numbered(code)
        sums = np.bincount(code, weights=tokens.weight[at], minlength=len(first))
        for i, t in zip(at[first].tolist(), sums.tolist(), strict=True):
            yield (tokens.langs[tokens.lang[i]], b" ".join(tokens.words[i:i + n])), int(t)


_PHRASES = "range int, langs array<string>, phrases array<binary>, counts array<long>"


def _counted(chunks: DataFrame, short, long, least: int) -> DataFrame:
    """``lang, phrase, f`` of the phrases that pass the filters and are found ``least`` times, counted by their words.

    A task's partial sums are dealt into ranges by a hash of the phrase, a row for each range.
    """
    ranges = n_ranges(chunks.sparkSession)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bytes], int] = {}

        def rows() -> pa.RecordBatch:
            dealt: dict[int, tuple[list, list, list]] = {}
            for (lang, phrase), n in held.items():
                row = dealt.setdefault((zlib.crc32(phrase) + len(lang)) % ranges, ([], [], []))
                row[0].append(lang), row[1].append(phrase), row[2].append(n)
            kinds = [pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(dealt), pa.int32()), *[pa.array([r[i] for r in dealt.values()], k) for i, k in enumerate(kinds)]],
                names=["range", "langs", "phrases", "counts"])

        for batch in _together(batches):
            for key, n in _phrase_sums(Tokens.of(batch), short.value, long.value):
                held[key] = held.get(key, 0) + n
            if len(held) >= _HELD >> 6:
                yield rows()
                held.clear()
        if held:
            yield rows()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bytes], int] = {}

        def rows() -> pa.RecordBatch:
            kept = [(lang, phrase, n) for (lang, phrase), n in held.items() if n >= least or not phrase]
            cols = list(zip(*kept, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()).cast(pa.string()),
                                               pa.array(cols[2], pa.int64())], names=["lang", "phrase", "f"])

        current = None
        for batch in batches:
            for i in range(batch.num_rows):
                of, langs, phrases, counts = (batch.column(c)[i].as_py() for c in range(4))
                if of != current and held:
                    yield rows()
                    held.clear()
                current = of
                for key, n in zip(zip(langs, phrases, strict=True), counts, strict=True):
                    held[key] = held.get(key, 0) + n
        if held:
            yield rows()

    together = chunks.mapInArrow(partial, _PHRASES).repartition("range").sortWithinPartitions("range")
    return together.mapInArrow(whole, "lang string, phrase string, f long")


def frequent_phrases(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, phrase, k, f``: every phrase of up to ``LONGEST`` words with its exact frequency of ``least`` or more.

    The empty phrase (k = 0) of a language has its number of words.
    """
    sc = documents.sparkSession.sparkContext
    chunks = written(dictionary(documents), "chunks")
    short = sc.broadcast(filter_of(_frequent_keys(chunks, (1, 2), None, least).select("key")))
    long = sc.broadcast(filter_of(_frequent_keys(chunks, tuple(range(3, LONGEST + 1)), short, least).select("key")))
    counts = _counted(chunks, short, long, least)
    k = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return written(counts.select("lang", "phrase", k.alias("k"), "f"), "phrases")


# --- scores -----------------------------------------------------------------

def _joined(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the candidates that no longer one stands for."""
    totals, _ = broadcast_if_small(phrases.where("k = 0").select(F.col("lang").alias("of_lang"), F.col("f").alias("n")))
    known, k = phrases.where("k > 0"), F.col("k")
    candidates = known.where("k > 1").withColumn("words", F.split("phrase", " "))

    cut = F.col("cut")
    cuts = candidates.select("lang", "phrase", k, F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), k - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", _joined(F.col("words"), F.lit(1), cut).alias("first"), _joined(F.col("words"), cut + 1, k - cut).alias("rest"))
    side = known.select(F.col("lang").alias("lang_of"), F.col("phrase").alias("part"), "f")
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(side, (F.col("lang") == F.col("lang_of")) & (F.col(part) == F.col("part"))).withColumnRenamed("f", name).drop("lang_of", "part")
    cuts = cuts.join(totals, F.col("lang") == F.col("of_lang"))
    exact = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    parts = cuts.withColumn("above", F.lit(1000).cast("decimal(4,0)") * (exact["a"] * exact["n"])).withColumn("below", exact["l"] * exact["r"])
    parts = parts.withColumn("score", F.expr("above div below"))
    best = parts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("b")).select(
        "lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")

    # f never grows with a phrase's length, so the candidates of one more word tell whether any longer one is as frequent
    longer = candidates.where("k > 2").select("lang", "f", F.explode(F.array(
        _joined(F.col("words"), F.lit(1), k - 1), _joined(F.col("words"), F.lit(2), k - 1))).alias("inside"))
    longer = longer.groupBy(F.col("lang").alias("lang_of"), "inside").agg(F.max("f").alias("most"))
    return best.join(longer, (F.col("lang") == F.col("lang_of")) & (F.col("phrase") == F.col("inside")) & (100 * F.col("most") >= 100 * F.col("a")),
                     "left_anti")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` candidates (a report of fixed length)."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    rows = scored(frequent_phrases(documents, least)).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    # first in each of some parts of a language, then in the language
    few = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = LEAST, top: int = TOP) -> str:
    """The query on ``documents`` in DuckDB SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    phrase = "array_to_string({w}[{a}:{b}], ' ')"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
         unnest(regexp_split_to_array(translate(text, '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (
  SELECT lang, {phrase.format(w='w', a='i', b='i + k - 1')} AS phrase, k
  FROM starts, range(1, {LONGEST + 1}) AS t(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, phrase, k, count(*)::BIGINT AS f FROM grams GROUP BY lang, phrase, k HAVING count(*) >= {least}),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, t.cut, {phrase.format(w='c.w', a='1', b='t.cut')} AS x, {phrase.format(w='c.w', a='t.cut + 1', b='c.k')} AS y
  FROM c, range(1, {LONGEST}) AS t(cut) WHERE t.cut < c.k),
s AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, p.f AS l, q.f AS r, total.n, cut,
         ((1000::HUGEINT * cuts.a * total.n) // (p.f::HUGEINT * q.f))::BIGINT AS score
  FROM cuts JOIN f p ON p.lang = cuts.lang AND p.phrase = cuts.x JOIN f q ON q.lang = cuts.lang AND q.phrase = cuts.y
  JOIN total ON total.lang = cuts.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT c.lang, {phrase.format(w='c.w', a='t.i', b='t.i + u.m - 1')} AS phrase, c.a AS most
  FROM c, range(1, {LONGEST}) AS t(i), range(2, {LONGEST}) AS u(m) WHERE u.m < c.k AND t.i + u.m - 1 <= c.k),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.most >= 100 * b.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= {top}"""
