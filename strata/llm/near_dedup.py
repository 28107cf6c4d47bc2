"""MinHash near-duplicates with sequential Bayesian verification.

Words are lower-cased (A-Z) and cut at ASCII white space; a document's set holds
its distinct shingles of ``width`` words (with fewer words: the whole sequence
as one; without words: nothing, and it is linked with nothing).  Documents are
linked when ``100 * |A and B| >= 80 * |A or B|``, and a class is a connected
component of links.

1. One pass over the texts makes each document's set key (a 128-bit digest of
   its sorted set), band keys and a one-byte-per-hash signature.  Documents with
   equal keys have equal sets: they form one class at once, and only one node for
   each set goes on.
2. Band buckets are star-joined: every member is paired with its bucket's hub,
   the member that meets the most others over all bands.  Pairs are therefore
   at most as many as bucket rows, whatever a bucket's size.
3. Sequential Bayesian verification: signatures are compared in batches; after
   each batch a pair is pruned when the posterior probability that its
   similarity reaches the threshold is below ``MISS``.
4. Survivors are verified exactly on their full shingle sets, streamed by hub.
   Linked pairs give components.
5. What stars cannot decide is done in full: the members of buckets of three or
   more that are still in different components are joined by an exact prefix filter.
   Shingles are ordered by rarity among these members; two sets of the threshold's
   similarity share one among the first ``n - ceil(0.8 n) + 1`` of each, at places that
   leave room for the overlap they need.  Per shingle, members outside its most
   frequent component meet all others, with the component, size and place tests inside
   the join: outsiders of a large group come with shingles of their own, so they meet
   nobody, and work grows with the members and not with the pairs.  Pairs that no star
   has tested run through steps 3 and 4, and the components are taken again.  No
   bucket is capped.

The only loss is probabilistic and stated: two documents at similarity 0.8
share no band with probability (1 - 0.8**6)**40 = 5e-6, and a batch prunes a
true pair with probability of about ``MISS``.

Defined results: null and empty texts have an empty set, and are their own
component; rows that repeat a doc_id with different sets are searched by every
one of them, and hold the classes of their sets together; a null doc_id is never
linked, has no component and is kept.  Sets beyond the first of an id that is
their least are numbered above all ids; a table whose ids leave no room for them
below 2**63 is refused.  Other columns are not read, and :func:`keep_one` returns
them untouched.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.components import components
from strata.llm.key_counts import count_keys
from strata.operators.rank import row_number_by_range

SIMILARITY_PERCENT = 80  # fixed by the task
ROWS, BANDS = 6, 40
N_HASHES = ROWS * BANDS
BATCH = 40  # signature bytes compared between two posterior tests
MISS = 1e-6
RARITY = 1 << 20  # slots by which shingles are ordered in the full pass over undecided buckets
PARTNERS = 256  # partners of a hub that are verified together
WORD_CACHE = 400_000
_SHINGLE_ROWS = 2048  # shingles hashed at a time, bounds memory for long texts


def words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; ``bytes.split`` cuts at just the six ASCII spaces."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, width: int) -> set[tuple[bytes, ...]]:
    """The exact set of shingles, for verification."""
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(width)], strict=False))


class Hasher(dict):
    """64-bit hashes of shingles; remembers word hashes (bounded)."""

    def __init__(self, width: int):
        super().__init__()
        import xxhash

        self._hash = xxhash.xxh64_intdigest
        self.width = width
        rng = np.random.default_rng(20_240)
        self.mul = rng.integers(1, 1 << 63, N_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, N_HASHES, dtype=np.uint64)
        self.band_mul = rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
        self.band_add = rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self._hash(word)
        if len(word) <= 64:
            self[word] = value
        return value

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes of a whole text."""
        w = words(text)
        if not w:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.__getitem__, w), np.uint64, len(w))
        n = max(1, len(w) - self.width + 1)
        out = np.full(n, len(w) if len(w) < self.width else self.width, np.uint64)
        for i in range(min(self.width, len(w))):
            out = (out ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return np.unique(out)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        """The ``N_HASHES`` 32-bit minima of a non-empty set."""
        low = np.full(N_HASHES, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(shingles), _SHINGLE_ROWS):
            part = shingles[at:at + _SHINGLE_ROWS, None] * self.mul
            part += self.add
            part >>= np.uint64(32)
            np.minimum(low, part.min(axis=0).astype(np.uint32), out=low)
        return low

    def bands(self, minima: np.ndarray) -> np.ndarray:
        mixed = (minima.reshape(BANDS, ROWS).astype(np.uint64) + np.uint64(1)) * self.band_mul
        mixed ^= mixed >> np.uint64(31)
        keys = mixed.sum(axis=1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + self.band_add
        return keys.view(np.int64)


@functools.lru_cache(maxsize=1)
def hasher_of(width: int) -> Hasher:
    """The hasher of this Python worker, with the words it remembers."""
    return Hasher(width)


@functools.lru_cache(maxsize=1)
def prune_bounds(threshold: float = SIMILARITY_PERCENT / 100, miss: float = MISS) -> list[tuple[int, int]]:
    """``(compared, least matches)`` after each batch, below which a pair is pruned.

    A byte of two signatures matches with probability ``p = s + (1 - s) / 256``
    at similarity ``s``.  With a uniform prior on ``p`` the posterior after
    ``m`` of ``n`` matches is Beta(m + 1, n - m + 1), and the probability that
    ``p`` reaches the threshold's value is the binomial tail P(Bin(n + 1, t) <= m).
    """
    t = threshold + (1 - threshold) / 256
    bounds = []
    for n in range(BATCH, N_HASHES + 1, BATCH):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        bounds.append((n, m))
    return bounds


def survivors(left: np.ndarray, right: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Row numbers of the signature pairs that no batch prunes."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    done = 0
    for n, least in bounds:
        matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
        if not len(alive):
            break
    return alive


# --- steps ------------------------------------------------------------------

def _text_key(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sketches(documents: DataFrame, width: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_key, bands, signature``; the last three are null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        hasher = hasher_of(width)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                size, key, bands, sign = [], [], [], []
                for text in part.column(1).to_pylist():
                    s = hasher.shingles(text)
                    size.append(len(s))
                    if not len(s):
                        key.append(None), bands.append(None), sign.append(None)
                        continue
                    low = hasher.minima(s)
                    key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    bands.append(hasher.bands(low))
                    sign.append((low & np.uint32(0xFF)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(2).cast(pa.binary()), pa.array(size, pa.int64()), pa.array(key, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sign, pa.binary())],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "bands", "signature"])

    return documents.select("doc_id", "text", _text_key(F.col("text")).alias("text_key")).mapInArrow(
        run, "doc_id long, text_key binary, n_shingles long, set_key binary, bands array<long>, signature binary")


def _set_nodes(sketch: DataFrame) -> DataFrame:
    """``set_key, least, rep`` of every distinct set: its least id, and the node that stands for it.

    The node is the least id.  Where that is the least id of several sets, the set of
    least key has it, and the others get numbers above all ids; so the least node of
    classes that their ids hold together is an id.
    """
    ids = sketch.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    by_key = written(ids.groupBy("set_key").agg(F.min("doc_id").alias("least")), "sets")
    shared = written(by_key.groupBy("least").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("least"), "shared-ids")
    if shared.isEmpty():
        return by_key.withColumn("rep", F.col("least"))
    among = by_key.join(shared, "least")
    own = among.groupBy("least").agg(F.min("set_key").alias("_own"))
    others = written(among.join(own, "least").where("set_key != _own").select("least", "set_key"), "further-sets")
    top, n = sketch.agg(F.max("doc_id")).first()[0], others.count()
    if top + n >= 1 << 63:
        raise OverflowError(f"no room above the ids for {n} further sets of repeated ids")
    numbered = row_number_by_range(others, [F.col("least"), F.col("set_key")], out_col="nth").select(
        "set_key", (F.col("nth") + F.lit(top + 1)).alias("rep"))
    return written(by_key.join(numbered, "set_key", "left").withColumn("rep", F.coalesce("rep", "least")), "set-nodes")


def _similar_sizes(a, b):
    """Sizes that a similarity of the threshold allows."""
    return (100 * F.least(a, b)) >= (SIMILARITY_PERCENT * F.greatest(a, b))


def _pruned(pairs: DataFrame) -> DataFrame:
    """``a, b`` of the pairs (``a, b, sign_a, sign_b``) that sequential verification lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = prune_bounds()
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, N_HASHES) for i in (2, 3)]
            alive = pa.array(survivors(*sides, bounds))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(alive), batch.column(1).take(alive)], names=["a", "b"])

    return pairs.select("a", "b", "sign_a", "sign_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs ``a, b`` (b the hub) whose full sets reach the threshold.

    A hub's partners are dealt into groups of about ``PARTNERS``, each with the hub's
    text; within a group the hub's text comes first and its partners stream past it,
    so a task holds two texts at a time however many partners a hub has.
    """
    groups = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("n_salts")).withColumnRenamed("b", "of")
    salted = pairs.join(groups, F.col("b") == F.col("of")).select(
        "a", "b", F.pmod(F.xxhash64("a"), F.col("n_salts")).cast("int").alias("salt"))
    member = salted.join(texts, F.col("a") == F.col("rep")).select(
        F.col("b").alias("hub"), "salt", F.lit(1).alias("turn"), F.col("a").alias("member"), "text")
    hub = salted.select(F.col("b").alias("hub"), "salt").distinct().join(texts, F.col("hub") == F.col("rep")).select(
        "hub", "salt", F.lit(0).alias("turn"), F.lit(None).cast("long").alias("member"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, own = None, set()
        for batch in batches:
            a, b = [], []
            for hub_id, salt, turn, member_id, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if turn == 0:
                    current, own = (hub_id, salt), shingle_set(text, width)
                elif current == (hub_id, salt):
                    other = shingle_set(text, width)
                    both = len(own & other)
                    if 100 * both >= SIMILARITY_PERCENT * (len(own) + len(other) - both):
                        a.append(member_id), b.append(hub_id)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    together = hub.unionByName(member).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "turn", "member")
    return together.mapInArrow(run, "a long, b long")


def _rarity(members: DataFrame, width: int) -> np.ndarray:
    """How often the shingles of ``members`` fall into each of ``RARITY`` hash slots (an order of shingles, not a count of each)."""
    def keys_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        hasher = hasher_of(width)
        slots = np.concatenate([hasher.shingles(t) for t in batch.column(0).to_pylist()] or [np.zeros(0, np.uint64)]) % np.uint64(RARITY)
        return slots, np.ones(len(slots), np.uint64)

    found = count_keys(members.select("text"), keys_of).toArrow()  # at most a row for each slot
    out = np.zeros(RARITY, np.int64)
    out[found.column("key").to_numpy()] = found.column("n").to_numpy()
    return out


def _prefixes(members: DataFrame, rarity, width: int) -> DataFrame:
    """``shingle, place, size, rep, component``: the rarest shingles of each member, as many as the prefix filter needs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, count = hasher_of(width), rarity.value
        for batch in batches:
            for rep, component, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                shingles = hasher.shingles(text)
                size = len(shingles)
                first = size - -(-SIMILARITY_PERCENT * size // 100) + 1
                order = np.lexsort((shingles, count[(shingles % np.uint64(RARITY)).astype(np.int64)]))[:first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingles[order].view(np.int64)), pa.array(np.arange(first), pa.int32()), pa.array([size] * first, pa.int32()),
                     pa.array([rep] * first, pa.int64()), pa.array([component] * first, pa.int64())],
                    names=["shingle", "place", "size", "rep", "component"])

    return members.select("rep", "component", "text").mapInArrow(run, "shingle long, place int, size int, rep long, component long")


def _similar_sets(members: DataFrame, width: int) -> DataFrame:
    """Pairs ``a, b`` of ``members`` (``rep, component, text``) of different components that the prefix filter lets through."""
    rarity = members.sparkSession.sparkContext.broadcast(_rarity(members, width))
    rows = written(_prefixes(members, rarity, width), "prefixes")
    counts = rows.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("n"))
    shared = counts.groupBy("shingle").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component"))["component"].alias("most")).where("parts > 1")
    met = written(rows.join(shared.select("shingle", "most"), "shingle"), "prefixes-shared")
    few = met.where("component != most").select("shingle", *[F.col(c).alias(f"{c}_of") for c in ("place", "size", "rep", "component")])
    left = F.least(F.col("size") - F.col("place"), F.col("size_of") - F.col("place_of"))  # the overlap there is room for
    pairs = few.join(met, "shingle").where(
        (F.col("component") != F.col("component_of")) & _similar_sizes(F.col("size"), F.col("size_of"))
        & ((100 + SIMILARITY_PERCENT) * left >= SIMILARITY_PERCENT * (F.col("size") + F.col("size_of"))))
    return pairs.select(F.greatest("rep", "rep_of").alias("a"), F.least("rep", "rep_of").alias("b")).distinct()


def _placed(documents: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text_key, n_shingles, part, component_id`` for every row, and the ids in several parts.

    A part is the class of a row's own set by links alone (null for an empty set).
    """
    sketch = written(sketches(documents, width), "sketches")
    nodes = _set_nodes(sketch)
    keyed = written(sketch.select("doc_id", "text_key", "n_shingles", "set_key").join(nodes.select("set_key", "rep"), "set_key", "left"),
                    "set-classes")

    # one row per distinct set, then band buckets of two or more
    reps = sketch.join(nodes.select("rep", "least", F.col("set_key").alias("_key")),
                       (F.col("doc_id") == F.col("least")) & (F.col("set_key") == F.col("_key")))
    # of several texts of an id with this set, one
    reps = reps.groupBy("rep").agg(F.min_by(F.struct("n_shingles", "bands", "signature", "least", "text_key"), "text_key").alias("s")).select(
        "rep", "s.*")
    banded = reps.select("rep", "n_shingles", F.explode("bands").alias("band"))
    sizes = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(banded.join(sizes, "band"), "buckets")
    met = buckets.groupBy("rep").agg(F.sum("n").alias("met"))
    hubs = buckets.join(met, "rep").groupBy("band").agg(F.max(F.struct("met", (-F.col("rep")).alias("least"), "n_shingles")).alias("hub"))
    star = buckets.join(hubs, "band").select(
        F.col("rep").alias("a"), (-F.col("hub.least")).alias("b"), "n_shingles", F.col("hub.n_shingles").alias("hub_size"))
    star = star.where((F.col("a") != F.col("b")) & _similar_sizes(F.col("n_shingles"), F.col("hub_size")))
    signs = written(reps.join(met, "rep", "left_semi").select("rep", "signature", "least", "text_key"), "signatures")
    tested = written(star.select("a", "b").distinct(), "stars")

    def signed(pairs: DataFrame) -> DataFrame:
        return pairs.join(signs.select(F.col("rep").alias("a"), F.col("signature").alias("sign_a")), "a").join(
            signs.select(F.col("rep").alias("b"), F.col("signature").alias("sign_b")), "b")

    candidates = written(_pruned(signed(tested)), "candidates")
    # rows of one id and text are alike, and belong to one set
    texts = documents.select(F.col("doc_id").alias("least"), "text", _text_key(F.col("text")).alias("text_key")).join(
        signs.select("rep", "least", "text_key"), ["least", "text_key"]).dropDuplicates(["least", "text_key"])
    texts = written(texts.select("rep", "text"), "candidate-texts")
    links = written(_verified(candidates, texts, width), "links-star")
    first = components(links)

    # the rest, in full: buckets whose members are still in different components
    named = buckets.join(first.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    undecided = named.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"),
                                          F.max("component").alias("hi")).where("n > 2 AND lo != hi").select("band")
    members = named.join(undecided, "band", "left_semi").select("rep", "component").distinct()
    more = _similar_sets(written(members.join(texts, "rep"), "undecided"), width)
    more = more.join(tested.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), ["a", "b"], "left_anti")
    rest = _verified(written(_pruned(signed(more)), "candidates-rest"), texts, width)
    final = components(links.unionByName(rest)).withColumnRenamed("node", "rep")
    rows = keyed.join(final, "rep", "left").select("doc_id", "text_key", "n_shingles", F.coalesce("component", "rep").alias("part"))

    # ids that repeat with different sets hold their sets' classes together
    several = written(rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("part").alias("lo"), F.max("part").alias("hi"), F.bool_or(F.col("part").isNull()).alias("empty")).where(
        "lo != hi OR (empty AND lo IS NOT NULL)"), "several")
    if several.isEmpty():
        whole = F.coalesce("part", "doc_id")
    else:
        ties = rows.join(several.where("lo != hi"), "doc_id").select(F.col("part").alias("a"), F.col("lo").alias("b"))
        rows = rows.join(components(ties).withColumnRenamed("node", "part"), "part", "left")
        whole = F.coalesce("component", "part", "doc_id")
    return rows.select("doc_id", "text_key", "n_shingles", "part", F.when(F.col("doc_id").isNotNull(), whole).alias("component_id")), several


def classes(documents: DataFrame, width: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents``."""
    rows, _ = _placed(documents, width)
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(documents: DataFrame, width: int = 5) -> DataFrame:
    """One document of each class, the one of least id, with its own columns.

    Rows that repeat a kept id are cut to the one of least text for each group of texts that
    links alone hold together (texts without words are one group); rows with a null id all stay.
    """
    rows, several = _placed(documents, width)
    dropped = rows.where("doc_id != component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    left = documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), row.alias("_row")).join(
        dropped, F.col("_id") == F.col("_dropped"), "left_anti")
    least_text = F.min_by("_row", F.coalesce("_text", F.lit(""))).alias("_row")
    out, known = left.where("_id IS NULL").select("_row"), left.where("_id IS NOT NULL")
    if not several.isEmpty():
        parts = written(rows.join(several, "doc_id", "left_semi").select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("part").alias("_part")).distinct(), "parts")
        out = out.unionByName(known.withColumn("_key", _text_key(F.col("_text"))).join(parts, ["_id", "_key"]).groupBy(
            "_id", "_part").agg(least_text).select("_row"))
        known = known.join(several.select(F.col("doc_id").alias("_id")), "_id", "left_anti")
    return known.groupBy("_id").agg(least_text).select("_row").unionByName(out).select("_row.*")
