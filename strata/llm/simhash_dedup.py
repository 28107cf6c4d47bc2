"""SimHash near-duplicates by segment popcounts.

Words are lower-cased (A-Z) and cut at ASCII white space.  A document's features
are its shingles of four words, repeats included, joined by a space (with fewer
words: the whole sequence).  A bit of its 64-bit fingerprint is 1 if it is set in
over half of the features' XXH64 values (UTF-8, seed 42); a document without
words has fingerprint zero and is linked like any other.  Documents are linked
when their fingerprints differ in at most ``RADIUS`` bits, and a class is a
connected component of links.

1. One pass over the texts makes the fingerprints; distinct fingerprints are the
   nodes, so a group of exact copies is one node whatever its size.
2. **Embedding.**  A fingerprint is cut into 32 segments of two bits and mapped to
   their popcounts, a point of ``{0, 1, 2}**32``.  Counts are kept as thermometer
   codes (0: 00, 1: 01, 2: 11) of one 64-bit number, so the Manhattan distance of
   two points is the popcount of the XOR of their codes (:func:`embedding`).  It
   never exceeds the Hamming distance of the fingerprints: sorting the two bits of
   a segment can only bring two segments nearer.
3. **Grid range join.**  Coordinates are grouped into ``BLOCKS`` blocks.  Points at
   Manhattan distance ``RADIUS`` or less agree on all but ``RADIUS`` blocks, so they
   fall into a common cell of at least one of the grids that fix ``BLOCKS - RADIUS``
   blocks: C(8, 4) = 70 cells a point, on 32 bits each.
4. In a cell every point is compared with the cell's least and greatest point and
   with its predecessor (a window: linear in the cell, whatever its size), first by
   Manhattan distance, then exactly.  The links give components.
5. Cells that hold more than one component after that are joined in full: points
   outside the cell's most frequent component against all points of the cell, with
   the component, Manhattan and Hamming tests inside the join, so only links between
   different components come out.  Components are taken again.  Nothing is capped.

So no link is lost: a pair of linked points shares a cell, and there the two are
already in one component, or one of them is outside the most frequent one.

Defined results: null and empty texts have fingerprint zero; rows that repeat a
doc_id hold the classes of their fingerprints together; a null doc_id is never
linked and has no component; equal texts have equal fingerprints; an empty table
gives no rows.  Texts are read whole, in slices, whatever their length.  Other
columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.components import components

WIDTH, SEED, RADIUS = 4, 42, 4  # fixed by the contract
BLOCKS = 8  # of 4 segments each
_BLOCK_BITS = 64 // BLOCKS
_EVEN = 0x5555555555555555
_SLICE = 1 << 15  # shingles hashed at a time


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


#: One mask of embedding bits for each grid.
GRIDS = [_signed(sum(((1 << _BLOCK_BITS) - 1) << (_BLOCK_BITS * b) for b in fixed))
         for fixed in itertools.combinations(range(BLOCKS), BLOCKS - RADIUS)]


# --- fingerprints -----------------------------------------------------------

def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= WIDTH:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - WIDTH + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        to = min(n, at + _SLICE)
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[at:to].tolist(), ends[at + WIDTH - 1:to + WIDTH - 1].tolist(), strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, print`` (the fingerprint as a signed 64-bit number) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                prints = np.array([fingerprint(t) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, print long")


# --- embedding --------------------------------------------------------------

def embedding(fingerprint: Column) -> Column:
    """Popcounts of the 32 two-bit segments, as thermometer codes in one number."""
    up = F.shiftrightunsigned(fingerprint, 1)
    some = fingerprint.bitwiseOR(up).bitwiseAND(F.lit(_EVEN))
    both = fingerprint.bitwiseAND(up).bitwiseAND(F.lit(_EVEN))
    return some.bitwiseOR(F.shiftleft(both, 1))


def _bits_apart(a: Column, b: Column) -> Column:
    """Manhattan distance of two embeddings; Hamming distance of two fingerprints."""
    return F.bit_count(a.bitwiseXOR(b))


def _near(a: Column, b: Column, point_a: Column, point_b: Column) -> Column:
    """The lower bound first, then the exact test."""
    return (_bits_apart(point_a, point_b) <= RADIUS) & (_bits_apart(a, b) <= RADIUS)


# --- links ------------------------------------------------------------------

def cells(nodes: DataFrame) -> DataFrame:
    """``cell, print, point``: every node in each of its grid cells."""
    point = F.col("point")
    keys = F.array(*[F.xxhash64(F.lit(i), point.bitwiseAND(F.lit(mask))) for i, mask in enumerate(GRIDS)])
    return nodes.select("print", embedding(F.col("print")).alias("point")).select(F.explode(keys).alias("cell"), "print", "point")


def _in_cells(cell_rows: DataFrame) -> DataFrame:
    """Each cell row with the prints it is compared with (itself where there is none), cells of one left out."""
    by_cell = Window.partitionBy("cell").orderBy("print")
    whole = by_cell.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return cell_rows.select(
        "cell", "print", "point", F.first("print").over(whole).alias("low"), F.last("print").over(whole).alias("high"),
        F.lag("print").over(by_cell).alias("before")).where("low != high")


def _links_of(rows: DataFrame) -> DataFrame:
    """The linear comparisons of step 4: ``a, b``."""
    other = F.col("other")
    pairs = rows.select("print", "point", F.explode(F.filter(
        F.array("low", "high", "before"),
        lambda o: o.isNotNull() & (o != F.col("print")) & _near(F.col("print"), o, F.col("point"), embedding(o)))).alias("other"))
    return pairs.select(F.greatest("print", other).alias("a"), F.least("print", other).alias("b")).distinct()


def _links_between(rows: DataFrame, component: DataFrame) -> DataFrame:
    """Links of step 5 between different components: ``a, b``."""
    named = rows.select("cell", "print", "point").join(component.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "component", F.coalesce("component", "print"))
    counts = named.groupBy("cell", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("cell").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component")).alias("most")).where("parts > 1")
    open_ = written(named.join(largest.select("cell", F.col("most.component").alias("most"), F.col("most.n").alias("n_most")), "cell"), "cells-open")
    few = open_.where("component != most").select(
        "cell", F.col("print").alias("a"), F.col("point").alias("point_a"), F.col("component").alias("component_a"))
    met = few.join(open_.select("cell", F.col("print").alias("b"), F.col("point").alias("point_b"), F.col("component").alias("component_b")),
                   "cell").where((F.col("component_a") != F.col("component_b")) & _near(F.col("a"), F.col("b"), F.col("point_a"), F.col("point_b")))
    return met.select("a", "b").distinct()


def link_classes(nodes: DataFrame) -> DataFrame:
    """``node, component`` (least print) for every node of ``nodes`` (column ``print``) that is not its class's least."""
    rows = written(_in_cells(cells(nodes)), "cells")
    links = written(_links_of(rows), "cell-links")
    more = _links_between(rows, components(links))
    return components(links.unionByName(more))


def classes(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``documents``."""
    prints = written(fingerprints(documents), "prints")
    known = prints.where("doc_id IS NOT NULL")
    nodes = written(known.groupBy("print").agg(F.min("doc_id").alias("least")), "print-nodes")
    found = link_classes(nodes.select("print"))
    # ids that repeat with different prints hold their classes together
    ends = known.groupBy("doc_id").agg(F.min("print").alias("lo"), F.max("print").alias("hi")).where("lo != hi").select("doc_id", "lo")
    ties = known.join(ends, "doc_id").where("print != lo").select(F.col("print").alias("a"), F.col("lo").alias("b"))
    ties = written(ties.distinct(), "print-ties")
    if not ties.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(ties))
    placed = nodes.join(found.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("component", "print").alias("component"))
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(ids, "component").select(F.col("print").alias("of"), "component_id")
    return prints.join(placed, F.col("print") == F.col("of"), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
