"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph is a non-empty line.  Each is hashed to a wide vector, and a
document's fingerprint is the sum of its paragraphs' vectors, lane by lane,
modulo a power of two.  So the order of paragraphs does not matter, and a
paragraph is inserted or deleted by adding or subtracting its vector
(:func:`combine`).  The vector has

* one lane modulo 2**32 that is 1: the sum counts paragraphs;
* ``DENSE`` lanes modulo 2**32, from all bits of SHA-256: they carry equality;
* ``SPREAD`` lanes modulo 2**16, of which the hash picks one: they carry likeness.
  Where two documents differ in ``d`` paragraphs, a lane agrees with probability
  ``(1 - 1/SPREAD)**d``, so the share of lanes that agree estimates ``d``, and with
  the two counts the Jaccard likeness of the paragraph multisets (:func:`likeness`);
* ``LEVELS`` times ``SPREAD`` thinned lanes modulo 2**16: a paragraph enters level j
  with probability ``4**-j``, by its own hash (level 0 are the spread lanes).  ``d`` is
  estimated from the first level where at least ``LEAST_SAME`` lanes agree, times
  ``4**j``.  The last level serves up to 2**32 paragraphs, where the count lane ends.

A fingerprint is written as hexadecimal text, lanes in this order: ``HEX_LENGTH``
digits, then for each thinned lane that is not zero one digit for its level, two for
its place and four for its sum.  So a document of n paragraphs adds some 7 n / 3
digits at most, and equal vectors have equal texts.  Only DataFrame functions are used.

Defined results: null counts as empty; a text without paragraphs has the zero
fingerprint, and is alike 1.0 to another such text and 0.0 to any other; equal
texts (and texts that differ in line order or empty lines) have equal
fingerprints and likeness 1.0.  In :func:`edits`, documents follow each other by
doc_id (null first), those that repeat an id by text; the last is followed by
the first, and a single document by itself; an empty table gives no rows.  Rows of
one id stand in one range, so an id that holds a large share of all rows is sorted by
one task (which spills).  Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DENSE, SPREAD = 8, 128
LEVELS = 12  # 128 lanes of 4**-12 still agree somewhere at 2**32 differing paragraphs
LEAST_SAME = 8  # agreeing lanes (of SPREAD) below which the next level is used
_LANES = [8] + [8] * DENSE + [4] * SPREAD  # hexadecimal digits of each lane
HEX_LENGTH = sum(_LANES)
_SPREAD_AT = 8 * (1 + DENSE)
RANGES_PER_PARTITION = 4


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def _digits(value: Column, n: int) -> Column:
    return F.lpad(F.lower(F.hex(value)), n, "0")


def paragraphs(text: Column) -> Column:
    """The non-empty lines of a text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: p != "")


def _hashes(text: Column) -> Column:
    """SHA-256 and its parts for every paragraph."""
    sha = F.transform(paragraphs(text), lambda p: F.sha2(p, 256))
    return F.transform(sha, lambda h: F.struct(
        F.array(*[_number(F.substring(h, 8 * k + 1, 8)) for k in range(DENSE)]).alias("dense"),
        F.pmod(_number(F.substring(h, 1, 2)), F.lit(SPREAD)).alias("lane"),
        _number(F.substring(h, 61, 4)).alias("value"),
        # zero bits at the head of 32, by twos: at least j of them with probability 4**-j
        F.least(F.lit(LEVELS), F.floor((F.lit(32) - F.length(F.regexp_replace(
            F.bin(_number(F.substring(h, 9, 8))), "^0$", ""))) / 2).cast("int")).alias("level")))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is made once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _thinned_digits(lanes: Column) -> Column:
    """Text of the thinned lanes whose sums are not zero, from an array of (place, value)."""
    sums = F.transform(F.array_sort(F.array_distinct(F.transform(lanes, lambda x: x["place"]))), lambda place: F.struct(
        place.alias("place"), F.aggregate(lanes, F.lit(0).cast("bigint"), lambda acc, x: F.when(
            x["place"] == place, F.pmod(acc + x["value"], F.lit(1 << 16))).otherwise(acc)).alias("sum")))
    return F.array_join(F.transform(F.filter(sums, lambda x: x["sum"] != 0), lambda x: F.concat(x["place"], _digits(x["sum"], 4))), "")


def _thinned(a: Column) -> Column:
    """The thinned lanes of a fingerprint, seven digits each."""
    return F.regexp_extract_all(F.substr(a, F.lit(HEX_LENGTH + 1)), F.lit(".{7}"), F.lit(0))


def with_fingerprint(df: DataFrame, text: Column, out_col: str) -> DataFrame:
    """``df`` with the fingerprint of ``text``; the hashes are made once, in a layer of their own."""
    hidden = f"_hashes_of_{out_col}"
    h = F.col(hidden)

    def dense_sum(k: int) -> Column:
        return F.aggregate(h, F.lit(0).cast("bigint"), lambda acc, x: (acc + F.get(x["dense"], F.lit(k))) % (1 << 32))

    spread = F.transform(F.sequence(F.lit(0), F.lit(SPREAD - 1)), lambda lane: F.aggregate(
        h, F.lit(0).cast("bigint"), lambda acc, x: F.when(x["lane"] == lane, (acc + x["value"]) % (1 << 16)).otherwise(acc)))
    t = F.col(f"{hidden}_thinned")
    levels = F.filter(F.sequence(F.lit(1), F.lit(LEVELS)), lambda j: j <= F.coalesce(F.array_max(F.transform(t, lambda x: x["level"])), F.lit(0)))
    thinned = F.transform(levels, lambda j: _let(
        F.transform(F.filter(t, lambda x: x["level"] >= j), lambda x: F.struct(
            F.concat(_digits(j, 1), _digits(x["lane"], 2)).alias("place"), x["value"].alias("value"))), _thinned_digits))
    parts = [_digits(F.size(h).cast("bigint"), 8), *[_digits(dense_sum(k), 8) for k in range(DENSE)],
             F.array_join(F.transform(spread, lambda v: _digits(v, 4)), ""), F.array_join(thinned, "")]
    return df.withColumn(hidden, _hashes(text)).withColumn(f"{hidden}_thinned", F.filter(h, lambda x: x["level"] > 0)).withColumn(
        out_col, F.concat(*parts)).drop(hidden, f"{hidden}_thinned")


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of all paragraphs of ``a`` and ``b`` together (``sign`` -1: of ``a`` without those of ``b``)."""
    out, at = [], 1
    for n in _LANES:
        x, y = _number(F.substring(a, at, n)), _number(F.substring(b, at, n))
        out.append(_digits(F.pmod(x + sign * y, F.lit(1 << 4 * n)), n))
        at += n

    def signed(fingerprint: Column, by: int) -> Column:
        return F.transform(_thinned(fingerprint), lambda x: F.struct(
            F.substring(x, 1, 3).alias("place"), (by * _number(F.substring(x, 4, 4))).alias("value")))

    return F.concat(*out, _let(F.concat(signed(a, 1), signed(b, sign)), _thinned_digits))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints' paragraph multisets, 0 to 1; equal ones: 1.

    It is at most the lesser count over the greater.
    """
    lanes = F.sequence(F.lit(0), F.lit(SPREAD - 1))
    spread = F.aggregate(lanes, F.lit(0), lambda acc, lane: acc + F.when(
        F.substr(a, _SPREAD_AT + 1 + 4 * lane, F.lit(4)) == F.substr(b, _SPREAD_AT + 1 + 4 * lane, F.lit(4)), 1).otherwise(0))
    counts = [_number(F.substring(x, 1, 8)).cast("double") for x in (a, b)]
    total = counts[0] + counts[1]

    def from_thinned() -> Column:
        """``level, same`` of the first level where enough lanes agree."""
        x, y = _thinned(a), _thinned(b)
        places = F.array_distinct(F.transform(F.concat(F.array_except(x, y), F.array_except(y, x)), lambda e: F.substring(e, 1, 3)))
        levels = _let(places, lambda p: F.transform(F.sequence(F.lit(1), F.lit(LEVELS)), lambda j: F.struct(
            j.alias("level"), (SPREAD - F.size(F.filter(p, lambda e: F.substring(e, 1, 1) == _digits(j, 1)))).alias("same"))))
        return _let(levels, lambda ls: F.coalesce(F.get(F.filter(ls, lambda x: x["same"] >= LEAST_SAME), F.lit(0)), F.get(ls, F.lit(LEVELS - 1))))

    first = _let(spread, lambda s: F.when(s >= LEAST_SAME, F.struct(F.lit(0).alias("level"), s.alias("same"))).otherwise(from_thinned()))
    differ = _let(first, lambda x: -SPREAD * F.log(F.greatest(x["same"].cast("double"), F.lit(0.5)) / SPREAD) * F.pow(F.lit(4.0), x["level"]))
    # total + differ is 0 only for two empty, hence equal, fingerprints
    near = F.least(_let(differ, lambda d: (total - d) / (total + d)), F.least(*counts) / F.greatest(*counts))
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(near, 6))))


def _range_of(order: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` (ascending) that are at most ``order``, by binary search."""
    if not bounds:
        return F.lit(0)
    known, step, steps = F.array(*[F.lit(b).cast("bigint") for b in bounds]), 1, []
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    return functools.reduce(
        lambda at, s: F.aggregate(F.array(F.lit(s)), at, lambda lo, width: F.when(
            F.get(known, lo + width - 1) <= order, lo + width).otherwise(lo)), steps, F.lit(0))


def edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    The edited text is the document's with its last ``floor(n / 2)`` code points
    replaced by the first as many (or all) of the next document.

    Documents are dealt into ranges of doc_id by sampled quantiles, a few per
    shuffle partition, so that "next" is a window inside a range: texts are
    shuffled once.  The last document of a range takes the first of the next
    range from a table with one row per range.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"),
                            F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("_order"))
    n_ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("_order", [i / n_ranges for i in range(1, n_ranges)], 20 * n_ranges)).first()[0]
    bounds = sorted(set(cuts or []))

    def dealt(*columns: str) -> DataFrame:
        """``_range`` and ``columns``, through inline, so that plans see a finished column and not the search expression."""
        return docs.select(F.inline_outer(F.array(F.struct(
            _range_of(F.col("_order"), bounds).alias("_range"), *[F.col(c) for c in columns]))))

    # first document of every range: one least key per range, then its text
    least = dealt("_order").groupBy("_range").agg(F.min("_order").alias("_least"))
    firsts = docs.join(F.broadcast(least), F.col("_order") == F.col("_least")).groupBy("_range").agg(F.min("_text").alias("_first"))
    by_range = Window.orderBy("_range")  # over range numbers alone, as many rows as ranges
    following = least.select(F.col("_range").alias("_of"), F.coalesce(
        F.lead("_range").over(by_range), F.first("_range").over(by_range.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("_next_range"))
    follow = following.join(firsts, F.col("_next_range") == F.col("_range")).select("_of", F.col("_first").alias("_follow"))
    follow = with_fingerprint(follow, F.col("_follow"), "_follow_print")

    inside = Window.partitionBy("_range").orderBy("_order", "_text")
    rows = with_fingerprint(dealt("doc_id", "_text", "_order"), F.col("_text"), "fingerprint").select(
        "*", F.lead("_text").over(inside).alias("_next"), F.lead("fingerprint").over(inside).alias("_next_print"))
    rows = rows.join(follow, F.col("_range") == F.col("_of"), "left").select(
        "doc_id", "_text", "fingerprint", F.length("_text").alias("_n"), F.coalesce("_next", "_follow").alias("_next"),
        F.coalesce("_next_print", "_follow_print").alias("_next_print"))
    cut = F.floor(F.col("_n") / 2).cast("int")
    rows = rows.withColumn("_edited", F.concat(F.substr("_text", F.lit(1), F.col("_n") - cut), F.substr("_next", F.lit(1), cut)))
    rows = with_fingerprint(rows, F.col("_edited"), "edited_fingerprint")
    return rows.select(
        "doc_id", F.col("_n").cast("bigint").alias("n_chars"), F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next_print")).alias("near_next"))


_NUMBER_SQL = "('0x' || substr({h}, {at}, {n}))::BIGINT"
_NEAR_SQL = """CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE (
   SELECT greatest(0.0::DOUBLE, least(1.0::DOUBLE, round(least((x + y - d) / (x + y + d), least(x, y) / greatest(x, y)), 6)))
   FROM (SELECT x, y, -{spread} * ln(greatest(same[level + 1]::DOUBLE, 0.5) / {spread}) * pow(4.0, level) AS d
     FROM (SELECT x, y, same, coalesce(list_filter(range({levels} + 1), lambda j: same[j + 1] >= {least})[1], {levels}) AS level
       FROM (SELECT x, y, list_transform(range({levels} + 1), lambda j: CASE WHEN j = 0
             THEN len(list_filter(range({spread}), lambda k: substr({a}, ({at} + 1 + 4 * k)::INT, 4) = substr({b}, ({at} + 1 + 4 * k)::INT, 4)))
             ELSE {spread} - len(list_filter(differ, lambda e: substr(e, 1, 1) = printf('%x', j))) END) AS same
         FROM (SELECT ('0x' || substr({a}, 1, 8))::BIGINT::DOUBLE AS x, ('0x' || substr({b}, 1, 8))::BIGINT::DOUBLE AS y,
               list_distinct(list_transform(list_filter(p, lambda e: NOT list_contains(q, e)) || list_filter(q, lambda e: NOT list_contains(p, e)),
                                            lambda e: substr(e, 1, 3))) AS differ
           FROM (SELECT regexp_extract_all(substr({a}, {hex} + 1), '.{{7}}') AS p, regexp_extract_all(substr({b}, {hex} + 1), '.{{7}}') AS q)))))) END"""


def oracle_sql() -> str:
    """The query on ``documents`` in DuckDB SQL."""
    def number(at: int | str, n: int) -> str:
        return _NUMBER_SQL.format(h="h", at=at, n=n)

    near = functools.partial(_NEAR_SQL.format, spread=SPREAD, levels=LEVELS, least=LEAST_SAME, at=_SPREAD_AT, hex=HEX_LENGTH)
    dense = " || ".join(f"printf('%08x', (coalesce(sum({number(8 * k + 1, 8)}), 0) % 4294967296)::BIGINT)" for k in range(DENSE))
    return f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS i, doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT i, doc_id, t, length(t) AS n, coalesce(lead(t) OVER (ORDER BY i), first_value(t) OVER (ORDER BY i)) AS nx,
             coalesce(lead(i) OVER (ORDER BY i), first_value(i) OVER (ORDER BY i)) AS next_i FROM d),
e AS (SELECT *, substr(t, 1, n - n // 2) || substr(nx, 1, n // 2) AS e FROM n),
lines AS (SELECT i, which, sha256(p) AS h FROM (
  SELECT i, 'own' AS which, unnest(string_split(t, chr(10))) AS p FROM e UNION ALL
  SELECT i, 'edited' AS which, unnest(string_split(e, chr(10))) AS p FROM e) WHERE p <> ''),
parts AS (SELECT i, which, h, {number(1, 2)} % {SPREAD} AS lane, {number(61, 4)} AS value,
                 least({LEVELS}, (32 - length(regexp_replace(bin({number(9, 8)}), '^0$', ''))) // 2) AS level FROM lines),
every AS (SELECT i, unnest(['own', 'edited']) AS which FROM d),
head AS (SELECT every.i, every.which, printf('%08x', count(h)::BIGINT) || {dense} AS head
         FROM every LEFT JOIN parts USING (i, which) GROUP BY every.i, every.which),
sums AS (SELECT i, which, j, lane, (sum(value) % 65536)::BIGINT AS s FROM parts, range(0, {LEVELS} + 1) AS t(j) WHERE j <= level GROUP BY ALL),
spread AS (SELECT every.i, every.which, string_agg(printf('%04x', coalesce(s, 0)), '' ORDER BY k) AS spread
           FROM every, range({SPREAD}) AS t(k) LEFT JOIN (SELECT * FROM sums WHERE j = 0) z ON z.i = every.i AND z.which = every.which AND z.lane = k
           GROUP BY every.i, every.which),
thin AS (SELECT i, which, string_agg(printf('%x%02x%04x', j, lane, s), '' ORDER BY j, lane) AS thin FROM sums WHERE j > 0 AND s <> 0 GROUP BY i, which),
prints AS (SELECT i, which, head || spread || coalesce(thin, '') AS fp FROM head JOIN spread USING (i, which) LEFT JOIN thin USING (i, which))
SELECT e.doc_id, e.n::BIGINT AS n_chars, sha256(e.e) AS edited_sha256, p1.fp AS fingerprint, p2.fp AS edited_fingerprint,
       {near(a='p1.fp', b='p2.fp')} AS near_edited, {near(a='p1.fp', b='p3.fp')} AS near_next
FROM e JOIN prints p1 ON p1.i = e.i AND p1.which = 'own' JOIN prints p2 ON p2.i = e.i AND p2.which = 'edited'
JOIN prints p3 ON p3.i = e.next_i AND p3.which = 'own'"""
