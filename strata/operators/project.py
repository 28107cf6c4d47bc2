"""Typing, null tokens and renaming of record columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import schema


def integral(c: Column, typ: str = "bigint") -> Column:
    """Text (or number) -> integer when it is a whole number, else null.

    Accepts ``1080415`` and the float form ``1080415.0`` that a pandas
    rewrite leaves in columns with missing values; ``3.5`` and words give
    null.  Parsed through ``decimal(38,10)``, so long integers stay exact.
    """
    d = F.trim(c.cast("string")).try_cast("decimal(38,10)")
    return F.when(d == F.floor(d), d.try_cast(typ))


def null_tokens(df: DataFrame, columns: Iterable[str] | None = None,
                tokens: Iterable[str] = schema.NA_TOKENS) -> DataFrame:
    """Turn missing-value tokens (``NA``, ``None``, ...) into null.

    The source files went through a pandas rewrite that read these tokens as
    missing; Spark's CSV reader only maps the empty string to null.
    """
    cols = set(df.columns if columns is None else columns)
    toks = list(tokens)
    return df.select(*[
        F.when(F.col(c).isin(toks), F.lit(None)).otherwise(F.col(c)).alias(c)
        if c in cols else F.col(c)
        for c in df.columns
    ])


def cast_columns(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """``try_cast`` text columns to declared types; a bad value becomes null.

    Integer types go through :func:`integral` (``3.0`` -> 3).  Columns
    missing from ``types`` keep their type.
    """
    types = schema.TYPE_BY_SOURCE if types is None else types
    out = []
    for c in df.columns:
        typ = types.get(c)
        if typ is None or typ == "string":
            out.append(F.col(c))
        elif typ in ("int", "bigint", "smallint", "tinyint"):
            out.append(integral(F.col(c), typ).alias(c))
        else:
            out.append(F.trim(F.col(c).cast("string")).try_cast(typ).alias(c))
    return df.select(*out)


def account_for(df: DataFrame, observation: Observation, types: Mapping[str, str] | None = None,
                tokens: Iterable[str] = schema.NA_TOKENS) -> DataFrame:
    """``df`` (raw text columns) with a count of what cleaning nulls, observed on the pass that reads it.

    Per column of ``types``: ``missing:<column>`` values that are missing-value tokens and
    ``failed:<column>`` other texts that do not cast to the declared type; and ``rows``.
    The counts are there (``observation.get``) once an action has run.
    """
    types = schema.TYPE_BY_SOURCE if types is None else types
    toks, counts = list(tokens), [F.count(F.lit(1)).alias("rows")]
    for c in df.columns:
        if c not in types:
            continue
        missing = F.col(c).isin(toks)
        counts.append(F.count_if(missing).alias(f"missing:{c}"))
        if types[c] != "string":
            text = F.trim(F.col(c))
            cast = integral(F.col(c), types[c]) if "int" in types[c] else text.try_cast(types[c])
            counts.append(F.count_if(F.col(c).isNotNull() & ~missing & cast.isNull()).alias(f"failed:{c}"))
    return df.observe(observation, *counts)


def accounts(spark: SparkSession, observation: Observation, names: Mapping[str, str] | None = None) -> DataFrame:
    """``field, n_missing, n_failed`` of every column (named by ``names``) that :func:`account_for` observed."""
    names = schema.ALIAS_BY_SOURCE if names is None else names
    got = observation.get
    fields = [k.split(":", 1)[1] for k in got if k.startswith("missing:")]
    rows = [(names.get(c, c), int(got[f"missing:{c}"]), int(got.get(f"failed:{c}", 0))) for c in fields]
    return spark.createDataFrame(rows, "field string, n_missing bigint, n_failed bigint")


def to_english(df: DataFrame, fields: Iterable[str] | None = None,
               keep: Iterable[str] = ()) -> DataFrame:
    """Select ``keep`` columns, then the record columns renamed to English.

    ``fields`` are English output names (default: all 28) in output order.
    """
    wanted = schema.FULL_EVENT_FIELDS if fields is None else list(fields)
    source_by_alias = {dst: src for src, dst in schema.ALIAS_BY_SOURCE.items()}
    return df.select(*[F.col(k) for k in keep],
                     *[F.col(source_by_alias[f]).alias(f) for f in wanted])
