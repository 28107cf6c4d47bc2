"""Small tables with every awkward row: nulls, empty and long texts, repeats, ties, clashing columns."""

from __future__ import annotations

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, _row string, label int"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["an", "er", "the", "in", "ou", "st"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(11)
    base = [prose(rng, 120) for _ in range(12)]
    rows: list[tuple[int | None, str | None]] = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[0]), (21, base[0]), (22, base[1] + " one more"), (23, "x " + base[1]), (24, base[2].upper())]
    rows += [(30, None), (31, ""), (32, "  \n\t "), (33, "a"), (34, "A b"), (35, "a B"), (36, "日本語 テスト 🙂 é é"), (37, "!!! ### 12")]
    rows += [(40, prose(rng, 6000)), (41, "z" * 30_000), (42, "\n".join([base[3]] * 3))]
    rows += [(50, base[4]), (50, base[4]), (51, base[5]), (51, base[6])]
    rows += [(None, base[7]), (None, None), (60, "<|im_end|><|endoftext|> a <|startoftext|>")]
    return rows


@pytest.fixture(scope="session")
def documents(spark, texts):
    """``documents`` with further columns whose names operators use inside."""
    langs = ["en", None, "de"]
    rows = [(i, t, langs[k % 3], None, None, 0.5, "x", k) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 1 if i % 3 else 0, 0) for i in range(25)] + [(3, 1, 1), (None, 1, 0), (4, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], COLUMNS)
