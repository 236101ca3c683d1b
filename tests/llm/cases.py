"""Documents with every kind of odd row, and small helpers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# extra columns named like the operators' own work columns and results
CLASHING = (
    "size shard slot record row t sigs cell words label score quality lines taken target key bucket id"
).split()
LONG = " ".join(f"word{i % 701} of the part{i % 97}\n" for i in range(20_000))
ROWS = [
    (1, "The cat sat on the mat and the dog of the house ran to a big red barn. " * 4, "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "  \t\n  ", "en", "b", 6),
    (5, "The cat sat on the mat and the dog of the house ran to a big red barn. " * 4, "en", "b", 1),
    (5, "The cat sat on the mat and the dog of the house ran to a big red barn. " * 4, "en", "b", 1),
    (6, LONG, "en", "a", len(LONG)),
    (None, "a text without an id, in the first of two rows", "en", None, 4),
    (None, "a text without an id, in the first of two rows", "en", None, 4),
    (7, "ein Wort\nA shared line of some length\nÉtude K Ärger MIT License\n", "de", "é", 3),
    (8, "a shared LINE of some length  \n\n\nCC BY and cc by-nc 4.0", "en", "a", 3),
    (9, "x", None, "b", 1),
]


def documents(spark: SparkSession, rows=ROWS, clashing: bool = False) -> DataFrame:
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        for name in CLASHING:
            df = df.selectExpr("*", f"'{name}' AS {name}")
    return df


def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def ascii_lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
