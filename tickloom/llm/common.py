"""Column helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import materialise
from tickloom.session import reach_workers as reach_workers

SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST_ID = 2**63 - 1


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; pure ASCII takes the byte-wise function."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    Without it Catalyst inlines the value into every lambda of the body and computes it again for
    each element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Array of the words of a text, split at ASCII white space."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes, which stand for a text in joins and groupings."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def packed(df: DataFrame, name: str = "_row") -> DataFrame:
    """All columns of a frame in one struct, so that extra columns cannot clash with work columns."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def number_copies(
    df: DataFrame, key: str, copies: int, per_task: int = 1 << 16
) -> tuple[DataFrame, DataFrame]:
    """Rows of keys with at most ``copies`` rows, and all others with columns k1, k2 and ``number``.

    The others are counted by content, with partial aggregation, so that however many are equal, one row
    per task and content is shuffled. k1 and k2 are hashes of all columns; equal rows are drawn out again
    and numbered from 0, ``per_task`` of them at once. (key, k1, k2, number) tells all rows apart. ``df``
    has no columns k1, k2, number, rows or from; those of documents belong into a struct.
    """
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > copies).select(key)
    hot = materialise(hot, "hot")
    counted = (
        packed(df.join(hot, key, "left_semi"))
        .select("_row", F.to_json("_row", {"ignoreNullFields": "false"}).alias("_content"))
        .groupBy(F.xxhash64("_content").alias("k1"), F.xxhash64(F.lit(1), "_content").alias("k2"))
        .agg(F.count(F.lit(1)).alias("rows"), F.any_value("_row").alias("_row"))
        .select("_row.*", "k1", "k2", "rows")
    )
    steps = F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(per_task).cast("long"))
    dealt = counted.withColumn("from", F.explode(steps)).repartition("k1", "k2", "from")
    last = F.least(F.col("from") + per_task, F.col("rows")) - 1
    drawn = dealt.withColumn("number", F.explode(F.sequence("from", last))).drop("rows", "from")
    return df.join(hot, key, "left_anti"), drawn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
