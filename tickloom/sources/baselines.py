"""Reader for stored baselines in any of their layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas

_ENVELOPE = T.StructType(
    [*schemas.BASELINE.fields, T.StructField("baselines", T.ArrayType(schemas.BASELINE))]
)


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """Column ``value``: JSON documents, one per line where every line of a file is one, else one
    per file.

    Each file is judged by itself. The lines of a file that is one document meet again in the order
    of their split and of their place in it; no names or contents go through the driver.
    """
    lines = (
        spark.read.text(path)
        .select(
            F.trim("value").alias("value"),
            F.input_file_name().alias("file"),
            F.input_file_block_start().alias("split"),
            F.monotonically_increasing_id().alias("line"),
        )
        .where("value != ''")
    )
    complete = F.col("value").rlike(r"^[{\[]") & F.try_parse_json("value").isNotNull()
    spread = lines.where(~complete).select("file").distinct()
    in_order = F.array_sort(F.collect_list(F.struct("split", "line", "value")))
    whole = (
        lines.join(spread, "file", "left_semi")
        .groupBy("file")
        .agg(F.array_join(F.transform(in_order, lambda line: line["value"]), "\n").alias("value"))
    )
    return lines.join(spread, "file", "left_anti").select("value").unionByName(whole.select("value"))


def read_baselines(spark: SparkSession, path: str) -> DataFrame:
    """Baselines from JSON Lines, an array, a single object or an envelope; file or folder.

    All part files are read, whatever mixture of layouts they have; text that is no JSON fails.
    Missing numbers count as zero, symbols are upper-cased, and of several rows for one symbol the
    most recently updated stays.
    """
    parsed = F.from_json("value", T.ArrayType(_ENVELOPE), {"mode": "FAILFAST"})
    rows = _documents(spark, path).select(F.inline(parsed))
    single = F.struct(*[F.col(name) for name in schemas.BASELINE.fieldNames()])
    items = rows.select(
        F.inline(F.when(F.col("baselines").isNotNull(), F.col("baselines")).otherwise(F.array(single)))
    )
    numbers = {}
    for field in schemas.BASELINE.fields:
        if isinstance(field.dataType, (T.DoubleType, T.LongType)):
            numbers[field.name] = F.coalesce(field.name, F.lit(0).cast(field.dataType))
    complete = items.where(F.col("symbol").isNotNull()).withColumns(
        {
            **numbers,
            "symbol": F.upper("symbol"),
            "updated_at": F.coalesce("updated_at", F.lit("")),
        }
    )
    rest = [name for name in schemas.BASELINE.fieldNames() if name not in ("symbol", "updated_at")]
    return (
        complete.groupBy("symbol")
        .agg(F.max(F.struct("updated_at", *rest)).alias("row"))
        .select("symbol", "row.*")
        .select(*schemas.BASELINE.fieldNames())
    )


def baseline_stamp(spark: SparkSession, path: str) -> int | None:
    """When the baselines at ``path`` were last written whole; None while they are being written."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = make(f"{path.rstrip('/')}/_SUCCESS")
    if files.exists(done):
        return files.getFileStatus(done).getModificationTime()
    if not files.exists(make(path)) or files.exists(make(f"{path.rstrip('/')}/_temporary")):
        return None
    return files.getFileStatus(make(path)).getModificationTime()
