"""Sharding by a two-pass external shuffle.

First pass: every record goes by a seeded hash of its id and text to one of as many buckets as the
bytes need, so a bucket fits in a task's memory however large the table; the buckets' row counts,
summed up, give each bucket its place in the order of the whole. Second pass: a bucket is put in
hash order, which makes the result independent of arrival order, and shuffled by Spark's
``shuffle(array, seed)``, a Fisher-Yates shuffle inside the JVM. The place of a record in the whole
order then deals it to a shard and a slot, so shard sizes differ by one row at most.

Copies of a text have ids of their own and scatter. Defined cases: a null text counts 16 bytes like an empty one. Null ids scatter by their texts. Rows
equal in id and text are kept and get a slot each; more than COPIES of them are scattered by all their
columns and, where these are equal as well, by a number. A very long text is one record, which a bucket
has to hold whole; buckets are measured by the bytes of all text columns. An empty table gives an empty
result. Extra columns are carried whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.llm.common import number_copies, packed
from tickloom.session import materialise

SHARDS = 40
BUCKET_BYTES = 16 << 20
ROW_BYTES = 16
SEED = 23
COPIES = 64
COPIES_PER_TASK = 1 << 16
# Offsets, 16 bytes a bucket, are sent to all executors up to this many buckets and joined beyond.
BROADCAST_BUCKETS = 1 << 18


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def scatter_key(row: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), row.getField("doc_id"), row.getField("text"))


def _held_bytes(docs: DataFrame) -> Column:
    """About what a record takes in memory: its strings and 16 bytes for each column."""
    strings = [F.octet_length(F.col(f"`{f.name}`")) for f in docs.schema if f.dataType.typeName() == "string"]
    return sum((F.coalesce(size, F.lit(0)).cast("long") for size in strings), F.lit(16 * len(docs.columns)))


def scatter_copies(keyed: DataFrame, copies: int = COPIES) -> DataFrame:
    """Rows (record, key) with a key of its own for every row of a key that has over ``copies`` rows."""
    others, drawn = number_copies(keyed, "key", copies, COPIES_PER_TASK)
    return others.select("record", "key").unionByName(
        drawn.select("record", F.xxhash64("key", "k1", "k2", "number").alias("key"))
    )


def shuffle_to_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = SEED,
) -> DataFrame:
    """All columns of ``docs`` in a struct ``record``, with ``shard`` and ``slot``.

    ``bucket_bytes`` should be about a hundredth of an executor core's memory, as a bucket is held
    as rows of one array.
    """
    keyed = scatter_copies(packed(docs, "record").withColumn("key", scatter_key(F.col("record"), seed)))
    total = docs.agg(F.sum(_held_bytes(docs))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod("key", F.lit(buckets)).cast("int")
    offsets = (
        keyed.groupBy(bucket.alias("b"))
        .count()
        .select("b", (F.sum("count").over(W.orderBy("b")) - F.col("count")).alias("offset"))
    )
    offsets = materialise(offsets, "offsets")
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    gathered = (
        keyed.withColumn("bucket", bucket)
        .repartitionById(buckets, F.col("bucket"))
        .sortWithinPartitions("bucket", "key", F.col("record.doc_id"))
        .groupBy("bucket")
        .agg(F.collect_list("record").alias("records"))
        # the shuffle draws by the number of its partition, which here is that of the bucket: behind a
        # join it could be any
        .select("bucket", F.posexplode(F.shuffle("records", seed)).alias("at", "record"))
    )
    placed = (
        gathered.join(offsets, F.col("bucket") == F.col("b"))
        .withColumn("place", F.col("offset") + F.col("at"))
    )
    return placed.select(
        "record",
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; records in slot order inside a file, larger shards in several files."""
    rows = sharded.select("shard", "slot", "record.*")
    (
        rows.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
