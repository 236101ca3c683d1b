"""Tables that micro-batches write, safe to repeat after a failure."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = 16


class KeyedTable:
    """One row per key. A micro-batch writes anew only the parts that its keys fall into.

    A key belongs to one of ``parts`` by hash; choose their number so that a part stays small. A
    micro-batch writes the new versions of its parts to a folder of its own and then publishes, by
    renaming one file, the list of the batch in which each part was written last. Readers go by the
    newest list, so they see a batch whole or not at all. Versions that neither the newest list nor the
    one before it names are deleted. A batch that runs again starts from the list before its own.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str = "symbol", parts: int = PARTS
    ) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.parts = key, parts

    def _files(self):
        """The file system of the table and a maker of its paths."""
        make = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return make(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), make

    def _lists(self) -> list[int]:
        """Ids of the batches that have published, ascending."""
        files, make = self._files()
        folder = make(f"{self.path}/published")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def _list(self, batch_id: int) -> dict[int, int]:
        """Batch in which each part was written last; one entry per part at most."""
        files, make = self._files()
        source = files.open(make(f"{self.path}/published/{batch_id}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        return {int(part): written for part, written in json.loads(text).items()}

    def _publish(self, batch_id: int, written: dict[int, int]) -> None:
        files, make = self._files()
        draft, final = make(f"{self.path}/published/_{batch_id}"), make(f"{self.path}/published/{batch_id}")
        target = files.create(draft, True)
        try:
            target.write(json.dumps(written).encode())
        finally:
            target.close()
        files.delete(final, False)
        files.rename(draft, final)

    def _folder(self, part: int, batch_id: int) -> str:
        return f"{self.path}/rows/batch={batch_id}/part={part}"

    def _read(self, written: dict[int, int]) -> DataFrame:
        folders = [self._folder(part, batch_id) for part, batch_id in written.items()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def current(self, now_seconds: int | None = None) -> DataFrame:
        """All rows as of the newest batch, without those that have expired by ``now_seconds``."""
        known = self._lists()
        rows = self._read(self._list(known[-1]) if known else {})
        return rows if now_seconds is None else rows.where(F.col("expires_at") > now_seconds)

    def merge(self, rows: DataFrame, batch_id: int, now_seconds: int | None = None) -> None:
        """Put ``rows`` over the stored ones of equal keys; expired ones in the same parts go."""
        part = F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int").alias("part")
        rows = rows.select(*self.schema.fieldNames(), part).persist()
        touched = sorted(row["part"] for row in rows.select("part").distinct().collect())
        before = [known for known in self._lists() if known < batch_id]
        written = self._list(before[-1]) if before else {}
        stored = self._read({p: written[p] for p in touched if p in written})
        if now_seconds is not None:
            stored = stored.where(F.col("expires_at") > now_seconds)
        kept = stored.join(rows.select(self.key), self.key, "left_anti").select("*", part)
        if touched:
            (
                kept.unionByName(rows)
                .hint("rebalance", "part")
                .write.mode("overwrite")
                .partitionBy("part")
                .parquet(f"{self.path}/rows/batch={batch_id}")
            )
        rows.unpersist()
        self._publish(batch_id, {**written, **{p: batch_id for p in touched}})
        self._drop(before)

    def _drop(self, before: list[int]) -> None:
        """Delete the versions that the last batch but one replaced, and the list that named them."""
        if len(before) < 2:
            return
        files, make = self._files()
        oldest, previous = self._list(before[-2]), self._list(before[-1])
        for part, batch_id in oldest.items():
            if previous.get(part) != batch_id:
                files.delete(make(self._folder(part, batch_id)), True)
        files.delete(make(f"{self.path}/published/{before[-2]}"), False)


class Published:
    """A small document that every micro-batch writes whole; readers get the newest finished one."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.table = KeyedTable(spark, path, T.StructType([T.StructField("name", T.StringType()), *schema]), "name", 1)
        self.columns = schema.fieldNames()

    def write(self, document: DataFrame, batch_id: int) -> None:
        self.table.merge(document.withColumn("name", F.lit("document")), batch_id)

    def current(self) -> DataFrame:
        return self.table.current().select(*self.columns)


def write_changes(df: DataFrame, batch_id: int, path: str) -> None:
    """Keep the rows a micro-batch changed; a repeated batch replaces its own."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_changes(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest version of every key out of all changes."""
    changes = spark.read.parquet(path)
    columns = [name for name in changes.columns if name != "batch"]
    rest = [name for name in columns if name not in keys]
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "batch").alias("row"))
        .select(*keys, "row.*")
        .select(*columns)
    )
