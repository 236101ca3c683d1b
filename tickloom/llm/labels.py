"""Labels of documents, and the rows that a model may learn them from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def label_of(labels: DataFrame, name: str) -> DataFrame:
    """(l_id, label): one row per labelled document, the mean of its labels if it has several."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull())
    return known.groupBy(F.col("doc_id").alias("l_id")).agg(F.avg(name).alias("label"))


def with_label(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows that have a label. Always a shuffled join: the labels grow with the documents."""
    return rows.join(labels.hint("merge"), rows["doc_id"] == labels["l_id"]).drop("l_id")
