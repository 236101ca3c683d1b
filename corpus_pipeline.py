"""From raw documents to packed token sequences, one Parquet table per stage.

Each stage takes the documents its predecessor kept and returns the columns of ``documents``, the last
one the packed pieces. Columns beyond those of ``documents`` are left out, whatever their names. An
empty table gives an empty result of every stage; a very long text is one document like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.lines import dedup_lines
from tickloom.llm.mixing import mix_texts
from tickloom.llm.packing import pack_documents
from tickloom.llm.quality_rules import quality_rules
from tickloom.llm.queries import trusted_ids
from tickloom.llm.simhash import drop_near_duplicates
from tickloom.session import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules do not reject.

    Null and empty texts have no words and are rejected; repeated rows are judged each.
    """
    judged = quality_rules(docs.select(*COLUMNS), trusted_ids(spark, sf_dir))
    return judged.where("quality.kept").select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier one has.

    A null text becomes an empty one. Repeated rows of one id are one document and keep their lines; of
    equal texts with ids of their own the smallest id keeps them, null ids come last.
    """
    out = dedup_lines(docs.select(*COLUMNS))
    kept = F.col("lines.kept")
    return out.withColumns({"text": kept, "n_chars": F.char_length(kept).cast("long")}).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    Of repeated rows one stays. Texts without words are alike, so one of them stays.
    """
    return drop_near_duplicates(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, one per shard of a source cut to fit.

    Texts without words are taken not at all. The null source is one of the sources.
    """
    return mix_texts(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    A null or empty text is one piece of one token; repeated rows are packed each, null ids stay null.
    """
    return pack_documents(docs.select(*COLUMNS))


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_shared_lines),
    ("near-duplicates", keep_one_of_each),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


# Neither fingerprints, tokens nor evolved packings can be expressed in SQL.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
