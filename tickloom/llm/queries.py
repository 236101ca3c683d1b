"""The registered queries of the text operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import oracles
from tickloom.llm.common import table, text_of, words_of
from tickloom.llm.exact import exact_duplicates
from tickloom.llm.licenses import scan_licenses
from tickloom.llm.lines import dedup_lines
from tickloom.llm.mixing import SEED, count_words, mix_sized, seeded
from tickloom.llm.packing import pack_documents
from tickloom.llm.quality_model import score_quality
from tickloom.llm.quality_rules import quality_rules
from tickloom.llm.runs import periodic_runs, strongest
from tickloom.llm.search import search
from tickloom.llm.shuffling import record_bytes, shuffle_to_shards
from tickloom.llm.simhash import near_duplicates
from tickloom.llm.spotsigs import edited, fingerprint, following, likeness, signatures
from tickloom.llm.toxicity import score_toxicity
from tickloom.session import materialise


THRESHOLD = 0.3


def op1_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    rows = following(table(spark, folder, "documents"))
    changed = rows.withColumn("edit", edited(F.col("text"), F.col("next_text")))
    compared = changed.withColumn("edit_sigs", signatures(F.col("edit")))
    return compared.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edit", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edit_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edit_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    sized = materialise(
        table(spark, folder, "documents").select(
            "doc_id",
            "source",
            count_words(F.col("text")).alias("size"),
            seeded(F.col("doc_id"), SEED).alias("place"),
            F.xxhash64("text").alias("tie"),
        ),
        "sizes",
    )
    return mix_sized(sized).select("doc_id", "size", "source_size", "target", "taken")


def decided(scored: DataFrame) -> DataFrame:
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted)


def op3_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    return decided(
        score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    )


def op4_shard_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    sharded = shuffle_to_shards(table(spark, folder, "documents"))
    text = F.coalesce("record.text", F.lit(""))
    return sharded.select(
        F.col("record.doc_id").alias("doc_id"),
        record_bytes(F.col("record.text")).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_pack_genetic(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack_documents(table(spark, folder, "documents"))
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents")).drop("found")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = dedup_lines(table(spark, folder, "documents"))
    return out.select(
        "doc_id",
        F.col("lines.n_lines").alias("n_lines"),
        F.col("lines.n_dropped").alias("n_dropped"),
        F.sha2(F.col("lines.kept"), 256).alias("kept_sha256"),
    )


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return decided(
        score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    )


def trusted_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that the labels call good."""
    return table(spark, folder, "labels").where(F.col("quality") == 1).select("doc_id")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    out = quality_rules(table(spark, folder, "documents"), trusted_ids(spark, folder))
    columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept score".split()
    return out.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in columns])


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_duplicates(table(spark, folder, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "benchmark"), table(spark, folder, "documents"))


def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents")).withColumnRenamed("sha256", "text_sha256")


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, words): every tenth document by its id's checksum ends in repetitions of its own words."""
    check = F.crc32(F.col("doc_id").cast("string"))
    split = docs.select(
        "doc_id", words_of(text_of()).alias("own"), check.alias("check"), F.floor(check / 10).alias("draw")
    )
    n = F.size("own")
    begin = (F.col("draw") % n).cast("int")
    period = (1 + F.floor((n - begin) / (3 + F.col("draw") % 8))).cast("int")
    tail = F.transform(
        F.sequence(begin, n - 1), lambda i: F.get("own", begin + (i - begin) % period)
    )
    edited = F.concat(F.slice("own", F.lit(1), begin), tail)
    chosen = (F.col("check") % 10 == 0) & (n > 0)
    return split.select("doc_id", F.when(chosen, edited).otherwise(F.col("own")).alias("words"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(repeated_tails(table(spark, folder, "documents")))
    run = strongest(F.col("runs"))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.select("row.doc_id", "runs", "kept", run.alias("run")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "run.start",
        "run.length",
        "run.period",
        F.expr("1000 * run.length div run.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.array_join("kept", " "), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_spot_signatures": op1_spot_signatures,
    "op2_mix_sources": op2_mix_sources,
    "op3_quality_model": op3_quality_model,
    "op4_shard_shuffle": op4_shard_shuffle,
    "op5_license_scan": op5_license_scan,
    "op6_line_dedup": op6_line_dedup,
    "op7_pack_genetic": op7_pack_genetic,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash": op10_simhash,
    "op11_lexical_search": op11_lexical_search,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {
    "op2_mix_sources": oracles.MIX_SOURCES,
    "op6_line_dedup": oracles.LINE_DEDUP,
    "op11_lexical_search": oracles.LEXICAL_SEARCH,
    "op12_exact_dedup": oracles.EXACT_DEDUP,
}
