"""Parsing, normalising and filtering of raw input, and the backfill list."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import adapters, schemas
from tickloom.functions import events as fn
from tickloom.operators import replay
from tickloom.operators.clean import clean_events, restrict_symbols, spot_events
from tickloom.registry import Query
from tickloom.registry.shared import SQL_EVENTS, events, rounded
from tickloom.session import scratch_path
from tickloom.sources import archive, messages
from tickloom.sources import events as event_files

BACKFILL_FROM, BACKFILL_TO = date(1992, 1, 1), date(2003, 12, 31)
_EVENT_ONLY = ("schema_version", "event_type")


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Exchange messages of the trades, by type.

    Views come wrapped, clicks as another message kind, sign-ups for a leveraged token, cheap
    errors with an unreadable price; the rest is bare.
    """
    trades = events(spark, folder)
    kind = F.col("base_asset")
    symbol = F.when(kind == "SIGNUP", F.lit("SIGNUPUPUSDT")).otherwise(F.lower("symbol"))
    price = F.when((kind == "ERROR") & (F.col("last_price") < 20), F.lit("n/a")).otherwise(
        F.col("last_price").cast("string")
    )
    body = F.format_string(
        '{"e":"%s","E":%d,"s":"%s","a":%d,"p":"%s","q":"%s"}',
        F.when(kind == "CLICK", F.lit("trade")).otherwise(F.lit("aggTrade")),
        F.when(kind == "PURCHASE", F.col("event_time") * 1000 + 3).otherwise(F.col("event_time")),
        symbol,
        "trade_id",
        price,
        (F.pmod("trade_id", F.lit(7)) + 0.5).cast("string"),
    )
    wrapped = F.format_string('{"stream":"%s@aggTrade","data":%s}', symbol, body)
    return trades.select(
        F.when(kind == "VIEW", wrapped).otherwise(body).alias("value"), "ingest_time"
    )


def parse_messages(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(messages.parse_messages(raw_messages(spark, folder), "ingest_time"))


def raw_records(trades: DataFrame) -> DataFrame:
    """Trades as a shard delivers them: base64 payload, record id, sequence number.

    The shard comes from the minute of the trade. Dear trades have no record id, every fifth cheap
    one no sequence number of its own.
    """
    shard = F.concat(
        F.lit("shard-"), F.pmod(F.expr("event_time div 60000"), F.lit(4)).cast("string")
    )
    sequence = (F.col("trade_id") + 1).cast("string")
    kind = F.pmod("trade_id", F.lit(5))
    return trades.select(
        F.base64(fn.canonical_json(schemas.EVENT_COLUMNS)).alias("data"),
        F.when(F.col("last_price") < 200, F.concat(shard, F.lit(":"), sequence)).alias("event_id"),
        F.when((kind != 0) | (F.col("last_price") >= 200), sequence).alias("sequence_number"),
    )


def decode_records(spark: SparkSession, folder: str) -> DataFrame:
    decoded = messages.decode_records(raw_records(events(spark, folder)))
    return rounded(decoded.drop(*_EVENT_ONLY))


def replay_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Records delivered twice, with a checkpoint halfway: each new one counts once.

    Record ids are numbers of growing length, so they must not be compared as text.
    """
    records = messages.decode_records(raw_records(events(spark, folder)))
    seen = replay.advance_checkpoints(records.where(F.col("event_time") < 1_705_000_000_000))
    fresh = replay.new_records(records.unionByName(records), seen)
    return fresh.select("symbol", "_shard_id", "_sequence", "trade_id")


def checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    records = messages.decode_records(raw_records(events(spark, folder)))
    return replay.advance_checkpoints(records)


def normalize_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Archive files with a heading each, written by symbol and read back."""
    trades = events(spark, folder)
    fields = {
        "aggregate_id": F.col("trade_id"),
        "price": F.col("last_price"),
        "quantity": F.pmod("trade_id", F.lit(9)) + 0.25,
        "first_trade_id": F.col("trade_id") * 10,
        "last_trade_id": F.col("trade_id") * 10 + F.pmod("trade_id", F.lit(6)) - 2,
        "time": F.when(F.col("base_asset") == "CLICK", F.col("event_time") * 1000 + 233).otherwise(
            F.col("event_time")
        ),
        "buyer_maker": F.lit("True"),
        "best_match": F.lit("True"),
    }
    path = scratch_path(spark, "archive")
    (
        trades.select("symbol", *[value.cast("string").alias(name) for name, value in fields.items()])
        .hint("rebalance", "symbol")
        .write.partitionBy("symbol")
        .option("header", "true")
        .csv(path)
    )
    return rounded(archive.normalise_archive(archive.read_archive(spark, path)))


def candidate_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """Part keys with a symbol made of brand and one of six endings chosen by part size."""
    endings = F.array(
        *[F.lit(e) for e in ("USDT", "BUSD", "upusdt", "BULLUSDT", "downUSDT", "BearUSDT")]
    )
    ending = F.element_at(endings, (F.pmod("p_size", F.lit(6)) + 1).cast("int"))
    return adapters.table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.regexp_replace("p_brand", "#", ""), ending).alias("symbol"),
    )


def symbol_filter(spark: SparkSession, folder: str) -> DataFrame:
    return spot_events(candidate_symbols(spark, folder))


def symbol_filter_allow(spark: SparkSession, folder: str) -> DataFrame:
    """Spot filter with an allow-list for symbols that only look leveraged."""
    return spot_events(candidate_symbols(spark, folder), allow=("BRAND7UPUSDT", "Brand3BullUSDT"))


def symbol_list(spark: SparkSession, folder: str) -> DataFrame:
    """Symbol lists typed by customers, parsed."""
    text = F.concat(
        F.lower("c_mktsegment"), F.lit("usdt , "), F.col("c_mktsegment"), F.lit("USDT,,"),
        F.col("c_mktsegment"), F.lit("DOWNUSDT, c"), F.col("c_nationkey").cast("string"),
        F.when(F.col("c_acctbal") > 0, F.lit("usdt")).otherwise(F.lit("eur")),
    )
    parsed = adapters.table(spark, folder, "customer").select(
        "c_custkey", fn.symbol_list(text).alias("list")
    )
    return parsed.select("c_custkey", F.concat_ws(",", "list").alias("symbols"))


def wanted_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of the brands that a large part belongs to."""
    sales = adapters.brand_events(spark, folder)
    parts = adapters.table(spark, folder, "part").where("p_size >= 49")
    brand = F.concat(F.upper(F.regexp_replace("p_brand", "#", "")), F.lit("USDT"))
    kept = restrict_symbols(sales, parts.select(brand.alias("symbol")))
    return kept.groupBy("symbol").agg(
        F.count("*").alias("sales"), F.round(F.sum("quote_volume"), 2).alias("volume")
    )


def listed_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """Newest id of the symbols on a fixed list."""
    kept = restrict_symbols(events(spark, folder), ["CLICKUSDT", "VIEWUSDT"])
    return kept.groupBy("symbol").agg(F.max("trade_id").alias("newest_id"))


def _sale_days(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.brand_events(spark, folder).select(
        "symbol", F.to_date(F.timestamp_millis("event_time")).alias("day")
    )


def backfill_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Days on which a brand sold nothing."""
    days = _sale_days(spark, folder).distinct()
    return archive.backfill_manifest(
        days.select("symbol").distinct(), BACKFILL_FROM, BACKFILL_TO, existing=days
    )


def backfill_available(spark: SparkSession, folder: str) -> DataFrame:
    """Wanted (brand, day) pairs that have sales, per brand and year."""
    days = _sale_days(spark, folder)
    wanted = archive.backfill_manifest(
        days.select("symbol").distinct(), BACKFILL_FROM, BACKFILL_TO, existing=days, overwrite=True
    )
    return (
        archive.available_days(wanted, days)
        .groupBy("symbol", F.year("day").cast("long").alias("year"))
        .agg(F.count("*").alias("days"))
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """The trades as JSON text, those of errors cut off in the middle."""
    trades = events(spark, folder)
    cut = F.format_string('{"symbol":"%s","trade_id":%d', "symbol", "trade_id")
    return trades.select(
        F.when(F.col("base_asset") == "ERROR", cut)
        .otherwise(fn.canonical_json(schemas.EVENT_COLUMNS))
        .alias("value")
    )


def quarantine_good(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = event_files.split_malformed(_lines(spark, folder))
    return rounded(good.drop(*_EVENT_ONLY))


def quarantine_bad(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = event_files.split_malformed(_lines(spark, folder))
    return bad


def scan_permissive(spark: SparkSession, folder: str) -> DataFrame:
    """Files with cut lines scanned leniently: a bad line becomes a row that cleaning drops."""
    path = scratch_path(spark, "lines")
    _lines(spark, folder).write.option("compression", "gzip").text(path)
    cleaned = clean_events(event_files.read_events(spark, path))
    return rounded(cleaned.drop(*_EVENT_ONLY, "event_timestamp"))


def canonical_json(spark: SparkSession, folder: str) -> DataFrame:
    text = fn.canonical_json(["trade_id", "symbol", "event_time", "base_asset"])
    return events(spark, folder).select("trade_id", text.alias("json"))


def keyed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed stream records, their values read back as numbers."""
    keyed = messages.keyed_records(events(spark, folder))
    value = F.from_json("value", schemas.EVENT)
    return rounded(
        keyed.select("key", F.col("value").endswith("}\n").alias("is_line"), value.alias("v"))
        .select("key", "is_line", "v.trade_id", "v.last_price", "v.quote_volume", "v.event_time")
    )


QUERIES: dict[str, Query] = {
    "parse_messages": parse_messages,
    "decode_records": decode_records,
    "replay_batch": replay_batch,
    "replay_checkpoints": checkpoints,
    "normalize_archive": normalize_archive,
    "symbol_filter": symbol_filter,
    "symbol_filter_allow": symbol_filter_allow,
    "symbol_list": symbol_list,
    "wanted_symbols": wanted_symbols,
    "listed_symbols": listed_symbols,
    "backfill_manifest": backfill_manifest,
    "backfill_available": backfill_available,
    "quarantine_good": quarantine_good,
    "quarantine_bad": quarantine_bad,
    "scan_permissive": scan_permissive,
    "canonical_json": canonical_json,
    "keyed_records": keyed_records,
}

_EVENT_COLUMNS = """symbol, base_asset, event_time, round(last_price, 6) AS last_price,
  round(quote_volume, 6) AS quote_volume, trade_count, ingest_time, trade_id"""
_RECORDS = f"""WITH {SQL_EVENTS},
d AS (
  SELECT *, CASE WHEN last_price < 200 THEN 'shard-' || (event_time // 60000) % 4 ELSE 'unknown' END
              AS _shard_id,
         CAST(trade_id + 1 AS VARCHAR) AS _sequence
  FROM m)"""
_BRAND_DAYS = f"""WITH s AS (
  SELECT DISTINCT upper(replace(p_brand, '#', '')) || 'USDT' AS symbol,
         CAST(l_shipdate AS DATE) AS day
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_CANDIDATES = """WITH c AS (
  SELECT p_partkey, replace(p_brand, '#', '') || CASE p_size % 6 WHEN 0 THEN 'USDT' WHEN 1 THEN 'BUSD'
           WHEN 2 THEN 'upusdt' WHEN 3 THEN 'BULLUSDT' WHEN 4 THEN 'downUSDT' ELSE 'BearUSDT' END
           AS symbol, p_size FROM part)"""

ORACLES: dict[str, str] = {
    "parse_messages": f"""WITH {SQL_EVENTS}
SELECT CAST(2 AS BIGINT) AS schema_version, 'aggTrade' AS event_type, symbol, base_asset,
  event_time, round(last_price, 6) AS last_price,
  round(last_price * (trade_id % 7 + 0.5), 6) AS quote_volume, trade_count, ingest_time, trade_id
FROM m
WHERE base_asset IN ('VIEW', 'PURCHASE') OR (base_asset = 'ERROR' AND last_price >= 20)""",
    "decode_records": f"{_RECORDS} SELECT {_EVENT_COLUMNS}, _shard_id, _sequence FROM d",
    "replay_batch": f"""{_RECORDS},
c AS (SELECT symbol, _shard_id, max(trade_id + 1) AS reached FROM d
      WHERE event_time < 1705000000000 GROUP BY symbol, _shard_id)
SELECT d.symbol, d._shard_id, _sequence, trade_id
FROM d LEFT JOIN c ON c.symbol = d.symbol AND c._shard_id = d._shard_id
WHERE reached IS NULL OR trade_id + 1 > reached""",
    "replay_checkpoints": f"""{_RECORDS}
SELECT symbol, _shard_id AS shard, CAST(max(trade_id + 1) AS VARCHAR) AS sequence
FROM d GROUP BY symbol, _shard_id""",
    "normalize_archive": f"""WITH {SQL_EVENTS}
SELECT CAST(2 AS BIGINT) AS schema_version, 'aggTrade' AS event_type, symbol, base_asset,
  event_time, round(last_price, 6) AS last_price,
  round(last_price * (trade_id % 9 + 0.25), 6) AS quote_volume,
  CAST(greatest(1, trade_id % 6 - 1) AS BIGINT) AS trade_count, event_time AS ingest_time, trade_id,
  'binance-vision-historical' AS source
FROM m""",
    "symbol_filter": f"{_CANDIDATES} SELECT p_partkey, symbol FROM c WHERE p_size % 6 = 0",
    "symbol_filter_allow": f"""{_CANDIDATES} SELECT p_partkey, symbol FROM c
WHERE p_size % 6 = 0 OR symbol = 'Brand#7upusdt' OR upper(symbol) IN ('BRAND7UPUSDT', 'BRAND3BULLUSDT')""",
    "symbol_list": """SELECT c_custkey,
  upper(c_mktsegment) || 'USDT' || CASE WHEN c_acctbal > 0 THEN ',C' || c_nationkey || 'USDT' ELSE '' END
    AS symbols
FROM customer""",
    "wanted_symbols": """SELECT upper(replace(p_brand, '#', '')) || 'USDT' AS symbol,
  count(*) AS sales, round(sum(l_extendedprice), 2) AS volume
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size >= 49) GROUP BY p_brand""",
    "listed_symbols": f"""WITH {SQL_EVENTS}
SELECT symbol, max(trade_id) AS newest_id FROM m
WHERE symbol IN ('CLICKUSDT', 'VIEWUSDT') GROUP BY symbol""",
    "backfill_manifest": f"""{_BRAND_DAYS},
w AS (
  SELECT symbol, CAST(unnest(generate_series(DATE '{BACKFILL_FROM}', DATE '{BACKFILL_TO}',
                                             INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT DISTINCT symbol FROM s))
SELECT symbol, day FROM w EXCEPT SELECT symbol, day FROM s""",
    "backfill_available": f"""{_BRAND_DAYS}
SELECT symbol, year(day) AS year, count(*) AS days FROM s
WHERE day BETWEEN DATE '{BACKFILL_FROM}' AND DATE '{BACKFILL_TO}' GROUP BY symbol, year(day)""",
    "quarantine_good": f"""WITH {SQL_EVENTS}
SELECT {_EVENT_COLUMNS} FROM m WHERE base_asset <> 'ERROR'""",
    "quarantine_bad": f"""WITH {SQL_EVENTS}
SELECT '{{"symbol":"' || symbol || '","trade_id":' || trade_id AS raw
FROM m WHERE base_asset = 'ERROR'""",
    "scan_permissive": f"""WITH {SQL_EVENTS}
SELECT {_EVENT_COLUMNS} FROM m WHERE base_asset <> 'ERROR'""",
    "canonical_json": f"""WITH {SQL_EVENTS}
SELECT trade_id, '{{"base_asset":"' || base_asset || '","event_time":' || event_time
  || ',"symbol":"' || symbol || '","trade_id":' || trade_id || '}}' AS json FROM m""",
    "keyed_records": f"""WITH {SQL_EVENTS}
SELECT symbol AS key, true AS is_line, trade_id, round(last_price, 6) AS last_price,
  round(quote_volume, 6) AS quote_volume, event_time FROM m""",
}
