"""Market events out of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom import params, schemas
from tickloom.functions import events as fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _events(rows: DataFrame, **columns: str) -> DataFrame:
    """The event columns, each given as an SQL expression over ``rows``."""
    fixed = {
        "schema_version": f"{params.SCHEMA_VERSION}L",
        "base_asset": f"regexp_replace({columns['symbol']}, '{fn.QUOTE_ASSET}$', '')",
    }
    named = {**fixed, **columns}
    return rows.selectExpr(*[f"{named[name]} AS {name}" for name in schemas.EVENT_COLUMNS])


def _millis(column: str) -> str:
    """Epoch milliseconds of a timestamp without zone, read in the session zone."""
    return f"unix_millis(CAST({column} AS timestamp))"


def _trades(spark: SparkSession, folder: str, symbol: str) -> DataFrame:
    return _events(
        table(spark, folder, "events"),
        event_type="'aggTrade'",
        symbol=symbol,
        event_time=_millis("ts"),
        last_price="value",
        quote_volume="value * (1 + CAST(get_json_object(props, '$.k') AS bigint))",
        trade_count="1L",
        ingest_time=f"{_millis('ts')} + pmod(event_id, 500)",
        trade_id="event_id",
    )


def market_events(spark: SparkSession, folder: str) -> DataFrame:
    """One trade per row of ``events``: symbol from the type, volume from value and ``props.k``."""
    return _trades(spark, folder, f"concat(upper(event_type), '{fn.QUOTE_ASSET}')")


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same trades keyed by user instead of type: many symbols with short histories."""
    return _trades(spark, folder, f"concat('U', user_id, '{fn.QUOTE_ASSET}')")


def brand_events(spark: SparkSession, folder: str) -> DataFrame:
    """Sales as trades: symbol from the part's brand, unit price, time at day grain.

    Order and line number repeat across rows, so ids tie and copies exist.
    """
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return _events(
        lines.join(parts, lines["l_partkey"] == parts["p_partkey"]),
        event_type="'sale'",
        symbol=f"concat(upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '')), '{fn.QUOTE_ASSET}')",
        event_time=_millis("l_shipdate"),
        last_price="l_extendedprice / l_quantity",
        quote_volume="l_extendedprice",
        trade_count="CAST(l_quantity AS bigint)",
        ingest_time=f"{_millis('l_shipdate')} + l_linenumber * 1000L",
        trade_id="l_orderkey * 8 + l_linenumber",
    )
