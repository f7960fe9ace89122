"""Inputs of the jobs, derived by Spark from the provided tables.

Each function reads whole tables; ``oracles`` states the same derivation in
SQL.  Times are taken as UTC whatever the session time zone is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import encode_payload
from ..functions.urls import domain_of
from ..schemas import EVENT

# One row in so many has no known user.
ANONYMOUS_SHOP = 17
ANONYMOUS_WEB = 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds of a zone-less timestamp read as UTC."""
    elapsed = ts - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    seconds = elapsed.cast("interval second").cast("decimal(20,6)")
    return F.floor(seconds * 1000).cast("bigint")


def weblog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One visit per event: ``event_id, event_type, uid, timestamp, url``."""
    events = table(spark, sf_dir, "events")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    page_count = pages.count()
    return (
        events.withColumn("page_id", F.col("event_id") % page_count)
        .join(pages, "page_id")
        .select(
            "event_id",
            "event_type",
            F.col("user_id").alias("uid"),
            epoch_ms(F.col("ts")).alias("timestamp"),
            "url",
        )
    )


def user_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested log ``uid, visits``.

    Some rows are anonymous, some hold the same visit twice, and every
    customer also has a row without visits.
    """
    log = weblog(spark, sf_dir)
    visit = F.struct("timestamp", "url")
    uid = F.when(F.col("event_id") % ANONYMOUS_WEB != 0, F.col("uid").cast("string"))
    visits = F.when(F.col("event_type") == "signup", F.array(visit, visit)).otherwise(
        F.array(visit)
    )
    seen = log.select(uid.alias("uid"), visits.alias("visits"))
    idle = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("uid"),
        F.array().cast(seen.schema["visits"].dataType).alias("visits"),
    )
    return seen.unionByName(idle)


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop events in the declared schema; purchase is buy, other kinds stay."""
    k = F.regexp_extract("props", r"(\d+)", 1)
    kind = F.col("event_type")
    columns = {
        "category": F.concat(F.lit("Everyday Goods-"), k.cast("bigint") % 8),
        "event_type": F.when(kind == "purchase", "buy").otherwise(kind),
        "item_id": F.concat(F.lit("Big K-"), k),
        "item_price": F.round(F.col("value") * 100).cast("bigint"),
        "timestamp": epoch_ms(F.col("ts")),
        "uid": F.when(
            F.col("event_id") % ANONYMOUS_SHOP != 0, F.col("user_id").cast("string")
        ),
    }
    events = table(spark, sf_dir, "events")
    return events.select(*[columns[name].alias(name) for name in EVENT.fieldNames()])


def shop_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as JSON messages."""
    return encode_payload(shop_events(spark, sf_dir), EVENT.fieldNames())


def mixed_messages(
    spark: SparkSession, sf_dir: str, bad_times: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """The events as messages with fractions: prices in hundredths, times with ``.0``.

    Every other message carries both as text.  With ``bad_times`` every tenth
    has its time in nanoseconds, as a wrong producer would send it.
    """
    k = F.col("event_id")
    ms = epoch_ms(F.col("ts"))
    if bad_times:
        ms = F.when(k % 10 == 3, ms * 1_000_000).otherwise(ms)
    kind = F.when(F.col("event_type") == "purchase", "buy").otherwise(F.col("event_type"))
    user = F.when(k % ANONYMOUS_SHOP != 0, F.col("user_id").cast("string"))
    fields = {
        "event_type": kind,
        "item_price": F.col("value").cast("decimal(20,2)").cast("string"),
        "timestamp": F.concat(ms.cast("string"), F.lit(".0")),
        "uid": user,
    }
    quote = F.when(k % 2 == 0, '"').otherwise("")
    pairs = [
        F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), around, value, around))
        for name, value in fields.items()
        for around in [F.lit('"') if name in ("event_type", "uid") else quote]
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    return table(spark, sf_dir, "events").select(*keep, body.alias("value"))


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mixed_messages`` with bad times, of which every seventh is cut off before its end."""
    order = F.col("event_id") % 7 == 5
    cut = F.when(order, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    messages = mixed_messages(spark, sf_dir, bad_times=True, keep=["event_id"])
    return messages.select(cut.alias("value"))


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with gender and age; ages reach below 18 and above 100."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("uid"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        (key % 90 + 15).cast("int").alias("age"),
    )


def domain_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One category per host, named after its last label."""
    hosts = table(spark, sf_dir, "pages").select(domain_of(F.col("url")).alias("domain"))
    last = F.regexp_extract("domain", r"([^.]+)$", 1)
    category = F.concat(F.lit("News-"), last, F.lit(" Sites"))
    return hosts.na.drop().distinct().select("domain", category.alias("category"))


def brand_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: ``uid, brand``."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(F.col("o_custkey").alias("uid"), F.col("p_brand").alias("brand"))
    )


def part_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: ``uid, part``."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("uid"), F.col("l_partkey").alias("part")
    )


def market_segment(spark: SparkSession, sf_dir: str, name: str = "AUTOMOBILE") -> DataFrame:
    customers = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == name)
    return customers.select(F.col("c_custkey").alias("uid"))
