"""Which items are most typical for a segment of users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import lenient_host, strip_www, unescape_url
from .lookups import BROADCAST_BYTES, fits_broadcast, salted_join
from .matrix import count_long

# One integer digit, so that a perfect score of 1 fits; 20 fractional digits.
RELEVANCE_TYPE = "decimal(21,20)"


def valid_log_rows(log: DataFrame) -> DataFrame:
    """Log rows with a user id and an http(s) URL, plus their ``domain``.

    ``log.url`` is percent-encoded.  Rows with an empty host are dropped too.
    """
    # The prefix test is cheap and spares other URLs the decoding.
    candidates = log.where(F.col("uid").isNotNull() & F.col("url").startswith("http"))
    # The host pattern itself demands http(s):// and a host.
    return (
        candidates.withColumn("url", unescape_url(F.col("url")))
        .withColumn("domain", strip_www(lenient_host(F.col("url")), "prefix"))
        .where(F.col("domain") != "")
    )


def item_counts(
    log: DataFrame,
    segment: DataFrame,
    item: str,
    uid: str = "uid",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows per item: all (``cnt_all``) and those of segment users (``cnt_auto``).

    Rows without user or item do not count.
    """
    members = segment.select(uid).na.drop().distinct()
    flagged = members.withColumn("_member", F.lit(True))
    rows = log.select(uid, item).na.drop()
    if fits_broadcast(members, broadcast_bytes):
        counts = (
            rows.join(F.broadcast(flagged), uid, "left")
            .groupBy(item)
            .agg(F.count("*").alias("cnt_all"), F.count("_member").alias("cnt_auto"))
        )
    else:
        pairs = count_long(rows, uid, item)
        own = F.when(F.col("_member"), F.col("n")).otherwise(F.lit(0))
        counts = (
            salted_join(pairs, flagged, uid, "left", spread=[item])
            .groupBy(item)
            .agg(F.sum("n").alias("cnt_all"), F.sum(own).alias("cnt_auto"))
        )
    # Always true; it keeps later projections out of the aggregate, so that
    # every use of the counts plans the same shuffle and Spark runs it once.
    return counts.where(F.col("cnt_all") > 0)


def segment_affinity(
    log: DataFrame,
    segment: DataFrame,
    item: str,
    k: int = 200,
    uid: str = "uid",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Top ``k`` items by ``cnt_auto^2 / (cnt_all * sum(cnt_auto))``.

    Rows count, not distinct users.  Ties are broken by item, ascending.  The
    totals are a scalar subquery over the same counts: Spark reuses their
    shuffle, so the log is read once and nothing passes through the driver.
    """
    counts = item_counts(log, segment, item, uid, broadcast_bytes)
    totals = counts.agg(
        F.struct(F.sum("cnt_all").alias("all"), F.sum("cnt_auto").alias("auto")).alias("totals")
    ).scalar()
    # Doubles, because a product of two row counts may not fit a BIGINT.
    own, every, total = (
        c.cast("double") for c in (F.col("cnt_auto"), F.col("cnt_all"), totals["auto"])
    )
    score = F.try_divide(F.pow(own, F.lit(2.0)), every * total)
    return (
        counts.select(item, score.cast(RELEVANCE_TYPE).alias("relevance"))
        .orderBy(F.col("relevance").desc(), F.col(item).asc())
        .limit(k)
    )
