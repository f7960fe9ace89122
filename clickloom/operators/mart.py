"""Profile mart: one row per client with shop and web category counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import age_bucket, label, quoted
from ..functions.urls import domain_of
from .lookups import BROADCAST_BYTES, fits_broadcast, salted_join
from .matrix import count_long, count_matrix, distinct_values, to_wide


def explode_visits(df: DataFrame) -> DataFrame:
    """Nested visits to one row ``(uid, timestamp, url)`` per visit.

    Users without visits vanish, repeated visits stay.
    """
    return df.select("uid", F.inline("visits"))


def shop_categories(visits: DataFrame) -> DataFrame:
    """``(uid, cat)`` of every shop visit of a known user, whatever its kind."""
    known = visits.where(F.col("uid").isNotNull())
    return known.select("uid", label("shop_", F.col("category")).alias("cat"))


def shop_category_matrix(
    visits: DataFrame, values: Sequence[str] | None = None
) -> DataFrame:
    """Visits per user and shop category; every event kind counts."""
    return count_matrix(shop_categories(visits), "uid", "cat", values)


def web_category_counts(
    weblogs: DataFrame, categories: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Long ``(uid, cat, n)`` over the visits whose full host has a category."""
    known = explode_visits(weblogs.where(F.col("uid").isNotNull()))
    hosts = known.select("uid", domain_of(F.col("url")).alias("domain"))
    named = categories.select("domain", label("web_", F.col("category")).alias("cat")).na.drop()
    if fits_broadcast(named, broadcast_bytes):
        # An inner join would test the host for null below the join and so parse
        # every URL twice.  Visits without a category form a group of count 0.
        joined = hosts.join(F.broadcast(named), "domain", "left")
        counts = joined.groupBy("uid", "cat").agg(F.count("cat").alias("n"))
        return counts.where(F.col("n") > 0)
    pairs = count_long(hosts, "uid", "domain")
    joined = salted_join(pairs, named, "domain", "inner", spread=["uid"])
    return joined.groupBy("uid", "cat").agg(F.sum("n").alias("n"))


def web_category_matrix(
    weblogs: DataFrame,
    categories: DataFrame,
    values: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Visits per user and website category.

    The columns come from the category table, not from the log, so the log is
    read once.
    """
    if values is None:
        named = categories.select(label("web_", F.col("category")).alias("cat"))
        values = distinct_values(named, "cat")
    counts = web_category_counts(weblogs, categories, broadcast_bytes)
    return to_wide(counts, "uid", "cat", sorted(values))


def profile_mart(
    clients: DataFrame,
    shop: DataFrame,
    web: DataFrame,
    fill: int | None = None,
    max_age: int | None = None,
) -> DataFrame:
    """Clients with age category, left-joined to both matrices on ``uid``.

    A client absent from a matrix has nulls there, or ``fill`` if given.
    """
    people = clients.select("uid", "gender", age_bucket(F.col("age"), max_age).alias("age_cat"))
    mart = people.join(shop, "uid", "left").join(web, "uid", "left")
    if fill is None:
        return mart
    counts = [c for c in [*shop.columns, *web.columns] if c != "uid"]
    cells = [f"coalesce({quoted(c)}, {fill}) AS {quoted(c)}" for c in counts]
    return mart.selectExpr(*people.columns, *cells)
