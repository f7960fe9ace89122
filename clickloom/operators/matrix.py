"""Count matrices: long ``(row, item, n)`` for the work, wide at the edge.

Counting happens on ``(row, item)`` with map-side partial sums, so neither a
hot row key nor a hot item gathers in one task.  Only the reduced counts are
then moved to one place per row key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import quoted, sql_text
from ..paths import pinned, scratch_dir


def count_long(df: DataFrame, row: str, item: str) -> DataFrame:
    """Sparse counts ``(row, item, n)``; rows with a null in either are left out."""
    return (
        df.select(row, item).na.drop().groupBy(row, item).agg(F.count("*").alias("n"))
    )


def distinct_values(df: DataFrame, item: str) -> list[str]:
    """Sorted distinct non-null values of ``item``, to become column names.

    Bounded by ``spark.sql.pivotMaxValues``: a table cannot have more columns
    than that anyway, and the long form has no such limit.
    """
    bound = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = df.select(item).na.drop().distinct().orderBy(item).limit(bound + 1).collect()
    if len(found) > bound:
        raise ValueError(
            f"more than {bound} distinct values of {item!r}: keep the counts in long form"
            " or raise spark.sql.pivotMaxValues"
        )
    return [r[0] for r in found]


def _differ_beyond_case(values: Sequence[str]) -> None:
    """Column names are the same to Spark and to its files when only their case differs."""
    seen: dict[str, str] = {}
    for value in map(str, values):
        other = seen.setdefault(value.lower(), value)
        if other != value:
            raise ValueError(
                f"items {other!r} and {value!r} differ in case only and cannot both be"
                " columns: keep the counts in long form"
            )


def to_wide(
    counts: DataFrame,
    row: str,
    item: str,
    values: Sequence[str],
    n: str = "n",
    gathered: bool = False,
) -> DataFrame:
    """Long counts to one column per value, in the given order, absent = 0.

    Only the sparse counts are shuffled, once, by ``row``; both aggregates of
    the pivot then run in place.  ``gathered`` says that each row's counts lie
    together already, as in a table bucketed by ``row``: nothing is shuffled.
    """
    if not values:
        return counts.select(row).distinct()
    _differ_beyond_case(values)
    placed = counts if gathered else counts.repartition(row)
    wide = placed.groupBy(row).pivot(item, list(values)).agg(F.sum(n))
    names = [quoted(str(v)) for v in values]
    return wide.selectExpr(quoted(row), *[f"coalesce({v}, 0L) AS {v}" for v in names])


def count_matrix(
    df: DataFrame, row: str, item: str, values: Sequence[str] | None = None
) -> DataFrame:
    """Wide counts, columns sorted by item, absent = 0.

    Without ``values`` the reduced counts are written to the shared folder and
    the items are looked up there, so ``df`` is read once either way.
    """
    counts = count_long(df, row, item)
    if values is None:
        counts = pinned(counts, scratch_dir(df.sparkSession))
        values = distinct_values(counts, item)
    return to_wide(counts, row, item, sorted(values))


def count_map(counts: DataFrame, row: str, item: str, n: str = "n") -> DataFrame:
    """Long counts to one map ``items`` of item to count per row key: no limit on the items.

    Counts are unique by row and item, so a row gathers its own items only.
    """
    cells = F.collect_list(F.struct(item, n))
    return counts.groupBy(row).agg(F.map_from_entries(F.array_sort(cells)).alias("items"))


def to_long(wide: DataFrame, key: str, item: str = "item", n: str = "n") -> DataFrame:
    """Wide counts back to the non-zero long counts.

    One zero cell per row is kept (the first column), so a row of zeros
    survives the way back to the wide form.
    """
    values = [c for c in wide.columns if c != key]
    if not values:
        return wide.selectExpr(
            quoted(key), f"cast(NULL AS string) AS {item}", f"cast(0 AS bigint) AS {n}"
        )
    # Cells leave the row as an array: a zero cell then costs no output row.
    names = "array(" + ", ".join(sql_text(c) for c in values) + ")"
    cells = "array(" + ", ".join(f"cast({quoted(c)} AS bigint)" for c in values) + ")"
    return (
        wide.selectExpr(quoted(key), f"{cells} AS _cells")
        .selectExpr(quoted(key), f"posexplode(_cells) AS (_at, {n})")
        .where((F.col(n) != 0) | (F.col("_at") == 0))
        .selectExpr(quoted(key), f"element_at({names}, _at + 1) AS {item}", n)
    )


def union_missing(a: DataFrame, b: DataFrame, fill: int = 0) -> DataFrame:
    """Union by name; columns one side lacks become ``fill``; sorted by name."""
    types = {f.name: f.dataType for df in (b, a) for f in df.schema.fields}
    names = sorted(types)

    def complete(df: DataFrame) -> DataFrame:
        own = set(df.columns)
        return df.selectExpr(
            *[
                quoted(c)
                if c in own
                else f"cast({fill} AS {types[c].simpleString()}) AS {quoted(c)}"
                for c in names
            ]
        )

    return complete(a).unionByName(complete(b))


def sum_by_key(df: DataFrame, key: str) -> DataFrame:
    """Sum of every other numeric column per key; the names stay as they are."""
    numeric = [
        f.name
        for f in df.schema.fields
        if f.name != key and isinstance(f.dataType, T.NumericType)
    ]
    if not numeric:
        return df.select(key).distinct()
    sums = df.groupBy(key).sum(*[quoted(c) for c in numeric])
    return sums.toDF(key, *numeric)


def merge_counts(old: DataFrame, new: DataFrame, row: str, item: str, n: str = "n") -> DataFrame:
    """Long counts of two periods added up."""
    return old.unionByName(new).groupBy(row, item).agg(F.sum(n).alias(n))


def merge_matrix(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Add two wide matrices: same cells are summed, new rows and columns join.

    Runs on the long form, so the shuffle carries non-zero cells only.
    """
    columns = sorted((set(old.columns) | set(new.columns)) - {key})
    merged = merge_counts(to_long(old, key), to_long(new, key), key, "item")
    return to_wide(merged, key, "item", columns)


def max_event_date(df: DataFrame, date: str = "date") -> str | None:
    """Newest ``yyyyMMdd`` in the data, a single value for the output path."""
    return df.agg(F.max(date).alias("newest")).first()["newest"]
