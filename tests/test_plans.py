"""Physical plans: what is scanned, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from clickloom import operators as op
from clickloom.operators import lookups
from clickloom.workload import QUERIES, derive

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ran_plan(df):
    """The plan after adaptive execution, without the initial alternatives."""
    df.collect()
    kept, skip = [], None
    for line in plan_of(df).splitlines():
        depth = len(line) - len(line.lstrip(" :|+-"))
        if skip is not None and depth >= skip:
            continue
        skip = None
        if "== Initial Plan ==" in line:
            skip = line.index("==")
            continue
        kept.append(line)
    return "\n".join(kept)


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 26])
def test_affinity_reads_the_log_once(spark, broadcast_bytes):
    ranked = op.segment_affinity(
        derive.part_log(spark, SF),
        derive.market_segment(spark, SF),
        "part",
        broadcast_bytes=broadcast_bytes,
    )
    plan = ran_plan(ranked)
    assert "TakeOrderedAndProject" in plan
    assert "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    final = plan.split("Initial Plan")[0]
    assert len(re.findall(r"FileScan parquet \[l_orderkey", final)) == 1


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = plan_of(derive.market_segment(spark, SF))
    assert "EqualTo(c_mktsegment,AUTOMOBILE)" in plan
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>", plan)


def test_lookup_is_hinted_only_below_the_bound(spark):
    log, segment = derive.part_log(spark, SF), derive.market_segment(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan_of(op.segment_affinity(log, segment, "part"))
        large = plan_of(op.segment_affinity(log, segment, "part", broadcast_bytes=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftOuter, BuildRight" in small
    assert "BroadcastHashJoin" not in large
    assert any("_part" in keys for keys in exchanges(large))


def test_wide_matrix_shuffles_sparse_counts_only(spark):
    counts = op.count_long(derive.brand_log(spark, SF), "uid", "brand")
    plan = plan_of(op.to_wide(counts, "uid", "brand", ["Brand#11", "Brand#12"]))
    keys = [re.sub(r"#\d+L?", "", k) for k in exchanges(plan)]
    assert keys[:2] == ["uid", "uid, brand"]
    above = plan[: plan.index("REPARTITION_BY_COL")]
    assert "Exchange" not in above.replace("Exchange hashpartitioning(uid", "", 1)


@pytest.mark.parametrize(
    "name",
    [n for n in QUERIES if n not in {"hourly_kpis_stream", "topic_stream_rows", "stopped_streams"}],
)
def test_no_python_workers_and_no_product_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("Python", "CartesianProduct", "NestedLoop", "MapInPandas"):
        assert node not in plan, node


def test_hot_user_is_reduced_before_the_shuffle(spark):
    """One user with a third of the rows reaches the shuffle as few rows."""
    hot = spark.range(0, 30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("uid"),
        F.concat(F.lit("d"), F.col("id") % 7).alias("domain"),
    )
    plan = plan_of(op.count_vector(hot, "uid", "domain", [f"d{i}" for i in range(7)]))
    before = plan[plan.index("Exchange hashpartitioning(uid") :]
    assert "partial_count(1)" in before
    vector = op.count_vector(hot, "uid", "domain", [f"d{i}" for i in range(7)])
    assert sum(vector.where("uid = 'hot'").first()["domain_features"]) == 10_000


def test_only_lookup_rows_of_hot_keys_are_repeated(spark):
    facts = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) AS key", "id AS uid", "1 AS n")
    lookup = spark.range(1000).selectExpr("id AS key", "id * 2 AS twice")
    hot = lookups.hot_keys(facts, "key")
    assert hot == [7]
    assert lookups.parts_of(lookup, "key", hot, 16).count() == 1000 + 15
    joined = lookups.salted_join(facts, lookup, "key", "inner", spread=["uid"], salts=16)
    expected = facts.join(lookup, "key")
    assert sorted(joined.collect()) == sorted(expected.select(joined.columns).collect())


def test_wide_counts_read_the_source_once(spark):
    plan = plan_of(QUERIES["users_items_wide"](spark, SF))
    assert "events.parquet" not in plan and "clickloom-" in plan
