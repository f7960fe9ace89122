"""Queries by name: ``(spark, sf_dir) -> DataFrame``.

Each runs one operator, or one job, over the whole derived input.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from .. import schemas
from ..functions import decode_events as decode_shop_events
from ..functions import (
    age_bucket,
    decode_payload,
    domain_of,
    encode_payload,
    event_date,
    label,
    price,
    unescape_url,
    visit_indicators,
)
from ..plans import (
    feature_table,
    job_conf,
    kpi_messages,
    pinned_visits,
    split_events,
    split_topic,
    store_matrix,
    stream_kpis,
    update_count_store,
)
from ..plans.features import read_feature_tables, visit_domains, write_feature_tables
from ..plans.mart import shop_matrix as pinned_shop_matrix
from ..plans.stream_kpis import WINDOW_KEY
from ..plans.users_items import update_users_items
from ..plans.vocabulary import add_dates, top_items_by_date
from ..sinks import SinkSpec, split_by_kind, write_ranked, write_snapshot, write_table
from ..sinks.split import KINDS, PARTITIONS, VERSIONS, dated_events
from ..sources import (
    SourceSpec,
    TopicSpec,
    latest_snapshot,
    read_events_dir,
    read_rejected,
    read_snapshot_counts,
    read_segment,
    read_snapshot,
    read_split_events,
    read_table,
    read_topic_batch,
    read_topic_stream,
    read_weblog,
)
from ..sources.files import kind_items
from ..sources.paths import join, pinned, scratch_dir
from ..streaming import AVAILABLE_NOW, read_compacted, read_updates, stop_streams, write_topic_stream
from . import derive

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

VECTOR_SIZE = 10
SPLIT_DATE = "20240120"
LATER_DATE = "20240125"
# Kinds of the events table, purchases under the name the jobs use.
EVENT_KINDS = ("buy", "click", "error", "signup", "view")
TOPIC_PARTITIONS = 3
TOPIC_OFFSET = 100


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- affinity ---------------------------------------------------------------


@query
def affinity_topk(spark, sf_dir):
    ranked = op.segment_affinity(
        derive.brand_log(spark, sf_dir), derive.market_segment(spark, sf_dir), "brand"
    )
    return ranked.select("brand", F.col("relevance").cast("double").alias("relevance"))


@query
def affinity_large_segment(spark, sf_dir):
    """The same ranking by the way taken when the segment exceeds a broadcast."""
    ranked = op.segment_affinity(
        derive.brand_log(spark, sf_dir),
        derive.market_segment(spark, sf_dir),
        "brand",
        broadcast_bytes=0,
    )
    return ranked.select("brand", F.col("relevance").cast("double").alias("relevance"))


@query
def affinity_parts(spark, sf_dir):
    """Many items, so the list is cut at its depth and ties matter."""
    log = derive.part_log(spark, sf_dir)
    ranked = op.segment_affinity(log, derive.market_segment(spark, sf_dir), "part")
    # Twenty digits are fewer than a double has for scores this small.
    scaled = F.round(F.col("relevance").cast("double") * 1e15).cast("bigint")
    return ranked.select("part", scaled.alias("relevance_e15"))


def _encoded_log(spark, sf_dir):
    log = derive.weblog(spark, sf_dir)
    seconds = (F.col("timestamp") / 1000).alias("ts")
    return log.select("uid", seconds, F.url_encode("url").alias("url"))


@query
def affinity_domains(spark, sf_dir):
    log = op.valid_log_rows(_encoded_log(spark, sf_dir))
    ranked = op.segment_affinity(log, derive.market_segment(spark, sf_dir), "domain")
    return ranked.select("domain", F.col("relevance").cast("double").alias("relevance"))


@query
def valid_log_rows(spark, sf_dir):
    return op.valid_log_rows(_encoded_log(spark, sf_dir)).select("uid", "ts", "url", "domain")


@query
def ranked_tsv(spark, sf_dir):
    """Ranking written as text and read back; the digits are compared as text."""
    path = join(scratch_dir(spark), "ranked")
    write_ranked(
        op.segment_affinity(
            derive.brand_log(spark, sf_dir), derive.market_segment(spark, sf_dir), "brand"
        ),
        path,
    )
    back = spark.read.schema("brand string, relevance string").csv(path, sep="\t")
    digits = F.length(F.substring_index("relevance", ".", -1)).cast("bigint")
    return back.select(
        "brand", F.col("relevance").cast("double").alias("relevance"), digits.alias("digits")
    )


@query
def weblog_tsv(spark, sf_dir):
    """Log written as tab-separated text and read back with its schema."""
    path = join(scratch_dir(spark), "weblog")
    _encoded_log(spark, sf_dir).write.csv(path, sep="\t", quote="")
    return read_weblog(spark, path).select("uid", "ts", unescape_url(F.col("url")).alias("url"))


@query
def segment_ids(spark, sf_dir):
    """Segment documents with repeated and unreadable ids."""
    path = join(scratch_dir(spark), "segment")
    member = derive.market_segment(spark, sf_dir).select(F.col("uid").cast("string"))
    ids = F.array(F.col("uid"), F.lit("-"), F.col("uid")).alias("autousers")
    member.select(ids).write.json(path)
    return read_segment(spark, path)


# --- columns ----------------------------------------------------------------


@query
def domain_counts(spark, sf_dir):
    domains = derive.weblog(spark, sf_dir).select("uid", domain_of(F.col("url")).alias("domain"))
    return domains.groupBy("domain").agg(F.count("*").alias("n"))


@query
def domain_variants(spark, sf_dir):
    url = F.col("url")
    upper = F.url_encode(F.concat(F.lit("http://WWW."), domain_of(url), F.lit("/a%zz+b")))
    inner = F.concat(F.lit("http://my.www.x."), domain_of(url))
    return derive.weblog(spark, sf_dir).select(
        "event_id",
        domain_of(url).alias("strict"),
        domain_of(url, parser="lenient").alias("lenient"),
        domain_of(upper, encoded=True, parser="lenient", lower=True).alias("encoded_lower"),
        domain_of(inner, strip="anywhere").alias("anywhere"),
        domain_of(inner, strip=None).alias("unstripped"),
        unescape_url(F.concat(url, F.lit("/a%zz+b%41"))).alias("unescaped"),
    )


@query
def domain_hosts(spark, sf_dir):
    """Hosts that tell the parsers apart: upper case, port, user info, underscores, addresses."""
    host = domain_of(F.col("url"))
    address = F.concat(F.lit("[2001:db8::"), F.col("event_id") % 10, F.lit("]"))
    urls = {
        "port": F.concat(F.lit("http://Us:er@www."), F.upper(host), F.lit(":8080/a?b#c")),
        "address": F.concat(F.lit("https://"), address, F.lit(":80/")),
        "underscore": F.concat(F.lit("http://a_b."), host, F.lit("/x y")),
    }
    return derive.weblog(spark, sf_dir).select(
        "event_id",
        *(
            domain_of(url, parser=parser, lower=True).alias(f"{name}_{parser}")
            for name, url in urls.items()
            for parser in ("strict", "lenient")
        ),
    )


@query
def age_buckets(spark, sf_dir):
    age = F.col("age")
    return derive.clients(spark, sf_dir).select(
        "uid", "age", age_bucket(age).alias("age_cat"), age_bucket(age, 99).alias("age_cat_99")
    )


@query
def bucket_distribution(spark, sf_dir):
    people = derive.clients(spark, sf_dir)
    return op.bucket_distribution(
        people.select("uid", "gender", age_bucket(F.col("age")).alias("age_cat"))
    )


@query
def label_names(spark, sf_dir):
    part = derive.table(spark, sf_dir, "part")
    raw = F.concat_ws("-", "p_type", "p_name", "p_brand")
    return part.select("p_partkey", label("view_", raw).alias("name"))


@query
def event_dates(spark, sf_dir):
    dates = derive.shop_events(spark, sf_dir).select(event_date(F.col("timestamp")).alias("date"))
    return dates.groupBy("date").agg(F.count("*").alias("n"))


@query
def max_event_date(spark, sf_dir):
    """Newest date, as the single row an output path is named after."""
    events = derive.shop_events(spark, sf_dir)
    newest = op.max_event_date(events.select(event_date(F.col("timestamp")).alias("date")))
    return spark.createDataFrame([(newest,)], "newest string")


@query
def visit_flags(spark, sf_dir):
    log = derive.weblog(spark, sf_dir)
    return log.select("event_id", *visit_indicators(F.col("timestamp")))


# --- messages, topics, split ------------------------------------------------


@query
def decode_events(spark, sf_dir):
    return decode_payload(derive.shop_messages(spark, sf_dir), schemas.EVENT)


@query
def decode_events_job(spark, sf_dir):
    """The decoding the jobs use, over messages with numbers and with numbers as text."""
    messages = derive.mixed_messages(spark, sf_dir)
    return decode_shop_events(messages).select(
        "event_type", price(F.col("item_price")).cast("double").alias("item_price"), "timestamp", "uid"
    )


@query
def encode_events(spark, sf_dir):
    return encode_payload(
        derive.shop_events(spark, sf_dir), ["event_type", "item_id", "item_price", "uid"], "shop"
    )


@query
def topic_batch(spark, sf_dir):
    """Bounded topic read from a numeric offset of partition 0."""
    path = join(scratch_dir(spark), "topic")
    events = derive.table(spark, sf_dir, "events")
    place = [
        (F.col("event_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("event_id") / TOPIC_PARTITIONS).alias("offset"),
        F.to_json(F.struct("event_id", "event_type", "user_id")).alias("value"),
    ]
    events.select(*place).write.parquet(path)
    topic = TopicSpec("shop", "parquet", path=path, partitions=TOPIC_PARTITIONS)
    messages = read_topic_batch(spark, topic, TOPIC_OFFSET)
    schema = "event_id bigint, event_type string, user_id bigint"
    return decode_payload(messages, schema, keep=["partition", "offset"])


def _message_topic(spark, sf_dir):
    """Messages as one text file per core, read by a stream in three or four batches."""
    path = join(scratch_dir(spark), "messages")
    files = spark.sparkContext.defaultParallelism
    derive.shop_messages(spark, sf_dir).repartition(files).write.text(path)
    return TopicSpec("shop", "text", {"maxFilesPerTrigger": str(max(1, files // 3))}, path)


def _split_dir(spark, sf_dir):
    """Both kinds split by date, from the topic."""
    path = join(scratch_dir(spark), "visits")
    split_events(spark, _message_topic(spark, sf_dir), path)
    return path


@query
def split_events_rows(spark, sf_dir):
    """Every line of the split output with the kind and date of its directory."""
    lines = read_split_events(spark, _split_dir(spark, sf_dir), KINDS)
    directory = F.regexp_extract(F.input_file_name(), r"/([a-z]+)/p_date=", 1)
    return lines.withColumn("kind", directory)


@query
def events_dir(spark, sf_dir):
    path = _split_dir(spark, sf_dir)
    return read_events_dir(spark, path, "view").unionByName(read_events_dir(spark, path, "buy"))


@query
def events_one_date(spark, sf_dir):
    """One day of both kinds, read from its date directories only."""
    path = join(scratch_dir(spark), "visits")
    split_by_kind(derive.shop_events(spark, sf_dir), path, layout=PARTITIONS)
    days = [read_events_dir(spark, path, kind, dates=[SPLIT_DATE]) for kind in KINDS]
    return days[0].unionByName(days[1])


@query
def split_with_bad_times(spark, sf_dir):
    """Messages whose times are in the wrong unit: their date is unreadable, none is lost."""
    path = join(scratch_dir(spark), "visits")
    split_by_kind(decode_shop_events(derive.mixed_messages(spark, sf_dir, bad_times=True)), path)
    lines = read_split_events(spark, path, KINDS)
    return lines.groupBy("event_type", "date").agg(F.count("*").alias("n"))


@query
def split_versions(spark, sf_dir):
    """The split output published by manifests: a first half, then all events in its place."""
    path = join(scratch_dir(spark), "visits")
    events = derive.shop_events(spark, sf_dir)
    for part in (events.where(event_date(F.col("timestamp")) < SPLIT_DATE), events):
        split_by_kind(part, path, layout=VERSIONS)
    return read_split_events(spark, path, KINDS).withColumn("kind", F.col("event_type"))


@query
def rejected_messages(spark, sf_dir):
    """A topic with broken, unknown and wrongly timed messages: every one is accepted or kept with its reason."""
    path = join(scratch_dir(spark), "topic")
    derive.faulty_messages(spark, sf_dir).write.text(path)
    out = join(scratch_dir(spark), "visits")
    split_topic(spark, TopicSpec("shop", "text", path=path), out)
    accepted = read_split_events(spark, out, KINDS).select(F.col("event_type").alias("kind"), F.lit(None).cast("string").alias("reason"))
    rejected = read_rejected(spark, out).select(F.lit(None).cast("string").alias("kind"), "reason")
    return accepted.unionByName(rejected).groupBy("kind", "reason").agg(F.count("*").alias("n"))


@query
def kind_checksums_observed(spark, sf_dir):
    """Rows and price sums per kind, taken while the split output is written."""
    checks = op.KindChecks(EVENT_KINDS)
    events = checks.watch(derive.shop_events(spark, sf_dir))
    split_by_kind(events, join(scratch_dir(spark), "visits"), layout=VERSIONS)
    return checks.result(spark)


@query
def reconcile_bad_times(spark, sf_dir):
    """The same messages sent and received, per kind."""
    sent = decode_shop_events(derive.mixed_messages(spark, sf_dir, bad_times=True))
    path = join(scratch_dir(spark), "visits")
    split_by_kind(sent, path)
    return op.reconcile(sent, read_split_events(spark, path, KINDS))


@query
def checksums_fractional(spark, sf_dir):
    """Price sums over prices with fractions, as numbers and as text."""
    return op.kind_checksums(decode_shop_events(derive.mixed_messages(spark, sf_dir)))


@query
def kind_checksums(spark, sf_dir):
    return op.kind_checksums(derive.shop_events(spark, sf_dir))


@query
def reconcile(spark, sf_dir):
    """Sent messages against the split output; other kinds show as lost."""
    events = derive.shop_events(spark, sf_dir)
    path = join(scratch_dir(spark), "visits")
    split_by_kind(events, path)
    return op.reconcile(events, read_split_events(spark, path, KINDS))


# --- KPIs -------------------------------------------------------------------


@query
def hourly_kpis(spark, sf_dir):
    return op.window_kpis(derive.shop_events(spark, sf_dir))


@query
def kpis_from_earliest(spark, sf_dir):
    return op.window_kpis(derive.shop_events(spark, sf_dir), start="earliest")


@query
def kpis_stream_from_earliest(spark, sf_dir):
    """The streaming job with windows that begin at the first event; last revision per window."""
    sink = TopicSpec("kpis", "parquet", path=join(scratch_dir(spark), "kpis"))
    checkpoint = join(scratch_dir(spark), "checkpoint")
    topic = _message_topic(spark, sf_dir)
    running = stream_kpis(spark, topic, sink, checkpoint, trigger=AVAILABLE_NOW, start="earliest")
    running.awaitTermination()
    updates = decode_payload(read_updates(spark, sink), schemas.KPI, keep=["batch_id"])
    return op.latest_kpis(updates)


@query
def kpis_compacted(spark, sf_dir):
    """The streaming job in many small batches, its revisions compacted by window start."""
    sink = TopicSpec("kpis", "parquet", path=join(scratch_dir(spark), "kpis"))
    checkpoint = join(scratch_dir(spark), "checkpoint")
    topic = _message_topic(spark, sf_dir)
    topic = replace(topic, options={"maxFilesPerTrigger": "1"})
    running = stream_kpis(spark, topic, sink, checkpoint, trigger=AVAILABLE_NOW, compact=True)
    running.awaitTermination()
    updates = decode_payload(read_compacted(spark, sink, WINDOW_KEY), schemas.KPI, keep=["revision"])
    return op.latest_kpis(updates, "revision")


@query
def half_hour_shifted_kpis(spark, sf_dir):
    """Two-hour windows aligned to half past an odd hour."""
    return op.window_kpis(derive.shop_events(spark, sf_dir), "2 hours", start=5_400_000)


@query
def kpi_messages_batch(spark, sf_dir):
    """The streaming job's transformation on a bounded topic, decoded again."""
    out = kpi_messages(derive.shop_messages(spark, sf_dir), "kpis")
    return decode_payload(out, schemas.KPI)


@query
def kpis_fractional_prices(spark, sf_dir):
    """KPIs over prices and times with fractions, as numbers and as text; some times are bad."""
    messages = derive.mixed_messages(spark, sf_dir, bad_times=True)
    return decode_payload(kpi_messages(messages, "kpis"), schemas.KPI)


@query
def kpi_messages_shifted(spark, sf_dir):
    """The job's windows aligned to half past the hour."""
    out = kpi_messages(derive.shop_messages(spark, sf_dir), "kpis", "2 hours", start=5_400_000)
    return decode_payload(out, schemas.KPI)


@query
def stopped_streams(spark, sf_dir):
    """Two streams over the messages, started and stopped; what each was reading."""
    topic = _message_topic(spark, sf_dir)
    for name in ("one", "two"):
        sink = TopicSpec(name, "parquet", path=join(scratch_dir(spark), name))
        source = read_topic_stream(spark, topic).select("value", F.lit(name).alias("topic"))
        checkpoint = join(scratch_dir(spark), "checkpoint")
        write_topic_stream(source, sink, checkpoint, "0 seconds").processAllAvailable()
    stopped = [(i, topic.path.rpartition("/")[2] in s) for i, s in enumerate(stop_streams(spark))]
    left = len(spark.streams.active)
    rows = spark.createDataFrame(stopped, "place int, of_topic boolean")
    return rows.agg(F.count_if("of_topic").alias("n_stopped"), F.lit(left).cast("bigint").alias("n_left"))


@query
def job_options(spark, sf_dir):
    """A job steered by its options: per event kind an id, read back with its type, up to which events count."""
    events = derive.table(spark, sf_dir, "events")
    # One row per kind of event.
    sizes = {r["event_type"]: r["n"] for r in events.groupBy("event_type").agg(F.count("*").alias("n")).collect()}
    for kind, n in sizes.items():
        spark.conf.set(f"spark.kinds.{kind}", str(n))
    options = job_conf(spark, "spark.kinds", {kind: (int, None) for kind in sizes} | {"missing": (int, -1)})
    for kind in sizes:
        spark.conf.unset(f"spark.kinds.{kind}")
    limits = spark.createDataFrame(list(options.items()), "event_type string, option bigint")
    steered = limits.join(events, "event_type", "left").groupBy(F.col("event_type").alias("name"), F.col("option").alias("value"))
    return steered.agg(F.count_if(F.col("event_id") < F.col("option")).alias("n_below"))


@query
def hourly_kpis_stream(spark, sf_dir):
    """The whole streaming job on files; last revision per window."""
    sink = TopicSpec("kpis", "parquet", path=join(scratch_dir(spark), "kpis"))
    checkpoint = join(scratch_dir(spark), "checkpoint")
    running = stream_kpis(
        spark, _message_topic(spark, sf_dir), sink, checkpoint, trigger=AVAILABLE_NOW
    )
    running.awaitTermination()
    updates = decode_payload(read_updates(spark, sink), schemas.KPI, keep=["batch_id"])
    return op.latest_kpis(updates)


@query
def topic_stream_rows(spark, sf_dir):
    """Unbounded read, passed through to a file topic unchanged."""
    sink = TopicSpec("copy", "parquet", path=join(scratch_dir(spark), "copy"))
    checkpoint = join(scratch_dir(spark), "checkpoint")
    source = read_topic_stream(spark, _message_topic(spark, sf_dir))
    messages = source.select("value", F.lit("copy").alias("topic"))
    write_topic_stream(messages, sink, checkpoint, AVAILABLE_NOW).awaitTermination()
    return decode_payload(read_updates(spark, sink), schemas.EVENT)


# --- mart -------------------------------------------------------------------


@query
def explode_visits(spark, sf_dir):
    return op.explode_visits(derive.user_visits(spark, sf_dir))


@query
def shop_matrix(spark, sf_dir):
    return op.shop_category_matrix(derive.shop_events(spark, sf_dir))


@query
def web_matrix(spark, sf_dir):
    return op.web_category_matrix(
        derive.user_visits(spark, sf_dir), derive.domain_categories(spark, sf_dir)
    )


@query
def web_matrix_large_categories(spark, sf_dir):
    """The same matrix by the way taken when the categories exceed a broadcast."""
    return op.web_category_matrix(
        derive.user_visits(spark, sf_dir),
        derive.domain_categories(spark, sf_dir),
        broadcast_bytes=0,
    )


def _mart(spark, sf_dir, **options):
    visits = derive.shop_events(spark, sf_dir)
    return op.profile_mart(
        derive.clients(spark, sf_dir),
        pinned_shop_matrix(visits, scratch_dir(spark)),
        web_matrix(spark, sf_dir),
        **options,
    )


@query
def profile_mart(spark, sf_dir):
    return _mart(spark, sf_dir)


@query
def profile_mart_filled(spark, sf_dir):
    return _mart(spark, sf_dir, fill=0, max_age=99)


@query
def mart_distribution(spark, sf_dir):
    return op.bucket_distribution(_mart(spark, sf_dir))


@query
def table_source(spark, sf_dir):
    """A table written and read through the connector specs."""
    path = join(scratch_dir(spark), "clients")
    write_table(derive.clients(spark, sf_dir), SinkSpec("json", path=path))
    return read_table(spark, SourceSpec("json", path=path, schema=schemas.CLIENT))


# --- users x items ----------------------------------------------------------


def _kind_items(spark, sf_dir) -> DataFrame:
    """``(date, uid, item_id)`` of views and buys, items named by kind."""
    dated = dated_events(derive.shop_events(spark, sf_dir))
    view, buy = (kind_items(dated.where(F.col("event_type") == kind), kind) for kind in KINDS)
    return view.unionByName(buy)


@query
def users_items_long(spark, sf_dir):
    return op.count_long(_kind_items(spark, sf_dir), "uid", "item_id")


@query
def users_items_wide(spark, sf_dir):
    return op.count_matrix(_kind_items(spark, sf_dir), "uid", "item_id")


def _before_and_after(spark, sf_dir) -> list[DataFrame]:
    items = _kind_items(spark, sf_dir)
    early: Column = F.col("date") < SPLIT_DATE
    return [op.count_matrix(items.where(part), "uid", "item_id") for part in (early, ~early)]


@query
def matrix_merge(spark, sf_dir):
    return op.merge_matrix(*_before_and_after(spark, sf_dir), "uid")


@query
def union_and_sum(spark, sf_dir):
    """The wide way of the merge: union by name, then sum by key."""
    return op.sum_by_key(op.union_missing(*_before_and_after(spark, sf_dir)), "uid")


@query
def union_missing(spark, sf_dir):
    """Two matrices with different columns under one another."""
    shop, web = shop_matrix(spark, sf_dir), web_matrix(spark, sf_dir)
    return op.union_missing(shop, web)


@query
def matrix_unpivot(spark, sf_dir):
    """Wide to long, the zero cells left out."""
    return op.to_long(shop_matrix(spark, sf_dir), "uid", "cat").where(F.col("n") != 0)


@query
def users_items_update(spark, sf_dir):
    """Two runs of the job, the second on top of the first; newest snapshot."""
    events = derive.shop_events(spark, sf_dir)
    scratch = scratch_dir(spark)
    early = event_date(F.col("timestamp")) < SPLIT_DATE
    for name, part in (("first", events.where(early)), ("second", events.where(~early))):
        split_by_kind(part, join(scratch, name))
        update_users_items(spark, join(scratch, name), join(scratch, "users-items"))
    snapshots = join(scratch, "users-items")
    return read_snapshot(spark, snapshots, latest_snapshot(spark, snapshots))


def _dated_parts(spark, sf_dir, cuts: list[str]) -> list[DataFrame]:
    """The shop events by date ranges between the cuts, the earliest first."""
    events = derive.shop_events(spark, sf_dir)
    date = event_date(F.col("timestamp"))
    bounds = ["00000000", *cuts, "99999999"]
    return [events.where((date >= a) & (date < b)) for a, b in zip(bounds, bounds[1:])]


def _update_all(spark, parts: list[DataFrame], **options) -> str:
    scratch = scratch_dir(spark)
    snapshots = join(scratch, "users-items")
    for i, part in enumerate(parts):
        split_by_kind(part, join(scratch, f"part-{i}"))
        update_users_items(spark, join(scratch, f"part-{i}"), snapshots, **options)
    return snapshots


@query
def users_items_partition_store(spark, sf_dir):
    """Four updates of the count store: early and newest days, the days between, the newest once more."""
    early, late, newest = _dated_parts(spark, sf_dir, [SPLIT_DATE, LATER_DATE])
    scratch = scratch_dir(spark)
    store = join(scratch, "store")
    for i, part in enumerate((early, newest, late, newest)):
        split_by_kind(part, join(scratch, f"part-{i}"), layout=VERSIONS)
        update_count_store(spark, join(scratch, f"part-{i}"), store)
    return store_matrix(spark, store)


@query
def users_items_late_batch(spark, sf_dir):
    """The middle days come last; the newest snapshot has all of them."""
    early, late, newest = _dated_parts(spark, sf_dir, [SPLIT_DATE, LATER_DATE])
    snapshots = _update_all(spark, [early, newest, late])
    return read_snapshot(spark, snapshots, latest_snapshot(spark, snapshots))


@query
def users_items_rerun(spark, sf_dir):
    """The second batch is merged twice: its days replace what they were."""
    early, late = _dated_parts(spark, sf_dir, [SPLIT_DATE])
    snapshots = _update_all(spark, [early, late, late])
    return read_snapshot(spark, snapshots, latest_snapshot(spark, snapshots))


@query
def users_items_added(spark, sf_dir):
    """The second batch is merged twice and added: its counts double."""
    early, late = _dated_parts(spark, sf_dir, [SPLIT_DATE])
    snapshots = _update_all(spark, [early, late, late], same_date="add", wide=False)
    newest = latest_snapshot(spark, snapshots)
    return read_snapshot_counts(spark, snapshots, newest, "uid", "item_id")


@query
def users_items_long_only(spark, sf_dir):
    """Two updates without the wide form, which has no limit on the items."""
    snapshots = _update_all(spark, _dated_parts(spark, sf_dir, [SPLIT_DATE]), wide=False)
    newest = latest_snapshot(spark, snapshots)
    return read_snapshot_counts(spark, snapshots, newest, "uid", "item_id")


@query
def item_maps(spark, sf_dir):
    """Counts as one map per user, given as text."""
    counts = op.count_long(_kind_items(spark, sf_dir), "uid", "item_id")
    cells = F.transform(
        F.map_entries("items"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return op.count_map(counts, "uid", "item_id").select("uid", F.array_join(cells, ",").alias("items"))


@query
def snapshot_roundtrip(spark, sf_dir):
    """Two dated snapshots, one replaced; the newest is picked and read."""
    directory = join(scratch_dir(spark), "snapshots")
    shop, web = shop_matrix(spark, sf_dir), web_matrix(spark, sf_dir)
    for matrix, date in ((web, "20240101"), (web, SPLIT_DATE), (shop, SPLIT_DATE)):
        write_snapshot(matrix, directory, date)
    return read_snapshot(spark, directory, latest_snapshot(spark, directory))


# --- features ---------------------------------------------------------------


def _visits(spark, sf_dir):
    return visit_domains(derive.user_visits(spark, sf_dir))


@query
def time_features(spark, sf_dir):
    return op.time_features(_visits(spark, sf_dir))


@query
def top_domains(spark, sf_dir):
    return op.top_items(_visits(spark, sf_dir), "domain", VECTOR_SIZE)


def _as_text(df: DataFrame) -> DataFrame:
    vector = F.array_join(F.col("domain_features").cast("array<string>"), ",")
    return df.withColumn("domain_features", vector)


@query
def top_domains_incremental(spark, sf_dir):
    """The most visited domains from dated summaries, added date range by date range, some dates twice."""
    root = join(scratch_dir(spark), "vocabulary")
    visits = pinned(_visits(spark, sf_dir), scratch_dir(spark))
    dated = visits.select(event_date(F.col("timestamp")).alias("date"), F.col("domain").alias("item"))
    for low, high in (("0", SPLIT_DATE), (SPLIT_DATE, "99999999"), (SPLIT_DATE, LATER_DATE)):
        add_dates(dated.where((F.col("date") >= low) & (F.col("date") < high)), root, VECTOR_SIZE)
    return top_items_by_date(spark, root, VECTOR_SIZE).withColumnRenamed("item", "domain")


@query
def domain_vector_sparse(spark, sf_dir):
    """The non-zero entries of the vectors, and the vectors made dense again, as text."""
    visits = pinned(_visits(spark, sf_dir), scratch_dir(spark))
    vocab = op.vocabulary(visits, "domain", VECTOR_SIZE)
    sparse = op.count_vector_sparse(visits, "uid", "domain", vocab)
    vector = F.col("domain_features")
    parts = {"indices": vector["indices"], "counts": vector["values"]}
    texts = [F.array_join(a.cast("array<string>"), ",").alias(name) for name, a in parts.items()]
    return _as_text(op.to_dense(sparse.select("uid", *texts, "domain_features")))


@query
def domain_vector(spark, sf_dir):
    """Vectors over the ten most visited domains, array joined to text."""
    visits = pinned(_visits(spark, sf_dir), scratch_dir(spark))
    vocab = op.vocabulary(visits, "domain", VECTOR_SIZE)
    return _as_text(op.count_vector(visits, "uid", "domain", vocab))


@query
def domain_vector_large_vocabulary(spark, sf_dir):
    """The same vectors by the way taken when the vocabulary exceeds a broadcast."""
    visits = pinned(_visits(spark, sf_dir), scratch_dir(spark))
    vocab = op.vocabulary(visits, "domain", VECTOR_SIZE)
    return _as_text(op.count_vector(visits, "uid", "domain", vocab, broadcast_bytes=0))


@query
def feature_matrix(spark, sf_dir):
    """The whole feature table: matrix, vectors and time features."""
    visits = pinned_visits(
        derive.user_visits(spark, sf_dir), join(scratch_dir(spark), "visit-domains")
    )
    return _as_text(feature_table(users_items_wide(spark, sf_dir), visits, VECTOR_SIZE))


@query
def feature_matrix_bucketed(spark, sf_dir):
    """The feature table from three tables bucketed by user: none of them is shuffled again."""
    scratch = scratch_dir(spark)
    visits = pinned_visits(derive.user_visits(spark, sf_dir), join(scratch, "visit-domains"))
    counts = op.count_long(_kind_items(spark, sf_dir), "uid", "item_id")
    write_feature_tables(counts, visits, join(scratch, "tables"), VECTOR_SIZE, buckets=8)
    return _as_text(read_feature_tables(spark, join(scratch, "tables")))
