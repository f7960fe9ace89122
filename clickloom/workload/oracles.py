"""The registered queries in plain SQL, for a second engine to check.

The inputs are stated once as common table expressions; they mirror
``derive``.
"""

from __future__ import annotations

import textwrap

from ..functions.clock import WEEKDAYS

WEBLOG = """
weblog AS (
  SELECT e.event_id, e.event_type, e.user_id AS uid, epoch_us(e.ts) // 1000 AS timestamp, p.url,
         regexp_replace(regexp_extract(p.url, '^https?://([^/?#:]+)', 1), '^www\\.', '') AS domain
  FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
)"""

VISITS = (
    WEBLOG
    + """,
visits AS (
  SELECT CASE WHEN event_id % 19 <> 0 THEN CAST(uid AS VARCHAR) END AS uid, timestamp, url, domain
  FROM weblog JOIN (VALUES (1), (2)) AS r(copy) ON copy = 1 OR event_type = 'signup'
)"""
)

SHOP = """
shop AS (
  SELECT 'Everyday Goods-' || (k % 8) AS category,
         CASE event_type WHEN 'purchase' THEN 'buy' ELSE event_type END AS event_type,
         'Big K-' || k AS item_id,
         CAST(round(value * 100) AS BIGINT) AS item_price,
         epoch_us(ts) // 1000 AS timestamp,
         CASE WHEN event_id % 17 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
         strftime(ts, '%Y%m%d') AS date,
         k
  FROM (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k FROM events)
)"""

MIXED = """
mixed AS (
  SELECT CASE event_type WHEN 'purchase' THEN 'buy' ELSE event_type END AS event_type,
         CAST(value AS DECIMAL(20,2)) AS price,
         event_id % 10 = 3 AS bad,
         epoch_us(ts) // 1000 AS timestamp,
         CASE WHEN event_id % 17 <> 0 THEN CAST(user_id AS VARCHAR) END AS uid,
         strftime(ts, '%Y%m%d') AS date
  FROM events
)"""

CLIENTS = """
clients AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(c_custkey % 90 + 15 AS INTEGER) AS age
  FROM customer
)"""

CATEGORIES = """
categories AS (
  SELECT DISTINCT h AS domain, 'News-' || regexp_extract(h, '([^.]+)$', 1) || ' Sites' AS category
  FROM (SELECT regexp_replace(regexp_extract(url, '^https?://([^/?#:]+)', 1), '^www\\.', '') AS h
        FROM pages)
)"""

AGE_CAT = """CASE WHEN age < 18 THEN NULL WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34'
  WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' ELSE '>=55' END"""

# Domain of the derived data: the number k of an item runs from 0 to 99, the
# shop category is k % 8, and hosts end in one of three labels.
SHOP_CATEGORIES = [f"shop_everyday_goods_{i}" for i in range(8)]
WEB_CATEGORIES = [f"web_news_{tld}_sites" for tld in ("com", "net", "org")]
ITEMS = [f"{kind}_big_k_{k}" for kind in ("buy", "view") for k in range(100)]


def with_(ctes: str | list[str], body: str) -> str:
    parts = [ctes] if isinstance(ctes, str) else ctes
    return "WITH " + ",".join(parts) + textwrap.dedent(body)


def counts(column: str, names: list[str]) -> str:
    return ", ".join(
        f"CAST(count(*) FILTER ({column} = '{name}') AS BIGINT) AS {name}" for name in names
    )


def affinity(source: str, item: str, ctes: list[str], columns: str = "r AS relevance") -> str:
    return with_(
        [
            *ctes,
            f"""
member AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE'),
cnt AS (
  SELECT {item} AS item, count(*) AS d, count(m.c_custkey) AS a
  FROM {source} AS s LEFT JOIN member AS m ON m.c_custkey = s.uid
  GROUP BY 1
),
ranked AS (
  SELECT item, CAST(a AS DOUBLE) * a
    / (CAST(d AS DOUBLE) * nullif((SELECT CAST(sum(a) AS DOUBLE) FROM cnt), 0)) AS r
  FROM cnt
)""",
        ],
        f"""
        SELECT item AS {item}, {columns}
        FROM ranked ORDER BY r DESC, item LIMIT 200""",
    )


BRANDS = """
lines AS (
  SELECT o_custkey AS uid, p_brand AS brand
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""
PARTS = """
lines AS (
  SELECT o_custkey AS uid, l_partkey AS part FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

KPI_MEASURES = """
  CAST(sum(CASE WHEN event_type = 'buy' THEN item_price ELSE 0 END) AS BIGINT) AS revenue,
  CAST(count(uid) AS BIGINT) AS visitors,
  CAST(count(*) FILTER (event_type = 'buy') AS BIGINT) AS purchases"""


def kpis(begin_ms: str, length_ms: int) -> str:
    return with_(
        SHOP,
        f"""
        SELECT CAST(b // 1000 AS BIGINT) AS start_ts,
               CAST((b + {length_ms}) // 1000 AS BIGINT) AS end_ts,
               revenue, visitors, purchases,
               CASE WHEN purchases > 0 THEN CAST(revenue AS DOUBLE) / purchases END AS aov
        FROM (SELECT {begin_ms} AS b, {KPI_MEASURES} FROM shop GROUP BY 1)""",
    )


HOURLY = kpis("timestamp - timestamp % 3600000", 3_600_000)

SHOP_EVENT = "category, event_type, item_id, item_price, timestamp, uid"
ITEM_NAME = "event_type || '_big_k_' || k"
SHOP_CAT = "'shop_everyday_goods_' || (k % 8)"
WEB_CAT = "lower(regexp_replace('web_' || category, '[\\s-]', '_', 'g'))"

SHOP_MATRIX = (
    f"SELECT uid, {counts(SHOP_CAT, SHOP_CATEGORIES)} FROM shop WHERE uid IS NOT NULL GROUP BY uid"
)
WEB_MATRIX = (
    f"SELECT uid, {counts(WEB_CAT, WEB_CATEGORIES)}"
    " FROM visits JOIN categories USING (domain) WHERE uid IS NOT NULL GROUP BY uid"
)
ITEM_MATRIX = (
    f"SELECT uid, {counts(ITEM_NAME, ITEMS)} FROM shop"
    " WHERE uid IS NOT NULL AND event_type IN ('view', 'buy') GROUP BY uid"
)
MATRICES = [VISITS, SHOP, CATEGORIES]

HOUR = "hour(make_timestamp(timestamp * 1000))"
WEEKDAY = "(isodow(make_timestamp(timestamp * 1000)) % 7)"

TIME_CONDITIONS = {f"web_day_{name}": f"{WEEKDAY} = {i}" for i, name in enumerate(WEEKDAYS)} | {
    f"web_hour_{h}": f"{HOUR} = {h}" for h in range(24)
}
FLAG_CONDITIONS = TIME_CONDITIONS | {
    "web_work_hours": f"{HOUR} BETWEEN 9 AND 17",
    "web_evening_hours": f"{HOUR} >= 18",
    "all_visits": "TRUE",
}
TIME_FEATURES = (
    "SELECT uid, "
    + ", ".join(
        f"CAST(count(*) FILTER ({c}) AS BIGINT) AS {name}" for name, c in TIME_CONDITIONS.items()
    )
    + f", CAST(count(*) FILTER ({HOUR} BETWEEN 9 AND 17) AS DOUBLE) / count(*)"
    " AS web_fraction_work_hours"
    + f", CAST(count(*) FILTER ({HOUR} >= 18) AS DOUBLE) / count(*) AS web_fraction_evening_hours"
    " FROM visits WHERE uid IS NOT NULL GROUP BY uid"
)

VOCAB = """
vocab AS (
  SELECT domain, n, CAST(row_number() OVER (ORDER BY domain) - 1 AS INTEGER) AS idx
  FROM (SELECT domain, CAST(count(*) AS BIGINT) AS n FROM visits
        GROUP BY domain ORDER BY n DESC, domain LIMIT 10)
)"""
VECTORS = """
  SELECT u.uid, string_agg(CAST(coalesce(c.n, 0) AS VARCHAR), ',' ORDER BY v.idx) AS domain_features
  FROM (SELECT DISTINCT uid FROM visits WHERE uid IS NOT NULL) AS u
  CROSS JOIN vocab AS v
  LEFT JOIN (SELECT uid, domain, count(*) AS n FROM visits GROUP BY uid, domain) AS c
    ON c.uid = u.uid AND c.domain = v.domain
  GROUP BY u.uid"""

MART = f"""
SELECT c.uid, gender, {AGE_CAT} AS age_cat, s.* EXCLUDE (uid), w.* EXCLUDE (uid)
FROM clients AS c
LEFT JOIN ({SHOP_MATRIX}) AS s ON s.uid = c.uid
LEFT JOIN ({WEB_MATRIX}) AS w ON w.uid = c.uid"""


def _filled() -> str:
    cells = ", ".join(f"coalesce({c}, 0) AS {c}" for c in SHOP_CATEGORIES + WEB_CATEGORIES)
    young = f"CASE WHEN age > 99 THEN NULL ELSE {AGE_CAT} END"
    return f"""
SELECT c.uid, gender, {young} AS age_cat, {cells}
FROM clients AS c
LEFT JOIN ({SHOP_MATRIX}) AS s ON s.uid = c.uid
LEFT JOIN ({WEB_MATRIX}) AS w ON w.uid = c.uid"""


def _union() -> str:
    no_web = ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in WEB_CATEGORIES)
    no_shop = ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in SHOP_CATEGORIES)
    return f"""
SELECT *, {no_web} FROM ({SHOP_MATRIX})
UNION ALL BY NAME
SELECT *, {no_shop} FROM ({WEB_MATRIX})"""


FEATURES = f"""
        SELECT m.*, v.domain_features, t.* EXCLUDE (uid)
        FROM ({ITEM_MATRIX}) AS m
        JOIN ({VECTORS}) AS v ON v.uid = m.uid
        JOIN ({TIME_FEATURES}) AS t ON t.uid = m.uid"""
AFFINITY_BRANDS = affinity("lines", "brand", [BRANDS])
EVENT_SELECT = with_(SHOP, f" SELECT {SHOP_EVENT} FROM shop")

ORACLES: dict[str, str] = {
    "affinity_topk": AFFINITY_BRANDS,
    "affinity_large_segment": AFFINITY_BRANDS,
    "affinity_parts": affinity(
        "lines", "part", [PARTS], "CAST(round(r * 1e15) AS BIGINT) AS relevance_e15"
    ),
    "affinity_domains": affinity("weblog", "domain", [WEBLOG]),
    "valid_log_rows": with_(
        WEBLOG, " SELECT uid, timestamp / 1000 AS ts, url, domain FROM weblog"
    ),
    "ranked_tsv": affinity(
        "lines", "brand", [BRANDS], "r AS relevance, CAST(20 AS BIGINT) AS digits"
    ),
    "weblog_tsv": with_(WEBLOG, " SELECT uid, timestamp / 1000 AS ts, url FROM weblog"),
    "segment_ids": "SELECT c_custkey AS uid FROM customer WHERE c_mktsegment = 'AUTOMOBILE'",
    "domain_counts": with_(
        WEBLOG, " SELECT domain, CAST(count(*) AS BIGINT) AS n FROM weblog GROUP BY domain"
    ),
    "domain_variants": with_(
        WEBLOG,
        """
        SELECT event_id, domain AS strict, domain AS lenient, domain AS encoded_lower,
               'my.x.' || domain AS anywhere, 'my.www.x.' || domain AS unstripped,
               url || '/a%zz+bA' AS unescaped
        FROM weblog""",
    ),
    "age_buckets": with_(
        CLIENTS,
        f"""
        SELECT uid, age, {AGE_CAT} AS age_cat,
               CASE WHEN age > 99 THEN NULL ELSE {AGE_CAT} END AS age_cat_99
        FROM clients""",
    ),
    "bucket_distribution": with_(
        CLIENTS,
        f"""
        SELECT gender, {AGE_CAT} AS age_cat, CAST(count(*) AS BIGINT) AS n_users
        FROM clients GROUP BY 1, 2""",
    ),
    "label_names": """
        SELECT p_partkey, lower(regexp_replace(
          'view_' || concat_ws('-', p_type, p_name, p_brand), '[\\s-]', '_', 'g')) AS name
        FROM part""",
    "event_dates": with_(
        SHOP, " SELECT date, CAST(count(*) AS BIGINT) AS n FROM shop GROUP BY date"
    ),
    "max_event_date": with_(SHOP, " SELECT max(date) AS newest FROM shop"),
    "visit_flags": with_(
        WEBLOG,
        " SELECT event_id, "
        + ", ".join(
            f"CAST(CASE WHEN {c} THEN 1 ELSE 0 END AS BIGINT) AS {name}"
            for name, c in FLAG_CONDITIONS.items()
        )
        + " FROM weblog",
    ),
    "decode_events": EVENT_SELECT,
    "topic_stream_rows": EVENT_SELECT,
    "decode_events_job": with_(
        MIXED,
        """
        SELECT event_type, CAST(price AS DOUBLE) AS item_price, timestamp, uid FROM mixed""",
    ),
    "events_one_date": with_(
        SHOP,
        f"""
        SELECT date, uid, {ITEM_NAME} AS item_id
        FROM shop WHERE event_type IN ('view', 'buy') AND date = '20240120'""",
    ),
    "split_with_bad_times": with_(
        MIXED,
        """
        SELECT event_type, CASE WHEN NOT bad THEN date END AS date, CAST(count(*) AS BIGINT) AS n
        FROM mixed WHERE event_type IN ('view', 'buy') GROUP BY 1, 2""",
    ),
    "reconcile_bad_times": with_(
        MIXED,
        """
        SELECT event_type, n AS n_sent,
               CASE WHEN event_type IN ('view', 'buy') THEN n ELSE 0 END AS n_received,
               event_type IN ('view', 'buy') AS agree
        FROM (SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM mixed GROUP BY event_type)""",
    ),
    "checksums_fractional": with_(
        MIXED,
        """
        SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows,
               CAST(trunc(sum(price)) AS BIGINT) AS price_checksum
        FROM mixed GROUP BY event_type""",
    ),
    "kpis_fractional_prices": with_(
        MIXED,
        """
        SELECT CAST(b // 1000 AS BIGINT) AS start_ts, CAST(b // 1000 + 3600 AS BIGINT) AS end_ts,
               revenue, visitors, purchases,
               CASE WHEN purchases > 0 THEN CAST(revenue AS DOUBLE) / purchases END AS aov
        FROM (SELECT timestamp - timestamp % 3600000 AS b,
                     CAST(trunc(sum(CASE WHEN event_type = 'buy' THEN price ELSE 0 END)) AS BIGINT)
                       AS revenue,
                     CAST(count(uid) AS BIGINT) AS visitors,
                     CAST(count(*) FILTER (event_type = 'buy') AS BIGINT) AS purchases
              FROM mixed WHERE NOT bad GROUP BY 1)""",
    ),
    "kpi_messages_shifted": kpis("timestamp - (timestamp - 5400000) % 7200000", 7_200_000),
    "stopped_streams": "SELECT CAST(2 AS BIGINT) AS n_stopped, CAST(0 AS BIGINT) AS n_left",
    "job_options": """
        SELECT event_type AS name, n AS value, CAST(count(*) FILTER (event_id < n) AS BIGINT) AS n_below
        FROM events JOIN (SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1) USING (event_type)
        GROUP BY 1, 2
        UNION ALL SELECT 'missing', -1, 0""",
    "domain_hosts": with_(
        WEBLOG,
        """
        SELECT event_id, lower(domain) AS port_strict, lower(domain) AS port_lenient,
               '[2001:db8::' || (event_id % 10) || ']' AS address_strict,
               '[2001:db8::' || (event_id % 10) || ']' AS address_lenient,
               CAST(NULL AS VARCHAR) AS underscore_strict, 'a_b.' || domain AS underscore_lenient
        FROM weblog""",
    ),
    "users_items_late_batch": with_(SHOP, " " + ITEM_MATRIX),
    "users_items_rerun": with_(SHOP, " " + ITEM_MATRIX),
    "users_items_added": with_(
        SHOP,
        f"""
        SELECT uid, {ITEM_NAME} AS item_id,
               CAST(sum(CASE WHEN date >= '20240120' THEN 2 ELSE 1 END) AS BIGINT) AS n
        FROM shop WHERE uid IS NOT NULL AND event_type IN ('view', 'buy') GROUP BY 1, 2""",
    ),
    "users_items_long_only": with_(
        SHOP,
        f"""
        SELECT uid, {ITEM_NAME} AS item_id, CAST(count(*) AS BIGINT) AS n
        FROM shop WHERE uid IS NOT NULL AND event_type IN ('view', 'buy') GROUP BY 1, 2""",
    ),
    "item_maps": with_(
        SHOP,
        f"""
        SELECT uid, string_agg(item || '=' || n, ',' ORDER BY item) AS items
        FROM (SELECT uid, {ITEM_NAME} AS item, count(*) AS n
              FROM shop WHERE uid IS NOT NULL AND event_type IN ('view', 'buy') GROUP BY 1, 2)
        GROUP BY uid""",
    ),
    "encode_events": with_(
        SHOP,
        """
        SELECT '{"event_type":"' || event_type || '","item_id":"' || item_id
               || '","item_price":' || item_price
               || CASE WHEN uid IS NULL THEN '' ELSE ',"uid":"' || uid || '"' END
               || '}' AS value, 'shop' AS topic
        FROM shop""",
    ),
    "topic_batch": """
        SELECT CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS offset,
               event_id, event_type, user_id
        FROM events WHERE event_id % 3 <> 0 OR event_id // 3 >= 100""",
    "split_events_rows": with_(
        SHOP,
        """
        SELECT category, event_type, item_id, CAST(item_price AS VARCHAR) AS item_price,
               timestamp, uid, date, date AS p_date, event_type AS kind
        FROM shop WHERE event_type IN ('view', 'buy')""",
    ),
    "events_dir": with_(
        SHOP,
        f"""
        SELECT date, uid, {ITEM_NAME} AS item_id
        FROM shop WHERE event_type IN ('view', 'buy')""",
    ),
    "kind_checksums": with_(
        SHOP,
        """
        SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows,
               CAST(sum(item_price) AS BIGINT) AS price_checksum
        FROM shop GROUP BY event_type""",
    ),
    "reconcile": with_(
        SHOP,
        """
        SELECT event_type, n AS n_sent,
               CASE WHEN event_type IN ('view', 'buy') THEN n ELSE 0 END AS n_received,
               event_type IN ('view', 'buy') AS agree
        FROM (SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM shop GROUP BY event_type)""",
    ),
    "split_versions": with_(
        SHOP,
        """
        SELECT category, event_type, item_id, CAST(item_price AS VARCHAR) AS item_price,
               timestamp, uid, date, date AS p_date, event_type AS kind
        FROM shop WHERE event_type IN ('view', 'buy')""",
    ),
    "rejected_messages": """
        SELECT kind, reason, CAST(count(*) AS BIGINT) AS n
        FROM (SELECT CASE WHEN reason IS NULL THEN kind END AS kind, reason
              FROM (SELECT CASE event_type WHEN 'purchase' THEN 'buy' ELSE event_type END AS kind,
                           CASE WHEN event_id % 7 = 5 THEN 'broken JSON'
                                WHEN event_type NOT IN ('view', 'purchase') THEN 'unknown kind'
                                WHEN event_id % 10 = 3 THEN 'bad time' END AS reason
                    FROM events))
        GROUP BY 1, 2""",
    "kind_checksums_observed": with_(
        SHOP,
        """
        SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows,
               CAST(sum(item_price) AS BIGINT) AS price_checksum
        FROM shop GROUP BY event_type""",
    ),
    "kpis_stream_from_earliest": kpis(
        "(timestamp - (timestamp - (SELECT min(timestamp) FROM shop)) % 3600000)", 3_600_000
    ),
    "kpis_compacted": HOURLY,
    "users_items_partition_store": with_(SHOP, " " + ITEM_MATRIX),
    "top_domains_incremental": with_([VISITS, VOCAB], " SELECT idx, domain, n FROM vocab"),
    "domain_vector_sparse": with_(
        [VISITS, VOCAB],
        f"""
        SELECT d.uid, d.domain_features, coalesce(s.indices, '') AS indices, coalesce(s.counts, '') AS counts
        FROM ({VECTORS}) AS d LEFT JOIN (
          SELECT uid, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices,
                 string_agg(CAST(c AS VARCHAR), ',' ORDER BY idx) AS counts
          FROM (SELECT uid, idx, count(*) AS c FROM visits JOIN vocab USING (domain) GROUP BY uid, idx)
          GROUP BY uid) AS s USING (uid)""",
    ),
    "feature_matrix_bucketed": with_([VISITS, SHOP, VOCAB], FEATURES),
    "hourly_kpis": HOURLY,
    "kpi_messages_batch": HOURLY,
    "hourly_kpis_stream": HOURLY,
    "kpis_from_earliest": kpis(
        "(timestamp - (timestamp - (SELECT min(timestamp) FROM shop)) % 3600000)", 3_600_000
    ),
    "half_hour_shifted_kpis": kpis("timestamp - (timestamp - 5400000) % 7200000", 7_200_000),
    "explode_visits": with_(VISITS, " SELECT uid, timestamp, url FROM visits"),
    "shop_matrix": with_(SHOP, " " + SHOP_MATRIX),
    "web_matrix": with_([VISITS, CATEGORIES], " " + WEB_MATRIX),
    "web_matrix_large_categories": with_([VISITS, CATEGORIES], " " + WEB_MATRIX),
    "profile_mart": with_([*MATRICES, CLIENTS], MART),
    "profile_mart_filled": with_([*MATRICES, CLIENTS], _filled()),
    "mart_distribution": with_(
        [*MATRICES, CLIENTS],
        f"""
        SELECT gender, age_cat, CAST(count(*) AS BIGINT) AS n_users FROM ({MART}) GROUP BY 1, 2""",
    ),
    "table_source": with_(CLIENTS, " SELECT uid, gender, age FROM clients"),
    "users_items_long": with_(
        SHOP,
        f"""
        SELECT uid, {ITEM_NAME} AS item_id, CAST(count(*) AS BIGINT) AS n
        FROM shop WHERE uid IS NOT NULL AND event_type IN ('view', 'buy') GROUP BY 1, 2""",
    ),
    "users_items_wide": with_(SHOP, " " + ITEM_MATRIX),
    "matrix_merge": with_(SHOP, " " + ITEM_MATRIX),
    "union_and_sum": with_(SHOP, " " + ITEM_MATRIX),
    "users_items_update": with_(SHOP, " " + ITEM_MATRIX),
    "union_missing": with_(MATRICES, _union()),
    "matrix_unpivot": with_(
        SHOP,
        f"""
        SELECT uid, {SHOP_CAT} AS cat, CAST(count(*) AS BIGINT) AS n
        FROM shop WHERE uid IS NOT NULL GROUP BY 1, 2""",
    ),
    "snapshot_roundtrip": with_(SHOP, " " + SHOP_MATRIX),
    "time_features": with_(VISITS, " " + TIME_FEATURES),
    "top_domains": with_([VISITS, VOCAB], " SELECT idx, domain, n FROM vocab"),
    "domain_vector": with_([VISITS, VOCAB], VECTORS),
    "domain_vector_large_vocabulary": with_([VISITS, VOCAB], VECTORS),
    "feature_matrix": with_([VISITS, SHOP, VOCAB], FEATURES),
}
