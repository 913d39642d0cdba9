"""For each query the same result as one DuckDB SQL text on the test tables."""

from __future__ import annotations

from brookmart.functions import people
from brookmart.operators.reports import TOTALS
from brookmart.operators.routing import DIMENSION_TABLES, EVENT_TOPIC, FACT_TABLES, START_TOPIC
from brookmart.plans.replay import CHUNKS
from brookmart.sinks.postings import B, K, PLACES
from brookmart.sources import changes, shop

DAY = f"DATE '{shop.DAY}'"

LOGS = """logs AS (
  SELECT event_id AS "offset", 'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid,
         epoch_us(ts) // 1000 AS ts, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr,
         event_type IN ('view', 'click') AS is_start
  FROM events)"""

SEEN = LOGS + """, seen AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, "offset") AS rn
    FROM logs WHERE is_start) WHERE rn = 1)"""

ORDERS = f"""o AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS status,
         CAST(round(o_totalprice * 100) AS BIGINT) AS paid,
         o_orderdate + INTERVAL {shop.SHIFT_DAYS} DAY + to_seconds(o_orderkey * 37 % 86400) AS ts
  FROM orders)"""

DETAILS = f"""d AS (
  SELECT (n - 1) * {shop.DETAIL_STEP} + l_orderkey AS id, l_orderkey AS order_id, n AS line,
         l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS num,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS amt
  FROM (SELECT *, row_number() OVER (
          PARTITION BY l_orderkey ORDER BY {', '.join(shop.LINE_ORDER)}) AS n FROM lineitem))"""

# final_cents of every line
PAID = ORDERS + ", " + DETAILS + """, w AS (
  SELECT o.id AS order_id, d.id AS detail_id, o.user_id, d.sku_id, d.num, d.amt, d.line, o.paid,
         o.status, o.ts, strftime(o.ts, '%Y-%m-%d') AS dt,
         CAST(sum(d.amt) OVER (PARTITION BY o.id) AS BIGINT) AS orig
  FROM o JOIN d ON d.order_id = o.id), s AS (
  SELECT *, (2 * paid * amt + orig) // (2 * orig) AS share,
         CAST(sum(amt) OVER (PARTITION BY order_id ORDER BY detail_id) AS BIGINT) AS cum
  FROM w), paid AS (
  SELECT *, CAST(CASE WHEN cum = orig AND cum - amt <> orig
         THEN paid - coalesce(sum(share) OVER (PARTITION BY order_id ORDER BY detail_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         ELSE share END AS BIGINT) AS final_cents
  FROM s)"""

USERS = f"""u AS (
  SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level, c_nationkey,
         strftime(DATE '1960-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CASE WHEN c_custkey % 2 = 0 THEN '{people.MALE}' ELSE '{people.FEMALE}' END AS gender_name,
         date_diff('day', DATE '1960-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER),
                   DATE '{shop.AS_OF}') // 365 AS age
  FROM customer), users AS (
  SELECT *, CASE WHEN age < 20 THEN '{people.AGE_UP_TO_20}' WHEN age > 30 THEN '{people.AGE_OVER_30}'
         ELSE '{people.AGE_21_TO_30}' END AS age_group FROM u)"""


def _text_id(column: str) -> str:
    return f"CAST('0x' || substr(md5({column}), 1, 13) AS BIGINT)"


# paid lines with names of product, province and user
WIDE = PAID + ", " + USERS + f""", wide AS (
  SELECT paid.*, p_name AS sku_name, {_text_id('p_brand')} AS tm_id, p_brand AS tm_name,
         p_type AS category3_name, p_name AS spu_name, n_name AS province_name,
         users.age_group, users.gender_name
  FROM paid LEFT JOIN part ON p_partkey = sku_id
  LEFT JOIN users ON users.c_custkey = user_id LEFT JOIN nation ON n_nationkey = users.c_nationkey)"""

CHUNKED_ORDERS = ORDERS + f""", c AS (
  SELECT o.*, c_nationkey, n_name, (epoch(o.ts)::BIGINT - lo) * {CHUNKS} // (hi - lo + 1) AS chunk
  FROM o LEFT JOIN customer ON c_custkey = user_id LEFT JOIN nation ON n_nationkey = c_nationkey,
       (SELECT min(epoch(ts)::BIGINT) AS lo, max(epoch(ts)::BIGINT) AS hi FROM o) AS span)"""

FIRSTS = """f AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id
              ORDER BY strftime(ts, '%Y-%m-%d %H:%M:%S'), id) = 1 THEN '1' ELSE '0' END AS mark FROM o)"""


def _amount(cents: str = "final_cents") -> str:
    return f"CAST(sum({cents}) AS DOUBLE) / 100"


_kinds = "CASE id % 4 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(changes.KINDS)) + " END"
CHANGES = "ch AS (SELECT *, " + _kinds + f" AS kind, id % {changes.EMPTY_EVERY} = 0 AS empty FROM (" + \
    " UNION ALL ".join(f"SELECT '{name}' AS tbl, CAST({key} AS BIGINT) AS id FROM {source}"
                       for name, source, key, _ in changes.TABLES) + "))"


def _in(names: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _compare(hours: str, value: str) -> str:
    def side(day: str) -> str:
        return f"coalesce((SELECT {value} FROM {hours} h WHERE h.dt = strftime({day}, '%Y-%m-%d') AND h.hr = spine.hr), 0)"
    return (f"SELECT spine.hr, {side(DAY)} AS today, {side(DAY + ' - 1')} AS yesterday "
            "FROM (SELECT lpad(CAST(range AS VARCHAR), 2, '0') AS hr FROM range(24)) spine")


SEEN_HOURS = SEEN + ", hours AS (SELECT dt, hr, count(*) AS n FROM seen GROUP BY ALL)"
AMOUNT_HOURS = PAID + f", hours AS (SELECT dt, strftime(ts, '%H') AS hr, {_amount()} AS amount FROM paid GROUP BY ALL)"
NEW = "new AS (SELECT dt, count(*) AS n FROM (SELECT mid, min(dt) AS dt FROM logs WHERE is_start GROUP BY mid) GROUP BY dt)"


DEVICES = """SELECT dt, d.n, coalesce(new.n, 0) AS n_new
  FROM (SELECT dt, count(DISTINCT mid) AS n FROM logs WHERE is_start GROUP BY dt) d LEFT JOIN new USING (dt)"""


def _top(after: str, before: str) -> str:
    return WIDE + f""", top AS (
  SELECT CAST(tm_id AS VARCHAR) AS trademark_id, tm_name AS trademark_name, {_amount()} AS amount
  FROM wide WHERE dt > '{after}' AND dt < '{before}' GROUP BY ALL
  ORDER BY sum(final_cents) DESC, trademark_id LIMIT 5)"""


TOP = _top("2018-01-01", "2024-01-01")
PAIRS = ORDERS + ", " + DETAILS + \
    " SELECT d.order_id, d.id AS detail_id FROM o JOIN d ON d.order_id = o.id WHERE d.id % 90 <= 50"
RINGS = (WIDE + """, hit AS (
  SELECT * FROM wide WHERE list_contains(regexp_split_to_array(lower(sku_name), '[^\\p{L}\\p{N}]+'), 'ring'))""")


def _share(column: str) -> str:
    return (f"WITH {WIDE}, g AS (SELECT {column} AS grp, count(*) AS n FROM wide GROUP BY 1) "
            "SELECT grp, n, CAST(n AS DOUBLE) * 100 / CAST((SELECT sum(n) FROM g) AS DOUBLE) AS pct FROM g")


def _total(which: int, value: str) -> str:
    key, name = TOTALS[which]
    return f"SELECT '{key}' AS id, '{name}' AS name, CAST(coalesce(({value}), 0) AS DOUBLE) AS value"


_day = f"dt = '{shop.DAY}'"

ORACLE: dict[str, str] = {
    # sources
    "dim_scan": f"WITH {USERS} SELECT id, user_level, birthday, gender FROM users",
    "key_list_lookup": "SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level FROM customer "
                       "WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "doc_get": "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id = 7",
    "doc_search": """
        SELECT doc_id, count(*) AS score
        FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word
              FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))
        WHERE word = 'the' GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10""",
    "doc_search_ranked": f"""
        WITH w AS (
          SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM documents),
        n AS (SELECT doc_id, term, count(*) AS n FROM w WHERE term <> '' GROUP BY ALL),
        l AS (SELECT doc_id, sum(n) AS len FROM n GROUP BY doc_id),
        a AS (SELECT count(*) AS docs, (SELECT sum(len) FROM l) / count(*) AS mean FROM documents),
        f AS (SELECT *, count(*) OVER (PARTITION BY term) AS df FROM n WHERE term IN ('the', 'query'))
        SELECT doc_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * n * ({K} + 1)
                 / (n + {K} * (1 - {B} + {B} * len / mean))), {PLACES}) AS score
        FROM f JOIN l USING (doc_id) CROSS JOIN a GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10""",
    # messages
    "cdc_apply_ordered": """
        SELECT CAST(c_custkey AS VARCHAR) AS id,
               CASE WHEN c_custkey % 9 = 0 THEN '4' WHEN c_custkey % 5 <> 0 THEN '2' ELSE '1' END AS user_level
        FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 9 = 0""",
    "route_logs": f"WITH {LOGS} SELECT CASE WHEN is_start THEN '{START_TOPIC}' ELSE '{EVENT_TOPIC}' END AS topic, "
                  "count(*) AS n FROM logs GROUP BY 1",
    "cdc_route_canal": f"WITH {CHANGES} SELECT 'ods_' || tbl AS topic, CAST(2 * count(*) AS BIGINT) AS n, "
                       "CAST(2 * sum(id) AS BIGINT) AS id_sum FROM ch WHERE kind = 'insert' AND NOT empty GROUP BY 1",
    "cdc_route_maxwell": f"WITH {CHANGES} SELECT 'ods_' || tbl AS topic, count(*) AS n, "
                         "CAST(sum(id) AS BIGINT) AS id_sum FROM ch WHERE NOT empty AND "
                         f"(tbl IN {_in(FACT_TABLES)} AND kind = 'insert' OR tbl IN {_in(DIMENSION_TABLES)}) GROUP BY 1",
    "json_parse_dynamic": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "json_parse_typed": "SELECT o_orderkey AS id, o_custkey AS user_id, o_totalprice AS amount, "
                        "CAST(0 AS DOUBLE) AS feight_fee FROM orders",
    "log_time_parts": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr FROM events",
    "order_time_parts": f"WITH {ORDERS} SELECT id, strftime(ts, '%Y-%m-%d') AS create_date, "
                        "strftime(ts, '%H') AS create_hour FROM o",
    # devices
    "dau_flatten": f"WITH {LOGS} SELECT mid, uid, dt, hr, '00' AS mi, ts FROM logs WHERE is_start",
    "dau_first_seen": f'WITH {SEEN} SELECT dt, mid, "offset" AS event_id FROM seen',
    "dau_total": f"WITH {LOGS} SELECT dt, count(DISTINCT mid) AS n FROM logs WHERE is_start GROUP BY dt",
    "dau_hour": f"WITH {SEEN_HOURS} SELECT dt, hr, n FROM hours",
    "dau_total_day": f"WITH {LOGS} SELECT dt, count(DISTINCT mid) AS n FROM logs WHERE is_start AND {_day} GROUP BY dt",
    "dau_hour_day": f"WITH {SEEN_HOURS} SELECT dt, hr, n FROM hours WHERE {_day} ORDER BY n DESC, hr LIMIT 24",
    "hour_compare_dau": f"WITH {SEEN_HOURS} {_compare('hours', 'n')}",
    "new_devices": f"WITH {LOGS}, {NEW} SELECT dt, n FROM new",
    "bitmap_devices": f"WITH {LOGS}, {NEW} {DEVICES}",
    "bitmap_devices_day": f"WITH {LOGS}, {NEW} {DEVICES} WHERE {_day}",
    # dimensions and lookups
    "user_profile": f"WITH {USERS} SELECT id, age_group, gender_name FROM users",
    "sku_denormalize": "SELECT CAST(p_partkey AS VARCHAR) AS sku_id, p_brand AS tm_name, "
                       "p_type AS category3_name, p_name AS spu_name FROM part",
    "join_province_broadcast": "SELECT o_orderkey AS id, n_name AS province_name, "
                               "CAST(n_nationkey AS VARCHAR) AS province_area_code FROM orders "
                               "LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey",
    "join_user": f"WITH {USERS} SELECT o_orderkey AS id, age_group AS user_age_group, gender_name AS user_gender "
                 "FROM orders LEFT JOIN users ON c_custkey = o_custkey",
    "join_sku": f"WITH {DETAILS} SELECT d.id AS detail_id, sku_id, {_text_id('p_brand')} AS tm_id, p_brand AS tm_name, "
                "p_type AS category3_name, p_name AS spu_name FROM d LEFT JOIN part ON p_partkey = sku_id",
    "first_order_mark": f"WITH {ORDERS}, {FIRSTS} SELECT id, user_id, mark AS if_first_order FROM f",
    "user_status_update": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, '1' AS if_consumed FROM orders",
    # wide table
    "order_wide": f"WITH {WIDE} SELECT order_id, detail_id, dt, user_id, sku_id, amt AS amount_cents, tm_name, "
                  "province_name, age_group AS user_age_group FROM wide",
    "split_payment": f"WITH {PAID} SELECT order_id, detail_id, final_cents FROM paid",
    # reports
    "trademark_batch_sum": f"WITH {WIDE} SELECT tm_id, tm_name, {_amount()} AS amount FROM wide GROUP BY ALL",
    "trademark_topn": f"WITH {TOP} SELECT * FROM top",
    "trademark_chart": f"WITH {TOP} SELECT trademark_name AS x, amount AS y, 1 AS s FROM top",
    "order_amount_total": f"WITH {PAID} SELECT dt, {_amount()} AS amount FROM paid GROUP BY dt",
    "order_amount_hour": f"WITH {AMOUNT_HOURS} SELECT dt, hr, amount FROM hours",
    "order_amount_day": f"WITH {PAID} SELECT '{shop.DAY}' AS dt, coalesce({_amount()}, 0) AS amount FROM paid WHERE {_day}",
    "order_hour_map": f"WITH {AMOUNT_HOURS} SELECT dt, hr, amount FROM hours WHERE {_day}",
    "hour_compare_amount": f"WITH {AMOUNT_HOURS} {_compare('hours', 'amount')}",
    "realtime_total": f"WITH {SEEN}, {NEW}, {PAID} " + " UNION ALL ".join([
        _total(0, f"SELECT count(*) FROM seen WHERE {_day}"),
        _total(1, f"SELECT n FROM new WHERE {_day}"),
        _total(2, f"SELECT {_amount()} FROM paid WHERE {_day}")]),
    "buyer_age_share": _share("age_group"),
    "buyer_gender_share": _share("gender_name"),
    "province_sales": f"WITH {WIDE} SELECT province_name, {_amount()} AS amount FROM wide GROUP BY 1",
    "sku_sales": f"WITH {WIDE} SELECT sku_name, CAST(sum(num) AS BIGINT) AS num FROM wide GROUP BY 1",
    "sale_detail_page": f"WITH {RINGS} SELECT detail_id, order_id, sku_name, dt, gender_name AS user_gender, "
                        "(SELECT count(*) FROM hit) AS total FROM hit ORDER BY detail_id LIMIT 20 OFFSET 20",
    # sinks
    "sink_topic_json": f"""WITH {WIDE} SELECT 'dws_order_wide' AS topic,
        '{{"order_detail_id":' || detail_id || ',"order_id":' || order_id || ',"dt":"' || dt || '","sku_id":' || sku_id
        || ',"sku_num":' || num || ',"tm_name":"' || tm_name || '","final_detail_amount":'
        || CAST(CAST(final_cents AS DECIMAL(18, 0)) / 100 AS DECIMAL(18, 2)) || '}}' AS value FROM wide""",
    "sink_upsert": "SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal < 0 THEN c_name || '*' ELSE c_name END "
                   "AS name, CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END AS version FROM customer",
    "sink_append": f"WITH {PAID} SELECT dt, count(*) AS n, {_amount()} AS amount FROM paid GROUP BY dt",
    "sink_upsert_daily": f"WITH {LOGS} SELECT DISTINCT dt, mid, CAST(1 AS BIGINT) AS n FROM logs WHERE is_start",
    "raw_log_archive": "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n FROM events GROUP BY 1",
    "batch_sample": "SELECT event_id FROM events ORDER BY event_id LIMIT 1000",
    "batch_count": "SELECT count(*) AS n FROM orders",
    # streams
    "stream_scan": "SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id FROM events",
    "stream_resume": "SELECT event_id FROM events",
    "stream_dau": f'WITH {SEEN} SELECT dt, mid, uid, "offset" AS event_id FROM seen',
    "sliding_window_count": """
        SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
        FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * i) AS start
              FROM events, (SELECT unnest(range(10)) AS i)) GROUP BY 1""",
    "stream_interval_join": f"WITH {PAIRS}",
    "stream_pair_dedup": f"WITH {PAIRS}",
    "stream_split_payment": f"WITH {PAID} SELECT order_id, detail_id, final_cents FROM paid",
    "stream_first_order": f"WITH {ORDERS}, {FIRSTS} SELECT id, mark AS if_first_order FROM f",
    "stream_dim_refresh": f"WITH {CHUNKED_ORDERS} SELECT id, CASE WHEN c_nationkey <= 12 OR chunk >= 2 "
                          "THEN n_name END AS province_name FROM c",
    "sink_exactly_once": f"WITH {WIDE} SELECT tm_id, tm_name, {_amount()} AS amount FROM wide GROUP BY ALL",
    "layers_brand_sum": f"WITH {WIDE} SELECT tm_id, tm_name, {_amount()} AS amount FROM wide GROUP BY ALL",
    "rollup_amount_hour": f"WITH {AMOUNT_HOURS} SELECT dt, hr, amount FROM hours",
    "rollup_trademark_topn": f"WITH {_top('2023-12-31', '2024-01-16')} SELECT * FROM top",
    "layers_replay": f"WITH {WIDE} SELECT tm_id, tm_name, {_amount()} AS amount FROM wide GROUP BY ALL",
    "fan_out": """
        SELECT 'user_status' AS sink, count(DISTINCT o_custkey) AS n FROM orders
        UNION ALL SELECT 'order_info', count(*) FROM orders
        UNION ALL SELECT 'dwd_order_info', count(*) FROM orders""",
}
