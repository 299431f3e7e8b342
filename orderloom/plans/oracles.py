"""SQL counterparts of the registered queries, for an engine with window functions over the sample tables.

They are written the textbook way (row numbers and windows per key), unlike the Spark side, so that a match
checks both.
"""

from __future__ import annotations

from orderloom.plans import queries as q
from orderloom.sources.mapping import AS_OF_YEAR, DIGEST

_NAMED_PARTS = """
spu AS (SELECT p_name, min(p_partkey) + 1 AS id FROM part GROUP BY p_name),
category3 AS (SELECT p_type, min(p_partkey) + 1 AS id FROM part GROUP BY p_type),
product AS (
  SELECT p_partkey AS sku_id, part.p_name AS sku_name, spu.id AS spu_id,
         CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS tm_id, category3.id AS category3_id,
         part.p_name AS spu_name, p_brand AS tm_name, part.p_type AS category3_nam
  FROM part JOIN spu ON part.p_name = spu.p_name JOIN category3 ON part.p_type = category3.p_type)
"""

_USERS = f"""
users AS (
  SELECT c_custkey AS id, c_mktsegment AS user_level,
         CAST(1940 + c_custkey % 70 AS VARCHAR) || '-01-01' AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN {AS_OF_YEAR} - (1940 + c_custkey % 70) < 18 THEN '0-17岁'
              WHEN {AS_OF_YEAR} - (1940 + c_custkey % 70) < 46 THEN '18-45岁'
              WHEN {AS_OF_YEAR} - (1940 + c_custkey % 70) < 70 THEN '46-69岁'
              ELSE '70岁及以上' END AS user_age_group,
         CASE WHEN c_custkey % 2 = 0 THEN '女' ELSE '男' END AS gender_name
  FROM customer)
"""



def _digest(prime: int, factor: int) -> str:
    digest = "CAST(7 AS BIGINT)"
    for part in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price_cents", "shipped"):
        digest = f"(({digest} * {factor} + {part}) % {prime})"
    return digest


_DETAIL = f"""
detail AS (
  SELECT {_digest(*DIGEST[0])} * 1073741824 + {_digest(*DIGEST[1])} AS id,
         l_orderkey AS order_id, l_partkey AS sku_id,
         (2 * price_cents + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT)) / 100.0 AS order_price,
         CAST(l_quantity AS BIGINT) AS sku_num,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS line_amount
  FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS price_cents,
               CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS shipped FROM lineitem))
"""

_ORDERS = """
orig AS (SELECT order_id, sum(line_amount) AS original FROM detail GROUP BY order_id),
flags AS (
  SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
ord AS (
  SELECT o.o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id, o_orderstatus AS order_status,
         o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS final_total_amount,
         coalesce(original, 0) AS original_total_amount, o_orderdate,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour,
         CASE WHEN rn = 1 THEN '1' ELSE '0' END AS if_first_order,
         n_name AS province_name, '1' || lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS province_area_code,
         'CN-' || n_nationkey AS province_iso_code, users.user_age_group, users.gender_name AS user_gender
  FROM orders o
  LEFT JOIN customer c ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN users ON users.id = o_custkey
  LEFT JOIN orig ON orig.order_id = o.o_orderkey
  JOIN flags ON flags.o_orderkey = o.o_orderkey)
"""


def _split(unit: int = 1) -> str:
    """Share per line in whole cents, half up to ``unit`` cents; the last line takes the rest."""
    return f"""
cents AS (
  SELECT d.id AS order_detail_id, d.order_id, d.line_amount, o.final_total_amount, o.original_total_amount,
         CAST(o.final_total_amount * 100 AS HUGEINT) AS f, CAST(o.original_total_amount * 100 AS HUGEINT) AS g,
         CAST(d.line_amount * 100 AS HUGEINT) AS a,
         row_number() OVER (PARTITION BY d.order_id ORDER BY d.id) AS rn,
         count(*) OVER (PARTITION BY d.order_id) AS n
  FROM detail d JOIN ord o ON o.id = d.order_id),
shares AS (
  SELECT *, CASE WHEN g = 0 THEN 0 ELSE ((2 * f * a + g * {unit}) // (2 * g * {unit})) * {unit} END AS share FROM cents),
split AS (
  SELECT *, CASE WHEN rn < n THEN share ELSE f - coalesce(sum(share) OVER earlier, 0) END AS part
  FROM shares
  WINDOW earlier AS (PARTITION BY order_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
"""


_WIDE = """
wide AS (
  SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
         CAST(d.order_price AS DOUBLE) AS sku_price, d.sku_num, p.sku_name, CAST(0 AS DOUBLE) AS benefit_reduce_amount,
         CAST(o.original_total_amount AS DOUBLE) AS original_total_amount, CAST(0 AS DOUBLE) AS feight_fee,
         CAST(o.final_total_amount AS DOUBLE) AS final_total_amount,
         CAST(s.part AS BIGINT) / 100.0 AS final_detail_amount, o.if_first_order, o.province_name, o.province_area_code,
         o.user_age_group, o.user_gender, o.create_date AS dt, coalesce(p.spu_id, 0) AS spu_id,
         coalesce(p.tm_id, 0) AS tm_id, coalesce(p.category3_id, 0) AS category3_id, p.spu_name, p.tm_name,
         p.category3_nam AS category3_name, s.part, o.o_orderdate
  FROM detail d JOIN ord o ON o.id = d.order_id
  JOIN split s ON s.order_id = d.order_id AND s.order_detail_id = d.id
  LEFT JOIN product p ON p.sku_id = d.sku_id)
"""

_FACTS = "WITH " + ",".join([_NAMED_PARTS, _USERS, _DETAIL, _ORDERS])
_FULL = ",".join([_FACTS, _split(), _WIDE])
_WIDE_COLUMNS = "* EXCLUDE (part, o_orderdate)"

_BRAND_BATCH = """
brand_batch AS (
  SELECT date_trunc('month', o_orderdate) AS stat_time, tm_id, tm_name, sum(part) AS part FROM wide GROUP BY ALL)
"""

_STATE_FLAGS = f"""
WITH state AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{q.STATE_CUTOFF}'),
flagged AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
         CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
               AND o_custkey NOT IN (SELECT o_custkey FROM state) THEN '1' ELSE '0' END AS if_first_order
  FROM orders WHERE o_orderdate >= TIMESTAMP '{q.STATE_CUTOFF}')
"""

_STREAM_FLAGS = """
SELECT o_orderkey AS id, o_custkey AS user_id,
       CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 THEN '1' ELSE '0' END
         AS if_first_order
FROM orders"""

_LAUNCHES = """
WITH launches AS (
  SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         '1' || lpad(CAST(user_id % 25 AS VARCHAR), 5, '0') AS ar, event_type AS ch, 'v' || (user_id % 3) AS vc,
         strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, '00' AS mi, epoch_us(ts) // 1000 AS ts, event_id
  FROM events WHERE event_type IN ('signup', 'click')),
dau AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, mid ORDER BY ts, event_id) AS rn FROM launches) WHERE rn = 1)
"""

_BOTH_DAYS = f"""
hours AS (
  SELECT hr, count(CASE WHEN dt < '{q.DAU_DAY}' THEN 1 END) AS yesterday, count(CASE WHEN dt = '{q.DAU_DAY}' THEN 1 END) AS today
  FROM dau WHERE dt IN ('{q.DAU_DAY}', strftime(DATE '{q.DAU_DAY}' - INTERVAL 1 DAY, '%Y-%m-%d')) GROUP BY hr)
"""

_KPIS = f"""
{_LAUNCHES},
active AS (SELECT count(DISTINCT mid) AS n FROM launches WHERE dt = '{q.DAU_DAY}'),
fresh AS (SELECT count(*) AS n FROM (SELECT mid FROM launches GROUP BY mid HAVING min(dt) = '{q.DAU_DAY}'))
"""

_KPI_ROWS = f"""{_KPIS}
        SELECT 'dau' AS id, '新增日活' AS name, n AS value FROM active
        UNION ALL SELECT 'new_mid', '新增设备', n FROM fresh"""

_USER_CHANGES = (
    "WITH "
    + _USERS
    + """,
events_in AS (
  SELECT id, user_level, birthday, gender, 'insert' AS type, id AS pos FROM users
  UNION ALL
  SELECT id, user_level || '+', birthday, gender, CASE WHEN id % 2 = 0 THEN 'delete' ELSE 'update' END, id + 1000000000000
  FROM users WHERE id % 3 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS rn FROM events_in)
"""
)

_ORDER_ROWS = """
SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS order_status,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS final_total_amount,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time
"""

_DETAIL_HITS = f"dt = '{q.PAGE_DAY}' AND contains(sku_name, '{q.PAGE_KEYWORD}')"

_BROKEN = "o_orderkey % 7 = 0"

ORACLES: dict[str, str] = {
    "brand_topn": f"""{_FULL},{_BRAND_BATCH}
        SELECT tm_id, tm_name, CAST(sum(part) AS BIGINT) / 100.0 AS sum_amount FROM brand_batch
        WHERE stat_time > TIMESTAMP '{q.RANKING_START}' AND stat_time < TIMESTAMP '{q.RANKING_END}'
        GROUP BY tm_id, tm_name ORDER BY sum(part) DESC, tm_id LIMIT {q.RANKING_SIZE}""",
    "brand_batch_sum": f"""{_FULL},{_BRAND_BATCH}
        SELECT strftime(stat_time, '%Y-%m-%d %H:%M:%S') AS stat_time, tm_id, tm_name, CAST(part AS BIGINT) / 100.0 AS amount
        FROM brand_batch""",
    "split_amount": f"""{_FACTS},{_split()}
        SELECT order_id, order_detail_id, CAST(line_amount AS DOUBLE) AS line_amount,
               CAST(final_total_amount AS DOUBLE) AS final_total_amount,
               CAST(original_total_amount AS DOUBLE) AS original_total_amount,
               CAST(part AS BIGINT) / 100.0 AS final_detail_amount,
               CAST(sum(part) OVER (PARTITION BY order_id) - part AS BIGINT) / 100.0 AS other_split_amount,
               CAST(sum(a) OVER (PARTITION BY order_id) - a AS BIGINT) / 100.0 AS other_origin_amount
        FROM split""",
    "split_amount_whole_units": f"""{_FACTS},{_split(100)}
        SELECT order_id, order_detail_id, CAST(part AS BIGINT) / 100.0 AS final_detail_amount FROM split""",
    "order_wide": f"{_FULL} SELECT {_WIDE_COLUMNS} FROM wide",
    "order_wide_colocated": f"{_FULL} SELECT {_WIDE_COLUMNS} FROM wide",
    "order_wide_dedup": f"{_FULL} SELECT {_WIDE_COLUMNS} FROM wide",
    "wide_seen_filter": f"""WITH {_DETAIL}
        SELECT d.id AS order_detail_id, d.order_id, strftime(o_orderdate, '%Y-%m-%d') AS dt,
               CAST(line_amount AS DOUBLE) AS line_amount
        FROM detail d JOIN orders ON o_orderkey = d.order_id WHERE o_orderdate >= TIMESTAMP '{q.STATE_CUTOFF}'""",
    "order_enriched": f"""{_FACTS}
        SELECT id, province_id, order_status, user_id, CAST(final_total_amount AS DOUBLE) AS final_total_amount,
               CAST(0 AS DOUBLE) AS benefit_reduce_amount, CAST(original_total_amount AS DOUBLE) AS original_total_amount,
               CAST(0 AS DOUBLE) AS feight_fee, CAST(NULL AS VARCHAR) AS expire_time, create_time,
               CAST(NULL AS VARCHAR) AS operate_time, create_date, create_hour, if_first_order, province_name,
               province_area_code, province_iso_code, user_age_group, user_gender
        FROM ord""",
    "detail_enriched": f"""{_FACTS}
        SELECT d.id, d.order_id, d.sku_id, CAST(d.order_price AS DOUBLE) AS order_price, d.sku_num, p.sku_name,
               CAST(NULL AS VARCHAR) AS create_time, coalesce(p.spu_id, 0) AS spu_id, coalesce(p.tm_id, 0) AS tm_id,
               coalesce(p.category3_id, 0) AS category3_id, p.spu_name, p.tm_name, p.category3_nam
        FROM detail d LEFT JOIN product p ON p.sku_id = d.sku_id""",
    "first_order_flag": f"{_STATE_FLAGS} SELECT * FROM flagged",
    "new_buyers": f"""{_STATE_FLAGS}
        SELECT CAST(user_id AS VARCHAR) AS user_id, if_first_order AS if_consumed FROM flagged WHERE if_first_order = '1'""",
    "order_time_fields": """
        SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
               strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour FROM orders""",
    "user_demographics": f"WITH {_USERS} SELECT * FROM users",
    "dim_latest": f"{_USER_CHANGES} SELECT id, user_level, birthday, gender FROM ranked WHERE rn = 1",
    "dim_latest_deletes": f"""{_USER_CHANGES}
        SELECT id, user_level, birthday, gender FROM ranked WHERE rn = 1 AND type <> 'delete'""",
    "product_dim": f"WITH {_NAMED_PARTS} SELECT * FROM product",
    "cdc_object": f"{_ORDER_ROWS}, 'insert' AS type FROM orders WHERE o_orderkey % 50 <> 0",
    "cdc_array": f"""{_ORDER_ROWS}, 'INSERT' AS type FROM orders JOIN range(2) AS copies(k)
        ON k < CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END""",
    "cdc_route": """
        SELECT 'ODS_NATION' AS topic, CAST(n_nationkey AS BIGINT) AS "offset", n_name AS label FROM nation
        UNION ALL SELECT 'ODS_CUSTOMER', c_custkey, c_mktsegment FROM customer
        UNION ALL SELECT 'ODS_PART', p_partkey, p_name FROM part
        UNION ALL SELECT 'ODS_ORDERS', o_orderkey, o_orderstatus FROM orders""",
    "cdc_rejects": f"""
        SELECT o_orderkey AS "offset", substr('{{"table":"order_info","type":"' || CASE o_orderkey % 100
               WHEN 0 THEN 'bootstrap-start' WHEN 50 THEN 'bootstrap-complete' ELSE 'insert' END || '","data":', 1, 40) AS value
        FROM orders WHERE {_BROKEN}""",
    "cdc_array_rejects": """
        SELECT o_orderkey AS "offset", CASE WHEN o_orderkey % 7 = 0
               THEN '{"table":"order_info","type":"INSERT","data":"' || o_orderkey || '"}'
               ELSE substr('{"table":"order_info","type":"INSERT","data":', 1, 38) END AS value
        FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""",
    "log_route": """
        SELECT CAST(user_id AS VARCHAR) AS key,
               CASE WHEN event_type IN ('signup', 'click') THEN 'START_LOG' ELSE 'EVENT_LOG' END AS topic,
               CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset" FROM events""",
    "log_archive": """
        SELECT strftime(ts, '%Y-%m-%d') AS dt, '{'
               || CASE WHEN event_type IN ('signup', 'click') THEN '"start":{"entry":"' || event_type || '"},' ELSE '' END
               || '"common":{"mid":"' || user_id || '","uid":"' || user_id || '","ar":"1' || lpad(CAST(user_id % 25 AS VARCHAR), 5, '0')
               || '","ch":"' || event_type || '","vc":"v' || user_id % 3 || '"},"ts":' || epoch_us(ts) // 1000 || '}' AS value
        FROM events""",
    "dau_first_launch": f"{_LAUNCHES} SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts FROM dau",
    "dau_devices_per_day": f"{_LAUNCHES} SELECT dt, count(DISTINCT mid) AS devices FROM launches GROUP BY dt",
    "dau_total": f"{_LAUNCHES} SELECT count(DISTINCT mid) AS dau_total FROM launches WHERE dt = '{q.DAU_DAY}'",
    "dau_hourly": f"""{_LAUNCHES}
        SELECT hr, count(*) AS n FROM dau WHERE dt = '{q.DAU_DAY}' GROUP BY hr ORDER BY n DESC, hr LIMIT 24""",
    "dau_compare": f"""{_LAUNCHES},{_BOTH_DAYS}
        SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hr, coalesce(yesterday, 0) AS yesterday, coalesce(today, 0) AS today
        FROM range(24) AS clock(h) LEFT JOIN hours ON hours.hr = lpad(CAST(h AS VARCHAR), 2, '0')""",
    "dau_compare_json": f"""{_LAUNCHES},{_BOTH_DAYS},
        sides AS (
          SELECT string_agg('"' || hr || '":' || yesterday, ',' ORDER BY hr) FILTER (yesterday > 0) AS y,
                 string_agg('"' || hr || '":' || today, ',' ORDER BY hr) FILTER (today > 0) AS t FROM hours)
        SELECT '{{"yesterday":{{' || coalesce(y, '') || '}},"today":{{' || coalesce(t, '') || '}}}}' AS response FROM sides""",
    "new_devices": f"{_KPIS} SELECT n AS new_mid FROM fresh",
    "kpi_totals": _KPI_ROWS,
    "stream_kpi": _KPI_ROWS,
    "detail_page": f"""{_FULL}
        SELECT {_WIDE_COLUMNS} FROM wide WHERE {_DETAIL_HITS}
        ORDER BY dt DESC, order_detail_id LIMIT {q.PAGE_LENGTH} OFFSET {q.PAGE_START}""",
    "stream_detail_seek": f"""{_FULL}
        SELECT {_WIDE_COLUMNS} FROM wide WHERE {_DETAIL_HITS}
        ORDER BY dt DESC, order_detail_id LIMIT {q.SEEK_LENGTH} OFFSET {q.SEEK_LENGTH}""",
    "detail_count": f"{_FULL} SELECT count(*) AS total FROM wide WHERE {_DETAIL_HITS}",
    "gender_share": f"""{_FULL}
        SELECT user_gender AS name, count(*) AS value, count(*) / sum(count(*)) OVER () AS share FROM wide GROUP BY 1""",
    "age_share": f"""{_FULL},
        aged AS (
          SELECT CASE WHEN {AS_OF_YEAR} - (1940 + user_id % 70) < 20 THEN '20岁以下'
                      WHEN {AS_OF_YEAR} - (1940 + user_id % 70) <= 30 THEN '20-30岁' ELSE '30岁以上' END AS name FROM wide)
        SELECT name, count(*) AS value, count(*) / sum(count(*)) OVER () AS share FROM aged GROUP BY name""",
    "province_sales": f"""{_FULL}
        SELECT province_name, CAST(sum(part) AS BIGINT) / 100.0 AS sales,
               least(CAST(floor(sum(part) / 2500000000.0) AS BIGINT), 5) AS level FROM wide GROUP BY province_name""",
    "doc_search": rf"""
        SELECT doc_id AS id, text AS name, lang || ',' || source AS members, n_chars AS score FROM documents
        WHERE (lang = '{q.SEARCH_MEMBER}' OR source = '{q.SEARCH_MEMBER}')
          AND list_contains(string_split_regex(lower(text), '[^\p{{L}}\p{{M}}\p{{N}}_]+'), '{q.SEARCH_WORD}')
        ORDER BY n_chars DESC, doc_id LIMIT 20""",
    "stream_dau": f"{_LAUNCHES} SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts FROM dau",
    "stream_device_sketches": f"""{_LAUNCHES}
        SELECT substr(dt, 1, 7) AS month, count(DISTINCT dt) AS days, true AS within_bound FROM launches GROUP BY 1""",
    "stream_unmatched": f"""WITH {_DETAIL}
        SELECT id AS order_detail_id, order_id FROM detail JOIN orders ON o_orderkey = order_id
        WHERE order_id % {q.WITHHELD} = 0""",
    "stream_dau_state": f"{_LAUNCHES} SELECT dt, mid FROM dau",
    # Each of the three cuts makes one batch of orders and lines. The joined stream runs a batch without rows after each but the last, so its
    # rows are written by batches 0, 2 and 4. A batch's position is that of its last row, not of all.
    "progress_ledger": f"""WITH {_NAMED_PARTS}, {_DETAIL}
        SELECT grp AS group_id, 'APP_LOG' AS topic, CAST(event_id % 4 AS INTEGER) AS partition_id,
               max(event_id // 4) + 1 AS topic_offset
        FROM events JOIN (VALUES ('LOGS'), ('DAU')) AS jobs(grp)
          ON grp = 'LOGS' OR event_type IN ('signup', 'click') GROUP BY ALL
        UNION ALL SELECT name, 'CHANGES', 0, last + 1 FROM (
          SELECT 'order_info' AS name, max(o_orderkey) AS last FROM orders WHERE o_orderdate >= '1999-06-01'
          UNION ALL SELECT 'order_detail', max(id) FROM detail JOIN orders ON o_orderkey = order_id WHERE o_orderdate >= '1999-06-01'
          UNION ALL SELECT 'user_info', max(c_custkey) FROM customer
          UNION ALL SELECT 'base_province', max(n_nationkey) FROM nation
          UNION ALL SELECT 'sku_info', max(sku_id) FROM product
          UNION ALL SELECT 'spu_info', max(spu_id) FROM product
          UNION ALL SELECT 'base_trademark', max(tm_id) FROM product
          UNION ALL SELECT 'base_category3', max(category3_id) FROM product)
        UNION ALL SELECT * FROM (VALUES ('wide', 'DWD_ORDER_INFO', 0, 3), ('wide', 'DWD_ORDER_DETAIL', 0, 3), ('brands', 'ADS_ORDER_WIDE', 0, 5))""",
    "stream_dim": f"""WITH {_USERS}
        SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN user_level || '+' ELSE user_level END AS user_level) FROM users""",
    "stream_dim_sql": f"""WITH {_NAMED_PARTS}
        SELECT tm_id, tm_name, category3_nam AS category3_name, count(*) AS skus FROM product GROUP BY ALL""",
    "stream_first_order": _STREAM_FLAGS,
    "stream_first_order_state": _STREAM_FLAGS,
    "stream_wide": f"{_FULL} SELECT {_WIDE_COLUMNS} FROM wide",
    "stream_brand": f"""{_FULL}
        SELECT tm_id, tm_name, CAST(sum(part) AS BIGINT) / 100.0 AS sum_amount FROM wide GROUP BY tm_id, tm_name""",
    "stream_split_state": f"""{_FACTS},{_split()}
        SELECT order_id, order_detail_id, CAST(part AS BIGINT) / 100.0 AS final_detail_amount FROM split""",
}
for _name in ("cdc_route", "dau_total", "detail_page"):
    ORACLES[f"stream_{_name}"] = ORACLES[_name]
