"""The SQL each registered query is checked against, for DuckDB over the same parquet tables.

Money is summed as ``decimal(18,2)`` and turned into a double once; times are compared as text.
"""

from __future__ import annotations

from lakemill.checks.queries import (
    FIRST_RUN, RUN_DAY, SECOND_RUN, SPLIT, TARGET_USER, TOP_YEAR,
)

MONEY = "CAST(o_totalprice AS DECIMAL(18,2))"
NATIONS = 25


def _text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


_ORDERS = f"""orders_m AS (
  SELECT o_orderkey AS order_sn, o_custkey AS customer_id, {MONEY} AS order_money,
         o_orderdate AS create_time, o_orderstatus AS order_status FROM orders)"""

_VALID = f"""{_ORDERS}, valid AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_sn ORDER BY create_time DESC) AS rn
    FROM orders_m WHERE order_status <> 'P') WHERE rn = 1)"""


def _cities(source: str) -> str:
    return f"""cities AS (
  SELECT o.*, n_name AS city, r_name AS province,
         CAST(year(create_time) AS INTEGER) AS year, CAST(month(create_time) AS INTEGER) AS month
  FROM {source} o JOIN customer ON c_custkey = customer_id
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


_VALID_CITIES = f"{_VALID}, {_cities('valid')}"

_PLACED = f"""{_ORDERS}, placed AS (
  SELECT o.*, n_nationkey AS province_id, n_name AS province_name, r_regionkey AS region_id,
         r_name AS region_name, CAST(year(create_time) AS INTEGER) AS year,
         CAST(month(create_time) AS INTEGER) AS month
  FROM orders_m o JOIN customer ON c_custkey = customer_id
  LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey)"""

_LINES = """lines AS (
  SELECT l_orderkey AS order_sn, l_partkey AS product_id, l_linenumber AS line_no,
         CAST(l_quantity AS BIGINT) AS product_cnt, CAST(l_extendedprice AS DECIMAL(18,2)) AS product_price,
         l_shipdate AS modified_time FROM lineitem)"""

_LINE_COLUMNS = f"""order_sn, product_id, line_no, product_cnt, CAST(product_price AS DOUBLE) AS product_price,
  {_text('modified_time')} AS modified_time"""

_ORDER_COLUMNS = f"""order_sn, customer_id, CAST(order_money AS DOUBLE) AS order_money,
  {_text('create_time')} AS create_time, order_status"""

_CUSTOMERS = "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id"

_STAMPS = f"""'user1' AS dwd_insert_user, '{SECOND_RUN}' AS dwd_insert_time,
  'user1' AS dwd_modify_user, '{SECOND_RUN}' AS dwd_modify_time"""

_LATEST_LINE = """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_sn, line_no ORDER BY modified_time {0},
    product_cnt {0}, product_id {0}, product_price {0}) AS rn FROM lines) WHERE rn = 1"""

_LABEL = "CASE WHEN {0} > {1} THEN '高' WHEN {0} < {1} THEN '低' ELSE '相同' END"

_OPERATED = "CASE WHEN order_status = 'F' THEN create_time + INTERVAL 30 DAY END"


def _user_day(source: str, user: str = "customer_id", name: str = "customer_name") -> str:
    return f"""SELECT customer_id AS {user}, c_name AS {name}, CAST(sum(order_money) AS DOUBLE) AS total_amount,
  count(*) AS total_count, CAST(year(create_time) AS INTEGER) AS year,
  CAST(month(create_time) AS INTEGER) AS month, CAST(day(create_time) AS INTEGER) AS day
FROM {source} JOIN customer ON c_custkey = customer_id
GROUP BY customer_id, c_name, year(create_time), month(create_time), day(create_time)"""


_CITY_MONTH = """SELECT *, rank() OVER (ORDER BY total_amount DESC) AS sequence FROM (
  SELECT city AS city_name, province AS province_name, CAST(sum(order_money) AS DOUBLE) AS total_amount,
         count(*) AS total_count, year, month FROM {0} GROUP BY city, province, year, month)"""

_ROLLUP = """SELECT *, rank() OVER (ORDER BY total_amount DESC) AS sequence FROM (
  SELECT province_id, province_name, region_id, region_name, CAST(sum(order_money) AS DOUBLE) AS total_amount,
         count(*) AS total_count, year, month FROM placed
  GROUP BY province_id, province_name, region_id, region_name, year, month)"""


def _average(child: str, parent: str, period: str, source: str, columns: str, child_avg: str, parent_avg: str) -> str:
    p = f"{parent}, {period}" if parent else period
    c = f"{child}, {p}"
    return f"""SELECT {columns}, CAST(cs AS DOUBLE) / cn AS {child_avg}, CAST(ps AS DOUBLE) / pn AS {parent_avg},
  {_LABEL.format('CAST(cs AS DOUBLE) / cn', 'CAST(ps AS DOUBLE) / pn')} AS comparison
FROM (SELECT {c}, sum(order_money) AS cs, count(*) AS cn FROM {source} GROUP BY {c}) ch
JOIN (SELECT {p}, sum(order_money) AS ps, count(*) AS pn FROM {source} GROUP BY {p}) pa USING ({p})"""


def _median(child: str, parent: str, period: str, source: str, columns: str, extra: str = "") -> str:
    p, c = f"{parent}, {period}", f"{child}, {parent}, {period}"
    return f"""SELECT {columns}
FROM (SELECT {c}, CAST(quantile_disc(order_money, 0.5) AS DOUBLE) AS cm FROM {source} {extra} GROUP BY {c}) ch
JOIN (SELECT {p}, CAST(quantile_disc(order_money, 0.5) AS DOUBLE) AS pm FROM {source} {extra} GROUP BY {p}) pa
USING ({p})"""


_CITY_AVERAGE = _average(
    "city", "province", "year, month", "cities", "city AS cityname, province AS provincename",
    "cityavgconsumption", "provinceavgconsumption")

_CITY_MEDIAN = _median(
    "city", "province", "year, month", "cities",
    "city AS cityname, cm AS citymidconsumption, province AS provincename, pm AS provincemidconsumption, "
    f"{_LABEL.format('cm', 'pm')} AS comparison")

_HOURS = "events_m AS (SELECT ts, CAST(value AS DECIMAL(18,2)) AS order_money FROM events)"


def _running(where: str = "") -> str:
    return f"""WITH {_HOURS}, hours AS (
  SELECT date_trunc('hour', ts) AS h, sum(order_money) AS s FROM events_m {where} GROUP BY 1)
SELECT strftime(h, '%Y-%m-%d %H') AS consumptiontime, CAST(s AS DOUBLE) AS consumptionadd,
  CAST(sum(s) OVER (ORDER BY h) AS DOUBLE) AS consumptionacc FROM hours"""


_WINDOWS = f"""{_HOURS}, windows AS (
  SELECT date_trunc('hour', ts) + to_hours(CAST(k AS BIGINT)) AS e, sum(order_money) AS s, count(*) AS n
  FROM events_m, range(1, 6) t(k) GROUP BY 1)"""


def _sliding(where: str = "") -> str:
    # The average is rounded half up in whole cents; amounts are not negative.
    return f"""WITH {_WINDOWS}, labelled AS (
  SELECT strftime(e, '%Y-%m-%d %H') AS consumptiontime, s, n, CAST(s * 100 AS HUGEINT) AS cents FROM windows)
SELECT consumptiontime, CAST(s AS DOUBLE) AS consumptionsum, CAST(n AS DOUBLE) AS consumptioncount,
  CAST(CAST((2 * cents + n) // (2 * n) AS DECIMAL(38,0)) / 100 AS DOUBLE) AS consumptionavg
FROM labelled {where}"""


_PREFIX = f"""{_ORDERS}, sums AS (
  SELECT order_sn, order_money, sum(order_money) OVER (ORDER BY order_sn) AS total FROM orders_m)"""


def _overlap(keep_self: bool) -> str:
    own = "" if keep_self else f"AND customer_id <> {TARGET_USER}"
    return f"""WITH bought AS (
  SELECT DISTINCT o_custkey AS customer_id, l_partkey AS product_id
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part ON p_partkey = l_partkey)
SELECT customer_id, count(*) AS num_products FROM bought
WHERE product_id IN (SELECT product_id FROM bought WHERE customer_id = {TARGET_USER}) {own}
GROUP BY customer_id ORDER BY num_products DESC, customer_id LIMIT 10"""


def _repurchase(rate: str) -> str:
    return f"""WITH {_VALID}, days AS (
  SELECT DISTINCT customer_id, CAST(create_time AS DATE) AS d FROM valid),
steps AS (SELECT *, d - lag(d) OVER (PARTITION BY customer_id ORDER BY d) AS gap FROM days),
counts AS (SELECT count(DISTINCT customer_id) AS purchaseduser,
  count(DISTINCT CASE WHEN gap = 1 THEN customer_id END) AS repurchaseduser FROM steps)
SELECT purchaseduser, repurchaseduser, {rate} AS repurchaserate FROM counts"""


_UPSERTED = f"""WITH {_LINES}, latest AS ({_LATEST_LINE.format('DESC')})
SELECT {_LINE_COLUMNS}, CAST(year(modified_time) AS INTEGER) AS ship_year FROM latest"""


_HISTORY = f"""{_ORDERS}, seen AS (
  SELECT *, create_time AS modified_time, strftime(date_trunc('month', create_time), '%Y%m%d') AS etl_date FROM orders_m),
early AS (SELECT * FROM seen WHERE create_time < TIMESTAMP '{SPLIT}' AND order_sn % 2 = 0),
high AS (SELECT max(modified_time) AS h FROM early),
history AS (
  SELECT *, '20240130' AS load_day FROM early
  UNION ALL SELECT seen.*, '{RUN_DAY}' FROM seen, high WHERE h IS NULL OR create_time > h OR (create_time = h AND order_sn % 2 = 1)
  UNION ALL SELECT * REPLACE ('P' AS order_status, TIMESTAMP '{SECOND_RUN}' AS modified_time), '{RUN_DAY}' FROM seen WHERE order_sn % 3 = 0)"""

_NIGHT_COLUMNS = f"""order_sn, customer_id, CAST(order_money AS DOUBLE) AS order_money, {_text('create_time')} AS create_time,
  order_status, {_text('modified_time')} AS modified_time, etl_date"""


_VERSIONS = f"""WITH {_LINES}, versions AS (
  SELECT *, CASE WHEN modified_time < TIMESTAMP '{SPLIT}' THEN '{FIRST_RUN}' ELSE '{SECOND_RUN}' END AS stamp FROM lines),
ranked AS (
  SELECT *, max(stamp) OVER (PARTITION BY product_id) AS dwd_modify_time,
    min(stamp) OVER (PARTITION BY product_id) AS dwd_insert_time,
    row_number() OVER (PARTITION BY product_id ORDER BY modified_time DESC, stamp DESC, line_no DESC,
      order_sn DESC, product_cnt DESC, product_price DESC) AS rn FROM versions)
SELECT {_LINE_COLUMNS}, 'user1' AS dwd_insert_user, dwd_insert_time, 'user1' AS dwd_modify_user, dwd_modify_time"""


def statements() -> dict[str, str]:
    return {
        "raw_scan": f"WITH {_ORDERS} SELECT {_ORDER_COLUMNS}, CAST(order_sn AS VARCHAR) AS _hoodie_record_key FROM orders_m",
        "rows_to_frame": "SELECT o_orderstatus AS order_status, count(*) AS n FROM orders GROUP BY o_orderstatus",
        "layer_preview": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, least(20, count(*)) AS n FROM {t}" for t in ("orders", "customer", "region")),
        "default_run_day": f"{_CUSTOMERS}, strftime(current_date - INTERVAL 1 DAY, '%Y%m%d') AS etl_date FROM customer",
        "fact_history": f"WITH {_HISTORY} SELECT {_NIGHT_COLUMNS}, load_day FROM history",
        "current_facts": f"""WITH {_HISTORY} SELECT {_NIGHT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_sn ORDER BY modified_time DESC, load_day DESC) AS rn FROM history) WHERE rn = 1""",
        "valid_facts": f"""WITH {_HISTORY} SELECT {_NIGHT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_sn ORDER BY create_time DESC, modified_time DESC) AS rn
  FROM history WHERE order_status <> 'P') WHERE rn = 1""",
        "catalog_scan": f"SELECT * REPLACE ({_text('o_orderdate')} AS o_orderdate) FROM orders",
        "read_cols": "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
        "keyed_scan": f"WITH {_ORDERS} SELECT {_ORDER_COLUMNS} FROM orders_m",
        "empty_like": f"{_CUSTOMERS}, {_STAMPS} FROM customer",
        "full_extract": f"SELECT * EXCLUDE (c_mktsegment), '{RUN_DAY}' AS etldate FROM customer",
        "full_extract_keyed": f"WITH {_LINES}, latest AS ({_LATEST_LINE.format('DESC')}) "
        f"SELECT {_LINE_COLUMNS}, '{RUN_DAY}' AS etldate FROM latest",
        "incr_ts": f"WITH {_ORDERS} SELECT {_ORDER_COLUMNS} FROM orders_m WHERE create_time > "
        f"(SELECT max(create_time) FROM orders_m WHERE create_time < TIMESTAMP '{SPLIT}')",
        "incr_two_ts": f"""WITH {_ORDERS}, src AS (SELECT *, {_OPERATED} AS operate_time FROM orders_m),
high AS (SELECT max(greatest(create_time, coalesce(operate_time, create_time))) AS h FROM src
         WHERE create_time < TIMESTAMP '{SPLIT}')
SELECT {_ORDER_COLUMNS}, {_text('operate_time')} AS operate_time FROM src, high
WHERE create_time > h OR operate_time > h""",
        "incr_id": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_nationkey AS nation_id
FROM customer WHERE c_custkey > (SELECT max(s_suppkey) FROM supplier)""",
        "stamp_load_time": f"{_CUSTOMERS}, '{SECOND_RUN}' AS create_time, '{RUN_DAY}' AS etl_date FROM customer",
        "fill_operate_time": f"WITH {_ORDERS} SELECT {_ORDER_COLUMNS}, "
        f"{_text(f'coalesce({_OPERATED}, create_time)')} AS operate_time FROM orders_m",
        "audit_stamp": f"{_CUSTOMERS}, {_STAMPS} FROM customer",
        "normalise_times": f"""SELECT event_id, event_type, CASE WHEN event_type IN ('click', 'view', 'purchase')
THEN {_text("date_trunc('second', ts)")} END AS event_time FROM events""",
        "dim_merge": f"{_VERSIONS} FROM ranked WHERE rn = 1",
        "stream_dim_merge": f"{_VERSIONS}, CAST(product_id % 4 AS INTEGER) AS line_group FROM ranked WHERE rn = 1",
        "dedupe_latest": f"WITH {_LINES}, latest AS ({_LATEST_LINE.format('DESC')}) SELECT {_LINE_COLUMNS} FROM latest",
        "dedupe_earliest": f"WITH {_LINES}, first AS ({_LATEST_LINE.format('ASC')}) SELECT {_LINE_COLUMNS} FROM first",
        "key_lifecycle": f"WITH {_LINES} SELECT product_id, {_text('max(modified_time)')} AS modified_time, "
        f"{_text('min(modified_time)')} AS insert_time FROM lines GROUP BY product_id",
        "event_partition": f"WITH {_ORDERS} SELECT {_ORDER_COLUMNS}, strftime(create_time, '%Y%m%d') AS etl_date FROM orders_m",
        "fact_clean": f"""WITH {_ORDERS}, {_cities('orders_m')} SELECT {_ORDER_COLUMNS}, city, province,
strftime(create_time, '%Y%m%d') AS etl_date, {_STAMPS} FROM cities WHERE length(city) <= 8""",
        "conform": f"WITH {_LINES} SELECT product_id, order_sn, line_no, CAST(product_price AS DOUBLE) AS product_price FROM lines",
        "filter_predicates": """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE (l_returnflag = 'A' AND l_linestatus <> 'F' AND l_quantity > 10)
   OR (l_discount >= 0.05 AND l_tax <= 0.02 AND l_shipdate IS NOT NULL)""",
        "not_in": f"WITH {_ORDERS} SELECT {_ORDER_COLUMNS} FROM orders_m WHERE order_status NOT IN ('P')",
        "join_inner": f"WITH {_ORDERS} SELECT order_sn, c_name AS customer_name, CAST(order_money AS DOUBLE) AS order_money "
        "FROM orders_m JOIN customer ON c_custkey = customer_id",
        "join_left": """SELECT c_custkey AS customer_id, c_nationkey AS nation_id, n_name AS province_name,
r_name AS region_name FROM customer LEFT JOIN (
  SELECT * FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'ASIA') ON n_nationkey = c_nationkey""",
        "ref_filter": """SELECT l_orderkey AS order_sn, l_linenumber AS line_no, l_partkey AS product_id,
o_custkey AS customer_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25)
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
        "union_by_name": """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation_id FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
        "valid_orders": f"WITH {_VALID} SELECT {_ORDER_COLUMNS} FROM valid",
        "user_day_consumption": f"WITH {_VALID} {_user_day('valid')}",
        "user_day_consumption_all": f"WITH {_ORDERS} {_user_day('orders_m', 'user_id', 'user_name')}",
        "city_month_consumption": f"WITH {_VALID_CITIES} {_CITY_MONTH.format('cities')}",
        "region_rollup": f"WITH {_PLACED} {_ROLLUP}",
        "region_rollup_keyed": f"""WITH {_PLACED}, r AS ({_ROLLUP})
SELECT *, sha256(concat_ws(chr(31), province_id, region_id, year, month)) AS uuid FROM r""",
        "avg_vs_parent": f"WITH {_VALID_CITIES} {_CITY_AVERAGE}",
        "avg_vs_parent_top": f"WITH {_VALID_CITIES}, r AS ({_CITY_AVERAGE}) SELECT * FROM r "
        "ORDER BY cityavgconsumption DESC, provinceavgconsumption DESC, cityname LIMIT 5",
        "median_vs_parent": f"WITH {_VALID_CITIES} {_CITY_MEDIAN}",
        "median_vs_parent_top": f"WITH {_VALID_CITIES}, r AS ({_CITY_MEDIAN}) SELECT * FROM r "
        "ORDER BY citymidconsumption DESC, provincemidconsumption DESC, cityname LIMIT 5",
        "avg_vs_region": f"WITH {_PLACED} " + _average(
            "province_id, province_name", "region_id, region_name", "year, month", "placed",
            "province_id AS provinceid, province_name AS provincename, region_id AS regionid, region_name AS regionname",
            "provinceavgconsumption", "regionavgconsumption"),
        "avg_vs_all": f"WITH {_PLACED} " + _average(
            "province_id, province_name", "", "year, month", "placed",
            "province_id AS provinceid, province_name AS provincename",
            "provinceavgconsumption", "allprovinceavgconsumption"),
        "nation_median": f"WITH {_PLACED} " + _median(
            "province_id, province_name", "region_id, region_name", "year", "placed",
            "province_id AS provinceid, province_name AS provincename, region_id AS regionid, "
            "region_name AS regionname, cm AS provincemedian, pm AS regionmedian", f"WHERE year = {TOP_YEAR}"),
        "top_n_per_group": f"""WITH {_VALID_CITIES}, totals AS (
  SELECT province, city, sum(order_money) AS s FROM cities WHERE year = {TOP_YEAR} GROUP BY province, city),
ranked AS (SELECT *, rank() OVER (PARTITION BY province ORDER BY s DESC) AS r FROM totals)
SELECT province AS provincename, string_agg(city, ',' ORDER BY r, city) AS citynames,
  string_agg(CAST(CAST(round(s) AS BIGINT) AS VARCHAR), ',' ORDER BY r, city) AS cityamount
FROM ranked WHERE r <= 3 GROUP BY province""",
        "region_top_three": f"""WITH {_PLACED}, totals AS (
  SELECT region_id, region_name, province_id, province_name, sum(order_money) AS s
  FROM placed WHERE year = {TOP_YEAR} GROUP BY ALL),
ranked AS (SELECT *, rank() OVER (PARTITION BY region_id, region_name ORDER BY s DESC) AS r FROM totals)
SELECT region_id AS regionid, region_name AS regionname,
  string_agg(CAST(province_id AS VARCHAR), ',' ORDER BY r, province_id) AS provinceids,
  string_agg(province_name, ',' ORDER BY r, province_id) AS provincenames,
  string_agg(CAST(CAST(round(s) AS BIGINT) AS VARCHAR), ',' ORDER BY r, province_id) AS provinceamount
FROM ranked WHERE r <= 3 GROUP BY region_id, region_name""",
        "top_n_pair": f"""WITH {_LINES}, totals AS (
  SELECT product_id, p_name AS product_name, sum(product_cnt) AS q, sum(product_cnt * product_price) AS v
  FROM lines JOIN part ON p_partkey = product_id GROUP BY product_id, p_name),
a AS (SELECT *, row_number() OVER (ORDER BY q DESC, product_id) AS sequence FROM totals),
b AS (SELECT *, row_number() OVER (ORDER BY v DESC, product_id) AS sequence FROM totals)
SELECT a.product_id AS topquantityid, a.product_name AS topquantityname, CAST(a.q AS BIGINT) AS topquantity,
  b.product_id AS toppriceid, b.product_name AS toppricename, CAST(b.v AS DOUBLE) AS topprice, sequence
FROM a LEFT JOIN b USING (sequence) WHERE sequence <= 10""",
        "repurchase_rate": _repurchase("printf('%.1f%%', 100.0 * repurchaseduser / purchaseduser)"),
        "repurchase_ratio": _repurchase(
            "CAST(CAST(CAST(repurchaseduser AS DOUBLE) / purchaseduser AS DECIMAL(10,4)) AS DOUBLE)"),
        "pivot_counts": f"WITH {_VALID_CITIES} SELECT " + ", ".join(
            f"count(*) FILTER (WHERE city = 'NATION_{i}') AS \"NATION_{i}\"" for i in range(NATIONS)) + " FROM cities",
        "running_total": _running(),
        "running_total_top": f"SELECT * FROM ({_running()}) ORDER BY consumptiontime LIMIT 5",
        "running_total_range": _running(
            "WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 09:59:59'"),
        "sliding_window": _sliding(),
        "sliding_window_range": _sliding("WHERE consumptiontime BETWEEN '2024-01-10 04' AND '2024-01-20 09'"),
        "prefix_sum": f"""WITH {_PREFIX} SELECT order_sn, CAST(order_money AS DOUBLE) AS order_money,
CAST(total AS DOUBLE) AS sum FROM sums""",
        "range_self_join": f"""WITH {_PREFIX}, offsets AS (SELECT * FROM range(20, 41) t(d)), lefts AS (
  SELECT order_sn AS l, order_sn + d AS r, order_money AS m, total AS s FROM sums, offsets)
SELECT l AS left_order_sn, CAST(m AS DOUBLE) AS left_order_money, CAST(s AS DOUBLE) AS left_total,
  order_sn AS right_order_sn, CAST(order_money AS DOUBLE) AS right_order_money, CAST(total AS DOUBLE) AS right_total
FROM lefts JOIN sums ON order_sn = r""",
        "max_avg_run": f"""WITH {_VALID}, bounds AS (SELECT min(order_sn) AS lo, max(order_sn) AS hi FROM valid),
dense AS (
  SELECT id, coalesce(order_money, 0) AS m FROM (SELECT unnest(range(lo, hi + 1)) AS id FROM bounds)
  LEFT JOIN valid ON order_sn = id),
sums AS (SELECT id, m, sum(m) OVER (ORDER BY id) AS s FROM dense),
runs AS (
  SELECT a.id AS first, b.id AS last, d + 1 AS n, CAST(100 * (b.s - a.s + a.m) AS HUGEINT) AS cents,
    CAST(b.s - a.s + a.m AS DOUBLE) / (d + 1) AS avg, cents * (219060189739591200 // (d + 1)) AS exact
  FROM sums a, range(20, 41) t(d), sums b WHERE b.id = a.id + d),
best AS (SELECT max(exact) AS top FROM runs),
winner AS (SELECT * FROM runs, best WHERE exact = top ORDER BY first, last LIMIT 1),
-- A run from first to last has the best average c/n where n P(last) - c last equals n P(first - 1) - c (first - 1).
prefix AS (SELECT id, CAST(100 * s AS HUGEINT) AS p FROM sums UNION ALL SELECT lo - 1, 0 FROM bounds),
level AS (SELECT id, n * p - cents * id AS v FROM prefix, winner)
SELECT 1 AS seq_index, avg AS avg_order_price, first || '-' || last AS id_range,
  (SELECT count(*) FROM level x JOIN level y ON x.v = y.v AND y.id - x.id > 20) AS matchnum
FROM winner""",
        "item_overlap": _overlap(keep_self=False),
        "item_overlap_with_self": _overlap(keep_self=True),
        "consecutive_day_users": f"""WITH {_ORDERS}, days AS (
  SELECT customer_id, CAST(create_time AS DATE) AS d, sum(order_money) AS s, count(*) AS n FROM orders_m GROUP BY 1, 2)
SELECT b.customer_id AS userid, c_name AS username, strftime(a.d, '%Y%m%d') || '_' || strftime(b.d, '%Y%m%d') AS day,
  CAST(a.s + b.s AS DOUBLE) AS totalconsumption, a.n + b.n AS totalorder
FROM days a JOIN days b ON a.customer_id = b.customer_id AND b.d = a.d + 1
JOIN customer ON c_custkey = b.customer_id""",
        "order_amount_diff": f"""WITH {_ORDERS}, {_LINES}, sums AS (
  SELECT order_sn, sum(product_price) AS s FROM lines GROUP BY order_sn)
SELECT order_sn AS order_id, CAST(order_money - coalesce(s, 0) AS DOUBLE) AS diff_value
FROM orders_m LEFT JOIN sums USING (order_sn)""",
        "top_k": f"WITH {_VALID}, days AS ({_user_day('valid')}) SELECT * FROM days "
        "ORDER BY customer_id, total_amount DESC, year, month, day LIMIT 5",
        "city_month_top": f"WITH {_VALID_CITIES}, m AS ({_CITY_MONTH.format('cities')}) "
        "SELECT * REPLACE (CAST(trunc(total_amount) AS BIGINT) AS total_amount) FROM "
        "(SELECT * FROM m ORDER BY total_count DESC, total_amount DESC, city_name, year, month LIMIT 5)",
        "region_rollup_top": f"WITH {_PLACED}, m AS ({_ROLLUP}) "
        "SELECT * REPLACE (CAST(trunc(total_amount) AS BIGINT) AS total_amount) FROM "
        "(SELECT * FROM m ORDER BY total_count DESC, total_amount DESC, province_id DESC, year, month LIMIT 5)",
        "write_partitioned": f"WITH {_ORDERS} SELECT {_ORDER_COLUMNS}, CAST(year(create_time) AS INTEGER) AS year FROM orders_m",
        "append_partition": f"""WITH {_ORDERS} SELECT {_ORDER_COLUMNS},
CASE WHEN create_time < TIMESTAMP '{SPLIT}' THEN '20240130' ELSE '{RUN_DAY}' END AS etl_date FROM orders_m""",
        "precombine_write": _UPSERTED,
        "keyed_upsert": _UPSERTED,
        "stream_upsert": _UPSERTED,
        "dynamic_overwrite": f"""WITH {_VALID}, {_cities('orders_m')},
recent AS (SELECT * FROM cities WHERE order_status <> 'P' AND create_time >= TIMESTAMP '{SPLIT}'),
before AS ({_CITY_MONTH.format('cities')}), after AS ({_CITY_MONTH.format('recent')})
SELECT * FROM before WHERE (year, month) NOT IN (SELECT (year, month) FROM after)
UNION ALL SELECT * FROM after""",
        "layer_bootstrap": f"{_CUSTOMERS}, {_STAMPS}, '{RUN_DAY}' AS etl_date FROM customer",
        "repair_partitions": f"WITH {_ORDERS} SELECT {_ORDER_COLUMNS} FROM orders_m",
        "layer_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}"
            for t in ("orders", "lineitem", "customer", "part", "nation", "region")),
        "warehouse_e2e": f"WITH {_VALID} {_user_day('valid')}",
        "stream_sliding": f"""WITH {_WINDOWS} SELECT strftime(e, '%Y-%m-%d %H') AS consumptiontime,
CAST(s AS DOUBLE) AS consumptionsum, CAST(n AS DOUBLE) AS consumptioncount
FROM windows WHERE e <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
        "stream_extract": f"SELECT * REPLACE ({_text('o_orderdate')} AS o_orderdate), '{RUN_DAY}' AS etl_date FROM orders",
    }
