"""The SQL, in DuckDB's dialect, that each registered query must equal."""

from __future__ import annotations

from daytally.functions.picks import DIGITS
from daytally.operators.dimensions import BUCKET_DIGITS
from daytally.operators.generator import DAYS, DISCOUNTS, FIRST_DAY, MAX_PER_DAY, MAX_QUANTITY, SECONDS_PER_DAY
from daytally.plans.batch import REPORT_DATE, SEED

_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_PRICE = "l_extendedprice / l_quantity / (1 - l_discount)"

# Sales records with every field.
RECORDS = f"""
SELECT {_LINE_ID} AS ts_id,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ts,
       CAST(l_shipdate AS DATE) AS ts_date,
       CAST(o_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
       r_name AS country, n_name AS city,
       p_type AS category, p_brand AS sub_category, p_name AS product_name,
       l_extendedprice AS sales, {_PRICE} AS price,
       CAST(l_quantity AS INTEGER) AS quantity, l_discount AS discount,
       {_PRICE} * CAST(l_quantity AS INTEGER) AS revenue,
       {_PRICE} * CAST(l_quantity AS INTEGER) * (1 - l_discount) AS profit,
       CAST(n_nationkey * 5 - 60 AS DOUBLE) AS latitude,
       CAST(n_nationkey * 13 - 160 AS DOUBLE) AS longitude,
       l_linenumber AS version
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN part ON l_partkey = p_partkey
"""

# Events as decoded from their messages: 32-bit money, coordinates as text.
EVENTS = """
SELECT CAST(event_id AS VARCHAR) AS ts_id,
       date_trunc('second', ts) AS ts,
       CAST(ts AS DATE) AS ts_date,
       CAST(user_id AS VARCHAR) AS customer_id,
       'User#' || user_id AS customer_name,
       'S' || (user_id % 3) AS segment,
       'C' || (user_id % 25 % 5) AS country,
       'T' || (user_id % 25) AS city,
       event_type AS category,
       'k' || (CAST(json_extract(props, '$.k') AS INTEGER) % 5) AS sub_category,
       'p' || CAST(json_extract(props, '$.k') AS INTEGER) AS product_name,
       CAST(CAST(value AS FLOAT) AS DOUBLE) AS price,
       CAST(json_extract(props, '$.k') AS INTEGER) AS quantity,
       CAST(CAST(value AS FLOAT) AS DOUBLE) AS revenue,
       CAST(CAST(value * (1 - CAST(0.1 AS DOUBLE)) AS FLOAT) AS DOUBLE) AS profit,
       CAST(user_id % 25 * 5 - 60 AS DOUBLE) AS latitude,
       CAST(user_id % 25 * 13 - 160 AS DOUBLE) AS longitude,
       value
FROM events
"""

_REASON = """
CASE WHEN category IN ('error', 'signup') THEN 'malformed'
     WHEN category = 'view' AND value < 5 THEN 'empty'
     WHEN category = 'click' THEN 'incomplete'
     ELSE 'good' END
"""

_SUMS = "round(sum(revenue), 2) AS daily_rev, round(sum(profit), 2) AS daily_profit"
_USERS = "CAST(count(DISTINCT customer_id) AS BIGINT) AS daily_pu"
_QUANTITY = "CAST(sum(quantity) AS BIGINT) AS daily_quantity"
_PRODUCT_KEYS = "ts_date, category, sub_category, product_name"
_PLACE_KEYS = "ts_date, latitude, longitude"


def _r(select: str) -> str:
    return f"WITH r AS ({RECORDS}) {select}"


def _e(select: str) -> str:
    return f"WITH e AS ({EVENTS}) {select}"


def _draw(label: str, *ids: str) -> str:
    text = " || '|' || ".join([f"'{SEED}'", f"'{label}'", *[f"CAST({i} AS VARCHAR)" for i in ids]])
    return f"CAST('0x' || substr(md5({text}), 1, {DIGITS}) AS BIGINT)"


def _synthetic(limit: str) -> str:
    total = sum(weight for _, weight in DISCOUNTS)
    upper, branches = 0, []
    for value, weight in DISCOUNTS:
        upper += weight
        branches.append(f"WHEN {_draw('discount', 'day', 'n')} % {total} < {upper} THEN CAST({value} AS DOUBLE)")
    return f"""
WITH r AS ({RECORDS}),
customers AS (
  SELECT row_number() OVER (
           ORDER BY substr(md5(concat_ws('|', customer_id, customer_name, segment, country, city)),
                           1, {BUCKET_DIGITS}),
                    customer_id, customer_name, segment, country, city) - 1 AS idx, *
  FROM (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
               c_mktsegment AS segment, r_name AS country, n_name AS city
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey)),
products AS (
  SELECT row_number() OVER (
           ORDER BY substr(md5(concat_ws('|', category, sub_category, product_name,
                                         CAST(CAST(floor(price * 1000000) AS BIGINT) AS VARCHAR))),
                           1, {BUCKET_DIGITS}),
                    category, sub_category, product_name, price) - 1 AS idx, *
  FROM (SELECT DISTINCT category, sub_category, product_name, price FROM r)),
days AS (
  SELECT CAST(DATE '{FIRST_DAY}' + CAST(i AS INTEGER) AS DATE) AS day FROM range({DAYS}) t(i)),
sizes AS (SELECT day, 1 + {_draw('size', 'day')} % ({limit}) AS size FROM days),
wanted AS (SELECT day, unnest(range(size)) AS n FROM sizes),
picked AS (
  SELECT md5('{SEED}|id|' || day || '|' || n) AS ts_id,
         strftime(CAST(day AS TIMESTAMP) + to_seconds({_draw('second', 'day', 'n')} % {SECONDS_PER_DAY}),
                  '%Y-%m-%d %H:%M:%S') AS ts,
         day AS ts_date,
         {_draw('customer', 'day', 'n')} % (SELECT count(*) FROM customers) AS customer_idx,
         {_draw('product', 'day', 'n')} % (SELECT count(*) FROM products) AS product_idx,
         CAST(1 + {_draw('quantity', 'day', 'n')} % {MAX_QUANTITY} AS INTEGER) AS quantity,
         CASE {' '.join(branches)} END AS discount
  FROM wanted)
SELECT ts_id, ts, ts_date, customer_id, customer_name, segment, customers.country, customers.city,
       category, sub_category, product_name, price, quantity, discount,
       price * quantity AS revenue, price * quantity * (1 - discount) AS profit,
       CAST(n_nationkey * 5 - 60 AS DOUBLE) AS latitude, CAST(n_nationkey * 13 - 160 AS DOUBLE) AS longitude
FROM picked
JOIN customers ON customer_idx = customers.idx
JOIN products ON product_idx = products.idx
JOIN region ON r_name = customers.country
JOIN nation ON n_name = customers.city AND n_regionkey = r_regionkey
"""


_READABLE = (
    "ts_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, ts_date, customer_id, customer_name, segment, "
    "country, city, category, sub_category, product_name, price, quantity, revenue, profit, "
    "CAST(latitude AS VARCHAR) AS latitude, CAST(longitude AS VARCHAR) AS longitude"
)

def _stacked(pu: str, product: str, address: str) -> str:
    return (
        f"SELECT 'daily_pu_rev' AS report, {pu} UNION ALL BY NAME "
        f"SELECT 'daily_category_product' AS report, {product} UNION ALL BY NAME "
        f"SELECT 'daily_address' AS report, {address}"
    )


def oracle_sql() -> dict[str, str]:
    sent_again = _e(
        f"SELECT * REPLACE (CAST(CAST(value + 1 AS FLOAT) AS DOUBLE) AS price, "
        "CAST(CAST(value + 1 AS FLOAT) AS DOUBLE) AS revenue, CAST(quantity + 1 AS INTEGER) AS quantity) "
        f"FROM (SELECT {_READABLE}, value FROM e)"
    ).replace("SELECT * REPLACE", "SELECT * EXCLUDE (value) REPLACE")
    days = _e(f"SELECT ts_date, {_SUMS}, TRUE AS pu_in_bound FROM e GROUP BY ts_date")
    products = f"{_PRODUCT_KEYS}, {_QUANTITY}, {_SUMS}"
    exact = _r(_stacked(
        f"ts_date, {_USERS}, {_SUMS} FROM r GROUP BY ts_date",
        f"{products} FROM r GROUP BY ALL",
        f"{_PLACE_KEYS}, {_USERS} FROM r GROUP BY ALL",
    ))
    text = lambda names: ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in names.split(", "))
    every_text = _r(_stacked(
        f"CAST(ts_date AS VARCHAR) AS ts_date, CAST(count(DISTINCT customer_id) AS VARCHAR) AS daily_pu, {_SUMS} FROM r GROUP BY r.ts_date",
        f"{text(_PRODUCT_KEYS)}, CAST(CAST(sum(quantity) AS BIGINT) AS VARCHAR) AS daily_quantity, {_SUMS} "
        "FROM r GROUP BY r.ts_date, r.category, r.sub_category, r.product_name",
        f"{text(_PLACE_KEYS)}, CAST(count(DISTINCT customer_id) AS VARCHAR) AS daily_pu "
        "FROM r GROUP BY r.ts_date, r.latitude, r.longitude",
    ))
    event_products = _e(f"SELECT {_PRODUCT_KEYS}, {_QUANTITY}, {_SUMS} FROM e GROUP BY ALL")
    reasons = _e(f"SELECT {_REASON} AS reason, CAST(count(*) AS BIGINT) AS n FROM e GROUP BY ALL")
    daily = _r(f"SELECT ts_date, {_USERS}, {_SUMS} FROM r GROUP BY ts_date")
    addresses = _r(f"SELECT {_PLACE_KEYS}, {_USERS} FROM r GROUP BY ALL")
    last_version = "CAST(max(version) AS BIGINT) AS version"
    return {
        "daily_pu_rev": daily,
        "daily_pu_rev_approx": _r(f"SELECT ts_date, {_USERS}, TRUE AS pu_in_bound FROM r GROUP BY ts_date"),
        "daily_category_product": _r(f"SELECT {_PRODUCT_KEYS}, {_QUANTITY}, {_SUMS} FROM r GROUP BY ALL"),
        "daily_address": addresses,
        "daily_address_approx": _r(f"SELECT {_PLACE_KEYS}, {_USERS}, TRUE AS pu_in_bound FROM r GROUP BY ALL"),
        "float32_sums": _r(
            "SELECT ts_date, round(sum(CAST(CAST(revenue AS FLOAT) AS DOUBLE)), 2) AS daily_rev "
            "FROM r GROUP BY ts_date"
        ),
        "revenue_on_date": _r(
            f"SELECT round(sum(revenue), 2) AS daily_rev FROM r WHERE ts_date = DATE '{REPORT_DATE}'"
        ),
        "rollup_consistency": _r(
            "SELECT ts_date, round(sum(revenue), 2) AS rev_a1, round(sum(revenue), 2) AS rev_a2, TRUE AS same "
            "FROM r GROUP BY ts_date"
        ),
        "list_price": f"SELECT {_LINE_ID} AS ts_id, {_PRICE} AS price FROM lineitem",
        "record_metrics": _r("SELECT ts_id, ts_date, revenue, profit FROM r"),
        "customer_dim": _r("SELECT DISTINCT customer_id, customer_name, segment, country, city FROM r"),
        "product_dim": _r("SELECT DISTINCT category, sub_category, product_name, price FROM r"),
        "geocode_records": _r("SELECT ts_id, latitude, longitude FROM r WHERE country <> 'EUROPE'"),
        "raw_upsert": """
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
            FROM lineitem
            QUALIFY row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1""",
        "decode_records": _e(f"SELECT {_READABLE} FROM e"),
        "encode_records": _r(
            "SELECT ts_id AS key, ts_id, ts, CAST(ts_date AS VARCHAR) AS ts_date, customer_id, customer_name, "
            "segment, country, city, category, sub_category, product_name, price, "
            "CAST(quantity AS VARCHAR) AS quantity, CAST(discount AS VARCHAR) AS discount, revenue, profit, "
            "latitude, longitude FROM r"
        ),
        "encode_changelog": exact,
        "quarantine": reasons,
        "good_records": _e(
            f"SELECT {_PRODUCT_KEYS}, {_QUANTITY}, {_SUMS} FROM e WHERE {_REASON} = 'good' GROUP BY ALL"
        ),
        "typed_reports": exact,
        "text_tables": every_text,
        "csv_scan": _r(
            "SELECT customer_id, customer_name, segment, country, city, category, sub_category, product_name, "
            "sales, quantity, discount FROM r"
        ),
        "daily_export": _r(
            "SELECT ts_id, ts, CAST(ts_date AS VARCHAR) AS ts_date, customer_id, customer_name, segment, country, city, "
            "category, sub_category, product_name, price, quantity, CAST(discount AS VARCHAR) AS discount, revenue, profit, "
            "latitude, longitude, ts_date AS day FROM r"
        ),
        "synth_records": _synthetic(str(MAX_PER_DAY)),
        "synth_records_scaled": _synthetic("SELECT count(*) FROM customers"),
        "upsert_daily_pu_rev": _r(f"SELECT ts_date, {_USERS}, {_SUMS}, {last_version} FROM r GROUP BY ts_date"),
        "upsert_daily_category_product": _r(
            f"SELECT {_PRODUCT_KEYS}, {_QUANTITY}, {_SUMS}, {last_version} FROM r GROUP BY ALL"
        ),
        "upsert_daily_address": _r(f"SELECT {_PLACE_KEYS}, {_USERS}, {last_version} FROM r GROUP BY ALL"),
        "stream_raw": sent_again,
        "raw_folded": sent_again,
        "sql_records_of_day": f"SELECT * FROM ({sent_again}) WHERE ts_date = DATE '2024-01-15'",
        "stream_daily_pu_rev": days,
        "stream_daily_category_product": event_products,
        "stream_daily_address": _e(f"SELECT DISTINCT {_PLACE_KEYS}, TRUE AS pu_in_bound FROM e"),
        "stream_late_rows": days,
        "stream_daily_final": _e(
            f"SELECT ts_date, {_SUMS}, TRUE AS pu_in_bound FROM e GROUP BY ts_date "
            "HAVING CAST(ts_date AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) FROM e) - INTERVAL 1 DAY"
        ),
        "stream_restart": days,
        "stream_fanout": _e(_stacked(
            f"ts_date, {_SUMS}, TRUE AS pu_in_bound FROM e GROUP BY ts_date",
            f"{products} FROM e GROUP BY ALL",
            f"{_PLACE_KEYS}, TRUE AS pu_in_bound FROM e GROUP BY ALL",
        )),
        "stream_quarantine": reasons,
        "changelog_latest": days,
        "changelog_compacted": event_products,
        "replay_idempotent": days,
        "users_rolled_up": _e(
            "SELECT DISTINCT 'week' AS span, CAST(CAST(date_trunc('week', ts_date) AS DATE) AS VARCHAR) AS period, TRUE AS pu_in_bound FROM e "
            "UNION ALL SELECT DISTINCT 'month', CAST(CAST(date_trunc('month', ts_date) AS DATE) AS VARCHAR), TRUE FROM e "
            "UNION ALL SELECT DISTINCT 'country', country, TRUE FROM e"
        ),
        "late_account": _e(
            "SELECT ts_date, count(*) AS sent, CASE WHEN ts_date >= DATE '2024-01-11' AND ts_date < DATE '2024-01-21' THEN count(*) ELSE 0 END AS late "
            "FROM e GROUP BY ts_date "
            "HAVING CAST(ts_date AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) FROM e) - INTERVAL 1 DAY"
        ),
        "publish_run": _e(f"SELECT ts_date, {_SUMS}, TRUE AS pu_in_bound, 0 AS lost FROM e GROUP BY ts_date"),
        "sql_daily_records": _e(f"SELECT {_READABLE} FROM e WHERE {_REASON} = 'good'"),
        "sql_quarantine": _e(
            f"SELECT {_REASON} AS reason, CAST(count(*) AS BIGINT) AS n FROM e WHERE {_REASON} <> 'good' GROUP BY ALL"
        ),
    }
