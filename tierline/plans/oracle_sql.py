"""DuckDB SQL for the correctness check of every registered query.

Each query's oracle is plain SQL over the driver's tables (pre-registered
views ``customer orders lineitem part supplier nation events``): the
retail extracts as CTEs, silver as the closed form of the two MERGE
statements (expire and insert as plain equi-joins on the key), gold as the
reference's mart SQL with exact money sums. Nothing here is executed by
the library; it is the independent statement of what each query returns.
"""

from __future__ import annotations

from tierline.functions.time import RUN_ID_FORMAT
from tierline.schemas import IS_QUARANTINED, REGISTRY, SCD2, TableSpec
from tierline.sources import retail as R

TS1 = R.AS_OF_1.strftime("%Y-%m-%d %H:%M:%S")
TS2 = R.AS_OF_2.strftime("%Y-%m-%d %H:%M:%S")
GOLD_DATE = R.GOLD_AS_OF.isoformat()
CUT = R.ORDER_CUTOFF.strftime("%Y-%m-%d %H:%M:%S")
RCUT = R.REVIEW_CUTOFF.strftime("%Y-%m-%d %H:%M:%S")


def _alt(key: str, batch: int) -> str:
    return f"({key} % {R.ALTER_MOD} = 0)" if batch == 2 else "FALSE"


def _nul(key: str, batch: int) -> str:
    return f"({key} % {R.NULL_MOD} = 0)" if batch == 2 else "FALSE"


def _ms(col: str) -> str:
    # floor to the millisecond, as Spark's unix_millis does
    return f"CAST(epoch_us({col}) // 1000 AS VARCHAR)"


def batch_sql(table: str, b: int) -> str:
    e1, e2 = R.EPOCH_1, R.EPOCH_2
    if table == "customers":
        a, n = _alt("c_custkey", b), _nul("c_custkey", b)
        return f"""SELECT CASE WHEN c_custkey % {R.NULL_CUSTOMER_KEY_MOD} = 0 THEN NULL ELSE c_custkey END AS customer_id,
  CASE WHEN {a} THEN c_name || ' (renamed)' ELSE c_name END AS name,
  CASE WHEN c_custkey % {R.NULL_EMAIL_MOD} = 0 OR {n} THEN NULL
       ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@' || lower(c_mktsegment) || '.example.com' END AS email,
  CASE WHEN {a} THEN '{e2}' ELSE '{e1}' END AS updated_at
FROM customer"""
    if table == "orders":
        a, n = _alt("o_orderkey", b), _nul("o_orderkey", b)
        where = f"WHERE o_orderdate < TIMESTAMP '{CUT}'" if b == 1 else ""
        return f"""SELECT o_orderkey AS order_id,
  CASE WHEN {n} THEN NULL ELSE o_custkey END AS customer_id,
  {_ms('o_orderdate')} AS order_date,
  CASE WHEN {a} THEN o_totalprice + CAST(10.0 AS DOUBLE) ELSE o_totalprice END AS total_amount,
  CASE WHEN {a} THEN '{e2}' ELSE {_ms('o_orderdate')} END AS updated_at
FROM orders {where}"""
    if table == "order_items":
        a, n = _alt("l_orderkey", b), _nul("l_orderkey", b)
        where = f"WHERE l_shipdate < TIMESTAMP '{CUT}'" if b == 1 else ""
        return f"""SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
    CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
    CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR), strftime(l_shipdate, '%Y%m%d')) AS order_item_id,
  l_orderkey AS order_id, l_partkey AS product_id,
  CASE WHEN {a} THEN CAST(l_quantity AS BIGINT) + 1 ELSE CAST(l_quantity AS BIGINT) END AS quantity,
  CASE WHEN {n} THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN {a} THEN '{e2}' ELSE {_ms('l_shipdate')} END AS updated_at
FROM lineitem {where}"""
    if table == "products":
        return f"""SELECT p_partkey AS product_id, p_name AS name,
  CASE WHEN p_partkey % {R.NULL_CATEGORY_MOD} = 0 THEN NULL
       ELSE CAST(replace(p_brand, 'Brand#', '') AS BIGINT) END AS category_id,
  p_retailprice AS price, '{e1}' AS updated_at
FROM part"""
    if table == "categories":
        return f"""SELECT category_id,
  CASE WHEN category_id % {R.NULL_CATEGORY_NAME_MOD} = 0 THEN NULL
       ELSE 'Category ' || CAST(category_id AS VARCHAR) END AS name,
  '{e1}' AS updated_at
FROM (SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS category_id FROM part) ids"""
    if table == "suppliers":
        return f"""SELECT s_suppkey AS supplier_id,
  CASE WHEN s_suppkey % {R.NULL_SUPPLIER_NAME_MOD} = 0 THEN NULL ELSE s_name END AS supplier_name,
  'Contact ' || CAST(s_suppkey AS VARCHAR) AS contact_name, CAST(NULL AS VARCHAR) AS phone,
  's' || CAST(s_suppkey AS VARCHAR) || '@supplier.example.com' AS email,
  CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS city, n_name AS country,
  '{e1}' AS created_at
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""
    if table == "product_suppliers":
        n = _nul("l_partkey", b)
        where = f"WHERE l_shipdate < TIMESTAMP '{CUT}'" if b == 1 else ""
        return f"""SELECT l_suppkey AS supplier_id, l_partkey AS product_id,
  CASE WHEN {n} THEN NULL ELSE min(l_extendedprice / l_quantity) END AS supply_price,
  {_ms('max(l_shipdate)')} AS last_updated
FROM lineitem {where}
GROUP BY l_suppkey, l_partkey"""
    if table == "customer_reviews":
        a, n = _alt("event_id", b), _nul("event_id", b)
        extra = f"AND ts < TIMESTAMP '{RCUT}'" if b == 1 else ""
        return f"""SELECT CAST(event_id AS VARCHAR) AS id, user_id AS customer_id,
  event_id % (SELECT count(*) FROM part) AS product_id,
  1 + (CASE WHEN {a} THEN event_id // 7 + 1 ELSE event_id // 7 END) % 5 AS rating,
  CASE WHEN event_id % {R.NULL_REVIEW_TEXT_MOD} = 0 OR {n} THEN NULL ELSE event_type END AS review_text,
  {_ms('ts')} AS review_date
FROM events WHERE true {extra}"""
    raise KeyError(table)


def _payload(spec: TableSpec) -> list[str]:
    cols = list(spec.columns)
    if spec.has_quarantine:
        cols.append(IS_QUARANTINED)
    return cols


def _prepared(spec: TableSpec, cte: str) -> str:
    cols = ", ".join(spec.columns)
    q = ""
    if spec.has_quarantine:
        q = ", (" + " OR ".join(f"{c} IS NULL" for c in spec.quarantine_if_null) + f") AS {IS_QUARANTINED}"
    distinct = "DISTINCT " if spec.dedup else ""
    return f"SELECT {distinct}{cols}{q} FROM {cte}"


def silver_ctes(table: str) -> list[tuple[str, str]]:
    """CTEs ending in ``{table}_silver``: the table after run 1 and run 2."""
    spec = REGISTRY[table]
    t = table
    if spec.silver_policy != SCD2:
        return [(f"{t}_b2", batch_sql(t, 2)), (f"{t}_silver", _prepared(spec, f"{t}_b2"))]
    pay = _payload(spec)
    cols = ", ".join(pay)
    scols = ", ".join(f"s.{c}" for c in pay)
    keyeq = " AND ".join(f"s.{k} = a.{k}" for k in spec.keys)
    chg = " OR ".join(f"a.{c} <> s.{c}" for c in spec.tracked)
    # live versions by number, so that the changed ones are found by one join on the key
    same_key = " AND ".join(f"s.{k} = k.{k}" for k in spec.keys)
    return [
        (f"{t}_b1", batch_sql(t, 1)),
        (f"{t}_s1", _prepared(spec, f"{t}_b1")),
        (f"{t}_v1", f"SELECT {cols}, TIMESTAMP '{TS1}' AS effective_start_date, "
                    f"TIMESTAMP '{TS1}' AS effective_end_date, TRUE AS is_active FROM {t}_s1"),
        (f"{t}_b2", batch_sql(t, 2)),
        (f"{t}_s2", _prepared(spec, f"{t}_b2")),
        (f"{t}_act", f"SELECT *, row_number() OVER () AS rn FROM {t}_v1 WHERE is_active = TRUE"),
        (f"{t}_hit", f"SELECT DISTINCT a.rn FROM {t}_act a JOIN {t}_s2 s ON {keyeq} WHERE {chg}"),
        (f"{t}_now", f"SELECT a.*, h.rn IS NOT NULL AS hit FROM {t}_act a LEFT JOIN {t}_hit h ON a.rn = h.rn"),
        (f"{t}_keptkeys", f"SELECT DISTINCT {', '.join(spec.keys)}, TRUE AS held FROM {t}_now WHERE NOT hit"),
        (f"{t}_silver", f"""SELECT {cols}, effective_start_date, effective_end_date, is_active
  FROM {t}_v1 WHERE NOT coalesce(is_active = TRUE, FALSE)
UNION ALL
SELECT {cols}, effective_start_date, CASE WHEN hit THEN TIMESTAMP '{TS2}' ELSE effective_end_date END, NOT hit FROM {t}_now
UNION ALL
SELECT {scols}, TIMESTAMP '{TS2}', TIMESTAMP '{TS2}', TRUE FROM {t}_s2 s
  LEFT JOIN {t}_keptkeys k ON {same_key} WHERE k.held IS NULL"""),
    ]


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    seen, parts = set(), []
    for name, sql in ctes:
        if name not in seen:
            seen.add(name)
            parts.append(f"{name} AS (\n{sql}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + body


def silver_query(table: str) -> str:
    spec = REGISTRY[table]
    names = spec.silver_schema().names
    fmt = {"effective_start_date", "effective_end_date"}
    sel = ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" if c in fmt else c for c in names)
    return with_ctes(silver_ctes(table), f"SELECT {sel} FROM {table}_silver")


def _gold(tables: list[str], body: str) -> str:
    ctes = []
    for t in tables:
        ctes += silver_ctes(t)
    return with_ctes(ctes, body)


_V = "CAST(oi.price AS DECIMAL(12,2)) * oi.quantity"


def gold_query(name: str) -> str:
    if name == "sales_summary":
        return _gold(["orders", "order_items", "products", "categories"], f"""SELECT
  o.order_date, p.category_id, c.name AS category_name, oi.product_id, p.name AS product_name,
  CAST(SUM(oi.quantity) AS BIGINT) AS total_units_sold,
  CAST(SUM({_V}) AS DOUBLE) AS total_sales,
  COUNT(DISTINCT o.customer_id) AS unique_customers
FROM orders_silver o
JOIN order_items_silver oi ON o.order_id = oi.order_id
JOIN products_silver p ON oi.product_id = p.product_id
JOIN categories_silver c ON p.category_id = c.category_id
WHERE o.is_active = TRUE
GROUP BY 1, 2, 3, 4, 5""")
    if name == "customer_engagement":
        return _gold(["customers", "orders", "order_items"], f"""SELECT
  c.customer_id, c.name AS customer_name,
  COUNT(o.order_id) AS total_orders,
  CAST(SUM({_V}) AS DOUBLE) AS total_spent,
  MAX(o.order_date) AS last_order_date,
  CAST(date_diff('day', CAST(epoch_ms(CAST(o.order_date AS BIGINT)) AS DATE), DATE '{GOLD_DATE}') AS BIGINT)
    AS days_since_last_order,
  CAST(SUM({_V}) AS DOUBLE) / NULLIF(COUNT({_V}), 0) AS avg_order_value
FROM customers_silver c
LEFT JOIN orders_silver o ON c.customer_id = o.customer_id
LEFT JOIN order_items_silver oi ON o.order_id = oi.order_id
WHERE c.is_active = TRUE
GROUP BY 1, 2, 6""")
    if name in ("product_performance", "product_performance_naive"):
        return _gold(["products", "categories", "product_suppliers", "suppliers", "order_items",
                      "customer_reviews"], f"""SELECT
  p.product_id, p.name AS product_name, p.category_id, c.name AS category_name,
  ps.supplier_id, s.supplier_name,
  CAST(SUM(oi.quantity) AS BIGINT) AS total_units_sold,
  CAST(SUM({_V}) AS DOUBLE) AS total_revenue,
  CAST(SUM(cr.rating) AS DOUBLE) / NULLIF(COUNT(cr.rating), 0) AS avg_rating,
  COUNT(cr.review_text) AS total_reviews
FROM products_silver p
LEFT JOIN categories_silver c ON p.category_id = c.category_id
LEFT JOIN product_suppliers_silver ps ON p.product_id = ps.product_id
LEFT JOIN suppliers_silver s ON ps.supplier_id = s.supplier_id
LEFT JOIN order_items_silver oi ON p.product_id = oi.product_id
LEFT JOIN customer_reviews_silver cr ON p.product_id = cr.product_id
WHERE p.is_quarantined = FALSE
GROUP BY 1, 2, 3, 4, 5, 6""")
    if name in ("supplier_analysis", "supplier_analysis_naive"):
        return _gold(["suppliers", "product_suppliers", "order_items"], f"""SELECT
  s.supplier_id, s.supplier_name,
  COUNT(DISTINCT ps.product_id) AS total_products_supplied,
  CAST(SUM(oi.quantity) AS BIGINT) AS total_units_sold,
  CAST(SUM({_V}) AS DOUBLE) AS total_revenue
FROM suppliers_silver s
LEFT JOIN product_suppliers_silver ps ON s.supplier_id = ps.supplier_id
LEFT JOIN order_items_silver oi ON ps.product_id = oi.product_id
WHERE s.is_quarantined = FALSE
GROUP BY 1, 2""")
    if name == "customer_reviews_summary":
        return _gold(["products", "customer_reviews"], """SELECT
  p.product_id, p.name AS product_name,
  CAST(SUM(cr.rating) AS DOUBLE) / NULLIF(COUNT(cr.rating), 0) AS avg_rating,
  COUNT(cr.review_text) AS total_reviews,
  COUNT(CASE WHEN cr.rating >= 4 THEN 1 END) AS positive_reviews,
  COUNT(CASE WHEN cr.rating < 3 THEN 1 END) AS negative_reviews
FROM products_silver p
LEFT JOIN customer_reviews_silver cr ON p.product_id = cr.product_id
WHERE p.is_quarantined = FALSE
GROUP BY 1, 2""")
    raise KeyError(name)


# --------------------------------------------------------------------------- ingest side

def epoch_ms(value) -> int:
    return int(value.timestamp() * 1000)


def bronze_query(table: str, batch: int = 2) -> str:
    return batch_sql(table, batch)


def daily_landing_query(table: str, days: list[tuple[int, object]]) -> str:
    """Each day's batch of ``table`` with that day as ``landing_date``."""
    return "\nUNION ALL\n".join(f"SELECT *, DATE '{day.isoformat()}' AS landing_date FROM (\n{batch_sql(table, b)}\n) d{b}"
                                 for b, day in days)


def extract_query(table: str, wm: str, mark, keyset: tuple[str, object] | None = None) -> str:
    m = epoch_ms(mark)
    cond = f"CAST({wm} AS BIGINT) > {m}"
    if keyset:
        cond = f"({cond} OR (CAST({wm} AS BIGINT) = {m} AND {keyset[0]} > {keyset[1]}))"
    return f"SELECT * FROM (\n{batch_sql(table, 2)}\n) b WHERE {cond}"


def _ms_to_text(expr: str) -> str:
    return f"strftime(make_timestamp(({expr}) * 1000), '%Y-%m-%d %H:%M:%S')"


def pages_query(table: str, wm: str, ident: str, page_rows: int, days) -> str:
    """Pages of two days' extracts by (wm, ident), the second behind the last row of the first."""
    loads = [f"SELECT CAST({wm} AS BIGINT) AS wm, {ident} AS id FROM (\n{batch_sql(table, n)}\n) b{n} WHERE {wm} IS NOT NULL" for n in (1, 2)]
    runs = [now.strftime(RUN_ID_FORMAT) for now in days]
    return f"""WITH d1 AS ({loads[0]}), d2 AS ({loads[1]}),
last AS (SELECT wm, id FROM d1 ORDER BY wm DESC, id DESC LIMIT 1),
extracts AS (
  SELECT '{runs[0]}' AS run, wm, id FROM d1
  UNION ALL
  SELECT '{runs[1]}', d2.wm, d2.id FROM d2, last WHERE d2.wm > last.wm OR (d2.wm = last.wm AND d2.id > last.id)),
placed AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY run ORDER BY wm, id) - 1) // {page_rows} + 1 AS page FROM extracts)
SELECT run || 'P' || lpad(CAST(page AS VARCHAR), 8, '0') AS run_id, COUNT(*) AS rows_loaded, {_ms_to_text('MAX(wm)')} AS watermark,
  arg_max(id, (wm, id)) AS last_id, COUNT(*) AS n_landed, MIN(id) AS least_id, CAST(SUM(id) AS BIGINT) AS sum_ids
FROM placed GROUP BY run, page"""


def distinct_query() -> str:
    return f"""SELECT strftime(make_timestamp(CAST(order_date AS BIGINT) * 1000), '%Y-%m') AS month,
  COUNT(DISTINCT customer_id) AS n_customers, TRUE AS within
FROM ({batch_sql('orders', 1)} UNION ALL {batch_sql('orders', 2)}) loads
GROUP BY 1"""


def batch_stats_query(tables: list[str]) -> str:
    parts = []
    for t in tables:
        wm = REGISTRY[t].watermark_col
        parts.append(f"SELECT '{t}' AS table_name, count(*) AS rows_loaded, "
                     f"{_ms_to_text(f'max(CAST({wm} AS BIGINT))')} AS max_watermark "
                     f"FROM (\n{batch_sql(t, 2)}\n) b_{t}")
    return "\nUNION ALL\n".join(parts)


def latest_watermark_query(incremental: list[str], full: list[str], default: str) -> str:
    ctes, rows = [], []
    for t in incremental:
        wm = f"CAST({REGISTRY[t].watermark_col} AS BIGINT)"
        ctes += [(f"{t}_b1", batch_sql(t, 1)), (f"{t}_b2", batch_sql(t, 2))]
        rows.append(f"SELECT '{t}' AS table_name, (SELECT max({wm}) FROM {t}_b1) AS wm")
        rows.append(f"SELECT '{t}' AS table_name, (SELECT max({wm}) FROM {t}_b2 "
                    f"WHERE {wm} > (SELECT max({wm}) FROM {t}_b1)) AS wm")
    for t in full:
        rows += [f"SELECT '{t}' AS table_name, CAST(NULL AS BIGINT) AS wm"] * 2
    ctes.append(("audit", "\nUNION ALL\n".join(rows)))
    body = (f"SELECT table_name, strftime(coalesce(make_timestamp(max(wm) * 1000), "
            f"TIMESTAMP '{default}'), '%Y-%m-%d %H:%M:%S') AS latest_watermark "
            f"FROM audit GROUP BY table_name")
    return with_ctes(ctes, body)


def audit_query(incremental: list[str], full: list[str], days: list) -> str:
    ctes, rows = [], []
    for t in incremental + full:
        ctes += [(f"{t}_b1", batch_sql(t, 1)), (f"{t}_b2", batch_sql(t, 2))]
        wm = f"CAST({REGISTRY[t].watermark_col} AS BIGINT)" if t in incremental else "CAST(NULL AS BIGINT)"
        later = [f"WHERE {wm} IS NOT NULL", f"WHERE {wm} > (SELECT max({wm}) FROM {t}_b1)"] if t in incremental else ["", ""]
        rows += [f"SELECT '{now:%Y%m%dT%H%M%SZ}' AS run_id, '{now:%Y-%m-%d}' AS load_date, '{t}' AS table_name, "
                 f"'{'incremental' if t in incremental else 'full'}' AS load_type, count(*) AS rows_loaded, "
                 f"strftime(make_timestamp(max({wm}) * 1000), '%Y-%m-%d %H:%M:%S') AS watermark FROM {t}_b{n} {later[n - 1]}"
                 for n, now in enumerate(days, 1)]
    return with_ctes(ctes, "\nUNION ALL\n".join(rows))


def config_query(incremental: list[str], full: list[str], failing: list[str], days: list) -> str:
    """Status, log and landed rows of two ingests; the first run of orders is in the archive."""
    ctes, rows = [], []
    for t in incremental + full:
        ctes += [(f"{t}_b1", batch_sql(t, 1)), (f"{t}_b2", batch_sql(t, 2))]
    for n, now in enumerate(days, 1):
        day = f"'{now:%Y-%m-%d}' AS run"
        for t in incremental + full + failing:
            load, ok = "incremental" if t in incremental else "full", t not in failing
            wm = f"CAST({REGISTRY[t].watermark_col} AS BIGINT)"
            later = f" WHERE {wm} > (SELECT max({wm}) FROM {t}_b1)" if t in incremental and n == 2 else ""
            count = f"(SELECT count(*) FROM {t}_b{n}{later})" if ok else "0"
            rows.append(f"SELECT 'status' AS kind, {day}, '{t}' AS table_name, '{load}' AS load_type, {count} AS n_rows, '{'SUCCESS' if ok else 'FAILED'}' AS state")
            rows += [f"SELECT '{kind}', {day}, '{t}', NULL, NULL, '{'INFO' if ok else 'ERROR'}'" for kind in ("log", "log_file")]
            if ok:
                kind = "archived" if t == "orders" and n == 1 else "landed"
                rows.append(f"SELECT * FROM (SELECT '{kind}', {day}, '{t}', NULL, {count} AS n_rows, NULL) WHERE n_rows > 0")
    return with_ctes(ctes, "\nUNION ALL\n".join(rows))


def quarantine_report_query(tables: list[str]) -> str:
    ctes = []
    for t in tables:
        ctes += silver_ctes(t)
    body = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS total_rows, "
        f"count(CASE WHEN is_quarantined THEN 1 END) AS quarantined_rows FROM {t}_silver"
        for t in tables)
    return with_ctes(ctes, body)
