"""For every SQL-expressible query of the catalogue, the same result as plain SQL over the sample tables.

The statements are written independently of the DataFrame code: joins instead of the shared aggregations, window
functions instead of merges, integer arithmetic instead of decimal division.
"""

from __future__ import annotations

from salesmart.plans.catalog import (
    BROKEN_DAYS,
    CARDS_AS_OF,
    CF_CUSTOMER,
    EDGE_AS_OF,
    EDGE_PREVIOUS,
    HISTORY_CUT,
    SEARCHED_DAYS,
    SEARCHED_PRODUCT,
    ITEM_IDS,
    RFM_AS_OF,
    RFM_PREVIOUS,
    RFM_STALE_BEFORE,
    SALES_DAY,
    STOCK_FROM,
    STOCK_TO,
    TREND_AS_OF,
    TREND_DAYS,
)

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"

_VIEWS = {
    "raw_sales": f"""
        SELECT CAST(event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS VARCHAR) AS sale_id,
               CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS customer_id,
               event_id % 10 + 1 AS store_id,
               CASE WHEN event_id % 19 = 0 THEN -1 ELSE {_K} END AS product_id,
               CAST(CASE WHEN event_id % 89 = 0 THEN -value ELSE value END AS DECIMAL(10,2)) AS amount,
               ts AS sale_date, event_id AS arrival_seq, event_type
        FROM events""",
    "products": """
        SELECT p_partkey AS product_id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS product_name,
               p_type AS category, CAST(p_retailprice AS DECIMAL(10,2)) AS price
        FROM part""",
    "inventory": """
        SELECT p_partkey AS product_id, CAST(p_partkey * 37 % 120 AS INT) AS stock_qty, 50 AS restock_threshold
        FROM part""",
    "inventory_alerts": f"""
        SELECT event_id AS alert_id, {_K} AS product_id, CAST({_K} * 37 % 120 AS INT) AS stock_qty, 50 AS threshold,
               ts AS alert_time, event_id % 3 <> 0 AS resolved
        FROM events WHERE event_type = 'error'""",
    "first_sales": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY sale_id ORDER BY arrival_seq) AS rn
            FROM raw_sales
            WHERE sale_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL AND amount IS NOT NULL)
        WHERE rn = 1""",
    "sales_enriched": """
        SELECT d.sale_id, d.customer_id, d.store_id, d.product_id, p.product_name, p.category, d.amount, d.sale_date,
               CAST(EXTRACT(HOUR FROM d.sale_date) AS INT) AS sale_hour, CAST(d.sale_date AS DATE) AS sale_date_only,
               d.event_type
        FROM first_sales d LEFT JOIN products p ON p.product_id = d.product_id
        WHERE d.amount > 0""",
    "order_sales": """
        SELECT CAST(o_orderkey AS VARCHAR) AS sale_id, o_custkey AS customer_id,
               CAST(o_totalprice AS DECIMAL(10,2)) AS amount, o_orderdate AS sale_date
        FROM orders""",
    "line_sales": """
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sale_id,
               o_custkey AS customer_id, l_suppkey AS store_id, l_partkey AS product_id,
               p_brand || ' ' || p_type AS product_name, p_type AS category,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, o_orderdate AS sale_date
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey""",
}


def _mean(total: str, count: str, scale: int, digits: int = 20) -> str:
    """Average rounded half away from zero in integers; ``total`` has two decimals."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    if scale <= 2:
        unit = 10 ** (2 - scale)
        den = f"({unit} * {count})"
    rounded = f"sign({cents}) * ((2 * abs({cents}) + {den}) // (2 * {den}))"
    return f"CAST(CAST({rounded} AS DECIMAL(30,0)) * CAST({10**-scale:.{scale}f} AS DECIMAL(3,{scale})) AS DECIMAL({digits},{scale}))"


def _auto_histogram(source: str, value: str) -> str:
    """Buckets of the smallest 1-2-5 width, in units of 0.0001, that covers the range in 30 steps."""
    widths = ", ".join(f"({digit}{'0' * power})" for power in range(17) for digit in (1, 2, 5))
    return f"""
        SELECT CAST(CAST(u - ((u % w) + w) % w AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS bucket,
               COUNT(*) AS "values"
        FROM (SELECT CAST({value} * 10000 AS BIGINT) AS u FROM {source}) v,
             (SELECT MIN(w) AS w FROM (SELECT CAST(w AS BIGINT) AS w FROM (VALUES {widths}) x(w)) y
              WHERE 30 * CAST(w AS HUGEINT) >= (SELECT CAST((MAX({value}) - MIN({value})) * 10000 AS BIGINT) FROM {source})) s
        GROUP BY 1"""


def _ratio(num: str, den: str) -> str:
    """Quotient of integers rounded half up to four decimals."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"CAST(CAST((20000 * {n} + {d}) // (2 * {d}) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(12,4))"


_MONEY = "CAST({} AS DECIMAL(20,2))"

_VIEWS["mart_sales"] = f"""
        SELECT store_id, COALESCE(category, 'Unknown') AS category, date_trunc('hour', sale_date) AS sale_hour,
               {_MONEY.format('SUM(amount)')} AS total_revenue, COUNT(*) AS order_count,
               {_mean('SUM(amount)', 'COUNT(*)', 2, 10)} AS avg_order_value
        FROM sales_enriched GROUP BY 1, 2, 3"""

_SEGMENT = """CASE WHEN recency_days <= 7 AND frequency >= 5 THEN 'Champions' WHEN recency_days <= 14 THEN 'Loyal'
                   WHEN recency_days <= 30 THEN 'At Risk' ELSE 'Lost' END"""


def _scored(base: str, as_of: str) -> str:
    return f"""
        SELECT customer_id, last_purchase, frequency, monetary, recency_days, {_SEGMENT} AS segment,
               CAST(TIMESTAMP '{as_of}' AS DATE) AS snapshot_date
        FROM (SELECT *, CAST(floor(epoch(TIMESTAMP '{as_of}' - last_purchase) / 86400) AS INT) AS recency_days
              FROM ({base}))"""


def _base(source: str, where: str) -> str:
    return f"""SELECT customer_id, MAX(sale_date) AS last_purchase, COUNT(*) AS frequency,
                      CAST(SUM(amount) AS DECIMAL(20,2)) AS monetary
               FROM {source} WHERE {where} GROUP BY customer_id"""


_VIEWS["rfm_previous"] = _scored(_base("order_sales", f"sale_date < TIMESTAMP '{RFM_PREVIOUS}'"), RFM_PREVIOUS)
_VIEWS["rfm_now"] = _scored(_base("order_sales", "true"), RFM_AS_OF)
_VIEWS["mart_account"] = """
        SELECT customer_id, segment, frequency, monetary, recency_days, snapshot_date
        FROM (SELECT * FROM rfm_previous UNION ALL SELECT * FROM rfm_now)"""
_VIEWS["sold"] = f"""
        SELECT product_id, COUNT(*) AS sold_qty FROM sales_enriched
        WHERE sale_date >= TIMESTAMP '{STOCK_FROM}' AND sale_date < TIMESTAMP '{STOCK_TO}' GROUP BY product_id"""
_VIEWS["mart_inventory"] = """
        SELECT product_id, product_name, category, stock_qty, restock_threshold,
               CASE WHEN stock_qty > restock_threshold THEN 'OK' WHEN stock_qty > 0 THEN 'LOW' ELSE 'CRITICAL' END AS status,
               (SELECT COUNT(*) FROM inventory_alerts a WHERE a.product_id = stocked.product_id AND NOT a.resolved)
                   AS alert_count
        FROM (SELECT * FROM inventory JOIN products USING (product_id)) stocked"""
_VIEWS["basket"] = "SELECT DISTINCT customer_id, product_name FROM line_sales WHERE product_name IS NOT NULL"
_VIEWS["items"] = "SELECT product_name, COUNT(*) AS customers FROM basket GROUP BY product_name"
_VIEWS["pairs"] = """
        SELECT a.product_name AS product_a, b.product_name AS product_b, COUNT(*) AS pair_customers
        FROM basket a JOIN basket b ON a.customer_id = b.customer_id AND a.product_name < b.product_name
        GROUP BY 1, 2
        HAVING COUNT(*) >= (SELECT greatest(10, CAST(ceil(COUNT(DISTINCT customer_id) / 100.0) AS BIGINT)) FROM line_sales)"""
_VIEWS["rules"] = f"""
        SELECT r.antecedent, r.consequent, {_ratio('r.pair_customers', 'n.n')} AS support,
               {_ratio('r.pair_customers', 'x.customers')} AS confidence,
               {_ratio('r.pair_customers * CAST(n.n AS HUGEINT)', 'x.customers * y.customers')} AS lift
        FROM (SELECT product_a AS antecedent, product_b AS consequent, pair_customers FROM pairs
              UNION ALL SELECT product_b, product_a, pair_customers FROM pairs) r
        JOIN items x ON x.product_name = r.antecedent JOIN items y ON y.product_name = r.consequent
        CROSS JOIN (SELECT COUNT(DISTINCT customer_id) AS n FROM basket) n
        WHERE 5 * r.pair_customers >= x.customers"""
_VIEWS["spend"] = """
        SELECT customer_id, product_id, CAST(SUM(amount) AS DECIMAL(20,2)) AS spend
        FROM sales_enriched GROUP BY customer_id, product_id"""
_VIEWS["top5"] = """
        SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY spend DESC, product_id) AS INT)
                       AS "rank" FROM spend) WHERE "rank" <= 5"""
_VIEWS["names"] = """
        SELECT product_id, product_name FROM (
            SELECT product_id, product_name,
                   row_number() OVER (PARTITION BY product_id ORDER BY customer_id, sale_date, sale_id) AS rn
            FROM sales_enriched) WHERE rn = 1"""
_VIEWS["spend_gram"] = """
        SELECT a.product_id AS i, b.product_id AS j, SUM(CAST(a.spend AS DOUBLE) * CAST(b.spend AS DOUBLE)) AS x
        FROM spend a JOIN spend b ON a.customer_id = b.customer_id GROUP BY 1, 2"""
_VIEWS["intervals"] = """
        SELECT s.product_id, s."at", s.n, i.stock_qty, i.restock_threshold,
               row_number() OVER (PARTITION BY s.product_id ORDER BY s."at") AS k
        FROM (SELECT product_id, time_bucket(INTERVAL 20 MINUTES, sale_date) + INTERVAL 20 MINUTES AS "at", COUNT(*) AS n
              FROM sales_enriched GROUP BY 1, 2) s JOIN inventory i ON i.product_id = s.product_id
        WHERE s."at" <= (SELECT MAX(sale_date) FROM sales_enriched) - INTERVAL 20 MINUTES"""
_DUE = "greatest({stock} - t.n, 0) <= {limit} AND ({last} IS NULL OR {last} <= t.\"at\" - INTERVAL 1 HOUR)"
_FIRST = _DUE.format(stock="t.stock_qty", limit="t.restock_threshold", last="CAST(NULL AS TIMESTAMP)")
_NEXT = _DUE.format(stock="r.stock_qty", limit="r.threshold", last="r.last_alert")
_VIEWS["stock_steps"] = f"""
        SELECT t.product_id, t.k, t."at", CAST(greatest(t.stock_qty - t.n, 0) AS INT) AS stock_qty,
               t.restock_threshold AS threshold, CASE WHEN {_FIRST} THEN t."at" END AS last_alert,
               CAST(CASE WHEN {_FIRST} THEN 1 ELSE 0 END AS BIGINT) AS alerts
        FROM intervals t WHERE t.k = 1
        UNION ALL
        SELECT t.product_id, t.k, t."at", CAST(greatest(r.stock_qty - t.n, 0) AS INT), r.threshold,
               CASE WHEN {_NEXT} THEN t."at" ELSE r.last_alert END,
               CAST(r.alerts + CASE WHEN {_NEXT} THEN 1 ELSE 0 END AS BIGINT)
        FROM stock_steps r JOIN intervals t ON t.product_id = r.product_id AND t.k = r.k + 1"""
_VIEWS["factor_0"] = "SELECT DISTINCT product_id, CAST(1 AS DOUBLE) AS v FROM spend"
for _step in range(1, 25):  # power iteration: the spend of all customers has one dominant direction
    _VIEWS[f"factor_{_step}"] = f"""
        SELECT product_id, y / sqrt(SUM(y * y) OVER ()) AS v
        FROM (SELECT i AS product_id, SUM(x * v) AS y FROM spend_gram JOIN factor_{_step - 1} f ON f.product_id = j GROUP BY i)"""
_VIEWS["recommendations"] = """
        SELECT r.customer_id, r.product_id, n.product_name,
               CAST(ROUND(r.score, 4) AS DECIMAL(18,4)) AS score, r."rank"
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, product_id) AS INT) AS "rank"
              FROM (SELECT p.customer_id, f.product_id, p.s * f.v AS score
                    FROM (SELECT customer_id, SUM(CAST(spend AS DOUBLE) * v) AS s
                          FROM spend JOIN factor_24 USING (product_id) GROUP BY customer_id) p
                    CROSS JOIN factor_24 f
                    WHERE NOT EXISTS (SELECT 1 FROM spend b WHERE b.customer_id = p.customer_id
                                      AND b.product_id = f.product_id))) r
        JOIN names n ON n.product_id = r.product_id WHERE r."rank" <= 5"""

_WITH = "WITH RECURSIVE " + ",\n".join(f"{name} AS ({text})" for name, text in _VIEWS.items()) + "\n"

_SALE_COLUMNS = "sale_id, customer_id, store_id, product_id, amount, sale_date, arrival_seq, event_type"
_TODAY = f"sale_hour >= date_trunc('day', TIMESTAMP '{CARDS_AS_OF}')"


def _last(column: str, interval: str) -> str:
    return f"{column} >= TIMESTAMP '{CARDS_AS_OF}' - INTERVAL {interval}"


def _revenue_and_orders(key: str, name: str, where: str) -> str:
    return f"""SELECT {key} AS {name}, {_MONEY.format('SUM(total_revenue)')} AS total_revenue,
               CAST(SUM(order_count) AS BIGINT) AS orders FROM mart_sales WHERE {where} GROUP BY 1"""


def _incremental(new: str) -> str:
    previous = _base("sales_enriched", f"sale_date < TIMESTAMP '{EDGE_PREVIOUS}'")
    merged = f"""
        SELECT COALESCE(o.customer_id, d.customer_id) AS customer_id,
               greatest(o.last_purchase, d.last_purchase) AS last_purchase,
               COALESCE(o.frequency, 0) + COALESCE(d.frequency, 0) AS frequency,
               CAST(COALESCE(o.monetary, 0) + COALESCE(d.monetary, 0) AS DECIMAL(20,2)) AS monetary
        FROM ({previous}) o FULL JOIN ({_base('sales_enriched', new)}) d ON o.customer_id = d.customer_id"""
    return _scored(merged, EDGE_AS_OF)


def _top_spenders(segment: str, inactivity: str) -> str:
    return f"""SELECT customer_id, monetary AS total_spent, frequency AS total_orders, recency_days AS {inactivity}
               FROM mart_account WHERE segment = '{segment}'
               ORDER BY monetary DESC, customer_id, snapshot_date LIMIT 20"""


def _count_segment(segment: str) -> str:
    return f"SELECT COUNT(*) AS value FROM mart_account WHERE segment = '{segment}'"


def _segment_summary(source: str) -> str:
    money = "SUM(monetary)"
    orders = "CAST(SUM(frequency) AS DECIMAL(20,2))"
    days = "CAST(SUM(recency_days) AS DECIMAL(20,2))"
    return f"""SELECT segment, COUNT(*) AS customers, {_mean(money, 'COUNT(*)', 2)} AS avg_spend,
               {_mean(orders, 'COUNT(*)', 1)} AS avg_orders, {_mean(days, 'COUNT(*)', 0)} AS avg_recency_days
               FROM {source} GROUP BY segment"""


_INVENTORY_ROWS = "SELECT product_name, category, stock_qty, restock_threshold, status, alert_count FROM mart_inventory"
_BY_URGENCY = "ORDER BY CASE status WHEN 'CRITICAL' THEN 1 WHEN 'LOW' THEN 2 ELSE 3 END, stock_qty, product_id"

_SQL = {
    "scan_hour_partition": """
        SELECT sale_id, customer_id, store_id, product_id, amount, sale_date,
               '2024' AS "year", '01' AS "month", '15' AS "day", '13' AS "hour"
        FROM raw_sales WHERE date_trunc('hour', sale_date) = TIMESTAMP '2024-01-15 12:00:00'""",
    "quality_not_null": f"""
        SELECT {_SALE_COLUMNS} FROM raw_sales
        WHERE sale_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL AND amount IS NOT NULL""",
    "dedup_first": f"SELECT {_SALE_COLUMNS} FROM first_sales",
    "quality_check": f"SELECT {_SALE_COLUMNS} FROM first_sales WHERE amount > 0",
    "quality_counts": """
        SELECT b.n AS rows_before, a.n AS rows_after, b.n - a.n AS rows_dropped
        FROM (SELECT COUNT(*) AS n FROM raw_sales) b, (SELECT COUNT(*) AS n FROM first_sales WHERE amount > 0) a""",
    "silver_enriched": "SELECT * FROM sales_enriched",
    "silver_rebuild": "SELECT * EXCLUDE (event_type) FROM sales_enriched",
    "raw_quarantine": f"""
        SELECT COUNT(*) AS total, COUNT(product_name) AS has_name, MIN(CAST(sale_date AS DATE)) AS from_date,
               MAX(CAST(sale_date AS DATE)) AS to_date, '{', '.join(f'{day} footer' for day in BROKEN_DAYS)}' AS broken
        FROM (SELECT *, row_number() OVER (PARTITION BY sale_id, CAST(sale_date AS DATE) ORDER BY arrival_seq) AS rn
              FROM raw_sales WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND amount IS NOT NULL) d
        LEFT JOIN products p ON p.product_id = d.product_id
        WHERE d.rn = 1 AND d.amount > 0 AND strftime(sale_date, '%m-%d') NOT IN {tuple('01-' + day for day in BROKEN_DAYS)}""",
    "silver_verify": """
        SELECT COUNT(*) AS total, COUNT(product_name) AS has_name, MIN(sale_date_only) AS from_date,
               MAX(sale_date_only) AS to_date FROM sales_enriched""",
    "silver_history": f"""
        SELECT s.sale_id, s.amount, s.sale_date, s.event_type, CASE WHEN early THEN 'early' ELSE 'late' END AS ingest, "hour"
        FROM (SELECT *, sale_date < TIMESTAMP '{HISTORY_CUT}' AS early FROM sales_enriched) s,
             (SELECT CAST(unnest(range(1, 6)) AS INT) AS "hour") h
        WHERE CASE "hour" WHEN 1 THEN early WHEN 2 THEN TRUE WHEN 3 THEN NOT early OR event_type = 'purchase'
              WHEN 4 THEN amount > 100 AND (NOT early OR event_type = 'purchase')
              ELSE CASE WHEN early THEN amount > 100 AND event_type = 'purchase' ELSE event_type <> 'error' END END""",
    "sales_of_product": f"""
        SELECT sale_id, customer_id, store_id, product_id, amount, sale_date FROM sales_enriched
        WHERE product_id = {SEARCHED_PRODUCT} OR product_id = -1 AND sale_date
              BETWEEN TIMESTAMP '{SEARCHED_DAYS[0]}' AND TIMESTAMP '{SEARCHED_DAYS[1]}'""",
    "fast_track_filter": """
        SELECT sale_id, customer_id, store_id, product_id, amount, sale_date, arrival_seq
        FROM raw_sales WHERE amount > 400""",
    "fast_track_json": """
        SELECT sale_id AS "key",
               '{"sale_id":"' || sale_id || '","customer_id":' || customer_id || ',"store_id":' || store_id
               || ',"product_id":' || product_id || ',"amount":' || CAST(amount AS VARCHAR)
               || ',"sale_date":"' || strftime(sale_date, '%Y-%m-%d %H:%M:%S.%f') || '"}' AS "value"
        FROM line_sales WHERE amount > 50000""",
    "mart_sales": "SELECT * FROM mart_sales",
    "mart_sales_day": f"SELECT * FROM mart_sales WHERE CAST(sale_hour AS DATE) = DATE '{SALES_DAY}'",
    "upsert_mart_sales": f"""
        SELECT COALESCE(n.store_id, o.store_id) AS store_id, COALESCE(n.category, o.category) AS category,
               COALESCE(n.sale_hour, o.sale_hour) AS sale_hour,
               COALESCE(n.total_revenue, o.total_revenue) AS total_revenue,
               COALESCE(n.order_count, o.order_count) AS order_count,
               COALESCE(n.avg_order_value, o.avg_order_value) AS avg_order_value
        FROM (SELECT store_id, COALESCE(category, 'Unknown') AS category, date_trunc('hour', sale_date) AS sale_hour,
                     {_MONEY.format('SUM(amount)')} AS total_revenue, COUNT(*) AS order_count,
                     {_mean('SUM(amount)', 'COUNT(*)', 2, 10)} AS avg_order_value
              FROM sales_enriched WHERE event_type <> 'error' GROUP BY 1, 2, 3) o
        FULL JOIN (SELECT * FROM mart_sales WHERE CAST(sale_hour AS DATE) = DATE '{SALES_DAY}') n
          ON n.store_id = o.store_id AND n.category = o.category AND n.sale_hour = o.sale_hour""",
    "rfm_full": "SELECT * FROM rfm_now",
    "rfm_delta": f"""
        SELECT customer_id, MAX(sale_date) AS last_purchase, COUNT(sale_date) AS frequency,
               CAST(SUM(amount) AS DECIMAL(20,2)) AS monetary
        FROM order_sales WHERE sale_date >= TIMESTAMP '{RFM_PREVIOUS}' AND sale_date < TIMESTAMP '{RFM_AS_OF}'
        GROUP BY customer_id""",
    "rfm_incremental": _scored(_base("sales_enriched", "true"), EDGE_AS_OF),
    "rfm_incremental_snapshot_date": _incremental(f"sale_date > date_trunc('day', TIMESTAMP '{EDGE_PREVIOUS}')"),
    "rfm_latest_snapshot": """
        SELECT * FROM (SELECT * FROM rfm_previous UNION ALL SELECT * FROM rfm_now)
        WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM
                               (SELECT snapshot_date FROM rfm_previous UNION ALL SELECT snapshot_date FROM rfm_now))""",
    "rfm_segment_counts": "SELECT segment, COUNT(*) AS customers FROM rfm_now GROUP BY segment",
    "mart_account": """
        SELECT customer_id, segment, frequency, monetary, recency_days, snapshot_date FROM rfm_now""",
    "upsert_mart_account": f"""
        WITH stale AS ({_scored(_base('order_sales', f"sale_date < TIMESTAMP '{RFM_STALE_BEFORE}'"), RFM_AS_OF)})
        SELECT customer_id, segment, frequency, monetary, recency_days, snapshot_date FROM rfm_previous
        UNION ALL
        SELECT COALESCE(n.customer_id, o.customer_id), COALESCE(n.segment, o.segment),
               COALESCE(n.frequency, o.frequency), COALESCE(n.monetary, o.monetary),
               COALESCE(n.recency_days, o.recency_days), COALESCE(n.snapshot_date, o.snapshot_date)
        FROM stale o FULL JOIN rfm_now n ON n.customer_id = o.customer_id AND n.snapshot_date = o.snapshot_date""",
    "hour_sold_qty": "SELECT product_id, sold_qty FROM sold",
    "inventory_after_sales": """
        SELECT i.product_id, CAST(greatest(i.stock_qty - COALESCE(s.sold_qty, 0), 0) AS INT) AS stock_qty,
               i.restock_threshold
        FROM inventory i LEFT JOIN sold s ON s.product_id = i.product_id""",
    "inventory_new_alerts": f"""
        SELECT (SELECT MAX(alert_id) FROM inventory_alerts WHERE alert_time < TIMESTAMP '{STOCK_TO}')
               + row_number() OVER (ORDER BY l.product_id % 1024, l.product_id) AS alert_id,
               l.product_id, l.stock_qty, l.restock_threshold AS threshold, TIMESTAMP '{STOCK_TO}' AS alert_time,
               FALSE AS resolved
        FROM (SELECT i.product_id, CAST(greatest(i.stock_qty - s.sold_qty, 0) AS INT) AS stock_qty, i.restock_threshold
              FROM inventory i JOIN sold s ON s.product_id = i.product_id) l
        WHERE l.stock_qty <= l.restock_threshold AND NOT EXISTS (
            SELECT 1 FROM inventory_alerts a
            WHERE a.product_id = l.product_id AND a.resolved = FALSE AND a.alert_time < TIMESTAMP '{STOCK_TO}'
              AND a.alert_time > TIMESTAMP '{STOCK_TO}' - INTERVAL 1 HOUR)""",
    "inventory_alert_report": f"""
        SELECT p.product_name, a.stock_qty, a.threshold, a.alert_time
        FROM inventory_alerts a JOIN products p ON p.product_id = a.product_id
        WHERE a.resolved = FALSE AND CAST(a.alert_time AS DATE) = DATE '{SALES_DAY}'""",
    "inventory_replay": """
        SELECT h.product_id, h.sale_hour, h.sold_qty,
               CAST(greatest(i.stock_qty - SUM(h.sold_qty) OVER (PARTITION BY h.product_id ORDER BY h.sale_hour), 0)
                    AS BIGINT) AS stock_after
        FROM (SELECT product_id, date_trunc('hour', sale_date) AS sale_hour, COUNT(*) AS sold_qty
              FROM sales_enriched GROUP BY 1, 2) h
        JOIN inventory i ON i.product_id = h.product_id""",
    "mart_inventory": "SELECT * FROM mart_inventory",
    "upsert_mart_inventory": """
        SELECT product_id, CASE WHEN category <> 'SMALL' THEN product_name || ' (old)' ELSE product_name END
               AS product_name, category, stock_qty,
               CASE WHEN category <> 'SMALL' THEN 40 ELSE restock_threshold END AS restock_threshold, status, alert_count
        FROM mart_inventory""",
    "insert_if_absent": """
        SELECT product_id, CASE WHEN category <> 'SMALL' THEN product_name || ' (old)' ELSE product_name END
               AS product_name, category, price FROM products""",
    "distinct_counts": """
        SELECT COUNT(*) AS sales, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT product_id) AS products
        FROM sales_enriched""",
    "customer_basket": "SELECT customer_id, product_name FROM basket",
    "affinity_item_support": "SELECT product_name, customers FROM items",
    "affinity_pair_support": """
        SELECT p.product_a, p.product_b, x.customers AS customers_a, y.customers AS customers_b, p.pair_customers
        FROM pairs p JOIN items x ON x.product_name = p.product_a JOIN items y ON y.product_name = p.product_b""",
    "affinity_rules": "SELECT * FROM rules",
    "affinity_rules_two_items": f"""
        SELECT r.antecedent_a, r.antecedent_b, r.consequent, {_ratio('r.n', 'z.n')} AS support,
               {_ratio('r.n', 'p.n')} AS confidence,
               {_ratio('r.n * CAST(z.n AS HUGEINT)', 'CAST(p.n AS HUGEINT) * y.customers')} AS lift
        FROM (SELECT t.x AS antecedent_a, t.y AS antecedent_b, t.z AS consequent, n FROM (SELECT n,
                     unnest([{{'x': a, 'y': b, 'z': c}}, {{'x': a, 'y': c, 'z': b}}, {{'x': b, 'y': c, 'z': a}}]) AS t
              FROM (SELECT a.product_name AS a, b.product_name AS b, c.product_name AS c, COUNT(*) AS n
                    FROM basket a JOIN basket b ON b.customer_id = a.customer_id AND a.product_name < b.product_name
                    JOIN basket c ON c.customer_id = a.customer_id AND b.product_name < c.product_name
                    GROUP BY 1, 2, 3 HAVING COUNT(*) >= (SELECT greatest(10, CAST(ceil(COUNT(DISTINCT customer_id) / 20.0) AS BIGINT))
                                                         FROM line_sales)))) r
        JOIN (SELECT a.product_name AS a, b.product_name AS b, COUNT(*) AS n
              FROM basket a JOIN basket b ON b.customer_id = a.customer_id GROUP BY 1, 2) p
          ON p.a = r.antecedent_a AND p.b = r.antecedent_b
        JOIN items y ON y.product_name = r.consequent
        CROSS JOIN (SELECT COUNT(DISTINCT customer_id) AS n FROM basket) z
        WHERE 5 * r.n >= p.n""",
    "affinity_rules_top": "SELECT * FROM rules ORDER BY lift DESC, antecedent, consequent LIMIT 5",
    "user_item_spend": "SELECT customer_id, product_id, spend FROM spend",
    "user_item_pivot": "SELECT customer_id, " + ", ".join(
        f"CAST(SUM(CASE WHEN product_id = {item} THEN amount ELSE 0 END) AS DECIMAL(20,2)) AS item_{str(item).replace('-', '_')}"
        for item in ITEM_IDS
    ) + " FROM sales_enriched GROUP BY customer_id",
    "product_name_lookup": "SELECT product_id, product_name FROM names",
    "unbought_pairs": """
        SELECT customer_id, product_id FROM sales_enriched
        EXCEPT SELECT customer_id, product_id FROM sales_enriched WHERE event_type = 'purchase'""",
    "unbought_counts": """
        SELECT customer_id, (SELECT COUNT(*) FROM products) - COUNT(DISTINCT p.product_id) AS unbought
        FROM sales_enriched s LEFT JOIN products p ON p.product_id = s.product_id GROUP BY customer_id""",
    "spend_top5_per_customer": 'SELECT customer_id, product_id, spend, "rank" FROM top5',
    "spend_gram": """
        SELECT i AS product_a, j AS product_b, CAST(ROUND(x, 4) AS DECIMAL(24,4)) AS total FROM spend_gram WHERE i <= j""",
    "cf_recommendations_one_factor": 'SELECT customer_id, product_id, product_name, score, "rank" FROM recommendations',
    # dashboards
    "card_store_revenue_7d": _revenue_and_orders("store_id", "store_id", _last("sale_hour", "7 DAYS")),
    "card_sales_trend_30d": _revenue_and_orders("date_trunc('day', sale_hour)", '"date"', _last("sale_hour", "30 DAYS")),
    "card_top10_products_7d": f"""
        SELECT product_name, category, COUNT(*) AS order_count, {_MONEY.format('SUM(amount)')} AS total_revenue,
               {_mean('SUM(amount)', 'COUNT(*)', 2)} AS avg_price
        FROM sales_enriched WHERE {_last('sale_date', '7 DAYS')} GROUP BY product_name, category
        ORDER BY total_revenue DESC, product_name NULLS LAST, category NULLS LAST LIMIT 10""",
    "card_category_revenue_7d": f"""
        SELECT category, {_MONEY.format('SUM(total_revenue)')} AS total_revenue,
               CAST(SUM(order_count) AS BIGINT) AS orders, {_mean('SUM(avg_order_value)', 'COUNT(*)', 2)} AS avg_order
        FROM mart_sales WHERE {_last('sale_hour', '7 DAYS')} GROUP BY category""",
    "card_segment_summary": _segment_summary("mart_account"),
    "card_segment_summary_latest": _segment_summary("rfm_now"),
    "card_top_champions": _top_spenders("Champions", "days_since_last_buy"),
    "card_at_risk": _top_spenders("At Risk", "days_inactive"),
    "card_monetary_frequency": """
        SELECT customer_id, segment, CAST(ROUND(monetary, 0) AS DECIMAL(20,2)) AS monetary, frequency
        FROM mart_account ORDER BY mart_account.monetary DESC, customer_id, snapshot_date LIMIT 200""",
    "card_inventory_overview": _INVENTORY_ROWS,
    "card_status_counts": "SELECT status, COUNT(*) AS product_count FROM mart_inventory GROUP BY status",
    "panel_revenue_today": f"SELECT {_MONEY.format('COALESCE(SUM(total_revenue), 0)')} AS value FROM mart_sales WHERE {_TODAY}",
    "panel_orders_today": f"SELECT CAST(COALESCE(SUM(order_count), 0) AS BIGINT) AS value FROM mart_sales WHERE {_TODAY}",
    "panel_avg_order_today": f"""
        SELECT COALESCE(CAST(SUM(avg_order_value) AS DOUBLE) / COUNT(avg_order_value), 0) AS value
        FROM mart_sales WHERE {_TODAY}""",
    "panel_open_alerts": "SELECT COUNT(*) AS value FROM inventory_alerts WHERE resolved = FALSE",
    "panel_hourly_by_store_24h": f"""
        SELECT sale_hour AS "time", CAST(store_id AS VARCHAR) AS metric, {_MONEY.format('SUM(total_revenue)')} AS value
        FROM mart_sales WHERE {_last('sale_hour', '24 HOURS')} GROUP BY 1, 2""",
    "panel_store_today": f"""
        SELECT 'Store ' || CAST(store_id AS VARCHAR) AS metric, {_MONEY.format('SUM(total_revenue)')} AS value
        FROM mart_sales WHERE {_TODAY} GROUP BY store_id""",
    "panel_category_today": f"""
        SELECT category, {_MONEY.format('SUM(total_revenue)')} AS total_revenue
        FROM mart_sales WHERE {_TODAY} AND category IS NOT NULL GROUP BY category""",
    "panel_inventory_top20": f"{_INVENTORY_ROWS} {_BY_URGENCY} LIMIT 20",
    "panel_daily_7d": _revenue_and_orders("date_trunc('day', sale_hour)", '"time"', _last("sale_hour", "7 DAYS")),
    "panel_customer_count": "SELECT COUNT(DISTINCT customer_id) AS value FROM mart_account",
    "panel_champions_count": _count_segment("Champions"),
    "panel_at_risk_count": _count_segment("At Risk"),
    "panel_lost_count": _count_segment("Lost"),
    "panel_segment_distribution": "SELECT segment AS metric, COUNT(*) AS value FROM mart_account GROUP BY segment",
    "panel_segment_avg_monetary": f"""
        SELECT segment AS metric, {_mean('SUM(monetary)', 'COUNT(*)', 2)} AS value FROM mart_account GROUP BY segment""",
    "panel_top20_customers": """
        SELECT customer_id, segment, frequency, monetary, recency_days
        FROM mart_account ORDER BY monetary DESC, customer_id, snapshot_date LIMIT 20""",
    "panel_recency_values": "SELECT recency_days AS value FROM mart_account",
    "panel_recency_histogram": """
        SELECT CAST(floor(recency_days / 30.0) * 30 AS DECIMAL(18,4)) AS bucket, COUNT(*) AS "values"
        FROM mart_account GROUP BY 1""",
    "panel_recency_histogram_auto": _auto_histogram("mart_account", "recency_days"),
    "panel_lift_histogram_auto": _auto_histogram("rules", "lift"),
    "panel_top_rules": """
        SELECT antecedent, consequent, CAST(ROUND(confidence, 3) AS DECIMAL(12,3)) AS confidence,
               CAST(ROUND(support, 3) AS DECIMAL(12,3)) AS support, CAST(ROUND(lift, 3) AS DECIMAL(12,3)) AS lift
        FROM rules ORDER BY rules.lift DESC, antecedent, consequent LIMIT 20""",
    "panel_lift_values": "SELECT lift AS value FROM rules",
    "panel_lift_histogram": """
        SELECT CAST(CAST(CAST(lift * 10000 AS BIGINT) // 1000 AS DECIMAL(12,0)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(18,4)) AS bucket, COUNT(*) AS "values"
        FROM rules GROUP BY 1""",
    "card_cf_for_customer": f"""
        SELECT customer_id, "rank" AS position, product_name, CAST(ROUND(score, 2) AS DECIMAL(18,2)) AS score
        FROM recommendations WHERE customer_id = {CF_CUSTOMER}""",
    "panel_top_recommended": """
        SELECT product_name AS metric, COUNT(*) AS value FROM recommendations WHERE "rank" = 1
        GROUP BY product_name ORDER BY value DESC, metric NULLS LAST LIMIT 10""",
    "customers_by_range": "SELECT * FROM (" + " UNION ALL ".join(f"""
        SELECT {days} AS days, COUNT(DISTINCT customer_id) AS customers FROM sales_enriched
        WHERE sale_date_only > DATE '{CARDS_AS_OF[:10]}' - {days} AND sale_date_only <= DATE '{CARDS_AS_OF[:10]}'"""
        for days in (1, 7, 30)) + ")",
    "card_sales_trend_incremental": f"""
        SELECT date_trunc('day', sale_hour) AS "date", {_MONEY.format('SUM(total_revenue)')} AS total_revenue,
               CAST(SUM(order_count) AS BIGINT) AS orders
        FROM (SELECT date_trunc('hour', sale_date) AS sale_hour, SUM(amount) AS total_revenue, COUNT(*) AS order_count
              FROM sales_enriched WHERE event_type <> 'error' OR CAST(sale_date_only AS VARCHAR) IN {TREND_DAYS} GROUP BY 1)
        WHERE sale_hour >= TIMESTAMP '{TREND_AS_OF}' - INTERVAL 30 DAYS GROUP BY 1""",
    # streams
    "stream_silver": """
        SELECT d.sale_id, d.customer_id, d.store_id, d.product_id, p.product_name, p.category, d.amount, d.sale_date,
               CAST(EXTRACT(HOUR FROM d.sale_date) AS INT) AS sale_hour, CAST(d.sale_date AS DATE) AS sale_date_only
        FROM (SELECT *, row_number() OVER (PARTITION BY sale_id, date_trunc('hour', sale_date) ORDER BY arrival_seq) AS rn
              FROM raw_sales WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND amount IS NOT NULL) d
        LEFT JOIN products p ON p.product_id = d.product_id
        WHERE d.rn = 1 AND d.amount > 0""",
    "stream_fast_track": """
        SELECT sale_id AS "key",
               '{"sale_id":"' || sale_id || '","customer_id":' || COALESCE(CAST(customer_id AS VARCHAR), 'null')
               || ',"store_id":' || store_id || ',"product_id":' || product_id
               || ',"amount":' || CAST(amount AS VARCHAR)
               || ',"sale_date":"' || strftime(sale_date, '%Y-%m-%d %H:%M:%S.%f') || '"}' AS "value"
        FROM raw_sales WHERE amount > 200""",
    "stream_sales_once": """
        SELECT DISTINCT sale_id FROM raw_sales
        WHERE customer_id IS NOT NULL AND product_id IS NOT NULL AND amount IS NOT NULL""",
    "stream_first_sale": f"SELECT {_SALE_COLUMNS} FROM first_sales WHERE amount > 0",
    "stream_alerts": f"""
        SELECT alerts * 1099511627776 + product_id AS alert_id, product_id, stock_qty, threshold, "at" AS alert_time,
               FALSE AS resolved
        FROM stock_steps WHERE last_alert = "at"
        """,
    "stream_hourly_revenue": """
        SELECT * FROM mart_sales
        WHERE sale_hour + INTERVAL 1 HOUR <= (SELECT MAX(sale_date) FROM sales_enriched) - INTERVAL 1 HOUR""",
    "stream_revenue_corrected": "SELECT * FROM mart_sales",
    "stream_stock_level": """
        SELECT i.product_id, CAST(greatest(i.stock_qty - COALESCE(s.n, 0), 0) AS INT) AS stock_qty, i.restock_threshold
        FROM inventory i LEFT JOIN (SELECT product_id, COUNT(*) AS n FROM sales_enriched GROUP BY product_id) s
          ON s.product_id = i.product_id""",
    "stream_rfm_totals": _base("sales_enriched", "true"),
}


_SQL["upsert_mart_sales_log"] = f"""{_SQL['upsert_mart_sales']}
        UNION ALL
        SELECT NULL AS store_id, category, sale_hour, total_revenue, order_count, avg_order_value
        FROM mart_sales WHERE CAST(sale_hour AS DATE) = DATE '{SALES_DAY}' AND store_id = 1"""


def all_sql() -> dict[str, str]:
    return {name: _WITH + "SELECT * FROM (" + text.strip() + ") q" for name, text in _SQL.items()}
