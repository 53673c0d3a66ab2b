"""DuckDB SQL that states, independently of the Spark code, what each
registered query must return (the correctness oracle).

The tables ``lineitem orders customer supplier part nation`` are views
over the same Parquet files.  Money is summed as DECIMAL(18,2) and
reported as DOUBLE on both sides; ids are BIGINT, counts BIGINT.
"""

from __future__ import annotations

# The canonical sales tables over the TPC-H-style tables (same mapping as
# martforge.sources.tpch).
BASE = """
fact AS (
  SELECT o.o_custkey AS customer_id,
         CAST(s.s_nationkey AS BIGINT) AS store_id,
         p.p_name AS product_name,
         CAST(l.l_shipdate AS DATE) AS sales_date,
         l.l_suppkey AS sales_person_id,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total_cost
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
dim_customer AS (
  SELECT c_custkey AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         c_mktsegment AS address,
         CAST(c_nationkey AS VARCHAR) AS pincode,
         '+' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone_number
  FROM customer
),
dim_store AS (
  SELECT CAST(n_nationkey AS BIGINT) AS store_id,
         'region ' || CAST(n_regionkey AS VARCHAR) AS store_address,
         n_name AS store_manager_name
  FROM nation
),
dim_sales_team AS (
  SELECT s_suppkey AS sales_person_id,
         split_part(s_name, '#', 1) AS sales_person_first_name,
         split_part(s_name, '#', 2) AS sales_person_last_name,
         CAST(s_nationkey AS BIGINT) AS manager_id,
         'N' AS is_manager,
         'nation ' || CAST(s_nationkey AS VARCHAR) AS sales_person_address,
         CAST(s_nationkey AS VARCHAR) AS sales_person_pincode
  FROM supplier
),
enriched AS (
  SELECT f.customer_id, f.store_id, f.sales_person_id, f.sales_date, f.total_cost,
         c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
         st.store_address, st.store_manager_name,
         t.sales_person_first_name, t.sales_person_last_name, t.manager_id, t.is_manager,
         t.sales_person_address, t.sales_person_pincode
  FROM fact f
  JOIN dim_customer c ON f.customer_id = c.customer_id
  JOIN dim_store st ON f.store_id = st.store_id
  JOIN dim_sales_team t ON f.sales_person_id = t.sales_person_id
),
sales_monthly AS (
  SELECT store_id, sales_person_id,
         sales_person_first_name || ' ' || sales_person_last_name AS full_name,
         substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month,
         SUM(total_cost) AS total_sales
  FROM enriched
  GROUP BY 1, 2, 3, 4
),
customer_monthly AS (
  SELECT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
         substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_date_month,
         SUM(total_cost) AS total_sales
  FROM enriched
  GROUP BY 1, 2, 3, 4, 5
),
incentives AS (
  SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
         RANK() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST) AS rnk
  FROM sales_monthly
)
"""


def with_base(body: str) -> str:
    return "WITH " + BASE.strip() + "\n" + body.strip()


INCENTIVE = ("CASE WHEN rnk = 1 THEN CAST(CAST(total_sales * 0.01 AS DECIMAL(18,2)) AS DOUBLE) "
             "ELSE 0.0 END")

SQL: dict[str, str] = {
    "conformed_sales": with_base("""
SELECT customer_id, store_id, product_name, sales_date, sales_person_id,
       CAST((2 * CAST(total_cost * 100 AS BIGINT) + quantity) // (2 * quantity) AS DOUBLE) / 100 AS price,
       quantity, CAST(total_cost AS DOUBLE) AS total_cost,
       CAST(NULL AS VARCHAR) AS additional_column
FROM fact"""),
    "enriched_sales": with_base("""
SELECT customer_id, store_id, sales_person_id, sales_date, CAST(total_cost AS DOUBLE) AS total_cost,
       first_name, last_name, address, pincode, phone_number, store_address, store_manager_name,
       sales_person_first_name, sales_person_last_name, manager_id, is_manager,
       sales_person_address, sales_person_pincode
FROM enriched"""),
    "customer_mart": with_base("""
SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date,
       CAST(total_cost AS DOUBLE) AS total_cost
FROM enriched"""),
    "sales_team_mart": with_base("""
SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name,
       store_manager_name, manager_id, is_manager, sales_person_address, sales_person_pincode,
       sales_date, CAST(total_cost AS DOUBLE) AS total_cost,
       substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month
FROM enriched"""),
    "customer_monthly": with_base("""
SELECT customer_id, full_name, address, phone_number, sales_date_month,
       CAST(total_sales AS DOUBLE) AS total_sales
FROM customer_monthly"""),
    "sales_team_monthly": with_base("""
SELECT store_id, sales_person_id, full_name, sales_month, CAST(total_sales AS DOUBLE) AS total_sales
FROM sales_monthly"""),
    "sales_team_rank": with_base("""
SELECT store_id, sales_person_id, full_name, sales_month, CAST(total_sales AS DOUBLE) AS total_sales,
       CAST(rnk AS BIGINT) AS rnk
FROM incentives"""),
    "sales_team_incentive": with_base(f"""
SELECT store_id, sales_person_id, full_name, sales_month, CAST(total_sales AS DOUBLE) AS total_sales,
       {INCENTIVE} AS incentive
FROM incentives"""),
    "top_seller_per_store_month": with_base("""
SELECT store_id, sales_person_id, full_name, sales_month, CAST(total_sales AS DOUBLE) AS total_sales
FROM incentives WHERE rnk = 1"""),
    "incentive_report": with_base(f"""
SELECT full_name AS sales_person_name, store_id AS sales_person_store_id, sales_month,
       CAST(total_sales AS DOUBLE) AS total_billing, {INCENTIVE} AS total_incentive
FROM incentives"""),
    "daily_products_per_customer": with_base("""
SELECT customer_id, sales_date, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
       COUNT(DISTINCT product_name) AS distinct_products
FROM fact GROUP BY 1, 2"""),
}

PRICE = "CAST((2 * CAST(total_cost * 100 AS BIGINT) + quantity) // (2 * quantity) AS DOUBLE) / 100"
DROP_COLS = ("customer_id, store_id, product_name, sales_date, sales_person_id, "
             f"{PRICE} AS price, quantity, CAST(total_cost AS DOUBLE) AS total_cost")

SQL["csv_drop_union"] = with_base(f"""
SELECT {DROP_COLS}, CAST(NULL AS VARCHAR) AS additional_column
FROM fact WHERE sales_date < DATE '1998-01-01'
UNION ALL
SELECT {DROP_COLS},
       concat_ws(', ', CASE WHEN quantity > 25 THEN 'UPI' ELSE 'cash' END,
                 CASE WHEN quantity >= 45 THEN 'Q' || CAST(quantity AS VARCHAR) END) AS additional_column
FROM fact WHERE sales_date >= DATE '1998-01-01' AND sales_date < DATE '2000-01-01'
  AND quantity <> 50""")

# the rows of the extra drop whose store id does not parse, as text in the
# drop's column order (empty text for a NULL cell)
SQL["csv_bad_rows"] = with_base("""
SELECT 'extra' AS drop_name,
       concat_ws(',', CASE WHEN quantity > 25 THEN 'UPI' ELSE 'cash' END,
                 CAST(total_cost AS VARCHAR), CAST(quantity AS VARCHAR),
                 CAST(CAST(CAST((2 * CAST(total_cost * 100 AS BIGINT) + quantity) // (2 * quantity) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS VARCHAR),
                 CAST(sales_person_id AS VARCHAR), CAST(sales_date AS VARCHAR), product_name,
                 'S' || CAST(store_id AS VARCHAR), CAST(customer_id AS VARCHAR),
                 COALESCE('Q' || CAST(quantity AS VARCHAR), '')) AS raw
FROM fact WHERE sales_date >= DATE '1998-01-01' AND sales_date < DATE '2000-01-01'
  AND quantity = 50""")

SQL["csv_drop_routing"] = with_base("""
SELECT 'clean' AS drop_name, 'accepted' AS reason, '' AS missing_columns, '' AS extra_columns,
       COUNT(*) AS n_rows
FROM fact WHERE sales_date < DATE '1998-01-01'
UNION ALL
SELECT 'extra', 'accepted', '', 'payment_mode,coupon', COUNT(*)
FROM fact WHERE sales_date >= DATE '1998-01-01' AND sales_date < DATE '2000-01-01'
UNION ALL
SELECT 'missing', 'missing_columns', 'store_id', 'payment_mode', COUNT(*)
FROM fact WHERE sales_date >= DATE '2000-01-01'""")

# the rejected drop lacks the store id; its lines as written
SQL["csv_quarantined_lines"] = with_base("""
SELECT 'missing' AS drop_name, 'missing_columns' AS reason, 'store_id' AS missing_columns,
       concat_ws(',', CAST(customer_id AS VARCHAR), product_name, CAST(sales_date AS VARCHAR),
                 CAST(sales_person_id AS VARCHAR),
                 CAST(CAST(CAST((2 * CAST(total_cost * 100 AS BIGINT) + quantity) // (2 * quantity) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS VARCHAR),
                 CAST(quantity AS VARCHAR), CAST(total_cost AS VARCHAR),
                 CASE WHEN quantity > 25 THEN 'UPI' ELSE 'cash' END) AS raw
FROM fact WHERE sales_date >= DATE '2000-01-01'""")

# 8 rotations, 2 directions, 0 to 12 extras: only the extras show in the rows
SQL["csv_many_shapes"] = with_base(f"""
, shapes AS (SELECT s, string_agg(CAST(s AS VARCHAR) || '-' || CAST(j AS VARCHAR), ', ' ORDER BY j) AS extras
             FROM range(208) t(s), range(12) u(j) WHERE j < s // 16 GROUP BY s)
SELECT {DROP_COLS}, extras AS additional_column
FROM fact LEFT JOIN shapes ON s = (customer_id * 7 + quantity) % 208""")

# the rows that parse of the accepted drops: before 2000, but for quantity 50 of the extra drop
SQL["pipeline_customer_mart"] = with_base("""
SELECT customer_id, first_name, last_name, address, pincode, phone_number, f.sales_date,
       CAST(f.total_cost AS DOUBLE) AS total_cost
FROM fact f JOIN dim_customer USING (customer_id) JOIN dim_store USING (store_id)
JOIN dim_sales_team USING (sales_person_id)
WHERE f.sales_date < DATE '1998-01-01' OR (f.sales_date < DATE '2000-01-01' AND f.quantity <> 50)""")

SQL["pipeline_ledger"] = with_base("""
SELECT CASE WHEN sales_date < DATE '1998-01-01' THEN 'clean' WHEN sales_date < DATE '2000-01-01' THEN 'extra'
       ELSE 'missing' END AS drop_name,
       CASE WHEN sales_date < DATE '2000-01-01' THEN 'I' ELSE 'R' END AS status,
       CAST(CASE WHEN sales_date < DATE '2000-01-01' THEN 2 ELSE 1 END AS BIGINT) AS n_events, TRUE AS moved,
       (sales_date >= DATE '1998-01-01' AND sales_date < DATE '2000-01-01' AND quantity = 50) AS bad,
       CAST(COUNT(*) AS BIGINT) AS n_rows
FROM fact GROUP BY ALL""")

# the stream must ingest exactly the rows of the batch ingest
SQL["incremental_ingest"] = SQL["csv_drop_union"]

FACT_COLS = ("customer_id, store_id, product_name, sales_date, sales_person_id, "
             f"{PRICE} AS price, quantity, CAST(total_cost AS DOUBLE) AS total_cost, "
             "CAST(NULL AS VARCHAR) AS additional_column")

SQL["unmatched_facts"] = with_base(f"""
SELECT 'customer' AS missing_dimension, {FACT_COLS} FROM fact f
WHERE NOT EXISTS (SELECT 1 FROM dim_customer c
                  WHERE c.customer_id = f.customer_id AND c.address <> 'BUILDING')
UNION ALL
SELECT 'store', {FACT_COLS} FROM fact f
WHERE NOT EXISTS (SELECT 1 FROM nation n
                  WHERE CAST(n.n_nationkey AS BIGINT) = f.store_id AND n.n_regionkey <> 0)
UNION ALL
SELECT 'sales_team', {FACT_COLS} FROM fact f
WHERE NOT EXISTS (SELECT 1 FROM dim_sales_team t WHERE t.sales_person_id = f.sales_person_id)""")

LEDGER_BASE = """
WITH files AS (
  SELECT 'drop_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
         'landing/drop_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_path,
         o_orderkey + 1000 AS length,
         CAST(o_orderdate AS TIMESTAMP) AS modification_time,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS run_id,
         o_orderstatus, o_orderpriority
  FROM orders
),
events AS (
  SELECT file_name, file_path, length, modification_time, run_id,
         'A' AS status, modification_time AS event_ts, 0 AS seq FROM files
  UNION ALL
  SELECT file_name, file_path, length, modification_time, run_id,
         'I', modification_time + INTERVAL 1 DAY, 1 FROM files WHERE o_orderstatus IN ('F', 'P')
  UNION ALL
  SELECT file_name, file_path, length, modification_time, run_id,
         'A', modification_time + INTERVAL 1 DAY, 2 FROM files WHERE o_orderstatus = 'P'
),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY file_path, length, modification_time
                               ORDER BY event_ts DESC, seq DESC) AS rn,
         MIN(event_ts) OVER (PARTITION BY file_path, length, modification_time) AS created_ts,
         MAX(event_ts) OVER (PARTITION BY file_path, length, modification_time) AS updated_ts,
         COUNT(*) OVER (PARTITION BY file_path, length, modification_time) AS n_events
  FROM events
),
state AS (SELECT * FROM ranked WHERE rn = 1),
listing AS (
  SELECT file_path AS path, file_name, length,
         CASE WHEN o_orderpriority = '5-LOW' THEN modification_time + INTERVAL 2 DAY
              ELSE modification_time END AS modification_time
  FROM files
)
"""

SQL["ledger_state"] = LEDGER_BASE.strip() + """
SELECT file_name, file_path, length, strftime(modification_time, '%Y-%m-%d %H:%M:%S') AS modification_time,
       status, run_id, strftime(created_ts, '%Y-%m-%d %H:%M:%S') AS created_ts,
       strftime(updated_ts, '%Y-%m-%d %H:%M:%S') AS updated_ts, n_events
FROM state"""

SQL["ledger_open_files"] = LEDGER_BASE.strip() + """
SELECT DISTINCT l.file_name FROM listing l
JOIN state s ON l.path = s.file_path AND l.length = s.length
            AND l.modification_time = s.modification_time
WHERE s.status = 'A'"""

SQL["ledger_pending"] = LEDGER_BASE.strip() + """
SELECT l.path, l.file_name, l.length, strftime(l.modification_time, '%Y-%m-%d %H:%M:%S') AS modification_time
FROM listing l
WHERE NOT EXISTS (SELECT 1 FROM state s WHERE s.status = 'I' AND l.path = s.file_path
                  AND l.length = s.length AND l.modification_time = s.modification_time)"""

SQL["partitioned_mart_roundtrip"] = with_base("""
SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name,
       store_manager_name, manager_id, is_manager, sales_person_address, sales_person_pincode,
       sales_date, CAST(total_cost AS DOUBLE) AS total_cost,
       substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month
FROM enriched""")

SQL["partitioned_mart_months"] = SQL["partitioned_mart_roundtrip"] + """
WHERE substring(CAST(sales_date AS VARCHAR), 1, 7) >= '1999-01'"""

SQL["snapshot_roundtrip"] = with_base(f"""
SELECT store_id, sales_person_id, full_name, sales_month, CAST(total_sales AS DOUBLE) AS total_sales,
       {INCENTIVE} AS incentive, CAST(1700000000000 AS BIGINT) AS run_id
FROM incentives""")

# the window forms must give the same rows as the aggregate forms
SQL["customer_monthly_window"] = SQL["customer_monthly"]
SQL["sales_team_monthly_window"] = SQL["sales_team_monthly"]
SQL["sales_team_rank_window"] = SQL["sales_team_rank"]

# three runs at their instants; P files stay open until the next run that lists them
SQL["ledger_compacted"] = """
WITH deliveries AS (
  SELECT 'drop_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
         'landing/drop_' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_path, o_orderkey + 1000 AS length,
         CAST(o_orderdate AS TIMESTAMP) AS delivered, o_orderstatus, o_orderpriority FROM orders
  UNION ALL
  SELECT 'drop_' || CAST(o_orderkey AS VARCHAR) || '.csv',
         'landing/drop_' || CAST(o_orderkey AS VARCHAR) || '.csv', o_orderkey + 1000,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 DAY, o_orderstatus, o_orderpriority
  FROM orders WHERE o_orderpriority = '5-LOW'
),
runs AS (
  SELECT 1 AS run_id, TIMESTAMP '1997-01-01' AS ends UNION ALL SELECT 2, TIMESTAMP '1999-01-01'
  UNION ALL SELECT 3, TIMESTAMP '2001-01-01'
),
listed AS (
  SELECT run_id, ends, file_name, file_path, length, o_orderstatus, o_orderpriority,
         MAX(delivered) AS modification_time
  FROM deliveries JOIN runs ON delivered < ends GROUP BY ALL
),
nth AS (SELECT *, run_id - MIN(run_id) OVER (PARTITION BY file_path, modification_time) AS n FROM listed),
events AS (
  SELECT *, 'R' AS status, ends AS event_ts, 0 AS seq FROM nth
  WHERE o_orderpriority = '4-NOT SPECIFIED' AND n = 0
  UNION ALL
  SELECT *, 'A', ends, 0 FROM nth
  WHERE o_orderpriority <> '4-NOT SPECIFIED' AND (n = 0 OR (n = 1 AND o_orderstatus = 'P'))
  UNION ALL
  SELECT *, 'I', ends + INTERVAL 1 HOUR, 1 FROM nth
  WHERE o_orderpriority <> '4-NOT SPECIFIED'
    AND n = CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END
)
SELECT file_name, file_path, length, strftime(modification_time, '%Y-%m-%d %H:%M:%S') AS modification_time,
       arg_max(status, (event_ts, seq)) AS status, CAST(MAX(run_id) AS BIGINT) AS run_id,
       strftime(MIN(event_ts), '%Y-%m-%d %H:%M:%S') AS created_ts,
       strftime(MAX(event_ts), '%Y-%m-%d %H:%M:%S') AS updated_ts, COUNT(*) AS n_events
FROM events GROUP BY file_name, file_path, length, events.modification_time"""

# the marts of the stream are those of the batch
SQL["incremental_customer_monthly"] = SQL["customer_monthly"]
SQL["incremental_sales_team_incentive"] = SQL["sales_team_incentive"]
SQL["incentive_report_csv"] = SQL["incentive_report"]

# both deliveries together are the whole fact
SQL["redelivered"] = SQL["conformed_sales"]

SQL["dimension_violations"] = """
SELECT 'customer' AS dimension, 'duplicate key' AS problem, CAST(c_custkey AS VARCHAR) AS subject,
       CAST(2 AS BIGINT) AS n_rows, c_mktsegment = 'BUILDING' AS rows_differ
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
UNION ALL
SELECT 'sales_team', 'null key', 'NULL', COUNT(*), COUNT(DISTINCT s_name) > 1
FROM supplier WHERE s_nationkey = 0 HAVING COUNT(*) > 0
UNION ALL SELECT 'store', 'missing column', 'reviews', NULL, NULL
UNION ALL SELECT 'store', 'type', 'store_pincode', NULL, NULL"""
