"""SQL for the registered queries, written on its own: joins and windows as the job defines them."""

from __future__ import annotations

# The supplied tables as sales and dimensions.
_SALES = """
sales AS (
  SELECT o_custkey AS customer_id, CAST(s_nationkey AS BIGINT) AS store_id,
         p_name AS product_name, CAST(o_orderdate AS DATE) AS sales_date,
         l_suppkey AS sales_person_id, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS total_cost,
         substring(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) AS sales_month,
         l_returnflag, l_linestatus
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey)"""

_DIMS = """
cust AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name, n_name AS address,
         lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS pincode,
         '91' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone_number
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE {customer_filter}),
store AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS address, r_name AS store_manager_name
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE {store_filter}),
team AS (
  SELECT s_suppkey AS id, split_part(s_name, '#', 1) AS first_name,
         split_part(s_name, '#', 2) AS last_name, CAST(s_nationkey AS BIGINT) AS manager_id,
         CASE WHEN s_acctbal > 0 THEN 'N' ELSE 'Y' END AS is_manager, n_name AS address,
         lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS pincode
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE {seller_filter})"""

_WHOLE = "WITH" + _SALES + "," + _DIMS.format(
    customer_filter="TRUE", store_filter="TRUE", seller_filter="TRUE")
_NARROWED = "WITH" + _SALES + "," + _DIMS.format(
    customer_filter="c_acctbal > 0", store_filter="r_name <> 'ASIA'",
    seller_filter="s_acctbal > 0")
_FACTS = "WITH" + _SALES

_STAR = """
  FROM sales s
  JOIN cust c ON s.customer_id = c.customer_id
  JOIN store st ON s.store_id = st.id
  JOIN team t ON s.sales_person_id = t.id"""

_CUSTOMER_MONTHLY = """
SELECT DISTINCT s.customer_id, c.first_name || ' ' || c.last_name AS full_name, c.address,
       c.phone_number, s.sales_month AS sales_date_month,
       CAST(sum(s.total_cost) OVER (PARTITION BY s.customer_id, s.sales_month)
            AS DECIMAL(18,2)) AS total_sales""" + _STAR

_SELLER_TOTALS = """
totals AS (
  SELECT DISTINCT s.store_id, s.sales_person_id,
         t.first_name || ' ' || t.last_name AS full_name, s.sales_month,
         CAST(sum(s.total_cost) OVER (PARTITION BY s.store_id, s.sales_person_id, s.sales_month)
              AS DECIMAL(18,2)) AS total_sales""" + _STAR + ")"

_RANKED = _SELLER_TOTALS + """,
ranked AS (
  SELECT *, rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST)
            AS rnk
  FROM totals)"""

_INCENTIVE = _RANKED + """
SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
       CAST(CASE WHEN rnk = 1 THEN round(total_sales * 0.01, 2) ELSE 0 END AS DECIMAL(18,2))
         AS incentive
FROM ranked"""

_CUSTOMER_MART = """
SELECT s.customer_id, c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
       CAST(s.sales_date AS VARCHAR) AS sales_date, s.total_cost""" + _STAR

_TEAM_MART = """
SELECT s.store_id, s.sales_person_id, t.first_name, t.last_name, st.store_manager_name,
       t.manager_id, t.is_manager, t.address, t.pincode, c.phone_number,
       CAST(s.sales_date AS VARCHAR) AS sales_date, s.total_cost, s.sales_month""" + _STAR

_CANONICAL = """customer_id, store_id, product_name, CAST(sales_date AS VARCHAR) AS sales_date,
       sales_person_id, price, quantity, total_cost"""

# Landed files: the shape of a sale's file, and its line of text.
_SHAPE = """CASE l_returnflag WHEN 'A' THEN 'plain' WHEN 'N' THEN 'extra' ELSE 'reordered' END"""
_EXTRAS = """CASE WHEN l_returnflag = 'N' THEN
         CASE WHEN l_linestatus = 'O' THEN 'cash,' ELSE '' END || 'c' || customer_id END"""


def _line(*columns: str) -> str:
    return " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)


_COLUMNS = ("customer_id", "store_id", "product_name", "sales_date", "sales_person_id", "price",
            "'n/a'", "total_cost")
_PLAIN_LINE = _line(*_COLUMNS)
_REORDERED_LINE = _line(*reversed(_COLUMNS))
_NO_STORE_LINE = _line("customer_id", "product_name", "sales_date", "sales_person_id", "price",
                       "quantity", "total_cost")

# Lines with faults of several kinds.
_LATE = "(l_linestatus = 'O' AND quantity < 10)"
_FAULTY_LINE = _line(
    "customer_id", "store_id", "product_name",
    f"CASE WHEN {_LATE} THEN 'soon' ELSE CAST(sales_date AS VARCHAR) END", "sales_person_id",
    "CASE WHEN quantity < 5 THEN 'free' ELSE CAST(price AS VARCHAR) END",
    "CASE WHEN quantity > 45 THEN 'n/a' ELSE CAST(quantity AS VARCHAR) END") + """
  || CASE WHEN quantity = 30 THEN '' ELSE ',' || CAST(total_cost AS VARCHAR) END
  || CASE WHEN quantity = 20 THEN ',more' ELSE '' END"""

# Fixed value: the header of a sales file.
_MANDATORY = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"
_REVERSED = ",".join(reversed(_MANDATORY.split(",")))
_HEADERS = {
    "plain": _MANDATORY,
    "extra": _MANDATORY + ",payment_mode,coupon",
    "reordered": _REVERSED,
    "no_store": _MANDATORY.replace("store_id,", ""),
}


_ORDER_FILES = "'order_' || CAST(o_orderkey AS VARCHAR) || '.csv'"

_TAKEN = "o_orderpriority NOT LIKE '5%'"
_REOPENED = "(o_orderstatus = 'F' AND o_orderpriority LIKE '1%')"
_CLOSED = f"(o_orderstatus = 'F' AND NOT {_REOPENED})"

# Files of every shape that some sale has, one for each begun ten thousand sales.
_LANDED = "SELECT shape FROM (SELECT shape, unnest(range(count(*) // 10000 + 1)) FROM (SELECT " + _SHAPE + """
  AS shape FROM lineitem UNION ALL SELECT 'no_store' FROM lineitem) GROUP BY shape)"""
_NOTES = "SELECT 'notes' AS shape FROM range(3)"

_ODD_KIND = "['good', '_hidden', 'tab_first', 'empty', 'damaged', 'packed'][n_nationkey % 6 + 1]"
_ODD_FILES = f"""
SELECT {_ODD_KIND} AS kind, {_ODD_KIND} || '_' || n_nationkey ||
       CASE WHEN {_ODD_KIND} IN ('damaged', 'packed') THEN '.csv.gz' ELSE '.csv' END AS odd_file
FROM nation"""

_ENRICHED = _WHOLE + """
SELECT s.customer_id, s.store_id, CAST(s.sales_date AS VARCHAR) AS sales_date, s.sales_person_id,
       s.total_cost, c.first_name AS customer_first_name, c.last_name AS customer_last_name,
       c.address AS customer_address, c.pincode AS customer_pincode, c.phone_number,
       st.address AS store_address, st.store_manager_name, t.first_name AS seller_first_name,
       t.last_name AS seller_last_name, t.manager_id, t.is_manager, t.address AS seller_address,
       t.pincode AS seller_pincode, CAST(NULL AS VARCHAR) AS seller_joining_date""" + _STAR

ORACLES: dict[str, str] = {
    "seller_monthly_incentive": _WHOLE + "," + _INCENTIVE,
    "seller_monthly_sales": _WHOLE + "," + _SELLER_TOTALS + "\nSELECT * FROM totals",
    "customer_monthly_sales": _WHOLE + _CUSTOMER_MONTHLY,
    "customer_mart": _WHOLE + _CUSTOMER_MART,
    "sales_team_mart": _WHOLE + _TEAM_MART,
    "sales_team_mart_partitioned": _WHOLE + _TEAM_MART,
    "seller_monthly_incentive_shuffled": _WHOLE + "," + _INCENTIVE,
    "customer_monthly_sales_shuffled": _WHOLE + _CUSTOMER_MONTHLY,
    "enrich_customer": _WHOLE + """
SELECT s.customer_id, s.store_id, CAST(s.sales_date AS VARCHAR) AS sales_date, s.sales_person_id,
       s.total_cost, c.first_name AS customer_first_name, c.last_name AS customer_last_name,
       c.address AS customer_address, c.pincode AS customer_pincode, c.phone_number
FROM sales s JOIN cust c ON s.customer_id = c.customer_id""",
    "enrich_store": _WHOLE + f"""
SELECT {_CANONICAL}, CAST(NULL AS VARCHAR) AS additional_column, st.address AS store_address,
       st.store_manager_name
FROM sales JOIN store st ON store_id = st.id""",
    "enrich_seller": _WHOLE + f"""
SELECT {_CANONICAL}, CAST(NULL AS VARCHAR) AS additional_column,
       t.first_name AS seller_first_name, t.last_name AS seller_last_name, t.manager_id,
       t.is_manager, t.address AS seller_address, t.pincode AS seller_pincode,
       CAST(NULL AS VARCHAR) AS seller_joining_date
FROM sales JOIN team t ON sales_person_id = t.id""",
    "enrich_sales": _ENRICHED,
    "enrich_sales_shuffled": _ENRICHED,
    "unmatched_sales": _NARROWED + f""",
marked AS (
  SELECT *, concat_ws(',',
           CASE WHEN NOT EXISTS (SELECT 1 FROM cust c WHERE c.customer_id = s.customer_id)
                THEN 'customer' END,
           CASE WHEN NOT EXISTS (SELECT 1 FROM store st WHERE st.id = s.store_id)
                THEN 'store' END,
           CASE WHEN NOT EXISTS (SELECT 1 FROM team t WHERE t.id = s.sales_person_id)
                THEN 'sales_team' END) AS unmatched
  FROM sales s)
SELECT {_CANONICAL}, CAST(NULL AS VARCHAR) AS additional_column, unmatched
FROM marked WHERE unmatched <> ''""",
    "customer_month_window_total": _FACTS + """
SELECT customer_id, CAST(sales_date AS VARCHAR) AS sales_date, total_cost, sales_month,
       CAST(sum(total_cost) OVER (PARTITION BY customer_id, sales_month) AS DECIMAL(28,2))
         AS month_total
FROM sales""",
    "seller_month_window_total": _FACTS + """
SELECT store_id, sales_person_id, CAST(sales_date AS VARCHAR) AS sales_date, total_cost,
       sales_month,
       CAST(sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month)
            AS DECIMAL(28,2)) AS month_total
FROM sales""",
    "rank_sellers": _WHOLE + "," + _RANKED + "\nSELECT * FROM ranked",
    "rank_many_sellers": _WHOLE + "," + _RANKED + "\nSELECT * FROM ranked",
    "sales_months": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS sales_month,
       strftime(o_orderdate, '%Y-%m') AS sales_month_sql
FROM orders""",
    "full_names": """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN replace(c_name, '#', ' ') END AS full_name
FROM customer""",
    "packed_extras": """
SELECT l_orderkey, l_linenumber,
       concat_ws(',', CASE WHEN l_returnflag <> 'R' THEN l_returnflag END,
                      CASE WHEN l_linestatus = 'O' THEN l_linestatus END) AS additional_column,
       '{' || concat_ws(',',
                CASE WHEN l_returnflag <> 'R' THEN '"flag":"' || l_returnflag || '"' END,
                CASE WHEN l_linestatus = 'O' THEN '"line":"' || l_linestatus || '"' END) || '}'
         AS additional_json,
       CAST(NULL AS VARCHAR) AS no_extras
FROM lineitem""",
    "incentive_amounts": """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       CAST(CASE WHEN l_returnflag = 'R'
                 THEN round(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01, 2) ELSE 0 END
            AS DECIMAL(18,2)) AS incentive
FROM lineitem""",
    "distinct_customer_months": _FACTS + "\nSELECT DISTINCT customer_id, sales_month FROM sales",
    "union_all_sales": _FACTS + f"""
SELECT {_CANONICAL}, CAST(NULL AS VARCHAR) AS additional_column FROM sales
UNION ALL
SELECT {_CANONICAL}, CAST(NULL AS VARCHAR) AS additional_column FROM sales""",
    "extension_triage": f"""
SELECT shape, TRUE AS is_csv FROM ({_LANDED}) UNION ALL SELECT shape, FALSE FROM ({_NOTES})""",
    "file_headers": f"""
WITH landed AS ({_LANDED}),
headers AS (
  SELECT shape, CASE shape
    {" ".join(f"WHEN '{s}' THEN '{h}'" for s, h in _HEADERS.items())} END AS header
  FROM landed)
SELECT 'peek' AS method, shape, header FROM headers
UNION ALL
SELECT 'scan', shape, header FROM headers""",
    "manifest": f"""
WITH landed AS ({_LANDED} UNION ALL {_NOTES})
SELECT shape, shape NOT IN ('no_store', 'notes') AS accepted,
       CASE WHEN shape = 'no_store' THEN 'store_id' ELSE '' END AS missing,
       CASE WHEN shape = 'extra' THEN 'payment_mode,coupon' ELSE '' END AS extras,
       CASE shape WHEN 'no_store' THEN 'missing columns: store_id'
                  WHEN 'notes' THEN 'not a .csv file' END AS reason
FROM landed""",
    "file_accounting": f"""
WITH landed AS ({_LANDED} UNION ALL {_NOTES}), odd AS ({_ODD_FILES}), files AS (
  SELECT shape AS folder, NULL AS odd_file, shape NOT IN ('no_store', 'notes') AS accepted,
         CASE shape WHEN 'no_store' THEN 'missing columns: store_id'
                    WHEN 'notes' THEN 'not a .csv file' END AS reason FROM landed
  UNION ALL
  SELECT 'odd', odd_file, kind IN ('good', 'tab_first'),
         CASE kind WHEN '_hidden' THEN 'name begins with _ or .'
                   WHEN 'empty' THEN 'missing columns: {_MANDATORY}'
                   WHEN 'damaged' THEN 'not a .csv file' WHEN 'packed' THEN 'not a .csv file' END
  FROM odd)
SELECT 'peek' AS method, * FROM files UNION ALL SELECT 'scan', * FROM files""",
    "conformed_union": _FACTS + f"""
SELECT {_CANONICAL}, {_EXTRAS} AS additional_column FROM sales""",
    "well_formed_rows": _FACTS + f"""
SELECT {_CANONICAL}, {_EXTRAS} AS additional_column FROM sales WHERE quantity <= 45""",
    "malformed_rows": _FACTS + f"""
SELECT {_SHAPE} AS shape,
       CASE l_returnflag
         WHEN 'A' THEN {_PLAIN_LINE}
         WHEN 'N' THEN {_PLAIN_LINE} || ',' ||
           CASE WHEN l_linestatus = 'O' THEN 'cash' ELSE '' END || ',c' || customer_id
         ELSE {_REORDERED_LINE} END AS line
FROM sales WHERE quantity > 45""",
    "row_faults": _FACTS + f"""
SELECT {_FAULTY_LINE} AS line,
       CASE WHEN quantity IN (20, 30) THEN 'number of cells'
            ELSE concat_ws(',', CASE WHEN {_LATE} THEN 'sales_date' END,
                           CASE WHEN quantity < 5 THEN 'price' END,
                           CASE WHEN quantity > 45 THEN 'quantity' END) END AS faults
FROM sales WHERE quantity IN (20, 30) OR quantity > 45 OR quantity < 5 OR {_LATE}""",
    "many_headers_union": _FACTS + f"""
SELECT {_CANONICAL},
       l_returnflag || CASE WHEN CAST(sales_month[6:7] AS INTEGER) % 2 = 1 THEN ',' || l_linestatus
                            ELSE '' END AS additional_column
FROM sales""",
    "quarantined_lines": _FACTS + f"""
SELECT 'no_store' AS shape, {_NO_STORE_LINE} AS line, 'missing columns: store_id' AS reason
FROM sales
UNION ALL
SELECT 'notes', r_name, 'not a .csv file' FROM region""",
    "snapshot_latest": _WHOLE + _CUSTOMER_MART,
    "run_whole_batch": _WHOLE + "," + _INCENTIVE,
    "batch_customer_mart": _WHOLE + _CUSTOMER_MART,
    "batch_sales_team_mart": _WHOLE + _TEAM_MART,
    "customer_monthly_sales_bucketed": _WHOLE + _CUSTOMER_MONTHLY,
    "batch_customer_monthly": _WHOLE + _CUSTOMER_MONTHLY,
    "batch_ledger": f"""
SELECT shape AS folder, 'I' AS status, '1704067200000' AS run_id
FROM ({_LANDED}) WHERE shape <> 'no_store'
UNION ALL
SELECT 'odd', 'I', '1704067200000' FROM ({_ODD_FILES}) WHERE kind IN ('good', 'tab_first')""",
    "arrived_files": f"""
SELECT shape, CASE WHEN shape IN ('reordered', 'no_store') THEN '1' ELSE '0' END AS run_id,
       CASE shape WHEN 'no_store' THEN 'missing columns: store_id'
                  WHEN 'notes' THEN 'not a .csv file' END AS reason,
       CASE WHEN shape IN ('reordered', 'no_store') THEN 'landing' ELSE 'archive' END AS place
FROM ({_LANDED} UNION ALL {_NOTES})""",
    "arrived_sales": _WHOLE + _CUSTOMER_MART.replace(
        "s.total_cost", "s.total_cost, CAST(l_returnflag = 'R' AS INTEGER) AS run", 1),
    "arrived_seller_months": _WHOLE + "," + _INCENTIVE,
    "arrived_customer_months": _WHOLE + _CUSTOMER_MONTHLY,
    "read_dimension_table": """
SELECT *, 'parquet' AS read_as FROM customer UNION ALL SELECT *, 'csv' FROM customer""",
    "append_table": _WHOLE + ", result AS (" + _CUSTOMER_MONTHLY + """)
SELECT result.*, '1' AS run_id FROM result
UNION ALL
SELECT result.*, '2' FROM result""",
    "append_committed_table": "@append_table",
    "ledger_state": f"""
SELECT {_ORDER_FILES} AS file_name, 'in/' || {_ORDER_FILES} AS file_location,
       CASE WHEN {_CLOSED} THEN 'I' ELSE 'A' END AS status,
       CASE WHEN {_REOPENED} THEN '2' ELSE '1' END AS run_id, '2024-01-01' AS created_date,
       CASE WHEN o_orderstatus = 'F' THEN '2024-01-02' END AS updated_date
FROM orders WHERE {_TAKEN}""",
    "ledger_snapshots": "@ledger_state",
    "active_file_names": f"""
WITH active AS (SELECT DISTINCT {_ORDER_FILES} AS file_name FROM orders WHERE {_TAKEN} AND NOT {_CLOSED})
SELECT file_name, 'all' AS among FROM active
UNION ALL
SELECT file_name, 'asked' FROM active
WHERE file_name IN ('order_0.csv', 'order_1.csv', 'order_2.csv', 'order_3.csv', 'order_none.csv')""",
    "unfinished_files": f"""
SELECT 'in/' || {_ORDER_FILES} AS path FROM orders WHERE {_TAKEN} AND NOT {_CLOSED}""",
    "files_to_process": f"""
SELECT 'in/' || {_ORDER_FILES} AS path FROM orders WHERE NOT ({_TAKEN} AND {_CLOSED})""",
}
# Queries that come to the same rows another way.
ORACLES |= {name: ORACLES[sql[1:]] for name, sql in ORACLES.items() if sql.startswith("@")}
