"""SQL that reads the sample tables as point-of-sale inputs.

Texts only, in the dialect Spark and DuckDB share, with one placeholder per table.
"""

POS_LINES = """
SELECT CAST(l.l_orderkey AS STRING) AS transaction_id,
       LPAD(CAST(n.n_regionkey + 1 AS STRING), 10, '0') AS store_id,
       r.r_name AS store_name,
       CAST(o.o_orderdate AS DATE) AS log_date,
       CAST(25200 + (o.o_orderkey * 7919) % 54000 AS INT) AS seconds,
       CAST(o.o_custkey % 8 + 1 AS STRING) AS terminal_code,
       CAST(o.o_custkey % 14 + 1 AS STRING) AS cashier_id,
       CAST(l.l_linenumber AS INT) AS sequence,
       CASE WHEN l.l_discount = 1e-1 AND l.l_tax = 0e0 THEN 'OPEN DEPT TOL 5'
            WHEN l.l_discount = 9e-2 AND l.l_tax <= 1e-2
                 THEN CONCAT('OPEN DEPT ', CAST(10 + l.l_suppkey % 25 AS STRING), CAST(l.l_linenumber AS STRING))
            WHEN l.l_discount = 8e-2 AND l.l_tax = 8e-2 THEN 'COUPON'
            WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'F' AND l.l_linenumber <= 3 THEN 'VOID'
            ELSE 'UPC' END AS key_function,
       CASE WHEN l.l_discount = 1e-1 AND l.l_tax = 0e0 THEN ''
            WHEN l.l_discount = 9e-2 AND l.l_tax <= 1e-2 THEN ''
            WHEN l.l_quantity = 5e1 THEN CONCAT('9', LPAD(CAST(l.l_partkey + 1 AS STRING), 13, '0'))
            WHEN l.l_quantity >= 45e0 THEN CAST(l.l_partkey + 1 AS STRING)
            ELSE LPAD(CAST(l.l_partkey + 1 AS STRING), 14, '0') END AS item_id,
       CONCAT(CAST(10 + l.l_suppkey % 25 AS STRING), CAST(l.l_linenumber AS STRING)) AS raw_department,
       CONCAT(CASE WHEN l.l_linestatus = 'F' AND l.l_returnflag = 'R' THEN 'R'
                   WHEN l.l_linestatus = 'F' AND l.l_returnflag = 'A' THEN 'C' ELSE '' END,
              CASE WHEN l.l_quantity <= 1e1 THEN 'W' ELSE '' END,
              CASE WHEN l.l_quantity <= 25e0 THEN 'F' ELSE '' END,
              CASE WHEN l.l_tax > 4e-2 THEN 'T' ELSE '' END) AS attribute_flag,
       CAST(CASE WHEN l.l_linestatus = 'F' AND l.l_returnflag <> 'N' THEN -l.l_quantity
                 ELSE l.l_quantity END AS DECIMAL(18,3)) AS quantity,
       CAST(FLOOR(ROUND(l.l_extendedprice * 1e2) / l.l_quantity) / 1e2 AS DECIMAL(18,2)) AS unit_price,
       CAST(CASE WHEN l.l_linestatus = 'F' AND l.l_returnflag <> 'N' THEN -l.l_extendedprice
                 ELSE l.l_extendedprice END AS DECIMAL(18,2)) AS extended_price,
       CASE WHEN l.l_discount = 0e0 THEN 'B' WHEN l.l_discount <= 3e-2 THEN 'T'
            WHEN l.l_discount <= 6e-2 THEN 'S' WHEN l.l_discount <= 9e-2 THEN 'L' ELSE 'E' END AS retail_type,
       CAST(CASE WHEN l.l_discount > 6e-2 AND l.l_discount <= 9e-2
                 THEN ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)), 2)
                 ELSE 0 END AS DECIMAL(18,2)) AS loyalty_discount,
       CAST(CASE WHEN l.l_discount > 0e0 AND l.l_discount <= 6e-2
                 THEN ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)), 2)
                 ELSE 0 END AS DECIMAL(18,2)) AS premium_discount,
       '' AS loyalty_code,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'CASH' WHEN '2-HIGH' THEN 'VISA' WHEN '3-MEDIUM' THEN 'DEBIT'
            WHEN '4-NOT SPECIFIED' THEN 'EBT FOOD' ELSE '' END AS tender_type
  FROM {lineitem} l
  JOIN {orders} o ON o.o_orderkey = l.l_orderkey
  JOIN {customer} c ON c.c_custkey = o.o_custkey
  JOIN {nation} n ON n.n_nationkey = c.c_nationkey
  JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""

# The tender line and the totals record of each order.
POS_CLOSING = """
SELECT CAST(o.o_orderkey AS STRING) AS transaction_id,
       LPAD(CAST(n.n_regionkey + 1 AS STRING), 10, '0') AS store_id,
       CAST(o.o_orderdate AS DATE) AS log_date,
       CAST(25200 + (o.o_orderkey * 7919) % 54000 AS INT) AS seconds,
       CAST(o.o_custkey % 8 + 1 AS STRING) AS terminal_code,
       CAST(o.o_custkey % 14 + 1 AS STRING) AS cashier_id,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount,
       CAST(ROUND(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS tax_total,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'CASH' WHEN '2-HIGH' THEN 'VISA' WHEN '3-MEDIUM' THEN 'DEBIT'
            WHEN '4-NOT SPECIFIED' THEN 'EBT FOOD' ELSE '' END AS tender_type
  FROM {orders} o
  JOIN {customer} c ON c.c_custkey = o.o_custkey
  JOIN {nation} n ON n.n_nationkey = c.c_nationkey
"""

ITEM_MASTER = """
SELECT p_partkey AS ord,
       LPAD(CAST(p_partkey + 1 AS STRING), 14, '0') AS item_id,
       CONCAT(UPPER(p_name), ' ', CAST(p_size AS STRING), ' OZ') AS item_desc,
       UPPER(p_name) AS product_key,
       CAST(9 + CAST(SUBSTR(p_brand, 7) AS INT) + CASE WHEN p_size = 50 THEN 1 ELSE 0 END AS STRING) AS department_code,
       p_brand AS department_name,
       CONCAT(CAST(9 + CAST(SUBSTR(p_brand, 7) AS INT) AS STRING), CAST(p_size % 10 AS STRING)) AS category_code,
       p_type AS category_name,
       CONCAT('VENDOR ', p_type) AS vendor,
       CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
       CAST(CASE WHEN p_size % 7 = 0 THEN 0
                 ELSE CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)) END AS DECIMAL(18,4)) AS unit_cost
  FROM {part}
"""

PRICE_BOOK = """
SELECT p_partkey AS ord,
       CASE WHEN p_size % 3 = 0 THEN ''
            ELSE CONCAT('4-', LPAD(CAST(p_partkey + 1 AS STRING), 10, '0'), '-', CAST(p_size % 10 AS STRING)) END AS "Upc with Dashes",
       CASE WHEN p_size % 2 = 0 THEN CONCAT('4.', SUBSTR(LPAD(CAST(p_partkey + 1 AS STRING), 10, '0'), 1, 5), 'E+11')
            ELSE CONCAT('4', LPAD(CAST(p_partkey + 1 AS STRING), 10, '0'), CAST(p_size % 10 AS STRING)) END AS "UPC",
       CASE WHEN p_size = 13 OR (p_size = 17 AND p_type = 'LARGE') THEN ''
            ELSE CONCAT(p_name, '  ', CAST(p_size AS STRING), CASE WHEN p_size % 2 = 0 THEN ' ounces, each' ELSE ' LBS' END) END AS "Description",
       CASE WHEN p_size = 17 THEN '' ELSE CONCAT(p_name, ' reg ', p_type) END AS "POS Description",
       CAST(9 + CAST(SUBSTR(p_brand, 7) AS INT) AS STRING) AS "Department",
       CONCAT(CAST(9 + CAST(SUBSTR(p_brand, 7) AS INT) AS STRING), CAST(p_size % 10 AS STRING)) AS "Dept 4",
       CASE WHEN p_size % 4 = 0 THEN '' ELSE p_type END AS "Category Name",
       CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS STRING) END AS "Sub Category",
       CASE WHEN p_size = 31 THEN '-' WHEN p_size = 12 THEN '#NAME?' WHEN p_size = 11 THEN '99¢'
            ELSE CONCAT('$', CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING)) END AS "Retail w/o dollar sign",
       CASE WHEN p_size = 31 THEN '' ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) END AS "Price w/o dollar sign",
       CASE WHEN p_size % 7 = 0 THEN '' WHEN p_size = 5 THEN '0'
            WHEN p_size = 6 THEN CAST(CAST(p_retailprice * 2 AS DECIMAL(18,2)) AS STRING)
            ELSE CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.4 AS DECIMAL(2,1))
                           + CAST(p_size AS DECIMAL(4,0)) AS DECIMAL(18,2)) AS STRING) END AS "Cost",
       CASE WHEN p_size = 14 THEN CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,2)) AS STRING)
            ELSE '' END AS "Base Unit Cost",
       p_brand AS "Brand",
       CONCAT('Vendor ', p_type) AS "Vendor Name",
       CASE WHEN p_size <= 25 THEN 'yes' ELSE 'no' END AS "Food Stamp",
       CASE WHEN p_size <= 10 THEN 'wic' ELSE '' END AS "WIC"
  FROM {part}
"""

# One row per item, store and week: what a weekly movement report lists.
MOVEMENT_ROWS = """
SELECT LPAD(CAST(n.n_regionkey + 1 AS STRING), 6, '0') AS store_no,
       r.r_name AS store_name,
       CAST(DATE_TRUNC('week', o.o_orderdate) AS DATE) AS week_start,
       l.l_partkey AS part_no,
       MIN(p.p_name) AS description,
       MIN(p.p_brand) AS brand,
       MIN(p.p_type) AS category,
       SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS qty,
       SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS sales,
       MIN(CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,2))) AS cost,
       MIN(p.p_size) AS size
  FROM {lineitem} l
  JOIN {orders} o ON o.o_orderkey = l.l_orderkey
  JOIN {customer} c ON c.c_custkey = o.o_custkey
  JOIN {nation} n ON n.n_nationkey = c.c_nationkey
  JOIN {region} r ON r.r_regionkey = n.n_regionkey
  JOIN {part} p ON p.p_partkey = l.l_partkey
 GROUP BY n.n_regionkey, r.r_name, CAST(DATE_TRUNC('week', o.o_orderdate) AS DATE), l.l_partkey
"""

QUERY_LOG = """
SELECT event_id AS query_id, ts,
       CASE event_type
            WHEN 'view' THEN 'SELECT department_name, SUM(revenue) FROM rollup_dept WHERE year = 2001 AND month IN (7, 8) GROUP BY 1'
            WHEN 'click' THEN CONCAT('SELECT * FROM detail WHERE year >= ', CAST(1995 + user_id % 7 AS STRING))
            WHEN 'error' THEN 'SELECT SUM(revenue) FROM rollup_item'
            WHEN 'signup' THEN 'SHOW TABLES'
            ELSE CONCAT('DELETE FROM detail WHERE day = ', CAST(user_id AS STRING)) END AS sql,
       CAST(ROUND(value * 1e9) AS BIGINT) AS bytes
  FROM {events}
"""
