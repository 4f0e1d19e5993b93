"""One statement per key. Common table expressions below are put in front of the ones that use them."""

from __future__ import annotations

import re

from basketlake.fixed_values import CATEGORY_SEASONS, DEPARTMENT_ALIASES, SEARCH_STOP_WORDS, SEASON_RULES, TARGET_REVENUE_SHARE
from basketlake.fixed_values import DEPARTMENTS, SECRET_PATTERNS
from basketlake.sources import mapping

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")


def plain(sql: str) -> str:
    for name in TABLES:
        sql = sql.replace(f"{{{name}}}", name)
    return sql.strip()


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CTES: dict[str, str] = {
    "pos": plain(mapping.POS_LINES),
    "closing": plain(mapping.POS_CLOSING),
    "master": plain(mapping.ITEM_MASTER),
    "book": plain(mapping.PRICE_BOOK),
    "weeks": plain(mapping.MOVEMENT_ROWS),
    "log": plain(mapping.QUERY_LOG),
}

CTES["items"] = """
SELECT *, CAST(log_date AS TIMESTAMP) + to_seconds(seconds) AS transaction_ts,
       CASE WHEN key_function = 'VOID' OR contains(attribute_flag, 'C') THEN 'VOID'
            WHEN contains(attribute_flag, 'R') THEN 'RETURN'
            WHEN contains(key_function, 'COUPON') THEN 'COUPON' ELSE 'SALE' END AS transaction_type
  FROM pos"""
CTES["votes"] = """
SELECT category_code AS subdepartment, department_code, count(*) AS votes,
       row_number() OVER (PARTITION BY category_code ORDER BY count(*) DESC, min(ord)) AS choice
  FROM master GROUP BY category_code, department_code"""
CTES["names"] = "SELECT department_code, arg_max(department_name, ord) AS department_name FROM master GROUP BY department_code"
CTES["detail"] = """
SELECT i.transaction_id, i.store_id, i.store_name, i.transaction_ts, i.log_date AS sale_date, i.terminal_code, i.cashier_id,
       i.sequence, i.key_function, i.item_id, i.transaction_type, i.quantity AS units, i.unit_price,
       i.extended_price AS revenue, i.retail_type, i.tender_type, i.attribute_flag,
       i.loyalty_discount + i.premium_discount AS discount,
       CASE WHEN contains(i.attribute_flag, 'W') THEN 1 ELSE 0 END AS is_wic,
       CASE WHEN contains(i.attribute_flag, 'F') THEN 1 ELSE 0 END AS is_food_stamp,
       CASE WHEN m.ord IS NOT NULL THEN m.item_desc
            WHEN starts_with(i.key_function, 'OPEN DEPT TOL') THEN 'Promotional discount (TOL 5)'
            WHEN starts_with(i.key_function, 'OPEN DEPT')
                 THEN coalesce(n.department_name, 'Dept ' || coalesce(v.department_code, i.raw_department)) || ' - open department key'
            ELSE 'Unknown barcode ' || i.item_id END AS item_desc,
       CASE WHEN m.ord IS NOT NULL THEN m.product_key
            WHEN starts_with(i.key_function, 'OPEN DEPT TOL') THEN 'PROMOTIONAL DISCOUNT'
            WHEN starts_with(i.key_function, 'OPEN DEPT') THEN 'OPEN DEPT ' || coalesce(v.department_code, i.raw_department)
            ELSE 'UNKNOWN BARCODE ' || i.item_id END AS product_key,
       CASE WHEN m.ord IS NOT NULL THEN m.department_code
            WHEN starts_with(i.key_function, 'OPEN DEPT TOL') THEN i.raw_department
            ELSE coalesce(v.department_code, i.raw_department) END AS department_code,
       CASE WHEN m.ord IS NOT NULL THEN m.department_name
            WHEN starts_with(i.key_function, 'OPEN DEPT TOL') THEN 'Promotions'
            ELSE coalesce(n.department_name, 'Dept ' || coalesce(v.department_code, i.raw_department)) END AS department_name,
       CASE WHEN m.ord IS NOT NULL THEN m.category_name
            WHEN starts_with(i.key_function, 'OPEN DEPT TOL') THEN 'Promotional discount'
            WHEN starts_with(i.key_function, 'OPEN DEPT') THEN 'Open department' ELSE 'Unmatched' END AS category_name,
       coalesce(m.vendor, '') AS vendor, coalesce(m.unit_cost, 0) AS unit_cost,
       CASE WHEN coalesce(m.unit_cost, 0) <> 0 THEN CAST(round(i.extended_price - m.unit_cost * i.quantity, 2) AS DECIMAL(18,2))
            ELSE 0 END AS margin
  FROM items i
  LEFT JOIN master m ON ltrim(m.item_id, '0') = ltrim(i.item_id, '0') AND i.item_id <> ''
  LEFT JOIN votes v ON v.subdepartment = i.raw_department AND v.choice = 1
  LEFT JOIN names n ON n.department_code = coalesce(v.department_code, i.raw_department)"""
CTES["sold"] = "SELECT * FROM detail WHERE transaction_type = 'SALE'"
CTES["recent"] = "SELECT * FROM sold WHERE sale_date BETWEEN DATE '2001-05-03' AND DATE '2001-08-01'"

ORACLES: dict[str, str] = {}


def _collect(sql: str, found: list[str]) -> None:
    """CTEs a statement uses, in the order they have to stand in."""
    for name in CTES:
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            _collect(CTES[name], found)
            found.append(name)


def oracle(key: str, sql: str) -> None:
    used: list[str] = []
    _collect(sql, used)
    head = ", ".join(f"{name} AS ({CTES[name]})" for name in used)
    sql = sql.strip()
    if head and sql.upper().startswith("WITH "):
        sql = f"WITH {head}, {sql[5:]}"
    elif head:
        sql = f"WITH {head} {sql}"
    ORACLES[key] = sql


def d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def share(part: str, whole: str, factor: str = " * 100") -> str:
    return f"{d(part)} / nullif({d(whole)}, 0){factor}"


# --- raw log -------------------------------------------------------------------------------------

CTES["raw"] = """
SELECT transaction_id, store_id, log_date, seconds, sequence, key_function, item_id, extended_price AS ext_sales,
       attribute_flag, 1 AS is_item FROM pos
UNION ALL SELECT transaction_id, store_id, log_date, seconds, 90, 'TENDER', tender_type, 0, '', 0 FROM closing
UNION ALL SELECT transaction_id, store_id, log_date, seconds, 0, '', '', 0, '', 0 FROM closing"""
_FILE = "concat('TLOG_', strftime(log_date, '%Y-%m-%d'), '_1_', store_id)"

oracle("raw_scan", f"SELECT store_id AS store_code, key_function, count(*) AS lines, {d('sum(ext_sales)')} AS ext_sales FROM raw GROUP BY ALL")
oracle("raw_partitions", "SELECT CAST(year(log_date) AS INT) AS year, CAST(month(log_date) AS INT) AS month, count(*) AS lines FROM raw GROUP BY ALL")


def _n(column: str) -> str:
    return f"regexp_replace(regexp_replace(CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR), '0+$', ''), '[.]$', '')"


def _record(sequence, key, ident, dept, retail, count, ext, tender, flag, kind, loyalty, premium, sub, tax, total) -> str:
    q = "'\"'"
    parts = [
        f"{q} || strftime(log_date, '%m/%d/%Y') || {q}", "CAST(seconds AS VARCHAR)", "terminal_code", "cashier_id",
        f"CAST({sequence} AS VARCHAR)", f"{q} || {key} || {q}", f"{q} || {ident} || {q}", dept, "'0'", retail, count, "'0'",
        ext, tender, f"{q} || {flag} || {q}", "'\"\"'", "'0'", "'0'", "'0'", f"{q} || {kind} || {q}", loyalty, premium,
        "'\"\"'", sub, tax, total, "'0'", "'0'", "'0'", f"{q} || transaction_id || {q}", "'0'", "'0'", "'\"\"'",
        f"{q} || store_id || {q}", "'0'", "'0'",
    ]
    return "concat_ws(',', " + ", ".join(parts) + ")"


oracle("tlog_render", f"""
SELECT {_FILE} AS file, CAST(transaction_id AS BIGINT) * 100 + sequence AS ord,
       {_record('sequence', 'key_function', 'item_id', 'raw_department', _n('unit_price'), _n('quantity'), _n('extended_price'),
                "'0'", 'attribute_flag', 'retail_type', _n('loyalty_discount'), _n('premium_discount'), "'0'", "'0'", "'0'")} AS line
  FROM pos
UNION ALL
SELECT {_FILE}, CAST(transaction_id AS BIGINT) * 100 + 90,
       {_record('90', "'TENDER'", 'tender_type', "'0'", "'0'", "'0'", "'0'", _n('total_amount'), "''", "'B'", "'0'", "'0'", "'0'", "'0'", "'0'")}
  FROM closing
UNION ALL
SELECT {_FILE}, CAST(transaction_id AS BIGINT) * 100 + 99,
       {_record('0', "''", "''", "'0'", "'0'", "'0'", "'0'", "'0'", "''", "'B'", "'0'", "'0'", _n('total_amount - tax_total'), _n('tax_total'), _n('total_amount'))}
  FROM closing""")
oracle("tlog_parse_roundtrip", f"""
SELECT transaction_id, store_id, transaction_ts, terminal_code, cashier_id, sequence, key_function, item_id, transaction_type,
       {d('quantity')} AS quantity, {d('unit_price')} AS unit_price, {d('extended_price')} AS extended_price FROM items""")
oracle("tlog_filename", "SELECT DISTINCT concat(strftime(log_date, '%Y-%m-%d'), '_', transaction_id, '_', store_id, '.txt') AS name FROM raw")
oracle("file_name_meta", f"SELECT DISTINCT concat({_FILE}, '.DAT') AS name, log_date AS file_date, store_id AS store_code FROM raw")
oracle("files_since", f"SELECT DISTINCT concat({_FILE}, '.DAT') AS name FROM raw WHERE log_date >= DATE '2000-01-01'")
_PARTS = "CAST(year(log_date) AS INT) AS year, CAST(month(log_date) AS INT) AS month"
oracle("incremental_partitions", f"SELECT DISTINCT store_id AS store, {_PARTS}, CAST(day(log_date) AS INT) AS day FROM raw WHERE log_date >= DATE '2001-07-29'")
oracle("months_touched", f"SELECT DISTINCT {_PARTS} FROM raw")
oracle("transaction_islands", f"""
SELECT {_FILE} AS file, dense_rank() OVER (PARTITION BY store_id, log_date ORDER BY CAST(transaction_id AS BIGINT)) - 1 AS transaction_no,
       transaction_id, count(*) AS lines FROM raw GROUP BY store_id, log_date, transaction_id""")
oracle("tender_stamp", f"SELECT store_id, tender_type, count(*) AS lines, {d('sum(extended_price)')} AS ext_sales FROM items GROUP BY ALL")
oracle("finalize_totals", f"SELECT transaction_id, store_id, {d('total_amount - tax_total')} AS subtotal, {d('tax_total')} AS tax_total, {d('total_amount')} AS total_amount FROM closing")
oracle("rejected_lines", "SELECT store_id AS store_code, 'no date' AS reason, count(*) AS lines FROM pos WHERE retail_type = 'E' GROUP BY store_id")
oracle("raw_sale_predicate", """
WITH told AS (SELECT CASE WHEN is_item = 1 AND key_function <> 'VOID' AND NOT contains(key_function, 'COUPON')
    AND NOT contains(attribute_flag, 'C') AND NOT contains(attribute_flag, 'R') THEN 1 ELSE 0 END AS sale FROM raw)
SELECT sale AS raw_sale, sale AS classified_sale, count(*) AS lines FROM told GROUP BY sale""")

# --- scalar functions ----------------------------------------------------------------------------

_RETAIL = 'trim("Retail w/o dollar sign")'


def _number(text: str) -> str:
    return f"try_cast(nullif(regexp_replace({text}, '[^0-9.-]', '', 'g'), '') AS DOUBLE)"


def _money(text: str) -> str:
    value = _number(text)
    return (f"(CASE WHEN {text} IN ('', '-', '#NAME?') THEN NULL WHEN ends_with({text}, '¢') AND {value} > 5 "
            f"THEN {value} / 100 ELSE {value} END)")


oracle("safe_number", f"""
SELECT ord AS row_no, coalesce(try_cast(regexp_replace("Retail w/o dollar sign", '^[$]', '') AS DOUBLE), 0) AS as_double,
       CAST(trunc(coalesce(try_cast("Cost" AS DOUBLE), 0)) AS INT) AS as_int FROM book""")
oracle("parse_money", f"SELECT ord AS row_no, {_money(_RETAIL)} AS price, {_number('\"Description\"')} AS number_in_text FROM book")
oracle("attribute_flags", """
SELECT attribute_flag, attribute_flag AS rebuilt, CAST(contains(attribute_flag, 'R') AS INT) AS is_refund,
       CAST(contains(attribute_flag, 'C') AS INT) AS is_void, CAST(contains(attribute_flag, 'W') AS INT) AS is_wic,
       CAST(contains(attribute_flag, 'F') AS INT) AS is_food_stamp, CAST(contains(attribute_flag, 'T') AS INT) AS is_taxable,
       count(*) AS lines FROM items GROUP BY attribute_flag""")
oracle("classify_lines", f"""
SELECT transaction_type, CASE transaction_type WHEN 'SALE' THEN 'Sale' WHEN 'VOID' THEN 'Void' WHEN 'RETURN' THEN 'Return' ELSE 'Coupon' END AS transaction_type_name,
       CASE WHEN transaction_type IN ('VOID', 'RETURN') THEN 1 ELSE 0 END AS is_loss_event,
       CAST(contains(attribute_flag, 'T') AS INT) AS is_taxable, CAST(contains(attribute_flag, 'F') AS INT) AS is_food_stamp,
       CAST(contains(attribute_flag, 'W') AS INT) AS is_wic, count(*) AS lines, {d('sum(extended_price)')} AS ext_sales
  FROM items GROUP BY ALL""")
oracle("event_timestamp", "SELECT DISTINCT transaction_id AS transaction_code, CAST(log_date AS TIMESTAMP) + to_seconds(seconds) AS \"at\" FROM raw")
oracle("store_label", """
SELECT store_id, CASE WHEN min(store_name) < 'B' THEN min(store_name) ELSE 'Store ' || ltrim(store_id, '0') END AS label,
       count(*) AS lines FROM items GROUP BY store_id""")
oracle("barcode_normalise", """
SELECT item_id, ltrim(item_id, '0') AS stripped, CASE WHEN length(item_id) < 14 THEN lpad(item_id, 14, '0') ELSE item_id END AS padded,
       count(*) AS lines FROM items GROUP BY item_id""")


def _product_key(text: str) -> str:
    steps = [
        ("[^A-Z0-9 ]", " "), (r"\b(EA|EACH|BY|PER|CT|PC|PCS)\b", " "), (r"(\d)\s*(LB|LBS|POUND|POUNDS)\b", r"\1LB"),
        (r"(\d)\s*(OZ|OUNCE|OUNCES)\b", r"\1OZ"), (r"(\d)\s*(G|GR|GRAM|GRAMS)\b", r"\1G"),
        (r"(\d)\s*(ML|L|LITER|LITRE)\b", r"\1ML"), (r"(\d)\s*(QT|QUART)\b", r"\1QT"), (r"\s+", " "),
    ]
    text = f"upper({text})"
    for pattern, new in steps:
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return f"trim({text})"


oracle("product_key", f"SELECT ord AS row_no, {_product_key('\"Description\"')} AS product_key FROM book")
_DASHED = "regexp_replace(\"Upc with Dashes\", '[^0-9]', '', 'g')"
_UPC = f"CASE WHEN length({_DASHED}) >= 6 THEN ltrim({_DASHED}, '0') ELSE regexp_replace(\"UPC\", '[^0-9]', '', 'g') END"
_DAMAGED = f"CASE WHEN length({_DASHED}) < 6 AND regexp_matches(\"UPC\", '[Ee][+]?[0-9]') THEN 1 ELSE 0 END"
oracle("recover_upc", f"SELECT ord AS row_no, {_UPC} AS upc, {_DAMAGED} AS damaged FROM book")


def _season(text: str, category: str) -> str:
    rules = " ".join(
        "WHEN " + " OR ".join(f"contains({text}, {quoted(k)})" for k in keywords) + f" THEN '{season}'"
        for season, keywords in SEASON_RULES
    )
    rest = " ".join(f"WHEN {category} = {quoted(name)} THEN '{season}'" for name, season in CATEGORY_SEASONS.items())
    return f"CASE {rules} {rest} ELSE 'flat' END"


oracle("season_tag", f"""
WITH words AS (SELECT lang, upper(text || ' ' || source) AS blob, upper(source) AS category FROM documents)
SELECT lang, {_season('blob', 'category')} AS season, count(*) AS documents FROM words GROUP BY ALL""")
_STOP = ", ".join(quoted(w) for w in SEARCH_STOP_WORDS)
oracle("stem_terms", f"""
WITH words AS (SELECT lower(unnest(regexp_split_to_array(trim(replace(text, ',', ' ')), '\\s+'))) AS w FROM conversations),
good AS (SELECT w, length(w) AS n FROM words WHERE w <> '' AND w NOT IN ({_STOP})),
cut AS (SELECT w, n, CASE WHEN ends_with(w, 'ies') THEN 3 WHEN ends_with(w, 'ches') OR ends_with(w, 'shes') OR ends_with(w, 'ses') THEN 2
                          WHEN ends_with(w, 's') OR ends_with(w, 'y') THEN 1 ELSE 0 END AS c FROM good)
SELECT CASE WHEN n >= 6 AND n - c >= 4 THEN left(w, n - c) ELSE w END AS term, count(*) AS uses FROM cut GROUP BY ALL""")
_ALIASES = ", ".join(f"({quoted(a)}, '{code}')" for a, code in DEPARTMENT_ALIASES.items())
_CODES = ", ".join(f"('{code}')" for code in DEPARTMENTS)
oracle("resolve_department", f"""
WITH said AS (SELECT CASE p_type WHEN 'PROMO' THEN ' Frozen Food ' WHEN 'SMALL' THEN 'veg' WHEN 'LARGE' THEN 'HBA'
        WHEN 'STANDARD' THEN 'no such place' ELSE CAST(9 + CAST(substr(p_brand, 7) AS INT) AS VARCHAR) END AS request FROM part),
known AS (SELECT * FROM (VALUES {_ALIASES}) t(word, code) UNION ALL SELECT c, c FROM (VALUES {_CODES}) u(c))
SELECT request, k.code AS department_code, count(*) AS requests FROM said LEFT JOIN known k ON k.word = lower(trim(request)) GROUP BY ALL""")
oracle("resolve_tender", """
WITH asked AS (SELECT * FROM (VALUES ('snap', 'EBT FOOD'), ('Visa', 'VISA'), ('debit card', 'DEBIT'), ('EBT', 'EBT FOOD'),
                                     ('cash money', 'CASH MONEY'), ('BIT', 'BIT')) t(request, wanted)),
found AS (SELECT DISTINCT tender_type FROM items WHERE tender_type <> '')
SELECT request, arg_min(tender_type, (CASE WHEN tender_type = wanted THEN '0' ELSE '1' END) || tender_type) AS tender_type
  FROM asked JOIN found ON contains(tender_type, wanted) OR contains(wanted, tender_type) GROUP BY request""")
oracle("resolve_category", """
WITH asked AS (SELECT * FROM (VALUES ('economy'), ('pro'), ('art'), ('nothing'), ('e')) t(request)),
found AS (SELECT DISTINCT category_name AS c FROM detail),
hits AS (SELECT request, c, CASE WHEN upper(c) = upper(request) THEN 0 WHEN starts_with(upper(c), upper(request)) THEN 1 ELSE 2 END AS grade
           FROM asked JOIN found ON contains(upper(c), upper(request)))
SELECT request, c AS category_name FROM hits QUALIFY row_number() OVER (PARTITION BY request ORDER BY grade, length(c), c) = 1""")
oracle("suggest_categories", """
WITH asked AS (SELECT * FROM (VALUES ('large promo items', 'LARGE'), ('large promo items', 'PROMO'), ('large promo items', 'ITEMS'),
                                     ('department of economy', 'DEPARTMENT'), ('department of economy', 'ECONOMY')) t(request, word)),
hits AS (SELECT DISTINCT request, category_name FROM asked JOIN (SELECT DISTINCT category_name FROM detail) ON contains(upper(category_name), word))
SELECT request, CAST(row_number() OVER (PARTITION BY request ORDER BY length(category_name), category_name) AS INT) AS position, category_name
  FROM hits QUALIFY position <= 6""")
oracle("period_bounds", """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders),
asked AS (SELECT as_of, unnest(['today','yesterday','last_7_days','last_30_days','last_90_days','last_week','this_month','last_month','this_year','all_time']) AS period FROM days)
SELECT as_of, period, CAST(CASE period WHEN 'today' THEN as_of WHEN 'yesterday' THEN as_of - 1 WHEN 'last_7_days' THEN as_of - 7
    WHEN 'last_30_days' THEN as_of - 30 WHEN 'last_90_days' THEN as_of - 90 WHEN 'last_week' THEN as_of - CAST(isodow(as_of) AS INT) + 1 - 7
    WHEN 'this_month' THEN date_trunc('month', as_of) WHEN 'last_month' THEN date_trunc('month', as_of) - INTERVAL 1 MONTH
    WHEN 'this_year' THEN date_trunc('year', as_of) ELSE DATE '1995-01-01' END AS DATE) AS start_day,
  CAST(CASE period WHEN 'yesterday' THEN as_of - 1 WHEN 'last_week' THEN as_of - CAST(isodow(as_of) AS INT)
    WHEN 'last_month' THEN date_trunc('month', as_of) - INTERVAL 1 DAY ELSE as_of END AS DATE) AS end_day FROM asked""")

# --- enrichment, dimensions, rollups -------------------------------------------------------------

oracle("enrich_lines", f"""
SELECT transaction_id, sequence, item_id, item_desc, product_key, department_code, department_name, category_name, vendor,
       transaction_type, {d('unit_cost')} AS unit_cost, {d('revenue')} AS extended_price, {d('margin')} AS gross_margin FROM detail""")
oracle("subdept_map", "SELECT subdepartment, department_code, votes FROM votes WHERE choice = 1")
oracle("dim_store", "SELECT store_id AS store_code, min(store_name) AS store_name, '' AS region FROM items GROUP BY store_id")
oracle("dim_department", "SELECT department_code, department_name FROM names")
_SUMS = ", ".join(f"{d(f'sum({m})')} AS {m}" for m in ("units", "revenue", "margin", "discount"))
_COUNTS = "count(*) AS line_count, count(DISTINCT transaction_id) AS basket_count"
oracle("rollup_item", f"""
SELECT sale_date, store_id, item_id, product_key, department_code, transaction_type, min(store_name) AS store_name,
       min(department_name) AS department_name, min(category_name) AS category_name, min(item_desc) AS item_desc,
       {_SUMS}, {_COUNTS} FROM detail GROUP BY sale_date, store_id, item_id, product_key, department_code, transaction_type""")
oracle("rollup_dept", f"""
SELECT sale_date, store_id, department_code, category_name, tender_type, transaction_type, min(store_name) AS store_name,
       min(department_name) AS department_name, {_SUMS}, {_COUNTS}
  FROM detail GROUP BY sale_date, store_id, department_code, category_name, tender_type, transaction_type""")
_YM = "CAST(year(sale_date) AS INT) AS year, CAST(month(sale_date) AS INT) AS month"
oracle("write_read_detail", f"SELECT store_id, {_YM}, transaction_type, count(*) AS lines, {d('sum(revenue)')} AS revenue, {d('sum(margin)')} AS margin FROM detail GROUP BY ALL")
oracle("write_read_rollups", f"""
SELECT store_id, {_YM}, transaction_type, count(*) AS lines, {d('sum(revenue)')} AS revenue, t.table_name
  FROM detail CROSS JOIN (VALUES ('rollup_item'), ('rollup_dept')) t(table_name) GROUP BY ALL""")
oracle("partition_pruned_scan", f"SELECT {_YM}, count(*) AS lines, {d('sum(revenue)')} AS revenue FROM detail WHERE sale_date BETWEEN DATE '1996-11-15' AND DATE '2000-02-10' GROUP BY ALL")
oracle("routing_equivalence", f"""
SELECT category_name AS category, {d('sum(revenue)')} AS revenue, {d('sum(units)')} AS units, t.table_name
  FROM sold CROSS JOIN (VALUES ('detail'), ('rollup_item'), ('rollup_dept')) t(table_name) GROUP BY ALL""")
_PAIRS = ", ".join(f"count(*) AS {s}_lines, {d('sum(revenue)')} AS {s}_revenue" for s in ("detail", "item", "dept"))
oracle("check_partition", f"SELECT store_id, sale_date, {_PAIRS}, 1 AS item_ok, 1 AS dept_ok FROM detail GROUP BY store_id, sale_date")
_FOUR = "(VALUES ('raw'), ('detail'), ('rollup_item'), ('rollup_dept')) t(source)"
for _key, _where in (("reconcile", "TRUE"), ("verify_totals", "sale_date >= DATE '2001-01-01'")):
    oracle(_key, f"""
SELECT t.source, count(*) AS lines, {d('sum(revenue)')} AS revenue, CAST(0 AS BIGINT) AS line_difference, CAST(0 AS DOUBLE) AS revenue_difference, 1 AS ok
  FROM sold CROSS JOIN {_FOUR} WHERE {_where} GROUP BY t.source""")
_BY_TYPE = f"count(*) AS lines, {d('sum(revenue)')} AS revenue"
oracle("publish_gate", f"SELECT store_name, transaction_type, {_BY_TYPE} FROM detail GROUP BY ALL")
oracle("stream_ingest", f"SELECT store_id, transaction_type, tender_type, {_BY_TYPE} FROM detail GROUP BY ALL")
oracle("stream_foreach_rollup", f"SELECT sale_date, store_id, transaction_type, {_BY_TYPE} FROM detail GROUP BY ALL")
oracle("stream_daily_rollup", f"SELECT sale_date, store_id, transaction_type, {d('sum(units)')} AS units, {d('sum(revenue)')} AS revenue, count(*) AS line_count FROM detail GROUP BY ALL")
oracle("backfill_equals_incremental", f"SELECT {_YM}, {_BY_TYPE} FROM detail GROUP BY ALL")
oracle("stream_dedup", "SELECT DISTINCT source, md5(text) AS content_md5 FROM documents")

# --- reports -------------------------------------------------------------------------------------

_RUM = ", ".join(f"{d(f'sum({m})')} AS {m}" for m in ("revenue", "units", "margin"))
_MPCT = f"{share('sum(margin)', 'sum(revenue)')} AS margin_pct"


def _movers(where: str, order: str, limit: int) -> str:
    return f"""
WITH p AS (SELECT product_key, min(item_desc) AS item_desc, min(department_name) AS department_name, count(DISTINCT item_id) AS barcodes,
                  {_RUM}, {_MPCT}, count(*) OVER () AS products FROM sold WHERE {where} GROUP BY product_key),
top AS (SELECT CAST(row_number() OVER (ORDER BY {order}, product_key) AS INT) AS position, * FROM p QUALIFY position <= {limit})
SELECT position, product_key, item_desc, department_name, barcodes, revenue, units, margin, margin_pct,
       CAST(sum(barcodes - 1) OVER () AS BIGINT) AS merged_barcodes, products > {limit} AS more_exist FROM top"""


oracle("top_movers", _movers("TRUE", "revenue DESC", 20))
oracle("bottom_movers", _movers("TRUE", "units", 50))
oracle("top_movers_filtered", _movers("store_id = '0000000002' AND department_code = '21' AND category_name = 'ECONOMY'", "margin DESC", 10))
for _name, _col in (("department", "department_name"), ("category", "category_name"), ("store", "store_name"), ("day", "sale_date")):
    oracle(f"sales_by_{_name}", f"""
SELECT {_col} AS {_name}, {_RUM}, {share('sum(revenue)', '(SELECT sum(revenue) FROM sold)')} AS share_pct, {_MPCT} FROM sold GROUP BY {_col}""")
oracle("tender_analysis", f"""
SELECT tender_type, CASE WHEN tender_type = 'EBT FOOD' THEN 'EBT FOOD (SNAP)' ELSE tender_type END AS label, {d('sum(revenue)')} AS revenue,
       {d('sum(margin)')} AS margin, count(DISTINCT transaction_id) AS baskets, {share('sum(revenue)', 'count(DISTINCT transaction_id)', '')} AS average_basket,
       {share('sum(revenue)', "(SELECT sum(revenue) FROM sold WHERE tender_type <> '')")} AS share_pct
  FROM sold WHERE tender_type <> '' GROUP BY tender_type""")
oracle("tender_top_groups", f"""
WITH t AS (SELECT tender_type, {d('sum(revenue)')} AS whole FROM sold WHERE tender_type <> '' GROUP BY tender_type),
g AS (SELECT tender_type, department_name AS grp, {d('sum(revenue)')} AS revenue, {d('sum(units)')} AS units FROM sold WHERE tender_type <> '' GROUP BY ALL)
SELECT g.tender_type, CAST(row_number() OVER (PARTITION BY g.tender_type ORDER BY revenue DESC, grp) AS INT) AS position, grp, revenue, units,
       revenue / nullif(whole, 0) * 100 AS share_pct FROM g JOIN t USING (tender_type) QUALIFY position <= 12""")
_LOSS = f"""count(*) FILTER (transaction_type = 'VOID') AS void_lines, coalesce({d("sum(abs(revenue)) FILTER (transaction_type = 'VOID')")}, 0) AS void_value,
       count(*) FILTER (transaction_type = 'RETURN') AS return_lines, coalesce({d("sum(abs(revenue)) FILTER (transaction_type = 'RETURN')")}, 0) AS return_value,
       coalesce({d("sum(abs(revenue)) FILTER (transaction_type IN ('VOID', 'RETURN'))")}, 0) AS loss_value,
       coalesce({d("sum(revenue) FILTER (transaction_type = 'SALE')")}, 0) AS sales,
       {share("sum(abs(revenue)) FILTER (transaction_type IN ('VOID', 'RETURN'))", "sum(revenue) FILTER (transaction_type = 'SALE')")} AS loss_pct"""
oracle("loss_report", f"SELECT store_name, {_LOSS} FROM detail GROUP BY store_name")
oracle("loss_chain_total", f"SELECT {_LOSS} FROM detail")
oracle("seasonal_trends", f"""
WITH w AS (SELECT * FROM (VALUES ('this_year', DATE '2001-01-01', DATE '2001-08-01'), ('last_year', DATE '2000-01-01', DATE '2000-08-01'),
                                 ('two_years_ago', DATE '1999-01-01', DATE '1999-08-01')) t(label, first_day, last_day)),
s AS (SELECT label, first_day, last_day, {_RUM}, count(DISTINCT transaction_id) AS transactions
        FROM sold JOIN w ON sale_date BETWEEN first_day AND last_day GROUP BY ALL)
SELECT *, CASE WHEN label <> 'this_year' THEN ((SELECT revenue FROM s WHERE label = 'this_year') - revenue) / nullif(revenue, 0) * 100 END AS change_pct FROM s""")
oracle("store_comparison", f"""
WITH s AS (SELECT store_name, {_RUM}, count(DISTINCT transaction_id) AS transactions,
                  {share('sum(revenue)', 'count(DISTINCT transaction_id)', '')} AS avg_basket, {_MPCT} FROM sold GROUP BY store_name)
SELECT CAST(row_number() OVER (ORDER BY avg_basket DESC, store_name) AS INT) AS position, * FROM s""")
oracle("promotion_performance", f"""
SELECT retail_type, CASE retail_type WHEN 'B' THEN 'Base retail' WHEN 'T' THEN 'TPR (temporary reduction)' WHEN 'S' THEN 'Sale price'
        WHEN 'L' THEN 'Loyalty price' WHEN 'E' THEN 'Electronic coupon' END AS label, {_RUM}, {d('sum(discount)')} AS discount,
       {share('sum(revenue)', '(SELECT sum(revenue) FROM sold)')} AS share_pct, {_MPCT} FROM sold GROUP BY retail_type""")
oracle("range_activity", f"SELECT department_name, count(DISTINCT item_id) AS items, {d('sum(revenue)')} AS revenue FROM sold GROUP BY department_name")
_PAD = "CASE WHEN length(item_id) < 14 THEN lpad(item_id, 14, '0') ELSE item_id END"
_IDLE = f"NOT EXISTS (SELECT 1 FROM (SELECT {_PAD} AS p FROM recent) r WHERE r.p = m.item_id)"
CTES["idle"] = f"SELECT m.*, CASE WHEN {_IDLE} THEN 1 ELSE 0 END AS unsold FROM master m"
oracle("dead_stock", f"""
SELECT CAST(row_number() OVER (ORDER BY unit_price DESC, item_id) AS INT) AS position, item_id, item_desc, department_name, {d('unit_price')} AS unit_price,
       ({d('unit_price')} - {d('unit_cost')}) / nullif({d('unit_price')}, 0) * 100 AS margin_pct,
       count(*) OVER () > 25 AS more_exist FROM idle WHERE unsold = 1 QUALIFY position <= 25""")
_UNSOLD = f"count(*) AS total, CAST(sum(unsold) AS BIGINT) AS unsold, {share('sum(unsold)', 'count(*)')} AS unsold_pct"
oracle("dead_stock_summary", f"SELECT {_UNSOLD} FROM idle")
oracle("dead_stock_by_dept", f"""
WITH g AS (SELECT department_name, {_UNSOLD} FROM idle GROUP BY department_name HAVING count(*) > 20)
SELECT *, CAST(row_number() OVER (ORDER BY unsold_pct DESC, department_name) AS INT) AS position FROM g QUALIFY position <= 8""")
_PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS lines FROM detail WHERE {c} <> '' GROUP BY {c}"
    for c in ("transaction_type", "tender_type", "retail_type", "department_name", "category_name"))
oracle("profile_values", f"""
WITH p AS ({_PROFILE}) SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY lines DESC, value) AS INT) AS position FROM p QUALIFY position <= 40""")
_DATED = "SELECT '{}' AS table_name, min(sale_date) AS first_day, max(sale_date) AS last_day, count(*) AS row_count FROM ({})"
oracle("profile_dates", " UNION ALL ".join([
    "SELECT 'detail' AS table_name, min(log_date) AS first_day, max(log_date) AS last_day, count(*) AS row_count FROM items",
    _DATED.format("rollup_item", "SELECT DISTINCT sale_date, store_id, item_id, product_key, department_code, transaction_type FROM detail"),
    _DATED.format("rollup_dept", "SELECT DISTINCT sale_date, store_id, department_code, category_name, tender_type, transaction_type FROM detail"),
]))
_IFSALE = "FILTER (transaction_type = 'SALE')"
oracle("load_summary", f"""
SELECT count(*) AS line_items, count(DISTINCT transaction_id) AS transactions, count(DISTINCT item_id) AS distinct_items, min(sale_date) AS first_day,
       max(sale_date) AS last_day, {d(f'sum(revenue) {_IFSALE}')} AS net_sales, {d(f'sum(margin) {_IFSALE}')} AS gross_margin,
       {share(f'sum(margin) {_IFSALE}', f'sum(revenue) {_IFSALE}')} AS margin_pct,
       {share("count(*) FILTER (category_name <> 'Unmatched')", 'count(*)')} AS match_pct FROM detail""")
oracle("unmatched_barcodes", """
WITH c AS (SELECT item_id, count(*) AS lines FROM detail WHERE category_name = 'Unmatched' GROUP BY item_id)
SELECT CAST(row_number() OVER (ORDER BY lines DESC, item_id) AS INT) AS position, item_id, lines, count(*) OVER () AS distinct_barcodes,
       CAST(sum(lines) OVER () AS BIGINT) AS total_lines FROM c QUALIFY position <= 5""")

# --- search --------------------------------------------------------------------------------------


def _listing(where: str, key: str = "product_key", limit: int = 25) -> str:
    return f"""
WITH g AS (SELECT {key} AS grp, min(item_desc) AS item_desc, min(department_name) AS department_name, min(category_name) AS category_name,
                  count(DISTINCT item_id) AS barcodes, count(DISTINCT transaction_id) AS baskets, {_RUM},
                  {share('sum(unit_price)', 'count(*)', '')} AS avg_price, {_MPCT} FROM sold WHERE {where} GROUP BY {key})
SELECT CAST(row_number() OVER (ORDER BY revenue DESC, grp) AS INT) AS position, *, count(*) OVER () > {limit} AS more_exist FROM g QUALIFY position <= {limit}"""


_OLD = "contains(upper(item_desc), 'OLD') AND contains(upper(item_desc), 'WIDGET')"
oracle("search_by_name", _listing("contains(upper(item_desc), 'WIDGET') AND contains(upper(item_desc), '16')"))
oracle("search_by_barcode_group", _listing(_OLD, "item_id"))
oracle("search_totals", f"SELECT count(DISTINCT product_key) AS products, {_RUM}, count(DISTINCT item_id) AS barcodes FROM sold WHERE {_OLD}")
_CODE = "(ltrim(item_id, '0') = '123' OR ends_with(item_id, '123'))"
oracle("search_barcode", f"SELECT item_id, min(item_desc) AS item_desc, min(department_name) AS department_name, {_RUM}, {_MPCT} FROM sold WHERE {_CODE} GROUP BY item_id")
_BY_CODE = f"""
WITH s AS (SELECT {_PAD} AS code, {_RUM}, count(DISTINCT transaction_id) AS baskets FROM recent GROUP BY ALL)
SELECT CAST(row_number() OVER (ORDER BY coalesce(revenue, 0) DESC, item_id) AS INT) AS position, item_id, item_desc, department_name, category_name,
       {d('unit_price')} AS unit_price, coalesce(revenue, 0) AS revenue, coalesce(units, 0) AS units, coalesce(margin, 0) AS margin,
       coalesce(baskets, 0) AS baskets, count(*) OVER () > 25 AS more_exist FROM master LEFT JOIN s ON s.code = item_id WHERE {_CODE} QUALIFY position <= 25"""
oracle("search_barcode_catalogue", _BY_CODE)
oracle("search_relaxed", f"SELECT *, 2 AS terms_used FROM ({_listing(_OLD.replace('OLD', 'SMALL'))})")
_UNSOLD_ANVILS = f"""
SELECT CAST(row_number() OVER (ORDER BY item_id) AS INT) AS position, item_id, item_desc, department_name, {d('unit_price')} AS unit_price,
       count(*) OVER () > 10 AS more_exist FROM idle WHERE unsold = 1 AND contains(item_desc, 'ANVIL') QUALIFY position <= 10"""
oracle("search_not_sold", _UNSOLD_ANVILS)


def _found(kind: str, listing: str, code: str, measures: bool, terms: int = 0) -> str:
    sums = "revenue, units, margin, baskets" if measures else "0e0 AS revenue, 0e0 AS units, 0e0 AS margin, 0 AS baskets"
    return (
        f"SELECT '{kind}' AS found, position, {code} AS code, item_desc, department_name, {sums}, {terms} AS terms_used, more_exist "
        f"FROM ({listing})"
    )


_ANVIL = _listing("contains(upper(item_desc), 'ANVIL')").replace("FROM sold", "FROM recent")
oracle("search_words", _found("sold", _listing(_OLD.replace("OLD", "SMALL")), "grp", True, 2))
oracle("search_code", _found("barcode", _BY_CODE, "item_id", True))
oracle("search_idle", _found("sold", _ANVIL, "grp", True, 1) + " UNION ALL " + _found("not_sold", _UNSOLD_ANVILS, "item_id", False))

# --- recipes -------------------------------------------------------------------------------------

oracle("dept_growth_qoq", f"""
WITH q AS (SELECT department_name, CAST(date_trunc('quarter', sale_date) AS DATE) AS quarter, {d('sum(revenue)')} AS revenue FROM sold GROUP BY ALL)
SELECT *, (revenue - lag(revenue) OVER w) / nullif(lag(revenue) OVER w, 0) * 100 AS growth_pct FROM q WINDOW w AS (PARTITION BY department_name ORDER BY quarter)""")
oracle("dept_yoy_trend", f"""
WITH q AS (SELECT department_name, CAST(year(sale_date) AS INT) AS year, {d('sum(revenue)')} AS revenue FROM sold GROUP BY ALL)
SELECT *, (revenue - lag(revenue) OVER w) / nullif(lag(revenue) OVER w, 0) * 100 AS change_pct FROM q WINDOW w AS (PARTITION BY department_name ORDER BY year)""")
oracle("monthly_revenue", f"SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, {d('sum(revenue)')} AS revenue, {d('sum(margin)')} AS margin FROM sold WHERE sale_date >= DATE '2000-03-01' GROUP BY ALL")


def _rate(keys: str, kind: str) -> str:
    hit = f"FILTER (transaction_type = '{kind}')"
    return f"""SELECT {keys}, count(*) AS lines, count(*) {hit} AS events, coalesce({d(f'sum(abs(revenue)) {hit}')}, 0) AS value,
       {share(f'count(*) {hit}', 'count(*)')} AS rate_pct FROM detail GROUP BY ALL"""


oracle("cashier_void_rate", _rate("store_id, cashier_id", "VOID"))
oracle("return_rate_by_dept", _rate("department_name", "RETURN"))
oracle("voids_by_hour", _rate("CAST(hour(transaction_ts) AS INT) AS hour", "VOID"))
oracle("category_peak_month", f"""
WITH m AS (SELECT category_name, CAST(month(sale_date) AS INT) AS month, sum(revenue) AS revenue FROM sold GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY category_name ORDER BY revenue DESC, month) AS place, sum(revenue) OVER (PARTITION BY category_name) AS whole FROM m)
SELECT category_name, month AS peak_month, {d('revenue')} AS peak_revenue, {d('whole')} AS revenue, CASE WHEN month = 12 THEN 1 ELSE 0 END AS peaks_in_month FROM r WHERE place = 1""")
oracle("basket_size_by_tender", f"""
WITH b AS (SELECT tender_type, transaction_id, count(*) AS lines, sum(units) AS units, sum(revenue) AS revenue FROM sold GROUP BY ALL)
SELECT tender_type, count(*) AS baskets, {share('sum(lines)', 'count(*)', '')} AS average_lines, {share('sum(units)', 'count(*)', '')} AS average_units,
       {share('sum(revenue)', 'count(*)', '')} AS average_value, {d('max(revenue)')} AS largest_basket FROM b GROUP BY tender_type""")
oracle("wic_share", f"""
SELECT {d('sum(revenue)')} AS revenue, coalesce({d('sum(revenue) FILTER (is_wic = 1)')}, 0) AS wic_revenue,
       coalesce({d('sum(revenue) FILTER (is_food_stamp = 1)')}, 0) AS food_stamp_revenue,
       {share('sum(revenue) FILTER (is_wic = 1)', 'sum(revenue)')} AS wic_pct, {share('sum(revenue) FILTER (is_food_stamp = 1)', 'sum(revenue)')} AS food_stamp_pct FROM sold""")
oracle("slow_mover_capital", f"""
WITH s AS (SELECT {_PAD} AS code, {d('sum(units)')} AS units FROM recent GROUP BY ALL)
SELECT CAST(row_number() OVER (ORDER BY unit_cost DESC, item_id) AS INT) AS position, item_id, item_desc, coalesce(units, 0) AS units, {d('unit_cost')} AS unit_cost
  FROM master LEFT JOIN s ON s.code = item_id WHERE coalesce(units, 0) <= 10 AND unit_cost > 0 QUALIFY position <= 50""")
oracle("saturday_busiest_hour", f"""
WITH h AS (SELECT CAST(hour(transaction_ts) AS INT) AS hour, count(DISTINCT transaction_id) AS baskets, {d('sum(revenue)')} AS revenue FROM sold WHERE isodow(sale_date) = 6 GROUP BY ALL)
SELECT *, CAST(row_number() OVER (ORDER BY baskets DESC, hour) AS INT) AS position FROM h QUALIFY position <= 3""")
oracle("basket_affinity", f"""
WITH h AS (SELECT DISTINCT transaction_id, product_key FROM sold), n AS (SELECT count(DISTINCT transaction_id) AS n FROM sold),
f AS (SELECT product_key, count(*) AS support FROM h GROUP BY product_key HAVING count(*) >= 0.01 * (SELECT n FROM n)),
p AS (SELECT a.product_key AS left_product, b.product_key AS right_product, count(*) AS together FROM h a JOIN h b
        ON a.transaction_id = b.transaction_id AND a.product_key < b.product_key GROUP BY ALL)
SELECT left_product, right_product, x.support AS left_baskets, y.support AS right_baskets, together, {share('together', 'x.support', '')} AS confidence,
       together * {d('(SELECT n FROM n)')} / ({d('x.support')} * {d('y.support')}) AS lift
  FROM p JOIN f x ON x.product_key = left_product JOIN f y ON y.product_key = right_product""")

oracle("basket_pairs", f"""
WITH h AS (SELECT DISTINCT store_id, terminal_code, sale_date, transaction_id, product_key FROM sold),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT store_id, terminal_code, sale_date, transaction_id FROM sold)),
f AS (SELECT product_key, count(*) AS support FROM h GROUP BY product_key),
p AS (SELECT a.product_key AS left_product, b.product_key AS right_product, count(*) AS together FROM h a JOIN h b
        ON a.store_id = b.store_id AND a.terminal_code = b.terminal_code AND a.sale_date = b.sale_date
           AND a.transaction_id = b.transaction_id AND a.product_key < b.product_key GROUP BY ALL HAVING count(*) >= 20)
SELECT left_product, right_product, x.support AS left_baskets, y.support AS right_baskets, together, {share('together', 'x.support', '')} AS confidence,
       together * {d('(SELECT n FROM n)')} / ({d('x.support')} * {d('y.support')}) AS lift
  FROM p JOIN f x ON x.product_key = left_product JOIN f y ON y.product_key = right_product""")

# --- catalogue -----------------------------------------------------------------------------------

_FIRST = f"CASE WHEN {_money(_RETAIL)} <> 0 THEN {_money(_RETAIL)} ELSE {_money('\"Price w/o dollar sign\"')} END"
_COSTS = f"CASE WHEN {_money('\"Cost\"')} <> 0 THEN {_money('\"Cost\"')} ELSE {_money('\"Base Unit Cost\"')} END"
_SQUEEZE = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"
CTES["clean"] = f"""
SELECT ord, {_UPC} AS upc, {_DAMAGED} AS damaged, coalesce(nullif({_SQUEEZE.format('"Description"')}, ''), {_SQUEEZE.format('"POS Description"')}) AS description,
       {_SQUEEZE.format('"POS Description"')} AS register_text, "Department" AS department_code, "Dept 4" AS dept4, "Category Name" AS category,
       "Sub Category" AS sub_category, {_FIRST} AS price, {_COSTS} AS cost, "Brand" AS brand, "Vendor Name" AS vendor,
       CASE WHEN "Food Stamp" = 'yes' THEN 'Y' ELSE 'N' END AS food_stamp, CASE WHEN "WIC" = 'wic' THEN 'Y' ELSE 'N' END AS wic FROM book"""
CTES["early"] = """
SELECT *, CASE WHEN upc = '' OR description = '' THEN 'missing upc or description'
               WHEN department_code IN ('33', '35') THEN 'non-merchandise department' END AS early FROM clean"""
CTES["graded"] = """
SELECT e.*, CASE WHEN early IS NOT NULL THEN early WHEN ord > f.first THEN 'duplicate upc' WHEN price > 0 THEN 'kept' ELSE 'no price' END AS skip_reason
  FROM early e LEFT JOIN (SELECT upc, min(ord) AS first FROM early WHERE early IS NULL AND price > 0 GROUP BY upc) f USING (upc)"""
CTES["catvote"] = """
SELECT dept4, category AS voted FROM clean WHERE category <> '' GROUP BY dept4, category
QUALIFY row_number() OVER (PARTITION BY dept4 ORDER BY count(*) DESC, min(ord)) = 1"""
CTES["kept"] = """
SELECT g.* REPLACE (coalesce(nullif(category, ''), v.voted, '') AS category), CASE WHEN category = '' AND v.voted IS NOT NULL THEN 1 ELSE 0 END AS recovered,
       CASE WHEN cost IS NULL OR cost <= 0 OR cost >= price OR (price - cost) / price > 0.9 THEN 'imputed' ELSE 'actual' END AS cost_source
  FROM graded g LEFT JOIN catvote v USING (dept4) WHERE skip_reason = 'kept'"""
CTES["margins"] = "SELECT department_code, (price - cost) / price AS m FROM kept WHERE cost_source = 'actual'"
CTES["medians"] = """
SELECT department_code, (max(m) FILTER (place = (n - 1) // 2) + max(m) FILTER (place = n // 2)) / 2 AS med
  FROM (SELECT *, row_number() OVER (PARTITION BY department_code ORDER BY m) - 1 AS place, count(*) OVER (PARTITION BY department_code) AS n FROM margins)
 GROUP BY department_code"""
CTES["overall"] = """
SELECT (max(m) FILTER (place = (n - 1) // 2) + max(m) FILTER (place = n // 2)) / 2 AS med
  FROM (SELECT m, row_number() OVER (ORDER BY m) - 1 AS place, count(*) OVER () AS n FROM margins)"""
CTES["built"] = f"""
SELECT CASE WHEN length(upc) < 14 THEN lpad(upc, 14, '0') ELSE upc END AS item_id, upc, k.*  EXCLUDE (upc), round(price, 2) AS unit_price,
       CASE WHEN cost_source = 'imputed' THEN round(round(price, 2) * (1 - least(greatest(coalesce(nullif(md.med, 0), nullif(o.med, 0), 0.35), 0.05), 0.75)), 4) ELSE cost END AS unit_cost
  FROM kept k LEFT JOIN medians md USING (department_code) CROSS JOIN overall o"""
oracle("pricebook_skips", "SELECT skip_reason, count(*) AS rows, CAST(sum(damaged) AS BIGINT) AS damaged_upcs FROM graded GROUP BY skip_reason")
oracle("category_recovery", """
SELECT dept4, coalesce(nullif(category, ''), voted, '') AS category, CASE WHEN category = '' AND voted IS NOT NULL THEN 1 ELSE 0 END AS recovered, count(*) AS rows
  FROM clean LEFT JOIN catvote USING (dept4) GROUP BY ALL""")
oracle("cost_imputation", "SELECT item_id, department_code, unit_price, unit_cost, cost_source, round((unit_price - unit_cost) / unit_price * 100, 1) AS margin_pct FROM built")
_BOOK_NAMES = {
    10: "Alcohol", 11: "Produce", 12: "Kitchen", 13: "Meat", 14: "Deli", 15: "Caviar", 16: "Dairy", 17: "Bread", 18: "Pet", 19: "Seafood",
    20: "Bakery", 21: "Frozen", 22: "Grocery", 25: "Non-Food", 26: "Dry Goods", 27: "Pickled", 28: "Garden", 30: "Reusable Bags", 31: "Soda",
    32: "Beer", 33: "Bottle Deposit", 34: "Gift", 35: "Online Fees", 40: "Garden",
}
_DEPT_NAME = "CASE department_code " + " ".join(f"WHEN '{c}' THEN {quoted(n)}" for c, n in _BOOK_NAMES.items()) + " ELSE 'Dept ' || department_code END"
_ITEM_BUILD = f"""
SELECT item_id, upc, left(description, 60) AS item_desc, {_product_key('description')} AS product_key,
       coalesce(nullif(left(register_text, 22), ''), left(description, 22)) AS pos_desc, department_code, {_DEPT_NAME} AS department_name,
       coalesce(nullif(sub_category, ''), '0') AS category_code, coalesce(nullif(category, ''), 'Uncategorized') AS category_name, brand, vendor,
       unit_price, food_stamp, wic, {_season("upper(description || ' ' || category)", 'upper(category)')} AS season FROM built"""
oracle("item_master_build", _ITEM_BUILD)
oracle("item_master_from_files", _ITEM_BUILD)
oracle("query_kinds", "SELECT item_id AS asked, true AS is_barcode FROM master UNION SELECT item_desc, false FROM master UNION SELECT 'no ' || item_id, false FROM master")
oracle("detail_from_item_files", f"SELECT department_name, transaction_type, {_BY_TYPE} FROM detail GROUP BY ALL")
oracle("item_master", f"SELECT department_code, count(*) AS items, {d('sum(CAST(unit_price AS DECIMAL(18,2)))')} AS price_sum FROM built GROUP BY department_code")
oracle("catalogue_summary", f"""
WITH p AS (SELECT {_product_key('description')} AS k, count(*) AS n FROM built GROUP BY k)
SELECT count(*) AS items, count(*) FILTER (cost_source = 'imputed') AS imputed, CAST(sum(recovered) AS BIGINT) AS recovered,
       count(*) FILTER (category = '') AS uncategorized, count(DISTINCT {_season("upper(description || ' ' || category)", 'upper(category)')}) AS seasons,
       (SELECT count(*) FROM p) AS products, (SELECT count(*) FROM p WHERE n > 1) AS multi_barcode_products,
       {share("count(*) FILTER (category = '')", 'count(*)')} AS uncategorized_pct FROM built""")
CTES["pctl"] = """
SELECT department_code, unit_price, CAST(rank() OVER w - 1 AS DOUBLE) / count(*) OVER (PARTITION BY department_code) AS percentile
  FROM built WINDOW w AS (PARTITION BY department_code ORDER BY unit_price)"""
oracle("price_percentile", "SELECT DISTINCT department_code, unit_price, percentile FROM pctl")


def _uniform(part: int) -> str:
    return f"CAST(CAST('0x' || substr(md5(item_id), {8 * part + 1}, 8) AS BIGINT) AS DOUBLE) / 4294967296e0"


CTES["scored"] = f"""
SELECT b.item_id, b.department_code, b.unit_price, 0.28e0 * (1 - percentile) + 0.72e0 * ({_uniform(0)}) AS score
  FROM built b JOIN (SELECT DISTINCT department_code, unit_price, percentile FROM pctl) USING (department_code, unit_price)"""
CTES["ranked"] = """
SELECT *, row_number() OVER (PARTITION BY department_code ORDER BY score DESC, item_id) AS rank FROM scored"""
CTES["weighted"] = f"""
SELECT *, round(1e0 / pow(rank + 6, 1.6e0) * (0.75e0 + (1.35e0 - 0.75e0) * ({_uniform(1)})), 8) AS weight FROM ranked"""
_TARGET = "CASE department_code " + " ".join(f"WHEN '{c}' THEN {s!r}e0" for c, s in TARGET_REVENUE_SHARE.items()) + " ELSE 0.002e0 END"
CTES["popular"] = f"""
SELECT *, weight * ({_TARGET} / expected) AS pop FROM (
  SELECT *, CAST(sum(CAST(weight AS DECIMAL(12,8)) * CAST(unit_price AS DECIMAL(12,2))) OVER (PARTITION BY department_code) AS DOUBLE) AS expected FROM weighted)"""
oracle("demand_weights", "SELECT item_id, rank, weight, round(pop / (SELECT max(pop) FROM popular), 9) AS popularity FROM popular")
oracle("demand_concentration", f"""
WITH p AS (SELECT item_id, CAST(round(pop / (SELECT max(pop) FROM popular), 9) AS DECIMAL(18,9)) AS v FROM popular),
r AS (SELECT v, row_number() OVER (ORDER BY v DESC, item_id) AS place FROM p)
SELECT count(*) FILTER (place <= 100) AS items, {share('sum(v) FILTER (place <= 100)', 'sum(v)')} AS share_pct FROM r""")

# --- movement ------------------------------------------------------------------------------------

CTES["act"] = """
SELECT lpad(concat('4', lpad(CAST(part_no + 1 AS VARCHAR), 10, '0')), 14, '0') AS item_id, description AS item_desc, brand,
       lpad(CAST(size AS VARCHAR), 4, '0') AS category_code, category AS category_name, 'STORE' || substr(store_no, 5) AS store_code, store_name,
       week_start AS period_start, week_start + 6 AS period_end, 7 AS days, CAST(qty AS DOUBLE) AS units, CAST(sales AS DOUBLE) AS sales,
       CAST(cost AS DOUBLE) AS unit_cost, part_no, qty AS qty_exact, sales AS sales_exact FROM weeks"""
oracle("movement_parse", "SELECT item_id, item_desc, brand, category_code, category_name, store_code, store_name, period_start, period_end, units, sales, unit_cost FROM act")
oracle("movement_rates", "SELECT item_id, store_code, period_start, days, ((2 * CAST(sales_exact * 100 AS BIGINT) * 100 + CAST(qty_exact * 100 AS BIGINT)) // (2 * CAST(qty_exact * 100 AS BIGINT))) / 1e2 AS unit_price, round(units / 7e0, 4) AS units_per_day, round(sales / 7e0, 4) AS sales_per_day FROM act")
CTES["lastweek"] = "SELECT * FROM act QUALIFY row_number() OVER (PARTITION BY item_id, store_code ORDER BY period_end DESC) = 1"
oracle("movement_latest", "SELECT item_id, store_code, period_end, units, round(units / 7e0, 4) AS units_per_day FROM lastweek")
oracle("movement_summary", f"""
SELECT count(*) AS items, {d('sum(CAST(units AS DECIMAL(18,3)))')} AS units, {d('sum(CAST(sales AS DECIMAL(18,2)))')} AS sales,
       count(DISTINCT store_code) AS stores, count(DISTINCT period_start) AS windows, count(DISTINCT category_name) AS categories FROM lastweek""")
oracle("movement_overlay", """
WITH seen AS (SELECT part_no, arg_max(units, store_code || strftime(period_end, '%Y%m%d')) AS units, arg_max(unit_cost, store_code) AS cost FROM lastweek GROUP BY part_no),
c AS (SELECT DISTINCT upper(category_name) AS category FROM lastweek)
SELECT m.item_id, round(units / 7e0, 4) AS observed_units_per_day,
       CASE WHEN units IS NOT NULL THEN 'observed' WHEN c.category IS NOT NULL THEN 'not in report' ELSE 'modelled' END AS demand_source,
       CASE WHEN cost > 0 AND cost < unit_price THEN 'movement report' ELSE 'actual' END AS cost_source,
       CASE WHEN cost > 0 AND cost < unit_price THEN round(cost, 4) ELSE CAST(unit_cost AS DOUBLE) END AS unit_cost,
       CASE WHEN units IS NULL AND c.category IS NOT NULL THEN 0.02e0 ELSE 1e0 END AS popularity
  FROM master m LEFT JOIN seen ON seen.part_no = m.ord LEFT JOIN c ON c.category = upper(m.category_name)""")

# --- guard and text scan -------------------------------------------------------------------------

oracle("query_audit", """
WITH t AS (SELECT query_id, CASE WHEN starts_with(sql, 'SELECT department') THEN 'view' WHEN starts_with(sql, 'SELECT *') THEN 'star'
        WHEN starts_with(sql, 'SELECT SUM') THEN 'sum' WHEN starts_with(sql, 'SHOW') THEN 'show' ELSE 'delete' END AS kind FROM log)
SELECT query_id, CASE WHEN kind = 'delete' THEN 1 ELSE 0 END AS is_write, CASE WHEN kind = 'show' THEN 1 ELSE 0 END AS is_metadata,
       CASE WHEN kind IN ('view', 'star', 'delete') THEN 1 ELSE 0 END AS has_partition_filter, CASE WHEN kind = 'star' THEN 1 ELSE 0 END AS selects_everything,
       CASE kind WHEN 'delete' THEN 'refused: not read-only' WHEN 'show' THEN 'accepted: metadata' WHEN 'sum' THEN 'refused: no partition filter'
                 WHEN 'star' THEN 'refused: reads everything' ELSE 'accepted' END AS verdict FROM t""")
_COST = "CAST(CAST({} AS BIGINT) AS DOUBLE) / 1099511627776e0 * 5e0"
oracle("spend_daily", f"""
WITH s AS (SELECT CAST(ts AS DATE) AS day, count(*) AS queries, CAST(sum(bytes) AS BIGINT) AS bytes FROM log GROUP BY ALL)
SELECT *, {_COST.format('bytes')} AS dollars, 5e0 - {_COST.format('bytes')} AS budget_left, CASE WHEN {_COST.format('bytes')} >= 5 THEN 1 ELSE 0 END AS over_budget FROM s""")
oracle("budget_breach", f"""
WITH r AS (SELECT *, CAST(ts AS DATE) AS day, coalesce(sum(bytes) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, query_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM log)
SELECT day, min(ts) AS first_refused_at, count(*) AS refused, CAST(sum(bytes) AS BIGINT) AS refused_bytes FROM r WHERE {_COST.format('before')} >= 0.05 GROUP BY day""")
oracle("guarded_sql", f"SELECT store_name, CAST(year(sale_date) AS INT) AS year, {d('sum(revenue)')} AS revenue, false AS more_exist FROM sold GROUP BY ALL")
# The years of the stored table, the whole of it, and the one refused: bytes of the files add up.
oracle("guard_log", "SELECT DATE '2001-08-01' AS day, count(DISTINCT year(sale_date)) + 1 AS queries, true AS adds_up, 1 AS refused FROM detail")

CTES["texts"] = "SELECT 'documents/' || doc_id AS place, text FROM documents UNION ALL SELECT 'pages/' || page_id, html FROM pages"


def _hits(source: str, keys: str) -> str:
    one = []
    for pattern, label in SECRET_PATTERNS:
        p = quoted(pattern)
        one.append(f"""SELECT {keys}, {quoted(label)} AS label, unnest(hits) AS hit, unnest(range(1, len(hits) + 1)) AS i, hits, parts
  FROM (SELECT {keys}, regexp_extract_all(text, {p}) AS hits, string_split_regex(text, {p}) AS parts FROM {source})""")
    breaks = "length({0}) - length(replace({0}, chr(10), ''))"
    before = f"array_to_string(parts[1:i], '') || array_to_string(hits[1:i - 1], '')"
    return f"""
SELECT {keys}, CAST({breaks.format('(' + before + ')')} + 1 AS BIGINT) AS line, label, replace(left(hit, 60), chr(10), ' ') AS snippet
  FROM ({' UNION ALL '.join(one)})"""


oracle("secret_scan", _hits("texts", "place"))
oracle("secret_scan_summary", f"SELECT label, count(*) AS hits, count(DISTINCT place) AS places FROM ({_hits('texts', 'place')}) GROUP BY label")
CTES["diffs"] = "SELECT source AS file, 'doc' || doc_id || '.txt' AS place, text FROM documents"
oracle("diff_scan", _hits("diffs", "file, place"))
