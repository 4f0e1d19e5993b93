"""The raw log path on small files, through the real reader."""

import pytest
from pyspark.sql import functions as F

from basketlake.functions import numbers
from basketlake.operators import lines, reconcile, rollups
from basketlake.schemas import log_fields, log_schema
from basketlake.sources import sinks
from basketlake.sources.raw_log import read_log

DEFAULTS = {
    "date": "07/01/2026", "time_in_seconds": "43200", "terminal_code": "001", "cashier_code": "07", "multiple": "1",
    "retail": "0.00", "movement_weight": "0", "tender_amount": "0.00", "retail_type": "B", "loyalty_discount": "0.00",
    "premium_discount": "0.00", "unit_cost": "0.00", "unit_deal": "0.00", "store_code": "0000000001",
}
BASKETS = [
    ("1", "UPC", "0000000012345", "112", "1", "3.99", "T", "T1"),
    ("2", "UPC", "0000000067890", "112", "2", "7.50", "TF", "T1"),
    ("3", "UPC", "0000000012345", "112", "-1", "-3.99", "C", "T1"),
    ("4", "TENDER", "CASH", "", "0", "0.00", "", "T1"),
    ("0", "", "", "", "0", "0.00", "", "T1"),
    ("1", "OPEN DEPT 237", "", "237", "1", "12.00", "T", "T2"),
    ("2", "UPC", "0000000067890", "112", "-1", "-3.75", "R", "T2"),
    ("3", "TENDER", "EBT FOOD", "", "0", "0.00", "", "T2"),
    ("0", "", "", "", "0", "0.00", "", "T2"),
]
NAMES = (
    "sequence", "key_function", "key_function_id", "department_code", "movement_count", "ext_sales", "attribute_flag",
    "transaction_code",
)


def record(**values):
    return ",".join('"' + {**DEFAULTS, **values}.get(f, "").replace('"', '""') + '"' for f in log_fields())


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    body = "\n".join(record(**dict(zip(NAMES, b))) for b in BASKETS)
    (folder / "TLOG_2026-07-01_1_0000000001.DAT").write_text(body + "\n")
    return read_log(spark, str(folder))


@pytest.fixture(scope="module")
def master(spark):
    rows = [
        (1, "0000000012345", "Test Bread", "TEST BREAD", "11", "Bread", "112", "Bread", "", 1.50),
        (2, "0000000067890", "Test Milk", "TEST MILK", "12", "Dairy", "9", "Milk", "", 2.00),
        (3, "9", "Apples", "APPLES", "22", "Produce", "237", "Fruit", "", 0.5),
    ]
    names = "ord long, item_id string, item_desc string, product_key string, department_code string, department_name string, category_code string, category_name string, vendor string, unit_cost double"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def detail(raw, master):
    return lines.detail_from_log(raw, master).cache()


def test_golden_baskets(detail):
    rows = detail.collect()
    assert len(rows) == 5
    kinds = [r.transaction_type for r in rows]
    assert (kinds.count("SALE"), kinds.count("VOID"), kinds.count("RETURN")) == (3, 1, 1)
    assert {r.key_function for r in rows} == {"UPC", "OPEN DEPT 237"}
    assert {r.tender_type for r in rows if r.transaction_id == "T1"} == {"CASH"}
    assert {r.tender_type for r in rows if r.transaction_id == "T2"} == {"EBT FOOD"}
    assert (sum(r.is_food_stamp for r in rows), sum(r.is_taxable for r in rows), sum(r.is_loss_event for r in rows)) == (1, 3, 2)
    opened = next(r for r in rows if r.key_function == "OPEN DEPT 237")
    assert opened.department_name == "Produce" and opened.product_key == "OPEN DEPT 22"
    bread = next(r for r in rows if r.item_desc == "Test Bread" and r.transaction_type == "SALE")
    assert float(bread.gross_margin) == 2.49
    assert bread.store_name == "Store 1" and str(bread.transaction_ts) == "2026-07-01 12:00:00"


def test_checks_pass_and_catch_damage(raw, detail):
    items, depts = rollups.item_rollup(detail), rollups.dept_rollup(detail)
    reconcile.require_agreement(reconcile.reconcile(raw, detail, items, depts))
    reconcile.require_agreement(reconcile.check_partitions(detail, items, depts), "item_ok", "dept_ok")
    first = F.col("item_id") == "0000000067890"
    slightly = items.withColumn("revenue", F.col("revenue") + F.when(first, 0.001).otherwise(0).cast("decimal(5,3)"))
    reconcile.require_agreement(reconcile.check_partitions(detail, slightly, depts), "item_ok")
    damaged = [
        items.withColumn("revenue", F.col("revenue") + F.when(first, 0.05).otherwise(0).cast("decimal(5,2)")),
        items.withColumn("line_count", F.col("line_count") + F.when(first, 1).otherwise(0)),
        items.where(~first),
    ]
    for broken in damaged:
        with pytest.raises(reconcile.ReconciliationError):
            reconcile.require_agreement(reconcile.check_partitions(detail, broken, depts), "item_ok")
    with pytest.raises(reconcile.ReconciliationError):
        reconcile.require_agreement(reconcile.reconcile(raw, detail, items, depts.where(F.col("tender_type") != "CASH")))


def test_odd_files(spark, tmp_path, master):
    good = dict(zip(NAMES, BASKETS[0]))
    rows = [
        record(**{**good, "customer_info": 'says "hi", bye'}),
        "",
        ",".join(["07/02/2026", "90000", "001", "07", "1", "UPC"]),
        record(**{**good, "date": "7/1/2026", "time_in_seconds": "90000", "transaction_code": "T9"}) + ",surplus,fields",
        record(**{**good, "date": "bad", "transaction_code": "T9"}),
    ]
    (tmp_path / "a.DAT").write_text("\n".join(rows) + "\n")
    (tmp_path / "empty.dat").write_text("")
    (tmp_path / "other.txt").write_text(record(**good) + "\n")
    log = read_log(spark, str(tmp_path))
    got = log.orderBy("ord").collect()
    assert len(got) == 4
    assert got[0].customer_info == 'says "hi", bye' and got[1].store_code == ""
    assert lines.rejected(log).count() == 1
    stamps = {str(r.transaction_ts) for r in lines.typed(log).collect()}
    assert stamps == {"2026-07-01 12:00:00", "2026-07-02 23:59:59", "2026-07-01 23:59:59"}


def test_runs_cross_blocks_and_come_back(spark):
    keys = ["a", "a", "b", "b", "b", "a", "c", "c"]
    blocks = [0, 0, 0, 1, 1, 2, 2, 3]
    rows = [("f", b, i, k) for i, (k, b) in enumerate(zip(keys, blocks))] + [("g", 0, 0, "c")]
    frame = spark.createDataFrame(rows, "file string, block long, ord long, k string")
    got = lines.runs(frame, F.col("k")).orderBy("file", "ord").collect()
    assert [r.run for r in got] == [0, 0, 1, 1, 1, 2, 3, 3, 0]


def test_layout_is_checked():
    assert len(log_schema().fields) == 36
    with pytest.raises(ValueError):
        log_fields(frozenset({"APPENDTRNCD"}), expected=36)


def test_rendered_amounts_need_no_patterns(spark):
    """Amounts lose their trailing zeros without a regular expression, of which a line would run two dozen."""
    amounts = ["0.00", "-0.10", "100.00", "10.50", "7561.63", "0.05", None]
    frame = spark.createDataFrame([(a,) for a in amounts], "a string").select(F.col("a").cast("decimal(18,2)").alias("retail"))
    assert [r.v for r in frame.select(numbers.plain_number(F.col("retail")).alias("v")).collect()] == ["0", "-0.1", "100", "10.5", "7561.63", "0.05", None]
    plan = frame.select(lines.render(frame).alias("line"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "rlike" not in plan.lower()


def test_tenders_come_from_one_read(spark, raw):
    """Lines and the rows of their blocks come from one shuffle, so the log is parsed once; lines keep all they had."""
    stamped = lines.tendered_runs(raw)
    got = stamped.orderBy("ord").collect()
    assert [r.transaction_no for r in got] == [0] * 5 + [1] * 4 and [r.tender_type for r in got] == ["CASH"] * 5 + ["EBT FOOD"] * 4
    assert set(stamped.columns) == {*raw.columns, "transaction_no", "tender_type"}
    assert [tuple(r) for r in stamped.orderBy("ord").select(*raw.columns).collect()] == [tuple(r) for r in raw.orderBy("ord").collect()]
    stamped.write.format("noop").mode("overwrite").save()
    plan = stamped._jdf.queryExecution()
    stamped.collect()
    shown = plan.executedPlan().toString()
    assert "ReusedExchange" in shown or shown.count("FileScan csv") == 1


def test_gzipped_logs_are_read_like_plain_ones(spark, tmp_path):
    """Logs of the sample are written gzipped, whole files in one piece, and the reader takes both kinds."""
    body = "\n".join(record(**dict(zip(NAMES, b))) for b in BASKETS)
    frame = spark.createDataFrame([("f", i, v, 2026, 7) for i, v in enumerate(body.split("\n"))], "file string, ord long, value string, year int, month int")
    sinks.write_log(frame, str(tmp_path / "zipped"))
    written = [p.name for p in (tmp_path / "zipped").rglob("part-*")]
    assert written and all(name.endswith(".dat.gz") for name in written)
    folder = tmp_path / "plain"
    folder.mkdir()
    (folder / "TLOG_2026-07-01_1_0000000001.DAT").write_text(body + "\n")
    fields = log_fields()
    zipped, plain = (read_log(spark, str(tmp_path / n)).orderBy("ord").select(*fields).collect() for n in ("zipped", "plain"))
    assert zipped == plain and len(plain) == len(BASKETS)
