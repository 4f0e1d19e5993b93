"""Order of rows over several files: file by name, then place in the file, whatever the files' sizes."""

import pytest
from pyspark.sql import functions as F

from basketlake.operators import catalogue
from basketlake.operators.lines import department_names, item_index
from basketlake.schemas import ITEM_MASTER
from basketlake.sources import dims, sample

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def small_splits(spark):
    """Many splits, of which Spark packs the largest first."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def master_file(folder, name, rows):
    header = ",".join(f.name for f in ITEM_MASTER.fields)
    blank = {f.name: "" for f in ITEM_MASTER.fields}
    body = [",".join(str({**blank, **row}[f.name]) for f in ITEM_MASTER.fields) for row in rows]
    (folder / name).write_text("\n".join([header, *body]) + "\n")


def test_rows_follow_file_names_and_places(spark, tmp_path, small_splits):
    sizes = {"a.csv": 5, "b.csv": 3000, "c.csv": 400}
    for name, n in sizes.items():
        master_file(tmp_path, name, [{"item_id": f"{name}-{i:05d}", "item_desc": "x" * 20} for i in range(n)])
    master = dims.read_item_master(spark, str(tmp_path))
    assert master.rdd.getNumPartitions() > 3
    got = [r.item_id for r in master.orderBy("ord").collect()]
    assert got == [f"{name}-{i:05d}" for name in sorted(sizes) for i in range(sizes[name])]


def test_the_later_row_wins_over_files(spark, tmp_path, small_splits):
    row = {"item_id": "00000000000012", "department_code": "7"}
    filler = [{"item_id": f"{i:014d}", "department_code": "7", "department_name": "NEW"} for i in range(100, 3000)]
    master_file(tmp_path, "1.csv", [*filler, {**row, "item_desc": "first", "department_name": "OLD"}])
    master_file(tmp_path, "2.csv", [{**row, "item_desc": "last", "department_name": "NEWEST"}])
    master = dims.read_item_master(spark, str(tmp_path))
    assert item_index(master).where("_code = '12'").first()._item.item_desc == "last"
    assert department_names(master).first().department_name == "NEWEST"
    turned = dims.read_item_master(spark, [str(tmp_path / "2.csv"), str(tmp_path / "1.csv")])
    assert item_index(turned).where("_code = '12'").first()._item.item_desc == "last"


def test_first_seen_breaks_ties_over_files(spark, tmp_path, small_splits):
    book = sample.price_book(spark, SF)
    columns = [c for c in book.columns if c != "ord"]
    ranked = book.repartitionByRange(3, "ord").sortWithinPartitions("ord")
    ranked.select(*columns).write.options(header=True, escape='"', emptyValue="").csv(str(tmp_path / "book"))
    read = dims.read_price_book(spark, str(tmp_path / "book"), columns)
    assert [tuple(r)[:-1] for r in read.orderBy("ord").collect()] == [tuple(r) for r in book.orderBy("ord").select(*columns).collect()]
    here, there = catalogue.build_items(read).drop("ord"), catalogue.build_items(book).drop("ord")
    assert here.exceptAll(there).count() == 0 and there.exceptAll(here).count() == 0
    votes = [catalogue.category_votes(catalogue.clean(b)).orderBy("dept4") for b in (read, book)]
    kept = [c for c in votes[0].columns if c != "first_seen"]
    assert votes[0].select(*kept).collect() == votes[1].select(*kept).collect()
