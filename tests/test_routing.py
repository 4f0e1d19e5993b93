"""Which stored table each report reads, and that its days become partition filters."""

import pytest

import workload
from basketlake.plans import recipes, reports
from basketlake.sources import sample

SF = "/root/testdata/sf0.001"
ROUTED = {
    "rollup_item": [
        lambda lake: reports.top_movers(lake, "last_30_days"), lambda lake: reports.sales_summary(lake, "this_year", "department"),
        lambda lake: reports.range_activity(lake, "this_year"), lambda lake: recipes.dept_growth_qoq(lake, "this_year"),
    ],
    "rollup_dept": [
        lambda lake: reports.sales_summary(lake, "this_year", "store"), lambda lake: reports.sales_summary(lake, "this_year", "category"),
        lambda lake: reports.tender_analysis(lake, "this_year"), lambda lake: reports.loss_report(lake, "this_year"), lambda lake: recipes.category_peak_month(lake),
    ],
    "detail": [lambda lake: recipes.basket_size_by_tender(lake, "this_year"), lambda lake: recipes.cashier_void_rate(lake, "this_year")],
}


def scans(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan parquet" in line and "PartitionFilters" in line and any(f"/{t}-" in line for t in ROUTED)]


@pytest.mark.parametrize("name", list(ROUTED))
def test_reports_read_the_smallest_table(spark, name):
    lake = sample.lake(spark, SF)
    for report in ROUTED[name]:
        lines = scans(report(lake))
        assert lines and all(f"/{name}-" in line for line in lines)


def test_days_prune_partitions(spark):
    for line in scans(reports.sales_summary(sample.lake(spark, SF), "this_year", "store")):
        assert "PartitionFilters: []" not in line and "year" in line.split("PartitionFilters:")[1].split("]")[0]


def test_rollups_are_stored_once(spark):
    first = sample.stored_rollups(spark, SF)["rollup_item"].inputFiles()
    workload.QUERIES["top_movers"](spark, SF)
    assert sample.stored_rollups(spark, SF)["rollup_item"].inputFiles() == first
