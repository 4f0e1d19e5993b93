"""Movement reports are summed up once."""

from basketlake.operators import movement
from basketlake.sources import sample

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_movement_rows_and_latest_windows_are_made_once(spark):
    """All counts of the summary read one stored table, and all reads of the cells one table of sums."""
    grid = sample.movement_grid(spark, SF)
    assert "l_linenumber" not in plan(grid) and "l_partkey" not in plan(grid)
    shown = plan(movement.summary(movement.latest(movement.parse(grid))))
    assert "movement-latest" in shown and "row_idx" not in shown
