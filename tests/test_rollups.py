"""Rollups from one pass over sorted lines."""

from pyspark.sql import functions as F

from basketlake.operators import rollups
from basketlake.schemas import ITEM_ROLLUP_KEYS
from basketlake.sources import sample

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_rollup_lines_are_taken_once(spark):
    """Each line by one window a key, not by partial and final aggregates of two levels; rows are those counted by hand."""
    detail = sample.detail(spark, SF).limit(400)
    null = F.lit(None).cast("string")
    odd = detail.unionAll(detail.limit(90)).withColumns({
        "transaction_id": F.when(F.col("sequence") != 3, F.col("transaction_id")),
        "item_id": F.when(F.col("sequence") > 1, F.col("item_id")).otherwise(null),
        "product_key": F.when(F.col("sequence") > 1, F.col("product_key")).otherwise(null),
        "quantity": F.when(F.col("sequence") != 2, F.col("quantity")),
    }).localCheckpoint()
    numbers = odd.select("transaction_id").where("transaction_id is not null").distinct().select(
        "transaction_id", F.col("transaction_id").cast("long").alias("basket_no")
    ).where("basket_no % 5 > 0")
    want = {}
    for r in odd.withColumn("sale_date", F.to_date("transaction_ts")).collect():
        w = want.setdefault(tuple(r[k] for k in ITEM_ROLLUP_KEYS), [None, 0, 0, 0, set(), []])
        w[0] = w[0] if r.quantity is None else (w[0] or 0) + r.quantity
        w[1], w[2], w[3] = w[1] + r.extended_price, w[2] + r.loyalty_discount + r.premium_discount, w[3] + 1
        w[4].add(r.transaction_id)
        w[5].append(r.item_desc)
    for known in (None, numbers):
        rolled = rollups.item_rollup(odd, known)
        assert "partial_sum" not in plan(rolled) and "partial_collect_list" not in plan(rolled)
        got = {tuple(r[k] for k in ITEM_ROLLUP_KEYS): r for r in rolled.collect()}
        assert set(got) == set(want)
        for key, (units, revenue, discount, lines, ids, texts) in want.items():
            r = got[key]
            assert (r.units, r.revenue, r.discount, r.line_count, r.basket_count, r.item_desc) == (units, revenue, discount, lines, len(ids), min(texts))
            assert known is None or r.baskets == sorted(int(i) for i in ids if i is not None and int(i) % 5 > 0)
