import random

import pytest
from pyspark.sql import functions as F

from tessera_spark import session
from tessera_spark.operators import numbering as N


def rows_with_hot_group(n=600):
    rng = random.Random(5)
    rows = [("hot" if i % 3 else f"g{i % 7}", i * 3, rng.random()) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 17])
@pytest.mark.parametrize("span", [10, 1 << 18])
def test_rank_in_group(spark, partitions, span):
    rows = rows_with_hot_group()
    df = spark.createDataFrame(rows, "g string, k long, v double").repartition(partitions)
    key = F.col("k")
    got = {r.k: r.position for r in N.rank_in_group(df, ["g"], [key], N.integer_bucket(key, span)).collect()}
    want, seen = {}, {}
    for g, k, _ in sorted(rows):
        want[k] = seen.get(g, 0)
        seen[g] = want[k] + 1
    assert got == want


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_number_by_range(spark, partitions):
    rows = [(g, f"p{k:06d}") for g, k, _ in rows_with_hot_group()]
    df = spark.createDataFrame(rows, "g string, p string").repartition(partitions)
    got = {r.p: (r.position, r.idx) for r in N.number_by_range(df, ["g", "p"], ["g"], index="idx").collect()}
    want, seen = {}, {}
    for i, (g, p) in enumerate(sorted(rows)):
        want[p] = (i, seen.get(g, 0))
        seen[g] = want[p][1] + 1
    assert got == want


def test_number_by_range_needs_group_first(spark):
    with pytest.raises(ValueError):
        N.number_by_range(spark.range(3).withColumn("g", F.lit(1)), ["id"], ["g"])


@pytest.mark.parametrize("span", [7, 1 << 18])
def test_previous_and_prefix(spark, span):
    rows = rows_with_hot_group(200)
    df = spark.createDataFrame(rows, "g string, k long, v double")
    bucket = N.integer_bucket(F.col("k"), span)
    back = {r.k: r.before for r in N.previous_in_group(df, ["g"], ["k"], bucket, {"before": "v"}).collect()}
    sums = N.prefix_in_group(
        df, ["g"], [F.col("k")], bucket, {"top": ("max", F.col("v")), "total": ("sum", F.col("v"))}
    )
    prefix = {r.k: (r.top, r.total) for r in sums.collect()}
    last, top, total = {}, {}, {}
    for g, k, v in sorted(rows):
        assert back[k] == last.get(g)
        assert prefix[k][0] == top.get(g)
        assert prefix[k][1] == pytest.approx(total.get(g)) if g in total else prefix[k][1] is None
        last[g], top[g], total[g] = v, max(v, top.get(g, v)), total.get(g, 0) + v


def test_previous_keeps_nulls_of_the_value(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 3, "c")], "g int, k long, v string")
    got = N.previous_in_group(df, ["g"], ["k"], N.integer_bucket(F.col("k"), 2), {"b": "v"})
    assert {r.k: r.b for r in got.collect()} == {1: None, 2: "a", 3: None}


def test_batches(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    first = {r.k: r.batch for r in N.assign_batches(df, "k", 256, epoch=1).collect()}
    other = {r.k: r.batch for r in N.assign_batches(df.repartition(9), "k", 256, epoch=1).collect()}
    later = {r.k: r.batch for r in N.assign_batches(df, "k", 256, epoch=2).collect()}
    assert first == other and first != later
    sizes = sorted(list(first.values()).count(b) for b in range(4))
    assert sizes == [232, 256, 256, 256]
    in_order = N.assign_batches(df, "k", 256, shuffle=False).collect()
    assert all(r.batch == r.k // 256 for r in in_order)


def test_settle_beyond_its_bound(spark):
    kept, small = session.settle(spark.range(20), max_rows=5)
    assert not small and kept.count() == 20
    kept, small = session.settle(spark.range(5), max_rows=5)
    assert small and kept.count() == 5


def test_lag_join_shares_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    out = N.previous_in_group(df, ["g"], ["k"], N.integer_bucket(F.col("k"), 8), {"b": "k"})
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
