import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera_spark.operators import checks, split


def frame(spark, sizes):
    rows, key = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((key, label))
            key += 1
    return spark.createDataFrame(rows, "k long, label_id int")


def quotas(sizes, share=0.25):
    total = sum(sizes.values())
    want = math.ceil(share * total)
    whole = {c: want * n // total for c, n in sizes.items()}
    rest = sorted(sizes, key=lambda c: (-(want * sizes[c] % total), c))
    for c in rest[: want - sum(whole.values())]:
        whole[c] += 1
    return whole


SIZES = {0: 300, 1: 41, 2: 7, 3: 2, 4: 150}


@pytest.mark.parametrize("exact_rows", [1_000_000, 1])
@pytest.mark.parametrize("partitions", [1, 13])
def test_stratified_sizes_and_members(spark, monkeypatch, exact_rows, partitions):
    monkeypatch.setattr(split, "EXACT_ROWS", exact_rows)
    rows = frame(spark, SIZES)
    done = split.stratified_split(rows.repartition(partitions), "k").collect()
    assert len(done) == sum(SIZES.values()) and all(r.stratified for r in done)
    assert Counter(r.label_id for r in done if r.split == "val") == Counter(quotas(SIZES))
    ranked = split.stratified_rank(rows, "k").collect()
    want = {r.k for r in ranked if r["rank"] < quotas(SIZES)[r.label_id]}
    assert {r.k for r in done if r.split == "val"} == want


@pytest.mark.parametrize("exact_rows", [1_000_000, 3])
def test_random_split_is_exact(spark, monkeypatch, exact_rows):
    monkeypatch.setattr(split, "EXACT_ROWS", exact_rows)
    rows = frame(spark, {0: 201})
    done = split.random_split(rows, "k").collect()
    order = sorted((r.d, r.k) for r in rows.select("k", split.order_hash(42, F.col("k")).alias("d")).collect())
    assert {r.k for r in done if r.split == "val"} == {k for _, k in order[:51]}
    assert len(done) == 201


@pytest.mark.parametrize("sizes", [{0: 50, 1: 1}, {c: 2 for c in range(8)} | {0: 3}])
def test_fallback_is_flagged(spark, sizes):
    # One class with a single row; and a quarter that is smaller than the number of classes.
    done = split.stratified_split(frame(spark, sizes), "k").collect()
    assert not any(r.stratified for r in done)
    assert sum(r.split == "val" for r in done) == math.ceil(0.25 * sum(sizes.values()))


def test_empty_split(spark):
    assert split.stratified_split(frame(spark, {}), "k").collect() == []


def test_quota_of_huge_counts(spark):
    counts = spark.createDataFrame([(0, 3 * 10**12), (1, 10**12 + 1)], "label_id int, n long")
    got = {r.label_id: r.quota for r in split.class_quotas(counts).collect()}
    assert got == quotas({0: 3 * 10**12, 1: 10**12 + 1})


def test_samples(spark):
    rows = split.stratified_split(frame(spark, SIZES), "k")
    sample = split.sample_rows(rows, "k", 8)
    assert sample.count() == 8
    assert {r.k for r in sample.collect()} == {r.k for r in split.sample_rows(rows.repartition(5), "k", 8).collect()}
    assert split.sample_rows(frame(spark, {0: 3}), "k", 8).count() == 3
    val = split.sample_validation(rows, "k", 10).collect()
    assert len(val) == 10 and all(r.split == "val" for r in val)
    assert split.sample_info(rows, sample, "k").count() == 8
    assert "TakeOrderedAndProject" in sample._jdf.queryExecution().executedPlan().toString()


def test_counts_and_coverage(spark):
    rows = split.stratified_split(frame(spark, SIZES), "k")
    known = spark.createDataFrame([(c, str(c)) for c in range(6)], "label_id int, label_name string")
    assert {r.label_id: r.n for r in split.class_counts(rows, known).collect()} == SIZES | {5: 0}
    cover = {r.label_id: r for r in checks.class_coverage(rows, known).collect()}
    assert cover[5].missing_in_train and cover[5].too_small and not cover[0].too_small
    only_val = rows.withColumn("split", F.when(F.col("label_id") == 4, "val").otherwise(F.col("split")))
    assert tuple(checks.class_count_check(only_val).first()) == (5, 4, True)


def test_the_rows_are_not_shuffled(spark):
    rows = frame(spark, SIZES)
    rows.write.mode("overwrite").format("noop").save()
    plan = split.stratified_split(rows, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_rows_without_label_belong_to_no_class(spark):
    rows = spark.createDataFrame([(k, k % 2 if k < 40 else None) for k in range(50)], "key long, label_id int")
    done = split.stratified_split(rows, "key").collect()
    assert len(done) == 40 and all(r.stratified and r.label_id is not None for r in done)
