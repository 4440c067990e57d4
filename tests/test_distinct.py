"""Mergeable distinct counts against the planner's own."""

import random

import pytest
from pyspark.sql import functions as F

from bizregistry.operators import Lookup, count_sets, distinct_sets, merge_sets, opening_counts
from bizregistry.operators.aggregates import _is_small


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def companies(rng):
    """Numbers of eight digits, and others that are none or of another length."""
    kind = rng.randrange(12)
    number = rng.randrange(300)
    special = {0: None, 1: f"{number}", 2: f"0{number:08d}", 3: f"{number:07d}X", 4: ""}
    return special.get(kind, f"{number:08d}")


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(1)
    data = [
        (companies(rng), rng.randrange(-5, 900), rng.choice([1, 2, 2, 2, 2, 3, 4, 5, None]), rng.randrange(3))
        for _ in range(4000)
    ]
    return spark.createDataFrame(data, "company string, number int, code int, k int").repartition(5)


@pytest.fixture(scope="module")
def cities(spark):
    """Two codes with one name, a code with two names, one without a name; 5 is in no row."""
    return spark.sql("SELECT * FROM VALUES (1, 'A'), (2, 'A'), (3, 'B'), (3, 'C'), (4, NULL) t(code, name)")


@pytest.mark.parametrize("value", ["company", "number"])
def test_sets_count_and_merge(facts, value):
    facts = facts.withColumn("wide", F.col("number").cast("bigint") * 10**12)
    for column in {value, "wide"}:
        want = rows(facts.groupBy("k").agg(F.countDistinct(column).alias("n")))
        fine = distinct_sets(facts, ["k", "code"], column)
        assert rows(count_sets(merge_sets(fine, ["k"]), ["k"], "n")) == want
        # Merged from parts that overlap.
        parts = [distinct_sets(facts.filter(f"number % 3 <> {i}"), ["k"], column) for i in range(3)]
        both = parts[0].unionByName(parts[1]).unionByName(parts[2])
        assert rows(count_sets(merge_sets(both, ["k"]), ["k"], "n")) == want


def test_rows_of_a_set(spark):
    """Neighbours share a row; what is no number of eight digits has its own."""
    data = [(f"{i:08d}",) for i in range(128)] + [("00000127",), ("127",), ("x",), (None,)]
    sets = distinct_sets(spark.createDataFrame(data, "v string"), [], "v")
    assert rows(sets.select("word", "rest", F.bit_count("bits"))) == sorted(
        [(0, None, 64), (1, None, 64), (None, "127", 1), (None, "x", 1), (None, None, 0)], key=str
    )
    empty = spark.createDataFrame([], "k int, v string")
    assert rows(count_sets(distinct_sets(empty, ["k"], "v"), ["k"], "n")) == []
    nulls = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(count_sets(distinct_sets(nulls, ["k"], "v"), ["k"], "n")) == [(1, 0)]


@pytest.mark.parametrize("value", ["company", "number"])
def test_both_ways_give_the_same(spark, facts, cities, value):
    """A table over the threshold meets sets, not rows; copies, gaps and NULLs count alike."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    found = {}
    for threshold in ("10m", "-1"):
        spark.conf.set(key, threshold)
        try:
            counts = opening_counts(
                facts,
                keys={"half": F.col("k") % 2},
                lookups=[Lookup(cities, "code", columns=["name"])],
                count=value,
                distinct=True,
                name="n",
            )
            found[threshold] = rows(counts)
            plan = counts._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.set(key, before)
        assert ("bit_or" in plan) == (threshold == "-1")
    assert found["10m"] == found["-1"] and len(found["10m"]) == 8
    joined = facts.join(cities, "code", "left").groupBy((F.col("k") % 2).alias("half"), "name")
    assert rows(joined.agg(F.countDistinct(value).alias("n"))) == found["-1"]


def test_no_row_is_shuffled_by_a_label(spark, facts, cities, tmp_path):
    """What meets the large code table has been gathered by code."""
    facts.write.parquet(f"{tmp_path}/facts")
    table = spark.read.parquet(f"{tmp_path}/facts")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert not _is_small(cities)
        lookup = Lookup(cities, "code", columns=["name"])
        counts = opening_counts(
            table, keys={"k": F.col("k")}, lookups=[lookup], count="company", distinct=True
        )
        lines = counts._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set(key, before)
    depth = {line.index(name): name for line in lines for name in ("SortMergeJoin",) if name in line}
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "company" in line)
    assert depth and any("bit_or" in line for line in lines[join:scan])
    assert _is_small(spark.range(10)) and not _is_small(spark.range(10**12))
