import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.dedup import keep_first
from tallyloom.operators.global_order import ntile_scores, range_layout, row_index, running_total


@pytest.fixture(scope="module")
def many_partitions(spark):
    """Keep AQE from merging the small test partitions into one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def skewed(spark):
    """Values of which a third is one and the same."""
    rng = random.Random(7)
    rows = [(i, 50 if i % 3 == 0 else rng.randint(0, 400)) for i in range(1000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id bigint, v bigint").repartition(5)


def test_layout_uses_several_partitions(many_partitions, skewed):
    layout = range_layout(skewed, [F.col("v"), F.col("id")], "t")
    sizes = [r["count"] for r in layout.groupBy("_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 500


def test_layout_has_as_many_parts_as_asked_for(many_partitions, skewed):
    layout = range_layout(skewed, [F.col("v"), F.col("id")], "t", parts=9, without=["v"])
    assert layout.groupBy("_part").count().count() == 9 and "v" not in layout.columns
    few = range_layout(skewed, [F.col("v"), F.col("id")], "t", parts=2)
    assert few.groupBy("_part").count().count() == 4
    got = row_index(skewed, [F.desc("v"), F.col("id")], parts=9, without=["v"]).join(skewed, "id")
    expected = skewed.withColumn("row_index", F.row_number().over(W.orderBy(F.desc("v"), "id")))
    assert sorted(got.select("id", "v", "row_index").collect()) == sorted(expected.collect())


def test_row_index_matches_row_number(many_partitions, skewed):
    got = row_index(skewed, [F.desc("v"), F.col("id")])
    expected = skewed.withColumn("row_index", F.row_number().over(W.orderBy(F.desc("v"), "id")))
    assert sorted(got.collect()) == sorted(expected.collect())


def test_row_index_start_and_empty(spark, many_partitions, skewed):
    got = row_index(skewed, [F.col("id")], start=100)
    assert got.agg(F.min("row_index"), F.max("row_index")).first()[:] == (100, 1099)
    assert row_index(skewed.filter("id < 0"), [F.col("id")]).count() == 0


def test_running_total_matches_window(many_partitions, skewed):
    got = running_total(skewed, [F.col("v"), F.col("id")], "v", "total")
    frame = W.orderBy("v", "id").rowsBetween(W.unboundedPreceding, 0)
    expected = skewed.withColumn("total", F.sum("v").over(frame))
    assert sorted(map(tuple, got.select("id", "total").collect())) == sorted(
        map(tuple, expected.select("id", "total").collect())
    )


@pytest.mark.parametrize("rows", [0, 1, 3, 5, 7, 1000])
def test_ntile_matches_window(many_partitions, skewed, rows):
    df = skewed.filter(F.col("id") < rows)
    got = ntile_scores(
        df, "id", {"a": F.col("v"), "b": -F.col("id")}, {"a": "a_tile", "b": "b_tile"}
    )
    expected = df.select(
        "id",
        F.ntile(5).over(W.orderBy("v", "id")).alias("a_tile"),
        F.ntile(5).over(W.orderBy(F.desc("id"))).alias("b_tile"),
    )
    columns = ["id", "a_tile", "b_tile"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, expected.collect())
    )


def test_keep_first_limits_groups_before_the_shuffle(spark, skewed):
    plan = keep_first(skewed, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_no_single_partition_exchange_for_scores(many_partitions, skewed):
    got = ntile_scores(skewed, "id", {"a": F.col("v")}, {"a": "tile"})
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # The only unpartitioned window runs over one row per partition.
    assert plan.count("Window [") == 1
    assert "windowspecdefinition(_part" in plan


def test_index_without_an_order_is_dense_and_unique(many_partitions, skewed):
    got = row_index(skewed, None, start=10)
    assert sorted(r.row_index for r in got.collect()) == list(range(10, 1010))
    assert got.select("id").distinct().count() == 1000
