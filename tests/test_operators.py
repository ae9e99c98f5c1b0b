from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardline.functions import age_years, average, percent, quotient
from wardline.operators import anti_join, dense_rank_desc, joins, prefilter, repeat_rows
from wardline.session import materialize


def _amounts(spark, kind):
    ids = spark.range(0, 5000, numPartitions=7)
    scattered = (F.xxhash64("id") % 100_000).cast("decimal(38,2)") / 100
    values = {
        "scattered": scattered,
        "a third alike": F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(scattered),
        "a third null": F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(scattered),
        "few values": F.col("id") % 4,
        "all alike": F.lit(7),
        "all null": F.lit(None),
    }
    return ids.select(F.col("id").cast("string"), values[kind].cast("decimal(38,2)").alias("v"))


@pytest.mark.parametrize("kind", ["scattered", "a third alike", "a third null", "few values", "all alike", "all null"])
@pytest.mark.parametrize("buckets", [2, 9, 64])
def test_dense_rank_over_ranges(spark, kind, buckets):
    df = _amounts(spark, kind)
    plain = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.desc("v"))))
    ranged = dense_rank_desc(df, "v", "r", "id", one_task_rows=0, buckets=buckets)
    assert {r.id: (r.v, r.r) for r in ranged.collect()} == {r.id: (r.v, r.r) for r in plain.collect()}


def test_dense_rank_of_nothing(spark):
    df = spark.createDataFrame([], "id string, v decimal(38,2)")
    assert dense_rank_desc(df, "v", "r", "id", one_task_rows=-1, buckets=4).collect() == []


@pytest.mark.parametrize("kind", ["a third alike", "a third null", "all alike"])
def test_dense_rank_spreads_a_shared_value(spark, monkeypatch, kind):
    """No range gets all rows of a value that a third of the rows have."""
    from wardline.operators import ranking

    written = []
    monkeypatch.setattr(ranking, "materialize", lambda df, label: written.append(df.cache()) or written[-1])
    dense_rank_desc(_amounts(spark, kind), "v", "r", "id", max_rows=5000, one_task_rows=0, buckets=32).count()
    sizes = written[0].groupBy("_range").count().agg(F.max("count")).first()[0]
    assert len(written) == 1 and sizes < 5000 / 8


@pytest.mark.parametrize("hot_rows", [1, 3, 50, 10_000])
def test_anti_join_with_hot_keys(spark, hot_rows):
    left = spark.range(0, 3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot and matched")
        .when(F.col("id") % 3 == 1, "hot and unmatched")
        .when(F.col("id") % 10 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("ref"),
    )
    keys = spark.range(0, 200).select(
        F.when(F.col("id") == 0, None)
        .when(F.col("id") < 50, "hot and matched")
        .otherwise(F.concat(F.lit("k"), (F.col("id") - 50).cast("string")))
        .alias("key")
    )
    known = {r.key for r in keys.collect()}
    expected = {r.id for r in left.collect() if r.ref is None or r.ref not in known}
    for broadcast_rows in (0, 200):
        joined = anti_join(left, keys, "ref", "key", 3000, 200, hot_rows, broadcast_rows)
        found = [r.id for r in joined.collect()]
        assert len(found) == len(set(found)) and set(found) == expected


@pytest.mark.parametrize("hot_rows", [2, 500, 10_000])
def test_anti_join_writes_no_values_where_most_rows_stay(spark, monkeypatch, hot_rows):
    """Only hot values are written, and what is left of the rows is shuffled once."""
    value = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 0, None).otherwise(F.concat(F.lit("k"), "id"))
    left = spark.range(0, 3000).select("id", value.alias("v"))
    keys = spark.range(0, 600).select(F.when(F.col("id") % 5 != 0, F.concat(F.lit("k"), F.floor(F.col("id") / 2))).alias("k"))
    known = {r.k for r in keys.collect()} - {None}
    for more in ([], ["hot"]):
        wanted = {r.id for r in left.collect() if r.v not in known.union(more)}
        given = keys.unionByName(spark.createDataFrame([(k,) for k in more], "k string"))
        written = []
        monkeypatch.setattr(joins, "materialize", lambda df, label: written.append(df := materialize(df, label)) or df)
        joined = anti_join(left, given, "v", "k", 3000, 600, hot_rows, broadcast_rows=100, most_stay=True)
        found = [r.id for r in joined.collect()]
        assert len(found) == len(set(found)) and set(found) == wanted
        assert [df.count() for df in written] == [{2: 1, 500: 1, 10_000: 0}[hot_rows]]


def test_anti_join_writes_references_once(spark, monkeypatch):
    """References that have a counterpart and are not hot are never written."""
    left = spark.range(0, 3000).select("id", (F.col("id") % 1000).alias("v"))
    keys = spark.range(0, 990).select(F.col("id").alias("k"))
    written = []
    monkeypatch.setattr(joins, "materialize", lambda df, label: written.append(df := materialize(df, label)) or df)
    found = anti_join(left, keys, "v", "k", 3000, 990, broadcast_rows=100)
    assert {r.id % 1000 for r in found.collect()} == set(range(990, 1000))
    assert [df.count() for df in written] == [10]


@pytest.mark.parametrize("chunk", [1, 4, 7, 1000])
def test_repeat_rows(spark, chunk):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 4), ("d", 7), ("e", 8), ("f", 50), (None, 15)], "k string, n long")
    expected = {"b": 1, "c": 4, "d": 7, "e": 8, "f": 50, None: 15}
    for limit in (0, 85):
        out = repeat_rows(df, "n", total=85, chunk=chunk, one_task_copies=limit)
        assert out.columns == ["k"]
        assert {r.k: r["count"] for r in out.groupBy("k").count().collect()} == expected


def test_prefilter_only_with_few_keys(spark):
    left = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k long")
    assert {r.k for r in prefilter(left, keys, "k", max_rows=3).collect()} == {1, 3}
    assert prefilter(left, keys, "k", max_rows=2).count() == 100


@pytest.mark.parametrize(
    "born,as_of,years",
    [
        (date(2004, 2, 29), date(2023, 2, 27), 18),
        (date(2004, 2, 29), date(2023, 2, 28), 19),
        (date(2004, 2, 29), date(2024, 2, 28), 19),
        (date(2004, 2, 29), date(2024, 2, 29), 20),
        (date(2000, 12, 3), date(2026, 12, 3), 26),
        (date(2000, 12, 4), date(2026, 12, 3), 25),
        (None, date(2026, 12, 3), None),
    ],
)
def test_age(spark, born, as_of, years):
    df = spark.createDataFrame([(born,)], "d date")
    assert df.select(age_years(F.col("d"), as_of)).first()[0] == years


def test_division_rounds_once(spark):
    # 2000001 / 400000 = 5.0000025; 0.0049999995 must not become 0.01 by way of 0.005000.
    df = spark.sql("select cast(9999999 as decimal(38,2)) as n, 2000000000L as d, 0L as z")
    row = df.select(
        quotient(F.col("n"), F.col("d")).cast("decimal(10,2)").alias("two"),
        average(F.lit(2000001), F.lit(400000)).alias("six"),
        percent(F.col("n"), F.col("z")).alias("none"),
        percent(F.lit(1), F.lit(3)).alias("third"),
        percent(F.lit(1), F.lit(800), "decimal(5,2)").alias("tie"),
    ).first()
    assert tuple(row) == (Decimal("0.00"), Decimal("5.000003"), None, Decimal("33.33"), Decimal("0.13"))


def test_anti_join_keeps_hot_values_with_a_counterpart_out_of_the_shuffle(spark):
    """A third of three million references are to one known key."""
    left = spark.range(0, 3_000_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, "known").otherwise(F.concat(F.lit("k"), F.col("id") % 50_000)).alias("v")
    )
    keys = spark.range(0, 40_000).select(F.concat(F.lit("k"), "id").alias("k")).unionByName(
        spark.createDataFrame([("known",)], "k string")
    )
    found = anti_join(left, keys, "v", "k", 3_000_000, 40_001, hot_rows=100_000, broadcast_rows=100)
    assert found.count() == left.where("v <> 'known' and cast(substring(v, 2) as int) >= 40000").count()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    shuffled = plan[plan.rindex("Join LeftSemi") :]
    above_scan = shuffled[: shuffled.index("Range (0, 3000000")]
    assert "strategy=broadcast" not in above_scan.splitlines()[0]
    assert "Join LeftAnti" in above_scan and "rightHint=(strategy=broadcast)" in above_scan
    # What is shuffled holds none of the hot value's rows.
    rest = left.join(F.broadcast(spark.createDataFrame([("known",)], "v string")), "v", "left_anti")
    assert rest.groupBy("v").count().agg(F.max("count")).first()[0] < 100
