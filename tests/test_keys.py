from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import keys as K


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_balanced_join_equals_plain_join(spark):
    # A third of the rows on one key, some keys unmatched, some rows without a key.
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
    )
    lookup = spark.createDataFrame([("hot", 1), (None, 9)] + [(f"k{i}", i) for i in range(40)], "key string, v int")
    for how in ("inner", "left"):
        want = sorted(map(repr, facts.join(lookup, "key", how).select("id", "key", "v").collect()))
        for size in (10, 100, 10_000):
            got = K.balanced_join(facts, lookup, "key", how, rows_per_task=size).select("id", "key", "v")
            assert sorted(map(repr, got.collect())) == want


def test_balanced_join_spreads_the_hot_key(spark):
    facts = spark.range(4000).select("id", F.lit("hot").alias("key"))
    lookup = spark.createDataFrame([("hot", 1)], "key string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = K.balanced_join(facts, lookup, "key", rows_per_task=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000


def test_dimension_join_checks_the_size(spark):
    facts = spark.range(100).select((F.col("id") % 5).alias("key"))
    sides = spark.range(5).select(F.col("id").alias("key"), F.lit("x").alias("v"))
    small, large = K.dimension_join(facts, sides, "key"), K.dimension_join(facts, sides, "key", bound=3)
    assert "BroadcastHashJoin" in plan_of(small)
    assert small.count() == large.count() == 100


def test_latest_per_key_cuts_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("key"), "id")
    latest = K.latest_per_key(rows, ["key"], [F.desc("id")])
    assert sorted(r.id for r in latest.collect()) == [998, 999]
    assert plan_of(latest).count("WindowGroupLimit") >= 2


def test_computed_once(spark):
    costly = F.regexp_replace(F.col("t"), "a+", "b")
    rows = spark.createDataFrame([("caat",)], "t string")
    plan = plan_of(K.compute_once(rows, u=costly).filter("u <> '' and u <> 'x'"))
    assert plan.count("regexp_replace") == 1
    assert K.compute_once(rows, u=costly).filter("u = 'cbt'").count() == 1


def test_compute_once_leaves_out_what_nothing_uses(spark):
    rows = spark.range(5).select("id", F.lit("abc").alias("t"))
    made = K.compute_once(rows, u=F.regexp_replace("t", "a", F.col("id").cast("string")), v=F.upper("t"))
    assert "regexp_replace" not in plan_of(made.groupBy("v").count())
    assert [tuple(r) for r in made.select("u", "v").where("id = 3").collect()] == [("3bc", "ABC")]
