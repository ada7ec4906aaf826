from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from slotweave.operators import joins


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def test_planning_runs_no_job(spark):
    left = spark.range(600).selectExpr("case when id < 500 then 1 else id end a", "'x' b", "id")
    right = spark.range(400, 700).selectExpr("id a", "'x' b", "id * 2 v").unionAll(spark.sql("select 1L a, 'x' b, 7L v"))
    before = jobs(spark)
    got = joins.lookup_join(joins.lookup_join(left, right, ["a", "b"]), right.select("a", "b", F.col("v").alias("w")), ["a", "b"])
    assert jobs(spark) == before
    want = left.join(right, ["a", "b"], "left").join(right.select("a", "b", F.col("v").alias("w")), ["a", "b"], "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns


def test_hot_keys_are_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        left = spark.range(0, 60_000, 1, 8).selectExpr("case when id % 3 > 0 then 'hot' else 'k' || id end k", "sha1(string(id)) x")
        right = spark.range(3000).selectExpr("case when id = 0 then 'hot' else 'k' || id * 3 end k", "id v").groupBy("k").agg(F.max("v").alias("v"))
        got = joins.lookup_join(left, right, ["k"])
        assert got.filter("k = 'hot' and v = 0").count() == 40_000
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)), min_size=1, max_size=30),
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), min_size=1, max_size=6),
)
def test_lookup_join_equals_left_join(spark, left_rows, right_rows):
    left = spark.createDataFrame(left_rows, "k string, x int")
    right = spark.createDataFrame(right_rows, "k string, v int")
    got = joins.lookup_join(left, right, ["k"])
    want = left.join(right, ["k"], "left")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "y"), ("b", None, None), (None, 1, "z")], "k string, v int, w string")
    assert sorted(map(tuple, joins.one_row_per_key(df, ["k"]).collect())) == [("a", 1, "y"), ("b", None, None)]
    assert joins.one_row_per_key(df.select("k"), ["k"]).count() == 2
