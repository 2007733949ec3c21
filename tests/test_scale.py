"""Plans that must hold when one key owns a third of all rows."""
import pytest
from pyspark.sql import functions as F

from rollbook import operators as op

SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB", "spark.sql.shuffle.partitions": "8"}


@pytest.fixture
def hot(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    n = F.col("id")
    yield spark.range(0, 300_000, 1, 4).select(
        F.when(n % 3 == 0, -1).otherwise(n % 20_000).alias("k"), (n % 50).alias("d"), n.alias("v"),
        F.concat(F.lit("text"), n).alias("t"), F.when(n % 7 == 0, "YES").otherwise("").alias("i"))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    checked = df.groupBy("d").agg(F.max("t"), *[F.max(c) for c in df.columns if c not in ("d", "t")])
    checked.collect()
    return checked._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("make", [
    lambda df: op.propagate_flag(df, ["k"], {"f": F.col("v") == 9}),
    lambda df: op.single_responsible(df, "k", "i", F.col("v") == 9),
    lambda df: op.enrich(df, [(df.groupBy("k").agg(F.max("v").alias("m")), ["k"], {"m": "m"})]),
    lambda df: op.update_from(df, df.where("v % 5 = 0").withColumnRenamed("t", "u"), ["k"], {"t": "u"}),
    lambda df: op.mark(df, df.where("v % 5 = 0"), ["k"], "f"),
    lambda df: op.cancelled_by(df, df.where("v % 5 = 0").withColumnRenamed("v", "w"), ["k"], [("v", "w")]),
    lambda df: op.semi(df, op.duplicates(df, ["k"]), ["k"]),
    lambda df: op.latest(df.withColumn("same", F.col("k") * 0), ["k"], ["same"], ties=True),
], ids=["propagate_flag", "single_responsible", "enrich", "update_from", "mark", "cancelled_by", "semi", "latest_ties"])
def test_hot_key_is_split_when_joined_back(hot, make):
    plan = final_plan(make(hot))
    assert "skew=true" in plan and "Window" not in plan


def test_hot_key_is_combined_before_the_shuffle(hot):
    picks = op.latest(hot, ["k"], ["d", "v"])
    plan = picks._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
    rows = {r.k: r.v for r in picks.where("k in (-1, 1)").collect()}
    assert rows == {-1: 299949, 1: 280001}
