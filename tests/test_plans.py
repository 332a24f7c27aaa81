"""Plan-shape checks for the properties the operators rely on at scale."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import tokenize
from tessera.adapters import lexicon, zone_map
from tessera.operators.generators import explode_rows
from tessera.operators.sentiment import with_sentiment_code
from tessera.plans.messages import parse_messages, scored_messages
from tessera.operators.relational import top_k_per_group
from tessera.plans.social import topk_with_breakdown
from tessera.registry import QUERIES
from tessera.session import ensure_checkpoint_dir, shared_path

SF = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    s = df._jdf.queryExecution().executedPlan().toString()
    return s.split("== Initial Plan ==")[0]


def test_top_k_per_group_limits_before_shuffle(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    plan = final_plan(top_k_per_group(df, ["g"], 2, [F.col("v").desc()]))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = sorted(tuple(r) for r in top_k_per_group(df, ["g"], 2, [F.col("v").desc()]).collect())
    assert got == sorted([(0, 4998), (0, 4995), (1, 4999), (1, 4996), (2, 4997), (2, 4994)])


def test_topk_breakdown_scans_input_once(spark):
    path = shared_path(spark, "soc")
    spark.createDataFrame([(f"C{i % 13}", i % 3 if i % 11 else None) for i in range(3000)],
                          "country string, sentiment int").write.parquet(path)
    plan = final_plan(topk_with_breakdown(spark.read.parquet(path), k=5))
    assert "ReusedExchange" in plan
    assert plan.count("FileScan parquet") == 1


def test_explode_rows_has_no_inferred_prefilter(spark):
    df = spark.createDataFrame([("a b",), ("",), (None,), ("  ",)], "m string").withColumn("w", tokenize("m"))
    out = explode_rows(df, F.col("w"), "tok")
    optimized = out._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in optimized.split("Generate")[1]
    assert sorted(r.tok for r in out.collect()) == ["", "a", "b"]
    plain = sorted(r.tok for r in df.select(F.explode("w").alias("tok")).collect())
    assert plain == ["", "a", "b"]


def _jobs(spark, name):
    spark.sparkContext.setJobGroup(f"building {name}", name)
    try:
        QUERIES[name](spark, SF)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"building {name}"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_query_runs_no_job(spark):
    # one job reads the footer of each Parquet table that is opened
    for name, tables in (("hvac_building", 2), ("topk_country_sentiment", 3), ("tweet_clean", 1), ("rating_extremes", 1)):
        assert _jobs(spark, name) <= tables, name


def test_no_forced_single_partition_or_spread(spark):
    for name in ("hvac_building", "topk_country_sentiment", "comment_search", "tokenize"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" not in plan and "LocalLimit" not in plan.replace("TakeOrdered", ""), name


def test_one_scan(spark):
    for name in ("ngram_frequency_2", "ngram_frequency_3", "rating_extremes", "comment_search", "tokenize", "table_counts"):
        plan = final_plan(QUERIES[name](spark, SF))
        assert plan.count("FileScan parquet") == 1, name


def test_copies_of_a_message_id_are_spread(spark):
    """A third of all messages under one id, codes too many to be broadcast: several tasks join the copies."""
    rng = random.Random(1)  # text that does not compress to nothing
    texts = ["and " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=800)) for _ in range(6000)]
    rows = [(json.dumps({"id_str": "7" if i % 3 == 0 else str(1000 + i), "text": t, "user": {"time_zone": "src0"}}),) for i, t in enumerate(texts)]
    path = shared_path(spark, "hot-messages")
    spark.createDataFrame(rows, "value string").repartition(12).write.parquet(path)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.files.maxPartitionBytes": "100k", "spark.sql.files.openCostInBytes": "10k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        scored = with_sentiment_code(parse_messages(spark.read.parquet(path)), lexicon(spark))
        by_task = scored.select("id", "sentiment", F.length("text").alias("size"), F.spark_partition_id().alias("task")).groupBy(
            "id", "task", "sentiment").agg(F.count("*").alias("n"), F.sum("size"))
        got = [r for r in by_task.collect() if r.id == 7]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r.n for r in got) == 2000 and len({r.sentiment for r in got}) == 1
    assert len(got) > 1 and max(r.n for r in got) < 2000


def test_messages_without_id_are_spread(spark):
    raw = spark.createDataFrame([(f"{{broken {i}",) for i in range(200)], "value string")
    groups = scored_messages(raw, zone_map(spark), lexicon(spark))
    assert groups.count() == 200 and groups.filter("tweet_id IS NOT NULL OR sentiment IS NOT NULL").count() == 0


def test_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
