"""What keeps the engine's queries fast and exact on large tables."""

import datetime
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from corvane.operators import features, location
from corvane.plans.queries import ORACLE, QUERIES


def differences(spark, folder, name):
    """Rows of a query over the tables in a folder that its SQL hasn't, and the other way round."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in folder.iterdir():
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}/*.parquet'")
    out = QUERIES[name](spark, str(folder))
    wanted = con.execute(f"SELECT {', '.join(out.columns)} FROM ({ORACLE[name]}) q").fetchall()
    found, wanted = sorted(repr(tuple(r)) for r in out.collect()), sorted(map(repr, wanted))
    assert wanted
    return [r for r in found if r not in wanted], [r for r in wanted if r not in found]


#: Third and later sentences that begin with their number or have spaces, spaces beyond ASCII, a vertical tab, texts of no sentence, and none.
ODD = ["One. Two. 28.68. 3 x. 44 4\n  5 y  ", "a.\n\n b!\u00a0 c? \u3000d\u2003", "v.\x0bw. x\x0by\x1cz", "", "\n \n", None, "1. 1. 1 1", " ".join(["w\x0bw"] * 199) + ". " + "x y. " * 150]


@pytest.mark.parametrize("name", ["regrouped_clauses", "sentence_packing"])
def test_sentences_are_those_of_sql(spark, tmp_path, name):
    spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert differences(spark, tmp_path, name) == ([], [])


def test_half_seconds_go_to_the_even_one(spark, tmp_path):
    times = [datetime.datetime(2024, 1, 1, 0, 59, s, us) for s in (58, 59) for us in (0, 499999, 500000, 500001)]
    spark.createDataFrame(list(enumerate(times)), "event_id long, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    assert differences(spark, tmp_path, "time_fields") == ([], [])


def test_tokens_are_those_of_sql(spark, tmp_path):
    texts = ["It's A1 a1", "", "\u00e9 \u4e2d!", None, "\u0130stanbul D\u0130Z \u212a2", "x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert differences(spark, tmp_path, "tokenize") == ([], [])


@pytest.mark.parametrize("observed_only", [False, True])
def test_scores_stay_within_the_jvm_compilers_limit(spark, data, observed_only):
    """HotSpot interprets methods of over 8,000 bytes, which takes ten times as long."""
    from corvane.plans.queries import SMOOTHING, model_of

    m = model_of(spark, data)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = location.scores(m["features"], m["homes"], m["params"], m["overrides"], m["vocab"], m["priors"], SMOOTHING, observed_only)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out._jdf.queryExecution().explainString(mode))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8000


def above_tokens(spark, rows):
    """The part of a plan above its explode: what happens to single features."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return plan[: plan.index("Generate explode")], plan


def test_features_are_counted_where_an_authors_posts_lie(spark, data, monkeypatch):
    """Posts are shuffled, in partitions of bounded size, and not their features."""
    from corvane.sources.posts import posts

    rows = posts(spark, data).withColumn("hour", F.hour("time"))
    above, plan = above_tokens(spark, features.author_features(rows))
    assert "Exchange" not in above and "Exchange hashpartitioning(author" in plan
    monkeypatch.setattr(features, "PART", 10_000)
    assert features.by_author(rows).rdd.getNumPartitions() > 20


def test_first_posts_are_shuffled_once(spark, data):
    from corvane.sources.posts import posts

    first, seen = features.first_posts(posts(spark, data), 2, ["time", "id"])
    above, plan = above_tokens(spark, features.author_features(first.withColumn("hour", F.hour("time")), dealt=True))
    assert "Exchange" not in above and plan.count("hashpartitioning(author") == 1
    assert seen.agg(F.max("seen")).first()[0] == 2
    assert {tuple(r) for r in first.groupBy("author").count().collect()} == {tuple(r) for r in seen.collect()}
