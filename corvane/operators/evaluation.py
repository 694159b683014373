"""Evaluation of ranked predictions and of annotators."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scores import ratio


def confusion(truth: DataFrame, ranked: DataFrame, k: int = 1) -> DataFrame:
    """(label, tp, fp, fn) of truth (author, label) and predictions (author, location, rank): the first k count as predicted."""
    sets = ranked.where(F.col("rank") <= k).select("author", F.col("location").alias("label"))
    hit = truth.select("author", "label").join(sets, ["author", "label"], "left_semi").select("label", F.lit("tp").alias("kind"))
    missed = truth.select("author", "label").join(sets, ["author", "label"], "left_anti").select("label", F.lit("fn").alias("kind"))
    wrong = sets.join(truth.select("author"), "author", "left_semi").join(truth.select("author", "label"), ["author", "label"], "left_anti").select("label", F.lit("fp").alias("kind"))
    count = lambda kind: F.count_if(F.col("kind") == kind).alias(kind)
    return hit.union(missed).union(wrong).groupBy("label").agg(count("tp"), count("fp"), count("fn"))


def prf(counts: DataFrame) -> DataFrame:
    """Micro and macro precision, recall and F1 of (label, tp, fp, fn); a ratio to 0 is 0, macro means are over all labels."""
    each = counts.withColumn("p", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("r", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    each = each.withColumn("f", ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    sums = each.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")], *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"{name}_macro") for c, name in (("p", "precision"), ("r", "recall"), ("f", "f1"))])
    sums = sums.withColumn("precision_micro", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall_micro", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    sums = sums.withColumn("f1_micro", ratio(2 * F.col("precision_micro") * F.col("recall_micro"), F.col("precision_micro") + F.col("recall_micro")))
    return sums.drop("tp", "fp", "fn")


def ranking(truth: DataFrame, scored: DataFrame) -> DataFrame:
    """n, top1_acc, top5_acc, top10_acc, mrr (over the first ten) and log_loss (over all locations) of scores (author, location, score)."""
    from pyspark.sql import Window

    own = scored.join(truth.select("author"), "author", "left_semi")
    order = Window.partitionBy("author").orderBy(F.desc(F.round("score", 9)), "location")
    every = own.withColumn("rank", F.row_number().over(order))
    norm = own.groupBy("author").agg(F.max("score").alias("__top")).join(own, "author").groupBy("author", "__top").agg(F.sum(F.exp(F.col("score") - F.col("__top"))).alias("__sum"))
    norm = norm.select("author", (F.col("__top") + F.ln("__sum")).alias("__norm"))
    rows = truth.select("author", "label").join(norm, "author", "left").join(every.select("author", F.col("location").alias("label"), "score", "rank"), ["author", "label"], "left")
    hit = lambda k: F.avg(F.when(F.col("rank") <= k, 1.0).otherwise(0.0))
    return rows.agg(
        F.count("*").alias("n"), hit(1).alias("top1_acc"), hit(5).alias("top5_acc"), hit(10).alias("top10_acc"),
        F.avg(F.when(F.col("rank") <= 10, 1.0 / F.col("rank")).otherwise(0.0)).alias("mrr"),
        F.avg(F.coalesce(F.col("__norm") - F.col("score"), F.lit(1e30))).alias("log_loss"),
    )


def in_vocabulary(features: DataFrame, authors: DataFrame, vocab: DataFrame) -> DataFrame:
    """avg_in_vocab_tokens over all the authors."""
    known = features.join(vocab.select("feature"), "feature", "left_semi").groupBy("author").agg(F.sum("cnt").alias("n"))
    return authors.select("author").distinct().join(known, "author", "left").agg(F.avg(F.coalesce("n", F.lit(0))).alias("avg_in_vocab_tokens"))


def seen_labels(truth: DataFrame, trained: DataFrame, unknown: str) -> DataFrame:
    """truth (author, label) with labels that were not trained on (location) as the unknown one."""
    known = trained.select(F.col("location").alias("label")).distinct().withColumn("__known", F.lit(True))
    return truth.join(known, "label", "left").select("author", F.when(F.col("__known"), F.col("label")).otherwise(unknown).alias("label"))


def agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """n, cohen_kappa and pearson of two raters' (doc_id, rating), over the documents both have rated."""
    both = a.select("doc_id", F.col("rating").alias("x")).join(b.select("doc_id", F.col("rating").alias("y")), "doc_id")
    cells = both.groupBy("x", "y").agg(F.count("*").alias("n"))
    rows, columns = cells.groupBy("x").agg(F.sum("n").alias("a")), cells.groupBy("y").agg(F.sum("n").alias("b"))
    chance = rows.join(columns, rows["x"] == columns["y"]).agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("chance"))
    sums = both.agg(F.count("*").alias("n"), F.count_if(F.col("x") == F.col("y")).alias("same"), F.corr(F.col("x").cast("double"), F.col("y").cast("double")).alias("pearson"))
    out = sums.crossJoin(F.broadcast(chance))  # a row each
    observed, expected = F.col("same") / F.col("n"), F.col("chance") / (F.col("n") * F.col("n"))
    return out.select("n", ((observed - expected) / (1 - expected)).alias("cohen_kappa"), "pearson")


def unmatched(a: DataFrame, b: DataFrame) -> DataFrame:
    """(doc_id, rater) of the documents that only one of two raters has."""
    return a.select("doc_id").join(b, "doc_id", "left_anti").withColumn("rater", F.lit(0)).union(b.select("doc_id").join(a, "doc_id", "left_anti").withColumn("rater", F.lit(1)))


def pearson_p(r: float, n: int) -> float:
    """The two-sided p-value of a correlation of n pairs: by the regularized incomplete beta function, as a continued fraction (Lentz)."""
    if n < 3 or math.isnan(r):
        return float("nan")
    if abs(r) >= 1:
        return 0.0
    a, b, x = (n - 2) / 2, 0.5, 1 - r * r

    def fraction(a: float, b: float, x: float) -> float:
        c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or 1e-300)
        out = d
        for m in range(1, 500):
            for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 / (1 + top * d or 1e-300), 1 + top / c or 1e-300
                out *= c * d
            if abs(c * d - 1) < 1e-15:
                break
        return out

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if r else 0.0
    return 1.0 if not r else front * fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * fraction(b, a, 1 - x) / b


def either(*ratings: DataFrame) -> DataFrame:
    """(doc_id, label): 1 if any rater's (doc_id, rating) is not 0."""
    rows = ratings[0].select("doc_id", "rating")
    for r in ratings[1:]:
        rows = rows.unionByName(r.select("doc_id", "rating"))
    return rows.groupBy("doc_id").agg(F.max((F.col("rating") != 0).cast("int")).alias("label"))


def distribution(rows: DataFrame, label: str) -> DataFrame:
    """(label, n): how many rows each label has."""
    return rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))


def summary(rows: DataFrame, label: str) -> DataFrame:
    """(labels, least, most, mean) of a split's label distribution."""
    return distribution(rows, label).agg(F.count("*").alias("labels"), F.min("n").alias("least"), F.max("n").alias("most"), F.avg("n").alias("mean"))


#: What the classes of relevance are called in evaluation files.
LABEL_TITLES = {0: "Irrelevant", 1: "Relevant"}


def titled(label: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in LABEL_TITLES.items() for x in pair]), label.cast("int"))


def write_evaluation(pairs: DataFrame, truth: str, predicted: str, rows_path: str, metrics_path: str, **run: object) -> tuple[float, float, float]:
    """Writes each row's text, true_label and predicted_label as CSV, and appends a row of precision, recall, f1 and the run's parameters to a table."""
    named = pairs.select("text", titled(F.col(truth)).alias("true_label"), titled(F.col(predicted)).alias("predicted_label"))
    named.write.mode("overwrite").option("header", True).option("escape", '"').csv(rows_path)
    scores = binary_prf(pairs, truth, predicted)
    found = scores.first()
    scores.sparkSession.createDataFrame([(*map(float, found), json.dumps(run, sort_keys=True, default=str))], "precision double, recall double, f1 double, run string").withColumn("at", F.current_timestamp()).write.mode("append").parquet(metrics_path)
    return tuple(found)


def class_weights(labels: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): all rows / (classes times the class's rows)."""
    each = labels.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    whole = each.agg(F.sum("n").alias("__all"), F.count("*").alias("__k"))
    return each.crossJoin(F.broadcast(whole)).select("label", "n", (F.col("__all") / (F.col("__k") * F.col("n"))).alias("weight"))


def binary_prf(pairs: DataFrame, truth: str, predicted: str) -> DataFrame:
    """precision, recall and f1 of class 1."""
    sums = pairs.agg(*[F.count_if((F.col(truth) == t) & (F.col(predicted) == p)).alias(k) for k, t, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0))])
    sums = sums.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return sums.select("precision", "recall", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"))


def best_config(results: DataFrame) -> DataFrame:
    """The best row by f1_macro, top5, mrr (descending) and logloss (ascending), then cfg_key."""
    return results.orderBy(F.desc("f1_macro"), F.desc("top5"), F.desc("mrr"), "logloss", "cfg_key").limit(1)
