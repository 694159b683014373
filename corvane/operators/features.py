"""Author features and the vocabulary statistics over them. Long tables: (author, feature, cnt) and (location, feature, cnt)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.text import is_author, unprefixed_keys
from corvane.sources.scratch import written


#: Bytes of input files whose posts make a partition when posts are dealt out by author.
PART = 16 << 20


def by_author(posts: DataFrame) -> DataFrame:
    """posts dealt out so that an author's lie together, in partitions whose size doesn't grow with the input: what is counted there need not be shuffled."""
    spark = posts.sparkSession
    leaves = posts._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    known = sum(n for n in sizes if n < 1 << 60)  # rows of the driver's have no size
    return posts.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), known // PART), "author")


def first_posts(posts: DataFrame, most: int, order: list) -> tuple[DataFrame, DataFrame]:
    """The first `most` posts of each author in scan order, those of an author together, and (author, seen): how many those are."""
    own = posts.where(is_author(F.col("author")))
    number = F.row_number().over(Window.partitionBy("author").orderBy(*order))
    first = by_author(own).withColumn("__n", number).where(F.col("__n") <= most).drop("__n")
    return first, own.groupBy("author").agg(F.least(F.count("*"), F.lit(most).cast("long")).alias("seen"))


def author_features(posts: DataFrame, dealt: bool = False) -> DataFrame:
    """(author, feature, cnt) from posts (author, text, subreddit, hour); blank and deleted authors are left out. Posts are moved, not their
    features, unless they have been `dealt` out by author before."""
    own = posts.where(is_author(F.col("author"))).select("author", "text", "subreddit", "hour")
    own = own if dealt else by_author(own)
    # Words get their prefix when they are counted; no word has a colon.
    keys = own.select("author", F.explode(unprefixed_keys(F.col("text"), F.col("subreddit"), F.col("hour"))).alias("key"))
    feature = F.when(F.contains("key", F.lit(":")), F.col("key")).otherwise(F.concat(F.lit("w:"), F.col("key")))
    return keys.groupBy("author", "key").agg(F.count("*").alias("cnt")).select("author", feature.alias("feature"), "cnt")


def merged_features(*tables: DataFrame) -> DataFrame:
    """The union of (author, feature, cnt) tables with equal keys added up."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy("author", "feature").agg(F.sum("cnt").alias("cnt"))


def unlabelled(features: DataFrame, homes: DataFrame) -> DataFrame:
    """(authors, unlabelled): how many authors have features, and how many of them no location."""
    own = features.select("author").distinct().join(homes.select("author", F.lit(1).alias("home")), "author", "left")
    return own.agg(F.count("*").alias("authors"), F.count_if(F.col("home").isNull()).alias("unlabelled"))


def location_features(features: DataFrame, homes: DataFrame) -> DataFrame:
    """(location, feature, cnt) of the users (author, location); users without a location are left out."""
    return features.join(homes, "author").groupBy("location", "feature").agg(F.sum("cnt").alias("cnt"))


def feature_totals(features: DataFrame) -> DataFrame:
    return features.groupBy("feature").agg(F.sum("cnt").alias("total"))


def priors(homes: DataFrame, kappa: float = 0.0, unknown: bool = False) -> DataFrame:
    """(location, n, prior): (n + kappa) / (N + kappa L), L with one more for unknown locations if asked."""
    each = homes.groupBy("location").agg(F.count("*").alias("n"))
    whole = each.agg(F.sum("n").alias("__all"), (F.count("*") + int(unknown)).alias("__places"))
    out = each.crossJoin(F.broadcast(whole))  # one row
    return out.select("location", "n", ((F.col("n") + kappa) / (F.col("__all") + kappa * F.col("__places"))).alias("prior"))


def mutual_information(by_location: DataFrame, location_priors: DataFrame, least: int) -> DataFrame:
    """(feature, mi) of the features with at least `least` tokens: the sum over locations of p(l, f) ln(p(l, f) / (p(l) p(f))).

    p(l) is the prior, scaled to the locations that have tokens; if those have none, the location's part of all tokens.
    """
    places = by_location.groupBy("location").agg(F.sum("cnt").alias("__tokens")).where("__tokens > 0").join(location_priors.select("location", "prior"), "location", "left")
    sums = places.agg(F.sum("__tokens").alias("__all"), F.coalesce(F.sum("prior"), F.lit(0.0)).alias("__mass"))
    places = places.crossJoin(F.broadcast(sums)).select("location", "__all", F.when(F.col("__mass") > 0, F.coalesce("prior", F.lit(0.0)) / F.col("__mass")).otherwise(F.col("__tokens") / F.col("__all")).alias("__p"))
    places = written(places, "places")  # one row for each location: Spark broadcasts it if it is small by its own measure
    # A feature's counts come together once, one for each location at most, with their total.
    listed = by_location.where("cnt > 0").groupBy("feature").agg(F.sum("cnt").alias("total"), F.collect_list(F.struct("location", "cnt")).alias("__each")).where(F.col("total") >= least)
    p = F.col("cnt") / F.col("__all")
    term = p * F.ln(p / (F.col("__p") * (F.col("total") / F.col("__all"))))
    return listed.select("feature", "total", F.inline("__each")).join(places, "location").groupBy("feature").agg(F.sum(term).alias("mi"))


def vocabulary(totals: DataFrame, size: int, mi: DataFrame | None = None) -> DataFrame:
    """(feature, rank): the `size` features of the most tokens; or of the highest mutual information, filled up from the most frequent. Ties: by name."""
    if mi is None:
        top = totals.orderBy(F.desc("total"), "feature").limit(size)
        return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), "feature"))).select("feature", "rank")
    first = mi.orderBy(F.desc(F.round("mi", 9)), "feature").limit(size).select("feature", F.lit(0).alias("__source"), F.round("mi", 9).alias("__value"))
    fill = totals.join(mi.select("feature"), "feature", "left_anti").orderBy(F.desc("total"), "feature").limit(size).select("feature", F.lit(1).alias("__source"), F.col("total").cast("double").alias("__value"))
    order = ["__source", F.desc("__value"), "feature"]
    return first.unionByName(fill).withColumn("rank", F.row_number().over(Window.orderBy(*order))).where(F.col("rank") <= size).select("feature", "rank")
