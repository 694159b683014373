"""The Dirichlet-multinomial location model: parameters, scores, decisions and the author cache."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.scores import lgamma_rise
from corvane.functions.text import clean_author, hour_of, is_author
from corvane.operators import features
from corvane.sources.scratch import written

UNKNOWN = "__UNKNOWN__"
LEAST_SEEN, LEAST_MARGIN = 10, 1.5


@dataclass(frozen=True)
class Smoothing:
    """Base pseudo-counts by the prefix of a feature; one without a known prefix counts as a word."""

    word: float = 0.1
    sub: float = 0.1
    hour: float = 0.1

    def of(self, feature: Column) -> Column:
        return F.when(F.startswith(feature, F.lit("s:")), self.sub).when(F.startswith(feature, F.lit("h:")), self.hour).otherwise(self.word)

    def lgamma(self, feature: Column) -> Column:
        word, sub, hour = map(math.lgamma, (self.word, self.sub, self.hour))
        return F.when(F.startswith(feature, F.lit("s:")), sub).when(F.startswith(feature, F.lit("h:")), hour).otherwise(word)


def location_params(by_location: DataFrame, vocab: DataFrame, locations: DataFrame, smoothing: Smoothing) -> tuple[DataFrame, DataFrame]:
    """(location, alpha_sum, lgamma_sum, const) and the overrides (location, feature, cnt) over the vocabulary.

    alpha_sum = sum of the base over the vocabulary and of the location's counts in it; lgamma_sum = sum over the vocabulary of ln
    gamma(alpha); const = ln gamma(alpha_sum) - lgamma_sum.
    """
    counts = vocab.agg(F.count_if(F.startswith("feature", F.lit("s:"))).alias("s"), F.count_if(F.startswith("feature", F.lit("h:"))).alias("h"), F.count("*").alias("n")).first()
    sizes = ((smoothing.sub, counts["s"]), (smoothing.hour, counts["h"]), (smoothing.word, counts["n"] - counts["s"] - counts["h"]))
    base, lgamma_base = sum(a * n for a, n in sizes), sum(math.lgamma(a) * n for a, n in sizes)
    overrides = by_location.where("cnt > 0").join(vocab.select("feature"), "feature", "left_semi").select("location", "feature", "cnt")
    sums = overrides.groupBy("location").agg(F.sum("cnt").alias("__n"), F.sum(lgamma_rise(smoothing.of(F.col("feature")), F.col("cnt"))).alias("__rise"))
    n, rise = F.coalesce("__n", F.lit(0)), F.coalesce("__rise", F.lit(0.0))
    # ln gamma(base + n) = ln gamma(base) + the rise; base is a number of the driver's.
    const = F.lit(math.lgamma(base) if base > 0 else 0.0) + lgamma_rise(F.lit(base), n) - (F.lit(lgamma_base) + rise)
    params = locations.select("location").join(sums, "location", "left").select("location", (F.lit(base) + n).alias("alpha_sum"), (F.lit(lgamma_base) + rise).alias("lgamma_sum"), const.alias("const"))
    return params, overrides


def scores(features: DataFrame, authors: DataFrame, params: DataFrame, overrides: DataFrame, vocab: DataFrame, location_priors: DataFrame, smoothing: Smoothing, observed_only: bool = False) -> DataFrame:
    """(author, location, score): ln prior + ln likelihood of every author's counts at every location.

    The likelihood is the Dirichlet-multinomial's: a base sum by author, plus a change where a location has counts of the author's
    features. Each feature of the vocabulary brings the list of its locations, so that a feature's row joins an author's once, without
    a join of the two by a feature that all share; sums are taken before anything is shuffled, and what then meets is a number for each
    author and location. An author without known features gets the priors. `observed_only` gives the score of training: without the
    terms ln gamma(alpha) of the features that the author doesn't have.
    """
    listed = overrides.groupBy("feature").agg(F.collect_list(F.struct("location", "cnt")).alias("__each"))
    # A row for each feature of the vocabulary; Spark broadcasts the table if it is small by its own measure. What depends on the feature
    # alone is computed here: the first entry is the base's, and `more` is added to an entry's term.
    entries = vocab.select("feature", smoothing.of(F.col("feature")).alias("alpha")).join(listed, "feature", "left")
    entries = entries.select("feature", "alpha", F.inline_outer("__each")).withColumn("c", F.coalesce("cnt", F.lit(0)))
    entries = entries.select("feature", "alpha", "location", (F.col("alpha") + F.col("c")).alias("at"), (lgamma_rise(F.col("alpha"), F.col("c")) if observed_only else F.lit(0.0)).alias("more"))
    own = smoothing.lgamma(F.col("feature")) if observed_only else F.lit(0.0)
    base = F.array(F.struct(F.lit(None).cast("string").alias("location"), F.col("alpha").alias("at"), own.alias("more")))
    by_feature = entries.groupBy("feature", "alpha").agg(F.collect_list(F.when(F.col("location").isNotNull(), F.struct("location", "at", "more"))).alias("places"))
    by_feature = written(by_feature.select("feature", "alpha", F.concat(base, "places").alias("places")), "by_feature")
    # The JVM's compiler leaves out methods of over 8,000 bytes, so each of the two terms has a step of its own, without branches.
    known = features.where("cnt > 0").join(by_feature, "feature").select("author", "cnt", lgamma_rise(F.col("alpha"), F.col("cnt")).alias("of_base"), "places")
    known = known.select("author", "cnt", "of_base", F.inline("places"))
    of_all = F.col("location").isNull()
    # lgamma(alpha + c + n) - lgamma(alpha + c) in place of the base term.
    known = known.select("author", "location", "cnt", "more", "of_base", lgamma_rise(F.col("at"), F.col("cnt")).alias("of_place"))
    parts = known.select("author", "location", (F.col("of_place") + F.col("more") - F.when(of_all, 0.0).otherwise(F.col("of_base"))).alias("x"), F.when(of_all, F.col("cnt")).otherwise(0).cast("long").alias("n"))
    places = params.join(location_priors.select("location", "prior"), "location", "left").select("location", "alpha_sum", "lgamma_sum", F.ln(F.coalesce("prior", F.lit(1e-30))).alias("prior"))
    places = written(places, "places")
    zero = authors.select("author").distinct().crossJoin(F.broadcast(places.select("location"))).select("author", "location", F.lit(0.0).alias("x"), F.lit(0).cast("long").alias("n"))
    wanted = parts.join(authors.select("author").distinct(), "author", "left_semi")
    summed = wanted.unionByName(zero).groupBy("author", "location").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    whole = lambda x: F.sum(F.when(of_all, F.col(x)).otherwise(0)).over(Window.partitionBy("author"))
    pairs = summed.withColumns({"base": whole("x"), "tokens": whole("n")}).where("location IS NOT NULL").join(places, "location")
    likelihood = F.col("base") + F.col("x") - lgamma_rise(F.col("alpha_sum"), F.col("tokens"))
    if observed_only:
        likelihood = F.when(F.col("tokens") > 0, likelihood - F.col("lgamma_sum")).otherwise(0.0)
    return pairs.select("author", "location", (F.col("prior") + likelihood).alias("score"))


def top_locations(scored: DataFrame, k: int) -> DataFrame:
    """(author, location, score, rank) of each author's k best; ties by name, of scores as rounded to nine places."""
    order = Window.partitionBy("author").orderBy(F.desc(F.round("score", 9)), "location")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def decisions(scored: DataFrame, seen: DataFrame) -> DataFrame:
    """(author, location, margin, seen, cached): the best location, how far ahead it is (infinite if alone) and whether it may be cached."""
    best = top_locations(scored, 2)
    second = F.lead("score").over(Window.partitionBy("author").orderBy("rank"))
    out = best.withColumn("margin", F.coalesce(F.col("score") - second, F.lit(float("inf")))).where("rank = 1").join(seen, "author", "left")
    out = out.withColumn("seen", F.coalesce("seen", F.lit(0)))
    return out.select("author", "location", "margin", "seen", ((F.col("seen") >= LEAST_SEEN) & (F.col("margin") >= LEAST_MARGIN)).alias("cached"))


def cache_upsert(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """The cache (author, location, updated_at) with fresh rows put in: the latest of each author; empty authors and locations are left out."""
    rows = cache.withColumn("__new", F.lit(0)).unionByName(fresh.where("author <> '' AND location <> ''").withColumn("__new", F.lit(1)))
    order = Window.partitionBy("author").orderBy(F.desc("updated_at"), F.desc("__new"), F.desc("location"))
    return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").select("author", "location", "updated_at")


def with_locations(posts: DataFrame, found: DataFrame) -> DataFrame:
    """posts with a location, __UNKNOWN__ where the author has none."""
    return posts.join(found.select("author", "location"), "author", "left").withColumn("location", F.coalesce("location", F.lit(UNKNOWN)))


def located(posts: DataFrame, model: dict[str, DataFrame], smoothing: Smoothing = Smoothing(), cache: DataFrame | None = None, most_posts: int = 25, months: list[tuple[int, int]] | None = None) -> tuple[DataFrame, DataFrame]:
    """posts (id, author, text, subreddit, time, ...) with a location, and the fresh cache rows (author, location) sure enough to be kept.

    Authors in the cache (author, location) have theirs; the others the likeliest by the features of their first posts, in
    the order of time or, with `months`, of the places of their months in that list, without other months; deleted and empty authors the unknown one.
    """
    posts = posts.withColumn("author", clean_author(F.col("author")))
    cache = cache.select("author", "location") if cache is not None else posts.sparkSession.createDataFrame([], "author string, location string")
    left = written(remaining_authors(posts.where(is_author(F.col("author"))), cache), "authors")
    scanned, order = posts.join(left, "author", "left_semi"), ["time", "id"]
    if months is not None:
        at = F.to_timestamp("time")
        scanned = scanned.withColumn("rank", F.array_position(F.array(*[F.lit(12 * y + m) for y, m in months]), (12 * F.year(at) + F.month(at)).cast("int"))).where("rank > 0")
        order = ["rank", *order]
    first, seen = features.first_posts(scanned, most_posts, order)
    own = written(features.author_features(first.withColumn("hour", hour_of(F.col("time").cast("string"))), dealt=True), "features")
    scored = written(scores(own, left, model["params"], model["overrides"], model["vocab"], model["priors"], smoothing), "scores")
    found = written(decisions(scored, seen), "decisions")
    wanted = cache.join(posts.select("author").distinct(), "author", "left_semi").unionByName(found.select("author", "location"))
    return with_locations(posts, wanted), found.where("cached").select("author", "location")


def remaining_authors(posts: DataFrame, cache: DataFrame) -> DataFrame:
    return posts.select("author").distinct().join(cache, "author", "left_anti")


def likeliest(location_priors: DataFrame, most: int | None = None) -> DataFrame:
    """The `most` locations of the highest prior (ties: by name); all, if `most` is None or 0."""
    return location_priors.orderBy(F.desc("prior"), "location").limit(most) if most else location_priors


def month_spiral(year: int, month: int, radius: int = 30, most: int = 60) -> list[tuple[int, int]]:
    """Months by distance from the given one, the earlier first: offsets 0, -1, 1, -2, 2, ...; `most` of them."""
    offsets = sorted(range(-radius, radius + 1), key=lambda d: (abs(d), d))[:most]
    return [((year * 12 + month - 1 + d) // 12, (year * 12 + month - 1 + d) % 12 + 1) for d in offsets]
