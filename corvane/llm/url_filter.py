"""URL filter: rules first, gradient-boosted trees on lexical features for the rest. DataFrame functions and Spark's own learner only.

Features: lengths of url, host and path; labels of the host and segments of the path; hyphens in the host; parts of digits and of
letters; entropy of the characters; parameters; scheme and fragment; statistics of the host's suffix (its registry and the name
before it) and of the host's words in the labelled URLs: how many there are and what part of them is blocked, drawn towards the whole
by `PRIOR`. A labelled URL's own statistics come from the other folds of hosts, so that no row tells the trees its own label.

Labelled URLs come as a table (url, blocked). Where none is given, the query makes one from a bounded sample of the pages' own urls: each
as it is, blocked if a word of its host is one of the blocked categories, and each once more with its host rebuilt round a word of
those or of harmless words, in the same shapes, so that no shape by itself gives the label away.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import settled, written

#: The rules, as (verdict, host and path).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Configuration, not learned: words of hosts that label a url where no labels are given, by category, and harmless ones for contrast.
BLOCKED = {
    "gambling": "casino poker bet bets betting slots lottery jackpot roulette gambling",
    "adult": "adult porn sex xxx cams dating escort",
    "pharmacy": "pills viagra cialis pharmacy meds",
    "adverts": "ads adserver advert banners popunder track tracker tracking pixel",
    "fraud": "spam phish phishing malware scam payday loans prize winner",
    "piracy": "warez torrent torrents crack keygen nulled",
}
HARMLESS = "news shop garden school travel books music city museum health sport photo library recipes weather forum wiki docs help journal village science bikes family office"
WORDS = tuple(w for group in BLOCKED.values() for w in group.split())

#: The bound of the labelled sample, in urls of the pages. Rules up to so many are one expression; more are joined by host suffix.
SAMPLE, MOST_RULES = 10_000, 200
#: Folds of hosts for the statistics; words that the trees are told of at most, those whose part differs most from the whole.
FOLDS, MOST_WORDS = 5, 300
TREES, DEPTH, PRIOR, SEED = 12, 4, 5.0, 7
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("url_length", "host_length", "path_length", "host_labels", "path_depth", "hyphens", "digit_part", "letter_part", "entropy", "parameters", "secure", "fragment", "suffix_seen", "suffix_blocked", "word_blocked", "words_blocked")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, after the first '://' up to '/', '?', '#' or the end; the path, then up to '?', '#' or the end. Null or without '://': both empty."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)"))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def placed(pages: DataFrame, url_col: str) -> DataFrame:
    host, path = host_and_path(F.col("__url"))
    return pages.withColumn("__url", F.col(url_col)).withColumns({"__host": host, "__path": path})


def ruled(rows: DataFrame, rules) -> DataFrame:
    """Adds __rule and __verdict: of the rules whose host is the url's or a parent domain of it, and whose path starts the url's, the longest; else null."""
    split = [(verdict, rule, rule.partition("/")[0], rule[len(rule.partition("/")[0]) :]) for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1]))]
    if len(split) <= MOST_RULES:
        fits = [((F.col("__host") == h) | F.endswith(F.col("__host"), F.lit("." + h))) & F.startswith(F.col("__path"), F.lit(p)) for _, _, h, p in split]
        pick = lambda k: F.coalesce(*[F.when(fit, F.lit(r[k])) for fit, r in zip(fits, split, strict=True)]) if split else F.lit(None).cast("string")
        return rows.withColumns({"__rule": pick(1), "__verdict": pick(0)})
    # Rows of one host and path have the same rule, so that these are the key.
    table = rows.sparkSession.createDataFrame(split, "v string, r string, h string, p string")
    labels = F.split("__host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = rows.select("__host", "__path").distinct().select("__host", "__path", F.explode(parents).alias("h"))
    best = hosts.join(table, "h").where("startswith(__path, p)").groupBy("__host", "__path").agg(F.max_by(F.struct("r", "v"), F.struct(F.length("r"), "r")).alias("__best"))
    return rows.join(best, ["__host", "__path"], "left").withColumns({"__rule": F.col("__best.r"), "__verdict": F.col("__best.v")}).drop("__best")


#: Second-level names that are registries under the two letters of a country.
REGISTRIES = ("ac", "co", "com", "edu", "gov", "gob", "ne", "net", "or", "org")


def suffix_of(host: Column) -> Column:
    """The registry and the name before it: the last two labels of the host, or three where the last two are a country's registry."""
    labels = F.split(host, r"\.")
    country = (F.size(labels) > 2) & (F.length(F.element_at(labels, -1)) == 2) & F.try_element_at(labels, F.lit(-2)).isin(*REGISTRIES)
    return F.when(country, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def words_of_host(host: Column) -> Column:
    """The distinct words between the host's dots and hyphens, without digits at their ends."""
    return F.array_distinct(F.filter(F.transform(F.split(host, "[.-]"), lambda w: F.regexp_replace(w, "^[0-9]+|[0-9]+$", "")), lambda w: w != ""))


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the lexical features and __suffix to rows with __url, __host and __path; a null url counts as empty."""
    url = F.coalesce("__url", F.lit(""))
    n = F.length(url)
    # Counts of distinct characters: what removing each one shortens the url by.
    of_char = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.when(c != "", (n - F.length(F.replace(url, c, F.lit("")))).cast("double")).otherwise(0.0))
    entropy = F.when(n > 0, -F.aggregate(of_char, F.lit(0.0), lambda a, x: a + F.when(x > 0, x / n * F.log2(x / n)).otherwise(0.0))).otherwise(0.0)
    without = lambda pattern: n - F.length(F.regexp_replace(url, pattern, ""))
    count = lambda column, c: (F.length(column) - F.length(F.replace(column, F.lit(c), F.lit("")))).cast("double")
    part = lambda x: F.when(n > 0, x / n).otherwise(0.0)
    return rows.withColumns({
        "url_length": n.cast("double"), "host_length": F.length("__host").cast("double"), "path_length": F.length("__path").cast("double"),
        "host_labels": count(F.col("__host"), "."), "path_depth": count(F.col("__path"), "/"), "hyphens": count(F.col("__host"), "-"),
        "digit_part": part(without("[0-9]")), "letter_part": part(without("[A-Za-z]")), "entropy": entropy,
        "parameters": F.when(F.contains(url, F.lit("?")), count(F.expr("substring(coalesce(__url, ''), instr(coalesce(__url, ''), '?') + 1)"), "=")).otherwise(0.0),
        "secure": F.startswith(url, F.lit("https://")).cast("double"), "fragment": F.contains(url, F.lit("#")).cast("double"),
        "__suffix": suffix_of(F.col("__host")), "__words": words_of_host(F.col("__host")),
    })


class Model:
    """Suffix and word statistics and trees; or, where the labelled URLs have one class only, that class.

    Labelled URLs that repeat count once, as blocked if any of them is. An empty table allows everything.
    """

    def __init__(self, labelled: DataFrame) -> None:
        once = labelled.groupBy("url").agg(F.max(F.col("blocked").cast("double")).alias("label"))
        rows = settled(lexical(placed(once, "url")).withColumn("__fold", F.pmod(F.xxhash64("__host"), F.lit(FOLDS))).drop("__url"))
        n, blocked = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
        self.base, self.trees, self.words = blocked / n if n else 0.0, None, {}
        part = (F.sum("label") + PRIOR * self.base) / (F.count("*") + PRIOR)
        self.suffixes = written(rows.groupBy("__suffix").agg(F.count("*").alias("__seen"), part.alias("__part")), "suffixes")
        if not 0 < blocked < n:
            return
        each = rows.select("url", "__fold", "label", F.explode("__words").alias("w"))
        differs = F.abs(F.col("part") - self.base)
        self.words = {r["w"]: r["part"] for r in each.groupBy("w").agg(part.alias("part"), F.count("*").alias("n")).where("n > 1").orderBy(differs.desc(), "w").limit(MOST_WORDS).collect()}
        fitted = self._out_of_fold(rows, each)
        self.assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="__features")
        fitted = self.assembler.transform(fitted).select("__features", "label").repartition(4, "__features")
        self.trees = GBTClassifier(featuresCol="__features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, predictionCol="__blocked").setRawPredictionCol("__raw").setProbabilityCol("__probability").fit(fitted)

    def _out_of_fold(self, rows: DataFrame, each: DataFrame) -> DataFrame:
        """rows with statistics of the hosts of all folds but their own. The labelled URLs are a bounded sample, so windows over a suffix or word may be."""

        def others(of: str, x: Column) -> Column:
            return F.sum(x).over(Window.partitionBy(of)) - F.sum(x).over(Window.partitionBy(of, "__fold"))

        part = lambda of: (others(of, F.col("label")) + PRIOR * self.base) / (others(of, F.lit(1)) + PRIOR)
        words = each.withColumn("part", part("w")).where(F.col("w").isin(*self.words)) if self.words else each.where("false").withColumn("part", F.lit(0.0))
        words = words.groupBy("url").agg(F.max("part").alias("word_blocked"), F.sum(F.greatest(F.col("part") - self.base, F.lit(0.0))).alias("words_blocked"))
        out = rows.withColumns({"suffix_seen": F.log1p(others("__suffix", F.lit(1)).cast("double")), "suffix_blocked": part("__suffix")}).join(words, "url", "left")
        return out.withColumns({"word_blocked": F.coalesce("word_blocked", F.lit(self.base)), "words_blocked": F.coalesce("words_blocked", F.lit(0.0))})

    def _with_statistics(self, rows: DataFrame) -> DataFrame:
        """rows with the statistics of all labelled URLs; Spark broadcasts the suffixes if their table is small by its own measure."""
        known = F.map_from_arrays(F.array(*map(F.lit, self.words)), F.array(*map(F.lit, self.words.values()))) if self.words else None
        parts = F.filter(F.transform("__words", lambda w: F.try_element_at(known, w)), lambda x: x.isNotNull()) if self.words else F.array().cast("array<double>")
        joined = rows.withColumn("__parts", parts).join(self.suffixes, "__suffix", "left")
        return joined.withColumns({
            "suffix_seen": F.log1p(F.coalesce("__seen", F.lit(0)).cast("double")), "suffix_blocked": F.coalesce("__part", F.lit(self.base)),
            "word_blocked": F.coalesce(F.array_max("__parts"), F.lit(self.base)), "words_blocked": F.aggregate("__parts", F.lit(0.0), lambda a, x: a + F.greatest(x - self.base, F.lit(0.0))),
        }).drop("__seen", "__part", "__parts", "__words")

    def judged(self, rows: DataFrame) -> DataFrame:
        """Adds __blocked (1.0 or 0.0) to rows with __url, __host and __path."""
        if self.trees is None:
            return rows.withColumn("__blocked", F.lit(float(self.base > 0.5)))
        out = self.trees.transform(self.assembler.transform(self._with_statistics(lexical(rows))))
        return out.drop(*FEATURES, "__features", "__raw", "__probability", "__suffix")


def has_word(host: Column, words=WORDS) -> Column:
    return F.arrays_overlap(words_of_host(host), F.array(*map(F.lit, words)))


def labelled_sample(pages: DataFrame, url_col: str = "url", n: int = SAMPLE, words=WORDS) -> DataFrame:
    """(url, blocked): at most n different urls of the pages, those of the least hash, each as it is and once with a rebuilt host."""
    rows = pages.select(F.col(url_col).alias("url")).where(F.col(url_col).isNotNull())
    total = rows.count()
    share = min(1_000_000, int(2_000_000 * n / total) + 1) if total else 0
    picked = rows.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < share).distinct().orderBy(F.xxhash64("url"), "url").limit(n)
    own = placed(picked, "url")
    draw = lambda salt, k: F.pmod(F.xxhash64("url", F.lit(salt)), F.lit(k))
    pick = lambda salt, of: F.element_at(F.array(*map(F.lit, of)), (draw(salt, len(of)) + 1).cast("int"))
    bad = draw("class", 2) == 0
    word = F.when(bad, pick("word", words)).otherwise(pick("word", HARMLESS.split()))
    other = F.when(draw("other", 3) == 0, pick("also", HARMLESS.split())).otherwise(F.substring_index("__host", ".", 1))
    suffix = suffix_of(F.col("__host"))
    number = draw("number", 1000).cast("string")
    # Shapes are drawn alike for both classes, but digits behind a word and long queries more often for blocked ones.
    shapes = [F.concat_ws(".", word, "__host"), F.concat(word, F.lit("-"), other, F.lit("."), suffix), F.concat(other, F.lit("-"), word, F.lit("."), suffix), F.concat_ws(".", word, suffix), F.concat_ws(".", F.lit("www"), word, suffix)]
    shape = F.element_at(F.array(*shapes), (draw("shape", len(shapes)) + 1).cast("int"))
    host = F.when(draw("digits", 10) < F.when(bad, 3).otherwise(1), F.concat(word, number, F.lit("."), suffix)).otherwise(shape)
    query = F.when(draw("query", 10) < F.when(bad, 3).otherwise(1), F.concat(F.lit("?id="), number, F.lit("&src="), word, F.lit("&sub="), draw("sub", 99999).cast("string"))).otherwise("")
    rebuilt = own.where("__host <> ''").select(F.concat(F.lit("https://"), host, "__path", query).alias("url"), bad.alias("blocked"))
    return own.select("url", has_word(F.col("__host"), words).alias("blocked")).union(rebuilt)


def filtered(pages: DataFrame, url_col: str = "url", rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """pages with host, path, rule (host and path of the longest that fits, else null) and verdict (allow or block: the rule's, else the trees').

    Null urls and those without '://' have an empty host and path and are judged by their features. Repeated rows are judged alike;
    an empty table gives no rows. Columns of pages are kept, whatever their names, but for those named like the new ones, which are replaced.
    """
    model = Model(labelled if labelled is not None else labelled_sample(pages, url_col))
    own = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = model.judged(ruled(placed(pages.select(F.struct(*own).alias("__row"), F.col(url_col).alias("__given")), "__given"), rules))
    verdict = F.coalesce("__verdict", F.when(F.col("__blocked") > 0.5, "block").otherwise("allow"))
    return rows.select("__row.*", F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"), verdict.alias("verdict"))


def report(pages: DataFrame) -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict."""
    return filtered(pages.select("page_id", "url")).drop("url")
