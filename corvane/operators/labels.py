"""Labelers of posts: the scorer registry, clauses and their features, sentiment and emotion columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scores import argmax, double_softmax, let, ratio
from corvane.functions.text import tokens

#: name -> a function from a text column to a column of scores. Neural models are registered by their users.
SCORERS: dict[str, Callable[[Column], Column]] = {}


def register_scorer(name: str, score: Callable[[Column], Column]) -> None:
    SCORERS[name] = score


def scorer(name: str) -> Callable[[Column], Column]:
    if name not in SCORERS:
        raise KeyError(f"no scorer {name!r} is registered; there are {sorted(SCORERS)}")
    return SCORERS[name]


#: name -> a fitted classifier over the column __tokens, which takes the place of the scorer of that name.
MODELS: dict[str, PipelineModel] = {}


def register_model(name: str, model: PipelineModel) -> None:
    """A classifier of `training.fit_classifier`, whose classes are the outputs of the scorer `name`, in order."""
    MODELS[name] = model


def scored(posts: DataFrame, name: str, text: Column, into: str) -> DataFrame:
    """posts with the column `into`: the logits that the model registered under `name` gives text, or else the scorer of that name."""
    if name not in MODELS:
        return posts.withColumn(into, scorer(name)(text))
    out = MODELS[name].transform(posts.withColumn("__tokens", tokens(text)))
    # Softmax of the logarithms gives the probabilities back; 0 has none.
    logits = F.transform(vector_to_array("__p"), lambda x: F.ln(F.greatest(x, F.lit(1e-300))))
    return out.withColumn(into, logits).drop("__tokens", "__features", "__raw", "__p", "__prediction")


def hashed_scorer(seed: str, outputs: int) -> Callable[[Column], Column]:
    """A deterministic stand-in for a model: logits from -2 to 2 by the text's hash. It knows nothing of the text's meaning."""

    def score(text: Column) -> Column:
        one = lambda digest, k: F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{k}:"), digest)), 1, 6), 16, 10).cast("double") / 4194304.0 - 2.0
        return let(F.md5(F.coalesce(text, F.lit(""))), lambda digest: F.array(*[one(digest, k) for k in range(outputs)]))

    return score


def lexicon_scorer(positive: tuple[str, ...], negative: tuple[str, ...]) -> Callable[[Column], Column]:
    """A polarity from -1 to 1: (positive - negative words) / (positive + negative words), 0 without either."""

    def score(text: Column) -> Column:
        words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9']+"), F.lit(0))
        count = lambda listed: F.size(F.filter(words, lambda w: w.isin(*listed))).cast("double")
        up, down = count(positive), count(negative)
        return ratio(up - down, up + down)

    return score


#: Function words by language: configuration of the stand-in for a language model.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "was"),
    "fr": ("le", "la", "les", "des", "et", "est", "que", "pour", "dans", "une"),
    "de": ("der", "die", "das", "und", "ist", "nicht", "von", "mit", "den", "ein"),
    "es": ("el", "los", "las", "en", "por", "con", "para", "una", "del", "como"),
}


def function_word_scorer(listed: dict[str, tuple[str, ...]]) -> Callable[[Column], Column]:
    """The language whose function words are the most frequent (ties: the first of the lists), `und` without any: a stand-in for a language model."""

    def score(text: Column) -> Column:
        words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
        count = lambda own: F.size(F.filter(words, lambda w: w.isin(*own)))
        counts = F.array(*map(count, listed.values()))
        return let(counts, lambda c: F.when(F.array_max(c) == 0, F.lit("und")).otherwise(F.element_at(F.array(*map(F.lit, listed)), argmax(c) + 1)))

    return score


def share_scorer(listed: tuple[str, ...]) -> Callable[[Column], Column]:
    """The part of a text's words that is listed, 0.0 without words."""

    def score(text: Column) -> Column:
        words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9']+"), F.lit(0))
        return ratio(F.size(F.filter(words, lambda w: w.isin(*listed))).cast("double"), F.size(words))

    return score


def punctuation_tags(words: Column) -> Column:
    """A stand-in for a clause segmenter: of each word 2 if it ends with a mark, 1 if it is the first or follows such a word, else 0."""
    ends = lambda w: w.rlike("[.,;:!?]$")
    return F.transform(words, lambda w, i: F.when(ends(w), 2).when((i == 0) | ends(F.get(words, i - 1)), 1).otherwise(0))


def hashed_clause_label(clause: Column) -> Column:
    """A stand-in for a clause classifier: ##QUESTION if the clause ends with a question mark, else a label by the clause's hash."""
    names = F.array(*[F.lit(x[0]) for x in CLAUSE_LABELS])
    pick = F.conv(F.substring(F.md5(clause), 1, 6), 16, 10).cast("int") % len(CLAUSE_LABELS) + 1
    return F.when(clause.rlike("[?]$"), F.lit("##QUESTION")).otherwise(F.element_at(names, pick))


POSITIVE = ("good", "great", "best", "love", "happy", "nice", "kind", "fine")
NEGATIVE = ("bad", "worst", "hate", "sad", "awful", "ugly", "cruel", "poor")

register_scorer("language", function_word_scorer(FUNCTION_WORDS))
register_scorer("sentiment", lexicon_scorer(POSITIVE, NEGATIVE))
register_scorer("polarity", lexicon_scorer(POSITIVE, NEGATIVE))
register_scorer("subjectivity", share_scorer(POSITIVE + NEGATIVE))
register_scorer("clause_tags", punctuation_tags)
register_scorer("clause_label", hashed_clause_label)
register_scorer("relevance", hashed_scorer("relevance", 2))
register_scorer("moralization", hashed_scorer("moralization", 2))
register_scorer("emotion_1", hashed_scorer("emotion1", 7))
register_scorer("emotion_2", hashed_scorer("emotion2", 6))
register_scorer("emotion_3", hashed_scorer("emotion3", 7))

#: The outputs of the three emotion models, in order.
EMOTIONS = (
    ("emotion_1", "1", ("anger", "disgust", "fear", "joy", "neutral", "sadness", "surprise")),
    ("emotion_2", "2", ("sadness", "joy", "love", "anger", "fear", "surprise")),
    ("emotion_3", "3", ("neutral", "joy", "surprise", "anger", "sadness", "disgust", "fear")),
)

#: Clause labels and their genericity, eventivity and boundedness.
CLAUSE_LABELS = (
    ("##BOUNDED EVENT (SPECIFIC)", "specific", "dynamic", "episodic"),
    ("##BOUNDED EVENT (GENERIC)", "generic", "dynamic", "episodic"),
    ("##UNBOUNDED EVENT (SPECIFIC)", "specific", "dynamic", "static"),
    ("##UNBOUNDED EVENT (GENERIC)", "generic", "dynamic", "static"),
    ("##BASIC STATE", "specific", "stative", "static"),
    ("##COERCED STATE (SPECIFIC)", "specific", "dynamic", "static"),
    ("##COERCED STATE (GENERIC)", "generic", "dynamic", "static"),
    ("##PERFECT COERCED STATE (SPECIFIC)", "specific", "dynamic", "episodic"),
    ("##PERFECT COERCED STATE (GENERIC)", "generic", "dynamic", "episodic"),
    ("##GENERIC SENTENCE (DYNAMIC)", "generic", "dynamic", "habitual"),
    ("##GENERIC SENTENCE (STATIC)", "generic", "stative", "static"),
    ("##GENERIC SENTENCE (HABITUAL)", "generic", "stative", "habitual"),
    ("##GENERALIZING SENTENCE (DYNAMIC)", "specific", "dynamic", "habitual"),
    ("##GENERALIZING SENTENCE (STATIVE)", "specific", "stative", "habitual"),
    ("##QUESTION", "NA", "NA", "NA"),
    ("##IMPERATIVE", "NA", "NA", "NA"),
    ("##NONSENSE", "NA", "NA", "NA"),
    ("##OTHER", "NA", "NA", "NA"),
)
COUNTS = (("genericity", "generic"), ("genericity", "specific"), ("eventivity", "stative"), ("eventivity", "dynamic"), ("boundedness", "static"), ("boundedness", "episodic"), ("habitual", "habitual"), ("NA", "NA"))


def emotions(posts: DataFrame, text: Column) -> DataFrame:
    """The twenty emotion columns: each model's logits through softmax twice."""
    out = posts
    for name, prefix, names in EMOTIONS:
        out = scored(out, name, text, "__logits").withColumn("__scores", double_softmax(F.col("__logits"))).drop("__logits")
        out = out.withColumns({f"{prefix}_{n}": F.col("__scores")[k] for k, n in enumerate(names)}).drop("__scores")
    return out


def moralized(posts: DataFrame, text: Column) -> DataFrame:
    moral = F.when(argmax(F.col("__logits")) == 1, "Moralized").otherwise("Non-Moralized")
    return scored(posts, "moralization", text, "__logits").withColumn("moralization", moral).drop("__logits")


#: White space of sentences as SQL's engine sees it (without the vertical tab), and the spaces that it trims (Unicode's class Zs).
WHITE, ZS = r"[\t\n\f\r ]+", "".join(map(chr, (0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))


def sentences(text: Column) -> Column:
    """A stand-in for a sentence model: parts that end with '.', '!', '?' or a line feed, stripped of spaces, empty ones dropped."""
    # Not F.trim itself: given a function of two parameters, transform hands over the element's number as characters to trim.
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), rf"(?<=[.!?]){WHITE}|\n+"), lambda s: F.btrim(s, F.lit(ZS))), lambda s: s != "")


def sentiment(posts: DataFrame, text: Column, polarity: Callable[[Column], Column], margin: float = 0.05) -> DataFrame:
    """Counts of positive, neutral and negative sentences, and the mean polarity over sentences (0.0 without any)."""
    each = F.transform(sentences(text), polarity)
    out = posts.withColumn("__each", each)
    count = lambda test: F.size(F.filter("__each", test)).cast("long")
    mean = ratio(F.aggregate("__each", F.lit(0.0), lambda a, x: a + x), F.size("__each"))
    return out.withColumns({"sentiment_pos": count(lambda x: x > margin), "sentiment_neu": count(lambda x: (x <= margin) & (x >= -margin)), "sentiment_neg": count(lambda x: x < -margin), "sentiment_compound": mean}).drop("__each")


def document_sentiment(posts: DataFrame, text: Column) -> DataFrame:
    """The polarity and subjectivity of the whole text, by the scorers of these names."""
    return posts.withColumns({"sentiment_polarity": scorer("polarity")(text), "sentiment_subjectivity": scorer("subjectivity")(text)})


def clause_attributes(label: Column) -> Column:
    """The struct (genericity, eventivity, boundedness) of a clause label, null if it is none."""
    listed = F.create_map(*[x for name, g, e, b in CLAUSE_LABELS for x in (F.lit(name), F.struct(F.lit(g).alias("genericity"), F.lit(e).alias("eventivity"), F.lit(b).alias("boundedness")))])
    return F.try_element_at(listed, label)


def clause_features(posts: DataFrame, labels: Column) -> DataFrame:
    """The eight counts of clause features and their proportions. Denominators: genericity with NA, eventivity with NA, and
    boundedness with NA, which serves habitual and NA too; a total of 0 gives 0.0."""
    out = posts.withColumn("__clauses", F.transform(labels, clause_attributes))
    count = lambda field, value: F.size(F.filter("__clauses", lambda c: c[field] == value)).cast("long")
    fields = {"genericity": "genericity", "eventivity": "eventivity", "boundedness": "boundedness", "habitual": "boundedness", "NA": "boundedness"}
    name = lambda kind, value: f"{kind}_{value}" if kind != value else kind
    out = out.withColumns({f"{name(kind, value)}_count": count(fields[kind], value) for kind, value in COUNTS})
    of = lambda field: F.size(F.filter("__clauses", lambda c: c[field].isNotNull()))
    return out.withColumns({f"{name(kind, value)}_proportion": ratio(F.col(f"{name(kind, value)}_count"), of(fields[kind])) for kind, value in COUNTS}).drop("__clauses")


def clauses(words: Column, tags: Column) -> Column:
    """Clauses of tagged words: a clause starts after a word tagged 2 and takes words until a 2 that follows a 0 or 1; a 2 that
    follows a 2 starts anew; what is left is a clause."""
    state = F.struct(F.lit(2).alias("before"), F.array().cast("array<string>").alias("open"), F.array().cast("array<array<string>>").alias("done"), F.lit(True).alias("on"))

    def step(s: Column, x: Column) -> Column:
        word, tag = x["words"], x["tags"]
        taken = F.when(s["before"] == 2, F.array(word)).when(s["on"], F.concat(s["open"], F.array(word))).otherwise(s["open"])
        on = s["on"] | (s["before"] == 2)
        closes = (tag == 2) & s["before"].isin(0, 1)
        empty = F.array().cast("array<string>")
        return F.struct(tag.cast("int").alias("before"), F.when(closes, empty).otherwise(taken).alias("open"), F.when(closes, F.concat(s["done"], F.array(taken))).otherwise(s["done"]).alias("done"), (on & ~closes).alias("on"))

    finish = lambda s: F.transform(F.when(s["on"] & (F.size(s["open"]) > 0), F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]), lambda c: F.array_join(c, " "))
    return F.aggregate(F.arrays_zip(words.alias("words"), tags.alias("tags")), state, step, finish)


def word_tags(word_of_piece: Column, tag_of_piece: Column) -> Column:
    """The tag of each word of a tokenized snippet: that of its first piece. word_of_piece: the word's number, null for special pieces."""
    zipped = F.arrays_zip(word_of_piece.alias("word"), tag_of_piece.alias("tag"))
    first = F.filter(zipped, lambda x, i: x["word"].isNotNull() & (F.array_position(word_of_piece, x["word"]) == i + 1))
    return F.transform(first, lambda x: x["tag"])


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def generalized(posts: DataFrame, text: Column) -> DataFrame:
    """clauses, generalization_clause_labels (arrays, in text order) and the sixteen counts and proportions: sentences are packed into
    snippets, a scorer tags a snippet's words, tagged words make clauses, and a scorer labels each. A row's snippets and clauses stay
    in its own arrays, so that nothing has to be joined back."""
    tags = scorer("clause_tags")
    of_snippet = lambda s: let(words_of(s), lambda w: clauses(w, tags(w)))
    out = posts.withColumn("clauses", F.flatten(F.transform(snippets(sentences(text)), of_snippet)))
    out = out.withColumn("generalization_clause_labels", F.transform("clauses", scorer("clause_label")))
    return clause_features(out, F.col("generalization_clause_labels"))


def clause_rows(posts: DataFrame, key: str) -> DataFrame:
    """(key, pos, clause): a row for each clause, for scorers that need rows."""
    return posts.select(key, F.posexplode("clauses").alias("pos", "clause"))


def regrouped(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): the values of a key's rows (key, pos, value) as an array in order of pos. A post's clauses are few."""
    each = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", value))).alias("each"))
    return each.select(key, F.transform("each", lambda x: x[value]).alias(value))


def snippets(parts: Column, most: int = 200) -> Column:
    """Sentences packed into snippets of at most `most` words between white space. A snippet begins with a space, unless a sentence
    that did not fit began it; a first sentence that is too long leaves an empty snippet before it; the last snippet is always given."""
    words = lambda s: F.size(F.filter(F.split(s, WHITE), lambda w: w != ""))
    # A sentence's words are counted once: inside the step each use would count them anew.
    counted = F.transform(parts, lambda x: F.struct(x.alias("x"), words(x).alias("k")))
    state = F.struct(F.lit("").alias("now"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("done"))

    def step(s: Column, y: Column) -> Column:
        x, k = y["x"], y["k"]
        over = s["n"] + k > most
        return F.struct(F.when(over, x).otherwise(F.concat(s["now"], F.lit(" "), x)).alias("now"), F.when(over, k).otherwise(s["n"] + k).alias("n"), F.when(over, F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"]).alias("done"))

    return F.aggregate(counted, state, step, lambda s: F.concat(s["done"], F.array(s["now"])))
