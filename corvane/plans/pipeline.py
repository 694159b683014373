"""The chain of stages from raw dumps to labelled posts, as functions from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.scores import is_relevant, softmax
from corvane.functions.text import match_labels, one_line
from corvane.operators import keywords, labels, location
from corvane.operators.training import counts_of, log_metrics, with_metrics
from corvane.sources.posts import write_stage

Stage = Callable[[DataFrame], DataFrame]


@dataclass
class Plan:
    """Stages of one social group; the scorers are those registered, the lists those given."""

    group: str
    terms: list[tuple[str, list[str]]]
    patterns: list[str]
    language: str = "en"
    location_model: dict[str, DataFrame] | None = None
    location_cache: DataFrame | None = None
    most_posts: int = 25
    months: list[tuple[int, int]] | None = None
    stages: dict[str, Stage] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.stages = {
            "filter_keywords": self.filter_keywords,
            "filter_language": self.filter_language,
            "filter_relevance": self.filter_relevance,
            "filter_keywords_adv": lambda posts: keywords.regex_filter(posts, self.patterns),
            "label_moralization": lambda posts: labels.moralized(posts, one_line(F.col("text"))),
            "label_sentiment": self.label_sentiment,
            "label_generalization": lambda posts: labels.generalized(posts, one_line(F.col("text"))),
            "label_emotion": lambda posts: labels.emotions(posts, one_line(F.col("text"))),
            "label_location": self.label_location,
        }

    def filter_keywords(self, posts: DataFrame) -> DataFrame:
        return keywords.keyword_filter(posts, self.terms).withColumn("matched_patterns", match_labels(F.col("matches"))).drop("matches")

    def filter_language(self, posts: DataFrame) -> DataFrame:
        if "lang" not in posts.columns:
            posts = posts.withColumn("lang", labels.scorer("language")(one_line(F.col("text"))))
        return posts.where(F.col("lang") == self.language).withColumn("text", one_line(F.col("text")))

    def filter_relevance(self, posts: DataFrame) -> DataFrame:
        scored = labels.scored(posts, "relevance", one_line(F.col("text")), "__logits")
        return scored.where(is_relevant(self.group, softmax(F.col("__logits")))).drop("__logits")

    def label_sentiment(self, posts: DataFrame) -> DataFrame:
        text = one_line(F.col("text"))
        return labels.document_sentiment(labels.sentiment(posts, text, labels.scorer("sentiment")), text)

    def label_location(self, posts: DataFrame) -> DataFrame:
        if self.location_model is None:
            raise ValueError("label_location needs a location model")
        return location.located(posts, self.location_model, cache=self.location_cache, most_posts=self.most_posts, months=self.months)[0]

    def chain(self, until: str | None = None) -> list[str]:
        """The stages up to and with `until`; all, without the location's if there is no model."""
        names = list(self.stages)
        return names[: names.index(until) + 1] if until else [n for n in names if n != "label_location" or self.location_model is not None]

    def run(self, posts: DataFrame, until: str | None = None) -> DataFrame:
        """All stages in order, up to and with `until`: one lazy plan, so that cheap filters run before the scorers."""
        for name in self.chain(until):
            posts = self.stages[name](posts)
        return posts

    def run_and_write(self, posts: DataFrame, until: str | None, path: str, metrics: str, append: bool = False) -> dict[str, dict[str, int]]:
        """Runs the stages, writes the last one's table by month, and appends each stage's counts of rows in, rows out and rows without text
        to the table at `metrics`: they are observed while the one job runs."""
        rows, seen = with_metrics(posts, "input", F.col("text").isNotNull())
        held = {"input": seen}
        for name in self.chain(until):
            rows, held[name] = with_metrics(self.stages[name](rows), name, F.col("text").isNotNull())
        write_stage(rows, path, append=append)
        found = {name: counts_of(seen) for name, seen in held.items()}
        counts = {name: {"total": own["total"], "missing": own["total"] - own["passed"]} for name, own in found.items()}
        for name, own in counts.items():
            log_metrics(posts.sparkSession, metrics, name, own)
        return counts
