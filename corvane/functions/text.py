"""Scalar text functions of the post pipeline, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip sees it.
SPACE = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def comment_text(body: Column) -> Column:
    """The stored text of a comment: stripped and lower-cased; a missing body is empty."""
    return F.lower(strip(F.coalesce(body, F.lit(""))))


def submission_text(title: Column, selftext: Column) -> Column:
    """The stored text of a submission: title, line feed, body, each stripped and lower-cased."""
    return F.concat_ws("\n", comment_text(title), comment_text(selftext))


def feature_text(kind: str, body: Column, title: Column, selftext: Column) -> Column:
    """The text that author features are read from: case kept."""
    if kind == "comments":
        return strip(F.coalesce(body, F.lit("")))
    return strip(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(selftext, F.lit(""))))


def one_line(text: Column) -> Column:
    """What models are given: stripped, line feeds as spaces."""
    return F.translate(strip(text), "\n", " ")


def without_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\0"), F.lit(""))


def post_time(epoch: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' in the session's zone (UTC); a missing time is 0."""
    return F.date_format(F.timestamp_seconds(F.coalesce(epoch.try_cast("bigint"), F.lit(0).cast("bigint"))), "yyyy-MM-dd HH:mm:ss")


def parent_id(kind: str, parent: Column) -> Column:
    return F.coalesce(parent, F.lit("")) if kind == "comments" else F.lit("")


def match_labels(matches: Column) -> Column:
    """'side: term, side: term' of an array of (side, term): distinct, sorted."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: F.concat(m["side"], F.lit(": "), m["term"])))), ", ")


def distinct_parts(matched: Column) -> Column:
    """A comma-separated list without repeats. Parts are not trimmed, so ' a: x' and 'a: x' differ."""
    return F.array_join(F.array_distinct(F.split(matched, ",")), ",")


def tokens(text: Column) -> Column:
    """Runs of a-z, 0-9 and ' in lower case. A dotted capital I is an i, as in SQL: Spark's lower makes two characters of it, which part a token."""
    return F.regexp_extract_all(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u0130"), F.lit("i"))), F.lit("[a-z0-9']+"), F.lit(0))


def hour_of(time: Column) -> Column:
    """The hour of a time that is given as epoch seconds, 'yyyy-MM-dd HH:mm:ss', 'yyyy-MM-ddTHH:mm:ss' or ISO text; else null."""
    time = F.trim(time)
    seconds = F.when(time.rlike("^[0-9]+$"), F.timestamp_seconds(time.try_cast("bigint")))
    return F.hour(F.coalesce(seconds, F.try_to_timestamp(time, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(time, F.lit("yyyy-MM-dd'T'HH:mm:ss")), F.try_to_timestamp(time)))


def feature_keys(text: Column, subreddit: Column, hour: Column) -> Column:
    """The features of a post: w:<token> for each token, s:<subreddit>, h:<HH>."""
    return F.transform(unprefixed_keys(text, subreddit, hour), lambda t: F.when(F.contains(t, F.lit(":")), t).otherwise(F.concat(F.lit("w:"), t)))


def unprefixed_keys(text: Column, subreddit: Column, hour: Column) -> Column:
    """The features of a post, tokens without their w: (they have no colon)."""
    name = F.trim(F.coalesce(subreddit, F.lit("")))
    place = F.when(name != "", F.array(F.concat(F.lit("s:"), name))).otherwise(F.array().cast("array<string>"))
    at = F.when(hour.isNotNull(), F.array(F.concat(F.lit("h:"), F.lpad(hour.cast("string"), 2, "0")))).otherwise(F.array().cast("array<string>"))
    return F.concat(tokens(text), place, at)


def unique_keywords(cell: Column, sides: tuple[str, str], most: int = 100) -> Column:
    """The distinct keywords of a matched-patterns cell, `most` at most: parts between commas or tabs, stripped, empty ones
    dropped; a part that holds a side and a colon is rewritten 'key: value' from its first two parts between colons."""
    parts = F.transform(F.split(F.translate(cell, "\t", ","), ","), strip)
    labelled = lambda p: F.contains(p, F.lit(f"{sides[0]}:")) | F.contains(p, F.lit(f"{sides[1]}:"))
    pair = lambda p: F.concat(strip(F.split(p, ":")[0]), F.lit(": "), strip(F.split(p, ":")[1]))
    return F.slice(F.array_distinct(F.filter(F.transform(parts, lambda p: F.when(labelled(p), pair(p)).otherwise(p)), lambda p: p != "")), 1, most)


def clean_author(author: Column, training: bool = False) -> Column:
    """Authors are trimmed; in training tables lower-cased too."""
    return F.lower(F.trim(author)) if training else F.trim(author)


def is_author(author: Column) -> Column:
    return F.coalesce((F.trim(author) != "") & (F.trim(author) != "[deleted]"), F.lit(False))


def year_month(path: Column) -> tuple[Column, Column]:
    return F.regexp_extract(path, r"(\d{4})-(\d{2})", 1), F.regexp_extract(path, r"(\d{4})-(\d{2})", 2)


def moralization(label: Column) -> Column:
    return F.when(label == 1, "Moralized").otherwise("Non-Moralized")
