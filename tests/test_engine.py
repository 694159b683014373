"""Functions, sources, sinks, streaming and the command line on small fixtures."""

import json
import math
import random
import sqlite3

import pytest
import zstandard
from pyspark.sql import functions as F

from corvane import cli
from corvane.functions import scores, text
from corvane.operators import audit, evaluation, keywords, labels, location, sampling
from corvane.sources import posts, tables
from corvane.streaming.stages import run_available, run_batches


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()[0]


@pytest.mark.parametrize("s", ["  a b \n", "\x1c x　", "", "\n\n", "é ", "a\nb"])
def test_strip_is_pythons(spark, s):
    assert one(spark, text.strip(F.col("s")), s=s) == s.strip()
    assert one(spark, text.one_line(F.col("s")), s=s) == s.strip().replace("\n", " ")


@pytest.mark.parametrize(("time", "hour"), [("0", 0), ("1700000000", 22), ("2024-01-02 13:45:00", 13), ("2024-01-02T07:00:00", 7), ("2024-01-02T07:00:00Z", 7), ("soon", None), ("", None)])
def test_hours(spark, time, hour):
    assert one(spark, text.hour_of(F.col("t")), t=time) == hour


def test_post_texts(spark):
    assert one(spark, text.submission_text(F.col("a"), F.col("b")), a=" Title ", b=None) == "title\n"
    assert one(spark, text.post_time(F.col("a")), a="60") == "1970-01-01 00:01:00" and one(spark, text.post_time(F.col("a")), a=None) == "1970-01-01 00:00:00"
    assert one(spark, text.distinct_parts(F.col("a")), a="a: x, a: x,a: x") == "a: x, a: x"
    assert one(spark, F.array_join(text.feature_keys(F.col("a"), F.col("b"), F.lit(7)), "|"), a="It's 9", b=" News ") == "w:it's|w:9|s:News|h:07"
    assert one(spark, F.array_join(text.unique_keywords(F.col("a"), ("old", "young")), "|"), a="old: elder:x\t plain , ,plain,young:kid") == "old: elder|plain|young: kid"
    assert one(spark, F.concat_ws("-", *text.year_month(F.col("a"))), a="/x/RC_2015-03.zst") == "2015-03"


@pytest.mark.parametrize("a", [0.05, 0.5, 3.0, 40.0])
@pytest.mark.parametrize("n", [0, 1, 5, 64, 65, 1000, 10_000_000])
def test_rising_factorial(spark, a, n):
    got = spark.range(1).select(scores.lgamma_rise(F.lit(a), F.lit(n).cast("long"))).first()[0]
    assert math.isclose(got, math.lgamma(a + n) - math.lgamma(a), rel_tol=1e-10, abs_tol=1e-9)


def test_softmax(spark):
    x = spark.range(1).select(F.array(*map(F.lit, (1000.0, 1001.0, 999.0))).alias("x"))
    p = x.select(scores.softmax(F.col("x"))).first()[0]
    assert math.isclose(sum(p), 1) and math.isclose(p[1] / p[0], math.e)


def test_keyword_matches(spark):
    sides = [("old", ["Aged ", "both", " "]), ("young", ["kid", "both"])]
    rows = spark.createDataFrame([(1, "a kid and kidney both"), (2, "aged"), (3, "aged wine"), (4, None), (5, "")], "id long, text string")
    python = {r.id: r.m for r in rows.select("id", text.match_labels(keywords.keyword_matches(F.col("text"), sides)).alias("m")).collect()}
    native = {r.id: r.m for r in keywords.keyword_filter(rows, sides, native=True).select("id", text.match_labels(F.col("matches")).alias("m")).collect()}
    assert python[1] == "young: both, young: kid" and python[3] == "old: aged " and python[2] == python[4] == python[5] == ""
    assert native == {k: v for k, v in python.items() if v}


def test_many_patterns_do_not_overflow(spark):
    rows = spark.createDataFrame([(1, "x499"), (2, "y")], "id long, text string")
    assert [r.id for r in keywords.regex_filter(rows, [f"x{k}\\b" for k in range(500)]).collect()] == [1]
    assert keywords.regex_filter(rows, []).count() == 0


def test_reservoirs_are_the_streaming_ones(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice("ab"), rng.randint(0, 5)) for k in range(200)]
    frame = spark.createDataFrame(rows, "id long, year string, n int")
    for order, better in (([F.desc("n"), "id"], lambda new, old: new > old), (["n", "id"], lambda new, old: new < old)):
        got = {(r.id, r.year) for r in sampling.reservoir(frame, "year", 7, order).collect()}
        held = {"a": [], "b": []}
        for k, year, n in rows:
            best = held[year]
            if len(best) < 7:
                best.append((k, n))
            else:
                worst = max(range(7), key=lambda i: ((-best[i][1] if better(1, 0) else best[i][1]), best[i][0]))
                if better(n, best[worst][1]):
                    best[worst] = (k, n)
        assert got == {(k, year) for year, best in held.items() for k, _ in best}


def test_exact_split_sizes(spark):
    for n in (0, 1, 9, 10, 997):
        sizes = {r.split: r["count"] for r in sampling.exact_split(spark.range(n), "id").groupBy("split").count().collect()}
        assert (sizes.get("train", 0), sizes.get("valid", 0)) == (math.floor(n * 0.8), math.floor(n * 0.1)) and sum(sizes.values()) == n


def test_location_decisions(spark):
    scored = spark.createDataFrame([("u", "a", -1.0), ("u", "b", -3.0), ("v", "a", -2.0), ("w", "a", -1.0), ("w", "b", -1.0)], "author string, location string, score double")
    seen = spark.createDataFrame([("u", 10), ("v", 12)], "author string, seen long")
    got = {r.author: (r.location, r.margin, r.cached) for r in location.decisions(scored, seen).collect()}
    assert got == {"u": ("a", 2.0, True), "v": ("a", float("inf"), True), "w": ("a", 0.0, False)}


def test_authors_without_features_get_the_prior(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    vocab = frame([("w:a",)], "feature string")
    homes = frame([("x", "g"), ("y", "g"), ("z", "h")], "author string, location string")
    by = frame([("g", "w:a", 3)], "location string, feature string, cnt long")
    pri = frame([("g", 2 / 3), ("h", 1 / 3)], "location string, prior double")
    params, over = location.location_params(by, vocab, pri, location.Smoothing())
    got = {(r.author, r.location): r.score for r in location.scores(frame([("x", "w:a", 2)], "author string, feature string, cnt long"), homes, params, over, vocab, pri, location.Smoothing()).collect()}
    assert math.isclose(got["y", "g"], math.log(2 / 3)) and len(got) == 6
    rise = lambda a, n: math.lgamma(a + n) - math.lgamma(a)
    assert math.isclose(got["x", "g"], math.log(2 / 3) + rise(3.1, 2) - rise(3.1, 2), abs_tol=1e-9)


def test_month_spiral_and_years():
    months = location.month_spiral(2015, 1, radius=2, most=10)
    assert months == [(2015, 1), (2014, 12), (2015, 2), (2014, 11), (2015, 3)] and len(location.month_spiral(2015, 3)) == 60
    assert audit.years_of("2010-2012") == [2010, 2011, 2012]
    for bad in ("2006", "2012-2010", "2010-2024"):
        with pytest.raises(ValueError):
            audit.years_of(bad)


def plain_clauses(words, tags):
    done, before, now = [], 2, None
    for w, t in zip(words, tags, strict=True):
        if before == 2:
            now = []
        if now is not None:
            now.append(w)
        if t == 2 and before in (0, 1):
            done.append(now)
            now = None
        before = t
    return [" ".join(c) for c in (done + ([now] if now else []))]


def test_clauses(spark):
    rng = random.Random(2)
    rows = [([f"w{k}" for k in range(n)], [rng.randint(0, 2) for _ in range(n)]) for n in range(25)]
    frame = spark.createDataFrame(rows, "w array<string>, t array<int>")
    assert [r[0] for r in frame.select(labels.clauses(F.col("w"), F.col("t"))).collect()] == [plain_clauses(w, t) for w, t in rows]


def test_snippets(spark):
    parts = [" ".join(["a"] * 150), " ".join(["b"] * 60), "c", " ".join(["d"] * 250)]
    frame = spark.createDataFrame([(parts,), ([],), ([parts[3]],)], "p array<string>")
    got = [r[0] for r in frame.select(labels.snippets(F.col("p"))).collect()]
    assert got == [[" " + parts[0], parts[1] + " c", parts[3]], [""], ["", parts[3]]]


def test_clause_features_without_clauses(spark):
    row = labels.clause_features(spark.createDataFrame([([],), (["##OTHER", "no label"],)], "l array<string>"), F.col("l")).collect()
    assert row[0].NA_proportion == 0.0 and row[1].NA_count == 1 and row[1].NA_proportion == 1.0


def test_prf_of_nothing(spark):
    truth = spark.createDataFrame([], "author string, label string")
    ranked = spark.createDataFrame([], "author string, location string, rank int")
    assert evaluation.prf(evaluation.confusion(truth, ranked)).first().f1_macro == 0.0


RAW = [{"id": "a", "parent_id": "p", "body": " An OLD man\u0000 ", "author": "x", "created_utc": "60", "subreddit": "s", "score": 3}, {"id": "b", "body": "kid", "created_utc": 120, "score": 1}]


@pytest.mark.parametrize("large", [False, True])
def test_raw_dumps(spark, tmp_path, large):
    data = "\n".join([json.dumps(RAW[0]), "{broken", json.dumps(RAW[1]), "[1]"]) + "\n"
    params = zstandard.ZstdCompressionParameters(window_log=27 if not large else 28)
    (tmp_path / "RC_2010-01.zst").write_bytes(zstandard.ZstdCompressor(compression_params=params).compress(data.encode()))
    rows = posts.normalised(posts.raw_posts(spark, [str(tmp_path / "RC_2010-01.zst")], large_windows=large)).where("id <> ''").orderBy("id").collect()
    assert [(r.id, r.time, r.score) for r in rows] == [("a", "1970-01-01 00:01:00", 3), ("b", "1970-01-01 00:02:00", 1)] and rows[1].author == ""


def test_curated_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_bytes('﻿id,parent id,text,author\n1,p,"two\nlines, ""quoted""\x00",x\n2,,,y\n'.encode())
    rows = posts.read_curated(spark, str(tmp_path / "in.csv"))
    assert rows.columns == ["id", "parent_id", "text", "author"] and [tuple(r) for r in rows.collect()] == [("1", "p", 'two\nlines, "quoted"', "x")]
    posts.write_curated(rows, str(tmp_path / "out"))
    again = posts.read_curated(spark, str(tmp_path / "out"))
    assert again.collect() == rows.collect()


def test_term_lists(spark, tmp_path):
    (tmp_path / "age_old.txt").write_bytes("﻿Fat \r\n\r\n Old\n".encode())
    assert tables.load_terms(spark, str(tmp_path / "age_old.txt")) == ["fat ", " old"]
    assert tables.load_terms(spark, str(tmp_path / "age_old.txt"), keep_mark=True)[0] == "﻿fat "


def test_count_tables(spark, tmp_path):
    lines = [{"author": " A", "hour_counts": {"3": 2, "24": 5, "x": 1}}, {"author": "b", "gmt_hour_counts": {"11": 1, "12": 0}}, {"author": "a", "hour_counts": {"4": 7}}]
    (tmp_path / "h.jsonl").write_text("\n".join(map(json.dumps, lines)))
    rows = tables.read_counts(spark, str(tmp_path / "h.jsonl"), ("hour_counts", "gmt_hour_counts"), "h:", hours=True)
    assert sorted(map(tuple, rows.collect())) == [("a", "h:04", 7), ("b", "h:11", 1)]
    wide = spark.createDataFrame([("u", None, "2", "0"), ("v", '{"q": 4, "r": -1}', "9", "9")], "id string, counts string, w1 string, w2 string")
    assert sorted(map(tuple, tables.row_counts(wide, "id", ["counts"]).collect())) == [("u", "w1", 2), ("v", "q", 4)]
    (tmp_path / "g.csv").write_text("author,geohash_5\nA,xyz\na,abc\n,q\n")
    assert [tuple(r) for r in tables.read_homes(spark, str(tmp_path / "g.csv")).collect()] == [("a", "abc")]
    (tmp_path / "r.csv").write_text("doc,text,rating\n1,a,x\n2,b,3\n")
    assert [r.rating for r in tables.read_ratings(spark, str(tmp_path / "r.csv")).orderBy("doc_id").collect()] == [0, 3]


def test_cache_and_model_tables(spark, tmp_path):
    with sqlite3.connect(tmp_path / "c.db") as db:
        db.execute("CREATE TABLE author_location (author TEXT PRIMARY KEY, location TEXT NOT NULL, updated_at INTEGER NOT NULL)")
        db.execute("INSERT INTO author_location VALUES ('a', 'g', 5)")
    cache = tables.cache_from_sqlite(spark, str(tmp_path / "c.db"))
    fresh = spark.createDataFrame([("a", "h", 9), ("", "h", 9), ("b", "", 9), ("c", "k", 1)], "author string, location string, updated_at long")
    assert sorted(map(tuple, location.cache_upsert(cache, fresh).collect())) == [("a", "h", 9), ("c", "k", 1)]
    params = spark.createDataFrame([("g", 1.0), ("h", 1.0)], "location string, alpha_sum double")
    tables.save_model(str(tmp_path / "m"), params=params, overrides=params, vocab=params)
    assert {r.prior for r in tables.load_model(spark, str(tmp_path / "m"))["priors"].collect()} == {0.5}


def test_streaming_reads_each_file_once(spark, tmp_path):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    stage = lambda rows: rows.where("id % 2 = 0")
    spark.range(10).coalesce(1).write.parquet(source)
    run_available(spark, source, "id long", stage, out, check)
    spark.range(10, 20).coalesce(1).write.mode("append").parquet(source)
    run_available(spark, source, "id long", stage, out, check)
    run_available(spark, source, "id long", stage, out, check)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(0, 20, 2))
    seen = []
    run_batches(spark, source, "id long", lambda rows, n: seen.append(rows.count()), str(tmp_path / "check2"))
    assert sum(seen) == 20


def test_scorers_are_registered():
    labels.register_scorer("mine", lambda t: F.lit(1))
    assert labels.scorer("mine") is labels.SCORERS.pop("mine")
    with pytest.raises(KeyError):
        labels.scorer("mine")


def test_command_line(spark, tmp_path):
    with pytest.raises(SystemExit):
        cli.arguments(["--resource", "filter_keywords", "--group", "age", "--years", "2010", "--posts", "p", "--out", "o"])
    for side, terms in (("old", "old"), ("young", "kid")):
        (tmp_path / f"age_{side}.txt").write_text(terms)
        (tmp_path / f"age_{side}_adv.txt").write_text(rf"\b{terms}\b")
    rows = spark.createDataFrame([(str(k), t, "en", 2010, 1) for k, t in enumerate(["an old man", "kidney", "none", "a kid"])], "id string, text string, lang string, year int, month int")
    rows.write.parquet(str(tmp_path / "posts"))
    common = ["--group", "age", "--years", "2010", "--terms", str(tmp_path)]
    cli.main(["--resource", "filter_keywords", "--posts", str(tmp_path / "posts"), "--out", str(tmp_path / "kept"), *common])
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert sorted(r.id for r in kept.collect()) == ["0", "1", "3"]
    cli.main(["--resource", "filter_sample", "--posts", str(tmp_path / "kept"), "--out", str(tmp_path / "sample"), "--sample", "9", *common])
    sample = str(tmp_path / "sample/sample_n9_2010_to_2010")
    assert spark.read.option("header", True).csv(f"{sample}/annot0").count() == 9
    key = spark.read.option("header", True).csv(f"{sample}/annot1_key")
    assert key.columns == ["random_id", "file", "original_id", "keywords", "sample_type"] and key.count() == 9


PLAN_TEXT = "an old man. Is he kind? He is good and great, or not! the end"


def plain_generalized(text):
    """Snippets, tags, clauses and labels of a short text in plain Python."""
    import hashlib
    import re

    sentences = [x for x in (p.strip(" ") for p in re.split(r"(?<=[.!?])\s+|\n+", text)) if x]
    words = " ".join(sentences).split()  # under 200 words: one snippet
    tags = [2 if w[-1] in ".,;:!?" else 1 if i == 0 or words[i - 1][-1] in ".,;:!?" else 0 for i, w in enumerate(words)]
    clauses = plain_clauses(words, tags)
    names = [x[0] for x in labels.CLAUSE_LABELS]
    return clauses, ["##QUESTION" if c.endswith("?") else names[int(hashlib.md5(c.encode()).hexdigest()[:6], 16) % 18] for c in clauses]


def test_generalization_is_the_plain_one(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").where("n_chars < 900").select("doc_id", "text")
    rows = rows.union(spark.createDataFrame([(-1, PLAN_TEXT), (-2, None), (-3, "")], "doc_id long, text string"))
    seen = 0
    for r in labels.generalized(rows, text.one_line(F.col("text"))).collect():
        if r.doc_id >= 0 and len(r.text.split()) > 190:
            continue
        clauses, found = plain_generalized((r.text or "").strip().replace("\n", " "))
        seen += len(clauses) > 2
        assert (r.clauses, r.generalization_clause_labels) == (clauses, found)
        attributes = {x[0]: x[1:] for x in labels.CLAUSE_LABELS}
        assert r.genericity_generic_count == sum(attributes[x][0] == "generic" for x in found) and r.NA_count == sum(attributes[x][2] == "NA" for x in found)
    assert seen > 5


def test_scored_language(spark):
    rows = spark.createDataFrame([(1, "The end of the day is near"), (2, "le jour et la nuit"), (3, "12 34"), (4, None)], "id long, text string")
    got = {r.id: r.x for r in rows.select("id", labels.scorer("language")(F.col("text")).alias("x")).collect()}
    assert got == {1: "en", 2: "fr", 3: "und", 4: "und"}


def test_source_rows_of_a_large_file(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", "b", "b", None]), k) for k in rng.sample(range(10_000), 900)]
    got = {(r.f, r.pos): r.source_row for r in audit.with_source_row(spark.createDataFrame(rows, "f string, pos long").repartition(7), "f", ["pos"]).collect()}
    for f in ("a", "b", None):
        own = sorted(p for x, p in rows if x == f)
        assert [got[f, p] for p in own] == list(range(1, len(own) + 1))


def test_correlation_p_value():
    # Of published tables of t: r = 0.632 of 10 pairs and r = 0.765 are the bounds of 0.05 and 0.01.
    assert abs(evaluation.pearson_p(0.6319, 10) - 0.05) < 1e-4 and abs(evaluation.pearson_p(0.7646, 10) - 0.01) < 1e-4
    assert evaluation.pearson_p(0.0, 10) == 1.0 and evaluation.pearson_p(1.0, 10) == 0.0 and math.isnan(evaluation.pearson_p(0.5, 2))


def test_locations_of_posts(spark, data):
    from corvane.plans.queries import SMOOTHING, model_of
    from corvane.sources.posts import posts as posts_of

    m = model_of(spark, data)
    rows = posts_of(spark, data).union(spark.createDataFrame([(-1, "x", "en", "s", "[deleted]", None), (-2, "x", "en", "s", None, None)], posts_of(spark, data).schema))
    found, fresh = location.located(rows, m, SMOOTHING, months=[(2024, 1)], most_posts=3)
    got = {r.id: r.location for r in found.select("id", "location").collect()}
    assert got[-1] == got[-2] == location.UNKNOWN and {v for k, v in got.items() if k >= 0} <= {f"g{k}" for k in range(7)} and fresh.columns == ["author", "location"]
    assert [r.location for r in location.likeliest(m["priors"], 2).collect()] == [r.location for r in m["priors"].orderBy(F.desc("prior"), "location").collect()][:2]


def test_vocabularies_and_splits(spark, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps([{"author": " a", "vocab": {"x": 2, "y": 0}}, {"author": "b", "vocab": {"z": 1}}]))
    (tmp_path / "named.json").write_text(json.dumps({"a": {"x": 2}, "b": {"z": 1}}))
    (tmp_path / "lines.jsonl").write_text('{"author": "a", "vocab": {"x": 9}}\n{"author": "a", "vocab": {"x": 2}}\n{"author": "b", "vocab": {"z": 1}}\n')
    users = spark.createDataFrame([("a",)], "author string")
    for name in ("list.json", "named.json", "lines.jsonl"):
        assert sorted(map(tuple, tables.read_vocabulary(spark, str(tmp_path / name)).collect())) == [("a", "w:x", 2), ("b", "w:z", 1)]
        assert [tuple(r) for r in tables.read_vocabulary(spark, str(tmp_path / name), users).collect()] == [("a", "w:x", 2)]
    homes = spark.createDataFrame([("a", "g")], "author string, location string")
    small = spark.createDataFrame([("a", "s:n", 4), ("b", "s:n", 1)], "author string, feature string, cnt long")
    words = tables.read_vocabulary(spark, str(tmp_path / "named.json"))
    assert sorted(map(tuple, tables.geo_vocabulary(words, homes, small).collect())) == [("g", "s:n", 4), ("g", "w:x", 2)]
    (tmp_path / "train_users.csv").write_text('u1,9\n"u,2"\n')
    (tmp_path / "train_labels.txt").write_text("1\n0\nx\n")
    assert [r.item for r in tables.read_split_items(spark, str(tmp_path / "train_users.csv")).collect()] == ["u1", "u,2"]
    assert [r.item for r in tables.read_split_items(spark, str(tmp_path / "train_labels.txt"), "int").collect()] == [1, 0, None]
    (tmp_path / "split.csv").write_text('id,counts\nu,"{""q"": 4, ""r"": -1}"\n')
    assert [tuple(r) for r in tables.read_split_users(spark, str(tmp_path / "split.csv"), "id", ["counts"]).collect()] == [("u", "q", 4)]
    tables.write_split(sampling.exact_split(spark.range(10), "id"), str(tmp_path / "s"))
    assert [tables.read_split(spark, str(tmp_path / "s"), k).count() for k in ("train", "valid", "test")] == [8, 1, 1]


def test_annotations_of_two_raters(spark, tmp_path):
    (tmp_path / "relevance_sample_age_0_rated.csv").write_text("id,text,rating\n1, one ,x\n2,two,0\n3,three,1\n")
    (tmp_path / "relevance_sample_age_1_rated.csv").write_text("id,text,rating\n1,other,0\n2,other,1\n3,other,x\n")
    (tmp_path / "age_retraining_sample_rated.csv").write_text("id,q,text,rating\n7,?,again,x\n8,?,more,1\n")
    got = sorted((r.doc_id, r.text, r.label) for r in tables.main_annotations(spark, str(tmp_path), "age").collect())
    assert got == [(1, "one", 0), (2, "two", 1), (3, "three", 1)]
    assert sorted((r.doc_id, r.text, r.label) for r in tables.retraining_annotations(spark, str(tmp_path), "age").collect()) == [(7, "again", 0), (8, "more", 1)]


def test_raw_lines_that_break_are_kept_aside(spark, tmp_path):
    (tmp_path / "RC_2010-01.json").write_text(json.dumps(RAW[0]) + "\n{broken\n[1]\n" + json.dumps(RAW[1]) + "\n")
    rows = posts.raw_posts(spark, [str(tmp_path / "RC_2010-01.json")], quarantine=str(tmp_path / "bad"))
    assert sorted(r.id for r in rows.collect()) == ["a", "b"] and {r.file for r in rows.collect()} == {"RC_2010-01.json"}
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == ["[1]", "{broken"]
    own = posts.feature_posts(rows).orderBy("id").first()
    assert own.text == "An OLD man\u0000" and own.author == "x"


def test_broken_lines_of_large_windows_are_kept_aside(spark, tmp_path):
    data = "\n".join([json.dumps(RAW[0]), "", "{broken", json.dumps(RAW[1] | {"body": "a\u2028b\r"}), "[1]"])
    (tmp_path / "RC_2010-01.zst").write_bytes(zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters(window_log=28)).compress(data.encode()))
    rows = posts.raw_posts(spark, [str(tmp_path / "RC_2010-01.zst")], large_windows=True, quarantine=str(tmp_path / "bad")).orderBy("id").collect()
    assert [(r.id, r.body, r.created_utc, r.file) for r in rows] == [("a", RAW[0]["body"], "60", "RC_2010-01.zst"), ("b", "a\u2028b\r", "120", "RC_2010-01.zst")]
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == ["", "[1]", "{broken"]


def test_a_trained_model_takes_the_place_of_its_scorer(spark, tmp_path, monkeypatch):
    from corvane.operators import training
    from corvane.plans.pipeline import Plan

    monkeypatch.setattr(labels, "MODELS", {})
    rated = spark.createDataFrame([(k, "good old words" if k % 3 == 0 else "other things here", int(k % 3 == 0)) for k in range(60)], "id long, text string, label int")
    rows = spark.createDataFrame([(1, "GOOD\nold words", None), (2, "other things", None), (3, None, None), (4, "", None)], "id long, text string, p string")
    plan, model = Plan("age", [("old", ["old"])], ["old"]), training.fit_classifier(rated)
    for name in ("relevance", "moralization"):
        labels.register_model(name, model)
    kept = plan.filter_relevance(rows)
    assert kept.columns == rows.columns and [r.id for r in kept.collect() if r.id < 3] == [1]
    assert [r.moralization for r in plan.stages["label_moralization"](rows).where("id < 3").orderBy("id").collect()] == ["Moralized", "Non-Moralized"]
    emotion = training.fit_classifier(spark.createDataFrame([(f"word{k % 7} filler", k % 7) for k in range(70)], "text string, label int"))
    labels.register_model("emotion_1", emotion)
    scores = labels.emotions(spark.createDataFrame([(f"word{k}",) for k in range(7)], "text string"), F.col("text")).orderBy("text").collect()
    names = labels.EMOTIONS[0][2]
    assert [max(names, key=lambda n: r[f"1_{n}"]) for r in scores] == list(names)
    with pytest.raises(SystemExit):
        cli.arguments(["--resource", "filter_relevance", "--group", "age", "--years", "2010", "--posts", "p", "--terms", "t", "--out", "o", "--trained", "nothing=x"])


def test_stages_count_their_rows(spark, tmp_path):
    from corvane.plans.pipeline import Plan

    rows = spark.createDataFrame([(str(k), t, "en", 2010, 1) for k, t in enumerate(["an old man", "kidney", "none", None])], "id string, text string, lang string, year int, month int")
    plan = Plan("age", [("old", ["old"]), ("young", ["kid"])], ["old"])
    counts = plan.run_and_write(rows, "filter_language", str(tmp_path / "out"), str(tmp_path / "metrics"))
    assert counts["input"] == {"total": 4, "missing": 1} and counts["filter_keywords"]["total"] == counts["filter_language"]["total"] == 2
    plan.run_and_write(rows, "filter_language", str(tmp_path / "out"), str(tmp_path / "metrics"), append=True)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4 and spark.read.parquet(str(tmp_path / "metrics")).count() == 12
    with pytest.raises(ValueError):
        plan.run(rows, "label_location")
    labelled = plan.run(rows, "label_emotion")
    assert {"moralization", "sentiment_polarity", "clauses", "1_anger"} <= set(labelled.columns)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from corvane.sources import scratch

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        scratch.application_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))


def test_every_resource_of_the_command_line(spark, tmp_path, monkeypatch):
    for resource in ("label_location", "metrics_interrater", "train_relevance", "train_location", "label_sentiment"):
        with pytest.raises(SystemExit):
            cli.arguments(["--resource", resource, "--group", "age", "--out", "o"])
    with pytest.raises(SystemExit):
        cli.arguments(["--resource", "filter_sample", "--group", "age", "--years", "1999", "--posts", "p", "--sample", "3", "--out", "o"])
    for k in (0, 1):
        for name in (f"relevance_sample_age_{k}.csv", f"relevance_sample_age_{k}_rated.csv"):
            (tmp_path / name).write_text("id,text,rating\n" + "".join(f"{i},{'good old words' if i % 2 else 'other things here'},{int(i % 2 == 1 and (i + k) % 9 > 0)}\n" for i in range(40)))
    cli.main(["--resource", "metrics_interrater", "--group", "age", "--ratings", str(tmp_path), "--out", str(tmp_path / "kappa")])
    row = spark.read.option("header", True).csv(str(tmp_path / "kappa")).first()
    assert row.n == "40" and float(row.cohen_kappa) > 0.5 and 0 <= float(row.p_value) < 0.01 and row.unmatched == "0"
    cli.main(["--resource", "train_relevance", "--group", "age", "--ratings", str(tmp_path), "--out", str(tmp_path / "relevance")])
    assert spark.read.parquet(str(tmp_path / "relevance/metrics")).count() == 1
    own = spark.createDataFrame([(f"u{k}", f"w:{'ab'[k % 2]}{j}", 3) for k in range(20) for j in range(4)], "author string, feature string, cnt long")
    homes = spark.createDataFrame([(f"u{k}", "gh"[k % 2], "train" if k < 14 else "valid") for k in range(20)], "author string, location string, split string")
    own.write.parquet(str(tmp_path / "features"))
    homes.write.parquet(str(tmp_path / "homes"))
    cli.main(["--resource", "train_location", "--features", str(tmp_path / "features"), "--homes", str(tmp_path / "homes"), "--out", str(tmp_path / "location")])
    (tmp_path / "age_old.txt").write_text("old")
    (tmp_path / "age_young.txt").write_text("kid")
    (tmp_path / "age_old_adv.txt").write_text("old")
    (tmp_path / "age_young_adv.txt").write_text("kid")
    rows = spark.createDataFrame([(str(k), "an old a0 a1 the of", "u2", "s", "2010-01-05 10:00:00", "en", 2010, 1) for k in range(12)], "id string, text string, author string, subreddit string, time string, lang string, year int, month int")
    rows.write.parquet(str(tmp_path / "posts"))
    common = ["--group", "age", "--years", "2010", "--terms", str(tmp_path), "--posts", str(tmp_path / "posts")]
    cli.main(["--resource", "label_location", "--model", str(tmp_path / "location/model"), "--out", str(tmp_path / "located"), "--array", "0", *common])
    counted = {r.stage for r in spark.read.parquet(str(tmp_path / "located_metrics")).collect()}
    assert {"input", "filter_keywords", "label_generalization", "label_location"} <= counted
    monkeypatch.setattr(labels, "MODELS", {})
    cli.main(["--resource", "filter_relevance", "--out", str(tmp_path / "relevant"), "--trained", f"relevance={tmp_path / 'relevance/model'}", *common])
    assert spark.read.parquet(str(tmp_path / "relevant")).count() == 12  # all hold "old", as what was rated relevant does
    from corvane.plans.pipeline import Plan

    plan = Plan("age", [("old", ["old"])], ["old"], location_model=tables.load_model(spark, str(tmp_path / "location/model")))
    assert {r.location for r in plan.label_location(rows).collect()} <= {"g", "h"}
