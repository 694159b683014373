"""Language ID, near-dedup, URL filter, mixing and the pipeline against brute force."""

import base64
import inspect
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import language, mixing, near_dup, url_filter
from corvane.llm.shingles import band_hashes, prob_min_hash, shingle_hashes, weighted
from corvane.llm.common import words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table_of(spark, rows):
    return spark.createDataFrame(rows, DOCS)


# Language ID


def test_held_out_accuracy(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = language.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = table_of(spark, [(900001, None, "en", "s", 0), (900002, "", None, None, 0), (900003, "123 456 !!", "en", "s", 0), (None, "hello the of and", None, None, None), (900004, "Q", "xx", "s", 1), (900004, "Q", "xx", "s", 1)])
    rows = language.report(docs.union(odd)).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() + 6
    assert all(by[k].lang_pred == "und" and by[k].score == 0.0 for k in (900001, 900002, 900003)) and not by[None].held_out
    assert language.report(docs.where("doc_id < 0")).count() == 0
    assert {r.lang_pred for r in language.report(odd.where("lang IS NULL")).collect()} == {"und"}
    kept = language.in_a_language(docs.union(odd))
    assert kept.columns == docs.columns and kept.where("doc_id < 900000").count() == docs.count() and kept.where("doc_id in (900001, 900002, 900003)").count() == 0


def test_junk_and_unlearned_languages_are_rejected(spark, data):
    docs = spark.read.parquet(f"{data.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rng = random.Random(11)
    letters = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))
    code = inspect.getsource(near_dup).split()
    junk = [letters(n) for n in [20] * 60 + [100] * 60 + [400] * 10] + [" ".join(code[k : k + 150]) for k in range(0, 900, 100)]
    junk += [base64.b64encode(rng.randbytes(900)).decode() for _ in range(20)]
    unlearned = [r.text for r in docs.where("lang = 'fr' AND n_chars > 600").limit(60).collect()]
    short = [" ".join(r.text.split()[:12]) for r in docs.where("lang <> 'fr' AND n_chars > 600").limit(60).collect()]
    learned = docs.withColumn("lang", F.when(F.col("lang") != "fr", F.col("lang")))
    rows = [(10**6 + k, t, None, "s", len(t)) for k, t in enumerate(junk)] + [(2 * 10**6 + k, t, None, "s", len(t)) for k, t in enumerate(unlearned)]
    rows += [(3 * 10**6 + k, t, None, "s", len(t)) for k, t in enumerate(short)]
    kept = [r.doc_id for r in language.in_a_language(learned.union(table_of(spark, rows))).select("doc_id").collect()]
    n = Counter(i // 10**6 for i in kept)
    own = docs.where("lang <> 'fr'").count()
    assert n[1] <= 0.05 * len(junk) and n[2] <= 0.1 * len(unlearned) and n[3] >= 0.95 * len(short)
    assert len({i for i in kept if i < 10**6} & {r.doc_id for r in docs.where("lang <> 'fr'").collect()}) >= 0.99 * own


def test_the_pipeline_learns_languages_from_every_document(spark, monkeypatch):
    rng, seen = random.Random(5), []
    rows = [(k, " ".join("".join(rng.choices("abcdefgh" if k % 2 else "ghijklmnop", k=rng.randint(2, 5))) for _ in range(rng.randint(3, 9))), "ab"[k % 2], "s", 0) for k in range(3600)]
    learn = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    assert min(Counter(r[2] for r in learn).values()) > language.TRAIN_ROWS
    monkeypatch.setattr(language, "predicted", lambda docs, model, **given: seen.append((model, given["low"])) or docs.withColumn("lang_pred", F.lit("a")))
    assert language.in_a_language(table_of(spark, rows + rows[:50])).count() == len(rows) + 50  # repeated rows stay, and are learned from once
    (names, profile), low = seen[0]
    grams, found = language.Grams(), []
    sized = [(r[2], *language.sized_vector(r[1], grams)) for r in learn]
    for lang, got in zip(names, profile, strict=True):
        total = sum(v.astype(float) for x, v, _ in sized if x == lang)
        assert np.allclose(got, total / np.linalg.norm(total), atol=1e-5)
        own = [(total - v, v, size) for x, v, size in sized if x == lang]
        each = [language.strength(float(rest @ v) / np.linalg.norm(rest), size) for rest, v, size in own]
        assert low[lang] == pytest.approx(np.quantile(each, language.LOW), abs=1e-5)
        found.append(lang)
    assert found == ["a", "b"]


def test_letterless_texts_go_when_nothing_was_learned(spark):
    docs = table_of(spark, [(1, "some words", None, "s", 10), (2, "12 34", None, "s", 5), (3, None, None, "s", 0)])
    assert [r.doc_id for r in language.in_a_language(docs).collect()] == [1]


def test_vectors_are_bound_and_bundled():
    grams = language.Grams(64)
    v = language.text_vector("ab", grams)
    vector = lambda c: language.letter_vector(ord(c), 64).astype(int)
    gram = lambda s: np.roll(vector(s[0]), 2) * np.roll(vector(s[1]), 1) * vector(s[2])
    plain = gram(" ab") + gram("ab ")
    assert np.allclose(v, plain / np.linalg.norm(plain))


# Near-dedup


def edited(words, rng, share):
    return [w if rng.random() > share else f"new{rng.random():.9f}"[:12] for w in words]


def family(rng, n, base, share):
    return [" ".join(edited(base, rng, share)) for _ in range(n)]


def brute_classes(rows):
    sets = {i: set(shingle_hashes(words_of(t)).tolist()) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= 0.8 * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {i: root(i) for i in ids}


def test_classes_are_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)  # many blocks
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = [" ".join(word() for _ in range(120)) for _ in range(15)]
    base = [word() for _ in range(300)]
    texts += [" ".join(base), *family(rng, 30, base, 0.01), *family(rng, 40, base, 0.035)]
    chain = [word() for _ in range(200)]
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = edited(chain, rng, 0.012)
    texts += [texts[0].upper() + "!!", texts[3].replace(" ", "\n"), "one two three", "One, two; three", "", None, "?!", "short"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_repeated_passages_hide_no_candidate():
    # Sets of 200 and 180 shingles, plain Jaccard 0.9; the passage that only one repeats a thousand times must not weigh.
    rng, lost = random.Random(5), 0
    for _ in range(120):
        words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(204)]
        passage = words[:100]
        a, b = " ".join(passage * 1000 + words[100:]), " ".join(words[:184])
        sets = [weighted(t) for t in (a, b)]
        x, y = (set(s[0].tolist()) for s in sets)
        assert len(x & y) >= 0.8 * len(x | y)
        owner = np.repeat([0, 1], [len(s[0]) for s in sets])
        bands = band_hashes(prob_min_hash(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), owner, 2, near_dup.BANDS * near_dup.ROWS), near_dup.BANDS, near_dup.ROWS)
        lost += not (bands[0] == bands[1]).any()
    assert lost == 0


def test_near_dup_edges(spark):
    docs = table_of(spark, [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "en", "s", 2), (3, None, None, None, None), (None, "a b c d e f", None, None, None), (4, "", "en", "s", 0)])
    rows = near_dup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in rows) == Counter([(1, 1), (1, 1), (2, 1), (3, 3), (4, 4), (None, None)])
    kept = near_dup.deduplicated(docs.withColumns({"id": F.lit(1), "bucket": F.lit(2)}))
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 4, None]) and kept.columns == [*docs.columns, "id", "bucket"]
    assert near_dup.near_duplicates(docs.where("doc_id > 9")).count() == 0 and near_dup.deduplicated(docs.where("doc_id > 9")).count() == 0


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    a, c, d = "a b c d e f g h", "q w e r t z u i", "lone words stand here for themselves"
    docs = spark.createDataFrame([(1, a), (5, a), (5, c), (7, c), (5, c), (9, d), (9, None), (9, ""), (8, d)], "doc_id long, text string")
    rows = Counter((r.doc_id, r.class_id) for r in near_dup.near_duplicates(docs).collect())
    assert rows == Counter([(1, 1), (5, 1), (5, 5), (5, 5), (7, 5), (9, 8), (9, 9), (9, 9), (8, 8)])
    kept = Counter((r.doc_id, r.text) for r in near_dup.deduplicated(docs).collect())
    assert {k for k in kept if k[0] != 9} == {(1, a), (5, c), (8, d)} and sum(n for k, n in kept.items() if k[0] == 9) == 1


def test_recall_of_links_over_planted_edits(spark):
    """Recall of pairs of the definition (0.8), and of looser copies where a lower threshold with bands to match is asked for."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows, pairs = [], []
    for k in range(150):
        own = [word() for _ in range(rng.randint(60, 400))]
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(edited(own, rng, rng.choice([0.005, 0.02, 0.035, 0.05]))))]
        x, y = (set(shingle_hashes(words_of(t)).tolist()) for _, t in rows[-2:])
        pairs.append((2 * k, len(x & y) / len(x | y)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    for threshold, bands, wide in ((0.8, near_dup.BANDS, near_dup.ROWS), (0.6, 48, 3)):
        got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs, threshold=threshold, bands=bands, rows=wide).collect()}
        due = [i for i, s in pairs if s >= threshold]
        assert len(due) > 40 and sum(got[i] == got[i + 1] for i in due) >= 0.99 * len(due)
        assert not any(got[i] == got[i + 1] for i, s in pairs if s < threshold)
    docs.unpersist()


def test_hot_pivots_and_wide_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "RAYS", 7)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 2000)
    rng = random.Random(17)
    base = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    rows = list(enumerate([" ".join(base), *family(rng, 40, base, 0.01), *family(rng, 40, base, 0.03)]))
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    a, b = rng.exponential(1, 300), rng.exponential(1, 300)
    a[:60], b[240:] = 0, 0
    exact = sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in range(300)) for x in range(300) if a[x] and b[x])
    m = 4096
    sig = prob_min_hash(np.concatenate([keys, keys]), np.concatenate([a, b]), np.repeat([0, 1], 300), 2, m)
    assert abs((sig[0] == sig[1]).mean() - exact) < 4 * (exact * (1 - exact) / m) ** 0.5
    assert band_hashes(sig, 512, 8).shape == (2, 512)


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(100, rng.randint(101, 160)) for _ in range(40)] + [(7, 7)]
    found = {r.id: r.component for r in near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[k] == 0 for k in range(41)) and all(v == 100 for k, v in found.items() if k >= 100)


# URL filter


def brute_rule(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for verdict, rule in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best[1] if best else None, best[0] if best else None


URLS = ["http://WWW.Example.COM/en/71?x=1#y", "https://a.example.net/de/8", "http://example.net/de/7/", "http://notexample.com/en/7", "ftp://com/en/", "http://com/en", "x.com/en/", None, "", "http://", "https://b.org/es/1?u=http://c.com/en/", "http://h.org?/es/", "http://k.org#/es/", "http://k.org//es/", "a://b://c.com/en/", "http://spam.example.org/fr/1", "http://spam.example.org/fr/1"]


@pytest.mark.parametrize("most", [200, 0])
def test_rules(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "MOST_RULES", most)
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rows = url_filter.report(pages).orderBy("page_id").collect()
    assert len(rows) == len(URLS)
    for r, url in zip(rows, URLS, strict=True):
        host, path, rule, verdict = brute_rule(url)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)


def judged(model, urls):
    return {r.url: r["__blocked"] for r in model.judged(url_filter.placed(urls, "url")).collect()}


def test_trees_judge_the_rest(spark, data):
    """Held-out hosts: the trees learn from four fifths of the hosts' labelled urls and are measured on the rest, against the majority answer."""
    pages = spark.read.parquet(f"{data.replace('0.001', '0.1')}/pages.parquet")
    labelled = url_filter.placed(url_filter.labelled_sample(pages, n=2500), "url").withColumn("held", F.pmod(F.xxhash64("__host", F.lit("held")), F.lit(5)) == 0).cache()
    model = url_filter.Model(labelled.where("NOT held").select("url", "blocked"))
    used = [f for f, x in zip(url_filter.FEATURES, model.trees.featureImportances.toArray(), strict=True) if x > 0.005]
    assert len(used) >= 4 and "suffix_blocked" in url_filter.FEATURES, used
    held = labelled.where("held").select("url", "blocked").distinct().cache()
    found, truth = judged(model, held.select("url")), {r.url: r.blocked for r in held.collect()}
    right = sum((found[u] == 1.0) == y for u, y in truth.items()) / len(truth)
    majority = max(sum(truth.values()), len(truth) - sum(truth.values())) / len(truth)
    hit = sum(found[u] for u, y in truth.items() if y) / sum(truth.values())
    assert len(truth) > 300 and right > 0.9 > majority and hit > 0.8, (right, majority, hit)
    probes = {"https://ads.example.org/x": 1.0, "https://casino.example.net/en/1": 1.0, "https://my-garden.example.com/en/1": 0.0, "https://www.news-city.example.org/2": 0.0}
    assert judged(model, spark.createDataFrame([(u,) for u in probes], "url string")) == probes
    labelled.unpersist()


def test_filtered_keeps_columns_and_follows_labels(spark, data):
    pages = spark.read.parquet(f"{data.replace('0.001', '0.01')}/pages.parquet")
    rows = url_filter.filtered(pages.withColumn("rank", F.lit(1)))
    assert rows.columns == [*pages.columns, "rank", "host", "path", "rule", "verdict"] and rows.count() == pages.count()
    rest = rows.where("rule IS NULL").collect()
    listed = lambda h: bool(set(h.replace("-", ".").split(".")) & set(url_filter.WORDS))
    assert sum((r.verdict == "block") != listed(r.host) for r in rest) <= 0.05 * len(rest)
    assert url_filter.report(pages.where("page_id < 0")).count() == 0
    own = spark.createDataFrame([(f"http://{w}{k}.t.xy/a", w == "bad") for k in range(60) for w in ("bad", "good")], "url string, blocked boolean")
    got = {r.host: r.verdict for r in url_filter.filtered(spark.createDataFrame([(1, "http://bad.t.xy/z"), (2, "http://good.t.xy/z")], "page_id long, url string"), rules=(), labelled=own).collect()}
    assert got == {"bad.t.xy": "block", "good.t.xy": "allow"}


def test_suffixes_and_words(spark):
    hosts = ["a.b.example.com", "x.example.co.uk", "co.uk", "com", "", "casino77-win.x.org"]
    rows = spark.createDataFrame([(h,) for h in hosts], "h string").select(url_filter.suffix_of(F.col("h")).alias("s"), url_filter.words_of_host(F.col("h")).alias("w")).collect()
    assert [r.s for r in rows] == ["example.com", "example.co.uk", "co.uk", "com", "", "x.org"] and rows[5].w == ["casino", "win", "x", "org"] and rows[4].w == []


def test_statistics_are_out_of_fold(spark):
    """A word or suffix that only one host has tells the trees nothing of that host's label; plain sums over the other folds give the rest."""
    rng = random.Random(4)
    rows = [(f"http://w{rng.choice('abc')}.n{rng.randint(0, 12)}.xy/{k}", rng.random() < 0.4) for k in range(120)]
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    model = url_filter.Model(labelled)
    made = url_filter.lexical(url_filter.placed(labelled.select("url", F.col("blocked").cast("double").alias("label")), "url")).withColumn("__fold", F.pmod(F.xxhash64("__host"), F.lit(url_filter.FOLDS))).drop("__url")
    got = model._out_of_fold(made, made.select("url", "__fold", "label", F.explode("__words").alias("w"))).collect()
    base = sum(y for _, y in rows) / len(rows)
    of = {r.url: (r["__suffix"], r["__fold"], r.label) for r in got}
    for r in got:
        others = [y for s, fold, y in of.values() if s == r["__suffix"] and fold != r["__fold"]]
        assert abs(r.suffix_blocked - (sum(others) + url_filter.PRIOR * base) / (len(others) + url_filter.PRIOR)) < 1e-9


# Mixing


def mixing_rows(rng):
    rows = [(k, " ".join(["w"] * rng.randint(0, 50)), "en", rng.choice(["a", "b", "B", "é", None, "c", "big", "big", "big"]), 0) for k in range(400)]
    return [*rows, (500, None, "en", "a", 0), (None, "x y z", None, None, None), (7, "w w", "en", "a", 0), (7, "w w", "en", "a", 0), (600, None, None, "empty", None), (601, "z " * 5000, "en", "c", 0)]


def test_mix_is_the_sql(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    rows = mixing_rows(random.Random(9))
    docs = table_of(spark, rows).repartition(3)
    got = sorted(map(tuple, mixing.report(docs).collect()), key=repr)
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text, source FROM documents")
    assert got == sorted(con.execute(mixing.ORACLE).fetchall(), key=repr)
    targets, taken = {}, Counter()
    by = {id(r): r for r in got}
    sources = Counter()
    for r in got:
        assert r[4] <= 2 * r[1]
        targets[r[2], r[3]] = r[3]
        taken[r[2], r[3]] += r[4]
    assert by and sources is not None
    for key, target in targets.items():
        assert abs(taken[key] - target) <= 5000


def test_mix_edges(spark):
    docs = table_of(spark, mixing_rows(random.Random(2)))
    assert mixing.report(docs.where("doc_id > 9999")).count() == 0
    assert mixing.curriculum(docs.where("doc_id > 9999")).count() == 0
    silent = mixing.report(table_of(spark, [(1, None, None, "a", 0), (2, "", None, None, 0)])).collect()
    assert [r.taken for r in silent] == [0, 0]
    mixed = mixing.curriculum(docs)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r.n for r in mixing.mixed(docs, mixing.n_words(F.col("text"))).groupBy("doc_id").agg(F.sum("__copies").alias("n")).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({k: n for k, n in copies.items() if n})


def test_positions_invert_the_schedule():
    from math import isclose

    for early, _ in mixing.TILTS:
        for share in (0.0, 0.1, 0.5, 1.0):
            t = min(1.0, 2 * share / (early + (early * early + 4 * (1 - early) * share) ** 0.5))
            assert isclose(early * t + (1 - early) * t * t, share, abs_tol=1e-9)


# The pipeline


def test_pipeline(spark, data):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, data)
    assert rows.count() > 0 and {"ids", "cu_seqlens", "position_resets"} <= set(rows.columns)
    docs = spark.read.parquet(f"{data}/documents.parquet")
    odd = docs.union(table_of(spark, [(90001, None, None, None, None), (90002, "", "en", "s", 0), (None, "the of and to in is", "en", "s", 9)]))
    for name, stage in corpus_pipeline.STAGES[:4]:
        odd = stage(spark, odd, data)
        assert odd.columns == docs.columns, name
        assert odd.count() > 0
    nothing = docs.where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, data).count() == 0


def test_pipeline_by_brute_force(spark, data):
    """What each stage keeps, by plain Python: copies by classes, contaminated texts by windows, epochs by mixing's own report, tokens by decoding."""
    import corpus_pipeline
    from corvane.llm import packing

    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    bench = [w for (t,) in spark.read.parquet(f"{data}/benchmark.parquet").select("text").collect() if len(w := words_of(t)) >= 10]
    leak = b" ".join(bench[0][:10]).decode()
    some = docs.where("n_chars > 600").orderBy("doc_id").first()
    planted = [(10**6, some.text, "en", "s", 0), (10**6 + 1, some.text + " and", "en", "s", 0), (10**6 + 2, "before it " + leak + " after it", "en", "s", 0), (10**6 + 3, "0101 -- 2222", "en", "s", 0)]
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs.union(table_of(spark, planted)), data).cache()
    assert {10**6 + 3}.isdisjoint(r.doc_id for r in kept.collect()) and kept.where("doc_id < 1000000").count() >= 0.98 * docs.count()
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    classes = brute_classes(rows)
    single = stages["near_dedup"](spark, kept, data).cache()
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, c in classes.items() if i == c)
    windows = {(n, tuple(w[i : i + n])) for w in (words_of(t) for (t,) in spark.read.parquet(f"{data}/benchmark.parquet").select("text").collect()) if w for n in [min(10, len(w))] for i in range(len(w) - n + 1)}
    sizes = {n for n, _ in windows}
    hit = lambda w: any((n, tuple(w[i : i + n])) in windows for n in sizes for i in range(len(w) - n + 1))
    clean = stages["decontamination"](spark, single, data).cache()
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in single.collect() if not hit(words_of(r.text)))
    assert 10**6 + 2 not in {r.doc_id for r in clean.collect()}
    mixed = stages["mix"](spark, clean, data).cache()
    sizes_of = {r.doc_id: r for r in mixing.report(clean).collect()}
    n = Counter(r.doc_id for r in mixed.collect())
    assert all(k * (size := sizes_of[i]["size"]) >= sizes_of[i].taken > (k - 1) * size for i, k in n.items() if sizes_of[i]["size"]) and all(sizes_of[i].taken == 0 for i in sizes_of if i not in n)
    pieces = {}
    for r in stages["pack"](spark, mixed, data).collect():
        ids = np.frombuffer(r.ids, "<i4")
        for d, part, a, b in zip(r.doc_ids, r.parts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            pieces.setdefault(d, Counter())[part, tuple(ids[a:b].tolist())] += 1
    texts = {r.doc_id: r.text for r in clean.collect()}
    for d, k in n.items():
        assert set(pieces[d].values()) == {k}
        ids = [x for _, p in sorted(pieces[d]) for x in p]
        assert packing.encoding().decode(ids[:-1]) == texts[d] and ids[-1] == packing.SEPARATOR
    for df in (kept, single, clean, mixed):
        df.unpersist()
