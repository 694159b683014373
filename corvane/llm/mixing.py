"""Mixing sources to target weights under a time-varying curriculum.

Each source's weight is a schedule over training time, from 0 to 1: a line from `early` to `late` times its mean. Integrated
and scaled to the source's target it is the source's cumulative token demand, a quadratic. A source serves its documents in
the order of md5('mix:' || doc_id), over and over until the demand ends; a copy is due where the cumulative demand reaches the
middle of the words it brings, and inverting the quadratic there gives its training position. Range-sorting by position gives
the training order.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating, and share 1.5 times all words; a target stops at
twice its source's words, and the excess is reshared by weight until none is above.

A source's documents are split by the head of their digest into buckets of about `bucket_rows`. Running sums are taken within
a bucket and, from pre-aggregated totals, over the buckets; so a source that holds most rows is still spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import settled, written

WEIGHTS, SHARE, MOST_EPOCHS, BUCKET_ROWS = (3, 1, 2), 1.5, 2, 2000
#: Of the schedule, in the order of the weights: the weight at time 0 and at time 1, times the mean; they add up to 2.
TILTS = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))


def n_words(text: Column) -> Column:
    """The number of runs of other than space and the controls 9 to 13; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """Adds rank, weight and target to sources (source, source_size, ...), one row each.

    The global rank comes from a range sort and the sizes of its partitions, without gathering the sources; each round of
    resharing is one aggregation, and caps only ever join, so it ends.
    """
    spark = sources.sparkSession
    ordered = settled(sources.orderBy(F.col("source").asc_nulls_last()).select("*", F.spark_partition_id().alias("__part"), (F.monotonically_increasing_id() % (1 << 33)).alias("__at")))
    before, offsets = 0, []
    for part, n in sorted(map(tuple, ordered.groupBy("__part").count().collect())):  # one row for each partition
        offsets.append((part, before))
        before += n
    starts = spark.createDataFrame(offsets, "__part int, __before long")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = settled(ordered.join(F.broadcast(starts), "__part").withColumn("rank", F.col("__at") + F.col("__before")).drop("__part", "__at", "__before").withColumn("weight", weight))
    cap = F.col("source_size") * MOST_EPOCHS
    all_words, held, left, capped = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.lit(0), F.coalesce(F.sum("weight"), F.lit(1)), F.lit(0)).first()
    while True:
        level = (SHARE * all_words - held) / left if left else 0.0
        full = F.lit(level) * F.col("weight") > cap
        held, left, n = ranked.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)), F.count_if(full)).first()
        if n == capped or not left:
            return ranked.withColumn("target", F.when(full, cap.cast("double")).otherwise(F.lit(level) * F.col("weight")))
        capped = n


def mixed(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs with __key, __size, __source_size, __target, __copies and __positions (of each copy, ascending).

    Copies are whole documents: in each pass over the source a document is taken if the middle of its words is before the target.
    So the words taken differ from the target by half a document at most, and no document is taken more than twice. Ties and
    repeated ids go by id, size and then content. A document without words adds nothing and is taken as its place says; where
    a source has no words at all, each is taken once. Null sources are one source. An empty table gives an empty result.
    """
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    sized = docs.withColumns({"__size": size, "__key": key, "__tie": F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind])})
    narrow = written(sized.select(F.col(source_col).alias("source"), "__size", "__key"), "sizes")
    each = narrow.groupBy("source").agg(F.sum("__size").alias("source_size"), F.count("*").alias("n"))
    goals = targets(each).select(F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), (F.col("rank") % len(WEIGHTS)).cast("int").alias("__kind"), F.greatest(F.ceil(F.col("n") / bucket_rows), F.lit(1)).alias("__spread"))
    goals = written(goals, "goals")
    bucket = F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") * F.col("__spread") / F.lit(1 << 32))
    dealt = lambda rows, source: rows.join(goals, rows[source].eqNullSafe(goals["__source"])).withColumn("__bucket", bucket)
    sums = dealt(narrow, "source").groupBy("__source", "__bucket").agg(F.sum("__size").alias("__words"))
    along = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sums.select(F.col("__source").alias("__s"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__words").over(along), F.lit(0)).alias("__before")), "starts")
    within = Window.partitionBy("__source", "__bucket").orderBy("__key", id_col, "__size", "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt(sized, source_col).withColumn("__upto", F.sum("__size").over(within))
    placed = placed.join(starts, placed["__source"].eqNullSafe(starts["__s"]) & (placed["__bucket"] == starts["__b"]))
    middle = F.col("__upto") + F.col("__before") - F.col("__size") / 2
    due = F.filter(F.array(*[k * F.col("__source_size") + middle for k in range(MOST_EPOCHS)]), lambda x: x < F.col("__target"))
    placed = placed.withColumn("__due", F.when(F.col("__source_size") > 0, due).otherwise(F.array(F.lit(0.0))))
    early = F.element_at(F.array(*[F.lit(a) for a, _ in TILTS]), F.col("__kind") + 1)
    positions = F.transform("__due", lambda x: position(F.when(F.col("__target") > 0, x / F.col("__target")).otherwise(0.5), early))
    return placed.withColumn("__copies", F.size("__due")).withColumn("__positions", positions).drop("__tie", "__source", "__kind", "__spread", "__bucket", "__s", "__b", "__before", "__upto", "__due")


def position(share: Column, early: Column) -> Column:
    """The time at which the integral of the weight, early + (late - early) t with early + late = 2, has reached a share of the whole.

    It solves early t + (1 - early) t^2 = share, in the form that stays exact for a level schedule.
    """
    return F.least(2 * share / (early + F.sqrt(early * early + 4 * (1 - early) * share)), F.lit(1.0))


def curriculum(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as often as the mix takes them, range-sorted by training position; a row that it doesn't take is gone."""
    rows = mixed(docs, n_words(F.col(text_col)), id_col, source_col).withColumn("__position", F.explode("__positions"))
    return rows.repartitionByRange("__position", "__key").sortWithinPartitions("__position", "__key").select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """One row for each document, range-sorted by position: doc_id, size, source_size, target, taken, position (of its first copy; null: not taken)."""
    rows = mixed(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), F.col("size"))
    rows = rows.withColumn("position", F.try_element_at("__positions", F.lit(1)))
    rows = rows.repartitionByRange(F.coalesce("position", F.lit(2.0)), F.col("__key")).sortWithinPartitions(F.coalesce("position", F.lit(2.0)), "__key")
    return rows.select("doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("size") * F.col("__copies")).alias("taken"), "position")


#: The report in SQL. The sources that stop at their cap are those of the least caps for their weight, so the level is found by sorting.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
sources AS (
  SELECT source, source_size, r % 3 AS kind, [3, 1, 2][r % 3 + 1] AS w, 2 * source_size AS cap
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM sized GROUP BY source)),
capped AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS held, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS left_w, sum(source_size) OVER () AS all_words,
         row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS nth
  FROM sources WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(l, nth) AS l FROM (SELECT CAST(1.5 * all_words - held AS DOUBLE) / CAST(left_w AS DOUBLE) AS l, w, cap, nth FROM capped) WHERE NOT l * w > cap),
goals AS (SELECT source, source_size, kind, CASE WHEN l * w > cap THEN CAST(cap AS DOUBLE) ELSE l * w END AS target FROM sources, level),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, [CAST(1.5 AS DOUBLE), 0.5, 1.0][g.kind + 1] AS early,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS DOUBLE) - CAST(s.size AS DOUBLE) / 2 AS middle
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
due AS (SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE middle END AS first, CASE WHEN source_size = 0 THEN 1 ELSE CAST(middle < target AS INT) + CAST(source_size + middle < target AS INT) END AS copies FROM placed),
shares AS (SELECT *, CASE WHEN copies = 0 THEN NULL WHEN target > 0 THEN first / target ELSE CAST(0.5 AS DOUBLE) END AS share FROM due)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
       least(2 * share / (early + sqrt(early * early + 4 * (1 - early) * share)), CASE WHEN share IS NULL THEN NULL ELSE CAST(1.0 AS DOUBLE) END) AS position
FROM shares
"""
