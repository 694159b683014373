"""Command line: runs the stages of a group over stored posts, writes an annotation sample, measures raters, or trains a model.

    python -m corvane.cli --resource label_emotion --group age --years 2010-2012 --posts IN --out OUT --terms FOLDER
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.text import unique_keywords
from corvane.operators import audit, evaluation, features, labels, location, sampling, training
from corvane.plans.pipeline import Plan
from corvane.session import session
from corvane.sources import tables
from corvane.sources.files import job_slice, job_tag
from corvane.sources.posts import normalised, raw_posts
from corvane.sources.tables import GROUPS, load_sides

STAGES = ("filter_keywords", "filter_language", "filter_relevance", "filter_keywords_adv", "label_moralization", "label_sentiment", "label_generalization", "label_emotion", "label_location")
OTHERS = ("filter_sample", "metrics_interrater", "train_relevance", "train_location")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("-r", "--resource", required=True, choices=STAGES + OTHERS, help="the last stage to run, or the sample, measure or training")
    parser.add_argument("-g", "--group", choices=sorted(GROUPS))
    parser.add_argument("-y", "--years", help="one year or first-last; needed by filters and labels")
    parser.add_argument("-t", "--type", default="comments", choices=("comments", "submissions"))
    parser.add_argument("--posts", help="stored posts (Parquet, with year and month), or raw dumps with --raw")
    parser.add_argument("--raw", action="store_true")
    parser.add_argument("--large-windows", action="store_true", help="raw dumps have zstd frames of windows over 128 MiB; a file is then one task")
    parser.add_argument("--trained", action="append", default=[], metavar="NAME=FOLDER", help="a classifier that train_relevance wrote, in place of the scorer NAME (relevance, moralization, emotion_1, ...); may be repeated")
    parser.add_argument("--terms", help="folder of term and pattern lists")
    parser.add_argument("--ratings", help="folder of raters' files")
    parser.add_argument("--features", help="table (author, feature, cnt) of training users")
    parser.add_argument("--homes", help="table (author, location, split), split train, valid or test")
    parser.add_argument("--model", help="folder of a trained location model")
    parser.add_argument("--out", required=True)
    parser.add_argument("-c", "--sample", type=int, help="rows of an annotation sample")
    parser.add_argument("-S", "--sample-target", dest="target", choices=STAGES, help="the stage whose output is sampled; names the files")
    parser.add_argument("-b", "--batchsize", type=int, help="rows of an Arrow batch that Python scorers are given")
    parser.add_argument("-j", "--num-jobs", dest="numjob", type=int, help="cap on executors")
    parser.add_argument("--files-per-job", type=int, default=1, help="months of a job's slice")
    parser.add_argument("--array", type=int, help="number of this job's slice of months; without it all months are processed")
    parser.add_argument("--maxitems", "--max-items", "--max_items_per_author", dest="maxitems", type=int, default=25, help="posts of an author that locate it")
    parser.add_argument("--maxfiles", "--max-files", "--max_files_to_scan", dest="maxfiles", type=int, default=60, help="months round the first that are scanned for them")
    parser.add_argument("--maxradius", "--max-radius", "--max_radius", dest="maxradius", type=int, default=30)
    parser.add_argument("--max-locations", type=int, help="likeliest locations that train_location takes")
    parser.add_argument("-s", "--slurm", action="store_true", help="not needed: spark-submit chooses the cluster")
    parser.add_argument("--append", action="store_true", help="add to the months that are there, as on resuming")
    out = parser.parse_args(argv)
    need = {"filter_sample": ["group", "years", "posts", "sample"], "metrics_interrater": ["group", "ratings"], "train_relevance": ["group", "ratings"], "train_location": ["features", "homes"]}
    for name in need.get(out.resource, ["group", "years", "posts", "terms", *(["model"] if out.resource == "label_location" else [])]):
        if getattr(out, name) is None:
            parser.error(f"{out.resource} needs --{name}")
    if out.slurm:
        parser.error("submit with spark-submit --master instead of --slurm")
    for name in ("batchsize", "sample", "numjob", "files_per_job", "maxitems", "maxfiles"):
        if getattr(out, name) is not None and getattr(out, name) <= 0:
            parser.error(f"{name} must be positive")
    for given in out.trained:
        if given.partition("=")[0] not in labels.SCORERS or not given.partition("=")[2]:
            parser.error(f"--trained {given}: give NAME=FOLDER, NAME one of {', '.join(sorted(labels.SCORERS))}")
    try:
        out.years = audit.years_of(out.years) if out.years else None
    except ValueError as error:
        parser.error(str(error))
    return out


def posts_of(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.raw:
        posts = normalised(raw_posts(spark, args.posts.split(","), args.type, args.large_windows, f"{args.out}_quarantine"), args.type)
        posts = posts.withColumns({"year": F.year(F.to_timestamp("time")), "month": F.month(F.to_timestamp("time"))})
    else:
        posts = spark.read.parquet(args.posts)
    months = [(y, m) for y in args.years for m in range(1, 13)]
    if args.array is not None:
        months = job_slice(months, args.files_per_job, args.array)
    return posts.where(F.struct(F.col("year").cast("int").alias("y"), F.col("month").cast("int").alias("m")).isin([F.struct(F.lit(y).alias("y"), F.lit(m).alias("m")) for y, m in months]) & F.col("year").isin(sorted({y for y, _ in months})))


def sample(spark: SparkSession, args: argparse.Namespace) -> None:
    sides = GROUPS[args.group]
    posts = posts_of(spark, args)
    counted = posts.withColumn("keywords", unique_keywords(F.col("matched_patterns"), sides)).withColumn("n_keywords", F.size("keywords"))
    kept = sampling.stratified_sample(sampling.first_by_id(counted, ["year", "id"], ["month", "id"]), "year", "n_keywords", "id", sampling.per_stratum(args.sample, len(args.years)))
    rows = sampling.numbered(kept, ["year", "sample_type", "id"]).withColumn("file", F.format_string("%s_%d-%02d", F.lit("RC" if args.type == "comments" else "RS"), "year", "month"))
    sampling.write_annotators(rows, f"{args.out}/{args.target or 'sample'}_n{args.sample}_{args.years[0]}_to_{args.years[-1]}")


def interrater(spark: SparkSession, args: argparse.Namespace) -> None:
    one, two = (tables.read_ratings(spark, f"{args.ratings}/relevance_sample_{args.group}_{k}.csv") for k in (0, 1))
    found = evaluation.agreement(one, two)
    row = found.first()
    out = found.withColumns({"p_value": F.lit(evaluation.pearson_p(row["pearson"] if row["pearson"] is not None else float("nan"), row["n"])), "unmatched": F.lit(evaluation.unmatched(one, two).count())})
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(args.out)


def train_relevance(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = sampling.exact_split(tables.main_annotations(spark, args.ratings, args.group), "doc_id")
    tables.write_split(rows, f"{args.out}/splits")
    model = training.fit_classifier(tables.read_split(spark, f"{args.out}/splits", "train"))
    model.write().overwrite().save(f"{args.out}/model")
    test = training.classify(model, tables.read_split(spark, f"{args.out}/splits", "test"), args.group)
    evaluation.write_evaluation(test, "label", "predicted", f"{args.out}/test", f"{args.out}/metrics", group=args.group)


def train_location(spark: SparkSession, args: argparse.Namespace) -> None:
    own, homes = spark.read.parquet(args.features), spark.read.parquet(args.homes)
    of = lambda name: homes.where(F.col("split") == name).select("author", "location")
    best = training.grid_search(spark, own, of("train"), of("valid").withColumnRenamed("location", "label"), f"{args.out}/grid", most_locations=args.max_locations)
    tables.save_model(f"{args.out}/model", **training.fit_location(own, of("train"), best, most_locations=args.max_locations))
    missing = features.unlabelled(own, homes).first()
    training.log_metrics(spark, f"{args.out}/metrics", "train_location", {"authors": missing["authors"], "unlabelled": missing["unlabelled"]})


def stage(spark: SparkSession, args: argparse.Namespace) -> None:
    sides = GROUPS[args.group]
    posts = posts_of(spark, args)
    patterns = [p for _, listed in load_sides(spark, args.terms, args.group, sides, advanced=True) for p in listed]
    model = tables.load_model(spark, args.model) if args.model else None
    for given in args.trained:
        name, _, folder = given.partition("=")
        labels.register_model(name, PipelineModel.load(folder))
    # A job of one month looks for its authors' posts round that month; one of more months takes them in the order of time.
    one = args.array is not None and args.files_per_job == 1
    months = location.month_spiral(args.years[0] + args.array // 12, args.array % 12 + 1, args.maxradius, args.maxfiles) if one else None
    plan = Plan(args.group, load_sides(spark, args.terms, args.group, sides), patterns, location_model=model, most_posts=args.maxitems, months=months)
    plan.run_and_write(posts, args.resource, args.out, f"{args.out}_metrics", args.append)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    conf = {"spark.dynamicAllocation.maxExecutors": str(args.numjob)} if args.numjob else {}
    name = job_tag(args.resource, args.group or "all", args.years or [0])
    spark = session(name, **conf)
    if args.batchsize:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(args.batchsize))
    spark.sparkContext.setJobDescription(f"{name}{'' if args.array is None else f' slice {args.array}'}")
    {"filter_sample": sample, "metrics_interrater": interrater, "train_relevance": train_relevance, "train_location": train_location}.get(args.resource, stage)(spark, args)


if __name__ == "__main__":
    main()
