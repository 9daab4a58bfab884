"""The jobs in order: extract, check, fit bins, apply them, score."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow import config
from creditflow.operators import bin_tests, binning, performance, prepare, quality, report, scoring, trees, woe
from creditflow.operators.histogram import variable_histogram
from creditflow.session import stage
from creditflow.sources.tables import append_results, read_bins, read_model, read_trees, write_bin_reports, write_model, write_table, write_trees


def with_train_woe(counts: DataFrame) -> DataFrame:
    """Give bins counted per split the WOE of the train part (a join of bins with bins)."""
    train = binning.bin_statistics(counts.where(F.col("split") == "train").drop("split"))
    lookup = train.select("variable", "bin_order", "woe")
    return counts.join(lookup, ["variable", "bin_order"], "left").withColumn(
        "woe", F.coalesce("woe", F.lit(woe.NEUTRAL))
    )


def search_trace(counts: DataFrame, search=binning.search_rounds) -> DataFrame:
    """Bins of every round with statistics, tests and decision, from a histogram.

    ``search`` is the way to bins: ``binning.search_rounds`` splits, ``merging.merge_search`` merges.
    Staged: it is small (variables x rounds x bins), and settling reads it twice.
    """
    group = ["variable", "round"]
    bins = binning.bin_statistics(search(counts), group)
    return stage(bin_tests.test_bins(binning.bin_labels(bins), group), "rounds")


def search_bins(
    train: DataFrame, features: Sequence[str], target: str = config.TARGET, stop_at_one: bool = True, search=binning.search_rounds
) -> DataFrame:
    """Search all rounds for all variables and keep each variable's settling round.

    The data is read for the histogram only, each column once; every later step works on bins. Stage what is not read from a file.
    """
    tested = search_trace(variable_histogram(train, features, target), search)
    return bin_tests.final_round(tested, len(config.SEARCH_ROUNDS), stop_at_one)


def extract(base: DataFrame, dictionary: DataFrame, data: config.Dataset) -> DataFrame:
    """Project, filter to the sample and impute."""
    sample = prepare.sample_window(
        prepare.project_base(base), data.start, data.end, data.recency_column, data.max_recency
    )
    return prepare.impute(sample, prepare.column_kinds(sample, dictionary))


def check(imputed: DataFrame, run_id: str, path: str, suite, fail_on_error: bool = False) -> DataFrame:
    """Run the data-quality suite and record it; a failure stops the run only if asked to, and after the record."""
    results = append_results(quality.run_suite(imputed, suite, run_id), path)
    if fail_on_error:
        quality.require_success(results)
    return results


def score_candidates(imputed: DataFrame, dictionary: DataFrame, data: config.Dataset, path: str) -> tuple[DataFrame, list[str]]:
    """Categories replaced by their train scores, which are written to ``path``, and all candidate variables."""
    kinds = prepare.column_kinds(imputed, dictionary)
    numbers = prepare.candidate_features(imputed, kinds, exclude=data.exclude)
    categories = prepare.candidate_features(imputed, kinds, "Categorical", data.exclude)
    if not categories:
        return imputed, numbers
    train, _ = prepare.train_and_oot(imputed, data.split)
    binning.category_scores(train, categories, data.target).write.mode("overwrite").parquet(path)
    scores = imputed.sparkSession.read.parquet(path)
    return stage(binning.score_categories(imputed, categories, scores), "scored"), [*numbers, *categories]


def fit_report(imputed: DataFrame, dictionary: DataFrame, features: Sequence[str], data: config.Dataset):
    """Bins settled on the train part, and their report with train and OOT Gini.

    Train and out-of-time rows share one histogram pass. Bins start at grid
    numbers, so the out-of-time buckets fall into them exactly. Only train rows
    decide how fine the buckets are, so out-of-time rows never change the bins.
    """
    marked = prepare.with_split(imputed, data.split).where(F.col("split").isNotNull())
    counts = variable_histogram(marked, features, data.target, by=["split"], judged_on="split = 'train'")
    tested = search_trace(counts.where(F.col("split") == "train"))
    found = bin_tests.final_round(tested, len(config.SEARCH_ROUNDS))
    edges = F.broadcast(found.select("variable", "bin_order", "is_special", "lo", "hi"))
    inside = (F.col("h.special") & F.col("e.is_special")) | (
        ~F.col("h.special") & (F.col("h.start") >= F.col("e.lo")) & (F.col("h.start") < F.col("e.hi"))
    )
    per_bin = (
        counts.alias("h")
        .join(edges.alias("e"), (F.col("h.variable") == F.col("e.variable")) & inside)
        .groupBy("h.split", "h.variable", "e.bin_order")
        .agg(F.sum("h.n").alias("n"), F.sum("h.bad").alias("bad"))
    )
    gini = performance.gini_train_oot(with_train_woe(per_bin))
    return found, report.bin_report(found, gini, dictionary)


def run(
    base: DataFrame,
    dictionary: DataFrame,
    data: config.Dataset,
    output: str,
    models: DataFrame | None = None,
    tree_model: DataFrame | PipelineModel | None = None,
    fail_on_error: bool = False,
    suite=None,
    run_id: str | None = None,
    tree_settings: trees.Settings | None = None,
) -> dict[str, str]:
    """All stages for one product. Every stage is written once and read by the next.

    ``run_id`` names the run in the data-quality history; a run that is not named gets an id of its own.
    Trees score the loans if a tree table is given, or if ``tree_settings`` says how to fit one to the train part's
    numbers; the table is saved under ``trees``. A fitted pipeline scores too, and is not saved.
    """
    spark = base.sparkSession
    stages = ("base", "quality", "categories", "bins", "bin_reports", "report", "woe", "model", "scores", "tree_scores")
    paths = {n: f"{output}/{data.name}/{n}" for n in stages}

    write_table(extract(base, dictionary, data), paths["base"])
    imputed = spark.read.parquet(paths["base"])

    suite = data.suite if suite is None else suite
    check(imputed, run_id or uuid.uuid4().hex, paths["quality"], suite, fail_on_error)

    scored, candidates = score_candidates(imputed, dictionary, data, paths["categories"])
    bins, full_report = fit_report(scored, dictionary, candidates, data)
    bins.write.mode("overwrite").parquet(paths["bins"])
    full_report.write.mode("overwrite").parquet(paths["report"])
    write_bin_reports(spark.read.parquet(paths["bins"]), paths["bin_reports"])

    accepted = spark.read.parquet(paths["bins"]).where(F.col("status") == "accepted")
    table = woe.woe_table(accepted)
    write_table(woe.woe_wide(scored, table, keep=("LOAN_ID", "USER_ID", "DISBURSED_DATE", data.target)), paths["woe"])
    transformed = spark.read.parquet(paths["woe"])

    if models is None and table:
        train, _ = prepare.train_and_oot(transformed, data.split)
        models = scoring.fit_scorecard(train, [f"{v}_woe".upper() for v in table])
    if models is not None:
        write_model(models, paths["model"])
        write_table(scoring.score_scorecard(transformed, read_model(spark, paths["model"])), paths["scores"])
    if tree_settings is not None and tree_model is None:
        numbers = prepare.candidate_features(imputed, prepare.column_kinds(imputed, dictionary), exclude=data.exclude)
        train, _ = prepare.train_and_oot(imputed, data.split)
        tree_model = trees.fit_trees(train, numbers, data.target, tree_settings)
    if isinstance(tree_model, PipelineModel):
        write_table(scoring.score_trees(imputed, tree_model), paths["tree_scores"])
    elif tree_model is not None:
        paths["trees"] = f"{output}/{data.name}/trees"
        write_trees(tree_model, paths["trees"])
        write_table(trees.score_trees(imputed, read_trees(spark, paths["trees"])), paths["tree_scores"])
    return paths


def apply_saved(
    base: DataFrame,
    dictionary: DataFrame,
    data: config.Dataset,
    saved: dict[str, str],
    output: str,
    model_no: int = config.MODEL_NO,
    run_id: str | None = None,
    suite=None,
    fail_on_error: bool = False,
) -> dict[str, str]:
    """Check, transform and score a later batch with the bins and the models of an earlier run, without fitting.

    ``saved`` has the paths that ``run`` returned: its ``bins``, its ``model``, its ``categories`` if any accepted bin
    is of a category, and its ``trees`` if there are any. The batch's data quality is recorded like that of a run.
    """
    spark = base.sparkSession
    paths = {n: f"{output}/{data.name}/{n}" for n in ("base", "quality", "woe", "scores", "tree_scores")}
    write_table(extract(base, dictionary, data), paths["base"])
    imputed = spark.read.parquet(paths["base"])
    check(imputed, run_id or uuid.uuid4().hex, paths["quality"], data.suite if suite is None else suite, fail_on_error)
    table = woe.woe_table(read_bins(spark, saved["bins"]).where(F.col("status") == "accepted"))
    kinds = prepare.column_kinds(imputed, dictionary)
    categories = [c for c in prepare.candidate_features(imputed, kinds, "Categorical", data.exclude) if c in table]
    scored = imputed
    if categories:
        scored = binning.score_categories(imputed, categories, spark.read.parquet(saved["categories"]))
    write_table(woe.woe_wide(scored, table, keep=("LOAN_ID", "USER_ID", "DISBURSED_DATE")), paths["woe"])
    transformed = spark.read.parquet(paths["woe"])
    write_table(scoring.score_scorecard(transformed, read_model(spark, saved["model"]), model_no), paths["scores"])
    if "trees" in saved:
        write_table(trees.score_trees(imputed, read_trees(spark, saved["trees"])), paths["tree_scores"])
    return paths
