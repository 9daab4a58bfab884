"""The registered queries: each runs one part of the engine over the whole tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditflow import config
from creditflow.functions.expressions import rounded
from creditflow.operators import bin_tests, binning, features, merging, performance, prepare, quality, report, scoring, woe
from creditflow.operators.histogram import variable_histogram
from creditflow.plans import jobs
from creditflow.session import new_path, stage
from creditflow.sources import datasets
from creditflow.sources.tables import append_results, latest_batch, read_bins, read_history, read_model, write_model

# Cut points for the queries that check the statistics at known bins.
FIXED_CUTS = {
    "DAYS_SINCE_LAST_TXN": (30, 90, 180, 365),
    "DAYS_SINCE_FIRST_TXN": (360, 720, 1080, 1440),
    "TOTAL_TRXNS": (2, 4, 6, 8),
    "TOTAL_TXN_MONTHS": (2, 5),
    "AVG_TRXNS_CNT_L6MONTH_MONTHLY": (0.1, 0.3),
    "AVG_TRXNS_CNT_L12MONTH_MONTHLY": (0.05, 0.15, 0.25),
    "TOTAL_TXN_AMNT": (250000, 500000, 1000000, 2000000),
    "LOAN_AMOUNT": (100000, 200000, 300000, 400000),
}
SECOND_CUTS = {
    "DAYS_SINCE_FIRST_TXN": (720,),
    "TOTAL_TRXNS": (3, 6),
    "TOTAL_TXN_AMNT": (500000, 1000000),
    "LOAN_AMOUNT": (250000,),
}
SCORECARD_CONSTANT = -0.5
SCORECARD = {
    "DAYS_SINCE_LAST_TXN_woe": 0.9,
    "TOTAL_TRXNS_woe": 0.4,
    "AVG_TRXNS_CNT_L12MONTH_MONTHLY_woe": 0.6,
    "TOTAL_TXN_AMNT_woe": -0.2,
}
ACTIVITY_CUTS = {
    "FACTS_L7DAY": (10, 14, 18),
    "TOTAL_FACTS": (15, 30, 45),
    "TOTAL_VALUE": (250, 500, 1000),
    "DAYS_SINCE_LAST_FACT": (2,),
    "RATIO_FACTS_3_BY_7": (0.3, 0.5),
}


def round_doubles(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Doubles at 6 decimals, so that engines can be compared."""
    return df.select(*[rounded(c).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


def _base(spark: SparkSession, sf: str, families: Sequence[str] = ("core",), period: tuple[str, str] | None = None) -> DataFrame:
    return prepare.project_base(datasets.transaction_base(spark, sf, families, period))


def _imputed(spark: SparkSession, sf: str, families: Sequence[str] = ("core",)) -> DataFrame:
    base = _base(spark, sf, families)
    return prepare.impute(base, _kinds(base.columns, datasets.transaction_dictionary_rows()))


def _kinds(columns: Sequence[str], dictionary: list[tuple]) -> dict[str, str]:
    return prepare.kinds_by_name(columns, {row[1]: row[4] for row in dictionary})


# --- extract, impute, split -----------------------------------------------------


def base_scan_project(spark, sf):
    return round_doubles(_base(spark, sf, tuple(features.FAMILIES)))


def sample_window_filter(spark, sf):
    data = config.TRANSACTIONS
    sample = prepare.sample_window(_base(spark, sf, period=(data.start, data.end)), data.start, data.end, data.recency_column, data.max_recency)
    return sample.select("LOAN_ID", "USER_ID", "DISBURSED_DATE", "BAD_FLAG", "DAYS_SINCE_LAST_TXN")


JOB_COLUMNS = ("DAYS_SINCE_LAST_TXN", "TOTAL_TRXNS", "TOTAL_TXN_AMNT", "AVG_TRAN_SIZE_3_MNTH_MONTHLY")


def job_extract(spark, sf):
    """The extract job: sample window and recency, then imputation."""
    data = config.TRANSACTIONS
    base = datasets.transaction_base(spark, sf, ("core",), (data.start, data.end))
    sample = jobs.extract(base, datasets.transaction_dictionary(spark), config.TRANSACTIONS)
    return round_doubles(sample.select("LOAN_ID", "DISBURSED_DATE", "BAD_FLAG", "SEGMENT", *JOB_COLUMNS))


def _job_base(spark, sf) -> DataFrame:
    data = config.TRANSACTIONS
    return datasets.transaction_base(spark, sf, tuple(features.FAMILIES), (data.start, data.end))


def _job_sample(spark, sf) -> DataFrame:
    return jobs.extract(_job_base(spark, sf), datasets.transaction_dictionary(spark), config.TRANSACTIONS)


def job_extract_all(spark, sf):
    """The extract job with the features of all families."""
    ids = ("LOAN_ID", "DISBURSED_DATE", "BAD_FLAG", "SEGMENT", "LOAN_AMOUNT")
    return round_doubles(_job_sample(spark, sf).select(*ids, *features.feature_names()))


def dictionary_kind(spark, sf):
    """Kind, expected trend and filled rows of every column of the base."""
    base = _base(spark, sf)
    filled = base.agg(*[F.count(c).alias(c) for c in base.columns]).unpivot(
        [], base.columns, "variable", "filled"
    )
    words = datasets.transaction_dictionary(spark).select("variables", "Type", "Trend_Business")
    return filled.join(words, F.col("variable") == F.col("variables"), "left").select(
        "variable", F.coalesce("Type", F.lit("Others")).alias("kind"), "Trend_Business", "filled"
    )


def impute_numeric(spark, sf):
    columns = [
        "DAYS_SINCE_FIRST_TXN", "DAYS_SINCE_LAST_TXN", "ACTIVATION_AGE", "TOTAL_TRXNS_CNT_3_BY_6",
        "RATIO_AMNT_L1_L3_MNTH_DAILY", "AVG_TRAN_SIZE_3_MNTH_MONTHLY", "TOTAL_TXN_AMNT",
    ]
    return round_doubles(_imputed(spark, sf).select("LOAN_ID", "BAD_FLAG", *columns))


def impute_categorical(spark, sf):
    return _imputed(spark, sf).select(*config.ID_COLUMNS, "BAD_FLAG", "SEGMENT")


def train_oot_split(spark, sf):
    marked = prepare.with_split(_base(spark, sf), config.TRANSACTIONS.split)
    return marked.groupBy("split").agg(
        F.count("*").alias("loans"),
        F.sum("BAD_FLAG").alias("bad"),
        F.min("DISBURSED_DATE").alias("first_day"),
        F.max("DISBURSED_DATE").alias("last_day"),
    )


# --- bins at fixed cut points -----------------------------------------------------


def _bins(spark, sf, cuts=FIXED_CUTS) -> DataFrame:
    edges = binning.bins_from_cuts(spark, cuts)
    counts = binning.count_bins(_imputed(spark, sf), cuts)
    return binning.bin_labels(binning.bin_statistics(binning.with_edges(counts, edges)))


def bin_counts_fixed(spark, sf):
    columns = ["variable", "bin_order", "bin", "count", "count_distr", "good", "bad", "badprob"]
    return round_doubles(_bins(spark, sf).select(*columns))


def woe_iv_fixed(spark, sf):
    bins = binning.bin_labels(_bins(spark, sf))
    columns = [
        "variable", "bin_order", "bin", "breaks", "is_special", "count", "count_distr", "good", "bad",
        "badprob", "woe", "bin_iv", "total_iv",
    ]
    return round_doubles(bins.select(*columns))


def monotonic_check(spark, sf):
    checked = bin_tests.monotonic_check(_bins(spark, sf))
    columns = [
        "variable", "bin_order", "counter", "badprob", "badprob_lag", "missing_bin", "missing_bin_lag",
        "test", "Inc_cnt", "Dec_cnt", "Na_cnt", "break_missing", "num_bin", "mtest",
    ]
    return round_doubles(checked.select(*columns))


def iv_share_test(spark, sf):
    columns = ["variable", "bin_order", "bin_iv", "Max_iv", "Prop_iv", "IV_test", "Max_IV_test"]
    return round_doubles(bin_tests.iv_share_test(_bins(spark, sf)).select(*columns))


def bin_decision(spark, sf):
    tested = bin_tests.test_bins(_bins(spark, sf))
    columns = ["variable", "Max_iv", "mtest", "num_bin", "Max_IV_test", "Accept_flag", "Issue_bin", "status"]
    return round_doubles(tested.select(*columns).distinct())


def decision_counts(spark, sf):
    return bin_tests.variable_counts(bin_tests.test_bins(_bins(spark, sf)))


def round_union(spark, sf):
    """Two rounds: what the first leaves unresolved is binned again."""
    imputed = stage(_imputed(spark, sf).select("BAD_FLAG", *FIXED_CUTS), "base")
    group = ["round", "variable"]

    def binned(cuts, number):
        counts = binning.with_edges(binning.count_bins(imputed, cuts), binning.bins_from_cuts(spark, cuts))
        return counts.withColumn("round", F.lit(number))

    both = binned(FIXED_CUTS, 1).unionByName(binned(SECOND_CUTS, 2))
    tested = bin_tests.test_bins(binning.bin_statistics(both, group), group)
    settled = bin_tests.final_round(tested, 2, stop_at_one=False)
    return round_doubles(
        settled.select("round", "variable", "bin_order", "count", "bad", "badprob", "woe", "total_iv", "status")
    )


# --- weight of evidence, performance, report --------------------------------------


def _fitted(spark, sf, cuts=FIXED_CUTS) -> tuple[DataFrame, dict]:
    """The imputed base, staged because fitting and applying both read it, and its WOE table."""
    imputed = stage(_imputed(spark, sf).select(*config.ID_COLUMNS, "BAD_FLAG", *cuts), "base")
    counts = binning.with_edges(binning.count_bins(imputed, cuts), binning.bins_from_cuts(spark, cuts))
    return imputed, woe.woe_table(binning.bin_statistics(counts))


def woe_apply_long(spark, sf):
    return round_doubles(woe.woe_long(*_fitted(spark, sf)))


def woe_apply_wide(spark, sf):
    return round_doubles(woe.woe_wide(*_fitted(spark, sf)))


def apply_saved_bins(spark, sf):
    """Bins are fitted and saved; the transformation reads them back and fits nothing."""
    imputed = stage(_imputed(spark, sf).select(*config.ID_COLUMNS, "BAD_FLAG", *FIXED_CUTS), "base")
    counts = binning.with_edges(binning.count_bins(imputed, FIXED_CUTS), binning.bins_from_cuts(spark, FIXED_CUTS))
    path = new_path(spark, "saved-bins")
    binning.bin_statistics(counts).write.parquet(path)
    return round_doubles(woe.woe_wide(imputed, woe.woe_table(read_bins(spark, path))))


def _split_counts(spark, sf) -> DataFrame:
    """Counts per (split, variable, bin) with the WOE fitted on the train part."""
    marked = prepare.with_split(_imputed(spark, sf), config.TRANSACTIONS.split)
    counts = stage(binning.count_bins(marked, FIXED_CUTS, by=["split"]), "counts")
    return jobs.with_train_woe(counts)


def univariate_auc(spark, sf):
    scored = performance.rank_auc(_split_counts(spark, sf), ["split", "variable"])
    return round_doubles(scored.select("split", "variable", "auc"))


def gini_train_oot(spark, sf):
    return round_doubles(performance.gini_train_oot(_split_counts(spark, sf)))


def bin_trend_report(spark, sf):
    counts = _split_counts(spark, sf)
    edges = binning.bins_from_cuts(spark, FIXED_CUTS)
    train = binning.with_edges(counts.where("split = 'train'").drop("woe", "split"), edges)
    tested = bin_tests.test_bins(binning.bin_labels(binning.bin_statistics(train)))
    words = datasets.transaction_dictionary(spark)
    return round_doubles(report.bin_report(tested, performance.gini_train_oot(counts), words))


def _risk(spark, sf) -> DataFrame:
    """Scorecard scores at six decimals with the outcome."""
    return scorecard_score(spark, sf).select("BAD_FLAG", "p_bad")


def roc_points(spark, sf):
    """The ROC curve of the scorecard's score, without points on a straight line."""
    return round_doubles(performance.roc_points(_risk(spark, sf), "p_bad"))


def roc_area(spark, sf):
    return round_doubles(performance.roc_area(_risk(spark, sf), "p_bad"))


# --- models -----------------------------------------------------------------------


def scorecard_score(spark, sf):
    imputed, table = _fitted(spark, sf, {v[:-4]: FIXED_CUTS[v[:-4]] for v in SCORECARD})
    transformed = woe.woe_wide(imputed, table)
    models = scoring.model_table(spark, config.MODEL_NO, SCORECARD_CONSTANT, SCORECARD)
    frame = scoring.model_frame(imputed, transformed, list(SCORECARD))
    keep = [*config.ID_COLUMNS, "BAD_FLAG", *[v[:-4] for v in SCORECARD]]
    return round_doubles(scoring.score_scorecard(frame, models, keep=keep))


def score_saved_model(spark, sf):
    """Two models are saved in one table; scoring reads it back and picks one by its number."""
    imputed, table = _fitted(spark, sf, {v[:-4]: FIXED_CUTS[v[:-4]] for v in SCORECARD})
    other = scoring.model_table(spark, config.MODEL_NO + 1, 1.0, dict.fromkeys(SCORECARD, -1.0))
    path = new_path(spark, "saved-model")
    write_model(scoring.model_table(spark, config.MODEL_NO, SCORECARD_CONSTANT, SCORECARD).unionByName(other), path)
    frame = scoring.model_frame(imputed, woe.woe_wide(imputed, table), list(SCORECARD))
    keep = [*config.ID_COLUMNS, "BAD_FLAG", *[v[:-4] for v in SCORECARD]]
    return round_doubles(scoring.score_scorecard(frame, read_model(spark, path), keep=keep))


def scorecard_fit(spark, sf):
    """Fit on the train part's WOE columns of all accepted variables; the result is the coefficient table."""
    scored, found, _ = _job_fit(spark, sf)
    table = woe.woe_table(found.where("status = 'accepted'"))
    train, _ = prepare.train_and_oot(scored, config.TRANSACTIONS.split)
    return scoring.fit_scorecard(stage(woe.woe_wide(train, table), "woe"), [f"{v}_woe" for v in table])


def gbt_score(spark, sf):
    imputed = _imputed(spark, sf, tuple(features.FAMILIES))
    columns = features.tree_model_features()
    data = stage(prepare.with_split(imputed, config.TRANSACTIONS.split).select("LOAN_ID", "BAD_FLAG", "split", *columns), "base")
    model = scoring.fit_trees(data.where("split = 'train'"), columns)
    return scoring.score_trees(data, model)


def pca_components(spark, sf):
    imputed = _imputed(spark, sf, tuple(features.FAMILIES)).select(*features.feature_names())
    variance = scoring.explained_variance(imputed, features.feature_names())
    return scoring.components_for_share(variance)


# --- binning search ----------------------------------------------------------------


ONE_ROUND = ((5, 0.05),)


def variable_histogram_grid(spark, sf):
    counts = variable_histogram(_imputed(spark, sf), list(FIXED_CUTS), max_share=1.0)
    return round_doubles(counts.select("variable", "special", "start", "n", "bad", "low", "high"))


def woebin_fit(spark, sf):
    """One round: at most 5 ordinary bins of at least 5 % of the rows each."""
    return _one_round(spark, sf, binning.search_rounds)


def woebin_merge(spark, sf):
    """The same round from the bottom up: buckets merged by chi-square."""
    return _one_round(spark, sf, merging.merge_search)


def _one_round(spark, sf, search) -> DataFrame:
    counts = variable_histogram(_imputed(spark, sf), list(FIXED_CUTS))
    bins = search(counts, rounds=ONE_ROUND).drop("round")
    return round_doubles(
        binning.bin_statistics(bins).select(
            "variable", "bin_order", "is_special", "lo", "hi", "count", "count_distr", "good", "bad",
            "badprob", "woe", "bin_iv", "total_iv",
        ),
        keep=("lo", "hi"),
    )


def _search_trace(spark, sf) -> DataFrame:
    """All rounds over all numeric features of the transaction base's train part."""
    data = _imputed(spark, sf, tuple(features.FAMILIES))
    names = [*features.feature_names(), "LOAN_AMOUNT"]
    train = prepare.with_split(data, config.TRANSACTIONS.split).where("split = 'train'").select("BAD_FLAG", *names)
    return jobs.search_trace(variable_histogram(stage(train, "train"), names))


def woebin_search(spark, sf):
    """The bins that the search settles on, per variable."""
    found = bin_tests.final_round(_search_trace(spark, sf), len(config.SEARCH_ROUNDS))
    return round_doubles(
        found.select("variable", "round", "status", "bin_order", "lo", "hi", "count", "good", "bad", "woe", "total_iv"),
        keep=("lo", "hi"),
    )


def search_round_counts(spark, sf):
    """Accepted, rejected and open variables in every round that ran."""
    return bin_tests.round_counts(_search_trace(spark, sf), len(config.SEARCH_ROUNDS))


def category_bins(spark, sf):
    """Categories binned by their bad rate: each category's bin and weight of evidence."""
    imputed = stage(_imputed(spark, sf).select("BAD_FLAG", "SEGMENT"), "base")
    scores = binning.category_scores(imputed, ["SEGMENT"])
    counts = variable_histogram(binning.score_categories(imputed, ["SEGMENT"], scores), ["SEGMENT"])
    bins = binning.bin_statistics(binning.search_rounds(counts, rounds=((5, 0.05),)).drop("round"))
    numbered = woe.woe_table(bins)["SEGMENT"]
    return round_doubles(
        scores.select("variable", "category", "score").withColumn(
            "bin_order", binning.bin_order_expression("score", numbered["cuts"])
        ).withColumn("woe", woe.woe_expression("score", numbered))
    )


# --- the fit and apply jobs ----------------------------------------------------------


def _job_fit(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The extracted sample with scored categories, the bins of all candidate variables, and their report."""
    words = datasets.transaction_dictionary(spark)
    sample = stage(_job_sample(spark, sf), "base")
    scored, candidates = jobs.score_candidates(sample, words, config.TRANSACTIONS, new_path(spark, "categories"))
    return scored, *jobs.fit_report(scored, words, candidates, config.TRANSACTIONS)


def job_bins(spark, sf):
    """The bins that the job settles on, for all numbers and categories."""
    _, found, _ = _job_fit(spark, sf)
    return round_doubles(
        found.select("variable", "round", "status", "bin_order", "lo", "hi", "count", "good", "bad", "woe", "total_iv"),
        keep=("lo", "hi"),
    )


def job_report(spark, sf):
    """The report of those bins, with train and out-of-time Gini."""
    _, _, full = _job_fit(spark, sf)
    return round_doubles(full)


def job_apply_saved(spark, sf):
    """A whole run, then its saved bins, categories and model applied without fitting: (loan, accepted variable, woe)."""
    words = datasets.transaction_dictionary(spark)
    base = stage(_job_base(spark, sf), "base")
    saved = jobs.run(base, words, config.TRANSACTIONS, new_path(spark, "run"))
    applied = spark.read.parquet(jobs.apply_saved(base, words, config.TRANSACTIONS, saved, new_path(spark, "later"))["woe"])
    columns = [c for c in applied.columns if c.endswith("_WOE")]
    return round_doubles(applied.select("LOAN_ID", *columns).unpivot(["LOAN_ID"], columns, "variable", "woe"))


# --- data quality -------------------------------------------------------------------


def _quality_base(spark, sf):
    return _imputed(spark, sf, ("core", "counterparty"))


def dq_min_between(spark, sf):
    checks = [
        quality.Expectation(quality.MIN_BETWEEN, "TOTAL_CUSTOMERS", 1, 1),
        quality.Expectation(quality.MIN_BETWEEN, "TOTAL_TRXNS", 0, None),
        quality.Expectation(quality.MIN_BETWEEN, "DAYS_SINCE_LAST_TXN", 0, None),
    ]
    return quality.run_suite(_quality_base(spark, sf), checks, "min")


def dq_unique_between(spark, sf):
    checks = [
        quality.Expectation(quality.UNIQUE_BETWEEN, "MONTHS_SINCE_LAST_TXN"),
        quality.Expectation(quality.UNIQUE_BETWEEN, "BAD_FLAG", 2, 2),
    ]
    return quality.run_suite(_imputed(spark, sf), checks, "unique")


def dq_suite(spark, sf):
    return quality.with_run_success(quality.run_suite(_quality_base(spark, sf), quality.TEST_SUITE, "suite"))


def dq_history(spark, sf):
    """Two recorded runs, one of which fails, with the outcome of each run."""
    imputed = stage(_imputed(spark, sf).select("TOTAL_TRXNS", "BAD_FLAG"), "base")
    path = new_path(spark, "quality")
    flags = quality.Expectation(quality.UNIQUE_BETWEEN, "BAD_FLAG", 2, 2)
    good = [quality.Expectation(quality.MIN_BETWEEN, "TOTAL_TRXNS", -99999, None), flags]
    bad = [quality.Expectation(quality.MIN_BETWEEN, "TOTAL_TRXNS", 1000000, None), flags]
    schema = append_results(quality.run_suite(imputed, good, "first"), path).schema
    append_results(quality.run_suite(imputed, bad, "second"), path)
    return quality.with_run_success(read_history(spark, path, schema))


def dq_latest_batch(spark, sf):
    monthly = _imputed(spark, sf).withColumn("batch", F.date_format("DISBURSED_DATE", "yyyy-MM"))
    checks = [
        quality.Expectation(quality.MIN_BETWEEN, "TOTAL_TRXNS", 0, None),
        quality.Expectation(quality.UNIQUE_BETWEEN, "LOAN_ID", 1, None),
    ]
    return quality.run_suite(latest_batch(monthly, "batch"), checks, "latest")


# --- feature families ----------------------------------------------------------------


def _family(spark, sf, families, names):
    return round_doubles(_base(spark, sf, families).select("LOAN_ID", *names))


def feat_totals_activity(spark, sf):
    names = [
        "TOTAL_ACCOUNTS", "PLATFORM_AGE", "TOTAL_CUSTOMERS", "NO_PLATFORM_CUSTOMERS",
        "DAYS_SINCE_FIRST_CUST_ADDED", "DAYS_SINCE_LAST_CUST_ADDED", "TOTAL_TRXNS", "TOTAL_TXN_MONTHS",
        "ACTIVE_ACCOUNTS", "ACTIVE_DAYS", "DEBIT_TRXNS", "CREDIT_TRXNS", "DEBIT_AMNT", "CREDIT_AMNT",
        "TOTAL_TXN_AMNT", "D_1_TXNS", "D_30_TXNS",
    ]
    return _family(spark, sf, ("core", "accounts", "counterparty"), names)


def feat_recency(spark, sf):
    names = [
        "DAYS_SINCE_FIRST_TXN", "DAYS_SINCE_LAST_TXN", "MONTHS_SINCE_FIRST_TXN", "MONTHS_SINCE_LAST_TXN",
        "ACTIVATION_AGE",
    ]
    return _family(spark, sf, ("core",), names)


def rolling_names(level: str) -> list[str]:
    names = [n for n in features.core_features() if n.startswith("AVG_") and n.endswith(f"MONTH_{level}")]
    return names


def feat_rolling_daily(spark, sf):
    return _family(spark, sf, ("core",), rolling_names("DAILY"))


def feat_rolling_monthly(spark, sf):
    return _family(spark, sf, ("core", "settlement"), [*rolling_names("MONTHLY"), "CREDIT_EXTENDED_LAST_MONTH_VALUE"])


RATIO_NAMES = [
    "TOTAL_TRXNS_CNT_3_BY_6", "TOTAL_TRXNS_CNT_3_BY_12", "RATIO_CNT_L1_L3_MNTH_DAILY",
    "RATIO_AMNT_L1_L3_MNTH_DAILY", "RATIO_CNT_L1_L3_MNTH_MONTHLY", "RATIO_AMNT_L1_L3_MNTH_MONTHLY",
]


def feat_window_ratios(spark, sf):
    return _family(spark, sf, ("core",), RATIO_NAMES)


def feat_txn_size(spark, sf):
    return _family(spark, sf, ("core",), [f"AVG_TRAN_SIZE_{m}_MNTH_{v}" for v in ("DAILY", "MONTHLY") for m in (1, 2, 3)])


def counterparty_names() -> list[str]:
    return [n for n in features.counterparty_features() if "COUNTERPARTY" in n]


def feat_counterparty(spark, sf):
    return _family(spark, sf, ("core", "counterparty"), counterparty_names())


def feat_settlement_ageing(spark, sf):
    return _family(spark, sf, ("core", "settlement"), ["CREDIT_EXTENDED_TOTAL", *features.SETTLEMENT[1:]])


def settlement_average_names() -> list[str]:
    return [f"{n}_{w}_AVG_{v}" for v in ("DAILY", "MONTHLY") for n in features.SETTLEMENT for w in ("3MNTH", "6MNTH", "12MNTH", "OVERALL")]


def feat_settlement_averages(spark, sf):
    return _family(spark, sf, ("core", "settlement"), settlement_average_names())


def recovery_names() -> list[str]:
    return [
        n for n in features.settlement_features() if "_BY_" in n or "RATIO" in n or n.endswith("MNTH_SUM")
    ]


def feat_recovery_ratios(spark, sf):
    return _family(spark, sf, ("core", "settlement"), recovery_names())


# --- the second product ----------------------------------------------------------------


def activity_features(spark, sf):
    return round_doubles(prepare.project_base(datasets.activity_base(spark, sf)))


def activity_woe_iv(spark, sf):
    base = prepare.project_base(datasets.activity_base(spark, sf))
    imputed = prepare.impute(base, _kinds(base.columns, datasets.activity_dictionary_rows()))
    counts = binning.count_bins(imputed, ACTIVITY_CUTS)
    bins = binning.bin_statistics(binning.with_edges(counts, binning.bins_from_cuts(spark, ACTIVITY_CUTS)))
    tested = bin_tests.test_bins(bins)
    return round_doubles(
        tested.select("variable", "bin_order", "count", "bad", "badprob", "woe", "bin_iv", "total_iv", "mtest", "status")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        base_scan_project, sample_window_filter, dictionary_kind, impute_numeric, impute_categorical,
        train_oot_split, bin_counts_fixed, woe_iv_fixed, monotonic_check, iv_share_test, bin_decision,
        decision_counts, round_union, woe_apply_long, woe_apply_wide, univariate_auc, gini_train_oot,
        bin_trend_report, scorecard_score, dq_min_between, dq_unique_between, dq_suite, dq_latest_batch,
        feat_totals_activity, feat_recency, feat_rolling_daily, feat_rolling_monthly, feat_window_ratios,
        feat_txn_size, feat_counterparty, feat_settlement_ageing, feat_settlement_averages,
        feat_recovery_ratios, activity_features, activity_woe_iv, variable_histogram_grid, woebin_fit,
        woebin_search, search_round_counts, category_bins, scorecard_fit, gbt_score, pca_components,
        job_extract, apply_saved_bins, score_saved_model, dq_history, job_extract_all, job_bins, job_report,
        job_apply_saved, woebin_merge, roc_points, roc_area,
    )
}
