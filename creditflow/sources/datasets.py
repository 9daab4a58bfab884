"""The two modelling bases, derived from the given tables.

Transactions: a loan is an order of the urgent priority class; the facts about
its customer are all orders before the loan's day, whatever their class, and
the lines of those orders. An account is one of the customer's priority
classes, a counterparty a supplier, and a counterparty is on the platform if
the supplier's balance is not negative.

Activity: a loan is a ``signup`` event; its facts are all events of the same
user on earlier days.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditflow.functions.expressions import cents
from creditflow.operators import features
from creditflow.operators.point_in_time import AGED, as_of, daily_panel, dated_uses
from creditflow.sources.tables import DICTIONARY_SCHEMA, read_given, small_table

LOAN_PRIORITY = "1-URGENT"
RECOVERY_DAYS = 90
ACTIVITY_DAYS = (1, 2, 3, 7, 14)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("account"),
        cents("o_totalprice").alias("c"),
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per loan: ids, date, customer segment and loan amount."""
    customer = read_given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("--"))
        .when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
        .alias("SEGMENT"),
    )
    return (
        _orders(spark, sf_dir)
        .where(F.col("account") == LOAN_PRIORITY)
        .select(
            "user_id",
            F.col("order_id").alias("loan_id"),
            F.col("day").alias("disbursed_date"),
            (F.col("c").cast("double") / F.lit(100.0)).alias("LOAN_AMOUNT"),
        )
        .join(customer, "user_id", "left")
    )


def transaction_events(orders: DataFrame, is_sampled: Column) -> DataFrame:
    """One row per order; a loan's day is an anchor if it ``is_sampled``."""

    def only(status: str, value: Column) -> Column:
        return F.when(F.col("status") == status, value).otherwise(F.lit(0).cast("bigint"))

    one = F.lit(1).cast("bigint")
    return orders.select(
        "user_id",
        "account",
        "day",
        one.alias("n_txn"),
        F.col("c").alias("c_txn"),
        only("F", one).alias("n_debit"),
        only("O", one).alias("n_credit"),
        only("F", F.col("c")).alias("c_debit"),
        only("O", F.col("c")).alias("c_credit"),
        F.when((F.col("account") == LOAN_PRIORITY) & is_sampled, 1).alias("is_anchor"),
    )


def account_events(transactions: DataFrame) -> DataFrame:
    """The same transactions, summed per account and day, with the accounts' first and active days beside them.

    One pass over the orders gives both, and what the search for neighbouring days sorts is one row per account and day.
    """
    measures = [c for c in transactions.columns if c not in ("user_id", "account", "day", "is_anchor")]
    uses = (
        transactions.where("user_id IS NOT NULL AND day IS NOT NULL")
        .groupBy("user_id", "account", "day")
        .agg(*[F.sum(m).alias(m) for m in measures], F.max("is_anchor").alias("is_anchor"))
    )
    carried = [*measures, "is_anchor"]
    return dated_uses(uses, "user_id", ["account"], "day", features.HORIZON, "accounts", "active_accounts", carried)


def followed_orders(orders: DataFrame, is_sampled: Column) -> DataFrame:
    """Orders that a loan of their customer, if it ``is_sampled``, follows.

    No total looks past its anchor, so the lines of all other orders describe no loan and are dealt to nobody. Rows
    that share an order's id stay or go together, as their lines are marked together.
    """
    # orders without a customer are no group of their own
    customer = Window.partitionBy("user_id", F.when(F.col("user_id").isNull(), F.col("order_id")))
    last_loan = F.max(F.when((F.col("account") == LOAN_PRIORITY) & is_sampled, F.col("day"))).over(customer)
    return (
        orders.where("order_id IS NOT NULL")
        .select("order_id", "user_id", "day", (F.col("day") < last_loan).alias("followed"))
        .withColumn("followed", F.max("followed").over(Window.partitionBy("order_id")))
        .where("followed")
        .drop("followed")
    )


def settlement_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Recoveries of each order, dated twice.

    A line delivered within 90 days of its order recovers its price. It becomes
    known on the delivery day and belongs to the order's day. An order counts as
    touched from its first recovery and as full once all its lines recovered.
    """
    lines = lineitem.where("l_orderkey IS NOT NULL").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").cast("date").alias("paid"), cents("l_extendedprice").alias("c")
    )
    # dealt once, for the sums, the join and the window
    by_day = lines.repartition("order_id").groupBy("order_id", "paid").agg(F.count("*").alias("lines"), F.sum("c").alias("c"))
    gap = F.datediff("paid", "day")
    recovered = gap.between(0, RECOVERY_DAYS)
    order = Window.partitionBy("order_id")
    marked = (
        by_day.join(orders.select("order_id", "user_id", "day"), "order_id")
        .withColumn("gap", gap)
        .withColumn("first_paid", F.min(F.when(recovered, F.col("paid"))).over(order))
        .withColumn("last_paid", F.max(F.when(recovered, F.col("paid"))).over(order))
        .withColumn("open_lines", F.sum(F.when(~recovered | F.col("gap").isNull(), F.col("lines")).otherwise(F.lit(0))).over(order))
        .where(recovered)
    )

    def aged(low: int, high: int) -> Column:
        return F.when(F.col("gap").between(low, high), F.col("c")).otherwise(F.lit(0))

    measures = {
        "c_recovered_0to30": aged(0, 30),
        "c_recovered_31to60": aged(31, 60),
        "c_recovered_61to90": aged(61, 90),
        "n_touched": (F.col("paid") == F.col("first_paid")).cast("bigint"),
        "n_full": ((F.col("paid") == F.col("last_paid")) & (F.col("open_lines") == 0)).cast("bigint"),
    }
    zero = F.lit(0).cast("bigint")
    known = [m.cast("bigint").alias(n) for n, m in measures.items()]
    belongs = [m.cast("bigint").alias(n + AGED) for n, m in measures.items()]
    rows = F.array(
        F.struct(F.col("paid").alias("d"), *known, *[zero.alias(n + AGED) for n in measures]),
        F.struct(F.col("day").alias("d"), *[zero.alias(n) for n in measures], *belongs),
    )
    return marked.select("user_id", F.inline(rows)).withColumnRenamed("d", "day")


def counterparty_events(orders: DataFrame, lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Dealings with suppliers: first seen, still active, and volume if on the platform.

    The lines meet their orders first and shrink to one row per (user, supplier,
    day) right after. Neighbouring days are found within (user, supplier), and
    only then is the supplier looked up: nothing needs that join's partitioning,
    so the adaptive planner can split a supplier with very many lines.
    """
    platform = supplier.select(
        F.col("s_suppkey").alias("supplier_id"), (F.col("s_acctbal") >= 0).alias("platform")
    )
    lines = lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("supplier_id"), cents("l_extendedprice").alias("c")
    )
    uses = (
        lines.join(orders.select("order_id", "user_id", "day"), "order_id")
        .repartition("user_id", "supplier_id")
        .groupBy("user_id", "supplier_id", "day")
        .agg(F.count("*").alias("n"), F.sum("c").alias("c"))
    )
    marked = dated_uses(uses, "user_id", ["supplier_id"], "day", features.HORIZON, "customers", "active_platform", ["n", "c"])
    looked_up = marked.join(platform, "supplier_id", "left")
    on = F.coalesce("platform", F.lit(False)).cast("bigint")
    return looked_up.select(
        "user_id",
        "day",
        "customers",
        (F.col("customers") * on).alias("platform_customers"),
        (F.col("active_platform") * on).alias("active_platform"),
        (F.col("active_platform" + AGED) * on).alias("active_platform" + AGED),
        (F.col("n") * on).alias("n_counterparty"),
        (F.col("c") * on).alias("c_counterparty"),
    )


def transaction_base(
    spark: SparkSession, sf_dir: str, families: Iterable[str] = tuple(features.FAMILIES), period: tuple[str, str] | None = None
) -> DataFrame:
    """One row per loan: ids, outcome flags, segment and the families' features.

    With a ``period`` (first and last day) only its loans are described. Orders after it are not read, and since
    no total looks past its anchor, the loans' features are those that they have without it.
    """
    families = tuple(dict.fromkeys(("core", *families)))
    orders, all_loans, is_sampled = _orders(spark, sf_dir), loans(spark, sf_dir), F.lit(True)
    if period is not None:
        start, end = (F.lit(d).cast("date") for d in period)
        orders, is_sampled = orders.where(F.col("day") <= end), F.col("day") >= start
        all_loans = all_loans.where(F.col("disbursed_date").between(start, end))
    transactions = transaction_events(orders, is_sampled)
    parts = [(account_events(transactions) if "accounts" in families else transactions).drop("account")]
    if "settlement" in families or "counterparty" in families:
        lineitem = read_given(spark, sf_dir, "lineitem")
        followed = followed_orders(orders, is_sampled)
    if "settlement" in families:
        parts.append(settlement_events(followed, lineitem))
    if "counterparty" in families:
        supplier = read_given(spark, sf_dir, "supplier")
        parts.append(counterparty_events(followed, lineitem, supplier))

    panel = daily_panel(parts, None, "user_id", "day")
    dated = ("customers",) if "counterparty" in families else ()
    known = as_of(panel, "user_id", "day", features.feature_windows(families), "n_txn", dated)

    recency = F.coalesce(F.col("anchor_day") - F.col("last_day"), F.lit(400))
    risk = (
        F.lit(10)
        + F.least(F.lit(40), F.floor(recency / 10))
        + F.when(F.col("n_txn_365") > 2, 0).otherwise(10)
    )
    bad = ((F.col("loan_id") * 7919) % 100 < risk).cast("int")
    named = features.feature_columns(families)
    if "counterparty" in families and "accounts" in families and "settlement" in families:
        named = {n: named[n] for n in features.feature_names()}
    return (
        all_loans.join(known.withColumnRenamed("day", "disbursed_date"), ["user_id", "disbursed_date"], "left")
        .withColumn("BAD_FLAG", bad)
        .select(
            F.col("user_id").alias("USER_ID"),
            F.col("loan_id").alias("LOAN_ID"),
            F.col("disbursed_date").alias("DISBURSED_DATE"),
            F.col("BAD_FLAG").alias("EVER11DPD_IN_90DAYS"),
            F.col("BAD_FLAG").alias("EVER15DPD_IN_90DAYS"),
            F.when(F.col("loan_id") % 2 == 0, F.col("BAD_FLAG")).otherwise(0).alias("EVER15DPD_IN_60DAYS"),
            "LOAN_AMOUNT",
            "SEGMENT",
            *[F.expr(c).alias(n) for n, c in named.items()],
        )
    )


def activity_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per signup event with the user's earlier activity."""
    events = read_given(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("day"), "event_type", cents("value").alias("c")
    )
    measures = {"facts": F.lit(1), **{f"n_{t}": (F.col("event_type") == t).cast("int") for t in EVENT_TYPES}}
    facts = events.select(
        "user_id", "day", F.col("c").alias("c_value"), *[m.cast("bigint").alias(n) for n, m in measures.items()]
    )
    signups = events.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("loan_id"), "user_id", F.col("day").alias("disbursed_date")
    )
    anchors = signups.select("user_id", F.col("disbursed_date").alias("day"))
    windows = {"facts": ACTIVITY_DAYS, "c_value": ACTIVITY_DAYS, **{f"n_{t}": () for t in EVENT_TYPES}}
    known = as_of(daily_panel([facts], anchors, "user_id", "day"), "user_id", "day", windows, "facts")
    risk = F.lit(10) + 2 * F.least(F.lit(20), F.col("facts_7"))
    bad = ((F.col("loan_id") * 7919) % 100 < risk).cast("int")
    named = {
        "TOTAL_FACTS": features.whole("facts"),
        "TOTAL_VALUE": features.money("c_value"),
        "ACTIVE_DAYS": features.whole("active_days"),
        "DAYS_SINCE_FIRST_FACT": features.days_since("first_day"),
        "DAYS_SINCE_LAST_FACT": features.days_since("last_day"),
        **{f"FACTS_L{d}DAY": features.whole(f"facts_{d}") for d in ACTIVITY_DAYS},
        **{f"VALUE_L{d}DAY": features.money(f"c_value_{d}") for d in ACTIVITY_DAYS},
        **{f"TOTAL_{t.upper()}": features.whole(f"n_{t}") for t in EVENT_TYPES},
        "RATIO_FACTS_3_BY_7": features.ratio("facts_3", "facts_7"),
    }
    return (
        signups.join(known.withColumnRenamed("day", "disbursed_date"), ["user_id", "disbursed_date"], "left")
        .withColumn("BAD_FLAG", bad)
        .select(
            F.col("user_id").alias("USER_ID"),
            F.col("loan_id").alias("LOAN_ID"),
            F.col("disbursed_date").alias("DISBURSED_DATE"),
            F.col("BAD_FLAG").alias("EVER11DPD_IN_90DAYS"),
            F.col("BAD_FLAG").alias("EVER15DPD_IN_90DAYS"),
            F.when(F.col("loan_id") % 2 == 0, F.col("BAD_FLAG")).otherwise(0).alias("EVER15DPD_IN_60DAYS"),
            *[F.expr(c).alias(n) for n, c in named.items()],
        )
    )


def transaction_dictionary_rows() -> list[tuple]:
    """The feature dictionary plus this base's loan amount and segment."""
    n = len(features.feature_names())
    return [
        *features.catalog_rows(),
        (n + 1, "LOAN_AMOUNT", "LOAN_AMOUNT_woe", "Amount of the loan", "Numerical", "Decreasing"),
        (n + 2, "SEGMENT", "SEGMENT_woe", "Market segment of the customer", "Categorical", "Decreasing"),
    ]


def activity_dictionary_rows() -> list[tuple]:
    return [
        (i, n, f"{n}_woe", n.replace("_", " ").capitalize(), "Numerical", "Decreasing" if "SINCE_LAST" in n else "Increasing")
        for i, n in enumerate(activity_names(), 1)
    ]


def transaction_dictionary(spark: SparkSession) -> DataFrame:
    return small_table(spark, transaction_dictionary_rows(), DICTIONARY_SCHEMA)


def activity_dictionary(spark: SparkSession) -> DataFrame:
    return small_table(spark, activity_dictionary_rows(), DICTIONARY_SCHEMA)


def activity_names() -> list[str]:
    return [
        "TOTAL_FACTS", "TOTAL_VALUE", "ACTIVE_DAYS", "DAYS_SINCE_FIRST_FACT", "DAYS_SINCE_LAST_FACT",
        *[f"FACTS_L{d}DAY" for d in ACTIVITY_DAYS], *[f"VALUE_L{d}DAY" for d in ACTIVITY_DAYS],
        *[f"TOTAL_{t.upper()}" for t in EVENT_TYPES], "RATIO_FACTS_3_BY_7",
    ]
