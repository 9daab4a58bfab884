"""The 197 loan features, as a grid of families and windows.

``feature_columns`` gives each named feature as an SQL expression over
point-in-time totals; ``catalog`` is the feature dictionary that belongs to them. A month is 30 days:
an N-month window is the last 30*N days, a daily average divides by 30*N and a
monthly one by N. Overall averages divide by the days since the first fact.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from creditflow.sources.tables import DICTIONARY_SCHEMA, small_table

MONTHS = (1, 2, 3, 6, 12)
LONG_MONTHS = (3, 6, 12)
HORIZON = 90
SETTLEMENT = (
    "CREDIT_EXTENDED",
    "CREDIT_RECOVERED",
    "AMT_RECOVERED_0TO30",
    "AMT_RECOVERED_31TO60",
    "AMT_RECOVERED_61TO90",
    "PARTIAL_SETTLED_TRXNS",
    "FULL_SETTLED_TRXNS",
    "UNSETTLED_TRXNS",
)

# Measures of the daily panel and the window lengths (days) each family needs.
CORE_WINDOWS = {
    "n_txn": (1, 30, 60, 90, 180, 360, 365),
    "c_txn": (30, 60, 90, 180, 360),
    "n_credit": (30, 60, 90, 180, 360),
    "n_debit": (30, 60, 90, 180, 360),
    "c_credit": (),
    "c_debit": (),
}
ACCOUNT_WINDOWS = {"accounts": (), "active_accounts": (HORIZON,)}
COUNTERPARTY_WINDOWS = {
    "customers": (),
    "platform_customers": (),
    "active_platform": (HORIZON,),
    "n_counterparty": (30, 60, 90),
    "c_counterparty": (30, 60, 90),
}
SETTLEMENT_WINDOWS = {
    "c_recovered_0to30": (90, 180, 360),
    "c_recovered_31to60": (90, 180, 360),
    "c_recovered_61to90": (90, 180, 360),
    "n_touched": (90, 180, 360),
    "n_full": (90, 180, 360),
}


def money(cents: str) -> str:
    return f"(cast({cents} as double) / 100.0D)"


def whole(column: str) -> str:
    return f"cast({column} as double)"


def ratio(numerator: str, denominator: str) -> str:
    return f"try_divide(cast({numerator} as double), cast({denominator} as double))"


def per(total: str, units: int) -> str:
    return f"({total} / {units}.0D)"


def days_since(day: str) -> str:
    return f"cast(anchor_day - {day} as double)"


def months_since(month: str) -> str:
    return f"cast(year(disbursed_date) * 12 + month(disbursed_date) - {month} as double)"


def _size_label(months: int) -> str:
    # Fixed value: the 1-month amount average is spelled AMOUNT, the others AMT.
    return "AMOUNT" if months == 1 else "AMT"


def core_features() -> dict[str, str]:
    """Totals, activity, recency, rolling averages, ratios, transaction size."""
    out = {
        "PLATFORM_AGE": days_since("first_day"),
        "TOTAL_TRXNS": whole("n_txn"),
        "TOTAL_TXN_MONTHS": whole("active_months"),
        "ACTIVE_DAYS": whole("active_days"),
        "DEBIT_TRXNS": whole("n_debit"),
        "CREDIT_TRXNS": whole("n_credit"),
        "DEBIT_AMNT": money("c_debit"),
        "CREDIT_AMNT": money("c_credit"),
        "TOTAL_TXN_AMNT": money("c_txn"),
        "DAYS_SINCE_FIRST_TXN": days_since("first_day"),
        "DAYS_SINCE_LAST_TXN": days_since("last_day"),
        "MONTHS_SINCE_FIRST_TXN": months_since("first_month"),
        "MONTHS_SINCE_LAST_TXN": months_since("last_month"),
        "ACTIVATION_AGE": days_since("second_day"),
        "D_1_TXNS": whole("n_txn_1"),
        "D_30_TXNS": whole("n_txn_30"),
    }
    for level, days in (("DAILY", 30), ("MONTHLY", 1)):
        for m in MONTHS:
            out[f"AVG_TRXNS_CNT_L{m}MONTH_{level}"] = per(whole(f"n_txn_{30 * m}"), days * m)
        for m in MONTHS:
            out[f"AVG_TRXNS_{_size_label(m)}_L{m}MONTH_{level}"] = per(money(f"c_txn_{30 * m}"), days * m)
        for side in ("CREDIT", "DEBIT"):
            for m in MONTHS:
                out[f"AVG_{side}_TRXNS_CNT_L{m}MONTH_{level}"] = per(
                    whole(f"n_{side.lower()}_{30 * m}"), days * m
                )
    out["TOTAL_TRXNS_CNT_3_BY_6"] = ratio("n_txn_90", "n_txn_180")
    out["TOTAL_TRXNS_CNT_3_BY_12"] = ratio("n_txn_90", "n_txn_360")
    for level in ("DAILY", "MONTHLY"):
        out[f"RATIO_CNT_L1_L3_MNTH_{level}"] = ratio(
            out[f"AVG_TRXNS_CNT_L1MONTH_{level}"], out[f"AVG_TRXNS_CNT_L3MONTH_{level}"]
        )
        out[f"RATIO_AMNT_L1_L3_MNTH_{level}"] = ratio(
            out[f"AVG_TRXNS_AMOUNT_L1MONTH_{level}"], out[f"AVG_TRXNS_AMT_L3MONTH_{level}"]
        )
    for level in ("DAILY", "MONTHLY"):
        for m in (1, 2, 3):
            out[f"AVG_TRAN_SIZE_{m}_MNTH_{level}"] = ratio(
                out[f"AVG_TRXNS_{_size_label(m)}_L{m}MONTH_{level}"],
                out[f"AVG_TRXNS_CNT_L{m}MONTH_{level}"],
            )
    return out


def account_features() -> dict[str, str]:
    return {"TOTAL_ACCOUNTS": whole("accounts"), "ACTIVE_ACCOUNTS": whole(f"active_accounts_{HORIZON}")}


def counterparty_features() -> dict[str, str]:
    out = {
        "TOTAL_CUSTOMERS": whole("customers"),
        "NO_PLATFORM_CUSTOMERS": whole("platform_customers"),
        "DAYS_SINCE_FIRST_CUST_ADDED": days_since("first_customers"),
        "DAYS_SINCE_LAST_CUST_ADDED": days_since("last_customers"),
        "TOTAL_COUNTERPARTY_TRXNS": whole("n_counterparty"),
        "TOTAL_COUNTERPARTY_TXN_AMT": money("c_counterparty"),
    }
    for level, days in (("DAILY", 30), ("MONTHLY", 1)):
        for kind, total in (("CNT", whole), ("AMT", money)):
            for m in (1, 2, 3):
                name = f"AVG_TXN_{kind}_WITH_PLATFORM_COUNTERPARTY_USERS_{m}MNTH_{level}"
                source = "n_counterparty" if kind == "CNT" else "c_counterparty"
                out[name] = per(total(f"{source}_{30 * m}"), days * m)
    out["ACTIVE_PLATFORM_COUNTERPARTY_USERS"] = whole(f"active_platform_{HORIZON}")
    return out


def settlement_features() -> dict[str, str]:
    """Credit extended, recovered by age, settlement counts, averages, ratios."""
    out: dict[str, str] = {}
    overall = {name: _settled(name, "") for name in SETTLEMENT}
    window = {(name, m): _settled(name, f"_{30 * m}") for name in SETTLEMENT for m in LONG_MONTHS}
    age = "anchor_day - first_day"
    out["CREDIT_EXTENDED_TOTAL"] = overall["CREDIT_EXTENDED"]
    for name in SETTLEMENT[1:]:
        out[name] = overall[name]
    for level, days in (("DAILY", 30), ("MONTHLY", 1)):
        for name in SETTLEMENT:
            for m in LONG_MONTHS:
                out[f"{name}_{m}MNTH_AVG_{level}"] = per(window[name, m], days * m)
            scale = "1.0D" if level == "DAILY" else "30.0D"
            out[f"{name}_OVERALL_AVG_{level}"] = ratio(f"{overall[name]} * {scale}", age)
    out["CREDIT_EXTENDED_LAST_MONTH_VALUE"] = money("c_txn_30")
    for m in (6, 12):
        for name in SETTLEMENT:
            out[f"{name}_3_BY_{m}"] = ratio(window[name, 3], window[name, m])
    for level in ("DAILY", "MONTHLY"):
        for m in (*LONG_MONTHS, "OVERALL"):
            label = f"OVERALL_AVG_{level}" if m == "OVERALL" else f"{m}MNTH_AVG_{level}"
            out[f"CREDIT_RECOVERY_RATIO_{m}_MNTH_AVG_{level}"] = ratio(
                out[f"CREDIT_RECOVERED_{label}"], out[f"CREDIT_EXTENDED_{label}"]
            )
    for m in LONG_MONTHS:
        out[f"CREDIT_EXTENDED_{m}MNTH_SUM"] = window["CREDIT_EXTENDED", m]
        out[f"CREDIT_RECOVERED_{m}MNTH_SUM"] = window["CREDIT_RECOVERED", m]
        out[f"CREDIT_RECOVERY_RATIO_{m}_MNTH"] = ratio(
            window["CREDIT_RECOVERED", m], window["CREDIT_EXTENDED", m]
        )
    for m in (6, 12):
        out[f"CREDIT_RECOVERY_RATIO_3_BY_{m}"] = ratio(
            out["CREDIT_RECOVERY_RATIO_3_MNTH"], out[f"CREDIT_RECOVERY_RATIO_{m}_MNTH"]
        )
    return out


def _settled(name: str, window: str) -> Column:
    if name == "CREDIT_EXTENDED":
        return money(f"c_txn{window}")
    if name == "CREDIT_RECOVERED":
        parts = " + ".join(f"c_recovered_{age}{window}" for age in ("0to30", "31to60", "61to90"))
        return money(f"({parts})")
    if name.startswith("AMT_RECOVERED_"):
        return money(f"c_recovered_{name.rsplit('_', 1)[1].lower()}{window}")
    if name == "FULL_SETTLED_TRXNS":
        return whole(f"n_full{window}")
    if name == "PARTIAL_SETTLED_TRXNS":
        return f"({whole(f'n_touched{window}')} - {whole(f'n_full{window}')})"
    return f"({whole(f'n_txn{window}')} - {whole(f'n_touched{window}')})"


FAMILIES = {
    "core": (core_features, CORE_WINDOWS),
    "accounts": (account_features, ACCOUNT_WINDOWS),
    "counterparty": (counterparty_features, COUNTERPARTY_WINDOWS),
    "settlement": (settlement_features, SETTLEMENT_WINDOWS),
}


def feature_columns(families: Iterable[str] = FAMILIES) -> dict[str, str]:
    out: dict[str, str] = {}
    for family in families:
        out.update(FAMILIES[family][0]())
    return out


def feature_windows(families: Iterable[str] = FAMILIES) -> dict[str, tuple[int, ...]]:
    out: dict[str, tuple[int, ...]] = {}
    for family in families:
        out.update(FAMILIES[family][1])
    return out


# Features that the source table stores with two decimals.
TWO_DECIMALS = (
    "RATIO_CNT_L1_L3_MNTH_DAILY",
    "RATIO_AMNT_L1_L3_MNTH_DAILY",
    "FULL_SETTLED_TRXNS_OVERALL_AVG_DAILY",
    "UNSETTLED_TRXNS_OVERALL_AVG_DAILY",
    "PARTIAL_SETTLED_TRXNS_OVERALL_AVG_MONTHLY",
)

# The inputs of the boosted-tree model.
TREE_MODEL_FEATURES = (
    "TOTAL_ACCOUNTS", "TOTAL_CUSTOMERS", "NO_PLATFORM_CUSTOMERS", "DAYS_SINCE_LAST_CUST_ADDED", "TOTAL_TRXNS", "TOTAL_TXN_MONTHS",
    "ACTIVE_ACCOUNTS", "ACTIVE_DAYS", "DEBIT_TRXNS", "CREDIT_TRXNS", "DEBIT_AMNT", "CREDIT_AMNT", "TOTAL_TXN_AMNT",
    "MONTHS_SINCE_LAST_TXN", "D_1_TXNS", "D_30_TXNS", "AVG_TRXNS_CNT_L1MONTH_DAILY", "AVG_TRXNS_CNT_L2MONTH_DAILY",
    "AVG_TRXNS_CNT_L3MONTH_DAILY", "AVG_TRXNS_CNT_L6MONTH_DAILY", "AVG_TRXNS_CNT_L12MONTH_DAILY", "AVG_TRXNS_AMOUNT_L1MONTH_DAILY",
    "AVG_TRXNS_AMT_L2MONTH_DAILY", "AVG_TRXNS_AMT_L3MONTH_DAILY", "AVG_CREDIT_TRXNS_CNT_L1MONTH_DAILY",
    "AVG_CREDIT_TRXNS_CNT_L2MONTH_DAILY", "AVG_CREDIT_TRXNS_CNT_L6MONTH_DAILY", "AVG_CREDIT_TRXNS_CNT_L12MONTH_DAILY",
    "AVG_DEBIT_TRXNS_CNT_L1MONTH_DAILY", "AVG_DEBIT_TRXNS_CNT_L2MONTH_DAILY", "AVG_DEBIT_TRXNS_CNT_L3MONTH_DAILY",
    "AVG_DEBIT_TRXNS_CNT_L6MONTH_DAILY", "AVG_DEBIT_TRXNS_CNT_L12MONTH_DAILY", "AVG_TRXNS_CNT_L1MONTH_MONTHLY",
    "AVG_TRXNS_CNT_L2MONTH_MONTHLY", "AVG_TRXNS_CNT_L3MONTH_MONTHLY", "AVG_TRXNS_CNT_L6MONTH_MONTHLY", "AVG_TRXNS_CNT_L12MONTH_MONTHLY",
    "AVG_TRXNS_AMOUNT_L1MONTH_MONTHLY", "AVG_TRXNS_AMT_L2MONTH_MONTHLY", "AVG_TRXNS_AMT_L3MONTH_MONTHLY",
    "AVG_CREDIT_TRXNS_CNT_L1MONTH_MONTHLY", "AVG_CREDIT_TRXNS_CNT_L2MONTH_MONTHLY", "AVG_CREDIT_TRXNS_CNT_L6MONTH_MONTHLY",
    "AVG_CREDIT_TRXNS_CNT_L12MONTH_MONTHLY", "AVG_DEBIT_TRXNS_CNT_L1MONTH_MONTHLY", "AVG_DEBIT_TRXNS_CNT_L2MONTH_MONTHLY",
    "AVG_DEBIT_TRXNS_CNT_L3MONTH_MONTHLY", "AVG_DEBIT_TRXNS_CNT_L6MONTH_MONTHLY", "AVG_DEBIT_TRXNS_CNT_L12MONTH_MONTHLY",
    "TOTAL_TRXNS_CNT_3_BY_6", "TOTAL_TRXNS_CNT_3_BY_12", "RATIO_CNT_L1_L3_MNTH_DAILY", "RATIO_AMNT_L1_L3_MNTH_DAILY",
    "RATIO_CNT_L1_L3_MNTH_MONTHLY", "RATIO_AMNT_L1_L3_MNTH_MONTHLY", "AVG_TRAN_SIZE_1_MNTH_DAILY", "AVG_TRAN_SIZE_2_MNTH_DAILY",
    "AVG_TRAN_SIZE_3_MNTH_DAILY", "AVG_TRAN_SIZE_1_MNTH_MONTHLY", "AVG_TRAN_SIZE_2_MNTH_MONTHLY", "AVG_TRAN_SIZE_3_MNTH_MONTHLY",
    "TOTAL_COUNTERPARTY_TRXNS", "TOTAL_COUNTERPARTY_TXN_AMT", "AVG_TXN_CNT_WITH_PLATFORM_COUNTERPARTY_USERS_1MNTH_DAILY",
    "AVG_TXN_CNT_WITH_PLATFORM_COUNTERPARTY_USERS_2MNTH_DAILY", "AVG_TXN_CNT_WITH_PLATFORM_COUNTERPARTY_USERS_3MNTH_DAILY",
    "AVG_TXN_AMT_WITH_PLATFORM_COUNTERPARTY_USERS_1MNTH_DAILY", "AVG_TXN_AMT_WITH_PLATFORM_COUNTERPARTY_USERS_2MNTH_DAILY",
    "AVG_TXN_AMT_WITH_PLATFORM_COUNTERPARTY_USERS_3MNTH_DAILY", "AVG_TXN_CNT_WITH_PLATFORM_COUNTERPARTY_USERS_1MNTH_MONTHLY",
    "AVG_TXN_CNT_WITH_PLATFORM_COUNTERPARTY_USERS_2MNTH_MONTHLY", "AVG_TXN_CNT_WITH_PLATFORM_COUNTERPARTY_USERS_3MNTH_MONTHLY",
    "AVG_TXN_AMT_WITH_PLATFORM_COUNTERPARTY_USERS_1MNTH_MONTHLY", "AVG_TXN_AMT_WITH_PLATFORM_COUNTERPARTY_USERS_2MNTH_MONTHLY",
    "AVG_TXN_AMT_WITH_PLATFORM_COUNTERPARTY_USERS_3MNTH_MONTHLY", "ACTIVE_PLATFORM_COUNTERPARTY_USERS", "CREDIT_EXTENDED_TOTAL",
    "AMT_RECOVERED_31TO60", "AMT_RECOVERED_61TO90", "PARTIAL_SETTLED_TRXNS", "FULL_SETTLED_TRXNS", "UNSETTLED_TRXNS",
    "CREDIT_EXTENDED_3MNTH_AVG_DAILY", "CREDIT_EXTENDED_6MNTH_AVG_DAILY", "CREDIT_EXTENDED_12MNTH_AVG_DAILY",
    "CREDIT_EXTENDED_OVERALL_AVG_DAILY", "CREDIT_RECOVERED_OVERALL_AVG_DAILY", "AMT_RECOVERED_0TO30_OVERALL_AVG_DAILY",
    "AMT_RECOVERED_31TO60_OVERALL_AVG_DAILY", "AMT_RECOVERED_61TO90_OVERALL_AVG_DAILY", "PARTIAL_SETTLED_TRXNS_3MNTH_AVG_DAILY",
    "PARTIAL_SETTLED_TRXNS_6MNTH_AVG_DAILY", "PARTIAL_SETTLED_TRXNS_12MNTH_AVG_DAILY", "PARTIAL_SETTLED_TRXNS_OVERALL_AVG_DAILY",
    "FULL_SETTLED_TRXNS_3MNTH_AVG_DAILY", "FULL_SETTLED_TRXNS_6MNTH_AVG_DAILY", "FULL_SETTLED_TRXNS_12MNTH_AVG_DAILY",
    "FULL_SETTLED_TRXNS_OVERALL_AVG_DAILY", "UNSETTLED_TRXNS_3MNTH_AVG_DAILY", "UNSETTLED_TRXNS_6MNTH_AVG_DAILY",
    "UNSETTLED_TRXNS_12MNTH_AVG_DAILY", "UNSETTLED_TRXNS_OVERALL_AVG_DAILY", "CREDIT_EXTENDED_3MNTH_AVG_MONTHLY",
    "CREDIT_EXTENDED_6MNTH_AVG_MONTHLY", "CREDIT_EXTENDED_12MNTH_AVG_MONTHLY", "CREDIT_EXTENDED_OVERALL_AVG_MONTHLY",
    "AMT_RECOVERED_31TO60_OVERALL_AVG_MONTHLY", "AMT_RECOVERED_61TO90_OVERALL_AVG_MONTHLY", "PARTIAL_SETTLED_TRXNS_3MNTH_AVG_MONTHLY",
    "PARTIAL_SETTLED_TRXNS_6MNTH_AVG_MONTHLY", "PARTIAL_SETTLED_TRXNS_12MNTH_AVG_MONTHLY", "PARTIAL_SETTLED_TRXNS_OVERALL_AVG_MONTHLY",
    "FULL_SETTLED_TRXNS_3MNTH_AVG_MONTHLY", "FULL_SETTLED_TRXNS_6MNTH_AVG_MONTHLY", "FULL_SETTLED_TRXNS_12MNTH_AVG_MONTHLY",
    "FULL_SETTLED_TRXNS_OVERALL_AVG_MONTHLY", "UNSETTLED_TRXNS_3MNTH_AVG_MONTHLY", "UNSETTLED_TRXNS_6MNTH_AVG_MONTHLY",
    "UNSETTLED_TRXNS_12MNTH_AVG_MONTHLY", "UNSETTLED_TRXNS_OVERALL_AVG_MONTHLY", "CREDIT_EXTENDED_LAST_MONTH_VALUE",
    "CREDIT_EXTENDED_3_BY_6", "CREDIT_RECOVERED_3_BY_6", "AMT_RECOVERED_0TO30_3_BY_6", "AMT_RECOVERED_31TO60_3_BY_6",
    "AMT_RECOVERED_61TO90_3_BY_6", "PARTIAL_SETTLED_TRXNS_3_BY_6", "FULL_SETTLED_TRXNS_3_BY_6", "UNSETTLED_TRXNS_3_BY_6",
    "CREDIT_EXTENDED_3_BY_12", "CREDIT_RECOVERED_3_BY_12", "AMT_RECOVERED_0TO30_3_BY_12", "AMT_RECOVERED_31TO60_3_BY_12",
    "AMT_RECOVERED_61TO90_3_BY_12", "PARTIAL_SETTLED_TRXNS_3_BY_12", "FULL_SETTLED_TRXNS_3_BY_12", "UNSETTLED_TRXNS_3_BY_12",
    "CREDIT_RECOVERY_RATIO_3_MNTH_AVG_DAILY", "CREDIT_RECOVERY_RATIO_6_MNTH_AVG_DAILY", "CREDIT_RECOVERY_RATIO_12_MNTH_AVG_DAILY",
    "CREDIT_RECOVERY_RATIO_OVERALL_MNTH_AVG_DAILY", "CREDIT_RECOVERY_RATIO_3_MNTH_AVG_MONTHLY",
    "CREDIT_RECOVERY_RATIO_6_MNTH_AVG_MONTHLY", "CREDIT_RECOVERY_RATIO_12_MNTH_AVG_MONTHLY",
    "CREDIT_RECOVERY_RATIO_OVERALL_MNTH_AVG_MONTHLY", "CREDIT_EXTENDED_3MNTH_SUM", "CREDIT_RECOVERY_RATIO_3_MNTH",
    "CREDIT_EXTENDED_6MNTH_SUM", "CREDIT_RECOVERY_RATIO_6_MNTH", "CREDIT_EXTENDED_12MNTH_SUM", "CREDIT_RECOVERY_RATIO_12_MNTH",
    "CREDIT_RECOVERY_RATIO_3_BY_6", "CREDIT_RECOVERY_RATIO_3_BY_12",
)


@cache
def feature_names() -> list[str]:
    """All feature names in catalog order."""
    names = list(feature_columns())
    head = [
        "TOTAL_ACCOUNTS", "PLATFORM_AGE", "TOTAL_CUSTOMERS", "NO_PLATFORM_CUSTOMERS",
        "DAYS_SINCE_FIRST_CUST_ADDED", "DAYS_SINCE_LAST_CUST_ADDED", "TOTAL_TRXNS",
        "TOTAL_TXN_MONTHS", "ACTIVE_ACCOUNTS",
    ]
    return head + [n for n in names if n not in head]


def tree_model_features() -> list[str]:
    return list(TREE_MODEL_FEATURES)


def expected_trend(name: str) -> str:
    """Business expectation: risk rises with time since the last activity and
    with unsettled transactions, and falls with everything else."""
    rising = "UNSETTLED" in name or ("SINCE_LAST" in name)
    return "Increasing" if rising else "Decreasing"


def catalog(spark: SparkSession) -> DataFrame:
    """The feature dictionary: number, name, WOE name, description, kind, trend."""
    return small_table(spark, catalog_rows(), DICTIONARY_SCHEMA)


def catalog_rows() -> list[tuple]:
    return [
        (i, name, f"{name}_woe", name.replace("_", " ").capitalize(), "Numerical", expected_trend(name))
        for i, name in enumerate(feature_names(), 1)
    ]
