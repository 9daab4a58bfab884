"""Reference answers for kept tables as plain SQL: what must be in them, from the given tables directly."""

from __future__ import annotations

from creditflow import config
from creditflow.operators import features
from creditflow.plans import queries as fixed
from creditflow.plans import table_queries as q
from creditflow.plans.oracle import SPLIT, STATS, base_cte, dictionary_values, job_search_cte, r6
from creditflow.sources import datasets

SUMMARY = "count(*) AS loans, CAST(sum(BAD_FLAG) AS BIGINT) AS bad, CAST(sum(round(LOAN_AMOUNT * 100)) AS BIGINT) AS cents"
MONTH = "strftime(DISBURSED_DATE, '%Y-%m')"


def batch_replace() -> str:
    return base_cte([]) + f""",
newest AS (SELECT max({MONTH}) AS month FROM base),
wanted AS (SELECT DISTINCT {MONTH} AS month FROM base WHERE {SPLIT} = 'oot')
SELECT {MONTH} AS BATCH, count(*) AS loans, CAST(sum(BAD_FLAG) AS BIGINT) AS bad,
       CAST(sum(round(LOAN_AMOUNT * CASE WHEN {MONTH} = newest.month THEN 2 ELSE 1 END * 100)) AS BIGINT) AS cents
FROM base, newest WHERE {MONTH} IN (SELECT month FROM wanted) GROUP BY 1"""


def dq_unique_history() -> str:
    def filled(c: str) -> str:
        return {"SEGMENT": "CASE WHEN SEGMENT IS NULL OR SEGMENT = '--' THEN 'missing' ELSE SEGMENT END", "LOAN_ID": "LOAN_ID", "USER_ID": "USER_ID"}.get(
            c, f"coalesce({c}, {config.MISSING_NUMERIC})"
        )

    parts = [
        f"""SELECT m.month AS BATCH, '{c}' AS "column", count(*) AS rows, count(DISTINCT {filled(c)}) AS observed, true AS is_near
FROM months m JOIN base ON {MONTH} <= m.month GROUP BY m.month"""
        for c in q.HISTORY_COLUMNS
    ]
    return base_cte(["MONTHS_SINCE_LAST_TXN"]) + f", months AS (SELECT DISTINCT {MONTH} AS month FROM base) " + " UNION ALL ".join(parts)


def dictionary_csv() -> str:
    core = list(features.core_features())
    columns = [*config.ID_COLUMNS, *config.OUTCOME_COLUMNS, "LOAN_AMOUNT", "SEGMENT", *core]
    data = config.TRANSACTIONS
    numbers = ", ".join(f"('{r[1]}', {r[0]})" for r in datasets.transaction_dictionary_rows())
    # imputed columns have no nulls; ids and flags never have
    return base_cte(core) + f""",
words(variables, kind, Trend_Business) AS (VALUES {dictionary_values()}),
numbers(variables, number) AS (VALUES {numbers}),
names(variable) AS (VALUES {", ".join(f"('{c}')" for c in columns)}),
sample AS (
  SELECT count(*) AS filled FROM base
  WHERE DISBURSED_DATE BETWEEN DATE '{data.start}' AND DATE '{data.end}' AND DAYS_SINCE_LAST_TXN <= {data.max_recency}
)
SELECT variable, coalesce(kind, 'Others') AS kind, number, filled
FROM names, sample LEFT JOIN words ON words.variables = variable LEFT JOIN numbers ON numbers.variables = variable"""


def bin_report_files() -> str:
    return job_search_cte() + """
SELECT variable, CAST(round AS INTEGER) AS round, CAST(bin_order AS INTEGER) AS bin_order, count, bad, status, status AS file
FROM tested JOIN chosen USING (variable, round)"""


def woe_columns_shape() -> str:
    return STATS + f"""
SELECT variable || '_woe' AS "column", {r6('sum(woe)')} AS total, count(*) AS rows, CAST({len(fixed.FIXED_CUTS)} AS BIGINT) AS width
FROM binned JOIN stats USING (variable, bin_order) GROUP BY variable"""


def table_oracle_sql() -> dict[str, str]:
    minima = ", ".join(f"min({r6(f'coalesce({c}, {config.MISSING_NUMERIC})')}) AS {c}" if c != "LOAN_ID" else "min(LOAN_ID) AS LOAN_ID" for c in q.FOOTER_COLUMNS)
    return {
        "table_replace": base_cte([]) + f"SELECT 1 AS version, {SUMMARY} FROM base UNION ALL SELECT 2, {SUMMARY} FROM base WHERE {SPLIT} = 'train'",
        "batch_replace": batch_replace(),
        "dq_unique_history": dq_unique_history(),
        "dq_min_footer": base_cte(["TOTAL_TRXNS", "DAYS_SINCE_LAST_TXN"]) + f"SELECT {minima} FROM base",
        "dictionary_csv": dictionary_csv(),
        "bin_report_files": bin_report_files(),
        "woe_columns_shape": woe_columns_shape(),
    }
