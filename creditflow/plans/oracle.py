"""Reference answers: the registered queries as plain SQL for another engine.

Written from the definitions, not from the Spark plans: facts are joined to
loans pair by pair and every total is a filtered aggregate over those pairs.
"""

from __future__ import annotations

from creditflow import config
from creditflow.operators import features, merging
from creditflow.plans import queries as q
from creditflow.sources import datasets

MONTHS = (1, 2, 3, 6, 12)


def r6(expression: str, places: int = 6) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"({dbl(a)} / nullif({dbl(b)}, 0))"


# --- the transaction base ----------------------------------------------------------

LOANS = """
loans AS (
  SELECT o_orderkey AS loan_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS disbursed,
         o_totalprice AS loan_amount,
         CASE c_mktsegment WHEN 'FURNITURE' THEN '--' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS segment
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  WHERE o_orderpriority = '1-URGENT'
),
facts AS (
  SELECT loan_id, disbursed, o_orderkey, o_orderstatus AS status, o_orderpriority AS account,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS day,
         date_diff('day', CAST(o_orderdate AS DATE), disbursed) AS gap
  FROM loans JOIN orders ON o_custkey = user_id AND CAST(o_orderdate AS DATE) < disbursed
)"""


def total(value: str, condition: str = "true") -> str:
    return f"coalesce(sum(CASE WHEN {condition} THEN {value} ELSE 0 END), 0)"


def core_cte() -> str:
    columns = []
    for days in (1, 30, 60, 90, 180, 360, 365):
        columns.append(f"{total('1', f'gap <= {days}')} AS n{days}")
        columns.append(f"{dbl(total('amount', f'gap <= {days}'))} AS a{days}")
        columns.append(f"{total('1', f'''gap <= {days} AND status = 'F' ''')} AS nf{days}")
        columns.append(f"{total('1', f'''gap <= {days} AND status = 'O' ''')} AS no{days}")
    return f"""
core AS (
  SELECT loans.loan_id, count(gap) AS n, {dbl(total('amount'))} AS a,
         {total('1', "status = 'F'")} AS nf, {total('1', "status = 'O'")} AS no,
         {dbl(total('amount', "status = 'F'"))} AS af, {dbl(total('amount', "status = 'O'"))} AS ao,
         min(gap) AS last_gap, max(gap) AS first_gap,
         count(DISTINCT day) AS days, count(DISTINCT year(day) * 12 + month(day)) AS months,
         max(year(loans.disbursed) * 12 + month(loans.disbursed)) - min(year(day) * 12 + month(day)) AS first_months,
         max(year(loans.disbursed) * 12 + month(loans.disbursed)) - max(year(day) * 12 + month(day)) AS last_months,
         date_diff('day', list_sort(list_distinct(list(day) FILTER (day IS NOT NULL)))[2], max(loans.disbursed)) AS second_gap,
         count(DISTINCT account) AS accounts, count(DISTINCT account) FILTER (gap <= 90) AS active_accounts,
         {', '.join(columns)}
  FROM loans LEFT JOIN facts USING (loan_id) GROUP BY loans.loan_id
)"""


SETTLEMENT_WINDOWS = {"3": 90, "6": 180, "12": 360, "OVERALL": 1000000}


def settlement_cte() -> str:
    known = "date_diff('day', day, CAST(l_shipdate AS DATE)) BETWEEN 0 AND 90 AND CAST(l_shipdate AS DATE) < disbursed"
    price = "CAST(l_extendedprice AS DECIMAL(18,2))"

    def recovered(low: int, high: int) -> str:
        return total(price, f"{known} AND date_diff('day', day, CAST(l_shipdate AS DATE)) BETWEEN {low} AND {high}")

    measures = {
        "CREDIT_EXTENDED": dbl(total("amount", "gap <= {w}")),
        "CREDIT_RECOVERED": dbl(total("rec", "gap <= {w}")),
        "AMT_RECOVERED_0TO30": dbl(total("rec30", "gap <= {w}")),
        "AMT_RECOVERED_31TO60": dbl(total("rec60", "gap <= {w}")),
        "AMT_RECOVERED_61TO90": dbl(total("rec90", "gap <= {w}")),
        "PARTIAL_SETTLED_TRXNS": dbl(total("1", "gap <= {w} AND paid > 0 AND paid < lines")),
        "FULL_SETTLED_TRXNS": dbl(total("1", "gap <= {w} AND paid > 0 AND paid = lines")),
        "UNSETTLED_TRXNS": dbl(total("1", "gap <= {w} AND coalesce(paid, 0) = 0")),
    }
    columns = [f"{e.replace('{w}', str(d))} AS {m}_{w}" for m, e in measures.items() for w, d in SETTLEMENT_WINDOWS.items()]
    return f"""
order_recovery AS (
  SELECT loan_id, o_orderkey, count(*) AS lines, count(*) FILTER ({known}) AS paid,
         {recovered(0, 90)} AS rec, {recovered(0, 30)} AS rec30, {recovered(31, 60)} AS rec60, {recovered(61, 90)} AS rec90
  FROM facts JOIN lineitem ON l_orderkey = o_orderkey GROUP BY loan_id, o_orderkey
),
settlement AS (
  SELECT loans.loan_id, {', '.join(columns)}
  FROM loans LEFT JOIN facts USING (loan_id) LEFT JOIN order_recovery USING (loan_id, o_orderkey)
  GROUP BY loans.loan_id
)"""


def counterparty_cte() -> str:
    windows = [
        f"count(*) FILTER (platform AND gap <= {30 * m}) AS cn{m}, {dbl(total('price', f'platform AND gap <= {30 * m}'))} AS ca{m}"
        for m in (1, 2, 3)
    ]
    return f"""
dealings AS (
  SELECT loan_id, disbursed, day, gap, l_suppkey AS supplier, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         coalesce(s_acctbal >= 0, false) AS platform
  FROM facts JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey
),
added AS (SELECT loan_id, supplier, max(gap) AS added_gap FROM dealings GROUP BY loan_id, supplier),
added_range AS (SELECT loan_id, max(added_gap) AS first_added, min(added_gap) AS last_added FROM added GROUP BY loan_id),
dealt AS (
  SELECT loan_id, count(DISTINCT supplier) AS customers, count(DISTINCT supplier) FILTER (platform) AS platform_customers,
         count(DISTINCT supplier) FILTER (platform AND gap <= 90) AS active_platform,
         count(*) FILTER (platform) AS cn, {dbl(total('price', 'platform'))} AS ca, {', '.join(windows)}
  FROM dealings GROUP BY loan_id
)"""


def feature_formulas() -> dict[str, str]:
    """Every feature over the CTEs ``core``, ``settlement``, ``dealt`` and ``added_range``."""
    f = {
        "TOTAL_ACCOUNTS": dbl("accounts"), "PLATFORM_AGE": dbl("first_gap"),
        "TOTAL_CUSTOMERS": dbl("coalesce(customers, 0)"),
        "NO_PLATFORM_CUSTOMERS": dbl("coalesce(platform_customers, 0)"),
        "DAYS_SINCE_FIRST_CUST_ADDED": dbl("first_added"), "DAYS_SINCE_LAST_CUST_ADDED": dbl("last_added"),
        "TOTAL_TRXNS": dbl("n"), "TOTAL_TXN_MONTHS": dbl("months"), "ACTIVE_ACCOUNTS": dbl("active_accounts"),
        "ACTIVE_DAYS": dbl("days"), "DEBIT_TRXNS": dbl("nf"), "CREDIT_TRXNS": dbl("no"),
        "DEBIT_AMNT": "af", "CREDIT_AMNT": "ao", "TOTAL_TXN_AMNT": "a",
        "DAYS_SINCE_FIRST_TXN": dbl("first_gap"), "DAYS_SINCE_LAST_TXN": dbl("last_gap"),
        "MONTHS_SINCE_FIRST_TXN": dbl("first_months"), "MONTHS_SINCE_LAST_TXN": dbl("last_months"),
        "ACTIVATION_AGE": dbl("second_gap"), "D_1_TXNS": dbl("n1"), "D_30_TXNS": dbl("n30"),
    }
    for level, unit in (("DAILY", 30), ("MONTHLY", 1)):
        for m in MONTHS:
            size = "AMOUNT" if m == 1 else "AMT"
            f[f"AVG_TRXNS_CNT_L{m}MONTH_{level}"] = f"{dbl(f'n{30 * m}')} / {unit * m}"
            f[f"AVG_TRXNS_{size}_L{m}MONTH_{level}"] = f"a{30 * m} / {unit * m}"
            f[f"AVG_CREDIT_TRXNS_CNT_L{m}MONTH_{level}"] = f"{dbl(f'no{30 * m}')} / {unit * m}"
            f[f"AVG_DEBIT_TRXNS_CNT_L{m}MONTH_{level}"] = f"{dbl(f'nf{30 * m}')} / {unit * m}"
            if m <= 3:
                f[f"AVG_TRAN_SIZE_{m}_MNTH_{level}"] = div(f"a{30 * m} / {unit * m}", f"{dbl(f'n{30 * m}')} / {unit * m}")
                name = f"WITH_PLATFORM_COUNTERPARTY_USERS_{m}MNTH_{level}"
                f[f"AVG_TXN_CNT_{name}"] = f"{dbl(f'coalesce(cn{m}, 0)')} / {unit * m}"
                f[f"AVG_TXN_AMT_{name}"] = f"coalesce(ca{m}, 0.0) / {unit * m}"
        f[f"RATIO_CNT_L1_L3_MNTH_{level}"] = div(f"{dbl('n30')} / {unit}", f"{dbl('n90')} / {3 * unit}")
        f[f"RATIO_AMNT_L1_L3_MNTH_{level}"] = div(f"a30 / {unit}", f"a90 / {3 * unit}")
    f["TOTAL_TRXNS_CNT_3_BY_6"] = div("n90", "n180")
    f["TOTAL_TRXNS_CNT_3_BY_12"] = div("n90", "n360")
    f["TOTAL_COUNTERPARTY_TRXNS"] = dbl("coalesce(cn, 0)")
    f["TOTAL_COUNTERPARTY_TXN_AMT"] = dbl("coalesce(ca, 0)")
    f["ACTIVE_PLATFORM_COUNTERPARTY_USERS"] = dbl("coalesce(active_platform, 0)")
    f["CREDIT_EXTENDED_LAST_MONTH_VALUE"] = "a30"
    for m in features.SETTLEMENT:
        f["CREDIT_EXTENDED_TOTAL" if m == "CREDIT_EXTENDED" else m] = f"{m}_OVERALL"
        for w in ("3", "6", "12"):
            f[f"{m}_{w}MNTH_AVG_DAILY"] = f"{m}_{w} / {30 * int(w)}"
            f[f"{m}_{w}MNTH_AVG_MONTHLY"] = f"{m}_{w} / {w}"
        f[f"{m}_OVERALL_AVG_DAILY"] = div(f"{m}_OVERALL", "first_gap")
        f[f"{m}_OVERALL_AVG_MONTHLY"] = div(f"{m}_OVERALL * 30", "first_gap")
        f[f"{m}_3_BY_6"] = div(f"{m}_3", f"{m}_6")
        f[f"{m}_3_BY_12"] = div(f"{m}_3", f"{m}_12")
    recovery = {}
    for w in ("3", "6", "12"):
        f[f"CREDIT_EXTENDED_{w}MNTH_SUM"] = f"CREDIT_EXTENDED_{w}"
        f[f"CREDIT_RECOVERED_{w}MNTH_SUM"] = f"CREDIT_RECOVERED_{w}"
        recovery[w] = div(f"CREDIT_RECOVERED_{w}", f"CREDIT_EXTENDED_{w}")
        f[f"CREDIT_RECOVERY_RATIO_{w}_MNTH"] = recovery[w]
    for level in ("DAILY", "MONTHLY"):
        for w in ("3", "6", "12"):
            f[f"CREDIT_RECOVERY_RATIO_{w}_MNTH_AVG_{level}"] = div(
                f[f"CREDIT_RECOVERED_{w}MNTH_AVG_{level}"], f[f"CREDIT_EXTENDED_{w}MNTH_AVG_{level}"]
            )
        f[f"CREDIT_RECOVERY_RATIO_OVERALL_MNTH_AVG_{level}"] = div(
            f[f"CREDIT_RECOVERED_OVERALL_AVG_{level}"], f[f"CREDIT_EXTENDED_OVERALL_AVG_{level}"]
        )
    f["CREDIT_RECOVERY_RATIO_3_BY_6"] = div(recovery["3"], recovery["6"])
    f["CREDIT_RECOVERY_RATIO_3_BY_12"] = div(recovery["3"], recovery["12"])
    for name in features.TWO_DECIMALS:
        f[name] = r6(f[name], 2)
    return f


BAD = """CAST(CASE WHEN (loan_id * 7919) % 100
       < 10 + least(40, coalesce(last_gap, 400) // 10) + CASE WHEN n365 > 2 THEN 0 ELSE 10 END THEN 1 ELSE 0 END AS INTEGER)"""


def base_cte(names, extra: str = "") -> str:
    """``base``: ids, outcome flags, loan amount, segment and the named features."""
    formulas = feature_formulas()
    columns = ", ".join(f"{formulas[n]} AS {n}" for n in names)
    ctes, joins = [LOANS, core_cte()], "loans JOIN core USING (loan_id)"
    core_only = {n for n in formulas if "RECOVER" not in n and "SETTLED" not in n and "EXTENDED" not in n}
    if any(n not in core_only for n in names):
        ctes.append(settlement_cte())
        joins += " JOIN settlement USING (loan_id)"
    if any("CUST" in n or "COUNTERPARTY" in n for n in names):
        ctes.append(counterparty_cte())
        joins += " LEFT JOIN dealt USING (loan_id) LEFT JOIN added_range USING (loan_id)"
    return f"""WITH {','.join(ctes)},
base AS MATERIALIZED (
  SELECT user_id AS USER_ID, loan_id AS LOAN_ID, loans.disbursed AS DISBURSED_DATE,
         {BAD} AS EVER11DPD_IN_90DAYS, {BAD} AS BAD_FLAG,
         CASE WHEN loan_id % 2 = 0 THEN {BAD} ELSE 0 END AS EVER15DPD_IN_60DAYS,
         loan_amount AS LOAN_AMOUNT, segment AS SEGMENT{', ' if columns else ''}{columns}
  FROM {joins}
){extra}
"""


def rounded_list(names) -> str:
    return ", ".join(f"{r6(n)} AS {n}" for n in names)


def family(names) -> str:
    return base_cte(names) + f"SELECT LOAN_ID, {rounded_list(names)} FROM base"


# --- bins ----------------------------------------------------------------------------


def binned_cte(cuts, source: str = "base", keep: str = "LOAN_ID, BAD_FLAG", name: str = "binned") -> str:
    """One row per (loan, variable): the bin it falls into; 0 is missing."""
    parts = []
    for variable, points in cuts.items():
        steps = " ".join(f"WHEN {variable} < {p} THEN {i}" for i, p in enumerate(points, 1))
        parts.append(
            f"SELECT {keep}, '{variable}' AS variable, CASE WHEN {variable} IS NULL OR {variable} = -99999 THEN 0 "
            f"{steps} ELSE {len(points) + 1} END AS bin_order FROM {source}"
        )
    return f",\n{name} AS ({' UNION ALL '.join(parts)})"


def edges_cte(cuts, name: str = "edges") -> str:
    rows = []
    for variable, points in cuts.items():
        labels = ["-inf", *[str(float(p)) for p in points], "inf"]
        rows.append(f"('{variable}', 0, true, 'missing', 'missing')")
        rows += [
            f"('{variable}', {i}, false, '[{labels[i - 1]},{labels[i]})', '{labels[i]}')" for i in range(1, len(labels))
        ]
    return f",\n{name}(variable, bin_order, is_special, bin, breaks) AS (VALUES {', '.join(rows)})"


def statistics_cte(source: str = "binned", group: str = "variable", name: str = "stats", where: str = "true") -> str:
    return f""",
{name}_counts AS (
  SELECT {group}, bin_order, count(*) AS count, CAST(sum(BAD_FLAG) AS BIGINT) AS bad,
         CAST(count(*) - sum(BAD_FLAG) AS BIGINT) AS good
  FROM {source} WHERE {where} GROUP BY {group}, bin_order
)""" + counted_statistics_cte(f"{name}_counts", group, name)


def counted_statistics_cte(counts: str, group: str, name: str) -> str:
    """Shares, WOE and IV of counted bins, by the textbook formulas."""
    p_bad = "(CASE WHEN bad = 0 THEN 0.5 ELSE bad END)::DOUBLE / bads"
    p_good = "(CASE WHEN good = 0 THEN 0.5 ELSE good END)::DOUBLE / goods"
    return f""",
{name}_totals AS (
  SELECT {group}, sum(count) AS rows, nullif(sum(bad), 0)::DOUBLE AS bads, nullif(sum(good), 0)::DOUBLE AS goods
  FROM {counts} GROUP BY {group}
),
{name}_woe AS (
  SELECT *, count::DOUBLE / rows AS count_distr, bad::DOUBLE / count AS badprob,
         ln(({p_bad}) / ({p_good})) AS woe, (({p_bad}) - ({p_good})) * ln(({p_bad}) / ({p_good})) AS bin_iv
  FROM {counts} JOIN {name}_totals USING ({group})
),
{name} AS MATERIALIZED (
  SELECT w.*, t.total_iv FROM {name}_woe w
  JOIN (SELECT {group}, sum(bin_iv) AS total_iv FROM {name}_woe GROUP BY {group}) t USING ({group})
)"""


def tests_cte(source: str = "stats", group: str = "variable", name: str = "tested") -> str:
    """Monotonicity, IV share and decision, from a self-join of neighbouring bins."""
    keys = [g.strip() for g in group.split(",")]
    same = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    return f""",
{name}_numbered AS (
  SELECT *, (SELECT count(*) FROM {source} b WHERE {same.replace('a.', 'a0.')} AND b.bin_order <= a0.bin_order) AS counter,
         CASE WHEN bin_order = 0 THEN 1 ELSE 0 END AS missing_bin
  FROM {source} a0
),
{name}_pairs AS (
  SELECT a.*, b.badprob AS badprob_lag, b.missing_bin AS missing_bin_lag,
         CASE WHEN b.missing_bin = 0 AND b.badprob > a.badprob THEN 'Inc'
              WHEN b.missing_bin = 0 AND b.badprob < a.badprob THEN 'Dec' ELSE 'NA' END AS test,
         a.bin_iv / nullif(a.total_iv, 0) AS Prop_iv
  FROM {name}_numbered a LEFT JOIN {name}_numbered b ON {same} AND b.counter = a.counter - 1
),
{name}_summary AS (
  SELECT {group}, count(*) FILTER (test = 'Inc') AS Inc_cnt, count(*) FILTER (test = 'Dec') AS Dec_cnt,
         count(*) FILTER (test = 'NA') AS Na_cnt, CAST(sum(missing_bin) AS BIGINT) AS break_missing, count(*) AS num_bin,
         max(total_iv) AS Max_iv, CAST(max(CASE WHEN Prop_iv < 0.05 AND missing_bin = 0 THEN 1 ELSE 0 END) AS INTEGER) AS Max_IV_test
  FROM {name}_pairs GROUP BY {group}
),
{name} AS (
  SELECT *, CASE WHEN Prop_iv < 0.05 AND missing_bin = 0 THEN 1 ELSE 0 END AS IV_test,
         CASE WHEN Inc_cnt > 0 AND Dec_cnt > 0 THEN 'NonMono' ELSE 'Mono' END AS mtest,
         CASE WHEN Max_iv < 0.02 THEN 'rejected'
              WHEN Max_IV_test = 0 AND (Inc_cnt = 0 OR Dec_cnt = 0 OR num_bin = 2 OR (break_missing > 0 AND num_bin = 3))
              THEN 'accepted' ELSE 'unresolved' END AS status
  FROM {name}_pairs JOIN {name}_summary USING ({group})
)"""


FIXED_BASE = base_cte([v for v in q.FIXED_CUTS if v != "LOAN_AMOUNT"])
STATS = FIXED_BASE + binned_cte(q.FIXED_CUTS) + edges_cte(q.FIXED_CUTS) + statistics_cte()
TESTED = STATS + tests_cte()
WITH_LABELS = "stats JOIN edges USING (variable, bin_order)"

SPLIT = "CASE WHEN DISBURSED_DATE <= DATE '{}' THEN 'train' WHEN DISBURSED_DATE > DATE '{}' THEN 'oot' END".format(
    config.TRANSACTIONS.split, config.TRANSACTIONS.split
)
SPLIT_STATS = (
    FIXED_BASE
    + binned_cte(q.FIXED_CUTS, keep=f"LOAN_ID, BAD_FLAG, {SPLIT} AS split")
    + edges_cte(q.FIXED_CUTS)
    + statistics_cte(where="split = 'train'")
)
# The rank AUC by its definition: over all (bad, good) pairs, the share in which
# the bad loan has the higher WOE, half for ties (pairs counted bin by bin).
AUC = """,
valued AS (
  SELECT split, variable, coalesce(woe, 0) AS woe, CAST(sum(b.BAD_FLAG) AS DOUBLE) AS bad,
         CAST(count(*) - sum(b.BAD_FLAG) AS DOUBLE) AS good
  FROM binned b LEFT JOIN stats USING (variable, bin_order) GROUP BY ALL
),
auc AS (
  SELECT x.split, x.variable,
         sum(x.bad * y.good * CASE WHEN x.woe > y.woe THEN 1.0 WHEN x.woe = y.woe THEN 0.5 ELSE 0.0 END)
           / nullif(sum(x.bad * y.good), 0) AS auc
  FROM valued x JOIN valued y USING (split, variable) GROUP BY x.split, x.variable
),
direction AS (
  SELECT variable, sign(round(corr_up, 12)) AS direction FROM (
    SELECT variable, sum(bad * woe) / sum(bad + good)
             - sum((bad + good) * woe) / sum(bad + good) * sum(bad) / sum(bad + good) AS corr_up
    FROM valued WHERE split = 'train' GROUP BY variable)
),
gini AS (
  SELECT t.variable || '_woe' AS var, t.variable, direction * (2 * t.auc - 1) AS Gini_train, direction * (2 * o.auc - 1) AS Gini_oot
  FROM auc t JOIN direction USING (variable) LEFT JOIN (SELECT * FROM auc WHERE split = 'oot') o USING (variable)
  WHERE t.split = 'train'
),
performance AS (
  SELECT *, abs(Gini_train - Gini_oot) / nullif(round(Gini_train, 4), 0) AS Relative_diff FROM gini
)"""


# The same from ``valued`` on, for other bins.
AUC_OF_VALUED = ",\n" + AUC[AUC.index("auc AS (") :]


def written(x: str) -> str:
    """A double as Spark writes it: with an exponent from ten million on and below a thousandth."""
    e = f"CAST(floor(log10(abs({x}))) AS INTEGER)"
    return f"""CASE WHEN {x} = 'inf'::DOUBLE THEN 'inf' WHEN {x} = '-inf'::DOUBLE THEN '-inf'
       WHEN {x} <> 0 AND (abs({x}) >= 1e7 OR abs({x}) < 1e-3) THEN CAST(round({x} / pow(10, {e}), 14) AS VARCHAR) || 'E' || {e}
       ELSE CAST({x} AS VARCHAR) END"""


def woe_case(variable: str) -> str:
    return f"(SELECT max(woe) FROM stats s WHERE s.variable = '{variable}' AND s.bin_order = b.bin_order)"


def trend(name: str) -> str:
    return features.expected_trend(name)


def dictionary_values() -> str:
    return ", ".join(f"('{r[1]}', '{r[4]}', '{r[5]}')" for r in datasets.transaction_dictionary_rows())


def bin_trend_report() -> str:
    return (
        SPLIT_STATS
        + AUC
        + tests_cte()
        + f""",
words(variables, kind, Trend_Business) AS (VALUES {dictionary_values()}),
rising AS (SELECT variable, bool_or(test = 'Dec') AS up FROM tested GROUP BY variable)
SELECT t.variable, p.var, e.bin, t.count, {r6('t.count_distr')} AS count_distr, t.good, t.bad, {r6('t.badprob')} AS badprob,
       {r6('t.woe')} AS woe, {r6('t.bin_iv')} AS bin_iv, {r6('t.total_iv')} AS total_iv, {r6('t.Prop_iv')} AS Prop_iv,
       t.Max_IV_test, t.IV_test, e.breaks, e.is_special AS is_special_values, CAST(t.counter AS INTEGER) AS counter, t.num_bin,
       CASE WHEN up THEN 'Increasing' ELSE 'Decreasing' END AS Trend, Trend_Business,
       {r6('Gini_train')} AS Gini_train, {r6('Gini_oot')} AS Gini_oot, {r6('Relative_diff')} AS Relative_diff
FROM tested t JOIN rising USING (variable) JOIN edges e USING (variable, bin_order)
LEFT JOIN performance p ON p.variable = t.variable LEFT JOIN words ON variables = t.variable"""
    )


def round_union() -> str:
    first = binned_cte(q.FIXED_CUTS, keep="1 AS round, LOAN_ID, BAD_FLAG", name="first_round")
    second = binned_cte(q.SECOND_CUTS, keep="2 AS round, LOAN_ID, BAD_FLAG", name="second_round")
    return (
        FIXED_BASE + first + second
        + ",\nboth_rounds AS (SELECT * FROM first_round UNION ALL SELECT * FROM second_round)"
        + statistics_cte("both_rounds", "round, variable")
        + tests_cte(group="round, variable")
        + f""",
settled AS (SELECT variable, min(round) AS round FROM tested WHERE status <> 'unresolved' GROUP BY variable),
chosen AS (
  SELECT DISTINCT t.variable, coalesce(s.round, 2) AS round FROM tested t LEFT JOIN settled s USING (variable)
)
SELECT round, variable, bin_order, count, bad, {r6('badprob')} AS badprob, {r6('woe')} AS woe, {r6('total_iv')} AS total_iv, status
FROM tested JOIN chosen USING (round, variable)"""
    )


def woe_apply_wide() -> str:
    columns = []
    for variable in q.FIXED_CUTS:
        columns.append(f"{r6(f'max(woe) FILTER (variable = {chr(39)}{variable}{chr(39)})')} AS {variable}_woe")
    return STATS + f"""
SELECT LOAN_ID, b.BAD_FLAG, {', '.join(columns)}
FROM binned b JOIN stats USING (variable, bin_order) GROUP BY LOAN_ID, b.BAD_FLAG"""


def scorecard_score() -> str:
    raw = [v[:-4] for v in q.SCORECARD]
    weights = " ".join(f"WHEN '{v[:-4]}' THEN CAST({c} AS DOUBLE)" for v, c in q.SCORECARD.items())
    cuts = {v: q.FIXED_CUTS[v] for v in raw}
    return (
        base_cte(raw) + binned_cte(cuts) + statistics_cte()
        + f""",
total AS (
  SELECT LOAN_ID, CAST({q.SCORECARD_CONSTANT} AS DOUBLE) + sum(woe * CASE variable {weights} END) AS z
  FROM binned JOIN stats USING (variable, bin_order) GROUP BY LOAN_ID
)
SELECT USER_ID, LOAN_ID, DISBURSED_DATE, BAD_FLAG,
       {', '.join(f'{r6(f"coalesce({v}, -99999)")} AS {v}' for v in raw)},
       CAST({config.MODEL_NO} AS BIGINT) AS model_no, {r6('1 / (1 + exp(-z))')} AS p_bad
FROM base JOIN total USING (LOAN_ID)"""
    )


def expectation(run: str, kind: str, column: str, low, high, observed: str, source: str = "base") -> str:
    low_sql = "CAST(NULL AS DOUBLE)" if low is None else f"CAST({low} AS DOUBLE)"
    high_sql = "CAST(NULL AS DOUBLE)" if high is None else f"CAST({high} AS DOUBLE)"
    return f"""SELECT '{run}' AS run_id, '{kind}' AS expectation_type, '{column}' AS "column", {low_sql} AS min_value,
  {high_sql} AS max_value, observed,
  ({low_sql} IS NULL OR observed >= {low_sql}) AND ({high_sql} IS NULL OR observed <= {high_sql}) AS success
FROM (SELECT CAST({observed} AS DOUBLE) AS observed FROM {source})"""


MIN, UNIQUE = "expect_column_min_to_be_between", "expect_column_unique_value_count_to_be_between"


def filled(column: str) -> str:
    return f"min(coalesce({column}, -99999))"


def distinct(column: str) -> str:
    return f"count(DISTINCT coalesce({column}, -99999))"


def dictionary_kind() -> str:
    core = list(features.core_features())
    columns = [*config.ID_COLUMNS, *config.OUTCOME_COLUMNS, "LOAN_AMOUNT", "SEGMENT", *core]
    counts = " UNION ALL ".join(f"SELECT '{c}' AS variable, count({c}) AS filled FROM base" for c in columns)
    return base_cte(core) + f""",
words(variables, kind, Trend_Business) AS (VALUES {dictionary_values()}),
counts AS ({counts})
SELECT variable, coalesce(kind, 'Others') AS kind, Trend_Business, filled
FROM counts LEFT JOIN words ON variables = variable"""


# --- the second product --------------------------------------------------------------


def activity_cte() -> str:
    window = ", ".join(
        f"{dbl(f'count(*) FILTER (gap <= {d})')} AS FACTS_L{d}DAY, {dbl(total('value', f'gap <= {d}'))} AS VALUE_L{d}DAY"
        for d in datasets.ACTIVITY_DAYS
    )
    kinds = ", ".join(
        f"{dbl(f'''count(*) FILTER (event_type = '{t}')''')} AS TOTAL_{t.upper()}" for t in datasets.EVENT_TYPES
    )
    return f"""WITH signups AS (
  SELECT event_id AS loan_id, user_id, CAST(ts AS DATE) AS disbursed FROM events WHERE event_type = 'signup'
),
pairs AS (
  SELECT loan_id, disbursed, CAST(ts AS DATE) AS day, date_diff('day', CAST(ts AS DATE), disbursed) AS gap,
         e.event_type, CAST(value AS DECIMAL(18,2)) AS value
  FROM signups LEFT JOIN events e ON e.user_id = signups.user_id AND CAST(ts AS DATE) < disbursed
),
totals AS (
  SELECT loan_id, {dbl('count(gap)')} AS TOTAL_FACTS, {dbl(total('value', 'gap IS NOT NULL'))} AS TOTAL_VALUE,
         {dbl('count(DISTINCT day)')} AS ACTIVE_DAYS, {dbl('max(gap)')} AS DAYS_SINCE_FIRST_FACT,
         {dbl('min(gap)')} AS DAYS_SINCE_LAST_FACT, {window}, {kinds},
         count(*) FILTER (gap <= 3) / nullif(count(*) FILTER (gap <= 7), 0) AS RATIO_FACTS_3_BY_7
  FROM pairs GROUP BY loan_id
),
flagged AS (
  SELECT *, CAST(CASE WHEN (loan_id * 7919) % 100 < 10 + 2 * least(20, FACTS_L7DAY) THEN 1 ELSE 0 END AS INTEGER) AS bad
  FROM signups JOIN totals USING (loan_id)
),
base AS (
  SELECT user_id AS USER_ID, loan_id AS LOAN_ID, disbursed AS DISBURSED_DATE, bad AS EVER11DPD_IN_90DAYS, bad AS BAD_FLAG,
         CASE WHEN loan_id % 2 = 0 THEN bad ELSE 0 END AS EVER15DPD_IN_60DAYS, {', '.join(datasets.activity_names())}
  FROM flagged
)"""


# --- histogram -----------------------------------------------------------------------


def grid(value: str, digits: int) -> str:
    """The number with this many significant digits that is nearest to the value, or the next one below."""
    scale = f"pow(10, {digits - 1} - floor(log10(abs({value}))))"
    near = f"round({value} * {scale})"
    return (
        f"CASE WHEN {value} = 0 THEN 0.0 WHEN {near} / {scale} <= {value} THEN {near} / {scale} "
        f"ELSE ({near} - 1) / {scale} END"
    )


def histogram_cte(variables, fine_share: float = 1.0, source: str = "base", where: str = "true") -> str:
    """Counts per variable and value cut down to three significant digits; six in
    buckets of several values that hold more than ``fine_share`` of the rows."""
    return f""",
long_values AS MATERIALIZED (
  SELECT variable, BAD_FLAG, CASE WHEN value <> -99999 THEN value END AS value
  FROM (UNPIVOT (SELECT BAD_FLAG, {', '.join(f'coalesce({v}, -99999)::DOUBLE AS {v}' for v in variables)} FROM {source} WHERE {where})
        ON {', '.join(variables)} INTO NAME variable VALUE value)
),
coarse AS MATERIALIZED (SELECT *, {grid('value', 3)} AS start3, {grid('value', 6)} AS start6 FROM long_values),
sizes AS (SELECT variable, count(*) AS total FROM long_values GROUP BY variable),
heavy AS (
  SELECT variable, start3 FROM coarse JOIN sizes USING (variable) WHERE value IS NOT NULL
  GROUP BY variable, start3, total HAVING count(*) > {fine_share} * total AND min(value) < max(value)
),
histogram AS MATERIALIZED (
  SELECT c.variable, value IS NULL AS special, CASE WHEN h.start3 IS NULL THEN c.start3 ELSE c.start6 END AS start,
         count(*) AS n, CAST(sum(BAD_FLAG) AS BIGINT) AS bad, min(value) AS low, max(value) AS high
  FROM coarse c LEFT JOIN heavy h ON h.variable = c.variable AND h.start3 = c.start3 GROUP BY 1, 2, 3
)"""


# --- the binning search ---------------------------------------------------------------


def search_cte(rounds) -> str:
    """The greedy search step by step: one CTE per added cut, all variables and shares at once."""
    shares = ", ".join(f"({s}::DOUBLE)" for s in sorted({s for _, s in rounds}))

    def segment(left: str, right: str) -> str:
        b = f"({right}bad - {left}bad)"
        g = f"(({right}n - {left}n) - {b})"
        pb = f"((CASE WHEN {b} = 0 THEN 0.5 ELSE {b} END)::DOUBLE / bads)"
        pg = f"((CASE WHEN {g} = 0 THEN 0.5 ELSE {g} END)::DOUBLE / goods)"
        return f"(({pb} - {pg}) * ln({pb} / {pg}))"

    out = f""",
ordered AS (
  SELECT variable, start AS edge, n, bad FROM histogram WHERE NOT special
),
points AS MATERIALIZED (
  SELECT variable, row_number() OVER w - 1 AS j, edge, sum(n) OVER w - n AS n, sum(bad) OVER w - bad AS bad
  FROM ordered WINDOW w AS (PARTITION BY variable ORDER BY edge)
),
sums AS MATERIALIZED (
  SELECT variable, sum(n) AS total, greatest(sum(bad), 0.5)::DOUBLE AS bads, greatest(sum(n) - sum(bad), 0.5)::DOUBLE AS goods,
         sum(n) FILTER (NOT special) AS last_n, sum(bad) FILTER (NOT special) AS last_bad
  FROM histogram GROUP BY variable
),
shares(share) AS (VALUES {shares}),
bounds0 AS MATERIALIZED (
  SELECT variable, share, j, n, bad, edge, 0 AS step FROM points, shares WHERE j = 0
  UNION ALL
  SELECT variable, share, 1000000, last_n, last_bad, 'inf'::DOUBLE, 0 FROM sums, shares WHERE last_n IS NOT NULL
)"""
    last = max(limit for limit, _ in rounds) - 1
    for k in range(1, last + 1):
        out += f""",
segments{k} AS (
  SELECT b.variable, share, b.j AS lj, b.n AS ln, b.bad AS lbad, lead(b.j) OVER w AS rj, lead(b.n) OVER w AS rn, lead(b.bad) OVER w AS rbad,
         total, bads, goods
  FROM bounds{k - 1} b JOIN sums USING (variable) WINDOW w AS (PARTITION BY b.variable, share ORDER BY b.j)
),
held{k} AS (
  SELECT variable, share, sum({segment('l', 'r')}) AS iv FROM segments{k} WHERE rj IS NOT NULL GROUP BY variable, share
),
offers{k} AS (
  SELECT s.variable, share, p.j, p.n, p.bad, p.edge, {segment('l', 'p.')} + {segment('p.', 'r')} - {segment('l', 'r')} AS gain
  FROM segments{k} s JOIN points p ON p.variable = s.variable AND p.j > lj AND p.j < rj
  WHERE p.n - ln >= share * total AND rn - p.n >= share * total
),
bounds{k} AS MATERIALIZED (
  SELECT * FROM bounds{k - 1}
  UNION ALL
  SELECT variable, share, j, n, bad, edge, {k} FROM (
    SELECT o.*, iv, row_number() OVER (PARTITION BY variable, share ORDER BY gain DESC, j) AS place
    FROM offers{k} o JOIN held{k} USING (variable, share))
  WHERE place = 1 AND gain > 0 AND gain >= {config.MIN_IV_GAIN}::DOUBLE * iv
)"""
    numbered = ", ".join(f"({i}, {limit}, {share}::DOUBLE)" for i, (limit, share) in enumerate(rounds, 1))
    return out + f""",
rounds(round, bin_limit, share) AS (VALUES {numbered}),
usual_bins AS (
  SELECT variable, round, row_number() OVER w AS bin_order, false AS is_special,
         CASE WHEN j = 0 THEN '-inf'::DOUBLE ELSE edge END AS lo, lead(edge) OVER w AS hi,
         lead(n) OVER w - n AS count, lead(bad) OVER w - bad AS bad
  FROM bounds{last} JOIN rounds USING (share) WHERE step < bin_limit
  WINDOW w AS (PARTITION BY variable, round ORDER BY j)
),
round_counts AS MATERIALIZED (
  SELECT variable, round, bin_order, is_special, lo, hi, CAST(count AS BIGINT) AS count, CAST(bad AS BIGINT) AS bad,
         CAST(count - bad AS BIGINT) AS good FROM usual_bins WHERE count IS NOT NULL
  UNION ALL
  SELECT variable, round, 0, true, NULL, NULL, n, bad, n - bad FROM histogram, rounds WHERE special
)""" + counted_statistics_cte("round_counts", "variable, round", "stats")


def merge_cte(limit: int, share: float) -> str:
    """Merging by chi-square as a recursion over lists of bins, one merge a step; then the bins' counts and statistics."""
    n, b = "(n[i] + n[i + 1])", "(bad[i] + bad[i + 1])"
    cross = "(bad[i] * (n[i + 1] - bad[i + 1]) - bad[i + 1] * (n[i] - bad[i]))::DOUBLE"
    chi = f"""CASE WHEN {b} = 0 OR {b} = {n} THEN 0.0::DOUBLE
      ELSE {n}::DOUBLE * {cross} * {cross} / (n[i]::DOUBLE * n[i + 1]::DOUBLE * {b}::DOUBLE * ({n} - {b})::DOUBLE) END"""
    small = f"(n[i] < {share} * total OR n[i + 1] < {share} * total)"
    return f""",
merging AS (
  SELECT variable, total, list(n ORDER BY start) AS n, list(bad ORDER BY start) AS bad, list(start ORDER BY start) AS starts
  FROM histogram JOIN (SELECT variable, sum(n) AS total FROM histogram GROUP BY variable) USING (variable) WHERE NOT special GROUP BY variable, total
  UNION ALL
  SELECT variable, total, n[1:pos - 1] || [n[pos] + n[pos + 1]] || n[pos + 2:], bad[1:pos - 1] || [bad[pos] + bad[pos + 1]] || bad[pos + 2:],
         starts[1:pos] || starts[pos + 2:]
  FROM (
    SELECT *, CASE WHEN len(n) > {limit} OR list_min(chis) < {merging.LEAST_CHI_SQUARE} THEN list_position(chis, list_min(chis))
                   WHEN list_min(touching) IS NOT NULL THEN list_position(touching, list_min(touching)) END AS pos
    FROM (
      SELECT *, list_transform(range(1, len(n)), lambda i: {chi}) AS chis, list_transform(range(1, len(n)), lambda i: CASE WHEN {small} THEN {chi} END) AS touching
      FROM merging WHERE len(n) > 1
    )
  )
  WHERE pos IS NOT NULL AND pos > 0
),
merged AS (SELECT variable, arg_min(struct_pack(n := n, bad := bad, starts := starts), len(n)) AS m FROM merging GROUP BY variable),
places AS (SELECT variable, m, unnest(range(1, len(m.n) + 1)) AS i FROM merged),
merged_counts AS MATERIALIZED (
  SELECT variable, i AS bin_order, false AS is_special, CASE WHEN i = 1 THEN '-inf'::DOUBLE ELSE m.starts[i] END AS lo,
         CASE WHEN i = len(m.n) THEN 'inf'::DOUBLE ELSE m.starts[i + 1] END AS hi, CAST(m.n[i] AS BIGINT) AS count, CAST(m.bad[i] AS BIGINT) AS bad,
         CAST(m.n[i] - m.bad[i] AS BIGINT) AS good FROM places
  UNION ALL
  SELECT variable, 0, true, NULL, NULL, n, bad, n - bad FROM histogram WHERE special
)""" + counted_statistics_cte("merged_counts", "variable", "stats")


def roc_cte() -> str:
    return f"""WITH scored AS ({scorecard_score()}),
counts AS (SELECT p_bad, sum(BAD_FLAG) AS bad, count(*) - sum(BAD_FLAG) AS good FROM scored GROUP BY p_bad),
ranked AS (
  SELECT *, sum(bad) OVER w AS bads, sum(good) OVER w AS goods, lead(bad) OVER w AS next_bad, lead(good) OVER w AS next_good,
         (SELECT sum(bad) FROM counts) AS all_bad, (SELECT sum(good) FROM counts) AS all_good
  FROM counts WINDOW w AS (ORDER BY p_bad DESC)
)"""


def settle_cte(rounds) -> str:
    """Each variable's settling round; the search stops when one variable is left."""
    n = len(rounds)
    return f""",
settled AS (
  SELECT variable, coalesce(min(round) FILTER (status <> 'unresolved'), {n + 1}) AS settled FROM tested GROUP BY variable
),
running AS (SELECT round, count(*) AS open FROM (SELECT DISTINCT round FROM tested) JOIN settled ON settled >= round GROUP BY round),
ended AS (SELECT max(round) AS last_round FROM running WHERE open > 1),
chosen AS (SELECT variable, least(settled, last_round) AS round FROM settled, ended)"""


def job_search_cte() -> str:
    """The job's search over all candidate variables: ``tested`` and ``chosen``, from the sample's train part."""
    data, all_names = config.TRANSACTIONS, features.feature_names()
    sample = f"DISBURSED_DATE BETWEEN DATE '{data.start}' AND DATE '{data.end}' AND DAYS_SINCE_LAST_TXN <= {data.max_recency}"
    train = f"DISBURSED_DATE <= DATE '{data.split}'"
    share, candidates = config.HEAVY_SHARE, [*all_names, "LOAN_AMOUNT", "SEGMENT"]
    return (
        base_cte(all_names) + f""",
sampled AS (SELECT * EXCLUDE (SEGMENT), coalesce(nullif(SEGMENT, '--'), 'missing') AS category FROM base WHERE {sample}),
scores AS (SELECT category, floor(sum(BAD_FLAG) * 1000 / count(*)) / 1000 AS score FROM sampled WHERE {train} GROUP BY category),
scored AS (SELECT s.*, score AS SEGMENT FROM sampled s LEFT JOIN scores USING (category))"""
        + histogram_cte(candidates, share, source="scored", where=train)
        + search_cte(config.SEARCH_ROUNDS) + tests_cte(group="variable, round") + settle_cte(config.SEARCH_ROUNDS)
    )


def oracle_sql() -> dict[str, str]:
    all_names = features.feature_names()
    ids = "USER_ID, LOAN_ID, DISBURSED_DATE, EVER11DPD_IN_90DAYS, BAD_FLAG, EVER15DPD_IN_60DAYS"
    data = config.TRANSACTIONS
    numeric = [
        "DAYS_SINCE_FIRST_TXN", "DAYS_SINCE_LAST_TXN", "ACTIVATION_AGE", "TOTAL_TRXNS_CNT_3_BY_6",
        "RATIO_AMNT_L1_L3_MNTH_DAILY", "AVG_TRAN_SIZE_3_MNTH_MONTHLY", "TOTAL_TXN_AMNT",
    ]
    imputed = ", ".join(f"{r6(f'coalesce({n}, -99999)')} AS {n}" for n in numeric)
    out = {
        "base_scan_project": base_cte(all_names)
        + f"SELECT {ids}, {r6('LOAN_AMOUNT')} AS LOAN_AMOUNT, SEGMENT, {rounded_list(all_names)} FROM base",
        "sample_window_filter": base_cte(["DAYS_SINCE_LAST_TXN"])
        + f"""SELECT LOAN_ID, USER_ID, DISBURSED_DATE, BAD_FLAG, DAYS_SINCE_LAST_TXN FROM base
WHERE DISBURSED_DATE BETWEEN DATE '{data.start}' AND DATE '{data.end}' AND DAYS_SINCE_LAST_TXN <= {data.max_recency}""",
        "dictionary_kind": dictionary_kind(),
        "impute_numeric": base_cte(numeric) + f"SELECT LOAN_ID, BAD_FLAG, {imputed} FROM base",
        "job_extract": base_cte(q.JOB_COLUMNS)
        + f"""SELECT LOAN_ID, DISBURSED_DATE, BAD_FLAG, coalesce(nullif(SEGMENT, '--'), 'missing') AS SEGMENT,
{", ".join(f"{r6(f'coalesce({n}, -99999)')} AS {n}" for n in q.JOB_COLUMNS)} FROM base
WHERE DISBURSED_DATE BETWEEN DATE '{data.start}' AND DATE '{data.end}' AND DAYS_SINCE_LAST_TXN <= {data.max_recency}""",
        "impute_categorical": base_cte([])
        + """SELECT USER_ID, LOAN_ID, DISBURSED_DATE, BAD_FLAG,
CASE WHEN SEGMENT IS NULL OR SEGMENT = '--' THEN 'missing' ELSE SEGMENT END AS SEGMENT FROM base""",
        "train_oot_split": base_cte([])
        + f"""SELECT {SPLIT} AS split, count(*) AS loans, CAST(sum(BAD_FLAG) AS BIGINT) AS bad,
min(DISBURSED_DATE) AS first_day, max(DISBURSED_DATE) AS last_day FROM base GROUP BY 1""",
        "bin_counts_fixed": STATS
        + f"""SELECT variable, bin_order, bin, count, {r6('count_distr')} AS count_distr, good, bad, {r6('badprob')} AS badprob
FROM {WITH_LABELS}""",
        "woe_iv_fixed": STATS
        + f"""SELECT variable, bin_order, bin, breaks, is_special, count, {r6('count_distr')} AS count_distr, good, bad,
{r6('badprob')} AS badprob, {r6('woe')} AS woe, {r6('bin_iv')} AS bin_iv, {r6('total_iv')} AS total_iv FROM {WITH_LABELS}""",
        "monotonic_check": TESTED
        + f"""SELECT variable, bin_order, CAST(counter AS INTEGER) AS counter, {r6('badprob')} AS badprob, {r6('badprob_lag')} AS badprob_lag,
missing_bin, missing_bin_lag, test, Inc_cnt, Dec_cnt, Na_cnt, break_missing, num_bin, mtest FROM tested""",
        "iv_share_test": TESTED
        + f"""SELECT variable, bin_order, {r6('bin_iv')} AS bin_iv, {r6('Max_iv')} AS Max_iv, {r6('Prop_iv')} AS Prop_iv,
IV_test, Max_IV_test FROM tested""",
        "bin_decision": TESTED
        + f"""SELECT DISTINCT variable, {r6('Max_iv')} AS Max_iv, mtest, num_bin, Max_IV_test,
CASE WHEN status = 'accepted' THEN 1 ELSE 0 END AS Accept_flag, CASE WHEN status = 'unresolved' THEN 1 ELSE 0 END AS Issue_bin,
status FROM tested""",
        "decision_counts": TESTED + "SELECT status, count(DISTINCT variable) AS variables FROM tested GROUP BY status",
        "round_union": round_union(),
        "woe_apply_long": STATS
        + f"SELECT LOAN_ID, b.BAD_FLAG, variable, {r6('woe')} AS woe FROM binned b JOIN stats USING (variable, bin_order)",
        "woe_apply_wide": woe_apply_wide(),
        "apply_saved_bins": woe_apply_wide(),
        "univariate_auc": SPLIT_STATS + AUC + f"SELECT split, variable, {r6('auc')} AS auc FROM auc",
        "gini_train_oot": SPLIT_STATS + AUC
        + f"""SELECT var, {r6('Gini_train')} AS Gini_train, {r6('Gini_oot')} AS Gini_oot, {r6('Relative_diff')} AS Relative_diff
FROM performance""",
        "bin_trend_report": bin_trend_report(),
        "scorecard_score": scorecard_score(),
        "score_saved_model": scorecard_score(),
        "dq_min_between": base_cte(["TOTAL_CUSTOMERS", "TOTAL_TRXNS", "DAYS_SINCE_LAST_TXN"])
        + " UNION ALL ".join(
            [
                expectation("min", MIN, "TOTAL_CUSTOMERS", 1, 1, filled("TOTAL_CUSTOMERS")),
                expectation("min", MIN, "TOTAL_TRXNS", 0, None, filled("TOTAL_TRXNS")),
                expectation("min", MIN, "DAYS_SINCE_LAST_TXN", 0, None, filled("DAYS_SINCE_LAST_TXN")),
            ]
        ),
        "dq_unique_between": base_cte(["MONTHS_SINCE_LAST_TXN"])
        + expectation("unique", UNIQUE, "MONTHS_SINCE_LAST_TXN", None, None, distinct("MONTHS_SINCE_LAST_TXN"))
        + " UNION ALL " + expectation("unique", UNIQUE, "BAD_FLAG", 2, 2, "count(DISTINCT BAD_FLAG)"),
        "dq_suite": base_cte(["MONTHS_SINCE_LAST_TXN", "TOTAL_CUSTOMERS"])
        + ", results AS ("
        + expectation("suite", UNIQUE, "MONTHS_SINCE_LAST_TXN", None, None, distinct("MONTHS_SINCE_LAST_TXN"))
        + " UNION ALL " + expectation("suite", MIN, "TOTAL_CUSTOMERS", 1, 1, filled("TOTAL_CUSTOMERS"))
        + ") SELECT *, (SELECT bool_and(success) FROM results) AS run_success FROM results",
        "dq_history": base_cte(["TOTAL_TRXNS"])
        + ", results AS ("
        + expectation("first", MIN, "TOTAL_TRXNS", -99999, None, filled("TOTAL_TRXNS"))
        + " UNION ALL " + expectation("first", UNIQUE, "BAD_FLAG", 2, 2, "count(DISTINCT BAD_FLAG)")
        + " UNION ALL " + expectation("second", MIN, "TOTAL_TRXNS", 1000000, None, filled("TOTAL_TRXNS"))
        + " UNION ALL " + expectation("second", UNIQUE, "BAD_FLAG", 2, 2, "count(DISTINCT BAD_FLAG)")
        + ") SELECT *, bool_and(success) OVER (PARTITION BY run_id) AS run_success FROM results",
        "dq_latest_batch": base_cte(["TOTAL_TRXNS"])
        + """, newest AS (
  SELECT * FROM base WHERE strftime(DISBURSED_DATE, '%Y-%m') = (SELECT max(strftime(DISBURSED_DATE, '%Y-%m')) FROM base)
) """
        + expectation("latest", MIN, "TOTAL_TRXNS", 0, None, filled("TOTAL_TRXNS"), "newest")
        + " UNION ALL " + expectation("latest", UNIQUE, "LOAN_ID", 1, None, "count(DISTINCT LOAN_ID)", "newest"),
        "feat_rolling_daily": family(q.rolling_names("DAILY")),
        "feat_rolling_monthly": family([*q.rolling_names("MONTHLY"), "CREDIT_EXTENDED_LAST_MONTH_VALUE"]),
        "feat_window_ratios": family(q.RATIO_NAMES),
        "feat_txn_size": family([f"AVG_TRAN_SIZE_{m}_MNTH_{v}" for v in ("DAILY", "MONTHLY") for m in (1, 2, 3)]),
        "feat_counterparty": family(q.counterparty_names()),
        "feat_settlement_ageing": family(["CREDIT_EXTENDED_TOTAL", *features.SETTLEMENT[1:]]),
        "feat_settlement_averages": family(q.settlement_average_names()),
        "feat_recovery_ratios": family(q.recovery_names()),
        "feat_recency": family(
            ["DAYS_SINCE_FIRST_TXN", "DAYS_SINCE_LAST_TXN", "MONTHS_SINCE_FIRST_TXN", "MONTHS_SINCE_LAST_TXN", "ACTIVATION_AGE"]
        ),
        "feat_totals_activity": family(
            [
                "TOTAL_ACCOUNTS", "PLATFORM_AGE", "TOTAL_CUSTOMERS", "NO_PLATFORM_CUSTOMERS",
                "DAYS_SINCE_FIRST_CUST_ADDED", "DAYS_SINCE_LAST_CUST_ADDED", "TOTAL_TRXNS", "TOTAL_TXN_MONTHS",
                "ACTIVE_ACCOUNTS", "ACTIVE_DAYS", "DEBIT_TRXNS", "CREDIT_TRXNS", "DEBIT_AMNT", "CREDIT_AMNT",
                "TOTAL_TXN_AMNT", "D_1_TXNS", "D_30_TXNS",
            ]
        ),
        "activity_features": activity_cte() + f" SELECT {ids}, {rounded_list(datasets.activity_names())} FROM base",
        "activity_woe_iv": activity_cte() + binned_cte(q.ACTIVITY_CUTS) + statistics_cte() + tests_cte()
        + f""" SELECT variable, bin_order, count, bad, {r6('badprob')} AS badprob, {r6('woe')} AS woe, {r6('bin_iv')} AS bin_iv,
{r6('total_iv')} AS total_iv, mtest, status FROM tested""",
        "variable_histogram_grid": FIXED_BASE + histogram_cte(q.FIXED_CUTS)
        + f"SELECT variable, special, {r6('start')} AS start, n, bad, {r6('low')} AS low, {r6('high')} AS high FROM histogram",
    }
    bins = f"""SELECT {{0}}variable, bin_order, lo, hi, count, good, bad, {r6('woe')} AS woe, {r6('total_iv')} AS total_iv"""
    share = config.HEAVY_SHARE
    search = (
        base_cte(all_names) + histogram_cte([*all_names, "LOAN_AMOUNT"], share, where=f"DISBURSED_DATE <= DATE '{data.split}'")
        + search_cte(config.SEARCH_ROUNDS) + tests_cte(group="variable, round") + settle_cte(config.SEARCH_ROUNDS) + " "
    )
    out["woebin_search"] = (
        search + bins.format("CAST(round AS INTEGER) AS round, status, ") + " FROM tested JOIN chosen USING (variable, round)"
    )
    out["search_round_counts"] = (
        search + """SELECT CAST(t.round AS INTEGER) AS round, status, count(DISTINCT variable) AS variables
FROM tested t JOIN chosen c USING (variable) WHERE t.round <= c.round GROUP BY t.round, status"""
    )
    one_round = q.ONE_ROUND
    out["category_bins"] = (
        base_cte([]) + """,
filled AS (SELECT BAD_FLAG, CASE WHEN SEGMENT IS NULL OR SEGMENT = '--' THEN 'missing' ELSE SEGMENT END AS category FROM base),
scores AS (SELECT category, floor(sum(BAD_FLAG) * 1000 / count(*)) / 1000 AS score FROM filled GROUP BY category),
scored AS (SELECT BAD_FLAG, score AS SEGMENT FROM filled JOIN scores USING (category))"""
        + histogram_cte(["SEGMENT"], share, source="scored") + search_cte(one_round)
        + f""" SELECT 'SEGMENT' AS variable, category, {r6('score')} AS score, CAST(bin_order AS INTEGER) AS bin_order, {r6('woe')} AS woe
FROM scores JOIN stats ON score >= lo AND score < hi"""
    )
    sample = f"DISBURSED_DATE BETWEEN DATE '{data.start}' AND DATE '{data.end}' AND DAYS_SINCE_LAST_TXN <= {data.max_recency}"
    train = f"DISBURSED_DATE <= DATE '{data.split}'"
    out["job_extract_all"] = (
        base_cte(all_names)
        + f"""SELECT LOAN_ID, DISBURSED_DATE, BAD_FLAG, coalesce(nullif(SEGMENT, '--'), 'missing') AS SEGMENT,
{", ".join(f"{r6(f'coalesce({n}, -99999)')} AS {n}" for n in ['LOAN_AMOUNT', *all_names])} FROM base WHERE {sample}"""
    )
    candidates = [*all_names, "LOAN_AMOUNT", "SEGMENT"]
    job_search = job_search_cte()
    out["job_bins"] = (
        job_search + " " + bins.format("CAST(round AS INTEGER) AS round, status, ") + " FROM tested JOIN chosen USING (variable, round)"
    )
    whole_rows = ", ".join(f"coalesce({v}, -99999)::DOUBLE AS {v}" for v in candidates)
    out["job_report"] = (
        job_search + f""",
final AS MATERIALIZED (SELECT * FROM tested JOIN chosen USING (variable, round)),
later AS MATERIALIZED (
  SELECT variable, BAD_FLAG, value FROM (UNPIVOT (SELECT BAD_FLAG, {whole_rows} FROM scored WHERE NOT {train}) ON {", ".join(candidates)} INTO NAME variable VALUE value)
),
later_counts AS (
  SELECT variable, bin_order, count(*) AS n, sum(BAD_FLAG) AS b FROM later JOIN final USING (variable)
  WHERE CASE WHEN is_special THEN value = -99999 ELSE value <> -99999 AND value >= lo AND value < hi END GROUP BY variable, bin_order
),
valued AS (
  SELECT 'train' AS split, variable, coalesce(woe, 0) AS woe, sum(bad)::DOUBLE AS bad, sum(good)::DOUBLE AS good FROM final GROUP BY ALL
  UNION ALL
  SELECT 'oot', variable, coalesce(woe, 0), sum(b)::DOUBLE, sum(n - b)::DOUBLE FROM later_counts JOIN final USING (variable, bin_order) GROUP BY ALL
)"""
        + AUC_OF_VALUED
        + f""",
words(variables, kind, Trend_Business) AS (VALUES {dictionary_values()}),
rising AS (SELECT variable, bool_or(test = 'Dec') AS up FROM final GROUP BY variable)
SELECT t.variable, p.var, CASE WHEN is_special THEN 'missing' ELSE '[' || {written('lo')} || ',' || {written('hi')} || ')' END AS bin,
       t.count, {r6('t.count_distr')} AS count_distr, t.good, t.bad, {r6('t.badprob')} AS badprob, {r6('t.woe')} AS woe, {r6('t.bin_iv')} AS bin_iv,
       {r6('t.total_iv')} AS total_iv, {r6('t.Prop_iv')} AS Prop_iv, t.Max_IV_test, t.IV_test,
       CASE WHEN is_special THEN 'missing' ELSE {written('hi')} END AS breaks, is_special AS is_special_values, CAST(t.counter AS INTEGER) AS counter, t.num_bin,
       CASE WHEN up THEN 'Increasing' ELSE 'Decreasing' END AS Trend, Trend_Business,
       {r6('Gini_train')} AS Gini_train, {r6('Gini_oot')} AS Gini_oot, {r6('Relative_diff')} AS Relative_diff
FROM final t JOIN rising USING (variable) LEFT JOIN performance p ON p.variable = t.variable LEFT JOIN words ON variables = t.variable"""
    )
    out["job_apply_saved"] = (
        job_search + f""",
accepted AS (SELECT variable, is_special, lo, hi, woe FROM tested JOIN chosen USING (variable, round) WHERE status = 'accepted'),
applied AS (
  UNPIVOT (SELECT LOAN_ID, {', '.join(f'coalesce({v}, -99999)::DOUBLE AS {v}' for v in candidates)} FROM scored)
  ON {', '.join(candidates)} INTO NAME variable VALUE value
)
SELECT LOAN_ID, variable || '_WOE' AS variable, {r6('coalesce(woe, 0)')} AS woe
FROM (SELECT * FROM applied WHERE variable IN (SELECT variable FROM accepted)) LEFT JOIN accepted USING (variable)
WHERE CASE WHEN is_special THEN value = -99999 ELSE value <> -99999 AND value >= lo AND value < hi END
UNION ALL
SELECT LOAN_ID, variable || '_WOE', 0.0 FROM applied WHERE value = -99999
AND variable IN (SELECT variable FROM accepted) AND variable NOT IN (SELECT variable FROM accepted WHERE is_special)"""
    )
    whole = f" {bins.format('')}, is_special, {r6('count_distr')} AS count_distr, {r6('badprob')} AS badprob, {r6('bin_iv')} AS bin_iv FROM stats"
    out["woebin_fit"] = FIXED_BASE + histogram_cte(q.FIXED_CUTS, share) + search_cte(one_round) + whole
    out["woebin_merge"] = (FIXED_BASE + histogram_cte(q.FIXED_CUTS, share) + merge_cte(*one_round[0])).replace("WITH ", "WITH RECURSIVE ", 1) + whole
    out["roc_points"] = roc_cte() + f"""
SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT p_bad, {r6('goods / all_good')}, {r6('bads / all_bad')} FROM ranked WHERE next_bad IS NULL OR bad * next_good <> next_bad * good"""
    area = "sum(good * (bads - bad / 2)) / max(all_bad * all_good)"
    out["roc_area"] = roc_cte() + f"SELECT {r6(area)} AS auc, {r6(f'2 * ({area}) - 1')} AS gini FROM ranked"
    return out
