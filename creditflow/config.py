"""Parameters shared by every job."""

from __future__ import annotations

from dataclasses import dataclass, field

from creditflow.operators import quality

# Sentinels, thresholds and dates that the results depend on.
MISSING_NUMERIC = -99999.0
MISSING_CATEGORY = "missing"
NULL_TOKEN = "--"
IV_THRESHOLD = 0.02
MIN_BIN_IV_SHARE = 0.05
PCA_VARIANCE_SHARE = 0.75
MAX_RECENCY_DAYS = 90
START_DATE = "2021-08-01"
END_DATE = "2022-07-31"
SPLIT_DATE = "2022-06-30"
MODEL_NO = 103138

# The binning search runs every bin limit from 10 down to 2, each with these
# smallest bin shares, in this order.
BIN_SHARES = (0.02, 0.05, 0.1)
BIN_LIMITS = tuple(range(10, 1, -1))
SEARCH_ROUNDS = tuple((limit, share) for limit in BIN_LIMITS for share in BIN_SHARES)

# Histogram: a bucket of several values with more than this share of the rows is counted again with more digits.
HEAVY_SHARE = 0.02
# Greedy binning: the relative gain in information value below which it stops splitting.
MIN_IV_GAIN = 0.1

ID_COLUMNS = ("USER_ID", "LOAN_ID", "DISBURSED_DATE")
TARGET = "BAD_FLAG"
OUTCOME_COLUMNS = ("EVER11DPD_IN_90DAYS", "BAD_FLAG", "EVER15DPD_IN_60DAYS")


@dataclass(frozen=True)
class Dataset:
    """One lending product: where its sample starts, ends and splits, and what its data must satisfy."""

    name: str
    start: str = START_DATE
    end: str = END_DATE
    split: str = SPLIT_DATE
    recency_column: str | None = "DAYS_SINCE_LAST_TXN"
    max_recency: int = MAX_RECENCY_DAYS
    target: str = TARGET
    exclude: tuple[str, ...] = field(default=ID_COLUMNS + OUTCOME_COLUMNS)
    suite: tuple[quality.Expectation, ...] = quality.TEST_SUITE


# The two products, over the dates that the test tables cover.
TRANSACTIONS = Dataset("transactions", "1997-01-01", "2001-07-31", "2000-06-30")
ACTIVITY = Dataset("activity", "2024-01-01", "2024-01-31", "2024-01-24", recency_column=None, suite=quality.ACTIVITY_SUITE)
