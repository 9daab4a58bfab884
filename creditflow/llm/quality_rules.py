"""Weak supervision: rules vote on a text or abstain, and an estimated label model weighs the votes.

Every rule looks at one signal and votes good (1), bad (0) or abstains. Expectation-maximisation over the counts
of vote patterns finds each rule's accuracy and the share of good texts without any label; a text is kept by the
posterior probability that it is good, so one bad vote alone does not remove it.

Nulls and empty texts have zero signals: every ratio rule abstains and ``base_failed`` is true. Rows are judged
one by one, so repeated rows and ids get equal results. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import common
from creditflow.session import stage

# Priors of the label model: accuracies on good and on bad texts, their weight as a share of all texts, share of
# good texts; and the limits that accuracies stay in.
PRIOR_ON_GOOD = 0.99
PRIOR_ON_BAD = 0.4
PRIOR_WEIGHT = 0.05
PRIOR_GOOD = 0.85
LIMITS_ON_GOOD = (0.97, 0.9999)
LIMITS_ON_BAD = (0.15, 0.95)

SYMBOLS = b"#*$%&|<>"
ASCII_UPPER = bytes(range(65, 91))
ASCII_LETTERS = ASCII_UPPER + bytes(range(97, 123))
# ASCII characters that are neither white space, letter, digit nor plain punctuation.
OTHER = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"?()-")
# A word that ends in a symbol or an exclamation mark.
MARKED = re.compile(rb"[#*$%&|<>!](?=\s|$)")

SIGNALS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_same_neighbours long, n_upper long, n_letters long, n_exclaims long, n_distinct long, n_marked_words long, n_other long"
)
SIGNAL_NAMES = [part.split()[0] for part in SIGNALS.split(",")]


@dataclass(frozen=True)
class Rule:
    """Votes good where ``signal`` lies in [good_low, good_high], bad outside [bad_low, bad_high], else abstains."""

    name: str
    signal: str
    bad_low: float
    good_low: float
    good_high: float
    bad_high: float


# The signal of each rule as a ratio, and the limits of its votes.
RULES = (
    Rule("length", "n_words", 20, 50, 1e18, 1e18),
    Rule("word_length", "word_chars / n_words", 2, 3, 12, 16),
    Rule("symbols", "n_symbols / n_words", 0, 0, 0.05, 0.2),
    Rule("repeated_lines", "n_dup_lines / n_lines", 0, 0, 0.15, 0.4),
    Rule("repeated_words", "n_repeat_words / n_words", 0, 0, 0.15, 0.4),
    Rule("same_neighbours", "n_same_neighbours / n_words", 0, 0, 0.05, 0.2),
    Rule("shouting", "n_upper / n_letters", 0, 0, 0.15, 0.4),
    Rule("marked_words", "n_marked_words / n_words", 0, 0, 0.03, 0.12),
    Rule("other_characters", "n_other / word_chars", 0, 0, 0.02, 0.06),
    Rule("exclaiming", "n_exclaims / n_words", 0, 0, 0.05, 0.2),
)


def count_without(raw: bytes, characters: bytes) -> int:
    """How many bytes of ``raw`` are one of ``characters``."""
    return len(raw) - len(raw.translate(None, characters))


def word_ids(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Each word as a number that equal words share, and how many numbers there are."""
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(ids.__getitem__, words), np.int64, len(words)), len(ids)


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside three-word windows that occur at least twice; the first occurrence counts too."""
    if len(ids) < 4 or distinct == len(ids):
        return 0
    _, pairs = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)
    windows = pairs[:-1] * distinct + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    starts = np.concatenate((order[1:][same], order[:-1][same]))
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[starts + shift] = True
    return int(covered.sum())


def text_signals(text: str | None) -> tuple:
    """The counts named in ``SIGNALS`` over the whole text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    ids, distinct = word_ids(words)
    return (
        len(words),
        len(text) - count_without(raw, common.WHITE_SPACE),
        count_without(raw, SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(ids, distinct),
        len(lines),
        int(np.count_nonzero(ids[1:] == ids[:-1])),
        count_without(raw, ASCII_UPPER),
        count_without(raw, ASCII_LETTERS),
        raw.count(b"!"),
        distinct,
        len(MARKED.findall(raw)),
        count_without(raw, OTHER),
    )


def signals(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and the counts of ``SIGNALS``. Other columns are not read."""
    measured = docs.select(F.col(id_column).alias("doc_id"), common.struct_udf(SIGNALS, text_signals)(F.col(text_column)).alias("s"))
    return measured.select("doc_id", "s.*")


def vote(rule: Rule):
    """'1', '0' or '-' as a column over the signals; a ratio over nothing abstains."""
    top, _, bottom = (part.strip() for part in rule.signal.partition("/"))
    value = F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")) if bottom else F.col(top).cast("double")
    return (
        F.when(value.isNull(), "-")
        .when(value.between(rule.good_low, rule.good_high), "1")
        .when((value < rule.bad_low) | (value > rule.bad_high), "0")
        .otherwise("-")
    )


def fit_label_model(patterns: list[str], counts: list[int], n_rules: int, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Accuracy of each rule on good and on bad texts, share of good texts, and posterior of good for each pattern.

    Accuracies are of the votes cast; an abstention says nothing. A rule notices one kind of fault, so it is nearly
    always right on good texts and often wrong on bad ones: each accuracy has a prior that says so, which also fixes
    what the two hidden classes mean. Without any pattern the priors are the result.
    """
    votes = np.array([[{"1": 1, "0": -1}.get(v, 0) for v in p] for p in patterns], dtype=float).reshape(len(patterns), n_rules)
    weight = np.array(counts, dtype=float)
    weight /= max(1.0, weight.sum())
    says_good, says_bad = (votes > 0).astype(float), (votes < 0).astype(float)
    on_good, on_bad, share = np.full(n_rules, PRIOR_ON_GOOD), np.full(n_rules, PRIOR_ON_BAD), PRIOR_GOOD

    def posterior() -> np.ndarray:
        odds = np.log(share / (1 - share)) + says_good @ np.log(on_good / (1 - on_bad)) + says_bad @ np.log((1 - on_good) / on_bad)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    def rate(right: np.ndarray, wrong: np.ndarray, prior: float) -> np.ndarray:
        return (right + PRIOR_WEIGHT * prior) / (right + wrong + PRIOR_WEIGHT)

    for _ in range(rounds if len(patterns) else 0):
        good = posterior()
        on_good = np.clip(rate(says_good.T @ (weight * good), says_bad.T @ (weight * good), PRIOR_ON_GOOD), *LIMITS_ON_GOOD)
        on_bad = np.clip(rate(says_bad.T @ (weight * (1 - good)), says_good.T @ (weight * (1 - good)), PRIOR_ON_BAD), *LIMITS_ON_BAD)
        share = float(np.clip((weight * good).sum(), 0.5, 0.99))
    return on_good, on_bad, share, posterior()


def judge(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` with ``quality_probability`` added; ``measured`` is read twice, so pass a stored table.

    The driver gets the counts of vote patterns: at most three to the power of the number of rules.
    """
    spark = measured.sparkSession
    voted = measured.withColumn("votes", F.concat(*[vote(r) for r in rules]))
    seen = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    patterns = [r["votes"] for r in seen]
    *_, good = fit_label_model(patterns, [r["n"] for r in seen], len(rules))
    table = spark.createDataFrame(list(zip(patterns, map(float, good), strict=True)), "votes string, quality_probability double")
    return voted.join(F.broadcast(table), "votes").select(*measured.columns, "quality_probability")


def quality_rules(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """Signals, posterior and verdict of every document.

    ``base_failed`` marks texts of under 50 words or with over half of their words in repeated windows; they are
    never kept. All others are kept if the posterior is at least ``threshold``.
    """
    judged = judge(stage(signals(docs, id_column, text_column), "quality-signals"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("quality_probability") >= threshold))
