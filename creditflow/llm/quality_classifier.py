"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Every pair of features interacts through low-rank factors; a text is scored in time linear in its features by the
sum-of-squares identity. Training uses a bounded sample of labelled rows; the whole text of every document is
scored.

Null and empty texts have only their structure features and get a score like any other. Rows are scored one by
one, so repeated rows get equal scores; an empty table gives an empty result. Labels other than 0 and 1 are not
used; of repeated labels the largest counts. Without labels of both kinds every score is the share of ones, 0.5
if there is none.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.llm import common, quality_rules, sparse

# Labelled rows that the model is fitted on, at most; drawn by a hash of the id.
MAX_TRAINING_ROWS = 6000
WORD_BUCKETS = 1 << 13
RANK = 8
EPOCHS = 8
THRESHOLD = 0.3

# Structure statistics as ratios, and the limits between their steps.
RATIOS = (
    ("word_chars", "n_words", (2, 3, 4, 5, 6, 8, 12)),
    ("n_symbols", "n_words", (0.001, 0.01, 0.05, 0.1, 0.3, 0.6, 1)),
    ("n_dup_lines", "n_lines", (0.01, 0.05, 0.1, 0.2, 0.4, 0.7)),
    ("n_repeat_words", "n_words", (0.02, 0.05, 0.1, 0.2, 0.4, 0.7, 0.95)),
    ("n_same_neighbours", "n_words", (0.005, 0.02, 0.05, 0.1, 0.3, 0.6, 0.9)),
    ("n_upper", "n_letters", (0.005, 0.02, 0.04, 0.08, 0.15, 0.3, 0.6)),
    ("n_exclaims", "n_words", (0.005, 0.02, 0.05, 0.1, 0.3, 0.6, 0.9)),
    ("n_distinct", "n_words", (0.05, 0.1, 0.2, 0.4, 0.6, 0.8)),
    ("n_lines", "n_words", (0.005, 0.01, 0.02, 0.05, 0.1, 0.2)),
)
# Steps of metadata: powers of two of the numbers of words and of characters.
SIZES = ("n_words", "word_chars")
MOST_POWER = 24
STEPS_PER_RATIO = 8
SIZE = WORD_BUCKETS + len(RATIOS) * STEPS_PER_RATIO + len(SIZES) * (MOST_POWER + 1)


def features(text: str | None) -> tuple[list[int], list[float]]:
    """Indices and values of a text's features; the words' part has length 1 as a vector."""
    counted = dict(zip(quality_rules.SIGNAL_NAMES, quality_rules.text_signals(text), strict=True))
    words = Counter((text or "").lower().encode().split())
    hashed: dict[int, float] = {}
    for word, n in words.items():
        slot = common.feature_hash(word, WORD_BUCKETS)
        hashed[slot] = hashed.get(slot, 0.0) + math.log1p(n)
    length = math.sqrt(sum(v * v for v in hashed.values())) or 1.0
    indices, values = list(hashed), [v / length for v in hashed.values()]
    base = WORD_BUCKETS
    for top, bottom, limits in RATIOS:
        if counted[bottom]:
            ratio = counted[top] / counted[bottom]
            indices.append(base + sum(ratio >= x for x in limits))
        base += STEPS_PER_RATIO
    for name in SIZES:
        indices.append(base + min(MOST_POWER, counted[name].bit_length()))
        base += MOST_POWER + 1
    return indices, values + [0.5] * (len(indices) - len(values))


def draw(labels: DataFrame, id_column: str, label_column: str, most: int, eligible: Column | None = None) -> DataFrame:
    """At most ``most`` labelled ids, ``of_id`` and ``mark``, drawn by a hash of the id among those that ``eligible`` admits."""
    marked = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
    if eligible is not None:
        marked = marked.where(eligible)
    marked = marked.groupBy(F.col(id_column).alias("of_id")).agg(F.max(label_column).cast("int").alias("mark"))
    return marked.orderBy(F.xxhash64("of_id"), "of_id").limit(most)


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality", eligible: Column | None = None) -> sparse.Model:
    """The model from a bounded sample, see ``MAX_TRAINING_ROWS``."""
    drawn = draw(labels, id_column, label_column, MAX_TRAINING_ROWS, eligible)
    found = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("whole")).join(F.broadcast(drawn), F.col("doc_id") == F.col("of_id"))
    featured = found.select("doc_id", "mark", common.struct_udf("i array<int>, v array<float>", features)("whole").alias("f"))
    found = featured.select("doc_id", "mark", "f.i", "f.v").orderBy("doc_id", "mark", "i").limit(MAX_TRAINING_ROWS).collect()
    marks = np.array([r["mark"] for r in found], dtype=float)
    model = sparse.fit(sparse.Rows.of([(r["i"], r["v"]) for r in found]), marks, SIZE, RANK, EPOCHS)
    return sparse.Model(model.bias, model.weights.astype(np.float32), model.factors.astype(np.float32))


def score(docs: DataFrame, model: sparse.Model, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, score, predicted``."""

    def rate(text: str | None) -> tuple[float]:
        return (float(model.score(sparse.Rows.of([features(text)]))[0]),)

    scored = docs.select(F.col(id_column).alias("doc_id"), common.struct_udf("score double", rate)(F.col(text_column)).alias("s"))
    return scored.select("doc_id", "s.score").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
