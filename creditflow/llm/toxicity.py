"""Toxicity by a classifier chain: linear models in sequence, each fed the earlier categories' probabilities.

Categories are learned one after the other. The model of a category sees hashed words and word beginnings, and the
probabilities of all earlier categories. For training, those probabilities are out of fold: each row gets them from
models that did not see it, so a later model learns from values of the kind that it will meet.

Where only one toxic mark is given, categories are derived from it: terms that stand mostly in marked texts are
mined from the sample, and a marked text is ``abusive`` if it has any, ``repeated`` if it has several. The chain ends
with ``toxic``, the mark itself.

Null and empty texts have no features and get the models' base scores. Rows are scored one by one, so repeated
rows get equal scores; an empty table gives an empty result. Without marks of both kinds a category's probability
is the share of ones, 0.5 if there is none. Labels other than 0 and 1 are not used; of repeated ones the largest
counts.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditflow.llm import common, quality_classifier, sparse

CATEGORIES = ("abusive", "repeated", "toxic")
MAX_TRAINING_ROWS = 6000
BUCKETS = 1 << 18
# Lengths of the word beginnings, which stand for inflected and compound forms.
BEGINNINGS = (4, 5, 6, 7)
FOLDS = 3
EPOCHS = 6
# Toxic texts are few and a missed one costs more than a false alarm: under one half.
THRESHOLD = 0.3
# A feature is used if it stands in at least so many texts of the sample and its number of marked ones is so many
# standard deviations from what chance gives; it is a term of abuse if at least this share of its texts is marked.
LEAST_TEXTS = 5
LEAST_DEVIATION = 4.0
TERM_SHARE = 0.8
REPEATED = 5

WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> list[int]:
    """Buckets of the distinct lower-case words and of their beginnings, sorted."""
    words = set(WORD.findall((text or "").lower()))
    tokens = {b"w" + w.encode() for w in words} | {b"b" + w[:n].encode() for w in words for n in BEGINNINGS if len(w) > n}
    return sorted({common.feature_hash(t, BUCKETS) for t in tokens})


def telling(found: list[list[int]], marks: np.ndarray) -> np.ndarray:
    """Features whose share in marked texts differs significantly from the others', as a mask."""
    lengths = [len(i) for i in found]
    flat = np.fromiter((x for i in found for x in i), np.int64, sum(lengths))
    texts = np.bincount(flat, minlength=BUCKETS).astype(float)
    marked = np.bincount(flat, np.repeat(marks, lengths), minlength=BUCKETS)
    share = marks.mean() if len(marks) else 0.5
    return (texts >= LEAST_TEXTS) & (np.abs(marked - texts * share) >= LEAST_DEVIATION * np.sqrt(texts * share * (1 - share)) + 1e-9)


def derive_categories(found: list[list[int]], marks: np.ndarray) -> np.ndarray:
    """A column for each of ``CATEGORIES``, from features and the toxic mark."""
    inside = np.zeros(BUCKETS)
    for indices, mark in zip(found, marks, strict=True):
        if mark:
            inside[indices] += 1
    share = np.bincount(np.array([x for i in found for x in i], dtype=np.int64), minlength=BUCKETS)
    terms = telling(found, marks) & (inside >= TERM_SHARE * share)
    hits = np.array([terms[i].sum() for i in found], dtype=int)
    toxic = marks > 0
    return np.stack([toxic & (hits >= 1), toxic & (hits >= REPEATED), toxic], axis=1).astype(float)


def with_chain(found: list[list[int]], earlier: np.ndarray) -> sparse.Rows:
    """Text features with value 1, then the earlier categories' probabilities."""
    extra = list(range(BUCKETS, BUCKETS + earlier.shape[1]))
    return sparse.Rows.of([(i + extra, [1.0] * len(i) + list(e)) for i, e in zip(found, earlier, strict=True)])


def fit_one(found: list[list[int]], earlier: np.ndarray, marks: np.ndarray) -> sparse.Model:
    mask = telling(found, marks)
    return sparse.fit(with_chain([[x for x in i if mask[x]] for i in found], earlier), marks, BUCKETS + len(CATEGORIES), 0, EPOCHS)


def fit_chain(found: list[list[int]], categories: np.ndarray) -> list[sparse.Model]:
    """One model per column of ``categories``, in order."""
    fold = np.arange(len(found)) % FOLDS
    earlier, models = np.zeros((len(found), 0)), []
    for c in range(categories.shape[1]):
        models.append(fit_one(found, earlier, categories[:, c]))
        held_out = np.zeros(len(found))
        for f in range(FOLDS):
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(outside):
                model = fit_one([found[i] for i in inside], earlier[inside], categories[inside, c])
                held_out[outside] = model.score(with_chain([found[i] for i in outside], earlier[outside]))
        earlier = np.column_stack((earlier, held_out))
    return models


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", eligible: Column | None = None) -> list[sparse.Model]:
    """The chain from a bounded sample, see ``MAX_TRAINING_ROWS``."""
    drawn = quality_classifier.draw(labels, id_column, label_column, MAX_TRAINING_ROWS, eligible)
    found = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("whole")).join(F.broadcast(drawn), F.col("doc_id") == F.col("of_id"))
    featured = found.select("doc_id", "mark", common.struct_udf("i array<int>", lambda text: (features(text),))("whole")["i"].alias("i"))
    sample = featured.orderBy("doc_id", "mark", "i").limit(MAX_TRAINING_ROWS).collect()
    marks = np.array([r["mark"] for r in sample], dtype=float)
    indices = [r["i"] for r in sample]
    models = fit_chain(indices, derive_categories(indices, marks))
    return [sparse.Model(m.bias, m.weights.astype(np.float32), m.factors) for m in models]


def predict(docs: DataFrame, models: list[sparse.Model], id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, a probability per category, ``score`` (the last one's) and ``predicted``."""

    def rate(text: str | None) -> tuple:
        indices = features(text)
        earlier = np.zeros((1, 0))
        for model in models:
            earlier = np.column_stack((earlier, model.score(with_chain([indices], earlier))))
        return tuple(float(x) for x in earlier[0])

    schema = ", ".join(f"{c} double" for c in CATEGORIES)
    scored = docs.select(F.col(id_column).alias("doc_id"), common.struct_udf(schema, rate)(F.col(text_column)).alias("s"))
    return scored.select("doc_id", "s.*", F.col(f"s.{CATEGORIES[-1]}").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
