import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import SCHEMA, documents
from pyspark.sql import functions as F

from creditflow.llm import common, katz
from creditflow.llm.queries import op13_katz_backoff

LOWER = {c: c + 32 for c in range(65, 91)}
END, START = None, 0


def tokens_of(text):
    return [w.decode() for w in (text or "").translate(LOWER).encode().split()] + [END]


class Model:
    """Katz backoff from the definition: dictionaries and recursion, one token at a time."""

    def __init__(self, texts, order):
        self.counts = [Counter() for _ in range(order + 1)]
        for tokens in texts:
            padded = [START] * (order - 1) + tokens
            for i in range(order - 1, len(padded)):
                for n in range(1, order + 1):
                    self.counts[n][tuple(padded[i - n + 1 : i + 1])] += 1
        self.discounts = [None] + [katz.good_turing([sum(c == j for c in self.counts[n].values()) for j in range(1, 7)]) for n in range(1, order + 1)]
        self.after = defaultdict(dict)
        for n in range(1, order + 1):
            for gram, c in self.counts[n].items():
                self.after[gram[:-1], n][gram[-1]] = c
        self.order, self.known = order, {}

    def kept(self, n, c):
        return c * (self.discounts[n][c] if c <= katz.LIMIT else 1.0)

    def context(self, h):
        """Divisor of the counts after ``h`` and backoff weight."""
        if h not in self.known:
            n, seen = len(h) + 1, self.after[h, len(h) + 1]
            total = sum(seen.values())
            taken = sum(c - self.kept(n, c) for c in seen.values())
            if taken <= 0:
                total, taken = total + 1, 1
            rest = 1 - sum(self.probability(w, h[1:]) for w in seen) if h else 1
            self.known[h] = total, taken / total / rest
        return self.known[h]

    def probability(self, w, h):
        seen = self.after.get((h, len(h) + 1))
        if not seen:
            return self.probability(w, h[1:]) if h else 1.0
        divisor, weight = self.context(h)
        if w in seen:
            return self.kept(len(h) + 1, seen[w]) / divisor
        return weight * (self.probability(w, h[1:]) if h else 1.0)


def brute_force(rows, order):
    """``rows``: doc_id, text, trains, held out."""
    texts = [tokens_of(text) for _, text, trains, _ in rows if trains]
    model = Model(texts, order)
    c = Counter(w for t in texts for w in t)
    total, types = sum(c.values()), len(c)
    out = []
    for doc_id, text, _, held_out in rows:
        tokens = tokens_of(text)
        padded = [START] * (order - 1) + tokens
        base = sum(math.log10((c[w] + 1) / (total + types + 1)) for w in tokens)
        score = sum(math.log10(model.probability(padded[i], tuple(padded[i - order + 1 : i]))) for i in range(order - 1, len(padded)))
        out.append((doc_id, held_out, len(tokens), sum(c[w] > 0 for w in tokens), total, base, score))
    return sorted(out, key=lambda r: repr(r[:5])), model


def some_rows(n=60, words=14, seed=3):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(f"{'W' if k % 5 else 'é'}{min(pick.randrange(words), pick.randrange(words))}" for k in range(pick.randrange(0, 25)))
        rows.append((i, text, None, None, None))
    return rows


def scored(docs, order, fold="crc32(cast(cast(doc_id as string) as binary)) % 7"):
    got = katz.score_texts(docs, F.expr(f"{fold} != 2"), F.expr(f"{fold} = 2"), order)
    return sorted((tuple(r) for r in got.collect()), key=lambda r: repr(r[:5]))


def given(docs, fold="crc32(cast(cast(doc_id as string) as binary)) % 7"):
    found = docs.select("doc_id", "text", F.coalesce(F.expr(f"{fold} != 2"), F.lit(False)), F.coalesce(F.expr(f"{fold} = 2"), F.lit(False)))
    return [tuple(r) for r in found.collect()]


def assert_same(got, want):
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, order):
    docs = documents(spark, some_rows())
    assert_same(scored(docs, order), brute_force(given(docs), order)[0])


@pytest.mark.parametrize("order", [2, 3])
def test_many_blocks_and_buckets_and_split_contexts(spark, monkeypatch, order):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 40)
    monkeypatch.setattr(katz, "BUCKET_NGRAMS", 60)
    monkeypatch.setattr(katz, "HOT", 25)
    docs = documents(spark, some_rows()).repartition(3)
    assert_same(scored(docs, order), brute_force(given(docs), order)[0])


@pytest.mark.parametrize("order", [2, 3])
def test_hard_rows(spark, order):
    docs = documents(spark, clashing=True)
    assert_same(scored(docs, order), brute_force(given(docs), order)[0])


def test_without_training_texts(spark):
    got = scored(documents(spark), 2, "2")
    assert {r[4:] for r in got} == {(0, 0.0, 0.0)} and all(r[1] for r in got)


def test_all_counts_over_the_limit(spark):
    """Nothing to discount: the contexts' totals count one more."""
    docs = documents(spark, [(i, "a b a b", None, None, None) for i in range(40)] + [(100, "b a zz", None, None, None)])
    assert_same(scored(docs, 2), brute_force(given(docs), 2)[0])


def test_empty_table(spark):
    assert katz.score_texts(spark.createDataFrame([], SCHEMA), F.lit(True), F.lit(False)).count() == 0


def test_given_table(spark):
    docs = common.read_documents(spark, "/root/testdata/sf0.001")
    got = sorted((tuple(r) for r in op13_katz_backoff(spark, "/root/testdata/sf0.001").collect()), key=lambda r: repr(r[:5]))
    want, model = brute_force(given(docs), katz.ORDER)
    assert_same(got, want)
    # the probabilities after a context add up to 1, over all known words and the unknown one
    words = {gram[0] for gram in model.counts[1]} | {"not a word"}
    contexts = [(START,), ("never seen",), *[(w,) for w in sorted(w for w in words if w)[:40]]]
    for h in contexts:
        assert abs(sum(model.probability(w, h) for w in words) - 1) < 1e-9
    assert 0 < min(katz.good_turing([100, 40, 20, 12, 8, 6])[1:]) < max(katz.good_turing([100, 40, 20, 12, 8, 6])) < 1


def test_pack_round_trip():
    arrays = [np.array([], np.int64), np.array([0, 1, 300]), np.array([2**63 + 5, 1], np.uint64), np.array([0.5, -1.25]), np.array([True, False]), np.array([-3, 7])]
    for a, b in zip(arrays, katz.unpack(katz.pack(*arrays)), strict=True):
        assert a.tolist() == b.tolist()
