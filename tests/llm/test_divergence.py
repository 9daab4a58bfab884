import re
from collections import Counter, defaultdict

import pytest
from helpers import SCHEMA, documents, rows_of
from pyspark.sql import functions as F

from creditflow.llm import common, divergence

PATTERN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(rows, least):
    """From the definition: every pair of groups over every kept term."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        terms = PATTERN.findall((text or "").translate(LOWER))
        groups.add((lang or "", source or ""))
        n[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, k in docs[lang].items() if k >= least)
        mine = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in mine:
            whole.update(n[lang, s])

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(whole)
        for s in mine:
            p = shares(n[lang, s])
            pairs = [(o, sum(abs(p[t] - x) for t, x in shares(n[lang, o]).items())) for o in mine if o != s]
            terms = [(t, p[t] - q[t]) for t in kept if n[lang, s][t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ordered, 1)]
    return sorted(out, key=repr)


def some_rows(groups=9, docs=12):
    words = "aa ab ac ad ae af ag été über Zz zz mot".split()
    rows = []
    for g in range(groups):
        for d in range(docs):
            text = " ".join(words[(g * 7 + d * k * k) % len(words)] for k in range(1, 3 + (g + d) % 9))
            rows.append((g * docs + d, text + ", 12! x_y", ("en", "fr", None)[g % 3], f"s{g // 3 * 31 % 8}" if g else None, 1))
    return rows


def test_pairs_and_terms(spark):
    rows = some_rows()
    assert rows_of(divergence.source_divergence(documents(spark, rows), least_documents=6)) == brute_force(rows, 6)


def test_blocks_and_tiles(spark, monkeypatch):
    """Several blocks a language and several tiles of groups give the same sums."""
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 2)
    monkeypatch.setattr(divergence, "TILE", 2)
    rows = some_rows(24, 6)
    assert rows_of(divergence.source_divergence(documents(spark, rows), least_documents=4)) == brute_force(rows, 4)


def test_flushes(spark, monkeypatch):
    monkeypatch.setattr(divergence, "MOST_HELD", 3)
    rows = some_rows()
    assert rows_of(divergence.source_divergence(documents(spark, rows), least_documents=3)) == brute_force(rows, 3)


@pytest.mark.parametrize("least", [1, 2, 30])
def test_hard_rows(spark, least):
    docs = documents(spark, clashing=True)
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in docs.collect()]
    got = rows_of(divergence.source_divergence(docs, least_documents=least))
    assert got == brute_force(rows, least)
    assert least < 30 or {r[4] for r in got} == {0}


def test_empty_table(spark):
    assert divergence.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_table(spark):
    docs = common.read_documents(spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert rows_of(divergence.source_divergence(docs)) == brute_force(rows, divergence.LEAST_DOCUMENTS)


def test_runs_are_few(spark):
    """Equal counts lie side by side: far fewer runs than cells."""
    docs = common.read_documents(spark, "/root/testdata/sf0.01")
    terms = divergence.kept_terms(divergence.term_counts(docs), 2)
    runs = divergence.run_columns(terms).select(F.size("counts").alias("runs"), "size").agg(F.sum("runs"), F.sum("size")).first()
    assert runs[0] < 0.5 * runs[1]


def test_shares_need_more_than_64_bits():
    counts = divergence.np.array([0, 10**13, 10**13, 7], dtype="int64")
    assert divergence.shares(counts, 3 * 10**13, 4).tolist() == [1 + 10**9 * (c + 5) // (3 * 10**13 + 20) for c in counts.tolist()]
