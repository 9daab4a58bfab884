import re
from collections import defaultdict

import pytest
from helpers import documents

from creditflow.llm import common, source_mixing


def water_fill(sizes):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: source_mixing.SOURCE_WEIGHTS[i % 3] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def check(rows, got):
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for _, text, *_ in rows]
    by_source, largest = defaultdict(int), defaultdict(int)
    for r, n in zip(rows, sizes, strict=True):
        by_source[r[3]] += n
        largest[r[3]] = max(largest[r[3]], n)
    want = water_fill(by_source)
    assert sorted(r["size"] for r in got) == sorted(sizes)
    return by_source, largest, want


def test_given_table(spark):
    docs = common.read_documents(spark, "/root/testdata/sf0.01")
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    got = source_mixing.mix_sizes(docs).collect()
    by_source, largest, want = check(rows, got)
    source_of, taken = {r[0]: r[3] for r in rows}, defaultdict(int)
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == by_source[s] and r["target"] == pytest.approx(want[s])
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        # complete epochs come first
        assert r["taken"] // max(1, r["size"]) >= int(want[s] // by_source[s])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)
    again = source_mixing.mix_sizes(docs.repartition(9)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_hard_rows(spark):
    got = source_mixing.mix_sizes(documents(spark, clashing=True)).collect()
    from helpers import hard_documents

    by_source, _, want = check(hard_documents(), got)
    assert len(got) == 13 and sum(want.values()) == pytest.approx(sum(by_source.values()))
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert source_mixing.mix_sizes(documents(spark, [])).count() == 0


def test_caps_are_reshared(spark):
    rows = [(i, "w " * n, None, s, None) for i, (s, n) in enumerate([("a", 100), ("a", 100), ("b", 1), ("c", 2), (None, 50)])]
    got = source_mixing.mix_sizes(documents(spark, rows)).collect()
    _, _, want = check(rows, got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["target"] == 3 and by_id[3]["target"] == 6 and by_id[2]["taken"] == 3
    assert by_id[0]["target"] == pytest.approx(want["a"]) and by_id[4]["target"] == pytest.approx(want[None])


def test_rows_are_repeated_as_taken(spark):
    docs = documents(spark, clashing=True)
    mixed = source_mixing.mix(docs)
    assert mixed.dtypes == docs.dtypes
    taken = sum(r["taken"] for r in source_mixing.mix_sizes(docs).collect())
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in mixed.collect()) == taken


def test_quality_weights_matter(spark):
    rows = [(i, ("good word " * 10) if i % 2 else ("### $$$ " * 10), None, "s", None) for i in range(2000)]
    rows += [(5000 + i, "x " * 20, None, "t", None) for i in range(1000)]
    got = source_mixing.mix_sizes(documents(spark, rows)).collect()
    first = [r for r in got if r["doc_id"] < 5000]
    good = sum(r["taken"] for r in first if r["doc_id"] % 2)
    assert 0.6 < good / sum(r["taken"] for r in first) < 0.95
