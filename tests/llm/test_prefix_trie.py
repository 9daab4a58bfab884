import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from helpers import rows_of

from creditflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, score string, hash string"


def brute_force(rows):
    """From the definition: every prefix of every rebuilt conversation; remainders have the sign of the id, as in SQL."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv_id].append(((turn is not None, turn or 0, key), (role, text)))
    original = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c in original:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(original.get(c - int(math.fmod(c, 5)), [])[:h] + original[c][h:])
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        leaves[prefix] = sum(leaves[x] for x in children[prefix]) if children[prefix] else 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        saved[prefix] = own + sum(saved[x] for x in children[prefix])
    out = []
    for prefix, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(rebuilt[c]) == len(prefix)))
        above = min(members[prefix[:-1]]) if prefix else None
        out.append((min(cs), len(prefix), above, len(cs), len(children[prefix]), leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def random_turns(seed, convs, longest):
    """Few different turns, so that prefixes of all lengths are shared; many copies, also of the whole."""
    pick = random.Random(seed)
    rows = []
    for c in range(convs):
        n = pick.choice((1, 2, 3, longest))
        like = pick.randrange(4)
        rows += [(c * 3 - 20, t, "user", f"{'é' * (t % 3)}{like if t < 2 else pick.randrange(2)}") for t in range(n)]
    return rows


@pytest.mark.parametrize(("per_task", "fan"), [(1 << 14, 32), (7, 2), (1, 2), (3, 32)])
def test_random_conversations(spark, monkeypatch, per_task, fan):
    """One task, and forests contracted and merged over several levels."""
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 5)
    for seed, longest in ((1, 14), (2, 30)):
        rows = random_turns(seed, 90, longest)
        assert rows_of(prefix_trie.prefix_trie(table(spark, rows), per_task)) == brute_force(rows)


def test_copies_over_many_tasks(spark, monkeypatch):
    """A third of the conversations are one and the same, and another third begin with the same turn."""
    monkeypatch.setattr(prefix_trie, "FAN", 3)
    rows = []
    for c in range(120):
        rows += [(c * 5, t, "user", "same" if c % 3 == 0 or (c % 3 == 1 and t == 0) else f"{c} {t}") for t in range(12)]
    assert rows_of(prefix_trie.prefix_trie(table(spark, rows), 6)) == brute_force(rows)


def test_hard_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", ""), (0, 1, "user", None), (0, 2, "a", "b" * 100_000), (0, 2, "ab", "b" * 99_999),
        (1, 0, "user", "x"), (1, 0, "user", "x"), (2, -3, "user", "é"), (2, None, "user", "z"), (None, 0, "user", "lost"), (None, None, None, None),
        (7, 0, "user", "absent first"), (-7, 5, "", ""), (10**12, 0, "user", "x"), (10**12 + 1, 0, "user", "x"),
    ]
    rows += [(20, t, "user", "long") for t in range(700)] + [(21, t, "user", "long") for t in range(650)] + [(22, t, "user", "long") for t in range(700)]
    assert rows_of(prefix_trie.prefix_trie(table(spark, rows))) == brute_force(rows)
    assert rows_of(prefix_trie.prefix_trie(table(spark, rows), 2)) == brute_force(rows)


def test_turnless(spark):
    """A conversation whose own turns are all replaced by those of an absent one has none; it is a member of the root."""
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    assert rows_of(prefix_trie.prefix_trie(table(spark, rows))) == brute_force(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(table(spark, [])).count() == 0


def test_contracted_forests_are_small():
    """A thousand conversations with different first turns leave three parts open, not a thousand."""
    parts = [prefix_trie.Part(4, bytes([i % 251, i // 251]), 40, i, 1) for i in range(1000)]
    edges = [prefix_trie.Edge(0, 0, b"root") for _ in range(999)]
    left, between, closed = prefix_trie.contract(parts, edges, whole=False)
    assert (len(left), len(between), len(closed)) == (3, 2, 998)
    assert left[1].n_convs == left[1].n_children == 998
