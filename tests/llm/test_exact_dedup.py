import hashlib
from collections import defaultdict

from helpers import documents, hard_documents, rows_of

from creditflow.llm import common, exact_dedup


def brute_force(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), len(ids) == 1 or doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_hard_rows(spark):
    want = brute_force([(r[0], r[1]) for r in hard_documents()])
    assert rows_of(exact_dedup.exact_duplicates(documents(spark, clashing=True), all_hashes=True)) == want
    assert exact_dedup.exact_duplicates(documents(spark, [])).count() == 0


def test_given_table(spark):
    docs = common.read_documents(spark, "/root/testdata/sf0.001")
    want = brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows_of(exact_dedup.exact_duplicates(docs, all_hashes=True)) == want
    kept = {w[0] for w in want if w[3]}
    assert {r["doc_id"] for r in exact_dedup.drop_duplicates(docs).collect()} == kept


def test_same_length_and_prefix_differ_later(spark):
    head = "p" * 2 * exact_dedup.PREFIX_BYTES
    rows = [(i, head + c, None, None, None) for i, c in enumerate("abca")]
    got = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.exact_duplicates(documents(spark, rows)).collect()}
    assert got == {0: (3, False), 1: (1, True), 2: (2, True), 3: (3, True)}


def test_hashes_only_where_needed(spark):
    rows = [(1, "a", None, None, None), (2, "bb", None, None, None), (3, "bb", None, None, None)]
    hashed = {r["doc_id"]: r["full_hash"] for r in exact_dedup.exact_duplicates(documents(spark, rows)).collect()}
    assert hashed[1] is None and hashed[2] == hashed[3] is not None


def test_columns_stay_as_they_are(spark):
    docs = documents(spark, clashing=True)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.dtypes == docs.dtypes
    texts = [r["text"] or "" for r in kept.collect()]
    # rows that repeat text and id stay together
    assert sorted(set(texts)) == sorted({r[1] or "" for r in hard_documents()}) and len(texts) == len(set(texts)) + 1
