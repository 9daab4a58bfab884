import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, hard_documents
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from creditflow.llm import common, packing
from creditflow.llm.queries import TOKENIZER

REFERENCE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return np.array([*REFERENCE.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def check(rows, pieces, capacity=2048):
    """Every id in exactly one piece; sequences gapless and not over capacity."""
    wanted = defaultdict(list)
    for doc_id, text in rows:
        wanted[doc_id].append(ids_of(text))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(wanted)
    for doc_id, parts in by_doc.items():
        pool = defaultdict(int)
        for p in parts:
            pool[p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]] += 1
        assert sum(p["length"] for p in parts) == sum(map(len, wanted[doc_id]))
        if len(wanted[doc_id]) == 1:
            ids, at = wanted[doc_id][0], 0
            for start, length, crc, total in sorted(pool):
                assert start == at and total == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
                at += length
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= capacity
    return len(by_sequence), sum(p["length"] for p in pieces)


def test_given_table(spark):
    docs = common.read_documents(spark, "/root/testdata/sf0.01")
    sequences, tokens = check([(r["doc_id"], r["text"]) for r in docs.collect()], packing.pack(docs, TOKENIZER).collect())
    assert tokens / (2048 * sequences) > 0.98


def test_hard_rows(spark):
    check([(r[0], r[1]) for r in hard_documents()], packing.pack(documents(spark, clashing=True), TOKENIZER).collect())
    assert packing.pack(documents(spark, []), TOKENIZER).count() == 0


@pytest.mark.parametrize("text", ["", " a  b\n\n c\t", "a<|endoftext|>b", "don't 12345 ünï 中文字 🙂\x00", "x" * 5000])
def test_same_ids_as_the_tokenizers_library(text):
    assert packing.tokenizer(TOKENIZER)(text).tolist() == ids_of(text).tolist()[:-1]
    assert packing.tokenizer(public_tokenizers.path("byte_bpe_50k.json"))(text).tolist() == ids_of(text).tolist()[:-1]


@given(st.integers(1, 20_000), st.sampled_from([64, 100, 2048]))
def test_cuts(length, capacity):
    pieces = packing.cut(length, capacity)
    assert sum(pieces) == length and all(0 < p <= capacity for p in pieces)
    # a class takes a fixed number of pieces, which fit
    assert all(packing.class_of(p, capacity) * p <= capacity < (packing.class_of(p, capacity) + 1) * p for p in pieces)


def test_other_capacities(spark):
    docs = common.read_documents(spark, "/root/testdata/sf0.001")
    check([(r["doc_id"], r["text"]) for r in docs.collect()], packing.pack(docs, TOKENIZER, 100).collect(), 100)
