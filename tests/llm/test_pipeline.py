import re
from collections import Counter

import corpus_pipeline
import pytest
from helpers import documents
from test_ngram_join import brute_force as near_classes
from test_packing import check as check_pieces

from creditflow.llm import common, language_id, source_mixing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage over the given table."""
    from creditflow.session import stage

    docs, out = common.read_documents(spark, SF), {}
    for name, function in corpus_pipeline.STAGES:
        done = stage(function(spark, docs, SF), name)
        out[name] = (docs, done)
        docs = done
    return out


def test_stages_keep_the_columns(stages, spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "ngram_jaccard_join", "source_mixing", "harmonic_packing"]
    for name in names[:-1]:
        assert stages[name][1].dtypes == common.read_documents(spark, SF).dtypes


def test_each_stage_on_its_own_input(stages):
    before, after = stages["language_id"]
    learned = language_id.learn(before.where(common.crc_remainder("doc_id", 3) != 1))
    wanted = {r["doc_id"] for r in language_id.identify(before, learned).where("accepted").collect()}
    assert {r["doc_id"] for r in after.collect()} == wanted and len(wanted) > 0.98 * before.count()

    before, after = stages["exact_dedup"]
    keep = {}
    for r in before.collect():
        keep[r["text"] or ""] = max(keep.get(r["text"] or "", -1), r["doc_id"])
    assert {r["doc_id"] for r in after.collect()} == set(keep.values())

    before, after = stages["ngram_jaccard_join"]
    classes = near_classes([(r["doc_id"], r["text"]) for r in before.collect()], corpus_pipeline.NEAR)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({c[2] for c in classes})

    before, after = stages["source_mixing"]
    copies = Counter(r["doc_id"] for r in after.collect())
    for r in source_mixing.mix_sizes(before).collect():
        assert r["taken"] == copies[r["doc_id"]] * r["size"]

    before, after = stages["harmonic_packing"]
    check_pieces([(r["doc_id"], r["text"]) for r in before.collect()], after.collect())


def test_run_is_the_stages(stages, spark):
    packed = corpus_pipeline.run(spark, SF)
    last = stages["harmonic_packing"][1]
    assert packed.dtypes == last.dtypes
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in packed.where("start = 0").collect()) == Counter((r["doc_id"], r["doc_tokens"]) for r in last.where("start = 0").collect())


def test_hard_rows_pass_all_stages(spark):
    for rows in (None, []):
        docs = documents(spark, rows, clashing=True)
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        for name, function in corpus_pipeline.STAGES:
            after = function(spark, docs, SF)
            if name != "harmonic_packing":
                assert after.dtypes == docs.dtypes
            docs = after
        pieces = docs.collect()
        # every document that is left is packed whole; nothing comes of nothing
        assert {r["doc_id"] for r in pieces} <= ids and bool(pieces) == bool(ids)
        packed = Counter()
        for r in pieces:
            packed[r["doc_id"]] += r["length"]
        assert all(n % next(r["doc_tokens"] for r in pieces if r["doc_id"] == i) == 0 for i, n in packed.items())


def test_words_of_the_mix_follow_the_targets(stages):
    before, after = stages["source_mixing"]
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert abs(sum(map(size, after.collect())) / sum(map(size, before.collect())) - 1) < 0.05
