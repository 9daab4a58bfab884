import re

import pytest
from helpers import PLAIN, documents
from pyspark.sql import functions as F

from creditflow.llm import common, quality_rules


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 3000 else set()
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(covered),
    }


@pytest.mark.parametrize(
    "text",
    [None, "", " \t", "a", "a b c", "a b c a b c", "x x x x x", "a b\na b\n\n\na b \n", "é#é &| <tag>\x0b\x0cz", PLAIN * 4, "a b c d a b c e b c d"],
)
def test_signals(text):
    got = dict(zip(quality_rules.SIGNAL_NAMES, quality_rules.text_signals(text), strict=True))
    assert {k: got[k] for k in expected(text)} == expected(text)


def test_signals_of_the_given_table(spark):
    docs = common.read_documents(spark, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality_rules.signals(docs).collect():
        for name, value in expected(texts[r["doc_id"]]).items():
            assert r[name] == value or (name == "n_repeat_words" and r["n_words"] >= 3000), (r["doc_id"], name)


def test_hard_rows(spark):
    got = quality_rules.quality_rules(documents(spark, clashing=True)).collect()
    assert len(got) == 13
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["n_words"] == 0 and by_id[1]["base_failed"] and not by_id[1]["kept"]
    assert by_id[8]["n_words"] == 60_000
    assert all(r["base_failed"] is not None and r["kept"] is not None and 0 <= r["quality_probability"] <= 1 for r in got)
    assert quality_rules.quality_rules(documents(spark, [])).count() == 0


def test_label_model_finds_faults():
    # eight rules: most texts without fault, some with two faults, a few where one rule errs
    patterns, counts = ["1" * 8, "00111111", "11001111", "1111111-", "0" + "1" * 7], [800, 60, 60, 70, 10]
    on_good, on_bad, share, good = quality_rules.fit_label_model(patterns, counts, 8)
    assert good[0] > 0.9 and good[3] > 0.9 and max(good[1], good[2]) < 0.1
    assert 0.8 < share < 0.95
    assert quality_rules.fit_label_model([], [], 8)[2] == quality_rules.PRIOR_GOOD


def test_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality_rules.quality_rules(common.read_documents(spark, sf)).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right = judged.where("not base_failed").agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.98
