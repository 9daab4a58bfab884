import re

import pytest
from helpers import documents

from creditflow.llm import common, license_scan

SCAN = license_scan.scanner()
NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def scan(text):
    return dict(zip(NAMES, SCAN(text), strict=True))


def base(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [(i, label) for phrase, label in license_scan.BASE_PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return {
        "n_words": len(words), "n_base": len(found), "first_word": min((i for i, _ in found), default=None),
        "last_word": max((i for i, _ in found), default=None), "base_labels": ",".join(sorted({x for _, x in found})),
    }


@pytest.mark.parametrize(
    "text",
    [None, "", "...", "cc by", "CC-BY cc by-cc.by cc  by", "All rights reserved all rights, reserved", "xcc by", "cc byx", "cc by x", "gnu general public license general public license"],
)
def test_base_places(text):
    got = scan(text)
    assert {k: got[k] for k in base(text)} == base(text)


def test_given_table(spark):
    docs = common.read_documents(spark, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in license_scan.scan_licenses(docs).collect():
        assert {k: r[k] for k in base(texts[r["doc_id"]])} == base(texts[r["doc_id"]])


def test_templates():
    assert scan("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by,notice-cc"
    assert scan("x licensed under the GNU General Public License, version 3. y")["spans"] == [{"label": "notice-gpl", "start": 1, "length": 9}]
    assert scan("Licensed under the Apache License, Version 2.0.")["labels"] == "notice-apache"
    assert scan("Licensed under the Apache Version 2.0.")["labels"] == ""
    assert scan("Copyright (c) 2020 Some Body. All rights reserved.")["labels"] == "notice-reserved,reserved"
    assert scan("Copyright a b c d e f g h i j. All rights reserved.")["labels"] == "reserved"
    assert 0 <= scan("Released under the MIT License.")["score"] <= 1


@pytest.mark.parametrize(
    ("template", "texts", "not_texts"),
    [
        ("a [[b]] c", ["a c", "a b c"], ["a b", "a b b c", "a x c"]),
        ("a <<2>> c", ["a x c", "a x y c", "a c c"], ["a c", "a x y z c"]),
        ("a [[b [[c]] d]] e", ["a e", "a b d e", "a b c d e"], ["a c e", "a b e"]),
        ("a [[<<3>>]] e", ["a e", "a x e", "a x y z e"], ["a w x y z e"]),
        ("a <<1>> b [[c]] d", ["a a b d", "a b b c d"], ["a b d"]),
    ],
)
def test_automata(template, texts, not_texts):
    automaton = license_scan.compile_template("t", template)
    for text in texts:
        words = text.encode().split()
        assert license_scan.longest_match(automaton, words, 0) == len(words), text
    for text in not_texts:
        assert license_scan.longest_match(automaton, text.encode().split(), 0) == 0, text


@pytest.mark.parametrize("template", ["", "[[a]] b", "<<2>> a", "a [[b", "[[a"])
def test_bad_templates(template):
    with pytest.raises((ValueError, IndexError)):
        license_scan.compile_template("t", template)


def test_hard_rows(spark):
    got = license_scan.scan_licenses(documents(spark, clashing=True)).collect()
    assert len(got) == 13 and all(r["labels"] is not None and r["score"] == 0 for r in got)
    assert license_scan.scan_licenses(documents(spark, [])).count() == 0


def test_long_holders_and_license_names():
    holder = "1982, 1986, 1990, 1991, 1993 The Regents of the University of California"
    assert scan(f"Copyright (c) {holder}. All rights reserved.")["spans"] == [{"label": "notice-reserved", "start": 0, "length": 17}]
    assert scan(f"Copyright © {holder}. All rights reserved.")["labels"] == "notice-reserved,reserved"
    for name in ("4.0 International", "3.0 Unported", "2.5 Generic", "3.0 United States", "4.0 International Public"):
        assert scan(f"licensed under a Creative Commons Attribution-ShareAlike {name} License")["labels"] == "notice-cc", name


def plain(template):
    """A text of the template with its optional regions and with names in its free ones."""
    return re.sub(r"<<\d+>>", "Some Body", re.sub(r"\[\[|\]\]", "", template))


@pytest.mark.parametrize(("label", "template"), [("mit", "MIT"), ("bsd", "BSD")])
def test_whole_licenses(label, template):
    text = plain(getattr(license_scan, template))
    assert scan(text)["labels"] == f"license-{label},notice-{label}"
    assert max(s["length"] for s in scan(text)["spans"]) == len(text.split())
    # changed wording after the first sentence
    assert scan(text.replace("be liable", "always be liable to pay"))["labels"] == f"notice-{label}"
    assert scan(text.rsplit(" ", 1)[0])["labels"] == f"notice-{label}"
