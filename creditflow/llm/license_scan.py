"""License scans by template markup.

A template is plain wording with two kinds of marked regions: ``[[ ... ]]`` may be missing, and ``<<n>>`` stands for
one to n words of any kind (a name, a year, a version). A template is compiled to a token automaton; a text matches
where some run of its words takes the automaton from start to end, so all mandatory wording must be there, exactly
and in order. Matching ignores ASCII case and everything between words.

Base phrases are plain word sequences, counted at every place where they stand. Null counts as an empty text: no
words, no places, no labels, score 0. Rows are scanned one by one, so repeated rows get equal results; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditflow.llm import common

# Base phrases and their labels.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Templates and their labels. Wording follows the public notices.
MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [[the software]] "
    "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
    "copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
    "the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software "
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
    "fitness for a particular purpose and noninfringement in no event shall <<16>> be liable for any claim damages or other liability "
    "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
)
BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "[[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "[[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
    "in the documentation and or other materials provided with the distribution "
    "[[[[3]] neither the name of <<16>> nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission]] "
    "this software is provided by <<16>> as is and any express or implied warranties including but not limited to the implied warranties of merchantability "
    "and fitness for a particular purpose are disclaimed in no event shall <<16>> be liable for any direct indirect incidental special exemplary "
    "or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise "
    "arising in any way out of the use of this software even if advised of the possibility of such damage"
)
TEMPLATES = (
    ("notice-cc", "licensed under [[a]] [[the]] cc by [[nc]] [[sa]] [[nd]] [[<<2>>]]"),
    ("notice-cc", "licensed under [[a]] [[the]] creative commons attribution [[noncommercial]] [[sharealike]] [[noderivatives]] [[<<2>>]] [[international]] [[unported]] [[generic]] [[united states]] [[public]] license"),
    ("notice-gpl", "licensed under the gnu [[lesser]] [[affero]] general public license [[version <<1>>]] [[or any later version]]"),
    ("notice-gpl", "under the terms of the gnu [[lesser]] [[affero]] general public license [[as published by the free software foundation]]"),
    ("notice-reserved", "copyright [[© <<24>>]] [[c <<24>>]] <<8>> all rights reserved"),
    ("notice-mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("notice-mit", "licensed under the mit license"),
    ("notice-mit", "released under the mit license"),
    ("notice-apache", "licensed under the apache license version <<2>>"),
    ("notice-bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    # the whole mandatory wording
    ("license-mit", MIT),
    ("license-bsd", BSD),
)

RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:long,length:long>>"

# Upper-case ASCII to lower case; every other ASCII character that is no letter or digit to a space.
TRANSLATION = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
MARKUP = re.compile(r"\[\[|\]\]|<<\d+>>|[^\s\[\]<>]+")


@dataclass(frozen=True)
class Automaton:
    """States are numbers; the start is 0. ``steps``: state to word to next states; ``free``: state to next states on any word."""

    label: str
    first: bytes
    mandatory: int
    steps: dict[int, dict[bytes, tuple[int, ...]]]
    free: dict[int, tuple[int, ...]]
    skips: dict[int, frozenset[int]]
    final: int


def compile_template(label: str, template: str) -> Automaton:
    """An automaton for one template; it must begin with a plain word and must not end inside an optional region."""
    steps: dict[int, dict[bytes, set[int]]] = {}
    free: dict[int, set[int]] = {}
    empty: dict[int, set[int]] = {}
    state, opened, mandatory, first = 0, [], 0, b""
    for part in MARKUP.findall(template):
        if part == "[[":
            opened.append(state)
        elif part == "]]":
            empty.setdefault(opened.pop(), set()).add(state)
        elif part.startswith("<<"):
            begin = state
            for k in range(int(part[2:-2])):
                free.setdefault(state, set()).add(state + 1)
                state += 1
                if k:
                    empty.setdefault(begin + k, set()).add(state)
            mandatory += not opened
        else:
            word = part.lower().encode()
            steps.setdefault(state, {}).setdefault(word, set()).add(state + 1)
            state += 1
            first = first or (word if not opened else b"")
            mandatory += not opened
    if opened or not first or 0 in empty or 0 in free:
        raise ValueError(f"the template must begin with a plain word and close its regions: {template}")

    def closure(at: int) -> frozenset[int]:
        seen, todo = {at}, [at]
        while todo:
            for x in empty.get(todo.pop(), ()):
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)

    return Automaton(
        label, first, mandatory,
        {s: {w: tuple(sorted(n)) for w, n in by.items()} for s, by in steps.items()},
        {s: tuple(sorted(n)) for s, n in free.items()},
        {s: closure(s) for s in range(state + 1)},
        state,
    )


def longest_match(automaton: Automaton, words: list[bytes], start: int) -> int:
    """Words of the longest match that begins at ``start``; 0 if there is none."""
    active, longest, at = set(automaton.skips[0]), 0, start
    while active and at < len(words):
        reached: set[int] = set()
        for state in active:
            for target in (*automaton.steps.get(state, {}).get(words[at], ()), *automaton.free.get(state, ())):
                reached |= automaton.skips[target]
        at += 1
        active = reached
        if automaton.final in active:
            longest = at - start
    return longest


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word positions where ``phrase`` stands in ``joined``, which has one space before, between and after words."""
    found, at, counted, word = [], joined.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        word += joined.count(b" ", counted, at)
        counted = at
        found.append(word)
        at = joined.find(b" " + phrase + b" ", at + 1)
    return found


def scanner(phrases=BASE_PHRASES, templates=TEMPLATES):
    """A function from a text to the columns of ``RESULT``."""
    compiled = [compile_template(label, template) for label, template in templates]
    anchors = {a.first for a in compiled}

    def scan(text: str | None) -> tuple:
        words = (text or "").encode().translate(TRANSLATION).split()
        joined = b" " + b" ".join(words) + b" " if words else b""
        starts, base = [], set()
        for phrase, label in phrases:
            if here := places(joined, phrase.encode()):
                starts += here
                base.add(label)
        spans, score = [], 0.0
        at = {w: places(joined, w) for w in anchors if b" " + w + b" " in joined}
        for automaton in compiled:
            past = 0
            for start in at.get(automaton.first, ()):
                if start >= past and (length := longest_match(automaton, words, start)):
                    spans.append({"label": automaton.label, "start": start, "length": length})
                    past = start + length
                    # longer mandatory wording is stronger evidence
                    score = max(score, 1 - 0.5 ** (automaton.mandatory / 2))
        if starts:
            score = max(score, 0.5)
        labels = base | {s["label"] for s in spans}
        return (
            len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score, spans,
        )

    return scan


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", phrases=BASE_PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row per document: ``doc_id`` and the columns of ``RESULT``, ``spans`` being the matched templates."""
    scanned = docs.select(F.col(id_column).alias("doc_id"), common.struct_udf(RESULT, scanner(phrases, templates))(F.col(text_column)).alias("s"))
    return scanned.select("doc_id", "s.*")
