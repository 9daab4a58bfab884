"""Language identification by compression.

For each language a dictionary of raw text is cut from labelled documents. A text is compressed with every
dictionary; the language whose dictionary gives the smallest result is the answer. Where the two smallest results
lie close together the answer stands but is not accepted.

Texts are reduced to lower-case words of letters. All words of a text are compressed, in order and in blocks, so that
the dictionary matters to the end of a long text. Dictionaries hold each word once per labelled document, which leaves
room for more documents. Null texts and texts without letters are ``und`` with score 0 and are not accepted; digits and
numbers of any kind (superscripts, fractions, Roman numerals, circled ones) are not letters. Ties go to the first
language by name.
Rows are judged one by one, so repeated rows get equal results; an empty table gives an empty result. Without any
labelled row every text is ``und``.
"""

from __future__ import annotations

from functools import cache

import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditflow.llm import common

# Labelled documents that a dictionary is cut from, at most, per language; and its size in bytes.
MAX_DOCUMENTS = 256
DICTIONARY_BYTES = 112 * 1024
BLOCK_BYTES = 4096
# So much of the dictionary's end goes before a text: very short texts would else be stored as they are.
LEAD_BYTES = 256
LEVEL = 3
MIN_MATCH = 3

# A margin is narrow if the second-best result is larger by less than this share.
MIN_MARGIN = 0.002

# A letter, then letters and the marks that belong to them; numbers in letter-like forms are none.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNDETERMINED = "und"


def letters(text: str | None, distinct: bool = False) -> bytes:
    """The words of letters, lower-cased, in order, all or each once; empty if there is none."""
    words = WORD.findall((text or "").lower())
    return (" " + " ".join(dict.fromkeys(words) if distinct else words)).encode() if words else b""


def sample_per_language(labelled: DataFrame, id_column: str, text_column: str, lang_column: str) -> dict[str, list[str]]:
    """The words of up to ``MAX_DOCUMENTS`` texts of each language, drawn by a hash of the id.

    Texts are reduced to what a dictionary can hold and ranked within their language before they are collected, so
    the driver gets about two dictionaries a language at most, however long texts are.
    """
    rows = labelled.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"), F.xxhash64(id_column).alias("draw"))
    rows = rows.where("lang is not null and text is not null")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).select(F.col("lang").alias("of"), "n")
    # about twice as many as needed pass by the hash alone, so that no language is ever sorted whole
    share = F.lit(2.0 * MAX_DOCUMENTS) / F.col("n")
    drawn = (share >= 1) | (F.col("draw") < F.round(share * F.lit(2.0**64)) - F.lit(2.0**63))
    few = rows.join(F.broadcast(counts), F.col("lang") == F.col("of")).where(drawn)
    held = few.select("lang", "draw", common.struct_udf("content string, size long", held_words)(F.col("text")).alias("s")).select("lang", "draw", "s.*")
    order = Window.partitionBy("lang").orderBy("draw", "content")
    held = held.withColumn("place", F.row_number().over(order))
    held = held.withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    texts: dict[str, list[str]] = {}
    for r in sorted(held.where(f"place <= {MAX_DOCUMENTS} and before < {DICTIONARY_BYTES}").collect(), key=lambda r: (r["lang"], r["place"])):
        texts.setdefault(r["lang"], []).append(r["content"])
    return texts


def held_words(text: str | None) -> tuple[str, int]:
    """A text's distinct words, as many as a dictionary can hold, and their size in bytes."""
    content = letters(text, distinct=True)[: DICTIONARY_BYTES + 4]
    return content.decode(errors="ignore"), len(content)


def dictionaries(texts: dict[str, list[str]]) -> dict[str, bytes]:
    """Raw dictionary content per language; languages without a letter in their texts are left out."""
    result = {}
    for lang, documents in sorted(texts.items()):
        pieces, size = [], 0
        for text in documents:
            if size >= DICTIONARY_BYTES:
                break
            pieces.append(letters(text, distinct=True))
            size += len(pieces[-1])
        if content := b"".join(pieces)[:DICTIONARY_BYTES]:
            result[lang] = content
    return result


def learn(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> dict[str, bytes]:
    """Dictionaries from the labelled rows: a bounded sample, see ``MAX_DOCUMENTS``."""
    return dictionaries(sample_per_language(labelled, id_column, text_column, lang_column))


@cache
def compressors(items: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor, bytes, int]]:
    """Per language a compressor, the lead that goes before a text, and the lead's own size; prepared once per worker."""
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=MIN_MATCH, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    made = []
    for lang, content in items:
        prepared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        prepared.precompute_compress(compression_params=parameters)
        compressor = zstandard.ZstdCompressor(dict_data=prepared, compression_params=parameters)
        lead = content[-LEAD_BYTES:]
        made.append((lang, compressor, lead, len(compressor.compress(lead))))
    return made


def classify(text: str | None, items: tuple[tuple[str, bytes], ...], min_margin: float = MIN_MARGIN) -> tuple[str, float, bool, float]:
    """Language, score, whether it is accepted, and the margin as a share of the second-best size.

    The score is the winner's share if every further byte of a result halves a language's odds.
    """
    raw = letters(text)
    if not raw or not items:
        return UNDETERMINED, 0.0, False, 0.0
    blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
    sizes = sorted(
        (len(c.compress(lead + blocks[0])) - own + sum(len(c.compress(b)) for b in blocks[1:]), lang) for lang, c, lead, own in compressors(items)
    )
    best, lang = sizes[0]
    score = 1 / sum(2.0 ** max(-60, best - size) for size, _ in sizes)
    if len(sizes) == 1:
        return lang, score, True, 1.0
    margin = (sizes[1][0] - best) / max(1, sizes[1][0])
    return lang, score, margin >= min_margin, margin


def classifier(items: dict[str, bytes], min_margin: float = MIN_MARGIN):
    """A column function from a text to ``lang_pred``, ``score``, ``accepted``, ``margin``."""
    fixed = tuple(sorted(items.items()))
    return common.struct_udf("lang_pred string, score double, accepted boolean, margin double", lambda text: classify(text, fixed, min_margin))


def identify(docs: DataFrame, items: dict[str, bytes], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, accepted, margin``."""
    judged = docs.select(F.col(id_column).alias("doc_id"), classifier(items)(F.col(text_column)).alias("s"))
    return judged.select("doc_id", "s.*")


def keep_identified(docs: DataFrame, items: dict[str, bytes], text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language was accepted."""
    return docs.where(classifier(items)(F.col(text_column))["accepted"])
