import unicodedata
from itertools import product

import zstandard
from helpers import documents
from pyspark.sql import functions as F

from creditflow.llm import common, language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = common.read_documents(spark, SF)
    remainder = common.crc_remainder("doc_id", 3)
    learned = language_id.learn(docs.where(remainder != 1))
    assert set(learned) == {"de", "en", "es", "fr"}
    judged = language_id.identify(docs.where(remainder == 1), learned).join(docs.select("doc_id", "lang"), "doc_id")
    right, accepted = judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("accepted").cast("int"))).first()
    assert right > 0.97 and accepted > 0.98
    # the same sample gives the same dictionaries
    assert language_id.learn(docs.where(remainder != 1).repartition(7)) == learned


def test_hard_rows(spark):
    docs = common.read_documents(spark, SF)
    learned = language_id.learn(docs)
    got = language_id.identify(documents(spark, clashing=True), learned).collect()
    assert len(got) == 13 and all(0 <= r["score"] <= 1 for r in got)
    unknown = [r for r in got if r["lang_pred"] == "und"]
    assert len(unknown) == 5 and all(r["score"] == 0 and not r["accepted"] for r in unknown)
    assert language_id.identify(documents(spark, []), learned).count() == 0
    kept = language_id.keep_identified(documents(spark, clashing=True), learned)
    assert kept.dtypes == documents(spark, clashing=True).dtypes and kept.count() == sum(r["accepted"] for r in got)


def test_without_labels(spark):
    nothing = language_id.learn(documents(spark, [(1, "text", None, None, None), (2, None, "en", None, None), (3, "12", "en", None, None)]))
    assert nothing == {}
    assert language_id.classify("some text", ()) == ("und", 0.0, False, 0.0)


def test_one_language():
    items = tuple(language_id.dictionaries({"xx": ["some words of a language"]}).items())
    assert language_id.classify("some words", items)[:3] == ("xx", 1.0, True)


def test_long_texts_are_used_whole():
    # words count once, so the tail has many different ones; the first block is of the other language
    syllables = {"aa": ("al", "be", "ga", "de", "ep", "ze", "et", "th"), "zz": ("om", "si", "la", "ka", "mu", "nu", "xi", "ro")}
    words = {lang: ["".join(p) for p in product(parts, repeat=4)] for lang, parts in syllables.items()}
    items = tuple(sorted(language_id.dictionaries({lang: [" ".join(w)] for lang, w in words.items()}).items()))
    head = " ".join(words["aa"][:600])
    assert len(head) > language_id.BLOCK_BYTES
    assert language_id.classify(head, items)[0] == "aa"
    assert language_id.classify(" ".join([head, *words["zz"][:3000]]), items)[0] == "zz"


def test_a_tail_of_repeated_words_is_used_whole():
    items = tuple(sorted(language_id.dictionaries({"aa": ["alpha beta gamma delta " * 9], "zz": ["omega sigma lambda kappa " * 9]}).items()))
    tail = " ".join(f"omega sigma lambda kappa{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(4000))
    assert language_id.classify("alpha beta gamma delta " + tail, items)[0] == "zz"


def test_repeated_words_count_each_time():
    # 20,000 running words over a vocabulary of 100 of one language, 300 different words of another listed once
    syllables = {"aa": ("al", "be", "ga", "de", "ep", "ze", "et", "th"), "zz": ("om", "si", "la", "ka", "mu", "nu", "xi", "ro")}
    words = {lang: ["".join(p) for p in product(parts, repeat=4)] for lang, parts in syllables.items()}
    items = tuple(sorted(language_id.dictionaries({lang: [" ".join(w)] for lang, w in words.items()}).items()))
    running = [words["aa"][i * 37 % 100 * 7] for i in range(20_000)]
    assert language_id.classify(" ".join(running + words["zz"][:300]), items)[:3:2] == ("aa", True)


def test_many_languages_and_long_texts(spark):
    # over 256 labels, and texts of some MB of different words, of which only a dictionary's worth reaches the driver
    rows = [(i, f"word{chr(97 + i // 26 % 26)}{chr(97 + i % 26)} other", f"l{i}", None, None) for i in range(300)]
    syllables = ["".join(p) for p in product(("al", "be", "ga", "de", "ep", "ze", "et", "th"), repeat=5)]
    rows += [(1000 + i, " ".join(syllables), "long", None, None) for i in range(20)]
    docs = documents(spark, rows)
    sampled = language_id.sample_per_language(docs, "doc_id", "text", "lang")
    assert set(sampled) == {r[2] for r in rows}
    assert sum(len(t.encode()) for t in sampled["long"]) <= 2 * language_id.DICTIONARY_BYTES + 4
    learned = language_id.learn(docs)
    assert len(learned) == 301 and len(learned["long"]) == language_id.DICTIONARY_BYTES
    whole = language_id.dictionaries({"long": [" ".join(syllables)] * 20})
    assert learned["long"] == whole["long"]
    assert language_id.learn(docs.repartition(5)) == learned


def test_numbers_of_any_kind_are_not_letters():
    items = tuple(language_id.dictionaries({"aa": ["alpha beta"], "zz": ["omega sigma"]}).items())
    for text in ("² ½", "Ⅷ", "①", "٣ 7 ᛮ", "́ ´ _ -"):
        assert language_id.classify(text, items) == ("und", 0.0, False, 0.0)
    assert language_id.letters("Café x²y Ⅷ ªB­") == " café x y ªb".encode()
    assert language_id.classify("x²", items)[0] != "und"


def plain_choice(text, learned):
    """From the definition: every block compressed with each dictionary by a compressor of its own, the smallest sum wins."""
    words = "".join(c if c.isalpha() or unicodedata.category(c)[0] == "M" else " " for c in (text or "").lower()).split()
    raw = "".join(f" {w}" for w in words).encode()
    sizes = []
    for lang, content in sorted(learned.items()):
        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        pack = lambda b, made=made: len(zstandard.ZstdCompressor(dict_data=made, compression_params=zstandard.ZstdCompressionParameters.from_level(3, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False)).compress(b))
        blocks = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
        lead = content[-256:]
        sizes.append((pack(lead + blocks[0]) - pack(lead) + sum(map(pack, blocks[1:])), lang))
    return min(sizes)[1]


def test_same_as_plain_compressors(spark):
    docs = common.read_documents(spark, SF)
    learned = language_id.learn(docs.where("doc_id % 2 = 0"))
    texts = [r["text"] for r in docs.where("doc_id % 2 = 1 AND length(text) > 40").orderBy("doc_id").limit(100).collect()]
    items = tuple(sorted(learned.items()))
    assert [language_id.classify(t, items)[0] for t in texts] == [plain_choice(t, learned) for t in texts]
