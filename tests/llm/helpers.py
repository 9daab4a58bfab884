"""Small tables that every text operator must cope with."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Names that the operators use themselves.
CLASHING = (
    "score", "kept", "row", "size", "node", "mark", "slot", "filter_word", "may_be_in", "length", "prefix_hash", "place",
    "target", "copies", "bucket", "component_id", "sequence_id", "of", "s", "content", "full_hash", "keep_id", "epochs", "whole",
)

PLAIN = "The quick brown fox jumps over the lazy dog and runs through the green wood to the old mill by the river. "


def hard_documents():
    """Nulls in any column, empty and blank texts, a very long text, ties, repeated rows and ids."""
    return [
        (1, None, "en", "a", None),
        (2, "", None, "a", 0),
        (3, " \t\n", "en", None, 3),
        (None, "one", "en", "b", 3),
        (None, None, None, None, None),
        (4, "one", "de", "b", 3),
        (5, "ONE", "en", "b", 3),
        (6, PLAIN * 3, "en", "c", 300),
        (6, PLAIN * 3, "en", "c", 300),
        (7, PLAIN * 3 + "tail", "en", "c", 304),
        (8, " ".join(f"w{i}" for i in range(60_000)), "fr", "c", 1),
        (9, "été ß 中文   x\x0by", "fr", "a", 9),
        (9, "1234 !!! ###", None, "b", 9),
    ]


def documents(spark, rows=None, clashing=False):
    df = spark.createDataFrame(hard_documents() if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clashing else df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
