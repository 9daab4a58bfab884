"""How far the sources of a language differ in their words, audited over run-length columns of counts.

Every (language, source) group gives each kept term of its language a share ``p``, smoothed and scaled to whole
numbers; two groups differ by the sum of ``|p - q|`` over all kept terms.

The terms are reordered so that equal counts lie side by side: sorted by their counts per source. Cut into blocks of
bounded size, each group's counts in a block are a column of few runs, and where a group has none of a block's terms
its column is a single run of zeros. For a pair of groups the boundaries of the runs are intersected, and each piece
adds ``|p - q|`` times its length. Groups are dealt to tiles, so a task holds one block of at most two tiles.

Terms are runs of letters (ASCII letters and everything beyond ASCII), with A-Z lower-cased, of the whole text however
long. Null texts, languages and sources count as empty strings, rows that repeat an id as documents of their own.
Groups without kept terms have counts 0; in a language without kept terms all values are 0. Ties are ranked by the
item's bytes. Sums are whole numbers, so no order of rows changes them. An empty table gives an empty result. Other
columns are not looked at and may have any names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditflow.llm import common
from creditflow.session import stage

# Documents that a kept term is in, what is added to every count, the scale of shares, ranks of terms.
LEAST_DOCUMENTS = 30
ADDED = 5
SCALE = 1_000_000_000
MOST_TERM_RANKS = 50
# Different (language, source, term) that a task counts before it passes them on.
MOST_HELD = 300_000
# Terms of a block, groups of a tile.
BLOCK_TERMS = 1 << 14
TILE = 32

# Fixed value: bytes that are not in terms become blanks, A-Z become a-z, all others stay.
TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
RUNS = pa.schema(
    [
        ("lang", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("source", pa.string()),
        ("counts", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ]
)
PAIRED = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def term_counts(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents with the term, summed in the tasks before the shuffle."""

    def run(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, in_docs) in held.items():
                terms = list(n)
                columns = (
                    pa.repeat(lang, len(terms)), pa.repeat(source, len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(list(n.values()), pa.int64()), pa.array([in_docs[t] for t in terms], pa.int64()),
                )
                yield pa.RecordBatch.from_arrays(list(columns), schema=COUNTED)
            held.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                terms = text.translate(TO_TERMS).split()
                n, in_docs = held.setdefault((lang, source), (Counter(), Counter()))
                n.update(terms)
                in_docs.update(set(terms))
            if sum(len(n) for n, _ in held.values()) > MOST_HELD:
                yield from flush()
        yield from flush()

    rows = docs.select(text_of(lang_column).alias("lang"), text_of(source_column).alias("source"), F.encode(text_of(text_column), "utf-8").alias("text"))
    found = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, counts``: the terms in enough documents, with (source, n) in order of the sources.

    A term's list has at most one entry per source of its language; the result has that number squared.
    """
    enough = counts.groupBy("lang", "term").agg(F.sum("docs").alias("in_docs")).where(F.col("in_docs") >= least_documents).select("lang", "term")
    return (
        counts.join(enough, ["lang", "term"])
        .groupBy("lang", "term")
        .agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"))
    )


def group_totals(docs: DataFrame, terms: DataFrame, lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """One row per occurring group: ``lang, source, total, lang_total, vocabulary``."""
    groups = docs.select(text_of(lang_column).alias("lang"), text_of(source_column).alias("source")).distinct()
    entries = terms.select("lang", F.explode("counts").alias("e"))
    sums = entries.groupBy("lang", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("total"))
    sizes = terms.groupBy("lang").agg(F.count("*").alias("vocabulary"))
    per_lang = sums.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(sizes, "lang")
    found = groups.join(sums, ["lang", "source"], "left").join(per_lang, "lang", "left")
    return found.na.fill(0, ["total", "lang_total", "vocabulary"])


def run_length(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of the runs of a column that is not empty."""
    starts = np.flatnonzero(np.diff(column, prepend=column[0] - 1))
    return column[starts], np.diff(np.append(starts, len(column)))


def run_columns(terms: DataFrame) -> DataFrame:
    """``lang, block, size, source, counts, lengths``: the columns of the blocks' sources that have any of their terms."""

    def encode(lang: str, block: int, rows: list[list[dict]]) -> pa.RecordBatch:
        places: dict[str, list[tuple[int, int]]] = {}
        for at, row in enumerate(rows):
            for e in row:
                places.setdefault(e["source"], []).append((at, e["n"]))
        found = []
        for entries in places.values():
            column = np.zeros(len(rows), dtype=np.int64)
            at, n = zip(*entries, strict=True)
            column[list(at)] = n
            found.append(run_length(column))
        columns = (
            pa.repeat(lang, len(found)), pa.repeat(pa.scalar(block, pa.int64()), len(found)), pa.repeat(pa.scalar(len(rows), pa.int64()), len(found)),
            pa.array(list(places), pa.string()), pa.array([c for c, _ in found], RUNS.field("counts").type), pa.array([x for _, x in found], RUNS.field("lengths").type),
        )
        return pa.RecordBatch.from_arrays(list(columns), schema=RUNS)

    def run(batches: common.Batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, current, rows = TaskContext.get().partitionId() << 32, None, []
        for batch in batches:
            for lang, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if rows and (lang != current or len(rows) == BLOCK_TERMS):
                    yield encode(current, block, rows)
                    block, rows = block + 1, []
                current = lang
                rows.append(counts)
        if rows:
            yield encode(current, block, rows)

    ordered = terms.select("lang", "counts").repartitionByRange("lang", "counts").sortWithinPartitions("lang", "counts")
    return ordered.mapInArrow(run, "lang string, block long, size long, source string, counts array<long>, lengths array<long>")


def shares(counts: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """Each count's share as a whole number; the products may need more than 64 bits."""
    if not vocabulary:
        return np.zeros(len(counts), dtype=np.int64)
    values, where = np.unique(counts, return_inverse=True)
    return np.array([1 + SCALE * (c + ADDED) // (total + ADDED * vocabulary) for c in values.tolist()], dtype=np.int64)[where]


def run_distance(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of ``|p - q|`` over two columns, given as shares of runs and the runs' ends."""
    ends = np.union1d(a[1], b[1])
    apart = np.abs(a[0][np.searchsorted(a[1], ends)] - b[0][np.searchsorted(b[1], ends)])
    return int((apart * np.diff(ends, prepend=0)).sum())


def pair_values(totals: DataFrame, runs: DataFrame) -> DataFrame:
    """``lang, a, b, value`` for all pairs of a language's sources, ``a < b``; the contract asks for each of them."""

    def intersect(table: pa.Table) -> pa.Table:
        columns, rows = {}, table.to_pylist()
        for r in rows:
            p = shares(np.array(r["counts"], dtype=np.int64), r["total"], r["vocabulary"])
            columns[r["source"]] = (p, np.cumsum(r["lengths"]))
        one_tile = rows[0]["x"] == rows[0]["y"]
        left = [r["source"] for r in rows if r["tile"] == rows[0]["x"]]
        right = [r["source"] for r in rows if r["tile"] == rows[0]["y"]]
        pairs = [(a, b) for a in left for b in right if not one_tile or a < b]
        values = [run_distance(columns[a], columns[b]) for a, b in pairs]
        ordered = [(min(p), max(p)) for p in pairs]
        arrays = (pa.repeat(rows[0]["lang"], len(pairs)), pa.array([a for a, _ in ordered], pa.string()), pa.array([b for _, b in ordered], pa.string()), pa.array(values, pa.int64()))
        return pa.Table.from_arrays(list(arrays), schema=PAIRED)

    tiles = totals.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("tiles"))
    tiled = totals.join(tiles, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    blocks = runs.select("lang", "block", "size").distinct()
    full = (
        tiled.join(blocks, "lang", "left")
        .na.fill(0, ["block", "size"])
        .join(runs.drop("size"), ["lang", "block", "source"], "left")
        .withColumn("lengths", F.coalesce("lengths", F.array("size")))
        .withColumn("counts", F.coalesce("counts", F.array(F.lit(0).cast("long"))))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumns({"x": F.least("tile", "other"), "y": F.greatest("tile", "other")})
    )
    cells = full.select("lang", "block", "x", "y", "tile", "source", "counts", "lengths", "total", "vocabulary").groupBy("lang", "block", "x", "y")
    return cells.applyInArrow(intersect, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def share(count: str, total: str) -> Column:
    """The same shares as a column, exactly."""
    scaled = f"cast({count} + {ADDED} AS decimal(20, 0)) * cast({SCALE} AS decimal(10, 0))"
    return F.expr(f"1 + ({scaled}) div cast({total} + {ADDED} * vocabulary AS decimal(20, 0))")


def term_values(totals: DataFrame, terms: DataFrame) -> DataFrame:
    """``lang, source, item, value``: kept terms that a group uses more than its language does."""
    in_lang = terms.select("lang", "term", F.expr("aggregate(counts, 0L, (s, e) -> s + e.n)").alias("lang_n"), F.explode("counts").alias("e"))
    joined = in_lang.select("lang", "term", "lang_n", F.col("e.source").alias("source"), F.col("e.n").alias("n")).join(totals, ["lang", "source"])
    more = joined.withColumn("value", share("n", "total") - share("lang_n", "lang_total"))
    return more.where("value > 0").select("lang", "source", F.col("term").alias("item"), "value")


def ranked(values: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return values.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def source_divergence(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
    least_documents: int = LEAST_DOCUMENTS, most_term_ranks: int = MOST_TERM_RANKS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: per group all other sources of its language, and its most typical terms."""
    counts = stage(term_counts(docs, text_column, lang_column, source_column), "term-counts")
    terms = stage(kept_terms(counts, least_documents), "kept-terms")
    totals = stage(group_totals(docs, terms, lang_column, source_column), "group-totals")
    runs = stage(run_columns(terms), "run-columns")
    pairs = pair_values(totals, runs)
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    both = pairs.select("lang", sides.alias("s"), "value").select("lang", "s.source", "s.item", "value")
    typical = ranked(term_values(totals, terms), "term").where(F.col("rank") <= most_term_ranks)
    return ranked(both, "pair").unionByName(typical)
