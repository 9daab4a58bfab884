"""Mix sources to target weights by exponential-key (Efraimidis-Spirakis) sampling.

Every source gets a target of words. Complete epochs come first: a source whose target is at least its size is
taken whole as often as it fits. The rest of the target is a weighted sample without replacement: each document
draws a key from an exponential distribution whose rate is its quality weight, and documents are taken in key
order until their sizes sum up to the rest.

Keys come from a hash of the id, so reruns agree. The sum is found without sorting a source: rows are counted in
about sqrt(rows) key ranges per source, and only the one range where the rest runs out is looked at row by row.
What is left is one cut-off per source, applied to the documents as a filter; texts are not shuffled.

Null texts have size 0, a null source is a source of its own (the last), rows that repeat id and text are taken or
left together. Ties in keys go by id, then by a hash of the text, nulls first. Sources without words have target
0. An empty table gives an empty result. Other columns may have any names: rows travel as one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditflow.llm import common
from creditflow.session import stage

SEED = 8

# Quality weights lie between this and 1, which bounds the share of rows that a key range can hold.
LEAST_WEIGHT = 0.25
# Targets stop at this many times their source's size.
MOST_EPOCHS = 3
# Weights of the sources, in order of their names, repeating.
SOURCE_WEIGHTS = (1, 2, 3)


def word_count(text_column: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_column), F.lit(common.WORD_PATTERN)), F.lit(0)).cast("long")


def quality_weight(text_column: str, size: Column) -> Column:
    """1 for plain prose, less with every symbol per word, ``LEAST_WEIGHT`` at least."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>!", ""))
    return F.greatest(F.lit(LEAST_WEIGHT), 1 / (1 + 5 * F.coalesce(F.try_divide(symbols, size), F.lit(0.0))))


def draw(id_column: str, weight: Column) -> Column:
    """The exponential key: smaller is earlier."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(id_column)), 11) + F.lit(0.5)) / F.lit(float(2**53))
    return -F.log(uniform) / weight


def order_of(id_column: str, text_column: str) -> Column:
    """What rows are sorted by within their source; a struct of key, id and text hash."""
    size = word_count(text_column)
    return F.struct(
        draw(id_column, quality_weight(text_column, size)).alias("key"),
        F.col(id_column).alias("id"),
        F.xxhash64(text_column).alias("hash"),
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = SOURCE_WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``sources`` (``source, rows, source_size``) with ``target`` added.

    Targets are in proportion to the weights and sum up to all sizes; what exceeds a source's cap is dealt to the
    others by weight until none is above. Sorted by cap per weight, the first k sources are at their cap, and k is
    the first for which the level of the others is under the next cap. One row per source in one window.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(names) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = sources.withColumn("weight", weight).withColumn("cap", F.lit(float(most_epochs)) * F.col("source_size"))
    whole = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leveled = weighed.withColumn(
        "level",
        (F.sum("source_size").over(whole) - (F.sum("cap").over(filled) - F.col("cap")))
        / (F.sum("weight").over(whole) - (F.sum("weight").over(filled) - F.col("weight"))),
    )
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "source", "level"))).over(whole)["level"]
    return leveled.withColumn("target", F.least("cap", level * F.col("weight"))).drop("weight", "cap", "level")


def plan_mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """One row per source: ``source, source_size, target, epochs, cutoff, filler``; rows up to ``cutoff``, and ``filler``, are taken once more."""
    rows = docs.select(F.col(source_column).alias("source"), word_count(text_column).alias("size"), order_of(id_column, text_column).alias("place"))
    rows = stage(rows, "mix-rows")
    sources = targets(rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size")))
    epochs = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("int")
    sources = sources.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    sources = stage(sources.withColumn("ranges", F.ceil(F.sqrt("rows"))), "mix-sources")

    # with weights of at least w, 1 - exp(-w key) is spread over [0, 1) with a density of at most 1 / w
    key_range = F.floor((1 - F.exp(-F.lit(LEAST_WEIGHT) * F.col("place.key"))) * F.col("ranges"))
    ranged = rows.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).withColumn("range", key_range)
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"), F.first("rest").alias("rest"), F.max("place").alias("last_place"))
    past = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("before", F.sum("range_size").over(past) - F.col("range_size"))
    # of the ranges that begin within the rest, the last one is where it runs out; all before it are taken
    begun = sums.where("rest > 0 and before <= rest").withColumn("earlier", F.lag("last_place").over(Window.partitionBy("source").orderBy("range")))
    last = begun.groupBy(F.col("source").alias("of")).agg(F.max(F.struct("range", "before", "earlier")).alias("last"))
    inside = ranged.drop("of").join(last, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("last.range")))
    running = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = inside.withColumn("sum", F.col("last.before") + F.sum("size").over(running))
    reached = F.max(F.when(F.col("sum") <= F.col("rest"), F.struct("place", "sum")))
    cutoffs = summed.groupBy(F.col("source").alias("of")).agg(reached.alias("reached"), F.first("last").alias("last"))
    cutoffs = stage(cutoffs.select("of", F.coalesce("reached.place", "last.earlier").alias("cutoff"), F.coalesce("reached.sum", "last.before").alias("sum")), "mix-cutoffs")
    # the one later document that fills the gap best, if it brings the sum nearer to the rest
    later = ranged.drop("of").join(cutoffs, F.col("source").eqNullSafe(F.col("of")) & (F.col("cutoff").isNull() | (F.col("place") > F.col("cutoff"))))
    gap, off = F.col("rest") - F.col("sum"), F.abs(F.col("rest") - F.col("sum") - F.col("size"))
    filler = later.where(off < gap).groupBy(F.col("source").alias("by")).agg(F.min(F.struct(off.alias("off"), "place"))["place"].alias("filler"))
    planned = sources.join(cutoffs, F.col("source").eqNullSafe(F.col("of")), "left").join(filler, F.col("source").eqNullSafe(F.col("by")), "left")
    return stage(planned.select("source", "source_size", "target", "epochs", "cutoff", "filler"), "mix-plan")


def copies_of(docs: DataFrame, plan: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    """``row`` (the document as a struct), ``size``, ``source_size``, ``target``, ``copies``."""
    placed = docs.select(common.whole_row(docs), F.col(source_column).alias("of"), word_count(text_column).alias("size"), order_of(id_column, text_column).alias("place"))
    extra = (F.coalesce(F.col("place") <= F.col("cutoff"), F.lit(False)) | F.col("place").eqNullSafe(F.col("filler"))).cast("int")
    return placed.join(plan, F.col("of").eqNullSafe(F.col("source"))).select("row", "size", "source_size", "target", (F.col("epochs") + extra).alias("copies"))


def mix_sizes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (words, repeats counted)."""
    plan = plan_mix(docs, id_column, text_column, source_column)
    counted = copies_of(docs.select(id_column, text_column, source_column), plan, id_column, text_column, source_column)
    return counted.select(F.col("row")[id_column].alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The documents of the mix with their columns as they are, each as often as it is taken."""
    plan = plan_mix(docs, id_column, text_column, source_column)
    counted = copies_of(docs, plan, id_column, text_column, source_column).where("copies > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
