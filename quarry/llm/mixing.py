"""Mixing sources to target weights by capped water-filling, with DataFrame operations only.

Sources share the corpus's words by weight; a source is read at most
``epochs`` times, so its target stops there and the excess goes to the others
by weight until no target is above its cap. A source's target is then met by
whole repetitions of all its documents and, for what is left, one more
repetition of the documents that come first in a seeded order; the last of
these, one document of each source, is repeated in part. Totals per source, and per
slice of the seeded order, are the only groups: no source meets in one task.

Defined results: a null text has size 0; null is a source by itself and comes
last; a source without words has target 0; rows with equal (or no) doc_id are placed
by their texts, and rows equal in both are taken one after the other, in no defined
order; an empty table gives an empty result; other columns are kept by ``mixture`` and not read by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import keep, ranked

WEIGHTS, EPOCHS, SEED = (1, 2, 3), 3, 5
ROWS_PER_SLICE = 4096
WORD = r"[^\x20\x09-\x0D]++"


def n_words(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _place() -> F.Column:
    """A document's place in the seeded order, 0 to 2^62; rows equal in doc_id and text share one."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("text")), 2)


def targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target: water-filling over one row per source."""
    t = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = ranked(t, [F.col("source").asc_nulls_last()], "_rank")
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    t = keep(t.withColumn("weight", w.cast("double")).withColumn("cap", (F.col("source_size") * epochs).cast("double")).drop("_rank"))
    level, full = 0.0, -1
    while True:  # each round clamps at least one source more
        at_cap = F.col("cap") <= F.col("weight") * level
        r = t.agg(F.sum(F.col("source_size").cast("double")), F.sum(F.when(at_cap, F.col("cap"))), F.sum(F.when(~at_cap, F.col("weight"))), F.sum(at_cap.cast("long"))).first()
        if r[2] is None or r[3] == full:
            break
        level, full = (r[0] - (r[1] or 0.0)) / r[2], r[3]
    return t.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def cuts(sizes: DataFrame, target: DataFrame) -> DataFrame:
    """For each source: whole repetitions, and where in the seeded order one more ends.

    Documents placed before ``cut`` get one more, the ``n_cut`` rows at ``cut`` get
    ``rest`` words, one row after the other.
    """
    bits = max(0, (sizes.count() // ROWS_PER_SLICE).bit_length())
    d = sizes.select("source", "size", F.col("place"), F.shiftrightunsigned("place", 62 - bits).alias("slice"))
    t = target.select(F.col("source").alias("_s"), "source_size", "target", F.floor(F.try_divide(F.col("target"), F.col("source_size"))).alias("whole"))
    t = t.withColumn("whole", F.coalesce("whole", F.lit(0)))
    t = t.withColumn("want", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    s = d.groupBy("source", "slice").agg(F.sum("size").alias("n")).withColumn("had", F.coalesce(F.sum("n").over(before), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_s"))
    edge = s.join(t, same).filter("had < want and want <= had + n").select("_s", F.col("slice").alias("_slice"), "had", "want")
    rows = d.join(edge, same & (F.col("slice") == F.col("_slice"))).groupBy("source", "place", "had", "want").agg(F.sum("size").alias("n"), F.count("*").alias("n_cut"))
    up_to = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("had", F.col("had") + F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    rows = rows.filter("had < want and want <= had + n").select(
        F.col("source").alias("_c"), F.col("place").alias("cut"), (F.col("want") - F.col("had")).alias("rest"), "n_cut")
    out = t.join(rows, F.col("_s").eqNullSafe(F.col("_c")), "left")
    return out.select("_s", "source_size", "target", "whole", F.coalesce("cut", F.lit(-1)).alias("cut"), "rest", F.coalesce("n_cut", F.lit(0)).alias("n_cut"))


def _with_cuts(d: DataFrame, c: DataFrame) -> DataFrame:
    """``d`` with its source's cut, and ``at_cut``: words of the rows before this one that share its place at the cut.

    Rows that share it are numbered as they are written to the shared folder; their
    sums per written part are added up, so equal rows never meet in one task.
    """
    d = d.join(c, F.col("source").eqNullSafe(F.col("_s")))
    if c.filter("n_cut > 1").isEmpty():
        return d.withColumn("at_cut", F.lit(0).cast("long"))
    tied = (F.col("place") == F.col("cut")) & (F.col("n_cut") > 1)
    t = keep(d.filter(tied).withColumn("_id", F.monotonically_increasing_id())).withColumn("_p", F.shiftright("_id", 33))
    before = Window.partitionBy("_g").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    sums = t.groupBy(F.col("source").alias("_g"), F.col("_p").alias("_k")).agg(F.sum("size").alias("_n"))
    sums = sums.select("_g", "_k", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("source", "_p").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_i", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    t = t.join(sums, F.col("source").eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_k")))
    return d.filter(~tied).withColumn("at_cut", F.lit(0).cast("long")).union(t.select(*d.columns, F.col("_o") + F.col("_i")))


def _taken() -> F.Column:
    more = F.when(F.col("place") < F.col("cut"), F.col("size")).when(
        F.col("place") == F.col("cut"), F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("at_cut")))).otherwise(0)
    return (F.col("whole") * F.col("size") + more).cast("long")


def plan(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    sizes = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words().alias("size"), _place().alias("place")))
    c = keep(cuts(sizes, targets(sizes, weights, epochs)))
    return _with_cuts(sizes, c).select("doc_id", "size", "source_size", "target", _taken().alias("taken"))


def mixture(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The mixed corpus: rows of ``docs`` as often as the plan takes them.

    A last repetition in part, of one document of each source at most, holds the document's first words (and its
    n_chars, where there is such a column). Documents without words stay, once.
    """
    d = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "source", "text", n_words().alias("size")).withColumn("place", _place())
    c = keep(cuts(d, targets(keep(d.select("source", "size")), weights, epochs)))
    d = _with_cuts(d, c).withColumn("_taken", _taken())
    full = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("_taken") / F.col("size"))).cast("int")
    part = F.when(F.col("size") > 0, F.col("_taken") % F.col("size")).otherwise(0).cast("int")
    parts = F.concat(F.array_repeat(F.lit(-1), full), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    d = d.withColumn("_part", F.explode(parts))
    whole = F.col("_part") < 0
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.greatest("_part", F.lit(0))), " ")
    d = d.withColumn("_head", F.when(~whole, head))
    new = {"text": F.when(whole, F.col("text")).otherwise(F.col("_head"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(whole, F.col("_row.n_chars")).otherwise(F.length("_head").cast(docs.schema["n_chars"].dataType))
    return d.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])
