"""Line parsers for the five input formats.

Each parser is a single projection of native expressions (no Python UDF):
rows that cannot be parsed keep ``ok = false`` instead of failing the job,
and ``split_rejects`` separates them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import java_whitespace_split


def split_rejects(df: DataFrame, flag: str = "ok") -> tuple[DataFrame, DataFrame]:
    """(good rows without the flag, rejected rows)."""
    return df.filter(F.col(flag)).drop(flag), df.filter(~F.col(flag))


def java_split(text: Column, separator: str) -> Column:
    """``text.split(separator)`` of a single character as Java does it: inner
    and leading empty tokens stay, trailing ones go; "" gives one empty token."""
    stripped = F.regexp_replace(text, f"{separator}+$", "")
    return F.when((stripped == "") & (text != ""), F.array().cast("array<string>")) \
        .otherwise(F.split(stripped, separator))


def basket_items(line: Column) -> Column:
    """``{1, 2,3}`` -> [1, 2, 3]: drop the first and last character, split on
    ',', trim, cast. A token that is not an integer becomes NULL."""
    inner = F.substring(line, 2, F.greatest(F.length(line) - 2, F.lit(0)))
    return F.transform(java_split(inner, ","), lambda t: F.trim(t).try_cast("int"))


def parse_baskets(lines: DataFrame, col: str = "value") -> DataFrame:
    """A1: adds ``items array<int>`` and ``ok`` (every token an integer)."""
    items = basket_items(F.col(col))
    return lines.withColumn("items", items).withColumn(
        "ok", F.coalesce(F.forall("items", lambda x: x.isNotNull()), F.lit(False)))


def parse_transactions(lines: DataFrame, col: str = "value") -> DataFrame:
    """items split on one space, empty inner and leading tokens kept as
    items (as Java's split leaves them); duplicates removed (FP-growth needs
    sets). Only a missing line is rejected; one of spaces has no items."""
    items = F.array_distinct(java_split(F.col(col), " "))
    return lines.withColumn("items", items).withColumn("ok", F.col(col).isNotNull())


def parse_categories(lines: DataFrame, col: str = "value") -> DataFrame:
    """``name index`` separated by any whitespace -> (category, label,
    position of the line in its file)."""
    tok = F.filter(java_whitespace_split(F.col(col)), lambda x: x != "")
    out = lines.select(F.get(tok, 0).alias("category"),
                       F.get(tok, 1).try_cast("int").alias("label"),
                       F.monotonically_increasing_id().alias("position"))
    return out.withColumn("ok", F.col("category").isNotNull() & F.col("label").isNotNull())


def parse_labelled_docs(docs: DataFrame, categories: DataFrame, text_col: str = "text") -> DataFrame:
    """Text before the first '|' is the category, the rest the content
    (not trimmed). Empty text, no '|' or an unknown category -> ok = false.

    ``categories`` (category, label, position) is the lookup table: of a name
    listed twice the last line counts. It is a left join, so unknown
    categories stay visible as rejects.
    """
    t = F.col(text_col)
    pos = F.instr(t, "|")
    parsed = docs.withColumn("category", F.when(pos > 0, F.substring(t, 1, pos - 1))) \
        .withColumn("content", F.when(pos > 0, F.substring(t, pos + 1, F.length(t) - pos)))
    cats = categories.groupBy("category").agg(F.max_by("label", "position").alias("label"))
    # a category may hold most documents: they are dealt in turn to as many copies of its row as the shuffle has partitions
    copies = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cats = cats.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))))
    parsed = parsed.withColumn("_copy", F.monotonically_increasing_id() % copies)
    out = parsed.join(cats, ["category", "_copy"], "left").drop("_copy")
    return out.withColumn("ok", F.coalesce((pos > 0) & F.col("label").isNotNull(), F.lit(False)))


def parse_links(lines: DataFrame, col: str = "value") -> DataFrame:
    """``src dst`` split on one space, first two tokens; fewer -> reject
    (trailing spaces make no token, leading ones an empty first token)."""
    tok = java_split(F.col(col), " ")
    return lines.select("*", F.get(tok, 0).alias("src"),
                        F.get(tok, 1).alias("dst")) \
        .withColumn("ok", F.col("dst").isNotNull())


def basket_table(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Text lines of baskets -> ((basket, item) long form, rejected lines).

    An accepted line without items stays as one row with a NULL item, so that
    it counts in the basket total.
    The basket id is ``monotonically_increasing_id()``: unique, and stable
    for a file scan (it is derived from the split and the row position)."""
    good, bad = split_rejects(parse_baskets(lines, col).withColumn("basket", F.monotonically_increasing_id()))
    return good.select("basket", F.explode_outer("items").alias("item")), bad


def transaction_table(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Text lines of space-separated items -> ((basket, item), rejects)."""
    good, bad = split_rejects(parse_transactions(lines, col).withColumn("basket", F.monotonically_increasing_id()))
    return good.select("basket", F.explode_outer("items").alias("item")), bad


def edge_table(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Text lines ``src dst`` -> ((src, dst), rejects)."""
    good, bad = split_rejects(parse_links(lines, col))
    return good.select("src", "dst"), bad
