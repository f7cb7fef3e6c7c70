"""Mixing sources to target weights, with DataFrame operations only.

1. Sizes are summed per source (combined before the shuffle), so a hot source is no large group.
2. Targets: sources share the whole by weight. No target exceeds `most` times its source; what it
   can't take is shared among the others by weight until none is above. That is water filling: in the
   order of cap over weight, the sources below the water line take their caps, the others weight times
   the line. Only one row per source takes part in it.
3. Each document appears floor(rate) times plus once more with probability rate - floor(rate), drawn from
   a hash of a seed, its id and its text, so that reruns agree and copies of a text under other ids differ.

Null texts have size 0. A null source is a source and comes last. Rows with null ids take part; repeated
rows are drawn alike. Extra columns stay, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.shared import written

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from the first 13 hex digits (52 bits) of a hash."""
    parts = [F.coalesce(c.cast("string"), F.lit("~")) for c in cols]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size) with one row per source.

    Weights repeat over the sources in code point order, null last.
    """
    ranked = sizes.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("k") - 1, F.lit(len(weights))) + 1).cast("int"))
    caps = ranked.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    # the order of cap / weight, in whole numbers
    common = 1
    for w in weights:
        common *= w
    order = Window.orderBy((F.col("cap") * (F.lit(common) / F.col("weight")).cast("long")).asc(), "k")
    all_rows = Window.partitionBy()
    line = caps.select(
        "*",
        F.row_number().over(order).alias("place"),
        F.sum("source_size").over(all_rows).alias("total"),
        F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("capped"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
    )
    # the first source in this order that stays under its cap if all before it take theirs sets the line
    under = (F.col("total") - F.col("capped")) * F.col("weight") <= F.col("cap") * F.col("open")
    line = line.withColumn("first", F.min(F.when(under, F.struct("place", "capped", "open"))).over(all_rows))
    share = (F.col("total") - F.col("first.capped")).cast("double") * F.col("weight") / F.col("first.open").cast("double")
    target = F.when(F.col("first").isNull() | (F.col("place") < F.col("first.place")), F.col("cap").cast("double")).otherwise(share)
    return line.select("source", "source_size", target.alias("target"))


def repetition_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, most: int = 3, seed: int = 1) -> DataFrame:
    """(row, size, source_size, target, copies): each row of docs as a struct and how often the mix takes it."""
    rows = docs.select(F.struct("*").alias("row"))
    own = F.col("row")
    rows = rows.withColumn("size", word_count(own.getField(text_col)))
    targets = written(source_targets(rows.groupBy(own.getField(source_col).alias("source")).agg(F.sum("size").alias("source_size")), weights, most), "targets")
    rows = rows.join(targets, own.getField(source_col).eqNullSafe(targets["source"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    chance = draw(seed, own.getField(id_col), F.md5(own.getField(text_col)))
    copies = F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")
    return rows.select("row", "size", "source_size", "target", copies.cast("int").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix: every row of docs as often as its plan says. options: those of repetition_plan."""
    plan = repetition_plan(docs, **options)
    return plan.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
