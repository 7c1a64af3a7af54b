"""Numbers of the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genescreen.sources.sinks import stored


def report_summary(parsed: DataFrame) -> DataFrame:
    """One row: blocks in all, with stops, frameshifts and both, mean score, total stops and frameshifts."""
    stops, shifts = F.col("stop") > 0, F.col("shift") > 0
    return parsed.agg(F.count("*").alias("total"), F.count_if(stops).alias("with_stops"), F.count_if(shifts).alias("with_frameshifts"), F.count_if(stops & shifts).alias("with_both"), F.avg("score").alias("average_score"), F.coalesce(F.sum("stop"), F.lit(0)).alias("total_stops"), F.coalesce(F.sum("shift"), F.lit(0)).alias("total_frameshifts"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """bin, low, n over equal widths between the least and the largest value, the last bin closed; one bin if they are equal, none without values."""
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    ends = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo is not null").withColumn("size", (F.col("hi") - F.col("lo")) / bins)
    place = F.when(F.col("size") > 0, F.least(F.floor((F.col("v") - F.col("lo")) / F.col("size")), F.lit(bins - 1))).otherwise(0).cast("int")
    counts = values.crossJoin(F.broadcast(ends)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    empty = ends.select("lo", "size", F.explode(F.sequence(F.lit(0), F.when(F.col("size") > 0, bins - 1).otherwise(0))).alias("bin"))
    return empty.join(counts, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * F.col("size")).alias("low"), F.coalesce("n", F.lit(0)).alias("n"))


def mutation_frequencies(parsed: DataFrame) -> DataFrame:
    """For every count up to the largest of either kind, the number of blocks with that many stops, and frameshifts."""
    counts = parsed.select(F.explode(F.array(F.struct(F.lit("stop").alias("kind"), F.col("stop").alias("count")), F.struct(F.lit("shift").alias("kind"), F.col("shift").alias("count")))).alias("x")).groupBy("x.count").agg(F.count_if(F.col("x.kind") == "stop").alias("n_stop"), F.count_if(F.col("x.kind") == "shift").alias("n_shift"))
    every = counts.agg(F.max("count").alias("most")).where("most is not null").select(F.explode(F.sequence(F.lit(0).cast("long"), "most")).alias("count"))
    return every.join(counts, "count", "left").na.fill(0)


def funnel_counts(stages: DataFrame) -> DataFrame:
    """Distinct ids of each stage of (stage, tid)."""
    return stages.groupBy("stage").agg(F.countDistinct("tid").alias("n"))


def paged(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """The rows written once in ranges of `order`, with `part`, the number of the range, and `row`, a row's place in it, for page_of().

    Ranges are sorted by themselves and kept in folders by part, so a page reads the ranges that hold it and no others.
    """
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    own = F.monotonically_increasing_id()
    rows = dealt.sortWithinPartitions(*order).withColumn("part", F.shiftright(own, 33).cast("int")).withColumn("row", own.bitwiseAND((1 << 33) - 1))
    return stored(rows, partition_by="part")


def page_of(pages: DataFrame, number: int, size: int = 50) -> DataFrame:
    """Page `number` (from 1) of a paged() table, in order: a count a range tells which ranges hold it; only these are read."""
    counts = sorted(map(tuple, pages.groupBy("part").count().collect()))  # a row a range
    first, before, wanted = (number - 1) * size, 0, []
    for part, n in counts:
        if before < first + size and before + n > first:
            wanted.append((part, first - before, first + size - before))
        before += n
    rows = pages.where(F.col("part").isin([p for p, *_ in wanted]))
    held = F.lit(False)
    for part, low, high in wanted:
        held = held | ((F.col("part") == part) & (F.col("row") >= low) & (F.col("row") < high))
    return rows.where(held).orderBy("part", "row").drop("part", "row")


#: Rows up to the end of a page for which all that come before may be gathered in one task.
SHALLOW = 10_000


def page(df: DataFrame, order: list[str], number: int, size: int = 50) -> DataFrame:
    """Page `number` (from 1) of the rows in order; a page that ends beyond SHALLOW rows is taken from ranges, see paged()."""
    if number * size > SHALLOW:
        return page_of(paged(df, order), number, size)
    return df.orderBy(*order).offset((number - 1) * size).limit(size)
