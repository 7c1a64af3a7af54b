"""Extraction of regions from contigs that are kept as tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tile_contigs(contigs: DataFrame, size: int = 65_536) -> DataFrame:
    """tname, tile_no, seq: contigs cut to pieces of `size`. One regular expression finds all pieces, so a contig is walked once."""
    pieces = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return contigs.select("tname", F.posexplode(pieces).alias("tile_no", "seq"))


def extract_regions(jobs: DataFrame, tiles: DataFrame, proteins: DataFrame, size: int = 65_536) -> tuple[DataFrame, DataFrame]:
    """Jobs with dna and protein sequence, and failures with reason (pep_missing goes before dna_missing).

    A 1-based closed region becomes the numbers of the tiles that it touches, an equality join on (tname, tile_no), each tile is cut to
    the region before anything is shuffled again, and the cuts are put together by tile number. Not reverse-complemented.
    """
    first, last = F.floor((F.col("start1") - 1) / size), F.floor((F.col("end1") - 1) / size)
    key = ["gene", "tname", "start1", "end1"]
    # a job that repeats is cut once; its copies get the sequence in the join below
    touched = jobs.select(*key).distinct().withColumn("tile_no", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    start = F.greatest(F.col("start1") - F.col("tile_no") * size, F.lit(1))
    end = F.least(F.col("end1") - F.col("tile_no") * size, F.lit(size))
    cut = touched.join(tiles, ["tname", "tile_no"]).select("gene", "tname", "start1", "end1", "tile_no", F.substring("seq", start.cast("int"), (end - start + 1).cast("int")).alias("cut"))
    dna = cut.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tile_no", "cut"))), lambda x: x.cut), "").alias("dna"))
    rows = jobs.join(dna, key, "left").join(proteins.select(F.col("tid").alias("gene"), F.col("seq").alias("protein")), "gene", "left")
    reason = F.when(F.col("protein").isNull(), "pep_missing").when(F.coalesce("dna", F.lit("")) == "", "dna_missing")
    rows = rows.withColumn("reason", reason)
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null").select("gene", "reason")
