"""Regions of repeated jobs."""

from genescreen.operators import regions


def test_repeated_jobs_are_cut_once(spark):
    jobs = spark.createDataFrame([("g", "+", "c", 3, 12), ("g", "+", "c", 3, 12), ("g", "-", "c", 3, 12), ("h", "+", "c", 1, 4)], "gene string, strand string, tname string, start1 long, end1 long")
    tiles = regions.tile_contigs(spark.createDataFrame([("c", "ABCDEFGHIJKLMNOP")], "tname string, seq string"), 5)
    proteins = spark.createDataFrame([("g", "M"), ("h", "K")], "tid string, seq string")
    rows, failures = regions.extract_regions(jobs, tiles, proteins, 5)
    assert sorted((r.gene, r.strand, r.dna) for r in rows.collect()) == [("g", "+", "CDEFGHIJKL"), ("g", "+", "CDEFGHIJKL"), ("g", "-", "CDEFGHIJKL"), ("h", "+", "ABCD")]
    assert failures.count() == 0
