"""Contig tiles while reading, deep pages, and ids matched as substrings."""

import random
import re

import pytest
from genescreen.operators import evaluate as V
from genescreen.operators import regions as G
from genescreen.operators import report as R
from genescreen.sources import readers as rd
from genescreen.sources import sinks as sk
from pyspark.sql import functions as F


@pytest.mark.parametrize("split, size", [(200, 50), (1000, 7), (1 << 20, 4096)])
def test_tiles_of_any_split_equal_the_plain_readers(spark, tmp_path, split, size):
    """Records longer than splits and than tiles, empty ones, blank lines and blanks, one file without a sequence, two files."""
    rng = random.Random(3)
    for k in range(2):
        text = "stray line before a header\n" if k else ""
        for n in [0, 1, 59, 60, 61, 700, 5000, 0, 120]:
            seq = "".join(rng.choice("ACGT") for _ in range(n))
            text += f">c{k}_{n} more\n" + "".join(f"{seq[i : i + 60]}{rng.choice(['', ' ', chr(13)])}\n{rng.choice(['', chr(10)])}" for i in range(0, n, 60))
        (tmp_path / f"{k}.fa").write_text(text)
    (tmp_path / "empty.fa").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = sorted(map(tuple, rd.read_contig_tiles(spark, str(tmp_path), size).where("tname <> ''").collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    plain = rd.read_fasta(spark, str(tmp_path / "[01].fa")).where("id like 'c%'")
    assert got == sorted(map(tuple, G.tile_contigs(plain.select(F.col("id").alias("tname"), "seq"), size).where("seq <> ''").collect()))
    assert max(len(x[2]) for x in got) <= size


def test_the_last_page_reads_the_ranges_that_hold_it(spark):
    pages = R.paged(spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("k"), F.lit("x").alias("part_of")), ["k"], 100)
    for number in (1, 777, 20_000, 20_001):
        page = R.page_of(pages, number)
        want = sorted(k * 7919 % 1_000_003 for k in range(1_000_000))[(number - 1) * 50 : number * 50]
        assert [r.k for r in page.collect()] == want
        plan = page._jdf.queryExecution().executedPlan().toString()
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)  # folders that aren't named aren't read
        assert not want or 1 <= len(re.findall(r"\d+", re.sub(r"#\d+", "", filters[1]))) <= 2


def test_pages_over_ties_and_nothing(spark):
    rows = spark.createDataFrame([(k // 500, k) for k in range(30_000)], "a long, b long").repartition(5)
    assert [tuple(r) for r in R.page(rows, ["a", "b"], 500).collect()] == [(k // 500, k) for k in range(24_950, 25_000)]
    assert R.page(rows, ["a", "b"], 5000).count() == R.page(rows.limit(0), ["a"], 500).count() == 0


def test_substrings_equal_the_nested_loop(spark):
    rng = random.Random(8)
    ids = ["", "T", "T1", "ENST00000000012", "ENST000000000123", *(f"ENST{rng.randrange(10**4):011d}" for _ in range(80)), "é1", "none of them at all"]
    texts = [None, "", "T", *(f"Query protein: ENST{rng.randrange(10**4):011d}.{rng.randrange(3)} é1" for _ in range(300)), "x ENST000000000123"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, label string")
    for q in (3, 6):
        got = V.substring_matches(spark.createDataFrame([(i,) for i in ids], "tid string"), rows, "label", q)
        assert sorted((r.tid, r.k) for r in got.collect()) == sorted({(i, k) for i in ids for k, t in enumerate(texts) if i and t and i in t})
    assert V.substring_matches(rows.select(F.col("label").alias("tid")).limit(0), rows, "label").count() == 0


def test_what_all_ids_begin_with_brings_nothing_together(spark):
    """Anchors are rare grams: what meets before it is verified stays near what matches."""
    ids = spark.range(1000).select(F.format_string("ENST%011d", "id").alias("tid"))
    lines = spark.range(1000).select(F.format_string("Query protein: ENST%011d.1", "id").alias("label"))
    found = V.substring_matches(ids, lines, "label")
    assert found.count() == 1000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_machine_local_warehouse_is_refused_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {"spark.sql.warehouse.dir": "file:/home/me/spark-warehouse"}

    with pytest.raises(ValueError):
        sk.scratch_path(Session, "x")
    Context.master = "local[4]"
    assert sk.scratch_path(Session, "x").startswith("file:/home/me/spark-warehouse/genescreen-intermediate/x-")
    Session.conf = {"spark.sql.warehouse.dir": "hdfs://host/w", "spark.checkpoint.dir": "hdfs://host/c"}
    Context.master = "yarn"
    assert sk.scratch_path(Session, "x").startswith("hdfs://host/c/x-")
