"""Loci, coverage and greedy counts of queries that hold a large share of all hits."""

import random
import re

import pytest
from genescreen.operators import hits as H
from pyspark.sql import functions as F

SCHEMA = "qname string, tname string, tstart long, tend long, qstart long, qend long, qlen long"


def made(n, seed):
    """A third of all hits are of one query and contig, some start at one place, some end far away."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        s = rng.choice([rng.randrange(200_000), rng.randrange(300), 777])
        q = rng.randrange(90)
        rows.append(("hot" if k % 3 == 0 else f"q{k % 40}", f"c{k % 2 if k % 3 else 0}", s, s + rng.choice([0, 1, 5, 40, 900, 30_000 if k % 50 == 0 else 7]), q, q + rng.randrange(1, 12), 100))
    return rows


def loci_by_loop(rows, gap):
    out, covered, reach = [], {}, {}
    for q, t, s, e, qs, qe, _ in sorted(rows):
        number, far = reach.get((q, t), (0, None))
        number += far is None or s > far + gap
        reach[q, t] = number, e if far is None else max(far, e)
        out.append((q, t, s, e, number))
        covered.setdefault((q, t, number), set()).update(range(qs, qe))
    return sorted(out), {k: len(v) / 100 for k, v in covered.items()}


def counts_by_loop(rows, frac=0.5):
    n, now = {}, {}
    for q, t, s, e, *_ in sorted(rows):
        last = now.get((q, t))
        if last is None or max(0, min(e, last[1]) - max(s, last[0])) / max(1, min(e - s, last[1] - last[0])) < frac:
            n[q], now[q, t] = n.get(q, 0) + 1, [s, e]
        else:
            last[1] = max(e, last[1])
    return n


@pytest.mark.parametrize("tile", [1, 100, 7919, 1 << 20])
def test_loci_are_the_same_for_any_tile(spark, tile):
    rows = made(3000, 1)
    loci = H.locus_clusters(spark.createDataFrame(rows, SCHEMA), 50, tile)
    want, covered = loci_by_loop(rows, 50)
    assert sorted(map(tuple, loci.select("qname", "tname", "tstart", "tend", "locus").collect())) == want
    got = H.merged_query_coverage(loci, max(1, tile // 10)).collect()
    assert {(r.qname, r.tname, r.locus): r.cov for r in got} == covered and sum(r.n_hits for r in got) == len(rows)


def test_no_window_holds_more_than_a_tile_of_a_hot_query(spark):
    """Windows over hits are by tile; those by query and contig alone go over a row a tile."""
    hits = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("q"), F.col("id") % 1000)).alias("qname"), F.lit("c").alias("tname"), F.col("id").alias("tstart"), (F.col("id") + 20).alias("tend"))
    loci = H.locus_clusters(hits, 10, 1000)
    plan = loci._jdf.queryExecution().executedPlan().toString()
    for line in re.findall(r"Window \[.*", plan):
        partition, order = re.findall(r"\], \[([^\]]*)\], \[([^\]]*)\]", line)[-1]
        assert "tile" in partition or order.startswith("tile"), line
    most = hits.groupBy("qname", F.floor(F.col("tstart") / 1000)).count().agg(F.max("count")).first()[0]
    assert most <= 1000 and loci.where("qname = 'hot'").agg(F.max("locus")).first()[0] == 1
    assert loci.count() == 60_000


@pytest.mark.parametrize("seed", range(2))
def test_greedy_counts_equal_the_loop(spark, seed):
    rows = made(4000, seed)
    got = H.greedy_counts(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert dict(map(tuple, got.collect())) == counts_by_loop(rows)


def test_one_island_of_a_million_hits(spark):
    """Hits of one query that overlap on end over many tasks: what comes in from a task changes what the next ones leave."""
    length = F.when(F.col("id") % 1000 == 0, 50_000).otherwise(F.col("id") * 7919 % 13 + 3)
    hits = spark.range(1_000_000).select(F.lit("q").alias("qname"), F.lit("c").alias("tname"), F.col("id").alias("tstart"), (F.col("id") + length).alias("tend"))
    want = counts_by_loop([("q", "c", k, k + (50_000 if k % 1000 == 0 else k * 7919 % 13 + 3)) for k in range(1_000_000)])
    assert dict(map(tuple, H.greedy_counts(hits).collect())) == want


def test_hits_that_never_forget(spark):
    """One long hit in front: every task's first interval comes from the one before, so rounds go on task by task."""
    rows = [("q", "c", 0, 10**6, 0, 9, 9), *(("q", "c", k, k + 10, 0, 9, 9) for k in range(1, 2000))]
    assert dict(map(tuple, H.greedy_counts(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect())) == counts_by_loop(rows) == {"q": 1}


def test_no_hits(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert H.greedy_counts(none).count() == H.locus_clusters(none).count() == H.merged_query_coverage(H.locus_clusters(none)).count() == 0
