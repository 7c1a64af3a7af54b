"""Copies of queries whose hits tie, and what is computed for them."""

import random
import re

from genescreen.operators import hits as H

SCHEMA = "qname string, qlen long, qstart long, qend long, tname string, tstart long, tend long, nmatch long, alen long, mapq long"


def made(n, seed):
    """Many hits start and end at the same places of query and contig."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        q, t = rng.choice([0, 30, 60]), rng.randrange(6) * 8_000
        rows.append((f"q{rng.randrange(9)}", 100, q, q + rng.choice([30, 40]), f"c{rng.randrange(3)}", t, t + rng.choice([100, 5_000]), 50, 50, 9))
    return rows


def copies_by_loop(rows, gap):
    loci, far = {}, {}
    for q, _, qs, qe, t, s, e, *_ in sorted(rows, key=lambda r: (r[0], r[4], r[5], r[6])):
        number, end = far.get((q, t), (0, None))
        number += end is None or s > end + gap
        far[q, t] = number, e if end is None else max(end, e)
        loci.setdefault((q, t, number), set()).update(range(qs, qe))
    out = dict.fromkeys((r[0] for r in rows), 0)
    for (q, *_), places in loci.items():
        out[q] += len(places) >= 80
    return out


def test_copies_of_tied_hits_equal_the_loop(spark):
    for seed in range(2):
        rows = made(120, seed)
        hits = spark.createDataFrame(rows, SCHEMA).repartition(5)
        want = copies_by_loop(rows, 2_000)
        assert dict(H.functional_redundancy(hits, target_gap=2_000).select("query", "full_copy_count").collect()) == want
        assert dict(map(tuple, H.full_copies(H.filter_hits(hits), target_gap=2_000, tile=5_000).collect())) == want


def test_coverage_groups_hits_by_start_once(spark):
    loci = H.locus_clusters(H.filter_hits(spark.createDataFrame(made(50, 3), SCHEMA)))
    plan = H.merged_query_coverage(loci)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Aggregate \[[^\]]*qstart#", plan)) == 1
