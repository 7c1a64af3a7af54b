"""Threshold grids as cubes and bits, against trying each combination."""

import random
import re
from itertools import product

import pytest
from genescreen.operators import evaluate as V
from pyspark.sql import functions as F

SCHEMA = "species string, tid string, aln_len long, cov double, ident double, mut_pos long, mut_type string, flank_bef double, flank_aft double, mut_frac double, is_one boolean, is_multi boolean"


def candidates(spark, n=300):
    rng = random.Random(4)
    near = lambda *x: rng.choice([*x, rng.random()])
    rows = [(rng.choice(["a", "b", "c"]), f"t{rng.randrange(n // 2)}", rng.choice([149, 150, 199, 200, 250, 300]), near(0.6, 0.7, 0.8), near(0.05, 0.1, 0.3, 1.0), rng.choice([-1, 0, 7]), "", near(0.3, 0.4), near(0.3, 0.4), near(0.9, 0.95), *rng.choice([(True, False), (False, True), (False, False), (True, True)])) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("grid", [None, {"low_mode": ["and"], "low_flank": [0.3], "low_overall": [0.2], "end_frac": [0.9], "multi_aln": [200], "multi_cov": [0.6], "multi_id": [0.05], "global_filter": ["150:0.8:0.3"]}])
def test_bits_equal_rows(spark, grid):
    """Counts by bits are those of the survivors as rows; a species that isn't asked for is in the union."""
    rows, table = candidates(spark), V.parameter_grid(spark, grid)
    truth = spark.createDataFrame([(f"t{k}",) for k in range(0, 150, 3)], "tid string")
    got = V.grid_search(rows, table, truth, ("a", "b"), top=400).select("combo", "union_size", "overlap", "n_a", "n_b").collect()
    kept = V.apply_params(rows, table).join(truth.withColumn("in_ref", F.lit(True)), "tid", "left").collect()
    want = {}
    for r in kept:
        x = want.setdefault(r.combo, [set(), set(), set(), set()])
        for k, use in enumerate((True, r.in_ref, r.species == "a", r.species == "b")):
            if use:
                x[k].add(r.tid)
    assert {r.combo: tuple(r)[1:] for r in got} == {k: tuple(map(len, want.get(k, [()] * 4))) for k in range(table.count())}


def test_one_row_a_tid_is_shuffled(spark):
    """The only exchanges of candidates are by tid, after a partial bit_or, and of whole bit vectors."""
    rows = candidates(spark).withColumn("in_ref", F.lit(True))
    plan = V.grid_counts(rows, V.parameter_grid(spark).collect(), ("a", "b"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    found = re.findall(r"Exchange hashpartitioning\(([^,)]*)[^\n]*\n[^\n]*HashAggregate\(keys=\[([^\]]*)\], functions=\[(partial_\w+)", plan)
    assert [(a.split("#")[0], f) for a, _, f in found if a.startswith("tid")] == [("tid", "partial_max")]
    spread = plan.index("Generate explode")
    assert plan.index("partial_bit_or") > spread and plan[spread:].count("Exchange hashpartitioning") == 2  # vectors, tids: both below the explode


def test_cube_equals_each_combination(spark):
    rng = random.Random(9)
    rows = [(f"t{k}", rng.random() < 0.4, rng.choice([0, 49, 50, 100, 199, 200, 500]), rng.choice([0.0, 0.3, 0.55, 0.8, 1.0]), rng.choice([0.0, 0.3, 0.69, 0.7, 1.0]), rng.random() < 0.8) for k in range(400)]
    features = spark.createDataFrame(rows, "tid string, in_ref boolean, align_len long, coverage double, identity double, multi boolean")
    grid = (200.0, 50.0), (0.3, 0.8), (0.7, 0.3)  # in no order
    got = {(r.min_aln_len, r.min_cov, r.min_id): (r.ref_kept, r.ref_total, r.nonref_dropped, r.nonref_total) for r in V.threshold_suggestions(features, *grid).collect()}
    multi = [r for r in rows if r[5]]
    keeps = lambda r, g: r[2] >= g[0] and r[3] >= g[1] and r[4] >= g[2]
    assert got == {g: (sum(r[1] and keeps(r, g) for r in multi), sum(r[1] for r in multi), sum(not r[1] and not keeps(r, g) for r in multi), sum(not r[1] for r in multi)) for g in product(*grid)}
    plan = V.threshold_suggestions(features)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "CartesianProduct" not in plan
