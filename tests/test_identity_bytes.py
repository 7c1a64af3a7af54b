"""Identities by bytes and code points against a plain loop."""

import random

from genescreen.functions import sequences as X
from pyspark.sql import functions as F


def test_matches_equal_the_loop(spark):
    rng = random.Random(1)
    text = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    pairs = [(text(a, rng.randrange(12)), text(b, rng.randrange(12))) for a in ("AB", "Aé", "é🙂A") for b in ("AB", "Aé", "🙂é") for _ in range(40)]
    pairs += [(None, "A"), ("A", None), (None, None), ("", ""), ("A" * 200_000, "A" * 199_999 + "B"), ("é" + "A" * 50_000, "e" + "A" * 60_000)]
    rows = spark.createDataFrame([(k, q, t) for k, (q, t) in enumerate(pairs)], "k long, q string, t string").repartition(3)
    got = {r.k: tuple(r)[1:] for r in rows.select("k", X.matches(F.col("q"), F.col("t")), X.positional_identity(F.col("q"), F.col("t")), X.report_identity(F.col("q"), F.col("t"))).collect()}
    for k, (q, t) in enumerate(pairs):
        same = None if q is None or t is None else sum(a == b for a, b in zip(q, t))
        assert got[k] == (same, same / min(len(q), len(t)) if q and t else 0.0, same / len(q) * 100 if q and t else 0.0)
