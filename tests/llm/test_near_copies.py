"""The pipeline's near-dedup stage against brute-force pairs."""

import numpy as np
from pyspark.sql import DataFrame

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def kept_by_brute_force(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n_pairs = 0
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                n_pairs += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return n_pairs, {k for k in range(len(texts)) if find(k) == k}


def test_stage_equals_brute_force_pairs(spark):
    import corpus_pipeline
    from genescreen.llm import simhash

    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(900)]
    texts = []
    for _ in range(40):
        base = rng.choice(words, 150).tolist()
        for edits in (0, 1, 2, 3, 4, 5, 6):
            copy = list(base)
            for at in rng.integers(0, 150, edits):
                copy[at] = "edit"
            texts.append(" ".join(copy))
    base = rng.choice(words, 200).tolist()
    for _ in range(60):  # one dense group
        copy = list(base)
        copy[int(rng.integers(0, 200))] = "other"
        texts.append(" ".join(copy))
    texts += [None, "", " \n", "A b", "a B", "a b c d e", "a b c d e f"]
    n_pairs, want = kept_by_brute_force(texts)
    assert n_pairs > 300
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(texts)] + [(None, texts[0], "en", "s", 1)]
    for shard, block, small in ((simhash.SHARD, simhash.BLOCK, simhash.SMALL), (16, 40, 4)):
        before = simhash.SHARD, simhash.BLOCK, simhash.SMALL
        simhash.SHARD, simhash.BLOCK, simhash.SMALL = shard, block, small
        got = [r.doc_id for r in corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()]
        simhash.SHARD, simhash.BLOCK, simhash.SMALL = before
        assert got.count(None) == 1
        assert {k for k in got if k is not None} == want and len(got) == len(want) + 1


def test_segments_meet_at_the_threshold():
    from genescreen.llm import simhash

    rng, met = np.random.default_rng(6), 0
    n_segments, bits, max_bits = simhash.parameters(250_000, 0.8)
    for _ in range(500):  # 160 of 200 shingles shared: similarity 0.8 exactly
        all_ = rng.integers(0, 1 << 63, 200, np.uint64)
        a, b = (np.frombuffer(simhash.set_fingerprint(x, n_segments, bits), "<u4") for x in (all_[:180], all_[20:]))
        differ = np.bitwise_count(a ^ b)
        met += bool((differ <= 1).any()) and differ.sum() <= max_bits
    assert met >= 0.96 * 500


def rows_shuffled(spark, links):
    """Rows that meet in the tasks which compare them."""
    below = links._jdf.queryExecution().analyzed().children().head()
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, below), spark).count()


def test_variants_are_a_row_a_bit_beside_a_large_group(spark, monkeypatch):
    from genescreen.llm import simhash

    rng = np.random.default_rng(9)
    # 60 fingerprints around one, far from each other by twos of bits in all segments, and others that meet none
    base, others = int(rng.integers(0, 1 << 62)), rng.integers(-(1 << 63), (1 << 63) - 1, 500).tolist()
    group = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 62, (60, 2))})
    fps = [*group, *others]
    sizes = [n for _, n in simhash.segments(4)]
    edges = [(a, b) for k, a in enumerate(fps) for b in fps[:k] if ((a ^ b) % (1 << 64)).bit_count() <= 4]
    want = dict(zip(*(x.tolist() for x in simhash.stars(*np.array(edges).T))))
    whole = spark.createDataFrame([(x,) for x in fps], "node long").repartition(3)
    cut = [(x, np.array([x % (1 << 64) >> sum(sizes[:s]) & (1 << n) - 1 for s, n in enumerate(sizes)], "<u4").tobytes()) for x in fps]
    split = spark.createDataFrame(cut, "node long, fp binary").repartition(3)
    assert len(want) >= len(group) - 1
    for block in (simhash.BLOCK, 16):
        monkeypatch.setattr(simhash, "BLOCK", block)
        direct, halved = simhash.links(whole, sizes, 4), simhash.links(split, sizes, 4, by_halves=True)
        for found in (direct, halved, simhash.links(split, sizes, 4)):
            a, b = (np.array(x) for x in zip(*map(tuple, found.select("a", "b").collect())))
            assert dict(zip(*(x.tolist() for x in simhash.stars(a, b)))) == want
        n_direct, n_halved = rows_shuffled(spark, direct), rows_shuffled(spark, halved)
        if block > len(fps):
            assert n_direct == 64 * len(fps) and n_halved == 6 * len(fps)
        else:  # only the large group's variants are in blocks: at most 60 / 8 of them
            assert 64 * len(fps) < n_direct <= 64 * len(others) + 64 * 8 * len(group)
            assert 6 * len(fps) < n_halved <= n_direct


def test_components_in_rounds(spark, monkeypatch):
    from genescreen.llm import graph

    monkeypatch.setattr(graph, "PIECE", 40)
    rng = np.random.default_rng(8)
    order = rng.permutation(300)
    edges = [(int(a), int(b)) for a, b in zip(order[:100], order[1:101])] + [(int(order[150]), int(k)) for k in order[151:250]]  # a path and a star
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()))
    assert got == {int(k): int(min(part)) for part in (order[:101], order[150:250]) for k in part}
