"""SimHash near-duplicates through one-wildcard variants of fingerprint segments."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.common import LOWER, complete_groups, complete_tables, doc_batches, documents, map_docs, read, stored
from genescreen.llm.decontaminate import _KNOWN, gram_hashes, id_filter, in_filter, word_hashes
from genescreen.llm.graph import components, stars

#: Groups of more members than this are compared in blocks by several tasks.
BLOCK = 8192
#: Buckets of up to so many members give all their links, larger ones a spanning forest.
SMALL = 32
#: Texts of a cluster whose shingles one task compares, and texts that every task of a larger cluster gets.
SHARD, HUBS = 1024, 8
#: Chance with which two texts at the least similarity meet.
RECALL = 0.98


def fingerprint(text: bytes | None, width: int) -> int:
    """SimHash over the XXH64 (seed 42) of all word shingles, repeats included, as a signed 64-bit integer; no words: zero."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - width + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], 42) for s, e in zip(starts, ends[width - 1 :].tolist())]
    bits = np.zeros(64, np.int64)
    raw = np.array(hashes, np.uint64)
    for at in range(0, len(raw), 1 << 16):
        part = raw[at : at + (1 << 16)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * bits > len(raw))
    return int(np.bitwise_or.reduce(np.uint64(1) << set_bits.astype(np.uint64), initial=np.uint64(0)).view(np.int64)) if len(set_bits) else 0


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id and fp (signed 64 bits) of every whole text."""

    def make(ids, texts):
        return {"doc_id": ids, "fp": [fingerprint(t, width) for t in texts]}

    return map_docs(documents(docs), make, "doc_id long, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, size) of so few segments of 64 bits that max_bits differing bits leave one with at most one of them."""
    n = max_bits // 2 + 1
    edges = [64 * k // n for k in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def _spanning(left: np.ndarray, right: np.ndarray | None, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links, as places in left and then right, that join the same groups as all pairs within max_bits of left (or of left with right).

    Breadth first; a member that has been reached is compared no more, so a dense group takes a pass or two over its members.
    """
    rows = left if right is None else np.concatenate([left, right])
    side = np.arange(len(rows)) >= len(left)
    waiting = np.arange(len(rows))
    while len(waiting) > 1:
        front, waiting = [waiting[0]], waiting[1:]
        while front and len(waiting):
            x = front.pop()
            near = np.bitwise_count(rows[waiting] ^ rows[x]).sum(axis=1) <= max_bits
            if right is not None:
                near &= side[waiting] != side[x]
            if near.any():
                found = waiting[near]
                yield np.full(len(found), x), found
                front.extend(found)
                waiting = waiting[~near]


def _linked(fp: np.ndarray, bucket: np.ndarray, across: np.ndarray, second: np.ndarray, max_bits: int) -> np.ndarray:
    """Places (a, b), a row each, of links among rows of segments `fp` in one bucket; where `across`, between both sides only."""
    found: list[np.ndarray] = [np.empty((2, 0), np.int64)]
    order = np.argsort(bucket, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]]))
    n = np.diff(np.append(starts, len(order)))
    left = np.repeat(np.where(n <= SMALL, starts + n, 0), n) - np.arange(len(order))  # members of a small bucket from each on
    first = np.flatnonzero(left > 1)
    for step in range(1, SMALL):
        first = first[left[first] > step]
        if not len(first):
            break
        a, b = order[first], order[first + step]
        near = (np.bitwise_count(fp[a] ^ fp[b]).sum(axis=1) <= max_bits) & (~across[a] | (second[a] != second[b]))
        found.append(np.stack([a[near], b[near]]))
    for s, e in zip(starts[n > SMALL].tolist(), (starts + n)[n > SMALL].tolist()):
        own = order[s:e]
        left_side = own[~second[own]]
        right_side = own[second[own]] if across[own[0]] else None
        own = own if right_side is None else np.concatenate([left_side, right_side])
        for a, b in _spanning(fp[own] if right_side is None else fp[left_side], None if right_side is None else fp[right_side], max_bits):
            found.append(np.stack([own[a], own[b]]))
    return np.concatenate(found, axis=1)


def links(fps: DataFrame, sizes: list[int], max_bits: int, by_halves: bool = False) -> DataFrame:
    """Links (a, b) that connect the same nodes as all pairs within max_bits, of which some segment differs in one bit at most, do.

    fps: node (long, distinct) and fp, a fingerprint's segments of `sizes` bits as unsigned 32-bit numbers; without fp, node itself is
    the fingerprint, 64 bits cut into the segments. A fingerprint is indexed under each one-wildcard variant of each segment, a row a bit;
    variants are joined by equality, and what meets is verified on all bits. A task returns stars of what its groups link, a row a node
    at most, not the pairs.

    With by_halves a fingerprint is sent once for each half of each segment, as of two segments that differ in one bit at most one
    half is the same in both, and the other half's variants are made where equal halves meet; only halves that over BLOCK fingerprints
    share send variants. That is fewer rows for long fingerprints, never more, and gives the same links.

    Variants of over BLOCK members are dealt to blocks by hash, each pair of blocks to one task, so no task holds more than about two
    blocks of a variant. Only variants under halves of over BLOCK members are counted for that.
    """
    halves = [(s, low, size // 2 if low else size - size // 2, 0 if low else size // 2) for s, size in enumerate(sizes) for low in (1, 0)]  # segment, its low half?, bits, shift
    lows = [sum(sizes[:s]) for s in range(len(sizes))]
    columns = [c for c in ("node", "fp") if c in fps.columns]
    rows = "node long, fp binary" if "fp" in columns else "node long"

    def half(fp: np.ndarray, k: int) -> np.ndarray:
        s, _, bits, shift = halves[k]
        return (fp[:, s] >> np.uint32(shift)) & np.uint32((1 << bits) - 1)

    def segments_of(table) -> np.ndarray:
        if "fp" in columns:
            return np.frombuffer(b"".join(table["fp"].to_pylist()), "<u4").reshape(len(table["fp"]), len(sizes))
        whole = table["node"].to_numpy(zero_copy_only=False).view(np.uint64)
        return np.stack([(whole >> np.uint64(lo)) & np.uint64((1 << size) - 1) for lo, size in zip(lows, sizes)], axis=1).astype("<u4")

    def half_keys(fp: np.ndarray, k: int) -> np.ndarray:
        return half(fp, k).astype(np.int64) | k << 40

    def variants(fp: np.ndarray, k: int) -> np.ndarray:
        """Keys of the variants with a wildcard in the half other than k, wildcard after wildcard."""
        s, _, bits, shift = halves[k ^ 1]
        return np.concatenate([(fp[:, s] & ~np.uint32(1 << bit)).astype(np.int64) | s << 40 | (bit + 1) << 32 for bit in range(shift, shift + bits)])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = segments_of(batch)
            keys, n = np.unique(np.concatenate([half_keys(fp, k) for k in range(len(halves))]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["key", "n"])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = segments_of(batch)
            for k in range(len(halves)):
                yield pa.RecordBatch.from_arrays([pa.array(half_keys(fp, k)), *[batch.column(c) for c in columns]], ["key", *columns])

    def expanded(batches: Iterator[pa.RecordBatch], numbers: bool) -> Iterator[pa.RecordBatch]:
        """Rows by variants, or numbers of them; halves that needn't be told apart by variants stay."""
        for batch in batches:
            fp, number = segments_of(batch), batch.column("key").to_numpy() >> 40
            whole = ~batch.column("hot").to_numpy(zero_copy_only=False).astype(bool) & by_halves
            keys, at = [batch.column("key").to_numpy()[whole]], [np.flatnonzero(whole)]
            for k in np.unique(number[~whole]).tolist():
                own = np.flatnonzero((number == k) & ~whole)
                keys.append(variants(fp[own], k))
                at.append(np.tile(own, halves[k ^ 1][2]))
            key, at = np.concatenate(keys), np.concatenate(at)
            if numbers:
                key, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])
            elif len(key):
                yield pa.RecordBatch.from_arrays([pa.array(key), *[batch.column(c).take(pa.array(at)) for c in columns]], ["key", *columns])

    def often(df: DataFrame) -> DataFrame:
        return df.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > BLOCK)

    hot = stored(often(fps.mapInArrow(counted, "key long, n long")).select("key", F.lit(True).alias("hot")))
    by_half = fps.select(columns).mapInArrow(sent, "key long, " + rows).join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    large = stored(often(by_half.where("hot").mapInArrow(lambda batches: expanded(batches, True), "key long, n long")).select("key", F.ceil(F.col("n") / (BLOCK // 2)).cast("int").alias("n")))
    met = by_half.mapInArrow(lambda batches: expanded(batches, False), "key long, " + rows).join(large, "key", "left")
    met = met.withColumn("block", F.pmod(F.xxhash64("node"), F.coalesce("n", F.lit(1))).cast("int"))
    # a member of block b meets those of every block k in the task of the two
    pairs = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.struct(F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j")))
    met = met.withColumn("pair", F.explode(F.when(F.col("n").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(pairs)))
    met = met.select("key", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "block", *columns).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_tables(batches, ["key", "i", "j"]):
            key, i, j, block, node = (table[c].to_numpy() for c in ("key", "i", "j", "block", "node"))
            fp, group = segments_of(table), np.cumsum((np.diff(key, prepend=0) != 0) | (np.diff(i, prepend=0) != 0) | (np.diff(j, prepend=0) != 0))
            across, second, of_half = i != j, (i != j) & (block == j), key >> 32 & 255 == 0
            found = [np.empty((2, 0), np.int64)]

            def add(own: np.ndarray, bucket: np.ndarray) -> None:
                pairs = np.sort(own[_linked(fp[own], bucket, across[own], second[own], max_bits)], axis=0)
                found.append(np.stack(np.divmod(np.unique(pairs[0] * len(fp) + pairs[1]), len(fp))))

            if not of_half.all():
                own = np.flatnonzero(~of_half)
                add(own, group[own])
            for k in np.unique(key[of_half] >> 40).tolist():  # the other half's variants of one half of one segment
                own = np.flatnonzero(of_half & (key >> 40 == k))
                rest = half(fp[own], k ^ 1)
                for bit in range(halves[k ^ 1][2]):
                    add(own, group[own] << np.int64(32) | (rest & ~np.uint32(1 << bit)))
            pairs = np.concatenate(found, axis=1)
            a, b = stars(node[pairs[0]], node[pairs[1]])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return met.mapInArrow(near, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links of at most max_bits differing fingerprint bits).

    Equal fingerprints meet first in a map-side minimum, so exact copies are one node however many they are. Texts without words
    (null, empty, blank) have fingerprint zero and link like any other. A repeated doc_id is one node of its fingerprint each time.
    A row of null doc_id stays and links like any other, but names no component: one of such rows alone has a null component_id.
    An empty table gives an empty one.
    """
    held = stored(fingerprints(docs, width))
    nodes = held.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    whole = stored(nodes.select(F.col("fp").alias("node")))
    roots = stored(components(links(whole, [size for _, size in segments(max_bits)], max_bits)))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return held.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def parameters(n: int, least: float) -> tuple[int, int, int]:
    """Number and bits of segments, and differing bits over all of them, for n texts at a similarity of `least` or more.

    A bit of two such texts' fingerprints differs with a probability of at most angle / pi, the angle's cosine being 2 least / (1 +
    least). Segments have so many bits that a text meets a bounded number of others by chance, and there are so many that two such
    texts share a variant with a chance of RECALL.
    """
    p, bits = math.acos(2 * least / (1 + least)) / math.pi, min(32, max(16, math.ceil(math.log2(max(2, n))) - 2))
    same = (1 - p) ** bits + bits * p * (1 - p) ** (bits - 1)
    n_segments = math.ceil(math.log(1 - RECALL) / math.log(1 - same))
    total = bits * n_segments
    return n_segments, bits, math.floor(total * p + 4 * math.sqrt(total * p * (1 - p)))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `width` words; fewer words are one shingle, no words none."""
    words = (text or b"").translate(LOWER).split()
    return np.unique(gram_hashes(word_hashes(words, _KNOWN), min(width, len(words)))) if words else np.zeros(0, np.uint64)


def set_fingerprint(grams: np.ndarray, n_segments: int, bits: int) -> bytes:
    """SimHash over distinct shingles, as segments of `bits` bits in unsigned 32-bit numbers."""
    votes = []
    for k in range(-(-n_segments * bits // 64)):
        mixed = (grams ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(29)
        votes.append(sum(np.unpackbits(mixed[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64) for at in range(0, len(grams), 65_536)))
    own = (2 * np.concatenate(votes) > len(grams))[: n_segments * bits].reshape(n_segments, bits)
    return (own * (np.uint32(1) << np.arange(bits, dtype=np.uint32))).sum(axis=1).astype("<u4").tobytes()


def _similar(nodes: np.ndarray, fp: np.ndarray, sets: list[np.ndarray], label: np.ndarray, apart: np.ndarray | None, max_bits: int, least: float) -> list[tuple[int, int]]:
    """Links that join what pairs of exact similarity `least` or more join; pairs of one label are joined already. apart: only across both sides."""
    sizes, label, out = np.array([len(x) for x in sets]), np.unique(label, return_inverse=True)[1], []
    own = [None] * len(sets)
    for x in range(len(sets)):
        rest = np.arange(x + 1, len(sets))
        rest = rest[(label[rest] != label[x]) & (np.minimum(sizes[rest], sizes[x]) >= least * np.maximum(sizes[rest], sizes[x]))]
        if apart is not None:
            rest = rest[apart[rest] != apart[x]]
        bits = np.bitwise_count(fp[rest] ^ fp[x]).sum(axis=1)
        for y in rest[bits <= max_bits][np.argsort(bits[bits <= max_bits], kind="stable")].tolist():
            if label[x] == label[y]:
                continue
            for k in (x, y):
                if own[k] is None:
                    own[k] = frozenset(sets[k].tolist())
            both = len(own[x] & own[y])
            if both >= least * (sizes[x] + sizes[y] - both):
                out.append((int(nodes[x]), int(nodes[y])))
                label[label == label[y]] = label[x]
    return out


def near_copies(docs: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """doc_id and component_id: the smallest doc_id reachable over pairs of texts whose sets of `width`-word shingles have a Jaccard similarity of `least` or more.

    Texts of equal sets are one node, however many they are; texts without words (null, empty, blank) have the empty set and are
    equal to each other alone. SimHash fingerprints of the sets, as long as parameters() says, meet by one-wildcard variants of
    their segments (see links()), which gathers nodes into clusters. Within a cluster exact similarity decides. Its nodes are
    dealt to shards; each shard's task links its nodes with each other and with a few hubs that all shards get, and a second round
    compares what that has left apart with all the cluster, in blocks. Pairs that links already join are not compared, so a dense group
    costs little more than its members; texts of one cluster that are alike but under `least` are compared pair by pair.

    A repeated doc_id is one node of its text each time; rows of null doc_id are in no component and not in the result. An empty table
    gives an empty one.
    """
    docs = documents(docs).where("doc_id is not null")
    n_segments, bits, max_bits = parameters(docs.count(), least)

    def node_of(grams: np.ndarray) -> int:
        return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes(), 7)).view(np.int64))

    def make(ids, texts):
        sets = [shingles(t, width) for t in texts]
        return {"doc_id": ids, "node": [node_of(s) for s in sets], "fp": [set_fingerprint(s, n_segments, bits) if len(s) else None for s in sets]}

    held = stored(map_docs(docs, make, "doc_id long, node long, fp binary"))
    nodes = stored(held.groupBy("node").agg(F.min("doc_id").alias("first_doc"), F.first("fp").alias("fp")))
    clusters = components(links(nodes.where("fp is not null").select("node", "fp"), [bits] * n_segments, max_bits, by_halves=True)).withColumnRenamed("root", "cluster")
    sized = clusters.join(clusters.groupBy("cluster").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("n_shards")), "cluster")
    members = stored(sized.join(nodes, "node"))
    wanted = docs.sparkSession.sparkContext.broadcast(id_filter(members.select(F.xxhash64("first_doc").alias("fp"))))

    # the shingles of one document a member are made anew; a bit map of fixed size spares the other texts
    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = (batch.filter(pa.array(in_filter(wanted.value, batch.column("h").to_numpy()))) for batch in batches)
        for ids, texts in doc_batches(some):
            grams = [shingles(t, width) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([node_of(s) for s in grams], pa.int64()), pa.array([s.view(np.int64) for s in grams], pa.list_(pa.int64()))], ["first_doc", "node", "grams"])

    made = docs.withColumn("h", F.xxhash64("doc_id")).mapInArrow(again, "first_doc long, node long, grams array<long>")
    sets = stored(members.join(made, ["first_doc", "node"]).dropDuplicates(["node"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("n_shards"))))

    def compare(keys: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in complete_groups(batches, keys):
                node = group["node"].to_numpy()
                fp = np.frombuffer(b"".join(group["fp"].to_pylist()), "<u4").reshape(len(node), n_segments)
                grams = [np.asarray(x.values) for x in group["grams"]]
                apart = "side" in group and group["i"][0] != group["j"][0]
                side = group["side"].to_numpy(zero_copy_only=False) if apart else None
                found = _similar(node, fp, grams, group["label"].to_numpy(), side, max_bits, least)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

        return run

    columns = ["cluster", "node", "fp", "grams"]
    hubs = sets.where("n_shards > 1").groupBy("cluster", "n_shards").agg(*[F.min_by("node", F.xxhash64("node", F.lit(k))).alias(f"hub_{k}") for k in range(HUBS)])
    hubs = hubs.select("n_shards", F.explode(F.array_distinct(F.array(*[f"hub_{k}" for k in range(HUBS)]))).alias("node"))
    dealt = sets.select(*columns, "shard").unionByName(sets.join(hubs.select("node", F.col("n_shards").alias("n")), "node").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("n") - 1).cast("array<long>"))).select(*columns, "shard")).dropDuplicates(["node", "shard"])
    dealt = dealt.withColumn("label", F.col("node")).repartition("cluster", "shard").sortWithinPartitions("cluster", "shard")
    found = stored(dealt.mapInArrow(compare(["cluster", "shard"]), "a long, b long"))

    # clusters of several shards: what isn't of the cluster's largest component meets all the rest of it
    labels = sets.where("n_shards > 1").select("cluster", "node").join(stored(components(found)), "node", "left").select("cluster", "node", F.coalesce("root", "node").alias("label"))
    parts = stored(labels).groupBy("cluster", "label").agg(F.count("*").alias("n"))
    main = parts.groupBy("cluster").agg(F.max_by("label", "n").alias("main"), (F.sum("n") - F.max("n")).alias("rest"), F.max("n").alias("most")).where("rest > 0")
    shaped = labels.join(main, "cluster").withColumn("side", F.col("label") == F.col("main"))
    n_rest, n_main = F.ceil(F.col("rest") / SHARD).cast("int"), F.ceil(F.col("most") / SHARD).cast("int")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("side"), n_main).otherwise(n_rest)).cast("int")
    # blocks of the rest are i, all blocks j: those of the rest first, then those of the main component
    task = lambda i, j, second: F.struct(i.alias("i"), j.alias("j"), second.alias("second"))
    with_rest = F.transform(F.sequence(F.lit(0), n_rest - 1), lambda k: task(F.least(k, own), F.greatest(k, own), k < own))
    with_main = F.transform(F.sequence(F.lit(0), n_main - 1), lambda k: task(own, n_rest + k, F.lit(False)))
    from_main = F.transform(F.sequence(F.lit(0), n_rest - 1), lambda k: task(k, n_rest + own, F.lit(True)))
    shaped = shaped.withColumn("task", F.explode(F.when(F.col("side"), from_main).otherwise(F.concat(with_rest, with_main)))).select("node", "label", "task.*")
    shaped = sets.select(*columns).join(shaped, "node").withColumnRenamed("second", "side").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    again_found = shaped.mapInArrow(compare(["cluster", "i", "j"]), "a long, b long")

    roots = stored(components(found.unionByName(again_found)))
    named = nodes.join(roots, "node", "left").select("node", "first_doc", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return held.select("doc_id", "node").join(named.join(lowest, "root").select("node", "component_id"), "node").select("doc_id", "component_id")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
