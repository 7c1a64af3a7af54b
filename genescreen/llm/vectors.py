"""Near-duplicate vectors through product quantisation, exact to the last link."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.common import complete_groups, read, stored
from genescreen.llm.graph import components

#: Vectors that the quantisers are fitted on at most: those of the smallest hashed vec_id.
SAMPLE = 16_384
#: Bytes of them at most, and how many different lengths of vectors get quantisers: the most frequent ones of at least LEAST vectors.
SAMPLE_BYTES, LENGTHS, LEAST = 1 << 27, 16, 64
#: Longer inverted lists are dealt to blocks of this size at most on average, and their probes to parts of a few times as many.
BLOCK = 2048
#: Slack of all bounds, far above the rounding of sums of doubles and far below any distance that matters.
SLACK = 1e-6


def k_means(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centres by Lloyd's rounds from evenly spaced rows."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Place of the nearest centre of each row."""
    return np.argmin((centres**2).sum(1) - 2 * (x @ centres.T), axis=1)


class Quantiser:
    """Coarse centres of inverted lists, and codebooks of the residuals' subspaces."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int = 8, codewords: int = 64) -> None:
        dims = sample.shape[1]
        self.parts = np.array_split(np.arange(dims), min(parts, max(1, dims)))
        self.centres = k_means(sample, lists)
        residuals = sample - self.centres[nearest(sample, self.centres)]
        self.books = [k_means(residuals[:, p], codewords) for p in self.parts]

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distance of each row from what its code stands for."""
        r = x - self.centres[own]
        codes = np.stack([nearest(r[:, p], book) for p, book in zip(self.parts, self.books)], axis=1).astype(np.uint8)
        rest = np.concatenate([r[:, p] - book[codes[:, k]] for k, (p, book) in enumerate(zip(self.parts, self.books))], axis=1)
        return codes, np.sqrt((rest**2).sum(1))

    def probes(self, x: np.ndarray, own: np.ndarray, radius: float) -> np.ndarray:
        """Rows x lists: may a vector within `radius` lie in the list? It must be across the plane halfway between the two centres."""
        d2 = (x**2).sum(1)[:, None] + (self.centres**2).sum(1) - 2 * (x @ self.centres.T)
        between = np.sqrt(np.maximum(0, ((self.centres[:, None] - self.centres) ** 2).sum(2)))
        return d2 - d2[np.arange(len(x)), own][:, None] <= 2 * between[own] * (radius + SLACK) + SLACK

    def distances(self, queries: np.ndarray, codes: np.ndarray, at: int) -> np.ndarray:
        """Asymmetric distances of queries from the coded members of a list, by table look-up."""
        r = queries - self.centres[at]
        out = np.zeros((len(queries), len(codes)))
        for k, (p, book) in enumerate(zip(self.parts, self.books)):
            table = ((r[:, None, p] - book) ** 2).sum(2)
            out += table[:, codes[:, k]]
        return np.sqrt(out)


def _quantiser(fitted: dict[int, Quantiser], dims: int) -> Quantiser:
    """The quantiser of a length; a length without one has a single list, all of whose members are reranked."""
    return fitted.get(dims) or Quantiser(np.zeros((1, dims)), 1)


def _units(column: pa.ListArray) -> list[bytes | None]:
    """Rows of unit length as doubles; None for those that are null, zero or hold null or non-finite components. None is padded."""
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False).astype(bool), np.diff(offsets), 0)
    out: list[bytes | None] = [None] * len(column)
    for n in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == n)
        x = flat[offsets[at][:, None] + np.arange(n)]
        largest = np.abs(x).max(axis=1)
        good = np.isfinite(largest) & (largest > 0)
        at, x = at[good], x[good] / largest[good, None]  # so that squares neither vanish nor overflow
        x /= np.sqrt((x**2).sum(1))[:, None]
        for k, row in zip(at.tolist(), x):
            out[k] = row.tobytes()
    return out


def _spanning(near: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a symmetric table of links."""
    waiting, out = np.ones(len(near), bool), []
    for start in range(len(near)):
        if not waiting[start]:
            continue
        waiting[start] = False
        front = [start]
        while front:
            x = front.pop()
            found = np.flatnonzero(near[x] & waiting).tolist()
            waiting[found] = False
            out.extend((x, y) for y in found)
            front.extend(found)
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept: vectors of one label linked at a cosine of `least` or more.

    Unit vectors at that cosine are within radius sqrt(2 - 2 least). A vector lies in the inverted list of its nearest centre, coded by
    the subspaces of its residual. It probes every list of higher number that can hold a vector within the radius (it would be across
    the plane between the two centres), so every link is met in one list and no probe count is guessed. A member is reranked by exact
    cosine if the look-up distance is at most the radius and the member's own coding error; the triangle inequality loses none.
    Equal vectors are one node with a weight. A list of over BLOCK members is dealt to blocks and its pairs of blocks to tasks; a task
    returns weights and a spanning forest, never its pairs. Quantisers are fitted on SAMPLE vectors; any fit gives the same links.

    Null labels, null or zero vectors and such with null or non-finite components link with nothing: n_links 0, their own component.
    So do rows of null vec_id, whose component is null and which are kept. Vectors of other lengths don't link and are never padded: each
    frequent length has quantisers of its own, the others a single list a label. Repeated rows count once; rows of one vec_id with other vectors are one node that links where
    any of them does. An empty table gives an empty one.
    """
    spark, radius = vectors.sparkSession, float(np.sqrt(max(0.0, 2 - 2 * least)))
    # a row of null vec_id has no name that others could link with
    label = F.when(F.col("vec_id").isNotNull(), F.col("label").cast("string"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [u if label is not None else None for u, label in zip(_units(batch.column("embedding")), batch.column("label").to_pylist())]
            group = [f"{len(u) // 8}:{label}" if u else None for u, label in zip(raw, batch.column("label").to_pylist())]
            same = [xxhash.xxh3_128_digest(g.encode() + b"\0" + u) if u else None for g, u in zip(group, raw)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(group, pa.string()), pa.array(same, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "group", "same", "unit"])

    held = stored(rows.mapInArrow(units, "vec_id long, group string, same binary, unit binary"))
    classes = held.where("same is not null").select("vec_id", "group", "same", "unit").dropDuplicates(["vec_id", "same"]).groupBy("same").agg(F.first("group").alias("group"), F.first("unit").alias("unit"), F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    classes = stored(classes)
    fitted = {}
    for size, total in classes.groupBy(F.octet_length("unit").alias("size")).count().where(F.col("count") >= LEAST).orderBy(F.desc("count"), "size").limit(LENGTHS).collect():
        if SAMPLE_BYTES // size >= LEAST:
            sample = classes.where(F.octet_length("unit") == size).orderBy(F.xxhash64("node")).select("unit").limit(min(SAMPLE, SAMPLE_BYTES // size)).collect()
            fitted[size // 8] = Quantiser(np.array([np.frombuffer(r.unit) for r in sample]), int(min(1024, max(8, total // 1000))))
    quantisers = spark.sparkContext.broadcast(fitted)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(u) // 8 for u in batch.column("unit").to_pylist()])
            for dims in np.unique(sizes).tolist():
                own_size = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                q, x = _quantiser(quantisers.value, dims), np.array([np.frombuffer(u) for u in own_size.column("unit").to_pylist()])
                own = nearest(x, q.centres)
                codes, error = q.encode(x, own)
                probes = q.probes(x, own, radius) & (np.arange(len(q.centres)) > own[:, None])
                at = np.concatenate([np.arange(len(x)), np.nonzero(probes)[0]])
                number = np.concatenate([own, np.nonzero(probes)[1]])
                member = np.arange(len(at)) < len(x)
                taken = pa.Table.from_batches([own_size]).take(pa.array(at)).combine_chunks()
                coded = [codes[k].tobytes() if m else None for k, m in zip(at.tolist(), member.tolist())]
                yield from pa.table({"group": taken["group"], "list": pa.array(number, pa.int32()), "member": pa.array(member), "node": taken["node"], "weight": taken["weight"], "unit": taken["unit"], "code": pa.array(coded, pa.binary()), "error": pa.array(error[at])}).to_batches()

    met = stored(classes.select("group", "unit", "node", "weight").mapInArrow(listed, "group string, list int, member boolean, node long, weight long, unit binary, code binary, error double"))
    met = met.withColumn("cell", F.xxhash64("group", "list"))
    sizes = met.groupBy("cell").agg(F.count_if("member").alias("members"), F.count_if(~F.col("member")).alias("probes")).where((F.col("members") > BLOCK) | (F.col("probes") > 8 * BLOCK))
    met = met.join(sizes, "cell", "left")
    n_blocks = F.when(F.col("members") > BLOCK, F.ceil(F.col("members") / (BLOCK // 2))).otherwise(1).cast("int")
    n_parts = F.when(F.col("probes") > 8 * BLOCK, F.ceil(F.col("probes") / (4 * BLOCK))).otherwise(1).cast("int")
    met = met.withColumn("n_blocks", n_blocks).withColumn("n_parts", n_parts)
    met = met.withColumn("block", F.when(F.col("member"), F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")).otherwise(-1)).withColumn("own_part", F.pmod(F.xxhash64("node"), F.col("n_parts")).cast("int"))
    blocks, parts = F.sequence(F.lit(0), F.col("n_blocks") - 1), F.sequence(F.lit(0), F.col("n_parts") - 1)
    # a member meets the members of each block in one task, and the probes in one task for each part of them
    among = F.transform(blocks, lambda k: F.struct(F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j"), F.lit(-1).alias("part")))
    asked = F.transform(parts, lambda k: F.struct(F.col("block").alias("i"), F.col("block").alias("j"), k.alias("part")))
    asking = F.transform(blocks, lambda k: F.struct(k.alias("i"), k.alias("j"), F.col("own_part").alias("part")))
    met = met.withColumn("task", F.explode(F.when(F.col("member"), F.concat(among, asked)).otherwise(asking))).select("cell", "task.*", "block", "group", "list", "node", "weight", "unit", "code", "error")
    met = met.repartition("cell", "i", "j", "part").sortWithinPartitions("cell", "i", "j", "part")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in complete_groups(batches, ["cell", "i", "j", "part"]):
            if len(group["node"]) < 2:
                continue
            block, nodes, weights = (group[c].to_numpy(zero_copy_only=False) for c in ("block", "node", "weight"))
            i, j, part = (group[c][0].as_py() for c in ("i", "j", "part"))
            members = np.flatnonzero(block == j)
            queries = np.flatnonzero(block == (-1 if part >= 0 else i))
            if not len(members) or not len(queries):
                continue
            x = np.frombuffer(b"".join(group["unit"].to_pylist())).reshape(len(nodes), -1)
            q = _quantiser(quantisers.value, x.shape[1])
            names = np.unique(np.array(group["group"].to_pylist()), return_inverse=True)[1]
            codes = np.frombuffer(b"".join(group["code"].take(pa.array(members)).to_pylist()), np.uint8).reshape(len(members), -1)
            error, at = group["error"].to_numpy()[members], group["list"][0].as_py()
            counts, forest = np.zeros(len(nodes), np.int64), []
            for k in range(0, len(queries), BLOCK):
                some = queries[k : k + BLOCK]
                near = np.zeros((len(some), len(members)), bool)
                for m in range(0, len(some), 128):
                    a, b = np.nonzero(q.distances(x[some[m : m + 128]], codes, at) <= radius + error + SLACK)
                    a += m
                    right = (some[a] != members[b]) & (names[some[a]] == names[members[b]])
                    a, b = a[right], b[right]
                    right = np.einsum("ij,ij->i", x[some[a]], x[members[b]]) >= least
                    near[a[right], b[right]] = True
                counts[some] += near @ weights[members]
                if i != j or part >= 0:
                    counts[members] += weights[some] @ near
                rows = np.flatnonzero(near.any(axis=1))
                if len(rows):
                    columns = np.flatnonzero(near.any(axis=0))
                    part_nodes = np.concatenate([nodes[some[rows]], nodes[members[columns]]])
                    table = np.zeros((len(part_nodes), len(part_nodes)), bool)
                    table[: len(rows), len(rows) :] = near[np.ix_(rows, columns)]
                    forest.extend((part_nodes[a], part_nodes[b]) for a, b in _spanning(table | table.T))
            linked = np.flatnonzero(counts)
            if len(linked):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*nodes[linked].tolist(), *(int(a) for a, _ in forest)], pa.int64()), pa.array([None] * len(linked) + [int(b) for _, b in forest], pa.int64()), pa.array([*counts[linked].tolist(), *[0] * len(forest)], pa.int64())],
                    ["a", "b", "n"],
                )

    found = stored(met.mapInArrow(compare, "a long, b long, n long"))
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    named = classes.select("same", "node", "weight").join(links, "node", "left").join(roots, "node", "left")
    named = named.select("same", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    out = held.select("vec_id", "same").join(named, "same", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all `embeddings`."""
    return near_duplicates(read(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l USING (vec_id) LEFT JOIN counted c USING (vec_id)
"""
