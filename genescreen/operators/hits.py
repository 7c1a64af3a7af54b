"""Alignment hits: metrics, filters, best hits, loci and copies."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genescreen.sources.sinks import stored


def hit_metrics(hits: DataFrame) -> DataFrame:
    """qcov and ident of hits with positive lengths; the others are dropped."""
    usable = hits.where("alen > 0 and qlen > 0")
    return usable.withColumn("qcov", (F.col("qend") - F.col("qstart")) / F.col("qlen")).withColumn("ident", F.col("nmatch") / F.col("alen"))


def filter_hits(hits: DataFrame, min_aln_len: int = 30, min_cov: float = 0.3, min_id: float = 0.3, min_mapq: int = 0) -> DataFrame:
    """Hits that reach all thresholds, with their metrics."""
    return hit_metrics(hits).where((F.col("alen") >= min_aln_len) & (F.col("mapq") >= min_mapq) & (F.col("qcov") >= min_cov) & (F.col("ident") >= min_id))


def best_hit(hits: DataFrame, order: list[str], min_len: int = 30, min_mapq: int = 0) -> DataFrame:
    """Per query the hit of the largest alen, the first by `order` among equals: a grouped minimum, combined map-side, that no hot query can skew."""
    kept = hits.where((F.col("alen") >= min_len) & (F.col("mapq") >= min_mapq))
    best = kept.groupBy("qname").agg(F.min_by(F.struct("strand", "tname", "tstart", "tend", "tlen", "alen", "mapq"), F.struct(-F.col("alen"), *order)).alias("x"))
    return best.select(F.col("qname").alias("gene"), "x.*")


def add_flanks(best: DataFrame, flank: int = 1000) -> DataFrame:
    """Regions widened by `flank` on both sides within their contig."""
    return best.withColumn("tstart", F.greatest(F.lit(0), F.col("tstart") - flank)).withColumn("tend", F.least("tlen", F.col("tend") + flank))


def region_jobs(flanked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jobs with 1-based closed regions and safe ids, and the regions that are none, with their reason."""
    rows = safe_id(flanked.withColumn("start1", F.col("tstart") + 1).withColumn("end1", F.col("tend")), "gene")
    bad = (F.col("start1") < 1) | (F.col("end1") < F.col("start1"))
    jobs = rows.where(~bad).select("gene", "strand", "tname", "start1", "end1", "safe_id")
    return jobs, rows.where(bad).select("gene", "tname", "start1", "end1", F.lit("invalid_region").alias("reason"))


def safe_id(df: DataFrame, column: str) -> DataFrame:
    """safe_id: the column with all but letters, digits, _ . - replaced by _."""
    return df.withColumn("safe_id", F.regexp_replace(column, "[^A-Za-z0-9_.-]", "_"))


def reach_before(rows: DataFrame, keys: list[str], start: str, end: str, size: int, keep_carried: bool = False, ends: DataFrame | None = None) -> DataFrame:
    """The rows with `tile` and `reach`: the furthest end of all rows before one in order of start and end within its keys (null: none is).

    A prefix maximum on two levels: rows are dealt by keys and tile (starts within `size` of each other), each tile's furthest end is
    taken map-side, a scan over these, a row a tile, says what reaches each tile from the ones before, and that joins its rows as one
    more row in front, which keep_carried leaves in, with the flag `carried`. So a group of any size spreads over its tiles.
    ends: rows with the same furthest ends that are cheaper to get; by default the rows themselves.
    """
    tile = F.floor(F.col(start) / size).cast("long")
    tiled = rows.withColumn("tile", tile)
    scan = Window.partitionBy(*keys).orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    far = (rows if ends is None else ends).groupBy(*keys, tile.alias("tile")).agg(F.max(end).alias("far")).withColumn("reach", F.max("far").over(scan)).where("reach is not null")
    both = tiled.withColumn("carried", F.lit(False)).unionByName(far.select(*keys, "tile", F.col("reach").alias(end), F.lit(True).alias("carried")), allowMissingColumns=True)
    place = Window.partitionBy(*keys, "tile").orderBy(F.desc("carried"), start, end)
    reached = both.withColumn("reach", F.max(end).over(place.rowsBetween(Window.unboundedPreceding, -1)))
    return reached if keep_carried else reached.where("not carried").drop("carried")


def islands(rows: DataFrame, keys: list[str], start: str, end: str, gap: int, size: int, name: str) -> DataFrame:
    """The rows with the number of their island within their keys, from 1: a new one starts beyond the furthest end so far plus the gap.

    Numbers are counted within tiles of `size` and added up over tiles, a row a tile. The gap isn't negative.
    """
    opens = F.when(F.col("carried"), F.lit(0)).otherwise(F.coalesce((F.col(start) > F.col("reach") + gap).cast("long"), F.lit(1))).cast("long")
    # the order that `reach` was taken in, so nothing is sorted again, and of rows of one place the first, which alone can open an island, stays first
    within = Window.partitionBy(*keys, "tile").orderBy(F.desc("carried"), start, end).rowsBetween(Window.unboundedPreceding, 0)
    reached = reach_before(rows, keys, start, end, size, keep_carried=True)
    numbered = stored(reached.withColumn("opens", opens).withColumn(name, F.sum("opens").over(within)).where("not carried").drop("carried", "reach", "opens"))
    scan = Window.partitionBy(*keys).orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    first = numbered.groupBy(*keys, "tile").agg(F.max(name).alias("own")).withColumn("first", F.sum("own").over(scan)).where("first is not null").drop("own")
    # a group's first tile has nothing before it, and most groups have no other
    return numbered.join(first, [*keys, "tile"], "left").withColumn(name, F.col(name) + F.coalesce("first", F.lit(0))).drop("tile", "first")


def locus_clusters(hits: DataFrame, target_gap: int = 10_000, tile: int = 1 << 20) -> DataFrame:
    """Hits with their locus number within query and contig: a new one starts beyond the furthest end so far plus the gap."""
    return islands(hits, ["qname", "tname"], "tstart", "tend", target_gap, tile, "locus")


def merged_query_coverage(loci: DataFrame, tile: int = 1 << 14) -> DataFrame:
    """Per locus the share of the query that its hits cover together; gaps and islands over query intervals, touching ones merged.

    Of hits that start at one place of the query only the furthest counts, so a locus has at most qlen rows after a map-side maximum.
    """
    key = ["qname", "tname", "locus"]
    starts = loci.groupBy(*key, "qstart").agg(F.max("qend").alias("qend"), F.max("qlen").alias("qlen"), F.count("*").alias("n"))
    # what an interval adds beyond the furthest end so far; it starts no earlier than those before it
    added = F.greatest(F.lit(0), F.col("qend") - F.greatest(F.col("qstart"), F.coalesce("reach", "qstart")))
    rows = reach_before(starts, key, "qstart", "qend", tile, ends=loci).withColumn("added", added)
    return rows.groupBy(*key).agg((F.sum("added") / F.max("qlen")).alias("cov"), F.max("qlen").alias("qlen"), F.sum("n").alias("n_hits"))


def full_copies(passing: DataFrame, copy_cov: float = 0.8, target_gap: int = 10_000, tile: int = 1 << 20) -> DataFrame:
    """qname, full_copy_count: loci of passing hits that cover copy_cov of each query."""
    loci = locus_clusters(passing.select("qname", "tname", "tstart", "tend", "qstart", "qend", "qlen"), target_gap, tile)
    return merged_query_coverage(loci).groupBy("qname").agg(F.count_if(F.col("cov") >= copy_cov).alias("full_copy_count"))


def functional_redundancy(hits: DataFrame, copy_cov: float = 0.8, target_gap: int = 10_000, tile: int = 1 << 20, **thresholds) -> DataFrame:
    """Per query with a passing hit: best_cov, best_id, full_copy_count (loci that cover copy_cov of it), redundant (two or more)."""
    passing = filter_hits(hits, **thresholds)
    copies = full_copies(passing, copy_cov, target_gap, tile)
    best = passing.groupBy("qname").agg(F.max("qcov").alias("best_cov"), F.max("ident").alias("best_id"))
    return best.join(copies, "qname").select(F.col("qname").alias("query"), "best_cov", "best_id", "full_copy_count", (F.col("full_copy_count") >= 2).alias("redundant"))


def _fold(batches: Iterator[pa.RecordBatch], overlap_frac: float, part: int | None, with_rows: bool) -> Iterator[pa.RecordBatch]:
    """Hits in order of query, contig and place, and after each stretch of one query and contig a row with what the scan left.

    A hit whose overlap with the current interval is under overlap_frac of the shorter one opens a new interval, else it extends it.
    A batch may bring the interval (s, e) that a stretch starts with. Only the current interval is held.
    """
    names = ["part", "qname", "tname", "tstart", "tend", "stretch", "n", "s", "e", "used_s", "used_e"]
    types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 5]
    key, state = None, ()

    def ended(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    for batch in batches:
        rows, left = [], []
        columns = [batch.column(c).to_pylist() for c in batch.schema.names]
        for at, q, t, start, end, s0, e0 in zip(*columns):
            if (at, q, t) != key:
                if key:
                    left.append((part if part is not None else key[0], *key[1:], None, None, True, *state))
                key, (n, s, e, used_s, used_e) = (at, q, t), (0, s0, e0, s0, e0)
            overlap = -1.0 if e is None else max(0, min(e, end) - max(s, start)) / max(1, min(e - s, end - start))
            if overlap < overlap_frac:
                n, s, e = n + 1, start, end
            else:
                e = max(e, end)
            state = (n, s, e, used_s, used_e)
        if with_rows and batch.num_rows:
            blank = [pa.nulls(batch.num_rows, pa.int64())] * 5
            own = pa.array([part] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([own, *(batch.column(c) for c in names[1:5]), pa.array([False] * batch.num_rows), *blank], names)
        if left:
            yield ended(left)
    if key:
        yield ended([(part if part is not None else key[0], *key[1:], None, None, True, *state)])


def greedy_counts(hits: DataFrame, overlap_frac: float = 0.5) -> DataFrame:
    """qname, hit_count: how many intervals a greedy scan over (tname, tstart, tend) leaves of each query's hits; a contig starts anew.

    Hits are dealt by ranges of query, contig and place and each task folds its own, so a query of any size, and an island of hits that
    overlap on end, spread over tasks, and no row holds more than a hit. Where a task goes on with another's query and contig the fold
    started without the interval that comes in. Such stretches are folded again with what the one before left, in rounds, until each
    one had what came in. A stretch mostly forgets what came in within a few hits, so one round is common.
    """
    order = ["qname", "tname", "tstart", "tend"]
    fields = "part int, qname string, tname string, tstart long, tend long, stretch boolean, n long, s long, e long, used_s long, used_e long"
    none = F.lit(None).cast("long")
    dealt = hits.select(*[F.col(c).cast("long" if c in ("tstart", "tend") else "string").alias(c) for c in order]).repartitionByRange(*order).sortWithinPartitions(*order)
    first = dealt.select(F.lit(0).alias("part"), *order, none.alias("s0"), none.alias("e0"))
    held = stored(first.mapInArrow(lambda batches: _fold(batches, overlap_frac, TaskContext.get().partitionId(), True), fields))
    keys, state = ["part", "qname", "tname"], ["n", "s", "e", "used_s", "used_e"]
    stretches = held.where("stretch").select(*keys, *state)
    chain = Window.partitionBy("qname", "tname").orderBy("part")
    while True:
        come = stretches.withColumn("s0", F.lag("s").over(chain)).withColumn("e0", F.lag("e").over(chain))
        again = stored(come.where(~(F.col("s0").eqNullSafe(F.col("used_s")) & F.col("e0").eqNullSafe(F.col("used_e")))).select(*keys, "s0", "e0"))
        if again.isEmpty():
            return stretches.groupBy("qname").agg(F.sum("n").alias("hit_count"))
        rows = held.where("not stretch").select(*keys, "tstart", "tend").join(again, keys).select(*keys, "tstart", "tend", "s0", "e0")
        folded = rows.repartition(*keys).sortWithinPartitions(*keys, "tstart", "tend").mapInArrow(lambda batches: _fold(batches, overlap_frac, None, False), fields)
        stretches = stored(stretches.join(again.select(*keys), keys, "left_anti").unionByName(folded.select(*keys, *state)))


def hit_multiplicity(hits: DataFrame, order: list[str], overlap_frac: float = 0.5, max_hits: int = 1, **thresholds) -> DataFrame:
    """Per query its best hit (largest nmatch, first by `order`), and how many hits a greedy scan by place leaves apart."""
    passing = filter_hits(hits, **thresholds)
    counts = greedy_counts(passing, overlap_frac)
    best = passing.groupBy("qname").agg(F.min_by(F.struct(F.col("qcov").alias("best_cov"), F.col("ident").alias("best_id"), F.col("alen").alias("best_alen"), F.col("tname").alias("best_tname"), F.col("tstart").alias("best_tstart"), F.col("tend").alias("best_tend")), F.struct(-F.col("nmatch"), *order)).alias("x"))
    return best.join(counts, "qname").select(F.col("qname").alias("query"), "x.*", "hit_count", F.col("hit_count").between(1, max_hits).alias("passes"))
