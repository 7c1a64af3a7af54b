"""Line deduplication with levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid

import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.common import LOWER, documents, map_docs, read, shared_dir, stored

#: Documents of a batch at most, about.
BATCH = 50_000_000
#: Keys of a bucket at most, on average; a run of more gets more buckets as it is merged.
BUCKET = 2_000_000
BLANK = b" \t\n\x0b\x0c\r"


def line_keys(text: bytes | None, min_chars: int) -> list[bytes | None]:
    """For each line the hash of its key (stripped, A-Z lower-cased), None where the key is shorter than min_chars code points."""
    out: list[bytes | None] = []
    for line in (text or b"").split(b"\n"):
        key = line.strip(BLANK)
        long_enough = len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key.translate(LOWER)) if long_enough else None)
    return out


class LineRuns:
    """Sorted runs of (key, first_doc) in levels under a folder, one row per key over all runs.

    A run is a table in buckets by key, sorted within them, one file a bucket. A batch is put into the same buckets once; it then
    meets each run bucket by bucket in a merge anti-join, without a shuffle of either side, and what no run has becomes a run of level
    0. As soon as a level holds `fan_in` runs they are merged, bucket by bucket too, into one run of the next level, so a batch probes
    at most fan_in - 1 runs a level and a key is rewritten once a level. The folder's log says which runs there are, so a later job
    that opens the folder goes on where an earlier one ended.

    A merged run of over BUCKET keys a bucket gets twice the buckets, again and again until it hasn't, so what a task merges doesn't grow
    with the corpus. It takes one shuffle of the runs, once each time that they outgrow their buckets. Batches, whose size is bounded,
    keep the number they began with; a batch meets runs of fewer buckets first and is itself dealt anew for those of more, never a run.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, fan_in: int = 3) -> None:
        self.spark, self.path, self.fan_in = spark, path, fan_in
        self.levels: list[list[str]] = [[]]
        try:
            log = spark.read.parquet(f"{path}/log").orderBy("step").collect()  # a row a run that was ever written
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log = []
        self.step = len(log)
        self.buckets = log[0].buckets if log else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets_of = {row.name: row.buckets for row in log}
        self.known: set[str] = set()  # tables that this object made known to the session
        for row in log:
            self._placed(row.name, row.level)

    def _placed(self, name: str, level: int) -> None:
        """A run of level k > 0 takes the place of all runs of level k - 1."""
        while len(self.levels) <= level:
            self.levels.append([])
        if level:
            self.levels[level - 1] = []
        self.levels[level].append(name)

    def _written(self, df: DataFrame, buckets: int) -> str:
        name = f"genescreen_lines_{uuid.uuid4().hex}"
        df.write.bucketBy(buckets, "key").sortBy("key").option("path", f"{self.path}/{name}").saveAsTable(name)
        self.known.add(name)
        self.buckets_of[name] = buckets
        return name

    def _logged(self, name: str, level: int) -> None:
        self.spark.createDataFrame([(self.step, name, level, self.buckets_of[name])], "step long, name string, level int, buckets int").coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        self.step += 1
        self._placed(name, level)

    def run(self, name: str) -> DataFrame:
        """One run; a run of an earlier job is made known to the session."""
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} (key BINARY, first_doc BIGINT) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {self.buckets_of[name]} BUCKETS LOCATION '{self.path}/{name}'")
            self.known.add(name)
        return self.spark.table(name)

    def _forget(self, names: list[str]) -> None:
        """Take tables that this object made known out of the session's catalog; their files stay, and so what was read from them before can still be run."""
        for name in self.known.intersection(names):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.known.discard(name)

    def close(self) -> None:
        """Take the runs out of the session's catalog too; batches, and runs that were merged, left it as soon as they had been read."""
        self._forget(list(self.known))

    def runs(self) -> list[DataFrame]:
        """All runs, those of fewer buckets first."""
        return [self.run(name) for name in sorted((name for level in self.levels for name in level), key=self.buckets_of.get)]

    def unseen(self, batch: DataFrame) -> DataFrame:
        """Rows of a batch in buckets whose key no run has."""
        for run in self.runs():
            batch = batch.join(run.hint("merge"), "key", "left_anti")
        return batch

    def merged(self, runs: list[DataFrame], deal: int | None = None) -> DataFrame:
        """Runs as one, bucket by bucket; dealt to so many buckets if given."""
        whole = runs[0]
        for other in runs[1:]:
            whole = whole.unionByName(other)
        return (whole.repartition(deal, "key") if deal else whole).groupBy("key").agg(F.min("first_doc").alias("first_doc"))

    def compacted(self, names: list[str]) -> str:
        """A new run of all of some runs."""
        runs, before = [self.run(name) for name in names], {self.buckets_of[name] for name in names}
        n, buckets = sum(run.count() for run in runs), max(before)  # counts come from the files' footers
        while n > buckets * BUCKET:
            buckets *= 2
        name = self._written(self.merged(runs, None if before == {buckets} else buckets), buckets)
        self._forget(names)
        return name

    def add(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Add what is new of a batch (key, first_doc, further columns; one row a key) as a run, then compact. Its new rows, and those that some run had."""
        dealt = self._written(batch.repartition(self.buckets, "key").sortWithinPartitions("key"), self.buckets)
        batch = self.spark.table(dealt)
        self._forget([dealt])
        unseen = self.unseen(batch).select("key", "first_doc")
        dealt_anew = any(self.buckets_of[name] > self.buckets for level in self.levels for name in level)
        name = self._written(unseen.repartition(self.buckets, "key") if dealt_anew else unseen, self.buckets)
        keys = self.run(name).select("key").hint("merge")
        self._logged(name, 0)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fan_in:
                self._logged(self.compacted(self.levels[level]), level + 1)
        return batch.join(keys, "key", "left_semi"), batch.join(keys, "key", "left_anti")


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, carry: tuple[str, ...] = (), runs: LineRuns | None = None) -> DataFrame:
    """Drop lines whose key stands in a document of smaller doc_id: doc_id, n_lines, n_dropped, kept (text), and the columns to carry along.

    A key is the line stripped of blanks at both ends with A-Z lower-cased; keys under `min_chars` code points are never dropped.
    All lines of a key in the smallest doc_id that holds it stay. Documents are taken in ranges of doc_id in ascending order, `batches`
    of them or as many as hold BATCH documents each, so a key found in the runs was first seen in a smaller doc_id. With `runs` of an
    earlier job, all its documents come before these. Within a batch the first document comes from a map-side
    minimum, so a line that most documents share is one row per task; the join that finds its documents is a sort-merge join
    whose hot key Spark splits. Null or empty text: one empty line, which stays. An empty table gives an empty one. Rows that
    repeat a doc_id each keep their own lines and count as one document. Rows of null doc_id keep all their lines and take none from others.
    """
    spark, whole, docs = docs.sparkSession, docs, documents(docs)
    carried = whole.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(c).alias(f"carried_{k}") for k, c in enumerate(carry)])

    def keys(ids, texts):
        out_ids, out_keys = [], []
        for i, text in zip(ids.tolist(), texts):
            mine = set(line_keys(text, min_chars))
            mine.discard(None)
            out_keys.extend(mine)
            out_ids.extend([i] * len(mine))
        return {"doc_id": out_ids, "key": out_keys}

    known = docs.where("doc_id is not null")
    batches = max(batches, -(-known.count() // BATCH))
    bounds = known.approxQuantile("doc_id", [k / batches for k in range(1, batches)], min(0.02, 0.2 / batches)) if batches > 1 else []
    bounds = sorted({int(b) for b in bounds})
    batch = F.lit(0)
    for b in bounds:
        batch = batch + (F.col("doc_id") > b).cast("int")
    held = stored(map_docs(known, keys, "doc_id long, key binary").withColumn("batch", batch), partition_by="batch")
    runs, drops = runs or LineRuns(spark, f"{shared_dir(spark)}/genescreen-lines-{uuid.uuid4().hex}"), None
    for k in range(len(bounds) + 1):
        mine = held.where(F.col("batch") == k).select("doc_id", "key")
        new, old = runs.add(mine.groupBy("key").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")))
        # only keys that some document of the batch must drop meet its lines
        repeated = new.where("last_doc > first_doc").select("key", "first_doc").unionByName(old.select("key", F.lit(None).cast("long").alias("first_doc")))
        gone = mine.join(stored(repeated), "key").where("first_doc is null or doc_id > first_doc").select("doc_id", "key")
        drops = gone if drops is None else drops.unionByName(gone)
    runs.close()
    drops = drops.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    joined = carried.join(drops, "doc_id", "left")
    kinds = "".join(f", carried_{k} {carried.schema[f'carried_{k}'].dataType.simpleString()}" for k in range(len(carry)))

    names = [f"carried_{k}" for k in range(len(carry))]

    def keep(batches_):
        for batch_ in batches_:
            rows = []
            for i, text, gone_ in zip(batch_.column("doc_id").to_pylist(), batch_.column("text").cast(pa.binary()).to_pylist(), batch_.column("keys").to_pylist()):
                text = text or b""
                lines = text.split(b"\n")
                if gone_:
                    gone_ = set(gone_)
                    kept = [line for line, key in zip(lines, line_keys(text, min_chars)) if key not in gone_]
                    rows.append((i, len(lines), len(lines) - len(kept), b"\n".join(kept)))
                else:
                    rows.append((i, len(lines), 0, text))
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()).cast(pa.string()), *[batch_.column(c) for c in names]], ["doc_id", "n_lines", "n_dropped", "kept", *names])

    out = joined.mapInArrow(keep, "doc_id long, n_lines long, n_dropped long, kept string" + kinds)
    return out.withColumnsRenamed({f"carried_{k}": c for k, c in enumerate(carry)})


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of `documents` deduplicated; the kept text as a digest."""
    return dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(str_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(str_split(coalesce(text, ''), chr(10)), 1) AS n
  FROM documents),
keyed AS (
  SELECT doc_id, n, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT k.doc_id, k.n, k.line, coalesce(f.first_doc < k.doc_id, false) AS gone FROM keyed k LEFT JOIN firsts f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
