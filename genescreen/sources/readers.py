"""Readers. Each row carries line_no (file, block, number in it), which orders rows as they stand in their files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genescreen.sources.sinks import stored

#: The columns of a hit, in order, and their types.
HIT_COLUMNS = [("qname", "string"), ("qlen", "long"), ("qstart", "long"), ("qend", "long"), ("strand", "string"), ("tname", "string"), ("tlen", "long"), ("tstart", "long"), ("tend", "long"), ("nmatch", "long"), ("alen", "long"), ("mapq", "long")]


def read_records(spark: SparkSession, path: str, separator: str | None = None, glob: str | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """value and line_no of each line, or of each piece between separators, and `extra` fields of its file; files are split among tasks."""
    reader = spark.read
    if separator:
        reader = reader.option("lineSep", separator)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    return reader.text(path).select("value", order.alias("line_no"), *[F.col(f"_metadata.{c}").alias(c) for c in extra])


def last_of(df: DataFrame, key: str, order: str = "line_no") -> DataFrame:
    """The last row of each key, by a grouped maximum that combines map-side."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("x")).select(key, "x.*")


def _tabs(value: Column, least: int) -> tuple[Column, Column]:
    parts = F.split(value, "\t")
    return parts, (F.trim(value) != "") & (F.size(parts) >= least)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """line_no, header, id, seq, length of each record: its lines after the header joined, blanks around them dropped."""
    lines = F.split(F.regexp_replace("value", "\r", ""), "\n")
    header = F.trim(F.regexp_replace(F.get(lines, 0), "^>", ""))
    rows = read_records(spark, path, "\n>").where(F.trim("value") != "").select("line_no", header.alias("header"), F.array_join(F.transform(F.slice(lines, 2, 1 << 30), lambda x: F.trim(x)), "").alias("seq"))
    return rows.select("line_no", "header", F.regexp_extract("header", r"^(\S+)", 1).alias("id"), "seq", F.length("seq").cast("long").alias("length"))


def _sequence_pieces(size: int):
    """Lines of a split, in order, to (file, block, stretch, name, at, seq): up to `size` letters or some more from place `at` of a stretch.

    A stretch is what a split has of one record; number 0 goes on with the record that the split before ended in.
    """
    names = ["file", "block", "stretch", "name", "at", "seq"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, stretch, name, at, held, n, rows = None, 0, None, 0, [], 0, []

        def close() -> None:
            nonlocal at, held, n
            if split and (n or (name is not None and at == 0)):
                rows.append((*split, stretch, name, at, "".join(held)))
            at, held, n = at + n, [], 0

        for batch in batches:
            for file, block, line in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value"))):
                if (file, block) != split:
                    close()
                    split, stretch, name, at = (file, block), 0, None, 0
                if line.startswith(">"):
                    close()
                    stretch, name, at = stretch + 1, (line[1:].split() or [""])[0], 0
                    continue
                held.append(line.replace("\r", "").strip(" "))
                n += len(held[-1])
                if n >= size:
                    close()
                if len(rows) >= 100:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
                    rows = []
        close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    return run


def read_contig_tiles(spark: SparkSession, path: str, size: int = 65_536) -> DataFrame:
    """tname, tile_no, seq: the sequences of FASTA records as pieces of `size` letters; a record is never one string.

    Files are read in splits. What a split has of a record goes on where the splits before left it: a prefix sum over a row a split
    and record. Lines are put together to pieces before anything is shuffled, and pieces meet by tile. A line itself is one string,
    so the file's sequence lines should be wrapped. Lines before a file's first header are left out; blanks around lines are dropped.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    pieces = stored(lines.mapInArrow(_sequence_pieces(size), "file string, block long, stretch long, name string, at long, seq string"))
    key = ["file", "block", "stretch"]
    ordered = Window.partitionBy("file").orderBy("block", "stretch")
    stretches = pieces.groupBy(*key).agg(F.max("name").alias("tname"), F.sum(F.length("seq")).alias("letters")).withColumn("record", F.sum((F.col("stretch") > 0).cast("long")).over(ordered))
    within = Window.partitionBy("file", "record").orderBy("block", "stretch")
    stretches = stretches.select(*key, "record", F.first("tname").over(within).alias("tname"), F.coalesce(F.sum("letters").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rows = pieces.join(stretches.where("record > 0"), key).where("seq <> ''").select("file", "record", "tname", (F.col("at") + F.col("before")).alias("at"), "seq")
    first, last = F.floor(F.col("at") / size), F.floor((F.col("at") + F.length("seq") - 1) / size)
    rows = rows.withColumn("tile_no", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    start = F.greatest(F.col("tile_no") * size - F.col("at"), F.lit(0))
    end = F.least((F.col("tile_no") + 1) * size - F.col("at"), F.length("seq"))
    cut = rows.select("file", "record", "tname", "tile_no", F.struct((F.col("at") + start).alias("at"), F.substring("seq", (start + 1).cast("int"), (end - start).cast("int")).alias("cut")).alias("x"))
    tiles = cut.groupBy("file", "record", "tname", "tile_no").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return tiles.select("tname", "tile_no", F.array_join(F.transform("x", lambda x: x.cut), "").alias("seq"))


def read_paf(spark: SparkSession, path: str) -> DataFrame:
    """Hits: the first twelve tab-separated columns; blank lines and lines of fewer columns are dropped, further columns ignored."""
    parts, usable = _tabs(F.col("value"), 12)
    return read_records(spark, path).where(usable).select(*[F.get(parts, k).cast(t).alias(c) for k, (c, t) in enumerate(HIT_COLUMNS)], "line_no")


def read_prediction_blocks(spark: SparkSession, path: str, delimiter: str = "anywhere", glob: str | None = None) -> DataFrame:
    """text, terminated, line_no of each block. delimiter: `anywhere` cuts at any //, `line` at lines that are //.

    Text keeps no // line; terminated is false for what stands after a file's last one. A line that begins with // ends a block too, and
    what else it has begins the next. Both forms are read in splits. For `line` the pieces are written once; whether a file's last piece
    is ended by a // without a line end follows from the file's size and that of its pieces (a compressed file's never is).
    """
    if delimiter == "anywhere":
        return read_records(spark, path, "//", glob).where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "").select(F.col("value").alias("text"), F.lit(True).alias("terminated"), "line_no")
    rows = read_records(spark, path, "\n//", glob, extra=("file_size",))
    rows = stored(rows.withColumn("bytes", F.octet_length("value").cast("long") + 3))
    # a row a file, from three narrow columns of the written pieces; its size decides how it is joined
    ends = rows.groupBy("line_no.file").agg(F.min("line_no").alias("first"), F.max("line_no").alias("last"), (F.sum("bytes") > F.max("file_size")).alias("open"))
    edges = ends.select(F.explode(F.array(F.struct(F.col("first").alias("line_no"), F.lit(True).alias("opens"), (F.col("open") & (F.col("first") == F.col("last"))).alias("open")), F.struct(F.col("last").alias("line_no"), F.lit(False).alias("opens"), F.col("open")))).alias("x")).select("x.*")
    edges = edges.groupBy("line_no").agg(F.max("opens").alias("opens"), F.max("open").alias("open"))
    rows = rows.join(edges, "line_no", "left")
    value = F.when(F.coalesce("opens", F.lit(False)), F.regexp_replace("value", "^//", "")).otherwise(F.col("value"))
    return rows.select(F.regexp_replace(value, r"^[ \t\r]*\n", "").alias("text"), (~F.coalesce("open", F.lit(False))).alias("terminated"), "line_no").where(F.trim(F.regexp_replace("text", r"\s+", " ")) != "")


def read_block_dir(spark: SparkSession, folder: str, glob: str = "*.gw.txt") -> DataFrame:
    """Blocks of all files of a folder whose names match, in path order; a file's end ends its last block. Files are read in splits.

    Of more than two slashes in a row the first two end the block, but for a split that begins among them.
    """
    return read_prediction_blocks(spark, folder, "anywhere", glob).select("text", "line_no")


def read_id_list(spark: SparkSession, path: str, mode: str = "line") -> DataFrame:
    """Distinct tid: whole lines (`line`), their first white-space token (`first_token`) or their first tab field (`first_tab`)."""
    line = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    tid = {"line": line, "first_token": F.regexp_extract(line, r"^(\S+)", 1), "first_tab": F.trim(F.get(F.split("value", "\t"), 0))}[mode]
    return spark.read.text(path).where(line != "").select(tid.alias("tid")).where("tid <> ''").distinct()


def read_alignment_pairs(spark: SparkSession, path: str) -> DataFrame:
    """tid, qseq, tseq: the first two non-blank lines after each header; records of fewer are lost, the last of a tid counts."""
    lines = F.transform(F.split("value", "\n"), lambda x: F.trim(F.regexp_replace(x, "\r", "")))
    lines = F.filter(lines, lambda x: x != "")
    rows = read_records(spark, path, "\n>").select("line_no", lines.alias("lines")).where(F.size("lines") >= 3)
    return last_of(rows.select(F.regexp_replace(F.get("lines", 0), "^>", "").alias("tid"), F.get("lines", 1).alias("qseq"), F.get("lines", 2).alias("tseq"), "line_no"), "tid")


def read_mutation_counts(spark: SparkSession, path: str) -> DataFrame:
    """tid, stop, shift, total; lines of under three columns are skipped, the last of a tid counts."""
    parts, usable = _tabs(F.col("value"), 3)
    rows = read_records(spark, path).where(usable).select(F.get(parts, 0).alias("tid"), F.get(parts, 1).cast("long").alias("stop"), F.get(parts, 2).cast("long").alias("shift"), "line_no")
    return last_of(rows, "tid").withColumn("total", F.col("stop") + F.col("shift"))


def read_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """key and text: the rest of the line after the first tab, tabs included; the last of a key counts."""
    parts = F.split("value", "\t", 2)
    return last_of(read_records(spark, path).where(F.size(parts) == 2).select(F.get(parts, 0).alias("key"), F.get(parts, 1).alias("text"), "line_no"), "key")


def read_biotypes(spark: SparkSession, path: str) -> DataFrame:
    """gene_id, tid, gene_biotype, transcript_biotype; lines of under four columns are skipped."""
    parts, usable = _tabs(F.col("value"), 4)
    return read_records(spark, path).where(usable).select(*[F.get(parts, k).alias(c) for k, c in enumerate(("gene_id", "tid", "gene_biotype", "transcript_biotype"))], "line_no")


def read_synteny(spark: SparkSession, path: str) -> DataFrame:
    """gid, chr, start, stop with reversed intervals swapped; lines of under four columns are skipped, the last of a gid counts."""
    parts, usable = _tabs(F.col("value"), 4)
    a, b = F.get(parts, 2).cast("long"), F.get(parts, 3).cast("long")
    return last_of(read_records(spark, path).where(usable).select(F.get(parts, 0).alias("gid"), F.get(parts, 1).alias("chr"), F.least(a, b).alias("start"), F.greatest(a, b).alias("stop"), "line_no"), "gid")


def read_gtf_exons(spark: SparkSession, path: str) -> DataFrame:
    """tid of each exon line that names one; blank lines, comments and lines of under nine columns are skipped."""
    parts, usable = _tabs(F.col("value"), 9)
    rows = spark.read.text(path).where(usable & ~F.col("value").startswith("#")).where(F.get(parts, 2) == "exon")
    return rows.select(F.regexp_extract(F.get(parts, 8), 'transcript_id "([^"]+)"', 1).alias("tid")).where("tid <> ''")
