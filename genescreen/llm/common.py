"""Helpers shared by the document operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.sources.sinks import scratch_path

#: Rows of an Arrow batch of documents.
ROWS = 1000
#: Byte table: A-Z to a-z, everything else unchanged.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Byte table: letters lower-cased, digits and bytes of non-ASCII characters kept, the rest blank.
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


#: What task_cache() gave out in this process.
_TASK_CACHES: list[dict] = []


def task_cache() -> dict:
    """A dictionary for what a worker meets again and again, emptied at the end of each task over texts.

    Spark keeps more Python workers than tasks run at once, takes them in turn, and uses them for one stage after the other.
    """
    _TASK_CACHES.append({})
    return _TASK_CACHES[-1]


def give_back() -> None:
    """Memory that Arrow and the C library keep for later goes back to the machine, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.pythonapi, "malloc_trim", None)
    if trim:
        trim(0)


def end_task() -> None:
    """Leave a worker without what its task has met, as it may be idle next or run another stage."""
    for cache in _TASK_CACHES:
        cache.clear()
    give_back()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the tables under a folder."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where it is unset one of the warehouse; never a machine's own on a cluster."""
    return scratch_path(spark, "").rsplit("/", 1)[0]


def stored(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write the rows as a Parquet table in the shared folder and read them again: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/genescreen-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(df: DataFrame) -> DataFrame:
    """doc_id and text alone, as long and string; other columns, whatever their names, don't matter.

    Where the session leaves the rows of an Arrow batch at Spark's default, they are set to ROWS: texts are long, and a batch is held
    several times over on its way between an executor and its Python workers.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def doc_batches(batches: Iterator[pa.RecordBatch], most: int = 1 << 24) -> Iterator[tuple[np.ndarray, list[bytes | None]]]:
    """doc ids and texts as bytes of (doc_id, text, ...) batches, in pieces of about `most` bytes of text; null ids are None."""
    try:
        for batch in batches:
            size = max(1, batch.column("text").nbytes)
            step = max(1, batch.num_rows * most // size)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = part.column("doc_id")
                yield np.array(ids.to_pylist(), object) if ids.null_count else ids.to_numpy(zero_copy_only=False), part.column("text").cast(pa.binary()).to_pylist()
                give_back()
    finally:
        end_task()


def text_pieces(batches: Iterator[pa.RecordBatch], most: int = 1 << 24) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Pieces of about `most` bytes of text of (text, ...) batches, and their texts with nulls as empty ones."""
    try:
        for batch in batches:
            step = max(1, batch.num_rows * most // max(1, batch.column("text").nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                yield part, pc.fill_null(part.column("text").cast(pa.string()), "")
                give_back()
    finally:
        end_task()


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """Texts with every byte replaced as a table of 256 bytes says."""
    whole = pa.concat_arrays([texts])  # offsets from zero
    offsets, data = whole.buffers()[1:]
    new = np.frombuffer(table, np.uint8)[np.frombuffer(data, np.uint8)] if data is not None and data.size else np.empty(0, np.uint8)
    return pa.StringArray.from_buffers(len(whole), offsets, pa.py_buffer(new))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of words of each text, the place of each word, text after text, among the distinct ones, and these. ASCII white space separates words."""
    parts = pc.ascii_split_whitespace(texts)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    flat = parts.values.slice(offsets[0], offsets[-1] - offsets[0])
    some = pc.not_equal(pc.binary_length(flat), 0)
    ends = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    coded = flat.filter(some).dictionary_encode()
    return np.diff(ends[offsets - offsets[0]]), coded.indices.to_numpy(), coded.dictionary


def taken(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `flat` that begin at `starts` and have `sizes` entries, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


def planes(x: np.ndarray) -> bytes:
    """Bytes of all numbers by significance, so that a general codec shrinks small numbers."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes() if len(x) else b""


def unplaned(b: bytes, dtype: str) -> np.ndarray:
    """The numbers that planes() wrote."""
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def packed(x: np.ndarray) -> bytes:
    """Numbers that aren't negative in as many bytes each as the largest needs, by significance."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpacked(b: bytes) -> np.ndarray:
    """The numbers that packed() wrote, as unsigned 64-bit ones."""
    rows = np.frombuffer(b, np.uint8)[1:].reshape(b[0], -1)
    out = np.zeros((rows.shape[1], 8), np.uint8)
    out[:, : b[0]] = rows.T
    return out.reshape(-1).view("<u8")


def map_docs(df: DataFrame, make: Callable[[np.ndarray, list[bytes | None]], dict | None], schema: str, extra: Callable | None = None) -> DataFrame:
    """Apply `make` to pieces of (doc_id, text) and return its columns (a dict of arrays or lists) as rows."""
    from pyspark.sql.types import StructType

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in doc_batches(batches):
            columns = make(ids, texts)
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def complete_tables(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 100_000) -> Iterator[dict[str, pa.Array]]:
    """Columns of some whole groups at a time, of at least `least` rows together but at the end, from batches that are sorted by integer keys."""
    held: list[pa.RecordBatch] = []

    def joined() -> dict[str, pa.Array]:
        table = pa.Table.from_batches(held).combine_chunks()
        return {c: table.column(c).chunk(0) for c in table.column_names}

    for batch in batches:
        if not batch.num_rows:
            continue
        if sum(b.num_rows for b in held) >= least:
            columns = [(batch.column(k).to_numpy(zero_copy_only=False), held[-1].column(k)[held[-1].num_rows - 1].as_py()) for k in keys]
            other = np.flatnonzero(np.logical_or.reduce([c != last for c, last in columns]))
            if len(other):  # the last group held ends here
                held.append(batch.slice(0, other[0]))
                yield joined()
                held, batch = [], batch.slice(other[0])
        held.append(batch)
    if held:
        yield joined()


def complete_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray | pa.Array]]:
    """Columns of one group after the other from batches that are sorted by integer keys; holds one group at a time."""
    held: list[pa.RecordBatch] = []

    def last_key(batch: pa.RecordBatch) -> tuple:
        return tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)

    def joined() -> dict:
        table = pa.Table.from_batches(held).combine_chunks()
        return {c: table.column(c).chunk(0) for c in table.column_names}

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(max(0, batch.num_rows - 1), bool)
        for c in columns:
            changed |= c[1:] != c[:-1]
        starts = [0, *(np.flatnonzero(changed) + 1).tolist()]
        if held and last_key(held[-1]) != tuple(c[0].item() for c in columns):
            yield joined()
            held = []
        for s, e in zip(starts, [*starts[1:], batch.num_rows]):
            held.append(batch.slice(s, e - s))
            if e < batch.num_rows:
                yield joined()
                held = []
    if held:
        yield joined()
