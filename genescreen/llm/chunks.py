"""Texts as numbered chunks: batches of documents keep the place of each chunk, and each distinct chunk or pair is looked up once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genescreen.llm.common import complete_groups, packed, unpacked

#: Bytes of text that are coded together; a longer text is a batch of its own.
BATCH = 1 << 22


def _space_ends() -> np.ndarray:
    """By the last two bytes of a character: may it be white space beyond ASCII?"""
    out = np.zeros(1 << 16, bool)
    for c in map(chr, [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]):
        a, b = c.encode()[-2:]
        out[a << 8 | b] = True
    return out


_SPACE_ENDS = _space_ends()


def split_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of chunks of each text, the place of each chunk, text after text, among the distinct ones, and these.

    A text that isn't empty gets a space in front. A chunk begins there and at every space or newline that follows no white space (nor
    a control character), so it is a run of white space and what follows up to the next run, and each one begins with a space or newline.
    """
    whole = pa.concat_arrays([pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))])
    offsets, data = whole.buffers()[1:]
    offsets = np.frombuffer(offsets, np.int32)[: len(whole) + 1]
    raw = np.frombuffer(data, np.uint8)[: offsets[-1]] if data is not None else np.empty(0, np.uint8)
    begins = np.zeros(len(raw) + 1, bool)
    begins[1:-1] = ((raw[1:] == 32) | (raw[1:] == 10)) & (raw[:-1] > 32)
    begins[2:-1] &= ~_SPACE_ENDS[raw[:-2].astype(np.uint16) << 8 | raw[1:-1]]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    begins[-1] = False
    at = np.flatnonzero(begins)
    coded = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(raw)).astype(np.int32)), pa.py_buffer(raw)).dictionary_encode()
    ends = np.concatenate([[0], np.cumsum(begins)])
    return np.diff(ends[offsets]), coded.indices.to_numpy(), coded.dictionary


def squeezed(x: np.ndarray) -> bytes:
    """Numbers that aren't negative, compressed."""
    return zstandard.compress(packed(x), 3)


def opened(b: bytes) -> np.ndarray:
    """The numbers that squeezed() wrote."""
    return unpacked(zstandard.decompress(b)).astype(np.int64)


def text_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Array, pa.Array]]:
    """A number of its own, doc ids and texts (null ones as empty) of batches of about `most` bytes of text each."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.column("text").nbytes))
        for at in range(0, batch.num_rows, step):
            held.append(batch.slice(at, step))
            size += held[-1].column("text").nbytes
            if size >= most:
                yield number, *_columns(held)
                number, held, size = number + 1, [], 0
    if held:
        yield number, *_columns(held)


def _columns(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    texts = pa.concat_arrays([x.column("text").cast(pa.string()) for x in held])
    return pa.concat_arrays([x.column("doc_id").cast(pa.int64()) for x in held]), pc.fill_null(texts, "")


def rejoined(coded: DataFrame, entries: DataFrame, make: Callable[[dict, dict], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`make` applied to each batch's coded row and to what its entries (batch, code, ...) hold, in order of code.

    Batches and entries are dealt by batch and sorted, the coded row first; a task holds one batch at a time.
    """
    rows = coded.withColumn("code", F.lit(-1)).unionByName(entries, allowMissingColumns=True)
    own, found = [c for c in coded.columns], [c for c in entries.columns if c not in ("batch", "code")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in complete_groups(batches, ["batch"]):
            yield from make({c: group[c][0] for c in own}, {c: group[c].slice(1) for c in found})

    return rows.repartition("batch").sortWithinPartitions("batch", "code").mapInArrow(run, schema)
