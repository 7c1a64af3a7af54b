"""SentencePiece ids of whole texts and back, by tables of distinct chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.chunks import BATCH, split_chunks, text_batches
from genescreen.llm.common import documents, read, taken

#: White space as pieces write it.
MARKER = "\u2581"
#: For each model file what a worker has loaded.
_MODELS: dict[str, tuple] = {}


def model(path: str) -> tuple:
    """The processor of a model file and the id of a lone marker; loaded once a worker.

    An error tells where chunks couldn't be segmented by themselves: pieces that hold a marker after another character or a newline
    beside others, texts that are normalised, or no marker in front.
    """
    if path not in _MODELS:
        from sentencepiece import SentencePieceProcessor

        found = SentencePieceProcessor(model_file=path)
        pieces = [found.id_to_piece(i) for i in range(found.get_piece_size())]
        if any(MARKER in p.lstrip(MARKER) or "\n" in p for p in pieces):
            raise ValueError("pieces of this model cross white space")
        if found.normalize("  a  \ufb01\u212b\n ") != f"{MARKER * 3}a{MARKER * 2}\ufb01\u212b\n{MARKER}":
            raise ValueError("this model normalises texts, or puts no marker in front of them")
        _MODELS[path] = (found, found.piece_to_id(MARKER))
    return _MODELS[path]


def segmented(chunks: list[str], path: str) -> list[list[int]]:
    """Ids of chunks that begin with a space or newline, as they are within a text.

    The library puts a marker in front of what it encodes. It stands for a chunk's first space; before a newline, which no piece
    holds with other characters, it is a piece of its own and goes.
    """
    found, marker = model(path)
    ids = found.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
    return [[marker] if c == " " else x if c[0] == " " else x[1:] for c, x in zip(chunks, ids)]


def _flat(x: pa.Array, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, and where the entries of a list or string array begin in them and how long they are."""
    offsets = np.frombuffer(x.buffers()[1], np.int32)[: len(x) + 1].astype(np.int64)
    return values, offsets[:-1], np.diff(offsets)


def chunk_table(distinct: pa.Array, path: str) -> tuple[pa.Array, pa.Array]:
    """Ids of each distinct chunk, segmented once, and the text that these decode to."""
    found, marker = model(path)
    ids = segmented(distinct.to_pylist(), path)
    plain = found.decode([[marker, *x] for x in ids], num_threads=1)  # the marker in front is what decoding drops
    return pa.array(ids, pa.list_(pa.int32())), pa.array(plain, pa.string())


def encode(docs: DataFrame, path: str, batch: int = BATCH) -> DataFrame:
    """doc_id, ids, decoded: every whole text's ids, as the library encodes it, and the text that they decode to.

    For models whose pieces cross no white space. Texts are cut into chunks of white space and what follows. The distinct chunks of
    about `batch` bytes of text make a table, each segmented and decoded once; ids and decoded bytes are joined back by place.
    Nothing is shuffled or kept from batch to batch, so memory is that of a batch, or of a single longer text.
    A null or empty text has no ids and decodes to an empty one. Repeated rows and rows of null doc_id stay, each for itself. An empty
    table gives an empty one. Other columns don't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, doc_ids, texts in text_batches(batches, batch):
            counts, at, distinct = split_chunks(pc.replace_substring(texts, MARKER, " "))
            of_ids, of_plain = chunk_table(distinct, path)
            ends = np.concatenate([[0], np.cumsum(counts)])
            first = ends[:-1][counts > 0]
            ids, starts, sizes = _flat(of_ids, of_ids.values.to_numpy())
            n_ids = np.concatenate([[0], np.cumsum(sizes[at])])[ends]
            lists = pa.ListArray.from_arrays(pa.array(n_ids, pa.int32()), pa.array(taken(ids, starts[at], sizes[at]), pa.int32()))
            data = of_plain.buffers()[2]
            plain, starts, sizes = _flat(of_plain, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8))
            starts, sizes = starts[at], sizes[at]
            starts[first] += 1  # the space put in front
            sizes[first] -= 1
            n_bytes = np.concatenate([[0], np.cumsum(sizes)])[ends]
            decoded = pa.StringArray.from_buffers(len(counts), pa.py_buffer(n_bytes.astype(np.int32)), pa.py_buffer(taken(plain, starts, sizes)))
            yield pa.RecordBatch.from_arrays([doc_ids, lists, decoded], ["doc_id", "ids", "decoded"])

    return documents(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decode(rows: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """The rows with `decoded`, the text of any list of ids as the library decodes it; null for null."""
    from pyspark.sql.types import StringType, StructType

    schema = StructType([*(f for f in rows.schema if f.name != "decoded")]).add("decoded", StringType())
    kept = [f.name for f in schema if f.name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = model(path)[0]
        for batch in batches:
            ids = batch.column(column).to_pylist()
            plain = found.decode([x or [] for x in ids], num_threads=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array([None if x is None else p for x, p in zip(ids, plain)], pa.string())], [*kept, "decoded"])

    return rows.select(*kept).mapInArrow(run, schema)


def default_model() -> str:
    """The model file that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """All `documents` encoded and decoded, with digests of both."""
    found = encode(read(spark, sf_dir, "documents"), path or default_model())
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
