"""Harmonic packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genescreen.llm.common import documents, read, split_words, stored, taken, task_cache, text_pieces

#: For each tokenizer file what a worker has loaded, and what its task has met: token ids (little-endian unsigned 32 bits) of parts of chunks.
_CACHES: dict[str, tuple] = {}
#: Parts beyond which a cache is emptied but for what the batch at hand needs.
CACHED = 250_000
#: Bytes of text that are encoded together: their words' places, sizes and ids take some thirty times as much.
PIECE = 1 << 21
#: ASCII punctuation but for what may begin or end a special token or a contraction.
_PUNCTUATION = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"


def tokenizer(path: str) -> tuple:
    """The tokenizer of a file, one with its merges alone, the ids that end a word, and a cache; loaded once a worker."""
    if path not in _CACHES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        whole = Tokenizer.from_file(path)
        merges = Tokenizer(whole.model)
        merges.pre_tokenizer = WhitespaceSplit()
        vocabulary = whole.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        _CACHES[path] = (whole, merges, ends, task_cache())
    return _CACHES[path]


def _letters() -> dict[int, int]:
    """Byte-level vocabularies write byte b as character b where that prints, the other bytes in order from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: 256 + n for n, b in enumerate(others)}


_BYTE_LETTERS = _letters()


def _plain(word: str) -> bool:
    """Letters that normalise to their lower case alone: ASCII, Latin-1 and Latin Extended-A but the dotted capital I and what lower-cases beyond."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0180" and not set(word) & set("\u0130\u0149\u0178\u017f\u00aa\u00ba\u0132\u0133\u013f\u0140")))


def _encode_parts(parts: list[bytes], loaded: tuple) -> dict[bytes, bytes]:
    """Ids of each part. Plain words go through the merges many at a time; each ends with the one id of its own that ends a word."""
    whole, merges, ends = loaded[:3]
    out: dict[bytes, bytes] = {}
    plain: list[tuple[bytes, str]] = []
    rest: list[tuple[bytes, str]] = []
    for x in parts:
        text = x.decode("utf-8", "replace")
        if text.isascii():
            (plain if text.isalpha() else rest).append((x, text))
        elif _plain(text):
            plain.append((x, text.lower().encode().decode("latin-1").translate(_BYTE_LETTERS)))
        else:
            rest.append((x, text))
    groups = [plain[k : k + 500] for k in range(0, len(plain), 500)]
    for group, found in zip(groups, merges.encode_batch_fast([" ".join([x[1] for x in g]) for g in groups], add_special_tokens=False)):
        ids = np.array(found.ids, "<u4")
        at = (4 * (np.flatnonzero(ends[ids]) + 1)).tolist()
        if len(at) != len(group):
            raise ValueError("a word has not exactly one id that ends a word")
        raw, start = ids.tobytes(), 0
        for (x, _), end in zip(group, at):
            out[x] = raw[start:end]
            start = end
    for (x, _), found in zip(rest, whole.encode_batch_fast([x[1] for x in rest], add_special_tokens=False)):
        out[x] = np.array(found.ids, "<u4").tobytes()
    return out


def part_ids(parts: pa.Array, path: str) -> list[bytes]:
    """Token ids of parts of chunks as little-endian unsigned 32 bits, each encoded once a worker while the cache holds."""
    loaded, names = tokenizer(path), parts.cast(pa.binary()).to_pylist()
    cache = loaded[3]
    cache[b""] = b""
    missing = [x for x in names if x not in cache]
    if missing:
        if len(cache) + len(missing) > CACHED:
            keep = {x: cache[x] for x in names if x in cache}
            cache.clear()
            cache.update(keep)
        cache.update(_encode_parts(missing, loaded))
    return list(map(cache.__getitem__, names))


def _stays_letters(stems: pa.Array) -> np.ndarray:
    """Is each stem all letters, also as the tokenizer sees it: composed and in lower case?

    The lower case of a letter may end in a combining mark (that of a dotted capital I does), as may the composed form, and the
    tokenizer joins such a mark to punctuation that follows.
    """
    letters = pc.utf8_is_alpha(stems).to_numpy(zero_copy_only=False).copy()
    foreign = np.flatnonzero(letters & ~pc.string_is_ascii(stems).to_numpy(zero_copy_only=False))
    letters[foreign] = [unicodedata.normalize("NFC", x).lower().isalpha() for x in stems.take(pa.array(foreign)).to_pylist()]
    return letters


def _cut(words: pa.Array, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Bytes `starts` to `starts + sizes` of each word."""
    whole = pa.concat_arrays([words])
    offsets, data = whole.buffers()[1:]
    first = np.frombuffer(offsets, np.int32)[: len(whole)] + starts
    found = taken(np.frombuffer(data, np.uint8), first, sizes) if data is not None else np.empty(0, np.uint8)
    return pa.StringArray.from_buffers(len(whole), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.py_buffer(found))


def encode(texts: pa.Array, path: str, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of whole texts one after the other, each followed by `end`, and how many each text has with that.

    For tokenizers that drop white space and end every word with an id of its own (byte-level merges with word ends, lower case): a
    text's ids are those of its blank-separated chunks. A chunk of letters (that stay letters) between ASCII punctuation splits further, as the tokenizer
    itself splits it; any other chunk, and so one that holds a special token, goes through the tokenizer whole. Distinct chunks are
    split and distinct parts encoded, then all ids are taken from them at once.
    """
    counts, at, words = split_words(texts)
    size = lambda x: pc.binary_length(x).to_numpy().astype(np.int64)
    left = pc.utf8_ltrim(words, characters=_PUNCTUATION)
    stems = pc.utf8_rtrim(left, characters=_PUNCTUATION)
    plain = _stays_letters(stems)
    # ASCII letters are lower-cased here; other letters are, where they are encoded
    own = pc.if_else(pa.array(plain), pc.ascii_lower(stems), words).dictionary_encode()
    sizes = size(words)
    before = np.where(plain, sizes - size(left), 0)
    after = np.where(plain, size(left) - size(stems), 0)
    marks = pa.concat_arrays([_cut(words, np.zeros(len(words), np.int64), before), _cut(words, sizes - after, after)]).dictionary_encode()
    parts = pa.concat_arrays([own.dictionary, marks.dictionary, pa.array([""])])
    found = [*part_ids(parts, path), end.tobytes()]
    ids, sizes = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
    starts = np.cumsum(sizes) - sizes
    # parts of each distinct chunk, and `end` as one more chunk
    mark = marks.indices.to_numpy().reshape(2, -1) + len(own.dictionary)
    three = np.concatenate([np.stack([mark[0], own.indices.to_numpy(), mark[1]], axis=1), [[len(parts) - 1, len(parts), len(parts) - 1]]])
    ids, sizes = taken(ids, starts[three].reshape(-1), sizes[three].reshape(-1)), sizes[three].sum(axis=1)
    starts = np.cumsum(sizes) - sizes
    at = np.insert(at, np.cumsum(counts), len(words))
    lengths = np.concatenate([[0], np.cumsum(sizes[at])])[np.concatenate([[0], np.cumsum(counts + 1)])]
    return taken(ids, starts[at], sizes[at]), np.diff(lengths)


@lru_cache(1 << 14)
def cuts(tokens: int, capacity: int) -> list[int]:
    """Sizes that a document of `tokens` ids is cut into: whole sequences, then the largest capacity // k that fits, again and again.

    Sizes up to a 64th of the capacity are not cut: capacity // size of them fill a sequence but for fewer ids than one has.
    """
    out = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        size = rest if rest <= capacity // 64 else capacity // -(-capacity // rest)
        out.append(size)
        rest -= size
    return out


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """doc_id, row, start, length, ids_crc32, doc_tokens (and ids): the pieces of every document, its ids followed by end_id."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    types = [pa.int64()] * 5 + [pa.binary()] * with_ids
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_pieces(batches, PIECE):
            tokens, sizes = encode(texts, path, end)
            own = [cuts(n, capacity) for n in sizes.tolist()]
            doc = np.repeat(np.arange(len(own)), np.fromiter(map(len, own), np.int64, len(own)))
            length = np.array([n for x in own for n in x], np.int64)
            ends = np.cumsum(length)
            raw = memoryview(tokens.tobytes())
            cut = [raw[4 * a : 4 * b] for a, b in zip((ends - length).tolist(), ends.tolist())]
            columns = [part.column("doc_id").take(pa.array(doc)), ends - length - (np.cumsum(sizes) - sizes)[doc], length, [zlib.crc32(x) for x in cut], sizes[doc]]
            columns += [[bytes(x) for x in cut]] * with_ids
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names)

    return documents(docs).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids)


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each piece, the longest first into the fullest sequence that has room."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used: list[int] = []
    where, offsets = [0] * len(lengths), [0] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        room = next((r for r in range(lengths[k], capacity) if rooms[r]), None)
        if room is None:
            used.append(0)
            bin_, room = len(used) - 1, capacity
        else:
            bin_ = rooms[room].pop()
        where[k], offsets[k] = bin_, used[bin_]
        used[bin_] += lengths[k]
        rooms[room - lengths[k]].append(bin_)
    return where, offsets


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with sequence_id and offset: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Pieces of one size form a class; capacity // size of them fill a sequence. Each of `class x worker` groups fills sequences of its
    own, a fixed number of pieces each, without looking at any other. What is left over in a group is fewer pieces than one sequence
    holds; those of all groups fill a class's sequences together, and what is left of a class, fewer than one sequence again, is packed
    by best fit in one task. That is at most one sequence's worth a class, so its size depends on the capacity alone.
    A null or empty text is end_id alone. Repeated rows and rows of null doc_id are packed each for itself. An empty table gives no pieces.
    """
    held = stored(pieces(docs, path, capacity, end_id, with_ids).withColumn("worker", F.spark_partition_id()).withColumn("n", F.monotonically_increasing_id()))
    fill = F.floor(F.lit(capacity) / F.col("length")).cast("long")
    # group totals are classes x workers rows; places within a group come from a window over it
    totals = held.groupBy("length", "worker").agg(F.count("*").alias("rows")).withColumn("own", F.floor(F.col("rows") / fill)).withColumn("over", F.col("rows") % fill)
    ahead = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("over_before", F.coalesce(F.sum("over").over(ahead), F.lit(0))).withColumn("over_all", F.sum("over").over(Window.partitionBy("length")))
    totals = totals.withColumn("over_bins", F.floor(F.col("over_all") / fill))
    sequences = stored(totals)
    # first sequence number of each group, and of each class's common sequences: running sums over groups
    groups = sequences.select("length", "worker", "own").unionByName(sequences.groupBy("length").agg(F.lit(-1).alias("worker"), F.first("over_bins").alias("own")))
    by_class = groups.groupBy("length").agg(F.sum("own").alias("own"))
    first = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    by_class = by_class.withColumn("class_first", F.coalesce(F.sum("own").over(first), F.lit(0)))
    within = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("before", F.coalesce(F.sum("own").over(within), F.lit(0))).join(by_class.select("length", "class_first"), "length").select("length", "worker", (F.col("before") + F.col("class_first")).alias("first_id"))
    common = groups.where("worker = -1").select("length", F.col("first_id").alias("common_id"))
    groups = sequences.join(groups.where("worker >= 0"), ["length", "worker"]).join(common, "length").select("length", "worker", "own", "over_before", "over_bins", "first_id", "common_id")
    all_full = by_class.agg(F.coalesce(F.sum("own"), F.lit(0)).alias("all_full"))

    place = F.row_number().over(Window.partitionBy("length", "worker").orderBy("n")) - 1
    dealt = held.withColumn("place", place).join(groups, ["length", "worker"])
    in_common = F.col("place") - F.col("own") * fill + F.col("over_before")
    dealt = dealt.withColumn("in_common", F.when(F.col("place") >= F.col("own") * fill, in_common))
    dealt = dealt.withColumn(
        "sequence_id",
        F.when(F.col("in_common").isNull(), F.col("first_id") + F.floor(F.col("place") / fill)).when(F.col("in_common") < F.col("over_bins") * fill, F.col("common_id") + F.floor(F.col("in_common") / fill)),
    ).withColumn("offset", (F.coalesce("in_common", "place") % fill) * F.col("length"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    dealt = stored(dealt.select(*names, "n", F.col("sequence_id").cast("long"), F.col("offset").cast("long")))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        where, offsets = best_fit(table.column("length").to_pylist(), capacity)
        first_id = table.column("all_full")[0].as_py()
        yield pa.RecordBatch.from_arrays([table.column("n").combine_chunks(), pa.array([first_id + w for w in where], pa.int64()), pa.array(offsets, pa.int64())], ["n", "rest_id", "rest_offset"])

    left = dealt.where("sequence_id is null").select("n", "length").crossJoin(F.broadcast(all_full)).coalesce(1).sortWithinPartitions("n").mapInArrow(rest, "n long, rest_id long, rest_offset long")
    full = dealt.where("sequence_id is not null").select(*names, "sequence_id", "offset")
    tail = dealt.where("sequence_id is null").join(left, "n").select(*names, F.col("rest_id").alias("sequence_id"), F.col("rest_offset").alias("offset"))
    return full.unionByName(tail)


def default_tokenizer() -> str:
    """The vocabulary file that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """All `documents` packed into sequences of at most 4096 tokens."""
    return pack(read(spark, sf_dir, "documents"), path or default_tokenizer())
