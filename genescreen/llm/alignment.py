"""Token groups that two tokenizers agree on, and how often their ids stand linked in the whole corpus."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genescreen.llm.chunks import BATCH, opened, rejoined, split_chunks, squeezed, text_batches
from genescreen.llm.common import documents, read, stored, taken
from genescreen.llm.sentencepieces import MARKER, model, segmented

#: For each pair of vocabulary files what a worker has loaded.
_LOADED: dict[tuple[str, str], tuple] = {}
#: Chunks that go through a tokenizer at once.
TOGETHER = 200


class Tokens:
    """Bytes of a vocabulary's tokens, end to end, and the decimal ids, each with a comma."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.flat, self.starts, self.sizes = _end_to_end(tokens)
        self.names = _end_to_end([b"%d," % i for i in range(len(tokens))])


def _end_to_end(items: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and where each item begins and how long it is."""
    sizes = np.fromiter(map(len, items), np.int64, len(items))
    return np.frombuffer(b"".join(items), np.uint8), np.cumsum(sizes) - sizes, sizes


def _loaded(a_path: str, b_path: str) -> tuple:
    """Tokenizer A, and the tokens of A and B; loaded once a worker."""
    if (a_path, b_path) not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(a_path)
        whole.encode_special_tokens = True
        # byte-level vocabularies write byte b as character b where that prints, the other bytes in order from 256 on
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in prints} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in prints)}
        words = [whole.id_to_token(i) or "" for i in range(max(whole.get_vocab().values()) + 1)]
        a = [bytes(byte_of[c] for c in x) if all(c in byte_of for c in x) else b"" for x in words]
        pieces, _ = model(b_path)
        words = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
        b = [bytes([int(x[3:-1], 16)]) if pieces.is_byte(i) else x.replace(MARKER, " ").encode() for i, x in enumerate(words)]
        _LOADED[a_path, b_path] = whole, Tokens(a), Tokens(b)
    return _LOADED[a_path, b_path]


def groups(a_ends: list[int], b_ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B stand up to each place where tokens of both end.

    Each end points to how many tokens stand up to it; the ends that both dictionaries have, sorted, cut both lists into groups.
    """
    a_at, b_at = dict(zip(a_ends, range(1, len(a_ends) + 1))), dict(zip(b_ends, range(1, len(b_ends) + 1)))
    common = sorted(a_at.keys() & b_at.keys())
    return np.fromiter(map(a_at.__getitem__, common), np.int64, len(common)), np.fromiter(map(b_at.__getitem__, common), np.int64, len(common))


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of tokens of A and B whose bytes overlap.

    Between two successive ends of either there is one token of each; within a group of m and n tokens these are m + n - 1 links.
    """
    ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    ends = ends[np.diff(ends, prepend=0) > 0]
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def _within(chunks: list[str], encode: Callable[[list[str]], list], tokens: Tokens, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids end to end, how many each chunk has, and whether their bytes are the chunk.

    What ends in no white space goes through the tokenizer TOGETHER chunks at a time, as a text does, and tokens end where chunks end.
    Where they don't all do so, and for chunks that end in white space, each chunk goes alone.
    """
    alone = np.array([c[-1:].isspace() or c[-1:] < "!" for c in chunks], bool)
    many = np.flatnonzero(~alone)
    stretches = [many[k : k + TOGETHER] for k in range(0, len(many), TOGETHER)]
    counts, found = np.zeros(len(chunks), np.int64), [np.empty(0, np.int64)] * len(chunks)
    for own, ids in zip(stretches, encode(["".join([chunks[k] for k in x]) for x in stretches])):
        ids = np.array(ids, np.int64)
        ends, wanted = np.cumsum(tokens.sizes[ids]), np.cumsum(sizes[own])
        at = np.searchsorted(ends, wanted)
        if len(ends) and ends[-1] == wanted[-1] and np.array_equal(ends[at], wanted):
            counts[own], found[own[0]] = np.diff(at, prepend=-1), ids  # in the place of the first: the others' follow it
        else:
            alone[own] = True
    single = np.flatnonzero(alone)
    for k, ids in zip(single.tolist(), encode([chunks[k] for k in single])):
        counts[k], found[k] = len(ids), np.array(ids, np.int64)
    # stretches skip the chunks that go alone, so ids are put in order of chunks
    order = np.concatenate([*(x for x in stretches if not alone[x[0]]), single]) if len(chunks) else single
    flat = np.concatenate([np.empty(0, np.int64), *(found[x[0]] for x in stretches if not alone[x[0]]), *(found[k] for k in single)])
    held = np.cumsum(counts[order]) - counts[order]
    starts = np.empty(len(chunks), np.int64)
    starts[order] = held
    flat = taken(flat, starts, counts)
    begins = np.cumsum(sizes) - sizes
    fine = _sums(tokens.sizes[flat], counts) == sizes
    kept = flat[np.repeat(fine, counts)]
    other = taken(tokens.flat, tokens.starts[kept], tokens.sizes[kept]) != taken(raw, begins[fine], sizes[fine])
    fine[fine] = _sums(other, sizes[fine]) == 0
    return flat, counts, fine


def aligned(chunks: list[str], a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Of each chunk: whether both tokenizers give its bytes back; numbers of tokens of A and B, groups and links; its groups as text; linked ids.

    Chunks begin with white space that neither tokenizer joins to what is before, so their tokens are those that they have within a
    text, and both end where a chunk ends: all chunks are cut end to end at once. Linked ids of chunk after chunk have A's in the upper
    32 bits. A chunk that isn't given back has none of all this.
    """
    whole, a, b = _loaded(a_path, b_path)
    raw, _, sizes = _end_to_end([c.encode() for c in chunks])
    a_ids, n_a, a_fine = _within(chunks, lambda x: [y.ids for y in whole.encode_batch_fast(x, add_special_tokens=False)], a, raw, sizes)
    b_ids, n_b, b_fine = _within(chunks, lambda x: segmented(x, b_path), b, raw, sizes)
    fine = a_fine & b_fine
    a_ids, b_ids = a_ids[np.repeat(fine, n_a)], b_ids[np.repeat(fine, n_b)]
    n_a, n_b = np.where(fine, n_a, 0), np.where(fine, n_b, 0)
    a_ends, b_ends = np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids])
    a_cut, b_cut = groups(a_ends.tolist(), b_ends.tolist())
    n_groups = np.diff(np.searchsorted(a_cut, np.concatenate([[0], np.cumsum(n_a)]), "right"))
    i, j = links(a_ends, b_ends)
    n_links = np.diff(np.searchsorted(i, np.concatenate([[0], np.cumsum(n_a)])))
    # groups as text: the tokens of A and B of a group, then those of the next one
    a_rank = np.arange(len(a_ids)) + np.concatenate([[0], b_cut])[np.searchsorted(a_cut, np.arange(len(a_ids)), "right")]
    b_rank = np.arange(len(b_ids)) + a_cut[np.searchsorted(b_cut, np.arange(len(b_ids)), "right")]
    n = len(a_ids) + len(b_ids)
    where, length, last = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.uint8)
    where[a_rank], where[b_rank] = a.names[1][a_ids], len(a.names[0]) + b.names[1][b_ids]
    length[a_rank], length[b_rank] = a.names[2][a_ids], b.names[2][b_ids]
    last[a_rank[a_cut - 1]], last[b_rank[b_cut - 1]] = ord("|"), ord(";")
    text, ends = taken(np.concatenate([a.names[0], b.names[0]]), where, length), np.cumsum(length)
    text[ends[last > 0] - 1] = last[last > 0]
    text, ends = text.tobytes(), np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
    shown = [text[x:y] for x, y in zip(ends, ends[1:])]
    return fine, np.stack([n_a, n_b, n_groups, n_links], axis=1), shown, a_ids[i] << 32 | b_ids[j]


def _sums(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each of the successive stretches of `counts` entries."""
    ends = np.cumsum(counts)
    total = np.concatenate([[0], np.cumsum(x)])
    return total[ends] - total[ends - counts]


def _coder(a_path: str, b_path: str, form: str, most: int):
    """Batches of documents with their numbers, groups, and linked ids as places among the batch's distinct pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, texts in text_batches(batches, most):
            counts, at, distinct = split_chunks(texts)
            fine, numbers, names, flat = aligned(distinct.to_pylist(), a_path, b_path)
            whole = _sums(~fine[at], counts) == 0
            at, counts = at[np.repeat(whole, counts)], np.where(whole, counts, 0)
            ends, places = np.cumsum(counts).tolist(), at.tolist()
            texts = (b"".join([names[k] for k in places[e - n : e]])[:-1] for e, n in zip(ends, counts.tolist()))
            shown = [x.decode() for x in texts] if form == "text" else [hashlib.sha256(x).hexdigest() if x else "" for x in texts]
            # each document's distinct pairs and how often it has them
            pairs, own = np.unique(flat, return_inverse=True)
            n_pairs = numbers[:, 3]
            starts = np.cumsum(n_pairs) - n_pairs
            n_links = _sums(n_pairs[at], counts)
            key = np.repeat(np.arange(len(counts)), n_links) * max(1, len(pairs)) + taken(own, starts[at], n_pairs[at])
            key, times = np.unique(key, return_counts=True)
            doc, code = np.divmod(key, max(1, len(pairs)))
            held = np.bincount(code, minlength=len(pairs))
            kept = np.flatnonzero(held)  # pairs of texts that have no tokens after all go
            new = np.cumsum(held > 0) - 1
            lists = [ids, *(pa.array(_sums(x[at], counts), pa.int64()) for x in numbers.T), pa.array(shown, pa.string()), pa.array(pairs[kept], pa.int64()), pa.array(held[kept], pa.int64())]
            blobs = [squeezed(np.bincount(doc, minlength=len(counts))), squeezed(new[code]), squeezed(times)]
            columns = [pa.array([number], pa.int64()), *(pa.ListArray.from_arrays([0, len(x)], x) for x in lists), *(pa.array([x], pa.binary()) for x in blobs)]
            yield pa.RecordBatch.from_arrays(columns, ["batch", "docs", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "pair_docs", "sizes", "places", "times"])

    return run


_CODED = "batch long, docs array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, pairs array<long>, pair_docs array<long>, sizes binary, places binary, times binary"


def _counted(own: dict, found: dict) -> Iterator[pa.RecordBatch]:
    """A batch's documents with the corpus-wide counts of their links."""
    sizes, at, times = (opened(own[c].as_py()) for c in ("sizes", "places", "times"))
    n, best = found["n"].to_numpy(zero_copy_only=False)[at], found["best"].to_numpy(zero_copy_only=False)[at]
    lists = [own[c].values for c in ("docs", "n_a", "n_b", "n_groups", "n_links")]
    yield pa.RecordBatch.from_arrays([*lists, pa.array(_sums(times * best, sizes), pa.int64()), pa.array(_sums(times * n, sizes), pa.int64()), own["groups"].values], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])


def pair_counts(coded: DataFrame) -> DataFrame:
    """pair, n, best: how many documents hold each linked pair of ids, and is no pair of its A id held by more?

    Batches bring a count each, so what is shuffled are their distinct pairs. An A id has at most as many pairs as B has pieces.
    """
    each = coded.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.pair_docs").alias("n"))
    return each.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(F.shiftrightunsigned("pair", 32)))).select("pair", "n", "best")


def align(docs: DataFrame, a_path: str, b_path: str, form: str = "text", batch: int = BATCH) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups of every whole text under two tokenizers.

    A (byte-level) encodes a space and the text, B (SentencePiece) the text; strings of special tokens are plain text. Byte offsets at
    which tokens of both end cut them into groups; tokens of A and B are linked where their bytes overlap. n_best are the links whose
    pair is held by as many documents as any pair of its A id, count_sum is the sum over links of the documents that hold their pair.
    groups: `a1,a2|b1;a3|b2` as text, or (form "sha256") its SHA-256, '' without tokens.

    Each distinct chunk of white space and what follows is aligned once a batch, as both tokenizers begin anew there.
    Documents are written in batches as places of pairs among the batch's distinct ones; these are counted, meet the counts by
    equality and come back to their batch. A pair that every batch has is one row a batch, which Spark splits if it is too many.
    A null or empty text, and one that either tokenizer's bytes don't give back, has zeros. Rows count as documents of their own, so
    repeated ones and those of null doc_id do too. An empty table gives an empty one. Other columns don't matter.
    """
    coded = stored(documents(docs).mapInArrow(_coder(a_path, b_path, form, batch), _CODED))
    counts = stored(pair_counts(coded))
    entries = coded.select("batch", F.posexplode("pairs").alias("code", "pair")).join(counts, "pair").select("batch", "code", "n", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return rejoined(coded.drop("pairs", "pair_docs"), entries, _counted, schema)


def default_tokenizers() -> tuple[str, str]:
    """The vocabulary files that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_token_alignment(spark: SparkSession, sf_dir: str, paths: tuple[str, str] | None = None) -> DataFrame:
    """All `documents` aligned, with digests of their groups."""
    return align(read(spark, sf_dir, "documents"), *(paths or default_tokenizers()), form="sha256").withColumnRenamed("groups", "groups_sha256")
