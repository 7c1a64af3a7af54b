"""Cross-entropy difference of documents between matched n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.common import ALNUM, complete_groups, documents, packed, read, split_words, stored, text_pieces, translated, unpacked

#: Bytes of text whose n-grams are asked for together.
BATCH = 1 << 21
#: Bytes of text whose n-grams a part of the table of counts holds at most on average; a part is held in memory.
PART = 1 << 25
#: Weight of the unigram model within the bigram model, in tokens, and count that every word has in the unigram model beforehand.
MIX, ADD = 20.0, 0.1
#: Hash of the mark before a document's first word.
START = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def part_bits(n_parts: int) -> np.uint64:
    """Bits of a gram's hash that its part is taken from; the others stand beside it in the code."""
    return np.uint64(max(16, (n_parts - 1).bit_length()))


def low_bits(n_parts: int) -> np.uint64:
    """Mask of the bits of a code beside the part."""
    return (np.uint64(1) << (np.uint64(64) - part_bits(n_parts))) - np.uint64(1)


class Grams:
    """The distinct words and word pairs of a batch of documents, in the order in which they are asked for.

    A gram's code is its part and the bits of a hash that the part isn't taken from (48 up to 65,536 parts), the lowest of which tells
    pairs from words; the mark before a document is a word.
    """

    def __init__(self, words: np.ndarray, at: np.ndarray, sizes: np.ndarray, n_parts: int) -> None:
        self.at, self.sizes, n = at, sizes, len(words) + 1
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.before = np.concatenate([[0], at[:-1]]).astype(np.int64)[: len(at)]
        self.before[(np.cumsum(sizes) - sizes)[sizes > 0]] = len(words)
        pairs, self.pair = np.unique(self.before * n + at, return_inverse=True)
        known = np.append(words, START)
        keys = _mixed(np.concatenate([known, known[pairs // n] * np.uint64(0xD6E8FEB86659FD93) + known[pairs % n]]))
        tag = np.repeat(np.array([0, 1], np.uint64), [n, len(pairs)])
        bits = part_bits(n_parts)
        part = ((keys >> (np.uint64(64) - bits)) * np.uint64(n_parts)) >> bits
        code = (part << (np.uint64(64) - bits)) | (keys & low_bits(n_parts) & ~np.uint64(1)) | tag
        self.order = np.argsort(code)
        self.code, self.n_words = code[self.order], n

    def counts(self, of: np.ndarray) -> np.ndarray:
        """How often each gram stands in the documents that `of` marks, in order."""
        token = of[self.doc]
        words = np.append(np.bincount(self.at[token], minlength=self.n_words - 1), np.count_nonzero(self.sizes[of]))
        return np.concatenate([words, np.bincount(self.pair[token], minlength=len(self.order) - self.n_words)])[self.order]


def batches(docs: DataFrame) -> DataFrame:
    """batch, doc_ids, sizes (tokens of each document), words (64-bit hashes of distinct words), at (word of each token): documents as numbers."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, pa.Array]] = []
        number = TaskContext.get().partitionId() << 32

        def out() -> pa.RecordBatch:
            ids, texts = (pa.concat_arrays(x) for x in zip(*held))
            sizes, at, words = split_words(translated(texts, ALNUM))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.cast(pa.binary()).to_pylist()), np.uint64, len(words))
            row = [[number], [ids.to_pylist()], [packed(sizes)], [hashes.tobytes()], [packed(at)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()))], ["batch", "doc_ids", "sizes", "words", "at"])

        for part, texts in text_pieces(parts, BATCH):
            held.append((part.column("doc_id"), texts))
            if sum(t.nbytes for _, t in held) >= BATCH:
                yield out()
                held, number = [], number + 1
        if held:
            yield out()

    return stored(documents(docs).mapInArrow(run, "batch long, doc_ids array<long>, sizes binary, words binary, at binary"))


def _read(batch: pa.RecordBatch, n_parts: int) -> Iterator[tuple[int, list, np.ndarray, Grams]]:
    """Per row its place, doc ids, which of its documents are of the target, and its grams."""
    for k in range(batch.num_rows):
        ids = batch.column("doc_ids")[k].as_py()
        target = np.zeros(len(ids), bool)
        if batch.column("hits")[k].is_valid:
            target[batch.column("hits")[k].as_py()] = True
        sizes = unpacked(batch.column("sizes")[k].as_py()).astype(np.int64)
        yield k, ids, target, Grams(np.frombuffer(batch.column("words")[k].as_py(), "<u8"), unpacked(batch.column("at")[k].as_py()).astype(np.int32), sizes, n_parts)


def _sums(marked: DataFrame, n_parts: int) -> DataFrame:
    """batch, part, target, whole: for each gram that a batch has, its counts over all batches; and a row (null batch) of each part's own sums.

    Each batch asks once for each of its distinct grams, so a word pair that stands everywhere is one entry a batch. What a batch
    asks of a part is one row of packed numbers, and so is the answer.
    """

    shift, low = np.uint64(64) - part_bits(n_parts), low_bits(n_parts)

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for k, ids, target, grams in _read(batch, n_parts):
                number, sums = batch.column("batch")[k].as_py(), [grams.counts(x) for x in (target, np.ones(len(ids), bool))]
                part = (grams.code >> shift).astype(np.int64)
                starts = np.flatnonzero(np.diff(part, prepend=-1))
                out = [(int(part[a]), number, packed(np.diff(grams.code[a:b] & low, prepend=np.uint64(0))), *(packed(x[a:b]) for x in sums)) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)])]
                columns = list(zip(*out)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["part", "batch", "codes", "target", "whole"])

    start = int(_mixed(np.array([START]))[0] & low & ~np.uint64(1))

    def answer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        names = ["batch", "part", "target", "whole", "n_words", "n_target", "n_whole"]
        for group in complete_groups(rows, ["part"]):
            codes = [np.cumsum(unpacked(x)) for x in group["codes"].to_pylist()]
            distinct, place = np.unique(np.concatenate(codes), return_inverse=True)
            sums = [np.bincount(place, np.concatenate([unpacked(x) for x in group[c].to_pylist()]), len(distinct)).astype("<u8") for c in ("target", "whole")]
            word = (distinct & np.uint64(1) == 0) & (distinct != start)
            part, at = group["part"][0].as_py(), 0
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((None, part, None, None, int(word.sum()), *(int(s[word].sum()) for s in sums)), types)], names)
            for number, own in zip(group["batch"].to_pylist(), map(len, codes)):
                mine = place[at : at + own]
                at += own
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((number, part, *(packed(s[mine]) for s in sums), None, None, None), types)], names)

    asked = marked.mapInArrow(ask, "part int, batch long, codes binary, target binary, whole binary").repartition("part").sortWithinPartitions("part")
    return stored(asked.mapInArrow(answer, "batch long, part int, target binary, whole binary, n_words long, n_target long, n_whole long"))


def _losses(pair: np.ndarray, context: np.ndarray, word: np.ndarray, tokens: np.ndarray, n_words: int, scale: float) -> np.ndarray:
    """Negative log-probability of tokens from the counts of their pairs, of the words before them, of themselves and of all tokens."""
    alone = (scale * word + ADD) / (scale * tokens + ADD * n_words)
    return -np.log((scale * pair + MIX * alone) / (scale * context + MIX))


def score(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score: mean losses per token and target minus background (lower: more like the target).

    The target model is a bigram model of the documents in `target_ids` (doc_id), the background model one of all documents. Both are
    matched: one vocabulary, which is every word of the corpus, so no word is unknown to either; one smoothing; and one amount of
    evidence, the background's counts being scaled to as many tokens as the target has. A document is scored by models of the others:
    its own counts are taken off, from the target's too if it is one of its documents.

    Counts are a table by gram in parts, which grows with the corpus; texts are read once and not shuffled, and no count passes the
    driver but the numbers of words and tokens. A part holds the n-grams of about PART bytes of text, so there are as many parts as the
    corpus needs. Grams are told apart by 48 bits of a hash beside their part's number, or by 63 bits with it beyond 65,536 parts.

    A text without tokens (null, empty) has losses and score 0. Repeated rows and rows of null doc_id are documents of their own, the
    latter never of the target. Without documents in the target all scores are 0. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    held = batches(docs)
    n_parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), held.count() * BATCH // PART)
    wanted = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    hits = held.select("batch", F.posexplode("doc_ids").alias("place", "doc_id")).join(wanted, "doc_id").groupBy("batch").agg(F.collect_list("place").alias("hits"))
    marked = held.join(stored(hits), "batch", "left")
    sums = _sums(marked, n_parts)
    whole = sums.where("batch is null").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", "n_target", "n_whole")]).first()
    n_words, tokens = whole.n_words, (whole.n_target, whole.n_whole)
    scale = tokens[0] / max(1, tokens[1])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for k, ids, target, grams in _read(batch, n_parts):
                found = sorted(batch.column("sums")[k].as_py(), key=lambda x: x["part"])
                n, doc, losses = grams.n_words, grams.doc, []
                own_pair, own_word = (np.unique(doc * (int(x.max(initial=0)) + 1) + x, return_inverse=True, return_counts=True)[1:] for x in (grams.pair, grams.at.astype(np.int64)))
                own_pair, own_word = own_pair[1][own_pair[0]], own_word[1][own_word[0]]
                first = grams.before == n - 1
                own_context = np.where(first, 1, np.concatenate([[0], own_word[:-1]])[: len(first)])
                for side, of, by in (("target", target, 1.0), ("whole", np.ones(len(ids), bool), scale)):
                    counts = np.empty(len(grams.order))
                    counts[grams.order] = np.concatenate([unpacked(x[side]) for x in found]) if found else 0
                    mine = of[doc]
                    loss = _losses(counts[n:][grams.pair] - mine * own_pair, counts[grams.before] - mine * own_context, counts[grams.at] - mine * own_word, tokens[side == "whole"] - (of * grams.sizes)[doc], n_words, by)
                    losses.append(np.bincount(doc, loss, len(ids)) / np.maximum(1, grams.sizes))
                t, b = losses if tokens[0] else (losses[1], losses[1])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(grams.sizes), pa.array(t), pa.array(b), pa.array(t - b)], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    answers = sums.where("batch is not null").groupBy("batch").agg(F.collect_list(F.struct("part", "target", "whole")).alias("sums"))
    return marked.join(answers, "batch", "left").mapInArrow(run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document between documents of quality 1 and all documents."""
    good = read(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return score(read(spark, sf_dir, "documents"), good)
