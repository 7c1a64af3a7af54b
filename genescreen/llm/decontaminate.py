"""Benchmark decontamination by winnowed k-gram fingerprints, extended to maximal shared spans."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.common import ALNUM, documents, map_docs, read, stored, task_cache

#: Bits of the filter over benchmark fingerprints, 2 MB however large the benchmark is.
FILTER_BITS = 1 << 24
#: Word hashes that a task has met.
_KNOWN: dict[bytes, int] = task_cache()
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, ASCII letters and non-ASCII characters."""
    return (text or b"").translate(ALNUM).split()


def word_hashes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """64-bit hash of every word; `known` caches them."""
    out = list(map(known.get, words))
    if None in out:
        digest = xxhash.xxh3_64_intdigest
        for k, x in enumerate(out):
            if x is None:
                w = words[k]
                out[k] = known.get(w)
                if out[k] is None:
                    if len(known) >= 300_000:
                        known.clear()
                    out[k] = known[w] = digest(w)
    return np.array(out, np.uint64)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Mixed hash of the k words from each place on."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        out = out * _MULTIPLIER + words[j : len(words) - k + 1 + j]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash (the last of equals) of each window of consecutive k-grams."""
    if len(grams) < window:
        return np.empty(0, np.int64)
    last = window - 1 - np.argmin(sliding_window_view(grams, window)[:, ::-1], axis=1)
    return np.unique(last + np.arange(len(last)))


def prints(words: list[bytes], span: int, k: int, short: list[int], whole: bool = True) -> np.ndarray:
    """Rows fingerprint, place, words it covers: winnowed k-grams (if `whole`), then every gram of the short items' lengths."""
    hashes = word_hashes(words, _KNOWN) if words else np.empty(0, np.uint64)
    found = []
    if whole:
        grams = gram_hashes(hashes, k)
        at = winnow(grams, span - k + 1)
        found.append(np.stack([grams[at].view(np.int64), at, np.zeros(len(at), np.int64)]))
    for n in short:
        g = gram_hashes(hashes, n) ^ np.uint64(n)
        found.append(np.stack([g.view(np.int64), np.arange(len(g)), np.full(len(g), n)]))
    return np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)


def context(words: list[bytes], at: int, n: int, span: int, k: int) -> tuple[bytes, bytes, bytes]:
    """Words left of a fingerprint (nearest first), its own and those to its right, as far as a span that holds it can reach.

    n: 0 for a winnowed k-gram, else the length of a short item, which has no neighbours.
    """
    if n:
        return b"", b" ".join(words[at : at + n]), b""
    reach = span - k
    return b" ".join(words[max(0, at - reach) : at][::-1]), b" ".join(words[at : at + k]), b" ".join(words[at + k : at + k + reach])


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def item_prints(benchmark: DataFrame, span: int, k: int) -> tuple[DataFrame, list[int]]:
    """Fingerprints of all items with their contexts, one row each with the items that have it; and the lengths under a span that items have."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    count = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), ""))
    short = sorted(r.n for r in items.select(count.alias("n")).where(F.col("n").between(1, span - 1)).distinct().collect())

    def make(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = words_of(text)
                small = 0 < len(words) < span
                for fp, at, n in prints(words, span, k, [len(words)] if small else [], not small).T.tolist():
                    rows.append((fp, n, *context(words, at, n, span, k), item))
            yield _rows(rows, ["fp", "n", "left", "own", "right", "item_id"], [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.string()])

    rows = items.mapInArrow(make, "fp long, n int, left binary, own binary, right binary, item_id string")
    return stored(rows.groupBy("fp", "n", "left", "own", "right").agg(F.collect_set("item_id").alias("items"))), short


def id_filter(index: DataFrame) -> np.ndarray:
    """Bit map over the column fp (long): FILTER_BITS bits, so its size doesn't grow with the table."""
    place = (F.pmod(F.col("fp"), F.lit(FILTER_BITS)) + 1).alias("p")
    pieces = index.select(place).groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
    out = np.zeros((FILTER_BITS >> 15, 1 << 12), np.uint8)
    for r in pieces.collect():
        out[r.bucket - 1] = np.frombuffer(bytes(r.bits), np.uint8)
    return out.reshape(-1)


def in_filter(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values (64-bit integers) the bit map may hold."""
    p = values & (FILTER_BITS - 1)
    return (table[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1


def _common(a: bytes, b: bytes) -> int:
    """Words that two blank-joined lists begin with in common."""
    n = 0
    for x, y in zip(a.split(), b.split()):
        if x != y:
            break
        n += 1
    return n


def hits(docs: DataFrame, benchmark: DataFrame, span: int = 13, k: int = 9) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, items: words of each document inside shared spans, and the sorted ids of the items with such a span.

    A span is `span` consecutive words that an item and the document share, or a whole item of fewer words. Both sides keep the
    smallest k-gram hash of each span - k + 1 consecutive k-grams, so every shared span has a fingerprint in both, at the same place
    in it. Document fingerprints pass a bit map of fixed size over the benchmark's, meet the benchmark's in an equality join with
    their neighbouring words, and are extended word by word. A document sends a fingerprint with one context once, with all its places.
    Only Spark's own size threshold decides whether the benchmark side is broadcast. Null has no words. A document is a doc_id with
    one text: repeated rows each get the same result, and null is a doc_id. An item of null item_id hits as any other and is not
    listed; items that repeat an item_id are listed once. Empty tables give no hits.
    """
    docs = documents(docs)
    index, short = item_prints(benchmark, span, k)
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(index))

    def make(ids, texts):
        table = bits.value
        rows: list[tuple] = []
        for i, text in zip(ids.tolist(), texts):
            words = words_of(text)
            h = xxhash.xxh3_64_intdigest(text or b"") - (1 << 63)
            rows.append((i, h, len(words), None, None, None, None, None, None))
            if not words:
                continue
            found: dict[tuple, list[int]] = {}
            all_prints = prints(words, span, k, short)
            passed = in_filter(table, all_prints[0])
            for f, at, n in all_prints[:, passed].T.tolist():
                found.setdefault((f, n, *context(words, at, n, span, k)), []).append(at)
            rows.extend((i, h, None, *key, places) for key, places in found.items())
        return dict(zip(("doc_id", "text_hash", "n_words", "fp", "n", "left", "own", "right", "places"), zip(*rows))) if rows else None

    held = stored(map_docs(docs, make, "doc_id long, text_hash long, n_words long, fp long, n int, left binary, own binary, right binary, places array<int>"))
    met = held.where("fp is not null").withColumnsRenamed({"left": "doc_left", "right": "doc_right"}).drop("n_words").join(index, ["fp", "n", "own"])

    def extend(batches):
        for batch in batches:
            columns = batch.to_pydict()
            rows = []
            for i, h, n, dl, dr, il, ir, places, items in zip(*(columns[c] for c in ("doc_id", "text_hash", "n", "doc_left", "doc_right", "left", "right", "places", "items"))):
                left, right = (0, 0) if n else (_common(dl, il), _common(dr, ir))
                size = n or left + k + right
                if n or size >= span:
                    rows.append((i, h, [p - left for p in places], [size] * len(places), items))
            yield _rows(rows, ["doc_id", "text_hash", "starts", "sizes", "items"], [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())])

    spans = met.select("doc_id", "text_hash", "n", "doc_left", "doc_right", "left", "right", "places", "items").mapInArrow(extend, "doc_id long, text_hash long, starts array<int>, sizes array<int>, items array<string>")
    spans = spans.distinct().groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("sizes")).alias("sizes"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def union(batches):
        for batch in batches:
            columns = batch.to_pydict()
            rows = []
            for i, h, starts, sizes, items in zip(*(columns[c] for c in ("doc_id", "text_hash", "starts", "sizes", "items"))):
                start = np.array(starts)
                order = np.argsort(start, kind="stable")
                start, end = start[order], (start + np.array(sizes))[order]
                before = np.maximum.accumulate(np.concatenate([[0], end[:-1]]))
                rows.append((i, h, int(np.maximum(0, end - np.maximum(start, before)).sum()), items))
            yield _rows(rows, ["doc_id", "text_hash", "n_hit", "items"], [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())])

    totals = spans.mapInArrow(union, "doc_id long, text_hash long, n_hit long, items array<string>")
    base = held.where("fp is null").select("doc_id", "text_hash", "n_words")
    empty = F.array().cast("array<string>")
    totals = totals.withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash"})
    return base.join(totals, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left").select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", empty).alias("items"))


def contaminated() -> F.Column:
    """At least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    found = hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


OP5_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, s, array_to_string(w[s : s + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM doc_words, sizes WHERE len(w) >= size)),
found AS (SELECT d.doc_id, d.size, d.s, i.item_id FROM doc_windows d JOIN item_windows i ON d.size = i.size AND d.words = i.words),
places AS (SELECT count(DISTINCT p) AS n_hit, doc_id FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
  sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN places p USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
