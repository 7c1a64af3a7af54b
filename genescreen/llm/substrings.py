"""Removal of repeated passages: fixed-block anchors, probed by every rolling window and extended to maximal repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.common import complete_groups, documents, planes, read, stored, unplaned
from genescreen.llm.decontaminate import _KNOWN, gram_hashes, word_hashes

#: Places of one anchor in one batch from which on they are taken as repeated without asking other batches.
MANY = 64
#: Words of text that are compared with each other before they are sent.
BATCH = 1_500_000
#: Bytes of text whose probes or windows a part holds at most on average; a part is held in memory.
PART = 1 << 24
_COLUMNS = "part int, sent boolean, code binary, check binary, doc binary, alt binary, n binary, at binary"
_NAMES = ["part", "sent", "code", "check", "doc", "alt", "n", "at"]
_TYPES = [pa.int32(), pa.bool_(), *[pa.binary()] * 6]


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of characters other than ASCII white space, unchanged."""
    return (text or b"").split()


def _packed(part: np.ndarray, code: np.ndarray, check: np.ndarray, doc: np.ndarray, alt: np.ndarray, at: np.ndarray, sent: bool) -> Iterator[list]:
    """One row for each part: codes, and places as documents with counts and steps; rows come ordered by document and place."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    part, code, check, doc, alt, at = part[order], code[order], check[order], doc[order], alt[order], at[order]
    new_part = np.concatenate([[True], part[1:] != part[:-1]])
    new_run = new_part | np.concatenate([[True], (doc[1:] != doc[:-1]) | (alt[1:] != alt[:-1])])
    step = at.copy()
    step[1:] = np.where(new_run[1:], at[1:], at[1:] - at[:-1])
    starts = np.flatnonzero(new_part)
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
        runs = np.flatnonzero(new_run[s:e])
        docs = doc[s:e][runs]
        yield [int(part[s]), sent, code[s:e].tobytes(), check[s:e].tobytes(), planes(np.diff(docs, prepend=np.int64(0))), planes(alt[s:e][runs]), planes(np.diff(np.append(runs, e - s)).astype("<u4")), planes(step[s:e].astype("<u4"))]


def _unpacked(group: dict, sent: bool, code: str, check: str) -> tuple[np.ndarray, ...]:
    """code, check, doc, alt and place of all entries of a part's rows."""
    keep = group["sent"].to_numpy(zero_copy_only=False) == sent
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    for k in np.flatnonzero(keep).tolist():
        docs = np.cumsum(unplaned(group["doc"][k].as_py(), "<i8"))
        n = unplaned(group["n"][k].as_py(), "<u4").astype(np.int64)
        steps = unplaned(group["at"][k].as_py(), "<u4").astype(np.int64)
        sums = np.cumsum(steps)
        first = np.cumsum(n) - n
        base = sums[first] - steps[first]
        out[0].append(np.frombuffer(group["code"][k].as_py(), code) if sent else np.empty(0, code))
        out[1].append(np.frombuffer(group["check"][k].as_py(), check) if sent else np.empty(0, check))
        out[2].append(np.repeat(docs, n))
        out[3].append(np.repeat(unplaned(group["alt"][k].as_py(), "<i8"), n))
        out[4].append(sums - np.repeat(base, n))
    if not out[2]:
        return np.empty(0, code), np.empty(0, check), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in out)


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_TYPES)], _NAMES)


def _places(doc: np.ndarray, alt: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(doc), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(doc[k : k + 100_000], pa.int64()), pa.array(alt[k : k + 100_000], pa.int64()), pa.array(at[k : k + 100_000].astype(np.int32), pa.int32())], ["doc_id", "alt", "at"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes, np.ndarray | None]]]:
    """Documents (doc_id, alt, text, places) in ascending order, each once, about BATCH words at a time; those that copy an earlier one are left out."""
    held: dict[tuple[int, int], tuple] = {}
    size = 0
    for batch in batches:
        with_places = "places" in batch.schema.names
        places = batch.column("places") if with_places else [None] * batch.num_rows
        for i, alt, text, first, at in zip(batch.column("doc_id").to_pylist(), batch.column("alt").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("first_doc").to_pylist(), places):
            if i is None or text is None or first is not None or (with_places and not at.is_valid) or (i, alt) in held:
                continue
            held[i, alt] = (i, alt, text, np.array(at.values) if with_places else None)
            size += len(text) // 6
            if size >= BATCH:
                yield [held[k] for k in sorted(held)]
                held, size = {}, 0
    if held:
        yield [held[k] for k in sorted(held)]


def _anchors(n_parts: int, block: int):
    """Every rolling block-gram of the documents, as codes for its part; what a batch alone shows to be repeated comes as places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _gathered(batches):
            grams = [gram_hashes(word_hashes(words, _KNOWN), block) if len(words := words_of(text)) >= block else np.empty(0, np.uint64) for _, _, text, _ in docs]
            sizes = np.array([len(g) for g in grams])
            h = np.concatenate(grams)
            if not len(h):
                continue
            doc, alt = (np.repeat(np.array([d[k] for d in docs], np.int64), sizes) for k in (0, 1))
            at = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            order = np.argsort(h, kind="stable")
            new = np.concatenate([[True], h[order][1:] != h[order][:-1]])
            starts = np.flatnonzero(new)
            n = np.diff(np.append(starts, len(h)))
            anchored = np.maximum.reduceat((at[order] % block == 0), starts)
            known = (n > 1) & (anchored | (n > MANY))
            repeated = np.repeat(known, n)
            # of what is known to be repeated here one place goes to the others, an anchor if there is one
            rank = np.where(at[order] % block == 0, 0, 1)
            first = np.zeros(len(h), bool)
            best = np.minimum.reduceat(rank * len(h) + np.arange(len(h)), starts) % len(h)
            first[best[known]] = True
            mine = np.zeros(len(h), bool)
            mine[order[repeated]] = True
            sent = ~mine
            sent[order[first]] = True
            part = ((h >> np.uint64(34)) % np.uint64(n_parts)).astype(np.uint32)
            none = np.zeros(len(h), np.uint8)
            rows = [[p, s, c, b"", *rest] for p, s, c, _, *rest in _packed(part[sent], (h[sent] & np.uint64(0xFFFFFFFF)).astype("<u4"), none[sent], doc[sent], alt[sent], at[sent], True)]
            if mine.any():
                # places need no code; they travel to the part that their document falls to
                part = ((doc[mine].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(34)) % np.uint64(n_parts)).astype(np.uint32)
                rows += [[p, s, b"", b"", *rest] for p, s, _, _, *rest in _packed(part, none[mine], none[mine], doc[mine], alt[mine], at[mine], False)]
            yield _batch(rows)

    return run


def _matched(block: int):
    """Places whose code is an indexed block's and stands at two places or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in complete_groups(batches, ["part"]):
            yield from _places(*_unpacked(group, False, "u1", "u1")[2:])
            code, _, doc, alt, at = _unpacked(group, True, "<u4", "u1")
            if len(code):
                order = np.argsort(code, kind="stable")
                starts = np.flatnonzero(np.concatenate([[True], code[order][1:] != code[order][:-1]]))
                n = np.diff(np.append(starts, len(code)))
                found = np.repeat((n > 1) & np.maximum.reduceat(at[order] % block == 0, starts), n)
                yield from _places(doc[order[found]], alt[order[found]], at[order[found]])

    return run


def _extended(n_parts: int, block: int, window: int):
    """The windows around matched places, by hash; of equal ones in a batch all but the first come as places to remove."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _gathered(batches):
            found: list[tuple[np.ndarray, ...]] = []
            for i, other, text, places in docs:
                hashes = word_hashes(words_of(text), _KNOWN)
                last = len(hashes) - window
                if last < 0:
                    continue
                edges = np.zeros(last + 2, np.int64)
                np.add.at(edges, np.clip(places - (window - block), 0, last + 1), 1)
                np.add.at(edges, np.minimum(places, last) + 1, -1)
                at = np.flatnonzero(np.cumsum(edges)[:-1] > 0)
                mixed = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                found.append((gram_hashes(hashes, window)[at], gram_hashes(mixed, window)[at], np.full(len(at), i, np.int64), np.full(len(at), other, np.int64), at))
            if not found:
                continue
            h, check, doc, alt, at = (np.concatenate(x) for x in zip(*found))
            if not len(h):
                continue
            order = np.argsort(h, kind="stable")
            s = order[1:]
            f = order[:-1]
            later = np.zeros(len(h), bool)
            later[s] = (h[s] == h[f]) & (check[s] == check[f])
            rest = ~later
            part = ((h >> np.uint64(34)) % np.uint64(n_parts)).astype(np.uint32)
            rows = list(_packed(part[rest], h[rest], check[rest].astype("<u4"), doc[rest], alt[rest], at[rest], True))
            if later.any():
                part = ((doc[later].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(34)) % np.uint64(n_parts)).astype(np.uint32)
                none = np.zeros(int(later.sum()), np.uint8)
                rows += [[p, sent, b"", b"", *others] for p, sent, _, _, *others in _packed(part, none, none, doc[later], alt[later], at[later], False)]
            yield _batch(rows)

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the windows that an earlier place has too."""
    for group in complete_groups(batches, ["part"]):
        yield from _places(*_unpacked(group, False, "u1", "u1")[2:])
        code, check, doc, alt, at = _unpacked(group, True, "<u8", "<u4")
        if len(code):
            order = np.lexsort((at, alt, doc, check, code))
            code, check, doc, alt, at = code[order], check[order], doc[order], alt[order], at[order]
            start = np.concatenate([[True], (code[1:] != code[:-1]) | (check[1:] != check[:-1])])
            first = np.maximum.accumulate(np.where(start, np.arange(len(code)), 0))
            later = (doc != doc[first]) | (alt != alt[first]) | (at != at[first])
            yield from _places(doc[later], alt[later], at[later])


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept: texts without the words of windows that stand earlier too (smaller doc_id, or same document and earlier start).

    Blocks of window // 2 words at multiples of that are the index: any window holds a whole one, wherever it starts. Every rolling
    window of a block's length probes it. Codes of blocks and probes (32 bits beside their part's) meet packed by part of the hash, so
    a probe costs about five bytes; what shares a code with a block is a hit. Hits are extended in their texts to all windows that hold
    them, and those are matched by 96 bits beside their part's; all but the first place of each are removed, which together are the
    maximal repeats. A batch sends what it sees to be repeated once, however often, so a passage that most documents share, and a
    third of all rows being copies, put no weight on one task; whole copies of an earlier text are settled beforehand by its digest.
    The texts are shuffled once, by doc_id, for all passes.

    Null and empty texts have no words. A document is a doc_id with one text: rows that repeat it each get the same result, and texts of
    one doc_id that differ are documents of their own, ordered by a hash. Rows of null doc_id keep all their words and take none from
    others. An empty table gives an empty one. There is a part for each PART bytes of text, so what a task holds doesn't grow with the corpus. Kept words are joined by one space. Windows are matched by 128 bits of hashes of their
    words, not word by word.
    """
    spark, docs, block = docs.sparkSession, documents(docs), window // 2
    known = docs.where("doc_id is not null and text is not null")
    hashes = known.select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"))
    hashes = stored(hashes.groupBy("doc_id").agg(F.min("h").alias("least"), F.max("h").alias("most"), F.sum("size").alias("size")))
    n_parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), (hashes.agg(F.sum("size")).first()[0] or 0) // PART)
    several = stored(hashes.where("least < most").select("doc_id", F.lit(True).alias("several")))
    if several.isEmpty():
        docs = docs.withColumn("alt", F.lit(0).cast("long"))
    else:
        docs = docs.join(several, "doc_id", "left").select("doc_id", "text", F.when(F.col("several"), F.xxhash64("text")).otherwise(F.lit(0).cast("long")).alias("alt"))
    keyed = docs.where("doc_id is not null and text is not null").select("doc_id", "alt", F.unhex(F.sha2("text", 256)).alias("digest"))
    # written first, so that the join shuffles both sides as they are and Spark can split a digest that very many rows have
    firsts = stored(keyed.groupBy("digest").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).where("first_doc < last_doc").drop("last_doc"))
    copies = keyed.join(firsts, "digest").where("first_doc < doc_id").groupBy("doc_id", "alt").agg(F.min("first_doc").alias("first_doc"))
    based = docs.join(copies.hint("shuffle_hash"), ["doc_id", "alt"], "left")

    def exchanged(df: DataFrame) -> DataFrame:
        return df.repartition("part").sortWithinPartitions("part")

    hits = exchanged(based.mapInArrow(_anchors(n_parts, block), _COLUMNS)).mapInArrow(_matched(block), "doc_id long, alt long, at int")
    hits = hits.groupBy("doc_id", "alt").agg(F.collect_list("at").alias("places"))
    windows = based.join(hits.hint("shuffle_hash"), ["doc_id", "alt"], "left").mapInArrow(_extended(n_parts, block, window), _COLUMNS)
    removed = exchanged(windows).mapInArrow(_repeated, "doc_id long, alt long, at int").groupBy("doc_id", "alt").agg(F.collect_list("at").alias("places"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, first, places in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("first_doc").to_pylist(), batch.column("places")):
                words = words_of(text)
                n = len(words)
                if first is not None and n >= window:
                    words = []
                elif places.is_valid:
                    at = np.array(places.values)
                    edges = np.zeros(n + window + 1, np.int64)
                    np.add.at(edges, np.minimum(at, n), 1)
                    np.add.at(edges, np.minimum(at + window, n), -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(edges)[:n] <= 0).tolist()]
                rows.append((i, n, n - len(words), b" ".join(words)))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return based.join(removed.hint("shuffle_hash"), ["doc_id", "alt"], "left").mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `documents` without repeated windows; the kept words as a digest."""
    return remove_repeats(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(w[s : s + 19], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM doc_words WHERE len(w) >= 20)),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY words ORDER BY doc_id, s) AS n FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE n > 1),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc_words),
kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(p.word, ' ' ORDER BY p.p) AS text
  FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.p = g.p GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, len(d.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM doc_words d LEFT JOIN kept k USING (doc_id)
"""
