"""Merkle trees over documents: digests up to one root by sweeps in label order, proofs down again, and tampered rows found."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genescreen.llm.common import read, stored

#: Children of a node.
FANOUT = 16
#: Levels that one sweep goes up or down; a task holds the FANOUT ** LEVELS nodes below one node at a time.
LEVELS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parent_digest(children: list[bytes]) -> bytes:
    """SHA-256 of the children's digests as hexadecimal text."""
    return hashlib.sha256("".join([x.hex() for x in children]).encode()).digest()


def up(digests: list[bytes], fanout: int, levels: int | None) -> Iterator[tuple[int, int, bytes]]:
    """(level, place, digest) of the nodes above `digests`, `levels` of them or up to a single node.

    A node's label is (level, place). A priority queue holds the messages that bring digests to the labels of their parents. The sweep
    takes labels in ascending order, so all children of a node have sent when it is reached.
    """
    queue = [((1, k // fanout), k, d) for k, d in enumerate(digests)]  # in order already, so a heap
    n, level = len(digests), 0
    while queue and (level < levels if levels else n > 1):
        level, n = level + 1, -(-n // fanout)
        for place in range(n):
            children = []
            while queue and queue[0][0] == (level, place):
                children.append(heapq.heappop(queue)[2])
            digest = parent_digest(children)
            heapq.heappush(queue, ((level + 1, place // fanout), place, digest))
            yield level, place, digest


def down(digests: list[bytes], fanout: int, levels: int | None, suffix: bytes) -> list[bytes]:
    """Of each of `digests` its proof: what stands beside it at each level, up to the top node, whose own proof is `suffix`.

    The sweep of up(), reversed: labels in descending order, each node sends its children the proof suffix that they share, which comes
    off the queue when their labels are reached. A level of a proof is the number of siblings before and after, then these.
    """
    rows = [list(digests)]
    for level, _, digest in up(digests, fanout, levels):
        if level == len(rows):
            rows.append([])
        rows[level].append(digest)
    queue, out = [(-(len(rows) - 1), 0, suffix)], []
    while queue:
        level, place, own = heapq.heappop(queue)
        level, place = -level, -place
        if level == 0:
            out.append(own)
            continue
        first = place * fanout
        run = rows[level - 1][first : first + fanout]
        for k in range(len(run) - 1, -1, -1):
            heapq.heappush(queue, (-(level - 1), -(first + k), bytes([k, len(run) - 1 - k]) + b"".join(run[:k] + run[k + 1 :]) + own))
    return out[::-1]


def proof_levels(proof: bytes) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Siblings before and after, level by level."""
    at = 0
    while at < len(proof):
        before, after = proof[at], proof[at + 1]
        found = [proof[at + 2 + 32 * k : at + 34 + 32 * k] for k in range(before + after)]
        at += 2 + 32 * len(found)
        yield found[:before], found[before:]


def fold(digest: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for before, after in proof_levels(proof):
        digest = parent_digest([*before, digest, *after])
    return digest


def siblings(proof: bytes) -> str:
    """All digests of a proof as hexadecimal text, level by level, from left to right."""
    return "".join(x.hex() for before, after in proof_levels(proof) for x in before + after)


def field(c: Column) -> Column:
    """`-` for null, else the number of bytes, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """Digest of a row of documents, with `text` for its text."""
    return F.unhex(F.sha2(F.concat(*(field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")), field(text)), 256))


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with `at`, their place within a tree by `order` (nulls first, text by bytes), and `n`, how many the tree has.

    Rows are dealt by ranges over (tree, order), so a tree of any size spreads over many tasks. Each task numbers its own rows; where
    a tree's stretch of a task begins in the whole tree is a running sum over a row a stretch.
    """
    dealt = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    own = F.monotonically_increasing_id()
    held = stored(dealt.withColumn("_part", F.shiftright(own, 33)).withColumn("_row", own.bitwiseAND((1 << 33) - 1)))
    stretch = held.groupBy(tree, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(tree)
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stretch = stored(stretch.select(F.col(tree).alias("_tree"), F.col("_part").alias("_of"), (before - F.col("_first")).alias("_before"), F.sum("_rows").over(whole).alias("n")))
    found = held.join(stretch, (F.col("_part") == F.col("_of")) & F.col(tree).eqNullSafe(F.col("_tree")))
    return found.withColumn("at", F.col("_row") + F.col("_before")).drop("_part", "_row", "_tree", "_of", "_before")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple]]:
    """Rows of one (tree, block) after the other from batches sorted by tree and place; the columns begin with tree and at."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            now = (row[0], row[1] // size)
            if now != key and held:
                yield held
                held = []
            key = now
            held.append(row)
    if held:
        yield held


def _steps(n: int, fanout: int, levels: int) -> int | None:
    """Levels that a sweep goes up in a tree of n nodes: None, up to a single node, where the tree is one block."""
    return None if n <= fanout**levels else levels


def grow(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Stored tables (tree, at, n, digest) of every `levels`-th level up to where each tree has one node.

    Nodes are dealt by (tree, block) with a block being all nodes below one node `levels` up; nothing else is held in a task.
    """
    size, out = fanout**levels, [nodes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for block in _blocks(batches, size):
            tree, at, n, _ = block[0]
            top = block[0][3]
            for _, _, digest in up([x[3] for x in block], fanout, _steps(n, fanout, levels)):
                top = digest
            rows.append((tree, at // size, -(-n // size), top))
            if len(rows) == 1000:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.binary()))], ["tree", "at", "n", "digest"])

    while not out[-1].where("n > 1").isEmpty():
        dealt = out[-1].select("tree", "at", "n", "digest").repartition("tree", F.floor(F.col("at") / size)).sortWithinPartitions("tree", "at")
        out.append(stored(dealt.mapInArrow(run, "tree string, at long, n long, digest binary")))
    return out


def descend(nodes: DataFrame, tops: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The nodes (tree, at, n, digest, ...) with `proof`, given (tree, at, proof) of the node `levels` up or of the tree's top."""
    size = fanout**levels
    names = [c for c in nodes.columns if c not in ("tree", "at", "n", "digest")]
    schema = nodes.select("tree", "at", "n", "digest", *names).withColumn("proof", F.lit(b"")).schema
    rows = nodes.select("tree", "at", "n", "digest", *names, F.lit(None).cast("binary").alias("proof"), F.lit(1).alias("kind"))
    rows = rows.unionByName(tops.select("tree", (F.col("at") * size).alias("at"), "proof", F.lit(0).alias("kind")), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for block in _blocks(batches, size):
            suffix, block = block[0][-2], block[1:]
            proofs = down([x[3] for x in block], fanout, _steps(block[0][2], fanout, levels), suffix)
            found = [(*x[:-2], p) for x, p in zip(block, proofs)]
            for k in range(0, len(found), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found[k : k + 1000]), arrow)], schema=arrow)

    return rows.repartition("tree", F.floor(F.col("at") / size)).sortWithinPartitions("tree", "at", "kind").mapInArrow(run, schema)


def proven(nodes: list[DataFrame], tops: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The lowest of grow()'s tables with proofs, given those of the trees' tops (tree, at 0, proof)."""
    for table in nodes[:0:-1][1:]:
        tops = stored(descend(table, tops, fanout, levels).select("tree", "at", "proof"))
    return descend(nodes[0], tops, fanout, levels)


def manifest(docs: DataFrame, changed: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, and with `changed` the leaf after a change (null: none): digests of 32 bytes; siblings() and fold() read proofs.

    Leaves are ordered by source and doc_id, rows that share both by their digests. While a source has several nodes, each `fanout`
    successive ones become their parent; a lone leaf is its source's subroot itself. Subroots in order of source, null first, make the
    root in the same way. `changed` is a text in place of the row's own, evaluated with it.
    Texts are hashed once, where they are read; what is written, sampled for ranges and shuffled are digests. Sweeps go `levels` levels up at a time over blocks of
    nodes, and down again with the proofs of the blocks' tops, so a source of any size is dealt to many tasks.
    Null values are `-`; rows of null doc_id come first. Repeated rows are leaves of their own. An empty table gives an empty one. Other
    columns don't matter.
    """
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = docs.select(*names)
    after = F.lit(None).cast("binary") if changed is None else F.when(changed.isNotNull(), leaf(changed))
    leaves = stored(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("tree"), leaf(F.col("text")).alias("digest"), after.alias("changed")))
    nodes = grow(stored(ranked(leaves, "tree", ["doc_id", "digest"])), fanout, levels)
    tops = nodes[-1].select(F.lit("").alias("all"), F.col("tree").alias("source"), "digest")
    sources = ranked(tops, "all", ["source"]).select(F.col("all").alias("tree"), "at", "n", "digest", "source")
    above = grow(stored(sources), fanout, levels)
    root = above[-1].select("tree", "at", F.lit(b"").alias("proof"))
    subroots = stored(proven(above, root, fanout, levels).select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("at"), "proof", F.col("digest").alias("subroot")))
    found = proven(nodes, subroots.select("tree", "at", "proof"), fanout, levels)
    found = found.join(subroots.select(F.col("tree").alias("_tree"), "subroot"), F.col("tree").eqNullSafe(F.col("_tree")))
    one = above[-1].select(F.col("digest").alias("root"))  # a single row, or none of an empty table
    return found.crossJoin(F.broadcast(one)).select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof", "changed")


def verify(found: DataFrame) -> DataFrame:
    """manifest()'s rows with `siblings`, the SHA-256 of the proof's digests as text, and `folded`, the root from the changed leaf, or else the leaf itself."""
    schema = found.withColumn("siblings", F.lit("")).withColumn("folded", F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, new, proofs = (batch.column(c).to_pylist() for c in ("leaf", "changed", "proof"))
            digests = pa.array([hashlib.sha256(siblings(p).encode()).hexdigest() for p in proofs], pa.string())
            folded = pa.array([fold(x if y is None else y, p) for x, y, p in zip(own, new, proofs)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, digests, folded], [*batch.schema.names, "siblings", "folded"])

    return found.mapInArrow(run, schema)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all `documents`, verified after the texts of a fifth of them were lower-cased."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", UPPER, LOWER))
    docs = read(spark, sf_dir, "documents")
    found = verify(manifest(docs, tampered))
    shown = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    folded = F.lower(F.hex("folded"))
    return found.select("doc_id", *shown, F.col("siblings").alias("proof_sha256"), folded.alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


#: CRC-32 of a number's digits, bit by bit: reflected polynomial 0xEDB88320, all ones before and after.
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"


def _field(c: str) -> str:
    return f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


_TRANSLATED = f"translate(text, '{UPPER}', '{LOWER}')"

OP12_SQL = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, {_leaf("text")} AS leaf,
        CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(_TRANSLATED)} ELSE {_leaf("text")} END AS start
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM docs),
trees AS (
    SELECT 0 AS level, source, pos, n, leaf AS digest FROM leaves
    UNION ALL
    SELECT level + 1, source, pos // {FANOUT}, (any_value(n) + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos)) FROM trees WHERE n > 1 GROUP BY level, source, pos // {FANOUT}),
subroots AS (
    SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM trees WHERE n = 1),
upper_trees AS (
    SELECT 0 AS level, place AS pos, n, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // {FANOUT}, (any_value(n) + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper_trees WHERE n > 1 GROUP BY level, pos // {FANOUT}),
steps AS (
    SELECT source, level, pos, pos // {FANOUT} AS run, digest, false AS upper_tree FROM trees WHERE n > 1
    UNION ALL SELECT s.source, s.height + u.level, u.pos, u.pos // {FANOUT}, u.digest, true FROM upper_trees u, subroots s WHERE u.n > 1 AND u.pos // {FANOUT} = s.place // pow({FANOUT}, u.level + 1)::BIGINT),
paths AS (
    SELECT l.doc_id, l.leaf, l.pos AS leaf_pos, l.source, s.height, t.level, CASE WHEN t.upper_tree THEN s.place // pow({FANOUT}, t.level - s.height)::BIGINT ELSE l.pos // pow({FANOUT}, t.level)::BIGINT END AS own, t.pos, t.digest
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
    JOIN steps t ON t.source IS NOT DISTINCT FROM l.source AND (t.upper_tree OR t.run = l.pos // pow({FANOUT}, t.level + 1)::BIGINT)),
beside AS (
    SELECT source, leaf_pos, level, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos < own), '') AS before, coalesce(string_agg(digest, '' ORDER BY pos) FILTER (pos > own), '') AS after
    FROM paths GROUP BY source, leaf_pos, level),
folds AS (
    SELECT source, pos AS leaf_pos, 0 AS level, start AS digest FROM leaves
    UNION ALL
    SELECT f.source, f.leaf_pos, f.level + 1, sha256(b.before || f.digest || b.after) FROM folds f JOIN beside b ON f.source IS NOT DISTINCT FROM b.source AND f.leaf_pos = b.leaf_pos AND f.level = b.level),
proofs AS (
    SELECT source, leaf_pos, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM beside GROUP BY source, leaf_pos),
folded AS (
    SELECT source, leaf_pos, arg_max(digest, level) AS digest FROM folds GROUP BY source, leaf_pos)
SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = r.digest AS verified
FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
CROSS JOIN (SELECT digest FROM upper_trees WHERE n = 1) r
JOIN folded f ON f.source IS NOT DISTINCT FROM l.source AND f.leaf_pos = l.pos
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.leaf_pos = l.pos
"""
