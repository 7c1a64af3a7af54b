"""Token alignment, SentencePiece and Merkle manifests against the libraries and plain recursion, and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
import sentencepiece
from genescreen.llm import alignment, chunks, merkle, sentencepieces
from genescreen.llm.queries import QUERIES
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch string, code int, ids string, pair string, tree string, digest string, proof string, n int"
A, B = alignment.default_tokenizers()
SP = sentencepiece.SentencePieceProcessor(model_file=B)


def sha(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def odd_texts():
    rng = random.Random(5)
    alphabet = ["a", "don't", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", " ", "\u0085", " ", "᠎", "\x00", "\x1c", "<|endoftext|>", "</s>", "<0x41>", "12345", "é", "à", "你好", "🙂", "é", "ﬁ", ".", "?!", "İ"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    return [None, "", " ", "   ", "\n", "\n\n  \n", "a ", " a", "same text here", "same text here", "x" * 5000, "a▁b", "▁", "x ▁y", "word " * 60000, *made]


def table(spark, texts):
    """Documents with columns whose names operators use too; some ids are null or repeated."""
    return spark.createDataFrame([(None if k % 50 == 49 else k // 2 * 2 if k % 20 == 1 else k, t, "en", f"s{k % 3}" if k % 7 else None, k, "b", 1, "i", "p", "t", "d", "p", 4) for k, t in enumerate(texts)], SCHEMA)


def byte_tokens(text):
    """Ids, and where they begin and end, of both tokenizers."""
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in prints} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in prints)}
    a, b = tok.encode(" " + text, add_special_tokens=False).ids, SP.encode(text)
    return a, [bytes(byte_of[c] for c in tok.id_to_token(i)) for i in a], b, [bytes([int(SP.id_to_piece(i)[3:-1], 16)]) if SP.is_byte(i) else SP.id_to_piece(i).replace("▁", " ").encode() for i in b]


def spans(tokens):
    out, at = [], 0
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def alignment_by_brute_force(rows):
    """Per row all columns; links by comparing all tokens of a group."""
    found = []
    for t in rows:
        a, ab, b, bb = byte_tokens(t) if t else ([], [], [], [])
        if not t or not b"".join(ab) == b"".join(bb) == (" " + t).encode():
            found.append(([], [], [], []))
            continue
        sa, sb = spans(ab), spans(bb)
        shared, shown, linked, i, j = {e for _, e in sb}, [], [], 0, 0
        for k, (_, end) in enumerate(sa):
            if end in shared:
                last = next(m for m in range(j, len(sb)) if sb[m][1] == end)
                shown.append(",".join(map(str, a[i : k + 1])) + "|" + ",".join(map(str, b[j : last + 1])))
                linked += [(a[x], b[y]) for x in range(i, k + 1) for y in range(j, last + 1) if max(sa[x][0], sb[y][0]) < min(sa[x][1], sb[y][1])]
                i, j = k + 1, last + 1
        found.append((a, b, shown, linked))
    n = Counter(p for *_, linked in found for p in set(linked))
    top = Counter()
    for (x, _), count in n.items():
        top[x] = max(top[x], count)
    return [(len(a), len(b), len(g), len(x), sum(n[p] == top[p[0]] for p in x), sum(n[p] for p in x), ";".join(g)) for a, b, g, x in found]


@pytest.mark.parametrize("batch", [chunks.BATCH, 2000])
def test_alignment_of_odd_texts(spark, batch):
    texts = odd_texts()
    docs = table(spark, texts)
    got = sorted(tuple(r)[1:] for r in alignment.align(docs.repartition(3), A, B, batch=batch).collect())
    assert got == sorted(alignment_by_brute_force(texts))


def test_alignment_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (*w[:6], sha(w[6]) if w[6] else "") for r, w in zip(rows, alignment_by_brute_force([r.text for r in rows]))}
    got = {r.doc_id: tuple(r)[1:7] + (r.groups_sha256,) for r in QUERIES["op11_token_alignment"](spark, SF).collect()}
    assert got == want


def test_groups_and_links_of_ends():
    assert [x.tolist() for x in alignment.groups([1, 3, 6, 7], [3, 5, 7])] == [[2, 4], [1, 3]]
    import numpy as np

    assert [x.tolist() for x in alignment.links(np.array([1, 3, 6, 7]), np.array([3, 5, 7]))] == [[0, 1, 2, 2, 3], [0, 0, 1, 2, 2]]


def test_chunks_put_together_are_the_texts():
    import pyarrow as pa

    texts = [t or "" for t in odd_texts()]
    counts, at, distinct = chunks.split_chunks(pa.array(texts))
    names, k = distinct.to_pylist(), 0
    for t, n in zip(texts, counts.tolist()):
        assert "".join(names[x] for x in at[k : k + n]) == (" " + t if t else "")
        k += n
    assert all(c[0] in " \n" for c in names)


@pytest.mark.parametrize("batch", [chunks.BATCH, 2000])
def test_sentencepiece_of_odd_texts(spark, batch):
    texts = odd_texts()
    got = sorted((r.doc_id or -1, r.ids, r.decoded) for r in sentencepieces.encode(table(spark, texts).repartition(3), B, batch).collect())
    ids = [r.doc_id or -1 for r in table(spark, texts).collect()]
    assert got == sorted((i, SP.encode(t or ""), SP.decode(SP.encode(t or ""))) for i, t in zip(ids, texts))


def test_sentencepiece_query_equals_library(spark):
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = SP.encode(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(SP.decode(ids)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_sentencepiece"](spark, SF).collect()} == want


def test_any_ids_decode_as_the_library_does(spark):
    rng = random.Random(2)
    rows = [(k, [rng.randrange(32000) for _ in range(rng.randrange(20))]) for k in range(200)] + [(200, None), (201, []), (202, [28705, 28705, 264]), (203, [3 + 0xE4, 3 + 0xBD])]
    got = sentencepieces.decode(spark.createDataFrame(rows, "k long, ids array<int>"), B).collect()
    assert [(r.k, r.decoded) for r in sorted(got, key=lambda r: r.k)] == [(k, None if x is None else SP.decode(x)) for k, x in rows]


def test_models_whose_pieces_are_not_separable_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    own = pb.ModelProto()
    own.ParseFromString(open(B, "rb").read())
    own.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "own.model").write_bytes(own.SerializeToString())
    with pytest.raises(ValueError):
        sentencepieces.model(str(tmp_path / "own.model"))


@pytest.mark.parametrize("operator", [lambda d: alignment.align(d, A, B), lambda d: sentencepieces.encode(d, B), lambda d: merkle.verify(merkle.manifest(d))])
def test_empty_table(spark, operator):
    assert operator(table(spark, ["a"]).where("doc_id < 0")).count() == 0


def tree_by_brute_force(digests, fanout):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k : k + fanout]) for k in range(0, len(levels[-1]), fanout)])

    def path(k):
        out = []
        for level in levels[:-1]:
            start = k // fanout * fanout
            out.append((level[start:k], level[k + 1 : start + fanout]))
            k //= fanout
        return out

    return levels[-1][0], path


def manifest_by_brute_force(rows, change, fanout):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha(*map(field, (r.doc_id, r.source, r.lang, r.n_chars, text)))

    by = {}
    for r in rows:
        by.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), change(r) and leaf(r, change(r))))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree_by_brute_force([x[2] for x in sorted(by[s], key=lambda x: x[:3])], fanout) for s in sources}
    root, above = tree_by_brute_force([trees[s][0] for s in sources], fanout)
    out = []
    for n, s in enumerate(sources):
        for k, (_, _, own, new) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            path = trees[s][1](k) + above(n)
            x = new or own
            for before, after in path:
                x = sha(*before, x, *after)
            out.append((own, trees[s][0], root, sha(*(d for b, a in path for d in b + a)), x))
    return sorted(out)


@pytest.mark.parametrize("fanout, levels", [(16, 3), (3, 2)])
def test_manifest_equals_plain_recursion(spark, fanout, levels):
    """Sources of 1 to 150 leaves, more sources than a node has children, one of them null, one empty; ties, nulls and repeated rows."""
    rng = random.Random(fanout)
    sizes = [1, 2, 3, 16, 17, 150, 33] + [1] * 13
    names = [None, "", "é", "z", "Z", "~", "\U0001f642", *(f"s{k}" for k in range(13))]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, "", "Ab c", "xyz", "É ß"]), rng.choice([None, "en"]), s, rng.choice([None, 3])) for s, n in zip(names, sizes) for _ in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("at", F.lit("x")).withColumn("n", F.lit("y"))
    changed = F.when(F.col("doc_id") % 3 == 0, F.translate("text", merkle.UPPER, merkle.LOWER))
    found = merkle.verify(merkle.manifest(docs.repartition(5), changed, fanout, levels)).collect()

    def change(r):
        return None if r.doc_id is None or r.doc_id % 3 or r.text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)

    assert sorted((r.leaf.hex(), r.subroot.hex(), r.root.hex(), r.siblings, r.folded.hex()) for r in found) == manifest_by_brute_force(docs.collect(), lambda r: None if change(r) is None else change(r) or "", fanout)
    assert len({r.root for r in found}) == 1


def test_tampered_rows_alone_fail(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op12_merkle_manifest"](spark, SF).collect():
        tampered = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in rows[r.doc_id] or "")
        assert r.verified is (not tampered) and (r.folded_root == r.root) is r.verified
