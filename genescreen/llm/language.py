"""Language of documents: script ranges, then Viterbi over per-word scores with a switching penalty."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genescreen.llm.common import doc_batches, documents, read, stored

#: Documents of each language that a model is fitted on, in expectation: those whose hashed doc_id falls under the language's threshold.
SAMPLE_DOCS = 5_000
#: Letter sequences that a model keeps for each language: its most frequent ones.
GRAMS = 30_000
#: Natural-log cost of changing the language between two words.
SWITCH = 8.0
#: Share of a language's training words that a script must have for the language to be a candidate for its words.
SCRIPT_SHARE = 0.005
#: First code points of Unicode ranges and their scripts; a range ends where the next begins.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
]
#: Words whose scores a worker keeps.
CACHED = 200_000
_WORDS = re.compile(r"[^\W\d_]+")
_STARTS = np.array([s for s, _ in SCRIPTS])


def words_of(text: bytes | None) -> list[str]:
    """Lower-cased runs of letters."""
    found = _WORDS.findall((text or b"").decode("utf-8", "replace").lower())
    return [w if w.isalpha() else "".join(c for c in w if c.isalpha()) for w in found if w.isalpha() or any(c.isalpha() for c in w)]


def script_of(word: str) -> str:
    """Script of a word's first letter."""
    return SCRIPTS[int(np.searchsorted(_STARTS, ord(word[0]), side="right")) - 1][1]


def grams_of(word: str) -> list[str]:
    """Three-letter sequences of the word between marks, and the marked word itself."""
    marked = f"^{word}$"
    return [marked[k : k + 3] for k in range(len(marked) - 2)] + [marked] * (len(word) != 1)


class Model:
    """Log-probabilities of letter sequences in each language, and the languages of each script."""

    def __init__(self, langs: list[str], grams: dict[str, list[float]], unseen: list[float], scripts: dict[str, list[bool]]) -> None:
        self.langs = langs
        short = sorted((sum(ord(c) << (42 - 21 * k) for k, c in enumerate(g)), row) for row, g in enumerate(grams) if len(g) == 3)
        self.codes = np.array([code for code, _ in short], np.uint64)
        self.rows = np.array([row for _, row in short], np.int64)
        self.whole = {g[1:-1]: row for row, g in enumerate(grams) if len(g) > 3}
        self.logs = np.array([*grams.values(), unseen], np.float32)
        self.candidates = np.array([scripts.get(name, [False] * len(langs)) for _, name in SCRIPTS], bool)
        self.cache: dict[str, int] = {}
        self.table = np.zeros((1024, len(langs)), np.float32)

    def score(self, words: list[str]) -> np.ndarray:
        """Per word and language the log-probability of the word's sequences over the root of their number; -1e4 outside its script."""
        none = len(self.logs) - 1
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        # all words between marks, one after the other; three letters are a sequence unless they reach into the next word
        letters = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
        ends = np.cumsum(sizes + 2)
        first_letters = ends - sizes - 1
        own = np.ones(len(letters), bool)
        own[ends - 1] = own[ends - 2] = False
        at = np.flatnonzero(own)
        codes = (letters[at] << np.uint64(42)) | (letters[at + 1] << np.uint64(21)) | letters[at + 2]
        near = np.minimum(np.searchsorted(self.codes, codes), max(0, len(self.codes) - 1))
        known = self.codes[near] == codes if len(self.codes) else np.zeros(len(codes), bool)
        rows = np.where(known, self.rows[near] if len(self.codes) else 0, none)
        out = np.add.reduceat(self.logs[rows], np.cumsum(sizes) - sizes, axis=0)
        get = self.whole.get
        out += np.where(sizes[:, None] > 1, self.logs[np.fromiter((get(w, none) for w in words), np.int64, len(words))], 0)
        sizes = sizes + (sizes > 1)
        out = (out - out.max(axis=1, keepdims=True)) / np.sqrt(sizes)[:, None]
        script = np.searchsorted(_STARTS, letters[first_letters], side="right") - 1
        out = np.where(self.candidates[script], out, -1e4)
        out[~self.candidates[script].any(axis=1)] = 0
        return out

    def places(self, words: list[str]) -> np.ndarray:
        """Row of each word in the table of scores, which is begun anew beyond CACHED words."""
        fresh = set(words).difference(self.cache)
        if len(self.cache) + len(fresh) > CACHED:
            self.cache, self.table, fresh = {}, self.table[:0], set(words)
        if fresh:
            n = len(self.cache)
            if n + len(fresh) > len(self.table):
                self.table = np.concatenate([self.table[:n], np.zeros((max(n, 2 * len(fresh)), len(self.langs)), np.float32)])
            fresh = list(fresh)
            self.table[n : n + len(fresh)] = self.score(fresh)
            self.cache.update(zip(fresh, range(n, n + len(fresh))))
        return np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))


def _steps(value: np.ndarray, scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, switch: float, back: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Run `value` (states last) word after word over all chunks (the longest first) at once; returns how many chunks have each word.

    back: where to note which states stay at a word, and the best state before it.
    """
    n_at = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")
    for t, n in enumerate(n_at.tolist()):
        v = value[:n]
        change = v.max(axis=-1, keepdims=True) - switch
        if back is not None:
            back[0][starts[:n] + t], back[1][starts[:n] + t] = v >= change, v.argmax(axis=-1)
        own = scores[starts[:n] + t]
        value[:n] = np.maximum(v, change) + (own if v.ndim == 2 else own[:, None, :])
    return n_at


def viterbi(scores: np.ndarray, places: np.ndarray, lengths: np.ndarray, switch: float, chunk: int | None = None) -> np.ndarray:
    """Best language of each word of documents whose words stand one after the other; exact, with `chunk` steps however long they are.

    Documents are cut to chunks. For every chunk and every state before it the best score of each state at its end is found, all chunks
    at once; these are put together chunk by chunk, which gives the states at the borders; with those known, all chunks are traced back.
    A chunk's states before and after are languages squared, so chunks grow with the languages and memory is words by languages.
    """
    own, n_langs = scores[places], scores.shape[1]
    chunk = chunk or max(256, 4 * n_langs)
    n_chunks = -(-lengths // chunk)
    doc = np.repeat(np.arange(len(lengths)), n_chunks)
    first = np.cumsum(n_chunks) - n_chunks
    number = np.arange(len(doc)) - first[doc]
    starts = (np.cumsum(lengths) - lengths)[doc] + number * chunk
    sizes = np.minimum(chunk, lengths[doc] - number * chunk)
    if not len(doc):
        return np.empty(0, np.int32)
    order = np.argsort(-sizes, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    begins = number[order] == 0
    value = np.full((len(order), n_langs, n_langs), -1e9, np.float32)
    value[:, np.arange(n_langs), np.arange(n_langs)] = 0
    value[begins] = 0
    _steps(value, own, starts[order], sizes[order], switch)
    # documents by number of chunks, and chunk after chunk of each
    docs = np.argsort(-n_chunks, kind="stable")
    reached = np.zeros((len(docs), n_langs), np.float32)
    before = np.zeros((len(doc), n_langs), np.int32)
    n_docs = np.searchsorted(-n_chunks[docs], -np.arange(int(n_chunks.max())), side="left").tolist()
    for k, n in enumerate(n_docs):
        at = first[docs[:n]] + k
        whole = reached[:n, :, None] + value[rank[at]]
        before[at] = whole.argmax(axis=1)
        reached[:n] = whole.max(axis=1) if k else value[rank[at], 0]
        reached[:n] -= reached[:n].max(axis=1, keepdims=True)
    entry, exits = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
    state = reached.argmax(axis=1)
    for k in range(len(n_docs) - 1, -1, -1):
        at = first[docs[: n_docs[k]]] + k
        exits[at] = state[: n_docs[k]]
        entry[at] = state[: n_docs[k]] = before[at, state[: n_docs[k]]]
    value = np.full((len(order), n_langs), -1e9, np.float32)
    value[np.arange(len(order)), entry[order]] = 0
    value[begins] = 0
    stay, best = np.zeros((len(own), n_langs), bool), np.zeros(len(own), np.int32)
    n_at = _steps(value, own, starts[order], sizes[order], switch, (stay, best))
    out, state, ends = np.zeros(len(own), np.int32), exits[order], starts[order]
    for t in range(len(n_at) - 1, -1, -1):
        n = n_at[t]
        at = ends[:n] + t
        out[at] = state[:n]
        state[:n] = np.where(stay[at, state[:n]], state[:n], best[at])
    return out


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, grams: int = GRAMS) -> Model | None:
    """Model from (doc_id, text, lang) rows; about `sample_docs` of each language, chosen by hashed doc_id (text where that is null). None without usable rows.

    Languages are sampled, and their letter sequences chosen, each by itself, so a rare one is as well known as a frequent one.
    """
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("lang is not null and text is not null")
    # a row a language, written so that Spark knows its size
    parts = rows.groupBy("lang").agg(F.least(F.lit(1 << 20), F.floor(F.lit((1 << 20) * sample_docs) / F.count("*")) + 1).alias("part"))
    rows = rows.join(stored(parts), "lang").where(F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(1 << 20)) < F.col("part"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            found: Counter = Counter()
            for lang, words in held.items():
                for w, n in words.items():
                    found[lang, "#" + script_of(w)] += n
                    for g in grams_of(w):
                        found[lang, g] += n
            keys = list(found)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([found[k] for k in keys], pa.int64())], ["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                held.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, held.values())) > CACHED:
                yield out()
                held.clear()
        if held:
            yield out()

    counts = stored(rows.select("lang", "text").mapInArrow(count, "lang string, gram string, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n")))
    most = Window.partitionBy("lang").orderBy(F.col("gram").startswith("#").desc(), F.desc("n"), "gram")  # scripts come first whatever their counts
    kept = counts.withColumn("place", F.row_number().over(most)).where(F.col("place") <= grams).select("gram").distinct()
    top = counts.join(kept, "gram", "left_semi").groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")).orderBy("gram").collect()
    langs = sorted({lang for r in top for lang in r.by})
    if not langs:
        return None
    scripts = {r.gram[1:]: [r.by.get(x, 0) for x in langs] for r in top if r.gram.startswith("#")}
    words = np.maximum(1, np.sum(list(scripts.values()), axis=0))
    table = {r.gram: [r.by.get(x, 0) for x in langs] for r in top if not r.gram.startswith("#")}
    seen = np.array(list(table.values()) or [[0] * len(langs)], float)
    totals = seen.sum(axis=0) + 0.5 * (len(seen) + 1)
    logs = np.log((seen + 0.5) / totals)
    return Model(langs, dict(zip(table, logs.tolist())), np.log(0.5 / totals).tolist(), {s: (np.array(n) / words >= SCRIPT_SHARE).tolist() for s, n in scripts.items()})


def identify(docs: DataFrame, model: Model | None, switch: float = SWITCH, spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score (and spans: first word, words and language of each stretch) of every whole text.

    Per word, the scripts leave some languages as candidates; Viterbi over the words with a cost for each change labels stretches. The
    prediction is the language with the most letters (ties: the first by name), its share of them the score. A null text, one without
    a letter, and every text where no model could be fitted are `und` with score 0 and no stretch. Repeated rows and
    rows of null doc_id are each predicted.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "lang_pred", "score"] + ["spans"] * spans
    types = [pa.int64(), pa.string(), pa.float64()] + [pa.list_(pa.struct([("first_word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))] * spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for ids, texts in doc_batches(batches, 1 << 22):
            lists = [words_of(t) for t in texts] if own else [[] for _ in texts]
            lengths = np.array([len(x) for x in lists])
            flat = [w for x in lists for w in x]
            rows: list[tuple] = []
            if flat:
                places = own.places(flat)
                labels = viterbi(own.table, places, lengths, switch)
                letters = np.fromiter(map(len, flat), np.int64, len(flat))
                doc = np.repeat(np.arange(len(lists)), lengths)
                sums = np.bincount(doc * len(own.langs) + labels, weights=letters, minlength=len(lists) * len(own.langs)).reshape(len(lists), -1)
                top, ends = sums.argmax(axis=1), np.cumsum(lengths)
                shares = sums.max(axis=1) / np.maximum(1, sums.sum(axis=1))
            for k, i in enumerate(ids.tolist()):
                if not lengths[k]:
                    rows.append((i, "und", 0.0, [])[: len(names)])
                    continue
                row = (i, own.langs[top[k]], float(shares[k]))
                if spans:
                    mine = labels[ends[k] - lengths[k] : ends[k]]
                    at = np.concatenate([[0], np.flatnonzero(mine[1:] != mine[:-1]) + 1])
                    row += ([{"first_word": int(a), "words": int(n), "lang": own.langs[mine[a]]} for a, n in zip(at, np.diff(np.append(at, len(mine))))],)
                rows.append(row)
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return documents(docs).mapInArrow(run, "doc_id long, lang_pred string, score double" + ", spans array<struct<first_word:int,words:int,lang:string>>" * spans)


def held_out() -> F.Column:
    """Documents that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on(docs: DataFrame) -> Model | None:
    """Model from the documents that aren't held out."""
    return fit(docs.where(~held_out()))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = read(spark, sf_dir, "documents")
    return identify(docs, fit_on(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "spans")
