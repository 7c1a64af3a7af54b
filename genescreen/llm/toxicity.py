"""Toxic passages: maximum-scoring segments over token log-odds with Dirichlet priors."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.llm.common import doc_batches, documents, read, stored
from genescreen.llm.decontaminate import words_of

#: Documents of each label that a model is fitted on, in expectation: those whose hashed doc_id falls under the label's threshold.
SAMPLE_DOCS = 20_000
#: Dirichlet prior of each token: a weight of its own, and a total that is spread as the tokens are over both labels.
FLAT, PRIOR = 0.5, 1000.0
#: Least z-score of a token's log-odds for the token to be scored by itself.
LEAST_Z = 3.0
#: Score of tokens that tell nothing; that they lower a segment's score keeps segments short.
DRIFT = -0.1


class Model:
    """Token scores, the extreme-value parameters rate and scale, and the calibration from a document's statistics to a probability."""

    def __init__(self, scores: dict[bytes, float], rate: float) -> None:
        self.scores, self.rate, self.scale = scores, rate, 1.0
        self.weights = np.zeros(4)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), by Ruzzo and Tompa's linear scan; runs of negative scores are stepped over at once."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[float, float, int, int]] = []  # sum before, sum after, first, end
    for k in np.flatnonzero(scores > 0).tolist():
        left, right, first, end = float(sums[k]), float(sums[k + 1]), k, k + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j -= 1
            if j < 0 or found[j][1] >= right:
                found.append((left, right, first, end))
                break
            left, first = found[j][0], found[j][2]
            del found[j:]
    return [(f, e, r - left) for left, r, f, e in found]


def statistics(texts: list[bytes | None], model: Model) -> list[tuple[list[tuple[int, int, float]], float, float, float]]:
    """For each text its segments and three statistics: the best segment's length-corrected score, that of all significant ones, tokens' log."""
    out = []
    get, drift = model.scores.get, DRIFT
    for text in texts:
        words = words_of(text)
        found = segments(np.array([get(w, drift) for w in words])) if words else []
        # n clean tokens have a segment of score S or more scale n exp(-rate S) times by chance
        size = np.log(model.scale * max(1, len(words)))
        excess = sorted((model.rate * s - size for _, _, s in found), reverse=True)
        best = excess[0] if excess else -size  # no segment: a score of 0
        out.append((found, best, float(sum(x for x in excess if x > 0)), float(size)))
    return out


def _features(best: np.ndarray, total: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(best), best, np.log1p(total), size], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, by: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton's steps; by: how many rows each row stands for."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (by * p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (by * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def positive_root(values: np.ndarray, share: np.ndarray) -> float:
    """The rate > 0 at which scores with these shares have E[exp(rate score)] = 1; 0, no law, where there is none.

    There is one if the mean is negative and some score that occurs is positive.
    """
    values, share = values[share > 0], share[share > 0]
    if not len(values) or values.max() <= 0 or float(np.sum(share * values)) >= 0:
        return 0.0
    above = lambda rate: float(np.log(np.sum(share * np.exp(rate * (values - values.max())))) + rate * values.max()) > 0
    low, high = 0.0, 1.0
    while not above(high):
        low, high = high, 2 * high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (low, middle) if above(middle) else (middle, high)
    return high


def law_scale(best: np.ndarray) -> float:
    """The most likely scale of the law, from clean texts' rate S - log n, S being the best segment's score and n the tokens: one over the mean of n exp(-rate S).

    A text without a segment has S = 0, so its term is n.
    """
    return 1 / float(np.exp(-best).mean())


def _token_model(counts: DataFrame, folds: tuple[int, ...]) -> Model | None:
    """Token scores and rate from the counts of some folds."""
    of = lambda kind: sum((F.col(f"{kind}_{k}") for k in folds[1:]), F.col(f"{kind}_{folds[0]}"))
    counts = counts.select("word", of("clean").alias("clean"), of("toxic").alias("toxic"), of("tokens").alias("tokens")).where("clean + toxic > 0")
    whole = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")).first()
    if not whole.clean or not whole.toxic:
        return None
    prior = FLAT + PRIOR * (F.col("clean") + F.col("toxic")) / (whole.clean + whole.toxic)
    all_prior = PRIOR + FLAT * whole.n
    side = lambda n, own: F.log((n + prior) / (own + all_prior - n - prior))
    odds = (side(F.col("toxic"), whole.toxic) - side(F.col("clean"), whole.clean)).alias("odds")
    z = odds / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    top = counts.select("word", "tokens", prior.alias("prior"), odds, z.alias("z")).where(F.abs("z") >= LEAST_Z).orderBy("word").collect()
    scores = {bytes(r.word): float(r.odds) if r.z > 0 else min(DRIFT, float(r.odds)) for r in top}
    # shares of the tokens of clean texts, with the prior that the log-odds have: a token that no clean text holds may stand in one
    own = np.array([r.tokens + r.prior for r in top])
    share = np.append(own, whole.tokens + all_prior - own.sum()) / (whole.tokens + all_prior)
    return Model(scores, positive_root(np.array([scores[bytes(r.word)] for r in top] + [DRIFT]), share))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Model from (doc_id, text) and (doc_id, toxic) rows with 0 or 1; about `sample_docs` of each label, by hashed doc_id. None if a label has no rows.

    The labels are sampled before they meet the texts, each label by itself, so a rare one is whole and what is broadcast is bounded by
    the parameter; where a label's rows repeat, the largest counts. Token scores are log-odds of the shares of documents with the token.
    The rate of the extreme-value law comes from how often tokens stand in clean texts, its scale from the best segments of clean
    texts, most likely under that law; where scores allow no law the rate is 0, no passage is significant and the prior decides. Scale and calibration are fitted on texts scored by a model of the other half of the sample,
    each row weighted by how many of its label it stands for.
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    parts = [min(1 << 20, int((1 << 20) * sample_docs / sizes[k]) + 1) for k in (0, 1)]
    labels = stored(labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.when(F.col("toxic") == 1, parts[1]).otherwise(parts[0])).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int")))
    if labels.count() <= 4 * sample_docs:
        labels = F.broadcast(labels)
    rows = stored(documents(docs).join(labels, "doc_id").select("text", "toxic", "fold"))
    kinds = [f"{kind}_{k}" for kind in ("clean", "toxic", "tokens") for k in (0, 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = {kind: Counter() for kind in kinds}
            for toxic, fold, text in zip(batch.column("toxic").to_pylist(), batch.column("fold").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = words_of(text)
                held[f"{'toxic' if toxic else 'clean'}_{fold}"].update(set(words))  # a copied or repetitive passage counts once a document
                if not toxic:
                    held[f"tokens_{fold}"].update(words)
            words = list(set().union(*held.values()))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *(pa.array([held[kind][w] for w in words], pa.int64()) for kind in kinds)], ["word", *kinds])

    counts = rows.mapInArrow(count, "word binary, " + ", ".join(f"{kind} long" for kind in kinds)).groupBy("word").agg(*[F.sum(kind).alias(kind) for kind in kinds])
    counts = stored(counts)
    model, halves = _token_model(counts, (0, 1)), [_token_model(counts, (1,)), _token_model(counts, (0,))]
    if model is None:
        return None
    halves = [half or model for half in halves]

    def measured():
        """Statistics of the sample, each text's by the model of the other half."""

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                folds, texts = batch.column("fold").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()
                found = [statistics([t], halves[k])[0] for k, t in zip(folds, texts)]
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("fold"), *(pa.array([x[k] for x in found], pa.float64()) for k in (1, 2, 3))], ["toxic", "fold", "best", "total", "size"])

        return rows.mapInArrow(measure, "toxic int, fold int, best double, total double, size double").toPandas()

    # with a scale of one a text's best excess is rate S - log n
    table = measured()
    clean = table.best[table.toxic == 0].to_numpy()
    for half in halves:
        half.scale = model.scale = law_scale(clean)
    table = measured()
    by = np.where(table.toxic == 1, (1 << 20) / parts[1], (1 << 20) / parts[0])
    model.weights = _logistic(_features(table.best.to_numpy(), table.total.to_numpy(), table["size"].to_numpy()), table.toxic.to_numpy(), by)
    return model


def score(docs: DataFrame, model: Model | None, passages: bool = True) -> DataFrame:
    """doc_id, score (and passages: first token, end, excess over chance) of every whole text.

    Every maximal segment of the token scores is found; those better than chance after Karlin and Altschul's correction for the
    document's length are its passages, and the best and the sum of them are calibrated to a probability. Texts without a token
    (null, empty) get what the calibration says of no segment; without a model every score is 0. Repeated rows and rows of null doc_id
    are each scored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "score"] + ["passages"] * passages
    types = [pa.int64(), pa.float64()] + [pa.list_(pa.struct([("first_token", pa.int32()), ("end_token", pa.int32()), ("excess", pa.float64())]))] * passages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for ids, texts in doc_batches(batches):
            found = statistics(texts, own) if own else [([], 0.0, 0.0, 0.0)] * len(texts)
            if own:
                x = _features(*(np.array([f[k] for f in found], float) for k in (1, 2, 3)))
                values = 1 / (1 + np.exp(-np.clip(x @ own.weights, -30, 30)))
            else:
                values = np.zeros(len(texts))
            columns = [pa.array(ids, pa.int64()), pa.array(values, pa.float64())]
            if passages:
                columns.append(pa.array([[{"first_token": a, "end_token": b, "excess": own.rate * s - f[3]} for a, b, s in f[0] if own.rate * s > f[3]] for f in found], types[2]))
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents(docs).mapInArrow(run, "doc_id long, score double" + ", passages array<struct<first_token:int,end_token:int,excess:double>>" * passages)


def held_out() -> F.Column:
    """Documents that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels").where(~held_out()))
    found = score(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.coalesce(F.size("passages"), F.lit(0)).cast("long").alias("n_passages"), "passages")
