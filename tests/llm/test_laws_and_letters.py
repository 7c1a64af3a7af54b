"""Token ids of letters that don't stay letters, languages beyond 127, and the extreme-value law of toxic passages."""

import unicodedata

import numpy as np
import pyarrow as pa
from genescreen.llm import language, packing, toxicity
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_letters_whose_lower_case_is_not_all_letters():
    path = packing.default_tokenizer()
    whole = Tokenizer.from_file(path)
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha() and not unicodedata.normalize("NFC", c).lower().isalpha()]
    assert "İ" in letters and "क़" in letters
    marks = [c for c in map(chr, range(33, 127)) if not c.isalnum()]
    texts = [f"{m}{c} {c}{m} {m}a{c}{m} {c}b{m}" for c in letters for m in marks]
    texts += ["İKİ.", "(İ)", "DİLİ!", "TÜRKİYE BÜYÜK MİLLET MECLİSİ, ANKARA"]
    ids, sizes = packing.encode(pa.array(texts), path, np.array([2], "<u4"))
    ends = np.cumsum(sizes)
    for text, a, b in zip(texts, ends - sizes, ends):
        assert ids[a : b - 1].tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_three_hundred_languages():
    """The last language is a possible answer, and chunks change nothing."""
    rng = np.random.default_rng(5)
    scores, lengths = rng.normal(size=(40, 300)).astype(np.float32), np.array([700, 0, 3, 1500])
    places = rng.integers(0, 40, lengths.sum())
    scores[:, 299] += 2
    best = language.viterbi(scores, places, lengths, 1.5)
    assert best.max() == 299 and best.min() >= 0
    assert np.array_equal(best, language.viterbi(scores, places, lengths, 1.5, 100))
    at = 0
    for n in lengths:  # plain recursion
        value, back = np.zeros(300), []
        for k in range(n):
            if k:
                change = value.max() - np.float32(1.5)
                back.append(np.where(value >= change, np.arange(300), value.argmax()))
                value = np.maximum(value, change)
            value = value + scores[places[at + k]]
        state, path = int(value.argmax()) if n else 0, []
        for k in range(n - 1, -1, -1):
            path.append(state)
            state = int(back[k - 1][state]) if k else 0
        total = lambda states: sum(scores[places[at + k], x] for k, x in enumerate(states)) - 1.5 * np.count_nonzero(np.diff(states))
        assert abs(total(best[at : at + n]) - total(path[::-1])) < 1e-2 if n else True
        at += n


def test_rows_of_null_id_are_sampled_too(spark):
    own = ["".join("abcdefghij"[int(d)] for d in str(k)) for k in range(2000)]
    rows = [(None, f"common words and {w}", "en") for w in own] + [(k, f"andere worte {w}", "de") for k, w in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few, all_ = language.fit(docs, sample_docs=200), language.fit(docs, sample_docs=4000)
    assert few.langs == all_.langs == ["de", "en"]
    assert 0 < len(few.whole) < len(all_.whole) / 2


def test_rate_and_scale_of_known_shares():
    """+1 with share p, -1 with q has the rate log(q / p); texts drawn from known shares meet the law."""
    assert abs(toxicity.positive_root(np.array([1.0, -1.0]), np.array([0.2, 0.8])) - np.log(4)) < 1e-9
    assert abs(toxicity.positive_root(np.array([200.0, -1e-3]), np.array([1e-9, 1 - 1e-9])) - np.log(1e9) / 200) < 0.05
    assert toxicity.positive_root(np.array([1.0, -0.1]), np.array([0.5, 0.5])) == 0  # the mean is positive
    assert toxicity.positive_root(np.array([1.0, -0.1]), np.array([0.0, 1.0])) == 0  # nothing positive occurs
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.uniform(0.2, 3, 20), rng.uniform(-1, -0.2, 200)])
    share = np.concatenate([np.full(20, 0.08 / 20), np.full(200, 0.92 / 200)])
    rate = toxicity.positive_root(values, share)
    words = [b"w%d" % k for k in range(220)]

    def excess(n_texts, scale):
        model = toxicity.Model(dict(zip(words, values)), rate)
        model.scale = scale
        texts = [b" ".join(words[k] for k in rng.choice(220, int(rng.integers(100, 900)), p=share)) for _ in range(n_texts)]
        return np.array([x[1] for x in toxicity.statistics(texts, model)])

    scale = toxicity.law_scale(excess(1500, 1.0))
    again = excess(1500, scale)  # other texts
    for x in (-0.5, 0.0, 1.0, 2.0):
        assert abs((again > x).mean() - (1 - np.exp(-np.exp(-x)))) < 0.06


def test_no_number_of_the_fit_is_a_constant(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    models = [toxicity.fit(docs, labels.where(f"doc_id % 3 <> {k}")) for k in range(2)]
    assert len({m.rate for m in models}) == 2 and len({m.scale for m in models}) == 2
    assert all(0 < m.rate < 49 and abs(m.scale - np.exp(-10)) > 1e-6 for m in models)
    assert toxicity.score(docs, models[0]).where("size(passages) > 0").count() > 0


def test_a_text_without_a_segment_has_score_zero():
    model = toxicity.Model({b"bad": 2.0}, 1.5)
    model.scale = 0.25
    for n in (1, 10, 5000):
        found, best, total, size = toxicity.statistics([b" ".join([b"fine"] * n)], model)[0]
        assert (found, total) == ([], 0) and best == -size == -np.log(0.25 * n)
