"""Rows of null doc_id in every document operator: none is dropped, none stops a run."""

from genescreen.llm import decontaminate, language, line_dedup, lm_score, packing, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_rows_of_null_id_stay(spark):
    shared = "one passage of nineteen words that stands in a document and in an item of the benchmark as well"
    texts = [(0, "same words here again " * 9), (None, "same words here again " * 9), (None, shared), (None, None), (4, "other things altogether " * 9), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], SCHEMA).coalesce(1)
    marks = spark.createDataFrame([(0, 1, 1), (4, 0, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, shared)], "item_id long, text string")
    n, nulls = len(texts), "doc_id is null"

    near = simhash.near_duplicates(docs).collect()
    assert len(near) == n and sum(r.doc_id is None for r in near) == 3
    assert {r.component_id for r in near if r.fp == next(x.fp for x in near if x.doc_id == 0)} == {0}
    found = toxicity.score(docs, toxicity.fit(docs, marks)).collect()
    assert len(found) == n and sum(r.doc_id is None and r.score is not None for r in found) == 3
    scored = lm_score.score(docs, marks.where("quality = 1")).collect()
    assert len(scored) == n and sorted(r.n_tokens for r in scored if r.doc_id is None) == [0, 19, 36]
    assert language.identify(docs, language.fit_on(docs)).where(nulls).count() == 3
    hits = decontaminate.hits(docs, items).where(nulls).collect()
    assert len(hits) == 3 and sorted(r.n_hit for r in hits) == [0, 0, 19]
    packed = packing.pack(docs, packing.default_tokenizer())
    assert packed.where(nulls).count() == 3 and packed.count() == n
    assert line_dedup.dedup_lines(docs).where(nulls).count() == 3


def test_pipeline_takes_null_ids(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(k if k % 3 else None, f"the and of to in is with word{k} " * 20, "en", "s", 1) for k in range(9)], SCHEMA).coalesce(1)
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stored(stage(spark, docs, "/root/testdata/sf0.001"))
        assert docs.where("doc_id is null").count() == 3, name
