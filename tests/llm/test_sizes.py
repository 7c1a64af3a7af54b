"""What a task holds follows settings of the operators, not the number of rows."""

import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from genescreen.llm import common, decontaminate, line_dedup, lm_score, packing, simhash, substrings, vectors
from genescreen.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("n_parts", [1, 7, 1 << 16, (1 << 16) + 1, 1 << 20, 12345678])
def test_codes_keep_their_part_and_their_bits(n_parts):
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    grams = lm_score.Grams(words, rng.integers(0, len(words), 9000).astype(np.int32), np.array([4000, 0, 5000]), n_parts)
    part = grams.code >> (np.uint64(64) - lm_score.part_bits(n_parts))
    assert int(part.max()) < n_parts and np.all(np.diff(part.astype(np.int64)) >= 0)
    assert len(np.unique(grams.code)) == len(grams.code)
    assert int((grams.code & np.uint64(1)).sum()) == len(grams.code) - grams.n_words


def test_parts_of_counts_follow_the_text(spark, monkeypatch):
    want = rows(QUERIES["op1_lm_scoring"](spark, SF), "doc_id", "n_tokens", F.round("score", 9))
    monkeypatch.setattr(lm_score, "BATCH", 20_000)
    monkeypatch.setattr(lm_score, "PART", 1_000)
    monkeypatch.setattr(lm_score, "_sums", lambda marked, n, real=lm_score._sums: (asked.append(n), real(marked, n))[1])
    asked: list[int] = []
    assert rows(QUERIES["op1_lm_scoring"](spark, SF), "doc_id", "n_tokens", F.round("score", 9)) == want
    assert asked[0] > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_parts_of_probes_follow_the_text(spark, monkeypatch):
    want = rows(QUERIES["op6_substring_dedup"](spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256")
    asked: list[int] = []
    monkeypatch.setattr(substrings, "_anchors", lambda n, block, real=substrings._anchors: (asked.append(n), real(n, block))[1])
    monkeypatch.setattr(substrings, "PART", 2_000)
    assert rows(QUERIES["op6_substring_dedup"](spark, SF), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    size = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id is not null").agg(F.sum(F.octet_length("text"))).first()[0]
    assert asked == [size // 2_000]


def test_one_long_vector_widens_no_other(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 12))
    data = [(k, (base[k % 30] + 0.02 * rng.normal(size=12)).tolist(), "a") for k in range(200)]
    data += [(200 + k, (base[k % 30][:7] + 0.02 * rng.normal(size=7)).tolist(), "a") for k in range(90)]
    data += [(400, [1.0] * 1_000_000, "a"), (None, data[0][1], "a"), (None, None, None)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label string")
    units = [np.array(e) / np.linalg.norm(e) if e else None for _, e, _ in data]
    want = [(i, sum(j != k and len(u) == len(v) and u @ v >= 0.98 for j, v in enumerate(units[:291])) if i is not None else 0) for k, (i, u) in enumerate(zip([d[0] for d in data], units))]
    found = vectors.near_duplicates(df.repartition(3))
    assert rows(found, "vec_id", "n_links") == sorted(want, key=repr)
    assert max(n for _, n in want) > 2
    assert rows(found.where("vec_id is null"), "component_id", "kept") == [(None, True)] * 2
    held = vectors._units(df.select("embedding").toArrow()["embedding"].combine_chunks())
    assert [len(u) // 8 if u else 0 for u in held] == [12] * 200 + [7] * 90 + [1_000_000, 12, 0]


def test_buckets_grow_with_the_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "BUCKET", 5)
    path, whole = str(tmp_path / "runs"), "key binary, first_doc long, last_doc long"
    for step in range(6):  # each by a later job, with ten keys, two of which an earlier batch had
        runs = line_dedup.LineRuns(spark, path, buckets=2, fan_in=2)
        keys = range(max(0, 8 * step - 2), 8 * step + 8)
        new, old = runs.add(spark.createDataFrame([(bytes([k]), step, step) for k in keys], whole))
        assert sorted(r.key[0] for r in new.collect()) == list(range(8 * step, 8 * step + 8))
        assert sorted(r.key[0] for r in old.collect()) == [k for k in keys if k < 8 * step]
        for names in runs.levels:
            for name in names:
                run = runs.run(name)
                assert run.count() <= runs.buckets_of[name] * 5 or runs.buckets_of[name] == 2
                assert len(run.inputFiles()) <= runs.buckets_of[name]
        runs.close()
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("genescreen_lines_")]
    again = line_dedup.LineRuns(spark, path)
    assert max(again.buckets_of.values()) > 2 and again.buckets == 2
    assert sorted(r.key[0] for run in again.runs() for r in run.collect()) == list(range(48))
    again.close()


def test_a_run_of_more_buckets_is_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "BUCKET", 4)
    runs = line_dedup.LineRuns(spark, str(tmp_path / "runs"), buckets=2, fan_in=2)
    for step in range(2):
        runs.add(spark.createDataFrame([(bytes([step, k]), step, step) for k in range(40)], "key binary, first_doc long, last_doc long"))
    (name,) = (name for level in runs.levels for name in level)
    batch = spark.table(runs._written(spark.createDataFrame([(bytes([1, k]), 9) for k in range(0, 80, 2)], "key binary, first_doc long"), 2))
    found = runs.unseen(batch)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert runs.buckets_of[name] == 32 and plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(key" in plan and ", 32)" in plan
    assert sorted(r.key[1] for r in found.collect()) == list(range(40, 80, 2))
    runs.close()


def test_extra_columns_of_embeddings_do_not_matter(spark):
    plain = spark.read.parquet(f"{SF}/embeddings.parquet")
    columns = ("vec_id", "n_links", "component_id", "kept")
    clashing = plain.select("*", *[F.lit("x").alias(c) for c in ("unit", "same", "group", "node", "weight", "list", "cell", "n_links", "component_id", "kept")])
    assert rows(vectors.near_duplicates(clashing), *columns) == rows(vectors.near_duplicates(plain), *columns)


def test_batches_and_merged_runs_leave_the_catalog_at_once(spark, tmp_path):
    def known():
        return {t.name for t in spark.catalog.listTables() if t.name.startswith("genescreen_lines_")}

    before = known()
    runs = line_dedup.LineRuns(spark, str(tmp_path / "runs"), buckets=2, fan_in=2)
    for step in range(4):
        new, old = runs.add(spark.createDataFrame([(bytes([step, k]), step, step) for k in range(5)] + [(b"same", step, step)], "key binary, first_doc long, last_doc long"))
        assert known() - before == {name for level in runs.levels for name in level}
        assert new.count() == 5 + (step == 0) and old.count() == (step > 0)  # what was read before can still be run
    runs.close()
    assert known() == before


def test_a_worker_keeps_nothing_of_a_task(spark):
    path, batch = packing.default_tokenizer(), pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["Some words here", "and there"]})
    for found in common.text_pieces(iter([batch, batch])):
        packing.encode(found[1], path, np.array([2], "<u4"))
        assert packing.tokenizer(path)[3]
    assert not packing.tokenizer(path)[3]
    for _, texts in common.doc_batches(iter([batch, batch])):
        simhash.shingles(texts[0], 2)
        assert decontaminate._KNOWN
    assert not decontaminate._KNOWN


#: Prints how many MB a process gains by packing 12 MB of text, whose words are mostly rare: at most, and once that is done.
GAIN = r"""
import re, sys, threading, time
import numpy as np, pyarrow as pa
from genescreen.llm import common, packing
held = lambda: sum(map(int, re.findall(r"\nAnonymous:\s+(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024
path, end, most, done = packing.default_tokenizer(), np.array([2], "<u4"), [0], threading.Event()
rng = np.random.default_rng(1)
words = np.array([f"w{k:x}" for k in range(200_000)])
batches = [pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": [" ".join(words[rng.integers(0, 200_000, 650)]) for _ in range(1000)]}) for _ in range(3)]
packing.tokenizer(path)
common.pa.default_memory_pool().release_unused()
before = held()
def watch():
    while not done.wait(0.02):
        most[0] = max(most[0], held() - before)
threading.Thread(target=watch, daemon=True).start()
for part, texts in common.text_pieces(iter(batches), getattr(packing, "PIECE", 1 << 24)):
    packing.encode(texts, path, end)
done.set()
print(round(most[0]), round(held() - before))
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_packing_gives_memory_back():
    gained, left = map(int, subprocess.run([sys.executable, "-c", GAIN], check=True, capture_output=True, text=True).stdout.split())
    assert gained < 230 and left < 60
