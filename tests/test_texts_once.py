"""Texts that are made by an expression are evaluated once a row, and a funnel reads each of its inputs once."""

from genescreen.functions.sequences import count_of
from genescreen.operators import blocks as B
from genescreen.plans.adapters import Entities
from genescreen.plans.funnel import Inputs, Thresholds, run_funnel
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
FOLD = "regexp_replace(coalesce(text"  # what the entities' letters are made by


def folds(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count(FOLD)


def test_blocks_are_folded_once(spark):
    blocks = Entities(spark, SF).blocks
    assert folds(B.count_mutations(blocks, signs=B.sign_kinds())) == folds(B.block_signs(blocks)) == 1


def test_counts_are_those_of_patterns(spark):
    texts = spark.createDataFrame([("a*:X[b:X[!",), ("",), (None,), ("*é*!!",), (":X[:X[",), (":X:X[[",)], "text string")
    for sign, pattern in (("*", r"\*"), ("!", "!"), (":X[", r":X\[")):
        rows = texts.select(count_of(F.col("text"), sign), F.regexp_count("text", F.lit(pattern)).cast("long")).collect()
        assert [r[0] for r in rows] == [r[1] for r in rows]


def test_alignments_are_measured_once(spark):
    # two: the entity itself drops texts of under two letters by a filter over its letters
    alignments, single = Entities(spark, SF).alignments, spark.createDataFrame([("T1",)], "tid string")
    assert folds(B.measured(alignments)) == folds(B.low_identity_flanks(alignments, single)) == folds(B.end_mutation(alignments)) == 2


def test_the_funnel_takes_each_text_once(spark):
    seen = {name: spark.sparkContext.accumulator(0) for name in ("text", "qseq", "length")}

    def counted(df, column):
        seen_of = seen[column]

        def take(x):
            seen_of.add(1)
            return x

        return df.withColumn(column, F.udf(take, dict(df.dtypes)[column])(column))

    ids = [f"T{k}.1" for k in range(40)]
    blocks = spark.createDataFrame([(k, f"Query protein: {t}\nAC{'*' * (k % 3)}DE!   FG", True) for k, t in enumerate(ids)], "line_no long, text string, terminated boolean")
    proteins = spark.createDataFrame([(t, f"G{k}", f"S{k}", 20) for k, t in enumerate(ids)], "tid string, gene_id string, gene_symbol string, length long")
    alignments = spark.createDataFrame([(t, "ACDEFGHIKL", "ACDXFGHIKL") for t in ids], "tid string, qseq string, tseq string")
    hits = Entities(spark, SF).hits.limit(10)
    inputs = Inputs(counted(blocks, "text"), counted(proteins, "length"), hits, counted(alignments, "qseq"), spark.createDataFrame([], "key string, text string"), spark.createDataFrame([(ids[0],)], "tid string"))
    assert run_funnel(inputs, Thresholds(id_rule="documented")).count() == 40
    assert {name: n.value for name, n in seen.items()} == dict.fromkeys(seen, 40)


def test_aligned_blocks_are_folded_once(spark):
    # two: the entity itself drops texts of under two letters by a filter over its letters
    blocks = Entities(spark, SF).aligned_blocks.select("line_no", "text", "terminated")
    assert folds(B.extract_alignment(blocks)) == folds(B.extract_alignment(blocks, "report")) == 2


def test_parsed_blocks_are_folded_once_and_stay_where_they_are(spark):
    blocks = Entities(spark, SF).aligned_blocks.select("line_no", "text", "terminated")
    rows = B.mutation_positions(B.parse_blocks(blocks))
    assert folds(rows) == 2 and "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_a_block_is_parsed_once_whatever_its_line_no(spark):
    text = lambda tid, t: f"Query protein: {tid}.1\n{tid} 1 ABCDEF 6\n\n{t}\n"
    blocks = spark.createDataFrame([(1, text("A", "A*C!E*")), (1, text("B", "é!C**F") + ":X["), (None, text("C", "!BCDEF"))], "line_no long, text string")
    found = B.mutation_positions(B.parse_blocks(blocks)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, [
        ("A.1", 0, 2, "stop"), ("A.1", 1, 6, "stop"), ("A.1", 2, 4, "frameshift"),
        ("B.1", 0, 4, "stop"), ("B.1", 1, 5, "stop"), ("B.1", 2, 2, "frameshift"), ("B.1", 3, None, "splice_stop"), ("C.1", 0, 1, "frameshift"),
    ]))
