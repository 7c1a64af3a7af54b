import random

from genescreen.functions import sequences as X
from genescreen.operators import blocks as B
from genescreen.operators import evaluate as V
from genescreen.operators import hits as H
from genescreen.operators import report as R
from genescreen.operators import select as S
from genescreen.plans.funnel import Inputs, Thresholds, run_funnel
from genescreen.sources import readers as rd
from pyspark.sql import functions as F

#: Made up: a stop, a shift, both kinds, and no end mark; what is aligned stands one line below, where no reader of pairs looks.
MOCK = """Query protein: TX10.2
Score 31.25 bits

TX10  1  WYRNDCEQGH  10
genome  1  WYRNDCEQGH  10

TX10  11  LKMFPST  17
genome  11  LKM*PST  17

//
Query protein: TX11.1
Score 77.0 bits

TX11  1  GGAVLIPFYW  10
genome  1  GGAV!IPFYW  10

//
Query protein: TX12.7
Score 50.5 bits

TX12  1  NQDEKRHSTCM  11
genome  1  NQ!EKR!ST*M  11
"""


def blocks_of(spark, tmp_path, delimiter="anywhere", text=MOCK):
    path = tmp_path / "mock.txt"
    path.write_text(text)
    return rd.read_prediction_blocks(spark, str(path), delimiter)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_mock_blocks(spark, tmp_path):
    blocks = blocks_of(spark, tmp_path)
    assert rows(B.count_mutations(blocks), "tid", "stop", "shift") == [("TX10.2", 1, 0), ("TX11.1", 0, 1), ("TX12.7", 1, 2)]
    assert [r[1] for r in rows(B.parse_score(blocks), "tid", "score")] == [31.25, 77.0, 50.5]
    summary = R.report_summary(B.parse_blocks(blocks)).first()
    assert (summary.total, summary.with_stops, summary.with_frameshifts, summary.with_both, summary.total_stops, summary.total_frameshifts) == (3, 2, 2, 1, 2, 3)
    assert abs(summary.average_score - 158.75 / 3) < 1e-9
    assert [r[1] for r in rows(R.histogram(B.parse_score(blocks), "score"), "bin", "n")] == [1, 0, 0, 0, 1, 0, 0, 0, 0, 1]
    assert rows(R.mutation_frequencies(B.count_mutations(blocks)), "count", "n_stop", "n_shift") == [(0, 1, 1), (1, 2, 1), (2, 0, 1)]
    assert rows(B.parse_blocks(blocks), "identity", "length") == [(0.0, 0)] * 3


def test_mock_alignments(spark, tmp_path):
    blocks = blocks_of(spark, tmp_path, "line")
    assert sorted(r.terminated for r in blocks.collect()) == [False, True, True]
    assert rows(B.extract_alignment(blocks), "tid", "qseq", "tseq") == [("TX10.2", "WYRNDCEQGHLKMFPST", ""), ("TX11.1", "GGAVLIPFYW", "")]


def test_block_inside_a_line(spark, tmp_path):
    text = "Query protein: A.1\n* // Query protein: B.1\n!\n//\n"
    assert rows(B.count_mutations(blocks_of(spark, tmp_path, text=text)), "tid", "stop", "shift") == [("A.1", 1, 0), ("B.1", 0, 1)]
    assert rows(B.count_mutations(blocks_of(spark, tmp_path, "line", text)), "tid", "stop", "shift") == [("A.1", 1, 1)]


def test_block_dir(spark, tmp_path):
    (tmp_path / "b.gw.txt").write_text("Query protein: B.1\n*\n//\n")
    (tmp_path / "a.gw.txt").write_text("Query protein: A.1\n!")
    (tmp_path / "empty.gw.txt").write_text("")
    (tmp_path / "other.txt").write_text("Query protein: C.1\n!")
    found = rd.read_block_dir(spark, str(tmp_path))
    assert [r.tid for r in B.count_mutations(found).orderBy("line_no").collect()] == ["A.1", "B.1"]


def test_ending_rules_of_ids(spark):
    text = "Query protein: T1\n>T1.sp.tr\nMK*AA\n"
    texts = [text, text.replace("T1", "T"), text.replace(": T1", ": Z9"), "Query protein: T2\n>T.sp.tr\nMK*AA\n", ">T.sp.tr\nMK*AA\n"]
    blocks = spark.createDataFrame([(x, True, k) for k, x in enumerate(texts)], "text string, terminated boolean, line_no long")
    single = spark.createDataFrame([("T1",), ("T",), ("Z9",), ("T2",)], "tid string")
    for rule in (B.ending_stop, B.ending_shift):
        assert rows(rule(blocks, single), "tid") == [("T",)]
        assert rows(rule(blocks, single, id_rule="documented"), "tid") == [("T",), ("T1",)]


def test_last_excluded_biotype_counts(spark):
    genes = spark.createDataFrame([("t", "g", "s")], "tid string, gene_id string, gene_symbol string")
    types = spark.createDataFrame([("t", "Pseudogene", "x", 1), ("t", "x", "lncRNA", 2), ("t", "x", "y", 3)], "tid string, gene_biotype string, transcript_biotype string, line_no long")
    none = [spark.createDataFrame([], x) for x in ("key string, text string", "tid string")]
    found = S.intronless_or_biotype(genes, none[0], types, none[1], ["zzz"], ["pseudogene", "lncrna"])
    assert rows(found, "tid", "matched_pattern", "source") == [("t", "transcript_biotype:lncRNA", "biotype")]


def test_mutation_at_the_start_has_low_flank(spark):
    pair = spark.createDataFrame([("a", "QKLM", "!KLM")], "tid string, qseq string, tseq string")
    assert rows(B.with_flank_identities(pair), "mut_pos", "mut_type", "flank_before", "flank_after") == [(0, "shift", 0.0, 1.0)]


def test_identities(spark):
    df = spark.createDataFrame([("ABCD", "ABXDE"), ("", "A"), ("AB", ""), (None, "A")], "q string, t string")
    got = [tuple(r) for r in df.select(X.positional_identity(F.col("q"), F.col("t")), X.report_identity(F.col("q"), F.col("t"))).collect()]
    assert got == [(0.75, 75.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_patterns_split_and_match(spark):
    assert S.split_patterns("a|b,c") == ["a", "b,c"] and S.split_patterns("a,b") == ["a", "b"]
    genes = spark.createDataFrame([("t1", "g1", "ORC1"), ("t2", "g2", "x"), ("t3", "g3", "y")], "tid string, gene_id string, gene_symbol string")
    texts = spark.createDataFrame([("g2", ""), ("x", "olfactory receptor"), ("y", "Olfactory receptor 3")], "key string, text string")
    assert rows(S.match_patterns(genes, ["olfactory receptor", "^OR"], texts), "tid", "matched_pattern", "source") == [("t1", "^OR", "gene_symbol"), ("t3", "olfactory receptor", "description")]


def test_whitelist_stays_out_of_an_empty_list(spark):
    none, listed = spark.createDataFrame([], "tid string"), spark.createDataFrame([("w",)], "tid string")
    assert rows(S.merge_whitelist(none, listed), "tid") == []
    assert rows(S.merge_whitelist(none, listed, False), "tid") == [("w",)]


def test_funnel_with_a_list_that_runs_empty(spark):
    blocks = spark.createDataFrame([("Query protein: A\n*\n", True, 1), ("Query protein: B\n*\n", True, 2)], "text string, terminated boolean, line_no long")
    proteins = spark.createDataFrame([("A", "g", "OR1", 9), ("B", "h", "OR2", 9)], "tid string, gene_id string, gene_symbol string, length int")
    hits = spark.createDataFrame([], "qname string, qlen long, qstart long, qend long, tname string, tstart long, tend long, nmatch long, alen long, mapq long")
    pairs, texts = spark.createDataFrame([], "tid string, qseq string, tseq string"), spark.createDataFrame([], "key string, text string")
    for listed, want in (([("B",)], []), ([("W",)], ["W"])):
        found = run_funnel(Inputs(blocks, proteins, hits, pairs, texts, spark.createDataFrame(listed, "tid string")), Thresholds(global_quality=False))
        assert [r.tid for r in found.where("high_confidence").collect()] == want


def hit(spark, spans, contig="c"):
    data = [("q", 100, qs, qe, "+", contig, 10**6, s, e, 90, 100, 60, k) for k, (s, e, qs, qe) in enumerate(spans)]
    return spark.createDataFrame(data, "qname string, qlen long, qstart long, qend long, strand string, tname string, tlen long, tstart long, tend long, nmatch long, alen long, mapq long, n long")


def test_gap_is_inclusive_and_touching_intervals_merge(spark):
    loci = H.locus_clusters(hit(spark, [(0, 100, 0, 40), (10_100, 10_200, 40, 80), (20_201, 20_300, 0, 90)]))
    assert rows(loci, "tstart", "locus") == [(0, 1), (10_100, 1), (20_201, 2)]
    assert rows(H.merged_query_coverage(loci), "locus", "cov") == [(1, 0.8), (2, 0.9)]


def test_coverage_and_multiplicity_equal_loops(spark):
    rng = random.Random(5)
    spans = [(s := rng.randrange(2000), s + rng.randrange(1, 300), q := rng.randrange(60), q + rng.randrange(31, 40)) for _ in range(60)]
    got = rows(H.merged_query_coverage(H.locus_clusters(hit(spark, spans), 30)), "locus", "cov")
    ordered, reach, locus, places = sorted(spans), None, 0, {}
    for s, e, qs, qe in ordered:
        if reach is None or s > reach + 30:
            locus += 1
        reach = e if reach is None else max(reach, e)
        places.setdefault(locus, set()).update(range(qs, qe))
    assert got == [(k, len(v) / 100) for k, v in sorted(places.items())]
    n, last = 0, None
    for s, e in sorted(x[:2] for x in spans):
        if last is None or max(0, min(e, last[1]) - max(s, last[0])) / max(1, min(e - s, last[1] - last[0])) < 0.5:
            n, last = n + 1, [s, e]
        else:
            last[1] = max(e, last[1])
    assert H.hit_multiplicity(hit(spark, spans), ["n"]).first().hit_count == n


def test_first_of_equal_hits_is_best(spark):
    hits = hit(spark, [(5, 105, 0, 50), (0, 100, 0, 50)])
    assert H.best_hit(hits, ["n"]).first().tstart == 5


def test_grid_of_nothing(spark):
    features = spark.createDataFrame([], "tid string, in_ref boolean, stop int, shift int, total int, align_len int, protein_len int, coverage double, identity double, multi boolean")
    found = V.threshold_suggestions(features).collect()
    assert len(found) == 120 and all(r.score == 0 for r in found)


def test_readers_skip_what_is_short(spark, tmp_path):
    paf = tmp_path / "x.paf"
    paf.write_text("q\t1\n\n" + "\t".join(["q", "10", "0", "5", "+", "c", "99", "1", "6", "4", "5", "60", "tag"]) + "\n")
    assert rd.read_paf(spark, str(paf)).count() == 1
    ids = tmp_path / "ids.txt"
    ids.write_text(" a b\n\na b\nc\td\n")
    assert rows(rd.read_id_list(spark, str(ids)), "tid") == [("a b",), ("c\td",)]
    assert rows(rd.read_id_list(spark, str(ids), "first_token"), "tid") == [("a",), ("c",)]
    pairs = tmp_path / "pairs.txt"
    pairs.write_text(">a\nQQ\nTT\n>b\nQQ\n\n>a\nQX\n\nTX\n")
    assert rows(rd.read_alignment_pairs(spark, str(pairs)), "tid", "qseq", "tseq") == [("a", "QX", "TX")]


def test_fasta_lines_of_any_characters(spark, tmp_path):
    path = tmp_path / "x.fa"
    path.write_text(">a one\n 00 \n111\n\n222\n>b\nACG\n")
    assert rows(rd.read_fasta(spark, str(path)), "id", "header", "seq", "length") == [("a", "a one", "00111222", 8), ("b", "b", "ACG", 3)]


def test_islands_of_hits_are_folded_apart(spark):
    spans = [(0, 100, 0, 50), (50, 120, 0, 50), (120, 200, 0, 50), (130, 190, 0, 50), (300, 400, 0, 50)]
    assert H.hit_multiplicity(hit(spark, spans), ["n"]).first().hit_count == 3
