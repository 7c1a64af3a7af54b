"""Registered queries over the adapted tables, each with the DuckDB SQL that says the same in another way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genescreen.functions import sequences as X
from genescreen.operators import blocks as B
from genescreen.operators import evaluate as V
from genescreen.operators import hits as H
from genescreen.operators import quality as Q
from genescreen.operators import regions as G
from genescreen.operators import report as R
from genescreen.operators import select as S
from genescreen.plans.adapters import Entities, oracle
from genescreen.plans.funnel import Inputs, Thresholds, run_funnel
from genescreen.sources import readers as rd
from genescreen.sources import sinks as sk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ORDER = ["o1", "o2", "o3", "o4", "o5"]
FAMILY = ["widget", "^PROMO", "plate", "brand#1"]


def plain(df: DataFrame) -> DataFrame:
    """Integers as long, so that both engines agree on types."""
    return df.select(*[F.col(c).cast("long").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes])


def query(name: str, sql: str, *entities: str):
    """Register a function of Entities under a name, with its oracle over the entities that it names."""

    def register(f: Callable[[Entities], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: plain(f(Entities(spark, sf_dir)))
        ORACLES[name] = oracle(sql, *entities)
        return f

    return register


# pieces of oracle SQL that several queries share

_PASSING = "passing AS (SELECT *, (qend - qstart) / qlen AS qcov, nmatch / alen AS ident FROM hits WHERE alen >= 30 AND mapq >= 0 AND (qend - qstart) / qlen >= 0.3 AND nmatch / alen >= 0.3)"
_LOCI = f""", {_PASSING},
reach AS (SELECT *, max(tend) OVER (PARTITION BY qname, tname ORDER BY tstart, tend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM passing),
loci AS (SELECT *, CAST(sum(CASE WHEN far IS NULL OR tstart > far + 10000 THEN 1 ELSE 0 END) OVER (PARTITION BY qname, tname ORDER BY tstart, tend ROWS UNBOUNDED PRECEDING) AS BIGINT) AS locus FROM reach)"""
_COVERED = f"""{_LOCI},
inner_reach AS (SELECT *, max(qend) OVER (PARTITION BY qname, tname, locus ORDER BY qstart, qend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS q_far FROM loci),
islands AS (SELECT *, sum(CASE WHEN q_far IS NULL OR qstart > q_far THEN 1 ELSE 0 END) OVER (PARTITION BY qname, tname, locus ORDER BY qstart, qend ROWS UNBOUNDED PRECEDING) AS island FROM inner_reach),
merged AS (SELECT qname, tname, locus, island, max(qend) - min(qstart) AS size, count(*) AS n, max(qlen) AS qlen FROM islands GROUP BY ALL),
covered AS (SELECT qname, tname, locus, sum(size) / max(qlen) AS cov, max(qlen) AS qlen, CAST(sum(n) AS BIGINT) AS n_hits FROM merged GROUP BY ALL)"""
_SAME = "len(list_filter(list_zip(string_split(qseq, ''), string_split(tseq, '')), lambda x: x[1] = x[2]))"
_IDENT = f"CASE WHEN least(length(qseq), length(tseq)) > 0 THEN {_SAME} / least(length(qseq), length(tseq)) ELSE 0.0 END"
_COUNTS = r""", counts AS (SELECT line_no, regexp_extract(text, 'Query protein:\s+(\S+)', 1) AS tid,
  CASE WHEN contains(text, '*') THEN length(text) - length(replace(text, '*', '')) ELSE (length(text) - length(replace(text, ':X[', ''))) // 3 END AS stop,
  length(text) - length(replace(text, '!', '')) AS shift FROM blocks)"""
_LOADS = f"{_COUNTS}, loads AS (SELECT DISTINCT tid, 'putative' AS load FROM counts WHERE stop + shift >= 1 UNION SELECT DISTINCT tid, 'single' FROM counts WHERE stop + shift = 1 UNION SELECT DISTINCT tid, 'multi' FROM counts WHERE stop + shift >= 2)"
_MET = f""", metrics AS (SELECT a.tid, least(length(qseq), length(tseq)) AS align_len, coalesce(p.length, 0) AS protein_len,
  CASE WHEN coalesce(p.length, 0) > 0 THEN least(length(qseq), length(tseq)) / p.length ELSE 0.0 END AS coverage, {_IDENT} AS identity FROM alignments a LEFT JOIN proteins p USING (tid))"""
_MUT = """, mut AS (SELECT tid, doc_id, qseq, tseq, CASE WHEN instr(tseq, 'X') > 0 AND (instr(tseq, '!') = 0 OR instr(tseq, 'X') < instr(tseq, '!')) THEN instr(tseq, 'X') - 1
  WHEN instr(tseq, '!') > 0 THEN instr(tseq, '!') - 1 END AS mut_pos FROM alignments),
typed AS (SELECT *, CASE substr(tseq, mut_pos + 1, 1) WHEN 'X' THEN 'stop' WHEN '!' THEN 'shift' END AS mut_type FROM mut),
cut AS (SELECT *, substr(qseq, greatest(mut_pos - 30, 0) + 1, least(mut_pos, 30)) AS qb, substr(tseq, greatest(mut_pos - 30, 0) + 1, least(mut_pos, 30)) AS tb, substr(qseq, mut_pos + 2, 30) AS qa, substr(tseq, mut_pos + 2, 30) AS ta FROM typed WHERE mut_pos IS NOT NULL),
flanks AS (SELECT *,
  CASE WHEN least(length(qb), length(tb)) > 0 THEN len(list_filter(range(1, least(length(qb), length(tb)) + 1), lambda i: substr(qb, i, 1) = substr(tb, i, 1))) / least(length(qb), length(tb)) ELSE 0.0 END AS flank_before,
  CASE WHEN least(length(qa), length(ta)) > 0 THEN len(list_filter(range(1, least(length(qa), length(ta)) + 1), lambda i: substr(qa, i, 1) = substr(ta, i, 1))) / least(length(qa), length(ta)) ELSE 0.0 END AS flank_after FROM cut)"""
_BEST = ", best AS (SELECT * FROM (SELECT qname AS gene, strand, tname, tstart, tend, tlen, alen, mapq, row_number() OVER (PARTITION BY qname ORDER BY alen DESC, o1, o2, o3, o4, o5) AS n FROM hits WHERE alen >= 30 AND mapq >= 0) WHERE n = 1)"


def _find(column: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p}', 'i') THEN '{p}'" for p in FAMILY) + " END"


_FAMILY = f""", named AS (SELECT g.tid, g.gene_id, g.gene_symbol, CASE WHEN i.key IS NOT NULL THEN i.text ELSE s.text END AS text FROM genes g LEFT JOIN descriptions i ON i.key = g.gene_id LEFT JOIN descriptions s ON s.key = g.gene_symbol),
family AS (SELECT tid, gene_id, gene_symbol, coalesce({_find('gene_symbol')}, {_find('gene_id')}, {_find('text')}) AS matched_pattern,
  CASE WHEN {_find('gene_symbol')} IS NOT NULL THEN 'gene_symbol' WHEN {_find('gene_id')} IS NOT NULL THEN 'gene_id' ELSE 'description' END AS source FROM named WHERE coalesce({_find('gene_symbol')}, {_find('gene_id')}, {_find('text')}) IS NOT NULL)"""


# sources and sinks: an entity is written as text, read back, and must be what it was


def _lines(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.concat_ws("\t", *columns).alias("value"))


@query("src1_snk1_fasta", "SELECT tid || ' gene=' || gene_id || ' gene_symbol=' || gene_symbol AS header, tid AS id, seq, length FROM proteins", "proteins")
def _(e: Entities) -> DataFrame:
    path = sk.write_fasta(e.proteins.select(F.concat("tid", F.lit(" gene="), "gene_id", F.lit(" gene_symbol="), "gene_symbol").alias("header"), "seq"), sk.scratch_path(e.spark, "fasta"))
    return rd.read_fasta(e.spark, path).drop("line_no")


@query("src2_paf", "SELECT qname, qlen, qstart, qend, strand, tname, tlen, tstart, tend, nmatch, alen, mapq FROM hits", "hits")
def _(e: Entities) -> DataFrame:
    columns = [c for c, _ in rd.HIT_COLUMNS]
    path = sk.write_lines(_lines(e.hits.withColumn("tag", F.lit("cg:Z:1M")), *columns, "tag"), sk.scratch_path(e.spark, "paf"))
    return rd.read_paf(e.spark, path).select(*columns)


@query("src3_blocks_anywhere", "SELECT trim(text, chr(10)) AS text FROM blocks", "blocks")
def _(e: Entities) -> DataFrame:
    path = sk.write_lines(e.blocks.select(F.concat("text", F.lit("\n//")).alias("value")), sk.scratch_path(e.spark, "blocks"))
    return rd.read_prediction_blocks(e.spark, path).select(F.trim("text", F.lit("\n")).alias("text"))


@query("src3_blocks_by_line", "SELECT trim(text, chr(10)) AS text, true AS terminated FROM blocks", "blocks")
def _(e: Entities) -> DataFrame:
    path = sk.write_lines(e.blocks.select(F.concat("text", F.lit("\n//")).alias("value")), sk.scratch_path(e.spark, "blocks"))
    return rd.read_prediction_blocks(e.spark, path, "line").select(F.trim("text", F.lit("\n")).alias("text"), "terminated")


@query("src4_block_dir", "SELECT trim(text, chr(10)) AS text FROM blocks", "blocks")
def _(e: Entities) -> DataFrame:
    path = sk.write_lines(e.blocks.select(F.concat("text", F.lit("\n//")).alias("value")), sk.scratch_path(e.spark, "blocks"))
    return rd.read_block_dir(e.spark, path, "*.txt").select(F.trim("text", F.lit("\n")).alias("text"))


@query("src5_snk3_id_list", "SELECT DISTINCT tid FROM (SELECT tid FROM truth UNION ALL SELECT tid FROM whitelist)", "truth", "whitelist")
def _(e: Entities) -> DataFrame:
    path = sk.write_id_list(e.truth.unionByName(e.whitelist), sk.scratch_path(e.spark, "ids"))
    return rd.read_id_list(e.spark, path)


@query("src5_id_list_first_tab", "SELECT DISTINCT tid FROM truth", "truth")
def _(e: Entities) -> DataFrame:
    path = sk.write_lines(e.truth.select(F.concat("tid", F.lit("\tmore of the line")).alias("value")), sk.scratch_path(e.spark, "ids"))
    return rd.read_id_list(e.spark, path, "first_tab")


@query("src6_alignment_pairs", "SELECT tid, qseq, tseq FROM alignments WHERE tseq <> '' AND qseq <> ''", "alignments")
def _(e: Entities) -> DataFrame:
    path = sk.write_lines(e.alignments.select(F.concat(F.lit(">"), "tid", F.lit("\n"), "qseq", F.lit("\n"), "tseq").alias("value")), sk.scratch_path(e.spark, "pairs"))
    return rd.read_alignment_pairs(e.spark, path)


@query("src7_mutation_counts", "SELECT tid, CAST(max_by(stop, line_no) AS BIGINT) AS stop, CAST(max_by(shift, line_no) AS BIGINT) AS shift, CAST(max_by(stop, line_no) + max_by(shift, line_no) AS BIGINT) AS total FROM counts GROUP BY tid".join((_COUNTS + " ", "")), "blocks")
def _(e: Entities) -> DataFrame:
    rows = B.count_mutations(e.blocks).orderBy("line_no")
    return rd.read_mutation_counts(e.spark, sk.write_lines(_lines(rows.select("tid", F.col("stop").cast("string").alias("stop"), F.col("shift").cast("string").alias("shift")), "tid", "stop", "shift"), sk.scratch_path(e.spark, "counts")))


@query("src8_descriptions", "SELECT key, text || chr(9) || 'x' AS text FROM descriptions", "descriptions")
def _(e: Entities) -> DataFrame:
    return rd.read_descriptions(e.spark, sk.write_lines(_lines(e.descriptions.withColumn("more", F.lit("x")), "key", "text", "more"), sk.scratch_path(e.spark, "descriptions")))


@query("src8_biotypes", "SELECT gene_id, tid, gene_biotype, transcript_biotype FROM biotypes", "biotypes")
def _(e: Entities) -> DataFrame:
    columns = ("gene_id", "tid", "gene_biotype", "transcript_biotype")
    return rd.read_biotypes(e.spark, sk.write_lines(_lines(e.biotypes, *columns), sk.scratch_path(e.spark, "biotypes"))).select(*columns)


@query("src8_synteny", "SELECT gid, chr, start, stop FROM synteny", "synteny")
def _(e: Entities) -> DataFrame:
    return rd.read_synteny(e.spark, sk.write_lines(_lines(e.synteny.withColumns({c: F.col(c).cast("string") for c in ("start", "stop")}), "gid", "chr", "stop", "start"), sk.scratch_path(e.spark, "synteny")))


@query("src9_gtf_exons", "SELECT tid FROM exons", "exons")
def _(e: Entities) -> DataFrame:
    line = F.concat(F.lit("chr1\tx\texon\t1\t2\t.\t+\t.\tgene_id \"g\"; transcript_id \""), "tid", F.lit('";'))
    return rd.read_gtf_exons(e.spark, sk.write_lines(e.exons.select(line.alias("value")), sk.scratch_path(e.spark, "gtf")))


@query("snk2_report", "SELECT query, format('{:.4f}', round(best_cov, 10)) AS best_cov, CAST(full_copy_count AS VARCHAR) AS full_copy_count FROM (SELECT p.qname AS query, max(p.qcov) AS best_cov, any_value(c.n) AS full_copy_count FROM passing p JOIN (SELECT qname, count(*) FILTER (WHERE cov >= 0.8) AS n FROM covered GROUP BY qname) c USING (qname) GROUP BY p.qname)".join((_COVERED + " ", "")), "hits")
def _(e: Entities) -> DataFrame:
    rows = H.functional_redundancy(e.hits).select("query", F.round("best_cov", 10).alias("best_cov"), "full_copy_count")
    return e.spark.read.csv(sk.write_report(rows, sk.scratch_path(e.spark, "report")), sep="\t", header=True)


# projections, filters and scalar functions


@query("prj1_protein_header", "SELECT tid, gene_id, gene_symbol FROM proteins", "proteins")
def _(e: Entities) -> DataFrame:
    header = F.concat("tid", F.lit(" gene="), "gene_id", F.lit(" gene_symbol="), "gene_symbol")
    return e.proteins.select("tid", X.header_token(header, "gene").alias("gene_id"), X.header_token(header, "gene_symbol").alias("gene_symbol"))


@query("prj2_ensembl_header", "SELECT gene, enst, gene_symbol FROM cds", "cds")
def _(e: Entities) -> DataFrame:
    header = F.concat("enst", F.lit(" cds gene:"), "gene", F.lit(" transcript:"), "enst", F.when(F.col("gene_symbol") != "", F.concat(F.lit(" gene_symbol:"), "gene_symbol")).otherwise(F.lit("")))
    return e.cds.select(X.tagged_id(header, "gene", "ENSG").alias("gene"), X.tagged_id(header, "transcript", "ENST").alias("enst"), X.tagged_id(header, "gene_symbol", "").alias("gene_symbol"))


@query("prj3_hit_metrics", "SELECT qname, o1, o2, (qend - qstart) / qlen AS qcov, nmatch / alen AS ident FROM hits WHERE alen > 0 AND qlen > 0", "hits")
def _(e: Entities) -> DataFrame:
    return H.hit_metrics(e.hits).select("qname", "o1", "o2", "qcov", "ident")


@query("fil1_filter_hits", f", {_PASSING} SELECT qname, tname, tstart, tend, qcov, ident FROM passing", "hits")
def _(e: Entities) -> DataFrame:
    return H.filter_hits(e.hits).select("qname", "tname", "tstart", "tend", "qcov", "ident")


@query("prj4_fil2_regions", f"{_BEST} SELECT gene, strand, tname, greatest(0, tstart - 1000) + 1 AS start1, least(tlen, tend + 1000) AS end1, gene AS safe_id FROM best WHERE least(tlen, tend + 1000) >= greatest(0, tstart - 1000) + 1", "hits")
def _(e: Entities) -> DataFrame:
    return H.region_jobs(H.add_flanks(H.best_hit(e.hits, ORDER)))[0]


@query("fil2_skipped_regions", f"{_BEST} SELECT gene, tname, tstart + 1 AS start1, tstart - 5 + alen % 10 AS end1, 'invalid_region' AS reason FROM best WHERE tstart - 5 + alen % 10 < tstart + 1", "hits")
def _(e: Entities) -> DataFrame:
    return H.region_jobs(H.best_hit(e.hits, ORDER).withColumn("tend", F.col("tstart") - 5 + F.col("alen") % 10))[1]


@query("prj5_safe_id", "SELECT DISTINCT regexp_replace(name || '/' || gene_symbol, '[^A-Za-z0-9_.-]', '_', 'g') AS safe_id, name || '/' || gene_symbol AS id FROM genes", "genes")
def _(e: Entities) -> DataFrame:
    return H.safe_id(e.genes.select(F.concat_ws("/", "name", "gene_symbol").alias("id")), "id").distinct()


@query("prj6_count_mutations", f"{_COUNTS} SELECT tid, CAST(stop AS BIGINT) AS stop, CAST(shift AS BIGINT) AS shift, line_no FROM counts", "blocks")
def _(e: Entities) -> DataFrame:
    return B.count_mutations(e.blocks)


@query("prj7_score", r"SELECT regexp_extract(text, 'Query protein:\s+(\S+)', 1) AS tid, CAST(regexp_extract(text, 'Score\s+([0-9.]+)\s+bits', 1) AS DOUBLE) AS score, line_no FROM blocks", "blocks")
def _(e: Entities) -> DataFrame:
    return B.parse_score(e.blocks)


@query("fil3_mutation_load", f"{_LOADS} SELECT tid, load FROM loads", "blocks")
def _(e: Entities) -> DataFrame:
    return B.classify_mutation_load(B.count_mutations(e.blocks))


@query("prj8_extract_alignment", r"SELECT tid, q AS qseq, regexp_replace(t1 || t2 || CASE WHEN spliced THEN 'X' ELSE '' END, '[^A-Z!]', '', 'g') AS tseq, line_no FROM aligned_blocks", "aligned_blocks")
def _(e: Entities) -> DataFrame:
    return B.extract_alignment(e.aligned_blocks.select("line_no", "text", "terminated"))


@query("prj8_extract_alignment_report", r"SELECT tid, q AS qseq, t1 || t2 || CASE WHEN spliced THEN 'X' ELSE '' END AS tseq, line_no FROM aligned_blocks", "aligned_blocks")
def _(e: Entities) -> DataFrame:
    return B.extract_alignment(e.aligned_blocks.select("line_no", "text", "terminated"), "report")


@query("prj9_positional_identity", f"SELECT tid, {_IDENT} AS identity FROM alignments", "alignments")
def _(e: Entities) -> DataFrame:
    return e.alignments.select("tid", X.positional_identity(F.col("qseq"), F.col("tseq")).alias("identity"))


@query("prj10_report_identity", f"SELECT tid, round(CASE WHEN length(qseq) > 0 AND length(tseq) > 0 THEN 100.0 * {_SAME} / length(qseq) ELSE 0.0 END, 6) AS identity FROM alignments", "alignments")
def _(e: Entities) -> DataFrame:
    return e.alignments.select("tid", F.round(X.report_identity(F.col("qseq"), F.col("tseq")), 6).alias("identity"))


@query("prj11_alignment_metrics", f"{_MET} SELECT * FROM metrics", "alignments", "proteins")
def _(e: Entities) -> DataFrame:
    return B.alignment_metrics(e.alignments, e.proteins.where("true"))


@query("prj12_first_mutation", f"{_MUT} SELECT tid, mut_pos, mut_type FROM typed", "alignments")
def _(e: Entities) -> DataFrame:
    return B.with_first_mutation(e.alignments).select("tid", "mut_pos", "mut_type")


@query("prj13_flank_identities", f"{_MUT} SELECT tid, mut_pos, flank_before, flank_after FROM flanks", "alignments")
def _(e: Entities) -> DataFrame:
    return B.with_flank_identities(e.alignments).select("tid", "mut_pos", "flank_before", "flank_after")


@query("prj14_mutation_positions", """, pairs AS (SELECT line_no, tid, t1 || t2 || CASE WHEN spliced THEN 'X' ELSE '' END AS t, spliced FROM aligned_blocks),
places AS (SELECT line_no, tid, unnest(string_split(t, '')) AS c, unnest(range(1, length(t) + 1)) AS i FROM pairs WHERE t <> ''),
found AS (SELECT line_no, tid, CASE c WHEN '*' THEN 0 ELSE 1 END AS k, i AS position FROM places WHERE c IN ('*', '!') UNION ALL SELECT line_no, tid, 2, NULL FROM pairs WHERE spliced)
SELECT tid, row_number() OVER (PARTITION BY line_no ORDER BY k, position) - 1 AS ordinal, position, CASE k WHEN 0 THEN 'stop' WHEN 1 THEN 'frameshift' ELSE 'splice_stop' END AS type FROM found""", "aligned_blocks")
def _(e: Entities) -> DataFrame:
    return B.mutation_positions(B.parse_blocks(e.aligned_blocks.select("line_no", "text", "terminated")))


@query("fil4_match_patterns", f"{_FAMILY} SELECT * FROM family", "genes", "descriptions")
def _(e: Entities) -> DataFrame:
    return S.match_patterns(e.genes, FAMILY, e.descriptions)


@query("fil5_search_ids", "SELECT tid FROM proteins WHERE contains(lower(tid), 't12')", "proteins")
def _(e: Entities) -> DataFrame:
    return S.search_ids(e.proteins.select("tid"), "T12")


# predicates of single disruptions

_SINGLE = f"{_LOADS}, single AS (SELECT tid FROM loads WHERE load = 'single'), own AS (SELECT b.text, c.tid FROM blocks b JOIN counts c USING (line_no) WHERE c.tid IN (FROM single))"


def _single(e: Entities) -> DataFrame:
    return B.classify_mutation_load(B.count_mutations(e.blocks)).where("load = 'single'").select("tid")


@query("fp1_splicing_stop", f"{_SINGLE} SELECT DISTINCT tid FROM own WHERE contains(text, ':X[')", "blocks")
def _(e: Entities) -> DataFrame:
    return B.splicing_stop(e.blocks, _single(e))


@query("fp3_splicing_shift", rf"{_SINGLE} SELECT DISTINCT tid FROM own WHERE regexp_matches(text, '![A-Z]\s\s\s|\s\s\s[A-Z]!|!\s\s\s|\s\s\s!')", "blocks")
def _(e: Entities) -> DataFrame:
    return B.splicing_shift(e.blocks, _single(e))


_ENDING = rf"{_SINGLE}, squeezed AS (SELECT regexp_replace(b.text, '\s+', '', 'g') AS s, c.tid FROM blocks b JOIN counts c USING (line_no) WHERE contains(b.text, '.sp.tr') AND c.tid IN (FROM single) AND regexp_extract(b.text, '>(\S+?)\.sp\.tr', 1) = c.tid)"
_ENDED_STOP = "contains(s, '*') AND length(s) - instr(s, '*') BETWEEN 1 AND 119"
_ENDED_SHIFT = "length(string_split(s, 'tr')[-1]) BETWEEN 1 AND 49"


@query("fp2_ending_stop", f"{_ENDING} SELECT DISTINCT tid FROM squeezed WHERE {_ENDED_STOP}", "blocks")
def _(e: Entities) -> DataFrame:
    return B.ending_stop(e.blocks, _single(e), 120, "documented")


# `as_coded` finds queries of one character alone, so it runs over blocks of such; it takes what follows a text's first > for the id
_CODED = (", blocks AS (FROM letter_blocks)" + _ENDING).replace(r"'>(\S+?)\.sp\.tr'", r"'>(\S)'")


def _letters(e: Entities) -> tuple[DataFrame, DataFrame]:
    return e.letter_blocks, B.classify_mutation_load(B.count_mutations(e.letter_blocks)).where("load = 'single'").select("tid")


@query("fp2_ending_stop_as_coded", f"{_CODED} SELECT DISTINCT tid FROM squeezed WHERE {_ENDED_STOP}", "letter_blocks")
def _(e: Entities) -> DataFrame:
    return B.ending_stop(*_letters(e), 120)


@query("fp4_ending_shift_as_coded", f"{_CODED} SELECT DISTINCT tid FROM squeezed WHERE {_ENDED_SHIFT}", "letter_blocks")
def _(e: Entities) -> DataFrame:
    return B.ending_shift(*_letters(e))


@query("fp4_ending_shift", f"{_ENDING} SELECT DISTINCT tid FROM squeezed WHERE {_ENDED_SHIFT}", "blocks")
def _(e: Entities) -> DataFrame:
    return B.ending_shift(e.blocks, _single(e), id_rule="documented")


@query("fp5_low_identity_flanks", f"{_MUT} SELECT tid, mut_type FROM (SELECT *, {_IDENT} AS identity FROM flanks) WHERE tid IN (FROM truth) AND (flank_before < 0.9 OR flank_after < 0.9) AND identity < 0.95", "alignments", "truth")
def _(e: Entities) -> DataFrame:
    return B.low_identity_flanks(e.alignments, e.truth, 30, 0.9, 0.95, "or")


@query("fp6_end_mutation", f"{_MUT} SELECT tid, mut_pos, length(qseq) AS query_len, (mut_pos + 1) / length(qseq) AS fraction FROM typed WHERE mut_pos IS NOT NULL AND (mut_pos + 1) / length(qseq) >= 0.5", "alignments")
def _(e: Entities) -> DataFrame:
    return B.end_mutation(e.alignments, 0.5)


# joins


@query("joi1_keep_listed", "SELECT species, tid FROM candidates WHERE tid IN (FROM truth)", "candidates", "truth")
def _(e: Entities) -> DataFrame:
    return S.keep_listed(e.candidates, e.truth)


@query("joi2_pending_jobs", "SELECT gene, tname, start1, end1 FROM regions WHERE gene NOT IN (SELECT tid FROM truth)", "regions", "truth")
def _(e: Entities) -> DataFrame:
    return S.pending_jobs(e.regions, e.truth.withColumnRenamed("tid", "gene")).select("gene", "tname", "start1", "end1")


@query("joi3_extract_regions", "SELECT r.gene, r.tname, r.start1, r.end1, r.strand, substr(c.seq, r.start1, r.end1 - r.start1 + 1) AS dna, p.seq AS protein FROM regions r JOIN contigs c USING (tname) JOIN proteins p ON p.tid = r.gene WHERE substr(c.seq, r.start1, r.end1 - r.start1 + 1) <> ''", "regions", "contigs", "proteins")
def _(e: Entities) -> DataFrame:
    rows, _ = G.extract_regions(e.regions, G.tile_contigs(e.contigs, 128), e.proteins, 128)
    return rows


@query("joi3_src1_from_fasta", "SELECT r.gene, r.tname, r.start1, r.end1, r.strand, substr(c.seq, r.start1, r.end1 - r.start1 + 1) AS dna, p.seq AS protein FROM regions r JOIN contigs c USING (tname) JOIN proteins p ON p.tid = r.gene WHERE substr(c.seq, r.start1, r.end1 - r.start1 + 1) <> ''", "regions", "contigs", "proteins")
def _(e: Entities) -> DataFrame:
    path = sk.write_fasta(e.contigs.select("tname", F.concat("tname", F.lit(" of documents")).alias("header"), "seq"), sk.scratch_path(e.spark, "fasta"))
    return G.extract_regions(e.regions, rd.read_contig_tiles(e.spark, path, 128), e.proteins, 128)[0]


@query("joi3_agg11_failures", "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN p.tid IS NULL THEN 'pep_missing' ELSE 'dna_missing' END AS reason FROM regions r LEFT JOIN contigs c USING (tname) LEFT JOIN proteins p ON p.tid = r.gene WHERE p.tid IS NULL OR coalesce(substr(c.seq, r.start1, r.end1 - r.start1 + 1), '') = '') GROUP BY reason", "regions", "contigs", "proteins")
def _(e: Entities) -> DataFrame:
    return S.failure_counts(G.extract_regions(e.regions, G.tile_contigs(e.contigs, 128), e.proteins, 128)[1])


@query("joi4_conserved_synteny", f"""{_BEST}, both_spans AS (SELECT b.gene, s.gid, b.tname = s.chr AS same, greatest(0, least(b.tend, s.stop) - greatest(b.tstart, s.start)) AS o, greatest(1, b.tend - b.tstart) AS n1, greatest(1, s.stop - s.start) AS n2 FROM best b LEFT JOIN synteny s ON s.gid = b.gene)
SELECT gene AS tid, bool_or(coalesce(same AND o / n1 >= 0.1 AND o / n2 >= 0.1, false)) AS conserved FROM both_spans GROUP BY gene""", "hits", "synteny")
def _(e: Entities) -> DataFrame:
    return S.conserved_synteny(H.best_hit(e.hits, ORDER), e.synteny)


_REPORT = f"""{_FAMILY}, single AS (SELECT tid FROM exons GROUP BY tid HAVING count(*) <= 1),
report AS (SELECT * FROM family UNION ALL
SELECT g.tid, g.gene_id, g.gene_symbol, b.found, 'biotype' FROM genes g JOIN (
  SELECT tid, CASE WHEN lower(gene_biotype) IN ('pseudogene', 'lncrna') THEN 'gene_biotype:' || gene_biotype ELSE 'transcript_biotype:' || transcript_biotype END AS found FROM biotypes
  WHERE lower(gene_biotype) IN ('pseudogene', 'lncrna') OR lower(transcript_biotype) IN ('pseudogene', 'lncrna') QUALIFY row_number() OVER (PARTITION BY tid ORDER BY line_no DESC) = 1) b USING (tid) UNION ALL
SELECT tid, gene_id, gene_symbol, 'intronless', 'gtf' FROM genes WHERE tid IN (FROM single))"""


@query("joi5_intronless_or_biotype", f"{_REPORT} SELECT * FROM report", "genes", "descriptions", "biotypes", "exons")
def _(e: Entities) -> DataFrame:
    return S.intronless_or_biotype(e.genes, e.descriptions, e.biotypes, e.exons, FAMILY, ["pseudogene", "lncRNA"])


@query("joi5_without_versions", f"{_REPORT} SELECT * REPLACE (tid || '.2' AS tid) FROM report", "genes", "descriptions", "biotypes", "exons")
def _(e: Entities) -> DataFrame:
    genes, biotypes = (df.withColumn("tid", F.concat("tid", F.lit(v))) for df, v in ((e.genes, ".2"), (e.biotypes, ".11")))
    return S.intronless_or_biotype(genes, e.descriptions, biotypes, e.exons, FAMILY, ["pseudogene", "lncRNA"], strip_version=True)


_FEATURES = f"""{_MET}, features AS (SELECT c.tid, c.tid IN (FROM truth) AS in_ref, c.n % 3 AS stop, c.n % 2 AS shift, c.n % 3 + c.n % 2 AS total, coalesce(m.align_len, 0) AS align_len, coalesce(p.length, 0) AS protein_len,
  coalesce(m.coverage, 0.0) AS coverage, coalesce(m.identity, 0.0) AS identity, c.n % 3 + c.n % 2 >= 2 AS multi
  FROM (SELECT DISTINCT tid, CAST(substr(tid, 2) AS BIGINT) AS n FROM candidates) c LEFT JOIN metrics m USING (tid) LEFT JOIN proteins p USING (tid))"""


def _numbered(e: Entities) -> DataFrame:
    n = F.substring("tid", 2, 20).cast("long")
    return e.candidates.select("tid").distinct().withColumn("stop", n % 3).withColumn("shift", n % 2)


def _features(e: Entities) -> DataFrame:
    counts = _numbered(e)
    return V.candidate_features(e.candidates, counts, e.alignments, e.proteins, e.truth, counts.where("stop + shift >= 2"))


@query("joi6_candidate_features", f"{_FEATURES} SELECT * FROM features", "candidates", "alignments", "proteins", "truth")
def _(e: Entities) -> DataFrame:
    return _features(e)


# aggregations, top-k, windows


@query("agg1_best_hit", f"{_BEST} SELECT * EXCLUDE n FROM best", "hits")
def _(e: Entities) -> DataFrame:
    return H.best_hit(e.hits, ORDER)


@query("agg2_longest_per_symbol", "SELECT tid, gene_symbol, CASE WHEN gene_symbol = '' THEN 'skipped_no_symbol' WHEN row_number() OVER (PARTITION BY gene_symbol ORDER BY length DESC, tid) = 1 THEN 'kept' ELSE 'skipped_duplicate' END AS status FROM proteins", "proteins")
def _(e: Entities) -> DataFrame:
    return S.longest_per_symbol(e.proteins)


@query("agg3_longest_whitelist", """, ranked AS (SELECT tid, gene_symbol, tid IN (FROM whitelist) AS listed, row_number() OVER (PARTITION BY gene_symbol, tid IN (FROM whitelist) ORDER BY length DESC, tid) AS n FROM proteins)
SELECT tid, gene_symbol, CASE WHEN listed OR (gene_symbol <> '' AND n = 1) THEN 'kept' WHEN gene_symbol = '' THEN 'skipped_no_symbol' ELSE 'skipped_duplicate' END AS status,
  CASE WHEN listed AND gene_symbol <> '' THEN 'whitelisted' WHEN listed THEN 'whitelisted_no_symbol' WHEN gene_symbol = '' THEN 'no_symbol' WHEN n = 1 THEN 'longest' ELSE 'duplicate' END AS reason FROM ranked""", "proteins", "whitelist")
def _(e: Entities) -> DataFrame:
    return S.longest_per_symbol_whitelist(e.proteins, e.whitelist)


_PEPTIDE = ", best AS (SELECT enst, ensp, pep_len FROM (SELECT *, row_number() OVER (PARTITION BY enst ORDER BY pep_len DESC, ensp) AS n FROM peptides) WHERE n = 1)"


@query("agg4_best_peptide", f"{_PEPTIDE} SELECT * FROM best", "peptides")
def _(e: Entities) -> DataFrame:
    return S.best_peptide(e.peptides)


@query("agg5_longest_cds", f"{_PEPTIDE} SELECT gene, enst, ensp, gene_symbol, cds_len, pep_len FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY cds_len DESC, pep_len DESC, enst) AS n FROM cds JOIN best USING (enst)) WHERE n = 1", "cds", "peptides")
def _(e: Entities) -> DataFrame:
    return S.longest_cds_per_gene(e.cds, e.peptides)


_CHOSEN = f"{_PEPTIDE}, chosen AS (SELECT gene, enst, ensp, gene_symbol, cds_len, pep_len FROM (SELECT *, row_number() OVER (PARTITION BY gene ORDER BY cds_len DESC, pep_len DESC, enst) AS n FROM cds JOIN best USING (enst)) WHERE n = 1)"


def _sequenced(e: Entities) -> DataFrame:
    return e.peptides.withColumn("seq", F.expr("repeat(substr(ensp, 5, 1), cast(pep_len as int))"))


@query("agg5_peptide_fasta", f"{_CHOSEN} SELECT enst || ' gene=' || gene || ' ensp=' || ensp || ' gene_symbol=' || gene_symbol || ' cds_len=' || cds_len || ' pep_len=' || pep_len AS header, enst AS id, repeat(substr(ensp, 5, 1), pep_len) AS seq FROM chosen", "cds", "peptides")
def _(e: Entities) -> DataFrame:
    path = sk.write_fasta(S.chosen_peptides(S.longest_cds_per_gene(e.cds, e.peptides), _sequenced(e)), sk.scratch_path(e.spark, "fasta"))
    return rd.read_fasta(e.spark, path).select("header", "id", "seq")


@query("agg5_counts", f"""{_CHOSEN} SELECT unnest(['pep_total_records', 'pep_with_transcript_tag', 'cds_total_records', 'cds_with_gene_tag', 'cds_with_protein', 'genes_picked', 'proteins_written']) AS name,
  unnest([(SELECT count(*) FROM peptides), (SELECT count(*) FROM peptides WHERE enst <> ''), (SELECT count(*) FROM cds), (SELECT count(*) FROM cds WHERE gene <> ''), (SELECT count(*) FROM cds WHERE enst IN (SELECT enst FROM best)), (SELECT count(*) FROM chosen), (SELECT count(*) FROM chosen)]) AS n""", "cds", "peptides")
def _(e: Entities) -> DataFrame:
    return S.longest_cds_counts(e.cds, e.peptides)


@query("agg6_locus_clusters", f"{_LOCI} SELECT qname, tname, tstart, tend, locus FROM loci", "hits")
def _(e: Entities) -> DataFrame:
    return H.locus_clusters(H.filter_hits(e.hits)).select("qname", "tname", "tstart", "tend", "locus")


@query("agg7_merged_coverage", f"{_COVERED} SELECT * FROM covered", "hits")
def _(e: Entities) -> DataFrame:
    return H.merged_query_coverage(H.locus_clusters(H.filter_hits(e.hits)))


@query("agg8_functional_redundancy", f"{_COVERED} SELECT p.qname AS query, max(p.qcov) AS best_cov, max(p.ident) AS best_id, any_value(c.n) AS full_copy_count, any_value(c.n) >= 2 AS redundant FROM passing p JOIN (SELECT qname, count(*) FILTER (WHERE cov >= 0.8) AS n FROM covered GROUP BY qname) c USING (qname) GROUP BY p.qname", "hits")
def functional_redundancy(e: Entities) -> DataFrame:
    return H.functional_redundancy(e.hits)


@query("agg9_hit_multiplicity", f""", {_PASSING.replace('FROM hits', 'FROM (SELECT * REPLACE (tstart % 5000 AS tstart, tstart % 5000 + alen AS tend) FROM hits)')},
folded AS (SELECT qname, tname, list({{'s': tstart, 'e': tend, 'n': CAST(1 AS BIGINT)}} ORDER BY tstart, tend) AS spans FROM passing GROUP BY qname, tname),
scanned AS (SELECT qname, list_reduce(spans, lambda a, x: CASE WHEN greatest(0, least(a.e, x.e) - greatest(a.s, x.s)) / greatest(1, least(a.e - a.s, x.e - x.s)) < 0.5 THEN {{'s': x.s, 'e': x.e, 'n': a.n + 1}} ELSE {{'s': a.s, 'e': greatest(a.e, x.e), 'n': a.n}} END).n AS n FROM folded),
counts AS (SELECT qname, CAST(sum(n) AS BIGINT) AS hit_count FROM scanned GROUP BY qname),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY nmatch DESC, o1, o2, o3, o4, o5) AS r FROM passing) WHERE r = 1)
SELECT b.qname AS query, b.qcov AS best_cov, b.ident AS best_id, b.alen AS best_alen, b.tname AS best_tname, b.tstart AS best_tstart, b.tend AS best_tend, c.hit_count, c.hit_count BETWEEN 1 AND 1 AS passes FROM best b JOIN counts c USING (qname)""", "hits")
def _(e: Entities) -> DataFrame:
    hits = e.hits.withColumn("tstart", F.col("tstart") % 5000).withColumn("tend", F.col("tstart") + F.col("alen"))
    return H.hit_multiplicity(hits, ORDER)


@query("agg10_exon_counts", "SELECT tid, count(*) AS n_exons, count(*) <= 1 AS intronless FROM exons GROUP BY tid", "exons")
def _(e: Entities) -> DataFrame:
    return S.exon_counts(e.exons)


@query("agg12_report_summary", f"""{_COUNTS}, scored AS (SELECT c.*, CAST(regexp_extract(b.text, 'Score ([0-9.]+) bits', 1) AS DOUBLE) AS score FROM counts c JOIN blocks b USING (line_no))
SELECT count(*) AS total, count(*) FILTER (WHERE stop > 0) AS with_stops, count(*) FILTER (WHERE shift > 0) AS with_frameshifts, count(*) FILTER (WHERE stop > 0 AND shift > 0) AS with_both, round(avg(score), 6) AS average_score, CAST(sum(stop) AS BIGINT) AS total_stops, CAST(sum(shift) AS BIGINT) AS total_frameshifts FROM scored""", "blocks")
def _(e: Entities) -> DataFrame:
    return R.report_summary(B.parse_blocks(e.blocks)).withColumn("average_score", F.round("average_score", 6))


@query("agg13_histogram", """, ends AS (SELECT min(length) AS lo, max(length) AS hi FROM proteins), bins AS (SELECT unnest(range(10)) AS bin),
placed AS (SELECT least(CAST(floor((length - lo) / ((hi - lo) / 10)) AS BIGINT), 9) AS bin FROM proteins, ends)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 10), 6) AS low, count(p.bin) AS n FROM bins b CROSS JOIN ends LEFT JOIN placed p USING (bin) GROUP BY b.bin, lo, hi""", "proteins")
def _(e: Entities) -> DataFrame:
    return R.histogram(e.proteins, "length").withColumn("low", F.round("low", 6))


@query("agg14_mutation_frequencies", f"""{_COUNTS}, every AS (SELECT unnest(range(0, (SELECT greatest(max(stop), max(shift)) FROM counts) + 1)) AS n)
SELECT e.n AS "count", (SELECT count(*) FROM counts WHERE stop = e.n) AS n_stop, (SELECT count(*) FROM counts WHERE shift = e.n) AS n_shift FROM every e""", "blocks")
def _(e: Entities) -> DataFrame:
    return R.mutation_frequencies(B.count_mutations(e.blocks))


@query("agg15_funnel_counts", f"{_LOADS} SELECT load AS stage, count(DISTINCT tid) AS n FROM loads GROUP BY load", "blocks")
def _(e: Entities) -> DataFrame:
    return R.funnel_counts(B.classify_mutation_load(B.count_mutations(e.blocks)).withColumnRenamed("load", "stage"))


@query("top1_page", f"{_COUNTS} SELECT line_no, tid, CAST(stop AS BIGINT) AS stop, CAST(shift AS BIGINT) AS shift FROM counts ORDER BY line_no LIMIT 50 OFFSET 100", "blocks")
def _(e: Entities) -> DataFrame:
    return R.page(B.count_mutations(e.blocks), ["line_no"], 3)


# quality filters, set algebra, funnel


@query("top1_deep_page", "SELECT o1, o2, o3, o4, o5 FROM hits ORDER BY ALL LIMIT 50 OFFSET 50000", "hits")
def _(e: Entities) -> DataFrame:
    return R.page(e.hits.select(*ORDER), ORDER, 1001)


@query("qua1_multi_quality", f"""{_FEATURES}, joined AS (SELECT f.tid, f.stop, f.shift, m.align_len, coalesce(p.length, 0) AS protein_len, m.coverage, m.identity FROM features f LEFT JOIN metrics m USING (tid) LEFT JOIN proteins p USING (tid) WHERE f.multi)
SELECT tid, stop, shift, coalesce(align_len, 0) AS align_len, protein_len, coalesce(coverage, 0.0) AS coverage, coalesce(identity, 0.0) AS identity,
  CASE WHEN align_len IS NULL THEN 'missing_alignment' WHEN protein_len = 0 THEN 'missing_length' WHEN align_len >= 200 AND coverage >= 0.7 AND identity >= 0.05 THEN 'pass'
  ELSE concat_ws(';', CASE WHEN align_len < 200 THEN 'short_alignment' END, CASE WHEN coverage < 0.7 THEN 'low_coverage' END, CASE WHEN identity < 0.05 THEN 'low_identity' END) END AS reason FROM joined""", "candidates", "alignments", "proteins", "truth")
def _(e: Entities) -> DataFrame:
    counts = _numbered(e)
    return Q.multi_disruption_quality(counts.where("stop + shift >= 2"), counts, e.alignments, e.proteins)


@query("qua2_global_quality", f"""{_MET} SELECT c.tid, coalesce(m.align_len, 0) AS align_len, coalesce(m.protein_len, 0) AS protein_len, coalesce(m.coverage, 0.0) AS coverage, coalesce(m.identity, 0.0) AS identity,
  CASE WHEN m.align_len >= 200 AND m.coverage >= 0.7 AND m.identity >= 0.3 THEN 'pass' ELSE 'fail' END AS status FROM (SELECT DISTINCT tid FROM candidates) c LEFT JOIN metrics m USING (tid)""", "candidates", "alignments", "proteins")
def _(e: Entities) -> DataFrame:
    return Q.global_alignment_quality(e.candidates.select("tid").distinct(), e.alignments, e.proteins)


@query("set1_intersect", "SELECT tid FROM candidates INTERSECT SELECT tid FROM truth", "candidates", "truth")
def _(e: Entities) -> DataFrame:
    return S.intersect_ids(e.candidates, e.truth)


@query("set2_subtract", "SELECT DISTINCT tid FROM candidates WHERE tid NOT IN (FROM truth)", "candidates", "truth")
def _(e: Entities) -> DataFrame:
    return S.subtract_ids(e.candidates.select("tid").distinct(), e.truth)


@query("set3_union", "SELECT tid FROM candidates UNION SELECT tid FROM truth UNION SELECT tid FROM whitelist", "candidates", "truth", "whitelist")
def _(e: Entities) -> DataFrame:
    return S.union_ids(e.candidates, e.truth, e.whitelist)


@query("set4_merge_whitelist", "SELECT tid FROM truth UNION SELECT tid FROM whitelist WHERE EXISTS (FROM truth)", "truth", "whitelist")
def _(e: Entities) -> DataFrame:
    return S.merge_whitelist(e.truth, e.whitelist)


_FUNNEL_TABLES = ("blocks", "candidates", "whitelist", "hits")
_FUNNEL = f"""{_COVERED}, redundant_ids AS (SELECT replace(qname, 'Q', 'T') || '.1' AS tid FROM covered GROUP BY qname HAVING count(*) FILTER (WHERE cov >= 0.8) >= 2){_LOADS},
p AS (SELECT DISTINCT tid || '.1' AS tid, 'G' || substr(tid, 2) AS gene_id, CASE WHEN CAST(substr(tid, 2) AS BIGINT) % 10 = 0 THEN '' ELSE 'S' || CAST(CAST(substr(tid, 2) AS BIGINT) % 300 AS VARCHAR) END AS gene_symbol, 80 + CAST(substr(tid, 2) AS BIGINT) % 50 AS length FROM candidates),
w AS (SELECT tid || '.1' AS tid FROM whitelist),
valid AS (SELECT tid FROM (SELECT tid, gene_symbol, tid IN (FROM w) AS listed, row_number() OVER (PARTITION BY gene_symbol, tid IN (FROM w) ORDER BY length DESC, tid) AS n FROM p) WHERE listed OR (gene_symbol <> '' AND n = 1)),
start AS (SELECT tid FROM loads WHERE load = 'putative' AND tid IN (FROM valid) UNION FROM w),
fam AS (SELECT tid FROM p WHERE regexp_matches(gene_symbol, '^S1', 'i')),
kept1 AS (SELECT tid FROM start WHERE tid NOT IN (FROM fam)), list1 AS (FROM kept1 UNION SELECT tid FROM w WHERE EXISTS (FROM kept1)),
kept2 AS (SELECT tid FROM list1 WHERE tid NOT IN (FROM redundant_ids)), unitary AS (FROM kept2 UNION SELECT tid FROM w WHERE EXISTS (FROM kept2)),
one AS (SELECT tid FROM loads WHERE load = 'single' AND tid IN (FROM unitary)),
fp AS (SELECT DISTINCT c.tid FROM counts c JOIN blocks b USING (line_no) WHERE c.tid IN (FROM one) AND (contains(b.text, ':X[') OR regexp_matches(b.text, '![A-Z]?\\s\\s\\s|\\s\\s\\s[A-Z]?!'))),
kept3 AS (SELECT tid FROM unitary WHERE tid NOT IN (FROM fp)), high AS (FROM kept3 UNION SELECT tid FROM w WHERE EXISTS (FROM kept3))
"""


def _funnel_inputs(e: Entities) -> Inputs:
    n = F.substring("tid", 2, 20).cast("long")
    ids = e.candidates.select("tid").distinct()
    proteins = ids.select(F.concat("tid", F.lit(".1")).alias("tid"), F.concat(F.lit("G"), n.cast("string")).alias("gene_id"), F.when(n % 10 == 0, "").otherwise(F.concat(F.lit("S"), (n % 300).cast("string"))).alias("gene_symbol"), (80 + n % 50).alias("length"))
    empty = e.spark.createDataFrame([], "tid string, qseq string, tseq string")
    hits = e.hits.withColumn("qname", F.concat(F.regexp_replace("qname", "Q", "T"), F.lit(".1")))
    return Inputs(e.blocks, proteins, hits, empty, e.spark.createDataFrame([], "key string, text string"), e.whitelist.select(F.concat("tid", F.lit(".1")).alias("tid")))


@query("fun1_funnel", f"{_FUNNEL} SELECT tid, tid IN (FROM unitary) AS unitary, tid IN (FROM high) AS high_confidence FROM (SELECT tid FROM loads UNION SELECT tid FROM w)", *_FUNNEL_TABLES)
def _(e: Entities) -> DataFrame:
    # alignments don't exist for these blocks, so what needs them is off
    rows = run_funnel(_funnel_inputs(e), Thresholds(family_patterns="^S1,^S1x", multi_quality=False, global_quality=False))
    return rows.select("tid", "unitary", "high_confidence")


_FULL_TABLES = ("blocks", "proteins", "alignments", "genes", "descriptions", "whitelist", "hits")
_FULL = rf"""{_COVERED}, redundant_ids AS (SELECT replace(qname, 'Q', 'T') || '.1' AS tid FROM covered GROUP BY qname HAVING count(*) FILTER (WHERE cov >= 0.8) >= 2){_LOADS}{_MUT}{_MET},
p AS (SELECT r.tid || '.1' AS tid, coalesce(g.gene_id, '') AS gene_id, CASE WHEN length(r.tid) > 1 AND right(r.tid, 1) = '8' THEN '' ELSE coalesce(g.gene_symbol || '/' || right(r.tid, 2), r.tid) END AS gene_symbol, r.length FROM proteins r LEFT JOIN genes g ON g.tid = 'Q' || substr(r.tid, 2)),
w AS (SELECT tid || '.1' AS tid FROM whitelist),
valid AS (SELECT tid FROM (SELECT tid, gene_symbol, tid IN (FROM w) AS listed, row_number() OVER (PARTITION BY gene_symbol, tid IN (FROM w) ORDER BY length DESC, tid) AS n FROM p) WHERE listed OR (gene_symbol <> '' AND n = 1)),
start AS (SELECT tid FROM loads WHERE load = 'putative' AND tid IN (FROM valid) UNION FROM w),
named AS (SELECT p.tid, p.gene_id, p.gene_symbol, CASE WHEN i.key IS NOT NULL THEN i.text ELSE s.text END AS text FROM p LEFT JOIN descriptions i ON i.key = p.gene_id LEFT JOIN descriptions s ON s.key = p.gene_symbol),
fam AS (SELECT tid FROM named WHERE regexp_matches(concat_ws(chr(10), gene_symbol, gene_id, text), 'plate|brand#1|red', 'i')),
kept1 AS (SELECT tid FROM start WHERE tid NOT IN (FROM fam)), list1 AS (FROM kept1 UNION SELECT tid FROM w WHERE EXISTS (FROM kept1)),
kept2 AS (SELECT tid FROM list1 WHERE tid NOT IN (FROM redundant_ids)), unitary AS (FROM kept2 UNION SELECT tid FROM w WHERE EXISTS (FROM kept2)),
one AS (SELECT tid FROM loads WHERE load = 'single' AND tid IN (FROM unitary)), many AS (SELECT tid FROM loads WHERE load = 'multi' AND tid IN (FROM unitary)),
squeezed AS (SELECT regexp_replace(b.text, '\s+', '', 'g') AS s, c.tid FROM blocks b JOIN counts c USING (line_no) WHERE contains(b.text, '.sp.tr') AND c.tid IN (FROM one) AND regexp_extract(b.text, '>(\S+?)\.sp\.tr', 1) = c.tid),
fp AS (SELECT c.tid FROM counts c JOIN blocks b USING (line_no) WHERE c.tid IN (FROM one) AND (contains(b.text, ':X[') OR regexp_matches(b.text, '![A-Z]?\s\s\s|\s\s\s[A-Z]?!'))
  UNION SELECT tid FROM squeezed WHERE (contains(s, '*') AND length(s) - instr(s, '*') BETWEEN 1 AND 49) OR length(string_split(s, 'tr')[-1]) BETWEEN 1 AND 49
  UNION SELECT tid || '.1' FROM (SELECT *, {_IDENT} AS identity FROM flanks) WHERE tid || '.1' IN (FROM one) AND flank_before < 0.2 AND flank_after < 0.2 AND identity < 0.1
  UNION SELECT tid || '.1' FROM typed WHERE mut_pos IS NOT NULL AND (mut_pos + 1) / length(qseq) >= 0.9),
kept3 AS (SELECT tid FROM unitary WHERE tid NOT IN (FROM fp)), list3 AS (FROM kept3 UNION SELECT tid FROM w WHERE EXISTS (FROM kept3)),
good_many AS (SELECT tid || '.1' AS tid FROM metrics WHERE protein_len > 0 AND align_len >= 200 AND coverage >= 0.7 AND identity >= 0.05),
kept4 AS (SELECT tid FROM list3 WHERE tid NOT IN (FROM many) OR tid IN (FROM good_many)), list4 AS (FROM kept4 UNION SELECT tid FROM w WHERE EXISTS (FROM kept4)),
good AS (SELECT tid || '.1' AS tid FROM metrics WHERE align_len >= 400 AND coverage >= 0.7 AND identity >= 0.3),
kept5 AS (SELECT tid FROM list4 WHERE tid IN (FROM good)), high AS (FROM kept5 UNION SELECT tid FROM w WHERE EXISTS (FROM kept5))
"""


def _full_funnel(e: Entities, **switches: bool) -> DataFrame:
    """The funnel over blocks, proteins, alignments and descriptions of one id space; all six switches are on but for what `switches` says."""
    named = lambda df: df.withColumn("tid", F.concat("tid", F.lit(".1")))
    genes = e.genes.select(F.regexp_replace("tid", "^Q", "T").alias("tid"), "gene_id", F.col("gene_symbol").alias("symbol"))
    proteins = e.proteins.select("tid", "length").join(genes, "tid", "left")
    proteins = named(proteins.select("tid", F.coalesce("gene_id", F.lit("")).alias("gene_id"), F.when((F.length("tid") > 1) & (F.substring("tid", -1, 1) == "8"), "").otherwise(F.coalesce(F.concat("symbol", F.lit("/"), F.substring("tid", -2, 2)), "tid")).alias("gene_symbol"), "length"))
    hits = e.hits.withColumn("qname", F.concat(F.regexp_replace("qname", "Q", "T"), F.lit(".1")))
    return run_funnel(Inputs(e.blocks, proteins, hits, named(e.alignments), e.descriptions, named(e.whitelist)), Thresholds(family_patterns="plate|brand#1|red", id_rule="documented", global_min_aln_len=400, **switches))


@query("fun1_funnel_all_filters", f"""{_FULL} SELECT tid, tid IN (SELECT tid FROM loads WHERE load = 'putative') AS putative, tid IN (FROM valid) AND tid IN (SELECT tid FROM loads) AS valid, tid IN (FROM w) AS listed, tid IN (FROM fam) AS family, tid IN (FROM redundant_ids) AS redundant, tid IN (FROM unitary) AS unitary,
  tid IN (FROM fp) AS false_positive, tid IN (FROM many) AND tid NOT IN (FROM good_many) AS low_multi, tid IN (FROM unitary) AND tid NOT IN (FROM good) AS low_global, tid IN (FROM high) AS high_confidence FROM (SELECT tid FROM loads UNION SELECT tid FROM w)""", *_FULL_TABLES)
def _(e: Entities) -> DataFrame:
    return _full_funnel(e).select("tid", "putative", "valid", "listed", "family", "redundant", "unitary", "false_positive", "low_multi", "low_global", "high_confidence")


#: Each switch, and what of the funnel's SQL stands for it, on and off.
SWITCHES = {
    "prefilter": ("listed OR (gene_symbol <> '' AND n = 1)", "true"),
    "family": ("WHERE regexp_matches(concat_ws(", "WHERE false AND regexp_matches(concat_ws("),
    "redundancy": ("FROM covered GROUP BY", "FROM covered WHERE false GROUP BY"),
    "false_positive": ("FROM unitary WHERE tid NOT IN (FROM fp)", "FROM unitary"),
    "multi_quality": ("FROM list3 WHERE tid NOT IN (FROM many) OR tid IN (FROM good_many)", "FROM list3"),
    "global_quality": ("FROM list4 WHERE tid IN (FROM good)", "FROM list4"),
}


def _without(switch: str) -> None:
    on, off = SWITCHES[switch]

    @query(f"fun1_funnel_without_{switch}", f"{_FULL.replace(on, off)} SELECT tid, tid IN (FROM unitary) AS unitary, tid IN (FROM high) AS high_confidence FROM (SELECT tid FROM loads UNION SELECT tid FROM w)", *_FULL_TABLES)
    def _(e: Entities) -> DataFrame:
        return _full_funnel(e, **{switch: False}).select("tid", "unitary", "high_confidence")


for _switch in SWITCHES:
    _without(_switch)


@query("agg15_funnel_stages", f"""{_FULL} SELECT 'putative' AS stage, count(DISTINCT tid) AS n FROM loads WHERE load = 'putative' UNION ALL SELECT 'unitary', count(*) FROM unitary UNION ALL SELECT 'high_confidence', count(*) FROM high""", *_FULL_TABLES)
def _(e: Entities) -> DataFrame:
    stages = ("putative", "unitary", "high_confidence")
    rows = _full_funnel(e).select("tid", F.explode(F.array_compact(F.array(*[F.when(F.col(c), c) for c in stages]))).alias("stage"))
    return R.funnel_counts(rows)


# evaluation and tuning


@query("eva1_threshold_suggestions", f"""{_FEATURES}, grid AS (SELECT a.x AS min_aln_len, c.x AS min_cov, i.x AS min_id FROM (SELECT unnest([50.0::DOUBLE, 100, 150, 200]) AS x) a, (SELECT unnest([0.3::DOUBLE, 0.4, 0.5, 0.6, 0.7, 0.8]) AS x) c, (SELECT unnest([0.3::DOUBLE, 0.4, 0.5, 0.6, 0.7]) AS x) i),
sums AS (SELECT g.*, count(*) FILTER (WHERE in_ref AND align_len >= min_aln_len AND coverage >= min_cov AND identity >= min_id) AS ref_kept, count(*) FILTER (WHERE in_ref) AS ref_total, count(*) FILTER (WHERE NOT in_ref AND NOT (align_len >= min_aln_len AND coverage >= min_cov AND identity >= min_id)) AS nonref_dropped, count(*) FILTER (WHERE NOT in_ref) AS nonref_total FROM grid g, features f WHERE f.multi GROUP BY ALL)
SELECT min_aln_len, min_cov, min_id, round(ref_kept / ref_total, 6) AS keep_ref, round(nonref_dropped / nonref_total, 6) AS drop_nonref, ref_kept, ref_total, nonref_dropped, nonref_total, round(ref_kept / ref_total + nonref_dropped / nonref_total, 6) AS score FROM sums""", "candidates", "alignments", "proteins", "truth")
def _(e: Entities) -> DataFrame:
    rows = V.threshold_suggestions(_features(e))
    return rows.withColumns({c: F.round(c, 6) for c in ("keep_ref", "drop_nonref", "score")})


_TUNE = f"""{_MUT}{_MET}, u AS (SELECT c.species, c.tid, CAST(substr(c.tid, 2) AS BIGINT) AS n FROM candidates c),
tune AS (SELECT u.species, u.tid, coalesce(m.align_len, 0) AS aln_len, coalesce(m.coverage, 0.0) AS cov, coalesce(m.identity, 0.0) AS ident, coalesce(t.mut_pos, -1) AS mut_pos, coalesce(t.mut_type, '') AS mut_type,
  coalesce(f.flank_before, 1.0) AS flank_bef, coalesce(f.flank_after, 1.0) AS flank_aft, CASE WHEN t.mut_pos IS NOT NULL AND coalesce(p.length, 0) > 0 THEN (t.mut_pos + 1) / p.length ELSE 0.0 END AS mut_frac, u.n % 2 = 1 AS is_one, u.n % 2 = 0 AS is_multi
  FROM u LEFT JOIN metrics m USING (tid) LEFT JOIN typed t USING (tid) LEFT JOIN flanks f USING (tid) LEFT JOIN proteins p USING (tid))"""


def _tuning(e: Entities) -> DataFrame:
    n = F.substring("tid", 2, 20).cast("long")
    return V.tuning_features(e.candidates.withColumn("is_one", n % 2 == 1).withColumn("is_multi", n % 2 == 0), e.alignments, e.proteins)


@query("eva2_tuning_features", f"{_TUNE} SELECT * FROM tune", "candidates", "alignments", "proteins")
def _(e: Entities) -> DataFrame:
    return _tuning(e)


_APPLY = f"""{_TUNE}, grid AS (SELECT row_number() OVER () - 1 AS combo, * FROM (SELECT m.x AS low_mode, lf.x AS low_flank, lo.x AS low_overall, ef.x AS end_frac, ma.x AS multi_aln, mc.x AS multi_cov, mi.x AS multi_id, g.x AS global_filter
  FROM (SELECT unnest(['or', 'and']) AS x, unnest([0, 1]) AS k) m, (SELECT unnest([0.3::DOUBLE, 0.4]) AS x) lf, (SELECT unnest([0.2::DOUBLE, 1.0]) AS x) lo, (SELECT unnest([0.9::DOUBLE, 0.95]) AS x) ef, (SELECT unnest([200.0::DOUBLE, 300]) AS x) ma, (SELECT unnest([0.6::DOUBLE, 0.7]) AS x) mc, (SELECT unnest([0.05::DOUBLE, 0.1]) AS x) mi, (SELECT unnest(['off', '150:0.8:0.3', '200:0.8:0.3']) AS x, unnest([0, 1, 2]) AS k) g
  ORDER BY m.k, lf.x, lo.x, ef.x, ma.x, mc.x, mi.x, g.k)),
survivors AS (SELECT g.combo, t.species, t.tid FROM grid g, tune t WHERE NOT (is_one AND (mut_frac >= end_frac OR (mut_pos >= 0 AND ident < low_overall AND CASE WHEN low_mode = 'or' THEN flank_bef < low_flank OR flank_aft < low_flank ELSE flank_bef < low_flank AND flank_aft < low_flank END)))
  AND NOT (is_multi AND NOT (aln_len >= multi_aln AND cov >= multi_cov AND ident >= multi_id)) AND (global_filter = 'off' OR (aln_len >= CAST(split_part(global_filter, ':', 1) AS DOUBLE) AND cov >= 0.8 AND ident >= 0.3)))"""


@query("eva3_apply_params", f"{_APPLY} SELECT combo, species, tid FROM survivors", "candidates", "alignments", "proteins")
def _(e: Entities) -> DataFrame:
    return V.apply_params(_tuning(e), V.parameter_grid(e.spark))


_SIGNED = ", signed AS (SELECT c.species, c.tid FROM candidates c JOIN (SELECT DISTINCT replace(regexp_extract(text, 'Query protein: (\\S+)', 1), '.1', '') AS tid FROM blocks WHERE contains(text, ':X[')) b USING (tid))"


def _signed(e: Entities) -> DataFrame:
    """(species, tid) of candidates with a splicing sign."""
    signs = B.block_signs(e.blocks).where("kind = 'splicing_stop'").select(F.regexp_replace("tid", r"\.1$", "").alias("tid")).distinct()
    return e.candidates.join(signs, "tid").select("species", "tid")


@query("eva3_apply_params_signs", f"{_APPLY}{_SIGNED} SELECT combo, species, tid FROM survivors WHERE (species, tid) NOT IN (SELECT (species, tid) FROM signed)", "candidates", "alignments", "proteins", "blocks")
def _(e: Entities) -> DataFrame:
    return V.apply_params(_tuning(e), V.parameter_grid(e.spark), _signed(e))


_SEARCH = f"""{_APPLY}, sums AS (SELECT combo, count(DISTINCT tid) AS union_size, count(DISTINCT tid) FILTER (WHERE tid IN (FROM truth)) AS overlap, count(*) FILTER (WHERE species = 'sp_a') AS n_sp_a, count(*) FILTER (WHERE species = 'sp_b') AS n_sp_b FROM survivors GROUP BY combo),
search AS (SELECT g.*, coalesce(union_size, 0) AS union_size, coalesce(overlap, 0) AS overlap, coalesce(n_sp_a, 0) AS n_sp_a, coalesce(n_sp_b, 0) AS n_sp_b, coalesce(overlap, 0) / (SELECT count(*) FROM truth) AS recall, coalesce(overlap / nullif(union_size, 0), 0.0) AS precision FROM grid g LEFT JOIN sums USING (combo))"""


@query("eva4_grid_search", f"{_SEARCH} SELECT * FROM search ORDER BY recall DESC, union_size, precision DESC, combo LIMIT 20", "candidates", "alignments", "proteins", "truth")
def _(e: Entities) -> DataFrame:
    return V.grid_search(_tuning(e), V.parameter_grid(e.spark), e.truth, ("sp_a", "sp_b"))


@query("eva4_grid_search_target", f"{_SEARCH} SELECT * FROM search ORDER BY abs(union_size - 100), recall DESC, precision DESC, combo LIMIT 20", "candidates", "alignments", "proteins", "truth")
def _(e: Entities) -> DataFrame:
    return V.grid_search(_tuning(e), V.parameter_grid(e.spark), e.truth, ("sp_a", "sp_b"), target_union=100)


@query("eva4_grid_search_min_recall", f"{_SEARCH} SELECT * FROM search WHERE recall >= 0.1 ORDER BY union_size, precision DESC, recall DESC, combo LIMIT 20", "candidates", "alignments", "proteins", "truth")
def _(e: Entities) -> DataFrame:
    return V.grid_search(_tuning(e), V.parameter_grid(e.spark), e.truth, ("sp_a", "sp_b"), min_recall=0.1)


@query("eva4_grid_search_max_union", f"{_SEARCH.replace('FROM survivors GROUP BY combo', 'FROM survivors WHERE (species, tid) NOT IN (SELECT (species, tid) FROM signed) GROUP BY combo').replace(', sums AS', _SIGNED + ', sums AS')} SELECT * FROM search WHERE union_size <= 520 ORDER BY recall DESC, union_size, precision DESC, combo LIMIT 20", "candidates", "alignments", "proteins", "truth", "blocks")
def _(e: Entities) -> DataFrame:
    return V.grid_search(_tuning(e), V.parameter_grid(e.spark), e.truth, ("sp_a", "sp_b"), max_union=520, false_positives=_signed(e))


@query("eva5_recall", "SELECT count(*) AS n_ref, count(*) FILTER (WHERE tid IN (SELECT tid FROM candidates WHERE species = 'sp_a')) AS n_found, count(*) FILTER (WHERE tid IN (SELECT tid FROM candidates WHERE species = 'sp_a')) / count(*) AS recall FROM truth", "truth", "candidates")
def _(e: Entities) -> DataFrame:
    return V.recall(e.candidates.where("species = 'sp_a'"), e.truth)


_DIAGNOSE = r""", t AS (SELECT tid FROM truth WHERE tid NOT IN (SELECT tid FROM candidates WHERE tid IN (FROM whitelist))),
seen AS (SELECT species, tid FROM candidates),
best AS (SELECT gene_symbol, tid AS kept_tid, length AS kept_length FROM (SELECT *, row_number() OVER (PARTITION BY gene_symbol ORDER BY length DESC, tid) AS n FROM proteins WHERE gene_symbol <> '') WHERE n = 1),
b AS (SELECT CASE WHEN line_no % 2 = 0 THEN 'sp_a' ELSE 'sp_b' END AS species, replace(regexp_extract(text, 'Query protein:\s+(\S+)', 1), '.1', '') AS tid, contains(text, 'X') AS stop, contains(text, '!') AS shift, CAST(regexp_extract(text, 'Score ([0-9.]+) bits', 1) AS DOUBLE) AS score, line_no FROM blocks),
raw AS (SELECT species, tid FROM b WHERE shift),
last AS (SELECT species, tid, max_by(stop, line_no) AS stop, max_by(shift, line_no) AS shift, max_by(score, line_no) AS score FROM b GROUP BY species, tid),
diag AS (SELECT t.tid, coalesce(p.gene_symbol, '') AS gene_symbol, coalesce(p.length, 0) AS length, k.kept_tid, k.kept_length, t.tid IN (SELECT kept_tid FROM best) AS in_prefilter,
  ('sp_a', t.tid) IN (SELECT (species, tid) FROM raw) AS raw_sp_a, ('sp_a', t.tid) IN (SELECT (species, tid) FROM seen) AS hit_sp_a, coalesce(a.stop, false) AS stop_sp_a, coalesce(a.shift, false) AS shift_sp_a, a.score AS score_sp_a,
  ('sp_b', t.tid) IN (SELECT (species, tid) FROM raw) AS raw_sp_b, ('sp_b', t.tid) IN (SELECT (species, tid) FROM seen) AS hit_sp_b, coalesce(c.stop, false) AS stop_sp_b, coalesce(c.shift, false) AS shift_sp_b, c.score AS score_sp_b
  FROM t LEFT JOIN proteins p USING (tid) LEFT JOIN best k ON k.gene_symbol = p.gene_symbol LEFT JOIN last a ON a.tid = t.tid AND a.species = 'sp_a' LEFT JOIN last c ON c.tid = t.tid AND c.species = 'sp_b'),
told AS (SELECT *, coalesce(nullif(concat_ws('; ', CASE WHEN NOT in_prefilter THEN 'removed by prefilter' END, CASE WHEN NOT raw_sp_a AND NOT raw_sp_b THEN 'no disruption in any species' WHEN NOT raw_sp_a THEN 'no disruption in: sp_a' WHEN NOT raw_sp_b THEN 'no disruption in: sp_b' END), ''), 'unknown') AS reasons,
  CASE WHEN NOT in_prefilter THEN 'prefilter' WHEN NOT raw_sp_a AND NOT raw_sp_b THEN 'no_disruption' ELSE 'partial' END AS category FROM diag)"""
_DIAGNOSE_TABLES = ("truth", "candidates", "whitelist", "proteins", "blocks")


def _diagnosis(e: Entities, match: str = "equal") -> DataFrame:
    kept = S.longest_per_symbol(e.proteins).where("status = 'kept'")
    text = F.col("text")
    blocks = e.blocks.select(F.when(F.col("line_no") % 2 == 0, "sp_a").otherwise("sp_b").alias("species"), F.regexp_replace(X.query_id(text), r"\.1$", "").alias("tid"), text.contains("X").alias("stop"), text.contains("!").alias("shift"), X.block_score(text).alias("score"), X.query_lines(text).alias("label"), "terminated", "line_no")
    return V.diagnose_missing(e.truth, S.keep_listed(e.candidates, e.whitelist), blocks.where("shift"), e.candidates, blocks, e.proteins, kept, ("sp_a", "sp_b"), match)


@query("eva6_diagnose_missing", f"{_DIAGNOSE} SELECT * FROM told", *_DIAGNOSE_TABLES)
def _(e: Entities) -> DataFrame:
    return _diagnosis(e)


_BY_SUBSTRING = _DIAGNOSE.replace("raw AS (", """found AS (SELECT b.species, t.tid, b.stop, b.shift, b.score, b.line_no FROM t JOIN (SELECT b.*, 'Query protein: ' || b.tid || '.1' AS label FROM b) b ON contains(b.label, t.tid)),
raw AS (""").replace("FROM b GROUP BY species, tid", "FROM found GROUP BY species, tid")


@query("eva6_diagnose_missing_substring", f"{_BY_SUBSTRING} SELECT * FROM told", *_DIAGNOSE_TABLES)
def _(e: Entities) -> DataFrame:
    return _diagnosis(e, "substring")


@query("eva7_missing_categories", f"{_DIAGNOSE} SELECT category, count(*) AS n FROM told GROUP BY category", *_DIAGNOSE_TABLES)
def _(e: Entities) -> DataFrame:
    return V.missing_categories(_diagnosis(e))
