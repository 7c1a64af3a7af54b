"""Entities made from the given tables: one SQL text each, which Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["lineitem", "orders", "part", "documents", "labels"]
# the letters of a text; what uses them more than once takes them from a subquery, as both engines would fold them anew each time
_LETTERS = "upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', ''<G>))"
_QSTART = "(l_orderkey * 13 + l_linenumber * 37) % 200"
_QLEN = "300 + l_partkey % 7 * 50"
_ALEN = "180 + l_suppkey * 37 % 900"
_TSTART = "(l_orderkey * 7919 + l_linenumber * 104729) % 200000"
_TID = "'T' || cast(doc_id - doc_id % 2 as string)"  # two blocks an id
_TAIL = "CASE WHEN doc_id % 4 < 2 THEN 20 ELSE 80 END"
_LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789', cast(doc_id % 62 as int) + 1, 1)"  # ids of one character


def _blocks(line_no: str, tid: str, other: str) -> str:
    """Prediction blocks of queries `tid`; some have a translation, of which a third is named `other`."""
    return f"""SELECT {line_no} AS line_no, 'Query protein: ' || {tid} || chr(10) || 'Score ' || cast(doc_id % 200 as string) || '.5 bits' || chr(10) || substr(q, 1, cast(greatest(0, length(q) - {_TAIL}) as int))
        || CASE doc_id % 5 WHEN 0 THEN '*' WHEN 1 THEN '!' WHEN 2 THEN ':X[' WHEN 3 THEN '   !' ELSE '*!!' END || chr(10)
        || CASE WHEN doc_id % 7 < 2 THEN '>' || CASE WHEN doc_id % 3 = 0 THEN {other} ELSE {tid} END || '.sp.tr' || chr(10) ELSE '' END || substr(q, cast(greatest(0, length(q) - {_TAIL}) as int) + 1) AS text, true AS terminated FROM (SELECT *, {_LETTERS} AS q FROM {{documents}}) AS d"""


SQL = {
    "hits": f"""SELECT 'Q' || cast(l_partkey as string) AS qname, {_QLEN} AS qlen, {_QSTART} AS qstart,
        least({_QLEN}, {_QSTART} + 60 + (l_suppkey * 11 + cast(l_quantity as bigint) * 9) % 300) AS qend,
        CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand, 'chr' || cast(l_suppkey % 5 as string) AS tname, cast(1000000 as bigint) AS tlen,
        {_TSTART} AS tstart, {_TSTART} + {_ALEN} AS tend, cast(floor(({_ALEN}) * (20 + (l_orderkey * 7 + l_linenumber) % 80) / 100.0) as bigint) AS nmatch, {_ALEN} AS alen,
        l_orderkey % 61 AS mapq, l_orderkey AS o1, cast(l_linenumber as bigint) AS o2, l_partkey AS o3, l_suppkey AS o4, l_extendedprice AS o5 FROM {{lineitem}}""",
    "proteins": f"""SELECT 'T' || cast(doc_id as string) AS tid, 'G' || cast(doc_id % 97 as string) AS gene_id,
        CASE WHEN doc_id % 10 = 0 THEN '' ELSE upper(lang) || '_' || source END AS gene_symbol, q AS seq, cast(length(q) as bigint) AS length FROM (SELECT *, {_LETTERS} AS q FROM {{documents}}) AS d""",
    "genes": "SELECT 'Q' || cast(p_partkey as string) AS tid, p_brand || '/' || cast(p_size as string) AS gene_id, p_type AS gene_symbol, p_name AS name FROM {part}",
    "descriptions": "SELECT CASE WHEN p_size % 2 = 0 THEN p_brand || '/' || cast(p_size as string) ELSE p_type END AS key, min(p_name) AS text FROM {part} GROUP BY 1",
    "biotypes": """SELECT p_brand AS gene_id, 'Q' || cast(p_partkey as string) AS tid, CASE WHEN p_size % 5 = 0 THEN 'Pseudogene' ELSE 'protein_coding' END AS gene_biotype,
        CASE WHEN p_size % 7 = 0 THEN 'lncRNA' ELSE 'protein_coding' END AS transcript_biotype, 2 * p_partkey AS line_no FROM {part}
        UNION ALL SELECT p_brand, 'Q' || cast(p_partkey as string), 'other', CASE WHEN p_size % 3 = 0 THEN 'lncrna' ELSE 'protein_coding' END, 2 * p_partkey + CASE WHEN p_size % 2 = 0 THEN 1 ELSE -1 END FROM {part}""",
    "cds": """SELECT 'ENSG' || cast(o_custkey as string) AS gene, 'ENST' || cast(o_orderkey as string) AS enst,
        CASE WHEN o_custkey % 20 = 0 THEN '' ELSE 'S' || cast(o_custkey % 300 as string) END AS gene_symbol, 300 + o_orderkey * 31 % 900 AS cds_len FROM {orders}""",
    "peptides": """SELECT 'ENST' || cast(l_orderkey as string) AS enst, 'ENSP' || cast(l_partkey as string) || '_' || cast(l_suppkey as string) AS ensp,
        max(cast(l_quantity as bigint) * 7) AS pep_len FROM {lineitem} GROUP BY 1, 2""",
    "blocks": _blocks("doc_id", f"{_TID} || '.1'", "'T9.1'"),
    "letter_blocks": _blocks("-1 - doc_id", _LETTER, "'-'"),
    "aligned_blocks": f"""SELECT doc_id AS line_no, 'Query protein: ' || {_TID} || '.1' || chr(10) || 'Score ' || cast(doc_id % 200 as string) || '.5 bits' || chr(10)
        || {_TID} || ' 1 ' || substr(q, 1, cast(floor(length(q) / 2) as int)) || ' 40' || chr(10) || chr(10) || translate(substr(q, 1, cast(floor(length(q) / 2) as int)), 'QZ', '!*') || chr(10)
        || {_TID} || ' 41 ' || substr(q, cast(floor(length(q) / 2) as int) + 1) || ' 80' || chr(10) || chr(10) || translate(substr(q, cast(floor(length(q) / 2) as int) + 1), 'K', '-') || CASE WHEN doc_id % 4 = 0 THEN '   :X[' ELSE '' END || chr(10) AS text, true AS terminated,
        {_TID} || '.1' AS tid, q, translate(substr(q, 1, cast(floor(length(q) / 2) as int)), 'QZ', '!*') AS t1, translate(substr(q, cast(floor(length(q) / 2) as int) + 1), 'K', '-') AS t2, doc_id % 4 = 0 AS spliced
        FROM (SELECT *, {_LETTERS} AS q FROM {{documents}}) AS d WHERE length(q) >= 2""",
    "alignments": f"""SELECT 'T' || cast(doc_id as string) AS tid, doc_id, q AS qseq,
        CASE doc_id % 3 WHEN 0 THEN translate(q, 'QZ', '!X') WHEN 1 THEN substr(q, 2)
        ELSE substr(translate(q, 'K', 'X'), 1, cast(greatest(0, length(q) - doc_id % 5) as int)) END AS tseq FROM (SELECT *, {_LETTERS} AS q FROM {{documents}}) AS d WHERE length(q) >= 2""",
    "candidates": """SELECT DISTINCT species, 'T' || cast(doc_id as string) AS tid FROM (
        SELECT doc_id, explode(CASE doc_id % 3 WHEN 0 THEN array('sp_a') WHEN 1 THEN array('sp_b') ELSE array('sp_a', 'sp_b') END) AS species FROM {documents}) AS x""",
    "truth": "SELECT DISTINCT 'T' || cast(doc_id as string) AS tid FROM {labels} WHERE quality = 1",
    "whitelist": "SELECT DISTINCT 'T' || cast(doc_id as string) AS tid FROM {labels} WHERE toxic = 1",
    "synteny": """SELECT CASE WHEN p_partkey % 10 = 0 THEN 'other' ELSE 'Q' END || cast(p_partkey as string) AS gid, 'chr' || cast(p_partkey % 5 as string) AS chr,
        least(p_partkey * 97 % 200000, p_partkey * 97 % 200000 + CASE WHEN p_size % 2 = 1 THEN -1 ELSE 1 END * (500 + p_size * 40)) AS start,
        greatest(p_partkey * 97 % 200000, p_partkey * 97 % 200000 + CASE WHEN p_size % 2 = 1 THEN -1 ELSE 1 END * (500 + p_size * 40)) AS stop FROM {part}""",
    "exons": "SELECT 'Q' || cast(l_orderkey as string) AS tid FROM {lineitem}",
    "contigs": f"SELECT 'chr' || cast(doc_id as string) AS tname, {_LETTERS} AS seq FROM {{documents}}",
    "regions": """SELECT 'T' || cast(l_orderkey as string) AS gene, CASE WHEN l_returnflag = 'R' THEN '-' ELSE '+' END AS strand, 'chr' || cast(l_partkey as string) AS tname,
        (l_orderkey * 7919 + l_linenumber * 104729) % 9000 + 1 AS start1, (l_orderkey * 7919 + l_linenumber * 104729) % 9000 + 200 + l_suppkey % 50 AS end1 FROM {lineitem}""",
}


class Entities:
    """The entities over one folder of tables, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        """One given table."""
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SQL:
            raise AttributeError(name)
        text = SQL[name].replace("<G>", "")
        return self.spark.sql(text, **{t: self.table(t) for t in TABLES if f"{{{t}}}" in text})


def oracle(sql: str, *names: str, recursive: bool = False) -> str:
    """DuckDB SQL with the named entities as leading common table expressions."""
    texts = [f"{n} AS (" + SQL[n].replace("<G>", ", 'g'").replace("explode(", "unnest(").replace("array('", "list_value('").format(**{t: t for t in TABLES}) + ")" for n in names]
    return "WITH " + "RECURSIVE " * recursive + ",\n".join(texts) + "\n" + sql
