"""Choice of one transcript per symbol or gene, annotation filters, and joins with lists and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def longest_per_symbol(proteins: DataFrame) -> DataFrame:
    """tid, gene_symbol, status: kept (longest of its symbol, ties by tid), skipped_duplicate, skipped_no_symbol. Sequences stay out of the shuffle."""
    keys = proteins.select("tid", "gene_symbol", "length")
    best = keys.where("gene_symbol <> ''").groupBy("gene_symbol").agg(F.min_by("tid", F.struct(-F.col("length"), "tid")).alias("best"))
    status = F.when(F.col("gene_symbol") == "", "skipped_no_symbol").when(F.col("tid") == F.col("best"), "kept").otherwise("skipped_duplicate")
    return keys.join(best, "gene_symbol", "left").select("tid", "gene_symbol", status.alias("status"))


def longest_per_symbol_whitelist(proteins: DataFrame, whitelist: DataFrame) -> DataFrame:
    """As longest_per_symbol over rows that aren't listed; listed rows are all kept. status and reason of each row."""
    rows = proteins.select("tid", "gene_symbol", "length").join(whitelist.select("tid").distinct().withColumn("listed", F.lit(True)), "tid", "left")
    best = rows.where("listed is null and gene_symbol <> ''").groupBy("gene_symbol").agg(F.min_by("tid", F.struct(-F.col("length"), "tid")).alias("best"))
    rows = rows.join(best, "gene_symbol", "left")
    listed, symbol = F.col("listed").isNotNull(), F.col("gene_symbol") != ""
    reason = F.when(listed & symbol, "whitelisted").when(listed, "whitelisted_no_symbol").when(~symbol, "no_symbol").when(F.col("tid") == F.col("best"), "longest").otherwise("duplicate")
    rows = rows.withColumn("reason", reason)
    status = F.when(F.col("reason") == "no_symbol", "skipped_no_symbol").when(F.col("reason") == "duplicate", "skipped_duplicate").otherwise("kept")
    return rows.select("tid", "gene_symbol", status.alias("status"), "reason")


def best_peptide(peptides: DataFrame) -> DataFrame:
    """Per transcript the longest peptide, ties by ensp; rows without a transcript are ignored."""
    best = peptides.where("enst <> ''").groupBy("enst").agg(F.min_by(F.struct("ensp", "pep_len"), F.struct(-F.col("pep_len"), "ensp")).alias("x"))
    return best.select("enst", "x.*")


def longest_cds_per_gene(cds: DataFrame, peptides: DataFrame) -> DataFrame:
    """Per gene the transcript of the longest CDS that has a peptide; ties: longer peptide, then smaller enst."""
    both = cds.where("gene <> '' and enst <> ''").join(best_peptide(peptides), "enst")
    best = both.groupBy("gene").agg(F.min_by(F.struct("enst", "ensp", "gene_symbol", "cds_len", "pep_len"), F.struct(-F.col("cds_len"), -F.col("pep_len"), "enst")).alias("x"))
    return best.select("gene", "x.*")


def chosen_peptides(chosen: DataFrame, peptides: DataFrame) -> DataFrame:
    """header and seq of the peptides that longest_cds_per_gene chose; the header is the transcript and what was chosen by."""
    tokens = [F.concat(F.lit(f" {name}="), F.col(column).cast("string")) for name, column in (("gene", "gene"), ("ensp", "ensp"), ("gene_symbol", "gene_symbol"), ("cds_len", "cds_len"), ("pep_len", "pep_len"))]
    # ids meet before sequences are read along
    return peptides.select("enst", "ensp", "seq").join(chosen, ["enst", "ensp"]).select(F.concat("enst", *tokens).alias("header"), "seq")


def longest_cds_counts(cds: DataFrame, peptides: DataFrame) -> DataFrame:
    """name, n: records read and used on the way to the longest CDS of each gene."""
    tagged = cds.select((F.col("gene") != "").alias("tagged"), "gene", "enst")
    with_protein = tagged.where("tagged and enst <> ''").join(best_peptide(peptides).select("enst", F.lit(True).alias("has")), "enst")
    picked = longest_cds_per_gene(cds, peptides)
    rows = [
        peptides.agg(F.count("*").alias("pep_total_records"), F.count_if(F.col("enst") != "").alias("pep_with_transcript_tag")),
        tagged.agg(F.count("*").alias("cds_total_records"), F.count_if("tagged").alias("cds_with_gene_tag")),
        with_protein.agg(F.count("*").alias("cds_with_protein")),
        picked.agg(F.count("*").alias("genes_picked")),
        peptides.select("enst", "ensp").join(picked, ["enst", "ensp"]).agg(F.count("*").alias("proteins_written")),
    ]
    out = None
    for row in rows:
        named = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in row.columns])).alias("x")).select("x.*")
        out = named if out is None else out.unionByName(named)
    return out


def split_patterns(patterns: str) -> list[str]:
    """Patterns apart: at |, or at commas where there is no |."""
    return [p for p in patterns.split("|" if "|" in patterns else ",") if p]


def first_pattern(text: Column, patterns: list[str]) -> Column:
    """The first pattern that is found in the text whatever the case; null if none is, or the text is missing. One regular expression goes before all."""
    if not patterns:
        return F.lit(None).cast("string")
    any_of = text.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))
    return F.when(any_of, F.coalesce(*[F.when(text.rlike(f"(?i){p}"), p) for p in patterns]))


def match_patterns(genes: DataFrame, patterns: list[str], descriptions: DataFrame) -> DataFrame:
    """tid, gene_id, gene_symbol, matched_pattern, source of genes that a pattern is found in.

    The symbol goes before the gene id and that before the description, which is looked up by gene id, else by symbol; an entry of the
    gene id counts even if its text is empty. Descriptions have one row a key.
    """
    by_id = descriptions.select(F.col("key").alias("gene_id"), F.col("text").alias("id_text"), F.lit(True).alias("has_id"))
    by_symbol = descriptions.select(F.col("key").alias("gene_symbol"), F.col("text").alias("symbol_text"))
    rows = genes.select("tid", "gene_id", "gene_symbol").join(by_id, "gene_id", "left").join(by_symbol, "gene_symbol", "left")
    text = F.when(F.col("has_id").isNotNull(), F.col("id_text")).otherwise(F.col("symbol_text"))
    found = [(first_pattern(c, patterns), name) for c, name in ((F.col("gene_symbol"), "gene_symbol"), (F.col("gene_id"), "gene_id"), (text, "description"))]
    pattern = F.coalesce(*[c for c, _ in found])
    source = F.coalesce(*[F.when(c.isNotNull(), name) for c, name in found])
    return rows.select("tid", "gene_id", "gene_symbol", pattern.alias("matched_pattern"), source.alias("source")).where("matched_pattern is not null")


def search_ids(df: DataFrame, term: str) -> DataFrame:
    """Rows whose tid holds the term whatever the case."""
    return df.where(F.lower("tid").contains(term.lower()))


def exon_counts(exons: DataFrame) -> DataFrame:
    """exons per transcript, and whether it is intronless (one at most)."""
    return exons.groupBy("tid").agg(F.count("*").alias("n_exons")).withColumn("intronless", F.col("n_exons") <= 1)


def intronless_or_biotype(genes: DataFrame, descriptions: DataFrame, biotypes: DataFrame, exons: DataFrame, patterns: list[str], exclude: list[str], strip_version: bool = False) -> DataFrame:
    """Report rows of genes that a pattern is found in, whose gene or transcript biotype is excluded, or that have one exon; up to three a gene. Of a transcript's excluded biotypes the last by line_no counts.

    strip_version: ids meet without a last `.` and digits, as those of sequences have versions where annotation has none.
    """
    plain = lambda df: df.withColumn("tid", F.regexp_replace("tid", r"\.\d+$", "")) if strip_version else df
    biotypes, exons = plain(biotypes), plain(exons)
    excluded = [x.strip().lower() for x in exclude if x.strip()]
    by_gene = F.when(F.lower("gene_biotype").isin(excluded), F.concat(F.lit("gene_biotype:"), "gene_biotype"))
    by_transcript = F.when(F.lower("transcript_biotype").isin(excluded), F.concat(F.lit("transcript_biotype:"), "transcript_biotype"))
    hit = biotypes.select("tid", F.coalesce(by_gene, by_transcript).alias("matched_pattern"), "line_no").where("matched_pattern is not null")
    hit = hit.groupBy("tid").agg(F.max_by("matched_pattern", "line_no").alias("matched_pattern"))
    keys = plain(genes.select("tid", "gene_id", "gene_symbol", F.col("tid").alias("own")))
    of_type = keys.join(hit, "tid").select(F.col("own").alias("tid"), "gene_id", "gene_symbol", "matched_pattern", F.lit("biotype").alias("source"))
    single = keys.join(exon_counts(exons).where("intronless"), "tid", "left_semi").select(F.col("own").alias("tid"), "gene_id", "gene_symbol", F.lit("intronless").alias("matched_pattern"), F.lit("gtf").alias("source"))
    return match_patterns(genes, patterns, descriptions).unionByName(of_type).unionByName(single)


def conserved_synteny(best: DataFrame, synteny: DataFrame, min_overlap: float = 0.1) -> DataFrame:
    """tid, conserved: some row lies on the listed chromosome and overlaps the listed interval by min_overlap of both lengths."""
    rows = best.select(F.col("gene").alias("tid"), "tname", F.least("tstart", "tend").alias("s"), F.greatest("tstart", "tend").alias("e"))
    rows = rows.join(synteny.select(F.col("gid").alias("tid"), "chr", "start", "stop"), "tid", "left")
    overlap = F.greatest(F.lit(0), F.least("e", "stop") - F.greatest("s", "start"))
    share = lambda a, b: overlap / F.greatest(F.lit(1), F.col(b) - F.col(a))
    ok = (F.col("tname") == F.col("chr")) & (share("s", "e") >= min_overlap) & (share("start", "stop") >= min_overlap)
    return rows.groupBy("tid").agg(F.max(F.coalesce(ok, F.lit(False))).alias("conserved"))


def keep_listed(df: DataFrame, ids: DataFrame, key: str = "tid") -> DataFrame:
    """Rows whose key is listed."""
    return df.join(ids.select(key), key, "left_semi")


def subtract_ids(df: DataFrame, ids: DataFrame, key: str = "tid") -> DataFrame:
    """Rows whose key isn't listed."""
    return df.join(ids.select(key), key, "left_anti")


def pending_jobs(jobs: DataFrame, done: DataFrame) -> DataFrame:
    """Jobs without an output."""
    return subtract_ids(jobs, done, "gene")


def intersect_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct ids of both."""
    return a.select("tid").intersect(b.select("tid"))


def union_ids(*lists: DataFrame) -> DataFrame:
    """Distinct ids of any."""
    out = lists[0].select("tid")
    for x in lists[1:]:
        out = out.unionByName(x.select("tid"))
    return out.distinct()


def merge_whitelist(ids: DataFrame, whitelist: DataFrame, only_if_any: bool = True) -> DataFrame:
    """Ids and all listed ones; with only_if_any, an empty list of ids stays empty."""
    listed = whitelist.select("tid")
    if only_if_any:
        listed = listed.crossJoin(F.broadcast(ids.limit(1).select(F.lit(1).alias("any")))).select("tid")
    return union_ids(ids, listed)


def failure_counts(failures: DataFrame) -> DataFrame:
    """Rows per reason, the most frequent first."""
    return failures.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")
