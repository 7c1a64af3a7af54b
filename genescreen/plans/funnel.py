"""The candidate funnel: one wide table by tid, every list a flag of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genescreen.operators import blocks as B
from genescreen.operators import hits as H
from genescreen.operators import quality as Q
from genescreen.operators import select as S
from genescreen.sources.sinks import stored


@dataclass(frozen=True)
class Thresholds:
    """Switches and thresholds of all filters."""

    prefilter: bool = True
    family: bool = True
    # fixed values: the default patterns, switches and thresholds
    family_patterns: str = "olfactory receptor|vomeronasal|zinc finger|^OR|^V1R|^V2R|^TAAR|^ZNF|^ZFP"
    redundancy: bool = True
    min_aln_len: int = 30
    min_cov: float = 0.3
    min_id: float = 0.3
    min_mapq: int = 0
    copy_cov: float = 0.8
    target_gap: int = 10_000
    false_positive: bool = True
    end_frac: float = 0.9
    flank_size: int = 30
    flank_th: float = 0.2
    overall_th: float = 0.1
    flank_mode: str = "and"
    id_rule: str = "as_coded"
    multi_quality: bool = True
    multi_min_cov: float = 0.7
    multi_min_id: float = 0.05
    multi_min_aln_len: int = 200
    global_quality: bool = True
    global_min_cov: float = 0.7
    global_min_id: float = 0.3
    global_min_aln_len: int = 200


@dataclass
class Inputs:
    """Tables of one run; descriptions has key and text, whitelist tid."""

    blocks: DataFrame
    proteins: DataFrame
    hits: DataFrame
    alignments: DataFrame
    descriptions: DataFrame
    whitelist: DataFrame


def _merged(rows: DataFrame, start: Column, base: Column, removed: list[str], name: str) -> DataFrame:
    """Flag `name`: in the list that `start` begins, each of `removed` thins out, and the listed ids come back to while it isn't empty.

    While it isn't empty after step k the list is what `base` leaves, with all listed ids; so step k leaves something if step k - 1 did
    and either of the two has an id that k doesn't remove. That takes one aggregation for all steps.
    """
    left, sums = base, [F.max(start).alias("any_0")]
    for k, c in enumerate(removed, 1):
        left = left & ~F.col(c)
        sums.append(F.max(left | (F.col("listed") & ~F.col(c))).alias(f"any_{k}"))
    going = F.lit(True)
    for k in range(len(removed) + 1):
        going = going & F.coalesce(F.col(f"any_{k}"), F.lit(False))
    return rows.crossJoin(F.broadcast(rows.agg(*sums))).withColumn(name, going & (left | (F.col("listed") & start))).drop(*[f"any_{k}" for k in range(len(removed) + 1)])


def run_funnel(x: Inputs, t: Thresholds = Thresholds()) -> DataFrame:
    """One row per id that is putative or listed, with flags; `unitary` and `high_confidence` are the lists that the funnel ends in.

    All tables are reduced to (tid, numbers) before they are joined, and all joins are on tid. The table of flags is written after each
    part of the funnel, since the lists of the next part are taken from it several times.
    """
    signs = {"signs": B.sign_kinds(id_rule=t.id_rule)} if t.false_positive else {}
    all_counts = stored(B.count_mutations(x.blocks, **signs))
    proteins = stored(x.proteins.select(*[c for c in ("tid", "gene_id", "gene_symbol", "length") if c in x.proteins.columns]))
    alignments = stored(B.measured(x.alignments, t.flank_size)) if t.false_positive or t.multi_quality or t.global_quality else x.alignments
    loads = B.classify_mutation_load(all_counts)
    flags = loads.groupBy("tid").agg(*[F.max(F.col("load") == k).alias(k) for k in ("putative", "single", "multi")])
    listed = x.whitelist.select("tid").distinct().withColumn("listed", F.lit(True))
    valid = S.longest_per_symbol_whitelist(proteins, x.whitelist).where("status = 'kept'") if t.prefilter else proteins
    rows = flags.join(valid.select("tid").distinct().withColumn("valid", F.lit(True)), "tid", "left").join(listed, "tid", "full")

    def flagged(df: DataFrame, ids: DataFrame, name: str) -> DataFrame:
        return df.join(ids.select("tid").distinct().withColumn(name, F.lit(True)), "tid", "left")

    if t.family:
        rows = flagged(rows, S.match_patterns(proteins, S.split_patterns(t.family_patterns), x.descriptions), "family")
    if t.redundancy:
        copies = H.full_copies(H.filter_hits(x.hits, t.min_aln_len, t.min_cov, t.min_id, t.min_mapq), t.copy_cov, t.target_gap)
        rows = flagged(rows, copies.where("full_copy_count >= 2").select(F.col("qname").alias("tid")), "redundant")
    for c in ("putative", "single", "multi", "valid", "listed", "family", "redundant"):
        rows = rows.withColumn(c, F.coalesce(F.col(c), F.lit(False)) if c in rows.columns else F.lit(False))
    # after each filter the listed ids come back, unless nothing is left of the list by then
    start = F.col("listed") | (F.col("putative") & F.col("valid"))
    rows = stored(_merged(stored(rows), start, F.col("putative") & F.col("valid"), ["family", "redundant"], "unitary"))
    single = rows.where("unitary and single").select("tid")
    multi = rows.where("unitary and multi").select("tid")
    if t.false_positive:
        found = S.union_ids(
            S.keep_listed(all_counts.where(F.size("signs") > 0), single),  # all four lists of single ids
            B.low_identity_flanks(alignments, single, t.flank_size, t.flank_th, t.overall_th, t.flank_mode), B.end_mutation(alignments, t.end_frac),
        )
        rows = flagged(rows, found, "false_positive")
    if t.multi_quality:
        counts = all_counts.groupBy("tid").agg(F.max_by(F.struct("stop", "shift"), "line_no").alias("x")).select("tid", "x.*")
        low = Q.multi_disruption_quality(multi, counts, alignments, proteins, t.multi_min_cov, t.multi_min_id, t.multi_min_aln_len)
        rows = flagged(rows, low.where("reason <> 'pass'"), "low_multi")
    if t.global_quality:
        good = Q.global_alignment_quality(rows.where("unitary"), alignments, proteins, t.global_min_cov, t.global_min_id, t.global_min_aln_len)
        rows = flagged(rows, good.where("status = 'fail'"), "low_global")
    for c in ("false_positive", "low_multi", "low_global"):
        rows = rows.withColumn(c, F.coalesce(F.col(c), F.lit(False)) if c in rows.columns else F.lit(False))
    return _merged(stored(rows), F.col("unitary"), F.col("unitary") & ~F.col("listed"), ["false_positive", "low_multi", "low_global"], "high_confidence")
