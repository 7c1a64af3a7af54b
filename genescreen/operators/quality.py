"""Quality filters of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genescreen.operators.blocks import alignment_metrics


def multi_disruption_quality(multi: DataFrame, counts: DataFrame, alignments: DataFrame, proteins: DataFrame, min_cov: float = 0.7, min_id: float = 0.05, min_aln_len: int = 200) -> DataFrame:
    """tid, stop, shift, align_len, protein_len, coverage, identity, reason of ids with several disruptions; reason `pass`, or what they fail."""
    lengths = proteins.select("tid", F.col("length").alias("known_len"))
    rows = multi.select("tid").join(counts.select("tid", "stop", "shift"), "tid", "left").join(alignment_metrics(alignments, proteins).drop("protein_len"), "tid", "left").join(lengths, "tid", "left")
    failed = F.concat_ws(";", F.when(F.col("align_len") < min_aln_len, "short_alignment"), F.when(F.col("coverage") < min_cov, "low_coverage"), F.when(F.col("identity") < min_id, "low_identity"))
    reason = F.when(F.col("align_len").isNull(), "missing_alignment").when(F.coalesce("known_len", F.lit(0)) == 0, "missing_length").when(failed == "", "pass").otherwise(failed)
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select("tid", zero("stop"), zero("shift"), zero("align_len"), F.coalesce("known_len", F.lit(0)).alias("protein_len"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"), F.coalesce("identity", F.lit(0.0)).alias("identity"), reason.alias("reason"))


def global_alignment_quality(ids: DataFrame, alignments: DataFrame, proteins: DataFrame, min_cov: float = 0.7, min_id: float = 0.3, min_aln_len: int = 200) -> DataFrame:
    """tid, align_len, protein_len, coverage, identity, status (pass or fail) of all ids; without an alignment or a protein they fail."""
    rows = ids.select("tid").join(alignment_metrics(alignments, proteins), "tid", "left").na.fill(0, ["align_len", "protein_len", "coverage", "identity"])
    passes = (F.col("align_len") >= min_aln_len) & (F.col("coverage") >= min_cov) & (F.col("identity") >= min_id)
    return rows.withColumn("status", F.when(passes, "pass").otherwise("fail"))
