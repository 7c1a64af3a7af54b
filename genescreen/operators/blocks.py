"""Prediction blocks: counts, scores, alignments, mutations, and predicates of single disruptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genescreen.functions.sequences import block_score, bound, first_mutation, flank_identities, once, places, positional_identity, query_id, report_identity, shift_count, stop_count


def count_mutations(blocks: DataFrame, **more: Column) -> DataFrame:
    """tid, stop, shift of every block that names a query, with its line_no, and what `more` takes from text in the same pass."""
    texts = once(blocks.select("line_no", "text"), "text")
    return texts.select(query_id(F.col("text")).alias("tid"), stop_count(F.col("text")).alias("stop"), shift_count(F.col("text")).alias("shift"), "line_no", *[c.alias(name) for name, c in more.items()]).where("tid <> ''")


def parse_score(blocks: DataFrame) -> DataFrame:
    """tid and score of every block that names a query."""
    return once(blocks.select("line_no", "text"), "text").select(query_id(F.col("text")).alias("tid"), block_score(F.col("text")).alias("score"), "line_no").where("tid <> ''")


def classify_mutation_load(counts: DataFrame) -> DataFrame:
    """Distinct (tid, load): putative (one disruption or more), single (one), multi (two or more); an id with several blocks may be in several."""
    total = F.col("stop") + F.col("shift")
    loads = F.array_compact(F.array(F.when(total >= 1, "putative"), F.when(total == 1, "single"), F.when(total >= 2, "multi")))
    return counts.select("tid", F.explode(loads).alias("load")).distinct()


def extract_alignment(blocks: DataFrame, keep: str = "pipeline") -> DataFrame:
    """tid, qseq, tseq: of each line that starts with the id before its first dot and has three tokens, the third, and what stands two lines below.

    keep: `pipeline` keeps letters and ! of the target, and needs the label at a line's start; `report` keeps * and - too, and takes the
    line one below where there is none two below. A terminated block has its // line as its last. Parts are joined in order.
    """
    rows = _paired(blocks, keep)
    if keep != "report":
        rows = once(rows.select("line_no", "tid", "pair"), "pair").where("pair.n > 0")
    return rows.select("tid", "pair.qseq", "pair.tseq", "line_no")


def _paired(blocks: DataFrame, keep: str) -> DataFrame:
    """line_no, text, tid of blocks that name a query, and `pair`: qseq, tseq and the number n of lines they come from, see extract_alignment()."""
    report = keep == "report"
    lines_of = F.regexp_replace("text", r"\n\z", "")
    text = F.col("text") if report else F.when(F.coalesce(F.col("terminated"), F.lit(True)), F.concat(lines_of, F.lit("\n//"))).otherwise(lines_of)
    tid = query_id(F.col("text")) if report else F.regexp_extract("text", r"(?m)^Query protein:\s*(\S+)", 1)
    clean = lambda x: F.regexp_replace(x, r"[^\p{L}!*-]" if report else r"[^\p{L}!]", "")
    tokens = lambda line: F.split(F.trim(line), r"\s+")

    def parts(lines: Column) -> Column:
        n = F.size(lines)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(lines, i).startswith(F.substring_index("tid", ".", 1)) & (F.size(tokens(F.get(lines, i))) >= 3))

        def of(found: Column) -> Column:
            full, late = F.filter(found, lambda i: i + 2 < n), F.filter(found, lambda i: i + 2 >= n)
            q = F.array_join(F.transform(full, lambda i: F.get(tokens(F.get(lines, i)), 2)), "")
            t = F.array_join(F.transform(full, lambda i: clean(F.get(lines, i + 2))), "")
            # once a part has been taken, a line too near the block's end gives what stands one below it
            below = F.array_join(F.transform(late, lambda i: clean(F.coalesce(F.get(lines, i + 1), F.lit("")))), "") if report else F.lit("")
            return F.struct(q.alias("qseq"), F.concat(t, F.when(F.size(full) > 0, below).otherwise(F.lit(""))).alias("tseq"), F.size(full).alias("n"))

        return bound(starts, of)

    texts = once(blocks.select("line_no", "text", *([] if report else ["terminated"])), "text")
    rows = texts.select("line_no", "text", tid.alias("tid"), text.alias("whole")).where("tid <> ''")
    return rows.select("line_no", "text", "tid", bound(F.split("whole", "\n"), parts).alias("pair"))


def measured(alignments: DataFrame, flank: int = 30) -> DataFrame:
    """Alignments as numbers: tid, query_len, align_len, identity, mut_pos, mut_type, flank_before, flank_after; each text is evaluated once.

    What has these numbers is returned as it is, so a table of them stands for the alignments wherever only numbers are asked for.
    """
    if "align_len" in alignments.columns:
        return alignments
    q, t, at = F.col("qseq"), F.col("tseq"), F.col("mut_pos")
    rows = once(with_first_mutation(once(alignments.select("tid", "qseq", "tseq"), "qseq", "tseq")), "qseq", "tseq", "mut_pos", "mut_type")
    before, after = flank_identities(q, t, at, flank)
    return rows.select("tid", F.length(q).alias("query_len"), F.least(F.length(q), F.length(t)).alias("align_len"), positional_identity(q, t).alias("identity"), "mut_pos", "mut_type", before.alias("flank_before"), after.alias("flank_after"))


def alignment_metrics(alignments: DataFrame, proteins: DataFrame) -> DataFrame:
    """align_len, protein_len, coverage and identity of each aligned tid; an unknown protein has length and coverage 0."""
    joined = measured(alignments).select("tid", "align_len", "identity").join(proteins.select("tid", F.col("length").alias("protein_len")), "tid", "left")
    length = F.coalesce("protein_len", F.lit(0))
    return joined.select("tid", "align_len", length.alias("protein_len"), F.when(length > 0, F.col("align_len") / F.greatest(F.lit(1), length)).otherwise(F.lit(0.0)).alias("coverage"), "identity")


def with_first_mutation(alignments: DataFrame) -> DataFrame:
    """mut_pos (0-based) and mut_type of each alignment; nulls without one."""
    at, kind = first_mutation(F.col("tseq"))
    return alignments.withColumn("mut_pos", at).withColumn("mut_type", kind)


def with_flank_identities(alignments: DataFrame, flank: int = 30) -> DataFrame:
    """Alignments with a first mutation, and the identities of its flanks."""
    rows = with_first_mutation(alignments).where("mut_pos is not null")
    before, after = flank_identities(F.col("qseq"), F.col("tseq"), F.col("mut_pos"), flank)
    return rows.withColumn("flank_before", before).withColumn("flank_after", after)


def mutation_positions(parsed: DataFrame) -> DataFrame:
    """tid, ordinal, position (1-based), type of all mutations of parsed blocks with both sequences: stops, then frameshifts, then a splice stop."""
    def kind(at: Column, name: str) -> Column:
        return F.transform(at, lambda p: F.struct(p.alias("position"), F.lit(name).alias("type")))

    splice = F.when(F.col("spliced"), F.array(F.struct(F.lit(None).cast("int").alias("position"), F.lit("splice_stop").alias("type")))).otherwise(F.array().cast("array<struct<position:int,type:string>>"))
    rows = once(parsed.select("tid", F.col("text").contains(":X[").alias("spliced"), "qseq", "tseq"), "qseq", "tseq").where("qseq <> '' and tseq <> ''")
    rows = rows.select("tid", "spliced", places(F.col("tseq"), "*").alias("stops"), places(F.col("tseq"), "!").alias("shifts"))
    rows = rows.select("tid", F.posexplode(F.concat(kind(F.col("stops"), "stop"), kind(F.col("shifts"), "frameshift"), splice)).alias("ordinal", "m"))
    return rows.select("tid", "ordinal", "m.position", "m.type")


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """All that a report shows of each block: tid, score, stops, shifts, sequences, identity in percent and length; one pass, nothing is shuffled."""
    text, q, t = F.col("text"), F.col("qseq"), F.col("tseq")
    rows = _paired(blocks, "report").select("line_no", "text", "tid", block_score(text).alias("score"), stop_count(text).alias("stop"), shift_count(text).alias("shift"), "pair.qseq", "pair.tseq")
    return rows.withColumn("identity", report_identity(q, t)).withColumn("length", F.when((q != "") & (t != ""), F.length(q)).otherwise(0))


# predicates of ids with one disruption


def sign_kinds(max_tail: int = 50, id_rule: str = "as_coded") -> Column:
    """The signs of a false positive in a block's text, see block_signs()."""
    text, tid = F.col("text"), query_id(F.col("text"))
    translated = F.regexp_extract(text, r">(\S+?)\.sp\.tr" if id_rule == "documented" else r">(\S)", 1)
    squeezed = F.regexp_replace(text, r"\s+", "")
    short = lambda pattern, group: F.length(F.regexp_extract(squeezed, pattern, group)).between(1, max_tail - 1)
    found = text.contains(".sp.tr") & (translated == tid)
    signs = {
        "splicing_stop": text.contains(":X["),
        "splicing_shift": text.contains("!") & text.rlike(r"![A-Z]?\s{3}|\s{3}[A-Z]?!"),
        "ending_stop": found & short(r"^[^*]*\*(\S+)$", 1),
        "ending_shift": found & short(r"(.*)tr(\S+)$", 2),
    }
    return F.array_compact(F.array(*[F.when(where, kind) for kind, where in signs.items()]))


def block_signs(blocks: DataFrame, max_tail: int = 50, id_rule: str = "as_coded") -> DataFrame:
    """tid and kind of every sign of a false positive in a block, in one pass over the texts.

    splicing_stop: the block holds :X[. splicing_shift: a ! touches three blanks, directly or with a letter between. ending_stop: the
    translation (`.sp.tr`), white space removed, has fewer than max_tail characters, but some, after its first *. ending_shift: it has
    as many after its last `tr`; no ! is needed. All are of the block's query. For the last two the id before `.sp.tr` must be the
    query's too, if id_rule is `documented`; `as_coded` takes what follows the first > for one character alone, so only queries
    of one character are ever found.
    """
    return once(blocks.select("text"), "text").select(query_id(F.col("text")).alias("tid"), F.explode(sign_kinds(max_tail, id_rule)).alias("kind")).where("tid <> ''")


def _signed(blocks: DataFrame, single: DataFrame, kind: str, *options) -> DataFrame:
    rows = block_signs(blocks, *options).where(F.col("kind") == kind)
    return rows.join(single.select("tid"), "tid", "left_semi").select("tid").distinct()


def splicing_stop(blocks: DataFrame, single: DataFrame) -> DataFrame:
    """Single ids with a splicing_stop sign."""
    return _signed(blocks, single, "splicing_stop")


def splicing_shift(blocks: DataFrame, single: DataFrame) -> DataFrame:
    """Single ids with a splicing_shift sign."""
    return _signed(blocks, single, "splicing_shift")


def ending_stop(blocks: DataFrame, single: DataFrame, max_tail: int = 50, id_rule: str = "as_coded") -> DataFrame:
    """Single ids with an ending_stop sign."""
    return _signed(blocks, single, "ending_stop", max_tail, id_rule)


def ending_shift(blocks: DataFrame, single: DataFrame, max_tail: int = 50, id_rule: str = "as_coded") -> DataFrame:
    """Single ids with an ending_shift sign."""
    return _signed(blocks, single, "ending_shift", max_tail, id_rule)


def low_identity_flanks(alignments: DataFrame, single: DataFrame, flank: int = 30, flank_th: float = 0.2, overall_th: float = 0.1, mode: str = "and") -> DataFrame:
    """tid and mut_type of single ids whose first mutation stands in badly aligned flanks of a badly aligned pair."""
    rows = measured(alignments.join(single.select("tid"), "tid", "left_semi"), flank).where("mut_pos is not null")
    before, after = F.col("flank_before") < flank_th, F.col("flank_after") < flank_th
    low = (before | after) if mode == "or" else (before & after)
    return rows.where(low & (F.col("identity") < overall_th)).select("tid", "mut_type")


def end_mutation(alignments: DataFrame, min_frac: float = 0.9) -> DataFrame:
    """tid, mut_pos, query_len, fraction of alignments whose first mutation stands in the last part of the query."""
    rows = measured(alignments).where("mut_pos is not null and query_len > 0")
    rows = rows.select("tid", "mut_pos", "query_len", ((F.col("mut_pos") + 1) / F.col("query_len")).alias("fraction"))
    return rows.where(F.col("fraction") >= min_frac)
