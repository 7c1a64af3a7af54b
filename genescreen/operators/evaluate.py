"""Evaluation against a truth list: features, threshold grids, recall and diagnosis."""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genescreen.functions.sequences import first_mutation, flank_identities, positional_identity
from genescreen.operators.blocks import alignment_metrics


def _flag(df: DataFrame, ids: DataFrame, name: str, keys: list[str]) -> DataFrame:
    return df.join(ids.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def candidate_features(unitary: DataFrame, counts: DataFrame, alignments: DataFrame, proteins: DataFrame, truth: DataFrame, multi: DataFrame) -> DataFrame:
    """One row per candidate: in_ref, stop, shift, total, align_len, protein_len, coverage, identity, multi."""
    rows = unitary.select("tid").distinct().join(counts.select("tid", "stop", "shift"), "tid", "left").join(alignment_metrics(alignments, proteins).drop("protein_len"), "tid", "left").join(proteins.select("tid", F.col("length").alias("protein_len")), "tid", "left")
    rows = rows.na.fill(0, ["stop", "shift", "align_len", "protein_len", "coverage", "identity"])
    rows = _flag(_flag(rows, truth, "in_ref", ["tid"]), multi, "multi", ["tid"])
    return rows.select("tid", "in_ref", "stop", "shift", (F.col("stop") + F.col("shift")).alias("total"), "align_len", "protein_len", "coverage", "identity", "multi")


def threshold_suggestions(features: DataFrame, aln: tuple = (50.0, 100.0, 150.0, 200.0), cov: tuple = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8), ident: tuple = (0.3, 0.4, 0.5, 0.6, 0.7)) -> DataFrame:
    """Per combination of thresholds, what of the truth among multi-disruption candidates is kept and what of the rest is dropped.

    A cumulative cube: each candidate is in one cell, that of how many thresholds of each kind it reaches. Cells are counted map-side
    and their sums over all cells from one on, kind by kind, are what reaches a combination. Sizes follow from the thresholds alone.
    """
    spark = features.sparkSession
    kinds = [("align_len", "min_aln_len", sorted(set(aln))), ("coverage", "min_cov", sorted(set(cov))), ("identity", "min_id", sorted(set(ident)))]
    cell = [sum((F.coalesce(F.col(c) >= x, F.lit(False)).cast("int") for x in values), F.lit(0)).alias(f"k{n}") for n, (c, _, values) in enumerate(kinds)]
    names = [f"k{n}" for n in range(len(kinds))]
    cells = features.where("multi").groupBy(*cell).agg(F.count_if("in_ref").alias("ref"), F.count_if(~F.col("in_ref")).alias("nonref"))
    every = spark.createDataFrame(list(product(*(range(len(values) + 1) for *_, values in kinds))), ", ".join(f"{n} int" for n in names))
    cube = every.join(cells, names, "left").na.fill(0)
    for n in names:
        reached = Window.partitionBy(*(x for x in names if x != n)).orderBy(F.desc(n)).rowsBetween(Window.unboundedPreceding, 0)
        cube = cube.withColumn("ref", F.sum("ref").over(reached)).withColumn("nonref", F.sum("nonref").over(reached))
    totals = cells.agg(F.coalesce(F.sum("ref"), F.lit(0)).alias("ref_total"), F.coalesce(F.sum("nonref"), F.lit(0)).alias("nonref_total"))
    grid = spark.createDataFrame([(*(values.index(x) + 1 for x, (*_, values) in zip(g, kinds)), *g) for g in product(aln, cov, ident)], ", ".join([*(f"{n} int" for n in names), *(f"{c} double" for _, c, _ in kinds)]))
    sums = grid.join(cube, names).crossJoin(F.broadcast(totals)).select("min_aln_len", "min_cov", "min_id", F.col("ref").alias("ref_kept"), "ref_total", (F.col("nonref_total") - F.col("nonref")).alias("nonref_dropped"), "nonref_total")
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    kept, dropped = rate("ref_kept", "ref_total"), rate("nonref_dropped", "nonref_total")
    return sums.select("min_aln_len", "min_cov", "min_id", kept.alias("keep_ref"), dropped.alias("drop_nonref"), "ref_kept", "ref_total", "nonref_dropped", "nonref_total", (kept + dropped).alias("score"))


def tuning_features(unitary: DataFrame, alignments: DataFrame, proteins: DataFrame, flank: int = 30) -> DataFrame:
    """Per (species, tid) of `unitary` (with is_one, is_multi): what apply_params needs. Sequences are reduced to numbers before the joins."""
    at, kind = first_mutation(F.col("tseq"))
    before, after = flank_identities(F.col("qseq"), F.col("tseq"), F.col("mut_pos"), flank)
    keys = [c for c in ("species", "tid") if c in alignments.columns]
    numbers = alignments.withColumn("mut_pos", at).withColumn("mut_type", kind).select(*keys, F.least(F.length("qseq"), F.length("tseq")).alias("aln_len"), positional_identity(F.col("qseq"), F.col("tseq")).alias("ident"), "mut_pos", "mut_type", before.alias("flank_bef"), after.alias("flank_aft"))
    rows = unitary.join(numbers, keys, "left").join(proteins.select("tid", F.col("length").alias("protein_len")), "tid", "left")
    length, has = F.coalesce("protein_len", F.lit(0)), F.col("mut_pos").isNotNull()
    over = lambda x: F.when(length > 0, x / F.greatest(F.lit(1), length)).otherwise(F.lit(0.0))
    return rows.select(
        "species", "tid", F.coalesce("aln_len", F.lit(0)).alias("aln_len"), over(F.coalesce("aln_len", F.lit(0))).alias("cov"), F.coalesce("ident", F.lit(0.0)).alias("ident"),
        F.coalesce("mut_pos", F.lit(-1)).alias("mut_pos"), F.coalesce("mut_type", F.lit("")).alias("mut_type"), F.when(has, F.col("flank_bef")).otherwise(F.lit(1.0)).alias("flank_bef"), F.when(has, F.col("flank_aft")).otherwise(F.lit(1.0)).alias("flank_aft"),
        F.when(has, over(F.col("mut_pos") + 1)).otherwise(F.lit(0.0)).alias("mut_frac"), "is_one", "is_multi",
    )


#: The default grid of the tuner.
GRID = {"low_mode": ["or", "and"], "low_flank": [0.3, 0.4], "low_overall": [0.2, 1.0], "end_frac": [0.9, 0.95], "multi_aln": [200, 300], "multi_cov": [0.6, 0.7], "multi_id": [0.05, 0.1], "global_filter": ["off", "150:0.8:0.3", "200:0.8:0.3"]}


def parameter_grid(spark: SparkSession, grid: dict[str, list] | None = None) -> DataFrame:
    """All combinations with their number; the last parameter changes fastest."""
    grid = grid or GRID
    rows = []
    for k, x in enumerate(product(*(grid[c] for c in GRID))):
        g = (None, None, None) if x[-1] == "off" else tuple(map(float, x[-1].split(":")))
        rows.append((k, x[0], *map(float, x[1:-1]), x[-1], *g))
    return spark.createDataFrame(rows, "combo int, low_mode string, low_flank double, low_overall double, end_frac double, multi_aln double, multi_cov double, multi_id double, global_filter string, g_aln double, g_cov double, g_id double")


def survives() -> Column:
    """Whether a candidate is kept under a combination of parameters."""
    before, after = F.col("flank_bef") < F.col("low_flank"), F.col("flank_aft") < F.col("low_flank")
    low = F.when(F.col("low_mode") == "or", before | after).otherwise(before & after) & (F.col("ident") < F.col("low_overall")) & (F.col("mut_pos") >= 0)
    single_bad = F.col("is_one") & (low | (F.col("mut_frac") >= F.col("end_frac")))
    multi_bad = F.col("is_multi") & ~((F.col("aln_len") >= F.col("multi_aln")) & (F.col("cov") >= F.col("multi_cov")) & (F.col("ident") >= F.col("multi_id")))
    global_ok = F.col("g_aln").isNull() | ((F.col("aln_len") >= F.col("g_aln")) & (F.col("cov") >= F.col("g_cov")) & (F.col("ident") >= F.col("g_id")))
    return ~single_bad & ~multi_bad & global_ok


def apply_params(features: DataFrame, grid: DataFrame, false_positives: DataFrame | None = None) -> DataFrame:
    """combo, species, tid of all survivors; (species, tid) of `false_positives` are out under every combination. The grid is broadcast: its size is its parameters' alone."""
    rows = features if false_positives is None else features.join(false_positives.select("species", "tid"), ["species", "tid"], "left_anti")
    return rows.crossJoin(F.broadcast(grid)).where(survives()).select("combo", "species", "tid")


def survival_bits(grid: list) -> list[Column]:
    """Per 64 rows of a collected parameter_grid() a long: bit k is set if a candidate is kept under row k.

    Parameters that are tested together are tested once for each of their values; the rows that such a test rules out are constants.
    """

    def ruled_out(parameters: list[str], fails: Callable[..., Column]) -> list[tuple[Column, list[int]]]:
        rows: dict[tuple, list[int]] = {}
        for k, g in enumerate(grid):
            rows.setdefault(tuple(g[c] for c in parameters), []).append(k)
        return [(fails(*values), ks) for values, ks in rows.items()]

    def low(mode: str, flank: float, overall: float) -> Column:
        before, after = F.col("flank_bef") < flank, F.col("flank_aft") < flank
        return F.col("is_one") & ((before | after) if mode == "or" else (before & after)) & (F.col("ident") < overall) & (F.col("mut_pos") >= 0)

    def short(aln: float | None, cov: float, ident: float) -> Column:
        return F.lit(False) if aln is None else ~((F.col("aln_len") >= aln) & (F.col("cov") >= cov) & (F.col("ident") >= ident))

    tests = ruled_out(["low_mode", "low_flank", "low_overall"], low)
    tests += ruled_out(["end_frac"], lambda x: F.col("is_one") & (F.col("mut_frac") >= x))
    tests += ruled_out(["multi_aln", "multi_cov", "multi_id"], lambda *x: F.col("is_multi") & short(*x))
    tests += ruled_out(["g_aln", "g_cov", "g_id"], short)

    def signed(ks: list[int], word: int) -> int:
        bits = sum(1 << k % 64 for k in ks if k // 64 == word)
        return bits - (1 << 64) if bits >> 63 else bits

    out = []
    for word in range(-(-len(grid) // 64)):
        gone = F.lit(0).cast("long")
        for fails, ks in tests:
            if any(k // 64 == word for k in ks):
                gone = gone.bitwiseOR(F.when(fails, F.lit(signed(ks, word)).cast("long")).otherwise(F.lit(0).cast("long")))
        out.append(F.bitwise_not(gone).bitwiseAND(F.lit(signed(list(range(len(grid))), word)).cast("long")))
    return out


def grid_counts(rows: DataFrame, grid: list, species: tuple[str, ...]) -> DataFrame:
    """combo, union_size, overlap and each species' size, of candidates (species, tid, in_ref, ...) that are kept under it.

    A candidate's row holds all combinations as bits. Those of a tid are merged with bit_or, map-side first, so what is shuffled is a
    row a tid whatever the size of the grid; equal bit vectors are counted before combinations are told apart.
    """
    bits = survival_bits(grid)
    words = [f"w{k}" for k in range(len(bits))]
    held = rows.select("tid", "species", "in_ref", *(b.alias(w) for b, w in zip(bits, words)))
    of_species = [F.bit_or(F.when(F.col("species") == s, F.col(w))).alias(f"{w}_{k}") for k, s in enumerate(species) for w in words]
    per_tid = held.groupBy("tid").agg(F.max("in_ref").alias("in_ref"), *(F.bit_or(w).alias(w) for w in words), *of_species)
    every = [w for w in per_tid.columns if w != "tid"]
    vectors = per_tid.groupBy(*every).agg(F.count("*").alias("n"))
    array = lambda end: F.array(*(F.coalesce(w + end, F.lit(0).cast("long")) for w in words))
    each = vectors.select("n", "in_ref", array("").alias("all"), *(array(f"_{k}").alias(f"all_{k}") for k in range(len(species))), F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1))).alias("k"))
    kept = lambda c: F.call_function("shiftright", F.get(c, (F.col("k") / 64).cast("int")), F.col("k") % 64).bitwiseAND(1)
    sums = each.groupBy("k").agg(F.sum(F.col("n") * kept("all")).alias("union_size"), F.sum(F.when(F.col("in_ref"), F.col("n") * kept("all")).otherwise(0)).alias("overlap"), *[F.sum(F.col("n") * kept(f"all_{k}")).alias(f"n_{s}") for k, s in enumerate(species)])
    numbers = rows.sparkSession.createDataFrame([(k, g["combo"]) for k, g in enumerate(grid)], "k int, combo int")
    return numbers.join(sums, "k").drop("k")


def grid_search(features: DataFrame, grid: DataFrame, truth: DataFrame, species: tuple[str, ...], top: int = 20, max_union: int = 0, target_union: int = 0, min_recall: float = 0.0, false_positives: DataFrame | None = None) -> DataFrame:
    """The best combinations with the size of the species' union, overlap, recall, precision and each species' size.

    Truth is joined before combinations are tried, and all are tried at once as bits, see grid_counts(); the grid, whose size is its
    parameters' alone, is read on the driver. Ranked by recall, union (smaller first), precision; with target_union by closeness to it, recall, precision; else
    with min_recall by union, precision, recall; ties by the combination's number.
    """
    truth = truth.select("tid").distinct()
    flagged = _flag(features, truth, "in_ref", ["tid"])
    rows = flagged if false_positives is None else flagged.join(false_positives.select("species", "tid"), ["species", "tid"], "left_anti")
    sums = grid_counts(rows, grid.orderBy("combo").collect(), species)
    size = truth.agg(F.count("*").alias("n_ref"))
    table = grid.drop("g_aln", "g_cov", "g_id").join(sums, "combo", "left").na.fill(0).crossJoin(F.broadcast(size))
    table = table.withColumn("recall", F.when(F.col("n_ref") > 0, F.col("overlap") / F.col("n_ref")).otherwise(F.lit(0.0))).withColumn("precision", F.when(F.col("union_size") > 0, F.col("overlap") / F.col("union_size")).otherwise(F.lit(0.0))).drop("n_ref")
    if max_union > 0:
        table = table.where(F.col("union_size") <= max_union)
    if min_recall > 0:
        table = table.where(F.col("recall") >= min_recall)
    if target_union > 0:
        order = [F.abs(F.col("union_size") - target_union), F.desc("recall"), F.desc("precision")]
    elif min_recall > 0:
        order = [F.col("union_size"), F.desc("precision"), F.desc("recall")]
    else:
        order = [F.desc("recall"), F.col("union_size"), F.desc("precision")]
    return table.orderBy(*order, "combo").limit(top)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """n_ref, n_found, recall of a list over the truth; 0 without truth."""
    rows = _flag(truth.select("tid").distinct(), found, "found", ["tid"])
    sums = rows.agg(F.count("*").alias("n_ref"), F.count_if("found").alias("n_found"))
    return sums.withColumn("recall", F.when(F.col("n_ref") > 0, F.col("n_found") / F.col("n_ref")).otherwise(F.lit(0.0)))


def substring_matches(ids: DataFrame, rows: DataFrame, column: str, q: int = 6) -> DataFrame:
    """The rows whose text in `column` holds an id of (tid) anywhere, once for each such id; no row meets an id whose anchor it lacks.

    An index of grams: an id's anchor is the one of its grams of q characters that the fewest texts have, so that what all ids begin
    with brings nothing together. Texts meet anchors by equality, and what meets is verified. Ids of under q characters are their own
    anchor, and texts are cut to such lengths only where there are such ids.
    """
    ids = ids.select("tid").where("tid <> ''").distinct()
    sizes = sorted(r[0] for r in ids.select(F.least(F.length("tid"), F.lit(q)).alias("n")).distinct().collect())  # at most q numbers

    def grams(text: Column, size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
        return F.when(F.length(text) >= size, F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))

    if not sizes:
        return rows.withColumn("tid", F.lit("")).where("false")
    of_text = F.array_distinct(F.concat(*(grams(F.col(column), n) for n in sizes)))
    held = rows.withColumn("gram", F.explode(of_text))
    own = F.when(F.length("tid") >= q, F.array_distinct(grams(F.col("tid"), q))).otherwise(F.array("tid"))
    common = held.groupBy("gram").agg(F.count("*").alias("n"))
    anchors = ids.withColumn("gram", F.explode(own)).join(common, "gram", "left").groupBy("tid").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    return held.join(anchors, "gram").where(F.col(column).contains(F.col("tid"))).drop("gram")


def diagnose_missing(truth: DataFrame, putative: DataFrame, raw: DataFrame, hits: DataFrame, blocks: DataFrame, proteins: DataFrame, valid: DataFrame, species: tuple[str, ...], match: str = "equal") -> DataFrame:
    """Per truth id that no species' putative list has: symbol, length, the transcript kept for its symbol, per species flags, and reasons.

    putative, raw and hits have (species, tid); blocks (species, tid, stop, shift, score), the last of a tid last in line_no.
    match: `equal` takes a block's tid; `substring` needs its `label`, the lines that name its query, and takes every block whose
    label holds the id anywhere; with a column `terminated`, blocks that aren't are left out.
    """
    missing = truth.select("tid").distinct().join(putative.select("tid").distinct(), "tid", "left_anti")
    best = proteins.where("gene_symbol <> ''").groupBy("gene_symbol").agg(F.min_by(F.struct(F.col("tid").alias("kept_tid"), F.col("length").alias("kept_length")), F.struct(-F.col("length"), "tid")).alias("x")).select("gene_symbol", "x.*")
    rows = missing.join(proteins.select("tid", "gene_symbol", "length"), "tid", "left").join(best, "gene_symbol", "left")
    rows = _flag(rows, valid, "in_prefilter", ["tid"])
    seen = raw.select("species", "tid", F.lit("raw").alias("kind")).unionByName(hits.select("species", "tid", F.lit("hit").alias("kind"))).join(missing, "tid", "left_semi")
    flags = seen.groupBy("tid").agg(*[F.max((F.col("species") == s) & (F.col("kind") == k)).alias(f"{k}_{s}") for s in species for k in ("raw", "hit")])
    if match == "substring":
        whole = blocks.where("terminated") if "terminated" in blocks.columns else blocks
        own = substring_matches(missing, whole.drop("tid"), "label")
    else:
        own = blocks.join(missing, "tid", "left_semi")
    last = own.groupBy("tid").agg(*[F.max_by(F.when(F.col("species") == s, F.struct("stop", "shift", "score")), F.when(F.col("species") == s, F.col("line_no"))).alias(f"block_{s}") for s in species])
    rows = rows.join(flags, "tid", "left").join(last, "tid", "left")
    in_raw = [F.coalesce(f"raw_{s}", F.lit(False)) for s in species]
    any_raw, all_raw = in_raw[0], in_raw[0]
    for x in in_raw[1:]:
        any_raw, all_raw = any_raw | x, all_raw & x
    absent = F.array_join(F.array_compact(F.array(*[F.when(~x, s) for x, s in zip(in_raw, species)])), ", ")
    reasons = F.concat_ws("; ", F.when(~F.col("in_prefilter"), "removed by prefilter"), F.when(~any_raw, "no disruption in any species").when(~all_raw, F.concat(F.lit("no disruption in: "), absent)))
    category = F.when(~F.col("in_prefilter"), "prefilter").when(~any_raw, "no_disruption").otherwise("partial")
    columns = [c for s, x in zip(species, in_raw) for c in (x.alias(f"raw_{s}"), F.coalesce(f"hit_{s}", F.lit(False)).alias(f"hit_{s}"), F.coalesce(f"block_{s}.stop", F.lit(False)).alias(f"stop_{s}"), F.coalesce(f"block_{s}.shift", F.lit(False)).alias(f"shift_{s}"), F.col(f"block_{s}.score").alias(f"score_{s}"))]
    return rows.select("tid", F.coalesce("gene_symbol", F.lit("")).alias("gene_symbol"), F.coalesce("length", F.lit(0)).alias("length"), "kept_tid", "kept_length", "in_prefilter", *columns, F.when(reasons == "", "unknown").otherwise(reasons).alias("reasons"), category.alias("category"))


def missing_categories(diagnosis: DataFrame) -> DataFrame:
    """Number of missing ids in each category."""
    return diagnosis.groupBy("category").agg(F.count("*").alias("n"))
