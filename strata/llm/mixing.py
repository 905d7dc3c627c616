"""Operator 8: mixing sources to target weights by entropy balancing.

Every document starts at rate 1 (one copy). The wanted rates lie in [0, cap],
meet each source's token target and are, among all such rates, the closest to
the start in relative entropy (of the tilted binomial distribution over the
copies 0..cap). The dual is convex with one multiplier per source; its optimum
tilts a document of ``size`` words to

    rate = cap / (1 + (cap - 1) * exp(-multiplier * size / mean size)).

Each Newton iteration is one aggregation over cells (source, size, number of
documents), an exact pre-aggregation of the documents. Gradient and curvature
are summed as decimals, so reruns agree to the bit.

Rates become copies by systematic rounding along the documents of a source in
descending size: the running sum of rates, shifted by a phase, is cut at whole
numbers. Any prefix is then off by less than one copy, so a source's words are
off by less than one of its largest documents; of ``PHASES`` phases each source
takes the one nearest its target. Running sums are two-level (cells of a source,
salted parts of a cell, rows of a part), so neither a hot source nor a hot size
is ordered in one task.

Defined results: null or empty texts have size 0, rate 1 and take 0 words; a
null source is a source of its own, the last; a source of size 0 has target 0.
Rows with a repeated or null doc_id are rounded row by row. Further columns of
the input do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise, n_words, text_of

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, CAP = 1.5, 2
PHASES, PARTS, ROUNDS = 32, 64, 60
CLOSE = 1e-10
EXACT = "decimal(38,12)"


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, n) with ``sid``, ``target`` and ``full`` (the target
    is the cap). One row per source; the global order over these rows is that of
    the weights. Water is filled in ascending order of cap / weight: a source is
    full if the level reached when all before it are full lies above its cap."""
    ranked = sources.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    all_, before = Window.partitionBy(F.lit(0)), Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    limit = (F.col("source_size") * F.lit(cap)).cast("double")
    level = ((F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / (F.col("weights") - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    filled = (ranked.withColumn("w", w).withColumn("limit", limit).withColumn("ratio", F.col("limit") / F.col("w"))
              .withColumn("total", F.sum("source_size").over(all_) * F.lit(float(share)))
              .withColumn("weights", F.sum("w").over(all_))
              .withColumn("full", F.col("ratio") <= level))
    rest = (F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(all_), F.lit(0.0)))
    open_weight = F.sum(F.when(~F.col("full"), F.col("w"))).over(all_)
    return filled.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(
        F.least(F.col("limit"), F.col("w") * rest / open_weight))).select(
            "source", "source_size", "n", "sid", "target", F.col("full").alias("full"))


def _rate(multiplier: Column, size: Column, mean: Column, cap: float) -> Column:
    z = F.coalesce(size / F.nullif(mean, F.lit(0.0)), F.lit(0.0))
    return F.lit(float(cap)) / (1 + F.lit(float(cap - 1)) * F.exp(-multiplier * z))


def solve(cells: DataFrame, sources: DataFrame, cap: float = CAP, rounds: int = ROUNDS) -> DataFrame:
    """``sources`` with ``multiplier``: Newton on the dual, a bracketed step per
    round on the logarithm of the words taken (below rate 1) or left (above)."""
    inf = float("inf")
    state = materialise(
        sources.withColumn("mean", F.coalesce(F.col("source_size") / F.col("n"), F.lit(0.0)).cast("double"))
        .withColumn("goes", ~F.col("full") & (F.col("source_size") > 0))
        .withColumns({"multiplier": F.lit(0.0), "low": F.lit(-inf), "high": F.lit(inf), "off": F.lit(inf)}), "mix")
    keep = [c for c in state.columns if c not in ("multiplier", "low", "high", "off")]
    for _ in range(rounds):
        r = _rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
        terms = cells.join(state, "sid").filter("goes").withColumn("r", r).select(
            "sid", (F.col("size") * F.col("cell") * F.col("r")).cast(EXACT).alias("g"),
            (F.col("size") * F.col("cell") * F.col("r") * (1 - F.col("r") / cap) * F.col("size") / F.col("mean"))
            .cast(EXACT).alias("h"))
        sums = terms.groupBy("sid").agg(F.sum("g").cast("double").alias("g"), F.sum("h").cast("double").alias("h"))
        low = F.when(F.col("g") < F.col("target"), F.greatest("low", "multiplier")).otherwise(F.col("low"))
        high = F.when(F.col("g") > F.col("target"), F.least("high", "multiplier")).otherwise(F.col("high"))
        most = F.col("source_size") * float(cap)
        up = F.col("target") >= F.col("source_size")
        step = F.when(up, F.log((most - F.col("g")) / (most - F.col("target"))) * (most - F.col("g")) / F.col("h")
                      ).otherwise(F.log(F.col("target") / F.col("g")) * F.col("g") / F.col("h"))
        wanted = F.col("multiplier") + F.coalesce(step, F.lit(0.0))
        state = materialise(
            state.join(sums, "sid", "left").withColumns({"low2": low, "high2": high, "wanted": wanted})
            .select(*keep, F.when(~F.col("goes"), F.col("multiplier"))
                    .when((F.col("wanted") > F.col("low2")) & (F.col("wanted") < F.col("high2")), F.col("wanted"))
                    .when(F.col("low2") == -inf, F.col("high2") - 1).when(F.col("high2") == inf, F.col("low2") + 1)
                    .otherwise((F.col("low2") + F.col("high2")) / 2).alias("multiplier"),
                    F.col("low2").alias("low"), F.col("high2").alias("high"),
                    F.when(F.col("goes"), F.abs(F.col("g") / F.col("target") - 1)).otherwise(0.0).alias("off")), "mix")
        if (state.agg(F.max("off")).first()[0] or 0.0) < CLOSE:
            break
    return state


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """doc_id, size, source, source_size, target, rate, copies and taken, and
    ``row_key`` to tell rows of one doc_id apart, for every row of ``docs``."""
    sized = materialise(
        docs.select("doc_id", "source", n_words().alias("size"), F.xxhash64("doc_id", text_of()).alias("row_key"))
        .withColumn("part", F.expr(f"pmod(row_key, {PARTS})")), "sizes")
    return _mix_sized(sized, weights, share, cap)


def _mix_sized(sized: DataFrame, weights, share: float, cap: int) -> DataFrame:
    sources = materialise(targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")),
        weights, share, cap), "sources")
    parts = materialise(
        sized.groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("docs"))
        .join(sources.select(F.col("source").alias("_s"), "sid"), F.col("source").eqNullSafe(F.col("_s")))
        .select("sid", "size", "part", "docs"), "parts")
    cells = materialise(parts.groupBy("sid", "size").agg(F.sum("docs").alias("cell")), "cells")
    solved = solve(cells, sources, cap)

    rate = F.when(F.col("full") & (F.col("source_size") > 0), F.lit(float(cap))).otherwise(
        _rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)).cast("decimal(14,12)")
    by_size = Window.partitionBy("sid").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(EXACT)
    rated = materialise(
        cells.join(solved, "sid").withColumn("rate", rate)
        .withColumn("mass", (F.col("cell").cast("decimal(18,0)") * F.col("rate")).cast(EXACT))
        .withColumn("start", F.coalesce(F.sum("mass").over(by_size), zero).cast(EXACT))
        .select("sid", "source", "source_size", "target", "size", "rate", "mass", "start"), "rated")

    phase = (F.col("phase").cast("decimal(6,0)") / F.lit(PHASES)).cast(EXACT)
    tried = (rated.withColumn("phase", F.explode(F.sequence(F.lit(0), F.lit(PHASES - 1)))).groupBy("sid", "phase")
             .agg(F.sum(F.col("size") * (F.floor(F.col("start") + F.col("mass") + phase)
                                         - F.floor(F.col("start") + phase))).alias("got"),
                  F.first("target").alias("target")))
    phases = tried.groupBy("sid").agg(
        F.min(F.struct(F.abs(F.col("got") - F.col("target")).alias("off"), "phase"))["phase"].alias("phase"))
    in_cell = Window.partitionBy("sid", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = (parts.withColumn("ahead", F.coalesce(F.sum("docs").over(in_cell), F.lit(0)))
              .join(rated, ["sid", "size"]).join(phases, "sid")
              .withColumn("start", (F.col("start") + phase).cast(EXACT))
              .select(F.col("source").alias("_s"), "source_size", "target", F.col("size").alias("_size"),
                      F.col("part").alias("_part"), "rate", "start", "ahead"))
    row = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("row_key", "doc_id"))
    at = lambda n: F.floor((F.col("start") + (n.cast("decimal(18,0)") * F.col("rate"))).cast(EXACT))
    copies = F.least(F.lit(cap).cast("long"), at(F.col("ahead") + F.col("row")) - at(F.col("ahead") + F.col("row") - 1))
    return (sized.withColumn("row", row.cast("long"))
            .join(placed, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_size"))
                  & (F.col("part") == F.col("_part")))
            .withColumn("copies", copies.cast("int"))
            .select("doc_id", "size", "source", "source_size", "target", F.col("rate").cast("double").alias("rate"),
                    "copies", (F.col("copies") * F.col("size")).alias("taken"), "row_key"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The input's rows, each as often as the mix takes it, with its columns.
    Rows that are equal in doc_id and text are interchangeable: their copies are
    summed and dealt out again evenly."""
    made = (mix(docs, weights, share, cap).groupBy(F.col("doc_id").alias("_doc"), F.col("row_key").alias("_key"))
            .agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")))
    keyed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_d"),
                        F.xxhash64("doc_id", text_of()).alias("_k"))
    both = keyed.join(made.hint("merge"), F.col("_d").eqNullSafe(F.col("_doc")) & (F.col("_k") == F.col("_key")))
    one = F.col("_copies")
    several = both.filter("_rows > 1").withColumn(
        "_at", F.row_number().over(Window.partitionBy("_d", "_k").orderBy(F.lit(0)))).withColumn(
            "_copies", F.floor(F.col("_copies") * F.col("_at") / F.col("_rows"))
            - F.floor(F.col("_copies") * (F.col("_at") - 1) / F.col("_rows"))).drop("_at")
    out = both.filter("_rows = 1").unionByName(several) if _any_repeated(made) else both
    return (out.filter(one > 0).select("_row", F.explode(F.sequence(F.lit(1), one.cast("int"))).alias("_n"))
            .select("_row.*"))


def _any_repeated(made: DataFrame) -> bool:
    return not made.filter("_rows > 1").isEmpty()
