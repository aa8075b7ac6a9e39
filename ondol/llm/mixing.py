"""Mixing sources to target weights, by capped water-filling.

Sizes are tokens of a public vocabulary. Each source gets its share of the total; a source that would have to be repeated more
often than its cap is clamped there, and what it can't give is spread over the others in proportion to their targets, until no
source is above its cap. Without a given total, the largest total is taken at which the targets hold exactly.

A source that is to be taken r times gives floor(r) whole repetitions and a seeded sample of its documents for the rest:
documents are ordered by a seeded hash, and the first ones that fill the rest are taken. The order is found by counting the
tokens in ranges of the hash, so that only the one range that is cut has to be sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import tokens

SEED, RANGES, MAX_SOURCES = 42, 4096, 100_000


def water_fill(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """source -> tokens. targets: source -> (share, most repeats). Sources without tokens give nothing; shares are taken
    relative to those of the sources that have any. Sources without a target aren't used."""
    live = {s: targets[s] for s in targets if sizes.get(s, 0) > 0 and targets[s][0] > 0 and targets[s][1] > 0}
    weight = sum(share for share, _ in live.values())
    if not live:
        return {s: 0.0 for s in targets}
    caps = {s: float(sizes[s] * repeats) for s, (_, repeats) in live.items()}
    if total is None:
        total = min(caps[s] * weight / live[s][0] for s in live)
    given: dict[str, float] = {}
    free = dict(live)
    left = float(total)
    while free:
        weight = sum(share for share, _ in free.values())
        over = [s for s, (share, _) in free.items() if left * share / weight > caps[s] * (1 + 1e-12)]
        if not over:
            given |= {s: left * share / weight for s, (share, _) in free.items()}
            break
        for s in over:
            given[s] = caps[s]
            del free[s]
        left = total - sum(given.values())
    return {s: given.get(s, 0.0) for s in targets}


def mix(documents: DataFrame, targets: DataFrame, total: float | None = None, epochs: float | None = None, seed: int = SEED, name: str = tokens.DEFAULT, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix (doc_id, source, n_tokens, copies; documents with no copy are left out) and the report (source, size, target_share,
    max_repeats, wanted, tokens, missed, share, epochs).

    ``total`` is the size of the mix in tokens, or ``epochs`` as a multiple of the tokens of all sources with a target. With
    neither, the largest total is taken at which every share holds exactly; a source that is small against its target then
    shrinks the mix in proportion. A given total that some sources can't serve clamps these at their repeats and goes to the
    others. ``missed`` is what the one document on the border of each source, taken or left as a whole, adds or lacks.

    Documents with a NULL source or one without a target aren't part of the mix. NULL and empty texts have no tokens; they are
    repeated as often as the whole repetitions of their source. Repeated targets of a source: the first by share counts.
    """
    rows = targets.where("source is not null").dropDuplicates(["source"]).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    wanted = {r.source: (float(r.target_share or 0), int(r.max_repeats or 0)) for r in rows}
    sized = materialize(tokens.counted(documents, name=name, path=path), "sizes")
    sized = sized.withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id"))).withColumn("range", F.pmod(F.shiftright("h", 20), F.lit(RANGES)))
    bins = sized.groupBy("source", "range").agg(F.sum("n_tokens").alias("n")).where("source is not null")
    sizes = {r.source: int(r.n) for r in bins.groupBy("source").agg(F.sum("n").alias("n")).join(F.broadcast(targets.select("source").distinct()), "source").collect()}
    if epochs is not None:
        total = epochs * sum(sizes.get(s, 0) for s in wanted)
    given = water_fill(sizes, wanted, total)

    spark = documents.sparkSession
    plan = []
    for s, t in sorted(given.items()):
        size = sizes.get(s, 0)
        whole = int(t // size + 1e-9) if size else 0
        whole = min(whole, wanted[s][1])
        plan.append((s, size, wanted[s][0], wanted[s][1], float(t), whole, t - whole * size if size else 0.0))
    shape = "source string, size bigint, target_share double, max_repeats int, wanted double, whole int, rest double"
    plan_df = F.broadcast(spark.createDataFrame(plan, shape))
    # tokens before each range: sources times RANGES rows at most
    below = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranged = bins.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0))).join(plan_df, "source")
    ranged = ranged.select("source", "range", "before", "n", "whole", "rest", (F.col("before") + F.col("n") <= F.col("rest")).alias("inside"), ((F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest"))).alias("cut"))
    docs = sized.join(ranged.withColumnsRenamed({"source": "s", "range": "r"}), (F.col("source") == F.col("s")) & (F.col("range") == F.col("r"))).drop("s", "r")
    within = Window.partitionBy("source", "range").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = docs.where("cut").withColumn("ahead", F.col("before") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    # the document on the border is taken if at least half of it fits
    cut = cut.withColumn("extra", (F.col("ahead") + F.col("n_tokens") / 2 <= F.col("rest")).cast("int"))
    rest = docs.where("not cut").withColumn("extra", (F.col("inside") & (F.col("rest") > 0)).cast("int"))
    columns = ["doc_id", "source", "n_tokens", (F.col("whole") + F.col("extra")).cast("int").alias("copies")]
    mixed = materialize(cut.select(*columns).unionByName(rest.select(*columns)).where("copies > 0"), "mix")
    reached = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"))
    total_tokens = Window.partitionBy()
    report = plan_df.join(reached, "source", "left").select("source", "size", "target_share", "max_repeats", "wanted", F.coalesce("tokens", F.lit(0)).alias("tokens")).withColumn("missed", F.col("tokens") - F.col("wanted"))
    report = report.withColumn("share", F.try_divide(F.col("tokens"), F.sum("tokens").over(total_tokens))).withColumn("epochs", F.try_divide(F.col("tokens"), F.col("size")))
    return mixed, report
