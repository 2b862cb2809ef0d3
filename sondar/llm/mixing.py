"""Mixing sources to target weights by systematic sampling.

A source's records stand in order of size; each is expected r times, r being the
source's share of the total over what it has. The running sum of expected copies,
moved by one random offset a source, emits a record once for each integer it crosses.
In order of size, the drawn tokens of a source miss their target by little more than one record;
of several random offsets the one that misses it least is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondar.plans.lineage import written


#: Random offsets tried for each source.
OFFSETS = 32


def plan_sources(sized: DataFrame, targets: DataFrame, tokens: str, total: int | None = None) -> DataFrame:
    """One row a target source: tokens it has, its share among sources that have any, and copies expected a record.

    The total is the largest for which every source that has tokens meets its share
    with at most max_repeats uses of each record. Targets of absent sources are spread
    over the others in proportion. Repeated targets of one source: the greatest share counts.
    A `total` can be asked for: sources that can't reach their share of it give what they have,
    which `shortfall` (tokens) reports.
    """
    t = targets.where("source is not null and target_share > 0 and max_repeats > 0").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max(F.struct("target_share", "max_repeats"))["max_repeats"].alias("max_repeats"))
    has = sized.groupBy("source").agg(F.sum(tokens).cast("bigint").alias("tokens"), F.count(F.lit(1)).alias("records"))
    all_ = W.partitionBy()  # over one row a target source
    p = t.join(has, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    p = p.withColumn("share", F.when(F.col("tokens") > 0, F.col("target_share")).otherwise(0.0))
    p = p.withColumn("share", F.when(F.sum("share").over(all_) > 0, F.col("share") / F.sum("share").over(all_)).otherwise(0.0))
    p = p.withColumn("total", F.lit(float(total)) if total is not None else F.coalesce(F.min(F.when(F.col("share") > 0, F.col("max_repeats") * F.col("tokens") / F.col("share"))).over(all_), F.lit(0.0)))
    rate = F.when(F.col("tokens") > 0, F.least(F.col("max_repeats").cast("double"), F.col("share") * F.col("total") / F.col("tokens"))).otherwise(0.0)
    short = F.greatest(F.lit(0.0), F.col("share") * F.col("total") - F.col("max_repeats") * F.col("tokens")).cast("bigint")
    return p.select("source", "target_share", "max_repeats", "tokens", "share", "total", rate.alias("rate"), short.alias("shortfall"))


def ranked_within(sized: DataFrame, source: str, order: list[str]) -> DataFrame:
    """sized with `rank`, from 0, in the order within the source, without gathering a source in one task.

    Rows are range-partitioned by (source, order); a source's parts are joined by an
    exclusive running sum over one row for each (partition, source).
    """
    placed = sized.repartitionByRange(source, *order).sortWithinPartitions(source, *order)
    placed = written(placed.withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33).alias("part")
    parts = placed.groupBy(source, part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(source).orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(source, "part", (before - F.col("first")).alias("shift"))
    return placed.withColumn("part", part).join(parts, [source, "part"]).withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _uses(offset, rate: str = "rate", rank: str = "rank"):
    """Integers that the running sum of expected copies crosses at a record."""
    return (F.floor(offset + F.col(rate) * (F.col(rank) + 1)) - F.floor(offset + F.col(rate) * F.col(rank))).cast("int")


def mix(sized: DataFrame, targets: DataFrame, key: str, tokens: str, seed: int = 17, total: int | None = None) -> DataFrame:
    """(key, source, copy_no, tokens): each drawn record once for each use, copy_no from 1.

    sized: key, source, tokens. Records without tokens or without a target source are
    never drawn; a record is never used more than max_repeats times (a use beyond it raises);
    rows with the same key are separate records. No targets or no records give an empty
    result. The same seed gives the same draw. total: tokens asked for, see plan_sources.
    """
    sized = sized.where(F.col(tokens) > 0).select(key, "source", tokens)
    plan = plan_sources(sized, targets, tokens, total)
    ranked = ranked_within(sized.where("source is not null"), "source", [tokens, key])
    offset = lambda j: F.pmod(F.xxhash64("source", F.lit(seed), j), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # plan has one row for each row of the fixed target table; the engine broadcasts it by its size
    j = ranked.join(plan.select("source", "rate", "max_repeats", (F.col("rate") * F.col("tokens")).alias("aim")), "source").where("rate > 0")
    tried = j.groupBy("source").agg(*[F.sum(_uses(offset(F.lit(k))) * F.col(tokens)).alias(f"t{k}") for k in range(OFFSETS)], F.first("aim").alias("aim"))
    missed = F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("aim")).alias("miss"), F.lit(k).alias("k")) for k in range(OFFSETS)])
    best = tried.select("source", F.array_min(missed)["k"].alias("k"))
    j = j.join(best, "source").withColumn("uses", _uses(offset(F.col("k")))).where("uses > 0")
    uses = F.when(F.col("uses") > F.col("max_repeats"), F.raise_error(F.lit("a record is used more often than allowed"))).otherwise(F.col("uses"))
    return j.select(key, "source", F.explode(F.sequence(F.lit(1), uses)).alias("copy_no"), tokens)


def shares(drawn: DataFrame, plan: DataFrame, tokens: str) -> DataFrame:
    """A row for each target source: target, tokens drawn and the actual share of all drawn tokens."""
    got = drawn.groupBy("source").agg(F.sum(tokens).cast("bigint").alias("drawn_tokens"), F.count(F.lit(1)).alias("drawn_records"), F.max("copy_no").alias("most_uses"))
    j = plan.join(got, "source", "left").na.fill(0, ["drawn_tokens", "drawn_records", "most_uses"])
    total = F.sum("drawn_tokens").over(W.partitionBy())
    return j.select("source", "target_share", "max_repeats", F.col("tokens").alias("source_tokens"), "drawn_tokens", "drawn_records", "most_uses", "shortfall", F.when(total > 0, F.col("drawn_tokens") / total).otherwise(0.0).alias("actual_share"))
