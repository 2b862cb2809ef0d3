"""What changed between consecutive full snapshots, by Merkle trees over key ranges.

Content never crosses the network: each row is reduced to a 128-bit digest at the
scan. Keys fall into leaf buckets, contiguous ranges of the hash space, and one
shuffle by (snapshot, key) brings a snapshot's copies of a key together. Leaf digests are
summed up a tree of fan-out 16, all its levels in one aggregation; consecutive snapshots are compared from the root
down, and rows are diffed only in leaves whose digests differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondar.functions.urls import WS
from sondar.plans.lineage import written
from sondar.plans.tables import buckets_for

FAN = 16


def squeezed(c: Column) -> Column:
    """Text with every run of white space as one blank, trimmed; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{WS}+", " "))


def digest(*cols: Column) -> list[Column]:
    """128 bits of the given strings as two bigints; the two use different layouts of the same values."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit("sondar"), *reversed(cols))]


def _levels(leaves: int) -> list[int]:
    """Numbers of nodes from the root's children down to the leaves."""
    out = [leaves]
    while out[-1] > FAN:
        out.append(max(1, out[-1] // FAN))
    return out[::-1]


def tree_of(nodes: DataFrame, leaves: int) -> DataFrame:
    """(width, ord, node, d1, d2, n) of every level of the trees over leaf digests, in one aggregation, written once."""
    widths = _levels(leaves)
    ups = F.array(*[F.struct(F.lit(w).alias("width"), F.expr(f"leaf div {leaves // w}").alias("node")) for w in widths])
    x = nodes.select("ord", F.explode(ups).alias("u"), "d1", "d2", "n").select("ord", "u.width", "u.node", "d1", "d2", "n")
    return written(x.groupBy("width", "ord", "node").agg(F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"), F.sum("n").alias("n")), "tree")


def changed_leaves(nodes: DataFrame, leaves: int) -> DataFrame:
    """(ord, leaf) of each snapshot ordinal whose leaf digest differs from the snapshot before.

    nodes: ord, leaf, d1, d2, n. A level is compared only below nodes that differ.
    """
    tree = tree_of(nodes, leaves)
    open_: DataFrame | None = None
    for width in _levels(leaves):
        level = tree.where(F.col("width") == width).drop("width")
        if open_ is not None:
            level = level.join(open_.select("ord", "up"), [level.ord == open_.ord, F.expr(f"node div {width // last}") == open_.up], "left_semi")
        # a node absent from a snapshot counts as empty: each node is sent to its own ordinal and to the next
        sides = level.select(F.explode(F.array(F.struct("ord", F.lit(1).alias("side")), F.struct((F.col("ord") + 1).alias("ord"), F.lit(0).alias("side")))).alias("o"), "node", "d1", "d2", "n")
        pair = sides.groupBy(F.col("o.ord").alias("ord"), "node").agg(*[F.bit_xor(c).alias(c) for c in ("d1", "d2")], F.sum(F.when(F.col("o.side") == 1, F.col("n")).otherwise(-F.col("n"))).alias("n"))
        differs = pair.where("d1 != 0 or d2 != 0 or n != 0")
        # a node compared at ord needs itself at ord and at ord - 1 one level down
        open_ = differs.select(F.explode(F.array("ord", F.col("ord") - 1)).alias("ord"), F.col("node").alias("up")).distinct()
        last = width
    return differs.select("ord", F.col("node").alias("leaf"))


def snapshot_changes(df: DataFrame, snapshot: str, key: str, version: str, compared: list[Column], leaf_rows: int = 4) -> DataFrame:
    """(snapshot, key, change_kind) between consecutive delivered snapshots.

    Of several rows of a key in one snapshot the one with the latest `version` counts
    (null is earliest; equal versions: the greater digest). compared: the values whose
    change counts, as strings without nulls. Rows without snapshot or key are no
    deliveries and are left out. The first snapshot gives no rows; an empty table
    gives an empty result. Columns of df beyond those named are never read. A leaf holds about
    leaf_rows keys: few, so that most leaves are equal where one key in ten changes.
    """
    kinds = {f: df.schema[f].dataType for f in (snapshot, key)}
    d1, d2 = digest(*compared)
    rows = df.where(F.col(snapshot).isNotNull() & F.col(key).isNotNull()).select(F.col(snapshot).alias("s"), F.col(key).alias("k"), F.col(version).alias("v"), d1.alias("d1"), d2.alias("d2"))
    best = F.max_by(F.struct("d1", "d2"), F.struct(F.col("v").isNotNull(), "v", "d1", "d2"))
    current = written(rows.groupBy("s", "k").agg(best.alias("d")).select("s", "k", "d.d1", "d.d2"), "snap")
    per = current.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    ords = per.select("s", F.row_number().over(W.orderBy("s")).cast("int").alias("ord"), "n")  # one row a delivery
    most = ords.agg(F.max("n"), F.max("ord")).first()
    leaves = buckets_for(most[0] or 1, leaf_rows)
    leaves = FAN ** max(1, -(-(leaves.bit_length() - 1) // 4))
    keyed = current.join(F.broadcast(ords.select("s", "ord")), "s").withColumn("leaf", F.pmod(F.shiftrightunsigned(F.xxhash64("k"), 8), F.lit(leaves)))
    # a row's share of its leaf: key and digests hashed together
    nodes = keyed.groupBy("ord", "leaf").agg(F.bit_xor(F.xxhash64("k", "d1", "d2")).alias("d1"), F.bit_xor(F.xxhash64("d2", "k", "d1")).alias("d2"), F.count(F.lit(1)).alias("n"))
    hit = changed_leaves(nodes, leaves).where((F.col("ord") > 1) & (F.col("ord") <= (most[1] or 0)))
    # both sides of a differing leaf are diffed in one aggregation
    asked = hit.select(F.explode(F.array(F.struct(F.col("ord").alias("at"), F.lit(True).alias("new")), F.struct((F.col("ord") - 1).alias("at"), F.lit(False).alias("new")))).alias("w"), "ord", "leaf")
    both = keyed.withColumnRenamed("ord", "at").join(asked.select(F.col("w.at").alias("at"), F.col("w.new").alias("new"), "ord", "leaf"), ["at", "leaf"])
    diff = both.groupBy("ord", "k").agg(F.max("new").alias("there"), F.min("new").alias("only"), F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"))
    kind = F.when(~F.col("there"), "removed").when(F.col("only"), "added").when((F.col("d1") != 0) | (F.col("d2") != 0), "changed")
    out = diff.withColumn("change_kind", kind).where("change_kind is not null").join(F.broadcast(ords.select("s", "ord")), "ord")
    return out.select(F.col("s").cast(kinds[snapshot]).alias(snapshot), F.col("k").cast(kinds[key]).alias(key), "change_kind")
