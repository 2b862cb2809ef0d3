import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondar.operators.copydiff import copy_differences
from sondar.operators.snapdiff import snapshot_changes, squeezed

S = "s int, k long, v timestamp_ntz, content string, url string, change_kind string"


def brute(rows):
    cur = {}
    for s, k, v, c, u in rows:
        if s is None or k is None:
            continue
        key = (s, k)
        val = (v is not None, v or "", " ".join((c or "").split()), u or "")
        if key not in cur or val[:2] > cur[key][:2]:
            cur[key] = val
    ids = sorted({s for s, _ in cur})
    out = []
    for a, b in zip(ids, ids[1:]):
        ka, kb = {k for s, k in cur if s == a}, {k for s, k in cur if s == b}
        out += [(b, k, "added") for k in kb - ka] + [(b, k, "removed") for k in ka - kb]
        out += [(b, k, "changed") for k in ka & kb if cur[a, k][2:] != cur[b, k][2:]]
    return sorted(out)


def test_snapshots_against_brute_force(spark):
    r = random.Random(3)
    rows = []
    for s in (1, 2, 5, 9):
        for k in range(300):
            if r.random() < 0.9:
                c = r.choice(["a b", "a  b ", "c", None, ""]) if r.random() < 0.2 else f"text {k}"
                rows.append((s, k, f"2026-01-0{s} 00:00:00", c, r.choice([None, "", "u"]) if r.random() < 0.1 else "u"))
                if r.random() < 0.1:
                    rows.append((s, k, "2025-01-01 00:00:00", "old", "old"))
                if r.random() < 0.1:
                    rows.append(rows[-1])
    rows += [(None, 1, None, "x", "x"), (1, None, None, "x", "x"), (1, 999, None, "x", None)]
    df = spark.createDataFrame([(s, k, v, c, u, "clash") for s, k, v, c, u in rows], S.replace("timestamp_ntz", "string")).withColumn("v", F.to_timestamp("v"))
    got = snapshot_changes(df, "s", "k", "v", [squeezed(F.col("content")), F.coalesce("url", F.lit(""))], leaf_rows=4)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert snapshot_changes(df.limit(0), "s", "k", "v", [squeezed(F.col("content"))]).count() == 0


def test_unchanged_leaves_are_pruned(spark):
    from sondar.operators.snapdiff import changed_leaves

    rows = [(o, leaf, 1, 1, 1) for o in (1, 2) for leaf in range(256)]
    rows[256 + 77] = (2, 77, 9, 1, 1)
    nodes = spark.createDataFrame(rows, "ord int, leaf long, d1 long, d2 long, n long")
    got = {(r.ord, r.leaf) for r in changed_leaves(nodes, 256).collect() if r.ord == 2}
    assert got == {(2, 77)}


def test_copies(spark):
    one = [(1, "a", "x", "2026-01-01"), (1, "b", "x", "2026-01-02"), (2, "a", None, "2026-01-01"), (3, "a", "x", None), (4, "n", "n", "2026-01-01"), (None, "q", "q", "2026-01-01"), (6, "same", "x", "2026-01-01"), (6, "same", "x", "2026-01-01")]
    two = [(1, "b", "y", "2026-01-01"), (2, "a", None, "2026-01-01"), (3, "b", None, "2026-01-01"), (5, "a", "x", "2026-01-01"), (6, "same", "x", "2026-02-01")]
    schema = "k long, f string, g string, at string"
    a, b = spark.createDataFrame(one, schema), spark.createDataFrame(two, schema)
    fields = {"f": F.col("f"), "g": F.col("g")}
    got = sorted(map(tuple, copy_differences(a, b, "k", "at", fields, fields, ("left", "right"), bucket_rows=2).collect()))
    assert got == [(1, "g"), (3, "f"), (3, "g"), (4, "missing_in_right"), (5, "missing_in_left")]
    assert sorted(map(tuple, copy_differences(a.limit(0), b, "k", "at", fields, fields, ("left", "right")).collect())) == [(k, "missing_in_left") for k in (1, 2, 3, 5, 6)]
    assert copy_differences(a.limit(0), b.limit(0), "k", "at", fields, fields, ("left", "right")).count() == 0


def test_the_tree_prunes_equal_leaves(spark):
    """On the test data most leaves are equal between deliveries, and their rows are never diffed."""
    from sondar.operators import snapdiff

    df = spark.read.parquet("/root/testdata/sf0.01/evidence_snapshot.parquet")
    d1, d2 = snapdiff.digest(snapdiff.squeezed(F.col("content")), F.coalesce("final_url", F.lit("")))
    rows = df.select(F.dense_rank().over(W.orderBy("snapshot_id")).alias("ord"), F.col("resource_id").alias("k"), d1.alias("d1"), d2.alias("d2")).distinct()
    leaves = 256
    keyed = rows.withColumn("leaf", F.pmod(F.shiftrightunsigned(F.xxhash64("k"), 8), F.lit(leaves)))
    nodes = keyed.groupBy("ord", "leaf").agg(F.bit_xor(F.xxhash64("k", "d1", "d2")).alias("d1"), F.bit_xor(F.xxhash64("d2", "k", "d1")).alias("d2"), F.count(F.lit(1)).alias("n"))
    most = rows.agg(F.max("ord")).first()[0]
    hit = snapdiff.changed_leaves(nodes, leaves).where((F.col("ord") > 1) & (F.col("ord") <= most)).count()
    assert 0 < hit < 0.7 * leaves * (most - 1)


def test_intermediate_tables_live_in_the_applications_folder(spark):
    from sondar.plans import lineage

    a = lineage.written(spark.range(3).toDF("k"), "t")
    where = a.inputFiles()[0]
    assert spark.sparkContext.applicationId in where and a.count() == 3
    old = lineage.shared_dir(spark) + "/sondar/app-long-ago"
    fs, p = lineage._fs(spark, old)
    fs.mkdirs(p)
    fs.setTimes(p, 0, -1)
    lineage._folders.clear()
    lineage.app_folder(spark)
    assert not fs.exists(p) and a.count() == 3
