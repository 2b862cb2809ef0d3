"""Differences between two copies of a dataset, field by field.

Both sides are reduced to one current row a key on the JVM side (with partial
aggregation, so a hot key costs nothing), cut into hash buckets of bounded size and
cogrouped as Arrow tables. Within a bucket, keys are aligned by sorted search and
all fields are compared with vectorised masks; only masked cells come out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.plans.tables import buckets_for


def current_rows(df: DataFrame, key: str, version: str, fields: dict[str, Column]) -> DataFrame:
    """One row a key: the fields of the row with the latest version (null earliest; ties: the greater fields)."""
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("__k"), F.col(version).alias("__v"), *[c.alias(f) for f, c in fields.items()])
    best = F.max_by(F.struct(*fields), F.struct(F.col("__v").isNotNull(), "__v", *fields))
    return rows.groupBy("__k").agg(best.alias("__r")).select("__k", "__r.*")


def copy_differences(left: DataFrame, right: DataFrame, key: str, version: str, left_fields: dict[str, Column], right_fields: dict[str, Column], names: tuple[str, str], bucket_rows: int = 20_000) -> DataFrame:
    """(key, diff): `missing_in_<name>` or the name of a field whose values differ, one row each.

    Fields are given as already normalised columns under the same names on both sides;
    two nulls are equal, a null differs from every value. Rows without a key identify
    nothing and are left out. Empty tables are fine: every key is then missing on one side.
    """
    fields = list(left_fields)
    a, b = current_rows(left, key, version, left_fields), current_rows(right, key, version, {f: right_fields[f] for f in fields})
    n = buckets_for(left.count() + right.count(), bucket_rows, 1)
    bucket = F.pmod(F.xxhash64("__k"), F.lit(n))
    kind = left.schema[key].dataType.simpleString()

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        x, y = x.combine_chunks().sort_by("__k"), y.combine_chunks().sort_by("__k")
        xk, yk = (t.column("__k").to_numpy(zero_copy_only=False) for t in (x, y))
        at = np.searchsorted(yk, xk)
        hit = (at < len(yk)) & (yk[np.minimum(at, max(len(yk) - 1, 0))] == xk if len(yk) else np.zeros(len(xk), bool))
        found = np.zeros(len(yk), bool)
        found[at[hit]] = True
        keys, kinds = [xk[~hit], yk[~found]], [f"missing_in_{names[1]}"] * int((~hit).sum()) + [f"missing_in_{names[0]}"] * int((~found).sum())
        xi, yi = pa.array(np.flatnonzero(hit)), pa.array(at[hit])
        for f in fields:
            u, v = x.column(f).take(xi), y.column(f).take(yi)
            one_null = pc.xor(pc.is_null(u), pc.is_null(v))
            mask = np.asarray(pc.or_(one_null, pc.fill_null(pc.not_equal(u, v), False)))
            keys.append(xk[hit][mask])
            kinds += [f] * int(mask.sum())
        return pa.table({key: pa.array(np.concatenate(keys)).cast(x.schema.field("__k").type), "diff": pa.array(kinds, pa.string())})

    # the bucket is taken as an attribute so that both sides share one hash partitioning
    a, b = a.withColumn("__bucket", bucket), b.withColumn("__bucket", bucket)
    return a.groupBy("__bucket").cogroup(b.groupBy("__bucket")).applyInArrow(run, f"`{key}` {kind}, diff string")
