"""Relational operators over units, truth and outcomes."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order given; rows beyond the first are dropped before the shuffle (group limit).

    Ties are settled by the order; a null key is a key of its own.
    """
    return df.withColumn("__rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def latest(df: DataFrame, keys: list[str], version: str, cols: list[str]) -> DataFrame:
    """Latest values of cols a key (null version earliest; ties: the greater values)."""
    best = F.max_by(F.struct(*cols), F.struct(F.col(version).isNotNull(), version, *cols))
    return df.groupBy(*keys).agg(best.alias("__r")).select(*keys, "__r.*")


def unpivot(df: DataFrame, keys: list[str], columns: dict[str, str], name: str, value: str) -> DataFrame:
    """A row for each key and named column."""
    items = F.array(*[F.struct(F.lit(label).alias(name), F.col(c).alias(value)) for c, label in columns.items()])
    return df.select(*keys, F.explode(items).alias("__i")).select(*keys, f"__i.{name}", f"__i.{value}")


def overlay(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new over old by key: old rows whose key isn't in new, and all of new."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def reconcile(expected: DataFrame, covered: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """(key, state) of every key: covered, excluded, both, missing, or unexpected."""
    parts = [d.select(key).distinct().withColumn("__s", F.lit(s)) for d, s in ((expected, 1), (covered, 2), (excluded, 4))]
    u = functools.reduce(DataFrame.unionByName, parts).groupBy(key).agg(F.bit_or("__s").alias("__s"))
    s = F.col("__s")
    state = F.when((s % 2) == 0, "unexpected").when(s == 7, "both").when(s == 3, "covered").when(s == 5, "excluded").otherwise("missing")
    return u.select(key, state.alias("state"))


def suffix_join(hosts: DataFrame, registry: DataFrame, host: str, suffix: str) -> DataFrame:
    """Each host with the longest registered suffix of its labels; an equi-join on every suffix, no cross join."""
    labels = F.split(F.col(host), "\\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    e = hosts.select(host).distinct().select(host, F.explode(ends).alias("__end"))
    hit = e.join(registry.select(F.col(suffix).alias("__end")).distinct(), "__end")
    return hit.groupBy(host).agg(F.max_by("__end", F.length("__end")).alias("registered"))


def top_per_group(df: DataFrame, group: str, order: list[Column], most: int, total: int) -> DataFrame:
    """The first `most` rows of each group, then the first `total` of all in order of group; `rank` within the group."""
    r = df.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("rank") <= most)
    return r.orderBy(group, "rank").limit(total)


def round_robin(df: DataFrame, stratum: str, order: list[Column], n: int) -> DataFrame:
    """n rows taken in turns from the strata: first of each, second of each, and so on."""
    # no stratum gives more than n rows: the group limit cuts each one before the shuffle
    r = df.withColumn("turn", F.row_number().over(W.partitionBy(stratum).orderBy(*order))).where(F.col("turn") <= n)
    return r.orderBy("turn", stratum).limit(n)


def hash_share(key: Column, seed: str, of: int) -> Column:
    """A stable share of 1 in `of` rows, by the first 8 hex digits of sha256(seed, key)."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), key), 256), 1, 8), 16, 10).cast("bigint") % of == 0


def first_rule(rules: list[tuple[str, Column]], fallback: str) -> Column:
    """The name of the first rule that holds; order is semantics."""
    c = F
    for i, (name, cond) in enumerate(rules):
        c = F.when(cond, name) if i == 0 else c.when(cond, name)
    return c.otherwise(fallback)


def ratio(a: Column, b: Column) -> Column:
    """a / b rounded to 4 digits, -1 where b is not positive."""
    return F.when(b > 0, F.round(a / b, 4)).otherwise(F.lit(-1.0))


def mentions(df: DataFrame, key: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """(key, name, at) of each name that a text holds as whole words, both already folded; at counts words from 1.

    Texts are exploded to their words with the few that follow, and names met by their first word:
    an equi-join whatever the sizes, never all texts against all names. The words that follow are
    as many as the longest name has. Null and empty texts and names mention nothing.
    """
    n = names.select(name).distinct().where(F.col(name) != "").withColumn("__first", F.substring_index(name, " ", 1))
    most = n.agg(F.max(F.size(F.split(name, " ")))).first()[0] or 1
    words = df.where(F.col(text) != "").select(key, F.split(text, " ").alias("__w"))
    each = F.transform("__w", lambda w, i: F.struct(w.alias("first"), (i + 1).alias("at"), F.array_join(F.slice("__w", i + 1, F.lit(most)), " ").alias("next")))
    e = words.select(key, F.explode(each).alias("__e")).select(key, F.col("__e.first").alias("__first"), F.col("__e.at").alias("at"), F.concat("__e.next", F.lit(" ")).alias("__next"))
    return e.join(n, "__first").where(F.startswith("__next", F.concat(name, F.lit(" ")))).select(key, name, "at")


def longest_mention(df: DataFrame, key: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """(key, name) of the longest name that a text mentions; of equally long ones the first in order of the alphabet."""
    m = mentions(df, key, text, names, name)
    return m.groupBy(key).agg(F.min(F.struct((-F.length(name)).alias("l"), name)).alias("__m")).select(key, F.col(f"__m.{name}").alias(name))
