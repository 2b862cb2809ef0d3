"""Folders of JSON documents, strict tables, raw pages and checked publication."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from sondar.sources.files import recover, swap_in


def read_json_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row for each JSON file under a path, with its `source` file; a file that doesn't parse raises when read.

    Fields that a file lacks are null; fields beyond the schema are never read.
    """
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path).withColumn("source", F.input_file_name())


def strict_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """df, if its columns are exactly these in this order; else an error that says what is missing or too much."""
    if df.columns != names:
        missing, extra = [n for n in names if n not in df.columns], [c for c in df.columns if c not in names]
        raise ValueError(f"unexpected columns: missing {missing}, beyond {extra}, order {df.columns}")
    return df


def required(df: DataFrame, names: list[str]) -> DataFrame:
    """df, where a blank or null value in one of the columns raises when read."""
    for n in names:
        blank = F.coalesce(F.trim(F.col(n).cast("string")), F.lit("")) == ""
        df = df.withColumn(n, F.when(blank, F.raise_error(F.lit(f"{n} is required"))).otherwise(F.col(n)))
    return df


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key; a key that comes twice raises when read. One aggregation with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    n = F.count(F.lit(1))
    g = df.groupBy(*keys).agg(n.alias("__n"), *[F.any_value(c).alias(c) for c in rest])
    told = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    checked = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("repeated key: "), told))).otherwise(F.col("__n"))
    return g.withColumn("__n", checked).where(F.col("__n") == 1).drop("__n").select(*df.columns)


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """The patterns of a list file, one a line; what follows a `#` is a comment, blank lines say nothing."""
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    return spark.read.text(path).select(line.alias("pattern")).where("pattern != ''")


def matches_pattern(value: Column, pattern: Column) -> Column:
    """Whether a value meets a glob, in which `*` is any text and `?` any character; case doesn't matter."""
    quoted = F.regexp_replace(F.lower(pattern), r"([.\\+^$()\[\]{}|])", r"\\$1")
    return F.rlike(F.lower(value), F.concat(F.lit("^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$")))


def decoded(content: Column, declared: Column) -> Column:
    """(text, diagnostics) of a page's bytes: by byte-order mark, the declared charset, UTF-8 if valid, else Latin-1.

    Diagnostics say which was taken and whether the declared one was wrong; null bytes give null text.
    """
    low = F.lower(F.trim(F.coalesce(declared, F.lit(""))))
    marked = F.hex(F.substring(content, 1, 3)) == "EFBBBF"
    valid = F.try_validate_utf8(content.cast("string"))
    latin = F.decode(content, "ISO-8859-1")
    says_latin = low.isin("iso-8859-1", "iso8859-1", "latin-1", "latin1", "windows-1252", "cp1252")
    text = F.when(marked, F.regexp_replace(valid, "^﻿", "")).when(says_latin, latin).when(valid.isNotNull(), valid).otherwise(latin)
    used = F.when(marked, "bom:utf-8").when(says_latin, "declared:iso-8859-1").when(valid.isNotNull(), "valid:utf-8").otherwise("fallback:iso-8859-1")
    wrong = F.when(low.isin("utf-8", "utf8") & valid.isNull() & content.isNotNull(), "declared_charset_invalid")
    doubtful = F.when(says_latin & ~marked & valid.isNotNull() & F.coalesce(valid.rlike("[^\\x{00}-\\x{7F}]"), F.lit(False)), "valid_utf8_despite_declared")
    return F.struct(text.alias("text"), F.when(content.isNotNull(), F.array_compact(F.array(used, wrong, doubtful))).otherwise(F.array().cast("array<string>")).alias("diagnostics"))


def flattened(df: DataFrame, sep: str = "_", joined: str = " | ") -> DataFrame:
    """Nested fields as columns of their own, arrays of plain values joined, other nested values as JSON text.

    A column whose name would clash gets a number.
    """
    out: list[Column] = []
    used: set[str] = set()

    def name(path: list[str]) -> str:
        n = base = sep.join(path)
        k = 2
        while n.lower() in used:
            n, k = f"{base}{sep}{k}", k + 1
        used.add(n.lower())
        return n

    def walk(c: Column, kind, path: list[str]) -> None:
        if isinstance(kind, StructType):
            for f in kind.fields:
                walk(c.getField(f.name), f.dataType, [*path, f.name])
        elif isinstance(kind, ArrayType) and not isinstance(kind.elementType, (StructType, ArrayType, MapType)):
            out.append(F.array_join(F.transform(c, lambda x: x.cast("string")), joined).alias(name(path)))
        elif isinstance(kind, (ArrayType, MapType)):
            out.append(F.to_json(c).alias(name(path)))
        else:
            out.append(c.alias(name(path)))

    for f in df.schema.fields:
        walk(F.col(f"`{f.name}`"), f.dataType, [f.name])
    return df.select(*out)


def publish(df: DataFrame, spark: SparkSession, path: str, checks: dict[str, Column]) -> None:
    """Write a table beside its place, check what was written, and only then put it there.

    checks: conditions by name that every row must meet; null counts as not met. Nothing changes at
    `path` if one fails.
    """
    recover(spark, path)
    side = f"{path}.new-{uuid.uuid4().hex[:8]}"
    df.write.parquet(side)
    new = spark.read.parquet(side)
    bad = new.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()]).first().asDict() if checks else {}
    failed = {n: k for n, k in bad.items() if k}
    if failed:
        p = spark._jvm.org.apache.hadoop.fs.Path(side)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        raise ValueError(f"not published, rows that fail: {failed}")
    swap_in(spark, side, path)
