"""Sources and sinks with the quirks of hand-kept files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.operators.relational import overlay


def detect_delimiter(head: list[str]) -> tuple[str, bool]:
    """(delimiter, whether the first line is a `sep=` line) from a file's first lines."""
    if head and (first := head[0].lstrip("﻿").strip()).lower().startswith("sep=") and len(first) > 4:
        return first[4], True
    few = "\n".join(head[:5])
    return (";" if few.count(";") > few.count(",") else ","), False


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, all strings, empty as "": byte-order mark, `sep=` line and delimiter are found by themselves.

    Only the first five lines reach the driver. A missing file raises. A file with a `sep=` line is
    one file, whose first two lines are the first of its first partition.
    """
    head = [r.value for r in spark.read.text(path).limit(5).collect()]
    sep, preamble = detect_delimiter(head)
    if not preamble:
        df = spark.read.csv(path, header=True, sep=sep, inferSchema=False)
    else:
        names = head[1].lstrip("﻿").split(sep)
        # only the first two lines are no rows: a row that looks like the header stays
        rows = spark.read.text(path).withColumn("at", F.monotonically_increasing_id()).where("at > 1").select("value")
        df = rows.select(F.from_csv("value", ", ".join(f"`{n}` string" for n in names), {"sep": sep}).alias("r")).select("r.*")
    clean = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    return clean.na.fill("")


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """CSV parts with header; lists are joined by ` | ` and null is empty."""
    cols = [F.array_join(c, " | ").alias(c) if t.startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c, t in df.dtypes]
    df.select(*cols).write.mode("overwrite").csv(path, header=True, sep=sep, emptyValue="")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, torn lines) of a log of JSON lines: an unfinished last line is torn, any other bad line raises when read.

    Lines are known by their place within their file; nothing is cached.
    """
    text = spark.read.text(path).select("value", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at")).where(F.trim("value") != "")
    last = text.groupBy("f").agg(F.max("at").alias("at")).withColumn("last", F.lit(True))
    parsed = text.join(last, ["f", "at"], "left").withColumn("r", F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    torn = parsed.where(bad & F.coalesce("last", F.lit(False))).select(F.col("value").alias("_torn"))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("bad line: "), F.substring("value", 1, 80)))).otherwise(F.col("r"))
    good = parsed.where(~(bad & F.coalesce("last", F.lit(False)))).select(checked.alias("r")).select("r.*").drop("_bad")
    return good, torn


def canonical_json(cols: list[str]):
    """JSON text with sorted keys and no blanks; null fields are left out."""
    return F.to_json(F.struct(*sorted(cols)))


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines; each task writes its own file, so nothing needs a lock."""
    df.select(canonical_json(df.columns).alias("value")).write.mode("append").text(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put a written folder in the place of another by renaming; until the last step one of both is whole at a known name."""
    jvm = spark._jvm
    here, there, aside = (jvm.org.apache.hadoop.fs.Path(x) for x in (new, path, path + ".old"))
    fs = there.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(there):
        fs.delete(aside, True)
        if not fs.rename(there, aside):
            raise OSError(f"can't move {path} aside")
    if not fs.rename(here, there):
        raise OSError(f"can't move {new} to {path}")
    fs.delete(aside, True)


def recover(spark: SparkSession, path: str) -> None:
    """Bring back the table that a crash between the two renames left aside."""
    if not _exists(spark, path) and _exists(spark, path + ".old"):
        swap_in(spark, path + ".old", path)


def upsert(df: DataFrame, spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Rows of df over the table at path, by key; only a missing path counts as no table, any other failure to read raises.

    The new table is written beside the old one and swapped in by renaming.
    """
    recover(spark, path)
    new = overlay(spark.read.parquet(path), df, keys) if _exists(spark, path) else df
    side = f"{path}.new-{uuid.uuid4().hex[:8]}"
    new.write.parquet(side)
    swap_in(spark, side, path)
    return spark.read.parquet(path)


def atomic_parquet(df: DataFrame, spark: SparkSession, path: str) -> None:
    """Overwrite a table whole or not at all."""
    recover(spark, path)
    side = f"{path}.new-{uuid.uuid4().hex[:8]}"
    df.write.parquet(side)
    swap_in(spark, side, path)


def excel_csv(df: DataFrame, path: str, fields: list[str]) -> None:
    """One CSV file for spreadsheets: byte-order mark, `sep=;` line, header, the given fields in order (missing ones empty).

    The rows are sorted and written by one task: it is a report of bounded size.
    """
    names = set(df.columns)
    cols = [F.coalesce(F.col(f).cast("string"), F.lit("")) if f in names else F.lit("") for f in fields]
    quoted = [F.when(c.rlike('[;"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c) for c in cols]
    body = df.select(F.concat_ws(";", *quoted).alias("value")).coalesce(1).sortWithinPartitions("value")
    head = df.sparkSession.createDataFrame([("\ufeffsep=;",), (";".join(fields),)], "value string").coalesce(1)
    head.unionByName(body).coalesce(1).write.mode("overwrite").text(path)
