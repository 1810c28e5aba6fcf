"""Readers and sinks with contracts: Parquet, CSV, JSON lines, partitioned layouts, file hashes."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def contained(root: str, relative: str) -> str:
    """The path of a file below ``root``; absolute paths and ``..`` are refused."""
    p = PurePosixPath(relative)
    if p.is_absolute() or ".." in p.parts or not p.parts:
        raise ValueError(f"outside its folder: {relative}")
    return f"{root.rstrip('/')}/{p}"


def schema_breaks(df: DataFrame, contract: T.StructType) -> list[str]:
    """How a table departs from its contract: missing, extra and differently typed columns, in any order."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in contract}
    out = [f"missing {n}" for n in want if n not in have] + [f"extra {n}" for n in have if n not in want]
    return sorted(out + [f"{n}: {have[n].simpleString()} for {want[n].simpleString()}" for n in want if n in have and have[n] != want[n]])


def read_contract(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """A Parquet table that must have exactly the contract's columns."""
    df = spark.read.parquet(path)
    if breaks := schema_breaks(df, contract):
        raise ValueError("; ".join(breaks))
    return df.select(*contract.names)


def artifact_checks(df: DataFrame, key: str, year: str, years: tuple[int, int]) -> DataFrame:
    """``n_rows, distinct_keys, bad_keys, bad_years`` in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNull() | (F.col(key) <= 0)).alias("bad_keys"),
        F.count_if(F.col(year).isNull() | ~F.col(year).between(*years)).alias("bad_years"),
    )


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``name, size, sha256`` of every file of a folder."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with ``file_name`` and ``row_index``, the row's place in its file from 0."""
    df = spark.read.parquet(path)
    return df.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row_index"))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken lines): a torn last line is kept apart, never dropped."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = spark.read.text(path).where("trim(value) <> ''").select(parsed.alias("r")).select("r.*")
    return rows.where("_corrupt is null").drop("_corrupt"), rows.where("_corrupt is not null").select(F.col("_corrupt").alias("line"))


def write_read(df: DataFrame, path: str, fmt: str) -> DataFrame:
    """``df`` written to ``path`` and read again with its own schema."""
    w = df.write.mode("overwrite")
    r = df.sparkSession.read.schema(df.schema)
    if fmt == "parquet":
        w.option("compression", "zstd").parquet(path)
        return r.parquet(path)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').option("quoteAll", True).option("emptyValue", "").option("nullValue", "\\N").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        return r.option("header", True).option("escape", '"').option("multiLine", True).option("emptyValue", "").option("nullValue", "\\N").csv(path)
    if fmt == "json":
        w.option("ignoreNullFields", False).json(path)
        return r.json(path)
    if fmt == "orc":
        w.orc(path)
        return r.orc(path)
    raise ValueError(fmt)


def write_batches(df: DataFrame, path: str, day: str, batch: str) -> None:
    """One folder per day and batch."""
    df.write.mode("append").partitionBy(day, batch).parquet(path)


def latest_batch(df: DataFrame, group: str, order: str) -> DataFrame:
    """The rows of each group's latest batch; with ``order`` a partition column only that is read."""
    last = df.groupBy(group).agg(F.max(order).alias("__last"))
    return df.join(last.withColumnRenamed(group, "__g"), (df[group].eqNullSafe(F.col("__g"))) & (df[order] == F.col("__last"))).drop("__g", "__last")


def latest_rows(df: DataFrame, order: str) -> DataFrame:
    """The rows of the latest batch of all: its number is found first and filtered for in the scan."""
    return df.where(F.col(order) == F.lit(df.agg(F.max(order)).first()[0]))
