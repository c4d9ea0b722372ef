"""Small sinks: list and specification files, key-value tables that keep the latest value."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def write_text(spark: SparkSession, text: str, to: str) -> None:
    """A small text, as a rendered template, as one file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(to)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def write_list(spark: SparkSession, paths: list[str], to: str) -> None:
    """One path a line, in one file."""
    write_text(spark, "".join(f"{p}\n" for p in paths), to)


def write_numbers(df: DataFrame, columns: list[str], to: str, separator: str = ",") -> None:
    """Numbers as lines of text, a folder of files; read_numbers reads them."""
    df.select(F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in columns])).write.mode("overwrite").text(to)


def specification(values: dict[str, Any]) -> list[str]:
    """'key=value' lines of what is set."""
    return [f"{k}={v}" for k, v in values.items() if v is not None]


def write_specification(spark: SparkSession, values: dict[str, Any], to: str) -> None:
    write_list(spark, specification(values), to)


def latest_values(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row by order for each key: an upsert of an append-only table."""
    w = W.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merged_maps(*maps: Column) -> Column:
    """One map of all; of a name in several the last one's value counts. Null maps are empty."""
    empty = F.create_map().cast("map<string,string>")

    def update(old: Column, new: Column) -> Column:
        new = F.coalesce(new, empty)
        return F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)

    return reduce(update, maps, empty)


def runs_with_tag(runs: DataFrame, tag: str, column: str = "tags") -> DataFrame:
    return runs.where(F.array_contains(column, tag))


def environment(df: DataFrame, column: str = "env", parts: tuple[str, ...] = ("SLURM_",)) -> DataFrame:
    """The entries of a map whose names hold one of the parts, as 'name=value' joined by ';'."""
    def keep(k, _):
        out = F.lit(False)
        for p in parts:
            out = out | F.contains(k, F.lit(p))
        return out

    kept = F.array_sort(F.map_entries(F.map_filter(column, keep)))
    return df.withColumn(column, F.array_join(F.transform(kept, lambda e: F.concat_ws("=", e["key"], e["value"])), ";"))


def capped_tasks(arguments, most: int):
    """Batch arguments with --ntasks no higher than most."""
    n = F.regexp_extract(arguments, r"--ntasks=(\d+)", 1).try_cast("int")
    return F.when(n > most, F.regexp_replace(arguments, r"--ntasks=\d+", f"--ntasks={most}")).otherwise(arguments)
