"""The run ledger: parameters and results of every task run, as Parquet tables that gain columns over time."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def flatten(values: dict | list, prefix: str = "") -> dict[str, Any]:
    """Nested dictionaries to dotted names, lists to [i]; dictionaries inside lists stay whole, as JSON; an empty
    list leaves no name."""
    out: dict[str, Any] = {}
    items = values.items() if isinstance(values, dict) else enumerate(values)
    for k, v in items:
        name = (f"{prefix}.{k}" if prefix else str(k)) if isinstance(values, dict) else f"{prefix}[{k}]"
        if isinstance(v, dict):
            out |= flatten(v, name) if isinstance(values, dict) else {name: json.dumps(v, sort_keys=True)}
        elif isinstance(v, (list, tuple)):
            out |= flatten(list(v), name)
        else:
            out[name] = v
    return out


def flat_columns(df: DataFrame, name: str) -> list[Column]:
    """Projections of a struct column to dotted names, at any depth."""
    from pyspark.sql.types import StructType

    def walk(path: str, kind) -> list[Column]:
        if isinstance(kind, StructType):
            return [c for f in kind.fields for c in walk(f"{path}.{f.name}", f.dataType)]
        return [F.col(path).alias(path)]

    return walk(name, df.schema[name].dataType)


def column_type(value: Any) -> str:
    """Whole numbers and booleans, numbers, text; anything else as bytes."""
    return "bigint" if isinstance(value, int) else "double" if isinstance(value, float) else "string" if isinstance(value, str) else "binary"


def valid_flag(status: Column) -> Column:
    return (status == "COMPLETED").cast("int")


class Ledger:
    """Tables under one folder. One writer at a time, as ids are numbered from the largest that is there."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame | None:
        """The rows with the columns of all files; None if there is no such table."""
        try:
            return self.spark.read.option("mergeSchema", "true").parquet(f"{self.folder}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
                return None
            raise

    def tables(self) -> list[str]:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        store = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in store.listStatus(path) if s.isDirectory()) if store.exists(path) else []

    def columns(self, name: str) -> list[str]:
        t = self.table(name)
        return t.columns if t is not None else []

    def new_columns(self, name: str, row: dict[str, Any]) -> list[str]:
        return [k for k in row if k not in set(self.columns(name))]

    def append(self, name: str, values: dict[str, Any], share: bool = False) -> int:
        """Adds a row and returns its id. share: an equal row (null equals null) is reused, the last of several."""
        row = flatten(values)
        old = self.table(name)
        if share and old is not None and not self.new_columns(name, row):
            match = F.lit(True)
            for k, v in row.items():
                match = match & F.col(f"`{k}`").eqNullSafe(F.lit(v))
            for k in set(old.columns) - {"id", "timestamp", *row}:
                match = match & F.col(f"`{k}`").isNull()
            found = old.where(match).agg(F.max("id")).first()[0]
            if found is not None:
                return found
        top = old.agg(F.max("id")).first()[0] if old is not None else 0
        kinds = dict(old.dtypes) if old is not None else {}
        columns = [F.lit((top or 0) + 1).cast("bigint").alias("id"), F.current_timestamp().alias("timestamp")]
        for k, v in row.items():
            kind = kinds.get(k) or ("string" if v is None else column_type(v))
            value = v if isinstance(v, (int, float, str, bytes)) or v is None else json.dumps(v, default=str).encode()
            columns.append(F.lit(value).cast(kind).alias(k))
        self.spark.range(1).select(*columns).write.mode("append").parquet(f"{self.folder}/{name}")
        return (top or 0) + 1

    def record(self, task: str, header: dict, execution: dict, parameters: dict, result: dict) -> int:
        """One run: the header and the execution settings are shared between runs that have them alike."""
        header = {k: v for k, v in header.items() if k != "work_dir"}
        gen, run = self.append("gen_cfg", header, share=True), self.append("exec_cfg", execution, share=True)
        own = {"gen_cfg_id": gen, "exec_cfg_id": run} | parameters | {"result": result}
        return self.append(task, own | {"valid_flag": int(result.get("task_status") == "COMPLETED")})

    def latest(self, task: str, parameter: str, valid_only: bool = True, run: Any = None, experiment: str | None = None) -> Any:
        """The parameter in the last entry; None without such a table, column or entry."""
        t = self.table(task)
        if t is None or parameter not in t.columns:
            return None
        gen = self.table("gen_cfg") if run is not None or experiment is not None else None
        row = latest_entry(t, parameter, valid_only, gen, run, experiment).first()
        return row[0] if row else None

    def history(self, task: str) -> DataFrame | None:
        t, gen, run = self.table(task), self.table("gen_cfg"), self.table("exec_cfg")
        return None if t is None else linked(t, gen, run)

    def set_valid(self, task: str, entry: int, flag: int = 0) -> None:
        """Marks an entry as (in)valid: the table is written anew beside the old one, then replaces it."""
        t = self.table(task).withColumn("valid_flag", F.when(F.col("id") == entry, flag).otherwise(F.col("valid_flag")))
        t.write.parquet(f"{self.folder}/.{task}.new")
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        a, b, c = (jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{x}") for x in (f".{task}.new", task, f".{task}.old"))
        store = b.getFileSystem(conf)
        store.rename(b, c)
        store.rename(a, b)
        store.delete(c, True)


def latest_entry(task: DataFrame, parameter: str, valid_only: bool = True, gen: DataFrame | None = None, run: Any = None, experiment: str | None = None) -> DataFrame:
    """One row with the parameter of the largest id among (valid) entries of the run; a semi-join keeps the runs."""
    t = task.where("valid_flag = 1") if valid_only else task
    if gen is not None:
        g = gen.where(F.col("run").cast("string") == str(run)) if run is not None else gen
        g = g.where(F.col("experiment") == experiment) if experiment is not None else g
        t = t.join(g, t["gen_cfg_id"] == g["id"], "left_semi")
    return t.agg(F.max_by(F.col(f"`{parameter}`"), "id").alias(parameter))


def selected(rows: DataFrame, column: str, conditions: dict[str, Any] | None = None) -> DataFrame:
    """The column of the rows that meet all conditions; a condition of None is met by null."""
    for k, v in (conditions or {}).items():
        rows = rows.where(F.col(f"`{k}`").eqNullSafe(F.lit(v)))
    return rows.select(F.col(f"`{column}`").alias(column))


def first_known(lookups: list[DataFrame], name: str) -> DataFrame:
    """One row: the value of the first lookup (each one row of one column) that found any."""
    from functools import reduce

    one = [x.toDF(f"_{i}") for i, x in enumerate(lookups)]
    return reduce(DataFrame.crossJoin, one).select(F.coalesce(*[f"_{i}" for i in range(len(one))]).alias(name))  # one row each


def linked(task: DataFrame, gen: DataFrame, run: DataFrame) -> DataFrame:
    """Entries with the columns of their header and execution settings, under gen_ and exec_."""
    g = gen.select(*[F.col(f"`{c}`").alias(f"gen_{c}") for c in gen.columns])
    e = run.select(*[F.col(f"`{c}`").alias(f"exec_{c}") for c in run.columns])
    return task.join(g, F.col("gen_cfg_id") == F.col("gen_id")).join(e, F.col("exec_cfg_id") == F.col("exec_id"))


def numbered(rows: DataFrame, after: int, order: list[str]) -> DataFrame:
    """Rows with ids after the largest one of a table; a batch of new entries is small."""
    return rows.withColumn("id", F.row_number().over(W.orderBy(*order)) + after)


def shared_ids(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Equal rows (null equals null) and the last id of each."""
    return rows.groupBy(*keys).agg(F.max("id").alias("id"), F.count("*").alias("n"))
