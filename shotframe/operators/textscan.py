"""Scans of text outputs: matching lines, rates, shell tables, concatenation and line rewriting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the geometry text format: keys that are uncommented, the line that peak lists follow, and these.
UNCOMMENTED = ("clen", "photon_energy", "adu_per_eV", "mask", "mask_good", "mask_bad")
DATA_LINE = "data = /entry_1/data_1/data"
PEAK_LINES = ("", "peak_list = /entry_1/result_1", "peak_list_type = cxi")


def numbered_lines(texts: DataFrame, text: str = "text", keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, line_no from 0, line) of every text; a last newline ends the last line."""
    lines = F.split(F.regexp_replace(text, r"\n\z", ""), "\n", -1)
    return texts.where(F.col(text).isNotNull()).select(*keys, F.posexplode(lines).alias("line_no", "line"))


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(line) of all files of the paths and patterns together."""
    return spark.read.text(list(paths)).withColumnRenamed("value", "line")


def concat_files(spark: SparkSession, pattern: str, out: str) -> None:
    """All lines of the matching files under one folder, files in order of their names."""
    lines = spark.read.text(pattern).select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"), "value")
    lines.repartitionByRange("f").sortWithinPartitions("f", "n").select("value").write.text(out)


def grep(lines: DataFrame, words: str, line: str = "line", regex: bool = False) -> DataFrame:
    """Lines with the fixed words, or with a match of the pattern."""
    return lines.where(F.col(line).rlike(words) if regex else F.contains(line, F.lit(words)))


def count_matching(line: Column, words: str) -> Column:
    return F.count_if(F.contains(line, F.lit(words)))


def rate(part: Column, whole: Column) -> Column:
    """part / whole with two decimals; 0.00 of nothing."""
    return F.format_string("%.2f", F.when(whole > 0, part / whole).otherwise(F.lit(0.0)))


def indexing_rate(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row of a stream file: lattices indexed, chunks, and their rate."""
    c = lines.agg(count_matching(F.col(line), "Cell parameters").alias("n_indexed"), count_matching(F.col(line), "End chunk").alias("n_chunks"))
    return c.select("n_indexed", "n_chunks", rate(F.col("n_indexed"), F.col("n_chunks")).alias("rate"))


def shell_table(lines: DataFrame, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, columns: array of double) of the lines that begin with a number; others, as the header, are left out."""
    one = F.trim(F.regexp_replace(line, r"\s+", " "))
    rows = lines.select(*keep, one.alias("_one")).where(F.substring_index("_one", " ", 1).try_cast("double").isNotNull())
    return rows.select(*keep, F.split("_one", " ").try_cast("array<double>").alias("columns"))


def figure_of_merit(header: str) -> str:
    """The third word of a shell table's header."""
    return header.split()[2]


def shells(table: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(resolution in Angstrom, value) of each shell; the first column is in 1/nm."""
    return table.select(*keep, (F.lit(10.0) / F.nullif(F.get("columns", F.lit(0)), F.lit(0.0))).alias("resolution"), F.get("columns", F.lit(1)).alias("value"))


def with_peak_lists(lines: DataFrame, line: str = "line", order: str = "line_no") -> DataFrame:
    """Geometry lines with the known keys uncommented and peak lists named after the data line; line_no anew."""
    key = F.get(F.split(F.col(line), r"\s+"), F.lit(1))
    comment = F.startswith(line, F.lit(";")) & key.isin(*UNCOMMENTED)
    own = F.when(comment, F.substring(line, 3, 1 << 30)).otherwise(F.col(line))
    more = F.when(~F.startswith(line, F.lit(";")) & F.contains(line, F.lit(DATA_LINE)), F.concat(F.array(own), F.array(*map(F.lit, PEAK_LINES)))).otherwise(F.array(own))
    wide = lines.select(F.col(order).alias("_n"), F.posexplode(more).alias("_k", line))
    return wide.select((F.col("_n") * (len(PEAK_LINES) + 1) + F.col("_k")).alias(order), line)


def with_offset_and_resolution(lines: DataFrame, coffset: float, res: float, line: str = "line") -> DataFrame:
    """Geometry lines with the values of every coffset and res entry set."""
    key = F.trim(F.get(F.split(F.col(line), "="), F.lit(0)))
    new = F.when(F.contains(line, F.lit("coffset")), F.concat(key, F.lit(f" = {coffset}"))).when(F.contains(line, F.lit("res = ")), F.concat(key, F.lit(f" = {res}"))).otherwise(F.col(line))
    return lines.withColumn(line, new)


def summary_string(fields: dict[str, Column]) -> Column:
    """'key: value' of the fields that are there and not empty, joined by ';'."""
    return F.concat_ws(";", *[F.when(v.cast("string") != "", F.concat(F.lit(f"{k}: "), v.cast("string"))) for k, v in fields.items()])


def run_name(experiment: Column, run: Column) -> Column:
    return F.concat_ws("_", experiment, F.concat(F.lit("Run"), F.lpad(run.cast("string"), 4, "0")))


def number_or_text(c: Column) -> Column:
    """A whole number, else a number, else the text itself, each as text in its plain form."""
    return F.coalesce(F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint").cast("string")), c.try_cast("double").cast("string"), c)


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def folder_name(path: Column) -> Column:
    """What precedes the last slash; empty without one."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def extension(path: Column) -> Column:
    """The last dot of a file's name and what follows; empty without one, or if the name only begins with it."""
    return F.regexp_extract(base_name(path), r"^.+(\.[^.]*)$", 1)


def last_token(c: Column, separator: str) -> Column:
    return F.substring_index(c, separator, -1)
