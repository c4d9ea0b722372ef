"""Where an empty parameter comes from: the outputs of earlier tasks in the ledger, one run at a time or for all runs at once."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Edge:
    """task's parameter takes a column of source's last entry. made: what becomes of it, as text and as a column, of the value and
    the task's own parameters; valid_only: of valid entries alone."""

    task: str
    parameter: str
    source: str
    column: str
    made: tuple[Callable[[str, dict[str, Any]], str], Callable[[Column, dict[str, Any]], Column]] | None = None
    valid_only: bool = True


def _stem(text: str) -> str:
    return text.split(".")[0]


def _stem_of(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def _folder_of(c: Column) -> Column:
    return F.regexp_extract(c, "^(.*)/[^/]*$", 1)


_HALVES = (lambda v, _: f"{v}1 {v}2", lambda c, _: F.concat(c, F.lit("1 "), c, F.lit("2")))
_SHELLS = (lambda v, p: f"{_stem(v)}_{p['fom']}_n{p['nshells']}.dat", lambda c, p: F.concat(_stem_of(c), F.lit(f"_{p['fom']}_n{p['nshells']}.dat")))
_MERGED = (lambda v, _: f"{_stem(v)}.mtz", lambda c, _: F.concat(_stem_of(c), F.lit(".mtz")))
_FOLDER = (lambda v, _: posixpath.dirname(v), lambda c, _: _folder_of(c))
_TAG = (lambda v, _: _stem(posixpath.basename(v).split("_")[-1]), lambda c, _: _stem_of(F.substring_index(F.substring_index(c, "/", -1), "_", -1)))
_REDIRECT = (lambda v, _: v if v.startswith("<") else f"<{v}", lambda c, _: F.when(c.startswith("<"), c).otherwise(F.concat(F.lit("<"), c)))

#: In the order in which they are tried. Which task's output another one takes, and the names of files made of it.
EDGES = (
    *(Edge(t, "path", "shots", "result.payload") for t in ("scattering", "overlap", "absorption", "absorption_scan", "emission")),
    *(Edge(t, "path", "scattering", "path") for t in ("overlap", "absorption", "emission")),
    Edge("absorption_scan", "path", "absorption", "path"),
    Edge("index", "in_file", "find_peaks", "out_file"),
    Edge("concatenate", "in_dir", "index", "out_file", _FOLDER),
    Edge("concatenate", "tag", "index", "out_file", _TAG),
    Edge("concatenate", "in_dir", "find_peaks", "out"),
    Edge("concatenate", "tag", "find_peaks", "tag"),
    Edge("merge", "in_file", "concatenate", "out"),
    Edge("compare", "in_files", "merge", "out_file", _HALVES),
    Edge("compare", "cell_file", "index", "cell_file", valid_only=False),
    Edge("compare", "symmetry", "merge", "symmetry"),
    Edge("compare", "shell_file", "merge", "out_file", _SHELLS),
    Edge("manipulate", "in_file", "merge", "out_file"),
    Edge("manipulate", "out_file", "merge", "out_file", _MERGED),
    Edge("manipulate", "cell_file", "index", "cell_file", valid_only=False),
    Edge("solve", "in_file", "manipulate", "out_file"),
    Edge("solve", "out_dir", "manipulate", "out_file", _FOLDER),
    Edge("prepare", "in_file", "manipulate", "out_file", _REDIRECT),
)


def filled(ledger: Any, task: str, values: dict[str, Any], run: Any = None, experiment: str | None = None, edges: Iterable[Edge] = EDGES) -> dict[str, Any]:
    """Parameters with the empty ones taken from the last entry of the run that has them; the rest as they are."""
    out = dict(values)
    for e in edges:
        if e.task == task and out.get(e.parameter) in (None, ""):
            found = ledger.latest(e.source, e.column, valid_only=e.valid_only, run=run, experiment=experiment)
            if found not in (None, ""):
                out[e.parameter] = e.made[0](found, out) if e.made else found
    return out


def filled_by_run(tables: dict[str, DataFrame], gen: DataFrame, task: str, values: dict[str, Any], edges: Iterable[Edge] = EDGES) -> DataFrame:
    """(run, parameter, value, source) of a task's empty parameters for all runs at once: of each source the last entry of the
    run (by id) that has the column, of several sources the first. tables: entries (id, gen_cfg_id, valid_flag, columns)
    by task; gen: (id, run)."""
    runs = gen.select(F.col("id").alias("_gen"), F.col("run"))
    parts = []
    for rank, e in enumerate(edges):
        if e.task != task or values.get(e.parameter) not in (None, "") or e.source not in tables or e.column not in tables[e.source].columns:
            continue
        t = tables[e.source]
        t = t.where("valid_flag = 1") if e.valid_only else t
        last = t.join(runs, F.col("gen_cfg_id") == F.col("_gen")).groupBy("run").agg(F.max_by(F.col(f"`{e.column}`").cast("string"), "id").alias("v")).where("v is not null and v <> ''")
        made = e.made[1](F.col("v"), values) if e.made else F.col("v")
        parts.append(last.select("run", F.lit(e.parameter).alias("parameter"), made.alias("value"), F.lit(e.source).alias("source"), F.lit(rank).alias("rank")))
    if not parts:
        return gen.select("run", *(F.lit(None).cast("string").alias(c) for c in ("parameter", "value", "source"))).limit(0)
    both = parts[0]
    for p in parts[1:]:
        both = both.union(p)
    first = both.groupBy("run", "parameter").agg(F.min_by(F.struct("value", "source"), "rank").alias("f"))
    return first.select("run", "parameter", "f.value", "f.source")
