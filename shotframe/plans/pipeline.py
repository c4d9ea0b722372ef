"""Named analysis tasks, steps before and after them, results, and graphs of tasks."""

from __future__ import annotations

import difflib
import html
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

PENDING, RUNNING, COMPLETED, FAILED = "PENDING", "RUNNING", "COMPLETED", "FAILED"


@dataclass
class Result:
    task_name: str
    task_status: str = PENDING
    summary: str = ""
    payload: Any = None
    impl_schemas: str | None = None
    seconds: float = 0.0


@dataclass
class Task:
    """transform(spark, parameters) gives a DataFrame or any other payload. before and after are small steps that
    get the parameters, or the payload, and may give a part of the summary; hooks are called by signal."""

    name: str
    transform: Callable[[SparkSession, dict], Any]
    before: list[Callable[[dict], Any]] = field(default_factory=list)
    after: list[Callable[[Any], Any]] = field(default_factory=list)
    hooks: dict[str, list[Callable[[str, Any], None]]] = field(default_factory=dict)
    result_from: str | None = None  #: the parameter that is the result, as of a task that writes a file it was given

    def hook(self, signal: str, call: Callable[[str, Any], None]) -> Task:
        self.hooks.setdefault(signal, []).append(call)
        return self

    def _tell(self, signal: str, value: Any = None) -> None:
        for call in self.hooks.get(signal, []):
            call(signal, value)

    def run(self, spark: SparkSession, parameters: dict) -> Result:
        """Failures are the result's status and summary, and end the task."""
        result, begun = Result(self.name, RUNNING), time.monotonic()
        self._tell("started")
        try:
            for step in self.before:
                step(parameters)
            result.payload = self.transform(spark, parameters)
            if self.result_from is not None:
                result.payload = parameters[self.result_from]
            parts = [step(result.payload) for step in self.after]
            result.summary = ";".join(f"{k}: {v}" for p in parts if isinstance(p, dict) for k, v in p.items() if v not in (None, ""))
            result.task_status = COMPLETED
        except Exception as e:  # noqa: BLE001  any failure of a task is its result
            result.task_status, result.summary = FAILED, f"{type(e).__name__}: {e}"
        result.seconds = time.monotonic() - begun
        self._tell("result" if result.task_status == COMPLETED else "stopped", result)
        return result


REGISTRY: dict[str, Task] = {}


def register(task: Task) -> Task:
    REGISTRY[task.name] = task
    return task


def lookup(name: str) -> Task:
    """The task of that name; the error names the nearest ones."""
    if name not in REGISTRY:
        near = difflib.get_close_matches(name, REGISTRY, n=3)
        raise KeyError(f"no task {name!r}" + (f"; did you mean {', '.join(near)}?" if near else ""))
    return REGISTRY[name]


@dataclass
class Graph:
    """Task names and what has to end well before each."""

    needs: dict[str, list[str]]

    @classmethod
    def nested(cls, node: dict | Iterable[dict]) -> Graph:
        """From {task_name, next: [...]}, or several."""
        needs: dict[str, list[str]] = {}

        def walk(n: dict, above: str | None) -> None:
            own = needs.setdefault(n["task_name"], [])
            if above and above not in own:
                own.append(above)
            for x in n.get("next", []):
                walk(x, n["task_name"])

        for n in [node] if isinstance(node, dict) else node:
            walk(n, None)
        return cls(needs)

    def order(self) -> list[str]:
        left, out = dict(self.needs), []
        while left:
            ready = sorted(n for n, ns in left.items() if not set(ns) & left.keys())
            if not ready:
                raise ValueError("the tasks wait for each other: " + ", ".join(sorted(left)))
            out += ready
            for n in ready:
                del left[n]
        return out

    def run(self, spark: SparkSession, parameters: dict[str, dict], always: frozenset[str] = frozenset()) -> dict[str, Result]:
        """Runs the registered tasks in order; one whose needs failed is left PENDING, unless it is in always."""
        done: dict[str, Result] = {}
        for name in self.order():
            if name not in always and any(done[n].task_status != COMPLETED for n in self.needs[name] if n in done):
                done[name] = Result(name)
                continue
            try:
                task = lookup(name)
            except KeyError as e:
                done[name] = Result(name, FAILED, summary=str(e.args[0]))
                continue
            done[name] = task.run(spark, parameters.get(name, {}))
        return done


#: Workflows of registered analyses: which follow which. External programs have no task here, nor have graphs of them.
WORKFLOWS = {
    "shots": Graph({"scattering": [], "overlap": ["scattering"], "absorption": [], "absorption_scan": ["absorption"], "emission": []}),
    "crystals": Graph({"find_peaks": []}),
    "geometry": Graph({"geometry": []}),
}


def last_result(entries: DataFrame, task_output: str = "path") -> str | None:
    """The output of the latest valid entry of a task in the ledger, as default for a parameter left empty."""
    from shotframe.operators.ledger import latest_entry

    row = latest_entry(entries, task_output).first()
    return row[0] if row else None


def html_report(path: str, title: str, tables: dict[str, DataFrame], rows: int = 500) -> str:
    """Writes small results (the first rows of each) as a plain page of tables under path/title/report.html."""
    parts = [f"<h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        found = df.limit(rows + 1).collect()
        body = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>" for r in found[:rows])
        more = f"<p>The first {rows} rows; there are more.</p>" if len(found) > rows else ""
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>{more}")
    to = Path(path) / title / "report.html"
    to.parent.mkdir(parents=True, exist_ok=True)
    to.write_text("<!doctype html><meta charset=utf-8>" + "".join(parts))
    return str(to)


def display_path(scan_name: str | None, run: int | str, kind: str = "XSS", own: bool = False) -> str:
    """Where a scan's report is shown: by the kind of scan (scattering has none of laser power), then the run with four
    digits (0 if it is no number), the scan's name (By_Event without one) and the kind of analysis. own: of a report that
    belongs to no scan, kind/run_kind."""
    if own:
        return f"{kind}/{int(run) if str(run).isdigit() else 0:04d}_{kind}"
    name = scan_name or "By_Event"
    folder = "lens_scans" if "lens" in name else "power_scans" if "lxe_opa" in name and kind != "XSS" else "time_scans"
    return f"{folder}/{int(run) if str(run).isdigit() else 0:04d}_{name}_{kind}"
