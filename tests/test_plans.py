import os

import pytest
from pyspark.sql import functions as F

from shotframe.operators.ledger import Ledger, flatten
from shotframe.plans import config
from shotframe.plans.pipeline import COMPLETED, FAILED, PENDING, WORKFLOWS, Graph, Task, display_path, html_report, lookup, register
from shotframe.streaming import reductions


@pytest.mark.parametrize("text,want", [("/p/{{ experiment }}/file_r{{ run:04d }}.in", "/p/X/file_r0012.in"), ("{{ run:04d }}", 12), ("out_{{ run }}_one", "out_12_one"), ("{{ Other.deep }}", "as it is"), ("{{ $RUNX:04d }}", 7), ("{{ $MISSING_X }}", "{{ $MISSING_X }}"), ("1e3", 1000.0)])
def test_substitution(monkeypatch, text, want):
    monkeypatch.setenv("RUNX", "7")
    tasks = {"T": {"a": text, "n": {"b": text}, "l": [text], "i": 3}, "Other": {"deep": "as it is"}}
    out = config.substitute({"experiment": "X", "run": 12}, tasks)
    assert out["T"]["a"] == want and out["T"]["n"]["b"] == want and out["T"]["l"] == [text] and out["T"]["i"] == 3


def test_environment_fallback(monkeypatch):
    monkeypatch.setenv("TENV_ABC", "5")
    assert config.substitute({}, {"T": {"a": "{{ $ABC }}"}})["T"]["a"] == 5


def test_load(tmp_path):
    (tmp_path / "c.yaml").write_text("run: 3\n---\nT:\n  a: r{{ run:03d }}\n")
    assert config.load(str(tmp_path / "c.yaml")) == ({"run": 3}, {"T": {"a": "r003"}})


def test_arguments():
    fields = {"v": {"flag": "--", "name": "verbose"}, "q": {"flag": "--"}, "x": {"flag": "-"}, "f": {"flag": ""}}
    values = {"v": True, "q": False, "x": 3, "f": "a b", "none": None, "empty": "", "zero": 0, "p_arg1": "pos"}
    assert config.arguments(values, fields) == ["--verbose", "-x", "3", "a", "b", "--zero", "0", "pos"]
    assert config.arguments({"x": 1, "long": 2}, {}, short_eq=True, long_eq=True) == ["-x=1", "--long=2"]


def test_tasks_and_graphs(spark):
    seen = []
    register(Task("one", lambda s, p: s.range(p["n"]), after=[lambda df: {"rows": df.count(), "skip": ""}]).hook("started", lambda *_: seen.append("one")))
    register(Task("bad", lambda s, p: 1 // 0))
    register(Task("after_bad", lambda s, p: 1))
    out = Graph.nested({"task_name": "one", "next": [{"task_name": "bad", "next": [{"task_name": "after_bad"}]}]}).run(spark, {"one": {"n": 3}})
    assert [out[n].task_status for n in ("one", "bad", "after_bad")] == [COMPLETED, FAILED, PENDING]
    assert out["one"].summary == "rows: 3" and seen == ["one"]
    with pytest.raises(ValueError, match="wait"):
        Graph({"a": ["b"], "b": ["a"]}).order()
    with pytest.raises(KeyError, match="one"):
        lookup("onee")


def test_report_and_paths(spark, tmp_path):
    path = html_report(str(tmp_path), "scan", {"t": spark.range(2)})
    assert os.path.exists(path) and display_path("lxt_ttc", "12", "XAS") == "time_scans/0012_lxt_ttc_XAS" and display_path(None, "x") == "time_scans/0000_By_Event_XSS" and display_path("lens_v", 3, "XES") == "lens_scans/0003_lens_v_XES" and display_path("lxe_opa", 3) == "time_scans/0003_lxe_opa_XSS" and display_path("lxe_opa", 3, "XAS") == "power_scans/0003_lxe_opa_XAS" and display_path(None, 7, "XAS", own=True) == "XAS/0007_XAS"


def test_flatten():
    assert flatten({"a": {"b": (1, 2), "c": 1}, "a2": 4, "e": [], "d": [{"x": 1}], "n": [[1], 2]}) == {"a.b[0]": 1, "a.b[1]": 2, "a.c": 1, "a2": 4, "d[0]": '{"x": 1}', "n[0][0]": 1, "n[1]": 2}


def test_ledger(spark, tmp_path):
    led = Ledger(spark, str(tmp_path / "led"))
    assert led.latest("T", "x") is None and led.tables() == []
    head, run = {"experiment": "e1", "run": "12", "work_dir": "/w"}, {"env": "A=1", "poll": 0.05}
    assert led.record("T", head, run, {"x": 1, "deep": {"y": "a"}}, {"task_status": "COMPLETED", "payload": "p"}) == 1
    assert led.record("T", head, run, {"x": 2, "deep": {"y": "b"}}, {"task_status": "FAILED", "payload": None}) == 2
    assert led.record("T", head | {"run": "13"}, run, {"x": 3, "deep": {"y": "c"}, "new": 1.5}, {"task_status": "COMPLETED", "payload": "q"}) == 3
    assert led.tables() == ["T", "exec_cfg", "gen_cfg"]
    assert led.table("gen_cfg").count() == 2 and led.table("exec_cfg").count() == 1
    assert led.latest("T", "x") == 3 and led.latest("T", "x", run="12") == 1 and led.latest("T", "x", valid_only=False, run="12") == 2
    assert led.latest("T", "unknown") is None and led.latest("T", "x", run="99") is None and led.latest("T", "new") == 1.5
    assert led.latest("T", "x", experiment="e2") is None and led.latest("T", "deep.y") == "c"
    assert led.history("T").count() == 3
    led.set_valid("T", 3)
    assert led.latest("T", "x") == 1


def test_streams_equal_batches(spark, tmp_path):
    rows = [(i % 4, i % 3, float((i * 7) % 11), i % 5) for i in range(60)]
    for k in range(3):
        spark.createDataFrame(rows[k * 20 : k * 20 + 20], "row int, col int, value double, n int").write.mode("append").parquet(str(tmp_path / "in"))
    whole = spark.read.parquet(str(tmp_path / "in"))
    live = reductions.live_shots(spark, str(tmp_path / "in"), whole.schema, 1)
    reductions.run_to_memory(reductions.stream_powder_max(live, F.col("n")), "mem_powder")
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(spark.table("mem_powder")) == key(reductions.powder_max(whole, F.col("n")))
    reductions.run_to_memory(reductions.stream_run_sums(live, F.col("n") == 0), "mem_sums")
    assert key(spark.table("mem_sums")) == key(reductions.run_sums(whole, F.col("n") == 0))


def test_unknown_tasks_fail_and_shipped_graphs_know_theirs(spark):
    from shotframe.plans import analyses  # noqa: F401  registers the tasks

    out = Graph({"no such task": [], "after": ["no such task"]}).run(spark, {})
    assert out["no such task"].task_status == FAILED and out["after"].task_status == PENDING
    assert all(lookup(name) for g in WORKFLOWS.values() for name in g.needs)
