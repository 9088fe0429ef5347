from pyspark.sql import functions as F

from siltworks.functions.budgets import within_budget, within_scoring
from siltworks.operators import extensions as E
from siltworks.operators import inline as I
from siltworks.operators.trajectory import structure


def test_fold_replaces_by_turn(spark):
    raw = spark.createDataFrame([(1, [(1, {"task": ["a"]}, False, None, 1.0), (2, {}, False, None, 2.0)]), (2, None)], f"k int, label_turns array<{I.LABEL}>")
    new = spark.createDataFrame([(1, 2, {"task": ["b"]}, False, None, 5.0), (1, 3, {}, True, 2, None), (2, 1, {}, False, None, 3.0)], "k int, turn_index int, labels map<string,array<string>>, inherited boolean, inherited_from int, value_score double")
    out = I.fold(raw, new, "k")
    got = {r.k: [(t.turn_index, t.value_score) for t in r.label_turns] for r in out.collect()}
    assert got == {1: [(1, 1.0), (2, 5.0), (3, None)], 2: [(1, 3.0)]}
    assert I.embedded(out, "k", require_labels=True).count() == 2 and I.embedded(out, "k", require_value=True).count() == 3
    assert out.select(F.explode(I.without_scores(F.col("label_turns"))).alias("t")).where("t.value_score is not null").count() == 0


def budgeted(spark, turns, budget):
    df = spark.createDataFrame([(1, turns)], "k int, turns array<struct<from:string,value:string>>")
    r = within_budget(df, "k", budget=budget).first()
    return [(t["from"], t["value"]) for t in r.turns], r.truncated


def test_budget(spark):
    turns = [("human", "h" * 900), *[("gpt" if i % 2 else "tool", f"{i}" * 700) for i in range(8)], ("gpt", "z" * 900)]
    out, cut = budgeted(spark, turns, 3000)
    assert cut and sum(len(v) for _, v in out) < 3300 and out[0][1][0] == "h" and out[-1] == ("gpt", "z" * 900) and out[1] == ("system", "[... 7 middle turns omitted for labeling ...]") and out[2] == ("gpt", "7" * 700)
    assert budgeted(spark, turns, 10**6) == (turns, False)
    assert budgeted(spark, [("system", "s" * 99), ("human", "q")], 50) == ([("system", "s" * 50)], True)
    one, _ = budgeted(spark, [("human", "a" * 5000)], 1000)
    assert len(one) == 1 and len(one[0][1]) == 1000
    two, _ = budgeted(spark, [("human", "a" * 5000), ("gpt", "b" * 5000)], 2000)
    assert [len(v) for _, v in two] == [800, 1200]
    marked, cut = budgeted(spark, [("human", "<issue>" * 50 + "q</issue>"), ("gpt", "a")], 60)
    assert marked == [("human", "q"), ("gpt", "a")] and not cut  # marks go before anything is measured
    assert budgeted(spark, [("human", None)], 10) == ([("human", "")], False) and budgeted(spark, None, 10) == ([], False) and budgeted(spark, [], 10) == ([], False)


def test_scoring_budget(spark):
    ts = [("human", "p" * 3000), ("gpt", "e" * 3000), ("human", "q" * 3000), ("tool", "t" * 3000), ("gpt", "r" * 3000)]
    df = spark.createDataFrame([(1, ts, "slow", "c" * 9000), (2, ts, "fast", None), (3, ts[2:3] + [("gpt", "r")], "slow", "c"), (4, [], "fast", "")], "k int, ts array<struct<from:string,value:string>>, mode string, cot string")
    got = {r.k: r.s for r in df.select("k", within_scoring(F.col("ts"), F.col("mode"), F.col("cot"), 8000).alias("s")).collect()}
    size = lambda s: sum(len(s[k] or "") for k in ("prior", "request", "trajectory", "cot", "response"))
    assert got[1].truncated and size(got[1]) <= 7600 and len(got[1].cot) <= 3420 and len(got[1].request) == 1140 and got[1].cot_chars == 9000
    assert got[2].truncated and got[2].cot is None and size(got[2]) <= 7600 and got[2].response.endswith("r")
    assert not got[3].truncated and (got[3].request, got[3].cot, got[3].response) == ("q" * 3000, "c", "r") and size(got[4]) == 0


def test_inherit_and_plan(spark):
    s = spark.createDataFrame([("c", 0, None, "x"), ("c", 1, 0, None), ("d", 1, 0, None)], "k string, pos int, src int, intent string")
    got = {(r.k, r.pos): (r.intent, r.inherited) for r in I.inherit(s, "k", "pos", "src", ["intent"]).collect()}
    assert got == {("c", 0): ("x", False), ("c", 1): ("x", True), ("d", 1): (None, False)}
    p = spark.createDataFrame([(True, True), (True, False), (False, False)], "h boolean, v boolean")
    assert [r.x for r in p.select(I.plan_mode(F.col("h"), F.col("v"), "incremental").alias("x")).collect()] == ["keep", "label", "label"]


def test_structure(spark):
    ts = [("human", "q"), ("gpt", '<tool_call>{"name": "run", "arguments": {}}</tool_call>'), ("tool", "$ pytest\nsrc/a.py\n3 passed"), ("gpt", "Updated b.py")]
    s = spark.createDataFrame([(ts,), ([],)], "ts array<struct<from:string,value:string>>").select(structure(F.col("ts")).alias("s")).collect()
    assert s[0].s.tools == ["run"] and s[0].s.tool_turns == 2 and s[0].s.test_turns == 1 and s[0].s.files == 2 and s[0].s.shell_turns == 1 and s[1].s.tool_ratio == 0


def test_extension_spec(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"id": "ui", "spec_version": 1, "trigger": {"domain_any_of": ["web"]}, "schema": {"kind": {"type": "enum", "options": ["a", "b"]}, "parts": {"type": "multi_enum", "options": ["x", "y"]}}}')
    (spec,) = E.load_specs([str(tmp_path / "s.json")])
    assert spec.any_of == {"domain": ("web",)} and spec.multi == ("parts",) and len(spec.digest()) == 64
    df = spark.createDataFrame([({"kind": ["a"], "parts": ["y", "z"]},), ({"kind": ["a", "b"]},), ({},)], "r map<string,array<string>>")
    v = [r.v for r in df.select(E.validated(spec, F.col("r")).alias("v")).collect()]
    assert [x.status for x in v] == ["success", "invalid", "invalid"] and v[0].labels["parts"] == ["y"] and v[0].unmapped[0].value == "z"
