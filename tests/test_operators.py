import math
import random
import re

import pytest
from pyspark.sql import functions as F

from siltworks.functions import normalize as N
from siltworks.functions import text as T
from siltworks.operators import clustering as CL
from siltworks.operators import conversation as C
from siltworks.operators import filters as FI
from siltworks.operators import labels as L
from siltworks.operators import lookups as LU
from siltworks.operators import planning as P
from siltworks.operators import rarity as R
from siltworks.operators import slicing as SL
from siltworks.operators import stats as S
from siltworks.operators import value as V
from siltworks.operators.components import connected_components

TURNS = "array<struct<from:string,value:string>>"


def one(spark, col, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in zip(values, [TURNS if isinstance(v, list) else "string" if isinstance(v, str) else "double" for v in values.values()], strict=True)))
    return df.select(col.alias("x")).first().x


def test_mid_rank_with_ties(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 1, 5, 2, 2, 2, 9])], "i int, v double")
    got = [r.pct for r in R.mid_rank(df, "v", []).orderBy("i").collect()]
    assert got == [4.5 / 6, 0, 4.5 / 6, 2 / 6, 2 / 6, 2 / 6, 1]


def test_mid_rank_of_one_and_of_none(spark):
    df = spark.createDataFrame([(1, "a", 3.0), (2, "b", None)], "i int, g string, v double")
    got = {r.i: r.pct for r in R.mid_rank(df, "v", ["g"]).collect()}
    assert got == {1: 0, 2: None}


def test_idf(spark):
    df = spark.createDataFrame([(99,), (2000,)], "n long")
    a, b = (r.x for r in df.select(R.idf(F.col("n"), 1000).alias("x")).collect())
    assert a == pytest.approx(math.log2(10)) and b == 0


def test_shrink(spark):
    rows = [(v, c) for v in (5.4, 5.5, 8.0) for c in (0.0, 0.5, 1.0, None)]
    got = [r.x for r in spark.createDataFrame(rows, "v double, c double").select(V.shrink(F.col("v"), F.col("c")).alias("x")).collect()]
    assert got == [5.4] * 4 + [5.5] * 4 + [5.5, 6.75, 8.0, 8.0]


def test_value_needs_two_parts(spark):
    df = spark.createDataFrame([(6.0, None, None), (6.0, 8.0, None), (2.0, 3.0, None)], "c double, q double, r double")
    got = [r.x for r in df.select(V.value_score(F.col("c"), F.col("q"), F.col("r"), F.lit(None).cast("double"), F.lit(1.0)).alias("x")).collect()]
    assert got[0] is None and got[1] == pytest.approx((6 * 0.25 + 8 * 0.4 + 5 * 0.15) / 0.8) and got[2] == pytest.approx(max(1, (2 * 0.25 + 3 * 0.4 + 5 * 0.15) / 0.8 * 0.7))


def conv(*roles):
    return [(r, f"{r}{i}") for i, r in enumerate(roles)]


def test_slices(spark):
    df = spark.createDataFrame([("a", conv("human", "gpt", "human", "gpt", "human", "gpt")), ("b", conv("human", "gpt")), ("c", conv("human")), ("d", None)], f"id string, turns {TURNS}")
    got = {}
    for r in SL.slices(df).collect():
        got.setdefault(r.id, []).append((r.slice_id, len(r.slice)))
    assert sorted(got["a"]) == [("a_t1", 2), ("a_t2", 4), ("a_t3", 6)] and got["b"] == [("b", 2)] and got["c"] == [("c", 1)] and got["d"] == [("d", 0)]


def test_windows_keep_every_turn(spark):
    df = spark.createDataFrame([(i, conv(*(["system", "human", "gpt"] + ["human", "tool", "gpt"] * i))) for i in range(1, 9)], f"i int, turns {TURNS}")
    for r in SL.windows(df, longer_than=6, size=6, stride=4).collect():
        assert 0 <= r.turn_start <= r.turn_end < len(r.turns) and len(r.body) == r.turn_end - r.turn_start + 1
        if r.total_windows > 1:
            assert r.prefix_turns == 3 and r.body[0]["from"] in ("human", "system") and r.body[-1]["from"] in ("gpt", "tool")


def test_whole_rows_limit_keeps_an_oversized_first_row(spark):
    df = spark.createDataFrame([(1, 9), (2, 1)], "i int, n_slices int")
    assert [r.i for r in SL.whole_rows_limit(df, 5, ["i"]).collect()] == [1]


def test_sparse_schedule(spark):
    def places(n, **params):
        return [r.id for r in spark.range(n).where(P.scheduled(F.col("id"), F.lit(n), **params)).orderBy("id").collect()]

    assert places(0) == [] and places(12) == list(range(12))
    assert places(60) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 13, 17, 22, 29, 37, 45, 53, 59]
    assert places(20, full_label_count=3, threshold=2, min_gap=1, max_gap=5, gap_multiplier=1.0) == list(range(20))


def test_segments_merge_and_anchors(spark):
    def plan(*flags, **params):
        b = [(0.0, [], bool(x), False) for x in flags]
        df = spark.createDataFrame([(b,)], "b array<struct<score:double,reasons:array<string>,boundary:boolean,hard:boolean>>")
        return df.select(P.segment_plan(F.col("b"), **params).alias("p")).first().p

    p = plan(0, 1, 0, 0, 1, 0)
    assert [x.segment for x in p] == [0, 0, 0, 0, 1, 1] and p[0].why == "segment_start" and (p[-1].segment, p[-1].anchor, p[-1].why) == (1, True, "segment_end")
    assert [x.segment for x in plan(0, 0, 0, 1, 1, 0)] == [0, 0, 0, 0, 1, 1] and plan() == []
    long = plan(*[0] * 9)
    assert [x.anchor for x in long] == [i in (0, 4, 8) for i in range(9)] and [x.distance for x in long] == [0, 1, 2, 1, 0, 1, 2, 1, 0]
    dense = plan(0, 1, 1, 1, 1, 1, 1, 1, 0, fallback_ratio=0.5)
    assert all(x.fallback and x.segment == 0 and x.confidence == 0 for x in dense) and [x.anchor for x in dense] == [True, *[False] * 7, True]
    assert not plan(0, 1, 1, 1, 1, 1, 1, fallback_ratio=0.5)[0].fallback  # fewer than eight slices


def test_label_plan_takes_the_smaller_one(spark):
    rows = [("a", i, False, 0 if i < 10 else 1, i in (0, 9, 10, 19), False) for i in range(20)] + [("b", i, False, i, True, False) for i in range(20)] + [("c", i, False, 0, i in (0, 19), True) for i in range(20)] + [("d", 0, False, 0, True, False)]
    df = spark.createDataFrame(rows, "k string, i int, hard boolean, segment int, anchor boolean, fallback boolean")
    got = {}
    for r in P.label_plan(df, "k", ["i"]).orderBy("k", "i").collect():
        got.setdefault(r.k, []).append(r)
    assert {k: v[0].policy for k, v in got.items()} == {"a": "anchors", "b": "schedule", "c": "schedule", "d": "schedule"}
    assert [r.i for r in got["a"] if r.labelled] == [0, 9, 10, 19] and got["a"][8].source_pos == 9 and got["a"][11].source_pos == 19 and got["d"][0].labelled


def test_inheritance_stops_at_hard_edges(spark):
    df = spark.createDataFrame([("c", i, i == 11) for i in range(14)], "ck string, t int, hard boolean")
    got = {r.pos: (r.labelled, r.source_pos) for r in P.inheritance(df, "ck", ["t"], "hard").collect()}
    assert got[9] == (False, 10) and got[11][1] == 13 and got[10] == (True, None) and all(got[i] == (True, None) for i in range(8))


def test_prune(spark):
    rows = [(k, i, v) for k, vs in {"a": [1], "b": [1, 1], "c": [9, 1, 9], "d": [1, 1, 1, 1, 1, 1], "e": [9, 2, 1, 2, 2, None, 9]}.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame([(k, i, None if v is None else float(v)) for k, i, v in rows], "k string, i int, v double")
    got = {}
    for r in FI.prune_turns(df, "k", ["i"], "v", F.col("v") >= 6).collect():
        got.setdefault(r.k, set()).add(r.i)
    assert got == {"a": {0}, "b": {0, 1}, "c": {0, 2}, "d": {0, 1, 5}, "e": {0, 1, 3, 6}}


def test_lookup_drops_ambiguous_ids(spark):
    rec = spark.createDataFrame([("i1", None, None, "f", 1.0, 1.0), ("i2", None, None, "f", 2.0, 2.0), ("i2", None, None, "g", 3.0, 3.0), ("i3", "u", "k", "f", 4.0, 4.0)], "conversation_id string, conversation_uid string, conversation_key string, source_file string, conv_value double, conv_selection double")
    s = spark.createDataFrame([("x", "y", "i1"), ("x", "y", "i2"), ("k", "y", "z"), ("x", "u", "z")], "conversation_key string, conversation_uid string, source_id string")
    assert sorted((r.source_id, r.found_by) for r in LU.conversation_lookup(s, rec).collect()) == [("i1", "legacy"), ("i2", "none"), ("z", "key"), ("z", "uid")]


def test_components_random(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    want = {x: root(x) for x in parent}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_combo_key_and_tags(spark):
    schema = "row_id int, labels struct<intent:string,language:array<string>,domain:array<string>,task:array<string>,difficulty:string,concept:array<string>,agentic:array<string>,constraint:array<string>,context:string,confidence:map<string,double>>"
    df = spark.createDataFrame([(1, ("make", ["b", "a", "a", None, ""], [], None, "", ["z", "y", "x", "w"], None, None, None, {"language": 0.5})), (2, None)], schema).withColumn("inherited", F.lit(False))
    assert [r.x for r in df.select(L.combo_key(F.col("labels")).alias("x")).collect()] == ["intent=make|language=a,b|concept=w,x,y", None]
    got = sorted((r.dim, r.tag, r.confidence) for r in L.tags_long(df, ["row_id"]).collect())
    assert got.count(("language", "a", 0.5)) == 2 and ("intent", "make", 0.75) in got and len(got) == 8


def test_order_statistics(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(None,), (float("nan"),)], "v double")
    assert {r.pct: r.value for r in S.order_statistics(df, "v", (0, 50, 100)).collect()} == {0: 0, 50: 5, 100: 9}
    assert {r.pct: r.value for r in S.order_statistics(df, "v", (50,), nearest=True).collect()} == {50: 4}


def test_turn_metrics(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([1, 9, 3, 5, 7])] + [("b", 0, None)], "k string, i int, v double")
    m = C.turn_metrics(df, "k", "v", ["i"]).collect()
    assert len(m) == 1 and m[0].median == 5 and m[0].bottom_mean == 3 and m[0].late_gain == 6


def test_text_functions(spark):
    t = F.col("t")
    assert one(spark, N.strip_cot(t), t="<think>a\nb</think> c [unused16]x[unused17]") == "c"
    assert one(spark, N.cot_text(t), t="[unused16]p[unused17]<think> q </think>") == "q\n\np"
    assert one(spark, T.fence_languages(t), t="```py\n```\n```RS\n```zzz") == ["python", "rust"]
    assert one(spark, T.code_blocks(t), t="```a``` ```") == 1
    assert one(spark, T.truncate(t, 400), t="x" * 400) == "x" * 400 and len(one(spark, T.truncate(t, 400), t="x" * 4000)) <= 400
    assert one(spark, T.char_ngrams(t), t="ab") == ["ab"] and one(spark, T.char_ngrams(t), t=" ") == []
    text = "".join(f"{i:05d}" for i in range(1800))
    cut = one(spark, T.fragments(t, 2000), t=text)
    gaps = re.findall(r"\n\[\.\.\. (\d+) chars omitted", cut)
    assert len(cut) <= 2000 and len(gaps) == 4 and one(spark, T.fragments(t, 5), t="ab") == "ab" and cut.startswith(text[:500]) and cut.endswith(text[-500:])
    assert len(re.sub(r"\n\[\.\.\. [^\]]*\]\n", "", cut)) + sum(map(int, gaps)) == len(text)  # nothing but what the notes say is gone
    assert one(spark, T.language_mix(t)["dominant"], t="中文 abc") == "mixed"


def test_segments(spark):
    ts = [("system", "s"), ("human", "q1"), ("gpt", "a1"), ("human", "q2"), ("tool", "t"), ("gpt", "a2")]
    s = one(spark, T.segments(F.col("ts")), ts=ts)
    assert (s.request, s.response, s.n_tools, s.pattern) == ("q2", "a2", 1, "human,tool,gpt") and s.trajectory == "[Tool Result] t"


def test_hash_embedding_and_semhash(spark):
    df = spark.createDataFrame([("a", "the quick brown fox"), ("b", "the  quick brown FOX"), ("c", "")], "k string, t string")
    v = CL.embeddings(df, "k", "t", 64)
    e = {r.k: r.embedding for r in v.collect()}
    assert e["a"] == e["b"] and math.isclose(sum(x * x for x in e["a"]), 1, rel_tol=1e-5) and not any(e["c"])
    h = CL.semhash(v, "k", dim=64, bits=128)
    w = {r.k: r.hash for r in h.collect()}
    assert w["a"] == w["b"] and len(w["a"]) == 2
    planes = CL.hyperplanes(64, 128, 42)
    want = sum(1 << i for i, p in enumerate(planes) if float(p @ e["a"]) >= 0)
    assert sum((x % 2**64) << (64 * i) for i, x in enumerate(w["a"])) == want
    got = CL.neighbours(v, h, "k", radius=64, cosine=0.8, n_bands=8, bits=128).collect()
    assert ("b", "a") in {(r.a, r.b) for r in got}


def test_neighbours_of_hot_buckets(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    centre = rng.normal(size=64)
    v = [(i, (centre + rng.normal(size=64) * 1.2).astype(np.float32).tolist()) for i in range(120)]
    v = spark.createDataFrame(v, "k long, embedding array<float>")
    h = CL.semhash(v, "k", dim=64, bits=64)
    got = [{(r.a, r.b) for r in CL.neighbours(v, h, "k", radius=28, cosine=0.2, top_k=200, n_bands=8, bits=64, hot=n).collect()} for n in (1000, 8, 1)]
    assert got[0] == got[1] == got[2] and len(got[0]) > 1000


def test_filter_null_semantics(spark):
    schema = "i int, value_score double, selection_score double, correctness int, thinking_mode string, difficulty string, source_file string, inherited boolean, partial boolean"
    df = spark.createDataFrame([(1, 7.0, 7.0, None, None, None, None, None, None), (2, None, 7.0, 5, "", "", "", False, False), (3, 7.0, None, 5, "slow", "hard", "f", True, False), (4, 7.0, 7.0, 1, "fast", "hard", "f", False, True)], schema)
    run = lambda **k: {r.i for r in df.where(FI.matches(FI.FilterConfig(**k))).collect()}
    assert run() == {1, 2, 3} and run(value_min=5) == {1, 3} and run(selection_min=5) == {1} and run(selection_min=5, include_unscored=True) == {1, 2, 3}
    assert run(correctness_min=5) == {1, 2, 3} and run(thinking_mode="fast") == {1, 2} and run(difficulty=("hard",)) == {1, 2, 3} and run(exclude_inherited=True) == {1, 2}
