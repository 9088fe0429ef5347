import collections
import itertools
import random
from datetime import datetime

import numpy as np
import pytest

from siltworks.llm import capping, common, neardup, pairs, terms
from siltworks.llm.tokens import shingles, tokenize

CONV = "row_id long, id string, conversations array<struct<from:string,value:string>>, metadata struct<source_file:string>, ingested_at timestamp, text string"
LABELS = "struct<intent:string,language:array<string>,domain:array<string>,task:array<string>,concept:array<string>,agentic:array<string>,constraint:array<string>>"
AT = datetime(2026, 1, 1)


def words(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


VOCAB = [f"{a}{b}{c}" for a in "bdfgklmnprstv" for b in "aeiou" for c in "bdgklmnrst"]


def test_tokens_are_words_and_characters():
    t = tokenize(["Ab_c d2 中文x", None, "", "AB"])
    assert t.doc.tolist() == [0, 0, 0, 0, 0, 0, 3] and t.h[0] == t.h[6] and len(set(t.h.tolist())) == 6
    h, at = shingles(t.h, t.doc, 3)
    assert at.tolist() == [0, 1, 2, 3, 6] and len(shingles(t.h[:0], t.doc[:0], 3)[0]) == 0


def test_near_duplicates(spark):
    rng = random.Random(1)
    rows, base = [], [[("human", words(rng, 30)), ("gpt", words(rng, 60)), ("human", words(rng, 20)), ("gpt", words(rng, 50))] for _ in range(30)]
    want = {}
    for g, b in enumerate(base):
        for k in range(rng.randrange(1, 5)):
            c = [list(t) for t in b]
            if k == 1:
                c = [["user", c[0][1]], *[list(t) for t in c[1:]]]
            if k >= 2:
                w = c[1][1].split()
                w[rng.randrange(len(w))] = "changed"
                w.insert(3, "added")
                c[1][1] = " ".join(w)
            if k == 3:
                c = c[2:] + c[:2]
            want[len(rows)] = g
            rows.append((len(rows), "i", [tuple(t) for t in c], None, AT, "clash"))
    shared = words(rng, 60)
    for _ in range(5):  # a shared system prompt isn't enough
        want[len(rows)] = f"s{len(rows)}"
        rows.append((len(rows), None, [("system", shared), ("human", words(rng, 40)), ("gpt", words(rng, 90))], None, AT, None))
    n = len(rows)
    rows += [(n, "x", None, None, None, None), (n + 1, "x", [], None, None, None), (n + 2, "x", [("human", None)], None, AT, None), (n + 3, "x", [("User ", None)], None, AT, None)]
    want[n + 2] = want[n + 3] = "null"
    got = {r.row_id: r.group_id for r in neardup.groups(spark.createDataFrame(rows, CONV)).collect()}
    assert set(got) == set(want)
    same = lambda m: {(a, b) for a, b in itertools.combinations(sorted(m), 2) if m[a] == m[b]}
    assert same(got) == same(want)
    found = neardup.group_pairs(neardup.groups(spark.createDataFrame(rows, CONV))).collect()
    assert {tuple(r) for r in found} == same(want)


def test_near_duplicates_in_hot_groups(spark):
    """A third exact copies, a third near copies of one text, and lists over the limit among the rest."""
    rng = random.Random(2)
    hot, near, prompt = words(rng, 80), words(rng, 80).split(), words(rng, 70)
    rows = []
    for i in range(450):
        if i % 3 == 0:
            text = hot
        elif i % 3 == 1:
            w = list(near)
            w[rng.randrange(80)] = rng.choice(VOCAB)
            text = " ".join(w)
        else:
            text = prompt + " " + words(rng, 110)
        rows.append((i, "i", [("human", text)], None, AT, None))
    for p in range(3):  # twins among those that share the prompt
        rows.append((1000 + p, "i", [("human", rows[2 + 3 * p][2][0][1] + " one more")], None, AT, None))
    got = {r.row_id: r.group_id for r in neardup.groups(spark.createDataFrame(rows, CONV), long_list=20).collect()}
    sizes = sorted(collections.Counter(got.values()).values(), reverse=True)
    assert sizes[:5] == [150, 150, 2, 2, 2] and len(sizes) == 2 + 150 and all(got[1000 + p] == 2 + 3 * p for p in range(3))


def test_near_duplicates_by_common_texts_only(spark):
    """Prompts and questions that many rows share, short replies: groups as by brute force, whatever is a long list."""
    rng = random.Random(6)
    prompts, questions = [words(rng, 60) for _ in range(4)], [words(rng, 60) for _ in range(4)]
    rows = [(i, "i", [("system", prompts[i % 4]), ("human", questions[i // 4 % 4]), ("gpt", words(rng, 24))], None, AT, None) for i in range(320)]
    rows += [(1000 + i, "i", [("system", prompts[i % 4]), ("human", words(rng, 90))], None, AT, None) for i in range(40)]
    got = {n: {r.row_id: r.group_id for r in neardup.groups(spark.createDataFrame(rows, CONV), long_list=n).collect()} for n in (12, 1000)}
    assert got[12] == got[1000] == {i: i % 16 if i < 320 else i for i, *_ in rows}


def test_near_duplicates_with_scattered_edits(spark):
    """Pairs with every eighth to seventh word changed at random: the exact check decides, candidates hardly lose any."""
    rng = random.Random(8)
    rows, alike = [], []
    for i in range(300):
        a = words(rng, 120).split()
        b = list(a)
        for at in rng.sample(range(120), rng.randrange(12, 19)):
            b[at] = rng.choice(VOCAB)
        three = [{tuple(w[j : j + 3]) for j in range(118)} for w in (a, b)]
        if len(three[0] & three[1]) >= neardup.COMMON * max(map(len, three)):
            alike.append((2 * i, 2 * i + 1))
        rows += [(2 * i, "i", [("human", " ".join(a))], None, AT, None), (2 * i + 1, "i", [("human", " ".join(b))], None, AT, None)]
    got = {r.row_id: r.group_id for r in neardup.groups(spark.createDataFrame(rows, CONV)).collect()}
    found = sum(got[a] == got[b] for a, b in alike)
    print("recall", found, "of", len(alike))
    assert len(alike) > 200 and found >= 0.95 * len(alike)


def test_near_duplicates_send_no_pairs_that_have_too_little_in_common(spark):
    """Rows with half of their text in common with 250 others each, but never enough: no stage shuffles more rows than there are coordinates, whatever number of pairs meets."""
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    common = [words(250) for _ in range(4)]
    rows = [(i, [("human", common[i % 4]), ("gpt", words(150))]) for i in range(1000)]
    df = spark.createDataFrame(rows, "row_id long, conversations array<struct<from:string,value:string>>")

    store = spark.sparkContext._jsc.sc().statusStore()

    def sent() -> dict[int, int]:
        """Rows that each stage shuffled."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}

    before = sent()
    assert len({r.group_id for r in neardup.groups(df, matches=19, common=0.8).collect()}) == 1000
    most = max(n for i, n in sent().items() if i not in before)
    assert most <= 32 * len(rows)  # a row for each coordinate


def test_overlaps():
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]
    assert neardup.overlaps(sets[:12], sets[12:]).tolist() == want


def test_near_duplicates_of_nothing(spark):
    assert neardup.group_pairs(neardup.groups(spark.createDataFrame([], CONV))).collect() == []


def labelled(spark, rows):
    return spark.createDataFrame([(i, k, lab, AT if at is None else at, "x") for i, k, lab, at in rows], f"row_id long, id string, labels {LABELS}, ingested_at timestamp, tag string")


def lab(**k):
    return tuple(k.get(f) for f in ("intent", "language", "domain", "task", "concept", "agentic", "constraint"))


def test_tags_in_their_spelling(spark):
    df = spark.createDataFrame([(" \tA b__C \t",), ("_",), ("",), ("Ä x",), (None,)], "t string")
    assert [r.x for r in df.select(common.norm_tag(df.t).alias("x")).collect()] == ["a-b-c", "-", "", "ä-x", None]


def test_tag_frequency(spark):
    rows = [(1, "a", lab(concept=["X", "x", None, " "], language=[]), None), (2, "a", lab(concept=["late"]), datetime(2026, 1, 2)), (3, "a", lab(concept=["later row"]), datetime(2026, 1, 2)), (4, "b", None, None), (5, None, lab(concept=["n"], task=["t", "t"]), None), (6, None, lab(concept=["n"]), None)]
    got = {(r.field, r.tag): (r.occurrences, r.records, r.mark) for r in terms.tag_frequency(labelled(spark, rows), rare_max=1, common_percent=12).collect()}
    assert got == {("concept", "later-row"): (1, 1, "rare"), ("concept", "n"): (2, 2, "common"), ("task", "t"): (2, 1, "rare")}
    assert terms.tag_frequency(labelled(spark, [])).collect() == []


def test_tag_frequency_splits_large_partitions(spark):
    rng = random.Random(3)
    rows = [(i, str(i), lab(concept=["hot", f"t{rng.randrange(300)}"]), None) for i in range(900)]
    want = collections.Counter(t for r in rows for t in r[2][4])
    got = {r.tag: r.occurrences for r in terms.tag_frequency(labelled(spark, rows), leaf_bytes=6500).collect()}
    assert got == want


def test_pairs(spark):
    rng = random.Random(4)
    rows = [(i, str(i), lab(concept=[f"c{rng.randrange(6)}" for _ in range(3)], domain=["d" if i % 3 else "e"]), None) for i in range(300)]
    rows += [(i, str(i), lab(concept=["r1", "r2"], agentic=["z"]), None) for i in range(300, 310)] + [(400, "400", None, None), (401, None, lab(), None)]
    sets = [{f"concept:{c}" for c in r[2][4] or []} | {f"domain:{c}" for c in r[2][2] or []} | {f"agentic:{c}" for c in r[2][5] or []} for r in rows if r[2]]
    want, single = collections.Counter(), collections.Counter()
    for s in sets:
        single.update(s)
        want.update(itertools.combinations(sorted(s), 2))
    got = pairs.co_occurrence(labelled(spark, rows)).collect()
    assert {(r.item_a, r.item_b): (r.n_ab, r.n_a, r.n_b, r.n) for r in got} == {p: (n, single[p[0]], single[p[1]], len(rows)) for p, n in want.items()}
    assert all(0 < r.p_value <= 1 and r.p_value <= r.q_value * 1.03 <= 1.03 for r in got)
    tests = len(single) * (len(single) - 1) // 2
    ps, best_q = sorted(r.p_value for r in got), {}
    low = 1.0
    for i in range(len(ps) - 1, -1, -1):  # Benjamini-Hochberg over all pairs of items, those that never meet having p = 1
        low = best_q[ps[i]] = min(low, ps[i] * tests / (i + 1))
    assert all(r.q_value == pytest.approx(best_q[r.p_value], rel=0.05) for r in got)
    sig = {(r.item_a, r.item_b) for r in pairs.significant(labelled(spark, rows)).collect()}
    assert sig == {(r.item_a, r.item_b) for r in got if r.q_value <= 0.05 and r.n_ab > r.expected} and {("agentic:z", "concept:r1"), ("concept:r1", "concept:r2")} <= sig
    best = min(got, key=lambda r: r.p_value)
    assert {best.item_a, best.item_b} <= {"concept:r1", "concept:r2", "agentic:z"}
    sur = {(r.item_a, r.item_b) for r in pairs.surprising(labelled(spark, rows)).collect()}
    n = len(rows)
    assert sur == {p for p, k in want.items() if k >= 5 and k * 1000 >= n and k * n >= 3 * single[p[0]] * single[p[1]]}
    assert pairs.co_occurrence(labelled(spark, [])).collect() == []


def test_fit_meets_the_degrees_and_the_tail_is_close():
    items, im, size, sm = np.array([5.0, 20.0, 60.0]), np.array([10.0, 4.0, 2.0]), np.array([1.0, 2.0, 4.0]), np.array([30.0, 50.0, 40.0])
    size = size * (items * im).sum() / (size * sm).sum()
    x, y = pairs.fit(items, im, size, sm)
    p = np.outer(x, y) / (1 + np.outer(x, y))
    assert np.allclose((p * sm).sum(1), items, rtol=1e-4) and np.allclose((p * im[:, None]).sum(0), size, rtol=1e-4)
    q, m = np.array([0.02, 0.3]), np.array([50, 10])
    exact = np.array([1.0])
    for a, k in zip(q, m, strict=True):
        for _ in range(k):
            exact = np.convolve(exact, [1 - a, a])
    for k in (1, 4, 8, 12):
        got = pairs.upper_tail(np.array([k]), q[None, :], m.astype(float))[0]
        assert got == pytest.approx(exact[k:].sum(), rel=0.1)


CAP = "row_id long, metadata struct<source_file:string>, value struct<value_score:double>, stays string"


@pytest.mark.parametrize("heap", [3, 200_000])
def test_capping(spark, heap):
    rng = random.Random(5)
    score = lambda: rng.choice([None, float("nan"), 1.0, 1.0, 2.5, -0.0, 0.0, -3.0, rng.random()])
    rows = [(i, None if i % 17 == 0 else (rng.choice(["runs/a.jsonl", "RUNS//A.jsonl", " ./runs\\a.jsonl\t", "b", f"c{i}", None]),), None if i % 19 == 0 else (score(),), "clash") for i in range(600)]
    rng.shuffle(rows)
    import re

    def key(m):
        return None if m is None or m[0] is None else re.sub(r"^\./", "", re.sub(r"[\\/]+", "/", m[0].strip().lower()))

    by = collections.defaultdict(list)
    for i, m, v, _ in rows:
        if key(m) is not None:
            x = v[0] if v else None
            by[key(m)].append((x is None or x != x, -(x if x is not None and x == x else 0), i))
    want = {i for g in by.values() for *_, i in sorted(g)[600 * 2 // 100 :]}
    got = {r.row_id for r in capping.capped(spark.createDataFrame(rows, CAP), 2, heap).where("not stays").collect()}
    assert got == want and len(got) > 300


def test_capping_of_few_and_none(spark):
    assert capping.capped(spark.createDataFrame([], CAP)).collect() == []
    few = spark.createDataFrame([(1, ("a",), (1.0,), ""), (2, None, None, "")], CAP)  # the cap is 0
    assert {(r.row_id, r.stays) for r in capping.capped(few).collect()} == {(1, False), (2, True)}
