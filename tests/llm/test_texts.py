import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import charsets, encoding, leakage, replies, truncation

AT = datetime(2026, 1, 1)
DOC = "doc_id long, text string, lang string, ids string, word string"
CONV = "row_id long, conversations array<struct<from:string,value:string>>, metadata struct<source_file:string>, word string, n long"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, "clash", "clash") for i, t in enumerate(texts)], DOC)


TEXTS = [None, "", " ", "a", "Hello world", "  two  spaces\n\n\tx", "don't we'll", "<|endoftext|> as text", "中文没有空格的一段很长的文字" * 40, "é" * 500, "👩🏽‍💻 ok   \xa0 x", "x" * 20_000, "word " * 30_000, "a1b2c3 " * 500, " a　b\x85c\x1cd"]


def test_encoding_agrees_with_whole_texts(spark):
    pytest.importorskip("tiktoken")
    plain = encoding.encoder(encoding.DEFAULT_VOCABULARY).encode_ordinary
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(" \n\tab1.,é中'\xa0") for _ in range(rng.randrange(400))) for _ in range(200)]
    got = {r.doc_id: r.ids for r in encoding.encode_corpus(docs(spark, texts)).collect()}
    assert got == {i: plain(t) if t else [] for i, t in enumerate(texts)}
    c = encoding.Chunks(encoding.DEFAULT_VOCABULARY, bits=1, limit=50)  # chunks of two characters, a cache that overflows
    assert [c.ids(t) for t in texts if t] == [plain(t) for t in texts if t] and c.repaired and c.hits
    assert encoding.encode_corpus(docs(spark, [])).collect() == []


def test_encoding_agrees_with_the_other_library():
    tk = pytest.importorskip("tokenizers")
    t = tk.Tokenizer.from_file(encoding.DEFAULT_VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    c = encoding.Chunks(encoding.DEFAULT_VOCABULARY)
    for x in TEXTS:
        if x:
            assert c.ids(x) == t.encode(x, add_special_tokens=False).ids


def sentence(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()) + str(rng.randrange(40)) for _ in range(n))


def test_leaks(spark):
    rng = random.Random(2)
    items = [sentence(rng, 80) for _ in range(6)]
    other = lambda n: sentence(rng, n)
    part = " ".join(items[1].split()[20:52])
    changed = items[2].split()
    changed[10:11], changed[40:40] = ["other"], ["added", "words"]
    two = " ".join(items[3].split()[:18]) + " " + other(6) + " " + " ".join(items[3].split()[50:68])
    few = " ".join(items[4].split()[:6])
    texts = [None, "", other(300), other(50) + " " + items[0].upper().replace(" ", ",  ") + other(50), other(900) + " " + part, " ".join(changed), two, other(40) + few + other(40), " ".join(reversed(items[5].split())), items[0].replace(" ", "\\n"), items[0]]
    ev = spark.createDataFrame([(i, t, "clash") for i, t in enumerate([*items, None, "", items[0]])], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(docs(spark, texts), ev).collect()}
    assert got == {(3, 0), (3, 8), (4, 1), (5, 2), (6, 3), (9, 0), (9, 8), (10, 0), (10, 8)}
    assert leakage.leaks(docs(spark, []), ev).collect() == [] and leakage.leaks(docs(spark, texts), ev.limit(0)).collect() == []


def test_leaks_by_brute_force(spark):
    """Random passages: found if and only if a plain longest-match count says so, away from the threshold."""
    rng = random.Random(3)
    items = [sentence(rng, 60) for _ in range(10)]
    texts, want, unsure = [], set(), set()
    for d in range(60):
        i, n, a = rng.randrange(10), rng.choice([0, 6, 12, 30, 45, 60]), 0
        a = rng.randrange(0, 60 - n + 1)
        texts.append(sentence(rng, 30) + " " + " ".join(items[i].split()[a : a + n]) + " " + sentence(rng, 30))
        if n >= 30:
            want.add((d, i))
        elif n == 12:
            unsure.add((d, i))
    ev = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(docs(spark, texts), ev).collect()}
    assert got - unsure == want


def test_leaks_beside_a_repeated_fragment(spark):
    """Two short passages near each other count, however many longer ones of one fragment stand elsewhere."""
    rng = random.Random(5)
    item = sentence(rng, 60).split()
    other = lambda n: sentence(rng, n)
    text = " ".join(" ".join(item[:14]) + " " + other(80) for _ in range(20)) + " " + " ".join(item[20:30]) + " " + other(8) + " " + " ".join(item[45:55])
    got = leakage.leaks(docs(spark, [text]), spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, round(r.share, 3)) for r in got] == [(0, 0, 0.333)]
    for _ in range(200):  # as by trying all pairs
        n, hits = 40, sorted({(p + rng.randrange(600) // 15 * 15, p % 40) for p in (rng.randrange(40) for _ in range(120))})
        ps = leakage.passages(hits)
        want = max(len(a[2] | b[2]) if a is b or (min(len(a[2]), len(b[2])) >= 6 and max(a[0], b[0]) - min(a[1], b[1]) <= 30) else 0 for a in ps for b in ps)
        assert leakage.coverage(hits, n) == min(1.0, want / n)


def test_leaks_of_short_items_and_in_blocks(spark, monkeypatch):
    rng = random.Random(7)
    items = ["red green blue", "omega", "sigma tau", "中文", sentence(rng, 40)]
    texts = ["they are red, green and blue", "first Red GREEN blue last", "red green", "an omega here", "omegas", "sigma", "tau sigma tau", "写中文的人", "中 文", sentence(rng, 20) + " " + items[4], None]
    ev = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(1, 0), (3, 1), (6, 2), (7, 3), (8, 3), (9, 4)}
    run = lambda: {(r.doc_id, r.item_id) for r in leakage.leaks(docs(spark, texts), ev).collect()}
    assert run() == want
    monkeypatch.setattr(leakage, "BLOCK_TERMS", 12)
    assert run() == want


def test_leaks_near_the_threshold(spark):
    """Passages of about a third of an item with words changed: as found by chaining all hits of all pairs, without a candidate step."""
    rng = random.Random(9)
    items = [sentence(rng, rng.choice([40, 80, 160])) for _ in range(8)]
    texts = []
    for _ in range(150):
        w = rng.choice(items).split()
        n = int(len(w) * rng.uniform(0.2, 0.6))
        a = rng.randrange(len(w) - n)
        part = [rng.choice(["new", "odd"]) if rng.random() < 0.06 else x for x in w[a : a + n]]
        texts.append(sentence(rng, 20) + " " + " ".join(part) + " " + sentence(rng, 20))
    grams = lambda t: [tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)]
    want = set()
    for d, t in enumerate(texts):
        g = grams(t)
        for i, x in enumerate(items):
            hits = [(p, j) for j, y in enumerate(grams(x)) for p, z in enumerate(g) if y == z]
            if leakage.coverage(hits, len(x.split())) >= leakage.SHARE:
                want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(docs(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert len(want) > 60 and got == want


def test_unescape():
    assert leakage.plain('a\\nb \\u00e9 &quot;x&quot; \\ud800') == 'a b é "x"  ' and leakage.plain(None) == ""


def clean_corpus():
    fr = "La tâche vérifie le schéma après le délai près du répertoire. "
    de = "Der Schlüssel löscht die Änderungen während der Ausführung für große Einträge. "
    ru = "Генератор открывает пакеты после запуска и проверяет список ошибок. "
    zh = "渲染管线部署完成后覆盖掉进度标记，并且序列化器重试了全部分区。"
    return [fr + f"x{i}" for i in range(16)] + [de + f"y{i}" for i in range(16)] + [ru + f"z{i}" for i in range(16)] + [zh + f"w{i}" for i in range(16)]


def test_wrong_encoding(spark):
    clean = clean_corpus()
    odd = ["emoji 👩🏽‍💻 and São Ångström ½ ± 20 °C", "If the page shows Ã© where é belongs, check the header.", "ascii only", None, "", "├── src │ └── a.py", "한국어 문장 日本語の文"]
    garbled = [(clean[i].encode("utf-8").decode("cp1252", "ignore"), None) for i in (0, 1)]
    garbled += [(clean[i].encode(a).decode(b), clean[i]) for i, a, b in ((2, "utf-8", "latin-1"), (17, "utf-8", "latin-1"), (18, "utf-8", "mac_roman"), (19, "utf-8", "mac_roman"), (34, "utf-8", "latin-1"), (50, "utf-8", "latin-1"))]
    garbled += [("Der Schl�ssel der �nderungen", "Der Schlüssel der Änderungen")]
    texts = clean + odd + [g for g, _ in garbled]
    got = {r.doc_id: r.restored for r in charsets.wrong_encoding(docs(spark, texts)).collect()}
    first = len(clean) + len(odd)
    assert set(got) == set(range(first, first + len(garbled)))
    for k, (_, want) in enumerate(garbled):
        if want:
            assert got[first + k] == want
    assert charsets.wrong_encoding(docs(spark, [])).collect() == [] and charsets.wrong_encoding(docs(spark, ["", None, "plain"])).collect() == []


def test_sequences_that_stand_alone(spark):
    """What a text speaks of is no case; what stands where other texts have a clean character is."""
    clean = clean_corpus()
    texts = clean + [clean[i].encode("utf-8").decode("cp1252", "ignore") for i in (0, 1)] + [f"see \u00a7 12 of the spec {i}" for i in range(6)] + [f"about 2 \u00d7 4 tiles, {i}" for i in range(6)]
    first = len(texts)
    texts += ["now see \u00c2\u00a7 12 of the spec", "the page shows \u00c3\u00a9 where \u00e9 belongs", "bytes EF BF BD, printed as \ufffd, to a file", "some 2 \ufffd 4 tiles", "\u00c3\u00a9"]
    got = {r.doc_id: r.restored for r in charsets.wrong_encoding(docs(spark, texts)).collect()}
    assert {k - first for k in got if k >= first} == {0, 3} and got[first] == "now see \u00a7 12 of the spec"
    assert charsets.context("a\nsee, \u00a7\n12", 7, 8) == "see\0" and charsets.alone("x\u00e9 \u00e9", 3, 4) and not charsets.alone("x\u00e9", 1, 2)


def test_codec_steps():
    g = "é’".encode().decode("cp1252")
    assert charsets.undo(g, "cp1252", "utf-8") == "é’" and charsets.undo("é", "cp1252", "utf-8") is None
    assert "Ã" in charsets.forward("í", "cp1252", "utf-8")


def test_learned_decodings_need_no_utf8_sequence():
    m = charsets.Mender([("mac_roman", "cp1252")], {"é": 1000, "È": 2}, {})
    assert m.mend("un dÈbut")[:3] == (True, "un début", [])
    text = "проверяет список"
    chars = dict.fromkeys(set(text), 500)
    garbled = text.encode("cp1251").decode("koi8_r")
    for learned in ([], [("koi8_r", "cp1251")]):  # learning a decoding doesn't switch it off
        assert charsets.Mender(learned, chars, {}).mend(garbled)[:2] == (True, text)


def test_lossy_twins_that_many_rows_hold(spark):
    clean = clean_corpus()
    texts = clean + [clean[i].encode("utf-8").decode("cp1252", "ignore") for i in (0, 1)]
    first = len(texts)
    texts += [f"El jardín {i}" for i in range(10)] + [f"Mi país {i}" for i in range(10)]
    texts += [f"El jardÃn {i}" for i in range(5)] + [f"Mi paÃs {i}" for i in range(15)]  # a third and more than half
    got = {r.doc_id: r.restored for r in charsets.wrong_encoding(docs(spark, texts)).collect()}
    want = {first + 20 + i: f"El jardín {i}" for i in range(5)} | {first + 25 + i: f"Mi país {i}" for i in range(15)}
    assert {k: v for k, v in got.items() if k >= first} == want and set(range(first - 2, first)) <= set(got)


def test_statistics_of_all_pairs(spark):
    rng = random.Random(4)
    texts = ["".join(chr(0x4E00 + rng.randrange(600)) for _ in range(2000)) for _ in range(50)]
    want = {a + b for t in texts for a, b in zip(t, t[1:])}
    _, _, duos, *_ = charsets.learn(docs(spark, texts))
    assert len(want) > 80_000 and set(duos) == want


SENT = ["The parser reads the buffer and writes the table.", "Each worker checks the queue before it closes the file.", "Later the scheduler moves the record to the archive."]


def conv(*turns, i=0, src="s"):
    return (i, list(turns), (src,) if src else None, "clash", 1)


def test_truncation(spark):
    body = [conv(("human", SENT[i % 3]), ("gpt", " ".join(SENT)), i=i) for i in range(60)]
    cases = {
        "pars": True, "The parser reads the buf": True, "Each worker checks the queue before it": True, SENT[0]: False, "pls fix the parser of the table": False, "pls fix the parser of the": True, "- Each worker\n- The file": False, "- Each worker\n- The que": True,
        "```python\nx = 1\n```": False, "```python\nx = 1\nfor": True, "<think>\nThe par": True, '{"a": [1, 2]}': False, '{"a": [1, 2': True, "42": False, "Yes.": False, "": False, None: False, "他们部署完成后重试了全部": True, "他们部署完成后重试了全部。": False, SENT[0] + " Each worker checks the…": True,
    }
    rows = body + [conv(("gpt", v), i=1000 + k, src=None if k % 2 else "t") for k, v in enumerate(cases)] + [(2000, None, None, None, None), (2001, [], None, None, None)]
    df = spark.createDataFrame(rows, CONV)
    got = {r.row_id - 1000 for r in truncation.cut_turns(df).collect()}
    assert got == {k for k, v in enumerate(cases.values()) if v}
    by = {r.source_file: (r.turns, r.cut) for r in truncation.truncation_by_source(df).collect()}
    assert by["s"] == (120, 0) and sum(c for _, c in by.values()) == len(got)
    assert truncation.cut_turns(spark.createDataFrame([], CONV)).collect() == []


def test_trie_needs_no_prefix_of_a_text(spark):
    long = " ".join(SENT * 5000)
    df = spark.createDataFrame([conv(("gpt", long), i=1), conv(("gpt", long[:-3]), i=2)], CONV)
    assert [r.row_id for r in truncation.cut_turns(df).collect()] == [2]


def test_replies(spark):
    en = ["How do I read the table when the buffer is full?", "Why does the worker close the file before the queue is empty?", "Can you explain how the scheduler moves each record to the archive?"]
    rows = [conv(("human", en[i % 3] + f" Case {i}."), ("gpt", " ".join(SENT) + f" That is step {i} of the plan."), i=i) for i in range(240)]
    de = "Der Schlüssel löscht die Änderungen während der Ausführung und das Modul prüft die Einträge für den Dienst."
    fr = "La tâche vérifie le schéma après le délai et le répertoire garde les fichiers dans la mémoire."
    rows += [conv(("human", "Wie kann ich die Tabelle und den Puffer mit dem Dienst lesen, wenn das Modul nicht läuft?"), ("gpt", de), i=300 + i) for i in range(10)]
    rows += [conv(("human", "Comment est-ce que je lis la table et le tampon dans le service avec les fichiers ?"), ("gpt", fr), i=320 + i) for i in range(10)]
    cases = [
        (en[0], None, "empty"), (en[0], "​ \n", "empty"), (en[0], "<think>\n\n</think>", "empty"), (en[0], "```\n```", "empty"), (en[1], en[1].upper(), "copy"), (en[1], f'"{en[1]}"', "copy"), (en[1], "Question: " + en[1], "copy"),
        (en[2], "I'm sorry, but I can't help with that.", "refusal"), (en[0], "Unfortunately I am not able to provide this for policy reasons.", "refusal"), (en[0], de, "language"), (en[0] + " Please answer in German.", de, None),
        (en[0], SENT[0] + " Each worker checks the que", "truncated"), (en[0], "Yes.", None), (en[0], "42", None), (en[0], '<tool_call>{"name": "x", "arguments": {}}</tool_call>', None), (en[0], "```python\nx = 1\n```", None),
    ]
    rows += [conv(("human", q), ("gpt" if k % 2 else " Assistant", a), i=500 + k) for k, (q, a, _) in enumerate(cases)]
    rows += [(900, None, None, None, None), (901, [], None, None, None), (902, [("gpt", None)], None, None, None)]
    got = {(r.row_id, r.turn_pos): r.defect for r in replies.defects(spark.createDataFrame(rows, CONV)).collect()}
    want = {(500 + k, 1): d for k, (_, _, d) in enumerate(cases) if d} | {(902, 0): "empty"}
    assert got == want
    assert replies.defects(spark.createDataFrame([], CONV)).collect() == []


def test_replies_are_learnt_from_all_rows(spark):
    """A language that none of the rows of the smallest hashes has is learnt nevertheless."""
    rng = random.Random(12)
    words = {"en": "the parser reads each record and writes it to the table while a worker waits for the queue".split(), "de": "der Dienst liest jeden Eintrag und schreibt ihn in die Tabelle während ein Prozess auf die Schlange wartet".split()}
    make = lambda k: " ".join(rng.choice(words[k]) for _ in range(25)).capitalize() + "."
    ids = [r.id for r in spark.range(440).orderBy(F.xxhash64("id"), "id").collect()]
    kinds = [("en", "en")] * 300 + [("de", "de")] * 120 + [("en", "de")] * 10 + [("de", "en")] * 10
    rows = [conv(("human", make(q)), ("gpt", make(a)), i=i) for i, (q, a) in zip(ids, kinds, strict=True)]
    got = {(r.row_id, r.defect) for r in replies.defects(spark.createDataFrame(rows, CONV), 200).collect()}
    assert got <= {(i, "language") for i in ids[420:]} and len(got) >= 14  # from the 200 smallest alone: none of these, and all German replies as refusals


def test_replies_of_few_rows_and_no_id(spark):
    q = "How do I read the table when the buffer is full?"
    rows = [conv(("human", q), ("gpt", "Read it by the index of each record and then close the file."), i=-5), conv(("human", q), ("gpt", None), i=None)]
    assert [tuple(r) for r in replies.defects(spark.createDataFrame(rows, CONV)).collect()] == [(None, 1, "empty")]


def test_a_small_mixed_cluster_joins_no_languages():
    languages = replies.Languages([], [], k=3)
    languages.link(np.array([[900.0, 4, 20], [5, 300, 15], [25, 10, 3]]))  # the third has texts of both others
    assert languages.group[0] != languages.group[1] and languages.group[2] == languages.group[0]


def test_classifier_on_held_out_defects():
    rng = random.Random(6)
    nouns = "table buffer worker file queue record archive parser module index".split()
    make = lambda: f"The {rng.choice(nouns)} reads the {rng.choice(nouns)} when each {rng.choice(nouns)} is in the {rng.choice(nouns)}."
    pairs = [("How do I move the " + rng.choice(nouns) + " to the " + rng.choice(nouns) + " if it is full?", " ".join(make() for _ in range(4))) for _ in range(150)]
    pairs = [(q, a, None) for q, a in pairs]
    languages = replies.Languages([q for q, _, _ in pairs[:100]], [a for _, a, _ in pairs[:100]])
    model = replies.train(pairs[:100], replies.cuts(pairs[:100]), languages)
    examples, y, _ = replies.synthesise(pairs[100:], languages, seed=9)
    s = model.scores(examples) > 0
    for name in ("empty", "copy", "refusal"):
        k = replies.LABELS.index(name)
        hit = (s[:, k] & (y[:, k] > 0)).sum()
        assert hit >= 0.95 * y[:, k].sum() and hit >= 0.95 * s[:, k].sum(), name


def test_each_text_of_a_block_is_read_once(monkeypatch):
    rng = random.Random(9)
    words = {"en": "the parser reads each record and writes it to the table while a worker waits for the queue".split(), "de": "der Dienst liest jeden Eintrag und schreibt ihn in die Tabelle während ein Prozess auf die Schlange wartet".split()}
    make = lambda k: " ".join(rng.choice(words[k]) for _ in range(20)) + "."
    pairs = [(make(k), make(k), None) for k in ("en", "de") for _ in range(150)]
    languages = replies.Languages([q for q, _, _ in pairs], [a for _, a, _ in pairs], k=4)
    read = {"tokenize": [], "trigrams": []}
    for name, texts in read.items():
        monkeypatch.setattr(replies, name, lambda x, own=texts, f=getattr(replies, name): own.extend(x) or f(x))
    replies.Examples(pairs, replies.cuts(pairs), languages)
    answers = {a for _, a, _ in pairs}
    for texts in read.values():
        assert answers <= set(texts) and sum(t in answers for t in texts) == len(answers)


def test_texts_as_their_patterns_say():
    texts = ["", "a_b ß-Σ9²", "ㅤ", "``` \n", "```py", "````", "```ㅤ```", "<THINK></think>\u200b", "<think>x", "\u200b\x00 ", "日本、語 İI", "\ud800x"]
    assert replies.letters(texts) == [replies._NOT_WORD.sub("", t.lower()) for t in texts]
    assert [replies.bare(t) for t in texts] == [not replies._MARKS.sub("", t) for t in texts]
    n = [0, 1, 2**63, 2**64 - 1, 12345]
    assert [replies._mix(i) for i in n] == replies.mix(np.array(n, np.uint64)).tolist()


def test_last_words_are_read_from_the_end():
    want = {"the que": "que", "the queue, (as_": "as", "x_Ab9 -–": "#", "end…": "end", "wait . . ...\u200b": "", "中文字": "", "b" * 450 + '"\n': "b" * 399, "\x1c\u3000": None, "``` x": "x"}
    assert {v: f and f.word for v, f in ((v, truncation.form(v)) for v in want)} == want


def test_languages_are_learnt():
    rng = random.Random(8)
    words = {
        "en": "the parser reads each record and writes it to the table while a worker waits for the queue".split(), "de": "der Dienst liest jeden Eintrag und schreibt ihn in die Tabelle während ein Prozess auf die Schlange wartet".split(),
        "fr": "le service lit chaque ligne puis écrit dans la table pendant que le processus attend une réponse".split(), "ru": "служба читает каждую запись и пишет её в таблицу пока процесс ждёт очередь".split(),
    }
    make = lambda k: " ".join(rng.choice(words[k]) for _ in range(25))
    of = [k for k in words for _ in range(60)]
    texts = [(make(k), make(k)) for k in of]
    lang = replies.Languages([q for q, _ in texts], [a for _, a in texts], k=8)
    new = [k for k in words for _ in range(20)]
    q, a = lang.of([make(k) for k in new]), lang.of([make(k) for k in new])
    same = lang.together[q[:, None], a[None, :]] > 0
    want = [[x == y for y in new] for x in new]
    assert (same == want).mean() > 0.97 and lang.of(["", "12 34", "ok"]).tolist() == [-1, -1, -1]


def test_evidence_of_early_stops(spark):
    """Which evidence decides, and that a hot last word or a field limit is no obstacle."""
    rng = random.Random(4)
    make = lambda: " ".join(rng.choice(SENT) for _ in range(12))
    whole = [conv(("gpt", make()), i=i) for i in range(200)]
    at_limit = [conv(("gpt", make()[:300]), i=1000 + i, src="cutter") for i in range(40)]
    hot = [conv(("gpt", SENT[0] + " Each worker checks the que"), i=2000 + i) for i in range(150)]
    spaces = [conv(("gpt", SENT[0] + " Each worker checks"), i=3000), conv(("gpt", SENT[0] + " Each worker (that"), i=3001), conv(("gpt", "```py\nx = 1"), i=3002)]
    got = {r.row_id: r.evidence for r in truncation.stops(spark.createDataFrame(whole + at_limit + hot + spaces, CONV)).collect()}
    assert not any(i < 1000 for i in got) and all(got[2000 + i] == "prefix" for i in range(150)) and got[3000] in ("sentence", "word") and got[3002] == "open"
    ends = {1000 + i for i in range(40) if at_limit[i][1][0][1].rstrip()[-1] != "."}
    assert ends <= set(got) and {got[i] for i in ends} <= {"prefix", "limit"}
