import json

from pyspark.sql import functions as F

from siltworks.operators.lookups import upsert
from siltworks.sources import readers as RD
from siltworks.sources import sinks as SK
from siltworks.streaming import incremental as INC


def test_read_any_and_normalise(spark, tmp_path):
    lines = [{"id": "1", "conversations": [{"from": "User", "value": "q"}, {"from": "assistant", "value": None}]}, {"id": "2", "messages": [{"role": "user", "content": "m"}]}, {"id": "3", "data": [{"role": "user", "content": "[unused10]x /no_think"}], "meta_prompt": [" sys ", " "]}]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\nnot json\n")
    (tmp_path / "a.json").write_text(json.dumps(lines))  # the same stem: left out
    (tmp_path / "b.json").write_text(json.dumps([{"id": "4", "conversations": []}]))
    (tmp_path / "._c.jsonl").write_text("{}")
    df = RD.normalise(RD.read_any(spark, str(tmp_path)))
    got = {r.id: r for r in df.collect()}
    assert set(got) == {"1", "2", "3", "4", None} and got["1"].turns == [("human", "q"), ("gpt", "")] and got["2"].original_format == "openai_messages"
    assert got["3"].turns == [("system", "sys"), ("human", "x")] and got["3"].is_pseudo_multiturn and got["4"].original_format == "unknown"
    stats = RD.parse_stats(RD.read_records(spark, str(tmp_path / "a.jsonl")).cache()).first()
    assert (stats.rows, stats.broken) == (4, 1)
    assert RD.read_any(spark, str(tmp_path), RD.RAW).count() == 5


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "f", ["a", "b"]), (2, "g", None)], "i int, source_file string, tags array<string>")
    SK.write_json(df, str(tmp_path / "j"), by=["source_file"])
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    SK.write_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2
    SK.write_table(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    s = spark.createDataFrame([(1, 2, 0.5), (1, 1, 0.1)], "i int, turn int, v double")
    assert [len(r.turns_scored) for r in SK.fold_back(df, s, "i", "turn", ["v"]).orderBy("i").collect()] == [2, 0]


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.json(src)
    stream = spark.readStream.schema("k int, v string").json(src)
    INC.run_available(stream, INC.upsert_sink(str(tmp_path / "out"), ["k"], ["v"]))
    assert INC.read_upserted(spark, str(tmp_path / "out"), 0, "k int, v string").count() == 2
    q = INC.tag_counts(stream.select(F.lit("d").alias("dim"), F.col("v").alias("tag"))).writeStream.format("memory").queryName("tagc").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination()
    assert spark.table("tagc").count() == 2


def test_upsert_sink_keeps_the_latest(spark, tmp_path):
    out, schema = str(tmp_path / "u"), "k int, at int, v string"
    sink = INC.upsert_sink(out, ["k"], ["at"], buckets=4)
    batches = [[(1, 1, "a"), (1, 3, "c"), (2, 1, "x")], [(1, 2, "late"), (3, 1, "n")], [(2, 5, "y"), (2, 4, "w")], []]
    want = [{1: "c", 2: "x"}, {1: "c", 2: "x", 3: "n"}, {1: "c", 2: "y", 3: "n"}, {1: "c", 2: "y", 3: "n"}]
    for i, rows in enumerate(batches):
        for _ in range(2):  # a batch that is repeated changes nothing
            sink(spark.createDataFrame(rows, schema), i)
            assert {r.k: r.v for r in INC.read_upserted(spark, out, i, schema).collect()} == want[i]
    versions = [p for p in (tmp_path / "u").glob("upsert_bucket=*/upsert_version=*")]
    assert len(versions) <= 2 * len(list((tmp_path / "u").glob("upsert_bucket=*")))  # old versions are gone


def test_upsert(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert sorted(map(tuple, upsert(a, b, ["k"]).collect())) == [(1, "x"), (2, "z"), (3, "w")]


def test_samples(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("g"))
    assert RD.seeded_sample(df, "id", 7).count() == 7 and RD.stratified_sample(df, "id", "g", 30).groupBy("g").count().where("count = 10").count() == 3
