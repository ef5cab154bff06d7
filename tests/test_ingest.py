import os

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import ingest as ing, judging as jd
from gaugeline.sources import tables as src


@pytest.mark.parametrize("raw, shape, labels", [
    ("['ORDER']", "list", ["ORDER"]), ('["a", "b"]', "list", ["a", "b"]), ("a; b ;;", "delimited", ["a", "b"]),
    (" ORDER ", "scalar", ["ORDER"]), ("[broken", "scalar", ["[broken"]), ("[x; y]", "delimited", ["[x", "y]"]),
    (None, "missing", []),
])
def test_labels(spark, raw, shape, labels):
    r = spark.createDataFrame([(raw,)], "raw string").select(
        ing.labels_shape(F.col("raw")).alias("s"), ing.parse_labels(F.col("raw")).alias("l")).first()
    assert (r.s, r.l) == (shape, labels)


def test_single_class(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "l array<string>")
    assert [r.c for r in df.select(ing.single_class(F.col("l")).alias("c")).collect()] == ["a", "∅", "∅"]


@pytest.mark.parametrize("raw, kind, expected", [
    ("4", "scale_1_5", 4.0), ("Score: 3.5.", "scale_1_5", 3.5), ("1\n2 reasons", "binary", 1.0), ("0.5", "binary", None),
    ("6", "scale_1_5", None), ("-1", "binary", None), ("", "binary", None), (None, "binary", None), ("none\n3", "scale_1_5", None),
])
def test_judge_reply(spark, raw, kind, expected):
    assert spark.createDataFrame([(raw,)], "r string").select(jd.parse_reply(F.col("r"), kind).alias("v")).first().v == expected


@pytest.mark.parametrize("raw, expected", [
    ('["a", "b"]', ["a", "b", None]), ('```json\n["a", [["b"]]]\n```', ["a", None, None]), ('ok: [["c"], "a", "b", "a"] end', ["c", "a", "b"]),
    ("no list", [None, None, None]), ('["zzz", "a"', [None, None, None]),
])
def test_batch_answers(spark, raw, expected):
    df = spark.createDataFrame([(1, [10, 11, 12], raw)], "b int, items array<int>, raw string")
    rows = ing.align_batch(df, ["b"], "items", "raw", ["a", "b", "c"]).orderBy("item_id").collect()
    assert [r.y_pred for r in rows] == expected


@pytest.mark.parametrize("raw, accuracy", [
    ('{"accuracy": 3, "completeness": 4.5, "fluency": 2}', 3.0),
    ('Well:\n{"accuracy": 5, "completeness": 1, "fluency": 2, "rationale": "x"} ok', 5.0),
    ('{"accuracy": 3, "completeness": 4}', None), ('{"accuracy": "3", "completeness": 4, "fluency": 2}', None),
    ('{"accuracy": 6, "completeness": 4, "fluency": 2}', None), ("nothing", None), ("{bad}", None), (None, None),
])
def test_scorecards(spark, raw, accuracy):
    df = spark.createDataFrame([(1, raw)], "id int, raw string")
    card = ing.parse_scorecards(df, "raw", "card").first().card
    assert (card and card.accuracy) == accuracy


def test_rationale_is_cut(spark):
    raw = '{"accuracy": 3, "completeness": 4, "fluency": 2, "rationale": "' + "x" * 500 + '"}'
    card = ing.parse_scorecards(spark.createDataFrame([(1, raw)], "id int, raw string"), "raw", "card").first().card
    assert len(card.rationale) == 300


def test_quarantine_has_exactly_the_rejected_rows(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 1.5), (3, -0.1)], "id int, v double").withColumn("s", ing.host_score(F.col("v"), F.lit(0.0)))
    ok, bad = ing.split_valid(df, "s")
    assert ([r.id for r in ok.collect()], sorted(r.id for r in bad.collect())) == ([1], [2, 3])


def test_golden_diff(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0 + 1e-12), (2, 2.1), (4, 4.0)], "k int, v double")
    rows = {r.k: (r.strict, r.close, r.one_sided) for r in ing.golden_diff(a, b, "k", "v").collect()}
    assert rows == {1: (False, True, False), 2: (False, False, False), 3: (False, False, True), 4: (False, False, True)}


def test_alignment(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (3, None), (4, "q")], "k int, v string")
    r = ing.alignment(a, b, "k", "v").first()
    assert (r.left_only, r.right_only, r.value_differs) == (0, 1, 1)


def test_json_field_fallback(spark):
    df = spark.createDataFrame([('{"a": "x"}',), ('{"b": "y", "a": ""}',), ("{}",), ("oops",)], "j string")
    assert [r.v for r in df.select(ing.json_field(F.col("j"), "a", "b").alias("v")).collect()] == ["x", "y", None, None]


def test_phrases(spark):
    df = spark.createDataFrame([("Do NOT do it.",), ("donot",)], "t string")
    assert [r.h for r in df.select(ing.contains_phrase(F.col("t"), ["do not"]).alias("h")).collect()] == [True, False]


def test_csv_round_trip(spark, folder):
    rows = [("q,1", 'say "hi"\nthere', "é"), ("", "x", None)]
    path = src.write(spark.createDataFrame(rows, src.QA_TRIPLE), f"{folder}/csv", "csv")
    back = src.read_csv(spark, path, src.QA_TRIPLE, multiline=True).collect()
    assert sorted(r.ai_answer for r in back) == ['say "hi"\nthere', "x"]


def test_nested_bundle(spark, folder):
    path = f"{folder}/b.json"
    with open(path, "w") as f:
        f.write('{"dataset": "d", "labels": ["a"], "train_size": 3, "n": 2, "items": [\n {"text": "t", "truth": ["a"], "tfidf": ["b"], "llm": []},'
                '\n {"text": "u", "truth": ["b"], "tfidf": [], "llm": ["a"]}]}')
    rows = src.read_bundle(spark, path).orderBy("text").collect()
    assert [(r.dataset, r.text, r.truth, r.llm) for r in rows] == [("d", "t", ["a"], []), ("d", "u", ["b"], ["a"])]


def test_jsonl_head(spark, folder):
    src.write(spark.range(10).select(F.col("id").cast("string").alias("id")), f"{folder}/j", "json")
    assert [r.id for r in src.read_jsonl(spark, f"{folder}/j", src.CASE, "id", 3).collect()] == ["0", "1", "2"]


def test_shards_and_write_if_absent(spark, folder):
    a, b = (src.write(spark.range(i, i + 3), f"{folder}/{i}") for i in (0, 3))
    assert src.read_shards(spark, [a, b]).count() == 6
    src.write_if_absent(spark.range(100), a)
    assert spark.read.parquet(a).count() == 3


def test_ledger_processes_every_key_once(spark, folder):
    work, path = spark.range(10).withColumnRenamed("id", "k"), f"{folder}/ledger"
    once = lambda df: df.withColumn("run", F.lit(1))
    src.append_pending(spark, work.where("k < 4"), path, "k", once)
    out = src.append_pending(spark, work, path, "k", lambda df: df.withColumn("run", F.lit(2)))
    assert {r.k: r.run for r in out.collect()} == {k: 1 if k < 4 else 2 for k in range(10)}
    assert src.append_pending(spark, work, path, "k", once).count() == 10


def test_a_torn_table_is_written_again(spark, folder):
    path = src.write(spark.range(3), f"{folder}/t")
    os.remove(f"{path}/_SUCCESS")
    src.write_if_absent(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_ledger_without_the_key_raises(spark, folder):
    work = spark.range(10).withColumnRenamed("id", "k")
    with pytest.raises(ValueError, match="lacks the key"):
        src.append_pending(spark, work, f"{folder}/ledger", "k", lambda df: df.select(F.lit(1).alias("x")))
    assert not src.exists(spark, f"{folder}/ledger")
    src.write(spark.range(2).select(F.lit(1).alias("x")), f"{folder}/old")
    with pytest.raises(Exception, match="k"):
        src.append_pending(spark, work, f"{folder}/old", "k", lambda df: df)
    assert spark.read.parquet(f"{folder}/old").count() == 2


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    def session(master, shared=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: shared or d), sparkContext=SimpleNamespace(master=master))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        src.scratch(session("spark://somewhere:7077"), "x")
    assert src.scratch(session("spark://somewhere:7077", "hdfs:///c"), "x").startswith("hdfs:///c/gaugeline/x-")
    assert src.scratch(session("local[2]"), "x")


def test_stored_tables_can_be_discarded(spark):
    df = src.stored(spark.range(3), "t")
    assert df.count() == 3 and src.exists(spark, df.stored_at)
    src.discard(df)
    assert not src.exists(spark, df.stored_at)
    src.discard(spark.range(1))


def test_bundle_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert {(r.dataset, r.x, r.y) for r in src.bundle({"a": a, "b": b}).collect()} == {("a", 1, 2), ("b", 3, None)}


def test_tag_profile(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b", "a", "c"],), (["a", "a"],)], "tags array<string>")
    prevalence, sizes, pairs = ing.tag_profile(df, "tags")
    assert {r.tag: r.n for r in prevalence.collect()} == {"a": 3, "b": 2, "c": 1}
    assert {r.n_tags: r.n for r in sizes.collect()} == {1: 1, 2: 1, 3: 1}
    assert {(r.tag_1, r.tag_2): r.n for r in pairs.collect()} == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1}


def test_bundle_sink_is_partitioned_by_dataset(spark, folder):
    df = src.bundle({"a": spark.range(3), "b": spark.range(5)})
    back = spark.read.parquet(src.write_bundle(df, f"{folder}/bundle"))
    one = back.where("dataset = 'a'")
    assert one.count() == 3 and all("dataset=a" in f for f in back.inputFiles() if f.split("/")[-2] == "dataset=a")
    assert "PartitionFilters: [isnotnull(dataset" in one._jdf.queryExecution().toString()
