import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docvec.functions import numbers
from docvec.operators import embed, profile, usage


def test_hash_embedder(spark):
    df = spark.createDataFrame([("Größe größe a",), ("",), (None,), ("!?",)], "t string")
    got = [r[0] for r in df.select(embed.hash_embedder(F.col("t"), 16)).collect()]
    assert abs(sum(x * x for x in got[0]) - 1) < 1e-6 and sorted(got[0])[-1] == pytest.approx(2 / 5**0.5)
    assert got[1] == got[2] == got[3] == [0.0] * 16


def test_model_embedder(spark):
    df = spark.createDataFrame([(i, f"t{i}" if i % 3 else None) for i in range(25)], "n int, content string").coalesce(1)
    sizes = embed.model_embedder(F.col("content"), lambda ts: [[float(t[1:]), len(ts)] for t in ts], 2, batch_size=10)
    rows = embed.embed(df, sizes).collect()
    assert all((r["vector"] is None) == (r["n"] % 3 == 0) for r in rows)
    assert all(r["vector"][0] == r["n"] for r in rows if r["n"] % 3)
    assert {r["vector"][1] for r in rows if r["vector"]} == {10.0, 6.0}
    assert {r["prompt_tokens"] for r in rows} == {0, 1}
    for bad in (lambda ts: [[1.0, 2.0]], lambda ts: [[1.0]] * len(ts)):
        with pytest.raises(Exception, match="received"):
            df.select(embed.model_embedder(F.col("content"), bad, 2, 10)).collect()


def test_batch_size_errors(spark):
    rows = spark.createDataFrame([(1, 1)], "g int, o int")
    for n, error in ((0, ZeroDivisionError), (-1, ValueError), ("3", TypeError), (True, TypeError)):
        with pytest.raises(error):
            embed.batches(rows, ["g"], "o", n)


def test_numbered_equals_row_number(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", "b", None]), o) for o in rng.sample(range(-5000, 5000), 1200)]
    df = spark.createDataFrame(rows, "g string, o int")
    seen: dict = {}
    for g, o in sorted(rows, key=lambda r: r[1]):
        seen[(g, o)] = sum(1 for k in seen if k[0] == g) + 1
    for rows in (df, df.repartition(7)):
        got = {(r["g"], r["o"]): r["row_number"] for r in embed.numbered(rows, ["g"], "o").collect()}
        assert got == seen
    batches = embed.content_batches(df.withColumn("t", F.col("o").cast("string")), ["g"], "o", "t", 50)
    for r in batches.filter("g = 'a'").collect():
        want = [str(o) for (g, o), n in sorted(seen.items(), key=lambda x: x[1]) if g == "a" and (n - 1) // 50 + 1 == r["batch"]]
        assert r["contents"] == want and r["items"] == len(want)


def test_hot_group_with_a_sparse_order_is_split(spark):
    """One group, orders far apart: several tasks number it, and the table of offsets stays small."""
    df = spark.range(0, 4000, 1, 4).select(F.lit("g").alias("g"), (F.col("id") * 1_000_003).alias("o"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = embed.numbered(df, ["g"], "o")
        assert [r["row_number"] for r in got.orderBy("o").collect()] == list(range(1, 4001))
        parts = df.repartitionByRange("g", "o").select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts == 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("width", [4, 5, 64])
def test_latency_mean(spark, width):
    values = [float((i * 37) % 11) for i in range(50)]
    df = spark.createDataFrame([("m", i, v) for i, v in enumerate(values)], "model string, o int, v double")
    got = usage.latency_mean(embed.numbered(df, ["model"], "o"), "model", "v", width=width)
    found = {r["o"]: r["mean_latency"] for r in got.collect()}
    want = {i: sum(values[max(0, i - 4) : i + 1]) / len(values[max(0, i - 4) : i + 1]) for i in range(50)}
    assert found == pytest.approx(want)


def test_dims(spark):
    asked = [("text-embedding-3-small", None), ("text-embedding-3-small", 256), ("text-embedding-3-small", 7),
             ("jina-v2-base", 768), ("jina-v2-base", 256), ("x", None), (None, 5)]
    df = spark.createDataFrame([(i, m, d) for i, (m, d) in enumerate(asked)], "n int, model string, dims int")
    rows = embed.resolve_dims(df, embed.models(spark)).orderBy("n").collect()
    assert [(r["dims"], r["error"]) for r in rows] == [
        (1024, None), (256, None), (None, "dimensions not supported"), (768, None),
        (None, "dimensions cannot be changed"), (None, "unknown model"), (None, "unknown model"),
    ]


def test_usage_rows(spark):
    texts = spark.createDataFrame([("u", "jina-v2-base", "a b."), ("u", "jina-v2-base", None), ("v", "zzz", "c")], "user_id string, model string, content string")
    counted = usage.batch_tokens(texts, ["user_id", "model"])
    priced = usage.with_cost(counted, embed.models(spark))
    rows = {r["user_id"]: r for r in priced.collect()}
    assert rows["u"]["total_tokens"] == 3 and rows["u"]["cost"] == pytest.approx(3e-7) and rows["u"]["items"] == 2
    assert rows["v"]["cost"] is None and rows["v"]["error"] == "unknown model"
    event = {r["user_id"]: r for r in usage.usage_events(priced).collect()}["u"]
    assert event["requests"] == 1 and event["completion_tokens"] == 3 and len(event["transaction_id"]) == 36
    assert event["input_tokens"] == 0


def test_status_and_reports(spark):
    log = spark.createDataFrame(
        [("a", "processing", datetime(2024, 1, 1)), ("a", "completed", datetime(2024, 1, 2)), ("b", "processing", datetime(2024, 1, 1))],
        "file_id string, status string, ts timestamp",
    )
    assert {r["file_id"]: r["status"] for r in usage.latest_status(log).collect()} == {"a": "completed", "b": "processing"}
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file_id string")
    written = spark.createDataFrame([("a", 2, None), ("b", 0, "bad")], "file_id string, chunks int, error string")
    assert {r["file_id"]: r["status"] for r in usage.file_states(files, written).collect()} == {"a": "completed", "b": "failed", "c": "processing"}


def test_quota(spark):
    quotas = spark.createDataFrame([("a", 1, 5.0), ("b", None, 5.0), ("c", 1, 0.0), ("d", 1, None)], "application string, hard_cap int, usage_available double")
    asked = spark.createDataFrame([(x,) for x in "abcdea"], "application string")
    passed, rejected = usage.quota_gate(asked, quotas)
    assert sorted(r[0] for r in passed.collect()) == ["a", "a"]
    assert sorted(r[0] for r in rejected.collect()) == ["b", "c", "d", "e"]


def test_profile(spark):
    df = spark.createDataFrame([(1, "red ring big", None), (2, "blue bolt", "x"), (3, "red ring big", "y")], "id int, name string, tag string")
    text = profile.sample_text(df, ["id"]).first()[0]
    assert text == "Columns (Properties): id, name, tag\nExample Rows:\nRow 1: id: 1, name: red ring big, tag: null\nRow 2: id: 2, name: blue bolt, tag: x\n"
    assert profile.sample_text(df.limit(0), ["id"]).first()[0] == "Columns (Properties): id, name, tag\n"
    assert profile.json_sample_text(df.limit(0), "name", ["id"]).first()[0] == ""
    rows = {r["name"]: r for r in profile.fields_to_embed(profile.column_profile(df)).collect()}
    assert (rows["tag"]["n_null"], rows["name"]["n_distinct"], rows["name"]["mean_words"]) == (1, 2, pytest.approx(8 / 3))
    assert [n for n, r in rows.items() if r["embed"]] == ["name"]
    assert [tuple(r) for r in profile.attribute_info(df).collect()][1] == ("name", "name of type string, for example blue bolt", "string")
    assert profile.metadata_fields(df) == ["id", "name", "tag"]
    keys = spark.createDataFrame([('{"a":1,"b":{}}',), ("[1]",), ('{"a":2}',)], "j string")
    assert sorted(r[0] for r in profile.json_fields(keys, "j").collect()) == ["a", "b"]
    text = profile.json_sample_text(keys.filter("j != '[1]'"), "j", ["j"]).first()[0]
    assert text == "Columns (Properties): a, b\nExample Rows:\nRow 1: a: 1, b: {}\nRow 2: a: 2\n"


def test_times_and_numbers(spark):
    df = spark.sql("select timestamp'2024-03-01 12:00:00.123456+05:00' as t, -7L as n")
    row = df.select(numbers.naive_utc(F.col("t")).alias("t"), numbers.clamp(F.col("n"), 0, 5).alias("c"), numbers.iso_now().alias("i"))
    assert dict(row.dtypes)["t"] == "timestamp_ntz"
    assert row.first()["t"] == datetime(2024, 3, 1, 7, 0, 0, 123456) and row.first()["c"] == 0
    assert datetime.fromisoformat(row.first()["i"])
    big = spark.sql("select 9007199254740993L as n").select(numbers.whole_quotient(F.col("n"), 2)).first()[0]
    assert big == 4503599627370496
    with pytest.raises(Exception, match="no time to convert"):
        spark.sql("select cast(null as timestamp) as t").select(numbers.naive_utc(F.col("t"))).collect()
