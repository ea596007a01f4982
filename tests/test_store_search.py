import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docvec import cluster
from docvec.functions import filters as flt
from docvec.functions import vectors as vec
from docvec.operators import search, store
from docvec.sources.documents import FILE_KEY

SCHEMA = "id string, vector array<float>, metadata map<string,string>"


def vectors(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


THREE = [
    ("north", [0.6, 0.0, 0.8], {"zone": "wet", FILE_KEY: "f1"}),
    ("south", [0.0, 0.6, 0.8], {"zone": "dry", FILE_KEY: "f1"}),
    ("west", [0.0, 1.0, 0.0], {"zone": "dry", FILE_KEY: "f2"}),
]


@pytest.fixture
def path(spark):
    return cluster.scratch_path(spark, "t")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_store_get_search_delete(spark, path):
    assert store.read_table(spark, path).count() == 0
    assert store.store(vectors(spark, THREE), path) == 3
    table = store.read_table(spark, path)
    assert ids(search.first_documents(table, 10)) == ["north", "south", "west"]
    hits = search.search(table, [0.0, 2.0, 0.0], 2).collect()
    assert [h["id"] for h in hits] == ["west", "south"] and hits[0]["score"] == 1.0
    assert store.info(table).first()[0] == 3
    assert store.delete_file(spark, path, "f1") is True
    assert store.delete_file(spark, path, "f1") is False
    assert ids(store.read_table(spark, path)) == ["west"]


def test_repeated_ids_last_wins_and_all_count(spark, path):
    rows = vectors(spark, [("a", [1.0], {}), ("b", [2.0], {}), ("a", [3.0], {})]).withColumn(
        "seq", F.monotonically_increasing_id()
    )
    assert store.store(rows, path, "seq") == 3
    got = {r["id"]: list(r["vector"]) for r in store.read_table(spark, path).collect()}
    assert got == {"a": [3.0], "b": [2.0]}
    assert store.store(vectors(spark, [("a", [9.0], {})]), path, batch_id=4) == 1
    assert store.store(vectors(spark, [("a", [7.0], {})]), path, batch_id=4) == 1  # a replay
    assert {r["id"]: list(r["vector"]) for r in store.read_table(spark, path).collect()} == {"a": [9.0], "b": [2.0]}


def test_random_writes_against_a_dict(spark, path):
    rng = random.Random(3)
    want = {}
    for step in range(6):
        if step == 3:
            store.compact(spark, path)
        if step == 4:
            gone = f"f{rng.randint(0, 2)}"
            assert store.delete_file(spark, path, gone) == any(f == gone for _, f in want.values())
            want = {k: v for k, v in want.items() if v[1] != gone}
        batch = [(f"k{rng.randint(0, 30)}", [float(step * 100 + i)], {FILE_KEY: f"f{rng.randint(0, 2)}"}) for i in range(20)]
        rows = vectors(spark, batch).withColumn("seq", F.col("vector")[0])
        assert store.store(rows, path, "seq") == 20
        want.update({k: (v[0], m[FILE_KEY]) for k, v, m in batch})
        got = {r["id"]: (r["vector"][0], r["file_id"]) for r in store.read_table(spark, path).collect()}
        assert got == want
    before = store.read_table(spark, path).count()
    assert store.compact(spark, path) == before == store.read_table(spark, path).count()


def test_uncommitted_version_is_not_read(spark, path):
    store.store(vectors(spark, THREE), path)
    left = vectors(spark, [("x", [0.0, 0.0, 1.0], {})]).withColumns(
        {"file_id": F.lit("f"), "deleted": F.lit(False), "writes": F.lit(1).cast("bigint")}
    )
    left.write.parquet(f"{path}/data/version=2")
    assert "x" not in ids(store.read_table(spark, path))
    store.store(vectors(spark, [("y", [0.0, 0.0, 1.0], {})]), path)
    assert ids(store.read_table(spark, path)) == ["north", "south", "west", "y"]


def test_delete_keeps_rows_without_a_file(spark):
    rows = vectors(spark, [("a", [1.0], {}), ("b", [1.0], None), ("c", [1.0], {FILE_KEY: "f"})])
    assert ids(store.delete_by_file(rows, "f")) == ["a", "b"]


def test_upsert_counts(spark):
    base = vectors(spark, THREE)
    new = vectors(spark, [("north", [1.0], {}), ("north", [2.0], {}), ("new", [3.0], {})])
    assert store.upsert_counts(base, new).first().asDict() == {"stored": 3, "created": 1, "updated": 1}


def brute(base, queries, k):
    out = {}
    for qid, q in queries:
        scored = []
        for i, v in base:
            n = np.linalg.norm(v) * np.linalg.norm(q)
            scored.append((-(round(float(np.dot(v, q) / n), 12) if n else 0.0), i))
        out[qid] = [(i, -s + 0.0) for s, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("limit", [0, 1000])
def test_batch_search_equals_brute_force(spark, limit):
    rng = np.random.default_rng(1)
    same = [1.0, 0.0, 1.0, 0.0]
    base = [(f"v{i}", same if i % 3 == 0 else rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(200)]
    queries = [(f"q{i}", rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(9)] + [("same", same), ("zero", [0.0] * 4)]
    rows = vectors(spark, [(i, v, {}) for i, v in base] + [("null", None, {}), (None, same, {})]).repartition(5)
    asked = spark.createDataFrame(queries, "query_id string, vector array<float>")
    got = {}
    for r in search.search_batch(rows, asked, 7, max_broadcast=limit).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    want = brute(base, queries, 7)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(abs(s - t) < 1e-9 for q, x in got.items() for (_, s), (_, t) in zip(x, want[q]))
    one = search.search(rows, queries[0][1], 7).collect()
    assert [r["id"] for r in one] == [i for i, _ in got["q0"]]


def test_blocks_cover_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = [(f"v{i}", rng.normal(size=3).astype("float32").tolist()) for i in range(120)]
    rows = vectors(spark, [(i, v, {}) for i, v in base])
    asked = rows.select(F.col("id").alias("query_id"), "vector")
    renamed = asked.select("query_id", F.col("vector").alias("query"))
    found = search._by_blocks(rows.select("id", "vector"), renamed, 3, per_query=17, values=75)
    assert found.groupBy("query_id", "id").count().filter("count > 1").isEmpty()
    whole = {(r["query_id"], r["id"], r["score"]) for r in search.search_batch(rows, asked, 3).collect()}
    parts = {(r["query_id"], r["id"], r["score"]) for r in found.collect()}
    assert whole <= parts


def test_no_queries_and_wrong_size(spark):
    rows = vectors(spark, THREE)
    none = spark.createDataFrame([], "query_id string, vector array<float>")
    assert search.search_batch(rows, none, 3).count() == 0
    assert search.search(rows, [1.0, 2.0], 1).count() == 0
    assert search.malformed(rows, 2).first()[0] == 3


def test_close_scores_and_malformed_vectors(spark):
    rows = vectors(spark, [("b", [1.0, 0.0009], {}), ("x", [1.0, 0.0], {}), ("short", [1.0], {}), ("hole", [1.0, None], {}), ("none", None, {})])
    assert [r["id"] for r in search.search(rows, [1.0, 0.0], 5).collect()] == ["x", "b"]
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<float>")
    for limit in (0, 10):
        got = search.search_batch(rows, asked, 5, max_broadcast=limit).orderBy("rank").collect()
        assert [r["id"] for r in got] == ["x", "b"]
    assert search.malformed(rows, 2).first()[0] == 3


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0])], "a array<float>, b array<float>")
    row = df.select(vec.dot(F.col("a"), F.col("b")), vec.norm(F.col("a")), vec.cosine(F.col("a"), F.col("b"))).first()
    assert tuple(row) == (24.0, 5.0, 0.96)
    with pytest.raises(Exception, match="vector must have 3 values"):
        df.select(vec.has_size(F.col("a"), 3)).collect()


ROWS = [(1, "red ring", 1.5, {"n": "10", "s": "x"}), (2, "Blue", None, {"n": "9"}), (3, None, 3.0, {}), (4, "red", -1.0, None)]
CASES = [
    ("name", "EQUAL", "red", [4]),
    ("name", "!=", "red", [1, 2]),
    ("price", "LESS_THAN", "1.5", [4]),
    ("price", "<=", "1.5", [1, 4]),
    ("price", "GREATER_THAN", "1.5", [3]),
    ("price", ">=", "1.5", [1, 3]),
    ("k", "IN", "[1, 3]", [1, 3]),
    ("k", "NOT IN", "[1, 3]", [2, 4]),
    ("name", "IN", '["red", "Blue"]', [2, 4]),
    ("k", "BETWEEN", "[2, 3]", [2, 3]),
    ("k", "NOT_BETWEEN", "[2, 3]", [1, 4]),
    ("name", "LIKE", "red%", [1, 4]),
    ("name", "NOT_LIKE", "red%", [2]),
    ("name", "IS_NULL", None, [3]),
    ("name", "IS NOT NULL", None, [1, 2, 4]),
    ("name", "MATCH", "RING, blue", [1, 2]),
    ("metadata.n", "LESS_THAN", "10", [2]),
    ("n", ">", "9", [1]),
    ("s", "=", "x", [1]),
]


@pytest.mark.parametrize("field,operator,value,want", CASES)
def test_filters(spark, field, operator, value, want):
    df = spark.createDataFrame(ROWS, "k int, name string, price double, metadata map<string,string>")
    got = flt.apply(df, [{"field": field, "operator": operator, "value": value}])
    assert sorted(r["k"] for r in got.collect()) == want


def test_filters_are_anded_and_checked(spark):
    df = spark.createDataFrame(ROWS, "k int, name string, price double, metadata map<string,string>")
    both = [{"field": "k", "operator": ">", "value": "1"}, {"field": "name", "operator": "LIKE", "value": "red%"}]
    assert [r["k"] for r in flt.apply(df, both).collect()] == [4]
    with pytest.raises(ValueError, match="supported are EQUAL, NOT_EQUAL"):
        flt.apply(df, [{"field": "k", "operator": "NEAR", "value": "1"}])
    with pytest.raises(ValueError):
        flt.apply(df, [{"field": "k", "operator": "BETWEEN", "value": "[1]"}])


def test_filter_reaches_the_scan(spark, sf):
    rows = spark.read.parquet(f"{sf}/part.parquet")
    plan = flt.apply(rows, [{"field": "p_size", "operator": "<", "value": "10"}])._jdf.queryExecution().toString()
    assert "LessThan(p_size,10)" in plan


def test_far_vectors_cost_no_step_per_query(monkeypatch):
    """Only queries for which a block has a row that can be among the k best are looked at one by one."""
    rng = np.random.default_rng(5)
    queries = rng.normal(size=(50, 8)).astype("float32")
    best = search._Best([f"q{i}" for i in range(50)], queries, 2)
    near = np.concatenate([queries * 2, queries * 3, queries * 0.5])
    best.add(np.array([f"n{i:03}" for i in range(150)], dtype=object), near)
    before = [list(x) for x in best.kept]
    assert [[i for _, i in x] for x in before] == [[f"n{i:03}", f"n{50 + i:03}"] for i in range(50)]
    steps = []
    monkeypatch.setattr(search._Best, "_merge", lambda self, q, scores, ids: steps.append(q))
    far = rng.normal(size=(1000, 8)).astype("float32")
    best.add(np.array([f"f{i}" for i in range(1000)], dtype=object), far)
    assert steps == [] and best.kept == before
