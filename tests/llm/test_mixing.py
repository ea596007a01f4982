import re
from collections import Counter

from pyspark.sql import functions as F

from docvec.llm import mixing, queries

SCHEMA = "doc_id long, text string, source string, target string, rate int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], SCHEMA)


def wanted(sizes):
    """Targets by the rule itself: reshare what is above, until nothing is."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, free, result = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        total = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / total > 2 * sizes[s]] if free else []
        if not over:
            return result | {s: left * weights[s] / total for s in free}
        for s in over:
            result[s] = 2.0 * sizes[s]
        left = 1.5 * sum(sizes.values()) - sum(result.values())
        free -= set(over)


def test_query_targets_and_taken(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op6_source_mix(spark, sf)
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = found.collect()
    sizes, taken, target, most = Counter(), Counter(), {}, Counter()
    for r in rows:
        doc = docs[r["doc_id"]]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", doc["text"]))
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        sizes[doc["source"]] += r["size"]
        taken[doc["source"]] += r["taken"]
        target[doc["source"]] = r["target"]
        most[doc["source"]] = max(most[doc["source"]], r["size"])
    assert len(rows) == len(docs) and {r["source_size"] for r in rows} == set(sizes.values())
    want = wanted(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * want[s]
        assert abs(taken[s] - target[s]) <= most[s]  # within its largest document
    again = queries.op6_source_mix(spark, sf)
    assert sorted(again.collect()) == sorted(rows)


def test_rates_are_tilted_exponentially(spark):
    rows = [(i, "w " * (1 + i % 40), "s") for i in range(400)] + [(1000 + i, "w " * 30, "t") for i in range(900)]
    got = mixing.mix(frame(spark, rows)).where("target < 2 * source_size").collect()
    tokens = Counter()
    for r in got:
        tokens[r["target"]] += r["rate"] * r["size"]
    assert all(abs(v - t) < 1e-3 * t for t, v in tokens.items())


def test_edges(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    rows = [(1, None, "a"), (2, "", "b"), (3, "x y", None), (3, "x y", None), (None, "z", "c"), (5, " \n", None)]
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == 6 and sorted(r["size"] for r in got) == [0, 0, 0, 1, 2, 2]
    assert all(0 <= r["copies"] <= 2 for r in got)
    zero = mixing.mix(frame(spark, [(1, None, "a"), (2, "", "a")])).collect()
    assert [r["target"] for r in zero] == [0.0, 0.0]


def test_one_source_holds_most_rows(spark):
    rows = [(i, "w " * (5 if i % 3 else 50), "hot") for i in range(3000)] + [(9000 + i, "w " * (i + 1), f"s{i}") for i in range(20)]
    got = mixing.mix(frame(spark, rows))
    sums = got.groupBy("target").agg(F.sum(F.col("copies") * F.col("size")).alias("t"), F.max("size").alias("m")).collect()
    assert all(abs(r["t"] - r["target"]) <= r["m"] for r in sums)


def test_repeat_keeps_columns_and_counts(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 4}") for i in range(100)] + [(3, "w " * 4, "s3")]
    df = frame(spark, rows)
    got = mixing.repeat(df)
    assert got.columns == df.columns
    copies = Counter()
    for r in mixing.mix(df).collect():
        copies[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in got.collect()) == +copies
