from pyspark.sql import functions as F

from docvec.operators import admit

FILES = "id string, path string, source_name string, size long, extra int"


def test_files_are_refused_for_the_first_reason(spark):
    rows = [("a.txt", "s", 5), ("b.TXT", "s", admit.MAX_BYTES + 1), ("c.csv", "s", 5), ("d.metadata", "s", 1 << 40), ("none", "s", 5), ("e.md", "s", 5),
            ("f.md", "s", 5), ("a.txt", None, 5), ("b.txt", None, 5), ("c.txt", None, 5), ("a.txt", "t", 5)]
    df = spark.createDataFrame([(n, f"x/{n}", s, size, 1) for n, s, size in rows], FILES).repartition(3)
    got = {(r["id"], r["source_name"]): r["refused"] for r in admit.refusal(df, max_files=2).collect()}
    assert got == {("a.txt", "s"): None, ("b.TXT", "s"): "too large", ("c.csv", "s"): "format not supported", ("d.metadata", "s"): "skipped format",
                   ("none", "s"): "format not supported", ("e.md", "s"): None, ("f.md", "s"): "too many files", ("a.txt", None): None, ("b.txt", None): None,
                   ("c.txt", None): "too many files", ("a.txt", "t"): None}
    assert admit.refusal(df, max_files=2).columns == [*df.columns, "refused"]
    assert admit.admitted(df, formats=None, skipped=(), max_bytes=None).count() == len(rows)
    assert admit.admitted(df, max_files=0).count() == 0 and admit.refusal(df.limit(0), max_files=3).collect() == []
    assert [r[0] for r in spark.createDataFrame([("abc",), ("ab",), (None,)], "t string").select(admit.too_long(F.col("t"), 2)).collect()] == ["too long", None, None]


def test_protected_indexes_open_by_group(spark):
    rows = spark.createDataFrame([(1, "free"), (2, "closed"), (3, "open"), (4, None)], "n int, index string")
    protected = spark.createDataFrame([("closed", "a"), ("open", "a"), ("open", "b")], "index string, group string")
    assert {r["n"] for r in admit.visible(rows, protected, ["b", "c"]).collect()} == {1, 3, 4}
    assert {r["n"] for r in admit.visible(rows, protected, []).collect()} == {1, 4}
