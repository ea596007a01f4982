import time

import pytest
from pyspark.sql import functions as F

from docvec.functions import sql
from docvec.operators import chunk, sections
from docvec.sources import documents, jsondocs


@pytest.mark.parametrize(
    "text, want",
    [
        ("", []),
        ("no heading\nat all", [("no heading\nat all", {})]),
        ("before\n# A\none\n## B\ntwo\n### C\nthree\n## D\nfour\n# E\nfive",
         [("before", {}), ("one", {"1": "A"}), ("two", {"1": "A", "2": "B"}), ("three", {"1": "A", "2": "B", "3": "C"}), ("four", {"1": "A", "2": "D"}), ("five", {"1": "E"})]),
        ("# A\n# B\n\n  \n## C", []),
        ("### C\nx\n# A\ny", [("x", {"3": "C"}), ("y", {"1": "A"})]),
        ("#hash\n#### four\n #\tA \nx", [("#hash\n#### four", {}), ("x", {"1": "A"})]),
        ("```py\n# no\n~~~\n# no\n```\n# A\n~~~~\n```\n# no\n~~~\n~~~~ \n# B\nx", [("```py\n# no\n~~~\n# no\n```", {}), ("~~~~\n```\n# no\n~~~\n~~~~", {"1": "A"}), ("x", {"1": "B"})]),
        ("# A\n```\n# never closed", [("```\n# never closed", {"1": "A"})]),
        ("`` ` ``\n```a`\n# A\nx", [("`` ` ``\n```a`", {}), ("x", {"1": "A"})]),
    ],
)
def test_sections_know_their_headings(text, want):
    names = [("#", "1"), ("##", "2"), ("###", "3")]
    assert list(sections.split_at_headings(text, names)) == want


def test_sections_take_linear_time():
    text = "# " * 300_000 + "\n" + "#\n" * 200_000 + "```\n" * 100_001 + "x"
    start = time.perf_counter()
    list(sections.split_at_headings(text))
    assert time.perf_counter() - start < 3


def test_sections_are_documents(spark):
    rows = [("d", "# A\none two\n## B\nthree", {"Header 1": "old", "k": "v"}, 7), ("n", None, None, 8), (None, "x", {}, 9)]
    docs = spark.createDataFrame(rows, "id string, content string, metadata map<string,string>, extra int")
    got = [(r["id"], r["content"], r["metadata"], r["extra"]) for r in sections.explode_sections(docs, keep=True).collect()]
    assert got == [("d_0", "# A\none two", {"Header 1": "A", "k": "v"}, 7), ("d_1", "## B\nthree", {"Header 1": "A", "Header 2": "B", "k": "v"}, 7), (None, "x", {}, 9)]
    chunks = chunk.explode_chunks(sections.explode_sections(docs), chunk.recursive_chunks(F.col("content"), 4))
    assert {r["id"] for r in chunks.where("doc_id IS NOT NULL").collect()} == {"d_0_0", "d_0_1", "d_1_0", "d_1_1"}


def test_table_functions_give_the_rows_of_the_columns(spark, sf):
    sql.register(spark)
    docs = documents.string_docs(spark.read.parquet(f"{sf}/documents.parquet").limit(60), "doc_id", "text").cache()
    docs = docs.unionByName(spark.createDataFrame([("null", None, {}), ("empty", "", {})], docs.schema))
    for call, column in {
        "recursive_chunks(d.content, 200, 20)": chunk.recursive_chunks(F.col("content"), 200, 20),
        "character_chunks(d.content, '. ', 300, 0)": chunk.character_chunks(F.col("content"), 300, 0, ". "),
        "window_chunks(d.content, 100, 30)": chunk.window_chunks(F.col("content"), 100, 30),
    }.items():
        got = spark.sql(f"SELECT d.id, c.chunk_index, c.content FROM {{docs}} d, LATERAL {call} c", docs=docs)
        want = chunk.explode_chunks(docs, column).select("doc_id", "chunk_index", "content")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    leaves = spark.sql("""SELECT l.id, l.content FROM (SELECT '{"id": 5, "a": [1, {"b": true}]}' AS t) d, LATERAL json_leaves(d.t, 'id') l""")
    assert [tuple(r) for r in leaves.collect()] == [(x, y) for x, y, _ in jsondocs.walk({"id": 5, "a": [1, {"b": True}]}, "id", frozenset(), (), "json")]
    found = spark.sql("SELECT s.* FROM (SELECT '# A\\nx' AS t) d, LATERAL markdown_sections(d.t) s").collect()
    assert [(r["content"], r["headings"]) for r in found] == [("x", {"Header 1": "A"})]
    lines = spark.sql("SELECT h.content FROM (SELECT '<p>one</p> two<br>' AS t) d, LATERAL html_lines(d.t) h ORDER BY line").collect()
    assert [r[0] for r in lines] == ["one", "two"]
    with pytest.raises(Exception, match="chunk_size must be at least 1"):
        spark.sql("SELECT * FROM window_chunks('x', 0, 0)").collect()
