import hashlib
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docvec.llm import infill, queries

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def numbers(key):
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def brute(key, text):
    text, h = text or "", numbers(key)
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def some_texts():
    r = random.Random(3)
    texts = ["", None, "<P", "P>", "<", "S>x", "a<S>b", "<<P>>", "é", "ab", "x" * 30_000 + "é " * 20_000]
    return texts + ["".join(r.choice("ab <>PSM é한😀\n\0z") for _ in range(r.randint(0, 40))) for _ in range(2000)]


@pytest.mark.parametrize("step", [1 << 21, 64, 7])
def test_every_size_of_steps_gives_the_same(step, monkeypatch):
    """Texts, blocks and marks that lie over the borders of the array work."""
    monkeypatch.setattr(infill.blocks, "__defaults__", (step,))
    monkeypatch.setattr(infill.pieces, "__defaults__", (step,))
    texts = some_texts() if step > 7 else some_texts()[:10] + some_texts()[11:]
    made = infill.arrange(pa.array(texts, pa.string()), pa.array([numbers(k) for k in range(len(texts))], pa.list_(pa.int64())))
    assert [tuple(x.values()) for x in made.to_pylist()] == [brute(k, t) for k, t in enumerate(texts)]
    assert infill.rebuild(made.field("output"), made.field("form")).to_pylist() == [t or "" for t in texts]


def test_slices_of_a_column():
    texts = pa.array(["skip", "ab cd", "é<x"], pa.string()).slice(1)
    made = infill.arrange(texts, pa.array([numbers(1), numbers(2)], pa.list_(pa.int64())))
    assert [x["output"] for x in made.to_pylist()] == [brute(1, "ab cd")[4], brute(2, "é<x")[4]]


def test_rows_with_every_kind_of_trouble(spark):
    rows = [(None, "a b c", "o"), (None, "a b c", "o"), (1, None, None), (2, "", "x"), (3, "long é " * 100_000, "y"), (3, "other", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string")
    got = infill.transform(df).select("doc_id", "text", "output", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", F.col("fim.output").alias("made"))
    back = got.withColumn("back", infill.restored(F.col("made"), F.col("form"))).collect()
    assert sorted(map(str, [(r["doc_id"], r["text"], r["output"]) for r in back])) == sorted(map(str, rows))
    for r in back:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["made"]) == brute(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert infill.transform(df.limit(0)).collect() == []


def test_shares_and_seed(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"))
    forms = {r["form"]: r["count"] for r in infill.transform(df).groupBy("fim.form").count().collect()}
    assert 300 < forms["plain"] < 500 and 600 < forms["spm"] < 850
    none = infill.transform(df, plain_share=0, spm_share=100).groupBy("fim.form").count().collect()
    assert [tuple(r) for r in none] == [("spm", 4000)]
    one, two = (infill.transform(df, seed=s).select("fim.output").collect() for s in (1, 2))
    assert one != two


def test_an_output_without_its_marks_is_an_error():
    with pytest.raises(ValueError, match="three marks"):
        infill.rebuild(pa.array(["<P>a<S>b"]), pa.array(["psm"]))


def test_query_against_brute_force(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op11_fill_in_middle(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        *want, output = brute(r["doc_id"], docs[r["doc_id"]])
        assert [r["n"], r["form"], r["prefix_chars"], r["middle_chars"]] == want
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
