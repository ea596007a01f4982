import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from docvec.cluster import written
from docvec.llm import mixing, secrets
from .test_jaccard import brute as components

SF = "/root/testdata/sf0.001"


def test_every_stage_against_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bad = spark.createDataFrame([(9001, None, "en", "src0", 0), (9002, "123 456", None, None, 7), (9003, "", "en", "src1", 0)], docs.schema)
    columns = docs.columns
    docs = written(docs.unionByName(bad).unionByName(docs.limit(3)), "docs")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), "stage")
        kept[name] = (before.collect(), docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns

    before, after = kept["language ID"]
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before if r["doc_id"] < 9000)

    before, after = kept["n-gram Jaccard join"]
    once = sorted({(r["doc_id"], r["text"]) for r in before})
    want = {key for key, _, component in components(once) if key == component}
    assert Counter(r["doc_id"] for r in after) == Counter(dict.fromkeys(want, 1))

    before, after = kept["secret scans"]
    texts = {r["doc_id"]: r["text"] for r in before}
    assert set(texts) == {r["doc_id"] for r in after}
    for r in after:
        assert r["n_chars"] == len(r["text"]) and not re.search(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", r["text"])
        if not secrets.base_spans(texts[r["doc_id"]], texts[r["doc_id"]].lower(), True):
            assert r["text"] == texts[r["doc_id"]]

    before, after = kept["mixing sources to target weights"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(before, spark.read.parquet(f"{SF}/documents.parquet").schema)).collect()}
    assert Counter(r["doc_id"] for r in after) == +Counter(copies)
    assert {(r["doc_id"], r["text"]) for r in after} <= {(r["doc_id"], r["text"]) for r in before}

    before, after = kept["SentencePiece encoding"]
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in after)


def test_extra_columns_pass_unharmed(spark):
    """Columns named like those the stages work with, and names that Spark would take apart."""
    names = ["spans", "base_spans", "weak_spans", "linked_spans", "text_key", "row_hash", "row_copies", "row_key", "taken_hash",
             "kept_key", "kept_hash", "score", "lang_pred", "copies", "size", "ids", "n_tokens", "a.b", "extra_5"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = docs.columns
    marks = [F.concat(F.lit(f"{n} of "), F.col("doc_id")).alias(n) for n in names]
    docs = written(docs.select(F.col("doc_id"), *marks, *plain[1:]), "marked")
    columns, bare = docs.columns, docs.select(*plain)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, bare = written(stage(spark, docs, SF), "marked"), written(stage(spark, bare, SF), "bare")
        assert docs.columns == columns, name
        rows = docs.collect()
        assert all(r[n] == f"{n} of {r['doc_id']}" for r in rows for n in names), name
        assert Counter(tuple(r[c] for c in plain) for r in rows) == Counter(map(tuple, bare.collect())), name
    last = corpus_pipeline.sentencepiece(spark, docs, SF)
    assert Counter(map(str, last.collect())) == Counter(map(str, corpus_pipeline.sentencepiece(spark, bare, SF).collect()))


def test_language_id_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert corpus_pipeline.language_id(spark, docs, "").count() == docs.where(docs["text"].rlike(r"\p{L}")).count()


def test_odd_rows_and_no_rows(spark):
    """Each stage by itself, on nulls in every column, empty, blank and very long texts and repeated rows, and on an empty table."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    prose = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").orderBy("doc_id").limit(12).collect()]
    rows = [(i, t, "en", "src1", len(t)) for i, t in enumerate(prose)]
    rows += [(100, None, "en", "src0", 0), (101, "", None, None, None), (102, " \n ", "en", "src1", 3), (None, " ".join(reversed(prose[0].split())), None, "src1", None),
             (103, "long words and secrets " * 60_000, "en", "src2", 9), (0, *rows[0][1:]), (104, "password = hunter22secret", "en", "src1", 1)]
    docs = written(spark.createDataFrame(rows, schema), "odd")
    stages = dict(corpus_pipeline.STAGES)

    def keys(df):
        return Counter(r["doc_id"] for r in df.collect())

    every = keys(docs)
    found = stages["language ID"](spark, docs, SF)
    assert keys(found) == every - Counter([100, 101, 102]) and found.columns == docs.columns
    joined = stages["n-gram Jaccard join"](spark, docs, SF)
    assert keys(joined) == Counter(dict.fromkeys(every, 1)) and joined.columns == docs.columns
    clean = {r["doc_id"]: r for r in stages["secret scans"](spark, docs, SF).collect()}
    assert clean[100]["text"] is None and clean[100]["n_chars"] is None and clean[101]["text"] == "" and clean[103]["n_chars"] == 23 * 60_000
    assert clean[104]["text"] == "[secret]" and keys(stages["secret scans"](spark, docs, SF)) == every
    mixed = stages["mixing sources to target weights"](spark, docs, SF)
    assert mixed.columns == docs.columns and set(keys(mixed)) <= set(every)
    coded = {r["doc_id"]: (r["ids"], r["n_tokens"]) for r in stages["SentencePiece encoding"](spark, docs, SF).collect()}
    assert coded[100] == (None, None) and coded[101] == ([], 0) and coded[103][1] > 60_000
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == [], name
