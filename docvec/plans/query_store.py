"""Registered queries: vector table, search, filters."""

from pyspark.sql import functions as F

from docvec import cluster
from docvec.functions import filters as flt
from docvec.functions import maps
from docvec.functions import vectors as vec
from docvec.operators import index, search, store
from docvec.plans import ingest
from docvec.plans.query_chunks import HASHED, WINDOWS
from docvec.plans.registry import query, table
from docvec.sources import documents


def stored(spark, sf):
    """Embeddings as a vector table; a label stands for a file."""
    label = F.concat(F.lit("label-"), "label")
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").alias("vector"),
        maps.from_columns({documents.FILE_KEY: label, "label": F.col("label")}).alias("metadata"),
        F.col("vec_id").alias("n"),
    )


def changes(spark, sf):
    """Three writes per vector of labels 1 and 2, the last of which counts; half get new ids."""
    rows = stored(spark, sf).filter(F.col("metadata")["label"].isin("1", "2"))
    new_id = F.when(F.col("n") % 2 == 0, F.col("id")).otherwise(F.concat(F.lit("new-"), "id"))
    return rows.withColumn("seq", F.explode(F.array(F.lit(2), F.lit(3), F.lit(1)))).withColumns(
        {
            "id": new_id,
            "vector": F.transform("vector", lambda x: (x * F.col("seq")).cast("float")),
        }
    )


CHANGED = """
    SELECT vec_id::VARCHAR AS id, label, embedding[1]::DOUBLE AS v FROM embeddings
    WHERE NOT (label IN (1, 2) AND vec_id % 2 = 0)
    UNION ALL
    SELECT CASE WHEN vec_id % 2 = 0 THEN '' ELSE 'new-' END || vec_id, label, (embedding[1] * 3::FLOAT)::DOUBLE
    FROM embeddings WHERE label IN (1, 2)"""


def shown(rows):
    return rows.select(
        "id",
        F.col("metadata")["label"].cast("bigint").alias("label"),
        F.round(F.col("vector")[0].cast("double"), 5).alias("first"),
    )


@query(f"SELECT id, label::BIGINT AS label, round(v, 5) AS first FROM ({CHANGED})")
def upsert(spark, sf):
    base = stored(spark, sf).select("id", "vector", "metadata")
    once = store.latest(changes(spark, sf).select("id", "vector", "metadata", "seq"), "seq")
    return shown(store.upsert(base, once))


@query(
    """SELECT 3 * count(*) AS stored, count(*) FILTER (vec_id % 2 = 1) AS created,
              count(*) FILTER (vec_id % 2 = 0) AS updated FROM embeddings WHERE label IN (1, 2)"""
)
def upsert_counts(spark, sf):
    return store.upsert_counts(stored(spark, sf), changes(spark, sf))


@query(f"SELECT id, label::BIGINT AS label, round(v, 5) AS first FROM ({CHANGED}) WHERE label <> 3")
def store_table(spark, sf):
    """Store, store changes twice under one batch id, delete a file, fold, and read."""
    path = cluster.scratch_path(spark, "vectors")
    store.store(stored(spark, sf), path)
    for _ in range(2):
        store.store(changes(spark, sf), path, "seq", batch_id="b1")
    store.delete_file(spark, path, "label-3")
    store.compact(spark, path)
    return shown(store.read_table(spark, path))


@query(f"SELECT id, label::BIGINT AS label, round(v, 5) AS first FROM ({CHANGED}) WHERE label <> 3")
def store_table_unfolded(spark, sf):
    """The same table read from its single versions."""
    path = cluster.scratch_path(spark, "vectors")
    store.store(stored(spark, sf), path)
    store.store(changes(spark, sf), path, "seq")
    store.delete_file(spark, path, "label-3")
    return shown(store.read_table(spark, path))


@query("SELECT vec_id::VARCHAR AS id FROM embeddings WHERE label <> 5")
def delete_by_file(spark, sf):
    return store.delete_by_file(stored(spark, sf), "label-5").select("id")


@query(
    """SELECT vec_id::VARCHAR AS id FROM embeddings WHERE label NOT IN
       (SELECT (doc_id % 7) FROM labels WHERE quality = 0 AND toxic = 1)"""
)
def delete_by_files(spark, sf):
    gone = table(spark, sf, "labels").filter("quality = 0 and toxic = 1")
    files = gone.select(F.concat(F.lit("label-"), F.col("doc_id") % 7).alias("file_id")).distinct()
    rows = stored(spark, sf).withColumn("file_id", F.col("metadata")[documents.FILE_KEY])
    return store.delete_by_files(rows, files).select("id")


@query("SELECT count(*) AS number_vectors_stored FROM embeddings")
def sink_info(spark, sf):
    return store.info(stored(spark, sf))


@query(
    """SELECT vec_id::VARCHAR AS id, 1.0::DOUBLE AS score, label::VARCHAR AS label
       FROM embeddings ORDER BY vec_id::VARCHAR LIMIT 10"""
)
def get_documents(spark, sf):
    rows = search.first_documents(stored(spark, sf), 10)
    return rows.select("id", "score", F.col("metadata")["label"].alias("label"))


# ---------------------------------------------------------------- similarity

COSINE = """round(list_dot_product({a}::DOUBLE[], {b}::DOUBLE[]) /
            (sqrt(list_dot_product({a}::DOUBLE[], {a}::DOUBLE[])) * sqrt(list_dot_product({b}::DOUBLE[], {b}::DOUBLE[]))), 12)"""


def score():
    """Ranks count twelve decimals, results show six."""
    return F.round("score", 6).alias("score")


TO_FIRST = COSINE.format(a="e.embedding", b="q.embedding")


def first_vector(spark, sf):
    return list(table(spark, sf, "embeddings").orderBy("vec_id").select("embedding").first()[0])


@query(
    f"""SELECT id, round(s, 6) AS score FROM (SELECT e.vec_id::VARCHAR AS id, {TO_FIRST} AS s FROM embeddings e,
        (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q ORDER BY s DESC, id LIMIT 10)"""
)
def vector_topk(spark, sf):
    return search.search(stored(spark, sf), first_vector(spark, sf), 10).select("id", score())


@query(
    f"""SELECT id, round(s, 6) AS score FROM (SELECT e.vec_id::VARCHAR AS id, {TO_FIRST} AS s FROM embeddings e,
        (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q
        WHERE e.label IN (2, 4, 6) AND e.label < 6 ORDER BY s DESC, id LIMIT 10)"""
)
def vector_topk_filtered(spark, sf):
    filters = [
        {"field": "label", "operator": "IN", "value": "[2, 4, 6]"},
        {"field": "metadata.label", "operator": "LESS_THAN", "value": "6"},
    ]
    return search.search(stored(spark, sf), first_vector(spark, sf), 10, filters).select("id", score())


@query(
    f"""WITH scored AS (
            SELECT e.vec_id::VARCHAR AS id, e.label, e.vec_id, {TO_FIRST} AS s
            FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q
        )
        SELECT 'all' AS kind, id, round(s, 6) AS score FROM (SELECT * FROM scored ORDER BY s DESC, id LIMIT 10)
        UNION ALL
        SELECT 'some', id, round(s, 6) FROM (
            SELECT * FROM scored WHERE label::VARCHAR IN ('2', '4', '6') AND label < 6 ORDER BY s DESC, id LIMIT 10)"""
)
def vector_topk_index(spark, sf):
    """Searches of a copy in cells, all rows and filtered by a metadata key that has a column there."""
    path = cluster.scratch_path(spark, "cells")
    index.build(stored(spark, sf), path, keys=("label",), cell_rows=100)
    query = first_vector(spark, sf)
    filters = [
        {"field": "metadata.label", "operator": "IN", "value": '["2", "4", "6"]'},
        {"field": "label", "operator": "LESS_THAN", "value": 6},
    ]
    found = [index.search(spark, path, query, 10, f).withColumn("kind", F.lit(k)) for k, f in (("all", None), ("some", filters))]
    return found[0].unionByName(found[1]).select("kind", "id", score())


ALL_PAIRS = f"""
    SELECT query_id, id, round(score, 6) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
        SELECT q.vec_id::VARCHAR AS query_id, e.vec_id::VARCHAR AS id, {TO_FIRST} AS score
        FROM embeddings e, embeddings q)) WHERE rank <= 5"""


def all_queries(spark, sf):
    return stored(spark, sf).select(F.col("id").alias("query_id"), "vector")


def ranked(rows):
    return rows.select("query_id", "id", score(), F.col("rank").cast("bigint").alias("rank"))


@query(ALL_PAIRS)
def vector_topk_batch(spark, sf):
    return ranked(search.search_batch(stored(spark, sf), all_queries(spark, sf), 5))


@query(
    """SELECT vec_id::VARCHAR AS id, CAST(row_number() OVER (ORDER BY abs(atan((1 + vec_id * 0.001)::FLOAT::DOUBLE) - atan(1.05::FLOAT::DOUBLE)), vec_id::VARCHAR) AS INTEGER) AS rank
       FROM embeddings WHERE vec_id % 3 <> 0 QUALIFY rank <= 5"""
)
def vector_topk_close(spark, sf):
    """Vectors that differ in the seventh decimal of their score, among malformed ones that are no hits."""
    x = (F.lit(1.0) + F.col("vec_id") * 0.001).cast("float")
    third = F.when(F.col("vec_id") % 9 == 0, F.array(x)).when(F.col("vec_id") % 9 == 3, F.array(x, F.lit(None).cast("float")))
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.when(F.col("vec_id") % 3 == 0, third).otherwise(F.array(x, F.lit(1.0).cast("float"))).alias("vector"),
        maps.empty_map().alias("metadata"),
    )
    asked = rows.limit(1).select(F.lit("q").alias("query_id"), F.array(F.lit(1.05), F.lit(1.0)).cast("array<float>").alias("vector"))
    return search.search_batch(rows, asked, 5).select("id", F.col("rank").cast("int").alias("rank"))


@query(ALL_PAIRS)
def vector_topk_blocks(spark, sf):
    """The way beyond the bound on broadcast queries."""
    return ranked(search.search_batch(stored(spark, sf), all_queries(spark, sf), 5, max_broadcast=0))


@query(
    f"""SELECT d.doc_id::VARCHAR AS id, round({COSINE.format(a='a.embedding', b='b.embedding')}, 6) AS score
        FROM documents d JOIN embeddings a ON d.doc_id = a.vec_id JOIN embeddings b ON b.vec_id = a.vec_id // 2"""
)
def pair_similarity(spark, sf):
    """Cosine of joined pairs, in the JVM."""
    rows = table(spark, sf, "embeddings")
    a = rows.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("a"))
    b = rows.select(F.col("vec_id").alias("half"), vec.has_size(F.col("embedding"), 64).alias("b"))
    docs = table(spark, sf, "documents").select("doc_id")
    both = docs.join(a, "doc_id").join(b, F.floor(F.col("doc_id") / 2) == F.col("half"))
    score = F.round(vec.cosine(F.col("a"), F.col("b")), 6)
    return both.select(F.col("doc_id").cast("string").alias("id"), score.alias("score"))


def dense(key, text, source):
    return f"SELECT {key}, list(v::FLOAT ORDER BY d) AS vec FROM ({HASHED.format(key=key, text=text, source=source)}) GROUP BY {key}"


SEARCHED = f"""
    WITH chunks AS ({WINDOWS.format(size=500, step=500)}),
         c AS ({dense('id', 'content', 'chunks')}),
         q AS ({dense('item_id', 'text', 'benchmark')})
    SELECT query_id, id, round(score, 6) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (
        SELECT q.item_id::VARCHAR AS query_id, c.id, coalesce(CASE WHEN isnan(s) THEN 0.0 ELSE s END, 0.0) AS score
        FROM (SELECT q.item_id, c.id, {COSINE.format(a='c.vec', b='q.vec')} AS s FROM c, q) p
        JOIN c ON c.id = p.id JOIN q ON q.item_id = p.item_id)) WHERE rank <= 5"""


@query(SEARCHED)
def search_documents(spark, sf):
    """The flagship: chunk and embed all documents, embed the query texts, rank chunks per query."""
    docs = documents.string_docs(table(spark, sf, "documents", "doc_id", "text"), "doc_id", "text")
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("content"))
    return ranked(ingest.nearest_chunks(docs, asked))


# ---------------------------------------------------------------- filters


def filtered(source, columns, *conditions):
    def run(spark, sf):
        filters = [dict(zip(("field", "operator", "value"), c)) for c in conditions]
        return flt.apply(table(spark, sf, source), filters).select(*columns)

    return run


FILTERS = {
    "filter_equal": ("part", "p_brand = 'Brand#2'", [("p_brand", "EQUAL", "Brand#2")]),
    "filter_not_equal": ("part", "p_brand <> 'Brand#2'", [("p_brand", "NOT_EQUAL", "Brand#2")]),
    "filter_less": ("part", "p_size < 10", [("p_size", "LESS_THAN", "10")]),
    "filter_less_equal": ("part", "p_size <= 10", [("p_size", "LESS_THAN_OR_EQUAL", "10")]),
    "filter_greater": ("part", "p_retailprice > 950.5", [("p_retailprice", "GREATER_THAN", "950.5")]),
    "filter_greater_equal": ("part", "p_retailprice >= 950.5", [("p_retailprice", "GREATER_THAN_OR_EQUAL", "950.5")]),
    "filter_in": ("part", "p_size IN (1, 5, 9)", [("p_size", "IN", "[1, 5, 9]")]),
    "filter_not_in": ("part", "p_type NOT IN ('ECONOMY', 'SMALL')", [("p_type", "NOT_IN", '["ECONOMY", "SMALL"]')]),
    "filter_between": ("part", "p_size BETWEEN 10 AND 20", [("p_size", "BETWEEN", "[10, 20]")]),
    "filter_not_between": ("part", "p_size NOT BETWEEN 10 AND 20", [("p_size", "NOT_BETWEEN", "[10, 20]")]),
    "filter_like": ("part", "p_name LIKE '%ring'", [("p_name", "LIKE", "%ring")]),
    "filter_not_like": ("part", "p_name NOT LIKE '%ring'", [("p_name", "NOT_LIKE", "%ring")]),
    "filter_is_null": ("part", "p_type IS NULL", [("p_type", "IS_NULL", "")]),
    "filter_is_not_null": ("part", "p_type IS NOT NULL", [("p_type", "IS_NOT_NULL", "")]),
    "filter_match": (
        "part", "list_has_any(string_split(lower(p_name), ' '), ['red', 'bolt'])", [("p_name", "MATCH", "Bolt, RED")]
    ),
    "filter_all": (
        "part",
        "p_size >= 5 AND p_type <> 'SMALL' AND p_name LIKE 'red%'",
        [("p_size", ">=", "5"), ("p_type", "!=", "SMALL"), ("p_name", "like", "red%")],
    ),
    "filter_time": (
        "orders",
        "o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-01-01'",
        [("o_orderdate", "BETWEEN", '["1995-01-01", "1996-01-01"]')],
    ),
    "filter_number_in_text": (
        "events", "json_extract_string(props, '$.k')::DOUBLE < 20", [("metadata.k", "LESS_THAN", "20")]
    ),
}
KEYS = {"part": "p_partkey", "orders": "o_orderkey", "events": "event_id"}


def _with_metadata(spark, sf):
    rows = table(spark, sf, "events")
    parsed = rows.withColumn("metadata", F.from_json("props", "map<string,string>"))
    return flt.apply(parsed, [{"field": "metadata.k", "operator": "LESS_THAN", "value": "20"}]).select("event_id")


# A text column of nulls, words and numbers in several spellings, and whole numbers that no double holds.
MIXED = """(SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN lang WHEN 2 THEN '05' WHEN 3 THEN '5.0'
             ELSE (doc_id % 13)::VARCHAR END AS code, 9007199254740992 + doc_id AS big,
             CASE WHEN doc_id % 5 <> 0 THEN source END AS source FROM documents)"""
IN_RANGE = "coalesce(TRY_CAST(code AS DECIMAL(38, 18)) BETWEEN 1 AND 9, false)"
MIXED_FILTERS = {
    "filter_text_equal": ("code = '5'", ("code", "EQUAL", "5")),
    "filter_text_not_equal": ("code <> '5'", ("code", "NOT_EQUAL", "5")),
    "filter_text_in": ("code IN ('5', 'en')", ("code", "IN", '[5, "en"]')),
    "filter_text_not_in": ("code NOT IN ('5', '05')", ("code", "NOT_IN", '["5", "05"]')),
    "filter_text_in_none": ("false", ("code", "IN", "[]")),
    "filter_text_not_in_none": ("code IS NOT NULL", ("code", "NOT_IN", "[]")),
    "filter_text_less": ("TRY_CAST(code AS DECIMAL(38, 18)) < 5.5", ("code", "LESS_THAN", "5.5")),
    "filter_text_between": (IN_RANGE, ("code", "BETWEEN", "[1, 9]")),
    "filter_text_not_between": (f"code IS NOT NULL AND NOT {IN_RANGE}", ("code", "NOT_BETWEEN", "[1, 9]")),
    "filter_text_is_null": ("code IS NULL", ("code", "IS_NULL", "")),
    "filter_text_is_not_null": ("code IS NOT NULL", ("code", "IS_NOT_NULL", "")),
    "filter_big_equal": ("big = 9007199254740993", ("big", "EQUAL", "9007199254740993")),
    "filter_big_greater": ("big > 9007199254740993", ("big", "GREATER_THAN", "9007199254740993")),
    "filter_big_less_half": ("big < 9007199254740999.5", ("big", "LESS_THAN", "9007199254740999.5")),
    "filter_big_in": ("big IN (9007199254740993, 9007199254741001)", ("big", "IN", "[9007199254740993, 9007199254741001]")),
}


def mixed(spark, sf):
    n = F.col("doc_id") % 7
    code = F.when(n == 1, F.col("lang")).when(n == 2, "05").when(n == 3, "5.0").when(n > 3, (F.col("doc_id") % 13).cast("string"))
    return table(spark, sf, "documents").select("doc_id", code.alias("code"), (F.col("doc_id") + (1 << 53)).alias("big"))


def mixed_filter(condition):
    def run(spark, sf):
        return flt.apply(mixed(spark, sf), [dict(zip(("field", "operator", "value"), condition))]).select("doc_id")

    return run


for _name, (_where, _condition) in MIXED_FILTERS.items():
    _run = mixed_filter(_condition)
    _run.__name__ = _name
    query(f"SELECT doc_id FROM {MIXED} WHERE {_where}")(_run)

for _name, (_source, _where, _conditions) in FILTERS.items():
    _run = _with_metadata if _source == "events" else filtered(_source, [KEYS[_source]], *_conditions)
    _run.__name__ = _name
    query(f"SELECT {KEYS[_source]} FROM {_source} WHERE {_where}")(_run)
