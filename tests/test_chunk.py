import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from docvec.functions import maps
from docvec.operators import chunk


def slow_merge(pieces, separator, size, overlap):
    """The merge rule one piece at a time."""
    gap, out, open_, total = len(separator), [], [], 0
    for piece in pieces:
        if open_ and total + gap + len(piece) > size:
            out.append(separator.join(open_).strip())
            while open_ and (total > overlap or total + gap + len(piece) > size):
                total -= len(open_.pop(0)) + (gap if open_ else 0)
        total += len(piece) + (gap if open_ else 0)
        open_.append(piece)
    out.append(separator.join(open_).strip())
    return [c for c in out if c]


def slow_recursive(text, separators, size, overlap):
    separator = next((s for s in separators if s == "" or s in text), separators[-1])
    rest = separators[separators.index(separator) + 1 :]
    if separator == "":
        pieces = list(text)
    else:
        first, *more = text.split(separator)
        pieces = [p for p in [first, *[separator + m for m in more]] if p]
    out, run = [], []
    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
            continue
        out += slow_merge(run, "", size, overlap) if run else []
        run = []
        out += slow_recursive(piece, rest, size, overlap) if rest else [piece]
    return out + (slow_merge(run, "", size, overlap) if run else [])


TEXT = st.text(alphabet="ab é\n.", max_size=60)
SIZES = st.integers(1, 12).flatmap(lambda n: st.tuples(st.just(n), st.integers(0, n)))


@settings(max_examples=300, deadline=None)
@given(TEXT, SIZES, st.sampled_from(["\n", " ", "\n\n", ". ", ""]))
def test_split_on_follows_the_merge_rule(text, sizes, separator):
    pieces = [p for p in (text.split(separator) if separator else text) if p]
    want = slow_merge(pieces, separator, *sizes) if pieces else []
    assert chunk.split_on(text, separator, *sizes) == want


@settings(max_examples=300, deadline=None)
@given(TEXT, SIZES, st.sampled_from([("\n\n", "\n", " ", ""), ("\n", " "), (" ", ""), ("",), ("aa", "")]))
def test_split_recursively_follows_the_rule(text, sizes, separators):
    assert chunk.split_recursively(text, separators, *sizes) == slow_recursive(text, separators, *sizes)


def texts(n=400):
    rng = random.Random(7)
    words = ["a", "bc", "déf", "x" * 30, "😀", ".", "\t"]
    out = ["", " ", "\n", "\n\n\n", "x" * 100, "ab " * 40, None]
    for _ in range(n):
        parts = [rng.choice(words) + rng.choice([" ", "\n", "  ", "", "\n\n"]) for _ in range(rng.randint(1, 40))]
        out.append("".join(parts))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "n int, text string").repartition(4).cache()
    df.count()
    return df


def run(rows, column):
    return {r["n"]: (r["text"], r["c"]) for r in rows.select("n", "text", column.alias("c")).collect()}


@pytest.mark.parametrize("size", [1, 7, 20])
def test_native_character_equals_python(rows, size):
    for separator in ("\n", " "):
        got = run(rows, chunk.character_chunks(F.col("text"), size, 0, separator))
        for text, chunks in got.values():
            assert chunks == (None if text is None else chunk.split_on(text, separator, size, 0))


@pytest.mark.parametrize("size", [1, 7, 20])
def test_native_recursive_equals_python(rows, size):
    for separators in (("\n", " ", ""), (" ", ""), (". ", "\n", ""), ("",)):
        got = run(rows, chunk.recursive_chunks(F.col("text"), size, 0, separators))
        for text, chunks in got.values():
            assert chunks == (None if text is None else chunk.split_recursively(text, separators, size, 0))


@pytest.mark.parametrize("size,overlap", [(10, 0), (10, 3), (1, 0), (25, 24)])
def test_windows(rows, size, overlap):
    plain = run(rows, chunk.window_chunks(F.col("text"), size, overlap))
    for text, chunks in plain.values():
        assert chunks == (None if text is None else chunk.split_windows(text, "", size, overlap))
    if size > 1:
        for separator in (" ", "\n\n"):
            got = run(rows, chunk.window_chunks(F.col("text"), size, overlap, separator))
            for text, chunks in got.values():
                assert chunks == (None if text is None else chunk.split_windows(text, separator, size, overlap))


def test_arrow_form_with_overlap(rows):
    got = run(rows, chunk.recursive_chunks(F.col("text"), 20, 8))
    for text, chunks in got.values():
        assert chunks == (None if text is None else slow_recursive(text, chunk.SEPARATORS, 20, 8) if text else [])
        assert all(len(c) <= 20 for c in chunks or [])


def test_no_text_is_lost_without_overlap(rows):
    for column in (chunk.recursive_chunks(F.col("text"), 15), chunk.character_chunks(F.col("text"), 15, 0, " ")):
        for text, chunks in run(rows, column).values():
            assert "".join((text or "").split()) == "".join("".join(chunks or []).split())


def test_hand_cases(spark):
    three = "Rain fell all night.\n\nThe river rose by dawn.\n\nBoats left before noon."
    cases = [
        (three, chunk.recursive_chunks(F.col("t"), 50), ["Rain fell all night.\n\nThe river rose by dawn.", "Boats left before noon."]),
        ("No blank line stands in here.", chunk.character_chunks(F.col("t"), 10), ["No blank line stands in here."]),
        ("aaa bbb ccc", chunk.character_chunks(F.col("t"), 7, 0, " "), ["aaa bbb", "ccc"]),
        ("aaa bbb ccc", chunk.character_chunks(F.col("t"), 7, 3, " "), ["aaa bbb", "bbb ccc"]),
        ("one red kite flew\ntwo grey owls sat\n\nsix tall elms grew\nten old oaks fell", chunk.recursive_chunks(F.col("t"), 20),
         ["one red kite flew", "two grey owls sat", "six tall elms grew", "ten old oaks fell"]),
        ("one red kite flew by us", chunk.recursive_chunks(F.col("t"), 20), ["one red kite flew by", "us"]),
        ("abcdefgh", chunk.window_chunks(F.col("t"), 4, 1), ["abcd", "defg", "gh"]),
        ("a b c", chunk.custom_chunks(F.col("t"), str.split), ["a", "b", "c"]),
    ]
    for text, column, want in cases:
        assert spark.createDataFrame([(text,)], "t string").select(column).first()[0] == want


def test_ids_and_metadata(spark):
    docs = spark.createDataFrame([("doc-1", "a b c", {"k": "v"}), ("doc-2", "", {})], "id string, content string, metadata map<string,string>")
    rows = chunk.explode_chunks(docs, chunk.window_chunks(F.col("content"), 2)).orderBy("id").collect()
    assert [(r["id"], r["content"], r["doc_id"], r["chunk_index"], r["metadata"]) for r in rows] == [
        ("doc-1_0", "a ", "doc-1", 0, {"k": "v"}),
        ("doc-1_1", "b ", "doc-1", 1, {"k": "v"}),
        ("doc-1_2", "c", "doc-1", 2, {"k": "v"}),
    ]


def test_sizes_are_checked(spark):
    for bad in ((10, 11), (0, 0), (5, -1)):
        with pytest.raises(ValueError):
            chunk.recursive_chunks(F.col("t"), *bad)
    with pytest.raises(ValueError):
        chunk.window_chunks(F.col("t"), 5, 5)


def test_chunker_by_metadata(spark):
    text = "aa bb cc"
    info = '{"chunk_size": 5, "separator": " "}'
    cases = [
        ({"chunker_name": "CharacterChunker", "chunker_information": info}, ["aa bb", "cc"]),
        ({"chunker_name": "recursivechunker", "chunker_information": '{"chunk_size": 3}'}, ["aa", "bb", "cc"]),
        ({"chunker_name": "customchunker", "chunker_information": "{}"}, ["AA BB CC"]),
        ({"chunker_name": "characterchunker", "chunker_information": None}, ["aa bb cc"]),
        ({"chunker_name": "markdownchunker"}, ["aa bb cc"]),
        ({}, ["aa bb cc"]),
    ]
    docs = spark.createDataFrame(
        [(str(i), text, meta) for i, (meta, _) in enumerate(cases)], "id string, content string, metadata map<string,string>"
    )
    got = chunk.chunk_by_metadata(docs, custom=lambda t: [t.upper()]).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("chunk_index", "content"))).alias("c")
    )
    found = {int(r["doc_id"]): [x["content"] for x in r["c"]] for r in got.collect()}
    assert found == {i: want for i, (_, want) in enumerate(cases)}
    with pytest.raises(PythonException):
        chunk.chunk_by_metadata(docs).collect()


def test_map_merge(spark):
    row = spark.range(1).select(
        maps.merge(
            F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("1")),
            F.lit(None).cast("map<string,string>"),
            F.create_map(F.lit("b"), F.lit("2")),
        ).alias("m"),
        maps.pick(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("1")), ["b", "z"]).alias("p"),
    ).first()
    assert row["m"] == {"a": "1", "b": "2"} and row["p"] == {"b": "1"}


def test_a_large_batch_is_taken_in_slices(monkeypatch):
    """What a function makes of the texts of one batch is handed over part by part."""
    monkeypatch.setattr(chunk.F, "arrow_udf", lambda kind: lambda run: run)
    texts = ["x" * 1_000_000] * 20 + [None, "", "y" * 9_000_000, "z"]
    for wrap in (chunk.texts_to_lists, chunk.texts_to_results):
        parts = list(wrap(lambda t: [t])(iter([pa.array(texts), pa.array(["a", None])])))
        found = [x["chunks"] if isinstance(x, dict) else x for part in parts for x in part.to_pylist()]
        assert found == [None if t is None else [t] for t in [*texts, "a", None]]
        assert max(part.nbytes for part in parts if len(part) > 1) < 5_000_000


def test_settings_of_a_chunker_reach_the_function_as_text(spark):
    """Spark measures a batch after each row, and goes through a column of null arrays from its start for that."""
    settings = '{"chunk_size":4,"chunk_overlap":null,"separators":["|","\\"",""]}'
    rows = [("a", "ab|cd", {"chunker_information": settings}), ("b", "ab|cd", {}), ("c", "ab|cd", {"chunker_information": "no"})]
    docs = spark.createDataFrame(rows, "id string, content string, metadata map<string,string>")
    for strict in (True, False):
        done = chunk.chunk_by_metadata(docs, strict=strict)
        plan = done._jdf.queryExecution().executedPlan().toString()
        calls = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
        assert calls and not any(".separators" in line for line in calls)
        got = sorted((r["doc_id"], r["content"]) for r in done.collect())
        assert got == [("a", "ab"), ("a", "|cd"), ("b", "ab|cd"), ("c", "ab|cd")]
