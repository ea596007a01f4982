import hashlib
import json
import os
import time
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docvec.functions import maps
from docvec.functions import text as tx
from docvec.sources import documents, files, jsondocs, tables


def write(root, name, content, at=None):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())
    if at is not None:
        os.utime(path, (at, at))
    return path


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(column).first()[0]


# ---------------------------------------------------------------- listings


@pytest.fixture(scope="module")
def bucket(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bucket"))
    write(root, "apple.txt", "x" * 100)
    write(root, "apron.pdf", "y" * 500)
    write(root, "deep/leaf.json", '{"tree": ["oak", 7], "root": {"depth": 2.5}}')
    write(root, "deeper/rows.csv", "id\n1\n")
    return root


def test_full_listing(spark, bucket):
    rows = {r["id"]: r for r in files.list_full(spark, bucket).collect()}
    assert sorted(rows) == ["apple.txt", "apron.pdf", "deep/leaf.json", "deeper/rows.csv"]
    assert rows["apron.pdf"]["size"] == 500 and rows["apron.pdf"]["type"] == "application/pdf"
    assert rows["apple.txt"]["name"] == "apple.txt" and rows["apple.txt"]["path"].endswith("/apple.txt")
    assert "T" in rows["apple.txt"]["metadata"]["last_modified"]


@pytest.mark.parametrize(
    "prefix,want", [("deep/", 1), ("deep", 2), ("ap", 2), ("deep/leaf", 1), ("", 4)]
)
def test_prefix(spark, bucket, prefix, want):
    assert files.list_full(spark, bucket, prefix).count() == want


@pytest.mark.parametrize(
    "glob,want",
    [("*.{csv,json}", {"a.csv", "b.json"}), ("part-[0-9]*", {"part-1.txt"}), ("part-[!0-9]*", {"part-x.txt"}),
     ("{a,{b,part-?}}.*", {"a.csv", "b.json", "part-1.txt", "part-x.txt"}), ("c\\[1].t*", {"c[1].txt"}), ("*", None)],
)
def test_globs_are_those_of_the_reader(spark, tmp_path, glob, want):
    names = {"a.csv", "b.json", "part-1.txt", "part-x.txt", "c[1].txt"}
    for name in names:
        write(str(tmp_path), name, "x")
    assert {r["id"] for r in files.list_full(spark, str(tmp_path), glob=glob).collect()} == (want or names)
    assert {r["id"] for r in files.read_content(spark, str(tmp_path), glob=glob).collect()} == (want or names)
    hidden = write(str(tmp_path), "_d/a.csv", "y")
    found = {r["id"] for r in files.read_content(spark, str(tmp_path), glob=glob).collect()}
    assert os.path.exists(hidden) and found - names == ({"_d/a.csv"} if not want or "a.csv" in want else set())


@pytest.mark.parametrize("glob", ["{a", "[a", "a\\"])
def test_broken_globs_are_errors(spark, tmp_path, glob):
    with pytest.raises(ValueError, match="glob"):
        files.list_full(spark, str(tmp_path), glob=glob)


def test_listing_does_not_read_content(spark, bucket):
    plan = files.list_full(spark, bucket)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_delta(spark, bucket):
    now = datetime.now(timezone.utc)
    assert files.list_delta(spark, bucket, now - timedelta(days=1)).count() == 4
    assert files.list_delta(spark, bucket, now + timedelta(days=1)).count() == 0
    assert files.list_delta(spark, bucket, None).count() == 4


def test_delta_is_strict(spark, tmp_path):
    at = int(time.time()) - 1000
    write(str(tmp_path), "a.txt", "a", at)
    when = datetime.fromtimestamp(at, timezone.utc)
    assert files.list_delta(spark, str(tmp_path), when).count() == 0
    assert files.list_delta(spark, str(tmp_path), when - timedelta(seconds=1)).count() == 1


def test_attributes(spark, bucket):
    row = files.file_attributes(spark, bucket, "deep/leaf.json").first()
    assert row["file_name"] == "deep/leaf.json" and row["file_size"] == 44
    with open(os.path.join(bucket, "deep/leaf.json"), "rb") as f:
        assert row["file_checksum"] == hashlib.md5(f.read()).hexdigest()
    assert row["file_type"] == "application/json"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.file_attributes(spark, bucket, "unknown").collect()


def test_content_below_a_prefix(spark, bucket):
    rows = files.read_content(spark, bucket, "s", prefix="deep/").collect()
    assert [(r["id"], bytes(r["content"])[:6]) for r in rows] == [("deep/leaf.json", b'{"tree')]
    later = files.read_content(spark, bucket).filter(F.col("last_modified") > datetime(2020, 1, 1))
    assert "PushedFilters: [IsNotNull(modificationTime), GreaterThan" in later._jdf.queryExecution().toString()


def test_extract(spark, bucket):
    both = [files.list_full(spark, bucket, "ap", "a"), files.list_full(spark, bucket, "deep", "b")]
    got = files.extract(both, "full").groupBy("source_name").count().collect()
    assert {r[0]: r[1] for r in got} == {"a": 2, "b": 2}
    assert files.extract(both, "delta", datetime.now(timezone.utc) + timedelta(days=1)).count() == 0
    with pytest.raises(ValueError, match="extract_type"):
        files.extract(both, "some")


# ---------------------------------------------------------------- CSV

PARTS = "id,part,price,bin\n1,Bolt M8,30,Shelf Nine\n2,Hex Nut,25,Lower Deck\n3,Flat Washer,40,Crate\n"


def test_csv(spark, tmp_path):
    path = write(str(tmp_path), "parts.csv", "﻿" + PARTS)
    rows = tables.csv_docs(spark, path).orderBy("id").collect()
    assert [r["id"] for r in rows] == ["1.id", "2.id", "3.id"]
    assert rows[0]["content"] == "id: 1\npart: Bolt M8\nprice: 30\nbin: Shelf Nine"
    assert [r["metadata"]["row"] for r in rows] == ["0", "1", "2"]
    assert rows[0]["metadata"]["source"].endswith("parts.csv")


def test_csv_selector_and_source_column(spark, tmp_path):
    path = write(str(tmp_path), "p.csv", PARTS)
    rows = tables.csv_docs(
        spark, path, to_embed=["bin", "part", "none"], to_metadata=["price", "none"], source_column="part"
    ).orderBy("id").collect()
    assert rows[1]["content"] == "bin: Lower Deck\npart: Hex Nut"
    assert rows[1]["metadata"] == {"price": "25", "source": "Hex Nut", "row": "1"}


def test_csv_options_short_rows_and_missing_id(spark, tmp_path):
    path = write(str(tmp_path), "p.csv", "k;v\n 'a;b' ; x \n'c'\n".replace(" '", "'").replace("' ", "'"))
    rows = tables.csv_docs(spark, path, sep=";", quote="'", unique_ids=True).orderBy("id").collect()
    assert [(r["id"], r["content"]) for r in rows] == [(".id_0", "k: a;b\nv: x"), (".id_1", "k: c\nv: ")]
    assert {r["id"] for r in tables.csv_docs(spark, path, sep=";", quote="'").collect()} == {".id"}


def test_row_numbers_of_split_files(spark, tmp_path):
    """Files cut into many blocks that several tasks read."""
    for name, n in (("a", 3000), ("b", 500), ("c", 1)):
        write(str(tmp_path), f"{name}.csv", "id,v\n" + "".join(f"{i},{'z' * (i % 50)}\n" for i in range(n)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        rows = tables.csv_docs(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(rows) == 3501
    assert all(r["metadata"]["row"] + ".id" == r["id"] for r in rows)


def test_other_header_is_an_error(spark, tmp_path):
    write(str(tmp_path), "a.csv", "id,v\n1,x\n")
    write(str(tmp_path), "b.csv", "id,w\n1,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.csv_docs(spark, str(tmp_path)).collect()


# ---------------------------------------------------------------- JSON


def leaves(spark, value, **options):
    df = spark.createDataFrame([(value if isinstance(value, str) else json.dumps(value),)], "content string")
    return [(r["id"], r["content"], r["metadata"]) for r in jsondocs.json_docs(df, **options).collect()]


NESTED = {"id": 7, "a": {"b": [1, True, None], "c": "x", "id": "in"}, "tags": ["p", {"q": 1.5}], "e": {}, "f": []}


def test_json_leaves(spark):
    assert [(i, c) for i, c, _ in leaves(spark, NESTED)] == [
        ("7.id", "7"), ("in.a.b", "1"), ("in.a.b", "true"), ("in.a.b", "null"), ("in.a.c", "x"), ("in.a.id", "in"),
        ("7.tags", "p"), ("tags.q", "1.5"),
    ]
    spelled = [c for _, c, _ in leaves(spark, NESTED, style="python")]
    assert spelled[2:4] == ["True", "None"]


def test_json_roots(spark):
    assert leaves(spark, [{"id": 1, "t": "x"}, {"t": "y"}]) == [("1.id", "1", {}), ("1.t", "x", {}), ("t", "y", {})]
    assert leaves(spark, "5") == [("", "5", {})]
    assert leaves(spark, [{"t": 1}, {"t": 2}], unique_ids=True) == [("t_0", "1", {}), ("t_1", "2", {})]
    deep = "[" * 500 + "1" + "]" * 500
    assert leaves(spark, deep) == [("", "1", {})]
    assert leaves(spark, '{"a": {"b": ' * 300 + "1" + "}}" * 300)[0][1] == "1"


def test_json_selector_needs_every_level(spark):
    assert [i for i, _, _ in leaves(spark, NESTED, to_embed=["a.c"])] == []
    assert [i for i, _, _ in leaves(spark, NESTED, to_embed=["a", "a.c"])] == ["in.a.c"]


def test_json_metadata_outer_wins_then_file(spark):
    value = {"k": "outer", "x": 1, "in": {"k": "inner", "y": [1, 2], "v": 1}}
    got = {i: m for i, _, m in leaves(spark, value, to_metadata=["k", "y"])}
    assert got["in.v"] == {"k": "outer", "y": "[1, 2]"} and got["x"] == {"k": "outer"}
    df = spark.createDataFrame([(json.dumps(value), {"k": "file"})], "content string, metadata map<string,string>")
    rows = jsondocs.json_docs(df, to_metadata=["k"]).collect()
    assert {r["metadata"]["k"] for r in rows} == {"file"}


def test_json_bad_and_missing(spark):
    df = spark.createDataFrame([("{",), (None,), ('{"a": 1}',)], "content string")
    assert [r["content"] for r in jsondocs.json_docs(df, strict=False).collect()] == ["1"]
    with pytest.raises(Exception, match="JSONDecodeError|Expecting"):
        jsondocs.json_docs(df).collect()


def test_json_files(spark, tmp_path):
    write(str(tmp_path), "a.json", '{"id": 1,\n "t": "x"}')
    rows = jsondocs.read_json_docs(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r["id"], r["content"]) for r in rows] == [("1.id", "1"), ("1.t", "x")]
    assert rows[0]["metadata"]["source"].endswith("a.json")


# ---------------------------------------------------------------- text


@pytest.mark.parametrize(
    "path,want",
    [("a/b.CSV", "csv"), ("x.tar.gz", "gz"), (".profile", "unknown"), ("a/.profile", "unknown"), ("a.b/c", "unknown"),
     ("name.", "unknown"), ("..a.b", "b"), ("", "unknown")],
)
def test_extension(spark, path, want):
    assert one(spark, tx.file_extension(F.col("p")), p=path) == want
    base, ext = os.path.splitext(path)
    assert want == (ext.lstrip(".").lower() or "unknown")


def test_small_text_functions(spark):
    assert one(spark, tx.flat_name(F.col("p")), p="a/b/c.txt") == "a_b_c.txt"
    assert one(spark, tx.file_stem(F.col("p")), p="a/b.c.txt") == "b.c"
    assert one(spark, tx.file_stem(F.col("p")), p=".profile") == ".profile"
    assert one(spark, tx.unquote(F.col("p")), p='"abc"') == "abc"
    assert one(spark, tx.fenced_code(F.col("p")), p="x ```python\ndef f(): pass\n``` y") == "def f(): pass\n"
    assert one(spark, tx.fenced_code(F.col("p")), p="none") is None
    assert one(spark, tx.strip(F.col("p")), p=" \t x y  \n\x1f") == "x y"
    assert one(spark, tx.token_count(F.col("p")), p="Hi, you!") == 4
    assert one(spark, tx.word_count(F.col("p")), p=" a b\n c ") == 3


@pytest.mark.parametrize("n", [0, 1, 750, 751, 1249, 1250, 3000])
def test_cut_words(spark, n):
    words = [f"w{i}" for i in range(n)]
    text = "  ".join(words)
    want = text if n <= 750 else " ".join(words[500:1250] if n >= 1250 else words[n - 750 :])
    assert one(spark, tx.cut_words(F.col("t")), t=text) == want


def test_html(spark):
    html = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style>
    <script type="x">var a = "</p>";</script></head><body><!-- no
    --><p class='a'>One<br/>two&nbsp;&#65;&#x42;&#0;&amp;lt;</p><ul><li>x <b>y</b></li><li>z</li></ul>1 < 2</body></html>"""
    want = "T & U\nOne\ntwo AB�&lt;\nx y\nz\n1 < 2"
    assert one(spark, tx.html_to_text(F.col("h")), h=html) == want


def test_markdown(spark):
    text = "# Title #\n\nSome *soft* and **hard** `code`, a [link](http://x) ![pic](p.png)\n\n> quoted\n\n- a\n2. b\n\n```py\nx = 1\n```\n---\nend"
    want = "Title\nSome soft and hard code, a link pic\nquoted\na\nb\nx = 1\nend"
    assert one(spark, tx.markdown_to_text(F.col("m")), m=text) == want


# ---------------------------------------------------------------- documents

FILES = "id string, path string, type string, metadata map<string,string>, content binary"


def as_files(spark, rows):
    return spark.createDataFrame([(i, f"/r/{i}", t, {"m": "1"}, c) for i, t, c in rows], FILES)


@pytest.mark.parametrize(
    "kind,want",
    [("text/csv", "csv"), ("string", "text"), ("application/octet-stream", "markdown"), ("text/html", "html"),
     ("application/pdf", "pages"), ("application/json", "json"), ("text/plain", "generic"), ("", "generic")],
)
def test_routes(spark, kind, want):
    assert one(spark, documents.route(F.col("t")), t=kind) == want


def test_auto(spark):
    rows = as_files(
        spark,
        [
            ("c", "csv", b"\xef\xbb\xbfid,v\n1, a \n2\n"),
            ("s", "string", "grüß".encode()),
            ("m", "application/octet-stream", b"# Head"),
            ("h", "html", b"<p>x</p>"),
            ("p", "pdf", b"one\ftwo"),
            ("j", "json", b'{"id": 3, "t": ["u", "v"]}'),
            ("g", "other", b"plain"),
        ],
    )
    got = {(r["file_id"], r["id"]): (r["content"], r["metadata"]) for r in documents.auto_docs(rows, unique_ids=True).collect()}
    text = {k: v[0] for k, v in got.items()}
    assert text == {
        ("c", "1.id_0"): "id: 1\nv: a", ("c", "2.id_1"): "id: 2\nv: ", ("s", "s_0"): "grüß", ("m", "m_0"): "Head",
        ("h", "h_0"): "x", ("p", "p_0"): "one", ("p", "p_1"): "two", ("j", "3.id_0"): "3", ("j", "3.t_1"): "u",
        ("j", "3.t_2"): "v", ("g", "g_0"): "plain",
    }
    assert got[("c", "2.id_1")][1] == {"row": "1", "source": "/r/c", documents.FILE_KEY: "c"}
    assert got[("p", "p_1")][1] == {"page": "1", "m": "1", documents.FILE_KEY: "p"}


def test_auto_records_errors(spark):
    rows = as_files(spark, [("j", "json", b"{"), ("t", "txt", b"\xff\xfe"), ("ok", "txt", b"fine"), ("e", "json", b"[]"), ("p", "pdf", b"bad")])

    def pages(content):
        raise ValueError("no parser")

    got = documents.auto_docs(rows, pages=pages, strict=False).collect()
    assert sorted((r["file_id"], r["content"], r["error"]) for r in got if r["error"]) == [
        ("j", None, "not valid JSON"), ("p", None, "not valid pages"), ("t", None, "not valid UTF-8"),
    ]
    assert [r["content"] for r in got if not r["error"]] == ["fine"]
    with pytest.raises(Exception):
        documents.auto_docs(rows).collect()


def test_pages(spark):
    rows = as_files(spark, [("manual", "pdf", b"1|2|3")])
    got = documents.page_docs(rows, lambda c: [f"Leaf number {p}" for p in c.decode().split("|")]).collect()
    assert [r["id"] for r in got] == ["manual"] * 3
    assert [r["content"] for r in got] == ["Leaf number 1", "Leaf number 2", "Leaf number 3"]
    assert [r["metadata"]["page"] for r in got] == ["0", "1", "2"]


def test_convert_and_images(spark):
    rows = spark.createDataFrame(
        [("1", "a/x.TXT", "plain <!-- image -->".encode()), ("2", "a/y.pdf", b"P"), ("3", "z.pdf", b"!"), ("4", "w.txt", b"\xff")],
        "id string, name string, content binary",
    )

    def convert(name, content):
        if content == b"!":
            raise ValueError("broken")
        images = [("picture", b"p1"), ("table", b"t1"), ("picture", b"p2")]
        return "A <!-- image --> B <!-- image --> C <!-- image -->", images

    got = {r["id"]: r for r in documents.conversion_status(documents.convert_batch(rows, convert)).collect()}
    assert got["1"]["markdown"] == "plain <!-- image -->" and got["1"]["filename"] == "a/x.TXT"
    assert got["2"]["markdown"] == "A picture-1.png B picture-2.png C <!-- image -->" and got["2"]["filename"] == "y"
    assert [(i["type"], i["filename"], i["image"]) for i in got["2"]["images"]] == [
        ("picture", "picture-1.png", "cDE="), ("table", "table-1.png", "dDE="), ("picture", "picture-2.png", "cDI="),
    ]
    assert got["3"]["error"] == "broken" and got["3"]["markdown"] is None and got["3"]["status"] == "FAILURE"
    assert got["4"]["error"] == "not valid UTF-8" and got["1"]["status"] == "SUCCESS"
    summary = documents.conversion_summary(documents.convert_batch(rows, convert)).first()
    assert tuple(summary) == ("SUCCESS", 4, 2)


def test_document_json(spark):
    df = spark.createDataFrame([("d-17", "snow on the pass", {"road": "B7"})], "id string, content string, metadata map<string,string>")
    text = df.select(documents.doc_to_json()).first()[0]
    assert json.loads(text) == {"id": "d-17", "content": "snow on the pass", "metadata": {"road": "B7"}}
    back = spark.createDataFrame([(text,)], "t string").select(documents.doc_from_json(F.col("t")).alias("d")).first()["d"]
    assert back.asDict() == {"id": "d-17", "content": "snow on the pass", "metadata": {"road": "B7"}}
    for bad in (None, "{"):
        with pytest.raises(Exception, match="no document|MALFORMED|Malformed"):
            spark.createDataFrame([(bad,)], "t string").select(documents.doc_from_json(F.col("t"))).collect()


def test_iso_json(spark):
    df = spark.sql("select named_struct('a', array(timestamp_ntz'2024-01-02 03:04:05'), 'b', date'2024-01-02') as v")
    assert df.select(documents.iso_json(F.col("v"))).first()[0] == '{"a":["2024-01-02T03:04:05.000000"],"b":"2024-01-02"}'


def test_object_metadata(spark):
    listed = spark.createDataFrame([("a", {"k": "1", "m": "1"}), ("b", {"k": "1"})], "id string, metadata map<string,string>")
    objects = spark.createDataFrame([("a", {"k": "2"})], "id string, metadata map<string,string>")
    got = {r["id"]: r["metadata"] for r in files.merge_object_metadata(listed, objects).collect()}
    assert got == {"a": {"k": "2", "m": "1"}, "b": {"k": "1"}}
    assert maps.EMPTY.startswith("cast")


def test_a_large_batch_of_cells_is_read_in_slices(monkeypatch):
    monkeypatch.setattr(jsondocs.F, "arrow_udf", lambda kind: lambda run: run)
    texts = [f"id,b\n{i},{'x' * 1_000_000}\n" for i in range(20)] + [None]
    parts = list(jsondocs.leaf_reader(lambda t: [(t[:9], t, {})], True, str)(iter([pa.array(texts)])))
    found = [[d["content"] for d in row["docs"]] for part in parts for row in part.to_pylist()]
    assert found == [[] if t is None else [t] for t in texts]
    assert max(part.nbytes for part in parts) < 5_000_000


def test_rows_of_leaves_do_not_carry_all_leaves_of_their_file(spark):
    """What goes through the explode beside a leaf has a bounded size, or a file costs the square of its leaves."""
    rows = [(str(i), f"/{i}.json", json.dumps({"events": [{"id": 10 * i + j} for j in range(3)]}).encode(), {}) for i in range(2)]
    found = spark.createDataFrame(rows, "id string, path string, content binary, metadata map<string,string>")
    docs = documents.auto_docs(found, by=documents.route_by_extension(F.col("path")), strict=False)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    generates = [line for line in plan.splitlines() if "Generate posexplode" in line]
    assert generates and not any("_loaded" in line.split("[", 1)[1] for line in generates)
    got = sorted((r["id"], r["content"], r["file_id"], r["position"], r["error"]) for r in docs.collect())
    assert got == sorted((f"{10 * i + j}.events.id", str(10 * i + j), str(i), j, None) for i in range(2) for j in range(3))
