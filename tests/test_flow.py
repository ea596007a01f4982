import dataclasses
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from docvec import cluster
from docvec.operators import chunk, embed, store
from docvec.plans import ingest
from docvec.sources import documents, files
from docvec.streaming import accounts
from docvec.streaming import ingest as streams

TEXT = "Alpha beta gamma.\n\nDelta epsilon zeta.\n\n" + "word " * 200


@pytest.fixture
def config(spark, tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "a.txt").write_text(TEXT)
    (root / "sub" / "b.html").write_text("<p>Solar panels on the roof</p>")
    (root / "bad.json").write_text("{")
    (root / "blank.txt").write_text(" \n")
    (root / "empty.txt").write_text("")
    return ingest.Config("p", "test", (ingest.Source("disk", str(root)),), cluster.scratch_path(spark, "table"))


def test_run_report_search_and_delete(spark, config):
    report = {r["file_id"]: r for r in ingest.run(spark, config).collect()}
    assert {k: r["status"] for k, r in report.items()} == {
        "a.txt": "completed", "sub/b.html": "completed", "bad.json": "failed", "blank.txt": "processing",
    }
    assert report["a.txt"]["vectors"] == len(chunk.split_recursively(TEXT, chunk.SEPARATORS, 500, 0))
    assert report["bad.json"]["error"] == "not valid JSON"
    hits = ingest.search_text(spark, config, "solar roof", 2).collect()
    assert hits[0]["id"] == "sub/b.html_0" and hits[0]["score"] > 0.5
    again = {r["file_id"]: r["vectors"] for r in ingest.run(spark, config).collect()}
    assert again == {k: r["vectors"] for k, r in report.items()}
    assert store.delete_file(spark, config.sink, "sub/b.html")
    assert {r["id"].split("_")[0] for r in ingest.stored_documents(spark, config, 100).collect()} == {"a.txt"}
    filtered = ingest.search_text(spark, config, "word", 5, [{"field": "file_id", "operator": "=", "value": "none"}])
    assert filtered.count() == 0


def test_last_of_equal_ids_stays(spark, tmp_path):
    for source, name, rows in (("b", "x.csv", "k,first"), ("a", "y.csv", "k,1,2"), ("a", "x.csv", "k,9")):
        (tmp_path / source).mkdir(exist_ok=True)
        (tmp_path / source / name).write_text("\n".join(rows.split(",")) + "\n")
    sources = tuple(ingest.Source(s, str(tmp_path / s)) for s in ("b", "a"))
    config = ingest.Config("p", "t", sources, cluster.scratch_path(spark, "last"))
    report = ingest.run(spark, config).collect()
    assert sorted((r["source_name"], r["file_id"], r["vectors"]) for r in report) == [
        ("a", "x.csv", 0), ("a", "y.csv", 1), ("b", "x.csv", 0),
    ]
    row = store.read_table(spark, config.sink).collect()
    assert [(r["id"], r["metadata"]["row"], r["file_id"]) for r in row] == [(".id_0", "1", "y.csv")]


def test_settings_reach_the_flow(spark, tmp_path):
    """Selectors, a parser by extension, object metadata, content and errors of single files."""
    root = tmp_path / "mix"
    root.mkdir()
    (root / "p.csv").write_text("no;part;bin\n7;Bolt;Shelf\n8;Nut;Deck\n")
    (root / "d.docx").write_bytes(b"one|two")
    (root / "q.docx").write_bytes(b"\xff")
    (root / "c.txt").write_text("aa bb cc")
    (root / "o.txt").write_text("overlap too large")
    (root / "m.txt").write_text("the model fails here")
    info = [("c.txt", {"chunker_name": "characterchunker", "chunker_information": '{"chunk_size": 5, "separator": " "}'}),
            ("o.txt", {"chunker_information": '{"chunk_size": 5, "chunk_overlap": 9}'})]
    objects = spark.createDataFrame(info, "id string, metadata map<string,string>")
    load = documents.Load(
        id_key="no", to_embed=("bin", "part"), to_metadata=("part",), source_column="bin", delimiter=";",
        parsers={"docx": lambda c: c.decode().split("|")}, unique_ids=True,
    )

    def model(texts):
        if any("fails" in t for t in texts):
            raise ValueError("no answer")
        return [[float(len(t)), 1.0] for t in texts]

    def ask(text):
        return embed.model_embedder(text, model, 2, strict=False)

    source = ingest.Source("disk", str(root), load=load, objects=objects)
    config = ingest.Config("p", "t", (source,), cluster.scratch_path(spark, "mix"), ask, keep_content=True)
    report = {r["file_id"]: (r["status"], r["vectors"], r["error"]) for r in ingest.run(spark, config, batch_id=1).collect()}
    assert report == {
        "p.csv": ("completed", 2, None), "d.docx": ("completed", 2, None), "c.txt": ("completed", 2, None),
        "q.docx": ("failed", 0, "not valid pages"), "m.txt": ("failed", 0, "not embedded"),
        "o.txt": ("failed", 0, "not chunked: chunk_overlap 9 is larger than chunk_size 5"),
    }
    rows = {r["id"]: r for r in store.read_table(spark, config.sink).collect()}
    assert rows["7.no_0_0"]["content"] == "bin: Shelf\npart: Bolt"
    assert rows["8.no_1_0"]["metadata"] == {"part": "Nut", "row": "1", "source": "Deck", documents.FILE_KEY: "p.csv"}
    assert [rows[f"d.docx_{i}_0"]["content"] for i in (0, 1)] == ["one", "two"]
    assert [rows[f"c.txt_0_{i}"]["content"] for i in (0, 1)] == ["aa bb", "cc"]

    def never(text):
        return F.raise_error(F.lit("asked again")).cast("array<float>")

    again = ingest.Config("p", "t", (source,), config.sink, never)
    assert {r["file_id"]: (r["status"], r["vectors"], r["error"]) for r in ingest.run(spark, again, batch_id=1).collect()} == report


def test_a_shorter_file_replaces_its_chunks(spark, tmp_path):
    root = tmp_path / "short"
    root.mkdir()
    (root / "a.txt").write_text("word " * 300)
    (root / "b.txt").write_text("other")
    config = ingest.Config("p", "t", (ingest.Source("d", str(root)),), cluster.scratch_path(spark, "short"), replace_files=True)
    ingest.run(spark, config)
    assert store.read_table(spark, config.sink).count() == 4
    (root / "a.txt").write_text("word")
    ingest.run(spark, config)
    assert sorted(r["id"] for r in store.read_table(spark, config.sink).collect()) == ["a.txt_0", "b.txt_0"]


def test_missing_folder_is_empty(spark, tmp_path):
    config = ingest.Config("p", "t", (ingest.Source("d", str(tmp_path), prefix="no/such/"),), cluster.scratch_path(spark, "none"))
    assert ingest.run(spark, config).collect() == []


HIDDEN = {"_notes.md": "of notes", ".x.txt": "a dot", "_d/deep one/y.txt": "in a folder", ".d/50%_z.txt": "percent", "plain.txt": "seen"}


def hidden_folder(tmp_path, name="in"):
    root = tmp_path / name
    for key, text in HIDDEN.items():
        (root / key).parent.mkdir(parents=True, exist_ok=True)
        (root / key).write_text(text)
    (root / "_empty.txt").write_text("")
    (root / "none.txt").write_text("")
    (root / "._notes.md.crc").write_bytes(b"crc\0")  # what Hadoop keeps beside a local file
    return str(root)


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_hidden_names_go_through_the_flow(spark, tmp_path, scheme):
    source = ingest.Source("d", scheme + hidden_folder(tmp_path))
    config = ingest.Config("p", "t", (source,), cluster.scratch_path(spark, "hidden"), keep_content=True)
    report = {r["file_id"]: (r["status"], r["vectors"]) for r in ingest.run(spark, config).collect()}
    assert report == dict.fromkeys(HIDDEN, ("completed", 1))
    stored = {r["file_id"]: r["content"] for r in store.read_table(spark, config.sink).collect()}
    assert stored == HIDDEN
    named = dataclasses.replace(config, sink=cluster.scratch_path(spark, "named"), empty_files=True)
    report = {r["file_id"]: (r["status"], r["vectors"]) for r in ingest.run(spark, named).collect()}
    assert report == dict.fromkeys(HIDDEN, ("completed", 1)) | dict.fromkeys(("_empty.txt", "none.txt"), ("processing", 0))


def test_hidden_names_in_a_store_only_hadoop_knows(spark, tmp_path):
    root = hidden_folder(tmp_path)
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.hidden.link./in", f"file://{root}")
    found = files.read_content(spark, "viewfs://hidden/in", empty=True).collect()
    assert {r["id"]: bytes(r["content"]).decode() for r in found} == HIDDEN | {"_empty.txt": "", "none.txt": ""}


def test_many_small_and_large_hidden_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "BATCH_BYTES", 1000)
    want = {f"_{i}.txt": f"{i}" * (1 + 400 * (i % 3)) for i in range(40)} | {"_empty.txt": ""}
    for name, text in want.items():
        (tmp_path / name).write_text(text)
    found = files.read_content(spark, str(tmp_path), empty=True, glob="_*")
    assert {r["id"]: bytes(r["content"]).decode() for r in found.repartition(1).collect()} == want
    assert found.where(F.col("last_modified") > datetime(2100, 1, 1)).count() == 0


def test_many_writes_are_few_scans(spark):
    path = cluster.scratch_path(spark, "many")
    rows = spark.range(3).select(F.col("id").cast("string").alias("id"), F.array(F.lit(1.0)).cast("array<float>").alias("vector"),
                                 F.expr("cast(map() as map<string,string>)").alias("metadata"), F.lit("f").alias("file_id"))
    for i in range(12):
        store.store(rows.withColumn("vector", F.array(F.lit(float(i))).cast("array<float>")), path)
    plan = store.read_table(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 5  # whatever the number of writes
    assert {r["vector"][0] for r in store.read_table(spark, path).collect()} == {11.0}


def test_folding_by_itself_and_two_writers(spark, monkeypatch):
    monkeypatch.setattr(store, "FOLD_AT", 3)
    path = cluster.scratch_path(spark, "fold")
    rows = spark.createDataFrame([("a", [1.0], {}, "f")], "id string, vector array<float>, metadata map<string,string>, file_id string")
    for _ in range(5):
        store.store(rows, path)
    assert len(store.committed(spark, path)) <= 3 and store.read_table(spark, path).count() == 1
    log = spark.read.schema(store.LOG).parquet(f"{path}/log")
    log.orderBy(F.desc("version")).limit(1).write.mode("append").parquet(f"{path}/log")
    with pytest.raises(RuntimeError, match="two writers"):
        store.read_table(spark, path)


def test_delta_and_earlier_is_full(spark, config):
    root = config.sources[0].root
    old = datetime.now(timezone.utc) - timedelta(days=2)
    os.utime(f"{root}/a.txt", (old.timestamp(), old.timestamp()))
    cut = datetime.now(timezone.utc) - timedelta(days=1)
    full = ingest.listed(spark, config)
    later = {r["id"] for r in ingest.listed(spark, config, "delta", cut).collect()}
    assert later | {"a.txt"} == {r["id"] for r in full.collect()} and "a.txt" not in later
    with pytest.raises(ValueError):
        ingest.listed(spark, config, "incremental")


def to_vectors(found):
    return ingest.to_store(ingest.vectors(found))


def test_stream_equals_batch_and_takes_new_files(spark, config, tmp_path):
    root = config.sources[0].root
    table, state = cluster.scratch_path(spark, "stream"), str(tmp_path / "state")

    def run():
        rows = streams.file_stream(spark, root, max_files=1)
        streams.ingest(rows, to_vectors, table, state, "chunk_index").awaitTermination()
        return {r["id"] for r in store.read_table(spark, table).select("id").collect()}

    want = {r["id"] for r in to_vectors(ingest.listed(spark, config)).select("id").collect()}
    assert run() == want and run() == want
    with open(f"{root}/late.txt", "w") as f:
        f.write("a late file")
    old = datetime.now().timestamp() - 100 * 86400
    os.utime(f"{root}/late.txt", (old, old))
    assert run() == want | {"late.txt_0"}


def test_usage_windows_batch(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 1, 5, m), "m", 10, 2.0 * m) for m in (1, 2)] + [(datetime(2024, 1, 1, 6, 0), "m", 1, 0.0)],
        "ts timestamp, model string, total_tokens int, latency_ms double",
    )
    got = sorted(tuple(r) for r in accounts.usage_by_window(rows).collect())
    assert got == [(datetime(2024, 1, 1, 5), "m", 2, 20, 3.0), (datetime(2024, 1, 1, 6), "m", 1, 1, 0.0)]


def test_chain_of_steps(spark):
    docs = documents.string_docs(spark.createDataFrame([(f"doc-00{i}", f"text {i}") for i in (1, 2, 3)], "id string, t string"), "id", "t")
    rows = embed.embed(chunk.explode_chunks(docs, chunk.recursive_chunks(F.col("content"))), embed.hash_embedder(F.col("content")))
    path = cluster.scratch_path(spark, "chain")
    assert store.store(documents.with_file_id(rows, F.col("doc_id")), path) == 3
    assert store.delete_file(spark, path, "doc-002")
    assert store.read_table(spark, path).count() == 2


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    assert df.columns == ["query_id", "id", "score", "rank"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 80


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        cluster.shared_dir(Session())
