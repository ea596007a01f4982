import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docvec.sources import files, objects
from docvec.streaming import ingest as streams


def put(root, name, text="x"):
    at = f"{root}/{name}"
    os.makedirs(os.path.dirname(at), exist_ok=True)
    with open(at, "w") as file:
        file.write(text)


@pytest.fixture
def tree(tmp_path):
    root = f"{tmp_path}/tree"
    names = ["_x.txt", ".x.txt", "a/b/c/d/e.txt", "_d/x.txt", ".h/y", "é/ü.txt", "none", "a/.x.txt.crc", "a/y.crc"]
    names += [f"big/{i}" for i in range(200)] + [f"big/sub{i}/{j}" for i in range(5) for j in range(30)] + [f"many/{i}/x" for i in range(90)]
    for n in names:
        put(root, n, "" if n == "none" else n)
    put(root, "a/sum.txt", "s")
    put(root, "a/.sum.txt.crc", "s")  # a checksum that Hadoop keeps
    return root


def names_below(root):
    found = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names]
    return Counter(os.path.relpath(f, root) for f in found if not f.endswith("/.sum.txt.crc"))


@pytest.mark.parametrize("splits, many, shares", [(1, 1000, 4), (8, 1000, 4), (64, 50, 4), (500, 10, 3)])
def test_the_units_of_a_plan_are_the_tree(tree, splits, many, shares):
    store = objects.Store(tree)
    units = store.plan(splits, many, shares)
    each = [[os.path.relpath(x.path, tree) for x in store.below([u])] for u in units]
    assert Counter(n for part in each for n in part) == names_below(tree)
    if many == 50:
        assert sum(u.folder.endswith("/big") for u in units) == shares and max(map(len, each)) < 150


@pytest.mark.parametrize("budget, many, shares, prefix", [(50_000, 20_000, 32, ""), (20, 50, 4, "file://"), (1, 1, 2, "")])
def test_a_walk_in_rounds_lists_every_file_once(spark, tree, budget, many, shares, prefix):
    found = objects.walk(spark, prefix + tree, budget, many, shares).collect()
    assert Counter(os.path.relpath(r["path"].removeprefix("file://"), tree) for r in found) == names_below(tree)
    assert all(r["path"].startswith(prefix + "/") and r["length"] == os.path.getsize(r["path"].removeprefix("file://")) for r in found)
    assert objects.walk(spark, f"{tree}/missing").count() == 0


def test_a_large_folder_takes_many_tasks(spark, tmp_path):
    for i in range(400):
        put(tmp_path, f"in/{i}.txt")
    rows = objects.walk(spark, f"{tmp_path}/in", many=100, shares=16)
    tasks = rows.groupBy(F.input_file_name()).count().collect()
    assert len(tasks) > 3 and max(r["count"] for r in tasks) < 200
    spark.dataSource.register(objects.Objects)
    source = spark.read.format(objects.FORMAT).option("many", "100").load(f"{tmp_path}/in")
    sizes = source.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 16 and sum(r["count"] for r in sizes) == 400
    assert source.orderBy("path").collect() == rows.orderBy("path").collect()


def runner(spark, root, tmp_path, **options):
    """Runs a stream to its end; gives what came in each micro-batch so far."""
    got = {}

    def run(fail_at=None):
        def take(batch, number):
            rows = [(r["id"], bytes(r["content"]).decode()) for r in batch.select("id", "content").collect()]
            if number == fail_at:
                raise RuntimeError("stopped")
            got[number] = sorted(rows)

        query = (
            streams.object_stream(spark, root, settle=0, **options).writeStream.foreachBatch(take)
            .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return [x for n in sorted(got) for x in got[n]]

    return run


def listed(spark, root):
    return sorted((r["id"], bytes(r["content"]).decode()) for r in files.read_content(spark, root, empty=True).collect())


def test_a_stream_equals_the_listing(spark, tmp_path):
    root = f"{tmp_path}/in"
    for n in ("_x.txt", ".x.txt", "_d/x.txt", "a/b.txt"):
        put(root, n, n)
    put(root, "empty", "")
    run = runner(spark, root, tmp_path, empty=True)
    assert sorted(run()) == listed(spark, root) and len(run()) == 5
    put(root, "late.txt", "late")
    os.utime(f"{root}/late.txt", (1, 1))
    put(tmp_path, "else/moved.txt", "moved")
    os.utime(f"{tmp_path}/else/moved.txt", (1, 1))
    os.rename(f"{tmp_path}/else", f"{root}/folder")  # the file itself does not change
    assert sorted(run()) == listed(spark, root) and len(run()) == 7
    put(root, "a/b.txt", "new text")
    assert [x for x in run() if x[0] == "a/b.txt"] == [("a/b.txt", "a/b.txt"), ("a/b.txt", "new text")]


def test_a_stopped_batch_is_replayed_as_it_was(spark, tmp_path):
    root = f"{tmp_path}/in"
    put(root, "one.txt", "1")
    run = runner(spark, root, tmp_path)
    run()
    put(root, "_two.txt", "2")
    with pytest.raises(Exception, match="stopped"):
        run(fail_at=1)
    put(root, "three.txt", "3")
    os.utime(f"{root}/three.txt", (1, 1))
    assert run()[:2] == [("one.txt", "1"), ("_two.txt", "2")]
    assert run() == [("one.txt", "1"), ("_two.txt", "2"), ("three.txt", "3")]  # not in the batch that was planned without it


def test_a_stream_with_a_limit_of_age(spark, tmp_path):
    root = f"{tmp_path}/in"
    put(root, "one.txt", "1")
    run = runner(spark, root, tmp_path, late="1 hour", glob="*.txt")
    assert run() == [("one.txt", "1")]
    put(root, "two.txt", "2")
    put(root, "two.csv", "2")
    assert run() == [("one.txt", "1"), ("two.txt", "2")] == run()


def test_s3_by_the_settings_of_hadoop(spark):
    settings = {"fs.s3a.access.key": "k", "fs.s3a.secret.key": "s", "fs.s3a.endpoint": "host:9000", "fs.s3a.endpoint.region": "eu-west-1",
                "fs.s3a.connection.ssl.enabled": "false"}
    options = objects.s3_options(settings)
    assert options == {"access_key": "k", "secret_key": "s", "endpoint_override": "host:9000", "region": "eu-west-1", "scheme": "http"}
    store = objects.Store("s3a://bucket/some/folder/", options)
    assert (store.files.type_name, store.base, store.scheme) == ("s3", "bucket/some/folder", "s3a://")
    assert objects.s3_options({objects.S3_PROVIDER: "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"}) == {"anonymous": True}
    assert objects.Store.of(spark, "viewfs://only-hadoop/x") is None
    with pytest.raises(ValueError, match="cannot list"):
        objects.stream(spark, "viewfs://only-hadoop/x")


def test_many_folders_are_few_tasks(tree):
    reader = objects.ObjectReader({"path": tree, "splits": "8"})
    tasks = reader.partitions()
    assert len(tasks) == 8
    found = Counter(os.path.relpath(path, tree) for t in tasks for batch in reader.read(t) for path in batch.column("path").to_pylist())
    assert found == names_below(tree)
