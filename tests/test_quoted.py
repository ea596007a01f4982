import csv
import io
import random

import pytest

from docvec.sources import quoted, tables


def files_with_breaks(folder, n=12):
    """Files whose cells hold quotes, separators and line breaks of all kinds, with empty lines between rows."""
    r = random.Random(11)
    texts = ["plain", "", "a,b", 'say "x"', "two\nlines", "\r\nboth\n\n", '"', '""', "é\n" * 50, "x" * 300, ",\n\",\"\n", "\n" * 40]
    for i in range(n):
        out = io.StringIO(newline="")
        names = ["id", f"na\nme{i}" if i % 3 == 0 else f"name{i}", "text"]
        writer = csv.writer(out, lineterminator=r.choice(["\n", "\r\n"]), quoting=r.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        writer.writerow(names)
        for k in range(r.choice([0, 1, 40, 120])):
            row = [str(k), r.choice(texts), r.choice(texts)]
            writer.writerow(row[: r.choice([2, 3, 3, 3])] + ["more"] * (r.random() < 0.1))
            if r.random() < 0.1:
                out.write(r.choice(["\n", "\r\n"]))
        text = out.getvalue()
        if i % 4 == 1:
            text = text.rstrip("\r\n") if not text.endswith('"\n') else text[:-1]
        (folder / f"f{i}.csv").write_bytes(("﻿" if i % 5 == 0 else "").encode() + text.encode())
    (folder / "empty.csv").write_bytes(b"")


def whole(folder):
    """Each file by the parser from its first line on."""
    found = []
    for path in folder.glob("*.csv"):
        rows = csv.reader(io.StringIO(path.read_bytes().decode("utf-8-sig"), newline=""))
        names = next(rows, None)
        found += [(path.name, i, names, cells) for i, cells in enumerate(c for c in rows if c)]
    return sorted(found)


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 1 << 26])
def test_any_splits_give_the_rows_of_one_parser(spark, tmp_path, split):
    folder = tmp_path / "in"
    folder.mkdir()
    files_with_breaks(folder, 4 if split == 1 else 12)
    got = quoted.read_rows(spark, str(folder), "*.csv", split_bytes=split).collect()
    assert sorted((r["path"].rpartition("/")[2], r["row"], r["names"], r["cells"]) for r in got) == whole(folder)


def test_one_long_cell_over_many_splits(spark, tmp_path):
    cell = 'line "one"\n, and more\r\n' * 40_000
    (tmp_path / "a.csv").write_text("id,text\n1,\"" + cell.replace('"', '""') + "\"\n2,x\n", newline="")
    got = quoted.read_rows(spark, str(tmp_path), split_bytes=10_000)
    assert sorted((r["row"], r["cells"]) for r in got.collect()) == [(0, ["1", cell]), (1, ["2", "x"])]
    assert got.where("row = 1").count() == 1


def test_quotes_that_do_not_pair_up(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('id,text\n1,5" pipe\n2,x\n3,y\n')
    (tmp_path / "good.csv").write_text("id,text\n1,x\n")
    with pytest.raises(Exception, match="do not pair up"):
        quoted.read_rows(spark, str(tmp_path)).collect()
    got = {r["path"].rpartition("/")[2]: r["cells"] for r in quoted.read_rows(spark, str(tmp_path), strict=False).where("row IS NULL OR path LIKE '%good.csv'").collect()}
    assert got == {"bad.csv": None, "good.csv": ["1", "x"]}


def test_documents_as_from_plain_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;name;kind\n1; x ;k\n2;y;k\n")
    rows = quoted.read_rows(spark, str(tmp_path), sep=";", quote="'", split_bytes=5)
    for options in ({}, {"to_embed": ["kind", "id"], "to_metadata": ["name"]}, {"source_column": "kind", "unique_ids": True}, {"id_key": "none"}):
        a, b = (sorted((r["id"], r["content"], {k: v.removeprefix("file:") for k, v in r["metadata"].items()}) for r in df.collect())
                for df in (quoted.docs(rows, **options), tables.csv_docs(spark, str(tmp_path), sep=";", quote="'", **options)))
        assert a == b
    with pytest.raises(ValueError, match="several bytes"):
        quoted.read_rows(spark, str(tmp_path), encoding="UTF-16")


def test_rows_are_numbered_through_the_files_of_a_folder(spark, tmp_path):
    for folder, sizes in (("a", (3, 0, 40)), ("b", (2, 2))):
        (tmp_path / folder).mkdir()
        for i, n in enumerate(sizes):
            (tmp_path / folder / f"part-{i}.csv").write_text("id,text\n" + "".join(f'{i}-{k},"x\n{k}"\n' for k in range(n)))
    got = quoted.read_rows(spark, str(tmp_path), split_bytes=16, by_folder=True).collect()
    want = {("a", i, f"0-{i}") for i in range(3)} | {("a", 3 + i, f"2-{i}") for i in range(40)} | {("b", i, f"{i // 2}-{i % 2}") for i in range(4)}
    assert {(r["path"].split("/")[-2], r["row"], r["cells"][0]) for r in got} == want and len(got) == len(want)
