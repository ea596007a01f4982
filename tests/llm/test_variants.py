import random
import re
import zlib
from collections import Counter

import pytest

from docvec.llm import queries, variants


def brute_counts(docs, least_length=6, least_count=5):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def at_one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1 :]


def near_words(counts):
    """Neighbours by all words in place of each other, or by all deletions where words are many."""
    near = {w: set() for w in counts}
    holes = {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    for short, words in holes.items():
        group = words | ({short} if short in counts else set())
        for a in group:
            near[a] |= {b for b in group if at_one_edit(a, b)}
    return near


def brute(counts, near):
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def words_table(spark, counts):
    rows = [(i, w, counts[w]) for i, w in enumerate(sorted(counts))]
    return spark.createDataFrame(rows, "id long, word string, n long").repartition(4)


@pytest.mark.parametrize("long", [64, 3])
def test_neighbours_against_all_pairs(spark, long, monkeypatch):
    """Few letters, so words have many neighbours and runs of equal letters; also with remainders in place of texts."""
    monkeypatch.setattr(variants, "LONG", long)
    r = random.Random(5)
    counts = {"".join(r.choice("aabé÷") for _ in range(r.randint(2, 7))): r.randint(1, 60) for _ in range(700)}
    table = words_table(spark, counts)
    word = {r["id"]: r["word"] for r in table.collect()}
    got = [(word[r["id"]], word[r["near"]], r["near_n"]) for r in variants.neighbours(table).collect()]
    want = {(a, b, counts[b]) for a in counts for b in counts if at_one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == want
    assert {tuple(r) for r in variants.group(table).collect()} == brute(counts, near_words(counts))


def test_chains_lead_to_their_end(spark):
    counts = {"a" * k: 5 ** (30 - k) for k in range(6, 27)}
    got = {r["word"]: (r["form"], r["root"]) for r in variants.group(words_table(spark, counts)).collect()}
    assert got == {"a" * k: ("a" * (k - 1) if k > 6 else None, "a" * 6) for k in range(6, 27)}


def test_ties_go_to_the_smallest_word_in_code_point_order(spark):
    counts = {"wordßs": 50, "wordzs": 50, "wordas": 5, "wordàs": 50}
    got = {r["word"]: r["form"] for r in variants.group(words_table(spark, counts)).collect()}
    assert got["wordas"] == "wordzs" and got["wordzs"] is None


def test_counts_against_brute_force(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice(["Straße", "ÉCOLE", "Écoles", "naïveté", "don't", "x÷yz×ab", "plural", "plurals"]) for _ in range(r.randint(0, 60))) for _ in range(400)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "plural " * 9), (3, texts[3]), (4, None), (5, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS word").repartition(5)
    got = variants.word_counts(df).orderBy("id").collect()
    assert {r["word"]: r["n"] for r in got} == brute_counts(docs)
    assert [r["word"] for r in got] == sorted(r["word"] for r in got)
    counts = brute_counts(docs)
    assert {tuple(r) for r in variants.group(variants.word_counts(df)).collect()} == brute(counts, near_words(counts))


def test_very_long_words_and_no_words(spark):
    long = "a" * 50_000
    docs = [(i, f"{long}b {long} short") for i in range(6)] + [(9, "word " * 500_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {len(r["word"]): (r["n_near"], r["form"]) for r in variants.group(variants.word_counts(df)).collect()}
    assert got == {50_000: (1, None), 50_001: (1, None)}
    assert variants.group(variants.word_counts(df.limit(0))).collect() == []


def test_parts_do_not_end_in_a_run():
    text = "abc déf  ghi" * 50
    for size in (1, 5, 17, 10_000):
        cut = list(variants.parts(text, size))
        assert "".join(cut) == text and [w for p in cut for w in variants.RUN.findall(p)] == variants.RUN.findall(text)


def test_query_against_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    counts = brute_counts(docs)
    assert {tuple(r) for r in queries.op13_spelling_variants(spark, sf).collect()} == brute(counts, near_words(counts))
