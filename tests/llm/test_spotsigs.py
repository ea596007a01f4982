import hashlib
import random

from docvec.llm import queries, spotsigs

SCHEMA = "doc_id long, text string, fingerprint string, n_chars int"


def sigs(text):
    return spotsigs.of_texts([text], spotsigs.anchor_hashes(), spotsigs.CHAIN)[0]


def brute(rows):
    """The contract, document by document."""
    ordered = sorted(((-(1 << 63) if k is None else k), t or "", k) for k, t in rows)
    result = []
    for i, (_, text, key) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + after[:quarter]
        result.append((
            key, len(text), hashlib.sha256(changed.encode()).hexdigest(), spotsigs.spelled(sigs(text)), spotsigs.spelled(sigs(changed)),
            spotsigs.jaccard(sigs(text), sigs(changed)), spotsigs.jaccard(sigs(text), sigs(after)),
        ))
    return sorted(result, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in spotsigs.stability(df.repartition(5)).collect()), key=str)


def test_equals_brute_force(spark):
    r = random.Random(9)
    words = ["the", "of", "und", "le", "río", "House", "garden,", "(tree)", "x1", "\n"]
    rows = [(3 * i, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(300)]
    rows += [(None, "null key the big house"), (10_000, None), (10_001, ""), (10_002, "z" * 50_000)]
    r.shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_edges(spark):
    assert found(spark, []) == []
    assert found(spark, [(5, "the one big text")]) == brute([(5, "the one big text")])
    same = [(1, "the big house"), (1, "the big house"), (2, "the big house")]
    got = found(spark, same)
    assert len(got) == 3 and len({g[3] for g in got}) == 1 and {g[6] for g in got} == {1.0}


def test_signatures():
    assert len(sigs("the big house of the old town")) == 3  # the+big+house, of+old+town, the+old+town
    assert len(sigs("menu home about")) == 1 and len(sigs("")) == 0 and len(sigs(" ,.! ")) == 0
    assert spotsigs.jaccard(sigs(""), sigs("")) == 1.0 and spotsigs.jaccard(sigs(""), sigs("x")) == 0.0
    assert (spotsigs.parsed(spotsigs.spelled(sigs("the big house of old towns"))) == sigs("the big house of old towns")).all()


def test_query_on_the_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op7_spotsigs(spark, sf).collect()), key=str)
    assert got == brute(docs)
    assert sum(g[5] for g in got) / len(got) > 0.5 > 0.2 > sum(g[6] for g in got) / len(got)


def test_near_pairs(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [r.choice(words) if k % 3 else "the" for k in range(90)]
        for _ in range(4):
            own = list(base)
            for _ in range(r.randint(0, 4)):
                own[r.randrange(90)] = r.choice(words)
            texts.append(" ".join(own))
    prints = sorted({spotsigs.spelled(sigs(t)) for t in [*texts, ""]})
    want = {
        (a, b): spotsigs.jaccard(spotsigs.parsed(a), spotsigs.parsed(b))
        for a in prints for b in prints if a < b and spotsigs.jaccard(spotsigs.parsed(a), spotsigs.parsed(b)) >= 0.8
    }
    df = spark.createDataFrame([(i, t, None, 1) for i, t in enumerate([*texts, *texts, None, ""])], SCHEMA)
    got = spotsigs.near_pairs(df.withColumn("fingerprint", spotsigs.fingerprint("text"))).collect()
    assert len(want) > 10 and {(x["a"], x["b"]): x["likeness"] for x in got} == want and len(got) == len(want)
    assert spotsigs.near_pairs(df.limit(0)).collect() == []
