import random
import re


from docvec.llm import jaccard

SCHEMA = "doc_id long, text string, node long, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                up[top(a)] = top(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), key), key)
    return sorted((key, len(sets[i]), least[top(i)]) for i, (key, _) in enumerate(rows))


def found(spark, rows):
    return sorted(tuple(r) for r in jaccard.join(frame(spark, rows)).collect())


def family(r, words, n, edits):
    """Texts that differ from a common one in a few words."""
    base = [r.choice(words) for _ in range(60)]
    result = []
    for _ in range(n):
        own = list(base)
        for _ in range(r.randint(0, edits)):
            own[r.randrange(len(own))] = r.choice(words)
        result.append(" ".join(own))
    return result


def test_equals_brute_force(spark, monkeypatch):
    r = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    texts = [t for edits in (1, 2, 3, 4) for t in family(r, words, 30, edits)]
    passage = " ".join(r.choice(words) for _ in range(30))
    texts += [f"{passage} {' '.join(r.choice(words) for _ in range(r.randint(3, 40)))}" for _ in range(60)]  # a passage that many share
    texts += [" ".join(r.choice("ab") for _ in range(r.randint(0, 7))) for _ in range(60)]  # short ones
    texts += ["A b\tC d\u000be", "a B c D e", None, "", "  \n", "one", "One", "one two", "x " * 4000, "x " * 5000]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    want = brute(rows)
    assert found(spark, rows) == want
    monkeypatch.setattr(jaccard, "MEMBERS", 4)  # similar sets in many groups
    monkeypatch.setattr(jaccard, "PARTNERS", 2)
    monkeypatch.setattr(jaccard, "FLUSH", 500)
    assert found(spark, rows) == want


def test_copies_and_edges(spark):
    rows = [(100 - i, "the same text for all of these rows") for i in range(90)] + [(500, None), (501, "")]
    assert {x[1:] for x in found(spark, rows[:90])} == {(4, 11)}
    assert found(spark, rows)[-2:] == [(500, 0, 500), (501, 0, 501)]
    assert found(spark, []) == [] and found(spark, rows[90:]) == [(500, 0, 500), (501, 0, 501)]


def test_repeated_and_null_keys(spark):
    text = "a b c d e f g"
    got = jaccard.join(frame(spark, [(3, text), (3, text), (None, text), (None, "z")])).collect()
    assert sorted((r["component_id"] or 0) for r in got) == [0, 3, 3, 3]


def test_keep_one(spark):
    text = "a b c d e f g"
    df = frame(spark, [(3, text), (3, text), (5, text.upper()), (7, "other words"), (7, "other words"), (8, None), (9, "")])
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id < 8").collect()) == [(3, text), (7, "other words")]
    assert sorted(r["doc_id"] for r in kept.where("doc_id >= 8").collect()) == [8, 9]


def test_components(spark):
    r = random.Random(1)
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    extra = [(5000, 5001), (5001, 5000), (7, 7)]
    edges = path + star + extra
    r.shuffle(edges)
    got = {x["node"]: x["label"] for x in jaccard.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {k: got[k] for k in range(301)} == dict.fromkeys(range(301), got[0])
    assert {got[1000 + i] for i in range(400)} == {got[1000]} and got[5000] == got[5001]
    assert len({got[0], got[1000], got[5000]}) == 3 and 7 in got
