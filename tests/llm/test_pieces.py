import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from docvec.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return pieces.Coder(MODEL)


def test_bpe_ids_are_those_of_the_library(coder):
    r = random.Random(1)
    alphabet = "abcdethon  \n\n\t▁éß한글😀'.,!?<s>123 　"
    texts = ["", "  ", "▁", " a", "<s></s>"] + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    texts.append(open(pieces.__file__).read())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids, sizes = coder.encode(texts)
    found = np.split(ids, np.cumsum(sizes)[:-1])
    assert [f.tolist() for f in found] == library.encode(texts)
    assert [coder.decode(f) for f in found] == [t.replace("▁", " ") for t in texts] == library.decode([f.tolist() for f in found])


def test_unigram_search_finds_the_best_sum(coder):
    """The same walk over scores of our own, against all spellings of each word."""
    r = random.Random(6)
    p = coder.pieces
    own = object.__new__(pieces.Pieces)
    own.__dict__.update(p.__dict__)
    names = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 4))) for _ in range(40)} | set("ab"))
    own.names, own.scores = names, [-r.random() * 9 - 1 for _ in names]
    own.id_of, own.bpe, own.worst, own.byte_id, own.unknown = {n: i for i, n in enumerate(names)}, False, -50.0, {}, 999
    own.grow()
    search = object.__new__(pieces.Coder)
    search.pieces, search.kept, search.neighbours = own, 100, {}
    search.forget()

    def best(word):
        sums = [0.0]
        for i in range(1, len(word) + 1):
            ends = [sums[i - len(n)] + s for n, s in zip(names, own.scores) if word[:i].endswith(n)]
            sums.append(max(ends, default=sums[i - 1] - 50.0))
        return sums[-1]

    words = sorted({"".join(r.choice("abcd") for _ in range(r.randint(1, 12))) for _ in range(500)})
    for word, ids in zip(words, search.walk(words)):
        assert abs(sum(-50.0 if i == 999 else own.scores[i] for i in ids) - best(word)) < 1e-9
        at = 0
        for i in ids:  # the ids spell the word
            assert i == 999 or word.startswith(names[i], at)
            at += 1 if i == 999 else len(names[i])
        assert at == len(word)


def test_forgetting_changes_nothing(coder):
    texts = [f"some words number {i} and {i * i}" for i in range(300)]
    small = pieces.Coder(MODEL, kept=20)
    found = [small.encode(texts[i : i + 10]) for i in range(0, 300, 10)]
    assert np.concatenate([x for x, _ in found]).tolist() == coder.encode(texts)[0].tolist()


def test_columns(spark):
    rows = [(1, None, "x", "y"), (2, "", "x", "y"), (3, "the house", "x", "y"), (3, "the house", "x", "y"), (4, "long word " * 50_000, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    coded = pieces.encode(df, MODEL)
    got = pieces.digests(pieces.decode(coded, MODEL)).orderBy("doc_id").collect()
    assert [r["decoded"] for r in got] == [r[1] for r in rows]
    assert got[0]["ids"] is None and got[1]["ids"] == [] and [r["n_tokens"] for r in got[:2]] == [0, 0]
    assert got[2]["ids"] == got[3]["ids"] and got[2]["ids_crc32"] == got[3]["ids_crc32"]
    assert pieces.encode(df.limit(0), MODEL).collect() == []


def test_query_round_trip(spark, sf):
    rows = queries.op3_sentencepiece(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(r["round_trip"] for r in rows)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {k: len(library.encode(t)) for k, t in texts.items()}
