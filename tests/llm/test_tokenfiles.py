import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docvec.llm import queries, tokenfiles

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 5, 1000, 70_000, 200_001])
def test_matrix_round_trip_and_lookups(n):
    r = np.random.default_rng(n)
    ids = r.integers(0, 300, n).astype(np.uint32)
    ids[ids == 7] = 4_000_000_000 if n > 1000 else 8
    shard = tokenfiles.in_memory(tokenfiles.build(ids, [None, 3], np.array([n // 2, n - n // 2])))
    assert (shard.ids() == ids).all() and shard.keys == [None, 3] and shard.lengths.tolist() == [n // 2, n - n // 2]
    for i in r.integers(0, n, 20) if n else []:
        assert shard.access(int(i)) == ids[i]
    for token in (0, 5, 8, 299, 4_000_000_000, 12345):
        at = np.flatnonzero(ids == token)
        assert shard.count(token) == len(at)
        assert shard.count(token, n // 3, n // 2) == ((at >= n // 3) & (at < n // 2)).sum()
        for k in range(0, len(at), max(1, len(at) // 5)):
            assert shard.occurrence(token, k) == at[k]
        with pytest.raises(IndexError):
            shard.occurrence(token, len(at))


def test_words_alone_give_the_library_ids():
    r = random.Random(1)
    alphabet = "ab'<|>end \n\t́\xa0\x85 ßİΣ1!é\x1c\x1f ​ 한À×÷"
    texts = ["", "  ", "<|endoftext|> <|ENDOFTEXT|>x<|startoftext|>", "İstanbul ΣΑΣ ς", "don't  x's\tn't", "ÀÉ, (abc) a×b"]
    texts += ["".join(r.choice(alphabet) for _ in range(40)) for _ in range(1500)]
    library = Tokenizer.from_file(PATH)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for kept in (600_000, 50):  # also when it has to forget
        ids, sizes = tokenfiles.tokenizer_encoder(PATH, kept)()(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_other_tokenizers_take_whole_texts():
    path, texts = public_tokenizers.path("byte_bpe_50k.json"), ["a  b", "", "x\n\ny <|endoftext|>"]
    ids, sizes = tokenfiles.tokenizer_encoder(path)()(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def brute(docs):
    library, start, result = Tokenizer.from_file(PATH), 0, {}
    for key, text in sorted(docs):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        result[key] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return result


def test_query_against_the_library(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op5_token_files(spark, sf).collect()}
    assert got == brute(docs)


def test_files_of_many_shards(spark):
    docs = [(i, "word " * (i % 7) + "tail") for i in range(200)] + [(500, None), (501, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    shards = tokenfiles.write(df, tokenfiles.tokenizer_encoder(PATH), end=1, shard_tokens=50).cache()
    rows = shards.orderBy("shard").collect()
    assert len(rows) > 8 and [r["shard"] for r in rows] == list(range(len(rows)))
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["tokens"] for r in rows]])[:-1].tolist()
    back = {r["key"]: (r["start"], r["ids"]) for r in tokenfiles.read(shards).collect()}
    assert {k: (s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, (s, ids) in back.items()} == brute(docs)
    ends = sorted(s + len(ids) - 1 for s, ids in back.values())
    places = tokenfiles.occurrences(shards, 1).collect()
    assert sorted(r["position"] for r in places) == ends and {r["key"] for r in places} == set(back)
    assert sum(r["n"] for r in tokenfiles.counts(shards, 1).collect()) == len(docs)


def test_edges(spark):
    encoder = tokenfiles.tokenizer_encoder(PATH)
    empty = spark.createDataFrame([], "doc_id long, text string, path string, shard int")
    assert tokenfiles.digests(tokenfiles.write(empty, encoder, end=1)).collect() == []
    rows = [(None, "a", "p", 1), (2, "b", "p", 1), (2, "b", "p", 1), (1, "long " * 300_000, "p", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string, shard int")
    got = sorted((r["start"], r["key"], r["n_tokens"]) for r in tokenfiles.digests(tokenfiles.write(df, encoder, end=1)).collect())
    assert got == [(0, None, 2), (2, 1, 300_001), (300_003, 2, 2), (300_005, 2, 2)]
