"""Words are told apart by their bytes: spans that a polynomial modulo a power of two cannot tell apart."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from docvec.llm import jaccard, kernels, pieces, spotsigs, tokenfiles


def twins(n):
    """The Thue-Morse word of ``n`` letters and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


LENGTHS = [512, 1024, 2048, 4096, 8192]


@pytest.mark.parametrize("alphabet", ["ab", "\0a", "aé"])
def test_hashes_and_comparison_of_spans(alphabet):
    r = random.Random(2)
    words = ["".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 2, 7, 8, 9, 16, 17, 255, 256, 257, 600]))) for _ in range(3000)]
    raw = "".join(words).encode()
    sizes = np.array([len(w.encode()) for w in words])
    stop = np.cumsum(sizes)
    begin = stop - sizes
    for hashes in (kernels.long_hashes(raw, begin, stop), np.zeros(len(words), np.uint64), sizes.astype(np.uint64)):
        code, first = kernels.distinct_spans(raw, begin, stop, hashes)
        seen = {}
        assert code.tolist() == [seen.setdefault(w, len(seen)) for w in words]
        assert [words[i] for i in first] == list(seen)
    assert len(set(kernels.long_hashes(raw, begin, stop).tolist())) == len(set(words))


def test_known_words_with_equal_hashes():
    known, raw = kernels.KnownWords(), b"aabbab"
    begin, stop = np.array([0, 2, 4]), np.array([2, 4, 6])
    known.add(raw, begin, stop, np.array([5, 5, 7], np.uint64))
    assert known.find(raw, begin, stop, np.array([5, 5, 7], np.uint64)).tolist() == [0, -1, 2]
    known.add(b"xx", np.array([0]), np.array([2]), np.array([5], np.uint64))
    assert known.count == 4 and known.find(b"xxaa", np.array([0, 2]), np.array([2, 4]), np.array([5, 5], np.uint64)).tolist() == [-1, 0]


def test_ids_of_twins_are_the_library_ids():
    texts = [w for n in LENGTHS for w in twins(n)]
    path = public_tokenizers.path("word_bpe_49k.json")
    library, encode = Tokenizer.from_file(path), tokenfiles.tokenizer_encoder(path)()
    model = public_tokenizers.path("piece_bpe_32k.model")
    processor, coder = sentencepiece.SentencePieceProcessor(model_file=model), pieces.Coder(model)
    for some in (texts, texts[::-1], texts[1::2]):  # in one batch, and remembered from an earlier one
        ids, sizes = encode(some)
        want = [e.ids for e in library.encode_batch(some, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
        ids, sizes = coder.encode(some)
        found = np.split(ids, np.cumsum(sizes)[:-1])
        assert [x.tolist() for x in found] == processor.encode(some) and [coder.decode(x) for x in found] == some


def test_ids_where_every_hash_is_equal(monkeypatch):
    """Even then each word has its own ids."""
    monkeypatch.setattr(tokenfiles, "span_hashes", lambda data, begin, stop: np.zeros(len(begin), np.uint64))
    monkeypatch.setattr(pieces, "long_hashes", lambda raw, begin, stop: np.zeros(len(begin), np.uint64))
    texts = ["some words, some more", "and others; words!", "", "some words"]
    path, model = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
    encode, coder = tokenfiles.tokenizer_encoder(path)(), pieces.Coder(model)
    for _ in range(2):
        ids, sizes = encode(texts)
        assert zlib.crc32(ids.tobytes()) == zlib.crc32(np.array([i for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False) for i in e.ids], np.uint32).tobytes())
        ids, sizes = coder.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == sentencepiece.SentencePieceProcessor(model_file=model).encode(texts)


def test_twins_have_shingles_and_signatures_of_their_own(spark):
    for n in LENGTHS:
        one, two = twins(n)
        a, b = kernels.shingle_sets([f"x y {one} z", f"x y {two} z"], 5)
        assert a.tolist() != b.tolist()
        same = [spotsigs.of_texts([f"the {w} house of words"], spotsigs.anchor_hashes(), 2)[0].tolist() for w in (one, two)]
        assert same[0] != same[1]
    one, two = twins(1024)
    df = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard.join(df).collect()} == {1: 1, 2: 2, 3: 1}
