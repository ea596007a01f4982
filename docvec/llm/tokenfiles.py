"""Token ids in binary files: one wavelet matrix per shard.

A shard holds the ids of consecutive documents as bit-planes, one per bit of the largest id,
each in blocks that are compressed on their own. Ranks at block borders make access, counting
and occurrence lookup possible from the file as it is, touching a block per plane.
"""

import io
import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.cluster import scratch_path, written
from docvec.llm.kernels import HASH_STEP, IS_SPACE, LOWER, STEP, KnownWords, distinct_spans, slices, span_hashes, utf8

MAGIC = b"WAVELET1"
HEADER = "<8sQQQQQ"  # magic, tokens, documents, different ids, planes, bits of a block
BLOCK_BITS = 1 << 16
# Tokens after which a shard ends with the document it is in.
SHARD_TOKENS = 1 << 22
# Distinct pieces of text whose ids a task remembers; beyond them it starts anew.
WORDS_KEPT = 600_000

Encoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def packed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def build(ids: np.ndarray, keys: list, lengths: np.ndarray) -> bytes:
    """The file of a shard: the ids of all its documents, the documents' keys and lengths.

    A key is an integer or null; ids are below 2**32. The planes hold the numbers of the ids
    among those the shard uses, so a shard of few different ids has few planes.
    """
    if len(ids) and int(ids.max()) < 1 << 24:
        used = np.flatnonzero(np.bincount(ids)).astype("<u4")
        numbers = np.zeros(int(used[-1]) + 1, np.uint32)
        numbers[used] = np.arange(len(used))
        now = numbers[ids]
    else:
        used, now = np.unique(ids.astype("<u4"), return_inverse=True)
    planes = max(1, (len(used) - 1).bit_length()) if len(ids) else 1
    now = now.astype(np.uint16 if planes <= 16 else np.uint32)
    zeros, sections = [], []
    for plane in range(planes):
        bits = (now >> now.dtype.type(planes - 1 - plane)) & now.dtype.type(1) != 0
        raw = np.packbits(bits, bitorder="little")
        step = BLOCK_BITS // 8
        blocks = [packed(raw[a : a + step].tobytes()) for a in range(0, len(raw), step)]
        ones = np.add.reduceat(bits, np.arange(0, len(bits), BLOCK_BITS), dtype=np.uint64) if len(bits) else np.empty(0, np.uint64)
        before = np.concatenate([[0], np.cumsum(ones)]).astype("<u8")
        places = np.cumsum([0, *map(len, blocks)]).astype("<u8")
        sections.append(b"".join([before.tobytes(), places.tobytes(), *blocks]))
        zeros.append(len(bits) - int(before[-1]))
        now = np.concatenate([np.compress(~bits, now), np.compress(bits, now)])
    known = np.array([k is not None for k in keys], dtype=bool)
    values = np.array([0 if k is None else k for k in keys], dtype="<i8")
    documents = packed(values.tobytes() + np.asarray(lengths, "<u8").tobytes() + used.tobytes() + np.packbits(known).tobytes())
    sizes = np.array([len(documents), *map(len, sections)], dtype="<u8")
    head = struct.pack(HEADER, MAGIC, len(ids), len(keys), len(used), planes, BLOCK_BITS)
    return b"".join([head, np.array(zeros, "<u8").tobytes(), sizes.tobytes(), documents, *sections])


class Shard:
    """A shard's file. Positions and counts are of ids; all lookups read only the blocks they need."""

    def __init__(self, file):
        self.file = file
        magic, self.tokens, self.documents, different, self.planes, self.block = struct.unpack(HEADER, self.read(0, struct.calcsize(HEADER)))
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        table = np.frombuffer(self.read(struct.calcsize(HEADER), 8 * (2 * self.planes + 1)), "<u8").astype(np.int64)
        self.zeros, sizes = table[: self.planes], table[self.planes :]
        begin = struct.calcsize(HEADER) + 8 * len(table)
        self.sections = begin + np.cumsum(sizes) - sizes
        self.blocks = -(-self.tokens // self.block)
        data = unpacked(self.read(begin, int(sizes[0])))
        n = self.documents
        self.used = np.frombuffer(data, "<u4", different, offset=16 * n)
        known = np.unpackbits(np.frombuffer(data, np.uint8, offset=16 * n + 4 * different), count=n).astype(bool)
        self.keys = [k if ok else None for k, ok in zip(np.frombuffer(data, "<i8", n).tolist(), known.tolist(), strict=True)]
        self.lengths = np.frombuffer(data, "<u8", n, offset=8 * n).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.index: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.held: dict[tuple[int, int], np.ndarray] = {}

    @classmethod
    def open(cls, path: str) -> "Shard":
        store, name = fs.FileSystem.from_uri(path)
        return cls(store.open_input_file(name))

    def read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def ranks(self, plane: int) -> tuple[np.ndarray, np.ndarray]:
        """Ones before each block of a plane, and where its blocks lie."""
        if plane not in self.index:
            at, n = int(self.sections[plane + 1]), self.blocks + 1
            both = np.frombuffer(self.read(at, 16 * n), "<u8").astype(np.int64)
            self.index[plane] = both[:n], both[n:] + at + 16 * n
        return self.index[plane]

    def bits(self, plane: int, block: int) -> np.ndarray:
        if (plane, block) not in self.held:
            places = self.ranks(plane)[1]
            raw = unpacked(self.read(int(places[block]), int(places[block + 1] - places[block])))
            count = min(self.block, self.tokens - block * self.block)
            if len(self.held) >= 4 * self.planes:
                self.held.clear()
            self.held[plane, block] = np.unpackbits(np.frombuffer(raw, np.uint8), count=count, bitorder="little")
        return self.held[plane, block]

    def rank1(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, rest = divmod(i, self.block)
        before = int(self.ranks(plane)[0][block])
        return before + int(self.bits(plane, block)[:rest].sum()) if rest else before

    def select(self, plane: int, bit: int, k: int) -> int:
        """Where the ``k``-th bit of this value lies in a plane, from 0."""
        ones = self.ranks(plane)[0]
        counts = ones if bit else np.minimum(np.arange(self.blocks + 1) * self.block, self.tokens) - ones
        block = int(np.searchsorted(counts, k, side="right")) - 1
        return block * self.block + int(np.flatnonzero(self.bits(plane, block) == bit)[k - int(counts[block])])

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        value = 0
        for plane in range(self.planes):
            bit = int(self.bits(plane, i // self.block)[i % self.block])
            ones = self.rank1(plane, i)
            i = int(self.zeros[plane]) + ones if bit else i - ones
            value = value << 1 | bit
        return int(self.used[value])

    def number(self, token: int) -> int:
        """The number of an id among the shard's ids, or -1."""
        k = int(np.searchsorted(self.used, token))
        return k if k < len(self.used) and int(self.used[k]) == token else -1

    def span(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of an id among positions ``low`` to ``high`` end up below the last plane."""
        number = self.number(token)
        if number < 0:
            return 0, 0
        for plane in range(self.planes):
            a, b = self.rank1(plane, low), self.rank1(plane, high)
            if number >> (self.planes - 1 - plane) & 1:
                low, high = int(self.zeros[plane]) + a, int(self.zeros[plane]) + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of an id among the positions from ``low`` to before ``high``."""
        a, b = self.span(token, low, self.tokens if high is None else high)
        return b - a

    def occurrence(self, token: int, k: int) -> int:
        """The position of the ``k``-th occurrence of an id, from 0."""
        low, high = self.span(token, 0, self.tokens)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at, number = low + k, self.number(token)
        for plane in range(self.planes - 1, -1, -1):
            bit = number >> (self.planes - 1 - plane) & 1
            at = self.select(plane, bit, at - int(self.zeros[plane]) if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids in order, put together from the last plane to the first."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        values = np.zeros(self.tokens, dtype=kind)
        for plane in range(self.planes - 1, -1, -1):
            raw = [unpacked(x) for x in self.plane_blocks(plane)]
            bits = np.unpackbits(np.frombuffer(b"".join(raw), np.uint8), count=self.tokens, bitorder="little").astype(bool)
            upper, zeros = np.empty_like(values), int(self.zeros[plane])
            upper[np.flatnonzero(~bits)] = values[:zeros]
            upper[np.flatnonzero(bits)] = values[zeros:] | kind(1 << (self.planes - 1 - plane))
            values = upper
        return self.used[values] if self.tokens else np.empty(0, "<u4")

    def plane_blocks(self, plane: int) -> Iterator[bytes]:
        places = self.ranks(plane)[1].tolist()
        data = self.read(places[0], places[-1] - places[0])
        for a, b in zip(places[:-1], places[1:], strict=True):
            yield data[a - places[0] : b - places[0]]


# How a tokenizer has to be set up so that its words can be remembered. It then
# drops white space and treats every run of other characters alone.
WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "suffix": "</w>",
}
# Bytes by class: 1 letters and 2 marks that this set-up spells in the plainest way, 0 white
# space, 3 all else. No apostrophe is plain, and no "<", with which reserved strings begin.
SPACE, LETTER, MARK, ODD = range(4)
CLASS = np.full(256, ODD, dtype=np.uint8)
CLASS[[32, 9, 10, 11, 12, 13]] = SPACE
CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<"]] = MARK
CLASS[[b for b in range(65, 123) if chr(b).isalpha()]] = LETTER
CLASS[0xC3] = LETTER  # with the byte after it one of U+00C0 to U+00FF


def pieces(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the pieces of ``raw`` begin and end, their hashes, and which are odd.

    A piece is a run of plain letters or of plain marks in a word of these alone, or else a whole,
    odd word.
    """
    found, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + HASH_STEP)
        while end < len(raw) and not IS_SPACE[raw[end]]:
            end += 1
        data = np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at)
        kind = CLASS[data]
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        after = after[(data[after] != 0x97) & (data[after] != 0xB7)]  # the signs of times and division
        kind[after] = LETTER
        space = np.ones(len(data) + 2, dtype=bool)
        space[1:-1] = kind == SPACE
        edges = np.flatnonzero(space[1:] != space[:-1])
        begin, stop = edges[0::2], edges[1::2]
        if len(begin):
            odd = np.flatnonzero(kind == ODD)
            strange = np.searchsorted(odd, stop) > np.searchsorted(odd, begin)
            cuts = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] != SPACE) & (kind[:-1] != SPACE)) + 1
            if strange.any():
                cuts = cuts[~strange[np.searchsorted(begin, cuts, side="right") - 1]]
            owner = begin
            begin, stop = np.sort(np.concatenate([begin, cuts])), np.sort(np.concatenate([stop, cuts]))
            strange = strange[np.searchsorted(owner, begin, side="right") - 1]
            found.append((begin + at, stop + at, span_hashes(data, begin, stop), strange))
        at = end
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def byte_letters() -> dict[int, int]:
    """The character that byte-level vocabularies use for each byte: itself if printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(rest)}


class WordEncoder:
    """Encodes each distinct piece once with the tokenizers library and puts texts together from them."""

    def __init__(self, tokenizer, kept: int):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.kept = tokenizer, kept
        # The same model without normalizer and patterns, for pieces that need neither.
        self.bare = Tokenizer(tokenizer.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        size = tokenizer.get_vocab_size()
        self.ends = np.array([(tokenizer.id_to_token(i) or "").endswith(WORDWISE["suffix"]) for i in range(size)])
        self.letters = byte_letters()
        self.forget()

    def forget(self) -> None:
        self.known = KnownWords()
        self.flat, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)  # ids of all known pieces, where each begins

    def plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        spelled = b"\0".join(words).decode().lower().encode().decode("latin-1").translate(self.letters | {0: 32})
        ids = np.array(self.bare.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, np.uint32)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):
            raise ValueError("the tokenizer does not close every word")
        return ids, np.diff(cuts, prepend=0)

    def learn(self, words: list[bytes], odd: np.ndarray) -> None:
        """Ids of new words, all plain ones before the odd ones."""
        first = len(words) - int(odd.sum())
        ids, sizes = self.plain(words[:first])
        other = self.tokenizer.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in words[first:]], add_special_tokens=False)
        rest = [np.array(e.ids, np.uint32) for e in other]
        self.flat = np.concatenate([self.flat, ids, *rest])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([*sizes.tolist(), *map(len, rest)], dtype=np.int64)])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [utf8(t) for t in texts]
        bounds = np.cumsum([0, *[len(r) + 1 for r in raw]])
        joined = b"\n".join(raw)
        if b"<|" not in joined:  # reserved strings count as they are written, all else in lower case
            joined = joined.translate(LOWER)
        begin, stop, hashes, odd = pieces(joined)
        code, first = distinct_spans(joined, begin, stop, hashes)
        if self.known.count > self.kept:
            self.forget()
        number = self.known.find(joined, begin[first], stop[first], hashes[first])
        new = np.flatnonzero(number < 0)
        if len(new):
            new = new[np.argsort(odd[first[new]], kind="stable")]
            spots = first[new]
            number[new] = np.arange(self.known.count, self.known.count + len(new))
            self.known.add(joined, begin[spots], stop[spots], hashes[spots])
            words = [joined[a:b] for a, b in zip(begin[spots].tolist(), stop[spots].tolist(), strict=True)]
            self.learn(words, odd[spots])
        number = number[code]
        size = (self.starts[1:] - self.starts[:-1])[number]
        ends = np.cumsum(size)
        place = np.repeat(self.starts[number] - (ends - size), size)
        place += np.arange(len(place))
        return self.flat[place], np.diff(np.concatenate([[0], ends])[np.searchsorted(begin, bounds)])


def tokenizer_encoder(path: str, kept: int = WORDS_KEPT) -> Callable[[], Encoder]:
    """Encodes texts with a file of the tokenizers library, as ``encode(text, add_special_tokens=False)`` does.

    If the tokenizer treats words alone, each distinct word is encoded once and remembered, up to
    ``kept`` of them; otherwise whole texts are encoded.
    """

    def make() -> Encoder:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        spec = json.loads(tokenizer.to_str())
        pattern = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        own = {"normalizer": spec["normalizer"], "pattern": pattern, "suffix": spec["model"].get("end_of_word_suffix")}
        if own == WORDWISE:
            return WordEncoder(tokenizer, kept)

        def whole(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum())), sizes

        return whole

    return make


def write(df: DataFrame, encoder: Callable[[], Encoder], end: int, text: str = "text", key: str = "doc_id", folder: str | None = None,
          shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the ids of all texts in ascending order of an integer key; one row per shard file.

    The texts are dealt out and sorted by key (null first, equal keys by the text's hash), and
    each task writes shards one after the other. Null is an empty text; every document ends with
    the id ``end``. The result (``shard`` counts from 0 in order of the keys, ``path``,
    ``documents``, ``tokens``, ``start``: ids before the shard) is itself a written table, so
    files of attempts that failed stay unnamed and unread. A shard holds whole documents.
    """
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "shards")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(F.asc_nulls_first("key")).sortWithinPartitions(F.asc_nulls_first("key"), F.xxhash64("text"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(), TaskContext.get().partitionId()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        held: list[np.ndarray] = []
        keys: list = []
        lengths: list[np.ndarray] = []
        state = {"tokens": 0, "seq": 0}

        def flush() -> pa.RecordBatch:
            name = f"shard-{part:06d}-{state['seq']:06d}-{uuid.uuid4().hex}.wavelet"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(build(np.concatenate([*held, np.empty(0, np.uint32)]), keys, np.concatenate(lengths)))
            row = {"part": part, "seq": state["seq"], "path": f"{folder}/{name}", "documents": len(keys), "tokens": state["tokens"]}
            held.clear(), keys.clear(), lengths.clear()
            state.update(tokens=0, seq=state["seq"] + 1)
            return pa.RecordBatch.from_pylist([row], schema=MANIFEST)

        for batch in batches:
            names = batch.column("key").to_pylist()
            for begin, texts in slices(batch.column("text"), min(STEP, 2 * shard_tokens)):
                ids, sizes = encode(texts)
                ends = np.cumsum(sizes)
                held.append(np.insert(ids, ends, end).astype(np.uint32))
                keys += names[begin : begin + len(texts)]
                lengths.append(sizes + 1)
                state["tokens"] += len(held[-1])
                if state["tokens"] >= shard_tokens:
                    yield flush()
        if keys:
            yield flush()

    files = written(ordered.mapInArrow(shards, "part int, seq int, path string, documents long, tokens long"), "manifest")
    # Parts are few, so their totals stand in one window; within a part the shards do.
    parts = files.groupBy("part").agg(F.sum("tokens").alias("all"), F.count("*").alias("files"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("a"), F.coalesce(F.sum("files").over(before), F.lit(0)).alias("b"))
    within = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("inner", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(parts, "part").select(
        (F.col("b") + F.col("seq")).alias("shard"), "path", "documents", "tokens", (F.col("a") + F.col("inner")).alias("start")
    )


MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])


def spread(shards: DataFrame) -> DataFrame:
    """One file is one row, so the rows are dealt out over all tasks."""
    spark = shards.sparkSession
    return shards.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard")


def read(shards: DataFrame) -> DataFrame:
    """Each document of the shard files: ``key``, ``start`` (ids before it in all shards) and its ``ids``."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start in rows_of(batches, "path", "start"):
            shard = Shard.open(path)
            ids = shard.ids()
            size = 1024
            for a in range(0, shard.documents, size):
                lengths = shard.lengths[a : a + size]
                ends = np.cumsum([0, *lengths.tolist()])
                first = int(shard.starts[a])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[first : first + int(ends[-1])], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.keys[a : a + size], pa.int64()), pa.array(shard.starts[a : a + size] + start, pa.int64()), lists], ["key", "start", "ids"]
                )

    return spread(shards.select("shard", "path", "start")).mapInArrow(documents, "key long, start long, ids array<long>")


def digests(shards: DataFrame) -> DataFrame:
    """Each document of the shard files: ``key``, ``start``, ``n_tokens`` and the crc32 of its ids as little-endian 32-bit words."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start in rows_of(batches, "path", "start"):
            shard = Shard.open(path)
            raw = memoryview(shard.ids().astype("<u4").tobytes())
            crcs = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(shard.starts.tolist(), shard.lengths.tolist(), strict=True)]
            columns = [pa.array(shard.keys, pa.int64()), pa.array(shard.starts + start, pa.int64()), pa.array(shard.lengths, pa.int64()), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "start", "n_tokens", "ids_crc32"])

    return spread(shards.select("shard", "path", "start")).mapInArrow(summed, "key long, start long, n_tokens long, ids_crc32 long")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """Every place of an id: ``position`` over all shards and the ``key`` of its document."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start in rows_of(batches, "path", "start"):
            shard = Shard.open(path)
            at = np.array([shard.occurrence(token, k) for k in range(shard.count(token))], dtype=np.int64)
            owner = np.searchsorted(shard.starts + shard.lengths, at, side="right")
            yield pa.RecordBatch.from_arrays([pa.array(at + start, pa.int64()), pa.array([shard.keys[k] for k in owner], pa.int64())], ["position", "key"])

    return spread(shards.select("shard", "path", "start")).mapInArrow(found, "position long, key long")


def counts(shards: DataFrame, token: int) -> DataFrame:
    """How often an id stands in each shard, from ranks alone."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, path in rows_of(batches, "shard", "path"):
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([Shard.open(path).count(token)], pa.int64())], ["shard", "n"])

    return spread(shards.select("shard", "path")).mapInArrow(counted, "shard long, n long")


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def in_memory(data: bytes) -> Shard:
    return Shard(io.BytesIO(data))
