"""Array work on texts inside a task: words, their hashes, word shingles and packed integers."""

import contextlib
import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Bytes that one step of the array work takes at most, unless one word is longer.
STEP = 1 << 21
ODD = 0x9E3779B97F4A7C15

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# Bytes of a batch of rows between Spark and Python.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that Spark hands to Python in bytes, so that long texts need no more memory.

    Spark counts 10,000 rows or 64 MB; several copies of a batch are held at once on either side.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def set_aside(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but those ``used`` under names that no operator works with, and what gives them back.

    What is given back has the columns of ``df``, in their order, and no others.
    """
    kept = {u if u in df.columns else next((c for c in df.columns if c.lower() == u.lower()), u) for u in used}
    names = [c if c in kept else f"extra_{i}" for i, c in enumerate(df.columns)]
    return df.toDF(*names), lambda found: found.select(*names).toDF(*df.columns)


def trim() -> None:
    """Give freed memory back to the system, so that a worker between two tasks holds little."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(column: pa.Array, size: int = STEP) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``size`` bytes together, and where they begin; null becomes empty."""
    texts = pc.fill_null(column, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    begin = 0
    while begin < len(texts):
        before = int(ends[begin - 1]) if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield begin, texts.slice(begin, stop - begin).to_pylist()
        begin = stop


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64, which spread each bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Bytes hashed at a time, few enough that the arrays stay in the processor's cache.
HASH_STEP = 1 << 18
# Spans of more bytes are hashed and compared one by one.
LONG_SPAN = 256
BLOCK = 8
# The bytes of a block that belong to a span, by their number.
KEEP = np.array([(1 << 8 * k) - 1 for k in range(BLOCK + 1)], dtype=np.uint64)


def windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` on, as an integer; zeros follow the last byte."""
    padded = np.zeros(len(data) + BLOCK, dtype=np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.as_strided(padded.view(np.uint8)[:BLOCK].view("<u8"), (len(data) + 1,), (1,))


def span_hashes(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span.

    The length, then each block of eight bytes, goes through ``mix``, so spans of one length up to
    eight bytes differ in their hashes whenever they differ. Long ones have a keyed BLAKE2b.
    """
    size = stop - begin
    found = mix(size.astype(np.uint64) * np.uint64(ODD))
    blocks = windows(data)
    left = np.flatnonzero(size <= LONG_SPAN) if len(size) and int(size.max()) > LONG_SPAN else np.arange(len(size))
    for at in range(0, LONG_SPAN, BLOCK):
        left = left[size[left] > at] if at else left
        if not len(left):
            break
        block = blocks[begin[left] + at] & KEEP[np.minimum(size[left] - at, BLOCK)]
        found[left] = mix(found[left] ^ block)
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        digest = hashlib.blake2b(data[begin[i] : stop[i]].tobytes(), digest_size=8, key=b"spans").digest()
        found[i] = int.from_bytes(digest, "little")
    return found


def same_spans(data: np.ndarray, begin: np.ndarray, other: np.ndarray, other_begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of ``size`` bytes are equal, byte by byte."""
    same = np.ones(len(size), dtype=bool)
    one, two = windows(data), windows(other)
    left = np.flatnonzero(size <= LONG_SPAN)
    for at in range(0, LONG_SPAN, BLOCK):
        left = left[size[left] > at]
        if not len(left):
            break
        same[left] &= ((one[begin[left] + at] ^ two[other_begin[left] + at]) & KEEP[np.minimum(size[left] - at, BLOCK)]) == 0
    for i in np.flatnonzero(size > LONG_SPAN).tolist():
        n = int(size[i])
        same[i] = np.array_equal(data[begin[i] : begin[i] + n], other[other_begin[i] : other_begin[i] + n])
    return same


def distinct_spans(raw: bytes, begin: np.ndarray, stop: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each span a number, equal for equal bytes only, and for each number the first span that has it.

    Equal hashes are no proof: every span is compared with the first one of its hash.
    """
    code = numbered(pa.array(hashes))
    first = firsts(code)
    data, other = np.frombuffer(raw, np.uint8), first[code]
    size = stop - begin
    same = size == size[other]
    same[same] = same_spans(data, begin[same], data, begin[other[same]], size[same])
    if not same.all():
        code = numbered(pa.array([raw[a:b] for a, b in zip(begin.tolist(), stop.tolist(), strict=True)], pa.large_binary()))
        first = firsts(code)
    return code, first


def numbered(values: pa.Array) -> np.ndarray:
    """A number for each value, in the order of first appearance."""
    return values.dictionary_encode().indices.to_numpy().astype(np.int64)


def firsts(code: np.ndarray) -> np.ndarray:
    first = np.empty(int(code.max()) + 1 if len(code) else 0, np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    return first


class KnownWords:
    """Numbers of words that were added before, in arrays: ordered hashes, and the bytes to compare with."""

    def __init__(self):
        self.hashes, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.begins, self.sizes, self.data = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint8)
        self.count = 0

    def find(self, raw: bytes, begin: np.ndarray, stop: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The number of each span, -1 for one that is not known."""
        found = np.full(len(hashes), -1, np.int64)
        if not len(self.hashes):
            return found
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number, size = self.numbers[at], stop - begin
        met = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[number] == size))
        same = same_spans(np.frombuffer(raw, np.uint8), begin[met], self.data, self.begins[number[met]], size[met])
        found[met[same]] = number[met[same]]
        return found

    def add(self, raw: bytes, begin: np.ndarray, stop: np.ndarray, hashes: np.ndarray) -> None:
        """Number new, distinct spans one after the other. One with the hash of a known word gets a number but is not found again."""
        size = stop - begin
        numbers = np.arange(self.count, self.count + len(hashes), dtype=np.int32)
        ends = np.cumsum(size)
        place = np.repeat(begin - (ends - size), size)
        place += np.arange(len(place))
        self.begins = np.concatenate([self.begins, len(self.data) + ends - size])
        self.sizes = np.concatenate([self.sizes, size.astype(np.int32)])
        self.data = np.concatenate([self.data, np.frombuffer(raw, np.uint8)[place]])
        self.count += len(hashes)
        values, chosen = np.unique(hashes, return_index=True)
        at = np.searchsorted(self.hashes, values)
        taken = self.hashes[np.minimum(at, len(self.hashes) - 1)] == values if len(self.hashes) else np.zeros(len(values), bool)
        values, chosen, at = values[~taken], chosen[~taken], at[~taken]
        self.hashes, self.numbers = np.insert(self.hashes, at, values), np.insert(self.numbers, at, numbers[chosen])


def long_hashes(raw: bytes, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """``span_hashes`` of ordered spans, some of them at a time, so that the arrays stay small."""
    found, a = [np.empty(0, np.uint64)], 0
    while a < len(begin):
        b = max(a + 1, int(np.searchsorted(stop, int(begin[a]) + HASH_STEP, side="right")))
        first, last = int(begin[a]), int(stop[b - 1])
        data = np.frombuffer(raw, dtype=np.uint8, count=last - first, offset=first)
        found.append(span_hashes(data, begin[a:b] - first, stop[a:b] - first))
        a = b
    return np.concatenate(found)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word of ``raw`` begins and ends, and a 64-bit hash of its bytes.

    Words are runs of bytes other than space and 9 to 13. Input is worked off in steps that end
    between words, so memory grows by 24 bytes a word beyond one step.
    """
    starts, stops, hashes, at = [], [], [], 0
    while at < len(raw):
        end = min(len(raw), at + HASH_STEP)
        while end < len(raw) and not IS_SPACE[raw[end]]:
            end += 1
        data = np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at)
        space = np.ones(len(data) + 2, dtype=bool)
        space[1:-1] = IS_SPACE[data]
        edges = np.flatnonzero(space[1:] != space[:-1])
        if len(edges):
            begin, stop = edges[0::2], edges[1::2]
            starts.append(begin + at)
            stops.append(stop + at)
            hashes.append(span_hashes(data, begin, stop))
        at = end
    if not starts:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    return np.concatenate(starts), np.concatenate(stops), np.concatenate(hashes)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += words[k : k + n]
    return mix(total)


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """For each text the ordered distinct hashes of its word shingles, A-Z in lower case."""
    raw = [utf8(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    places, _, hashes = word_hashes(b"\n".join(raw).translate(LOWER))
    runs = shingles(hashes, size)
    bounds = np.searchsorted(places, starts).tolist()
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        found = runs[a : b - size + 1].copy() if b - a >= size else shingles(hashes[a:b], size)
        found.sort()
        keep = np.ones(len(found), dtype=bool)
        np.not_equal(found[1:], found[:-1], out=keep[1:])
        yield found[keep]


def pack48(values: np.ndarray) -> bytes:
    """48-bit values in six bytes each: all low halves of 32 bits, then all high ones of 16."""
    return (values & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (values >> np.uint64(32)).astype("<u2").tobytes()


def unpack48(packed: bytes) -> np.ndarray:
    n = len(packed) // 6
    low = np.frombuffer(packed, dtype="<u4", count=n)
    high = np.frombuffer(packed, dtype="<u2", count=n, offset=4 * n)
    return low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


def with_runs(texts: list[str], classes: list[tuple[np.ndarray, int]]) -> list[np.ndarray]:
    """For each byte class and length: which texts have a run of at least so many such bytes."""
    raw = [utf8(t) for t in texts]
    starts = np.cumsum([0, *[len(r) + 1 for r in raw]])
    joined, result = b"\n".join(raw), []
    for table, least in classes:
        found = np.zeros(len(texts), dtype=bool)
        carried = 0  # where the run began that reaches the next step
        for a in range(0, len(joined), STEP):
            data = np.frombuffer(joined, dtype=np.uint8, count=min(STEP, len(joined) - a), offset=a)
            outside = np.flatnonzero(~table[data]) + a
            edges = np.concatenate([[carried - 1], outside, [a + len(data)]])
            long = np.flatnonzero(np.diff(edges) > least)
            found[np.searchsorted(starts, edges[long] + 1, side="right") - 1] = True
            carried = int(edges[-2]) + 1
        result.append(found)
    return result
