"""Spelling variants: words at an edit of one character, found by sorting permuterm rotations.

A word with a terminator behind it has a rotation for each of its characters. Rotated so that the
edited character is the last one, two words that differ there by a replacement are equal but for
that character, and a word that lacks it is, rotated to the same place, all of the rest. So every
rotation stands in the sorted order as it is, and once more without its last character; equal
entries lie together, and neighbours are found by one scan. A group has one entry per character of
the alphabet and one for the word without it, so no group grows with the corpus.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvec.cluster import written
from docvec.llm.kernels import LOWER, STEP, slices, trim, utf8

# What words are made of, once A to Z are lower-cased, and the terminator.
RUN = re.compile("[a-zÀ-ÿ]+")
END = "$"
# Fixed value: one in so many runs of a document loses a character.
NOISE = 199

LEAST_LENGTH = 6
LEAST_COUNT = 5
# A variant's form occurs at least so many times as often as it.
RATIO = 5
# Different words that a task counts before it hands the counts on.
COUNTED = 200_000
# Rotations of words of more characters are compared by two remainders modulo a prime instead of as text.
LONG = 64
PRIME = (1 << 61) - 1
BASES = (0x1D3A5B79C8E6F204 % PRIME, 0x0F1E2D3C4B5A6978 % PRIME)
# Entries of a batch.
ENTRIES = 50_000


def noised(key: str, run: str) -> str:
    """``run`` as it is counted: some runs of a document lose one character."""
    h = zlib.crc32(utf8(run), zlib.crc32(utf8(f"{key}:")))
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def parts(text: str, size: int = STEP) -> Iterator[str]:
    """A text in parts of about ``size`` characters that do not end within a run."""
    at = 0
    while at < len(text):
        run = RUN.match(text, at + size)
        stop = run.end() if run else at + size
        yield text[at:stop]
        at = stop


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """``id``, ``word``, ``n``: the words of all texts; ids ascend with the words in order of code points.

    A null text has no words, a null key counts as empty. Tasks add up before anything is shuffled,
    so a word that every document has is one row per task. The result is a written table.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return rows

        for batch in batches:
            keys = batch.column("key").to_pylist()
            for begin, texts in slices(batch.column("text")):
                for own, words in zip(keys[begin:], texts, strict=False):
                    for part in parts(utf8(words).translate(LOWER).decode("utf-8", "surrogatepass")):
                        for run, n in Counter(RUN.findall(part)).items():
                            word = noised(own, run)
                            if len(word) >= least_length:
                                counts[word] += n
                        if len(counts) >= COUNTED:
                            yield flush()
        yield flush()
        trim()

    rows = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))
    words = rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)
    words = written(words, "words").repartitionByRange("word").sortWithinPartitions("word")
    return written(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


class Rotations:
    """Keys of the rotations of a word with its terminator: of each whole one, and of each without its last character."""

    def __init__(self, word: str):
        self.text = 2 * (word + END)
        self.size = len(word) + 1
        self.sums: list[list[int]] = []
        if self.size > LONG:
            for base in BASES:
                total, sums = 0, [0]
                for c in self.text:
                    total = (total * base + ord(c) + 1) % PRIME
                    sums.append(total)
                self.sums.append(sums)
            self.powers = {n: [pow(base, n, PRIME) for base in BASES] for n in (self.size, self.size - 1)}

    def key(self, at: int, n: int) -> bytes:
        if n <= LONG:
            return utf8(self.text[at : at + n])
        parts = [(s[at + n] - s[at] * p) % PRIME for s, p in zip(self.sums, self.powers[n], strict=True)]
        return b"\0%d,%d,%d" % (n, *parts)

    def entries(self) -> Iterator[tuple[bytes, bool, bool]]:
        """Key, whether it is a whole rotation, and whether the left-out character is the last of a run of equal ones.

        Leaving out any character of a run gives the same shorter word; one of them is enough.
        """
        for at in range(self.size):
            yield self.key(at, self.size), True, False
            last = (at + self.size - 1) % self.size  # the character left out
            if last != self.size - 1:  # not the terminator
                yield self.key(at, self.size - 1), False, self.text[last] != self.text[last + 1]


ENTRY = "key binary, id long, n long, whole boolean, canonical boolean"
ENTRY_SCHEMA = pa.schema([("key", pa.binary()), ("id", pa.int64()), ("n", pa.int64()), ("whole", pa.bool_()), ("canonical", pa.bool_())])


def rotations(words: DataFrame) -> DataFrame:
    """The entries of all words, dealt out by key and sorted in each task."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, counts, whole, canonical = columns = [], [], [], [], []
        for batch in batches:
            for own, word, n in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n")), strict=True):
                for key, is_whole, is_canonical in Rotations(word).entries():
                    keys.append(key)
                    ids.append(own)
                    counts.append(n)
                    whole.append(is_whole)
                    canonical.append(is_canonical)
                    if len(keys) >= ENTRIES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ENTRY_SCHEMA, strict=True)], schema=ENTRY_SCHEMA)
                        for c in columns:
                            c.clear()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ENTRY_SCHEMA, strict=True)], schema=ENTRY_SCHEMA)

    return words.mapInArrow(made, ENTRY).repartition("key").sortWithinPartitions("key", "id", "whole")


PAIR = "id long, near long, near_n long"
PAIR_SCHEMA = pa.schema([("id", pa.int64()), ("near", pa.int64()), ("near_n", pa.int64())])


def neighbours(words: DataFrame) -> DataFrame:
    """``id``, ``near``, ``near_n``: each word with each word at one insertion, deletion or replacement, once, and that one's count.

    One scan over the sorted rotations; a group that reaches over a batch's end is carried on.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])]).combine_chunks()
            edges = borders(table.column("key").combine_chunks())
            held = table.slice(int(edges[-2])) if len(edges) > 1 else table
            yield from pairs(table, edges[:-1])
        if held is not None and held.num_rows:
            yield from pairs(held, borders(held.column("key").combine_chunks()))

    return rotations(words).mapInArrow(scanned, PAIR)


def borders(keys: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Where groups of equal keys begin, and the end."""
    if isinstance(keys, pa.ChunkedArray):
        keys = keys.combine_chunks()
    if not len(keys):
        return np.zeros(1, np.int64)
    changed = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [len(keys)]])


def pairs(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The pairs of each group: words with another character there, and the word without it with those that have it."""
    sizes = np.diff(edges)
    ids, counts, whole, canonical = (table.column(c).to_numpy() for c in ("id", "n", "whole", "canonical"))
    for begin in range(0, len(sizes), ENTRIES):
        found = []
        several = np.flatnonzero(sizes[begin : begin + ENTRIES] > 1) + begin
        # Groups of one size are compared together, as a matrix.
        for size in np.unique(sizes[several]).tolist():
            place = edges[several[sizes[several] == size]][:, None] + np.arange(size)
            one, other = (np.broadcast_to(x, (len(place), size, size)) for x in (place[:, :, None], place[:, None, :]))
            replaced = ~whole[one] & ~whole[other] & (ids[one] != ids[other])
            lacks = (whole[one] & canonical[other]) | (whole[other] & canonical[one])
            met = replaced | lacks
            found.append((ids[one[met]], ids[other[met]], counts[other[met]]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], schema=PAIR_SCHEMA)


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of a table made by ``word_counts``.

    A word's form is its near word of the largest count (ties: the smallest in code-point order), if
    that count is at least ``ratio`` times its own, else null; the root is where forms end. Counts
    grow along forms by ``ratio``, so chains have no circle and are as long as the logarithm of the
    largest count; pointers double, so rounds are the logarithm of that.
    """
    stats = neighbours(words).groupBy("id").agg(F.count("*").alias("n_near"), F.max(F.struct("near_n", (-F.col("near")).alias("first"))).alias("best"))
    stats = stats.select("id", "n_near", F.col("best.near_n").alias("best_n"), (-F.col("best.first")).alias("best"))
    known = words.join(stats, "id", "left")
    formed = F.col("best_n") >= F.col("n") * ratio
    n_near = F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")
    known = written(known.select("id", "word", "n", n_near, F.when(formed, F.col("best")).alias("to"), F.when(formed, F.col("best_n")).alias("form_n")), "forms")
    links = known.where("to IS NOT NULL").select("id", "to")
    roots = links
    while True:
        step = roots.select(F.col("id").alias("to"), F.col("to").alias("next"))
        longer = written(roots.join(step, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = longer.drop("moved")
        if longer.where("moved").isEmpty():
            break
    names = words.select(F.col("id").alias("to"), F.col("word").alias("name"))
    form = links.join(names, "to").select("id", F.col("name").alias("form"))
    root = roots.join(names, "to").select("id", F.col("name").alias("root"))
    found = reduce(lambda a, b: a.join(b, "id", "left"), [form, root], known)
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
