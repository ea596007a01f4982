"""Document fingerprints by SpotSigs: chains of content words that follow common words.

Every common word (an anchor) with the next content words after it is a spot; the hashes of a
text's distinct spots are its signatures, and likeness is their Jaccard. Prose holds many anchors
and lists or menus few, so fingerprints follow the prose of a page.
"""

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.cluster import written
from docvec.llm.kernels import mix, slices, utf8, word_hashes

CHAIN = 2
# Common words that anchor a spot.
ANCHORS = {
    "en": "the a an of to in is was are be been that this it as at by for from on or with and he she they his her not but which",
    "de": "der die das ein eine einer eines dem den des im in ist war sind und zu von mit auf für nicht sich als auch es an",
    "fr": "le la les un une des du de et est était dans en que qui pour par sur au aux avec ce cette ne pas il elle",
    "es": "el la los las un una unos unas de del y es era en que por para con se no al lo su como más",
}
# Punctuation is no part of a word.
BREAKS = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def anchor_hashes() -> np.ndarray:
    words = sorted({w for line in ANCHORS.values() for w in line.split()})
    return np.sort(word_hashes(utf8(" ".join(words)))[2])


def signatures(words: np.ndarray, anchors: np.ndarray, chain: int) -> np.ndarray:
    """Ordered distinct 32-bit signatures of a text, from the hashes of its words.

    A text with words but without a spot has one signature, of all its words.
    """
    place = np.minimum(np.searchsorted(anchors, words), len(anchors) - 1)
    common = anchors[place] == words
    content = np.flatnonzero(~common)
    spots = np.flatnonzero(common)
    first = np.searchsorted(content, spots)
    spots, first = spots[first + chain <= len(content)], first[first + chain <= len(content)]
    if not len(words):
        return np.empty(0, np.uint32)
    if not len(spots):
        return np.frombuffer(hashlib.blake2b(words.tobytes(), digest_size=4).digest(), "<u4")
    total = words[spots].copy()
    for k in range(chain):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += words[content[first + k]]
    return np.unique((mix(total) >> np.uint64(32)).astype("<u4"))


def of_texts(texts: list[str], anchors: np.ndarray, chain: int) -> list[np.ndarray]:
    raw = [utf8(t.lower()).translate(BREAKS) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    begin, _, hashes = word_hashes(b" ".join(raw))
    bounds = np.searchsorted(begin, starts).tolist()
    return [signatures(hashes[a:b], anchors, chain) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def spelled(found: np.ndarray) -> str:
    """The number of signatures, and they in ascending order as little-endian 32-bit words in base64."""
    return f"{len(found)}:{base64.b64encode(found.tobytes()).decode()}"


def parsed(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.partition(":")[2]), "<u4")


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two ordered sets; 1 for two empty ones. Below ``least`` by length alone, 0."""
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def fingerprint(text: Column | str, chain: int = CHAIN) -> Column:
    """The fingerprint of a text; null counts as empty. Equal texts have equal fingerprints."""
    anchors = anchor_hashes()

    @F.arrow_udf("string")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array([spelled(s) for _, part in slices(texts) for s in of_texts(part, anchors, chain)], pa.string())

    return made(text)


def likeness(a: Column | str, b: Column | str) -> Column:
    """Jaccard of two fingerprints, 0 to 1."""

    @F.arrow_udf("double")
    def compared(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = zip(left.to_pylist(), right.to_pylist(), strict=True)
        return pa.array([None if x is None or y is None else jaccard(parsed(x), parsed(y)) for x, y in pairs], pa.float64())

    return compared(a, b)


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by as much of the begin of ``after``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + after[:quarter]


FOUND = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def stability(df: DataFrame, key: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """How fingerprints stand an edit: one row per row of ``df``, each with the next one in order of an integer key.

    Columns: ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``. Null keys come first, equal keys by the text's hash; null texts
    are empty; the last row's next is the first. An empty table gives none.

    Texts are dealt out once, by ranges of keys. The first document of each range is sent to the
    range before it too, so that every task knows the document after its last one.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rank = F.coalesce("key", F.lit(-(1 << 63)))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(ranges)]
    found = rows.select(rank.alias("r")).agg(F.min("r").alias("least"), F.percentile_approx("r", shares, 10 * ranges).alias("bounds")).head()
    bounds = np.array(sorted({found["least"], *(found["bounds"] or [])} - {None}), np.int64)
    anchors = anchor_hashes()

    @F.arrow_udf("array<struct<range:int,follows:boolean>>")
    def placed(keys: pa.Array) -> pa.Array:
        values = pc.fill_null(keys, -(1 << 63)).to_numpy(zero_copy_only=False)
        place = np.searchsorted(bounds, values, side="right") - 1
        first = bounds[place] == values
        return pa.array(
            [
                [{"range": p, "follows": False}] + [{"range": (p - 1) % len(bounds), "follows": True}] * f
                for p, f in zip(place.tolist(), first.tolist(), strict=True)
            ],
            pa.list_(pa.struct([("range", pa.int32()), ("follows", pa.bool_())])),
        )

    dealt = rows.select("key", "text", F.explode(placed("key")).alias("at")).select("at.*", "key", "text")
    ordered = dealt.repartition("range").sortWithinPartitions("range", "follows", F.asc_nulls_first("key"), F.xxhash64("text"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # range, key, text, signatures of the row whose next one is still to come
        for batch in batches:
            ranges, follows, keys = (batch.column(k).to_pylist() for k in ("range", "follows", "key"))
            for begin, texts in slices(batch.column("text")):
                waiting, ending = [], []
                for i, (own, words) in enumerate(zip(of_texts(texts, anchors, chain), texts, strict=True), begin):
                    if last is not None and last[0] == ranges[i]:
                        waiting.append(last)
                        ending.append((words, own))
                    last = None if follows[i] else (ranges[i], keys[i], words, own)
                changed = [edited(x[2], after) for x, (after, _) in zip(waiting, ending, strict=True)]
                made = of_texts(changed, anchors, chain)
                columns = [
                    [x[1] for x in waiting], [len(x[2]) for x in waiting], [hashlib.sha256(utf8(t)).hexdigest() for t in changed],
                    [spelled(x[3]) for x in waiting], [spelled(s) for s in made],
                    [jaccard(x[3], s) for x, s in zip(waiting, made, strict=True)], [jaccard(x[3], s) for x, (_, s) in zip(waiting, ending, strict=True)],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)

    return ordered.mapInArrow(compared, FOUND)


SCHEMA = pa.schema(
    [("key", pa.int64()), ("n_chars", pa.int64()), *[(k, pa.string()) for k in ("edited_sha256", "fingerprint", "edited_fingerprint")],
     ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def near_pairs(fingerprints: DataFrame, least: float = 0.8, column: str = "fingerprint") -> DataFrame:
    """All pairs of different fingerprints with a likeness of ``least`` (above 0) or more: ``a`` < ``b``, ``likeness``.

    Equal fingerprints are one set; their rows are found by joining on the fingerprint. Sets are
    partitioned by length so that a partner is in the same partition or the next one; within a
    partition they meet on a rare signature only (rare ones first, as many as a pair at this
    likeness must share one of), and lengths that rule a pair out are pruned before the sets are
    compared. Empty sets have no partner.
    """
    distinct = fingerprints.select(F.col(column).alias("f")).where(F.col("f").isNotNull()).distinct()

    @F.arrow_udf("array<bigint>")
    def members(values: pa.Array) -> pa.Array:
        return pa.array([parsed(v).astype(np.int64) for v in values.to_pylist()], pa.list_(pa.int64()))

    sets = distinct.select("f", members("f").alias("s")).where(F.size("s") > 0)
    sets = written(sets.withColumns({"n": F.size("s"), "node": F.xxhash64("f")}), "signatures")
    flat = sets.select("node", "n", F.explode("s").alias("sig"))
    often = flat.groupBy("sig").count()
    ranked = flat.join(often.where("count > 1"), "sig").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("count", "sig"))).alias("sigs"))
    # Signatures that no other set has stand before these in the order.
    head = F.size("sigs") - F.ceil(F.col("n") * least).cast("int") + 1
    part = F.floor(F.log("n") / -np.log(least) + 1e-9).cast("int") if least < 1 else F.col("n")
    probes = ranked.where(head > 0).withColumn("part", part).select("node", "n", "part", F.explode(F.slice("sigs", F.lit(1), head)).alias("x")).select("node", "n", "part", "x.sig")
    probes = written(probes, "probes")
    other = probes.select("sig", F.col("node").alias("o_node"), F.col("n").alias("o_n"), F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"), F.col("part").alias("o_part"))
    smaller = (F.col("n") > F.col("o_n")) | ((F.col("n") == F.col("o_n")) & (F.col("node") > F.col("o_node")))
    met = probes.join(other, ["sig", "part"]).where(smaller & (F.col("o_n") >= F.col("n") * least)).select("node", "o_node").distinct()
    left, right = sets.select("node", F.col("f").alias("x"), F.col("s").alias("xs")), sets.select(F.col("node").alias("o_node"), F.col("f").alias("y"), F.col("s").alias("ys"))
    common = F.size(F.array_intersect("xs", "ys"))
    near = met.join(left, "node").join(right, "o_node").select("x", "y", (common / (F.size("xs") + F.size("ys") - common)).alias("likeness"))
    return near.where(F.col("likeness") >= least).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "likeness")

