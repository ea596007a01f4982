"""Language ID in two steps: the family first, then linear SVMs, one against one, within it.

A text is its hashed byte n-grams as shares of all its n-grams. All functions are linear in
them, so a text is scored by adding up weights over its bytes and needs no vector of its own.
"""

import re
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docvec.llm.kernels import LOWER, slices, trim, utf8

UNKNOWN = "und"
# Language codes by family; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz tk ky",
    "indic": "hi bn mr gu pa ur ne",
    "semitic": "ar he mt am",
    "sinitic": "zh yue",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# Bounds of the sample that is learned from: documents per language, and languages (the most
# frequent). Both reach the driver as sparse n-gram counts.
SAMPLE_PER_LANGUAGE = 400
MAX_LANGUAGES = 100
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
STEP = 1 << 20
LETTER = re.compile(r"[^\W\d_]")
PLAIN = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in LOWER)


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the n-gram that ends at each byte; before the first byte there are spaces."""
    code = np.full(len(data), order, dtype=np.uint32)
    for back in range(order):
        shifted = data if not back else np.concatenate([np.full(min(back, len(data)), 32, np.uint8), data[: -back or None]])[: len(data)]
        code = (code * np.uint32(0x01000193)) ^ shifted.astype(np.uint32)
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int32)


def flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as bytes of letters and spaces, and where each begins.

    The spaces after each text keep its n-grams apart from the next one's.
    """
    raw = [utf8(t.lower()).translate(PLAIN) + b" " * (max(ORDERS) - 1) for t in texts]
    return np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)])


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    data, _ = flat([text])
    total = sum(np.bincount(grams(data, n), minlength=BUCKETS) for n in ORDERS)
    used = np.flatnonzero(total)
    return used.astype(np.int32), (total[used] / (len(data) * len(ORDERS))).astype(np.float32)


def sums(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """For each text the weights of its n-grams, added up and divided by their number."""
    data, starts = flat(texts)
    result = np.zeros((len(texts), weights.shape[1]))
    for a in range(0, len(data), STEP):  # a long text takes several steps
        lead = min(a, max(ORDERS) - 1)
        part = data[a - lead : a + STEP]
        first, last = np.searchsorted(starts, [a, min(a + STEP, len(data)) - 1], side="right") - 1
        cuts = np.maximum(starts[first : last + 1] - a, 0)
        for n in ORDERS:
            result[first : last + 1] += np.add.reduceat(weights[grams(part, n)[lead:]], cuts, axis=0, dtype=np.float64)
    return result / (np.diff(starts) * len(ORDERS))[:, None]


def svm(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, scale: np.ndarray, rounds: int = 20, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with squared hinge loss, by dual coordinate descent."""
    weights, bias = np.zeros(BUCKETS), 0.0
    alpha = np.zeros(len(rows))
    scaled = [(i, v * scale[i]) for i, v in rows]
    diagonal = np.array([v @ v + 1.0 for _, v in scaled]) + 0.5 / cost
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for k in order.permutation(len(rows)):
            i, v = scaled[k]
            slope = signs[k] * (weights[i] @ v + bias) - 1 + 0.5 / cost * alpha[k]
            new = max(0.0, alpha[k] - slope / diagonal[k])
            step = (new - alpha[k]) * signs[k]
            if step:
                weights[i] += step * v
                bias += step
                alpha[k] = new
    return weights * scale, bias


def certainty(margin: np.ndarray) -> np.ndarray:
    """0 to 1; 0.5 on the border between two classes, 0.98 at the edge of the SVM's margin."""
    return 1 / (1 + np.exp(-4 * np.clip(margin, -8, 8)))


@dataclass
class Model:
    """Weights per n-gram: one against the rest for families, one against one within each."""

    families: list[str] = field(default_factory=list)
    members: dict[str, list[str]] = field(default_factory=dict)
    family_weights: np.ndarray | None = None
    family_bias: np.ndarray | None = None
    pair_weights: dict[str, np.ndarray] = field(default_factory=dict)
    pair_bias: dict[str, np.ndarray] = field(default_factory=dict)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if LETTER.search(t)] if self.families else []
        if not known:
            return langs, scores.tolist()
        sure, family = np.ones(len(known)), np.zeros(len(known), dtype=int)
        if len(self.families) > 1:
            margins = sums([texts[i] for i in known], self.family_weights) + self.family_bias
            family, sure = margins.argmax(axis=1), certainty(margins.max(axis=1))
        for f, name in enumerate(self.families):
            own, codes = np.flatnonzero(family == f), self.members[name]
            if not len(own):
                continue
            pick, inner = np.zeros(len(own), dtype=int), np.ones(len(own))
            if len(codes) > 1:
                margins = sums([texts[known[k]] for k in own], self.pair_weights[name]) + self.pair_bias[name]
                votes = np.zeros((len(own), len(codes)))
                for p, (a, b) in enumerate(combinations(range(len(codes)), 2)):
                    win = certainty(margins[:, p])
                    votes[:, a] += win
                    votes[:, b] += 1 - win
                pick, inner = votes.argmax(axis=1), votes.max(axis=1) / (len(codes) - 1)
            for k, code, s in zip(own, pick, sure[own] * inner, strict=True):
                langs[known[k]], scores[known[k]] = codes[code], s
        return langs, scores.tolist()


def train(langs: list[str], rows: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    if not rows:
        return Model()
    mean = np.zeros(BUCKETS)
    for i, v in rows:
        mean[i] += v
    scale = 1 / np.sqrt(mean / len(rows) + 1e-6)
    by_family: dict[str, set[str]] = {}
    for code in langs:
        by_family.setdefault(FAMILY_OF.get(code, f"only {code}"), set()).add(code)
    model = Model(sorted(by_family), {f: sorted(codes) for f, codes in by_family.items()})
    kind = np.array([FAMILY_OF.get(code, f"only {code}") for code in langs])
    code = np.array(langs)

    def fitted(picks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        found = [svm([rows[k] for k in np.flatnonzero(use)], np.where(sign[use], 1.0, -1.0), scale) for use, sign in picks]
        return np.stack([w for w, _ in found], axis=1).astype(np.float32), np.array([b for _, b in found])

    if len(model.families) > 1:
        model.family_weights, model.family_bias = fitted([(kind == kind, kind == f) for f in model.families])
    for f, codes in model.members.items():
        if len(codes) > 1:
            pairs = combinations(codes, 2)
            model.pair_weights[f], model.pair_bias[f] = fitted([((code == a) | (code == b), code == a) for a, b in pairs])
    return model


def fit(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", usable: Column | None = None,
        per_language: int = SAMPLE_PER_LANGUAGE, max_languages: int = MAX_LANGUAGES) -> Model:
    """Learn from a bounded sample: of each of the most frequent languages, the rows whose key hashes lowest.

    Rows without language, without a letter or not ``usable`` are not learned from. Rows with
    equal keys count as one choice, so a rerun picks the same rows. An empty table gives a model
    that knows no language.
    """
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.lit(True) if usable is None else usable))
    sizes = rows.groupBy(F.col(lang).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not sizes:
        return Model()
    # About twice the rows needed pass by their hash, so that only they are ranked.
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, (2 * per_language + 50) / r["count"]))])
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    few = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), place.alias("place")).where(F.col("place") < share[F.col("lang")])
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("place", F.xxhash64("text"))))

    @F.arrow_udf("struct<buckets:binary,shares:binary>")
    def features(texts: pa.Array) -> pa.Array:
        found = [counts(t) if t and LETTER.search(t) else (np.empty(0, np.int32), np.empty(0, np.float32)) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([x[k].tobytes() for x in found], pa.binary()) for k in (0, 1)], ["buckets", "shares"])

    sample = ranked.where(F.col("rank") <= per_language).select("lang", "rank", features("text").alias("x")).orderBy("lang", "rank").collect()
    pairs = [(r["lang"], (np.frombuffer(r["x"]["buckets"], np.int32), np.frombuffer(r["x"]["shares"], np.float32))) for r in sample]
    pairs = [(code, x) for code, x in pairs if len(x[0])]
    return train([code for code, _ in pairs], [x for _, x in pairs])


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with the columns ``lang_pred`` and ``score``; columns of that name are replaced.

    A text that is null or has no letter is ``und`` with score 0, as is every text under a model
    that knows no language. The score is the certainty of the family times that within it.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def predicted(column: pa.Array) -> pa.Array:
        langs, scores = [], []
        for _, texts in slices(column):
            a, b = shared.value.predict(texts)
            langs += a
            scores += b
        trim()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    found = df.withColumn("lang_pred", predicted(text))
    return found.withColumns({"score": F.col("lang_pred.score"), "lang_pred": F.col("lang_pred.lang")})


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves no remainder by 5; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0
