"""Secret scans: sure findings by pattern, weak ones only where parts of a credential meet.

Sure findings always count. A weak part (an identifier, an opaque string, an endpoint) counts
only if its complement lies in its scope: the text up to ``reach`` code points before and after.
Parts meet in an interval join of Spark, on the text and on bins as wide as the reach, so a
text with very many parts is spread over its bins.
"""

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.cluster import written
from docvec.llm.kernels import byte_class, set_aside, slices, trim, with_runs

REACH = 200

# Kinds of sure findings in their order, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of hex digits is one match, so shorter runs need no look
MIN_ASSIGN, MIN_ACCESS = 6, 20

# Weak kinds: what may be half of a credential.
WEAK = ("ident", "opaque", "endpoint")
IDENT = re.compile(r"""(?:access_key_id|client_id|account|username|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", re.I | re.A)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Z+/0-9]*[a-z])(?=[a-z+/0-9]*[A-Z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9_-])")
ENDPOINT = re.compile(r"https?://[^\s\"'<>]+")
# What has to lie in the scope of a weak part: one kind of each group.
IDENTIFIERS, SECRETS = ("access", "ident"), ("assign", "hex", "opaque")
NEEDS = {"ident": (SECRETS,), "opaque": (IDENTIFIERS,), "endpoint": (IDENTIFIERS, SECRETS)}
ORDER = (*KINDS, *WEAK)

SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint>"
Span = tuple[int, int, str, int]


# A pattern runs only where what each of its matches holds was seen: a word in any case, or a run
# of so many bytes of a class.
ASSIGN_WORDS, IDENT_WORDS = ("passw", "secret", "token", "api"), ("access_key", "client_id", "account", "username", "login")
HEX_RUN = (byte_class(b"0123456789abcdef"), 24)
OPAQUE_RUN = (byte_class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 32)


def base_spans(text: str, low: str, hexes: bool) -> list[Span]:
    """Sure findings as (start, rank of the kind, kind, end), by start and rank."""
    found = []
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    if hexes:
        found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def weak_spans(text: str, low: str, opaque: bool, base: list[Span]) -> list[Span]:
    """Weak parts that touch no sure finding."""
    found = []
    if any(w in low for w in IDENT_WORDS):
        found += [(m.start(), 3, "ident", m.end()) for m in IDENT.finditer(text)]
    if opaque:
        found += [(m.start(), 4, "opaque", m.end()) for m in OPAQUE.finditer(text)]
    if "http" in text:
        found += [(m.start(), 5, "endpoint", m.end()) for m in ENDPOINT.finditer(text)]
    if not found:
        return []
    free, taken = [], iter([*base, (float("inf"), 0, "", float("inf"))])
    now = next(taken)
    for s in sorted(found):
        while now[3] <= s[0]:
            now = next(taken)
        if now[0] >= s[3]:
            free.append(s)
    return free


def spelled(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def parts(df: DataFrame, text: str) -> DataFrame:
    """``df`` with sure findings, weak parts, and where there are weak ones the text's digest."""

    @F.arrow_udf(f"struct<base:array<{SPAN}>,weak:array<{SPAN}>>")
    def found(texts: pa.Array) -> pa.Array:
        keys = ("start", "rank", "kind", "end")
        kind = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int64())]))
        both: tuple[list, list] = ([], [])
        for _, values in slices(texts):
            hexes, opaques = with_runs(values, [HEX_RUN, OPAQUE_RUN])
            for value, has_hex, has_opaque in zip(values, hexes.tolist(), opaques.tolist(), strict=True):
                low = value.lower()
                base = base_spans(value, low, has_hex)
                for column, spans in zip(both, (base, weak_spans(value, low, has_opaque, base)), strict=True):
                    column.append([dict(zip(keys, s, strict=True)) for s in spans])
        trim()
        return pa.StructArray.from_arrays([pa.array(c, kind) for c in both], ["base", "weak"])

    rows = df.withColumn("base_spans", found(text))
    rows = rows.withColumns({"weak_spans": F.col("base_spans.weak"), "base_spans": F.col("base_spans.base")})
    return rows.withColumn("text_key", F.when(F.size("weak_spans") > 0, F.md5(F.col(text).cast("binary"))))


def linked(rows: DataFrame, reach: int) -> DataFrame:
    """``text_key`` and the weak spans whose complements lie in their scope; equal texts count once."""
    once = rows.where(F.col("text_key").isNotNull()).select("text_key", "base_spans", "weak_spans").dropDuplicates(["text_key"])
    part = once.select("text_key", F.explode(F.concat("base_spans", "weak_spans")).alias("p")).select("text_key", "p.*")

    def bins(start: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / reach), F.floor((end - 1) / reach)))

    # A weak part stands in the bins its scope covers, a complement in the bins it covers itself.
    scope = part.where(F.col("kind").isin(*WEAK)).select("text_key", "start", "rank", "kind", "end", bins(F.greatest(F.lit(0), F.col("start") - reach), F.col("end") + reach).alias("bin"))
    near = part.where(~F.col("kind").isin("endpoint")).select(
        "text_key", F.col("start").alias("from"), F.col("end").alias("to"), F.col("kind").alias("by"), bins(F.col("start"), F.col("end")).alias("bin")
    )
    met = scope.join(near, ["text_key", "bin"]).where((F.col("from") < F.col("end") + reach) & (F.col("to") > F.col("start") - reach))
    sides = [F.max(F.col("by").isin(*group)).alias(f"has{i}") for i, group in enumerate((IDENTIFIERS, SECRETS))]
    seen = met.groupBy("text_key", "start", "rank", "kind", "end").agg(*sides)
    ok = (F.col("has0") | ~F.col("kind").isin(*[k for k, v in NEEDS.items() if IDENTIFIERS in v])) & (
        F.col("has1") | ~F.col("kind").isin(*[k for k, v in NEEDS.items() if SECRETS in v])
    )
    return seen.where(ok).groupBy("text_key").agg(F.collect_list(F.struct("start", "rank", "kind", "end")).alias("linked_spans"))


def scan(df: DataFrame, text: str = "text", reach: int = REACH, keep_text: bool = True) -> DataFrame:
    """``df`` with ``base_spans`` and ``spans``: sure findings, and these with the linked weak parts.

    Spans are structs of start, rank of the kind, kind and end in code points, end exclusive,
    ordered by start and rank. A null or empty text has none. Every row is kept, repeated rows
    too; columns of ``df`` with these names, or ``weak_spans``, ``linked_spans`` or ``text_key``, are
    dropped. The patterns run once per row: their findings are written to the shared folder, with
    the text only if ``keep_text``.
    """
    df = df.drop("base_spans", "weak_spans", "linked_spans", "spans", "text_key")
    rows = parts(df, text)
    rows = written(rows if keep_text else rows.drop(text), "secrets")
    plain = rows.where(F.col("text_key").isNull()).withColumn("linked_spans", F.expr(f"CAST(NULL AS array<{SPAN}>)"))
    weak = rows.where(F.col("text_key").isNotNull()).join(linked(rows, reach), "text_key", "left")
    both = plain.unionByName(weak)
    spans = F.array_sort(F.concat("base_spans", F.coalesce("linked_spans", F.expr(f"CAST(array() AS array<{SPAN}>)"))))
    return both.withColumn("spans", spans).drop("linked_spans", "weak_spans", "text_key")


def redact(df: DataFrame, text: str = "text", mark: str = "[secret]", reach: int = REACH) -> DataFrame:
    """``df`` with every finding in ``text`` replaced by ``mark``; findings that overlap become one mark."""

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        result = []
        for value, begin, stop in zip(texts.to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True):
            if value is not None and begin:
                pieces, at = [], 0
                for a, b in zip(begin, stop, strict=True):
                    if a >= at:
                        pieces += [value[at:a], mark]
                    at = max(at, b)
                value = "".join([*pieces, value[at:]])
            result.append(value)
        found = pa.array(result, pa.string())
        del result
        trim()
        return found

    df, given = set_aside(df, text)
    found = scan(df, text, reach)
    return given(found.withColumn(text, cleaned(text, "spans.start", "spans.end")))
