"""URL filters: all rules run at once as one bit-parallel automaton over each URL.

Every rule is a chain of bits in a vector of 64-bit words. A URL is read character by
character; one shift, one mask and one mask of self-loops move the chains of all rules, and a
whole Arrow batch of URLs moves together.
"""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"://([^/?#]*)([^?#]*)"
# Symbols that are no character of a rule: any such character, and the border of host and path.
OTHER, BORDER = 0, 1


@dataclass(frozen=True)
class Rule:
    """A host and a path pattern with a verdict.

    A rule fits its host and all subdomains, if the URL's path starts with the rule's path.
    ``*`` stands for any run of characters and ``?`` for one, both within host or path.
    """

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


class Automaton:
    """Extended Shift-And over the symbols of ``host BORDER path``, in as many words as needed."""

    def __init__(self, rules: Sequence[Rule]):
        # The longest rule wins, then the blocking one, then by code points.
        self.rules = sorted(set(rules), key=lambda r: (-len(r.name), r.verdict != BLOCK, r.name))
        chars = sorted({".", *(c for r in self.rules for c in r.host + r.path if c not in "*?")})
        self.alphabet = np.array([ord(c) for c in chars], dtype=np.uint32)
        index = {c: i + 2 for i, c in enumerate(chars)}
        everything = range(len(chars) + 2)
        within = [s for s in everything if s != BORDER]
        accepts, loops, starts, finals = [], [], [], []  # of each bit: symbols it takes, symbols it stays on
        for r in self.rules:
            ends = []
            for subdomain in (False, True):
                starts.append(len(accepts))
                accepts.append([])
                loops.append(within if subdomain else [])
                if subdomain:
                    accepts.append([index["."]])
                    loops.append([])
                for c in [*r.host, None, *r.path]:
                    if c == "*":
                        loops[-1] = within
                    else:
                        accepts.append([BORDER] if c is None else within if c == "?" else [index[c]])
                        loops.append([])
                loops[-1] = everything
                ends.append(len(accepts) - 1)
            finals.append(ends)
        self.finals, self.words = finals, len(accepts) // 64 + 1
        self.take, self.stay = self.masks(accepts), self.masks(loops)
        self.start = np.zeros(self.words, dtype=np.uint64)
        for i in starts:
            self.start[i // 64] |= np.uint64(1 << i % 64)

    def masks(self, bits: list) -> np.ndarray:
        table = np.zeros((len(self.alphabet) + 2, self.words), dtype=np.uint64)
        for i, symbols in enumerate(bits):
            for s in symbols:
                table[s, i // 64] |= np.uint64(1 << i % 64)
        return table

    def symbols(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        place = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[place] == codes, place + 2, OTHER)

    def best(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """For each URL the number of its winning rule, or -1."""
        n = len(hosts)
        result = np.full(n, -1)
        if not self.rules or not n:
            return result
        parts = [x for h, p in zip(hosts, paths, strict=True) for x in (h, p)]
        flat, lengths = self.symbols("".join(parts)), np.array([len(x) for x in parts])
        borders = np.cumsum(lengths)[0::2]
        flat = np.insert(flat, borders, BORDER)
        size = lengths[0::2] + lengths[1::2] + 1
        order = np.argsort(-size, kind="stable")
        offset, size = (np.cumsum(size) - size)[order], size[order]
        state = np.tile(self.start, (n, 1))
        for at in range(int(size[0])):
            k = int(np.searchsorted(-size, -at, side="left"))  # URLs with a character here
            symbol, now = flat[offset[:k] + at], state[:k]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:k] = (moved & self.take[symbol]) | (now & self.stay[symbol])
        found = np.full(n, -1)
        for i in range(len(self.rules) - 1, -1, -1):
            for bit in self.finals[i]:
                found[(state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1] = i
        result[order] = found
        return result


def judge(df: DataFrame, rules: Sequence[Rule], rest: Sequence[Rule] = (), url: str = "url") -> DataFrame:
    """``df`` with the columns ``host``, ``path``, ``rule`` and ``verdict``.

    The longest of ``rules`` that fits names the verdict; ``rule`` is its host and path. Where
    none fits, the longest of ``rest`` that fits gives the verdict and ``rule`` is null; where
    none fits either, the URL is allowed. A URL that is null, empty or without ``://`` has an
    empty host and path. Columns of ``df`` with these names are replaced, all rows are kept.
    """
    first, second = Automaton(rules), Automaton(rest)

    @F.arrow_udf("struct<rule:string,verdict:string>")
    def verdicts(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        hosts, paths = (pc.fill_null(x, "").to_pylist() for x in (hosts, paths))
        named, other = first.best(hosts, paths).tolist(), second.best(hosts, paths).tolist()
        return pa.StructArray.from_arrays(
            [
                pa.array([first.rules[i].name if i >= 0 else None for i in named], pa.string()),
                pa.array(
                    [
                        first.rules[i].verdict if i >= 0 else second.rules[j].verdict if j >= 0 else ALLOW
                        for i, j in zip(named, other, strict=True)
                    ],
                    pa.string(),
                ),
            ],
            ["rule", "verdict"],
        )

    parts = df.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    both = parts.withColumn("verdict", verdicts("host", "path"))
    return both.withColumns({"rule": F.col("verdict.rule"), "verdict": F.col("verdict.verdict")})
