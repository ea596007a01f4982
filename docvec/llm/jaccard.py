"""Exact Jaccard join of word n-gram sets through a token-group matrix.

Documents are sets of shingles. A link needs 80 % of either set in common, so only documents that
share as much with any others can have one; they are the candidates. Similar candidates are put
into groups. The matrix says which tokens occur in a group at the head of a member's list, with
rare tokens first. Two groups that share no such token hold no link (the prefix rule). For the
rest, a member is compared with another group only if its overlap with the union of that group's
tokens could make a link. Exact copies are one set from the start, and groups whose members are
connected already are not opened again, so copies never become pairs.

Shingles are compared by 48-bit hashes of theirs: two different ones of a pair of documents are
taken as equal once in about 10**14 comparisons. Sets are told apart by 64-bit hashes.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvec.cluster import written
from docvec.llm.kernels import mix, pack48, set_aside, shingle_sets, slices, trim, unpack48

SHINGLE = 5
PERCENT = 80
# Tokens that a task gathers before it hands them on by bucket, and tokens of a bucket.
FLUSH, BUCKET = 1 << 18, 1_000_000
LEAST_BUCKETS = 256
# Rows of the matrix that name their pairs in one task.
ROWS = 500_000
# Bounds of a group, and partners that one group meets in a task.
MEMBERS, GROUP_TOKENS, PARTNERS = 256, 400_000, 32
LOW48 = np.uint64((1 << 48) - 1)


def node_of(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def sets(df: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """``key``, ``node`` (the set's hash, null if it is empty) and ``n`` (its size)."""

    @F.arrow_udf("struct<node:bigint,n:bigint>")
    def counted(texts: pa.Array) -> pa.Array:
        found = [(node_of(s) if len(s) else None, len(s)) for _, part in slices(texts) for s in shingle_sets(part, shingle)]
        trim()
        return pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], ["node", "n"])

    return df.select(F.col(key).alias("key"), counted(text).alias("s")).select("key", "s.node", "s.n")


def dealt(df: DataFrame, text: str, shingle: int, buckets: int) -> DataFrame:
    """The tokens of all sets by bucket: one row per bucket and quarter of a million tokens of a task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        seen: set[int] = set()

        def flush() -> pa.RecordBatch:
            sizes = np.array([len(t) for _, t in held])
            nodes = np.array([x for x, _ in held], np.int64)
            tokens = np.concatenate([t for _, t in held]) >> np.uint64(16)
            owner = np.repeat(np.arange(len(held), dtype=np.int32), sizes)
            bucket = (tokens % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, tokens, owner = bucket[order], tokens[order], owner[order]
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
            found = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = owner[a:b]
                first = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
                who = own[first]
                found.append({
                    "bucket": int(bucket[a]), "nodes": nodes[who].tobytes(), "sizes": sizes[who].astype(np.int32).tobytes(),
                    "counts": np.diff(first, append=b - a).astype(np.int32).tobytes(), "tokens": pack48(tokens[a:b]),
                })
            held.clear()
            return pa.RecordBatch.from_pylist(found, schema=DEALT)

        waiting = 0
        for batch in batches:
            for _, part in slices(batch.column(0)):
                for s in shingle_sets(part, shingle):
                    if not len(s) or (node := node_of(s)) in seen:
                        continue
                    if len(seen) >= 100_000:  # copies that this forgets are told apart by the bucket
                        seen.clear()
                    seen.add(node)
                    held.append((node, s))
                    waiting += len(s)
                if waiting >= FLUSH:
                    yield flush()
                    waiting = 0
        if held:
            yield flush()
        trim()

    return df.select(text).mapInArrow(rows, "bucket long, nodes binary, sizes binary, counts binary, tokens binary")


DEALT = pa.schema([("bucket", pa.int64()), ("nodes", pa.binary()), ("sizes", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())])


def array(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def binaries(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive pieces of an array as a column of binaries."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * data.itemsize
    if ends[-1] < 1 << 31:
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
    raw = data.tobytes()
    return pa.array([raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())


def shared(bucket: pa.Table) -> pa.Table:
    """Of one bucket: for every set the tokens that other sets have too, with the number of sets that have them.

    Token and number stand in one word, the number (65,535 at most) in the upper 16 bits.
    """
    nodes, sizes, counts = array(bucket.column("nodes"), np.int64), array(bucket.column("sizes"), np.int32), array(bucket.column("counts"), np.int32)
    tokens = np.concatenate([unpack48(x) for x in bucket.column("tokens").to_pylist()])
    ends = np.cumsum(counts, dtype=np.int64)
    _, first = np.unique(nodes, return_index=True)  # a copy that several tasks sent counts once
    owner = np.full(len(nodes), -1, np.int64)
    owner[first] = first
    of = np.repeat(owner, counts)
    order = np.argsort(tokens, kind="stable")
    order = order[of[order] >= 0]
    ranked = tokens[order]
    edges = np.concatenate([[0], np.flatnonzero(ranked[1:] != ranked[:-1]) + 1, [len(ranked)]])
    often = np.repeat(np.diff(edges), np.diff(edges))
    number = np.zeros(len(tokens), np.uint64)
    number[order] = np.minimum(often, 0xFFFF).astype(np.uint64)
    kept = np.flatnonzero(number > 1)
    values = number[kept] << np.uint64(48) | tokens[kept]
    row = np.searchsorted(ends, kept, side="right")
    who, n = np.unique(row, return_counts=True)
    return pa.Table.from_arrays([pa.array(nodes[who]), pa.array(sizes[who]), binaries(values, n)], ["node", "n", "shared"])


def least_overlap(n: int, percent: int) -> int:
    """The fewest tokens that a set of ``n`` has in common with any set it links with."""
    return -(-percent * n // 100)


def candidates(parts: DataFrame, percent: int) -> DataFrame:
    """Sets that share enough with others: ``node``, ``n``, ``tokens`` (shared, rare ones first), ``head`` (tokens of the prefix), two hashes for grouping."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, n, pieces in zip(*[batch.column(k).to_pylist() for k in ("node", "n", "pieces")], strict=True):
                values = np.frombuffer(b"".join(pieces), np.uint64)
                head = len(values) - least_overlap(n, percent) + 1
                if head > 0:
                    tokens = np.sort(values) & LOW48
                    hashed = np.partition(mix(tokens), min(1, len(tokens) - 1))[:2].astype(np.int64)
                    rows.append({"node": node, "n": n, "tokens": pack48(tokens), "head": head, "h1": int(hashed[0]), "h2": int(hashed[-1])})
            yield pa.RecordBatch.from_pylist(rows, schema=CANDIDATES)
        trim()

    whole = parts.groupBy("node").agg(F.first("n").alias("n"), F.collect_list("shared").alias("pieces"))
    return whole.mapInArrow(chosen, "node long, n int, tokens binary, head int, h1 long, h2 long")


CANDIDATES = pa.schema([("node", pa.int64()), ("n", pa.int32()), ("tokens", pa.binary()), ("head", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])


class Forest:
    """Union-find over numbers from 0; the smallest number stands for its set."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = sorted((self.top(i), self.top(j)))
        self.up[j] = i


class Group:
    """Members' token lists, with the union of their tokens and who has each."""

    def __init__(self, n: np.ndarray, lists: list[np.ndarray]):
        self.n, self.lists = n, lists
        tokens = np.concatenate(lists)
        member = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(tokens, kind="stable")
        self.member = member[order]
        self.union, self.start = np.unique(tokens[order], return_index=True)
        self.start = np.append(self.start, len(tokens))

    def links(self, n: int, tokens: np.ndarray, percent: int, before: int | None = None) -> np.ndarray:
        """Members (numbered below ``before``) that a set links with."""
        place = np.searchsorted(self.union, tokens)
        place[place == len(self.union)] = 0
        place = place[self.union[place] == tokens]
        if len(place) < least_overlap(n, percent):  # not even the union overlaps enough
            return np.empty(0, np.int64)
        size = self.start[place + 1] - self.start[place]
        spots = np.repeat(self.start[place] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        common = np.bincount(self.member[spots], minlength=len(self.n))
        linked = np.flatnonzero((100 + percent) * common >= percent * (n + self.n.astype(np.int64)))
        linked = linked[common[linked] > 0]
        return linked if before is None else linked[linked < before]


GROUPS = "gid long, members int, nodes binary, comps binary, sizes binary, counts binary, heads binary, tokens binary"


def groups(chosen: DataFrame, percent: int) -> DataFrame:
    """Groups of similar candidates, a row each, with what their own members link to already.

    Candidates are sorted by the two smallest hashes of their tokens; a group is a run with the
    same smallest one, cut where it would grow too large for a row. ``comps`` names for each
    member the first node of its own group that it is connected with.
    """

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, tokens = TaskContext.get().partitionId(), 0, [], 0

        def row() -> dict:
            lists = [x[2] for x in held]
            n, forest = np.array([x[1] for x in held], np.int32), Forest(len(held))
            if len(held) > 1:
                group = Group(n, lists)
                for i in range(1, len(held)):
                    for j in group.links(int(n[i]), lists[i], percent, before=i).tolist():
                        forest.join(i, j)
            nodes = np.array([x[0] for x in held], np.int64)
            return {
                "gid": (part << 32) + seq, "members": len(held), "nodes": nodes.tobytes(), "sizes": n.tobytes(),
                "comps": nodes[[forest.top(i) for i in range(len(held))]].tobytes(),
                "counts": np.array([len(x) for x in lists], np.int32).tobytes(),
                "heads": np.array([x[3] for x in held], np.int32).tobytes(), "tokens": pack48(np.concatenate(lists)),
            }

        now = None
        for batch in batches:
            done = []
            for node, n, packed, head, h1 in zip(*[batch.column(k).to_pylist() for k in ("node", "n", "tokens", "head", "h1")], strict=True):
                own = unpack48(packed)
                if held and (h1 != now or len(held) >= MEMBERS or tokens + len(own) > GROUP_TOKENS):
                    done.append(row())
                    held, tokens, seq = [], 0, seq + 1
                now = h1
                held.append((node, n, own, head))
                tokens += len(own)
            yield pa.RecordBatch.from_pylist(done, schema=GROUP_SCHEMA)
        if held:
            yield pa.RecordBatch.from_pylist([row()], schema=GROUP_SCHEMA)

    ordered = chosen.repartitionByRange("h1", "h2", "node").sortWithinPartitions("h1", "h2", "node")
    return ordered.mapInArrow(grouped, GROUPS)


GROUP_SCHEMA = pa.schema(
    [("gid", pa.int64()), ("members", pa.int32()), *[(k, pa.binary()) for k in ("nodes", "comps", "sizes", "counts", "heads", "tokens")]]
)


def opened(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Components, set sizes and token lists of a group's members."""
    comps, sizes, counts, tokens = (row[f"{prefix}{k}"] for k in ("comps", "sizes", "counts", "tokens"))
    lists = np.split(unpack48(tokens), np.cumsum(np.frombuffer(counts, np.int32))[:-1])
    return np.frombuffer(comps, np.int64), np.frombuffer(sizes, np.int32), lists


def matrix(table: DataFrame) -> DataFrame:
    """Which tokens stand at the head of a member's list in which group: one row per token, group and component.

    ``low`` and ``high`` are the smallest and largest set size of these members.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.to_pylist():
                comps, sizes, lists = opened(group)
                heads = np.frombuffer(group["heads"], np.int32)
                tokens = np.concatenate([x[:h] for x, h in zip(lists, heads.tolist(), strict=True)])
                comp, size = np.repeat(comps, heads), np.repeat(sizes, heads)
                order = np.lexsort((size, comp, tokens))
                tokens, comp, size = tokens[order], comp[order], size[order]
                first = np.concatenate([[0], np.flatnonzero((tokens[1:] != tokens[:-1]) | (comp[1:] != comp[:-1])) + 1])
                last = np.append(first[1:], len(tokens)) - 1
                n = len(first)
                columns = [tokens[first].astype(np.int64), np.full(n, group["gid"]), np.full(n, group["members"], np.int32), comp[first], size[first], size[last]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "gid", "members", "comp", "low", "high"])

    return table.select("gid", "members", "comps", "sizes", "counts", "heads", "tokens").mapInArrow(
        rows, "token long, gid long, members int, comp long, low int, high int"
    )


def meet(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """Links between the components of the groups ``a`` and ``b`` of every pair: ``u``, ``v``, at most one per two components and pair."""
    partners = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("shares"))
    split = written(pairs.join(partners, "a").select("a", "b", F.pmod(F.xxhash64("b"), "shares").alias("share")), "pairs")
    blobs = table.select("gid", "comps", "sizes", "counts", "tokens")
    left = split.select("a", "share").distinct().join(blobs, F.col("a") == F.col("gid")).drop("gid")
    right = split.join(blobs, F.col("b") == F.col("gid")).drop("gid", "b")
    right = right.toDF(*[f"o_{c}" for c in right.columns])

    def compare(one: pa.Table, many: pa.Table) -> pa.Table:
        found: set[tuple[int, int]] = set()
        if one.num_rows:
            comps, sizes, lists = opened(one.to_pylist()[0])
            group = Group(sizes, lists)
            for row in many.to_pylist():
                for comp, n, tokens in zip(*opened(row, "o_"), strict=True):
                    found |= {(int(comp), int(c)) for c in np.unique(comps[group.links(int(n), tokens, percent)]) if c != comp}
        return pa.Table.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["u", "v"])

    return left.groupBy("a", "share").cogroup(right.groupBy("o_a", "o_share")).applyInArrow(compare, "u long, v long")


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def open_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups, ``a`` below ``b``, that share a token with members of different components and near sizes.

    Two groups of near copies share many tokens. Tokens whose rows are mostly of one component
    (``most``) go to one task together, which names each pair once; a component with very many
    rows is split by token over several tasks.
    """
    shares = rows.groupBy("most").agg(F.ceil(F.count("*") / ROWS).alias("shares"))
    spread = rows.join(shares, "most").withColumn("share", F.pmod(F.xxhash64("token"), "shares"))

    def pairs(table: pa.Table) -> pa.Table:
        token, gid, comp, low, high = (table.column(k).to_numpy() for k in ("token", "gid", "comp", "low", "high"))
        names, group = np.unique(gid, return_inverse=True)
        order = np.lexsort((group, token))
        token, group, comp, low, high = (x[order] for x in (token, group, comp, low, high))
        cuts = [0, *(np.flatnonzero(token[1:] != token[:-1]) + 1).tolist(), len(token)]
        found, waiting = [np.empty(0, np.int64)], 0
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            for i in range(a, b - 1):
                rest = slice(i + 1, b)
                fits = (group[rest] > group[i]) & (comp[rest] != comp[i]) & (high[rest] * 100 >= low[i] * percent) & (high[i] * 100 >= low[rest] * percent)
                found.append(group[i] * len(names) + group[rest][fits])
                waiting += len(found[-1])
            if waiting > 1 << 21:
                found, waiting = [np.unique(np.concatenate(found))], 0
        code = np.unique(np.concatenate(found))
        return pa.Table.from_arrays([pa.array(names[code // len(names)]), pa.array(names[code % len(names)])], schema=PAIRS)

    columns = spread.select("most", "share", "token", "gid", "comp", F.col("low").cast("long"), F.col("high").cast("long"))
    return columns.groupBy("most", "share").applyInArrow(pairs, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the same for connected nodes; only nodes of edges are named.

    Every round sends each node to its smallest neighbour, follows that twice, and contracts the
    edges; all steps are joins and sums that split hot nodes. A round at least halves the nodes of
    a component, so the rounds are few.
    """
    edges = written(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    labels = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("label", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), "parents")
        for _ in range(2):
            further = up.select(F.col("u").alias("p"), F.col("p").alias("q"))
            up = written(up.join(further, "p", "left").select("u", F.coalesce("q", "p").alias("p")), "parents")
        to = up.select(F.col("u").alias("label"), "p")
        labels = written(labels.join(to, "label", "left").select("node", F.coalesce("p", "label").alias("label")), "labels")
        moved = edges.join(up.withColumnRenamed("p", "pu"), "u").join(up.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v")
        edges = moved.where("pu <> pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
        edges = written(edges.distinct(), "edges")
    return labels


def linked_nodes(df: DataFrame, text: str, shingle: int, percent: int, total: int) -> DataFrame:
    """``node`` and ``label`` of all sets that link with another one."""
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET))
    parts = dealt(df, text, shingle, buckets).groupBy("bucket").applyInArrow(shared, "node long, n int, shared binary")
    chosen = written(candidates(parts, percent), "candidates")
    table = written(groups(chosen, percent), "groups")
    tokens = written(matrix(table), "matrix")

    def open_tokens(rows: DataFrame, *more) -> DataFrame:
        """Tokens of more than one component."""
        found = rows.groupBy("token").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), *more)
        return found.where("c1 <> c2").drop("c1", "c2")

    # First every group of a token meets the largest one; that connects most of what is similar.
    largest = F.max(F.struct("members", (-F.col("gid")).alias("g"))).alias("top")
    center = open_tokens(tokens, largest).select("token", (-F.col("top.g")).alias("a"))
    star = tokens.select("token", F.col("gid").alias("b")).join(center, "token").where("a <> b").select("a", "b").distinct()
    star = written(star, "star")
    first = written(meet(star, table, percent), "links")
    # Then all groups of a token meet that still hold different components.
    known = components(first).select(F.col("node").alias("comp"), "label")
    now = tokens.join(known, "comp", "left").withColumn("comp", F.coalesce("label", "comp")).drop("label", "members")
    often = F.mode("comp", True).alias("most")
    now = written(now.join(open_tokens(now, often), "token"), "open")
    rest = open_pairs(now, percent)
    done = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = meet(rest.join(done, ["a", "b"], "left_anti"), table, percent)

    own = table.select(F.arrays_zip(longs("nodes").alias("u"), longs("comps").alias("v")).alias("m")).select(F.inline("m"))
    return components(first.unionByName(second).unionByName(own.toDF("u", "v")))


def longs(column: str):
    @F.arrow_udf("array<bigint>")
    def unpacked(values: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x, np.int64) for x in values.to_pylist()], pa.list_(pa.int64()))

    return unpacked(column)


def join(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``df``: the key, ``n_shingles`` and ``component_id``.

    Words are runs of characters other than space and 9 to 13, A-Z in lower case. Two rows link
    if ``100 * intersection >= percent * union`` of their distinct shingles of ``shingle`` words;
    a text with fewer words has its whole sequence as its one shingle. ``component_id`` is the
    smallest key reachable by links, the row's own included. A null, empty or blank text has
    0 shingles and is a component of its own, of its own key. Rows with equal keys are rows of
    their own; a null key is used only where a component has no other. An empty table gives none.
    """
    found = written(sets(df, key, text, shingle), "sets")
    full = found.where("n > 0")
    total = full.agg(F.sum("n")).head()[0] or 0
    labels = linked_nodes(df, text, shingle, percent, total)
    classes = full.groupBy("node").agg(F.min("key").alias("least")).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    component = written(classes.join(smallest, "label").select("node", "component_id"), "components")
    whole = full.join(component, "node").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")
    alone = found.where("n = 0").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("key").alias("component_id"))
    return whole.unionByName(alone)


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``df`` with one row of each component: that of the smallest key, of equal keys that of the smallest text hash.

    Rows that repeat a key with the same text are one row. A row without words is a component of
    its own and stays. All columns are kept as they are.
    """
    df, given = set_aside(df, key, text)
    spot = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("hash"))
    found = join(df.select(spot.alias("spot"), F.col(text).alias("text")), "spot", "text", shingle, percent)
    chosen = found.where(F.col("spot").eqNullSafe(F.col("component_id"))).select(F.col("spot.key").alias("kept_key"), F.col("spot.hash").alias("kept_hash"))
    rows = df.select("*", F.xxhash64(text).alias("row_hash"))
    here = F.col(key).eqNullSafe(F.col("kept_key")) & (F.col("row_hash") == F.col("kept_hash"))
    return given(rows.join(written(chosen, "kept"), here, "left_semi").dropDuplicates([key, "row_hash"]))
