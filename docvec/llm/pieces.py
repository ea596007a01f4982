"""SentencePiece encoding and decoding by a Viterbi search that words with a common prefix share.

A text is cut into marked words, which no piece crosses. The distinct new words of a batch are
sorted, which lays them out as a trie, and walked depth-first: the forward states of the prefix a
word has in common with the one before it are kept. A state holds the best way to spell a prefix.

What is best depends on the model. In a unigram model it is the largest sum of scores. In a BPE
model scores are the order of merges, and a spelling is the encoder's if and only if every two
neighbours in it are what merging their joined text gives; all other transitions are impossible,
so one path is left, and the ids are those of the library.
"""

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvec.llm.kernels import STEP, KnownWords, distinct_spans, long_hashes, slices, trim, utf8

SPACE = "▁"
# Distinct words, and pairs of neighbours, that a worker remembers; beyond them it starts anew.
WORDS_KEPT, PAIRS_KEPT = 450_000, 200_000
# Bytes of texts encoded at a time, unless one text is longer.
ENCODED = STEP // 4
UNKNOWN_PENALTY = 10.0


class Pieces:
    """The pieces of a model: strings, scores, bytes, and an automaton that finds those that end at a place."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names, scores = [self.model.id_to_piece(i) for i in range(n)], [self.model.get_score(i) for i in range(n)]
        bytewise = {i: int(names[i][3:-1], 16) for i in range(n) if self.model.is_byte(i)}
        usable = [i for i in range(n) if i not in bytewise and not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i))]
        self.names, self.scores = names, scores
        self.id_of = {names[i]: i for i in usable}
        self.byte_id = {b: i for i, b in bytewise.items()}
        self.unknown = self.model.unk_id()
        self.worst = min((scores[i] for i in usable), default=0.0) - UNKNOWN_PENALTY
        # Scores of a BPE model are minus the ranks of its merges.
        self.bpe = all(s <= 0 and s == int(s) for s in scores)
        self.table = [b""] * n
        for i in usable:
            self.table[i] = utf8(names[i].replace(SPACE, " "))
        for i, b in bytewise.items():
            self.table[i] = bytes([b])
        self.prefix = self.model.decode(self.model.encode(" ")) == " " and self.model.normalize("a").startswith(SPACE)
        # Marked words begin with a run of marks. No piece goes across two neighbours that stand side
        # by side in none, so a word may end between two such characters too.
        self.whole = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of)
        self.apart = np.zeros((256, 256), bool)  # of ASCII characters
        self.apart[:128, :128] = True
        for p in self.id_of:
            for before, c in zip(p, p[1:]):
                if before.isascii() and c.isascii():
                    self.apart[ord(before), ord(c)] = False
        self.moves: list[dict[str, int]] = []  # grown when first needed, which decoding never does

    def cut(self, raw: bytes, starts: np.ndarray) -> np.ndarray:
        """Where words begin in normalized texts that stand one after the other and begin at ``starts``."""
        data = np.frombuffer(raw, np.uint8)
        begins = np.zeros(len(data), bool)
        begins[starts[starts < len(data)]] = True
        if not self.whole:
            begins[1:] |= self.apart[data[:-1], data[1:]]
            if len(data) > 2:
                mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
                begins[mark[np.diff(mark, prepend=-9) != 3]] = True  # the first of each run of marks
        return np.flatnonzero(begins)

    def grow(self) -> None:
        """Aho-Corasick automaton: for each state its moves, and the pieces that end there, longest first."""
        self.moves = [{}]
        own: list[int | None] = [None]
        for name, i in self.id_of.items():
            state = 0
            for c in name:
                if c not in self.moves[state]:
                    self.moves[state][c] = len(self.moves)
                    self.moves.append({})
                    own.append(None)
                state = self.moves[state][c]
            own[state] = i
        self.back = [0] * len(self.moves)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(self.moves)
        layer, depth = list(self.moves[0].values()), 1
        while layer:
            further = []
            for state in layer:
                piece = own[state]
                self.ending[state] = (() if piece is None else ((depth, piece),)) + self.ending[self.back[state]]
                for c, after in self.moves[state].items():
                    back = self.back[state]
                    while back and c not in self.moves[back]:
                        back = self.back[back]
                    self.back[after] = self.moves[back].get(c, 0)
                    further.append(after)
            layer, depth = further, depth + 1

    def step(self, state: int, c: str) -> int:
        while state and c not in self.moves[state]:
            state = self.back[state]
        return self.moves[state].get(c, 0)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging gives: always the neighbours with the best score together, the first of equals."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.scores[i], k) for k in range(len(parts) - 1) if (i := self.id_of.get(parts[k] + parts[k + 1])) is not None]
            if not found:
                break
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts


def pair_key(left: int, right: int) -> int:
    return (left << 32) + right


class Coder:
    """Encodes texts; remembers words and pairs of neighbours."""

    def __init__(self, path: str, kept: int = WORDS_KEPT):
        self.pieces, self.kept = Pieces(path), kept
        self.neighbours: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        self.known = KnownWords()
        self.flat, self.starts = np.empty(0, np.int32), np.zeros(1, np.int64)

    def fits(self, left: int, right: int) -> bool:
        """Whether a BPE encoder leaves these two pieces side by side; a negative ``left`` is none."""
        p = self.pieces
        if len(self.neighbours) >= PAIRS_KEPT:
            self.neighbours.clear()
        names = [p.names[i] for i in (left, right) if i >= 0]
        ok = self.neighbours[pair_key(left, right)] = p.merged("".join(names)) == names
        return ok

    def walk(self, words: list[str]) -> Iterator[list[int]]:
        """The ids of each of the words, which are sorted.

        The forward states of a prefix are the automaton's state, the last piece of the best way
        to spell it (-1 for none or an unknown character), that piece's length, and in a unigram
        model the sum of scores. They stand on stacks that keep what two words have in common.
        """
        p = self.pieces
        if not p.moves:
            p.grow()
        bpe, ending, scores, moves, known = p.bpe, p.ending, p.scores, p.moves, self.neighbours
        automata, lasts, lengths, sums = [0], [-1], [0], [0.0]
        before = ""
        for word in words:
            common, most = 0, min(len(before), len(word))
            while common < most and before[common] == word[common]:
                common += 1
            for stack in (automata, lasts, lengths, sums):
                del stack[common + 1 :]
            state, at = automata[common], common
            for c in word[common:]:
                at += 1
                further = moves[state].get(c)
                state = p.step(state, c) if further is None else further
                best, size, total = -1, 1, sums[at - 1] + p.worst  # a character that is no piece
                for length, piece in ending[state]:
                    if bpe:
                        last = lasts[at - length]
                        ok = known.get((last << 32) + piece)
                        if self.fits(last, piece) if ok is None else ok:
                            best, size = piece, length
                            break
                    elif best < 0 or sums[at - length] + scores[piece] > total:
                        best, size, total = piece, length, sums[at - length] + scores[piece]
                automata.append(state)
                lasts.append(best)
                lengths.append(size)
                sums.append(total)
            ids = []
            while at:
                if lasts[at] >= 0:
                    ids.append(lasts[at])
                elif p.byte_id:
                    ids += [p.byte_id[b] for b in reversed(utf8(word[at - 1]))]
                else:
                    ids.append(p.unknown)
                at -= lengths[at]
            yield ids[::-1]
            before = word

    def learn(self, words: list[str]) -> None:
        """Ids of new words, kept in the order of ``words``."""
        order = sorted(range(len(words)), key=words.__getitem__)
        found: list[list[int]] = [[]] * len(words)
        for k, ids in zip(order, self.walk([words[k] for k in order]), strict=True):
            found[k] = ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        raw = [utf8(t) for t in (self.pieces.model.normalize(texts) if texts else [])]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
        joined = b"".join(raw)
        begin = self.pieces.cut(joined, bounds[:-1])
        stop = np.append(begin[1:], len(joined)) if len(begin) else begin
        hashes = long_hashes(joined, begin, stop)
        code, first = distinct_spans(joined, begin, stop, hashes)
        if self.known.count > self.kept:
            self.forget()
        number = self.known.find(joined, begin[first], stop[first], hashes[first])
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = np.arange(self.known.count, self.known.count + len(new))
            spots = first[new]
            self.known.add(joined, begin[spots], stop[spots], hashes[spots])
            self.learn([joined[a:b].decode("utf-8", "surrogatepass") for a, b in zip(begin[spots].tolist(), stop[spots].tolist(), strict=True)])
        number = number[code]
        size = self.starts[number + 1] - self.starts[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(self.starts[number] - ends[:-1], size) + np.arange(int(ends[-1]))
        return self.flat[place], np.diff(ends[np.searchsorted(begin, bounds)])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks become spaces, but for the one that encoding sets before a text."""
        text = b"".join(map(self.pieces.table.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.pieces.prefix and text.startswith(" ") else text


class Memo:
    """What a Python worker keeps from one task to the next, when it holds this as a broadcast value."""

    def __init__(self):
        self.held: dict = {}

    def get(self, name: str, make: Callable):
        if name not in self.held:
            self.held[name] = make()
        return self.held[name]


def encode(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``df`` with the column ``ids``; a column of that name is replaced.

    ``model`` is the path of a SentencePiece model. A null text stays null, an empty one has no
    ids. Words and automaton are kept per worker, in bounded memory; the result of a row depends
    on that row alone.
    """
    memo = df.sparkSession.sparkContext.broadcast(Memo())

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        coder = memo.value.get(model, lambda: Coder(model))
        found = [coder.encode(part) for _, part in slices(texts, ENCODED)]
        sizes = np.concatenate([np.empty(0, np.int64), *[n for _, n in found]])
        ids = np.concatenate([np.empty(0, np.int32), *[i for i, _ in found]])
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(ids))
        trim()
        return pc.if_else(texts.is_null(), pa.scalar(None, lists.type), lists) if texts.null_count else lists

    return df.withColumn("ids", encoded(text))


def pieces_of(lists: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each row; none for null."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    at = 0
    for n in sizes.tolist():
        yield flat[at : at + n]
        at += n


def decode(df: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids`` in the column ``text``; null for null."""
    memo = df.sparkSession.sparkContext.broadcast(Memo())

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        coder = memo.value.get(model, lambda: Coder(model))
        valid = lists.is_valid().to_pylist()
        return pa.array([coder.decode(x) if ok else None for x, ok in zip(pieces_of(lists), valid, strict=True)], pa.string())

    return df.withColumn(text, decoded(ids))


def digests(df: DataFrame, ids: str = "ids") -> DataFrame:
    """``df`` with ``n_tokens`` and ``ids_crc32`` of its ids as little-endian 32-bit words; null counts as none."""

    @F.arrow_udf("bigint")
    def crc(lists: pa.Array) -> pa.Array:
        return pa.array([zlib.crc32(x.astype("<i4").tobytes()) for x in pieces_of(lists)], pa.int64())

    return df.withColumns({"n_tokens": F.coalesce(F.size(ids), F.lit(0)).cast("long"), "ids_crc32": crc(ids)})
