"""Chat formatting at the level of tokens.

Every turn is ``TURN role TEXT text END``. Role and text are encoded on their own, and the three
marks are spliced in as reserved ids that no encoded text can hold, so a turn can be read back
from its ids. Control strings inside roles and texts are escaped, so a rendering as text can be
read back too.
"""

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvec.cluster import written

# The marks of this template, and strings that other templates and tokenizers read
# as commands.
MARKS = ("<|turn|>", "<|text|>", "<|end|>")
CONTROLS = (
    *MARKS,
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
    "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
)
CONTROL = "|".join(map(re.escape, CONTROLS))
# A control string is broken after its first character, wherever one begins.
BREAK = re.compile(rf"(?=({CONTROL}))(.)", re.S)
STARTS = {c[0] for c in CONTROLS}
LEARNED = ("assistant",)


def escape(text: str) -> str:
    r"""``text`` without control strings: ``\`` is doubled, and one stands after the first character of each of them."""
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    return BREAK.sub(r"\2\\", text) if any(c in text for c in STARTS) else text


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


def byte_table(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
    tokens = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in tokens]


def loaded(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def assemble(tokenizer, roles: list[str], texts: list[str], learned: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all turns one after the other, the loss mask over them, and the ids of each turn."""
    base, n = tokenizer.get_vocab_size(), len(roles)
    segments = [s for pair in zip(map(escape, roles), map(escape, texts), strict=True) for s in pair]
    encoded = [e.ids for e in tokenizer.encode_batch_fast(segments, add_special_tokens=False)]
    marks = [[base], [base + 1], [base + 2]]
    parts = [x for i in range(n) for x in (marks[0], encoded[2 * i], marks[1], encoded[2 * i + 1], marks[2])]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ids = np.fromiter((i for p in parts for i in p), np.int32, int(sizes.sum()))
    ends = np.cumsum(sizes)
    # +1 where a learned text begins, -1 where it ends; the running sum is the mask.
    steps = np.zeros(len(ids) + 1, np.int8)
    take = np.array([r in learned for r in roles], dtype=bool)
    np.add.at(steps, (ends - sizes)[3::5][take], 1)
    np.add.at(steps, ends[3::5][take], -1)
    return ids, np.cumsum(steps[:-1]).astype(bool), sizes.reshape(-1, 5).sum(axis=1) if n else sizes


def format_turns(df: DataFrame, tokenizer: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """One row per turn: ``conv_id``, ``turn``, ``ids`` and ``mask``, true on ids that are learned.

    ``tokenizer`` is the path of a byte-level vocabulary of the tokenizers library; the marks take
    the three ids after its last one. A null role or text is empty. Every row is kept, repeated
    ones too; turns follow one another as sorted by ``turn`` (null first), then by their ids.
    """

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(tokenizer)
        for batch in batches:
            roles, texts = (pc.fill_null(batch.column(i), "").to_pylist() for i in (2, 3))
            ids, mask, sizes = assemble(coder, roles, texts, learned)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, t)) for x, t in ((ids, pa.int32()), (mask, pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], ["conv_id", "turn", "ids", "mask"])

    rows = df.select(F.col(conv).cast("long"), F.col(turn).cast("long"), F.col(role), F.col(text))
    return rows.mapInArrow(formatted, "conv_id long, turn long, ids array<int>, mask array<boolean>")


class Reader:
    """Turns back from ids."""

    def __init__(self, tokenizer: str):
        coder = loaded(tokenizer)
        self.base, self.table = coder.get_vocab_size(), byte_table(coder)

    def plain(self, ids: np.ndarray) -> str:
        return b"".join([self.table[i] for i in ids.tolist()]).decode("utf-8")

    def turn(self, ids: np.ndarray) -> tuple[str, str]:
        """Role and text, still escaped."""
        at = np.flatnonzero(ids >= self.base)
        if ids[at].tolist() != [self.base, self.base + 1, self.base + 2] or at[0] != 0 or at[2] != len(ids) - 1:
            raise ValueError("not a formatted turn")
        return self.plain(ids[1 : at[1]]), self.plain(ids[at[1] + 1 : -1])


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame, tokenizer: str) -> DataFrame:
    """One row per conversation, read back from its formatted turns.

    Turns are dealt out by conversation and sorted, and a task reads them as a stream: of a
    conversation it keeps two running hashes and four numbers, however long it is.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now, done = Reader(tokenizer), None, []

        def closed(state: dict) -> dict:
            return state | {"turns_sha256": state["turns_sha256"].hexdigest(), "loss_sha256": state["loss_sha256"].hexdigest()}

        for batch in batches:
            convs, ids, mask = batch.column("conv_id").to_pylist(), batch.column("ids"), batch.column("mask")
            for i, conv in enumerate(convs):
                if now is None or now["conv_id"] != conv:
                    if now is not None:
                        done.append(closed(now))
                    now = {"conv_id": conv, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0, "loss_sha256": hashlib.sha256(), "formatted_chars": 0}
                own = ids[i].values.to_numpy()
                role, text = reader.turn(own)
                now["n_turns"] += 1
                now["turns_sha256"].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                learned = unescape(reader.plain(own[mask[i].values.to_numpy(zero_copy_only=False)]))
                now["loss_chars"] += len(learned)
                now["loss_sha256"].update(learned.encode())
                now["formatted_chars"] += len(role) + len(text) + sum(map(len, MARKS))
            yield pa.RecordBatch.from_pylist(done, schema=SCHEMA)
            done = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([closed(now)], schema=SCHEMA)

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return dealt.mapInArrow(read, DIGESTS)


SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def format_table(df: DataFrame, tokenizer: str, **columns: str) -> DataFrame:
    """The formatted turns as a written table."""
    return written(format_turns(df, tokenizer, **columns), "chat")


