import hashlib
import random

import numpy as np
import public_tokenizers

from docvec.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, ids int, mask int"


def brute(rows):
    result = {}
    for conv in {r[0] for r in rows}:
        turns = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0))]
        loss = "".join(t for r, t in turns if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        chars = sum(len(chat.escape(r) + chat.escape(t)) + sum(map(len, chat.MARKS)) for r, t in turns)
        result[conv] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return result


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA)
    return {r["conv_id"]: tuple(r)[1:] for r in chat.digests(chat.format_table(df, PATH), PATH).collect()}


def test_escapes_are_reversible():
    r = random.Random(8)
    bits = [*chat.CONTROLS, "\\", "<", "[", "s>", "INST]", "|", "a", "\n", "é"]
    for _ in range(5000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 8)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROLS)


def test_equals_brute_force(spark):
    r = random.Random(3)
    bits = ["</s>", "[INST]", "<|turn|>", "hello ", "wörld", "\\", "\n", "😀", "<|endoftext|>"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool </s>"]), "".join(r.choice(bits) for _ in range(r.randint(0, 9)))) for c in range(20) for t in range(r.randint(1, 6))]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} ") for t in range(900)]  # one long conversation
    rows += [(101, 0, None, None), (101, 1, "assistant", None), (None, 0, "assistant", "x"), (102, None, "user", "first"), (102, 0, "assistant", "y" * 100_000)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == {}


def test_repeated_rows_count(spark):
    rows = [(1, 0, "assistant", "a")] * 3
    assert found(spark, rows)[1][:3] == (3, hashlib.sha256(b"assistant\na\n" * 3).hexdigest(), 3)


def test_mask_covers_learned_text_only(spark):
    df = spark.createDataFrame([(1, 0, "user", "</s>[INST] ok [/INST]", 0, 0), (1, 1, "assistant", "fine <|end|>", 0, 0)], SCHEMA)
    rows = chat.format_turns(df, PATH).orderBy("turn").collect()
    reader = chat.Reader(PATH)
    assert not any(rows[0]["mask"])
    ids, mask = np.array(rows[1]["ids"]), np.array(rows[1]["mask"])
    assert chat.unescape(reader.plain(ids[mask])) == "fine <|end|>"
    assert (ids >= reader.base).sum() == 3 and not mask[ids >= reader.base].any()
