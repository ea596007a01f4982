"""Fill in the middle: texts cut in three and put together in another order, by displacement scatter.

All texts of a step are one array of bytes. A scan finds where tokens begin and so the bytes of
the cuts; a difference array holds, at the first byte of each part, by how much the shift of its
bytes differs from that of the part before. The cumulative sum is the shift of every byte, and one
scatter writes the output. Restoring finds the marks in the output, builds the same shifts and
gathers.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvec.llm.kernels import STEP

# The marks before prefix, suffix and middle, and the names of the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMS = (PLAIN, PSM, SPM)
MARK = len(PREFIX)

# Of a hundred texts, how many stay as they are, and how many of the others begin with the suffix.
PLAIN_SHARE = 10
SPM_SHARE = 20

LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
IS_MARK = np.zeros(256, dtype=bool)
IS_MARK[[PREFIX[1], SUFFIX[1], MIDDLE[1]]] = True


def draws(key: Column, seed: int = 1) -> Column:
    """Four numbers below 2**32 that depend on the seed and the row's key only; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)])


def pieces(column: pa.Array, size: int = STEP) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``size`` bytes together: first row, row behind the last, their bytes, and the rows' bounds in them."""
    texts = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, offset=8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    begin = 0
    while begin < len(texts):
        stop = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size, side="right")) - 1)
        yield begin, stop, data[offsets[begin] : offsets[stop]], offsets[begin : stop + 1] - offsets[begin]
        begin = stop


def blocks(n: int, size: int = STEP) -> Iterator[tuple[int, int]]:
    """A range of bytes in steps, so that arrays beside the bytes stay small for a text of any length."""
    return ((a, min(n, a + size)) for a in range(0, n, size))


def token_starts(data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """Where tokens begin, block by block: at each first letter of a run and at each other character."""
    for a, b in blocks(len(data)):
        part = data[a:b]
        letter = LETTER[part]
        inner = np.empty(len(part), dtype=bool)
        inner[0] = a > 0 and LETTER[data[a - 1]]
        inner[1:] = letter[:-1]
        first = bounds[np.searchsorted(bounds, a) : np.searchsorted(bounds, b)] - a
        inner[first] = False
        yield np.flatnonzero(((part & 0xC0) != 0x80) & ~(letter & inner)) + a


def counted(places: Iterator[np.ndarray], bounds: np.ndarray) -> np.ndarray:
    """How many of the ordered places lie between each two bounds."""
    below = np.zeros(len(bounds), dtype=np.int64)
    for found in places:
        below += np.searchsorted(found, bounds)
    return np.diff(below)


def located(places: Iterator[np.ndarray], wanted: np.ndarray, beyond: np.ndarray) -> np.ndarray:
    """The places of the numbers ``wanted`` among all; ``beyond`` where there is no such place."""
    result, seen = beyond.copy(), 0
    for found in places:
        here = (wanted >= seen) & (wanted < seen + len(found))
        result[here] = found[wanted[here] - seen]
        seen += len(found)
    return result


def characters(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Code points before each byte place."""
    order = np.argsort(places, kind="stable")
    ordered, total, seen = places[order], np.zeros(len(places), np.int64), 0
    for a, b in blocks(len(data)):
        sums = np.concatenate([[0], np.cumsum((data[a:b] & 0xC0) != 0x80)])
        here = (ordered > a) & (ordered <= b)
        total[here] = seen + sums[ordered[here] - a]
        seen += int(sums[-1])
    result = np.empty_like(total)
    result[order] = total
    return result


def marks(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where marks begin; bytes of two rows are no mark."""
    found = []
    for a, b in blocks(len(data)):
        end = min(len(data), b + MARK - 1)
        part = data[a:end]
        n = max(0, min(b, end - MARK + 1) - a)
        found.append(np.flatnonzero((part[:n] == PREFIX[0]) & IS_MARK[part[1 : n + 1]] & (part[2 : n + 2] == PREFIX[2])) + a)
    places = np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int64)
    return places[np.searchsorted(bounds, places, side="right") == np.searchsorted(bounds, places + MARK - 1, side="right")]


def displaced(n: int, starts: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Block by block, where each byte goes: the parts' shifts as a difference array, and its cumulative sum.

    Parts are in ascending order of their starts; of parts that start at the same byte all but the
    last are empty, and their differences add up to the shift of that last one.
    """
    steps = np.diff(shifts, prepend=0)
    carried = 0
    for a, b in blocks(n):
        here = slice(*np.searchsorted(starts, [a, b]))
        change = np.zeros(b - a, dtype=np.int64)
        np.add.at(change, starts[here] - a, steps[here])
        change[0] += carried
        shift = np.cumsum(change)
        carried = int(shift[-1])
        yield a, b, shift


def arrange(column: pa.Array, drawn: pa.Array, plain_share: int = PLAIN_SHARE, spm_share: int = SPM_SHARE) -> pa.Array:
    """Each text in its form; see ``transform``."""
    h = np.asarray(drawn.flatten(), dtype=np.int64).reshape(-1, 4)
    n_all, form_all, prefix_all, middle_all, sizes, out = [], [], [], [], [], []
    for row, stop, data, bounds in pieces(column):
        own = h[row:stop]
        first, last = bounds[:-1], bounds[1:]
        n = counted(token_starts(data, bounds), bounds)
        plain = (n == 0) | (own[:, 2] % 100 >= 100 - plain_share)
        plain[np.searchsorted(bounds, marks(data, bounds), side="right") - 1] = True
        spm = ~plain & (own[:, 3] % 100 < spm_share)
        k = np.sort(own[:, :2] % (n + 1)[:, None], axis=1)
        before = np.cumsum(n) - n
        cuts = [located(token_starts(data, bounds), before + k[:, i], last) for i in (0, 1)]
        a, b = (np.where(plain | (k[:, i] == n), last, cuts[i]) for i in (0, 1))
        # In psm the marks of prefix and suffix, in spm those of suffix and prefix and the suffix itself come before.
        moved = np.cumsum(np.where(plain, 0, 3 * MARK))
        base = moved - np.where(plain, 0, 3 * MARK)
        suffix = last - b
        shifts = np.stack(
            [
                base + np.where(plain, 0, np.where(spm, 2 * MARK + suffix, MARK)),
                base + 3 * MARK + suffix,
                base + np.where(spm, MARK - (b - first), 2 * MARK - (b - a)),
            ],
            axis=1,
        )
        result = np.empty(len(data) + int(moved[-1]), dtype=np.uint8)
        for x, y, shift in displaced(len(data), np.stack([first, a, b], axis=1).ravel(), shifts.ravel()):
            result[np.arange(x, y) + shift] = data[x:y]
        begin = first + base
        size = last - first
        at_p = np.where(spm, begin + MARK + suffix, begin)
        at_s = np.where(spm, begin, begin + MARK + a - first)
        at_m = begin + size + 2 * MARK - (b - a)
        for mark, at in ((PREFIX, at_p), (SUFFIX, at_s), (MIDDLE, at_m)):
            for i, byte in enumerate(mark):
                result[at[~plain] + i] = byte
        chars = characters(data, np.concatenate([first, a, b])).reshape(3, -1)
        n_all.append(n)
        form_all.append(np.where(plain, 0, np.where(spm, 2, 1)))
        prefix_all.append(np.where(plain, -1, chars[1] - chars[0]))
        middle_all.append(np.where(plain, -1, chars[2] - chars[1]))
        sizes.append(size + np.where(plain, 0, 3 * MARK))
        out.append(result)
    form = np.concatenate([*form_all, np.empty(0, np.int64)])
    made = strings(sizes, out)

    def counts(parts: list[np.ndarray]) -> pa.Array:
        values = np.concatenate([*parts, np.empty(0, np.int64)])
        return pa.array(values, pa.int64(), mask=values < 0)

    names = pa.array(np.array(FORMS, dtype=object)[form.astype(np.int64)], pa.string())
    return pa.StructArray.from_arrays([counts(n_all), names, counts(prefix_all), counts(middle_all), made], ["n", "form", "prefix_chars", "middle_chars", "output"])


def strings(sizes: list[np.ndarray], data: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum(np.concatenate([[0], *sizes])).astype(np.int64)
    joined = np.concatenate(data) if data else np.empty(0, np.uint8)
    made = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(joined))
    return made.cast(pa.string())


def rebuild(column: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts that ``arrange`` made its outputs from; see ``restored``."""
    known = np.array([FORMS.index(f) for f in pc.fill_null(forms, PLAIN).to_pylist()], dtype=np.int64)
    sizes, out = [], []
    for row, stop, data, bounds in pieces(column):
        form = known[row:stop]
        plain, spm = form == 0, form == 2
        at = marks(data, bounds)
        owner = np.searchsorted(bounds, at, side="right") - 1
        at = at[~plain[owner]]
        if len(at) != 3 * int((~plain).sum()):
            raise ValueError("an output has not the three marks of its form")
        first, last = bounds[:-1], bounds[1:]
        own = np.stack([first, last, last], axis=1)
        own[~plain] = at.reshape(-1, 3)
        # Lengths of the parts in the order of the text.
        one, two, three = own[:, 1] - own[:, 0] - MARK, own[:, 2] - own[:, 1] - MARK, last - own[:, 2] - MARK
        prefix = np.where(plain, last - first, np.where(spm, two, one))
        middle, suffix = np.where(plain, 0, three), np.where(plain, 0, np.where(spm, one, two))
        size = prefix + middle + suffix
        begin = np.cumsum(size) - size
        starts = np.stack([begin, begin + prefix, begin + prefix + middle], axis=1)
        source = np.stack([np.where(plain, first, np.where(spm, own[:, 1], own[:, 0]) + MARK), own[:, 2] + MARK, np.where(spm, own[:, 0], own[:, 1]) + MARK], axis=1)
        result = np.empty(int(size.sum()), dtype=np.uint8)
        for x, y, shift in displaced(len(result), starts.ravel(), (source - starts).ravel()):
            result[x:y] = data[np.arange(x, y) + shift]
        sizes.append(size)
        out.append(result)
    return strings(sizes, out)


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, plain_share: int = PLAIN_SHARE,
              spm_share: int = SPM_SHARE, into: str = "fim") -> DataFrame:
    """``df`` with the column ``into``: ``n`` tokens, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Tokens are runs of the letters A to Z and single other characters. The row's key and the seed
    alone choose two cuts between tokens and the form, so reruns and copies of a row agree. A text
    stays plain if it is empty or null (null counts as empty), holds a mark, or is one of the
    ``plain_share`` of a hundred; then both lengths are null. Nothing is shuffled; rows that repeat
    or share a key are transformed alike, an empty table gives none, and a text of any length needs
    little more memory than itself and its output. Other columns stay; one named ``into`` is replaced.
    """
    kind = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"

    @F.arrow_udf(kind)
    def made(texts: pa.Array, drawn: pa.Array) -> pa.Array:
        return arrange(texts, drawn, plain_share, spm_share)

    return df.withColumn(into, made(F.col(text), draws(F.col(key), seed)))


def restored(output: Column, form: Column) -> Column:
    """The exact text of an output of ``transform``, from the output and its form; a null output is empty."""

    @F.arrow_udf("string")
    def made(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return rebuild(outputs, forms)

    return made(output, form)
