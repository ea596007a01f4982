"""Arrow batches in slices, so that a worker holds few texts as Python objects at once."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of texts that a function turns into Python objects at once, unless one text alone has more.
SLICE_BYTES = 4_000_000


def slices(columns: Sequence[pa.Array] | pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, ...]]:
    """Rows of a batch in order, in slices whose first column, texts or bytes, has at most ``limit`` bytes or one row.

    Spark bounds a batch to 10,000 rows and some ten million bytes, which as lists, with all that is
    made of them, take several times as much.
    """
    columns = columns if isinstance(columns, tuple | list) else (columns,)
    ends = np.cumsum(pc.fill_null(pc.binary_length(columns[0]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield tuple(c.slice(at, stop - at) for c in columns)
        at = stop


def values(column: pa.Array) -> list:
    """Rows of a column as Python objects; for texts and bytes many times as fast as ``to_pylist``, which makes a scalar of each."""
    plain = pa.types.is_string(column.type) or pa.types.is_binary(column.type)
    return column.to_numpy(zero_copy_only=False).tolist() if plain else column.to_pylist()
