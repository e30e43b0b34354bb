"""Terms of whole texts as Arrow dictionary indices."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What separates terms once A-Z are small letters: all of ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text tokenized at a time, so that what is derived from a batch stays small.
SLICE = 4 << 20


class Terms(NamedTuple):
    """The terms of the texts in order: text i has ``codes[offsets[i]:offsets[i + 1]]``."""

    offsets: np.ndarray
    codes: np.ndarray
    dictionary: pa.Array


def terms_of(texts: pa.Array) -> Terms:
    """Maximal runs of digits, letters and characters beyond ASCII; only A-Z lower-cased.

    A null or empty text has none.
    """
    lowered = pc.ascii_lower(pc.fill_null(texts, ""))
    parts = pc.split_pattern_regex(lowered, pattern=SEPARATORS)
    encoded = pc.list_flatten(parts).dictionary_encode()
    lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    blank = pc.index(encoded.dictionary, "").as_py()
    if blank >= 0:  # what stands before a leading or after a trailing separator
        real = codes != blank
        ends = np.concatenate([[0], np.cumsum(real, dtype=np.int64)])[ends]
        codes = codes[real]
    return Terms(np.concatenate([[0], ends]).astype(np.int64), codes, encoded.dictionary)


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with at most ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
