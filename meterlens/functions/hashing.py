"""Hash positions of Bloom filters and reproducible shuffling keys."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def bloom_size(capacity: int, error_rate: float) -> tuple[int, int]:
    """(bits, hashes) of a filter for ``capacity`` items at ``error_rate``."""
    bits = int(-capacity * math.log(error_rate) / math.log(2) ** 2)
    return bits, int(bits * math.log(2) / capacity)


def bloom_position(item: str, number: str | int, bits: int) -> Column:
    """The bit of column ``item`` under hash ``number``, a column or a constant.

    It is the 128-bit MD5 of "item_number" modulo ``bits`` (below 2**47). The 32 hex
    digits are taken as 2, 15 and 15, the largest pieces a long holds; from 2**31 bits on as
    eight times 4, so that a remainder times the step still fits.
    """
    if bits >= 1 << 47:
        raise ValueError("a filter must have fewer than 2**47 bits")
    first, width = (2, 15) if bits < 1 << 31 else (4, 4)
    digest = f"md5(concat_ws('_', {item}, CAST({number} AS STRING)))"
    step = (1 << 4 * width) % bits
    rest = f"CAST(conv(substring({digest}, 1, {first}), 16, 10) AS BIGINT)"
    for start in range(1 + first, 33, width):
        piece = f"CAST(conv(substring({digest}, {start}, {width}), 16, 10) AS BIGINT)"
        rest = f"({rest} * {step} + {piece} % {bits}) % {bits}"
    return F.expr(rest)


def shuffle_key(row_id: str, seed: int) -> Column:
    """A hex text that orders rows at random, the same way in every engine and run."""
    return F.expr(f"md5(concat_ws('_', '{int(seed)}', CAST({row_id} AS STRING)))")
