"""Words of a text: the longest runs of Unicode letters and digits, in lower case."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """The words in order; a null text has none. Cut first, lowered then: lowering can't split a word."""
    return " ".join(WORD.findall(text)).lower().split(" ") if text and WORD.search(text) else []


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has about ``limit`` bytes of the text column at most (a longer text is alone)."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        if not len(size) or size[-1] <= limit:
            yield batch
            continue
        at = 0
        while at < len(size):
            done = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, done + limit, "right")))
            yield batch.slice(at, end - at)
            at = end
