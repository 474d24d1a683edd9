"""Words cut out of Arrow text columns, without a Python object for each."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 4 << 20  # bytes of text that are cut at once; a longer text is a slice of its own

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words(NamedTuple):
    values: pa.Array  #: the words' bytes, A-Z in small letters
    rows: np.ndarray  #: the row that each word stands in
    starts: np.ndarray  #: where it starts, counted over the bytes of all rows
    data: np.ndarray  #: these bytes
    offsets: np.ndarray  #: where each row starts in them


def byte_class(pattern: bytes) -> np.ndarray:
    """Which of the 256 bytes occur in ``pattern``."""
    table = np.zeros(256, bool)
    table[list(pattern)] = True
    return table


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, pa.Array]]:
    """Stretches of at most ``most`` bytes (one row at least), and the number of each one's first row. Missing texts become empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, texts.slice(at, to - at)
        at = to


def cut_words(texts: pa.Array, in_word: np.ndarray) -> Words:
    """The maximal runs of bytes for which ``in_word`` is set; no run goes on into the next row.

    All bytes from 128 on must be alike in ``in_word``, so that no letter is cut. ``texts`` holds no nulls.
    """
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    first, end = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(buffers[2], np.uint8)[first:end] if buffers[2] is not None else np.zeros(0, np.uint8)
    offsets = offsets - first
    data = _LOWER[data]
    inside = in_word[data]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[heads], last[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    places = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=places[1:])
    values = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[inside])])
    return Words(values, np.searchsorted(offsets, starts, "right") - 1, starts, data, offsets[:-1])
