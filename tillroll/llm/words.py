"""Words and runs of words as 64-bit numbers, for many texts at once. A word is what white space surrounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the number of words of each text."""
    words, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.split()
        counts[i] = len(own)
        words += own
    if not words:
        return np.array([], np.uint64), counts
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False), counts


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each place on; shorter than `words` by length - 1. Crosses texts.

    Runs of 1, 2, 4 ... words are made from pairs of shorter ones, and those that add up to `length` are joined.
    """
    n = len(words) - length + 1
    if n <= 0 or length <= 0:
        return np.array([], np.uint64)
    power = lambda k: np.uint64(pow(int(_BASE), k, 1 << 64))
    total, done, block, width, rest = np.zeros(n, np.uint64), 0, words, 1, length
    while rest:
        if rest & 1:
            total = total * power(width) + block[done : done + n]
            done += width
        rest >>= 1
        if rest:
            block = block[:-width] * power(width) + block[width:]
            width *= 2
    return mixed(total)


def sorted_groups(stream: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of the rows that agree in the first `keys` columns, from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in stream:
        if not batch.num_rows:
            continue
        columns = [batch.column(i) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= np.asarray(pa.compute.not_equal(c[1:], c[:-1]))
        starts = np.flatnonzero(change).tolist()
        first = tuple(c[0].as_py() for c in columns)
        if last is not None and first != last:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for start in starts:
            held.append(batch.slice(at, start - at))
            yield pa.Table.from_batches(held)
            held, at = [], start
        held.append(batch.slice(at))
        last = tuple(c[batch.num_rows - 1].as_py() for c in columns)
    if held:
        yield pa.Table.from_batches(held)
