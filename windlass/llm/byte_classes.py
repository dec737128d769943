"""UTF-8 bytes mapped to a small alphabet: the tokens of the two language models.

Letters a-z are classes of their own, capitals one class, digits one, common
punctuation a few, and bytes of other scripts are kept apart by their low bits.
Class 0 stands for the edge of a text. The alphabet is fixed, so a table over
all windows of a few classes has a size that does not grow with the corpus.
"""

from __future__ import annotations

import numpy as np

EDGE = 0


def _table() -> bytes:
    groups = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\t\r\x0b\x0c", ".", ",", "!?", "'\"-", "#$%&*+=@^~|_<>\\/`"]
    table = [0] * 256
    for k, c in enumerate("abcdefghijklmnopqrstuvwxyz", 1):
        table[ord(c)] = k
    for k, group in enumerate(groups, 27):
        for c in group:
            table[ord(c)] = k
    other, lead, tail = 36, 37, 38  # remaining ASCII; first bytes; eight classes of further bytes
    for b in range(256):
        if b >= 0xC0:
            table[b] = lead
        elif b >= 0x80:
            table[b] = tail + (b & 7)
        elif table[b] == 0:
            table[b] = other
    return bytes(table)


TABLE = _table()
SIZE = max(TABLE) + 1


def classes(texts: list[bytes], before: int, after: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of all texts in a row, each with ``before`` and ``after`` edge
    marks around it; with the start of each text in that row and its length."""
    left, right = bytes(before), bytes(after)
    joined = b"".join(left + t.translate(TABLE) + right for t in texts)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.r_[0, np.cumsum(lengths + before + after)[:-1]].astype(np.int64) + before
    return np.frombuffer(joined, dtype=np.uint8), starts, lengths


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each run of ``lengths`` values; empty runs give 0."""
    out = np.zeros(len(lengths))
    full = lengths > 0
    if full.any():
        out[full] = np.add.reduceat(values, np.r_[0, np.cumsum(lengths[full])[:-1]])
    return out


def positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all characters of all texts in the row of classes."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
