"""Words of many texts at once in numpy: byte classes, word spans and 64-bit word hashes.

A word hash is a polynomial over the word's normalised bytes modulo 2**64, taken from
one running sum over the whole buffer, then mixed; equal words have equal hashes
wherever they stand.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Word bytes: all but white space ("space"), or 0-9, letters and all non-ASCII ("alnum").  Fixed values.
WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
BASE, MIX1, MIX2, ROLL = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def byte_table(kind: str, lower: bool) -> np.ndarray:
    """For each byte: its normalised value in a word, or 0 where it separates words.

    A NUL byte is a word byte under "space"; it maps to 0x01, which no rule tells apart
    from a NUL but keeps it inside the word.
    """
    out = np.arange(256, dtype=np.uint8)
    out[0] = 1
    if lower:
        out[65:91] += 32
    if kind == "space":
        out[list(WHITE)] = 0
    else:
        ok = np.zeros(256, bool)
        ok[48:58] = ok[65:91] = ok[97:123] = ok[128:] = True
        out[~ok] = 0
    return out


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX2
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((int(BASE), pow(int(BASE), -1, 1 << 64))):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _powers[k] = np.multiply.accumulate(run)
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums, one more than values; see :func:`span_hashes`."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span's bytes, the same wherever the span stands (length included)."""
    inverse = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * ROLL)


@dataclass
class Words:
    """Words of a piece of texts, in order: text number, byte span, hash."""

    n_texts: int
    norm: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n_texts)

    @property
    def first(self) -> np.ndarray:
        """Index of each text's first word, one more than texts."""
        return np.concatenate([[0], np.cumsum(self.per_text)])


def spans(flags: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of true flags, broken at the offsets."""
    if not len(flags):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros(len(flags) + 1, bool)
    before[1:] = flags
    after = np.zeros(len(flags) + 1, bool)
    after[:-1] = flags
    edge = off[1:-1]
    opens, closes = after & ~before, before & ~after
    cut = edge[(edge > 0) & (edge < len(flags))]
    both = cut[flags[cut] & flags[cut - 1]]
    opens[both] = closes[both] = True
    return np.flatnonzero(opens), np.flatnonzero(closes)


def find_words(data: np.ndarray, off: np.ndarray, lut: np.ndarray) -> Words:
    norm = lut[data]
    start, end = spans(norm != 0, off)
    text = np.searchsorted(off, start, side="right") - 1
    return Words(len(off) - 1, norm, text, start, end, span_hashes(prefix_sums(norm), start, end))


def rolling(hashes: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of k consecutive words of one text, and the index of each window's first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = out * ROLL + hashes[j : j + n]
    at = np.flatnonzero(text[:n] == text[k - 1 :])
    return mix(out[at] + np.uint64(k)), at


def per_text_sum(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of true flags between consecutive offsets."""
    run = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return run[off[1:]] - run[off[:-1]]
