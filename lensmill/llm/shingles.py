"""Sets of word shingles as sorted 64-bit digests, computed for many texts at once."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np

from lensmill.llm.fingerprints import mix

_U = np.uint64
_BASE = _U(0xD1342543DE82EF95)
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: A random number per byte, none for white space.
_BYTES = np.where(_SPACES, _U(0), mix(np.arange(1, 257).astype(_U) * _BASE))


@lru_cache(maxsize=1)
def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _BASE))


class Sets(NamedTuple):
    """Set i is values[offsets[i] : offsets[i + 1]], ascending and distinct."""

    values: np.ndarray
    offsets: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.values[self.offsets[i] : self.offsets[i + 1]]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all words, A-Z lower-cased, and how many of them each text has."""
    parts = [t.encode().lower() for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    space = _SPACES[data]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    ends = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    if not len(starts):
        return np.zeros(0, _U), counts
    lengths = np.diff(starts, append=len(data))
    data = data[starts[0] :]
    place = np.arange(len(data)) - np.repeat(starts - starts[0], lengths)
    # The table grows in powers of two, to the longest word there is.
    powers = _powers(1 << max(10, int(lengths.max()).bit_length()))
    return mix(np.add.reduceat(_BYTES[data] * powers[place], starts - starts[0])), counts


def shingle_sets(texts: list[str], width: int = 5) -> Sets:
    """Distinct shingles per text; a text of fewer words has its whole sequence as one, an empty text has none."""
    words, counts = word_hashes(texts)
    multipliers = mix(np.arange(7, 7 + width).astype(_U)) | _U(1)
    n_windows = len(words) - width + 1
    sums = np.zeros(max(n_windows, 0), _U)
    for k, by in enumerate(multipliers):
        if n_windows > 0:
            sums += words[k : k + n_windows] * by
    sums = mix(sums)
    found, at = [], 0
    for count in counts.tolist():
        if count >= width:
            found.append(np.unique(sums[at : at + count - width + 1]))
        elif count:
            whole = (words[at : at + count] * multipliers[:count]).sum(keepdims=True)
            found.append(mix(mix(whole + _U(count))))
        else:
            found.append(sums[:0])
        at += count
    offsets = np.cumsum([0, *map(len, found)])
    return Sets(np.concatenate(found) if found else sums, offsets)


def set_digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of two ascending sets."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)
