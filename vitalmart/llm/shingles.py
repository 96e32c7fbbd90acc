"""Word shingles of whole texts as 64-bit hashes, in numpy over the bytes."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

from vitalmart.llm.common import mix

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes from which on a word is hashed by blake2b.
_LONG = 256
#: Masks of the first 0 to 8 bytes.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_FORTH, _BACK = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _FORTH, _BACK
    if n > len(_FORTH):
        _FORTH, _BACK = _powers(_BASE, n), _powers(_INVERSE, n)
    return _FORTH[:n], _BACK[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """P with P[i] = sum of (byte + 1) * BASE ** j over j < i; the hash of
    data[s:e] is (P[e] - P[s]) * BASE ** -s, modulo 2 ** 64."""
    out = np.zeros(len(data) + 1, np.uint64)
    forth, _ = powers(len(data) + 1)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forth[:len(data)], out=out[1:])
    return out


def lowered(data: np.ndarray) -> np.ndarray:
    return data + np.uint8(32) * ((data >= 65) & (data <= 90))


def spans(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[s:e]. Eight bytes at a time are mixed into a
    chain, which no sum of terms can undo (other than a polynomial, in which
    words of a certain pattern cancel out); what is long goes to blake2b."""
    n = e - s
    eights = np.ndarray(len(data) + 1, "<u8", np.r_[data, np.zeros(8, np.uint8)].tobytes(), strides=(1,))
    out = mix(n.astype(np.uint64) + np.uint64(_BASE))
    live = np.flatnonzero((n > 0) & (n <= _LONG))
    k = 0
    while len(live):
        left = n[live] - k
        part = eights[s[live] + k] & _FIRST[np.minimum(left, 8)]
        out[live] = mix(out[live] * _STEP ^ mix(part + np.uint64(_BASE)))
        k += 8
        live = live[left > 8]
    for i in np.flatnonzero(n > _LONG).tolist():
        out[i] = int.from_bytes(blake2b(data[s[i]:e[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lowered, words end at space, tab to carriage
    return, or the document's end), and the words before each document."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    inside = ~blank
    start = inside.copy()
    start[1:] &= blank[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= blank[1:] | first[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return spans(lowered(data), s, e), np.searchsorted(s, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each document the sorted distinct hashes of its word shingles; a
    document of fewer words has its whole sequence as one, without words
    none."""
    with np.errstate(over="ignore"):
        w, at = word_hashes(data, offsets)
        n = max(0, len(w) - size + 1)
        joined = np.zeros(n, np.uint64)
        for k in range(size):
            joined = joined * _STEP + w[k:k + n]
        joined = mix(joined + np.uint64(size))
        out = []
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= size:
                out.append(np.unique(joined[a:b - size + 1]))
            elif b > a:
                h = np.zeros(1, np.uint64)
                for x in w[a:b]:
                    h = h * _STEP + x
                out.append(mix(h + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def set_of(text: bytes, size: int) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return shingle_sets(data, np.array([0, len(data)], np.int64), size)[0]
