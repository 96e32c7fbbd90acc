"""Token ids of whole texts, and their byte-plane encoding."""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import repeat

import numpy as np
import zstandard

from vitalmart.llm.shingles import lowered, spans

#: What a segment must be to be given to the model itself, once lowered.
_LETTERS, _MARKS = re.compile("[a-zß-öø-ÿ]+"), re.compile("[!-&(-/:;=?@\\[-`{-~]+")

# Byte classes: blank, letter of a simple word, mark of one, anything else.
_BLANK, _LETTER, _MARK, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[32, 9, 10, 13]] = _BLANK
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_CLASS[[c for c in range(33, 127) if _MARKS.fullmatch(chr(c))]] = _MARK


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces that can be encoded apart from each
    other: the words between blanks, and where a word is made of Latin-1
    letters and ASCII marks only, its runs of either."""
    kind = _CLASS[data]
    before = np.r_[np.uint8(0), data[:-1]]
    high = data >= 128
    fine = (data == 0xC3) | (high & (data < 0xC0) & (before == 0xC3) & (data != 0x97) & (data != 0xB7))
    odd = (kind == _OTHER) | (high & ~fine)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    blank = kind == _BLANK
    start = ~blank
    start[1:] &= blank[:-1] | first[1:-1]
    word = np.flatnonzero(start)
    turn = np.flatnonzero((kind[1:] != kind[:-1]) & ~blank[1:] & ~blank[:-1] & ~first[1:-1]) + 1
    if len(word):
        simple = np.diff(np.r_[0, np.cumsum(odd)][np.r_[word, len(data)]]) == 0  # blanks count as nothing
        turn = turn[simple[np.searchsorted(word, turn, side="right") - 1]]
    starts = np.sort(np.r_[word, turn])
    end = ~blank
    end[:-1] &= blank[1:] | first[1:-1]
    return starts, np.sort(np.r_[np.flatnonzero(end) + 1, turn])


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level tokenizers write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts by a tokenizers file whose pre-tokenizer never joins
    text across white space: a text's ids are then the ids of its segments
    (see above), so each distinct segment is encoded by the library once and
    found again by a 64-bit hash of its lowered bytes (of its own bytes, if it
    holds ``<|``). Runs of plain Latin
    letters, whose normalised form is known, go to the library's model
    directly; all else goes through the whole tokenizer. Holds at most
    ``most`` segments, then starts again."""

    def __init__(self, path: str, end_id: int | None = None, most: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.end_id, self.most = end_id, most
        # the short ways must give what the whole tokenizer gives
        probe = ["Ouwhea", "the", "É", "üBer", "straße", "x", "Zzyxqj"]
        if not all(self._model(w.lower()) == self._whole(w) == self._whole(w.lower()) for w in probe) or not all(
                self._whole(w + m) == self._whole(w) + self._whole(m) for w in probe for m in (".", ",", "?!", ";:")):
            raise ValueError(f"{path} doesn't lower its words or split them from marks")
        self._reset()

    def _reset(self) -> None:
        self.at: dict[int, int] = {}
        self.flat, self.ends = array("I"), array("q", [0])  # ids of segment k: flat[ends[k]:ends[k + 1]]

    def _whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _model(self, low: str) -> list[int]:
        if not low.isascii():
            low = "".join(map(self.letters.__getitem__, low.encode()))
        return [t.id for t in self.tokenizer.model.tokenize(low)]

    def _learn(self, keys: list[int], words: list[bytes]) -> None:
        for key, word in zip(keys, words):
            word = word.decode()
            low = word.lower()
            self.flat.extend(self._model(low) if _LETTERS.fullmatch(low) else self._whole(word))
            self.at[key] = len(self.ends) - 1
            self.ends.append(len(self.flat))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts data[offsets[i]:offsets[i + 1]] one after the
        other, and the number of ids of each text, its end id included."""
        starts, ends = segments(data, offsets)
        low = lowered(data)
        # added tokens are matched in the raw text, so what may hold one keeps its bytes
        added = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
        for k in np.unique(np.searchsorted(starts, added, side="right") - 1).tolist():
            low[starts[k]:ends[k]] = data[starts[k]:ends[k]]
        with np.errstate(over="ignore"):
            keys = spans(low, starts, ends)
        found, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.at) > self.most:
            self._reset()
        names = found.tolist()
        index = np.fromiter(map(self.at.get, names, repeat(-1)), np.int64, len(names))
        if len(missing := np.flatnonzero(index < 0)):
            raw = data.tobytes()
            at = where[missing]
            self._learn([names[i] for i in missing.tolist()],
                        [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())])
            index[missing] = np.fromiter(map(self.at.__getitem__, found[missing].tolist()), np.int64, len(missing))
        upto, pool = np.frombuffer(self.ends, np.int64), np.frombuffer(self.flat, np.uint32)
        index = index[inverse]
        begin = upto[index]
        length = upto[index + 1] - begin
        after = np.cumsum(length)
        total = int(after[-1]) if len(after) else 0
        ids = pool[np.repeat(begin - (after - length), length) + np.arange(total)]
        at = np.r_[0, after][np.searchsorted(starts, offsets)]
        if self.end_id is None:
            return ids, np.diff(at)
        return np.insert(ids, at[1:], self.end_id), np.diff(at) + 1


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int | None) -> Encoder:
    """One encoder per worker process, which keeps its words between tasks."""
    return Encoder(path, end_id)


BLOCK = 1 << 14


def planes(ids: np.ndarray, level: int = 3, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
    """The ids in blocks of a fixed size, each turned into its four byte
    planes, each plane compressed by zstandard; a plane of zeros takes no
    bytes. Returns the payload and the plane sizes, block by block."""
    press = zstandard.ZstdCompressor(level=level)
    out, sizes = [], []
    for a in range(0, len(ids), block):
        part = np.ascontiguousarray(ids[a:a + block], "<u4").view(np.uint8).reshape(-1, 4)
        for plane in np.ascontiguousarray(part.T):
            packed = press.compress(plane.tobytes()) if plane.any() else b""
            out.append(packed)
            sizes.append(len(packed))
    return b"".join(out), np.array(sizes, np.int32)


def unplanes(payload: bytes, sizes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids again."""
    unpress = zstandard.ZstdDecompressor()
    out, at = np.zeros((n, 4), np.uint8), 0
    for k, size in enumerate(sizes):
        a = k // 4 * block
        if size:
            plane = np.frombuffer(unpress.decompress(payload[at:at + size]), np.uint8)
            out[a:a + len(plane), k % 4] = plane
            at += size
    return out.reshape(-1).view("<u4").astype(np.uint32)
