"""Words and word shingles of whole texts, for the operators that compare texts."""

from __future__ import annotations

import hashlib

import numpy as np

_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_TO_SPACE = bytes(0x20 if b in _SEPARATORS else b for b in range(256))
_MIX = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Words between ASCII blanks, A-Z in lower case.
BLANK_WORDS = bytes(0x20 if b in range(0x09, 0x0E) else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Entries of the word -> hash memo of one worker.
MEMO_WORDS = 500_000


def words_of(text: str) -> list[bytes]:
    """Words in lower case; ASCII signs and blanks separate them."""
    return text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split()


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


_HASHES = _Hashes()


def hashes_of(words: list[bytes]) -> np.ndarray:
    """One stable 64-bit hash per word."""
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingles(words: list[bytes], width: int = 5) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words; a shorter text has one shingle of
    all its words, an empty one none."""
    if not words:
        return np.zeros(0, np.uint64)
    h, width = hashes_of(words), min(width, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for j in range(width):
        out += h[j:j + len(out)] * _MIX[j]
    return scrambled(out)


# Hashes of all words of a batch at once: a word's hash is a polynomial in its bytes, a difference of
# two running sums over the batch times the inverse power of its place (arithmetic modulo 2 ** 64).
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 20
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        _POWERS[base] = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n, _BLOCK + 1), base, np.uint64)]))
    return _POWERS[base]


def hashed_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ``data``, which ends with the 0x20 that separates them, and where each begins and ends."""
    found, firsts, lasts, at = [], [], [], 0
    while at < len(data):
        to = min(len(data), at + _BLOCK)
        cut = data.rfind(b" ", at, to) + 1
        if cut <= at:  # a word longer than a block
            cut = data.index(b" ", at) + 1
        block = np.frombuffer(data, np.uint8, cut - at, at)
        blank = block == 0x20
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if not blank[0]:
            edges = np.concatenate([[0], edges])
        first, last = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[block] * _powers(_BASE, len(block))[:len(block)], dtype=np.uint64)])
        found.append(scrambled((sums[last] - sums[first[:len(last)]]) * _powers(_INVERSE, len(block))[first[:len(last)]]))
        firsts.append(first[:len(last)] + at)
        lasts.append(last + at)
        at = cut
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(firsts), np.concatenate(lasts)


def word_hashes(texts: list[str], table: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and the number of words of each text.

    ``table`` maps the bytes of a text, separators to 0x20; by default words are in lower case between ASCII signs.
    """
    parts = [(t.lower() if table is None else t).encode("utf-8", "replace") for t in texts]
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    data = (b" ".join(parts) + b" ").translate(_TO_SPACE if table is None else table)
    found, first, _ = hashed_spans(data)
    if not len(found):
        return found, np.zeros(len(texts), np.int64)
    return found, np.bincount(np.searchsorted(ends, first, "right"), minlength=len(texts)).astype(np.int64)


def shingled(hashes: np.ndarray, counts: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text the hashes of its runs of ``width`` words (of all its words, if it has fewer)."""
    n = max(0, len(hashes) - width + 1)
    runs = np.full(n, width, np.uint64)
    for j in range(width):
        runs += hashes[j:j + n] * _MIX[j]
    runs, out, at = scrambled(runs), [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(runs[at:at + c - width + 1])
        elif c:
            short = np.full(1, c, np.uint64)
            for j in range(c):
                short += hashes[at + j:at + j + 1] * _MIX[j]
            out.append(scrambled(short))
        else:
            out.append(runs[:0])
        at += c
    return out
