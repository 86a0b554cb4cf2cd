"""Words and five-word shingles of whole texts as 64-bit hashes, with numpy over UTF-8 bytes."""

import hashlib
from collections.abc import Iterator

import numpy as np

from quillrank.llm.worker import per_worker

SEGMENT = 1 << 20  # bytes of a text hashed at a time; longer texts go in pieces cut at white space
_WHITE = bytes([0x20, *range(0x09, 0x0E)])
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Tables:
    """Byte tables and powers of the hash base; powers grow with the longest segment seen."""

    def __init__(self):
        white = np.zeros(256, dtype=np.int8)
        white[list(_WHITE)] = 1
        self.white = white
        lower = np.arange(256, dtype=np.uint64)
        lower[ord("A") : ord("Z") + 1] += 32
        self.lowered = mixed(lower + np.uint64(1))
        self.as_is = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1))
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers), 1 << 16)
            steps = np.full(size, _BASE, dtype=np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
            steps[1:] = pow(_BASE, -1, 1 << 64)
            self.inverses = np.multiply.accumulate(steps)
        return self.powers[:n], self.inverses[:n]


def tables() -> _Tables:
    return per_worker("word_tables", _Tables)


def segments(data: bytes, size: int = SEGMENT) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes that cut no word."""
    start = 0
    while len(data) - start > size:
        end = start + size
        while end < len(data) and data[end] not in _WHITE:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One hash per span of bytes, the same wherever the span stands."""
    powers, inverses = tables().upto(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data] * powers[: len(data)], dtype=np.uint64)))
    return mixed((sums[ends] - sums[starts]) * inverses[starts])


def word_hashes(text: str | None) -> np.ndarray:
    """A hash per word, A-Z in lower case; words are runs of bytes other than ASCII white space."""
    found = []
    for piece in segments((text or "").encode("utf-8", "surrogatepass")):
        data = np.frombuffer(piece, dtype=np.uint8)
        edges = np.diff(tables().white[data], prepend=np.int8(1), append=np.int8(1))
        starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        found.append(span_hashes(data, starts, ends, tables().lowered))
    return np.concatenate(found)


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """The sorted distinct shingles of ``width`` words; of fewer words, the one sequence; of none, none."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for i in range(width):
        total = total * _STEP + words[i : i + count]
    return np.unique(mixed(total))


def set_key(sorted_set: np.ndarray) -> bytes:
    """A 128-bit name of a set: equal sets, and only they, share it."""
    return hashlib.blake2b(sorted_set.tobytes(), digest_size=16).digest()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, exactly, for sorted distinct arrays."""
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
