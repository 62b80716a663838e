"""Sets of word shingles as sorted 64-bit hashes, and PartEnum signatures of them."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash

SIZE = 3
#: Words whose hashes a task remembers at most; then it forgets them all.
REMEMBERED = 200_000
#: Counters of a sketch.
CELLS = 64
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_hashes = WordHashes()


def word_hashes(words: list[bytes] | list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the number; nothing is lost."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct shingles of three words, capital letters A-Z made small; of one or two words, the
    sequence itself; of none, nothing."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    if len(h) < SIZE:
        h = np.concatenate((h, np.full(SIZE - len(h), len(h), np.uint64)))
    n = len(h) - SIZE + 1
    return np.unique(mixed(sum(h[i : i + n] * ODD[i] for i in range(SIZE))))


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def sketch(s: np.ndarray) -> bytes:
    """Counts of the set's members by cell. The counts of two sets differ, in sum, by no more than
    the sets do; counts that no longer fit stop at the largest number, which keeps that true."""
    counts = np.bincount((s >> np.uint64(40)).astype(np.int64) % CELLS, minlength=CELLS)
    return np.minimum(counts, 65_535).astype("<u2").tobytes()


def sketches(column) -> np.ndarray:
    """A row per sketch, from an Arrow column of them."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, "<u2").reshape(-1, CELLS).astype(np.int32)


class PartEnum:
    """Signatures by partitions and enumeration, for sets whose Jaccard similarity is at least
    ``percent`` / 100.

    Sizes fall into bands, each as wide as similarity allows, so that similar sets are in one band or
    in neighbouring ones. The instance of a band serves it and the band below: a bound on how many
    members two similar sets of these sizes differ by is known. The domain is cut into partitions so
    many that one of them at least holds no more than ``errors`` of the differences, and each again
    into ``errors + spare`` parts, of which some ``spare`` hold none of these. A set's signatures
    are, for each partition and each choice of ``spare`` parts, its members there.
    """

    def __init__(self, percent: int, errors: int = 1, spare: int = 2) -> None:
        self.percent, self.errors, self.spare = percent, errors, spare
        self.plans: dict[int, tuple[int, int, list[tuple[int, ...]]]] = {}

    def alike(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)

    def most_apart(self, a, b):
        """How many members similar sets of these sizes differ by, at most."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def band(self, size: int) -> tuple[int, int, int]:
        """The band of a size: its number, the largest size in it and in the one above."""
        number, low = 0, 1
        while (high := 100 * low // self.percent) < size:
            number, low = number + 1, high + 1
        return number, high, 100 * (high + 1) // self.percent

    def plan(self, largest: int) -> tuple[int, int, list[tuple[int, ...]]]:
        """Partitions, parts of each, and the choices of parts, for sets up to a size. There are few
        such sizes, one to a band."""
        if largest not in self.plans:
            differ = self.most_apart(largest, largest)
            first = -(-(differ + 1) // (self.errors + 1))
            left = differ // first
            parts = left + self.spare if left else 1
            self.plans[largest] = first, parts, list(combinations(range(parts), parts - left))
        return self.plans[largest]

    def signatures(self, s: np.ndarray) -> np.ndarray:
        if not len(s):
            return np.empty(0, np.int64)
        number, high, above = self.band(len(s))
        out = []
        for instance, largest in ((number, high), (number + 1, above)):
            first, parts, choices = self.plan(largest)
            cells = np.zeros(first * parts, np.uint64)
            np.add.at(cells, s % np.uint64(first * parts), mixed(s))
            cells = cells.reshape(first, parts)
            place = np.arange(first, dtype=np.uint64) * ODD[0] + np.uint64(instance)
            for k, choice in enumerate(choices):
                held = sum(cells[:, c] for c in choice)
                out.append(mixed(mixed(held + place * ODD[1]) + np.uint64(k)))
        return np.concatenate(out).view(np.int64)
