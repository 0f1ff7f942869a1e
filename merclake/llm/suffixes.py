"""Names of byte strings and packed columns for the suffix operator."""

from __future__ import annotations

import numpy as np

from merclake.llm.common import GOLDEN, scramble

#: One random odd number for each byte; a string's name is a polynomial in an odd base over these, modulo 2**64.
LETTERS = scramble(np.arange(1, 257, dtype=np.uint64) * GOLDEN) | np.uint64(1)
_POWERS: dict[bool, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the base, or of its inverse."""
    have = _POWERS.get(inverse)
    if have is None or len(have) < n:
        base = pow(int(GOLDEN), -1, 2**64) if inverse else int(GOLDEN)
        steps = np.full(max(n, 1024), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[inverse] = np.cumprod(steps)
    return have[:n]


class Names:
    """Names of all substrings of a byte array from its prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(LETTERS[data] * powers(len(data)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * powers(len(self.sums), inverse=True)[start])

    def all_of(self, length: int) -> np.ndarray:
        """Names of the strings of this length at every position."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return scramble((self.sums[length:] - self.sums[:n]) * powers(n, inverse=True))


def names_of_rows(rows: np.ndarray, first: int, length: int) -> np.ndarray:
    """Names of the strings in columns [first, first + length) of a matrix of bytes."""
    return scramble((LETTERS[rows[:, first : first + length]] * powers(length)).sum(axis=1, dtype=np.uint64))


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of every ``width`` consecutive values."""
    pick = np.minimum if least else np.maximum
    if len(values) < width:
        return values[:0]
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    if done < width:
        more = width - done
        values = pick(values[: len(values) - more], values[more:])
    return values


def pack(*columns: np.ndarray, widths: tuple[int, ...] | None = None) -> bytes:
    """Columns of equal length as bytes, each as planes of its first, second, ... bytes, so that small numbers
    compress to little. ``widths`` keeps only so many low bytes of a column."""
    out = [np.uint32(len(columns[0])).tobytes()]
    for i, c in enumerate(columns):
        c = np.ascontiguousarray(c)
        planes = c.view(np.uint8).reshape(len(c), c.itemsize).T
        out.append(np.ascontiguousarray(planes[: widths[i]] if widths else planes).tobytes())
    return b"".join(out)


def unpack(data: bytes, kinds: tuple[str, ...], widths: tuple[int, ...] | None = None) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    at, out = 4, []
    for i, kind in enumerate(kinds):
        size = np.dtype(kind).itemsize
        width = widths[i] if widths else size
        planes = np.zeros((size, n), dtype=np.uint8)
        planes[:width] = np.frombuffer(data, np.uint8, width * n, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += width * n
    return out


def deltas(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences to the value before; the values themselves at ``starts``."""
    out = values.copy()
    out[1:] -= values[:-1]
    out[starts] = values[starts]
    return out


def runs(sorted_values: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Flags of the first row of each run of equal values."""
    first = np.ones(len(sorted_values), dtype=bool)
    if len(first) > 1:
        first[1:] = sorted_values[1:] != sorted_values[:-1]
        for x in more:
            first[1:] |= x[1:] != x[:-1]
    return first


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    """pmod(xxhash64(id), groups) as Spark computes it for a long."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in PRIMES)
    x = ids.astype(np.int64).view(np.uint64)
    turn = lambda v, by: (v << np.uint64(by)) | (v >> np.uint64(64 - by))
    h = turn(x * p2, 31) * p1 ^ (np.uint64(42) + p5 + np.uint64(8))
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return (h ^ (h >> np.uint64(32))).view(np.int64) % groups


#: The five primes of XXH64. Fixed values.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
