"""Vectorised polynomial hashes of words, word shingles and byte strings in numpy."""

import numpy as np

U = np.uint64
#: Multipliers of the two prefix hashes (odd, so that they can be inverted modulo 2**64) and seeds of their byte values.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Bytes that part words: space, and tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits (splitmix64's finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_VALUES = [mix(np.arange(1, 257, dtype=U) * U(b)) for b in BASES]


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(which)
    if have is None or len(have[0]) <= n:
        size = 1 << max(16, int(n + 1).bit_length())
        base = BASES[which]
        up = np.full(size, base, U)
        down = np.full(size, pow(base, -1, 1 << 64), U)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            _powers[which] = have = np.cumprod(up), np.cumprod(down)
    return have


def prefix(data: np.ndarray, which: int = 0) -> np.ndarray:
    """P with P[i] the hash of the first i bytes; see span()."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE_VALUES[which][data] * powers(len(data), which)[0][: len(data)], out=out[1:])
    return out


def span(p: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of the byte strings [start, end), the same wherever the strings stand."""
    return (p[end] - p[start]) * powers(len(p), which)[1][start]


def words(data: np.ndarray, off: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes b with not apart[b]; a word never spans two rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~apart[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off[off <= len(data)]] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def shingles(data: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row its distinct word k-shingles as sorted 64-bit hashes.

    Words are runs without blanks, A-Z lower-cased. A row of fewer than k words has its whole sequence as
    one shingle; a row without words has none.
    """
    with np.errstate(over="ignore"):
        data = LOWER[data]
        start, end = words(data, off, BLANK)
        p = prefix(data)
        w = mix(span(p, start, end) + (end - start).astype(U) * U(BASES[1]))
        count = np.searchsorted(start, off)
        row = np.repeat(np.arange(len(off) - 1), np.diff(count))
        n = len(w) - k + 1
        if n > 0:
            h = np.zeros(n, U)
            for j in range(k):
                h = h * U(BASES[1]) + w[j : j + n]
            h = mix(h)
            whole = row[:n] == row[k - 1 :]
            h, row = h[whole], row[:n][whole]
        else:
            h, row = np.zeros(0, U), np.zeros(0, np.int64)
        at = np.searchsorted(row, np.arange(len(off)))
        out = []
        for i in range(len(off) - 1):
            if at[i + 1] > at[i]:
                out.append(np.unique(h[at[i] : at[i + 1]]))
            elif count[i + 1] > count[i]:
                x = U(count[i + 1] - count[i])
                for y in w[count[i] : count[i + 1]]:
                    x = x * U(BASES[0]) + y
                out.append(mix(np.array([x], U)))
            else:
                out.append(np.zeros(0, U))
        return out
