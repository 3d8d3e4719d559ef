"""Words of many UTF-8 texts at once, as numpy arrays of positions and 64-bit hashes."""

from __future__ import annotations

import numpy as np

#: Words are read in runs of about this many bytes; what is kept is some 24 bytes a word.
RUN_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Bytes that belong to words of letters, digits and anything beyond ASCII (after A-Z are lowered).
ALNUM = np.array([48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123 or b >= 128 for b in range(256)])
#: Bytes that belong to words cut at white space.
NONSPACE = np.array([b != 32 and not 9 <= b < 14 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b < 91 else b for b in range(256)], np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit (uint64 to uint64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Splits texts laid end to end into words; the power tables are kept between calls."""

    def __init__(self, inside: np.ndarray, prefixes: tuple[int, ...] = ()):
        """With ``prefixes`` (lengths in bytes) a word's hashes are a column: its own, then those of its first bytes (0 where it is shorter)."""
        self.inside = inside
        self.prefixes = prefixes
        self.up = powers(_MULTIPLIER, 1)
        self.down = powers(_INVERSE, 1)

    def _run(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words of ``data``; a word also ends at each of ``breaks``."""
        n = len(data)
        if len(self.up) < n + 1:
            self.up, self.down = powers(_MULTIPLIER, n + 1), powers(_INVERSE, n + 1)
        inside = self.inside[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        inner = breaks[(breaks > 0) & (breaks < n)]
        first[inner] = inside[inner]
        last[inner - 1] = inside[inner - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * self.up[:n], out=total[1:])
        scale = self.down[starts]
        own = mix((total[ends] - total[starts]) * scale)
        if not self.prefixes:
            return starts, ends, own
        heads = [np.where(ends - starts >= k, mix((total[np.minimum(starts + k, n)] - total[starts]) * scale + np.uint64(k)), 0) for k in self.prefixes]
        return starts, ends, np.stack([own, *heads])

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, hash, text number) of each word; text i is ``data[offsets[i]:offsets[i + 1]]``.

        Long inputs are read in runs cut between words, so memory follows the number of words.
        """
        n, at, parts = len(data), 0, []
        while at < n:
            end = min(n, at + RUN_BYTES)
            while end < n:  # back to a byte outside words, else on until one comes
                outside = np.flatnonzero(~self.inside[data[at:end]])
                if len(outside):
                    end = at + int(outside[-1]) + 1
                    break
                end = min(n, end + RUN_BYTES)
            starts, ends, hashes = self._run(data[at:end], offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end, "right")] - at)
            parts.append((starts + at, ends + at, hashes))
            at = end
        if not parts:
            none = np.zeros(0, np.uint64) if not self.prefixes else np.zeros((1 + len(self.prefixes), 0), np.uint64)
            return np.zeros(0, np.int64), np.zeros(0, np.int64), none, np.zeros(0, np.int64)
        starts, ends, hashes = (np.concatenate(x, -1) for x in zip(*parts, strict=True))
        return starts, ends, hashes, np.searchsorted(offsets, starts, "right") - 1
