"""Words and their hashes in many texts at once, as arrays."""

from __future__ import annotations

import numpy as np

from cohortloom.llm.common import mixed

SEGMENT = 1 << 20
_BASE = 0x5851F42D4C957F2D | 1
_BYTES = np.arange(256)
#: A-Z in lower case, all other bytes as they are.
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: Bytes of a word: digits, letters, and all of a character beyond ASCII.
WORD = (LOWER >= 128) | ((LOWER >= 48) & (LOWER <= 57)) | ((LOWER >= 97) & (LOWER <= 122))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            size = max(n + 1, SEGMENT + 4096)
            inverse = pow(_BASE, -1, 1 << 64)
            cls.up, cls.down = (
                np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64)))) for b in (_BASE, inverse)
            )
        return cls.up, cls.down


def hashed_words(data: np.ndarray, at: np.ndarray, letters: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of the rows ``data[at[i]:at[i + 1]]``; words never cross rows.

    ``letters`` says of each byte whether it belongs to words.
    """
    found, pos = [], 0
    while pos < len(data):
        end = min(len(data), pos + SEGMENT)
        while end < len(data) and letters[data[end]]:
            end += 1
        part = data[pos:end]
        is_word = letters[part]
        cuts = at[(at > pos) & (at < end)] - pos
        before = np.concatenate(([False], is_word[:-1]))
        before[cuts] = False
        after = np.concatenate((is_word[1:], [False]))
        after[cuts - 1] = False
        starts, ends = np.nonzero(is_word & ~before)[0], np.nonzero(is_word & ~after)[0] + 1
        up, down = _Powers.upto(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((LOWER[part].astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        found.append((starts + pos, ends + pos, mixed((sums[ends] - sums[starts]) * down[starts])))
        pos = end
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` word hashes."""
    n = max(0, len(hashes) - k + 1)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(_BASE) + hashes[j : j + n]
    return mixed(total)
