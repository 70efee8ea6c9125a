"""Word shingles of whole texts as 64-bit hashes, computed over Arrow buffers in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from placebook.llm.common import mix64, utf8_buffer

PIECE = 1 << 19                                                   # bytes; some 60 bytes of arrays for each
WIDTH = 5
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_PLACE = mix64(np.arange(11, 11 + WIDTH, dtype=np.uint64)) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        for name, base in (("up", _P), ("down", _P_INV)):
            p = np.full(max(n, 1 << 16), base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def _words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word of one piece."""
    space = _SPACE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[starts] = True                                          # a text's first byte begins a word, as after a space
    begins = np.flatnonzero(~space & (first[:-1] | np.concatenate([[True], space[:-1]])))
    ends = np.flatnonzero(~space & (first[1:] | np.concatenate([space[1:], [True]]))) + 1
    up, down = _power(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * up, out=total[1:])
    hashes = (total[ends] - total[begins]) * down[begins] if len(raw) else np.zeros(0, np.uint64)
    return mix64(hashes + (ends - begins).astype(np.uint64)), np.searchsorted(starts, begins, "right") - 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word. A long text is worked through in pieces cut at spaces, so that
    the arrays per byte stay small."""
    raw, starts = utf8_buffer(texts)
    hashes, of, at = [], [], 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        while end < len(raw) and not _SPACE[raw[end]]:
            more = np.flatnonzero(_SPACE[raw[end:end + PIECE]])
            end += int(more[0]) if len(more) else min(PIECE, len(raw) - end)
        inside = starts[np.searchsorted(starts, at):np.searchsorted(starts, end)]
        h, t = _words(raw[at:end], np.unique(np.concatenate([[0], inside - at])))
        # text numbers by place, so that empty texts between don't shift them
        cuts = np.unique(np.concatenate([[at], inside]))
        last = np.searchsorted(starts, cuts, "right") - 1
        hashes.append(h)
        of.append(last[t] if len(t) else np.zeros(0, np.int64))
        at = max(end, at + 1)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(of)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, sorted. Fewer words than a shingle: one hash of the whole; none: empty."""
    words, of = word_hashes(texts)
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    n = max(len(words) - WIDTH + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for i in range(WIDTH):
        rolled += words[i:i + n] * _PLACE[i]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= WIDTH:
            s = np.sort(rolled[a:b - WIDTH + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(mix64((words[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
