"""Simple-8b word-aligned integer coding, vectorised with numpy.

A 64-bit word has a 4-bit selector in its top bits and 60 bits of payload; the selector says
how many values of which width the payload packs, lowest first. Values are coded
in blocks of ``BLOCK`` that begin at known words, so that all blocks advance
together both ways. Values of 60 bits or more are escapes: their word holds an
index into a list of raw 64-bit exceptions.
"""

from __future__ import annotations

from functools import cache

import numpy as np

BLOCK = 1024
# Fixed values of the format: how many values a word packs, and of how many bits, by selector.
COUNTS = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 1
_PAD = int(COUNTS.max())
#: Value widths that some selector packs; a value's class is the least that fits, the escapes' comes last.
_CLASSES = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_LIMITS = np.array([1 << int(b) for b in _CLASSES], np.uint64)


@cache
def _small_classes() -> np.ndarray:
    return np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def _classes(values: np.ndarray) -> np.ndarray:
    if len(values) and int(values.max()) < 1 << 16:
        return _small_classes()[values]
    return np.searchsorted(_LIMITS, values, side="right").astype(np.uint8)


def _selectors(cls: np.ndarray) -> np.ndarray:
    """The selector that packs most values from each place on, for padded rows of value classes."""
    best = np.where(cls == len(_CLASSES), ESCAPE, len(COUNTS) - 1).astype(np.uint8)
    top, span = cls, 1
    for s in range(len(COUNTS) - 2, -1, -1):
        if s == ESCAPE:
            continue
        need = int(COUNTS[s])
        while span < need:  # widen the window by its own length at most
            step = min(span, need - span)
            shifted = np.zeros_like(top)
            shifted[:, :-step] = top[:, step:]
            top, span = np.maximum(top, shifted), span + step
        fits = top <= np.searchsorted(_CLASSES, WIDTHS[s])
        if not fits.any():
            continue
        best[fits] = s
    return best


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, offsets, exceptions)``; block k is words[offsets[k]:offsets[k + 1]]."""
    values = np.ascontiguousarray(values, np.uint64)
    n_blocks = -(-len(values) // BLOCK)
    if not n_blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32), np.zeros(0, np.uint64)
    padded = np.zeros((n_blocks, BLOCK + _PAD), np.uint64)
    whole = len(values) // BLOCK
    padded[:whole, :BLOCK] = values[: whole * BLOCK].reshape(whole, BLOCK)
    padded[whole:, : len(values) - whole * BLOCK] = values[whole * BLOCK :]
    sel = _selectors(_classes(padded.ravel()).reshape(padded.shape))
    ends = np.full(n_blocks, BLOCK, np.int64)
    ends[-1] = len(values) - (n_blocks - 1) * BLOCK
    rows, at, n_words = np.arange(n_blocks), np.zeros(n_blocks, np.int64), np.zeros(n_blocks, np.int64)
    steps = []
    while len(rows):
        s = sel[rows, at]
        steps.append((rows, at, s))
        n_words[rows] += 1
        at = at + COUNTS[s]
        more = at < ends[rows]
        rows, at = rows[more], at[more]
    offsets = np.zeros(n_blocks + 1, np.int64)
    np.cumsum(n_words, out=offsets[1:])
    words = np.zeros(offsets[-1], np.uint64)
    place = np.concatenate([offsets[r] + k for k, (r, _, _) in enumerate(steps)])
    start = np.concatenate([r * (BLOCK + _PAD) + a for r, a, _ in steps])
    chosen = np.concatenate([s for _, _, s in steps])
    flat = padded.ravel()
    exceptions = np.zeros(0, np.uint64)
    for s in np.unique(chosen):
        mine = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            mine = mine[np.argsort(place[mine])]
            exceptions = flat[start[mine]]
            packed = np.arange(len(mine), dtype=np.uint64)
        else:
            packed = np.zeros(len(mine), np.uint64)
            if WIDTHS[s]:
                for k in range(int(COUNTS[s])):
                    packed |= flat[start[mine] + k] << np.uint64(k * int(WIDTHS[s]))
        words[place[mine]] = packed | np.uint64(int(s) << 60)
    return words, offsets.astype(np.uint32), exceptions


def decode(words: np.ndarray, offsets: np.ndarray, exceptions: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values behind :func:`encode`'s arrays."""
    n_blocks = len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64)
    offsets = offsets.astype(np.int64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[sel])
    starts = ends - COUNTS[sel]
    block = np.repeat(np.arange(n_blocks), np.diff(offsets))
    at = starts - starts[offsets[:-1]][block] + block * (BLOCK + _PAD)
    flat = np.zeros(n_blocks * (BLOCK + _PAD), np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for s in np.unique(sel):
        mine = np.flatnonzero(sel == s)
        if s == ESCAPE:
            flat[at[mine]] = exceptions[payload[mine].astype(np.int64)]
        elif WIDTHS[s]:
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            for k in range(int(COUNTS[s])):
                flat[at[mine] + k] = (payload[mine] >> np.uint64(k * int(WIDTHS[s]))) & mask
    return flat.reshape(n_blocks, BLOCK + _PAD)[:, :BLOCK].reshape(-1)[:n]
