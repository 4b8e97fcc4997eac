"""Anchors for exact repeats of a fixed window length.

A *window* is ``window`` consecutive symbols (bytes, or hashes of words) of one
document. Its *anchor* is the ``gram`` consecutive symbols inside it with the
least hash (the rightmost among equal ones), so equal windows have equal
anchors at equal places. The windows with the same anchor place are neighbours:
a run ``start .. start + extent``, whose symbols form a *segment*. A text of n
symbols has about 2 n / (window - gram + 2) segments, and every window belongs
to just one. So repeats can be sought segment by segment:

* segments with the same anchor hash go to the same task,
* equal segments hold the same windows: only the first of them is looked at,
* different segments with the same anchor may share some windows.

All functions work on numpy arrays; hashes are 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols handled at once; also the bound on places inside a block.
BLOCK = 1 << 18
_PLACE_BITS = 22
_MULTIPLIERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))
_SHIFT = np.uint64(29)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers (finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _BYTE_SYMBOLS[data]


def _join(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    h = a * _MULTIPLIERS[level]
    h += b
    h ^= h >> _SHIFT
    return h


def gram_hashes(symbols: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """For each length, the hash of the symbols from each place on. A length is
    put together from powers of two, the largest first."""
    powers, level, step = {1: symbols}, 0, 1
    while 2 * step <= max(lengths):
        h = powers[step]
        powers[2 * step] = _join(h[:-step], h[step:], level) if len(h) > step else h[:0]
        step, level = 2 * step, level + 1
    out = []
    for n in lengths:
        size = max(0, len(symbols) - n + 1)
        done, total = 0, None
        for p in sorted(powers, reverse=True):
            if n - done >= p:
                part = powers[p][done : done + size]
                total = part if total is None else _join(total, part, 7)
                done += p
        out.append(mix(total[:size]))
    return out


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys."""
    have = 1
    while 2 * have <= width:
        keys = np.minimum(keys[:-have], keys[have:])
        have *= 2
    rest = width - have
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


@dataclass
class Segments:
    """Columns of equal length; ``doc`` is the number of the text in its batch."""

    anchor: np.ndarray  # hash of the anchor's symbols
    content: np.ndarray  # hash of all the segment's symbols and the anchor's place
    doc: np.ndarray
    start: np.ndarray  # place of the first window in its text
    extent: np.ndarray  # number of its windows, less one
    offset: np.ndarray  # place of the anchor after start

    @staticmethod
    def together(parts: list[Segments]) -> Segments:
        names = Segments.__dataclass_fields__
        return Segments(**{n: np.concatenate([getattr(p, n) for p in parts]) if parts else np.empty(0, np.uint64 if n in ("anchor", "content") else np.int64) for n in names})


def _block_segments(symbols: np.ndarray, firsts: np.ndarray, docs: np.ndarray, starts: np.ndarray, window: int, gram: int, heavy: np.ndarray) -> Segments:
    """Segments of texts that stand one after the other in ``symbols``, from
    the places ``firsts`` on; ``starts``: those places in the whole texts."""
    width = window - gram + 1
    grams, windows = gram_hashes(symbols, (gram, window))
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    places = np.arange(len(grams), dtype=np.uint64)
    keys = (grams >> np.uint64(1) & ~mask) | (mask - places)
    if len(heavy):
        found = np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)
        keys |= (heavy[found] == grams).astype(np.uint64) << np.uint64(63)
    least = sliding_least(keys, width)
    anchors = (mask - (least & mask)).astype(np.int64)
    ends = np.append(firsts[1:], len(symbols))
    fits = np.zeros(len(anchors) + 1, np.int32)  # windows inside one text
    ok = ends - firsts >= window
    np.add.at(fits, firsts[ok], 1)
    np.add.at(fits, ends[ok] - window + 1, -1)
    place = np.flatnonzero(np.cumsum(fits[:-1]) > 0)
    anchor = anchors[place]
    new = np.ones(len(place), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)
    low = place[new]
    high = place[np.append(np.flatnonzero(new)[1:] - 1, len(place) - 1)] if len(place) else low
    at = anchor[new]
    text = np.searchsorted(firsts, low, "right") - 1
    content = mix(windows[low] * _MULTIPLIERS[0] + (windows[high] ^ mix(((high - low) << 16 | (at - low)).astype(np.uint64))))
    return Segments(grams[at], content, docs[text], low - firsts[text] + starts[text], high - low, at - low)


def segments(texts: list[np.ndarray], window: int, gram: int, heavy: np.ndarray = np.empty(0, np.uint64)) -> Segments:
    """The segments of some texts, each an array of symbols. Grams whose hash
    is in ``heavy`` (sorted) are anchors only where there is no other. Texts are taken in
    blocks of about ``BLOCK`` symbols; a longer one is cut into blocks that
    overlap so that every window is in one of them."""
    out, held, total = [], [], 0

    def done():
        nonlocal held, total
        if held:
            sizes = np.array([len(x) for x, _, _ in held])
            firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            out.append(_block_segments(np.concatenate([x for x, _, _ in held]), firsts, np.array([d for _, d, _ in held]), np.array([s for _, _, s in held]), window, gram, heavy))
        held, total = [], 0

    for doc, symbols in enumerate(texts):
        if len(symbols) < window:
            continue
        for a in range(0, len(symbols) - window + 1, BLOCK):
            piece = symbols[a : a + BLOCK + window - 1]
            if total and total + len(piece) > BLOCK + window:
                done()
            held.append((piece, doc, a))
            total += len(piece)
    done()
    return Segments.together(out)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_WORD_TABLE = mix(np.arange(1, 64 * 256 + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_bounds(data: bytes, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words, runs of bytes that are not ``outside``; of
    anything but ASCII white space, if not told otherwise."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~outside[np.frombuffer(data, np.uint8)]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_symbols(data: bytes, outside: np.ndarray = _SPACE) -> np.ndarray:
    """A 64-bit hash of each word (tabulation by byte and place)."""
    starts, ends = word_bounds(data, outside)
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    base = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(base, sizes)
    values = np.frombuffer(data, np.uint8)[place + np.repeat(starts, sizes)].astype(np.int64)
    values = _WORD_TABLE[(place & 63) << 8 | values]
    if sizes.max() > 64:
        values = values * ((place >> 6 << 1) + 1).astype(np.uint64)
    return mix(np.add.reduceat(values, base) + mix(sizes))
