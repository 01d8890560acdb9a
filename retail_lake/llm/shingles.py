"""Word shingles of texts as sets of 64-bit hashes, computed on flat byte buffers."""

import numpy as np

WORDS = 5

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of every word, A-Z lower-cased, in the order of the text."""
    blank = _BLANK[data]
    first = ~blank
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[offsets] = True
    first[1:] &= blank[:-1] | starts_text[1:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    solid = np.flatnonzero(~blank)
    begins = np.searchsorted(solid, at)
    sizes = np.diff(np.append(begins, len(solid)))
    place = np.arange(len(solid)) - np.repeat(begins, sizes)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(sizes.max()), _BASE)]), dtype=np.uint64)
    hashes = np.add.reduceat(_BYTE[_LOWER[data[solid]]] * powers[place], begins)
    rows = np.searchsorted(offsets, at, side="right") - 1
    return rows, mixed(hashes)


def shingle_sets(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each row's set in the hashes, and the hashes: distinct and ascending
    within a row. A row of fewer words has its whole sequence as one shingle; a row
    without words has none."""
    count = len(offsets) - 1
    rows, words = word_hashes(offsets, data)
    per_row = np.bincount(rows, minlength=count)
    begins = np.cumsum(per_row) - per_row
    spans = np.where(per_row >= WORDS, per_row - WORDS + 1, (per_row > 0).astype(np.int64))
    out = np.zeros(int(spans.sum()), np.uint64)
    to = np.cumsum(spans) - spans

    long = per_row >= WORDS
    if long.any():
        size = len(words) - WORDS + 1
        sums = words[:size] * _PLACE[0]
        for k in range(1, WORDS):
            sums += words[k : k + size] * _PLACE[k]
        whole = rows[:size] == rows[WORDS - 1 :]
        out[np.repeat(long, spans)] = mixed(sums[whole])
    for n in range(1, WORDS):
        short = np.flatnonzero(per_row == n)
        sums = np.full(len(short), _SHORT[n])
        for k in range(n):
            sums += words[begins[short] + k] * _PLACE[k]
        out[to[short]] = mixed(sums)

    ends = np.cumsum(spans)
    for a, b in zip(to[spans > 1].tolist(), ends[spans > 1].tolist(), strict=True):
        out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[to[spans > 0]] = True
    bounds = np.concatenate([[0], np.cumsum(new)])[np.concatenate([to, [len(out)]])]
    return bounds, out[new]
