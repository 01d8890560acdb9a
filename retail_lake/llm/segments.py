"""Encode whole columns of text by encoding each distinct segment once.

A byte-level BPE splits text by a pattern before it merges, so a text may be cut
wherever a pattern match ends for certain, and the ids of the parts put together
are the ids of the whole. Such safe boundaries lie before a space that a solid
character follows, and around a line break between solid characters. Segments
between them (mostly words) repeat a lot: each distinct one of a run of texts is
encoded once, and a bounded cache remembers them from run to run.
"""

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from retail_lake.llm.common import pieces, text_bytes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism

#: Bytes of text searched for distinct segments at once.
RUN_BYTES = 16 << 20
#: Segments a worker remembers (about 200 bytes each).
CACHED = 400_000
#: Bytes of joined segments given to the library at once.
JOINED_BYTES = 64 << 10

# Printable ASCII is no white space in any sense. Of the characters beyond ASCII,
# white ones start with one of four bytes; any other start byte is solid too.
_INK = np.zeros(256, bool)
_INK[0x21:0x7F] = True
_SOLID = _INK.copy()
_SOLID[0x80:] = True
_SOLID[[0xC2, 0xE1, 0xE2, 0xE3]] = False


def safe_boundaries(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Byte positions at which texts start, end, or may be cut."""
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    cut[0] = cut[-1] = True
    if len(data) > 2:
        space = np.flatnonzero(data[1:-1] == 0x20) + 1
        cut[space[_SOLID[data[space + 1]] | _INK[data[space - 1]]]] = True
        line = np.flatnonzero(data[1:-1] == 0x0A) + 1
        line = line[_INK[data[line - 1]] & _SOLID[data[line + 1]]]
        cut[line] = cut[line + 1] = True
    return np.flatnonzero(cut)


def gathered(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The slices ``values[start : start + length]`` one after another."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(total)]


class SegmentEncoder:
    """``encode`` gives the ids of a text, ``widths`` the bytes of every id."""

    def __init__(self, encode: Callable[[str], np.ndarray], widths: np.ndarray):
        self.encode, self.widths = encode, widths
        self.known: dict[bytes, bytes] = {}

    def column(self, texts: pa.Array):
        """Runs of rows as ``(first row, last row, offsets, ids)``; ids are uint32."""
        for first, last, offsets, data in pieces(texts, RUN_BYTES):
            cuts = safe_boundaries(offsets, data)
            bounds, ids = self._run(cuts, data)
            yield first, last, bounds[np.searchsorted(cuts, offsets)], ids

    def _run(self, cuts: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each segment in the ids, and the ids."""
        if len(cuts) < 2:
            return np.zeros(max(len(cuts), 1), np.int64), np.zeros(0, np.uint32)
        parts = pa.Array.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]
        ).dictionary_encode()
        found = self._distinct(parts.dictionary.to_pylist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        which = parts.indices.to_numpy()
        each = lengths[which]
        ids = gathered(starts[which], each, np.frombuffer(b"".join(found), np.uint32))
        return np.concatenate([[0], np.cumsum(each)]), ids

    def _distinct(self, segments: list[bytes]) -> list[bytes]:
        """The ids of each segment, as bytes of uint32."""
        known = self.known
        found = list(map(known.get, segments))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(known) + len(new) > CACHED:
            known.clear()
        joined, size = [], 0
        for i in new:
            segment = segments[i]
            if len(segment) > 1 and segment[0] == 0x20 and _SOLID[segment[1]]:
                joined.append(i)
                size += len(segment)
                if size >= JOINED_BYTES:
                    self._together(joined, segments, found)
                    joined, size = [], 0
            else:  # its start need not be a boundary behind another segment
                found[i] = self._ids(segment).tobytes()
        self._together(joined, segments, found)
        for i in new[:CACHED]:
            known[segments[i]] = found[i]
        return found

    def _ids(self, segment: bytes) -> np.ndarray:
        return np.asarray(self.encode(segment.decode("utf-8", "replace")), np.uint32)

    def _together(self, joined: list[int], segments: list[bytes], found: list) -> None:
        """Encode segments that all start at safe boundaries as one text, and tell
        them apart by the bytes of their ids."""
        if not joined:
            return
        parts = [segments[i] for i in joined]
        ends = np.cumsum([len(p) for p in parts])
        try:
            ids = np.asarray(self.encode(b"".join(parts).decode()), np.uint32)
        except UnicodeDecodeError:
            for i in joined:
                found[i] = self._ids(segments[i]).tobytes()
            return
        reached = np.cumsum(self.widths[ids])
        upto = np.searchsorted(reached, ends) + 1
        flat, start = ids.tobytes(), 0
        for i, end in zip(joined, upto.tolist(), strict=True):
            found[i] = flat[4 * start : 4 * end]
            start = end


def slices(offsets: np.ndarray, data: np.ndarray) -> list[bytes]:
    """Each row's bytes."""
    flat = data.tobytes()
    return [flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def byte_slices(column: pa.Array) -> list[bytes]:
    return slices(*text_bytes(column))
