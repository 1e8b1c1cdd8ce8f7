"""Encoding of whole texts unit by unit.

A unit is a stretch of text that no token reaches beyond (a word between
white space). Each worker encodes a unit once, many at a time, with the
tokenizers library, and keeps its ids; a text's ids are those of its units,
one after the other. Units are known by 64-bit hashes of their bytes.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

from tillroll.llm.common import hashed_words

#: Units that a worker keeps; beyond, it starts anew.
KEEP = 1_500_000
#: Units that are joined into one string for the library.
JOIN = 256


class UnitEncoder:
    """Ids of units, kept by the units' hash."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], keep: int = KEEP):
        self.encode, self.keep = encode, keep
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.start = np.zeros(1, np.int64)

    def batch(self, texts: list[bytes], gap: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts side by side, and the number of each text's ids.
        Units stand between bytes of ``gap``; bytes of equal ``values`` are one."""
        buffer, start, end, h, words = hashed_words(texts, gap, values)
        distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.place) + len(distinct) > self.keep:
            self.clear()
        at = np.fromiter((self.place.get(x, -1) for x in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        if len(new):
            data = buffer.tobytes()
            coded = self.encode([data[a:z] for a, z in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
            n = len(self.start) - 1
            at[new] = np.arange(n, n + len(new))
            self.place.update(zip(distinct[new].tolist(), range(n, n + len(new)), strict=True))
            size = np.array([len(x) // 4 for x in coded], np.int64)
            ends = self.start[-1] + np.cumsum(size)
            while len(self.ids) < ends[-1]:
                self.ids = np.append(self.ids, np.zeros_like(self.ids))
            self.ids[self.start[-1] : ends[-1]] = np.frombuffer(b"".join(coded), "<u4")
            self.start = np.append(self.start, ends)
        unit = at[back]
        size = self.start[unit + 1] - self.start[unit]
        upto = np.append(0, np.cumsum(size))
        ids = self.ids[np.repeat(self.start[unit] - upto[:-1], size) + np.arange(upto[-1])]
        return ids, np.diff(upto[np.append(0, np.cumsum(words))])


def encode_joined(tokenizer, units: list[str], glue: str) -> list[bytes]:
    """Ids of each unit, from strings of many units with ``glue`` between them
    (a space that starts a unit, or that yields no token). The library encodes
    the strings as one batch, on as many threads as it is given."""
    out: list[bytes] = []
    groups = [units[a : a + JOIN] for a in range(0, len(units), JOIN)]
    for group, enc in zip(groups, tokenizer.encode_batch([glue.join(g) for g in groups], add_special_tokens=False), strict=True):
        ids = np.array(enc.ids, "<u4")
        at = np.array([o[0] for o in enc.offsets], np.int64)
        starts = np.cumsum([0, *(len(u) + len(glue) for u in group[:-1])])
        cuts = np.searchsorted(at, np.append(starts, np.iinfo(np.int64).max)).tolist()
        out += [ids[a:z].tobytes() for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def encode_letters(tokenizer, ends: np.ndarray, units: list[str]) -> list[bytes]:
    """Ids of units of letters, for a tokenizer whose last token of a word says
    so (``ends``, by id), which spares the offsets. A group in which a unit is
    not one word, as the count of ends shows, goes by offsets."""
    out: list[bytes] = []
    groups = [units[a : a + JOIN] for a in range(0, len(units), JOIN)]
    for group, enc in zip(groups, tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
        ids = np.array(enc.ids, "<u4")
        cuts = np.flatnonzero(ends[ids]) + 1
        if len(cuts) != len(group) or cuts[-1] != len(ids):
            out += encode_joined(tokenizer, group, " ")
            continue
        data, cuts = ids.tobytes(), (4 * cuts).tolist()
        out += [data[a:z] for a, z in zip([0, *cuts], cuts, strict=False)]
    return out


def threads(n: int) -> None:
    """Let the tokenizers library use ``n`` threads; before its first batch."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if n > 1 else "false"
    os.environ.setdefault("RAYON_NUM_THREADS", str(n))
