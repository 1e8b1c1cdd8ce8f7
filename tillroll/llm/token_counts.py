"""Token counts that follow edits.

A text is cut into leaves at places that no token crosses, before a lone space
between two characters that aren't white space. A segment tree over the leaves
has their lengths and token counts as sums. An edit finds its leaves by going
down the tree, and only these and one neighbour on each side are encoded anew;
the outer cuts of that stretch depend on characters which the edit leaves as
they were. The sums above change along the paths to the root.

The trees are a table, with the leaves of each document and their counts. A batch of
edits reads it and gives the trees after the edits, for the next batch; texts are
encoded whole once, when the table is made.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize

#: Characters of a leaf, about.
LEAF = 512
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Edits of the query: mail addresses and long numbers give way to a mark.
_REDACT = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]*\w|\d[\d -]{5,}\d")
EDIT = "edits array<struct<start:int,end:int,text:string>>"

_encodings: dict = {}


def encoding(ranks_path: str, pattern: str):
    """The tiktoken encoding of a rank file, made once in each worker."""
    if ranks_path not in _encodings:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[ranks_path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[ranks_path]


def cut(text: str, leaf: int = LEAF) -> list[str]:
    """Pieces of about ``leaf`` characters whose tokens are those of the text."""
    out, lo = [], 0
    while len(text) - lo > leaf:
        m = _CUT.search(text, lo + leaf)
        if not m:
            break
        out.append(text[lo : m.start()])
        lo = m.start()
    return [*out, text[lo:]] if lo < len(text) else out


class Counter:
    """A text's leaves and the sums of lengths and token counts over them."""

    def __init__(self, text: str, count, leaf: int = LEAF):
        self.count, self.leaf, self.encoded = count, leaf, 0
        self._build(cut(text, leaf))

    @classmethod
    def of(cls, leaves: list[str], counts: list[int], count, leaf: int = LEAF) -> Counter:
        """The tree of leaves whose counts are known; nothing is encoded."""
        tree = cls("", count, leaf)
        tree._place([(x, (len(x), n)) for x, n in zip(leaves, counts, strict=True)])
        return tree

    def stored(self) -> tuple[list[str], list[int]]:
        """The leaves and their counts."""
        own = [(x, self.sums[self.size + k][1]) for k, x in enumerate(self.leaves) if x]
        return [x for x, _ in own], [n for _, n in own]

    def _build(self, leaves: list[str]) -> None:
        self.size = 1 << max(0, len(leaves) - 1).bit_length()
        self.leaves = leaves + [""] * (self.size - len(leaves))
        self.sums = [(0, 0)] * self.size + [self._leaf(x) for x in self.leaves]
        for k in range(self.size - 1, 0, -1):
            self._join(k)

    def _leaf(self, text: str) -> tuple[int, int]:
        self.encoded += len(text)
        return len(text), self.count(text) if text else 0

    def _join(self, k: int) -> None:
        a, b = self.sums[2 * k], self.sums[2 * k + 1]
        self.sums[k] = (a[0] + b[0], a[1] + b[1])

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    @property
    def length(self) -> int:
        return self.sums[1][0]

    def text(self) -> str:
        return "".join(self.leaves)

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that has the character at ``place``, and where it begins."""
        k, before = 1, 0
        while k < self.size:
            k *= 2
            if place >= before + self.sums[k][0] and self.sums[k + 1][0]:
                before += self.sums[k][0]
                k += 1
        return k - self.size, before

    def edit(self, start: int, end: int, text: str) -> None:
        """Put ``text`` for the characters from ``start`` to before ``end``;
        places beyond the text count as its end."""
        start = min(max(0, start), self.length)
        end = min(max(start, end), self.length)
        first, lo = self._find(start)
        last, _ = self._find(max(start, end - 1))
        # One leaf with text more on each side.
        first = next((k for k in range(first - 1, -1, -1) if self.leaves[k]), first)
        last = next((k for k in range(last + 1, self.size) if self.leaves[k]), last)
        old = "".join(self.leaves[first : last + 1])
        lo = sum(self._before(first))
        new = cut(old[: start - lo] + text + old[end - lo :], self.leaf)
        room = last + 1 - first
        if len(new) > room:
            # More leaves than there is room for: the last ones share one, or the tree grows.
            if len(new) > 2 * room + 2:
                known = [(x, s) for k, (x, s) in enumerate(zip(self.leaves, self.sums[self.size :], strict=True)) if x and not first <= k <= last]
                at = sum(1 for k in range(first) if self.leaves[k])
                self._grow(known[:at], new, known[at:])
                return
            new = [*new[: room - 1], "".join(new[room - 1 :])]
        new += [""] * (room - len(new))
        for k, x in enumerate(new, first):
            if x != self.leaves[k]:
                self.leaves[k] = x
                self.sums[self.size + k] = self._leaf(x)
        a, z = (self.size + first) // 2, (self.size + last) // 2
        while a:
            for k in range(a, z + 1):
                self._join(k)
            a, z = a // 2, z // 2

    def _before(self, leaf: int) -> list[int]:
        """Lengths of the subtrees left of a leaf."""
        k, out = self.size + leaf, []
        while k > 1:
            if k % 2:
                out.append(self.sums[k - 1][0])
            k //= 2
        return out

    def _grow(self, before, new: list[str], after) -> None:
        self._place([*before, *((x, self._leaf(x)) for x in new), *after])

    def _place(self, every: list) -> None:
        self.size = 1 << max(0, len(every) - 1).bit_length()
        every += [("", (0, 0))] * (self.size - len(every))
        self.leaves = [x for x, _ in every]
        self.sums = [(0, 0)] * self.size + [s for _, s in every]
        for k in range(self.size - 1, 0, -1):
            self._join(k)


def redactions(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``edits``, which put a mark for each mail address and
    long number; places are those of the text as it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        for b in batches:
            edits = [[{"start": m.start(), "end": m.end(), "text": "[redacted]"} for m in _REDACT.finditer(t or "")][::-1] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(edits, kind)], names=["doc_id", "text", "edits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, text string, {EDIT}")


def token_trees(docs: DataFrame, ranks_path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """The trees of the documents' whole texts: doc_id, leaves (the text in pieces), counts
    (of their tokens), and ``edits`` if the documents have any. A null or empty text has
    no leaves; repeated rows and null ids come back as they are; other columns are
    ignored; an empty table gives no rows."""
    edits = ["edits"] if "edits" in docs.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for b in batches:
            leaves = [cut(t or "", leaf) for t in b.column(1).to_pylist()]
            counts = [[len(enc.encode_ordinary(x)) for x in own] for own in leaves]
            columns = [b.column(0), pa.array(leaves, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32())), *b.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "leaves", "counts", *edits])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *edits)
    return rows.mapInArrow(run, f"doc_id long, leaves array<string>, counts array<int>{', ' + EDIT if edits else ''}")


def edit_trees(trees: DataFrame, ranks_path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """The trees of (doc_id, leaves, counts, edits) rows after the edits, which are made
    one after the other, each on the text that the ones before left; only what they
    touch is encoded.

    Returns doc_id, leaves, counts, n_tokens (before), n_edits, n_tokens_edited,
    n_chars_edited, n_reencoded (characters that the edits had encoded anew). Places beyond
    a text count as its end; null edits are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for b in batches:
            rows: list[list] = [[] for _ in range(7)]
            for leaves, counts, edits in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                c = Counter.of(leaves or [], counts or [], lambda x: len(enc.encode_ordinary(x)), leaf)
                before = c.tokens
                for e in edits or ():
                    c.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
                for cell, v in zip(rows, (*c.stored(), before, len(edits or ()), c.tokens, c.length, c.encoded), strict=True):
                    cell.append(v)
            kinds = [pa.list_(pa.string()), pa.list_(pa.int32()), *[pa.int64()] * 5]
            names = ["doc_id", "leaves", "counts", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "n_reencoded"]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(r, t) for r, t in zip(rows, kinds, strict=True))], names=names)

    schema = "doc_id long, leaves array<string>, counts array<int>, n_tokens long, n_edits long, n_tokens_edited long, n_chars_edited long, n_reencoded long"
    return trees.select("doc_id", "leaves", "counts", "edits").mapInArrow(run, schema)


def count_tokens(edited: DataFrame, ranks_path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """Token counts of (doc_id, text, edits) before and after the edits, by trees that are
    written once.

    Returns doc_id, n_tokens, n_edits, n_tokens_edited, n_chars_edited, n_reencoded (characters that
    the edits had encoded anew). A null or empty text has no tokens, edits of it
    insert, and null edits are none. Long texts are counted whole. Other columns are ignored; repeated rows and
    null ids come back as they are; an empty table gives no rows.
    """
    trees = materialize(token_trees(edited, ranks_path, pattern, leaf), "token-trees")
    return edit_trees(trees, ranks_path, pattern, leaf).drop("leaves", "counts")
