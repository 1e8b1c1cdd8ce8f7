"""Removal of byte strings that an earlier document already has.

Prefix-free parsing: the hash of every ``KGRAM`` bytes is rolled over a text,
and the least hash within a window of ``window`` bytes is its trigger.
Consecutive windows with one trigger form a phrase, and neighbouring phrases
overlap by ``window - 1`` bytes, so that each window lies in just one phrase
and equal windows lie in phrases of equal trigger, wherever they stand. The
parse of a document is its sequence of phrases; the dictionary holds each
distinct phrase with the least document that has it.

The suffixes of the dictionary are dealt out by trigger and put in order to a
depth of ``window`` bytes. Suffixes that agree to that depth stand together,
with the least document of all of them, and the parse carries the verdict back
to each place where a phrase stands. Copied text costs one dictionary entry a
block, however often it occurs, and no task sees all places of a phrase.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import _ODD, MAX_ID, blocks_for, mix64, words64

WINDOW = 50
KGRAM = 10
#: Windows in a phrase at most; with it the first and the last window of a
#: phrase hold all of its bytes.
RUN = WINDOW
#: Text that one block of documents, and one share of the dictionary, stand for.
BLOCK_BYTES = 6 << 20
#: Windows that are hashed at a time.
STEP = 1 << 17
#: Phrases that are hashed at a time.
SLICE = 1 << 12

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def window_hashes(x8: np.ndarray, at: np.ndarray | slice, window: int) -> np.ndarray:
    """64-bit hash of the ``window`` bytes (8 at least) at the positions ``at``;
    x8: the 8-byte words of the text."""
    out: np.ndarray | None = None
    offsets = [*range(0, window - 7, 8)]
    if offsets[-1] != window - 8:
        offsets.append(window - 8)
    n = len(x8) - (window - 8)
    with np.errstate(over="ignore"):
        for k, o in enumerate(offsets):
            part = x8[o : o + n] if isinstance(at, slice) else x8[at + o]
            part = (part ^ (part >> np.uint64(29))) * _ODD[2 + k % 60]
            part ^= part >> np.uint64(32)
            part *= _ODD[(3 + 2 * k) % 64]
            out = part if out is None else out + part
    return mix64(out)


def rolled(x8: np.ndarray) -> np.ndarray:
    """Hash of the KGRAM bytes at each position."""
    with np.errstate(over="ignore"):
        h = x8[KGRAM - 8 :] >> np.uint64(31)
        h ^= x8[KGRAM - 8 :]
        h *= _ODD[41]
        h += x8[: len(x8) - (KGRAM - 8)] * _ODD[40]
    return mix64(h)


def phrase_hash(x8: np.ndarray, first: np.ndarray, count: np.ndarray, window: int) -> np.ndarray:
    """Hash of the phrases of ``count`` windows at ``first``."""
    with np.errstate(over="ignore"):
        return mix64(window_hashes(x8, first, window) + window_hashes(x8, first + count - 1, window) * _ODD[50] + count.astype(np.uint64) * _ODD[51])


def phrases(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int = WINDOW):
    """Phrases of the texts buffer[starts[i]:ends[i]], which lie side by side.

    Returns for each phrase: first byte, number of windows, trigger, hash.
    """
    n = len(buffer) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    x8 = words64(buffer)
    h = rolled(x8)[: n + window - KGRAM]
    span, width = window - KGRAM + 1, 1
    while 2 * width <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    if width < span:
        h = np.minimum(h[: len(h) - (span - width)], h[span - width :])
    owner = np.repeat(np.arange(len(starts)), ends - starts)[:n]
    valid = np.arange(n) + window <= ends[owner]
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new & valid)
    # A run ends where the next begins or where its text's last window lies.
    stop = np.minimum(np.append(np.flatnonzero(new), n)[np.searchsorted(np.flatnonzero(new), first) + 1], ends[owner[first]] - window + 1)
    count = stop - first
    if (count > RUN).any():
        pieces = -(-count // RUN)
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, count = np.repeat(first, pieces) + k * RUN, np.minimum(RUN, np.repeat(count, pieces) - k * RUN)
    key = h[first]
    return first, count, key, phrase_hash(x8, first, count, window)


def gather(buffer: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes buffer[first[i]:first[i]+length[i]], one after the other."""
    before = np.cumsum(length) - length
    return buffer[np.repeat(first - before, length) + np.arange(int(length.sum()))]


def block_phrases(ids: np.ndarray, texts: list[bytes], window: int):
    """Phrases of a block: document index, first byte in it, windows, trigger,
    hash, and the bytes themselves as (buffer, place)."""
    parts, buffers, base = [], [], 0
    k = 0
    while k < len(texts):
        starts, ends, which, lo, size, data = [], [], [], [], 0, []
        while k < len(texts) and (not size or size + len(texts[k]) <= STEP):
            t = texts[k]
            for at in range(0, max(1, len(t) - window + 1), STEP):
                piece = t[at : at + STEP + window - 1]
                starts.append(size)
                size += len(piece)
                ends.append(size)
                which.append(k)
                lo.append(at)
                data.append(piece)
            k += 1
        buffer = np.frombuffer(b"".join(data), np.uint8)
        first, count, key, ident = phrases(buffer, np.array(starts), np.array(ends), window)
        s = np.searchsorted(starts, first, "right") - 1
        parts.append((np.array(which)[s], first - np.array(starts)[s] + np.array(lo)[s], count, key, ident, first + base))
        buffers.append(buffer)
        base += len(buffer)
    return [np.concatenate(x) for x in zip(*parts, strict=True)], np.concatenate(buffers)


def _ordered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Documents of a block by id and text, the same whenever it is computed:
    the place of each in the table, ids with null as the largest, texts."""
    ids = table.column("doc_id").to_pylist()
    texts = [t or b"" for t in table.column("_text").to_pylist()]
    order = sorted(range(len(ids)), key=lambda i: (MAX_ID if ids[i] is None else ids[i], texts[i]))
    return np.array(order), np.array([MAX_ID if ids[i] is None else ids[i] for i in order], np.int64), [texts[i] for i in order]


def _dictionary(ids: np.ndarray, parsed: list[np.ndarray], buckets: int):
    """Distinct phrases of a block by bucket and hash: index of the first place
    of each, its bucket, and for each place its phrase. Within a bucket phrases
    stand as in the texts, which makes them shorter once compressed."""
    doc, _, _, key, ident, _ = parsed
    _, at, back = np.unique(ident, return_index=True, return_inverse=True)
    bucket = (key[at] % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((at, bucket))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return at[order], bucket[order], rank[back]


def dedup_substrings(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Remove each byte covered by a string of ``window`` bytes that also
    starts in a document with a smaller ``doc_id``.

    Texts are their UTF-8 bytes, matches never cross documents, and strings are
    judged on the input. A null or empty text, and one shorter than a window,
    loses nothing. Rows with one doc_id don't count as earlier than each other,
    so repeated rows lose nothing to one another; a null doc_id is later than
    all others. Further columns are ignored. An empty table gives no rows.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and ``kept``, the remaining bytes.
    """
    blocks = blocks_for(docs, "text", block_bytes)
    buckets = blocks + blocks // 2
    rows = docs.select(
        # By text too, so that rows without an id, or with one id, don't share a block.
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("_text"),
    )

    def parse(table: pa.Table) -> pa.Table:
        _, ids, texts = _ordered(table)
        block = table.column("block")[0].as_py()
        parsed, buffer = block_phrases(ids, texts, window)
        at, bucket, _ = _dictionary(ids, parsed, buckets)
        doc, _, count, _, _, place = parsed
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(at))
        press = zstandard.ZstdCompressor(level=6)
        out = []
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            own = at[a:z]
            data = b"".join((count[own].astype(np.uint8).tobytes(), np.diff(ids[doc[own]], prepend=0).tobytes(), gather(buffer, place[own], count[own] + window - 1).tobytes()))
            out.append((int(bucket[a]), block, z - a, press.compress(data)))
        return pa.table({k: pa.array([r[i] for r in out], t) for i, (k, t) in enumerate((("bucket", pa.int32()), ("block", pa.int32()), ("n", pa.int64()), ("data", pa.binary())))})

    def order(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        counts, least, texts = [], [], []
        unpress = zstandard.ZstdDecompressor()
        for n, z in zip(sizes, table.column("data").to_pylist(), strict=True):
            data = unpress.decompress(z)
            counts.append(np.frombuffer(data, np.uint8, n))
            least.append(np.cumsum(np.frombuffer(data, np.int64, n, n)))
            texts.append(np.frombuffer(data, np.uint8, offset=9 * n))
        count = np.concatenate(counts).astype(np.int64)
        covered = verdicts(count, np.concatenate(least), np.concatenate(texts), window)
        out, lo = [], 0
        press = zstandard.ZstdCompressor(level=1)
        for n, size in zip(sizes, np.add.reduceat(count, np.cumsum([0, *sizes[:-1]])), strict=True):
            out.append(press.compress(np.packbits(covered[lo : lo + size]).tobytes()))
            lo += size
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array(out, pa.binary())})

    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        places, ids, texts = _ordered(left)
        parsed, _ = block_phrases(ids, texts, window)
        at, bucket, phrase = _dictionary(ids, parsed, buckets)
        doc, start, count, _, _, _ = parsed
        lead = doc[at]
        length = count[at]
        before = np.cumsum(length) - length
        known = np.zeros(int(length.sum()), bool)
        unpress = zstandard.ZstdDecompressor()
        for b, z in zip(right.column("bucket").to_pylist(), right.column("bits").to_pylist(), strict=True):
            lo, hi = np.searchsorted(bucket, [b, b + 1])
            n = int(length[lo:hi].sum())
            known[before[lo] : before[lo] + n] = np.unpackbits(np.frombuffer(unpress.decompress(z), np.uint8), count=n)
        cells = [[] for _ in range(6)]
        runs = np.searchsorted(doc, np.arange(len(texts) + 1))
        for k, t in enumerate(texts):
            marks = np.zeros(len(t) + 1, np.int64)
            own = slice(runs[k], runs[k + 1])
            p, s, c = phrase[own], start[own], count[own]
            if len(p):
                later = ids[lead[p]] < ids[k]
                idx = np.repeat(before[p] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
                hit = known[idx] | np.repeat(later, c)
                at_byte = (np.repeat(s - (np.cumsum(c) - c), c) + np.arange(int(c.sum())))[hit]
                np.add.at(marks, at_byte, 1)
                np.add.at(marks, at_byte + window, -1)
            gone = np.cumsum(marks[:-1]) > 0
            kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
            for cell, v in zip(cells, (None if ids[k] == MAX_ID else int(ids[k]), len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                cell.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, cells, kinds, strict=True)})

    parsed = rows.groupBy("block").applyInArrow(parse, "bucket int, block int, n long, data binary")
    judged = parsed.groupBy("bucket").applyInArrow(order, "block int, bucket int, bits binary")
    return rows.groupBy("block").cogroup(judged.groupBy("block")).applyInArrow(cut, RESULT)


def verdicts(count: np.ndarray, least: np.ndarray, buffer: np.ndarray, window: int) -> np.ndarray:
    """For each window of the phrases (``count`` windows each, bytes side by
    side in ``buffer``): whether a smaller document than the phrase's ``least``
    has it. Windows of one content stand together once their hashes are in
    order; the least document of each run decides."""
    least = np.unique(least, return_inverse=True)[1].astype(np.int32)
    length = count + window - 1
    start = np.cumsum(length) - length
    ident, trigger = np.empty((2, len(count)), np.uint64)
    for a in range(0, len(count), SLICE):
        own = slice(a, a + SLICE)
        lo = start[a]
        x8 = words64(buffer[lo : lo + int(length[own].sum())])
        bounds = np.stack((start[own], start[own] + length[own] - KGRAM + 1), axis=1).ravel() - lo
        trigger[own] = np.minimum.reduceat(np.append(rolled(x8), np.uint64(0)), bounds)[::2]
        ident[own] = phrase_hash(x8, start[own] - lo, count[own], window)
    # Equal phrases first: all but those of the least document are covered whole.
    by = np.lexsort((least, ident))
    head = np.append(True, ident[by][1:] != ident[by][:-1])
    group = np.cumsum(head) - 1
    lead = by[head]
    rank = np.empty(len(count), np.int64)
    rank[by] = group
    # Windows can be equal only under one trigger: where all phrases of a
    # trigger are equal, there is nothing to put in order.
    n = count[lead]
    before = np.cumsum(n) - n
    lowest = least[lead].repeat(n)
    _, kind, kinds = np.unique(trigger[lead], return_inverse=True, return_counts=True)
    some = np.flatnonzero(kinds[kind] > 1)
    own = lead[some]
    c = count[own]
    inner = np.cumsum(c) - c
    h = np.empty(int(c.sum()), np.uint64)
    for a in range(0, len(own), SLICE):
        part = own[a : a + SLICE]
        x8 = words64(gather(buffer, start[part], length[part]))
        at = np.repeat(np.arange(len(part)) * (window - 1), count[part]) + np.arange(int(count[part].sum()))
        h[inner[a] : inner[a] + len(at)] = window_hashes(x8, at, window)
    if len(h):
        by = np.argsort(h)
        at = np.repeat((before[some] - inner).astype(np.int32), c)
        at += np.arange(len(h), dtype=np.int32)
        at = at[by]
        h = h[by]
        del by
        run = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        low = np.minimum.reduceat(lowest[at], run)
        lowest[at] = np.repeat(low, np.diff(np.append(run, len(h))))
    del h
    out = []
    for a in range(0, len(count), SLICE):
        own = slice(a, a + SLICE)
        c = count[own]
        idx = np.repeat(before[rank[own]] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
        out.append(lowest[idx] < np.repeat(least[own], c))
    return np.concatenate(out)
