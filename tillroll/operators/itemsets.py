"""Frequent itemsets from blocks of baskets.

The baskets are dealt out in blocks of about ``BLOCK_BASKETS`` by a hash. A block holds
them the other way round, as a list of basket numbers for each item, and is mined by
itself, depth first: the lists of the items after one, cut down to the baskets that
have it, are the next level. A set that is frequent among all baskets is as frequent,
in proportion, in one block at least, so the sets found in the blocks contain all that
are wanted. Their counts are summed; where blocks did not report a set that may still be
frequent, a second pass counts it in all blocks.

The work is dealt out by baskets and not by items: an item that a third of all baskets
have costs its share in every block and makes no task larger than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialize

#: Baskets of a block, about.
BLOCK_BASKETS = 1 << 14
#: Baskets that a frequent set has in a block on average, at least: with fewer, sets
#: would be frequent in some block by chance. Rare sets so make for larger blocks.
BLOCK_SUPPORT = 32
#: Sets of the second pass that go to the tasks at once.
CANDIDATES = 200_000
_ROWS = 20_000


def block_count(baskets: int, least: int, wanted: int | None = None) -> int:
    """Number of blocks for so many baskets and a set's least number of them."""
    return max(1, min(max(wanted or 1, -(-baskets // BLOCK_BASKETS)), least // BLOCK_SUPPORT))


_BLOCK = "baskets long, items array<string>, sizes array<long>, ids binary"


def _vertical(table: pa.Table) -> pa.Table:
    """A block: its items, the rarest first, and the numbers of their baskets."""
    lists = table.column("items").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    basket = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    coded = lists.flatten().dictionary_encode()
    names, item = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    size = np.bincount(item, minlength=len(names))
    order = sorted(range(len(names)), key=lambda k: (size[k], names[k]))
    place = np.zeros(len(names), np.int64)
    place[order] = np.arange(len(names))
    ids = basket[np.argsort(place[item], kind="stable")].astype("<i4")
    row = {"baskets": len(lists), "items": [names[k] for k in order], "sizes": [int(size[k]) for k in order], "ids": ids.tobytes()}
    kinds = [("baskets", pa.int64()), ("items", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64())), ("ids", pa.binary())]
    return pa.Table.from_pylist([row], schema=pa.schema(kinds))


def vertical_blocks(baskets: DataFrame) -> DataFrame:
    """Blocks of (block, items) rows, a row for each basket; written once."""
    return materialize(baskets.groupBy("block").applyInArrow(_vertical, _BLOCK), "basket-blocks")


def mined(ids: np.ndarray, sizes: np.ndarray, baskets: int, least: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Sets of items that ``least`` baskets have, as items' numbers, and their counts.
    ``ids`` are the baskets of each item, side by side."""
    mark = np.zeros(baskets, bool)

    def grow(prefix: tuple[int, ...], items: np.ndarray, ids: np.ndarray, sizes: np.ndarray):
        cuts = np.append(0, np.cumsum(sizes))
        of = np.repeat(np.arange(len(items)), sizes)
        for k, item in enumerate(items.tolist()):
            own, rest, place = ids[cuts[k] : cuts[k + 1]], ids[cuts[k + 1] :], of[cuts[k + 1] :]
            yield (*prefix, item), len(own)
            mark[own] = True
            hit = mark[rest]
            mark[own] = False
            size = np.bincount(place[hit], minlength=len(items))
            good = size >= least
            if good.any():
                yield from grow((*prefix, item), items[good], rest[hit & good[place]], size[good])

    good = sizes >= least
    return grow((), np.flatnonzero(good), ids[np.repeat(good, sizes)], sizes[good])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str], np.ndarray, np.ndarray]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            yield row["baskets"], row["items"], np.array(row["sizes"], np.int64), np.frombuffer(row["ids"], "<i4")


def _mine(baskets_of_all: int, least_of_all: int):
    """Frequent sets of each block: items in order, n, and ``more``: what a block that
    doesn't report a set may have of it at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for baskets, items, sizes, ids in _blocks(batches):
            least = max(1, -(-least_of_all * baskets // baskets_of_all))
            sets: list[list[str]] = []
            counts: list[int] = []

            def out(sets=sets, counts=counts, more=least - 1) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(sets, pa.list_(pa.string())), pa.array(counts, pa.int64()), pa.array([more] * len(sets), pa.int64())], names=["items", "n", "more"]
                )

            for found, n in mined(ids, sizes, baskets, least):
                sets.append(sorted(items[k] for k in found))
                counts.append(n)
                if len(sets) == _ROWS:
                    yield out()
                    sets.clear()
                    counts.clear()
            yield out()

    return run


def _recount(candidates: list[list[str]]):
    """Counts of the candidates, by their numbers, in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(candidates), np.int64)
        for _, items, sizes, ids in _blocks(batches):
            cuts = np.append(0, np.cumsum(sizes)).tolist()
            place = {x: k for k, x in enumerate(items)}
            for c, wanted in enumerate(candidates):
                # The rarest first, as items are numbered.
                at = sorted(place.get(x, -1) for x in wanted)
                if at[0] < 0:
                    continue
                own = ids[cuts[at[0]] : cuts[at[0] + 1]]
                for k in at[1:]:
                    own = np.intersect1d(own, ids[cuts[k] : cuts[k + 1]], assume_unique=True)
                total[c] += len(own)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(candidates))), pa.array(total)], names=["number", "n"])

    return run


def frequent_sets(blocks: DataFrame, baskets: int, least: int) -> DataFrame:
    """(items, freq): the sets of items, each in order, that ``least`` or more of all
    ``baskets`` have, from their vertical blocks."""
    found = blocks.mapInArrow(_mine(baskets, least), "items array<string>, n long, more long").groupBy("items")
    found = materialize(found.agg(F.sum("n").alias("n"), F.sum("more").alias("more"), F.count("*").alias("blocks")), "block-sets")
    most = F.expr(f"greatest(1, ({least} * baskets + {max(1, baskets)} - 1) div {max(1, baskets)}) - 1")
    row = blocks.agg(F.count("*").alias("n"), F.sum(most).alias("more")).first()
    # Blocks that report a set are all, or the others may have ``more`` of it.
    whole = found.where((F.col("blocks") == row["n"]) & (F.col("n") >= least)).select("items", F.col("n").alias("freq"))
    open_sets = found.where((F.col("blocks") < row["n"]) & (F.col("n") + (row["more"] or 0) - F.col("more") >= least)).select("items")
    size = open_sets.count()
    rounds = -(-size // CANDIDATES)
    for k in range(rounds):
        own = sorted(r["items"] for r in open_sets.where(F.pmod(F.xxhash64("items"), F.lit(rounds)) == k).collect())
        counts = blocks.mapInArrow(_recount(own), "number long, n long").groupBy("number").agg(F.sum("n").alias("freq")).where(F.col("freq") >= least)
        names = blocks.sparkSession.createDataFrame(list(enumerate(own)), "number long, items array<string>")
        whole = whole.unionByName(counts.join(names, "number").select("items", "freq"))
    return whole
