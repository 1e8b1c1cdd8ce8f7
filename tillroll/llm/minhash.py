"""Near-duplicate groups by MinHash, banding, verification and components.

1. One pass over the texts makes a sketch of each document: the size of its set
   of word shingles, two sums that stand for the whole set, and the minima of
   ``BANDS * ROWS`` universal hash functions, folded into one key for each band.
2. Documents with one set are one class, named by its least doc_id.
3. Classes that share a band's key, a bucket, hang together in a loose group (a star
   around the least class of each bucket; alternating large-star and small-star
   find the groups). Each true link lies within a bucket.
4. Links are confirmed on full sets, which are made anew from the texts of the
   classes in groups of two and more. A group is dealt out to cells of at most
   ``TILE`` classes. A cell counts all intersections at once and gives only the
   links that join parts not joined yet. In a group of more than one cell, the
   hubs of the parts are linked next. What is left is looked for in buckets that
   have classes of two parts or more, buckets of the same classes once: texts that are
   alike but not enough share few buckets, so that they are handed to cells
   in proportion to their number and not to its square. In a bucket of more than a
   cell, only classes outside its largest part are held against the others, tile
   by tile, so that copies cost their stragglers times their number.
5. Large-star and small-star over the confirmed links give the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import _ODD, BYTE_VALUES, gap_table, hashed_words, mix64, text_rows
from tillroll.llm.components import connected_components
from tillroll.session import materialize

SHINGLE = 3
PERCENT = 85
ROWS = 10
BANDS = 64
#: Classes in a cell at most.
TILE = 384
#: Shingles of a cell whose columns are counted at a time.
COLUMNS = 4096
STEP = 1 << 20

_BYTE = BYTE_VALUES.copy()
#: Upper case as lower case, so that they hash alike.
_BYTE[65:91] = _BYTE[97:123]
_GAP = gap_table(b" \t\n\x0b\x0c\r")
#: Universal hash functions over the upper halves of the shingles' hashes.
_HASHES = np.random.default_rng(11).integers(0, 2**32, size=(2, 2048), dtype=np.uint64).astype(np.uint32)
#: Times that tiles may hand out the classes of a group; beyond, its buckets do.
HANDED = 4
#: Groups of more than a cell that are sent to every task.
FEW = 100_000


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts, in order, and the words of each text."""
    *_, h, words = hashed_words(texts, _GAP, _BYTE)
    return h, words


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """The hashes of the distinct ``size``-word shingles of each text, in order;
    with fewer words, the hash of the whole sequence; without words, none."""
    h, words = word_hashes(texts)
    out, at = [], 0
    with np.errstate(over="ignore"):
        n = max(0, len(h) - size + 1)
        s = np.zeros(n, np.uint64)
        for k in range(size):
            s += h[k : k + n] * _ODD[20 + k]
        s = mix64(s)
        for w in words:
            if w >= size:
                x = np.sort(s[at : at + w - size + 1])
                out.append(x[np.append(True, x[1:] != x[:-1])])
            elif w:
                whole = np.array([w], np.uint64) * _ODD[61]
                for k in range(w):
                    whole += h[at + k] * _ODD[40 + k]
                out.append(mix64(whole))
            else:
                out.append(np.zeros(0, np.uint64))
            at += w
    return out


def minima(sets: list[np.ndarray], functions: int) -> np.ndarray:
    """The least value of each universal hash function over each set (none of
    which is empty), as rows of functions."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    offsets = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((functions, len(sets)), np.uint32)
    x = np.empty_like(flat)
    for j in range(functions):
        np.multiply(flat, _HASHES[0, j] | np.uint32(1), out=x)
        np.add(x, _HASHES[1, j], out=x)
        np.minimum.reduceat(x, offsets, out=out[j])
    return out


def band_keys(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band of each set."""
    keys = np.zeros((bands, low.shape[1]), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(rows):
            keys += mix64(low[k::rows].astype(np.uint64)) * _ODD[30 + k]
        # Each band has keys of its own.
        keys += np.arange(1, bands + 1, dtype=np.uint64)[:, None] * _ODD[29]
    return mix64(keys).T


def _sketches(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_rows(batches, STEP):
            sets = shingle_sets(texts, size)
            n = np.array([len(s) for s in sets])
            full = np.flatnonzero(n)
            sums = np.zeros((2, len(sets)), np.int64)
            keys: list = [None] * len(sets)
            if len(full):
                some = [sets[i] for i in full]
                at = np.cumsum([0, *map(len, some[:-1])])
                flat = np.concatenate(some)
                sums[0, full] = np.add.reduceat(flat, at).view(np.int64)
                sums[1, full] = np.add.reduceat(mix64(flat ^ _ODD[62]), at).view(np.int64)
                for i, k in zip(full, band_keys(minima(some, bands * rows), bands, rows).view(np.int64), strict=True):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(sums[0]), pa.array(sums[1]), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "s1", "s2", "bands"],
            )

    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of a cell."""
    n = len(sets)
    if n == 2:
        c = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), c], [c, len(sets[1])]], np.int64)
    flat, row = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.append(True, flat[1:] != flat[:-1])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, row = np.unique(column[shared], return_inverse=True)[1], row[shared]
    out = np.zeros((n, n), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, z = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[row[a:z], column[a:z] - lo] = 1
        out += part @ part.T
    out = out.astype(np.int64)
    out[np.arange(n), np.arange(n)] = [len(s) for s in sets]
    return out


def cell_parts(sets: list[np.ndarray], labels: list[int], percent: int) -> tuple[list[int], np.ndarray]:
    """For each member of a cell: the least label of the part that links and
    labels join it to; the number of links it has in the cell."""
    c = common_counts(sets)
    n = np.diag(c)
    link = 100 * c >= percent * (n[:, None] + n[None, :] - c)
    link &= (n > 0)[:, None] & (n > 0)[None, :]
    parent = {lab: lab for lab in labels}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in np.argwhere(np.triu(link, 1)).tolist():
        a, b = find(labels[i]), find(labels[j])
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in labels], link.sum(axis=1)


#: A label of a cell, the least label it is joined to, and the member with most
#: links of the part that has the label as its least.
_PARTS = "grp long, label long, root long, hub long, size long"


def _cell(size: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        ids, labels = table.column("rep").to_pylist(), table.column("label").to_pylist()
        roots, degree = cell_parts(shingle_sets([t or b"" for t in table.column("_text").to_pylist()], size), labels, percent)
        hub: dict[int, tuple] = {}
        joined = dict(zip(labels, roots, strict=True))
        count: dict[int, int] = {}
        for i, r in enumerate(roots):
            hub[r] = max(hub.get(r, (-1, 0)), (int(degree[i]), ids[i]))
            count[r] = count.get(r, 0) + 1
        g = table.column("grp")[0].as_py()
        rows = [(g, lab, r, hub[r][1], count[r]) for lab, r in joined.items()]
        return pa.table({k: pa.array([r[i] for r in rows], pa.int64()) for i, k in enumerate(("grp", "label", "root", "hub", "size"))})

    return run


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, tile: int = TILE
) -> DataFrame:
    """Component of each document under the links of texts whose sets of
    ``size``-word shingles have 100 * intersection >= ``percent`` * union.

    Words are what stands between ASCII white space, A-Z in lower case. A text
    of fewer words than ``size`` has its whole sequence as its one shingle. A null or empty text, or one of white space, is linked with nothing
    and is its own component. Repeated rows and rows that share a doc_id are one
    node. A row with a null doc_id goes to the component of the same text, or to none, and
    links nothing. Extra columns are ignored; an empty table gives no rows.

    A pair at the least similarity shares a band's key with probability
    1 - (1 - 0.85**10)**64 = 0.9999992; one at a half, with 0.06.

    Returns doc_id, n_shingles, component_id (least doc_id reachable), kept.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = materialize(
        texts.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
            _sketches(size, bands, rows), "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"
        ),
        "sketch",
    )
    key = ["n_shingles", "s1", "s2"]
    classes = materialize(sketch.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")
    keyed = classes.where("rep IS NOT NULL").select("rep", F.explode("bands").alias("h"))
    star = keyed.groupBy("h").agg(F.min("rep").alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n")
    near = connected_components(keyed.hint("merge").join(star, "h").where("rep <> lead"), "rep", "lead")
    near = near.select(F.col("node").alias("rep"), F.col("root").alias("grp"))
    near = near.union(near.select(F.col("grp").alias("rep"), "grp").distinct())
    wide = _few(near.groupBy("grp").agg(F.ceil(F.count("*") / tile).alias("tiles")).where("tiles > 1"))
    near = near.join(wide, "grp", "left").withColumn("label", F.col("rep"))
    # The texts are dealt out by id at every size, so that the plan is the same.
    members = texts.select(F.col("doc_id").alias("rep"), F.col("text").cast("binary").alias("_text")).hint("merge").join(near, "rep")
    members = materialize(members, "members")
    cell = _cell(size, percent)

    tiles = members.withColumn("tile", F.coalesce(F.pmod(F.xxhash64("rep"), F.col("tiles")), F.lit(0)))
    parts = materialize(tiles.groupBy("grp", "tile").applyInArrow(cell, _PARTS), "parts")
    joined = parts.select(F.col("label").alias("node"), "root")
    large = members.where("tiles IS NOT NULL")
    if not large.isEmpty():
        across = _across_tiles(large, parts.join(wide, "grp", "left_semi"), classes, cell, tile)
        joined = parts.join(wide, "grp", "left_anti").select(F.col("label").alias("node"), "root").union(across)
    return (
        sketch.drop("bands")
        .join(classes.drop("bands"), key, "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.coalesce("root", "rep")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    )


def _few(df: DataFrame) -> DataFrame:
    """A table of what is more than a cell, written once; sent to all tasks if it has few
    rows, so that joins with it don't gather the classes of a group."""
    df = materialize(df, "wide")
    return F.broadcast(df) if df.count() <= FEW else df


def _across_tiles(large: DataFrame, parts: DataFrame, classes: DataFrame, cell, tile: int) -> DataFrame:
    """(node, root) of the classes in groups of more than one tile, from the
    parts that each tile has by itself and the buckets of the classes."""
    hubs = parts.where("size > 1 AND label = root").select("grp", F.col("hub").alias("rep"), "label")
    split = _few(hubs.groupBy("grp").agg(F.ceil(F.count("*") / tile).alias("n")))
    hubs = hubs.join(split, "grp").select("rep", "label", F.pmod(F.xxhash64("rep"), F.col("n")).alias("tile"))
    linked = large.drop("label").join(hubs, "rep").groupBy("grp", "tile").applyInArrow(cell, _PARTS)
    links = materialize(parts.union(linked).select("label", "root").where("label <> root"), "links")

    known = connected_components(links, "label", "root")
    part = large.select("grp", "rep").distinct().join(known, F.col("rep") == F.col("node"), "left")
    part = materialize(part.select("grp", "rep", F.coalesce("root", "rep").alias("label")), "labels")
    cells = _cells(part, classes, tile)
    found = large.select("rep", "_text").join(cells, "rep").groupBy("grp", "c").applyInArrow(cell, _PARTS).where("label <> root")
    merged = connected_components(found, "label", "root").select(F.col("node").alias("label"), F.col("root").alias("top"))
    return part.join(merged, "label", "left").select(F.col("rep").alias("node"), F.coalesce("top", "label").alias("root"))


def _cells(part: DataFrame, classes: DataFrame, tile: int) -> DataFrame:
    """(grp, rep, label, c): cells in which all links are found that classes of a loose
    group may have to those of another label. A group goes by tiles of all of it where
    that hands out ``HANDED`` times its classes at most, as where few stragglers are left
    beside many copies, and otherwise by its buckets."""
    m, outs = F.col("m"), F.col("n") - F.col("m")
    by_tiles = m * F.ceil(outs / tile) + outs * (F.ceil(m / tile) + F.ceil(outs / tile))
    tiled = _few(_mains(part).select("grp", (by_tiles <= HANDED * F.col("n")).alias("tiled")))
    whole = _dealt(part.join(tiled.where("tiled"), "grp", "left_semi"), tile)
    rows = part.join(tiled.where("NOT tiled"), "grp", "left_semi").join(classes.select("rep", "bands"), "rep")
    own = materialize(_bucket_rows(rows.select("rep", "label", F.explode("bands").alias("grp"))), "bucket-rows")
    one = F.struct(F.lit("all").alias("kind"), F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))
    small = own.where(F.col("n") <= tile).select("grp", "rep", "label", one.alias("c"))
    return whole.unionByName(small).unionByName(_dealt(own.where(F.col("n") > tile).drop("n"), tile))


def _bucket_rows(keyed: DataFrame) -> DataFrame:
    """(grp, rep, label, n): the buckets ``grp`` of n classes that have two labels or
    more; of buckets of the same classes, one."""
    mark = F.xxhash64("rep")
    buckets = keyed.groupBy("grp").agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x"), F.sum(mark.bitwiseAND(0xFFFFFFFF)).alias("s"), F.min("label").alias("least"), F.max("label").alias("most"))
    buckets = buckets.where("least <> most").groupBy("n", "x", "s").agg(F.min("grp").alias("grp")).select("grp", "n")
    return keyed.hint("merge").join(buckets, "grp").select("grp", "rep", "label", "n")


def _mains(rows: DataFrame) -> DataFrame:
    """Of each group: the label of most classes (main), their number (m), and that of all (n)."""
    labels = rows.groupBy("grp", "label").count()
    return labels.groupBy("grp").agg(F.max(F.struct("count", "label"))["label"].alias("main"), F.max("count").alias("m"), F.sum("count").alias("n"))


def _dealt(rows: DataFrame, tile: int) -> DataFrame:
    """Groups of (grp, rep, label) rows in cells: tiles of the classes outside the largest
    part among themselves (oo) and with tiles of that part (om)."""
    main = _few(_mains(rows).select("grp", "main", F.ceil((F.col("n") - F.col("m")) / tile).alias("outs"), F.ceil(F.col("m") / tile).alias("mains")))
    wide = rows.join(main, "grp").withColumn("out", F.col("label") != F.col("main"))
    wide = wide.withColumn("own", F.pmod(F.xxhash64("rep"), F.when(F.col("out"), F.col("outs")).otherwise(F.col("mains"))))
    # A group without stragglers has nothing left to look for.
    other = "transform(sequence(0L, {0} - 1), x -> struct({1} AS kind, {2} AS i, {3} AS j))"
    among = other.format("outs", "'oo'", "least(x, own)", "greatest(x, own)")
    across = other.format("mains", "'om'", "own", "x")
    back = f"if(outs > 0, {other.format('outs', chr(39) + 'om' + chr(39), 'x', 'own')}, array())"
    return wide.select("grp", "rep", "label", F.explode(F.expr(f"if(out, concat({among}, {across}), {back})")).alias("c"))
