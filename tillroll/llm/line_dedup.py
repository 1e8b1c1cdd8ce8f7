"""Lines that recur across documents, by a template tree of fixed depth.

A line goes down a tree by its number of tokens and by its leading tokens, in
which fields with a digit count as variable; at the leaf, templates keep half of
the remaining fields (those at even or at odd places) and let the other half
vary, so that two lines of one leaf share a template if they agree in one of
the halves. A template recurs if it stands in ``min_contexts`` or more
different texts, compared as the templates of all their lines, or in as many
different surroundings (the lines before and after it, as templates). So a group
of copies, however large, counts once, and a block of lines counts in each text
that has it. Lines of fewer than ``MIN_TOKENS`` tokens recur by chance more
often; their one template is the whole line, and it has to stand in
``min_short`` texts. The first document that has a recurring template keeps its
lines; all later ones lose them.

The tree is never gathered: its paths are hashed, and templates are counted in
a grouping by path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import MAX_ID, free_name, numbered, own_columns, text_hash, text_rows
from tillroll.session import materialize

#: Lines of fewer tokens recur by chance; a stricter test holds for them.
MIN_TOKENS = 4
#: From here on, half of the fields may vary.
FREE_TOKENS = 10
#: Leading tokens that stand in the tree.
LEADING = 2
#: Different texts or surroundings in which a template stands.
MIN_CONTEXTS = 3
#: Different texts for short lines.
MIN_SHORT = 10

_DIGIT = re.compile(r"[0-9]")
_FIELD = re.compile(r"\S*[0-9]\S*")


def masked(line: str) -> list[str]:
    """Tokens of a line, fields with a digit as variable ones."""
    if _DIGIT.search(line):
        line = _FIELD.sub("<*>", line)
    return line.split()


def templates(tokens: list[str]) -> list[str]:
    """Paths of a line's templates."""
    n = len(tokens)
    if n < MIN_TOKENS:
        return []
    if n < FREE_TOKENS:
        return [f"{n} " + " ".join(tokens)]
    head = f"{n} " + " ".join(tokens[:LEADING])
    return [f"{head} even " + " ".join(tokens[LEADING::2]), f"{head} odd " + " ".join(tokens[LEADING + 1 :: 2])]


def short_template(tokens: list[str]) -> list[str]:
    """Path of a short line's template; none for one of variable fields alone."""
    n = len(tokens)
    return [f"{n} " + " ".join(tokens)] if n < MIN_TOKENS and any(x != "<*>" for x in tokens) else []


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_rows(batches):
        rows: list[list] = [[], [], [], [], [], [], []]
        for d, t in zip(ids, texts, strict=True):
            digest = text_hash(t)
            lines = [masked(x) for x in t.decode().split("\n")]
            marks = [" ".join(x) for x in lines]
            whole = _long(xxhash.xxh3_64_intdigest("\n".join(marks).encode()))
            for k, tokens in enumerate(lines):
                short = len(tokens) < MIN_TOKENS
                around = _long(xxhash.xxh3_64_intdigest("\n".join((marks[k - 1] if k else "\r", marks[k + 1] if k + 1 < len(marks) else "\r")).encode()))
                for path in short_template(tokens) if short else templates(tokens):
                    # The last bit tells short lines from others.
                    h = xxhash.xxh3_128_intdigest(path.encode()) & ~1 | short
                    for cell, v in zip(rows, (_long(h >> 64), _long(h & (1 << 64) - 1), whole, around, d, digest, k), strict=True):
                        cell.append(v)
        kinds = [pa.int64()] * 6 + [pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names=["hi", "lo", "whole", "around", "doc", "digest", "line"])


def _drop(text: int, names: list[str]):
    """For mapInArrow over the documents' columns, the text at place ``text``,
    and the lines to be cut: the columns ``names``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *out, gone = batch.columns
            lines, dropped, texts = [], [], []
            for t, g in zip(out[text].to_pylist(), gone.to_pylist(), strict=True):
                own, g = (t or "").split("\n"), set(g or ())
                lines.append(len(own) if t else 0)
                dropped.append(len(g))
                texts.append("\n".join(x for k, x in enumerate(own) if k not in g) if g else t)
            out[text] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*out, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=names)

    return run


def dedup_lines(docs: DataFrame, min_contexts: int = MIN_CONTEXTS, min_short: int = MIN_SHORT) -> DataFrame:
    """The documents, all columns, with recurring lines cut from ``text``, and two
    columns more: _lines and _dropped, the numbers of lines before and of those cut
    (where the table has a column of such a name, that of ``free_name``).

    Lines stand between \n, tokens between white space. A blank line and one of
    variable fields alone stay. A null or empty text has
    no lines and stays as it is; a text that loses all lines is empty. Rows of one
    doc_id count as one document, and a null doc_id as the last; the document of
    the least doc_id keeps a template's lines, repeated ones included. An empty
    table stays empty; a long text is read whole; further columns pass unread.
    """
    by_doc, by_digest, cut = (free_name(docs, n) for n in ("_doc", "_digest", "_gone"))
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_ID))
    text = F.col("text").cast("string").cast("binary")
    # Texts are parsed once: the written paths serve the counting and the cutting.
    paths = docs.select(own.alias("doc"), text.alias("text")).mapInArrow(_paths, "hi long, lo long, whole long, around long, doc long, digest long, line int")
    paths = materialize(paths, "line-paths")
    short = F.col("lo").bitwiseAND(1) == 1
    recurring = (
        paths.select("hi", "lo", "doc", F.inline(F.array(F.struct(F.lit(True).alias("text"), F.col("whole").alias("mark")), F.struct(F.lit(False).alias("text"), F.col("around").alias("mark")))))
        .groupBy("hi", "lo", "text", "mark").agg(F.min("doc").alias("first"))
        .groupBy("hi", "lo").agg(F.count_if("text").alias("texts"), F.count_if(~F.col("text")).alias("places"), F.min("first").alias("first"))
        .where(F.when(short, F.col("texts") >= min_short).otherwise(F.greatest("texts", "places") >= min_contexts)).select("hi", "lo", "first")
    )
    gone = paths.hint("merge").join(recurring, ["hi", "lo"]).where("doc > first").groupBy(F.col("doc").alias(by_doc), F.col("digest").alias(by_digest))
    gone = gone.agg(F.collect_set("line").alias(cut))
    keyed = docs.withColumn(by_doc, own).withColumn(by_digest, F.xxhash64(text))
    joined = keyed.hint("merge").join(gone, [by_doc, by_digest], "left").select(*own_columns(docs), cut)
    more = [T.StructField(free_name(docs, n), T.LongType()) for n in ("_lines", "_dropped")]
    out = T.StructType([*docs.schema.fields, *more])
    return numbered(joined).mapInArrow(_drop(docs.columns.index("text"), out.names), out)


def line_report(docs: DataFrame, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the remaining text)."""
    out = dedup_lines(docs.select("doc_id", "text"), min_contexts)
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
