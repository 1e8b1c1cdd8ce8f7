"""SentencePiece encoding and decoding with the tokenizers library.

The model's protobuf is read field by field: pieces with score and kind, the
kind of model, normaliser options. From these the same segmentation is rebuilt
for the tokenizers library: a BPE model gets its merges from the scores (each
split of a piece in two pieces, in order of the piece's score), a unigram model
its scores; both fall back to bytes. White space becomes the metaspace marker.

Because no piece has the marker after another character, tokens never reach
across a space that follows another character, and a text is encoded unit by
unit (a run of spaces with what follows). Each unit that a worker meets is
held against the sentencepiece library; where the two differ, the reference ids
stand, and the units of each text on which they do are counted. Of a model that
normalises texts, whole texts are encoded and compared.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import BYTE_VALUES, gap_table, numbered, text_rows
from tillroll.llm.units import UnitEncoder, encode_joined, threads

MARK = "▁"
#: Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

#: Units that a worker keeps beside the two libraries' models.
KEEP = 250_000
#: Units that both libraries encode at a time: what they return is far larger than the ids.
_UNITS = 4096

_UNIT = re.compile(" +[^ ]*")
_GAP = gap_table(b" ")


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    charsmap: bytes = b""
    dummy_prefix: bool = True
    collapse_spaces: bool = True
    escape_spaces: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


def read_model(data: bytes) -> Model:
    """The parts of a model's protobuf that encoding needs."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    text = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((text, score, kind))
        elif number == 2:
            model.kind = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix, model.collapse_spaces, model.escape_spaces = (bool(spec.get(n, 1)) for n in (3, 4, 5))
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that join to a piece, the best score first."""
    index = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
    pairs = []
    for p, i in index.items():
        for k in range(1, len(p)):
            left, right = index.get(p[:k]), index.get(p[k:])
            if left is not None and right is not None:
                pairs.append((-model.pieces[i][1], left, right, p[:k], p[k:]))
    return [(a, b) for *_, a, b in sorted(pairs)]


def normalises(model: Model) -> bool:
    """Whether what a unit becomes depends on the text around it."""
    marked = any(MARK in p.lstrip(MARK) for p, *_ in model.pieces)
    return bool(marked or model.collapse_spaces or model.charsmap or not (model.dummy_prefix and model.escape_spaces))


def build(model: Model):
    """The model as a tokenizer of the tokenizers library."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), 0)
    if model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab, merges(model), unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=True)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=unknown, byte_fallback=any(k == BYTE for *_, k in model.pieces))
    else:
        raise ValueError(f"model kind {model.kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if normalises(model):
        # Whole texts come without the space that stands before a unit.
        if model.collapse_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if model.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


class Codec:
    """Encoder and decoder of one model in one worker."""

    def __init__(self, path: str, parallel: int = 2):
        import sentencepiece

        threads(parallel)
        with open(path, "rb") as f:
            self.model = read_model(f.read())
        self.tokenizer = build(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        #: Units that were compared, and those on which the libraries differ.
        self.compared = self.differ = 0
        #: The units themselves; few, as the pieces' scores decide in both.
        self.unlike: set[str] = set()
        self.whole = normalises(self.model)
        self.units = UnitEncoder(lambda new: self._encode([" " + u.decode() for u in new]), KEEP)
        pieces = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(MARK, " ").encode() for p, _, kind in self.model.pieces]
        self.pieces = np.array(pieces, object)

    def _encode(self, new: list[str]) -> list[bytes]:
        return [x for k in range(0, len(new), _UNITS) for x in self._encode_some(new[k : k + _UNITS])]

    def _encode_some(self, new: list[str]) -> list[bytes]:
        runs = [k for k, u in enumerate(new) if not u.strip(" ")]  # these would join the next unit
        rest = [k for k, u in enumerate(new) if u.strip(" ")]
        ours: list[bytes] = [b""] * len(new)
        for k, x in zip(runs, self.tokenizer.encode_batch([new[k] for k in runs], add_special_tokens=False), strict=True):
            ours[k] = np.array(x.ids, "<u4").tobytes()
        for k, x in zip(rest, encode_joined(self.tokenizer, [new[k] for k in rest], ""), strict=True):
            ours[k] = x
        # The library puts the dummy prefix, a space, before what it is given.
        theirs = [np.array(x, "<u4").tobytes() for x in self.reference.encode([u[1:] for u in new], num_threads=1)]
        self.compared += len(new)
        for k, (a, b) in enumerate(zip(ours, theirs, strict=True)):
            if a != b and len(new[k]) > 1:
                self.differ += 1
                self.unlike.add(new[k])
                ours[k] = b
        return ours

    def differing(self, text: bytes) -> int:
        """Units of a text that was encoded on which the libraries differ."""
        t = " " + text.decode()
        if self.whole:
            return int(t in self.unlike)
        if not any(u in t for u in self.unlike):
            return 0
        return sum(u in self.unlike for u in _UNIT.findall(t))

    def _encode_whole(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        plain = [t.decode() for t in texts]
        ours = [x.ids for x in self.tokenizer.encode_batch(plain, add_special_tokens=False)]
        theirs = self.reference.encode(plain, num_threads=1)
        self.compared += len(texts)
        for t, a, b in zip(plain, ours, theirs, strict=True):
            if a != b:
                self.differ += 1
                self.unlike.add(" " + t)
        return np.array([i for x in theirs for i in x], np.uint32), np.array([len(x) for x in theirs])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the UTF-8 texts side by side, and the number of each text's."""
        if self.whole:
            return self._encode_whole(texts)
        plain = [not (t[:1] == b" " or t[-1:] == b" " or b"  " in t) for t in texts]
        ids, n = self.units.batch([t for t, p in zip(texts, plain, strict=True) if p], _GAP, BYTE_VALUES)
        if all(plain):
            return ids, n
        # Runs of spaces are part of the unit that they begin.
        parts = iter(np.split(ids, np.cumsum(n)[:-1]))
        out = []
        for t, p in zip(texts, plain, strict=True):
            if p:
                out.append(next(parts))
            else:
                found = _UNIT.findall(" " + t.decode())
                known = dict(zip(distinct := list(set(found)), self._encode(list(distinct)), strict=True))
                out.append(np.frombuffer(b"".join(known[u] for u in found), "<u4"))
        return np.concatenate(out), np.array([len(x) for x in out])

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """UTF-8 texts of ids side by side; the dummy prefix goes, and bytes
        that aren't UTF-8 become replacement characters."""
        out, cuts = [], np.cumsum(np.append(0, n)).tolist()
        pieces = self.pieces[ids].tolist()
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            data = b"".join(pieces[a:z]).removeprefix(b" ")
            out.append(data.decode(errors="replace").encode())
        return out


_codecs: dict = {}


def codec(path: str, parallel: int = 2) -> Codec:
    """The codec of a model file, made once in each worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path, parallel)
    return _codecs[path]


def encode_pieces(docs: DataFrame, model_path: str, keep_ids: bool = True, parallel: int = 2) -> DataFrame:
    """Encode and decode each whole text with a SentencePiece model file, which
    lies at ``model_path`` on every executor.

    Returns doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), round_trip (the ids decode to the text), n_differ (units of the
    text, or whole texts of a model that normalises, on which the rebuilt tokenizer
    differs from the library, whose ids stand), and ``ids``, an array, if
    ``keep_ids``. Long texts are encoded whole. A null or empty text has no ids and round_trip is
    true. Repeated rows and rows with null ids are encoded like others; extra
    columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path, parallel)
        for ids, data in text_rows(batches):
            flat, n = c.encode(data)
            same = [a == b for a, b in zip(c.decode(flat, n), data, strict=True)]
            cuts = np.cumsum(np.append(0, n))
            raw = memoryview(flat.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            differ = [c.differing(t) if t and c.unlike else 0 for t in data]
            columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same), pa.array(differ, pa.int64())]
            names = ["doc_id", "n_tokens", "ids_crc32", "round_trip", "n_differ"]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, n_differ long" + (", ids array<int>" if keep_ids else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


#: Rows and text that are encoded at a time, about.
_ROWS, _BYTES = 512, 1 << 20


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of rows; one longer text stands alone."""
    size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    lo = upto = 0
    for k, n in enumerate(size.tolist()):
        if k > lo and (k - lo == _ROWS or upto + n > _BYTES):
            yield batch.slice(lo, k - lo)
            lo, upto = k, 0
        upto += n
    if batch.num_rows:
        yield batch.slice(lo)


def append_pieces(docs: DataFrame, model_path: str, parallel: int = 2) -> DataFrame:
    """All columns of the documents with n_tokens and ids, an array. Columns
    that had these names give way. A null or empty text has no ids."""
    docs = docs.drop("n_tokens", "ids")
    at = docs.columns.index("text")
    more = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*docs.schema.fields, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path, parallel)
        for whole in batches:
            for b in _slices(whole, at):
                flat, n = c.encode([t or b"" for t in b.column(at).cast(pa.binary()).to_pylist()])
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum(np.append(0, n)), pa.int32()), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64()), ids], names=schema.names)

    return numbered(docs).mapInArrow(run, schema)
