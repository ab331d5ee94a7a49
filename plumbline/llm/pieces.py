"""Operator 13: SentencePiece encoding through a table of distinct chunks, and decoding.

Where no piece of a model holds a whitespace marker behind another character, no merge reaches over the
place where a run of markers begins. A text is then the chain of its chunks, each a run of markers and
what follows up to the next one, and its ids are those of its chunks one after another. A worker keeps a
table of distinct chunks: those of a batch that it lacks are segmented together by the library, each
once, and the ids are joined back by position. Texts are cut where Spark holds them, so nothing is
shuffled; a table shared by all tasks would send every occurrence of a rare chunk to it and back.

Models for which this does not hold (see ``Segmenter``) are given whole texts.
"""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import shipped

#: Distinct chunks in a worker's table. A full table is put aside, and what is met again is taken over from it.
TABLE_CHUNKS = 300_000
#: Bytes of text that are cut and joined at once, one text at least.
SLICE_BYTES = 4 << 20
MARKER = "▁"
_CHUNK = re.compile(rb" +[^ ]*")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def separable(model) -> bool:
    """Whether chunks of a text are segmented alike alone and inside it, by the model's own description.

    Merges by rank, texts taken as they are with a marker in front, no piece with a marker behind another
    character, and no pieces that are matched before the merges or taken apart after them.
    """
    said, normal = model.trainer_spec, model.normalizer_spec
    taken_as_is = not normal.precompiled_charsmap and normal.add_dummy_prefix and normal.escape_whitespaces
    kinds = {p.type for p in model.pieces} <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
    inside = any(MARKER in p.piece.lstrip(MARKER) for p in model.pieces if p.type == _NORMAL)
    alone = any(p.piece == MARKER and p.type == _NORMAL for p in model.pieces)
    return bool(
        said.model_type == said.BPE
        and taken_as_is
        and not normal.remove_extra_whitespaces
        and not said.treat_whitespace_as_suffix
        and kinds
        and alone
        and not inside
    )


class Segmenter:
    """Texts (UTF-8) to arrays of ids, as the library gives them without begin or end ids."""

    def __init__(self, path: str, most: int = TABLE_CHUNKS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        described = sentencepiece_model_pb2.ModelProto()
        described.ParseFromString(self.library.serialized_model_proto())
        self.separable = separable(described)
        self._most = most
        self._single = np.array([self.library.piece_to_id(MARKER)], "<i4").tobytes()
        self.table: dict[bytes, bytes] = {b" ": self._single}
        self._aside: dict[bytes, bytes] = {}
        self.segmented = 0

    def _learn(self, chunks: set[bytes]) -> None:
        """Segments those of ``chunks`` that are not known, each once; the library itself puts a marker in front."""
        new = chunks - self.table.keys()
        if new and len(self.table) + len(new) > self._most:
            self._aside, self.table = self.table, {b" ": self._single}
            new = chunks - self.table.keys()
        met = new & self._aside.keys()
        self.table.update((c, self._aside[c]) for c in met)
        unknown = list(new - met)
        if unknown:
            self.segmented += len(unknown)
            for chunk, ids in zip(unknown, self.library.encode([c[1:] for c in unknown], num_threads=1), strict=True):
                self.table[chunk] = array("i", ids).tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        if not self.separable:
            return [np.array(ids, "<i4").tobytes() for ids in self.library.encode(texts, num_threads=1)] if texts else []
        # The marker's own character and the blank are one thing to the model.
        blank = MARKER.encode()
        cut = [_CHUNK.findall(b" " + t.replace(blank, b" ")) if t else [] for t in texts]
        self._learn(set().union(*cut))
        return [b"".join(map(self.table.__getitem__, chunks)) for chunks in cut]


def segmenter(path: str) -> Segmenter:
    """The segmenter of this worker process: later tasks find the chunks of earlier ones."""
    # This module is shipped by value with each job, so the place to keep it is one that outlives jobs.
    place = sys.modules.setdefault("_piece_segmenters", types.ModuleType("_piece_segmenters"))
    kept = place.__dict__.setdefault("kept", {})
    if path not in kept:
        kept[path] = Segmenter(path)
    return kept[path]


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``SLICE_BYTES`` together, one row at least."""
    start = total = 0
    for k, size in enumerate(sizes):
        if k > start and total + size > SLICE_BYTES:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids): the piece ids of every whole text, one row for each row of ``docs``.

    NULL and empty texts have no ids; a text of blanks alone has the ids of its markers. Repeated rows
    and rows with a NULL doc_id keep a row each; an empty table gives no rows; other columns are ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            sizes = texts.to_pandas().str.len().tolist()
            for a, b in _slices(sizes):
                packed = segmenter(model).encode(texts.slice(a, b - a).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], ["doc_id", "ids"])

    given = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = given.select("doc_id", F.array().cast("array<int>").alias("ids")).schema
    return given.mapInArrow(rows, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text): the library's decoding of the ids in every row. NULL or no ids: an empty text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            for a, b in _slices([len(v) * 4 if v else 0 for v in lists]):
                part = batch.slice(a, b - a)
                texts = segmenter(model).library.decode([v or [] for v in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    given = encoded.select("doc_id", "ids")
    return given.mapInArrow(rows, given.select("doc_id", "ids", F.lit("").alias("text")).schema)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text): every text's ids and what they decode to, from the same pass over the texts."""
    return decode(encode(docs, model), model)


def digest(docs: DataFrame, model: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_tokens and the digests of the ids and of the decoded text."""
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return round_trip(docs, model).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


shipped(__name__)
