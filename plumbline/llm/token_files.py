"""Operator 4: token-id files with Elias-Fano encoded document boundaries.

Documents are range partitioned by id, tokenized and written by the task that holds them: one file
for each range, in ascending order over all files. A file is the concatenated id array followed by
two Elias-Fano sequences, the token offset of every document (boundaries) and the document ids, and
a footer. Both sequences take about two bits and the logarithm of the mean gap for each document;
``select`` finds any offset from sampled bit counts, so there is no table of 64-bit offsets.

Only manifest rows (one a file) come back from the writing job; readers start from them, so reading
is as parallel as the files.
"""

from __future__ import annotations

import json
import math
import os
import re
import struct
import sys
import types
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import prefix_sums, shared_folder, shipped, written
from plumbline.llm.shared_files import AtomicFile, open_random

MAGIC = b"TOKEFv1\n"
END_ID = 2
#: Bits of the upper part between two sampled counts.
BLOCK_BITS = 512
#: Words whose ids a task remembers, and tokens read at once.
CACHE_WORDS = 600_000
READ_TOKENS = 1 << 20
_SEQUENCE = "<QQBQ"
_FOOTER = "<QQQqBQQ8s"


# ---------------------------------------------------------------- Elias-Fano


def ef_encode(values: np.ndarray, universe: int) -> bytes:
    """A non-decreasing sequence of integers in 0..universe: low bits packed, high bits in unary, counts sampled."""
    n = len(values)
    values = values.astype(np.uint64)
    low_bits = max(0, int(math.log2(universe / n))) if n and universe > n else 0
    lows = np.zeros(0, dtype=np.uint8)
    if n and low_bits:
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
    size = n + (universe >> low_bits) + 1
    upper = np.zeros(-(-size // BLOCK_BITS) * BLOCK_BITS, dtype=np.uint8)
    if n:
        upper[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
    counts = np.concatenate([[0], np.cumsum(upper.reshape(-1, BLOCK_BITS).sum(1, dtype=np.int64))[:-1]]).astype("<u4")
    packed = np.packbits(upper, bitorder="little")
    head = struct.pack(_SEQUENCE, n, len(packed), low_bits, len(lows))
    return head + lows.tobytes() + packed.tobytes() + counts.tobytes()


class EliasFano:
    """Reads ``ef_encode``: random access by ``select``, ranges by ``decode``."""

    def __init__(self, data: bytes):
        self._n, upper, self._low_bits, low = struct.unpack_from(_SEQUENCE, data)
        at = struct.calcsize(_SEQUENCE)
        self._lows = np.frombuffer(data, np.uint8, low, at)
        self._upper = np.frombuffer(data, np.uint8, upper, at + low)
        self._counts = np.frombuffer(data, "<u4", upper * 8 // BLOCK_BITS, at + low + upper)

    def __len__(self) -> int:
        return self._n

    def _low(self, start: int, stop: int) -> np.ndarray:
        width = self._low_bits
        if not width:
            return np.zeros(stop - start, dtype=np.uint64)
        first = start * width // 8
        bits = np.unpackbits(self._lows[first : -(-stop * width // 8)], bitorder="little")
        bits = bits[start * width - first * 8 :][: (stop - start) * width].reshape(-1, width)
        return (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The value at ``i``: the block by its sampled count, then the bit inside it."""
        if not 0 <= i < self._n:
            raise IndexError(i)
        return int(self.decode(i, i + 1)[0])

    def decode(self, start: int, stop: int) -> np.ndarray:
        """Values ``start`` to ``stop`` (exclusive); only the blocks that hold them are touched."""
        if stop <= start:
            return np.zeros(0, dtype=np.uint64)
        a = int(np.searchsorted(self._counts, start, "right")) - 1
        b = int(np.searchsorted(self._counts, stop - 1, "right")) - 1
        width = BLOCK_BITS // 8
        ones = np.flatnonzero(np.unpackbits(self._upper[a * width : (b + 1) * width], bitorder="little"))
        skip = start - int(self._counts[a])
        place = ones[skip : skip + stop - start] + a * BLOCK_BITS
        high = (place - np.arange(start, stop)).astype(np.uint64)
        return (high << np.uint64(self._low_bits)) | self._low(start, stop)


# ---------------------------------------------------------------- tokenizing


#: Fixed value: the split of tokenizers for which runs of letters are pieces of their own.
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
#: Latin letters, then punctuation other than apostrophes and brackets of special tokens.
_PLAIN_WORD = re.compile(r"([A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]*)([!-&(-/:;=?@\[-`{}~]*)")


class Encoder:
    """Texts to id arrays. ``by_words``: the tokenizer never joins across ASCII white space and drops it,
    so the ids of a text are those of its words one after another, and words are remembered.

    Most words are a run of Latin letters with some punctuation behind it. If the tokenizer's own
    description says that it splits there, such runs go to its merge model directly, in the form
    that its normalizer and byte mapping give each letter; all other words take the whole way.
    """

    def __init__(self, path: str, by_words: bool):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._by_words = by_words
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._words = Words(self.learn)
        self._runs: dict[str, bytes] = {}
        self._forms = self._letter_forms() if by_words else None

    def _letter_forms(self) -> dict[int, str] | None:
        """How each Latin letter reaches the merge model, or None where runs of letters are not pieces."""
        said = json.loads(self._tokenizer.to_str())
        normal, split = said.get("normalizer") or {}, said.get("pre_tokenizer") or {}
        steps = [x["type"] for x in normal.get("normalizers", [])]
        pieces = split.get("pretokenizers", [{}])
        first = pieces[0]
        known = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [x.get("type") for x in pieces] == ["Split", "ByteLevel"]
            and (first.get("pattern"), first.get("behavior"), first.get("invert")) == ({"Regex": LETTER_RUNS}, "Removed", True)
            and not pieces[1].get("add_prefix_space")
            and not pieces[1].get("use_regex")
            and not said.get("post_processor")
            and said["model"]["type"] == "BPE"
        )
        if not known:
            return None
        whole = {c: self._tokenizer.normalizer.normalize_str(c) for c in _LETTERS}
        return {ord(c): "".join(p for p, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(n)) for c, n in whole.items()}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._packed(e.ids) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _packed(self, ids: list[int]) -> bytes:
        return array(self._code, ids).tobytes()

    def _run(self, letters: str) -> bytes:
        form = letters.translate(self._forms)
        ids = self._runs.get(form)
        if ids is None:
            if len(self._runs) >= CACHE_WORDS:
                self._runs.clear()
            ids = self._runs[form] = self._packed([t.id for t in self._tokenizer.model.tokenize(form)])
        return ids

    def learn(self, token: bytes) -> bytes:
        """The ids of a word that is not remembered."""
        word = token.decode()
        plain = _PLAIN_WORD.fullmatch(word) if self._forms else None
        if plain is None:
            return self._whole([word])[0]
        letters, marks = plain.groups()
        if not letters:
            return self._whole([marks])[0]
        return self._run(letters) + (self._words[marks.encode()] if marks else b"")

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        if not self._by_words:
            yield from self._whole([t.decode() for t in texts])
            return
        for text in texts:
            if len(self._words) > CACHE_WORDS:
                self._words.clear()
            yield b"".join(map(self._words.__getitem__, text.split()))


class Words(dict):
    """Ids by word; a word not yet there is learnt."""

    def __init__(self, learn: Callable[[bytes], bytes]):
        super().__init__()
        self._learn = learn

    def __missing__(self, token: bytes) -> bytes:
        ids = self[token] = self._learn(token)
        return ids


def encoder(path: str, by_words: bool) -> Encoder:
    """The encoder of this worker process: later tasks find the words that earlier ones learnt."""
    # This module is shipped by value with each job, so the place to keep it is one that outlives jobs.
    place = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders"))
    kept = place.__dict__.setdefault("kept", {})
    if (path, by_words) not in kept:
        kept[path, by_words] = Encoder(path, by_words)
    return kept[path, by_words]


# ---------------------------------------------------------------- writing


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, by_words: bool = True) -> DataFrame:
    """Write ``docs`` (doc_id, text) below ``folder`` and return the manifest: part, file, docs, tokens, first.

    NULL texts have no token but the end id. Rows with a NULL doc_id come first; rows with one doc_id
    are ordered by the text. An empty table writes no file. Other columns are ignored. ``first`` is
    the number of ids in all earlier files.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part = TaskContext.get().partitionId()
        encode, out = None, None
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        nulls = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                encode, out = encoder(tokenizer, by_words), AtomicFile(folder, f"part-{part:06d}.tokens")
                end = np.array([end_id], dtype=encode.dtype).tobytes()
            width = encode.dtype.itemsize
            sizes = []
            for encoded in encode(batch.column(1).cast(pa.binary()).to_pylist()):
                out.write(encoded + end)
                sizes.append(len(encoded) // width + 1)
            lengths.append(np.array(sizes, dtype=np.int64))
            given = batch.column(0)
            nulls += given.null_count
            ids.append(given.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
        if out is None:
            return
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        known = np.concatenate(ids)
        base = int(known[0]) if len(known) else 0
        shifted = known.view(np.uint64) - np.uint64(base % (1 << 64))
        n, total = len(offsets) - 1, int(offsets[-1])
        boundaries = ef_encode(offsets, total)
        names = ef_encode(shifted, int(shifted[-1]) if len(known) else 0)
        out.write(boundaries + names)
        out.write(struct.pack(_FOOTER, n, nulls, total, base, encode.dtype.itemsize, len(boundaries), len(names), MAGIC))
        out.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": [out.uri], "docs": [n], "tokens": [total]})

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    ranged = given.repartitionByRange(order[0]).sortWithinPartitions(*order)
    manifest = written(ranged.mapInArrow(rows, "part int, file string, docs bigint, tokens bigint"), "manifest")
    return written(prefix_sums(manifest, "tokens", [F.col("part")], [], "first"), "manifest")


# ---------------------------------------------------------------- reading


class TokenFile:
    """Random access to one file: ``bounds(i)``, ``doc_ids``, ``tokens(start, stop)``."""

    def __init__(self, uri: str):
        self._in = open_random(uri)
        size = self._in.size()
        footer = struct.calcsize(_FOOTER)
        parts = struct.unpack(_FOOTER, self._in.read_at(footer, size - footer))
        self.docs, self.nulls, self.n_tokens, self._base, self._width, bounds, names, magic = parts
        if magic != MAGIC or size != self.n_tokens * self._width + bounds + names + footer:
            raise ValueError(f"{uri} is not a complete token file")
        at = size - footer - names - bounds
        self.boundaries = EliasFano(self._in.read_at(bounds, at))
        self._ids = EliasFano(self._in.read_at(names, at + bounds))

    def bounds(self, i: int) -> tuple[int, int]:
        """First token of document ``i`` of this file and that after its last."""
        start, stop = self.boundaries.decode(i, i + 2)
        return int(start), int(stop)

    def doc_ids(self, start: int, stop: int) -> list[int | None]:
        known = self._ids.decode(max(0, start - self.nulls), max(0, stop - self.nulls))
        missing = max(0, min(stop, self.nulls) - start)
        return [None] * missing + (known + np.uint64(self._base % (1 << 64))).view(np.int64).tolist()

    def tokens(self, start: int, stop: int) -> np.ndarray:
        data = self._in.read_at((stop - start) * self._width, start * self._width)
        return np.frombuffer(data, f"<u{self._width}")

    def spans(self) -> Iterator[tuple[int, int]]:
        """Runs of documents whose tokens are read together: about ``READ_TOKENS``, one document at least."""
        i = 0
        while i < self.docs:
            low = self.boundaries.select(i)
            stop = min(self.docs, i + 65_536)
            ends = self.boundaries.decode(i + 1, stop + 1)
            stop = i + max(1, int(np.searchsorted(ends, low + READ_TOKENS, "right")))
            yield i, stop
            i = stop

    def close(self) -> None:
        self._in.close()


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) for every document of the files of ``manifest``.

    ``start`` counts the ids of all documents before it over all files; the checksum is that of the
    ids as little-endian unsigned 32-bit integers.
    """
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(uri)
                for a, b in file.spans():
                    edges = file.boundaries.decode(a, b + 1).astype(np.int64)
                    ids = file.tokens(int(edges[0]), int(edges[-1]))
                    local = (edges - edges[0]).tolist()
                    sums = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(local, local[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.doc_ids(a, b), pa.int64()), pa.array(edges[:-1] + first), pa.array(np.diff(edges)), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                file.close()

    files = manifest.select("file", "first")
    return files.repartition(max(1, files.count())).mapInArrow(rows, schema)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = END_ID, by_words: bool = True) -> DataFrame:
    """Write the token files of ``docs`` to a new shared folder and read them back."""
    folder = shared_folder(docs.sparkSession, "tokens")
    return read(write(docs, folder, tokenizer, end_id, by_words))


shipped(__name__)
