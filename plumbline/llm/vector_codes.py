"""Operator 11: vector codes from codebooks of parts, compared exactly in integers.

Components become integers, vectors are cut into equal parts, and each part is coded by the nearest
entry of its position's codebook. Distances are compared behind an integer Walsh-Hadamard transform
of the parts and entries, filled up with zeros to a power of two: it multiplies every squared
distance by the transform's length and gathers most of it in the coefficients of few sign changes.
Scaled squared differences are added up in that order; an entry goes as soon as its sum exceeds the
full distance of the entry that led after the first coefficients. Nothing is rounded, so ties stay ties.

Spark holds the vectors: every round is a pass in which each task codes its rows and adds up its own
parts by entry, then one row for each task and entry is merged. Only codebooks, whose size depends on
parts, entries and vector length alone, travel through the driver and with the jobs.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import joined_small, shipped, small, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Share of the coefficients that is added up for all entries, in tiles, before entries are eliminated, and
#: coefficients between later eliminations, which gather what is left.
FIRST, STEP = (3, 4), 4
#: Vectors that are compared at once.
BLOCK = 1024
_LONG = (1 << 63) - 1


# ---------------------------------------------------------------- exact comparison


def sequency(n: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of ``n`` rows (a power of two), rows by their number of sign changes."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < n:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[np.argsort((np.diff(matrix, axis=1) != 0).sum(1), kind="stable")]


def length(width: int) -> int:
    """The least power of two that holds a part."""
    return 1 << max(0, width - 1).bit_length()


def transform(parts: np.ndarray) -> np.ndarray:
    """Rows behind the transform, zero-padded; exact, in integers of the given kind."""
    width = parts.shape[1]
    matrix = sequency(length(width))[:, :width].T
    return parts @ (matrix.astype(object) if parts.dtype == object else matrix)


def fits(width: int, largest: int) -> bool:
    """Whether all scaled sums of squares stay within 64 bits for components up to ``largest``."""
    return length(width) * width * 4 * largest * largest <= _LONG


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of transformed ``parts`` the nearest of the transformed ``entries`` and the squared distance.

    The lower index wins a tie. Arrays of 64-bit integers or of Python's unbounded ones (object).
    """
    n, scale = len(parts), parts.shape[1]
    first = max(1, scale * FIRST[0] // FIRST[1])
    kind = parts.dtype
    largest = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if first * (2 * largest) ** 2 < 1 << 31:
        kind = np.dtype(np.int32)  # the tiles' sums fit, in half the memory
    left_side, right_side = parts[:, :first].astype(kind), entries[:, :first].T.astype(kind)
    sums = np.zeros((n, len(entries)), kind)
    for c in range(first):
        gap = left_side[:, c, None] - right_side[c]
        gap *= gap
        sums += gap
    leader = sums.argmin(1)
    bound = ((parts - entries[leader]) ** 2).sum(1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry].astype(parts.dtype)
    for c in range(first, scale, STEP):
        sums = sums + ((parts[row, c : c + STEP] - entries[entry, c : c + STEP]) ** 2).sum(1)
        left = sums <= bound[row]
        row, entry, sums = row[left], entry[left], sums[left]
    # The leader is left in every row, so every row has a run of candidates, in order of the index.
    starts = np.searchsorted(row, np.arange(n))
    least = np.minimum.reduceat(sums, starts)
    hits = np.flatnonzero(sums == least[row])
    _, at = np.unique(row[hits], return_index=True)
    return entry[hits[at]], least // scale


def integers(vectors: pa.ListArray, dims: int) -> np.ndarray:
    """floor(1024 x) of all components, short vectors filled with zeros; unbounded integers where 64 bits may not do."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) and np.abs(flat).max() >= 1 << 36:
        values = np.array([int(x) * SCALE if abs(x) >= 1 << 53 else int(np.floor(x * SCALE)) for x in flat.tolist()], object)
    else:
        values = np.floor(flat * SCALE).astype(np.int64)
    sizes = np.diff(vectors.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), dims), values.dtype)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class Codebooks:
    """The entries of every part: ``books[p]`` has a row of integers for each entry."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books
        self.width = books[0].shape[1]
        self.largest = max(int(np.abs(b).max(initial=0)) for b in books)

    def code(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers (row, part) and squared distances summed over the parts."""
        largest = max(self.largest, int(np.abs(rows).max(initial=0)))
        kind = np.int64 if fits(self.width * len(self.books), largest) else object
        codes = np.zeros((len(rows), len(self.books)), np.int64)
        errors = np.zeros(len(rows), kind)
        for p, book in enumerate(self.books if self.width else []):
            entries = transform(book.astype(kind))
            for a in range(0, len(rows), BLOCK):
                part = rows[a : a + BLOCK, p * self.width : (p + 1) * self.width].astype(kind)
                codes[a : a + BLOCK, p], near = nearest(transform(part), entries)
                errors[a : a + BLOCK] += near
        return codes, errors

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for e in b.tolist() for x in e).encode()).hexdigest()


# ---------------------------------------------------------------- rounds over the table


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of rows with a vector whose components are all finite numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", "label", "embedding").filter(F.col("embedding").isNotNull() & finite)


def _first(rows: DataFrame, dims: int, parts: int, entries: int) -> Codebooks:
    """Codebooks of the vectors with the smallest ids; of equal ids the smaller vector comes first, NULL ids come last."""
    order = F.col("vec_id").asc_nulls_last()
    ids = [r[0] for r in rows.select("vec_id").orderBy(order).limit(entries).collect()]
    near = rows if ids[-1] is None else rows.filter(F.col("vec_id") <= F.lit(ids[-1]))
    chosen = near.orderBy(order, F.col("embedding")).limit(entries).select("embedding").collect()
    values = integers(pa.array([r[0] for r in chosen], pa.list_(pa.float64())), dims)
    return Codebooks(np.split(values, parts, axis=1))


def _sums(rows: DataFrame, books: Codebooks, dims: int) -> DataFrame:
    """(part, entry, n, sums): what each task adds up for the entries its rows are nearest to; sums as decimal text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(books.books), len(books.books[0])), np.int64)
        sums = np.zeros((*counts.shape, books.width), object)
        for batch in batches:
            values = integers(batch.column(0), dims)
            codes, _ = books.code(values)
            for p in range(len(counts)):
                part = values[:, p * books.width : (p + 1) * books.width]
                order = np.argsort(codes[:, p], kind="stable")
                used, starts, n = np.unique(codes[order, p], return_index=True, return_counts=True)
                if len(used) and books.width:
                    # A batch's own sums stay within 64 bits unless its values are unbounded integers already.
                    sums[p, used] += np.add.reduceat(part[order], starts, axis=0).astype(object)
                counts[p, used] += n
        part, entry = np.nonzero(counts)
        told = [[str(x) for x in s] for s in sums[part, entry].tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.array(told, pa.list_(pa.string()))],
            ["part", "entry", "n", "sums"],
        )

    return rows.select("embedding").mapInArrow(made, "part int, entry int, n bigint, sums array<string>")


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    """floor(sum / count) of one entry, from a row of each task."""
    total = int(rows["n"].sum())
    sums = [sum(map(int, column)) // total for column in zip(*rows["sums"], strict=True)]
    return pd.DataFrame({"part": rows["part"].iloc[:1], "entry": rows["entry"].iloc[:1], "mean": [[str(x) for x in sums]]})


def _improved(rows: DataFrame, books: Codebooks, dims: int) -> Codebooks:
    means = _sums(rows, books, dims).groupBy("part", "entry").applyInPandas(_mean, "part int, entry int, mean array<string>")
    following = [b.astype(object) for b in books.books]
    for r in means.collect():  # a row for each entry of each part
        following[r["part"]][r["entry"]] = [int(x) for x in r["mean"]]
    largest = max((abs(x) for b in following for x in b.flat), default=0)
    return Codebooks([b if largest > _LONG else b.astype(np.int64) for b in following])


def train(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[Codebooks, int] | None:
    """Codebooks after ``rounds`` assignments and means over all usable rows, and the components of a vector.

    None for a table without a usable row. Unused entries stay as they are.
    """
    rows = _usable(vectors)
    longest = rows.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    if longest is None:
        return None
    dims = -(-longest // parts) * parts
    books = _first(rows, dims, parts, entries)
    for _ in range(rounds):
        books = _improved(rows, books, dims)
    return books, dims


def encode(vectors: DataFrame, books: Codebooks, dims: int) -> DataFrame:
    """(vec_id, label, codes, error): entry numbers by part and the squared distance of every usable row.

    An error beyond 64 bits is NULL.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = books.code(integers(batch.column(2), dims))
            told = pa.array([e if e <= _LONG else None for e in errors.tolist()], pa.int64())
            lists = pa.array(codes.tolist(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, told], ["vec_id", "label", "codes", "error"])

    rows = _usable(vectors)
    codes = F.array().cast("array<int>").alias("codes")
    return rows.mapInArrow(made, rows.select("vec_id", "label", codes, F.lit(0).cast("bigint").alias("error")).schema)


def digest(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every usable row of ``vectors`` (vec_id, embedding, label).

    Rows whose vector is NULL or holds NULL or non-finite components go. Shorter vectors count as
    filled with zeros, and so does a length that the parts do not divide. Repeated rows and NULL ids
    keep a row each; NULL labels are one label. A sum of errors beyond 64 bits is NULL, as is that of a label
    with such an error. A table without usable rows gives no rows; other columns are ignored.
    """
    trained = train(vectors, parts, entries, rounds)
    books, dims = trained or (Codebooks([np.zeros((1, 0), np.int64)] * parts), 0)
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("-"))
    coded = written(encode(vectors, books, dims).withColumn("_label", label), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    sums = coded.groupBy("_label").agg(F.when(F.count("error") == F.count(F.lit(1)), total).alias("label_error"))
    code = F.lower(F.array_join(F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), ""))
    joined = joined_small(coded, sums, "_label", "inner", small(sums, "_label"))
    return joined.select("vec_id", code.alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The digest in SQL: every part against every entry, without the transform."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT rid, p, min({{'d': CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(s, c)]) AS BIGINT), 'e': e}}) AS best
  FROM parts JOIN c{k} USING (p) GROUP BY rid, p)""")
        if k < rounds:
            steps.append(f"""
s{k} AS (SELECT p, e, k, sum(x) AS t, count(*) AS n
  FROM (SELECT p, best.e AS e, unnest(s) AS x, generate_subscripts(s, 1) AS k FROM a{k} JOIN parts USING (rid, p)) GROUP BY p, e, k),
m{k} AS (SELECT p, e, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY k) AS m FROM s{k} GROUP BY p, e),
c{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM c{k} LEFT JOIN m{k} USING (p, e))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS s FROM kept CROSS JOIN range({parts}) AS t(p)),
c0 AS MATERIALIZED (SELECT p, rid - 1 AS e, s AS c FROM parts WHERE rid <= {entries}),{",".join(steps)},
r AS (SELECT rid, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid),
b AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN kept USING (rid) CROSS JOIN b"""


shipped(__name__)
