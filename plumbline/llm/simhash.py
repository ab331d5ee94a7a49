"""Operator 7: SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64-bit. Two documents are linked when their fingerprints differ in at most
``RADIUS`` bits; a group is what links connect.

Equal fingerprints are merged first. The distinct ones are cut into ``RADIUS + 2`` bit blocks: two
fingerprints within the radius agree in at least two whole blocks, so every pair of blocks makes a
key under which all true neighbours meet. These complete keys are the first step, tiles the second:
rows of one key value form a tile, or, if there are more than ``TILE`` of them, several tiles by population count and hash. Tile pairs whose population
counts differ by more than the radius cannot hold neighbours and are never formed. A tile pair is
compared exactly with numpy exclusive-or and bit counts, and yields a spanning forest of its links,
never all pairs. Any radius, key value or group size takes the same path.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import shipped, written
from plumbline.llm.components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
BITS = 64
#: Rows of a tile; a tile pair needs about 16 times TILE * STRIP bytes.
TILE = 2048
STRIP = 256
_UPPER = bytes(range(65, 91))
_LOWER_CASE = bytes.maketrans(_UPPER, _UPPER.lower())
#: Shingles hashed between two additions to the bit counts.
_CHUNK = 1 << 16


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority bit vector of the XXH64 of all word shingles, repeats included; no word gives 0."""
    import xxhash

    tokens = (text or b"").translate(_LOWER_CASE).split()
    if not tokens:
        return 0
    if len(tokens) < shingle:
        grams: Iterator = iter([tuple(tokens)])
        total = 1
    else:
        grams = zip(*(tokens[k:] for k in range(shingle)), strict=False)
        total = len(tokens) - shingle + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, _CHUNK):
        size = min(_CHUNK, total - start)
        hashes = np.fromiter((digest(join(g), SEED) for _, g in zip(range(size), grams, strict=False)), "<u8", size)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns as c0, c1, ... and ``fp``, the fingerprint as a signed 64-bit integer. One pass, no shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values.view(np.int64))], schema.names)

    names = [f"c{k}" for k in range(len(keep))]
    given = docs.select(F.col("text").cast("string"), *[F.col(f"`{c}`") for c in keep]).toDF("text", *names)
    schema = given.select(*names, F.lit(0).cast("bigint").alias("fp")).schema
    return given.mapInArrow(rows, schema)


# ---------------------------------------------------------------- links


def _block_keys(fp: Column, radius: int) -> Column:
    """Array of (table, key): the bits of every pair of blocks, one of which all neighbours share."""
    edges = [round(BITS * k / (radius + 2)) for k in range(radius + 3)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    keys = []
    for number, (x, y) in enumerate(combinations(range(len(masks)), 2)):
        mask = masks[x] | masks[y]
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("table"), fp.bitwiseAND(F.lit(signed)).alias("key")))
    return F.array(*keys)


def union_find(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each of ``n`` elements' component under the links ``a``-``b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def _links_within_small_units(unit: np.ndarray, fp: np.ndarray, ones: np.ndarray, radius: int):
    """Links inside units of a few rows: every row against its next, second next, ... of the unit."""
    for step in range(1, len(unit)):
        same = unit[step:] == unit[:-step]
        if not same.any():
            return
        i = np.flatnonzero(same & (np.abs(ones[step:].astype(np.int16) - ones[:-step]) <= radius))
        near = np.bitwise_count(fp[i] ^ fp[i + step]) <= radius
        yield i[near], i[near] + step


def _links_of_tile_pair(fp: np.ndarray, ones: np.ndarray, side: np.ndarray, two: bool, radius: int):
    """Links of one large unit, sorted by population count, in strips of rows."""
    n = len(fp)
    for start in range(0, n, STRIP):
        stop = min(start + STRIP, n)
        end = int(np.searchsorted(ones, ones[stop - 1] + radius, "right"))
        block = np.bitwise_count(fp[start:stop, None] ^ fp[None, start:end]) <= radius
        if two:
            block &= side[start:stop, None] != side[None, start:end]
        i, j = np.nonzero(block)
        keep = i < j
        i, j = i[keep], j[keep]
        if len(i):
            root = union_find(end - start, i, j)  # a forest of the strip instead of all its pairs
            moved = np.flatnonzero(root != np.arange(end - start))
            yield start + root[moved], start + moved


def _link(radius: int):
    def forest(columns: list[np.ndarray], small: int = 64) -> pa.RecordBatch:
        table, key, low, high, fp, ones, side = columns
        n = len(fp)
        starts = np.ones(n, dtype=bool)
        starts[1:] = (table[1:] != table[:-1]) | (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        unit = np.cumsum(starts) - 1
        sizes = np.bincount(unit)
        first = np.flatnonzero(starts)
        few = np.flatnonzero((sizes[unit] <= small) & (low == high))
        a, b = [], []
        for i, j in _links_within_small_units(unit[few], fp[few], ones[few], radius):
            a.append(few[i])
            b.append(few[j])
        for u in np.flatnonzero((sizes > small) | (low[first] != high[first])):
            at = slice(first[u], first[u] + sizes[u])
            two = bool(low[first[u]] != high[first[u]])
            for i, j in _links_of_tile_pair(fp[at], ones[at], side[at], two, radius):
                a.append(first[u] + i)
                b.append(first[u] + j)
        if not a:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["a", "b"])
        root = union_find(n, np.concatenate(a), np.concatenate(b))
        moved = np.flatnonzero(root != np.arange(n))
        signed = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[root[moved]]), pa.array(signed[moved])], ["a", "b"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            columns[4] = columns[4].view(np.uint64)
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            # The last unit may go on in the next batch.
            last = np.ones(len(columns[0]), dtype=bool)
            for c in columns[:4]:
                last &= c == c[-1]
            cut = len(last) if last.all() else int(np.flatnonzero(~last)[-1]) + 1
            if last.all():
                held = columns
                continue
            yield forest([c[:cut] for c in columns])
            held = [c[cut:] for c in columns]
        if held is not None and len(held[0]):
            yield forest(held)

    return rows


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` that connect the same groups as all links.

    Shuffles one narrow row for each fingerprint and key; a key value with many fingerprints is
    dealt out in tile pairs.
    """
    ones = F.bit_count("fp").cast("int")
    keyed = fps.select("fp", ones.alias("ones"), F.explode(_block_keys(F.col("fp"), radius)).alias("k")).select(
        F.col("k.table").alias("table"), F.col("k.key").alias("key"), "fp", "ones"
    )
    # Key values with more rows than a tile: how many tiles each population count takes (at most 65 entries).
    counts = keyed.groupBy("table", "key", "ones").agg(F.count(F.lit(1)).alias("n"))
    parts = F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    crowded = counts.groupBy("table", "key").agg(F.sum("n").alias("n"), parts.alias("parts")).filter(F.col("n") > tile)
    crowded = crowded.select("table", "key", "parts")

    def number(count: Column, part: Column) -> Column:
        return count.cast("bigint") * (1 << 32) + part.cast("bigint")

    own_tiles = F.element_at(F.filter("parts", lambda p: p["ones"] == F.col("ones")), 1)["tiles"]
    own = number(F.col("ones"), F.pmod(F.xxhash64("fp"), own_tiles))
    near = F.filter("parts", lambda p: F.abs(p["ones"] - F.col("ones")) <= radius)
    others = F.flatten(F.transform(near, lambda p: F.transform(F.sequence(F.lit(0), p["tiles"] - 1), lambda t: number(p["ones"], t))))
    pairs = F.transform(
        others, lambda o: F.struct(F.least("own", o).alias("low"), F.greatest("own", o).alias("high"))
    )
    single = F.array(F.struct(F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high")))
    dealt = (
        keyed.join(crowded, ["table", "key"], "left")
        .withColumn("own", F.when(F.col("parts").isNull(), F.lit(0).cast("bigint")).otherwise(own))
        .withColumn("pair", F.explode(F.when(F.col("parts").isNull(), single).otherwise(pairs)))
        .select("table", "key", "pair.low", "pair.high", "fp", "ones", (F.col("own") == F.col("pair.high")).cast("int").alias("side"))
    )
    units = ["table", "key", "low", "high"]
    return (
        dealt.repartition(*[F.col(c) for c in units])
        .sortWithinPartitions(*units, "ones")
        .mapInArrow(_link(radius), "a bigint, b bigint")
    )


def _labelled(docs: DataFrame, radius: int, shingle: int, also: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp and the columns ``also``) of all rows, and (fp, root, component_id) of all distinct fingerprints."""
    marked = written(fingerprints(docs, ["doc_id", *also], shingle).toDF("doc_id", *also, "fp"), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    groups = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    rooted = distinct.join(groups, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return marked, rooted.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text; other columns are ignored).

    ``component_id`` is the smallest doc_id reachable through links, the document itself included.
    NULL and empty texts, and texts without words, have fingerprint 0 and are linked like any other.
    Repeated rows keep one row each; a row with NULL doc_id takes part in linking, and a group of
    such rows alone has a NULL component. An empty table gives no rows.
    """
    marked, labels = _labelled(docs, radius, shingle)
    # The labels are unique on the fingerprint, so a popular one is split on the documents' side.
    return marked.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """Of each group of near-duplicates exactly one row, with all columns of ``docs``: that with the smallest doc_id.

    NULL ids lose against others; of several rows with one doc_id the text with the smallest md5 stays, so
    different texts under one id each count for their own group. NULL and empty texts are one text.
    An empty table gives no rows; other columns are carried whatever their names.
    """
    id_text, text = F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.concat_ws(":", id_text, F.md5(text))
    # Narrow rows choose; the whole rows move once, to the key they are kept by.
    given = docs.select("doc_id", text.alias("text"), key.alias("key"))
    marked, labels = _labelled(given, radius, shingle, ["key"])
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    chosen = marked.join(labels, "fp").groupBy("root").agg(F.min(rank).alias("least")).select(F.col("least.key").alias("_key"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_key"))
    kept = rows.join(chosen, "_key", "left_semi").groupBy("_key").agg(F.first("_row").alias("_row"))
    return kept.select("_row.*")


shipped(__name__)
