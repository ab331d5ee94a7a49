"""Operator 2: sharding by extendible hashing.

The directory is indexed by the leading bits of a hash. It starts as one bucket; a bucket above the
byte limit splits on the next bit, all others stay, until every shard fits.

Bytes are first summed for cells of a few leading bits, in one shuffle of pre-aggregated rows. The
totals of all shorter prefixes follow from the cells, and a cell's shard is its shortest prefix that
fits. Cells that are still too large are taken up again with further bits. Rows that agree in all
hash bits cannot be told apart by any prefix; they are numbered inside their partitions and dealt
out in runs that fit.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import prefix_sums, written

LIMIT_BYTES = 1 << 20
#: Leading bits of md5 that are used: a non-negative 60-bit integer.
HASH_BITS = 60
#: Cells for each expected shard in one round.
_FINER = 4


def hash60(key: Column) -> Column:
    """60 leading bits of the md5 of a text form of the key; NULL counts as an empty key."""
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.conv(digest, 16, 10).cast("bigint")


def _bits(h: str, bits: str) -> Column:
    return F.expr(f"shiftright({h}, cast({HASH_BITS} - {bits} as int))")


def directory(sizes: DataFrame, limit: int = LIMIT_BYTES) -> tuple[DataFrame, bool]:
    """Leaves (depth, prefix, bytes, rows) of the directory for rows (h, bytes), and whether one exceeds the limit.

    A leaf exceeds the limit only at full depth, where its rows share one hash.
    """
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    step = max(1, min(24, math.ceil(math.log2(max(total / limit, 1))) + _FINER))
    leaves, low, open_rows = None, 0, sizes
    while True:
        high = min(HASH_BITS, low + step)
        cells = open_rows.groupBy(_bits("h", str(high)).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        # Every prefix from the last settled depth to the cells; a prefix sums at most 2 ** step cells, map-side first.
        depths = F.sequence(F.lit(low), F.lit(high))
        totals = cells.withColumn("depth", F.explode(depths)).groupBy(
            "depth", F.expr(f"shiftright(cell, cast({high} - depth as int))").alias("prefix")
        ).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        totals = written(totals, "prefixes")
        fitting = F.col("bytes") <= limit
        # A prefix is a leaf if it fits and its parent does not; depth ``low`` has no parent left that fits.
        parents = totals.filter(~fitting).select((F.col("depth") + 1).alias("d"), F.col("prefix").alias("p"))
        child = (F.col("depth") == F.col("d")) & (F.expr("shiftright(prefix, 1)") == F.col("p"))
        found = totals.filter(fitting).join(parents, child, "left_semi")
        if low == 0:
            found = found.unionByName(totals.filter(fitting & (F.col("depth") == 0)))
        over = totals.filter(~fitting & (F.col("depth") == high))
        leaves = found if leaves is None else leaves.unionByName(found)
        if high == HASH_BITS:
            return leaves.unionByName(over), not over.isEmpty()
        if over.isEmpty():
            return leaves, False
        crowded = over.select(F.col("prefix").alias("p"))
        open_rows = open_rows.join(crowded, _bits("h", str(high)) == F.col("p"), "left_semi")
        low = high


COLUMNS = ("doc_id", "bytes", "depth", "shard", "part", "shard_bytes")


def _placed(docs: DataFrame, limit: int, carried: list[Column]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.octet_length(text).cast("bigint").alias("bytes")
    sized = docs.select("doc_id", hash60(F.col("doc_id")).alias("h"), size, *carried)
    leaves, crowded = directory(sized.select("h", "bytes"), limit)
    leaves = written(leaves, "directory")
    # At most HASH_BITS + 1 depths occur; each row is tried at those and has one leaf.
    depths = [r["depth"] for r in leaves.select("depth").distinct().collect()]
    tries = F.explode(F.array(*[F.lit(d) for d in depths]) if depths else F.array().cast("array<int>"))
    leaf = leaves.select("depth", "prefix", F.col("bytes").alias("shard_bytes"))
    placed = sized.withColumn("depth", tries).withColumn("prefix", _bits("h", "depth")).join(leaf, ["depth", "prefix"])
    digits = F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), "0")
    none = F.lit(0).cast("bigint")
    out = placed.withColumn("shard", F.when(F.col("depth") == 0, F.lit("")).otherwise(digits)).withColumn("part", none)
    if not crowded:
        return out
    alone = (F.col("depth") == HASH_BITS) & (F.col("shard_bytes") > limit)
    # By size class, so that all rows of a part are within a factor of two, numbered and cut into runs.
    size_class = F.ceil(F.log2(F.greatest(F.col("bytes"), F.lit(1)))).cast("int")
    hot = out.filter(alone).withColumn("class", size_class).withColumn("one", F.lit(1).cast("bigint"))
    numbered = prefix_sums(hot, "one", [F.col("bytes"), F.col("doc_id")], ["shard", "class"], "number")
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.pow(F.lit(2.0), F.col("class")))).cast("bigint")
    numbered = numbered.withColumn("part", F.col("class").cast("bigint") * (1 << 40) + F.floor(F.col("number") / fit))
    total = numbered.groupBy("shard", "part").agg(F.sum("bytes").alias("part_bytes"))
    hot = numbered.join(total, ["shard", "part"]).withColumn("shard_bytes", F.col("part_bytes"))
    return out.filter(~alone).unionByName(hot.select(*out.columns))


def shards(docs: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, bytes, depth, shard, part, shard_bytes.

    ``shard`` is the prefix as a string of bits (empty for a single bucket). ``part`` is 0 but for
    rows whose ids share one hash and together exceed the limit: those are dealt out in parts that
    fit. Only a single document above the limit stands alone above it. ``bytes`` counts the UTF-8
    text, NULL and empty texts as 0; a NULL doc_id hashes as an empty key. Repeated rows keep one
    row each; an empty table gives no rows; other columns are ignored.
    """
    return _placed(docs, limit, []).select(*COLUMNS)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES) -> None:
    """Write ``docs`` as Parquet, one folder ``_shard=bits-part`` for each shard below ``path``.

    Rows are clustered by shard: one task writes a shard, which is bounded by the limit.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    placed = _placed(docs, limit, [row]).withColumn("_shard", F.concat_ws("-", "shard", "part"))
    placed = placed.repartition("_shard").sortWithinPartitions("_shard")
    placed.select("_row.*", "_shard").write.partitionBy("_shard").parquet(path)


def oracle() -> str:
    """Every prefix of every row, and the shortest that fits."""
    return f"""
WITH s AS (SELECT row_number() OVER () AS rid, doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
                  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {HASH_BITS // 4})) AS BIGINT) AS h FROM documents),
p AS (SELECT s.*, CAST(d.depth AS INTEGER) AS depth, h >> ({HASH_BITS} - d.depth) AS prefix FROM s, range(0, {HASH_BITS + 1}) AS d(depth)),
t AS (SELECT *, sum(bytes) OVER (PARTITION BY depth, prefix) AS shard_bytes FROM p),
leaf AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY depth) AS k FROM t WHERE shard_bytes <= {LIMIT_BYTES})
SELECT doc_id, bytes, depth, CASE WHEN depth = 0 THEN '' ELSE right(repeat('0', 64) || bin(prefix), depth) END AS shard,
       CAST(0 AS BIGINT) AS part, CAST(shard_bytes AS BIGINT) AS shard_bytes FROM leaf WHERE k = 1"""
