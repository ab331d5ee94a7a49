"""Operator 8: mixing sources to target weights.

Words of a source are packed, document after document, into blocks of 256 words; the last block of
a source may be shorter. The mix is a list of slots, each to be filled by one block, dealt over output
shards of a fixed number of slots. Every shard draws its source counts from one multinomial
distribution with the shares of the targets. Free draws miss a target by their sampling noise, so what a
source drew beyond its slots is given to sources that drew too few, evenly over the shards. A source's
slots then run through a pseudorandom permutation of its block numbers, once for each epoch, and blocks
are joined by number. The last slot of a source takes only as many words of its block as its target asks
for, so targets are met to the word whatever the size of a source.

Permutations are swap-or-not ciphers on exactly the numbers needed. Like the draws they are arithmetic on
built-in functions, need no sort and give the same mix in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import GAP, joined_small, prefix_sums, small, words, written

BLOCK_WORDS = 256
SLOTS_PER_SHARD = 8192
#: Weights of the sources in order, repeating, and how often a document may be repeated.
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
SEED = 20_01
_ROUNDS = 12
_PRIME = 2_147_483_647
#: Slots that one task draws or makes, about.
_TASK_SLOTS = 1 << 20


# ---------------------------------------------------------------- permutation


def _mixed(a: str, b: str) -> str:
    return f"(((cast({a} as bigint) % {_PRIME}) * 48271 + (({b}) + 1) * 69621) % {_PRIME} * 16807 % {_PRIME})"


def _point(seed: str, r: str, n: str) -> str:
    """Twice the centre of round ``r``'s mirror."""
    return f"(({_mixed(seed, r)} * {_PRIME} + {_mixed(f'({seed} + 7919)', f'{r} + 31')}) % ({n}))"


def _key(seed: str, r: str) -> str:
    return _mixed(_mixed(seed, r), f"{r} + 101")


def _swap_or_not(x: str, point: str, key: str, n: str) -> str:
    """One round: ``x`` or its mirror image, by a keyed bit of the larger of the two.

    Squaring keeps neighbours from having related bits.
    """
    mirror = f"(({point} + ({n}) - {x}) % ({n}))"
    larger = f"(greatest({x}, {mirror}) % {_PRIME})"
    coin = f"(cast(floor(((({larger} * {larger}) % {_PRIME} + {key}) % {_PRIME} * 16807 % {_PRIME}) / 4096) as bigint) % 2)"
    return f"case when {coin} = 1 then {mirror} else {x} end"


def rounds(seed: str, n: str) -> tuple[Column, Column]:
    """The mirrors and keys of all rounds, two arrays to be made once for each permutation."""
    steps = f"sequence(0L, {_ROUNDS - 1}L)"
    return (
        F.expr(f"transform({steps}, r -> {_point(seed, 'r', n)})"),
        F.expr(f"transform({steps}, r -> {_key(seed, 'r')})"),
    )


def permuted(x: str, points: str, keys: str, n: str, inverse: bool = False) -> Column:
    """The image of 0 <= ``x`` < ``n`` under the permutation of ``rounds`` (SQL expressions of bigint).

    Each round is its own inverse, so the inverse takes the rounds from the last to the first.
    """
    order = f"sequence({_ROUNDS - 1}, 0)" if inverse else f"sequence(0, {_ROUNDS - 1})"
    return F.expr(f"aggregate({order}, {x}, (x, r) -> {_swap_or_not('x', f'{points}[r]', f'{keys}[r]', n)})")


# ---------------------------------------------------------------- targets


def _targets(sizes: DataFrame) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size)."""
    ranked = prefix_sums(sizes.withColumn("one", F.lit(1).cast("bigint")), "one", [F.col("source").asc_nulls_last()], [], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = written(ranked.withColumn("weight", weight.cast("bigint")).drop("one"), "sources")
    cap = F.col("source_size") * MOST_EPOCHS
    whole = ranked.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total, level = whole["size"] or 0, 0.0
    if total:
        # The common level rises while sources stop at their caps; each step is one row of sums.
        level, before = total / whole["weight"], None
        while level != before:
            before = level
            stops = cap <= F.lit(level) * F.col("weight")
            row = ranked.agg(
                F.sum(F.when(stops, cap).otherwise(0)).alias("held"), F.sum(F.when(stops, 0).otherwise(F.col("weight"))).alias("open")
            ).first()
            level = (total - row["held"]) / row["open"] if row["open"] else level
    share = F.lit(level) * F.col("weight")
    return ranked.withColumn("target", F.when(cap <= share, cap.cast("double")).otherwise(share)).drop("weight")


def _plan(rows: DataFrame) -> DataFrame:
    """One row a source: source, rank, source_size, target, blocks, slots, last_words, first_slot.

    ``last_words`` is what the last slot takes of its block, NULL where it takes all of it.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    out = _targets(sizes).withColumn("blocks", F.expr(f"(source_size + {BLOCK_WORDS - 1}) div {BLOCK_WORDS}"))
    points, keys = rounds(f"({SEED} + rank)", "greatest(blocks, 1L)")
    out = out.withColumn("_points", points).withColumn("_keys", keys)
    # The one block that may be short, and how many blocks of an epoch come before it.
    out = out.withColumn("_short", F.expr(f"source_size - (blocks - 1) * {BLOCK_WORDS}"))
    out = out.withColumn("_at", permuted("greatest(blocks - 1, 0L)", "_points", "_keys", "greatest(blocks, 1L)", inverse=True))
    wanted = F.floor(F.col("target") + 0.5).cast("bigint")
    out = out.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0).cast("bigint"))
    out = out.withColumn("_rest", wanted - F.col("_epochs") * F.col("source_size"))
    more = f"""case when _rest <= _at * {BLOCK_WORDS} then (_rest + {BLOCK_WORDS - 1}) div {BLOCK_WORDS}
        when _rest <= _at * {BLOCK_WORDS} + _short then _at + 1
        else (_rest + {BLOCK_WORDS} - _short + {BLOCK_WORDS - 1}) div {BLOCK_WORDS} end"""
    out = out.withColumn("_more", F.expr(more)).withColumn("slots", F.expr("_epochs * blocks + _more"))
    before = f"(_more - 1) * {BLOCK_WORDS} - if(_more - 1 > _at, {BLOCK_WORDS} - _short, 0)"
    out = out.withColumn("last_words", F.expr(f"if(_more > 0, _rest - ({before}), null)"))
    out = out.select("source", "rank", "source_size", "target", "blocks", "slots", "last_words")
    return written(prefix_sums(out, "slots", [F.col("rank")], [], "first_slot"), "plan")


def _fits(plan: DataFrame) -> bool:
    return small(plan, "source")


def _with_plan(df: DataFrame, plan: DataFrame, columns: list[str]) -> DataFrame:
    right = plan.select(F.col("source").alias("_s"), *columns)
    right = F.broadcast(right) if _fits(plan) else right
    return df.join(right, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def _tasks(spark: SparkSession, rows: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-rows // _TASK_SLOTS))


def draws(plan: DataFrame) -> DataFrame:
    """(shard, rank, drawn): each shard's multinomial source counts; the shares are those of the plan's slots.

    A slot's draw is a number below all slots, looked up among the sources' ranges of slots through a
    guide table of about as many cells as sources.
    """
    row = plan.filter("slots > 0").agg(F.sum("slots").alias("slots"), F.count("*").alias("sources")).first()
    total, width = row["slots"] or 0, max(1, -(-(row["slots"] or 0) // max(row["sources"], 1)))
    cells = F.explode(F.expr(f"sequence(first_slot div {width}, (first_slot + slots - 1) div {width})"))
    guide = plan.filter("slots > 0").select("rank", "first_slot", "slots", cells.alias("cell"))
    guide = F.broadcast(guide) if _fits(plan) else guide
    spark = plan.sparkSession
    drawn = spark.range(0, total, 1, _tasks(spark, total)).select(
        F.expr(f"id div {SLOTS_PER_SHARD}").alias("shard"), F.expr(f"pmod(xxhash64({SEED}L, id), {max(total, 1)}L)").alias("draw")
    )
    found = drawn.withColumn("cell", F.expr(f"draw div {width}")).join(guide, "cell").filter("draw >= first_slot and draw < first_slot + slots")
    return found.groupBy("shard", "rank").agg(F.count("*").alias("drawn"))


def slots(plan: DataFrame) -> DataFrame:
    """(shard, slot, source_rank, epoch, block, last_words): the mix as a list of slots, in any order."""
    spark = plan.sparkSession
    cells = prefix_sums(draws(plan), "drawn", [F.col("shard")], ["rank"], "start")
    # A shard has no more sources than slots, so this window is bounded.
    cells = written(cells.withColumn("offset", F.sum("drawn").over(Window.partitionBy("shard").orderBy("rank")) - F.col("drawn")), "draws")
    sums = cells.groupBy("rank").agg(F.sum("drawn").alias("all_drawn"))
    totals = plan.filter("slots > 0").join(sums, "rank", "left").fillna(0, ["all_drawn"])
    totals = totals.withColumn("over", F.expr("greatest(all_drawn - slots, 0L)")).withColumn("under", F.expr("greatest(slots - all_drawn, 0L)"))
    totals = prefix_sums(totals, "over", [F.col("rank")], [], "over_before")
    totals = written(prefix_sums(totals, "under", [F.col("rank")], [], "under_before"), "totals")
    size = totals.agg(F.sum("slots").alias("slots"), F.sum("over").alias("over")).first()
    total, freed = size["slots"] or 0, size["over"] or 0
    tasks = _tasks(spark, total)

    # Of the slots that a source drew beyond its own, each shard gives up its part.
    values = totals.select("rank", "all_drawn", "over", "over_before")
    cells = joined_small(cells, values, ["rank"], "inner", _fits(plan))
    cells = cells.withColumn("gone", F.expr("start * over div all_drawn"))
    cells = cells.withColumn("gives", F.expr("(start + drawn) * over div all_drawn - gone"))
    points, keys = rounds(f"({SEED} + 104729 + shard)", "room")
    cells = cells.withColumn("room", F.expr(f"least({SLOTS_PER_SHARD}L, {total}L - shard * {SLOTS_PER_SHARD})"))
    # The number of tasks is stated, as each of these few rows becomes up to a shard's slots.
    cells = cells.repartition(tasks, "shard", "rank").withColumn("_points", points).withColumn("_keys", keys)
    each = cells.withColumn("u", F.explode(F.expr("sequence(0L, drawn - 1)")))
    each = each.withColumn("slot", permuted("offset + u", "_points", "_keys", "room"))
    kept = each.filter("u < drawn - gives").select("shard", "slot", "rank", F.expr("start - gone + u").alias("j"))
    points, keys = rounds(f"{SEED}", f"{max(freed, 1)}L")
    free = each.filter("u >= drawn - gives").select("shard", "slot", F.expr("over_before + gone + u - (drawn - gives)").alias("q"))
    free = free.withColumn("_points", points).withColumn("_keys", keys)
    free = free.select("shard", "slot", permuted("q", "_points", "_keys", f"{max(freed, 1)}L").alias("unit"))
    # A source may lack many slots, so they are made in runs that are dealt out.
    lacks = totals.filter("under > 0").withColumn("run", F.explode(F.expr(f"sequence(0L, (under - 1) div {SLOTS_PER_SHARD})")))
    lacks = lacks.repartition(_tasks(spark, freed), "rank", "run")
    ends = f"least(under, (run + 1) * {SLOTS_PER_SHARD}) - 1"
    lacks = lacks.withColumn("t", F.explode(F.expr(f"sequence(run * {SLOTS_PER_SHARD}, {ends})")))
    lacks = lacks.select("rank", F.expr("all_drawn + t").alias("j"), F.expr("under_before + t").alias("unit"))
    given = free.join(lacks, "unit").select("shard", "slot", "rank", "j")

    points, keys = rounds(f"({SEED} + rank)", "greatest(blocks, 1L)")
    sources = plan.select("rank", "blocks", F.col("slots").alias("n"), "last_words", points.alias("_points"), keys.alias("_keys"))
    found = joined_small(kept.unionByName(given), sources, ["rank"], "inner", _fits(plan))
    return found.select(
        "shard", "slot", F.col("rank").alias("source_rank"), F.expr("j div blocks").alias("epoch"),
        permuted("j % blocks", "_points", "_keys", "blocks").alias("block"), F.expr("if(j = n - 1, last_words, null)").alias("last_words"),
    )


# ---------------------------------------------------------------- documents


def _rows(docs: DataFrame, carried: list[Column]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.size(words(text)).cast("bigint").alias("size"), F.xxhash64(text).alias("body"), *carried
    )


def _packed(docs: DataFrame, carried: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``start``, the words before them in their source, and the plan of the sources.

    Rows with words are told apart by (source, start). Ties of doc_id are ordered by the text.
    """
    rows = prefix_sums(_rows(docs, carried), "size", [F.col("doc_id"), F.col("body")], ["source"], "start")
    return rows, _plan(_rows(docs, []) if not carried else rows.select("source", "size"))


def pieces(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(shard, slot, source_rank, epoch, start, low, high): words low to high of the row at ``start`` fill part of a slot."""
    spans = _with_plan(rows.filter("size > 0").select("source", "start", "size"), plan, ["rank"])
    first, last = f"start div {BLOCK_WORDS}", f"(start + size - 1) div {BLOCK_WORDS}"
    cut = spans.withColumn("block", F.explode(F.expr(f"sequence({first}, {last})"))).withColumnRenamed("rank", "source_rank")
    # Slots are made from the few rows of the plan, so their size is far above what Spark would guess.
    filled = slots(plan).hint("merge").join(cut, ["source_rank", "block"])
    filled = filled.withColumn("low", F.expr(f"greatest(0, block * {BLOCK_WORDS} - start)"))
    filled = filled.withColumn("high", F.expr(f"least(size, block * {BLOCK_WORDS} + coalesce(last_words, {BLOCK_WORDS}) - start)"))
    return filled.filter("high > low").select("shard", "slot", "source_rank", "epoch", "start", "low", "high")


def digest(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, source_size, target, taken.

    NULL texts have size 0 and are never taken; a NULL source is a source of its own, ranked last;
    rows with a NULL doc_id come first in their source. Repeated rows are documents of their own; an
    empty table gives no rows; a table without words has targets of 0. Other columns are ignored.
    """
    rows, plan = _packed(docs, [])
    rows = written(rows, "packed")
    taken = pieces(rows, plan).groupBy(F.col("source_rank").alias("rank"), "start").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    ranked = _with_plan(rows, plan, ["rank", "source_size", "target"])
    # A row without words shares its start with the next one and must not take its words.
    found = ranked.join(taken.withColumn("some", F.lit(True)), ["rank", "start"], "left")
    count = F.when((F.col("size") > 0) & F.col("taken").isNotNull(), F.col("taken")).otherwise(0)
    return found.select("doc_id", "size", "source_size", "target", count.cast("bigint").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: one row for each document and epoch that takes it.

    A document that an epoch takes whole keeps its text as it is; of one that it takes in part, the
    taken words follow each other separated by blanks. ``n_chars``, if there, is the new length.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows, plan = _packed(docs, [row])
    rows = written(rows, "packed")
    taken = pieces(rows.select("source", "start", "size"), plan)
    parts = taken.groupBy(F.col("source_rank").alias("rank"), "start", "epoch").agg(
        F.sum(F.col("high") - F.col("low")).alias("taken"), F.sort_array(F.collect_list(F.struct("low", "high"))).alias("parts")
    )
    ranked = _with_plan(rows.filter("size > 0"), plan, ["rank"])
    found = ranked.join(parts, ["rank", "start"])
    w = words(F.col("_row")["text"].cast("string"))
    chosen = F.flatten(F.transform("parts", lambda p: F.slice("_w", (p["low"] + 1).cast("int"), (p["high"] - p["low"]).cast("int"))))
    partly = F.col("taken") < F.col("size")
    found = found.withColumn("_w", F.when(partly, w))
    text = F.when(partly, F.array_join(chosen, " ")).otherwise(F.col("_row")["text"].cast("string"))
    found = found.withColumn("_text", text)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_text").alias(c))
        elif c == "n_chars":
            columns.append(F.length("_text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("_row")[c].alias(c))
    return found.select(*columns)


def oracle() -> str:
    """The same mix without shards: a source's whole epochs, and of its last one blocks until the words run out."""
    seed = f"({SEED} + rank)"
    perm = f"list_reduce(range({_ROUNDS}), lambda x, r: {_swap_or_not('x', 'points[r + 1]', 'keys[r + 1]', 'blocks')}, j)"
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    return f"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
        CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda x: x <> '')) AS BIGINT) AS size FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM t GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s0),
s2 AS (SELECT *, CAST({weights}[CAST(rank % {len(WEIGHTS)} AS INTEGER) + 1] AS BIGINT) AS weight FROM s1),
lev(i, l) AS (SELECT 0, CAST((SELECT sum(source_size) / sum(weight) FROM s2) AS DOUBLE) UNION ALL
   SELECT i + 1, (SELECT CASE WHEN sum(CASE WHEN {MOST_EPOCHS} * source_size <= l * weight THEN 0 ELSE weight END) = 0 THEN l ELSE
      ((SELECT sum(source_size) FROM s2) - sum(CASE WHEN {MOST_EPOCHS} * source_size <= l * weight THEN {MOST_EPOCHS} * source_size ELSE 0 END))
      / sum(CASE WHEN {MOST_EPOCHS} * source_size <= l * weight THEN 0 ELSE weight END) END FROM s2) FROM lev WHERE i < 60),
s3 AS (SELECT s2.*, CASE WHEN {MOST_EPOCHS} * source_size <= l * weight THEN CAST({MOST_EPOCHS} * source_size AS DOUBLE) ELSE l * weight END AS target,
        CAST({BLOCK_WORDS} AS BIGINT) AS bw FROM s2, lev WHERE i = 60),
s4 AS (SELECT *, CAST(ceil(source_size / bw) AS BIGINT) AS blocks, CAST(floor(target + 0.5) AS BIGINT) AS goal FROM s3),
s5 AS (SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS epochs,
        CASE WHEN source_size > 0 THEN goal % source_size ELSE 0 END AS rest FROM s4),
d AS (SELECT t.*, s5.rank, s5.source_size, s5.target, s5.bw, s5.epochs, CAST(coalesce(sum(size) OVER (PARTITION BY t.source ORDER BY doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM t JOIN s5 ON t.source IS NOT DISTINCT FROM s5.source),
keyed AS (SELECT *, [{_point(seed, 'r', 'greatest(blocks, 1)')} FOR r IN range({_ROUNDS})] AS points, [{_key(seed, 'r')} FOR r IN range({_ROUNDS})] AS keys FROM s5),
places AS (SELECT rank, source_size, bw, rest, blocks, points, keys, unnest(range(blocks)) AS j FROM keyed WHERE rest > 0),
dealt AS (SELECT rank, source_size, bw, rest, j, {perm} AS block FROM places),
lens AS (SELECT *, least(bw, source_size - block * bw) AS len FROM dealt),
extra AS (SELECT rank, block, least(len, greatest(0, rest - (sum(len) OVER (PARTITION BY rank ORDER BY j) - len))) AS most FROM lens),
more AS (SELECT rid, sum(greatest(0, least(start + size, block * bw + most) - greatest(start, block * bw))) AS n
         FROM d JOIN extra USING (rank) WHERE size > 0 AND most > 0 AND block BETWEEN start // bw AND (start + size - 1) // bw GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size = 0 THEN 0 ELSE epochs * size + coalesce(n, 0) END AS BIGINT) AS taken
FROM d LEFT JOIN more USING (rid)"""
