"""Operator 12: groups of spelling variants through pivotal grams.

Two words are near when one inserted, deleted or replaced code point makes one of the other. One edit
touches at most one of two disjoint bigrams, so of any two disjoint bigrams of a word one stands
unchanged in every near word, at the same place or one further. With all bigrams in one order, rare
ones first, every word has a prefix (its first three bigrams, with all that equal the third) and two
disjoint pivots chosen within it by dynamic programming for the least total frequency. Of two near
words, the pivots of that with the lesser prefix end meet the other's prefix; so pivots are joined
with prefixes on bigram, place and length, shifted as the difference in length allows, and on what stands
on one side of the bigram, for the edit is on the other. The pairs that meet are verified. No pair is
lost, and no two words meet for a common bigram alone.

Words are counted in the tasks that hold the texts, then by one aggregate; all else runs on distinct words.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import discard, joined_small, shipped, small, written

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A variant's form occurs at least so many times as often.
MANY_TIMES = 5
#: Fixed values of the contract: runs of letters, and the divisor by which a run loses a code point.
RUN = "[a-zÀ-ÿ]+"
LOSES = 199
#: Distinct words that a task holds before it hands their counts on.
HELD_WORDS = 400_000
#: Edits that are bridged, code points of a gram.
EDITS, GRAM = 1, 2
_UPPER = bytes(range(65, 91))
_LOWER_CASE = bytes.maketrans(_UPPER, _UPPER.lower())


# ---------------------------------------------------------------- words


def document_words(doc_id, text: bytes, runs: re.Pattern) -> Counter:
    """Words of a text with their numbers, runs that lose a code point in their changed form."""
    found = Counter(runs.findall(text.translate(_LOWER_CASE).decode("utf-8", "replace")))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    changed = []
    for run, n in found.items():
        h = zlib.crc32(run.encode(), start)
        if h % LOSES == 0:
            at = h % len(run)
            changed.append((run, run[:at] + run[at + 1 :], n))
    for run, word, n in changed:
        found[run] -= n
        found[word] += n
    return found


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) for words of at least ``least_length`` code points with at least ``least_count`` occurrences in all texts."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held = re.compile(RUN), Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                for word, n in document_words(doc_id, text.as_py(), runs).items():
                    if n and len(word) >= least_length:
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield told()
                    held.clear()
        yield told()

    given = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = given.mapInArrow(made, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


# ---------------------------------------------------------------- grams


def disjoint(places: Sequence[int], cost: Sequence[int], wanted: int = EDITS + 1, width: int = GRAM) -> list[int]:
    """Indexes of ``wanted`` grams that do not overlap, of least total cost; ``places`` ascend.

    ``best[j][i]`` is the least cost of ``j`` disjoint grams among the first ``i``.
    """
    n, none = len(places), float("inf")
    before = [max((k for k in range(i + 1) if k == 0 or places[k - 1] + width <= places[i]), default=0) for i in range(n)]
    best = [[0.0] * (n + 1)] + [[none] * (n + 1) for _ in range(wanted)]
    for j in range(1, wanted + 1):
        for i in range(1, n + 1):
            best[j][i] = min(best[j][i - 1], best[j - 1][before[i - 1]] + cost[i - 1])
    chosen, i = [], n
    for j in range(wanted, 0, -1):
        while best[j][i] == best[j][i - 1]:
            i -= 1
        chosen.append(i - 1)
        i = before[i - 1]
    return chosen[::-1]


def signature(word: str, order: dict[str, int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Prefix and pivots of a word as (gram's number in the order, place).

    The prefix has the first ``EDITS * GRAM + 1`` grams by number, which hold ``EDITS + 1`` disjoint ones,
    and all that equal the last of them, so that equal grams are inside or outside together.
    """
    grams = sorted((order[word[k : k + GRAM]], k) for k in range(len(word) - GRAM + 1))
    last = grams[min(len(grams), EDITS * GRAM + 1) - 1][0]
    prefix = sorted((g for g in grams if g[0] <= last), key=lambda g: g[1])
    # Numbers ascend with the frequency, so they are the cost: rarer pivots meet fewer words.
    chosen = disjoint([p for _, p in prefix], [g for g, _ in prefix])
    return prefix, [prefix[k] for k in chosen]


def _gram_order(words: DataFrame) -> dict[str, int]:
    """Numbers of all grams of the words, the rarest first. A run's letters make at most 90 x 90 grams."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - (GRAM - 1)), lambda k: F.substring("word", k, F.lit(GRAM)))
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return {r["gram"]: k for k, r in enumerate(sorted(counts.collect(), key=lambda r: (r["n"], r["gram"])))}


def stands(word: str, pivots: Sequence[tuple[int, int]]) -> list[tuple]:
    """Where pivots stand in near words: (gram, place, length, side that is equal, its letters).

    In a word of equal length a gram that the edit leaves stands at the same place, with equal letters on
    the left or on the right. If the word is longer or shorter by one, it stands at the same place with
    equal letters on the left, or is moved by one with equal letters on the right.
    """
    n, found = len(word), []
    for gram, place in pivots:
        left, right = word[:place], word[place + GRAM :]
        found += [(gram, place, n + more, "<", left) for more in (0, 1, -1)]
        found += [(gram, place + more, n + more, ">", right) for more in (0, 1, -1)]
    return found


def own_stands(word: str, prefix: Sequence[tuple[int, int]]) -> list[tuple]:
    """Where a word's own grams stand, in the form of ``stands``."""
    n = len(word)
    return [x for g, p in prefix for x in ((g, p, n, "<", word[:p]), (g, p, n, ">", word[p + GRAM :]))]


def _keys(words: DataFrame, order: dict[str, int], pivots: bool) -> DataFrame:
    """(word, n, h): a row for each hash of where the word's pivots stand in near words, or its prefix in itself."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            row, hashes = [], []
            for k, word in enumerate(batch.column(0).to_pylist()):
                prefix, chosen = signature(word, order)
                for x in stands(word, chosen) if pivots else own_stands(word, prefix):
                    row.append(k)
                    hashes.append(xxhash.xxh64_intdigest("%d %d %d %s%s" % x))
            keys = pa.array(np.array(hashes, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(row, pa.int32())) for c in batch.columns], keys], ["word", "n", "h"])

    return words.select("word", "n").mapInArrow(made, "word string, n bigint, h bigint")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb) for all pairs of near words, each once with a < b. ``words``: (word, n), distinct, of six letters or more."""
    order = _gram_order(words)
    left = _keys(words, order, True).select(F.col("word").alias("p"), F.col("n").alias("np"), "h")
    right = _keys(words, order, False).select(F.col("word").alias("q"), F.col("n").alias("nq"), "h")
    met = left.join(right, "h").filter((F.col("p") != F.col("q")) & (F.levenshtein("p", "q", EDITS) == EDITS))
    ordered = F.when(F.col("p") < F.col("q"), F.struct("p", "np", "q", "nq")).otherwise(
        F.struct(F.col("q").alias("p"), F.col("nq").alias("np"), F.col("p").alias("q"), F.col("np").alias("nq"))
    )
    pair = met.select(ordered.alias("x")).select(F.col("x.p").alias("a"), F.col("x.np").alias("na"), F.col("x.q").alias("b"), F.col("x.nq").alias("nb"))
    return pair.distinct()


# ---------------------------------------------------------------- forms and roots


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that forms lead to. A form is ``MANY_TIMES`` as frequent, so chains are short and end."""
    current = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = joined_small(current, step, "root", "left", small(step, "root", "next"))
        following = written(followed.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(current)
        current = following
        if not current.filter("moved").limit(1).count():
            return current.select("word", "root")


def group(words: DataFrame, many_times: int = MANY_TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n).

    The form is the near word of largest n (of equal ones the smallest in code-point order), if it occurs
    ``many_times`` as often; the root is where forms lead to, the word itself without a form.
    """
    pairs = written(near_pairs(words), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m"))
    )
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    joined = words.join(best, "word", "left").withColumn("_is", -F.col("best.m") >= many_times * F.col("n"))
    formed = joined.select(
        "word",
        F.when(F.col("_is"), F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(F.col("_is"), -F.col("best.m")).alias("form_n"),
    )
    formed = written(formed, "forms")
    roots = _roots(formed.filter("form is not null"))
    whole = formed.join(roots, "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of all texts of ``docs`` (doc_id, text); see ``group`` for the columns.

    NULL and empty texts have no words; a NULL doc_id counts as an empty one; repeated rows count as
    often as they occur; an empty table gives no rows; other columns are ignored.
    """
    return group(written(count_words(docs), "words"))


def oracle() -> str:
    """The same in SQL: near words by a blanked or a left-out code point at every place, the checksum by its rule."""
    return f"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT [list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
          for i in range(256)] AS tab),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY doc_id, run),
bytes AS (SELECT *, [CAST('0x' || h AS BIGINT) for h in regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..')] AS b FROM runs),
sums AS MATERIALIZED (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c // 256, tab[xor(c % 256, x) + 1])), 4294967295) AS h
  FROM bytes CROSS JOIN tab),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {LOSES} = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM sums)
  WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
cuts AS MATERIALIZED (
  SELECT word, n, k, left(word, k - 1) || substr(word, k + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)),
near AS MATERIALIZED (
  SELECT DISTINCT a.word AS word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.less = b.less AND a.k = b.k AND a.word <> b.word
  UNION SELECT w.word, c.word, c.n FROM words w JOIN cuts c ON w.word = c.less
  UNION SELECT c.word, w.word, w.n FROM words w JOIN cuts c ON w.word = c.less),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS r FROM near),
formed AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {MANY_TIMES} * n THEN other END AS form, CASE WHEN m >= {MANY_TIMES} * n THEN m END AS form_n
  FROM words LEFT JOIN ranked ON words.word = ranked.word AND r = 1),
walk AS (SELECT word, word AS at FROM words UNION SELECT walk.word, form FROM walk JOIN formed ON walk.at = formed.word WHERE form IS NOT NULL)
SELECT formed.word, formed.form, walk.at AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN walk USING (word) JOIN formed AS last ON last.word = walk.at WHERE last.form IS NULL"""


shipped(__name__)
