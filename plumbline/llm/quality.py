"""Operator 6: document quality rules as a short-circuit cascade.

A rule is cheap or dear (its features must be computed) and rejects few or many documents. Both are
estimated on a bounded sample, the cost by timing the rule's features, and the rules are then tried
in order of rejections per cost: once a rule rejects a document, the features of later rules are
not computed for it. The order changes the work, never the verdict: a document is kept if no rule
rejects it.

All features are built-in array and string functions on whole texts; no row leaves its task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import GAP, words

#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rows on which costs and selectivities are estimated; they steer the order only.
SAMPLE_ROWS = 500
_POSITION_BITS = 24
_LETTER = r"\p{L}"


# ---------------------------------------------------------------- features


def _covered(positions: Column) -> Column:
    """Words covered by 3-word windows that start at the ascending ``positions``."""
    steps = F.transform(positions, lambda p, k: F.least(F.lit(3).cast("bigint"), F.coalesce(F.get(positions, k + 1) - p, F.lit(3).cast("bigint"))))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, s: total + s)


def _position(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def _hash_part(entry: Column) -> Column:
    return F.shiftright(entry, _POSITION_BITS)


def _repeat_features(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words from ``_w``, the words.

    Windows become 40-bit hashes packed with their position; sorting brings equal ones together.
    Neighbours with equal hashes are compared word for word: if any differ, or positions need more
    bits, the text takes the exact route that sorts the windows themselves.
    """
    w = F.col("_w")
    starts = F.sequence(F.lit(0), F.size(w) - 3)
    packed = F.transform(
        starts,
        lambda i: F.shiftleft(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), _POSITION_BITS).bitwiseOR(i.cast("bigint")),
    )
    enough = F.size(w) >= 3
    df = df.withColumn("_s", F.when(enough & (F.size(w) < (1 << _POSITION_BITS)), F.sort_array(packed)))
    s = F.col("_s")

    def twin(x: Column, k: Column) -> Column:
        after, before = F.get(s, k + 1), F.get(s, k - 1)
        return F.coalesce(_hash_part(after) == _hash_part(x), F.lit(False)) | F.coalesce(_hash_part(before) == _hash_part(x), F.lit(False))

    df = df.withColumn("_twins", F.filter(s, twin))
    twins = F.col("_twins")

    def clash(i: Column) -> Column:
        a, b = F.get(twins, i), F.get(twins, i + 1)
        p, q = _position(a).cast("int"), _position(b).cast("int")
        other = (F.get(w, p) != F.get(w, q)) | (F.get(w, p + 1) != F.get(w, q + 1)) | (F.get(w, p + 2) != F.get(w, q + 2))
        return F.coalesce((_hash_part(a) == _hash_part(b)) & other, F.lit(False))

    clashes = F.when(F.size(twins) > 1, F.exists(F.sequence(F.lit(0), F.size(twins) - 2), clash)).otherwise(F.lit(False))
    sure = F.col("_s").isNotNull() & ~clashes
    df = df.withColumn("_exact", F.when(enough & ~sure, F.array_sort(F.transform(starts, lambda i: F.struct(F.concat_ws(" ", F.slice(w, i + 1, 3)).alias("g"), i.cast("bigint").alias("p"))))))
    exact = F.col("_exact")
    exact_twins = F.filter(
        exact,
        lambda x, k: F.coalesce(F.get(exact, k + 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(exact, k - 1)["g"] == x["g"], F.lit(False)),
    )
    df = df.withColumn("_at", F.sort_array(F.when(sure, F.transform(twins, _position)).otherwise(F.transform(exact_twins, lambda x: x["p"]))))
    repeat = F.when(F.size("_at") > 0, _covered(F.col("_at"))).otherwise(F.lit(0).cast("bigint"))
    return df.withColumn("n_repeat_words", F.coalesce(repeat, F.lit(0).cast("bigint"))).drop("_s", "_twins", "_exact", "_at")


def _with_words(df: DataFrame) -> DataFrame:
    return df.withColumn("_w", words(F.col("_text"))).withColumn("n_words", F.size("_w").cast("bigint"))


def _with_word_chars(df: DataFrame) -> DataFrame:
    return df.withColumn("word_chars", F.length(F.array_join("_w", "")).cast("bigint"))


def _with_symbols(df: DataFrame) -> DataFrame:
    left = F.regexp_replace("_text", r"[#*$%&|<>]+", "")
    return df.withColumn("n_symbols", (F.length("_text") - F.length(left)).cast("bigint"))


def _with_lines(df: DataFrame) -> DataFrame:
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_lines", lines).withColumn("n_lines", F.size("_lines").cast("bigint"))
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"))
    return df.drop("_lines")


def _with_letters(df: DataFrame) -> DataFrame:
    no_letters = F.filter("_w", lambda x: ~x.rlike(_LETTER))
    return df.withColumn("n_no_letter_words", F.size(no_letters).cast("bigint"))


def _with_capitals(df: DataFrame) -> DataFrame:
    left = F.regexp_replace("_text", r"\p{Lu}+", "")
    return df.withColumn("n_capitals", (F.length("_text") - F.length(left)).cast("bigint"))


#: Feature groups: what each adds. All need the words, which every rule pays for once.
FEATURES: dict[str, tuple[Callable[[DataFrame], DataFrame], tuple[str, ...]]] = {
    "word_chars": (_with_word_chars, ("word_chars",)),
    "symbols": (_with_symbols, ("n_symbols",)),
    "lines": (_with_lines, ("n_lines", "n_dup_lines")),
    "repeats": (_repeat_features, ("n_repeat_words",)),
    "letters": (_with_letters, ("n_no_letter_words",)),
    "capitals": (_with_capitals, ("n_capitals",)),
}
BASE = ("word_chars", "symbols", "lines", "repeats")


@dataclass(frozen=True)
class Rule:
    """Rejects a document when ``rejects`` is true; needs the columns of the feature groups."""

    name: str
    needs: tuple[str, ...]
    rejects: str


#: Public heuristics for web text: length, repetition, symbols, word length, duplicate lines, words without letters, shouting.
RULES = (
    Rule("short", (), f"n_words < {MIN_WORDS}"),
    Rule("repeated_windows", ("repeats",), f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule("symbols", ("symbols",), "10 * n_symbols > n_words"),
    Rule("word_length", ("word_chars",), "word_chars < 3 * n_words or word_chars > 12 * n_words"),
    Rule("duplicate_lines", ("lines",), "n_dup_lines > 2 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("no_letters", ("letters",), "5 * n_no_letter_words > n_words"),
    Rule("shouting", ("capitals", "word_chars"), "2 * n_capitals > word_chars"),
)


def _start(docs: DataFrame) -> DataFrame:
    """The whole row in one column, beside the text, so that no column of ``docs`` can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("_row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))


def measure(docs: DataFrame, features: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """(_row, n_words and the features' columns) for every row of ``docs``. NULL text: no words."""
    df = _with_words(_start(docs))
    names = ["n_words"]
    for name in features:
        add, columns = FEATURES[name]
        df = add(df)
        names += columns
    return df.select("_row", *[_held(c) for c in names])


def _held(name: str) -> Column:
    """The column, tied to the running row number: filters and joins of callers stay above what computes it.

    Pushed below, they would copy the nested expressions of every feature and rule again and again.
    """
    return F.when(F.monotonically_increasing_id() >= 0, F.col(name)).alias(name)


# ---------------------------------------------------------------- cascade


def rank(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per cost on a sample of about ``sample_rows`` rows, best first.

    The sample is drawn over the whole table by row and only steers the order. A rule's cost is the
    time its features take on the sample beyond that of the words; its selectivity is the share it rejects.
    """
    rows = docs.select(F.col("text").cast("string").alias("text"))
    n = rows.count()
    if not n:
        return list(rules)
    sample = rows.sample(min(1.0, sample_rows / n), seed=11).repartition(1).persist()
    measured = measure(sample, list(FEATURES))
    hits = measured.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.coalesce(F.expr(f"int({r.rejects})"), F.lit(0))).alias(r.name) for r in rules]
    ).first()

    def seconds(features: Sequence[str]) -> float:
        start = time.perf_counter()
        measure(sample, features).drop("_row").write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(())
    floor = min(seconds(()), seconds(()))
    cost = {name: max(min(seconds(("word_chars", name)) if name == "letters" else seconds((name,)) for _ in range(2)) - floor, 1e-4) for name in {f for r in rules for f in r.needs}}
    sample.unpersist()
    total = max(hits["n"], 1)

    def worth(rule: Rule) -> float:
        return ((hits[rule.name] or 0) / total + 1e-6) / (sum(cost[f] for f in rule.needs) + 1e-4)

    return sorted(rules, key=worth, reverse=True)


def verdicts(docs: DataFrame, rules: Sequence[Rule], also: Sequence[str] = ()) -> DataFrame:
    """(_row, kept, n_words, columns of ``also``) with the rules tried in the given order.

    ``also`` names feature groups that are computed for every row. Other features are computed only
    for rows that no earlier rule has rejected.
    """
    df = _with_words(_start(docs)).withColumn("_all_text", F.col("_text")).withColumn("_all_w", F.col("_w"))
    have: list[str] = []
    for name in also:
        df = FEATURES[name][0](df)
        have.append(name)
    df = df.withColumn("kept", F.lit(True))
    for rule in rules:
        for name in rule.needs:
            if name not in have:
                # Rejected rows go on with empty inputs, which cost next to nothing.
                df = df.withColumn("_text", F.when(F.col("kept"), F.col("_all_text")).otherwise(F.lit("")))
                df = df.withColumn("_w", F.when(F.col("kept"), F.col("_all_w")).otherwise(F.array().cast("array<string>")))
                df = FEATURES[name][0](df)
                have.append(name)
        df = df.withColumn("kept", F.col("kept") & ~F.coalesce(F.expr(rule.rejects), F.lit(False)))
    columns = [c for name in also for c in FEATURES[name][1]]
    return df.select("_row", *[_held(c) for c in ("kept", "n_words", *columns)])


def quality(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    A text without words is rejected as short. Repeated rows are judged alike and all kept or all
    dropped; an empty table stays empty; other columns are carried whatever their names.
    """
    return verdicts(docs, rank(docs, rules, sample_rows)).filter("kept").select("_row.*")


def digest(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the base measures, base_failed and kept."""
    judged = verdicts(docs, rank(docs, rules, sample_rows), also=BASE)
    failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    return judged.select(
        F.col("_row")["doc_id"].alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "kept",
    )


def oracle() -> str:
    """The digest in SQL: windows as rows instead of sorted arrays."""
    gap = GAP.replace("\\", "\\")
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, list_filter(regexp_split_to_array(text, '{gap}'), lambda x: x <> '') AS w FROM t),
pos AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) >= 3),
grams AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, w[p], w[p + 1], w[p + 2]) AS n FROM pos),
covered AS (SELECT rid, count(DISTINCT q) AS n_repeat_words
            FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM grams WHERE n > 1) GROUP BY rid),
lines AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
f AS (SELECT w.rid, w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(list_filter(w, lambda x: NOT regexp_matches(x, '\\p{{L}}'))) AS BIGINT) AS no_letter,
        CAST(length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS BIGINT) AS capitals
      FROM w JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars NOT BETWEEN 3 * n_words AND 12 * n_words
            OR (n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines) OR 5 * no_letter > n_words OR 2 * capitals > word_chars) AS kept
FROM b"""
