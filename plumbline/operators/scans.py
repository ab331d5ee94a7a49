"""Text scans over whole documents: patterns per line, and numbers that facts do not support."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import numbers

# The secret patterns, searched per line.
SECRET_PATTERNS = {
    "private key": r"-----BEGIN (?:RSA |EC |OPENSSH |DSA )?PRIVATE KEY-----",
    "password assignment": r"(?i)\b(?:password|passwd|pwd)\s*[=:]\s*['\"]?[^\s'\";{}]{4,}",
    "storage account key": r"AccountKey=[A-Za-z0-9+/=]{20,}",
    "SAS signature": r"[?&]sig=[A-Za-z0-9%+/=]{20,}",
    "AWS access key": r"\bAKIA[0-9A-Z]{16}\b",
    "GitHub token": r"\bgh[pousr]_[A-Za-z0-9]{30,}\b",
    "OpenAI-style key": r"\bsk-(?:ant-)?[A-Za-z0-9_-]{20,}\b",
    "Slack token": r"\bxox[baprs]-[A-Za-z0-9-]{10,}\b",
    "client secret": r"(?i)client_secret\s*[=:]\s*['\"]?[^\s'\"]{8,}",
}


# What a match of each secret pattern cannot do without: one of these, none of them across a line end.
SECRET_LITERALS = {
    "private key": ("PRIVATE KEY-----",),
    "password assignment": ("password", "passwd", "pwd"),
    "storage account key": ("AccountKey=",),
    "SAS signature": ("?sig=", "&sig="),
    "AWS access key": ("AKIA",),
    "GitHub token": tuple(f"gh{c}_" for c in "pousr"),
    "OpenAI-style key": ("sk-",),
    "Slack token": tuple(f"xox{c}-" for c in "baprs"),
    "client secret": ("client_secret",),
}


# Everything that ends a line; a carriage return before a line feed is part of one end.
LINE_END = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"


def may_match(text: Column, pattern: str, literals: tuple[str, ...]) -> Column:
    """Whether the whole text holds one of the literals; case is ignored where the pattern ignores it."""
    if pattern.startswith("(?i)"):
        return text.rlike("(?i)" + "|".join(rf"\Q{x}\E" for x in literals))
    return reduce(or_, [text.contains(x) for x in literals])


def scan_patterns(
    df: DataFrame,
    key: str,
    text: str,
    patterns: Mapping[str, str] = SECRET_PATTERNS,
    literals: Mapping[str, tuple[str, ...]] = SECRET_LITERALS,
) -> DataFrame:
    """One row per (key, line, pattern) hit; lines count from 1.

    Row-local: lines are split and matched where the document is, only hits leave the scan. A text
    without any literal of ``literals`` is never split, and a line is searched only for patterns whose
    literals its text holds; patterns without an entry are searched for in every line.
    """
    body, line = F.col(text), F.col("_line")
    # An entry belongs to its pattern, not to the name alone.
    given = {n: literals[n] for n in patterns if n in literals and (n not in SECRET_PATTERNS or patterns[n] == SECRET_PATTERNS[n])}
    flags = {n: may_match(body, patterns[n], given[n]) for n in given}
    hits = F.array_compact(
        F.array(
            *[
                F.when((F.col(f"_may{i}") & line.rlike(p)) if name in flags else line.rlike(p), F.lit(name))
                for i, (name, p) in enumerate(patterns.items())
            ]
        )
    )
    found = df.filter(reduce(or_, flags.values())) if len(flags) == len(patterns) else df
    marks = [flags[name].alias(f"_may{i}") for i, name in enumerate(patterns) if name in flags]
    lines = found.select(key, body, *marks).select(
        key, *[f"_may{i}" for i, name in enumerate(patterns) if name in flags],
        F.posexplode(F.split(body, LINE_END)).alias("_position", "_line"),
    )
    return lines.select(
        key,
        (F.col("_position") + 1).cast("bigint").alias("line_number"),
        F.explode(hits).alias("pattern"),
    )


def plain_number(token: Column) -> Column:
    return F.replace(token, F.lit(","), F.lit(""))


def allowed_numbers(facts: Column) -> Column:
    """Numbers a text may use: as written, without trailing zeros, and the integer part."""
    plain = F.transform(numbers(facts), plain_number)
    decimals = F.filter(plain, lambda n: n.contains("."))
    bare = F.transform(decimals, lambda n: F.rtrim(F.rtrim(n, F.lit("0")), F.lit(".")))
    whole = F.transform(decimals, lambda n: F.substring_index(n, ".", 1))
    return F.array_distinct(F.concat(plain, bare, whole))


def ungrounded_numbers(df: DataFrame, text: str, facts: str) -> DataFrame:
    """Adds the numbers of ``text`` that ``facts`` does not contain, in order of appearance."""
    allowed = allowed_numbers(F.coalesce(F.col(facts), F.lit("")))
    found = numbers(F.coalesce(F.col(text), F.lit("")))
    # A set difference per distinct token; copies of an unknown token are reported once.
    unknown = F.array_except(F.transform(found, plain_number), allowed)
    return df.withColumn("ungrounded", unknown)
