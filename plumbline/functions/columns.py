"""Column functions shared by the operators. All are built-in expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUS = "−"
REASON_SEPARATOR = " | "


# ---------------------------------------------------------------- codes and money


def code(column: Column) -> Column:
    """Normalised code: trimmed, upper case."""
    return F.upper(F.trim(column))


def to_cents(amount: Column, rate: Column) -> Column:
    """Convert one amount and round it half up to cents, before any sum."""
    return F.round(amount * rate, 2).cast("decimal(18,2)")


def money(column: Column) -> Column:
    return column.cast("decimal(18,2)")


def percent_of(part: Column, whole: Column, kind: str = "decimal(9,2)") -> Column:
    """100 * part / whole, NULL when the whole is zero."""
    return (F.lit(100) * part / F.nullif(whole, F.lit(0).cast("decimal(18,2)"))).cast(kind)


# ---------------------------------------------------------------- time


def utc(moment: datetime | str) -> Column:
    """A timestamp literal. Sessions run in UTC, so naive values mean UTC."""
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp")


def age_minutes(latest: Column, as_of: Column) -> Column:
    """Whole minutes between two timestamps, rounded down, NULL without data."""
    elapsed = F.unix_micros(as_of) - F.unix_micros(latest)
    return F.floor(elapsed / F.lit(60_000_000)).cast("bigint")


def parse_utc(text: Column) -> Column:
    """ISO-8601 or SQL-style text to a timestamp; empty text is NULL."""
    return F.nullif(F.trim(text), F.lit("")).cast("timestamp")


def format_utc(moment: Column) -> Column:
    shown = F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(F.concat(shown, F.lit(" UTC")), F.lit("never"))


def iso_z(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


# ---------------------------------------------------------------- text


def cad(amount: Column, signed: bool = False) -> Column:
    """``CAD 1,234.56`` with a typographic minus and, when signed, a plus."""
    text = F.concat(F.lit("CAD "), F.format_number(F.abs(amount), 2))
    positive = F.concat(F.lit("+" if signed else ""), text)
    return F.when(amount >= 0, positive).otherwise(F.concat(F.lit(MINUS), text))


def pct(value: Column) -> Column:
    text = F.concat(F.format_number(F.abs(value), 2), F.lit("%"))
    # No thousands separators in percentages.
    text = F.replace(text, F.lit(","), F.lit(""))
    return F.when(value >= 0, F.concat(F.lit("+"), text)).otherwise(
        F.concat(F.lit(MINUS), text)
    )


def split_reasons(text: Column) -> Column:
    """Reason text to an array without blanks."""
    parts = F.split(F.coalesce(text, F.lit("")), r" \| ")
    return F.filter(F.transform(parts, F.trim), lambda part: part != "")


def reason_texts(reasons: Column) -> Column:
    """Drop the leading ``CODE: `` of every reason."""
    return F.transform(
        reasons,
        lambda r: F.when(F.locate(": ", r) > 0, F.substring(r, F.locate(": ", r) + 2, F.length(r)))
        .otherwise(r),
    )


def sentence_list(parts: Column) -> Column:
    """``a``, ``a and b``, ``a, b and c``; empty text for no parts."""
    head = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), ", ")
    return F.when(F.size(parts) <= 1, F.array_join(parts, "")).otherwise(
        F.concat(head, F.lit(" and "), F.element_at(parts, -1))
    )


def counted(number: Column, singular: str, plural: str) -> Column:
    """``1,234 rows were`` style phrase."""
    noun = F.when(number == 1, F.lit(singular)).otherwise(F.lit(plural))
    return F.concat(F.format_string("%,d", number), F.lit(" "), noun)


def numbers(text: Column) -> Column:
    """Number tokens of a text, in order."""
    return F.regexp_extract_all(text, F.lit(r"\d[\d,]*(?:\.\d+)?"), F.lit(0))
