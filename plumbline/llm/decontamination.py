"""Operator 5: benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question that was asked again with other
values keeps its template. Windows of template tokens are hash-joined to those of the benchmark.
For documents with enough matching windows the values behind the placeholders are compared: within
one occurrence a benchmark value must always stand for the same document value, and windows that
break this do not count. Windows of the plain tokens are joined as well, so what was copied word for word
counts whatever it consists of, and windows in which every capitalised word is a name, as a name may start
a sentence. A document is contaminated if the remaining windows cover enough of an item.

Everything is built-in string and array functions, joins and aggregates. A text is marked once and every
token hashed once; windows are combined hashes, exploded and filtered against the benchmark's windows
before anything is shuffled. Only matches, narrow rows, are grouped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import joined_small, small, written

WINDOW = 5
#: Share of an item's tokens that consistent windows must cover.
COVER = 0.8
#: Literal tokens that a window of template tokens needs, so that placeholders alone never match.
MIN_LITERALS = 3
#: Items of fewer tokens are found as whole lines or sentences instead of anywhere.
MIN_TOKENS = 3
#: Matches of one occurrence lie in a band of shifts of this width, or follow each other within this many lengths
#: of the item. Plain windows count together wherever they stand in a text.
BAND = 8
GAP_LENGTHS = 2
#: The benchmark's distinct window hashes are broadcast up to this size, else joined by shuffle.
HASH_BYTES = 128 << 20

#: Units of measure that may follow a number.
UNITS = (
    "mm cm dm km m mi miles mile feet foot ft inch inches yards yard mg g kg t tons ton tonnes lb lbs pounds ounces oz "
    "ml cl l litres litre liters liter gallons gallon s sec seconds second min mins minutes minute h hr hrs hours hour days day "
    "weeks week months month years year kmh mph hz khz mhz ghz w kw mw kwh j kj cal kcal v a k c f percent degrees degree "
    "dollars dollar usd euros euro eur cents pounds kb mb gb tb bytes bits"
).split()
#: Placeholders. Before a token stands NAME if it is a name within a sentence, START if it is another
#: capitalised word or a number.
NAME, NUMBER, UNIT, START = "\u0001", "\u0002", "\u0003", "\u0004"
_SIGNS = NAME + NUMBER + UNIT + START
#: Kinds of windows.
_PLAIN, _TEMPLATE = 0, 1


def signed_tokens(text: Column) -> Column:
    """Tokens in lower case; names, numbers and other capitalised words carry a sign in front.

    A name is a capitalised word after a lower-case letter, digit or comma and a blank, that is, not
    at the start of a sentence. A number may hold points and commas between its digits. Patterns begin with
    what is rare, so that most characters are passed over at the first look.
    """
    out = F.coalesce(text, F.lit(""))
    foreign = out.contains(_SIGNS[0]) | out.contains(_SIGNS[1]) | out.contains(_SIGNS[2]) | out.contains(_SIGNS[3])
    out = F.when(foreign, F.translate(out, _SIGNS, " " * len(_SIGNS))).otherwise(out)
    capital, number = r"(?=\p{Lu})(?<![\p{L}\p{M}\p{N}])(?=\p{Lu}\p{Ll})", r"(?=[0-9])(?<![\p{L}\p{M}\p{N}.,])"
    out = F.regexp_replace(out, f"{capital}|{number}", START)
    out = F.regexp_replace(out, rf"{START}(?=\p{{Lu}})(?<=[\p{{Ll}}\p{{N}},;)][ \t\n]{START})", NAME)
    word = r"[\p{L}\p{M}\p{N}]++"
    return F.regexp_extract_all(F.lower(out), F.lit(f"[{NAME}{START}]?{word}(?:(?<=[0-9])[.,](?=[0-9]){word})*+"), F.lit(0))


def _plain(token: Column) -> Column:
    return F.when(token < "\u0005", F.substring(token, 2, 1 << 30)).otherwise(token)


def _is_number(token: Column) -> Column:
    return token.between(START + "0", START + ":")


def _forms(of: str, value: Callable[[Column], Column]) -> dict[str, Callable[[], Column]]:
    """The plain form w of the signed tokens ``of`` and the template forms t and t2, one for one, each from
    the one before it. ``value`` is taken of every token: the token itself or its hash. In t2 every capitalised
    word is a name.
    """

    def unit(x: Column, i: Column) -> Column:
        return F.coalesce(_is_number(F.get(of, i - 1)), F.lit(False)) & x.isin(*UNITS)

    def first(x: Column, i: Column) -> Column:
        name = F.when(x < "\u0002", value(F.lit(NAME))).when(_is_number(x), value(F.lit(NUMBER)))
        return F.when(x < "\u0005", name.otherwise(F.get("w", i))).when(unit(x, i), value(F.lit(UNIT))).otherwise(F.get("w", i))

    def second(x: Column, i: Column) -> Column:
        return F.when((x < "\u0005") & ~_is_number(x), value(F.lit(NAME))).otherwise(F.get("t", i))

    return {
        "w": lambda: F.transform(of, lambda x: value(_plain(x))),
        "t": lambda: F.transform(of, first),
        "t2": lambda: F.transform(of, second),
    }


def _with_forms(rows: DataFrame, of: str, value: Callable[[Column], Column]) -> DataFrame:
    for name, form in _forms(of, value).items():
        rows = rows.withColumn(name, form())
    return rows


def _literal(token: Column) -> Column:
    return ~token.isin(NAME, NUMBER, UNIT)


def _parsed(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``w`` (plain tokens), ``t`` and ``t2`` (template tokens), one for one."""
    return _with_forms(rows.withColumn("_v", signed_tokens(F.col(text))), "_v", lambda x: x).drop("_v")


def _starts(tokens: str, n: int) -> Column:
    """Positions of all windows of ``n`` tokens."""
    none = F.array().cast("array<int>")
    return F.when(F.size(tokens) >= n, F.sequence(F.lit(0), F.size(tokens) - n)).otherwise(none)


def _combined(kind: Column, hashes: list[Column]) -> Column:
    return F.xxhash64(kind, *hashes)


def _window_hashes(hashed: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, h): the hashes of all windows of each length, from the token hashes w, t and t2.

    A row for each position first: higher-order functions over whole texts are interpreted, plain expressions
    of a row are compiled. Template windows that equal the plain one hold no placeholder, and no item has such a
    window; those of t2 that equal that of t are the same window.
    """
    # The outer form: for the inner one the optimizer filters empty arrays first, by computing them a second time.
    rows = hashed.select("key", "w", "t", "t2", F.posexplode_outer("w").alias("_i", "_w0"))
    ahead = range(max(lengths))
    seen = [F.get(form, F.col("_i") + k).alias(f"_{form}_{k}") for form in ("w", "t", "t2") for k in ahead]
    rows = rows.select("key", *seen)

    def window(form: str, kind: int, n: int, other: str | None = None) -> Column:
        whole = F.col(f"_w_{n - 1}").isNotNull()
        if other:
            whole &= reduce(or_, [F.col(f"_{form}_{k}") != F.col(f"_{other}_{k}") for k in range(n)])
        return F.when(whole, _combined(F.lit(kind), [F.col(f"_{form}_{k}") for k in range(n)]))

    forms = [("w", _PLAIN, None), ("t", _TEMPLATE, "w"), ("t2", _TEMPLATE, "t")]
    hashes = [window(form, kind, n, other) for n in lengths for form, kind, other in forms]
    return rows.select("key", F.explode_outer(F.array(*hashes)).alias("h"))


def _window_rows(rows: DataFrame, n: int) -> DataFrame:
    """A row for each window of ``n`` tokens: kind, ``pos``, ``m`` (tokens to match) and ``v`` (plain tokens)."""

    def of(tokens: str, kind: int) -> Column:
        def one(i: Column) -> Column:
            return F.struct(F.lit(kind).alias("kind"), i.alias("pos"), F.slice(tokens, i + 1, n).alias("m"), F.slice("w", i + 1, n).alias("v"))

        return F.transform(_starts(tokens, n), one)

    # Windows are cut inside their row: an exploded row holds a window, never the whole text again.
    kept = [c for c in rows.columns if c not in ("w", "t", "t2")]
    windows = rows.select(*kept, F.concat(of("w", _PLAIN), of("t", _TEMPLATE), of("t2", _TEMPLATE)).alias("_windows"))
    return windows.select(*kept, F.inline_outer("_windows")).filter("pos is not null")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, n, length, ipos, kind, h, m, v): windows of each distinct item text, of plain and of template tokens.

    ``item`` is the md5 of the text, ``length`` its tokens, ``n`` the window's, smaller only for items shorter
    than a window. ``m`` are the tokens to match and ``v`` the plain ones. Windows of template tokens have a
    placeholder and enough literals; windows of plain tokens consist of whatever the item does.
    """
    texts = benchmark.select(F.col("text").cast("string").alias("text")).distinct().withColumn("item", F.md5("text"))
    parsed = _parsed(texts.filter(F.col("text").isNotNull()), "text").drop("text").withColumn("length", F.size("w"))
    literals = F.size(F.filter("m", _literal))
    out = None
    for n in range(MIN_TOKENS, window + 1):
        own = F.col("length") == n if n < window else F.col("length") >= n
        rows = _window_rows(parsed.filter(own), n).withColumn("n", F.lit(n))
        rows = rows.filter((F.col("kind") == _PLAIN) | (literals.between(MIN_LITERALS, n - 1)))
        rows = rows.withColumn("h", _combined(F.col("kind"), [F.xxhash64(F.get("m", F.lit(k))) for k in range(n)]))
        out = rows if out is None else out.unionByName(rows)
    return out.select("item", "n", "length", F.col("pos").alias("ipos"), "kind", "h", "m", "v").dropDuplicates(["item", "ipos", "kind", "m"])


def short_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(body, item, coverage): items of one or two tokens in texts that hold them as a whole line or sentence."""
    given = benchmark.select(F.col("text").cast("string").alias("text")).distinct()
    form = F.array_join(F.transform(signed_tokens(F.col("text")), _plain), " ")
    few = given.withColumn("form", form).filter((F.size(F.split("form", " ")) < MIN_TOKENS) & (F.col("form") != ""))
    items = written(few.select("form", F.md5("text").alias("item")), "short-items")
    if not items.limit(1).count():
        return items.select(F.col("item").alias("body"), "item", F.lit(1.0).alias("coverage"))
    lines = docs.select(F.md5("text").alias("body"), F.explode_outer(F.split("text", r"[\n\r]+|[.!?;:]+(?=\s|$)")).alias("text"))
    said = lines.select("body", form.alias("form"))
    return joined_small(said, items, "form", "inner", small(items, "form")).select("body", "item", F.lit(1.0).alias("coverage")).distinct()


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """(body, item_id, coverage): contaminated texts by their md5, with the items they hold.

    ``coverage`` is the share of the item's tokens that slot-consistent windows of one occurrence cover.
    """
    items = written(benchmark_windows(benchmark, window), "windows")
    # At most ``window`` lengths occur: the full one and those of shorter items.
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    named = benchmark.select(F.md5(F.col("text").cast("string")).alias("item"), "item_id").distinct()
    found = short_items(texts, benchmark)
    if lengths:
        found = found.unionByName(_occurrences(texts, items, lengths, cover))
    found = found.groupBy("body", "item").agg(F.max("coverage").alias("coverage"))
    return joined_small(found, named, "item", "inner", small(named, "item")).select("body", "item_id", "coverage")


def _candidates(texts: DataFrame, items: DataFrame, lengths: list[int], cover: float) -> DataFrame:
    """(key, item): texts, by hash, that share enough windows with an item."""
    signed = texts.select(F.xxhash64("text").alias("key"), signed_tokens(F.col("text")).alias("v"))
    hashed = _with_forms(signed, "v", F.xxhash64)
    windows = _window_hashes(hashed, lengths)
    wanted = items.select("h").distinct()
    hit = joined_small(windows, wanted, "h", "left_semi", small(wanted, limit=HASH_BYTES)).distinct()
    own = items.select("h", "item", "ipos", "n", "length")
    shared = joined_small(hit, own, "h", "inner", small(own, "item", limit=HASH_BYTES)).groupBy("key", "item")
    shared = shared.agg(F.countDistinct("ipos").alias("hits"), F.min("n").alias("n"), F.min("length").alias("length"))
    # Windows of n tokens must be at least this many to cover the share.
    return written(shared.filter(F.col("hits") * F.col("n") >= cover * F.col("length")).select("key", "item"), "candidates")


def _matches(texts: DataFrame, items: DataFrame, enough: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, item, length, n, kind, dpos, ipos, slots): equal windows of candidates, token for token.

    ``slots`` names for each placeholder the benchmark's value and the document's.
    """
    few = enough.select("key").distinct()
    keyed = texts.select(F.xxhash64("text").alias("key"), "text")
    # Copies are verified once.
    bodies = _parsed(joined_small(keyed, few, "key", "left_semi", small(few)).distinct(), "text").drop("text")
    fits, pairs_fit = small(items, "m", "v", "item", limit=HASH_BYTES), small(enough, "item")
    slots = F.filter(F.arrays_zip("m", "v", "dv"), lambda s: ~_literal(s["m"]))
    slots = F.transform(slots, lambda s: F.struct(F.concat(s["m"], s["v"]).alias("slot"), s["dv"].alias("value")))
    out = None
    for n in lengths:
        places = _window_rows(bodies, n).select("key", "kind", F.col("pos").alias("dpos"), "m", F.col("v").alias("dv"))
        own = items.filter(F.col("n") == n).drop("h")
        placed = joined_small(joined_small(places, own, ["kind", "m"], "inner", fits), enough, ["key", "item"], "left_semi", pairs_fit)
        rows = placed.select("key", "item", "length", "n", "kind", "dpos", "ipos", slots.alias("slots")).dropDuplicates(["key", "item", "kind", "dpos", "ipos", "slots"])
        out = rows if out is None else out.unionByName(rows)
    return written(out, "matches")


def _occurrences(texts: DataFrame, items: DataFrame, lengths: list[int], cover: float) -> DataFrame:
    """(body, item, coverage) of what sound windows of one occurrence cover.

    Three views of what belongs to one occurrence: a band of shifts (inserted or left-out tokens, other
    matches beside it), an island of matches (any number of inserted runs), and, for plain windows, the text.
    """
    enough = _candidates(texts, items, lengths, cover)
    matched = _matches(texts, items, enough, lengths)
    inside = Window.partitionBy("key", "item").orderBy("dpos", "ipos")
    apart = F.coalesce(F.col("dpos") - F.lag("dpos").over(inside) > GAP_LENGTHS * F.col("length"), F.lit(False))
    islands = matched.withColumn("_new", apart.cast("int")).withColumn("island", F.sum("_new").over(inside))
    shift = F.col("dpos") - F.col("ipos")
    # A view and its number in one integer: bands by shift, islands, and the text for plain windows.
    views = [(F.floor((shift + half * BAND / 2) / BAND) * 2 + half) * 4 for half in (0, 1)]
    views += [F.col("island") * 4 + 1, F.when(F.col("kind") == _PLAIN, F.lit(2))]
    seen = F.array_compact(F.array(*[v.cast("bigint") for v in views]))
    spread = islands.withColumn("seen", F.explode(seen)).select("key", "item", "seen", "length", "n", "dpos", "ipos", "slots")

    # Slots: what each benchmark value stands for, by majority within the occurrence.
    occurrence = ["key", "item", "seen"]
    open_rows = spread.filter(F.size("slots") > 0)
    filled = open_rows.select(*occurrence, "dpos", "ipos", F.inline("slots"))
    votes = filled.groupBy(*occurrence, "slot", "value").agg(F.count(F.lit(1)).alias("n"))
    chosen = votes.groupBy(*occurrence, "slot").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("choice"))
    broken = filled.join(chosen, [*occurrence, "slot"]).filter("value != choice").select(*occurrence, "dpos", "ipos").distinct()
    columns = [*occurrence, "length", "n", "ipos"]
    sound = spread.filter(F.size("slots") == 0).select(columns).unionByName(open_rows.join(broken, [*occurrence, "dpos", "ipos"], "left_anti").select(columns))

    # Coverage of the item by sound windows of one occurrence; an item's length bounds its positions.
    places = sound.groupBy(*occurrence).agg(F.array_sort(F.collect_set("ipos")).alias("at"), F.min("length").alias("length"), F.min("n").alias("n"))
    steps = F.transform("at", lambda p, k: F.least(F.col("n"), F.coalesce(F.get("at", k + 1) - p, F.col("n"))))
    coverage = F.aggregate(steps, F.lit(0), lambda total, x: total + x) / F.col("length")
    shares = places.select("key", "item", coverage.alias("coverage")).filter(F.col("coverage") >= cover)
    best = shares.groupBy("key", "item").agg(F.max("coverage").alias("coverage"))
    # Back from the hash to the texts, once each.
    held = texts.select(F.xxhash64("text").alias("key"), F.md5("text").alias("body"))
    named = joined_small(held, best, "key", "inner", small(best, "item"))
    return named.select("body", "item", "coverage").distinct()


def mark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """One row for each row of ``docs``: doc_id, contaminated, items (ascending ids, comma-joined), coverage.

    NULL, empty and word-less texts are clean. Texts decide, so repeated rows and rows with a NULL
    doc_id are judged like any other. Items with NULL or word-less texts match nothing, those with a NULL
    item_id mark a text without being listed; an empty benchmark leaves all documents clean; an empty table
    gives no rows; other columns are ignored.
    """
    found = written(find(docs, benchmark, window, cover), "contaminated")
    hits = found.groupBy("body").agg(F.array_sort(F.collect_set("item_id")).alias("ids"), F.max("coverage").alias("coverage"))
    keyed = docs.select("doc_id", F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("body"))
    out = joined_small(keyed, hits, "body", "left", small(hits, "ids"))
    items = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    return out.select("doc_id", F.col("ids").isNotNull().alias("contaminated"), F.coalesce(items, F.lit("")).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, cover: float = COVER) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns; NULL and empty texts stay."""
    bad = written(find(docs, benchmark, window, cover).select(F.col("body").alias("_body")).distinct(), "contaminated")
    body = F.md5(F.coalesce(docs["text"].cast("string"), F.lit("")))
    right = F.broadcast(bad) if small(bad, "_body") else bad
    return docs.join(right, body == bad["_body"], "left_anti")
