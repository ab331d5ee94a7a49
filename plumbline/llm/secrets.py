"""Operator 9: secret scans by assignment-aware lexing.

Base patterns find assignments to sensitive names, access keys and long hexadecimal runs. Beyond
them, source code and configuration are lexed into name-literal pairs (``name = "x"``, ``"name": 'x'``,
``name => x``, ``<name>x</name>``, ``export NAME=x``), constants are propagated (``password = KEY`` makes
the literal of ``KEY`` a password), adjacent and added literals are taken together, and a literal is
scored by how sensitive its target names are and how random it looks.

Every text is scanned whole in the task that reads it; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import shipped

#: The base patterns and least lengths of the contract, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of ``[0-9a-f]+``; the leftmost match of at least the least length is always a whole run.
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "literal")

#: Sensitivity of the parts of a name (1 certain, below 1 needs a more random literal).
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "passcode": 0.9, "secret": 1.0, "secretkey": 1.0,
    "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "authtoken": 1.0, "accesstoken": 1.0, "token": 0.9, "credential": 0.9,
    "credentials": 0.9, "bearer": 0.8, "signingkey": 1.0, "encryptionkey": 1.0, "clientsecret": 1.0, "auth": 0.5, "salt": 0.4,
}
#: Texts without any of these, separators within names left out, have no sensitive name.
_HINTS = ("pass", "pwd", "secret", "apikey", "accesskey", "privatekey", "token", "credential", "bearer", "signing", "encryption", "auth", "salt")
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|change_?me.*|your[_-].*|example.*|test|dummy|none|null|true|false|undefined|todo|redacted)$")
LEAST_LITERAL = 8
THRESHOLD = 1.0

_STRING = r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`"""
_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*"
#: A type between a name and ``=``; before a bare value it needs a blank behind it, as ``a: b=c`` may be one value.
_TYPE = rf""":(?!:)[\x20\t]*(?:&(?:'[a-z]+[\x20\t]+)?)?[A-Za-z_][\w.\[\]|<>,?\x20\t]{{0,60}}?(?:[\x20\t]+(?==(?!=))|(?==[\x20\t]*["'`]))"""
#: name, type if any, separator, then strings (adjacent or added) or one bare word.
_PAIR = re.compile(
    rf"""(?<![A-Za-z0-9_.\-])({_NAME})["'`]?\]?[\x20\t]*(?:{_TYPE})?(?::=|=>|=(?!=)|:(?!:))[\x20\t]*(?:((?:{_STRING})(?:[\x20\t]*\+?[\x20\t]*(?:{_STRING}))*)|([^\s"'`,;<>()\[\]{{}}]+))"""
)
_ELEMENT = re.compile(rf"<({_NAME})>([^<>\n]+)</\1>")
_PIECE = re.compile(_STRING)
_BARE_NAME = re.compile(rf"{_NAME}\Z")
_LINE_HEAD = re.compile(r"[\x20\t]*(?:(?:export|set|const|let|var|final|static|public|private|String|str|ENV|-)[\x20\t]+)*[\x20\t\"'\-]*\Z")


def sensitivity(name: str) -> float:
    """Of a target name: the most sensitive of its parts, single or two in a row."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    parts = [p for p in re.split(r"[_.\-]+", spaced.lower()) if p]
    pairs = [a + b for a, b in zip(parts, parts[1:], strict=False)]
    return max((SENSITIVE.get(p, 0.0) for p in (*parts, *pairs, "".join(parts))), default=0.0)


def randomness(literal: str) -> float:
    """0 to 1: bits of character entropy over the whole literal, 48 or more count as 1; 0 for placeholders and prose."""
    if len(literal) < LEAST_LITERAL or PLACEHOLDER.match(literal) or re.search(r"\s", literal):
        return 0.0
    n = len(literal)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(literal).values()) * n
    mixed = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, bits / 48) if mixed >= 2 else min(1.0, bits / 96)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns: leftmost, non-overlapping for each kind, short ones dropped."""
    found = []
    low = text.lower()
    if any(n in low for n in ("passw", "secret", "token", "api")):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), "hex", m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def pairs(text: str) -> Iterator[tuple[str, list[tuple[int, int]] | str]]:
    """(name, literal spans without quotes) or (name, other name) for each assignment of the text."""
    for m in _PAIR.finditer(text):
        if m[2] is not None:
            yield m[1], [(m.start(2) + s.start() + 1, m.start(2) + s.end() - 1) for s in _PIECE.finditer(m[2])]
            continue
        head = text[text.rfind("\n", 0, m.start()) + 1 : m.start()] if m.start() else ""
        if not _LINE_HEAD.match(head):
            # A bare value in the middle of a line is prose, but among arguments or entries a name may be meant.
            if head.rstrip(" \t\"'`")[-1:] in "([{," and (given := _BARE_NAME.match(m[3].rpartition("=")[2])):
                yield m[1], given[0]
            continue
        if (given := _BARE_NAME.match(m[3])):
            yield m[1], given[0]
        tail = text[m.end(3) : m.end(3) + 200].split("\n", 1)[0]
        if not tail.strip(" \t\r,;"):
            yield m[1], [(m.start(3), m.end(3))]
    for m in _ELEMENT.finditer(text):
        yield m[1], [(m.start(2), m.end(2))]


def literal_spans(text: str) -> set[tuple[int, int]]:
    """Literals that a sensitive name holds, directly or through other names."""
    bound: dict[str, list[list[tuple[int, int]]]] = defaultdict(list)
    refers: dict[str, set[str]] = defaultdict(set)
    targets = []
    for name, value in pairs(text):
        if sensitivity(name) > 0:
            targets.append(name)
        if isinstance(value, str):
            refers[name].add(value)
        else:
            bound[name].append(value)
    found: set[tuple[int, int]] = set()
    for target in dict.fromkeys(targets):
        weight, seen, todo = sensitivity(target), {target}, [target]
        while todo:  # what the name stands for, through any number of names
            name = todo.pop()
            for spans in bound[name]:
                literal = "".join(text[a:b] for a, b in spans)
                if weight + randomness(literal) > THRESHOLD and randomness(literal) > 0.5:
                    found.update(s for s in spans if s[1] > s[0])
            new = refers[name] - seen
            seen |= new
            todo += new
    return found


def scan_text(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Base spans, and base spans with those of the method, both by start and kind."""
    base = base_spans(text)
    bare = text.lower().replace("_", "").replace(".", "").replace("-", "")
    if not any(h in bare for h in _HINTS):
        return base, base
    inside = [(s, e) for s, _, e in base]
    more = [(s, "literal", e) for s, e in literal_spans(text) if not any(a <= s and e <= b for a, b in inside)]
    return base, sorted({*base, *more}, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def _join(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Positions are code points, ends exclusive. NULL and empty texts have no span and the digest of
    an empty string. Repeated rows keep one row each; an empty table gives no rows; other columns
    are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS[:3]}
            digests, spans = [], []
            for value in batch.column(1):
                base, every = scan_text(value.as_py() or "")
                kinds = Counter(k for _, k, _ in base)
                for k, column in counts.items():
                    column.append(kinds[k])
                digests.append(hashlib.sha256(_join(base).encode()).hexdigest())
                spans.append(_join(every))
            columns = [pa.array(counts[k], pa.int64()) for k in KINDS[:3]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(rows, schema)


shipped(__name__)
