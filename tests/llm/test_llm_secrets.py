from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.support import AWKWARD, documents, prose

from plumbline.llm import secrets

EITHER = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(rf"""({EITHER}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
HEXA = "24be64439e3e49cf46b2d7c90f3602a3"


def brute(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


TEXTS = [
    f'é token = "{HEXA}"', f"PassWord:{HEXA}", "secret=token=abcdefghijklmnop", "secret: token = 'abcdefghijklmnop'", f"AKIA{'A7' * 8}", f"AKIAAKIA{'9' * 8}",
    "ſecret=aaaaaaaaaaaaaaaa toKen=aaaaaaaaaaaaaaaa", "api_key  =  'AAAABBBBCCCCDDDD' apikey:short", HEXA.upper(), HEXA[:15], HEXA[:16] + "g" + HEXA,
]


def test_base_equals_brute_force(spark, awkward, no_documents):
    rows = [(100 + k, t, None) for k, t in enumerate(TEXTS)]
    for docs, given_rows in ((documents(spark, rows), rows), (awkward, AWKWARD)):
        want = Counter()
        for i, t, _ in given_rows:
            spans = brute(t)
            n = Counter(k for _, _, k, _ in spans)
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()
            want[(i, n["assign"], n["access"], n["hex"], digest)] += 1
        assert Counter(tuple(r)[:5] for r in secrets.scan(docs).collect()) == want
    assert secrets.scan(no_documents).count() == 0


@given(st.text(alphabet="apikey_tokensecret=: '\"0123456789abcdefAKIAſK\n-", max_size=80))
@settings(max_examples=300, deadline=None)
def test_base_spans_of_any_text(text):
    assert secrets.base_spans(text) == [(a, k, b) for a, _, k, b in brute(text)]


def literals(text):
    return [text[a:b] for a, k, b in secrets.scan_text(text)[1] if k == "literal"]


GOOD = "Xk9#mQ2$vL7!pR4z"


@pytest.mark.parametrize(
    ("text", "found"),
    [
        (f'db_password = "{GOOD}"', [GOOD]),
        (f"client-secret => '{GOOD}'", [GOOD]),
        (f'{{"clientSecret": "{GOOD}"}}', [GOOD]),
        (f"<passphrase>{GOOD}</passphrase>", [GOOD]),
        (f"export DB_PWD={GOOD}\n", [GOOD]),
        (f'KEY = "{GOOD}"\nOTHER = KEY\nconnect(password=1)\npassword = OTHER\n', [GOOD]),
        ('signing_key = "Xk9#mQ2$" + "vL7!pR4z"', ["Xk9#mQ2$", "vL7!pR4z"]),
        (f'title = "{GOOD}"', []),
        ('password = "changeme"', []),
        ('password = "${DB_PASSWORD}"', []),
        ('author = "A long name of one"', []),
        ("We discuss the password: it must never be written down, and the token as well.", []),
        (f"in the middle of a line the passphrase: {GOOD} is prose", []),
    ],
)
def test_assignments(text, found):
    assert literals(text) == found


def test_cyclic_constants_end():
    assert literals("a = b\nb = a\npassword = a\n") == []


def test_prose_has_no_span_and_long_runs_are_fast(spark):
    text = prose(1, 2000) + " token " + "a.b_" * 50_000 + " password" + " " * 50_000
    assert secrets.scan_text(text) == ([], [])


def test_dotted_names_types_and_arguments():
    from plumbline.llm.secrets import scan_text

    secret = "h7Gk2pQz9LmX"
    for text in (
        f"stripe.api.key={secret}", f"my.access.key = {secret}", f'password: str = "{secret}"', f'const apiKey: string = "{secret}";',
        f'let password: &str = "{secret}";', f'password: Optional[str]="{secret}"', f'DB_PW = "{secret}"\nconnect(user, password=DB_PW)',
        f'DB_PW = "{secret}"\nopts = {{"password": DB_PW}}', f'DB_PW = "{secret}"\ndef f(password: str=DB_PW): pass',
    ):
        at = text.index(secret)
        assert [s for s in scan_text(text)[1] if s[0] <= at and s[2] >= at + len(secret)], text
    assert scan_text('password: foo=bar1')[1] == [] and scan_text(f'name: str = "{secret}" # no password')[1] == []
