from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from tests.llm.support import AWKWARD, documents

from plumbline.llm import spelling


def brute_words(rows):
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_groups(words):
    near = {w: [x for x in words if is_near(w, x)] for w in words}
    best = {w: min(xs, key=lambda x: (-words[x], x), default=None) for w, xs in near.items()}
    form = {w: x if x is not None and words[x] >= 5 * words[w] else None for w, x in best.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return Counter((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def invented(seed, n, letters="abé", lengths=(6, 10)):
    rng = random.Random(seed)
    return {"".join(rng.choices(letters, k=rng.randint(*lengths))): rng.choice([5, 6, 26, 30, 131, 800]) for _ in range(n)}


@pytest.mark.parametrize("letters", ["ab", "abé", "abcdefghij"])
def test_groups_against_all_pairs(spark, letters):
    words = invented(len(letters), 250, letters)
    for k, w in enumerate(list(words)[:60]):  # edits at every kind of place
        at = k % (len(w) + 1)
        for edited in (w[:at] + "b" + w[at:], w[:at] + w[at + 1 :], w[:at] + "é" + w[at + 1 :]):
            if len(edited) >= 6:
                words.setdefault(edited, 5 + k % 3)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = Counter(map(tuple, spelling.group(df).collect()))
    assert got == brute_groups(words)
    assert any(r[2] != r[0] for r in got)


def test_pivots_of_near_words_always_meet_a_prefix():
    rng = random.Random(8)
    for _ in range(3000):
        w = "".join(rng.choices("abc", k=rng.randint(6, 9)))
        at = rng.randrange(len(w))
        v = rng.choice([w[:at] + rng.choice("abc") + w[at:], w[:at] + rng.choice("abc") + w[at + 1 :]])
        order = {"".join(g): k for k, g in enumerate(rng.sample(list(itertools.product("abc", repeat=2)), 9))}

        def meets(x, y):
            own = spelling.own_stands(y, spelling.signature(y, order)[0])
            return not set(own).isdisjoint(spelling.stands(x, spelling.signature(x, order)[1]))

        assert meets(w, v) or meets(v, w)


def test_pivots_are_the_cheapest_disjoint_grams():
    rng = random.Random(5)
    for _ in range(500):
        places = sorted(rng.sample(range(12), rng.randint(3, 7)))
        cost = [rng.randint(1, 9) for _ in places]
        pairs = [(cost[i] + cost[j], i, j) for i in range(len(places)) for j in range(i) if places[i] - places[j] >= 2]
        chosen = spelling.disjoint(places, cost)
        assert places[chosen[1]] - places[chosen[0]] >= 2
        assert sum(cost[k] for k in chosen) == min(pairs)[0]


def test_documents(spark, awkward, no_documents):
    rows = [*AWKWARD, *[(k, "Spelling spelling spellin' Größe Größen grössen ÀÉÎÕÜý ×÷×÷×÷ " * (1 + k % 3), None) for k in range(400)]]
    rows += [(None, "spelling " * 3, None), (999, "speling " * 7, None), (1000, "x" * 50_000 + " " + "x" * 49_999, "a")]
    want = brute_groups(brute_words(rows))
    assert Counter(map(tuple, spelling.variants(documents(spark, rows).repartition(5)).collect())) == want
    assert any(form == "spelling" for _, form, *_ in want)
    assert spelling.variants(no_documents).count() == 0


def test_counts_do_not_depend_on_what_a_task_holds(spark, monkeypatch):
    rows = [(k, " ".join(invented(k, 40)), None) for k in range(30)] * 5
    df = documents(spark, rows)
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    assert {r.word: r.n for r in spelling.count_words(df).collect()} == brute_words(rows)
