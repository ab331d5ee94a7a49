from __future__ import annotations

import random
from collections import Counter, defaultdict

import regex
from pyspark.sql import functions as F
from tests.llm.support import AWKWARD, documents, prose

from plumbline.llm import decontamination as dc

QUESTION = (
    "A baker called Maria bought 12 kg of flour in Lyon and gave 3 kg to Pierre, then sold 5 kg for 20 euros each week "
    "until the whole stock was gone and she counted how many weeks that took"
)
OTHER = (
    "A baker called Olga bought 40 lbs of flour in Oslo and gave 9 lbs to Sven, then sold 7 lbs for 31 dollars each week "
    "until the whole stock was gone and she counted how many weeks that took"
)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def marked(spark, docs, items):
    return {r.doc_id: (r.contaminated, r["items"]) for r in dc.mark(documents(spark, docs), bench(spark, items)).collect()}


def test_templates(spark):
    text = spark.createDataFrame([("He paid 3.50 euros to Anna Berg. Later, 7 km on; N2 is 1,000.",)], "text string")
    signed = text.select(dc.signed_tokens(text["text"]).alias("_v"))
    row = dc._with_forms(signed, "_v", lambda x: x).first()
    n, u, m, s = dc.NUMBER, dc.UNIT, dc.NAME, dc.START
    assert row["_v"] == [s + "he", "paid", s + "3.50", "euros", "to", m + "anna", m + "berg", s + "later", s + "7", "km", "on", "n2", "is", s + "1,000"]
    assert row.w == ["he", "paid", "3.50", "euros", "to", "anna", "berg", "later", "7", "km", "on", "n2", "is", "1,000"]
    assert row.t == ["he", "paid", n, u, "to", m, m, "later", n, u, "on", "n2", "is", n]
    assert row.t2 == [m, "paid", n, u, "to", m, m, m, n, u, "on", "n2", "is", n]


def test_exact_edited_and_reparameterised_items_are_found(spark):
    items = [(1, QUESTION), (2, prose(2, 40)), (3, None), (4, ""), (5, "12 kg 3 kg 5 kg"), (6, prose(6, 4))]
    around = prose(77, 90)
    docs = [
        (10, f"{around}\n{QUESTION}\n{around}", None),
        (11, f"{around} {OTHER} {around}", None),
        (12, prose(2, 40).upper().replace(" ", ",  "), None),
        (13, " ".join(w for k, w in enumerate(prose(2, 40).split()) if k != 20), None),  # one word left out
        (14, " ".join(prose(2, 40).split()[:20]) + " " + prose(99, 40), None),  # half an item
        (15, "12 kg 3 kg 5 kg and 12 kg 3 kg 5 kg", None),
        (16, prose(6, 4), None),
        (17, around, None),
        (18, f"{QUESTION} {prose(2, 40)}", None),
    ]
    assert marked(spark, docs, items) == {
        10: (True, "1"), 11: (True, "1"), 12: (True, "2"), 13: (True, "2"), 14: (False, ""), 15: (True, "5"), 16: (True, "6"), 17: (False, ""),
        18: (True, "1,2"),
    }


def test_inconsistent_slots_do_not_count(spark):
    item = " ".join(f"the value of Xena here is {1} now and the {w} of Xena stays at {1} again" for w in ("cost", "price", "rate"))
    sound = item.replace("Xena", "Yuri").replace(" 1 ", " 8 ")
    mixed = item
    for k in range(6):
        mixed = mixed.replace("Xena", f"Name{'abcdef'[k]}", 1).replace(" 1 ", f" {k + 20} ", 1)
    assert marked(spark, [(1, sound, None), (2, mixed, None)], [(1, item)]) == {1: (True, "1"), 2: (False, "")}


def test_awkward_rows(spark, awkward, no_documents):
    items = bench(spark, [(1, prose(7, 80)), (2, None), (3, prose(5, 60))])
    got = Counter((r.doc_id, r["items"]) for r in dc.mark(awkward, items).collect())
    found = {prose(7, 80): "1", prose(5, 60): "3"}
    assert got == Counter((i, found.get(t, "")) for i, t, _ in AWKWARD)
    kept = dc.clean(awkward, items)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, t, _ in AWKWARD if t not in found)
    assert dc.mark(no_documents, items).count() == 0
    assert dc.clean(awkward, items.limit(0)).count() == len(AWKWARD)


def test_one_item_in_many_documents(spark):
    docs = [(k, f"{prose(k, 30)} {QUESTION} {prose(k + 500, 30)}", None) for k in range(150)]
    got = marked(spark, docs, [(1, QUESTION), (2, OTHER)])
    assert all(v == (True, "1,2") for v in got.values())


def test_items_with_inserted_runs(spark):
    item = prose(2, 40).split()
    docs = [(k * 100 + at, " ".join([prose(77, at + 1), *item[:20], prose(88, k), *item[20:], prose(99, 30)]), None) for k in (5, 8, 25, 60, 700) for at in range(8)]
    got = marked(spark, docs, [(1, " ".join(item))])
    assert all(v == (True, "1") for v in got.values()) and len(got) == 40


def test_items_of_numbers_and_names_copied_word_for_word(spark):
    short, listed = "What is 12 + 35 + 48 + 19 + 77?", f"{prose(1, 9)} 3 8 1 9 4 7 2 6 5 12 17 11 {prose(2, 9)}"
    items = [(1, short), (2, listed), (3, "Add 7"), (4, "12 + 35 + 48 + 19 + 77 = 191"), (5, "42")]
    docs = [
        (1, f"{prose(70, 20)} {short} {prose(71, 20)}", None),
        (2, f"{prose(72, 20)} {listed} {prose(73, 20)}", None),
        (3, "What is 13 + 36 + 49 + 20 + 78?", None),
        (4, " add  7.", None),
        (5, f"{prose(74, 20)} add 7 {prose(75, 20)}", None),
        (6, "12 + 35 + 48 + 19 + 77 = 191", None),
        (7, f"{prose(76, 20)} 12 + 35 + 48 + 19 + 77 = 191 {prose(77, 20)}", None),
        (8, f"{prose(78, 20)}. Add 7.\n{prose(79, 20)}\n 42\n", None),
    ]
    assert marked(spark, docs, items) == {1: (True, "1,4"), 2: (True, "2"), 3: (False, ""), 4: (True, "3"), 5: (False, ""), 6: (True, "4"), 7: (True, "4"), 8: (True, "3,5")}


def test_names_at_the_start_of_sentences(spark):
    item = "Tom has 5 apples. Tom eats 2. Tom buys 7 more. How many does Tom have?"
    other = "Lea owned 30 red marbles. Lea lost 4 of them in the park. Lea then found 9 more of them. How many are left now?"
    docs = [
        (1, f"{prose(70, 20)}. {item.replace('Tom', 'Anna')} {prose(71, 20)}", None),
        (2, other.replace("Lea", "Omar").replace("30", "12"), None),
        (3, item.upper(), None),
    ]
    assert marked(spark, docs, [(1, item), (2, other)]) == {1: (True, "1"), 2: (True, "2"), 3: (True, "1")}


def brute_tokens(text):
    """(plain, template, template with every capitalised word a name), token for token."""
    text = regex.sub("[\x01-\x04]", " ", text or "")
    found = []
    for m in regex.finditer(r"(?:[\p{L}\p{M}\p{N}]|(?<=[0-9])[.,](?=[0-9]))+", text):
        w, before = m.group(), text[: m.start()]
        capital = regex.match(r"\p{Lu}\p{Ll}", w) is not None
        inside = capital and regex.search(r"[\p{Ll}\p{N},;)][ \t\n]$", before) is not None
        number = w[0] in "0123456789" and not before.endswith((".", ","))
        found.append((w.lower(), "name" if inside else "start" if capital else "number" if number else ""))
    plain, first, second = [], [], []
    for k, (w, kind) in enumerate(found):
        unit = k and found[k - 1][1] == "number" and kind == "" and w in dc.UNITS
        plain.append(w)
        first.append({"name": dc.NAME, "number": dc.NUMBER}.get(kind, dc.UNIT if unit else w))
        second.append(dc.NAME if kind == "start" else first[-1])
    return plain, first, second


def brute_windows(tokens, n):
    plain, first, second = tokens
    return {(kind, k, tuple(form[k : k + n])): plain[k : k + n] for kind, form in ((0, plain), (1, first), (1, second)) for k in range(len(plain) - n + 1)}


def brute_contaminated(text, item):
    doc, own = brute_tokens(text), brute_tokens(item)
    length = len(own[0])
    n = min(5, length)
    if n < 3:
        lines = regex.split(r"[\n\r]+|[.!?;:]+(?=\s|$)", text or "")
        return length > 0 and any(brute_tokens(x)[0] == own[0] for x in lines)
    signs = (dc.NAME, dc.NUMBER, dc.UNIT)
    known = defaultdict(list)
    for (kind, k, m), v in brute_windows(own, n).items():
        if kind == 0 or 3 <= sum(x not in signs for x in m) < n:
            known[kind, m].append((k, v))
    seen = defaultdict(set)
    matches = sorted((d, k, kind, m, tuple(v), tuple(dv)) for (kind, d, m), dv in brute_windows(doc, n).items() for k, v in known.get((kind, m), ()))
    island, last = 0, None
    for match in matches:
        d, k, kind = match[:3]
        island += last is not None and d - last > 2 * length
        last = d
        for half in (0, 1):
            seen["band", (d - k + half * 4) // 8 * 2 + half].add(match)
        seen["island", island].add(match)
        if kind == 0:
            seen["text", 0].add(match)

    def slots(match):
        return [(s + v, dv) for s, v, dv in zip(match[3], match[4], match[5], strict=True) if s in signs]

    for group in seen.values():
        votes = Counter(x for match in group for x in slots(match))
        choice = {slot: min((-c, v) for (s, v), c in votes.items() if s == slot)[1] for slot, _ in votes}
        broken = {match[:2] for match in group if any(choice[slot] != v for slot, v in slots(match))}
        covered = {j for match in group if not slots(match) or match[:2] not in broken for j in range(match[1], match[1] + n)}
        if len(covered) >= dc.COVER * length:
            return True
    return False


def test_random_edits_insertions_and_values_against_brute_force(spark):
    rng = random.Random(11)
    names = ["Anna", "Omar", "Lea", "Tom", "Zoe"]

    def question(k):
        words = prose(k, 60).split()
        out = []
        for w in words[: rng.randint(4, 45)]:
            out.append(rng.choice([w, w, w, w, rng.choice(names), str(rng.randint(1, 99)), f"{rng.randint(2, 9)} kg", w.title() + ".", w + "."]))
        return " ".join(out)

    def changed(text, k):
        words = text.split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            if words:
                words[rng.randrange(len(words))] = rng.choice(["other", "77", "Omar", "x"])
        if rng.random() < 0.5:
            swap = dict(zip(names, rng.sample(names, len(names)), strict=True))
            words = [swap.get(w, str(int(w) + 3) if w.isdigit() and rng.random() < 0.95 else w) for w in words]
        if rng.random() < 0.5 and words:
            at = rng.randrange(len(words))
            words[at:at] = prose(900 + k, rng.choice([1, 6, 12, 90])).split()
        if rng.random() < 0.2:
            words = words[: int(len(words) * 0.75)]
        text = " ".join(words)
        return rng.choice([text, text, text.upper(), f"{prose(500 + k, 25)} {text} {prose(600 + k, 9)}.", f"{text} {text.replace('7', '8')}"])

    items = [(k, question(k)) for k in range(30)] + [(30, "add 7"), (31, "7 8 9"), (32, "Tom. Tom has 5 kg"), (33, "")]
    docs = [(k, changed(items[k % len(items)][1], k), None) for k in range(300)]
    want = {i: ",".join(map(str, sorted(k for k, item in items if brute_contaminated(text, item)))) for i, text, _ in docs}
    got = {i: found for i, (_, found) in marked(spark, docs, items).items()}
    assert got == want
    assert 60 < sum(bool(v) for v in want.values()) < 280


def test_window_hashes_are_compiled_and_complete(spark):
    text = f"{QUESTION}. {OTHER} 1 2 3 4 5 6 a b"
    given = documents(spark, [(1, text, None), (2, "a b", None), (3, "", None), (4, None, None)])
    signed = given.select(given["doc_id"].alias("key"), dc.signed_tokens(given["text"]).alias("v"))
    found = dc._window_hashes(dc._with_forms(signed, "v", F.xxhash64), [3, 5])
    generates = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate " in line]
    assert generates and all("*(" in line for line in generates)
    forms = dc._with_forms(signed, "v", lambda x: x).filter("key = 1").first()
    expected = set()
    for n in (3, 5):
        for k in range(len(forms.w) - n + 1):
            plain, template, capitals = (tuple(f[k : k + n]) for f in (forms.w, forms.t, forms.t2))
            expected |= {(dc._PLAIN, plain)} | {(dc._TEMPLATE, m) for m in (template, capitals) if m != plain}
    rows = spark.createDataFrame(list(expected), "kind int, m array<string>").withColumn("n", F.size("m"))
    hashes = rows.withColumn("h", F.when(F.col("n") == 3, dc._combined(F.col("kind"), [F.xxhash64(F.get("m", F.lit(k))) for k in range(3)])).otherwise(
        dc._combined(F.col("kind"), [F.xxhash64(F.get("m", F.lit(k))) for k in range(5)])))
    assert {(r.key, r.h) for r in found.filter("h is not null").collect()} == {(1, r.h) for r in hashes.collect()}
