from __future__ import annotations

import re
from collections import Counter

from tests.llm.support import AWKWARD, documents, prose

from plumbline.llm import quality


def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark, awkward):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.digest(awkward).collect())
    assert got == Counter((i, *measures(t)) for i, t, _ in AWKWARD)


def test_colliding_hashes_take_the_exact_route(spark, monkeypatch):
    rows = [(1, "a b c d a b c x y a b c", None), (2, " ".join(str(k % 37) for k in range(300)), None), (3, prose(1, 200), None)]
    monkeypatch.setattr(quality, "_hash_part", lambda entry: entry * 0)  # every window collides
    got = {r.doc_id: r.n_repeat_words for r in quality.digest(documents(spark, rows)).collect()}
    assert got == {i: measures(t)[4] for i, t, _ in rows}


def test_order_changes_nothing(spark, awkward):
    orders = [list(quality.RULES), list(reversed(quality.RULES))]
    kept = [sorted(map(str, quality.verdicts(awkward, o).select("_row.doc_id", "_row.text", "kept").collect())) for o in orders]
    assert kept[0] == kept[1]


def test_rank_prefers_rejections_per_cost(spark):
    docs = documents(spark, [(i, "too short", None) for i in range(40)])
    ranked = quality.rank(docs)
    assert ranked[0].name == "short" and {r.name for r in ranked} == {r.name for r in quality.RULES}


def test_stage_keeps_rows_and_columns(spark, awkward, no_documents):
    kept = quality.quality(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, 7, 7, 8, 11])
    assert quality.quality(no_documents).count() == 0
    assert quality.digest(no_documents).count() == 0


def test_each_rule_rejects_its_kind(spark):
    good = prose(3, 120)
    bad = {
        1: prose(1, 49),
        2: "one two three " * 40,
        3: " ".join(w + "###" for w in prose(2, 60).split()),
        4: " ".join("a" for _ in range(3)) + " " + " ".join("x" * (k + 13) for k in range(60)),
        5: "\n".join([prose(4, 3)] * 4 + [prose(9, 60)] + [prose(5, 4)] * 4),
        6: prose(6, 40) + " " + " ".join(str(k) for k in range(1000, 1060)),
        7: prose(8, 80).upper(),
    }
    docs = documents(spark, [(0, good, None), *[(i, t, None) for i, t in bad.items()]])
    assert [r.doc_id for r in quality.quality(docs).collect()] == [0]


def test_results_can_be_filtered_and_joined(spark):
    rows = [(i, prose(i, 40 + i) + (" one two three" * 30 if i % 3 == 0 else ""), None) for i in range(60)]
    found = quality.digest(documents(spark, rows))
    all_rows = {r.doc_id: r for r in found.collect()}
    for condition, want in [("kept", lambda r: r.kept), ("not kept", lambda r: not r.kept), ("base_failed", lambda r: r.base_failed), ("n_repeat_words > 10", lambda r: r.n_repeat_words > 10)]:
        assert {r.doc_id for r in found.filter(condition).collect()} == {i for i, r in all_rows.items() if want(r)}
    other = found.filter("kept").withColumnRenamed("doc_id", "other").select("other")
    joined = found.join(other, found["doc_id"] == other["other"]).filter("not base_failed")
    assert joined.count() == sum(r.kept for r in all_rows.values())
