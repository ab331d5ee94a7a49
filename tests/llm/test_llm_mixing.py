from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from tests.llm.support import AWKWARD, documents, prose

from plumbline.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Shares by weight, capped, the excess shared again until none is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    held, left, open_ = {}, sum(sizes.values()), set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if 3 * sizes[s] <= left * weight[s] / total]
        if not over:
            break
        for s in over:
            held[s] = 3.0 * sizes[s]
        left -= sum(held[s] for s in over)
        open_ -= set(over)
    total = sum(weight[s] for s in open_) or 1
    return {s: held.get(s, left * weight[s] / total) for s in names}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, prose(k, 3 + (k * 37) % 300), ("a", "b", "c", "d", "tiny", None)[k % 6]) for k in range(360) if k % 6 != 4 or k < 30]
    rows += [(1000 + k, prose(k, 200), "c") for k in range(300)]
    return rows, documents(spark, rows)


def test_digest(corpus):
    rows, docs = corpus
    got = mixing.digest(docs).collect()
    again = Counter(tuple(r) for r in mixing.digest(docs.repartition(5)).collect())
    assert Counter(tuple(r) for r in got) == again
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    want, source = targets(sizes), {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        assert r.size == size(rows[[x[0] for x in rows].index(r.doc_id)][1]) and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5


def permutation(spark, n):
    points, keys = mixing.rounds("77", f"{n}L")
    ids = spark.range(n).withColumn("points", points).withColumn("keys", keys)
    there = ids.withColumn("p", mixing.permuted("id", "points", "keys", f"{n}L"))
    back = mixing.permuted("p", "points", "keys", f"{n}L", inverse=True).alias("b")
    rows = there.select("id", "p", back).orderBy("id").collect()
    assert all(r.b == r.id for r in rows)
    return [r.p for r in rows]


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 64, 1000):
        got = permutation(spark, n)
        assert sorted(got) == list(range(n))
    shuffled = permutation(spark, 1000)
    steps = Counter((b - a) % 1000 for a, b in zip(shuffled, shuffled[1:], strict=False))
    assert max(steps.values()) < 20


def test_slots_are_spread_over_shards(corpus, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 100)
    rows, plan = mixing._packed(corpus[1], [])
    slots = mixing.slots(plan).collect()
    places = {(r.shard, r.slot) for r in slots}
    assert len(places) == len(slots) == plan.agg({"slots": "sum"}).first()[0]
    counts = Counter((r.source_rank, r.shard) for r in slots)
    top = {r["rank"]: r["slots"] for r in plan.collect()}
    shards = max(s for _, s in places and {(0, r.shard) for r in slots}) + 1
    for rank, n in top.items():
        for shard in range(shards - 1):
            expected = n / len(slots) * 100
            assert abs(counts[rank, shard] - expected) <= 5 * max(expected, 1) ** 0.5 + 1


def test_every_block_once_an_epoch(corpus):
    plan = mixing._packed(corpus[1], [])[1]
    seen = defaultdict(list)
    for r in mixing.slots(plan).collect():
        seen[r.source_rank, r.epoch].append((r.block, r.last_words))
    for p in plan.collect():
        length = {b: min(256, p.source_size - 256 * b) for b in range(p.blocks)}
        words = 0
        for e in range(3):
            got = seen.pop((p.rank, e), [])
            assert len({b for b, _ in got}) == len(got) and (e + 1 > p.slots // max(p.blocks, 1) or len(got) == p.blocks)
            words += sum(length[b] if last is None else last for b, last in got)
            assert all(last is None or 0 < last <= length[b] for b, last in got)
        assert words == int(p.target + 0.5)
    assert not seen


def test_draws_are_multinomial(spark, monkeypatch):
    """Counts of many shards spread as a multinomial's do, and slots stay spread when corrected."""
    monkeypatch.setattr(mixing, "SLOTS_PER_SHARD", 200)
    n = {0: 30_000, 1: 9_000, 2: 1_000}
    first = {0: 0, 1: 30_000, 2: 39_000}
    rows = [(str(k), k, 256 * v, 256.0 * v, v, v, None, first[k]) for k, v in n.items()]
    types = "source string, rank bigint, source_size bigint, target double, blocks bigint, slots bigint, last_words bigint, first_slot bigint"
    plan = spark.createDataFrame(rows, types)
    counts = {(r.shard, r["rank"]): r.drawn for r in mixing.draws(plan).collect()}
    for k, v in n.items():
        p = v / 40_000
        got = [counts.get((s, k), 0) for s in range(200)]
        mean = sum(got) / 200
        variance = sum((g - mean) ** 2 for g in got) / 199
        assert abs(mean - 200 * p) < 5 * (200 * p * (1 - p) / 200) ** 0.5
        assert 0.6 < variance / (200 * p * (1 - p)) < 1.5
    slots = mixing.slots(plan)
    assert Counter(r.source_rank for r in slots.collect()) == Counter(n)
    assert slots.groupBy("shard").count().filter("count <> 200").count() == 0


def test_mixed_documents(corpus):
    rows, docs = corpus
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    taken = Counter()
    text = {i: t for i, t, _ in rows}
    for r in out.collect():
        taken[r.doc_id] += size(r.text)
        assert r.n_chars == len(r.text)
        assert r.text == text[r.doc_id] or set(r.text.split()) <= set(text[r.doc_id].split())
    assert taken == Counter({r.doc_id: r.taken for r in mixing.digest(docs).collect() if r.taken})


def test_awkward_rows(awkward, no_documents):
    got = mixing.digest(awkward).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size(t)) for i, t, _ in AWKWARD)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert sum(r.taken for r in got) == pytest.approx(sum(r.size for r in got), rel=0.02)
    assert mixing.digest(no_documents).count() == 0
    assert mixing.mix(no_documents).count() == 0


def test_no_words_at_all(spark):
    docs = documents(spark, [(1, None, "a"), (2, " ", None)])
    assert [(r.target, r.taken) for r in mixing.digest(docs).collect()] == [(0.0, 0)] * 2
    assert mixing.mix(docs).count() == 0
