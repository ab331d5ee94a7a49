from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.support import AWKWARD, documents, prose

from plumbline.llm import simhash
from plumbline.llm.components import components


def brute_fingerprint(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, radius):
    """Set of groups (as frozensets of values) under links within the radius."""
    values, parent = list(values), {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, a in enumerate(values):
        for b in values[k + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    groups = {}
    for v in values:
        groups.setdefault(find(v), set()).add(v)
    return {frozenset(g) for g in groups.values()}


def groups_of(spark, values, radius=3, tile=simhash.TILE):
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    fps = spark.createDataFrame(signed, "fp bigint")
    roots = {r.node: r.root for r in components(simhash.links(fps, radius, tile)).collect()}
    out = {}
    for (s,) in signed:
        out.setdefault(roots.get(s, s), set()).add(s % (1 << 64))
    return {frozenset(g) for g in out.values()}


def around(rng, centre, n, most):
    out = set()
    while len(out) < n:
        flips = rng.choice(64, rng.integers(0, most + 1), replace=False)
        out.add(int(centre) ^ sum(1 << int(b) for b in flips))
    return out


@pytest.mark.parametrize("tile", [8, 64, 2048])
def test_links_connect_what_all_pairs_connect(spark, tile):
    rng = np.random.default_rng(tile)
    centres = [int.from_bytes(rng.bytes(8), "little") for _ in range(6)]
    values = set().union(*(around(rng, c, 60, 5) for c in centres)) | {0, 1, 7, 15, (1 << 64) - 1}
    assert groups_of(spark, sorted(values), 3, tile) == brute_groups(values, 3)


def test_other_radius(spark):
    rng = np.random.default_rng(9)
    values = around(rng, int.from_bytes(rng.bytes(8), "little"), 120, 8)
    assert groups_of(spark, sorted(values), 1, 16) == brute_groups(values, 1)


def test_documents(spark, awkward, no_documents):
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(awkward).collect())
    fps = [(i, brute_fingerprint(t)) for i, t, _ in AWKWARD]
    want = []
    for group in brute_groups({f for _, f in fps}, 3):
        ids = [i for i, f in fps if f in group and i is not None]
        want += [(i, f, min(ids, default=None)) for i, f in fps if f in group]
    assert got == Counter(want)
    assert simhash.near_duplicates(no_documents).count() == 0


def test_keep_first_keeps_one_of_each_group(spark, awkward, no_documents):
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns
    # 1, 2, 3 and the NULL text share fingerprint zero; 7 and 8 are copies; a NULL id keeps its own group.
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, None, 7, 9, 10, 11, 12])
    assert simhash.keep_first(no_documents).count() == 0


def test_many_near_copies_make_few_links(spark):
    base = prose(3, 400).split()
    rows = [(i, " ".join(base[:399] + [f"end{i}"]), None) for i in range(300)] + [(1000 + i, prose(50 + i, 60), None) for i in range(20)]
    found = simhash.near_duplicates(documents(spark, rows))
    assert found.filter("doc_id >= 1000 and component_id = doc_id").count() == 20
    distinct = found.select("fp").distinct()
    made = simhash.links(distinct, tile=16).count()
    keys, n = 10, distinct.count()
    assert made <= keys * n * 4


def test_components_of_chains_stars_and_noise(spark):
    chain = [(k, k + 1) for k in range(0, 40)]
    star = [(100, k) for k in range(101, 160)]
    noise = [(200, 200), (None, 3), (3, None), (7, 6), (6, 7)]
    edges = spark.createDataFrame(chain + star + noise, "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}
    assert components(edges.filter(F.lit(False))).count() == 0


def test_keep_first_with_one_id_for_different_texts(spark):
    a, b = prose(1, 80), prose(2, 80)
    kept = simhash.keep_first(documents(spark, [(1, a, None), (1, b, None), (0, b, None), (1, a, None), (None, a, None)]))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, a), (0, b)])
