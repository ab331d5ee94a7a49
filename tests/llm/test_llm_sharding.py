from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

from tests.llm.support import AWKWARD, documents, prose

from plumbline.llm import sharding


def brute(rows, limit):
    """Splits one bucket after another."""
    items = [(int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16), i, len((t or "").encode())) for i, t, _ in rows]
    out, todo = {}, [(0, items)]
    while todo:
        depth, bucket = todo.pop()
        if sum(b for *_, b in bucket) <= limit or depth == 60:
            for h, i, _ in bucket:
                out[i] = (depth, f"{h:060b}"[:depth])
        else:
            for bit in (0, 1):
                part = [x for x in bucket if x[0] >> (59 - depth) & 1 == bit]
                if part:
                    todo.append((depth + 1, part))
    return out


def test_directory_equals_successive_splits(spark):
    rows = [(k, prose(k, 5 + (k * k) % 400), None) for k in range(200)]
    for limit in (3_000, 20_000, 10**9):
        got = {r.doc_id: (r.depth, r.shard) for r in sharding.shards(documents(spark, rows), limit).collect()}
        assert got == brute(rows, limit)


def test_awkward_rows(spark, awkward, no_documents):
    got = sharding.shards(awkward, 1 << 30).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in AWKWARD)
    assert sum(r.bytes for r in got) == got[0].shard_bytes == sum(len((t or "").encode()) for _, t, _ in AWKWARD)
    assert sharding.shards(no_documents).count() == 0


def test_rows_of_one_id_are_dealt_out(spark):
    rows = [(5, "x" * (100 + k % 7), None) for k in range(300)] + [(k, "y" * 50, None) for k in range(100, 140)] + [(6, "z" * 5000, None)]
    got = sharding.shards(documents(spark, rows), 1000).collect()
    assert len(got) == len(rows)
    totals = defaultdict(int)
    for r in got:
        totals[r.shard, r.part] += r.bytes
    assert all(r.shard_bytes == totals[r.shard, r.part] for r in got)
    assert {r.doc_id for r in got if totals[r.shard, r.part] > 1000} == {6}


def test_written_shards_fit(spark, tmp_path):
    docs = documents(spark, [(k % 50, prose(k, 30), None) for k in range(200)])
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, 3000)
    back = spark.read.parquet(path)
    assert set(back.columns) == {*docs.columns, "_shard"}
    assert sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert len([d for d in os.listdir(path) if d.startswith("_shard=")]) > 5
    assert back.selectExpr("_shard", "octet_length(text) n").groupBy("_shard").sum("n").filter("`sum(n)` > 3000").count() == 0
