from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T
from tests.llm.support import EXTRA

from plumbline.llm import vector_codes as vc


def vectors(spark, rows):
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.DoubleType())),
            T.StructField("label", T.IntegerType()),
            *[T.StructField(c, T.StringType()) for c in (*EXTRA[:-1], "codes", "error", "part")],
        ]
    )
    return spark.createDataFrame([(*r, *["x"] * (len(schema) - 3)) for r in rows], schema)


def exact(x):
    return int(x) * 1024 if abs(x) >= 1 << 53 else math.floor(x * 1024)


def brute(rows, parts=4, entries=256, rounds=4):
    """The contract in plain Python integers."""
    good = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not good:
        return Counter()
    width = -(-max(len(v) for _, v, _ in good) // parts)
    whole = [[exact(x) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in good]
    order = sorted(range(len(good)), key=lambda k: (good[k][0] is None, good[k][0] or 0, good[k][1]))[:entries]
    cut = [[v[p * width : (p + 1) * width] for v in whole] for p in range(parts)]
    codes, errors, books = [""] * len(good), [0] * len(good), []
    for p in range(parts):
        book = [cut[p][k] for k in order]

        def near(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            own = defaultdict(list)
            for x in cut[p]:
                own[near(x, book)[1]].append(x)
            book = [[sum(c) // len(own[k]) for c in zip(*own[k], strict=True)] if own[k] else e for k, e in enumerate(book)]
        for k, x in enumerate(cut[p]):
            d, e = near(x, book)
            codes[k] += f"{e:02x}"
            errors[k] += d
        books += [str(x) for e in book for x in e]
    long = [e if e < 1 << 63 else None for e in errors]
    by_label = defaultdict(list)
    for (_, _, lab), e in zip(good, long, strict=True):
        by_label[lab].append(e)
    sums = {lab: None if None in es or sum(es) >= 1 << 63 else sum(es) for lab, es in by_label.items()}
    sha = hashlib.sha256(",".join(books).encode()).hexdigest()
    return Counter((i, c, e, sums[lab], sha) for (i, _, lab), c, e in zip(good, codes, long, strict=True))


def got(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("n", [1, 2, 8, 16, 64])
def test_transform_keeps_scaled_distances(n):
    matrix = vc.sequency(n)
    assert (matrix @ matrix.T == n * np.eye(n)).all()
    changes = (np.diff(matrix, axis=1) != 0).sum(1)
    assert changes.tolist() == list(range(n))
    a, b = np.random.default_rng(n).integers(-500, 500, (2, 9, max(1, n - n // 3)))
    assert (((vc.transform(a) - vc.transform(b)) ** 2).sum(1) == vc.length(a.shape[1]) * ((a - b) ** 2).sum(1)).all()


@pytest.mark.parametrize("kind", [np.int64, object])
@pytest.mark.parametrize("spread", [2, 400])
def test_nearest_against_all_entries(kind, spread):
    rng = np.random.default_rng(spread)
    parts, entries = rng.integers(-spread, spread, (300, 7)), rng.integers(-spread, spread, (90, 7))
    entries[40:50] = entries[:10]  # ties
    where, far = vc.nearest(vc.transform(parts.astype(kind)), vc.transform(entries.astype(kind)))
    full = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert where.tolist() == full.argmin(1).tolist() and far.tolist() == full.min(1).tolist()


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=10).tolist(), i % 3) for i in range(40)]
    rows += [(50, None, 1), (51, [1.0, None], 1), (52, [nan] * 10, 1), (53, [inf] + [0.0] * 9, None), (54, [], None), (55, [0.25], None)]
    rows += [(7, [0.5] * 10, 2), (7, [0.5] * 10, 2), (None, [-0.001] * 10, None), (None, rows[3][1], 9), (60, [1e30] + [0.0] * 9, 5), (61, [-3e9] * 10, 6)]
    df = vectors(spark, rows)
    assert got(vc.digest(df, entries=16)) == brute(rows, entries=16)
    assert got(vc.digest(df.filter("vec_id = 50 or vec_id = 52"))) == Counter()
    assert got(vc.digest(df.filter("vec_id < 0"))) == Counter()
    assert got(vc.digest(df.filter("vec_id = 54"))) == brute([(54, [], None)])


def test_many_equal_vectors_and_few_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [0.125] * 12 if i % 3 else rng.normal(size=12).tolist(), None if i % 2 else 1) for i in range(200)]
    df = vectors(spark, rows).repartition(7)
    assert got(vc.digest(df, entries=8, rounds=3)) == brute(rows, entries=8, rounds=3)


def test_whole_table(spark):
    from plumbline.llm.queries import op11_vector_codes

    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert got(op11_vector_codes(spark, folder)) == brute(rows)
