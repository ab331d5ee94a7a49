from __future__ import annotations

import os
from collections import Counter, defaultdict

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from tests.llm.test_llm_simhash import brute_fingerprint, brute_groups
from tests.llm.test_llm_token_files import brute as token_rows

from plumbline.llm.common import written

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    if not os.path.isdir(DATA):
        pytest.skip("test tables are not available")
    docs = written(spark.read.parquet(f"{DATA}/documents.parquet"), "given")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], DATA), "stage"))
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_in_order(results):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "mixing", "token_files"]
    for df in results[:5]:
        assert df.columns == results[0].columns
    counts = [df.count() for df in results[:4]]
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0


def test_quality_stage_follows_the_query(spark, results):
    kept = entry.queries()["op6_quality_rules"](spark, DATA).filter("kept")
    assert ids(results[1]) == ids(kept)


def test_near_duplicate_stage_against_all_pairs(results):
    fps = {r.doc_id: brute_fingerprint(r.text) for r in results[1].collect()}
    by_fp = defaultdict(list)
    for i, f in fps.items():
        by_fp[f].append(i)
    want = {min(i for f in group for i in by_fp[f]) for group in brute_groups(by_fp, 3)}
    assert set(ids(results[2])) == want


def test_decontamination_stage_drops_documents_with_items(spark, results):
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in results[2].collect() if any(t in r.text for t in items)}
    assert holds and set(ids(results[2])) - set(ids(results[3])) == holds


def test_mixing_and_token_stages(spark, results):
    from tokenizers import Tokenizer

    from plumbline.llm import mixing
    from plumbline.llm.queries import tokenizer_file

    taken = {r.doc_id: r.taken for r in mixing.digest(results[3]).collect() if r.taken}
    words = Counter()
    for r in results[4].collect():
        words[r.doc_id] += len(r.text.split())
    assert words == taken
    rows = [(r.doc_id, r.text, None) for r in results[4].collect()]
    got = sorted((tuple(r) for r in results[5].collect()), key=lambda r: r[1])
    assert got == token_rows(Tokenizer.from_file(tokenizer_file()), rows)


def test_run_gives_the_last_stage(spark, results):
    assert Counter(map(tuple, corpus_pipeline.run(spark, DATA).collect())) == Counter(map(tuple, results[5].collect()))
