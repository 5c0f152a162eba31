"""Every query with SQL against DuckDB, and the pipeline's stages against plain Python."""

from collections import Counter

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from orderflow.llm import gam, queries as llm, token_ans
from orderflow.llm.common import stored
from tests.llm import test_decontaminate, test_hashtree, test_mixing, test_simhash_tiles
from tools.compare_oracle import digest

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("key", sorted(llm.ORACLE_SQL))
def test_matches_sql(spark, con, key):
    df = queries()[key](spark, SF)
    rel = con.execute(oracle_sql()[key])
    columns, rows = [x[0] for x in rel.description], rel.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns) and len(got) == len(rows)
    assert digest(df.columns, got)[0] == digest(columns, rows)[0]


@pytest.mark.parametrize("key", ["op1_quality_gam", "op3_toxic_grammar"])
def test_classifiers_contract(spark, documents, key):
    rows = queries()[key](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.collect())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in llm.QUERIES}
    assert "pipeline" in queries() and corpus_pipeline.ORACLE_SQL is None and token_ans.END_ID == 1


def test_pipeline_stages(spark, documents):
    (_, quality), (_, near), (_, bench), (_, mix), (_, shard) = corpus_pipeline.STAGES
    columns = documents.columns
    docs = stored(quality(spark, documents, SF))
    model = gam.fit_quality(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = documents.collect()
    scores = model.score(gam.feature_matrix([(r.text or "").encode() for r in rows]))
    want = sorted(tuple(r) for r, s in zip(rows, scores) if s >= gam.THRESHOLD)
    assert docs.columns == columns and sorted(map(tuple, docs.collect())) == want

    before, docs = want, stored(near(spark, docs, SF))
    keep = {r[2] for r in test_simhash_tiles.expected([r[:2] for r in before])}
    want = [r for r in before if r[0] in keep]
    assert docs.columns == columns and sorted(map(tuple, docs.collect())) == want

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before, docs = want, stored(bench(spark, docs, SF))
    bad = {place for place, *_ in test_decontaminate.matched([r[:2] for r in before], items)}
    want = [r for k, r in enumerate(before) if k not in bad]
    assert bad and docs.columns == columns and sorted(map(tuple, docs.collect())) == want

    before, docs = want, stored(mix(spark, docs, SF))
    got = Counter(map(tuple, docs.collect()))
    assert docs.columns == columns and set(got) <= set(before) and max(got.values()) <= 2
    sizes = Counter()
    for r in before:
        sizes[r[3]] += test_mixing.words(r[1])
    taken = Counter()
    for r, n in got.items():
        taken[r[3]] += n * test_mixing.words(r[1])
    target = test_mixing.targets(sizes)
    largest = max(test_mixing.words(r[1]) for r in before)
    assert all(abs(taken[s] - target[s]) <= 0.1 * largest + 5 for s in sizes)

    rows = shard(spark, docs, SF).collect()
    assert Counter(tuple(r[c] for c in columns) for r in rows) == got
    tree = test_hashtree.m.tree(8)
    assert all(r.shard == test_hashtree.descend(str(r.doc_id), tree) for r in rows)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
