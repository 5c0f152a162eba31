"""Rows without an id, or with one that many rows share; the whole pipeline on odd and empty tables."""

import tempfile

import corpus_pipeline
from pyspark.sql import functions as F

from orderflow.llm import gam, hashtree, mixing
from orderflow.llm.common import RANK_DIGITS, id_text_hash, text_bytes

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def many_without_id(spark):
    """A third of the rows has no id, a third the same one."""
    rows = [((None, 7, k)[k % 3], f"text number {k} " + "w " * (k % 5), "en", f"s{k % 4}", 1) for k in range(3000)]
    return rows, spark.createDataFrame(rows, DOCUMENTS).repartition(4)


def test_rank_buckets_hold_few_rows(spark):
    _, docs = many_without_id(spark)
    bucket = F.substring(id_text_hash(F.col("doc_id"), F.crc32(text_bytes())), 1, RANK_DIGITS)
    assert max(r["count"] for r in docs.groupBy(bucket).count().collect()) < 12


def test_sharding_and_mixing(spark):
    rows, docs = many_without_id(spark)
    slots = {}
    for r in hashtree.assignment(docs).collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, slots.values())) == 3000 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in hashtree.assignment(docs).where("doc_id is null").collect()}) == 1
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == 3000 and all(0 <= r.copies <= 2 for r in mixed)
    for source in ("s0", "s3"):
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 10


def test_one_row_per_labelled_id(spark):
    _, docs = many_without_id(spark)
    labels = spark.createDataFrame([(7, 1), (None, 1), *((k, k % 2) for k in range(2, 3000, 3))], "doc_id long, quality int")
    sample = gam.labelled_sample(docs, labels, "quality", F.lit(True), 10_000).collect()
    assert len(sample) == len({r.doc_id for r in sample}) == 1001 and {r.doc_id for r in sample} >= {2, 7, 2999}
    small = gam.labelled_sample(docs, labels, "quality", F.lit(True), 100).collect()
    assert 50 < len(small) < 160


def folder(spark, docs):
    """Tables of a pipeline run."""
    root = tempfile.mkdtemp(prefix="odd-", dir="/tmp")
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 1, 0), (4, None, 0), (9, 1, 0), (12, 0, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven"), (None, None)], "item_id long, text string").write.parquet(
        f"{root}/benchmark.parquet")
    return root


def test_pipeline_on_odd_rows(spark, odd):
    rows = corpus_pipeline.run(spark, folder(spark, odd)).collect()
    assert rows and set(odd.columns) | {"shard", "slot"} == set(rows[0].asDict())
    given = {(r.doc_id, r.text, r.source) for r in odd.collect()}
    kept = [(r.doc_id, r.text, r.source) for r in rows]
    assert set(kept) <= given and max(map(kept.count, kept)) <= 2
    # The benchmark's passage is gone with its rows, and the two copies of the long text are one row at most twice.
    assert not {1, 2, 3} & {k[0] for k in kept} and sum(k[0] in (9, 10) for k in kept) <= 2
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pipeline_on_empty_tables(spark, none):
    out = corpus_pipeline.run(spark, folder(spark, none))
    assert out.collect() == [] and {"shard", "slot"} <= set(out.columns)
