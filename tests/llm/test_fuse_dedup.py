import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderflow.llm import fuse_dedup as m
from tests.llm.conftest import odd_rows


@settings(deadline=None, max_examples=60)
@given(st.sets(st.integers(0, 2 ** 64 - 1), max_size=300))
def test_filter_has_no_false_negative(keys):
    keys = np.array(sorted(keys), np.uint64)
    assert m.FuseFilter.build(keys).holds(keys).all()


def test_filter_size_and_false_positives():
    rng = np.random.default_rng(3)
    made = m.FuseFilter.build(rng.integers(0, 2 ** 63, 50_000).astype(np.uint64))
    assert len(made.fingerprints) < 1.3 * 50_000
    assert made.holds(rng.integers(0, 2 ** 63, 100_000).astype(np.uint64)).mean() < 0.006


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, len(t or "")))
    out = []
    for text, members in groups.items():
        keep = min(members, key=lambda x: (-x[1], x[0] is None, x[0]))[0]
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, digest) for i, _ in members]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_odd_rows(odd, none):
    want = expected([r[:2] for r in odd_rows()])
    assert got(m.deduplicate(odd, F.col("doc_id") % 2 == 0)) == want
    assert got(m.deduplicate(odd, F.lit(True))) == want  # an empty snapshot
    assert got(m.deduplicate(odd, F.lit(False))) == want  # an empty batch
    assert m.deduplicate(none, F.lit(True)).count() == 0


def test_kept_filters_and_buckets(spark):
    docs = spark.createDataFrame([(k, f"text {k % 700}" + " " * (k % 3)) for k in range(1500)], "doc_id long, text string")
    old = docs.where("doc_id < 900").select(F.sha2(m.normalised(), 256).alias("digest")).distinct()
    filters = m.build_filters(old.select(F.xxhash64("digest").alias("key")), 7)
    assert filters.count() == 7
    result = m.deduplicate(docs, F.col("doc_id") >= 900, filters, 7)
    assert got(result) == expected([tuple(r) for r in docs.collect()])
