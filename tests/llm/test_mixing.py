import math
import re

from orderflow.llm import mixing as m
from tests.llm.conftest import odd_rows


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Resharing by weight, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    fixed, budget = {}, 1.5 * sum(sizes.values())
    while True:
        rest = budget - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2.0 * sizes[s] for s in over}


def check(rows, docs, slack):
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + words(text)
    want = targets(sizes)
    taken = {}
    for r in rows:
        assert r["size"] <= 0 or r.taken % r["size"] == 0
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], abs_tol=1e-6)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(rows) == len(docs)
    assert all(abs(taken[s] - want[s]) <= slack(s) for s in sizes), (taken, want)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plain = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    rows = m.mix(docs).collect()
    check(rows, plain, lambda s: 25)  # the smallest texts of a source have a few words
    again = m.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_odd_rows(odd, none):
    rows = m.mix(odd).collect()
    plain = [(r[0], r[1], r[3]) for r in odd_rows()]
    check(rows, plain, lambda s: max(words(t) for _, t, source in plain if source == s))
    full = m.mixed(odd)
    assert full.columns == odd.columns and full.count() == sum(r.copies for r in rows)
    assert m.mix(none).count() == 0 and m.mixed(none).count() == 0


def test_one_hot_size_is_shared_out_exactly(spark):
    """Nine tenths of the rows have one size and source: their copies add up to the bucket's, one apart at most."""
    rows = [(k, "w " * 10, "a") for k in range(900)] + [(k, "w " * (k % 7 + 1), "b") for k in range(900, 1000)]
    got = m.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    check(got, rows, lambda s: 10)
    copies = {r.copies for r in got if r.source == "a"}
    assert max(copies) - min(copies) <= 1


def test_tilt_solves_the_dual(spark):
    """Rates before rounding meet the constraints and follow the sigmoid of one multiplier per source."""
    docs = spark.createDataFrame([(k, "w " * (1 + k * 7 % 50), "abc"[k % 3]) for k in range(600)],
                                 "doc_id long, text string, source string")
    histogram = m._sizes(docs).groupBy("source", "size").count().withColumnRenamed("count", "docs")
    t = m.source_targets(m._sizes(docs))
    for s in m.tilted(histogram, t).collect():
        own = [r for r in histogram.collect() if r.source == s.source]
        if s.target < 2 * s.source_size:
            sum_ = sum(r.docs * r["size"] * 2 / (1 + math.exp(-s.multiplier * r["size"] / s["mean"])) for r in own)
            assert abs(sum_ - s.target) < 1e-6 * s.source_size
