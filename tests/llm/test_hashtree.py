import hashlib
import math
import zlib

from pyspark.sql import functions as F

from orderflow.llm import hashtree as m
from tests.llm.conftest import odd_rows


def descend(key, node):
    while node.shard is None:
        def draw(c):
            bits = int(hashlib.md5(f"{key}@{c.path}".encode()).hexdigest()[:13], 16)
            return -math.log((bits + 1) / 2 ** 52) / c.weight
        node = min(node.children, key=draw) if len(node.children) > 1 else node.children[0]
    return node.shard


def test_odd_rows(odd, none):
    rows = m.assignment(odd).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert r.shard == descend(key, m.tree(8)) and r.grown_shard == descend(key, m.tree(9))
    sizes = sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t, *_ in odd_rows())
    assert sorted(str((r.doc_id, r["size"], r.text_crc32)) for r in rows) == sizes
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    full = m.with_shards(odd)
    assert set(full.columns) == {*odd.columns, "slot"} and full.count() == len(rows)
    assert m.assignment(none).count() == 0 and m.with_shards(none).count() == 0


def test_growth_and_weights(spark):
    ids = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    for n in (8, 9, 11):
        moved = ids.select(m.shard_of(F.col("k"), m.tree(n)).alias("a"), m.shard_of(F.col("k"), m.tree(n + 1)).alias("b"))
        counts = {(r.a == r.b, r.b == n): r["count"] for r in moved.groupBy("a", "b").count().collect()}
        assert (False, False) not in counts
    light = {5: 0.5}
    rows = ids.select(m.shard_of(F.col("k"), m.tree(8)).alias("a"), m.shard_of(F.col("k"), m.tree(8, light)).alias("b")).collect()
    changed = [(r.a, r.b) for r in rows if r.a != r.b]
    # Shard 5 sits in region 1 (shards 4-7): no row moves inside region 0.
    assert changed and all(4 <= a <= 7 for a, _ in changed)
    share = sum(r.b == 5 for r in rows) / len(rows)
    assert abs(share - 0.5 / 7.5) < 0.02
