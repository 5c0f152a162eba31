"""Sharding by a hierarchical weighted hash tree (native expressions only).

A document descends region, rack and shard levels.  At each level every child draws ``-ln(u) / weight``, u being a
hash of the id and the child's path, and the smallest draw wins; a child's weight is the sum of its shards' weights.
A draw depends on nothing but the id, the child and its weight, so when weights change, a document moves only into or
inside the subtrees whose weights change.

``tree(shards)``: the first eight shards form two regions of two racks of two shards; every further shard is a region
of its own with one rack.  From eight shards on, one more shard therefore takes rows only into itself.

Slots number the rows of a shard from 0 without gaps, in the order of the md5 of the id and the text's checksum (a
fixed shuffle of the shard).  They are ranked inside buckets of a shard and offset by the buckets' counts, so no task
holds a whole shard, also where many rows have no id or the same one.

Defined cases: a null id is a key like any other (all such rows go to one shard); repeated rows of an id go to the
same shard and get slots of their own; a null text has size 1 and the checksum of no bytes; an empty table gives an
empty result.  Extra columns are kept by ``with_shards`` and ignored by ``assignment``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import id_text_hash, spread_rank, text_bytes

SHARDS = 8
LAW = "key"


@dataclass(frozen=True)
class Node:
    path: str
    weight: float
    shard: int | None = None
    children: tuple[Node, ...] = ()


def _parent(path: str, children: tuple[Node, ...]) -> Node:
    return Node(path, sum(c.weight for c in children), children=children)


def tree(shards: int, weights: dict[int, float] | None = None) -> Node:
    """Region, rack and shard levels for shards 0 to ``shards`` - 1; weights default to 1."""
    weights = weights or {}

    def rack(region: int, number: int, members: list[int]) -> Node:
        path = f"{region}/{number}"
        return _parent(path, tuple(Node(f"{path}/{s}", weights.get(s, 1.0), s) for s in members))

    regions = []
    for first in range(0, min(shards, 8), 4):
        members = list(range(first, min(first + 4, shards)))
        racks = [rack(len(regions), k, members[2 * k:2 * k + 2]) for k in range((len(members) + 1) // 2)]
        regions.append(_parent(str(len(regions)), tuple(racks)))
    for extra in range(8, shards):
        regions.append(_parent(str(len(regions)), (rack(len(regions), 0, [extra]),)))
    return _parent("", tuple(regions))


def _draw(key: Column, node: Node) -> Column:
    """Exponential draw of a child: -ln(u) / weight, u in (0, 1] from 52 bits of an md5."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"@{node.path}"))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 1.0) / F.lit(float(1 << 52))) / F.lit(node.weight)


def shard_of(key: Column, root: Node) -> Column:
    """The shard reached by descending the tree with a string key."""
    if root.shard is not None:
        return F.lit(root.shard)
    if len(root.children) == 1:
        return shard_of(key, root.children[0])
    draws = F.array(*[F.struct(_draw(key, c).alias("draw"), F.lit(k).alias("child")) for k, c in enumerate(root.children)])
    won = F.array_min(draws)["child"]
    out = shard_of(key, root.children[-1])
    for k, child in reversed(list(enumerate(root.children[:-1]))):
        out = F.when(won == k, shard_of(key, child)).otherwise(out)
    return out


def _key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def assignment(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One narrow row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = docs.select(
        "doc_id", (F.octet_length(text_bytes()) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text_bytes()).alias("text_crc32"), F.lit(LAW).alias("law"),
        shard_of(_key(), tree(shards)).alias("shard"), id_text_hash(F.col("doc_id"), F.crc32(text_bytes())).alias("__hash"),
        shard_of(_key(), tree(shards + 1)).alias("grown_shard"))
    ranked = spread_rank(rows, ["shard"], "__hash", ["doc_id", "text_crc32", "size"], "slot")
    return ranked.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def with_shards(docs: DataFrame, shards: int = SHARDS, names: tuple[str, str] = ("shard", "slot")) -> DataFrame:
    """All columns of the documents with their shard and slot.

    A column that has one of the two names gives way.  The rows of a shard and bucket end up in one partition.
    """
    shard, slot = names
    docs = docs.drop(*names)
    rows = docs.withColumn(shard, shard_of(_key(), tree(shards))).withColumn("__hash", id_text_hash(F.col("doc_id"), F.crc32(text_bytes())))
    return spread_rank(rows, [shard], "__hash", ["doc_id"], slot).drop("__hash")


def _sql_draw(node: Node) -> str:
    return (f"-ln((CAST('0x' || substr(md5(k || '@{node.path}'), 1, 13) AS BIGINT) + 1.0::DOUBLE) / {float(1 << 52)!r}::DOUBLE)"
            f" / {node.weight!r}::DOUBLE")


def _sql_shard(root: Node) -> str:
    if root.shard is not None:
        return str(root.shard)
    if len(root.children) == 1:
        return _sql_shard(root.children[0])
    draws = [f"({_sql_draw(c)})" for c in root.children]
    won = " ".join(f"WHEN least({', '.join(draws)}) = {d} THEN {_sql_shard(c)}" for d, c in zip(draws, root.children))
    return f"CASE {won} END"


#: The table of CRC-32 and its steps over bytes, built by rule.
ORACLE_SQL = f"""
WITH bit8 AS (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
        lambda c, x: xor(c >> 1, 3988292384::BIGINT * (c & 1))) v FROM range(256) t(i)),
crc AS (SELECT list(v ORDER BY i) t FROM bit8),
d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') k, coalesce('=' || doc_id::VARCHAR, 'null') x, encode(coalesce(text, '')) b FROM documents),
s AS (SELECT doc_id, k, x, octet_length(b) + 1 AS size,
        xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(b), '..'),
            lambda h: CAST('0x' || h AS BIGINT))),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS text_crc32
        FROM d, crc)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, '{LAW}' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY md5(x || chr(31) || '=' || text_crc32), doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM (SELECT *, {_sql_shard(tree(SHARDS))}::INTEGER AS shard, {_sql_shard(tree(SHARDS + 1))}::INTEGER AS grown_shard FROM s)
"""
