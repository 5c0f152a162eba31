"""SimHash near-duplicates: exact comparison of tiles of fingerprints with numpy.

Fingerprints are grouped into tiles by the population counts of their four 16-bit quarters.  The L1 distance of two
tiles' counts never exceeds the Hamming distance of their members, so a tile pair whose counts differ by more than
the radius is skipped without losing a link.  What remains is compared exactly with exclusive-or and bit counts,
in blocks of bounded size.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; a text with fewer words than
the shingle length has one shingle, its whole word sequence; repeated shingles count each time; equal fingerprints
form one class before any comparison, so copies are never expanded into pairs; a null ``doc_id`` never becomes a
``component_id`` (a component whose rows all lack an id has a null one); an empty table gives an empty result.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import bounded_batches, stored, text_bytes, text_key
from orderflow.llm.components import connected_components

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
QUARTERS = 4
#: Fingerprints in a block of a tile, on average.
BLOCK = 2048
_CHUNK = 1 << 16


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash: a bit is set when more than half of the shingle hashes have it."""
    words = text.lower().split()
    count = len(words) - words_per_shingle + 1
    if not words:
        return 0
    if count < 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:count].tolist()
    ends = ends[words_per_shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, count, _CHUNK):
        spans = zip(starts[k:k + _CHUNK], ends[k:k + _CHUNK])
        hashes = np.array([digest(line[i:j], SEED) for i, j in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, row: Column | None = None) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed 64-bit integer; ``row`` is carried along as __row."""
    carried = [] if row is None else [row.alias("__row")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fps = np.fromiter((fingerprint(t.as_py(), words_per_shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                                             ["doc_id", "fp", *batch.schema.names[2:]])

    texts = bounded_batches(docs).select(F.col("doc_id").cast("long"), text_bytes().alias("text"), *carried)
    return texts.mapInArrow(run, "doc_id long, fp long" + (", __row string" if carried else ""))


def _offsets(radius: int, parts: int = QUARTERS) -> list[tuple[int, ...]]:
    """Differences of population counts within the radius, one of each (d, -d): those not below zero."""
    found = [()]
    for _ in range(parts):
        found = [(*o, d) for o in found for d in range(-radius, radius + 1) if sum(map(abs, (*o, d))) <= radius]
    return [o for o in found if o >= (0,) * parts]


def block_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the links within ``radius`` between two blocks: (node, smallest node it reaches here)."""
    shift = 0 if same else len(a)
    left, right = [], []
    for k in range(0, len(a), 256):
        near = np.bitwise_count(a[k:k + 256, None] ^ b) <= radius
        if near.any():
            i, j = np.nonzero(near)
            left.append(i + k)
            right.append(j + shift)
    if not left:
        return a[:0], b[:0]
    i, j = np.concatenate(left), np.concatenate(right)
    nodes = a if same else np.concatenate([a, b])
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    linked = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[linked], nodes[label[linked]]


def tile_links(classes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect every pair of distinct fingerprints within ``radius``, through chains.

    Each pair of blocks gives at most one link for each of its fingerprints, not all pairs.
    """
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(0xFFFF)).cast("int") for k in range(QUARTERS)]
    tiled = classes.select("fp", F.array(*counts).alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    blocks = (tiled.join(sizes, "tile")
              .withColumn("block", F.pmod(F.xxhash64(F.col("fp"), F.lit("block")), F.col("blocks")))
              .groupBy("tile", "block").agg(F.collect_list("fp").alias("fps")))
    blocks = stored(blocks)
    offsets = F.array(*[F.array(*[F.lit(d) for d in o]) for o in _offsets(radius)])
    left = (blocks.withColumn("offset", F.explode(offsets))
            .select(F.col("block").alias("block_a"), F.col("fps").alias("a"),
                    F.zip_with("tile", "offset", lambda t, o: t + o).alias("tile"),
                    (F.col("offset") == F.array(*[F.lit(0)] * QUARTERS)).alias("own")))
    pairs = (left.join(blocks, "tile").where("not own or block_a <= block")
             .select("a", F.col("fps").alias("b"), (F.col("own") & (F.col("block_a") == F.col("block"))).alias("same")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [(c.flatten().to_numpy().view(np.uint64), c.offsets.to_numpy() - c.offsets[0].as_py())
                   for c in (batch.column(0), batch.column(1))]
            same = batch.column(2).to_pylist()
            out = [(np.empty(0, np.uint64),) * 2]
            (a, at_a), (b, at_b) = cut
            for k, one in enumerate(same):
                out.append(block_links(a[at_a[k]:at_a[k + 1]], b[at_b[k]:at_b[k + 1]], radius, one))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([x[side] for x in out]).view(np.int64)) for side in (0, 1)], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _rooted(fps: DataFrame, first: Column, radius: int) -> DataFrame:
    """(fp, first, root): every distinct fingerprint with the smallest ``first`` of its rows and its component."""
    classes = stored(fps.groupBy("fp").agg(F.min(first).alias("first")))
    roots = connected_components(tile_links(classes, radius), "a", "b").select(F.col("node").alias("fp"), "root")
    return classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp (signed), fingerprint (hexadecimal) and component_id."""
    fps = stored(fingerprints(docs, words_per_shingle))
    rooted = _rooted(fps, F.col("doc_id"), radius)
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = stored(rooted.join(ids, "root").select("fp", "component_id"))
    return (fps.join(labels, "fp")
            .select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def _row_key(docs: DataFrame) -> Column:
    """SHA-256 of id and text, then a hash of all columns: rows with one key are copies of each other."""
    every = [c for name in docs.columns for c in (F.col(name).isNull(), F.col(name))]
    return F.concat(text_key(F.col("doc_id").cast("long")), F.hex(F.xxhash64(*every)))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Documents that stay: of each component exactly one row, by the smallest doc_id (null last) and row key.

    Rows are told apart by id and content, so neither null nor repeated ids bring a row in, or out, for another one.
    """
    fps = stored(fingerprints(docs, row=_row_key(docs)))
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__row")
    kept = _rooted(fps, first, RADIUS).groupBy("root").agg(F.min("first")["__row"].alias("__row"))
    # Copies of a row collapse before the shuffle; the join finds the rows dealt by the key already.
    rows = docs.withColumn("__row", _row_key(docs)).dropDuplicates(["__row"])
    return rows.join(kept.select("__row"), "__row", "left_semi").select(*docs.columns)
