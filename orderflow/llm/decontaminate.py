"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A short test item inside a long document has a Jaccard similarity near zero whatever the document holds, so the
MinHash side is the item's: its sketch are its smallest shingle hashes (bottom-k).  Items are partitioned by their
number s of distinct shingles (powers of two).  A document that holds a share t of an item misses at most
``floor((1 - t) * s)`` of its shingles, so of a sketch that is m larger than that it holds at least m.  Every class
has its own m, which grows with its size, and its own filter over its sketches; a whole document is screened class by
class, passes a class with at least m hits, and is compared with the items of these classes only.  Documents that pass
give their shingles that are also benchmark shingles (one more filter); these are joined with the items' as strings,
and a pair is reported when the share of the item's distinct shingles found is t or more.  No step loses a pair.

Words are runs of ASCII letters and digits and of non-ASCII characters, in lower case; characters of scripts that are
written without spaces (Chinese, Japanese, Thai, Lao, Burmese, Khmer) are words of their own, and marks of other
blocks (Latin-1 and general punctuation, CJK and full-width marks) part words.  Shingles have five words; an item of
fewer words is one shingle of its own length, which is looked for in documents of any length.

Defined cases: a null or empty text, and one without words, has no shingle and matches nothing; an item of a single
word is found wherever that word stands; repeated shingles count once; items that occur twice under different ids are
reported for each id.  Inside the search
a document or item is an id with a text, null ids included: different texts under one id are searched each on its own,
copies of a row are one.  A pair of ids is reported once, with its best match; pairs with a null id are not reported,
but their documents are dropped.  An empty benchmark or table gives an empty result.  Only doc_id, item_id and text
are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.llm.bloom import filter_of, probe
from orderflow.llm.common import bounded_batches, stored, text_bytes, text_key

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

# Characters that are words of their own (kana, Han, Thai and Lao, Burmese, Khmer), and marks that part words.
ALONE = ((0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF), (0x0E00, 0x0EFF),
         (0x1000, 0x109F), (0x1780, 0x17FF))
MARKS = ((0x80, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7), (0x2000, 0x206F), (0x3000, 0x303F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20))


def _class(ranges: tuple[tuple[int, int], ...]) -> str:
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


_SPECIAL = re.compile(f"([{_class(ALONE)}])|[{_class(MARKS)}]")


def words_of(text: bytes) -> list[bytes]:
    low = text.decode("utf-8", "replace").lower()
    if not low.isascii() and _SPECIAL.search(low):
        low = _SPECIAL.sub(lambda c: f" {c[1]} " if c[1] else " ", low)
    return _WORD.findall(low.encode())


def shingle_hashes(words: list[bytes], length: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit hash of each shingle of this length, mixed from the words' checksums; none for a shorter sequence."""
    if len(words) < length or not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(crc32, words), np.uint64, len(words)) + np.uint64(1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes) - length + 1, np.uint64)
        for k in range(length):
            total = total * np.uint64(0x9E3779B97F4A7C15) + codes[k:len(codes) - length + 1 + k]
        total ^= total >> np.uint64(31)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        return total ^ (total >> np.uint64(29))


def least_hits(size_class: int) -> int:
    """m of a class: hits in its sketches that a document needs."""
    return size_class + 1


def item_shingles(items: DataFrame, threshold: float = CONTAINMENT, length: int = SHINGLE_WORDS) -> DataFrame:
    """(__item, item_id, shingle, hash, words, item_shingles, size_class, in_sketch) for every distinct shingle of every item.

    ``words`` is the shingles' length: that of the item if it is shorter than ``length``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int | None, str, int, int]] = []
            for key, item, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                own = min(length, len(words))
                if own:
                    out += [(key, item, b" ".join(words[k:k + own]).decode(), h, own)
                            for k, h in enumerate(shingle_hashes(words, own).view(np.int64).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in
                                              enumerate((pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32()))],
                                             ["__item", "item_id", "shingle", "hash", "words"])

    rows = (items.select(text_key(F.col("item_id").cast("long")).alias("__item"), F.col("item_id").cast("long"),
                         text_bytes().alias("text"))
            .mapInArrow(run, "__item string, item_id long, shingle string, hash long, words int").distinct())
    own = Window.partitionBy("__item")
    rank = F.row_number().over(own.orderBy("hash", "shingle"))
    size_class = F.floor(F.log2("item_shingles")).cast("int")
    return (rows.withColumn("item_shingles", F.count("*").over(own)).withColumn("size_class", size_class)
            .withColumn("in_sketch", rank <= F.floor(F.lit(1.0 - threshold + 1e-9) * F.col("item_shingles"))
                        + F.col("size_class") + least_hits(0)))


def screened(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """(__doc, doc_id, classes, shingle): the shingles that may be the benchmark's, of documents that pass a class's
    screen; ``classes`` has a bit for each class passed.

    There is one filter for each class of powers of two that occurs, so their number is bounded, too.
    """
    spark = docs.sparkSession
    found = [tuple(r) for r in shingles.select("size_class", "words").distinct().collect()]
    lengths = sorted({words for _, words in found})
    sketch = shingles.where("in_sketch")
    filters = spark.sparkContext.broadcast({c: filter_of(sketch.where(F.col("size_class") == c).select("hash"))
                                            for c in sorted({c for c, _ in found})})
    every = spark.sparkContext.broadcast(filter_of(shingles.select("hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            passed: list[int] = []
            texts: list[str] = []
            for row, text in enumerate(batch.column(2)):
                words = words_of(text.as_py())
                # Per length, where the document has shingles that may be the benchmark's, and their hashes.
                places = []
                for length in lengths:
                    hashes = shingle_hashes(words, length)
                    place = np.nonzero(probe(every.value, hashes))[0]
                    places.append((length, place, hashes[place]))
                hashes = np.unique(np.concatenate([h for _, _, h in places])) if places else np.empty(0, np.uint64)
                classes = sum(1 << c for c, bits in filters.value.items()
                              if len(hashes) >= least_hits(c) and probe(bits, hashes).sum() >= least_hits(c))
                if not classes:
                    continue
                hits = {b" ".join(words[k:k + length]).decode() for length, place, _ in places for k in place.tolist()}
                at += [row] * len(hits)
                passed += [classes] * len(hits)
                texts += hits
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(passed, pa.int64()),
                                              pa.array(texts, pa.string())], ["__doc", "doc_id", "classes", "shingle"])

    return (bounded_batches(docs)
            .select(text_key(F.col("doc_id").cast("long")).alias("__doc"), F.col("doc_id").cast("long"), text_bytes().alias("text"))
            .mapInArrow(run, "__doc string, doc_id long, classes long, shingle string"))


def _matches(docs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """(__doc, __item, doc_id, item_id, item_shingles, shared, size_class, containment) of rows, whatever their ids."""
    shingles = stored(item_shingles(items, threshold))
    found = stored(screened(docs, shingles).distinct())
    hits = found.join(shingles, "shingle").where(F.expr("(shiftright(classes, size_class) & 1L) = 1L"))
    return (hits.groupBy("__doc", "__item")
            .agg(F.max("doc_id").alias("doc_id"), F.max("item_id").alias("item_id"),
                 F.max("item_shingles").alias("item_shingles"), F.count("*").alias("shared"),
                 F.max("size_class").alias("size_class"), F.sum(F.col("in_sketch").cast("int")).alias("__hits"))
            .withColumn("containment", F.col("shared") / F.col("item_shingles"))
            .where((F.col("__hits") > F.col("size_class")) & (F.col("containment") >= threshold)).drop("__hits"))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared, size_class, containment) for each item that a document contains.

    Of several texts under one id the pair with the largest containment, then size, is reported; null ids are not.
    """
    best = F.max(F.struct("containment", "item_shingles", "shared", "size_class")).alias("best")
    return (_matches(docs, items, threshold).where("doc_id is not null and item_id is not null")
            .groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", *[f"best.{c}" for c in ("item_shingles", "shared", "size_class", "containment")]))


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """The rows that contain no item, whatever the ids of either."""
    bad = _matches(docs, items, threshold).select("__doc").distinct()
    keyed = docs.withColumn("__doc", text_key(F.col("doc_id").cast("long")))
    return keyed.join(bad, "__doc", "left_anti").select(*docs.columns)


def _sql_class(ranges: tuple[tuple[int, int], ...]) -> str:
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


_SQL_WORDS = (f"regexp_extract_all(regexp_replace(regexp_replace(lower(text), '[{_sql_class(MARKS)}]', ' ', 'g'), "
              f"'([{_sql_class(ALONE)}])', ' \\1 ', 'g'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')")


def _sql_shingles(length: str) -> str:
    return f"unnest(list_transform(range(len(w) - {length} + 1), lambda k: array_to_string(w[k + 1:k + {length}], ' ')))"


ORACLE_SQL = f"""
WITH d AS (SELECT DISTINCT doc_id, md5(coalesce(text, '')) x, {_SQL_WORDS} w FROM documents),
b AS (SELECT DISTINCT item_id, md5(coalesce(text, '')) y, {_SQL_WORDS} w FROM benchmark),
l AS (SELECT item_id, y, w, least(len(w), {SHINGLE_WORDS}) n FROM b WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, y, {_sql_shingles('n')} s FROM l),
ds AS (SELECT DISTINCT doc_id, x, {_sql_shingles('n')} s FROM d, (SELECT DISTINCT n FROM l) WHERE len(w) >= n),
size AS (SELECT item_id, y, count(*) AS item_shingles FROM bs GROUP BY item_id, y),
hit AS (SELECT doc_id, x, item_id, y, count(*) AS shared FROM ds JOIN bs USING (s) GROUP BY doc_id, x, item_id, y),
found AS (SELECT doc_id, item_id, item_shingles, shared, CAST(floor(log2(item_shingles)) AS INTEGER) AS size_class,
            shared / item_shingles AS containment
          FROM hit JOIN size USING (item_id, y) WHERE shared / item_shingles >= {CONTAINMENT})
SELECT * FROM found WHERE doc_id IS NOT NULL AND item_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY containment DESC, item_shingles DESC, shared DESC, size_class DESC) = 1
"""
