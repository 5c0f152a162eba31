"""Exact deduplication with static binary-fuse filters.

Texts are equal when they are identical after white space is deleted; the SHA-256 of what is left names an exact
bucket.  Digests of an immutable snapshot are split into buckets of bounded size by their hash, and each bucket gets
a static 3-wise binary-fuse filter (8-bit fingerprints, about 9 bits a key) that is built once and kept.  A new batch
is first grouped on its own; its distinct digests are screened by the filters of their buckets, and only positives
are joined with the snapshot's exact buckets, where the texts are compared.  A filter has no false negatives, so
nothing is missed; a false positive finds no bucket; unequal texts of snapshot and batch under one digest stay apart
(inside either side, the digest alone decides).

Of equal texts the row with the most code points stays, then the smallest doc_id.

Defined cases: a null text counts as empty, and all texts without other characters than white space are equal; a
null doc_id loses against any other; repeated rows of one id count towards the group's size and share the decision
of their id; empty snapshots and empty batches give filters for nothing and no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.bloom import filter_of, probe
from orderflow.llm.common import bounded_batches, key_text, stored

#: Distinct digests in a bucket and its filter, on average.
BUCKET_KEYS = 20_000
#: Seeds tried before a filter's bucket is given more room.
ATTEMPTS = 8
FILTER = "bucket long, seed long, segment int, segments int, keys long, fingerprints binary"


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of key plus seed."""
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed)
        for shift in (33, 29):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(32))


@dataclass
class FuseFilter:
    """Static filter: a key is in when its fingerprint is the xor of three slots in neighbouring segments."""

    seed: int
    segment: int
    segments: int
    fingerprints: np.ndarray

    def _slots(self, mixed: np.ndarray) -> np.ndarray:
        span = np.uint64(self.segments)
        first = ((mixed >> np.uint64(40)) * span) >> np.uint64(24)
        mask, width = np.uint64(self.segment - 1), np.uint64(self.segment)
        inside = [mixed & mask, (mixed >> np.uint64(13)) & mask, (mixed >> np.uint64(26)) & mask]
        return np.stack([(first + np.uint64(k)) * width + inside[k] for k in range(3)]).astype(np.int64)

    @staticmethod
    def _prints(mixed: np.ndarray) -> np.ndarray:
        return ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(7)).astype(np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.fingerprints):
            return np.zeros(len(keys), bool)
        mixed = _mix(keys, self.seed)
        a, b, c = self._slots(mixed)
        return self.fingerprints[a] ^ self.fingerprints[b] ^ self.fingerprints[c] == self._prints(mixed)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """Filter of distinct 64-bit keys, by peeling; another seed, then more room, where peeling gets stuck."""
        keys = np.unique(keys)
        if not len(keys):
            return cls(0, 1, 1, np.empty(0, np.uint8))
        n = len(keys)
        width = 1 << max(2, min(12, int(np.log(n) / np.log(3.33) + 2.25))) if n > 1 else 4
        room = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2))) + 8 / n
        for attempt in range(1, 1 << 10):
            segments = max(1, -(-int(n * room) // width) - 2)
            made = cls(attempt, width, segments, np.zeros((segments + 2) * width, np.uint8))
            if made._peel(_mix(keys, attempt)):
                return made
            if attempt % ATTEMPTS == 0:
                room *= 1.25
        raise ValueError("no filter found")

    def _peel(self, mixed: np.ndarray) -> bool:
        """Slots with a single key are emptied round by round, then filled in reverse; False when a core remains."""
        slots, prints = self._slots(mixed), self._prints(mixed)
        count = np.bincount(slots.ravel(), minlength=len(self.fingerprints))
        which = np.zeros(len(self.fingerprints), np.int64)
        for row in slots:
            np.bitwise_xor.at(which, row, np.arange(len(mixed)))
        rounds, left, frontier = [], len(mixed), np.nonzero(count == 1)[0]
        while len(frontier):
            own, at = np.unique(which[frontier], return_index=True)
            slot = frontier[at]
            rounds.append((own, slot))
            left -= len(own)
            touched = slots[:, own]
            np.subtract.at(count, touched.ravel(), 1)
            np.bitwise_xor.at(which, touched.ravel(), np.tile(own, 3))
            touched = np.unique(touched)
            frontier = touched[count[touched] == 1]
        if left:
            return False
        for own, slot in reversed(rounds):
            a, b, c = slots[:, own]
            # The own slot is still zero, so the xor of all three is that of the other two.
            self.fingerprints[slot] = prints[own] ^ self.fingerprints[a] ^ self.fingerprints[b] ^ self.fingerprints[c]
        return True


def normalised(text: str = "text") -> Column:
    """The text without the characters of [\\x20\\x09-\\x0D]."""
    out = F.coalesce(F.col(text), F.lit(""))
    for blank in " \n\t\r\x0b\x0c":
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def build_filters(digests: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of a snapshot's distinct digests (column ``key``, a 64-bit hash of the digest)."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = FuseFilter.build(rows["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "seed": [made.seed], "segment": [made.segment],
                             "segments": [made.segments], "keys": [len(rows)], "fingerprints": [made.fingerprints.tobytes()]})

    return digests.select(F.pmod("key", F.lit(buckets)).alias("bucket"), "key").groupBy("bucket").applyInPandas(build, FILTER)


def screen(digests: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The rows (digest, key) that their bucket's filter may hold."""

    def test(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(rows):
            return rows[["digest", "key"]].iloc[:0]
        f = own.iloc[0]
        made = FuseFilter(int(f.seed), int(f.segment), int(f.segments), np.frombuffer(f.fingerprints, np.uint8))
        return rows.loc[made.holds(rows["key"].to_numpy().view(np.uint64)), ["digest", "key"]]

    rows = digests.select(F.pmod("key", F.lit(buckets)).alias("bucket"), "digest", "key")
    return filters.groupBy("bucket").cogroup(rows.groupBy("bucket")).applyInPandas(test, "digest string, key long")


def _groups(rows: DataFrame) -> DataFrame:
    """(digest, key, best, n): the row that stays of each exact bucket, and its size."""
    best = F.max(F.struct("chars", (-F.col("doc_id")).alias("lowest"), "doc_id")).alias("best")
    return rows.groupBy("digest").agg(best, F.count("*").alias("n")).withColumn("key", F.xxhash64("digest"))


def deduplicate(docs: DataFrame, incoming: Column, filters: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and whether it came with the new batch.

    ``incoming`` tells the rows of the new batch from those of the snapshot.  ``filters`` are the snapshot's, if they
    have been kept from an earlier batch (with their number of ``buckets``); else they are built here.
    """
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(incoming, F.lit(False)).alias("incoming"),
                              F.sha2(normalised(), 256).alias("digest"),
                              F.length(F.coalesce("text", F.lit(""))).alias("chars")))
    old, new = (stored(_groups(rows.where(F.col("incoming") == side))) for side in (False, True))
    buckets = buckets or max(1, max(old.count(), new.count()) // BUCKET_KEYS)
    if filters is None:
        filters = stored(build_filters(old.select("key"), buckets))
    positive = screen(new.select("digest", "key"), filters, buckets).select("digest")
    both = stored(positive.join(new.select("digest", F.col("best").alias("new_best"), F.col("n").alias("new_n")), "digest")
                  .join(old.select("digest", F.col("best").alias("old_best"), F.col("n").alias("old_n")), "digest"))
    same = stored(_same_bytes(docs, both))
    merged = both.join(same, "digest").select("digest", F.greatest("new_best", "old_best").alias("best"),
                                              (F.col("new_n") + F.col("old_n")).alias("n"))
    apart = (old.withColumn("incoming", F.lit(False)).unionByName(new.withColumn("incoming", F.lit(True)))
             .join(merged.withColumnsRenamed({"best": "all_best", "n": "all_n"}), "digest", "left")
             .select("digest", "incoming", F.coalesce("all_best", "best")["doc_id"].alias("keep_id"),
                     F.coalesce("all_n", "n").alias("group_size")))
    return (rows.join(apart, ["digest", "incoming"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("digest").alias("text_sha256"), "incoming"))


def _texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(id, text) of the rows whose ``key_text`` id is among ``keys`` (column ``id``), and of few others.

    A Bloom filter of fixed size goes to the rows, so texts that nobody asks for are not shuffled.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(filter_of(keys.select(F.xxhash64("id").alias("hash"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = probe(wanted.value, batch.column(0).to_numpy().view(np.uint64))
            if found.any():
                picked = batch.filter(pa.array(found))
                yield pa.RecordBatch.from_arrays([picked.column(1), picked.column(2)], ["id", "text"])

    rows = bounded_batches(docs).select(key_text(F.col("doc_id").cast("long")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select(F.xxhash64("id").alias("hash"), "id", "text").mapInArrow(run, "id string, text string")


def _same_bytes(docs: DataFrame, both: DataFrame) -> DataFrame:
    """Digests under which the snapshot's text and the batch's text are the same, compared as texts.

    Only the texts of the positives' representatives move.  They are found by a merge join at every size.
    """
    ends = both.select("digest", F.explode(F.array("new_best.doc_id", "old_best.doc_id")).alias("id"))
    ends = stored(ends.select("digest", key_text(F.col("id")).alias("id")).distinct())
    texts = (_texts_of(docs, ends.select("id")).select("id", normalised().alias("text"))
             .withColumn("digest", F.sha2("text", 256)).join(ends.hint("merge"), ["digest", "id"]))
    return texts.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a = b").select("digest")


ORACLE_SQL = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) c,
        sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY c DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""
