"""Spelling variant grouping: a relational trie walked by a frontier of (word, position, node, edits) states.

Every word stands in a trie, and spelt backwards in a second one.  Nodes are hashes of prefixes; chains of nodes
without a branch are one edge, whose label is the letters between.  The distributed edge table has one row per node
with the edges that leave it (at most one per letter of the alphabet).

A state without edits follows its own word, so its positions are read off the word's path.  Where another edge
leaves the path, the word may differ from its neighbour there: replacing, inserting or deleting one letter makes a
state with one edit, which then has to match letter by letter.  These states are joined with the edge table level by
level until none is left; one that has used up its word at the end of another word has found a neighbour.  The place
of an edit is the first letter in which two words differ.  If it lies in the front half, the backward trie has it in
its own rear half, so either trie is entered from the middle of a word on only, and together they miss nothing.  As
neighbours differ by at most one in length, a word stands in either trie from just before its own middle on only:
nodes near the root hold short words alone and have few edges.  Every edge has a Bloom mask of the letters that still
follow its child, up to the end of a word; a state that these cannot continue is dropped when it is made.

The form of a word is its most frequent neighbour (ties: smallest in code point order) if that is at least ``RATIO``
times as frequent; following forms to the last gives the root.  Frequencies at least double at each step, so the
pointers are doubled a bounded number of times.

Defined cases: a null or empty text has no words; a null id counts as the text ``null`` in the id's place; repeated
rows count each time; words of any length are handled, rounds grow with the branching nodes behind an edit, not with
the letters; a collision of two prefix hashes adds states but no neighbours, as found words are compared letter by
letter; an empty table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import bounded_batches, stored, text_bytes

MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2
#: One run in this many, by checksum, loses a letter.
TYPO_EVERY = 97
#: Bits that tell which ends of words follow a node.
MASK = 64
#: Words that a task counts before it hands the counts on.
HELD_WORDS = 100_000
#: Runs of too few letters make no word, with or without a letter less.
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return made

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            # Lower-casing bytes changes A-Z only.
            runs = Counter(_RUN.findall(text.as_py().lower().decode("utf-8", "replace")))
            begin = crc32(f"{doc_id}:".encode())
            for run, n in runs.items():
                h = crc32(run.encode(), begin)
                if h % TYPO_EVERY == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < MIN_LETTERS:
                        continue
                held[run] += n
            if len(held) >= HELD_WORDS:
                yield out()
    yield out()


def words_of(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """(word, n) of every word with at least ``least`` occurrences in all documents."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return (bounded_batches(docs).select(key, text_bytes()).mapInArrow(_counts, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def _middle(size: np.ndarray, back: bool) -> np.ndarray:
    """The first position at which words of these sizes enter the forward or the backward trie."""
    return (size + back) // 2


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, back, k, node, letter): the node that a word passes after k letters, and the letter that follows (0: none)."""
    for batch in batches:
        for back in (False, True):
            words = [w[::-1] if back else w for w in batch.column(1).to_pylist()]
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            if not len(words):
                continue
            codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
            begin = np.cumsum(sizes) - sizes
            place = np.arange(len(codes)) - np.repeat(begin, sizes)
            with np.errstate(over="ignore"):
                powers = np.cumprod(np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64))
                total = np.concatenate([[np.uint64(0)], np.cumsum((codes * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)) * powers[place])])
                # The row after a word's last letter is its end; no neighbour enters before its own middle.
                first = _middle(np.maximum(sizes - 1, 0), back)
                rows = sizes - first + 1
                k = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows - first, rows)
                own = np.repeat(np.arange(len(words)), rows)
                node = total[begin[own] + k] - total[begin[own]] + np.uint64(back) * np.uint64(0xA0761D6478BD642F) + k.astype(np.uint64)
                for shift in (32, 29):
                    node = (node ^ (node >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
                node ^= node >> np.uint64(32)
            letters = np.append(codes, np.uint64(0))[begin[own] + k]
            letters[k == sizes[own]] = 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own)), pa.array(np.full(len(k), back)), pa.array(k.astype(np.int32)),
                 pa.array(node.view(np.int64)), pa.array(letters.astype(np.int32))], ["id", "back", "k", "node", "letter"])


def _piece(begin: Column, size: Column) -> Column:
    """Letters of the word ``o`` from a position (from 0) on."""
    return F.substring(F.col("o"), begin + 1, size)


def _end_bit(begin: Column) -> Column:
    """The bit of a mask that stands for the letters of the word ``o`` from a position on."""
    return F.pmod(F.xxhash64(_piece(begin, F.length("o"))), F.lit(MASK)).cast("int")


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paths, edges) of (id, word) rows.

    Paths have one row per word and direction: id, back, o (the word as spelt there) and path, its nodes that branch
    or end a word, as (k, node).  Edges have one row per node: node and edges, its (head, body, m, child, follow, word),
    the label's first letter, its others and its length, and the id of the word that ends at the child; the node's own
    word stands under an empty label.  ``follow`` has a bit for every end of a word behind the child (ends share bits),
    so that dead states go at once.
    """
    passed = words.select("id", "word").mapInArrow(_prefixes, "id long, back boolean, k int, node long, letter int")
    passed = stored(passed)
    branching = (passed.groupBy("node").agg(F.min("letter").alias("a"), F.max("letter").alias("b"))
                 .where("a = 0 or a < b"))
    paths = (passed.join(branching.select("node"), "node")
             .groupBy("id", "back").agg(F.sort_array(F.collect_list(F.struct("k", "node"))).alias("path"))
             .join(words.select("id", "word"), "id")
             .select("id", "back", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("o"), "path"))
    paths = stored(paths)
    step = F.zip_with(F.slice("path", F.lit(1), F.size("path") - 1), F.slice("path", F.lit(2), F.size("path")),
                      lambda a, b: F.struct(a["node"].alias("node"), a["k"].alias("k"), b["node"].alias("child"),
                                            b["k"].alias("to")))
    inner = (paths.select("id", "o", F.explode(step).alias("s")).select("id", "o", "s.*")
             .select("node", _piece(F.col("k"), F.col("to") - F.col("k")).alias("label"), "child",
                     F.call_function("shiftleft", F.lit(1).cast("long"), _end_bit(F.col("to"))).alias("follow"),
                     F.when(F.col("to") == F.length("o"), F.col("id")).alias("word")))
    ends = paths.select(F.element_at("path", -1)["node"].alias("node"), F.lit("").alias("label"),
                        F.lit(None).cast("long").alias("child"), F.lit(0).cast("long").alias("follow"), F.col("id").alias("word"))
    edges = (inner.unionByName(ends).groupBy("node", "label", "child").agg(F.bit_or("follow").alias("follow"), F.max("word").alias("word"))
             .groupBy("node").agg(F.collect_list(F.struct(
                 F.substring("label", 1, 1).alias("head"), F.substring("label", F.lit(2), F.length("label")).alias("body"),
                 F.length("label").alias("m"), "child", "follow", "word")).alias("edges")))
    return paths, stored(edges)


def _moved(states: DataFrame, edges: DataFrame, positions: list[Column]) -> DataFrame:
    """States moved along the edges of their node: every position of ``positions`` that is not null is taken.

    The expressions see the edge and the letters from the state's position on (``rest``), without the first (``rest1``)
    and without the first two (``rest2``).  The result has the states that go on and, with a ``near`` word, those that
    are done; a state that no edge can continue is dropped.
    """
    size = F.length("o")
    rests = {name: _piece(F.col("position") + k, size) for k, name in enumerate(("rest", "rest1", "rest2"))}
    # Most edges take no state on: these rows go before an array is made.
    return (states.join(edges, "node").withColumns(rests).withColumn("e", F.explode("edges"))
            .select("id", "back", "o", "position", *rests, "e.*")
            .where(F.coalesce(*positions).isNotNull())
            .withColumn("at", F.explode(F.array(*positions)))
            .where(F.when(F.col("at") == size, F.col("word").isNotNull()).otherwise(
                (F.col("at") < size) & (F.getbit("follow", _end_bit(F.col("at"))) == 1)))
            .select("id", "back", "o", F.col("at").alias("position"), F.col("child").alias("node"), F.lit(1).alias("edits"),
                    F.when(F.col("at") == size, F.col("word")).alias("near")))


def _edited(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """The states with one edit: where an edge leaves a word's path from its middle on."""
    size = F.length("o")
    middle = F.floor((size + F.col("back").cast("int")) / 2)
    states = (paths.select("id", "back", "o", F.explode(F.filter("path", lambda p: p["k"] >= middle)).alias("p"))
              .select("id", "back", "o", F.col("p.k").alias("position"), F.col("p.node").alias("node"), F.lit(0).alias("edits")))
    at, m, head, body = (F.col(c) for c in ("position", "m", "head", "body"))
    other = (m > 0) & ~F.startswith("rest", head)
    return _moved(states, edges, [
        F.when(other & (at < size) & F.startswith("rest1", body), at + m),
        F.when(other & F.startswith("rest", body), at + m - 1),
        F.when((other | (m == 0)) & (at < size) & F.startswith("rest1", head) & F.startswith("rest2", body), at + m + 1)])


def neighbours(words: DataFrame) -> DataFrame:
    """(id, near, near_word, near_n): ordered pairs of words that differ by one letter, from stored (id, word, n) rows."""
    paths, edges = trie(words)
    frontier = stored(_edited(paths, edges))
    rounds = [frontier]
    match = F.when((F.col("m") > 0) & F.startswith("rest", F.col("head")) & F.startswith("rest1", F.col("body")),
                   F.col("position") + F.col("m"))
    while True:
        going = rounds[-1].where("near is null")
        if going.isEmpty():
            break
        rounds.append(stored(_moved(going.drop("near"), edges, [match])))
    found = rounds[0].where("near is not null")
    for later in rounds[1:]:
        found = found.unionByName(later.where("near is not null"))
    pairs = found.select("id", "near", F.when(F.col("back"), F.reverse("o")).otherwise(F.col("o")).alias("word")).distinct()
    named = words.select(F.col("id").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    return pairs.join(named, "near").where(F.levenshtein("word", "near_word", 1) == 1).select("id", "near", "near_word", "near_n")


def _roots(links: DataFrame) -> DataFrame:
    """(id, root) of (id, form) rows: the last id that is reached by following forms."""
    now = stored(links.select("id", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        now = stored(now.join(further, "root", "left").select("id", F.coalesce("further", "root").alias("root"),
                                                              F.col("further").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("id", "root")
        now = now.select("id", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n) rows."""
    words = stored(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near_word", "near")).alias("best")
    near = neighbours(words).groupBy("id").agg(F.count("*").alias("n_near"), best)
    rows = words.join(near, "id", "left")
    form = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    rows = stored(rows.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(form, F.col("best.near_word")).alias("form"), F.when(form, -F.col("best.less")).alias("form_n"),
                              F.when(form, F.col("best.near")).alias("form_id")))
    roots = _roots(rows.where("form_id is not null").select("id", F.col("form_id").alias("form")))
    named = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return (rows.join(named, "id", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The words of all documents with their forms and roots."""
    return variants(words_of(docs))


#: Pairs by the one-letter deletions that they share; the checksum's table is built by rule.
ORACLE_SQL = f"""
WITH RECURSIVE bit8 AS (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
        lambda c, x: xor(c >> 1, 3988292384::BIGINT * (c & 1))) v FROM range(256) t(i)),
crc AS (SELECT list(v ORDER BY i) t FROM bit8),
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') w FROM documents),
g AS (SELECT doc_id, w, count(*) c FROM r WHERE length(w) >= {MIN_LETTERS} GROUP BY ALL),
h AS (SELECT w, c, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, 'null') || ':' || w)), '..'),
            lambda b: CAST('0x' || b AS BIGINT))),
            lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))) h FROM g, crc),
m AS (SELECT CASE WHEN h % {TYPO_EVERY} = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END w, c FROM h),
v AS (SELECT w, sum(c)::BIGINT n FROM m WHERE length(w) >= {MIN_LETTERS} GROUP BY w HAVING sum(c) >= {MIN_COUNT}),
cut AS (SELECT w, n, i, left(w, i) || substr(w, i + 2) d FROM (SELECT w, n, unnest(range(length(w))) i FROM v)),
near AS (SELECT a.w, b.w x, b.n k FROM cut a JOIN cut b ON a.d = b.d AND a.i = b.i AND a.w <> b.w
         UNION SELECT c.w, v.w, v.n FROM cut c JOIN v ON c.d = v.w UNION SELECT v.w, c.w, c.n FROM cut c JOIN v ON c.d = v.w),
best AS (SELECT w, count(*) n_near, max(k) k FROM near GROUP BY w),
f AS (SELECT v.w, v.n, coalesce(n_near, 0) n_near, CASE WHEN k >= {RATIO} * v.n THEN k END form_n,
        CASE WHEN k >= {RATIO} * v.n THEN (SELECT min(x) FROM near WHERE near.w = v.w AND near.k = best.k) END form
      FROM v LEFT JOIN best ON best.w = v.w),
chain AS (SELECT w, w AS at FROM f UNION ALL SELECT chain.w, f.form FROM chain JOIN f ON f.w = chain.at WHERE f.form IS NOT NULL),
last AS (SELECT chain.w, chain.at FROM chain JOIN f ON f.w = chain.at WHERE f.form IS NULL)
SELECT f.w AS word, form, last.at AS root, n, n_near, form_n FROM f JOIN last ON last.w = f.w
"""
