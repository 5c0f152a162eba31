import re

import pytest

from orderflow.llm import decontaminate as m
from tests.llm.conftest import odd_rows


ALONE = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
MARKS = "\x80-\xbf\xd7\xf7\u2000-\u206f\u3000-\u303f\uff00-\uff0f\uff1a-\uff20"


def words_of(text):
    """Letter by letter."""
    out, run = [], ""
    for c in (text or "").lower() + " ":
        alone = re.match(f"[{ALONE}]", c)
        if not alone and (re.match("[0-9a-z]", c) or ord(c) >= 128 and not re.match(f"[{MARKS}]", c)):
            run += c
            continue
        out += [run] * bool(run) + [c] * bool(alone)
        run = ""
    return out


def matched(docs, items):
    """(place of document, item id, shingles, shared) of every document and item, whatever their ids."""
    out = []
    words = [words_of(t) for _, t in docs]
    for item, text in items:
        w = words_of(text)
        n = min(5, len(w))
        own = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
        for place, have in enumerate(words):
            shared = sum(s in {tuple(have[k:k + n]) for k in range(len(have) - n + 1)} for s in own)
            if own and shared >= 0.8 * len(own):
                out.append((place, item, len(own), shared))
    return out


def expected(docs, items):
    """Pairs of ids with their best match."""
    best = {}
    for place, item, n, shared in matched(docs, items):
        doc = docs[place][0]
        if doc is not None and item is not None:
            best[doc, item] = max(best.get((doc, item), (0, 0, 0)), (shared / n, n, shared))
    return sorted((d, i, n, shared) for (d, i), (_, n, shared) in best.items())


def test_against_all_pairs(spark):
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(words[k * 11:k * 11 + 6 + k])) for k in range(25)] + [(90, "solo"), (91, None), (92, ""), (None, "x y"),
                                                                               (93, "two words"), (94, " ".join(words[:6])), (95, "Ünï cödé tèxt wörds hére now")]
    long_text = " ".join(words)
    docs = [(1, "pre " + " ".join(words[:6]) + " post"), (2, long_text * 3), (3, "W0, w1; W2 w3\nw4 - w5!"), (4, " ".join(words[11:16])), (5, None), (6, ""),
            (7, "Solo"), (8, "two words more"), (9, "two words"), (None, long_text), (10, " ".join(words[250:262]) + " x " + " ".join(words[262:275])),
            (11, "ÜNÏ CÖDÉ TÈXT WÖRDS HÉRE NOW"), (12, long_text + " solo"), (13, " ".join(reversed(words)))]
    docs += [(100 + k, "x " * k + " ".join(words[k * 11:k * 11 + 4 + k]) + " tail " + " ".join(words[k * 11 + 4 + k:])) for k in range(25)]
    ddf = spark.createDataFrame([(*d, "c") for d in docs] + [(3, docs[2][1], "c")], "doc_id long, text string, item_id string").repartition(4)
    idf = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in m.contained_items(ddf.drop("item_id"), idf).select("doc_id", "item_id", "item_shingles", "shared").collect())
    assert got == expected(docs, items) and {r[0] for r in got} > {1, 2, 3, 7, 9, 11}
    kept = m.drop_contaminated(ddf, idf)
    rows = [*docs, (3, docs[2][1])]
    bad = {place for place, *_ in matched(rows, items)}
    assert kept.columns == ddf.columns and any(rows[k][0] is None for k in bad)
    assert sorted(str(tuple(r)[:2]) for r in kept.collect()) == sorted(str(r) for k, r in enumerate(rows) if k not in bad)


def test_odd_rows_and_empty(spark, odd, none):
    items = spark.createDataFrame([(1, "ONE two three, four five six seven!"), (2, "nothing like this at all here")], "item_id long, text string")
    got = {r.doc_id for r in m.contained_items(odd, items).collect()}
    assert got == {1, 2, 3}
    assert m.contained_items(none, items).count() == 0 and m.contained_items(odd, items.limit(0)).count() == 0
    assert [r[0] for r in expected([x[:2] for x in odd_rows()], [(1, "one two three four five six seven")])] == [1, 2, 3]


def test_sketch_never_misses():
    """Whatever fifth of an item's shingles is lost, as many of the sketch are left as its class asks for."""
    for size in range(1, 5000):
        lost, size_class = int((1 - 0.8 + 1e-9) * size), size.bit_length() - 1
        sketch = lost + m.least_hits(size_class)
        assert sketch <= size and sketch - lost >= m.least_hits(size_class)
        assert size - lost <= -(-8 * size // 10)


def test_short_items_and_scripts_without_spaces(spark):
    """Items of one to four words, and of characters, inside long documents and across marks."""
    filler = " ".join(f"f{k}" for k in range(300))
    items = [(1, "Capital of France"), (2, "yes"), (3, "two words"), (4, "what is the answer"), (5, "日本の首都は東京です"), (6, "東京"),
             (7, "ประเทศไทย"), (8, "«quoted» “words” of—five—six"), (9, "capital of france")]
    docs = [(1, f"{filler} the capital of France, {filler}"), (2, f"{filler} yes. {filler}"), (3, f"two {filler} words"),
            (4, f"{filler} two words"), (5, f"何か日本の首都は東京ですか？{filler}"), (6, "東 京 タワー"), (7, f"ใน ประเทศไทย {filler}"),
            (8, "quoted words of five six"), (9, "What is the Answer?"), (10, "the yeses of capital France"), (11, "首都は東京です"), (12, None)]
    ddf, idf = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in m.contained_items(ddf, idf).select("doc_id", "item_id", "item_shingles", "shared").collect())
    assert got == expected(docs, items)
    assert {(1, 1), (1, 9), (2, 2), (4, 3), (5, 5), (5, 6), (6, 6), (7, 7), (8, 8), (9, 4)} <= {r[:2] for r in got}
    assert not {3, 10, 12} & {r[0] for r in got}
    con = pytest.importorskip("duckdb").connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    assert sorted(r[:4] for r in con.execute(m.ORACLE_SQL).fetchall()) == got


def test_classes_screen_for_themselves(spark):
    """A document with a few stray shingles of a large item does not pass the large items' class."""
    words = [f"w{k}" for k in range(80)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(f"v{k}" for k in range(7)))], "item_id long, text string")
    shingles = m.item_shingles(items)
    assert {(r.item_id, r.size_class) for r in shingles.collect()} == {(1, 6), (2, 1)}
    docs = spark.createDataFrame([(1, " ".join(words[:7])), (2, "x v0 v1 v2 v3 v4 v5 v6 y " + " ".join(words[:6])), (3, " ".join(words[:70]))],
                                 "doc_id long, text string")
    assert {(r.doc_id, r.classes) for r in m.screened(docs, shingles).collect()} == {(2, 1 << 1), (3, 1 << 6)}


def test_null_and_repeated_ids(spark):
    """Rows are screened one by one: null ids on either side, and different texts under one id."""
    passage, second, third = (" ".join(f"{c}{k}" for k in range(20)) for c in "abc")
    items = spark.createDataFrame([(1, passage), (1, second), (None, third)], "item_id long, text string")
    rows = [(None, f"x {passage} y"), (None, "clean text without any passage in it"), (5, f"{second} tail"), (5, "five has a clean text too"),
            (6, f"head {third}"), (7, f"{passage} {second}"), (8, None), (None, None), (None, f"{third} again"), (9, "clean nine of five words")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_shingles int").repartition(3)
    kept = m.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    want = [r for r in rows if not any(p in (r[1] or "") for p in (passage, second, third))]
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=str) == sorted(want, key=str)
    got = sorted(tuple(r) for r in m.contained_items(docs, items).select("doc_id", "item_id", "item_shingles", "shared").collect())
    assert got == [(5, 1, 16, 16), (7, 1, 16, 16)]
