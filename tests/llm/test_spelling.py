import random
import re
from collections import Counter, defaultdict
from zlib import crc32

from orderflow.llm import spelling as m


def distance_one(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def counted(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def expected(counts):
    near = {w: [x for x in counts if distance_one(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out, key=str)


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_words(seed, letters, low, high, n):
    rnd = random.Random(seed)
    return {"".join(rnd.choice(letters) for _ in range(rnd.randint(low, high))): rnd.randint(3, 60) for _ in range(n)}


def test_against_all_pairs(spark):
    """Dense words of two and six letters, chains of every length, and many words with one beginning."""
    counts = random_words(1, "ab", 5, 9, 300) | random_words(2, "abcdeé", 5, 6, 400)
    counts |= {"a" * k: 3 + 2 ** (k % 7) for k in range(5, 17)} | {"b" + "a" * k: 9 for k in range(4, 15)}
    counts |= {"prefix" + x + y: 3 + ord(x) for x in "abcdefgh" for y in ("", "x", "y", "xy", "yx")}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert rows(m.variants(df)) == expected(counts)


def test_documents(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    counts = counted(docs)
    got = {r.word: r.n for r in m.words_of(documents).collect()}
    assert got == counts
    assert any(len(w) > 5 for w in got)


def test_runs_and_letters(spark):
    docs = [(k, "Ähnlich ÄHNLICH ähnlich straßen4you Straßen-ecke naïve×naïve") for k in range(12)]
    docs += [(None, "rowwithoutid"), (None, "rowwithoutid"), (None, "ROWWITHOUTID"), (7, "twice twice twice"), (7, "twice twice twice")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.word: r.n for r in m.words_of(df).collect()} == counted(docs)


def test_very_long_word(spark):
    long_word = "ab" * 10_000
    counts = {long_word: 5, long_word[:-1]: 50, long_word[:10_000] + long_word[10_001:]: 4, "short": 3}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near) for r in m.variants(df).collect()}
    assert got[long_word] == (long_word[:-1], long_word[:-1], 2) and got["short"] == (None, "short", 0)


def test_odd_and_empty(spark, odd, none):
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert rows(m.spelling_variants(odd)) == expected(counted(docs))
    assert rows(m.spelling_variants(none)) == []


def test_counts_are_handed_on(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(m, "HELD_WORDS", 3)
    text = " ".join(f"words{chr(97 + k)}" for k in range(20))
    batch = pa.RecordBatch.from_arrays([pa.array(["1", "2"]), pa.array([text.encode()] * 2)], ["doc_id", "text"])
    total = defaultdict(int)
    for out in m._counts(iter([batch])):
        for w, n in zip(*(c.to_pylist() for c in out.columns)):
            total[w] += n
    want = Counter()
    for doc_id in ("1", "2"):
        for run in text.split():
            h = crc32(f"{doc_id}:{run}".encode())
            run = run[:h % 6] + run[h % 6 + 1:] if h % 97 == 0 else run
            want[run] += len(run) >= 5
    assert dict(total) == dict(want)


def ided(spark, counts):
    return m.stored(spark.createDataFrame([(k, w, n) for k, (w, n) in enumerate(counts.items())], "id long, word string, n long"))


def test_trie_holds_words_from_before_their_middle_on(spark):
    """Nodes near the root hold short words alone, however many long ones begin alike; every pair is still found."""
    counts = {"ab" + w: n for w, n in random_words(4, "abcd", 3, 20, 300).items()}
    words = ided(spark, counts)
    paths, _ = m.trie(words)
    got = [(len(r.o), r.back, [p.k for p in r.path]) for r in paths.collect()]
    assert len(got) == 2 * len(counts)
    assert all(size == ks[-1] and ks[0] >= (size - 1 + back) // 2 for size, back, ks in got)
    near = {(r.id, r.near_word) for r in m.neighbours(words).collect()}
    assert near == {(k, x) for k, w in enumerate(counts) for x in counts if distance_one(w, x)}


def test_states_that_no_word_ends_are_not_made(spark):
    """Of four letters the next one fits often, all that follow it hardly ever (by the next letter alone: 1293 states)."""
    words = ided(spark, random_words(3, "abcd", 7, 8, 600))
    assert m._edited(*m.trie(words)).where("near is null").count() <= 300
