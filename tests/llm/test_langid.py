from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import langid as m
from orderflow.llm.queries import op13_byte_network

SF = "/root/testdata/sf0.01"


def test_windows_hold_every_run():
    texts = [b"", b"a", b"x" * 128, b"y" * 129, bytes(range(97, 123)) * 40, b"1234" * 100 + b"word"]
    flat, starts, owners = m.windows_of(texts)
    for k, text in enumerate(texts):
        mine = [w.tobytes() for w in m.cut(flat, starts[owners == k])]
        runs = {text[i:i + 4] for i in range(max(1, len(text) - 3)) if any(c > 57 for c in text[i:i + 4])}
        assert all(any(r in w for w in mine) for r in runs)
        assert all(any(97 <= c for c in w) for w in mine)
    assert set(owners) == {1, 2, 3, 4, 5}


def test_gradients():
    rng = np.random.default_rng(1)
    model = m.ByteNetwork.start(("a", "b", "c"))
    for name in ("embedding", "top", "top_bias"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    model.filters = [f.astype(np.float64) for f in model.filters]
    model.biases = [b.astype(np.float64) for b in model.biases]
    windows, labels = rng.integers(97, 123, (4, m.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0])
    _, slopes = model.gradients(windows, labels)
    for p, g in zip(model.parameters(), slopes):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in p.shape)
            at = (int(windows[0, 5]), *at[1:]) if p.shape[0] == 256 else at
            kept, step = p[at], 1e-6
            p[at] = kept + step
            high = model.gradients(windows, labels)[0]
            p[at] = kept - step
            low = model.gradients(windows, labels)[0]
            p[at] = kept
            assert g[at] == pytest.approx((high - low) / (2 * step), rel=1e-3, abs=1e-7)


def test_responses_are_convolutions():
    model = m.ByteNetwork.start(("a", "b"))
    window = np.frombuffer((b"some words " * 20)[:m.WINDOW], np.uint8)[None]
    for w, weights, got in zip(m.WIDTHS, model.filters, model.responses(window)):
        for i in (0, 7, m.WINDOW - w):
            want = sum(model.embedding[window[0, i + j]] @ weights[j * m.EMBEDDING:(j + 1) * m.EMBEDDING] for j in range(w))
            assert np.allclose(got[0, i], want, atol=1e-5)


def test_whole_texts_count():
    model = m.ByteNetwork.start(("a", "b"))
    texts = [("eins zwei drei " * 300 + "one two three " * 100).encode(), b"short", ("1" * 5000 + " tail").encode()]
    for text, (lang, score) in zip(texts, model.predict(texts)):
        flat, starts, _ = m.windows_of([text])
        weight = m.letters_in(flat, starts)
        odds = (model.probabilities(m.cut(flat, starts)) * weight[:, None]).sum(axis=0) / weight.sum()
        assert lang == model.languages[odds.argmax()] and score == pytest.approx(odds.max(), abs=1e-6)


def test_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = op13_byte_network(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    for name in set(lang.values()):  # a constant would be right for one language only
        mine = [r for r in held if lang[r.doc_id] == name]
        assert len(mine) > 20 and sum(r.lang_pred == name for r in mine) >= 0.97 * len(mine)
        assert sum(r.lang_pred == name for r in held) <= 1.03 * len(mine)


def test_odd_rows(spark, odd, none):
    model = m.fit_languages(odd)
    assert model.languages == ("en",)
    got = sorted((tuple(r) for r in m.identify(odd, model).collect()), key=str)
    want = [(r.doc_id, *(("en", 1.0) if r.text and m.has_letter(r.text) else ("und", 0.0))) for r in odd.collect()]
    assert got == sorted(want, key=str)
    empty = m.fit_languages(none)
    assert empty.languages == () and m.identify(none, model).collect() == []
    assert {r.lang_pred for r in m.identify(odd, empty).collect()} == {"und"}


def test_sample_is_bounded_and_copies_count_once(spark):
    rows = [(k, f"texte numéro {k} avec des mots", "fr") for k in range(3000)]
    rows += [(k, "the very same words in every copy", "en") for k in range(3000, 6000)]
    rows += [(None, "no id", "xx"), (9000, None, "yy"), (9001, "no language", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = m.labelled_windows(df, F.lit(True), rows=200).groupBy("lang").count().collect()
    counts = {r["lang"]: r["count"] for r in found}
    assert counts["en"] == 1 and 50 <= counts["fr"] <= 160 and set(counts) == {"en", "fr"}
