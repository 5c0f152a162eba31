import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderflow.llm import token_ans as m
from orderflow.llm.common import shared_folder
from tests.llm.conftest import odd_rows


@settings(deadline=None, max_examples=40)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=3000))
def test_coder_round_trip(ids):
    ids = np.array(ids, np.uint32)
    coder = m.Coder(m.quantise(np.bincount(ids)))
    lanes, states, words, marks = coder.encode(ids)
    assert np.array_equal(coder.decode(len(ids), states, words), ids)


def test_checkpoints_and_size():
    ids = (np.random.default_rng(0).zipf(1.4, 2 * m.LANES * m.CHECKPOINT_STEPS + 5_000) % 49_408).astype(np.uint32)
    counts = np.bincount(ids, minlength=49_408)
    coder = m.Coder(m.quantise(counts))
    lanes, states, words, marks = coder.encode(ids)
    assert len(marks) == 2
    for step, offset, at in marks:
        assert np.array_equal(coder.decode(len(ids) - step * lanes, at, words, offset), ids[step * lanes:])
    p = counts[counts > 0] / len(ids)
    assert 32 * len(words) < 1.02 * len(ids) * -(p * np.log2(p)).sum()


def test_frequencies():
    for counts in ([0, 1], [5, 0, 1 << 40], [1] * 60_000, [10 ** 9] + [1] * 60_000):
        freq = m.quantise(np.array(counts))
        assert freq.sum() == 1 << m.SCALE_BITS and ((freq > 0) == (np.array(counts) > 0)).all()


def expected(rows):
    t = Tokenizer.from_file(public_tokenizers.path(m.TOKENIZER))
    out, at = [], 0
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, m.END_ID], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_documents(spark, documents):
    folder = shared_folder(spark)
    rows = sorted((tuple(r) for r in m.encoded_documents(documents, folder).collect()), key=lambda r: r[1])
    assert rows == expected(sorted((r.doc_id, r.text) for r in documents.collect()))
    block = m.read_blocks(spark, folder).orderBy("part", "block").first()
    whole = m.Coder(m._coder(spark, folder).freq.astype(np.int64)).decode(
        block.n_ids, np.frombuffer(block.states, np.uint64), np.frombuffer(block.words, "<u4"))
    if block.checkpoints:
        part = m.read_segment(spark, folder, block.part, block.block, 0)
        assert np.array_equal(part, whole[block.checkpoints[0].step * block.lanes:])


def test_odd_rows(odd, none):
    got = sorted((tuple(r) for r in m.encoded_documents(odd).collect()), key=lambda r: r[1])
    want = {(i, n, c) for i, _, n, c in expected([r[:2] for r in odd_rows()])}
    assert {(i, n, c) for i, _, n, c in got} == want and len(got) == len(odd_rows())
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got]).tolist()[:-1]]
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert m.encoded_documents(none).count() == 0


def test_words_equal_whole_texts():
    t = Tokenizer.from_file(public_tokenizers.path(m.TOKENIZER))
    texts = ["It's  A test of <|endoftext|> ﬁ É É İSTANBUL ΣΑΣ\x1c\x85 'tis we'll 12,5% ​ 漢字𝄞",
             "á ́b \u0085 ''s 's\x0b\x0c\r\nx", "<|startoftext|>x<|endoftext|>"]
    made = m.WordTokenizer(m.TOKENIZER)
    for text in texts:
        assert np.frombuffer(made.ids([text.encode()])[0], made.kind).tolist() == t.encode(text, add_special_tokens=False).ids


def test_damage_is_noticed(spark):
    folder = shared_folder(spark)
    m.write_tokens(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), folder)
    blocks = m.read_blocks(spark, folder).toPandas()
    blocks["words_crc32"] += 1
    bad = shared_folder(spark)
    spark.createDataFrame(blocks, m.BLOCKS).write.parquet(f"{bad}/blocks")
    spark.read.parquet(f"{folder}/table").write.parquet(f"{bad}/table")
    with pytest.raises(Exception, match="damaged"):
        m.read_tokens(spark, bad).collect()
