"""Token ids in a compressed block format: a static range asymmetric numeral system (rANS).

Layout of a written corpus (``write_tokens``), two tables below one folder, written by Spark's committers:

* ``table``: symbol, frequency; the shared frequency table, quantised from the counts of all ids to a sum of
  2**``SCALE_BITS``;
* ``blocks``: one row per independent block, in ascending order of (part, block): the ids of its documents
  (``doc_ids``, ``lengths``), the number of ``ids``, interleaved ``lanes``, the lanes' first ``states``, the stream of
  32-bit ``words``, ``checkpoints`` (step, word offset, states) from which decoding can start inside the block, and
  checksums of the stream and of the decoded ids.

Documents are range-partitioned by ``doc_id``, so parts, the blocks of a part and the documents of a block ascend.
Id i of a block belongs to lane i mod lanes; a step codes one id of every lane in numpy.  Blocks end at a document's
end, once they have ``BLOCK_IDS`` ids.  Blocks decode independently of each other, with the shared table alone.

Words between ASCII white space are tokenised independently by this tokenizer, so their ids are kept in a bounded
per-process cache and only new words reach the tokenizer.

Defined cases: a null text counts as empty, an empty text is the end id alone; null ids come first; repeated ids and
rows are written each, next to each other; an empty table gives no blocks.  Extra columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.llm.common import bounded_batches, shared_folder, stored, text_bytes

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SCALE_BITS = 20
LANES = 2048
BLOCK_IDS = 1 << 19
CHECKPOINT_STEPS = 128
CACHED_WORDS = 400_000
_LOW = np.uint64(1 << 31)
_M, _32 = np.uint64(SCALE_BITS), np.uint64(32)
RAW = "part int, block int, doc_ids array<long>, lengths array<int>, kind string, ids binary"
BLOCKS = ("part int, block int, doc_ids array<long>, lengths array<int>, n_ids int, lanes int, states binary, words binary, "
          "checkpoints array<struct<step:int,offset:int,states:binary>>, words_crc32 long, ids_crc32 long")


class _WordIds(dict):
    """Ids of words, as bytes of ``kind``; unknown words are tokenised on first use.

    Words are forgotten a generation at a time: when ``CACHED_WORDS`` are held they become the old generation, from
    which words in use are taken over.
    """

    #: Latin letters, which the normalizer lower-cases one by one, and a run of marks that is a piece of its own.
    _MARKS = b".,!?;:*$#%&|"
    _PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:*$#%&|]*)")

    def __init__(self, tokenizer: object) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.kind, self._code = ("<u2", "H") if tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self._tokenizer, self._model, self._old = tokenizer, tokenizer.model, {}
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self._shown = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}

    def __missing__(self, word: bytes) -> bytes:
        ids = self._old.get(word)
        if ids is None:
            core = word.rstrip(self._MARKS)
            low = core.lower()
            if low.isalpha() and low == word:  # ASCII letters only
                ids = self._packed([t.id for t in self._model.tokenize(word.decode())])
            elif low.isalpha():
                ids = self[low] + (self[word[len(core):]] if len(core) < len(word) else b"")
            else:
                ids = self._mixed(word.decode("utf-8", "replace"))
        if len(self) >= CACHED_WORDS:
            self._old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _mixed(self, text: str) -> bytes:
        plain = self._PLAIN.fullmatch(text)
        if not plain:
            return self._packed(self._tokenizer.encode(text, add_special_tokens=False).ids)
        core = plain[1].lower()
        if core != text:
            return self[core.encode()] + (self[plain[2].encode()] if plain[2] else b"")
        return self._packed([t.id for t in self._model.tokenize(text.translate(self._shown))])

    def _packed(self, ids: list[int]) -> bytes:
        return array(self._code, ids).tobytes()


class WordTokenizer:
    """Ids of texts by a tokenizers file, given by path or by the name of a public file.

    The file's pre-tokenizer splits at white space and between letters and marks, so the model itself is asked for
    plain words, and the whole tokenizer for all others.
    """

    def __init__(self, path: str) -> None:
        import os

        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if os.sep not in path:
            import public_tokenizers

            path = public_tokenizers.path(path)
        # Kept with the imported library, so that later tasks of the same worker process find it.
        kept = vars(tokenizers).setdefault("_word_ids", {})
        if path not in kept:
            kept[path] = _WordIds(tokenizers.Tokenizer.from_file(path))
        self._words = kept[path]
        self.kind = self._words.kind

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as bytes of ``kind``."""
        known = self._words.__getitem__
        return [b"".join(map(known, text.split())) for text in texts]


def quantise(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE_BITS, at least 1 for each symbol that occurs."""
    if not counts.sum():
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, counts * float(1 << SCALE_BITS) / counts.sum()).astype(np.int64), 0)
    over = int(freq.sum()) - (1 << SCALE_BITS)
    for s in np.argsort(-freq, kind="stable"):
        if over <= 0:
            break
        take = min(over, int(freq[s]) // 2)
        freq[s] -= take
        over -= take
    freq[np.argmax(freq)] -= over
    return freq


class Coder:
    """Encoder and decoder of blocks for one frequency table."""

    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, list[tuple[int, int, np.ndarray]]]:
        """(lanes, states, words, checkpoints)."""
        lanes = min(LANES, len(ids))
        steps = -(-len(ids) // lanes)
        freq, start = self.freq[ids], self.start[ids]
        state = np.full(lanes, _LOW)
        words: list[np.ndarray] = []
        marks, written = [], 0
        for t in range(steps - 1, -1, -1):
            if (t + 1) % CHECKPOINT_STEPS == 0 and t + 1 < steps:
                marks.append((t + 1, written, state.copy()))
            f, s = freq[t * lanes:(t + 1) * lanes], start[t * lanes:(t + 1) * lanes]
            x = state[:len(f)]
            full = x >= f << np.uint64(63 - SCALE_BITS)
            if full.any():
                words.append(x[full].astype("<u4"))
                written += len(words[-1])
                x = np.where(full, x >> _32, x)
            share = x // f
            state[:len(f)] = (share << _M) + (x - share * f) + s
        stream = np.concatenate(words[::-1]) if words else np.empty(0, "<u4")
        return lanes, state, stream, [(t, written - done, x) for t, done, x in marks[::-1]]

    def decode(self, count: int, states: np.ndarray, words: np.ndarray, offset: int = 0) -> np.ndarray:
        """``count`` ids from the given states and place in the stream on."""
        lanes, out = len(states), np.empty(count, np.uint32)
        state, mask = states.astype(np.uint64), np.uint64((1 << SCALE_BITS) - 1)
        for t in range(0, count, lanes):
            x = state[:min(lanes, count - t)]
            slot = x & mask
            got = self.symbol[slot]
            x = self.freq[got] * (x >> _M) + slot - self.start[got]
            low = np.nonzero(x < _LOW)[0]
            x[low] = (x[low] << _32) | words[offset:offset + len(low)]
            offset += len(low)
            state[:len(x)] = x
            out[t:t + len(x)] = got
        return out


def _raw_blocks(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Tokenised documents in ascending doc_id order, packed into rows of at least BLOCK_IDS ids (but the last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), WordTokenizer(tokenizer)
        end = np.array([END_ID], made.kind).tobytes()
        width = len(end)
        block, doc_ids, pieces, held = 0, [], [], 0

        def packed() -> pa.RecordBatch:
            row = [[part], [block], [doc_ids], [[len(p) // width for p in pieces]], [made.kind], [b"".join(pieces)]]
            kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)],
                                              ["part", "block", "doc_ids", "lengths", "kind", "ids"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                pieces.append(made.ids([text.as_py()])[0] + end)
                doc_ids.append(doc)
                held += len(pieces[-1]) // width
                if held >= BLOCK_IDS:
                    yield packed()
                    block, doc_ids, pieces, held = block + 1, [], [], 0
        if doc_ids:
            yield packed()

    by = [F.col("doc_id"), F.xxhash64("text")]
    return (bounded_batches(docs).select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
            .repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, RAW))


def _counts(raw: DataFrame) -> np.ndarray:
    """Number of each id over all blocks; the driver gets one row per symbol of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for kind, ids in zip(batch.column(0), batch.column(1)):
                own = np.bincount(np.frombuffer(ids.as_py(), kind.as_py()), minlength=len(total))
                own[:len(total)] += total
                total = own
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["symbol", "n"])

    rows = raw.select("kind", "ids").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 + max([END_ID, *rows.column("symbol").to_pylist()]), np.int64)
    out[rows.column("symbol").to_numpy()] = rows.column("n").to_numpy()
    return out


def write_tokens(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER) -> None:
    """Tokenise all documents and write table and blocks below ``folder``."""
    spark = docs.sparkSession
    raw = stored(_raw_blocks(docs, tokenizer))
    freq = quantise(_counts(raw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for batch in batches:
            for row in range(batch.num_rows):
                head = [batch.column(c).slice(row, 1) for c in range(4)]
                ids = np.frombuffer(batch.column(5)[row].as_py(), batch.column(4)[row].as_py())
                lanes, states, words, marks = coder.encode(ids)
                stream = words.tobytes()
                marks = [{"step": t, "offset": o, "states": x.tobytes()} for t, o, x in marks]
                kind = pa.list_(pa.struct([("step", pa.int32()), ("offset", pa.int32()), ("states", pa.binary())]))
                rest = [pa.array([len(ids)], pa.int32()), pa.array([lanes], pa.int32()), pa.array([states.tobytes()]),
                        pa.array([stream]), pa.array([marks], kind), pa.array([crc32(stream)]), pa.array([crc32(ids.astype("<u4").tobytes())])]
                yield pa.RecordBatch.from_arrays([*head, *rest], ["part", "block", "doc_ids", "lengths", "n_ids", "lanes", "states",
                                                                  "words", "checkpoints", "words_crc32", "ids_crc32"])

    used = np.nonzero(freq)[0]
    table = pa.table({"symbol": used.astype(np.int64), "frequency": freq[used]})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{folder}/table")
    raw.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


def _coder(spark: SparkSession, folder: str) -> Coder:
    rows = spark.read.schema("symbol long, frequency long").parquet(f"{folder}/table").toArrow()
    freq = np.zeros(1 + max(rows.column("symbol").to_pylist(), default=0), np.int64)
    freq[rows.column("symbol").to_numpy()] = rows.column("frequency").to_numpy()
    return Coder(freq)


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 (and ids, 32-bit little-endian).

    Every block's checksums are checked.
    """
    coder = _coder(spark, folder)
    freq = coder.freq.astype(np.int64)
    blocks = read_blocks(spark, folder)
    names = ["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Coder(freq)
        for batch in batches:
            for row in batch.to_pylist():
                if crc32(row["words"]) != row["words_crc32"]:
                    raise ValueError(f"stream of block {row['part']}/{row['block']} is damaged")
                ids = own.decode(row["n_ids"], np.frombuffer(row["states"], np.uint64), np.frombuffer(row["words"], "<u4"))
                data = ids.astype("<u4").tobytes()
                if crc32(data) != row["ids_crc32"]:
                    raise ValueError(f"ids of block {row['part']}/{row['block']} are damaged")
                ends = np.cumsum(row["lengths"], dtype=np.int64).tolist()
                starts = [0, *ends[:-1]]
                pieces = [data[4 * a:4 * b] for a, b in zip(starts, ends)]
                n = len(ends)
                columns = [[row["part"]] * n, [row["block"]] * n, row["doc_ids"], starts, row["lengths"], list(map(crc32, pieces)),
                           *[pieces] * with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    needed = blocks.select("part", "block", "doc_ids", "lengths", "n_ids", "states", "words", "words_crc32", "ids_crc32")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("part", "block", F.col("n_ids").cast("long").alias("n_ids"))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    places = (sizes.withColumn("within", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)))
              .join(parts.select("part", "base"), "part").select("part", "block", (F.col("base") + F.col("within")).alias("first")))
    return (needed.mapInArrow(run, schema).join(places, ["part", "block"])
            .select("doc_id", (F.col("first") + F.col("inside")).alias("start"), *names[4:]))


def read_segment(spark: SparkSession, folder: str, part: int, block: int, checkpoint: int) -> np.ndarray:
    """Ids of one block from its ``checkpoint``-th checkpoint on, decoded without the ids before."""
    row = read_blocks(spark, folder).where((F.col("part") == part) & (F.col("block") == block)).first()
    mark = row["checkpoints"][checkpoint]
    count = row["n_ids"] - mark["step"] * row["lanes"]
    words = np.frombuffer(row["words"], "<u4")
    return _coder(spark, folder).decode(count, np.frombuffer(mark["states"], np.uint64), words, mark["offset"])


def encoded_documents(docs: DataFrame, folder: str | None = None, tokenizer: str = TOKENIZER) -> DataFrame:
    """Write all documents and read them back: doc_id, start, n_tokens, ids_crc32."""
    folder = folder or shared_folder(docs.sparkSession)
    write_tokens(docs, folder, tokenizer)
    return read_tokens(docs.sparkSession, folder)
