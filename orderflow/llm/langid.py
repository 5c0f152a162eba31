"""Language ID: a byte convolutional network on fixed-length windows, trained in numpy.

The UTF-8 bytes of a text in lower case are cut into windows of ``WINDOW`` bytes that overlap by one byte less than
the widest filter, so every run of bytes that a filter can see lies whole in some window.  Bytes are embedded, filters
of several widths slide over a window, each keeps its largest response (max pooling), and a softmax layer gives the
languages' probabilities.  Windows are scored in batches; a text's probabilities are the mean over all its windows,
weighted by their letters, so whole texts count however long they are.

Trained by Adam steps on at most about ``SAMPLE_ROWS`` labelled texts, dealt evenly over the languages and chosen by a
hash of the text, so copies count once, with at most ``TEXT_WINDOWS`` windows spread over each.  The ``LANGUAGES``
most frequent labels are learned.  Only sampled windows reach the driver (about 10 MB); the network's size depends on
the number of languages only.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows with a null id, text or language
are not learned from; with no labelled text every text is ``und`` with score 0, with one language every text with a
letter has it with score 1; ties go to the language first in code point order; repeated rows are scored each; an empty
table gives an empty result.  Only doc_id, text and, for learning, lang are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import bounded_batches, text_bytes

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
STEP = WINDOW - max(WIDTHS) + 1
SAMPLE_ROWS = 6_000
TEXT_WINDOWS = 6
LANGUAGES = 500
STEPS = 1_500
BATCH = 64
RATE = 0.004
#: Windows scored at once.
CHUNK = 256
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, owners): the texts' bytes with padding, where each window starts, and whose it is.

    Windows without a letter (an ASCII letter or any byte from 128 on) are left out.
    """
    pad = bytes(WINDOW)
    flat = np.frombuffer(pad.join(texts) + pad, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(sizes + WINDOW) - sizes - WINDOW
    counts = np.maximum(1, -(-(sizes - (WINDOW - STEP)) // STEP))
    owners = np.repeat(np.arange(len(texts)), counts)
    starts = begin[owners] + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * STEP
    letters = letters_in(flat, starts)
    return flat, starts[letters > 0], owners[letters > 0]


def letters_in(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    low = flat | 32
    before = np.concatenate([[0], np.cumsum((flat >= 128) | ((low >= 97) & (low <= 122)), dtype=np.int64)])
    return before[starts + WINDOW] - before[starts]


def cut(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(flat, WINDOW)[starts]


@dataclass
class ByteNetwork:
    languages: tuple[str, ...] = ()
    embedding: np.ndarray | None = None
    filters: list[np.ndarray] = field(default_factory=list)
    biases: list[np.ndarray] = field(default_factory=list)
    top: np.ndarray | None = None
    top_bias: np.ndarray | None = None

    @classmethod
    def start(cls, languages: tuple[str, ...], seed: int = 13) -> ByteNetwork:
        draw = np.random.default_rng(seed).standard_normal

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (draw(shape) * scale).astype(np.float32)

        made = cls(languages, normal(256, EMBEDDING, scale=0.5),
                   [normal(w * EMBEDDING, FILTERS, scale=(w * EMBEDDING) ** -0.5) for w in WIDTHS],
                   [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
                   normal(FILTERS * len(WIDTHS), len(languages), scale=(FILTERS * len(WIDTHS)) ** -0.5),
                   np.zeros(len(languages), np.float32))
        made.embedding[0] = 0  # the padding
        return made

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.top, self.top_bias]

    def responses(self, windows: np.ndarray) -> list[np.ndarray]:
        """Per width the response of each filter at each position: (windows, positions, filters)."""
        x = self.embedding[windows]
        out = []
        for w, weights, bias in zip(WIDTHS, self.filters, self.biases):
            spans = np.lib.stride_tricks.sliding_window_view(x, w, axis=1).swapaxes(2, 3)
            out.append(spans.reshape(len(x), WINDOW - w + 1, w * EMBEDDING) @ weights + bias)
        return out

    def head(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled, 0) @ self.top + self.top_bias
        logits -= logits.max(axis=1, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(axis=1, keepdims=True)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return self.head(np.concatenate([r.max(axis=1) for r in self.responses(windows)], axis=1))

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy and its gradient; through the pooling, only the largest responses have one."""
        responses = self.responses(windows)
        places = [r.argmax(axis=1) for r in responses]
        pooled = np.concatenate([r.max(axis=1) for r in responses], axis=1)
        odds = self.head(pooled)
        rows = np.arange(len(labels))
        loss = -float(np.log(odds[rows, labels] + 1e-12).mean())
        odds[rows, labels] -= 1
        odds /= len(labels)
        back = (odds @ self.top.T) * (pooled > 0)
        embedding, filters, biases = np.zeros_like(self.embedding), [], []
        for k, (w, weights, place) in enumerate(zip(WIDTHS, self.filters, places)):
            own = back[:, k * FILTERS:(k + 1) * FILTERS]
            seen = windows[rows[:, None, None], place[:, :, None] + np.arange(w)]
            spans = self.embedding[seen].reshape(len(rows), FILTERS, w * EMBEDDING)
            filters.append(np.einsum("bf,bfk->kf", own, spans))
            biases.append(own.sum(axis=0))
            share = (own[:, :, None] * weights.T).reshape(-1, EMBEDDING)
            for e in range(EMBEDDING):
                embedding[:, e] += np.bincount(seen.ravel(), share[:, e], 256)
        embedding[0] = 0
        return loss, [embedding, *filters, *biases, np.maximum(pooled, 0).T @ odds, odds.sum(axis=0)]

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        """(language, score) of each whole text."""
        low = [b"" if t is None else t.decode("utf-8", "replace").lower() for t in texts]
        spoken = [bool(t) and has_letter(t) for t in low]
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not self.languages or not any(spoken):
            return out
        rows = [k for k, s in enumerate(spoken) if s]
        flat, starts, owners = windows_of([low[k].encode() for k in rows])
        weight = letters_in(flat, starts).astype(np.float64)
        total = np.zeros((len(rows), len(self.languages)))
        for k in range(0, len(starts), CHUNK):
            odds = self.probabilities(cut(flat, starts[k:k + CHUNK])) * weight[k:k + CHUNK, None]
            first = owners[k]
            for c in range(odds.shape[1]):
                sums = np.bincount(owners[k:k + CHUNK] - first, odds[:, c])
                total[first:first + len(sums), c] += sums
        total /= np.bincount(owners, weight, len(rows))[:, None]
        best = total.argmax(axis=1)
        for k, row in enumerate(rows):
            out[row] = (self.languages[best[k]], float(min(1.0, total[k, best[k]])))
        return out


def fit(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], steps: int = STEPS) -> ByteNetwork:
    """Adam steps over shuffled windows, every language with the same weight in all."""
    model = ByteNetwork.start(languages)
    if len(languages) < 2:
        return model
    rng = np.random.default_rng(29)
    counts = np.bincount(labels, minlength=len(languages))
    odds = 1.0 / np.maximum(counts, 1)[labels]
    means = [np.zeros_like(p) for p in model.parameters()]
    squares = [np.zeros_like(p) for p in model.parameters()]
    for step in range(1, steps + 1):
        chosen = rng.choice(len(windows), min(BATCH, len(windows)), p=odds / odds.sum())
        _, slopes = model.gradients(windows[chosen], labels[chosen])
        rate = RATE * (1.0 - (step - 1) / steps)
        for p, g, m, s in zip(model.parameters(), slopes, means, squares):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= (rate / (1 - 0.9 ** step) * m / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def labelled_windows(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(lang, text, number, window): the training windows, from about ``rows`` distinct labelled texts."""
    texts = (bounded_batches(docs).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & learn)
             .select(F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("key"), text_bytes().alias("text")))
    known = (texts.groupBy("lang").agg(F.approx_count_distinct("key").alias("there"))
             .orderBy(F.desc("there"), "lang").limit(LANGUAGES).collect())
    each = max(12, rows // max(1, len(known)))
    keep = F.create_map(*[F.lit(v) for r in known for v in (r.lang, int(min(1.0, each / r.there) * (1 << 20)))]) if known else None
    share = F.lit(0) if keep is None else F.coalesce(keep[F.col("lang")], F.lit(0))
    chosen = texts.where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 20)) < share).dropDuplicates(["lang", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [t.as_py().decode("utf-8", "replace").lower() for t in batch.column(2)]
            low = [t.encode() if has_letter(t) else b"" for t in low]
            flat, starts, owners = windows_of(low)
            # Of each text some windows, evenly spread from its first to its last.
            counts = np.bincount(owners, minlength=len(low))
            place = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
            n = counts[owners]
            taken = np.minimum(n, TEXT_WINDOWS)
            mine = (place * taken) // n != ((place - 1) * taken) // n
            windows = cut(flat, starts[mine])
            own = pa.array(owners[mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(own), batch.column(1).take(own), pa.array(place[mine]),
                 pa.array([w.tobytes() for w in windows], pa.binary())], ["lang", "key", "number", "window"])

    return chosen.mapInArrow(run, "lang string, key long, number long, window binary")


def fit_languages(docs: DataFrame, learn: Column | None = None) -> ByteNetwork:
    """Learn the languages of ``lang`` from the rows for which ``learn`` holds."""
    found = labelled_windows(docs, F.lit(True) if learn is None else learn).toArrow()
    if not len(found):
        return ByteNetwork()
    found = found.sort_by([(c, "ascending") for c in ("lang", "key", "number")])
    names = found.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    place = {name: k for k, name in enumerate(languages)}
    windows = np.frombuffer(b"".join(found.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return fit(windows, np.fromiter(map(place.__getitem__, names), np.int64, len(names)), languages)


def identify(docs: DataFrame, model: ByteNetwork) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return (bounded_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))
