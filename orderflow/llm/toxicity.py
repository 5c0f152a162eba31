"""Toxicity: a weighted finite-state grammar over clauses.

Five transducers are composed.  The insult transducer reads the letters of a word and gives its symbol: an insult
(learned word beginnings, and whole words where they are short), a word of a threat or of the grammar's own lists, or
other.  The threat transducer follows phrases of several words and gives a threat where one is complete.  The negation
transducer marks cues that follow a negation closely, the reported-speech transducer marks cues after a verb of saying,
and the target transducer, last, keeps the strongest cue and whether somebody is addressed.  At the end of a clause the
machine gives one label, such as ``insult targeted``; labels of clauses, not single words, carry weights.  A document's
score is the sigmoid of a bias plus the labels' weights times the logarithm of one plus their clause counts.

Learned from at most about ``SAMPLE_ROWS`` labelled rows (chosen by a hash of the id): insults, which occur in many
different contexts, nearly all in toxic rows, so a passage that is copied into many rows gives none; threats, which are
phrases of two or three words, one of them a target, with contexts of that kind and without an insult; and the weights,
by Newton steps with a ridge that holds labels without evidence at the grammar's own weights.  All that the evidence
supports is kept; the bounded sample bounds the number.

Defined cases: a null text counts as empty; a text without cues, the empty one included, has the score of the bias;
rows with a null label or id are not learned from, repeated labels count as the larger one; without labelled rows the
grammar's own weights, words and threats are used.  Only doc_id and text are read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import bounded_batches, stored, text_bytes
from orderflow.llm.gam import labelled_sample

SAMPLE_ROWS = 12_000
#: Letters of the word beginnings that are learned; longer words are found by their beginning, shorter ones as they are.
STEM_LETTERS = (4, 12)
#: An insult or threat stands in this many contexts of toxic rows, and this many times as often as elsewhere.
STEM_CONTEXTS = 8
STEM_RATIO = 20
NEGATION_REACH = 3
THRESHOLD = 0.3
RIDGE = 1.0
#: Arcs that a machine given by a rule keeps; others are worked out again.
KEPT_ARCS = 200_000

# Function words of the grammar, and threats it knows without learning (English, German, French, Spanish).
THREATS = ("kill you", "hurt you", "destroy you", "beat you", "find you", "bringe dich um", "mach dich fertig", "te tuer",
           "vais te", "te mato", "te voy a")
TARGETS = ("you", "your", "yours", "he", "she", "they", "him", "her", "them", "du", "dich", "dir", "dein", "ihr", "euch", "tu",
           "toi", "vous", "votre", "ton", "tú", "ti", "vosotros", "ustedes", "usted")
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "nunca", "jamás")
REPORTS = ("said", "says", "say", "told", "wrote", "quoted", "called", "sagte", "sagt", "schrieb", "nannte", "dit", "disait",
           "écrit", "dijo", "dice", "escribió", "llamó")

#: A letter in any script, and what may stand between two words of a threat: white space and marks, no comma or colon.
_LETTER = r"[^\W\d_]"
_GAP = r"(?:[^\w,:.!?;\n]|_)+"

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, END, BREAK = "insult", "threat", "T", "N", "R", "O", "$", "|"
KINDS = (INSULT, THREAT)
CUES = tuple(kind + negated + reported for kind in KINDS for negated in ("", " negated") for reported in ("", " reported"))
LABELS = tuple(cue + targeted for cue in CUES for targeted in ("", " targeted"))


class Transducer:
    """Deterministic: (state, symbol) -> (state, output); an empty output feeds nothing to the next machine.

    Arcs are given as a table, or by a rule and kept as they are met (the letters and words that a rule knows are
    not listed beforehand).
    """

    def __init__(self, start: object, arcs: dict | None = None, rule: Callable[[object, str], tuple[object, str]] | None = None):
        self.start, self.arcs, self._rule = start, arcs or {}, rule

    def step(self, state: object, symbol: str) -> tuple[object, str]:
        found = self.arcs.get((state, symbol))
        if found is None:
            if self._rule is None:
                raise KeyError((state, symbol))
            found = self._rule(state, symbol)
            if len(self.arcs) < KEPT_ARCS:
                self.arcs[state, symbol] = found
        return found

    def run(self, symbols: Iterable[str]) -> list[str]:
        state, out = self.start, []
        for s in symbols:
            state, o = self.step(state, s)
            out.append(o)
        return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds the outputs of the first to the second; its states are pairs."""

    def rule(state: tuple, symbol: str) -> tuple[object, str]:
        a, between = first.step(state[0], symbol)
        if not between:
            return (a, state[1]), ""
        b, out = second.step(state[1], between)
        return (a, b), out

    return Transducer((first.start, second.start), rule=rule)


def insult_transducer(stems: Iterable[str], words: dict[str, str]) -> Transducer:
    """Reads letters, then ``END`` of a word: nothing for a letter, the word's symbol for its end.

    A word that begins with a stem is an insult; ``words`` gives the symbols of whole words.
    """
    stems = set(stems)
    paths = {w[:k] for w in (*stems, *words) for k in range(len(w) + 1)}
    insult, unknown = 1, 0  # states of words that have begun with a stem, or are none of the lists

    def rule(state: object, letter: str) -> tuple[object, str]:
        if letter == END:
            return "", INSULT if state == insult else words.get(state, OTHER)
        longer = state + letter if isinstance(state, str) else state
        return (insult if longer in stems else longer if isinstance(state, int) or longer in paths else unknown), ""

    return Transducer("", rule=rule)


def word_symbol(word: str) -> str:
    """Symbol of a word that threats are made of."""
    return f"={word}"


def threat_transducer(phrases: Iterable[tuple[str, ...]], roles: dict[str, str]) -> Transducer:
    """Follows phrases over word symbols; the last word of one becomes a threat, any other has its role (or other).

    The state is the longest run of words read that begins a phrase.  A break ends it and is not handed on.
    """
    phrases = set(phrases)
    begun = {p[:k] for p in phrases for k in range(len(p))}

    def rule(state: tuple[str, ...], symbol: str) -> tuple[object, str]:
        if symbol == BREAK:
            return (), ""
        if not symbol.startswith("="):
            return (), symbol
        read = (*state, symbol[1:])
        tails = [read[k:] for k in range(len(read) + 1)]
        if any(t in phrases for t in tails):
            return (), THREAT
        return next(t for t in tails if t in begun), roles.get(symbol[1:], OTHER)

    return Transducer((), rule=rule)


def negation_transducer(reach: int = NEGATION_REACH) -> Transducer:
    """Marks cues within ``reach`` words after a negation; the state counts down."""
    arcs = {}
    for state in range(reach + 1):
        after = max(0, state - 1)
        arcs |= {(state, s): (after, s) for s in (TARGET, REPORT, OTHER)}
        arcs |= {(state, kind): (after, kind + (" negated" if state else "")) for kind in KINDS}
        arcs |= {(state, NEGATION): (reach, OTHER), (state, END): (0, END)}
    return Transducer(0, arcs)


def report_transducer() -> Transducer:
    """Marks cues after a verb of saying in the same clause."""
    arcs = {}
    for state in (False, True):
        arcs |= {(state, s): (state, s) for s in (TARGET, OTHER)}
        arcs |= {(state, kind + n): (state, kind + n + (" reported" if state else "")) for kind in KINDS for n in ("", " negated")}
        arcs |= {(state, REPORT): (True, OTHER), (state, END): (False, END)}
    return Transducer(False, arcs)


def target_transducer() -> Transducer:
    """Keeps the strongest cue (plain before reported before negated) and whether a target occurs; labels the end."""
    rank = {None: -1} | {c: 2 * ("negated" not in c) + ("reported" not in c) for c in CUES}
    arcs = {}
    for cue in (None, *CUES):
        for aimed in (False, True):
            state = (cue, aimed)
            arcs[state, OTHER] = (state, "")
            arcs[state, TARGET] = ((cue, True), "")
            arcs |= {(state, c): ((c if rank[c] > rank[cue] else cue, aimed), "") for c in CUES}
            arcs[state, END] = ((None, False), "" if cue is None else cue + (" targeted" if aimed else ""))
    return Transducer((None, False), arcs)


#: What follows the insults and threats; these are learned and composed in front.
GRAMMAR = compose(compose(negation_transducer(), report_transducer()), target_transducer())


def own_weights() -> np.ndarray:
    """Bias, then the grammar's own weight of each label."""
    out = [-4.0]
    for label in LABELS:
        out.append(5.0 + ("targeted" in label) - 3.0 * ("negated" in label) - 3.0 * ("reported" in label))
    return np.array(out)


def any_of(words: Iterable[str]) -> str:
    """Regular expression of any of the words, with what they begin with in common written once."""
    words = sorted(set(words))
    if not words:
        return "(?!)"
    out = []
    for _, group in groupby(words, key=lambda w: w[:1]):
        group = list(group)
        shared = os.path.commonprefix(group)
        rest = [w[len(shared):] for w in group]
        out.append(re.escape(shared) + (f"(?:{any_of(r for r in rest if r)}){'?' if '' in rest else ''}" if len(rest) > 1 else ""))
    return "|".join(out)


@dataclass
class Grammar:
    """Insults (``stems``: beginnings of words, ``words``: whole ones), threats as phrases, and weights."""

    stems: tuple[str, ...] = ()
    words: tuple[str, ...] = ()
    threats: tuple[tuple[str, ...], ...] = tuple(tuple(t.split()) for t in THREATS)
    weights: np.ndarray = field(default_factory=own_weights)

    def __post_init__(self) -> None:
        roles = {w: s for s, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}
        symbols = roles | {w: word_symbol(w) for t in self.threats for w in t} | {w: INSULT for w in self.words}
        self._insults = insult_transducer(self.stems, symbols)
        self._machine = compose(threat_transducer(self.threats, roles), GRAMMAR)
        # Where a cue may be; what it is, and whether it is one, the machine tells.
        threat = "|".join(_GAP.join(map(re.escape, t)) for t in self.threats) or "(?!)"
        self._cue = re.compile(f"(?<!{_LETTER})(?:(?:{any_of(self.stems)})|(?:{any_of(self.words)}|{threat})(?!{_LETTER}))")
        self._clause = re.compile(r"[.!?;\n]+")
        joined = "|".join(re.escape(w).replace("'", "['’]") for w in roles if "'" in w)
        self._token = re.compile(f"(?<!{_LETTER})(?:{joined})(?!{_LETTER})|{_LETTER}+|[0-9]+")
        self._break, self._stop = re.compile(r"[\s,:()\"]"), re.compile(r"[,:]")

    def _clause_symbols(self, low: str, begin: int, end: int) -> list[str]:
        """Symbols of the letter runs of a clause, from the insult transducer; marks have none, but commas and colons
        are breaks.

        Runs that no white space, comma, colon, bracket or quote parts (``don't``) are one word for the negation's
        reach: an ``O`` beside another symbol of the same word goes.
        """
        out: list[str] = []
        last = None
        for m in self._token.finditer(low, begin, end):
            symbol = self._insults.run([*m[0].replace("’", "'"), END])[-1]
            if last is not None and self._stop.search(low, last, m.start()):
                out.append(BREAK)
            if last is None or self._break.search(low, last, m.start()):
                out.append(symbol)
            elif out[-1] == OTHER:
                out[-1] = symbol
            elif symbol != OTHER:
                out.append(symbol)
            last = m.end()
        return out

    def label_counts(self, text: bytes) -> np.ndarray:
        """Clauses of each label in a whole text.  Only clauses that hold a cue are read by the machine."""
        counts = np.zeros(len(LABELS))
        low = text.decode("utf-8", "replace").lower()
        cue, end = self._cue.search(low), 0
        while cue:
            begin = end
            for mark in self._clause.finditer(low, end, cue.start()):
                begin = mark.end()
            stop = self._clause.search(low, cue.end())
            end = stop.start() if stop else len(low)
            label = self._machine.run([*self._clause_symbols(low, begin, end), END])[-1]
            if label:
                counts[LABELS.index(label)] += 1
            cue = self._cue.search(low, max(end, cue.end()))
        return counts

    def score(self, counts: np.ndarray) -> np.ndarray:
        total = self.weights[0] + np.log1p(counts) @ self.weights[1:]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _contexts(rows: DataFrame, cue: str) -> DataFrame:
    """(cue, toxic, clean): in how many contexts (the word before) a cue stands in toxic rows, and in others."""
    return (rows.groupBy(cue, "before").agg(F.max("y").alias("toxic"), F.min("y").alias("least"))
            .groupBy(cue).agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("least")).alias("clean")))


_TELLS = f"toxic >= {STEM_CONTEXTS} and toxic >= {STEM_RATIO} * clean"


def _words(sample: DataFrame) -> DataFrame:
    words = F.filter(F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}]+"), lambda w: w != "")
    return sample.select("y", words.alias("words")).where(F.size("words") > 0)


def learn_insults(sample: DataFrame) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(stems, words) from (doc_id, y, text) rows: word beginnings, and whole short words, that tell."""
    pairs = F.transform(F.sequence(F.lit(1), F.size("words")),
                        lambda k: F.struct(F.element_at("words", k).alias("word"),
                                           F.when(k > 1, F.element_at("words", k - 1)).alias("before")))
    low, high = STEM_LETTERS
    found = _contexts(_words(sample).select("y", F.explode(pairs).alias("p")).select("y", "p.word", "p.before"), "word")
    size = F.length("word")
    lengths = F.when(size < low, F.array(size)).otherwise(F.sequence(F.lit(low), F.least(size, F.lit(high))))
    cues = (found.select(F.explode(lengths).alias("letters"), "*")
            .groupBy(F.expr("left(word, letters)").alias("stem")).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where(_TELLS).select("stem", "toxic").collect())
    own = {*TARGETS, *NEGATIONS, *REPORTS}
    support = {r.stem: r.toxic for r in cues if len(r.stem) >= low}
    out: dict[str, str] = {}
    for stem in sorted(support, key=lambda s: (len(s), s)):
        if not any(stem[:k] in out for k in range(low, len(stem))):
            longer = [s for s in support if s.startswith(stem) and support[s] >= 0.95 * support[stem]]
            out[stem] = max(longer, key=lambda s: (len(s), s))
    return tuple(sorted(set(out.values()))), tuple(sorted(r.stem for r in cues if len(r.stem) < low and r.stem not in own))


def learn_stems(sample: DataFrame) -> tuple[str, ...]:
    return learn_insults(sample)[0]


def learn_threats(sample: DataFrame, insults: Grammar) -> tuple[tuple[str, ...], ...]:
    """Phrases of two or three words from (doc_id, y, text) rows that tell, with a target and without an insult."""
    targets = F.array(*map(F.lit, TARGETS))
    places = F.filter(F.sequence(F.lit(1), F.size("words")), lambda k: F.array_contains(targets, F.element_at("words", k)))
    rows = _words(sample).select("y", "words", F.explode(places).alias("k"))
    spans = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(n).alias("n")) for n in (2, 3) for a in range(n)])
    rows = rows.withColumn("s", F.explode(spans)).withColumn("first", F.col("k") - F.col("s.a"))
    rows = rows.where((F.col("first") >= 1) & (F.col("first") + F.col("s.n") - 1 <= F.size("words")))
    rows = rows.select("y", F.array_join(F.slice("words", F.col("first"), F.col("s.n")), " ").alias("phrase"),
                       F.when(F.col("first") > 1, F.element_at("words", F.col("first") - 1)).alias("before"))
    found = sorted(tuple(r.phrase.split(" ")) for r in _contexts(rows, "phrase").where(_TELLS).select("phrase").collect())
    plain = [p for p in found if not any(insults._insults.run([*w, END])[-1] == INSULT for w in p)]
    # A phrase that holds a shorter one says nothing more.
    short = {p for p in plain if len(p) == 2}
    return tuple(p for p in plain if len(p) == 2 or not {p[:2], p[1:]} & short)


def fit_weights(counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps of a logistic model with a ridge around the grammar's own weights."""
    prior = own_weights()
    x = np.column_stack([np.ones(len(y)), np.log1p(counts)])
    x, n = np.unique(np.column_stack([x, y]), axis=0, return_counts=True)
    x, y = x[:, :-1], x[:, -1]
    w = prior.copy()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - RIDGE * (w - prior)
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None) -> Grammar:
    sample = stored(labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, SAMPLE_ROWS))
    grammar = Grammar(*learn_insults(sample))
    grammar = Grammar(grammar.stems, grammar.words, tuple(sorted({*grammar.threats, *learn_threats(sample, grammar)})))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([grammar.label_counts(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(LABELS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts.T)], ["y", *(f"c{k}" for k in range(len(LABELS)))])

    schema = "y int, " + ", ".join(f"c{k} double" for k in range(len(LABELS)))
    rows = sample.select("y", "text").mapInArrow(run, schema).toArrow()
    if len(rows):
        counts = np.column_stack([rows.column(f"c{k}").to_numpy() for k in range(len(LABELS))])
        grammar.weights = fit_weights(counts, rows.column("y").to_numpy().astype(float))
    return grammar


def scorer(grammar: Grammar) -> Callable[[Column], Column]:
    """Column function: the score of a text's UTF-8 bytes."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        counts = np.array([grammar.label_counts(t) for t in texts.to_pylist()]).reshape(-1, len(LABELS))
        return pa.array(grammar.score(counts))

    return score


def score_texts(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """(doc_id, score) of every whole text."""
    return bounded_batches(docs).select("doc_id", scorer(grammar)(text_bytes()).alias("score"))
