import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import toxicity as m
from orderflow.llm.gam import fold


def test_grammar_labels():
    g = m.Grammar(("idiot", "moron"))

    def labels(text):
        return {m.LABELS[k]: int(n) for k, n in enumerate(g.label_counts(text.encode())) if n}

    assert labels("You idiot. It rains.") == {"insult targeted": 1}
    assert labels("what idiots") == {"insult": 1}
    assert labels("you are not an idiot; what a moron") == {"insult negated targeted": 1, "insult": 1}
    assert labels("she said he is an idiot\nI will kill you") == {"insult reported targeted": 1, "threat": 1}
    assert labels("not very far from being an idiot") == {"insult": 1}  # out of the negation's reach
    assert labels("ridiotous idio t") == {} and labels("") == {}
    assert labels("an IDIOT, not a moron") == {"insult": 1}  # the strongest cue of a clause counts


def test_compose_is_feeding():
    a, b, c = m.negation_transducer(), m.report_transducer(), m.target_transducer()
    rng = np.random.default_rng(1)
    symbols = [m.INSULT, m.THREAT, m.TARGET, m.NEGATION, m.REPORT, m.OTHER, m.END]
    for _ in range(200):
        line = rng.choice(symbols, 30).tolist()
        assert m.GRAMMAR.run(line) == c.run(b.run(a.run(line)))


def test_compose_in_front(spark):
    """All five machines, one after the other over letters and words, give what the composed one gives."""
    g = m.Grammar(("idiot", "worthl"), ("ass",), (("kill", "you"), ("te", "voy", "a")))
    machines = [m.threat_transducer(g.threats, g_roles := {w: s for s, ws in ((m.TARGET, m.TARGETS), (m.NEGATION, m.NEGATIONS),
                                                                             (m.REPORT, m.REPORTS)) for w in ws}),
                m.negation_transducer(), m.report_transducer(), m.target_transducer()]
    assert g_roles["you"] == m.TARGET
    rng = np.random.default_rng(2)
    words = ["idiots", "worthless", "ass", "asset", "kill", "you", "te", "voy", "a", "not", "said", "tree", "he", ","]
    for _ in range(300):
        line = rng.choice(words, 9).tolist()
        symbols = [m.BREAK if w == "," else g._insults.run([*w, m.END])[-1] for w in line] + [m.END]
        fed = symbols
        for machine in machines:
            fed = [o for o in machine.run(fed) if o]
        assert "".join(g._machine.run(symbols)) == "".join(fed)
        text = " ".join(line)
        want = {fed[-1]: 1} if fed else {}
        assert {m.LABELS[k]: int(n) for k, n in enumerate(g.label_counts(text.encode())) if n} == want, text


def test_any_of():
    words = ["", "a", "ab", "abc", "abd", "b.", "be", "z" * 40, "é"]
    for chosen in (words[1:], words[1:4], words[4:5], []):
        pattern = re.compile(m.any_of(chosen))
        assert all(bool(pattern.fullmatch(w)) == (w in chosen) for w in [*words, "abe", "bx", "z"])


def test_learned_threats_and_short_insults(spark):
    """Phrases with a target that tell are learned, their words alone are not; short insults as whole words."""
    rows = [(1, f"x{chr(97 + k)} smash you y{chr(97 + k)}") for k in range(20)] + [(1, f"v{chr(97 + k)} git w{chr(97 + k)}") for k in range(20)]
    rows += [(0, f"q{chr(97 + k)} smash r{chr(97 + k)} you gits") for k in range(20)]
    rows += [(1, "one passage that will harm you is copied")] * 30
    sample = spark.createDataFrame([(y, bytearray(t.encode())) for y, t in rows], "y int, text binary")
    stems, words = m.learn_insults(sample)
    assert words == ("git",) and "smash" not in stems
    threats = m.learn_threats(sample, m.Grammar(stems, words))
    assert threats == (("smash", "you"),)
    g = m.Grammar(stems, words, threats)
    found = [{m.LABELS[k] for k, n in enumerate(g.label_counts(t)) if n} for t in (b"I smash you", b"a smash, you", b"what a git", b"gits digit")]
    assert found == [{"threat"}, set(), {"insult"}, set()]


@pytest.mark.parametrize("sf, recall, precision", [("sf0.01", 0.6, 1.0), ("sf0.1", 0.87, 0.94)])
def test_held_out(spark, sf, recall, precision):
    """Of the held-out rows' toxic ones, those found, and of those called toxic, those that are."""
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    held = fold(F.col("doc_id"), 4) == 2
    g = m.fit_toxicity(docs, labels, learn=~held)
    rows = m.score_texts(docs, g).join(labels.where(held), "doc_id").collect()
    toxic = [r.score >= m.THRESHOLD for r in rows if r.toxic == 1]
    called = [r.toxic == 1 for r in rows if r.score >= m.THRESHOLD]
    assert len(toxic) > 10 and sum(toxic) >= recall * len(toxic), (sum(toxic), len(toxic))
    assert sum(called) >= precision * len(called), (sum(called), len(called))


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (None, 1), (7, None), (99, 1), (8, 1), (8, 0)], "doc_id long, toxic int")
    g = m.fit_toxicity(odd, labels)
    rows = m.score_texts(odd, g).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert m.score_texts(none, g).count() == 0
    plain = m.fit_toxicity(odd, labels.limit(0))
    assert plain.stems == () and max(r.score for r in m.score_texts(odd, plain).collect()) < m.THRESHOLD


def test_copied_passage_gives_no_stem(spark):
    rows = [(1, b"the zork blimped over fences") for _ in range(40)] + [(0, f"calm words {k} here".encode()) for k in range(40)]
    rows += [(1, f"some{chr(97 + k)} vilez{chr(97 + k)} thing".encode()) for k in range(20)]
    stems = m.learn_stems(spark.createDataFrame([(y, bytearray(t)) for y, t in rows], "y int, text binary"))
    assert "vilez" in stems and not any(s.startswith(("zork", "blimp")) for s in stems)


def test_cues_behind_marks():
    """Marks of any script before, behind and inside cues and threats neither hide them nor count as words."""
    g = m.Grammar(("idiot",))

    def labels(text):
        return {m.LABELS[k]: int(n) for k, n in enumerate(g.label_counts(text.encode())) if n}

    for text in ("*idiot*", "'idiot'", "[idiot]", "_idiot_", "¡idiota!", "¿idiota?", "« idiot »", "«\u00a0idiot\u00a0»", "“idiot”",
                 "‘idiot’", "so—idiot", "l'idiot", "l’idiot", "x/idiot", "2idiot", "漢字 idiot"):
        assert labels(text) == {"insult": 1}, text
    for text in ("you-idiot", "you—idiot", "“you” *idiot*", "you're an idiot"):
        assert labels(text) == {"insult targeted": 1}, text
    for text in ("I kill you", "I kill  you", "I kill\u00a0you", "I *kill* you", "“kill” “you”", "te  voy\ta"):
        assert labels(text) == {"threat": 1}, text
    for text in ("isn't an idiot", "isn’t an idiot", "not a well-known idiot", "not * a * big * idiot", "*not* an idiot"):
        assert labels(text) == {"insult negated": 1}, text
    for text in ("kill, you", "skill you", "kill your", "éidiot", "midiot"):
        assert labels(text) == {}, text
