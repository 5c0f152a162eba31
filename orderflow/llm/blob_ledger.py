"""Secret scans over an incremental blob ledger (native expressions only).

Every historical version of a file is addressed by its content: the SHA-256 of its bytes names the blob.  The ledger
holds, per blob, which rule versions have been run on it and the spans they found.  A scan runs only the (blob, rule
version) pairs that the ledger lacks, each blob once however many paths share it, appends the new entries and joins
the findings back to all paths.

Spans are code point offsets, end exclusive.  They come from native expressions: a text is split at a rule's matches,
and the lengths of the pieces and matches add up to the offsets.  Cheap substring guards skip texts that cannot match.

Defined cases: a null text counts as empty, and an empty text is a blob like any other, without findings; repeated
rows (same path, same text) get the same findings each; a null path is kept; an empty history gives empty results;
a rule whose version changes is run again on every blob, its findings of older versions are no longer reported.
Columns other than the path columns and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import key_text, stored, text_bytes


@dataclass(frozen=True)
class Rule:
    """``least``: code points that ``group`` must have; ``guards``: lower-case texts one of which a match contains."""

    kind: str
    pattern: str
    group: int
    least: int
    guards: tuple[str, ...]
    version: int = 1


# Public formats of credentials, the first three as the contract states them.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
         ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", r"(AKIA[A-Z0-9]+)", 1, 16, ("akia",)),
    Rule("hex", r"([0-9a-f]{32,})", 1, 32, ()),
)
RULES = (
    *BASE_RULES,
    Rule("pem", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 1, ("private key-----",)),
    Rule("github", r"(gh[pousr]_[A-Za-z0-9]{36,})", 1, 1, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 1, ("eyj",)),
)
_SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, findings array<struct<kind:string,version:int,spans:{_SPANS}>>"


def rule_spans(text: Column, lower: Column, rule: Rule) -> Column:
    """Spans of a rule's matches that are long enough; leftmost and non-overlapping."""
    pieces = F.split(text, rule.pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(done: Column, part: Column) -> Column:
        begin = done["at"] + F.length(part["piece"])
        end = begin + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"))
        spans = F.when(F.length(part["value"]) >= rule.least, F.array_append(done["spans"], span)).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    parts = F.arrays_zip(pieces.alias("piece"), hits.alias("hit"), values.alias("value"))
    found = F.aggregate(parts, start, add, lambda done: done["spans"])
    may = F.lit(False) if rule.guards else text.rlike(rule.pattern)
    for guard in rule.guards:
        may = may | F.contains(lower, F.lit(guard))
    return F.when(may, found).otherwise(F.array().cast(_SPANS))


def _pair(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def scan(history: DataFrame, paths: list[str], text: str, ledger: DataFrame | None = None,
         rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings, entries): findings of every path of ``history``, and the new ledger entries.

    findings: the path columns, blob and findings (kind, version, spans) of the current rule versions.
    entries: blob and findings of the pairs that were run now; append them to the ledger.
    """
    known = ledger is not None
    if not known:
        ledger = history.sparkSession.createDataFrame([], LEDGER)
    keys = [f"__p{i}" for i in range(len(paths))]
    blob = F.sha2(text_bytes(text), 256)
    addressed = history.select(*[F.col(p) for p in paths], *[key_text(F.col(p)).alias(k) for p, k in zip(paths, keys)],
                               F.coalesce(F.col(text), F.lit("")).alias("__text"), blob.alias("blob"))
    rows = stored(addressed.drop("__text"))
    run = F.expr("transform(flatten(collect_list(findings)), f -> concat(f.kind, '@', f.version))")
    seen = ledger.groupBy("blob").agg(run.alias("__run"))
    wanted = F.array(*[F.lit(_pair(r)) for r in rules])
    first = F.min(F.struct(*keys)).alias("__first")
    due = (rows.groupBy("blob").agg(first).join(seen, "blob", "left")
           .withColumn("__due", F.array_except(wanted, F.coalesce("__run", F.array().cast("array<string>"))))
           .where(F.size("__due") > 0).select("blob", "__first.*", "__due"))
    unseen = addressed.select(*keys, "blob", "__text").join(due, [*keys, "blob"])
    lower = F.lower("__text")
    results = [F.when(F.array_contains("__due", _pair(r)),
                      F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
                               rule_spans(F.col("__text"), lower, r).alias("spans"))) for r in rules]
    entries = stored(unseen.select("blob", F.array_compact(F.array(*results)).alias("findings")).dropDuplicates(["blob"]))
    current = entries
    if known:
        found = ledger.select("blob", "findings").unionByName(entries).groupBy("blob").agg(
            F.flatten(F.collect_list("findings")).alias("findings"))
        current = stored(found.withColumn("findings", F.filter("findings", lambda f: F.array_contains(
            wanted, F.concat(f["kind"], F.lit("@"), f["version"])))))
    # Both sides are stored tables, so the join has shuffles of its own, which AQE can split for a hot blob.
    return rows.drop(*keys).join(current, "blob"), entries


def _listed(findings: str, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end`` of the rules' spans, by start and then rule order, joined by commas."""
    order = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(k))])
    of_rules = F.filter(findings, lambda f: F.map_contains_key(order, f["kind"]))
    flat = F.flatten(F.transform(of_rules, lambda f: F.transform(f["spans"], lambda s: F.struct(
        s["start"].alias("start"), order[f["kind"]].alias("order"), s["end"].alias("end"), f["kind"].alias("kind")))))
    return F.array_join(F.transform(F.array_sort(flat), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(findings: DataFrame, base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans and the list of all spans."""
    def count(rule: Rule) -> Column:
        own = F.filter("findings", lambda f: f["kind"] == rule.kind)
        return F.aggregate(own, F.lit(0).cast("long"), lambda n, f: n + F.size(f["spans"])).alias(f"n_{rule.kind}")

    return findings.select("doc_id", *[count(r) for r in base], F.sha2(_listed("findings", base), 256).alias("base_sha256"),
                           _listed("findings", rules).alias("spans"))


def _sql_spans(rule: Rule) -> str:
    """DuckDB: list of {s, o, e, k} of a rule's spans."""
    p = rule.pattern.replace("'", "''")
    lengths = f"list_transform(string_split_regex(t, '{p}'), lambda x: length(x))"
    hits = f"list_transform(regexp_extract_all(t, '{p}', 0), lambda x: length(x))"
    values = f"list_transform(regexp_extract_all(t, '{p}', {rule.group}), lambda x: length(x))"
    order = [r.kind for r in RULES].index(rule.kind)
    begin = f"list_sum(({lengths})[1:i]) + coalesce(list_sum(({hits})[1:i - 1]), 0)"
    return (f"CASE WHEN regexp_matches(t, '{p}') THEN list_transform(list_filter(range(1, len({hits}) + 1), "
            f"lambda i: ({values})[i] >= {rule.least}), lambda i: {{'s': ({begin})::BIGINT, 'o': {order}, "
            f"'e': ({begin} + ({hits})[i])::BIGINT, 'k': '{rule.kind}'}}) ELSE [] END")


_LIST = "array_to_string(list_transform(list_sort(x), lambda v: v.k || ':' || v.s || ':' || v.e), ',')"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),
f AS (SELECT doc_id, {', '.join(f'{_sql_spans(r)} AS r{k}' for k, r in enumerate(RULES))} FROM d)
SELECT doc_id, len(r0)::BIGINT AS n_assign, len(r1)::BIGINT AS n_access, len(r2)::BIGINT AS n_hex,
    sha256(coalesce({_LIST.replace('x)', 'r0 || r1 || r2)')}, '')) AS base_sha256,
    coalesce({_LIST.replace('x)', ' || '.join(f'r{k}' for k in range(len(RULES))) + ')')}, '') AS spans
FROM f
"""
