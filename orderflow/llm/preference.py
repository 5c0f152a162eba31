"""Preference formatting: paired conversations as one prompt and two masked completions (native expressions only).

The longest common prefix of turns (same role, same text) of the chosen and the rejected conversation is rendered
once as the prompt; the remaining turns of either side are its completion.  A completion's mask lists the spans (code
points, end exclusive) that a loss may count: the texts of assistant turns with their end mark.  Other turns inside a
completion are rendered but not in the mask.

Defined cases: repeated rows (same turn, role and text of one side) count once; rows that share a turn number are
ordered by role and text, a null turn comes last; a null role is rendered as ``unknown``, a null text as empty; the
marks' opening ``<|`` inside a text is rendered ``< |``, so no text can end its turn; identical sides have empty
completions, a missing side is an empty one; rows with a null pair id belong to no pair and go.  Extra columns are
not read.  A pair is one row of the result, so its turns meet in one task; nothing else does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of a rendered turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
_SPANS = "array<string>"


_LAST = (1 << 63) - 1


def _ordered(turns: Column) -> Column:
    """Distinct (turn, role, text) structs in order, as (role, text)."""
    return F.transform(F.array_sort(turns), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _plain(rows: DataFrame, *keys: Column) -> DataFrame:
    """The keys, turn (null: last), role and text without nulls and without opening marks inside texts."""
    return rows.select(*keys, F.coalesce(F.col("turn").cast("long"), F.lit(_LAST)).alias("turn"),
                       F.coalesce("role", F.lit("unknown")).alias("role"),
                       F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(CLOSE))


def _mask(turns: Column) -> Column:
    """Spans of the assistant texts and end marks in the rendered turns, as ``start:end`` joined by commas."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(done: Column, turn: Column) -> Column:
        begin = done["at"] + F.length(turn["role"]) + F.lit(len(OPEN) + 1)
        end = begin + F.length(turn["text"]) + F.lit(len(CLOSE))
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        spans = F.when(turn["role"] == ASSISTANT, F.array_append(done["spans"], span)).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.array_join(F.aggregate(turns, start, add, lambda done: done["spans"]), ",")


def format_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, side, turn, role, text) rows to one row per pair: prompt, completions, masks and turn counts.

    ``side`` is ``chosen`` or ``rejected``.
    """
    rows = _plain(turns.where("pair_id is not null and side in ('chosen', 'rejected')"), F.col("pair_id"), F.col("side"))
    turn = F.struct("turn", "role", "text")
    return format_sides(rows.groupBy("pair_id").agg(
        *[_ordered(F.collect_set(F.when(F.col("side") == s, turn))).alias(s) for s in ("chosen", "rejected")]))


def format_sides(sides: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected), either side an array of (role, text), to the rows of ``format_pairs``."""
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    differ = F.array_position(same, False)
    shared = F.when(differ > 0, differ - 1).otherwise(F.size(same)).cast("int")
    cut = sides.select("pair_id", "chosen", "rejected", shared.alias("prompt_turns"))
    rest = [F.slice(s, F.col("prompt_turns") + 1, F.size(s)).alias(s) for s in ("chosen", "rejected")]
    cut = cut.select("pair_id", "prompt_turns", F.slice("chosen", F.lit(1), F.col("prompt_turns")).alias("prompt"), *rest)
    return cut.select(
        "pair_id", "prompt_turns", F.array_join(F.transform("prompt", _rendered), "").alias("prompt"),
        *[c for s in ("chosen", "rejected") for c in (
            F.size(s).alias(f"{s}_turns"), F.array_join(F.transform(s, _rendered), "").alias(s), _mask(F.col(s)).alias(f"{s}_mask"))])


def sibling_sides(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations, one per conversation: a stand-in for recorded preferences.

    Chosen is the conversation; rejected has its turns before the cut and from there on those of its sibling (the
    conversation whose id differs in the last bit).  The cut is the first assistant turn in the second half, or the
    end; turns without a number follow the numbered ones, so they stand behind it on either side.  Siblings are grouped together, so the texts are shuffled once.
    """
    rows = _plain(conversations.where("conv_id is not null"), F.col("conv_id").cast("long").alias("conv_id"))
    both = (rows.groupBy(F.shiftright("conv_id", 1).alias("siblings"))
            .agg(F.collect_set(F.struct("conv_id", "turn", "role", "text")).alias("turns")))
    each = both.select(F.explode(F.array_distinct(F.transform("turns", lambda t: t["conv_id"]))).alias("pair_id"), "turns")
    parts = each.select("pair_id", *[
        F.transform(F.filter("turns", lambda t: (t["conv_id"] == F.col("pair_id")) == own),
                    lambda t: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), t["text"].alias("text"))).alias(name)
        for name, own in (("own", True), ("other", False))])
    numbered = F.transform(F.filter("own", lambda t: t["turn"] < _LAST), lambda t: t["turn"])
    parts = parts.withColumn("last", F.coalesce(F.array_max(numbered), F.lit(-1)))
    replies = F.filter("own", lambda t: (t["role"] == ASSISTANT) & (t["turn"] < _LAST) & (t["turn"] >= F.col("last") / 2))
    first = F.array_min(F.transform(replies, lambda t: t["turn"]))
    parts = parts.withColumn("cut", F.coalesce(first, F.col("last") + 1))
    rejected = F.array_union(F.filter("own", lambda t: t["turn"] < F.col("cut")),
                             F.filter("other", lambda t: t["turn"] >= F.col("cut")))
    return parts.select("pair_id", _ordered(F.col("own")).alias("chosen"), _ordered(rejected).alias("rejected"))


def _sql_render(turns: str) -> str:
    return f"coalesce(array_to_string(list_transform({turns}, lambda t: '{OPEN}' || t.r || chr(10) || t.x || '{CLOSE[:-1]}' || chr(10)), ''), '')"


def _sql_mask(turns: str) -> str:
    size = f"length(t.r) + length(t.x) + {len(OPEN) + 1 + len(CLOSE)}"
    ends = f"list_transform(range(1, len({turns}) + 1), lambda i: list_sum(list_transform(({turns})[1:i], lambda t: {size}))::BIGINT)"
    return (f"coalesce(array_to_string(list_transform(list_filter(range(1, len({turns}) + 1), lambda i: ({turns})[i].r = '{ASSISTANT}'), "
            f"lambda i: (({ends})[i] - length(({turns})[i].x) - {len(CLOSE)}) || ':' || ({ends})[i]), ','), '')")


ORACLE_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, 'unknown') r, replace(coalesce(text, ''), '<|', '< |') x
           FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT conv_id, max(turn) m FROM c GROUP BY conv_id),
cut AS (SELECT conv_id, coalesce(min(turn) FILTER (r = '{ASSISTANT}' AND turn >= m / 2), max(m) + 1) cut
        FROM c JOIN h USING (conv_id) GROUP BY conv_id),
a AS (SELECT conv_id AS pair_id, list({{'r': r, 'x': x}} ORDER BY turn, r, x) l FROM (SELECT DISTINCT * FROM c) GROUP BY conv_id),
s AS (SELECT conv_id AS pair_id, turn, r, x FROM c JOIN cut USING (conv_id) WHERE turn < cut
      UNION SELECT cut.conv_id, turn, r, x FROM c JOIN cut ON xor(c.conv_id, 1) = cut.conv_id
      WHERE turn >= cut OR turn IS NULL),
b AS (SELECT pair_id, list({{'r': r, 'x': x}} ORDER BY turn, r, x) l FROM s GROUP BY pair_id),
p AS (SELECT pair_id, a.l AS c, coalesce(b.l, []) AS j FROM a LEFT JOIN b USING (pair_id)),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, greatest(len(c), len(j)) + 1), lambda i: c[i] IS DISTINCT FROM j[i])) - 1,
        len(c)) AS k FROM p),
e AS (SELECT pair_id, k, c[1:k] AS q, c[k + 1:] AS c, j[k + 1:] AS j FROM n)
SELECT pair_id, k::INTEGER AS prompt_turns, {_sql_render('q')} AS prompt,
    len(c)::INTEGER AS chosen_turns, {_sql_render('c')} AS chosen, {_sql_mask('c')} AS chosen_mask,
    len(j)::INTEGER AS rejected_turns, {_sql_render('j')} AS rejected, {_sql_mask('j')} AS rejected_mask
FROM e
"""
