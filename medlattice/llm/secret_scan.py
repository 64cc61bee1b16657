"""Secret scan over an inverted index of trigrams.

A Boolean query over trigrams is derived from each rule's pattern: a text can match only if it holds
them. Postings (trigram, document) are kept for the trigrams that the rules ask for, intersected per
document, and only the remaining (rule, document) candidates are verified with the pattern. Rules
without mandatory trigrams are run over every text.

Everything that touches rows is a column expression. The postings are counted sets per document, so
a frequent trigram is no hot key. Candidates carry no text: up to ``BROADCAST_ROWS`` of them are
broadcast, beyond that the texts are joined by their id.

Positions come without a position function: the pieces between the matches and the matches
themselves, alternating, add up to the text, so their lengths give every start and end.

Defined cases: null or empty texts have no spans; rows that share a ``doc_id`` (or have none) share
their candidates, which verification makes exact; repeated rows are reported each; an empty table
gives an empty result; other columns are ignored by ``spans`` and kept by ``redacted``.
"""

from __future__ import annotations

import re._parser as patterns
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import cut_lineage, packed
from medlattice.session import broadcast_if_small

#: candidates (an id and a list of rule numbers each, about 40 bytes) that are broadcast at most
BROADCAST_ROWS = 200_000
#: strings that a finite part of a pattern is spelled out into at most
SPELLED = 16


@dataclass(frozen=True)
class Rule:
    """A match counts when its group ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# Kinds and patterns of the base scan, then well-known public credential formats.
# Runs of [0-9a-f] and of [A-Z0-9] are matched to their end, so asking for the length inside the
# pattern gives the same spans as dropping short matches; for assignments it would not.
RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repository_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment_key", r"sk_live_[A-Za-z0-9]{16,}"),
)

_NONE = "cast(array() AS array<struct<start: int, number: int, kind: string, end: int>>)"

#: (clause AND clause ...), a clause being (set of trigrams OR set of trigrams ...)
Query = tuple[tuple[frozenset[str], ...], ...]


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> Query:
    """Mandatory lower-case trigrams of a pattern; empty when there are none.

    Finite parts (characters, small classes, branches, optional parts) are spelled out as sets of
    strings and joined to their neighbours; anything else ends the running strings.
    """
    clauses: list[tuple[frozenset[str], ...]] = []

    def end(strings: set[str]) -> None:
        if strings and all(len(s) >= 3 for s in strings):
            clauses.append(tuple(sorted((_grams(s) for s in strings), key=sorted)))

    def finite(op, value) -> set[str] | None:
        """All strings of a node, if they are few."""
        name = str(op)
        if name == "LITERAL":
            return {chr(value).lower()}
        if name == "IN":
            if len(value) <= SPELLED and all(str(o) == "LITERAL" for o, _ in value):
                return {chr(v).lower() for _, v in value}
            return None
        if name == "SUBPATTERN":
            return spell(value[3])
        if name == "BRANCH":
            found: set[str] = set()
            for part in value[1]:
                strings = spell(part)
                if strings is None:
                    return None
                found |= strings
            return found if len(found) <= SPELLED else None
        if name in ("MAX_REPEAT", "MIN_REPEAT") and value[1] <= 4:
            strings, out, power = spell(value[2]), set(), {""}
            for times in range(value[1] + 1):
                if strings is None or len(power) > SPELLED:
                    return None
                out |= power if times >= value[0] else set()
                power = {a + b for a in power for b in strings}
            return out if len(out) <= SPELLED else None
        return None

    def spell(nodes) -> set[str] | None:
        strings = {""}
        for op, value in nodes:
            more = finite(op, value)
            if more is None or len(strings) * len(more) > SPELLED:
                return None
            strings = {a + b for a in strings for b in more}
        return strings

    def walk(nodes, running: set[str]) -> set[str]:
        for op, value in nodes:
            more = finite(op, value)
            if more is not None and len(running) * len(more) <= SPELLED:
                running = {a + b for a in running for b in more}
                continue
            end(running)
            if more is not None:
                running = more
            else:
                if str(op) == "SUBPATTERN":
                    end(walk(value[3], {""}))
                elif str(op) in ("MAX_REPEAT", "MIN_REPEAT") and value[0] >= 1:
                    end(walk(value[2], {""}))
                running = {""}
        return running

    end(walk(patterns.parse(pattern), {""}))
    return tuple(clauses)


def vocabulary(rules: tuple[Rule, ...] = RULES) -> list[str]:
    return sorted({g for rule in rules for clause in trigram_query(rule.pattern) for grams in clause for g in grams})


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Inverted index: one row (trigram, doc_id) for each wanted trigram that a text holds."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in trigrams]))
    return cut_lineage(low.select("doc_id", F.explode(held).alias("trigram")), "trigram-postings")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and the numbers of the rules whose trigram query it satisfies."""
    held = index.groupBy("doc_id").agg(F.collect_set("trigram").alias("held"))
    tests = []
    for number, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query:
            test = F.lit(True)
            for clause in query:
                either = F.lit(False)
                for grams in clause:
                    both = F.lit(True)
                    for g in sorted(grams):
                        both = both & F.array_contains("held", g)
                    either = either | both
                test = test & either
            tests.append(F.when(test, F.lit(number)))
    found = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<int>")
    return held.select("doc_id", found.alias("rules")).where(F.size("rules") > 0)


def _verified(rule: Rule, number: int) -> Column:
    """Spans of one rule in ``text`` as array of (start, number, kind, end); code points, end exclusive."""
    literal = _sql(rule.pattern)
    match, group = (f"regexp_extract_all(text, '{literal}', {g})" for g in (0, rule.group))
    pieces = f"split(text, '{literal}', -1)"
    parts = (
        f"zip_with(zip_with({match}, {group}, (m, g) -> struct(length(m) AS len, length(g) >= {rule.least} AS ok)), {pieces},"
        f" (m, p) -> struct(length(p) AS gap, m.len AS len, m.ok AS ok))"
    )
    # Appending copies what is there, so parts are added up in runs of about the square root of their number, each from
    # where the runs before it end.
    length = "aggregate(run, 0, (t, x) -> t + x.gap + coalesce(x.len, 0))"
    begins = f"aggregate(runs, array(0), (s, run) -> array_append(s, element_at(s, -1) + {length}))"
    spans = (
        f"aggregate(run, struct(begins[i] AS at, {_NONE} AS spans),"
        f" (s, x) -> struct(s.at + x.gap + coalesce(x.len, 0) AS at, CASE WHEN x.ok THEN array_append(s.spans, named_struct('start', s.at + x.gap,"
        f" 'number', {number}, 'kind', '{rule.kind}', 'end', s.at + x.gap + x.len)) ELSE s.spans END AS spans), s -> s.spans)"
    )
    cut = "transform(sequence(0, cast((size(parts) - 1) div width AS int)), k -> slice(parts, k * width + 1, width))"
    inner = f"transform(array({begins}), begins -> flatten(transform(runs, (run, i) -> {spans})))[0]"
    found = F.expr(
        f"transform(array({parts}), parts -> transform(array(greatest(1, cast(ceil(sqrt(size(parts))) AS int))), width ->"
        f" transform(array({cut}), runs -> {inner})[0])[0])[0]"
    )
    wanted = F.array_contains("rules", number) if trigram_query(rule.pattern) else F.lit(True)
    return F.when(wanted & F.col("text").rlike(rule.pattern), found)


def _sql(pattern: str) -> str:
    """A pattern as the inside of a SQL string literal."""
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _scanned(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``docs`` with one array of spans per rule (``spans_0`` and so on)."""
    index = postings(docs, vocabulary(rules))
    chosen, _ = broadcast_if_small(candidates(index, rules), "secret-candidates", BROADCAST_ROWS)
    chosen = chosen.select(F.col("doc_id").alias("candidate_id"), "rules")
    joined = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("candidate_id")), "left").drop("candidate_id")
    spans = {f"spans_{i}": F.coalesce(_verified(rule, i), F.expr(_NONE)) for i, rule in enumerate(rules)}
    return joined.withColumns(spans).drop("rules")


_TEXT = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"


def spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_<kind>`` of the base rules, ``base_spans`` and ``spans`` as text
    (kind:start:end by start, then rule order)."""
    found = _scanned(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), rules)
    numbers = range(len(rules))
    counts = [F.size(f"spans_{i}").cast("long").alias(f"n_{rules[i].kind}") for i in numbers if rules[i].base]
    base = F.sort_array(F.concat(*[F.col(f"spans_{i}") for i in numbers if rules[i].base]))
    every = F.sort_array(F.concat(*[F.col(f"spans_{i}") for i in numbers]))
    return found.select("doc_id", *counts, base.alias("base"), every.alias("every")).select(
        "doc_id", *[F.col(f"n_{r.kind}") for r in rules if r.base],
        F.expr(_TEXT.format("base")).alias("base_spans"), F.expr(_TEXT.format("every")).alias("spans"),
    )


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one."""
    found = _scanned(packed(docs, "doc_id", "text"), rules)
    every = F.sort_array(F.concat(*[F.col(f"spans_{i}") for i in range(len(rules))]))
    rows = found.select("row", "text", every.alias("every"))
    # as for the spans: runs of about the square root of their number, each with the piece of the text that it covers
    cut = "transform(sequence(0, cast((size(every) - 1) div width AS int)), k -> slice(every, k * width + 1, width))"
    ends = "aggregate(runs, array(0), (s, run) -> array_append(s, greatest(element_at(s, -1), array_max(transform(run, x -> x.end)))))"
    out = (
        "aggregate(run, struct(ends[i] AS at, '' AS out), (s, x) -> CASE WHEN x.start >= s.at THEN"
        " struct(x.end AS at, concat(s.out, substring(piece, s.at - ends[i] + 1, x.start - s.at), '[', x.kind, ']') AS out)"
        " ELSE struct(greatest(s.at, x.end) AS at, s.out AS out) END, s -> s.out)"
    )
    outs = f"transform(runs, (run, i) -> transform(array(substring(text, ends[i] + 1, ends[i + 1] - ends[i])), piece -> {out})[0])"
    inner = f"transform(array({ends}), ends -> concat(array_join({outs}, ''), substring(text, element_at(ends, -1) + 1)))[0]"
    text = F.expr(f"transform(array(greatest(1, cast(ceil(sqrt(size(every))) AS int))), width -> transform(array({cut}), runs -> {inner})[0])[0]")
    new = F.when(F.size("every") > 0, text).otherwise(F.col("text"))
    return rows.select(F.col("row").withField("text", new).alias("row")).select("row.*")
