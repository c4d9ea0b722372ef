"""Secret scans by a trigram inverted index, with DataFrame functions only.

Each rule's pattern is read on the driver into a Boolean query of trigrams that its matches must hold: an OR of ANDs.
The index has, for each block of documents, the postings of the trigrams that some query names. A block's postings
are intersected and united as each query says, which gives each rule's candidate documents, and only these are
searched with the pattern. A rule whose pattern has no mandatory trigram scans every text.
"""

from __future__ import annotations

import re._constants as re_kinds
import re._parser as re_parser
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documents to a block of the index: the length of a posting list at most, some by chance more.
BLOCK_DOCS = 4096
#: Strings, and ANDs of a query, that are kept apart; beyond them a weaker query is taken.
MOST = 64
#: The query that every text meets.
ANY: list[frozenset[str]] = [frozenset()]
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _either(queries: list[list[frozenset[str]]]) -> list[frozenset[str]]:
    """OR; an AND that holds another of them is left out."""
    some = {x for q in queries for x in q}
    some = [x for x in some if not any(y < x for y in some)]
    return sorted(some, key=sorted) if len(some) <= MOST else ANY


def _both(a: list[frozenset[str]], b: list[frozenset[str]]) -> list[frozenset[str]]:
    """AND; where it is too long, the more telling of the two."""
    if len(a) * len(b) > MOST:
        return max(a, b, key=lambda q: min(map(len, q)))
    return _either([[x | y for x in a for y in b]])


def _of_strings(strings: set[str]) -> list[frozenset[str]]:
    """The trigrams of one of the strings, as lower case."""
    return _either([[frozenset(x[i : i + 3] for i in range(len(x) - 2))] for x in strings])


def _strings(kind, what) -> set[str] | None:
    """All strings that a part of a pattern matches, as lower case, if they are few and ASCII."""
    out: set[str] | None = None
    if kind is re_kinds.LITERAL:
        out = {chr(what).lower()}
    elif kind is re_kinds.IN and what[0][0] is not re_kinds.NEGATE:
        out = set()
        for k, v in what:
            if k is re_kinds.CATEGORY or k is re_kinds.RANGE and v[1] - v[0] >= MOST:
                return None
            out |= {chr(c).lower() for c in (range(v[0], v[1] + 1) if k is re_kinds.RANGE else [v])}
    elif kind is re_kinds.SUBPATTERN:
        out = _joined(what[3])
    elif kind is re_kinds.BRANCH:
        some = [_joined(x) for x in what[1]]
        out = None if None in some else set().union(*some)
    elif kind is re_kinds.MAX_REPEAT and what[1] is not re_kinds.MAXREPEAT and what[1] <= 8:
        own, out = _joined(what[2]), None
        if own is not None and len(own) ** what[1] <= MOST:
            out = {"".join(x) for n in range(what[0], what[1] + 1) for x in product(own, repeat=n)}
    elif kind is re_kinds.AT:
        out = {""}
    return out if out is not None and len(out) <= MOST and all(map(str.isascii, out)) else None


def _joined(parts) -> set[str] | None:
    out = {""}
    for kind, what in parts:
        own = _strings(kind, what)
        if own is None or len(out) * len(own) > MOST:
            return None
        out = {a + b for a in out for b in own}
    return out


def _query(parts) -> list[frozenset[str]]:
    """Of a row of parts: neighbours that match few strings are put together, the others speak for themselves."""
    out, held = ANY, {""}
    for kind, what in parts:
        own = _strings(kind, what)
        if own is not None and len(held) * len(own) <= MOST:
            held = {a + b for a in held for b in own}
            continue
        out, held = _both(out, _of_strings(held)), {""}
        if own is not None:
            held = own
        elif kind is re_kinds.SUBPATTERN:
            out = _both(out, _query(what[3]))
        elif kind is re_kinds.BRANCH:
            out = _both(out, _either([_query(x) for x in what[1]]))
        elif kind is re_kinds.MAX_REPEAT and what[0]:
            out = _both(out, _query(what[2]))
    return _both(out, _of_strings(held))


def trigram_query(pattern: str) -> list[list[str]]:
    """ANDs of lower-case trigrams, of which every match of the pattern, in lower case, meets one; empty: the
    pattern has no mandatory trigram. ValueError for syntax that Python's and Java's patterns do not share."""
    try:
        found = _query(re_parser.parse(pattern))
    except re_parser.error as e:
        raise ValueError(f"{pattern}: {e}") from e
    return [] if frozenset() in found else [sorted(x) for x in found]


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Of a match, group part has to be at least least long, or the match is dropped."""

    kind: str
    pattern: str
    part: int = 0
    least: int = 1

    @cached_property
    def query(self) -> list[list[str]]:
        return trigram_query(self.pattern)


BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", part=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),  # a shorter run is no match, and a longer one is the same match
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE + MORE


def trigram_postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(block, trigram, ids): the inverted index of the trigrams that the rules' queries name. docs has id and text;
    rows without either are not in it. A list is bounded by its block."""
    grams = sorted({g for r in rules for q in r.query for g in q})
    known = docs.where("id is not null and text is not null")
    blocks = 1 + known.count() // BLOCK_DOCS
    low = known.select("id", F.lower("text").alias("low"))  # once a text: the lookups below share it
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    hits = low.select("id", F.explode(found).alias("trigram")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return hits.groupBy("block", "trigram").agg(F.collect_set("id").alias("ids"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, one boolean per rule with a query): the postings of each block, intersected and united as the rules say."""
    lists = postings.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("lists"))
    asked = [r for r in rules if r.query]
    none = F.array().cast("array<bigint>")
    of = lambda g: F.coalesce(F.col("lists")[g], none)
    found = [reduce(F.array_union, [reduce(F.array_intersect, map(of, q)) for q in r.query]) for r in asked]
    pairs = lists.select(F.explode(F.array(*[F.struct(F.lit(r.kind).alias("kind"), x.alias("ids")) for r, x in zip(asked, found, strict=True)])).alias("x"))
    pairs = pairs.select("x.kind", F.explode("x.ids").alias("id"))
    return pairs.groupBy("id").agg(*[F.max(F.col("kind") == r.kind).alias(f"may_{r.kind}") for r in asked])


def _spans(rule: Rule, rank: int) -> Column:
    """Array of (start, rank, end, kind) of the rule's matches, in code points. The text between matches and the
    matches themselves alternate, so their lengths give every start."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = whole if rule.part == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.part))
    lengths = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(whole, lambda x: F.length(x)).alias("size"),
        F.transform(part, lambda x: F.length(x)).alias("part"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["gap"]
        b = a + F.coalesce(x["size"], F.lit(0))
        one = F.array(F.struct(a.alias("start"), F.lit(rank).alias("rank"), b.alias("end"), F.lit(rule.kind).alias("kind")))
        return F.struct(b.alias("at"), F.when(x["part"] >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.filter(lengths, lambda x: x["gap"].isNotNull()), start, step, lambda acc: acc["out"])


def secret_scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Spans of secrets in every whole text: id, text, the other columns of keep, and spans (array of start, rank,
    end, kind, ordered by start, then by the rules' order). Starts and ends are code points, the end is exclusive.

    Matches of a rule are leftmost and do not overlap; those of different rules may. Null text has no
    spans; rows with a null id are not in the index and so are searched by every rule; rows that repeat an id
    share its candidate rules and give a row each. An empty table gives an empty result. Columns that are
    not kept are not read."""
    kept = [c for c in keep if c not in (id_col, text_col)]
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.struct(*kept).alias("kept") if kept else F.lit(None).alias("kept"))
    none = F.array().cast(SPAN)
    if any(r.query for r in rules):
        found = candidates(trigram_postings(source, rules), rules).withColumnRenamed("id", "found")
        source = source.withColumn("at", F.coalesce("id", F.xxhash64("text")))  # null ids are dealt out by their texts
        source = source.join(found.hint("shuffle_hash"), (F.col("at") == F.col("found")) & (F.col("id") == F.col("found")), "left")
    per_rule = [F.when(F.col("text").isNotNull() & (F.col(f"may_{r.kind}") | F.col("id").isNull()) if r.query else F.col("text").rlike(r.pattern), _spans(r, k)).otherwise(none) for k, r in enumerate(rules)]
    return source.select(F.col("id").alias(id_col), F.col("text").alias(text_col), *(F.col("kept")[c].alias(c) for c in kept), F.array_sort(F.concat(*per_rule)).alias("spans"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    whole = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
