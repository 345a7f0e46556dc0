"""Secret scans through a trigram inverted index.

A rule's pattern is parsed once; every run of characters that a match must contain gives mandatory
trigrams, so each rule becomes a Boolean query over (lower-cased) trigrams.  The index holds, for the
trigrams that the rules ask for, one posting per document.  A query's conjunctions are intersected
by counting a document's postings per conjunction; documents that satisfy one are candidates, and the
pattern itself verifies them on the whole text.  A rule without mandatory trigrams has no query and
scans every text.

Postings come one distinct (trigram, document) at a time and are counted, never gathered into lists,
so a trigram that every document holds is only many rows.  Null text counts as empty.  Rows are keyed
by (doc_id, text digest) with null-safe equality: repeated rows, null ids and one id with several
texts each keep their own result.  Only doc_id and the columns named here leave the operator.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, table, text_digest, whole_text


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0          # the group whose size counts
    least: int = 0          # its least number of characters


# The three base kinds; then published formats of well-known keys.
WORDS = ["password", "passwd", "secret", "token", "api_key", "apikey"]
BASE = [
    Rule("assign", "(" + "|".join(_either(w) for w in WORDS)
         + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),   # maximal runs: the same spans as runs of any size, short ones dropped
]
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = BASE + MORE
#: Strings tracked at once while a pattern is read; more end the run (a weaker query, never a wrong one).
MOST_STRINGS = 64
#: Values summed at once by a fold that appends; bits of the candidates' sieve and of one of its rows.
RUN = 64
SIEVE, SIEVE_ROW = 1 << 23, 32_768


def _grams(strings: set[str]) -> list[frozenset[str]] | None:
    """Conjunctions of which one holds, if one of the strings occurs; None: nothing is mandatory."""
    if not strings or min(map(len, strings)) < 3:
        return None
    return [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]


def _both(a, b):
    """Conjunction of two queries in disjunctive form."""
    if a is None or b is None:
        return b if a is None else a
    return list({x | y for x, y in product(a, b)}) if len(a) * len(b) <= MOST_STRINGS else min(a, b, key=len)


def _read(nodes) -> tuple[set[str] | None, list[frozenset[str]] | None]:
    """(every string it matches, if few and lower-cased; else None), (its query)."""
    run: set[str] | None = {""}
    query, exact = None, True
    for op, arg in nodes:
        strings, inner = None, None
        if op is rc.LITERAL:
            strings = {chr(arg).lower()}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
            strings = {chr(a).lower() for _, a in arg}
        elif op is rc.SUBPATTERN:
            strings, inner = _read(arg[3])
        elif op is rc.BRANCH:
            parts = [_read(p) for p in arg[1]]
            if all(s is not None for s, _ in parts):
                strings = set().union(*(s for s, _ in parts))
            if all(q is not None for _, q in parts):
                inner = [c for _, q in parts for c in q]
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            low, high, body = arg
            s, q = _read(body)
            if s is not None and low == high and low <= 4:
                strings = {"".join(x) for x in product(s, repeat=low)} if len(s) ** low <= MOST_STRINGS else None
            elif s is not None and (low, high) == (0, 1):
                strings = s | {""}
            inner = q if low else None
        elif op is rc.AT:
            continue
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        query = _both(_both(query, _grams(run)), inner if strings is None else _grams(strings) or inner)
        run, exact = {""}, False
    query = _both(query, _grams(run))
    return (run if exact else None), query


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """A disjunction of trigram sets, one of which every match contains in full; None: no such set."""
    return _read(rp.parse(pattern))[1]


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (gram, doc_id, digest) of the given trigrams, each document once per trigram."""
    found = _let(F.lower("t"), lambda low: F.filter(F.array(*[F.lit(g) for g in trigrams]), lambda g: F.contains(low, g)))
    return (docs.select("doc_id", whole_text().alias("t"), text_digest().alias("digest"))
            .select("doc_id", "digest", F.explode(found).alias("gram")).distinct())


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """doc_id, digest and ``kinds``: the rules of which a conjunction has all its postings there."""
    wanted: dict[str, list[tuple[str, int, int]]] = {}
    for kind, conjunctions in queries.items():
        for i, grams in enumerate(conjunctions):
            for g in sorted(grams):
                wanted.setdefault(g, []).append((kind, i, len(grams)))
    terms = F.create_map(*[x for g, uses in sorted(wanted.items()) for x in (F.lit(g), F.array(*[
        F.struct(F.lit(k).alias("kind"), F.lit(i).alias("part"), F.lit(n).alias("need")) for k, i, n in uses]))])
    hits = (index.select("doc_id", "digest", F.explode(F.element_at(terms, F.col("gram"))).alias("u"))
            .groupBy("doc_id", "digest", "u").count().where("count = u.need"))
    return hits.groupBy("doc_id", "digest").agg(F.collect_set("u.kind").alias("kinds"))


def _upto(values: Column) -> Column:
    """Running sums before each value of an array.

    Appending to an array copies it, so the sums are made in runs of ``RUN`` values, the runs' totals in runs
    again: ``n`` values cost about ``n * RUN`` copies, not ``n * n``."""
    def flat(v: Column) -> Column:
        none = F.array().cast("array<long>")
        return F.aggregate(v, F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def runs(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / RUN).cast("int") - 1), lambda r: F.slice(v, r * RUN + 1, F.lit(RUN)))

    def added(totals_of, pieces: Column) -> Column:
        totals = F.transform(pieces, lambda r: F.aggregate(r, F.lit(0).cast("long"), lambda s, x: s + x))
        return _let(totals_of(totals), lambda before: F.flatten(F.transform(
            pieces, lambda r, i: _let(F.get(before, i), lambda base: F.transform(flat(r), lambda x: x + base)))))

    def once(v: Column) -> Column:
        return F.when(F.size(v) <= RUN, flat(v)).otherwise(_let(runs(v), lambda p: added(flat, p)))

    def twice(v: Column) -> Column:
        return F.when(F.size(v) <= RUN, flat(v)).otherwise(_let(runs(v), lambda p: added(once, p)))
    return _let(values, twice)


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """Spans of one rule in a text: the leftmost non-overlapping matches that are long enough.

    Starts are running sums over the pieces between matches, so no position leaves the JVM."""
    pattern = F.lit(rule.pattern)
    match = F.regexp_extract_all(text, pattern, F.lit(0))
    sized = match if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.filter(F.transform(
        F.arrays_zip(match.alias("m"), sized.alias("s"), F.split(text, rule.pattern).alias("p")),
        lambda x: F.struct(F.char_length(x["p"]).cast("long").alias("gap"), F.char_length(x["m"]).cast("long").alias("size"),
                           (F.char_length(x["s"]) >= rule.least).alias("ok"))), lambda x: x["size"].isNotNull())

    def placed(steps: Column) -> Column:
        before = _upto(F.transform(steps, lambda x: x["gap"] + x["size"]))
        spans = F.transform(F.arrays_zip(steps.alias("x"), before.alias("at")), lambda z: F.when(z["x"]["ok"], F.struct(
            (z["at"] + z["x"]["gap"]).cast("int").alias("start"), F.lit(order).alias("ord"),
            (z["at"] + z["x"]["gap"] + z["x"]["size"]).cast("int").alias("end"))))
        return F.filter(spans, lambda x: x.isNotNull())
    return _let(steps, placed)


NONE = "array<struct<start:int,ord:int,end:int>>"


def _sieve(hits: DataFrame) -> DataFrame:
    """``SIEVE`` bits of the candidates' keys, as rows (slice, bits) of 4,096 bytes: a fixed size."""
    bit = F.pmod(F.xxhash64("c_id", "c_digest"), F.lit(SIEVE))
    rows = hits.select((bit / SIEVE_ROW).cast("int").alias("slice"), (bit % SIEVE_ROW).alias("bit"))
    return rows.groupBy("slice").agg(F.bitmap_construct_agg("bit").alias("bits"))


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id and ``found``: array of (start, ord, end) by start, then rule order; code points.

    Only candidates' texts travel: a sieve of fixed size over the candidates' keys goes to every task and drops,
    in place, the texts of rows that cannot be one (and match no rule that scans); the join then decides."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q is not None}
    grams = sorted({g for q in indexed.values() for c in q for g in c})
    hits = materialize(candidates(build_index(docs, grams), indexed).withColumnsRenamed({"doc_id": "c_id", "digest": "c_digest"}))
    texts = docs.select("doc_id", whole_text().alias("t"), text_digest().alias("digest"))
    bit = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SIEVE))
    sieved = texts.withColumn("slice", (bit / SIEVE_ROW).cast("int")).withColumn("bit", bit % SIEVE_ROW).join(
        F.broadcast(_sieve(hits)), "slice", "left")
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    passed = F.coalesce(F.get(F.array(*[F.shiftright(byte, i) for i in range(8)]), (F.col("bit") % 8).cast("int")).bitwiseAND(1) == 1, F.lit(False))
    for r in rules:
        if r.kind not in indexed:
            passed |= F.col("t").rlike(r.pattern)
    sieved = sieved.select("doc_id", "digest", F.when(passed, F.col("t")).alias("t"))
    joined = sieved.join(hits, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("digest") == F.col("c_digest")), "left")
    none = F.array().cast(NONE)
    per_rule = [F.when(F.array_contains("kinds", r.kind) if r.kind in indexed else F.col("t").rlike(r.pattern),
                       _spans(r, i, F.col("t"))).otherwise(none) for i, r in enumerate(rules)]
    return joined.select("doc_id", F.array_sort(reduce(F.concat, per_rule)).alias("found"))


def spans_text(found: Column, rules: list[Rule] = RULES) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(kinds, s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of(order: int):
    return lambda s: s["ord"] == order


def op5(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["ord"] < len(BASE))
    return found.select(
        "doc_id",
        *[F.size(F.filter("found", _of(i))).cast("long").alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("found")).alias("spans"))


def _oracle() -> str:
    parts = []
    for i, r in enumerate(RULES):
        pat = r.pattern.replace("'", "''")
        parts.append(f"""
select doc_id, {i} as ord, '{r.kind}' as kind, unnest(m) as m, unnest(s) as s, generate_subscripts(m, 1) as k, g
from (select doc_id, regexp_extract_all(t, '{pat}') as m, regexp_extract_all(t, '{pat}', {r.group}) as s,
        list_transform(regexp_split_to_array(t, '{pat}'), lambda x: length(x)) as g from d)""")
    least = " ".join(f"when {i} then {r.least}" for i, r in enumerate(RULES))
    counts = ", ".join(f"count(*) filter (ord = {i}) as n_{r.kind}" for i, r in enumerate(BASE))
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
a as ({" union all ".join(parts)}),
b as (select *, list_sum(g[1:k]) + coalesce(sum(length(m)) over (partition by doc_id, ord order by k
        rows between unbounded preceding and 1 preceding), 0) as start from a),
c as (select doc_id, ord, cast(start as bigint) as start,
        kind || ':' || cast(cast(start as bigint) as varchar) || ':' || cast(cast(start + length(m) as bigint) as varchar) as x
      from b where length(s) >= case ord {least} end),
f as (select doc_id, {counts}, string_agg(x, ',' order by start, ord) filter (ord < {len(BASE)}) as base,
        string_agg(x, ',' order by start, ord) as spans from c group by doc_id)
select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join f using (doc_id)"""


ORACLE_SQL = _oracle()
