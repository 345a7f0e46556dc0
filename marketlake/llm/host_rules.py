"""Host-level quality rules.

Every document is measured inside its own row (words, symbols, repeated lines, repeated three-word
windows).  Rule failures are counted by host with map-side sums, so a host holding a third of the
rows costs one partial row per task.  Per rule the rates of the *other* hosts give a host its empirical
beta prior by moments: their spread less what binomial noise alone would give (hosts weigh
``n / (n + WEIGHT)``, so neither a crowd of tiny hosts nor one huge host settles the prior).  Its shrunk
rate is ``(failures + a) / (documents + a + b)``.  A host is rejected when for some rule its shrunk rate lies
more than ``OUTLIER`` standard deviations of the prior above the prior's mean and is over ``LEAST_RATE``, or
is over ``HOST_LIMIT`` whatever the others do.  The verdict is joined back to its documents.  Hosts that
are all alike leave no spread, so all of them are kept; a host that is alone is judged by its own rate.

Null text counts as empty (no words, fails the length rule); a document without a host is judged by
the base rules alone; repeated rows are judged row by row and count as often as they occur.  An
empty table gives no rows.  The result has only the columns named here, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, WORD, materialize, table, whole_text

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Failure of one document, by rule; a host is judged on all of them.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "n_dup_lines > 30",
    "word_size": "word_chars > 12 * n_words",
}
#: A host far out in the prior is rejected from LEAST_RATE on, any host beyond HOST_LIMIT.
OUTLIER, LEAST_RATE, HOST_LIMIT = 3.0, 0.2, 0.7
#: Documents from which on a host counts for more than half in the prior.
WEIGHT = 100.0
#: Bounds of the prior's strength (a + b), used when host rates barely or wildly vary.
WEAKEST, STRONGEST = 2.0, 1e6
#: What is left of a sum of other hosts when there is none but rounding.
TINY = 1e-9


def _let(value: Column, body) -> Column:
    """``body`` of a value computed once per row (a lambda variable is never inlined again)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text."""
    def covered(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def places(s: Column) -> Column:
            again = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["x"] == x["x"], F.lit(False))
                             | F.coalesce(F.get(s, j + 1)["x"] == x["x"], F.lit(False)))
            at = F.array_sort(F.transform(again, lambda x: x["i"]))
            return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                               lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"),
                                                     p.alias("last")),
                               lambda a: a["n"])

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(ordered, places))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return _let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(_let(windows(w), covered)))


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the document measures."""
    text = F.col("t")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    measures = docs.select("doc_id", F.col(host).alias("host"), whole_text().alias("t")).select(
        "doc_id", "host",
        _let(F.filter(F.split(text, BLANK + "+"), lambda x: x != ""),
             lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r"))).alias("w"),
        (F.char_length(text) - F.regexp_count(text, F.lit(BLANK))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    return measures.select("doc_id", "host", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
                           "n_dup_lines", F.col("w.r").cast("long").alias("n_repeat_words"))


def _moments(counts: str) -> dict[str, str]:
    """Sums over all hosts, as SQL (doubles ``n`` and one failure count per rule)."""
    w = f"(n / (n + {WEIGHT}))"
    sums = {"w": w, "wn": f"{w} / n", "ww": f"{w} * {w}", "wwn": f"{w} * {w} / n"}
    for x in RULES:
        sums |= {f"m_{x}": f"{w} * f_{x} / n", f"q_{x}": f"{w} * f_{x} / n * f_{x} / n"}
    return {f"{counts}_{k}": f"sum({v})" for k, v in sums.items()}


def _priors() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """SQL steps from the sums (all_*) and a host's own counts to its verdict; Spark and other engines read it alike."""
    w = f"(n / (n + {WEIGHT}))"
    own = {"w": w, "wn": f"{w} / n", "ww": f"{w} * {w}", "wwn": f"{w} * {w} / n"}
    others = {f"o_{k}": f"all_{k} - {v}" for k, v in own.items()}
    for x in RULES:
        others |= {f"o_m_{x}": f"all_m_{x} - {w} * f_{x} / n", f"o_q_{x}": f"all_q_{x} - {w} * f_{x} / n * f_{x} / n"}
    fitted = {}
    for x in RULES:
        m = f"(o_m_{x} / o_w)"
        noise, share = "(o_wn - o_wwn / o_w)", "(o_w - o_ww / o_w - o_wn + o_wwn / o_w)"
        variance = f"((o_q_{x} - o_m_{x} * o_m_{x} / o_w - {m} * (1 - {m}) * {noise}) / {share})"
        fitted[f"p_{x}"] = f"case when lonely then 0 else {m} end"
        fitted[f"s_{x}"] = (f"case when lonely then 0 when {share} > {TINY} and {variance} > {TINY} then "
                            f"least(greatest({m} * (1 - {m}) / {variance} - 1, {WEAKEST}), {STRONGEST}) else {STRONGEST} end")
    verdict = {}
    for x in RULES:
        verdict[f"rate_{x}"] = f"(f_{x} + p_{x} * s_{x}) / (n + s_{x})"
        verdict[f"bad_{x}"] = (f"(f_{x} + p_{x} * s_{x}) / (n + s_{x}) > case when lonely then {HOST_LIMIT} else least(greatest("
                               f"p_{x} + {OUTLIER} * sqrt(greatest(p_{x} * (1 - p_{x}), 0) / (s_{x} + 1)), {LEAST_RATE}), {HOST_LIMIT}) end")
    return others, fitted, verdict


def _listed(columns: dict[str, str]) -> list[str]:
    return [f"{v} as {k}" for k, v in columns.items()]


#: Fewer other hosts than this weight, in sum: the host is alone.
LONELY = f"o_w < {TINY} as lonely"


def host_verdicts(measured: DataFrame) -> DataFrame:
    """host, documents, one shrunk failure rate per rule and ``host_kept``."""
    hosts = materialize(measured.where("host is not null").groupBy("host").agg(
        F.count("*").cast("double").alias("n"),
        *[F.sum(F.expr(f"cast({rule} as int)")).cast("double").alias(f"f_{name}") for name, rule in RULES.items()]))
    total = hosts.agg(*[F.expr(v).alias(k) for k, v in _moments("all").items()]).first().asDict()
    others, fitted, verdict = _priors()
    judged = (hosts.select("*", *[F.lit(v).cast("double").alias(k) for k, v in total.items()])
              .selectExpr("*", *_listed(others)).selectExpr("*", LONELY).selectExpr("*", *_listed(fitted))
              .selectExpr("host", "cast(n as long) as documents", *_listed(verdict)))
    return judged.select("host", "documents", *[f"rate_{x}" for x in RULES],
                         (~F.expr(" or ".join(f"bad_{x}" for x in RULES))).alias("host_kept"))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every document."""
    measured = materialize(measure(docs, host))
    verdicts = host_verdicts(measured).select("host", "host_kept")
    failed = F.expr(f"{RULES['short']} or {RULES['repeats']}")
    return (measured.withColumn("base_failed", failed).join(verdicts, "host", "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce("host_kept", F.lit(True)))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept"))


def op3(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    others, fitted, verdict = (", ".join(_listed(c)) for c in _priors())
    return rf"""
with d as (select doc_id, source as host, coalesce(text, '') as t from documents),
w as (select doc_id, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from d),
word as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from w),
win as (select doc_id, p, x || ' ' || lead(x, 1) over o || ' ' || lead(x, 2) over o as x from word
        window o as (partition by doc_id order by p)),
twice as (select doc_id, p, count(*) over (partition by doc_id, x) as c from win where x is not null),
covered as (select doc_id, count(distinct q) as r from (select doc_id, unnest([p, p + 1, p + 2]) as q from twice
            where c >= 2) group by doc_id),
ln as (select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
m as (select d.doc_id, d.host, cast(len(w.w) as bigint) as n_words,
        cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
        cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) as n_symbols,
        cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
        cast(coalesce(r, 0) as bigint) as n_repeat_words
      from d join w using (doc_id) join ln using (doc_id) left join covered using (doc_id)),
h as (select host, cast(count(*) as double) as n,
        {", ".join(f"cast(sum(cast(({rule}) as int)) as double) as f_{n}" for n, rule in RULES.items())}
      from m where host is not null group by host),
t as (select {", ".join(_listed(_moments("all")))} from h),
o as (select *, {others} from h, t),
q as (select *, {LONELY} from o),
p as (select *, {fitted} from q),
v as (select host, not ({" or ".join(f"bad_{x}" for x in RULES)}) as host_kept from (select host, {verdict} from p))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({RULES['short']} or {RULES['repeats']}) as base_failed,
  not ({RULES['short']} or {RULES['repeats']}) and coalesce(host_kept, true) as kept
from m left join v using (host)"""


ORACLE_SQL = _oracle()
