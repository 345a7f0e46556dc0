"""Fill-in-middle transformation, cut at whole tokens.

A token is a run of blanks with the word after it, or the blanks that end the text.  A worker views a
part's UTF-8 as 64-bit words (SWAR): arithmetic on whole words marks the byte that ends each token and
each byte that starts a code point, ``bitwise_count`` per word and a running sum give a rank directory,
a binary search in it finds the word of the k-th token end, and a multiplication inside that word finds
the byte.  No token is ever built.  The cuts go back to the JVM, which puts the output together.

Null text counts as empty; an empty text, and one that contains a sentinel, stays plain.  A null doc_id
draws as the empty id.  Rows that repeat a doc_id are cut each by their own text.  An empty table gives no
rows.  The result has only the columns named here, so others cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import PART_BYTES, ship, table, whole_text

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts that are transformed, and of those the percent in suffix-prefix-middle order.
RATE, SPM_SHARE, SEED = 50, 80, 42

CUTS = StructType([StructField("n", LongType()), StructField("prefix_bytes", IntegerType()),
                   StructField("middle_bytes", IntegerType()), StructField("prefix_chars", LongType()),
                   StructField("middle_chars", LongType())])
_CUTS = pa.struct([(f.name, pa.int32() if f.name.endswith("bytes") else pa.int64()) for f in CUTS])

ONES = np.uint64(0x0101010101010101)
LOW, HIGH = ONES * np.uint64(0x7F), ONES * np.uint64(0x80)
BLANK = 0x20


def blank_lanes(w: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is ASCII white space (0x20, 0x09-0x0D)."""
    seven = w & LOW
    from_tab = seven + ONES * np.uint64(0x80 - 0x09)
    past_return = seven + ONES * np.uint64(0x80 - 0x0E)
    not_space = (seven ^ (ONES * np.uint64(BLANK))) + LOW
    return ((from_tab & ~past_return) | ~not_space) & ~w & HIGH


class Marks:
    """Marked bytes of a buffer with a rank directory: one running count per 64-bit word."""

    def __init__(self, lanes: np.ndarray):
        self.lanes = lanes
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(lanes), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before byte ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte << np.uint64(3))) - np.uint64(1)
        return self.upto[word] + np.bitwise_count(self.lanes[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte that holds the k-th mark (from 1)."""
        word = np.searchsorted(self.upto, k, "left") - 1
        left = (k - self.upto[word]).astype(np.uint64)
        running = ((self.lanes[word] >> np.uint64(7)) & ONES) * ONES      # lane j: marks in lanes 0 to j
        reached = ((running | HIGH) - left * ONES) & HIGH
        return word * 8 + 8 - np.bitwise_count(reached)


def token_marks(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[Marks, Marks]:
    """Marks of token ends and of code-point starts; every text is followed by a blank that is not its own."""
    padded = np.full((len(data) // 8 + 2) * 8, BLANK, np.uint8)
    padded[: len(data)] = data
    w = padded.view("<u8")
    blank = blank_lanes(w)
    after = (blank >> np.uint64(8)) | (np.append(blank[1:], HIGH) << np.uint64(56))
    ends = ~blank & after & HIGH
    last = stops[stops > starts] - 1                                      # blanks that end a text end a token
    last = last[blank[last >> 3] >> ((last & 7).astype(np.uint64) * np.uint64(8)) & np.uint64(0x80) != 0]
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7).astype(np.uint64) * np.uint64(8)))
    return Marks(ends), Marks(~(w & ~(w << np.uint64(1))) & HIGH)


def cut_part(texts: pa.Array, h1: np.ndarray, h2: np.ndarray) -> pa.Array:
    """Token count and cuts of each text of a part."""
    joined = pc.binary_join_element_wise(texts.cast(pa.large_string()), pa.scalar(" ", pa.large_string()),
                                         pa.scalar("", pa.large_string()))
    _, offsets, data = joined.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(joined) + 1, joined.offset * 8)
    data = np.frombuffer(data, np.uint8, bounds[-1])
    starts, stops = bounds[:-1], bounds[1:] - 1
    ends, chars = token_marks(data, starts, stops)
    base = ends.rank(starts)
    n = ends.rank(stops) - base
    first, second = h1 % (n + 1), h2 % (n + 1)

    def cut(units: np.ndarray) -> np.ndarray:
        at = starts.copy()
        some = units > 0
        at[some] = ends.select(base[some] + units[some]) + 1
        return at

    a, b = cut(np.minimum(first, second)), cut(np.maximum(first, second))
    ca, cb = chars.rank(a), chars.rank(b)
    columns = [n, (a - starts).astype(np.int32), (b - a).astype(np.int32), ca - chars.rank(starts), cb - ca]
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CUTS)], fields=list(_CUTS))


@F.arrow_udf(CUTS)
def _cuts(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    one, two, made, lo = h1.to_numpy(), h2.to_numpy(), [], 0
    while lo < len(upto):      # parts of about PART_BYTES, so what a worker holds does not follow Spark's batches
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PART_BYTES, "right")))
        made.append(cut_part(texts.slice(lo, hi - lo), one[lo:hi], two[lo:hi]))
        lo = hi
    return pa.concat_arrays(made) if made else pa.array([], _CUTS)


def draws(key: str = "doc_id", seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers that the seed and the id settle."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: int = RATE,
                   spm_share: int = SPM_SHARE, seed: int = SEED) -> DataFrame:
    """``key``, n (tokens), form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output."""
    ship(docs.sparkSession)
    h1, h2, h3, h4 = draws(key, seed)
    sentinel = F.greatest(*[F.contains(F.col("t"), F.lit(s)) for s in (PREFIX, SUFFIX, MIDDLE)])
    rows = docs.select(F.col(key), whole_text(text).alias("t"), h1.alias("h1"), h2.alias("h2"),
                       (h3 % 100 < rate).alias("chosen"), (h4 % 100 < spm_share).alias("spm"))
    rows = rows.select(key, "t", _cuts("t", "h1", "h2").alias("c"),
                       F.when((F.col("t") == "") | sentinel | ~F.col("chosen"), "plain")
                       .when(F.col("spm"), "spm").otherwise("psm").alias("form"))
    raw, a, b = F.col("t").cast("binary"), F.col("c.prefix_bytes"), F.col("c.middle_bytes")
    prefix, middle = F.substring(raw, F.lit(1), a), F.substring(raw, a + 1, b)
    suffix = F.substring(raw, a + b + 1, F.octet_length("t"))

    def joined(*pieces) -> Column:
        return F.concat(*[F.lit(p).cast("binary") if isinstance(p, str) else p for p in pieces]).cast("string")

    output = (F.when(F.col("form") == "plain", F.col("t"))
              .when(F.col("form") == "psm", joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
              .otherwise(joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)))
    changed = F.col("form") != "plain"
    return rows.select(key, F.col("c.n").alias("n"), "form", F.when(changed, F.col("c.prefix_chars")).alias("prefix_chars"),
                       F.when(changed, F.col("c.middle_chars")).alias("middle_chars"), output.alias("output"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text before the transformation, from output and form alone: a transformed text holds each sentinel
    once (no sentinel can arise where text and sentinel meet)."""
    pieces = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    one, two, three = (F.get(pieces, F.lit(i)) for i in (1, 2, 3))
    return (F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", F.concat(one, three, two))
            .otherwise(F.concat(two, three, one)))


def op11(spark, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


ORACLE_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
k as (select doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as k,
        cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
        cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from d),
c as (select *, cast(len(k) as bigint) as n, least(h1 % (len(k) + 1), h2 % (len(k) + 1)) as a,
        greatest(h1 % (len(k) + 1), h2 % (len(k) + 1)) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain'
             when h4 % 100 < 80 then 'spm' else 'psm' end as form from k),
p as (select *, array_to_string(k[1:a], '') as prefix, array_to_string(k[a + 1:b], '') as middle,
        array_to_string(k[b + 1:n], '') as suffix from c)
select doc_id, n, form, case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(t) as restored_sha256
from p"""
