"""Fill-in-middle, line deduplication and importance resampling against plain Python."""

import hashlib
import random
from collections import Counter

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import PASSAGE, edge_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.llm import fill_middle, line_dedup, resampling
from marketlake.llm.queries import QUERIES

ROWS = [(r[0], r[1]) for r in edge_rows()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill in the middle ----------------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0aZ<>PSM漢🤦é\x00", max_size=40), min_size=1, max_size=8),
       st.lists(st.integers(0, 2**32 - 1), min_size=16, max_size=16))
def test_cuts_follow_the_token_pattern(texts, numbers):
    h1, h2 = np.array(numbers[:len(texts)]), np.array(numbers[8:8 + len(texts)])
    got = fill_middle.cut_part(pa.array(texts), h1, h2).to_pylist()
    for text, one, two, cut in zip(texts, h1.tolist(), h2.tolist(), got):
        units = brute.tokens(text)
        a, b = sorted((one % (len(units) + 1), two % (len(units) + 1)))
        prefix, middle = "".join(units[:a]), "".join(units[a:b])
        assert cut == {"n": len(units), "prefix_bytes": len(prefix.encode()), "middle_bytes": len(middle.encode()),
                       "prefix_chars": len(prefix), "middle_chars": len(middle)}


def test_every_byte_value_is_classified():
    w = np.arange(256, dtype=np.uint8).view("<u8")
    lanes = fill_middle.blank_lanes(w)
    got = [b for b in range(256) if int(lanes[b >> 3]) >> (8 * (b & 7) + 7) & 1]
    assert got == [9, 10, 11, 12, 13, 32]


def test_fill_in_middle_edges(spark, edge_dir):
    want = Counter()
    for i, t in ROWS:
        n, form, prefix, middle, output = brute.fill_in_middle(i, t)
        want[(i, n, form, prefix, middle, sha(output), sha(t or ""))] += 1
    assert Counter(tuple(r) for r in QUERIES["op11_fill_in_middle"](spark, edge_dir).collect()) == want


def test_forms_and_sentinels_of_the_operator(spark):
    texts = [PASSAGE, "a <P", "S> b", "<", "has <M> inside", "", " lead and trail \n", "<<S", "P><"]
    rows = [(i, texts[i % len(texts)]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = fill_middle.fill_in_middle(docs, rate=90, spm_share=40, seed=7).withColumn("back", fill_middle.restored())
    got = {r.doc_id: r for r in made.collect()}
    forms = Counter()
    for i, t in rows:
        n, form, prefix, middle, output = brute.fill_in_middle(i, t, 90, 40, 7)
        assert (got[i].n, got[i].form, got[i].prefix_chars, got[i].middle_chars, got[i].output) == (n, form, prefix, middle, output)
        assert got[i].back == t
        forms[form] += 1
    assert min(forms[f] for f in ("plain", "psm", "spm")) > 30


# ---- lines -----------------------------------------------------------------------------------------

def line_rows(seed=3):
    rng = random.Random(seed)
    common = [f"A line that many Documents hold, number {i:03d} of the set" for i in range(60)]
    short, rows = ["short line", "x" * 39, "É" * 39], []
    for i in range(220):
        lines = [rng.choice(common) for _ in range(rng.randint(0, 9))] + [rng.choice(short)]
        lines += [f"only document {i} has this line, which is long enough to count"] * rng.randint(0, 2)
        lines = [rng.choice(["", "  ", "\t", "\r"]) + (x.upper() if rng.random() < 0.2 else x) + rng.choice(["", " \x0b", "\r"]) for x in lines]
        rng.shuffle(lines)
        rows.append((rng.choice([i, i, i, i // 2, None]), "\n".join(lines)))
    return rows + [(500 + i, "É" * 40 + "\n" + " " + "a" * 39) for i in range(6)] + [(1, None), (2, "")]


def as_rows(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect())


@pytest.mark.parametrize("shard, piece, docs", [(1 << 16, 1 << 26, 5), (4, 1, 5), (7, 600, 2)])
def test_lines_against_brute_force(spark, monkeypatch, shard, piece, docs):
    """Also with many shards, and with one shard a piece (as many passes as shards)."""
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", shard)
    monkeypatch.setattr(line_dedup, "PIECE_BYTES", piece)
    rows = line_rows() if shard > 100 else line_rows()[:90]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert as_rows(line_dedup.dedup_lines(frame, min_docs=docs)) == Counter(brute.line_dedup(rows, min_docs=docs))


def test_line_query_edges(spark, edge_dir):
    want = Counter((i, n, gone, sha(kept)) for i, n, gone, kept in brute.line_dedup(ROWS))
    assert Counter(tuple(r) for r in QUERIES["op12_line_dedup"](spark, edge_dir).collect()) == want


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 2**63, (2, 50_000), dtype=np.uint64)
    a[1000:2000] = a[:1000]                      # halves that repeat are still different keys
    words, starts = line_dedup.build_levels(a, b)
    slots = line_dedup.Levels(words, starts).slots(a, b)
    assert np.array_equal(np.sort(slots), np.arange(len(a)))
    assert len(words) * 64 < 4 * len(a)          # bits a key
    shard = line_dedup._build_shard(pa.table({"shard": [0] * len(a), "a": a.view(np.int64), "b": b.view(np.int64),
                                              "docs": np.full(len(a), 9), "last": np.arange(len(a))}))
    piece = line_dedup.Piece(shard.to_pylist(), 1)
    counts, last = piece.find(a, b)
    assert (counts == 9).all() and np.array_equal(last, np.arange(len(a)))
    assert not piece.find(a, b ^ np.uint64(1))[0].any()


# ---- resampling ------------------------------------------------------------------------------------

@pytest.mark.parametrize("longest, buckets", [(1, 10_000), (3, 97)])
def test_resampling_against_brute_force(spark, longest, buckets):
    rng = random.Random(11)
    vocabulary = ["Red", "blue", "grün", "漢字", "x1", "don't", "END", "é"]
    rows = [(i % 140 if i % 9 else None, "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", ", ", "\n\n"]) for _ in range(rng.randint(0, 60))))
            for i in range(150)] + [(7, None), (8, ""), (9, "...")]
    rows += [(1000 + i, "a line that repeats\n" * 12) for i in range(25)]
    target = [("grün red\nred x1",), (None,), ("a line that",)]
    got = resampling.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(target, "text string"),
                              longest=longest, buckets=buckets)
    want = brute.resample(rows, [t for t, in target], longest, buckets)
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    assert sum(r[4] is not None for r in want) > 5


def test_resampling_edges(spark, edge_dir):
    target = [r.text for r in spark.read.parquet(f"{edge_dir}/benchmark.parquet").collect()]
    got = QUERIES["op13_importance_resampling"](spark, edge_dir).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute.resample(ROWS, target))


def test_repeated_lines_are_taken_apart_once(spark):
    """The rows that are split into words are the distinct lines, whatever their copies."""
    docs = spark.createDataFrame([("one two\nthree\n" * 50,)] * 40, "text string")
    counts = resampling.bucket_counts(docs)
    assert counts.agg(F.sum("n")).first()[0] == 40 * 50 * 3
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Aggregate [text")  # features are made above the fold
