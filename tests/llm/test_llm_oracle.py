"""Queries against DuckDB or the brute force on the smallest driver scale; held-out accuracy."""

import hashlib
import zlib

import duckdb
import llm_brute as brute
import numpy as np
import pytest

from marketlake.llm import bpe, packing, quality, simhash, suffix_dedup, toxicity
from marketlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.1"


def _canon(names, rows):
    """Rows as values by column name: a null is a null, a whole number is one, whatever frame would hold them."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF), con.execute(ORACLE[name])
    assert sorted(got.columns) == sorted(d[0] for d in want.description)
    assert _canon(got.columns, got.collect()) == _canon([d[0] for d in want.description], want.fetchall())


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_round_trip(spark, rows):
    import public_tokenizers as P
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load().ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op1_bpe_round_trip"](spark, SF).collect()}
    for i, t in rows:
        ids = np.array(library.encode_ordinary(t), "<u4")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_components(spark, rows):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash"](spark, SF).collect()}
    assert got == brute.simhash_components(rows)


def test_pieces_of_a_large_block_are_linked(spark, monkeypatch):
    """A block cut into pieces links the same fingerprints as the plain rule."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = np.unique(np.concatenate([base[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (6, 40)).astype(np.uint64))]).ravel())
    monkeypatch.setattr(simhash, "BLOCK", 16)
    from marketlake.llm.common import components

    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r.node: r.root for r in components(simhash.links(frame)).collect()}
    root = {int(x): int(x) for x in fps.view(np.int64)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps[np.bitwise_count(fps ^ a) <= 2]:
            x, y = find(int(a.view(np.int64))), find(int(b.view(np.int64)))
            root[max(x, y)] = min(x, y)
    assert {x: got.get(x, x) for x in root} == {x: find(x) for x in root}


def test_removed_bytes(spark, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op6_suffix_dedup"](spark, SF).collect()}
    assert got == brute.removed(rows)


def test_small_alphabet_slices_and_buckets(spark, monkeypatch):
    """Runs, periods and shifted copies, over several batches and buckets."""
    rng = np.random.default_rng(2)
    base = "".join(rng.choice(list("ab"), 700))
    texts = [base, base[50:400], "b" * 350, "ab" * 200, base[::-1], "x" + base[100:230] + "y" * 120 + base[300:520],
             "b" * 101, "b" * 99, (base[:37] + "é") * 12]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = suffix_dedup.remove_repeats(frame).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out}
    assert got == brute.removed(list(enumerate(texts)))


def test_deep_shallow_order():
    rng = np.random.default_rng(3)
    short = rng.integers(97, 99, (4_000, 100)).astype(np.uint8)
    short[1_000:3_000, :80] = short[0, :80]     # a deep group for the tries
    short[2_000:2_500] = short[1_500]           # and ties
    order = suffix_dedup.deep_shallow(short)
    assert sorted(order.tolist()) == list(range(4_000))
    strings = [short[i].tobytes() for i in order]
    assert strings == sorted(strings)
    lcp = suffix_dedup.common_prefixes(short, order)
    for i in range(1, 4_000, 37):
        a, b = strings[i - 1], strings[i]
        assert lcp[i] == next((k for k in range(100) if a[k] != b[k]), 100)


def test_long_text_slices(monkeypatch):
    """Anchors do not depend on where a long text is cut."""
    rng = np.random.default_rng(5)
    text = rng.integers(97, 123, 30_000).astype(np.uint8).tobytes()
    whole = suffix_dedup.anchors([text])
    monkeypatch.setattr(suffix_dedup, "SLICE", 4_096)
    cut = suffix_dedup.anchors([text])
    covers = lambda a: {(p - b + k) for p, b, m in zip(a["place"], a["back"], a["more"]) for k in range(m + 1)}
    assert covers(whole) == covers(cut) == set(range(30_000 - 99))


def test_packing_is_tight_and_exact(spark, rows):
    from tokenizers import Tokenizer
    import public_tokenizers as P

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = packing.pack(docs, with_ids=True)
    got = packed.collect()
    parts = {(r.doc_id, r.piece): r for r in got}
    for i, t in rows:
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4")
        at, k = 0, 0
        while at < len(ids):
            r = parts.pop((i, k))
            chunk = ids[at: at + r.length]
            assert r.start == at and r.ids == chunk.tobytes() and r.ids_crc32 == zlib.crc32(chunk.tobytes())
            assert r.length == 1024 or (k == 0 and r.length == (len(ids) - 1) % 1024 + 1)
            at, k = at + r.length, k + 1
    assert not parts
    total = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) <= -(-total // 1024) * 1.01 + 1
    rebuilt = packing.sequences(packed).collect()
    assert sum(sum(map(len, r.ids)) for r in rebuilt) == 4 * total


def test_genetic_operators_keep_every_piece():
    rng = np.random.default_rng(7)
    sizes = rng.integers(1, 1024, 600)
    first = packing.evolve(sizes, [], rng)
    later = packing.evolve(sizes, list(first), rng)
    for p in first + later:
        assert (packing.fills(sizes, p) <= 1024).all() and (p >= 0).all() and len(p) == len(sizes)
        assert len(np.unique(p)) == p.max() + 1
    assert packing.fitness(sizes, later[0]) >= packing.fitness(sizes, first[0]) - 1e-12


def _labelled(spark, column):
    docs = spark.read.parquet(f"{MORE}/documents.parquet").join(spark.read.parquet(f"{MORE}/labels.parquet"), "doc_id")
    return {r[0]: r[1] for r in docs.select("doc_id", column).collect()}


def test_quality_on_held_out_rows(spark):
    truth = _labelled(spark, "quality")
    got = [(r.predicted, truth[r.doc_id]) for r in quality.op7(spark, MORE).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in got]) > 0.98


def test_toxicity_on_held_out_rows(spark):
    truth = _labelled(spark, "toxic")
    got = [(r.predicted, truth[r.doc_id], r.score) for r in toxicity.op4(spark, MORE).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b, _ in got]) > 0.95
    ranked = sorted(got, key=lambda x: x[2])
    places = [k for k, x in enumerate(ranked) if x[1]]
    n1 = len(places)
    assert (sum(places) - n1 * (n1 - 1) / 2) / (n1 * (len(got) - n1)) > 0.93


def test_misspellings_share_vectors(spark):
    rng = np.random.default_rng(11)
    plain = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    texts, y = [], []
    for i in range(400):
        bag = list(rng.choice(plain, 30))
        if i % 4 == 0:
            bag.insert(int(rng.integers(0, 30)), "wretchlike")
        texts.append(" ".join(bag))
        y.append(int(i % 4 == 0))
    model = toxicity.train(texts, np.array(y))
    seen, unseen, clean = model.score(["abcdef wretchlike hgfedc", "abcdef wretchlikke hgfedc", "abcdef fedcba hgfedc"])
    assert seen > 0.7 and unseen > 0.5 > clean
