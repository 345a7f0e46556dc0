"""Operators without SQL against plain versions of their method; the pipeline's rows stage by stage."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from llm_brute import simhash_components
from marketlake.llm import pii, quality, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").collect()


def _kept_out(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def qda_scores(rows, marks):
    """Scores of (doc_id, text) rows: covariances by numpy, densities by solving, no cached factor."""
    x = {i: np.array(quality.statistics(t or "")) for i, t in rows}
    learn = [(x[m.doc_id], m.quality) for m in marks if m.doc_id in x and not _kept_out(m.doc_id, 5, 0)]
    groups = [np.array([v for v, y in learn if y == k]) for k in (0, 1)]
    own = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(len(g) * c for g, c in zip(groups, own)) / len(learn)
    density = []
    for g, c in zip(groups, own):
        c = (1 - quality.POOLED) * c + quality.POOLED * pooled
        c = (1 - quality.DIAGONAL) * c + quality.DIAGONAL * np.diag(np.diag(c)) + quality.RIDGE * np.eye(len(c))
        centre, share = g.mean(axis=0), np.log(len(g) / len(learn))
        density.append({i: share - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (v - centre) @ np.linalg.solve(c, v - centre)
                        for i, v in x.items()})
    return {i: 1 / (1 + np.exp(min(max(density[0][i] - density[1][i], -700), 700))) for i in x}


def test_quality_is_the_plain_discriminant(spark, docs, labels):
    want = qda_scores([(r.doc_id, r.text) for r in docs], labels)
    got = quality.op7(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6)
        assert r.held_out == _kept_out(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.3)


def bag_score(model, text):
    """Windows of words one by one; a word's n-grams one by one, hashed as the operator documents its buckets."""
    def bucket(gram):
        a = [0 if c == "_" else ord(c) for c in gram]
        h = (a[0] * 0x9E3779B1 + a[1]) % 2 ** 32
        for c in a[2:]:
            h = ((h ^ (h >> 15)) * 0x85EBCA77 + c) % 2 ** 32
        h = h * 0xC2B2AE3D % 2 ** 32
        return (h ^ (h >> 16)) % toxicity.BUCKETS

    values = []
    for word in toxicity.words(text):
        edged = f"_{word}_"
        grams = [edged[i:i + k] for k in range(3, toxicity.GRAMS + 1) for i in range(len(edged) - k + 1)]
        values.append(sum(model.buckets[bucket(g)] for g in grams) / len(grams) if grams else 0.0)
    windows = [values[i:i + toxicity.WINDOW] for i in range(max(1, len(values) - toxicity.WINDOW + 1))]
    worst = max(sum(w) / toxicity.WINDOW for w in windows)
    return 1 / (1 + np.exp(-(model.slope * worst + model.bias)))


def test_toxicity_is_the_plain_bag(spark, docs):
    tables = [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")]
    model = toxicity.fit(*tables)
    got = {r.doc_id: r.score for r in toxicity.score(tables[0], model).collect()}
    assert got == {r.doc_id: r.score for r in toxicity.op4(spark, SF).collect()}    # training is repeatable
    for r in docs:
        assert got[r.doc_id] == pytest.approx(bag_score(model, r.text or ""), abs=1e-9)


def surrogates(entities):
    """{entity: surrogate}: in rounds, the smallest value that asks for a free surrogate gets it."""
    made, out, taken = pii.Surrogates(pii.KEY), {}, set(entities)
    attempt, left = 0, sorted(entities)
    while left:
        asked = {}
        for kind, value in left:
            asked.setdefault((kind, made.value(kind, value, attempt)), (kind, value))
        for new, entity in asked.items():
            if new not in taken:
                out[entity] = new[1]
        taken |= {(k, s) for (k, _), s in out.items()}
        left, attempt = [e for e in left if e not in out], attempt + 1
        assert attempt < pii.SINGLE_ROUNDS
    return out


def replaced(rows):
    """Texts with every entity replaced, right to left."""
    found = [pii.find(t) if t else [] for t in rows]
    names = surrogates({(k, v) for spans in found for _, _, k, v in spans})
    texts = []
    for text, spans in zip(rows, found):
        for a, b, kind, value in sorted(spans, reverse=True):
            text = text[:a] + pii.write(kind, text[a:b], names[kind, value]) + text[b:]
        texts.append(text)
    return texts, found, names


def test_surrogates_are_those_of_the_plain_rounds(spark, docs):
    texts, found, names = replaced([r.text for r in docs])
    got = {r.doc_id: r for r in pii.op2(spark, SF).collect()}
    assert {i: (r.text, r.n_replaced) for i, r in got.items()} == {
        r.doc_id: (t, len(f)) for r, t, f in zip(docs, texts, found)}
    assert len({k for k, _ in names}) > 1
    of_kind = defaultdict(set)
    for (kind, value), new in names.items():
        of_kind[kind].add(new)
        assert (kind, new) not in names
    assert sum(map(len, of_kind.values())) == len(names)


def test_crowded_surrogates_are_those_of_the_plain_rounds(spark):
    entities = [("family_greek", f"ν{i}") for i in range(2_000)]
    want, made = surrogates(set(entities)), pii.Surrogates(pii.KEY)
    attempts = {(r.kind, r.value): r.attempt for r in
                pii.moved(spark.createDataFrame(entities, "kind string, value string")).collect()}
    assert attempts and {e: made.value(*e, attempts.get(e, 0)) for e in entities} == want


def test_pipeline_rows_are_those_of_the_plain_stages(spark, docs, labels):
    """Every stage on all that the plain version of the stage before kept."""
    from tokenizers import Tokenizer
    import public_tokenizers as P

    scores = qda_scores([(r.doc_id, r.text) for r in docs], labels)
    left = [(r.doc_id, r.text) for r in docs if scores[r.doc_id] >= quality.THRESHOLD]
    assert 0 < len(left) < len(docs)
    groups = simhash_components([(i, t or "") for i, t in left])
    one = [(i, t) for i, t in left if groups[i][1] == i]
    assert len(one) < len(left)
    cut = _cut(one)
    assert cut != sorted(one)
    texts, _, names = replaced([t for _, t in cut])
    assert names
    got = corpus_pipeline.run(spark, SF).collect()
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = set()
    for (i, _), text in zip(cut, texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        ends = range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)
        for k, end in enumerate(ends):
            start = 0 if k == 0 else end - 1024
            want.add((i, k, start, end - start, zlib.crc32(ids[start:end].tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    _gapless(got)


def _cut(rows, length=100):
    """Texts without their repeated bytes; what is left of a character that was cut goes too."""
    seen, out = set(), []
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            gone[at:at + length] |= data[at:at + length] in seen
            seen.add(data[at:at + length])
        out.append((i, t if t is None else np.frombuffer(data, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")))
    return out


def _gapless(rows):
    """No sequence overflows, and offsets follow each other; about as few sequences as the tokens allow."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= first_fit_decreasing([r.length for r in rows])


def first_fit_decreasing(sizes):
    room = []
    for s in sorted(sizes, reverse=True):
        at = next((k for k, x in enumerate(room) if x >= s), None)
        if at is None:
            room.append(1024 - s)
        else:
            room[at] -= s
    return len(room)
