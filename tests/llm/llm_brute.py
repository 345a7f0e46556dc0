"""Plain Python versions of the contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    import xxhash

    low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows):
    """rows: (doc_id, text) with distinct ids -> {doc_id: (hex, smallest id)}."""
    ids = sorted(i for i, _ in rows)
    fp = {i: fingerprint(t) for i, t in rows}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (fp[a] ^ fp[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (f"{fp[i]:016x}", find(i)) for i in ids}


def removed(rows, length=100):
    """rows: (doc_id, text) with distinct ids, null ids last -> {doc_id: (bytes, removed, runs, sha)}."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        mark = np.zeros(len(data) + 1, np.int64)
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            if s in seen:
                mark[i] += 1
                mark[i + length] -= 1
            seen.add(s)
        gone = np.cumsum(mark)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out[doc_id] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def top_k(rows, k=5, every=50, scale=256):
    """rows: (vec_id, vector) -> [(query, rank, vec_id, score)]."""
    import math

    fine = {i: [math.floor(scale * float(x)) for x in v] for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in sorted(i for i in fine if i % every == 0):
        found = sorted(((-sum(a * b for a, b in zip(fine[q], w)), i) for i, w in fine.items() if i != q))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return out


def secrets(text):
    """Base spans by plain scanning: (start, order, end)."""
    text = text or ""
    out = []
    for m in re.finditer(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.A):
        if len(m.group(2)) >= 8:
            out.append((m.start(), 0, m.end()))
    for order, (pattern, least) in enumerate([(r"AKIA[A-Z0-9]+", 16), (r"[0-9a-f]+", 32)], 1):
        out += [(m.start(), order, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return sorted(out)


def host_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def tokens(text):
    return re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text or "")


def fill_in_middle(doc_id, text, rate=50, spm=80, seed=42):
    """n, form, prefix_chars, middle_chars, output."""
    text, units = text or "", tokens(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def line_dedup(rows, min_chars=40, min_docs=5):
    """[(doc_id, text)] -> [(doc_id, n_lines, n_dropped, kept)] in the same order."""
    def key(line):
        return ascii_lower(line.strip(" \t\n\v\f\r"))

    low, held = -(1 << 63), {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(low if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stays = [x for x in lines if len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == (low if i is None else i)]
        out.append((i, len(lines), len(lines) - len(stays), "\n".join(stays)))
    return out


def resample(rows, target, longest=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    """[(doc_id, n_features, weight, score, rank)] in the order of rows."""
    import math
    import zlib
    from collections import Counter

    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
        runs = [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
        return len(w), [zlib.crc32(r.encode()) % buckets for r in runs]

    measured = [features(t) for _, t in rows]
    s, t = Counter(b for _, f in measured for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * big_s / ((s[b] + 1.0) * big_t))) for b in s}
    out = []
    for (i, _), (n_words, f) in zip(rows, measured):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0))), None, n_words])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], -(1 << 63) if r[0] is None else r[0], r[2], r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]
