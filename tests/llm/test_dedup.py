import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from parvis.llm import components, line_dedup, simhash, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_oracle(plain, min_chars, min_docs):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for d, t in plain:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    rank = lambda d: (d is not None, d or 0)
    owner = {k: max(v, key=rank) for k, v in holders.items() if len(v) >= min_docs}
    rows = []
    for d, t in plain:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in owner or owner[key(x)] == d]
        rows.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return Counter(rows)


@pytest.mark.parametrize("min_docs", [2, 5])
def test_lines(docs, plain, min_docs):
    done = line_dedup.dedup_lines(docs, min_docs=min_docs, n_batches=3)
    got = done.select("row.doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    want = line_oracle(plain, 40, min_docs)
    assert Counter(map(tuple, got)) == want
    assert sum(n for _, _, n, _ in want) > 0


def test_lines_keep_all_columns(docs, empty):
    kept = line_dedup.keep_columns(docs, line_dedup.dedup_lines(docs, n_batches=2))
    assert kept.schema == docs.schema or kept.dtypes == docs.dtypes
    texts = {r["doc_id"]: r for r in kept.collect()}
    assert texts[0]["text"] is None and texts[1]["text"] == ""
    assert line_dedup.dedup_lines(empty, n_batches=2).count() == 0


def test_runs_compact_and_anti_join(spark):
    runs = line_dedup.LineRuns(fanout=2)
    for batch in ([(9, b"a"), (8, b"a"), (8, b"b")], [(7, b"a"), (7, b"c")], [(6, b"c"), (6, b"d")], [(5, b"a")]):
        runs.add(spark.createDataFrame(batch, "doc_id long, key binary"))
    assert runs.compactions == 3 and [len(level) for level in runs.levels] == [0, 0, 1]
    table = {bytes(r["key"]): (r["docs"], r["holder"]) for r in runs.table().collect()}
    assert table == {b"a": (4, 9), b"b": (1, 8), b"c": (2, 7), b"d": (1, 6)}
    fresh = runs.new_lines(spark.createDataFrame([(b"a",), (b"z",)], "key binary"))
    assert [bytes(r["key"]) for r in fresh.collect()] == [b"z"]


def fingerprint_oracle(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def component_oracle(fps):
    """Smallest index reachable over links of at most 3 bits."""
    values, root = np.array(fps, np.uint64), list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def simhash_oracle(plain):
    rows = sorted(plain, key=lambda r: (r[0] is None, r[0] or 0))
    fps = [fingerprint_oracle(t) for _, t in rows]
    return Counter((rows[i][0], f"{fps[i]:016x}", rows[r][0]) for i, r in enumerate(component_oracle(fps)))


@pytest.mark.parametrize("per_slice", [20_000, 2])
def test_simhash(docs, plain, per_slice):
    got = simhash.near_duplicates(docs, chunk=2, per_slice=per_slice)
    assert Counter(map(tuple, got.collect())) == simhash_oracle(plain)


def test_simhash_keeps_one_of_each(docs, plain, empty):
    kept = simhash.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    want = {c for _, _, c in simhash_oracle(plain)}
    got = [r["doc_id"] for r in kept.collect()]
    assert set(got) == want and len(got) == len(want)
    assert simhash.near_duplicates(empty).count() == 0


def test_near_edges_lose_no_link(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = [int(c) for c in centre]
    for c in fps[:12]:
        for _ in range(15):
            x = c
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(b)
            fps.append(x)
    fps = sorted(set(fps))
    classes = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    for chunk in (4096, 8):
        roots = {r["node"]: r["root"] for r in components.components(simhash.near_edges(classes, chunk)).collect()}
        want = component_oracle(fps)
        got = [roots.get(simhash._signed(x), simhash._signed(x)) for x in fps]
        groups = lambda labels: sorted(sorted(i for i, y in enumerate(labels) if y == x) for x in set(labels))
        assert groups(got) == groups(want)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1002), (1002, 1001), (1001, 1001)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000, 1002: 1000}


def substring_oracle(plain, window):
    words = [WORD.findall(t or "") for _, t in plain]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    rows = []
    for (d, _), w in zip(plain, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        rows.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return Counter(rows)


@pytest.mark.parametrize("window", [35, 5])
def test_substrings(docs, plain, window):
    got = Counter(map(tuple, substring_dedup.remove_repeats(docs, window).collect()))
    assert got == substring_oracle(plain, window)


def test_substrings_without_compaction(docs, plain, empty, monkeypatch):
    """A wrong span hash is noticed and every window compared by itself."""
    monkeypatch.setattr(substring_dedup, "span_key", lambda words, n=iter(range(10**9)): (next(n), 0))
    got = Counter(map(tuple, substring_dedup.remove_repeats(docs, 35).collect()))
    assert got == substring_oracle(plain, 35)
    assert substring_dedup.remove_repeats(empty, 35).count() == 0
