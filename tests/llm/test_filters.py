import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from parvis.llm import decontaminate, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def features_oracle(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        covered |= {i, i + 1, i + 2} if seen[w] > 1 else set()
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_features(docs, plain, empty):
    got = quality.measure(docs, F.col("doc_id")).select("doc_id", *quality.FEATURES, "base_failed").collect()
    want = Counter((d, *f, f[0] < 50 or 100 * f[4] > 50 * f[0]) for d, f in ((d, features_oracle(t)) for d, t in plain))
    assert Counter(map(tuple, got)) == want
    assert quality.measure(empty, F.col("doc_id")).count() == 0


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 50, 0.02), (7, 400, 0.01), (50, 50, 0.3), (2, 5, 0.5)])
def test_binomial_bounds(k, n, p):
    exact = sum(comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
    assert quality.binomial_tail(k, n, p) == pytest.approx(float(exact), rel=1e-9)
    bound = quality.upper_bound(k, n, 0.05)
    if k < n:
        assert quality.binomial_tail(k, n, bound) == pytest.approx(0.05, rel=1e-6)
    # Testing the limit and bounding the rate are one thing.
    assert (quality.binomial_tail(k, n, p) <= 0.05) == (bound <= p or k == n and p >= 1)


def test_fixed_sequence_stops_at_the_first_failure():
    assert quality.strictest_valid([0, 0, 90, 0], 1000, 0.05, 0.01) == 1
    assert quality.strictest_valid([90, 0], 1000, 0.05, 0.01) is None
    assert quality.strictest_valid([0, 0], 0, 0.05, 0.01) is None


def judged_docs(spark):
    """Good prose, and bad texts full of signs, in two languages; few labels in a third."""
    rng = random.Random(2)
    prose = lambda n: " ".join(str(rng.randint(0, 10**6)) for _ in range(n))
    docs, labels = [], []
    for i in range(1500):
        lang = ["en", "fr", "xx"][0 if i < 700 else 1 if i < 1400 else 2]
        bad = i % 10 == 0
        docs.append((i, prose(60).replace(" ", "%%% " if bad else " "), lang, "clash"))
        labels.append((i, int(not bad)))
    labels += [(99999, 1), (None, 1), (5, None)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, n_words string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_reject_bad_and_spare_good(spark):
    docs, labels = judged_docs(spark)
    judged = quality.judge(docs, labels, risk=0.1).select("doc_id", "lang", "kept").collect()
    for lang in ("en", "fr"):
        mine = {r["doc_id"]: r["kept"] for r in judged if r["lang"] == lang}
        assert all(kept == (i % 10 != 0) for i, kept in mine.items())
    # Too few labels prove nothing, so the rules stay unused there.
    assert all(r["kept"] for r in judged if r["lang"] == "xx")
    kept = quality.keep_good(docs, labels, risk=0.1)
    assert kept.dtypes == docs.dtypes
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in judged if r["kept"]}


def test_quality_without_labels(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.dtypes == docs.dtypes
    want = Counter(r["doc_id"] for r in quality.judge(docs, labels).filter("not base_failed").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def tiles_oracle(item, doc, min_match):
    """Covered words of ``item`` by plain greedy string tiling."""
    marked_item, marked_doc, covered = set(), set(), 0
    for size in range(len(item), min_match - 1, -1):
        for a in range(len(item) - size + 1):
            for b in range(len(doc) - size + 1):
                free = not marked_item & set(range(a, a + size)) and not marked_doc & set(range(b, b + size))
                if free and item[a : a + size] == doc[b : b + size]:
                    marked_item |= set(range(a, a + size))
                    marked_doc |= set(range(b, b + size))
                    covered += size
    return covered


@pytest.mark.parametrize("seed", range(8))
def test_tiles(seed):
    rng = random.Random(seed)
    item = np.array([rng.randint(1, 4) for _ in range(24)], np.uint64)
    doc = np.array([rng.randint(0, 4) for _ in range(60)], np.uint64)
    doc[20:32] = item[12:24]
    doc[40:52] = item[0:12]
    for min_match in (3, 5):
        tiles = decontaminate.tile(item, doc, min_match)
        for a, b, n in tiles:
            assert (item[a : a + n] == doc[b : b + n]).all()
        assert len({x for a, _, n in tiles for x in range(a, a + n)}) == sum(n for *_, n in tiles)
        assert sum(n for *_, n in tiles) == tiles_oracle(item.tolist(), [x or -1 for x in doc.tolist()], min_match)


def contaminated_oracle(docs, items, min_match=5, coverage=0.8):
    """(doc_id, item_id) by plain tiling of every pair, documents cut down to the runs that they share."""
    words_of = lambda t: re.findall(r"[^ \t-\r]+", re.sub(r"[!-/:-@\[-`{-~]", "", (t or "").lower()))
    found = set()
    for item_id, item in ((i, words_of(t)) for i, t in items):
        size = min(min_match, len(item))
        runs = {tuple(item[a : a + size]) for a in range(len(item) - size + 1)} if item else set()
        for doc_id, doc in ((d, words_of(t)) for d, t in docs):
            starts = [a for a in range(len(doc) - size + 1) if tuple(doc[a : a + size]) in runs] if runs else []
            places = {p for a in starts for p in range(a, a + size)}
            cut = [doc[p] if p in places else None for p in range(len(doc)) if p in places or p - 1 in places]
            if starts and tiles_oracle(item, cut, size) >= coverage * len(item):
                found.add((doc_id, item_id))
    return found


@pytest.fixture(scope="module")
def benchmark(spark, texts):
    item = " ".join(texts[6].split()[:30])
    rows = [(1, item), (2, None), (3, ""), (4, "!!! ..."), (5, "Zebra quagga okapi"), (6, " ".join(texts[7].split()[:40])), (6, item)]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontamination(spark, docs, texts, benchmark, empty):
    words = texts[6].split()[:30]
    planted = {
        500: "Before. " + " ".join(words).upper() + " after",
        501: " ".join(words[15:] + ["and"] + words[:15]),
        502: " ".join(words[:20]),
        503: "only ZEBRA, quagga okapi!",
        504: " ".join(w for pair in zip(words, ["between"] * 30) for w in pair),
    }
    extra = spark.createDataFrame(list(planted.items()), "doc_id long, text string")
    all_docs = docs.select("doc_id", "text").unionByName(extra)
    for filter_bits in (1 << 24, 64):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(all_docs, benchmark, filter_bits=filter_bits).collect()}
        assert {(500, 1), (501, 1), (503, 5), (6, 1), (7, 6)} <= got
        assert not {502, 504, 8, 9, None, 0, 1} & {d for d, _ in got}
        rows = [(r["doc_id"], r["text"]) for r in all_docs.collect()]
        assert got == contaminated_oracle(rows, [(r["item_id"], r["text"]) for r in benchmark.collect()])
    clean = decontaminate.keep_clean(docs, benchmark)
    gone = {d for d, _ in got}
    assert clean.dtypes == docs.dtypes
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(r["doc_id"] for r in docs.collect() if r["doc_id"] not in gone)
    named = docs.withColumns({c: F.lit("clash") for c in ("digest", "at", "seeds", "item", "last", "slice")})
    assert decontaminate.keep_clean(named, benchmark).dtypes == named.dtypes
    copies = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(" ".join(words)).alias("text"))
    assert Counter(r["item_id"] for r in decontaminate.matches(copies, benchmark).collect()) == {1: 300, 6: 300}
    assert decontaminate.keep_clean(copies, benchmark).count() == 0
    assert decontaminate.matches(empty, benchmark).count() == 0
    assert decontaminate.keep_clean(docs, benchmark.limit(0)).count() == docs.count()


def kernel_oracle(s, t, decay):
    """Sum over all pairs of equal three-letter subsequences."""
    total = 0.0
    spots = lambda x: [(i, j, k) for i in range(len(x)) for j in range(i + 1, len(x)) for k in range(j + 1, len(x))]
    for a in spots(s):
        for b in spots(t):
            if [s[i] for i in a] == [t[i] for i in b]:
                total += decay ** (a[2] - a[0] + 1 + b[2] - b[0] + 1)
    return total


@pytest.mark.parametrize("pair", [("idiot", "idxiot"), ("aaaa", "aaa"), ("moron", "clown"), ("ab", "abc"), ("émile", "emile")])
def test_kernel(pair):
    s, t = pair
    got = float(toxicity.kernel(toxicity.codes([s]), toxicity.codes([t]))[0])
    assert got == pytest.approx(kernel_oracle(s, t, toxicity.DECAY), rel=1e-5, abs=1e-7)


def test_long_words_are_read_whole():
    word = "".join(chr(97 + i % 26) for i in range(77))
    pieces = toxicity.parts(word)
    assert all(len(p) <= toxicity.WIDTH for p in pieces) and pieces[-1].endswith(word[-1])
    half = toxicity.WIDTH // 2
    assert "".join(p[:half] for p in pieces[:-1]) + pieces[-1] == word


def toxic_docs(spark):
    rng = random.Random(4)
    syllables = "the on er an ti re ed th ing ou ble st en es and".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    insults = ["grumblor", "fizzwick", "dunkelpot"]
    docs, labels = [], []
    for i in range(400):
        words = [word() for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randint(0, 59)] = insults[i // 5 % 3] + rng.choice(["", "s", "er", "!"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    unseen = {
        900: "you " + "g.r.u.m.b.l.o.r",
        901: "the on er f i z z w i c k and",
        902: "fizz-wick",
        903: "gruxmblor edth",
        904: "DUNKELPOTTING",
        910: "",
        911: None,
        912: "the and thering",
    }
    rows = [(i, t, "clash") for i, t in [*docs, *unseen.items(), (None, "the on")]]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")


def test_toxicity(spark):
    docs, labels = toxic_docs(spark)
    model = toxicity.fit(docs, labels, F.col("doc_id") < 300)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model, F.col("doc_id")).collect()}
    held_out = [(i % 5 == 0, got[i]["predicted"] == 1) for i in range(300, 400)]
    assert sum(a == b for a, b in held_out) >= 98
    assert all(got[i]["predicted"] == 1 for i in (900, 901, 902, 903, 904))
    assert all(got[i]["predicted"] == 0 and 0 <= got[i]["score"] <= 1 for i in (910, 911, 912, None))
    assert len(got) == 400 + 9
    assert toxicity.score(docs.limit(0), model, F.col("doc_id")).count() == 0


@pytest.mark.parametrize("label", [0, 1])
def test_toxicity_of_one_class(spark, label):
    docs, labels = toxic_docs(spark)
    one = labels.filter("doc_id < 20").withColumn("toxic", F.lit(label))
    scores = {r["predicted"] for r in toxicity.score(docs, toxicity.fit(docs, one), F.col("doc_id")).collect()}
    assert scores == {label}
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(docs, none, F.col("doc_id")).collect()} == {0}
