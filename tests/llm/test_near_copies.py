import random
from collections import Counter

import corpus_pipeline
import pytest
from parvis.llm import near_copies, simhash

from .test_dedup import LOWER, WORD


def shingle_oracle(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def keepers_oracle(plain):
    """Ids of the first documents of all components over links of Jaccard 0.8 and more, by all pairs."""
    rows = sorted(plain, key=lambda r: (r[0] is None, r[0] or 0))
    sets, root = [shingle_oracle(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for j in range(len(rows)):
        for i in range(j):
            if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return Counter(rows[find(i)][0] for i in range(len(rows)) if find(i) == i)


@pytest.fixture(scope="module")
def copies(spark):
    """Copies with scattered changes of 2 to 8 % of their words, a chain of copies, and texts that share a part."""
    rng = random.Random(7)
    prose = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    texts = []
    for i in range(30):
        base = prose(200)
        texts.append(base)
        for _ in range(2):
            copy = list(base)
            for at in rng.sample(range(200), rng.randint(2, 6)):
                copy[at] = "changed"
            texts.append(copy)
    chain = prose(300)
    for i in range(12):
        chain = chain[8:] + prose(8)
        texts.append(chain)
    shared = prose(150)
    texts += [shared + prose(60) for _ in range(12)]
    plain = list(enumerate(" ".join(t) for t in texts)) + [(900, None), (901, ""), (902, "One two"), (903, "one  TWO"), (None, "one two")]
    return plain, spark.createDataFrame(plain, "doc_id long, text string")


def test_stage_drops_copies_at_jaccard_0_8_only(spark, copies):
    plain, docs = copies
    kept = corpus_pipeline.near_deduplication(spark, docs, "")
    assert kept.dtypes == docs.dtypes
    want = keepers_oracle(plain)
    assert Counter(r["doc_id"] for r in kept.collect()) == want
    assert len(want) < len(plain) - 40


def test_bits_of_simhash_alone_do_not_decide(copies):
    plain, _ = copies
    apart = [simhash.fingerprint(plain[0][1].encode()) ^ simhash.fingerprint(plain[i][1].encode()) for i in (1, 2)]
    assert max(x.bit_count() for x in apart) > simhash.LIMIT


def test_messy_texts(docs, plain, empty):
    kept = near_copies.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    assert Counter(r["doc_id"] for r in kept.collect()) == keepers_oracle(plain)
    assert near_copies.keep_one(empty).count() == 0


def test_template_crowds_do_not_pair_up(spark):
    """Documents that share 150 of 180 words have a similarity under 0.8: pairs grow with the crowd, not with its square."""
    rng = random.Random(9)
    prose = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    template, listed = prose(150), []
    for size in (100, 200):
        texts = [" ".join(template + prose(30)) for _ in range(size)]
        texts += [" ".join(t.split()[:-2] + ["new", "end"]) for t in texts[:5]]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = [near_copies.shingles(t.encode()) for t in texts]
        nodes = [near_copies.set_id(f) for f in found]
        signed = [n - 2**64 if n >= 2**63 else n for n in nodes]
        sets = spark.createDataFrame([(n, f.tobytes()) for n, f in zip(signed, found)], "node long, members binary")
        rooted = spark.createDataFrame([(n, len(f), n) for n, f in zip(signed, found)], "node long, size long, root long")
        pairs = {tuple(sorted(r)) for r in near_copies.sharing_a_rare_shingle(rooted, sets).collect()}
        assert {tuple(sorted((signed[i], signed[size + i]))) for i in range(5)} <= pairs
        listed.append(len(pairs))
        assert Counter(r["doc_id"] for r in near_copies.keep_one(docs).collect()) == keepers_oracle(list(enumerate(texts)))
    assert max(listed) < 100


def test_sketches_never_differ_by_more_than_their_sets():
    rng = random.Random(3)
    for n in (0, 1, 5, 200, 3000):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
        for changed in (0, 1, n // 20, n // 3):
            copy = list(words)
            for at in rng.sample(range(n), min(n, changed)):
                copy[at] = "changed"
            x, y = (near_copies.shingles(" ".join(w).encode()) for w in (words, copy))
            bits = sum((int(a) ^ int(b)).bit_count() for a, b in zip(near_copies.parity(x).view("uint64"), near_copies.parity(y).view("uint64")))
            assert bits <= len(set(x.tolist()) ^ set(y.tolist()))


def test_crowd_of_copies_at_every_distance(spark):
    """Copies of one text with 1 to 12 changed words: some are linked by chains, some by none, and few pairs meet in vain."""
    rng = random.Random(11)
    base, texts = [f"w{rng.randint(0, 10**6)}" for _ in range(150)], []
    for i in range(240):
        copy = list(base)
        for at in rng.sample(range(150), 1 + i % 12):
            copy[at] = f"c{rng.randint(0, 10**6)}"
        texts.append(" ".join(copy))
    sets = [near_copies.shingles(t.encode()) for t in texts]
    nodes = [near_copies.set_id(f) for f in sets]
    signed = [n - 2**64 if n >= 2**63 else n for n in nodes]
    held = spark.createDataFrame([(n, f.tobytes()) for n, f in zip(signed, sets)], "node long, members binary")
    rooted = spark.createDataFrame([(n, len(f), n) for n, f in zip(signed, sets)], "node long, size long, root long")
    met = {tuple(sorted(r)) for r in near_copies.sharing_a_rare_shingle(rooted, held).collect()}
    plain = [set(f.tolist()) for f in sets]
    similar = {
        tuple(sorted((signed[i], signed[j])))
        for j in range(len(plain)) for i in range(j)
        if 5 * len(plain[i] & plain[j]) >= 4 * len(plain[i] | plain[j])
    }
    assert similar <= met
    assert len(met) < 1.2 * len(similar)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert Counter(r["doc_id"] for r in near_copies.keep_one(docs).collect()) == keepers_oracle(list(enumerate(texts)))


def test_the_stage_links_by_pivot_tables_first(spark, monkeypatch):
    """Texts within 3 bits are candidates of SimHash; only those similar enough are linked."""
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(900)]
    texts = [" ".join(base), " ".join(base[:-1] + ["end"]), " ".join(reversed(base)), "", "one two"]
    bits = simhash.fingerprint(texts[0].encode()) ^ simhash.fingerprint(texts[1].encode())
    assert bits.bit_count() <= simhash.LIMIT
    asked = []
    plain = near_copies.near_edges
    monkeypatch.setattr(near_copies, "near_edges", lambda classes: asked.append(classes.count()) or plain(classes))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = near_copies.with_bands(docs, docs.doc_id)
    pairs = {tuple(sorted(r)) for r in near_copies.by_fingerprint(made.select("fp", "node")).collect()}
    nodes = {r.doc_id: r.node for r in made.collect()}
    assert tuple(sorted((nodes[0], nodes[1]))) in pairs
    assert Counter(r.doc_id for r in corpus_pipeline.near_deduplication(spark, docs, "").collect()) == Counter([0, 2, 3, 4])
    assert asked


def test_only_doubtful_texts_are_marked(spark):
    keys = spark.range(0, 100_000, 7).toDF("id")
    found = simhash._with_mark(spark.range(100_000).toDF("id"), simhash._marked(keys, ["id"]), ["id"])
    marked = {r.id for r in found.filter("marked").collect()}
    assert set(range(0, 100_000, 7)) <= marked and len(marked) < 14_286 + 200
