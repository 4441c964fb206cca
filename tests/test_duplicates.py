import random
from collections import Counter

import pyarrow as pa
import pytest

from parvis.operators.components import components
from parvis.operators.dedup import exact_log, exact_survivors, key_columns, mark_exact_duplicates
from parvis.operators import edits, near, resolve
from parvis.operators.near import measure, near_pairs, with_characters
from parvis.operators.resolve import passed_over
from parvis.options import Options
from parvis.plans.ingest import dedup_summary, deduplicate
from parvis.session import cut_lineage


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last if x == y else 1 + min(last, row[j], row[j - 1])
    return row[-1]


def similar(a, b):
    if not a or not b:
        return 0.0
    return 1.0 - distance(a, b) / max(len(a), len(b))


def matches(x, y):
    """Match of x before y; prices may be missing."""
    if x["surface_m2"] is None or y["surface_m2"] is None or abs(x["surface_m2"] - y["surface_m2"]) > 5:
        return False
    p, q = x["asking_price"], y["asking_price"]
    if p is not None and q is not None and abs(p - q) / max(p, 1) > 0.06:
        return False
    return similar(x["raw_address"], y["raw_address"]) >= 0.82


def turn_by_turn(rows):
    """(removed, kept) of the sequential rule over rows that share a zip."""
    flagged, log = set(), []
    for i, x in enumerate(rows):
        if i in flagged:
            continue
        for j in range(i + 1, len(rows)):
            y = rows[j]
            if j in flagged or not matches(x, y):
                continue
            p, q = x["asking_price"], y["asking_price"]
            gone, kept = (j, i) if p is not None and q is not None and p <= q else (i, j)
            if gone not in flagged:
                flagged.add(gone)
                log.append((rows[gone]["listing_id"], rows[kept]["listing_id"]))
    return log


def random_market(rng, zipcode, size, missing=0.1):
    """Listings whose addresses differ by a few letters; no two share an exact key."""
    rows = []
    for k in range(size):
        street = list("boulevard voltaire")
        for _ in range(rng.randint(0, 4)):
            street[rng.randrange(len(street))] = rng.choice("abcde")
        address = "" if rng.random() < missing / 2 else f"{k % 10}{k // 10 % 10} " + "".join(street)
        rows.append(
            {
                "raw_address": address,
                "code_postal": zipcode,
                "surface_m2": None if rng.random() < missing / 2 else 40.0 + rng.randint(0, 24) / 2 + k / 1000,
                "asking_price": None if rng.random() < missing else rng.choice([-5, 0, 1, 2]) if rng.random() < 0.1
                else rng.randint(300, 340) * 1000,
            }
        )
    return rows


@pytest.fixture(scope="module")
def markets():
    rng = random.Random(11)
    rows = []
    for z in range(50):
        rows += random_market(rng, 75000 + z, rng.randint(2, 16))
    rows += random_market(rng, 76000, 60, missing=0.0)
    rng.shuffle(rows)
    return [{"row_idx": 3 * i + 1, "listing_id": f"L{i}", **r} for i, r in enumerate(rows)]


def expected(rows):
    log = []
    for z in {r["code_postal"] for r in rows}:
        log += turn_by_turn([r for r in rows if r["code_postal"] == z])
    return sorted(log)


@pytest.mark.parametrize(
    "options",
    [
        Options(),
        Options(replay_pairs=30),
        Options(replay_pairs=2, first_round_rows=20),
        Options(hot_cell_rows=3, first_round_rows=100),
    ],
)
def test_same_as_turn_by_turn(make_listings, markets, options):
    listings = make_listings(markets)
    clean, log = deduplicate(listings, options)
    got = log.collect()
    assert all(r.reason.startswith("fuzzy_match (sim=") for r in got)
    want = expected(markets)
    assert sorted((r.removed_id, r.kept_id) for r in got) == want
    assert len(want) > 100
    removed = {w[0] for w in want}
    assert {r.listing_id for r in clean.collect()} == {m["listing_id"] for m in markets} - removed


def test_pairs_equal_brute_force(make_listings, markets):
    rows = cut_lineage(key_columns(make_listings(markets)))
    want = Counter()
    by_zip = {}
    for m in markets:
        by_zip.setdefault(m["code_postal"], []).append(m)
    for group in by_zip.values():
        want.update((x["row_idx"], y["row_idx"]) for a, x in enumerate(group) for y in group[a + 1:] if matches(x, y))
    for o in (Options(), Options(hot_cell_rows=0), Options(hot_cell_rows=4, broadcast_rows=0)):
        assert Counter((r.i, r.j) for r in near_pairs(rows, rows, o).collect()) == want


def test_short_addresses_in_hot_cells(make_listings):
    texts = ["a", "a", "b", "abcde", "abcdef", "abcdeg", "bcdef", "aaaaaa", "aaaaaaa", "aaaaa", "ab", "abc"]
    rows = [
        {"row_idx": i, "raw_address": t, "code_postal": 1, "surface_m2": 10.0, "asking_price": 100}
        for i, t in enumerate(texts)
    ]
    keyed = cut_lineage(key_columns(make_listings(rows)))
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if similar(texts[i], texts[j]) >= 0.82}
    got = near_pairs(keyed, keyed, Options(hot_cell_rows=0)).collect()
    assert sorted((r.i, r.j) for r in got) == sorted(want)


def test_removed_listing_still_removes(make_listings):
    base = {"code_postal": 75001, "surface_m2": 50.0}
    listings = make_listings(
        [
            {**base, "raw_address": "10 rue de rivoli a", "asking_price": 300000},
            {**base, "raw_address": "10 rue de rivoli b", "asking_price": 295000},
            {**base, "raw_address": "10 rue de rivoli c", "asking_price": 310000},
        ]
    )
    log = deduplicate(listings)[1].collect()
    assert sorted((r.removed_id, r.kept_id) for r in log) == [("L0", "L1"), ("L2", "L0")]
    assert {r.removed_id: (r.price_removed, r.price_kept) for r in log} == {
        "L0": (300000, 295000),
        "L2": (310000, 300000),
    }
    assert {r.reason for r in log} == {"fuzzy_match (sim=0.944)"}


def test_price_test_is_relative_to_the_earlier_listing(make_listings):
    base = {"surface_m2": 50.0}
    listings = make_listings(
        [
            {**base, "code_postal": 1, "raw_address": "10 rue de rivoli a", "asking_price": 100000},
            {**base, "code_postal": 1, "raw_address": "10 rue de rivoli b", "asking_price": 106001},
            {**base, "code_postal": 2, "raw_address": "10 rue de rivoli a", "asking_price": 106001},
            {**base, "code_postal": 2, "raw_address": "10 rue de rivoli b", "asking_price": 100000},
        ]
    )
    assert [r.removed_id for r in deduplicate(listings)[1].collect()] == ["L2"]


def test_exact_duplicates(make_listings):
    rows = [
        {"raw_address": "1 Bd X", "surface_m2": 10.0, "code_postal": 1, "asking_price": 300},
        {"raw_address": "1, boulevard x", "surface_m2": 10.0, "code_postal": 1, "asking_price": 100},
        {"raw_address": "1 bd  x.", "surface_m2": 10.0, "code_postal": 1, "asking_price": 100},
        {"raw_address": "1 bd x", "surface_m2": 10.0, "code_postal": 1, "asking_price": None},
        {"raw_address": "1 bd x", "surface_m2": 11.0, "code_postal": 1, "asking_price": 1},
        {"raw_address": "", "surface_m2": 10.0, "code_postal": 1, "asking_price": 5},
        {"raw_address": None, "surface_m2": 10.0, "code_postal": 1, "asking_price": 6},
        {"raw_address": "2 av y", "surface_m2": None, "code_postal": None, "asking_price": 9},
        {"raw_address": "2 avenue y", "surface_m2": None, "code_postal": None, "asking_price": 8},
    ]
    marked = mark_exact_duplicates(key_columns(make_listings(rows)))
    log = {(r.removed_id, r.kept_id, r.price_removed, r.price_kept) for r in exact_log(marked).collect()}
    assert log == {("L0", "L1", 300, 100), ("L2", "L1", 100, 100), ("L3", "L1", None, 100), ("L7", "L8", 9, 8)}
    assert {r.listing_id for r in exact_survivors(marked).collect()} == {"L1", "L4", "L5", "L6", "L8"}


def test_one_key_holds_a_third(make_listings):
    rows = [
        {"raw_address": "1 bd x" if i % 3 == 0 else f"{i} rue de la ville numero {i * 7919}", "surface_m2": 10.0,
         "code_postal": 1, "asking_price": 1000 + i}
        for i in range(900)
    ]
    clean, log = deduplicate(make_listings(rows))
    exact = [r for r in log.collect() if r.reason == "exact_key_match"]
    assert len(exact) == 299 and {r.kept_id for r in exact} == {"L0"}


def test_near_copies_hold_a_third(make_listings):
    """A crowd of mutual matches: the rounds leave what the turns leave."""
    rng = random.Random(5)
    rows = [
        {"raw_address": f"residence du grand parc batiment nord {k:04d}", "surface_m2": 30.0 + k / 1e4, "code_postal": 7,
         "asking_price": 200000 + rng.randint(0, 4000)}
        for k in range(240)
    ]
    options = Options(hot_cell_rows=20, first_round_rows=16)
    listings = make_listings(rows)
    keyed = key_columns(listings)
    load = measure(keyed, keyed, options)
    assert load.n_hot > 0 and load.n_lonely > 0
    named = [{"listing_id": f"L{i}", **r} for i, r in enumerate(rows)]
    got = deduplicate(listings, options)[1].collect()
    assert sorted((r.removed_id, r.kept_id) for r in got) == sorted(turn_by_turn(named))


def test_no_duplicates(make_listings):
    listings = make_listings([{"raw_address": "1 rue a", "code_postal": 1, "surface_m2": 9.0, "asking_price": 1}])
    clean, log = deduplicate(listings)
    assert clean.count() == 1 and log.count() == 0
    assert log.columns == ["removed_id", "kept_id", "reason", "price_removed", "price_kept"]
    assert dedup_summary(listings, log).first().asDict() == {
        "raw": 1, "clean": 1, "removed": 0, "removed_exact": 0, "removed_fuzzy": 0,
    }


def test_empty_input(make_listings):
    clean, log = deduplicate(make_listings([]))
    assert clean.count() == 0 and log.count() == 0


def test_a_chain_of_a_thousand_links(spark):
    chain = [(i, i + 1) for i in range(1000)] + [(2000, 2002), (2001, 2002), (2002, 2003), (2003, 2004), (2002, 2004)]
    got = sorted(r.j for r in passed_over(spark.createDataFrame(chain, "i long, j long")).collect())
    assert got == [*range(1, 1001, 2), 2002, 2004]


def test_turns_of_random_graphs(spark):
    rng = random.Random(8)
    edges = sorted({tuple(sorted(rng.sample(range(200), 2))) for _ in range(260)})
    lost = set()
    for i, j in edges:
        if i not in lost:
            lost.add(j)
    assert sorted(r.j for r in passed_over(spark.createDataFrame(edges, "i long, j long")).collect()) == sorted(lost)


def jobs_of(spark, work):
    """Result of ``work`` and the number of Spark jobs it ran."""
    group = f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    result = work()
    count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    return result, count


def test_jobs_do_not_follow_the_length_of_chains(spark, make_listings):
    """Every listing is dominated by the two before it: nothing but the turns tells who goes."""
    counted = []
    for size in (12, 120):
        rows = [
            {"raw_address": f"{i} rue de la longue chaine aux maillons", "code_postal": 3, "surface_m2": 20.0 + 2.5 * i, "asking_price": 100000 + i}
            for i in range(size)
        ]
        # Three-digit numbers differ too much, so every address is the same length.
        rows = [{**r, "raw_address": "rue de la longue chaine aux maillons " + "abc"[i % 3]} for i, r in enumerate(rows)]
        listings = make_listings(rows)
        log, jobs = jobs_of(spark, lambda: deduplicate(listings)[1].collect())
        named = [{"listing_id": f"L{i}", **r} for i, r in enumerate(rows)]
        assert sorted((r.removed_id, r.kept_id) for r in log) == sorted(turn_by_turn(named))
        counted.append(jobs)
    assert counted[0] == counted[1]


@pytest.mark.parametrize("price", ["falling", "unpriced", "rising", "mixed"])
def test_crowds_of_copies(make_listings, price):
    """Copies of one address; most are matches of each other and none is cheap to list in pairs."""
    rng = random.Random(2)
    asked = {"falling": lambda k: 900000 - k, "unpriced": lambda k: None, "rising": lambda k: 500000 + k, "mixed": lambda k: rng.choice([None, rng.randint(480000, 520000)])}
    rows = [
        {"raw_address": "12 residence du grand parc", "surface_m2": 30.0 + k / 1e4, "code_postal": 7 + k % 2, "asking_price": asked[price](k)}
        for k in range(100)
    ]
    named = [{"listing_id": f"L{i}", **r} for i, r in enumerate(rows)]
    want = [w for z in (7, 8) for w in turn_by_turn([r for r in named if r["code_postal"] == z])]
    for options in (Options(), Options(hot_cell_rows=20, first_round_rows=16)):
        got = deduplicate(make_listings(rows), options)[1].collect()
        assert sorted((r.removed_id, r.kept_id) for r in got) == sorted(want)


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(64)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "i long, j long")).collect()
    assert {r.node: r.root for r in got} == root and len(got) == len(root)


def test_characters_never_differ_by_more_than_the_edits(spark):
    rng = random.Random(6)
    letters = "abcdefgz 0123456789#é北😀"
    rows = []
    for n in range(150):
        text = [rng.choice(letters) for _ in range(rng.randint(1, 30))]
        copy = list(text)
        for _ in range(rng.randint(0, 4)):
            at, kind = rng.randrange(len(copy) + 1), rng.randrange(3)
            copy[at : at + (kind > 0)] = [rng.choice(letters)] * (kind < 2)
        rows += [(2 * n, "".join(text)), (2 * n + 1, "".join(copy))]
    held = {r.row_idx: r for r in with_characters(spark.createDataFrame(rows, "row_idx long, address_norm string")).collect()}
    edits = spark.createDataFrame([(n, rows[2 * n][1], rows[2 * n + 1][1]) for n in range(150)], "n int, a string, b string")
    for r in edits.selectExpr("n", "levenshtein(a, b) as d").collect():
        a, b = held[2 * r.n].characters, held[2 * r.n + 1].characters
        for x, y in ((a, b), (b, a)):
            assert sum(((p & ~q) & (2**64 - 1)).bit_count() for p, q in zip(x, y)) <= r.d


def test_busy_zips_are_resolved_in_rounds_before_their_matches_are_listed(spark, make_listings, monkeypatch):
    """4 * 60 copies that all match: 1,770 pairs a zip, above what the option lets a task replay."""
    rows = [
        {"raw_address": f"{10 + k // 4} rue du long chemin vert", "code_postal": k % 4, "surface_m2": 30.0, "asking_price": 500000 + k}
        for k in range(240)
    ]
    listed = []
    plain = resolve.replay_units
    monkeypatch.setattr(resolve, "replay_units", lambda pairs, o: listed.append(pairs.count()) or plain(pairs, o))
    named = [{"listing_id": f"L{i}", **r} for i, r in enumerate(rows)]
    want = [w for z in range(4) for w in turn_by_turn([r for r in named if r["code_postal"] == z])]
    got = deduplicate(make_listings(rows), Options(replay_pairs=20, first_round_rows=16))[1].collect()
    assert sorted((r.removed_id, r.kept_id) for r in got) == sorted(want)
    assert sum(listed) < 1770


def test_blocks_are_sifted_by_trigrams_only_where_that_spares_comparisons(spark, make_listings, monkeypatch):
    """Addresses of one pattern share their rare trigrams, those of random letters do not (F14, F20)."""
    rng = random.Random(9)
    alike = [f"{10 + k} rue du long chemin vert" for k in range(60)]
    apart = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(24)) for _ in range(40)]
    apart += [a[:-1] + "é" for a in apart]
    sifted = []
    plain = near._matches
    monkeypatch.setattr(near, "_matches", lambda sides, keys, *a: sifted.append("gram" in keys) or plain(sides, keys, *a))
    for addresses, cost, wanted in ((alike, 1000, False), (apart, 1000, False), (apart, 0, True)):
        rows = [{"raw_address": a, "surface_m2": 30.0, "code_postal": 7, "asking_price": 1000 + k} for k, a in enumerate(addresses)]
        keyed = key_columns(make_listings(rows))
        want = Counter((r.i, r.j) for r in near_pairs(keyed, keyed, Options()).collect())
        sifted.clear()
        got = near_pairs(keyed, keyed, Options(hot_cell_rows=4, trigram_row_cost=cost)).collect()
        assert Counter((r.i, r.j) for r in got) == want and len(want) >= 40
        assert any(sifted) == wanted


def test_slices_of_large_blocks_lose_and_repeat_no_match(make_listings, monkeypatch):
    rng = random.Random(3)
    rows = [
        {"raw_address": f"{rng.randint(1, 9)} rue du {rng.choice(['long', 'petit', 'vieux'])} chemin", "surface_m2": 30.0 + k % 7,
         "code_postal": 7, "asking_price": rng.choice([None, 1000 + 10 * (k % 9)])}
        for k in range(120)
    ]
    keyed = key_columns(make_listings(rows))
    want = Counter((r.i, r.j) for r in near_pairs(keyed, keyed, Options()).collect())
    monkeypatch.setattr(near, "SLICE_ROWS", 5)
    assert Counter((r.i, r.j) for r in near_pairs(keyed, keyed, Options(hot_cell_rows=4)).collect()) == want


def test_the_smaller_side_may_take_all_copies(spark, make_listings):
    """The same matches, with fewer rows of the second side to shuffle (F2, F20)."""
    rng = random.Random(12)
    rows = [
        {"raw_address": f"{rng.randint(1, 9)} rue du long chemin", "surface_m2": rng.choice([None, 30.0 + 2 * (k % 9)]),
         "code_postal": 7, "asking_price": rng.choice([None, -3, 0, 1, 1000 + 20 * (k % 9)])}
        for k in range(90)
    ]
    keyed = key_columns(make_listings(rows))
    few = keyed.filter("row_idx % 5 = 0")
    assert near._cells(keyed, Options(), False, True).count() < near._cells(keyed, Options(), False).count()
    want = Counter((r.i, r.j) for r in near_pairs(few, keyed).collect())
    assert len(want) > 50
    for options in (Options(), Options(hot_cell_rows=3)):
        assert Counter((r.i, r.j) for r in near_pairs(few, keyed, options, few_first=True).collect()) == want


def test_first_round_takes_as_many_rows_as_its_comparisons_allow(spark, make_listings):
    """Sparse blocks need few rounds; a crowd at the head of the input is met in small ones (F2, F20)."""
    options = Options(first_round_rows=16)
    sparse = [{"raw_address": "1 rue a", "surface_m2": 30.0, "code_postal": k % 200, "asking_price": 1000} for k in range(600)]
    crowd = [{**r, "code_postal": 7 if k < 300 else k} for k, r in enumerate(sparse)]
    first = {}
    for name, rows in (("sparse", sparse), ("crowd", crowd)):
        keyed = key_columns(make_listings(rows))
        comparisons = measure(keyed, keyed, options).comparisons
        ends = resolve._round_ends(keyed, options, comparisons)
        first[name] = ends[0] if ends else 600
    assert first["sparse"] > 300 and first["crowd"] < 100


def test_few_comparisons_do_not_put_all_rows_into_one_task(spark, make_listings):
    """Many rows that hardly meet: the adaptive plan deals them (F2, F20)."""
    rows = [{"raw_address": "1 rue a", "surface_m2": 30.0, "code_postal": k, "asking_price": 1000} for k in range(50)]
    keyed = key_columns(make_listings(rows))
    plan = near_pairs(keyed, keyed)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan


def test_lists_of_addresses_find_every_match(make_listings, markets, monkeypatch):
    """Blocks of any size compared by whole lists, tries read from either end and pairs that move alone (F1)."""
    rows = cut_lineage(key_columns(make_listings(markets)))
    plain = {(r.i, r.j): r for r in near_pairs(rows, rows).collect()}
    want = Counter(plain.keys())
    for look in (-1e9, 1e9):
        monkeypatch.setattr(edits, "LOOK", look)
        monkeypatch.setattr(edits, "FOUND", 7)
        monkeypatch.setattr(edits, "TEXTS", 5)
        monkeypatch.setattr(near, "DENSE_SLICE_ROWS", 9)
        got = near_pairs(rows, rows, Options(dense_cell_rows=0)).collect()
        assert Counter((r.i, r.j) for r in got) == want and all(r == plain[r.i, r.j] for r in got)
        narrow = near_pairs(rows, rows, Options(dense_cell_rows=0), narrow=True)
        assert narrow.columns == ["i", "j", "similarity"]
        assert sorted(narrow.collect()) == sorted((r.i, r.j, r.similarity) for r in got)


@pytest.mark.parametrize("look", [-1e9, 1e9])
def test_distances_of_lists_are_exact(look, monkeypatch):
    """Addresses of one to three words, of odd characters, equal ones and ends that hold no character (F1)."""
    monkeypatch.setattr(edits, "LOOK", look)
    monkeypatch.setattr(edits, "STATE_WORDS", 4096)
    monkeypatch.setattr(edits, "HELD_CHARACTERS", 2)
    rng = random.Random(21)
    texts = ["".join(rng.choice("ab é北😀\0") for _ in range(n)) for n in (1, 2, 5, 30, 63, 64, 65, 127, 128, 129, 140, 192)]
    for t in [*texts]:
        for _ in range(4):
            copy = list(t)
            for _ in range(rng.randint(0, 1 + len(t) // 6)):
                copy[rng.randrange(len(copy))] = rng.choice("abé😀")
            texts.append("".join(copy))
    rng.shuffle(texts)
    n = len(texts)
    side = edits.Side(pa.table({"row_idx": range(n), "address_norm": texts, "asking_price": pa.array([None] * n, pa.int64()), "surface_m2": [1.0] * n}))
    got = [(i, j, s) for found in edits.block_matches(side, side, edits.Rules(0.82, 0.06, 5.0)) for i, j, s in zip(*(f.tolist() for f in found))]
    got = sorted((int(side.number[i]), int(side.number[j]), s) for i, j, s in got)
    want = [(i, j, similar(texts[i], texts[j])) for i in range(n) for j in range(i + 1, n) if similar(texts[i], texts[j]) >= 0.82]
    assert got == want and len(want) > 60


def test_rows_of_dense_blocks_may_repeat_or_lack_values(make_listings):
    """Numbers that repeat or are null, null prices, surfaces without a value (F1)."""
    rng = random.Random(4)
    rows = [
        {"row_idx": rng.choice([None, 1, 2, 3, k]), "raw_address": rng.choice(["1 rue du chemin vert", "2 rue du chemin vert", "av foch", None]),
         "surface_m2": rng.choice([None, float("nan"), 30.0, 33.5, 36.0]), "code_postal": rng.choice([None, 7]),
         "asking_price": rng.choice([None, -2, 0, 1, 1000, 1050, 1100])}
        for k in range(320)
    ]
    keyed = cut_lineage(key_columns(make_listings(rows)))
    want = Counter(tuple(r) for r in near_pairs(keyed, keyed, Options(dense_cell_rows=1000)).collect())
    assert Counter(tuple(r) for r in near_pairs(keyed, keyed, Options(dense_cell_rows=0)).collect()) == want
    assert sum(want.values()) > 100


def test_large_blocks_are_not_compared_pair_by_pair(make_listings):
    """A block of a street: the join's plan must not hold its pairs, which cost it a microsecond each (F1)."""
    rows = [{"raw_address": f"{k} rue du long chemin vert", "surface_m2": 30.0, "code_postal": 7, "asking_price": 1000} for k in range(600)]
    keyed = cut_lineage(key_columns(make_listings(rows)))
    assert measure(keyed, keyed).n_dense > 0
    found = near_pairs(keyed, keyed, narrow=True)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 3
    assert found.count() == 600 * 599 // 2


def test_blocks_of_very_long_addresses_are_left_to_the_join(make_listings):
    rows = [{"raw_address": f"{k} " + "rue " * (300 if k == 3 else 3), "surface_m2": 30.0, "code_postal": 7, "asking_price": 1000} for k in range(9)]
    keyed = cut_lineage(key_columns(make_listings(rows)))
    o = Options(dense_cell_rows=0)
    assert measure(keyed, keyed, o).n_dense == 0
    assert near_pairs(keyed, keyed, o).count() == 28


def test_dense_blocks_may_still_be_sifted_by_trigrams(make_listings, monkeypatch):
    """Where whole lists would take longer than a join by rare trigrams; each pair is found once (F1)."""
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(24)) for _ in range(40)]
    texts += [a[:-1] + "é" for a in texts]
    rows = [{"raw_address": a, "surface_m2": 30.0, "code_postal": 7 + k % 2 * (k < 20), "asking_price": 1000 + k} for k, a in enumerate(texts)]
    keyed = cut_lineage(key_columns(make_listings(rows)))
    want = Counter((r.i, r.j) for r in near_pairs(keyed, keyed).collect())
    in_lists, real = [], near._dense_matches
    monkeypatch.setattr(near, "_dense_matches", lambda rows, dense, n, *a: in_lists.append(n) or real(rows, dense, n, *a))
    for gain in (1.0, 1e9):
        monkeypatch.setattr(near, "DENSE_GAIN", gain)
        got = near_pairs(keyed, keyed, Options(hot_cell_rows=4, dense_cell_rows=3, trigram_row_cost=0))
        assert Counter((r.i, r.j) for r in got.collect()) == want and len(want) >= 30
    assert in_lists[0] < in_lists[1]
