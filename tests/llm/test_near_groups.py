"""Near-duplicate groups against brute force over texts around the threshold, and long chains."""

import random
from itertools import combinations

from bondscope.llm import near_dedup


def brute(rows):
    sets, label = {}, {}
    for i, text in rows:
        w = near_dedup.words(text)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        label[i] = i
    links = [(a, b) for a, b in combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in sets:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
        if not moved:
            break
    return {i: (len(sets[i]), label[i]) for i in sets}


def changed(rng, base, places):
    out = list(base)
    for at in rng.sample(range(len(out)), places):
        out[at] = f"new{rng.randrange(10**9)}"
    return " ".join(out)


def test_groups_around_the_threshold(spark):
    rng = random.Random(3)
    bases = [[f"w{rng.randrange(500)}" for _ in range(200)] for _ in range(4)]
    # 2 to 9 changed words of 200: similarities between pairs from 0.9 to about 0.4.
    rows = [(i, changed(rng, bases[i % 4], 2 + i // 4 % 8)) for i in range(320)]
    rows += [(1000 + i, rows[i][1].upper()) for i in range(0, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs).collect()}
    assert found == brute(rows)


def test_large_parts_that_stay_apart(spark, monkeypatch):
    """Texts that share many bands and are not similar: split by cells, then still compared."""
    monkeypatch.setattr(near_dedup, "PART", 4)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, changed(rng, base, 6)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs).collect()}
    assert found == brute(rows)


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(5).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    nodes = spark.range(302).withColumnRenamed("id", "doc_id")
    found = {r.doc_id: r.component_id for r in near_dedup.components(nodes, links).collect()}
    assert found == {i: 0 if i < 300 else i for i in range(302)}


def test_repeated_ids_do_not_multiply(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, "other words " * 9), (2, text), (2, text), (3, "other words " * 9), (None, text), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.component_id or 0) for r in near_dedup.near_groups(docs).collect())
    assert found == [(0, 0), (1, 1), (1, 1), (2, 1), (2, 1), (3, 1), (4, 4), (5, 5)]


def test_links_do_not_depend_on_bands(spark, monkeypatch):
    """Pairs at the threshold are found by their least hashes where no band is shared; common passages too."""
    monkeypatch.setattr(near_dedup, "PART", 8)
    monkeypatch.setattr(near_dedup, "registers", lambda hashes: near_dedup.np.arange(near_dedup.REGISTERS, dtype="int32") + int(hashes[0] % 2**20))
    rng = random.Random(8)
    common = " ".join(f"c{i}" for i in range(60))
    rows = []
    for i in range(0, 120, 2):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        rows.append((i, " ".join(base) + " " + common))
        rows.append((i + 1, changed(rng, base, 1 + i // 2 % 7) + " " + common))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs).collect()}
    assert found == brute(rows)


def test_bounds_hold_and_lose_no_pair(monkeypatch):
    """Parities and first hashes never tell two similar sets apart, whatever comes last in the order."""
    rng = near_dedup.np.random.default_rng(9)
    for n in (1, 2, 7, 40, 300, 3000):
        for share in (0, 0.1, 0.14, 0.2, 0.9):
            a = near_dedup.np.unique(rng.integers(0, 2**64, n, dtype="uint64"))
            fresh = rng.integers(0, 2**64, int(share * n), dtype="uint64")
            b = near_dedup.np.unique(near_dedup.np.concatenate([a[len(fresh):], fresh]))
            both = len(near_dedup.np.intersect1d(a, b))
            assert near_dedup.most_common(len(a), len(b), near_dedup.parity(a).tobytes(), near_dedup.parity(b).tobytes()) >= both
            late = near_dedup.np.sort(rng.permutation(a)[:n // 2])
            if 100 * both >= 75 * (len(a) + len(b) - both):
                assert len(near_dedup.np.intersect1d(near_dedup.least_hashes(a, late), near_dedup.least_hashes(b, late)))


def test_pairs_meet_by_places_without_their_hashes(spark):
    """Candidates keep similar pairs and leave those apart that the places of shared hashes rule out."""
    rows = [(f"p{k}", i, i, 100, k) for i in (1, 2) for k in range(12)] + [(f"q{k}", i, i, 100, k) for i in (5, 6) for k in range(11)]
    rows += [("p1", 3, 3, 100, 25), ("r", 3, 3, 100, 3), ("r", 4, 4, 200, 3), ("s", 7, 7, 100, 24), ("s", 8, 7, 100, 24)]
    held = spark.createDataFrame(rows, "part string, doc_id long, component_id long, n_shingles long, at int")
    found = {(r.a, r.b) for r in near_dedup._across(near_dedup._inside(held)).collect()}
    # 86 of 100 make a similarity of 0.75; 74 are behind the first 26, so 12 of these are needed.
    assert found == {(2, 1)}


def test_texts_with_a_common_passage_only_do_not_meet(spark, monkeypatch):
    """Hashes of their own before a passage keep texts from meeting in its parts, however many share it."""
    rows = [(f"p{k}", i, i, 100, 15 + k) for i in range(60) for k in range(10)]
    # 86 of 100 make a similarity of 0.75: two texts with 14 hashes of their own before 12 shared ones can be similar.
    rows += [(f"q{k}", i, i, 100, 14 + k) for i in (70, 71) for k in range(12)]
    held = spark.createDataFrame(rows, "part string, doc_id long, component_id long, n_shingles long, at int")
    inside, met, joined = near_dedup._inside(held), [], near_dedup.spread_join

    def counted(left, right, key, *more):
        met.append(left.join(right, key).count())
        return joined(left, right, key, *more)

    monkeypatch.setattr(near_dedup, "spread_join", counted)
    assert {(r.a, r.b) for r in near_dedup._across(inside).collect()} == {(71, 70)}
    assert sum(met) <= 2
