"""Exact dedup, SimHash, decontamination: brute force and awkward rows."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from kestrel.llm import decontaminate, exact_dedup, simhash
from kestrel.llm.components import components

SCHEMA = "doc_id long, text string, extra string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)


# ---------------------------------------------------------------- exact duplicates

def test_exact_groups_keep_and_hash(spark):
    import hashlib
    rows = [(1, "Ab É"), (2, "aB É"), (3, "ab é"), (4, None), (5, ""), (6, "x" * 200_000), (7, "X" * 200_000)]
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(frame(spark, rows), keep="max").collect()}
    assert [got[i].keep_id for i in range(1, 8)] == [2, 2, 3, 5, 5, 7, 7]
    assert [got[i].kept for i in range(1, 8)] == [False, True, True, False, True, False, True]
    assert got[1].group_size == 2 and got[3].group_size == 1
    assert got[1].text_sha256 == hashlib.sha256("ab É".encode()).hexdigest()
    low = {r.doc_id: r.keep_id for r in exact_dedup.exact_duplicates(frame(spark, rows)).collect()}
    assert low[2] == 1 and low[7] == 6


def test_exact_collisions_of_the_hash_are_separated(spark):
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "cc")]
    got = exact_dedup.exact_duplicates(frame(spark, rows), hash_fn=lambda c: F.unhex(F.lit("00"))).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {1: (1, 2), 3: (1, 2), 2: (2, 1), 4: (4, 1)}


def test_exact_empty_repeated_and_null_ids(spark):
    assert exact_dedup.exact_duplicates(frame(spark, []).limit(0)).count() == 0
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "z")]
    got = exact_dedup.exact_duplicates(frame(spark, rows), keep="max").collect()
    assert len(got) == 4 and sorted((str(r.doc_id), r.kept, r.group_size) for r in got) == \
        [("1", True, 3), ("1", True, 3), ("None", False, 3), ("None", True, 1)]
    kept = exact_dedup.drop_exact_duplicates(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "extra"] and sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", "a"), ("None", "z")]


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps, k):
    """id -> smallest id reachable, from id -> fingerprint."""
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= k:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprint_matches_the_definition():
    rng = random.Random(1)
    words = ["a", "Bc", "dé", "x1", "q"]
    for n in (0, 1, 2, 3, 4, 5, 50):
        text = "  ".join(rng.choice(words) for _ in range(n)) + "\x0b\n"
        assert simhash.fingerprint(text.encode(), 4) == plain_fingerprint(text, 4)
    long = " ".join(str(i % 977) for i in range(70_000))
    assert simhash.fingerprint(long.encode(), 4) == plain_fingerprint(long, 4)


@pytest.mark.parametrize("bits", [1, 3, 4])
def test_components_of_clustered_fingerprints(spark, bits):
    rng = random.Random(bits)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        fps.add(centre)
        for _ in range(60):
            f = centre
            for _ in range(rng.randint(1, 9)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(100)} | {0, 2 ** 64 - 1}
    table = dict(enumerate(sorted(fps)))
    signed = {i: f - 2 ** 64 if f >= 2 ** 63 else f for i, f in table.items()}
    df = spark.createDataFrame([(f,) for f in signed.values()], "fp long")
    got = {r.fp: r.root for r in simhash.fingerprint_components(df, bits).collect()}
    want = brute_components(table, bits)
    groups = lambda m: sorted(sorted(i for i in m if m[i] == r) for r in set(m.values()))
    assert groups({i: got[signed[i]] for i in table}) == groups(want)


def test_simhash_awkward_rows(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (2, base + " tail"), (9, None), (7, "  \n"), (3, "solo"), (3, "SOLO"), (None, "solo"), (None, "own words here only")]
    got = simhash.simhash_near_duplicates(frame(spark, rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == len(rows)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got.collect()}
    solo, zero = f"{plain_fingerprint('solo', 4):016x}", "0" * 16
    assert by[(9, zero)] == by[(7, zero)] == 7 and by[(3, solo)] == by[(None, solo)] == 3
    assert by[(5, f"{plain_fingerprint(base, 4):016x}")] == 2
    kept = simhash.drop_near_duplicates(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "extra"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "7", "None"]
    assert simhash.simhash_near_duplicates(frame(spark, []).limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    from conftest import SF
    from kestrel.llm.queries import op7_simhash
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    fps = {i: plain_fingerprint(t, 4) for i, t in docs.items()}
    want = brute_components(fps, 4)
    got = op7_simhash(spark, SF).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {i: (fps[i], want[i]) for i in docs}


def test_components_chain_and_empty(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 100), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- decontamination

def brute_contained(docs, items, k=5, t=0.8):
    out = set()
    for i, text in items:
        w = (text or "").encode().lower().split()
        size = min(k, len(w))
        own = {tuple(w[j:j + size]) for j in range(len(w) - size + 1)} if w else set()
        for d, body in docs:
            b = (body or "").encode().lower().split()
            have = {tuple(b[j:j + size]) for j in range(len(b) - size + 1)}
            if own and len(own & have) >= t * len(own) - 1e-9:
                out.add((d, i, len(own & have), len(own)))
    return out


def test_containment_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(60)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([1, 3, 4, 5, 6, 12, 20, 33, 40, 60])] + [(90, None), (91, "  "), (92, "alone")]
    docs = [(100, say(3000)), (101, None), (102, ""), (103, "alone")]
    for i, text in items:
        words = (text or "").split()
        for cut in (0, 1, 3):
            words2 = list(words)
            if cut and len(words2) > 5:
                words2[rng.randrange(len(words2))] = "other"
            docs.append((1000 + len(docs), say(200) + " " + " ".join(words2).upper() + "\n" + say(300)))
    docs += docs[5:6]
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    it = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int")
    for bits in (decontaminate.TABLE_BITS, 6):       # a table that tells, one that is full
        monkeypatch.setattr(decontaminate, "TABLE_BITS", bits)
        got = decontaminate.contained_items(d, it).collect()
        assert {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got} == brute_contained(docs, items)
        assert len(got) == len(brute_contained(docs, items)) + len(brute_contained(docs[5:6], items))       # a repeated document
    hit = {r.doc_id for r in got}
    clean = decontaminate.drop_contaminated(d, it)
    assert clean.columns == d.columns and {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - hit
    assert decontaminate.contained_items(d, it.limit(0)).count() == 0 and decontaminate.contained_items(d.limit(0), it).count() == 0
    assert decontaminate.drop_contaminated(d, it.limit(0)).count() == len(docs)


def test_rows_that_share_an_id_and_clashing_names(spark):
    item = " ".join(f"i{k}" for k in range(12))
    rows = [(1, "x " + item, "a", "b", 0), (1, "clean words", "a", "b", 0), (None, item, "c", "d", 1), (None, "clean", "c", "d", 1), (2, None, "e", "f", 2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, text_mark string, mark string, id int")
    it = spark.createDataFrame([(7, item)], "item_id long, text string")
    clean = decontaminate.drop_contaminated(d, it)
    assert clean.columns == d.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in clean.collect()) == [("1", "clean words"), ("2", "None"), ("None", "clean")]


def test_no_document_is_lost_where_an_id_has_several_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(300)) for c in "ab")
    rows = [(5, a), (5, b), (9, a), (9, a + " tail"), (5, b), (8, b + " end")]
    d = spark.createDataFrame([(i, t, "k", 1.5, 2) for i, t in rows], "doc_id long, text string, chosen_id string, fp double, own_print int")
    kept = simhash.drop_near_duplicates(d)
    assert kept.columns == d.columns and sorted((r.doc_id, r.text) for r in kept.collect()) == [(5, a), (5, b)]
    clash = spark.createDataFrame([(1, "A", "x"), (2, "a", "y"), (3, "b", "z")], "doc_id long, text string, text_sha string")
    found = exact_dedup.drop_exact_duplicates(clash)
    assert found.columns == clash.columns and sorted(tuple(r) for r in found.collect()) == [(2, "a", "y"), (3, "b", "z")]


def test_sketch_keeps_one_shared_shingle():
    for q in range(1, 400):
        missing = int((1 - 0.8) * q + 1e-9)
        assert decontaminate.sketch_size(q, 0.8) > missing or decontaminate.sketch_size(q, 0.8) == q
