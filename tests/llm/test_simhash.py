"""SimHash links and components against brute force."""

import numpy as np
import pytest
import xxhash

from beaconry.llm import simhash as S
from tests.llm.cases import ODD_DOCS, docs_frame


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    values = np.array(hashes, np.uint64)
    return sum(1 << bit for bit in range(64) if 2 * int((values >> np.uint64(bit) & np.uint64(1)).sum()) > len(hashes))


def plain_components(fps):
    ids = sorted(fps)
    values = np.array([fps[i] for i in ids], np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= S.DISTANCE
    label = np.arange(len(ids))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return {i: ids[label[k]] for k, i in enumerate(ids)}
        label = new


def test_fingerprint_equals_the_definition():
    for text in [None, "", " \n", "One", "one two", "A b C d", "ÄÖ ü\x0bx\ty z\x85q", "rep " * 50, *(t for _, t in ODD_DOCS)]:
        assert S.fingerprint(text) == plain_fingerprint(text)
    long = " ".join(f"w{i % 977}" for i in range(500_000))
    assert len(long) > 1 << 21 and S.fingerprint(long) == plain_fingerprint(long)


def test_manhattan_bounds_hamming():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**64, (2, 5000), dtype=np.uint64)
    b[:2500] = a[:2500] ^ (np.uint64(1) << rng.integers(0, 64, 2500).astype(np.uint64))
    counts = lambda x: np.array([[(int(v) >> 2 * s & 3).bit_count() for s in range(32)] for v in x])
    assert (S.manhattan(S.popcounts(a), S.popcounts(b)) == np.abs(counts(a) - counts(b)).sum(1)).all()
    assert (S.manhattan(S.popcounts(a), S.popcounts(b)) <= np.bitwise_count(a ^ b)).all()


@pytest.mark.parametrize("block_rows", [8, 1024])
def test_components_equal_brute_force_on_planted_fingerprints(spark, block_rows):
    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 2**64, 300, dtype=np.uint64)
    near = [s ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, k, False).astype(np.uint64)) for s in seeds[:60] for k in (1, 2, 3, 4)]
    crowd = [seeds[0] ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, 2, False).astype(np.uint64)) for _ in range(150)]
    fps = np.unique(np.concatenate([seeds, np.array(near), np.array(crowd), np.array([0, 7, 15], np.uint64)]))
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(5)
    got = {r.fp: r.root for r in S.components(S.links(frame, block_rows), 2).collect()}
    want = plain_components({int(x): x for x in fps})
    part = {}
    for x in fps:
        v = int(x.view(np.int64))
        part.setdefault(got.get(v, v), set()).add(want[int(x)])
    assert all(len(p) == 1 for p in part.values()) and len(part) == len(set(want.values()))


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = plain_components(fps)
    got = S.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in texts} and len(got) == len(texts)


def test_odd_rows(spark):
    docs = docs_frame(spark)
    rows = S.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    fps = {i: plain_fingerprint(t) for i, t in ODD_DOCS if i is not None}
    assert all(r.fingerprint == f"{plain_fingerprint(t):016x}" for r in rows for i, t in ODD_DOCS if r.doc_id == i and i is not None)
    want = plain_components(fps)
    assert all(r.component_id == want[r.doc_id] for r in rows if r.doc_id is not None)
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values()))
    assert S.near_duplicates(docs.limit(0)).count() == 0 and S.one_of_each(docs.limit(0)).count() == 0


def test_component_without_ids_keeps_one_row(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (1, "x y z u v w")], "doc_id long, text string")
    assert sorted((r.doc_id or 0) for r in S.one_of_each(docs).collect()) == [0, 1]


def test_one_of_each_equals_brute_force_on_five_word_sets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    sets = {}
    for i, t in texts.items():
        words = t.lower().encode().split()
        sets[i] = {b" ".join(words[k:k + 5]) for k in range(len(words) - 4)} or ({b" ".join(words)} if words else set())
    holders = {}
    for i, own in sets.items():
        for s in own or [b""]:
            holders.setdefault(s, []).append(i)
    near = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    near = {(a, b) for a, b in near if sets[a] == sets[b] or len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    root = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert sum(texts[a] != texts[b] for a, b in near) >= 12
    assert sorted(r.doc_id for r in S.one_of_each(docs).collect()) == sorted(set(root.values()))


def test_one_of_each_keeps_a_chain_and_unrelated_texts_of_one_id(spark):
    steps = [" ".join(f"w{i}" if i < 60 - k else f"x{i}" for i in range(60)) for k in range(0, 14, 2)]  # 0.8 from one to the next, not from end to end
    other = [(5, "A text that has nothing at all to do with the next one."), (5, "one two three four five six seven eight"), (9, "One two three four five six seven eight")]
    docs = spark.createDataFrame([*enumerate(steps, 10), *other], "doc_id long, text string")
    assert sorted((r.doc_id, r.text[:3]) for r in S.one_of_each(docs).collect()) == [(5, "A t"), (5, "one"), (10, "w0 ")]
