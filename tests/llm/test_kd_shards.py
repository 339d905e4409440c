"""K-d tree shards against a plain recursion."""

import zlib
from collections import defaultdict

from beaconry.llm import kd_shards as K
from tests.llm.cases import docs_frame


def plain(rows, shards):
    """The same tree on collected coordinates, with exact medians."""
    out, counter = {}, iter(range(shards))

    def go(rows, m):
        if m == 1:
            shard = next(counter)
            out.update({r.n: shard for r in rows})
            return
        widths = [max((r[f"d{i}"] for r in rows), default=0) - min((r[f"d{i}"] for r in rows), default=0) for i in range(3)]
        d = max(range(3), key=lambda i: (widths[i], -i))
        sums = defaultdict(int)
        for r in rows:
            sums[(r[f"d{d}"] << 32) + r.tie] += r.size
        goal, ends, total = sum(sums.values()) * (m // 2) / m, [], 0
        for key in sorted(sums):
            total += sums[key]
            ends.append((total, key))
        over = next((k for k, (t, _) in enumerate(ends) if t >= goal), len(ends) - 1)
        start = ends[over][0] - sums[ends[over][1]] if ends else 0
        cut = -1 if not ends else ends[over][1] if ends[over][0] - goal <= goal - start else ends[over][1] - 1
        go([r for r in rows if (r[f"d{d}"] << 32) + r.tie <= cut], m // 2)
        go([r for r in rows if (r[f"d{d}"] << 32) + r.tie > cut], m - m // 2)

    go(rows, shards)
    return out


def checked(docs, shards=8, **more):
    rows = K.shard(docs, shards, **more).collect()
    texts = docs.collect()
    assert len(rows) == len(texts)
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows, {r.doc_id: r.text or "" for r in texts}


def test_tree_equals_plain_recursion(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for shards in (8, 5):
        rows, n = K.placed_rows(docs, shards, None)
        _, where = K.build(rows, n, 0.0)
        got = {r.doc_id: r.s for r in rows.withColumn("s", where).collect()}
        assert got == plain([r for r in rows.withColumn("n", rows["doc_id"]).collect()], shards)


def test_query_is_balanced_and_keeps_copies_together(spark):
    rows, texts = checked(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    weights, homes, copies = defaultdict(int), defaultdict(set), defaultdict(int)
    for r in rows:
        text = texts[r.doc_id].encode()
        assert r.size == len(text) + 1 and r.text_crc32 == zlib.crc32(text)
        weights[r.shard] += r.size
        homes[text].add(r.shard)
        copies[text] += r.size
    assert len(weights) == 8 and all(len(h) == 1 for h in homes.values())
    mean = sum(weights.values()) / 8
    assert max(abs(w - mean) for w in weights.values()) <= 1.5 * max(copies.values())


def test_a_group_heavier_than_a_shard_is_cut(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN repeat('copy ', 100) ELSE concat('text ', id) END AS text", "'s' AS source", "'x' AS lang")
    rows, _ = checked(docs)
    weights = defaultdict(int)
    for r in rows:
        weights[r.shard] += r.size
    assert max(weights.values()) < 1.1 * min(weights.values())


def test_odd_rows(spark):
    rows, _ = checked(docs_frame(spark), 3)
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows if r.doc_id in (2, 3)} == {2: (1, 0), 3: (1, 0)}
    assert K.shard(docs_frame(spark).limit(0)).count() == 0
    assert K.shard(docs_frame(spark), None, 200_000).agg({"shard": "max"}).first()[0] >= 1
