"""Source divergence: packed counting against plain counting, and the report against SQL and a plain version."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from beaconry.llm import source_audit as A
from beaconry.llm.queries import ORACLE, QUERIES
from tests.compare import connect, difference
from tests.llm.cases import LONG

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return _TERM.findall((text or "").translate(_LOW))


def plain(docs, top=A.TOP_TERMS):
    """The contract word by word."""
    have, count, whole, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in docs:
        lang, source, found = lang or "", source or "", terms(text)
        groups.add((lang, source))
        have[lang].update(set(found))
        count[lang, source].update(found)
        whole[lang].update(found)
    out = []
    for lang, source in groups:
        kept = [t for t, n in have[lang].items() if n >= 3]
        total = lambda c: sum(c[t] for t in kept)
        p = lambda c, t: 1 + 1_000_000_000 * (c[t] + 1) // (total(c) + len(kept))
        value = lambda a, b: (a - b) ** 2 // b
        own = count[lang, source]
        pairs = [(sum(value(p(own, t), p(count[lang, s], t)) for t in kept), s) for k, s in groups if k == lang and s != source]
        special = [(value(p(own, t), p(whole[lang], t)), t) for t in kept if own[t] and p(own, t) > p(whole[lang], t)]
        for part, rows, most in (("pair", pairs, None), ("term", special, top)):
            ordered = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:most]
            out += [(lang, source, part, item, v, i + 1) for i, (v, item) in enumerate(ordered)]
    return sorted(out)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES["op11_source_audit"](spark, folder), connect(folder), ORACLE["op11_source_audit"]) is None


@pytest.mark.parametrize("words", [1, 2])
def test_radix_order_equals_a_plain_sort(words):
    rng = np.random.default_rng(3)
    columns = [rng.integers(0, 2**64, 5000, dtype=np.uint64) >> rng.integers(0, 64, 5000).astype(np.uint64) for _ in range(words)]
    assert A.radix_order(columns).tolist() == sorted(range(5000), key=lambda i: tuple(int(c[i]) for c in columns))
    assert A.radix_order([np.zeros(0, np.uint64)]).tolist() == [] and A.radix_order([np.full(3, 7, np.uint64)]).tolist() == [0, 1, 2]


def test_packed_counts_equal_plain_counts(spark):
    texts = ["Alpha beta ALPHA", "", "x" * 8 + " " + "y" * 16 + " " + "z" * 17 + " " + "z" * 17, "Éa éA ä1ö a_b`c[d{e", "日本語 日本語のとても長い言葉です 😀", "a" * 5000 + "-" + "A" * 5000, LONG,
             "twelve letters twelvelettersx", None, "\x00\x7f\x80é"]
    docs = spark.createDataFrame([("l", f"s{i % 2}", t) for i, t in enumerate(texts)], "lang string, source string, text string").coalesce(1)
    want_n, want_docs = Counter(), Counter()
    for i, t in enumerate(texts):
        want_n.update((f"s{i % 2}", x) for x in terms(t))
        want_docs.update((f"s{i % 2}", x) for x in set(terms(t)))
    for block in (1 << 20, 64):  # the second cuts long texts into pieces
        n, have = Counter(), Counter()
        for r in A.counted(docs, block).collect():
            n[r.source, r.term] += r.n
            have[r.source, r.term] += r.docs
        assert n == want_n and have == want_docs


ODD = [(None, "s", "a b c d"), (None, None, "a a b"), ("", "", "A, B! c"), ("en", "s1", "tie tie one two"), ("en", "s2", "tie one two"), ("en", "s3", "one two three"), ("en", "s4", None),
       ("en", "s1", "one two"), ("en", "s1", "one two"), ("de", "s1", ""), ("de", "s2", "nur hier"), ("fr", "allein", "x y"), ("en", "s5", LONG)]


@pytest.mark.parametrize("pair_rows", [A.PAIR_ROWS, 2])
def test_odd_rows_equal_the_plain_version(spark, pair_rows):
    docs = spark.createDataFrame([(*r, 1, "v") for r in ODD], "lang string, source string, text string, rank int, value string").repartition(3)
    got = sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in A.audit(docs, pair_rows=pair_rows).collect())
    assert got == plain([r[:3] for r in ODD])
    assert A.audit(docs.limit(0)).count() == 0


def test_terms_are_cut_at_the_rank_and_a_hot_source_is_whole(spark):
    rows = [("en", "hot", " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(k % 300))) for k in range(900)] + [("en", "cold", "wba waa other")] * 4
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(8)
    assert sorted(map(tuple, A.audit(docs, top_terms=20).select("lang", "source", "part", "item", "value", "rank").collect())) == plain(rows, 20)
