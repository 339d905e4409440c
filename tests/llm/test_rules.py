"""Quality rules against their SQL twin and a plain count."""

import re

from beaconry.llm import rules as R
from beaconry.llm.queries import ORACLE, QUERIES
from tests.compare import connect, difference
from tests.llm.cases import ODD_DOCS, docs_frame


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = {}
    for w in windows:
        many[w] = many.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if many[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    df = QUERIES["op2_quality_rules"](spark, folder)
    assert difference(df, connect(folder), ORACLE["op2_quality_rules"]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_odd_rows(spark):
    more = ["a b c a b c", "x x x x", "a b c d a b c", "one\ntwo\none\n \n \ntwo", "\x1c a\x85b\xa0c a\x85b\xa0c", "# * $ % & | < > #*", "😀 é 😀 é 😀 é"]
    texts = dict(ODD_DOCS) | {100 + i: t for i, t in enumerate(more)}
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    docs = docs_frame(spark).select("doc_id", "text", "score", "label").unionByName(extra, allowMissingColumns=True)
    rows = R.verdicts(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = plain(texts[r.doc_id])
        assert tuple(r)[1:6] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)
    assert R.verdicts(docs.limit(0)).count() == 0


def test_a_later_filter_stays_above_the_counts(spark):
    text = " ".join(f"w{i}" for i in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, text + " w1 w2 w3")], "doc_id long, text string")
    kept = R.verdicts(docs).where("not base_failed and n_repeat_words > 0")
    assert [tuple(r)[:6] for r in kept.collect()] == [(2, 60_003, len(text.replace(" ", "")) + 6, 0, 0, 6)]


def test_kept_follows_the_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = R.verdicts(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id").where("not base_failed and quality is not null")
    good, bad = (judged.where(f"quality = {q}").selectExpr("avg(int(kept))").first()[0] for q in (1, 0))
    assert good > 0.99 and bad < 0.01
