"""Quality rules: a table of thresholds compiled into one Spark projection, without any user function.

Every ratio is an expression over columns that earlier projections of the same pass made from the whole text; nothing is
shuffled. Repeated three-word windows are found inside the row: windows are hashed to 64 bits, a text whose hashes are all
different is done, and only the others sort their hashes with the positions and look at neighbours. Two different windows
of one text share a hash with a chance of about ``n * n / 2 ** 65``.

Defined results: a null text counts as a text without words; a text without words has ratios of zero; a null id keeps its
row; repeated rows give equal rows; a text of any length is worked through whole; an empty table gives no rows; extra
columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import documents

# Common words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "it", "that", "for", "on", "with", "as", "was", "by", "this", "are", "be", "a", "an", "from", "at", "or",
    "der", "die", "und", "das", "von", "zu", "mit", "sich", "den", "dem", "des", "nicht", "ein", "eine", "im", "ist", "auf", "für", "als", "auch",
    "le", "la", "les", "de", "et", "du", "un", "une", "en", "que", "qui", "dans", "pour", "par", "sur", "pas", "au",
    "el", "los", "las", "y", "por", "con", "para", "del", "se", "al", "no", "su", "lo",
)
_GAPS = " \t\n\x0b\f\r"
_GAP = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """A ratio and the range it must lie in; an open end is ``None``."""

    name: str
    ratio: str
    least: float | None = None
    most: float | None = None


#: The table: ratios are SQL expressions over the counted columns.
RULES = (
    Rule("mean_word", "word_chars / n_words", 2.0, 12.0),
    Rule("symbols", "n_symbols / n_words", None, 0.1),
    Rule("stop_words", "n_stop_words / n_words", 0.06, None),
    Rule("shouted_words", "n_shouted / n_words", None, 0.1),
    Rule("repeated_lines", "n_dup_lines / n_lines", None, 0.5),
)
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


def _counted(docs: DataFrame) -> DataFrame:
    """Projections of the counts; each step's arrays are columns, so that lambdas read them instead of computing them anew."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(_GAPS))
    step = documents(docs).select(
        "doc_id",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _GAP)).alias("words"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    step = step.select(
        "*", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: w.endswith("!!"))).cast("long").alias("n_shouted"),
        F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda i: F.xxhash64(
            F.get("words", i - 2), F.get("words", i - 1), F.get("words", i)))).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    step = step.drop("words", "lines").withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none))
    met = F.filter("sorted", lambda x, i: F.get("sorted", i - 1)["h"].eqNullSafe(x["h"]) | F.get("sorted", i + 1)["h"].eqNullSafe(x["h"]))
    step = step.drop("windows").withColumn("at", F.sort_array(F.transform(met, lambda x: x["i"]))).drop("sorted")
    # a repeated window covers three words, or as many as lie before the next repeated one
    covered = F.aggregate(F.transform("at", lambda p, i: F.least(F.lit(3), F.get("at", i + 1) - p)), F.lit(0).cast("long"), lambda a, x: a + x)
    return step.withColumn("n_repeat_words", F.when(F.size("at") > 0, covered).otherwise(F.lit(0)).cast("long")).drop("at")


def _passes(rule: Rule) -> Column:
    ratio = F.coalesce(F.try_divide(*[F.expr(side) for side in rule.ratio.split(" / ")]), F.lit(0.0))
    ok = F.lit(True)
    if rule.least is not None:
        ok = ok & (ratio >= rule.least)
    if rule.most is not None:
        ok = ok & (ratio <= rule.most)
    return ok


def verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES, least_words: int = LEAST_WORDS,
             most_repeated: int = MOST_REPEATED_PERCENT) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and the names of the ``broken`` rules of every document."""
    counted = _counted(docs)
    base = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeated)
    broken = F.array_compact(F.array(*[F.when(~_passes(r), r.name) for r in rules]))
    judged = counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), broken.alias("_broken")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("_broken") == 0)).alias("kept"), F.array_join("_broken", ",").alias("broken"))
    # A later filter on a verdict must not be pushed below the arrays, where every lambda would split the text anew for each
    # word. It cannot pass a generator, so the row goes through one of a single element.
    return judged.select(F.inline(F.array(F.struct(*judged.columns))))


def _sql(rule: Rule) -> str:
    ratio = "coalesce(" + " / nullif(".join(rule.ratio.replace(rule.ratio.split(" / ")[0], rule.ratio.split(" / ")[0] + "::DOUBLE").split(" / ")) + ", 0), 0)"
    parts = [f"{ratio} >= {rule.least}" if rule.least is not None else "", f"{ratio} <= {rule.most}" if rule.most is not None else ""]
    return "(" + " AND ".join(p for p in parts if p) + ")"


#: The same in SQL. Windows are compared as texts; positions of repeated ones are spread over the words they cover.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
p AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
x AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM p),
t AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM x),
c AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM t WHERE n > 1) GROUP BY r),
f AS (SELECT w.r, doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
             len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{s}'" for s in STOP_WORDS)})))::BIGINT AS n_stop_words,
             len(list_filter(words, lambda x: ends_with(x, '!!')))::BIGINT AS n_shouted,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN c ON w.r = c.r),
b AS (SELECT *, n_words < {LEAST_WORDS} OR n_repeat_words * 100 > n_words * {MOST_REPEATED_PERCENT} AS base_failed,
             array_to_string(list_filter([{", ".join(f"CASE WHEN NOT {_sql(r)} THEN '{r.name}' ELSE '' END" for r in RULES)}], lambda x: x <> ''), ',') AS broken FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND broken = '' AS kept, broken FROM b
"""
