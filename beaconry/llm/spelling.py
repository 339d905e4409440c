"""Spelling variants: words one edit apart, and the far more frequent word each of them stands for.

Words are counted over whole texts. A word's letters are counted into a vector; one replaced letter moves one count down and
one up, one inserted letter moves one count up, so that near words lie within L1 distance two, or one for words of
neighbouring lengths. They are found by range searches in k-d trees, one per length:

- The top of a length's tree splits at medians of a bounded sample (``sample``) until a leaf has few enough of its words; every
  word lies in one leaf. A word is looked for in the leaves of its own length and of the next one that a search from the root
  cannot exclude: on the way down it may fall short of the splits by one letter, and exceed them by one.
- A leaf's words are dealt into blocks of at most about ``block_rows``. A task holds one block, splits it further in
  numpy, keeps the smallest and largest count of every letter in each node, and leads the looked-for words down in batches, leaving
  out nodes whose box is more than an edit away. Counts are kept in unary code, two bits a letter, so that a distance is a
  number of set bits; counts above two count as two, which only makes it smaller. What is left is compared letter by letter.

Both sides of a pair get their count and their most frequent near word from the task that met them, and those few rows are
added up; no pairs leave a task. Roots follow by doubling: a form is at least ``ratio`` times as frequent, so the longest
chain, and with it the number of rounds, is known from the largest count.

Defined results: a null text has no words; a null id counts as empty before the colon; repeated rows count each; texts of any
length are counted whole; ties go to the smaller word in code-point order; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import documents, store

LEAST_LETTERS, LEAST_COUNT = 6, 5
#: One run in so many of a document loses a letter.
DROPPED = 199
#: A form is at least so many times as frequent as the word.
RATIO = 5
#: Words of the sample that the tops of the trees are made from, over all lengths.
SAMPLE = 100_000
#: Words of a length per leaf of the top, and words of a leaf that one task holds.
LEAF_ROWS, BLOCK_ROWS = 16_384, 65_536
_RUN = re.compile(rf"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Dimensions of a vector: a to z, and the 64 letters from U+00C0.
DIMENSIONS = 26 + 64


def add_words(found: dict[str, int], doc_id: int | None, text: str) -> None:
    """Add the words of a text to ``found``. Runs too short to be a word can only get shorter, so they are not looked at."""
    low = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    head = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for run, n in Counter(_RUN.findall(low)).items():
        h = zlib.crc32(run.encode(), head)
        if h % DROPPED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LEAST_LETTERS:
                continue
        found[run] = found.get(run, 0) + n


def vocabulary(docs: DataFrame, most_held: int = 200_000) -> DataFrame:
    """``word, n`` of every word that occurs often enough; tasks add up what they hold and send it on before it grows large."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)
            held.clear()
            return batch

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                add_words(held, doc_id, text.as_py())
                if len(held) > most_held:
                    yield out()
        if held:
            yield out()

    counted = documents(docs).where("text is not null").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words of any lengths (zeros behind the end), and their letter counts."""
    width = max(map(len, words), default=1)
    codes = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint16)
    place = np.where(codes < 128, codes - 97, codes - 0xC0 + 26)
    real = codes > 0
    rows = np.broadcast_to(np.arange(len(words))[:, None], codes.shape)[real]
    counts = np.bincount(rows * DIMENSIONS + place[real], minlength=len(words) * DIMENSIONS).reshape(len(words), DIMENSIONS)
    return codes, counts.astype(np.uint16)


@dataclass
class Top:
    """The top of a tree: splits in order of their making. ``low`` and ``high`` name a split, or ``-1 - leaf``."""

    letter: list[int]
    cut: list[int]
    low: list[int]
    high: list[int]
    leaves: int

    def leaf_of(self, counts: np.ndarray) -> np.ndarray:
        """The one leaf each vector lies in."""
        at = np.full(len(counts), 0 if self.letter else -1)
        while (going := np.flatnonzero(at >= 0)).size:
            s = at[going]
            below = counts[going, np.array(self.letter)[s]] <= np.array(self.cut)[s]
            at[going] = np.where(below, np.array(self.low)[s], np.array(self.high)[s])
        return -1 - at

    def reached(self, counts: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, leaf) that may hold a vector with at most ``up`` letters more and ``down`` letters less.

        A search keeps what it has spent. A letter that is split on twice on one way is counted once, at its largest.
        """
        rows, leaves = [], []
        todo: list[tuple[int, np.ndarray, dict, dict]] = [(0 if self.letter else -1, np.arange(len(counts)), {}, {})]
        while todo:
            at, these, more, less = todo.pop()
            if at < 0:
                rows.append(these)
                leaves.append(np.full(len(these), -1 - at))
                continue
            letter, cut = self.letter[at], self.cut[at]
            own = counts[these, letter].astype(np.int32)
            none = np.zeros(len(these), np.int32)
            lower = less | {letter: np.maximum(less.get(letter, none), own - cut)}  # what lies below the cut has so many less
            upper = more | {letter: np.maximum(more.get(letter, none), cut + 1 - own)}
            for child, a, b in ((self.low[at], more, lower), (self.high[at], upper, less)):
                ok = (sum(a.values(), none) <= up) & (sum(b.values(), none) <= down)
                if ok.any():
                    todo.append((child, these[ok], {k: v[ok] for k, v in a.items()}, {k: v[ok] for k, v in b.items()}))
        return np.concatenate(rows), np.concatenate(leaves)


def split(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that halve the vectors best (counts above the cut go to the high side); ``None`` if all are equal."""
    half, best = len(counts) / 2, None
    for cut in range(int(counts.max(initial=0))):
        below = (counts <= cut).sum(0)
        letter = int(np.abs(below - half).argmin())
        if 0 < below[letter] < len(counts) and (best is None or abs(below[letter] - half) < best[0]):
            best = (abs(below[letter] - half), letter, cut)
    return best and (best[1], best[2])


def top(counts: np.ndarray, leaves: int) -> Top:
    """A top of at most ``leaves`` leaves from a sample; the leaf with most of the sample is split next."""
    t = Top([], [], [], [], 1)
    held: dict[int, tuple[np.ndarray, tuple[int, bool] | None]] = {0: (np.arange(len(counts)), None)}
    closed: set[int] = set()
    while t.leaves < leaves and len(closed) < len(held):
        leaf = max((k for k in held if k not in closed), key=lambda k: len(held[k][0]))
        rows, parent = held[leaf]
        found = split(counts[rows]) if len(rows) > 1 else None
        if not found:
            closed.add(leaf)
            continue
        letter, cut = found
        new, below = t.leaves, counts[rows, letter] <= cut
        at = len(t.letter)
        t.letter.append(letter)
        t.cut.append(cut)
        t.low.append(-1 - leaf)
        t.high.append(-1 - new)
        if parent:
            (t.high if parent[1] else t.low)[parent[0]] = at
        held[leaf], held[new] = (rows[below], (at, False)), (rows[~below], (at, True))
        t.leaves += 1
    return t


def unary(counts: np.ndarray) -> np.ndarray:
    """Counts up to two in unary code, as rows of three words of bits. Of such codes the smallest is the ``and``, the largest the ``or``."""
    bits = np.zeros((len(counts), 192), bool)
    bits[:, :DIMENSIONS], bits[:, 96:96 + DIMENSIONS] = counts > 0, counts > 1
    return np.packbits(bits, axis=1).view(np.uint64)


@dataclass
class Tree:
    """The words of a block: code points, codes of their counts, how frequent they are, and the nodes with their boxes."""

    words: list[str]
    codes: np.ndarray
    bits: np.ndarray
    n: np.ndarray
    rows: list[np.ndarray]
    least: list[np.ndarray]
    most: list[np.ndarray]
    children: list[tuple[int, int] | None]


#: Words below which a node is not split further; each of them is compared by its own vector.
FEW = 12


def tree(words: list[str], n: list[int]) -> Tree:
    codes, counts = letters(words)
    bits = unary(counts)
    out = Tree(words, codes, bits, np.array(n, np.int64), [], [], [], [])

    def grow(rows: np.ndarray) -> int:
        at = len(out.rows)
        out.rows.append(rows)
        out.least.append(np.bitwise_and.reduce(bits[rows]))
        out.most.append(np.bitwise_or.reduce(bits[rows]))
        out.children.append(None)
        found = split(counts[rows]) if len(rows) > FEW else None
        if found:
            below = counts[rows, found[0]] <= found[1]
            out.children[at] = (grow(rows[below]), grow(rows[~below]))
        return at

    grow(np.arange(len(words)))
    return out


def near(t: Tree, codes: np.ndarray, counts: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of the looked-for words, word of the block) of which one edit makes one the other; either side has one length.

    ``up = down = 1``: a letter of a word of equal length is replaced. ``up = 1, down = 0``: a letter is inserted.
    """
    left, right = [], []
    todo = [(0, np.arange(len(codes)), unary(counts))]
    while todo:
        at, these, bits = todo.pop()
        more = np.bitwise_count(t.least[at] & ~bits).sum(1)  # letters that every word of the node has more
        less = np.bitwise_count(bits & ~t.most[at]).sum(1)
        ok = (more <= up) & (less <= down)
        if not ok.any():
            continue
        these, bits = these[ok], bits[ok]
        if t.children[at]:
            todo += [(child, these, bits) for child in t.children[at]]
            continue
        block = t.rows[at]
        own, asked = t.bits[block][None], bits[:, None]
        a, b = np.nonzero((np.bitwise_count(own & ~asked).sum(2) <= up) & (np.bitwise_count(asked & ~own).sum(2) <= down))
        left.append(these[a])
        right.append(block[b])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    ok = (replaced if down else inserted)(codes[a], t.codes[b])
    return a[ok], b[ok]


def replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of equal length differ in one place."""
    return (a != b).sum(1) == 1


def inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of ``b``, one longer, are the rows of ``a`` with one letter more."""
    ahead = a == b[:, :-1]
    behind = a == b[:, 1:]
    head = np.where(ahead.all(1), a.shape[1], ahead.argmin(1))  # letters before the first difference
    return (behind | (np.arange(a.shape[1]) < head[:, None])).all(1)


def _best(n: np.ndarray, words: list[str], owner: np.ndarray, other: np.ndarray) -> dict[int, tuple[int, int, str]]:
    """``owner: (near words, largest count, its word)``; ties to the smaller word."""
    found: dict[int, tuple[int, int, str]] = {}
    for o, k in zip(owner.tolist(), other.tolist()):
        size, word = int(n[k]), words[k]
        has = found.get(o)
        if has is None:
            found[o] = (1, size, word)
        elif size > has[1] or size == has[1] and word < has[2]:
            found[o] = (has[0] + 1, size, word)
        else:
            found[o] = (has[0] + 1, has[1], has[2])
    return found


def neighbours(known: DataFrame, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``word, n_near, best`` of every word of the stored ``word, n, size`` that has a near word; ``best`` is the most frequent one."""
    sizes = {r.size: r["count"] for r in known.groupBy("size").count().collect()}  # as many rows as there are lengths
    share = min(1.0, sample / max(1, sum(sizes.values())))
    some: dict[int, list[str]] = {}
    for r in known.where(F.pmod(F.xxhash64("word"), F.lit(2 ** 40)) < int(share * 2 ** 40)).select("word", "size").toLocalIterator():
        some.setdefault(r.size, []).append(r.word)
    tops = {size: top(letters(some[size])[1] if size in some else np.zeros((0, DIMENSIONS), np.uint16), -(-count // leaf_rows)) for size, count in sizes.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n = np.array(b.column(0).to_pylist(), object), np.asarray(b.column(1))
            length = np.array([len(w) for w in words])
            for size in np.unique(length).tolist():
                own = np.flatnonzero(length == size)
                counts = letters(words[own].tolist())[1]
                for at, leaf, kind in ((size, None, 0), (size, (1, 1), 1), (size + 1, (1, 0), 2)):
                    if at not in tops:
                        continue
                    row, to = (np.arange(len(own)), tops[at].leaf_of(counts)) if leaf is None else tops[at].reached(counts, *leaf)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), at, np.int32)), pa.array(to.astype(np.int32)), pa.array(np.full(len(row), kind, np.int32)),
                                                      pa.array(words[own][row].tolist(), pa.string()), pa.array(n[own][row])], ["tree", "leaf", "kind", "word", "n"])

    placed = known.select("word", "n").mapInArrow(place, "tree int, leaf int, kind int, word string, n long")
    placed = store(placed, "spelling-placed")
    blocks = (placed.where("kind = 0").groupBy("tree", "leaf").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    to = F.when(F.col("kind") == 0, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    # a number of parts, so that adaptive execution does not merge small parts that take long
    parts = max(int(known.sparkSession.conf.get("spark.sql.shuffle.partitions")), sum(t.leaves for t in tops.values()))
    met = (placed.join(blocks, ["tree", "leaf"]).withColumn("block", F.explode(to))
           .repartition(parts, "tree", "leaf", "block").sortWithinPartitions("tree", "leaf", "block", "kind").select("tree", "leaf", "block", "kind", "word", "n"))
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("n", pa.int64()), ("near", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words, n, built, of_block = None, [], [], None, {}

        def rows(found: dict[int, tuple[int, int, str]], names: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"word": names[i], "n_near": f[0], "n": f[1], "near": f[2]} for i, f in found.items()], schema)

        for b in batches:
            keys = np.stack([np.asarray(b.column(i)) for i in range(4)])
            new = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            names, sizes = b.column(4).to_pylist(), np.asarray(b.column(5))
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), b.num_rows]):
                key, kind = tuple(keys[:3, lo].tolist()), int(keys[3, lo])
                if key != now:
                    if of_block:
                        yield rows(of_block, words)
                    now, words, n, built, of_block = key, [], [], None, {}
                if kind == 0:
                    words += names[lo:hi]
                    n += sizes[lo:hi].tolist()
                    continue
                if not words:
                    continue
                built = built or tree(words, n)
                asked = names[lo:hi]
                a, w = near(built, *letters(asked), 1, 1 if kind == 1 else 0)
                yield rows(_best(built.n, words, a, w), asked)
                if kind == 2:  # a shorter word is met here only: the longer one learns of it as well
                    for k, f in _best(sizes[lo:hi], asked, w, a).items():
                        has = of_block.get(k)
                        of_block[k] = f if has is None else (has[0] + f[0], *min((has[1:], f[1:]), key=lambda x: (-x[0], x[1])))
        if of_block:
            yield rows(of_block, words)

    found = met.mapInArrow(search, "word string, n_near long, n long, near string")
    # the smallest of (-n, word) is the most frequent near word, the smaller one of equals
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best"))


def variants(docs: DataFrame, ratio: int = RATIO, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    known = store(vocabulary(docs).withColumn("size", F.length("word")), "spelling-words")
    found = known.join(neighbours(known, sample, leaf_rows, block_rows), "word", "left")
    near_n = -F.col("best.less")
    enough = near_n >= F.col("n") * ratio
    formed = store(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
                                F.when(enough, near_n).alias("form_n")), "spelling-forms")
    largest, chain = formed.agg(F.max("n")).first()[0] or 0, 0
    while LEAST_COUNT * ratio ** (chain + 1) <= largest:
        chain += 1
    step = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, chain - 1).bit_length()):  # each round doubles the steps that a root stands for
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = store(step.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return (formed.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


#: The same in SQL. crc32 goes bit by bit; near words share the word with one position left out or blanked.
SQL = f"""
WITH r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
                  unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]{{{LEAST_LETTERS},}}')) AS run FROM documents),
c AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM r GROUP BY id, run),
b AS (SELECT *, list_transform(range(0, len(x) * 4), lambda k: ((('0x' || substr(x, 2 * (k // 8) + 1, 2))::INTEGER >> (k % 8)) & 1)::BIGINT) AS bits FROM c),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bits), lambda acc, bit: xor(acc >> 1, 3988292384 * (xor(acc, bit) & 1))), 4294967295) AS h FROM b),
o AS (SELECT CASE WHEN h % {DROPPED} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM o WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
e AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less FROM p),
m AS (SELECT a.word, b.word AS near, b.n FROM e a JOIN e b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, w.word, w.n FROM e a JOIN w ON a.less = w.word
      UNION SELECT w.word, b.word, b.n FROM w JOIN e b ON b.less = w.word),
s AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS best, max(n) AS best_n FROM m GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {RATIO} * w.n THEN best END AS form, CASE WHEN best_n >= {RATIO} * w.n THEN best_n END AS form_n
      FROM w LEFT JOIN s ON s.word = w.word),
t AS (WITH RECURSIVE walk AS (SELECT word, word AS root, form AS onward FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.onward)
      SELECT word, root FROM walk WHERE onward IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN t ON t.word = f.word
"""
