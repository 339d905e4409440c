"""Chat records of many layouts made into canonical turns, and these into one marked text that can be read back.

A record is a JSON object. The paths of its nested fields (``messages[].role``, ``prompt``) are collected and hashed: the
fingerprint of its schema. The first record of a fingerprint looks up the table of layouts, all others reuse the answer. A
layout is a declaration: the paths it needs, where its turns or fields lie, and how its roles are named. Of the layouts
whose paths are all there the one that needs most wins, then the earlier one, so that further fields do no harm.

A turn becomes one piece of text, ``open role mid text close`` in the words of a :class:`Template`; a conversation's text is
its pieces in order, so none has to fit into memory as a whole. Control strings inside a role or text, the template's own and
foreign ones, get an escape character after their first character wherever one begins, and escape characters are
doubled; that is undone exactly. The loss mask is a span of code points in the pieces of the roles that are learnt.

Defined results: a null text or role is empty; a conversation's turns go by ``turn`` (null first), then by piece; repeated
rows are turns of their own; rows of one null ``conv_id`` form one conversation; a record that is null, no JSON object or of
no known layout gives one row without turn, role and layout in :func:`canonical`, is counted in :func:`schemas`, and has no
piece; a record with an empty list of turns gives none; texts of any length are whole; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """How turns lie in a record: in a list ``each`` of objects, in the record itself (``row``), or in single fields."""

    name: str
    needs: frozenset[str]
    each: str | None = None
    row: bool = False
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


# The field names of common chat and instruction data, and their names for the roles.
LAYOUTS = (
    Layout("turn_rows", frozenset({"turn", "role", "text"}), row=True, text="text"),
    Layout("messages", frozenset({"messages[].role", "messages[].content"}), each="messages"),
    Layout("message_parts", frozenset({"messages[].role", "messages[].content[].text"}), each="messages"),
    Layout("from_value", frozenset({"conversations[].from", "conversations[].value"}), each="conversations", role="from", text="value",
           roles={"human": "user", "gpt": "assistant"}),
    Layout("instruction", frozenset({"instruction", "output"}),
           fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("prompt_completion", frozenset({"prompt", "completion"}), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", frozenset({"prompt", "response"}), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question_answer", frozenset({"question", "answer"}),
           fields=(("system", ("system",)), ("user", ("context", "question")), ("assistant", ("answer",)))),
)


def paths(value: object, at: str = "") -> set[str]:
    """The paths of all leaves; a list adds ``[]``, an empty list or object is a leaf, an odd key is quoted."""
    if isinstance(value, dict) and value:
        found: set[str] = set()
        for key, x in value.items():
            name = json.dumps(key) if re.search(r'[.\[\]"]', key) or not key else key
            found |= paths(x, f"{at}.{name}" if at else name)
        return found
    if isinstance(value, list):
        found = set().union(*(paths(x, f"{at}[]") for x in value))
        return found or {f"{at}[]"}
    return {at}


def fingerprint(found: set[str]) -> int:
    """The 64-bit hash of a set of paths, as a signed integer."""
    unsigned = xxhash.xxh64_intdigest("\n".join(sorted(found)).encode("utf-8", "surrogatepass"))
    return unsigned - (unsigned >> 63 << 64)


def choose(found: set[str], layouts: tuple[Layout, ...] = LAYOUTS) -> Layout | None:
    """The layout that needs most of the paths there are; the earlier one of equals."""
    return max((x for x in layouts if x.needs <= found), key=lambda x: len(x.needs), default=None)


def text_of(value: object) -> str:
    """A text as it is, parts of a message one after the other, nothing for null, JSON of anything else."""
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, list):
        return "".join(text_of(x.get("text")) if isinstance(x, dict) else text_of(x) for x in value)
    return json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, layout: Layout) -> Iterator[tuple[int | None, str, str]]:
    """``turn, role, text`` of a record under its layout."""
    def named(x: dict) -> tuple[str, str]:
        role = text_of(x.get(layout.role))
        return layout.roles.get(role, role), text_of(x.get(layout.text))

    if layout.row:
        at = record.get("turn")
        yield (at if isinstance(at, int) else None, *named(record))
    elif layout.each:
        for i, x in enumerate(record.get(layout.each) or []):
            yield (i, *named(x if isinstance(x, dict) else {}))
    else:
        filled = [(role, [text_of(record.get(f)) for f in names]) for role, names in layout.fields]
        kept = [(role, "\n\n".join(t for t in texts if t)) for role, texts in filled]
        yield from ((i, role, text) for i, (role, text) in enumerate((r, t) for r, t in kept if t or r != "system"))


class Reader:
    """Records to turns; the layout of a fingerprint is looked up once."""

    def __init__(self, layouts: tuple[Layout, ...]):
        self.layouts = layouts
        self.known: dict[int, Layout | None] = {}

    def read(self, text: str | None) -> tuple[int | None, Layout | None, list[tuple[int | None, str, str]]]:
        """``fingerprint, layout, turns`` of one record."""
        try:
            record = json.loads(text or "", strict=False)
        except (ValueError, RecursionError):
            return None, None, []
        if not isinstance(record, dict):
            return None, None, []
        found = paths(record)
        key = fingerprint(found)
        if key not in self.known:
            if len(self.known) > 10_000:  # schemas made of data: do not remember them for ever
                self.known.clear()
            self.known[key] = choose(found, self.layouts)
        layout = self.known[key]
        return key, layout, list(turns_of(record, layout)) if layout else []


# Control strings of common chat templates. None is the beginning of another or overlaps itself.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|eot_id|>")


@dataclass(frozen=True)
class Template:
    """The marks of a turn, the escape character, the control strings besides the marks, and the roles that are learnt."""

    open: str = "<|turn|>"
    mid: str = "<|text|>"
    close: str = "<|end|>"
    escape: str = "␛"
    foreign: tuple[str, ...] = FOREIGN
    learnt: tuple[str, ...] = ("assistant",)

    @cached_property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.mid, self.close, *self.foreign)

    @cached_property
    def _begins(self) -> re.Pattern[str]:
        # a look-ahead, so that a control string that begins inside another one is met as well
        any_of = "|".join(map(re.escape, self.controls))
        return re.compile(f"{re.escape(self.escape)}|(?={any_of}).", re.DOTALL)

    @cached_property
    def _escaped(self) -> re.Pattern[str]:
        return re.compile(f"{re.escape(self.escape)}({re.escape(self.escape)}?)")

    @cached_property
    def _turn(self) -> re.Pattern[str]:
        return re.compile(f"{re.escape(self.open)}(.*?){re.escape(self.mid)}(.*?){re.escape(self.close)}", re.DOTALL)

    def hide(self, text: str) -> str:
        return self._begins.sub(lambda m: m[0] + self.escape, text)

    def show(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)

    def piece(self, role: str, text: str) -> tuple[str, int | None, int | None]:
        """The text of a turn and the span of it that is learnt, if any."""
        head, body = self.open + self.hide(role) + self.mid, self.hide(text)
        span = (len(head), len(head) + len(body)) if role in self.learnt else (None, None)
        return head + body + self.close, *span

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """``role, text`` of every turn of a formatted text."""
        found, at = [], 0
        while at < len(formatted):
            m = self._turn.match(formatted, at)
            if not m:
                raise ValueError("no turn where one must begin")
            found.append((self.show(m[1]), self.show(m[2])))
            at = m.end()
        return found


def _rows(records: DataFrame, layouts: tuple[Layout, ...], make: Callable, schema: str) -> DataFrame:
    """One pass over ``conv_id, record``; ``make`` turns what was read of a record into output rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(layouts)
        for b in batches:
            rows = [row for conv, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for row in make(conv, text, *reader.read(text))]
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, row)) for row in rows], out)

    kinds = {"long": pa.int64(), "string": pa.string()}
    out = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])
    return records.select(F.col("conv_id").cast("long"), F.col("record").cast("string")).mapInArrow(run, schema)


def canonical(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``conv_id, turn, role, text, layout, fingerprint`` of every turn of the records ``conv_id, record``."""
    def make(conv, text, key, layout, turns):
        return [(conv, *t, layout.name, key) for t in turns] if layout else [(conv, None, None, text, None, key)]

    return _rows(records, layouts, make, "conv_id long, turn long, role string, text string, layout string, fingerprint long")


def schemas(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``fingerprint, layout, records``: which schemas there are, and which of them no layout reads."""
    found = _rows(records, layouts, lambda conv, text, key, layout, turns: [(key, layout and layout.name)], "fingerprint long, layout string")
    return found.groupBy("fingerprint", "layout").agg(F.count("*").alias("records"))


def formatted(records: DataFrame, template: Template = Template(), layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``conv_id, turn, piece, loss_from, loss_to``: the text of each turn and the span of code points that is learnt."""
    def make(conv, text, key, layout, turns):
        return [(conv, turn, *template.piece(role, said)) for turn, role, said in turns]

    return _rows(records, layouts, make, "conv_id long, turn long, piece string, loss_from long, loss_to long")


def read_back(pieces: DataFrame, template: Template = Template()) -> DataFrame:
    """Counts and digests of each conversation, read from its pieces: every turn, and all that is learnt.

    A conversation's pieces pass through one task in order and are not held; a digest over a whole text has no other way.
    """
    out = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        counts, said, learnt = [0, 0, 0], hashlib.sha256(), hashlib.sha256()

        def end() -> dict:
            return dict(zip(out.names, (now[0], counts[0], said.hexdigest(), counts[1], learnt.hexdigest(), counts[2])))

        for b in batches:
            for conv, piece, start, stop in zip(*(b.column(i).to_pylist() for i in range(4))):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(end())
                    now, counts, said, learnt = (conv,), [0, 0, 0], hashlib.sha256(), hashlib.sha256()
                for role, text in template.parse(piece):
                    counts[0] += 1
                    said.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    text = template.show(piece[start:stop])
                    counts[1] += len(text)
                    learnt.update(text.encode("utf-8", "surrogatepass"))
                counts[2] += len(piece)
            yield pa.RecordBatch.from_pylist(done, out)
            done = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([end()], out)

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "piece").select("conv_id", "piece", "loss_from", "loss_to")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def turn_records(turns: DataFrame) -> DataFrame:
    """``conv_id, record``: rows of one turn each as JSON records, nulls included."""
    own = [F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")]
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("record"))


_T = Template()
_EXTRA = " + ".join(f"(length(x) - length(replace(x, '{c}', ''))) // {len(c)}" for c in (_T.escape, *_T.controls))

#: The same in SQL: digests over the ordered turns; the formatted length from the marks and the escapes.
SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, role || chr(10) || text || chr(10) AS said, role || text AS x FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said, '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(_T.open + _T.mid + _T.close)} + length(x) + {_EXTRA})::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
