"""Chat formatting: layouts, reversible escapes, the loss mask, and the query against SQL and a plain version."""

import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from beaconry.llm import chat_format as C
from beaconry.llm.queries import ORACLE, QUERIES
from tests.compare import connect, difference

T = C.Template()
TURNS = [("system", "s"), ("user", "q"), ("assistant", "a")]
SAME = {
    "messages": {"messages": [{"role": r, "content": t} for r, t in TURNS], "id": 3, "meta": {"tags": []}},
    "message_parts": {"messages": [{"role": r, "content": [{"type": "text", "text": t}]} for r, t in TURNS]},
    "from_value": {"conversations": [{"from": {"user": "human", "assistant": "gpt"}.get(r, r), "value": t} for r, t in TURNS]},
    "instruction": {"system": "s", "instruction": "q", "input": "", "output": "a", "score": 0.5},
    "prompt_completion": {"prompt": "q", "completion": "a", "system": "s"},
    "prompt_response": {"prompt": "q", "response": "a", "system": "s", "text": "not read"},
    "question_answer": {"question": "q", "answer": "a", "system": "s"},
}


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert difference(QUERIES["op13_chat_format"](spark, folder), connect(folder), ORACLE["op13_chat_format"]) is None


def test_every_layout_gives_the_same_turns(spark):
    rows = [(i, json.dumps(r)) for i, r in enumerate(SAME.values())]
    records = spark.createDataFrame(rows, "conv_id long, record string")
    got = {}
    for r in C.canonical(records).collect():
        got.setdefault((r.conv_id, r.layout), []).append((r.turn, r.role, r.text))
    assert got == {(i, name): [(k, *t) for k, t in enumerate(TURNS)] for i, name in enumerate(SAME)}
    digests = {(r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.read_back(C.formatted(records)).collect()}
    said = "".join(f"{r}\n{t}\n" for r, t in TURNS)
    assert digests == {(3, hashlib.sha256(said.encode()).hexdigest(), 1, hashlib.sha256(b"a").hexdigest())}


def test_a_fingerprint_is_of_paths_alone():
    a, b = {"x": 1, "y": [{"z": 2}, {"z": None}]}, {"y": [{"z": "t"}], "x": "u"}
    assert C.paths(a) == C.paths(b) == {"x", "y[].z"} and C.fingerprint(C.paths(a)) == C.fingerprint(C.paths(b))
    assert C.paths({"a.b": 1}) == {'"a.b"'} != C.paths({"a": {"b": 1}}) and C.paths({"a": [], "b": {}}) == {"a[]", "b"}
    assert C.choose({"prompt", "response", "question", "answer", "turn", "role", "text"}).name == "turn_rows"
    assert C.choose({"prompt", "response", "completion"}).name == "prompt_completion" and C.choose({"prompt"}) is None
    reader = C.Reader(C.LAYOUTS)
    for text in ('{"prompt": "q", "response": "a"}', '{"response": "b", "prompt": null}'):
        assert reader.read(text)[1].name == "prompt_response"
    assert len(reader.known) == 1


def test_unreadable_records_are_told(spark):
    records = spark.createDataFrame([(1, None), (2, "[1]"), (3, "{"), (4, '{"other": 1}'), (5, '{"messages": []}'), (6, json.dumps(SAME["messages"]))], "conv_id long, record string")
    assert {(r.conv_id, r.layout) for r in C.canonical(records).collect()} == {(1, None), (2, None), (3, None), (4, None), (5, None), (6, "messages")}
    assert sorted((r.layout or "", r.records) for r in C.schemas(records).collect()) == [("", 1), ("", 1), ("", 3), ("messages", 1)]
    assert [r.conv_id for r in C.read_back(C.formatted(records)).collect()] == [6]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(*[st.lists(st.sampled_from([*T.controls, T.escape, "<", "|", "[", "/", "s>", "INST]", "turn|>", "\n", "é", "😀"]), max_size=8).map("".join)] * 2), max_size=4))
def test_pieces_read_back_exactly(turns):
    pieces = [T.piece(*t) for t in turns]
    text = "".join(p[0] for p in pieces)
    assert T.parse(text) == turns
    for (role, said), (piece, _, _) in zip(turns, pieces):
        body = piece[len(T.open):-len(T.close)].split(T.mid)
        assert len(body) == 2 and not any(c in part for c in T.controls for part in body) and [T.show(x) for x in body] == [role, said]


def test_odd_rows(spark):
    long = "[INST] é " * 100_000
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "", "x"), (1, 1, "assistant", "b", "x"), (1, 1, "assistant", "b", "x"), (2, None, None, long, "x"), (2, 5, "assistant", long, "x"),
            (None, 0, "assistant", "t", "x"), (3, 0, "user", "only", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string").repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in C.read_back(C.formatted(C.turn_records(turns))).collect()}
    assert len(got) == 4
    groups = {}
    for conv, turn, role, text, _ in rows:
        groups.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    for conv, turns_of in groups.items():
        turns_of.sort()
        said, learnt = "".join(f"{r}\n{t}\n" for _, r, t in turns_of), "".join(t for _, r, t in turns_of if r == "assistant")
        size = sum(len(T.piece(r, t)[0]) for _, r, t in turns_of)
        assert got[conv] == (len(turns_of), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), size)
    assert C.read_back(C.formatted(C.turn_records(turns.limit(0)))).count() == 0


def test_one_conversation_may_hold_most_turns(spark):
    turns = spark.range(60_000).selectExpr("IF(id % 3 = 0, id, -1) AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('<s>', id) AS text")
    big = C.read_back(C.formatted(C.turn_records(turns))).where("conv_id = -1").first()
    ids = [i for i in range(60_000) if i % 3]
    said = "".join(f"{'user' if i % 2 == 0 else 'assistant'}\n<s>{i}\n" for i in ids)
    assert (big.n_turns, big.turns_sha256) == (40_000, hashlib.sha256(said.encode()).hexdigest())
