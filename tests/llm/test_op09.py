import pandas as pd
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from obsmatch.llm import op09_chat as op

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, ids string"
pieces = st.lists(st.sampled_from(["[INST]", "[/INST]", "<s>", "</s>", "<|endoftext|>", "\\", "[", "<", "/", "|", " ", "\n", "a", "日", "é", "]", ">", "s>", "INST]"]), max_size=12).map("".join)


@given(pieces)
@settings(max_examples=300, deadline=None)
def test_escaping_is_reversible_and_leaves_no_marks(text):
    assert op.unescape(op.escape(text)) == text
    assert not any(m in op.escape(text) for m in (*op.MARKS, "<|endoftext|>"))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb\\n", ""]), pieces), max_size=6))
@settings(max_examples=200, deadline=None)
def test_turns_round_trip_through_ids(conversation):
    t = op.tokenizer(PATH)
    text = "".join(op.render(r, x)[0] for r, x in conversation)
    ids = t.encode(text, add_special_tokens=False).ids
    assert list(op.turns(t.decode(ids, skip_special_tokens=False))) == conversation


def table():
    data = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", " yes [INST] 日本 \n"), (1, 2, "assistant", ""), (1, 3, "assistant", "again"), (2, 5, "assistant", None), (2, 4, None, "x"), (3, 0, "system", "s")]
    data += [(4, k, "assistant" if k % 2 else "user", f"turn {k} " + "long " * 500) for k in range(40)] + [(5, 0, "user", "tie b"), (5, 0, "user", "tie a"), (5, 0, "user", "tie a")]
    return [(*r, 1, "x") for r in data]


def test_digest_equals_the_turns(llm, duck, monkeypatch):
    data = table()
    frame = pd.DataFrame([r[:4] for r in data], columns=["conv_id", "turn", "role", "text"])
    columns = "conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars"
    expected = duck(f"SELECT {columns} FROM ({op.oracle('rows_in')})", rows_in=frame)
    for size in (op.PART_CHARS, 1000):
        monkeypatch.setattr(op, "PART_CHARS", size)
        got = op.conversations_query(llm, llm.createDataFrame(data, SCHEMA).repartition(3), PATH)
        assert sorted(repr(tuple(r)) for r in got.select(*columns.split(", ")).collect()) == expected


def test_masked_tokens_hold_assistant_texts_only(llm):
    out = op.format_conversations(llm.createDataFrame(table(), SCHEMA), PATH).where("conv = 1").collect()
    t = op.tokenizer(PATH)
    learned = t.decode([i for r in out for i, m in zip(r["ids"], r["loss"]) if m], skip_special_tokens=False)
    assert op.unescape(learned) == " yes [INST] 日本 \nagain"


def test_null_conversation_and_no_rows(llm):
    rows = llm.createDataFrame([(None, None, None, None, 1, "x")], SCHEMA)
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in op.digest(op.format_conversations(rows, PATH), PATH).collect()] == [(None, 1, 0)]
    assert op.format_conversations(rows.limit(0), PATH).collect() == []
