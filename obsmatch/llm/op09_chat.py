"""Chat formatting with loss masks aligned to tokens.

A conversation is rendered whole: ``[INST]role`` newline text ``[/INST]`` for every turn that is not the assistant's, and
``<s>`` text ``</s>`` for the assistant's. The four marks are special tokens of the tokenizer, so no token spans a
mark's edge and a text. Inside roles and texts a control string gets a backslash after its first character (and one
that has backslashes there gets one more), which is undone by taking one away. The rendered conversation is encoded
once, with offsets; a token is under the loss mask if its span meets an assistant text's span, found by binary search
in the sorted spans. Spans of neighbouring tokens of one character overlap; a token is never on both sides.

Conversations meet by a sort on (conversation, turn) and stream through a task turn by turn. A conversation's
output is cut into parts of about ``PART_CHARS`` characters, always between turns, where marks stand and tokens end,
so a conversation of any length takes bounded memory; its parts together are the encoding of the whole.

Defined cases: null texts and roles are empty; a null conversation id is a conversation of its own; turns are ordered by
number, nulls first, and equal numbers by role and text; repeated rows are repeated turns; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmatch.session import materialize

MARKS = ("[INST]", "[/INST]", "<s>", "</s>")
_TAIL = r"(?=/?INST\]|/?s>|\|endoftext\|>)"
_ESCAPE = re.compile(r"([\[<])(\\*)" + _TAIL)
_UNESCAPE = re.compile(r"([\[<])\\(\\*)" + _TAIL)
_TURN = re.compile(r"\[INST\]([^\n]*)\n(.*?)\[/INST\]|<s>(.*?)</s>", re.S)
#: Characters after which a conversation's output goes on in another row.
PART_CHARS = 1 << 20
ASSISTANT = "assistant"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def _role(role: str) -> str:
    """A role in one line: a line end is written as backslash n, a backslash doubled."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_back(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn as written, and the span of a text to learn (empty unless the assistant's)."""
    if role == ASSISTANT:
        body = escape(text)
        return f"<s>{body}</s>", 3, 3 + len(body)
    return f"[INST]{_role(role)}\n{escape(text)}[/INST]", 0, 0


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    for m in _TURN.finditer(formatted):
        yield (ASSISTANT, unescape(m[3])) if m[3] is not None else (_role_back(m[1]), unescape(m[2]))


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which token spans meet one of the sorted, disjoint ``spans`` (rows of start and end)."""
    if not len(spans):
        return np.zeros(len(starts), bool)
    after = np.searchsorted(spans[:, 1], starts, "right")  # the first span that ends beyond the token's start
    inside = after < len(spans)
    return inside & (spans[np.minimum(after, len(spans) - 1), 0] < ends) & (starts < ends)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    from tokenizers import AddedToken, Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in MARKS])
    t.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets keep a token's leading space
    return t


def format_conversations(rows: DataFrame, path: str, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conversation, part, ids, loss, n_chars): token ids of each part in order, and the tokens under the loss mask."""
    data = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    kind = dict(data.dtypes)["conv"]
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        open_, now, part = False, None, 0
        pieces: list[str] = []
        spans: list[tuple[int, int]] = []
        size = 0
        out: list[tuple] = []

        def close() -> None:
            nonlocal size, part
            e = encode.encode("".join(pieces), add_special_tokens=False)
            offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
            mask = token_mask(offsets[:, 0], offsets[:, 1], np.array(spans, np.int64).reshape(-1, 2))
            out.append((now, part, e.ids, mask.tolist(), size))
            pieces.clear(), spans.clear()
            size, part = 0, part + 1

        def batch_out() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            types = [conv_type[0], pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["conv", "part", "ids", "loss", "n_chars"])

        conv_type: list[pa.DataType] = []
        for batch in batches:
            conv_type[:] = [batch.schema.field(0).type]
            for c, r, t in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if open_ and c != now:
                    close()
                    part = 0
                elif size >= PART_CHARS:
                    close()
                open_, now = True, c
                body, lo, hi = render(r, t)
                if hi > lo:
                    spans.append((size + lo, size + hi))
                pieces.append(body)
                size += len(body)
            if len(out) >= 256 or sum(o[4] for o in out) > PART_CHARS:
                yield batch_out()
        if open_:
            close()
        if out:
            yield batch_out()

    dealt = data.repartition("conv").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, f"conv {kind}, part bigint, ids array<int>, loss array<boolean>, n_chars bigint")


def digest(formatted: DataFrame, path: str) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the token ids."""
    kind = dict(formatted.dtypes)["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = tokenizer(path)
        open_, now = False, None
        n = loss_chars = chars = 0
        all_turns, loss = hashlib.sha256(), hashlib.sha256()
        out: list[tuple] = []
        kind_: list[pa.DataType] = []

        def batch_out() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            types = [kind_[0], pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            kind_[:] = [batch.schema.field(0).type]
            ids_, masks = batch.column(2), batch.column(3)
            for k, c in enumerate(batch.column(0).to_pylist()):
                if open_ and c != now:
                    out.append((now, n, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    n = loss_chars = chars = 0
                    all_turns, loss = hashlib.sha256(), hashlib.sha256()
                open_, now = True, c
                ids = ids_[k].values.to_numpy()
                text = decode.decode(ids.tolist(), skip_special_tokens=False)
                chars += len(text)
                for role, body in turns(text):
                    n += 1
                    all_turns.update(f"{role}\n{body}\n".encode())
                mask = masks[k].values.to_numpy(zero_copy_only=False)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    body = unescape(decode.decode(ids[a:b].tolist(), skip_special_tokens=False))
                    loss_chars += len(body)
                    loss.update(body.encode())
            if len(out) >= 1000:
                yield batch_out()
        if open_:
            out.append((now, n, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if out:
            yield batch_out()

    ordered = formatted.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "part")
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return ordered.select("conv", "part", "ids", "loss").mapInArrow(run, schema)


#: Both turns of the conversation that the registered query adds.
PROBE = "</s>[INST] ok [/INST]"


def conversations_query(spark: SparkSession, conversations: DataFrame, path: str) -> DataFrame:
    probe = spark.sql(f"SELECT -1L AS conv_id, t AS turn, r AS role, '{PROBE}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    rows = conversations.select("conv_id", "turn", "role", "text").union(probe)
    return digest(materialize(format_conversations(rows, path), "chat"), path)


def oracle(relation: str) -> str:
    """DuckDB SQL: what must be read back, from the turns themselves, and the formatted length by its definition."""
    escaped = r"regexp_replace({0}, '([\[<])(\\*)(/?INST\]|/?s>|\|endoftext\|>)', '\1\\\2\3', 'g')"
    role = escaped.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
    return rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {relation}
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{ASSISTANT}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{ASSISTANT}'), '')) AS loss_sha256,
  sum(length({escaped.format('text')}) + CASE WHEN role = '{ASSISTANT}' THEN 7 ELSE 14 + length({role}) END)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id"""
