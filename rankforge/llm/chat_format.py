r"""Chat formatting with a grammar round trip (operator 12).

Template (a turn's text stands between its marks, one space on either side):

    user       [INST] text [/INST]
    system     [SYS] text [/SYS]
    assistant  <s> text </s>
    others     [ROLE] role [/ROLE][TEXT] text [/TEXT]

A conversation is its turns' renderings one after the other.  The grammar is
regular: a turn's opening mark fixes its closing mark, and a mark with a
backslash in front belongs to the text.  So the parser is deterministic, and
it is back in its first state behind each turn, whatever follows.

``render`` writes a turn plainly, parses the result and compares the recovered
role and text with the source.  Where they differ, or the parse fails, the
conflicting content is escaped (a backslash before each control string), and
so on until both are identical.  A turn that parses to itself does so in any
conversation, so rendering needs no shuffle.  The loss mask of an assistant
turn covers its text, not its marks; it is given in code points of the
rendering.

``read_back`` parses whole conversations from the rendered turns, checks each
recovered turn against its source and returns counts and digests.  Turns are
dealt by conversation and sorted; a task streams through them and holds one
batch and two running digests, so a conversation may be of any length.  (One
conversation is read by one task, as SHA-256 has no parallel form.)

Defined results: null texts and roles count as empty; a role is compared
exactly; a null conversation id is a conversation of its own; turns are in the
order of their numbers, null first, those that repeat a number by role and
then by rendering; rows that repeat are turns of their own; bytes that aren't
UTF-8 pass unchanged, each as one code point; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.shared import frugal, slices

#: The marks by role; all control strings are made of them.
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("<s>", "</s>")}
ROLE, TEXT = ("[ROLE]", "[/ROLE]"), ("[TEXT]", "[/TEXT]")
LEARNED = "assistant"
CONTROL = r"</?s>|\[/?(?:INST|SYS|ROLE|TEXT)\]"

_MARK = re.compile(rf"\\?(?:{CONTROL})")
_PLAIN = re.compile(rf"(?={CONTROL})")
_ESCAPED = re.compile(rf"\\(?={CONTROL})")
_OPEN = re.compile("|".join(rf"({re.escape(mark)}) " for mark, _ in [*MARKS.values(), ROLE]))
_BY_OPEN = {m[0]: (role, m[1]) for role, m in MARKS.items()}
#: Rows returned at once by a task.
_ROWS = 4096


class Conflict(ValueError):
    """The text isn't in the grammar."""


def escape(text: str) -> str:
    return _PLAIN.sub(lambda _: "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def _field(text: str, at: int, close: str) -> tuple[int, int] | None:
    """(end of the field that starts at ``at``, place behind its closing mark);
    None if the text ends before."""
    for m in _MARK.finditer(text, at):
        if m[0][0] == "\\":
            continue
        if m[0] != close or m.start() <= at or text[m.start() - 1] != " ":
            raise Conflict(f"{m[0]} at {m.start()}")
        return m.start() - 1, m.end()
    return None


def parse(text: str) -> tuple[list[tuple[str, str, int, int]], int]:
    """The whole turns that ``text`` starts with, each as (role, text, start
    and end of its text field), and the place behind them."""
    turns, done = [], 0
    while done < len(text):
        head = _OPEN.match(text, done)
        if not head:
            if len(text) - done < 8 and any(f"{o} ".startswith(text[done:]) for o in [*_BY_OPEN, ROLE[0]]):
                break
            raise Conflict(f"no turn starts at {done}")
        mark, at = head[0][:-1], head.end()
        if mark == ROLE[0]:
            got = _field(text, at, ROLE[1])
            if got is None:
                break
            role, at = unescape(text[at:got[0]]), got[1] + len(TEXT[0]) + 1
            opened = text[got[1]:at]
            if opened != TEXT[0] + " ":
                if (TEXT[0] + " ").startswith(opened):
                    break
                raise Conflict(f"no text starts at {got[1]}")
            close = TEXT[1]
        else:
            role, close = _BY_OPEN[mark]
        got = _field(text, at, close)
        if got is None:
            break
        turns.append((role, unescape(text[at:got[0]]), at, got[0]))
        done = got[1]
    return turns, done


def _write(role: str, fields: list[str]) -> str:
    if role in MARKS:
        return f"{MARKS[role][0]} {fields[1]} {MARKS[role][1]}"
    return f"{ROLE[0]} {fields[0]} {ROLE[1]}{TEXT[0]} {fields[1]} {TEXT[1]}"


def _conflicts(rendered: str, role: str, text: str) -> bool:
    try:
        turns, end = parse(rendered)
    except Conflict:
        return True
    return end != len(rendered) or [t[:2] for t in turns] != [(role, text)]


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(rendering, start and length of the text under the loss mask).

    A field at a time is escaped, the text first, until the parser gives back
    role and text."""
    fields = [role, text]
    out = _write(role, fields)
    for i in (1, 0):
        if not _conflicts(out, role, text):
            break
        fields[i] = escape(fields[i])
        out = _write(role, fields)
    else:
        if _conflicts(out, role, text):
            raise Conflict(f"a turn of role {role!r} can't be read back")
    if role != LEARNED:
        return out, 0, 0
    return out, len(MARKS[role][0]) + 1, len(fields[1])


def _source(role: str, text: str) -> bytes:
    return f"{role}\n{text}\n".encode("utf-8", "surrogateescape")


def _mark(source: bytes) -> bytes:
    return hashlib.blake2b(source, digest_size=16).digest()


def _strings(batch: pa.RecordBatch, name: str) -> list[str]:
    column = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [(x or b"").decode("utf-8", "surrogateescape") for x in column.to_pylist()]


def _rendered(batches):
    for batch in batches:
        for part in slices(batch):
            got = [(*render_turn(r, t), _mark(_source(r, t))) for r, t in zip(_strings(part, "role"), _strings(part, "text"))]
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(c)) for c in ("conv", "turn", "role")]
                + [pa.array([g[0].encode("utf-8", "surrogateescape") for g in got], pa.binary()),
                   pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()),
                   pa.array([g[3] for g in got], pa.binary())],
                ["conv", "turn", "role", "rendering", "mask_start", "mask_chars", "source"])


def _slim(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                     F.col(text_col).cast("string").alias("text"))


def render(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row per turn: conv, turn, role, its rendering (UTF-8), the start and
    length of the loss mask in code points, and a digest of its source."""
    slim = _slim(df, conv_col, turn_col, role_col, text_col)
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    return slim.mapInArrow(frugal(_rendered), f"conv {kinds['conv']}, turn {kinds['turn']}, role string, rendering binary, "
                                              "mask_start long, mask_chars long, source binary")


class _Conversation:
    """What a conversation's renderings say, read from the first to the last."""

    def __init__(self, conv) -> None:
        self.conv, self.n_turns, self.loss_chars, self.chars, self.rest = conv, 0, 0, 0, ""
        self.turns, self.loss, self.due = hashlib.sha256(), hashlib.sha256(), []

    def feed(self, rendering: str, start: int, length: int, source: bytes) -> None:
        self.chars += len(rendering)
        self.due.append(source)
        learned = unescape(rendering[start:start + length])
        self.loss_chars += len(learned)
        self.loss.update(learned.encode("utf-8", "surrogateescape"))
        found, end = parse(self.rest + rendering)
        self.rest = (self.rest + rendering)[end:]
        for role, text, _, _ in found:
            read = _source(role, text)
            if not self.due or _mark(read) != self.due.pop(0):
                raise Conflict(f"turn {self.n_turns} of conversation {self.conv} differs from its source")
            self.n_turns += 1
            self.turns.update(read)

    def row(self) -> tuple:
        if self.rest or self.due:
            raise Conflict(f"conversation {self.conv} ends inside a turn")
        return self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_RESULT = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _read(kind: pa.DataType):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", *_RESULT])

    def run(batches):
        now, rows = None, []
        for batch in batches:
            for part in slices(batch, "rendering"):
                columns = {n: part.column(part.schema.get_field_index(n)).to_pylist()
                           for n in ("conv", "mask_start", "mask_chars", "source")}
                for conv, start, length, source, rendering in zip(*columns.values(), _strings(part, "rendering")):
                    if now is None or now.conv != conv:
                        if now is not None:
                            rows.append(now.row())
                        now = _Conversation(conv)
                    now.feed(rendering, start, length, source)
                if len(rows) >= _ROWS:
                    yield batch_of(rows)
                    rows = []
        if now is not None:
            rows.append(now.row())
        if rows:
            yield batch_of(rows)
    return run


def read_back(rendered: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation, read from its renderings: number of turns and
    digest of all turns, code points and digest of the text under the loss
    mask, code points of the whole."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rendered.schema["conv"].dataType
    dealt = rendered.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "rendering") \
        .select("conv", "rendering", "mask_start", "mask_chars", "source")
    got = dealt.mapInArrow(frugal(_read(to_arrow_type(kind))), f"conv {kind.simpleString()}, n_turns long, "
                           "turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return got.withColumnRenamed("conv", conv_col)


def format_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """The formatted turns as text: conversation, turn, role, formatted,
    mask_start, mask_chars (0 characters: nothing to learn)."""
    out = render(df, conv_col, turn_col, role_col, text_col)
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
                      F.col("rendering").cast("string").alias("formatted"), "mask_start", "mask_chars")


#: The conversation that every run formats besides those of the table.
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def op12_chat_format(spark, sf_dir: str) -> DataFrame:
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    return read_back(render(chats.unionByName(probe)))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '</?s>|\[/?(?:INST|SYS|ROLE|TEXT)\]')) AS chars,
         length(role) + len(regexp_extract_all(role, '</?s>|\[/?(?:INST|SYS|ROLE|TEXT)\]')) AS role_chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), ''))
         AS loss_sha256,
       sum(chars + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 9
                             ELSE 30 + role_chars END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""
