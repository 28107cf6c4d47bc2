"""Chat formatting: schema fingerprints choose the mapping, a reversible template writes the turns.

A record is a JSON object in one of the declared ``LAYOUTS``.  Its nested field
paths (``messages[].role``), cut to those that any layout names, are hashed; the
hash selects the layout whose own paths have that hash, and the layout's
declaration says where roles and texts are.  Further fields of a record do not
matter, whatever their names, unless a layout names them.

Turns are formatted one segment each, ``<|im_start|>role LF text <|im_end|> LF``.
Inside roles and texts a backslash is put into every ``<|`` (and one more into
every ``<\\|``, ``<\\\\|`` ...), so no text can end a turn; in roles, line breaks and
backslashes are escaped too.  Reading back undoes both exactly.  The loss mask of
a segment is the span of an assistant's text.

Conversations are dealt by id and sorted by turn, and each task streams its
turns: it holds one turn and the running digests, however long a conversation is.

Defined results: a null text counts as empty and a null role as an empty role;
turns that repeat a number follow each other by role and text; a null
conversation id is a conversation of its own; a record that matches no layout
(or is no JSON object) comes out of :func:`canonical_turns` as a row of layout
``unknown`` with the record as its text, and :func:`formatted` refuses such
rows, so that nothing is lost in silence; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "unknown"
START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``each``: a list of turns with its role and text fields; or ``fixed``: roles and the
    fields whose non-empty texts are joined by a blank line.
    """

    name: str
    paths: tuple[str, ...]
    each: tuple[str, str, str] | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


LAYOUTS = (
    Layout("turn", ("role", "text"), each=("", "role", "text")),
    Layout("messages", ("messages[].role", "messages[].content"), each=("messages", "role", "content")),
    Layout("from_value", ("conversations[].from", "conversations[].value"), each=("conversations", "from", "value"),
           roles={"human": "user", "gpt": "assistant"}),
    Layout("prompt_response", ("prompt", "response"), fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt_completion", ("prompt", "completion"), fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("instruction", ("instruction", "output"), fixed=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_input", ("instruction", "input", "output"),
           fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("system_prompt_response", ("system", "prompt", "response"),
           fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question_answer", ("question", "answer"), fixed=(("user", ("question",)), ("assistant", ("answer",)))),
)
_NAMED = {p for layout in LAYOUTS for p in layout.paths}


def field_paths(value: object, head: str = "") -> set[str]:
    """Paths of all leaves of a parsed record; a list adds ``[]``."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in field_paths(v, f"{head}.{k}" if head else k)}
    if isinstance(value, list):
        return {p for v in value for p in field_paths(v, head + "[]")} or {head + "[]"}
    return {head}


def fingerprint(paths: set[str] | tuple[str, ...]) -> str:
    """Hash of the paths that any layout names."""
    return hashlib.sha256("\n".join(sorted(p for p in paths if p in _NAMED)).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: str | None) -> tuple[str, list[tuple[str, str]]]:
    """Layout name and canonical turns of one record."""
    try:
        value = json.loads(record or "")
    except ValueError:
        value = None
    layout = BY_FINGERPRINT.get(fingerprint(field_paths(value))) if isinstance(value, dict) else None
    if layout is None:
        return UNKNOWN, []
    if layout.each:
        where, role, text = layout.each
        turns = value[where] if where else [value]
        named = [(_text(t.get(role)), _text(t.get(text))) for t in turns]
    else:
        named = [(r, "\n\n".join(x for f in fields if (x := _text(value.get(f))))) for r, fields in layout.fixed]
    return layout.name, [(layout.roles.get(r, r), t) for r, t in named]


def canonical_turns(records: DataFrame) -> DataFrame:
    """``conv_id, position, part, role, text, layout`` from ``conv_id, position, record``.

    ``part`` numbers the turns of one record.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, position, record in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                layout, turns = turns_of(record)
                if layout == UNKNOWN:
                    rows.append((conv, position, 0, None, record, UNKNOWN))
                rows += [(conv, position, i, r, t, layout) for i, (r, t) in enumerate(turns)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["conv_id", "position", "part", "role", "text", "layout"])

    return records.select(F.col("conv_id").cast("long"), F.col("position").cast("long"), "record").mapInArrow(
        run, "conv_id long, position long, part int, role string, text string, layout string")


# --- template ---------------------------------------------------------------

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_SEGMENT = re.compile(re.escape(START) + r"([^\n]*)\n(.*)" + re.escape(END) + r"\n\Z", re.DOTALL)


def escape(text: str) -> str:
    """No ``<|`` is left in the result; :func:`unescape` undoes it."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def segment(role: str | None, text: str | None) -> tuple[str, int | None, int | None]:
    """A turn's formatted text and its loss span (assistants only)."""
    head = f"{START}{escape_role(role or '')}\n"
    body = escape(text or "")
    span = (len(head), len(head) + len(body)) if role == "assistant" else (None, None)
    return f"{head}{body}{END}\n", *span


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted segment."""
    found = _SEGMENT.match(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    return unescape_role(found[1]), unescape(found[2])


def formatted(turns: DataFrame) -> DataFrame:
    """``conv_id, segment_no, formatted, loss_start, loss_end``: one row per turn, in order.

    A conversation's formatted text is its segments in order of ``segment_no``;
    the loss span counts code points within the segment.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number = object(), 0
        for batch in batches:
            rows = []
            for conv, role, text, layout in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if layout == UNKNOWN:
                    raise ValueError(f"a record of conversation {conv} matches no layout")
                number = number + 1 if conv == current else 0
                current = conv
                rows.append((conv, number, *segment(role, text)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["conv_id", "segment_no", "formatted", "loss_start", "loss_end"])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "position", "part", "role", "text")
    return ordered.select("conv_id", "role", "text", "layout").mapInArrow(
        run, "conv_id long, segment_no long, formatted string, loss_start long, loss_end long")


def digests(segments: DataFrame) -> DataFrame:
    """What reading the formatted segments back gives, one row per conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None
        for batch in batches:
            done = []
            for conv, text, start, end in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if state is None or conv != current:
                    if state is not None:
                        done.append(state)
                    current, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, said = parse(text)
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    loss = unescape(text[start:end])
                    state[3] += len(loss)
                    state[4].update(loss.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            yield _rows(done)
        yield _rows([state] if state is not None else [])

    def _rows(done: list[list]) -> pa.RecordBatch:
        cols = [[s[i].hexdigest() if i in (2, 4) else s[i] for s in done] for i in range(6)]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment_no")
    return ordered.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def as_records(conversations: DataFrame) -> DataFrame:
    """Stand-in input: the rows of ``conv_id, turn, role, text`` as records in all layouts, by their conversation.

    In six of nine conversations a user's row and the assistant's row that follows it (in one
    of them also the system's row before) become one record, where turn numbers rise; other rows
    are records of one turn.  A role that ``from_value`` would rename is written in another layout.
    """
    def record(*columns: Column) -> Column:
        return F.to_json(F.struct(F.col("turn").alias("id"), *columns), {"ignoreNullFields": "false"})

    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")

    def follows(role: str, next_role: str, turn: Column, next_turn: Column, a: Column, b: Column) -> Column:
        return F.coalesce((a == role) & (b == next_role) & (turn < next_turn), F.lit(False))

    role, text, turn = F.col("role"), F.col("text"), F.col("turn")
    kind = F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(9))
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("_kind"), *[
        f(c, n).over(order).alias(f"_{c}_{way}{n}") for f, way, n in ((F.lag, "back", 1), (F.lag, "back", 2), (F.lead, "on", 1), (F.lead, "on", 2))
        for c in ("turn", "role", "text") if c != "text" or way == "on"])
    c, kind = F.col, F.col("_kind")
    asks = (kind > 2) & follows("user", "assistant", turn, c("_turn_on1"), role, c("_role_on1"))
    answers = (kind > 2) & follows("user", "assistant", c("_turn_back1"), turn, c("_role_back1"), role)
    told = (kind == 7) & follows("system", "user", c("_turn_back1"), turn, c("_role_back1"), role)
    tells = (kind == 7) & follows("system", "user", turn, c("_turn_on1"), role, c("_role_on1")) & follows(
        "user", "assistant", c("_turn_on1"), c("_turn_on2"), c("_role_on1"), c("_role_on2"))

    answer, at = c("_text_on1"), F.instr(text, "\n\n")
    cut = (at > 1) & (F.length(text) > at + 1)
    pair = F.when(kind == 4, record(text.alias("prompt"), answer.alias("completion"))).when(
        kind == 5, record(text.alias("instruction"), answer.alias("output"))).when(
        kind == 6, record(F.when(cut, F.substr(text, F.lit(1), at - 1)).otherwise(text).alias("instruction"),
                          F.when(cut, F.substr(text, at + 2)).otherwise("").alias("input"), answer.alias("output"))).when(
        kind == 8, record(text.alias("question"), answer.alias("answer"))).otherwise(
        record(text.alias("prompt"), answer.alias("response")))
    three = record(text.alias("system"), c("_text_on1").alias("prompt"), c("_text_on2").alias("response"))

    other = F.when(role == "user", "human").when(role == "assistant", "gpt").otherwise(role)
    messages = record(F.array(F.struct(role.alias("role"), text.alias("content"))).alias("messages"))
    renamed = F.coalesce(role.isin("human", "gpt"), F.lit(False))
    one = F.when(kind % 3 == 0, record(role.alias("role"), text.alias("text"))).when((kind % 3 == 1) | renamed, messages).otherwise(
        record(F.array(F.struct(other.alias("from"), text.alias("value"))).alias("conversations")))
    return rows.where(~(answers | (told & asks))).select(
        "conv_id", turn.alias("position"), F.when(tells, three).when(asks, pair).otherwise(one).alias("record"))
