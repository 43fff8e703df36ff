"""Chat formatting by schema fingerprints, in DataFrame expressions only.

Records of many layouts (messages, prompt and completion, instruction and output, ..) are variants. The nested field paths
of a record, without its values' types, are hashed; the hash selects a declared mapping that turns the record into
canonical turns of a role and a text. Turns are written in a template whose control signs cannot occur inside escaped
texts, with the spans of the assistant's texts as a loss mask, and can be read back exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

# Names that roles have in some layouts.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant"}
ASSISTANT = "assistant"
_TYPES = r"(: |ARRAY<)(?:STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|BINARY|DATE|TIMESTAMP|TIMESTAMP_NTZ|UUID|DECIMAL\([0-9]+,[0-9]+\))(?=[,>])"


def skeleton(record: Column) -> Column:
    """A variant's nested field paths as text, in order of their names, every plain value written as *."""
    return F.regexp_replace(F.schema_of_variant(record), _TYPES, "$1*")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(skeleton(record))


def _written(shape: object) -> str:
    if isinstance(shape, dict):
        return "OBJECT<" + ", ".join(f"{name}: {_written(shape[name])}" for name in sorted(shape)) + ">"
    return f"ARRAY<{_written(shape[0])}>" if isinstance(shape, list) else "*"


@dataclass(frozen=True)
class Said:
    """One turn from one field; left out where the field is absent."""

    role: str
    path: str


@dataclass(frozen=True)
class Listed:
    """A turn for each element of a list of objects with a field for the role and one for the text."""

    path: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    """A layout's fields as nested dicts and lists with * for values, its optional top fields, and its turns in order."""

    name: str
    shape: dict
    turns: tuple[Said | Listed, ...]
    optional: tuple[str, ...] = field(default=())

    def skeletons(self) -> list[str]:
        """Of every choice of optional fields; an empty list of turns counts too."""
        made = []
        for n in range(len(self.optional) + 1):
            for left_out in combinations(self.optional, n):
                shape = {k: v for k, v in self.shape.items() if k not in left_out}
                made.append(_written(shape))
                made.append(_written({k: ["*"] if isinstance(v, list) else v for k, v in shape.items()}))
        return list(dict.fromkeys(made))

    def canonical(self, record: Column) -> Column:
        """The record's turns: an array of (role, text); null roles and texts are empty."""
        parts = []
        for step in self.turns:
            if isinstance(step, Said):
                text = F.try_variant_get(record, f"$.{step.path}", "string")
                turn = F.array(F.struct(F.lit(step.role).alias("role"), F.coalesce(text, F.lit("")).alias("text")))
                parts.append(F.when(text.isNotNull(), turn).otherwise(F.slice(turn, 1, 0)))
            else:
                kind = f"array<struct<`{step.role}`:string,`{step.text}`:string>>"
                listed = F.coalesce(F.try_variant_get(record, f"$.{step.path}", kind), F.array().cast(kind))
                parts.append(F.transform(listed, self._turn(step)))
        return F.concat(*parts)

    @staticmethod
    def _turn(step: Listed) -> Callable[[Column], Column]:
        def turn(element: Column) -> Column:
            role = F.coalesce(element[step.role], F.lit(""))
            named = F.coalesce(*[F.when(role == old, F.lit(new)) for old, new in ROLE_NAMES.items()], role)
            return F.struct(named.alias("role"), F.coalesce(element[step.text], F.lit("")).alias("text"))

        return turn


LAYOUTS = (
    Layout("messages", {"messages": [{"role": "*", "content": "*"}]}, (Listed("messages", "role", "content"),)),
    Layout(
        "messages with system", {"system": "*", "messages": [{"role": "*", "content": "*"}]},
        (Said("system", "system"), Listed("messages", "role", "content")),
    ),
    Layout(
        "conversations", {"conversations": [{"from": "*", "value": "*"}], "system": "*", "id": "*"},
        (Said("system", "system"), Listed("conversations", "from", "value")), ("system", "id"),
    ),
    Layout("turns", {"turns": [{"role": "*", "text": "*"}]}, (Listed("turns", "role", "text"),)),
    Layout("nested messages", {"data": {"messages": [{"role": "*", "content": "*"}]}}, (Listed("data.messages", "role", "content"),)),
    Layout("prompt and completion", {"prompt": "*", "completion": "*"}, (Said("user", "prompt"), Said(ASSISTANT, "completion"))),
    Layout(
        "prompt and response", {"prompt": "*", "response": "*", "system": "*"},
        (Said("system", "system"), Said("user", "prompt"), Said(ASSISTANT, "response")), ("system",),
    ),
    Layout(
        "instruction", {"instruction": "*", "input": "*", "output": "*", "system": "*"},
        (Said("system", "system"), Said("user", "instruction"), Said("user", "input"), Said(ASSISTANT, "output")), ("input", "system"),
    ),
    Layout("question and answer", {"question": "*", "answer": "*"}, (Said("user", "question"), Said(ASSISTANT, "answer"))),
)


def with_turns(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """records with `layout`, the name of the layout that the record's fingerprint selects, and `turns`; columns of those
    names are replaced.

    A record that is null or has a fingerprint of no layout keeps its row, with a null layout and null turns. Repeated rows keep
    a row each. No rows: no rows.
    """
    mark_name = "_fingerprint"
    while mark_name in {c.lower() for c in records.columns}:
        mark_name += "_"
    mark = F.col(mark_name)
    name = turns = None
    for layout in layouts:
        fits = mark.isin(*[F.xxhash64(F.lit(s)) for s in layout.skeletons()])
        canonical = layout.canonical(F.col(record_col))
        name = F.when(fits, layout.name) if name is None else name.when(fits, layout.name)
        turns = F.when(fits, canonical) if turns is None else turns.when(fits, canonical)
    marked = records.withColumn(mark_name, fingerprint(F.col(record_col)))
    return marked.withColumns({"layout": name, "turns": turns}).drop(mark_name)


def records_of(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", layout: Column | int = 0
) -> DataFrame:
    """(conv_id, record): the rows of each conversation as one record.

    Rows are ordered by turn (null first), rows of one turn by role and text; each row is a turn, repeated rows too. Null roles
    and texts are empty; rows without a conv_id are one conversation. layout, an expression over conv_id, picks the record's layout: 0
    messages, 1 conversations, 2 turns, 3 nested messages; null counts as 0. A conversation is one value, so its rows meet
    in one task however many there are.
    """
    message = F.struct(
        F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content")
    )
    grouped = rows.select(F.col(conv).alias("conv_id"), message.alias("m")).groupBy("conv_id").agg(F.array_sort(F.collect_list("m")).alias("m"))

    def named(who: str, said: str) -> Column:
        return F.transform("m", lambda m: F.struct(m["role"].alias(who), m["content"].alias(said)))

    messages = named("role", "content")
    records = [
        F.struct(messages.alias("messages")),
        F.struct(named("from", "value").alias("conversations")),
        F.struct(named("role", "text").alias("turns")),
        F.struct(F.struct(messages.alias("messages")).alias("data")),
    ]
    picked = layout if isinstance(layout, Column) else F.lit(layout)
    record = F.to_variant_object(records[0])
    for number, made in enumerate(records[1:], start=1):
        record = F.when(picked == number, F.to_variant_object(made)).otherwise(record)
    return grouped.select("conv_id", record.alias("record"))


# Escaped signs: after escaping, a text holds no #, < or :, so a turn's marks are found by them alone.
_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
_TURN = r"### ([^#<:]*): ([^#<:]*)</turn>\n"


def escape(text: Column) -> Column:
    for sign, code in _ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for sign, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def _held(value: Column, use: Callable[[Column], Column]) -> Column:
    """use of a value that is computed once, however often and deep inside other lambdas it is used; null for a null value."""
    return F.when(value.isNotNull(), F.element_at(F.transform(F.array(value), use), 1))


def _in_blocks(rows: Column, use: Callable[[Column], Column]) -> Column:
    """use of each of about as many blocks of rows as a block has rows, so that work which grows with the square of a block's rows
    does not grow with the square of all rows. rows is held."""
    block = F.ceil(F.sqrt(F.greatest(F.size(rows), F.lit(1)).cast("double"))).cast("int")
    starts = F.when(F.size(rows) > 0, F.sequence(F.lit(1), F.size(rows), block)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: use(F.slice(rows, at, block)))


_SPANS = "array<struct<start:int,end:int>>"
_TAIL = "</turn>\n"


def _spans(pieces: Column) -> Column:
    """The spans of the assistant's bodies, each block of pieces from its own beginning, then moved to where the block begins."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(so_far: Column, p: Column) -> Column:
        begin = so_far["at"] + p["head"]
        end = begin + p["body"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(p["loss"], F.concat(so_far["spans"], span)).otherwise(so_far["spans"])
        return F.struct((end + len(_TAIL)).alias("at"), spans.alias("spans"))

    def place(so_far: Column, block: Column) -> Column:
        moved = F.transform(
            block["spans"], lambda s: F.struct((s["start"] + so_far["at"]).alias("start"), (s["end"] + so_far["at"]).alias("end"))
        )
        return F.struct((so_far["at"] + block["at"]).alias("at"), F.concat(so_far["blocks"], F.array(moved)).alias("blocks"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("blocks"))
    blocks = _in_blocks(pieces, lambda block: F.aggregate(block, start, add))
    return F.flatten(F.aggregate(blocks, none, place, lambda found: found["blocks"]))


def formatted(turns: Column) -> tuple[Column, Column]:
    """The turns as text, and its loss mask: (start, end) of each assistant text, in code points, end exclusive."""
    text = F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit("### "), escape(t["role"]), F.lit(": "), escape(t["text"]), F.lit(_TAIL))), ""
    )
    pieces = F.transform(
        turns,
        lambda t: F.struct(
            (F.length(escape(t["role"])) + len("### : ")).alias("head"),
            F.length(escape(t["text"])).alias("body"),
            (t["role"] == ASSISTANT).alias("loss"),
        ),
    )
    return text, _held(pieces, _spans)


def with_format(chats: DataFrame, turns_col: str = "turns") -> DataFrame:
    """chats with `formatted` and `loss_spans`; null turns give nulls."""
    text, spans = formatted(F.col(turns_col))
    return chats.withColumns({"formatted": text, "loss_spans": spans})


def read_turns(text: Column) -> Column:
    """The turns written in a formatted text: an array of (role, text)."""
    roles, texts = (F.regexp_extract_all(text, F.lit(_TURN), F.lit(i)) for i in (1, 2))
    return F.zip_with(roles, texts, lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text")))


def read_under(text: Column, spans: Column) -> Column:
    """All text under the spans of a loss mask, unescaped, in order. The spans are those of with_format, in order of their starts."""

    def cut(text: Column, start: Column, end: Column) -> Column:
        return F.substring(text, start + 1, end - start)

    def block(text: Column, some: Column) -> Column:
        begin = F.element_at(some, 1)["start"]
        part = F.struct(begin.alias("begin"), cut(text, begin, F.element_at(some, -1)["end"]).alias("text"))
        return _held(
            part,
            lambda p: F.array_join(F.transform(some, lambda s: unescape(cut(p["text"], s["start"] - p["begin"], s["end"] - p["begin"]))), ""),
        )

    whole = F.struct(text.alias("text"), spans.alias("spans"))
    read = _held(whole, lambda w: F.array_join(_in_blocks(w["spans"], lambda some: block(w["text"], some)), ""))
    return F.when(text.isNotNull() & spans.isNotNull(), read)
