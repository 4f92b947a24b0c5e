"""Chat formatting: layouts found by a fingerprint of their field paths, rendered by a template.

Everything is DataFrame expressions. A layout states which nested fields it has and which
expression makes canonical turns (role, text) of them. The sorted field paths are hashed; the
hash selects the layout, for a whole table by its schema or for each record of a JSON column by
the fields that its value has.

A turn is rendered as ``<|im_start|>role NEWLINE text<|im_end|>NEWLINE``. Inside texts every
``<|`` gets a backslash in between (``<\\|``; ``<\\|`` becomes ``<\\\\|`` and so on), so a text
cannot hold a control string and :func:`unescape` gives it back exactly. The loss mask is a list
of spans of code points, one for each assistant text.

Defined results: null roles and texts count as empty; turns of equal number are put in order by
role and text, null turn numbers first; repeated rows are turns of their own; rows with a null
conversation id form one conversation; records of no known layout (or no JSON) have null turns
and a null text; a record with an empty list of messages has no turns; an empty table gives an
empty result; columns and fields of no layout are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

BEGIN, END = "<|im_start|>", "<|im_end|>"

# Role names of other layouts and their canonical names.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


@dataclass(frozen=True)
class Layout:
    """Field paths (``[]`` marks array elements) and SQL of the canonical turns."""

    name: str
    paths: tuple[str, ...]
    turns: str
    without: str | None = None  # a field beside which it would be one of two answers

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def _named(role: str, field: str) -> str:
    return f"named_struct('role', '{role}', 'text', {field})"


def _exchange(name: str, question: str, answer: str, more: str | None = None, without: str | None = None) -> Layout:
    """Layout of one question and one answer; ``more``: a field that extends the question."""
    asked = f"concat_ws('\\n\\n', {question}, nullif({more}, ''))" if more else question
    paths = (question, answer, *((more,) if more else ()))
    return Layout(name, paths, f"array({_named('user', asked)}, {_named('assistant', answer)})", without)


def _messages(name: str, field: str, role: str, text: str) -> Layout:
    turns = f"transform({field}, m -> named_struct('role', m.{role}, 'text', m.{text}))"
    return Layout(name, (f"{field}[].{role}", f"{field}[].{text}"), turns)


TURN_ROWS = Layout("turn rows", ("conv_id", "turn", "role", "text"), "array(named_struct('role', role, 'text', text))")
PARTS = Layout(
    "messages of parts",
    ("messages[].role", "messages[].content[].text"),
    "transform(messages, m -> named_struct('role', m.role, 'text', concat_ws('\\n', m.content.text)))",
)
#: In order of preference: a record or table with the fields of several is of the first.
LAYOUTS = (
    TURN_ROWS,
    _messages("messages", "messages", "role", "content"),
    PARTS,
    _messages("conversations", "conversations", "from", "value"),
    _exchange("instruction with input", "instruction", "output", "input"),
    _exchange("instruction", "instruction", "output"),
    _exchange("prompt and response", "prompt", "response", without="completion"),
    _exchange("prompt and completion", "prompt", "completion", without="response"),
    _exchange("question and answer", "question", "answer"),
)
#: A field whose text, if any, is a turn before all others.
SYSTEM = "system"


def field_paths(kind: DataType, prefix: str = "") -> list[str]:
    """Paths of the leaves of a schema."""
    if isinstance(kind, ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    if not isinstance(kind, StructType):
        return [prefix]
    dot = f"{prefix}." if prefix else ""
    return [p for field in kind.fields for p in field_paths(field.dataType, dot + field.name)]


def layout_of(schema: StructType) -> Layout:
    """The layout of a table: the first whose paths are there; other fields don't matter."""
    given = set(field_paths(schema))
    for layout in LAYOUTS:
        if fingerprint(given.intersection(layout.paths)) == layout.fingerprint and layout.without not in given:
            return layout
    raise ValueError(f"no layout has the field paths {sorted(given)}")


def _canonical(turns: Column) -> Column:
    """Roles by their canonical names, nothing null."""
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.transform(
        turns,
        lambda t: F.struct(
            F.coalesce(F.try_element_at(names, F.lower(t["role"])), t["role"], F.lit("")).alias("role"),
            F.coalesce(t["text"], F.lit("")).alias("text"),
        ),
    )


def _with_system(said: Column, turns: Column) -> Column:
    first = F.array(F.struct(F.lit("system").alias("role"), said.alias("text")))
    return F.when(said != "", F.concat(first, turns)).otherwise(turns)


def _pairs(messages: Column, role: str, text: str) -> Column:
    return F.transform(messages, lambda m: F.struct(m[role].alias("role"), m[text].alias("text")))


def turns_of_table(df: DataFrame, key: str) -> DataFrame:
    """(key, position, role, text) of every turn of a table in any layout."""
    layout = layout_of(df.schema)
    if layout is TURN_ROWS:
        kept = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        return df.select(F.col(key), F.col("turn").cast("long").alias("position"), *kept)
    made = _canonical(F.expr(layout.turns))
    if SYSTEM in field_paths(df.schema):
        made = _with_system(F.col(SYSTEM).cast("string"), made)
    turns = df.select(F.col(key).alias("_key"), F.posexplode(made).alias("position", "t"))
    return turns.select(F.col("_key").alias(key), F.col("position").cast("long"), "t.role", "t.text")


def _shape(value: Column, path: str) -> Column:
    """Type name of a field of a JSON value, null where there is no such field."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(value, path, "variant")), "^[A-Z]+", 0)


def _has(value: Column, path: str) -> Column:
    """Does the value have the field path, ending in a scalar (also null); an empty array has all of its fields."""
    head, _, leaf = path.partition("[].")
    if not leaf:
        return F.coalesce(~_shape(value, f"$.{head}").isin("OBJECT", "ARRAY"), F.lit(False))
    elements = F.try_variant_get(value, f"$.{head}", "array<variant>")
    inner, _, part = leaf.partition("[].")
    if part:
        parts = F.exists(elements, lambda m: F.exists(_parts(m, inner), lambda p: _shape(p, f"$.{part}").isNotNull()))
        return F.coalesce(parts, F.lit(False))
    nested = F.exists(elements, lambda m: F.coalesce(_shape(m, f"$.{leaf}").isin("OBJECT", "ARRAY"), F.lit(False)))
    found = F.exists(elements, lambda m: _shape(m, f"$.{leaf}").isNotNull())
    return F.coalesce((F.size(elements) == 0) | (found & ~nested), F.lit(False))


def _parts(value: Column, field: str) -> Column:
    return F.try_variant_get(value, f"$.{field}", "array<variant>")


def _text_of_parts(message: Column) -> Column:
    """Texts of a message's parts, one below the other; its plain content if it has no parts."""
    texts = F.transform(_parts(message, "content"), lambda p: F.try_variant_get(p, "$.text", "string"))
    return F.coalesce(F.array_join(texts, "\n"), F.try_variant_get(message, "$.content", "string"))


def turns_of_records(df: DataFrame, key: str, record: str) -> DataFrame:
    """(key, layout, turns) of a column of JSON records, each in a layout of its own."""
    rows = df.select(F.col(key).alias("_key"), F.try_parse_json(F.col(record)).alias("_value"))
    # The field paths that the record has; of each layout's own the hash must be the layout's.
    paths = sorted({path for layout in LAYOUTS[1:] for path in layout.paths})
    rows = rows.withColumn("_has", F.array(*[_has(F.col("_value"), path) for path in paths]))
    has = {path: F.col("_has")[i] for i, path in enumerate(paths)}
    lists = {layout.paths[0].partition("[].")[0] for layout in LAYOUTS[1:] if "[]." in layout.paths[0]}
    filled = {head: F.coalesce(F.size(_parts(F.col("_value"), head)) > 0, F.lit(False)) for head in lists}
    chosen, empty, made_by = [], [], {}
    for layout in LAYOUTS[1:]:
        shown = F.concat_ws("\n", *[F.when(has[path], F.lit(path)) for path in sorted(layout.paths)])
        same = F.substring(F.sha2(shown, 256), 1, 16) == layout.fingerprint
        if layout.without:
            same &= ~has[layout.without]
        head, _, leaf = layout.paths[0].partition("[].")
        if not leaf:
            chosen.append(F.when(same, layout.name))
        else:  # a list without messages only counts where nothing else is found
            chosen.append(F.when(same & filled[head], layout.name))
            empty.append(F.when(same, layout.name))
        made_by[layout.name] = _turns_of_record(layout)
    rows = rows.withColumn("layout", F.coalesce(*chosen, *empty))
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for name, made in made_by.items():
        turns = F.when(F.col("layout") == name, _canonical(made)).otherwise(turns)
    turns = _with_system(F.try_variant_get("_value", f"$.{SYSTEM}", "string"), turns)
    return rows.select(F.col("_key").alias(key), "layout", turns.alias("turns"))


def _turns_of_record(layout: Layout) -> Column:
    """(role, text) pairs of a JSON value ``_value`` of the layout."""
    if layout is PARTS:
        return F.transform(
            _parts(F.col("_value"), "messages"),
            lambda m: F.struct(F.try_variant_get(m, "$.role", "string").alias("role"), _text_of_parts(m).alias("text")),
        )
    struct: dict[str, list[str]] = {}
    for path in sorted(layout.paths):
        head, _, leaf = path.partition("[].")
        struct.setdefault(head, []).extend([leaf] * bool(leaf))
    fields = {}
    for head, leaves in struct.items():
        cast = f"ARRAY<STRUCT<{', '.join(f'`{x}`: STRING' for x in leaves)}>>" if leaves else "STRING"
        fields[head] = F.try_variant_get("_value", f"$.{head}", cast)
    if any(struct.values()):
        role, text = (p.partition("[].")[2] for p in layout.paths)
        return _pairs(fields[next(iter(struct))], role, text)
    question, answer, *more = layout.paths
    asked = F.concat_ws("\n\n", fields[question], F.nullif(fields[more[0]], F.lit(""))) if more else fields[question]
    return F.array(
        F.struct(F.lit("user").alias("role"), asked.alias("text")),
        F.struct(F.lit("assistant").alias("role"), fields[answer].alias("text")),
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _header(role: Column) -> Column:
    """A role on one line; ``%`` is the escape."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role(header: Column) -> Column:
    return F.replace(F.replace(unescape(header), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def formatted(turns: DataFrame, key: str) -> DataFrame:
    """One row per conversation: (key, formatted, loss_spans, loss_turns).

    ``turns`` has (key, position, role, text). ``loss_spans``: array of (begin, length) in code
    points of ``formatted``, one for each assistant text; ``loss_turns``: numbers of the turns that
    these lie in. Where a turn begins is a running sum
    over the conversation, so no expression walks over all turns for each turn.
    """
    head = F.concat(F.lit(BEGIN), _header(F.col("role")), F.lit("\n"))
    rows = turns.select(
        F.col(key), "position", "role", "text", head.alias("_head"), escape(F.col("text")).alias("_body")
    ).withColumn("_size", F.char_length("_head") + F.char_length("_body") + len(END) + 1)
    before = Window.partitionBy(key).orderBy("position", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_begin", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    placed = F.struct(
        F.col("_begin").alias("begin"),
        F.concat("_head", "_body", F.lit(f"{END}\n")).alias("shown"),
        F.when(
            F.col("role") == "assistant",
            F.struct(
                (F.col("_begin") + F.char_length("_head")).alias("begin"),
                F.char_length("_body").cast("long").alias("length"),
            ),
        ).alias("loss"),
    )
    ordered = rows.groupBy(key).agg(F.sort_array(F.collect_list(placed)).alias("_turns"))
    return ordered.select(
        key,
        F.concat_ws("", F.col("_turns.shown")).alias("formatted"),
        F.array_compact(F.col("_turns.loss")).alias("loss_spans"),
        F.array_compact(F.transform("_turns", lambda t, i: F.when(t["loss"].isNotNull(), i))).alias("loss_turns"),
    )


def parsed(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`formatted` with ``turns`` read back from the text and ``loss_text``.

    The text is split once. A span is cut out of its turn's piece, not of the whole text, whose
    characters would have to be counted from the start for every span.
    """
    pieces = F.slice(F.split("formatted", r"\Q" + BEGIN + r"\E"), 2, 1 << 30)
    tail = len(END) + 1

    def header(piece: Column) -> Column:
        return F.substring_index(piece, "\n", 1)

    def turn(piece: Column) -> Column:
        begin = F.char_length(header(piece)) + 2
        body = F.substring(piece, begin, F.char_length(piece) - tail - begin + 1)
        return F.struct(_role(header(piece)).alias("role"), unescape(body).alias("text"))

    def masked(span: Column, number: Column) -> Column:
        piece = F.col("_pieces")[number]
        return unescape(F.substring(piece, F.char_length(header(piece)) + 2, span["length"].cast("int")))

    split = rows.withColumn("_pieces", pieces)
    loss = F.zip_with("loss_spans", "loss_turns", masked)
    return split.select(
        *rows.columns, F.transform("_pieces", turn).alias("turns"), F.concat_ws("", loss).alias("loss_text")
    )
