"""Chat formatting: records of any known layout to canonical turns, and turns to one marked text.

Schema fingerprinting: the nested field paths of a record, as far as any layout knows them, are
sorted and hashed; the hash selects a declarative mapping. Nothing else about a record is looked at
to decide how it is read. A record is a variant, so layouts may differ from row to row.

The template marks every turn and the role in it. Control strings inside texts are broken by an
escape character, which can be undone, so a text can never close its turn or open another. Turns
are formatted one by one; only the last step brings a conversation together, into one row.

Edge cases: a null text, role or field counts as empty; a record whose paths fit no layout (a null
record too) has no turns and is listed by unmapped(); turns with the same position go by role, then
by formatted text, repeated ones stay; turns without a position come first; rows without an id form
one conversation; a conversation without turns has no row.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN = "struct<position: bigint, role: string, text: string>"


@dataclass(frozen=True)
class Listed:
    """Turns are the elements of an array."""

    array: str
    role: str
    text: str
    # Names of roles in this layout, and what they are called here; others stay.
    roles: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Fields:
    """Turns are single fields: (role, fields joined by an empty line); all but the last are left out when empty."""

    turns: tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class Row:
    """The record is one turn of a conversation that is spread over rows."""

    position: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    name: str
    mapping: Listed | Fields | Row
    # Paths of leaves: '.' steps into an object, '[]' into the elements of an array.
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()

    def shapes(self) -> list[tuple[str, ...]]:
        """Every set of paths a record of this layout may have."""
        some = [c for n in range(len(self.optional) + 1) for c in combinations(self.optional, n)]
        return [tuple(sorted({*self.required, *c})) for c in some]


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("rows", Row("turn", "role", "text"), ("role", "text", "turn")),
    Layout("messages", Listed("messages", "role", "content"), ("messages[].content", "messages[].role")),
    Layout(
        "message parts",
        Listed("messages", "role", "content"),
        ("messages[].content[].text", "messages[].content[].type", "messages[].role"),
    ),
    Layout("no messages", Listed("messages", "role", "content"), ("messages[]",)),
    Layout(
        "speakers",
        Listed("conversations", "from", "value", SPEAKERS),
        ("conversations[].from", "conversations[].value"),
    ),
    Layout(
        "instruction",
        Fields((("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
        ("instruction", "output"),
        ("input", "system"),
    ),
    Layout(
        "prompt and completion", Fields((("user", ("prompt",)), ("assistant", ("completion",)))), ("prompt", "completion")
    ),
    Layout("prompt and response", Fields((("user", ("prompt",)), ("assistant", ("response",)))), ("prompt", "response")),
    Layout(
        "question",
        Fields((("system", ("context",)), ("user", ("question",)), ("assistant", ("answer",)))),
        ("question", "answer"),
        ("context",),
    ),
)


def field_paths(record: str | Column) -> Column:
    """Paths of all leaves of a variant, over all elements of its arrays; none for null.

    Read from the variant's schema text, which quotes unusual names, by a walk over its tokens: a name
    steps down, a scalar ends a path, a closing bracket ends an object or array.
    """
    schema = F.schema_of_variant(F.col(record) if isinstance(record, str) else record)
    token = r"(`[^`]*(?:``[^`]*)*`: |OBJECT<|ARRAY<|>|\w+: |\w+(?:\([0-9,]+\))?)"
    empty = F.struct(F.array(F.lit("")).alias("at"), F.array().cast("array<string>").alias("paths"))

    def step(state: Column, tok: Column) -> Column:
        at, paths = state["at"], state["paths"]
        top = F.try_element_at(at, F.lit(-1))
        up = F.slice(at, F.lit(1), F.greatest(F.size(at) - 1, F.lit(0)))
        name = F.regexp_replace(F.regexp_replace(F.left(tok, F.length(tok) - 2), "^`|`$", ""), "``", "`")
        below = F.when(top == "", name).otherwise(F.concat(top, F.lit("."), name))
        return (
            F.when(tok == ">", F.struct(up.alias("at"), paths.alias("paths")))
            .when(tok == "OBJECT<", state)
            .when(tok == "ARRAY<", F.struct(F.array_append(at, F.concat(top, F.lit("[]"))).alias("at"), paths.alias("paths")))
            .when(tok.endswith(": "), F.struct(F.array_append(at, below).alias("at"), paths.alias("paths")))
            .otherwise(F.struct(up.alias("at"), F.array_append(paths, top).alias("paths")))
        )

    tokens = F.regexp_extract_all(F.coalesce(schema, F.lit("")), F.lit(token), 1)
    return F.aggregate(tokens, empty, step, lambda s: s["paths"])


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(F.array_sort(F.array_distinct(paths)), "\n"))


def layout_of(record: str | Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Name of the layout whose fingerprint the record has, null for none; unknown paths do not count."""
    known = F.array(*[F.lit(p) for p in sorted({p for x in layouts for p in (*x.required, *x.optional)})])
    names, taken = [], {}
    for x in layouts:
        for shape in x.shapes():
            if taken.setdefault(shape, x.name) != x.name:
                raise ValueError(f"layouts {taken[shape]} and {x.name} have the same paths")
            names += [fingerprint(F.array(*[F.lit(p) for p in shape])), F.lit(x.name)]
    return F.try_element_at(F.create_map(*names), fingerprint(F.array_intersect(field_paths(record), known)))


def _get(record: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(record, "$" + "".join(f"[{json.dumps(p)}]" for p in path.split(".")), kind)


def _plain(value: Column) -> Column:
    """Text of a variant: a scalar as it is, of an array of parts the texts of the parts."""
    parts = F.try_variant_get(value, "$", "array<variant>")
    texts = F.transform(parts, lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.lit("")))
    return F.coalesce(F.when(parts.isNotNull(), F.array_join(texts, "")), F.try_variant_get(value, "$", "string"), F.lit(""))


def _turns(record: Column, mapping: Listed | Fields | Row) -> Column:
    def turn(position: Column, role: Column, text: Column) -> Column:
        return F.struct(position.cast("long").alias("position"), role.alias("role"), text.alias("text")).cast(TURN)

    blank = F.lit("")
    if isinstance(mapping, Row):
        role, text = (F.coalesce(_get(record, p, "string"), blank) for p in (mapping.role, mapping.text))
        return F.array(turn(_get(record, mapping.position, "long"), role, text))
    if isinstance(mapping, Listed):
        names = F.create_map(*[F.lit(x) for pair in mapping.roles.items() for x in pair]) if mapping.roles else None

        def element(x: Column, i: Column) -> Column:
            said = F.coalesce(_get(x, mapping.role, "string"), blank)
            role = said if names is None else F.coalesce(F.try_element_at(names, said), said)
            return turn(i, role, _plain(_get(x, mapping.text, "variant")))

        return F.transform(_get(record, mapping.array, "array<variant>"), element)
    made = []
    for i, (role, paths) in enumerate(mapping.turns):
        texts = F.array(*[F.coalesce(_get(record, p, "string"), blank) for p in paths])
        made.append(turn(F.lit(i), F.lit(role), F.array_join(F.array_remove(texts, ""), "\n\n")))
    last = len(made) - 1
    return F.filter(F.array(*made), lambda t: (t["text"] != "") | (t["position"] == last))


def canonical_turns(
    records: DataFrame, conversation: str, record: str, layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """(conversation, layout, position, role, text), one row per turn of every record that fits a layout."""
    read = records.select(F.col(conversation).alias("conversation"), F.col(record).alias("record"))
    named = read.withColumn("layout", layout_of("record", layouts))
    turns = F.lit(None).cast(f"array<{TURN}>")
    for x in layouts:
        turns = F.when(F.col("layout") == x.name, _turns(F.col("record"), x.mapping)).otherwise(turns)
    return named.select("conversation", "layout", F.inline(turns))


def unmapped(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(paths, records): field paths of records that fit no layout, and how many have them."""
    lost = records.select(F.col(record).alias("record")).filter(layout_of("record", layouts).isNull())
    paths = F.array_sort(F.array_distinct(field_paths("record")))
    return lost.select(paths.alias("paths")).groupBy("paths").agg(F.count("*").alias("records"))


# Control strings of common chat formats, none of which may come out of a text.
CONTROLS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>",
    "<|start_header_id|>", "<|end_header_id|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<start_of_turn>", "<end_of_turn>",
)


@dataclass(frozen=True)
class Template:
    """A turn is opening + role + line feed + escaped text + closing + line feed."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>"
    controls: tuple[str, ...] = CONTROLS
    # Put behind the first character of a control string inside a text, and doubled where the text has it.
    escape: str = "\\"
    # Roles whose texts are trained on.
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        marks = {self.opening, self.closing}
        if not marks <= set(self.controls) or len(self.escape) != 1 or any(len(c) < 2 for c in self.controls):
            raise ValueError("controls have two characters at least and contain the marks; the escape is one character")
        if any(self.escape in c or "\n" in c for c in self.controls):
            raise ValueError("no control string may hold the escape or a line feed")
        for c in self.controls:  # else the end of a text and the mark behind it could spell a control string
            if any(m.startswith(c[k:]) or c[k:].startswith(m) for m in marks for k in range(1, len(c))):
                raise ValueError(f"the end of {c} begins a mark")

    def escaped(self, text: Column) -> Column:
        doubled = F.replace(text, F.lit(self.escape), F.lit(self.escape * 2))
        starts = "|".join(re.escape(c) for c in self.controls)
        return F.regexp_replace(doubled, f"(?=(?:{starts}))([\\s\\S])", "$1" + re.escape(self.escape))

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, re.escape(self.escape) + r"([\s\S])", "$1")

    def head(self, role: Column) -> Column:
        """What stands before the text; the role is percent-encoded, so it holds no mark and no line feed."""
        return F.concat(F.lit(self.opening), F.url_encode(role), F.lit("\n"))

    @property
    def tail(self) -> str:
        return f"{self.closing}\n"


CHAT = Template()


def format_turns(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """(conversation, position, role, piece, loss_start, loss_end) of every turn, without a shuffle.

    The loss range is in code points of the piece, null for roles that are not trained on.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    text = template.escaped(F.coalesce(F.col("text"), F.lit("")))
    made = turns.select(
        "conversation", "position", role.alias("role"), template.head(role).alias("head"), text.alias("body")
    )
    trained = F.col("role").isin(*template.trained)
    return made.select(
        "conversation",
        "position",
        "role",
        F.concat("head", "body", F.lit(template.tail)).alias("piece"),
        F.when(trained, F.length("head")).cast("long").alias("loss_start"),
        F.when(trained, F.length("head") + F.length("body")).cast("long").alias("loss_end"),
    )


def format_conversations(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """(conversation, formatted, turns) of every conversation; turns has start, end, loss_start, loss_end in code points.

    One shuffle by conversation. The formatted text is one value, so a conversation must fit into a row.
    """
    order = Window.partitionBy("conversation").orderBy("position", "role", "piece")
    before = F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = format_turns(turns, template).select("*", F.coalesce(before, F.lit(0)).alias("start"))
    at = F.struct(
        "start",
        (F.col("start") + F.length("piece")).alias("end"),
        (F.col("start") + F.col("loss_start")).alias("loss_start"),
        (F.col("start") + F.col("loss_end")).alias("loss_end"),
        "piece",
    )
    whole = placed.groupBy("conversation").agg(F.array_sort(F.collect_list(at)).alias("all"))
    return whole.select(
        "conversation",
        F.array_join(F.col("all.piece"), "").alias("formatted"),
        F.transform("all", lambda t: t.dropFields("piece")).alias("turns"),
    )


def read_back(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """``formatted`` with turns, the roles and texts as parsed from the formatted text alone, and loss.

    ``loss`` has the unescaped text of every trained range, in order.
    """
    cut = F.split("formatted", f"(?={re.escape(template.opening)})")
    pieces = formatted.select(
        "conversation", "formatted", F.filter(cut, lambda p: p != "").alias("pieces"), F.col("turns").alias("spans")
    )

    def parsed(piece: Column) -> Column:
        line = F.locate("\n", piece)
        role = F.substring(piece, F.lit(len(template.opening) + 1), line - len(template.opening) - 1)
        body = F.substring(piece, line + 1, F.length(piece) - line - len(template.tail))
        return F.struct(F.url_decode(role).alias("role"), template.unescaped(body).alias("text"))

    def masked(piece: Column, span: Column) -> Column:
        first = (span["loss_start"] - span["start"] + 1).cast("int")
        chars = (span["loss_end"] - span["loss_start"]).cast("int")
        return F.when(span["loss_start"].isNotNull(), template.unescaped(F.substring(piece, first, chars)))

    return pieces.select(
        "conversation",
        "formatted",
        F.transform("pieces", parsed).alias("turns"),
        F.filter(F.zip_with("pieces", "spans", masked), lambda t: t.isNotNull()).alias("loss"),
    )
