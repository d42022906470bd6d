"""Chat formatting: records of any known layout to canonical turns to one text (DataFrame only).

A layout is a set of nested field paths, such as ``messages[].role``. The paths of a
frame's schema, or of each JSON record by itself, are cut to those that some mapping
reads, sorted and hashed; the hash picks the mapping, and a mapping only declares which
path holds what. Where paths of several mappings meet, the one with the most paths that
are all there is taken, the earlier of equals. Canonical turns are an array of (role,
text) per record.

The template writes a turn as ``### role: text</turn>`` and a line feed. Inside texts a
backslash is doubled, ``#`` becomes ``\\#`` and ``</turn>`` becomes ``<\\/turn>``, so that
neither ``###`` nor ``</turn>`` occurs there; in roles ``: `` becomes ``:\\ `` as well. A
backslash is always taken together with the character after it, hence reading back is a
split and one replacement. The loss mask is an array of byte spans [start, end) of the
formatted text, one for each assistant text, in order.

Defined results: null roles and texts count as empty; flat rows are ordered by turn
(nulls first), then role, then text, and rows without an id form one conversation whose
id is null; repeated rows are turns of their own. In the other layouts each row is a
record, also where ids repeat or are null; a null prompt, instruction or input gives no
turn, a null or missing list gives no turns, a null item of a list gives a turn without
role and text. A record whose paths fit no mapping, and text that is no JSON, keeps its
row with ``turns`` null and can be found by its fingerprint; it is formatted as no turns.
A frame whose schema fits none is an error that names the paths. Columns that no mapping
reads are ignored. An empty table gives an empty result. A conversation is one row, so
its formatted text has to stay below Spark's 2 GB for a value.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tillwright.llm.common import prepare

TURN = "struct<role string, text string>"
#: Names that the layout with ``from`` and ``value`` gives its roles.
SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns.

    ``items`` is the path of a list of turns with ``role`` and ``text`` inside it; or
    ``turns`` lists (role, path), or (role, path, path) to join two texts by a blank
    line, in order. ``rows`` marks the layout in which each row is a turn.
    """

    name: str
    items: str | None = None
    role: str | None = None
    text: str | None = None
    turns: tuple[tuple[str, ...], ...] = ()
    rows: bool = False
    aliases: tuple[tuple[str, str], ...] = ()

    def paths(self) -> set[str]:
        if self.rows:
            return {"turn", self.role, self.text}
        if self.items:
            return {f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"}
        return {p for _, *own in self.turns for p in own}


MAPPINGS = (
    Mapping("rows", role="role", text="text", rows=True),
    Mapping("messages", items="messages", role="role", text="content"),
    Mapping("messages_text", items="messages", role="role", text="text"),
    Mapping("turns", items="turns", role="role", text="text"),
    Mapping("conversations", items="conversations", role="from", text="value", aliases=SPEAKERS),
    Mapping("nested_messages", items="conversation.messages", role="author.role", text="content.text"),
    Mapping("prompt_completion", turns=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt_response", turns=(("user", "prompt"), ("assistant", "response"))),
    Mapping("system_prompt_response", turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("question_answer", turns=(("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", turns=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", turns=(("user", "instruction", "input"), ("assistant", "output"))),
)


def fingerprint(paths) -> str:
    """SHA-256 of the sorted paths, one per line."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def known_paths(mappings: tuple[Mapping, ...] = MAPPINGS) -> list[str]:
    return sorted(set().union(*(m.paths() for m in mappings)))


def schema_paths(schema: DataType, above: str = "") -> list[str]:
    """Paths of all fields that hold neither a struct nor a list of structs."""
    if isinstance(schema, StructType):
        return [
            p for f in schema.fields for p in schema_paths(f.dataType, f"{above}.{f.name}" if above else f.name)
        ]
    if isinstance(schema, ArrayType):
        return schema_paths(schema.elementType, f"{above}[]")
    return [above]


def by_size(mappings: tuple[Mapping, ...]) -> list[Mapping]:
    return sorted(mappings, key=lambda m: -len(m.paths()))


def chosen(schema: StructType, mappings: tuple[Mapping, ...] = MAPPINGS) -> Mapping:
    """The mapping whose fingerprint is that of the schema's known paths."""
    own = set(schema_paths(schema))
    by_mark = {fingerprint(m.paths()): m for m in reversed(mappings)}
    mark = fingerprint(own & set(known_paths(mappings)))
    if mark in by_mark:
        return by_mark[mark]
    for mapping in by_size(mappings):
        if mapping.paths() <= own:
            return mapping
    raise ValueError(f"no mapping for the paths {sorted(own)}")


def _role(role: Column, mapping: Mapping) -> Column:
    named = F.coalesce(role.cast("string"), F.lit(""))
    out = named
    for alias, name in mapping.aliases:
        out = F.when(named == alias, F.lit(name)).otherwise(out)
    return out


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _inside(value: Column, names: list[str]) -> Column:
    for name in names:
        value = value.getField(name)
    return value


def _fixed(turns, read) -> Column:
    """Turns of a layout with a field per turn; a turn without any text is left out."""
    made = []
    for role, *paths in turns:
        texts = [read(p) for p in paths]
        text = texts[0] if len(texts) == 1 else F.concat_ws("\n\n", *[F.nullif(t, F.lit("")) for t in texts])
        present = F.coalesce(*texts).isNotNull()
        # An answer stays as an empty turn; the others need a text.
        turn = _turn(F.lit(role), text)
        made.append(turn if role == ASSISTANT else F.when(present, turn))
    return F.filter(F.array(*made), lambda t: t.isNotNull())


def canonical(
    records: DataFrame, record_id: str = "conv_id", mappings: tuple[Mapping, ...] = MAPPINGS
) -> DataFrame:
    """(conv_id, layout, turns) of a frame, by its schema's fingerprint."""
    mapping = chosen(records.schema, mappings)
    key = F.col(record_id).cast("long").alias("conv_id")
    if mapping.rows:
        own = records.select(
            key,
            F.col("turn").cast("long").alias("turn"),
            _turn(_role(F.col(mapping.role), mapping), F.col(mapping.text)).alias("said"),
        )
        # Structs sort by turn (nulls first), then role, then text.
        found = own.groupBy("conv_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("turn", "said.role", "said.text"))),
                        lambda t: _turn(t["role"], t["text"])).alias("turns")
        )
        return found.select("conv_id", F.lit(mapping.name).alias("layout"), "turns")
    if mapping.items:
        outer, *inner = mapping.items.split(".")
        items = F.transform(
            _inside(F.col(outer), inner),
            lambda m: _turn(
                _role(_inside(m, mapping.role.split(".")), mapping), _inside(m, mapping.text.split("."))
            ),
        )
        turns = F.coalesce(items, F.array().cast(f"array<{TURN}>"))
    else:
        turns = _fixed(mapping.turns, lambda p: F.col(p).cast("string"))
    return records.select(key, F.lit(mapping.name).alias("layout"), turns.alias("turns"))


def _record_paths(record: Column, known: list[str]) -> Column:
    """Those of the known paths that a JSON record has, sorted.

    The record's own shape is told by the engine; a path is there if its parts are.
    """
    def has(path: str) -> Column:
        list_path, _, inner = path.partition("[].")
        if not inner:
            return F.try_variant_get(record, f"$.{path}", "variant").isNotNull()
        items = F.try_variant_get(record, f"$.{list_path}", "array<variant>")
        return F.exists(items, lambda item: F.try_variant_get(item, f"$.{inner}", "variant").isNotNull())

    return F.filter(F.array(*[F.when(has(p), F.lit(p)) for p in known]), lambda p: p.isNotNull())


def canonical_records(
    records: DataFrame,
    record: str = "record",
    record_id: str = "conv_id",
    mappings: tuple[Mapping, ...] = MAPPINGS,
) -> DataFrame:
    """(conv_id, layout, turns, fingerprint) of JSON records, each by its own fingerprint.

    One column may hold every layout but flat rows. The fingerprint covers the known
    paths that the record has.
    """
    usable = tuple(m for m in mappings if not m.rows)
    known = known_paths(usable)
    parsed = records.select(
        F.col(record_id).cast("long").alias("conv_id"), F.try_parse_json(F.col(record)).alias("value")
    )
    marked = parsed.withColumn(
        "fingerprint", F.sha2(F.array_join(_record_paths(F.col("value"), known), "\n"), 256)
    )
    turns, layout = F.lit(None).cast(f"array<{TURN}>"), F.lit(None).cast("string")
    there = _record_paths(F.col("value"), known)
    # The last condition set is the first one tried: fingerprints come before parts.
    for m in reversed(by_size(usable)):
        mine = F.size(F.array_except(F.array(*map(F.lit, sorted(m.paths()))), there)) == 0
        turns = F.when(mine, _record_turns(F.col("value"), m)).otherwise(turns)
        layout = F.when(mine, F.lit(m.name)).otherwise(layout)
    for m in reversed(usable):
        mine = F.col("fingerprint") == fingerprint(m.paths())
        turns = F.when(mine, _record_turns(F.col("value"), m)).otherwise(turns)
        layout = F.when(mine, F.lit(m.name)).otherwise(layout)
    return marked.select("conv_id", layout.alias("layout"), turns.alias("turns"), "fingerprint")


def _record_turns(value: Column, mapping: Mapping) -> Column:
    if not mapping.items:
        return _fixed(mapping.turns, lambda p: F.try_variant_get(value, f"$.{p}", "string"))
    return F.transform(
        F.try_variant_get(value, f"$.{mapping.items}", "array<variant>"),
        lambda item: _turn(
            _role(F.try_variant_get(item, f"$.{mapping.role}", "string"), mapping),
            F.try_variant_get(item, f"$.{mapping.text}", "string"),
        ),
    )


HEAD, MIDDLE, TAIL = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("#"), F.lit("\\#"))
    return F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(": "), F.lit(":\\ "))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Lengths in a block of the running sum below.
STEP = 256


def _starts(lengths: Column) -> Column:
    """Exclusive running sums of an array, by blocks, so that the work stays near linear."""
    zero = F.lit(0).cast("long")

    def add(a, x):
        return a + x

    def blocks(n):
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.floor((F.size(n) - 1) / STEP), F.lit(0)).cast("int")),
            lambda b: F.aggregate(F.slice(n, b * STEP + 1, STEP), zero, add),
        )

    def running(sums):
        return F.aggregate(
            sums,
            F.array(zero),
            lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s)),
        )

    def all_starts(n, bases):
        return F.transform(
            n,
            lambda _, i: F.get(bases, F.floor(i / STEP).cast("int"))
            + F.aggregate(F.slice(n, (i - i % STEP + 1).cast("int"), (i % STEP).cast("int")), zero, add),
        )

    return _let(lengths, lambda n: _let(running(blocks(n)), lambda bases: all_starts(n, bases)))


def format_turns(conversations: DataFrame) -> DataFrame:
    """``formatted`` and ``loss_spans`` for rows with ``turns``; the other columns stay.

    ``loss_spans`` are byte offsets into the UTF-8 of ``formatted``.
    """
    turns = F.coalesce("turns", F.array().cast(f"array<{TURN}>"))
    parts = F.transform(
        turns,
        lambda t: F.struct(
            F.concat(F.lit(HEAD), _escape_role(t["role"]), F.lit(MIDDLE)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == ASSISTANT).alias("loss"),
        ),
    )
    written = conversations.withColumn("_parts", parts)

    def spans(own):
        head = F.transform(own, lambda p: F.octet_length(p["head"]).cast("long"))
        body = F.transform(own, lambda p: F.octet_length(p["body"]).cast("long"))
        whole = F.zip_with(head, body, lambda h, b: h + b + len(TAIL))
        found = F.zip_with(
            own,
            _starts(whole),
            lambda p, s: F.when(
                p["loss"],
                F.struct(
                    (s + F.octet_length(p["head"])).alias("start"),
                    (s + F.octet_length(p["head"]) + F.octet_length(p["body"])).alias("end"),
                ),
            ),
        )
        return F.filter(found, lambda x: x.isNotNull())

    return written.select(
        *[F.col(f"`{c}`") for c in conversations.columns],
        F.array_join(
            F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(TAIL))), ""
        ).alias("formatted"),
        _let(F.col("_parts"), spans).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    pieces = F.split(formatted, TAIL)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: _let(
            F.locate(MIDDLE, p),
            lambda at: F.struct(
                unescape(F.substring(p, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"),
                unescape(F.substring(p, at + len(MIDDLE), F.char_length(p))).alias("text"),
            ),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return _let(
        formatted.cast("binary"),
        lambda raw: F.transform(
            spans,
            lambda s: unescape(
                F.decode(F.substring(raw, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), "UTF-8")
            ),
        ),
    )


def digest(formatted: DataFrame) -> DataFrame:
    """What a formatted conversation says, read back from it."""
    back = formatted.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def chat_format(*records: DataFrame, record_id: str = "conv_id") -> DataFrame:
    """(conv_id, layout, turns, formatted, loss_spans) of frames of any layouts."""
    if not records:
        raise ValueError("no frame to format")
    prepare(records[0].sparkSession)
    turns = None
    for frame in records:
        own = canonical(frame, record_id)
        turns = own if turns is None else turns.unionByName(own)
    return format_turns(turns)
