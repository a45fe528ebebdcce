"""Chat formatting: layouts recognised by a fingerprint of their field paths, canonical turns, one
marked-up text per conversation with a loss mask, and the way back. Native expressions only."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Layout:
    """How one record layout becomes turns.

    ``paths`` are the field paths that identify it, ``optional`` those it may lack. Either ``list_path``
    names a list of messages with fields ``role`` and ``text``, or ``parts`` gives the turns in order as
    (role, paths joined by a blank line).
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    list_path: str | None = None
    role: str = "role"
    text: str = "content"
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()


LAYOUTS = (
    Layout("turn_rows", ("conv_id", "role", "text", "turn")),
    Layout("messages", ("messages[].content", "messages[].role"), list_path="messages"),
    Layout("from_value", ("conversations[].from", "conversations[].value"), list_path="conversations",
           role="from", text="value"),
    Layout("instruction", ("instruction", "output"), ("input", "system"),
           parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("prompt_response", ("prompt", "response"), ("system",),
           parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt_completion", ("completion", "prompt"), ("system",),
           parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("question_answer", ("answer", "question"), ("context",),
           parts=(("user", ("context", "question")), ("assistant", ("answer",)))),
)

# Other names of the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: Sequence[str]) -> str:
    """Hash of a set of nested field paths, in any order; list elements are written ``[]``."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def schema_paths(schema: T.DataType, at: str = "") -> list[str]:
    """The paths of all leaves of a schema."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in schema_paths(f.dataType, f"{at}.{f.name}".lstrip("."))]
    if isinstance(schema, T.ArrayType):
        return schema_paths(schema.elementType, f"{at}[]")
    return [at]


def _known_paths(layouts: Sequence[Layout]) -> list[str]:
    return sorted({p for x in layouts for p in (*x.paths, *x.optional)})


def _choices(layouts: Sequence[Layout]) -> dict[str, str]:
    """Fingerprint to layout name, for every subset of the optional paths."""
    found = {}
    for x in layouts:
        for bits in range(2 ** len(x.optional)):
            extra = [p for i, p in enumerate(x.optional) if bits >> i & 1]
            found[fingerprint([*x.paths, *extra])] = x.name
    return found


def layout_of(schema: T.StructType, layouts: Sequence[Layout] = LAYOUTS) -> Layout | None:
    """The layout of a table by the fingerprint of its schema. Columns that no layout knows do not count; if
    there are columns of several layouts, the one with the most paths whose paths are all there is taken, the
    first of equals."""
    known = set(_known_paths(layouts))
    held = {p for p in schema_paths(schema) if p in known}
    name = _choices(layouts).get(fingerprint(sorted(held)))
    whole = [x for x in layouts if held.issuperset(x.paths)]
    return next((x for x in layouts if x.name == name), max(whole, key=lambda x: len(x.paths), default=None))


def _json_path(path: str) -> str:
    return "$." + path.replace("[]", "[0]")


def _held(record: Column, path: str) -> Column:
    """Whether a JSON record has a path. A key with the value null is there; a path through a list is, if any of its
    elements has the key or the list has no elements."""
    if "[]." not in path:
        top, _, rest = path.rpartition(".")
        of = F.get_json_object(record, f"$.{top}") if top else record
        return F.coalesce(F.array_contains(F.json_object_keys(of), rest), F.lit(False))
    listed, key = path.split("[].")
    items = F.from_json(F.get_json_object(record, f"$.{listed}"), "array<map<string,string>>")
    some = F.exists(items, lambda m: F.coalesce(F.map_contains_key(m, key), F.lit(False)))
    return F.coalesce(some | (F.size(items) == 0), F.lit(False))


def json_layout(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """The layout name of each JSON record, by the fingerprint of the known paths it holds: keys count whatever their
    value, and one element of a list is enough. A record with paths of several layouts has the one with the most paths
    that are all there, the first of equals; null where there is none."""
    held = {p: _held(record, p) for p in _known_paths(layouts)}
    hashed = F.sha2(F.concat_ws("\n", *(F.when(there, F.lit(p)) for p, there in held.items())), 256)
    pairs = [F.lit(x) for pair in _choices(layouts).items() for x in pair]
    whole = [
        F.when(reduce(and_, (held[p] for p in x.paths)), F.lit(x.name))
        for x in sorted(layouts, key=lambda x: -len(x.paths))
    ]
    return F.coalesce(F.create_map(*pairs)[hashed], *whole)


_TURNS = "array<struct<role:string,text:string>>"


def _turns(layout: Layout, at: Callable[[str], Column | None], items: Column | None) -> Column:
    """The turns of one record: those of its list, or its parts; ``at`` gives the text at a path, None for a path that
    is not there."""
    if layout.list_path:
        made = F.transform(items, lambda m: F.struct(m[layout.role].alias("role"), m[layout.text].alias("text")))
        return made.cast(_TURNS)
    parts = []
    for role, paths in layout.parts:
        texts = [c.cast("string") for c in map(at, paths) if c is not None]
        if texts:
            some = F.coalesce(*texts).isNotNull()
            parts.append(F.when(some, F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *texts).alias("text"))))
    return F.filter(F.array(*parts), lambda m: m.isNotNull()).cast(_TURNS)


def _listed(rows: DataFrame) -> DataFrame:
    found = rows.select("conv_id", F.posexplode("turns").alias("turn", "t"))
    return found.select("conv_id", F.col("turn").cast("long"), canonical_role(F.col("t.role")).alias("role"), "t.text")


def _json_rows(records: DataFrame, id_col: str, json_col: str, layouts: Sequence[Layout]) -> DataFrame:
    rows = records.select(F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{json_col}`").alias("record"))
    rows = rows.withColumn("layout", json_layout(F.col("record"), layouts))
    record, ways = F.col("record"), F.lit(None).cast(_TURNS)
    for x in layouts:
        if x.list_path or x.parts:
            element = f"array<struct<`{x.role}`:string,`{x.text}`:string>>"
            items = F.from_json(F.get_json_object(record, f"$.{x.list_path}"), element) if x.list_path else None
            turns = _turns(x, lambda p: F.get_json_object(record, f"$.{p}"), items)
            ways = F.when(F.col("layout") == x.name, turns).otherwise(ways)
    return rows.withColumn("turns", ways)


def json_turns(records: DataFrame, id_col: str, json_col: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Turns (``conv_id, turn, role, text``) of JSON records in different layouts.

    A message of a list is a turn whatever it lacks: its role or text is then null. A part that is missing or null gives
    no turn, the other parts of the record do. Records that are null, no JSON, in no known layout or without any turn
    give none; :func:`json_remainder` counts them. Other columns are not carried over, whatever their names.
    """
    return _listed(_json_rows(records, id_col, json_col, layouts))


def json_remainder(records: DataFrame, id_col: str, json_col: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``reason, n``: how many records give no turn, and why: ``null``, ``no object``, ``no layout``, ``no turns``."""
    rows = _json_rows(records, id_col, json_col, layouts)
    reason = (
        F.when(F.col("record").isNull(), "null")
        .when(F.json_object_keys("record").isNull(), "no object")
        .when(F.col("layout").isNull(), "no layout")
        .when(F.coalesce(F.size("turns"), F.lit(0)) <= 0, "no turns")
    )
    return rows.groupBy(reason.alias("reason")).agg(F.count("*").alias("n")).filter("reason IS NOT NULL")


def canonical_role(role: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    return F.coalesce(names[role], role)


def table_turns(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Turns of a table whose schema has a known layout, the same for all rows: a message of a list is a turn whatever it
    lacks, a part that is null gives none. Raises ``ValueError`` for any other schema."""
    layout = layout_of(rows.schema)
    if layout is None:
        raise ValueError("no layout has the fingerprint of this schema")
    if layout.name == "turn_rows":
        return rows.select("conv_id", "turn", "role", "text")
    there = set(schema_paths(rows.schema))
    turns = _turns(layout, lambda p: F.col(p) if p in there else None, F.col(layout.list_path) if layout.list_path else None)
    return _listed(rows.select(F.col(f"`{id_col}`").alias("conv_id"), turns.alias("turns")))


def escape(text: Column) -> Column:
    """Text in which no control string can begin: ``&`` and ``<|`` are written as entities."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def format_chat(turns: DataFrame, learn: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss`` with ``loss`` the spans (``start``, ``stop``,
    in code points of ``formatted``) of the texts of the roles in ``learn``.

    ``turns`` has ``conv_id, turn, role, text``; other columns are dropped. Null roles and texts count as
    empty. Turns are ordered by ``turn`` (nulls first), ties by role and text; repeated rows are repeated
    turns. Rows with a null ``conv_id`` form one conversation of their own. A conversation is one text and
    so is put together in one task, but its offsets are summed in the sort, in linear time.
    """
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("&#10;"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumns({"head": head, "body": body})
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(f"{END}\n")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns(
        {"pos": F.row_number().over(order), "before": F.sum(F.length("piece").cast("long")).over(upto)}
    ).withColumn("start", F.col("before") - F.length("piece") + F.length("head"))
    span = F.when(
        F.col("role").isin(list(learn)),
        F.struct(F.col("start").alias("start"), (F.col("start") + F.length("body")).alias("stop")),
    )
    packed = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "piece", span.alias("span")))).alias("pieces")
    )
    return packed.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(F.transform("pieces", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss"),
    )


def read_chat(formatted: DataFrame) -> DataFrame:
    """Back from the output of :func:`format_chat`: ``conv_id, turns`` (array of role and text),
    ``loss_texts`` (the unescaped texts under the mask) and ``formatted_chars``. A null ``formatted`` gives
    nulls."""
    pieces = F.filter(F.split("formatted", "<\\|im_end\\|>\n"), lambda p: p != "")
    inner = F.transform(pieces, lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p)))

    def parse(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        text = F.substring(p, F.length(role) + 2, F.length(p))
        return F.struct(
            unescape(F.replace(role, F.lit("&#10;"), F.lit("\n"))).alias("role"), unescape(text).alias("text")
        )

    under = F.transform(
        "loss",
        lambda s: unescape(
            F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))
        ),
    )
    return formatted.select(
        "conv_id",
        F.transform(inner, parse).alias("turns"),
        under.alias("loss_texts"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
