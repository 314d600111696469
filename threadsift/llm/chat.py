"""Conversations in many layouts as canonical turns, and turns as training text with a loss mask.

A layout is recognised by its fingerprint, a hash of the sorted nested field paths of a record (types left out);
``LAYOUTS`` maps fingerprints to declarative descriptions of where the turns are. ``canonical_turns`` does this for
a table by its schema, ``canonical_json_turns`` record by record for JSON texts, whose layouts may be mixed.

``format_turns`` writes each turn as ``<s>[INST]role[/INST]text</s>``. A control string inside a role or a text gets a
backslash after its first character, and backslashes are doubled, so the marks are the only control strings of
the output and reading back is exact. ``read_back`` parses the formatted pieces again.

Conversations are never gathered: turns are sorted by conversation and streamed, so a conversation may hold any
number of turns.

Defined results: NULL texts and roles are empty; turns are ordered by turn (NULL first), then role, then text;
repeated rows are turns of their own; rows without conv_id are conversations of one turn each; a record of unknown
layout keeps its fingerprint and has no turns; a text without assistant turns has an empty loss mask.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
#: Control strings that never occur in formatted texts except as marks.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ESCAPE = "([<\\[])(" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")"


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its turns.

    ``turns``: path of an array of (role, text) members; or ``parts``: (role, path) pairs in order; or ``rows``:
    the table has one row per turn with these columns (turn, role, text). ``fields`` are the record's paths.
    """

    name: str
    key: str
    fields: tuple[str, ...]
    turns: tuple[str, str, str] | None = None
    parts: tuple[tuple[str, str], ...] = ()
    rows: tuple[str, str, str] | None = None

    @property
    def fingerprint(self) -> str:
        return fingerprint_of(self.fields)


def fingerprint_of(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Paths of the leaves; ``[]`` marks an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


#: Mappings from layouts to turns; further ones can be passed.
LAYOUTS = (
    Layout("rows", "conv_id", ("conv_id", "turn", "role", "text"), rows=("turn", "role", "text")),
    Layout("messages", "id", ("id", "messages[].role", "messages[].content"), turns=("messages", "role", "content")),
    Layout("conversations", "id", ("id", "conversations[].from", "conversations[].value"), turns=("conversations", "from", "value")),
    Layout("prompt", "id", ("id", "prompt", "response"), parts=(("user", "prompt"), ("assistant", "response"))),
    Layout("completion", "id", ("id", "prompt", "completion"), parts=(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", "id", ("id", "instruction", "input", "output"), parts=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("system", "id", ("id", "system", "question", "answer"), parts=(("system", "system"), ("user", "question"), ("assistant", "answer"))),
)
#: Names that some layouts use for the canonical roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant"}


def _role(column: Column) -> Column:
    out = F.coalesce(column.cast("string"), F.lit(""))
    for name, role in ROLE_NAMES.items():
        out = F.when(out == name, role).otherwise(out)
    return out


def _turn_array(layout: Layout, value: Callable[[str], Column] = F.col) -> Column:
    """The turns of a record with the layout's fields, as an array of (role, text); parts that are NULL are left out."""
    if layout.turns:
        path, role, text = layout.turns
        return F.transform(
            value(path), lambda m: F.struct(_role(m[role]).alias("role"), F.coalesce(m[text].cast("string"), F.lit("")).alias("text"))
        )
    parts = [F.struct(F.lit(role).alias("role"), value(path).cast("string").alias("text")) for role, path in layout.parts]
    return F.filter(F.array(*parts), lambda p: p["text"].isNotNull())


def canonical_turns(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text) of a table whose schema's fingerprint selects the layout. Columns beyond the
    layout's are ignored when no layout fits all of them."""
    paths = set(field_paths(df.schema))
    exact = [x for x in layouts if x.fingerprint == fingerprint_of(paths)]
    fitting = exact or sorted((x for x in layouts if set(x.fields) <= paths), key=lambda x: -len(x.fields))
    if not fitting:
        raise ValueError(f"no layout for the fields {sorted(paths)}")
    layout = fitting[0]
    if layout.rows:
        turn, role, text = (F.col(c) for c in layout.rows)
        return df.select(
            F.col(layout.key).alias("conv_id"), turn.cast("long").alias("turn"),
            F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
        )
    exploded = df.select(F.col(layout.key).alias("conv_id"), F.posexplode(_turn_array(layout)).alias("turn", "_t"))
    return exploded.select("conv_id", F.col("turn").cast("long").alias("turn"), "_t.role", "_t.text")


def _ddl(fields: tuple[str, ...]) -> str:
    """A schema of text leaves for the paths of a layout."""
    arrays: dict[str, list[str]] = {}
    plain = []
    for path in fields:
        if "[]." in path:
            outer, inner = path.split("[].")
            arrays.setdefault(outer, []).append(inner)
        else:
            plain.append(path)
    members = [f"`{p}` string" for p in plain]
    members += [f"`{o}` array<struct<{', '.join(f'`{i}`: string' for i in inner)}>>" for o, inner in arrays.items()]
    return ", ".join(members)


def json_fingerprint(text: Column) -> Column:
    """The fingerprint of one JSON record: its variant schema without scalar types, hashed."""
    kinds = F.schema_of_variant(F.try_parse_json(text))
    return F.substring(F.sha2(F.regexp_replace(kinds, r"\b(STRING|VOID|BIGINT|DOUBLE|FLOAT|BOOLEAN|DECIMAL\(\d+,\s*\d+\))", "_"), 256), 1, 16)


def canonical_json_turns(df: DataFrame, column: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, layout, fingerprint, turn, role, text) of JSON records in mixed layouts. A record of unknown layout
    or broken JSON has one row with NULL layout and turn."""
    keyed = [x for x in layouts if not x.rows]
    spark = df.sparkSession
    example = [(x.name, _example(x.fields)) for x in keyed]
    known = {
        r["name"]: r["fp"]
        for r in spark.createDataFrame(example, "name string, j string").select("name", json_fingerprint(F.col("j")).alias("fp")).collect()
    }
    base = df.select(F.col(column).alias("_json")).withColumn("fingerprint", json_fingerprint(F.col("_json")))
    name, turns, key = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>"), F.lit(None).cast("string")
    for x in keyed:
        fits = F.col("fingerprint") == known[x.name]
        name = F.when(fits, x.name).otherwise(name)
        base = base.withColumn(f"_{x.name}", F.when(fits, F.from_json("_json", _ddl(x.fields))))
        record = F.col(f"_{x.name}")
        turns = F.when(fits, _turn_array(x, lambda path, record=record: record[path])).otherwise(turns)
        key = F.when(fits, record[x.key]).otherwise(key)
    rows = base.select(key.alias("conv_id"), name.alias("layout"), "fingerprint", F.posexplode_outer(turns).alias("turn", "_t"))
    return rows.select("conv_id", "layout", "fingerprint", F.col("turn").cast("long").alias("turn"), "_t.role", "_t.text")


def _example(fields: tuple[str, ...]) -> str:
    out: dict = {}
    for path in fields:
        if "[]." in path:
            outer, inner = path.split("[].")
            out.setdefault(outer, [{}])[0][inner] = "x"
        else:
            out[path] = "x"
    return json.dumps(out)


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _ESCAPE, r"$1\\$2")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, conv_key, turn_no, piece, at, loss_from, loss_to): the formatted text of a conversation is its
    pieces in order of turn_no; ``at`` is the code point at which a piece begins, [loss_from, loss_to) the span
    of the whole that is learned (NULL unless the role is assistant). conv_key is unique for each conversation."""
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    rows = turns.select("conv_id", own.alias("_row"), "turn", "role", "text")
    order = Window.partitionBy("conv_id", "_row").orderBy("turn", "role", "text")
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    parts = rows.withColumn("_head", F.concat(F.lit(OPEN), role, F.lit(MIDDLE))).withColumn("_text", text)
    parts = parts.select("*", F.concat("_head", "_text", F.lit(CLOSE)).alias("piece"))
    before = F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("piece")
    parts = parts.select("*", F.row_number().over(order).alias("turn_no"), before.alias("at"))
    begin = F.when(F.col("role") == "assistant", F.col("at") + F.length("_head"))
    key = F.concat_ws(":", F.col("conv_id").cast("string"), F.concat(F.lit("row"), F.col("_row").cast("string")))
    return parts.select(
        "conv_id", key.alias("conv_key"), "turn_no", "piece", "at",
        begin.alias("loss_from"), (begin + F.length("_text")).alias("loss_to"),
    )


_turn_mark = re.compile(re.escape(OPEN) + r"(.*?)" + re.escape(MIDDLE) + r"(.*?)" + re.escape(CLOSE), re.S)
_unescape = re.compile(r"\\(.)", re.S)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its formatted pieces alone: turns, and digests of the turns and of the text under the
    loss mask. One pass over sorted pieces that holds one piece at a time."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, None
        for rows in batches:
            out = []
            for key, conv, piece, at, begin, end in rows.itertuples(index=False, name=None):
                if key != current:
                    if state:
                        out.append(state.result())
                    current, state = key, _ReadBack(conv)
                state.add(piece, at, begin, end)
            if out:
                yield pd.DataFrame(out, columns=names)
        if state:
            yield pd.DataFrame([state.result()], columns=names)

    schema = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [c.split()[0] for c in schema.split(", ")]
    rows = formatted.repartition("conv_key").sortWithinPartitions("conv_key", "turn_no")
    rows = rows.select("conv_key", F.col("conv_id").cast("string"), "piece", "at", F.coalesce("loss_from", F.lit(-1)), F.coalesce("loss_to", F.lit(-1)))
    out = rows.mapInPandas(digests, schema)
    return out.withColumn("conv_id", F.col("conv_id").cast(formatted.schema["conv_id"].dataType))


class _ReadBack:
    def __init__(self, conv: str | None):
        self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, at: int, begin: int, end: int) -> None:
        for role, text in _turn_mark.findall(piece):
            self.n += 1
            self.turns.update(f"{_unescape.sub(r'\1', role)}\n{_unescape.sub(r'\1', text)}\n".encode())
        if begin >= 0:
            learned = _unescape.sub(r"\1", piece[begin - at : end - at])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(piece)

    def result(self) -> tuple:
        return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
