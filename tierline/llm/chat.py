"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A record's fingerprint is the hash of its sorted nested field paths
(``messages[].role``), metadata fields left out. Each known layout is a
``Mapping``: where the turns are and which fields hold role and text. The
registry holds a fingerprint for every combination of a mapping's optional
fields, so finding the mapping is one lookup. Every layout becomes rows
(conversation, order, role, text): the canonical turns.

A table of typed columns has one layout: ``canonical`` fingerprints its nested
schema and applies the mapping as column expressions. A table of JSON texts may hold a
layout in each record: ``turns_from_json`` fingerprints every record.

``render`` turns them into template text. A turn is
``<|im_start|>role\\ntext<|im_end|>\\n``; in roles and texts every ``<``, run of
backslashes and ``|`` gets one more backslash, so no control string can occur
inside them and ``unescape`` restores them. ``read_back`` parses the formatted text into
turns again.

Turns are formatted where they are read, before any exchange. The segments are then sorted inside
partitions by conversation and order, and digests stream over them: the state of a conversation is two
hashers, so no conversation, however long, is held in memory. Only this running digest needs a conversation's
turns in one task.

Defined results: a null role or text is empty; a null order sorts last, ties by the formatted turn;
repeated rows are repeated turns; a null conversation id is a conversation; an unknown layout gives no turns, and its
fingerprint is reported by ``unknown_layouts``; extra fields outside the
mappings' vocabulary are ignored; an empty table gives an empty result. A schema with fields of
several layouts has the one with most fields whose required ones are all there (ties: the first registered); a schema that fits none raises.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """A layout: ``turns`` (field path of role, or a fixed role; field path of text) in order.

    With ``each`` the paths are inside the elements of that list. ``extra``:
    (path, path) whose texts are joined by a blank line to the first one's text.
    """
    name: str
    turns: tuple[tuple[str, str], ...]
    each: str = ""
    optional: tuple[str, ...] = ()
    joined: tuple[tuple[str, str], ...] = ()
    alias: bool = False

    def paths(self) -> set[str]:
        pre = f"{self.each}[]." if self.each else ""
        own = {pre + p for role, text in self.turns for p in (role[1:] if role.startswith("@") else "", text) if p}
        return own | {pre + b for _, b in self.joined}


# "@x": the role is in field x; else the role itself.
MAPPINGS = (
    Mapping("turn_rows", (("@role", "text"),)),
    Mapping("messages", (("@role", "content"),), each="messages"),
    Mapping("sharegpt", (("@from", "value"),), each="conversations", alias=True),
    Mapping("prompt_response", (("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("prompt_completion", (("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", (("system", "system"), ("user", "instruction"), ("assistant", "output")),
            optional=("system", "input"), joined=(("instruction", "input"),)),
)


def field_paths(value, pre: str = "") -> set[str]:
    """The nested field paths of the leaves of a JSON-like value; lists add ``[]``."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{pre}.{k}" if pre else str(k)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return set().union({f"{pre}[]"} if not value else set(), *(field_paths(v, f"{pre}[]") for v in value))
    return {pre}


def fingerprint(paths) -> str:
    return hashlib.sha1("\n".join(sorted(paths)).encode()).hexdigest()


def registry(mappings=MAPPINGS) -> dict[str, Mapping]:
    """Fingerprint to mapping, with every subset of the optional fields."""
    out = {}
    for m in mappings:
        need = m.paths() - set(m.optional)
        for n in range(len(m.optional) + 1):
            for some in combinations(m.optional, n):
                out[fingerprint(need | set(some))] = m
        if m.each:
            out[fingerprint({f"{m.each}[]"})] = m  # no elements
    return out


def vocabulary(mappings=MAPPINGS) -> set[str]:
    return set().union(*(m.paths() | ({f"{m.each}[]"} if m.each else set()) for m in mappings))


class Layouts:
    """Finds the mapping of a record and applies it. Records of one shape are looked up once."""

    def __init__(self, mappings=MAPPINGS):
        self.known, self.words, self.seen = registry(mappings), vocabulary(mappings), {}

    def find(self, record) -> tuple[str, Mapping | None]:
        shape = frozenset(field_paths(record) & self.words)
        if shape not in self.seen:
            print_ = fingerprint(shape)
            self.seen[shape] = (print_, self.known.get(print_))
        return self.seen[shape]

    def turns(self, record) -> list[tuple[str, str]] | None:
        """(role, text) pairs; None if the layout is unknown."""
        _, m = self.find(record)
        if m is None:
            return None
        items = (record.get(m.each) or []) if m.each else [record]
        if not all(isinstance(x, dict) for x in items):
            return None
        out = []
        for item in items:
            for role, text in m.turns:
                if text in m.optional and item.get(text) is None:
                    continue
                role = str(item.get(role[1:]) or "") if role.startswith("@") else role
                said = [item.get(text)] + [item.get(b) for a, b in m.joined if a == text and item.get(b)]
                out.append((ROLES.get(role, role) if m.alias else role, "\n\n".join("" if s is None else str(s) for s in said)))
        return out


def schema_paths(kind: T.DataType, pre: str = "") -> set[str]:
    """The nested field paths of a type, as ``field_paths`` gives them for its values."""
    if isinstance(kind, T.StructType):
        return set().union(*(schema_paths(f.dataType, f"{pre}.{f.name}" if pre else f.name) for f in kind.fields))
    return schema_paths(kind.elementType, f"{pre}[]") if isinstance(kind, T.ArrayType) else {pre}


def layout_of(schema: T.StructType, mappings=MAPPINGS) -> Mapping:
    """The mapping of a table with this schema."""
    paths = schema_paths(schema) & vocabulary(mappings)
    found = registry(mappings).get(fingerprint(paths))
    if found is None:       # fields of several layouts
        fits = [m for m in mappings if m.paths() - set(m.optional) <= paths]
        if not fits:
            raise ValueError(f"no layout fits the fields {sorted(schema_paths(schema))}")
        found = max(fits, key=lambda m: len(m.paths() & paths))
    return found


def canonical(records: DataFrame, id_col: str = "conv_id", order_col: str | None = None, mappings=MAPPINGS) -> DataFrame:
    """Canonical turns (conv_id, turn, role, text) of a table whose layout its nested schema's fingerprint selects.

    ``turn`` is ``order_col``, or the place inside the record where records hold several turns.
    """
    m = layout_of(records.schema, mappings)
    present = schema_paths(records.schema)
    conv, order = records[id_col].alias("conv_id"), records[order_col] if order_col else F.lit(0)
    if m.each:
        rows = records.select(conv, F.posexplode(records[m.each]).alias("_pos", "_item"))
        item, pre, place = lambda name: F.col("_item")[name], f"{m.each}[].", F.col("_pos").cast("long") * len(m.turns)
    else:
        named = sorted({p for p in m.paths() if p in present})
        rows = records.select(conv, order.alias("_pos"), F.struct(*[records[n] for n in named]).alias("_item"))
        item, pre, place = lambda name: F.col("_item")[name], "", F.col("_pos") if len(m.turns) == 1 else F.lit(0).cast("long")

    def has(name: str) -> bool:
        return pre + name in present

    def text_of(name: str) -> Column:
        said = F.coalesce(item(name).cast("string"), F.lit(""))
        for _, other in (j for j in m.joined if j[0] == name and has(j[1])):
            more = F.coalesce(item(other).cast("string"), F.lit(""))
            said = F.concat(said, F.when(more != "", F.concat(F.lit("\n\n"), more)).otherwise(""))
        return said

    def role_of(role: str) -> Column:
        if not role.startswith("@"):
            return F.lit(role)
        own = F.coalesce(item(role[1:]).cast("string"), F.lit(""))
        return F.coalesce(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])[own], own) if m.alias else own

    turns = [F.struct((place + k if len(m.turns) > 1 else place).alias("turn"), role_of(role).alias("role"), text_of(text).alias("text"),
                      (item(text).isNotNull() if text in m.optional else F.lit(True)).alias("_said"))
             for k, (role, text) in enumerate(m.turns) if has(text)]
    if len(turns) == 1:
        rows = rows.select("conv_id", turns[0].alias("_t"))
    else:
        rows = rows.select("conv_id", F.explode(F.array(*turns)).alias("_t"))
    return rows.where("_t._said").select("conv_id", "_t.turn", "_t.role", "_t.text")


def turns_from_json(records: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Canonical turns (conv_id, turn, role, text) of records in any known layout; text that isn't a JSON object gives none."""
    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layouts = Layouts()
        for pdf in batches:
            out = []
            for i, raw in zip(pdf["id"], pdf["raw"]):
                out += [(i, k, *t) for k, t in enumerate(layouts.turns(r) or [])] if (r := _loads(raw)) is not None else []
            yield pd.DataFrame(out, columns=["conv_id", "turn", "role", "text"])
    kind = records.schema[id_col].dataType
    return (records.select(records[id_col].cast("string").alias("id"), records[json_col].alias("raw"))
            .mapInPandas(convert, "conv_id string, turn long, role string, text string")
            .withColumn("conv_id", F.col("conv_id").cast(kind)))


def unknown_layouts(records: DataFrame, json_col: str) -> DataFrame:
    """(fingerprint, n) of the records no mapping fits."""
    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        layouts = Layouts()
        for pdf in batches:
            found = [layouts.find(r if isinstance(r, dict) else {}) for r in map(_loads, pdf["raw"])]
            yield pd.DataFrame({"fingerprint": [f for f, m in found if m is None]}, dtype=object)
    return (records.select(records[json_col].alias("raw")).mapInPandas(prints, "fingerprint string")
            .groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")))


def _loads(raw):
    try:
        value = json.loads(raw)
    except (TypeError, ValueError):
        return None
    return value if isinstance(value, dict) else None


_OPENS, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    return _OPENS.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role(role: str) -> str:
    # a role is one line of the template: its line breaks and backslashes are written as escapes
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its loss mask begins and ends (equal: no loss)."""
    head, body = f"{START}{_role(role)}\n", escape(text)
    until = len(head) + len(body) if role == "assistant" else len(head)
    return f"{head}{body}{END}\n", len(head), until


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of formatted text."""
    return [(_unrole(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def render(turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, segment, loss_from, loss_to), sorted by conversation and turn inside partitions.

    A conversation's formatted text is its segments one after the other.
    Turns are formatted where they lie; only segments are exchanged.
    """
    kind, place = turns.schema[id_col].dataType, turns.schema[order_col].dataType
    rows = turns.select(turns[id_col].cast("string").alias("conv_id"), turns[order_col].cast("string").alias("turn"), turns[role_col].alias("role"), turns[text_col].alias("text"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [segment(r or "", t or "") for r, t in zip(pdf["role"], pdf["text"])]
            yield pd.DataFrame({"conv_id": pdf["conv_id"], "turn": pdf["turn"], "segment": [p[0] for p in parts],
                                "loss_from": [p[1] for p in parts], "loss_to": [p[2] for p in parts]})
    return (rows.mapInPandas(write, "conv_id string, turn string, segment string, loss_from long, loss_to long")
            .withColumns({"conv_id": F.col("conv_id").cast(kind), "turn": F.col("turn").cast(place)})
            .repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "segment").drop("turn"))


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, part: str, begin: int, end: int) -> None:
        for role, text in read_back(part):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n += 1
        said = unescape(part[begin:end])
        self.loss.update(said.encode())
        self.loss_chars += len(said)
        self.chars += len(part)

    def row(self, conv):
        return conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(rendered: DataFrame) -> DataFrame:
    """One row per conversation, read back from the output of ``render``."""
    kind = rendered.schema["conv_id"].dataType
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for pdf in batches:
            done = []
            for conv, part, begin, end in zip(pdf["conv_id"], pdf["segment"], pdf["loss_from"], pdf["loss_to"]):
                if state is None or conv != now:
                    if state is not None:
                        done.append(state.row(now))
                    now, state = conv, _Digest()
                state.add(part, begin, end)
            yield pd.DataFrame(done, columns=columns)
        if state is not None:
            yield pd.DataFrame([state.row(now)], columns=columns)
    return (rendered.withColumn("conv_id", F.col("conv_id").cast("string"))
            .mapInPandas(stream, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
            .withColumn("conv_id", F.col("conv_id").cast(kind)))
