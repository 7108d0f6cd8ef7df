"""Operator 10: chat formatting of records of many layouts, chosen by schema fingerprint.

A record is a JSON object. Its fingerprint is a hash of its sorted nested
field paths (array elements as ``[]``, values by their kind), so records of one
layout share it whatever their texts. A declarative mapping names where a
layout keeps its turns; mappings are looked up by fingerprint, so choosing one
costs a hash of the paths and a dictionary access. The canonical form is a
list of (role, text) turns.

The template writes each turn as ``<turn>role LF text</turn> LF``. In roles and
texts ``&`` becomes ``&amp;`` and ``<`` becomes ``&lt;`` (and a line end within
a role ``&#10;``), so no text can hold a control string, and ``read_turns``
restores every text exactly. The loss mask lists the code-point spans of the
texts that the model is to learn.

Rows and ties. A null text or role is empty. A record that is null, no JSON
object or of an unknown layout has null turns, with its fingerprint, and is
formatted as null. Empty tables give empty results. Other columns pass through.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

OPEN, CLOSE = "<turn>", "</turn>\n"
TURNS = "array<struct<role:string,text:string>>"


# --- fingerprints and mappings ------------------------------------------------

def paths(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value; null counts as a text, so that absent texts keep the layout."""
    if isinstance(value, dict):
        return set().union({f"{at}{{}}"}, *(paths(v, f"{at}.{k}") for k, v in value.items()))
    if isinstance(value, list):
        return set().union({f"{at}[]"}, *(paths(v, f"{at}[]") for v in value))
    kind = "n" if isinstance(value, (int, float)) and not isinstance(value, bool) else "b" if isinstance(value, bool) else "s"
    return {f"{at}:{kind}"}


def fingerprint(value) -> str:
    """16 hex digits over the sorted paths of a record."""
    from xxhash import xxh64_hexdigest

    return xxh64_hexdigest("\n".join(sorted(paths(value))).encode("utf-8", "surrogatepass"))


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    Either ``turns`` names an array whose elements have ``role`` and ``text``
    (roles may be renamed by ``roles``), or ``fields`` lists (role, field names)
    in order, where the non-empty fields of one turn are joined by a blank line.
    ``optional`` fields may be absent; a turn without any present field is left out.
    """

    name: str
    turns: str = ""
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()

    def samples(self) -> list[dict]:
        """A record of every variant of the layout, from which its fingerprints follow."""
        if self.turns:
            return [{self.turns: [{self.role: "", self.text: ""}]}, {self.turns: []}]
        every = [f for _, fs in self.fields for f in fs]
        out = []
        for bits in range(1 << len(self.optional)):
            absent = {f for i, f in enumerate(self.optional) if bits >> i & 1}
            out.append({f: "" for f in every if f not in absent})
        return out

    def read(self, record: dict) -> list[tuple[str, str]]:
        if self.turns:
            rename = dict(self.roles)
            pairs = [(t[self.role] or "", t[self.text] or "") for t in record[self.turns]]
            return [(rename.get(r, r), x) for r, x in pairs]
        out = []
        for role, names in self.fields:
            present = [record[n] or "" for n in names if n in record]
            if present:
                out.append((role, present[0] if len(present) == 1 else "\n\n".join(p for p in present if p)))
        return out


#: Layouts in use; a role that a layout spells in its own way is renamed.
MAPPINGS = [
    Mapping("messages", turns="messages"),
    Mapping("messages-text", turns="messages", text="text"),
    Mapping("turns", turns="turns", text="text"),
    Mapping("dialogue", turns="conversations", role="from", text="value",
            roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("completion", fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("response", fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
            optional=("system",)),
    Mapping("question", fields=(("user", ("question",)), ("assistant", ("answer",)))),
    Mapping("instruction", fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
            optional=("system", "input")),
]


@dataclass
class Registry:
    """Mappings by fingerprint."""

    mappings: list[Mapping] = field(default_factory=lambda: list(MAPPINGS))

    def __post_init__(self) -> None:
        self.known = {fingerprint(s): m for m in reversed(self.mappings) for s in m.samples()}

    def canonical(self, text: str | None) -> tuple[str | None, str | None, list[dict] | None]:
        """(fingerprint, name of the layout, turns) of a JSON text."""
        try:
            record = json.loads(text) if text is not None else None
        except ValueError:
            return None, None, None
        if not isinstance(record, dict):
            return None, None, None
        mark = fingerprint(record)
        m = self.known.get(mark)
        if m is None:
            return mark, None, None
        return mark, m.name, [{"role": r, "text": x} for r, x in m.read(record)]


def _no_clash(df: DataFrame, results: list[str]) -> None:
    clash = {c.lower() for c in df.columns} & set(results)
    if clash:
        raise ValueError(f"columns are named like results: {sorted(clash)}")


def canonical_turns(records: DataFrame, column: str = "record", mappings: list[Mapping] | None = None) -> DataFrame:
    """``records`` with schema_hash, layout and turns (role, text) from its JSON ``column``; columns of these names are refused."""
    _no_clash(records, ["schema_hash", "layout", "turns"])
    ship(records.sparkSession)
    chosen = list(mappings or MAPPINGS)
    at = records.columns.index(column)
    schema = T.StructType([*records.schema.fields, T.StructField("schema_hash", T.StringType()),
                           T.StructField("layout", T.StringType()),
                           T.StructField("turns", T.ArrayType(T.StructType([
                               T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        registry = Registry(chosen)
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            got = [registry.canonical(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string()),
                 pa.array([g[2] for g in got], kind)], [*batch.schema.names, "schema_hash", "layout", "turns"])

    return records.mapInArrow(run, schema)


# --- template --------------------------------------------------------------------

def _escaped(text: str, role: bool = False) -> str:
    out = f"replace(replace(coalesce({text}, ''), '&', '&amp;'), '<', '&lt;')"
    return f"replace({out}, '\\n', '&#10;')" if role else out


def _restored(text: str) -> str:
    return f"replace(replace(replace({text}, '&#10;', '\\n'), '&lt;', '<'), '&amp;', '&')"


def format_turns(df: DataFrame, learn: str = "assistant") -> DataFrame:
    """``df`` (with turns) with formatted (text) and loss_spans (start from 0, length; code points); columns of
    these names are refused."""
    _no_clash(df, ["formatted", "loss_spans"])
    pieces = (f"transform(turns, t -> named_struct('head', concat('{OPEN}', {_escaped('t.role', True)}, '\\n'), "
              f"'body', {_escaped('t.text')}, 'learn', coalesce(t.role, '') = '{learn}'))")
    close = "</turn>\\n"
    spans = ("aggregate(__lw_pieces, named_struct('at', 0, 'spans', CAST(array() AS array<struct<start:int,length:int>>)), "
             "(a, p) -> named_struct('at', a.at + length(p.head) + length(p.body) + "
             f"{len(CLOSE)}, 'spans', IF(p.learn, "
             "concat(a.spans, array(named_struct('start', a.at + length(p.head), 'length', length(p.body)))), a.spans)), "
             "a -> a.spans)")
    return (df.withColumn("__lw_pieces", F.expr(pieces))
            .withColumn("formatted", F.expr(
                f"array_join(transform(__lw_pieces, p -> concat(p.head, p.body, '{close}')), '')"))
            .withColumn("loss_spans", F.expr(spans)).drop("__lw_pieces"))


def read_turns(formatted: str = "formatted") -> Column:
    """The turns of a formatted text, restored."""
    parts = f"transform(slice(split({formatted}, '</turn>\\n'), 1, size(split({formatted}, '</turn>\\n')) - 1), " \
            f"p -> substring(p, {len(OPEN) + 1}))"
    return F.expr(f"transform({parts}, p -> named_struct('role', {_restored("substring_index(p, '\\n', 1)")}, "
                  f"'text', {_restored("substring(p, locate('\\n', p) + 1)")}))")


def read_loss(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, restored, nothing between."""
    part = f"substring({formatted}, s.start + 1, s.length)"
    return F.expr(f"array_join(transform({spans}, s -> {_restored(part)}), '')")
