"""Chat formatting by schema fingerprints.

A record is a JSON object in any known layout: prompt and response, instruction
with input and output, or a list of messages. The set of its nested field paths
is hashed; the hash selects a declarative mapping, which turns the record into
canonical (role, text) turns. A record with more fields than a mapping names
falls back to the mapping with the most paths among those it contains. The
template then writes each turn as ``### role: text</turn>`` and a line feed, and
gives the spans of assistant texts as the loss mask.

Control strings inside texts are escaped: a backslash comes before each
backslash, ``###`` and ``</turn>`` (in roles before ``:`` too), so that the
formatted text can be read back exactly.

Defined results: null or malformed records and unknown layouts have no turns,
an empty formatted text and ``layout`` null; null texts and roles are empty;
repeated rows are repeated; other columns pass through.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow


@dataclass(frozen=True)
class Mapping:
    """``each``: path of a list of turns, and the names of role and text in it; or ``fields``: (path, role) in order."""

    name: str
    each: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    #: Fields that may be there or not; an absent or empty one gives no turn.
    optional: tuple[tuple[str, str], ...] = ()
    #: Whether role names go through ROLES.
    renames: bool = False

    def paths(self) -> frozenset[str]:
        if self.each:
            head, role, text = self.each
            return frozenset({f"{head}[].{role}", f"{head}[].{text}"})
        return frozenset(p for p, _ in self.fields)


MAPPINGS = (
    Mapping("messages", each=("messages", "role", "content")),
    Mapping("conversations", each=("conversations", "from", "value"), renames=True),
    Mapping("prompt", fields=(("prompt", "user"), ("response", "assistant")), optional=(("system", "system"),)),
    Mapping("completion", fields=(("prompt", "user"), ("completion", "assistant"))),
    Mapping("instruction", fields=(("instruction", "system"), ("input", "user"), ("output", "assistant"))),
    Mapping("question", fields=(("data.question", "user"), ("data.answer", "assistant"))),
)

#: Role names that stand for a canonical one.
ROLES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}


def paths_of(value, at: str = "") -> set[str]:
    """The nested field paths of a JSON value; ``[]`` stands for any element of a list."""
    if isinstance(value, dict):
        return set().union(*[paths_of(v, f"{at}.{k}" if at else k) for k, v in value.items()]) if value else {at}
    if isinstance(value, list):
        return set().union(*[paths_of(v, f"{at}[]") for v in value]) if value else {f"{at}[]"}
    return {at}


def fingerprint(paths) -> int:
    """The hash of a set of field paths."""
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode())


def fitting(record, m: Mapping | None) -> Mapping | None:
    """The mapping, or none if it reads a list in which an element is not an object: the layout is unknown."""
    if m is None or not m.each:
        return m
    rows = _at(record, m.each[0]) or []
    return m if isinstance(rows, list) and all(isinstance(x, dict) for x in rows) else None


class Layouts:
    """Mappings by fingerprint."""

    def __init__(self, mappings=MAPPINGS) -> None:
        self.mappings = mappings
        self.by_print: dict[int, Mapping | None] = {}
        for m in mappings:
            self.by_print[fingerprint(m.paths())] = m

    def select(self, record) -> Mapping | None:
        if not isinstance(record, dict):
            return None
        have = paths_of(record)
        key = fingerprint(have)
        if key not in self.by_print:
            fit = [m for m in self.mappings if m.paths() <= have or m.each and f"{m.each[0]}[]" in have]
            found = max(fit, key=lambda m: (len(m.paths() & have), len(m.paths())), default=None)
            if len(self.by_print) > 10_000:
                return fitting(record, found)
            self.by_print[key] = found
        return fitting(record, self.by_print[key])


def _at(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record, m: Mapping) -> list[tuple[str, str]]:
    """The canonical turns of a record under its mapping."""
    if m.each:
        head, role, text = m.each
        rows = _at(record, head) or []
        names = ROLES if m.renames else {}
        return [(names.get(r := _text(x.get(role)), r), _text(x.get(text))) for x in rows]
    extra = [(role, _text(_at(record, p))) for p, role in m.optional if _at(record, p)]
    return extra + [(role, _text(_at(record, p))) for p, role in m.fields]


def escape(text: str, also: str = "") -> str:
    return re.sub(r"\\|###|</turn>" + (f"|{also}" if also else ""), lambda x: "\\" + x[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans, in code points, of the assistant texts in it."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"### {escape(role, ':')}: ", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "</turn>\n"]
        at += len(head) + len(body) + 8
    return "".join(out), spans


_CONTROL = re.compile(r"\\.|</turn>\n|: ", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, read back from its unescaped control strings."""
    turns, at, role = [], 0, None
    for x in _CONTROL.finditer(formatted):
        if x[0] == ": " and role is None:
            role, at = unescape(formatted[at + 4:x.start()]), x.end()
        elif x[0] == "</turn>\n" and role is not None:
            turns.append((role, unescape(formatted[at:x.start()])))
            role, at = None, x.end()
    return turns


def format_chats(records: DataFrame, record: str = "record", mappings=MAPPINGS) -> DataFrame:
    """``records`` with ``layout``, ``schema_print`` (the fingerprint), ``formatted`` and ``loss_spans``."""
    added = T.StructType([
        T.StructField("layout", T.StringType()), T.StructField("schema_print", T.StringType()), T.StructField("formatted", T.StringType()),
        T.StructField("loss_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    keep = [c for c in records.columns if c not in added.names]
    rows = records.select(*keep)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts = Layouts(mappings)
        for batch in batches:
            names, prints, texts, spans = [], [], [], []
            for raw in batch.column(record).to_pylist():
                try:
                    value = json.loads(raw) if raw is not None else None
                except ValueError:
                    value = None
                m = layouts.select(value)
                text, where = render(turns_of(value, m)) if m else ("", [])
                names.append(m.name if m else None)
                prints.append(f"{fingerprint(paths_of(value)):016x}" if isinstance(value, dict) else None)
                texts.append(text)
                spans.append([{"start": a, "end": b} for a, b in where])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(prints, pa.string()), pa.array(texts, pa.string()), pa.array(spans, span)],
                names=[*batch.schema.names, *added.names])

    return arrow(rows, run, T.StructType([*rows.schema.fields, *added.fields]))


def digests(formatted: DataFrame) -> DataFrame:
    """Digest columns read back from ``formatted`` and ``loss_spans``; keeps ``conv_id``."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, layout string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, text, spans, layout in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans", "layout")]):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                said = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), layout))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "layout"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], names=names)

    return arrow(formatted.select("conv_id", "formatted", "loss_spans", "layout"), run, schema)


def records_from_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, record): rows by turn as JSON records, in the layout that fits the conversation.

    A user and an assistant turn alone make a prompt record, a system, user and
    assistant turn an instruction record, anything else a list of messages. Rows
    with the same turn are ordered by role, then text; none is dropped.
    """
    said = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("t"))
    roles = F.concat_ws(",", F.transform("t", lambda x: x["role"]))
    content = lambda i: F.get("t", F.lit(i))["content"]
    record = (
        F.when((F.size("t") == 2) & (roles == "user,assistant"), F.to_json(F.struct(content(0).alias("prompt"), content(1).alias("response"))))
        .when((F.size("t") == 3) & (roles == "system,user,assistant"), F.to_json(F.struct(content(0).alias("instruction"), content(1).alias("input"), content(2).alias("output"))))
        .otherwise(F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages")))))
    return convs.select("conv_id", record.alias("record"))
