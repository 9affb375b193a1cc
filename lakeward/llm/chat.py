"""Operator 3: chat formatting with schema fingerprints.

A source record is a JSON object in one of several layouts. The nested field paths
that carry conversation (``messages[].role``, ``prompt`` ...) are sorted and hashed;
the hash selects a declarative ``Layout`` that says where turns, roles and texts
are. The canonical turns are laid out with a ``Template`` whose control strings are
escaped in texts reversibly, together with the loss span of every assistant text.

A conversation may be long: turns stay rows, the formatted output is one row per
turn (in order), and reading back streams the sorted rows with running digests, so
no task holds a whole conversation.

Defined results: null or missing text is the empty text, null role the empty role;
turns of equal number are ordered by position in the record, role and text;
repeated rows are repeated turns; a null conversation id is a conversation of its
own; rows whose record is no JSON object or of no known layout come back with
``layout = 'unmapped'``, position -1 and the raw record as text (the query has
none); fields that no layout knows are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import cut, read_table

ASSISTANT = "assistant"


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns: a list of objects, or one field per turn."""
    name: str
    turn_list: str | None = None            # path of the list of turns
    role_field: str = ""
    text_field: str = ""
    role_names: dict = field(default_factory=dict)
    turn_fields: tuple = ()                 # ((field, role), ...) in turn order
    joined: dict = field(default_factory=dict)  # field -> field whose text it is appended to

    def path_sets(self) -> Iterator[tuple[str, ...]]:
        """Every set of known field paths that a record of this layout can have."""
        if self.turn_list:
            # An empty list has no elements, and either field may be missing in all of them.
            inner = [f"{self.turn_list}[].{f}" for f in (self.role_field, self.text_field)]
            for k in range(3):
                for some in itertools.combinations(inner, k):
                    yield (self.turn_list, *some)
            return
        names = [f for f, _ in self.turn_fields] + list(self.joined)
        for k in range(1, len(names) + 1):
            for some in itertools.combinations(names, k):
                if all(self.joined[f] in some for f in some if f in self.joined):
                    yield some

    def turns(self, record: dict) -> list[tuple[str, str]]:
        if self.turn_list:
            out = []
            for t in record.get(self.turn_list) or []:
                role, text = t.get(self.role_field) or "", t.get(self.text_field) or ""
                out.append((self.role_names.get(role, role), text))
            return out
        out = []
        for f, role in self.turn_fields:
            if f in record:
                extra = [record[j] for j, to in self.joined.items() if to == f and record.get(j)]
                out.append((role, "\n\n".join([record[f] or "", *extra])))
        return out


LAYOUTS = (
    Layout("messages", "messages", "role", "content"),
    Layout("from_value", "conversations", "from", "value",
           {"human": "user", "gpt": ASSISTANT}),
    Layout("prompt", turn_fields=(("system", "system"), ("prompt", "user"), ("completion", ASSISTANT))),
    Layout("query", turn_fields=(("query", "user"), ("response", ASSISTANT))),
    Layout("instruction", turn_fields=(("instruction", "user"), ("output", ASSISTANT)),
           joined={"input": "instruction"}),
)


def field_paths(record: dict, known: frozenset[str]) -> tuple[str, ...]:
    """Sorted known paths of a record; list elements are written ``[]``."""
    found: set[str] = set()

    def walk(value, path: str) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                sub = f"{path}.{k}" if path else k
                if sub in known:
                    found.add(sub)
                    walk(v, sub)
        elif isinstance(value, list):
            for v in value:
                walk(v, f"{path}[]")

    walk(record, "")
    return tuple(sorted(found))


def fingerprint(paths: tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def fingerprints(layouts: tuple[Layout, ...] = LAYOUTS) -> tuple[dict[str, Layout], frozenset[str]]:
    """Layout by fingerprint, and all known paths. Layouts must not share a path set."""
    by_print: dict[str, Layout] = {}
    known: set[str] = set()
    for layout in layouts:
        for paths in layout.path_sets():
            known.update(paths)
            if by_print.setdefault(fingerprint(paths), layout) is not layout:
                raise ValueError(f"layout {layout.name} is not told apart by its paths {paths}")
    return by_print, frozenset(known)


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``conv string, turn bigint, record string`` to ``conv, turn, pos, role, text, layout``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_print, known = fingerprints(layouts)
        for pdf in batches:
            out = []
            for conv, turn, raw in zip(pdf["conv"], pdf["turn"], pdf["record"]):
                try:
                    record = json.loads(raw)
                    layout = by_print.get(fingerprint(field_paths(record, known)))
                    turns = layout.turns(record) if layout else None
                except (TypeError, ValueError, AttributeError):
                    turns = None
                if turns is None:
                    out.append((conv, turn, -1, None, raw, "unmapped"))
                else:
                    out.extend((conv, turn, i, role, text, layout.name)
                               for i, (role, text) in enumerate(turns))
            yield pd.DataFrame(out, columns=["conv", "turn", "pos", "role", "text", "layout"])

    return records.select("conv", "turn", "record").mapInPandas(
        run, "conv string, turn string, pos int, role string, text string, layout string")


@dataclass(frozen=True)
class Template:
    """``turn`` role ``text`` body ``end``; every control string is escaped in role and body.

    Escaping puts a backslash behind the first character of a control string (and of
    one that already has backslashes there), so taking one away restores the text.
    """
    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "</s>"
    reserved: tuple = ("<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>",
                       "<|im_end|>", "<|endoftext|>")

    def patterns(self) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
        marks = sorted({self.turn, self.text, self.end, *self.reserved})
        escape = re.compile("|".join(f"{re.escape(m[0])}\\\\*{re.escape(m[1:])}" for m in marks))
        unescape = re.compile("|".join(f"{re.escape(m[0])}\\\\+{re.escape(m[1:])}" for m in marks))
        piece = re.compile(f"{re.escape(self.turn)}(.*?){re.escape(self.text)}(.*){re.escape(self.end)}",
                           re.DOTALL)
        return escape, unescape, piece


def escape(text: str, pattern: re.Pattern) -> str:
    return pattern.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str, pattern: re.Pattern) -> str:
    return pattern.sub(lambda m: m[0][0] + m[0][2:], text)


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """A formatted piece per turn and the code point span of its loss (0, 0: none).

    The text of a conversation is its pieces joined in the order of
    ``turn, pos, role, text``.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        esc, _, _ = template.patterns()
        for pdf in batches:
            pieces, starts, ends = [], [], []
            for role, text in zip(pdf["role"], pdf["text"]):
                role, body = role or "", escape(text or "", esc)
                head = template.turn + escape(role, esc) + template.text
                pieces.append(head + body + template.end)
                learn = role == ASSISTANT
                starts.append(len(head) if learn else 0)
                ends.append(len(head) + len(body) if learn else 0)
            yield pdf[["conv", "turn", "pos"]].assign(
                formatted=pieces, loss_start=starts, loss_end=ends)

    return turns.select("conv", "turn", "pos", "role", "text").mapInPandas(
        run, "conv string, turn string, pos int, formatted string, loss_start bigint, loss_end bigint")


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests per conversation, parsed from the formatted pieces and their loss spans.

    Rows are dealt by conversation and sorted; a task streams them with one running
    digest, so a conversation of any length needs the memory of one batch.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, unesc, piece = template.patterns()
        current, state = None, None

        def closed():
            return (current[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for pdf in batches:
            out = []
            for conv, text, a, b in zip(pdf["conv"], pdf["formatted"], pdf["loss_start"], pdf["loss_end"]):
                key = (conv if isinstance(conv, str) else None,)
                if key != current:
                    if current is not None:
                        out.append(closed())
                    current, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                m = piece.fullmatch(text)
                if m is None:
                    raise ValueError(f"formatted turn of conversation {conv} cannot be read back")
                role, body = unescape(m[1], unesc), unescape(m[2], unesc)
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                if b > a:
                    learned = unescape(text[a:b], unesc)
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            yield pd.DataFrame(out, columns=columns)
        if current is not None:
            yield pd.DataFrame([closed()], columns=columns)

    columns = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    ordered = (formatted.withColumn("turn_no", F.col("turn").cast("decimal(38,0)"))
               .repartition("conv").sortWithinPartitions("conv", "turn_no", "pos", "formatted")
               .drop("turn_no"))
    return ordered.mapInPandas(
        run, "conv string, n_turns bigint, turns_sha256 string, loss_chars bigint, "
             "loss_sha256 string, formatted_chars bigint")


def as_source_records(conversations: DataFrame) -> DataFrame:
    """Conversation rows as JSON records of mixed layouts, as crawled sources deliver them.

    User, assistant and system turns take a layout by a hash of the row; any other
    role needs a layout that names its role.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))

    def obj(**fields):
        return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))

    listed = obj(messages=F.array(F.struct(role.alias("role"), text.alias("content"))))
    named = F.when(role == "user", "human").when(role == ASSISTANT, "gpt").otherwise(role)
    from_value = obj(conversations=F.array(F.struct(named.alias("from"), text.alias("value"))))
    pick = F.pmod(F.xxhash64("conv_id", "turn", "role"), F.lit(5))
    by_field = {
        "user": (obj(prompt=text), obj(query=text), obj(instruction=text)),
        ASSISTANT: (obj(completion=text), obj(response=text), obj(output=text)),
        "system": (obj(system=text), listed, from_value),
    }
    record = listed
    for name, choices in by_field.items():
        one = F.when(pick == 0, choices[0]).when(pick == 1, choices[1]).when(
            pick == 2, choices[2]).when(pick == 3, from_value).otherwise(listed)
        record = F.when(role == name, one).otherwise(record)
    return conversations.select(F.col("conv_id").cast("string").alias("conv"),
                                F.col("turn").cast("string").alias("turn"), record.alias("record"))


def chat_digests(conversations: DataFrame) -> DataFrame:
    formatted = cut(format_turns(canonical_turns(as_source_records(conversations))), "chat")
    return read_back(formatted)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, ASSISTANT, said)], table.schema)
    id_type = table.schema["conv_id"].dataType
    return chat_digests(table.unionByName(extra)).select(
        F.col("conv").cast(id_type).alias("conv_id"), "n_turns", "turns_sha256", "loss_chars",
        "loss_sha256", "formatted_chars")


def _sql() -> str:
    t = Template()
    controls = t.patterns()[0].pattern.replace("'", "''")
    extra = len(t.turn) + len(t.text) + len(t.end)
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({extra} + length(role) + length(text) + len(regexp_extract_all(role, '{controls}'))
           + len(regexp_extract_all(text, '{controls}'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


SQL = _sql()
