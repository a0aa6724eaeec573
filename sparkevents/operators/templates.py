"""Post templates: text with ``{{...}}`` actions, parsed once and compiled to a column.

Actions: ``.FileName``, ``.FileSize``, quoted text, ``range .Events`` ... ``else`` ... ``end`` with ``.EventText`` and
``.EventSeq`` inside (there ``$.FileName`` reaches the bundle), ``if`` over any of these values (an empty text and the
number 0 do not hold) and comments ``/* */``. ``{{- `` and `` -}}`` take the blanks beside them away. Events are read
once: a second ``range`` finds none. Anything else is a ``ValueError`` when the template is parsed.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\r\n"
QUOTED = r'"(?:\\.|[^"\\\n])*"|`[^`]*`'
ACTION = re.compile(r"\{\{(-(?=\s))?\s*(/\*.*?\*/|(?:" + QUOTED + r"|(?!\}\})[^\"`])*?)\s*((?<=\s)-)?\}\}", re.DOTALL)
BUNDLE_FIELDS = ("FileName", "FileSize")
EVENT_FIELDS = ("EventText", "EventSeq")


@dataclass(frozen=True)
class Node:
    """``text`` and ``field`` hold a value; ``range`` and ``if`` hold two lists of nodes."""

    kind: str
    value: str = ""
    body: tuple[Node, ...] = ()
    other: tuple[Node, ...] = ()


def tokens(template: str) -> list[tuple[bool, str]]:
    """``(is an action, its text)`` in order, blanks trimmed where an action asks for it."""
    out, at, trim = [], 0, False
    for m in ACTION.finditer(template):
        text = template[at : m.start()]
        text = text.lstrip(BLANKS) if trim else text
        out.append((False, text.rstrip(BLANKS) if m.group(1) else text))
        out.append((True, m.group(2)))
        at, trim = m.end(), bool(m.group(3))
    rest = template[at:].lstrip(BLANKS) if trim else template[at:]
    if "{{" in rest or any("{{" in text for action, text in out if not action):
        raise ValueError("an action of the template is not closed")
    return [*out, (False, rest)]


def parse(template: str) -> tuple[Node, ...]:
    """The nodes of a template."""
    # every open block: its kind, its value, the finished body once ``else`` was met, the nodes that are being filled
    open_blocks: list[list] = [["", "", None, []]]
    for action, text in tokens(template):
        block = open_blocks[-1]
        word, _, rest = text.partition(" ")
        if not action:
            if text:
                block[3].append(Node("text", text))
        elif text.startswith("/*"):
            continue
        elif word in ("range", "if"):
            if word == "range" and (rest.strip() not in (".Events", "$.Events") or len(open_blocks) > 1):
                raise ValueError("range goes over .Events, outside of other blocks")
            inside = any(b[0] == "range" and b[2] is None for b in open_blocks)
            value = ".Events" if word == "range" else operand(rest.strip(), inside).value
            open_blocks.append([word, value, None, []])
        elif text == "else" and block[0] and block[2] is None:
            block[2], block[3] = tuple(block[3]), []
        elif text == "end" and block[0]:
            kind, value, body, nodes = open_blocks.pop()
            body, other = (tuple(nodes), ()) if body is None else (body, tuple(nodes))
            open_blocks[-1][3].append(Node(kind, value, body, other))
        else:
            block[3].append(operand(text, any(b[0] == "range" and b[2] is None for b in open_blocks)))
    if len(open_blocks) > 1:
        raise ValueError(f"{open_blocks[-1][0]} has no end")
    return tuple(open_blocks[0][3])


def operand(text: str, inside: bool) -> Node:
    """A quoted text, or a field that exists where it stands."""
    if re.fullmatch(QUOTED, text):
        return Node("text", text[1:-1] if text[0] == "`" else json.loads(text, strict=False))
    name = text.removeprefix("$").removeprefix(".")
    fields = BUNDLE_FIELDS if text.startswith("$") or not inside else EVENT_FIELDS
    if text not in (f".{name}", f"$.{name}") or name not in fields:
        raise ValueError(f"the template has no value {text!r} here")
    return Node("field", name)


def compiled(nodes: tuple[Node, ...], events: Column, **bundle: Column) -> Column:
    """The text of a bundle. ``events`` is an array of ``(event_seq, text)`` in order; ``bundle`` gives the other fields."""
    parts = []
    for node in nodes:
        parts.append(_column(node, bundle, events))
        if node.kind == "range":
            events = F.slice(events, 1, 0)
    return F.concat(*parts) if parts else F.lit("")


def _column(node: Node, values: dict[str, Column], events: Column | None = None) -> Column:
    if node.kind == "text":
        return F.lit(node.value)
    if node.kind == "field":
        return values[node.value].cast("string")
    if node.kind == "if":
        chosen = [_joined(branch, values) for branch in (node.body, node.other)]
        held = values[node.value].cast("string") if node.value in values else F.lit(node.value)
        holds = ~held.isin("", "0") if node.value in ("FileSize", "EventSeq") else held != ""
        return F.when(holds, chosen[0]).otherwise(chosen[1])
    each = F.transform(events, lambda e: _joined(node.body, {**values, "EventText": e["text"], "EventSeq": e["event_seq"]}))
    return F.when(F.size(events) > 0, F.array_join(each, "")).otherwise(_joined(node.other, values))


def _joined(nodes: tuple[Node, ...], values: dict[str, Column]) -> Column:
    return F.concat(*[_column(n, values) for n in nodes]) if nodes else F.lit("")
