"""Secrets in texts: fixed patterns, and an assignment-aware lexer.

Base spans come from three patterns. The lexer reads every line that holds an assignment
mark, in source, configuration, shell, JSON and YAML notations, and turns it into pairs of a
name and a literal; so do calls with a name and a literal (``define('NAME', 'value')``),
options (``--name value``), XML elements and the indented blocks of YAML. Literals are strings
in quotes, joined with ``+`` or by standing next to each other, bare words, and names: constants
are propagated through the text, from the last binding above or else the first below; a name
that is bound nowhere is an unknown part of its value. A pair whose name has sensitive parts is
scored by them and by the look of its value (length, classes of characters, entropy); a
reference, a placeholder or a plain word is not a secret. The places of its literals, wherever
they stand, are added as spans of kind ``pair`` unless a base span already covers them.

Defined cases: a null text counts as empty; rows are independent of each other, so repeated
rows give equal results; extra columns pass through, but for those named like added columns,
which are replaced. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.textops import per_chunk

# The base patterns.
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
_LEAST = {"assign": 8, "access": 16, "hex": 32}

# A run shorter than the least length fails, and no match starts inside a failed run.
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")

#: Parts of names that call for secrecy, and what they weigh.
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 2.5, "secret": 3.0, "token": 2.5,
    "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "private": 1.5, "key": 1.5, "auth": 1.5,
    "access": 1.0, "signature": 1.5, "bearer": 2.5, "salt": 1.5, "dsn": 1.5, "jwt": 2.0,
    "passcode": 2.5, "pin": 1.0,
}
#: Parts that make a name harmless whatever else it holds.
HARMLESS = {"public", "example", "length", "count", "size", "name", "file", "path", "url", "type"}
PLACEHOLDER = re.compile(
    r"(?i)^(?:x+|\*+|\.+|none|null|nil|true|false|undefined|changeme|todo|example.*|your[_-].*"
    r"|<.*>|\$\{.*\}|\$\w+|%\w+%|\{\{.*\}\}|.*(?:getenv|environ).*)$"
)
THRESHOLD = 4.0

_NAME = r"[A-Za-z_$][A-Za-z0-9_$.-]*"
_STRING = r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`"
_TOKEN = re.compile(
    rf"(?P<string>{_STRING})|(?P<option>(?<![\w-])--[A-Za-z][A-Za-z0-9_-]*)|(?P<name>{_NAME})"
    r"|(?P<mark>:=|=>|=|:)|(?P<plus>\+|\.\.)|(?P<comment>#|//|--\x20)"
    r"|(?P<bare>[0-9][A-Za-z0-9+/_=-]*)|(?P<other>[^\s])"
)
_FULL_NAME = re.compile(_NAME)
_BARE = re.compile(r"[^\s\"'`,;()\[\]{}]+")
#: Behind an unknown name: a plus sign and more of the value.
_JOINED = re.compile(r"(?:(?<=\+)|\x20*\+)\x20*(?=[\"'`A-Za-z_$])")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: What a line must hold to be lexed.
_MARK = re.compile(r"[=:]|--[A-Za-z]|[\"'`]\x20*,")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*)(?:\s[^<>\n]*)?>([^<>\n]+)</\1\s*>")
_BLOCK = re.compile(
    rf"^([\x20\t]*)(?:-\x20+)?[\"']?({_NAME})[\"']?\x20*:\x20*[|>][+-]?[0-9]?[+-]?[\x20\t\r]*$",
    re.MULTILINE,
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns by start, then kind."""
    out = [
        ("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= _LEAST["assign"]
    ]
    if "AKIA" in text:
        found = ACCESS.finditer(text)
        out += [("access", *m.span()) for m in found if len(m[0]) >= _LEAST["access"]]
    out += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def name_score(name: str) -> float:
    """Weight of the sensitive parts of a name such as ``dbPassword`` or ``AUTH_TOKEN``."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    if HARMLESS & set(parts):
        return 0.0
    return sum(SENSITIVE.get(p, 0.0) for p in {*parts, *joined})


def value_score(value: str) -> float:
    """0 for words and placeholders, higher for long mixed strings of high entropy."""
    if len(value) < 6 or PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    kinds = sum(
        any(f(c) for c in value)
        for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())
    )
    if kinds < 2:
        return 0.0
    times = Counter(value).values()
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in times)
    return 0.5 * kinds + 0.5 * entropy + min(len(value), 40) / 40


Places = list[tuple[int, int]]


class Lexer:
    """Name-literal pairs of a text, line by line, with the constants bound so far.

    ``below`` holds the first binding of each name in the whole text.
    """

    def __init__(self, text: str, below: dict[str, tuple[str, Places]] | None = None):
        self.text = text
        self.below = below or {}
        self.constants: dict[str, tuple[str, Places]] = {}

    def _value(self, at: int, stop: int) -> tuple[str, Places, int] | None:
        """Value, the places of its literals, and its end; None if nothing of it is known."""
        text, parts, places = self.text, [], []
        last, joinable = at, True
        while m := _TOKEN.search(text, at, stop):
            kind, at = m.lastgroup, m.end()
            if kind == "plus":
                joinable = True
                continue
            if not joinable and kind != "string":
                break
            if kind == "string":
                parts.append(m[0][1:-1])
                places.append((m.start() + 1, m.end() - 1))
            elif kind == "name" and (known := self.constants.get(m[0]) or self.below.get(m[0])):
                parts.append(known[0])
                places += known[1]
            elif kind in ("name", "bare"):
                if text[at : at + 1] in ('"', "'") and len(m[0]) < 3:
                    continue  # the prefix of a string
                bare = _BARE.match(text, m.start(), stop)
                if text[bare.end() : bare.end() + 1] == "(":
                    break  # a call
                if more := _JOINED.match(text, bare.end(), stop):
                    at = more.end()
                    continue  # an unknown part
                if not parts:
                    return bare[0], [bare.span()], bare.end()
            else:
                break
            last, joinable = at, False
        if not parts:
            return None
        return "".join(parts), places, last

    def pairs(self, begin: int, stop: int):
        """(name, value, places) for each assignment of a line, also behind comment signs:
        they stand in URLs and before code that was commented out."""
        text, target, at = self.text, None, begin
        opened = argument = False  # behind a bracket; behind a name in quotes there
        while m := _TOKEN.search(text, at, stop):
            at, kind = m.end(), m.lastgroup
            assigned = kind == "mark" and target is not None
            if kind == "name":
                target = m[0]
            elif kind == "option":
                target = m[0][2:]
                assigned = text[at : at + 1].isspace() and name_score(target) > 0
            elif kind == "string":
                inner = m[0][1:-1]
                target = inner if _FULL_NAME.fullmatch(inner) else None
            elif m[0] == "," and argument:
                after = _TOKEN.search(text, at, stop)
                assigned = after is not None and after.lastgroup == "string"
            elif kind not in ("mark", "plus"):
                target = None
            argument = kind == "string" and opened and target is not None
            opened = m[0] == "("
            if kind == "mark" and text[at : at + 1] == "=":  # a comparison
                at, target = at + 1, None
            elif assigned:
                if found := self._value(at, stop):
                    value, places, end = found
                    self.constants[target.rpartition(".")[2]] = value, places
                    yield target, value, places
                    at = max(at, end + 1)
                target = None
            elif kind == "mark":
                target = None


def is_secret(name: str, value: str) -> bool:
    """Whether name and look together reach the threshold."""
    weight = name_score(name)
    return bool(weight) and (look := value_score(value)) >= 2 and weight + look >= THRESHOLD


def _lines(text: str):
    """Start and end of each line that may hold an assignment."""
    at = 0
    while m := _MARK.search(text, at):
        begin = text.rfind("\n", 0, m.start()) + 1
        end = text.find("\n", m.end())
        at = len(text) if end < 0 else end
        yield begin, at


def _blocks(text: str):
    """(name, value, places) for the lines of each indented block."""
    for m in _BLOCK.finditer(text):
        at = m.end() + 1
        while at < len(text):
            end = text.find("\n", at)
            end = len(text) if end < 0 else end
            line = text[at:end]
            body = line.strip()
            indent = len(line) - len(line.lstrip(" \t"))
            if body and indent <= len(m[1]):
                break
            if body:
                yield m[2], body, [(at + indent, at + indent + len(body))]
            at = end + 1


def pair_spans(text: str) -> list[tuple[str, int, int]]:
    """(pair, start, end) of the literals of secrets, by start."""
    lines, below = list(_lines(text)), {}
    above = Lexer(text)
    for line in lines:
        for name, value, places in above.pairs(*line):
            below.setdefault(name.rpartition(".")[2], (value, places))
    lexer = Lexer(text, below)
    found = [p for line in lines for p in lexer.pairs(*line)]
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            body = m[2].strip()
            start = m.start(2) + len(m[2]) - len(m[2].lstrip())
            found.append((m[1], body, [(start, start + len(body))]))
    found += _blocks(text)
    out = {place for name, value, places in found if is_secret(name, value) for place in places}
    return [("pair", *place) for place in sorted(out)]


def spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans in order of start."""
    base = base_spans(text)
    more = [
        s for s in pair_spans(text) if not any(b[1] <= s[1] and s[2] <= b[2] for b in base)
    ]
    order = (*KINDS, "pair")
    return base, sorted(base + more, key=lambda s: (s[1], order.index(s[0])))


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)
_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (kind, start, end), in code
    points, end exclusive, by start and then kind."""
    carried = [f for f in docs.schema.fields if f.name.lower() not in ("base_spans", "spans")]
    keep = [f.name for f in carried]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in carried]
        + [f"base_spans {_TYPE}", f"spans {_TYPE}"]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [spans(t or "") for t in batch.column(text).to_pylist()]
        named = [[[dict(zip(("kind", "start", "end"), s)) for s in part] for part in row]
                 for row in found]
        columns = {c: batch.column(c) for c in keep}
        columns["base_spans"] = pa.array([row[0] for row in named], _SPANS)
        columns["spans"] = pa.array([row[1] for row in named], _SPANS)
        return pa.RecordBatch.from_pydict(columns)

    wanted = docs.select(*[F.col(f"`{c}`") for c in keep])
    return wanted.mapInArrow(per_chunk(run, text), schema)


def joined(column: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def counted(column: str, kind: str) -> Column:
    return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("bigint")
