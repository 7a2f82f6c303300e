"""Secrets in text: fixed patterns, and literals that are assigned to sensitive names in source or configuration."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from math import log2
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import pick, ship, whole_text

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "lexed")

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16

NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
HEX_ONLY = bytes(49 if chr(i) in "0123456789abcdef" else 48 for i in range(256))
HEX_RUN = b"1" * HEX_LENGTH

#: What a part of a target name adds to the score of its literal.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "secrets": 1.0, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "token": 0.8, "auth": 0.6, "private": 0.5, "access": 0.4, "api": 0.4,
    "signing": 0.4, "encryption": 0.4, "key": 0.4, "pass": 0.6, "salt": 0.5, "cookie": 0.4, "session": 0.4,
}
#: Name parts that say that a value is about a secret and not the secret.
NAME_EXCUSES = {"length", "len", "size", "count", "name", "file", "path", "url", "type", "hint", "prompt", "label", "field", "min", "max"}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|change_?me|example|placeholder|none|null|true|false|todo|your[-_ ].*|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|test|dummy|redacted)$")
THRESHOLD = 1.3
LEAST_LITERAL = 8

TOKEN = re.compile(
    r"""(?P<line>\n\s*+)|(?P<text>["'])"""
    r"""|(?P<put>:[ \t]++[|>][-+0-9]*+(?=[ \t\r]*+\n)|:=|=>|\+=|[=:](?![=:]))"""
    r"""|(?P<sub>(?<=[\w\])])\[[ \t]*+(?:"[^"\\\n]*+"[ \t]*+|'[^'\\\n]*+'[ \t]*+|[^\[\]"'\n]*+)\])"""
    r"""|(?P<join>\\\r?\n)|(?P<word>[^\s"'=:+,;(){}\[\]<>#]++)"""
    r"""|(?P<plus>\+)|(?P<open>[({\[])|(?P<close>[)}\]])|(?P<end>[,;<>#])|(?P<other>[^\s])"""
)
#: The rest of a quoted text, after the quote that begins it.
QUOTED = {q: re.compile(rf"[^{q}\\\n]*+(?:\\.[^{q}\\\n]*+)*+{q}") for q in "\"'"}
SIGN = re.compile("[=:]")
LINE_ENDS = re.compile(r"[ \t]*+[,;]?+[ \t\r]*+(?:\n|\Z)")
OPENS = {")": "(", "]": "[", "}": "{"}
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
NAME = re.compile(r"[A-Za-z_$][\w$.-]*$", re.ASCII)
KEEP_NAME = re.compile(r"[\w$.-]+", re.ASCII)


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Matches of the three patterns, leftmost and without overlap within a kind; failing matches are dropped."""
    raw = text.encode()
    lowered = raw.lower()
    found = []
    if any(name in lowered for name in NAMES):
        found += [Span("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if b"AKIA" in raw:
        found += [Span("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    if HEX_RUN in raw.translate(HEX_ONLY):
        found += [Span("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LENGTH]
    return found


class Literal(NamedTuple):
    start: int
    end: int
    value: str


#: Values of up to so many characters are kept as text; of longer ones only what their score needs.
SHORT = 64
#: Characters counted apart; others share the counts of 128 more.
COUNTED = 256
#: A sum longer than this counts as this long: names can double their value on every line.
LONGEST = 1e30
KIND_SIGNS = [re.compile(p) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")]
SPACE = re.compile(r"\s")


def counted(text: str) -> np.ndarray:
    if text.isascii():
        return np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=COUNTED).astype(np.float32)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(np.where(points < 128, points, 128 + points % 128), minlength=COUNTED).astype(np.float32)


class Value:
    """A literal or a sum of values, with what its score needs. Sums share their parts, so adding costs the same at any length."""

    __slots__ = ("parts", "literal", "end", "length", "text", "counts", "kinds", "blank", "excused", "shared", "listed")

    def __init__(self, parts: tuple[Value, ...], literal: Literal | None, end: int):
        self.parts, self.literal, self.end = parts, literal, end
        self.length, self.text, self.counts, self.kinds = 0.0, None, None, 0
        self.blank = self.excused = self.shared = self.listed = False

    @classmethod
    def of(cls, literal: Literal) -> Value:
        out = cls((), literal, literal.end)
        out._read(literal.value)
        return out

    def _read(self, text: str) -> None:
        self.length, self.blank, self.excused = float(len(text)), SPACE.search(text) is not None, PLACEHOLDER.match(text) is not None
        self.kinds = sum(1 << i for i, sign in enumerate(KIND_SIGNS) if sign.search(text))
        if len(text) <= SHORT:
            self.text = text
        else:
            self.counts = counted(text)

    @classmethod
    def sum(cls, parts: list[Value]) -> Value:
        """The sum of values; the first one's counts are taken over if nothing else uses it."""
        if len(parts) == 1:
            return parts[0]
        out = cls(tuple(parts), None, parts[-1].end)
        length = sum(p.length for p in parts)
        if length <= SHORT:
            out._read("".join(p.text for p in parts))
            return out
        out.length, out.blank, out.excused = length, any(p.blank for p in parts), all(p.excused for p in parts)
        first = parts[0]
        if first.counts is None:
            out.counts = counted(first.text)
        elif first.shared or any(p is first for p in parts[1:]):
            out.counts = first.counts.copy()
        else:
            out.counts, first.counts = first.counts, None
        for p in parts[1:]:
            out.counts += counted(p.text) if p.counts is None else p.counts
        for p in parts:
            out.kinds |= p.kinds
        if out.length > LONGEST:
            out.counts *= np.float32(LONGEST / 1e10 / out.length)
            out.length = LONGEST / 1e10
        return out

    def score(self) -> float:
        """Up to 1: variety of characters and their entropy; short, blank and placeholder values score below zero."""
        if self.length < LEAST_LITERAL or self.excused or self.blank:
            return -2.0
        numbers = np.array(list(Counter(self.text).values()), float) if self.counts is None else self.counts[self.counts > 0]
        entropy = -sum(p * log2(p) for p in (numbers / self.length).tolist())
        return 0.2 * min(self.kinds.bit_count(), 3) + min(entropy, 4.0) / 10

    def new_literals(self) -> Iterator[Literal]:
        """Literals of the value, in order, that no call has named before."""
        stack = [self]
        while stack:
            value = stack.pop()
            if value.listed:
                continue
            value.listed = True
            if value.literal is not None:
                yield value.literal
            stack.extend(reversed(value.parts))


class Pair(NamedTuple):
    name: str
    value: Value


def pairs(text: str) -> Iterator[Pair]:
    """Name-literal pairs in order, with constants put in place of their names.

    Understands ``name = "v"``, ``name: v``, ``"name": "v"``, ``name := v``, ``name => v``, ``name="v"`` in tags and
    calls, ``+=``, sums of literals and names, ``x["name"] = "v"`` and ``name: type = "v"`` (a pair for either word).
    A bare word is a literal unless it names a constant that was set before. Values may stand on later lines: after a
    sign, around a plus, in brackets (each item is a value), in indented blocks and lists; a bare word does so if it is
    alone on a more indented line. A name in a block or braces below a sensitive name is put behind that name. One pass
    over the tokens; lines without ``=`` or ``:`` are left out while nothing is open. Names keep their last value.

    Time and memory grow with the length of the text, whatever is in it: values share their parts, each quote is looked
    for once, and no pattern goes back. A pair holds at the time it is yielded; its value may be extended afterwards.
    """
    return _Lexer(text).run()


class _Lexer:
    def __init__(self, whole: str):
        self.whole = whole
        self.found: list[Pair] = []
        self.constants: dict[str, Value] = {}
        self.unclosed = {q: -1 for q in QUOTED}  # up to where on this line no text in such quotes ends
        self.brackets: list[tuple[str, str | None, bool]] = []  # sign, sensitive name above, whether it groups a value
        self.depth = dict.fromkeys("([{", 0)
        self.blocks: list[tuple[int, str | None]] = []  # indent of a key with lines below it, sensitive name
        self.indent, self.fresh = 0, True  # of this line; whether no token of it was read
        self.name: list[str] | None = None  # parts of the name that ends with the last token, if a sign may follow
        self.name_start, self.leads = 0, False  # where it is; whether it begins its line
        self.noted: str | None = None  # the name before a colon on this line, which a type may follow
        self.angles = 0
        self.drop()

    def drop(self) -> None:
        """No target is open."""
        self.target: str | None = None
        self.alias: str | None = None
        self.above: str | None = None
        self.sign, self.key, self.target_indent, self.group = "", False, 0, 0
        self.wants, self.crossed = False, False  # a value is due; it is due since an earlier line
        self.value: list[Value] = []
        self.spare: list[Value] = []  # the value if no other comes, as in ``a: b=``
        self.last = 0  # parts before the newest part of the value

    def put_value(self) -> None:
        value = self.value or self.spare
        if self.target is None or not value:
            return
        whole = self.constants[self.target] = self.put_constant(value)
        self.found.append(Pair(self.target, whole))
        if self.above is not None:
            self.found.append(Pair(f"{self.above}.{self.target}", whole))
        if self.alias is not None and self.value:
            self.found.append(Pair(self.alias, whole))

    def put_constant(self, value: list[Value]) -> Value:
        held = self.constants.get(self.target) if self.sign == "+=" else None
        return Value.sum(value if held is None else [held, *value])

    def finish(self) -> None:
        self.put_value()
        self.drop()

    def run(self) -> Iterator[Pair]:
        at = self.skip(0)
        while m := TOKEN.search(self.whole, at):
            kind, at = m.lastgroup, m.end()
            if kind == "line":
                self.line(m)
                if self.target is None and self.name is None and not self.brackets and not self.blocks:
                    at = self.skip(at)
                yield from self.taken()
                continue
            if kind == "text":
                end = self.closing(m[0], at)
                if end is None:
                    self.sign_(m[0], "other")
                else:
                    self.part(Literal(at, end - 1, self.whole[at : end - 1]), "text", m.start(), end)
                    at = end
            elif kind == "word":
                self.part(Literal(m.start(), at, m[0]), kind, m.start(), at)
            elif kind == "put":
                self.put(m)
            elif kind == "sub":
                self.subscript(m)
            elif kind == "plus":
                if self.target is not None and not self.wants:
                    self.wants, self.crossed = True, False
                else:
                    self.finish()
                self.name = None
            elif kind == "open":
                self.open(m[0])
            elif kind == "close":
                self.close(OPENS[m[0]])
            elif kind != "join":
                self.sign_(m[0], kind)
            self.fresh = False
            if self.found:
                yield from self.taken()
        self.finish()
        yield from self.taken()

    def taken(self) -> list[Pair]:
        found, self.found = self.found, []
        return found

    def closing(self, quote: str, at: int) -> int | None:
        """End of the text that a quote before ``at`` begins.

        Where one is not closed on its line, no later one is: what follows is read in the same steps from there.
        """
        if at <= self.unclosed[quote]:
            return None
        if m := QUOTED[quote].match(self.whole, at):
            return m.end()
        end = self.whole.find("\n", at)
        self.unclosed[quote] = len(self.whole) if end < 0 else end
        return None

    def skip(self, at: int) -> int:
        """The line of the next sign, or the one before it if the sign begins the line."""
        sign = SIGN.search(self.whole, at)
        if sign is None:
            return len(self.whole)
        begin = max(at, self.whole.rfind("\n", at, sign.start()) + 1)
        if begin > at and not self.whole[begin : sign.start()].strip():
            begin = max(at, self.whole.rfind("\n", at, begin - 1) + 1)
        if begin > at:
            head = self.whole[begin : sign.start()]
            self.indent, self.fresh = len(head) - len(head.lstrip()), True
        return begin

    def line(self, m: re.Match) -> None:
        at = m.end()
        self.indent, self.fresh = len(m[0]) - m[0].rfind("\n") - 1, True
        self.noted, self.angles = None, 0
        listed_ = self.whole.startswith(("- ", "-\t"), at)
        while self.blocks and (self.blocks[-1][0] > self.indent or (self.blocks[-1][0] == self.indent and not listed_)):
            self.blocks.pop()
        if self.target is not None and self.wants:
            below = self.indent > self.target_indent or (listed_ and self.indent == self.target_indent)
            if self.key and not self.value and not self.group and not self.crossed and below:
                self.blocks.append((self.target_indent, self.sensitive(self.target, self.above)))
            self.crossed = True
        elif self.target is not None and not self.group and (not self.whole.startswith("+", at) or self.whole.startswith("+=", at)):
            self.finish()
        if self.whole[at : at + 1] not in ("=", ":"):
            self.name = None

    def sensitive(self, name: str, above: str | None) -> str | None:
        if name_score(name):
            return name
        return above if above is not None and name_score(f"{above}.{name}") else None

    def part(self, found: Literal, kind: str, start: int, end: int) -> None:
        """A literal or a word: a part of the value, or what a sign may follow."""
        if self.fresh and kind == "word" and found.value == "-" and self.whole[end : end + 1] in (" ", "\t"):
            self.finish()
            if self.blocks and self.blocks[-1][1] is not None:
                self.target, self.sign, self.wants = self.blocks[-1][1], ":", True
                self.target_indent = self.indent
            self.indent += 2
            self.name, self.leads = None, True
            return
        leads = self.fresh or (self.leads and self.name is None)
        if self.target is not None and (self.wants or (self.group and kind == "text" and self.value)):
            known = self.constants.get(found.value) if kind == "word" else None
            far = kind == "word" and known is None and self.crossed and not self.group
            if far and not (self.indent > self.target_indent and (self.key or self.sign != ":") and LINE_ENDS.match(self.whole, end)):
                self.finish()
            else:
                self.last = len(self.value)
                if known is not None:
                    known.shared = True
                self.value.append(Value.of(found) if known is None else known)
                self.wants = self.crossed = False
        elif self.target is not None:
            self.finish()
        word = found.value if kind == "text" else found.value.strip("\"'")
        self.name, self.name_start, self.leads = [word] if NAME.match(word) else None, start, leads

    def subscript(self, m: re.Match) -> None:
        inner = m[0][1:-1].strip()
        quoted = inner[:1] in ("'", '"')
        if not quoted and inner[:1] == ":":
            inner, quoted = inner[1:], True
        if quoted and NAME.match(inner := inner.strip("\"'")):
            if self.name is None or name_score(inner):
                self.name = [inner]
            else:
                self.name.append(inner)
        if self.target is not None and not self.wants and self.value and self.value[-1].end >= self.name_start:
            del self.value[self.last :]  # an element, or a type with parameters, is no literal

    def put(self, m: re.Match) -> None:
        sign = m[0]
        name, self.name = None if self.name is None else ".".join(self.name), None
        if name is None:
            if sign == "=" and self.noted is not None:  # a type that does not end in a word
                self.drop()
                self.target, self.sign, self.wants = self.noted, "=", True
                self.target_indent, self.noted = self.indent, None
            elif self.target is not None and not self.wants:
                self.finish()
            return
        spare: list[Value] = []
        if self.target is not None and self.value and self.value[-1].end > self.name_start:
            spare = self.value[self.last :]  # what looked like the value is the next name, as in ``a: b: c``
            del self.value[self.last :]
        typed = sign == "=" and self.noted is not None and not self.group
        only = not self.value
        self.spare = []
        self.finish()
        self.wants, self.sign, self.target_indent = True, sign.split()[0], self.indent
        above = self.brackets[-1][1] if self.brackets else None
        if above is None and self.blocks and self.sign == ":" and self.leads:
            above = self.blocks[-1][1]
        if typed:
            self.target, self.alias, self.spare, self.noted = self.noted, name, spare if only else [], None
        else:
            self.target, self.key = name, self.sign == ":" and self.leads
            if above is not None and not name_score(name):
                self.above = above
            if self.sign == ":":
                self.noted = name

    def open(self, sign: str) -> None:
        holds = self.target is not None and self.wants
        if holds or self.brackets:
            above = self.sensitive(self.target, self.above) if holds else self.brackets[-1][1]
            self.brackets.append((sign, above, holds and sign != "{"))
            self.depth[sign] += 1
        if not holds or sign == "{":
            self.finish()
        else:
            self.group += 1
        self.name, self.noted = None, None if sign == "{" else self.noted

    def close(self, sign: str) -> None:
        grouped = False
        if self.depth[sign]:
            while True:
                top, _, grouped = self.brackets.pop()
                self.depth[top] -= 1
                if grouped:
                    self.group = max(0, self.group - 1)
                if top == sign:
                    break
        if not grouped or self.target is None:
            self.finish()
        else:
            self.wants = False
        if sign != "[":
            self.noted = None
        self.name = None

    def sign_(self, sign: str, kind: str) -> None:
        """Any other sign ends a value; a comma in brackets ends one item of it."""
        self.angles = max(0, self.angles + (sign == "<") - (sign == ">"))
        if sign == ";" or (sign == "," and not self.angles):
            self.noted = None
        if self.target is not None and self.group and sign == ",":
            self.put_value()
            self.value, self.spare, self.last, self.wants, self.crossed = [], [], 0, True, False
        else:
            self.finish()
        if kind != "other":
            self.name = None


@lru_cache(4096)
def name_score(name: str) -> float:
    parts = [p.lower() for p in PART.findall(name)]
    if not parts or parts[-1] in NAME_EXCUSES:
        return 0.0
    return sum(NAME_WEIGHTS.get(p, 0.0) for p in dict.fromkeys(parts))


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and the literals that the assignments add; a literal inside a base span is not added."""
    base = base_spans(text)
    if "=" not in text and ":" not in text:
        return base, []
    added = {}
    for pair in pairs(text):
        weight = name_score(pair.name)
        if weight and weight + pair.value.score() >= THRESHOLD:
            added.update((Span("lexed", x.start, x.end), None) for x in pair.value.new_literals() if x.end > x.start)
    ordered = sorted(base, key=lambda b: b.start)
    starts, reach = [b.start for b in ordered], [0, *accumulate((b.end for b in ordered), max)]
    return base, [s for s in added if reach[bisect_right(starts, s.start)] < s.end]


def listed(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in order)


def redacted(text: str, mark: str = "[REDACTED]") -> str:
    """The text with every run of overlapping spans put as ``mark``."""
    base, added = all_spans(text)
    out, at = [], 0
    for span in sorted(base + added, key=lambda s: s.start):
        if span.start >= at:
            out += [text[at : span.start], mark]
        at = max(at, span.end)
    return "".join([*out, text[at:]])


def find_secrets(text: Column) -> Column:
    """Struct (n_assign, n_access, n_hex, n_lexed, base, spans) of a text column without NULL."""

    @F.pandas_udf("n_assign bigint, n_access bigint, n_hex bigint, n_lexed bigint, base string, spans string")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, added = all_spans(text)
            count = [sum(s.kind == kind for s in base) for kind in KINDS[:3]]
            rows.append((*count, len(added), listed(base), listed(base + added)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_lexed", "base", "spans"])

    return run(text)


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts per kind, the base spans and all spans as text.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. Whole texts are read; NULL
    counts as empty and has no spans. Rows are independent, so repeated rows repeat their result, without a shuffle.
    """
    ship(docs.sparkSession)
    source = pick(docs, doc_id=doc_id, text=whole_text(text))
    return source.select("doc_id", find_secrets(F.col("text")).alias("found")).select("doc_id", "found.*")


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All rows and columns, with secrets put as ``[REDACTED]`` and ``length`` (if there is one) counted anew.

    NULL texts stay NULL; texts without secrets stay as they are, with the length that they came with.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redacted(t))

    names, mark = docs.columns, "__redacted"
    out = docs.withColumn(mark, run(F.col(text).cast("string")))
    if length in names:
        changed = ~F.col(mark).eqNullSafe(F.col(text))
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(changed, F.char_length(mark).cast(kind)).otherwise(F.col(length)))
    return out.withColumn(text, F.col(mark)).select(*names)
