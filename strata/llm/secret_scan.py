"""Secret scans: three fixed patterns and an assignment-aware lexer.

The patterns (``assign``, ``access``, ``hex``) give the base spans. The lexer
reads what stands around each ``=`` or ``:`` as source or configuration
syntax: a target name on the left (``name =``, ``name:``, ``"name":``,
``obj.name :=``, ``--name=``), and on the right one or more literals (quoted,
joined by ``+``, or bare) or the name of a constant. Besides, it knows the
pairs of calls (``define("name", "value")``), of XML attributes (``key="name"
value="value"``), of addresses (``//user:password@``), of query strings and of
header lines (``Authorization: Bearer value``). Literals are bound to their
names and follow constants (``a = "x"; password = a``). A literal is scored by
the sensitive words of each name it reaches and by how much it, or what it
is joined to, looks like a made-up value, judged by its first ``HEAD`` code
points; from ``THRESHOLD`` on it is a ``literal`` span, unless a base span
covers it.

Time is in proportion to the text: a bare literal ends where another pair of a
query string or of a sensitive name begins, values are read only when they are
scored, and weights flow through the constants once, backwards.

Spans are in code points, the end exclusive, ordered by start, then kind as
listed in ``KINDS``. Edge cases: a null text counts as empty and has no span;
repeated rows give repeated results; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import pieces, sha256, text_bytes, texts

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 1.0
#: Code points by which a literal's looks are judged.
HEAD = 512

# Fixed patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, as [0-9a-f]+ has them

#: Sensitive words of target names and their weight.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.8,
    "secret": 1.0, "token": 0.9, "credential": 0.9, "credentials": 0.9, "apikey": 1.0,
    "auth": 0.7, "authorization": 0.8, "bearer": 0.8, "signature": 0.6, "salt": 0.5,
}
#: Words that make a "key" sensitive.
KEY_OF = {"api", "access", "private", "secret", "signing", "encryption", "auth", "account", "ssh", "aws", "client"}
DUMMY = re.compile(r"(?i)^(?:x+|\*+|\.+|changeme|example|none|null|nil|true|false|todo|test|your[\w-]*|<.*>|\$\{?.*|%.*%|os\.environ.*|getenv.*)$")

_OPERATOR = re.compile(r"(?<![=!<>:+\-*/%&|^~])(?::=|=>|=(?![=~])|:(?![:/\\]))")
_TARGET = re.compile(r"""(?:^|[\s,;{(\[<&?$@.-]|--)["'`]?([A-Za-z_$][\w$.-]*)["'`]?(?:\[["']([\w.-]+)["']\])?(?:\s*:\s*[A-Za-z_][\w.\[\], ]*)?[ \t]*$""", re.ASCII)
#: The same read backwards from the operator: blanks, annotation, index, name, up to the delimiter or line start.
_TARGET_BACK = re.compile(r"""[ \t]*+(?:[\w.\[\], ]*[A-Za-z_][^\S\n]*:[^\S\n]*)?(?:\]["']([\w.-]+)["']\[)?["'`]?([\w$.-]*[A-Za-z_$])["'`]?(?=[\s,;{(\[<&?$@.-]|\Z)""", re.ASCII)
_NEAR = 160
_LITERAL = re.compile(r'''[ \t]*(?:"""(.*?)"""|"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`|([^\s"'`,;(){}\[\]<>]))''', re.DOTALL)
_BARE = re.compile(r'''[^\s"'`,;(){}\[\]<>]+''')
#: Inside a run of bare characters: the next pair of a query string, or of a sensitive name.
_CUT = re.compile(r"""&(?=[\w.-]{1,64}=)|[^\w\s](?=(?:password|passwd|pwd|passphrase|secret|token|api_?key|credentials?)[=:])""", re.IGNORECASE)
_SCHEME = re.compile(r"(Bearer|Basic|Token|Digest)(?=[ \t]+[^\s\"'`,;(){}\[\]<>])", re.IGNORECASE)
_CALL = re.compile(r"""\(\s{0,80}["']([\w.-]{1,200})["']\s{0,80},\s{0,80}["']([^"'\n]+)["']""", re.ASCII)
_XML = re.compile(r"""\b(?:key|name)\s{0,80}=\s{0,80}["']([\w.:-]{1,200})["']\s{1,80}value\s{0,80}=\s{0,80}["']([^"'\n]+)["']""", re.ASCII)
_ADDRESS = re.compile(r"://[\w.%+-]{0,200}:([^\s:/@\"'<>]+)@")
_NAME = re.compile(r"[A-Za-z_$][\w$.]*\Z", re.ASCII)
_PLUS = re.compile(r"[ \t]*\+")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_weight(name: str) -> float:
    """How sensitive the words of a target name are."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    best = max((SENSITIVE.get(p.rstrip("s") if p.rstrip("s") in SENSITIVE else p, 0.0) for p in parts), default=0.0)
    joined = "".join(parts)
    if "apikey" in joined or ("key" in parts or "keys" in parts) and KEY_OF & set(parts):
        best = max(best, 1.0)
    if parts and parts[-1] in ("name", "length", "len", "type", "count", "file", "path", "url", "field", "id", "hint", "policy", "expires", "expiry", "ttl"):
        best *= 0.4
    return best


def literal_weight(text: str) -> float:
    """0 for placeholders and short values, up to 1 for long mixed ones."""
    if len(text) < 6 or DUMMY.match(text) or any(c.isspace() for c in text):
        return 0.0
    n = len(text)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(text).values())
    kinds = sum(bool(re.search(k, text)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.2 + 0.1 * kinds + entropy / 8 + min(n, 32) / 96)


class _Bare:
    """Ends of bare literals. A run of bare characters is read once; inside it a
    literal ends at the next cut behind its start, less closing punctuation."""

    def __init__(self, text: str):
        self.text, self.cuts, self.run = text, [m.start() for m in _CUT.finditer(text)], (0, 0)
        self.ends: dict[int, int] = {}

    def end(self, at: int) -> int:
        if not self.run[0] <= at < self.run[1]:
            self.run = (at, _BARE.match(self.text, at).end())
        k = bisect_right(self.cuts, at)
        stop = min(self.run[1], self.cuts[k]) if k < len(self.cuts) else self.run[1]
        if stop not in self.ends:
            b = stop
            while b > self.run[0] and self.text[b - 1] in ".!?:":
                b -= 1
            self.ends[stop] = b
        return max(at, self.ends[stop])


def pairs(text: str) -> Iterator[tuple[str, list[tuple[int, int, bool]]]]:
    """(target name, its right side as (start, end, quoted)) in text order."""
    back, bare = "", _Bare(text)
    for m in _OPERATOR.finditer(text):
        i = m.start()
        line = max(text.rfind("\n", max(0, i - _NEAR), i) + 1, i - _NEAR, 0)
        hard = max(text.rfind(c, line, i) for c in ";{(&<?")  # no target reaches over these
        target = _TARGET.search(text[max(line, hard) : i])
        if target:
            name = target[2] or target[1]
        if hard < 0 and (not target or not target.start()) and line and text[line - 1] != "\n":
            back = back or text[::-1]
            target = _TARGET_BACK.match(back, len(text) - i)
            if target:
                name = (target[1] or target[2])[::-1]
        if not target:
            continue
        right, at = [], m.end()
        while x := _LITERAL.match(text, at):
            k = x.lastindex
            a, b = x.span(k)
            if k == 5:
                b = bare.end(a)
                scheme = _SCHEME.match(text, a)
                if scheme and scheme.end(1) == b:
                    at = b
                    continue
            if b > a:
                right.append((a, b, k != 5))
            more = _PLUS.match(text, max(x.end(), b))
            if not more:
                break
            at = more.end()
        if right:
            yield name, right


def _others(text: str) -> Iterator[tuple[str, tuple[int, int]]]:
    """Pairs that no operator joins: calls, XML attributes, addresses."""
    for m in _CALL.finditer(text) if "(" in text else ():
        yield m[1], m.span(2)
    for m in _XML.finditer(text) if "value" in text else ():
        yield m[1], m.span(2)
    for m in _ADDRESS.finditer(text) if "://" in text else ():
        yield "password", m.span(1)


def literals(text: str) -> list[tuple[int, int]]:
    """Spans of literals whose score reaches the threshold."""
    last: dict[str, int] = {}  # constant -> its node
    nodes: list[tuple[list[tuple[int, int]], list[int]]] = []  # literals, constants referred to
    weights: list[float] = []
    for name, right in pairs(text):
        own, refs = [], []
        for a, b, quoted in right:
            ref = None
            if not quoted and b - a <= HEAD and _NAME.match(value := text[a:b]):
                ref = last.get(value, last.get(value.rsplit(".", 1)[-1]))
            if ref is None:
                own.append((a, b))
            elif ref not in refs:
                refs.append(ref)
        last[name] = last[name.rsplit(".", 1)[-1]] = len(nodes)
        nodes.append((own, refs))
        weights.append(name_weight(name))
    for name, span in _others(text):
        nodes.append(([span], []))
        weights.append(name_weight(name))
    score: dict[tuple[int, int], float] = {}
    for k in range(len(nodes) - 1, -1, -1):  # constants come before what refers to them
        own, refs = nodes[k]
        for r in refs:
            weights[r] = max(weights[r], weights[k])
        if weights[k]:
            folded = literal_weight("".join(text[a : min(b, a + HEAD)] for a, b in own)[:HEAD]) if len(own) > 1 else 0.0
            for a, b in own:
                looks = max(folded, literal_weight(text[a : min(b, a + HEAD)]))
                if looks and weights[k] * 0.6 + looks * 0.6 >= THRESHOLD:
                    score[a, b] = looks
    return sorted(score)


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text: (kind, start, end), ordered."""
    operator = "=" in text or ":" in text
    out = [("hex", *m.span()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if operator:
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if operator or "(" in text:
        base = sorted((a, b) for _, a, b in out)
        reach = list(accumulate((b for _, b in base), max))  # of the base spans up to each
        for a, b in literals(text):
            k = bisect_right(base, (a, len(text)))
            if not k or reach[k - 1] < b:
                out.append(("literal", a, b))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redact(text: str, found: list[tuple[str, int, int]], mask: str = "[REDACTED]") -> str:
    """The text with each (merged) span replaced by the mask."""
    out, at = [], 0
    for _, a, b in sorted(found, key=lambda s: s[1:]):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts by base kind, digest of the base spans, all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = [spans(t) for t in texts(b.column("text"))]
            kinds = [Counter(k for k, *_ in f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    *(pa.array([n[k] for n in kinds], pa.int64()) for k in KINDS),
                    pa.array([sha256(joined([s for s in f if s[0] != "literal"])) for f in found], pa.string()),
                    pa.array([joined(f) for f in found], pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"],
            )

    return text_bytes(df, id_col, text_col).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, base_sha256 string, spans string")


def redacted(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the secrets of ``text_col`` masked; all else is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text_col):
            masked = [t if t is None else redact(t, spans(t)) for t in b.column(text_col).to_pylist()]
            i = b.schema.get_field_index(text_col)
            yield b.set_column(i, b.schema.field(i), pa.array(masked, b.schema.field(i).type))

    return df.mapInArrow(run, df.schema)
