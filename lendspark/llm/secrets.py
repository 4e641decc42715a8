"""Secrets in source and configuration text: fixed patterns, and literals
scored by the sensitive names that they are assigned to."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_LEAST = 6
ACCESS, ACCESS_LEAST = re.compile(r"AKIA[A-Z0-9]+"), 20
HEX_LEAST = 24
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)  # runs are whole either way, so the length can be asked for at once
KINDS = ("assign", "access", "hex", "lexed")

#: Parts of a target name and how sensitive each makes it.
NAME_PARTS = {"password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 2.5, "pass": 2.0, "secret": 3.0, "token": 2.5, "credential": 2.5,
              "credentials": 2.5, "apikey": 3.0, "privatekey": 3.0, "accesskey": 3.0, "authkey": 3.0, "signingkey": 3.0, "encryptionkey": 3.0,
              "auth": 1.0, "bearer": 2.0, "key": 1.0, "salt": 1.0, "pin": 1.0}
HARMLESS_PARTS = {"name", "file", "path", "url", "uri", "field", "length", "size", "count", "type", "policy", "expiry", "ttl", "public", "hint", "label", "id"}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|your\W.*|.*change.?me.*|.*example.*|.*placeholder.*|none|null|true|false|undefined|todo.*|<.*>|\$\{.*|\{\{.*)$")
THRESHOLD = 4.0
VALUE_MOST = 4096  # characters of constants that one value may take in; constants stay as written beyond, and in longer bare words

_OPERATOR = re.compile(r"=>|:=|(?<![=!<>+*/%&|^-])=(?![=~])|:(?!:)")
# the name before an operator, read backwards from it: blanks, a type after a colon, a bracket, a quote, then the name
_NAME_REVERSED = re.compile(r"""[ \t]*(?:[\w.<>\[\]]*[A-Za-z_]\s*:\s*)?\]?\s?["'`]?([A-Za-z0-9_$.-]*[A-Za-z_$])""")
_HARMLESS_START = re.compile(r"(?i)your\W|todo")
_HARMLESS_INSIDE = re.compile(r"(?i)change.?me|example|placeholder")
_STRING = re.compile(r"""[rRbBuUfF]{0,2}("(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\]|\\.)*`)""")
_IDENTIFIER = re.compile(r"[A-Za-z_$][A-Za-z0-9_$.]*")
_BARE = re.compile(r"[^\s\"'`,;#<>(){}\[\]]+")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&|\|\|)[ \t]*|[ \t]+(?=[\"'])")
_REFERENCE = re.compile(r"\$\{([A-Za-z_]\w*)\}|\$([A-Za-z_]\w*)|\{([A-Za-z_]\w*)\}|%([A-Za-z_]\w*)%")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """How sensitive a target name is: its parts by case and separators, and neighbours joined (api + key)."""
    parts = [p.lower() for p in _PART.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:])]
    score = max((NAME_PARTS.get(p, NAME_PARTS.get(p.rstrip("s"), 0.0)) for p in parts + joined), default=0.0)
    return score - 2.0 * (parts[-1] in HARMLESS_PARTS if parts else False)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret: length, symbol entropy, kinds of characters; spaces and placeholders count against it."""
    if len(value) < 6 or PLACEHOLDER.match(value):
        return -10.0
    return _symbol_score(len(value), Counter(value))


def _symbol_score(n: int, counts: Counter) -> float:
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    has = lambda f: any(map(f, counts))
    kinds = sum(map(has, (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())))
    return min(n, 32) / 16 + entropy / 2 + 0.5 * (kinds - 1) - 1.5 * has(str.isspace) - 1.5 * all(map(str.isalpha, counts)) - (
        all(map(str.isdigit, counts)) and n < 10)


class _LongWord:
    """The rest of one long bare word from ever later places: its literal_score
    from counts that only lose what is passed, so all operators in the word
    cost its length once."""

    def __init__(self, text: str, start: int, end: int):
        self.text, self.at, self.end = text, start, end
        self.counts = Counter(text[start:end])
        self.harmless = max((m.start() for m in _HARMLESS_INSIDE.finditer(text, start, end)), default=-1)

    def score(self, at: int) -> float:
        self.counts -= Counter(self.text[self.at:at])
        self.at = at
        n, one = self.end - at, next(iter(self.counts), "") if len(self.counts) == 1 else ""
        if n <= VALUE_MOST:
            return literal_score(self.text[at:self.end])
        if self.harmless >= at or _HARMLESS_START.match(self.text, at) or one and one in "xX*.-":
            return -10.0
        return _symbol_score(n, self.counts)


def _value(text: str, at: int, known: dict[str, str], bare: list[int]) -> tuple[str | None, int, int] | None:
    """(constant value, start, end) of the expression at ``at``: string
    literals, names of constants and bare words, joined by concatenation.
    Constants are put in up to VALUE_MOST characters in all, and stay as
    written beyond, so values that double line by line cannot grow without
    end.  bare: [start, end] of the bare run last met, as many operators may
    stand in one run.  A run with more than VALUE_MOST characters left is the
    value as it is written, given as None with its span."""
    out, start, end, room = [], None, at, VALUE_MOST

    def put(name: str, written: str) -> str:
        nonlocal room
        value = known.get(name, written)
        if value is not written and len(value) > room:
            return written
        room -= len(value) if value is not written else 0
        return value

    def reference(r: re.Match) -> str:
        return put(next(g for g in r.groups() if g), r[0])
    while True:
        if m := _STRING.match(text, end):
            body, a, b = m[1][1:-1], m.start(1) + 1, m.end(1) - 1
            out.append(_REFERENCE.sub(reference, body))
            stop = m.end()
        elif (m := _IDENTIFIER.match(text, end)) and m[0] in known:
            out.append(put(m[0], m[0]))
            a, b = m.span()
            stop = b
        elif start is None:
            if not bare[0] <= end < bare[1]:
                m = _BARE.match(text, end)
                bare[:] = m.span() if m else (0, 0)
            if not bare[0] <= end < bare[1]:
                return None
            if bare[1] - end > VALUE_MOST:
                return None, end, bare[1]
            return _REFERENCE.sub(reference, text[end:bare[1]]), end, bare[1]
        else:
            break
        start, last = a if start is None else start, b
        end = stop
        if not (j := _JOIN.match(text, end)):
            break
        end = j.end()
    return ("".join(out), start, last) if start is not None else None


def lexed(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of literals assigned to sensitive names.

    Each assignment operator is read with the name before it and the value
    expression after it; plain constants are kept by name, so a value built
    from earlier names is scored as the text it stands for, at its own place.
    """
    known: dict[str, str] = {}
    out, done, floor, line, bare, long = [], 0, 0, 0, [0, 0], None
    backwards, n = text[::-1], len(text)
    for op in _OPERATOR.finditer(text):
        if op.start() < done:
            continue
        while (newline := text.find("\n", line, op.start())) >= 0:
            line = newline + 1
        first = max(line, floor, done)
        if op[0] != ":":
            floor = op.end()  # a name holds no such operator
        if not (m := _NAME_REVERSED.match(backwards, n - op.start(), n - first)):
            continue
        name, at = m[1][::-1], op.end()
        while at < n and text[at] in " \t":
            at += 1
        if at >= n or not (v := _value(text, at, known, bare)):
            continue
        value, a, b = v
        quoted = text[a - 1:a] in "\"'`"
        if value is None:
            known.pop(name, None)
        elif quoted or op[0] != ":":
            known[name] = value
        if quoted:
            done = b  # an operator inside a string is no assignment
        strength = name_score(name)
        if strength < 2.0:
            continue
        if value is None:
            if long is None or long.end != b or long.at > a:
                long = _LongWord(text, a, b)
            score = strength + long.score(a)
        else:
            score = strength + literal_score(value)
        if score >= THRESHOLD:
            out.append((a, b, name, round(score, 3)))
    return out


def find_secrets(text: str, operators: bool = True, hexes: bool = True) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) in code points, by start, then kind."""
    found = []
    if operators:
        found += [(m.start(), m.end(), "assign", 0.0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
        found += [(a, b, "lexed", s) for a, b, _, s in lexed(text)]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", 0.0) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    if hexes:
        found += [(m.start(), m.end(), "hex", 0.0) for m in HEX.finditer(text)]
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[2]), f[1]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sign, digit = np.zeros(256, bool), np.zeros(256, bool)
    sign[list(b"=:")] = True
    digit[list(b"0123456789abcdef")] = True
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    for batch in batches:
        for i, j, data, offs in chunks(batch.column("text")):
            n, raw = j - i, data.tobytes()
            signs = np.concatenate([[0], np.cumsum(sign[data])])
            has_sign = (signs[offs[1:]] - signs[offs[:-1]] > 0).tolist()
            gap = np.flatnonzero(~digit[data])  # runs of hex digits lie between
            start = np.concatenate([[0], gap + 1])
            long = start[np.concatenate([gap, [len(data)]]) - start >= HEX_LEAST]
            has_hex = np.zeros(n, bool)
            ends = np.concatenate([gap, [len(data)]])[np.searchsorted(start, long)]
            for a, b in zip(long.tolist(), ends.tolist()):  # a run may go on into the next text
                has_hex[np.searchsorted(offs, a, "right") - 1:np.searchsorted(offs, b - 1, "right")] = True
            out = []
            for d in range(n):
                part = raw[offs[d]:offs[d + 1]]
                if has_sign[d] or has_hex[d] or b"AKIA" in part:
                    out.append([{"kind": k, "start": a, "end": b, "score": s}
                                for a, b, k, s in find_secrets(part.decode("utf-8", "replace"), has_sign[d], bool(has_hex[d]))])
                else:
                    out.append([])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, n), pa.array(out, kind)], names=["doc_id", "found"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, found) for each row of docs(doc_id, text, ...): an array of
    (kind, start, end, score) in code points, end exclusive, by start, then kind.

    Kinds assign, access and hex are fixed patterns.  lexed are the literals
    that assignments in source or configuration syntax give to sensitive names,
    with constants propagated within the text (up to VALUE_MOST characters of
    them into one value).  Names and literals of any length are read whole, in
    time linear in the text.  Rows alone, without a shuffle.  Null or empty text has none; repeated rows give
    repeated results; other columns are ignored; an empty table gives no rows.
    """
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_scan, "doc_id long, found array<struct<kind:string,start:long,end:long,score:double>>"))


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) from ``scan_secrets``."""
    spans = lambda xs: F.array_join(F.transform(xs, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    base = F.filter("found", lambda f: f["kind"] != "lexed")
    count = lambda k: F.size(F.filter("found", lambda f: f["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans(base), 256).alias("base_sha256"),
                        spans(F.col("found")).alias("spans"))
