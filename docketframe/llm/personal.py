"""Personal data in texts, also when it is disguised, at its place in the source.

Transducers rewrite a text piece by piece (look-alike letters, invisible
characters, spelled digits, "at" and "dot", signs in brackets) and keep, for each character they
write, the source characters it stands for.  The same detectors run on the
source and on what was written; spans of the latter are mapped back.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.llm import arrays

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, number of the kind, end

# -- detectors ----------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Starts inside a run of digits cannot match where its start does not.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_DOTTED = re.compile(r"[0-9]\.[0-9]")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and domain, found from each @ so that long runs cost no more than once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def detect(text: str) -> list[Span]:
    """All spans of a text as it stands, by start and kind."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if _DOTTED.search(text):
        for m in _IP.finditer(text):
            # Leading zeros do not count; four digits more are too many anyway.
            if all(int(part.lstrip("0")[:4] or 0) <= 255 for part in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# -- transducers --------------------------------------------------------------

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТХасеорхуіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧο",
        "ABEKMHOPCTXaceopxyijsdqwABEZHIKMNOPTYXo",
        strict=True,
    )
)
# Forms of Latin letters, digits and signs, by rule: letterlike and circled ones, full-width and mathematical ones.
_FORMS = [*range(0x20A0, 0x2500), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x1F110, 0x1F16A)]
_PLAIN = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in _FORMS}
_LOOKALIKES |= {c: plain for c, plain in _PLAIN.items() if len(plain) == 1 and "!" <= plain <= "~"}
# Full stops of other scripts.
_LOOKALIKES |= dict.fromkeys("․。｡．", ".")
_INVISIBLE = "​‌‍⁠﻿­"


def _char_class(chars: str) -> str:
    """A class of characters, written as ranges: single ones beyond U+FFFF are compared one by one."""
    runs: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in runs) + "]"


_STRANGE = re.compile(_char_class("".join([*_LOOKALIKES, *_INVISIBLE])))
_DIGIT_WORDS = "zero one two three four five six seven eight nine".split()
_DIGITS = {w: str(i) for i, w in enumerate(_DIGIT_WORDS)}
_SPELLED = re.compile(rf"\b(?:{'|'.join(_DIGIT_WORDS)})\b", re.I)
_SPELLED_RUN = re.compile(
    rf"\b(?:(?:{'|'.join(_DIGIT_WORDS)}|[0-9]+)[\x20-]){{4,}}(?:{'|'.join(_DIGIT_WORDS)}|[0-9]+)\b", re.I
)
# A sign in brackets, between blanks, or as it is.
_BRACKETED = r"\x20?[(\[{{<]\x20?(?:{})\x20?[)\]}}>]\x20?"
_AT = rf"(?:{_BRACKETED.format('at|@')}|\x20at\x20|\x20?@\x20?)"
_DOT_WORD = rf"{_BRACKETED.format(r'dot|\.')}|\x20dot\x20"
_DOT = rf"(?:{_DOT_WORD}|\.)"
_AT_SIGN = re.compile(_AT, re.I)
# What every such sign holds, quick to find, and the characters that may stand before it.
_SIGN_CORE = re.compile(r"@|(?<=[\x20(\[{<])[Aa][Tt](?=[\x20)\]}>])")
_BEFORE_CORE = 3
_LOCAL_LABEL = frozenset(_LOCAL - {"."})
_HIDDEN_DOMAIN = re.compile(rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+", re.I)
_DOT_BEFORE = re.compile(rf"(?:{_DOT})\Z", re.I)
#: Characters of the longest form of a dot.
_DOT_CHARS = 9
_DOT_SIGN = re.compile(_DOT, re.I)
_DIGIT_DOT = re.compile(rf"(?<=[0-9])(?:{_DOT_WORD})(?=[0-9])", re.I)
# Every form of a sign that is rewritten holds one of these, in lower case.
_HINTS = [" at ", " dot ", " @", "@ ", *[f"{b}{s}{sign}" for b in "([{<" for s in ("", " ") for sign in ("at", "@", "dot", ".")]]


class Written:
    """A text and, for each of its characters, the source characters [starts, ends)."""

    def __init__(self, text: str, starts=None, ends=None):
        self.text = text
        self.starts = starts if starts is not None else range(len(text))
        self.ends = ends if ends is not None else range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> "Written":
        """Replace spans in order; what is written stands for all its span."""
        if not edits:
            return self
        text, starts, ends, at = [], [], [], 0
        for start, end, new in [*edits, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:start])
            starts.extend(self.starts[at:start])
            ends.extend(self.ends[at:start])
            if new:
                text.append(new)
                starts.extend([self.starts[start]] * len(new))
                ends.extend([self.ends[end - 1]] * len(new))
            at = end
        return Written("".join(text), starts, ends)


def _plain_letters(w: Written) -> Written:
    if w.text.isascii():
        return w
    return w.rewrite([(m.start(), m.end(), _LOOKALIKES.get(m[0], "")) for m in _STRANGE.finditer(w.text)])


def _digits(w: Written, lower: str) -> Written:
    # Of five words in a row with three spelled ones, one stands inside.
    spaced = lower.replace("-", " ")
    if not any(f" {word} " in spaced for word in _DIGIT_WORDS):
        return w
    edits = []
    for run in _SPELLED_RUN.finditer(w.text):
        words = list(_SPELLED.finditer(w.text, run.start(), run.end()))
        if len(words) >= 3:
            edits += [(m.start(), m.end(), _DIGITS[m[0].lower()]) for m in words]
    return w.rewrite(edits)


def _signs(w: Written, lower: str) -> Written:
    if not any(hint in lower for hint in _HINTS):
        return w
    w = w.rewrite([(m.start(), m.end(), ".") for m in _DIGIT_DOT.finditer(w.text)])
    edits = []
    for start, at, end in _addresses(w.text):
        marks = [(at.start(), at.end(), "@")]
        marks += [(d.start(), d.end(), ".") for part in ((start, at.start()), (at.end(), end)) for d in _DOT_SIGN.finditer(w.text, *part)]
        edits += [x for x in sorted(marks) if w.text[x[0] : x[1]] != x[2]]
    return w.rewrite(edits)


def _local_start(text: str, end: int, least: int) -> int:
    """Where the local part that ends at ``end`` starts: labels with dots, disguised or not, between them."""
    start = at = end
    while True:
        while at > least and text[at - 1] in _LOCAL_LABEL:
            at -= 1
        if at == start:
            return start  # no label before what was taken for a dot
        start = at
        dot = _DOT_BEFORE.search(text, max(least, start - _DOT_CHARS), start)
        if not dot:
            return start
        at = dot.start()
        if at == least or text[at - 1] not in _LOCAL_LABEL:
            return start


def _named(domain: str) -> bool:
    """Whether what stands after a plain "at" reads as a host: its last label is a word of two letters or more, not the
    start of a sentence, or it is an address of four numbers."""
    labels = _DOT_SIGN.split(domain)
    last = labels[-1]
    if last.isalpha():
        return len(last) > 1 and not last.istitle()
    return len(labels) == 4 and all(x.isdigit() and len(x) < 4 and int(x) < 256 for x in labels)


def _addresses(text: str) -> Iterator[tuple[int, re.Match, int]]:
    """(start, the sign, end) of what is an address once its signs are rewritten, found from each sign."""
    least = 0
    for core in _SIGN_CORE.finditer(text):
        if core.start() < least:
            continue
        places = range(max(least, core.start() - _BEFORE_CORE), core.start() + 1)
        sign = next((m for m in (_AT_SIGN.match(text, i) for i in places) if m and m.end() >= core.end()), None)
        start = _local_start(text, sign.start(), least) if sign else 0
        domain = _HIDDEN_DOMAIN.match(text, sign.end()) if sign and start < sign.start() else None
        if domain and (sign[0].strip().lower() != "at" or _named(domain[0])):
            yield start, sign, domain.end()
            least = domain.end()


def deobfuscated(text: str) -> Written | None:
    """The text with disguises undone; None if there is none."""
    plain = Written(text)
    w = _plain_letters(plain)
    lower = w.text.lower()
    w = _signs(_digits(w, lower), lower)
    return None if w is plain else w


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(spans of the text as it stands, further spans of what is disguised in it)."""
    base, w = detect(text), deobfuscated(text)
    if w is None:
        return base, []
    mapped = {(w.starts[s], k, w.ends[e - 1]) for s, k, e in detect(w.text)}
    # Spans of a kind do not overlap: the last that starts no later is the only one to hold another.
    plain = [[(s, e) for s, k, e in base if k == kind] for kind in range(len(KINDS))]
    more = []
    for s, k, e in sorted(mapped - set(base)):
        at = bisect_right(plain[k], s, key=itemgetter(0)) - 1
        # What a plain span of its kind holds already is not a new one; what reaches beyond it is.
        if at < 0 or plain[k][at][1] < e:
            more.append((s, k, e))
    return base, more


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for s, k, e in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find_personal(docs: DataFrame) -> DataFrame:
    """doc_id, counts, spans and the text with all spans redacted, one row per row of ``docs``.

    ``docs`` has doc_id and text; other columns are ignored.  A null text is
    taken as empty but stays null when redacted.  Rows repeated, null doc_id included, each give
    the same row.  No rows give no rows.  Spans count code points and exclude
    their end.  A disguised span is reported beside the plain ones unless one of its kind holds
    all of it; spans that overlap are redacted as one.
    """
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long, redacted string"

    def run(source):
        for rows in source:
            out = {name: [] for name in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_disguised", "redacted")}
            for text in rows["text"].to_pylist():
                base, more = find(text or "")
                for k, kind in enumerate(KINDS):
                    out[f"n_{kind}"].append(sum(s[1] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(sorted(base + more)))
                out["n_disguised"].append(len(more))
                out["redacted"].append(text if text is None else redacted(text, base + more))
            yield pa.RecordBatch.from_pydict({"doc_id": rows["doc_id"], **out}, pa.schema(
                [("doc_id", pa.int64()), *[(n, pa.string() if n in ("base_sha256", "spans", "redacted") else pa.int64()) for n in out]]
            ))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, its texts redacted and n_chars, if there, counted anew.

    Null texts stay null; other columns are passed on as they are.
    """

    def run(source):
        arrays.give_back()
        for rows in source:
            texts = [t if t is None else redacted(t, [s for found in find(t) for s in found]) for t in rows["text"].to_pylist()]
            new = {"text": pa.array(texts, rows["text"].type)}
            if "n_chars" in rows.schema.names:
                new["n_chars"] = pa.array([None if t is None else len(t) for t in texts], rows["n_chars"].type)
            yield pa.RecordBatch.from_arrays([new.get(c, rows[c]) for c in rows.schema.names], rows.schema.names)

    return docs.mapInArrow(run, docs.schema)
