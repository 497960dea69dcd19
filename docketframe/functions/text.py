"""String primitives as Column expressions (no Python in the data path)."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketframe import rules

# The code points a Python str counts as white space; Java's \s and Spark's
# trim() know far fewer of them.
WS_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
         *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
WS_MEMBERS = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def java_regex(pattern: str) -> str:
    """Give a rule pattern the meaning it has for Unicode text in Spark.

    ``\\d`` becomes ``\\p{Nd}``, ``\\s`` the explicit white-space class, and the
    ``(?d)`` flag makes ``.`` and ``$`` treat only ``\\n`` as a line end.  The
    idiom ``[\\s\\S]`` (any character) stays as it is.  ``\\w``, ``\\S`` and ``\\D``
    keep Java's ASCII meaning.
    """
    out, in_class, i = [], False, 0
    while i < len(pattern):
        if pattern.startswith(r"[\s\S]", i):
            out.append(r"[\s\S]")
            i += 6
            continue
        two = pattern[i : i + 2]
        if two == r"\d":
            out.append(r"\p{Nd}")
        elif two == r"\s":
            out.append(WS_MEMBERS if in_class else f"[{WS_MEMBERS}]")
        elif two[0] == "\\":
            out.append(two)
        else:
            in_class = two[0] == "[" or (in_class and two[0] != "]")
            out.append(two[0])
            i -= 1
        i += 2
    return "(?d)" + "".join(out)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# Patterns of literals, plain classes, plain or looking groups, quantifiers and
# escapes that stand for no other literal.
_PLAIN = re.compile(
    r"(?:\\[dswDSWbB]|\\[^\w\s]|\[\^?(?:\\[dswDSW]|\\[^\w\s]|[^\[\]\\&])+\]|\((?:\?(?::|<?[=!]))?(?!\?)|[^\\\[\](])*"
)


@cache
def required_literal(pattern: str) -> str:
    """The longest literal that every hit of the pattern contains, or ''.

    Looks at the top level and into groups that occur exactly once and have no
    alternatives; anything optional, repeated or in a class is passed over.
    A pattern with flags, named groups, nested classes or escapes of characters
    has none: its spelling does not show what it matches.
    """
    if not _PLAIN.fullmatch(pattern) or _alternates(pattern):
        return ""
    runs, i = [""], 0
    while i < len(pattern):
        token, inner = _token(pattern, i)
        i += len(token)
        quantified = pattern[i : i + 1] in tuple("*?{+")
        optional = quantified and pattern[i] != "+"
        if inner is not None:
            runs += [] if quantified else [required_literal(inner)]
            runs.append("")
        elif len(token) == 1 and token not in ".^$" and not optional:
            runs[-1] += token
        else:
            runs.append("")
        if quantified:
            end = pattern.index("}", i) + 1 if pattern[i] == "{" else i + 1
            i = end + (pattern[end : end + 1] in ("?", "+"))
            runs.append("")
    return max(runs, key=len)


def _token(pattern: str, i: int) -> tuple[str, str | None]:
    """The token at ``i``; for a group also what is inside it."""
    if pattern[i] == "\\":
        return pattern[i : i + 2], None
    if pattern[i] == "[":
        j = i + 1
        while pattern[j] != "]":
            j += 2 if pattern[j] == "\\" else 1
        return pattern[i : j + 1], None
    if pattern[i] != "(":
        return pattern[i], None
    j = i + 1
    while pattern[j] != ")":
        j += len(_token(pattern, j)[0])
    inner = pattern[i + 1 : j]
    if inner.startswith("?"):
        # Of the special groups only the plain (?:...) consumes what it holds.
        inner = inner[2:] if inner.startswith("?:") else ""
    return pattern[i : j + 1], inner


def _alternates(pattern: str) -> bool:
    i = 0
    while i < len(pattern):
        token, _ = _token(pattern, i)
        if token == "|":
            return True
        i += len(token)
    return False


def _guarded(text: Column, pattern: str, hit: Column, otherwise: Column) -> Column:
    """Run the regex only where the literal it needs occurs: a byte search is
    far cheaper, and most texts lack most literals."""
    literal = required_literal(pattern)
    if not literal:
        return hit
    return F.when(F.contains(text, F.lit(literal)), hit).when(text.isNotNull(), otherwise)


def hits(text: Column, pattern: str) -> Column:
    """Whether a rule pattern occurs."""
    if required_literal(pattern) == pattern:
        return F.contains(text, F.lit(pattern))
    return _guarded(text, pattern, text.rlike(java_regex(pattern)), F.lit(False))


def find(text: Column, pattern: str, group: int = 0) -> Column:
    """First hit of a rule pattern, ``''`` if there is none."""
    hit = F.regexp_extract(text, java_regex(pattern), group)
    return _guarded(text, pattern, hit, F.lit(""))


def find_or_null(text: Column, pattern: str, group: int = 0) -> Column:
    """As :func:`find`, but NULL if there is no hit.

    A plain ``nullif`` would put the regex into the plan twice wherever Spark
    cannot compute it ahead, that is inside conditions and lambdas.
    """
    hit = bind(F.regexp_extract(text, java_regex(pattern), group), blank_to_null)
    return _guarded(text, pattern, hit, F.lit(None).cast("string"))


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    hit = F.regexp_extract_all(text, F.lit(java_regex(pattern)), F.lit(group))
    return _guarded(text, pattern, hit, F.array().cast("array<string>"))


def contains_any(text: Column, words: list[str]) -> Column:
    hit = F.contains(text, F.lit(words[0]))
    for word in words[1:]:
        hit = hit | F.contains(text, F.lit(word))
    return hit


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def clean_ws(c: Column) -> Column:
    """Runs of white space become one space, the ends are trimmed; NULL is ''."""
    return F.btrim(F.regexp_replace(F.coalesce(c, F.lit("")), f"[{WS_MEMBERS}]+", " "))


def display_cut(c: Column, n: int) -> Column:
    return F.concat(F.left(c, F.lit(n)), F.lit("..."))


def body_md5(c: Column) -> Column:
    return F.md5(F.encode(c, "UTF-8"))


@cache
def _digits() -> tuple[str, str]:
    """All decimal digits of Unicode and their ASCII values, by rule."""
    wide = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(wide), "".join(str(unicodedata.decimal(c)) for c in wide)


def ascii_digits(c: Column) -> Column:
    return F.translate(c, *_digits())


def first_number(c: Column, default: float = 0.0) -> Column:
    """First number in the text as a double; ``default`` if there is none."""
    hit = ascii_digits(find_or_null(c, rules.FIRST_NUMBER))
    return F.coalesce(hit.try_cast("double"), F.lit(float(default)))


def numeral_texts(*numerals: Column) -> Column:
    """Chinese or decimal numerals as an array of plain decimal strings.

    Text is the carrier so that digit runs of any length stay exact.  The
    Chinese forms read are one character, 十x and x十y; anything else is 0.
    NULL stays NULL.
    """
    entries = ", ".join(f"'{ch}', {n}" for ch, n in rules.NUMERALS.items())
    table = F.expr(f"map({entries})")
    ten = F.lit("十")

    def value(ch: Column, missing: int) -> Column:
        return F.coalesce(F.try_element_at(table, ch), F.lit(missing))

    def read(c: Column) -> Column:
        tens, ones = (F.split_part(c, ten, F.lit(i)) for i in (1, 2))
        han = (
            F.when(F.length(c) == 1, value(c, 0))
            .when(F.startswith(c, ten), 10 + value(F.substring(c, 2, 1), 0))
            .when(F.contains(c, ten), 10 * value(tens, 1) + value(ones, 0))
            .otherwise(0)
        )
        plain = F.regexp_replace(ascii_digits(c), "^0+(?=[0-9])", "")
        return F.when(c.rlike(r"^\p{Nd}+\z"), plain).when(c.isNotNull(), han.cast("string"))

    return F.transform(F.array(*numerals), read)


def numeral_text(numeral: Column) -> Column:
    return F.get(numeral_texts(numeral), F.lit(0))


def cn_to_num(c: Column) -> Column:
    """:func:`numeral_text` as BIGINT (NULL where it does not fit)."""
    return numeral_text(c).try_cast("bigint")


def fixed2(value: Column) -> Column:
    """A non-negative double as text with two decimals, rounded on its exact
    binary value with ties to even, as C's ``%.2f`` does.

    Spark's own ``format_string`` rounds the shortest decimal form half up.
    A value below 1e12 that has at most two decimals in that form needs no
    rounding.  Otherwise integers decide: the fraction times 2**60 is an exact integer
    for every double that can still round to something other than zero.
    """
    scale = 1 << 60
    scale_dec = F.lit(scale).cast("decimal(20,0)")

    def rounded(v: Column) -> Column:
        whole = F.floor(v)
        scaled = ((v - whole) * F.lit(float(scale))).cast("bigint").cast("decimal(20,0)") * 100
        return bind(
            F.struct(
                whole.alias("whole"),
                F.floor(scaled / scale_dec).cast("bigint").alias("cents"),
                (scaled % scale_dec).cast("bigint").alias("rest"),
            ),
            to_text,
        )

    def to_text(part: Column) -> Column:
        half, odd = F.lit(scale // 2), part["cents"] % 2 == 1
        up = (part["rest"] > half) | ((part["rest"] == half) & odd)
        total = part["whole"] * 100 + part["cents"] + F.when(up, 1).otherwise(0)
        return (total.cast("decimal(20,0)") / 100).cast("decimal(20,2)").cast("string")

    def integral(v: Column) -> Column:
        # From 2**53 a double is an integer.  Both of its parts by 2**60 are exact.
        high = F.floor(v / F.lit(float(scale)))
        low = v - high.cast("double") * F.lit(float(scale))
        exact = high.cast("bigint").cast("decimal(19,0)") * scale_dec + low.cast("bigint").cast("decimal(19,0)")
        return F.concat(exact.cast("decimal(38,0)").cast("string"), F.lit(".00"))

    short = value.cast("decimal(20,2)")
    return (
        F.when(value >= float(1 << 123), F.format_string("%.2f", value))
        .when(value >= float(1 << 53), integral(value))
        .when((value < 1e12) & (short.cast("double") == value), short.cast("string"))
        .when(value.isNotNull(), rounded(value))
    )


def chunk_id(seq: Column, size: int) -> Column:
    """0-based block of ``size`` consecutive rows for a 1-based row number."""
    return F.call_function("div", seq - 1, F.lit(size))


def current_time_text(pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.current_timestamp(), pattern)


def current_millis() -> Column:
    return F.unix_millis(F.current_timestamp())
