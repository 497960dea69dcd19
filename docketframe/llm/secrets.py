"""Secrets in texts, and weak parts of credentials linked by what stands near.

Plain built-in expressions.  Strong kinds (assign, access, hex) are reported as
found.  Identifiers, bare keys and endpoints prove nothing alone: they are
parts, put on a line of code points, and an interval join within scopes reports
a part only if its complements are at most ``scope`` away.  The join meets cells
of one scope's width, each reduced to its first and last part of a kind, so no
pairs of parts are formed however many a text holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketframe.session import staged

# Kinds and their patterns.
ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{24,})"
# Weak parts.
IDENT = (
    r"(?:[Aa][Cc][Cc][Ee][Ss][Ss]|[Cc][Ll][Ii][Ee][Nn][Tt]|[Aa][Cc][Cc][Oo][Uu][Nn][Tt]|[Uu][Ss][Ee][Rr]|[Kk][Ee][Yy])_?(?:[Ii][Dd]|[Nn][Aa][Mm][Ee])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})"""
)
KEY = r"([A-Za-z0-9+/]{32,})"
ENDPOINT = r"((?:https?|ftps?|sftp|ssh|wss?|s3|smtps?|imaps?|ldaps?|amqps?|rediss?|mysql|mongodb|postgres|postgresql)://[A-Za-z0-9.-]+(?::[0-9]+)?)"

#: kind, pattern, least length of group 1
STRONG = (("assign", ASSIGN, 6), ("access", ACCESS, 20), ("hex", HEX, 24))
WEAK = (("ident", IDENT, 3), ("secret", KEY, 32), ("endpoint", ENDPOINT, 8))
KINDS = [k for k, _, _ in STRONG + WEAK]
IDENTIFIERS, SECRETS = ("access", "ident"), ("assign", "hex", "secret")
#: Matches that are folded into one array at a time.
STRETCH = 128
#: Code points between the starts of parts that belong together.
SCOPE = 400

SPAN = "struct<start: bigint, kind: int, end: bigint>"


def _matches(text: Column, pattern: str) -> Column:
    """Of each match, the length of the text before it, its own and its group; the last row has no match.  Null if there is none."""
    p = F.lit(pattern)
    rows = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, p, F.lit(0)), F.length).alias("hit"),
        F.regexp_extract_all(text, p, F.lit(1)).alias("value"),
    )
    return F.when(text.rlike(pattern), rows)


def _folded(rows: str, kind: str, least: int) -> Column:
    """For each stretch of ``STRETCH`` matches: its length, and the spans in it whose group is long enough, from its start.

    An array grows by one at the cost of all of it, so it is kept to a stretch.
    """
    number = KINDS.index(kind)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["hit"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        good = F.length(x["value"]) >= least
        if kind == "secret":
            good &= x["value"].rlike("[0-9]") & x["value"].rlike("[A-Z]") & x["value"].rlike("[a-z]")
        return F.struct(end.alias("at"), F.when(good, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    at = F.sequence(F.lit(0), F.size(rows) - 1, F.lit(STRETCH))
    return F.when(F.size(rows) > 0, F.transform(at, lambda i: F.aggregate(F.slice(rows, i + 1, F.lit(STRETCH)), start, step)))


def _spans(folded: str) -> Column:
    """All spans of a text, from those of its stretches and where each stretch starts."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
    starts = F.aggregate(
        folded, start, lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"]
    )

    def moved(stretch: Column, by: Column) -> Column:
        return F.transform(stretch["out"], lambda s: F.struct((s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end")))

    return F.coalesce(F.flatten(F.zip_with(folded, starts, moved)), F.array().cast(f"array<{SPAN}>"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, strong and all spans with their counts, one row per row of ``docs``.

    ``docs`` has doc_id and text; other columns are ignored.  A null text is
    empty; empty texts have no spans.  Rows repeated, null doc_id included,
    each give the same row.  No rows give no rows.  Spans count code points and
    exclude their end.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(F.col("doc_id"), text.alias("text"))
    kinds = STRONG + WEAK
    # Step by step, since each is read several times by the next.
    found = read.select("doc_id", "text", *[_matches(F.col("text"), p).alias(k) for k, p, _ in kinds])
    found = found.select("doc_id", "text", *[_folded(k, k, n).alias(k) for k, _, n in kinds])
    found = found.select("doc_id", "text", *[_spans(k).alias(k) for k, _, _ in kinds])
    # Equal rows share a key and an answer; rows without weak parts need none.
    key = F.when(
        F.size("ident") + F.size("secret") + F.size("endpoint") > 0,
        F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("text")), 256),
    )
    found = staged(
        found.select(
            "doc_id",
            key.alias("key"),
            F.sort_array(F.concat("assign", "access", "hex")).alias("strong"),
            F.concat("ident", "secret", "endpoint").alias("weak"),
        )
    )
    linked = _linked(found.where("key IS NOT NULL").dropDuplicates(["key"]), scope)
    out = found.join(linked, "key", "left").withColumn(
        "all_spans", F.sort_array(F.concat("strong", F.coalesce("linked", F.array().cast(f"array<{SPAN}>"))))
    )

    def count(spans: str, kind: str) -> Column:
        n = KINDS.index(kind)
        return F.size(F.filter(spans, lambda s: s["kind"] == n)).cast("bigint").alias(f"n_{kind}")

    return out.select(
        "doc_id",
        *[count("strong", k) for k, _, _ in STRONG],
        F.sha2(_written(F.col("strong")), 256).alias("base_sha256"),
        _written(F.col("all_spans")).alias("spans"),
        *[count("all_spans", k) for k, _, _ in WEAK],
    )


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """key and the weak spans with complements in scope."""
    outside = F.filter(
        "weak", lambda w: ~F.exists("strong", lambda s: (s["start"] <= w["start"]) & (w["end"] <= s["end"]))
    )
    parts = (
        found.withColumn("weak", outside)
        .where(F.size("weak") > 0)
        .select("key", F.explode(F.concat("strong", "weak")).alias("s"))
        .select("key", "s.*", F.expr(f"s.start div {scope}").alias("cell"))
    )

    def of(kinds: tuple[str, ...]) -> Column:
        return F.when(F.col("kind").isin([KINDS.index(k) for k in kinds]), F.col("start"))

    cells = parts.groupBy("key", "cell").agg(
        F.min(of(IDENTIFIERS)).alias("id_first"), F.max(of(IDENTIFIERS)).alias("id_last"),
        F.min(of(SECRETS)).alias("secret_first"), F.max(of(SECRETS)).alias("secret_last"),
    )
    weak = parts.where(F.col("kind") >= len(STRONG)).withColumn(
        "cell", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1))
    )
    met = weak.join(cells, ["key", "cell"])

    def near(which: str) -> Column:
        first, last, at = F.col(f"{which}_first"), F.col(f"{which}_last"), F.col("start")
        inside = ((first >= at - scope) & (first <= at + scope)) | ((last >= at - scope) & (last <= at + scope))
        return F.max(F.coalesce(inside, F.lit(False)))

    by_part = met.groupBy("key", "start", "kind", "end").agg(near("id").alias("has_id"), near("secret").alias("has_secret"))
    number = {k: KINDS.index(k) for k, _, _ in WEAK}
    kind = F.col("kind")
    wanted = (
        ((kind == number["ident"]) & F.col("has_secret"))
        | ((kind == number["secret"]) & F.col("has_id"))
        | ((kind == number["endpoint"]) & F.col("has_id") & F.col("has_secret"))
    )
    span = F.struct("start", "kind", "end")
    return by_part.where(wanted).groupBy("key").agg(F.collect_list(span).alias("linked"))
