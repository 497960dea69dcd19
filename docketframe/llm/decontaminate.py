"""Words of documents that a benchmark item holds too, found by winnowing.

Built-in expressions and joins only.  Of every run of WINDOW consecutive words the
k-gram with the least hash is a fingerprint.  A run that a document shares with
an item has the same least k-gram in both, so joining fingerprints misses no
shared run of that length.  Items shorter than a run are fingerprinted whole.

Each text is cut into words once; what goes on is its distinct fingerprints, eight
bytes each.  Only the texts of documents that share one are read again, and there a hit is
extended: the runs whose fingerprint it is are compared, as text, with the runs of the items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketframe.session import staged

WINDOW, GRAM = 10, 5
#: Bytes that a broadcast may hold, with some for each row beside its text; more are shuffled.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What a row is known by: two lanes of a hash of doc_id and text.
KEY = ["k1", "k2"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def _keyed(docs: DataFrame) -> DataFrame:
    own = [x for c in (F.col("doc_id"), F.col("text")) for x in (c.isNull(), c)]
    return docs.withColumns({"k1": F.xxhash64(*own), "k2": F.xxhash64(F.lit(1), *own)})


def _gram_hashes(hashes: str, n: int) -> Column:
    """Hashes of all n-grams of an array of word hashes; null if it has fewer words."""
    at = F.sequence(F.lit(0), F.size(hashes) - n)
    return F.when(F.size(hashes) >= n, F.transform(at, lambda i: F.xxhash64(F.lit(n), *[F.get(F.col(hashes), i + j) for j in range(n)])))


def _with_least(df: DataFrame, window: int, gram: int) -> DataFrame:
    """Adds ``least``: of each run of ``window`` words, the least k-gram hash; null for shorter texts.

    ``df`` has an array ``hashes`` of word hashes.  The minimum over a run is that of two overlapping
    stretches whose lengths are powers of two, each of two halves.
    """
    others, width = df.columns, window - gram + 1

    def both(one: str, ahead: int) -> Column:
        return F.zip_with(one, F.slice(one, F.lit(ahead + 1), F.size(one)), lambda x, y: F.least(x, y))

    df, size = df.select("*", _gram_hashes("hashes", gram).alias("m")), 1
    df = df.withColumn("runs", F.size("m") - width + 1)
    while 2 * size <= width:
        df, size = df.withColumn("m", both("m", size)), 2 * size
    if size < width:
        df = df.withColumn("m", both("m", width - size))
    return df.select(*others, F.when(F.col("runs") > 0, F.slice("m", F.lit(1), F.greatest("runs", F.lit(0)))).alias("least"))


def _prints(window: int, lengths: Sequence[int]) -> Column:
    """at, n, print of all runs of ``window`` words, and of those of other lengths asked for."""
    kinds = [(F.col("least"), window), *[(_gram_hashes("hashes", n), n) for n in lengths]]
    empty = F.array().cast("array<struct<at:int,n:int,print:bigint>>")

    def rows(column: Column, n: int) -> Column:
        placed = F.transform(column, lambda p, i: F.struct(i.alias("at"), F.lit(n).alias("n"), p.alias("print")))
        return F.coalesce(placed, empty)

    return F.concat(*[rows(column, n) for column, n in kinds])


def _small(df: DataFrame, text: str = "''") -> DataFrame:
    """A stored table with a broadcast hint if its rows, with ``text`` as their only long part, are known to be small."""
    size = df.agg(F.sum(F.lit(ROW_BYTES) + F.octet_length(F.expr(text)))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document, its words, those in runs shared with items, and the items.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are
    ignored.  An item of fewer than ``window`` words is one run of all its
    words.  Null and empty texts have no words, and neither hit nor are hit.  A
    null item_id marks words but is not listed.  Rows repeated, null doc_id
    included, each give the same row.  No rows give no rows, no items no hits.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    items = items.select("item_id", words(F.col("text").cast("string")).alias("words")).where(F.size("words") > 0)
    hashes = F.transform("words", lambda w: F.xxhash64(w)).alias("hashes")

    # The runs of the items, as text and by fingerprint.
    n = F.least(F.size("words"), F.lit(window))
    run_words = F.transform(F.sequence(F.lit(0), F.size("words") - n), lambda i: F.slice("words", i + 1, n))
    runs = items.select("item_id", n.alias("n"), F.explode(run_words).alias("words"))
    item_runs = staged(runs.select("item_id", "n", F.array_join("words", " ").alias("run"), "words").distinct())
    lengths = sorted(r[0] for r in item_runs.where(F.col("n") < window).select("n").distinct().collect())  # below window
    marked = _with_least(item_runs.select("n", "words", hashes), window, gram)
    whole = [F.when(F.col("n") == k, _gram_hashes("hashes", k)[0]) for k in lengths]
    item_prints = _small(staged(marked.select("n", F.coalesce(F.col("least")[0], *whole).alias("print")).distinct()))

    # One pass over all texts.
    counted = _keyed(docs).select("doc_id", *KEY, words(F.col("text")).alias("words")).select(
        "doc_id", *KEY, F.size("words").cast("bigint").alias("n_words"), hashes
    )
    least = _with_least(counted, window, gram)
    empty = F.array().cast("array<bigint>")
    distinct = F.array_distinct(F.concat(*[F.coalesce(c, empty) for c in (F.col("least"), *[_gram_hashes("hashes", k) for k in lengths])]))
    base = staged(least.select("doc_id", *KEY, "n_words", distinct.alias("prints")))
    near = base.select(*KEY, F.explode("prints").alias("print")).join(item_prints, "print", "left_semi").select(KEY).distinct()

    # The texts of the few documents that share a fingerprint.
    texts = _keyed(docs).join(_small(staged(near)), KEY, "left_semi").dropDuplicates(KEY).select(*KEY, words(F.col("text")).alias("words"))
    texts = staged(texts)
    all_prints = _with_least(texts.select(*KEY, hashes), window, gram).select(*KEY, F.inline(_prints(window, lengths)))
    places = all_prints.join(item_prints, ["print", "n"], "left_semi").groupBy(KEY).agg(F.collect_list(F.struct("at", "n")).alias("places"))
    extended = F.transform(
        "places", lambda p: F.struct(p["at"].alias("start"), p["n"].alias("n"), F.array_join(F.slice("words", p["at"] + 1, p["n"]), " ").alias("run"))
    )
    candidates = texts.join(places, KEY).select(*KEY, F.inline(extended))
    shared = staged(candidates.join(_small(item_runs.drop("words"), "run"), ["run", "n"]).select(*KEY, "start", "n", "item_id").distinct())

    in_order = Window.partitionBy(KEY).orderBy("start", "end")
    spans = shared.select(*KEY, "start", (F.col("start") + F.col("n")).alias("end")).distinct()
    reached = F.coalesce(F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), reached))
    n_hit = spans.withColumn("new", new).groupBy(KEY).agg(F.sum("new").alias("n_hit"))
    of = shared.groupBy(KEY).agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))

    out = base.select("doc_id", *KEY, "n_words").join(_small(staged(n_hit.join(of, KEY)), "array_join(items, ',')"), KEY, "left")
    ids = F.sort_array(F.coalesce("items", F.array().cast("array<string>")))
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
