"""Documents whose sets of word n-grams are similar: a prefix-filtered join.

Every set is put in one global order, rarest n-gram first.  Two sets that reach
the threshold share an n-gram within their prefixes, so only prefixes are
joined, and of the smaller set only the part that can still give the overlap
that an equally large one needs.  A pair then has to pass, in turn, the length filter, the positional
filter (what is left after the shared place can still reach the threshold), the
suffix filter (n-grams counted in cells of the hash range: the differences of
the counts bound the overlap from above) and, once, the comparison of both sets.

Copies, that is equal sets, are one class and are joined once.  For components
a pair is left out when its ends are known to be connected already; without
that a group of k near copies would give k * k pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.llm import arrays, shared_keys
from docketframe.llm.graph import component_labels
from docketframe.session import discard, small, staged

#: Cells of the suffix filter.
CELLS = np.arange(1, 32, dtype=np.uint64) << np.uint64(59)
#: Posting lists led by up to this many sets are joined as they are; others go by hubs first.
SHORT_LIST = 12
#: Members of a long list that are compared with all others in the first round.
HUBS = 8

#: Bytes of a row of ids, of a list, of a class, at most, where a table of them may be broadcast.
ID_BYTES, LIST_BYTES, CLASS_BYTES = 16, 40, 64

SETS = "doc_id long, n_shingles long, signature binary, tokens array<long>, places array<int>, members binary"


def _shingles(words: arrays.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each n-gram; a text of fewer words is one n-gram."""
    at = np.flatnonzero(words.whole(n))
    docs, keys = [words.doc[at]], [words.windows(n)[at]]
    for short in range(1, n):
        own = np.flatnonzero(words.counts == short)
        if len(own):
            docs.append(own)
            keys.append(arrays.mix(words.windows(short)[words.first[own]] + np.uint64(short)))
    return np.concatenate(docs), np.concatenate(keys)


def _sets(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    groups = shared_keys.groups_for(docs)

    def distinct_shingles(b):
        """Each text's distinct n-grams in text order, and the batch's distinct keys."""
        doc, key = _shingles(b.words(lower=True), n)
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        return doc[new], key[new], shared_keys.Keys([key[new]], groups)

    def count(b):
        return distinct_shingles(b)[2].blocks(b.uid, state="<u4")

    def order(b, replies):
        doc, key, keys = distinct_shingles(b)
        held = np.maximum(keys.totals(replies), 1)[keys.group]
        order = np.lexsort((key, held, doc))
        key, held = key[order], held[order]
        sizes = np.bincount(doc, minlength=len(b.ids))
        first = np.concatenate([[0], np.cumsum(sizes)])
        out = {c: [] for c in ("signature", "tokens", "places", "members")}
        signed = [np.add.reduceat(np.append(x, x[:0].dtype.type(0)), first[:-1]) if len(b.ids) else [] for x in (arrays.mix(key), arrays.mix(key ^ np.uint64(0x5DEECE66D)))]
        for i, size in enumerate(sizes):
            own, shared = key[first[i] : first[i + 1]], held[first[i] : first[i + 1]] > 1
            prefix = size - -(-num * size // den) + 1
            places = np.flatnonzero(shared[:prefix])
            if len(places):
                out["signature"].append(np.array([signed[0][i], signed[1][i], size], np.uint64).tobytes())
                out["tokens"].append(own[places].view(np.int64))
                out["places"].append(places)
                out["members"].append(np.sort(own).tobytes())
            else:
                for c in out:
                    out[c].append(None)
        return pa.table(
            {
                "doc_id": pa.array(b.ids, pa.int64()),
                "n_shingles": pa.array(sizes, pa.int64()),
                "signature": pa.array(out["signature"], pa.binary()),
                "tokens": pa.array(out["tokens"], pa.list_(pa.int64())),
                "places": pa.array(out["places"], pa.list_(pa.int32())),
                "members": pa.array(out["members"], pa.binary()),
            }
        )

    totals = shared_keys.repeated(shared_keys.mapped(docs, count, shared_keys.BLOCK))
    return shared_keys.answered(docs, totals, order, SETS)


def _filtered(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that length and position let through, each once."""
    # overlap >= num / (num + den) * (n_a + n_b), in whole numbers; the places
    # bound it by what stands from there on, at the first shared n-gram at least.
    return (
        pairs.where(f"{den} * least(n_x, n_y) >= {num} * greatest(n_x, n_y)")
        .where(f"least(n_x - place_x, n_y - place_y) * {num + den} >= {num} * (n_x + n_y)")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def _may_reach(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """The suffix filter."""
    cells = [np.append(np.searchsorted(v, CELLS), len(v)) for v in (x, y)]
    counts = [np.diff(c, prepend=0) for c in cells]
    most = (len(x) + len(y) - int(np.abs(counts[0] - counts[1]).sum())) // 2
    return (num + den) * most >= num * (len(x) + len(y))


def _verified(pairs: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sets reach the threshold."""
    # Ids go to the sets, so that of these only the ones wanted are shuffled.
    ends = small(staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()), ID_BYTES)
    picked = members.join(ends, "doc_id", "left_semi")
    left = picked.select(F.col("doc_id").alias("a"), F.col("members").alias("set_a"))
    right = picked.select(F.col("doc_id").alias("b"), F.col("members").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")

    def compare(source):
        for rows in source:
            keep = []
            for x, y in zip(rows["set_a"], rows["set_b"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                good = _may_reach(x, y, num, den)
                if good:
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    good = den * shared >= num * (len(x) + len(y) - shared)
                keep.append(good)
            yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        arrays.give_back()

    return both.mapInArrow(compare, "a long, b long")


def _pairs(left: DataFrame, right: DataFrame, where: str) -> DataFrame:
    def side(df: DataFrame, end: str) -> DataFrame:
        return df.select(
            "token",
            F.col("doc_id").alias(end),
            F.col("n_shingles").alias(f"n_{end}"),
            F.col("place").alias(f"place_{end}"),
            F.col("label").alias(f"label_{end}"),
        )

    return side(left, "x").join(side(right, "y"), "token").where(where)


#: Posts that no leader of their list can be joined with are of no use.
_USEFUL = "leads OR reach >= least"


def _lists(posts: DataFrame) -> DataFrame:
    """Lists that have a leader: token, size, leaders, and the least size of a leading set."""
    least = F.min(F.when(F.col("leads"), F.col("n_shingles"))).alias("least")
    lists = posts.groupBy("token").agg(F.count("*").alias("size"), F.count_if("leads").alias("leaders"), least)
    return lists.where("leaders > 0")


def links(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, connect_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """(one row per document with its class, linked pairs of classes).

    The first table: doc_id, n_shingles, class_id, the smallest doc_id of the
    documents with an equal set (null: no other can be near).  The second: a, b,
    class ids with a < b.  With ``connect_only`` pairs are left out whose ends
    other pairs connect; the components are the same.
    """
    spark = docs.sparkSession
    sets = staged(_sets(docs, n, num, den))
    near = sets.where("signature IS NOT NULL AND doc_id IS NOT NULL")
    classes = staged(near.groupBy("signature").agg(F.min("doc_id").alias("class_id")))
    leading = small(classes.withColumnRenamed("class_id", "doc_id"), CLASS_BYTES)
    one = near.join(leading, ["signature", "doc_id"], "left_semi")
    # A doc_id that several rows with equal texts have is one class all the same.
    again = staged(one.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if not again.isEmpty():
        few = small(again, ID_BYTES)
        one = one.join(few, "doc_id", "left_anti").unionByName(one.join(few, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    posts = one.select("doc_id", "n_shingles", F.explode(F.arrays_zip("tokens", "places")).alias("t")).select(
        "doc_id", "n_shingles", F.col("t.tokens").alias("token"), F.col("t.places").alias("place")
    )
    # The smaller set of a pair needs num / (num + den) of both sizes, so of twice its own at least.
    # ``reach``: the largest size of a smaller set with which what stands from here on can be enough.
    posts = posts.withColumn("reach", F.expr(f"((n_shingles - place) * {num + den} - {num} * n_shingles) div {num}"))
    posts = posts.withColumn("leads", F.col("reach") >= F.col("n_shingles")).withColumn("label", F.col("doc_id"))
    # Before anything is joined, lists of one or without a leader are left out.
    first = staged(_lists(posts).where("size > 1").select("token", "least"))
    useful = staged(posts.join(small(first, LIST_BYTES), "token").where(_USEFUL).drop("least"))
    lists = staged(_lists(useful).where("size > 1").select("token", "size", "leaders"))
    posts = staged(useful.join(small(lists, LIST_BYTES), "token"))
    # Sets that stand in no list need not be compared with any.
    listed = small(staged(posts.select("doc_id").distinct()), ID_BYTES)
    members = staged(one.join(listed, "doc_id", "left_semi").select("doc_id", "members"))
    bound = f"leaders <= {SHORT_LIST}"
    short = posts.where(bound) if connect_only else posts
    open_posts = posts.where(f"NOT ({bound})").drop("leaders")
    empty = spark.createDataFrame([], "a long, b long")
    found = staged(_verified(_filtered(_pairs(short.where("leads"), short, "x <> y AND n_x <= n_y"), num, den), members, num, den))
    if connect_only and not open_posts.isEmpty():
        tested, labels = empty, component_labels(found)
        for turn in itertools.count():
            # A list whose members are all connected has nothing left to test.
            now = open_posts.drop("label").join(labels, open_posts["doc_id"] == labels["node"], "left")
            now = now.withColumn("label", F.coalesce("label", "doc_id")).drop("node", "size")
            all_now = staged(now.join(_lists(now).select("token", "least"), "token").where(_USEFUL).drop("least"))
            by_label = all_now.groupBy("token", "label").agg(F.count("*").alias("own"), F.count_if("leads").alias("own_leaders"))
            per = by_label.groupBy("token").agg(F.sum("own").alias("size"), F.sum("own_leaders").alias("leaders"), F.count("*").alias("kinds"))
            per = staged(per.where("kinds > 1 AND leaders > 0").select("token", "size"))
            now = staged(all_now.join(per, "token"))
            cross = by_label.join(per, "token").agg(F.sum("own"), F.sum(F.col("own_leaders") * (F.col("size") - F.col("own")))).first()
            for done in (open_posts, all_now, per):
                discard(done)
            if cross[0] is None:
                break
            # Twice as many each time, so that rounds grow with the logarithm of the longest list.
            n_hubs = HUBS << turn
            last = cross[1] <= 2 * n_hubs * cross[0]
            hubs = now.where("leads") if last else _hubs(now.where("leads"), turn, n_hubs)
            # A pair with two leaders of one size would come twice; it is made distinct below.
            candidates = _pairs(hubs, now, "x <> y AND n_x <= n_y AND label_x <> label_y")
            fresh = staged(_filtered(candidates, num, den).join(tested, ["a", "b"], "left_anti"))
            true = staged(_verified(fresh, members, num, den))
            before = (found, tested, fresh, true)
            found, tested = staged(found.unionByName(true)), staged(tested.unionByName(fresh))
            for done in before:
                discard(done)
            if last:
                break
            # A hub has met all the list; it stays as one that others lead to.
            gone = hubs.select("token", "doc_id", F.lit(False).alias("still"))
            open_posts = staged(
                now.join(gone, ["token", "doc_id"], "left").withColumn("leads", F.coalesce("still", "leads")).drop("still")
            )
            discard(now)
            labels = component_labels(found)
    table = sets.select("doc_id", "n_shingles", "signature").join(classes, "signature", "left")
    return table.select("doc_id", "n_shingles", "class_id"), found


def _hubs(posts: DataFrame, turn: int, n: int) -> DataFrame:
    """At most ``n`` members of each list, those most like the others first, by partial aggregation."""
    # A set with few n-grams of its own, whose shared ones come early, is near the middle of its group.
    row = F.struct(F.col("place").alias("h"), F.hash("doc_id", F.lit(turn)).alias("i"), *[F.col(c) for c in ("doc_id", "n_shingles", "place", "label")])
    salted = posts.withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(n)))
    best = salted.groupBy("token", "salt").agg(F.min(row).alias("r"))
    return best.select("token", "r.*")


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, class_id and component_id of each row.

    ``docs`` has doc_id and text; other columns are ignored.  Words are what
    white space separates, with A-Z in lower case.  Documents link when
    den * |A ∩ B| >= num * |A ∪ B|; component_id is the smallest doc_id that
    links reach, the document's own included.  Rows without words, and rows
    whose doc_id is null, are alone; the latter have a null component.  Rows
    with the same doc_id and text are one document, each with its row.  Rows
    with the same doc_id and other texts have to be given ids of their own
    before, or links of all but one of them may be lost.  No rows give no rows.
    """
    table, found = links(docs, n, num, den, connect_only=True)
    labels = component_labels(found)
    out = table.join(labels, table["class_id"] == labels["node"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "class_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "class_id", component.alias("component_id"))
