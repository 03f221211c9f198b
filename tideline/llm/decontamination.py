"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification, DataFrame only.

A test item counts as leaked into a document if at least `percent` of its distinct 5-word shingles stand there (words
are lower-cased and split at white space; an item or text of fewer words has no shingle). Items are partitioned by the
power of two below their number of shingles; a partition's items all keep the same number of smallest hashes, one more
than the largest item there can miss. So a document that contains an item shares at least one of these MinHash values
with it, and no leak is lost. Documents look their shingles up in these signatures alone; what they meet, and is short
enough for them, is a candidate, and each candidate is verified by counting the item's shingles in the whole document.

The signatures are broadcast while they are `most_broadcast` rows at most (counted); beyond that the look-up shuffles by
value, with the documents' side salted, and gives the same rows.

Null and empty texts and items shorter than five words have no shingles and match nothing. Equal documents give one row
for each item, as do rows that share an id: a leak into one of them is a leak of that id. Rows of one item id are one
item that counts by its best match. Extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import materialize

WIDTH = 5
#: Parts into which the documents that share a shingle are dealt where the search shuffles.
SALTS = 16


def word_hashes(text: str) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(text: str) -> Column:
    """Hashes of all runs of five words of a text, as often as they occur.

    The words are bound to a lambda variable, so that a predicate that Catalyst moves down does not make them anew for
    each shingle.
    """

    def of(w: Column) -> Column:
        places = F.when(F.size(w) >= WIDTH, F.sequence(F.lit(0), F.size(w) - WIDTH)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WIDTH))))

    return F.get(F.transform(F.array(word_hashes(text)), of), F.lit(0))


def item_sets(items: DataFrame) -> DataFrame:
    """item_id, item (tells rows of one id apart), n (distinct shingles), shingles of items (item_id, text) that have any."""
    sets = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), F.array_sort(F.array_distinct(shingles("text"))).alias("shingles"))
    return sets.where(F.size("shingles") > 0).select("item_id", "item", F.size("shingles").alias("n"), "shingles").dropDuplicates(["item"])


def signatures(sets: DataFrame, percent: int) -> DataFrame:
    """item, n, value: the smallest hashes of each item, as many as its size partition needs."""
    part = F.floor(F.log2("n")).cast("int")
    largest = F.pow(F.lit(2.0), part + 1).cast("int") - 1
    keep = F.floor(largest * (100 - percent) / 100).cast("int") + 1
    return sets.select("item", "n", F.explode(F.slice("shingles", F.lit(1), keep)).alias("value"))


def leaks(
    docs: DataFrame, items: DataFrame, *, percent: int = 75, most_broadcast: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row per (doc_id, item_id) found: n_shared and n_item, distinct shingles of the item in the document and in all."""
    sets = materialize(item_sets(items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))))
    keys = materialize(signatures(sets, percent))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    each = base.select("row", shingles("text").alias("own")).select("row", F.size("own").alias("n_doc"), F.explode("own").alias("value"))
    if keys.count() <= most_broadcast:
        met = each.join(F.broadcast(keys), "value")
    else:
        salt = F.pmod(F.xxhash64("row", F.lit(3)), F.lit(SALTS)).cast("int")
        met = each.withColumn("salt", salt).join(keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["value", "salt"])
    pairs = materialize(met.where(100 * F.col("n_doc") >= percent * F.col("n")).select("row", "item").distinct())
    rows = pairs.select("row").distinct()
    if pairs.count() <= most_broadcast:
        pairs, rows = F.broadcast(pairs), F.broadcast(rows)
    whole = base.join(rows, "row", "left_semi").select("row", "doc_id", shingles("text").alias("own"))
    shared = F.size(F.array_intersect("own", "shingles"))
    found = whole.join(pairs, "row").join(sets, "item").select("doc_id", "item_id", F.struct(shared.cast("long").alias("n_shared"), F.col("n").cast("long").alias("n_item")).alias("x"))
    enough = found.where(100 * F.col("x.n_shared") >= percent * F.col("x.n_item"))
    best = enough.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("x.n_shared") / F.col("x.n_item")).alias("part"), "x")).alias("best"))
    return best.select("doc_id", "item_id", "best.x.n_shared", "best.x.n_item")
