"""Spelling variants: words of a corpus that differ by one code point, by dynamic programming along sorted lists.

Words are counted in each task before they are shuffled. Two words that differ by one insertion, deletion or replacement
share the first half of the shorter one or its second half; so each word goes to the groups of its first half and of its
second half, for either length that the shorter one may have. Groups of more than `most` words are split the same way
again, by the halves of the middle that is still open, so that what is left together at the end agrees in all but one code
point; a group of any size is cut up without leaving a pair out. A pair is taken where the first half of the open middle
agrees, else in the other group, so it is found once.

In a group the middles are sorted. Each word of the shorter length is compared with the list from front to back: the rows
of its edit matrix, three cells wide, are kept for the beginning that a middle shares with the one before it, and once a
row has no cell of one or less, all middles that share that beginning are skipped. Three cells of 0, 1 or 2 and three
comparisons have one successor each, which is looked up.

Null and empty texts have no words; an empty table gives no rows. Repeated rows count once each. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import product
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import materialize, slices

BATCH = 8 << 20
#: Words that a task counts before it hands them on.
MOST_COUNTED = 400_000
#: Bytes of Latin-1: letters, upper case of ASCII as lower case; all else separates.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Row (three cells of 0, 1, 2 or more, in base 3) * 8 + three bits of equal characters -> next row, and least cell of a row.
NEXT: list[int] = []
LEAST = [min(r) for r in product(range(3), repeat=3)]
START = 2 * 9 + 0 * 3 + 1


def _rows() -> Iterator[int]:
    for a, b, c in product(range(3), repeat=3):
        for x, y, z in product((1, 0), repeat=3):  # 1: the character differs
            first = min(2, a + x, b + 1)
            second = min(2, b + y, c + 1, first + 1)
            yield first * 9 + second * 3 + min(2, c + z, second + 1)


NEXT.extend(_rows())


def near_pairs(words: list[str], size: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of a sorted list of distinct strings of size or size + 1 characters that differ by one edit, and of
    which one has `size` characters."""
    n = len(words)
    shared = [0, *(len(commonprefix(words[k - 1 : k + 1])) for k in range(1, n))]
    for i, word in enumerate(words):
        if len(word) != size:
            continue
        x, rows, j = f"\0{word}\0\0", [START], 0
        while j < n:
            other = words[j]
            if j == i or (j < i and len(other) == size):
                # no comparison: keep the rows that the next one shares
                j += 1
                if j < n:
                    del rows[shared[j] + 1 :]
                continue
            depth, row = len(rows) - 1, rows[-1]
            while depth < len(other) and LEAST[row] < 2:
                c = other[depth]
                row = NEXT[row * 8 + (c == x[depth]) * 4 + (c == x[depth + 1]) * 2 + (c == x[depth + 2])]
                rows.append(row)
                depth += 1
            if LEAST[row] > 1:
                j += 1
                while j < n and shared[j] >= depth:
                    j += 1
            else:
                if (row // 9, row // 3 % 3, row % 3)[size - len(other) + 1] == 1:
                    yield i, j
                j += 1
            if j < n:
                del rows[shared[j] + 1 :]


def word_counts(docs: DataFrame, spell: Callable[[int | None, bytes], bytes] | None = None, *, shortest: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word string, n long: runs of Latin letters in all texts, A-Z as a-z, of `shortest` code points at least.

    spell: (id, run as Latin-1 bytes) -> the run to count in its place; it is called once for each run of a text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches, "text", BATCH):
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                runs = Counter(w for w in text.encode("latin-1", "replace").translate(LETTERS).split() if len(w) >= shortest)
                for w, n in runs.items():
                    if spell:
                        w = spell(i, w)
                        if len(w) < shortest:
                            continue
                    held[w] = held.get(w, 0) + n
                if len(held) > MOST_COUNTED:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return base.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


ENTRY = ("word", "n", "size", "front", "back", "below")


def _entries(words: DataFrame) -> DataFrame:
    """Each word for either length of the shorter one, with an open middle that is the whole of it. front, back: characters
    that a group shares; below: a pair of the group that shares this many at the front belongs elsewhere."""
    size = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size")
    return words.select("word", "n", size, F.lit(0).alias("front"), F.lit(0).alias("back"), F.lit(1 << 30).alias("below"))


def _halved(entries: DataFrame) -> DataFrame:
    """The two entries of each whose open middle is half as long."""
    half = F.expr("cast((size - front - back) div 2 as int)")
    left = F.struct((F.col("front") + half).alias("front"), F.col("back"), F.col("below"))
    right = F.struct(F.col("front"), (F.col("size") - F.col("front") - half).alias("back"), F.least("below", F.col("front") + half).alias("below"))
    return entries.withColumn("part", F.explode(F.array(left, right))).select("word", "n", "size", "part.*")


def near_words(words: DataFrame, *, most: int = 128) -> DataFrame:
    """a string, n_a long, b string, n_b long: every pair of the distinct words of (word string, n long) that differ by one
    code point, once.

    most: words of a group that are compared in one list and held in memory; larger groups are passed on as they are read
    and split until they agree in all but one code point, where at most one word for each character (and one more) is left.
    """
    entries, found = _entries(words), None
    while True:
        out = materialize(_compared(_halved(entries), most))
        part = out.where("a IS NOT NULL").select("a", "n_a", "b", "n_b")
        found = part if found is None else found.unionByName(part)
        entries = out.where("word IS NOT NULL").select(*ENTRY)
        if entries.isEmpty():
            return found


def _compared(entries: DataFrame, most: int) -> DataFrame:
    """The pairs of each group (a, n_a, b, n_b), and the entries of groups that are too large."""
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
    names = ["a", "n_a", "b", "n_b", *ENTRY]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, large, pairs, rest = None, [], False, [], []

        def finish() -> None:
            _, _, size, front, back, below = held[0]
            middles = sorted((w[front : len(w) - back], w, n) for w, n, *_ in held)
            inner = [m[0] for m in middles]
            for i, j in near_pairs(inner, size - front - back):
                if below > front + len(commonprefix([inner[i], inner[j]])):
                    pairs.append((*middles[i][1:], *middles[j][1:]))

        def emit() -> pa.RecordBatch:
            columns = [*zip(*pairs, strict=True)] if pairs else [()] * 4
            others = [*zip(*rest, strict=True)] if rest else [()] * len(ENTRY)
            columns = [[*c, *[None] * len(rest)] for c in columns] + [[*[None] * len(pairs), *c] for c in others]
            pairs.clear()
            rest.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", *ENTRY)]
            for k, *row in zip(*columns, strict=True):
                if k != key:
                    if len(held) > 1:
                        finish()
                    key, held, large = k, [], False
                if large:
                    rest.append(row)
                    continue
                held.append(row)
                # a middle of one code point cannot be halved
                if len(held) > most and row[2] - row[3] - row[4] > 1:
                    rest.extend(held)
                    held, large = [], True
            yield emit()
        if len(held) > 1:
            finish()
        yield emit()

    key = F.concat_ws("\t", F.col("size"), F.col("front"), F.col("back"), F.expr("substring(word, 1, front)"), F.expr("right(word, back)"))
    dealt = entries.withColumn("key", key).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(compare, "a string, n_a long, b string, n_b long, word string, n long, size int, front int, back int, below int")


def variant_groups(words: DataFrame, *, times: int = 5, most: int = 128) -> DataFrame:
    """One row per word of (word string, n long): word, n, n_near long (words that differ by one code point), form (of those
    the one with the largest n, ties to the smallest, if its n is `times` the word's at least), form_n, root (the word that
    is reached by following the forms).

    A form has `times` the occurrences of its word, so a chain of forms has at most log(largest n) links and no circle;
    roots are found by doubling.
    """
    if times < 2:
        raise ValueError("times must be 2 or more")
    pairs = near_words(words.select("word", "n"), most=most)
    ends = F.array(F.struct(F.col("a").alias("word"), F.col("n_b").alias("other_n"), F.col("b").alias("other")), F.struct(F.col("b").alias("word"), F.col("n_a").alias("other_n"), F.col("a").alias("other")))
    both = pairs.select(F.explode(ends).alias("e")).select("e.word", F.struct((-F.col("e.other_n")).alias("less"), F.col("e.other").alias("other")).alias("other"))
    # the largest count, and of those the smallest word
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    is_form = -F.col("best.less") >= times * F.col("n")
    out = words.select("word", "n").join(best, "word", "left")
    out = materialize(out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    links = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = materialize(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if links.where("moved").isEmpty():
            return out.join(links.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
        links = links.drop("moved")
