"""Packing of tokenized documents into sequences: first-fit decreasing with a tournament tree of bin capacities.

Documents are shuffled at random by a hash of their id and cut into groups of about `group_tokens` tokens; each group is
packed on its own, so a group is the unit of memory and of recovery. Ids longer than a sequence are cut into full
pieces; what is left over is packed by first-fit decreasing. Last, the emptiest bins of the group are dealt out into the
gaps of the fuller ones, with cuts, so that at most the last bin of a group has room left; that one is cut at powers of
two, whose sequences need no padding.

A null text is an empty one: it has the end id only. Equal rows are packed once each, in order of their ids and texts.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import gives_back, keep_only, slices

MOST_RUNS = 400_000

#: Letters of Latin-1, and those in lower case.
_LETTERS, _LOWER = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "a-zªµºß-öø-ÿ"
#: Runs of letters and of what stands between them, in a lower-cased text of Latin-1.
RUNS = re.compile(f"[{_LOWER}]+|[^{_LOWER} \n]+")
#: The same in any text; a part between spaces that is not plain stays whole.
MIXED = re.compile(f"[^ \n]*(?:[^\x00-\xff]|'|<\\|)[^ \n]*|[{_LETTERS}]+|[^{_LETTERS} \n]+")
WORD = re.compile("[a-zß-öø-ÿ]+")


def plain(text: str) -> bool:
    """All Latin-1, without apostrophes and special strings."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "'" not in text and "<|" not in text


class WordIds(dict):
    """Ids, as bytes, of runs of letters or of other characters, and of parts between spaces.

    The tokenizer lower-cases, drops white space and splits letters from other characters, so a text may be cut at
    spaces, and a part that is all Latin-1 without apostrophes (contractions) or "<|" (special strings) also between
    runs of letters and of other characters. Runs are tokenized once, many at a time.
    """

    def __init__(self, path: str):
        # Spark's tasks are the parallelism; the library's own threads would only contend with them
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def learn(self, new: set[str]) -> None:
        """Tokenize runs that are not known yet."""
        words = list(filter(WORD.fullmatch, new))
        rest = list(new.difference(words))
        for k in range(0, len(words), 500):
            # a word of letters only has one token that ends a word, its last
            own = words[k : k + 500]
            ids = np.array(self.encode([" ".join(own)])[0].ids, self.kind)
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) != len(own):
                rest += own
                continue
            flat, stops = ids.tobytes(), (ends * self.kind.itemsize).tolist()
            self.update(zip(own, map(flat.__getitem__, map(slice, [0, *stops], stops)), strict=True))
        for r, e in zip(rest, self.encode(rest), strict=True):
            self[r] = array(self.code, e.ids).tobytes()

    def encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def ids(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """The ids of each text and end_id."""
        runs = [RUNS.findall(t.lower()) if plain(t) else MIXED.findall(t) for t in texts]
        new = set().union(*runs).difference(self)
        if new:
            if len(self) > MOST_RUNS:
                self.clear()
                new = set().union(*runs)
            self.learn(new)
        end = array(self.code, [end_id]).tobytes()
        return [np.frombuffer(b"".join(map(self.__getitem__, own)) + end, self.kind) for own in runs]


class Tournament:
    """A complete binary tree over bins in the order they were opened; each node holds the largest room below it."""

    def __init__(self, bins: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.room = [0] * (2 * self.size)

    def set(self, k: int, room: int) -> None:
        k += self.size
        self.room[k] = room
        while k > 1:
            k >>= 1
            self.room[k] = max(self.room[2 * k], self.room[2 * k + 1])

    def first(self, need: int) -> int:
        """The first bin with so much room, -1 if none."""
        if self.room[1] < need:
            return -1
        k = 1
        while k < self.size:
            k *= 2
            if self.room[k] < need:
                k += 1
        return k - self.size


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indexes of `lengths` (each at most capacity) by bin."""
    bins: list[list[int]] = []
    tree = Tournament(max(1, len(lengths)))
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        k = tree.first(lengths[i])
        if k < 0:
            k = len(bins)
            bins.append([])
            tree.set(k, capacity)
        bins[k].append(i)
        tree.set(k, tree.room[k + tree.size] - lengths[i])
    return bins


def pack_group(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (index, start, length) that hold every id of items 0..n-1 once."""
    full, rest = [], []
    for i, n in enumerate(lengths):
        cut = n - n % capacity
        full += [[(i, at, capacity)] for at in range(0, cut, capacity)]
        if n > cut:
            rest.append((i, cut, n - cut))
    bins = [[rest[k] for k in b] for b in first_fit_decreasing([x[2] for x in rest], capacity)]
    room = [capacity - sum(x[2] for x in b) for b in bins]
    # the emptiest bins fill the gaps of the others
    order = sorted(range(len(bins)), key=lambda k: (room[k], k))
    lo, hi = 0, len(order) - 1
    while lo < hi:
        to, source = order[lo], order[hi]
        if room[to] == 0:
            lo += 1
        elif not bins[source]:
            hi -= 1
        else:
            i, at, n = bins[source].pop()
            part = min(n, room[to])
            bins[to].append((i, at, part))
            room[to] -= part
            if part < n:
                bins[source].append((i, at + part, n - part))
            room[source] += part
    out = full + [b for b in bins if b]
    last = [k for k, b in enumerate(out) if sum(x[2] for x in b) < capacity]
    if last:  # at most one has room: cut it at powers of two
        pieces = out.pop(last[0])
        used = sum(x[2] for x in pieces)
        sizes = [1 << b for b in range(used.bit_length()) if used >> b & 1][::-1]
        for size in sizes:
            seq = []
            while size:
                i, at, n = pieces.pop()
                part = min(n, size)
                seq.append((i, at, part))
                size -= part
                if part < n:
                    pieces.append((i, at + part, n - part))
            out.append(seq)
    return out


_loaded: dict[str, WordIds] = {}


def load(path: str) -> WordIds:
    """The words of a tokenizer file, kept for all tasks of a worker process."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def pack(docs: DataFrame, *, path: str, end_id: int = 2, capacity: int = 4096, group_tokens: int = 1 << 22, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if with_ids.

    path: a tokenizers file whose normaliser and pre-tokenizer drop white space, readable on every executor.
    Ids are whole numbers, given as long. capacity: a power of two. end_id closes each document. sequence_id: unique, ascending within a partition.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(path)
        keep_only(words)
        sequence = TaskContext.get().partitionId() << 36
        ids: list[np.ndarray] = []
        owners: list[int] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, held
            rows = []
            for pieces in pack_group([len(x) for x in ids], capacity):
                at = 0
                for i, start, n in pieces:
                    own = ids[i][start : start + n].astype("<u4")
                    rows.append((owners[i], start, n, zlib.crc32(own), len(ids[i]), sequence, at) + (own.astype(np.int32),) * with_ids)
                    at += n
                sequence += 1
            ids.clear()
            owners.clear()
            held = 0
            for k in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*rows[k : k + 4096], strict=True), kinds, strict=True)], names=names)

        for batch in slices(batches, "text", 1 << 20):
            for owner, own in zip(batch.column("doc_id").to_pylist(), words.ids(batch.column("text").to_pylist(), end_id), strict=True):
                ids.append(own)
                owners.append(owner)
                held += len(own)
                if held >= group_tokens:
                    yield from flush()
        if ids:
            yield from flush()

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = base.withColumn("at", F.xxhash64("doc_id", F.lit(seed))).repartition("at").sortWithinPartitions("at", "doc_id", "text")
    return dealt.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids)
