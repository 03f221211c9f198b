"""Token counts by finite-state tokenizer compilation.

A BPE vocabulary with scores is compiled into a deterministic transducer over characters. After each prefix of a word
the segmentation that BPE gives to the prefix has one last piece, and which piece that is depends only on the suffix of
the prefix that can still grow into a piece and on the last pieces at the positions inside that suffix. Such a
(suffix, last pieces, relative counts) triple is a state; a transition carries the change of the token count (it may be
negative, as a later character can join pieces). States are made when they are first reached and kept.

Long texts are cut into chunks that Spark spreads. A chunk map takes each state in which the text before may end to the
state in which the chunk ends and to the change of the count. Which states those are is found by starting the machine at
each of the last characters before the chunk: a state depends on what went before through a short suffix only, so nearly
always all starts end in one state, and a text of one repeated character in as many as it has phases. Paths that meet go
on as one. Maps compose associatively, level by level as in a parallel prefix scan; a text needs no white space for it. An
entry state that a map lacks is walked for the whole text in its place, so the count is exact for every text.

Null and empty texts have no tokens; an empty table gives no rows. Each row gives a row, repeated rows too; extra columns
are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import keep_only, materialize

MARK = "▁"
UNITS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
RESET = re.compile(f"(?<=[^{MARK}]){MARK}")
#: States and words that are kept in a worker; beyond that they are made anew.
MOST_STATES, MOST_WORDS = 400_000, 1_000_000


class Transducer:
    """pieces: text -> score of the pieces that merges can make; characters outside them cost their UTF-8 bytes."""

    START = ("", (None,), (0,))

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.prefixes = {p[:i] for p in pieces for i in range(len(p) + 1)}
        self.pair_ok: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.ids, self.states, self.edges = {self.START: 0}, [self.START], [{}]

    def segment(self, s: str) -> list[str]:
        """Plain BPE: the best-scored adjacent pair, leftmost first, until none is a piece."""
        parts, score = list(s), self.pieces
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                v = score.get(parts[i] + parts[i + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands(self, left: str | None, piece: str) -> bool:
        """Does BPE leave `piece` as a piece of its own after `left`?"""
        if piece not in self.whole:
            self.whole[piece] = self.segment(piece) == [piece]
        if not self.whole[piece] or left is None:
            return self.whole[piece]
        ok = self.pair_ok.get((left, piece))
        if ok is None:
            if len(self.pair_ok) > 4 * MOST_STATES:
                self.pair_ok.clear()
            ok = self.pair_ok[left, piece] = self.segment(left + piece) == [left, piece]
        return ok

    def step(self, at: int, c: str) -> tuple[int, int]:
        """The transition of state `at` on c: (state, change of the token count)."""
        suffix, lasts, counts = self.states[at]
        if c not in self.pieces:
            nxt, delta = self.START, len(c.encode())
        else:
            grown = suffix + c
            for k in range(len(grown)):
                if grown[k:] in self.pieces and self.stands(lasts[k], grown[k:]):
                    break
            else:
                raise ValueError(f"no segmentation of {grown!r}")
            last, delta = grown[k:], counts[k] + 1
            k = next(k for k in range(len(grown) + 1) if grown[k:] in self.prefixes)
            nxt = (grown[k:], (*lasts, last)[k:], tuple(x - delta for x in (*counts, delta)[k:]))
        to = self.ids.get(nxt)
        if to is None:
            to = self.ids[nxt] = len(self.states)
            self.states.append(nxt)
            self.edges.append({})
        self.edges[at][c] = out = (to, delta)
        return out

    def walk(self, state: tuple, text: str) -> tuple[tuple, int]:
        """The state after `text` from a state, and the change of the count."""
        if len(self.states) > MOST_STATES:
            self.reset()
        at = self.ids.get(state)
        if at is None:
            at = self.ids[state] = len(self.states)
            self.states.append(state)
            self.edges.append({})
        total, edges = 0, self.edges
        for c in text:
            at, delta = edges[at].get(c) or self.step(at, c)
            total += delta
        return self.states[at], total

    def count(self, word: str) -> int:
        """Sum of the counts along the path of one word."""
        if len(self.states) > MOST_STATES:
            self.reset()
        at, total, edges = 0, 0, self.edges
        for c in word:
            at, delta = edges[at].get(c) or self.step(at, c)
            total += delta
        return total


class Words(dict):
    """Paths from the start state through whole words, as they were first walked.

    Keys lack the word mark in front. A key that begins with a line feed has no mark: a line feed is in no piece, so it
    costs one byte and the automaton starts anew behind it.
    """

    def __init__(self, machine: Transducer):
        self.machine = machine

    def __missing__(self, word: str) -> int:
        n = self.machine.count(word if word[:1] == "\n" else MARK + word)
        if len(self) > MOST_WORDS:
            self.clear()
        self[word] = n
        return n


def whole_count(words: Words, text: str) -> int:
    """Tokens of a text that is already marked."""
    if MARK + MARK in text or text[:1] != MARK:
        return sum(map(words.machine.count, UNITS.findall(text)))
    return sum(map(words.__getitem__, text[1:].replace("\n", MARK + "\n").split(MARK)))


#: A chunk map: entry state -> (exit state, change of the count).
ChunkMap = dict[tuple, tuple[tuple, int]]
#: Characters before a chunk from which the machine is started to find the entry states.
LEAD = 48


def chunk_map(words: Words, lead: str, text: str) -> ChunkMap:
    """The map of a marked chunk that the marked characters `lead` precede (none: the chunk begins the text)."""
    machine = words.machine
    entries = {machine.walk(machine.START, lead[k:])[0] for k in range(len(lead))} or {machine.START}
    paths, at = {e: (e, 0) for e in entries}, 0
    while at < len(text):
        now = {state for state, _ in paths.values()}
        marks = _resets(text, at) if len(now) == 1 else None
        if marks:  # one path, and words ahead: these are counted as words, the rest is walked
            first, last = marks
            state, n = machine.walk(*now, text[at:first])
            end, more = machine.walk(machine.START, text[last:])
            n += whole_count(words, text[first:last]) + more
            return {e: (end, before + n) for e, (_, before) in paths.items()}
        # paths that have met walk on as one
        walked = {state: machine.walk(state, text[at : at + LEAD]) for state in now}
        paths = {e: (walked[state][0], n + walked[state][1]) for e, (state, n) in paths.items()}
        at += LEAD
    return paths


def _resets(text: str, at: int) -> tuple[int, int] | None:
    """The first and the last place behind `at` where a word mark follows another character: there the machine begins
    anew. None if there are no two."""
    found = RESET.search(text, at + 1)
    if not found:
        return None
    last = text.rfind(MARK)
    while last > found.start() and text[last - 1] == MARK:
        last -= 1
    return (found.start(), last) if last > found.start() else None


def compose(a: ChunkMap, b: ChunkMap) -> ChunkMap:
    """The map of chunk a followed by chunk b, for the entries of a whose exits b knows."""
    return {e: (b[x][0], n + b[x][1]) for e, (x, n) in a.items() if x in b}


def scan(maps: list[ChunkMap]) -> int | None:
    """Compose the maps of a text pairwise, level by level; None if a map lacks the entry that occurs."""
    while len(maps) > 1:
        maps = [compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0].get(Transducer.START, (None, None))[1]


_compiled: dict[str, Words] = {}


def load(path: str) -> Words:
    """The transducer of a sentencepiece BPE model file, once for each worker process."""
    if path not in _compiled:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        _compiled[path] = Words(Transducer(pieces))
    return _compiled[path]


def token_counts(docs: DataFrame, *, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, chunk_chars: int = 1 << 16) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit (n_tokens > limit), without special tokens.
    Ids are whole numbers, given as long.

    path: a sentencepiece BPE model with byte fallback, identity normalisation and a word mark in front of each text,
    readable on every executor.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(path)
        keep_only(words)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = [whole_count(words, MARK + t.replace(" ", MARK)) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(path)
        keep_only(words)
        for batch in batches:
            found, sizes = [], []
            for k, t in zip(batch.column("k").to_pylist(), batch.column("text").to_pylist(), strict=True):
                lead = LEAD if k else 0
                marked = (MARK if k == 0 else "") + t.replace(" ", MARK)
                found.append(pickle.dumps(chunk_map(words, marked[:lead], marked[lead:])))
                sizes.append(len(t[lead:].encode()))
            cols = [*(batch.column(c) for c in ("doc_id", "at", "copies", "k")), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "at", "copies", "k", "size", "map"])

    def scans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [scan([pickle.loads(m["map"]) for m in row]) for row in batch.column("maps").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "at", "copies", "n_bytes")), pa.array(n, pa.int64())], names=["doc_id", "at", "copies", "n_bytes", "n_tokens"])

    length = F.length("text")
    long = base.where(length > chunk_chars).withColumn("at", F.xxhash64("text"))
    # equal rows have one map; a chunk brings the characters before it
    begin = F.col("k") * chunk_chars + 1 - F.when(F.col("k") > 0, LEAD).otherwise(0)
    size = chunk_chars + F.when(F.col("k") > 0, LEAD).otherwise(0)
    chunks = (
        long.withColumn("k", F.explode(F.sequence(F.lit(0), F.ceil(length / chunk_chars).cast("int") - 1)))
        .select("doc_id", "at", "k", F.substring(F.col("text"), begin, size).alias("text"))
        .groupBy("doc_id", "at", "k", "text")
        .agg(F.count("*").alias("copies"))
        .mapInArrow(maps, "doc_id long, at long, copies long, k int, size long, map binary")
        .groupBy("doc_id", "at", "copies")
        .agg(F.sum("size").alias("n_bytes"), F.sort_array(F.collect_list(F.struct("k", "map"))).alias("maps"))
        .mapInArrow(scans, "doc_id long, at long, copies long, n_bytes long, n_tokens long")
    )
    found = materialize(chunks)
    composed = found.where("n_tokens is not null").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    composed = composed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    # texts whose maps lacked an entry are walked whole
    open_ = found.where("n_tokens is null").select(F.col("doc_id").alias("_id"), F.col("at").alias("_at"))
    walked = long.join(open_, long["doc_id"].eqNullSafe(open_["_id"]) & (long["at"] == open_["_at"]), "left_semi").select("doc_id", "text").mapInArrow(short, out)
    return base.where(length <= chunk_chars).mapInArrow(short, out).unionByName(composed).unionByName(walked)
