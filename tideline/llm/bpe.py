"""BPE encoding and decoding by a tokenization automaton.

The automaton reads token sequences and accepts exactly those that BPE makes. It begins with one state and an arc for
each byte. The merges are then applied in their order, each as a gadget: for u v -> w the state behind u loses its arc v,
and wherever an arc u begins, an arc w is added that lands in the state behind v as it stood then. All arcs of one token
land in one state, so a state is named by the token read last and the result is deterministic.

A gadget removes one arc, and with it the arcs of all tokens made later whose left part goes back to that arc; it copies
one state. Both are kept as they are made, not spelt out: a state holds the arcs that it lost with the time of the loss,
and a link to the state that it was copied from. An arc is then looked up along those links.

A word has one accepting path. Each prefix of the word has one as well, and its last token is the only one of the tokens
ending there whose arc leaves the state of the prefix before it. A table of steps from node to node of a trie of all labels
lists the tokens ending at a byte; the path is read back from the end of the word. Decoding emits the labels of the arcs.

Words are those of the byte-level pre-tokenizer's pattern. A text is first cut in front of single spaces between two
characters that are no white space, which always are word bounds; what stands between is split by the pattern, and both
are kept in bounded tables.

Null and empty texts have no tokens; an empty table gives no rows. Each row gives a row, repeated rows and rows without an
id too; extra columns of the input are left out of the encoding. Texts of any length are encoded in parts of PART
characters at least.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import slices

#: How the pre-tokenizer of byte-level vocabularies splits a text into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space between two characters that are no white space.
BOUND = re.compile(r"(?<=\S) (?=\S)")
NEAR_SPACES = re.compile(r"\s\s")
#: Chunks and words after which a worker sets its table aside (it keeps two), the characters of the longest that it keeps, and words that are encoded together.
MOST_KEPT, LONGEST_KEPT, TOGETHER = 200_000, 32, 1 << 15
#: Arcs that a worker keeps as looked up.
MOST_ARCS = 1_000_000
#: Characters of a text that are encoded at a time, and bytes of texts in a batch.
PART, BATCH = 1 << 20, 4 << 20
NEVER = 1 << 60


class TokenAutomaton:
    """labels: bytes of each token by id (None: no token); merges: (left, right, whole) ids in their order."""

    def __init__(self, labels: list[bytes | None], merges: list[tuple[int, int, int]]):
        self.labels = labels
        size = len(labels)
        self.born = [-1] * size
        #: The arcs that the state of a token lost, by token, with the time of the loss.
        self.lost: list[dict[int, int]] = [{} for _ in range(size)]
        #: The states that a state was copied from, each with the time of the copy; the token itself first.
        self.copies: list[tuple] = [((self.lost[t], NEVER),) for t in range(size)]
        #: The tokens that a token begins with, each with the time at which the next longer one was made.
        self.heads: list[tuple] = [((t, NEVER),) for t in range(size)]
        self.alive: set[int] = set()
        made = set()
        for time, merge in enumerate(merges):
            self.gadget(time, *merge)
            if merge[2] in made or self.born[merge[0]] >= time or self.born[merge[1]] >= time:
                raise ValueError(f"merge {time} makes a token a second time, or from tokens that are made later")
            made.add(merge[2])
        single = [t for t in range(size) if self.labels[t] is not None and len(self.labels[t]) == 1 and t not in made]
        self._trie(single + [t for t in made if t in self.alive])

    def gadget(self, time: int, left: int, right: int, whole: int) -> None:
        if self.labels[left] + self.labels[right] != self.labels[whole]:
            raise ValueError(f"merge {time} does not make {self.labels[whole]}")
        self.born[whole] = time
        if not (self._is_made(left) and self._is_made(right) and self.arc(left, right)):
            return  # no path reads left and right one after the other: the token never comes about
        self.alive.add(whole)
        self.copies[whole] = ((self.lost[whole], NEVER), (self.copies[right][0][0], time), *self.copies[right][1:])
        self.heads[whole] = ((whole, NEVER), (left, time), *self.heads[left][1:])
        self.lost[left][right] = time

    def _is_made(self, token: int) -> bool:
        return self.born[token] < 0 or token in self.alive

    def arc(self, last: int, token: int) -> bool:
        """Does an arc of `token` leave the state behind `last`?"""
        heads = self.heads[token]
        for lost, copied in self.copies[last]:
            if lost:
                for head, longer in heads:
                    at = lost.get(head)
                    if at is not None and at < copied and at <= longer:
                        return False
        return True

    def _trie(self, tokens: list[int]) -> None:
        """Tables over nodes for all beginnings of labels."""
        children: list[list[tuple[int, int]]] = [[]]
        goto: dict[int, int] = {}
        by_node: dict[int, int] = {}
        for t in tokens:
            at = 0
            for b in self.labels[t]:
                to = goto.get(at << 8 | b)
                if to is None:
                    to = goto[at << 8 | b] = len(children)
                    children[at].append((b, to))
                    children.append([])
                at = to
            by_node[at] = t
        # step: the node after a byte, with the links to suffixes followed; longest: the longest token that ends at a node,
        # shorter: the longest one that ends a token
        self.step = np.zeros((len(children), 256), np.int32)
        self.longest = np.full(len(children), -1, np.int32)
        self.shorter = np.full(len(self.labels), -1, np.int32)
        link = array("i", [0]) * len(children)
        breadth_first = array("i", [0])
        for at in breadth_first:
            self.step[at] = self.step[link[at]]
            for b, to in children[at]:
                link[to] = self.step[at, b] if at else 0
                ends = self.longest[link[to]]
                if to in by_node:
                    self.longest[to], self.shorter[by_node[to]] = by_node[to], ends
                else:
                    self.longest[to] = ends
                breadth_first.append(to)
            for b, to in children[at]:
                self.step[at, b] = to
        self.sizes = np.array([len(x or b"") for x in self.labels], np.int32)
        #: Arcs that were looked up: sorted last * 2**32 + token, and whether there is one.
        self.pairs, self.open = np.zeros(0, np.int64), np.zeros(0, bool)

    def arcs(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """arc() of many pairs, each looked up once."""
        key = last.astype(np.int64) << 32 | token
        at = np.searchsorted(self.pairs, key)
        known = at < len(self.pairs)
        known[known] = self.pairs[at[known]] == key[known]
        if not known.all():
            new = np.unique(key[~known])
            if len(self.pairs) + len(new) > MOST_ARCS:
                self.pairs, self.open, new = np.zeros(0, np.int64), np.zeros(0, bool), np.unique(key)
            found = np.array([self.arc(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()], bool)
            at = np.searchsorted(self.pairs, new)
            self.pairs, self.open = np.insert(self.pairs, at, new), np.insert(self.open, at, found)
            at = np.searchsorted(self.pairs, key)
        return self.open[at]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The tokens on the accepting path of each word, as little-endian unsigned 32-bit integers; all words take their
        steps together, one byte at a time."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        size = np.array([len(words[i]) for i in order], np.int32)
        data = np.frombuffer(b"".join(words[i] for i in order), np.uint8)
        begin = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        last = np.full((len(words), int(size[0]) + 1 if len(words) else 1), -1, np.int32)  # token that ends each prefix
        node = np.zeros(len(words), np.int32)
        n = len(words)
        for i in range(1, last.shape[1]):
            n = int(np.searchsorted(-size[:n], -i, "right"))  # words of i bytes at least
            node = self.step[node[:n], data[begin[:n] + (i - 1)]]
            row, token = np.arange(n), self.longest[node]
            while len(row):
                if (token < 0).any():
                    raise ValueError("a byte that no token has")
                before = last[row, i - self.sizes[token]]
                open_ = before < 0  # the start's state has every arc
                open_[~open_] = self.arcs(before[~open_], token[~open_])
                last[row[open_], i] = token[open_]
                row, token = row[~open_], self.shorter[token[~open_]]
        # read back from the end
        row, at, path = np.arange(n := len(words)), size.copy(), []
        while len(row):
            token = last[row, at[row]]
            path.append((row, token))
            at[row] -= self.sizes[token]
            row = row[at[row] > 0]
        rows = np.concatenate([r for r, _ in path]) if path else np.zeros(0, np.int64)
        tokens = np.concatenate([t for _, t in path]) if path else np.zeros(0, np.int32)
        counts = np.bincount(rows, minlength=n)
        flat = tokens[::-1][np.argsort(rows[::-1], kind="stable")].astype("<u4").tobytes()
        ends, out = np.cumsum(4 * counts).tolist(), [b""] * n
        begins = [0, *ends[:-1]] if n else []
        for k, i in enumerate(order):
            out[i] = flat[begins[k] : ends[k]]
        return out

    def encode_long(self, word: bytes) -> bytes:
        """The same for one word, byte by byte: for words too long to stand beside others."""
        step, longest, shorter, sizes, at = self.step, self.longest, self.shorter, self.sizes, 0
        last, known = array("i", [-1]), {}
        for i, b in enumerate(word, 1):
            at = int(step[at, b])
            t = int(longest[at])
            while True:
                if t < 0:
                    raise ValueError("a byte that no token has")
                before = last[i - int(sizes[t])]
                if before < 0:
                    break
                key = before << 32 | t
                if key not in known:
                    known[key] = self.arc(before, t)
                if known[key]:
                    break
                t = int(shorter[t])
            last.append(t)
        out, i = [], len(word)
        while i:
            out.append(last[i])
            i -= int(sizes[last[i]])
        return np.array(out[::-1], "<u4").tobytes()


class Labels:
    """Labels of the arcs by id; a special token has its text."""

    def __init__(self, path: str):
        _, own, self.special = _read(path)
        self.labels = [x or b"" for x in own]
        for text, i in self.special.items():
            self.labels[i] = text.encode()

    def decode(self, ids: bytes) -> bytes:
        """The labels of a path, one after the other; bytes that are no UTF-8 are replaced."""
        return b"".join(map(self.labels.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace").encode()


def _read(path: str) -> tuple[dict, list[bytes | None], dict[str, int]]:
    """The file, the bytes of each id (None: no ordinary token), and the ids of special tokens."""
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    if held["normalizer"] or held["pre_tokenizer"]["type"] != "ByteLevel" or held["pre_tokenizer"]["add_prefix_space"] or not held["pre_tokenizer"]["use_regex"]:
        raise ValueError(f"{path} is no plain byte-level vocabulary")
    to_byte = {c: b for b, c in enumerate(_byte_letters())}
    vocab, special = held["model"]["vocab"], {x["content"]: x["id"] for x in held["added_tokens"]}
    labels: list[bytes | None] = [None] * (1 + max([*vocab.values(), *special.values()]))
    for text, i in vocab.items():
        if text not in special:
            labels[i] = bytes(to_byte[c] for c in text)
    return held, labels, special


class Codec:
    """The automaton of a byte-level BPE file of the tokenizers library, with the words it has met."""

    def __init__(self, path: str):
        import regex

        held, labels, self.special = _read(path)
        model = held["model"]
        vocab = model["vocab"]
        self.automaton = TokenAutomaton(labels, [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])])
        self.word = regex.compile(WORD)
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        #: Words, and what stands between two bounds without the space in front (one that begins with a line feed has none):
        #: those met lately, and those met before them.
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.old_chunks: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, str | int, bool]] = []
        size = 0
        for k, text in enumerate(texts):
            for part in self._parts(text):
                held.append((k, *part))
                size += len(part[0]) if isinstance(part[0], str) else 1
                if size >= PART:
                    self._encode_parts(held, out)
                    held, size = [], 0
        self._encode_parts(held, out)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _parts(self, text: str) -> Iterator[tuple[str | int, bool]]:
        """Special ids, and parts of the text between them; True: a space stood in front of the part."""
        at = 0
        for found in self.cut.finditer(text) if self.cut else ():
            yield from self._cut_long(text[at : found.start()])
            yield self.special[found[0]], False
            at = found.end()
        yield from self._cut_long(text[at:] if at else text)

    def _cut_long(self, text: str) -> Iterator[tuple[str, bool]]:
        at = 0
        while len(text) - at > PART and (found := BOUND.search(text, at + PART)):
            yield text[at : found.start()], at > 0
            at = found.end()
        if text:
            yield (text[at:] if at else text), at > 0

    def _encode_parts(self, held: list[tuple[int, str | int, bool]], out: list[list[bytes]]) -> None:
        if len(self.words) > MOST_KEPT:
            self.words, self.old_words = {}, self.words
        if len(self.chunks) > MOST_KEPT:
            self.chunks, self.old_chunks = {}, self.chunks
        cut: list[tuple[list[str], list[str]] | None] = []
        for _, text, spaced in held:
            if isinstance(text, int):
                cut.append(None)
                continue
            # a line feed alone between two characters is a word; what follows it has no space in front
            pieces = BOUND.split(text) if NEAR_SPACES.search(text) else text.replace("\n", " \n").split(" ")
            cut.append(([], pieces) if spaced else (self.word.findall(pieces[0]), pieces[1:]))
        split = {c: self._words_of(c) for c in _absent(set().union(*(x[1] for x in cut if x)), self.chunks, self.old_chunks)}
        wanted = _absent(set().union(*split.values(), *(x[0] for x in cut if x)), self.words, self.old_words)
        long = {w: self.automaton.encode_long(w.encode()) for w in wanted if len(w) > LONGEST_KEPT}
        short = [w for w in wanted if len(w) <= LONGEST_KEPT]
        for i in range(0, len(short), TOGETHER):
            some = short[i : i + TOGETHER]
            self.words.update(zip(some, self.automaton.encode([w.encode() for w in some]), strict=True))
        words = self.words if not long else ChainMap(self.words, long)
        for c, ws in split.items():
            self.chunks[c] = words[ws[0]] if len(ws) == 1 else b"".join([words[w] for w in ws])
        for (k, text, _), x in zip(held, cut, strict=True):
            out[k].append(text.to_bytes(4, "little") if x is None else b"".join([words[w] for w in x[0]]) + b"".join(map(self.chunks.__getitem__, x[1])))
        for c in [c for c in split if len(c) > LONGEST_KEPT]:
            del self.chunks[c]

    def _words_of(self, chunk: str) -> list[str]:
        if chunk.isalpha():
            return [" " + chunk]
        if chunk[:1] == "\n":
            return ["\n", chunk[1:]] if chunk[1:].isalpha() else self.word.findall(chunk)
        return self.word.findall(" " + chunk)


def _absent(keys: set[str], kept: dict[str, bytes], old: dict[str, bytes]) -> set[str]:
    """Keys that are in neither table; what only the old one has is kept anew."""
    keys.difference_update(kept)
    again = {k: old[k] for k in keys if k in old}
    kept.update(again)
    return keys.difference(again)


def _byte_letters() -> list[str]:
    """The character that stands for each byte: visible ones for themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=2)
def load(path: str) -> Codec:
    """The codec of a file, compiled once for each worker process."""
    return Codec(path)


@lru_cache(maxsize=2)
def labels_of(path: str) -> Labels:
    return Labels(path)


def encode(docs: DataFrame, *, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: str | None = None) -> DataFrame:
    """One row per document: doc_id long, n_tokens long, ids binary (little-endian unsigned 32-bit integers).

    path: a byte-level BPE file of the tokenizers library, readable on every executor. Special tokens in a text are one
    id each, as in the library; none are added. decoded: the name of one more column with the text that decoding the ids
    gives, made in the same pass.
    """
    if decoded in ("doc_id", "n_tokens", "ids"):
        raise ValueError(f"there is a column {decoded} already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, own = load(path), labels_of(path) if decoded else None
        for batch in slices(batches, "text", BATCH):
            ids = codec.encode(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([own.decode(x) for x in ids], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_tokens", "ids", *([decoded] if decoded else [])]
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return base.mapInArrow(run, "doc_id long, n_tokens long, ids binary" + (f", `{decoded}` string" if decoded else ""))


def decode(encoded: DataFrame, *, path: str, ids_col: str = "ids", into: str = "text") -> DataFrame:
    """The table with the texts of its ids in place of the ids; null ids have no text. An unknown id is an error."""
    kept = [c for c in encoded.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = labels_of(path)
        for batch in slices(batches, ids_col, BATCH):
            texts = [None if x is None else own.decode(x) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.binary()).cast(pa.string())], names=[*kept, into])

    schema = encoded.select(*kept).schema.add(into, "string")
    return encoded.mapInArrow(run, schema)
