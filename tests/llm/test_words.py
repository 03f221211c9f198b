"""BPE coding, periodic runs and spelling variants against their library, brute force and edge cases; clashing names and id
types in all operators; what is left of checkpoints."""

import collections
import gc
import hashlib
import os
import random
import struct
import subprocess
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tideline.llm import bpe, common, decontamination, fixity, licenses, near_dup, packing, periodic_runs, quality, queries, spelling, substring_dedup, token_counts, topk, unit_dedup

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n", "one", "  two\n\n\nthree ", "a b c d e f", "x" * 70_000, "日本語" * 3000, "Ünï çödé　日本 \x00 <|endoftext|> </s><|endoftext|>", "A, b!\nA, b!\n" * 40, "\t\x85\xa0  a  b \r\n c", "'s't're I'd we'll"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BYTES)

    def run(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids), tokenizer.decode(ids, skip_special_tokens=False)

    return run


def test_codec_query_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = {k: (len(ids) // 4, sha(ids), sha(text.encode())) for k, (ids, text) in ((k, library(t)) for k, t in texts.items())}
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op11_bpe_codec(spark, SF).collect()} == want


def test_coding_of_odd_texts_and_back(spark, library):
    rows = [*enumerate(ODD), (3, "one"), (None, "no id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("ids", F.lit(1)).withColumn("N_tokens", F.lit("x"))
    out = bpe.encode(df.repartition(3), path=BYTES, decoded="back").collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["back"]) for r in out) == collections.Counter((i, len(x) // 4, x, t or "") for i, t in rows for x in [library(t)[0]])
    back = bpe.decode(bpe.encode(df, path=BYTES).withColumn("ids", F.when(F.col("doc_id") != 1, F.col("ids"))), path=BYTES).collect()
    assert {r["doc_id"]: r["text"] for r in back if r["doc_id"] not in (None, 1)} == {i: t or "" for i, t in rows if i not in (None, 1)}
    assert all(r["text"] is None for r in back if r["doc_id"] in (None, 1))
    assert bpe.encode(df.limit(0), path=BYTES).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(df, path=BYTES, decoded="ids")


@pytest.mark.parametrize("part,kept", [(1 << 20, 200_000), (40, 20)])
def test_coding_in_parts_and_with_small_tables(library, monkeypatch, part, kept):
    monkeypatch.setattr(bpe, "PART", part)
    monkeypatch.setattr(bpe, "MOST_KEPT", kept)
    monkeypatch.setattr(bpe, "MOST_ARCS", 2000 if kept < 100 else 1_000_000)
    codec, rnd, texts = bpe.Codec(BYTES), random.Random(part), []
    for i in range(1500):
        letters = ("abeth on\n  '<|>,.éß日", "theringatonds ", "的一是不了人 　", "aab", " \n\t\x0b\x1c\x85\xa0a1", "'s't're've'll'dA")[i % 6]
        texts.append("".join(rnd.choices(letters, k=rnd.randint(0, 200))))
    texts += ["".join(rnd.choices(["<|endoftext|>", " ", "x", "<|", "\n", "  "], k=9)) for _ in range(100)]
    for k in range(0, len(texts), 400):
        assert codec.encode(texts[k : k + 400]) == [library(t)[0] for t in texts[k : k + 400]]


def _gadgets(n, merges):
    """The automaton as states and arcs, merge by merge: state of each token -> tokens that may follow."""
    arcs = {None: set(range(n))} | {t: set(range(n)) for t in range(n)}
    for left, right, whole in merges:
        if not any(left in follow for follow in arcs.values()) or right not in arcs.get(left, ()):
            continue
        landed = set(arcs[right])
        arcs[left] = arcs[left] - {right}
        for t in arcs:
            if left in arcs[t]:
                arcs[t].add(whole)
        # the new arc lands in the state behind `right` as it stood: with arcs of the new token where it has those of left
        arcs[whole] = landed | ({whole} if left in landed else set())
    return arcs


def test_arcs_equal_gadgets_one_by_one():
    rnd = random.Random(3)
    for _ in range(150):
        n = rnd.randint(1, 3)
        labels, merges = [b"abc"[i : i + 1] for i in range(n)], []
        for _ in range(rnd.randint(0, 12)):
            u, v = rnd.randrange(len(labels)), rnd.randrange(len(labels))
            if len(labels[u] + labels[v]) < 9 and labels[u] + labels[v] not in labels:
                merges.append((u, v, len(labels)))
                labels.append(labels[u] + labels[v])
        own, want = bpe.TokenAutomaton(labels, merges), _gadgets(n, merges)
        assert set(range(n)) | own.alive == set(want) - {None}
        for t in want:
            if t is not None:
                assert {x for x in want if x is not None and own.arc(t, x)} == want[t]
        # and what the automaton accepts is what merging in order gives
        for _ in range(30):
            word = [rnd.randrange(n) for _ in range(rnd.randint(1, 12))]
            plain = list(word)
            for u, v, w in merges:
                at = 0
                while at < len(plain) - 1:
                    if plain[at : at + 2] == [u, v]:
                        plain[at : at + 2] = [w]
                    at += 1
            text = b"".join(labels[t] for t in word)
            assert own.encode([text, b""])[0] == own.encode_long(text) == struct.pack(f"<{len(plain)}I", *plain)
    with pytest.raises(ValueError):
        bpe.TokenAutomaton([b"a", b"aa", b"aa"], [(0, 0, 1), (0, 0, 1)])


def _plain_runs(w, shortest):
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s >= q and i - s + q >= shortest:
                best.setdefault((s, i + q), q)
            i += i == s
    return sorted((s, e - s, q) for (s, e), q in best.items())


def test_runs_equal_brute_force():
    rnd = random.Random(4)
    for k in range(1500):
        letters = [b"%d" % i for i in range(rnd.randint(1, 7))]
        words = [rnd.choice(letters) for _ in range(rnd.randint(0, 80))]
        if k % 3 == 1:
            words = [w for _ in range(rnd.randint(1, 5)) for w in [rnd.choice(letters) for _ in range(rnd.randint(1, 9))] * rnd.randint(1, 4)]
        elif k % 3 == 2:  # Fibonacci words have the most runs
            words, b = [b"a"], [b"b"]
            for _ in range(rnd.randint(1, 8)):
                words, b = words + b, words
        for shortest in (2, 5, 12):
            found = periodic_runs.runs(words, shortest)
            assert found == _plain_runs(words, shortest)
            lost = {i for s, n, q in found for i in range(s + q, s + n)}
            assert periodic_runs.collapsed(words, found) == [w for i, w in enumerate(words) if i not in lost]


def test_long_loops_are_found_at_once():
    assert periodic_runs.runs([b"a"] * 200_000) == [(0, 200_000, 1)]
    assert periodic_runs.runs([b"a", b"b", b"c"] * 30_000) == [(0, 90_000, 3)]


def test_runs_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b " * 6), (4, "a b " * 6), (None, "x\x0by\tx y x y x y x y x y"), (5, "a b " * 12), (6, "w " * 11)]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("runs", F.lit("x")).withColumn("Kept_Text", F.lit(1))
    got = collections.Counter((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["kept_text"]) for r in periodic_runs.periodic_runs(df.repartition(3)).collect())
    assert got == collections.Counter([(1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), *[(4, 12, ((0, 12, 2),), "a b")] * 2, (None, 12, ((0, 12, 2),), "x y"), (5, 12, ((0, 12, 1),), "a b"), (6, 11, (), " ".join("w" * 11))])
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(df, shortest=1)


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, c in enumerate(a) if c != b[i]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def test_sorted_lists_give_all_pairs_of_one_edit():
    rnd = random.Random(3)
    for _ in range(1500):
        size = rnd.randint(0, 7)
        words = sorted({"".join(rnd.choices("abcdé"[: rnd.randint(1, 5)], k=size + rnd.randint(0, 1))) for _ in range(rnd.randint(1, 40))})
        got = sorted(tuple(sorted(p)) for p in spelling.near_pairs(words, size))
        assert got == [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if size in (len(words[i]), len(words[j])) and _one_edit(words[i], words[j])] and len(got) == len(set(got))


@pytest.mark.parametrize("most", [2, 7, 128])
def test_variant_groups_equal_brute_force(spark, most):
    rnd = random.Random(most)
    counts = {}
    for _ in range(60):
        base = "".join(rnd.choices("abcdeéÿ", k=rnd.randint(6, 13)))
        for _ in range(rnd.randint(1, 8)):
            counts[base] = rnd.choice([5, 6, 25, 30, 150, 800])
            k = rnd.randrange(len(base) + 1)
            base = base[:k] + rnd.choice(["", "a", "é"]) + base[k + rnd.randint(0, 1) :]
            base = base if len(base) > 5 else base + "xyzxyz"
    counts |= {"sameprefix" + c + d: 5 + i for i, (c, d) in enumerate((c, d) for c in "abcdefgh" for d in "klmn")}  # one large group
    near = {w: [x for x in counts if _one_edit(w, x)] for w in counts}
    form = {w: next((x for x in sorted(near[w], key=lambda x: (-counts[x], x)) if counts[x] >= 5 * counts[w]), None) if near[w] and max(counts[x] for x in near[w]) >= 5 * counts[w] else None for w in counts}

    def root(w):
        return root(form[w]) if form[w] else w

    out = spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("key", F.lit(1)).repartition(4), most=most).collect()
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in out} == {w: (n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}
    assert len(out) == len(counts) and any(form[form[w]] for w in counts if form[w])


def test_word_counts_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "Straße STRAßE straße naïveté×x 日本語 ÀÉÎ"), (3, "Straße"), (None, "nobody's words"), (4, "long" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("word", F.lit("x"))
    got = {r["word"]: r["n"] for r in spelling.word_counts(df.repartition(3), shortest=6).collect()}
    assert got == {"straße": 4, "naïveté×x": 1, "nobody": 1, "long" * 20_000: 1}
    spelt = spelling.word_counts(df, lambda i, w: w[:6] if i == 3 else b"none", shortest=6).collect()
    assert {r["word"]: r["n"] for r in spelt} == {"straße": 4, "naïvet": 1}
    assert spelling.variant_groups(spelling.word_counts(df.limit(0), shortest=6)).count() == 0
    assert spelling.variant_groups(spelling.word_counts(df, shortest=6)).count() == 4
    h = zlib.crc32("7:naïveté".encode())
    assert queries.misspelt(7, "naïveté".encode("latin-1")) == "naïveté".encode("latin-1") or h % 199 == 0


TEXTS = [(1, "The quick brown fox jumps over the lazy dog. It is here. " * 3), (2, "The quick brown fox jumps over the lazy dog. It is here. " * 3), (3, None), (4, ""), (5, "under the mit license " + "word " * 14)]
CLASH = ["text2", "Spans", "tail", "Tail2", "_id", "_at", "row", "at", "node", "key", "value", "ids", "n", "k", "word", "words", "labels", "digest", "size", "copies", "map", "item", "n_doc", "runs", "entry", "kept", "start", "offset", "Component_Id"]
OPERATORS = {
    "near_dup": lambda spark, df: near_dup.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept"),
    "packing": lambda spark, df: packing.pack(df, path=public_tokenizers.path("word_bpe_49k.json"), with_ids=False).select("doc_id", "start", "length", "ids_crc32"),
    "quality": lambda spark, df: quality.score(df, quality.train(df, spark.createDataFrame([(1, 1), (5, 0)], "doc_id long, grade int"), levels=2), at_least=1).select(F.col("doc_id").cast("long"), "tail", "accepted"),
    "licenses": lambda spark, df: licenses.license_scan(df).select("doc_id", "n_words", "labels"),
    "substring_dedup": lambda spark, df: substring_dedup.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans"),
    "unit_dedup": lambda spark, df: unit_dedup.remove_repeated_units(df).select(F.col("doc_id").cast("long"), "kept_text", "n_units", F.size("spans").alias("spans")),
    "decontamination": lambda spark, df: decontamination.leaks(df, spark.createDataFrame([(7, "quick brown fox jumps over the lazy dog")], "item_id long, text string")),
    "token_counts": lambda spark, df: token_counts.token_counts(df, path=public_tokenizers.path("piece_bpe_32k.model")),
    "bpe": lambda spark, df: bpe.encode(df, path=BYTES),
    "periodic_runs": lambda spark, df: periodic_runs.periodic_runs(df).select("doc_id", "n_words", "kept_text", F.size("runs").alias("runs")),
    "spelling": lambda spark, df: spelling.variant_groups(spelling.word_counts(df, shortest=3)),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_names_and_id_types_change_nothing(spark, name):
    plain = spark.createDataFrame(TEXTS, "doc_id long, text string")
    norm = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    want = norm(OPERATORS[name](spark, plain))
    wide = plain.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    assert norm(OPERATORS[name](spark, wide)) == want
    assert norm(OPERATORS[name](spark, plain.withColumn("doc_id", F.col("doc_id").cast("int")))) == want


def test_clashing_names_of_archives_and_vectors(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x</p>"), (2, None, None)], "page_id int, url string, html string").select("*", *[F.lit("x").alias(c) for c in CLASH])
    held = fixity.archive(pages)
    found = fixity.audit(held.select("record_id", "file", "offset", "length"), held.select("record_id", "content"), held.where("record_id = 1").select("record_id", "content"))
    assert [(r["record_id"], r["status"]) for r in found.select("record_id", "status").collect()] == [(2, "missing_second")]
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id int, embedding array<double>").select("*", *[F.lit("x").alias(c) for c in CLASH])
    assert sorted(tuple(r) for r in topk.top_k(vectors, F.col("vec_id") == 0, k=2).select("query_id", "rank", "vec_id", "score").collect()) == [(0, 1, 1, 256 * 128), (0, 2, 2, 0)]


def test_unit_dedup_keeps_the_columns_of_its_input(spark):
    df = spark.createDataFrame([("1", "One line of five words.\n", 1, "a", "b")], "id string, body string, text int, _id string, Spans string")
    out = unit_dedup.remove_repeated_units(df, id_col="id", text_col="body")
    assert out.columns == ["id", "body", "text", "_id", "kept_text", "n_units", "spans"] and tuple(out.first())[:5] == ("1", "One line of five words.\n", 1, "a", "One line of five words.\n")


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_checkpoints_go_with_their_last_reader(spark, name):
    folder = common.shared_folder(spark).removeprefix("file:")
    left = lambda: sum(d.startswith("rdd-") for _, names, _ in os.walk(folder) for d in names)
    before = left()
    queries.queries()[name](spark, SF).count()
    for _ in range(20):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)
        if left() <= before:
            break
    assert left() <= before


def test_pipeline_leaves_only_what_its_result_reads(spark):
    import corpus_pipeline

    folder = common.shared_folder(spark).removeprefix("file:")
    stages = lambda: sorted(n for d, names, _ in os.walk(folder) if os.path.basename(d).startswith("pipeline-") for n in names)
    before = stages()
    out = corpus_pipeline.run(spark, SF)
    assert sorted([*before, corpus_pipeline.STAGES[-2][0]]) == stages()
    assert out.count() > 0


def _loss(weights, thresholds, x, y):
    """Mean negative log-likelihood of grades under a cumulative-link model, written out level by level."""
    score, edges = x @ weights, [-np.inf, *thresholds, np.inf]
    below = [1 / (1 + np.exp(-(e - score))) if np.isfinite(e) else np.full(len(y), float(e > 0)) for e in edges]
    return -np.mean([np.log(max(below[g + 1][i] - below[g][i], 1e-12)) for i, g in enumerate(y)])


def test_fit_comes_close_to_an_independent_optimum():
    rnd = np.random.default_rng(1)
    x, true = rnd.random((500, 4)) * (rnd.random((500, 4)) < 0.7), np.array([3.0, -2.0, 1.0, 0.0])
    y = np.searchsorted([-0.5, 1.0], x @ true + rnd.logistic(size=500))
    rows = [(np.flatnonzero(v).astype(np.int64), v[v > 0]) for v in x]
    model = quality.fit(rows, y, 3, epochs=200, l1=0.0)
    # coordinate steps that shrink whenever none of them helps, from the model without features
    best, step = np.array([0.0, 0.0, 0.0, 0.0, -0.5, 0.5]), 0.5
    value = _loss(best[:4], best[4:], x, y)
    while step > 1e-3:
        tries = [best + d * step * np.eye(6)[k] for k in range(6) for d in (-1, 1)]
        losses = [_loss(t[:4], t[4:], x, y) if t[4] < t[5] else np.inf for t in tries]
        if min(losses) < value - 1e-9:
            value, best = min(losses), tries[int(np.argmin(losses))]
        else:
            step /= 2
    got = _loss(model.weights[:4], model.thresholds, x, y)
    assert value - 1e-6 <= got <= value * 1.01
    assert np.abs(model.weights[:4] - best[:4]).max() < 0.4 and model.thresholds[0] < model.thresholds[1]


def test_a_reused_worker_gives_its_memory_back():
    """Spark keeps Python workers from stage to stage: what a task or an operator before has freed must not stay with them."""
    code = """
import re
from tideline.llm import common

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

def fill():
    own = [bytes(20000) for _ in range(5000)]
    return dict(enumerate(own)), own[::50]  # a few that stay, so that malloc itself gives nothing back

table, few = fill()
common.keep_only(table)
before = held()
common.keep_only(None)
assert not table and held() < before - 50, (before, held())

def run(batches):
    kept = fill()
    few.extend(kept[1])
    tops.append(held())
    del kept
    yield from batches

tops = []
assert list(common.gives_back(run)(iter([1, 2]))) == [1, 2]
assert held() < tops[0] - 50, (tops, held())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True, timeout=60)
    assert done.returncode == 0, done.stderr
