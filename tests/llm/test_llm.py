"""The training-data operators against brute force, SQL and edge cases."""

import collections
import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import same

from tideline.llm import decontamination, fixity, licenses, near_dup, packing, quality, queries, substring_dedup, token_counts, topk, unit_dedup

SF = "/root/testdata/sf0.001"
WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "one", "a b c d", "a b c d e f", "a b c d e f", "x" * 70_000, "Ünï çödé　日本 \x00 <|endoftext|> </s>", "A, b!\nA, b!\n" * 40]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, with columns whose names clash with those inside the operators."""
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, value int, digit int")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    same(spark, SF, queries.queries()[name], queries.oracle_sql()[name])


def _texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_token_counts_equal_the_library(spark, odd):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        texts = {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}
        for chunk in (1 << 16, 97):
            out = token_counts.token_counts(df, path=PIECES, chunk_chars=chunk).collect()
            assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in out} == {k: (len(t.encode()), len(model.encode(t))) for k, t in texts.items()}


def test_chunk_maps_compose_in_any_cut():
    import sentencepiece

    model, words, rnd = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.load(PIECES), random.Random(5)
    lead, lacking = token_counts.LEAD, 0
    for i in range(400):
        # with white space, without any, of few characters and of one
        text = "".join(rnd.choices(("abeth on\n▁  ,.éß日'<", "theringatonds", "的一是不了人我在有他这中大来上国", "aab", "-")[i % 5], k=rnd.randint(1, 500)))
        marked, cut = token_counts.MARK + text.replace(" ", token_counts.MARK), rnd.randint(60, 120)
        maps = [token_counts.chunk_map(words, marked[max(0, k - lead) : k], marked[k : k + cut]) for k in range(0, len(marked), cut)]
        found = token_counts.scan(maps)
        assert found in (None, len(model.encode(text)))
        lacking += found is None
    assert lacking == 0


def test_token_counts_of_long_texts_without_white_space(spark, monkeypatch):
    import sentencepiece

    model, rnd = sentencepiece.SentencePieceProcessor(model_file=PIECES), random.Random(6)
    texts = ["".join(rnd.choices("的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就", k=30_000)), "a" * 20_001, "ab" * 9000, "x" * 5000 + " " + "日" * 5000]
    rows = [(1, texts[0]), (1, texts[0]), (1, texts[1]), (None, texts[2]), (2, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k", F.lit(1)).withColumn("at", F.lit("x"))
    want = collections.Counter((i, len(t.encode()), n := len(model.encode(t)), n > 4096) for i, t in rows)
    assert collections.Counter(map(tuple, token_counts.token_counts(df, path=PIECES, chunk_chars=1000).collect())) == want
    # maps without any entry leave all to the walk of whole texts
    monkeypatch.setattr(token_counts, "LEAD", 1)
    assert collections.Counter(map(tuple, token_counts.token_counts(df, path=PIECES, chunk_chars=1000).collect())) == want
    assert token_counts.token_counts(df.limit(0), path=PIECES).count() == 0


def _check_packing(rows, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    ids = {k: [*t.encode(x or "", add_special_tokens=False).ids, 2] for k, x in texts.items()}
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for k, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            own = np.array(ids[k][at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[k]), zlib.crc32(own.tobytes()))
            at += r["length"]
        assert at == len(ids[k])
    sizes = []
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        sizes.append(at)
    assert all(n <= 4096 and n & (n - 1) == 0 for n in sizes)


def test_packing_is_exact_and_leaves_no_padding(spark, odd):
    _check_packing(queries.op2_packing(spark, SF).collect(), _texts(spark))
    _check_packing(packing.pack(odd, path=WORDS, group_tokens=5000).collect(), dict(enumerate(ODD)))


def test_first_fit_decreasing_equals_a_plain_scan():
    rnd = random.Random(2)
    lengths = [rnd.randint(1, 100) for _ in range(400)]
    bins, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        k = next((k for k, r in enumerate(room) if r >= lengths[i]), None)
        if k is None:
            bins.append([])
            room.append(128)
            k = len(bins) - 1
        bins[k].append(i)
        room[k] -= lengths[i]
    assert packing.first_fit_decreasing(lengths, 128) == bins


def _licenses(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_license_scan_base_and_suppression(spark, odd):
    texts = _texts(spark) | {9000: "Licensed under CC BY-NC 4.0. cc by nc; CC BY NC, under the MIT license under the MIT LICENSE"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for frame in (df, odd):
        for r in licenses.license_scan(frame).join(frame.select("doc_id", "text"), "doc_id").collect():
            assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == _licenses(r["text"])
            assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    names = [x.split(":", 1)[1] for x in licenses.Scanner().scan("licensed under the Apache License, Version 2.0")[7]]
    assert names == ["apache-2:grant"]
    assert len(licenses.rules()) > 300


def _plain_license_scan(text):
    """Every rule over the whole text without a gate, and suppression by comparing each detection with all before it."""
    words = "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")).split(" ")
    words = [w for w in words if w]
    joined = (" " + " ".join(words) + " ").encode()
    found = [(joined[: m.start()].count(b" "), joined[: m.end()].count(b" "), r) for r in licenses.rules() for m in r.regex.finditer(joined)]
    kept = []
    for a, b, r in sorted(found, key=lambda x: (x[2].priority, x[0] - x[1], x[0], x[2].name)):
        if not any(c <= a and b <= d for c, d, _ in kept):
            kept.append((a, b, r))
    _, n, _, _, base = _licenses(text)
    labels = {r.label for *_, r in kept} | set(filter(None, base.split(",")))
    return ",".join(sorted(labels)), max([r.confidence for *_, r in kept] + [0.9] * bool(n), default=0.0), sorted(f"{a}-{b}:{r.name}" for a, b, r in kept)


def test_license_labels_score_and_suppression_equal_a_plain_scan(spark, odd):
    rnd = random.Random(21)
    rules = licenses.rules()
    mixed = [" / ".join(_sample(re._parser.parse(rnd.choice(rules).regex.pattern), rnd).decode() + rnd.choice(("", " license", " or later, see the file")) for _ in range(rnd.randint(1, 12))) for _ in range(150)]
    texts = _texts(spark) | dict(enumerate(mixed, 10_000)) | {20_000: None, 20_001: "Licensed under the MIT license. " * 3000}
    rows = list(texts.items()) + [(10_000, mixed[0])]
    out = licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit(1))).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] != 20_001:
            assert (r["labels"], r["score"], sorted(r["detections"])) == _plain_license_scan(texts[r["doc_id"]])
        else:
            assert (r["n_base"], r["labels"], len(r["detections"])) == (3000, "mit", 3000)
    assert sum(bool(r["labels"]) for r in out) > 150
    assert licenses.license_scan(odd.limit(0)).count() == 0


def _sample(tree, rnd):
    """A random text that a parsed regex matches."""
    out = b""
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            out += bytes([arg])
        elif op == "IN":
            kind, x = rnd.choice(arg)
            out += bytes([x]) if str(kind) == "LITERAL" else b"%d" % rnd.randrange(10)
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = arg
            out += b"".join(_sample(inner, rnd) for _ in range(rnd.randint(low, min(int(high), low + 2))))
        elif op == "SUBPATTERN":
            out += _sample(arg[-1], rnd)
        elif op == "BRANCH":
            out += _sample(rnd.choice(arg[1]), rnd)
        else:
            assert op == "ASSERT", op
    return out


def test_license_prefilter_changes_no_result():
    rnd = random.Random(8)
    for r in licenses.rules():
        tree = re._parser.parse(r.regex.pattern)
        for _ in range(60):
            text = _sample(tree, rnd) + b" "
            assert r.regex.match(text), (r.name, text)
            assert r.keyword in text and (not r.also or any(x in text for x in r.also)), (r.name, text)
    n, *_, score, found = licenses.Scanner().scan("This work is governed by the GPL v3 license.")
    assert (n, score, [x.split(":", 1)[1] for x in found]) == (9, 0.9, ["gpl-3:under"])


def _components(texts, percent=75):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = {}
    for k, x in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (x or "").encode().translate(low))
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {k: k for k in sets}
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    return {k: (len(sets[k]), root[k], root[k] == k) for k in keys}


def _family(rnd, base, n):
    """Copies of a text with a few words changed, so that some link only through others."""
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rnd.randint(1, 4)):
            w[rnd.randrange(len(w))] = f"w{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_equal_brute_force(spark, odd):
    rnd = random.Random(11)
    texts = dict(enumerate(ODD))
    base = " ".join(f"b{rnd.randrange(10**6)}" for _ in range(110))
    shared = " ".join(f"s{rnd.randrange(10**6)}" for _ in range(60))
    more = _family(rnd, base, 60) + [f"{shared} " + " ".join(f"u{rnd.randrange(10**6)}" for _ in range(40)) for _ in range(40)]
    texts |= {100 + i: t for i, t in enumerate(more + more[:20])}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("node", F.lit("x"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(df.repartition(5)).collect()}
    assert got == _components(texts)


def test_near_duplicates_of_repeated_rows_and_rows_without_ids(spark):
    rnd = random.Random(12)
    one, two = (" ".join(f"{c}{rnd.randrange(10**6)}" for _ in range(40)) for c in "xy")
    rows = [(1, one), (1, one), (None, one), (5, two), (5, one + " tail"), (None, "alone in the world of texts"), (None, "alone in the world of texts"), (None, None), (7, ""), (7, "")]
    for n in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(n).withColumn("at", F.lit("x")).withColumn("ids", F.lit(1))
        got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(df).collect())
        want = [(1, 36, 1, True), (1, 36, 1, True), (None, 36, 1, False), (5, 36, 5, True), (5, 37, 1, False), (None, 2, None, True), (None, 2, None, True), (None, 0, None, True), (7, 0, 7, True), (7, 0, 7, True)]
        assert got == collections.Counter(want)
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_sketch_limit_rejects_no_link():
    """Sets at the smallest similarity allowed stay below the limit of differing bits at every size."""
    rnd = np.random.default_rng(5)
    for n in (70, 150, 300, 1200):
        full = near_dup.BINS * (1 - np.exp(-n / near_dup.BINS))
        lent = (near_dup.BINS - full) / full
        independent = near_dup.BINS**2 / (full * (1 + 3 * lent + lent**2))
        most = near_dup.BINS * 0.125 + 6 * near_dup.BINS * (0.875 * 0.125 / independent) ** 0.5
        for _ in range(300):
            shared = int(np.ceil(n * 0.75 * 2 / 1.75))
            x = rnd.integers(0, 1 << 63, 2 * n - shared, dtype=np.uint64) * np.uint64(2)
            a, b = near_dup.sketches(near_dup.signatures([np.sort(x[:n]), np.sort(x[n - shared :])]))
            assert np.bitwise_count(a ^ b).sum() <= most


def test_forest_finds_the_links_between_blocks():
    import pyarrow as pa

    sets = [[1, 2, 3, 4], [1, 2, 3, 5], [9, 10], [1, 2, 3, 4, 5]]
    block = pa.array([{"node": i, "root": i, "shingles": s} for i, s in enumerate(sets)], pa.struct([("node", pa.int64()), ("root", pa.int64()), ("shingles", pa.list_(pa.int64()))]))
    assert sorted(tuple(sorted(e)) for e in near_dup._forest(block, block, 75)) == [(0, 3), (1, 3)]


def test_suffix_dedup_handles_odd_and_overlapping_texts(spark, odd):
    rnd = random.Random(3)
    parts = ["".join(rnd.choices("abcdé \n", k=rnd.randint(30, 90))) for _ in range(12)]
    texts = dict(enumerate(ODD)) | {50 + i: "".join(rnd.choices(parts, k=rnd.randint(1, 8))) for i in range(60)}
    data = {k: (t or "").encode() for k, t in texts.items()}
    seen, want = set(), {}
    for k in sorted(data):
        lost = set()
        for i in range(len(data[k]) - 49):
            if data[k][i : i + 50] in seen:
                lost.update(range(i, i + 50))
        seen.update(data[k][i : i + 50] for i in range(len(data[k]) - 49))
        spans = sum(1 for i in lost if i - 1 not in lost)
        want[k] = (len(data[k]), len(lost), spans, hashlib.sha256(bytes(c for i, c in enumerate(data[k]) if i not in lost)).hexdigest())
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("runs", F.lit(1))
    for n in (1, 6):
        out = substring_dedup.remove_repeats(df.repartition(n)).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out} == want


def test_suffix_dedup_of_repeated_and_missing_ids(spark):
    rnd = random.Random(5)
    one, two = ("".join(rnd.choices("abcdef ", k=80)) for _ in range(2))
    rows = [(1, one), (1, one), (1, two), (None, two + one), (3, two + "x" + one), (3, "short"), (4, two)]
    want = collections.Counter([(1, 80, 0, 0), (1, 80, 0, 0), (1, 80, 0, 0), (None, 160, 0, 0), (3, 161, 160, 2), (3, 5, 0, 0), (4, 80, 80, 1)])
    for n in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(n).withColumn("copy", F.lit("x"))
        assert collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in substring_dedup.remove_repeats(df).collect()) == want
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0
    for width in (substring_dedup.GRAM, 52):
        with pytest.raises(ValueError):
            substring_dedup.remove_repeats(df, width=width)


def test_unit_dedup_of_repeated_rows_does_not_depend_on_partitions(spark):
    one, two = "One line of five words.\nShort.\n", "Another line of many words here.\nOne line of five words.\n"
    rows = [(1, one), (1, one), (1, two), (2, two), (2, two), (None, one)]
    first, second = sorted([one, two], key=lambda t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0])
    cut = {one: {"One line of five words.\n"}, two: {"One line of five words.\n"}}
    left = {first: first, second: "".join(x for x in second.splitlines(True) if x not in cut[second])}
    want = collections.Counter([(1, left[one]), (1, left[one]), (1, left[two]), (2, ""), (2, ""), (None, one)])
    for n in (1, 3, 6):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(n).withColumn("at", F.lit(0)).withColumn("_at", F.lit(0))
        assert collections.Counter((r["doc_id"], r["kept_text"]) for r in unit_dedup.remove_repeated_units(df).collect()) == want


def test_unit_dedup_keeps_the_first_and_all_columns(spark, odd):
    rows = [(3, "One two three four five six. Rest of it"), (1, "x\nOne, TWO three four five six.\n"), (2, None), (4, "")]
    out = {r["doc_id"]: r for r in unit_dedup.remove_repeated_units(spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(0))).collect()}
    assert (out[3]["kept_text"], [tuple(s) for s in out[3]["spans"]]) == ("Rest of it", [(0, 29)])
    assert (out[1]["kept_text"], out[2]["kept_text"], out[4]["kept_text"]) == (rows[1][1], None, "")
    assert unit_dedup.remove_repeated_units(odd).count() == len(ODD)


def test_unit_dedup_removes_repeated_lines_whole(spark):
    line = "The first sentence has many words. Short end."
    rows = [(1, f"Own.\n{line}\n\n"), (2, f"{line.upper()}\n\nOther short end. Stays here."), (3, f"x {line}\n--\n--\nOwn!"), (4, f"{line}\n{line}"), (5, "Short end. Another line with it.\nOWN")]
    out = {r["doc_id"]: (r["kept_text"], r["n_units"], [tuple(s) for s in r["spans"]]) for r in unit_dedup.remove_repeated_units(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert out[1] == (rows[0][1], 4, [])
    assert out[2] == ("\nOther short end. Stays here.", 5, [(0, 35), (35, 46)])
    assert out[3] == (f"x {line}\n--\n--\n", 5, [(54, 58)])
    assert out[4] == ("", 4, [(0, 35), (35, 46), (46, 81), (81, 91)])
    assert out[5] == ("Short end. Another line with it.\n", 3, [(33, 36)])


def test_pipeline_leaves_no_part_of_a_repeated_line(spark):
    import corpus_pipeline

    line = "The first sentence has many words. Short end."
    docs = spark.createDataFrame([(i, f"own{i}\n{line}\n" if i != 2 else line, "en", "s", 0) for i in (1, 2, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.unit_stage(spark, docs, SF).collect()} == {1: (f"own1\n{line}\n", 0), 3: ("own3\n", 5)}


def test_decontamination_on_both_paths(spark, odd):
    item = "the quick brown fox jumps over the lazy dog again and again today"
    other = " ".join(f"w{i}" for i in range(40))
    docs = [(1, "noise " * 3000 + item.upper() + " tail"), (2, "noise " * 50), (3, None), (4, item[:30]), (5, other), (5, item), (5, item), (None, "x " + item), (6, item[: len(item) // 2])]
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumn("value", F.lit(1)).withColumn("row", F.lit("x"))
    items = spark.createDataFrame([(7, item), (7, other), (7, other), (8, "too short"), (9, None)], "item_id long, text string").withColumn("item", F.lit(1))
    for most in (1_000_000, 0):
        found = decontamination.leaks(docs, items, most_broadcast=most).collect()
        assert collections.Counter(map(tuple, found)) == collections.Counter([(1, 7, 9, 9), (5, 7, 36, 36), (None, 7, 9, 9)])
        assert decontamination.leaks(docs, items.limit(0), most_broadcast=most).count() == 0
        assert decontamination.leaks(docs.limit(0), items, most_broadcast=most).count() == 0
    assert decontamination.leaks(odd, items).count() == 0


def test_decontamination_at_every_size_and_share(spark):
    """Items of many sizes that stand in part in long documents: both paths give what a plain count gives."""
    rnd = random.Random(9)
    items = {i: [f"i{i}w{k}" for k in range(n)] for i, n in enumerate((5, 6, 8, 11, 12, 19, 35, 36, 67, 130))}
    docs = {}
    for i, words in items.items():
        for part in (0.6, 0.7, 0.75, 0.8, 0.9, 1.0):
            own = words[: max(1, round(part * len(words)))]
            docs[len(docs)] = " ".join([f"n{rnd.randrange(10**6)}" for _ in range(300)] + own + [f"n{rnd.randrange(10**6)}" for _ in range(50)])
    sets = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    want = {(d, i) for d, t in docs.items() for i, w in items.items() if sets(w) and 100 * len(sets(w) & sets(t.split())) >= 75 * len(sets(w))}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    tests = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    for most in (1_000_000, 0):
        assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(frame, tests, most_broadcast=most).collect()} == want and len(want) > 20


def test_top_k_with_ties_and_bad_vectors(spark):
    rnd = random.Random(4)
    rows = [(i, [float(rnd.randint(-3, 3)) / 4 for _ in range(8)]) for i in range(400)] + [(400, None), (450, [1.0, None] + [0.0] * 6), (500, [float("nan")] * 8), (550, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rows", F.lit(1))
    v = {i: np.floor(256 * np.array(x)).astype(int) for i, x in rows[:400]}
    want = []
    for q in (i for i in v if i % 50 == 0):
        best = sorted((-int(v[q] @ v[i]), i) for i in v if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, block_rows=64, query_rows=3).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_prunes_and_stays_exact():
    rnd = np.random.default_rng(3)
    n, d = 6000, 32
    v = np.floor(256 * rnd.normal(size=(n, d)) * rnd.lognormal(0, 0.6, size=(n, 1)) * np.exp(-np.arange(d) / 6))
    ids, q = np.arange(n), np.arange(n) % 50 == 0
    turn = np.linalg.eigh(v.T @ v)[1][:, ::-1]
    order = np.argsort(-np.sqrt((v * v).sum(1)), kind="stable")
    owner, _, scores, scored = topk.find(ids[q], v[q], np.full(q.sum(), -np.inf), ids[order], v[order], turn, 5)
    every = v[q] @ v.T
    every[np.arange(q.sum()), ids[q]] = -np.inf
    assert [sorted(scores[owner == i]) for i in range(q.sum())] == [sorted(np.sort(x)[-5:]) for x in every]
    assert scored < 0.05 * q.sum() * n
    # with the thresholds of a round before, later blocks of short vectors are not scored at all
    least = np.array([scores[owner == i].min() for i in range(q.sum())])
    assert topk.find(ids[q], v[q], least, ids[order[3000:]], v[order[3000:]], turn, 5)[3] < 0.001 * q.sum() * n


def test_top_k_in_rounds_of_blocks(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rnd.normal(size=8) * np.exp(rnd.normal())]) for i in range(900)] + [(50, [0.0] * 8), (100, None)]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit(1)).withColumn("length", F.lit("x")).withColumn("score", F.lit(0))
    v = [(i, np.floor(256 * np.array(x))) for i, x in rows if x]
    asked = collections.defaultdict(set)
    for i, x in v:
        if i % 50 == 0:
            asked[i].add(tuple(x))
    want = []
    for q, vectors in asked.items():
        best = sorted((-int(np.array(x) @ y), i) for x in vectors for i, y in v if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    for most in (40, 10_000):
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, block_rows=most, query_rows=7, growth=3).collect()
        assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)


def test_fixity_finds_every_kind_of_damage(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", None if i == 3 else "x" * i) for i in range(300)], "page_id long, url string, html string")
    held = fixity.archive(pages, records_per_file=64)
    index, first = held.select("record_id", "file", "offset", "length"), held.select("record_id", "content")
    second = first.where("record_id <> 9").select(F.when(F.col("record_id") == 17, 999).otherwise(F.col("record_id")).alias("record_id"), F.when(F.col("record_id") == 5, F.encode(F.lit("bad"), "utf-8")).otherwise(F.col("content")).alias("content"))
    assert sorted((r["record_id"], r["status"]) for r in fixity.audit(index, first, second).collect()) == [(5, "changed"), (9, "missing_second"), (17, "missing_second"), (999, "extra_second")]
    assert fixity.audit(index, first, first).count() == 0


def test_fixity_of_repeated_records_and_empty_tables(spark):
    pages = spark.createDataFrame([(i % 40, "u", f"body {i}") for i in range(60)] + [(None, "u", "x")], "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("offset", F.lit("x"))
    held = fixity.archive(pages, records_per_file=16)
    index, first = held.select("record_id", "file", "offset", "length"), held.select("record_id", "content").withColumn("digest", F.lit(0)).withColumn("other", F.lit(0))
    assert held.count() == 60 and fixity.audit(index, first, first.repartition(5)).count() == 0
    second = first.where(~F.decode("content", "utf-8").contains("body 45"))  # one of two records of id 5
    assert [(r["record_id"], r["status"]) for r in fixity.audit(index, first, second).collect()] == [(5, "changed")] * 2
    assert {r["status"] for r in fixity.audit(index, first, second.limit(0)).collect()} == {"missing_second"}
    assert {r["status"] for r in fixity.audit(index.limit(0), first, second).collect()} == {"extra_first", "extra_second"}
    assert fixity.archive(pages.limit(0)).count() == 0


def test_quality_on_held_out_labels(spark, odd):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), quality.graded(spark.read.parquet(f"{sf}/labels.parquet"))
    model = quality.train(docs, labels.where("doc_id % 4 <> 0"), levels=3, sample_rows=3000)
    assert (np.diff(model.thresholds) > 0).all()
    held = quality.score(docs.join(labels.where("doc_id % 4 = 0"), "doc_id"), model, at_least=2).collect()
    right = sum(r["accepted"] == (r["grade"] == 2) for r in held) / len(held)
    assert right > 0.95
    assert quality.score(odd, model, at_least=2).count() == len(ODD)
    empty = quality.train(docs.limit(0), labels.limit(0), levels=3)
    assert all(r["accepted"] for r in quality.score(odd, empty, at_least=2).collect())


def test_quality_scores_equal_a_plain_sum(spark, odd):
    """Each row's expected grade and tail, recomputed token by token with the model's weights."""
    import xxhash

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), quality.graded(spark.read.parquet(f"{SF}/labels.parquet"))
    model = quality.train(docs, labels, levels=3, sample_rows=200)
    assert np.count_nonzero(model.weights) and list(model.thresholds) == sorted(model.thresholds)
    at = lambda x: xxhash.xxh64_intdigest(x) >> (64 - quality.BITS)

    def shape(token):
        kind = lambda c: "0" if c.isdecimal() else c if not c.isalnum() or c == "_" else "a" if re.fullmatch("[a-zß-öø-ÿ]", c) else "A"
        kinds = [kind(c) for c in token]
        return "".join(c for i, c in enumerate(kinds) if c not in "Aa0" or i == 0 or kinds[i - 1] != c)[:8]

    def plain(text):
        tokens = (text or "").split()
        if not tokens:
            return 0.0
        words = {at("w " + w) for t in tokens for w in re.findall(r"\w+", t.lower())}
        score = sum(model.weights[w] for w in words) * max(1.0, len(words) / 100) ** -0.5
        score += sum(4.0 / len(tokens) * model.weights[at("s " + shape(t))] for t in tokens)
        score += 8.0 * model.weights[at("share repeats")] * sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / len(tokens)
        return score + 8.0 * model.weights[at("share marks")] * sum(bool(re.search(r"[^\w.,;:'\"()!?-]", t)) for t in tokens) / len(tokens)

    for frame in (docs, docs.union(docs.limit(3)), odd.withColumn("tail", F.lit("x")).withColumn("accepted", F.lit(1))):
        out = quality.score(frame, model, at_least=2).collect()
        assert len(out) == frame.count()
        for r in out:
            tails = [1 / (1 + np.exp(t - plain(r["text"]))) for t in model.thresholds]
            assert abs(r["tail"] - tails[1]) < 1e-6 and abs(r["expected_grade"] - sum(tails)) < 1e-6 and r["accepted"] == (r["tail"] >= 0.5)
    assert quality.score(docs.limit(0), model, at_least=2).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert corpus_pipeline.run(spark, SF).count() > 0


def _units_kept(texts):
    """Texts without repeated lines and repeated sentences of five words or more, by a plain scan."""
    words = lambda x: tuple(re.findall(r"\w+", x.lower()))
    lines_seen, units_seen, out = set(), set(), {}
    for k in sorted(texts):
        kept = ""
        for line in re.findall(r"[^\n]*\n|[^\n]+", texts[k] or ""):
            again = bool(words(line)) and words(line) in lines_seen
            lines_seen.add(words(line))
            for unit in re.split(r"(?<=[.!?] )", line):
                own = words(unit)
                if not again and not (len(own) >= 5 and own in units_seen):
                    kept += unit
                units_seen.add(own)
        out[k] = texts[k] if texts[k] is None else kept
    return out


def _leaking(texts, items):
    def sets(x):
        w = [v for v in re.split(r"[\x20\x09-\x0D]+", (x or "").lower()) if v]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    tests = [s for s in map(sets, items) if s]
    return {k for k, x in texts.items() for own in [sets(x)] if any(100 * len(own & t) >= 75 * len(t) for t in tests)}


def test_pipeline_stages_equal_brute_force(spark):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    run = lambda name, df: {r["doc_id"]: r["text"] for r in stages[name](spark, df, SF).select("doc_id", "text").collect()}
    texts = _texts(spark)
    alone = run("near_dup", docs)
    assert alone == {k: texts[k] for k, (_, _, kept) in _components(texts).items() if kept} and len(alone) < len(texts)
    whole = _units_kept(texts)
    units = run("unit_dedup", docs)
    assert units == {k: x for k, x in whole.items() if x == texts[k] or x.strip(" ")} and units != texts
    leaking = _leaking(texts, items)
    clean = run("decontamination", docs)
    assert clean == {k: x for k, x in texts.items() if k not in leaking} and leaking
    # in a row, as the pipeline has them
    good = run("quality", docs)
    assert all(texts[k] == x for k, x in good.items()) and 0 < len(good) < len(texts)
    left = {k: good[k] for k, (_, _, kept) in _components(good).items() if kept}
    left = {k: x for k, x in _units_kept(left).items() if x == left[k] or (x or "").strip(" ")}
    gone = _leaking(left, items)
    left = {k: x for k, x in left.items() if k not in gone}
    _check_packing(corpus_pipeline.run(spark, SF).collect(), left)


def test_decontamination_drops_leaks_without_an_id(spark):
    import corpus_pipeline

    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(r["text"].split()) >= 20)
    docs = spark.createDataFrame([(None, item, "en", "s", 1), (1, item, "en", "s", 1), (2, "clean", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in corpus_pipeline.decontamination_stage(spark, docs, SF).collect()] == [2]


def test_stages_take_odd_rows(spark):
    """Null, empty and long texts, repeated rows, rows without an id, and columns whose names clash with inner ones."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (5, ODD[5]), (None, "no id at all but some words here"), (None, None), (9, "another text of the same id as an older one")]
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("x") for c in ("node", "at", "row", "spans", "kept", "copy", "item", "digest")})
    out = {name: collections.Counter((r["doc_id"], r["text"]) for r in stage(spark, docs, SF).collect()) for name, stage in stages.items() if name not in ("quality", "packing")}
    every = collections.Counter(rows)
    assert out["decontamination"] == every
    # 6 repeats 5; both rows of 5 stay
    assert out["near_dup"] == every - collections.Counter([(6, ODD[6])])
    # 6 repeats 5, and the second line and all after it repeat the first of the last text
    gone = collections.Counter([(6, ODD[6]), (9, ODD[9])])
    assert out["unit_dedup"] == every - gone + collections.Counter([(9, "A, b!\n")])
    good = stages["quality"](spark, docs, SF)
    assert good.columns == list(corpus_pipeline.COLUMNS) and good.count() <= len(rows)
    packed = stages["packing"](spark, docs, SF).collect()
    assert collections.Counter(r["doc_id"] for r in packed if r["start"] == 0) == collections.Counter(i for i, _ in rows)
