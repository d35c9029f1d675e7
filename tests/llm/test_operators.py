"""Text operators against brute force on small hand-made tables."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import (
    decontamination, language, lattice_lm, near_dedup, packing, quality_model, quality_rules, suffix_dedup, toxicity,
    token_counts)
from seriesloom.llm.linear import svm
from seriesloom.llm.tokens import END_ID, encoding

SCHEMA = "doc_id long, text string, lang string, score double, kept string, n_words long"  # columns with clashing names
WORDS = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "Lambda", "mu"]


def docs_of(spark, texts, start=0):
    return spark.createDataFrame([(start + k, text, "en", 0.5, "x", 7) for k, text in enumerate(texts)], SCHEMA)


def prose(seed, size):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randrange(40)) for _ in range(size))


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empties, ties, repeated rows, copies, near copies, shared passages and a very long text."""
    base, shared = prose(1, 120), prose(2, 30)
    near = base.split()
    near[50] = "changed"
    texts = [base, base, " ".join(near), None, "", "   \n\t", "one", "one two", "One  TWO", shared + " " + prose(3, 40),
             prose(4, 25) + " " + shared, prose(5, 20) + shared[:200] + prose(6, 9), "é" * 120, "xé" * 60, "a" * 70, "a" * 49,
             prose(7, 4000), prose(7, 4000) + " tail", prose(8, 60) + "\n" + prose(8, 60), "🙂 " * 30]
    frame = docs_of(spark, texts)
    again = spark.createDataFrame([(0, base, "en", 0.5, "x", 7), (None, base, None, None, None, None),
                                   (3, None, "en", 0.5, "x", 7)], SCHEMA)
    return frame.unionByName(again).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(frame):
    return [(row.doc_id, row.text) for row in frame.select("doc_id", "text").collect()]


# --- repeated passages ---------------------------------------------------------------------------

def brute_repeats(rows):
    least = {}
    data = [(-(1 << 63) if doc is None else doc, (text or "").encode()) for doc, text in rows]
    for doc, text in data:
        for i in range(len(text) - 49):
            key = text[i:i + 50]
            least[key] = min(least.get(key, doc), doc)
    out = []
    for (doc, text), (own, _) in zip(data, rows):
        gone = np.zeros(len(text) + 1, dtype=bool)
        for i in range(len(text) - 49):
            if least[text[i:i + 50]] < doc:
                gone[i:i + 50] = True
        gone = gone[:len(text)]
        left = bytes(b for b, g in zip(text, gone) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((own, len(text), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def digest(frame):
    return [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans),
             hashlib.sha256(bytes(r.kept)).hexdigest()) for r in frame.collect()]


def test_repeats_against_brute_force(hard):
    assert sorted(map(str, digest(suffix_dedup.remove_repeats(hard)))) == sorted(map(str, brute_repeats(texts_of(hard))))


def test_repeats_with_hot_anchors(spark):
    line = "This line stands in very many documents and has more than fifty bytes."
    frame = docs_of(spark, [prose(k, 8) + line + prose(100 + k % 7, 8) for k in range(40)])
    want = sorted(map(str, brute_repeats(texts_of(frame))))
    assert sorted(map(str, digest(suffix_dedup.remove_repeats(frame, hot=4)))) == want
    assert sorted(map(str, digest(suffix_dedup.remove_repeats(frame)))) == want


def test_hot_anchors_with_carried_columns(spark):
    line = "This line stands in very many documents and has more than fifty bytes."
    texts = [prose(k, 8) + line + prose(100 + k % 7, 8) for k in range(30)] + [None, "", line, line + " é" * 30]
    rows = [(None if k == 33 else k % 31, text, f"t{k}", k, k) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, shard int, spans int")
    plain = suffix_dedup.shortened(docs)
    left = sorted(map(str, plain.collect()))
    assert plain.columns == docs.columns and len(left) == len(rows)
    found = suffix_dedup.remove_repeats(docs, carry=True, hot=3)
    assert sorted(map(str, digest(found))) == sorted(map(str, brute_repeats(texts_of(docs))))
    assert sorted(row._carried_2 for row in found.collect()) == sorted(row[2] for row in rows)


def test_slices_and_small_parts_give_the_same(hard):
    want = sorted(map(str, brute_repeats(texts_of(hard))))
    assert sorted(map(str, digest(suffix_dedup.remove_repeats(hard, part_bytes=500, shard_bytes=700)))) == want


@pytest.mark.parametrize("most", [1 << 21, 100, 7])
def test_a_shard_in_slices_against_brute_force(most):
    pick = random.Random(11)
    pieces = [bytes(pick.choice(b"ab ") for _ in range(pick.randrange(50, 90))) for _ in range(9)]
    texts = [pick.choice(pieces) if k % 3 else pick.choice(pieces)[:40] + bytes(pick.choice(b"ab ") for _ in range(30)) for k in range(60)]
    ids = np.array([pick.randrange(25) for _ in texts])
    count = np.array([len(t) - 49 for t in texts], dtype=np.int32)
    whole, runs = suffix_dedup.repeated_in_shard(b"".join(texts), ids, count, np.ones(len(texts), dtype=bool), most)
    got = {(k, at) for k in np.flatnonzero(whole).tolist() for at in range(count[k])}
    for owner, first, last in runs:
        got |= {(k, at) for k, a, b in zip(owner.tolist(), first.tolist(), last.tolist()) for at in range(a, b + 1)}
    least = {}
    for doc, text in zip(ids.tolist(), texts):
        for at in range(len(text) - 49):
            least[text[at:at + 50]] = min(least.get(text[at:at + 50], doc), doc)
    assert got == {(k, at) for k, (doc, text) in enumerate(zip(ids.tolist(), texts)) for at in range(len(text) - 49)
                   if least[text[at:at + 50]] < doc}


def test_suffix_array_is_sorted_by_fifty_bytes():
    pick = random.Random(3)
    data = np.frombuffer(bytes(pick.choice(b"ab") for _ in range(900)) + b"a" * 300 + b"\xff" * 80 + b"\x00" * 80, dtype=np.uint8)
    places = np.array([pick.randrange(len(data) - 50) for _ in range(4000)], dtype=np.int32)
    order, fresh = suffix_dedup.suffix_array(suffix_dedup.words_at(data), places)
    strings = [data[p:p + 50].tobytes() for p in places[order].tolist()]
    assert strings == sorted(strings)
    assert fresh.tolist() == [True] + [a != b for a, b in zip(strings, strings[1:])]


def test_levels_merge_and_find_earlier_holders():
    pick = random.Random(5)
    data = np.frombuffer(bytes(pick.choice(b"ab") for _ in range(6000)), dtype=np.uint8)
    places, docs = np.arange(0, 5900), np.repeat(np.arange(59), 100)
    got = suffix_dedup.earlier_elsewhere(data, places, docs, batch=137)
    least = {}
    for at, doc in zip(places, docs):
        least.setdefault(data[at:at + 50].tobytes(), doc)
    assert got.tolist() == [least[data[at:at + 50].tobytes()] < doc for at, doc in zip(places, docs)]
    index = suffix_dedup.Levels()
    for first in range(0, 5900, 100):
        index.scan_and_add(data, places[first:first + 100], docs[first:first + 100])
    sizes = [len(strings) for strings, _ in index.levels]
    assert len(sizes) <= 8 and all(2 * b <= a for a, b in zip(sizes, sizes[1:]))


def test_equal_strings_have_equal_anchors():
    pick = random.Random(9)
    inner = bytes(pick.choice(b"abcdefgh ") for _ in range(50))
    found = set()
    for _ in range(20):
        text = bytes(pick.choice(b"xyz") for _ in range(pick.randrange(80))) + inner + b"qq" * pick.randrange(40)
        hashes, first = suffix_dedup.anchors(text)
        found.add(int(hashes[np.searchsorted(first, text.index(inner), "right") - 1]))
    assert len(found) == 1


def test_shortened_keeps_columns(hard, spark):
    left = suffix_dedup.shortened(hard)
    assert left.columns == hard.columns and left.count() == hard.count()
    assert left.filter("doc_id = 3 and text is null").count() == 2
    assert left.filter("doc_id = 12").first().text == "é" * 120
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


# --- near duplicates -----------------------------------------------------------------------------

def brute_components(rows, words=3, percent=85):
    sets = {}
    for doc, text in rows:
        tokens = (text or "").encode().lower().split()
        n = min(words, len(tokens))
        sets[doc] = {tuple(tokens[i:i + n]) for i in range(len(tokens) - n + 1)} if tokens else set()
    ids, parent = list(sets), {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted([root(a), root(b)])
                parent[y] = x
    return {(doc, len(sets[doc]), root(doc), root(doc) == doc) for doc in ids}


def test_near_duplicates_against_brute_force(hard):
    rows = hard.filter("doc_id is not null").dropDuplicates(["doc_id"])
    got = {tuple(row) for row in near_dedup.near_duplicates(rows).collect()}
    assert got == brute_components(texts_of(rows))


def test_chain_of_near_copies_and_large_group(spark):
    base, texts = prose(11, 200).split(), []
    for k in range(60):
        copy = list(base)
        for j in range(k % 12):
            copy[(17 * j + k) % 200] = f"edit{k}x{j}"
        texts.append(" ".join(copy))
    frame = docs_of(spark, texts)
    got = {tuple(row) for row in near_dedup.near_duplicates(frame).collect()}
    assert got == brute_components(texts_of(frame))


def test_near_duplicates_edge_cases(hard, spark):
    got = near_dedup.near_duplicates(hard)
    lone = {row.doc_id: row for row in got.collect()}
    assert lone[3].n_shingles == 0 and lone[3].kept and lone[4].kept
    assert lone[7].component_id == 7 and not lone[8].kept  # words compare without case
    assert lone[None].kept and lone[0].component_id is None  # a row without an id comes first
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    left = near_dedup.keep_one_of_each(hard)
    assert left.columns == hard.columns and left.filter("doc_id = 3").count() == 2


def test_an_id_with_two_texts_keeps_the_links_of_both(spark):
    """Both texts of id 5 have near copies, in groups that only the rare-shingle rule can tell apart."""
    base, other = prose(31, 120), prose(32, 130)
    rows = [(5, base), (5, other), (9, base + " tail"), (7, other + " tail"), (3, prose(33, 120)), (2, "end " + other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(row.doc_id, row.n_shingles): row.component_id for row in near_dedup.near_duplicates(docs).collect()}
    sizes = {text: len(near_dedup.shingle_set(text.encode(), 3)) for _, text in rows}
    assert got[5, sizes[base]] == 5 and got[9, sizes[base + " tail"]] == 5
    assert got[5, sizes[other]] == 2 and got[7, sizes[other + " tail"]] == 2 and got[2, sizes["end " + other]] == 2
    kept = near_dedup.keep_one_of_each(docs, words=3, percent=85)
    assert sorted(row.doc_id for row in kept.collect()) == [2, 3, 5, 5]


def test_rare_prefix_pairs_of_several_sets_against_brute_force(spark):
    pick = random.Random(12)
    texts = {}
    for group in range(6):
        words = prose(50 + group, 60).split()
        for copy in range(5):
            changed = [w if pick.random() > 0.03 else f"x{pick.randrange(99)}" for w in words]
            texts[near_dedup.class_key(near_dedup.shingle_set(" ".join(changed).encode(), 3))] = " ".join(changed)
    held_by = spark.createDataFrame([(bytearray(key), k % 4) for k, key in enumerate(texts)], "class_key binary, first long")
    classes = near_dedup.named_classes(held_by)  # four ids hold all texts
    key_of = {row.node: bytes(row.class_key) for row in classes.collect()}
    assert len(key_of) == len(texts)
    docs = spark.createDataFrame([(k % 4, text) for k, text in enumerate(texts.values())] * 2, "first long, text string")
    sets = near_dedup.shingle_sets(docs.join(classes, "first"), 3)
    nodes = sets.select("node", F.col("node").alias("label")).distinct()
    found = near_dedup.verified(near_dedup.rare_prefix_pairs(sets, nodes, 85), sets, 85)
    got = {tuple(sorted((key_of[row.a], key_of[row.b]))) for row in found.collect()}
    held = {key: set(near_dedup.shingle_set(text.encode(), 3).tolist()) for key, text in texts.items()}
    want = {tuple(sorted((a, b))) for a in held for b in held if a < b and 100 * len(held[a] & held[b]) >= 85 * len(held[a] | held[b])}
    assert got == want and want


def test_near_copies_go_whatever_the_other_columns_are_called(spark):
    text = prose(41, 80)
    names = ["doc_id", "text", "gone", "kept", "_gone_id", "any_kept", "component_id", "node", "bucket"]
    docs = spark.createDataFrame([(1, text, *"abcdefg"), (2, text, *"abcdefg"), (3, prose(42, 80), *"abcdefg")],
                                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:]))
    kept = near_dedup.keep_one_of_each(docs)
    assert kept.columns == names and sorted(row.doc_id for row in kept.collect()) == [1, 3]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    got = {row.node: row.label for row in near_dedup.components(links).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_signature_is_circulant():
    shingles = np.arange(1, 400, dtype=np.uint64) * np.uint64(7919)
    places = np.unique(near_dedup.mix(shingles ^ near_dedup.SIGMA_SEED) % np.uint64(near_dedup.CIRCLE)).astype(int)
    pi = near_dedup.PI[:near_dedup.CIRCLE]
    want = [pi[(places + k) % near_dedup.CIRCLE].min() for k in range(64)]
    assert near_dedup.signature(shingles, 64).tolist() == want


# --- packing and token counts --------------------------------------------------------------------

def test_tokens_equal_the_vocabulary_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    for text in ["", " ", "Plain text, and more.", "Ünïcode 🙂 é\n\n\t  x", "<|endoftext|> inside", prose(3, 300), "a" * 500]:
        assert encoding().encode_ordinary(text) == whole.encode(text, add_special_tokens=False).ids


def test_strings_of_special_tokens_are_ordinary_text():
    import public_tokenizers
    import tokenizers

    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    for text in ("<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>\n", "<|endof text|>"):
        ids = encoding().encode_ordinary(text)
        assert ids == whole.encode(text, add_special_tokens=False).ids and 50256 not in ids


def test_packing_loses_and_repeats_no_token(hard, spark):
    rows = packing.packing_report(hard).collect()
    want = sorted(len(encoding().encode_ordinary(text or "")) + 1 for _, text in texts_of(hard))
    firsts = sorted(row.doc_tokens for row in rows if row.start == 0)
    assert firsts == want and sum(row.length for row in rows) == sum(want)
    filled = {}
    for row in rows:
        filled.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    long = [row for row in rows if row.doc_id == 16]
    ids = encoding().encode_ordinary(prose(7, 4000)) + [END_ID]
    for row in long:
        part = ids[row.start:row.start + row.length]
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == row.ids_crc32
    assert packing.packing_report(empty(spark)).count() == 0


def test_best_fit_takes_the_tightest_window():
    pick = random.Random(3)
    lengths = sorted((pick.randrange(1, 100) for _ in range(800)), reverse=True)
    windows, offsets = packing.best_fit(lengths, 100)
    room = []
    for length, window, offset in zip(lengths, windows, offsets):
        fits = [r for r in room if r >= length]
        if fits:
            assert room[window] == min(fits)
        else:
            assert window == len(room)
            room.append(100)
        assert offset == 100 - room[window]
        room[window] -= length


def test_packed_sequences_hold_the_ids(hard):
    rows = packing.sequences(hard).collect()
    for row in rows:
        size = len(row.ids) // 4
        assert size == packing.CAPACITY or (size == row.n_tokens and size & (size - 1) == 0)
    total = Counter(x for row in rows for x in struct.unpack(f"<{row.n_tokens}I", bytes(row.ids)[:4 * row.n_tokens]))
    want = Counter(x for _, text in texts_of(hard) for x in encoding().encode_ordinary(text or "") + [END_ID])
    assert total == want


def test_context_report_against_brute_force(spark):
    lengths = [0, 0, 3, 3, 7, 1023, 1024, 1025, 5000, 5000]
    frame = spark.createDataFrame([(x,) for x in lengths], "n_tokens long")
    for row in token_counts.context_report(token_counts.length_histogram(frame)).collect():
        at = row.n_tokens
        assert row.truncated_tokens == sum(min(x, at) for x in lengths)
        assert row.docs_over == sum(x > at for x in lengths) and row.docs_at_most == sum(x <= at for x in lengths)
        assert row.tokens_at_most == sum(x for x in lengths if x <= at) and row.total_tokens == sum(lengths)
        assert row.lost_tokens == sum(lengths) - row.truncated_tokens and row.quantile == row.docs_at_most / len(lengths)


def test_token_lengths_of_edge_cases(hard, spark):
    got = Counter(row.n_tokens for row in token_counts.token_lengths(hard).collect())
    assert got == Counter(len(encoding().encode_ordinary(text or "")) for _, text in texts_of(hard))
    assert token_counts.length_histogram(token_counts.token_lengths(empty(spark))).count() == 0


# --- benchmark passages --------------------------------------------------------------------------

def brute_hits(words, items):
    hit, found = set(), set()
    for name, item in items:
        n = min(10, len(item))
        for i in range(len(item) - n + 1 if item else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == item[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(name)
    return hit, found


@pytest.mark.parametrize("block_pairs", [200_000, 7])
def test_decontamination_against_brute_force(spark, block_pairs):
    pick = random.Random(8)
    small = ["a", "b", "C", "é"]
    items = [(k, " ".join(pick.choice(small) for _ in range(size))) for k, size in enumerate([1, 2, 3, 10, 12, 15, 0, 11])]
    items = items[1:] + [(99, "b, C. a!"), (None, "c c c c")]
    texts = [" ".join(pick.choice(small) for _ in range(pick.randrange(60))) for _ in range(25)]
    texts += [items[3][1], "x " + items[4][1].upper() + " y", None, "", "--", "a_b-c"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = docs_of(spark, texts)
    split = [(name, decontamination.item_words((text or "").encode())) for name, text in items]
    for row in decontamination.find_contamination(frame, bench, block_pairs).collect():
        words = decontamination.item_words((texts[row.doc_id] or "").encode())
        hit, found = brute_hits(words, split)
        assert row.n_words == len(words) and set(row.hit_words) == hit
        assert set(row.item_ids) == {str(x) for x in found if x is not None}
    clean = {row.doc_id for row in decontamination.drop_contaminated(frame, bench, block_pairs).collect()}
    want = {k for k, text in enumerate(texts)
            if not brute_hits(decontamination.item_words((text or "").encode()), split)[0]}
    assert clean == want


def test_decontamination_keeps_repeated_rows_with_any_number_of_blocks(spark):
    rows = [(1, "one two three four")] * 3 + [(1, "other words")] + [(2, None)] * 2 + [(None, "five six")] * 2 + [(3, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([("a", "two three"), ("b", "five six"), ("c", "not there")], "item_id string, text string")

    def found(block_pairs):
        return sorted(map(repr, decontamination.find_contamination(frame, bench, block_pairs).collect()))

    assert len(found(1)) == len(rows) and found(1) == found(100)


def test_decontamination_with_empty_tables(hard, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_contamination(hard, none).filter(F.size("hit_words") > 0).count() == 0
    assert decontamination.drop_contaminated(hard, none).count() == hard.count()
    assert decontamination.find_contamination(empty(spark), none).count() == 0


# --- language model ------------------------------------------------------------------------------

def test_lattice_sums_over_all_segmentations():
    scores = {b"a": -1.0, b"b": -2.0, b"ab": -1.5, b"ba": -2.5, b"aba": -3.0, b"c": -4.0}
    lattice = lattice_lm.Lattice(scores)

    def brute(text):
        if not text:
            return 1.0
        return sum(math.exp(scores[text[:k]]) * brute(text[k:]) for k in range(1, len(text) + 1) if text[:k] in scores)

    for text in [b"a", b"ab", b"abab", b"ababab", b"cabac", b"bbbaaabab"]:
        assert lattice.log_probability(text) == pytest.approx(math.log(brute(text)))
    assert lattice.log_probability(b"") == 0 and lattice.log_probability(b"z") == -math.inf


@pytest.mark.parametrize("head", [150_000, 3])
def test_language_model_scores(hard, monkeypatch, head):
    choose = lattice_lm.head_words
    monkeypatch.setattr(lattice_lm, "head_words", lambda words: choose(words, head))
    rows = texts_of(hard)
    fold = [zlib.crc32(str(doc).encode()) % 7 if doc is not None else -1 for doc, _ in rows]
    counts, ends = Counter(), 0
    for (_, text), f in zip(rows, fold):
        if f != 2:
            counts.update((text or "").encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    pieces = Counter()
    for word, k in counts.items():
        for piece in encoding().encode_ordinary(" " + word.decode()):
            pieces[piece] += k
    scores, end = lattice_lm.piece_scores(pieces, ends)
    lattice, want = lattice_lm.Lattice(scores), []
    for (doc, text), f in zip(rows, fold):
        words = (text or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        score = (sum(lattice.log_probability(b" " + w) for w in words) + end) / math.log(10)
        want.append((doc, f == 2, len(words) + 1, sum(counts[w] > 0 for w in words) + 1, n, base, score))
    key = lambda x: (x[0] is None, x[0] or 0, x[2], x[5])
    got = sorted((tuple(row) for row in lattice_lm.score_texts(hard).collect()), key=key)
    merged = sorted(set(want), key=key)
    assert len(got) == len(merged)
    for a, b in zip(got, merged):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6])


def test_language_model_of_nothing(spark):
    assert lattice_lm.score_texts(empty(spark)).count() == 0


# --- language, toxicity, quality -----------------------------------------------------------------

def speech(lang, k):
    stock = {"en": "the of and house water", "de": "der und ist haus wasser", "fr": "le et la maison eau"}[lang].split()
    pick = random.Random(f"{lang}{k}")
    return " ".join(pick.choice(stock) for _ in range(12))


def test_language_learns_and_answers(spark):
    rows = [(k, speech(lang, k), lang) for k in range(90) for lang in [["en", "de", "fr"][k % 3]]]
    frame = spark.createDataFrame(rows + [(900, None, "en"), (901, "12 34 !", "fr"), (902, "", None)],
                                  "doc_id long, text string, lang string")
    got = {row.doc_id: row for row in language.identify(frame, language.learn(frame)).collect()}
    assert all(got[k].lang_pred == lang for k, _, lang in rows)
    assert all(got[k].lang_pred == "und" and got[k].score == 0 for k in (900, 901, 902))
    assert all(0 <= row.score <= 1 for row in got.values())
    nobody = frame.withColumn("lang", F.lit(None).cast("string"))
    assert language.learn(nobody) is None
    assert {row.lang_pred for row in language.identify(nobody, None).collect()} == {"und"}
    single = language.learn(frame.filter("lang = 'de'"))
    assert {row.lang_pred for row in language.identify(frame.filter("lang = 'en' AND doc_id < 900"), single).collect()} == {"de"}


def test_string_kernel_against_definition():
    from itertools import combinations

    def phi(s):
        out = Counter()
        for places in combinations(range(len(s)), toxicity.LENGTH):
            if places[-1] - places[0] < toxicity.STRETCH and all(97 <= s[p] <= 122 for p in places):
                out[bytes(s[p] for p in places)] += toxicity.DECAY ** (places[-1] - places[0] + 1)
        return out

    strings, marks = [b"idiot", b"i.d.i.o.t", b"idxiot", b"hahahahaha", b"abc", b"unrelated"], [b"idiot", b"moron"]
    got = toxicity.Landmarks(marks).similarity(strings)
    for i, s in enumerate(strings):
        for j, m in enumerate(marks):
            a, b = phi(s), phi(m)
            norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
            want = sum(a[u] * b[u] for u in a) / norm if norm else 0.0
            assert got[i, j] == pytest.approx(want, abs=1e-5)
    assert got[1, 0] > 0.9 and got[2, 0] > 0.4 and got[5, 0] < 0.1


def test_string_kernel_counts_wide_subsequences():
    from itertools import combinations

    def phi(s):
        out = Counter()
        for places in combinations([p for p, c in enumerate(s) if c.isalpha()], toxicity.LENGTH):
            out["".join(s[p] for p in places)] += toxicity.DECAY ** (places[-1] - places[0] + 1)
        return out

    words = ["idiot", "stupid"]
    strings = [gap.join(word) for word in words for gap in ("--", "---", "\u200b", "\u200b\u2014", "." * 9, "x")] + ["hahahahahaha"]
    got = toxicity.Landmarks([x.encode() for x in words]).similarity([x.encode() for x in strings])
    for i, s in enumerate(strings):
        for j, m in enumerate(words):
            a, b = phi(s), phi(m)
            norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
            assert got[i, j] == pytest.approx(sum(a[u] * b[u] for u in a) / norm, abs=1e-5)
    assert got[2, 0] == pytest.approx(toxicity.Landmarks([b"idiot"]).similarity([b"i-d-i-o-t"])[0, 0])
    weights = np.random.default_rng(3).normal(size=32 ** toxicity.LENGTH).astype(np.float32)
    for text in strings:
        whole, = toxicity.stretches(text.encode())
        want = sum(weights[code] * value for code, value in toxicity.profile(whole).items())
        assert toxicity.dot([whole], weights)[0] == pytest.approx(want, abs=1e-5)
    long = toxicity.stretches("--".join("abcdefghijklmnopqrstu").encode())
    assert [x.replace(b"--", b"") for x in long] == toxicity.stretches(b"abcdefghijklmnopqrstu")


@pytest.mark.parametrize("bias", [-1.8, -0.9, -0.5, 0.2])
def test_decisions_skip_no_norm_that_matters(bias):
    pick = random.Random(8)
    words = [gap.join(pick.choice("idotsupe") for _ in range(pick.randrange(4, 12))) for gap in ("", "", "-", "--", "-----") for _ in range(60)]
    strings = [toxicity.START + x.encode() + toxicity.END for x in ["idiot", "i---d---i---o---t", *words]]
    marked = toxicity.profile(strings[0])
    codes = np.array(sorted(marked))
    values = np.array([marked[c] * (20 if k % 3 else -20) for k, c in enumerate(codes)], dtype=np.float32)
    value = dict(zip(codes.tolist(), values.tolist()))
    got = toxicity.Model(codes, values, bias, (1.0, 0.0, 0.0, 0.0, 0.0), 0.1).decisions(strings)
    for x, decision in zip(strings, got):
        whole = toxicity.profile(x)
        raw, norm = sum(value.get(c, 0) * w for c, w in whole.items()), math.sqrt(sum(w * w for w in whole.values()))
        assert decision == pytest.approx(max(raw / norm + bias, toxicity.FLOOR), abs=1e-4)


def test_long_words_are_read_whole_up_to_the_span():
    for word in ("numbskull" * 2, "n-u-m-b-s-k-u-l-l" * 2, "abcdefghijklmnopqrstuvwx"):
        assert toxicity.stretches(word.encode()) == [toxicity.START + word.encode() + toxicity.END]
    longer = toxicity.stretches(b"abcdefghijklmnopqrstuvwxyzabcdefghijkl")
    assert len(longer) > 1 and all(len(piece.strip(b"\xfe\xff")) <= toxicity.SPAN for piece in longer)
    assert b"".join(sorted(set(longer), key=longer.index)).strip(b"\xfe\xff").startswith(b"abc") and longer[-1].endswith(b"jkl" + toxicity.END)
    assert toxicity.DECAY ** (toxicity.SPAN + 1) < 3e-6


def test_clean_texts_are_told_apart(spark):
    docs, labels = toxic_tables(spark)
    got = toxicity.score_texts(docs, toxicity.learn(docs, labels)).filter("hits = 0").collect()
    assert len({row.decision for row in got}) > 3 and min(row.decision for row in got) > toxicity.FLOOR - 1e-9


def test_toxicity_finds_wide_gaps(spark):
    docs, labels = toxic_tables(spark)
    wide = spark.createDataFrame([(2000 + k, f"alpha {gap.join('numbskull')} beta") for k, gap in
                                  enumerate(["--", "---", "\u200b", "\u200b\u200b", "\u2022\u2022\u2022"])], docs.schema)
    got = toxicity.score_texts(wide, toxicity.learn(docs, labels)).collect()
    assert len(got) == 5 and all(row.score >= toxicity.THRESHOLD for row in got)


def toxic_tables(spark, n=400):
    pick, rows, marks = random.Random(4), [], []
    for k in range(n):
        words = [pick.choice(WORDS) for _ in range(30)]
        bad = k % 4 == 0
        if bad:
            words[pick.randrange(30)] = pick.choice(["blockhead", "numbskull"])
        rows.append((k, " ".join(words)))
        marks.append((k, 1, int(bad)))
    odd = [(1000, "alpha b.l.o.c.k.h.e.a.d beta"), (1001, "alpha b l o c k h e a d beta"), (1002, "alpha bloxckhead"),
           (1003, None), (1004, ""), (1005, "alpha beta gamma")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxicity_finds_insults_and_their_disguises(spark):
    docs, labels = toxic_tables(spark)
    model = toxicity.learn(docs, labels)
    got = {row.doc_id: row.score for row in toxicity.score_texts(docs, model).collect()}
    assert all((got[k] >= toxicity.THRESHOLD) == (k % 4 == 0) for k in range(400))
    assert all(got[k] >= toxicity.THRESHOLD for k in (1000, 1001, 1002))
    assert all(0 <= got[k] < toxicity.THRESHOLD for k in (1003, 1004, 1005))
    assert set(toxicity.drop_toxic(docs, model).toPandas().doc_id) == {k for k in got if got[k] < toxicity.THRESHOLD}


def test_toxicity_without_usable_labels(spark, hard):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    clean = spark.createDataFrame([(0, 1, 0), (1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, clean):
        rows = toxicity.score_texts(hard, toxicity.learn(hard, labels)).collect()
        assert len(rows) == hard.count() and all(row.score < 0.01 for row in rows)


def test_expectation_maximisation_recovers_accuracies():
    pick = np.random.default_rng(2)
    n, k = 60_000, len(quality_model.LABELLERS)
    good, right = pick.random(n) < 0.8, np.linspace(0.75, 0.95, k)
    cast = np.where(pick.random((n, k)) < right, good[:, None], ~good[:, None]).astype(int)
    cast[pick.random((n, k)) < 0.2] = quality_model.NONE
    patterns, counts = np.unique([quality_model.pattern_of(tuple(row)) for row in cast], return_counts=True)
    _, chance, share = quality_model.estimate(patterns, counts.astype(float))
    assert share == pytest.approx(0.8, abs=0.02)
    assert np.allclose(chance[1][:, quality_model.GOOD], 0.8 * right, atol=0.02)


def test_quality_model_scores_every_row(hard, spark):
    rows = quality_model.score_texts(hard, quality_model.learn(hard)).collect()
    assert len(rows) == hard.count() and all(0 <= row.score <= 1 for row in rows)
    assert quality_model.learn(empty(spark)) is None
    assert quality_model.score_texts(empty(spark), None).count() == 0


def test_binomial_tail_against_direct_sum(spark):
    cases = [(0, 10, 0.1), (3, 50, 0.1), (2, 900, 0.005), (40, 10_000, 0.005), (700, 200_000, 0.005), (9, 10, 0.1)]
    frame = spark.createDataFrame([(k, n) for k, n, _ in cases], "k long, n long")
    for k, n, p in cases:
        got = frame.filter((F.col("k") == k) & (F.col("n") == n)).select(
            quality_rules.binomial_tail(F.col("k"), F.col("n"), p).alias("x")).first().x
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                + (n - i) * math.log1p(-p) for i in range(k + 1)]
        assert got == pytest.approx(1.0 if k > n * p else math.fsum(map(math.exp, logs)), rel=1e-8)


def test_rules_measures_against_brute_force(hard):
    by_id = {row.doc_id: row for row in quality_rules.measured(hard).collect()}
    for doc, text in texts_of(hard):
        words, lines = re.findall(r"[^\x20\x09-\x0D]+", text or ""), (text or "").split("\n")
        seen, repeats = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4)), set()
        for i in range(len(words) - 4):
            if seen[tuple(words[i:i + 5])] > 1:
                repeats.update(range(i, i + 5))
        lines = [line for line in lines if re.search(r"[^\x20\x09-\x0D]", line)]
        row = by_id[doc]
        assert (row.n_words, row.word_chars, row.n_repeat_words) == (len(words), sum(map(len, words)), len(repeats))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))


def test_rules_without_labels_keep_what_passes_the_base(hard, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality_rules.apply_rules(hard, none).collect()
    assert len(rows) == hard.count() and all(row.kept != row.base_failed for row in rows)
    assert quality_rules.apply_rules(empty(spark), none).count() == 0


def test_rules_limit_false_rejection(spark):
    pick = random.Random(6)
    rows = [(k, " ".join(pick.choice(WORDS) + ("#" if k % 10 == 9 else "") for _ in range(20)), "en") for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 10 != 9), 0) for k, _, _ in rows], "doc_id long, quality int, toxic int")
    got = {row.doc_id: row.kept for row in quality_rules.apply_rules(docs, labels).collect()}
    assert not any(got[k] for k in range(9, 4000, 10))
    assert sum(not got[k] for k in got if k % 10 != 9) <= 0.02 * 3600


def test_the_walk_takes_a_cutoff_of_each_rule_in_turn_and_never_loosens():
    assert sorted(quality_rules.WALK) == sorted((r, c) for r, cutoffs in quality_rules.RULES.items() for c in cutoffs)
    for rule, cutoffs in quality_rules.RULES.items():
        assert cutoffs == sorted(cutoffs, reverse=True) == [c for r, c in quality_rules.WALK if r == rule]
    assert [rule for rule, _ in quality_rules.WALK[:4]] == list(quality_rules.RULES)


def test_selected_steps_against_exact_bounds(spark):
    """Per stratum the last step before the first whose exact bound fails; too few labels select none."""
    pick = random.Random(8)
    rows = [(k, s, pick.choice([3, 9, 20, 43, 43, 43, 43, 43])) for k, s in enumerate("a" * 900 + "b" * 300 + "c" * 20)]
    measures = spark.createDataFrame(rows, "doc_id long, stratum string, first_step int").selectExpr(
        "*", "100L AS n_words", "0L AS n_repeat_words")
    labels = spark.createDataFrame([(k, 1) for k, _, _ in rows], "doc_id long, quality int")
    got = {row.stratum: (row.last_step, row.n_good, row.n_rejected) for row in
           quality_rules.selected_steps(measures, labels, risk=0.2).collect()}
    want = {}
    for stratum in "abc":
        steps = [t for _, s, t in rows if s == stratum]
        for step in range(len(quality_rules.WALK)):
            k, n = sum(t <= step for t in steps), len(steps)
            tail = 1.0 if k > 0.2 * n else math.fsum(math.comb(n, i) * 0.2**i * 0.8**(n - i) for i in range(k + 1))
            if tail > quality_rules.DELTA / 3:
                break
            want[stratum] = (step, n, k)
    assert got == want and len(want) >= 2


def test_svm_separates():
    pick = np.random.default_rng(1)
    x = pick.normal(size=(200, 5))
    y = np.where(x[:, 0] - x[:, 1] > 0, 1.0, -1.0)
    assert ((x @ svm(x, y, 10.0) > 0) == (y > 0)).mean() > 0.97
