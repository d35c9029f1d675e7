"""Filter audit, periodic runs and fingerprints against brute force on small hand-made tables."""

import random
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
import xxhash

from seriesloom.llm import filter_audit, periodic_runs, simhash
from seriesloom.llm.textops import exact_word_hashes

SCHEMA = ("doc_id long, text string, source string, lang string, part string, failed int, n long, print long, runs string, "
          "component_id long")  # columns with clashing names


def prose(seed, size):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(300)}" for _ in range(size))


def rows_of(texts, start=0):
    return [(start + k, text, f"s{k % 3}" if k % 4 else None, "en", "x", 9, 9, 9, "x", 9) for k, text in enumerate(texts)]


TEXTS = [prose(1, 80), prose(1, 80), "ABC " * 60, None, "", " \n\t", "one", "a # b", "x y " * 40, prose(2, 50).upper(), prose(2, 3000),
         prose(3, 60) + " " + "loop the loop " * 9, "é " * 30, "na " * 11, "na " * 12, prose(1, 79) + " changed", "🙂 b\x0bc " * 20]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, ties, repeated rows, copies, a very long text and columns with clashing names."""
    rows = rows_of(TEXTS) + rows_of([TEXTS[0]]) + [(None, TEXTS[0], None, None, None, None, None, None, None, None),
                                                   (0, "another text", "s9", None, None, None, None, None, None, None),
                                                   (99, prose(5, 20_000) + " tail tail" * 400, "", "en", "x", 9, 9, 9, "x", 9)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# --- filter audit --------------------------------------------------------------------------------

def brute_failures(rows):
    least = {}
    for row in rows:
        if row.doc_id is not None:
            least[row.text or ""] = min(least.get(row.text or "", row.doc_id), row.doc_id)
    out = []
    for row in rows:
        text = row.text or ""
        words = text.split(" ")
        for space in "\t\n\v\f\r":
            words = [piece for word in words for piece in word.split(space)]
        words = [word for word in words if word]
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if row.doc_id is not None and row.doc_id > least[text]:
            fails.add("E")
        out.append((row.source or "", row.doc_id, fails))
    return out


def test_audit_against_every_order(odd, spark):
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (1, 1, 1), (2, None, 1), (8, 1, None), (None, 1, 1), (500, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    good, toxic = {0, 1, 8}, {1, 2}
    failures = brute_failures(odd.collect())
    want, totals = {}, Counter()
    for order in permutations("ABCDE"):
        for part in {part for part, _, _ in failures}:
            mine = [(doc, fails) for p, doc, fails in failures if p == part]
            for step, letter in enumerate(order, 1):
                left = [(doc, fails) for doc, fails in mine if not fails & set(order[:step - 1])]
                gone = [doc for doc, fails in left if letter in fails]
                totals[part, letter] += len(gone)
                want["".join(order), part, step] = (
                    len(left) - len(gone), len(gone), sum(letter in fails for _, fails in mine) - len(gone),
                    sum(fails == {letter} for _, fails in mine), sum(doc in good for doc in gone), sum(doc in toxic for doc in gone))
    got = filter_audit.interaction_audit(filter_audit.failure_counts(odd, labels)).collect()
    assert len(got) == len(want) == 600 * len({part for part, _, _ in failures})
    for row in got:
        assert want[row.filter_order, row.part, row.step] == (
            row.kept, row.removed, row.redundant, row.unique_fails, row.good_lost, row.toxic_lost)
        assert row.shapley == totals[row.part, row.filter_order[row.step - 1]]


def test_potential_gives_shapley_values_of_other_games(spark):
    pick = random.Random(3)
    counts = [(part, failed, pick.randrange(10**12)) for part in "pq" for failed in range(16) for _ in range(2)]
    frame = spark.createDataFrame(counts, "part string, failed int, n long")
    got = filter_audit.interaction_audit(frame, "WXYZ", measures=())
    assert sorted(got.columns) == sorted(["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "shapley"])
    for row in got.filter("filter_order = 'ZXWY'").collect():
        total = 0
        for order in permutations(range(4)):
            bit = "WXYZ".index("ZXWY"[row.step - 1])
            before = sum(1 << k for k in order[:order.index(bit)])
            total += sum(n for part, failed, n in counts if part == row.part and failed & 1 << bit and not failed & before)
        assert row.shapley == total


def test_audit_of_empty_tables(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.interaction_audit(filter_audit.failure_counts(nothing(spark), labels)).count() == 0
    rows = filter_audit.interaction_audit(filter_audit.failure_counts(odd.drop("source"), labels))
    assert rows.count() == 600 and rows.filter("good_lost > 0 or toxic_lost > 0").count() == 0


# --- periodic runs -------------------------------------------------------------------------------

def brute_runs(words, least=12):
    best = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end - at + period >= max(least, 2 * period):
                best.setdefault((at, end - at + period), period)
            at = max(end, at + 1)
    return sorted(((a, n, p) for (a, n), p in best.items()), key=lambda run: (run[0], run[2]))


@pytest.mark.parametrize("least", [1, 4, 12])
def test_runs_of_symbols_against_brute_force(least):
    for seed in range(400):
        pick = random.Random(seed)
        size = pick.choice([1, 2, 2, 3, 5])
        symbols = [pick.randrange(1, size + 1) for _ in range(pick.randrange(1, 60))]
        if seed % 2:
            period, first = pick.randrange(1, 9), pick.randrange(len(symbols))
            symbols = [symbols[k if k < first else first + (k - first) % period] if first + period <= len(symbols) else x
                       for k, x in enumerate(symbols)]
        got = [tuple(run) for run in periodic_runs.runs_of(symbols, size + 1, least).tolist()]
        assert got == brute_runs(symbols, least), seed


def test_islands_keep_every_run():
    for seed in range(300):
        pick = random.Random(seed)
        words = []
        while len(words) < 150:
            root = [b"r%d" % pick.randrange(6) for _ in range(pick.randrange(1, 14))]
            words += root * pick.choice([1, 1, 2, 3, 7]) + root[:pick.randrange(len(root) + 1)]
            words += [b"u%d" % pick.randrange(400) for _ in range(pick.randrange(12))]
        got = [tuple(run) for run in periodic_runs.text_runs(words, exact_word_hashes(b" ".join(words))).tolist()]
        assert sorted(got) == sorted(brute_runs(words)), seed
        kept = [word for k, word in enumerate(words) if not any(a + p <= k < a + n for a, n, p in got)]
        assert periodic_runs.without_repeats(words, np.array(got).reshape(-1, 3)) == b" ".join(kept)


def test_tree_of_a_text_holds_every_suffix_in_order():
    pick = random.Random(9)
    for size in (1, 2, 4):
        symbols = [pick.randrange(1, size + 1) for _ in range(80)]
        suffixes, falls = periodic_runs.SuffixTree(symbols, size + 1).tour()
        order = sorted(range(81), key=lambda k: [*symbols[k:], 0])
        assert suffixes.tolist() == order
        for one, other, fall in zip(order, order[1:], falls[1:].tolist()):
            same = next(k for k in range(81) if [*symbols[one:], 0, -1][k] != [*symbols[other:], 0, -2][k])
            assert same == fall


def test_runs_of_documents(odd):
    got = periodic_runs.periodic_runs(odd, periodic_runs.looped).collect()
    expected = Counter()
    for row in odd.collect():
        words = (row.text or "").encode().split()
        if row.doc_id is not None and words:
            checksum = zlib.crc32(str(row.doc_id).encode())
            if checksum % 10 == 0:
                a = checksum // 10 % len(words)
                p = 1 + (len(words) - a) // (3 + checksum // 10 % 8)
                words = [words[k] if k < a else words[a + (k - a) % p] for k in range(len(words))]
        runs = brute_runs(words) if len(words) < 5000 else [(20_000, 800, 1)] if words[-1] == b"tail" else None
        if runs is None:
            continue
        kept = b" ".join(w for k, w in enumerate(words) if not any(a + p <= k < a + n for a, n, p in runs))
        expected[row.doc_id, tuple(runs), kept] += 1
    found = Counter((row.doc_id, tuple(map(tuple, row.runs)), bytes(row.collapsed)) for row in got)
    assert found == expected


def test_some_documents_are_looped():
    hit = [doc for doc in range(200) if zlib.crc32(str(doc).encode()) % 10 == 0]
    assert [doc for doc in range(200) if periodic_runs.looped(doc, 50) is not None] == hit
    assert periodic_runs.looped(hit[0], 0) is None and periodic_runs.looped(None, 5) is None


def test_runs_of_an_empty_table(spark):
    assert periodic_runs.periodic_runs(nothing(spark)).count() == 0


# --- fingerprints --------------------------------------------------------------------------------

def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def least_reachable(prints, near):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= near:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(k) for k in range(len(prints))]


def test_fingerprints_and_components(odd):
    rows = odd.collect()
    prints = [brute_print(row.text) for row in rows]
    roots = least_reachable(prints, simhash.NEAR)
    least = {}
    for row, root in zip(rows, roots):
        if row.doc_id is not None:
            least[root] = min(least.get(root, row.doc_id), row.doc_id)
    want = Counter((row.doc_id, mine, least.get(root)) for row, mine, root in zip(rows, prints, roots))
    got = simhash.simhash_components(odd).collect()
    assert Counter((row.doc_id, row.print % (1 << 64), row.component_id) for row in got) == want


@pytest.mark.parametrize("most", [24, 4096])
def test_no_link_is_lost_in_buckets_of_any_bound(spark, most):
    pick = random.Random(most)
    bases = [pick.getrandbits(64) for _ in range(4)]
    prints = set()
    while len(prints) < 300:
        bits = pick.choice(bases) if pick.random() < 0.7 else pick.getrandbits(64)
        for _ in range(pick.randrange(8)):
            bits ^= 1 << pick.choice([pick.randrange(64), pick.randrange(3)])
        prints.add(bits)
    prints = sorted(prints)
    frame = spark.createDataFrame([(simhash.signed(bits),) for bits in prints], "print long")
    found = {tuple(sorted((row.a % (1 << 64), row.b % (1 << 64)))) for row in simhash.links(frame, most=most).collect()}
    place, parent = {bits: k for k, bits in enumerate(prints)}, list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        i, j = sorted((root(place[a]), root(place[b])))
        parent[j] = i
    assert [root(k) for k in range(len(prints))] == least_reachable(prints, simhash.NEAR)


@pytest.mark.parametrize("fan,frontier", [(2, 1), (3, 100), (8, 1 << 21)])
def test_gray_index_against_all_pairs(monkeypatch, fan, frontier):
    monkeypatch.setattr(simhash, "FAN", fan)
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    for seed in range(30):
        pick = random.Random(seed)
        keys, prints, want = [], [], []
        for key in range(pick.randrange(1, 5)):
            base = pick.getrandbits(64)
            own = {base ^ sum(1 << k for k in pick.sample(range(64), pick.randrange(6))) for _ in range(pick.randrange(1, 70))}
            keys += [key] * len(own)
            prints += sorted(own)
            want.append(len(set(least_reachable(sorted(own), simhash.NEAR))))
        a, _ = simhash.forest(np.array([keys, keys]), np.array(prints, dtype=np.uint64))
        assert len(a) == len(prints) - sum(want)


def test_neighbours_in_gray_order_differ_in_one_bit():
    codes = np.array([k ^ k >> 1 for k in range(1000)], dtype=np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(1000))


def test_simhash_of_an_empty_table(spark):
    assert simhash.simhash_components(nothing(spark)).count() == 0
