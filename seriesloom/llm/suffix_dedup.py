"""Removing repeated passages with a logarithmic family of suffix arrays.

A byte is removed if a string of 50 bytes covers it that also starts in a document with a
smaller id. Strings are judged on the input, matches never cross documents.

Suffixes enough for exact results are found first. The least hash among the 20-byte strings of a
50-byte string is its anchor; equal strings have equal anchors at the same place, and only
about one position in sixteen is one.
  1. Anchors of all documents are counted by hash; those that two documents hold come back to
     their documents. (Hashes travel packed, by bucket of the hash.)
  2. Each document cuts out, for each such anchor, the stretch of text whose strings it stands
     for. Equal stretches of documents dealt to the same part are settled there: all but the
     smallest id are repeats. The others travel by anchor. A hot anchor (in more than ``HOT``
     places and a quarter of its shard) sends each of its strings by that string's own hash, so no task
     gets the surroundings of a common line whole.
  3. Each shard drops equal stretches of later documents at once and indexes what is left in batches of
     rising document id. A batch gets a suffix array: the places of its strings in the
     shard's bytes, in the order of the 50 bytes that follow. It is merge-scanned against all existing levels
     for matches of full length, then becomes a level; levels of like size are merged in one
     linear pass, so n batches make about log n levels. The earliest document of each string decides.
  4. The removed stretches go back to their documents.
The numbers of parts and shards follow from the bytes of text (``PART_BYTES``, ``SHARD_BYTES``), so a task's
memory does not grow with the data; a shard of many strings is searched in slices. Texts are
shuffled once and read twice.

Defined cases: null text is empty; texts under 50 bytes stay whole; repeated rows and rows
with one id never remove each other's bytes; rows without an id count as one document with the smallest id (they
are dealt to many parts); an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
import zlib
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import give_back, map_arrow, ship, small_batches, table, text_bytes
from seriesloom.llm.registry import query
from seriesloom.llm.textops import mix

MATCH = 50
GRAM = 20
REACH = MATCH - GRAM + 1
HOT = 4096
BATCH = 1 << 17
SLICE = 1 << 21
FLUSH_BYTES = 24 << 20
PART_BYTES = 4 << 20
SHARD_BYTES = 12 << 20
#: Rows without an id are dealt by numbers up to NO_ID, which all count as NO_ID.
NO_ID = -(1 << 63) + (1 << 20)
CODE_BITS = 40

FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: Bytes of a string that are compared after the first eight, five at a time.
STEPS = range(8, MATCH, 5)


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a big-endian number; a view of ``data``."""
    return np.ndarray((max(len(data) - 7, 0),), dtype=">u8", buffer=data, strides=(1,))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position on."""
    words = words_at(data) * FACTORS[0]
    words ^= words >> np.uint64(32)
    count = len(data) - GRAM + 1
    h = words[:count] * FACTORS[1] + words[8:8 + count] * FACTORS[2] + words[GRAM - 8:GRAM - 8 + count]
    return mix(h)


def extreme(values: np.ndarray, width: int, best) -> np.ndarray:
    """Running ``best`` (np.minimum or np.maximum) over ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    return best(values[:-(width - size)], values[width - size:]) if width > size else values


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each distinct stretch's anchor, and the first string that each stands for.

    Strings (starts 0 .. n-MATCH) in a row with one anchor form a stretch; the second array gives
    the first start of each stretch.
    """
    if len(text) < MATCH:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    h = gram_hashes(np.frombuffer(text, dtype=np.uint8))
    placed = h >> np.uint64(32)
    placed <<= np.uint64(32)
    placed |= np.arange(len(h), dtype=np.uint64)
    chosen = extreme(placed, REACH, np.minimum).astype(np.uint32)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    return h[chosen[first]], first


def packed(values: np.ndarray) -> bytes:
    """The low CODE_BITS of each value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE_BITS // 8]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // (CODE_BITS // 8), 8), dtype=np.uint8)
    out[:, :CODE_BITS // 8] = np.frombuffer(data, dtype=np.uint8).reshape(-1, CODE_BITS // 8)
    return out.view("<u8").reshape(-1)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(CODE_BITS)) % np.uint64(shards)).astype(np.int64)


def prime_from(least: int) -> int:
    """The least prime number from ``least`` on; ids in regular steps still spread over so many parts."""
    while any(least % k == 0 for k in range(2, int(least ** 0.5) + 1)):
        least += 1
    return least


def split_by(keys: np.ndarray):
    """(key, rows) for each distinct key."""
    order = np.argsort(keys, kind="stable")
    edges = np.flatnonzero(np.diff(keys[order])) + 1
    for rows in np.split(order, edges) if len(keys) else []:
        yield int(keys[rows[0]]), rows


def to_shards(docs: DataFrame, shards: int) -> DataFrame:
    """Step 1, documents: shard, blobs of ids, anchors per id, anchor codes."""
    def look(batches):
        held, size = [], 0

        def flush():
            ids = np.repeat([doc for doc, _ in held], [len(x) for _, x in held]).astype(np.int64)
            codes = np.concatenate([x for _, x in held]) if held else np.empty(0, dtype=np.uint64)
            out = []
            for shard, rows in split_by(shard_of(codes, shards)):
                owner = ids[rows]
                edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                counts = np.diff(np.concatenate([edge, [len(owner)]])).astype(np.uint32)
                out.append((shard, owner[edge].tobytes(), counts.tobytes(), packed(codes[rows])))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int32()), *[pa.array([x[k] for x in out], pa.binary()) for k in (1, 2, 3)]],
                ["shard", "ids", "counts", "codes"])

        for batch in small_batches(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text"))):
                held.append((doc, np.unique(anchors(text)[0])))
                size += len(text)
            if size > FLUSH_BYTES:
                yield flush()
                size = 0
        if held:
            yield flush()

    return map_arrow(docs.select("doc_id", "text"), look, "shard int, ids binary, counts binary, codes binary")


def gathered(batches) -> dict[int, list[dict]]:
    """All rows of a partition by their shard."""
    out: dict[int, list[dict]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            out.setdefault(row["shard"], []).append(row)
    return out


def shared_anchors(blobs: DataFrame, parts: int, hot_from: int = HOT) -> DataFrame:
    """Step 1, shards: part, blobs of ids, hashes held by several ids, whether hot."""
    def count(batches):
        for shard, rows in gathered(batches).items():
            ids = np.concatenate([np.repeat(np.frombuffer(row["ids"], dtype=np.int64),
                                            np.frombuffer(row["counts"], dtype=np.uint32)) for row in rows])
            codes = np.concatenate([unpacked(row["codes"]) for row in rows])
            order = np.argsort(codes, kind="stable")
            ids, codes = ids[order], codes[order]
            edge = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, int)
            if not len(edge):
                continue
            held = np.diff(np.concatenate([edge, [len(codes)]]))
            several = np.minimum.reduceat(ids, edge) != np.maximum.reduceat(ids, edge)
            keep, hot = np.repeat(several, held), np.repeat(held > max(hot_from, len(codes) // 4), held)
            ids, codes, hot = ids[keep], codes[keep], hot[keep]
            out = []
            for part, mine in split_by(np.mod(ids, parts)):
                by_id = mine[np.argsort(ids[mine], kind="stable")]
                out.append((part, shard, ids[by_id].tobytes(), packed(codes[by_id]), np.packbits(hot[by_id]).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()),
                 *[pa.array([x[k] for x in out], pa.binary()) for k in (2, 3, 4)]],
                ["part", "shard", "ids", "codes", "hot"])

    return map_arrow(blobs, count, "part int, shard int, ids binary, codes binary, hot binary")


def row_order(texts: pa.Table) -> tuple[list[int], list[int], list[bytes]]:
    """Row numbers of a part by id and text (the same numbering each time it is read), and ids and texts so ordered."""
    ids = texts.column("doc_id").to_pylist()
    data = [value or b"" for value in texts.column("text").cast(pa.binary()).to_pylist()]
    order = sorted(range(len(ids)), key=lambda k: (ids[k], data[k]))
    return order, [ids[k] for k in order], [data[k] for k in order]


def cut_stretches(shards: int):
    """Step 2 for one part: its texts and the shared anchors of its ids to stretches by shard."""
    def cut(texts: pa.Table, replies: pa.Table) -> pa.Table:
        ids, keys, hots = [], [], []
        for row in replies.to_pylist():
            found = np.frombuffer(row["ids"], dtype=np.int64)
            ids.append(found)
            keys.append(unpacked(row["codes"]) | np.uint64(row["shard"] << CODE_BITS))
            hots.append(np.unpackbits(np.frombuffer(row["hot"], dtype=np.uint8), count=len(found)))
        if not ids:
            return stretches_table([])
        ids, keys, hots = np.concatenate(ids), np.concatenate(keys), np.concatenate(hots).astype(bool)
        order = np.argsort(ids, kind="stable")
        ids, keys, hots = ids[order], keys[order], hots[order]
        part = texts.column("part")[0].as_py() if texts.num_rows else 0
        seen: dict[bytes, int] = {}
        out: dict[int, list] = {}
        settled = out.setdefault(part % shards, [])
        for number, (doc, text) in enumerate(zip(*row_order(texts)[1:])):
            lo, hi = np.searchsorted(ids, doc, "left"), np.searchsorted(ids, doc, "right")
            if lo == hi or len(text) < MATCH:
                continue
            named = max(doc, NO_ID)
            hashes, first = anchors(text)
            own = np.uint64(CODE_BITS)
            full = (hashes & np.uint64((1 << CODE_BITS) - 1)) | (shard_of(hashes, shards).astype(np.uint64) << own)
            by_key = lo + np.argsort(keys[lo:hi], kind="stable")
            mine = keys[by_key]
            at = np.minimum(np.searchsorted(mine, full), len(mine) - 1)
            shared = mine[at] == full
            last = np.concatenate([first[1:], [len(text) - MATCH + 1]])
            for k in np.flatnonzero(shared).tolist():
                start, count, hot = int(first[k]), int(last[k] - first[k]), hots[by_key[at[k]]]
                stretch = text[start:start + count + MATCH - 1]
                if seen.setdefault(stretch, named) < named:
                    settled.append((named, number, start, count, b""))
                elif not hot:
                    out.setdefault(int(full[k] >> own), []).append((named, number, start, count, stretch))
                else:
                    for begin in range(start, start + count):
                        string = text[begin:begin + MATCH]
                        if seen.setdefault(string, named) < named:
                            settled.append((named, number, begin, 1, b""))
                        else:
                            out.setdefault(zlib.crc32(string) % shards, []).append((named, number, begin, 1, string))
        cut_out = stretches_table([(shard, part, rows) for shard, rows in out.items() if rows])
        out.clear()
        seen.clear()
        give_back()
        return cut_out

    return cut


STRETCHES = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("ids", pa.binary()), ("places", pa.binary()),
                       ("bytes", pa.binary())])


def stretches_table(blobs: list) -> pa.Table:
    packer = zstandard.ZstdCompressor(level=1)
    rows = []
    for shard, part, found in blobs:
        found.sort(key=lambda x: x[4])
        rows.append({"shard": shard, "part": part, "ids": np.array([x[0] for x in found], dtype=np.int64).tobytes(),
                     "places": np.array([(x[1], x[2], x[3], len(x[4]) > 0) for x in found], dtype=np.int32).T.tobytes(),
                     "bytes": packer.compress(b"".join([x[4] for x in found]))})
    return pa.Table.from_pylist(rows, schema=STRETCHES)


def heads_of(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    return words[places].astype(np.uint64)


def compared(words: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sign of string ``one`` against string ``other`` for pairs of places with equal first eight bytes."""
    sign = np.zeros(len(one), dtype=np.int8)
    left = np.arange(len(one))
    for at in (8, 16, 24, 32, 40, MATCH - 8):
        a, b = words[one[left] + at], words[other[left] + at]
        sign[left] = np.where(a < b, -1, a > b).astype(np.int8)
        left = left[a == b]
        if not len(left):
            break
    return sign


def suffix_array(words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings at ``places``, and whether each string of that order differs from the one before.

    Sorted by the first eight bytes; strings that tie are sorted on by the next five, as long as it takes. Runs
    of equal strings are recognised by comparing neighbours.
    """
    heads = heads_of(words, places)
    order = np.argsort(heads)
    fresh = np.ones(len(order), dtype=bool)
    ordered = heads[order]
    fresh[1:] = ordered[1:] != ordered[:-1]
    settled = np.zeros(len(order), dtype=bool)  # in a run of equal strings
    for step, at in enumerate(STEPS):
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        tied &= ~settled
        mine = np.flatnonzero(tied)
        if not len(mine):
            break
        group = np.cumsum(fresh[mine])
        if step in (1, 3):  # runs of equal strings need no more sorting
            same = np.concatenate([[False], compared(words, places[order[mine[:-1]]], places[order[mine[1:]]]) == 0])
            edge = np.flatnonzero(fresh[mine])
            equal = np.logical_and.reduceat(same | fresh[mine], edge)
            equal = np.repeat(equal, np.diff(np.append(edge, len(mine))))
            settled[mine[equal]] = True
            mine, group = mine[~equal], group[~equal]
            if not len(mine):
                break
        width = min(5, MATCH - at)
        start = min(at, MATCH - 8)
        keys = heads_of(words, places[order[mine]] + start)
        keys = (keys << np.uint64(8 * (at - start))) >> np.uint64(64 - 8 * width)
        keys |= group.astype(np.uint64) << np.uint64(40)
        by = np.argsort(keys)
        order[mine] = order[mine][by]
        keys = keys[by]
        fresh[mine] = np.concatenate([[True], keys[1:] != keys[:-1]])
    return order, fresh


class Levels:
    """A logarithmic family of suffix arrays over one buffer; each string keeps the earliest document that holds it.

    A level holds the places of distinct strings in rising order and their documents; ``heads`` holds
    the first eight bytes of each level's strings.
    """

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.heads: list[np.ndarray] = []

    def scan_and_add(self, data: np.ndarray, places: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Whether an earlier document holds the string at each place; the batch becomes a level."""
        words = words_at(data)
        order, fresh = suffix_array(words, places)
        edge = np.flatnonzero(fresh)
        distinct, own = places[order[edge]], np.minimum.reduceat(docs[order], edge)
        heads, earliest = heads_of(words, distinct), own.copy()
        for (level, first), known in zip(self.levels, self.heads):
            at, same = scanned(words, level, known, distinct, heads)
            earliest[same] = np.minimum(earliest[same], first[at[same]])
        repeated = np.empty(len(order), dtype=bool)
        repeated[order] = earliest[np.cumsum(fresh) - 1] < docs[order]
        self.levels.append((distinct, own))
        self.heads.append(heads)
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) > len(self.levels[-2][0]):
            *columns, known = merged(words, *self.levels[-2:], *self.heads[-2:])
            self.levels[-2:], self.heads[-2:] = [tuple(columns)], [known]
        return repeated


def scanned(words, level: np.ndarray, known: np.ndarray, places: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each string (in rising order) belongs in the level, and whether the level holds it."""
    low = np.searchsorted(known, heads, side="left")
    high = np.searchsorted(known, heads, side="right")
    same = np.zeros(len(places), dtype=bool)
    left = np.flatnonzero(low < high)
    while len(left):
        middle = (low[left] + high[left]) >> 1
        sign = compared(words, level[middle], places[left])
        found = sign == 0
        same[left[found]] = True
        low[left] = np.where(found, middle, np.where(sign < 0, middle + 1, low[left]))
        high[left] = np.where(sign < 0, high[left], middle)
        left = left[~found]
        left = left[low[left] < high[left]]
    return low, same


def merged(words, one, other, known: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, documents and heads of two levels as one, in a linear pass; a string of both keeps the earlier document."""
    at, same = scanned(words, one[0], known, other[0], heads)
    docs = one[1].copy()
    docs[at[same]] = np.minimum(docs[at[same]], other[1][same])
    new = np.flatnonzero(~same)
    to = at[new] + np.arange(len(new))
    kept = np.ones(len(docs) + len(new), dtype=bool)
    kept[to] = False
    out = []
    for mine, theirs in ((one[0], other[0]), (docs, other[1]), (known, heads)):
        column = np.empty(len(kept), dtype=mine.dtype)
        column[kept], column[to] = mine, theirs[new]
        out.append(column)
    return tuple(out)


def earlier_elsewhere(data: np.ndarray, places: np.ndarray, docs: np.ndarray, batch: int = BATCH) -> np.ndarray:
    """For each place (by rising document), whether a smaller document holds its string."""
    index, out = Levels(), np.zeros(len(places), dtype=bool)
    for first in range(0, len(places), batch):
        cut = slice(first, first + batch)
        out[cut] = index.scan_and_add(data, places[cut], docs[cut])
    return out


def joined(number: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Row numbers, starts and ends with stretches of a row that touch made one; three rows of int32."""
    order = np.lexsort([start, number])
    number, start, end = number[order].astype(np.int64), start[order], end[order]
    wide = number << 32  # ends of earlier rows lie below every start of the next
    reach = np.maximum.accumulate(wide + end)
    fresh = np.concatenate([[True], (wide + start)[1:] > reach[:-1]]) if len(order) else np.zeros(0, dtype=bool)
    edge = np.flatnonzero(fresh)
    last = np.concatenate([edge[1:], [len(order)]])[:len(edge)] - 1
    return np.stack([number[edge], start[edge], reach[last] - wide[last]]).astype(np.int32)


def removed_stretches(blobs: DataFrame) -> DataFrame:
    """Step 3: part, blobs of (row number, start, end) to remove."""
    def search(batches):
        opener, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for rows in gathered(batches).values():
            part = np.repeat(np.array([row["part"] for row in rows], dtype=np.int32), [len(row["ids"]) // 8 for row in rows])
            ids = np.concatenate([np.frombuffer(row["ids"], dtype=np.int64) for row in rows])
            number, start, count, open_ = np.concatenate(
                [np.frombuffer(row["places"], dtype=np.int32).reshape(4, -1) for row in rows], axis=1)
            text = b"".join([opener.decompress(row["bytes"]) for row in rows])
            rows.clear()
            whole, some = repeated_in_shard(text, ids, count, open_ > 0)
            whole |= open_ == 0
            found = [(part[whole], number[whole], start[whole], start[whole] + count[whole] + MATCH - 1)]
            for owner, first, last in some:
                found.append((part[owner], number[owner], start[owner] + first, start[owner] + last + MATCH))
            to, number, start, end = (np.concatenate(x) for x in zip(*found))
            out = [(p, packer.compress(joined(number[k], start[k], end[k]).tobytes())) for p, k in split_by(to)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()),
                                              pa.array([x[1] for x in out], pa.binary())], ["part", "removed"])

    return map_arrow(blobs, search, "part int, removed binary")


def repeated_in_shard(text: bytes, ids: np.ndarray, count: np.ndarray, given: np.ndarray, most: int = SLICE):
    """What a shard's stretches repeat of smaller documents.

    Returns which stretches are repeats as a whole, and (stretch, first string, last string) of further
    runs. ``text`` holds the bytes of the ``given`` stretches, ``count`` + MATCH - 1 each.
    """
    docs = np.unique(ids, return_inverse=True)[1].astype(np.int32)
    mine = np.flatnonzero(given)
    ends = np.cumsum(count[mine] + MATCH - 1, dtype=np.int64)
    bounds = [0, *ends.tolist()]
    # Equal stretches: those of later documents are repeats; the earliest document's are looked up.
    first: dict[bytes, int] = {}
    group = np.fromiter((first.setdefault(text[a:b], k) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))),
                        dtype=np.int64, count=len(mine))
    first.clear()
    least = np.full(len(mine), np.iinfo(np.int32).max, dtype=np.int32)
    np.minimum.at(least, group, docs[mine])
    later = docs[mine] > least[group]
    whole = np.zeros(len(ids), dtype=bool)
    whole[mine[later]] = True
    offsets = np.zeros(len(ids), dtype=np.int64)
    offsets[mine] = ends - (count[mine] + MATCH - 1)
    waiting = mine[~later]
    waiting = waiting[np.argsort(docs[waiting], kind="stable")]
    data, runs = np.frombuffer(text, dtype=np.uint8), []
    kind = np.int32 if len(text) < 1 << 31 else np.int64
    for owner, at in slices_of(data, offsets, count, waiting, most):
        flags = earlier_elsewhere(data, (offsets[owner] + at).astype(kind), docs[owner])
        hit, at = owner[flags], at[flags]
        if not len(hit):
            continue
        order = np.lexsort([at, hit])
        hit, at = hit[order], at[order]
        edge = np.flatnonzero(np.concatenate([[True], (hit[1:] != hit[:-1]) | (at[1:] != at[:-1] + 1)]))
        end = np.append(edge[1:], len(hit)) - 1
        runs.append((hit[edge], at[edge], at[end]))
    return whole, runs


def slices_of(data: np.ndarray, offsets: np.ndarray, count: np.ndarray, waiting: np.ndarray, most: int):
    """(stretch, string) of the waiting stretches' strings (int32), in that order, in slices that never part equal strings.

    A string's slice follows from its bytes and is found piece by piece, so memory follows the slice.
    """
    slices = max(1, -(-int(count[waiting].sum(dtype=np.int64)) // most))
    begins = np.cumsum(count[waiting], dtype=np.int64)
    pieces = np.split(waiting, np.searchsorted(begins, np.arange(most, int(begins[-1]), most)) + 1) if len(waiting) else []
    words = words_at(data)
    for mine in range(slices):
        found = []
        for piece in pieces:
            owner = np.repeat(piece, count[piece]).astype(np.int32)
            at = np.arange(len(owner), dtype=np.int32)
            at -= np.repeat(np.cumsum(count[piece]) - count[piece], count[piece]).astype(np.int32)
            if slices > 1:
                place = offsets[owner] + at
                key = mix(words[place] * FACTORS[0] + words[place + MATCH // 2] * FACTORS[1] + words[place + MATCH - 8])
                keep = key % np.uint64(slices) == mine
                owner, at = owner[keep], at[keep]
            found.append((owner, at))
        if found:
            yield tuple(np.concatenate(x) for x in zip(*found))


KEPT = "doc_id long, n_bytes long, spans array<struct<start: int, end: int>>, kept binary"


def whole_characters(kept: bytes) -> bytes:
    return kept.decode("utf-8", "ignore").encode("utf-8")


def strike(texts: pa.Table, replies: pa.Table) -> pa.Table:
    """Step 4 for one part: spans to remove and what is left of each text; carried columns follow.

    With carried columns, ``kept`` holds whole characters only and the text itself comes along.
    """
    carried = [name for name in texts.column_names if name.startswith("_carried_")]
    order, ids, data = row_order(texts)
    opener = zstandard.ZstdDecompressor()
    blobs = [np.frombuffer(opener.decompress(x), dtype=np.int32).reshape(3, -1) for x in replies.column("removed").to_pylist()]
    number, start, end = np.concatenate(blobs, axis=1) if blobs else np.empty((3, 0), dtype=np.int32)
    by_row = np.argsort(number, kind="stable")
    number, start, end = number[by_row], start[by_row], end[by_row]
    spans, kept = [], []
    edges = np.searchsorted(number, np.arange(len(ids) + 1))
    for k, text in enumerate(data):
        lo, hi = edges[k], edges[k + 1]
        if lo == hi:
            spans.append([])
            kept.append(text)
            continue
        depth = np.zeros(len(text) + 1, dtype=np.int32)
        np.add.at(depth, start[lo:hi], 1)
        np.add.at(depth, end[lo:hi], -1)
        gone = np.cumsum(depth[:-1]) > 0
        turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
        spans.append([{"start": int(a), "end": int(b)} for a, b in turns])
        left = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
        kept.append(whole_characters(left) if carried else left)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    columns = {"doc_id": pa.array([None if doc <= NO_ID else doc for doc in ids], pa.int64()),
               "n_bytes": pa.array([len(text) for text in data], pa.int64()),
               "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())}
    if carried:
        moved = texts.take(pa.array(order, pa.int64()))
        null = moved.column("_null").to_pylist()
        columns["_text_or_null"] = pa.array([None if gone else text.decode("utf-8") for gone, text in zip(null, data)],
                                            pa.string())
        columns |= {name: moved.column(name) for name in carried}
    return pa.table(columns)


def remove_repeats(docs: DataFrame, carry: bool = False, hot: int = HOT, part_bytes: int = PART_BYTES,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs, by byte), kept (the bytes that stay).

    With ``carry``, also the text as it was and every other column of ``docs`` as _carried_<place>.
    ``part_bytes`` and ``shard_bytes`` are the bytes of text a part and a shard stand for.
    """
    spark = docs.sparkSession
    ship(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards, parts = max(partitions, -(-size // shard_bytes)), prime_from(max(partitions, -(-size // part_bytes)))
    extra = [] if not carry else [F.col("text").isNull().alias("_null"), *[
        F.col(name).alias(f"_carried_{k}") for k, name in enumerate(docs.columns) if name != "text"]]
    dealt_id = F.lit(NO_ID) - F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(1 << 20))
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), dealt_id).alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *extra)
    replies = shared_anchors(to_shards(texts, shards).repartitionById(shards, F.col("shard")), parts, hot)
    dealt = texts.withColumn("part", F.pmod("doc_id", F.lit(parts)).cast("int"))
    stretches = (dealt.groupBy("part").cogroup(replies.groupBy("part"))
                 .applyInArrow(cut_stretches(shards), "shard int, part int, ids binary, places binary, bytes binary"))
    removed = removed_stretches(stretches.repartitionById(shards, F.col("shard")))
    schema = KEPT + (", _text_or_null string" if carry else "") + "".join(
        f", {name} {kind}" for name, kind in dealt.dtypes if name.startswith("_carried_"))
    return dealt.groupBy("part").cogroup(removed.groupBy("part")).applyInArrow(strike, schema)


def shortened(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without their repeated passages; all columns stay.

    A character of which a byte is removed goes whole. A null text stays null; ``n_chars``, if there is
    such a column, is counted anew for the rows that change.
    """
    found = remove_repeats(docs, carry=True)
    changed = F.size("spans") > 0
    text = F.when(changed, F.decode("kept", "UTF-8")).otherwise(F.col("_text_or_null"))
    columns = []
    for k, field in enumerate(docs.schema.fields):
        value = F.col(f"_carried_{k}")
        if field.name == "text":
            value = text
        elif field.name == "n_chars":
            value = F.when(changed, F.length(text)).otherwise(value)
        columns.append(value.cast(field.dataType).alias(field.name))
    return found.select(*columns)


SQL = f"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT *, length(h) // 2 AS n FROM texts),
strings AS (
  SELECT r, doc_id, i, substr(h, 2 * i + 1, 2 * {MATCH}) AS s
  FROM (SELECT r, doc_id, h, unnest(range(0, n - {MATCH} + 1)) AS i FROM sized WHERE n >= {MATCH})),
first_ids AS (SELECT s, min(doc_id) AS lo FROM strings GROUP BY s),
hits AS (SELECT r, i FROM strings JOIN first_ids USING (s) WHERE lo < doc_id),
marked AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {MATCH} THEN 0 ELSE 1 END AS fresh FROM hits),
grouped AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS g FROM marked),
runs AS (SELECT r, g, min(i) AS a, max(i) + {MATCH} AS b FROM grouped GROUP BY r, g),
cuts AS (
  SELECT r, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends, sum(b - a) AS gone, count(*) AS k
  FROM runs GROUP BY r),
kept AS (
  SELECT s.r, s.doc_id, s.n, coalesce(c.gone, 0) AS gone, coalesce(c.k, 0) AS k,
         CASE WHEN c.r IS NULL THEN s.h ELSE array_to_string(list_transform(range(0, c.k + 1), lambda j:
           substr(s.h, 2 * CASE WHEN j = 0 THEN 0 ELSE c.ends[j] END + 1,
                  2 * (CASE WHEN j = c.k THEN s.n ELSE c.starts[j + 1] END - CASE WHEN j = 0 THEN 0 ELSE c.ends[j] END))), '')
         END AS h
  FROM sized s LEFT JOIN cuts c USING (r))
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(gone AS BIGINT) AS n_removed, CAST(k AS BIGINT) AS n_spans,
       sha256(unhex(h)) AS kept_sha256 FROM kept
"""


@query("op2_suffix_array_dedup", SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
