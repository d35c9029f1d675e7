"""Near-duplicates by SimHash, found with a Gray-order hierarchical index of the fingerprints.

A fingerprint takes the majority of each of 64 bits over the XXH64 values of a text's four-word shingles,
repeats included. Texts whose fingerprints differ in at most ``NEAR`` bits are linked.

Equal fingerprints are one member, whatever the number of their documents. Members are dealt to buckets
so that no link is lost: with ``NEAR`` + 1 blocks of bits, two linked members agree on a whole block, so
each member goes to a bucket per block. A bucket of more than ``MOST`` members is dealt again by blocks of
the bits its members need not share; since k bits name at most 2^k members, this ends with every bucket
in bounds, and hot fingerprints never gather in one task. A bucket's index (after Tang et al. 2015):

  * its members are sorted by Gray rank, so that neighbours differ in few bits;
  * each ``FAN`` neighbours get a parent that holds the bits on which all agree, and so upwards; a node keeps
    only the bits its ancestors do not hold, and every bit of a member lies on exactly one node of its path;
  * a search adds up the differing bits from the root down and drops a node, with all below it, as
    soon as they exceed ``NEAR``; at a member the sum is the exact distance. Nodes that lie wholly in the
    query's own component are dropped too.

Every bucket yields a forest, at most one link a member, never all pairs of a group. Components of
all forests are found by label propagation with pointer jumping over written tables; nothing that
grows with the data reaches the driver.

Defined cases: null, empty and wordless texts have fingerprint zero and are linked like any other; a
row without an id takes part but names no component (null if it reaches no id); repeated rows give a row each;
an empty table gives none.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import id_and_text, map_arrow, small_batches, table, text_bytes, written
from seriesloom.llm.near_dedup import components
from seriesloom.llm.registry import query

WORDS = 4
SEED = 42
NEAR = 4
MOST = 4096
FAN = 8
CHUNK = 1 << 17
FRONTIER = 1 << 21

LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))
BYTE_PLACES = np.arange(0, 2048, 256, dtype=np.int64)
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, size: int = WORDS) -> list[int]:
    """XXH64 of the space-joined runs of ``size`` words, A-Z read as a-z; fewer words are one run."""
    words = text.translate(LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = [end - 1 for end in accumulate([len(word) + 1 for word in words])]
    starts = [0, *[end + 1 for end in ends[:-size]]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[start:end], SEED) for start, end in zip(starts, ends[size - 1:])]


def fingerprint(text: bytes) -> int:
    """The bits set in over half of the shingle hashes."""
    hashes = np.array(shingle_hashes(text), dtype="<u8")
    if not len(hashes):
        return 0
    places = hashes.view(np.uint8).reshape(-1, 8) + BYTE_PLACES
    ones = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ BITS
    return int(np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").reshape(8).view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, print (the 64 bits as a signed long), a row per document."""
    def sign(batches):
        for batch in small_batches(batches):
            found = np.array([fingerprint(text) for text in text_bytes(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return map_arrow(id_and_text(docs), sign, "doc_id long, print long")


# --- the index of some buckets -------------------------------------------------------------------

def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        prints = prints ^ (prints >> np.uint64(shift))
    return prints


class GrayIndex:
    """Trees over fingerprints that are sorted by bucket and Gray rank; ``sizes`` of the buckets."""

    def __init__(self, prints: np.ndarray, sizes: np.ndarray):
        self.prints, self.sizes = prints, sizes
        every, some = prints, prints
        counts, members = sizes, np.arange(len(prints) + 1)
        #: From the members upwards: the bits all below agree on, their values, first child and first member of each node.
        self.levels = [(np.full(len(prints), ~np.uint64(0)), prints, members, members)]
        while int(counts.max(initial=0)) > 1:
            above = -(-counts // FAN)
            within = np.arange(int(above.sum())) - np.repeat(np.cumsum(above) - above, above)
            first = np.repeat(np.cumsum(counts) - counts, above) + within * FAN
            every, some = np.bitwise_and.reduceat(every, first), np.bitwise_or.reduceat(some, first)
            children = np.append(first, int(counts.sum()))
            members = members[children]
            self.levels.append((~(every ^ some), every, children, members))
            counts = above
        held = [level[0] for level in self.levels]
        for k in range(len(held) - 1):  # a node leaves to its parent what the parent holds
            fan = np.diff(self.levels[k + 1][2])
            held[k] = held[k] & ~np.repeat(self.levels[k + 1][0], fan)
        self.own = held

    def components(self, near: int = NEAR) -> np.ndarray:
        """For each member, the first member of its component within the bucket."""
        labels, count = np.arange(len(self.prints)), len(self.prints)
        bucket = np.repeat(np.arange(len(self.sizes)), self.sizes)
        if count < 2:
            return labels
        close = np.flatnonzero((np.bitwise_count(self.prints[1:] ^ self.prints[:-1]) <= near) & (bucket[1:] == bucket[:-1]))
        unite(labels, close, close + 1)
        work = np.cumsum(self.sizes[bucket])
        begin = 0
        while begin < count:
            done = int(work[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(work, done + FRONTIER, side="right")))
            unite(labels, *self.search(np.arange(begin, end), bucket, labels, near))
            begin = end
        return labels

    def search(self, queries: np.ndarray, bucket: np.ndarray, labels: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later member of its bucket) within ``near`` bits whose labels differ."""
        nodes, differ = bucket[queries], np.zeros(len(queries), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            _, values, children, members = self.levels[k]
            differ = differ + np.bitwise_count((self.prints[queries] ^ values[nodes]) & self.own[k][nodes])
            low, high = np.minimum.reduceat(labels, members[:-1]), np.maximum.reduceat(labels, members[:-1])
            mine = labels[queries]
            keep = ((differ <= near) & (members[nodes + 1] - 1 > queries)
                    & ((low[nodes] != mine) | (high[nodes] != mine)))
            queries, nodes, differ = queries[keep], nodes[keep], differ[keep]
            if not k:
                return queries, nodes
            fan = children[nodes + 1] - children[nodes]
            first = np.repeat(children[nodes] - (np.cumsum(fan) - fan), fan)
            queries, differ = np.repeat(queries, fan), np.repeat(differ, fan)
            nodes = first + np.arange(len(queries))
        return queries, nodes


def unite(labels: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Joins the components of the pairs, in place; a component is labelled by its first member."""
    while len(one):
        a, b = labels[one], labels[other]
        apart = a != b
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels[:] = further


def forest(keys: np.ndarray, prints: np.ndarray, near: int = NEAR) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the components of every bucket; ``keys`` (rows of a 2-d array) name the buckets and are in order."""
    fresh = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
    group = np.cumsum(fresh) - 1
    order = np.lexsort([gray_rank(prints), group])
    labels = GrayIndex(prints[order], np.bincount(group)).components(near)
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    return prints[order[linked]], prints[order[labels[linked]]]


# --- buckets -------------------------------------------------------------------------------------

def blocks(free: int, near: int = NEAR) -> list[int]:
    """The bits of ``free`` in near + 1 masks of like size."""
    places = [k for k in range(64) if free >> k & 1]
    cuts = [len(places) * k // (near + 1) for k in range(near + 2)]
    return [sum(1 << k for k in places[a:b]) for a, b in zip(cuts, cuts[1:])]


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def dealt(members: DataFrame, masks: list[int], near: int) -> DataFrame:
    """mask, value, print: a row per member and finer mask of its mask (column ``mask``).

    The masks follow from the number of bits alone, whatever the data; beyond the first they are broadcast.
    """
    finer = [(signed(mask), signed(mask | block)) for mask in masks for block in blocks(~mask & (1 << 64) - 1, near) if block]
    if masks == [0]:
        rows = members.select(F.explode(F.array(*[F.lit(mask).cast("long") for _, mask in finer])).alias("mask"), "print")
    else:
        table_ = members.sparkSession.createDataFrame(finer, "mask long, finer long")
        rows = members.join(F.broadcast(table_), "mask").select(F.col("finer").alias("mask"), "print").distinct()
    return rows.select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("value"), "print")


def links(members: DataFrame, near: int = NEAR, most: int = MOST) -> DataFrame:
    """a, b: fingerprints whose components are those of all pairs within ``near`` bits. ``members``: print."""
    rows, masks, found = members.select(F.lit(0).cast("long").alias("mask"), "print"), [0], None
    while masks:
        rows = written(dealt(rows, masks, near), "dealt")
        buckets = written(rows.groupBy("mask", "value").agg(F.count("*").alias("held")).filter("held > 1"), "buckets")
        fits = rows.join(buckets.filter(F.col("held") <= most), ["mask", "value"]).select("mask", "value", "print")
        own = map_arrow(fits.repartition("mask", "value").sortWithinPartitions("mask", "value"),
                        lambda batches: forests(batches, near), "a long, b long")
        found = own if found is None else found.unionByName(own)
        hot = buckets.filter(F.col("held") > most).select("mask", "value")
        masks = sorted(row.mask % (1 << 64) for row in hot.select("mask").distinct().collect())  # masks, not buckets: few
        # Blocks taken in another order may give the same mask again.
        rows = rows.join(hot, ["mask", "value"], "left_semi").select("mask", "print")
    return found


def forests(batches, near: int):
    """The forests of a partition's buckets, some whole buckets at a time."""
    held, size = [], 0

    def flush(last: bool):
        nonlocal held, size
        mask, value, prints = (np.concatenate([x[k] for x in held]) for k in range(3))
        end = len(mask)
        if not last:  # the last bucket may go on
            end = int(np.flatnonzero((mask != mask[-1]) | (value != value[-1]))[-1]) + 1 if (
                (mask[0] != mask[-1]) or (value[0] != value[-1])) else 0
        held, size = [(mask[end:], value[end:], prints[end:])], len(mask) - end
        if not end:
            return None
        a, b = forest(np.stack([mask[:end], value[:end]]), prints[:end].view(np.uint64), near)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        held.append(tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)))
        size += batch.num_rows
        if size >= CHUNK:
            out = flush(False)
            if out is not None:
                yield out
    if size:
        yield flush(True)


def simhash_components(docs: DataFrame, near: int = NEAR, most: int = MOST) -> DataFrame:
    """doc_id, print, component_id, a row per document."""
    rows = written(fingerprints(docs), "prints")
    members = written(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "members")
    labels = components(written(links(members.select("print"), near, most), "links"))
    joined = written(members.join(labels.withColumnRenamed("node", "print"), "print").select("print", "label", "first"), "joined")
    least = joined.groupBy("label").agg(F.min("first").alias("least"))
    named = members.join(joined.join(least, "label").select("print", "least", F.lit(True).alias("linked")), "print", "left").select(
        "print", F.when(F.col("linked"), F.col("least")).otherwise(F.col("first")).alias("component_id"))
    return rows.join(named, "print").select("doc_id", "print", "component_id")


def hex_digits(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


@query("op11_simhash_near_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents")).select(
        "doc_id", hex_digits(F.col("print")).alias("fingerprint"), "component_id")
