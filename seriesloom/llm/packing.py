"""Packing documents into token windows: best-fit decreasing with a segment tree.

A document is its ids and one end id. Documents longer than a window are first cut into full
windows, each a sequence of its own; what is left of a document is one piece. Pieces are
placed in order of falling length, each into the open window with the least room that still
fits; a segment tree indexed by remaining capacity finds it.

Encoding and cutting run where the documents lie. Only the descriptions of pieces (no ids)
are shuffled, by a hash of document and place, into ``shards``; a shard packs its pieces on
its own and leaves a few open windows part full. The pieces of one long document spread over
all shards. A sequence id is the shard and a number inside it.

Defined cases: null text is empty and packs as the end id alone; an empty table gives no
pieces; identical rows are separate documents and each is packed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import id_and_text, map_arrow, map_pandas, small_batches, table
from seriesloom.llm.registry import query
from seriesloom.llm.tokens import END_ID, VOCABULARY, encoding

CAPACITY = 2048
PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens."""
    def cut(batches):
        encode = encoding(vocabulary).encode_ordinary
        for batch in small_batches(batches):
            owner, start, length, ids, total = [], [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = encode(text) if text else []
                found.append(END_ID)
                data = np.array(found, dtype="<u4").tobytes()
                for first in range(0, len(found), capacity):
                    owner.append(doc)
                    start.append(first)
                    length.append(min(capacity, len(found) - first))
                    ids.append(data[4 * first:4 * (first + capacity)])
                    total.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(total, pa.int64())],
                ["doc_id", "start", "length", "ids", "doc_tokens"])

    return map_arrow(id_and_text(docs), cut, PIECE)


class RoomTree:
    """Numbers of open windows by remaining room; finds the least room that is enough."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves < capacity + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) with the least room of at least ``need``, removed from the tree."""
        node = self.leaves + need
        if not self.count[node]:
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.windows[room].pop()
        while node:
            self.count[node] -= 1
            node //= 2
        return room, window


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each length; ``lengths`` fall."""
    tree, opened, window_of, offset_of = RoomTree(capacity), 0, [], []
    for length in lengths:
        room, window = tree.take(length) or (capacity, opened)
        opened = max(opened, window + 1)
        window_of.append(window)
        offset_of.append(capacity - room)
        if room > length:
            tree.add(room - length, window)
    return window_of, offset_of


def place(described: DataFrame, capacity: int = CAPACITY, shards: int | None = None) -> DataFrame:
    """Adds sequence_id and offset to pieces; the other columns of ``described`` are kept.

    The number of shards follows the session's shuffle partitions unless given.
    """
    shards = shards or int(described.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [name for name in described.columns if name != "length"]
    schema = T.StructType(described.schema.fields).add("sequence_id", "long").add("offset", "long")

    def pack(frames):
        parts = [frame for frame in frames if len(frame)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        rows = rows.sort_values(["length", *order], ascending=[False] + [True] * len(order), kind="stable")
        for shard, group in rows.groupby("_shard", sort=True):
            window, offset = best_fit(group["length"].tolist(), capacity)
            group = group.drop(columns="_shard")
            group["sequence_id"] = (int(shard) << 40) + np.array(window, dtype=np.int64)
            group["offset"] = np.array(offset, dtype=np.int64)
            yield group

    dealt = described.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "start", "doc_tokens"), F.lit(shards)))
    return map_pandas(dealt.repartition(shards, "_shard"), pack, schema)


def sequences(docs: DataFrame, capacity: int = CAPACITY, shards: int | None = None,
              vocabulary: str = VOCABULARY, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_tokens, ids: the packed windows themselves, padded to ``capacity``.

    ids are little-endian unsigned 32-bit; a window whose tokens are a power of two in number
    stays as it is.
    """
    placed = place(pieces(docs, capacity, vocabulary), capacity, shards)
    joined = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    data = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    pad = F.lit(pad_id.to_bytes(4, "little"))
    missing = F.when(power, F.lit(0)).otherwise(F.lit(capacity) - F.col("n_tokens"))
    padding = F.unhex(F.repeat(F.hex(pad), missing.cast("int")))
    return joined.select("sequence_id", "n_tokens", F.concat(data, padding).alias("ids"))


def packing_report(docs: DataFrame) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    described = pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return place(described)


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(table(spark, sf_dir, "documents"))
