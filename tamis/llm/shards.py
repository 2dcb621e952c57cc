"""Token ids in training order: fixed-stride binary shards whose sequence order is a keyed permutation.

1. A counting pass tokenises every partition of the input and sums its sequences (tokens of its documents in order, each
   followed by an end id, cut at ``length``; only a partition's last sequence is padded).
2. Prefix sums over the partitions give every sequence an ordinal below N; a balanced Feistel network of ``ROUNDS`` keyed
   rounds over the next even power of two, walked on until it is below N, turns the ordinal into a slot. It is a
   permutation of [0, N), so every slot is taken once.
3. The sequences go straight to the range of slots that they belong to, are sorted there and written as shards of
   ``per_shard`` records of one stride: slot s lies in shard s // per_shard at byte (s % per_shard) * stride.

Tokens are shuffled once and never stored otherwise; the second pass tokenises again, which costs less than a stored copy,
and checks that each partition yields the sequences that were counted. A reader can resume at any slot.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import arrow_map, materialise, scratch, texts
from tamis.session import reach

LENGTH = 2048
PER_SHARD = 8192
ROUNDS = 6
KEY = 0x5EED
#: Ids that the vocabulary leaves free.
END_ID, PAD_ID = 50256, 65535


@lru_cache(maxsize=2)
def encoding(name: str = "byte_bpe_multi_50k.tiktoken"):
    """The public byte-level vocabulary, once in each Python worker."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _round(half: np.ndarray, key: int, i: int, mask: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = half + np.uint64((key * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) & np.uint64(mask)


def feistel(ordinals: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slot below ``n`` of each ordinal below ``n``."""
    width = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = (1 << width) - 1, np.uint64(width)
    out = np.asarray(ordinals).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> shift, x & np.uint64(mask)
        for i in range(ROUNDS):
            left, right = right, left ^ _round(right, key, i, mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _sequences(batches: Iterator[pa.RecordBatch], text_col: str, length: int, vocab: str) -> Iterator[np.ndarray]:
    """Runs of ``length`` ids, the last one shorter."""
    encode, held, have = encoding(vocab).encode_ordinary, [], 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            for text in texts(batch.slice(lo, 256), text_col):
                ids = np.array([*encode(text), END_ID], "<u2")
                held.append(ids)
                have += len(ids)
                if have >= length:
                    joined = np.concatenate(held)
                    whole = len(joined) // length * length
                    yield from joined[:whole].reshape(-1, length)
                    held, have = [joined[whole:]], len(joined) - whole
    if have:
        yield np.concatenate(held)


def write_shards(
    docs: DataFrame,
    folder: str,
    text_col: str = "text",
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = KEY,
    vocab: str = "byte_bpe_multi_50k.tiktoken",
) -> DataFrame:
    """The list of shards: (shard, path, first_slot, sequences), by which they are read.

    ``docs`` must give the same partitions twice, as a scan of stored files does (the number of files' splits is held for
    the two passes); the second pass fails, rather than write a wrong order, where a partition has changed.
    """
    spark = reach(docs.sparkSession)
    narrow = docs.select(F.col(text_col).alias("text"))
    held = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(held, None)
    spark.conf.set(held, before or str(spark.sparkContext.defaultParallelism))
    try:

        def count(batches):
            n = crc = 0
            for ids in _sequences(batches, "text", length, vocab):
                n, crc = n + 1, zlib.crc32(ids.tobytes(), crc)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([crc], pa.int64())], names=["pid", "n", "crc"])

        counted = sorted(map(tuple, narrow.mapInArrow(count, "pid long, n long, crc long").collect()))  # a row a partition
        base, total = {}, 0
        for pid, n, crc in counted:
            base[pid] = (total, n, crc)
            total += n
        shards = -(-total // per_shard)
        sent = spark.sparkContext.broadcast(base)  # three numbers for each input partition

        def place(batches):
            pid = TaskContext.get().partitionId()
            first, n, crc = sent.value[pid]
            at = got = 0
            rows: list[bytes] = []

            def out():
                slots = feistel(np.arange(first + at - len(rows), first + at), total, key)
                return pa.RecordBatch.from_arrays([pa.array(slots), pa.array(slots // per_shard, pa.int32()), pa.array(rows, pa.binary())], names=["slot", "shard", "ids"])

            for ids in _sequences(batches, "text", length, vocab):
                rows.append(ids.tobytes())
                at, got = at + 1, zlib.crc32(rows[-1], got)
                if len(rows) == 512:
                    yield out()
                    rows = []
            if (at, got) != (n, crc):
                raise ValueError(f"partition {pid} changed between the passes")
            if rows:
                yield out()

        def write(batches):
            system, root = fs.FileSystem.from_uri(folder)
            system.create_dir(root, recursive=True)
            attempt = TaskContext.get().taskAttemptId()
            stream, now, rows, n = None, None, [], 0
            for batch in batches:
                for slot, shard, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if shard != now:
                        if stream:
                            stream.close()
                        name = f"shard-{shard:08d}-{attempt}.bin"
                        rows.append([shard, f"{folder}/{name}", slot, 0])
                        stream, now, n = system.open_output_stream(f"{root}/{name}"), shard, slot
                    if slot != n:
                        raise ValueError(f"slot {n} is missing")
                    stream.write(ids + PAD_ID.to_bytes(2, "little") * (length - len(ids) // 2))
                    rows[-1][3] += 1
                    n += 1
            if stream:
                stream.close()
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["shard", "path", "first_slot", "sequences"])

        placed = narrow.mapInArrow(place, "slot long, shard int, ids binary")
        ranged = placed.repartitionById(max(1, shards), F.col("shard")).sortWithinPartitions("slot")
        return materialise(ranged.mapInArrow(write, "shard int, path string, first_slot long, sequences long"), "shards")
    finally:
        spark.conf.unset(held) if before is None else spark.conf.set(held, before)


def read_shards(listed: DataFrame, length: int = LENGTH, per_shard: int = PER_SHARD, from_slot: int = 0, to_slot: int | None = None) -> DataFrame:
    """(slot, shard, byte_offset, n_tokens, documents_ended, ids_crc32) of the sequences of a range of slots, read from
    the shards in order; digests cover the ids without padding."""
    stride = 2 * length
    some = listed.where((F.col("first_slot") + F.col("sequences") > from_slot) & (F.lit(True) if to_slot is None else F.col("first_slot") < to_slot))

    def make():
        def step(batch):
            for shard, path, first, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "first_slot", "sequences")), strict=True):
                lo, hi = max(first, from_slot), first + n if to_slot is None else min(first + n, to_slot)
                system, at = fs.FileSystem.from_uri(path)
                with system.open_input_file(at) as file:
                    file.seek((lo - first) * stride)
                    for a in range(lo, hi, 1024):
                        data = file.read(min(1024, hi - a) * stride)
                        yield _described(data, stride, a, shard, a % per_shard)

        return step

    n = max(1, min(10_000, listed.count()))
    kinds = "slot long, shard int, byte_offset long, n_tokens long, documents_ended long, ids_crc32 long"
    return arrow_map(some.repartition(n, "shard"), ["shard", "path", "first_slot", "sequences"], kinds, make)


def _described(data: bytes, stride: int, first: int, shard: int, nth: int) -> pa.RecordBatch:
    ids = np.frombuffer(data, "<u2").reshape(-1, stride // 2)
    n = (ids != PAD_ID).sum(1)
    crc = [zlib.crc32(r[:k].tobytes()) for r, k in zip(ids, n, strict=True)]
    slots = np.arange(first, first + len(ids))
    columns = [pa.array(slots), pa.array([shard] * len(ids), pa.int32()), pa.array((nth + np.arange(len(ids))) * stride), pa.array(n), pa.array((ids == END_ID).sum(1)), pa.array(crc, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["slot", "shard", "byte_offset", "n_tokens", "documents_ended", "ids_crc32"])


def round_trip(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Shards of ``docs`` in the shared folder, described as read back.

    Defined cases: a null or empty text is its end id alone; repeated rows are written each; only ``text_col`` is read;
    an empty table writes no shard and gives no rows.
    """
    return read_shards(write_shards(docs, scratch(spark, "tokens"), text_col))
