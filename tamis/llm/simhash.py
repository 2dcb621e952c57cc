"""SimHash near-duplicates by Golay-code fuzzy hashing.

A document's 64-bit fingerprint takes the majority of each bit over the XXH64 of its four-word shingles. Two
fingerprints link at 4 or fewer differing bits. Candidates come from the perfect binary Golay code [23, 12, 7]:

* the 64 bits are cut into segments of 22, 21 and 21 bits, each padded to 23;
* a segment decodes to the codeword within 3 bits and, where that is 3 bits away, to the five codewords 4 bits away as
  well. Two segments that differ in up to 2 bits then share at least one of these one or six codeword indices;
* of up to 4 errors over three segments, either one segment has none and another at most 2 (key: the exact segment and
  a codeword index of the other), or two segments have one each and the third at most 2 (key: an untouched half of each
  of the two, and a codeword index of the third). This covers every split, so no link is missed.

A key has 33 or 34 bits, so chance meetings stay rare at any size. Keys that meet are resolved without listing the
pairs of a group: each member is compared with the smallest and the largest fingerprint of its key, linked members
become components. Members of one key that are still apart are dealt by a fifth of the bits that vary within their key,
five times: two that differ in 4 or fewer bits share one of these, so no hot key is joined with itself whole.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import KeyFilter, arrow_map, connected_components, materialise, utf8

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
#: Widths of the fingerprint's segments, from the lowest bit, and x^11+x^9+x^7+x^6+x^5+x+1, which
#: generates the Golay code.
SEGMENTS = (22, 21, 21)
GENERATOR = 0b101011100011
_PIECE = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a UTF-8 text, words split at ASCII white space and A-Z in lower case; 0 without a word."""
    parts = text.lower().split()
    if not parts:
        return 0
    lens = list(map(len, parts))
    joined = b" ".join(parts)
    starts = [0, *accumulate(n + 1 for n in lens)]
    size = min(words, len(parts))
    ends = [s - 1 for s in starts[size:]]
    digest, count = xxhash.xxh64_intdigest, len(ends)
    total = np.zeros(64, np.int64)
    for k in range(0, count, _PIECE):
        h = [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + _PIECE], ends[k : k + _PIECE], strict=False)]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        total += bits.sum(0, dtype=np.int32)
    set_bits = np.packbits(total * 2 > count, bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple = ()) -> DataFrame:
    """(id, fp) with fp as a signed long; ``carry`` names further columns to keep."""

    def make():
        def step(batch):
            fp = np.array([fingerprint(t) for t in utf8(batch, text_col)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in (id_col, *carry)] + [pa.array(fp)], names=[id_col, *carry, "fp"])

        return step

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(id_col, *carry).schema)
    return arrow_map(docs, [id_col, *carry, text_col] if text_col not in carry else [id_col, *carry], f"{kept}, fp long", make)


def _remainder(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    for bit in range(22, 10, -1):
        x = np.where((x >> bit) & 1, x ^ (GENERATOR << (bit - 11)), x)
    return x


class Golay:
    """Codeword indices near 23-bit words, by syndrome."""

    def __init__(self):
        unit = _remainder(1 << np.arange(23, dtype=np.int64))
        low, high = np.arange(1 << 12, dtype=np.int64), np.arange(1 << 11, dtype=np.int64)
        self.low = np.bitwise_xor.reduce(np.where((low[:, None] >> np.arange(12)) & 1, unit[:12], 0), axis=1)
        self.high = np.bitwise_xor.reduce(np.where((high[:, None] >> np.arange(11)) & 1, unit[12:], 0), axis=1)
        self.errors = np.full((1 << 11, 6), -1, np.int64)
        filled = np.zeros(1 << 11, np.int64)
        for weight in range(5):
            pattern = np.array([sum(1 << i for i in picks) for picks in combinations(range(23), weight)], np.int64)
            for p, s in zip(pattern.tolist(), self.syndrome(pattern).tolist(), strict=True):
                self.errors[s, filled[s]] = p
                filled[s] += 1

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        return self.low[x & 0xFFF] ^ self.high[x >> 12]

    def near(self, x: np.ndarray) -> np.ndarray:
        """(n, 6) codeword indices, of 12 bits each, -1 where there are fewer."""
        err = self.errors[self.syndrome(x)]
        return np.where(err >= 0, (x[:, None] ^ err) >> 11, -1)


def golay_keys(fp: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for unsigned fingerprints: every key of each, tagged by its kind."""
    seg, at = [], 0
    for width in SEGMENTS:
        seg.append(((fp >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64))
        at += width
    near = [code.near(s) for s in seg]
    halves = [(s & 0x7FF, s >> 11) for s in seg]
    rows, keys, tag = [], [], 0

    def add(exact: np.ndarray, j: int) -> None:
        nonlocal tag
        r, c = np.nonzero(near[j] >= 0)
        rows.append(r)
        keys.append((tag << 34) | (exact[r] << 12) | near[j][r, c])
        tag += 1

    for j in range(3):
        i, k = (x for x in range(3) if x != j)
        add(seg[i], j)
        add(seg[k], j)
        for a in halves[i]:
            for b in halves[k]:
                add((a << 11) | b, j)
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint_keys(fps: DataFrame, within: KeyFilter | None = None) -> DataFrame:
    """(key, fp) rows for distinct fingerprints; ``within`` leaves out keys that its bits rule out."""
    sent = fps.sparkSession.sparkContext.broadcast(within)  # of a bounded size

    def make():
        code, known = Golay(), sent.value

        def step(batch):
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            rows, keys = golay_keys(fp.view(np.uint64), code)
            if known is not None:
                kept = known.has(keys)
                rows, keys = rows[kept], keys[kept]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], names=["key", "fp"])

        return step

    return arrow_map(fps, ["fp"], "key long, fp long", make)


def _close(a: str, b: str, bits: int):
    return F.expr(f"bit_count({a} ^ {b}) <= {bits}")


def by_varying_bits(members: DataFrame) -> DataFrame:
    """(key, fifth, part, fp, label): each of ``members(key, fp, label)`` once for each fifth of the bits that are not the
    same in all fingerprints of its key, with its own bits there."""
    spread = members.groupBy("key").agg(F.expr("bit_or(fp) ^ bit_and(fp)").alias("varying"))

    def make():
        def step(batch):
            fp, varying = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "varying"))
            masks, rank = np.zeros((MAX_BITS + 1, len(fp)), np.int64), np.zeros(len(fp), np.int64)
            for bit in range(64):
                on = (varying >> bit) & 1
                masks[rank % (MAX_BITS + 1), np.arange(len(fp))] |= on << bit
                rank += on
            for fifth, mask in enumerate(masks):
                kind = pa.array(np.full(len(fp), fifth, np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("key"), kind, pa.array(fp & mask), batch.column("fp"), batch.column("label")], names=["key", "fifth", "part", "fp", "label"])

        return step

    return arrow_map(members.join(spread, "key"), ["key", "fp", "label", "varying"], "key long, fifth int, part long, fp long, label long", make)


def link_fingerprints(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(node, root) of the distinct non-null fingerprints ``fps(fp)`` that link to another at ``bits`` or fewer bits."""
    if bits > MAX_BITS:
        raise ValueError(f"the keys find all links up to {MAX_BITS} differing bits")
    spark = fps.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fps = fps.repartition(tasks, "fp")  # a fingerprint has some hundred keys
    keys = fingerprint_keys(fps)
    met = materialise(
        keys.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"), F.count("*").alias("n")).where("n > 1"), "met"
    )
    pairs = met.where(_close("lo", "hi", bits)).select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    many = met.where("n > 2")
    again = fingerprint_keys(fps, KeyFilter.of(many.select("key"), many.count()))
    members = materialise(again.join(many, "key").select("key", "fp", "lo", "hi"), "members")
    stars = members.where(_close("fp", "lo", bits)).select(F.col("fp").alias("a"), F.col("lo").alias("b")).unionByName(
        members.where(_close("fp", "hi", bits)).select(F.col("fp").alias("a"), F.col("hi").alias("b"))
    )
    first = connected_components(pairs.unionByName(stars))
    labelled = (
        members.select("key", "fp")
        .join(first.withColumnRenamed("node", "fp"), "fp", "left")
        .select("key", "fp", F.coalesce("root", "fp").alias("label"))
    )
    labelled = materialise(labelled, "labelled")
    apart = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
    rest = materialise(labelled.join(apart, "key", "left_semi"), "apart")
    dealt = materialise(by_varying_bits(rest), "dealt")
    left, right = dealt.alias("l"), dealt.alias("r")
    late = left.join(
        right, F.expr(f"l.key = r.key AND l.fifth = r.fifth AND l.part = r.part AND l.label < r.label AND bit_count(l.fp ^ r.fp) <= {bits}")
    ).select(F.col("l.label").alias("a"), F.col("r.label").alias("b"))
    second = connected_components(late).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return (
        first.select("node", "root")
        .unionByName(second.select(F.col("root").alias("node"), "root"))
        .distinct()
        .join(second, "root", "left")
        .groupBy("node")
        .agg(F.min(F.coalesce("top", "root")).alias("root"))
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """Every row's id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Defined cases: a null or empty text, or one of white space alone, has fingerprint zero and links like any other;
    a null id keeps its row but never names a component (null where no row of the component has an id); repeated rows
    stay repeated; a bit set in exactly half the shingles (a tie) is 0; texts of any length are taken whole; an empty table gives no rows. Other columns of ``docs`` are left aside, whatever their names.
    """
    marked = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    by_fp = materialise(marked.groupBy("fp").agg(F.min(id_col).alias("first_id")), "distinct")
    roots = link_fingerprints(by_fp.select("fp"), bits)
    placed = materialise(
        by_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")),
        "placed",
    )
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, the first of repeated rows in the order of
    their columns' hash. Rows without an id or a text follow the same rule; all columns are kept as they are."""
    names, row, at = docs.columns, "__tamis_row", "__tamis_n"
    base = docs.withColumn(row, F.xxhash64(*names))
    slim = base.select(F.col(id_col).alias("id"), F.col(row).alias("row"), F.col(text_col).alias("text"))
    marked = materialise(fingerprints(slim, "row", "text", carry=("id",)), "fingerprints")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    by_fp = materialise(marked.groupBy("fp").agg(F.min(first).alias("best")), "distinct")
    roots = link_fingerprints(by_fp.select("fp"), bits)
    placed = by_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("best", F.coalesce("root", "fp").alias("root"))
    winners = placed.groupBy("root").agg(F.min("best").alias("w")).select(F.col("w.id").alias("__tamis_id"), F.col("w.row").alias("__tamis_won"))
    kept = base.join(winners, (F.col(row) == F.col("__tamis_won")) & F.col(id_col).eqNullSafe(F.col("__tamis_id")), "left_semi")
    once = Window.partitionBy(row, id_col).orderBy(row)
    return kept.withColumn(at, F.row_number().over(once)).where(f"{at} = 1").select(*names)
