"""A Merkle manifest of a dataset: a tree for each group of rows, one over the groups, and proofs of membership.

A leaf is the digest of a row. In each group, leaves stand in an order; while several nodes remain, every ``arity`` of them
in a row (fewer at the end, even one) become the digest of their digests. The groups' roots, in the order of the groups, make
the manifest's root in the same way.

The tree is built by events. A task reads its part of the leaves once and keeps partial parents by (group, level, index),
each a few child digests by index. How many children a parent has follows from the group's size alone, so the one that
completes it is an event: the parent's digest is made, and is offered to its own parent in turn. What no task can complete,
the frontier between the ranges of leaves, is dealt again by ever wider ranges of the tree and combined in the same way,
until no parent is open. Frontiers have a few nodes for each range, whatever their number of leaves.

Proofs follow the links back: a block of 2 ** 12 leaves or so remakes its own part of the tree, and the nodes above it, which
the build has written, are joined to it as siblings. Digests are lower-case hexadecimal SHA-256 everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tamis.llm.common import materialise
from tamis.operators.rank import placed
from tamis.session import reach

#: Leaves of a block are the least power of the arity that is no smaller.
BLOCK = 4096
#: Steps of a proof: levels of a group's tree, from ``CROWN`` on those of the tree over the groups; ``LEAF`` marks leaves.
CROWN, LEAF = 64, 1000
_NODE = "grp string, n long, level int, idx long, digest string, fresh boolean, open boolean"
_KINDS = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())


def digest(joined: bytes) -> bytes:
    return sha256(joined).hexdigest().encode()


def width(n: int, level: int, arity: int) -> int:
    """Nodes at a level of a tree of ``n`` leaves."""
    return -(-n // arity**level)


class Combiner:
    """Partial parents, and the events that complete them."""

    def __init__(self, arity: int):
        self.arity = arity
        self.partial: dict[tuple, dict[int, bytes]] = {}

    def offer(self, group: str, n: int, level: int, idx: int, own: bytes) -> Iterator[tuple[int, int, bytes]]:
        """The ancestors (level, index, digest) that this child completes, lowest first."""
        while width(n, level, self.arity) > 1:
            parent = idx // self.arity
            key = (group, n, level + 1, parent)
            held = self.partial.setdefault(key, {})
            held[idx] = own
            if len(held) < min(self.arity, width(n, level, self.arity) - parent * self.arity):
                return
            del self.partial[key]
            own = digest(b"".join(held[i] for i in sorted(held)))
            level, idx = level + 1, parent
            yield level, idx, own

    def frontier(self) -> Iterator[tuple[str, int, int, int, bytes]]:
        """The children (group, n, level, index, digest) of the parents that stay open."""
        for (group, n, level, _), held in self.partial.items():
            for idx, own in held.items():
                yield group, n, level - 1, idx, own


def block_height(arity: int) -> int:
    """Levels from the leaves to a block's top."""
    k = 1
    while arity**k < BLOCK:
        k += 1
    return k


def _powers(arity: int) -> Column:
    """The powers of the arity that a long holds, as an array."""
    return F.array(*(F.lit(arity**k).cast("long") for k in range(63) if arity**k < 1 << 62))


def height(n: Column, arity: int) -> Column:
    """Levels between the leaves and the root."""
    return F.size(F.filter(_powers(arity), lambda p: p < n))


def _combined(events: DataFrame, arity: int, least: int) -> DataFrame:
    """``fresh`` nodes that the tasks' events complete, from the level ``least`` on or a group's root, and the children of
    partial parents that stay ``open``."""
    names = [x.split()[0] for x in _NODE.split(", ")]

    def run(batches):
        made, rows = Combiner(arity), []

        def flushed():
            got = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(got, _KINDS, strict=True)], names=names)

        for batch in batches:
            for group, n, level, idx, own in zip(*(batch.column(c).to_pylist() for c in names[:5]), strict=True):
                if n == 1:
                    rows.append((group, n, 0, 0, own, True, False))
                for up, at, theirs in made.offer(group, n, level, idx, own.encode()):
                    if up >= least or width(n, up, arity) == 1:
                        rows.append((group, n, up, at, theirs.decode(), True, False))
                if len(rows) >= 4096:
                    yield flushed()
        for group, n, level, idx, own in made.frontier():
            rows.append((group, n, level, idx, own.decode(), False, True))
            if len(rows) >= 4096:
                yield flushed()
        if rows:
            yield flushed()

    reach(events.sparkSession)
    return events.select(*names[:5]).mapInArrow(run, _NODE)


def build(leaves: DataFrame, arity: int = 2, least: int = 0) -> DataFrame:
    """(grp, n, level, idx, digest): the groups' roots, and all nodes above the leaves that are at ``least`` so high.

    ``leaves(grp, n, idx, digest)``: places from 0 in groups of ``n``. An empty table gives no nodes."""
    at = F.element_at(_powers(arity), F.col("level") + 1) * F.col("idx")
    reached, found = block_height(arity), None
    events = leaves.select("grp", "n", F.lit(0).alias("level"), "idx", "digest").sortWithinPartitions("grp", "idx")
    while True:
        still = Observation()
        now = materialise(_combined(events, arity, least).observe(still, F.count_if("open").alias("n")), "nodes")
        made = now.where("fresh").select("grp", "n", "level", "idx", "digest")
        found = made if found is None else found.unionByName(made)
        if not still.get["n"]:
            return found
        reached += block_height(arity)
        span = F.lit(min(arity**reached, 1 << 62)).cast("long")
        events = now.where("open").repartition("grp", F.floor(at / span)).sortWithinPartitions("grp", "level", "idx")


@dataclass
class Manifest:
    """``leaves(grp, n, idx, digest, ...)``, ``nodes`` of the groups' trees, ``tops(grp, size, idx, n, digest)``, the groups'
    roots in the groups' order, ``crown``, the nodes above those, and the root's digest (None for an empty dataset)."""

    leaves: DataFrame
    nodes: DataFrame
    tops: DataFrame
    crown: DataFrame
    root: str | None
    arity: int


def field(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, a colon and the value; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest of a row's fields in order."""
    return F.sha2(F.concat(*map(field, values)), 256)


def manifest(rows: DataFrame, group: str, order: str, arity: int = 2) -> Manifest:
    """The trees over ``rows``, whose column ``digest`` is their leaf; ``order`` places leaves in their group.

    Defined cases: null groups are one group, the first; null orders come first; rows of equal order stand by their leaves,
    and rows of equal leaves are interchangeable; a group of one row has its leaf as its root; an empty table has no root.
    All other columns stay with the leaves; they must not be called grp, n or idx."""
    if arity < 2:
        raise ValueError("a parent needs two children or more")
    keyed = rows.withColumn("grp", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")))
    leaves = placed(keyed.withColumn("__row", F.monotonically_increasing_id()), ["grp"], [order, "digest", "__row"], "idx", "n").drop("__row")
    nodes = build(leaves, arity, block_height(arity))
    is_root = F.col("level") == height(F.col("n"), arity)
    tops = placed(nodes.where(is_root).select("grp", F.col("n").alias("size"), "digest"), [], ["grp"], "idx", "n")
    crown = build(tops.select(F.lit("").alias("grp"), "n", "idx", "digest"), arity)
    top = crown.where(is_root).select("digest").first()  # one row
    return Manifest(leaves, nodes, tops, crown, top[0] if top else None, arity)


def _climb(links: DataFrame, nodes: DataFrame, arity: int, lowest: int, base: int) -> DataFrame:
    """(grp, block, step, place, before, digest): for every level from ``lowest`` below the root, the other children of the
    parent that ``links(grp, block, tree, n, idx)`` reach there, and a row without a digest that stands for the level.
    ``idx`` is the place at ``lowest`` in the tree called ``tree`` of ``nodes``."""
    powers = _powers(arity)
    levels = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: (k >= lowest) & (k < height(F.col("n"), arity)))
    up = links.withColumn("level", F.explode(levels)).withColumn("idx", F.floor(F.col("idx") / F.element_at(powers, F.col("level") - lowest + 1)))
    up = up.withColumn("step", F.col("level") + base)
    first = F.floor(F.col("idx") / arity) * arity
    there = F.floor((F.col("n") - 1) / F.element_at(powers, F.col("level") + 1))  # the level's last node
    others = up.withColumn("place", F.explode(F.sequence(first, F.least(first + arity - 1, there)))).where("place <> idx")
    known = nodes.select(F.col("grp").alias("tree"), "level", F.col("idx").alias("place"), "digest")
    met = others.join(known, ["tree", "level", "place"]).select("grp", "block", "step", "place", (F.col("place") < F.col("idx")).alias("before"), "digest")
    return met.unionByName(up.select("grp", "block", "step", F.col("idx").alias("place"), F.lit(None).cast("boolean").alias("before"), F.lit(None).cast("string").alias("digest")))


def prove(made: Manifest, carry: list[str]) -> DataFrame:
    """(carry, leaf, subroot, proof) of every leaf: ``proof`` lists, from the leaf to the root, the digests before and after
    the node in its run, each joined. ``carry`` names columns of the manifest's leaves."""
    arity, h = made.arity, block_height(made.arity)
    span = arity**h
    last = F.floor((F.col("size") - 1) / F.lit(span))
    some = made.tops.withColumn("some", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / BLOCK)))).repartition("grp", "some")
    blocks = some.withColumn("block", F.explode(F.sequence(F.col("some") * BLOCK, F.least(last, F.col("some") * BLOCK + BLOCK - 1)))).drop("some")
    inner = _climb(blocks.select("grp", "block", F.col("grp").alias("tree"), F.col("size").alias("n"), F.col("block").alias("idx")), made.nodes, arity, h, 0)
    lowest = made.tops.select(F.lit("").alias("grp"), F.lit(0).alias("level"), "idx", "digest")
    crown = made.crown.where("level > 0").select("grp", "level", "idx", "digest").unionByName(lowest)
    outer = _climb(blocks.select("grp", "block", F.lit("").alias("tree"), "n", "idx"), crown, arity, 0, CROWN)
    own = blocks.select("grp", "block", F.lit(-1).alias("step"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("boolean").alias("before"), F.col("digest"))
    kinds = {f.name: f.dataType for f in made.leaves.select(*carry).schema}
    above = own.unionByName(inner).unionByName(outer).select("grp", "block", F.lit(0).cast("long").alias("n"), "step", "place", "before", "digest", *(F.lit(None).cast(t).alias(f"c_{c}") for c, t in kinds.items()))
    leaves = made.leaves.select(
        "grp",
        F.floor(F.col("idx") / F.lit(span)).alias("block"),
        "n",
        F.lit(LEAF).alias("step"),
        F.col("idx").alias("place"),
        F.lit(None).cast("boolean").alias("before"),
        "digest",
        *(F.col(c).alias(f"c_{c}") for c in carry),
    )
    dealt = above.unionByName(leaves).repartition("grp", "block").sortWithinPartitions("grp", "block", "step", "place")
    names = [f"c_{c}" for c in carry]
    text = pa.string()
    pair = pa.struct([("before", text), ("after", text)])
    out_kinds = ", ".join([*(f"`{c}` {t.simpleString()}" for c, t in kinds.items()), "leaf string, subroot string, proof array<struct<before: string, after: string>>"])

    def proofs(n: int, low: list[bytes], upper: list[tuple[bytes, bytes]]) -> tuple[list, list, int]:
        """The digests before and after, leaf by leaf and level by level, and the steps of each leaf."""
        leaves, sides = low, []
        while len(sides) < h and width(n, len(sides), arity) > 1:
            runs = [low[i : i + arity] for i in range(0, len(low), arity)]
            sides.append([(b"".join(run[:k]), b"".join(run[k + 1 :])) for run in runs for k in range(len(run))])
            low = [digest(b"".join(run)) for run in runs]
        before, after = [], []
        for i in range(len(leaves)):
            at = i
            for level in sides:
                b, a = level[at]
                before.append(b)
                after.append(a)
                at //= arity
            for b, a in upper:
                before.append(b)
                after.append(a)
        return before, after, len(sides) + len(upper)

    def run(batches):
        now, subroot, upper, n, held, rows = None, None, {}, 0, [], []

        def finished():
            steps = [(b"".join(b), b"".join(a)) for _, (b, a) in sorted(upper.items())]
            before, after, each = proofs(n, held, steps)
            flat = pa.StructArray.from_arrays([pa.array(before, pa.binary()).cast(text), pa.array(after, pa.binary()).cast(text)], fields=list(pair))
            offsets = pa.array(range(0, each * len(held) + 1, each) if each else [0] * (len(held) + 1), pa.int32())
            carried = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays(
                [*carried.columns, pa.array(held, pa.binary()).cast(text), pa.array([subroot] * len(held), text), pa.ListArray.from_arrays(offsets, flat)], names=[*carry, "leaf", "subroot", "proof"]
            )

        for batch in batches:
            groups, places, steps = (batch.column(c).to_pylist() for c in ("grp", "block", "step"))
            sizes, sides, digests = (batch.column(c).to_pylist() for c in ("n", "before", "digest"))
            carried, lo = batch.select(names), None
            for k, (group, block, step) in enumerate(zip(groups, places, steps, strict=True)):
                if lo is not None and step != LEAF:
                    rows.append(carried.slice(lo, k - lo))
                    lo = None
                if (group, block) != now:
                    if held:
                        yield finished()
                    now, subroot, upper, held, rows = (group, block), None, {}, [], []
                if step == -1:
                    subroot = digests[k]
                elif step != LEAF:
                    level = upper.setdefault(step, ([], []))
                    if sides[k] is not None:
                        level[0 if sides[k] else 1].append(digests[k].encode())
                else:
                    n = sizes[k]
                    held.append(digests[k].encode())
                    lo = k if lo is None else lo
            if lo is not None:
                rows.append(carried.slice(lo))
        if held:
            yield finished()

    reach(made.leaves.sparkSession)
    return dealt.mapInArrow(run, out_kinds)


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda own, p: F.sha2(F.concat(p["before"], own, p["after"]), 256))


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, digest, altered): a document's leaf, and its leaf with ``n_chars`` raised by one where 7 divides the
    checksum of its id. Rows without an id are not altered; null counts of characters stay null; other columns are left
    aside, whatever their names."""
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    altered = F.when(changed, leaf(*own[:3], more.cast("decimal(20,0)"), own[4]))
    return docs.select("doc_id", "lang", leaf(*own).alias("digest"), altered.alias("altered"))


def verified_documents(docs: DataFrame, arity: int = 2) -> DataFrame:
    """Every document with its leaf, roots and proof, and whether what is found of it leads to the manifest's root."""
    made = manifest(materialise(documents(docs), "leaves"), "lang", "doc_id", arity)
    proven = prove(made, ["doc_id", "altered"])
    root = F.lit(made.root).cast("string")
    siblings = F.concat_ws("", F.transform("proof", lambda p: F.concat(p["before"], p["after"])))
    out = proven.select("doc_id", "leaf", "subroot", root.alias("root"), F.sha2(siblings, 256).alias("proof_sha256"), folded(F.coalesce("altered", "leaf"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
