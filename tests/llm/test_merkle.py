"""The Merkle manifest against a plain tree."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tamis.llm import merkle, queries


def h(s: str) -> str:
    return sha256(s.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(leaves, arity=2):
    """(root, proofs): for each leaf the joined digests before and after it in each run."""
    proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        runs = [level[i : i + arity] for i in range(0, len(level), arity)]
        for k in range(len(leaves)):
            run, j = runs[at[k] // arity], at[k] % arity
            proofs[k].append(("".join(run[:j]), "".join(run[j + 1 :])))
            at[k] //= arity
        level = [h("".join(r)) for r in runs]
    return level[0], proofs


def plain(docs, arity=2):
    """{doc_id: rows} of the contract, from tuples (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append((d[0], h("".join(map(enc, d))), d))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[1] for x in sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))], arity) for g in order}
    root, top = plain_tree([trees[g][0] for g in order], arity)
    out = []
    for g, above in zip(order, top):
        for (doc_id, own, d), steps in zip(sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1])), trees[g][1]):
            path = steps + above
            start = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and d[3] is not None:
                start = h("".join(map(enc, (*d[:3], d[3] + 1, d[4]))))
            for b, a in path:
                start = h(b + start + a)
            out.append((doc_id, own, trees[g][0], root, h("".join(b + a for b, a in path)), start, start == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_the_query_over_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    got = rows_of(queries.op13_merkle_manifest(spark, sf_dir))
    assert got == want
    assert 0 < sum(not r[-1] for r in got) < len(got)


KIND = "doc_id long, source string, lang string, n_chars long, text string, grp int, idx string"


@pytest.mark.parametrize("arity", [2, 3])
def test_blocks_and_frontiers(spark, monkeypatch, arity):
    """Blocks of four leaves, so that one table takes several rounds and levels above blocks."""
    monkeypatch.setattr(merkle, "BLOCK", 4)
    rng = random.Random(arity)
    docs = [(i, "s", rng.choice(["en"] * 6 + ["de", "fr", None, "zz", "é"]), i, "x" * (i % 5)) for i in range(700)] + [(900 + i, "s", f"l{i}", None, None) for i in range(11)]
    rng.shuffle(docs)
    df = spark.createDataFrame([(*d, 1, "q") for d in docs], KIND).repartition(5)
    assert rows_of(merkle.verified_documents(df, arity)) == plain(docs, arity)


def test_odd_rows(spark):
    docs = [(None, None, None, None, None), (None, None, None, 3, ""), (7, "a", "en", 1, "t" * 100_000), (7, "a", "en", 1, "t" * 100_000), (7, "b", "en", 1, "é"), (-5, "", "", 0, "")]
    docs += [(8, "a", "en", (1 << 63) - 1, "max"), (14, "a", "en", (1 << 63) - 1, "max")]
    df = spark.createDataFrame([(*d, 1, "q") for d in docs], KIND)
    assert rows_of(merkle.verified_documents(df)) == plain(docs)
    one = [(1, "a", "en", 1, "only")]
    assert rows_of(merkle.verified_documents(spark.createDataFrame([(*one[0], 1, "q")], KIND))) == plain(one)
    none = merkle.verified_documents(spark.createDataFrame([], KIND))
    assert none.count() == 0 and "verified" in none.columns


def test_combiner_takes_events_in_any_order():
    rng = random.Random(0)
    for arity in (2, 3, 5):
        for n in (1, 2, 3, 9, 10, 64, 100):
            leaves = [h(f"{i}") for i in range(n)]
            order = list(range(n))
            rng.shuffle(order)
            made = merkle.Combiner(arity)
            got = [x for i in order for x in made.offer("g", n, 0, i, leaves[i].encode())]
            assert not list(made.frontier())
            root = max(got)[2].decode() if got else leaves[0]
            assert root == plain_tree(leaves, arity)[0]
            half = merkle.Combiner(arity)
            low = [x for i in range(0, n, 2) for x in half.offer("g", n, 0, i, leaves[i].encode())]
            other = merkle.Combiner(arity)
            for g, m, level, i, own in half.frontier():
                low += other.offer(g, m, level, i, own)
            for i in range(1, n, 2):
                low += other.offer("g", n, 0, i, leaves[i].encode())
            assert not list(other.frontier()) and (not low or max(low)[2].decode() == root)


def test_proofs_are_the_operator_s_own_output(spark):
    df = spark.createDataFrame([(i, "a", "en", i, f"{i}") for i in range(9)], "doc_id long, source string, lang string, n_chars long, text string")
    made = merkle.manifest(merkle.documents(df), "lang", "doc_id")
    proven = merkle.prove(made, ["doc_id"])
    assert proven.columns == ["doc_id", "leaf", "subroot", "proof"]
    bad = proven.where(merkle.folded(F.col("leaf"), F.col("proof")) != F.lit(made.root))
    assert bad.count() == 0 and all(len(r["proof"]) == 4 for r in proven.collect())
    forged = proven.where(merkle.folded(F.sha2(F.lit("other"), 256), F.col("proof")) == F.lit(made.root))
    assert forged.count() == 0
