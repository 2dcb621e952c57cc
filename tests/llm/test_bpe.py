"""Byte-level BPE against the public library, a plain merge, and an exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tamis.llm import bpe, queries
from tamis.llm.tokens import vocabulary


@pytest.fixture(scope="module")
def model():
    return bpe.ByteBpe(vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, entries=200)


@pytest.fixture(scope="module")
def library(model):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.ranks, special_tokens={})


def plain_merge(ids, pairs):
    ids = list(ids)
    while True:
        known = [(pairs[a << 32 | b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in pairs]
        if not known:
            return ids
        rank, i = min(known)
        ids[i : i + 2] = [rank]


def test_merge_is_the_leftmost_lowest_pair(model):
    rng = random.Random(3)
    made_up = {rng.randrange(6) << 32 | rng.randrange(40): rng.randrange(6, 40) for _ in range(120)}
    for pairs, top in ((model.pairs, 256), (made_up, 6)):
        for n in [0, 1, 2, 3, 4, 5, 8, 9, 31, 32, 33, 200]:
            for _ in range(15):
                ids = [rng.randrange(top) for _ in range(n)]
                assert bpe.merge(ids, pairs) == plain_merge(ids, pairs)


def test_many_trees_at_once(model):
    rng = random.Random(5)
    rows = [[rng.randrange(97, 105) for _ in range(rng.randint(1, 16))] for _ in range(500)]
    ids = np.full((len(rows), 16), -1, np.int64)
    for k, row in enumerate(rows):
        ids[k, : len(row)] = [model.single[b] for b in row]
    got, live = bpe.merge_many(ids, model.table)
    for k, row in enumerate(rows):
        assert got[k][live[k]].tolist() == plain_merge([model.single[b] for b in row], model.pairs)


def test_encode_equals_the_library(model, library):
    rng = random.Random(4)
    bits = [" ", "  ", "\n", "\t", "\x1c", "\x85", "　", "\xa0", "a", "B", "'s", "'", "'ll", "é", "ß", "中", "文", "1", "²", "!", "-", "<|endoftext|>", "́", "😀", "‍", "\r\n", "the", "ing", "\x00", "﻿"]
    odd = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    points = "".join(f"{chr(c)}a{chr(c)} {chr(c)}" for c in range(0x3000))
    for text in [*odd, points, "a" * 50_000, "".join(rng.choice("abcdefgh") for _ in range(20_000)), " " * 9_000, "\n " * 9_000]:
        got = model.encode([text])[0]
        assert np.frombuffer(got, "<u4").tolist() == library.encode_ordinary(text)
        assert model.decode(got) == text.encode()


def test_patterns_without_a_leading_space(library):
    model = bpe.ByteBpe(vocabulary("byte_bpe_multi_50k.tiktoken"), r"\p{L}+|[^\p{L}]+")
    own = tiktoken.Encoding("own", pat_str=r"\p{L}+|[^\p{L}]+", mergeable_ranks=model.ranks, special_tokens={})
    for text in ("one two  three", "  a b", "x"):
        assert np.frombuffer(model.encode([text])[0], "<u4").tolist() == own.encode_ordinary(text)


def test_the_query_over_the_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    got = queries.op11_byte_level_bpe(spark, sf_dir).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for doc_id, text in zip(docs.doc_id, docs.text):
        ids = library.encode_ordinary(text or "")
        row = got.loc[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_rows(spark):
    kind = "ids string, n_tokens int, decoded long, text string, `a.b` int"
    rows = [("x", 1, 1, None, 1), (None, 1, 1, "", 1), ("y", None, 1, "hi there", None), ("y", 1, 1, "hi there", 1), ("z", 1, 1, "long " * 60_000, 1)]
    docs = spark.createDataFrame(rows, kind)
    encoded = bpe.encode(docs.withColumnRenamed("ids", "doc"), "doc")
    back = bpe.decode(encoded)
    assert encoded.columns == ["doc", "n_tokens", "ids"] and back.columns == ["doc", "n_tokens", "ids", "decoded"]
    got = sorted((r["doc"] or "", r["n_tokens"], bytes(r["decoded"]).decode()) for r in back.collect())
    assert [g[2] for g in got] == ["", "", "hi there", "hi there", "long " * 60_000]
    assert [g[1] for g in got[:4]] == [0, 0, 2, 2]
    assert bpe.decode(back).columns == back.columns
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string, n_tokens int")).count() == 0


def test_unknown_ids_fail(model):
    with pytest.raises(KeyError):
        model.decode((70_000).to_bytes(4, "little"))
    with pytest.raises(ValueError):
        model.decode(b"abc")
