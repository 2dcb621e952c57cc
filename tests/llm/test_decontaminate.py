"""The index of benchmark items: what is sent, crowded keys, ids of any type, and what shared words rule out."""

import pickle
import random
import time

import numpy as np

from tamis.llm import decontaminate


def test_what_is_sent_is_the_text():
    rng = random.Random(1)
    vocab = [f"v{i}" for i in range(5000)]
    for words in (13, 100):
        rows = [(i, " ".join(rng.choice(vocab) for _ in range(words))) for i in range(3000)]
        block = decontaminate.Block(rows)
        assert len(block.items.seqs) == 3000
        sent = pickle.dumps(block)
        assert len(sent) <= 1.5 * sum(len(t) for _, t in rows)
        again = pickle.loads(sent)
        assert again.rows == rows and again.items is again.items


def test_items_that_open_alike_are_cheap():
    rows = [(i, f"what is the capital of country{i} today") for i in range(20_000)]
    items = decontaminate.Block(rows).items
    docs = [f"some words and what is the capital of country{i * 7} then more words follow" for i in range(20)] + ["what is the capital of nothing"] * 20
    began = time.perf_counter()
    got = sorted((k, items.ids[i], held[0]) for k, i, held in items.search(docs))
    assert time.perf_counter() - began < 5
    assert got == [(k, 7 * k, 1) for k in range(20)]


def test_a_passage_that_repeats_is_verified_once():
    items = decontaminate.Block([(1, "w " * 13)]).items
    assert [held for _, _, held in items.search(["w " * 4000])] == [(0, 0, 13)]


def test_shared_words_rule_out_no_passage():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 40)))) for i in range(150)] + [(500, " ".join(rng.choice(vocab) for _ in range(300)))]
    items = decontaminate.Block(rows).items
    every = np.arange(len(items.seqs))
    for _ in range(60):
        k = rng.randrange(len(items.seqs))
        n = int(items.sizes[k])
        words = items.seqs[k].tolist()
        for _ in range(decontaminate.edits(n)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], [0], [words[at], 0]])
        before = [0] * rng.randrange(6)
        ids = np.array(before + words + [0] * 5)
        assert items.verify(ids, k, len(before)) is None or items._share_words(ids, every, len(before))[k]


def test_ids_of_any_type(spark):
    bench = spark.createDataFrame([("q-1", "the quick brown fox jumps over the lazy dog today", 1), (None, "a b c", 1)], "item_id string, text string, doc_id int")
    docs = spark.createDataFrame([("d1", "see the quick brown fox jumps over the lazy dog today ok", "x"), ("d2", "none", "y"), (None, None, "z")], "doc_id string, text string, item_id string")
    assert [(r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.find(docs, bench).collect()] == [("d1", "q-1", 0)]
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r["item_id"] for r in left.collect()) == ["y", "z"]
