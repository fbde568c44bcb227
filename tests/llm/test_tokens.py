import os
import random
import time

import numpy as np
import pytest

pytest.importorskip("worktally.llm.bpe")
from worktally.llm.bpe import Encoder, count_tokens, encode_texts, load_ranks
from worktally.llm.packing import balance_report, fill_report, pack, pack_block
from worktally.llm.vocabularies import vocabulary_path

VOCABULARY = vocabulary_path()
needs_vocabulary = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, "rb") as f:
        return Encoder(load_ranks(f.read()))


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


ODD = ["", " ", "\n\n  x", "a" * 3000, "ab" * 500, "हिन्दी में पाठ", "i'm we'll I'LL", "👨‍👩‍👧 x", "\u0085   y", "\x1c\x1d z", "<|endoftext|>", "१२३ 45.6", "é", "﻿x", "tab\tand\r\nline  ", "ѬѬ", "\u0000"]


@needs_vocabulary
@pytest.mark.parametrize("text", ODD)
def test_encoder_equals_the_library_on_odd_texts(encoder, reference, text):
    assert encoder.encode(text) == reference(text)


@needs_vocabulary
def test_encoder_equals_the_library_on_random_texts(encoder, reference):
    rng = random.Random(1)
    letters = "aabbcdeehillnoorsttuwxyz  ,.'0189éकाि中\n"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 200)))
        assert encoder.encode(text) == reference(text)


@needs_vocabulary
def test_merge_takes_the_leftmost_lowest_rank(encoder):
    def slow(data):
        parts = [data[i : i + 1] for i in range(len(data))]
        while True:
            ranked = [(encoder.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in encoder.ranks]
            if not ranked:
                return [encoder.ranks[p] for p in parts]
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(2)
    for _ in range(200):
        data = bytes(rng.choice(b"aabcnortheing") for _ in range(rng.randint(1, 40)))
        whole = encoder.ranks.get(data)
        assert encoder.merge(data) == ([whole] if whole is not None else slow(data))


@needs_vocabulary
def test_long_words_take_near_linear_time(encoder):
    took = []
    for n in (20_000, 80_000):
        began = time.process_time()
        encoder.encode("".join(random.Random(n).choice("abcdefgh") for _ in range(n)))
        took.append(time.process_time() - began)
    assert took[1] < 12 * max(took[0], 0.02)


@needs_vocabulary
def test_encode_texts_keeps_every_row(spark, encoder):
    rows = [(1, "a b", "x", 1), (1, "a b", "x", 1), (2, None, "y", 2), (3, "", "z", 3), (None, "c", "w", 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int")
    got = sorted(((r.doc_id or 0), r.ids) for r in encode_texts(df).collect())
    assert got == sorted([(1, encoder.encode("a b"))] * 2 + [(2, []), (3, []), (0, encoder.encode("c"))])
    assert sorted(r.n_tokens for r in count_tokens(df).collect()) == sorted(len(x) for _, x in got)
    assert encode_texts(df.limit(0)).count() == 0


def _packed(spark, sizes, capacities):
    lengths = spark.createDataFrame([(i, n, "clash") for i, n in sizes], "doc_id bigint, n_tokens bigint, kind string")
    kinds = spark.createDataFrame([(f"k{c}", c) for c in capacities], "container_kind string, capacity_tokens int")
    return pack(lengths, kinds), kinds


def test_packing_holds_every_token_once(spark):
    rng = random.Random(4)
    sizes = [(i, rng.choice([0, 1, 7, 50, 100, 101, 250, 1000])) for i in range(400)] + [(7, 60), (7, 60), (500, None)]
    packed, kinds = _packed(spark, sizes, [100, 1000])
    rows = packed.collect()
    for c in (100, 1000):
        mine = [r for r in rows if r.container_kind == f"k{c}"]
        held, pieces = {}, {}
        for r in mine:
            held[r.container_id] = held.get(r.container_id, 0) + r.n_tokens
            pieces.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
        assert max(held.values()) <= c
        assert set(pieces) == {i for i, _ in sizes}
        for i, n in sizes:
            if i != 7:
                at = 0
                for first, size in sorted(pieces[i]):
                    assert first == at
                    at += size
                assert at == (n or 0) and len(pieces[i]) == max(1, -(-(n or 0) // c))
        assert sum(held.values()) == sum(n or 0 for _, n in sizes)
    report = {r.container_kind: r.unused_share for r in fill_report(packed, kinds).collect()}
    assert all(0 <= x < 0.1 for x in report.values())


def test_packing_of_empty_and_bad_tables(spark):
    assert _packed(spark, [], [100])[0].count() == 0
    assert _packed(spark, [(1, 5)], [])[0].count() == 0
    assert {r.n_tokens for r in _packed(spark, [(1, 0), (2, None)], [10])[0].collect()} == {0}
    with pytest.raises(ValueError):
        _packed(spark, [(1, 5)], [0])


def test_pack_block_balances_cost():
    sizes = np.sort(np.random.default_rng(1).integers(1, 1000, 3000))[::-1]
    at = pack_block(sizes, 4096)
    room = np.bincount(at, weights=sizes)
    assert room.max() <= 4096 and 1 - sizes.sum() / (4096 * len(room)) < 0.01
    cost = np.bincount(at, weights=sizes + sizes.astype(float) ** 2 / 2048)
    assert cost.std() / cost.mean() < 0.1


def test_costs_of_containers_are_reported(spark):
    packed = spark.createDataFrame([("a", "a:0", 10), ("a", "a:0", 20), ("a", "a:1", 40), ("a", "a:2", 0), ("b", "b:0", None)], "container_kind string, container_id string, n_tokens bigint")
    r = balance_report(packed, 1.0, 0.5).collect()
    costs = [30 + 0.5 * (100 + 400), 40 + 0.5 * 1600]
    assert [(x.container_kind, x.n_containers) for x in r] == [("a", 2)]
    assert (r[0].mean_cost, r[0].highest_cost) == (sum(costs) / 2, max(costs)) and abs(r[0].spread - (costs[1] - costs[0]) / sum(costs)) < 1e-9
    assert balance_report(packed.limit(0)).count() == 0
