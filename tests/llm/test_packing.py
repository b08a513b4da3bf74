import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm.packing import configuration_lp, knapsack, pack, packing_plan, pieces, plan_ranges, rounded_plans

CAP = 64


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _ids(tokenizer, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_equal_the_tokenizer(docs_of, odd_texts, tokenizer):
    texts = odd_texts + ["Don't stop. It's 2024! é   x y", "<|endoftext|> a<|endoftext|>b", "\x1c\x1d z"]
    got = defaultdict(list)
    for r in pieces(docs_of(enumerate(texts)), tokenizer, CAP, ids=True).collect():
        got[r["doc_id"]].append(r)
    for i, t in enumerate(texts):
        want = _ids(tokenizer, t)
        own = sorted(got[i], key=lambda r: r["piece"])
        assert [x for r in own for x in r["ids"]] == want
        assert [r["start"] for r in own] == list(range(0, len(want), CAP))
        assert all(r["length"] == len(r["ids"]) <= CAP for r in own)
        assert all(r["length"] == CAP for r in own[:-1])
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())


def _check_places(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= CAP
    return len(by)


def test_pack_round_trip(docs_of, odd_texts, text_of, tokenizer):
    texts = odd_texts + [text_of(k % 40, k) for k in range(150)]
    df = docs_of([*enumerate(texts), (7, texts[8]), (None, "a b"), (None, "a b")])
    rows = pack(df, tokenizer, CAP).collect()
    want = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces(df, tokenizer, CAP).collect())
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    total = sum(r["length"] for r in rows)
    assert _check_places(rows) <= -(-total // CAP) * 1.03 + 1
    assert pack(df.limit(0), tokenizer, CAP).count() == 0


def test_knapsack_is_the_best():
    r = random.Random(5)
    for _ in range(20):
        lengths = np.array(sorted(r.sample(range(1, 25), 5)))
        weights = np.array([r.random() for _ in lengths])
        room = 30
        best = [0.0] * (room + 1)
        for c in range(1, room + 1):
            best[c] = max([best[c - 1]] + [best[c - n] + w for n, w in zip(lengths, weights) if n <= c])
        assert knapsack(lengths, weights, room)[0] == pytest.approx(best)


def _best_fit_decreasing(histogram):
    rooms = []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        i = bisect.bisect_left(rooms, n)
        bisect.insort(rooms, (rooms.pop(i) if i < len(rooms) else CAP) - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    r = random.Random(seed)
    histogram = {n: r.randrange(1, 400) for n in r.sample(range(1, CAP + 1), r.choice([1, 5, 30, 60]))}
    plan = packing_plan(histogram, CAP, rounds=400)
    used = Counter()
    for conf, times in plan:
        assert sum(n * k for n, k in conf.items()) <= CAP and times > 0
        for n, k in conf.items():
            used[n] += k * times
    assert used == Counter(histogram)
    assert sum(t for _, t in plan) <= _best_fit_decreasing(histogram) * 1.005 + 2
    ranges = plan_ranges(plan)
    for n in histogram:
        assert ranges[ranges[:, 0] == n][0, 1] == 0
    assert packing_plan({}, CAP) == []


def test_lp_serves_every_length():
    lengths, counts = np.array([5, 20, 33, 40]), np.array([10.0, 7.0, 9.0, 4.0])
    found, served = configuration_lp(lengths, counts, CAP, rounds=200)
    assert served.min() >= 1.0
    assert all(sum(n * k for n, k in c.items()) <= CAP for c, _ in found)


def test_few_lengths_are_packed_by_the_program():
    """At the production rounds: every piece placed once, never more sequences than with full
    configurations alone, fewer on some, and about half the sequences come from the program
    (full configurations alone: one in a hundred)."""
    r = random.Random(7)
    fewer, shares = 0, []
    for _ in range(40):
        histogram = {n: r.randrange(50, 900) for n in r.sample(range(200, 2049), r.randrange(3, 9))}
        plans = [(sum(t for _, t in plan), placed) for plan, placed in rounded_plans(histogram, 2048)]
        used = packing_plan(histogram, 2048)
        best = min(plans, key=lambda x: x[0])
        assert sum(t for _, t in used) == best[0] <= plans[-1][0]
        fewer += best[0] < plans[-1][0]
        shares.append(best[1] / best[0])
        counted = Counter()
        for conf, times in used:
            assert sum(n * k for n, k in conf.items()) <= 2048
            for n, k in conf.items():
                counted[n] += k * times
        assert counted == Counter(histogram)
    assert fewer and sum(shares) / len(shares) > 0.5
