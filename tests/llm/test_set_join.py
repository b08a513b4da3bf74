import random

import numpy as np
import pytest

from riskframe.llm import set_join
from riskframe.llm.set_join import Band, allocate, budget, difference, narrow, parities, set_keys, similar_sets

from . import brute


def _edited(base, seed, changes):
    r = random.Random(seed)
    w = base.split()
    for _ in range(changes):
        k = r.randrange(3)
        at = r.randrange(len(w) + (k == 1))
        if k == 0:
            w[at] = f"z{r.randrange(10**6)}"
        elif k == 1:
            w.insert(at, f"y{r.randrange(10**6)}")
        elif len(w) > 1:
            del w[at]
    return " ".join(w)


def _corpus(text_of, odd_texts):
    out = list(odd_texts)
    for f in range(5):
        base = text_of(100 + 40 * f, 70 + f, 3000)
        out += [base, base.upper(), base] + [_edited(base, 100 * f + k, k % 6) for k in range(14)]
    for n in range(4, 16):  # few shingles
        base = text_of(n, 900 + n)
        out += [base, base + " more", "less " + base, _edited(base, n, 1)]
    out += [text_of(50, 1) + " " + text_of(100, k + 3) for k in range(12)]  # a passage that many share
    return out


@pytest.mark.parametrize("percent", [80, 60])
def test_components_equal_plain_python(docs_of, text_of, odd_texts, percent):
    texts = _corpus(text_of, odd_texts)
    order = list(range(len(texts)))
    random.Random(4).shuffle(order)
    pairs = [(i, texts[k]) for i, k in enumerate(order)]
    want = brute.components(pairs, percent)
    rows = similar_sets(docs_of(pairs).repartition(5), percent).collect()
    assert len(rows) == len(pairs)
    sizes = {i: len(brute.shingles(t)) for i, t in pairs}
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in rows} == {i: (want[i], sizes[i]) for i in sizes}


def test_a_large_group_is_linked_before_all_its_pairs_are_met(docs_of, text_of, monkeypatch):
    base = text_of(150, 1, 3000)
    pairs = [(i, _edited(base, 50 + i, 1 + i % 3)) for i in range(240)]
    tables = {}

    def spy(df, name, keep=set_join.written):
        tables[name] = out = keep(df, name)
        return out

    monkeypatch.setattr(set_join, "written", spy)
    got = {r["doc_id"]: r["component_id"] for r in similar_sets(docs_of(pairs).repartition(5)).collect()}
    assert got == brute.components(pairs, 80)
    assert tables["open-pairs"].count() <= 4 * len(pairs)


def test_repeated_and_null_ids(docs_of, text_of):
    t = text_of(60, 1)
    rows = similar_sets(docs_of([(5, t), (5, t), (3, text_of(60, 2)), (3, t + " x"), (None, t), (None, "alone here"), (9, None), (None, "")])).collect()
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)
    assert got == sorted([(5, 56, 3), (5, 56, 3), (3, 56, 3), (3, 57, 3), (None, 56, 3), (None, 1, None), (9, 0, 9), (None, 0, None)], key=str)


def test_empty_table_and_percent(docs_of):
    assert similar_sets(docs_of([])).collect() == []
    with pytest.raises(ValueError, match="percent"):
        similar_sets(docs_of([]), 40)


def _random_pair(r, n, percent):
    """Two sets of about n values at, or barely above, the similarity."""
    a = int(r.integers(max(1, n), 2 * n + 1))
    b = int(r.integers(a, 100 * a // percent + 1))
    d = int(difference(a, b, percent))
    lost = (d - (b - a)) // 2
    values = r.integers(0, 1 << 63, size=a + b, dtype=np.uint64)
    x, y = values[:a], np.concatenate([values[lost:a], values[a:a + b - (a - lost)]])
    assert 100 * (a - lost) >= percent * (a + b - (a - lost))
    return np.sort(x), np.sort(y)


@pytest.mark.parametrize("neighbours", [None, 0, 1, 3])
def test_similar_sets_share_a_key(neighbours):
    """Whatever the allocation and the frequent shingles, no pair at the threshold is missed."""
    r = np.random.default_rng(8)
    for percent in (80, 50, 95):
        for n in (1, 2, 3, 4, 5, 6, 8, 11, 15, 16, 23, 40, 90, 300, 1100):
            bands = {}
            for level in range(14):
                if neighbours is None:
                    bands[level] = allocate(level, 5000, float(r.random()), percent)
                else:
                    bands[level] = Band(level, neighbours, int(r.integers(1, 4 << level)) + 1)
            for _ in range(60 if n < 100 else 4):
                x, y = _random_pair(r, n, percent)
                if np.array_equal(x, y):
                    continue
                frequent = np.sort(r.choice(np.concatenate([x, y]), size=max(1, len(x) // 2)))
                keys, bounds = set_keys(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), bands, frequent, percent)
                assert np.intersect1d(keys[:bounds[1]], keys[bounds[1]:]).size, (percent, n, len(x), len(y))
                p, q = parities(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
                for u, v in ((p, q), (narrow(p), narrow(q))):
                    if len(u) != len(v):
                        u, v = sorted((u, v), key=len)
                        v = v[: len(u)] ^ v[len(u):]
                    assert np.unpackbits((u ^ v).view(np.uint8)).sum() <= difference(len(x), len(y), percent)


def test_keys_of_a_set_are_few():
    """A set of n shingles has about n / 4 keys at 80 %, not one a shingle."""
    r = np.random.default_rng(1)
    sets = np.sort(r.integers(0, 1 << 63, size=700, dtype=np.uint64))
    bands = {level: allocate(level, 10_000, 0.02, 80) for level in range(14)}
    keys, _ = set_keys(sets, np.array([0, 700]), bands, np.zeros(0, dtype=np.uint64), 80)
    assert len(keys) <= 700 * 0.3
    assert budget(np.array([700]), bands[9], 80)[0] == difference(700, 875, 80)
