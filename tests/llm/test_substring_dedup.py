import random

import numpy as np
import pytest

from riskframe.llm.substring_dedup import anchors, levels, substring_dedup
from riskframe.llm.textcols import mix

from . import brute


def _run(df, window):
    return {(r["doc_id"]): (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup(df, window).collect()}


@pytest.mark.parametrize("window,rounds", [(35, 2), (8, 1), (12, 3)])
def test_equal_to_plain_python(docs_of, text_of, odd_texts, window, rounds):
    r = random.Random(window)
    passages = [text_of(n, 70 + n, 50) for n in (7, 20, 36, 90, 200)]
    texts = list(odd_texts)
    for k in range(40):
        parts = [text_of(r.randrange(5, 60), 1000 + k, 80)]
        for _ in range(r.randrange(3)):
            p = r.choice(passages).split()
            a = r.randrange(len(p))
            parts += [" ".join(p[a:] if r.random() < 0.5 else p[: a + 1]), text_of(r.randrange(3, 30), 2000 + k, 80)]
        texts.append("\n".join(parts))
    texts += ["a b " * 100, "a " * 37, "b " * 35, "c " * 34, " ".join(["d", "e", "f"] * 30)]
    pairs = list(enumerate(texts))
    want = brute.repeated(pairs, window)
    got = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept"]) for x in substring_dedup(docs_of(pairs), window, rounds).collect()}
    assert got == want


def test_repeated_rows_nulls_and_empty_table(docs_of, text_of):
    t = text_of(50, 1)
    df = docs_of([(1, t), (1, t), (2, text_of(50, 2)), (None, t + " end"), (None, None), (3, None)])
    got = sorted(((r["doc_id"] or 0), r["n_words"], r["n_removed"]) for r in substring_dedup(df).collect())
    assert got == [(0, 0, 0), (0, 51, 50), (1, 50, 50), (1, 50, 50), (2, 50, 0), (3, 0, 0)]
    assert substring_dedup(df.limit(0)).count() == 0
    digest = {r["doc_id"]: r["kept"] for r in substring_dedup(docs_of([(1, t)]), digest=True).collect()}
    assert digest == {1: brute.sha256(t)}


def test_equal_substrings_have_equal_interior_symbols():
    r = np.random.default_rng(1)
    inner = mix(r.integers(0, 9, 60).astype(np.uint64) + np.uint64(1))
    texts = [np.concatenate([mix(r.integers(0, 9, 20).astype(np.uint64) + np.uint64(1)), inner,
                             mix(r.integers(0, 9, 20).astype(np.uint64) + np.uint64(1))]) for _ in range(2)]
    for number in range(4):
        seen = []
        for t in texts:
            s = levels(t, np.zeros(len(t), dtype=np.int64), 3)[number]
            mine = (s.low >= 20) & (s.high <= 80)
            assert (s.low <= s.start).all() and (s.end <= s.high).all()
            seen.append(list(zip(s.name[mine], s.start[mine], s.end[mine])))
        assert seen[0] == seen[1] and seen[0]


def test_every_window_has_one_anchor():
    r = np.random.default_rng(4)
    w = mix(r.integers(0, 30, 500).astype(np.uint64) + np.uint64(1))
    first = np.array([0, 10, 200, 200, 500])
    a = anchors(w, first, 35, 2)
    covered = sorted((int(x), int(y) + k) for x, y, n in zip(a["row"], a["at"], a["n"]) for k in range(n))
    assert covered == [(1, k) for k in range(190 - 34)] + [(3, k) for k in range(300 - 34)]
