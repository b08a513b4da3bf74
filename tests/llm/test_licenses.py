import random

import numpy as np
import pytest

from riskframe.llm.licenses import GAP, MATCH, MISMATCH, TEMPLATES, align, alignments, scan_licenses


def test_planted_notices_are_found(docs_of, text_of, odd_texts):
    texts, want = list(odd_texts), set()
    names = list(TEMPLATES)
    r = random.Random(4)
    for k in range(60):
        name = r.choice(names)
        w = TEMPLATES[name].split()
        if len(w) > 20:
            w[r.randrange(len(w))] = "other"
            w.insert(r.randrange(len(w)), "added")
        i = len(texts)
        texts.append(text_of(r.randrange(30), k) + " " + " ".join(w).upper() + "\n" + text_of(r.randrange(30), k + 500))
        want.add((i, name))
    rows = scan_licenses(docs_of(enumerate(texts))).collect()
    assert {(x["doc_id"], x["template"]) for x in rows} == want
    for x in rows:
        part = texts[x["doc_id"]][x["char_start"]: x["char_end"]]
        assert len(part.split()) >= 3 and x["coverage"] >= 0.8
        if x["template_words"] < 20:
            assert x["coverage"] == 1.0 and part.lower().split()[0].strip('."') in TEMPLATES[x["template"]].lower()


def test_odd_rows_and_own_templates(docs_of, odd_texts):
    df = docs_of([*enumerate(odd_texts), (None, "b c d e"), (3, "b c d e"), (3, "b c d e")])
    rows = scan_licenses(df, {"t": "B, C; d (e)", "two": "é-Ü 漢字"}).collect()
    assert sorted((str(x["doc_id"]), x["template"]) for x in rows) == [("3", "t"), ("3", "t"), ("None", "t")]
    with pytest.raises(ValueError):
        scan_licenses(df, {"short": "word"})
    assert scan_licenses(df.limit(0)).count() == 0


def _full(doc, template):
    """Best local alignment score without a band."""
    h = np.zeros((len(template) + 1, len(doc) + 1), dtype=int)
    for i in range(1, len(template) + 1):
        for j in range(1, len(doc) + 1):
            s = MATCH if template[i - 1] == doc[j - 1] else MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + GAP, h[i, j - 1] + GAP)
    return int(h.max())


def test_alignment_equals_the_full_one_in_a_wide_band():
    r = np.random.default_rng(7)
    for _ in range(60):
        doc = r.integers(0, 4, r.integers(1, 30)).astype(np.uint64)
        template = r.integers(0, 4, r.integers(1, 15)).astype(np.uint64)
        score, pairs = align(doc, template, -len(template), len(doc))
        assert score == _full(doc, template)
        assert all(doc[a] == template[b] for a, b in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def _full_runs(doc, template, least):
    """Spans of the best full alignments, of what lies left and right of them, and so on."""
    _, pairs = align(doc, template, -len(template), len(doc))
    if not pairs or len(pairs) < least:
        return []
    a, b = pairs[0][0], pairs[-1][0] + 1
    return _full_runs(doc[:a], template, least) + [(a, b)] + [(b + x, b + y) for x, y in _full_runs(doc[b:], template, least)]


def test_repeated_notices_are_a_row_each(docs_of, text_of):
    short = {n: t for n, t in TEMPLATES.items() if len(t.split()) < 20}
    texts, want = [], []
    for n, t in short.items():
        for k, between in ((2, " "), (3, "\n"), (7, " and "), (5, " one two three ")):
            texts.append(text_of(12, k) + " " + between.join([t] * k) + " " + text_of(12, k + 50))
            want.append((n, k, t))
    rows = {}
    for x in scan_licenses(docs_of(enumerate(texts))).collect():
        rows.setdefault(x["doc_id"], []).append(x)
    for i, (n, k, t) in enumerate(want):
        assert [x["template"] for x in rows[i]] == [n] * k, texts[i]
        assert {texts[i][x["char_start"]: x["char_end"]] for x in rows[i]} == {t.rstrip(".")}
    both = "All rights reserved. Released under the MIT License. " * 3
    found = sorted(scan_licenses(docs_of([(1, both)])).collect(), key=lambda x: x["word_start"])
    assert [x["template"] for x in found] == ["all-rights-reserved", "mit-line"] * 3


def test_repeats_equal_repeated_full_alignment():
    r = np.random.default_rng(3)
    for size in (3, 5, 8, 12):
        template = np.arange(size).astype(np.uint64)
        for _ in range(40):
            parts = []
            for _ in range(r.integers(1, 9)):
                p = template.copy()
                if r.random() < 0.3:
                    p[r.integers(size)] = 99
                parts += [p, r.integers(100, 200, r.integers(0, 5)).astype(np.uint64)]
            doc = np.concatenate(parts)
            least = -(-size * 4 // 5)
            got = sorted((p[0][0], p[-1][0] + 1) for p in alignments(doc, template, -size, len(doc), least))
            assert got == _full_runs(doc, template, least)


def test_a_long_run_of_notices(docs_of):
    rows = scan_licenses(docs_of([(1, "All rights reserved.\n" * 5000)])).collect()
    assert len(rows) == 5000 and len({x["char_start"] for x in rows}) == 5000
