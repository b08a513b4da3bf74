import hashlib
import re
import zlib

import pytest

from riskframe.llm.manifest import document_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, payload int, tree string"


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(doc_id, text, lang, source, n_chars):
    out = ""
    for v in (doc_id, source, lang, n_chars, text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _h(out)


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def _steps(levels, i):
    for nodes in levels[:-1]:
        lo = i // 8 * 8
        yield nodes[lo:lo + 8], i - lo
        i //= 8


def expected(rows):
    """Rows as (doc_id, leaf, subroot, root, proof, folded, verified)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        rows_ = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
        trees[g] = rows_, _levels([_leaf(*r) for r in rows_])
    top = _levels([trees[g][1][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        rows_, levels = trees[g]
        for i, r in enumerate(rows_):
            leaf = acc = levels[0][i]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                acc = _leaf(r[0], re.sub("[A-Z]", lambda m: m[0].lower(), r[1]), *r[2:])
            proof = ""
            for run, at in [*_steps(levels, i), *_steps(top, k)]:
                proof += "".join(run[:at] + run[at + 1:])
                acc = _h("".join([*run[:at], acc, *run[at + 1:]]))
            out.append((r[0], leaf, levels[-1][0], top[-1][0], _h(proof), acc, acc == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "t") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, document_manifest(df).collect()), key=str)


def test_equals_plain_python(spark):
    rows = [(i, f"Text {i} É" + "A" * (i % 50), "de", "s", i) for i in range(700)]
    rows += [(1000 + i, f"x{i}", f"l{i}", None, None) for i in range(75)]  # a language each: two levels over the subroots
    rows += [(2000 + i, None if i % 3 else "", None, "", 5) for i in range(65)]
    rows += [(None, "no id", "de", "s", 1), (None, "no id", "de", "s", 1), (None, "other", None, "s", 1)]
    rows += [(5, "Text 5 twice", "de", "s", 2), (3, "Text 3 É" + "A" * 3, "de", "s", 3), (7, "long " * 400_000, "xx", "s", 0)]
    got = run(spark, rows)
    assert got == expected(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n, langs", [(1, 1), (9, 1), (9, 9), (64, 1)])
def test_small_trees(spark, n, langs):
    rows = [(i, f"Aa{i}", f"l{i % langs}", "s", 1) for i in range(n)]
    assert run(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
