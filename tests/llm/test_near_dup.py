import random

from pyspark.sql import functions as F

from riskframe.llm.components import connected_components
from riskframe.llm.near_dup import accidental, classes, drop_near_duplicates, estimate, near_duplicates, sketches

import numpy as np

from . import brute


def _family(base, seed, changes):
    r = random.Random(seed)
    w = base.split()
    for _ in range(changes):
        w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
    return " ".join(w)


def _corpus(text_of, odd_texts):
    out = list(odd_texts)
    for f in range(6):
        base = text_of(120 + 20 * f, 50 + f, 3000)
        out += [base, base.upper(), base] + [_family(base, 100 * f + k, k % 7) for k in range(14)]
    out += [text_of(4, 9), text_of(4, 9) + " more", text_of(8, 9), text_of(8, 9) + " q"]
    return out


def test_components_equal_plain_python(docs_of, text_of, odd_texts):
    texts = _corpus(text_of, odd_texts)
    order = list(range(len(texts)))
    random.Random(3).shuffle(order)
    pairs = [(i, texts[k]) for i, k in enumerate(order)]
    want = brute.components(pairs)
    rows = near_duplicates(docs_of(pairs)).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        assert r["component_id"] == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])
        assert r["n_shingles"] == len(brute.shingles(dict(pairs)[r["doc_id"]]))


def test_repeated_and_null_ids(docs_of, text_of):
    t = text_of(50, 1)
    df = docs_of([(5, t), (5, t), (3, t.upper()), (None, t), (None, text_of(50, 2)), (None, None), (8, "")])
    got = [(r["doc_id"], r["component_id"]) for r in near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(5, 3), (5, 3), (3, 3), (None, 3), (None, None), (None, None), (8, 8)], key=str)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert classes(df.limit(0)).count() == 0 and drop_near_duplicates(df.limit(0)).count() == 0


def test_a_chain_is_one_component(docs_of):
    w = [f"v{k}" for k in range(400)]
    pairs = [(k, " ".join(w[4 * k: 4 * k + 100])) for k in range(40)]
    assert {r["component_id"] for r in near_duplicates(docs_of(pairs)).collect()} == {0}


def test_estimate_is_corrected():
    r = np.random.default_rng(2)
    common = r.integers(0, 1 << 63, 3000).astype(np.uint64)
    a = np.unique(np.concatenate([common, r.integers(0, 1 << 63, 1000).astype(np.uint64)]))
    b = np.unique(np.concatenate([common, r.integers(0, 1 << 63, 1000).astype(np.uint64)]))
    sk = sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    assert abs(estimate(sk[0], sk[1], len(a), len(b)) - 0.6) < 0.15
    assert 0 < accidental(1e4, 1e4) < 0.01


def test_connected_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)]
    parent = list(range(300))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: find(i) for e in edges if e[0] != e[1] for i in e}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    assert connected_components(spark.createDataFrame(edges, "u long, v long")).groupBy("node").count().where(F.col("count") > 1).count() == 0


def test_rows_without_or_with_shared_ids_are_told_apart_by_text(docs_of, text_of):
    base, other, third = (text_of(150, k, 3000) for k in (71, 72, 73))
    pairs = [(None, base), (None, _family(base, 1, 2)), (None, other), (None, third), (7, text_of(90, 74, 3000)),
             (7, text_of(90, 75, 3000)), (9, _family(third, 2, 2)), (5, text_of(60, 76, 3000)), (5, text_of(60, 76, 3000)),
             (None, other), (7, _family(text_of(90, 75, 3000), 3, 1)), (11, ""), (11, ""), (12, "")]
    df = docs_of(pairs)
    want = [(5, pairs[7][1]), (7, pairs[4][1]), (9, pairs[6][1]), (11, ""), (12, ""), (None, other)]
    got = [(r["doc_id"], r["text"]) for r in drop_near_duplicates(df).collect()]
    assert sorted(x for x in got if x[0] not in (None, 7)) == [x for x in want if x[0] not in (None, 7)]
    null = [t for i, t in got if i is None]
    assert len(null) == 2 and other in null and (set(null) - {other}) <= {base, pairs[1][1]}
    seven = [t for i, t in got if i == 7]
    assert len(seven) == 2 and pairs[4][1] in seven and (set(seven) - {pairs[4][1]}) <= {pairs[5][1], pairs[10][1]}
    rows = near_duplicates(df).collect()
    assert len(rows) == len(pairs) and sum(r["kept"] for r in rows) == len(got) == 9 - 1
    # a row without an id takes the component_id of the near copy that has one
    assert sorted(str(r["component_id"]) for r in rows if r["doc_id"] is None) == ["9", "None", "None", "None", "None"]


def test_the_query_keeps_where_the_id_is_that_of_the_component(spark, docs_of, text_of, tmp_path):
    from riskframe.llm.queries import QUERIES

    t = text_of(50, 1)
    docs_of([(5, t), (5, t), (3, t.upper()), (3, t.upper()), (9, ""), (9, ""), (None, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op8_hyperminhash"](spark, str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), r["kept"]) for r in got) == [
        ("3", True), ("3", True), ("5", False), ("5", False), ("9", True), ("9", True), ("None", True)]
