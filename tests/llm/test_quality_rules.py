import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm.quality_rules import (
    FLOORS, TOLERANCE, base_failed, chi2_cdf, concentrations, consistency, estimates, filter_documents, quality_rules, raised, salted, statistics)

from . import brute

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _texts(text_of):
    out = [text_of(40 + 7 * (k % 23), k, 5000) for k in range(80)]
    out += [" ".join(f"{w}###" for w in text_of(80, 900 + k, 5000).split()) for k in range(4)]
    out += ["\n".join([text_of(6, 7)] * 12), text_of(9, 3)]
    return out


def test_statistics_equal_plain_python(docs_of, odd_texts, text_of):
    texts = odd_texts + _texts(text_of) + ["a\nb\na\n\n \na\r\na\n", "#*$%&|<> x", "\n\n"]
    got = {r["doc_id"]: r for r in statistics(docs_of(enumerate(texts))).collect()}
    for i, t in enumerate(texts):
        assert {c: got[i][c] for c in BASE} == brute.statistics(t), i


def test_verdicts_equal_plain_python(docs_of, text_of):
    texts = _texts(text_of)
    got = {r["doc_id"]: r for r in quality_rules(docs_of(enumerate(texts))).collect()}
    stats = [brute.statistics(t) for t in texts]
    d2 = brute.distances([brute.features(s) for s in stats], FLOORS, factor=consistency(0.75))
    for i, s in enumerate(stats):
        assert got[i]["distance2"] == pytest.approx(d2[i], rel=1e-6, abs=1e-9)
        failed = s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"]
        assert got[i]["base_failed"] == failed
        assert got[i]["kept"] == (not failed and d2[i] <= 30.0)
    assert [got[i]["kept"] for i in range(86)] == [True] * 80 + [False] * 6


def test_groups_are_judged_apart(spark, text_of):
    plain = [(k, text_of(50, k, 5000), "en", None) for k in range(40)]
    marked = [(100 + k, " ".join(w + "#" for w in text_of(50, k, 5000).split()), None, "t") for k in range(40)]
    small = [(200, " ".join(w + "#" for w in text_of(50, 1, 5000).split()), "fr", "t")]
    df = spark.createDataFrame(plain + marked + small, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality_rules(df).collect()}
    assert all(got.values())  # symbols are usual in their own group; a small group isn't judged
    mixed = df.withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).where("doc_id <= 100")
    assert {r["doc_id"]: r["kept"] for r in quality_rules(mixed).collect()}[100] is False


def test_filter_keeps_columns_and_rows(spark, docs_of, odd_texts, text_of):
    texts = odd_texts + [text_of(50, k, 5000) for k in range(40)]
    df = docs_of(enumerate(texts)).union(docs_of([(99, texts[-1]), (99, texts[-1]), (None, texts[-2])]))
    out = filter_documents(df)
    assert out.columns == df.columns
    ids = sorted(str(r["doc_id"]) for r in out.collect())
    assert ids.count("99") == 2 and ids.count("None") == 1 and "0" not in ids
    empty = df.limit(0)
    assert filter_documents(empty).count() == 0 and quality_rules(empty).count() == 0
    with pytest.raises(ValueError):
        statistics(df.drop("lang"))


def test_chi_square():
    assert chi2_cdf(11.0705, 5) == pytest.approx(0.95, abs=1e-5)
    assert chi2_cdf(0.0, 5) == 0.0
    r = np.random.default_rng(1).normal(size=(200_000, 5))
    d = np.sort((r ** 2).sum(axis=1))
    h = r[(r ** 2).sum(axis=1) <= d[150_000]]
    assert consistency(0.75) * h.var(axis=0).mean() == pytest.approx(1.0, abs=0.02)


def test_base_rule_bounds(spark):
    df = spark.createDataFrame([(19, 0), (20, 6), (20, 7)], "n_words long, n_repeat_words long")
    assert [r[0] for r in df.select(base_failed()).collect()] == [True, False, True]


def test_small_groups_are_judged_by_their_language_or_the_table(spark, text_of):
    junk = " ".join(w + "###" for w in text_of(50, 1, 5000).split())
    tail = [(k, text_of(40 + k % 20, k, 5000), "en", f"host{k}") for k in range(60)]
    large = [(100 + k, text_of(40 + k % 20, 200 + k, 5000), "en", "large") for k in range(40)]
    odd = [(300, junk, "en", "host-a"), (301, junk, "en", None), (302, junk, "fr", "host-b"), (303, junk, None, None)]
    few = [(400, text_of(50, 999, 5000), "fr", "host-c")]
    df = spark.createDataFrame(tail + large + odd + few, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules(df).collect()}
    assert len(got) == 105 and all(r["distance2"] is not None for r in got.values())
    assert [i for i in sorted(got) if not got[i]["kept"]] == [300, 301, 302, 303]

    def d2(rows):
        x = [brute.features(brute.statistics(r[1])) for r in rows]
        return dict(zip([r[0] for r in rows], brute.distances(x, FLOORS, factor=consistency(0.75))))

    english, table = d2(tail + large + odd[:2]), d2(tail + large + odd + few)
    for i, want in [*((r[0], english) for r in tail + odd[:2]), *((r[0], table) for r in odd[2:] + few),
                    *((r[0], d2(large)) for r in large[:3])]:
        assert got[i]["distance2"] == pytest.approx(want[i], rel=1e-6, abs=1e-9)


def test_long_lines_are_compared_by_their_bytes(docs_of):
    # a Thue-Morse line and its complement collide under every polynomial hash modulo 2^64
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    texts = [f"{one}\n{other}", f"{one}\n{other}\n{one}\n{other}\n{other}", f"{one}\n{other[:-1]}\n{one[:1024]}\n{other[:1024]}"]
    got = {r["doc_id"]: r["n_dup_lines"] for r in statistics(docs_of(enumerate(texts))).collect()}
    assert got == {0: 0, 1: 3, 2: 0}
    assert all(brute.statistics(t)["n_dup_lines"] == got[i] for i, t in enumerate(texts))


def _pools(spark, groups):
    rows = [(p, 1, k, *map(float, r)) for p, x in groups.items() for k, r in enumerate(x)]
    return spark.createDataFrame(rows, "pool string, salts long, slot int, x0 double, x1 double, x2 double, x3 double, x4 double")


def test_the_determinant_falls_and_the_least_is_kept(spark):
    r = np.random.default_rng(4)
    clean = r.normal(size=(300, 5)) @ r.normal(size=(5, 5)) * 3
    crowd = np.concatenate([clean[:240], r.normal(size=(60, 5)) * 0.1 + 40])  # a fifth lies close together, far away
    same = np.tile([3.0, 5.0, 0.0, 0.0, 0.1], (50, 1))
    groups = {"clean": clean, "crowd": crowd, "same": same, "one": same[:1]}
    rows = _pools(spark, groups)
    steps = [{(x["pool"], x["start"]): x["criterion"] for x in e.collect()} for e in concentrations(rows)]
    assert len(steps[0]) == len(steps[1]) == 12 and len(steps) < 30
    for before, after in zip(steps, steps[1:]):
        assert set(after) <= set(before)
        assert all(after[k] <= before[k] + TOLERANCE for k in after)
    est = {x["pool"]: x for x in estimates(rows).collect()}
    assert all(est[p]["criterion"] == min(c for e in steps for (q, _), c in e.items() if q == p) for p in groups)
    assert {p: est[p]["n"] for p in est} == {"clean": 300, "crowd": 300, "same": 50, "one": 1}
    m = np.array([est["crowd"][f"m{i}"] for i in range(5)])
    w = np.array([[est["crowd"][f"w{min(i, j)}{max(i, j)}"] for i in range(5)] for j in range(5)])
    d2 = np.einsum("ij,jk,ik->i", crowd - m, w, crowd - m) / consistency(0.75)
    assert (d2[240:] > 30).all() and (d2[:240] <= 30).all()


def test_raised_eigenvalues():
    inv, criterion = raised(np.diag(np.square(FLOORS)) * 4)
    assert np.allclose(inv, np.diag(1 / np.square(FLOORS)) / 4) and criterion == pytest.approx(5 * np.log(4) + 5)
    inv, criterion = raised(np.zeros((5, 5)))
    assert np.allclose(inv, np.diag(1 / np.square(FLOORS))) and criterion == 0


def test_salts_follow_the_pool(spark):
    est = spark.range(10_000).select(F.col("id").cast("string").alias("pool"), F.lit(30).cast("long").alias("n"))
    est = est.union(spark.createDataFrame([("hot", 2_500_000)], "pool string, n long"))
    assert salted(est).count() == 10_000 + 3


def test_equal_rows_of_a_hot_group_are_spread(docs_of, monkeypatch, text_of):
    from riskframe.llm import quality_rules as q

    texts = [text_of(40 + 7 * (k % 23), k, 5000) for k in range(60)] + [text_of(50, 1, 5000)] * 60
    df = docs_of(enumerate(texts))
    want = {r["doc_id"]: r["distance2"] for r in quality_rules(df).collect()}
    monkeypatch.setattr(q, "ROWS_PER_SALT", 25)
    got = {r["doc_id"]: r["distance2"] for r in quality_rules(df).collect()}
    assert set(got) == set(want) and all(got[i] == pytest.approx(want[i], rel=1e-6) for i in want)
