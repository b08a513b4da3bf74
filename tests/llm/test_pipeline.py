from collections import defaultdict

import corpus_pipeline
from riskframe.llm.quality_rules import FLOORS, consistency
from riskframe.llm.shared import written

from . import brute

SF = "/root/testdata/sf0.001"


def _quality(docs, min_group=30):
    """Ids that the rules keep. A group of fewer than ``min_group`` rows is judged by the estimate of its
    language, or of the table if that has fewer too."""
    stats = {d["doc_id"]: brute.statistics(d["text"]) for d in docs}
    pools, keep = defaultdict(list), set()
    for d in docs:
        for pool in (("group", d["lang"], d["source"]), ("lang", d["lang"]), "table"):
            pools[pool].append(d["doc_id"])

    def distances(pool):
        ids = pools[pool]
        return dict(zip(ids, brute.distances([brute.features(stats[i]) for i in ids], FLOORS, factor=consistency(0.75))))

    known = {}
    for d in docs:
        pool = next(p for p in (("group", d["lang"], d["source"]), ("lang", d["lang"]), "table") if p == "table" or len(pools[p]) >= min_group)
        if pool not in known:
            known[pool] = distances(pool)
        s = stats[d["doc_id"]]
        failed = s["n_words"] < 20 or 100 * s["n_repeat_words"] > 30 * s["n_words"]
        if not failed and known[pool][d["doc_id"]] <= 30.0:
            keep.add(d["doc_id"])
    return keep


def test_stages_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    rows = [r.asDict() for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality_rules":
            keep = _quality(rows)
            texts = {i: t for i, t in texts.items() if i in keep}
        elif name == "line_dedup":
            out = brute.dedup_lines(list(texts.items()))
            texts = {i: t for i, (t, n) in out.items() if not n or brute.words(t)}
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect() if out[r["doc_id"]][1])
        elif name == "near_dedup":
            texts = {i: texts[i] for i, c in brute.components(list(texts.items())).items() if i == c}
        else:
            bad = {d for d, _ in brute.hits(list(texts.items()), items)}
            texts = {i: t for i, t in texts.items() if i not in bad}
        assert got == texts, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == set(texts)
    total = sum(r["length"] for r in packed)
    assert len({r["sequence_id"] for r in packed}) <= -(-total // 2048) * 1.02 + 1
    again = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, again)) == sorted(map(key, packed))


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_stages_keep_columns_with_clashing_names(spark):
    from pyspark.sql import functions as F

    names = ["_lines", "_kept", "_gone", "_g_id", "_k_id", "_k_text", "_q_id", "_q_text", "_q_group", "_h_id", "_h_text", "_n_removed", "_n_lines"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test-names")
        assert docs.columns[-len(names):] == names, name
        assert docs.where(" or ".join(f"`{n}` is null or `{n}` <> concat('{n}', doc_id)" for n in names)).count() == 0
        assert docs.count() > 50
