import random

import numpy as np
import pyarrow as pa

from riskframe.llm.decontamination import BITMAP_BITS, RADIUS, bitmap_width, drop_contaminated, hits, simhash
from riskframe.llm.textcols import mix

from . import brute


def test_hits_equal_plain_python(spark, docs_of, text_of, odd_texts):
    r = random.Random(2)
    items = [(k, text_of(r.randrange(6, 60), 300 + k, 300)) for k in range(12)]
    items += [(50, "one"), (51, "x y z"), (52, None), (53, ""), (54, items[0][1]), (None, text_of(30, 999))]
    texts = list(odd_texts)
    for k in range(40):
        w = r.choice(items[:12])[1].split()
        for _ in range(r.randrange(3)):
            w[r.choice([0, len(w) - 1, r.randrange(len(w))])] = "changed"
        texts.append(" ".join([text_of(r.randrange(40), 800 + k), r.choice(["", "\n"]), " ".join(w).upper(), text_of(r.randrange(40), 900 + k)]))
    texts += ["say x y z now", "X Y Z", items[0][1] + " " + items[0][1]]
    bench = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, m int, fa int")
    docs = docs_of(enumerate(texts))
    got = {(x["doc_id"], x["item_id"]): (round(x["similarity"], 9), x["start"]) for x in hits(docs, bench).collect()}
    assert got == brute.hits(list(enumerate(texts)), items)
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {x["doc_id"] for x in kept.collect()} == set(range(len(texts))) - {d for d, _ in got}
    assert hits(docs.limit(0), bench).count() == 0 and hits(docs, bench.limit(0)).count() == 0
    assert drop_contaminated(docs, bench.limit(0)).count() == len(texts)


def test_similar_windows_lie_within_the_radius():
    r = np.random.default_rng(3)
    far = []
    for _ in range(300):
        a = mix(r.integers(0, 1 << 40, 28).astype(np.uint64))
        b = a.copy()
        b[:4] = mix(r.integers(0, 1 << 40, 4).astype(np.uint64))  # 24 common of 32
        f = simhash(np.concatenate([a, b]), np.array([0, 28, 56]))
        far.append(sum(bin(int(x)).count("1") for x in f[0] ^ f[1]))
    assert max(far) <= RADIUS and 12 < np.mean(far) < 32


def test_documents_shorter_than_an_item(spark, docs_of, text_of):
    r = random.Random(5)
    items = [(k, text_of(n, 400 + k)) for k, n in enumerate((5, 6, 8, 20, 40, 41, 60))]
    texts = []
    for _, t in items:
        w = t.split()
        for n in range(len(w) + 2):  # each head of an item, some with a changed word or an added one
            texts.append(" ".join(w[:n]))
            texts.append(" ".join(w[len(w) - min(n, len(w)):] + ["more"]))
            if n:
                at = r.randrange(n)
                texts.append(" ".join(w[:at] + ["changed"] + w[at + 1:n]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): (round(x["similarity"], 9), x["start"]) for x in hits(docs_of(enumerate(texts)), bench).collect()}
    want = brute.hits(list(enumerate(texts)), items)
    assert got == want
    assert any(len(texts[d].split()) < len(items[i][1].split()) for d, i in want)


def test_bitmap_follows_the_items():
    low, high = BITMAP_BITS
    assert bitmap_width(0) == bitmap_width(1000) == low and bitmap_width(10 ** 9) == high
    for n in (40_000, 200_000, 500_000):
        assert 256 * 2 * n <= 1 << bitmap_width(n) <= 512 * 2 * n
