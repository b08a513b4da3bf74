import random

from pyspark.sql import functions as F

from riskframe.llm.line_dedup import count_names, dedup_lines

from . import brute


def test_equal_to_plain_python(docs_of, text_of, odd_texts):
    r = random.Random(1)
    lines = [text_of(r.randrange(1, 9), k) for k in range(60)]
    texts = odd_texts + ["a\n" * 12, "a\nb\nc\n\na\n \nb\nc", "x\n\n\ny", "\n", "\n\n"]
    for k in range(60):
        a = r.randrange(50)
        own = [text_of(4, 500 + k)] + lines[a: a + r.randrange(2, 9)] + ["", "  "][: r.randrange(3)] + [text_of(3, 700 + k)]
        texts.append("\n".join(own))
    ids = list(range(len(texts)))
    r.shuffle(ids)
    pairs = list(zip(ids, texts))
    df = docs_of(pairs)
    out = dedup_lines(df)
    assert out.columns == [c for c in df.columns if c != "text"] + ["text", "_n_lines", "_n_removed"]
    got = {x["doc_id"]: (x["text"], x["_n_removed"]) for x in out.collect()}
    assert got == brute.dedup_lines(pairs)


def test_repeated_rows_and_empty_table(docs_of):
    t = "a\nb\nc\nd"
    df = docs_of([(1, t), (1, t), (None, "q\na\nb\nc"), (2, t), (3, None)])
    got = sorted((str(r["doc_id"]), r["text"], r["_n_removed"]) for r in dedup_lines(df).collect())
    # a null id is the smallest, so a, b, c are first there; b, c, d are first in document 1
    assert got == [("1", "d", 3), ("1", "d", 3), ("2", "", 4), ("3", None, 0), ("None", "q\na\nb\nc", 0)]
    assert dedup_lines(df.limit(0)).count() == 0


def test_clashing_names_pass_through(docs_of):
    names = ["_lines", "_kept", "_gone", "_g_id", "_g_text", "_worded", "_out", "_n_lines", "_n_removed", "a.b"]
    df = docs_of([(1, "a\nb\nc\nd"), (2, "a\nb\nc\ne"), (3, None)]).withColumns(
        {n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    assert count_names(df) == ("__n_lines", "__n_removed")
    out = dedup_lines(df)
    assert out.columns == [c for c in df.columns if c != "text"] + ["text", "__n_lines", "__n_removed"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert [(rows[i]["text"], rows[i]["__n_removed"]) for i in (1, 2, 3)] == [("a\nb\nc\nd", 0), ("e", 3), (None, 0)]
    assert all(rows[i][n] == f"{n}{i}" for i in rows for n in names)
