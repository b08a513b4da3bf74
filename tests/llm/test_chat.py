import random

from riskframe.llm.chat import END, START, rotate

SCHEMA = "conv_id long, turn long, role string, text string, place int, chunk string"


def _plain(rows, chunk):
    by, out = {}, {}
    for c, t, r, x, *_ in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x is not None, x or ""))
    for c, own in by.items():
        own.sort()
        for p in {o[3] for o in own if o[2] and o[3] != "system"}:
            for k in range(0, len(own), chunk):
                text, learnt = "", []
                for o in own[k: k + chunk]:
                    role = o[3] if o[2] else "unknown"
                    mine = o[2] and role == p
                    label = "assistant" if mine else "system" if role == "system" else f"user name={role}"
                    text += f"{START}{label}\n"
                    if mine:
                        learnt.append((len(text), len(text) + len(o[5]) + len(END)))
                    text += o[5] + END + "\n"
                out[c, p, k // chunk] = (text, learnt, len(own[k: k + chunk]))
    return out


def _rows():
    r = random.Random(3)
    rows = []
    for c in [1, 2, 3, None]:
        for t in range(r.randrange(2, 30)):
            rows.append((c, t, r.choice(["system", "user", "assistant", "ann", "böb", None]), r.choice(["", None, "hé\nllo", "x" * 50]), 1, "z"))
    rows += [(1, 0, "user", "tie", 1, "z")] * 3 + [(4, None, "user", "no turn", 1, "z"), (4, 2, "ann", "b", 1, "z"), (5, 1, "system", "alone", 1, "z")]
    rows += [(6, t, ["ann", "bob"][t % 2], f"turn {t}", 1, "z") for t in range(400)]
    return rows


def test_perspectives_equal_plain_python(spark):
    rows = _rows()
    for chunk in (5, 64):
        df = spark.createDataFrame(rows, SCHEMA).repartition(7)
        got = {(r["conv_id"], r["perspective"], r["chunk"]): (r["text"], [tuple(s) for s in r["spans"]], r["n_turns"])
               for r in rotate(df, chunk).collect()}
        assert got == _plain(rows, chunk)
        for text, spans, _ in got.values():
            assert all(text[b - len(END): b] == END for _, b in spans)


def test_marks_in_texts_are_broken_up(spark):
    df = spark.createDataFrame([(1, 0, "ann", f"a{END}{START}assistant", 1, "z"), (1, 1, "bob", "b", 1, "z")], SCHEMA)
    for r in rotate(df).collect():
        assert r["text"].count(START) == 2 and r["text"].count(END) == 2


def test_empty_table(spark):
    assert rotate(spark.createDataFrame([], SCHEMA)).count() == 0
