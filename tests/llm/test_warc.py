import base64
import hashlib

import pytest

from riskframe.llm.warc import read_archive, read_index, write_archive

PAGES = [(1, "http://a/", "<p>x</p>", 0), (2, "http://b/", "<p>x</p>", 1), (3, None, None, 2), (4, "http://c/\r\nX: y", "", 3),
         (5, "http://d/", "é\u0000漢", 4), (6, "http://e/", "z" * 3_000_00, 5), (7, "http://f/", "z" * 3_000_00, 6),
         (7, "http://f2/", "z" * 3_000_00, 7), (None, "http://n/", "null id", 8), (None, "http://n/", "<p>x</p>", 9)]
SCHEMA = "page_id long, url string, html string, payload int"


def _digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def _archive(spark, rows, tmp_path, **options):
    path = str(tmp_path / "archive")
    write_archive(spark.createDataFrame(rows, SCHEMA), path, **options)
    return path


def test_records_round_trip(spark, tmp_path):
    path = _archive(spark, PAGES, tmp_path)
    rows = read_archive(spark, path).collect()
    last = {}
    for i, _, h, _ in PAGES:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, u, h, _ in PAGES:
        response = (-1 if i is None else i) == last[h or ""]
        want.append((str(i), len((h or "").encode()), _digest(h), "response" if response else "revisit",
                     None if response else last[h or ""], (h or "").encode()))
    got = [(str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in rows:
        raw = bytes(r["record"])
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and int(fields[b"Content-Length"]) == len(rest) - 4
        assert rest == (bytes(r["payload"]) if r["record_type"] == "response" else b"") + b"\r\n\r\n"
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({h or "" for _, _, h, _ in PAGES})


def test_short_payloads_are_responses(spark, tmp_path):
    rows = read_index(spark, _archive(spark, PAGES, tmp_path, least=9)).collect()
    assert {r["record_type"] for r in rows if r["payload_bytes"] < 9} == {"response"}
    assert [r["refers_to"] for r in rows if r["page_id"] == 6] == [7]


def test_damage_is_found(spark, tmp_path):
    path = _archive(spark, PAGES, tmp_path)
    from pyspark.sql import functions as F

    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.concat("payload", F.lit(b"!")))
    bad.write.parquet(str(tmp_path / "bad" / "payloads"))
    spark.read.parquet(f"{path}/headers").write.parquet(str(tmp_path / "bad" / "headers"))
    with pytest.raises(Exception, match="does not match its SHA-256"):
        read_index(spark, str(tmp_path / "bad")).collect()


def test_empty_table(spark, tmp_path):
    assert read_index(spark, _archive(spark, [], tmp_path)).count() == 0
