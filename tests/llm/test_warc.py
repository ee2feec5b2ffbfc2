import hashlib

import pytest

from telemill.llm import warc

INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ROWS = [
    (1, "http://a/", "x" * 1500), (2, "http://b/\r\nWARC-Type: evil", "x" * 1500), (3, None, None), (4, "u", ""),
    (5, "u", "y" * 999), (6, "u", "y" * 999), (7, "http://ü/", f"before {INNER}after é{INNER}WARC/1.0\r\n"), (8, "u", INNER),
    (9, "u", "WARC/1."), (10, "u", "\r\n\r\n" * 300), (11, "u", "\r\n\r\n" * 300), (None, "u", "x" * 1500),
    (12, "u", "z" * 5000 + INNER * 40), (13, "u", "z" * 5000 + INNER * 40),
]


def expected(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        first = max(same) if same and len(data) >= 1000 else i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if i == first else "revisit",
                    None if i == first else first))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split", ["300", "128m"])
@pytest.mark.parametrize("per_file", [3])
def test_round_trip(spark, tmp_path, split, per_file):
    df = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, digest string")
    path = str(tmp_path / "w")
    warc.write(df.coalesce(2), path, records_per_file=per_file)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert all(r.intact for r in got)
    rows = [(int(r.record) if r.record else None, r.payload_bytes, r.payload_digest, r.type,
             int(r.refers) if r.refers else None) for r in got]
    assert sorted(rows, key=repr) == expected(ROWS)


def test_truncated_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", "p" * 50 + str(i)) for i in range(4)], "page_id long, url string, html string")
    warc.write(df.coalesce(1), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("part-*")
    cut = tmp_path / "cut.warc"
    cut.write_bytes(file.read_bytes()[:-30])
    assert sorted(r.record for r in warc.read(spark, str(cut)).collect()) == ["0", "1", "2"]
    warc.write(df.limit(0), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).collect() == []
