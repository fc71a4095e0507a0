import hashlib

from corvane.llm.store import fresh_path
from corvane.llm.warc import archived_pages, read_archive, write_archive

SF = "/root/testdata/sf0.001"


def want(rows):
    first = {}
    for i, h in rows:
        if i is not None:
            b = (h or "").encode()
            first[b] = min(i, first.get(b, i))
    out = []
    for i, h in rows:
        b = (h or "").encode()
        again = len(b) >= 100 and i is not None and first[b] < i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in archived_pages(df).collect()), key=str)


def test_pages(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    assert got(df) == want([(r.page_id, r.html) for r in df.collect()])


def test_magic_in_payloads_and_small_splits(spark):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "a" * 99), (2, "a" * 99), (3, "b" * 100), (9, "b" * 100), (5, "b" * 100), (4, None), (6, ""), (None, "c" * 200), (8, "c" * 200)]
    rows += [(10, "x\r\n\r\nWARC/1.1\r\n" * 3), (11, f"start\r\n\r\n{inner}{inner}tail"), (12, f"\r\n\r\n{inner}"), (13, "é\r\n\r\nWARC/1.1\r\nContent-Length: 99999\r\n\r\n"), (14, "\r\n\r\n"), (15, "y" * 300_000)]
    rows += [(100 + i, f"page {i} " * (i % 40) + "\r\n\r\nWARC/1.1\r\n" * (i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame([(i, None if i == 3 else f"http://h/{i}\r\nX: y", h, "z") for i, h in rows], "page_id long, url string, html string, digest string")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    try:
        assert got(df.coalesce(2)) == want(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty(spark):
    assert got(spark.read.parquet(f"{SF}/pages.parquet").limit(0)) == []


def test_cut_archive(spark):
    path = fresh_path(spark, "archive")
    write_archive(spark.createDataFrame([(1, "u", "p" * 500), (2, "u", "q" * 500)], "page_id long, url string, html string").coalesce(1), path)
    import glob

    [part] = glob.glob(path.removeprefix("file:") + "/part-*")
    with open(part, "rb") as f:
        data = f.read()
    with open(part, "wb") as f:
        f.write(data[:-60])
    for crc in glob.glob(path.removeprefix("file:") + "/.*.crc"):
        open(crc, "wb").close()
    rows = {r.record_id: (r.payload_bytes, r.damaged) for r in read_archive(spark, path).collect()}
    assert rows == {"1": (500, False), "2": (None, True)}
