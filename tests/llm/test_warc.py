import gzip
import hashlib
import random
from pathlib import Path

from snapweave.llm import warc


def test_round_trip_and_revisits(spark, tmp_path):
    rng = random.Random(3)
    big = "".join(rng.choice("aé漢\n\r 0") for _ in range(200_000))
    same = "s" * 1500
    rows = [(1, "http://a/ b\r\nX: y", big), (2, None, None), (3, "u", ""), (4, "u", same), (9, "u", same), (7, "v", same),
            (9, "u", same), (5, "w", "short"), (6, "w", "short"), (None, "n", same), (None, "n", "n" * 1200),
            (11, "x", "0\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (12, "y", "\n"), (13, "y", "line\r")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    path = str(tmp_path / "w")
    warc.write(pages, path)
    got = sorted((r["record_key"] or "", r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or "")
                 for r in warc.read_records(spark, path).collect())
    want = []
    for k, _, h in rows:
        data = (h or "").encode()
        revisit = data == same.encode() and k != 9
        want.append((str(k) if k is not None else "", len(data), hashlib.sha1(data).hexdigest(),
                     "revisit" if revisit else "response", "9" if revisit else ""))
    assert got == sorted(want)
    # the chunk table gives the payload back, with running digests and bounded chunks
    chunks = warc.read_chunks(spark, path).filter("record_key = '1'").orderBy("chunk_no").collect()
    whole, sha = b"", hashlib.sha1()
    for c in chunks[:-1]:
        assert 0 < len(c["data"]) <= warc.CHUNK_BYTES
        whole += c["data"]
        sha.update(c["data"])
        assert (c["bytes_so_far"], c["sha1_so_far"]) == (len(whole), sha.hexdigest())
    assert whole == big.encode() and len(chunks) > 5
    # records by their own Content-Length, as another reader would find them
    types = []
    for file in sorted(Path(path).glob("part-*.gz")):
        data = gzip.decompress(file.read_bytes())
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            head = dict(x.split(b": ", 1) for x in data[at:end].split(b"\r\n")[1:])
            types.append(head[b"WARC-Type"])
            stop = end + 4 + int(head[b"Content-Length"])
            assert data[at:at + 8] == b"WARC/1.1" and data[stop:stop + 4] == b"\r\n\r\n"
            at = stop + 4
    assert len(types) == len(rows)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert warc.read_records(spark, path).count() == 0
