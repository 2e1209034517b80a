import gzip
import hashlib
import io
import os
import random

import pytest
from helpers import prose

from quayside.llm import queries, warc

PAGES = "page_id long, url string, html string, key int"


def brute(rows, least=1000):
    best = {}
    for p, _, h, *_ in rows:
        if p is not None:
            best[h or ""] = max(best.get(h or "", p), p)
    out = []
    for p, _, h, *_ in rows:
        raw, m = (h or "").encode(), best.get(h or "")
        again = len(raw) >= least and m is not None and p != m
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", m if again else None))
    return out


def _rows(seed=1):
    rnd = random.Random(seed)
    hot = "<p>" + prose(rnd, 300)
    rows = [(i, f"http://x/{i}", f"<p>{i} é " + prose(rnd, rnd.randint(0, 300)), 0) for i in range(150)]
    rows += [(1000 + i, f"http://y/{i}", hot, 0) for i in range(80)]
    rows += [(2000, "http://z/\r\nX: y z\x01", None, 0), (2001, None, "", 0), (2002, "u", "x" * 999, 0), (2003, "u", "x" * 999, 0), (2004, "u", "x" * 1000, 0), (2005, "u", "x" * 1000, 0),
             (2006, "u", "ü" * 500, 0), (2007, "u", "ü" * 500, 0), (-5, "u", "y" * 400_000, 0), (9, "dup", "again", 0), (None, "n", hot, 0), (None, "n2", "z" * 2000, 0), (None, "n3", "z" * 2000, 0)]
    rows += [(3000, "t", "w" * 3000, 0)] * 3
    return rows


def _key(r):
    return (r[0] is None, r[0] or 0, *r[1:4], r[4] or 0)


def test_round_trip_against_brute_force(spark, tmp_path):
    rows = _rows()
    target = f"file://{tmp_path}/a"
    warc.write_warc(spark.createDataFrame(rows, PAGES), target, shard_bytes=40_000, roll_bytes=5_000)
    back = warc.read_warc(spark, target).collect()
    got = [(r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back]
    assert sorted(got, key=_key) == sorted(brute(rows), key=_key)
    payload = {h.encode() for _, _, h, _ in rows if h} | {b""}
    assert all(bytes(r.payload) in payload for r in back if r.record_type == "response")
    urls = {r.url for r in back}
    assert None in urls and "http://z/%0D%0AX:%20y%20z%01" in urls
    assert len([f for f in os.listdir(f"{tmp_path}/a") if f.endswith(".warc.gz")]) > 10
    assert not [f for f in os.listdir(f"{tmp_path}/a") if f.endswith(".open")]


def test_same_files_for_other_partitioning(spark, tmp_path):
    data = spark.createDataFrame(_rows(2), PAGES)

    def files(name, df):
        warc.write_warc(df, f"file://{tmp_path}/{name}", shard_bytes=40_000, roll_bytes=5_000)
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/{name}/manifest").collect())

    assert files("a", data.repartition(5)) == files("b", data.repartition(2, "url"))


def test_files_are_sorted_standard_and_listed(spark, tmp_path):
    rows = [r for r in _rows(3) if r[0] is not None]
    warc.write_warc(spark.createDataFrame(rows, PAGES), f"file://{tmp_path}/a", shard_bytes=40_000, roll_bytes=5_000)
    for r in spark.read.parquet(f"{tmp_path}/a/manifest").collect():
        with open(f"{tmp_path}/a/{r.file}", "rb") as f:
            raw = f.read()
        assert (len(raw), hashlib.sha256(raw).hexdigest()) == (r.bytes, r.sha256)
        text = gzip.GzipFile(fileobj=io.BytesIO(raw)).read()
        assert text.startswith(b"WARC/1.1\r\n") and text.count(b"WARC-Record-ID: ") == r.records
        keys = [int(x.split(b"\r\n")[0]) for x in text.split(b"\r\nX-Row-Id: ")[1:]]
        assert keys == sorted(keys)


def test_unlisted_files_are_not_read(spark, tmp_path):
    target = f"file://{tmp_path}/a"
    warc.write_warc(spark.createDataFrame([(1, "u", "x", 0)], PAGES), target)
    with open(f"{tmp_path}/a/.part-00000000-00000.warc.gz.dead.open", "wb") as f:
        f.write(b"junk")
    with open(f"{tmp_path}/a/part-99999999-00000.warc.gz", "wb") as f:
        f.write(b"junk")
    assert warc.read_warc(spark, target).count() == 1


def test_a_task_tried_again_leaves_one_file(tmp_path):
    import pyarrow.fs as pafs

    fs, folder = pafs.FileSystem.from_uri(f"file://{tmp_path}")
    for _ in range(2):
        roll = warc._Roll(fs, folder, "part-0", 10)
        assert [m[0] for m in [*roll.add(b"x" * 20), *roll.close()]] == ["part-0-00000.warc.gz"]
    assert os.listdir(tmp_path) == ["part-0-00000.warc.gz"]


def test_damage_is_found():
    good = warc._gzip(warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None))
    assert len(list(warc.parse_records(good + good))) == 2
    with pytest.raises(ValueError):
        list(warc.parse_records(good + good[:-9]))


def test_empty(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], PAGES), f"file://{tmp_path}/a")
    assert warc.read_warc(spark, f"file://{tmp_path}/a").count() == 0


def test_query(spark):
    base = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{base}/pages.parquet").collect()]
    assert sorted(tuple(r) for r in queries.QUERIES["op4_warc"](spark, base).collect()) == sorted(brute(rows))


@pytest.mark.parametrize("ids", [lambda i: 2**62 if i == 77 else i, lambda i: -2**63 if i == 5 else 2**63 - 1 if i == 6 else i, lambda i: 123 if i % 3 == 0 else i, lambda i: None if i % 3 == 0 else 10**12 * (i % 7) + i])
def test_odd_ids_do_not_fill_a_shard(spark, tmp_path, ids):
    """An id far from all others, ids at both ends, one id or no id for a third of the rows."""
    rows = [(ids(i), f"u{i}", f"payload {i} " * 10, 0) for i in range(3000)]
    warc.write_warc(spark.createDataFrame(rows, PAGES), f"file://{tmp_path}/a", shard_bytes=20_000, roll_bytes=1 << 20)
    held = [r.records for r in spark.read.parquet(f"{tmp_path}/a/manifest").collect()]
    assert sum(held) == 3000 and len(held) >= 90 and max(held) <= 40
    got = warc.read_warc(spark, f"file://{tmp_path}/a").select("key", "url").collect()
    assert sorted((r.url, r.key is None, r.key or 0) for r in got) == sorted((u, k is None, k or 0) for k, u, _, _ in rows)


def test_shard_of_equals_a_search_of_pairs():
    import numpy as np
    rnd = np.random.default_rng(2)
    cuts = sorted({(int(a), int(b)) for a, b in rnd.integers(0, 12, (40, 2))})
    rows = rnd.integers(-1, 13, (500, 2))
    got = warc.shard_of((np.array([c[0] for c in cuts]), np.array([c[1] for c in cuts])), rows[:, 0], rows[:, 1])
    assert got.tolist() == [max(0, sum(c <= tuple(r) for c in cuts) - 1) for r in rows.tolist()]
