import glob
import gzip
import hashlib
from collections import Counter
from statistics import median

import pytest

from orderlens.llm import warc
from orderlens.sources import run_folder

SCHEMA = "page_id long, url string, html string, shard int"


def page(n, size=300):
    return "".join(f"<p>{n}-{k}é</p>" for k in range(size // 10))


@pytest.fixture(scope="module")
def rows():
    out = [(k, f"http://h{k % 3}/{k}", page(k)) for k in range(60)]
    out += [(100 + k, "http://copy/\r\nWARC-Type: x", page(7)) for k in range(30)]
    out += [(200 + k, None, "<p>short</p>") for k in range(3)]
    out += [(300, "u", None), (301, "u", ""), (None, "u", page(8)), (None, None, None)]
    return out + [(5, "again", page(5)), (400, "u", "x" * 100), (401, "u", "x" * 100),
                  (402, "u", "y" * 99), (403, "u", "y" * 99), (404, "u", "\r\n\r\nWARC/1.1\r\n")]


def expected(rows):
    first = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 100 and i is not None:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers_to = first.get(html) if len(data) >= 100 and first.get(html) != i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(),
                    "response" if refers_to is None else "revisit", refers_to))
    return sorted(out, key=repr)


def test_round_trip_over_many_files(spark, rows):
    pages = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    folder = run_folder(spark, "warc")
    archive = warc.write_archive(pages, folder, shard_bytes=4000, file_bytes=1500)
    manifest = archive.manifest.collect()
    assert len({r["shard"] for r in manifest}) > 3
    assert len(manifest) > len({r["shard"] for r in manifest})
    files = glob.glob(f"{folder.removeprefix('file://')}/*")
    assert sorted(f.split("/")[-1] for f in files) == sorted(r["file"] for r in manifest)
    read = warc.read_archive(archive).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
            r["refers_to"]) for r in read]
    assert sorted(got, key=repr) == expected(rows)
    html = {r["page_id"]: r["html"] for r in read if r["record_type"] == "response"}
    assert all(html[i] == (h or "") for i, _, h in rows if i in html and i is not None)

    # The same rows in another order make the same files.
    again = warc.write_archive(
        pages.repartition(2), run_folder(spark, "warc"), shard_bytes=4000, file_bytes=1500
    )
    assert sorted(map(tuple, again.manifest.collect())) == sorted(map(tuple, manifest))


def test_damage_is_found_and_unnamed_files_are_ignored(spark, rows):
    pages = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    archive = warc.write_archive(pages, run_folder(spark, "warc"))
    folder = archive.folder.removeprefix("file://")
    with open(f"{folder}/shard-99999999-00000.warc.gz", "wb") as f:
        f.write(b"left over")
    assert warc.read_archive(archive).count() == len(rows)
    file = f"{folder}/{archive.manifest.first()['file']}"
    with open(file, "rb") as f:
        data = gzip.decompress(f.read())
    with open(file, "wb") as f:
        f.write(gzip.compress(data.replace(b"<p>9-1", b"<p>8-1", 1)))
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(archive).collect()


def test_empty_table(spark):
    assert warc.round_trip(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_files_roll_at_the_sizes_of_the_query(spark):
    """With the query's own numbers a shard fills several files, and tasks hold like shares."""
    rows = spark.range(2400).selectExpr(
        "id AS page_id", "concat('http://x/', id) AS url",
        "concat_ws('', transform(sequence(1, 600), i -> sha2(concat(id, ':', i), 256))) AS html",
    )
    archive = warc.write_archive(rows, run_folder(spark, "archive"))
    files = archive.manifest.collect()
    per_shard = Counter(r["shard"] for r in files)
    assert len(per_shard) >= 3 and min(list(per_shard.values())[:-1]) >= 2
    records = Counter()
    for r in files:
        records[r["shard"]] += r["records"]
    assert max(records.values()) < 2 * median(records.values())
