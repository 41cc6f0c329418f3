"""Downloads that are kept: each address once, whatever fails in between."""

import hashlib
import os
import urllib.error
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meetloom.sources import downloads, fetch


def counting(log, broken=None):
    """A fetcher that notes each request in a file, since tasks run in other processes. `broken` fails hard until its file is gone."""

    def get(url):
        with open(log, "a") as f:
            f.write(url + "\n")
        if broken and "broken" in url and os.path.exists(broken):
            os._exit(1)
        if "busy" in url:
            raise urllib.error.HTTPError(url, 503, "no", None, None)
        return f"body {url[-1]}".encode(), "text/html", url

    return get


def asked(log):
    return Counter(Path(log).read_text().split())


def test_each_address_is_fetched_once(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "kept")
    targets = spark.createDataFrame([(f"https://h{i % 3}/{i}",) for i in range(30)] + [("https://h0/0",), (None,)], "url string")
    got = downloads.download(targets, counting(log), root, run="a")
    manifest = fetch.write_manifest(fetch.processed(got), str(tmp_path / "m"))
    assert manifest == {"total": 30, "ready": 30, "needs_retry": 0, "needs_manual_review": 0, "download_failed": 0}
    assert set(asked(log).values()) == {1} and len(asked(log)) == 30
    assert downloads.run_totals(spark, root, "a") == {"fetched": 30, "known": 0, "new_files": 10, "new_bytes": 60}
    files = [p for p in Path(root, "sha256").rglob("*") if p.is_file()]
    assert len(files) == 10 and all(hashlib.sha256(p.read_bytes()).hexdigest() == p.name for p in files)
    before = {p: p.stat().st_mtime_ns for p in Path(root).rglob("*") if p.is_file() and "runs" not in str(p)}
    downloads.download(targets, counting(log), root, run="b")
    assert downloads.run_totals(spark, root, "b") == {"fetched": 0, "known": 30, "new_files": 0, "new_bytes": 0}
    assert before == {p: p.stat().st_mtime_ns for p in Path(root).rglob("*") if p.is_file() and "runs" not in str(p)}
    held = downloads.contents(got.where("url = 'https://h0/3'"), root).first()
    assert bytes(held["content"]) == b"body 3"
    assert "generated_at" in Path(tmp_path, "m/summary.json").read_text()


def test_a_killed_job_goes_on_where_it_was(spark, tmp_path):
    log, root, broken = str(tmp_path / "log"), str(tmp_path / "kept"), tmp_path / "broken"
    broken.touch()
    targets = spark.createDataFrame([(f"https://h/{i}",) for i in range(12)] + [("https://h/broken",)], "url string")
    with pytest.raises(Exception):  # noqa: B017
        downloads.download(targets, counting(log, str(broken)), root, run="a")
    assert not list(Path(root, "_staging").rglob("*.json")) and not any(p.is_file() for p in Path(root, "_staging").rglob("*"))
    broken.unlink()
    assert downloads.download(targets, counting(log, str(broken)), root, run="a").count() == 13
    times = asked(log)
    assert times.pop("https://h/broken") >= 2 and set(times.values()) == {1} and len(times) == 12


def test_passing_failures_are_tried_again_by_another_run(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "kept")
    targets = spark.createDataFrame([("https://h/busy",)], "url string")
    for run in ("a", "a", "b"):
        row = fetch.processed(downloads.download(targets, counting(log), root, run=run)).first()
    assert (row["processing_status"], row["sha256"], asked(log)["https://h/busy"]) == ("needs_retry", None, 2)


def test_a_host_has_its_pause(tmp_path):
    now, waits = [0.0], []

    def sleep(s):
        waits.append(round(s, 3))
        now[0] += s

    writer = downloads.sink(counting(str(tmp_path / "log")), 0.5, clock=lambda: now[0], sleep=sleep)({"path": str(tmp_path / "kept"), "run": "a"}).writer(None, False)
    told = writer.write(iter([{"url": u} for u in ("https://a/1", "https://b/1", "https://a/2", "https://a/3")]))
    assert told.fetched == 4 and waits == [0.5, 0.5]


def test_lanes_split_a_hot_host(spark):
    rows = spark.range(2000).select(F.concat(F.lit("https://hot/"), "id").alias("url")).unionByName(spark.range(20).select(F.concat(F.lit("https://h"), "id", F.lit("/")).alias("url")))
    parts = downloads.dealt(rows, lanes=2).select("url", F.spark_partition_id().alias("p"))
    hot = [r["count"] for r in parts.where("url like 'https://hot/%'").groupBy("p").count().collect()]
    assert len(hot) <= 2 and sum(hot) == 2000 and parts.select("p").distinct().count() > 1


def test_contents_of_rows_are_kept(spark, tmp_path):
    rows = spark.createDataFrame([(1, bytearray(b"x")), (2, bytearray(b"x")), (3, None)], "id long, content binary")
    got = sorted(map(tuple, downloads.keep_contents(rows, str(tmp_path)).collect()))
    digest = hashlib.sha256(b"x").hexdigest()
    assert got == [(1, digest, 1), (2, digest, 1), (3, None, None)]
    assert len([p for p in tmp_path.rglob("*") if p.is_file()]) == 1
