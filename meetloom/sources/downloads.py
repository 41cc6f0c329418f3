"""Downloads that are fetched once and kept: a data source writer whose rows are addresses.

Below the root, `sha256/ab/<digest>` holds contents by their SHA-256 and `receipts/ab/<sha1 of the address>.json` what became of
an address. A task fetches an address, puts its content in place by a rename, and then its receipt, which is the point of no
return: a task that runs again (a lost executor, a retry, a second run) finds the receipt and doesn't fetch again, and a task that dies leaves
nothing but a staged file, which the end of the job sweeps away. Equal contents of any number of addresses are one file.

Addresses are dealt by host and lane. A host has at most LANES lanes, a lane waits between two requests of a host, so a
host's budget of requests a second holds whatever the cluster's size.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import urlparse

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from meetloom.sources import fetch as net

LANES = 2
#: Columns of a receipt, which are those of a fetched row without its content.
RECEIPT = ", ".join(x for x in net.RESULTS.split(", ") if not x.startswith("content ")) + ", run string, fetched_at string"
_FIELDS = [x.split()[0] for x in RECEIPT.split(", ")]


class Kept:
    """A folder of contents by digest and receipts by address, on any file system that Arrow reaches."""

    def __init__(self, root: str):
        self.fs, self.base = pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)
        self.base = self.base.rstrip("/")

    def exists(self, path: str) -> bool:
        return self.fs.get_file_info(f"{self.base}/{path}").type == pafs.FileType.File

    def read(self, path: str) -> bytes:
        with self.fs.open_input_stream(f"{self.base}/{path}") as f:
            return f.read()

    def place(self, path: str, data: bytes, run: str) -> bool:
        """Put data at a path at once, by a rename of a staged file; False if it is there already."""
        if self.exists(path):
            return False
        staged = f"{self.base}/_staging/{run}/{uuid.uuid4().hex}"
        for folder in (staged, f"{self.base}/{path}"):
            self.fs.create_dir(folder.rpartition("/")[0], recursive=True)
        with self.fs.open_output_stream(staged) as f:
            f.write(data)
        self.fs.move(staged, f"{self.base}/{path}")
        return True

    def put(self, content: bytes, run: str) -> tuple[str, bool]:
        """(digest, whether it is new)."""
        digest = hashlib.sha256(content).hexdigest()
        return digest, self.place(content_path(digest), content, run)

    def receipt(self, url: str) -> dict | None:
        path = receipt_path(url)
        return json.loads(self.read(path)) if self.exists(path) else None

    def sweep(self, run: str) -> None:
        """Remove what tasks of a run left staged."""
        folder = f"{self.base}/_staging/{run}"
        if self.fs.get_file_info(folder).type == pafs.FileType.Directory:
            self.fs.delete_dir(folder)


def content_path(digest: str) -> str:
    return f"sha256/{digest[:2]}/{digest}"


def receipt_path(url: str) -> str:
    name = hashlib.sha1(url.encode()).hexdigest()
    return f"receipts/{name[:2]}/{name}.json"


def is_final(receipt: dict | None, run: str) -> bool:
    """Whether an address needs no further try: it was got, its failure is not of the kind that passes, or this run has tried."""
    if receipt is None:
        return False
    passes = receipt["error_kind"] == "url" or receipt["error_kind"] == "http" and (receipt["http_code"] >= 500 or receipt["http_code"] in (408, 429))
    return not passes or receipt["run"] == run


@dataclass
class Fetched(WriterCommitMessage):
    fetched: int = 0
    known: int = 0
    new_files: int = 0
    new_bytes: int = 0


def sink(fetch: net.Fetcher, pause: float = 0.0, tries: int = 3, follow: bool = False, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> type[DataSource]:
    """The data source `meetloom_downloads` with a fetcher: rows (url) written to it are fetched, a host's at least `pause` seconds apart in a task."""

    class Writer(DataSourceWriter):
        def __init__(self, root: str, run: str):
            self.root, self.run = root, run

        def write(self, rows: Iterator) -> Fetched:
            kept, told, last = Kept(self.root), Fetched(), {}
            for row in rows:
                if is_final(kept.receipt(row["url"]), self.run):
                    told.known += 1
                    continue
                host = urlparse(row["url"]).netloc.lower()
                if pause and host in last and (wait := last[host] + pause - clock()) > 0:
                    sleep(wait)
                got = net.fetch_one(row["url"], fetch, tries, follow)
                last[host] = clock()
                content = got.pop("content")
                if content is not None:
                    got["sha256"], new = kept.put(content, self.run)
                    told.new_files += new
                    told.new_bytes += len(content) * new
                receipt = got | {"run": self.run, "fetched_at": datetime.now(timezone.utc).isoformat()}
                path = receipt_path(row["url"])
                if kept.exists(path):
                    kept.fs.delete_file(f"{kept.base}/{path}")
                kept.place(path, json.dumps(receipt).encode(), self.run)
                told.fetched += 1
            return told

        def commit(self, messages: list) -> None:
            kept = Kept(self.root)
            kept.sweep(self.run)
            total = {k: sum(getattr(m, k) for m in messages if m) for k in ("fetched", "known", "new_files", "new_bytes")}
            kept.place(f"runs/{self.run}/{uuid.uuid4().hex}.json", json.dumps(total).encode(), self.run)
            kept.sweep(self.run)

        def abort(self, messages: list) -> None:
            Kept(self.root).sweep(self.run)

    class Downloads(DataSource):
        @classmethod
        def name(cls) -> str:
            return "meetloom_downloads"

        def schema(self) -> str:
            return "url string"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return Writer(self.options["path"], self.options["run"])

    return Downloads


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def dealt(targets: DataFrame, url: str = "url", lanes: int = LANES) -> DataFrame:
    """Distinct addresses by host and lane, hosts interleaved. The number of tasks is fixed: few bytes of addresses are long work."""
    rows = targets.select(F.col(url).alias("url")).where("url is not null").distinct()
    lane, tasks = F.pmod(F.xxhash64("url"), F.lit(lanes)), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, host_of(F.col("url")), lane).sortWithinPartitions(F.xxhash64("url"))


def download(targets: DataFrame, fetch: net.Fetcher, root: str, run: str | None = None, url: str = "url", requests_a_second: float | None = None, lanes: int = LANES, tries: int = 3, follow: bool = False) -> DataFrame:
    """Fetch what has no final receipt yet and return the receipts of all targets; contents stay below the root."""
    spark = targets.sparkSession
    spark.dataSource.register(sink(fetch, lanes / requests_a_second if requests_a_second else 0.0, tries, follow))
    dealt(targets, url, lanes).write.format("meetloom_downloads").mode("append").option("path", root).option("run", run or uuid.uuid4().hex).save()
    return receipts(targets, root, url)


def receipts(targets: DataFrame, root: str, url: str = "url") -> DataFrame:
    """Receipts of the targets, each looked up by its address, so a folder of any size is never listed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = Kept(root)
        for b in batches:
            found = [r for r in map(kept.receipt, b["url"].tolist()) if r is not None]
            yield pd.DataFrame(found, columns=_FIELDS).astype({"bytes_downloaded": "Int64", "http_code": "Int32"})

    return targets.select(F.col(url).alias("url")).where("url is not null").distinct().mapInPandas(run, RECEIPT)


def contents(rows: DataFrame, root: str) -> DataFrame:
    """Rows with a sha256, and their content. A digest is read once a row; rows without one have none."""
    schema = rows.drop("content").schema.add("content", "binary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = Kept(root)
        for b in batches:
            yield b.assign(content=[kept.read(content_path(d)) if isinstance(d, str) else None for d in b["sha256"]])

    return rows.drop("content").mapInPandas(run, schema)


def keep_contents(rows: DataFrame, root: str, run: str | None = None) -> DataFrame:
    """Rows with a content (mail attachments, files of a folder) to the same rows with sha256 and bytes_downloaded instead; contents are
    put below the root where their digest is new. Putting is repeatable, so a second pass over the rows writes nothing."""
    job = run or uuid.uuid4().hex
    schema = rows.drop("content").schema.add("sha256", "string").add("bytes_downloaded", "long")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = Kept(root)
        for b in batches:
            plain = [None if c is None else bytes(c) for c in b["content"]]
            yield b.drop(columns="content").assign(sha256=[None if c is None else kept.put(c, job)[0] for c in plain], bytes_downloaded=pd.array([None if c is None else len(c) for c in plain], "Int64"))

    return rows.mapInPandas(put, schema)


def run_totals(spark: SparkSession, root: str, run: str) -> dict[str, int]:
    """What the committed jobs of a run did."""
    names = ("fetched", "known", "new_files", "new_bytes")
    rows = spark.read.schema(", ".join(f"{n} long" for n in names)).json(f"{root}/runs/{run}")
    return rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first().asDict()
