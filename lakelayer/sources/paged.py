"""Paged JSON API as a Spark data source (Python Data Source API).

One input partition per (resource, day) request, so the pages of different
resources and days are fetched by different tasks in parallel; inside a
partition the pages are followed by their ``next`` link. Each page becomes a
row with its body and audit fields; a page that still fails after the retries
becomes a ``failed`` row and ends that partition (the other partitions go on).

The transport is injected by name (option ``transport``):
* ``folder:<path>`` replays recorded responses: the body for a URL is the file
  ``<path>/<sha1(url)>.json`` (offline runs and tests; on a cluster the folder
  must be a mount every executor can read);
* ``<module>:<function>`` imports ``function(url) -> str`` on the executors.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import importlib
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lakelayer.operators.flatten import RESOURCES

# Records per page, tries per page, pause between tries (seconds).
PAGE_SIZE = 50
MAX_RETRIES = 3
RETRY_PAUSE_S = 2.0

PAGE_SCHEMA = ("resource string, day date, page_number int, url string, status string, error string, "
               "body string, records_on_page int, total_records long, next_url string")


def request_url(base_url: str, resource: str, day: dt.date, page_size: int = PAGE_SIZE) -> str:
    nxt = day + dt.timedelta(days=1)
    return (f"{base_url}/{resource}?_lastUpdated=ge{day.isoformat()}T00:00:00Z"
            f"&_lastUpdated=lt{nxt.isoformat()}T00:00:00Z&_count={page_size}&_format=json")


def recorded_name(url: str) -> str:
    return hashlib.sha1(url.encode()).hexdigest() + ".json"


def _transport(spec: str):
    if spec.startswith("folder:"):
        root = spec[len("folder:"):]

        def fetch(url: str) -> str:
            with open(f"{root}/{recorded_name(url)}", encoding="utf-8") as f:
                return f.read()
        return fetch
    mod, _, fn = spec.partition(":")
    return getattr(importlib.import_module(mod), fn)


def fetch_page(transport: str, url: str, retries: int = MAX_RETRIES, pause: float = RETRY_PAUSE_S) -> tuple:
    """(status, error, body, records, total, next URL) of one page. Network and server errors, and a body that is no JSON
    object, are tried again; after the last try the page is ``failed`` (with the body, if any) and links nowhere."""
    fetch, body, error = _transport(transport), None, None
    for attempt in range(retries):
        try:
            body = fetch(url)
            doc = json.loads(body)
            if not isinstance(doc, dict):
                raise ValueError("the body is no JSON object")
            nxt = next((l.get("url") for l in doc.get("link") or [] if l.get("relation") == "next"), None)
            return "success", None, body, len(doc.get("entry") or []), int(doc.get("total") or 0), nxt
        except Exception as exc:
            error = str(exc)
            if attempt + 1 < retries:
                time.sleep(pause)
    return "failed", error, body, 0, 0, None


class _Request(InputPartition):
    def __init__(self, resource: str, day: str):
        super().__init__((resource, day))
        self.resource, self.day = resource, day


class PagedApiReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base_url = options["base_url"]
        self.start = dt.date.fromisoformat(options["start"])
        self.end = dt.date.fromisoformat(options["end"])
        self.resources = [r for r in options.get("resources", ",".join(RESOURCES)).split(",") if r]
        self.transport = options["transport"]
        self.page_size = int(options.get("page_size", PAGE_SIZE))
        self.retries = int(options.get("max_retries", MAX_RETRIES))
        self.pause = float(options.get("retry_pause_s", RETRY_PAUSE_S))

    def partitions(self):
        days, d = [], self.start
        while d < self.end:                                   # half-open [start, end)
            days.append(d.isoformat())
            d += dt.timedelta(days=1)
        return [_Request(r, day) for r in self.resources for day in days]

    def read(self, partition: _Request):
        day = dt.date.fromisoformat(partition.day)
        url, page = request_url(self.base_url, partition.resource, day, self.page_size), 1
        while url:
            status, error, body, records, total, nxt = fetch_page(self.transport, url, self.retries, self.pause)
            yield (partition.resource, day, page, url, status, error, body, records, total, nxt)
            url, page = nxt, page + 1


class PagedApiSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lakelayer_paged"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedApiReader(self.options)


def fetch_pages(spark: SparkSession, base_url: str, start: str, end: str, transport: str,
                resources=RESOURCES, page_size: int = PAGE_SIZE, max_retries: int = MAX_RETRIES,
                retry_pause_s: float = RETRY_PAUSE_S) -> DataFrame:
    """Pages of every (resource, day) in ``[start, end)`` as a DataFrame (lazy)."""
    spark.dataSource.register(PagedApiSource)
    return (spark.read.format(PagedApiSource.name())
            .option("base_url", base_url).option("start", start).option("end", end)
            .option("resources", ",".join(resources)).option("transport", transport)
            .option("page_size", str(page_size)).option("max_retries", str(max_retries))
            .option("retry_pause_s", str(retry_pause_s)).load())


REQUEST_SCHEMA = "resource string, day date, page_number int, url string"


def crawl(spark: SparkSession, requests: DataFrame, root: str, transport: str, tasks: int = 32,
          max_retries: int = MAX_RETRIES, retry_pause_s: float = RETRY_PAUSE_S) -> DataFrame:
    """Fetch the pages of ``requests`` (resource, day, url) and all that they link to, resumably; returns the page rows.

    Requests are files under ``root``, and a stream over that folder is the memory of what was asked: its offsets
    say which (resource, day, link) are done. Each micro-batch fetches one page for every new request, in ``tasks`` tasks,
    stores the pages, and files their ``next`` links as new requests, until no page links on. After a failure, also
    of the driver, the same call goes on where it stopped: stored pages are not fetched again, and a batch whose
    pages were stored only files its links once more. Requests are taken from ``requests`` at the first call only.
    """
    from pyspark.sql import functions as F
    root = root.rstrip("/")
    asked, pages = f"{root}/requests", f"{root}/pages"

    def stored(path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    if not stored(f"{asked}/from=first"):
        (requests.select("resource", F.col("day").cast("date").alias("day"), F.lit(1).alias("page_number"), "url")
         .write.mode("overwrite").parquet(f"{asked}/from=first"))

    def fetch(batches):
        import pyarrow as pa
        for b in batches:
            for r in b.to_pylist():
                got = fetch_page(transport, r["url"], max_retries, retry_pause_s)
                row = (r["resource"], r["day"], r["page_number"], r["url"], *got)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    from pyspark.sql.pandas.types import to_arrow_schema
    schema = spark.createDataFrame([], PAGE_SCHEMA).schema
    arrow = to_arrow_schema(schema)
    names, types = arrow.names, arrow.types
    followed = []

    def each(batch: DataFrame, batch_id: int) -> None:
        mine, links = f"{pages}/batch={batch_id}", f"{asked}/from={batch_id}"
        if not stored(mine):
            batch.repartition(tasks).mapInArrow(fetch, schema).write.mode("overwrite").parquet(mine)
        onward = spark.read.schema(schema).parquet(mine).where("next_url IS NOT NULL").select(
            "resource", "day", (F.col("page_number") + 1).alias("page_number"), F.col("next_url").alias("url"))
        if not stored(links):
            onward.coalesce(1).write.mode("overwrite").parquet(links)
        followed.append(not onward.isEmpty())

    while True:
        followed.clear()
        q = (spark.readStream.schema(REQUEST_SCHEMA).parquet(f"{asked}/from=*").writeStream.foreachBatch(each)
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        if not any(followed):
            break
    return spark.read.schema(schema).parquet(f"{pages}/batch=*")


def land_pages(spark: SparkSession, pages: DataFrame, root: str, run_id: str) -> DataFrame:
    """Fetch once, then write the raw layer and append the audit rows.

    The fetched pages are first written under ``<root>/_fetched/run_id=<id>`` so the
    API is called exactly once per page (the raw files and the audit rows are
    both derived from that written copy, which also survives executor loss).
    Returns the audit rows.
    """
    from pyspark.sql import functions as F
    from lakelayer.sinks.tables import append, write_raw_pages
    staged = f"{root.rstrip('/')}/_fetched/run_id={run_id}"
    pages.write.mode("overwrite").parquet(staged)
    fetched = spark.read.parquet(staged)
    ok = fetched.filter(F.col("status") == "success")
    write_raw_pages(ok.select("resource", F.col("day").alias("date"), "body"), f"{root.rstrip('/')}/raw")
    audit = fetched.select(F.lit(run_id).alias("run_id"), F.col("resource").alias("resource_name"),
                           F.col("day").alias("ingest_date"), "page_number", F.col("url").alias("api_url"),
                           "records_on_page", "total_records",
                           F.current_timestamp().alias("extraction_timestamp"),
                           "status", F.col("error").alias("error_message"))
    append(audit, f"{root.rstrip('/')}/api_metadata", ["ingest_date"])
    return spark.read.parquet(f"{root.rstrip('/')}/api_metadata").filter(F.col("run_id") == run_id)
