"""Clinical layer flow: raw bundle pages -> bronze -> silver (hash SCD2) -> gold.

``synth_pages`` turns the driver tables into bundle pages (the role mapping of
``roles.py``, plus missing-field cases chosen by key) so the page parser and the
flatteners run on data that grows with the tables. ``load_bronze`` is one job
over every day and resource type; ``load_silver`` applies the day snapshots in
order; ``run_medallion`` strings the layers together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakelayer.functions import record_hash
from lakelayer.operators.dedup import latest_per_key
from lakelayer.operators.flatten import ID_COLUMN, RESOURCES, flatten
from lakelayer.operators.scd import scd2_hash_history, scd2_hash_merge_parts
from lakelayer.plans import gold
from lakelayer.session import lean_disk, missing_path, run_concurrently
from lakelayer.plans.roles import ENCOUNTER, OBSERVATION, PATIENT, CONDITION, FROM_SQL, select_sql, table
from lakelayer.sinks.history import ReplayedHistory, replay
from lakelayer.sinks.tables import (HistoryStore, replace_partitions, shared, store_current, store_first, store_generation,
                                    store_days, store_write, write_raw_pages)
from lakelayer.sources.bundles import PAGE_SIZE, entries, read_pages

BASE_URL = "https://fhir.example.org/R4"


@dataclass(frozen=True)
class Context:
    """Where each layer lives; one folder per layer and resource."""
    root: str

    def raw(self) -> str:
        return f"{self.root.rstrip('/')}/raw"

    def bronze(self, resource: str) -> str:
        return f"{self.root.rstrip('/')}/bronze/{resource.lower()}"

    def silver(self, resource: str) -> str:
        return f"{self.root.rstrip('/')}/silver/{resource.lower()}"

    def replayed(self, resource: str) -> str:
        return f"{self.root.rstrip('/')}/silver_replayed/{resource.lower()}"

    def gold(self) -> str:
        return f"{self.root.rstrip('/')}/gold"


# ── synthetic pages from the driver tables ───────────────────────────────────

def _concept(code, display=None) -> Column:
    return F.struct(F.array(F.struct(code.alias("code"),
                                      (display if display is not None else F.lit(None).cast("string"))
                                      .alias("display"))).alias("coding"))


def _meta() -> Column:
    return F.struct(F.lit("2024-01-01T00:00:00Z").alias("lastUpdated"))


def _role(cols, name) -> Column:
    return F.expr(dict(cols)[name])


# Missing-field cases (by key): no name (k % 5 = 0), empty given names (k % 3 = 0),
# two phone entries, the later one wins (k % 7 = 0); encounter without subject
# (k % 11 = 0) or with an absolute patient URL (k % 13 = 0); observation with an
# empty effectiveDateTime and a period (line 2); condition onset from a period.
PATIENT_FLAT_SQL = {
    "family_name": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END",
    "given_name": "CASE WHEN c_custkey % 5 = 0 OR c_custkey % 3 = 0 THEN NULL ELSE concat(c_mktsegment, ' X') END",
    "phone": "CASE WHEN c_custkey % 7 = 0 THEN concat('+2-', cast(c_custkey as string)) ELSE "
             + dict(PATIENT)["phone"] + " END",
}
ENCOUNTER_FLAT_SQL = {
    "patient_id": "CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 "
                  f"THEN concat('{BASE_URL}/', cast(o_custkey as string)) ELSE cast(o_custkey as string) END",
}


def _page(key: Column, per_page: int) -> Column:
    return F.call_function("div", key, F.lit(per_page))


ROWS_PER_TASK = 250_000    # rendered entries that one task groups into pages
ROWS_PER_SHARE = 20_000_000    # source rows that are moved at a time

Share = tuple[int, int]    # (i, n): the pages whose number's hash has remainder i by n
EVERY: Share = (0, 1)


def _page_tasks(df: DataFrame, share: Share = EVERY) -> int:
    """Tasks that a share of ``df`` is dealt to by page. The count comes from the file footers; without it AQE would size the
    tasks by the narrow source rows, a tenth of the text they become, and the grouping would spill that text."""
    return -(-df.count() // (ROWS_PER_TASK * share[1])) or 1


def _by_page(df: DataFrame, key: Column, per_page: int, tasks: int, share: Share = EVERY) -> DataFrame:
    """Hash-partition the source rows of a share of the pages by page before rendering them.

    Grouping entries into pages needs this shuffle anyway; doing it first lets
    the per-entry JSON rendering run on every task instead of on the scan tasks.
    """
    page, (i, n) = _page(key, per_page), share
    if n > 1:
        df = df.where(F.pmod(F.xxhash64(page), F.lit(n)) == i)
    return df.repartition(tasks, page)


def patient_resources(spark: SparkSession, d: str, share: Share = EVERY) -> DataFrame:
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
    k = F.col("c_custkey")
    j = _by_page(j, k, PAGE_SIZE, _page_tasks(c, share), share)
    name = F.when(k % 5 == 0, F.lit(None)).otherwise(F.array(F.struct(
        F.col("c_name").alias("family"),
        F.when(k % 3 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.col("c_mktsegment"), F.lit("X"))).alias("given"))))
    tel = lambda s, v: F.struct(F.lit(s).alias("system"), v.alias("value"))
    phone1, email = _role(PATIENT, "phone"), _role(PATIENT, "email")
    telecom = F.when(k % 7 == 0, F.array(tel("phone", phone1), tel("email", email),
                                         tel("phone", F.concat(F.lit("+2-"), k.cast("string"))))) \
        .otherwise(F.array(tel("phone", phone1), tel("email", email)))
    res = F.struct(
        F.lit("Patient").alias("resourceType"), k.cast("string").alias("id"), _meta().alias("meta"),
        name.alias("name"), _role(PATIENT, "gender").alias("gender"),
        _role(PATIENT, "birth_date").alias("birthDate"),
        F.array(F.struct(_role(PATIENT, "city").alias("city"), _role(PATIENT, "state").alias("state"),
                         _role(PATIENT, "country").alias("country"),
                         _role(PATIENT, "postal_code").alias("postalCode"))).alias("address"),
        telecom.alias("telecom"),
        F.array(F.struct(_concept(F.lit("en"), F.lit("English")).alias("language"))).alias("communication"),
        _role(PATIENT, "active").alias("active"))
    return j.select(F.lit("Patient").alias("resource"), k.alias("_k"), _page(k, PAGE_SIZE).alias("page"),
                    res.alias("res"))


def encounter_resources(spark: SparkSession, d: str, share: Share = EVERY) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, d, "orders")
    o = _by_page(o, k, PAGE_SIZE, _page_tasks(o, share), share)
    subject = F.when(k % 11 == 0, F.lit(None)).otherwise(F.struct(
        F.when(k % 13 == 0, F.concat(F.lit(f"{BASE_URL}/Patient/"), F.col("o_custkey").cast("string")))
        .otherwise(F.concat(F.lit("Patient/"), F.col("o_custkey").cast("string"))).alias("reference")))
    res = F.struct(
        F.lit("Encounter").alias("resourceType"), k.cast("string").alias("id"), _meta().alias("meta"),
        _role(ENCOUNTER, "status").alias("status"),
        F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("display")).alias("class"),
        F.array(_concept(_role(ENCOUNTER, "type_code"), F.col("o_orderpriority"))).alias("type"),
        subject.alias("subject"),
        F.struct(_role(ENCOUNTER, "period_start").alias("start"),
                 F.lit(None).cast("string").alias("end")).alias("period"),
        F.struct(_role(ENCOUNTER, "service_provider").alias("display")).alias("serviceProvider"))
    return o.select(F.lit("Encounter").alias("resource"), k.alias("_k"), _page(k, PAGE_SIZE).alias("page"),
                    res.alias("res"))


def _lines_by_page(spark, d, per_page: int, share: Share) -> DataFrame:
    """Lines with their order, by page. Both tables are dealt by page first, so the join and the grouping into pages move
    the lines no second time."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    tasks, line, order = _page_tasks(li, share), F.col("l_orderkey"), F.col("o_orderkey")
    return _by_page(li, line, per_page, tasks, share).join(
        _by_page(o, order, per_page, tasks, share), (_page(line, per_page) == _page(order, per_page)) & (line == order), "inner")


def _refs():
    return (F.struct(F.concat(F.lit("Patient/"), F.col("o_custkey").cast("string")).alias("reference")),
            F.struct(F.concat(F.lit("Encounter/"), F.col("l_orderkey").cast("string")).alias("reference")))


def observation_resources(spark: SparkSession, d: str, share: Share = EVERY) -> DataFrame:
    j = _lines_by_page(spark, d, 8, share)
    subj, enc = _refs()
    day = _role(OBSERVATION, "effective_datetime")
    line2 = F.col("l_linenumber") == 2
    res = F.struct(
        F.lit("Observation").alias("resourceType"), _role(OBSERVATION, "observation_id").alias("id"),
        _meta().alias("meta"), _role(OBSERVATION, "status").alias("status"),
        F.array(_concept(F.lit("laboratory"))).alias("category"),
        _concept(_role(OBSERVATION, "code"), _role(OBSERVATION, "code_display")).alias("code"),
        subj.alias("subject"), enc.alias("encounter"),
        F.when(line2, F.lit("")).otherwise(day).alias("effectiveDateTime"),
        F.when(line2, F.struct(day.alias("start"))).alias("effectivePeriod"),
        F.struct(F.col("l_quantity").alias("value"), F.lit("unit").alias("unit")).alias("valueQuantity"),
        F.array(F.struct(_concept(F.col("l_suppkey").cast("string")).alias("code"),
                         F.struct(F.col("l_discount").alias("value"), F.lit("%").alias("unit"))
                         .alias("valueQuantity"))).alias("component"))
    return j.select(F.lit("Observation").alias("resource"), F.col("l_orderkey").alias("_k"),
                    _page(F.col("l_orderkey"), 8).alias("page"), res.alias("res"))


def condition_resources(spark: SparkSession, d: str, share: Share = EVERY) -> DataFrame:
    j = _lines_by_page(spark, d, PAGE_SIZE, share)
    subj, enc = _refs()
    res = F.struct(
        F.lit("Condition").alias("resourceType"), _role(CONDITION, "condition_id").alias("id"),
        _meta().alias("meta"),
        _concept(_role(CONDITION, "clinical_status")).alias("clinicalStatus"),
        _concept(F.lit("confirmed")).alias("verificationStatus"),
        F.array(_concept(F.lit("problem-list-item"))).alias("category"),
        _concept(_role(CONDITION, "code"), _role(CONDITION, "code_display")).alias("code"),
        subj.alias("subject"), enc.alias("encounter"),
        F.struct(_role(CONDITION, "onset_datetime").alias("start")).alias("onsetPeriod"),
        _concept(F.col("l_returnflag")).alias("severity"))
    return j.select(F.lit("Condition").alias("resource"), F.col("l_orderkey").alias("_k"),
                    _page(F.col("l_orderkey"), PAGE_SIZE).alias("page"), res.alias("res"))


RESOURCE_BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "Patient": patient_resources, "Encounter": encounter_resources,
    "Observation": observation_resources, "Condition": condition_resources,
}
SOURCES = {"Patient": "customer", "Encounter": "orders", "Observation": "lineitem", "Condition": "lineitem"}


def _page_url(resource: Column, day: Column, page: Column) -> Column:
    return F.format_string("%s/%s?_lastUpdated=ge%s&_count=%d&_page=%d", F.lit(BASE_URL), resource,
                           F.date_format(day, "yyyy-MM-dd"), F.lit(PAGE_SIZE), page.cast("int"))


def bundle_pages(resources: DataFrame, day: str, keep_page: bool = False) -> DataFrame:
    """Group resources into pages (bounded: one key range per page) and render the bundle JSON.

    Each entry is rendered to JSON text before the shuffle, so only strings move.
    Pages whose number is a multiple of 17 carry no self link (the reader then
    uses the file path); a full page links to the next one.
    """
    d = F.lit(day).cast("date")
    pages = (resources.select("resource", "page", F.to_json(F.struct(F.col("res").alias("resource"))).alias("ej"))
             .groupBy("resource", "page").agg(F.collect_list("ej").alias("items")))  # reuses _by_page
    n = F.size("items")
    self_link = F.struct(F.lit("self").alias("relation"), _page_url(F.col("resource"), d, F.col("page")).alias("url"))
    next_link = F.struct(F.lit("next").alias("relation"),
                         _page_url(F.col("resource"), d, F.col("page") + 1).alias("url"))
    links = F.filter(F.array(F.when(F.col("page") % 17 != 0, self_link), F.when(n >= PAGE_SIZE, next_link)),
                     lambda x: x.isNotNull())
    body = F.concat(F.lit('{"resourceType":"Bundle","total":'), n.cast("string"), F.lit(',"link":'),
                    F.to_json(links), F.lit(',"entry":['), F.array_join("items", ","), F.lit("]}"))
    return pages.select("resource", d.alias("date"), body.alias("body"), *(["page"] if keep_page else []))


def synth_raw(spark: SparkSession, d: str, raw_root: str, day: str = "2024-01-01",
              resources=RESOURCES, adjust: Callable[[str, DataFrame], DataFrame] | None = None) -> None:
    """Write one day of pages for the given resource types under ``raw_root``.

    The types take turns, a large one in shares of its pages: a share's source rows are moved, its pages are written and
    the moved rows are gone before the next share begins. So beside the pages the disk holds one share's rows, whatever
    the tables' size, and every share reads its tables anew. A type's first pages replace its folder of that day and
    the others are added, so a load that broke off is put right by the next. No two calls may write the same
    ``raw_root`` at once.
    """
    with lean_disk(spark):
        for r in resources:
            n = -(-table(spark, d, SOURCES[r]).count() // ROWS_PER_SHARE) or 1
            landed = 0
            for i in range(n):
                res = RESOURCE_BUILDERS[r](spark, d, (i, n))
                if adjust is not None:
                    res = adjust(r, res)
                seen = Observation(f"landed_{uuid.uuid4().hex[:8]}")
                land_pages(bundle_pages(res, day).observe(seen, F.count(F.lit(1)).alias("pages")), raw_root, add=landed > 0)
                landed += int(seen.get.get("pages", 0) or 0)


def land_pages(pages: DataFrame, raw_root: str, add: bool = False) -> None:
    """Write grouped pages from the tasks that grouped them, compressed: their text is neither moved nor stored plainly."""
    write_raw_pages(pages, raw_root, compression="gzip", gather=False, add=add)


# ── oracle text for the flatteners ───────────────────────────────────────────

def flat_sql(role: str) -> str:
    cols = {"patient": PATIENT, "encounter": ENCOUNTER, "observation": OBSERVATION, "condition": CONDITION}[role]
    over = {"patient": PATIENT_FLAT_SQL, "encounter": ENCOUNTER_FLAT_SQL}.get(role, {})
    cols = [(n, over.get(n, e)) for n, e in cols]
    return f"SELECT {select_sql(cols)} FROM {FROM_SQL[role]}"


# ── bronze / silver / gold ───────────────────────────────────────────────────

def bronze_frames(pages, extraction_ts: Column | None = None) -> dict[str, DataFrame]:
    """Flattened, hashed, per-day-deduplicated rows for each resource type (not yet written).

    ``pages``: one DataFrame of all pages, or a function resource -> that type's pages.
    """
    ts = F.current_timestamp() if extraction_ts is None else extraction_ts
    out = {}
    for r in RESOURCES:
        # the raw folder is partitioned by resource: each type reads only its own pages
        mine = pages(r) if callable(pages) else pages.filter(F.col("resource_name") == F.lit(r))
        ents = entries(mine, keep=("api_url",))
        flat = flatten(ents, r, keep=("api_url", "date"))
        flat = (flat.withColumn("ingest_date", F.to_date("date")).drop("date")
                .withColumn("extraction_timestamp", ts).withColumn("bronze_load_timestamp", ts))
        # moved as bytes, half of the text; they have the text's order
        flat = flat.withColumn("record_hash", F.unhex(record_hash(flat)))
        key = ID_COLUMN[r]
        # latest entry per id and day: last_updated, then api_url, then hash decide
        latest = latest_per_key(flat, [key, "ingest_date"],
                                [F.col("last_updated"), F.col("api_url"), F.col("record_hash")])
        out[r] = latest.withColumn("record_hash", F.lower(F.hex("record_hash")))
    return out


def raw_days(pages: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Pages of the landing days in ``[start, end)``; the ``date`` folders outside it are not read."""
    day = F.col("date").cast("date")
    if start is not None:
        pages = pages.filter(day >= F.lit(start).cast("date"))
    return pages if end is None else pages.filter(day < F.lit(end).cast("date"))


def load_bronze(spark: SparkSession, ctx: Context, extraction_ts: Column | None = None, start: str | None = None,
                end: str | None = None) -> None:
    """Raw days in ``[start, end)`` (an open bound: all) of every resource type; each (resource, day) partition read is
    replaced, other days stay. The rows are written by the tasks that chose each id's latest one. The types take turns:
    each moves all of its rows, and only one type's moved rows are on disk at a time."""
    frames = bronze_frames(lambda r: raw_days(read_pages(spark, ctx.raw(), resource=r), start, end), extraction_ts)
    with lean_disk(spark):
        for r, df in frames.items():
            replace_partitions(df, ctx.bronze(r), ["ingest_date"], gather=False)


ROWS_PER_TURN = 10_000_000    # stored rows that silver and gold move at a time


def _turns(stored: DataFrame) -> int:
    return -(-stored.count() // ROWS_PER_TURN) or 1


def load_silver(spark: SparkSession, ctx: Context, start: str, end: str,
                clock: Callable[[Column], Column] | None = None) -> None:
    """Apply the bronze day slices in ``[start, end)`` to each silver history, in day order.

    An empty history takes the closed form (one job for all days); an existing
    one is merged day by day, each day written as a new generation. The store
    records a mark (row count and hash sum) of every day it holds: a day that is
    new, late or corrected is merged, and the days of the range behind it once
    more in order, so the newest day has the last word. Days that are unchanged
    and not behind such a day are left out. The types take turns, as in bronze,
    and a large type's first load goes in turns by key.
    """
    import datetime as dt
    clock = clock or (lambda day: F.current_timestamp())
    s, e = dt.date.fromisoformat(start), dt.date.fromisoformat(end)

    def one(r: str) -> None:
        key, store = ID_COLUMN[r], HistoryStore(ctx.silver(r))
        try:
            bronze = spark.read.option("mergeSchema", "true").parquet(ctx.bronze(r))
        except AnalysisException as exc:                 # no bronze data for this resource yet
            if not missing_path(exc):
                raise
            return
        in_range = bronze.filter((F.col("ingest_date") >= F.lit(s)) & (F.col("ingest_date") < F.lit(e)))
        mark = F.concat_ws(":", F.count(F.lit(1)), F.sum(F.xxhash64(key, "record_hash").cast("decimal(38,0)")))
        held = {str(x["ingest_date"]): x["mark"] for x in in_range.groupBy("ingest_date").agg(mark.alias("mark")).collect()}
        last = store_generation(spark, store)
        if last is None:                          # first load: all days in one job
            parts = shared(in_range, key, _turns(in_range))
            store_first(spark, store, [scd2_hash_history(p, key, clock=clock) for p in parts],
                        loaded_through=max(held, default=None), days=held)
            return
        seen = store_days(spark, store)
        first = min((d for d in held if seen.get(d) != held[d]), default=None)
        current, gen = store_current(spark, store, last), last
        for day in sorted(d for d in held if first is not None and d >= first):   # each depends on the one before
            gen += 1
            on = dt.date.fromisoformat(day)
            batch = in_range.filter(F.col("ingest_date") == F.lit(on))
            closed, fresh = scd2_hash_merge_parts(current, batch, key, F.lit(on), load_ts=clock(F.lit(on)))
            # days behind this one are open until merged again, also after a crash
            seen = seen | {day: held[day]} | {d: "" for d in held | seen if d > day}
            store_write(spark, store, closed, fresh, gen, loaded_through=max(seen), days=seen)
            current = store_current(spark, store, gen)      # the generation just committed

    with lean_disk(spark):
        for r in RESOURCES:
            one(r)


def replay_silver(spark: SparkSession, ctx: Context, clock: Callable[[Column], Column] | None = None) -> dict[str, list]:
    """Bring a history of each resource type up to all of its bronze days: late, corrected and missing days are replayed
    for the keys they affect (``sinks.history``). Returns the changed days. ``load_silver`` applies days in load
    order instead and keeps what an earlier order made of them."""
    def one(r: str) -> list:
        try:
            bronze = spark.read.option("mergeSchema", "true").parquet(ctx.bronze(r))
        except AnalysisException as exc:                 # no bronze data for this resource yet
            if not missing_path(exc):
                raise
            return []
        return replay(spark, ReplayedHistory(ctx.replayed(r), ID_COLUMN[r]), bronze, clock)

    return dict(zip(RESOURCES, run_concurrently([lambda r=r: one(r) for r in RESOURCES])))


def gold_models(spark: SparkSession, ctx: Context) -> dict[str, DataFrame]:
    """Gold reads only the current part of each silver history."""
    silver = {r.lower(): store_current(spark, HistoryStore(ctx.silver(r))) for r in RESOURCES}
    return gold.build_gold(silver)


def run_medallion(spark: SparkSession, ctx: Context, start: str, end: str,
                  clock: Callable[[Column], Column] | None = None, publish: bool = True) -> dict[str, DataFrame]:
    """raw pages (already fetched) -> bronze -> silver -> gold; returns the gold frames."""
    load_bronze(spark, ctx, start=start, end=end)
    load_silver(spark, ctx, start, end, clock)
    models = gold_models(spark, ctx)
    if publish:
        with lean_disk(spark):                  # one after another, as in bronze
            turns = {n: _turns(store_current(spark, HistoryStore(ctx.silver(m.role)))) for n, m in gold.MODELS.items() if m.sides}
            paths = gold.publish(models, ctx.gold(), shares=turns)
        return {k: spark.read.parquet(p) for k, p in paths.items()}
    return models
