"""Loading feeds into stored tables, in one go or as a stream of landed files."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldledger import schema
from fieldledger.functions import dates
from fieldledger.operators import merge, normalize, profile, rules
from fieldledger.operators.normalize import arrival
from fieldledger.sources import pages as page_source
from fieldledger.sources.store import TableStore, observed, setting

# Feeds in load order, and defaults of the reads that need one.
STATIC_FEEDS = ("serviceline", "tag", "paymentterms")
FEED_ORDER = (
    "company",
    "location",
    "contact",
    "job",
    "appointment",
    "servicerequest",
    "invoice",
    "quote",
    "asset",
    "deficiency",
    "servicerecurrence",
    "user",
)
CHILD_FEEDS = {"invoice": "invoiceitem", "quote": "quoteitem"}
UPDATED_FLOOR = {"asset": 946684800, "servicerecurrence": 946684800}
DUE_SECTION = "serviceRequests"

#: Tables of the loader itself: profiles of feeds, pulls that arrive page by page, pages that wait, and what was rejected.
PROFILES, PULLS, WAITING, REJECTS = "_profiles", "_pulls", "_waiting", "_rejects"
PULL_LAYOUT = "name string, feed string, pull string, total_pages long, pages_landed long, unread long, released long"
WAITING_LAYOUT = "page long, total_pages long, readable boolean, body string, feed string, source string, pull string, batch long"
REJECT_LAYOUT = "pull string, page long, pos long, item long, id long, field string, raw string, reason string, resource string, run string"


@dataclass(frozen=True)
class Run:
    """Outcome of one table in one load. ``partial``: some pages could not be read, or a pull is not whole yet."""

    table: str
    fetched: int
    upserted: int
    status: str
    error: str | None = None


@dataclass
class Loader:
    """Loads into ``store``; ``clock`` gives epoch seconds.

    ``plans`` holds rule lists by feed. A feed without one is profiled: its stored profile is merged with that
    of the batch, so rules do not depend on how the feed is cut into batches that came before.
    """

    store: TableStore
    clock: object = field(default=lambda: int(time.time()))
    plans: Mapping[str, list[rules.Field]] = field(default_factory=dict)

    def __post_init__(self):
        own = {PROFILES: (profile.STORED, "name"), PULLS: (PULL_LAYOUT, "name")}
        self.store.layouts = {**{n: (T.StructType.fromDDL(text), key) for n, (text, key) in own.items()}, **self.store.layouts}

    @property
    def spark(self):
        return self.store.spark

    def plan(self, feed: str, records: DataFrame) -> list[rules.Field]:
        """Rules of a feed, saved ones or from what its records have looked like so far."""
        if feed in self.plans:
            return self.plans[feed]
        known = self.store.read(PROFILES).where(F.col("feed") == feed)
        with self.store.staged(profile.first_of_shapes(records)) as spots:
            both = known.unionByName(profile.stored_profile(records, feed, spots))
            # one row for each field and type, the size of a table header
            rows = profile.merged_profile(both).collect()
        layout, _ = self.store.layout(PROFILES)
        seen = self.spark.createDataFrame(rows, layout)
        self.store.upsert(PROFILES, seen, cheap=True)
        return rules.resource_plan(profile.profiles_of(profile.settled_profile(seen)), feed)

    def _shaped(self, feed: str, records: DataFrame) -> DataFrame:
        """Records with the shape that their profile is taken by, found while they are written aside."""
        return records if feed in self.plans else profile.with_shape(records)

    def load(
        self,
        feed: str,
        pages: DataFrame,
        full: bool = False,
        details: DataFrame | None = None,
        source: str | None = None,
        batch: int | None = None,
        newer_by: str | None = None,
        hold: int = 0,
    ) -> list[Run]:
        """One feed with its children. A failure is logged and ends only this feed.

        ``details`` holds child records with their parent id (and ``page``, ``pos``) from the child's own feed; a child that it
        lacks is taken as it is embedded. A page or record that cannot be read, a record without id and a value that does not fit its
        column go to the rejects. A pull with fewer pages than it announces fails the run. The mark stays
        where it is after a failure, an unread page, and while ``hold`` pulls are not whole.
        """
        table, started = schema.table_name(feed), self.clock()
        if table not in schema.TABLE_COLUMNS:
            return [self._log(Run(table, 0, 0, "skipped", "no table for this feed"), started, source, batch)]
        if feed in STATIC_FEEDS and not full and self.store.exists(table) and not self.store.read(table).isEmpty():
            return [self._log(Run(table, 0, 0, "skipped"), started, source, batch)]
        # what was written aside packs well: cut by size alone it would make about one task for each core, and a few more
        finer = setting(self.spark, "spark.sql.files.minPartitionNum", 4 * self.spark.sparkContext.defaultParallelism)
        try:
            with finer, self.store.staged(self._shaped(feed, page_source.landed(pages, feed))) as landed:
                unread = self._dead_pages(table, landed, started, source, batch, whole=batch is None)
                records = landed.where(F.col("pos").isNotNull()).drop("total_pages", "bad")
                if feed == "servicerecurrence":
                    due = normalize.enrich_due(records.where(F.col("record").isNotNull()), page_source.section(pages, DUE_SECTION))
                    records = due.unionByName(records.where(F.col("record").isNull()), allowMissingColumns=True)
                trouble = [f"{unread} pages cannot be read"] * bool(unread) + [f"{hold} pulls are not whole"] * bool(hold)
                runs = [self._put(feed, table, records, started, source, batch, newer_by, "; ".join(trouble) or None)]
                child = CHILD_FEEDS.get(feed)
                if child and runs[0].fetched > 0:
                    runs.append(self._children(feed, child, records, details, started, source, batch))
                return runs
        except Exception as error:  # noqa: BLE001 - one feed must not stop the others
            return [self._log(Run(table, 0, 0, "failed", str(error)), started, source, batch)]

    def _dead_pages(self, table, landed, started, source, batch, whole) -> int:
        heads = landed.select("pull", "page", "total_pages", F.col("bad").isNull().alias("readable"), "bad").distinct()
        if whole:
            missing = page_source.pull_states(heads).where(F.col("total_pages") > F.col("pages_landed") + F.col("unread")).count()
            if missing:
                raise ValueError(f"{missing} pulls have fewer pages than they announce")
        bad = heads.where(~F.col("readable"))
        unread = bad.count()
        if unread:
            dead = bad.select("pull", F.col("bad").alias("raw"), F.lit("page cannot be read").alias("reason"))
            self._reject(dead, table, f"{_run(started, source, batch)}-pages")
        return unread

    def _put(self, feed, table, records, started, source, batch, newer_by, trouble) -> Run:
        readable = records.where(F.col("record").isNotNull())
        given = {"currently_due": F.col("currently_due")} if "currently_due" in records.columns else None
        return self._store(table, records, self.plan(feed, readable), ["pull", "page", "pos"], given, started, source, batch, newer_by, trouble)

    def _children(self, feed, child, records, details, started, source, batch) -> Run:
        parent_column, table = f"{feed}_id", schema.table_name(child)
        try:
            place = {c: F.coalesce(c, F.lit(0)) for c in ("page", "pos", "item")}
            readable = records.where(F.col("record").isNotNull())
            chosen = normalize.choose_children(readable, parent_column, details).withColumns(place)
            chosen = chosen.withColumn("pull", F.coalesce("pull", F.lit("")))
            with self.store.staged(self._shaped(child, chosen)) as kept:
                keep = [parent_column, "pull", "page", "pos", "item"]
                return self._store(table, kept, self.plan(child, kept), keep, None, started, source, batch, None, None)
        except Exception as error:  # noqa: BLE001 - the parent is stored already
            return self._log(Run(table, 0, 0, "failed", str(error)), started, source, batch)

    def _store(self, table, records, plan, keep, given, started, source, batch, newer_by, trouble) -> Run:
        record = F.col("record")
        columns = normalize.columns_of(record, plan, given=given)
        wanted = {*schema.TABLE_COLUMNS[table].split(), "pull", "page", "pos", "item"}
        text = F.coalesce(F.col("text"), F.to_json(record)) if "text" in records.columns else F.to_json(record)
        rows = records.select(*keep, *columns, normalize.lost_values(record, plan).alias("_lost"), text.alias("_text"))
        rows = rows.select(*[c for c in rows.columns if c in wanted or c.startswith("_")]).withColumn("_text", F.when(F.col("id").isNull(), F.col("_text")))
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("all"), F.count("id").alias("keyed"), F.sum(F.size("_lost")).alias("lost"))
        with self.store.staged(counted) as typed:
            counts = {"all": 0, "keyed": 0, "lost": 0, **observed(seen)}
            order = [normalize.pull_order(F.col("pull")), arrival(F.col("page"), F.col("pos"))]
            if "item" in typed.columns:
                order.append(F.col("item"))
            if newer_by:
                order.insert(0, F.col(newer_by))
            keyed = typed.drop("_lost", "_text").where(F.col("id").isNotNull())
            with self.store.staged(merge.repeated(keyed, "id")) as twice:
                # rows whose key comes once need no choice, and so no sorting
                changes = keyed if twice.isEmpty() else merge.last_of_repeated(keyed, "id", order, twice)
                added = self.store.upsert(table, changes, newer_by)
            if counts["keyed"] < counts["all"] or counts["lost"]:
                self._reject(_rejected(typed), table, _run(started, source, batch))
        status = "partial" if trouble else "success"
        if not trouble:
            self._mark(table, started, added)
        return self._log(Run(table, counts["all"], counts["keyed"], status, trouble), started, source, batch)

    def _reject(self, rows: DataFrame, table: str, run: str) -> None:
        layout = T.StructType.fromDDL(REJECT_LAYOUT)
        named = schema.fit(rows.withColumns({"resource": F.lit(table), "run": F.lit(run)}), layout)
        self.store.put_part(REJECTS, named, "resource", "run")

    def rejects(self) -> DataFrame:
        """What was turned away: pages and records as text, values with their field and the reason."""
        return self.store.parts(REJECTS, REJECT_LAYOUT)

    def _mark(self, table: str, started: int, added: int) -> None:
        """The high-water mark is the start of the run: changes made meanwhile come again. Rows are counted on."""
        last = self.store.read("sync_status").where(F.col("resource") == table).select("record_count").first()
        count = last[0] + added if last else self.store.count(table)
        row = [(table, started, _clock(started), started, _clock(started), count)]
        self.store.upsert("sync_status", self.spark.createDataFrame(row, schema.table_schema("sync_status")), cheap=True)

    def _log(self, run: Run, started: int, source: str | None, batch: int | None) -> Run:
        """One log row per run and table; a replay writes the same row again."""
        finished = self.clock()
        values = {
            "resource": run.table, "started_at": started, "started_at_dt": _clock(started), "finished_at": finished, "finished_at_dt": _clock(finished),
            "status": run.status, "records_fetched": run.fetched, "records_upserted": run.upserted, "error_message": run.error,
        }
        # one row without a detour through Python, as a stream writes it in every batch
        row = self.spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(n) for n, v in values.items()])
        identity = F.xxhash64(F.lit(source or str(started)), F.lit(-1 if batch is None else batch), F.col("resource"))
        self.store.upsert("sync_log", row.withColumn("id", identity), cheap=True)
        return run

    def load_all(self, feeds: Mapping[str, DataFrame], full: bool = False, details: Mapping[str, DataFrame] | None = None) -> list[Run]:
        """Every feed that has pages: the static ones, then the rest in order.

        ``details`` holds, by parent feed, the child records of its detail feed.
        """
        known = [f for f in (*STATIC_FEEDS, *FEED_ORDER) if f in feeds]
        others = [f for f in feeds if f not in known]
        return [run for feed in known + others for run in self.load(feed, feeds[feed], full, details=(details or {}).get(feed))]

    def row_counts(self, tables: list[str] | None = None) -> DataFrame:
        """``(name, records)`` of stored tables, -1 for one that does not exist."""
        rows = [(name, self.store.count(name)) for name in tables or schema.TABLE_COLUMNS]
        return self.spark.createDataFrame(rows, "name string, records long")

    def reset(self, table: str) -> None:
        """Empty a table, its children and their marks; the next load fetches everything."""
        family = [table, *[c for c, p in schema.CHILD_TABLES.items() if p == table]]
        for name in family:
            self.store.clear(name)
        if self.store.exists("sync_status"):
            self.store.replace("sync_status", self.store.read("sync_status").where(~F.col("resource").isin(*family)))

    def since(self, table: str, full: bool = False) -> int | None:
        """From which update on the next read of a table starts; None means everything."""
        floor = UPDATED_FLOOR.get(table.replace("_", ""))
        if full or table in schema.STATIC_TABLES:
            return floor
        mark = self.store.read("sync_status").where(F.col("resource") == table).select("last_synced_at").first()
        return mark[0] if mark else floor

    # Streams -----------------------------------------------------------------

    def stream(self, feed: str, folder: str, checkpoint: str, files_per_batch: int = 1000, details: DataFrame | None = None) -> None:
        """Load the files that landed since the last call, then stop.

        Pages wait until their pull is whole; ``released`` of a pull is the batch that loaded it. A batch that ran but was not
        recorded finds its own numbers again and does the same once more.
        """

        def one(pages: DataFrame, batch: int) -> None:
            waiting, pulls, hold = self._wait(feed, pages, checkpoint, batch)
            if not any(released is not None for _, released in pulls):
                waits = Run(schema.table_name(feed), 0, 0, "partial", f"{hold} pulls are not whole")
                self._log(waits, self.clock(), checkpoint, batch)
                return
            ready = self._ready(waiting, pulls, batch)
            failed = [r for r in self.load(feed, ready, True, details, source=checkpoint, batch=batch, hold=hold) if r.status == "failed"]
            if failed:
                raise RuntimeError(failed[0].error)

        # files and folders are listed by some tasks for each core, not by one task for each of them
        listing = setting(self.spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4 * self.spark.sparkContext.defaultParallelism)
        with listing:
            run_stream(page_source.stream_pages(self.spark, folder, files_per_batch), one, checkpoint)

    def _waiting(self, feed: str, source: str) -> DataFrame:
        return self.store.parts(WAITING, WAITING_LAYOUT).where((F.col("feed") == feed) & (F.col("source") == _short(source))).withColumn("pull", F.substring("pull", 2, 1 << 20))

    def _wait(self, feed: str, pages: DataFrame, source: str, batch: int) -> tuple[DataFrame, list[tuple], int]:
        """Keep the pages of a batch, and note which pulls it completes.

        Returns the pages kept up to this batch, ``(pull, released)`` for each pull that the batch has pages of, and how many pulls of the
        feed are not whole.
        """
        # partition values are never empty: a letter goes before the name of a pull
        parts = {"feed": F.lit(feed), "source": F.lit(_short(source)), "batch": F.lit(batch), "pull": F.concat(F.lit("p"), "pull")}
        # few files for each pull, as later batches read the heads in them again
        kept = page_source.page_heads(pages).withColumns(parts).hint("rebalance", F.col("pull"))
        self.store.put_part(WAITING, kept, "feed", "source", "pull", "batch")
        waiting = self._waiting(feed, source).where(F.col("batch") <= batch)
        mine = (F.col("feed") == feed) & F.col("name").startswith(f"{_short(source)}/")
        before = self.store.read(PULLS).where(mine & (F.col("released") < batch)).select("pull", "released")
        # only pulls of this batch change; bodies are not read
        touched = waiting.where(F.col("batch") == batch).select("pull").distinct()
        states = page_source.pull_states(waiting.join(touched, "pull", "left_semi"))
        there = F.col("total_pages").isNull() | (F.col("total_pages") <= F.col("pages_landed") + F.col("unread"))
        name = F.concat(F.lit(f"{_short(source)}/{feed}/"), "pull")
        rows = states.join(before, "pull", "left").select(
            name.alias("name"), F.lit(feed).alias("feed"), "pull", "total_pages", "pages_landed", "unread", F.coalesce("released", F.when(there, F.lit(batch))).cast("long").alias("released")
        )
        with self.store.staged(rows) as settled:
            # one row for each pull of the batch, at most one for each of its files
            found = [(r["pull"], r["released"]) for r in settled.select("pull", "released").collect()]
            self.store.upsert(PULLS, settled, cheap=True)
        whole = F.coalesce(F.col("total_pages") <= F.col("pages_landed"), F.col("unread") == 0)
        return waiting, found, self.store.read(PULLS).where(mine & ~whole).count()

    def _ready(self, waiting: DataFrame, pulls: list[tuple], batch: int) -> DataFrame:
        """Pages to load now: all pages of pulls that this batch completes, and its own pages of pulls loaded before."""
        known = self.spark.createDataFrame(pulls, "pull string, released long")
        pages = waiting.join(known.where("released is not null"), "pull")
        now = (F.col("released") == batch) | ((F.col("released") < batch) & (F.col("batch") == batch))
        return pages.where(now).select("pull", "body")


def _short(source: str) -> str:
    return hashlib.sha256(source.encode()).hexdigest()[:16]


def _run(started: int, source: str | None, batch: int | None) -> str:
    """A name for one load that a replay has again."""
    return f"{_short(source)}-{batch}" if source is not None else str(started)


def _rejected(typed: DataFrame) -> DataFrame:
    """Reject rows of typed records: those without id or that could not be read, and values that did not fit."""
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.col("_text").alias("raw"), F.lit("no id").alias("reason")))
    each = F.explode(F.concat(F.when(F.col("id").isNull(), nothing).otherwise(F.array().cast(normalize.LOST)), "_lost")).alias("lost")
    place = [c for c in ("pull", "page", "pos", "item") if c in typed.columns]
    return typed.select(*place, "id", each).select(*place, "id", "lost.field", "lost.raw", "lost.reason")


def _clock(epoch: int) -> str:
    return time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(epoch))


def incremental(rows: DataFrame, mark: int | None, column: str = "updated_at") -> DataFrame:
    """Rows updated after the mark, as a filter the scan can skip by."""
    return rows if mark is None else rows.where(F.col(column) > mark)


def status_from_log(log: DataFrame, counts: DataFrame) -> DataFrame:
    """Marks rebuilt from the log: per resource the start of its last good run.

    ``counts`` has ``resource, record_count``; a resource it lacks counts -1.
    """
    good = F.col("status") == "success"
    marks = log.where(good).groupBy("resource").agg(
        F.max("started_at").alias("last_synced_at"), F.max("finished_at").alias("last_run_at")
    )
    return schema.conform(
        marks.join(counts, "resource", "left").select(
            "resource",
            "last_synced_at",
            dates.clock_text(F.col("last_synced_at")).alias("last_synced_at_dt"),
            "last_run_at",
            dates.clock_text(F.col("last_run_at")).alias("last_run_at_dt"),
            F.coalesce("record_count", F.lit(-1)).alias("record_count"),
        ),
        "sync_status",
    )


def run_stream(stream: DataFrame, each_batch, checkpoint: str) -> None:
    """All available input through ``each_batch(rows, batch number)``, then stop."""
    query = (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_upserts(
    store: TableStore, table: str, folder: str, layout: str, order: list[str], checkpoint: str, files_per_batch: int = 1000
) -> None:
    """Parquet files of changed rows, streamed into a stored table; batches apply in order, a replay changes nothing."""
    _, key = store.layout(table)

    def one(rows: DataFrame, batch: int) -> None:
        store.upsert(table, merge.last_arrivals(rows, key, [F.col(c) for c in order]))

    source = store.spark.readStream.schema(layout).option("maxFilesPerTrigger", files_per_batch)
    run_stream(source.parquet(folder), one, checkpoint)
