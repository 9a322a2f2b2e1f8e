"""Named report views and bounded ad-hoc queries."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldledger import schema
from fieldledger.functions import dates
from fieldledger.plans.report import REPORTS, Settings

# Default row limit and the form of view names.
DEFAULT_LIMIT = 1000
VIEW_NAME = r"^report_[a-z0-9_]+$"
MAIN_PREFIX, CHECK_PREFIX, OTHER_PREFIX = "report_", "report_qual_", "report_zzz_"

OWN_LIMIT = re.compile(r"\blimit\s+\d+(\s+offset\s+\d+)?\s*$", re.IGNORECASE)
OUTSIDE_CALLS = re.compile(r"\b(java_method|reflect|try_reflect)\s*\(|\busing\s*''", re.IGNORECASE)
#: String literals, comments and name quotes, read from left to right.
QUOTED = re.compile(r"""(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<note>--[^\n]*|/\*.*?\*/)|`""", re.DOTALL)
FILES_AS_TABLES = "spark.sql.runSQLOnFiles"


def bare_text(sql: str) -> str:
    """A statement with empty literals and without comments and name quotes."""
    return QUOTED.sub(lambda m: "''" if m["text"] else " " if m["note"] else "", sql)


def select_only(spark: SparkSession, sql: str) -> str:
    """The statement without its trailing semicolon, if it only reads.

    The statement has to analyse as a subquery, which no command does, and without
    files named as tables. Calls are looked for outside literals and comments.
    """
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise ValueError("empty query")
    if text.split()[0].upper() not in ("SELECT", "WITH"):
        raise ValueError("only SELECT and WITH queries are allowed")
    if OUTSIDE_CALLS.search(bare_text(text)):
        raise ValueError("calls outside the engine are not allowed")
    allowed = spark.conf.get(FILES_AS_TABLES)
    spark.conf.set(FILES_AS_TABLES, "false")
    try:
        spark.sql(f"SELECT * FROM (\n{text}\n) AS checked")
    except Exception as error:
        raise ValueError(f"not a query: {str(error)}") from error
    finally:
        spark.conf.set(FILES_AS_TABLES, allowed)
    return text


def bounded_query(spark: SparkSession, sql: str, limit: int = DEFAULT_LIMIT, marked: bool = False) -> DataFrame:
    """Rows of a read-only query; without a LIMIT of its own it gets the default one.

    ``marked`` adds a column ``truncated``: whether the default limit left rows out. It asks for one row more than it shows.
    """
    text = select_only(spark, sql)
    rows = spark.sql(text)
    if OWN_LIMIT.search(text):
        return rows.withColumn("truncated", F.lit(False)) if marked else rows
    shown = rows.limit(limit)
    if not marked:
        return shown
    more = rows.limit(limit + 1).agg((F.count(F.lit(1)) > limit).alias("more"))
    return shown.withColumn("truncated", more.scalar())


def as_json(rows: DataFrame) -> DataFrame:
    """One JSON object per row."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))


def timestamp_view(table: DataFrame, name: str, tz: str = dates.PACIFIC) -> DataFrame:
    """All columns of a table, plus a local clock text for every epoch column."""
    clocks = [
        dates.clock_text(F.col(c), tz).alias(f"{c}_dt") for c in schema.timestamp_columns(name) if c in table.columns
    ]
    return table.select("*", *clocks)


def register_tables(tables: Mapping, names: list[str] | None = None, tz: str = dates.PACIFIC) -> None:
    """Tables under their own names and, where they hold timestamps, as ``v_<table>``."""
    for name in names or list(tables):
        tables[name].createOrReplaceTempView(name)
        if schema.timestamp_columns(name):
            timestamp_view(tables[name], name, tz).createOrReplaceTempView(f"v_{name}")


def view_name(report: str) -> str:
    if report == "primary_hood_duplicates":
        return CHECK_PREFIX + report
    return (MAIN_PREFIX if report.startswith("primary_hood") else OTHER_PREFIX) + report


class ReportCatalog:
    """Saved views: temp views for reading, one text file each for keeping."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.entries: dict[str, tuple[str, str, str]] = {}

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.sql")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def save(self, name: str, description: str, sql: str) -> None:
        """Create or replace a view. It has to run before anything is stored."""
        if not re.match(VIEW_NAME, name):
            raise ValueError(f"view name {name!r} must match {VIEW_NAME}")
        text = select_only(self.spark, sql)
        self.spark.sql(text).limit(1).collect()
        created = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        header = f"-- name: {name}\n-- description: {' '.join(description.split())}\n-- created_at: {created}\n"
        files, path = self._file(name)
        stream = files.create(path, True)
        try:
            stream.write(bytearray((header + text + "\n").encode()))
        finally:
            stream.close()
        self._register(name, description, text, created)

    def _register(self, name: str, description: str, sql: str, created: str) -> None:
        self.spark.sql(sql).createOrReplaceTempView(name)
        self.entries[name] = (description, sql, created)

    def add_reports(self, tables: Mapping, settings: Settings) -> None:
        """The built-in reports as views; read without order like any table."""
        for name, report in REPORTS.items():
            report.frame(tables, settings).createOrReplaceTempView(view_name(name))
            self.entries[view_name(name)] = (report.description, None, None)

    def saved(self) -> DataFrame:
        """``name, description, created_at, sql`` of all stored texts, by whichever session."""
        files, path = self._file("x")
        layout = "name string, description string, created_at string, sql string"
        if not files.exists(path.getParent()):
            return self.spark.createDataFrame([], layout)
        found = self.spark.read.option("pathGlobFilter", "*.sql").text(self.folder, wholetext=True)
        line = lambda key: F.regexp_extract("value", rf"(?m)^-- {key}: (.+)$", 1)
        told = [F.nullif(line(key), F.lit("")).alias(key) for key in ("description", "created_at")]
        text = F.regexp_replace("value", r"(?m)^-- (name|description|created_at): [^\n]*\n", "")
        body = F.regexp_replace(text, r"^\s+|\s+$", "").alias("sql")
        return found.select(line("name").alias("name"), *told, body)

    def listing(self) -> DataFrame:
        """``name, description, created_at, sql`` of all report views, registered here or saved by anyone."""
        views = [(t.name,) for t in self.spark.catalog.listTables() if t.isTemporary]
        built_in = self.spark.createDataFrame([(n, e[0]) for n, e in self.entries.items() if e[1] is None], "name string, told string")
        saved = self.saved()
        names = self.spark.createDataFrame(views, "name string").unionByName(saved.select("name")).distinct().where(F.col("name").rlike("^report."))
        shown = names.join(saved, "name", "left").join(built_in, "name", "left")
        return shown.select("name", F.coalesce("description", "told").alias("description"), "created_at", "sql").orderBy("name")

    def drop(self, name: str) -> bool:
        """Remove a view with its stored text; False when there is none."""
        if not name.startswith("report_"):
            raise ValueError("only report_ views can be dropped")
        files, path = self._file(name)
        found = self.spark.catalog.dropTempView(name)
        if files.exists(path):
            found = files.delete(path, False) or found
        self.entries.pop(name, None)
        return found

    def restore(self) -> tuple[list[str], dict[str, str]]:
        """Register every stored view again, those that others read first: names done, and errors by name."""
        rows = {r["name"]: r for r in self.saved().collect()}  # one row per saved view, as many as people have typed
        reads = {n: sorted(set(re.findall(r"[a-z0-9_]+", bare_text(r["sql"]).lower())) & set(rows) - {n}) for n, r in rows.items()}
        done, errors, left = [], {}, dict(sorted(reads.items()))
        while left:
            ready = [n for n, others in left.items() if not any(o in left for o in others)]
            if not ready:
                errors |= {n: f"views that read each other: {', '.join(left)}" for n in left}
                break
            for name in ready:
                row = rows[name]
                del left[name]
                try:
                    self._register(name, row["description"], select_only(self.spark, row["sql"]), row["created_at"])
                    done.append(name)
                except Exception as error:  # noqa: BLE001 - a broken file must not stop the others
                    errors[name] = str(error)
        return done, errors
