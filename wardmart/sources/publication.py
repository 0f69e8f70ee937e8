"""Atomic publication of whole builds.

A build writes its tables into run folders that nobody else names. When they
are whole and verified, ``publish`` makes them visible with one step: a
manifest ``v<number>.json`` that names every table of the run appears by a
rename that fails if the number is taken. Readers follow the highest
manifest, so they see all tables of one build or all of the one before.

A reader holds a lease on its version. ``retire`` deletes the runs of old
versions, but none that a lease still covers: the reader first writes its
lease and then looks whether the version is still there; ``retire`` first
takes the version away and then looks for leases. Either the reader finds
the version gone and takes a newer one, or the lease is seen and the files
stay. Runs of builds that died are deleted once the builder's own lease has
run out. Times are those of the machines that run the drivers; leases should
be longer than their clocks differ.

Files are reached through Hadoop's interface, so the folder may be in any
store that the session can write. The rename is atomic where the store's is.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from ..functions.text import quote

HOLD_SECONDS = 24 * 3600.0


class Store:
    """The few file steps a publication needs, in any Hadoop store."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.root = root.rstrip("/")
        fs = self.jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        self.fs = fs.Path(self.root).getFileSystem(conf)
        self.context = fs.FileContext.getFileContext(fs.Path(self.root).toUri(), conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def names(self, *parts: str) -> list[str]:
        """Names in a folder (none if it does not exist), in order."""
        folder = self.path(*parts)
        try:
            return sorted(s.getPath().getName() for s in self.fs.listStatus(folder))
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return []
            raise

    def read(self, *parts: str) -> str | None:
        """A small text file; None if it is not there."""
        try:
            stream = self.fs.open(self.path(*parts))
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return None
            raise
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, text: str, *parts: str) -> bool:
        """A whole file that appears at once; False if the name is taken."""
        draft = self.path(*parts[:-1], f".{parts[-1]}.{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        return self.move(draft, self.path(*parts))

    def move(self, old, new) -> bool:
        """Rename unless the new name is taken or the old one gone."""
        none = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            self.context.rename(old, new, none)
            return True
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() not in ("FileAlreadyExistsException", "FileNotFoundException"):
                raise
            self.fs.delete(old, False) if self.fs.exists(new) and old.getName().startswith(".") else None
            return False

    def delete(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)


@dataclass
class Entry:
    """How one published table is read."""
    path: str
    rows: int
    schema: str                                     # Spark's JSON
    buckets: int = 0
    bucket_columns: list[str] = field(default_factory=list)
    partition_columns: list[str] = field(default_factory=list)


@dataclass
class Manifest:
    version: int
    run_id: str
    tables: dict[str, Entry]
    views: dict[str, str]       # name -> query over the other names, as {name}

    @classmethod
    def parse(cls, version: int, text: str) -> Manifest:
        data = json.loads(text)
        return cls(version, data["run_id"], {k: Entry(**v) for k, v in data["tables"].items()}, data["views"])


class NotPublished(RuntimeError):
    """A build that is not whole, or a name that no version has."""


def _file(version: int) -> str:
    return f"v{version:012d}.json"


def versions(store: Store) -> list[int]:
    return [int(n[1:-5]) for n in store.names("_published") if n.startswith("v") and n.endswith(".json")]


def hold(store: Store, kind: str, name: str, seconds: float, now: float | None = None) -> str:
    """Write a lease on ``kind`` (a version or a builder's run); its name."""
    until = (time.time() if now is None else now) + seconds
    lease = f"{uuid.uuid4().hex}-{until:.0f}"
    store.write(str(until), kind, name, lease)
    return lease


def held(store: Store, kind: str, name: str, now: float) -> bool:
    """Whether a lease on ``name`` has not run out."""
    return any(not n.startswith(".") and float(n.rpartition("-")[2]) >= now for n in store.names(kind, name))


def begin(spark: SparkSession, root: str, run_id: str, seconds: float = HOLD_SECONDS) -> None:
    """Announce a build, so that ``retire`` leaves its unpublished run alone."""
    hold(Store(spark, root), "_builders", run_id, seconds)


def publish(spark: SparkSession, root: str, run_id: str, tables: dict[str, Entry],
            views: dict[str, str] | None = None) -> int:
    """Make a written run the one that readers see; returns its version.

    Every table is verified first: its files must hold the rows that were
    counted while it was written (footers only, no data pages). Builds that
    publish at the same time get versions of their own, in some order.
    """
    for name, entry in tables.items():
        found = read_entry(spark, entry).count()
        if found != entry.rows:
            raise NotPublished(f"{name}: {entry.rows} rows were written, {found} are there")
    store = Store(spark, root)
    body = json.dumps({"run_id": run_id, "tables": {k: asdict(v) for k, v in tables.items()}, "views": views or {}})
    taken = store.names("_published")
    version = max([int(n[1:13]) for n in taken if n.startswith("v")], default=0) + 1
    while not store.write(body, "_published", _file(version)):
        version += 1
    return version


def read_entry(spark: SparkSession, entry: Entry) -> DataFrame:
    """A scan of a published table's files."""
    from pyspark.sql.types import StructType
    return spark.read.schema(StructType.fromJson(json.loads(entry.schema))).parquet(entry.path)


class Snapshot:
    """One published version, kept readable until ``release`` or its lease
    runs out. Usable in a ``with`` statement."""

    def __init__(self, spark: SparkSession, store: Store, manifest: Manifest, lease: str):
        self.spark, self.store, self.manifest, self.lease = spark, store, manifest, lease

    @property
    def version(self) -> int:
        return self.manifest.version

    def table(self, name: str) -> DataFrame:
        if name not in self.manifest.tables:
            raise NotPublished(f"version {self.version} has no table {name}")
        return read_entry(self.spark, self.manifest.tables[name])

    def bind(self, database: str = "wardmart") -> None:
        """Name this version's tables and views in the session's catalog.

        Tables are external, ``<name>__v<version>``, with their buckets and
        partitions; ``<name>`` is a persistent view over them, replaced here,
        so queries written against the names follow the publications. Where
        the catalog outlives the session, so do the names.
        """
        spark, m = self.spark, self.manifest
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(database)} LOCATION '{self.store.root}/_catalog/{database}'")
        for name, e in m.tables.items():
            table = f"{quote(database)}.{quote(f'{name}__v{m.version}')}"
            if not spark.catalog.tableExists(table):
                from pyspark.sql.types import StructType
                columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}"
                                    for f in StructType.fromJson(json.loads(e.schema)).fields)
                by = ""
                if e.partition_columns:
                    by += " PARTITIONED BY (" + ", ".join(map(quote, e.partition_columns)) + ")"
                if e.buckets:
                    by += f" CLUSTERED BY ({', '.join(map(quote, e.bucket_columns))}) INTO {e.buckets} BUCKETS"
                spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{by} LOCATION '{e.path}'")
                if e.partition_columns:
                    spark.sql(f"MSCK REPAIR TABLE {table}")
            spark.sql(f"CREATE OR REPLACE VIEW {quote(database)}.{quote(name)} AS SELECT * FROM {table}")
        named = {n: f"{quote(database)}.{quote(n)}" for n in [*m.tables, *m.views]}
        for name, sql in m.views.items():
            spark.sql(f"CREATE OR REPLACE VIEW {named[name]} AS {sql.format(**named)}")

    def release(self) -> None:
        self.store.delete("_leases", str(self.version), self.lease)

    def __enter__(self) -> Snapshot:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def snapshot(spark: SparkSession, root: str, seconds: float = HOLD_SECONDS, version: int | None = None) -> Snapshot:
    """The newest published version (or the one asked for), under a lease."""
    store = Store(spark, root)
    while True:
        there = versions(store)
        chosen = max(there, default=None) if version is None else version
        if chosen is None or chosen not in there:
            raise NotPublished(f"{root} has no published version" + (f" {version}" if version else ""))
        lease = hold(store, "_leases", str(chosen), seconds)
        text = store.read("_published", _file(chosen))
        if text is not None:
            return Snapshot(spark, store, Manifest.parse(chosen, text), lease)
        store.delete("_leases", str(chosen), lease)     # retired meanwhile


def retire(spark: SparkSession, root: str, keep: int = 2, now: float | None = None) -> list[str]:
    """Delete the runs that nobody can read any more; returns their ids.

    Those are the runs of versions older than the ``keep`` newest without a
    lease, and the runs of announced builds that were never published and
    whose own lease has run out. Everything else stays, also run folders
    that no build announced. A retire that dies is finished by the next.
    """
    store = Store(spark, root)
    now = time.time() if now is None else now
    there = sorted(versions(store))
    for version in there[:max(0, len(there) - max(1, keep))]:
        name = _file(version)
        store.move(store.path("_published", name), store.path("_published", name + ".retired"))
    live = {json.loads(t)["run_id"] for t in (store.read("_published", _file(v)) for v in versions(store)) if t}
    gone = []

    def delete_run(run_id: str) -> None:
        for table in store.names():
            if not table.startswith("_") and store.names(table, f"run={run_id}"):
                store.delete(table, f"run={run_id}")
        gone.append(run_id)

    for name in [n for n in store.names("_published") if n.startswith("v") and n.endswith(".retired")]:
        version = str(int(name[1:13]))
        run_id = json.loads(store.read("_published", name))["run_id"]
        if not held(store, "_leases", version, now):
            if run_id not in live:
                delete_run(run_id)
            store.delete("_published", name)
            store.delete("_leases", version)
        else:
            live.add(run_id)
    for run_id in store.names("_builders"):
        if not held(store, "_builders", run_id, now):
            if run_id not in live and run_id not in gone:
                delete_run(run_id)
            store.delete("_builders", run_id)
    return gone
