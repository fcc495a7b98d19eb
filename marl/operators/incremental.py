"""Processing only what is new or changed, with the target as the state.

A target is a folder of data and of manifests, one a version. Every output row stores its source key, its version and its place
in the source's order; what has been handled is read from there and nowhere else. A run writes its rows into a folder of
their own, and publishes them by creating the manifest of the next version, which succeeds once: a run that fails before it
leaves no trace that a reader sees, one that is repeated after it finds its rows there, and of two that race one is refused.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marl.plans.scratch import create_once, delete, keep, listed, read_bytes

#: Versions after which a run writes the last row of each key anew, so that reading the state does not grow with age.
SNAPSHOT = 16


class Target:
    """The published versions below `path`. `schema` is that of a row: key columns, `version`, `place` and what else a row carries.

    A manifest names the data folders of all versions up to its own, and the last snapshot with the folders since.
    """

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark, self.path, self.schema = spark, path, schema

    def _versions(self) -> list[int]:
        return sorted(int(n) for n in listed(self.spark, f"{self.path}/manifest") if n.isdigit())

    def latest(self) -> int:
        """The number of the last published version; 0 for none."""
        return max(self._versions(), default=0)

    def manifest(self, version: int) -> dict:
        return json.loads(read_bytes(self.spark, f"{self.path}/manifest/{version:012d}")) if version else {"data": [], "snapshot": None, "since": []}

    def _read(self, folders: list[str]) -> DataFrame:
        paths = [f"{self.path}/data/{f}" for f in folders]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def rows(self, upto: int | None = None) -> DataFrame:
        """All rows as of a version, the last by default."""
        return self._read(self.manifest(self.latest() if upto is None else upto)["data"])

    def state(self, upto: int) -> DataFrame:
        """Rows as of a version that hold the last one of every key: the last snapshot and what came since."""
        m = self.manifest(upto)
        return self._read([*([m["snapshot"]] if m["snapshot"] else []), *m["since"]])

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/data/{name}")
        return name

    def publish(self, rows: DataFrame, after: int, keys: list[str] = ()) -> int:
        """Add `rows` as the version that follows `after`; raises if another run has published that one already. With `keys` a snapshot is written every SNAPSHOT versions."""
        before = self.manifest(after)
        mine = [self._write(rows)]
        now = {"data": [*before["data"], mine[0]], "snapshot": before["snapshot"], "since": [*before["since"], mine[0]]}
        if keys and len(now["since"]) >= SNAPSHOT:
            held = self._read([*([now["snapshot"]] if now["snapshot"] else []), *now["since"]])
            last = held.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in self.schema.fieldNames() if c not in keys]), "place").alias("r"))
            mine.append(self._write(last.select(*keys, "r.*").select(*self.schema.fieldNames())))
            now |= {"snapshot": mine[1], "since": []}
        if not create_once(self.spark, f"{self.path}/manifest/{after + 1:012d}", json.dumps(now).encode()):
            for name in mine:
                delete(self.spark, f"{self.path}/data/{name}")
            raise RuntimeError(f"version {after + 1} of {self.path} was published by another run")
        return after + 1

    def sweep(self, hours: float = 24.0) -> list[str]:
        """Delete the data folders that no manifest names and that are older than `hours`: what failed runs left; their names."""
        named: set[str] = set()
        for v in self._versions():
            m = self.manifest(v)
            named.update(m["data"], [m["snapshot"]] if m["snapshot"] else [])
        old = time.time() - hours * 3600
        gone = [n for n, at in listed(self.spark, f"{self.path}/data").items() if n not in named and at / 1000 <= old]
        for n in gone:
            delete(self.spark, f"{self.path}/data/{n}")
        return gone


def late(source: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `source` that come too late: their key's state is at a later place and the target holds no row of their place."""
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys]
    done = state.groupBy(*keys).agg(F.max("place").alias("done"))
    behind = source.alias("s").join(done.alias("k"), same).where("s.place < done").select("s.*")
    held = state.select(*keys, "place").distinct()
    return behind.alias("s").join(held.alias("k"), [*same, F.col("s.place") == F.col("k.place")], "left_anti")


def changes(source: DataFrame, state: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Rows of `source` that are new or changed, given the last version and place of each key in `state`.

    A row counts if its place comes after the state's and its version differs from that of the row of its key just
    before it, in `source` or else in `state`. Nulls are values, in keys and versions. `spread` names a column that
    grows with `place`; neighbours are compared within one value of it first, and then only the ends of each value, so
    that a key with any share of the rows is spread over tasks.
    """
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    known = state.groupBy(*keys).agg(F.max_by(F.struct("place", F.struct("version").alias("held")), "place").alias("last"))
    rows = source.alias("s").join(known.alias("k"), same("s", "k"), "left").select("s.*", F.col("last.held").alias("held"), F.col("last.place").alias("done"))
    rows = rows.where(F.col("done").isNull() | (F.col("place") > F.col("done")))
    inner = Window.partitionBy(*keys, spread).orderBy("place")
    rows = rows.withColumn("before", F.lag(F.struct("version")).over(inner))
    ends = rows.groupBy(*keys, spread).agg(F.max_by(F.struct("version"), "place").alias("end"))
    ends = ends.withColumn("earlier", F.lag("end").over(Window.partitionBy(*keys).orderBy(spread))).where("earlier is not null").drop("end")
    match = [*same("r", "e"), F.col(f"r.{spread}").eqNullSafe(F.col(f"e.{spread}"))]
    first = rows.where("before is null").alias("r").join(ends.alias("e"), match, "left").select("r.*", "e.earlier")
    first = first.withColumn("before", F.coalesce("earlier", "held")).drop("earlier")
    both = rows.where("before is not null").unionByName(first)
    return both.where(F.col("before").isNull() | ~F.col("before.version").eqNullSafe(F.col("version"))).select(*source.columns)


def process_new(target: Target, source: DataFrame, keys: list[str], spread: str) -> int:
    """One run: publish the new and changed rows of `source` as the next version of `target`; its number.

    `source` has the target's columns and `spread`. An empty source publishes an empty version.
    """
    at = target.latest()
    fresh = changes(source, target.state(at), keys, spread)
    return target.publish(fresh.select(*target.schema.fieldNames()), at, keys)


def handled_entries(plans: DataFrame, reports: DataFrame, stage: str = "tap") -> DataFrame:
    """The feed entries that each run handled, in its working order.

    Plans of one run_id count once. A run's report is its row of `stage` with the latest written_at, and of several at
    one time the one of the highest counts; without one, or with null counts, the run handled nothing; otherwise it
    handled the first processed + skipped elements of feed_entries. Elements without entry_id are left out but keep
    their place. Null lists hold nothing.
    """
    report = reports.where((F.col("stage") == stage) & F.col("run_id").isNotNull()).groupBy("run_id").agg(F.max(F.struct("written_at", "processed", "skipped")).alias("r"))
    report = report.select("run_id", (F.col("r.processed") + F.col("r.skipped")).cast("int").alias("n")).where("n > 0")
    once = plans.where("run_id is not null and feed_entries is not null").groupBy("run_id").agg(F.first(F.struct("datastore", "planned_at", "feed_entries")).alias("p")).select("run_id", "p.*")
    cut = once.join(report, "run_id").select("run_id", "datastore", "planned_at", F.posexplode(F.slice("feed_entries", F.lit(1), F.col("n"))).alias("pos", "e"))
    return cut.select("run_id", "datastore", "planned_at", "pos", "e.feed_url", "e.entry_id", "e.content_hash").where("entry_id is not null")


def changed_entries(plans: DataFrame, reports: DataFrame, path: str, runs: int = 2) -> DataFrame:
    """(run_id, feed_url, entry_id): of each pull run the handled entries that were new or had changed.

    The history is worked off in `runs` runs against the target in `path`, each of which sees the plans of one span of
    time; the result does not depend on how many. Runs planned at one time follow each other by run_id. Runs of unknown
    planned_at come after all others, by run_id, and in the last slice. Empty tables give no rows; other columns are ignored.
    """
    spark = plans.sparkSession
    entries = handled_entries(plans, reports)
    unknown = F.col("planned_at").isNull().alias("unknown")
    place = F.struct(unknown, "planned_at", "run_id", "pos")
    rows = entries.select("datastore", "feed_url", "entry_id", F.col("content_hash").alias("version"), place.alias("place"), F.struct(unknown, F.date_trunc("week", "planned_at").alias("week")).alias("span"))
    rows = keep(rows, "handled")
    target = Target(spark, path, rows.drop("span").schema)
    low, high, n = rows.agg(F.min("place.planned_at"), F.max("place.planned_at"), F.count("*")).first()
    ends = [low + (high - low) * i / runs for i in range(runs)] if low is not None else [None] if n else []
    for i, start in enumerate(ends):
        part = rows.where(F.col("place.unknown") | (F.col("place.planned_at") >= F.lit(start))) if start is not None else rows
        if i + 1 < len(ends):
            part = part.where(F.col("place.planned_at") < F.lit(ends[i + 1]))
        process_new(target, part, ["datastore", "feed_url", "entry_id"], "span")
    return target.rows().select("place.run_id", "feed_url", "entry_id")
