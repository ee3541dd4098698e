"""A resumable store of cases: versions in batches, a log of commits, a ledger of ids, JSON Lines by year.

A save writes its rows to a folder of its own and then commits: a small manifest, the next number of
the log, created only if no one else has created it. Until then nothing has changed for readers;
afterwards the batch has replaced the one of its name, if any. A snapshot is what the log says up to
a number, so reading as of an older commit, saving at the same time from several places and
running a batch again need no locks and lose nothing. The ledger is a view over the
committed batches: an id is known as long as some batch holds it.
"""

from __future__ import annotations

import datetime
import errno
import json
import os
import uuid
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketspark.plans.stored import fresh

FORMATS = ("table", "jsonl", "both")
#: A manifest's name is its number, so that names sort as numbers do.
_DIGITS = 12
LEDGER = "id string, first_saved_at timestamp, batch string"


def year_key(df: DataFrame) -> DataFrame:
    return df.withColumn("year_key", F.coalesce(F.col("year").cast("string"), F.lit("unknown")))


def with_ids(cases: DataFrame) -> DataFrame:
    """Rows without an id, or with an empty one, are left out."""
    return cases.where(F.coalesce(F.col("id").cast("string"), F.lit("")) != "")


def latest(versions: DataFrame, stamp: str = "_scraped_at") -> DataFrame:
    """The newest version of each id. max_by aggregates map-side, so many versions of one id do not meet in a task.

    Each column has a max_by of its own, all by one place, so that only columns that are used are shuffled.
    """
    rest, place = [c for c in versions.columns if c != "id"], fresh(versions, "place")
    placed = versions.withColumn(place, F.struct(F.col(stamp), F.xxhash64(*rest)))
    return placed.groupBy("id").agg(*[F.max_by(c, place).alias(c) for c in rest]).select(*versions.columns)


def unfetched(ids: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows whose id is not in the ledger yet."""
    return ids.join(ledger.select("id"), "id", "left_anti")


def next_batch(ids: DataFrame, ledger: DataFrame, limit: int | None = None) -> DataFrame:
    """The next `limit` unfetched rows by id; none or 0: all."""
    left = unfetched(ids, ledger)
    return left.orderBy("id").limit(limit) if limit else left


def year_counts(cases: DataFrame) -> DataFrame:
    """year_key, n: how many cases each partition of the JSON Lines would get."""
    return year_key(with_ids(cases)).groupBy("year_key").agg(F.count(F.lit(1)).alias("n"))


class CommitLog:
    """Manifests under one folder, numbered from 1 without gaps; each is there as a whole or not at all."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def last(self) -> int:
        """The number of the last commit; 0 before the first."""
        folder, files = self._at()
        if not files.exists(folder):
            return 0
        names = [f.getPath().getName() for f in files.listStatus(folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def read(self, number: int) -> dict:
        path, files = self._at(f"{number:0{_DIGITS}d}.json")
        stream = files.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _created(self, number: int, body: str) -> bool:
        """Whether this manifest was put in place; not if the number is taken. It is written under another name first."""
        final, files = self._at(f"{number:0{_DIGITS}d}.json")
        draft, _ = self._at(f".draft-{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(body.encode())
        out.close()
        try:
            if files.getUri().getScheme() == "file":  # a local rename replaces what is there, a link doesn't
                os.link(draft.toUri().getPath(), final.toUri().getPath())
                return True
            context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
            none = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            context.rename(draft, final, options)
            return True
        except OSError as e:
            if e.errno != errno.EEXIST:
                raise
            return False
        except Exception:
            if files.exists(final):
                return False
            raise
        finally:
            files.delete(draft, False)

    def append(self, make) -> int:
        """Commits make(number), trying the numbers after the last until one is free; returns the number."""
        while True:
            number = self.last() + 1
            if self._created(number, json.dumps(make(number))):
                return number

    def upto(self, number: int | None = None) -> list[dict]:
        """The manifests that make up a snapshot, oldest first: those since the last one that stands for all before it."""
        last = self.last() if number is None else number
        if number is not None and not 0 <= number <= self.last():
            raise ValueError(f"there is no commit {number}")
        found = []
        for k in range(last, 0, -1):
            found.append(self.read(k))
            if found[-1].get("whole"):
                break
        return found[::-1]


@dataclass
class Snapshot:
    """What a compaction folded (base: versions, ids: their ledger, requests by day), and the batches since: live ones by name, all in order."""

    base: str | None = None
    ids: str | None = None
    requests: dict[str, int] = field(default_factory=dict)
    live: dict[str, dict] = field(default_factory=dict)
    since: list[dict] = field(default_factory=list)

    def versions(self) -> list[str]:
        return [f for f in (self.base, *(e["versions"] for e in self.live.values())) if f]

    def requests_by_day(self) -> dict[str, int]:
        found = dict(self.requests)
        for e in self.since:
            day = e["at"][:10]
            found[day] = found.get(day, 0) + e.get("requests", 0)
        return found


class CaseStore:
    """Versions, ledger and lines under one folder; reading takes the latest version of each id."""

    def __init__(self, spark: SparkSession, path: str, save_format: str = "both"):
        if save_format not in FORMATS:
            raise ValueError(f"format must be one of {FORMATS}, not {save_format!r}")
        self.spark, self.path, self.save_format = spark, path.rstrip("/"), save_format
        self.log = CommitLog(spark, f"{self.path}/commits")

    def _snapshot(self, as_of: int | None = None) -> Snapshot:
        found = Snapshot()
        for manifest in self.log.upto(as_of):
            if manifest.get("whole"):
                found = Snapshot(manifest["base"], manifest["ids"], manifest["requests"], {e["batch"]: e for e in manifest["live"]}, manifest["since"])
            else:
                found.live[manifest["batch"]] = manifest
                found.since.append(manifest)
        return found

    def save(self, cases: DataFrame, batch: str | None = None, requests: int = 0) -> int:
        """Stamps and stores the cases as a batch; returns the number of the commit, which also tells how many requests it took.

        The cases are computed once, to the first file written; ids and lines derive from that file.
        Saving again under the same name, as a retry does, replaces the batch.
        """
        name = batch or uuid.uuid4().hex
        own = f"commit={uuid.uuid4().hex}"
        stamped = with_ids(cases).withColumn("_scraped_at", F.current_timestamp())
        lines = f"{self.path}/jsonl/batch={name}"
        entry = {"batch": name, "versions": None, "ids": f"ids/{own}", "requests": requests, "at": datetime.datetime.now(datetime.UTC).isoformat()}
        if self.save_format == "jsonl":
            year_key(stamped).write.mode("overwrite").partitionBy("year_key").json(lines)
            kept = self.spark.read.schema("id string, _scraped_at timestamp").json(lines)
        else:
            entry["versions"] = f"versions/{own}"
            stamped.write.parquet(f"{self.path}/{entry['versions']}")
            kept = self.spark.read.schema(stamped.schema).parquet(f"{self.path}/{entry['versions']}")
        ids = kept.groupBy(F.col("id").cast("string").alias("id")).agg(F.min("_scraped_at").alias("saved_at"))
        ids.write.parquet(f"{self.path}/{entry['ids']}")
        number = self.log.append(lambda _: entry)
        if self.save_format == "both":  # an export of what is committed: a failure here leaves the store whole
            year_key(kept).write.mode("overwrite").partitionBy("year_key").json(lines)
        return number

    def saved(self, number: int) -> int:
        """How many cases a commit of a batch saved."""
        return self.spark.read.parquet(f"{self.path}/{self.log.read(number)['ids']}").count()

    def requests(self, day: datetime.date | None = None) -> int:
        """Requests of all commits, or of one day (UTC)."""
        by_day = self._snapshot().requests_by_day()
        return sum(by_day.values()) if day is None else by_day.get(day.isoformat(), 0)

    def versions(self, as_of: int | None = None) -> DataFrame | None:
        """All versions of a snapshot; none before the first save."""
        folders = self._snapshot(as_of).versions()
        return self.spark.read.option("mergeSchema", True).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else None

    def cases(self, as_of: int | None = None) -> DataFrame | None:
        """The latest version of every case, as of a commit or now; none before the first save."""
        versions = self.versions(as_of)
        return None if versions is None else latest(versions)

    def ledger(self, as_of: int | None = None) -> DataFrame:
        """id, when it was first saved, and the first batch that holds it; ids that no batch holds any more are not in it."""
        found = self._snapshot(as_of)
        if not found.since and not found.ids:
            return self.spark.createDataFrame([], LEDGER)
        # what a compaction folded comes first, and is held whatever was saved since
        parts = []
        if found.ids:
            folded = self.spark.read.schema(LEDGER).parquet(f"{self.path}/{found.ids}")
            parts.append(folded.select("id", F.col("first_saved_at").alias("saved_at"), F.struct(F.lit(-1).alias("place"), "batch").alias("held")))
        if found.since:
            kept = {e["ids"] for e in found.live.values()}
            entries = [(e["ids"].rsplit("/", 1)[1], n, e["batch"], e["ids"] in kept) for n, e in enumerate(found.since)]
            batches = self.spark.createDataFrame(entries, "folder string, place int, batch string, kept boolean")
            rows = self.spark.read.schema("id string, saved_at timestamp").parquet(*[f"{self.path}/{e['ids']}" for e in found.since])
            rows = rows.withColumn("folder", F.element_at(F.split("_metadata.file_path", "/"), -2)).join(batches, "folder")
            parts.append(rows.select("id", "saved_at", F.when(F.col("kept"), F.struct("place", "batch")).alias("held")))
        summed = reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.min("saved_at").alias("first_saved_at"), F.min("held").alias("held"))
        return summed.where("held is not null").select("id", "first_saved_at", "held.batch")

    def compact(self, files: int | None = None, row_group_bytes: int = 16 << 20) -> int:
        """Folds all versions into the latest of each id, in files sorted by id with Bloom filters on it, and the ledger into one table.

        Returns the number of the commit. Batches committed meanwhile stay beside the folded ones. A folded batch is sealed: saving it
        again adds versions and takes nothing back.
        """
        seen = self.log.last()
        versions, folded = self.versions(seen), self._snapshot(seen)
        if versions is None:
            return seen
        own = uuid.uuid4().hex
        base, ids = f"base/commit={own}", f"ids/commit={own}"
        n = files or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        placed = latest(versions).repartitionByRange(n, "id").sortWithinPartitions("id")
        writer = placed.write.option("parquet.bloom.filter.enabled#id", "true").option("parquet.block.size", row_group_bytes)
        writer.parquet(f"{self.path}/{base}")
        self.ledger(seen).write.parquet(f"{self.path}/{ids}")

        def manifest(number: int) -> dict:
            now = self._snapshot(number - 1)
            if now.base != folded.base or any(now.live[name]["ids"] != e["ids"] for name, e in folded.live.items()):
                raise RuntimeError("what was folded has been folded or saved again meanwhile; compact once more")
            live = [e for name, e in now.live.items() if name not in folded.live]
            since = now.since[len(folded.since) :]
            return {"whole": True, "base": base, "ids": ids, "requests": folded.requests_by_day(), "live": live, "since": since}

        return self.log.append(manifest)

    def load(self, id_: str, as_of: int | None = None) -> DataFrame | None:
        return self.load_all([id_], as_of)

    def load_all(self, ids: list[str], as_of: int | None = None) -> DataFrame | None:
        """The latest version of each of these few ids; for many, join with a table of them.

        Each id is a condition of its own, so that all reach the files: statistics and Bloom filters of
        sorted files leave few row groups. A long list would be pushed down as its range only.
        """
        versions = self.versions(as_of)
        if versions is None or not ids:
            return None if versions is None else versions.limit(0)
        asked = [F.col("id") == i for i in ids]
        while len(asked) > 1:  # halved, so that many ids don't nest deeply
            asked = [reduce(or_, asked[k : k + 2]) for k in range(0, len(asked), 2)]
        return latest(versions.where(asked[0]))

    def is_fetched(self, id_: str) -> bool:
        return bool(self.ledger().where(F.col("id") == id_).take(1))

    def stats(self) -> dict:
        """total_cases, years, tracked."""
        cases = self.cases()
        found = {"total_cases": 0, "years": 0} if cases is None else cases.agg(
            F.count(F.lit(1)).alias("total_cases"), F.count_distinct(F.coalesce(F.col("year").cast("string"), F.lit("unknown"))).alias("years")
        ).first().asDict()
        return {**found, "tracked": self.ledger().count()}

    def vacuum(self, keep_from: int) -> int:
        """Deletes the folders that no snapshot since commit keep_from reads; returns how many."""
        kept = [self._snapshot(number) for number in range(max(1, keep_from), self.log.last() + 1)]
        used = {f for s in kept for f in (*s.versions(), s.ids, *(e["ids"] for e in s.since))}
        gone = 0
        for kind in ("versions", "base", "ids"):
            folder, files = self.log._at(f"../{kind}")
            for entry in files.listStatus(folder) if files.exists(folder) else ():
                if f"{kind}/{entry.getPath().getName()}" not in used:
                    files.delete(entry.getPath(), True)
                    gone += 1
        return gone
