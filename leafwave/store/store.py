"""Observation store: immutable partition directories and an append-only log, both parquet.

A commit writes one directory per (group, commit, date) and a log row naming
the directories that make up the group from then on. Readers take the newest
row of a branch, so an aborted write leaves nothing visible. One writer per
store at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from leafwave.functions.timeutil import between
from leafwave.operators.dedup import batch_actions, dedup_read, mark_existing, prepare_overwrite, skip_reasons
from leafwave.operators.grids import Grid
from leafwave.operators.stored_grid import StoredGrid, load_grid, save_grid
from leafwave.operators.temporal import resample
from leafwave.schema import REGISTRY_SCHEMA, nan_to_null
from leafwave.session import broadcast_checked

LOG_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_id", T.StringType()),
        T.StructField("parent", T.StringType()),
        T.StructField("branch", T.StringType()),
        T.StructField("group", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("written_at", T.TimestampNTZType()),
        T.StructField("tag", T.StringType()),
        T.StructField("dirs", T.ArrayType(T.StringType())),
    ]
)
GROUP_REGISTRY = T.StructType([T.StructField("group", T.StringType()), *REGISTRY_SCHEMA.fields])


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class ObservationStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # -- log --------------------------------------------------------------------

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def log(self) -> DataFrame:
        return self._table("log", LOG_SCHEMA)

    def registry(self, group: str | None = None) -> DataFrame:
        """One row per file offered to the store, with what was done with it."""
        rows = self._table("registry", GROUP_REGISTRY)
        return rows if group is None else rows.where(F.col("group") == group)

    def _append_log(self, rows: list[dict]) -> None:
        ordered = [tuple(r.get(f) for f in LOG_SCHEMA.fieldNames()) for r in rows]
        self.spark.createDataFrame(ordered, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def _head(self, group: str, branch: str) -> dict | None:
        row = (
            self.log()
            .where((F.col("group") == group) & (F.col("branch") == branch) & F.col("tag").isNull())
            .orderBy(F.desc("written_at"))
            .first()
        )
        return None if row is None or row["action"] == "deleted" else row.asDict()

    def group_exists(self, group: str, branch: str = "main") -> bool:
        return self._head(group, branch) is not None

    def groups(self, branch: str = "main") -> DataFrame:
        rows = self.log().where((F.col("branch") == branch) & F.col("tag").isNull())
        last = rows.groupBy("group").agg(F.max_by("action", "written_at").alias("action"))
        return last.where(F.col("action") != "deleted").select("group")

    def history(self, branch: str = "main", limit: int | None = None) -> DataFrame:
        rows = self.log().where((F.col("branch") == branch) & F.col("tag").isNull())
        rows = rows.select("snapshot_id", "parent", "group", "action", "message", "written_at").orderBy(F.desc("written_at"))
        return rows if limit is None else rows.limit(limit)

    def snapshot_dirs(self, snapshot_id: str) -> list[str]:
        row = self.log().where(F.col("snapshot_id") == snapshot_id).first()
        if row is None:
            raise KeyError(f"no snapshot {snapshot_id!r}")
        return list(row["dirs"])

    def compare_snapshots(self, first: str, second: str) -> DataFrame:
        """(dir, change): partitions only one snapshot has, and the common ones."""
        schema = "dir string"
        a = self.spark.createDataFrame([(d,) for d in self.snapshot_dirs(first)], schema)
        b = self.spark.createDataFrame([(d,) for d in self.snapshot_dirs(second)], schema)
        mark = lambda df, c: df.withColumn("change", F.lit(c))
        return (
            mark(a.exceptAll(b), "removed").unionByName(mark(b.exceptAll(a), "added")).unionByName(mark(a.intersect(b), "common"))
        )

    def create_tag(self, name: str, branch: str = "main") -> None:
        """Remember the current snapshot of every group under a name."""
        rows = []
        for r in self.groups(branch).collect():  # group names: receivers of a site
            head = self._head(r["group"], branch)
            rows.append({**head, "tag": name, "written_at": _now()})
        self._append_log(rows)

    def tags(self) -> DataFrame:
        return self.log().where(F.col("tag").isNotNull()).select("tag").distinct()

    def create_branch(self, name: str, source: str = "main") -> None:
        rows = []
        for r in self.groups(source).collect():
            head = self._head(r["group"], source)
            rows.append({**head, "branch": name, "action": "branched", "written_at": _now(), "parent": head["snapshot_id"]})
        self._append_log(rows)

    def branches(self) -> DataFrame:
        return self.log().select("branch").distinct()

    def _rewrite_log(self, keep: DataFrame) -> None:
        """Replace the log; its rows are file names only, so they fit in the driver."""
        rows = [r.asDict() for r in keep.collect()]
        ordered = [tuple(r.get(f) for f in LOG_SCHEMA.fieldNames()) for r in rows]
        self.spark.createDataFrame(ordered, LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/log")

    def delete_tag(self, name: str) -> None:
        self._rewrite_log(self.log().where(F.col("tag").isNull() | (F.col("tag") != name)))

    def delete_branch(self, name: str) -> None:
        if name == "main":
            raise ValueError("the main branch stays")
        self._rewrite_log(self.log().where(F.col("branch") != name))

    def expire_snapshots(self, days: float) -> int:
        """Forget untagged snapshots older than ``days`` that no branch needs; returns how many."""
        log = self.log()
        heads = log.where(F.col("tag").isNull()).groupBy("branch", "group").agg(
            F.max_by("snapshot_id", "written_at").alias("snapshot_id")
        )
        keep_ids = heads.select("snapshot_id").unionByName(log.where(F.col("tag").isNotNull()).select("snapshot_id")).distinct()
        cutoff = _now() - timedelta(days=days)
        recent = log.where(F.col("written_at") >= F.lit(cutoff))
        needed = log.where(F.col("written_at") < F.lit(cutoff)).join(keep_ids, "snapshot_id", "left_semi")
        kept = recent.unionByName(needed)
        gone = log.count() - kept.count()
        if gone:
            self._rewrite_log(kept)
        return gone

    # -- data ---------------------------------------------------------------------

    def _commit(
        self, df: DataFrame, group: str, branch: str, action: str, message: str, keep_dirs: Sequence[str] = (),
    ) -> str:
        commit = uuid.uuid4().hex[:12]
        base = f"{self.root}/data/{group}"
        target = f"{base}/commit={commit}"
        day = nan_to_null(df).withColumn("date", F.to_date("epoch"))
        # One shuffle by day and sid range: few, sorted files per partition.
        day.repartitionByRange("date", "sid").sortWithinPartitions("sid", "epoch").write.partitionBy("date").option(
            "compression", "zstd"
        ).parquet(target)
        try:
            days = self.spark.read.parquet(target).select("date").distinct().collect()  # one row per day
        except AnalysisException:
            days = []
        dirs = [*keep_dirs, *[f"commit={commit}/date={d['date']}" for d in days]]
        parent = self._head(group, branch)
        self._append_log(
            [
                dict(
                    snapshot_id=commit, parent=parent and parent["snapshot_id"], branch=branch, group=group,
                    action=action, message=message, written_at=_now(), tag=None, dirs=dirs,
                )
            ]
        )
        return commit

    def _read_dirs(self, group: str, dirs: Sequence[str]) -> DataFrame:
        base = f"{self.root}/data/{group}"
        return (
            self.spark.read.option("basePath", base).option("mergeSchema", "true").parquet(*[f"{base}/{d}" for d in dirs])
        )

    def read(
        self, group: str, branch: str = "main", time_range: tuple | None = None, date: str | None = None,
        snapshot_id: str | None = None,
    ) -> DataFrame:
        """A group; ``date`` (YYYYDOY) is one UTC day, ``time_range`` is inclusive."""
        if snapshot_id is None:
            head = self._head(group, branch)
            if head is None:
                raise KeyError(f"no group {group!r} on branch {branch!r}")
            dirs = head["dirs"]
        else:
            dirs = self.snapshot_dirs(snapshot_id)
        df = self._read_dirs(group, dirs)
        if date is not None:
            df = df.where(F.col("date") == F.to_date(F.lit(date), "yyyyDDD"))
        if time_range is not None:
            start, end = time_range
            df = df.where(between("epoch", start, end))
            if start is not None:
                df = df.where(F.col("date") >= F.to_date(F.lit(start)))
            if end is not None:
                df = df.where(F.col("date") <= F.to_date(F.lit(end)))
        return df.drop("commit", "date")

    def read_deduplicated(self, group: str, branch: str = "main") -> DataFrame:
        """Epochs inside a registered file interval, the latest write of each (epoch, sid)."""
        head = self._head(group, branch)
        if head is None:
            raise KeyError(f"no group {group!r} on branch {branch!r}")
        written = self.log().select("snapshot_id", F.col("written_at").alias("__at"))
        rows = self._read_dirs(group, head["dirs"]).withColumn("snapshot_id", F.col("commit").cast("string"))
        rows = rows.join(broadcast_checked(written.dropDuplicates(["snapshot_id"]), 100_000), "snapshot_id", "left")
        kept = dedup_read(rows, self.registry(group).where(F.col("action") != "skipped"))
        values = [c for c in kept.columns if c not in ("snapshot_id", "__at", "commit", "date")]
        best = kept.groupBy("epoch", "sid").agg(F.max_by(F.struct(*values), "__at").alias("__r"))
        return best.select("__r.*")

    def write_initial(self, df: DataFrame, group: str, branch: str = "main", message: str = "initial") -> str:
        if self.group_exists(group, branch):
            raise ValueError(f"group {group!r} exists on branch {branch!r}")
        return self._commit(df, group, branch, "initial", message)

    def append(self, df: DataFrame, group: str, branch: str = "main", message: str = "append") -> str:
        head = self._head(group, branch)
        return self._commit(df, group, branch, "append", message, head["dirs"] if head else ())

    def _replace_intervals(self, df: DataFrame, group: str, branch: str, intervals: DataFrame, message: str) -> str:
        """Write ``df`` and drop stored epochs inside the intervals; other days are untouched."""
        head = self._head(group, branch)
        # Days the rewritten files touch: a calendar, not data.
        day = F.explode(F.sequence(F.to_date("start"), F.to_date("end"), F.expr("interval 1 day")))
        touched = {str(r["d"]) for r in intervals.select(day.alias("d")).distinct().collect()}
        hit = [d for d in head["dirs"] if d.rsplit("date=", 1)[1] in touched]
        rest = [d for d in head["dirs"] if d not in hit]
        if hit:
            survivors = prepare_overwrite(self._read_dirs(group, hit).drop("commit", "date"), intervals)
            df = df.unionByName(survivors, allowMissingColumns=True)
        return self._commit(df, group, branch, "overwrite", message, rest)

    def overwrite_file(self, df: DataFrame, group: str, start, end, branch: str = "main", message: str = "overwrite") -> str:
        """Replace the epochs of one file's closed interval."""
        one = self.spark.createDataFrame([(start, end)], "start timestamp_ntz, end timestamp_ntz")
        return self._replace_intervals(df, group, branch, one, message)

    def write_batch(
        self, obs: DataFrame, group: str, strategy: str = "skip", branch: str = "main", message: str = "batch",
    ) -> DataFrame:
        """Write the files of a batch, each known or overlapping one by ``strategy``.

        ``obs`` carries ``rinex_hash`` (and optionally ``path``) per row; rows
        without a hash are left out. Every file gets a registry row with its
        action. Returns those rows.
        """
        has_path = "path" in obs.columns
        first_path = F.min("path") if has_path else F.lit(None).cast("string")
        files = obs.where(F.col("rinex_hash").isNotNull()).groupBy("rinex_hash").agg(
            F.min("epoch").alias("start"), F.max("epoch").alias("end"), first_path.alias("physical_path")
        )
        exists = self.group_exists(group, branch)
        known = self.registry(group).where(F.col("action") != "skipped")
        marked = batch_actions(mark_existing(files, known), strategy, exists)
        stamp = _now()
        rows = marked.select(
            F.lit(group).alias("group"), "rinex_hash", "start", "end", F.lit(None).cast("string").alias("snapshot_id"),
            "action", F.lit(message).alias("commit_msg"), F.lit(stamp).cast("timestamp_ntz").alias("written_at"),
            F.lit(strategy).alias("write_strategy"), F.to_json(F.struct("exists_layer")).alias("attrs"),
            F.lit(None).cast("string").alias("canonical_name"), "physical_path",
        )
        # The decisions are written down before any data moves, so they are
        # taken once; a row per file.
        decided = f"{self.root}/decisions/{uuid.uuid4().hex[:12]}"
        rows.write.parquet(decided)
        rows = self.spark.read.schema(GROUP_REGISTRY).parquet(decided)
        wanted = rows.where(F.col("action") != "skipped")
        if wanted.isEmpty():
            rows.write.mode("append").parquet(f"{self.root}/registry")
            return rows
        data = obs.join(wanted.select("rinex_hash"), "rinex_hash", "left_semi").drop("path")
        redone = wanted.where(F.col("action") == "overwritten")
        if strategy == "overwrite" and exists and not redone.isEmpty():
            snapshot = self._replace_intervals(data, group, branch, redone.select("start", "end"), message)
        elif exists:
            snapshot = self.append(data, group, branch, message)
        else:
            snapshot = self.write_initial(data, group, branch, message)
        rows = rows.withColumn("snapshot_id", F.when(F.col("action") != "skipped", F.lit(snapshot)))
        rows.write.mode("append").parquet(f"{self.root}/registry")
        return rows

    def append_file(
        self, df: DataFrame, group: str, rinex_hash: str, branch: str = "main", overwrite: bool = False, message: str = "append",
    ) -> str | None:
        """Append one file's rows, unless its hash is on record or its time meets a file on record; then nothing is written
        and None returned. With ``overwrite`` stored epochs inside its time are replaced instead."""
        if not self.group_exists(group, branch):
            raise ValueError(f"no group {group!r} on branch {branch!r}")
        if rinex_hash is None:
            raise ValueError("rows without a file hash cannot be appended")
        span = df.agg(F.min("epoch").alias("start"), F.max("epoch").alias("end")).withColumn("rinex_hash", F.lit(rinex_hash))
        one = self.spark.createDataFrame(span.collect(), "start timestamp_ntz, end timestamp_ntz, rinex_hash string")
        known = self.registry(group).where(F.col("action") != "skipped")
        met = not skip_reasons(one, known).where("reason <> ''").isEmpty()
        if met and not overwrite:
            return None
        if met:
            snapshot = self._replace_intervals(df, group, branch, one, message)
        else:
            snapshot = self.append(df, group, branch, message)
        self._record(one, group, snapshot, "overwritten" if met else "appended", message, "overwrite" if overwrite else "append")
        return snapshot

    def _record(self, files: DataFrame, group: str, snapshot: str, action: str, message: str, strategy: str) -> None:
        """Registry rows for (start, end, rinex_hash)."""
        rows = files.select(
            F.lit(group).alias("group"), "rinex_hash", "start", "end", F.lit(snapshot).alias("snapshot_id"), F.lit(action).alias("action"),
            F.lit(message).alias("commit_msg"), F.lit(_now()).cast("timestamp_ntz").alias("written_at"), F.lit(strategy).alias("write_strategy"),
            F.lit("{}").alias("attrs"), F.lit(None).cast("string").alias("canonical_name"), F.lit(None).cast("string").alias("physical_path"),
        )
        rows.write.mode("append").parquet(f"{self.root}/registry")

    def write_vod(
        self, vod: DataFrame, analysis: str, canopy_hash: str, reference_hash: str, branch: str = "main", overwrite: bool = False,
    ) -> str:
        """Write a retrieval once; the registry hash joins both sides' hashes.

        A retrieval of the same two sides that is on record is left alone, or
        with ``overwrite`` replaced, so a run that is repeated changes nothing.
        """
        group, key, message = f"vod_{analysis}", f"{canopy_hash}_{reference_hash}", f"VOD {analysis}"
        before = self.registry(group).where(F.col("rinex_hash") == key).orderBy(F.desc("written_at")).first()
        if before is not None and not overwrite:
            return before["snapshot_id"]
        span = vod.agg(F.min("epoch").alias("start"), F.max("epoch").alias("end")).withColumn("rinex_hash", F.lit(key))
        one = self.spark.createDataFrame(span.collect(), "start timestamp_ntz, end timestamp_ntz, rinex_hash string")
        if before is None:
            snapshot = self.append(vod, group, branch, message)
        else:
            old = self.spark.createDataFrame([(before["start"], before["end"])], "start timestamp_ntz, end timestamp_ntz")
            snapshot = self._replace_intervals(vod, group, branch, old.unionByName(one.select("start", "end")), message)
        self._record(one, group, snapshot, "written" if before is None else "overwritten", message, "overwrite" if overwrite else "append")
        return snapshot

    # -- maintenance ----------------------------------------------------------------

    def compact(self, group: str, branch: str = "main") -> str:
        """Rewrite a group into one commit of large, sorted files."""
        return self._commit(self.read(group, branch), group, branch, "compact", "compact")

    def sanitize(self, group: str, variable: str = "SNR", source: str = "main", branch: str = "sanitized") -> str:
        """Copy a group to a branch without the sids that never have a value."""
        df = self.read(group, source)
        alive = df.where(F.col(variable).isNotNull()).select("sid").distinct()
        return self._commit(df.join(alive, "sid", "left_semi"), group, branch, "sanitize", "drop empty sids")

    def resample_to_branch(self, group: str, freq: str = "1D", source: str = "main", branch: str = "aggregated") -> str:
        return self._commit(resample(self.read(group, source), freq), group, branch, "resample", freq)

    def group_stats(self, branch: str = "main") -> DataFrame:
        """Per group: partitions, commits and files on record."""
        rows = self.log().where((F.col("branch") == branch) & F.col("tag").isNull())
        heads = rows.groupBy("group").agg(
            F.max_by(F.size("dirs"), "written_at").alias("n_partitions"), F.count(F.lit(1)).alias("n_commits")
        )
        files = self.registry().groupBy("group").agg(
            F.count(F.lit(1)).alias("n_files"), F.min("start").alias("first"), F.max("end").alias("last")
        )
        return heads.join(files, "group", "left")

    # -- analysis tables ---------------------------------------------------------------

    def save_table(self, df: DataFrame, kind: str, dataset: str, grid: str, name: str = "default") -> None:
        """Weights, masks, statistics, per-cell series and grids: parquet by dataset, grid and name."""
        df.write.mode("overwrite").parquet(f"{self.root}/analysis/{kind}/dataset={dataset}/grid={grid}/name={name}")

    def load_table(self, kind: str, dataset: str, grid: str, name: str = "default") -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/analysis/{kind}/dataset={dataset}/grid={grid}/name={name}")

    def store_grid(self, grid: Grid, name: str | None = None) -> str:
        """Write a grid with its sky index; ``load_grid`` gives it back ready to assign."""
        name = name or grid.name
        save_grid(self.spark, grid, f"{self.root}/grids/{name}")
        return name

    def load_grid(self, name: str) -> StoredGrid:
        return load_grid(self.spark, f"{self.root}/grids/{name}")

    def list_tables(self, kind: str) -> DataFrame:
        """(dataset, grid, name) of the stored tables of one kind."""
        try:
            return self.spark.read.parquet(f"{self.root}/analysis/{kind}").select("dataset", "grid", "name").distinct()
        except AnalysisException:
            return self.spark.createDataFrame([], "dataset string, grid string, name string")
