"""A topic kept as files: the backend that batch and streaming jobs are tested on.

    <path>/data/commit=<n>/*.parquet        LOG rows
    <path>/data/commit=<n>/_manifest.json   state of the log after this commit
    <path>/staging/<id>/                    invisible to readers

Rows and manifest are staged together and published by one exclusive directory rename. That rename
is the claim on commit ``n``: a second writer with the same ``n`` fails and must not retry with its
old offsets. A crash before it leaves nothing visible, a crash after it leaves a whole commit.
A manifest holds a few numbers per partition and writer, never per-commit history. On object
stores a directory rename is not atomic, so streaming reads need a file system where it is.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from logferry.functions import normalize
from logferry.operators.ranking import offset_stats, renumber
from logferry.operators.small import local_table
from logferry.schemas import LOG, LOG_COLUMNS
from logferry.sources.files import AlreadyPublished, Files, fresh_name

# Rows that one task writes together when a log or archive is laid out.
ROWS_PER_SLAB = 262_144

# Commits whose folders are named one by one instead of listing them all.
LISTED_COMMITS = 256

# Names of forwarding runs begin with this and sort by time; the offsets of the latest are kept.
RUN = "run:"
KEPT_RUNS = 16


@dataclass(frozen=True)
class Head:
    """State of a log after commit ``commit``."""

    commit: int = 0
    low: dict[int, int] = field(default_factory=dict)
    high: dict[int, int] = field(default_factory=dict)
    # Per writing query, the last batch that was committed.
    batches: dict[str, int] = field(default_factory=dict)
    # Per source topic id, or per forwarding run, the next source offset of each partition.
    copied: dict[str, dict[int, int]] = field(default_factory=dict)
    # Bytes of the data files of this commit and all before it.
    total_bytes: int = 0
    # The latest forwarding run whose offsets are no longer kept.
    forgotten: str = ""


class TopicLog:
    def __init__(self, spark: SparkSession, path: str, partitions: int):
        self.spark, self.path, self.partitions = spark, path, partitions
        self.data = f"{path}/data"
        self._files = Files(spark)

    def create(self) -> TopicLog:
        self._files.mkdirs(self.data)
        return self

    def head(self) -> Head:
        return self.at(self._files.last(self.data, "commit"))

    def at(self, commit: int) -> Head:
        """State of the log after a commit; 0 is the empty log."""
        if not commit:
            return Head()
        raw = self._files.read_json(f"{self.data}/commit={commit}/_manifest.json")
        return Head(
            commit,
            _int_keys(raw["low"]),
            _int_keys(raw["high"]),
            raw["batches"],
            {source: _int_keys(offsets) for source, offsets in raw["copied"].items()},
            raw.get("total_bytes", 0),
            raw.get("forgotten", ""),
        )

    def bounds(self, head: Head | None = None) -> DataFrame:
        """BOUNDS of all declared partitions, captured now: later commits do not move them."""
        head = head or self.head()
        rows = (
            {"partition": p, "low": head.low.get(p, 0), "high": head.high.get(p, 0)}
            for p in range(self.partitions)
        )
        return local_table(self.spark, rows, ["partition", "low", "high"])

    def covered(self, offsets: Mapping[int, int]) -> int:
        """The last commit whose records all lie before ``offsets``; 0 if there is none.

        Ends only grow from commit to commit, so a few manifests are looked at, not all.
        """
        covered, beyond = 0, self.head().commit + 1
        while beyond - covered > 1:
            middle = (covered + beyond) // 2
            if all(end <= offsets.get(p, 0) for p, end in self.at(middle).high.items()):
                covered = middle
            else:
                beyond = middle
        return covered

    def reaching(self, offsets: Mapping[int, int]) -> int:
        """The first commit that holds all records before ``offsets``, or the last commit if none does."""
        short, enough = 0, self.head().commit
        while enough - short > 1:
            middle = (short + enough) // 2
            high = self.at(middle).high
            if all(high.get(p, 0) >= end for p, end in offsets.items()):
                enough = middle
            else:
                short = middle
        return enough

    def commit_ranges(self, after: int, upto: int, most_bytes: int) -> Iterator[tuple[int, int, int]]:
        """(after, upto, bytes) of successive ranges of commits. A range holds ``most_bytes`` at most, or one
        commit. Manifests carry running totals, so a few are looked at per range."""
        while after < upto:
            base = self.at(after).total_bytes
            fits, beyond = after + 1, upto + 1
            while beyond - fits > 1:
                middle = (fits + beyond) // 2
                if self.at(middle).total_bytes - base <= most_bytes:
                    fits = middle
                else:
                    beyond = middle
            yield after, fits, self.at(fits).total_bytes - base
            after = fits

    def scan(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """LOG rows. ``after`` and ``upto`` leave out whole commits, by directory: only the folders of a short
        range are listed."""
        reader = self.spark.read.schema(f"{LOG}, commit BIGINT")
        if upto is not None and 0 < upto - after <= LISTED_COMMITS:
            folders = [f"{self.data}/commit={n}" for n in range(after + 1, upto + 1)]
            rows = reader.option("basePath", self.data).parquet(*folders)
        else:
            rows = reader.parquet(self.data)
        if after:
            rows = rows.where(F.col("commit") > after)
        if upto is not None:
            rows = rows.where(F.col("commit") <= upto)
        return normalize(rows).select(*LOG_COLUMNS)

    def commits(self, after: int = 0) -> DataFrame:
        """Unbounded rows of commit numbers, which say that there are new commits. No record is read."""
        rows = self.spark.readStream.schema(f"{LOG}, commit BIGINT").parquet(self.data)
        return rows.where(F.col("commit") > after).select("commit")

    def stream(self, after: int = 0, most_bytes: int | None = None) -> DataFrame:
        """Unbounded LOG rows. Without a limit a micro-batch takes whole commits, so progress is always a
        prefix. With ``most_bytes`` it takes as many files as that allows and may end inside a commit: for
        consumers that need every record once, not every batch to be a prefix. The copies limit their work
        without it, see ``commit_ranges``."""
        reader = self.spark.readStream.schema(f"{LOG}, commit BIGINT")
        if most_bytes is not None:
            reader = reader.option("maxBytesPerTrigger", most_bytes)
        rows = reader.parquet(self.data)
        if after:
            rows = rows.where(F.col("commit") > after)
        return normalize(rows).select(*LOG_COLUMNS)

    def append(
        self,
        rows: DataFrame,
        *,
        batch: tuple[str, int] | None = None,
        copied: tuple[str, Mapping[int, int]] | None = None,
        stats: Sequence[Row] | None = None,
    ) -> Head:
        """Append records in offset order of their partition; they get new offsets.

        ``batch`` = (query, number): a batch that was committed before is not appended again.
        ``copied`` = (source topic id, next source offsets): committed together with the rows.
        ``stats`` are given for rows whose offsets are known to be unique, as those of a log are;
        otherwise repeated offsets are looked for and refused.
        """
        head = self.head()
        if batch and head.batches.get(batch[0], -1) >= batch[1]:
            return head
        rows = normalize(rows)
        if stats is None:
            refuse_repeats(rows)
            stats = offset_stats(rows).collect()
        self._check_ids(stats)
        staged = f"{self.path}/staging/{fresh_name()}"
        placed = renumber(rows, stats, head.high, "offset").select(*LOG_COLUMNS)
        # No sort: rows without gaps keep the order they are read in, ranked ones come in order.
        placed.write.option("compression", "zstd").parquet(staged)
        expected = sum(r["records"] for r in stats)
        # Row counts come from the file footers.
        written = self.spark.read.schema(LOG).parquet(staged).count()
        if written != expected:
            self._files.delete(staged)
            raise RuntimeError(f"staged {written} records but the source held {expected}")
        new = self._after(head, stats, batch, copied)
        self._publish(staged, new)
        return new

    def ingest(self, rows: DataFrame, high: Mapping[int, int] | None = None) -> Head:
        """Append records that already have offsets in this log, gaps included.

        For what was produced elsewhere. ``high`` states ends that lie after the last record.
        """
        head = self.head()
        staged = f"{self.path}/staging/{fresh_name()}"
        (
            normalize(rows)
            .repartition("partition", F.expr(f"`offset` div {ROWS_PER_SLAB}"))
            .sortWithinPartitions("partition", "offset")
            .write.option("compression", "zstd")
            .parquet(staged)
        )
        held = self.spark.read.schema(LOG).parquet(staged)
        try:
            refuse_repeats(held)
        except ValueError:
            self._files.delete(staged)
            raise
        stats = offset_stats(held).collect()
        self._check_ids(stats)
        for row in stats:
            if row["low"] < head.high.get(row["partition"], 0):
                self._files.delete(staged)
                raise ValueError(
                    f"offset {row['low']} of partition {row['partition']} is already taken"
                )
        low = {r["partition"]: r["low"] for r in stats} | head.low
        ends = {r["partition"]: r["high"] for r in stats}
        for partition, end in (high or {}).items():
            ends[partition] = max(ends.get(partition, 0), end)
        new = replace(head, commit=head.commit + 1, low=low, high={**head.high, **ends})
        self._publish(staged, new)
        return new

    def _publish(self, staged: str, new: Head) -> None:
        # ``new`` carries the total of the commit before.
        content = asdict(new) | {"total_bytes": new.total_bytes + self._files.size(staged)}
        del content["commit"]
        self._files.write_json(f"{staged}/_manifest.json", content)
        try:
            self._files.publish(staged, f"{self.data}/commit={new.commit}")
        except AlreadyPublished:
            self._files.delete(staged)
            raise

    def _check_ids(self, stats: Sequence[Row]) -> None:
        strange = [r["partition"] for r in stats if not 0 <= r["partition"] < self.partitions]
        if strange:
            raise ValueError(f"partition {strange[0]} does not exist in {self.path}")

    def _after(self, head, stats, batch, copied) -> Head:
        high = dict(head.high)
        for row in stats:
            high[row["partition"]] = high.get(row["partition"], 0) + row["records"]
        batches = dict(head.batches)
        if batch:
            batches[batch[0]] = batch[1]
        progress = {source: dict(offsets) for source, offsets in head.copied.items()}
        if copied:
            mine = progress.setdefault(copied[0], {})
            for partition, offset in copied[1].items():
                mine[partition] = max(mine.get(partition, offset), offset)
        runs = sorted(r for r in progress if r.startswith(RUN))
        for run in runs[:-KEPT_RUNS]:
            del progress[run]
        forgotten = max([head.forgotten, *runs[:-KEPT_RUNS]])
        return replace(head, commit=head.commit + 1, high=high, batches=batches, copied=progress, forgotten=forgotten)


def refuse_repeats(rows: DataFrame) -> None:
    """Raise where an offset of a partition occurs twice. Shuffles two numbers per record."""
    twice = rows.groupBy("partition", "offset").count().where("count > 1").first()
    if twice:
        raise ValueError(f"offset {twice['offset']} of partition {twice['partition']} occurs {twice['count']} times")


def _int_keys(mapping: Mapping[str, int]) -> dict[int, int]:
    return {int(k): v for k, v in mapping.items()}
