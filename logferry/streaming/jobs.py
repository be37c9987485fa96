"""Continuous copies as Structured Streaming queries.

A micro-batch says that a source has more; what it has is taken over in pieces of about ``most_bytes``, each
one commit of the destination log together with the source offsets it covers. Work between two saved
positions is therefore bounded, whatever has piled up, and a failure redoes one piece.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from logferry.plans.transfer import (
    SourceCluster,
    Untrusted,
    committed_progress,
    same_shape,
    save_progress,
    take_over,
    trusted_head,
)
from logferry.sources.cluster import Cluster
from logferry.sources.files import Files, fresh_name
from logferry.sources.source import PIECE_BYTES, Source
from logferry.sources.topic_log import RUN, Head, TopicLog

#: Seconds between two attempts at a piece that failed: at first, and at most.
FIRST_WAIT, LONGEST_WAIT = 0.5, 60.0


@dataclass
class Figures:
    """What a running copy says of itself. Its micro-batches write here, ``status`` reads."""

    #: Next source offset of each partition.
    next_offset: dict[int, int] = field(default_factory=dict)
    #: Message of the last attempt at a partition, while it has not succeeded since.
    last_error: dict[int, str] = field(default_factory=dict)
    pieces: int = 0
    records: int = 0


def clone_stream(
    source: SourceCluster,
    source_topic: str,
    dest: Cluster,
    name: str,
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
    most_bytes: int = PIECE_BYTES,
    patience: float = 0.0,
    figures: Figures | None = None,
) -> StreamingQuery:
    """Keep ``name`` up to date with ``source_topic``, with saved progress.

    The progress committed with the records decides, not the checkpoint: what the destination already holds
    is not read again. A replayed batch adds nothing and a lost checkpoint costs nothing but a listing.
    ``every`` is the time between micro-batches. A piece that fails is tried again for ``patience`` seconds,
    so an outage of the destination is waited through. ``figures`` is kept up to date.
    """
    figures = Figures() if figures is None else figures
    origin, target = source.source(source_topic), dest.describe(name)
    same_shape(origin, target)
    log = dest.open(target).create()
    copied = trusted_head(log, origin.topic_id).copied.get(origin.topic_id, {})

    def copy(batch: DataFrame, batch_id: int) -> None:
        here = Cluster(batch.sparkSession, dest.root, dest.cluster_id)
        sink = here.open(target)

        def save(head: Head) -> None:
            save_progress(here, target, origin, committed_progress(sink, head, origin.topic_id))

        head_of = lambda: trusted_head(sink, origin.topic_id)
        _take_all(origin, sink, origin.topic_id, head_of, {}, batch, most_bytes, patience, figures, save)

    return _start(origin.changes(copied), copy, f"clone {name}", checkpoint, available_now, every)


def forward(
    source: SourceCluster,
    source_topic: str,
    dest: Cluster,
    name: str,
    checkpoint: str,
    bounds: DataFrame | None = None,
    available_now: bool = False,
    every: str | None = None,
    positions: dict[int, int] | None = None,
    most_bytes: int = PIECE_BYTES,
    patience: float = 0.0,
    figures: Figures | None = None,
) -> StreamingQuery:
    """Forward records produced after now (or after ``bounds``).

    Nothing is remembered for the next run, which takes a new ``checkpoint`` folder. Starting again
    with the same folder continues the same run: from the end captured then, without repeating a
    record. ``positions`` is filled with the next source offset per partition, for status only. A piece
    that fails is tried again for ``patience`` seconds. ``figures`` is kept up to date.
    """
    figures = Figures() if figures is None else figures
    origin, target = source.source(source_topic), dest.describe(name)
    same_shape(origin, target)
    dest.open(target).create()
    run, ends = _run(Files(dest.spark), origin, checkpoint, bounds)

    def copy(batch: DataFrame, batch_id: int) -> None:
        sink = Cluster(batch.sparkSession, dest.root, dest.cluster_id).open(target)

        def head_of() -> Head:
            head = sink.head()
            if run not in head.copied and run <= head.forgotten:
                raise Untrusted(f"the run of {checkpoint} is too long ago; start a new one")
            return head

        def note(head: Head) -> None:
            if positions is not None:
                positions.update(head.copied.get(run, {}))

        _take_all(origin, sink, run, head_of, ends, batch, most_bytes, patience, figures, note)

    return _start(origin.changes(ends), copy, f"forward {name}", checkpoint, available_now, every)


def _take_all(
    origin: Source,
    sink: TopicLog,
    key: str,
    head_of: Callable[[], Head],
    starts: Mapping[int, int],
    batch: DataFrame,
    most_bytes: int,
    patience: float,
    figures: Figures,
    after: Callable[[Head], None],
) -> None:
    """Take over all that a micro-batch announces. Each attempt begins at what the destination has committed,
    so trying again neither loses nor repeats a record, wherever the failure was."""
    wait, given_up = FIRST_WAIT, time.monotonic() + patience
    concerned = set(range(origin.partitions))
    while True:
        try:
            head = head_of()
            at = {p: head.copied.get(key, {}).get(p, starts.get(p, 0)) for p in range(origin.partitions)}
            for piece in origin.arrived(batch, at, most_bytes):
                concerned = {p for p, end in piece.ends.items() if end > at.get(p, 0)}
                held = sum(head.high.values())
                head = take_over(sink, key, piece, head)
                after(head)
                at |= piece.ends
                figures.pieces += 1
                figures.records += sum(head.high.values()) - held
                figures.next_offset |= piece.ends
                for p in concerned:
                    figures.last_error.pop(p, None)
                wait, given_up = FIRST_WAIT, time.monotonic() + patience
            after(head)
            figures.next_offset |= head.copied.get(key, {})
            figures.last_error.clear()
            return
        except Exception as error:
            figures.last_error |= dict.fromkeys(concerned, str(error))
            if isinstance(error, Untrusted) or time.monotonic() + wait > given_up:
                raise
            time.sleep(wait)
            wait = min(2 * wait, LONGEST_WAIT)


def _run(files: Files, origin: Source, checkpoint: str, bounds: DataFrame | None) -> tuple[str, dict[int, int]]:
    """Name and captured ends of the run that ``checkpoint`` belongs to. Names sort by time."""
    note = f"{checkpoint}/forward.json"
    if not files.exists(note):
        ends = (origin.bounds() if bounds is None else bounds).select("partition", "high").collect()
        files.mkdirs(checkpoint)
        # Written aside and renamed, so that a crash leaves a whole note or none.
        name = f"{RUN}{time.time_ns():020d}-{fresh_name()}"
        files.write_json(f"{note}.new", {"run": name, "ends": [[p, high] for p, high in ends]})
        files.publish(f"{note}.new", note)
    saved = files.read_json(note)
    return saved["run"], dict(saved["ends"])


def _start(rows, copy, name, checkpoint, available_now, every) -> StreamingQuery:
    writer = (
        rows.writeStream.foreachBatch(copy)
        .queryName(f"{name} {fresh_name()[:8]}")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()
