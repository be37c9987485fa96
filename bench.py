"""Times the headline jobs and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. The source logs are
written before the clock starts; every job runs once to warm up and once for the record. Results of
operators are computed in full but not collected.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from checks.compare import session
from checks.inputs import EVENT_PARTITIONS, ORDER_PARTITIONS, Inputs
from checks.jobs import FAN_IN, actions, split
from logferry.functions import with_digest
from logferry.operators import progress, ranking, scans
from logferry.operators.digest import fingerprint, roundtrip_check
from logferry.plans.run import finish
from logferry.plans.transfer import clone, dump, restore
from logferry.sources.archive import read_archive
from logferry.sources.cluster import Cluster
from logferry.sources.files import shared_folder
from logferry.streaming.jobs import clone_stream, forward


def drained(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


class Bench:
    def __init__(self, folder: str, cpus: int):
        self.spark = session(cpus)
        self.inputs = Inputs(self.spark, folder)
        self.place = shared_folder(self.spark)
        self.source = Cluster(self.spark, f"{self.place}/source", "source")
        self.dest = Cluster(self.spark, f"{self.place}/dest", "dest")
        before, after = split(self.inputs.events_log())
        # Gappy events in two commits, and orders renumbered without gaps.
        self.events = self.source.import_topic("events", before, EVENT_PARTITIONS)
        self.cut = self.events.bounds()
        self.events.ingest(after)
        self.orders = self.source.create_topic("orders", ORDER_PARTITIONS)
        self.orders.append(self.inputs.orders_log())
        self.rows = {"events": self.events.scan().count(), "orders": self.orders.scan().count()}
        self.number = 0
        for log, name in ((self.events, "events"), (self.orders, "orders")):
            dump(log, f"{self.place}/archives/{name}")

    def fresh(self) -> str:
        self.number += 1
        return f"t{self.number}"

    def topic(self, partitions: int) -> str:
        name = self.fresh()
        self.dest.create_topic(name, partitions)
        return name

    def archive(self, name: str) -> DataFrame:
        return read_archive(self.spark, f"{self.place}/archives/{name}", verify=False)

    def jobs(self) -> dict[str, tuple[str, Callable[[], None]]]:
        """Job -> (log whose rows it handles, the work)."""
        saved = progress.fold_progress(scans.bounded_scan(self.events.scan(), self.cut))

        def stream_clone():
            name = self.topic(EVENT_PARTITIONS)
            place = f"{self.place}/checkpoints/{name}"
            finish([clone_stream(self.source, "events", self.dest, name, place, True)])

        def stream_forward():
            name = self.topic(EVENT_PARTITIONS)
            place = f"{self.place}/checkpoints/{name}"
            finish([forward(self.source, "events", self.dest, name, place, self.cut, True)])

        def resume():
            bounds = self.events.bounds()
            drained(scans.resume_scan(self.events.scan(), saved, bounds))

        def copy(name: str, partitions: int):
            return lambda: clone(self.source, name, self.dest, self.topic(partitions))

        def refill(name: str, partitions: int):
            return lambda: restore(
                self.dest, self.topic(partitions), f"{self.place}/archives/{name}"
            )

        def archive(log):
            return lambda: dump(log, f"{self.place}/archives/{self.fresh()}")

        return {
            "record_digest": ("events", lambda: drained(with_digest(self.events.scan()))),
            "partition_sequence": (
                "orders",
                lambda: drained(ranking.partition_sequence(self.orders.scan())),
            ),
            "topic_watermarks": (
                "orders",
                lambda: drained(scans.watermarks(self.orders.scan(), ORDER_PARTITIONS)),
            ),
            "resume_scan": ("events", resume),
            "topic_fingerprint": (
                "events",
                lambda: drained(fingerprint(self.archive("events"), EVENT_PARTITIONS, FAN_IN)),
            ),
            "roundtrip_check": (
                "events",
                lambda: drained(
                    roundtrip_check(self.archive("events"), self.archive("events"), FAN_IN)
                ),
            ),
            "dump_job": ("events", archive(self.events)),
            "dump_job_dense": ("orders", archive(self.orders)),
            "restore_job": ("events", refill("events", EVENT_PARTITIONS)),
            "clone_bounded": ("events", copy("events", EVENT_PARTITIONS)),
            "clone_bounded_dense": ("orders", copy("orders", ORDER_PARTITIONS)),
            "clone_continuous": ("events", stream_clone),
            "forward_new": ("events", stream_forward),
            "reconcile_actions": ("orders", lambda: drained(actions(self.inputs))),
        }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    bench = Bench(folder, cpus)
    seconds, rates = {}, {}
    for name, (log, work) in bench.jobs().items():
        work()
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)
        rates[name] = round(bench.rows[log] / seconds[name])
    line = {
        "metric": "headline log jobs, total seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": rates,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    bench.spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
