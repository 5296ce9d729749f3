"""The log of a run: lifecycle, warnings and errors as JSON files beside its results (inventory R9, K7).

Entries are few (a handful a bundle) and each is a file of its own, so driver restarts and
several runs never overwrite one another.  Errors of single records are not here but in the
table of records with an error, which grows with the corpus.
"""

from __future__ import annotations

import json
import time
import traceback
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..sources import scratch

KINDS = ("info", "warning", "error")
SCHEMA = "kind string, message string, infos string, stack string, time long"


class RunLog:
    """Writes entries below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def write(self, kind: str, message: str, infos: str = "No information", stack: str = "") -> None:
        if kind not in KINDS:
            raise ValueError(f"kinds are {KINDS}")
        now = time.time_ns()
        entry = {"kind": kind, "message": message, "infos": infos, "stack": stack, "time": now // 1_000_000}
        scratch.put(self.spark, f"{self.folder}/{now:020d}-{uuid.uuid4().hex}.json", json.dumps(entry) + "\n")

    def info(self, message: str, infos: str = "No information") -> None:
        self.write("info", message, infos)

    def warning(self, message: str, infos: str = "No information") -> None:
        self.write("warning", message, infos)

    def error(self, e: BaseException, infos: str = "No information") -> None:
        self.write("error", str(e) or "Unknown error", infos, "".join(traceback.format_exception(e)))

    def entries(self) -> DataFrame:
        """All entries so far."""
        return self.spark.read.schema(SCHEMA).json(self.folder)

    def listener(self, name: str) -> StreamingQueryListener:
        """Writes what becomes of the streaming query of that name."""
        log = self

        class Listener(StreamingQueryListener):
            own: set = set()

            def onQueryStarted(self, event):
                if event.name == name:
                    self.own.add(str(event.runId))
                    log.info("stream started", str(event.runId))

            def onQueryProgress(self, event):
                p = event.progress
                if str(p.runId) in self.own:
                    log.info(f"bundle {p.batchId}: {p.numInputRows} files", str(p.runId))

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                if str(event.runId) in self.own:
                    self.own.discard(str(event.runId))
                    if event.exception:
                        log.write("error", event.exception.splitlines()[0], str(event.runId), event.exception)
                    else:
                        log.info("stream ended", str(event.runId))

        return Listener()
