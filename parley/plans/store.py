"""SNK-2, JOIN-2, FIL-3: a store of stage tables from which a run that was broken off goes on.

A stage table lies in a folder named after what it was made of: the stage's name, its parameters
and the versions of its inputs. A run that asks for the same again reads it; a change anywhere
upstream names another folder. Responses of paid calls are kept by request, not by run: a growing
log per stage, in which each request is looked up before it is sent, so that neither a broken run
nor a few new rows pay for earlier calls again.

Everything is written beside its place first and counts only once its marker, a small file created
last and never overwritten, is there. Of two runs that make the same table the first marker wins.
Folders that no run uses any more can be removed.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.model_stage import ModelFn, complete
from parley.schemas import RESPONSES

MARKER = "COMMITTED.json"


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:24]


def files_version(spark: SparkSession, path: str) -> str:
    """Version of a table that is given as files: their names, lengths and times, listed and added up by
    Spark; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    mark = F.xxhash64(name, "length", "modificationTime")
    row = files.select(mark.alias("m")).agg(F.count("m"), F.coalesce(F.sum(F.col("m").cast("decimal(38,0)")), F.lit(0))).first()
    return digest(row[0], str(row[1]))


class StageStore:
    """Stage tables and response logs below ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.used = spark, root.rstrip("/"), set()
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- files

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _folders(self, path: str) -> list[str]:
        if not self.fs.exists(self._path(path)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(path)) if s.isDirectory())

    def _mark(self, folder: str, **said) -> bool:
        """Create the marker of a folder; False if there is one."""
        try:
            out = self.fs.create(self._path(f"{folder}/{MARKER}"), False)
        except Exception:
            if self._marked(folder) is None:
                raise
            return False
        out.write(bytearray(json.dumps(said).encode()))
        out.close()
        return True

    def _marked(self, folder: str) -> dict | None:
        """What a folder's marker says; None without one (or with one that is cut off)."""
        at = f"{folder}/{MARKER}"
        if not self.fs.exists(self._path(at)):
            return None
        stream = self.fs.open(self._path(at))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        except ValueError:
            return None
        finally:
            stream.close()

    # ---- stage tables

    def key(self, name: str, inputs: list[str], **parameters) -> str:
        return f"{name}/{digest(name, inputs, parameters)}"

    def table(self, name: str, build: Callable[[], DataFrame], inputs: list[str], **parameters) -> tuple[DataFrame, str]:
        """The table of a stage and its key, which is the version that later stages name as input.
        ``build`` is called only where the table is not there yet."""
        key = self.key(name, inputs, **parameters)
        folder = f"{self.root}/tables/{key}"
        self.used.add(folder)
        said = self._marked(folder)
        if said is None:
            df = build()
            part = uuid.uuid4().hex[:12]
            df.write.parquet(f"{folder}/{part}")
            self._mark(folder, part=part, schema=df.schema.json())
            said = self._marked(folder)
        schema = T.StructType.fromJson(json.loads(said["schema"]))
        return self.spark.read.schema(schema).parquet(f"{folder}/{said['part']}"), key

    # ---- responses

    def _log(self, stage: str) -> str:
        return f"{self.root}/responses/{stage}"

    def _committed(self, stage: str) -> list[str]:
        folders = (f"{self._log(stage)}/{name}" for name in self._folders(self._log(stage)))
        return [f for f in folders if self.fs.exists(self._path(f"{f}/{MARKER}"))]

    def responses(self, stage: str) -> DataFrame | None:
        """All committed responses of a stage; None without any."""
        folders = self._committed(stage)
        return self.spark.read.schema(RESPONSES).parquet(*(f"{f}/rows" for f in folders)) if folders else None

    def _append(self, stage: str) -> Callable[[DataFrame, str], DataFrame]:
        def write(df: DataFrame, _: str) -> DataFrame:
            folder = f"{self._log(stage)}/{uuid.uuid4().hex[:12]}"
            df.write.parquet(f"{folder}/rows")
            self._mark(folder)
            return self.spark.read.schema(RESPONSES).parquet(f"{folder}/rows")
        return write

    def complete(self, stage: str, requests: DataFrame, model_fn: ModelFn, parts: int = 4, **options) -> tuple[DataFrame, str]:
        """Every response to ``requests`` (the log may hold more) and a version of them. Calls are made and
        committed in ``parts`` ranges of the request id, so that a broken run loses a part at most."""
        place = F.conv(F.substring("request_id", 1, 7), 16, 10).cast("long") * parts / F.lit(1 << 28)
        sliced = requests.select("request_id", "messages", F.floor(place).alias("_part"))
        for i in range(parts):
            mine = sliced.where(F.col("_part") == i).drop("_part")
            existing = self.responses(stage)
            if existing is not None:
                existing = existing.join(mine.select("request_id").distinct(), "request_id", "left_semi").select(*RESPONSES.names)
            complete(mine, model_fn, self._append(stage), existing, **options)
        for f in self._committed(stage):
            self.used.add(f)
        found = self.responses(stage)
        mark = F.sum(F.xxhash64("request_id", "attempt", "status").cast("decimal(38,0)"))
        wanted = requests.select("request_id").distinct()
        row = found.join(wanted, "request_id", "left_semi").agg(F.count(F.lit(1)), mark).first()
        return found, digest(stage, row[0], str(row[1]))

    # ---- removal

    def remove_unused(self) -> list[str]:
        """Delete stage tables that this store object did not read or write, and batches of responses without
        a marker. Committed responses stay: they are paid."""
        gone = []
        for name in self._folders(f"{self.root}/tables"):
            gone += [f for key in self._folders(f"{self.root}/tables/{name}")
                     if (f := f"{self.root}/tables/{name}/{key}") not in self.used]
        for stage in self._folders(f"{self.root}/responses"):
            kept = set(self._committed(stage))
            gone += [f for name in self._folders(self._log(stage)) if (f := f"{self._log(stage)}/{name}") not in kept]
        for folder in gone:
            self.fs.delete(self._path(folder), True)
        return gone
