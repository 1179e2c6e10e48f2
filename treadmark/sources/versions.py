"""Tables of days that are replaced in one step.

A version is a small manifest that names, for each day, the load that holds it.  A writer first writes a load of its own,
which nobody reads yet, and then renames its manifest into place; that is the moment of change.  A run that dies before it
leaves the old version, one that dies after it the new one.  Loads that no manifest names are swept up later.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from treadmark import schemas

MANIFESTS = "_manifests"


class StaleVersion(RuntimeError):
    """Another writer has changed the table since this one began."""


@dataclass(frozen=True)
class Version:
    """``loads`` gives the load of each day (in ISO form); version 0 is a table that was never written."""

    number: int = 0
    loads: dict[str, str] = field(default_factory=dict)


class DayTable:
    """A table partitioned by the days of one column; ``fields`` are its other columns."""

    def __init__(self, spark: SparkSession, path: str, fields: schemas.Fields, day: str):
        self.spark, self.path, self.fields, self.day = spark, path.rstrip("/"), fields, day
        jvm = spark.sparkContext._jvm
        self._to_path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._to_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._to_path(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def current(self) -> Version:
        """The newest version; a manifest that is still being written has another name and is not seen."""
        done = [n for n in self._names(f"{self.path}/{MANIFESTS}") if n.endswith(".json")]
        if not done:
            return Version()
        lines = self.spark.read.text(f"{self.path}/{MANIFESTS}/{done[-1]}", wholetext=True).collect()  # one name for each day
        told = json.loads(lines[0][0])
        return Version(told["version"], told["loads"])

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version (the newest); the day comes from the folders, so filters on it prune."""
        version = version or self.current()
        text = f"{schemas.ddl(self.fields)}, `{self.day}` date"
        if not version.loads:
            return self.spark.createDataFrame([], text)
        folders = [f"{self.path}/load={load}/{self.day}={day}" for day, load in sorted(version.loads.items())]
        df = self.spark.read.schema(f"{text}, load string").option("basePath", self.path).parquet(*folders)
        return df.drop("load")

    def stage(self, df: DataFrame, start: dt.date, end: dt.date) -> str:
        """Write the rows of the days [start, end] as a load that no version names yet."""
        load = uuid.uuid4().hex
        rows = df.where(F.col(self.day).between(F.lit(start), F.lit(end))).select(*schemas.names(self.fields), self.day)
        rows.write.partitionBy(self.day).parquet(f"{self.path}/load={load}")
        return load

    def commit(self, base: Version, load: str, start: dt.date, end: dt.date) -> Version:
        """The days [start, end] become those of ``load``, all at once, if the table is still at ``base``."""
        first, last = start.isoformat(), end.isoformat()
        new = {n.split("=", 1)[1]: load for n in self._names(f"{self.path}/load={load}") if n.startswith(f"{self.day}=")}
        kept = {day: other for day, other in base.loads.items() if not first <= day <= last}
        version = Version(base.number + 1, kept | new)
        place = self._to_path(f"{self.path}/{MANIFESTS}/{version.number:012d}.json")
        fresh = self._to_path(f"{self.path}/{MANIFESTS}/{load}.new")
        out = self._fs.create(fresh, True)
        out.write(bytearray(json.dumps({"version": version.number, "loads": version.loads}).encode()))
        out.close()
        if self._fs.exists(place) or not self._fs.rename(fresh, place):
            self._fs.delete(fresh, False)
            raise StaleVersion(f"{self.path} is no longer at version {base.number}")
        return version

    def replace(self, df: DataFrame, start: dt.date, end: dt.date) -> Version:
        """Replace the days [start, end]; ``df`` may read the table itself.  Days without rows go."""
        base = self.current()
        return self.commit(base, self.stage(df, start, end), start, end)

    def sweep(self) -> int:
        """Delete loads that the newest version does not name; for when no reader or writer is at work."""
        named = set(self.current().loads.values())
        unnamed = [n for n in self._names(self.path) if n.startswith("load=") and n.removeprefix("load=") not in named]
        for name in unnamed:
            self._fs.delete(self._to_path(f"{self.path}/{name}"), True)
        return len(unnamed)
