"""What tables of catalog partitions share: partitions are rewritten beside the old ones and swapped in the catalog."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.tables import described_location, files_at, location_of, quoted

# Partitions named in one statement.
SPECS_PER_STATEMENT = 500
# Folder of rewritten partitions, below the table's own.
VERSIONS = "_versions"
# Partitions of the catalog that are described or moved in one call.
LISTED_AT_ONCE = 1000
# As the catalog describes a partition.
DESCRIBED = re.compile(r"^Partition Values: \[(.*)\]$|^Location: (.*)$", re.M)


# File operations under way at once; each concerns one folder and is mostly waiting.
AT_ONCE = 16


def _each(do: Callable, items: Iterable) -> list:
    """``do`` of every item, several at once; the first failure is raised."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(do, items))


@dataclass
class Staged:
    """Rewritten partitions: a table beside the real one that has them, their folder, and the path of each."""

    table: str
    folder: str
    written: list[str]

    def at(self, path: str) -> str:
        return f"{self.folder}/{path}"


def _values(path: str) -> str:
    """Path of a partition as the catalog prints its values."""
    return "/".join(map(unquote, path.split("/")))


def _upwards(folder: str, upper: list[str]) -> list[str]:
    """The folder of a partition, and above it those of the partition columns before its last."""
    out = [folder]
    for column in reversed(upper):
        above = out[-1].rpartition("/")[0]
        if not above.rpartition("/")[2].startswith(f"{column}="):
            break
        out.append(above)
    return out


class PartitionedTable:
    """A catalog table with partitions of its own folders; ``name`` is the table's."""

    spark: SparkSession
    name: str

    def _partition_columns(self, df: DataFrame) -> list[str]:
        raise NotImplementedError

    def _spec(self, path: str) -> str:
        """Full partition spec of a catalog entry such as ``a=1/b=2``."""
        raise NotImplementedError

    def _partitions(self) -> DataFrame:
        """The catalog's partition list, one row per partition, without opening data."""
        return self.spark.sql(f"SHOW PARTITIONS {quoted(self.name)}")

    def _folder(self, path: str) -> str:
        """Where the catalog has a partition's files."""
        return described_location(self.spark, f"{quoted(self.name)} {self._spec(path)}")

    def _listed(self, name: str) -> Iterable:
        """The catalog's own entries of a table's partitions, many at once."""
        state = self.spark._jsparkSession.sessionState()
        found = state.catalog().listPartitions(
            state.sqlParser().parseTableIdentifier(quoted(name)), self.spark._jvm.scala.Option.empty())
        groups = found.grouped(LISTED_AT_ONCE)
        while groups.hasNext():
            yield groups.next()

    def _folders(self) -> dict[str, str]:
        """Where the catalog has each partition's files, by the values of its path; no statement per partition."""
        out = {}
        for some in self._listed(self.name):
            values = None
            for told, folder in DESCRIBED.findall(re.sub(r"^\s+", "", some.mkString("\n"), flags=re.M)):
                if folder:
                    out[values] = folder.rstrip("/")
                else:
                    values = told.replace(", ", "/")
        return out

    def _forget(self, paths: list[str], folders: dict[str, str]) -> None:
        location = location_of(self.spark, self.name)
        for at in range(0, len(paths), SPECS_PER_STATEMENT):
            specs = ", ".join(self._spec(p) for p in paths[at:at + SPECS_PER_STATEMENT])
            self.spark.sql(f"ALTER TABLE {quoted(self.name)} DROP IF EXISTS {specs}")
        # the default folder too: an insert would find what an interrupted rewrite left there
        self._clear({folders[values] for values in map(_values, paths) if values in folders}
                    | {f"{location}/{path}" for path in paths})

    def _clear(self, folders: Iterable[str]) -> None:
        """Delete folders that no partition has; a parent partition's folder at once if none has anything below it."""
        if not folders:
            return
        upper = self._partition_columns(self.spark.table(quoted(self.name)))[:-1]
        live = {above for folder in self._folders().values() for above in _upwards(folder, upper)}
        _each(self._delete, {[f for f in _upwards(folder, upper) if f == folder or f not in live][-1]
                             for folder in folders})

    def _delete(self, folder: str) -> None:
        files, at = files_at(self.spark, folder)
        files.delete(at, True)

    def replace(self, df: DataFrame, paths: Iterable[str]) -> None:
        """Put the rows of ``df`` in the place of the listed partitions.

        ``df`` has all columns, the partition columns last, and may read those partitions.  The rows
        go to a fresh folder first.  Then the catalog is pointed at the new partitions, many at
        once, and listed partitions without rows are dropped; the old files go last.
        A job that is lost while writing changes nothing, one lost later leaves every partition
        either old or new, and can be repeated.
        """
        self.swap(self.stage(df), paths)

    def stage(self, df: DataFrame) -> Staged:
        """Write ``df`` by partition to a fresh folder, with a table of its own until it is swapped or discarded."""
        parts = self._partition_columns(df)
        fresh = f"{location_of(self.spark, self.name)}/{VERSIONS}/{uuid.uuid4().hex}"
        staged = Staged(f"{self.name}_{uuid.uuid4().hex}", fresh, [])
        files, root = files_at(self.spark, fresh)
        try:
            df.write.partitionBy(*parts).option("compression", "zstd").parquet(fresh)
            files.mkdirs(root)
            # the catalog finds the partitions itself, so none is listed from here
            self.spark.sql(f"CREATE TABLE {quoted(staged.table)} LIKE {quoted(self.name)} LOCATION '{fresh}'")
            self.spark.sql(f"ALTER TABLE {quoted(staged.table)} RECOVER PARTITIONS")
            listed = self.spark.sql(f"SHOW PARTITIONS {quoted(staged.table)}").collect()
            staged.written.extend(r["partition"] for r in listed)
        except Exception:
            self.discard(staged)
            raise
        return staged

    def discard(self, staged: Staged) -> None:
        """Delete what was staged and is not wanted."""
        self.spark.sql(f"DROP TABLE IF EXISTS {quoted(staged.table)}")
        self._delete(staged.folder)

    def swap(self, staged: Staged, paths: Iterable[str]) -> None:
        """Point the catalog at staged partitions and drop the listed ones that have none."""
        known, written = set(paths), set(staged.written)
        before = self._folders()
        state = self.spark._jsparkSession.sessionState()
        table = state.sqlParser().parseTableIdentifier(quoted(self.name))
        added = [p for p in staged.written if _values(p) not in before]
        for start in range(0, len(added), SPECS_PER_STATEMENT):
            specs = " ".join(f"{self._spec(p)} LOCATION '{staged.at(p).replace(chr(39), '')}'"
                             for p in added[start:start + SPECS_PER_STATEMENT])
            self.spark.sql(f"ALTER TABLE {quoted(self.name)} ADD IF NOT EXISTS {specs}")
        # the entries of the staged table say where the rows are now
        for some in self._listed(staged.table):
            state.catalog().alterPartitions(table, some)
        self.spark.sql(f"DROP TABLE {quoted(staged.table)}")
        self._forget([path for path in known if path not in written], before)
        self._clear({before[_values(p)] for p in known & written if _values(p) in before})
        self.spark.catalog.refreshTable(self.name)
