"""Versioned storage of the lake: write, audit, then publish.

Every write goes to a folder of its own, also when a run id recurs, so readers keep
seeing the last published version until ``publish`` adds a publication: one small
file that names the folders of all tables of the layer. It appears as a whole or
not at all, and a reader takes the latest, in any session or process; tables of
two publications never mix. No data file is moved or overwritten, which holds on
object stores too. A table's version is a list of parts, one unless later runs added
their rows to it; an added part leaves the folders of the others alone. Views of the catalog show the same to SQL users of the session.
"""

import tempfile
import time
import uuid
from collections.abc import Collection, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from functools import reduce

from py4j.protocol import Py4JError
from pyarrow import fs
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold", "served")
#: What is served are the tables of another layer.
SHOWN = {"served": "gold"}

_PUBLICATION = (
    "version bigint, publication string, layer string, table string, path string, rows bigint,"
    " columns array<string>, where string, part int, types map<string, string>"
)


class NotPublished(LookupError):
    """The table has no published version."""


@dataclass(frozen=True)
class Staged:
    """A written, not yet published table, or rows to add to one. ``columns`` and
    ``where`` narrow what its view shows of the written rows; ``types`` are those of
    all that was written, which the values of partition folders don't tell."""

    layer: str
    table: str
    path: str
    rows: int
    columns: tuple[str, ...]
    where: str | None = None
    tallies: Mapping[str, int] = field(default_factory=dict, compare=False)
    types: Mapping[str, str] = field(default_factory=dict, compare=False)


@dataclass(frozen=True)
class Version:
    """What is published of a table: its parts, in the order they were added."""

    parts: tuple[Staged, ...]

    @property
    def rows(self) -> int:
        return sum(part.rows for part in self.parts)

    def added(self, part: Staged) -> "Version":
        """With a further part, unless it adds no rows."""
        return Version((*self.parts, part)) if part.rows or not self.parts else self


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    name: str = "retail"
    fmt: str = "parquet"

    def stage(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        run_id: str,
        partition_by: Sequence[str] = (),
        tallies: Mapping[str, Column] | None = None,
        gathered: bool = False,
    ) -> Staged:
        """Write ``df`` to a fresh folder, counting its rows on the way, and on request
        the rows that meet each condition of ``tallies``. For ``gathered`` see ``write_table``."""
        path = f"{self.root}/{layer}/{table}/{run_id}-{new_run_id()[:12]}"
        observed = Observation()
        counts = [F.count_if(condition).alias(f"tally_{name}") for name, condition in (tallies or {}).items()]
        counts.append(F.count(F.lit(1)).alias("rows"))
        write_table(df.observe(observed, *counts), path, self.fmt, partition_by, gathered)
        try:
            counted = observed.get
        except Py4JError:
            # Adaptive execution drops the observation of a plan it finds to be empty on the way.
            written = self.spark.read.schema(df.schema).format(self.fmt).load(path)
            counted = written.agg(*counts).first().asDict()
        found = {name: counted[f"tally_{name}"] for name in tallies or {}}
        return Staged(layer, table, path, counted["rows"], tuple(df.columns), tallies=found, types=dict(df.dtypes))

    def stage_all(
        self,
        layer: str,
        tables: Mapping[str, DataFrame],
        run_id: str,
        partition_by: Mapping[str, Sequence[str]] | None = None,
        tallies: Mapping[str, Mapping[str, Column]] | None = None,
        gathered: Collection[str] = (),
    ) -> list[Staged]:
        """Write independent tables side by side, so that the last tasks of a large
        one leave no executors idle while small ones wait."""
        stage = inheritable_thread_target(self.spark)(self.stage)
        layout = partition_by or {}
        with ThreadPoolExecutor(max_workers=len(tables)) as pool:
            writes = [
                pool.submit(stage, layer, name, df, run_id, layout.get(name, ()), (tallies or {}).get(name), name in gathered)
                for name, df in tables.items()
            ]
            return [write.result() for write in writes]

    def load(self, version: Staged | Version) -> DataFrame:
        """Its rows. Columns that only some parts have are NULL in the others."""
        if isinstance(version, Version):
            parts = [self.load(part) for part in version.parts]
            return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
        df = self.spark.read.format(self.fmt).load(version.path)
        if version.where:
            df = df.where(version.where)
        found = dict(df.dtypes)
        typed = [c for c in version.columns if version.types.get(c, found[c]) != found[c]]
        return df.select(*version.columns).withColumns({c: F.col(c).cast(version.types[c]) for c in typed})

    def _log(self, layer: str) -> DataFrame | None:
        """A row per part of a table and publication; None if nothing was published yet."""
        try:
            return self.spark.read.schema(_PUBLICATION).json(f"{self.root}/_published/{layer}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _latest(self, layer: str) -> list[Row]:
        """The rows of the last publication, picked by an aggregate: what reaches the driver
        is a row per part of a table, however often was published."""
        if (log := self._log(layer)) is None:
            return []
        tables = F.collect_list(F.struct(*log.columns)).alias("tables")
        last = log.groupBy("version", "publication").agg(tables).agg(F.max_by("tables", F.struct("version", "publication")).alias("tables"))
        return last.first()["tables"] or []

    def published(self, layer: str) -> dict[str, Version]:
        """The current version of each published table by name."""
        return _versions(self._latest(SHOWN.get(layer, layer)))

    def publish(self, tables: Iterable[Staged], add_to: Collection[str] = ()) -> None:
        """Make the tables' versions the current ones, all of a layer at once; its other
        tables keep theirs, and those of ``add_to`` keep their parts before the new one."""
        layers: dict[str, dict[str, Staged]] = {}
        for staged in tables:
            layers.setdefault(staged.layer, {})[staged.table] = staged
        for layer, new in layers.items():
            nothing = self.spark.createDataFrame([], _PUBLICATION)
            nothing.write.mode("ignore").json(f"{self.root}/_published/{layer}")  # at first
            before = self._latest(layer)
            mark = {"version": max((r["version"] for r in before), default=0) + 1, "publication": new_run_id()}
            current = _versions(before)
            for name, staged in new.items():
                kept = current.get(name, Version(())) if name in add_to else Version(())
                current[name] = kept.added(staged)
            rows = [
                mark | {"part": n} | {k: v for k, v in asdict(part).items() if k != "tallies"}
                for version in current.values()
                for n, part in enumerate(version.parts)
            ]
            publication = self.spark.createDataFrame(rows, _PUBLICATION).coalesce(1)
            publication.write.mode("append").json(f"{self.root}/_published/{layer}")
            self.register(layer)

    def register(self, layer: str) -> None:
        """Views of the layer's published tables in this session's catalog."""
        self.create_database(layer)
        for name, version in self.published(layer).items():
            shown = list(dict.fromkeys(c for part in version.parts for c in part.columns))
            selects = " UNION ALL ".join(self._select(part, shown) for part in version.parts)
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.qualified(layer, name)} AS {selects}")

    def _select(self, part: Staged, shown: Sequence[str]) -> str:
        """The SQL of one part of a view of the columns ``shown``."""
        own = {c: f"CAST(`{c}` AS {part.types[c]})" if c in part.types else f"`{c}`" for c in part.columns}
        columns = ", ".join(f"{own.get(c, 'NULL')} AS `{c}`" for c in shown)
        condition = f" WHERE {part.where}" if part.where else ""
        return f"SELECT {columns} FROM {self.fmt}.`{part.path}`{condition}"

    def expire(self, keep: int = 3, older_than: float = 86_400.0) -> list[str]:
        """Delete written folders that none of a layer's last ``keep`` publications names
        and that are older than ``older_than`` seconds, so that a run under way keeps
        its own, and the publications before the last ``keep``. Returns the folders."""
        if keep < 1:
            raise ValueError("the published version must stay")
        store, root = fs.FileSystem.from_uri(self.root)
        gone = []
        for layer in LAYERS:
            named = self._trimmed(layer, keep, store)
            for table in _folders(store, f"{root}/{layer}"):
                for version in _folders(store, table.path):
                    aged = time.time() - version.mtime.timestamp() >= older_than if version.mtime else False
                    if aged and version.base_name not in named:
                        store.delete_dir(version.path)
                        gone.append(version.path)
        return gone

    def _trimmed(self, layer: str, keep: int, store: fs.FileSystem) -> set[str]:
        """Folders named by the last ``keep`` publications; the files of others go."""
        if (log := self._log(layer)) is None:
            return set()
        log = log.select("*", F.col("_metadata.file_path").alias("file"))
        last = log.select("version", "publication").distinct().orderBy(F.desc("version"), F.desc("publication")).limit(keep)
        kept = log.join(F.broadcast(last), ["version", "publication"])  # ``keep`` rows
        named = {r["path"].rsplit("/", 1)[-1] for r in kept.select("path").distinct().collect()}
        gone = log.select("file").distinct().join(kept.select("file").distinct(), "file", "left_anti")
        for r in gone.toLocalIterator():
            store.delete_file(fs.FileSystem.from_uri(r["file"])[1])
        return named

    def create_database(self, layer: str) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}"
            f" LOCATION '{self.root}/_catalog/{layer}'"
        )

    def table(self, layer: str, table: str) -> DataFrame:
        """The published version; an unpublished table is an error, not a stale read."""
        return self.tables(layer, [table])[table]

    def tables(self, layer: str, names: Iterable[str]) -> dict[str, DataFrame]:
        """Several tables of one publication."""
        current = self.published(layer)
        if missing := [name for name in names if name not in current]:
            raise NotPublished(f"not published in {layer}: {', '.join(missing)}")
        return {name: self.load(current[name]) for name in names}

    def unregister(self) -> None:
        """Take the lake's databases out of the catalog; written data stays."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")

    def database(self, layer: str) -> str:
        return f"{self.name}_{layer}"

    def qualified(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"


def _versions(rows: Iterable[Row]) -> dict[str, Version]:
    """Versions by table from a row per part."""
    parts: dict[str, list[Staged]] = {}
    for r in sorted(rows, key=lambda r: r["part"] or 0):
        part = Staged(r["layer"], r["table"], r["path"], r["rows"], tuple(r["columns"]), r["where"], types=r["types"] or {})
        parts.setdefault(r["table"], []).append(part)
    return {name: Version(tuple(found)) for name, found in parts.items()}


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), gathered: bool = False
) -> None:
    """Write to ``path``, which must not exist yet. Rows of one partition value are brought together first,
    unless they are ``gathered`` already, in files of the advisory size: a hot value is
    split over several tasks, and small ones share a task instead of leaving a file per task behind."""
    if partition_by and not gathered:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).option("compression", "zstd")
    writer.mode("errorifexists").partitionBy(*partition_by).save(path)


def _folders(store: fs.FileSystem, path: str) -> list[fs.FileInfo]:
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return [x for x in found if x.type == fs.FileType.Directory]


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Overwrite only the partitions that occur in ``df``; all others stay."""
    (
        df.hint("rebalance", *partition_by)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def new_run_id() -> str:
    return uuid.uuid4().hex


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one the cluster names; only a local session
    that names none gets a temporary folder of this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="retail_lake_")
    return f"{shared.rstrip('/')}/{label}-{new_run_id()}"
