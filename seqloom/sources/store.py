"""Tables on files that change together: one marker commits the new folders of many tables.

A commit writes each table's rows to a folder of its own and then one marker that lists the folders of
every table. Readers take the newest marker, so they see all of a commit or nothing of it, also when the
writer is lost between two tables. A batch number given with a commit makes it idempotent: a batch that
is already in the newest marker is skipped, one that was cut short is written anew over its own folders.

Two kinds of tables:

* logs hold every row;
* keyed tables hold the newest row per key. A write adds a folder with the newest rows of its own (one
  small file for one row) and rewrites nothing; reading keeps the newest row per key over all folders.

``compact`` folds the added folders: of a keyed table only the hash buckets that hold changed keys are
rewritten, of a log the added files are joined into larger ones. Folders that were replaced stay until
``vacuum``, so readers that started earlier finish on what they saw. Writers may run side by side: a marker
is put in place only if its number is free, otherwise the change is applied to the newer marker.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.operators.ordering import keep_first

#: Tables of one commit that are written side by side, and tries of a marker against other writers.
WRITERS, TRIES = 8, 50
#: Bytes of a compacted log file, about.
LOG_FILE_BYTES = 256 << 20


@dataclass(frozen=True)
class Keyed:
    """Key of a table, what makes a row newer, and columns that keep their least value of all time.

    With ``order`` the row of the largest order counts whenever it arrives; among equals, and without
    ``order``, the later commit does. ``within`` settles rows of one commit that are equal so far.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    least: tuple[str, ...] = ()
    within: tuple[str, ...] = ()
    buckets: int = 64


def newest(rows: DataFrame, spec: Keyed, commit: str | None = None) -> DataFrame:
    """The newest row per key; null keys are keys. Partial results go to the shuffle, not all rows."""
    rank = [*spec.order, *([commit] if commit else []), *spec.within]
    schema = rows.schema
    tie = F.xxhash64(*[f.name for f in schema if not isinstance(f.dataType, T.MapType)])
    if not spec.least:
        return keep_first(rows, spec.keys, [*[F.desc(c) for c in rank], tie])
    place = F.struct(*rank, tie.alias("_tie"))
    others = [c for c in schema.names if c not in spec.keys]
    folded = rows.groupBy(*spec.keys).agg(
        F.max_by(F.struct(*others), place).alias("_newest"), *[F.min(c).alias(f"_least_{c}") for c in spec.least]
    )
    value = lambda c: F.col(f"_least_{c}") if c in spec.least else F.col(f"_newest.{c}")
    return folded.select(*[F.col(c) if c in spec.keys else value(c).alias(c) for c in schema.names])


@dataclass
class Store:
    """Tables below ``root``; tables that are not in ``keyed`` are logs."""

    spark: SparkSession
    root: str
    keyed: Mapping[str, Keyed] = field(default_factory=dict)

    # --- files -----------------------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        files, place = self._files(), self._path("_commits")
        if not files.exists(place):
            return []
        return sorted(int(n) for s in files.listStatus(place) if (n := s.getPath().getName()).isdigit())

    def state(self, number: int | None = None) -> dict:
        """What the newest marker says: its number, batches per writer, folders per table."""
        numbers = self._numbers()
        if not numbers:
            return {"number": 0, "batches": {}, "tables": {}}
        jvm = self.spark.sparkContext._jvm
        stream = self._files().open(self._path("_commits", f"{number or numbers[-1]:020d}"))
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _advance(self, change: Callable[[dict], bool | None]) -> bool:
        """Apply ``change`` to the newest state and put the next marker in place, whoever else writes."""
        jvm, files = self.spark.sparkContext._jvm, self._files()
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
        no_options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        for _ in range(TRIES):
            state = self.state()
            if change(state) is False:
                return False
            state["number"] += 1
            draft, final = self._path("_drafts", uuid.uuid4().hex), self._path("_commits", f"{state['number']:020d}")
            out = files.create(draft, False)
            out.write(json.dumps(state).encode())
            out.close()
            files.mkdirs(self._path("_commits"))
            try:
                context.rename(files.makeQualified(draft), files.makeQualified(final), no_options)
            except Exception:  # noqa: BLE001 - the number was taken meanwhile
                files.delete(draft, False)
                if state["number"] in self._numbers():
                    continue
                raise
            return True
        raise RuntimeError("too many writers at a time")

    # --- writing ---------------------------------------------------------------------------------

    def commit(self, tables: Mapping[str, DataFrame], writer: str | None = None, batch: int | None = None) -> bool:
        """Write rows to each table and commit them together; false if the writer's batch is in already.

        Batches of a writer must come in rising order, as micro-batches do.
        """
        if self.is_committed(writer, batch):
            return False
        folder = uuid.uuid4().hex if batch is None else f"{writer}-{batch}"
        ready = {name: newest(df, self.keyed[name]) if name in self.keyed else df for name, df in tables.items()}
        with ThreadPoolExecutor(WRITERS) as pool:
            writes = [pool.submit(df.write.mode("overwrite").parquet, f"{self.root}/{name}/{folder}") for name, df in ready.items()]
            for write in writes:
                write.result()

        def add(state: dict) -> bool | None:
            if batch is not None:
                if batch <= state["batches"].get(writer, -1):
                    return False
                state["batches"][writer] = batch
            for name, df in ready.items():
                table = state["tables"].setdefault(name, {"schema": None, "base": {}, "added": []})
                table["schema"] = _joined(table["schema"], df.schema)
                table["added"].append(folder)
            return None

        return self._advance(add)

    def is_committed(self, writer: str | None, batch: int | None) -> bool:
        return batch is not None and batch <= self.state()["batches"].get(writer, -1)

    # --- reading ---------------------------------------------------------------------------------

    def names(self) -> list[str]:
        return sorted(self.state()["tables"])

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """The table as of the newest marker, or of marker ``number`` while that is kept."""
        table = self.state(number)["tables"][name]
        return self._merged(name, table, list(table["base"].values()))

    def lookup(self, name: str, **key: object) -> DataFrame:
        """The row of a whole key: reads one bucket and what was added since, and prunes inside by the key."""
        spec, table = self.keyed[name], self.state()["tables"][name]
        schema = T.StructType.fromJson(table["schema"])
        asked = self.spark.range(1).select(*[F.lit(key[k]).cast(schema[k].dataType).alias(k) for k in spec.keys])
        bucket = str(asked.select(_bucket(spec)).first()[0])
        rows = self._rows(name, table, [table["base"][bucket]] if bucket in table["base"] else [])
        for k in spec.keys:
            rows = rows.filter(F.col(k).eqNullSafe(F.lit(key[k]).cast(schema[k].dataType)))
        return newest(rows, spec, "_commit").drop("_commit")

    def added_in(self, name: str, writer: str, batch: int) -> DataFrame | None:
        """The rows a batch added to a table, while they have not been compacted."""
        table = self.state()["tables"].get(name)
        folder = f"{writer}-{batch}"
        if table is None or folder not in table["added"]:
            return None
        return self._rows(name, {**table, "added": [folder]}, []).drop("_commit")

    def _rows(self, name: str, table: dict, base: list[str]) -> DataFrame:
        """All stored rows with ``_commit``: the place of their folder among those added, -1 for the base."""
        schema = T.StructType.fromJson(table["schema"])
        paths = [f"{self.root}/{name}/{p}" for p in [*base, *table["added"]]]
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("_commit", F.lit(-1))
        rows = self.spark.read.schema(schema).parquet(*paths)
        if not table["added"]:
            return rows.withColumn("_commit", F.lit(-1))
        places = F.create_map(*[F.lit(x) for at, folder in enumerate(table["added"]) for x in (folder, at)])
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        return rows.select(*schema.names, F.coalesce(F.try_element_at(places, folder), F.lit(-1)).alias("_commit"))

    def _merged(self, name: str, table: dict, base: list[str]) -> DataFrame:
        rows = self._rows(name, table, base)
        if name not in self.keyed:
            return rows.drop("_commit")
        return newest(rows, self.keyed[name], "_commit").drop("_commit")

    # --- upkeep ----------------------------------------------------------------------------------

    def compact(self, *names: str) -> None:
        """Fold what was added to the tables (all, if none is named) into their base."""
        for name in names or self.names():
            self._compact(name)

    def _compact(self, name: str) -> None:
        table = self.state()["tables"][name]
        taken, folder = list(table["added"]), f"base-{uuid.uuid4().hex}"
        if not taken:
            return
        to = f"{self.root}/{name}/{folder}"
        if name in self.keyed:
            spec = self.keyed[name]
            # as many numbers as there are buckets at most
            touched = [str(r[0]) for r in self._rows(name, table, []).select(_bucket(spec)).distinct().collect()]
            kept = [table["base"][b] for b in touched if b in table["base"]]
            merged = self._merged(name, table, kept).withColumn("_bucket", _bucket(spec))
            merged.repartition("_bucket").write.partitionBy("_bucket").parquet(to)
            made = {b: f"{folder}/_bucket={b}" for b in touched}
        else:
            rows = self._rows(name, table, []).drop("_commit")
            size = sum(self._files().getContentSummary(self._path(name, f)).getLength() for f in taken)
            rows.repartition(max(1, -(-size // LOG_FILE_BYTES))).write.parquet(to)
            made = {folder: folder}

        def replace(state: dict) -> bool | None:
            now = state["tables"][name]
            if now["added"][: len(taken)] != taken:
                return False  # someone else folded them
            now["added"] = now["added"][len(taken) :]
            now["base"].update(made)
            return None

        self._advance(replace)

    def vacuum(self, keep: int = 10, older_than_s: int = 3600) -> int:
        """Remove markers before the last ``keep`` and folders that no kept marker names and nothing has
        written to for ``older_than_s`` seconds. Returns how many folders went."""
        files, numbers = self._files(), self._numbers()
        for number in numbers[:-keep]:
            files.delete(self._path("_commits", f"{number:020d}"), False)
        live: set[tuple[str, str]] = set()
        for number in numbers[-keep:]:
            for name, table in self.state(number)["tables"].items():
                live |= {(name, p.split("/")[0]) for p in [*table["base"].values(), *table["added"]]}
        now, gone = self.spark.sparkContext._jvm.System.currentTimeMillis(), 0
        for name in self.names():
            for status in files.listStatus(self._path(name)):
                folder = status.getPath().getName()
                if (name, folder) not in live and now - status.getModificationTime() >= older_than_s * 1000:
                    files.delete(status.getPath(), True)
                    gone += 1
        return gone


def _bucket(spec: Keyed) -> Column:
    return F.pmod(F.hash(*spec.keys), F.lit(spec.buckets)).alias("_bucket")


def _joined(before: dict | None, now: T.StructType) -> dict:
    """The schema of a table after a commit: new columns join at the end, known ones keep their type."""
    if before is None:
        return now.jsonValue()
    known = T.StructType.fromJson(before)
    for f in now.fields:
        if f.name in known.names and known[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} was {known[f.name].dataType.simpleString()}, now {f.dataType.simpleString()}")
    return T.StructType([*known.fields, *[f for f in now.fields if f.name not in known.names]]).jsonValue()
