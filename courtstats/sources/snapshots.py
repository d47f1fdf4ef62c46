"""Tables that change in whole versions: readers see one version or the next, never a half-done load.

The tables of a root share their versions. Rows lie in ``data/<table>/commit=<id>/bucket=<n>`` by a hash of the table's key and are
never changed; ``versions/<number>.json`` lists per table and bucket the commits whose rows are live. A writer stages new folders and
then creates the next version's file, which must not exist: that one step makes all its tables' changes
visible. If another writer was first, the change is put on top of that version, unless both touched the
same bucket: then :class:`Conflict` is raised and the writer has to look again. A reader keeps the version it
planned with, and older versions can be read until :func:`SnapshotTables.expire` drops them.

Every staged bucket has a row in the commit's key index: its rows and a bitmap of hashed keys. A load looks up which
folders may hold its keys and compares with these alone, so its cost follows the batch and not the table. A bucket that has
gathered ``max_folders`` folders is written as one by the next commit that touches it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, VariantType

from courtstats import files
from courtstats.operators.dealing import parts_for

#: Bits of a key bitmap, as Spark's bitmap functions define it.
BITS = 32_768
#: Folders a bucket gathers before it is written as one.
MAX_FOLDERS = 8
#: How often a change is put on top of versions of other writers.
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Another writer has changed a bucket since this writer read it."""


@dataclass(frozen=True)
class Table:
    """What a version says of a table."""

    schema: str
    keys: tuple[str, ...]
    buckets: int
    folders: Mapping[int, tuple[str, ...]]
    #: Buckets each live commit was written with.
    sizes: Mapping[str, int]


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: Mapping[str, Table] = field(default_factory=dict)
    #: Last batch of every run whose rows are in.
    applied: Mapping[str, int] = field(default_factory=dict)

    def text(self) -> str:
        tables = {
            name: {
                "schema": t.schema,
                "keys": list(t.keys),
                "buckets": t.buckets,
                "folders": {str(b): list(c) for b, c in t.folders.items()},
                "sizes": dict(t.sizes),
            }
            for name, t in self.tables.items()
        }
        return json.dumps({"number": self.number, "tables": tables, "applied": dict(self.applied)})

    @staticmethod
    def parse(text: str) -> Version:
        raw = json.loads(text)
        tables = {
            name: Table(
                t["schema"],
                tuple(t["keys"]),
                t["buckets"],
                {int(b): tuple(c) for b, c in t["folders"].items()},
                t["sizes"],
            )
            for name, t in raw["tables"].items()
        }
        return Version(raw["number"], tables, raw["applied"])


@dataclass(frozen=True)
class Change:
    """Staged folders of one table: added to their buckets, or in place of what the buckets hold ("": nothing)."""

    name: str
    table: Table
    added: Mapping[int, str]
    replaced: Mapping[int, str]
    sizes: Mapping[str, int]


def same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Null-safe equality of columns."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(_hash(keys), F.lit(buckets)).cast("int")


def _bit_of(keys: Sequence[str]) -> Column:
    """Place of a key in its bucket's bitmap, from other bits of the hash than the bucket."""
    return F.pmod(F.shiftrightunsigned(_hash(keys), 24), F.lit(BITS))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1


class SnapshotTables:
    """Tables below a root folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, max_folders: int = MAX_FOLDERS):
        """``buckets`` holds for tables that don't exist yet: choose it so that a bucket fits a few tasks."""
        self.spark, self.root, self.buckets, self.max_folders = spark, root.rstrip("/"), buckets, max_folders

    # --- Versions -----------------------------------------------------------------------

    def numbers(self) -> list[int]:
        found = files.names(self.spark, f"{self.root}/versions")
        return sorted(int(name[:-5]) for name in found if name.endswith(".json") and name[:-5].isdigit())

    def latest(self) -> Version:
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else Version()

    def version(self, number: int) -> Version:
        if number == 0:
            return Version()
        return Version.parse(files.read_text(self.spark, self._file(number)))

    def _file(self, number: int) -> str:
        return f"{self.root}/versions/{number:010d}.json"

    # --- Reading ------------------------------------------------------------------------

    def read(self, name: str, version: Version | int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of a table as of a version (default: the latest), of all buckets or some."""
        if not isinstance(version, Version):
            version = self.latest() if version is None else self.version(version)
        table = version.tables[name]
        if buckets is None:
            return self._rows(name, table, [(c, b) for b, commits in table.folders.items() for c in commits])
        chosen = set(buckets)
        return self._rows(name, table, [(c, b) for b, commits in table.folders.items() if b in chosen for c in commits])

    def _rows(self, name: str, table: Table, folders: Sequence[tuple[str, int]]) -> DataFrame:
        schema = StructType.fromJson(json.loads(table.schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/data/{name}"
        by_commit: dict[str, list[int]] = {}
        for commit, bucket in folders:
            by_commit.setdefault(commit, []).append(bucket)
        paths = []
        for commit, buckets in by_commit.items():
            place = f"{base}/commit={commit}"
            whole = len(buckets) == table.sizes[commit]
            paths += [place] if whole else [f"{place}/bucket={b}" for b in buckets]
        stored = StructType([*schema.fields]).add("commit", "string").add("bucket", "integer")
        return self.spark.read.schema(stored).option("basePath", base).parquet(*paths).drop("commit", "bucket")

    def _index(self, name: str, table: Table) -> DataFrame:
        live = set(table.sizes)
        paths = [f"{self.root}/index/{name}/commit={c}" for c in sorted(live)]
        schema = "bucket int, rows long, bits binary, commit string"
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/index/{name}").parquet(*paths)

    def folders_for(self, version: Version, name: str, wanted: DataFrame) -> list[tuple[str, int]]:
        """(commit, bucket) of the live folders that may hold one of the wanted keys: bounded by the live folders."""
        table = version.tables[name]
        if not table.sizes:
            return []
        keys = list(table.keys)
        probes = wanted.select(bucket_of(keys, table.buckets).alias("bucket"), _bit_of(keys).alias("bit")).distinct()
        hits = self._index(name, table).join(probes, "bucket").where(_is_set(F.col("bits"), F.col("bit")))
        live = {(c, b) for b, commits in table.folders.items() for c in commits}
        found = {(r["commit"], r["bucket"]) for r in hits.select("commit", "bucket").distinct().collect()}
        return sorted(found & live)

    def candidates(self, version: Version, name: str, wanted: DataFrame) -> DataFrame:
        """Rows of the folders that may hold a wanted key."""
        return self._rows(name, version.tables[name], self.folders_for(version, name, wanted))

    def unseen(self, version: Version, name: str, rows: DataFrame, row_keys: Sequence[str]) -> DataFrame:
        """Rows whose row key no row of the table has. Null keys are keys like any other.

        The stored rows are shuffled: their files are small for what they hold, and by the files' size Spark would send
        them through the driver to every task, batch after batch.
        """
        if name not in version.tables:
            return rows
        stored = self.candidates(version, name, rows).select(*row_keys).hint("merge")
        return rows.join(stored, same(rows, stored, row_keys), "left_anti")

    # --- Writing ------------------------------------------------------------------------

    def stage(
        self, version: Version, name: str, rows: DataFrame, keys: Sequence[str], size: int | None = None
    ) -> Change:
        """Write rows beside a table, to be added to it; full buckets are written anew with them.

        ``size``: about how many rows there are, if that is known; it decides how many tasks write them.
        """
        table = self._table(version, name, rows, keys)
        commit, touched = self._write(name, rows, table, size)
        full = [b for b in touched if len(table.folders.get(b, ())) >= self.max_folders]
        sizes = {commit: len(touched)}
        replaced: dict[int, str] = {}
        if full:
            old = [(c, b) for b in full for c in table.folders[b]] + [(commit, b) for b in full]
            known = Table(table.schema, table.keys, table.buckets, table.folders, {**table.sizes, **sizes})
            folded, held = self._write(name, self._rows(name, known, old), table)
            sizes[folded] = len(held)
            replaced = dict.fromkeys(held, folded)
        return Change(name, table, {b: commit for b in touched if b not in replaced}, replaced, sizes)

    def stage_replacement(
        self, version: Version, name: str, rows: DataFrame, keys: Sequence[str], gone: DataFrame | None = None
    ) -> Change:
        """Write the buckets that rows touch: rows with other keys as they are, those with the same keys replaced.

        ``gone`` holds further keys whose rows go, whether ``rows`` has some for them or not.
        """
        table = self._table(version, name, rows, keys)
        sent = rows.select(*keys)
        sent = (sent if gone is None else sent.union(gone.select(*keys))).distinct()
        places = sent.select(bucket_of(keys, table.buckets).alias("bucket")).distinct()
        touched = sorted(r[0] for r in places.collect())
        stored = self._rows(name, table, [(c, b) for b in touched for c in table.folders.get(b, ())])
        kept = stored.join(sent, same(stored, sent, keys), "left_anti")
        commit, held = self._write(name, kept.unionByName(rows.select(*stored.columns)), table)
        emptied = {b: "" for b in touched if b not in held and table.folders.get(b)}
        return Change(name, table, {}, {**dict.fromkeys(held, commit), **emptied}, {commit: len(held)})

    def _table(self, version: Version, name: str, rows: DataFrame, keys: Sequence[str]) -> Table:
        # Nullability isn't part of what a table promises: files hold nullable columns.
        plain = StructType.fromJson(json.loads(json.dumps(_nullable(rows.schema.jsonValue()))))
        table = version.tables.get(name) or Table(plain.json(), tuple(keys), self.buckets, {}, {})
        if table.keys != tuple(keys):
            raise ValueError(f"{name} is keyed by {list(table.keys)}, not {list(keys)}")
        if StructType.fromJson(json.loads(table.schema)).simpleString() != plain.simpleString():
            raise ValueError(f"{name} has other columns: {table.schema}")
        return table

    def _write(self, name: str, rows: DataFrame, table: Table, size: int | None = None) -> tuple[str, list[int]]:
        """Stage rows in buckets, with their key index; returns the commit and the buckets it holds."""
        commit, keys = uuid.uuid4().hex, list(table.keys)
        data = f"{self.root}/data/{name}/commit={commit}"
        placed = rows.withColumn("bucket", bucket_of(keys, table.buckets))
        if size is None or parts_for(size) <= table.buckets:
            # A bucket in few files; one that holds most rows is split by AQE.
            placed = placed.hint("rebalance", "bucket")
        else:
            # A bucket in as many files as its share of the rows needs, whichever keys they have.
            files_each = -(-parts_for(size) // table.buckets)
            plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
            file = F.pmod(F.xxhash64(*plain, F.lit("file")), F.lit(files_each)).cast("int")
            placed = placed.repartitionById(table.buckets * files_each, F.col("bucket") * files_each + file)
        placed.write.partitionBy("bucket").parquet(data)
        if not any(entry.startswith("bucket=") for entry in files.names(self.spark, data)):
            return commit, []
        stored = self.spark.read.schema(StructType([*rows.schema.fields]).add("bucket", "integer")).parquet(data)
        # Counted per bit first, of which a bucket has few: no task sorts the rows themselves.
        bits = stored.groupBy("bucket", _bit_of(keys).alias("bit")).agg(F.count(F.lit(1)).alias("rows"))
        index = bits.groupBy("bucket").agg(F.sum("rows").alias("rows"), F.bitmap_construct_agg("bit").alias("bits"))
        place = f"{self.root}/index/{name}/commit={commit}"
        index.coalesce(1).write.parquet(place)
        return commit, sorted(r[0] for r in self.spark.read.parquet(place).select("bucket").collect())

    def commit(
        self, base: Version, changes: Sequence[Change], run_id: str | None = None, batch_id: int | None = None
    ) -> Version:
        """Make staged changes visible in one step, or raise :class:`Conflict`.

        ``base`` is the version the changes were made from. A batch of a run that is in already changes nothing.
        """
        now = base
        for _ in range(ATTEMPTS):
            if run_id is not None and now.applied.get(run_id, -1) >= batch_id:
                return now
            self._check(base, now, changes)
            new = self._apply(now, changes, run_id, batch_id)
            if files.create_text(self.spark, self._file(new.number), new.text()):
                return new
            now = self.latest()
        raise Conflict(f"{ATTEMPTS} other versions came first")

    @staticmethod
    def _check(base: Version, now: Version, changes: Sequence[Change]) -> None:
        for change in changes:
            old, new = base.tables.get(change.name), now.tables.get(change.name)
            if new is None or new is old:
                continue
            if (new.schema, new.keys, new.buckets) != (change.table.schema, change.table.keys, change.table.buckets):
                raise Conflict(f"{change.name} has been created otherwise")
            before = old.folders if old else {}
            for bucket in {*change.added, *change.replaced}:
                if before.get(bucket, ()) != new.folders.get(bucket, ()):
                    raise Conflict(f"bucket {bucket} of {change.name} has changed since version {base.number}")

    @staticmethod
    def _apply(now: Version, changes: Sequence[Change], run_id: str | None, batch_id: int | None) -> Version:
        tables = dict(now.tables)
        for change in changes:
            table = tables.get(change.name, change.table)
            folders = dict(table.folders)
            for bucket, commit in change.added.items():
                folders[bucket] = (*folders.get(bucket, ()), commit)
            for bucket, commit in change.replaced.items():
                folders[bucket] = (commit,) if commit else ()
            live = {c for commits in folders.values() for c in commits}
            sizes = {c: n for c, n in {**table.sizes, **change.sizes}.items() if c in live}
            tables[change.name] = Table(table.schema, table.keys, table.buckets, folders, sizes)
        applied = dict(now.applied) if run_id is None else {**now.applied, run_id: batch_id}
        return Version(now.number + 1, tables, applied)

    def replace(
        self, name: str, rows: DataFrame, keys: Sequence[str], run_id: str | None = None, batch_id: int | None = None
    ) -> Version:
        """Rows with the keys of ``rows`` are replaced by them, all others stay; on a conflict it looks again."""
        for attempt in range(ATTEMPTS):
            base = self.latest()
            if run_id is not None and base.applied.get(run_id, -1) >= batch_id:
                return base
            try:
                return self.commit(base, [self.stage_replacement(base, name, rows, keys)], run_id, batch_id)
            except Conflict:
                if attempt == ATTEMPTS - 1:
                    raise
        raise AssertionError

    def expire(self, keep: int = 10) -> int:
        """Drop all versions but the last ``keep`` and the folders only they need; returns how many versions went.

        Call it when no reader of an older version is left. Folders of writers that have not committed stay.
        """
        numbers = self.numbers()
        gone, kept = numbers[:-keep] if keep else numbers, numbers[-keep:] if keep else []
        needed = {(n, c) for v in map(self.version, kept) for n, t in v.tables.items() for c in t.sizes}
        dropped = {(n, c) for v in map(self.version, gone) for n, t in v.tables.items() for c in t.sizes}
        for number in gone:
            files.remove(self.spark, self._file(number))
        for name, commit in sorted(dropped - needed):
            files.remove(self.spark, f"{self.root}/data/{name}/commit={commit}")
            files.remove(self.spark, f"{self.root}/index/{name}/commit={commit}")
        return len(gone)


def _nullable(schema):
    """A schema's JSON with every column, element and value nullable."""
    if isinstance(schema, dict):
        flags = {"nullable", "containsNull", "valueContainsNull"}
        return {k: True if k in flags else _nullable(v) for k, v in schema.items()}
    return [_nullable(x) for x in schema] if isinstance(schema, list) else schema
