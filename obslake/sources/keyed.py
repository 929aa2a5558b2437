"""Keyed tables with atomic commits.

A keyed store takes an appended row as the new version of its key. Here a table is a folder of
immutable Parquet folders and of manifests:

    data/commit_seq=<n>/commit_id=<id>/<partition>=<value>/part-*.parquet
    _manifests/<n>.json

A write puts its rows, one per key, under a new folder and then publishes manifest n, which lists the
folders that make up the table, by one rename that fails if n is there already. A writer that lost
that race takes the next number. A reader takes the newest manifest and sees that version to the end of
its query; a writer lost before the rename leaves the table as it was. Nothing that a manifest names
is ever changed; `vacuum` deletes what the kept manifests no longer name.

Within a partition the row of the greatest seq is the key's (or of the greatest `newest_by` columns, or
columns are merged by min and max). So a write holds the delivered rows alone, however large the
partition. Folders of a partition are merged as they gather, small ones with small ones, and a
partition of one folder is read without a shuffle. The rename must be atomic, as on HDFS and local
file systems; object stores need a connector that provides it.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.schemas import DAY_S

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a null partition value
MOST_FOLDERS = 8


class Entry(NamedTuple):
    """A folder of rows: of which partition (folder name, '' without partitioning), under which seq
    and id, how many bytes."""
    part: str
    seq: int
    c: str
    size: int


class Manifest(NamedTuple):
    version: int
    schema: str                      # as JSON
    keys: list[str]
    partition_by: str | None
    newest_by: list[str]
    merge: dict[str, str]            # column -> min or max; empty: the newest row
    entries: list[Entry]
    applied: dict[str, list[int]]    # writer -> its last batch and the seq that it got
    facts: dict                      # what jobs keep beside the rows, committed with them
    registered: list[str]            # catalog tables that follow this one


# --- files ------------------------------------------------------------------------------------

def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _fs(spark: SparkSession, path: str):
    p = _hadoop(spark).Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in path; none if it does not exist."""
    p, fs = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def _read(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    f = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8")
    finally:
        f.close()


def _move(spark: SparkSession, a: str, b: str) -> bool:
    """Rename a to b; false if there is a b already."""
    p, fs = _fs(spark, a)
    q = _hadoop(spark).Path(b)
    fs.mkdirs(q.getParent())
    fc = _hadoop(spark).FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(),
                                                   spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        fc.rename(p, q, options)
        return True
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise


def partition_value(name: str) -> str | None:
    """The value, as text, that a partition's folder name stands for."""
    v = unquote(name.split("=", 1)[1])
    return None if v == NULL_PARTITION else v


class KeyedTable:
    """The table at `path`. keys, partition_by, newest_by and merge are needed by its first write
    alone; later ones, and readers, take them from the manifest. A key determines its partition."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, partition_by: str | None = None,
                 newest_by: tuple[str, ...] = (), merge: dict[str, str] | None = None, most_folders: int = MOST_FOLDERS):
        self.spark, self.path, self.most_folders = spark, path.rstrip("/"), most_folders
        self._first = Manifest(0, T.StructType([]).json(), list(keys or []), partition_by, list(newest_by), dict(merge or {}),
                               [], {}, {}, [])

    # manifests

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in list_names(self.spark, f"{self.path}/_manifests") if n.endswith(".json") and n[0] not in "._"]

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of a version; one without rows before the first write."""
        if version is None:
            known = self.versions()
            if not known:
                return self._first
            version = known[-1]
        m = json.loads(_read(self.spark, f"{self.path}/_manifests/{version:012d}.json"))
        return Manifest(**m | {"entries": [Entry(*e) for e in m["entries"]]})

    def exists(self) -> bool:
        return bool(self.versions())

    def _publish(self, m: Manifest) -> bool:
        tmp = f"{self.path}/_manifests/.{uuid.uuid4().hex}"
        p, fs = _fs(self.spark, tmp)
        f = fs.create(p, False)
        try:
            f.write(bytearray(json.dumps(m._asdict()).encode()))
        finally:
            f.close()
        if _move(self.spark, tmp, f"{self.path}/_manifests/{m.version:012d}.json"):
            return True
        fs.delete(p, False)
        return False

    # reading

    def _folder(self, e: Entry) -> str:
        return f"{self.path}/data/commit_seq={e.seq}/commit_id={e.c}" + (f"/{e.part}" if e.part else "")

    def _rows(self, m: Manifest, entries: list[Entry]) -> DataFrame:
        """All stored versions in these folders, with their seq."""
        fields = T.StructType.fromJson(json.loads(m.schema)).fields
        if not entries:
            return self.spark.createDataFrame([], T.StructType([*fields, T.StructField("_seq", T.LongType())]))
        # named as no column is, the folders' own columns are told from the table's
        read = self.spark.read.schema(T.StructType(fields)).option("basePath", f"{self.path}/data")
        df = read.option("pathGlobFilter", "part-*").parquet(*map(self._folder, entries))
        return df.select(*(f.name for f in fields), F.col("commit_seq").cast("long").alias("_seq"))

    def _merged(self, m: Manifest, rows: DataFrame) -> DataFrame:
        """One row per key of rows with their seq. One aggregate: versions are combined before the
        shuffle, so a key of many versions never reaches a task as raw rows."""
        by = [*([m.partition_by] if m.partition_by and m.partition_by not in m.keys else []), *m.keys]
        rest = [c for c in rows.columns if c not in by and c != "_seq"]
        order = F.struct(*m.newest_by, "_seq")
        if m.merge:
            aggs = [getattr(F, m.merge[c])(c).alias(c) if c in m.merge else F.max_by(c, order).alias(c) for c in rest]
            return rows.groupBy(*by).agg(*aggs or [F.lit(1)]).select(*by, *rest)
        return rows.groupBy(*by).agg(F.max_by(F.struct(F.lit(0).alias("_"), *rest), order).alias("_v")).select(
            *by, *(F.col("_v")[c].alias(c) for c in rest))

    def read(self, version: int | None = None, parts: set[str] | None = None) -> DataFrame:
        """The table as of a version (the newest), or only the partitions of these folder names.
        Partitions of one folder are read as they are; others are merged by key."""
        m = self.manifest(version)
        return self._table(m, [e for e in m.entries if parts is None or e.part in parts])

    def _table(self, m: Manifest, entries: list[Entry]) -> DataFrame:
        cols = [f["name"] for f in json.loads(m.schema)["fields"]]
        held = defaultdict(list)
        for e in entries:
            held[e.part].append(e)
        single = [es[0] for es in held.values() if len(es) == 1]
        several = [e for es in held.values() if len(es) > 1 for e in es]
        df = self._rows(m, single).select(*cols) if single or not several else None
        if several:
            merged = self._merged(m, self._rows(m, several)).select(*cols)
            df = merged if df is None else df.unionByName(merged)
        return df

    def written(self, seq: int) -> DataFrame:
        """The rows that the write of this seq delivered, unless they were merged with others since."""
        m = self.manifest()
        return self._rows(m, [e for e in m.entries if e.seq == seq]).drop("_seq")

    # writing

    def _stage(self, rows: DataFrame, partition_by: str | None, keys: list[str]) -> str:
        """Write rows to a folder that no manifest names; files follow the partitions, a large one
        has several."""
        out = f"{self.path}/data/staged-{uuid.uuid4().hex}"
        w = (rows.hint("rebalance", partition_by) if partition_by else rows.hint("rebalance")).sortWithinPartitions(
            *([partition_by] if partition_by else []), *[k for k in keys if k != partition_by]).write
        (w.partitionBy(partition_by) if partition_by else w).parquet(out)
        return out

    def _staged_parts(self, staged: str, partition_by: str | None) -> list[tuple[str, int]]:
        if not partition_by:
            p, fs = _fs(self.spark, staged)
            files = [st for st in fs.listStatus(p) if st.getPath().getName().startswith("part-")]
            size = sum(st.getLen() for st in files)
            return [("", size)] if files and not self.spark.read.parquet(staged).isEmpty() else []
        names = [n for n in list_names(self.spark, staged) if n[0] not in "._"]
        return [(n, int(_fs(self.spark, f"{staged}/{n}")[1].getContentSummary(_fs(self.spark, f"{staged}/{n}")[0]).getLength()))
                for n in names]

    def _commit(self, change, staged: str | None = None, seq: int | None = None,
                parts: list[tuple[str, int]] = ()) -> Manifest | None:
        """Publish the newest manifest as `change` makes it from (manifest, new entries); again from the
        next one if another writer was first. None if `change` gives None. The staged folder becomes
        data/commit_seq=<n>/commit_id=<id>, with the version's number or the given seq."""
        c, at = uuid.uuid4().hex[:12], staged
        while True:
            m = self.manifest()
            n = m.version + 1
            s = n if seq is None else seq
            if staged and parts:
                to = f"{self.path}/data/commit_seq={s}/commit_id={c}"
                if at != to:
                    _move(self.spark, at, to)
                    at = to
            elif staged:
                delete(self.spark, staged)
                staged = at = None
            new = change(m, [Entry(p, s, c, size) for p, size in parts])
            if new is None:
                if at:
                    delete(self.spark, at)
                return None
            new = new._replace(version=n)
            if self._publish(new):
                return new

    @staticmethod
    def _with_columns(m: Manifest, schema: T.StructType) -> str:
        known = T.StructType.fromJson(json.loads(m.schema))
        names = set(known.names)
        return T.StructType([T.StructField(f.name, f.dataType) for f in [*known.fields, *(f for f in schema.fields if f.name not in names)]]).json()

    def create(self, df: DataFrame, overwrite: bool = False) -> Manifest:
        """Create and load; fails if there is a table, unless told to overwrite it (its older
        versions stay readable until they are vacuumed)."""
        if not overwrite and self.exists():
            raise FileExistsError(f"table already exists: {self.path}")
        first = self._first
        staged = self._stage(df, first.partition_by, first.keys)
        parts = self._staged_parts(staged, first.partition_by)

        def change(m: Manifest, entries: list[Entry]) -> Manifest:
            if m.version and not overwrite:
                raise FileExistsError(f"table already exists: {self.path}")
            return first._replace(schema=self._with_columns(first, df.schema), entries=entries, registered=m.registered)
        done = self._commit(change, staged, parts=parts)
        self._follow({p for p, _ in parts})
        return done

    def upsert(self, new: DataFrame, order: list[str] = (), writer: str | None = None, batch: int | None = None,
               facts: dict | None = None, keep_order: bool = True, unique: bool = False) -> int | None:
        """Deliver rows; each replaces the stored row of its key. `order` (ascending = older)
        decides among rows of one delivery; without keep_order its columns are not stored. `unique` tells
        that the rows have one per key, as aggregates by key do. Returns the seq under which they were stored; None if
        there were none.

        The rows are read once and written once; no stored row is read or moved. With writer and
        batch a replayed batch changes nothing and returns the seq that it got before. `facts` are
        kept with the commit, also where there are no rows.
        """
        m = self.manifest()
        if writer is not None and (got := m.applied.get(writer)) and got[0] >= batch:
            return got[1] if got[0] == batch else None
        self._tidy(m)
        part = m.partition_by
        by = [*([part] if part and part not in m.keys else []), *m.keys]
        cols = [c for c in new.columns if keep_order or c not in order]
        rest = [c for c in cols if c not in by]
        if unique:
            latest = new
        elif m.merge:
            latest = self._merged(m, new.withColumn("_seq", F.struct(*order) if order else F.lit(0)))
        else:
            ordered = F.struct(*m.newest_by, *order, F.lit(0).alias("_"))
            latest = new.groupBy(*by).agg(F.max_by(F.struct(F.lit(0).alias("_"), *rest), ordered).alias("_v")).select(
                *by, *(F.col("_v")[c].alias(c) for c in rest))
        staged = self._stage(latest.select(*cols), part, m.keys)
        parts = self._staged_parts(staged, part)
        if not parts and writer is None and not facts:
            delete(self.spark, staged)
            return None

        def change(m: Manifest, entries: list[Entry]) -> Manifest:
            seq = entries[0].seq if entries else -1
            return m._replace(schema=self._with_columns(m, latest.select(*cols).schema) if entries else m.schema, entries=m.entries + entries,
                              applied=m.applied | ({writer: [batch, seq]} if writer is not None else {}), facts=m.facts | (facts or {}))
        done = self._commit(change, staged, parts=parts)
        if done.registered:
            self.compact({p for p, _ in parts})
        return done.entries[-1].seq if parts else None

    def _replace(self, old: list[Entry], rows: DataFrame | None, m: Manifest) -> bool:
        """Put rows in the place of these folders; false if another writer took one of them away."""
        staged = self._stage(rows, m.partition_by, m.keys) if rows is not None else None
        parts = self._staged_parts(staged, m.partition_by) if staged else []
        gone = set(old)

        def change(now: Manifest, entries: list[Entry]) -> Manifest | None:
            return now._replace(entries=[e for e in now.entries if e not in gone] + entries) if gone <= set(now.entries) else None
        return self._commit(change, staged, seq=max(e.seq for e in old), parts=parts) is not None

    def _tidy(self, m: Manifest) -> None:
        """Merge folders of partitions that have gathered too many: from the newest back, as long as
        those behind weigh as much as the next one, so a row is rewritten a logarithmic number of times.
        Partitions that merge the same writes are done together."""
        held, runs = defaultdict(list), defaultdict(list)
        for e in m.entries:
            held[e.part].append(e)
        for es in held.values():
            if len(es) <= self.most_folders:
                continue
            es.sort(key=lambda e: e.seq)
            k = len(es) - 2
            while k > 0 and sum(e.size for e in es[k:]) >= es[k - 1].size:
                k -= 1
            runs[tuple(e.seq for e in es[k:])].append(es[k:])
        for same in runs.values():
            old = [e for es in same for e in es]
            self._replace(old, self._merged(m, self._rows(m, old)), m)

    def compact(self, parts: set[str] | None = None) -> None:
        """One folder per partition, for these partitions or all."""
        m = self.manifest()
        held = defaultdict(list)
        for e in m.entries:
            if parts is None or e.part in parts:
                held[e.part].append(e)
        runs = defaultdict(list)  # partitions with the same newest write are merged by one job
        for es in held.values():
            if len(es) > 1:
                runs[max(e.seq for e in es)] += es
        for old in runs.values():
            self._replace(old, self._merged(m, self._rows(m, old)), m)
        self._follow(parts)

    def drop(self, parts: set[str]) -> None:
        """Remove partitions by folder name, in one commit."""
        if parts:
            self._commit(lambda m, _: m._replace(entries=[e for e in m.entries if e.part not in parts]))
            self._follow(parts)

    def expire(self, as_of, ttl_s: int = DAY_S, written_at: str = "written_at") -> None:
        """Drop the rows written more than ttl_s before as_of. Partitions without a living row go as
        they are, null and escaped values included; mixed ones are rewritten with their living rows.
        Only one row per partition reaches the driver."""
        m = self.manifest()
        if not m.entries:
            return
        w = F.col(written_at).cast("timestamp")
        cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(secs=F.lit(ttl_s))
        value = F.col(m.partition_by).cast("string") if m.partition_by else F.lit("")
        stats = self._table(m, m.entries).groupBy(value.alias("v")).agg(
            F.coalesce(F.max(w) > cutoff, F.lit(False)).alias("living"), F.coalesce(F.min(w) <= cutoff, F.lit(True)).alias("dying")).collect()
        state = {r.v: r for r in stats}
        of = lambda e: state.get(partition_value(e.part) if e.part else "")
        mixed = [e for e in m.entries if (r := of(e)) and r.living and r.dying]
        runs = defaultdict(list)
        for e in mixed:
            runs[max(x.seq for x in mixed if x.part == e.part)].append(e)
        for old in runs.values():
            self._replace(old, self._table(m, old).where(w > cutoff), m)
        self.drop({e.part for e in m.entries if (r := of(e)) is None or not r.living})
        self._follow({e.part for e in mixed})

    def note(self, **facts) -> None:
        """Keep facts with the table, as a commit without rows."""
        self._commit(lambda m, _: m._replace(facts=m.facts | facts))

    def vacuum(self, keep: int = 10) -> None:
        """Delete the manifests before the newest `keep`, and the folders that none of these names: those
        of lost writers too, so no write should be under way."""
        known = self.versions()
        named = {(str(e.seq), e.c, e.part) for v in known[-keep:] for e in self.manifest(v).entries}
        for v in known[:-keep]:
            delete(self.spark, f"{self.path}/_manifests/{v:012d}.json")
        for s in list_names(self.spark, f"{self.path}/data"):
            if s.startswith("staged-"):
                delete(self.spark, f"{self.path}/data/{s}")
                continue
            for c in list_names(self.spark, f"{self.path}/data/{s}"):
                held = {p for q, d, p in named if (f"commit_seq={q}", f"commit_id={d}") == (s, c)}
                if not held:
                    delete(self.spark, f"{self.path}/data/{s}/{c}")
                elif "" not in held:
                    for p in list_names(self.spark, f"{self.path}/data/{s}/{c}"):
                        if p[0] not in "._" and p not in held:
                            delete(self.spark, f"{self.path}/data/{s}/{c}/{p}")

    # catalog

    def register(self, name: str) -> None:
        """Let the catalog table `name` (Parquet, partitioned as this one, at its path) follow this
        table: each partition's location is its one folder, now and after every later commit through
        this class."""
        self._commit(lambda m, _: m._replace(registered=sorted({*m.registered, name})))
        self.compact()

    def _follow(self, parts: set[str] | None) -> None:
        m = self.manifest()
        for name in m.registered:
            if not self.spark.catalog.tableExists(name):
                continue
            now = {e.part: e for e in m.entries}
            for p in sorted(now if parts is None else parts):
                v = partition_value(p)
                spec = f"`{m.partition_by}`=" + ("null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'")
                if p in now:
                    at = self._folder(now[p])
                    self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{at}'")
                    self.spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{at}'")
                else:
                    self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
            self.spark.catalog.refreshTable(name)
