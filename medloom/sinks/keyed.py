"""Tables by key: rows in buckets of the key's hash, versions that name each bucket's folders, writers that do not lose
each other's rows."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.operators.tasks import last_wins, stamped_upsert, upsert

#: Buckets of a new table.
BUCKETS = 64
#: Times that a writer begins anew when others change the buckets that it has read.
TRIES = 10
#: Parts of a bucket in which new keys are counted off.
SLICES = 64
_BUCKET = "__bucket"


class Conflict(RuntimeError):
    """Other writers changed the same buckets again and again."""


@dataclass
class Version:
    """``number`` (0: no table yet), the keys, the number of buckets, the rows' schema and the folders of each bucket."""

    number: int = 0
    keys: list[str] = field(default_factory=list)
    buckets: int = BUCKETS
    schema: T.StructType | None = None
    folders: dict[int, list[str]] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"keys": self.keys, "buckets": self.buckets, "schema": self.schema.json(), "folders": self.folders})

    @classmethod
    def of(cls, number: int, text: str) -> Version:
        x = json.loads(text)
        return cls(number, x["keys"], x["buckets"], T.StructType.fromJson(json.loads(x["schema"])), {int(k): v for k, v in x["folders"].items()})


class KeyedTable:
    """A table at ``path`` with unique or grouping ``keys``.

    Data lie in ``data/<write>/__bucket=<n>``, versions in ``versions/<number>.json``.  A write reads and writes the
    buckets of its own keys only, beside what is there, and becomes visible when its version is renamed into place,
    which fails if another writer took the number.  A writer that lost the race takes the newer version: if its buckets
    are as it read them, it adds its own, else it begins anew.  A writer that dies before the rename leaves a folder that
    no version names (``clear`` removes it).  The rename has to be atomic and must not replace a file, as on HDFS."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path("").getFileSystem(self._conf)

    def _path(self, rest: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{rest}" if rest else self.path)

    def _numbers(self) -> list[int]:
        folder = self._path("versions")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> Version:
        """The newest version, or one by its number."""
        there = self._numbers()
        if not there:
            return Version(keys=list(self.keys or []), buckets=self.buckets)
        number = there[-1] if number is None else number
        stream = self._files.open(self._path(f"versions/{number:08d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version.of(number, text)

    def read(self, version: Version | None = None, only: list[int] | None = None) -> DataFrame:
        """Rows of a version, of some buckets alone where ``only`` has them."""
        v = version or self.version()
        if v.schema is None:
            raise FileNotFoundError(self.path)
        paths = [f"{self.path}/{f}" for b, own in v.folders.items() if only is None or b in only for f in own]
        return self.spark.read.schema(v.schema).parquet(*paths) if paths else self.spark.createDataFrame([], v.schema)

    def bucket(self, v: Version) -> Column:
        return F.pmod(F.xxhash64(*v.keys), F.lit(v.buckets)).cast("int")

    def lookup(self, **key) -> DataFrame:
        """Rows of one key, from its bucket alone."""
        v = self.version()
        one = self.spark.createDataFrame([tuple(key[k] for k in v.keys)], T.StructType([v.schema[k] for k in v.keys]))
        number = one.select(self.bucket(v)).first()[0]
        out = self.read(v, [number])
        for k in v.keys:
            out = out.where(F.col(k).eqNullSafe(F.lit(key[k])))
        return out

    def _publish(self, v: Version) -> bool:
        """Make ``v`` the version of its number; False if there is one already."""
        part, final = self._path(f"versions/.{uuid.uuid4().hex}"), self._path(f"versions/{v.number:08d}.json")
        out = self._files.create(part)
        out.write(bytearray(v.text().encode()))
        out.close()
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.makeQualified(final).toUri(), self._conf)
            context.rename(self._files.makeQualified(part), self._files.makeQualified(final), self.spark.sparkContext._gateway.new_array(kind, 0))
        except Py4JJavaError as e:
            self._files.delete(part, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                return False
            raise
        return True

    def write(self, new: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> Version:
        """Put ``merged(old, new)``, of the old rows in the buckets of the new ones' keys, in those buckets' place."""
        new = new.persist()
        try:
            return self._write(new, merged)
        finally:
            new.unpersist()

    def _write(self, new: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> Version:
        for _ in range(TRIES):
            v = self.version()
            if self.keys and v.keys != list(self.keys):
                raise ValueError(f"the table's keys are {v.keys}, not {list(self.keys)}")
            self.keys = list(v.keys)
            schema = v.schema or T.StructType([T.StructField(f.name, f.dataType, True) for f in new.schema.fields])
            rows = new.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
            dealt = self.bucket(v)
            # numbers of buckets, as many as there are at most
            touched = sorted(r[0] for r in rows.select(dealt.alias("b")).distinct().collect())
            if not touched and v.schema is not None:
                return v
            old = self.read(v, touched) if v.schema is not None else self.spark.createDataFrame([], schema)
            folder = f"data/{uuid.uuid4().hex}"
            whole = merged(old, rows).select(*schema.fieldNames()).withColumn(_BUCKET, dealt)
            # a bucket is one file as long as it is small, and several tasks' work when it is not
            whole.hint("rebalance", F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
            there = {int(s.getPath().getName().split("=")[1]) for s in self._files.listStatus(self._path(folder)) if "=" in s.getPath().getName()}
            for _ in range(TRIES):
                folders = {b: own for b, own in v.folders.items() if b not in touched} | {b: [f"{folder}/{_BUCKET}={b}"] for b in touched if b in there}
                after = Version(v.number + 1, v.keys, v.buckets, schema, folders)
                if self._publish(after):
                    return after
                newer = self.version()
                same = all(newer.folders.get(b) == v.folders.get(b) for b in touched) and newer.buckets == v.buckets and newer.schema == schema
                v = newer
                if not same:
                    break
            self._files.delete(self._path(folder), True)
        raise Conflict(self.path)

    def upsert(self, new: DataFrame, order: list[str] | None = None) -> Version:
        """Insert or update; of several new rows of a key the last by ``order`` counts."""
        return self.write(new, lambda old, rows: upsert(old, rows, self.keys, order))

    def upsert_stamped(self, new: DataFrame, stamp: str, now: Column) -> Version:
        """Insert or update by one key; the stamp becomes ``now`` where another column differs, null-safe, and stays where
        none does.  New rows have ``now``."""

        def merged(old, rows):
            (key,) = self.keys
            one = last_wins(rows, [key], [c for c in rows.columns if c not in (key, stamp)])
            return stamped_upsert(old, one, key, stamp, now)

        return self.write(new, merged)

    def upsert_numbered(self, new: DataFrame, number: str, order: list[str] | None = None) -> Version:
        """Insert or update, with a number (bigint) for each key that is generated when the key first comes and stays.

        Numbers are unique in the table: those of bucket b are b, b + buckets, b + 2 buckets ..., in the order that keys came
        to it, so two writers of different buckets give none twice.  Of several new rows of a key the last by ``order`` counts.
        New keys are counted off in slices of their bucket, in parallel; a bucket's window is over its slices only."""
        b, s = "__b", "__s"

        def merged(old, rows):
            v = self.version()
            keys = v.keys
            rest = [c for c in rows.columns if c not in (*keys, number)]
            one = last_wins(rows.drop(number), keys, order or rest) if rest else rows.select(*keys).distinct()
            known = old.select(*[F.col(k).alias(f"__{k}") for k in keys], number)
            came = one.join(known, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left").select(*keys, *rest, number)
            mine = came.select(*[F.col(k).alias(f"__{k}") for k in keys])
            stay = old.join(mine, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti")
            fresh = came.where(F.col(number).isNull()).withColumn(b, self.bucket(v)).withColumn(s, F.pmod(F.xxhash64(F.lit("slice"), *keys), F.lit(SLICES)))
            before = Window.partitionBy(b).orderBy(s).rowsBetween(Window.unboundedPreceding, -1)
            starts = fresh.groupBy(b, s).agg(F.count(F.lit(1)).alias("__n")).select(b, s, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
            last = old.groupBy(self.bucket(v).alias(b)).agg(F.max(F.floor(F.col(number) / v.buckets)).alias("__last"))
            counted = fresh.join(starts, [b, s]).join(last, b, "left")
            turn = F.coalesce(F.col("__last"), F.lit(-1)) + F.col("__start") + F.row_number().over(Window.partitionBy(b, s).orderBy(*keys))
            given = counted.withColumn(number, (turn * v.buckets + F.col(b)).cast("bigint"))
            return stay.unionByName(came.where(F.col(number).isNotNull())).unionByName(given.select(*came.columns))

        return self.write(new.withColumn(number, F.lit(None).cast("bigint")), merged)

    def keep_greatest(self, new: DataFrame, order: list[str]) -> Version:
        """One row per key: the greatest by ``order`` of what is there and what comes, so late rows change nothing."""
        return self.write(new, lambda old, rows: last_wins(old.unionByName(rows), self.keys, order))

    def insert_missing(self, new: DataFrame) -> Version:
        """Insert if not exists: the row that is there stays; of several new rows of a key the least is taken."""

        def merged(old, rows):
            rest = [c for c in rows.columns if c not in self.keys]
            one = rows.groupBy(*self.keys).agg(F.min(F.struct(*rest)).alias("r")).select(*[F.col(c) if c in self.keys else F.col(f"r.{c}").alias(c) for c in rows.columns])
            both = old.withColumn("__new", F.lit(0)).unionByName(one.withColumn("__new", F.lit(-1)))
            return last_wins(both, self.keys, ["__new", *rest]).drop("__new")

        return self.write(new, merged)

    def replace(self, new: DataFrame) -> Version:
        """All stored rows of the keys that come go; the new rows, of which a key may have several, are added."""

        def merged(old, rows):
            came = rows.select(*[F.col(k).alias(f"__{k}") for k in self.keys]).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys]
            return old.join(came, same, "left_anti").unionByName(rows)

        return self.write(new, merged)

    def delete(self, keys: DataFrame) -> Version:
        """All rows of the keys go."""
        v = self.version()
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in v.schema.fields if f.name not in v.keys]

        def merged(old, rows):
            came = rows.select(*[F.col(k).alias(f"__{k}") for k in v.keys]).distinct()
            return old.join(came, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in v.keys], "left_anti")

        return self.write(keys.select(*v.keys, *rest), merged)

    def clear(self, keep: int = 1, age: float = 86_400) -> list[str]:
        """Delete versions but the last ``keep``, and folders of buckets that none of those names and that are ``age``
        seconds old: a younger one may still be a writer's.  Returns the folders."""
        numbers = self._numbers()
        named = {f for n in numbers[-keep:] for own in self.version(n).folders.values() for f in own}
        for n in numbers[:-keep]:
            self._files.delete(self._path(f"versions/{n:08d}.json"), False)
        gone = []
        for write in self._files.listStatus(self._path("data")) if numbers else []:
            name = f"data/{write.getPath().getName()}"
            if time.time() - write.getModificationTime() / 1000 < age:
                continue
            mine = [f"{name}/{b.getPath().getName()}" for b in self._files.listStatus(write.getPath())]
            kept = [f for f in mine if f in named]
            for f in [f for f in mine if f not in kept] if kept else [name]:
                self._files.delete(self._path(f), True)
                gone.append(f)
        return gone
