"""Size-tiered compaction of document shards, under versioned manifests.

A store is a folder: `data/run-N/` holds immutable Parquet shards, `manifests/vN/` the list
of live shards as of version N.  An arrival is appended as small shards.  Shards of like
size (a power of RATIO times SMALL apart) form a tier; once a tier has MERGE shards, those
are rewritten as few shards near the target size, tier by tier, without a shuffle: the
files of a tier are read as they lie and dealt to as many writers as target-sized files are
needed.  A manifest is written to a folder of its own and renamed into place, by a rename
that fails if that version exists; as some file systems move a folder into one of the same
name instead, the writer then looks for a mark of its own, and takes a version as committed
only if it finds it.  Readers only see whole manifests, and all versions stay until
`vacuum` removes the ones beyond a given number and age.

All data and metadata go through DataFrame operations.  The driver handles the paths of the
shards that it reads or rewrites, as Spark's own file listing does.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import checkpoint_dir, fresh

#: Bytes of documents (not of files): the least tier's upper bound, the target of a merged shard, and the factor between tiers.
SMALL, TARGET, RATIO = 4 << 20, 64 << 20, 4
#: Shards that a tier has to have before they are merged.
MERGE = 4
_MANIFEST = "shard string, tier int, n_docs long, n_bytes long, version long"


class ShardStore:
    """A folder of shards.  id and size columns tell how documents are counted and measured."""

    def __init__(self, spark: SparkSession, path: str, text_column: str = "text", small: int = SMALL, target: int = TARGET, ratio: int = RATIO, merge: int = MERGE) -> None:
        self.spark, self.path, self.text_column = spark, path.rstrip("/"), text_column
        self.small, self.target, self.ratio, self.merge = small, target, ratio, merge

    # Folders and atomic renames, by the file system that the path names.

    def _file(self, name: str):  # noqa: ANN202
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    @property
    def _fs(self):  # noqa: ANN202
        return self._file("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The number of the latest committed manifest; 0 without any."""
        at = self._file("manifests")
        names = [x.getPath().getName() for x in self._fs.listStatus(at)] if self._fs.exists(at) else []
        return max([0, *(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())])

    def manifest(self, version: int | None = None) -> DataFrame:
        """The live shards of a version: shard (path below the store), tier, n_docs, n_bytes, version (in which it came)."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifests/v{version:08d}")

    def schema(self, version: int | None = None) -> StructType:
        """The columns of a version's documents, as its manifest keeps them; none of an empty store."""
        version = self.version() if version is None else version
        if not version:
            return StructType()
        kept = self._file(f"manifests/v{version:08d}/_schema.json")
        if not self._fs.exists(kept):  # a manifest that came before schemas were kept
            return self._documents(self.manifest(version)).schema
        with_ = self._fs.open(kept)
        try:
            text = bytes(x & 0xFF for x in self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(with_)).decode()
        finally:
            with_.close()
        return StructType.fromJson(json.loads(text))

    def _joined(self, base: int, arrival: StructType) -> StructType:
        """The columns of version base and of an arrival; an error if one has another type there.  No widening is done: not of int to long, nor any other."""
        known = self.schema(base)
        kinds = {f.name.lower(): f for f in known}
        for f in arrival:
            before = kinds.get(f.name.lower())
            if before is not None and before.dataType.simpleString() != f.dataType.simpleString():
                raise ValueError(f"column {f.name} is {f.dataType.simpleString()}, but {before.dataType.simpleString()} in {self.path}")
        return StructType([*known, *(StructField(f.name, f.dataType) for f in arrival if f.name.lower() not in kinds)])

    def commit(self, shards: DataFrame, base: int, schema: StructType | None = None) -> int:
        """Writes the manifest of version base + 1, all of it or nothing; an error if another writer has committed that version.

        That holds where renaming a folder is one step that fails if the new name exists, as on
        HDFS and local disks; on an object store without such renames, writers need a lock of their own.
        """
        schema = self.schema(base) if schema is None else schema
        mark, final = f"_by-{uuid.uuid4().hex}", f"manifests/v{base + 1:08d}"
        staged = f"manifests/.staged{mark}"
        shards.write.parquet(f"{self.path}/{staged}")
        self._fs.create(self._file(f"{staged}/{mark}"), False).close()
        out = self._fs.create(self._file(f"{staged}/_schema.json"), False)
        out.write(bytearray(schema.json().encode()))
        out.close()
        self._renamed(staged, final)
        if not self._fs.exists(self._file(f"{final}/{mark}")):
            for left in (staged, f"{final}/.staged{mark}"):
                self._fs.delete(self._file(left), True)
            raise RuntimeError(f"version {base + 1} of {self.path} was committed by another writer")
        return base + 1

    def _renamed(self, staged: str, final: str) -> None:
        """Tries to rename one folder to another that is not to exist."""
        jvm = self.spark._jvm
        options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never = self.spark.sparkContext._gateway.new_array(options, 1)
        never[0] = options.valueOf("NONE")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._fs.makeQualified(self._file(staged)), self._fs.makeQualified(self._file(final)), never)
        except Py4JJavaError as error:
            if "Exist" not in error.java_exception.getClass().getName() and not self._fs.exists(self._file(final)):
                raise

    def _written(self, run: str, version: int) -> DataFrame:
        """The manifest rows of the shards of a run; a shard's size is that of its documents' texts."""
        below = F.concat(F.lit(f"{run}/"), F.regexp_extract(F.input_file_name(), f"/{run}/(.*)$", 1))
        size = F.coalesce(F.octet_length(self.text_column), F.lit(0)).cast("long")
        rows = self.spark.read.parquet(f"{self.path}/{run}").select(size.alias("bytes"), below.alias("shard"))
        sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("bytes").alias("n_bytes"))
        step = F.log(float(self.ratio), F.greatest(F.col("n_bytes") / float(self.small), F.lit(1.0)))
        return sizes.select("shard", F.ceil(F.round(step, 9)).cast("int").alias("tier"), "n_docs", "n_bytes", F.lit(version).cast("long").alias("version"))

    def _new_run(self, version: int) -> str:
        return f"data/run-{version:08d}-{uuid.uuid4().hex[:8]}"

    def append(self, arrival: DataFrame) -> int:
        """Adds the rows of an arrival as small shards, one or more for each of its tasks, and commits.

        It may lack columns, and have new ones; a column of another type than before is an error, before anything is written.
        """
        base = self.version()
        schema, run = self._joined(base, arrival.schema), self._new_run(base + 1)
        arrival.write.option("compression", "zstd").parquet(f"{self.path}/{run}")
        return self.commit(self.manifest(base).unionByName(self._written(run, base + 1)), base, schema)

    def arrivals(self, docs: DataFrame, column: str) -> Iterator[int]:
        """Writes all rows once, by the value of a column of whole numbers (which is not stored); then commits a value at a time, in order, as versions."""
        run, arriving = self._new_run(self.version() + 1), docs.drop(column).schema
        self._joined(self.version(), arriving)
        docs.write.partitionBy(column).option("compression", "zstd").parquet(f"{self.path}/{run}")
        folders = sorted((int(n.split("=")[1]), n) for n in self._names(run) if "=" in n)
        for _, folder in folders:
            base = self.version()
            yield self.commit(self.manifest(base).unionByName(self._written(f"{run}/{folder}", base + 1)), base, self._joined(base, arriving))

    def _names(self, folder: str) -> list[str]:
        at = self._file(folder)
        return [x.getPath().getName() for x in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _documents(self, shards: DataFrame) -> DataFrame:
        """The rows of shards; columns that some shards lack are null there."""
        paths = [f"{self.path}/{x['shard']}" for x in shards.select("shard").toLocalIterator()]
        if not paths:
            raise AnalysisException("the store has no shards")
        return self.spark.read.option("mergeSchema", True).parquet(*paths)

    def due(self, live: DataFrame) -> DataFrame:
        """(tier, n, bytes) of the tiers to merge: of shards below half the target size, those with enough of them."""
        small = live.where(F.col("n_bytes") < self.target // 2)
        return small.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("bytes")).where(F.col("n") >= self.merge)

    def compact(self) -> int:
        """Merges every tier that is due, from the least on, and commits each merge."""
        while True:
            base = self.version()
            live = self.manifest(base)
            first = self.due(live).orderBy("tier").limit(1).collect()
            if not first:
                return base
            tier = (F.col("tier") == first[0]["tier"]) & (F.col("n_bytes") < self.target // 2)
            run = self._new_run(base + 1)
            files = max(1, math.ceil(first[0]["bytes"] / self.target))
            self._documents(live.where(tier)).coalesce(files).write.option("compression", "zstd").parquet(f"{self.path}/{run}")
            self.commit(live.where(~tier).unionByName(self._written(run, base + 1)), base, self.schema(base))

    def vacuum(self, versions: int = 10, seconds: float = 7 * 86_400) -> None:
        """Removes manifests but for the latest `versions`, and shards that none of those names; nothing that is younger than `seconds`.

        Writers that take longer than that from their first shard to their commit lose it, and
        so do readers of the versions that go.  It is never called by itself.
        """
        now, before = self.version(), 1000 * (time.time() - seconds)
        old = lambda name: self._fs.getFileStatus(self._file(name)).getModificationTime() < before
        names = [n for n in self._names("manifests") if n.startswith("v") and n[1:].isdigit()]
        gone = {n for n in names if int(n[1:]) <= now - versions and old(f"manifests/{n}")}
        keep = {x["shard"] for n in names if n not in gone for x in self.manifest(int(n[1:])).select("shard").distinct().toLocalIterator()}
        for n in gone:
            self._fs.delete(self._file(f"manifests/{n}"), True)
        files = self._fs.listFiles(self._file("data"), True)
        while files.hasNext():
            at = files.next().getPath()
            name = at.toUri().getPath().split(f"{self._file('').toUri().getPath().rstrip('/')}/", 1)[1]
            if name not in keep and old(name):
                self._fs.delete(at, False)

    def read(self, version: int | None = None, shard_column: str | None = None) -> DataFrame:
        """The documents of a version, with all their columns; shard_column, if given, names the shard that each lies in.  An error if there are no shards."""
        rows = self._documents(self.manifest(version))
        if shard_column is None:
            return rows
        return rows.withColumn(shard_column, F.regexp_extract(F.input_file_name(), "/(data/run-.*)$", 1))


def compacted(docs: DataFrame, path: str | None = None, arrivals: int = 4, id_column: str = "doc_id", text_column: str = "text", **sizes: int) -> DataFrame:
    """Appends docs in arrivals (by crc32 of the id), compacts after each, and returns where every document lies.

    One row per row of docs: doc_id, n_bytes (UTF-8 bytes of its text; 0 for a null text),
    arrival, shard, tier, shard_docs, shard_bytes, version (of the manifest that the shard
    came with).  A null id is in arrival 0.  Rows are kept as often as they occur, with all
    their columns, in the store at path (by default a new folder in the checkpoint folder).
    All versions stay.
    """
    spark = docs.sparkSession
    store = ShardStore(spark, path or f"{checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}", text_column, **sizes)
    of_id = lambda c: F.coalesce(F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(arrivals)), F.lit(0)).cast("int")
    name = fresh("_arrival", docs.columns)
    for _ in store.arrivals(docs.withColumn(name, of_id(id_column)), name):
        store.compact()
    live = store.manifest()
    at = fresh("_shard", docs.columns)
    kept = docs.limit(0).withColumn(at, F.lit("")) if live.isEmpty() else store.read(shard_column=at)
    size = F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long")
    placed = kept.select(F.col(id_column).alias("doc_id"), size.alias("n_bytes"), of_id(id_column).alias("arrival"), F.col(at).alias("shard"))
    where = live.select("shard", "tier", F.col("n_docs").alias("shard_docs"), F.col("n_bytes").alias("shard_bytes"), "version")
    return placed.join(where, "shard").select("doc_id", "n_bytes", "arrival", "shard", "tier", "shard_docs", "shard_bytes", "version")
