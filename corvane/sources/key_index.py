"""An index of the keys of an archive, so that an append needn't read the archive.

Keys are dealt by hash into buckets, folders of small Parquet files; a batch reads the buckets that its keys fall into
and nothing else. The number of buckets follows the index: when buckets would exceed their size on average, or consist
of too many files, the index is written anew, with more buckets, as the next version, and readers turn to it once it is
complete. So what a batch reads depends on the batch, not on the archive, and rewriting costs a constant share of all
appends.

The archive is written between begin() and end(). A marker tells an append that was broken off in between; the next one
then builds the index anew from the archive's keys. Defined cases: null keys are in no index; an index without a
version holds nothing; repeated keys are kept once a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.sources import store

#: Bytes of a bucket on average and files of a bucket, beyond which the index is written anew; bits that are added then.
BUCKET_BYTES, BUCKET_FILES, MORE_BITS, MOST_BITS = 1 << 20, 32, 3, 20
#: Buckets that are read by their paths; of more, the index is listed as a whole.
BY_PATH = 2_000


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.path, self.bucket_bytes = spark, path.rstrip("/"), bucket_bytes

    def version(self) -> tuple[str, int] | None:
        """Folder and bits of the newest complete version."""
        done = [n for n in store.names(self.spark, self.path) if n.startswith("v") and store.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return (f"{self.path}/{max(done)}", int(max(done).split("-")[1])) if done else None

    def broken(self) -> bool:
        """Whether an append was broken off between begin() and end()."""
        return store.exists(self.spark, f"{self.path}/_pending")

    def begin(self) -> None:
        store.mark(self.spark, f"{self.path}/_pending")

    def end(self) -> None:
        store.delete(self.spark, f"{self.path}/_pending")

    def rebuild(self, keys: DataFrame, bits: int | None = None) -> None:
        """A new version of these keys (one string column); earlier versions go once it is complete."""
        old = [n for n in store.names(self.spark, self.path) if n.startswith("v")]
        number = int(old[-1][1:9]) + 1 if old else 0
        bits = 0 if bits is None else min(bits, MOST_BITS)
        self._write(keys, f"{self.path}/v{number:08d}-{bits:02d}", bits)
        for n in old:
            store.delete(self.spark, f"{self.path}/{n}")
        self._grow()

    def add(self, keys: DataFrame) -> None:
        """Keys that the archive now has, too."""
        now = self.version()
        if now is None:
            self.rebuild(keys)
        else:
            self._write(keys, *now)
            self._grow()

    def seen(self, keys: DataFrame, key: str) -> DataFrame:
        """Those of the keys (distinct, column `key`) that the index has."""
        now = self.version()
        if now is None:
            return keys.select(key).limit(0)
        folder, bits = now
        asked = keys.select(F.col(key), _bucket(F.col(key), bits).alias("bucket"))
        touched = [r.bucket for r in asked.select("bucket").distinct().orderBy("bucket").collect()]  # at most 2^bits numbers
        held = self._read(folder, touched)
        return asked.join(held, (asked["bucket"] == held["bucket"]) & (asked[key] == held["_key"]), "left_semi").select(key) if held is not None else keys.select(key).limit(0)

    def bytes_read(self, keys: DataFrame, key: str) -> int:
        """Bytes of the buckets that a batch of keys reads."""
        now = self.version()
        if now is None:
            return 0
        touched = [r.bucket for r in keys.select(_bucket(F.col(key), now[1]).alias("bucket")).distinct().collect()]
        return sum(store.size(self.spark, f"{now[0]}/bucket={b}")[0] for b in touched)

    def _read(self, folder: str, touched: list[int]) -> DataFrame | None:
        reader = self.spark.read.schema("_key string, bucket int").option("basePath", folder)
        if len(touched) > BY_PATH:
            return reader.parquet(folder)
        paths = [p for p in (f"{folder}/bucket={b}" for b in touched) if store.exists(self.spark, p)]
        return reader.parquet(*paths) if paths else None

    def _write(self, keys: DataFrame, folder: str, bits: int) -> None:
        named = keys.select(F.col(keys.columns[0]).cast("string").alias("_key")).where("_key IS NOT NULL").distinct().withColumn("bucket", _bucket(F.col("_key"), bits))
        named.repartition("bucket").sortWithinPartitions("bucket", "_key").write.mode("append").partitionBy("bucket").parquet(folder)

    def _grow(self) -> None:
        folder, bits = self.version()
        length, files = store.size(self.spark, folder)
        more = length > self.bucket_bytes << bits and bits < MOST_BITS
        if more or files > 2 * BUCKET_FILES << bits:  # of a file, a checksum may be another
            held = self.spark.read.schema("_key string, bucket int").parquet(folder)
            self.rebuild(held.select("_key"), bits + MORE_BITS if more else bits)


def _bucket(key, bits: int):
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << bits)).cast("int")
