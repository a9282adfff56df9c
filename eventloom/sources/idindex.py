"""Which event ids are stored: a narrow table of ids in hash buckets, with a filter in front.

Each batch adds the ids it stored, in folders by hash bucket, and a filter of 16 bits an id. A delivery
is held against the filters first, which are a tenth of the ids in size; only ids whose bit is set
(all that are stored, and one in 16 of the new) are looked up, and only in the buckets they fall into.
Compaction keeps the number of folders bounded, so the files that a batch opens do not depend on how many batches
or days are stored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.logtable import LogTable

BITS_PER_ID = 16
#: Bits that Spark's bitmap functions hold in one value.
BITMAP_BITS = 32_768
FILTER = "no bigint, bits binary"


class IdIndex:
    """Ids stored under ``path``; the number of buckets is fixed for the life of an index."""

    def __init__(self, spark: SparkSession, path: str, key: str = "event_id", buckets: int = 64):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.table = LogTable(spark, path)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.lit(0), self.key), F.lit(self.buckets)).cast("int")

    def _bit(self, size: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(1), self.key), F.lit(size))

    def _write(self, ids: DataFrame) -> dict:
        """Folders of ids and of their filter; ``ids`` is read twice."""
        rows, bits = self.table.new_folder(), self.table.new_folder()
        n = ids.count()
        size = BITMAP_BITS
        while size < BITS_PER_ID * n:
            size *= 2
        bucketed = ids.select(self.key, self._bucket().alias("bucket"))
        bucketed.repartition(F.col("bucket")).sortWithinPartitions("bucket").write.partitionBy("bucket").parquet(rows)
        bit = ids.select(self._bit(size).alias("bit"))
        maps = bit.groupBy(F.floor(F.col("bit") / BITMAP_BITS).alias("no")).agg(
            F.bitmap_construct_agg(F.col("bit") % BITMAP_BITS).alias("bits")
        )
        maps.write.parquet(bits)
        return {"folder": rows, "filter": bits, "size": size, "rows": n}

    def _rows(self, entries: list[dict], key_type: str) -> DataFrame:
        return self.table.read(f"`{self.key}` {key_type}, bucket int", entries)

    def suspects(self, df: DataFrame, entries: list[dict]) -> DataFrame:
        """(key, bucket) of the ids of ``df`` that may be stored: all that are, and few others."""
        found = []
        for entry in entries:
            maps = self.spark.read.schema(FILTER).parquet(entry["filter"])
            asked = df.select(self.key, self._bit(entry["size"]).alias("_bit"))
            hits = asked.join(maps, F.floor(F.col("_bit") / BITMAP_BITS) == F.col("no"))
            place = (F.col("_bit") % BITMAP_BITS).cast("int")
            byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            found.append(hits.where(F.getbit(byte, place % 8) == 1).select(self.key))
        return reduce(DataFrame.unionAll, found).distinct().select(self.key, self._bucket().alias("bucket"))

    def without_stored(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Rows of ``df`` whose id no other batch has stored. Rows without an id stay."""
        entries = [e for e in self.table.others(batch_id) if e["rows"]]
        if not entries:
            return df
        maybe = self.suspects(df, entries).persist()
        # At most ``buckets`` numbers; they prune the folders that are read.
        wanted = [r.bucket for r in maybe.select("bucket").distinct().collect()]
        if not wanted:
            maybe.unpersist()
            return df
        stored = self._rows(entries, df.schema[self.key].dataType.simpleString()).where(F.col("bucket").isin(wanted))
        known = stored.join(maybe, ["bucket", self.key], "left_semi").select(self.key)
        return df.join(known, self.key, "left_anti")

    def add(self, ids: DataFrame, batch_id: int) -> None:
        """Add the ids that a batch stored, then merge old batches if many wait."""
        self.table.put(batch_id, self._write(ids.select(self.key).na.drop()))
        key_type = ids.schema[self.key].dataType.simpleString()
        self.table.compact(lambda entries: self._write(self._rows(entries, key_type).select(self.key)))
