"""Two-pass external shuffle into shards.

Pass one scatters whole records into buckets by a seeded hash of all their columns, and of a copy's number where a record is
repeated so often that its copies would fill a bucket; a bucket is sized to fit in a task's memory. Pass two shuffles each bucket by Fisher-Yates with a seed of its own. The buckets in order are one uniformly shuffled sequence,
which is cut into shards whose row counts differ by one at most (the law ``rows``). Nothing depends on how Spark happened to
partition the input, so a task that is run again writes the same rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql import types as S

from factloom.llm.runtime import cut, ensure_importable, free

#: Bytes of records in a bucket.
BUCKET_BYTES = 8 << 20
#: Hot rows of which every task holds the hashes (8 bytes each); where there are more, the rows move to them.
BROADCAST_ROWS = 1 << 20
#: Bytes of a record beside its text.
RECORD_BYTES = 8


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniformly random order of 0..n-1: for i from the last to the second place, swap with a random place up to i."""
    rng = np.random.Generator(np.random.PCG64(seed))
    order = list(range(n))
    places = rng.integers(0, np.arange(1, n + 1)) if n else []
    for i in range(n - 1, 0, -1):
        j = places[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _running(counts: DataFrame, bucket: str, width: int = 4096) -> DataFrame:
    """(bucket, before): rows in the buckets before each one. No task sees more than ``width`` buckets, or one sum for so many."""
    blocks = counts.withColumn("_block", F.floor(F.col(bucket) / width))
    inside = F.sum("_n").over(W.partitionBy("_block").orderBy(bucket)) - F.col("_n")
    totals = blocks.groupBy("_block").agg(F.sum("_n").alias("_all"))
    totals = totals.select("_block", (F.sum("_all").over(W.orderBy("_block")) - F.col("_all")).alias("_first"))
    return blocks.withColumn("_inside", inside).join(totals, "_block").select(bucket, (F.col("_first") + F.col("_inside")).alias("before"))


def _copies(docs: DataFrame, row_: str, copy_: str, most: int, chunk: int = 1000) -> DataFrame:
    """docs with a number for each copy of the rows that occur over ``most`` times; 0 for all others.

    Copies are counted on the map side, so one row stands for all that a task has, and made again in chunks. Each hot row has over
    ``most`` copies, so they are few, and their hashes go to the rows; other rows are not moved to be told apart from them.
    """
    hot = docs.groupBy(row_).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(row_)
    hot = cut(hot)
    found = hot.count()
    if not found:
        return docs.withColumn(copy_, F.lit(0).cast("long"))
    hot = F.broadcast(hot) if found <= BROADCAST_ROWS else hot
    names = docs.columns
    once = docs.join(hot, row_, "left_semi").groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count("*").alias(copy_ + "n"))
    parts = once.withColumn(copy_ + "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copy_ + "n") - 1, F.lit(chunk).cast("long")))).repartition(row_, copy_ + "at")
    last = F.least(F.col(copy_ + "at") + chunk, F.col(copy_ + "n")) - 1
    again = parts.withColumn(copy_, F.explode(F.sequence(copy_ + "at", last))).select(*[F.col(f"`{c}`") for c in names], copy_)
    return docs.join(hot, row_, "left_anti").select(*[F.col(f"`{c}`") for c in names]).withColumn(copy_, F.lit(0).cast("long")).unionByName(again)


def external_shuffle(docs: DataFrame, shards: int, text_col: str = "text", seed: int = 17, bucket_bytes: int = BUCKET_BYTES, buckets_a_task: int = 4) -> DataFrame:
    """docs in shuffled order, with the columns shard int and slot long (gapless from 0 in each shard).

    Null texts have no bytes. Rows of one id that differ in any column are scattered apart, and so are the copies of a row
    that is repeated over ``bucket_bytes`` / (64 * its bytes) times, so no id and no row fills a bucket. Columns of any type
    and name stay as they are (maps are hashed by their sorted entries; where maps lie inside of other types, those columns
    are left out of the hash and repeated rows share a bucket). Columns named shard or slot are replaced.
    """
    ensure_importable(docs.sparkSession)
    docs = docs.drop("shard", "slot")
    row_, bucket_, copy_ = free(docs, "_srow", "_sbucket", "_scopy")
    names, maps = docs.columns, [f.name for f in docs.schema.fields if isinstance(f.dataType, S.MapType)]
    nested = [f.name for f in docs.schema.fields if f.name not in maps and "map<" in f.dataType.simpleString() or f.name in maps and f.dataType.simpleString().count("map<") > 1]
    weight = F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long") + RECORD_BYTES
    rows, total = docs.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    buckets = max(1, math.ceil(total / bucket_bytes))

    def entries(df: DataFrame, back: bool = False) -> DataFrame:
        """Maps as sorted arrays of entries, which can be hashed and grouped, and back."""
        change = F.map_from_entries if back else lambda c: F.array_sort(F.map_entries(c))
        return df.withColumns({c: change(F.col(f"`{c}`")) for c in maps if c not in nested}) if maps else df

    flat = entries(docs)
    flat = flat.withColumn(row_, F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in names if c not in nested]))
    most = max(1, bucket_bytes // (64 * max(1, total // max(rows, 1))))
    flat = flat.withColumn(copy_, F.lit(0).cast("long")) if nested else _copies(flat, row_, copy_, most)
    bucket = F.pmod(F.when(F.col(copy_) == 0, F.col(row_)).otherwise(F.xxhash64(row_, copy_)), F.lit(buckets))
    flat = flat.withColumn(bucket_, bucket)
    counts = flat.select(bucket_).groupBy(bucket_).agg(F.count("*").alias("_n"))
    before = _running(counts, bucket_).withColumnRenamed(bucket_, "bucket")
    # Both sides are dealt out alike, so their groups meet without a further exchange, and the rows move once. For a join Spark would
    # move them again, to its own number of partitions, and back for the groups.
    tasks = max(1, math.ceil(buckets / buckets_a_task))
    scattered = entries(flat, back=True).repartition(tasks, bucket_)
    before = before.repartition(tasks, "bucket")
    schema = S.StructType([*docs.schema.fields, S.StructField("shard", S.IntegerType()), S.StructField("slot", S.LongType())])

    def shuffled(group: pa.Table, at: pa.Table) -> pa.Table:
        n = group.num_rows
        # The rows arrive in any order, so they are put in one that depends on the rows alone.
        keys = pa.table({"r": group.column(row_), "t": group.column(text_col)})
        order = pc.sort_indices(keys, sort_keys=[("r", "ascending"), ("t", "ascending")]).to_numpy()
        order = order[fisher_yates(n, seed * 1_000_003 + int(group.column(bucket_)[0].as_py()))]
        place = int(at.column("before")[0].as_py()) + np.arange(n, dtype=np.int64)
        shard = place * shards // rows
        first = -(-shard * rows // shards)
        out = group.select(names).take(pa.array(order))
        return out.append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(place - first))

    return scattered.groupBy(bucket_).cogroup(before.groupBy("bucket")).applyInArrow(shuffled, schema)


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """Write the shuffled shards as Parquet, a folder ``shard=k`` for each, the rows of a file in the order of their slots."""
    out = external_shuffle(docs, shards, **options)
    out.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
