"""Sharding by a two-pass external shuffle, in DataFrame operations alone.

Pass one scatters the rows uniformly into memory-sized buckets by a seeded hash of the whole row; pass two shuffles each bucket with the
built-in Fisher-Yates ``shuffle`` and deals the resulting global order to the shards in turn. Row counts of the shards differ by one at most
(law ``rows``), and the slots of a shard have no gaps.

Copies of one row hash alike, so a row that is repeated beyond a part of a bucket is counted first and its copies are cut into portions with
hashes of their own; the row is then shuffled once a portion and repeated within its bucket.

Defined results: nulls in any column hash like a value of their own; equal rows are separate rows, each with a slot of its own (0.0 and -0.0 are
equal, and either may stand for both in a row that is cut into portions); an empty table gives an empty result; further columns are carried
along, and columns named ``shard`` or ``slot`` are replaced. A column of maps raises, as Spark can't hash it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.llm.common import documents, shuffle_partitions

#: Buckets in one group of the two-level running sum.
GROUP = 1024
#: Copies of one row that take more than this share of a bucket are cut into portions of that size.
PORTIONS = 8


def _single(rows: DataFrame) -> DataFrame:
    return rows.select("__h", "__row", F.lit(0).cast("long").alias("__part"), F.lit(1).cast("int").alias("__n"))


def _portions(rows: DataFrame, portion: int) -> DataFrame:
    """A row for each ``portion`` bytes of the copies of a row, with the number of copies in it; a row of its own where one is larger."""
    each = F.greatest(F.lit(1), F.expr(f"{portion} div __bytes"))
    counted = rows.groupBy("__h", "__row", "__bytes").agg(F.count(F.lit(1)).alias("__all")).withColumn("__each", each)
    parts = counted.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(__all - 1) div __each"))))
    return parts.select("__h", "__row", "__part", F.least(F.col("__each"), F.col("__all") - F.col("__part") * F.col("__each")).cast("int").alias("__n"))


def _offsets(counts: DataFrame) -> DataFrame:
    """Start of each bucket in the global order: a running sum in two levels, so that no task sees more than GROUP buckets or 1/GROUP of them."""
    counts = counts.withColumn("__hi", F.expr(f"__bucket div {GROUP}"))
    low = Window.partitionBy("__hi").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn("__before", F.coalesce(F.sum("__n").over(low), F.lit(0)))
    upper = Window.orderBy("__hi").rowsBetween(Window.unboundedPreceding, -1)
    outer = counts.groupBy("__hi").agg(F.sum("__n").alias("__n")).select("__hi", F.coalesce(F.sum("__n").over(upper), F.lit(0)).alias("__base"))
    return inner.join(outer, "__hi").select("__bucket", (F.col("__before") + F.col("__base")).alias("__start"))


def shard_rows(df: DataFrame, n_shards: int = 8, seed: int = 42, bucket_bytes: int = 32 << 20, row_bytes: int = 128) -> DataFrame:
    """``df`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 within the shard) added, in a seeded random order.

    ``bucket_bytes`` bounds what one bucket holds in memory; the bytes of string and binary columns count besides ``row_bytes`` a row.
    """
    spark, names = df.sparkSession, [c for c in df.columns if c not in ("shard", "slot")]
    wide = [c for c, kind in df.dtypes if kind in ("string", "binary") and c in names]
    volume = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in wide), F.lit(row_bytes).cast("long"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), volume.alias("__bytes"))
    rows = rows.withColumn("__h", F.xxhash64(F.lit(seed + 1), "__row"))
    copies = rows.groupBy("__h").agg(F.count(F.lit(1)).alias("__n"), F.sum("__bytes").alias("__v"))
    total, most = copies.agg(F.sum("__v"), F.max(F.when(F.col("__n") > 1, F.col("__v")))).first()
    buckets = max(4 * shuffle_partitions(spark), -(-(total or 0) // bucket_bytes))

    # Pass one: scatter. Equal texts have different ids and so part; the hash is of the whole row and the number of its portion.
    portion = max(1, bucket_bytes // PORTIONS)
    if (most or 0) > portion:
        often = copies.where((F.col("__n") > 1) & (F.col("__v") > portion)).select("__h")
        parted = _portions(rows.join(often, "__h", "left_semi"), portion).unionByName(_single(rows.join(often, "__h", "left_anti")))
        repeated = lambda items: F.flatten(F.transform(items, lambda x: F.array_repeat(x, x["n"])))
    else:
        parted, repeated = _single(rows), lambda items: items
    scattered = parted.withColumn("__bucket", F.pmod(F.xxhash64("__row", F.lit(seed), "__part"), F.lit(buckets)))
    item = F.struct(F.col("__h").alias("h"), F.col("__row").alias("r"), F.col("__n").alias("n"))
    grouped = scattered.groupBy("__bucket").agg(F.collect_list(item).alias("__rows"))
    # Pass two: sorted first, so that the Fisher-Yates shuffle starts from the same order in every attempt of a task.
    # Buckets too are in a fixed order within a task, as they draw from one seeded generator in turn.
    shuffled = grouped.sortWithinPartitions("__bucket").select("__bucket", F.shuffle(repeated(F.sort_array("__rows")), seed).alias("__rows"))
    starts = _offsets(scattered.groupBy("__bucket").agg(F.sum("__n").alias("__n")))
    dealt = shuffled.join(starts, "__bucket").select("__start", F.posexplode("__rows").alias("__at", "__item"))
    place = F.col("__start") + F.col("__at")
    return dealt.select(
        *[F.col(f"__item.r.`{c}`").alias(c) for c in names],
        F.pmod(place, F.lit(n_shards)).cast("int").alias("shard"),
        F.expr(f"(__start + __at) div {n_shards}").cast("long").alias("slot"),
    )


def write_shards(df: DataFrame, path: str, n_shards: int = 8, seed: int = 42) -> None:
    """Shard ``df`` and write one folder a shard, each file sorted by slot."""
    placed = shard_rows(df, n_shards, seed)
    placed.repartition(F.col("shard"), F.expr("slot div 100000")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and checksum of each text where the shuffle has put it: whole documents are dealt."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = (F.octet_length(raw) + F.lit(1)).cast("long").alias("size")
    placed = shard_rows(documents(spark, sf_dir), 8)
    return placed.select("doc_id", size, F.crc32(raw).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op10_sharding": op10_sharding}
ORACLE: dict[str, str] = {}
