"""Sharding by extendible hashing: a directory over hash-prefix bits, split only where a shard is too large.

Native plans only: the rows' bytes are summed by key, then by prefix, and a
shard is the shortest prefix whose rows fit the limit while no shorter prefix
does. That is the state that bucket-by-bucket splitting ends in, whatever the
order of insertion, so it needs no loop over buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioscan.llm.common import SPARING, discard, materialise, prefix_bits, small

#: Hash bits that a directory may use.
BITS = 60


def _prefix(bits: Column, depth: Column) -> Column:
    """The first `depth` of BITS bits, as a number."""
    return F.call_function("shiftright", bits, (F.lit(BITS) - depth).cast("int"))


def directory(sized: DataFrame, limit_bytes: int) -> DataFrame:
    """depth, prefix, shard_bytes of all shards, from rows of (bits, n_bytes) by key.

    Sums go down from a depth at which shards are expected to fit; prefixes
    that still don't fit there go deeper in strides, over their own rows only.
    """
    spark = sized.sparkSession
    found, rest, start = None, sized, 0
    total, keys = sized.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.count("*")).first()
    stride = max(4, (total // limit_bytes).bit_length() + 4)
    while keys:
        end = min(BITS, start + stride)
        # one row for each prefix at the deepest level, then its ancestors
        deep = rest.groupBy(_prefix(F.col("bits"), F.lit(end)).alias("p")).agg(F.sum("n_bytes").alias("n"), F.count("*").alias("k"))
        levels = deep.select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("depth"), "p", "n", "k")
        up = (F.lit(end) - F.col("depth")).cast("int")
        sums = levels.groupBy("depth", F.call_function("shiftright", F.col("p"), up).alias("prefix")).agg(F.sum("n").alias("shard_bytes"), F.sum("k").alias("keys"))
        sums = materialise(sums, "prefixes")
        large = sums.where((F.col("shard_bytes") > limit_bytes) & (F.col("keys") > 1))
        if start == 0:
            roots = sums.where("depth = 0")
            fits = sums.where((F.col("shard_bytes") <= limit_bytes) | (F.col("keys") == 1))
        else:
            roots = None
            fits = sums.where(((F.col("shard_bytes") <= limit_bytes) | (F.col("keys") == 1)) & (F.col("depth") > start))
        # a shard is a prefix that fits below one that doesn't
        parents = large.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
        below = fits.withColumn("up", F.call_function("shiftright", F.col("prefix"), F.lit(1))).join(parents, ["depth", "up"], "left_semi").drop("up")
        level = below if roots is None else below.unionByName(roots.where((F.col("shard_bytes") <= limit_bytes) | (F.col("keys") == 1)))
        if end == BITS:
            level = level.unionByName(large.where(F.col("depth") == BITS))
        level = level.select("depth", "prefix", "shard_bytes")
        found = level if found is None else found.unionByName(level)
        if end == BITS:
            break
        open_ = large.where(F.col("depth") == end).select(F.col("prefix").alias("p"))
        if open_.isEmpty():
            break
        rest = materialise(rest.withColumn("p", _prefix(F.col("bits"), F.lit(end))).join(small(open_, **SPARING), "p", "left_semi").drop("p"), "open")
        start = end
        stride = 8
    return materialise(found, "directory") if found is not None else spark.createDataFrame([], "depth int, prefix long, shard_bytes long")


def shards(docs: DataFrame, limit_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, depth, shard, part.

    shard is the bucket's hash prefix as a string of `depth` bits ("" for an
    undivided table). No bucket holds more than limit_bytes unless all its
    rows share one id, which no hash bit can split: such a bucket is divided
    into parts of at most limit_bytes (part is 0 elsewhere, and where one row
    has all of the bytes; its numbers may have gaps), and only a single row
    above the limit exceeds it. A
    null text has 0 bytes; null ids hash as the empty string; an empty table
    gives an empty one.
    """
    placed = _placed(materialise(_numbered(docs, id_col, text_col), "sizes"), ["doc_id", "n_bytes", "depth"], limit_bytes)
    return placed.select("doc_id", "n_bytes", "depth", "shard", "part")


def _numbered(docs: DataFrame, id_col: str, text_col: str, *kept: Column) -> DataFrame:
    """doc_id, n_bytes, bits, row and kept of each row; the number is drawn once, so it must be written before it is used."""
    key = F.col(f"`{id_col}`").cast("long")
    n_bytes = F.coalesce(F.octet_length(F.col(f"`{text_col}`").cast("string")), F.lit(0)).cast("long")
    return docs.select(key.alias("doc_id"), n_bytes.alias("n_bytes"), prefix_bits(F.coalesce(key.cast("string"), F.lit(""))).alias("bits"), F.monotonically_increasing_id().alias("row"), *kept)


def _placed(rows: DataFrame, kept: list[str], limit_bytes: int) -> DataFrame:
    """kept, shard and part of each of the numbered rows."""
    found = directory(rows.groupBy("bits").agg(F.sum("n_bytes").alias("n_bytes")), limit_bytes)
    depths = [r[0] for r in found.select("depth").distinct().collect()]
    # at most BITS + 1 depths; each row tries them by an equality join on (depth, prefix)
    tries = F.explode(F.array(*[F.struct(F.lit(d).cast("int").alias("depth"), _prefix(F.col("bits"), F.lit(d)).alias("prefix")) for d in sorted(depths)])) if depths else F.explode(F.array(F.struct(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"))))
    own = [c for c in rows.columns if c != "bits"]
    placed = rows.select(*own, tries.alias("t")).select(*own, "t.depth", "t.prefix").join(small(found, **SPARING), ["depth", "prefix"])
    # F.bin drops leading zeros
    shard = F.when(F.col("depth") == 0, "").otherwise(F.substring(F.lpad(F.bin("prefix"), BITS, "0"), BITS + 1 - F.col("depth"), F.col("depth")))
    whole = placed.where(F.col("shard_bytes") <= limit_bytes).select(*kept, shard.alias("shard"), F.lit(0).cast("long").alias("part"))
    # rows of one id: dealt by their numbers into about half a limit each, so that no task gets them all
    half = max(1, limit_bytes // 2)
    deals = F.greatest(F.ceil(F.col("shard_bytes") / half), F.lit(1)).cast("long")
    single = placed.where(F.col("shard_bytes") > limit_bytes).withColumn("deals", deals).withColumn("deal", F.pmod(F.xxhash64("row"), F.col("deals")))
    order = Window.partitionBy("depth", "prefix", "deal").orderBy("n_bytes", "row")
    before = F.sum("n_bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_bytes")
    # small rows that start in one half share a part, larger ones are parts of their own
    at = F.when(F.col("n_bytes") <= half, 2 * F.floor(before / half)).otherwise(2 * F.row_number().over(order) + 1)
    # a row with all of its bucket's bytes leaves nothing to divide; those without any fit in with it
    whole_row = (F.col("n_bytes") == F.col("shard_bytes")) | (F.col("n_bytes") == 0)
    part = F.when(whole_row, 0).otherwise(F.col("deal") + F.col("deals") * F.col("at"))
    over = single.withColumn("at", at).select(*kept, shard.alias("shard"), part.cast("long").alias("part"))
    return whole.unionByName(over)


def write_shards(docs: DataFrame, path: str, limit_bytes: int = 256 << 20, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write docs, each row once, with shard and part as partition folders _fs_shard and _fs_part; each is one task's."""
    rows = materialise(_numbered(docs, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all")), "rows")
    at = _placed(rows, ["all"], limit_bytes).select("all.*", F.col("shard").alias("_fs_shard"), F.col("part").alias("_fs_part"))
    at.repartition("_fs_shard", "_fs_part").write.partitionBy("_fs_shard", "_fs_part").parquet(path)
    discard(rows)
