"""How far a log has been read, as state: next offset, replays and gaps of every partition.

The state is one bitmap for each block of ``BLOCK`` offsets of a partition. Tasks set the bits of their own
rows first and exchange bitmaps, so neither a busy partition nor a long one is one group. It takes one bit
a message and does not depend on the order of arrival. A batch writes the blocks it has touched into a
folder of its own, which it replaces when it is run again; the state itself is in the checkpoint, so a
batch that is run again counts nothing twice. Rows without a topic, partition or offset hold no place in a log
and are passed over, as are offsets below 0; a message that comes again is a replay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordhaul.operators.once import evaluate_once
from recordhaul.session import matches
from recordhaul.streaming.sync import COMMIT_INTERVAL

# Fixed value: the bits that Spark's bitmap functions hold in one bitmap.
BLOCK = 32_768

PARTITION = ["topic", "partition"]
BLOCKS = "topic string, partition int, block bigint, seen binary, rows bigint, batch_id bigint"


def offset_blocks(messages: DataFrame) -> DataFrame:
    """``topic, partition, block, seen, rows``: a bitmap of the offsets in each block, and the messages read.

    The same for a table and for a stream, where it is the state.
    """
    placed = messages.select("topic", "partition", F.col("offset").cast("bigint").alias("offset"))
    placed = placed.filter(
        F.col("topic").isNotNull() & F.col("partition").isNotNull() & (F.col("offset") >= 0)
    )
    # Spark numbers the bits of a bitmap from 1.
    place = F.col("offset") + 1
    return placed.groupBy(
        *PARTITION, (F.bitmap_bucket_number(place) - 1).alias("block")
    ).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("seen"),
        F.count(F.lit(1)).alias("rows"),
    )


def run_offsets(
    messages: DataFrame,
    root: str,
    checkpoint: str | None = None,
    continuous: bool = False,
    interval: str = COMMIT_INTERVAL,
) -> StreamingQuery:
    """Follow a log; stops by itself at its end unless ``continuous``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/blocks/batch_id={batch_id}")

    writer = offset_blocks(messages).writeStream.outputMode("update").foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint or f"{root}/checkpoint")
    if continuous:
        writer = writer.trigger(processingTime=interval)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_blocks(spark: SparkSession, root: str) -> DataFrame:
    """The newest state of every block, of committed batches; none if there is none yet."""
    done = [path.removesuffix("/_SUCCESS") for path in matches(spark, f"{root}/blocks/batch_id=*/_SUCCESS")]
    if not done:
        return spark.createDataFrame([], BLOCKS).drop("batch_id")
    told = spark.read.schema(BLOCKS).option("basePath", f"{root}/blocks").parquet(*done)
    newest = F.max_by(F.struct("seen", "rows"), "batch_id").alias("newest")
    return told.groupBy(*PARTITION, "block").agg(newest).select(*PARTITION, "block", "newest.*")


def _positions(seen: Column) -> Column:
    """The set bits of a bitmap, in order; of a byte only its bits are looked at if it has any."""

    def of_byte(n: Column) -> Column:
        byte = F.conv(F.hex(F.substring(seen, n + 1, F.lit(1))), 16, 10).cast("int")
        bits = [F.when(byte.bitwiseAND(F.lit(1 << bit)) != 0, n * 8 + bit) for bit in range(8)]
        return F.array_compact(F.array(*bits))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BLOCK // 8 - 1)), of_byte))


def offset_runs(blocks: DataFrame) -> DataFrame:
    """``topic, partition, first, last``: the runs of offsets read without a gap, block by block.

    Runs that meet at the end of a block are not joined. A full block is one run and is not unpacked.
    """
    full = F.bitmap_count("seen") == BLOCK
    whole = F.array(F.struct(F.lit(0).alias("first"), F.lit(BLOCK - 1).alias("last")))
    spread = blocks.select(
        *PARTITION, "block", full.alias("full"), F.when(~full, _positions(F.col("seen"))).alias("at")
    )
    spread = evaluate_once(spread, ["full", "at"])
    starts = F.filter("at", lambda x, i: (i == 0) | (F.get("at", i - 1) < x - 1))
    ends = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) > x + 1))
    paired = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    runs = spread.select(*PARTITION, "block", F.inline(F.when(F.col("full"), whole).otherwise(paired)))
    base = F.col("block") * BLOCK
    return runs.select(*PARTITION, (base + F.col("first")).alias("first"), (base + F.col("last")).alias("last"))


def offset_progress(blocks: DataFrame) -> DataFrame:
    """One row a partition: first and next offset, messages, replays among them, offsets missing in between."""
    seen = F.bitmap_count("seen")
    ends = _ends(blocks)
    return ends.groupBy(*PARTITION).agg(
        F.min("first").alias("first_offset"),
        (F.max("last") + 1).alias("next_offset"),
        F.sum("rows").alias("messages"),
        F.sum(F.col("rows") - seen).alias("replays"),
        (F.max("last") + 1 - F.min("first") - F.sum(seen)).alias("missing"),
    )


def _ends(blocks: DataFrame) -> DataFrame:
    """Blocks with the first and last offset set in them, found by their first and last byte that is not 0."""
    text = F.hex("seen")
    zeros = F.length(text) - F.length(F.ltrim(text, F.lit("0")))
    left = F.length(F.rtrim(text, F.lit("0"))) - 1

    def byte(digit: Column) -> Column:
        return F.conv(F.hex(F.substring("seen", F.floor(digit / 2).cast("int") + 1, F.lit(1))), 16, 10)

    def bit(value: Column, lowest: bool) -> Column:
        order = range(8) if lowest else range(7, -1, -1)
        number = value.cast("int")
        return F.coalesce(
            *[F.when(number.bitwiseAND(F.lit(1 << n)) != 0, F.lit(n)) for n in order]
        )

    def place(digit: Column, lowest: bool) -> Column:
        return F.col("block") * BLOCK + F.floor(digit / 2) * 8 + bit(byte(digit), lowest)

    return blocks.withColumn("first", place(zeros, True)).withColumn("last", place(left, False))


def offset_gaps(blocks: DataFrame) -> DataFrame:
    """``topic, partition, first_missing, last_missing``: offsets not read between two that were.

    Only the ends of runs are sorted, a few for a block of a log without many holes.
    """
    order = Window.partitionBy(*PARTITION).orderBy("first")
    before = offset_runs(blocks).withColumn("before", F.lag("last").over(order))
    gaps = before.filter(F.col("first") > F.col("before") + 1)
    return gaps.select(
        *PARTITION, (F.col("before") + 1).alias("first_missing"), (F.col("first") - 1).alias("last_missing")
    )
