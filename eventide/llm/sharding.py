"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows of each partition go to each shard is drawn first: under a
uniform permutation of all rows, that matrix has given margins (partition
sizes and shard sizes) and is otherwise multivariate hypergeometric. Then
every partition permutes its rows and deals them out by its row of the matrix,
the rows are exchanged, and every shard permutes what it got. The result is a
uniform random permutation, cut into shards of exactly the wanted sizes,
although no step ever sees all rows.

The matrix is drawn down a binary tree over the partitions: a node halves its
partitions and draws, shard by shard, how many of its rows the left half gets.
A draw inverts the hypergeometric distribution function at a hashed uniform
number. Everything is a built-in expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import free_name, saved, table

#: Shards of the registered query.
SHARDS = 24
#: Rows that one task orders in the second permutation, about.
BLOCK_ROWS = 250_000
#: Standard deviations on either side of the mode that a draw looks at: what lies beyond
#: has a probability below that of a 64-bit hash collision.
DEVIATIONS = 12


def uniform(*parts) -> Column:
    """A number in [0, 1) hashed from ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0 ** -53)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``marked`` among ``total`` rows are in a draw of ``drawn``, at quantile ``u``.

    Weights of the values are built by their ratio from the first value on, so
    nothing overflows; values beyond ``DEVIATIONS`` standard deviations are left out.
    """
    one, zero = F.lit(1.0), F.lit(0.0)

    def scope(g: Column) -> Column:
        share = g.k / F.greatest(g.n, one)
        spread = F.sqrt(F.greatest(zero, g.d * share * (1 - share) * (g.n - g.d) / F.greatest(g.n - 1, one)))
        mode, reach = F.floor((g.d + 1) * (g.k + 1) / (g.n + 2)), F.ceil(spread * DEVIATIONS) + DEVIATIONS
        low = F.greatest(F.greatest(zero, g.d - (g.n - g.k)).cast("long"), mode - reach)
        high = F.least(F.least(g.d, g.k).cast("long"), mode + reach)
        return F.struct(g.n.alias("n"), g.k.alias("k"), g.d.alias("d"), g.u.alias("u"), low.alias("low"),
                        F.greatest(low, high).alias("high"))

    def after(g: Column, weight: Column, x: Column) -> Column:
        v = x.cast("double")
        return F.when(x < g.high, weight * (g.k - v) * (g.d - v) / ((v + 1) * (g.n - g.k - g.d + v + 1))).otherwise(zero)

    def whole(g: Column) -> Column:
        return F.aggregate(F.sequence(g.low, g.high), F.struct(one.alias("w"), zero.alias("sum")),
                           lambda a, x: F.struct(after(g, a.w, x).alias("w"), (a["sum"] + a.w).alias("sum")),
                           lambda a: a["sum"])

    def pick(g: Column, target: Column) -> Column:
        return F.aggregate(
            F.sequence(g.low, g.high),
            F.struct(one.alias("w"), zero.alias("sum"), g.low.alias("value"), F.lit(False).alias("found")),
            lambda a, x: F.struct(
                after(g, a.w, x).alias("w"), (a["sum"] + a.w).alias("sum"),
                F.when(a.found, a.value).otherwise(x).alias("value"),
                (a.found | (a["sum"] + a.w > target)).alias("found")),
            lambda a: a.value)

    given = F.struct(total.cast("double").alias("n"), marked.cast("double").alias("k"), drawn.cast("double").alias("d"),
                     u.alias("u"))
    return let(given, lambda g: let(scope(g), lambda h: let(h.u * whole(h), lambda target: pick(h, target))))


def halves(node: DataFrame, seed: int) -> DataFrame:
    """Each node as its two halves: ``counts`` of the partitions, ``room`` that each shard has for them."""
    width = F.size("counts").cast("int")
    half = (width / 2).cast("int")
    left = node.select(
        "path", F.slice("counts", F.lit(1), half).alias("lc"), F.slice("counts", half + 1, width - half).alias("rc"), "room")
    left = left.withColumn("n", F.aggregate("lc", F.lit(0).cast("long"), lambda a, x: a + x))
    dealt = F.aggregate(
        F.sequence(F.lit(1), F.size("room")),
        F.struct(F.col("n").alias("need"), F.aggregate("room", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
                 F.array().cast("array<bigint>").alias("out")),
        lambda a, i: _deal(a, F.element_at(F.col("room"), i), uniform(F.lit(seed), F.col("path"), i)),
        lambda a: a.out)
    both = left.withColumn("lroom", dealt).withColumn("rroom", F.zip_with("room", "lroom", lambda a, b: a - b))
    return both.select(F.inline(F.array(
        F.struct((F.col("path") * 2).alias("path"), F.col("lc").alias("counts"), F.col("lroom").alias("room")),
        F.struct((F.col("path") * 2 + 1).alias("path"), F.col("rc").alias("counts"), F.col("rroom").alias("room")))))


def _deal(a: Column, room: Column, u: Column) -> Column:
    """One shard's draw: of ``total`` places left, ``room`` are its own and ``need`` go to the left half."""
    return let(hypergeometric(a.total, room, a.need, u), lambda got: F.struct(
        (a.need - got).alias("need"), (a.total - room).alias("total"), F.array_append(a.out, got).alias("out")))


def communication_matrix(counts: DataFrame, room: Column, seed: int, partitions: int) -> DataFrame:
    """(part, room): how many rows of each partition go to each shard.

    ``counts`` has one row with the array ``counts`` of all partition sizes,
    ``room`` is the array of shard sizes with the same sum. The matrix has
    ``partitions`` rows; tasks share the draws from the sixth level on.
    """
    levels = max(0, math.ceil(math.log2(max(1, partitions))))
    padded = F.concat("counts", F.array_repeat(F.lit(0).cast("long"), 2 ** levels - F.size("counts")))
    node = counts.select(F.lit(1).cast("long").alias("path"), padded.alias("counts"), room.alias("room"))
    for level in range(levels):
        if level == 6:
            node = node.repartition(64, "path")
        node = halves(node, seed)
    return node.select((F.col("path") - 2 ** levels).alias("part"), "room")


def shard(rows: DataFrame, shards: int = SHARDS, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 within the shard).

    Shard sizes differ by at most one row (the first shards have the extra
    ones). Every row is dealt on its own: repeated rows, equal texts and nulls
    are rows like others. The same rows from the same files in the same order
    with the same seed give the same result. Input columns named ``shard`` or
    ``slot`` give way. An empty table gives no rows.

    The rows are first written to the shared folder with the number of the
    partition they came in, which fixes them for every later step and retry.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    part, pos, rank, block = free_name(rows, "part", "pos", "rank", "block")
    staged = saved(rows.select(*[F.col(f"`{c}`") for c in kept], F.spark_partition_id().cast("long").alias(part),
                               F.monotonically_increasing_id().alias(pos)), "staged")
    sizes = staged.groupBy(part).count()
    whole = sizes.agg(F.sum("count").alias("n"), F.max(part).alias("last")).first()
    total, partitions = whole.n or 0, (whole["last"] or 0) + 1
    # one row: the sizes of all partitions in order, empty ones included
    every = rows.sparkSession.range(partitions).withColumnRenamed("id", part).join(sizes, part, "left")
    listed = every.agg(F.array_sort(F.collect_list(F.struct(part, F.coalesce("count", F.lit(0)).alias("n")))).alias("l")).select(
        F.transform("l", lambda x: x.n.cast("long")).alias("counts"))
    room = F.array(*[F.lit(total // shards + (s < total % shards)).cast("long") for s in range(shards)])
    matrix = saved(communication_matrix(listed, room, seed, partitions), "matrix")

    # 1. permute locally, deal out by the matrix
    bounds = F.transform(F.sequence(F.lit(1), F.lit(shards)),
                         lambda s: F.aggregate(F.slice(F.col("room"), F.lit(1), s), F.lit(0).cast("long"), lambda a, x: a + x))
    local = Window.partitionBy(part).orderBy(F.xxhash64(F.lit(seed), F.lit("local"), part, pos), pos)
    dealt = staged.withColumn(rank, F.row_number().over(local)).join(
        matrix.select(F.col("part").alias(part), bounds.alias("bounds")), part).withColumn(
        "shard", F.size(F.filter("bounds", lambda b: b < F.col(rank))).cast("int")).drop("bounds", rank)

    # 2. exchange, permute again: blocks of a shard by the leading bits of a hash, each ordered by all of it
    blocks = max(1, math.ceil(total / shards / block_rows))
    again = F.xxhash64(F.lit(seed), F.lit("again"), part, pos)
    placed = dealt.withColumn(block, F.floor(uniform(F.lit(seed), F.lit("block"), part, pos) * blocks).cast("int"))
    before = Window.partitionBy("shard").orderBy(block)
    starts = placed.groupBy("shard", block).count().withColumn("start", F.sum("count").over(before) - F.col("count")).drop("count")
    within = Window.partitionBy("shard", block).orderBy(again, part, pos)
    slots = placed.withColumn(rank, F.row_number().over(within)).join(starts, ["shard", block])
    return slots.select(*[F.col(f"`{c}`") for c in kept], "shard", (F.col("start") + F.col(rank) - 1).cast("long").alias("slot"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by at most one."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard(rows).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))
