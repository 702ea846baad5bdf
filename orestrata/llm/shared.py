"""What the operators share: cut lineage on shared storage, connected components."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A word of every operator: a run of anything but the space and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def cut(df: DataFrame) -> DataFrame:
    """`df` computed once and kept in the folder that all executors share (`spark.checkpoint.dir`).

    Only a local master without that setting gets a folder of this machine.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base and not context.master.startswith(("local[", "local")) or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(base or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components: a row (node, root) for each node of `links`, root being its smallest node.

    Alternating large-star and small-star rounds. Each groups the links by node and joins the node's smallest
    neighbour back, so that no node's links meet in one task (adaptive execution splits a hot node's join), and
    the number of links never grows. Nulls are no nodes. Ends when all links are stars around their smallest nodes.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    pairs = cut(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    loops = pairs.where("u = v").select("u")
    pairs = pairs.where("u <> v")
    while not _stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    found = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = found.select(F.col("root").alias("node"), "root")
    alone = loops.select(F.col("u").alias("node"), F.col("u").alias("root"))
    return found.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("root").alias("root"))


def _stars(pairs: DataFrame) -> bool:
    """Whether each larger end of the distinct `pairs` (u > v) has one smaller end, which is no pair's larger end."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("above"))
    ends = ends.unionByName(pairs.select(F.col("v").alias("node"), F.lit(0).alias("above")))
    nodes = ends.groupBy("node").agg(F.sum("above").alias("above"), F.count("*").alias("n"))
    return nodes.where("above > 0 and n > 1").agg(F.count("*")).first()[0] == 0


HOT_SHARE = 1000


def hot_join(rows: DataFrame, facts: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Inner join of `rows` with `facts`, one row for each key with `n`, how many of the `total` rows have it; `n` goes.

    Keys of more than one row in HOT_SHARE are fewer than HOT_SHARE, so their facts are broadcast and their rows stay
    where they are. All others are joined by shuffle, where no key is large.
    """
    hot = F.col("n") * HOT_SHARE > total
    few = F.broadcast(facts.where(hot).drop("n"))
    cold = rows.join(F.broadcast(facts.where(hot).select(*keys)), keys, "left_anti")
    return rows.join(few, keys).unionByName(cold.join(facts.where(~hot).drop("n"), keys))


FILTER_BITS = 1 << 25


def key_filter(keys: DataFrame, column: str):
    """A Bloom filter of FILTER_BITS bits over a column of 64-bit hashes: an array of words, 4 MB at any size of `keys`.

    It only spares work: what passes must still be joined with the keys. Where keys are too many for it, more passes.
    """
    import numpy as np

    places = [F.pmod(F.shiftright(column, k * 20), F.lit(FILTER_BITS)) for k in range(2)]
    bits = keys.select(F.explode(F.array(*places)).alias("bit"))
    word = F.floor(F.col("bit") / 64).alias("word")
    mask = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    words = bits.select(word, mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    found = np.zeros(FILTER_BITS // 64, np.uint64)
    found[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    return found


def may_hold(found, keys):
    """Which of the int64 `keys` may be among those of the filter."""
    import numpy as np

    out = np.ones(len(keys), bool)
    for k in range(2):
        bit = (keys >> (k * 20)) & (FILTER_BITS - 1)
        out &= (found[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out
