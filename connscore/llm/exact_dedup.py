"""Exact deduplication by a stateful stream.

Each row becomes (digest of its normalised text, doc_id, place of its content)
and lands in a table that a structured stream reads.  The stream keeps one
state row per digest in RocksDB, without watermark or expiry: the smallest
identifier, the place of that row's content, the number of rows.  Sums and
minima combine map-side, so a text that a third of the rows hold reaches its
state as one row per task.  The state is then read back as a table.

A hit (a row whose digest is held by another) is believed only after its whole
bytes equal those of the row that the state names; rows that differ go through
again under a digest of the next level until none is left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from connscore.llm import common as C
from connscore.session import scratch_path

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    # a store is closed when its task is done: no open files of idle partitions
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # of an executor, beside the heap and what Python workers of earlier stages hold
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
}

#: Landed rows of one state store.
STORE_ROWS = 200_000

_PLACE = [C.FILE, C.ROW]


def normalised(column: str = "text") -> Column:
    """The text with each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), C.SPACE_RUN, " ")


def _digest(text: Column, level: int, digest_bytes: int) -> Column:
    """Digest of a level; level 0 is plain SHA-256, cut to ``digest_bytes``."""
    salted = text if level == 0 else F.concat(F.lit(f"{level}\x00"), text)
    return F.substring(F.unhex(F.sha2(salted, 256)), 1, digest_bytes)


def start_state_stream(spark: SparkSession, landing: str, checkpoint: str):
    """The stream over landed digest rows; its state lives under ``checkpoint``.

    Started again with the same checkpoint it takes only files that landed
    since, and old digests are still known.  The caller awaits its end.
    """
    schema = f"digest binary, doc_id long, {C.FILE} long, {C.ROW} long, sha string"
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *_PLACE)
    return (spark.readStream.schema(schema).parquet(landing)
            .groupBy("digest").agg(F.min(first).alias("first"), F.count("*").alias("n"))
            .writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def state_stores(spark: SparkSession, rows: int) -> int:
    """Stores for that many landed rows: a core's worth at least, no more than shuffles have partitions."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(most, max(spark.sparkContext.defaultParallelism, math.ceil(rows / STORE_ROWS)))


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The held state: digest, first (identifier and content place), n."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key.digest").alias("digest"),
                        F.col("value.*")).toDF("digest", "first", "n")


def exact_dedup(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    ``docs`` has doc_id and text.  Null texts count as empty, so null, empty
    and no text are one group; a text of white space only equals one space.
    Of equal texts the smallest doc_id stays (null last); of rows with that
    same id the first by place.  An empty table gives an empty result.
    ``digest_bytes`` under 32 makes digests collide (tests).
    """
    return located_dedup(C.located(docs.select("doc_id", "text"), "dedup-docs"), digest_bytes)


def located_dedup(rows: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """``exact_dedup`` of rows that have the place columns of ``common.located``; the result has them too."""
    spark = rows.sparkSession
    todo, done, level = rows, [], 0
    with C.settings(spark, _STATE):
        while todo is not None:
            base = scratch_path(spark, f"dedup-{level}")
            text = normalised()
            landed = todo.select(_digest(text, level, digest_bytes).alias("digest"),
                                 F.col("doc_id").cast("long").alias("doc_id"), *_PLACE,
                                 F.sha2(text, 256).alias("sha"))
            landed.write.parquet(f"{base}/landing")
            landing = spark.read.schema(landed.schema).parquet(f"{base}/landing")
            stores = str(state_stores(spark, landing.count()))
            with C.settings(spark, {"spark.sql.shuffle.partitions": stores}):
                start_state_stream(spark, f"{base}/landing", f"{base}/state").awaitTermination()
            state = C.written(read_state(spark, f"{base}/state"), f"dedup-state-{level}")
            wrong = _differing(todo, state, level, digest_bytes)
            n_wrong = wrong.count()
            if n_wrong:
                fewer = wrong.groupBy("digest").agg(F.count("*").alias("less"))
                state = (state.join(fewer, "digest", "left")
                         .withColumn("n", F.col("n") - F.coalesce("less", F.lit(0))).drop("less"))
                places = wrong.select(*_PLACE)
                landing = landing.join(places, _PLACE, "left_anti")
                todo, level = C.located(
                    todo.select("doc_id", "text", *_PLACE).join(places, _PLACE)
                    .select("doc_id", "text"), "dedup-rest"), level + 1
            else:
                todo = None
            done.append(landing.join(state, "digest").select(
                "doc_id", F.col("first.doc_id").alias("keep_id"),
                F.col("n").cast("long").alias("group_size"),
                ((F.col(C.FILE) == F.col(f"first.{C.FILE}"))
                 & (F.col(C.ROW) == F.col(f"first.{C.ROW}"))).alias("kept"),
                F.col("sha").alias("text_sha256"), *_PLACE))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _differing(rows: DataFrame, state: DataFrame, level: int, digest_bytes: int) -> DataFrame:
    """Rows whose digest is held but whose whole bytes differ from the held row's."""
    held = C.sized_broadcast(state.filter("n > 1").select("digest", "first"))
    text = rows.select(normalised().alias("body"), *_PLACE)
    hits = text.withColumn("digest", _digest(F.col("body"), level, digest_bytes)).join(held, "digest")
    own = ((F.col(C.FILE) == F.col(f"first.{C.FILE}"))
           & (F.col(C.ROW) == F.col(f"first.{C.ROW}")))
    keepers = hits.filter(own).select("digest", F.col("body").alias("held_body"))
    return C.written(hits.filter(~own).join(keepers, "digest")
                     .filter(F.col("body") != F.col("held_body"))
                     .select("digest", *_PLACE), "dedup-differing")


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever those are called.

    Of equal texts (null as empty) the row with the smallest doc_id stays, a
    null id last, the first in place of equal ids.  An empty table stays empty.
    """
    plain, named = C.plain_names(docs, ["doc_id", "text"])
    rows = C.located(plain, "dedup-docs")
    result = located_dedup(rows.select("doc_id", "text", *_PLACE)).filter("kept").select(*_PLACE)
    return named(rows.join(result, _PLACE, "left_semi"))
