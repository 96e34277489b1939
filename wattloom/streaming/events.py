"""Event files as a stream: classify each batch and merge it into a partitioned table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import dedupe, rules
from ..session import stage
from ..sources.readers import existing_paths
from ..sources.writers import write_partitioned, write_plain


def merge_into(path: str, schema: T.StructType, keys: Sequence[str], *, order: str, partition: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function; a batch that is run twice changes nothing the second time.

    Late rows for old partitions are merged like all others, as whichever
    partitions a batch touches are rewritten.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        if existing_paths(spark, [path]):
            stored = spark.read.schema(schema).parquet(path)
        else:
            stored = spark.createDataFrame([], schema)
        merged = dedupe.merge_incremental(stored, batch.select(*schema.names), keys, order=order, partition=partition)
        write_partitioned(stage(merged, "merged"), path, partition)  # staged, as what is read is overwritten

    return merge


def classify_stream(spark: SparkSession, source: str, schema: T.StructType | str, rule_table: DataFrame, path: str, checkpoint: str, *, key: Sequence[str], order: str, partition: Sequence[str], fmt: str = "parquet") -> StreamingQuery:
    """Classify what is new in a folder and merge it; ends when all of it is done."""

    def each(batch: DataFrame, number: int) -> None:
        known, _ = rules.split_patterns(rules.load_rules(rule_table))
        found = rules.classify(batch, known, key=key)
        merge_into(path, found.schema, key, order=order, partition=partition)(found, number)

    stream = spark.readStream.schema(schema).format(fmt).load(source)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: The state has one row for each group of keys; a checkpoint goes with the number of groups.
GROUPS = 1024
_UNKNOWN, _NO_TIME = -(1 << 63), -(1 << 62)


def _latest(order: str, late: float):
    """Of each key of a group the time of its latest row, which decides what becomes of the rows that come."""

    def run(_: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)  # a group's rows of one batch
        keys, batch = batch["__key"], batch.drop(columns=["__key", "__group"])
        times = batch[order].astype("datetime64[us]").astype("int64").where(batch[order].notna(), _NO_TIME)
        names, micros = state.get if state.exists else ([], [])
        stored = pd.Series(list(micros), index=pd.Index(list(names), dtype=object), dtype="int64")
        known = pd.Series(stored.reindex(keys, fill_value=_UNKNOWN).to_numpy(), index=batch.index)
        latest = times == times.groupby(keys).transform("max").clip(lower=known)
        passed = known != _UNKNOWN
        too_late = passed & (times < known.where(passed, 0) - int(late * 1_000_000))
        now = pd.concat([stored, times.groupby(keys).max()]).groupby(level=0).max()
        state.update((now.index.tolist(), now.tolist()))
        if (chosen := latest | too_late).any():
            yield batch[chosen].assign(outcome=latest[chosen].map({True: "latest", False: "late"}))

    return run


def latest_events(stream: DataFrame, key: Sequence[str], order: str, *, late: float, groups: int = GROUPS) -> DataFrame:
    """Rows of a stream that are the latest of their key so far, and rows that come too late, told by `outcome`.

    The state store has one time for each key, for as long as the stream lives.  Keys are held in `groups` by
    their hash, so that Python is called for each group of a batch and not for each key; where keys are so many that
    a group's are too much for one row, take more groups, and set the session to keep the state in
    RocksDB.  Rows that are older than their key's latest are dropped, as the latest has
    been passed on; those that are older by more than `late` seconds than what was known before
    their batch are `late` instead of dropped.  Rows of the same time are all passed on: the table's
    merge decides between them.  A row without a time is the oldest.
    """
    kinds = T.StructType([*stream.schema.fields, T.StructField("outcome", T.StringType())])
    name = F.to_json(F.array(*[F.col(f"`{k}`").cast("string") for k in key]))  # a null is a value like others
    held = stream.withColumn("__key", name).withColumn("__group", F.pmod(F.xxhash64("__key"), F.lit(groups)))
    return held.groupBy("__group").applyInPandasWithState(_latest(order, late), kinds, "names array<string>, micros array<long>", "append", GroupStateTimeout.NoTimeout)


def classify_latest_stream(
    spark: SparkSession, source: str, schema: T.StructType | str, rule_table: DataFrame, root: str, *, key: Sequence[str], order: str, partition: Sequence[str], late: float, fmt: str = "parquet", files: int | None = None
) -> StreamingQuery:
    """Classify the latest events of each key as files arrive, and merge them; ends when all of it is done.

    Below root: `events`, a table with the latest event of each key, its regex_id and curated_reason, and
    in their place an error where no rule matches or the type is unknown; it is what one batch
    over all files would make.  `errors` has what was in error when it came and what came
    too late (error `late`), with source_mode, in a partition for each batch, which a
    batch that is run twice writes again.  `wrong_rules` has the rules whose patterns don't
    compile, with the problem; all others are used.  files: most files of a batch.
    """
    known, wrong = rules.split_patterns(rules.load_rules(rule_table))
    known = stage(known, "rules")
    write_plain(wrong, f"{root}/wrong_rules")

    def each(batch: DataFrame, number: int) -> None:
        rows = stage(batch, "batch")  # the state must not be asked twice
        current = rows.where("outcome = 'latest'").drop("outcome")
        found = stage(rules.matched(current, known, key=key), "matched")
        errors = rules.no_match(found).unionByName(rules.unknown_type(current, known))
        judged = rules.first_match(found).unionByName(errors, allowMissingColumns=True)
        merge_into(f"{root}/events", judged.schema, key, order=order, partition=partition)(judged, number)
        late = rows.where("outcome = 'late'").drop("outcome").withColumn("error", F.lit("late"))
        write_partitioned(errors.unionByName(late).withColumns({"source_mode": F.lit("incr"), "batch": F.lit(number)}), f"{root}/errors", ["batch"])

    reader = spark.readStream.schema(schema).format(fmt)
    stream = (reader.option("maxFilesPerTrigger", files) if files else reader).load(source)
    chosen = latest_events(stream, key, order, late=late)
    return chosen.writeStream.foreachBatch(each).outputMode("append").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, *, ts: str, keys: Sequence[str], window: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Events by window and key, with a watermark for late ones; for streams and batches alike."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), *keys).agg(F.count("*").alias("n")).select("w.start", "w.end", *keys, "n")
