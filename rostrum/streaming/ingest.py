"""Incremental ingest beyond the batch operators: file streams, scopes and results per batch, turns over ordered cues, resumable work, windows with late data."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rostrum.operators.sync import upsert
from rostrum.sinks.export import write_scopes


def file_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def ingest_scopes(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], table: str, scope: list[str], checkpoint: str) -> StreamingQuery:
    """Runs `transform` on all rows so far of the scopes in each batch, and replaces these scopes.

    The stream has the scope's columns. Rows are kept beside the checkpoint by
    batch, so that a scope whose files fall into several batches is whole, and a
    batch that runs again gives the same table. An empty batch changes nothing.
    """
    kept = f"{checkpoint.rstrip('/')}-rows"

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        df.write.mode("overwrite").parquet(f"{kept}/batch={number}")
        mine = spark.read.schema(df.schema).parquet(f"{kept}/batch={number}").select(*scope).distinct()
        seen = spark.read.schema(df.schema).option("basePath", kept).parquet(kept).select(*df.columns)
        out = transform(seen.join(mine, scope, "left_semi"))
        if not out.isEmpty():
            write_scopes(out, table, scope)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def import_results(stream: DataFrame, table: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Puts results in place by their keys as they arrive; a result that comes again overwrites, of several in one batch the greatest in column order holds.

    Each batch writes a version of the table from the one before it, so that
    readers (`latest_results`) and a batch that runs again see whole versions.
    """
    rest = [c for c in stream.columns if c not in keys]

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        incoming = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("x")).select(*keys, "x.*")
        before = spark.read.parquet(f"{table}/version={number - 1}") if number else spark.createDataFrame([], df.schema)
        upsert(before.select(*df.columns), incoming.select(*df.columns), keys).write.mode("overwrite").parquet(f"{table}/version={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_results(spark: SparkSession, table: str) -> DataFrame:
    rows = spark.read.option("basePath", table).parquet(table)
    newest = rows.agg(F.max("version")).first()[0]
    return rows.filter(F.col("version") == newest).drop("version")


TURNS = "transcript_id bigint, first_seq bigint, last_seq bigint, speaker_code string, text string, late boolean"
_OPEN = "speaker_code string, first_seq bigint, last_seq bigint, text string"


def _carry_turns(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames)).drop_duplicates("seq").sort_values("seq")
    who, first, last, said = state.get if state.exists else (None, None, None, "")
    out: list[tuple] = []
    done = False
    for row in rows.itertuples():
        if last is not None and row.seq <= last:
            out.append((key[0], row.seq, row.seq, row.speaker_code if isinstance(row.speaker_code, str) else None, row.text, True))
            continue
        speaker = row.speaker_code if isinstance(row.speaker_code, str) else who
        if first is not None and speaker != who:
            out.append((key[0], first, last, who, said, False))
            first, said = None, ""
        first = row.seq if first is None else first
        who, last, said = speaker, row.seq, f"{said} {row.text or ''}".strip()
        done |= bool(row.final)
    if done and first is not None:
        out.append((key[0], first, last, who, said, False))
        state.remove()
    elif first is not None:
        state.update((who, int(first), int(last), said))
    yield pd.DataFrame(out, columns=[c.split()[0] for c in TURNS.split(", ")])


def stream_turns(cues: DataFrame) -> DataFrame:
    """Turns of cues as they arrive (transcript_id, seq, speaker_code, text, final), with the open turn of each transcript carried as state.

    A cue without a speaker goes on with the one before. A turn comes out when the
    next begins, the last one with the cue that is `final`. A cue that arrives
    after later ones were taken is a turn of its own, marked late. A cue that comes
    again within a batch counts once.
    """
    rows = cues.select(F.col("transcript_id").cast("bigint"), F.col("seq").cast("bigint"), "speaker_code", "text", "final").filter("transcript_id is not null and seq is not null")
    return rows.groupBy("transcript_id").applyInPandasWithState(_carry_turns, TURNS, _OPEN, "append", GroupStateTimeout.NoTimeout)


def work_off(work: DataFrame, keys: list[str], process: Callable[[DataFrame], DataFrame], done: str, each: int = 1_000, stop: Callable[[], bool] = lambda: False) -> int:
    """Processes rows that are not yet in the table `done`, `each` at a time in order of their keys, until none is left or `stop` says so; returns the number of steps.

    A step writes its results, with the keys, before the next begins, so that work
    that was broken off is resumed where it stopped. `process` keeps every key.
    """
    spark, steps = work.sparkSession, 0
    while not stop():
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(done)
        known = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        left = work.join(spark.read.parquet(done).select(*keys).distinct(), keys, "left_anti") if known else work
        step = left.orderBy(*keys).limit(each)
        if step.isEmpty():
            break
        process(step).write.mode("append").parquet(done)
        steps += 1
    return steps


def windowed_counts(events: DataFrame, time: str, key: str, length: str = "10 minutes", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Events per key and window; rows later than `late` are dropped by the watermark of a stream."""
    rows = events.withWatermark(time, late)
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return rows.groupBy(window.alias("w"), key).agg(F.count("*").alias("events")).select(F.col("w.start").alias("window_start"), key, "events")


def sessions(events: DataFrame, time: str, key: str, gap: str = "5 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of a key: events less than `gap` apart."""
    rows = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("events"))
    return rows.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")
