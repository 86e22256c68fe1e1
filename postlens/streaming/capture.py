"""Capture: route raw messages, track keywords, write rolling JSON files.

Runs the same on a batch DataFrame of raw lines and on a stream from
``spark.readStream.text(...)``::

    readStream -> route -> status only -> keyword filter -> rolling text files

Routing looks at the raw text, first marker wins: ``in_reply_to_status``
(a status), ``delete``, ``limit``, ``warning``; anything else is ignored.
Notices are parsed only for their few fields.
"""

from __future__ import annotations

import time as _time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import check_words, col_of, keyword_pattern
from .rolling import RollingSink

KINDS = ("status", "delete", "limit", "warning", "ignored")


def route_messages(df: DataFrame, col: str = "value", out: str = "kind") -> DataFrame:
    v = col_of(col)
    kind = (F.when(v.contains(K.ROUTE_STATUS), F.lit("status"))
            .when(v.contains(K.ROUTE_DELETE), F.lit("delete"))
            .when(v.contains(K.ROUTE_LIMIT), F.lit("limit"))
            .when(v.contains(K.ROUTE_WARNING), F.lit("warning"))
            .otherwise(F.lit("ignored")))
    return df.withColumn(out, kind)


def _parsed(v):
    return F.try_parse_json(v)


def delete_notices(df: DataFrame, col: str = "value", kind: str = "kind") -> DataFrame:
    """``(status_id, user_id)`` of delete notices, by a single parse."""
    j = F.from_json(col_of(col), "delete struct<status:struct<id:bigint,user_id:bigint>>")
    return df.filter(F.col(kind) == "delete").select(j.alias("_j")).select(
        F.col("_j.delete.status.id").alias("status_id"), F.col("_j.delete.status.user_id").alias("user_id"))


def missed_counter(df: DataFrame, col: str = "value", kind: str = "kind") -> DataFrame:
    """Posts withheld by the source: the counter is cumulative, so the
    latest (largest) value is the total; also the number of notices."""
    j = _parsed(col_of(col))
    t = F.try_variant_get(j, "$.limit.track", "bigint")
    return df.filter(F.col(kind) == "limit").agg(F.max(t).alias("missed"), F.count(F.lit(1)).alias("n_notices"))


def warning_messages(df: DataFrame, col: str = "value", kind: str = "kind") -> DataFrame:
    """Warning text (``warning.message``, falling back to ``warnings.message``)."""
    j = _parsed(col_of(col))
    msg = F.coalesce(F.try_variant_get(j, "$.warning.message", "string"),
                     F.try_variant_get(j, "$.warnings.message", "string"))
    return df.filter(F.col(kind) == "warning").withColumn("message", msg)


STATUS_TEXT = ("struct<text:string,extended_tweet:struct<full_text:string>,"
               "retweeted_status:struct<text:string,extended_tweet:struct<full_text:string>>>")


def status_texts(col: str = "value"):
    """The text fields of a raw status as one array, by a single parse."""
    s = F.from_json(col_of(col), STATUS_TEXT)
    return F.transform(F.array(s), lambda x: F.array(
        x["text"], x["extended_tweet"]["full_text"], x["retweeted_status"]["text"],
        x["retweeted_status"]["extended_tweet"]["full_text"]))[0]


def capture_frame(df: DataFrame, words, col: str = "value") -> DataFrame:
    """Status messages whose text holds a tracked word (case-insensitive,
    whole word). An empty word list keeps nothing."""
    check_words(words)
    routed = route_messages(df, col, "_kind").filter(F.col("_kind") == "status").drop("_kind")
    pat = keyword_pattern(words)
    if pat is None:
        return routed.filter(F.lit(False))
    return routed.filter(F.exists(status_texts(col), lambda t: F.coalesce(t.rlike(pat), F.lit(False))))


def messages_from_events(events: DataFrame) -> DataFrame:
    """Raw capture-style messages derived from event rows (one per event):
    views are statuses, errors delete notices, signups limit notices,
    purchases warnings and clicks unrelated messages."""
    eid, uid = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    et = F.col("event_type")
    digits = F.regexp_replace(F.col("props"), "[^0-9]", "")
    msg = (F.when(et == "view", F.concat(F.lit('{"id":'), eid, F.lit(',"in_reply_to_status_id":null,"text":"view k'),
                                         digits, F.lit(" by user"), uid, F.lit('"}')))
           .when(et == "error", F.concat(F.lit('{"delete":{"status":{"id":'), eid, F.lit(',"user_id":'), uid,
                                         F.lit("}}}")))
           .when(et == "signup", F.concat(F.lit('{"limit":{"track":'), uid, F.lit("}}")))
           .when(et == "purchase", F.concat(F.lit('{"warning":{"code":"FALLING_BEHIND","message":"queue '),
                                            uid, F.lit('"}}')))
           .otherwise(F.concat(F.lit('{"event":"'), et, F.lit('","id":'), eid, F.lit("}"))))
    return events.select(F.col("event_id").alias("id"), msg.alias("value"))


def capture_paths(out_dir: str, prefix: str = "streamer", run: str = "*") -> list[str]:
    """Path list of captured files for ``read_posts(path_list=...)``: all runs, or one."""
    return [f"{out_dir.rstrip('/')}/prefix={prefix}/run={run}/file=*/*.txt"]


def start_capture(spark: SparkSession, source_dir: str, out_dir: str, words, checkpoint: str,
                  prefix: str = "streamer", max_records: int = K.RECORDS_PER_FILE, nb: int | None = None,
                  timeout_hours: float | None = None, available_now: bool = False, run: str | None = None,
                  every: str | None = None):
    """Start the capture as a Structured Streaming query.

    * raw lines from ``source_dir`` (text source; any source giving ``value``
      works the same) -> status messages holding a tracked word -> text files
      ``out_dir/prefix=<prefix>/run=<run>/file=<prefix>_<time>_<number>/``, closed
      at ``max_records`` lines, over as many batches as it takes (0 or less: one
      file a task and batch). ``run`` is by default the checkpoint's name, so a
      resumed query goes on in its own folder, in the file left open.
    * ``every``: trigger interval (such as ``"1 minute"``).
    * ``nb`` > 0 keeps exactly ``nb`` statuses over all restarts, by the running
      number of each line (see ``rolling``). The call then waits and stops the
      query once they are written.
    * ``timeout_hours``: the caller waits that long, then the query stops.
    * progress lives in ``checkpoint``, so a restarted query resumes where it
      stopped (counts included).
    Returns the ``StreamingQuery``.
    """
    stream = spark.readStream.format("text").load(source_dir)
    kept = capture_frame(stream, words, "value").select("value")
    run = run or checkpoint.rstrip("/").rpartition("/")[2]
    sink = RollingSink(spark, f"{out_dir.rstrip('/')}/prefix={prefix}/run={run}", f"{checkpoint.rstrip('/')}/rolling", prefix, max_records, nb)
    w = kept.writeStream.foreachBatch(sink.step).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif every:
        w = w.trigger(processingTime=every)
    q = w.start()
    deadline = None if timeout_hours is None else _time.time() + timeout_hours * 3600
    while q.isActive and (sink.nb is not None or deadline is not None) and not available_now:
        if deadline is not None and _time.time() >= deadline or sink.full():
            q.stop()
            break
        wait = 1.0 if deadline is None else min(1.0, max(0.1, deadline - _time.time()))
        q.awaitTermination(wait)
    return q


def notice_stream(spark: SparkSession, source_dir: str):
    """Streaming delete/limit/warning notices (for a side table or console)."""
    routed = route_messages(spark.readStream.format("text").load(source_dir), "value", "kind")
    return routed.filter(F.col("kind").isin("delete", "limit", "warning"))


def write_notices(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, available_now: bool = False):
    """Parsed notices as a Parquet side table under ``out_dir/notices``: (kind, status_id, user_id,
    missed, message), partitioned by kind. Append-only; totals are aggregates over the table."""
    n = notice_stream(spark, source_dir)
    j = F.from_json(F.col("value"), "delete struct<status:struct<id:bigint,user_id:bigint>>, limit struct<track:bigint>, "
                                    "warning struct<message:string>, warnings struct<message:string>")
    rows = n.select("kind", j.alias("_j")).select(
        "kind", F.col("_j.delete.status.id").alias("status_id"), F.col("_j.delete.status.user_id").alias("user_id"),
        F.col("_j.limit.track").alias("missed"), F.coalesce("_j.warning.message", "_j.warnings.message").alias("message"))
    w = rows.writeStream.format("parquet").partitionBy("kind").outputMode("append")
    w = w.option("checkpointLocation", checkpoint).option("path", f"{out_dir.rstrip('/')}/notices")
    return (w.trigger(availableNow=True) if available_now else w).start()


def feature_stream(posts: DataFrame, prepare, out_dir: str, checkpoint: str, available_now: bool = False):
    """Runs the batch chain ``prepare`` (such as sentiment or the gazetteer) on every micro-batch of the
    stream ``posts`` and writes each batch to its own folder, so a repeated batch replaces itself."""
    def step(batch: DataFrame, number: int) -> None:
        prepare(batch).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={number}")

    w = posts.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
