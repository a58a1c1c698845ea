"""Log lines in the formats of ``sources.logs``, rendered from the ``events`` table.

Each event becomes one or more lines, so the logs grow with the table. Columns are those of
``read_lines``; a block covers ``LINES_PER_BLOCK`` events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


LINES_PER_BLOCK = 1000


def _place(file):
    return [
        file.alias("file"),
        F.floor(F.col("event_id") / LINES_PER_BLOCK).alias("block"),
        F.col("event_id").alias("line_id"),
    ]


def pidstat_lines(events: DataFrame) -> DataFrame:
    """``value`` as %CPU; sign-ups run under the load generator, errors are unreadable lines."""
    file = F.format_string("run/cpu_%d.log", F.col("user_id") % 6 + 2)
    command = F.when(F.col("event_type") == "signup", "load_generator").otherwise(
        F.concat(F.lit("server --"), F.col("event_type"))
    )
    sample = F.concat_ws(
        "  ",
        F.date_format("ts", "HH:mm:ss a"),
        F.lit("1000"),
        F.col("event_id"),
        F.col("user_id"),
        F.col("event_id") % 40,
        F.lit("0.00"),
        F.lit("0.50"),
        F.col("value").cast("string"),
        F.col("user_id") % 8,
        command,
    )
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("Average:  "), F.col("props"))).otherwise(sample)
    return events.select(*_place(file), F.concat(line, F.lit("  ")).alias("line"))


def iostat_lines(events: DataFrame) -> DataFrame:
    """Views and clicks give CPU rows, purchases and sign-ups device rows, errors the headers."""
    file = F.format_string("run/system_log_%d_.log", F.col("user_id") % 6 + 2)
    value = F.col("value").cast("string")
    cpu = F.concat(F.lit("           1.00    0.00    0.50    0.25    0.00   "), value)
    device = F.concat(
        F.lit("sda  "),
        F.concat_ws("  ", F.col("user_id"), F.lit("2.5"), *[F.lit("0.00")] * 4, F.col("event_id") % 9),
        F.lit("  "),
        F.concat_ws("  ", *[F.lit("0.00")] * 14),
        F.lit("   "),
        value,
    )
    header = F.when(F.col("user_id") % 2 == 0, "avg-cpu:  %user   %nice %system %iowait  %steal   %idle").otherwise(
        F.concat(F.lit("Device  "), F.array_join(F.array_repeat(F.lit("x/s"), 22), "  "))
    )
    kind = F.col("event_type")
    line = F.when(kind.isin("view", "click"), cpu).when(kind == "error", header).otherwise(device)
    return events.select(*_place(file), line.alias("line"))


def report_lines(events: DataFrame, insert_format: bool = False) -> DataFrame:
    """One run report per event; the reports of a user form a file."""
    value = F.col("value").cast("string")
    threads = (F.col("event_id") % 12 + 1).cast("string")
    if insert_format:
        lines = [
            F.concat(F.lit("Number of Threads: "), threads),
            F.concat(F.lit("Throughput: "), F.col("user_id").cast("string"), F.lit(" req/sec")),
            F.concat(F.lit("Avg latency: "), value, F.lit(" ms")),
        ]
    else:
        lines = [
            F.concat(F.lit("Number of threads: "), threads),
            F.concat(F.lit("Total requests made: "), (F.col("event_id") * 3 + 1).cast("string")),
            F.concat(F.lit("Total requests completed: "), (F.col("event_id") * 3).cast("string")),
            F.concat(F.lit("Throughput: "), value, F.lit(" req/sec")),
            F.concat(F.lit("Avg response time: "), F.col("user_id").cast("string"), F.lit(".25 ms")),
        ]
    frame = [F.lit("========= RESULTS ========="), *lines, F.lit("")]
    file = F.format_string("run/user_%d.txt", F.col("user_id"))
    return events.select(*_place(file)[:2], "event_id", F.posexplode(F.array(*frame))).select(
        "file", "block", (F.col("event_id") * 10 + F.col("pos")).alias("line_id"), F.col("col").alias("line")
    )
