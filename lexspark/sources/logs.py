"""Readers and summaries for process, disk and run logs.

``lines`` means ``(file, block, line_id, line)``. ``block`` numbers the parts in which Spark reads a
file (their byte offset) and ``line_id`` grows within a part, so (block, line_id) is the order of the
lines without reading a file in one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexspark.operators.quantiles import exact_quantiles
from lexspark.session import materialise

# Log formats and thread-count file names.
PIDSTAT_LINE = (
    r"^(\S+\s+\S+)\s+(\d+)\s+(\d+)\s+([\d.]+)\s+([\d.]+)\s+([\d.]+)\s+([\d.]+)\s+([\d.]+)\s+(\d+)\s+(.+)$"
)
CPU_LOG_NAME = r"cpu_(\d+)\.log"
DISK_LOG_NAME = r"system_log_(\d+)_"
CPU_ROW_FIELDS = 6
DEVICE_ROW_FIELDS = 23
DEVICE_FIELDS = {
    "r_s": 1, "rkb_s": 2, "r_await": 5, "w_s": 7, "wkb_s": 8, "w_await": 11, "aqu_sz": 21, "util": 22,
}
SEARCH_REPORT = {
    "threads": (r"Number of threads:\s*(\d+)", "int"),
    "throughput": (r"Throughput:\s*([\d.]+)\s*req/sec", "double"),
    "avg_latency_ms": (r"Avg response time:\s*([\d.]+)\s*ms", "double"),
    "requests_made": (r"Total requests made:\s*(\d+)", "bigint"),
    "requests_completed": (r"Total requests completed:\s*(\d+)", "bigint"),
}
INSERT_REPORT = {
    "threads": (r"Number of Threads:\s*(\d+)", "int"),
    "throughput": (r"Throughput:\s*([\d.]+)", "double"),
    "avg_latency_ms": (r"Avg latency:\s*([\d.]+)", "double"),
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )


def threads_from_name(file: Column, pattern: str) -> Column:
    return F.regexp_extract(file, pattern, 1).cast("int")


def pidstat_samples(lines: DataFrame, targets: tuple[str, ...] = ("server", "load_generator")) -> DataFrame:
    """One row per sample and target whose name occurs in the command; other lines are skipped."""
    line = F.regexp_replace("line", r"\s+$", "")
    fields = lines.filter(line.rlike(PIDSTAT_LINE)).select("file", F.split(line, r"\s+", 11).alias("f"))
    numbers = ["usr", "system", "guest", "wait", "cpu"]
    samples = fields.select(
        "file",
        F.concat_ws(" ", F.col("f")[0], F.col("f")[1]).alias("timestamp"),
        F.col("f")[2].cast("bigint").alias("uid"),
        F.col("f")[3].cast("bigint").alias("pid"),
        *[F.col("f")[4 + i].cast("double").alias(name) for i, name in enumerate(numbers)],
        F.col("f")[9].cast("int").alias("core"),
        F.col("f")[10].alias("cmd"),
    )
    matching = F.filter(F.array(*[F.lit(t) for t in targets]), lambda t: F.col("cmd").contains(t))
    # The outer form keeps the optimiser from adding a size check that parses the line again.
    return samples.select("*", F.explode_outer(matching).alias("target")).filter(F.col("target").isNotNull())


def pidstat_summary(lines: DataFrame, target: str = "server") -> DataFrame:
    """CPU summary per file and command of one target, with the thread count of the file."""
    parsed = pidstat_samples(lines, (target,)).select("file", "cmd", "cpu", "usr", "system")
    samples = materialise(parsed, "pidstat-samples")
    keys = ["file", "cmd"]
    totals = samples.groupBy(*keys).agg(
        F.max("cpu").alias("max_cpu"),
        F.avg("cpu").alias("mean_cpu"),
        F.avg("usr").alias("avg_usr"),
        F.avg("system").alias("avg_sys"),
    )
    medians = exact_quantiles(samples, keys, "cpu", {"median_cpu": 0.5})
    summary = totals.join(medians, keys).withColumn("threads", threads_from_name(F.col("file"), CPU_LOG_NAME))
    return summary.orderBy("threads", "cmd")


def iostat_rows(lines: DataFrame, num_samples: int | None = None) -> DataFrame:
    """The CPU rows and device rows of every file; with ``num_samples`` the first so many of each kind.

    ``kind`` is ``cpu`` (six fields, the last is %idle) or ``disk`` (a device row).
    """
    text = F.trim(F.translate(F.col("line"), "\t\n\x0b\f\r", " " * 5))

    def parsed(f: Column) -> Column:
        head = F.get(f, F.lit(0))
        kind = F.when(~head.startswith("avg-cpu:") & (F.size(f) == CPU_ROW_FIELDS), "cpu").when(
            ~head.startswith("avg-cpu:") & ~head.startswith("Device") & (F.size(f) >= DEVICE_ROW_FIELDS), "disk"
        )
        is_cpu, is_disk = kind == "cpu", kind == "disk"
        return F.struct(
            kind.alias("kind"),
            F.when(is_cpu, F.get(f, F.lit(5)).cast("double")).alias("idle"),
            F.when(is_disk, head).alias("device"),
            *[F.when(is_disk, F.get(f, F.lit(i)).cast("double")).alias(name) for name, i in DEVICE_FIELDS.items()],
        )

    # Split once per line: the fields are a lambda variable, and no filter is pushed below an explode.
    once = F.transform(F.array(F.split(text, " +")), parsed)
    rows = lines.select("file", "block", "line_id", F.explode_outer(once).alias("r")).filter("r.kind IS NOT NULL")
    flat = rows.select("file", "block", "line_id", "r.*")
    if num_samples is None:
        return flat.drop("block", "line_id")
    # The rank is limited before the shuffle, so no task gets more than the samples of a file part.
    in_order = Window.partitionBy("file", "kind").orderBy("block", "line_id")
    ranked = flat.withColumn("sample", F.row_number().over(in_order)).filter(F.col("sample") <= num_samples)
    return ranked.drop("block", "line_id")


def iostat_summary(lines: DataFrame, num_samples: int | None = None) -> DataFrame:
    """Idle and disk-utilisation summary per file, over all rows or the first ``num_samples`` of each kind."""
    rows = materialise(iostat_rows(lines, num_samples).select("file", "idle", "util"), "iostat-rows")
    totals = rows.groupBy("file").agg(
        F.count("idle").alias("cpu_samples"),
        F.avg("idle").alias("cpu_avg_idle"),
        F.max("idle").alias("cpu_max_idle"),
        F.count("util").alias("disk_samples"),
        F.avg("util").alias("disk_avg_util"),
        F.max("util").alias("disk_max_util"),
    )
    measured = F.stack(F.lit(2), F.lit("cpu"), F.col("idle"), F.lit("disk"), F.col("util"))
    values = rows.select("file", measured.alias("kind", "value"))
    at95 = exact_quantiles(values, ["file", "kind"], "value", {"q": 0.95})
    pivoted = at95.groupBy("file").agg(
        F.max(F.when(F.col("kind") == "cpu", F.col("q"))).alias("cpu_95th_idle"),
        F.max(F.when(F.col("kind") == "disk", F.col("q"))).alias("disk_95th_util"),
    )
    named = totals.join(pivoted, "file", "left")
    return named.withColumn("threads", threads_from_name(F.col("file"), DISK_LOG_NAME)).orderBy("threads")


def occurrence_number(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number the rows of every group in line order, block by block.

    Rows are numbered within a block; the counts of the earlier blocks are added. No window holds
    more than one block of lines or one row per block, and both uses share one shuffle.
    """
    in_block = Window.partitionBy(*keys, "block").orderBy("line_id")
    numbered = df.withColumn("_local", F.row_number().over(in_block))
    by_block = Window.partitionBy(*[f"_{k}" for k in keys]).orderBy("_block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    # All columns take part in the maximum, so this branch reads the very shuffle that numbered the rows.
    last = F.max(F.struct("_local", *[c for c in df.columns if c not in keys])).alias("_last")
    offsets = (
        numbered.groupBy(*[F.col(c).alias(f"_{c}") for c in (*keys, "block")])
        .agg(last)
        .withColumn("_offset", F.coalesce(F.sum("_last._local").over(earlier), F.lit(0)))
        .drop("_last")
    )
    same_block = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, "block")])
    joined = numbered.join(offsets, same_block)
    return joined.select(*df.columns, (F.col("_local") + F.col("_offset")).alias(name))


def run_report(lines: DataFrame, metrics: dict[str, tuple[str, str]] = SEARCH_REPORT) -> DataFrame:
    """``(file, run, <metric>...)``: the k-th occurrences of all metrics make up run k.

    A line counts for the first metric that it matches. A file whose metrics do not occur equally
    often raises an error.
    """
    tried = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.regexp_extract("line", pattern, 1).alias("value"))
            for name, (pattern, _) in metrics.items()
        ]
    )
    first = F.slice(F.filter(tried, lambda m: m.value != ""), 1, 1)
    found = (
        lines.select("file", "block", "line_id", F.explode_outer(first).alias("m"))
        .filter(F.col("m").isNotNull())
        .select("file", "block", "line_id", "m.*")
    )
    runs = occurrence_number(found, ["file", "metric"], "run")
    table = runs.groupBy("file", "run").agg(
        F.count(F.lit(1)).alias("_found"),
        *[
            F.max(F.when(F.col("metric") == name, F.col("value").cast(kind))).alias(name)
            for name, (_, kind) in metrics.items()
        ],
    )
    # In a filter, which no column selection removes.
    complete = (F.col("_found") == len(metrics)) | F.raise_error(
        F.concat(F.lit("metrics do not occur equally often in "), F.col("file"))
    ).cast("boolean")
    return table.filter(complete).withColumn("run", F.col("run").cast("bigint")).drop("_found")


def run_metrics(
    requests: DataFrame, duration_sec: float, run_col: str = "run", latency_col: str = "latency_ms", ok_col: str = "ok"
) -> DataFrame:
    """Requests made and completed, completed per second and mean latency of the completed."""
    ok = F.col(ok_col)
    return requests.groupBy(run_col).agg(
        F.count(F.lit(1)).alias("requests_made"),
        F.count_if(ok).alias("requests_completed"),
        (F.count_if(ok) / F.lit(float(duration_sec))).alias("throughput"),
        (F.coalesce(F.sum(F.when(ok, F.col(latency_col))), F.lit(0.0)) / F.greatest(F.count_if(ok), F.lit(1))).alias(
            "avg_latency_ms"
        ),
    )


def run_metrics_whole_ms(
    requests: DataFrame, duration_sec: int, run_col: str = "run", latency_col: str = "latency_ms", ok_col: str = "ok"
) -> DataFrame:
    """Only completed requests, whole milliseconds per request and whole requests per second."""
    ok = F.col(ok_col)
    whole = F.when(ok, F.floor(F.col(latency_col)))
    return requests.groupBy(run_col).agg(
        F.count_if(ok).alias("requests"),
        F.floor(F.count_if(ok) / F.lit(int(duration_sec))).alias("throughput"),
        F.coalesce(F.sum(whole) / F.nullif(F.count_if(ok), F.lit(0)), F.lit(0.0)).alias("avg_latency_ms"),
    )
