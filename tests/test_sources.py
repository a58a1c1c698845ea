import json
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.operators.quantiles import exact_quantiles
from lexspark.sources import generate, logs
from lexspark.sources.json_docs import decode_documents, read_json_documents


def test_json_bodies(spark, tmp_path):
    bodies = [
        ('{"text":"a b"}', "a b", "accepted"),
        ('{"text":5}', None, "not_a_string"),
        ('{"text":null}', None, "not_a_string"),
        ("{}", "", "no_tokens"),
        ('{"text":""}', "", "no_tokens"),
        ('{"text":"the of"}', "the of", "no_tokens"),
        ("[1]", None, "not_an_object"),
        ('"text"', None, "not_an_object"),
        ("bad", None, "malformed"),
        ('{"text":"x"', None, "malformed"),
        ('{"text":["x"]}', None, "not_a_string"),
        ('{"text":"caf\\u00e9 \\n new","n":1}', "café \n new", "accepted"),
    ]
    (tmp_path / "in.json").write_text("\n".join(b for b, _, _ in bodies))
    rows = decode_documents(read_json_documents(spark, str(tmp_path))).collect()
    assert {r.body: (r.text, r.status) for r in rows} == {b: (t, s) for b, t, s in bodies}


# -- logs ------------------------------------------------------------------------------------------

PIDSTAT = """Linux 6.5.0 (host) \t10/01/25 \t_x86_64_\t(8 CPU)

10:00:01 PM   UID       PID    %usr %system  %guest   %wait    %CPU   CPU  Command
10:00:02 PM  1000      4321   10.00    5.00    0.00    0.50   15.00     0  server
10:00:03 PM  1000      4321   20.00    5.00    0.00    0.50   25.00     0  server
10:00:03 PM  1000      4322    1.00    1.00    0.00    0.00    2.00     1  load_generator
10:00:04 PM  1000      4321   30.00    8.00    0.00    0.50   38.00     0  server
10:00:04 PM  1000      4400    3.00    0.00    0.00    0.00    3.00     2  load_generator server x
Average:     1000      4321   20.00    6.00    0.00    0.50   26.00     -  server
"""


def test_pidstat(spark, tmp_path):
    (tmp_path / "cpu_4.log").write_text(PIDSTAT)
    lines = logs.read_lines(spark, str(tmp_path))
    samples = logs.pidstat_samples(lines)
    assert {r.target: r.n for r in samples.groupBy("target").agg(F.count("*").alias("n")).collect()} == {
        "server": 4,
        "load_generator": 2,
    }
    first = samples.filter("cpu = 15").collect()[0]
    assert (first.timestamp, first.uid, first.pid, first.usr, first.core, first.cmd) == (
        "10:00:02 PM", 1000, 4321, 10.0, 0, "server",
    )
    summary = {r.cmd: r for r in logs.pidstat_summary(lines).collect()}
    assert set(summary) == {"server", "load_generator server x"}
    server = summary["server"]
    assert (server.threads, server.max_cpu, server.median_cpu) == (4, 38.0, 25.0)
    assert server.mean_cpu == pytest.approx(26.0) and server.avg_usr == pytest.approx(20.0)
    assert server.avg_sys == pytest.approx(6.0)


def iostat_text(values):
    parts = ["Linux 6.5.0 (host) 10/01/25 _x86_64_ (8 CPU)"]
    for i, v in enumerate(values):
        parts += [
            "",
            "avg-cpu:  %user   %nice %system %iowait  %steal   %idle",
            f"           1.00    0.00    0.50    0.25    0.00   {v}",
            "",
            "Device " + " ".join(["x"] * 22),
            "sda " + " ".join(str(x) for x in [i, 2.5, 0, 0, 0.5, 0, 7, 8.5, 0, 0, 1.25, *[0] * 9, 0.75, v / 2]),
        ]
    return "\n".join(parts)


def test_iostat(spark, tmp_path):
    values = [10.0 + (i * 37 % 50) for i in range(40)]
    (tmp_path / "system_log_8_.log").write_text(iostat_text(values))
    lines = logs.read_lines(spark, str(tmp_path))
    device = logs.iostat_rows(lines, 360).filter("kind = 'disk' AND sample = 4").collect()[0]
    assert (device.device, device.r_s, device.w_s, device.aqu_sz) == ("sda", 3.0, 7.0, 0.75)
    row = logs.iostat_summary(lines, num_samples=25).collect()[0]
    head = values[:25]
    assert (row.threads, row.cpu_samples, row.disk_samples) == (8, 25, 25)
    assert row.cpu_avg_idle == pytest.approx(np.mean(head)) and row.cpu_max_idle == max(head)
    assert row.cpu_95th_idle == pytest.approx(np.percentile(head, 95))
    assert row.disk_95th_util == pytest.approx(np.percentile(head, 95) / 2)


def report(runs):
    return "\n".join(
        f"Experiment {i}\n\n===== RESULTS =====\nNumber of threads: {t}\nTotal requests made: {n}\n"
        f"Total requests completed: {n - 1}\nThroughput: {x} req/sec\nAvg response time: {y} ms\n====\n"
        for i, (t, n, x, y) in enumerate(runs)
    )


def test_run_report_over_many_file_parts(spark, tmp_path):
    runs = [(i % 12, 1000 + i, i + 0.5, i / 4) for i in range(300)]
    (tmp_path / "stats.txt").write_text(report(runs))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = logs.read_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 5
        rows = logs.run_report(lines).orderBy("run").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.run, r.threads, r.requests_made, r.throughput, r.avg_latency_ms) for r in rows] == [
        (i + 1, t, n, x, y) for i, (t, n, x, y) in enumerate(runs)
    ]


def test_run_report_of_inserts_and_unequal_counts(spark, tmp_path):
    (tmp_path / "post.txt").write_text(
        "Number of Threads: 2\nTotal requests: 9\nThroughput: 167 req/sec\nAvg latency: 11.5 ms\n"
        "Number of Threads: 4\nThroughput: 225 req/sec\nAvg latency: 17.25 ms\n"
    )
    rows = logs.run_report(logs.read_lines(spark, str(tmp_path)), logs.INSERT_REPORT).orderBy("run").collect()
    assert [(r.threads, r.throughput, r.avg_latency_ms) for r in rows] == [(2, 167.0, 11.5), (4, 225.0, 17.25)]
    (tmp_path / "post.txt").write_text("Number of Threads: 2\nThroughput: 167 req/sec\n")
    with pytest.raises(Exception, match="equally often"):
        logs.run_report(logs.read_lines(spark, str(tmp_path)), logs.INSERT_REPORT).collect()
    with pytest.raises(Exception, match="equally often"):
        logs.run_report(logs.read_lines(spark, str(tmp_path)), logs.INSERT_REPORT).select("threads").collect()


def test_run_metrics(spark):
    rows = [("a", 1.75, True), ("a", 2.5, True), ("a", 99.0, False), ("b", 5.0, False)]
    requests = spark.createDataFrame(rows, "run string, latency_ms double, ok boolean")
    exact = {r.run: r for r in logs.run_metrics(requests, 4).collect()}
    assert (exact["a"].requests_made, exact["a"].requests_completed, exact["a"].throughput) == (3, 2, 0.5)
    assert exact["a"].avg_latency_ms == pytest.approx(2.125) and exact["b"].avg_latency_ms == 0.0
    whole = {r.run: r for r in logs.run_metrics_whole_ms(requests, 2).collect()}
    assert (whole["a"].requests, whole["a"].throughput, whole["a"].avg_latency_ms) == (2, 1, 1.5)
    assert (whole["b"].requests, whole["b"].throughput, whole["b"].avg_latency_ms) == (0, 0, 0.0)


def test_quantiles_of_uneven_groups(spark):
    rng = np.random.default_rng(3)
    groups = {
        "constant": [5.0] * 50,
        "one": [2.0],
        "two": [1.0, 2.0],
        "spread": list(np.round(rng.exponential(10, 3000), 2)),
        "outlier": list(rng.normal(0, 1, 500)) + [1e9],
        "copies": [1.0] * 900 + [7.0] * 100,
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("one", None)]
    result = exact_quantiles(
        spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"q05": 0.05, "q50": 0.5, "q95": 0.95, "top": 1.0}
    )
    for r in result.collect():
        want = np.percentile(groups[r.g], [5, 50, 95, 100])
        assert [r.q05, r.q50, r.q95, r.top] == pytest.approx(list(want)), r.g
    assert result.filter("g = 'spread'").first().q50 == pytest.approx(statistics.median(groups["spread"]))


def test_one_outlier_does_not_gather_the_other_values(spark):
    """Values are dealt out by rank, so no range holds most of them, however they are distributed."""
    from lexspark.operators.ordered import ranged

    rows = spark.range(20_000).select(F.lit("g").alias("g"), (1 + F.col("id") / 20_000).alias("v"))
    rows = rows.union(spark.createDataFrame([("g", 1e300)], "g string, v double"))
    sizes = [r["count"] for r in ranged(rows, "g", ["v"], "ranges").groupBy("_range").count().collect()]
    assert max(sizes) < 2 * sum(sizes) / 4
    median = exact_quantiles(rows, ["g"], "v", {"q": 0.5}).first()["q"]
    assert median == pytest.approx(1.5)


def test_iostat_over_all_and_first_rows(spark, tmp_path):
    cpu = "".join(f"1.0 0.0 0.5 0.2 0.0 {i}\n" for i in range(1, 401))
    (tmp_path / "system_log_4_.log").write_text("avg-cpu: %user\n" + cpu)
    lines = logs.read_lines(spark, str(tmp_path))
    every, first = logs.iostat_summary(lines).first(), logs.iostat_summary(lines, 360).first()
    assert (every.cpu_samples, every.cpu_max_idle, every.threads, every.disk_95th_util) == (400, 400.0, 4, None)
    assert (first.cpu_samples, first.cpu_max_idle) == (360, 360.0)
    assert every.cpu_95th_idle == pytest.approx(np.percentile(range(1, 401), 95))


# -- generators --------------------------------------------------------------------------------------


def test_generated_words(spark):
    docs = generate.generate_word_documents(spark.range(3000).withColumnRenamed("id", "doc_id"), seed=7)
    texts = {r.doc_id: r.text for r in docs.collect()}
    popular = [t for t in texts.values() if t.split()[0] in generate.POPULAR_WORDS]
    assert all(len(t.split()) == 35 and t.endswith(" ") for t in texts.values())
    assert all(w.startswith("gibberish_") for t in texts.values() for w in t.split()[2:])
    assert 0.07 < len(popular) / 3000 < 0.13
    again = generate.generate_word_documents(spark.range(3000).withColumnRenamed("id", "doc_id").repartition(3), seed=7)
    assert {r.doc_id: r.text for r in again.collect()} == texts
    other = generate.generate_word_documents(spark.range(3000).withColumnRenamed("id", "doc_id"), seed=8)
    assert {r.doc_id: r.text for r in other.collect()} != texts


def test_generated_characters(spark):
    docs = generate.generate_character_documents(spark.range(200).withColumnRenamed("id", "doc_id"))
    texts = [r.text for r in docs.collect()]
    assert all(len(t) == 1000 for t in texts) and len(set(texts)) == 200
    counts = {c: sum(t.count(c) for t in texts) for c in generate.ALPHABET}
    assert sum(counts.values()) == 200_000
    assert all(abs(n / 200_000 - 1 / 27) < 0.004 for n in counts.values())


def test_all_of_an_id_counts(spark):
    """Ids a fixed distance apart give neither equal texts nor shifted ones."""
    ids = [5, 5 + 2_147_483_647, 5 + (1 << 30), 5 + (1 << 31), 5 + (1 << 45), 6, 7]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    texts = [r.text for r in generate.generate_character_documents(rows).collect()]
    pieces = [{t[i : i + 12] for i in range(len(t) - 12)} for t in texts]
    assert all(a.isdisjoint(b) for i, a in enumerate(pieces) for b in pieces[:i])


def test_generated_queries(spark):
    ids = spark.range(2000).withColumnRenamed("id", "query_id")
    short = {r.text for r in generate.generate_queries(ids, "short_tail").collect()}
    long = {r.text for r in generate.generate_queries(ids, "long_tail").collect()}
    assert short == set(generate.POPULAR_WORDS)
    assert len(long) > 1500 and all(0 <= int(w.removeprefix("word_")) < 10_000 for w in long)
    with pytest.raises(ValueError):
        generate.generate_queries(ids, "no_tail")


def test_payloads_round_trip(spark):
    docs = generate.generate_word_documents(spark.range(5).withColumnRenamed("id", "doc_id"))
    bodies = docs.select(F.to_json(F.struct("text")).alias("body"))
    assert all(json.loads(r.body)["text"] == r.text and r.status == "accepted" for r in decode_documents(bodies).collect())
