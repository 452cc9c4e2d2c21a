"""Dedupe over batches and restarts, barrier with timers, attempts and dead letters, digests and guards of commits."""

from __future__ import annotations

import json
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strandlake.streaming import attempts, commits, state


def put(folder, name, rows):
    Path(folder).mkdir(exist_ok=True)
    aside = Path(folder, f".{name}")
    aside.write_text("".join(json.dumps(x) + "\n" for x in rows))
    aside.rename(Path(folder, name))


MESSAGES = "job string, target long, body string"


def run_dedupe(spark, base):
    stream = spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).json(f"file://{base}/in")
    out = state.distinct_messages(stream, ["job", "target"], ["body"])
    write = out.writeStream.option("checkpointLocation", f"file://{base}/check").format("parquet").option("path", f"file://{base}/out")
    write.trigger(availableNow=True).start().awaitTermination(120)
    return [tuple(r) for r in spark.read.parquet(f"file://{base}/out").select("job", "target", "body", "kind").collect()]


def test_messages_are_delivered_once_over_restarts(spark, tmp_path):
    """Each start is a new query on the same checkpoint, as after a failure; files repeat what was sent before."""
    message = lambda j, t, b: {"job": j, "target": t, "body": b}
    put(tmp_path / "in", "1.json", [message("a", 1, "x")] * 50 + [message("a", 2, "y"), message("b", 1, "x")])
    assert sorted(run_dedupe(spark, tmp_path)) == [("a", 1, "x", "first"), ("a", 2, "y", "first"), ("b", 1, "x", "first")]
    put(tmp_path / "in", "2.json", [message("a", 1, "x"), message("a", 2, "other"), message("c", 1, None)])
    time.sleep(0.1)
    put(tmp_path / "in", "3.json", [message("a", 2, "other"), message("a", 2, "y"), message("a", 2, "third"), message("c", 1, None)])
    got = run_dedupe(spark, tmp_path)
    assert sorted(got, key=repr) == sorted([("a", 1, "x", "first"), ("a", 2, "y", "first"), ("b", 1, "x", "first"), ("a", 2, "other", "conflict"), ("a", 2, "third", "conflict"), ("c", 1, None, "first")], key=repr)
    assert run_dedupe(spark, tmp_path) == got


def test_conflict_within_a_batch(spark, tmp_path):
    put(tmp_path / "in", "1.json", [{"job": "a", "target": 1, "body": b} for b in "pqrpq"])
    got = run_dedupe(spark, tmp_path)
    assert sorted(x[2] for x in got) == ["p", "q", "r"]
    assert sorted(x[3] for x in got) == ["conflict", "conflict", "first"]


MARKERS = "batch_id long, part int, expected int"


def barrier_run(spark, base, **k):
    stream = spark.readStream.schema(MARKERS).option("maxFilesPerTrigger", 1).json(f"file://{base}/in")
    return state.barrier(stream, **k).writeStream.option("checkpointLocation", f"file://{base}/check").format("parquet").option("path", f"file://{base}/out")


def test_barrier_of_shuffled_and_repeated_parts(spark, tmp_path):
    g = random.Random(3)
    marks = [(b, p, 5 + b) for b in range(6) for p in range(5 + b)] * 2 + [(20, 0, 1), (21, 0, 2), (22, 0, 3), (22, 2, 3), (23, 7, 3), (23, 0, 4), (24, 0, 70), (24, 69, 70)]
    g.shuffle(marks)
    for k in range(4):
        put(tmp_path / "in", f"{k}.json", [dict(zip(("batch_id", "part", "expected"), m, strict=True)) for m in marks[k::4]])
    for _ in range(2):
        barrier_run(spark, tmp_path).trigger(availableNow=True).start().awaitTermination(120)
    rows = [tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()]
    assert sorted(r[0] for r in rows if r[1] == "ready") == [0, 1, 2, 3, 4, 5, 20]
    assert {r[0] for r in rows if r[1] == "misfit"} == {23}
    put(tmp_path / "in", "late.json", [{"batch_id": 22, "part": 1, "expected": 3}, {"batch_id": 0, "part": 1, "expected": 5}, *({"batch_id": 24, "part": k, "expected": 70} for k in range(70))])
    barrier_run(spark, tmp_path).trigger(availableNow=True).start().awaitTermination(120)
    rows = [tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()]
    assert sorted(r[0] for r in rows if r[1] == "ready") == [0, 1, 2, 3, 4, 5, 20, 22, 24]


def test_timer_names_stragglers(spark, tmp_path):
    mark = lambda b, p, n: {"batch_id": b, "part": p, "expected": n}
    put(tmp_path / "in", "1.json", [mark(1, 0, 3), mark(1, 2, 3), mark(2, 0, 1)])
    q = barrier_run(spark, tmp_path, wait_ms=500).trigger(processingTime="200 milliseconds").start()

    def rows():
        try:
            return {tuple(map(str, r)) for r in spark.read.schema("batch_id long, status string, expected int, missing array<int>").parquet(f"file://{tmp_path}/out").collect()}
        except Exception as missing:
            assert "PATH_NOT_FOUND" in str(missing)
            return set()

    def until(row):
        end = time.time() + 60
        while row not in rows() and time.time() < end:
            time.sleep(0.5)
        assert row in rows()

    try:
        until(("2", "ready", "1", "[]"))
        put(tmp_path / "in", "2.json", [mark(9, 0, 1)])
        until(("1", "waiting", "3", "[1]"))
        put(tmp_path / "in", "3.json", [mark(1, 1, 3)])
        until(("1", "ready", "3", "[]"))
    finally:
        q.stop()
    assert sum(r[1] == "waiting" for r in rows()) == 1


def test_attempts(spark, tmp_path):
    """Message k fails k times; what breaks a rule is never tried; clocks are given."""
    ledger = attempts.Ledger(f"file://{tmp_path}/ledger", base_seconds=100)
    tried = F.when(F.col("need") >= F.col("attempt"), F.concat(F.lit("fails "), F.col("attempt").cast("string")))
    handler = lambda rows: rows.withColumn("error", tried)
    messages = spark.createDataFrame([(k, k % 5, None if k % 7 == 3 else "b") for k in range(40)], "message_id long, need int, body string")
    rules = {"no_body": F.col("body").isNull()}
    at = lambda t: F.lit(f"2030-01-01 {t}").cast("timestamp")
    done = {}
    for run, (new, now) in enumerate([(messages, "00:00:00"), (messages.limit(0), "00:00:49"), (messages.limit(0), "00:01:41"), (messages.limit(0), "00:01:41"), (messages.limit(0), "01:00:00"), (messages.limit(0), "23:00:00")]):
        done[run] = sorted(r.message_id for r in attempts.attempt(new, ledger, handler, str(run), rules, at(now)).collect())
    sound = [k for k in range(40) if k % 7 != 3]
    assert done == {0: [k for k in sound if k % 5 == 0], 1: [], 2: [k for k in sound if k % 5 == 1], 3: [], 4: [k for k in sound if k % 5 == 2], 5: []}
    dead = {r.message_id: (r.error, r.attempt) for r in attempts.dead_letters(spark, ledger).collect()}
    assert dead == {k: ("no_body", 1) if k % 7 == 3 else ("fails 3", 3) for k in range(40) if k % 7 == 3 or k % 5 > 2}
    assert attempts.waiting(spark, ledger).count() == 0


def test_a_replayed_run_changes_nothing(spark, tmp_path):
    ledger = attempts.Ledger(f"file://{tmp_path}/ledger", base_seconds=0)
    handler = attempts.caught(lambda row: 1 / (row["attempt"] - 1) if row["message_id"] == 1 else None)
    messages = spark.createDataFrame([(1, "a"), (2, "b")], "message_id long, body string")
    now = lambda h: F.lit(f"2030-01-01 {h:02d}:00:00").cast("timestamp")
    for _ in range(2):
        assert [r.message_id for r in attempts.attempt(messages, ledger, handler, "0", now=now(0)).collect()] == [2]
    for _ in range(2):
        assert [tuple(r) for r in attempts.attempt(messages.limit(0), ledger, handler, "1", now=now(1)).collect()] == [(1, "a")]
    rows = sorted((r.message_id, r.attempt, r.status, r.error) for r in ledger.outcomes(spark).collect())
    assert rows == [(1, 1, "retry", "ZeroDivisionError: division by zero"), (1, 2, "done", None), (2, 1, "done", None)]


def test_waits_grow_and_are_spread(spark):
    ledger = attempts.Ledger("x", base_seconds=10, longest_seconds=50)
    rows = spark.range(200).withColumnRenamed("id", "message_id").withColumn("attempt", F.explode(F.array(*map(F.lit, range(1, 6)))))
    for r in rows.groupBy("attempt").agg(F.min(ledger.wait(F.col("attempt"))).alias("a"), F.max(ledger.wait(F.col("attempt"))).alias("b"), F.countDistinct(ledger.wait(F.col("attempt"))).alias("n")).collect():
        full = min(10 * 2 ** (r.attempt - 1), 50)
        assert full / 2 <= r.a < full * 0.55
        assert full * 0.95 < r.b <= full
        assert r.n > 190


def test_a_bad_batch_stops_nothing(spark, tmp_path):
    row = lambda j, b, m, s: {"job_id": j, "batch_id": b, "message_id": m, "score": s}
    schema = "job_id long, batch_id string, message_id long, score double"
    inbox = tmp_path / "in"
    put(inbox, "1.json", [row(1, "x", 1, 5.0), row(1, "x", 2, -3.0), row(2, "y", 3, 7.0), row(4, "w", 9, 66.0)])
    ledger = attempts.Ledger(f"file://{tmp_path}/ledger")

    def run():
        commits.stream_commits(
            spark.readStream.schema(schema).json(f"file://{inbox}"), f"file://{tmp_path}/rows", f"file://{tmp_path}/guard", f"file://{tmp_path}/check", quarantine=f"file://{tmp_path}/aside",
            ledger=ledger, rules={"negative": F.col("score") < 0}, handler=lambda d: d.withColumn("error", F.when(F.col("score") == 66, "no room")),
        ).awaitTermination()
        return {(r.job_id, r.batch_id, r.score) for r in spark.read.parquet(f"file://{tmp_path}/rows").collect()}

    assert run() == {(1, "x", 5.0), (2, "y", 7.0)}
    put(inbox, "2.json", [row(2, "y", 4, 8.0), row(3, "z", 5, 1.0)])
    assert run() == {(1, "x", 5.0), (2, "y", 7.0), (3, "z", 1.0)}
    assert [(r.job_id, r.score, r.reason) for r in spark.read.parquet(f"file://{tmp_path}/aside").collect()] == [(2, 8.0, "other_contents")]
    assert [(r.message_id, r.error) for r in attempts.dead_letters(spark, ledger).collect()] == [(2, "negative")]
    assert [(r.message_id, r.attempt) for r in attempts.waiting(spark, ledger).collect()] == [(9, 2)]


def test_digest_of_a_batch(spark):
    rows = [(1, "x", k % 3, 1.5 * k) for k in range(10)]
    schema = "job_id long, batch_id string, target_id int, score double"
    of = lambda r: commits.batch_digest(spark.createDataFrame(r, schema).repartition(3), ("job_id", "batch_id")).first().digest
    assert of(rows) == of(rows[::-1])
    assert len({of(rows), of(rows[1:]), of(rows + rows[:1]), of(rows + rows[:2] * 2), of([*rows[:-1], (1, "x", 0, 99.0)])}) == 5
    plan = commits.batch_digest(spark.createDataFrame(rows, schema), ("job_id", "batch_id"))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_guard_of_the_jobs_at_hand_alone_is_read(spark, tmp_path):
    path, guard = f"file://{tmp_path}/rows", f"file://{tmp_path}/guard"
    for job in range(6):
        commits.commit_batch(spark.createDataFrame([(job, "b", 1.0)], "job_id long, batch_id string, score double"), path, guard)
    folders = [p.name for p in Path(tmp_path, "guard").glob("shard=*")]
    assert len(folders) > 3
    with pytest.raises(ValueError, match="other contents"):
        commits.commit_batch(spark.createDataFrame([(3, "b", 2.0)], "job_id long, batch_id string, score double"), path, guard)
    assert spark.read.parquet(path).agg(F.sum("score")).first()[0] == 6.0


def test_barrier_of_many_batches_calls_few_groups(spark, tmp_path):
    """Twenty thousand batches: a call a shard and not a call a batch, and each ready once."""
    marks = spark.range(60_000).select((F.col("id") % 20_000).alias("batch_id"), F.floor(F.col("id") / 20_000).cast("int").alias("part"), F.lit(3).alias("expected")).where("batch_id % 7 > 0 OR part < 2")
    marks.repartition(4).write.json(f"file://{tmp_path}/in")
    began = time.time()
    barrier_run(spark, tmp_path).trigger(availableNow=True).start().awaitTermination(300)
    took = time.time() - began
    got = [r.batch_id for r in spark.read.parquet(f"file://{tmp_path}/out").where("status = 'ready'").collect()]
    assert sorted(got) == [b for b in range(20_000) if b % 7]
    assert took < 60
    calls = state.barrier(spark.readStream.schema(MARKERS).json(f"file://{tmp_path}/in"))
    assert "shard" in calls._jdf.queryExecution().analyzed().toString()
