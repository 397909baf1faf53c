"""First-seen state and alerts against replays of the same batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gazette.streaming import state

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)


def write_batches(spark, path, schema, batches):
    """One file a batch, in order of its time."""
    import os
    import shutil
    import tempfile

    os.makedirs(path, exist_ok=True)
    for i, rows in enumerate(batches):
        tmp = tempfile.mkdtemp()
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(tmp)
        part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
        at = f"{path}/batch-{i:03d}.parquet"
        shutil.move(f"{tmp}/{part}", at)
        os.utime(at, (1_700_000_000 + i, 1_700_000_000 + i))


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


SEEN = "k string, at timestamp, seq long, data string"


def seen_batches(seed):
    rng = random.Random(seed)
    out = []
    for day in range(0, 75, 3):
        keys = [f"k{rng.randrange(12)}" for _ in range(14)] + ([f"old{day}"] if day < 30 else [])
        out.append([(k, START + DAY * (day - rng.random() * 4), rng.randrange(1_000_000), f"v{rng.randrange(99)}") for k in keys])
    return out


def replay_seen(batches, keep=30, delay=7):
    """(newest change of each key, keys held) by the rules: late records are dropped, timers fire behind the watermark."""
    held, last, newest_at, mark = {}, {}, None, None
    for rows in [*batches, []]:
        late = mark
        by_key = {}
        for k, at, seq, data in rows:
            if late is None or at >= late:
                by_key.setdefault(k, []).append((at, seq, data))
        for k, own in by_key.items():
            first, top = held.get(k, (None, None))
            for r in sorted(own):
                first = r[0] if first is None else min(first, r[0])
                top = r if top is None or r[:2] > top[:2] else top
            held[k] = (first, top)
            last[k] = (first, *top, False)
        for k in [k for k, (_, top) in held.items() if mark is not None and top[0] + keep * DAY <= mark]:
            first, top = held.pop(k)
            last[k] = (first, *top, True)
        newest_at = max([x for x in [newest_at, *[r[1] for r in rows]] if x is not None])
        mark = newest_at - delay * DAY
    return last, held


def rounded(t):
    return t.replace(microsecond=t.microsecond // 1000 * 1000)


def test_first_seen_as_replayed(spark, tmp_path):
    batches = [[(k, rounded(at), s, d) for k, at, s, d in b] for b in seen_batches(1)]
    write_batches(spark, f"{tmp_path}/in", SEEN, batches)
    changes = state.first_seen(stream(spark, f"{tmp_path}/in", SEEN), ["k"], "at", "seq", "data")
    sizes = []
    with state.rocks_state(spark):
        query = changes.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination()
        sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    stored = spark.read.parquet(f"{tmp_path}/out")
    got = {r.k: (r.first_seen, r.at, r.seq, r.data, r.expired) for r in state.newest(stored, ["k"]).collect()}
    want, held = replay_seen(batches)
    assert got == want
    assert any(x[4] for x in want.values()) and len(held) < len(want)
    assert max(sizes) > sizes[-1]  # state shrinks when keys are forgotten
    assert spark.conf.get(state.PROVIDER, None) != state.ROCKS


NOTICES = "id long, at timestamp, seq long, deadline timestamp, qualification timestamp"
DATES = {"deadline": ("deadline", 3), "qualification": ("qualification", 0)}


def notice_batches(seed):
    rng = random.Random(seed)
    out = []
    for day in range(0, 60, 2):
        rows = []
        for _ in range(6):
            at = rounded(START + DAY * (day + rng.random() * 2))
            due = START + DAY * (day + rng.randrange(1, 20)) if rng.random() < 0.95 else None
            rows.append((rng.randrange(15), at, rng.randrange(10**6), due, START + DAY * (day + rng.randrange(1, 9)) if rng.random() < 0.6 else None))
        out.append(rows)
    return out


def replay_alerts(batches, delay=1):
    newest, due, sent, out, top, mark = {}, {}, {}, [], None, None
    for rows in [*batches, []]:
        touched = {}
        for n, at, seq, a, b in rows:
            if (mark is None or at >= mark) and (n not in newest or (at, seq) > newest[n]) and (n not in touched or (at, seq) > touched[n][0]):
                touched[n] = ((at, seq), {"deadline": a, "qualification": b})
        for n, (place, dates) in touched.items():
            newest[n] = place
            for kind, (_, lead) in DATES.items():
                date = dates[kind]
                ok = date is not None and date != sent.get((n, kind)) and (mark is None or date >= mark)
                due[n, kind] = (date, date - lead * DAY) if ok else None
        for (n, kind), x in due.items():
            if x and mark is not None and x[1] <= mark:
                out.append((n, kind, x[0]))
                sent[n, kind], due[n, kind] = x[0], None
        top = max([x for x in [top, *[r[1] for r in rows]] if x is not None])
        mark = top - delay * DAY
    return sorted(out)


@pytest.mark.parametrize("restarts", [False, True])
def test_alerts_once_over_moved_deadlines_and_restarts(spark, tmp_path, restarts):
    batches = notice_batches(3)
    schema = NOTICES
    run = lambda: state.run_to_table(state.alerts(stream(spark, f"{tmp_path}/in", schema), ["id"], "at", "seq", DATES), f"{tmp_path}/out", f"{tmp_path}/c")
    write_batches(spark, f"{tmp_path}/in", schema, batches)
    if restarts:
        # Stopped in the middle, and started again from the checkpoint.
        with state.rocks_state(spark):
            found = state.alerts(stream(spark, f"{tmp_path}/in", schema), ["id"], "at", "seq", DATES)
            query = found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").start()
            while not [p for p in query.recentProgress if p["batchId"] >= 5]:
                query.processAllAvailable() if not query.isActive else query.awaitTermination(1)
            query.stop()
        run()
    got = sorted((r.id, r.kind, r.date) for r in run().collect())
    want = replay_alerts(batches)
    assert got == want and len(set(got)) == len(got)
    assert {k for _, k, _ in got} == {"deadline", "qualification"}


def test_rows_without_key_or_time_are_left_out(spark, tmp_path):
    write_batches(spark, f"{tmp_path}/in", SEEN, [[(None, START, 1, "x"), ("a", None, 1, "x"), ("a", START, None, "x"), ("a", START, 2, None)]])
    changes = state.first_seen(stream(spark, f"{tmp_path}/in", SEEN), ["k"], "at", "seq", "data")
    got = state.run_to_table(changes, f"{tmp_path}/out", f"{tmp_path}/c").collect()
    assert [(r.k, r.seq, r.data, r.version, r.expired) for r in got] == [("a", 2, None, 1, False)]
