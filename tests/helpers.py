"""Small builders and plan readers for the tests."""

import contextlib
import io
import json
import os

READING = "sensor_id string, timestamp timestamp, vehicle_count int, avg_speed double"
AGGREGATE = ("sensor_id string, window_start timestamp, window_end timestamp, "
             "total_vehicles bigint, window_avg_speed double, congestion_index double, "
             "traffic_date date")
PEAK = "sensor_id string, peak_hour int, hourly_volume bigint, avg_congestion_index double"


def rows(df, *columns):
    """Sorted tuples, NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda r: [(v is not None, str(v)) for v in r])


def final_plan(df):
    """The adaptive plan after a run, without the initial plans it also prints."""
    df.collect()
    kept, below = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :"))
        if below is not None and depth > below:
            continue
        below = depth if "== Initial Plan ==" in line else None
        kept.append(line)
    return "\n".join(kept)


def shuffled_records(df):
    """Records each shuffle of the plan wrote, in a run."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name in ("ShuffleQueryStageExec", "ResultQueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def write_lines(folder, name, messages, mtime):
    """One file of JSON envelopes, with a set file time so that the order is known."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        for key, value, time in messages:
            f.write(json.dumps({"key": key, "value": value, "timestamp": time}) + "\n")
    os.utime(path, (mtime, mtime))


def reading_json(sensor, time, vehicles, speed):
    return json.dumps({"sensor_id": sensor, "timestamp": time, "vehicle_count": vehicles,
                       "avg_speed": speed})


def envelope_stream(spark, folder, **options):
    return (spark.readStream.schema("key string, value string, timestamp timestamp")
            .options(**options).json(str(folder)))
