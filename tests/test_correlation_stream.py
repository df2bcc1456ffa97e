"""Alerts correlated as they land, late ones and strays included, against all pairs."""

import random

from pyspark.sql import functions as F

from meterflow.files import Files
from meterflow.schemas import ALERT_COLUMNS
from meterflow.streaming import correlation as C
from test_streaming import NOW, START_US

SCHEMA = "us long, source string, subject string, reason string, value double, detail string"
DAY = 86_400_000_000


def frame(spark, rows):
    flat = spark.createDataFrame([(us, s, f"x{n}", "r", 1.0, "d") for us, s, n in rows], SCHEMA)
    return flat.select(F.timestamp_micros(F.col("us") + START_US).alias("alert_time"), *ALERT_COLUMNS[1:])


def plainly(rows, within):
    found = {}
    for us, source, n in rows:
        if source == "telemetry":
            before = [u for u, s, _ in rows if s == "network" and us - within <= u <= us]
            if before:
                found[f"x{n}"] = (len(before), max(before))
    return found


def test_late_alerts_and_strays(spark, tmp_path, monkeypatch):
    source, landed, changes, check = (str(tmp_path / n) for n in ("src", "landed", "changes", "check"))
    pick, rows, asked = random.Random(3), [], []
    real = Files.existing
    monkeypatch.setattr(Files, "existing", lambda self, paths: (asked.append(list(paths)), real(self, paths))[1])
    for batch in range(6):
        new = [(pick.randrange(0, 400_000_000), pick.choice(["network", "telemetry"]), len(rows) + k) for k in range(40)]
        if batch == 3:
            new = [(-300 * DAY, "network", 1000), (-300 * DAY + 5_000_000, "telemetry", 1001), (DAY - 10, "network", 1002)]
        if batch == 4:
            new = [(DAY + 10, "telemetry", 1003)]
        if batch == 5:
            new = []
        rows += new
        frame(spark, new).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame(spark, []).schema).parquet(source)
        C.start_correlation(stream, landed, changes, check, trigger=NOW).awaitTermination()
        got = {r.subject: (r.network_alerts, r.us) for r in C.correlated(spark, changes).withColumn(
            "us", F.unix_micros("last_network_alert") - START_US).collect()}
        assert got == plainly(rows, 30_000_000)
    assert max(map(len, asked)) <= 5  # days, however far apart the strays are
