import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import monitoring
from ledgerlens.operators.metrics import CONFUSION
from ledgerlens.streaming import jobs, live

LOG = "event_id long, logged_at timestamp_ntz, outcome string, prediction long"
LABELS = "event_id long, isFraud long, labelled_at timestamp_ntz"
BASE = datetime.datetime(2024, 5, 1)
DAY = datetime.timedelta(days=1)


def planted(n=300):
    """Per request its day, its outcome, and when its label comes, if it does."""
    draw = random.Random(9)
    requests, labels = [], []
    for i in range(n):
        at = BASE + DAY * (i // 10) + datetime.timedelta(minutes=draw.randrange(600))
        requests.append((i, at, draw.choice(["success"] * 5 + ["malformed"]), draw.randrange(2)))
        wait = draw.choice([0, 1, 3, 5, None, -1])
        if wait is not None:
            labels.append((i, draw.randrange(2), at + DAY * wait))
    labels.append((labels[0][0], 1, labels[0][2]))  # a second label of one request
    odd = [(None, BASE, "success", 1), (n, None, "success", 1), (n + 1, BASE + DAY * 29, "success", None)]
    return requests + odd, labels + [(None, 1, BASE), (n + 2, 1, None)]


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    """Three runs over growing folders with one checkpoint; the rows, labels and counts."""
    at = tmp_path_factory.mktemp("live")
    requests, labels = planted()
    log, known = spark.createDataFrame(requests, LOG), spark.createDataFrame(labels, LABELS)
    after, written = [], []

    def write(rows, batch):
        written.append(batch)
        live.write_into(str(at / "counts"))(rows, batch)

    for day in (10, 20, 60):
        low, high = BASE + DAY * (day - 10 if day < 60 else 20), BASE + DAY * day
        low = low if day > 10 else BASE - DAY * 9
        part = lambda t, c: t.where((F.col(c) >= F.lit(low)) & (F.col(c) < F.lit(high)) | (F.col(c).isNull() & F.lit(day == 10)))
        part(log, "logged_at").coalesce(1).write.mode("append").parquet(str(at / "log"))
        part(known, "labelled_at").coalesce(1).write.mode("append").parquet(str(at / "labels"))
        read = lambda name, schema: spark.readStream.schema(schema).parquet(str(at / name))
        pairs = live.judged(read("log", LOG), read("labels", LABELS), "4 days")
        jobs.run_batches(pairs, write, str(at / "checkpoint"))
        after.append(live.read(spark, str(at / "counts")).first())
    return log, known, after, str(at)


def test_equals_the_batch_form_within_the_bound(spark, streamed):
    log, known, after, _ = streamed
    asked = log.select("event_id", F.col("logged_at").alias("asked"))
    near = known.join(asked, "event_id").where("labelled_at >= asked and labelled_at <= asked + interval 4 days")
    want = monitoring.live_performance(log, near).first()
    assert {c: after[-1][c] for c in want.asDict()} == want.asDict()
    assert want["scored"] > 50 and min(want[c] for c in CONFUSION) > 0


def test_labels_count_as_they_come(streamed):
    scored = [row["scored"] for row in streamed[2]]
    assert 0 < scored[0] < scored[1] < scored[2]


def test_requests_without_a_label_expire(spark, streamed):
    """Those whose time is over by the watermark; later ones still wait."""
    log, known, after, _ = streamed
    served = log.where("outcome = 'success' and event_id is not null and logged_at is not null")
    asked = served.select("event_id", F.col("logged_at").alias("asked"))
    met = known.join(asked, "event_id").where("labelled_at >= asked and labelled_at <= asked + interval 4 days")
    waiting = served.join(met, "event_id", "left_anti")
    lag = F.lit(min(log.agg(F.max("logged_at")).first()[0], known.agg(F.max("labelled_at")).first()[0])) - F.expr("interval 1 hour")
    over = waiting.where(F.col("logged_at") + F.expr("interval 4 days") < lag).count()
    assert 0 < over == after[-1]["expired"] < waiting.count()
    assert after[0]["expired"] < after[1]["expired"] < after[2]["expired"]


def test_a_batch_that_runs_twice_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, 1, False), (2, 0, None, True)], "event_id long, prediction long, truth long, expired boolean")
    write = live.write_into(str(tmp_path))
    write(rows, 0)
    write(rows, 0)
    row = live.read(spark, str(tmp_path)).first()
    assert (row.true_positives, row.scored, row.expired) == (1, 1, 1)
