import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import monitoring
from ledgerlens.streaming import jobs as stream_jobs
from ledgerlens.streaming import panels

LOG = "logged_at timestamp_ntz, outcome string, latency_ms double, prediction long, fraud_probability double"
BASE = datetime.datetime(2024, 3, 1)


def outcome_rows(n=900):
    draw = random.Random(6)
    rows = []
    for _ in range(n):
        outcome = draw.choice(["success"] * 6 + ["invalid_request", "features_unavailable", "malformed"])
        at = BASE + datetime.timedelta(seconds=draw.randrange(3 * 3600))
        served = outcome == "success"
        rows.append((at, outcome, draw.choice([2.0, 7.5, 80.0, 12_000.0, None]) if served else None, draw.choice([0, 0, 1]) if served else None, draw.choice([draw.random(), None]) if served else None))
    return rows + [(None, "success", 1.0, 0, 0.5), (datetime.datetime(1969, 12, 31, 23, 59, 30), "success", 1.0, 1, 0.5)]


def same(got, want):
    assert got.columns == want.columns
    def key(r):
        return [round(v, 9) if isinstance(v, float) else v for v in r]

    assert sorted(map(key, got.collect()), key=str) == sorted(map(key, want.collect()), key=str)


PANELS = [
    (panels.request_rate, lambda log, size, slide: monitoring.request_rate(log, f"{size} seconds", size, slide and f"{slide} seconds"), 60),
    (panels.latency_quantiles, monitoring.latency_quantiles, 300),
    (panels.error_ratio, monitoring.error_ratio, 300),
    (panels.fraud_per_hour, monitoring.fraud_per_hour, 3600),
    (panels.mean_probability, monitoring.mean_probability, 300),
    (panels.class_distribution, monitoring.class_distribution, 3600),
]


@pytest.fixture(scope="module")
def streamed(spark, tmp_path_factory):
    """The log as a stream of files in no order of time, with a replay of its last batch."""
    at = tmp_path_factory.mktemp("panels")
    folder, path = str(at / "in"), str(at / "panels")
    log = spark.createDataFrame(outcome_rows(), LOG)
    log.repartition(5).write.parquet(folder)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    for _ in range(2):
        stream_jobs.run_batches(stream, panels.write_into(path), str(at / "c"))
        last = max((at / "c/commits").glob("[0-9]*"), key=lambda f: int(f.name))
        for f in (last, last.with_name(f".{last.name}.crc")):
            f.unlink()
    return log, path


@pytest.mark.parametrize("k", range(len(PANELS)))
def test_panels_equal_the_batch(spark, streamed, k):
    log, path = streamed
    live, batch, size = PANELS[k]
    log = log.where("logged_at IS NOT NULL")
    for slide in (None, 60, 1200 if size == 3600 else None):
        windows = (f"{size} seconds", slide and f"{slide} seconds") if k else (size, slide)
        same(live(panels.read(spark, path), size, slide), batch(log, *windows))


def test_folded_panels_are_the_same(spark, streamed):
    _, path = streamed
    before = sorted(panels.read(spark, path).collect())
    assert panels.fold(spark, path) == 1
    after = sorted(panels.read(spark, path).collect())
    assert [r[:-1] for r in after] == [r[:-1] for r in before]
    assert [r.probability for r in after] == pytest.approx([r.probability for r in before])


def test_windows_must_be_whole_steps(spark, streamed):
    with pytest.raises(ValueError):
        panels.request_rate(panels.read(spark, streamed[1]), 90)
    assert panels.partial_rows(streamed[0].limit(0)).count() == 0
    one = panels.partial_rows(streamed[0], 1)
    assert one.agg(F.sum("counted")).first()[0] == panels.partial_rows(streamed[0]).agg(F.sum("counted")).first()[0]
