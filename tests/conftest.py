from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerlens.schema import TRANSACTION_SCHEMA, TRANSACTION_TYPES
from ledgerlens.session import local_session

_CYCLE = ("PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT")
assert set(_CYCLE) == set(TRANSACTION_TYPES)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def sixty_rows():
    return [
        (i + 1, _CYCLE[i % 5], 100.0 + i, f"C{i}", 1000.0, 900.0, f"M{i}", 0.0, 100.0, int(i % 4 == 0), 0)
        for i in range(60)
    ]


@pytest.fixture(scope="session")
def log(spark):
    """Sixty rows: steps 1 to 60, fifteen positives."""
    return spark.createDataFrame(sixty_rows(), TRANSACTION_SCHEMA)


@pytest.fixture
def row(spark):
    """A one-row log with the given fields changed."""

    def make(**changes):
        base = dict(zip(TRANSACTION_SCHEMA.names, sixty_rows()[0])) | changes
        return spark.createDataFrame([tuple(base[n] for n in TRANSACTION_SCHEMA.names)], TRANSACTION_SCHEMA)

    return make


@pytest.fixture
def csv(tmp_path):
    """Writes a log of dict rows as one CSV file and returns its path."""

    def write(rows, columns=TRANSACTION_SCHEMA.names, name="log.csv"):
        path = tmp_path / name
        lines = [",".join(columns)]
        lines += [",".join("" if r.get(c) is None else str(r[c]) for c in columns) for r in rows]
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


@pytest.fixture
def dict_rows():
    return [dict(zip(TRANSACTION_SCHEMA.names, r)) for r in sixty_rows()]
