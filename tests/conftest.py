from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tabforge.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", 4, str(tmp_path_factory.mktemp("scratch")))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def load(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


def rows(df, *keys):
    """Rows as dicts, sorted by the keys."""
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=lambda r: tuple(str(r[k]) for k in keys)) if keys else out


def by(df, key, value=None):
    """Column ``key`` -> row (or one value of it)."""
    return {r[key]: (r[value] if value else r.asDict()) for r in df.collect()}
