from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from dimforge.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=8, shuffle_partitions=8, app="dimforge-tests")
    yield s
    s.stop()


def raw_rows(spark, rows: list[dict]):
    """Hand-written landing rows: missing fields are NULL, all text."""
    from dimforge.sources.landing import LANDING_COLUMNS, LANDING_SCHEMA

    data = [tuple(r.get(c) for c in LANDING_COLUMNS) for r in rows]
    return spark.createDataFrame(data, LANDING_SCHEMA)


BASE = {
    "id": "1", "case_number": "HX0000001", "date": "01/15/2010 10:30:00 AM", "block": "001XX BLOCK",
    "iucr": "0110", "primary_type": "THEFT", "description": "ARMED - KIND 1", "location_description": "STREET",
    "arrest": "true", "domestic": "false", "beat": "0421", "district": "004", "ward": "12", "community_area": "7",
    "fbi_code": "06", "year": "2010", "updated_on": "01/02/2014 03:04:05 PM", "latitude": "41.123456785",
    "longitude": "-87.5",
}


def row(**kw):
    r = dict(BASE)
    r.update(kw)
    return r
