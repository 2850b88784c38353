from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build_session

    ckpt = tempfile.mkdtemp(prefix="quayside-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="quayside-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": ckpt},
    )
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test data not present")
    return SF_SMALL


import datetime as dt

from quayside.specs import (
    CUSTOMER_LOYALTY_DDL,
    FRANCHISE_DDL,
    LOCATION_DDL,
    MENU_DDL,
    ORDER_DETAIL_DDL,
    ORDER_HEADER_DDL,
    TRUCK_DDL,
)

TS = dt.datetime(2024, 5, 1, 13, 30)


@pytest.fixture()
def pos(spark):
    od = spark.createDataFrame(
        [
            (1, 10, 100, None, 1, 2, 3.0, 6.0, None),
            (2, 10, 101, None, 2, 1, 4.0, 4.0, None),
            (3, 11, 100, None, 1, 1, 3.0, 3.0, None),
            (4, 12, 100, None, 1, 1, 3.0, 3.0, None),  # order 12: unknown truck
        ],
        ORDER_DETAIL_DDL,
    )
    oh = spark.createDataFrame(
        [
            (10, 7, 1.0, 500, None, 1, None, None, "web", TS, None, "USD", 10.0, None, None, 10.5),
            (11, 7, 2.0, None, None, 1, None, None, "pos", TS, None, "USD", 3.0, None, None, 3.25),
            (12, 9, 1.0, 500, None, 1, None, None, "pos", TS, None, "USD", 3.0, None, None, 3.0),
            (13, 7, 1.0, 500, None, 1, None, None, "pos", TS, None, "USD", 1.0, None, None, 1.0),
            (14, 7, None, 501, None, 1, None, None, "pos", TS, None, "USD", 1.0, None, None, 2.0),
        ],
        ORDER_HEADER_DDL,
    )
    truck = spark.createDataFrame(
        [(7, 1, "Austin", "TX", "US-TX", "US", "US", 1, 2020, "VW", "Bus", 0, 70, dt.date(2020, 1, 1))],
        TRUCK_DDL,
    )
    menu = spark.createDataFrame(
        [
            (1, 1, "Tacos", "Guac", 100, "Taco", "Main", "Hot", 1.0, 3.0, '{"a": 1}'),
            (1, 1, "Tacos", "Guac", 101, "Soda", "Drink", "Cold", 0.5, 4.0, None),
        ],
        MENU_DDL,
    )
    franchise = spark.createDataFrame([(70, "Ann", "Lee", "Austin", "US", "a@x", "1")], FRANCHISE_DDL)
    location = spark.createDataFrame(
        [(1, "pk1", "Park", "Austin", "TX", "US", "US"), (2, "pk2", "Mall", "Austin", "TX", "US", "US")],
        LOCATION_DDL,
    )
    members = spark.createDataFrame(
        [
            (500, "Bo", "Kim", "Austin", "US", "7", "en", "f", "Guac", "m", 2,
             dt.date(2020, 1, 1), dt.date(1990, 1, 1), "b@x", "2"),
            (501, "Cy", "Ng", "Austin", "US", "7", "en", "m", "Guac", "s", 0,
             dt.date(2020, 1, 1), dt.date(1991, 1, 1), "c@x", "3"),
            (502, "Di", "Ox", "Austin", "US", "7", "en", "f", "Guac", "s", 0,
             dt.date(2020, 1, 1), dt.date(1992, 1, 1), "d@x", "4"),
        ],
        CUSTOMER_LOYALTY_DDL,
    )
    return {
        "order_detail": od, "order_header": oh, "truck": truck, "menu": menu,
        "franchise": franchise, "location": location, "customer_loyalty": members,
    }
