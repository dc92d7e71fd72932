"""R8 and R10 on sf0.1 within a time limit, every row computed."""

import time

import __spark_entry__ as E

SF01 = "/root/testdata/sf0.1"
LIMIT_SEC = 180


def _timed(spark, name):
    t = time.perf_counter()
    E.queries()[name](spark, SF01).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def test_smotenc_at_sf01(spark):
    assert _timed(spark, "smotenc_oversample") < LIMIT_SEC


def test_prepare_at_sf01(spark):
    assert _timed(spark, "prepare") < LIMIT_SEC
