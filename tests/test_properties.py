"""Property tests: Spark column expressions against plain-Python models."""

import bisect
import zlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sortproof.functions import counts as C
from sortproof.functions import records as R
from sortproof.operators import partition as P

SETTINGS = dict(max_examples=15, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.binary(min_size=0, max_size=12)


def _prefix_model(k: bytes, nbytes: int) -> int:
    return int.from_bytes((k + bytes(nbytes))[:nbytes], "big")


@settings(**SETTINGS)
@given(st.lists(keys, min_size=1, max_size=40), st.integers(1, 50))
def test_prefix_partitions_model(spark, ks, p):
    df = spark.createDataFrame([(k,) for k in ks], "key binary")
    got = df.select(P.prefix7_partition("key", p).alias("a"),
                    P.prefix3_partition("key", p).alias("b")).collect()
    per7 = ((1 << 56) - 1) // p
    per3 = -(-(1 << 24) // p)
    assert [(r.a, r.b) for r in got] == [
        (min(p - 1, _prefix_model(k, 7) // per7), min(p - 1, _prefix_model(k, 3) // per3))
        for k in ks]


@settings(**SETTINGS)
@given(st.lists(keys, min_size=1, max_size=40), st.lists(keys, min_size=0, max_size=70))
def test_range_partition_model(spark, ks, splits):
    splits = sorted(splits)
    df = spark.createDataFrame([(k,) for k in ks], "key binary")
    got = [r.pid for r in df.select(P.range_partition("key", splits).alias("pid")).collect()]
    assert got == [bisect.bisect_right(splits, k) for k in ks]
    # with a salt, hot keys stay inside the partitions their split points reserve
    salted = [r.pid for r in df.select(P.range_partition("key", splits, F.xxhash64("key"))
                                       .alias("pid")).collect()]
    for k, pid in zip(ks, salted):
        lo, hi = bisect.bisect_left(splits, k), bisect.bisect_right(splits, k)
        assert (pid == hi) if hi - lo <= 1 else (lo + 1 <= pid <= hi)


@settings(**SETTINGS)
@given(st.lists(keys, min_size=1, max_size=30))
def test_crc_and_hex_model(spark, ks):
    df = spark.createDataFrame([(k,) for k in ks], "key binary")
    got = df.select(R.crc_key("key").alias("c"), R.spaced_hex("key").alias("h"),
                    R.key_prefix_int("key", 7).alias("p")).collect()
    assert [(r.c, r.h, r.p) for r in got] == [
        (zlib.crc32(k), " ".join(f"{b:02x}" for b in k), _prefix_model(k, 7)) for k in ks]


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 2 ** 120), min_size=1, max_size=20))
def test_decimal_hex_model(spark, vals):
    df = spark.createDataFrame([(format(v, "x"),) for v in vals], "h string")
    got = df.select(R.hex_to_decimal("h").alias("d")).select(
        R.decimal_to_hex("d").alias("x")).collect()
    assert [r.x for r in got] == [format(v, "x") for v in vals]


@settings(**SETTINGS)
@given(st.lists(st.integers(-10, 2 ** 62), min_size=1, max_size=30))
def test_format_size_model(spark, vals):
    def model(n):
        for unit, scale in (("TB", 10 ** 12), ("GB", 10 ** 9), ("MB", 10 ** 6), ("KB", 10 ** 3)):
            if n > scale:
                return f"{n // scale}{unit}"
        return f"{n}B"
    df = spark.createDataFrame([(v,) for v in vals], "n bigint")
    assert [r.t for r in df.select(C.format_size("n").alias("t")).collect()] == \
        [model(v) for v in vals]
