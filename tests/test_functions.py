from decimal import Decimal

from pyspark.sql import functions as F

from sortproof.functions import counts as C
from sortproof.functions import records as R


def test_human_counts(spark):
    cases = ["12", "12k", "3M", "7b", "2t", "2T", "5x", "", "k", "-3", "1.5k", "00", "9223372036854775807"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = {r.s: r.n for r in df.select("s", C.parse_human_count("s").alias("n")).collect()}
    assert got["12"] == 12 and got["12k"] == 12000 and got["3M"] == 3_000_000
    assert got["7b"] == 7 * 10 ** 9 and got["2t"] == got["2T"] == 2 * 10 ** 12
    assert got["5x"] is None and got[""] is None and got["k"] is None and got["-3"] is None
    assert got["1.5k"] is None and got["00"] == 0
    assert got["9223372036854775807"] == 9223372036854775807


def test_format_size(spark):
    vals = [0, 999, 1000, 1001, 999_999, 1_000_001, 2_500_000_000, 10 ** 12, 10 ** 12 + 1,
            9_000_000_000_000_000_000]
    df = spark.createDataFrame([(v,) for v in vals], "n bigint")
    got = [r.t for r in df.select(C.format_size("n").alias("t")).collect()]
    assert got == ["0B", "999B", "1000B", "1KB", "999KB", "1MB", "2GB", "1000GB", "1TB",
                   "9000000TB"]


def test_hex_roundtrip(spark):
    vals = [0, 255, 2 ** 64 - 1, 2 ** 64, 2 ** 100 + 12345]
    df = spark.createDataFrame([(format(v, "x"),) for v in vals], "h string")
    r = df.select(R.hex_to_decimal("h").alias("d")).select(
        "d", R.decimal_to_hex("d").alias("h")).collect()
    assert [int(x.d) for x in r] == vals
    assert [x.h for x in r] == [format(v, "x") for v in vals]


def test_strict_decimal(spark):
    df = spark.createDataFrame([("123",), ("12a",), ("",), (" 1",)], "s string")
    got = [r.d for r in df.select(R.parse_decimal_strict("s").alias("d")).collect()]
    assert got == [Decimal(123), None, None, None]


def test_key_bytes_and_prefix(spark):
    df = spark.createDataFrame([(bytes([0xFF, 0x0A, 0x00]),)], "k binary")
    r = df.select(R.spaced_hex("k").alias("s"), R.key_byte_values("k").alias("b"),
                  R.byte_at("k", 1).alias("b1"), R.byte_at("k", 7).alias("b7"),
                  R.key_prefix_int("k", 7).alias("p7"), R.key_prefix_int("k", 3).alias("p3"),
                  R.hex_digit_at(F.lit("ab"), 1).alias("h1"),
                  R.hex_digit_at(F.lit("ab"), 5).alias("h5")).collect()[0]
    assert r.s == "ff 0a 00" and r.b == [255, 10, 0] and r.b1 == 10 and r.b7 == 0
    assert r.p7 == 0xFF0A0000000000 and r.p3 == 0xFF0A00
    assert (r.h1, r.h5) == ("B", "0")


def test_binary_order_is_unsigned(spark):
    df = spark.createDataFrame([(bytes([0xFF]), bytes([0x0A]))], "a binary, b binary")
    assert df.select((F.col("a") > F.col("b")).alias("x")).collect()[0].x is True


def test_record_split_join(spark):
    df = spark.createDataFrame([(bytes(range(10)), bytes(range(10, 100)))], "key binary, value binary")
    r = df.select(R.join_record().alias("rec")).select(
        R.record_key("rec").alias("k"), R.record_value("rec").alias("v"),
        R.crc_record(R.record_key("rec"), R.record_value("rec")).alias("c")).collect()[0]
    import zlib
    assert bytes(r.k) == bytes(range(10)) and bytes(r.v) == bytes(range(10, 100))
    assert r.c == zlib.crc32(bytes(range(100)))
