import random
import struct

from pyspark.sql import functions as F

from quayside.functions.numbers import concat_fixed, round_fast


def _values():
    rng = random.Random(7)
    out = [0.0, -0.0, 0.0005, 0.0015, 1.0005, 2.675, 0.5, 1.5, -0.0004, -2.675, 1e-9, 999.9995, 999.99949999, 1e9, 1e12, 1e15, 1e18, 1e300,
           float("nan"), float("inf"), float("-inf"), None, 1234.5675, 19999.9999995, 0.0000005, 0.1234565]
    out += [rng.uniform(0, 20000) for _ in range(3000)]
    out += [rng.randrange(20_000_000) / 1000 + 0.0005 for _ in range(1500)]  # ties of three digits
    out += [rng.randrange(20_000_000_000) / 1e6 + 5e-7 for _ in range(1500)]  # ties of six
    return out + [struct.unpack("<d", struct.pack("<q", struct.unpack("<q", struct.pack("<d", v))[0] + d))[0] for v in (0.0005, 2.6755, 100.0005) for d in (-1, 1)]


def test_fast_rounding_and_fixed_notation_equal_the_built_in_functions(spark):
    df = spark.createDataFrame([(v,) for v in _values()], "v double")
    got = df.select("v", round_fast("v", 6).alias("r"), F.round("v", 6).alias("want_r"),
                    concat_fixed(F.lit("at "), "v", 3, " km").alias("t"), F.format_string("at %.3f km", "v").alias("want_t"))
    assert got.filter(~F.col("r").eqNullSafe(F.col("want_r")) | ~F.col("t").eqNullSafe(F.col("want_t"))).collect() == []
    # most values need neither
    fast = round_fast("v", 6)
    assert "round(" in str(fast) and got.count() > 6000
