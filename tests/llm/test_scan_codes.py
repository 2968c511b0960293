"""Block starts of texts of more than 2^31 / 256 words."""

from martforge.llm.decontaminate import _codes
from pyspark.sql import functions as F


def test_codes_of_a_very_long_text(spark):
    n, m = 8_400_000, 250
    codes = spark.createDataFrame([(n,)], "n int").select(_codes(F.col("n"), [m])[0].alias("c")).select(
        F.size("c").alias("size"), F.element_at("c", -1).alias("last")).first()
    assert codes["size"] == n // m and divmod(codes["last"], 256) == (n - m, m)
