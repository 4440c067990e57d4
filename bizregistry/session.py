"""Settings the jobs count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Exact distinct counts are taken where the company join left the rows, without a shuffle.
# By default adaptive execution then does not split a hot company, as that needs one; forced,
# it does, and adds the shuffle only for joins which turn out to be skewed.
#
# The large join may be reduced before its shuffle: where the flagged companies are few for the
# establishments' scan, the planner builds a Bloom filter of them and applies it to that scan. It does
# so by size only: the scan must be large (spark.sql.optimizer.runtime.bloomFilter.
# applicationSideScanSizeThreshold, 10 GB by default) and the companies' table under the threshold
# below, so that few tasks build the filter. It is made for so many companies, 20 MB of bits; beyond
# that it lets more through, and results stay the same.
_COMPANIES, _BITS = 20_000_000, 8
_BLOOM = "spark.sql.optimizer.runtime.bloomFilter"
SETTINGS = {
    f"{_BLOOM}.enabled": "true",
    f"{_BLOOM}.creationSideThreshold": "1g",
    f"{_BLOOM}.expectedNumItems": str(_COMPANIES),
    f"{_BLOOM}.numBits": str(_BITS * _COMPANIES),
    f"{_BLOOM}.maxNumItems": str(2 * _COMPANIES),
    f"{_BLOOM}.maxNumBits": str(2 * _BITS * _COMPANIES),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
