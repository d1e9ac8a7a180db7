"""Hot keys in row-level dimension joins are split by AQE."""

import pytest
from pyspark.sql import functions as F

from panelmill.operators import joins
from panelmill.session import stage

# Thresholds scaled down with the data; the defaults are hundreds of megabytes.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture
def small(spark):
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("join, expected", [(joins.join_dim, 200_000), (joins.orphans, 100_000)])
def test_hot_and_missing_codes_are_split(small, join, expected):
    """A third of the records has one code, a third has none."""
    code = "CASE id % 3 WHEN 0 THEN 'C0' WHEN 1 THEN CAST(NULL AS STRING) ELSE concat('C', id % 30000) END"
    records = stage(
        small.range(300_000).selectExpr(
            "id AS raw_record_id", f"{code} AS country_code", "sha2(CAST(id AS STRING), 512) AS source_file"
        ).repartition(16)
    )
    dim = stage(
        small.range(30_000).selectExpr(
            "concat('C', id) AS country_code", "'n' AS country_name", "'r' AS region", "'g' AS income_group"
        )
    )
    total = join(records, dim).agg(F.count("*").alias("n"), F.max("source_file").alias("last"))
    assert total.collect()[0]["n"] == expected
    assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
