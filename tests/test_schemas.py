import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from viewlake import schemas


def test_tables_have_the_declared_columns():
    assert len(schemas.VIEWING_EVENTS) == 10
    assert len(schemas.CONTENT_METADATA) == 6
    assert len(schemas.CONTENT_LAUNCH) == 5
    assert not schemas.VIEWING_EVENTS["event_id"].nullable
    assert schemas.VIEWING_EVENTS["customer_id"].nullable


def test_domains():
    assert len(schemas.REGIONS) == 4
    assert len(schemas.DEVICE_TYPES) == 5
    assert len(schemas.EVENT_TYPES) == 6
    assert len(schemas.SUBSCRIPTION_TYPES) == 4
    assert len(schemas.LAUNCH_STATUSES) == 3


def test_added_column_is_compatible():
    grown = StructType([*schemas.CONTENT_LAUNCH, StructField("note", StringType())])
    drift = schemas.require_compatible(schemas.CONTENT_LAUNCH, grown)
    assert drift.added == ("note",)


def test_missing_or_retyped_column_fails():
    fields = schemas.CONTENT_LAUNCH.fields
    with pytest.raises(ValueError, match="region"):
        schemas.require_compatible(
            schemas.CONTENT_LAUNCH, StructType([fields[0], *fields[2:]])
        )
    retyped = StructType([fields[0], StructField("region", LongType()), *fields[2:]])
    assert schemas.compare_schemas(schemas.CONTENT_LAUNCH, retyped).retyped == (
        "region",
    )


def test_merged_read_fills_a_new_column_with_null(spark, tmp_path):
    from viewlake.sources import read_lake

    path = str(tmp_path / "lake")
    spark.sql("SELECT 1 AS a").write.parquet(f"{path}/day=1")
    spark.sql("SELECT 2 AS a, 'x' AS b").write.parquet(f"{path}/day=2")
    rows = read_lake(spark, path, merge_schema=True).orderBy("a").collect()
    assert [(r.a, r.b) for r in rows] == [(1, None), (2, "x")]
