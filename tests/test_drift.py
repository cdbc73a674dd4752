"""Unknown fields: their merged types, which are promoted, and what stays behind."""

import pytest
from pyspark.sql import functions as F, types as T

from pulsemill.operators import drift
from pulsemill.schemas import ENRICHED
from pulsemill.sinks import warehouse
from pulsemill.sources.tables import read_warehouse


def rows(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, image string")
    return df.select("id", F.from_json("image", "map<string,variant>").alias("extras"))


def test_types_are_merged_over_all_rows(spark):
    found = drift.discovered_fields(rows(
        spark, '{"a":1,"b":"x","c":{"p":1}}', '{"a":2.5,"b":3,"c":{"q":"t"}}', '{"a":null,"d":null}', None, "{}").repartition(4))
    assert {tuple(r) for r in found.collect()} == {
        ("a", "DECIMAL(21,1)", 3, 1), ("b", "VARIANT", 2, 0), ("c", "OBJECT<p: BIGINT, q: STRING>", 2, 0), ("d", "VOID", 1, 1)}


def test_only_scalars_of_one_type_are_promoted(spark):
    found = spark.createDataFrame([
        ("zz", "STRING", 5, 1), ("ZZ", "BIGINT", 3, 0), ("DEVICE", "STRING", 9, 0), ("few", "STRING", 9, 8),
        ("mixed", "VARIANT", 9, 0), ("none", "VOID", 9, 9), ("obj", "OBJECT<a: BIGINT>", 9, 0), ("on", "BOOLEAN", 7, 0),
        ("d", "DECIMAL(4,2)", 6, 0)], "field string, type string, n_rows long, n_null long")
    assert drift.agreed_schema(found, ENRICHED, 2) == T.StructType([
        T.StructField("d", T.DecimalType(4, 2)), T.StructField("on", T.BooleanType()), T.StructField("zz", T.StringType())])
    assert drift.agreed_schema(found, ENRICHED, 2, most=1).names == ["on"]
    assert drift.agreed_schema(found.limit(0), ENRICHED).names == []


@pytest.mark.parametrize("kind, text, value, rest", [
    ("bigint", '{"a":7}', 7, None), ("bigint", '{"a":1.5}', None, '{"a":1.5}'), ("bigint", '{"a":"7"}', None, '{"a":"7"}'),
    ("bigint", '{"a":9007199254740993}', 9007199254740993, None), ("double", '{"a":1.5,"b":2}', 1.5, '{"b":2}'),
    ("double", '{"a":true}', None, '{"a":true}'), ("string", '{"a":"t"}', "t", None), ("string", '{"a":1}', None, '{"a":1}'),
    ("boolean", '{"a":null}', None, '{"a":null}'), ("string", '{"b":1}', None, '{"b":1}'), ("string", None, None, None),
    ("decimal(20,1)", '{"a":1.25}', None, '{"a":1.25}'), ("decimal(20,1)", '{"a":12345678901234567.25}', None, '{"a":12345678901234567.25}'),
])
def test_a_value_moves_only_unchanged(spark, kind, text, value, rest):
    fields = T.StructType([T.StructField("a", T.DataType.fromDDL(kind))])
    row = drift.promoted(rows(spark, text), fields).select("a", F.to_json("extras", {"ignoreNullFields": "false"})).first()
    assert tuple(row) == (value, rest)


def test_nothing_to_promote(spark):
    df = rows(spark, '{"a":1}')
    assert drift.promoted(df, T.StructType([])) is df


def test_batches_before_and_after_a_promotion(spark, tmp_path):
    base = spark.range(4).select(*[
        (F.col("id") if f.name == "id" else F.lit("2024-01-05 10:00:00").cast(f.dataType) if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
         else F.lit("1").cast(f.dataType)).alias(f.name) for f in ENRICHED.fields]).withColumn("tag", F.lit("t"))
    before, rejects = warehouse.warehouse_rows(base.where("id < 2"))
    after, _ = warehouse.warehouse_rows(base.where("id >= 2"), promoted=["tag"])
    assert rejects.count() == 0 and after.columns[-1] == "tag" and "tag" not in before.columns
    warehouse.write_batch(before, str(tmp_path), 0)
    warehouse.write_batch(after, str(tmp_path), 1)
    table = read_warehouse(spark, str(tmp_path), T.StructType([T.StructField("tag", T.StringType())]))
    assert {(int(r.id), r.tag) for r in table.select("id", "tag").collect()} == {(0, None), (1, None), (2, "t"), (3, "t")}
    assert "tag" not in read_warehouse(spark, str(tmp_path)).columns
