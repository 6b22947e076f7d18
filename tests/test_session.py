from pyspark.sql import functions as F

from reviewlake.functions.pseudonym import hmac_pads, pseudonym
from reviewlake.session import pin, release_pins, shared_folder


def test_pins_live_in_the_shared_folder_and_can_be_released(spark):
    pinned = pin(spark.range(10).withColumn("x", F.lit("a")))
    plan = pinned.select("id").filter("id > 3")._jdf.queryExecution().executedPlan().toString()
    assert shared_folder(spark).split(":")[-1] in plan
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan and "ReadSchema: struct<id:bigint>" in plan
    assert pinned.count() == 10
    release_pins(spark)
    assert pin(spark.range(2)).count() == 2


def test_plans_hide_key_material(spark):
    df = spark.range(1).select(pseudonym(F.col("id"), "very secret").alias("p"))
    shown = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended")
    assert not any(pad.lower() in shown.lower() for pad in hmac_pads("very secret"))
