import tempfile

from pyspark.sql import functions as F

from evenline.plans.queries import analysed
from evenline.sources.sink import write_results


def test_sink_partitions_and_prunes(spark):
    sf = "/root/testdata/sf0.001"
    from evenline.plans.context import Context
    c = Context.get(spark, sf)
    a = analysed(spark, sf).join(c.docs.select("doc_id", "lang"), "doc_id")
    out = tempfile.mkdtemp(prefix="evenline-sink-") + "/analysed"
    write_results(a.select("doc_id", "lang", "truth_label", "sentiment_label", "bias_label"), out)
    back = spark.read.parquet(out).where(F.col("lang") == "en")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(lang" in plan
    assert back.count() == c.docs.where("lang = 'en'").count()
