from __future__ import annotations

from pyspark.sql import functions as F

from cdcflow.sources import workload

TEMPLATE = '<row id="T1">\n  <c23>1.00</c23>\n</row>'


def test_stamped_copy(spark):
    xml = workload.stamp_record(
        F.lit(TEMPLATE), "T1", F.lit("A-1"), F.lit(5).cast("bigint"), F.lit(6).cast("bigint"), {"c23": F.lit("$2\\")}
    )
    assert spark.range(1).select(xml).head()[0] == (
        '<row id="A-1">\n  <c23>$2\\</c23>\n<bts>5</bts><ots>6</ots></row>'
    )
    plain = workload.stamp_record(F.lit(TEMPLATE), "T1", F.lit("A-1"))
    assert spark.range(1).select(plain).head()[0] == TEMPLATE.replace("T1", "A-1")
