from pyspark.sql import functions as F

from lakework.operators import dimension as M
from lakework.operators import eligibility as E
from tests.conftest import rows


def test_floc_attributes_priority_and_order(spark):
    l1 = spark.createDataFrame([("P1", "ED_POLE", " ", 1), ("P2", "XX;YY", "12kV", 2), ("P3", "ED_POLE", None, 3)],
                               "FLOC string, `Eq_OjType` string, Voltage string, pos int")
    l2 = spark.createDataFrame([("P1", "ET_TOWER", "66kV", 1)], "`FLOC ID` string, EqType string, kV string, pos int")
    kw = dict(run_date="d", run_id="r", source_system="S")
    lines = [
        M.scope_list_line(l1, asset_class="distribution", scope_list="A", position=F.col("pos"), **kw),
        M.scope_list_line(l2.withColumnRenamed("FLOC ID", "FLOC_ID"), asset_class="transmission", scope_list="B", position=F.col("pos"), **kw),
    ]
    dim = M.floc_attributes_dim(M.scope_master_union(lines))
    got = {r[0]: r[1:] for r in rows(dim, "floc", "object_type", "voltage", "scope_lists", "row_count")}
    assert got == {"P1": ("ET_TOWER", "66kV", "A;B", 2), "P2": ("XX", "12kV", "A", 1), "P3": ("ED_POLE", None, "A", 1)}
    ranked = E.standardize_floc_dim(spark.createDataFrame([("P1", "ED_POLE", None), ("P1", "EZ_POLE", "1")], "floc string, object_type string, voltage string"))
    assert rows(ranked) == [("P1", "EZ_POLE", "1")]
