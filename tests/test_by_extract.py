from datetime import datetime

from pyspark.sql import functions as F

from checks import jobs


def test_extracts_of_a_year_read_that_year_alone(spark, tmp_path):
    days = [None, datetime(1994, 12, 31), datetime(1995, 1, 1), datetime(1995, 1, 1),
            datetime(2001, 12, 31), datetime(2002, 1, 1)]
    folder = str(tmp_path)
    spark.createDataFrame(
        [(i, 1, d) for i, d in enumerate(days)], "o_orderkey long, o_custkey long, o_orderdate timestamp"
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        [(i, 1, 1, d, "N") for i, d in enumerate(days)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate timestamp, l_returnflag string",
    ).write.parquet(f"{folder}/lineitem.parquet")
    dated = jobs._by_year(spark, folder)
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        found = dated[name].groupBy("_year").agg(F.sort_array(F.collect_list(key))).collect()
        assert sorted(map(tuple, found)) == [(1995, [2, 3]), (2001, [4])]
        first = dated[name].where("_year = 1995").select("_metadata.file_path").collect()
        assert all("_year=1995/" in r[0] for r in first)
