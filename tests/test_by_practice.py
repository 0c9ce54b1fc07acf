import pytest
from pyspark.errors import AnalysisException

from tidemark.operators.analytics import by_practice, for_each_practice

QUERIES = [
    "select k, count(*) as n from {t} group by k",
    "select count(*) as n, max(v) as most from {t}",
    "select t.k, sum(w) as w from {t} t join {u} u on t.k = u.k group by t.k",
    "select t.k, t.v, c.name from {t} t left join {c} c on t.k = c.k",
    "select k, v from {t} order by v desc, k limit 1",
    "select name, v from {t} join {c} using (k)",
    "select k, row_number() over (order by v) as place from {t}",
    "select distinct k from {t} union all select k from {u}",
    "with z as (select k from {t} where v > 1) select count(distinct k) as n from z",
    "select k from {t} except select k from {u}",
]


@pytest.fixture
def tables(spark):
    return {
        "t": spark.createDataFrame(
            [("a", 1, "x"), ("a", 2, "y"), ("a", 2, None), ("b", 3, "x"), ("z", 9, "x")],
            "practice string, v int, k string",
        ),
        "u": spark.createDataFrame(
            [("a", "x", 10), ("b", "x", 20), ("b", "y", 5)], "practice string, k string, w int"
        ),
        "c": spark.createDataFrame([("x", "ex")], "k string, name string"),
    }


@pytest.mark.parametrize("query", QUERIES)
def test_as_each_practice_alone(spark, tables, rows, query):
    names = ["a", "b", "none"]
    listed = spark.createDataFrame([(n,) for n in [*names, "a"]], "practice string")
    assert rows(by_practice(spark, query, listed, tables)) == rows(
        for_each_practice(spark, query, names, tables)
    )


@pytest.mark.parametrize("query", [
    "select t.k, u.w from {t} t left join {u} u on t.k = u.k",
    "select k from {t} where v = (select max(v) from {t})",
])
def test_what_cannot_be_correlated_is_refused(spark, tables, query):
    listed = spark.createDataFrame([("a",)], "practice string")
    with pytest.raises(AnalysisException):
        by_practice(spark, query, listed, tables)


def test_the_plan_does_not_grow_with_the_list(spark, tables):
    def size(n):
        listed = spark.range(n).selectExpr("cast(id as string) as practice")
        df = by_practice(spark, QUERIES[0], listed, tables)
        return df._jdf.queryExecution().executedPlan().toString().count("\n")

    assert size(3) == size(5000)


def test_columns_of_any_name(spark, rows):
    odd = spark.createDataFrame([("a", 1)], "practice string, `a b``c` int")
    listed = spark.createDataFrame([("a",)], "practice string")
    assert rows(by_practice(spark, "select * from {odd}", listed, {"odd": odd})) == [("a", 1)]
