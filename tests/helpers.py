from pyspark.sql import functions as F


def one(spark, column, schema=None, **values):
    """Evaluate a column over one row of text values."""
    schema = schema or ", ".join(f"{name} string" for name in values)
    df = spark.createDataFrame([tuple(values.values())], schema)
    return df.select(column.alias("x")).first()["x"]


def each(spark, build, values, type_name="string"):
    """Evaluate ``build(column)`` over a list of values, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {type_name}")
    return [r["x"] for r in df.select("i", build(F.col("c")).alias("x")).orderBy("i").collect()]


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
