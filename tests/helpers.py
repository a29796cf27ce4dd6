import math


def values(spark, sql_type, items, expression):
    """An expression over `x`, one row per item, in order."""
    df = spark.createDataFrame(list(enumerate(items)), f"i int, x {sql_type}")
    rows = df.selectExpr("i", f"{expression} as y").orderBy("i").collect()
    return [r.y for r in rows]


def same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a):
        return math.isnan(b)
    return a == b
