"""Small frames and failure injection."""

from pathlib import Path

from pyspark.sql import functions as F

from haulier import read_landed


def values(spark, columns, *tuples):
    """Frame of SQL literals: ``values(spark, "id INT, d DATE", "1, DATE'2024-01-01'")``."""
    names = ", ".join(c.split()[0] for c in columns.split(","))
    casts = ", ".join(f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in columns.split(","))
    if not tuples:
        nulls = ", ".join("NULL" for _ in columns.split(","))
        return spark.sql(f"SELECT {casts} FROM VALUES ({nulls}) AS t({names})").limit(0)
    body = ", ".join(f"({t})" for t in tuples)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")


def failing(df):
    """The same rows, but the job dies while it runs."""
    return df.withColumn(df.columns[0], F.when(F.lit(True), F.raise_error(F.lit("lost the source"))).otherwise(F.col(df.columns[0])))


def content(spark, result_or_path, schema=None):
    path = getattr(result_or_path, "dataset", result_or_path)
    schema = schema or getattr(result_or_path, "schema", None)
    return sorted(map(tuple, read_landed(spark, path, schema).collect()), key=repr)


def files(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*.parquet"))


def folders(path):
    return sorted({str(p.relative_to(path).parent) for p in Path(path).rglob("*.parquet")})


def leftovers(dataset):
    """Working files of loads that must not outlive them."""
    root = Path(dataset)
    inside = [p.name for p in root.glob("_*") if p.name != "_SUCCESS"] if root.exists() else []
    beside = [p.name for p in root.parent.glob("_*")]
    return inside + beside
