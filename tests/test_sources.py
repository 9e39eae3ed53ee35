"""Type maps, column catalog, query texts, and the JDBC options and statements (no database needed)."""

import re
from datetime import date, datetime

import pytest
from helpers import content, values
from pyspark.sql import functions as F

from haulier import SchemaError, full_load, task_from_mapping
from haulier.errors import ContractError
from haulier.plans.replicate import open_source
from haulier.sources import jdbc
from haulier.sources.tables import column_catalog, lower_bound, read_query, single_statement
from haulier.sources.types import normalize_types

ALL_TYPES = """
SELECT true AS b, CAST(1 AS TINYINT) AS i1, CAST(2 AS SMALLINT) AS i2, 3 AS i4, 4L AS i8,
    CAST(1.5 AS FLOAT) AS f4, 2.5D AS f8, CAST(12345.6789 AS DECIMAL(20,4)) AS n, 'text  ' AS s,
    DATE'2024-02-29' AS d, TIMESTAMP'2024-02-29 01:02:03.5Z' AS tz, TIMESTAMP_NTZ'2024-02-29 01:02:03.5' AS t,
    X'00FF41' AS bin, array(1, 2) AS arr, map('k', 1) AS m, named_struct('x', 1) AS st,
    TIME'01:02:03.25' AS tm, TIMESTAMP_NTZ'1970-01-01 04:05:06.25' AS jt, TIMESTAMP_NTZ'1970-01-01 04:05:06' AS jw,
    INTERVAL '1' DAY AS iv
"""


def types_of(frame):
    return {f.name: f.dataType.simpleString() for f in frame.schema.fields}


def test_postgresql_types(spark):
    frame = normalize_types(spark.sql(ALL_TYPES), "postgresql", time_columns=["jt", "jw"])
    assert types_of(frame) == {
        "b": "boolean", "i1": "tinyint", "i2": "smallint", "i4": "int", "i8": "bigint", "f4": "float", "f8": "double",
        "n": "double", "s": "string", "d": "date", "tz": "timestamp", "t": "timestamp_ntz", "bin": "string",
        "arr": "string", "m": "string", "st": "string", "tm": "string", "jt": "string", "jw": "string", "iv": "string",
    }
    row = frame.first()
    assert (row.n, row.s, row.bin, row.arr, row.m, row.st) == (12345.6789, "text  ", "\\x00ff41", "[1,2]", '{"k":1}', '{"x":1}')
    assert (row.tm, row.jt, row.jw) == ("01:02:03.25", "04:05:06.25", "04:05:06")


def test_sqlserver_types(spark):
    frame = normalize_types(spark.sql(ALL_TYPES), "sqlserver")
    got = types_of(frame)
    assert {got[c] for c in ("i1", "i2", "i4", "i8")} == {"bigint"}
    assert (got["b"], got["f4"], got["n"], got["bin"]) == ("boolean", "double", "double", "binary")


def test_decimals_can_stay(spark):
    assert types_of(normalize_types(spark.sql(ALL_TYPES), numeric="decimal"))["n"] == "decimal(20,4)"
    for bad in ({"numeric": "float"}, {"source_type": "oracle"}):
        with pytest.raises(ContractError):
            normalize_types(spark.sql(ALL_TYPES), **bad)


def test_every_landing_type_can_be_written(spark, dataset):
    frame = normalize_types(spark.sql(ALL_TYPES), "postgresql", time_columns=["jt", "jw"])
    row = content(spark, full_load(frame, dataset))[0]
    assert row[9:12] == (date(2024, 2, 29), datetime(2024, 2, 29, 1, 2, 3, 500000), datetime(2024, 2, 29, 1, 2, 3, 500000))


def test_column_catalog(spark):
    rows = column_catalog(values(spark, "id INT, `odd` DATE".replace("`", ""), "1, NULL")).collect()
    assert [(r.name, r.data_type, r.ordinal_position) for r in rows] == [("id", "int", 1), ("odd", "date", 2)]
    with pytest.raises(SchemaError):
        column_catalog(spark.range(1).select())


def test_query_text(spark):
    assert single_statement(" SELECT 1 AS x ;\n") == "SELECT 1 AS x"
    assert read_query(spark, "SELECT 1 AS x;").first().x == 1
    with pytest.raises(ContractError):
        single_statement(" ; ")
    with pytest.raises(SchemaError):
        lower_bound(spark.range(3), "ID", 1)


def test_default_query():
    assert jdbc.default_query("postgresql", "public", 'o"dd', ["id", "$x"]) == 'SELECT "id", "$x" FROM "public"."o""dd"'
    assert jdbc.default_query("sqlserver", "dbo", "Posts", ["Id", "a]b"]) == "SELECT [Id], [a]]b] FROM [dbo].[Posts]"
    for schema, columns in ((None, ["id"]), ("", ["id"]), ("public", [])):
        with pytest.raises(SchemaError):
            jdbc.default_query("postgresql", schema, "t", columns)


def test_catalog_query():
    text = jdbc.catalog_query("postgresql", "public", "it's")
    assert "udt_name AS udt_name" in text and "table_name = 'it''s'" in text
    assert "udt_name" not in jdbc.catalog_query("sqlserver", "dbo", "t")


def test_reader_options():
    options = jdbc.reader_options({"url": "jdbc:x", "user": "u"}, "sqlserver", 50000)
    assert options["fetchsize"] == "50000" and options["preferTimestampNTZ"] == "true"
    assert options["sessionInitStatement"] == "SET DATEFORMAT ymd"
    assert "sessionInitStatement" not in jdbc.reader_options({"url": "jdbc:x"}, "postgresql")
    assert "fetchsize" not in jdbc.reader_options({"url": "jdbc:x"}, "postgresql")
    with pytest.raises(ContractError):
        jdbc.reader_options({}, "postgresql")


def test_range_split():
    assert jdbc.RangeSplit("id", 0, 100, 4).options() == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    with pytest.raises(ContractError):
        jdbc.RangeSplit("id", 0, 100, 0).options()


def test_maximum_query():
    assert jdbc.maximum_query("sqlserver", "SELECT * FROM t;", "At") == "SELECT MAX([At]) AS highest_value FROM (SELECT * FROM t) AS src"


@pytest.mark.parametrize("granularity", ["year", "month", "day"])
def test_period_predicates_cover_every_row_once(spark, granularity):
    rows = spark.sql(
        """SELECT explode(sequence(DATE'2023-11-01', DATE'2024-03-31', INTERVAL 1 DAY)) AS d
        UNION ALL SELECT NULL UNION ALL SELECT DATE'1990-01-01' UNION ALL SELECT DATE'2050-01-01'"""
    )
    predicates = jdbc.period_predicates("d", granularity, date(2023, 12, 15), date(2024, 2, 10), "postgresql")
    # the same predicates, evaluated by Spark
    hits = [F.when(F.expr(p.replace('"d"', "d")), 1).otherwise(0) for p in predicates]
    total = hits[0]
    for hit in hits[1:]:
        total = total + hit
    assert rows.filter(total != 1).count() == 0
    assert "'20231201'" in jdbc.period_predicates("d", "month", date(2023, 12, 15), date(2024, 2, 10), "sqlserver")[0]


def hits(predicates, column="d"):
    """How many predicates hold for a row, evaluated by Spark."""
    plain = [re.sub(r"'(\d{8})'", lambda m: f"DATE'{m[1][:4]}-{m[1][4:6]}-{m[1][6:]}'", p) for p in predicates]
    plain = [re.sub(r"(?<!TIMESTAMP )'(\d{4}-\d\d-\d\dT[\d:]+)'", r"TIMESTAMP_NTZ'\1'", p).replace("TIMESTAMP '", "TIMESTAMP_NTZ'") for p in plain]
    held = [F.when(F.expr(p.replace(f'"{column}"', column).replace(f"[{column}]", column)), 1).otherwise(0) for p in plain]
    return held


def skewed(spark):
    """Half of all rows on one day, the rest over three years, some NULL."""
    return spark.sql(
        """SELECT CAST(TIMESTAMP_NTZ'2022-01-01 00:00:00' + make_dt_interval(CAST(id % 1095 AS INT), 0, 0, id % 86400) AS TIMESTAMP_NTZ) AS d FROM range(20000)
        UNION ALL SELECT TIMESTAMP_NTZ'2023-05-17 00:00:00' + make_dt_interval(0, 0, 0, id * 4) FROM range(20000)
        UNION ALL SELECT CAST(NULL AS TIMESTAMP_NTZ) FROM range(500)"""
    )


@pytest.mark.parametrize("dialect", ["postgresql", "sqlserver"])
@pytest.mark.parametrize("granularity", ["year", "month", "day"])
@pytest.mark.parametrize("timestamps", [True, False])
def test_even_splits_follow_the_counts(spark, dialect, granularity, timestamps):
    rows = skewed(spark) if timestamps else skewed(spark).select(F.col("d").cast("date").alias("d"))
    counts = rows.groupBy(F.trunc(F.col("d").cast("date"), granularity).alias("p") if granularity != "day" else F.col("d").cast("date").alias("p")).count()
    split = jdbc.EvenSplit("d", 12, granularity, timestamps)
    predicates = jdbc.even_predicates([tuple(r) for r in counts.collect()], split, dialect)
    outside = spark.sql("SELECT TIMESTAMP_NTZ'1970-01-01 00:00:00' AS d UNION ALL SELECT TIMESTAMP_NTZ'2099-01-01 00:00:00'")
    every = rows.unionByName(outside.select(F.col("d").cast(rows.schema["d"].dataType)))
    held = hits(predicates)
    total = sum(held[1:], held[0])
    assert every.filter(total != 1).count() == 0
    sizes = every.agg(*[F.sum(h).alias(str(i)) for i, h in enumerate(held)]).first()
    assert sizes[-1] == 500 and len(predicates) <= 2 * 12 + 2
    if granularity == "day":
        # A day of dates cannot be cut; the others are still shared out.
        assert sorted(sizes)[-1 if timestamps else -2] <= 2 * 40000 / 12


def test_even_splits_of_little():
    split = jdbc.EvenSplit("d", 4)
    assert jdbc.even_predicates([], split, "postgresql") == ['"d" IS NOT NULL', '"d" IS NULL']
    assert jdbc.even_predicates([(None, 9), (date(2024, 1, 1), 2)], jdbc.EvenSplit("d", 1), "sqlserver") == ["[d] IS NOT NULL", "[d] IS NULL"]
    with pytest.raises(ContractError):
        jdbc.EvenSplit("d", 0)
    with pytest.raises(Exception):  # noqa: B017
        jdbc.period_counts_query("postgresql", "SELECT 1", jdbc.EvenSplit("d", 2, "week"))


def test_counts_are_asked_of_the_database_in_one_query(spark):
    counts = spark.sql("SELECT DATE'2024-01-01' AS period, 30L AS n UNION ALL SELECT DATE'2024-02-01', 30L UNION ALL SELECT NULL, 1L")
    database = RecordingSession([("GROUP BY", counts), ("", spark.sql("SELECT TIMESTAMP_NTZ'2024-01-05 00:00:00' AS d"))])
    jdbc.read_jdbc(database, {"url": "jdbc:x"}, "postgresql", None, "t", query="SELECT * FROM t", split=jdbc.EvenSplit("d", 2, "month"))
    counted, read = database.asked
    assert counted["dbtable"] == (
        "(SELECT CAST(DATE_TRUNC('month', \"d\") AS date) AS period, COUNT(*) AS n FROM (SELECT * FROM t) AS src "
        "GROUP BY CAST(DATE_TRUNC('month', \"d\") AS date)) AS src"
    )
    assert read["predicates"] == ["\"d\" < DATE '2024-02-01'", "\"d\" >= DATE '2024-02-01'", '"d" IS NULL']
    assert "DATEFROMPARTS(YEAR([d]), MONTH([d]), 1)" in jdbc.period_counts_query("sqlserver", "SELECT 1", jdbc.EvenSplit("d", 2, "month"))
    task = task_from_mapping(
        {
            "table": {"schema_name": "dbo", "name": "t", "target_schema_name": "raw", "target_name": "t"},
            "source": {"type": "postgresql", "runtime": "db", "query_path": "q.sql"},
            "target": {"type": "local", "runtime": "out"},
            "replication": {"mode": "full_load"},
        }
    )
    open_source(database, task, {"db": {"url": "jdbc:x", "split": {"column": "d", "parts": 2}}}, {"q.sql": "SELECT * FROM t"})
    assert len(database.asked[-1]["predicates"]) == 3


class RecordingSession:
    """Stands in for the session: records what the JDBC reader is asked and answers with given frames."""

    def __init__(self, answers):
        self.answers, self.asked = answers, []
        self.read = self

    def format(self, name):
        assert name == "jdbc"
        self._options = {}
        return self

    def options(self, **options):
        self._options.update(options)
        return self

    def option(self, key, value):
        self._options[key] = value
        return self

    def load(self):
        return self._answer(self._options)

    def jdbc(self, url, table, predicates, properties):
        return self._answer({"url": url, "dbtable": table, "predicates": predicates, **properties})

    def _answer(self, options):
        self.asked.append(options)
        return next(frame for key, frame in self.answers if key in options["dbtable"])


@pytest.fixture
def database(spark):
    catalog = spark.sql(
        """SELECT * FROM VALUES ('at', 'time without time zone', 'NO', 2), ('n', 'numeric', 'YES', 1)
        AS t(name, data_type, nullable, ordinal_position)"""
    )
    rows = spark.sql("SELECT CAST(1.5 AS DECIMAL(9,2)) AS n, TIMESTAMP_NTZ'1970-01-01 08:00:00' AS at")
    top = spark.sql("SELECT 7 AS highest_value")
    return RecordingSession([("information_schema", catalog), ("MAX(", top), ("", rows)])


def test_table_read(database):
    frame = jdbc.read_jdbc(database, {"url": "jdbc:x"}, "postgresql", "public", "t", chunk_size=50000)
    assert tuple(frame.first()) == (1.5, "08:00:00")
    asked = database.asked[-1]
    # columns in ordinal order, one query, fetched in chunks
    assert asked["dbtable"] == '(SELECT "n", "at" FROM "public"."t") AS src'
    assert asked["fetchsize"] == "50000" and "numPartitions" not in asked


def test_query_and_split_reads(database):
    connection = {"url": "jdbc:x", "user": "u"}
    jdbc.read_jdbc(database, connection, "sqlserver", None, "t", query="SELECT 1;", split=jdbc.RangeSplit("n", 0, 9, 3))
    assert database.asked[-1]["dbtable"] == "(SELECT 1) AS src" and database.asked[-1]["numPartitions"] == "3"
    jdbc.read_jdbc(database, connection, "postgresql", None, "t", query="SELECT 1", split=["n < 5", "n >= 5 OR n IS NULL"])
    assert database.asked[-1]["predicates"] == ["n < 5", "n >= 5 OR n IS NULL"] and database.asked[-1]["url"] == "jdbc:x"
    assert len(database.asked) == 2
    with pytest.raises(SchemaError):
        jdbc.read_jdbc(database, connection, "postgresql", None, "t")


def test_split_append_fixes_its_upper_edge(database):
    task = task_from_mapping(
        {
            "table": {"schema_name": "public", "name": "t", "target_schema_name": "raw", "target_name": "t"},
            "source": {"type": "postgresql", "runtime": "db", "chunk_size": 10},
            "target": {"type": "local", "runtime": "out"},
            "replication": {"mode": "incremental", "strategy": {"type": "append", "reference_column": "n"}},
        }
    )
    settings = {"url": "jdbc:x", "split": jdbc.RangeSplit("n", 0, 9, 3), "numeric": "decimal"}
    opened = open_source(database, task, {"db": settings})
    assert opened.upper_bound == 7 and opened.shaped().schema["n"].dataType.simpleString() == "decimal(9,2)"
    assert database.asked[-1]["dbtable"] == '(SELECT MAX("n") AS highest_value FROM (SELECT "n", "at" FROM "public"."t") AS src) AS src'
    assert "split" not in database.asked[-1]
    from_file = {"url": "jdbc:x", "split": {"column": "n", "lower": 0, "upper": 9, "partitions": 3}}
    assert open_source(database, task, {"db": from_file}).upper_bound == 7
    opened = open_source(database, task, {"db": {"url": "jdbc:x"}})
    assert opened.upper_bound == 7  # one query may run twice, too
    # bounds are compared with the delivered column; the cast to the landing type comes behind them
    assert opened.rows.schema["n"].dataType.simpleString() == "decimal(9,2)"
    assert opened.shaped().schema["n"].dataType.simpleString() == "double"


def test_time_fields_are_known_by_the_mark_of_the_reader(spark):
    """A user query has no catalog entry, but Spark's JDBC reader marks fields that hold a time of day."""
    rows = spark.sql("SELECT TIMESTAMP_NTZ'1970-01-01 08:00:00' AS at, TIMESTAMP_NTZ'1970-01-01 08:00:00' AS ts")
    marked = rows.withMetadata("at", {"logical_time_type": True})
    assert tuple(normalize_types(marked).first())[0] == "08:00:00"
    assert normalize_types(marked).schema["ts"].dataType.simpleString() == "timestamp_ntz"
