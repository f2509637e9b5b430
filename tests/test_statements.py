import pytest

from parcelmill.operators import matching, statements

ALLOWED = [
    "SELECT * FROM sold",
    "WITH x AS (SELECT 1 AS a) SELECT a FROM x",
    "select count(*) from sold where yr_mo = '2026-04'",
    "SELECT * FROM sold WHERE City = ';'",
    "SELECT * FROM sold -- todo: drop later",
    "SELECT replace(City, 'x', 'y') FROM sold",
    "SELECT * FROM sold WHERE City = 'a;b';",
    "/* insert */ SELECT 'it''s; drop' FROM sold",
    r"SELECT 'it\'s; drop' FROM sold",
    "SELECT a.x FROM a JOIN b USING (x)",
    "SELECT transform(array(1), v -> v + 1)",
    # The line comment goes on after the escaped line break, so nothing is called.
    "SELECT 1 -- ' \\\n ', reflect('x', 'y') -- '\n",
]
BLOCKED = [
    "DROP TABLE sold", "DELETE FROM sold", "INSERT INTO sold VALUES (1)", "UPDATE sold SET ClosePrice = 0",
    "CREATE TABLE t AS SELECT 1", "ATTACH 'x.db'", "COPY sold TO 'out.csv'", "SELECT 1; DROP TABLE sold",
    "SELECT * FROM read_text('/etc/hosts')", "SELECT * FROM read_csv_auto('/tmp/x.csv')",
    "SELECT * FROM glob('/tmp/*')", "WITH x AS (SELECT * FROM read_parquet('a.pq')) SELECT * FROM x",
    "SELECT * FROM text.`/etc/hosts`", "SELECT * FROM `csv` . `/etc/hosts`",
    "SELECT TRANSFORM (City) USING 'cat' AS c FROM sold", 'SELECT TRANSFORM (City) USING "cat" FROM sold',
    "SELECT reflect('java.lang.System', 'getenv')", "SELECT `java_method`('a', 'b')",
    "SELECT IDENTIFIER('reflect')('a', 'b')", "EXPLAIN SELECT 1", "",
    # Nothing may hide behind a quote or a comment mark.
    "SELECT '--'; DROP TABLE sold", "SELECT `a'`, reflect('x') FROM sold", r"SELECT r'\'; DROP TABLE sold --'",
    "SELECT 'a' /* ' */ ; DROP TABLE sold",
    # Spark nests comments, and ends line comments at a carriage return.
    "SELECT /* /* */ ' */ reflect('java.lang.System', 'getProperty', 'java.version') AS x -- '",
    "SELECT /* a /* b */ ' */ java_method('x', 'y') AS x -- '", "SELECT /* /* */ \" */ reflect('x', 'y') -- \"",
    "SELECT 1 /*/* */ ` */, reflect('x', 'y') -- `", "SELECT 1 -- \r, reflect('x', 'y')", "SELECT 1 /* open ' */ /* '",
]


@pytest.mark.parametrize("statement", ALLOWED)
def test_allowed(statement):
    assert statements.is_read_only(statement)


@pytest.mark.parametrize("statement", BLOCKED)
def test_blocked(statement):
    assert not statements.is_read_only(statement)


def test_column_form_agrees(spark):
    df = spark.createDataFrame([(s,) for s in ALLOWED + BLOCKED] + [(None,)], "statement string")
    got = {r["statement"]: r["allowed"] for r in statements.audit_statements(df).collect()}
    assert got == {**{s: True for s in ALLOWED}, **{s: False for s in BLOCKED}, None: False}


def test_guarded_run_caps_and_reports(spark):
    spark.range(100).createOrReplaceTempView("sold")
    assert statements.guarded_sql(spark, "SELECT id FROM sold;", 7).df.count() == 7
    assert statements.guarded_sql(spark, "DROP VIEW sold").error.startswith("rejected")
    broken = statements.guarded_sql(spark, "SELECT nothing FROM sold")
    assert broken.df is None and "nothing" in broken.error


def test_plan_is_tested_after_the_text(spark, tmp_path):
    plain = spark.sql("SELECT reflect('java.lang.System', 'getProperty', 'java.version') AS x")
    assert statements.blocked_in_plan(plain) == ["CallMethodViaReflection"]
    assert statements.blocked_in_plan(spark.sql("SELECT upper('x') AS x, sum(id) AS s FROM range(3) GROUP BY 1")) == []
    spark.range(3).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.runSQLOnFiles")
    spark.conf.set("spark.sql.runSQLOnFiles", "true")
    try:
        assert statements.guarded_sql(spark, f"SELECT * FROM delta.`{tmp_path}/t`").df is None
        assert statements.guarded_sql(spark, f"SELECT * FROM `parquet`.`{tmp_path}/t`").df is None
        assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"
    finally:
        spark.conf.set("spark.sql.runSQLOnFiles", before)


def test_answer_tells_when_it_is_cut(spark):
    spark.range(100).createOrReplaceTempView("sold")
    assert statements.guarded_sql(spark, "SELECT id FROM sold", 99).truncated()
    assert not statements.guarded_sql(spark, "SELECT id FROM sold", 100).truncated()


def test_description_carries_notes(spark):
    df = statements.with_notes(spark.createDataFrame([("x", 1), (None, 2)], "City string, n int"), {"City": "city"})
    got = [tuple(r) for r in statements.describe_table(df).collect()]
    assert got == [("City", "string", "city", 1), ("n", "int", None, 2)]


def test_results_match_as_sets(spark):
    one = spark.createDataFrame([("a", 1.04), ("a", 1.04), ("b", None)], "k string, v double")
    two = spark.createDataFrame([(None, "b"), (1.0, " a ")], "x double, y string")
    row = matching.compare_results(one, two).first()
    assert row["same"] and row["shared"] == 2
    # A text number counts as a number; a repeat within a row counts once.
    three = spark.createDataFrame([("1.00", 1.0)], "k string, v double")
    four = spark.createDataFrame([(1.0,)], "v double")
    assert matching.compare_results(three, four).first()["same"]
    assert not matching.compare_results(one, four).first()["same"]


def test_attempt_scores(spark):
    rows = [("m", 1, t, o) for t, o in enumerate(["correct", "correct", "wrong"])]
    rows += [("m", 2, t, "exec_error") for t in range(3)]
    row = matching.score_attempts(
        spark.createDataFrame(rows, "model string, question int, trial int, outcome string")).first()
    assert (row["accuracy"], row["solved_questions"], row["stable_questions"], row["n_questions"]) == (0.333, 1, 1, 2)
    assert (row["correct"], row["wrong"], row["exec_error"], row["guard_reject"]) == (2, 1, 3, 0)


def _tables(spark):
    return {"sold": spark.createDataFrame([(1, "x"), (2, "y")], "id int, City string")}


@pytest.mark.parametrize("statement", [
    "SELECT id AS `set` FROM sold",
    "WITH t AS (SELECT id, City FROM sold) SELECT a.City FROM t a JOIN sold b ON a.id = b.id AND a.id > 0",
    "SELECT City, row_number() OVER (ORDER BY id) AS n FROM sold WHERE id = (SELECT max(id) FROM sold)",
    "SELECT id, w FROM sold LATERAL VIEW explode(split(City, '')) t AS w",
    "SELECT s.id, m.n FROM sold s CROSS JOIN (SELECT count(*) AS n FROM sold) m",
    "SELECT id FROM sold WHERE City IN (SELECT City FROM sold) UNION SELECT id FROM range(5) ORDER BY id LIMIT 1",
    "SELECT to_json(named_struct('a', id)), upper(City), try_divide(id, 2) FROM sold",
])
def test_plan_allows(spark, statement):
    answer = statements.guarded_sql(spark, statement, tables=_tables(spark))
    assert answer.error is None and answer.df.count() > 0


@pytest.mark.parametrize("statement", [
    "SELECT * FROM host_lines()",
    "SELECT id FROM sold WHERE id IN (SELECT n FROM host_lines())",
    "SELECT own(id) FROM sold",
    "SELECT id FROM sold WHERE id = (SELECT max(own(id)) FROM sold)",
    "SELECT * FROM other",
    "WITH other AS (SELECT 1 AS a) SELECT * FROM global_temp.elsewhere",
    "SELECT count(*) FROM range(100000000)",
    "SELECT count(*) FROM sold a CROSS JOIN sold b",
    "SELECT count(*) FROM sold a JOIN sold b ON a.id < b.id",
    "SELECT (SELECT count(*) FROM sold a JOIN sold b ON a.id = b.id OR a.City = b.City) AS n",
])
def test_plan_refuses(spark, statement):
    from pyspark.sql.functions import udtf

    @udtf(returnType="n int")
    class HostLines:
        def eval(self):
            yield 1,

    spark.udtf.register("host_lines", HostLines)
    spark.udf.register("own", lambda x: x, "int")
    spark.range(1).createOrReplaceTempView("other")
    spark.range(1).createOrReplaceGlobalTempView("elsewhere")
    assert "rejected" in statements.guarded_sql(spark, statement, tables=_tables(spark)).error


def test_given_tables_leave_no_view_behind(spark):
    spark.range(7).createOrReplaceTempView("sold")
    answer = statements.guarded_sql(spark, "SELECT count(*) AS n FROM sold", tables=_tables(spark))
    assert answer.df.first()["n"] == 2 and spark.table("sold").count() == 7
    spark.catalog.dropTempView("sold")
    assert statements.guarded_sql(spark, "SELECT count(*) AS n FROM sold", tables=_tables(spark)).df.first()["n"] == 2
    assert not spark.catalog.tableExists("sold")
