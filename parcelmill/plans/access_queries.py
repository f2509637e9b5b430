"""Read-only SQL, result comparison, scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.functions.quantiles import median, summarise
from parcelmill.operators import matching, ranking, statements
from parcelmill.operators.clean import homes_only
from parcelmill.plans import stages
from parcelmill.plans.registry import query
from parcelmill.plans.views import sold_rows, table

#: What a reader of the sold table cannot see from names and types: unit or
#: form, and which values occur.
_MONEY, _SHARE, _DAYS = "US dollars, above 0", "a ratio, 1 means equal", "whole days, 0 or more"
SOLD_NOTES = {
    **dict.fromkeys(("ClosePrice", "ListPrice", "OriginalListPrice"), _MONEY),
    **dict.fromkeys(("price_ratio", "close_to_original_list_ratio"), _SHARE),
    **dict.fromkeys(("DaysOnMarket", "listing_to_contract_days", "contract_to_close_days"), _DAYS),
    "price_per_sqft": "US dollars for one square foot",
    "LivingArea": "square feet, above 0",
    "BedroomsTotal": "count, 0 or more",
    "BathroomsTotalInteger": "count, 0 or more",
    "CloseDate": "day, ISO form",
    "yr_mo": "month of CloseDate as text, like 2024-05",
    "close_year": "year of CloseDate",
    "close_month": "month of CloseDate, 1 = January",
    "Latitude": "degrees north",
    "Longitude": "degrees east, so below 0",
    "CountyOrParish": "name without the word County",
    "City": "name, spelled as delivered",
    "PostalCode": "text, keeps leading zeros",
    "PropertyType": "one value only after the type filter",
}


# --- reference questions ----------------------------------------------------
# Counting questions are plain SQL text. Questions with a median use the
# grouped quantiles, which a single very large group cannot overload.

def _clean(spark, folder, *columns: str) -> DataFrame:
    return stages.sold_clean(spark, folder, list(columns))


def _ask(spark, text: str, sold: DataFrame) -> DataFrame:
    return spark.sql(text, sold=sold)


@query("gold_q1", "SELECT yr_mo, count(*) AS n FROM sold_clean WHERE close_year = 1997 GROUP BY yr_mo",
       needs=("sold_clean",))
def gold_q1(spark, folder):
    return _ask(spark, "SELECT yr_mo, count(*) AS n FROM {sold} WHERE close_year = 1997 GROUP BY yr_mo",
                _clean(spark, folder, "yr_mo", "close_year"))


@query("gold_q2", """
SELECT CountyOrParish, round(median(ClosePrice), 6) AS median_price FROM sold_clean
WHERE yr_mo = '1997-04' AND CountyOrParish IS NOT NULL GROUP BY 1 ORDER BY median(ClosePrice) DESC, 1 LIMIT 5""",
       needs=("sold_clean",))
def gold_q2(spark, folder):
    rows = _clean(spark, folder, "CountyOrParish", "ClosePrice", "yr_mo").filter(F.col("yr_mo") == "1997-04")
    return ranking.top_groups_by_median(rows, "CountyOrParish", "ClosePrice", 5).select(
        "CountyOrParish", F.col("median_value").alias("median_price"))


@query("gold_q3", "SELECT count(*) AS n FROM sold_clean WHERE CountyOrParish = 'NATION_7' AND close_year = 1997",
       needs=("sold_clean",))
def gold_q3(spark, folder):
    return _ask(
        spark, "SELECT count(*) AS n FROM {sold} WHERE CountyOrParish = 'NATION_7' AND close_year = 1997",
        _clean(spark, folder, "CountyOrParish", "close_year"))


@query("gold_q4", "SELECT round(median(ClosePrice), 6) AS median_price FROM sold_clean WHERE CountyOrParish = 'NATION_7'",
       needs=("sold_clean",))
def gold_q4(spark, folder):
    rows = _clean(spark, folder, "CountyOrParish", "ClosePrice").filter(F.col("CountyOrParish") == "NATION_7")
    return summarise(rows, (), (), [median("ClosePrice", "median_price")])


@query("gold_q5", """
SELECT count(*) AS n FROM sold_clean WHERE yr_mo = '1997-04' AND PropertySubType = 'STEEL'""",
       needs=("sold_clean",))
def gold_q5(spark, folder):
    return _ask(
        spark, "SELECT count(*) AS n FROM {sold} WHERE yr_mo = '1997-04' AND PropertySubType = 'STEEL'",
        _clean(spark, folder, "yr_mo", "PropertySubType"))


_Q6 = """SELECT CountyOrParish, count(*) AS n FROM {s} WHERE CountyOrParish IS NOT NULL
GROUP BY CountyOrParish ORDER BY n DESC, CountyOrParish LIMIT 3"""


@query("gold_q6", _Q6.format(s="sold_clean"), needs=("sold_clean",))
def gold_q6(spark, folder):
    return _ask(spark, _Q6.format(s="{sold}"), _clean(spark, folder, "CountyOrParish"))


@query("gold_q7", """
SELECT PropertySubType, round(median(ClosePrice), 6) AS median_price FROM sold_clean WHERE close_year = 1997
GROUP BY PropertySubType""", needs=("sold_clean",))
def gold_q7(spark, folder):
    rows = _clean(spark, folder, "PropertySubType", "ClosePrice", "close_year").filter("close_year = 1997")
    return summarise(rows, ["PropertySubType"], (), [median("ClosePrice", "median_price")])


@query("gold_q8", """
SELECT City FROM sold_clean GROUP BY City
ORDER BY count(*) FILTER (yr_mo = '1997-04') - count(*) FILTER (yr_mo = '1997-03') DESC, City LIMIT 3""",
       needs=("sold_clean",))
def gold_q8(spark, folder):
    rows = _clean(spark, folder, "City", "yr_mo")
    return ranking.growth_leaders(rows, "City", "1997-03", "1997-04", 3).select("City")


# --- result comparison -----------------------------------------------------

_CELLS = """list_sort(list_distinct([{cells}]))"""


def _cell(c):
    return (f"coalesce(cast(round(try_cast(cast({c} AS varchar) AS double), 1) AS varchar),"
            f" trim(cast({c} AS varchar)), 'nan')")


def _match_sql(columns: str, one: list[str], two: list[str]) -> str:
    return f"""
SELECT {columns}
FROM (SELECT cells, bool_or(side = 1) AS l, bool_or(side = 2) AS r FROM (
  SELECT {_CELLS.format(cells=', '.join(map(_cell, one)))} AS cells, 1 AS side FROM one
  UNION ALL
  SELECT {_CELLS.format(cells=', '.join(map(_cell, two)))}, 2 FROM two) u GROUP BY cells) t"""


_DIFFER = """count(*) FILTER (l AND NOT r) AS left_only, count(*) FILTER (r AND NOT l) AS right_only,
  count(*) FILTER (l <> r) = 0 AS same"""
_MATCH = f"{_DIFFER}, count(*) FILTER (l AND r) AS shared"
_ONE_SQL = "SELECT CountyOrParish, count(*) AS n, avg(DaysOnMarket) AS m FROM sold GROUP BY 1"
_TWO_SQL = """SELECT avg(DaysOnMarket) AS m, ' ' || CountyOrParish || ' ' AS place, count(ClosePrice) AS n
         FROM sold{where} GROUP BY CountyOrParish"""


def _two_results(rows, other):
    """The same question asked twice, with other names, order and spacing."""
    one = rows.groupBy("CountyOrParish").agg(
        F.count(F.lit(1)).alias("n"), F.avg("DaysOnMarket").alias("m"))
    two = other.groupBy("CountyOrParish").agg(
        F.avg("DaysOnMarket").alias("m"), F.count("ClosePrice").alias("n")
    ).select("m", F.concat(F.lit(" "), "CountyOrParish", F.lit(" ")).alias("place"), "n")
    return one, two


@query("result_match", _match_sql(_MATCH, ["CountyOrParish", "n", "m"], ["m", "place", "n"]), needs=("sold",),
       one=_ONE_SQL, two=_TWO_SQL.format(where=" WHERE CountyOrParish <> 'NATION_9'"))
def result_match(spark, folder):
    rows = stages.sold(spark, folder)
    return matching.compare_results(*_two_results(rows, rows.filter(F.col("CountyOrParish") != "NATION_9")))


@query("result_match_whole", _match_sql(_MATCH, ["CountyOrParish", "n", "m"], ["m", "place", "n"]), needs=("sold",),
       one=_ONE_SQL, two=_TWO_SQL.format(where=""))
def result_match_whole(spark, folder):
    rows = stages.sold(spark, folder)
    return matching.compare_results(*_two_results(rows, rows))


# Two row-level results that differ in the homes of one year.
@query("result_differences", _match_sql(_DIFFER, ["ListingKey", "days", "price"], ["price", "days", "ListingKey"]),
       needs=("sold",),
       one="SELECT ListingKey, DaysOnMarket AS days, ClosePrice AS price FROM sold",
       two="""SELECT ClosePrice AS price, DaysOnMarket + CASE WHEN YearBuilt = 1960 THEN 5000 ELSE 0 END AS days, ListingKey
         FROM sold""")
def result_differences(spark, folder):
    rows = stages.sold_staged(spark, folder, ["ListingKey", "DaysOnMarket", "ClosePrice", "YearBuilt"])
    one = rows.select("ListingKey", F.col("DaysOnMarket").alias("days"), F.col("ClosePrice").alias("price"))
    moved = F.when(F.col("YearBuilt") == 1960, 5000).otherwise(0)
    two = rows.select(F.col("ClosePrice").alias("price"), (F.col("DaysOnMarket") + moved).alias("days"), "ListingKey")
    return matching.differences(one, two)


# Attempts: events as trials of questions, the outcome spread by event number.
_ATTEMPTS = """SELECT event_type AS model, user_id % 40 AS question, event_id AS trial,
  CASE (user_id % 40 + event_id // 997) % 6 WHEN 0 THEN 'wrong' WHEN 1 THEN 'exec_error' WHEN 2 THEN 'guard_reject'
    WHEN 3 THEN 'llm_fail' ELSE 'correct' END AS outcome FROM events"""


@query("attempt_rollup", """
SELECT model, cast(sum(k) AS bigint) AS total_trials, cast(sum(correct) AS bigint) AS correct,
  cast(sum(wrong) AS bigint) AS wrong, cast(sum(exec_error) AS bigint) AS exec_error,
  cast(sum(guard_reject) AS bigint) AS guard_reject, cast(sum(llm_fail) AS bigint) AS llm_fail,
  count(*) AS n_questions, count(*) FILTER (correct >= 2) AS solved_questions,
  count(*) FILTER (kinds = 1) AS stable_questions, round(sum(correct) / sum(k), 3) AS accuracy
FROM (SELECT model, question, count(*) AS k, count(*) FILTER (outcome = 'correct') AS correct,
  count(*) FILTER (outcome = 'wrong') AS wrong, count(*) FILTER (outcome = 'exec_error') AS exec_error,
  count(*) FILTER (outcome = 'guard_reject') AS guard_reject, count(*) FILTER (outcome = 'llm_fail') AS llm_fail,
  count(DISTINCT outcome) AS kinds FROM attempts GROUP BY 1, 2) q GROUP BY model""", attempts=_ATTEMPTS)
def attempt_rollup(spark, folder):
    question = F.col("user_id") % 40
    spread = (question + F.floor(F.col("event_id") / 997)) % 6
    outcome = (
        F.when(spread == 0, "wrong").when(spread == 1, "exec_error").when(spread == 2, "guard_reject")
        .when(spread == 3, "llm_fail").otherwise("correct")
    )
    return matching.score_attempts(table(spark, folder, "events").select(
        F.col("event_type").alias("model"), question.alias("question"), F.col("event_id").alias("trial"),
        outcome.alias("outcome")))


# --- statement audit -------------------------------------------------------
# One statement per order, built from its values: harmless and harmful forms.

#: (statement, whether it may run). The verdict is stated, not worked out from
#: patterns, so the check does not share a mistake with the gate.
_FORMS = [
    ("SELECT * FROM sold WHERE City = '{p}'", True),
    ("with x as (select {k} as a) select a from x", True),
    ("SELECT count(*) FROM sold WHERE City = ';' -- {p} drop later", True),
    ("SELECT replace(City, 'update', '{p}') FROM sold;", True),
    ("DROP TABLE sold_{k}", False),
    ("DELETE FROM sold WHERE id = {k}", False),
    ("SELECT {k}; DROP TABLE sold", False),
    ("SELECT * FROM read_text('/data/{k}')", False),
    ("WITH x AS (SELECT * FROM read_parquet('a{k}.pq')) SELECT * FROM x", False),
    ("SELECT '--', {k}; UPDATE sold SET City = '{p}'", False),
    ("SELECT * FROM csv.`/data/{k}`", False),
    ("SELECT TRANSFORM (City) USING 'cat' FROM sold LIMIT {k}", False),
    ("SELECT reflect('java.lang.System', 'getenv', '{p}')", False),
    ("/* {p} */ SELECT a.City FROM sold a JOIN sold b USING (City) LIMIT {k}", True),
    ("EXPLAIN SELECT {k}", False),
    ("SELECT /* insert */ 'copy ' || City FROM sold WHERE id > {k}", True),
    ("SELECT /* /* */ ' */ reflect('java.lang.System', 'getProperty', '{p}') AS x -- '", False),
    ("SELECT /*/* {k} */ ` */ java_method('a', '{p}') -- `", False),
    ("SELECT {k} /* left open ' */ /* '", False),
    ("SELECT id AS `set`, `drop` FROM sold WHERE id = {k}", True),
]


def _form_sql():
    cases = []
    for i, (form, _) in enumerate(_FORMS):
        text = form.replace("'", "''").replace("{p}", "' || o_orderpriority || '").replace(
            "{k}", "' || cast(o_orderkey AS varchar) || '")
        cases.append(f"WHEN {i} THEN '{text}'")
    return f"CASE o_orderkey % {len(_FORMS)} " + " ".join(cases) + " END"



@query("statement_audit", "SELECT o_orderkey, statement, CASE o_orderkey % " + str(len(_FORMS)) + " "
       + " ".join(f"WHEN {i} THEN {str(ok).lower()}" for i, (_, ok) in enumerate(_FORMS))
       + " END AS allowed FROM statements", statements=f"SELECT o_orderkey, {_form_sql()} AS statement FROM orders")
def statement_audit(spark, folder):
    orders = table(spark, folder, "orders")
    made = None
    for i, (form, _) in enumerate(_FORMS):
        text = F.replace(F.replace(F.lit(form), F.lit("{p}"), F.col("o_orderpriority")),
                         F.lit("{k}"), F.col("o_orderkey").cast("string"))
        hit = F.col("o_orderkey") % len(_FORMS) == i
        made = F.when(hit, text) if made is None else made.when(hit, text)
    return statements.audit_statements(orders.select("o_orderkey", made.alias("statement")))


# --- guarded run and description -------------------------------------------

_GUARDED = """SELECT City, PropertySubType, count(*) AS n, max(ClosePrice) AS max_price FROM {s}
WHERE yr_mo >= '1996-01' GROUP BY City, PropertySubType"""


@query("guarded_query", "SELECT City, PropertySubType, n, round(max_price, 6) AS max_price FROM ("
       + _GUARDED.format(s="sold_clean") + ") t", needs=("sold_clean",))
def guarded_query(spark, folder):
    rows = _clean(spark, folder, "City", "PropertySubType", "yr_mo", "ClosePrice")
    answer = statements.guarded_sql(spark, _GUARDED.format(s="sold") + ";", tables={"sold": rows})
    if answer.error:
        raise RuntimeError(answer.error)
    return answer.df


@query("guarded_query_capped", """
SELECT 3 AS rows, true AS cut, cast(sum(n) AS bigint) AS rows_behind FROM (SELECT City, count(*) AS n FROM sold_clean
  GROUP BY City ORDER BY n DESC, City LIMIT 3) t""", needs=("sold_clean",))
def guarded_query_capped(spark, folder):
    """A result longer than the cap: its first rows, and the mark that says so."""
    answer = statements.guarded_sql(
        spark, "SELECT City, count(*) AS n FROM sold GROUP BY City ORDER BY n DESC, City", 3,
        tables={"sold": _clean(spark, folder, "City")})
    return answer.df.agg(F.count(F.lit(1)).alias("rows"), F.lit(answer.truncated()).alias("cut"),
                         F.sum("n").alias("rows_behind"))


_DESCRIBED = ["ListingKey", "CountyOrParish", "City", "CloseDate", "ClosePrice", "LivingArea", "BedroomsTotal",
              "DaysOnMarket", "Latitude"]
_TYPES = {"CloseDate": "date", "ClosePrice": "double", "LivingArea": "double", "BedroomsTotal": "int",
          "DaysOnMarket": "int", "Latitude": "double"}


@query("table_description", " UNION ALL ".join(
    "SELECT '{c}' AS field, '{t}' AS type, {n} AS note, count({c}) AS present FROM home".format(
        c=c, t=_TYPES.get(c, "string"), n=f"'{SOLD_NOTES[c]}'" if c in SOLD_NOTES else "NULL")
    for c in _DESCRIBED), needs=("home",))
def table_description(spark, folder):
    rows = homes_only(sold_rows(spark, folder)).select(*_DESCRIBED)
    return statements.describe_table(statements.with_notes(rows, SOLD_NOTES))
