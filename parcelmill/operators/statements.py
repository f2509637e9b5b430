"""Read-only SQL access: statement test, guarded run, table description."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.constants import (
    BLOCKED_FILE_CALLS, BLOCKED_SPARK_CALLS, BLOCKED_WORDS, PATH_FORMATS, QUERY_ROW_CAP,
)
from parcelmill.operators.profile import missing_profile

# One scan from the left takes quoted names, literals and comments in turn, so
# a quote in a comment or a comment mark in a literal cannot hide what follows.
# A quoted name stays, a literal leaves its quote mark, a comment leaves a space.
# Spark nests bracketed comments and ends a line comment at a carriage return, but
# not at an escaped line break. A comment with another one inside leaves its mark,
# which is forbidden, as does one that is never closed.
TOKENS = (
    r"(`[^`]*`)"
    r"|\b[rR](')[^']*'|\b[rR](\")[^\"]*\""
    r"|(')[^'\\]*(?:\\[\s\S][^'\\]*)*'|(\")[^\"\\]*(?:\\[\s\S][^\"\\]*)*\""
    r"|--(?:\\\n|[^\r\n])*|(/\*(?:(?!\*/)[\s\S])+?/\*)|/\*[\s\S]*?\*/"
)
KEPT, KEPT_JAVA = r"\1\2\3\4\5\6 ", "$1$2$3$4$5$6 "
STARTS_READING = r"(?i)^\s*(?:with|select)\b"
#: Tested outside quoted names, where a word is only a name.
FORBIDDEN_WORDS = r"(?i)\b(?:" + "|".join(BLOCKED_WORDS) + r")\b"
QUOTED_NAME = r"`[^`]*`"
FORBIDDEN = [
    r";",
    r"/\*",
    r"(?i)\b(?:" + "|".join(BLOCKED_FILE_CALLS + BLOCKED_SPARK_CALLS) + r")`?\s*\(",
    # A relation that is a path: csv.`/some/file`
    r"(?i)\b(?:" + "|".join(PATH_FORMATS) + r")`?\s*\.\s*`",
    # Rows piped through a program: TRANSFORM (...) USING 'program'
    r"(?i)\busing\s*['\"]",
]


def strip_statement(statement: str) -> str:
    text = re.sub(TOKENS, KEPT, statement)
    return re.sub(r"[\s;]+$", "", text)


def is_read_only(statement: str) -> bool:
    """True for one SELECT or WITH statement that changes nothing and reaches
    nothing outside the tables."""
    text = strip_statement(statement)
    if not re.search(STARTS_READING, text):
        return False
    if re.search(FORBIDDEN_WORDS, re.sub(QUOTED_NAME, "`", text)):
        return False
    return not any(re.search(pattern, text) for pattern in FORBIDDEN)


def read_only_column(statement: Column | str) -> Column:
    """``is_read_only`` as a column expression, for a table of statements."""
    c = F.col(statement) if isinstance(statement, str) else statement
    text = F.regexp_replace(c, TOKENS, KEPT_JAVA)
    text = F.regexp_replace(text, r"[\s;]+$", "")
    ok = text.rlike(STARTS_READING) & ~F.regexp_replace(text, QUOTED_NAME, "`").rlike(FORBIDDEN_WORDS)
    for pattern in FORBIDDEN:
        ok = ok & ~text.rlike(pattern)
    return F.coalesce(ok, F.lit(False))


def audit_statements(df: DataFrame, column: str = "statement") -> DataFrame:
    """The table with a column ``allowed``."""
    return df.withColumn("allowed", read_only_column(column))


#: The only steps that an analysed statement may take. Table functions of users,
#: programs, streams, writes and commands are none of them.
PLAN_ALLOWED = frozenset("""
    Project Filter Aggregate Join Sort GlobalLimit LocalLimit Offset Distinct Deduplicate Union Intersect Except
    Window Expand Generate Pivot Unpivot Sample LateralJoin ResolvedHint SubqueryAlias View WithCTE CTERelationDef
    CTERelationRef LogicalRelation LogicalRDD LocalRelation OneRowRelation Range DataSourceV2Relation
    """.split())
RELATIONS = frozenset(["LogicalRelation", "LogicalRDD", "DataSourceV2Relation"])
#: Expressions may come from Spark's own packages, but for calls into the host
#: and functions of users.
OWN_PACKAGES = ("org.apache.spark.sql.catalyst.", "org.apache.spark.sql.execution.")
CALLS_BLOCKED = re.compile(r"UDT?F|UDAF|Aggregator|TypedAggregate|Reflect|ScriptTransform|ApplyFunction|UserDefined")
#: Rows that a ``range`` may make.
RANGE_ROWS = 1_000_000


@dataclass
class Answer:
    """``df`` holds at most ``max_rows`` rows; ``whole`` is the uncut result."""

    sql: str | None
    df: DataFrame | None
    error: str | None
    whole: DataFrame | None = None
    max_rows: int = QUERY_ROW_CAP

    def truncated(self) -> bool:
        """Whether the cap cut rows off. Looks at one row more than the cap."""
        return self.whole is not None and self.whole.limit(self.max_rows + 1).count() > self.max_rows


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _steps_of(plan, open_views: Sequence[str] | None) -> Iterator:
    """The nodes of a plan and of its subqueries. What an allowed view was made
    of is not looked at."""
    todo = [plan, *_items(plan.subqueriesAll())]
    while todo:
        node = todo.pop()
        yield node
        if node.nodeName() != "View" or open_views is None or not _open(node, open_views):
            todo += _items(node.children())


def _open(view, names: Sequence[str]) -> bool:
    return view.isTempView() and view.desc().identifier().table().lower() in names


def blocked_in_plan(df: DataFrame, tables: Sequence[str] | None = None) -> list[str]:
    """The forbidden parts of an analysed statement: steps that are not on the
    list, functions that are not Spark's own, ``range`` beyond a bound, and with
    ``tables`` every relation that is not a temporary view of one of these names."""
    names = None if tables is None else [t.lower() for t in tables]
    found = set()
    for node in _steps_of(df._jdf.queryExecution().analyzed(), names):
        kind = node.getClass().getSimpleName()
        if kind not in PLAN_ALLOWED:
            found.add(kind)
        elif kind == "Range" and int(str(node.numElements())) > RANGE_ROWS:
            found.add(f"Range of more than {RANGE_ROWS} rows")
        elif names is not None and (kind in RELATIONS or kind == "View" and not _open(node, names)):
            found.add(f"{kind} that was not given")
        if kind == "View":
            continue
        for expression in _items(node.expressions()):
            for name in re.findall(r'"class"\s*:\s*"([^"]+)"', expression.toJSON()):
                if not name.startswith(OWN_PACKAGES) or CALLS_BLOCKED.search(name.rsplit(".", 1)[-1]):
                    found.add(name.rsplit(".", 1)[-1])
    return sorted(found)


def unbound_joins(df: DataFrame) -> int:
    """Joins of the optimised statement that compare all rows of one side with
    all of the other: without an equality, and no side is known to be one row."""
    def one_row(side) -> bool:
        most = side.maxRows()
        return most.isDefined() and int(str(most.get())) <= 1

    def equality(condition) -> bool:
        kind = condition.nodeName()
        return kind in ("EqualTo", "EqualNullSafe") or kind == "And" and any(map(equality, _items(condition.children())))

    joins = [n for n in _steps_of(df._jdf.queryExecution().optimizedPlan(), None) if n.nodeName() == "Join"]
    return sum(not (j.condition().isDefined() and equality(j.condition().get()) or one_row(j.left()) or one_row(j.right()))
               for j in joins)


@contextmanager
def _only_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[None]:
    """``tables`` as temporary views inside the block; views of the same names
    come back behind it."""
    before = {}
    for name, df in tables.items():
        if any(t.isTemporary and t.name == name.lower() for t in spark.catalog.listTables(pattern=name.lower())):
            before[name] = spark.table(name)
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in tables:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def guarded_sql(spark: SparkSession, statement: str, max_rows: int = QUERY_ROW_CAP,
                tables: Mapping[str, DataFrame] | None = None) -> Answer:
    """Test, analyse and cap a statement. Errors come back in the answer.

    The text is tested first, then the analysed plan against a list of what may
    occur, then the joins. Files named as relations stay closed while the
    statement is analysed, whatever the session allows. With ``tables`` the
    statement sees these tables under these names and no others; without, all
    relations of the session. A statement without an order has no defined first
    rows; ``truncated`` tells when the cap has cut some off."""
    if not is_read_only(statement):
        return Answer(statement, None, "rejected: only one read-only SELECT is allowed")
    setting = "spark.sql.runSQLOnFiles"
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, "false")
    try:
        with _only_views(spark, tables or {}):
            whole = spark.sql(re.sub(r"[\s;]+$", "", statement))  # analysis errors surface here
            blocked = blocked_in_plan(whole, None if tables is None else list(tables))
            if not blocked and unbound_joins(whole):
                blocked = ["a join of all rows with all rows"]
    except Exception as problem:  # noqa: BLE001 - reported, not raised
        return Answer(statement, None, str(problem))
    finally:
        spark.conf.set(setting, before)
    if blocked:
        return Answer(statement, None, f"rejected: {', '.join(blocked)}")
    return Answer(statement, whole.limit(max_rows), None, whole, max_rows)


def with_notes(df: DataFrame, notes: dict[str, str]) -> DataFrame:
    """Attach a note to each named column as its comment."""
    return df.select(*[
        F.col(f"`{c}`").alias(c, metadata={"comment": notes[c]}) if c in notes else F.col(f"`{c}`")
        for c in df.columns
    ])


def describe_table(df: DataFrame) -> DataFrame:
    """(field, type, note, present): the columns in order of the table, with
    their notes and how many values each one holds."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    notes = {f.name: f.metadata.get("comment") for f in df.schema.fields}
    entry = F.create_map(*[
        x for name in types
        for x in (F.lit(name), F.struct(F.lit(types[name]).alias("type"),
                                        F.lit(notes[name]).cast("string").alias("note")))
    ])
    at = F.element_at(entry, F.col("field"))
    return missing_profile(df).select(
        "field", at["type"].alias("type"), at["note"].alias("note"),
        (F.col("rows") - F.col("missing")).alias("present"),
    )
