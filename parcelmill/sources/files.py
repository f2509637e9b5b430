"""Monthly CSV feeds: columns that drift, repeated headers, quoted newlines.

Files are read in two passes, both spread over their splits:

1. A survey looks at the lines. A quote mark opens a field only at the field's
   start, and the next single mark closes it; marks elsewhere are text. What a
   line does is a map from "inside a field before it" to "inside a field behind
   it"; the survey notes, per split, its first line and the map of all its lines.
2. Files whose records are single lines are read by Spark's CSV source in
   splits. In the others a line belongs to the record before it when it begins
   inside a field. The maps of the splits before tell that for the start of each
   split, so these files are split as well.

The driver sees the different headers, never the list of files.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.packaging import ship
from parcelmill.session import stage

CSV_OPTIONS = {"escape": '"', "quote": '"', "mode": "PERMISSIVE"}
_PLACE = "path string, start long, first string, open_if_closed boolean, open_if_open boolean, breaks boolean"
#: Fields that end on their line: quoted with text behind it or not, or without a mark at the start.
_FIELD = r'(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|)'
_CLOSES = re.compile(rf"{_FIELD}(?:,{_FIELD})*+\Z")
_CLOSES_OPEN = re.compile(rf'(?:[^"]|"")*+"[^,]*+(?:,{_FIELD})*+\Z')


def distinct_header(names: Sequence[str]) -> list[str | None]:
    """Names with every repeat replaced by None. Both forms of a repeat count:
    the same name again, and the name with '.1' behind it."""
    seen: set[str] = set()
    kept: list[str | None] = []
    for name in names:
        base = name[:-2] if name.endswith(".1") else name
        repeated = name in seen or (base != name)
        kept.append(None if repeated else name)
        seen.add(name)
    return kept


def _lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """(path, start of the split, at, value): every line, ``at`` rising within a split."""
    read = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("at"), "value")


def line_map(line: str) -> tuple[bool, bool]:
    """Whether a quoted field is open behind ``line`` if none was open before it, and if one was."""
    if '"' not in line:
        return False, True
    return _CLOSES.match(line) is None, _CLOSES_OPEN.match(line) is None


def survey(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """A row per split: its first line, whether a field is open at its end if
    none or one was open at its start, and whether a line of it breaks inside a field."""
    if not paths:
        raise FileNotFoundError("no file matches")
    ship(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "start", "first", "open_if_closed", "open_if_open", "breaks"]
        types = [pa.string(), pa.int64(), pa.string(), *[pa.bool_()] * 3]
        held: dict[tuple, list] = {}
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            cut = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for i, j in zip(cut, cut[1:]) if keys else ():
                found = held.setdefault(keys[i], [batch.column(2)[i].as_py(), False, True, False])
                part = batch.column(2).slice(i, j - i)
                # Lines without a mark change nothing.
                for line in part.filter(pc.match_substring(part, '"')).to_pylist():
                    after = line_map(line)
                    found[1], found[2] = after[found[1]], after[found[2]]
                    found[3] |= after[0]
        rows = [(*k, *v) for k, v in held.items()]  # a task has few splits
        columns = zip(*rows) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    lines = _lines(spark, paths).select("path", "start", "value")
    return stage(lines.mapInArrow(work, _PLACE), "survey")


def _begins(lines: DataFrame) -> DataFrame:
    """``lines`` with ``begins_if_closed`` and ``begins_if_open``: whether a line
    begins a record if no or one field was open at the start of its split."""
    schema = T.StructType([*lines.schema.fields, *(T.StructField(n, T.BooleanType()) for n in ("begins_if_closed", "begins_if_open"))])
    path, start, value = (lines.columns.index(n) for n in ("path", "start", "value"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state = None, (False, True)
        for batch in batches:
            told: list[tuple[bool, bool]] = []
            keys = zip(batch.column(path).to_pylist(), batch.column(start).to_pylist())
            for key, line in zip(keys, batch.column(value).to_pylist()):
                if key != split:
                    split, state = key, (False, True)
                told.append((not state[0], not state[1]))
                if '"' in line:
                    after = line_map(line)
                    state = after[state[0]], after[state[1]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([x[k] for x in told], pa.bool_()) for k in (0, 1))], names=schema.names)

    return lines.mapInArrow(work, schema)


def _open_at_start(blocks: DataFrame) -> DataFrame:
    """(path, start, open): whether a field is open where a split starts. A file
    is one row of its splits while their maps are applied one after the other."""
    splits = F.array_sort(F.collect_list(F.struct("start", "open_if_closed", "open_if_open")))
    after = lambda now, x: F.when(now["open"], x["open_if_open"]).otherwise(x["open_if_closed"])
    told = F.aggregate(
        "splits", F.struct(F.lit(False).alias("open"), F.array().cast("array<struct<start:bigint,open:boolean>>").alias("all")),
        lambda now, x: F.struct(after(now, x).alias("open"), F.concat(
            now["all"], F.array(F.struct(x["start"].alias("start"), now["open"].alias("open")))).alias("all")),
        lambda now: now["all"])
    return blocks.groupBy("path").agg(splits.alias("splits")).select("path", F.inline(told))


def _files(blocks: DataFrame) -> DataFrame:
    """(path, header line, breaks) of every file that is not empty."""
    return blocks.groupBy("path").agg(
        F.max(F.when(F.col("start") == 0, F.regexp_replace("first", "^\\ufeff", ""))).alias("header"),
        F.max("breaks").alias("breaks"))


def _headers(files: DataFrame) -> dict[str, list[str]]:
    """Names by header line, in order of the first file that has it; as many
    entries as there are different headers."""
    known = files.groupBy("header").agg(F.min("path").alias("path")).orderBy("path")
    lines = [r["header"] for r in known.collect()]
    return {line: next(csv.reader(io.StringIO(line)), []) for line in lines}


def _records(spark: SparkSession, paths: Sequence[str] | str) -> tuple[DataFrame, DataFrame, dict[str, list[str]]]:
    """(records as ``path``, ``header`` and fields ``c``, files, headers)."""
    blocks = survey(spark, paths)
    files = _files(blocks)
    headers = _headers(files)
    width = max(map(len, headers.values()), default=0) + 1  # one more shows fields beyond any header
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    fields = F.array(*[F.col(f"_c{i}") for i in range(width)]).alias("c")

    read = spark.read.schema(schema).options(header="true", enforceSchema="true", **CSV_OPTIONS)
    single = read.csv(paths if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias("path"), fields)
    records = single.join(files.where("NOT breaks").select("path", "header"), "path")

    if files.where("breaks").head(1):
        before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        open_ = _open_at_start(blocks).join(files.where("breaks").select("path", "header"), "path")
        lines = _begins(_lines(spark, paths)).join(open_, ["path", "start"])
        begins = F.when(F.col("open"), F.col("begins_if_open")).otherwise(F.col("begins_if_closed"))
        lines = lines.withColumn("begins", begins.cast("long"))
        # Records are numbered within the file: those of the splits before, then those in the split.
        counts = lines.groupBy("path", "start").agg(F.sum("begins").alias("n"))
        counts = counts.select("path", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("records_before"))
        within = Window.partitionBy("path", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        lines = lines.join(counts, ["path", "start"]).withColumn("record", F.col("records_before") + F.sum("begins").over(within))
        whole = lines.where("record > 1").groupBy("path", "header", "record").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "at", "value"))), lambda x: x["value"]), "\n").alias("text"))
        parsed = whole.where("trim(text) <> ''").select("path", F.from_csv("text", schema.simpleString()[7:-1].replace(":", " "), CSV_OPTIONS).alias("x"), "header")
        records = records.unionByName(parsed.select(
            "path", F.array(*[F.col(f"x._c{i}") for i in range(width)]).alias("c"), "header"))
    return records, files, headers


def _beyond(headers: dict[str, list[str]]) -> Column:
    """Whether a record has a value behind the last name of its header."""
    found = F.lit(False)
    for line, names in headers.items():
        more = F.exists(F.slice("c", len(names) + 1, F.greatest(F.size("c") - len(names), F.lit(0))), lambda x: x.isNotNull())
        found = F.when(F.col("header") == line, more).otherwise(found)
    return found


def ingest(spark: SparkSession, paths: Sequence[str] | str, malformed: str = "fail") -> DataFrame:
    """Union of the files by column name, all columns as text; a column that a
    file lacks is null, and the first of each repeated column is kept.

    All files are one scan: the header of its file tells where a record has a
    column, so the plan grows with the number of different headers and not with
    the number of files. A record with more fields than its header stops the
    read; ``malformed='drop'`` leaves it out, see ``file_counts`` for how many."""
    if malformed not in ("fail", "drop"):
        raise ValueError("malformed is 'fail' or 'drop'")
    records, _, headers = _records(spark, paths)
    if malformed == "drop":
        records = records.where(~_beyond(headers))
    else:
        # A filter, as a column would be left out where nobody reads it.
        told = F.raise_error(F.concat(F.lit("a record has more fields than the header of "), "path")).cast("boolean")
        records = records.where(F.when(_beyond(headers), told).otherwise(True))
    places: dict[str, Column] = {}
    for line, names in headers.items():
        for i, name in enumerate(distinct_header(names)):
            if name is not None:
                places[name] = F.when(F.col("header") == line, F.col("c")[i]).otherwise(places.get(name, F.lit(None).cast("string")))
    return records.select(*[place.alias(name) for name, place in places.items()])


def file_counts(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """(file, rows, columns, malformed) of every file, also of those that hold a
    header only. ``malformed`` records have more fields than the header."""
    records, files, headers = _records(spark, paths)
    counted = records.groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(_beyond(headers)).alias("malformed"))
    columns = F.lit(0)
    for line, names in headers.items():
        columns = F.when(F.col("header") == line, len(names)).otherwise(columns)
    return files.join(counted, "path", "left").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.coalesce("rows", F.lit(0)).alias("rows"),
        columns.alias("columns"), F.coalesce("malformed", F.lit(0)).alias("malformed"))


def read_columns(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """Typed read of a column subset; text that does not fit is null. Postal
    codes stay text when the type says so."""
    source = ingest(spark, [path]) if path.endswith(".csv") else spark.read.parquet(path)
    return source.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items() if c in source.columns])


def size_of(df: DataFrame) -> tuple[int, int]:
    """(rows, columns). Over Parquet the rows come from the file footers."""
    return df.count(), len(df.columns)
