"""Elements of JSON arrays that are spread over lines, put together by many tasks.

A string of JSON never goes over the end of a line, so what a line opens and closes shows in the line itself. The
depth at a line is a sum over the lines before it: every split of a file is summed up on its own, and a small table with
one row per split holds what the splits before it leave open (like ``lineage.split_offsets``). Lines from one that
begins an element at depth 0 to the one that closes it are a *run*, and runs are what is shuffled and parsed. An
unmatched closing bracket leaves the depth at 0.

A run that is never closed, or closed too late, would take the rest of the file along. Lines that begin with ``{`` and
are indented no more than any other such line are *marks*: a run that is no JSON is taken apart at its marks, so that a
broken element costs itself. In files without indentation marks may lie inside elements; there a run is parsed before
it is taken apart. Only a run of more than ``MAX_ELEMENT`` characters is taken apart without trying.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stratum.functions.lineage import _RUNNING as LINE
from stratum.functions.lineage import _SPLIT as SPLIT
from stratum.functions.lineage import FILE
from stratum.session import work_root

MAX_ELEMENT = 64 << 20
# Characters that a reject keeps of lines that are no element.
EXCERPT = 1_000


def inside_array(text: Column) -> Column:
    """Part of a JSON array, made an array itself: an outer bracket or separator at either end goes."""
    inner = F.regexp_replace(text, r"\A\x{FEFF}?\s*+[\[,]?", "")
    inner = F.regexp_replace(inner, r"[\],]?\s*+\z", "")
    return F.concat(F.lit("["), inner, F.lit("]"))


def is_whole(text: Column) -> Column:
    """Whether a line holds whole objects and nothing else, but for what stands between elements."""
    inner = inside_array(text)
    return inner.rlike(r"^\[\s*\{") & F.json_array_length(inner).isNotNull()


def says_nothing(text: Column) -> Column:
    """Only white space, brackets of arrays and separators."""
    return text.rlike(r"^[\s,\[\]\x{FEFF}]*$")


def _outside(text: Column) -> Column:
    """The line without its strings; one that is not closed goes to the end of the line."""
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    return F.array_join(F.filter(F.split(plain, '"'), lambda _, i: i % 2 == 0), "")


def _fragments(lines: DataFrame) -> DataFrame:
    """One row per line, or two: what a line closes at its beginning belongs to the element before."""
    whole = is_whole(F.col("value"))
    # A generator of one row: its columns are worked out once.
    rows = lines.select("value", FILE, SPLIT, LINE, F.inline(F.array(F.struct(
        whole.alias("whole"), F.regexp_extract("value", r"^(\s*[}\]][}\]\s]*)", 1).alias("closing")))))
    parts = F.when(~F.col("whole") & (F.col("closing") != "") & (F.col("closing") != F.col("value")), F.array(
        "closing", F.expr("substring(value, length(closing) + 1)"))).otherwise(F.array("value"))
    rows = rows.select(FILE, SPLIT, LINE, "whole", F.length(F.regexp_extract("value", r"^[\s,]*", 0)).alias("indent"),
                       F.posexplode(parts).alias("part", "text"))
    outside = rows.select("*", F.inline(F.array(F.struct(F.when(F.col("whole"), "").otherwise(_outside(F.col("text"))).alias("outside")))))
    size = lambda marks: F.length("outside") - F.length(F.translate("outside", marks, ""))
    return outside.select(
        FILE, SPLIT, LINE, "part", "text", "whole", "indent", (size("[{") - size("]}")).cast("long").alias("change"),
        (F.col("text").rlike(r"^[\s,\[\x{FEFF}]*\{")).alias("object"), says_nothing(F.col("text")).alias("empty"),
        F.col("text").rlike(r"^\s*,").alias("begins"), F.col("text").rlike(r"[,\[]\s*$").alias("ends"),
        (F.trim("text") == "").alias("blank"), F.col("text").rlike(r"^\x{FEFF}?\s*\[").alias("bracket"))


def _stored(df: DataFrame) -> DataFrame:
    """Splits and line numbers must be the same wherever the rows are used."""
    path = work_root(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _in_split() -> WindowSpec:
    return Window.partitionBy(FILE, SPLIT).orderBy(LINE, "part")


def _up_to() -> WindowSpec:
    return _in_split().rowsBetween(Window.unboundedPreceding, 0)


def _before() -> WindowSpec:
    return _in_split().rowsBetween(Window.unboundedPreceding, -1)


def _splits_before() -> WindowSpec:
    return Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)


def _or_0(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("long"))


def _split_depths(summed: DataFrame) -> DataFrame:
    """Per split: what the splits before it leave open, the lowest that ever was, and how far the file's elements are indented."""
    first = F.min_by(F.struct("bracket", "whole", LINE), F.when(~F.col("blank"), F.struct(LINE, "part")))
    splits = summed.groupBy(FILE, SPLIT).agg(
        F.sum("change").alias("total"), F.min(F.when(~F.col("blank"), F.col("sum"))).alias("lowest"), first.alias("first"),
        F.min(F.when(F.col("object"), F.struct("indent", LINE))).alias("object"),
        F.min(F.when(F.col("object") & ~F.col("leading"), F.col("indent"))).alias("later"))
    # Of the file's first line neither the bracket that opens the array nor the indentation counts.
    leads = ~F.coalesce(F.max(F.col("first").isNotNull()).over(_splits_before()), F.lit(False))
    opens = leads & F.coalesce(F.col("first.bracket") & ~F.col("first.whole"), F.lit(False))
    splits = splits.withColumns({"opens": opens.cast("long"), "own": F.when(leads, F.col("later")).otherwise(F.col("object.indent"))})
    before = _or_0(F.sum(F.col("total") - F.col("opens")).over(_splits_before()))
    splits = splits.withColumns({"base": before - F.col("opens"), "margin": F.min("own").over(Window.partitionBy(FILE))})
    floor = _or_0(F.min(F.col("base") + F.col("lowest")).over(_splits_before()))
    return splits.select(FILE, SPLIT, "base", F.least(floor, F.lit(0)).alias("floor"), "margin")


def _with_depth(fragments: DataFrame) -> DataFrame:
    """What each fragment does: it begins a run, strays outside of any, or may mark an element inside a run."""
    said = F.when(~F.col("blank"), F.col("sum"))
    parts = F.when(~F.col("blank"), F.col("ends") | F.col("whole"))
    first_line = F.min(F.when(~F.col("blank"), F.col(LINE))).over(_up_to())
    summed = fragments.withColumn("sum", F.sum("change").over(_up_to())).withColumns({
        "low": F.min(said).over(_before()), "parted": F.last(parts, True).over(_before()),
        "leading": F.coalesce(F.col(LINE) == first_line, F.lit(True))})
    summed = _stored(summed)
    rows = summed.join(_split_depths(summed), [FILE, SPLIT])
    lowest = F.least("floor", F.coalesce(F.col("base") + F.col("low"), "floor"))
    rows = rows.withColumn("outer", F.col("base") + F.col("sum") - F.col("change") <= lowest)
    rows = rows.where(~(F.col("outer") & F.col("empty")))
    # Between two elements of which one goes over lines there has to be a separator.
    apart = F.col("whole") | F.col("begins") | F.coalesce("parted", F.lit(True))
    return rows.select(
        FILE, SPLIT, LINE, "part", "text", (F.col("outer") & F.col("object") & apart).alias("begins"),
        (F.col("outer") & ~F.col("object")).alias("strays"),
        F.coalesce(~F.col("outer") & F.col("object") & (F.col("indent") == F.col("margin")), F.lit(False)).alias("mark"))


def _in_runs(rows: DataFrame) -> DataFrame:
    """Each fragment with its ``run``, the number of ``marks`` up to it, and whether it is ``junk`` behind its run; all counted over the file."""
    totals = {name: F.sum(F.col(flag).cast("long")).over(_up_to()) for name, flag in (("run", "begins"), ("marks", "mark"), ("stray", "strays"))}
    rows = rows.withColumns(totals).withColumn("at_begin", F.max(F.when(F.col("begins"), F.col("stray"))).over(_up_to()))
    rows = _stored(rows)
    splits = rows.groupBy(FILE, SPLIT).agg(*[F.max(c).alias(f"all_{c}") for c in ("run", "marks", "stray", "at_begin")])
    before = {f"{c}_before": _or_0(F.sum(f"all_{c}").over(_splits_before())) for c in ("run", "marks", "stray")}
    splits = splits.withColumns(before).withColumn(
        "began", _or_0(F.max(F.col("stray_before") + F.col("all_at_begin")).over(_splits_before())))
    splits = splits.select(FILE, SPLIT, *before, "began")
    began = F.coalesce(F.col("stray_before") + F.col("at_begin"), "began")
    junk = F.col("stray_before") + F.col("stray") > began
    return rows.join(splits, [FILE, SPLIT]).select(
        FILE, SPLIT, LINE, "part", "text", (F.col("mark") & ~junk).alias("mark"), junk.alias("junk"),
        (F.col("run") + F.col("run_before")).alias("run"), (F.col("marks") + F.col("marks_before")).alias("marks"))


def _joined(lines: Column) -> Column:
    text = F.transform(lines, lambda x, i: F.concat(F.when((i > 0) & (x["part"] == 0), "\n").otherwise(""), x["text"]))
    return F.array_join(text, "")


def _taken_apart(lines: Column) -> Column:
    """One text from each mark to the next."""
    marks = F.filter(F.transform(lines, lambda x, i: F.when((i == 0) | x["mark"], i)), lambda i: i.isNotNull())
    return F.element_at(F.transform(F.array(marks), lambda at: F.transform(at, lambda start, k: _joined(F.slice(
        lines, start + 1, F.coalesce(F.get(at, k + 1), F.size(lines)) - start)))), 1)


def put_together(lines: DataFrame, max_element: int = MAX_ELEMENT) -> DataFrame:
    """The elements of files in ``value``, from lines with ``lineage.split_position()``.

    ``value`` is one text per element, or per line with several; what is no JSON comes as it is, but for its beginning
    only where it is several lines of junk or more than ``max_element`` characters without a mark. The place of the
    first line is kept, with ``part`` and ``piece`` for the order inside it.
    """
    rows = _in_runs(_with_depth(_fragments(lines)))
    run, place = [FILE, "run"], F.struct(SPLIT, LINE, "part")
    long_runs = rows.groupBy(*run).agg(F.sum(F.length("text")).alias("size")).where(F.col("size") > max_element).select(*run)
    pieces = rows.join(long_runs, run, "left_semi").groupBy(*run, "marks", "junk").agg(
        F.min(place).alias("first"), (F.sum(F.length("text")) > max_element).alias("endless"))
    rows = rows.join(pieces, [*run, "marks", "junk"], "left").where(~F.coalesce("endless", F.lit(False)) | (place == F.col("first")))
    rows = rows.withColumn("of", F.when(F.col("first").isNotNull(), F.col("marks")))
    runs = rows.groupBy(*run, "of").agg(
        F.sort_array(F.collect_list(F.struct(SPLIT, LINE, "part", "text", "mark", "junk"))).alias("lines"),
        F.coalesce(F.max("endless"), F.lit(False)).alias("endless"))
    parts = {"own": F.filter("lines", lambda x: ~x["junk"]), "junk": F.filter("lines", lambda x: x["junk"])}
    runs = runs.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in parts.items()]))))
    runs = runs.select("*", F.inline(F.array(F.struct(_joined(F.col("own")).alias("text"), _joined(F.col("junk")).alias("behind")))))
    valid = F.json_array_length(inside_array(F.col("text"))).isNotNull()
    behind = F.when(F.size("junk") > 1, F.left("behind", F.lit(EXCERPT))).otherwise(F.col("behind"))
    behind = F.when(F.size("junk") > 0, F.array(behind)).otherwise(F.array().cast("array<string>"))
    # What a broken element leaves behind its run is part of it.
    texts = (F.when(F.size("own") == 0, behind).when(F.col("endless"), F.array(F.left(_joined(F.col("lines")), F.lit(EXCERPT))))
             .when(valid, F.concat(F.array("text"), behind))
             .when(F.exists(F.slice("own", 2, F.greatest(F.size("own") - 1, F.lit(0))), lambda x: x["mark"]), F.concat(_taken_apart(F.col("own")), behind))
             .otherwise(F.array(_joined(F.col("lines")))))
    first = F.col("lines")[0]
    return runs.select(FILE, first[SPLIT].alias(SPLIT), first[LINE].alias(LINE), first["part"].alias("part"), F.posexplode(texts).alias("piece", "value"))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Running numbers, without gaps inside a split, in place of the lines' ones."""
    inside = Window.partitionBy(FILE, SPLIT).orderBy(LINE, *order)
    return rows.withColumn(LINE, F.row_number().over(inside).cast("long")).drop(*order)
