"""Records of delimited text files, found in parallel.

A line break inside quotes belongs to its field, so a line alone does not tell whether it
starts a record. Each line maps the state in front of it (inside quotes or not) to the
state behind it, one of four maps: it keeps the state, turns it over, or sets it either way.
Such maps join like sums: the state behind a line is what the last setting line left,
turned over as often as lines after it say. The maps of a block's lines are joined in the
block, those of the blocks in a table of one row per block, and that gives each block the
state it starts in. So a file is read in any number of blocks; only the lines of records with
line breaks are moved to meet each other, and files without one take no part.

Quotes count at the start of a field only, doubled quotes stand for one, and what follows a
closing quote belongs to the field: the reading of the usual CSV modules.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rivulet.functions.geo import let
from rivulet.sources.tables import settle

MOST_CHARACTERS = 1 << 20  # of a record; a longer one has a quote that is never closed
INSIDE = r'[^"]*+(?:""[^"]*+)*+'  # of quotes, up to the closing one


def _fields(sep: str) -> str:
    """Whole fields, each with the separator behind it."""
    return rf'(?:(?:"{INSIDE}"[^{sep}]*+|[^"{sep}][^{sep}]*+)?{sep})*+'


def _open_behind(sep: str, quoted: bool) -> Column:
    """1 if a line ends inside quotes, when it starts inside quotes or not."""
    if not quoted:
        return F.col("value").rlike(rf'(?s)^{_fields(sep)}"{INSIDE}$').cast("int")
    return F.col("value").rlike(
        rf'(?s)^{INSIDE}$|^{INSIDE}"[^{sep}]*+{sep}{_fields(sep)}"{INSIDE}$').cast("int")


def file_lines(reader, path: str | Sequence[str]) -> DataFrame:
    """(file, start, value): lines of text files, with the file and the block each was read from.

    ``reader`` is ``spark.read`` or ``spark.readStream``. Lines end at line feeds; a carriage
    return stays, so that a field with line breaks comes out as it was.
    """
    return reader.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def in_own_encoding(lines: DataFrame) -> DataFrame:
    """Lines of files that are no valid UTF-8 decoded as Latin-1, each file judged as a whole."""
    lines = lines.withColumn("n", F.monotonically_increasing_id())  # before they move
    valid = lines.groupBy("file").agg(F.min(F.is_valid_utf8("value")).alias("_valid"))
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    return lines.join(valid, "file").select("file", "start", "n", F.when(
        F.col("_valid"), F.col("value")).otherwise(latin).alias("value"))


def delimiter_of(header: str, default: str = ";") -> str:
    """The separator of a payload: ``;`` only where there is no comma."""
    if ";" in header and "," not in header:
        return ";"
    return "," if "," in header else default


def _spread(lines: DataFrame) -> DataFrame:
    """(file, start, n, value) of records, from (file, start, n, value, sep) lines of files that need it."""
    def behind(quoted: bool) -> Column:
        by_sep = F.when(F.col("sep") == ";", _open_behind(";", quoted)).otherwise(_open_behind(",", quoted))
        return F.when(F.contains("value", F.lit('"')), by_sep).otherwise(int(quoted))

    maps = lines.withColumn("_o0", behind(False)).withColumn("_o1", behind(True)).select(
        "file", "start", "n", "value", F.when(F.col("_o0") > F.col("_o1"), 1).otherwise(0).alias("_turn"),
        F.when(F.col("_o0") == F.col("_o1"), F.col("_o0")).alias("_set"))
    block = Window.partitionBy("file", "start").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    maps = maps.withColumn("_turns", F.sum("_turn").over(block) % 2)
    # a set state counts from its line on; turned back by the turns up to it, it holds for later lines
    maps = maps.withColumn("_left", F.last((F.col("_set") + F.col("_turns")) % 2, ignorenulls=True).over(block))
    # stored: a repeated read must number the lines alike
    maps = settle(maps, "lines")
    blocks = maps.groupBy("file", "start").agg(
        F.max_by("_turns", "n").alias("turns"), F.max_by("_left", "n").alias("left"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("start")
    states = (blocks.withColumn("_all", F.sum("turns").over(earlier) % 2)
              .withColumn("_kept", F.last((F.col("left") + F.col("turns") + F.col("_all")) % 2,
                                          ignorenulls=True).over(earlier))
              .withColumn("_end", (F.coalesce("_kept", F.lit(0)) + F.col("_all")) % 2)
              .select("file", "start", F.coalesce(F.lag("_end").over(before), F.lit(0)).alias("_in")))
    state = (F.coalesce("_left", "_in") + F.col("_turns")) % 2
    own = Window.partitionBy("file", "start").orderBy("n")
    known = maps.join(states, ["file", "start"]).withColumn("_after", state).withColumn(
        "_before", F.coalesce(F.lag("_after").over(own), F.col("_in")))
    whole = known.where("_before = 0 AND _after = 0").select("file", "start", "n", "value")
    parts = known.where("_before = 1 OR _after = 1").withColumn(
        "_own", F.last(F.when(F.col("_before") == 0, F.struct("start", "n")), ignorenulls=True).over(block))
    ends = parts.groupBy("file", "start").agg(F.max("_own").alias("_last"))
    past = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_last", ignorenulls=True).over(past)).drop("_last")
    parts = parts.join(carried, ["file", "start"]).withColumn("_first", F.coalesce("_own", "_carried"))
    sizes = parts.groupBy("file", "_first").agg(F.sum(F.char_length("value")).alias("size"))
    long = sizes.where(F.col("size") > MOST_CHARACTERS).select("file").first()
    if long:
        raise ValueError(f"a quote is never closed in {long[0]}")
    lines_of = F.array_sort(F.collect_list(F.struct("start", "n", "value")))
    spread = parts.groupBy("file", "_first").agg(lines_of.alias("_lines")).select(
        "file", "_first.start", "_first.n",
        F.array_join(F.transform("_lines", lambda x: x["value"]), "\n").alias("value"))
    return whole.union(spread)


def read_records(lines: DataFrame, separator: Callable[[str], str] = delimiter_of
                 ) -> tuple[DataFrame, list[tuple[str, str]]]:
    """((header, sep, value) of each record, layouts (header, sep)) of (file, start, value) lines.

    The first line of a file with more than blanks starts its header; blank lines between
    records are no records. Only the distinct headers come to the driver.
    """
    spark = lines.sparkSession
    if "n" not in lines.columns:
        lines = lines.withColumn("n", F.monotonically_increasing_id())
    quoted = F.contains("value", F.lit('"'))
    opens = {sep: F.max(F.when(quoted, _open_behind(sep, False)).otherwise(0)) for sep in ";,"}
    first = F.min(F.when(F.trim(_without_return()) != "", F.struct("start", "n", "value")))
    # one row per file, stored: what follows reads it several times
    found = settle(lines.groupBy("file").agg(
        first.alias("first"), opens[";"].alias("semicolon"), opens[","].alias("comma")).where(
        "first IS NOT NULL"), "files")
    heads = [r[0] for r in found.select("first.value").distinct().collect()]
    seps = spark.createDataFrame([(h, separator(h)) for h in heads], "value string, sep string")
    files = found.join(seps, F.col("first.value") == seps["value"]).select(
        "file", "first", "sep", F.when(F.col("sep") == ";", F.col("semicolon")).otherwise(
            F.col("comma")).cast("boolean").alias("spread"))
    plain = files.where("NOT spread").select("file", "sep", "first", _without_return("first.value").alias("header"))
    records = lines.join(plain, "file").select("file", "start", "n", "value", "sep", "first", "header")
    if not files.where("spread").isEmpty():
        some = files.where("spread").select("file", "sep", "first")
        spread = settle(_spread(lines.join(some.drop("first"), "file").select(
            "file", "start", "n", "value", "sep")), "records").join(some, "file")
        # their headers may have line breaks, too
        heads_of = spread.where("start = first.start AND n = first.n").select(
            "file", _without_return().alias("header"))
        records = records.union(spread.join(heads_of, "file").select(records.columns))
        plain = plain.select("header", "sep").union(heads_of.join(some, "file").select("header", "sep"))
    rows = records.where("NOT (start = first.start AND n = first.n)").select(
        "header", "sep", _without_return().alias("value")).where(F.trim("value") != "")
    layouts = [tuple(r) for r in plain.select("header", "sep").distinct().orderBy("header").collect()]
    return rows, layouts


def _without_return(column: str = "value") -> Column:
    return F.regexp_replace(column, r"\r\z", "")


def names_of(spark: SparkSession, header: str, sep: str) -> list[str]:
    """The fields of a header as they stand there, without quotes."""
    return list(spark.range(1).select(_fields_of(F.lit(header.lstrip("\ufeff")), sep).alias("r")).first()["r"])


def _fields_of(value: Column, sep: str) -> Column:
    """The fields of a record as texts."""
    raw = F.regexp_extract_all(F.concat(F.lit(sep), value), F.lit(rf'{sep}("{INSIDE}"[^{sep}]*+|[^{sep}]*+)'), F.lit(1))
    quoted = rf'(?s)^"({INSIDE})"(.*)$'
    return F.transform(raw, lambda f: F.when(
        F.startswith(f, F.lit('"')), F.concat(F.replace(F.regexp_extract(f, quoted, 1), F.lit('""'), F.lit('"')),
                                              F.regexp_extract(f, quoted, 2))).otherwise(f))


def parsed_columns(rows: DataFrame, layouts: Sequence[tuple[str, str, Sequence[str | None]]],
                   columns: Sequence[str]) -> DataFrame:
    """The columns of (header, sep, value) records, as text, '' as NULL, in one scan for all layouts.

    A layout names each field of its header; fields named None are left out, and of fields
    of one name the last counts. Records of other headers are left out.
    """
    def fields(names: Sequence[str | None]) -> Callable[[Column], Column]:
        place = {n: k for k, n in enumerate(names) if n is not None}
        return lambda r: F.struct(*[
            (F.nullif(F.get(r, F.lit(place[c])), F.lit("")) if c in place else F.lit(None).cast("string")).alias(c)
            for c in columns])

    out = F.lit(None)
    for header, sep, names in layouts:
        record = let(_fields_of(F.col("value"), sep), fields(names))
        out = F.when(F.col("header") == header, record).otherwise(out)
    return rows.where(F.col("header").isin([h for h, *_ in layouts])).select(out.alias("_row")).select("_row.*")
