"""JSON array files read by many tasks, whether an array stands on one line or on many.

A file is read in pieces that end with a closing brace, which Spark's text source deals out as byte
ranges. Whether a brace stands in a string, and how deep, depends on everything before it, so

1. each range is summarised by its number of quotes, and for both possible entry states, outside and
   inside a string, by the change of depth and by how often each depth is that behind a closing brace;
2. a scan over the summaries, one row per range, gives each range its entry state, its entry depth and
   the number of records that end before it;
3. with these each range cuts itself: a record ends with a brace behind which the depth is one. Records
   inside a range stay where they are; of each range only the two cut off at its ends travel on.

Between two records stands a comma, before the first an opening bracket, behind the last a closing one
and nothing else. Anything else fails the query, as does a record of another type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdigris.sources.storage import stored

_RANGE = ["source_file", "block"]
# White space as JSON knows it.
_BLANK = "[ \\t\\n\\r]*"


def _count(text: Column, mark: str) -> Column:
    """How often a one-byte mark stands in the text."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def _without(text: Column, mark: str, pattern: str) -> Column:
    """The text without what the pattern finds; a pattern that needs the mark runs where the mark stands."""
    return F.when(F.contains(text, F.lit(mark)), F.regexp_replace(text, pattern, "")).otherwise(text)


def _with_effects(pieces: DataFrame) -> DataFrame:
    """Adds quotes, effect_0 and effect_1: the change of depth over a piece that is entered outside or inside a string.

    A step is a column of its own, so that it is computed once. No piece holds a closing brace.
    """
    # The last piece of a file may have no brace behind it; that shows in the file's length, see _entries.
    held = pieces.columns
    steps = pieces.withColumn("clean", _without(F.col("value"), "\\", "(?s)\\\\."))
    steps = steps.withColumns({"quotes": _count(F.col("clean"), '"'), "first": F.instr("clean", '"')})
    behind = F.when(F.col("first") > 0, F.substr("clean", F.col("first") + 1)).otherwise("")
    steps = steps.withColumns({"entered_0": F.col("clean"), "entered_1": behind})
    steps = steps.withColumns({f"outside_{n}": _without(F.col(f"entered_{n}"), '"', '"[^"]*("|\\z)') for n in (0, 1)})
    for inside in (0, 1):
        outside = F.col(f"outside_{inside}")
        change = _count(outside, "[") + _count(outside, "{") - _count(outside, "]")
        steps = steps.withColumn(f"effect_{inside}", change - ((F.col("quotes") + inside) % 2 == 0).cast("int"))
    return steps.select(*held, "quotes", "effect_0", "effect_1")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, file_size, block, place, value, quotes, effect_0, effect_1) per piece, in order of block and place.

    A piece is what stands before a closing brace or the end of the file. Escaped characters cannot part
    at a brace, so what counts as a quote shows in the piece alone.
    """
    read = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), "value",
    )
    return _with_effects(read)


def _running(pieces: DataFrame) -> DataFrame:
    """Adds, relative to the start of the range: quotes before, and the depth behind each piece for both entry states."""
    before = Window.partitionBy(*_RANGE).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*_RANGE).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("quotes_before", F.coalesce(F.sum("quotes").over(before), F.lit(0)))
    for inside in (0, 1):
        within = (F.col("quotes_before") + inside) % 2 == 1
        pieces = pieces.withColumn(f"own_{inside}", F.when(within, F.col("effect_1")).otherwise(F.col("effect_0")))
    return pieces.withColumns({f"depth_{inside}": F.sum(f"own_{inside}").over(upto) for inside in (0, 1)})


def _ends(entry: Column, quotes_behind: Column) -> Column:
    """Whether the brace behind a piece stands outside strings."""
    return (entry + quotes_behind) % 2 == 0


def _entries(pieces: DataFrame) -> DataFrame:
    """(source_file, block, inside, depth, records): the state in which each range is entered."""
    running = _running(pieces.drop("value")).withColumn("behind", F.col("quotes_before") + F.col("quotes"))
    # How often each depth occurs: a range holds few depths, whatever its size. Both sums come out of one pass over the text.
    by_depth = running.groupBy(*_RANGE, "depth_0", "depth_1", (F.col("behind") % 2).alias("odd")).agg(
        F.count("*").alias("n"), F.sum("quotes").alias("quotes"), F.sum("own_0").alias("change_0"), F.sum("own_1").alias("change_1"),
        F.max("file_size").alias("file_size"), F.sum(F.col("bytes") + 1).alias("bytes"),
    )
    totals = by_depth.groupBy(*_RANGE).agg(
        *[F.sum(name).alias(name) for name in ("quotes", "change_0", "change_1", "bytes")],
        F.max("file_size").alias("file_size"), F.collect_list(F.struct("depth_0", "depth_1", "odd", "n")).alias("depths"),
    )
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = totals.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    change = F.when(F.col("inside") == 1, F.col("change_1")).otherwise(F.col("change_0"))
    entered = entered.withColumn("depth", F.coalesce(F.sum(change).over(earlier), F.lit(0)))
    # The last piece has no brace behind it, unless the pieces with one brace each are as long as the file.
    whole = Window.partitionBy("source_file")
    surplus = F.sum("bytes").over(whole) - F.col("file_size")
    # A byte order mark is left out by the reader.
    open_end = F.when(surplus.isin(1, -2), True).when(surplus.isin(0, -3), False)
    entered = entered.withColumns({"open_end": open_end, "last": F.col("block") == F.max("block").over(whole)})

    def ended(found: Column) -> Column:
        own = F.when(F.col("inside") == 1, found["depth_1"]).otherwise(found["depth_0"])
        return F.when((own + F.col("depth") == 1) & _ends(F.col("inside"), found["odd"]), found["n"]).otherwise(F.lit(0).cast("long"))

    entered = entered.withColumn("ended", F.aggregate("depths", F.lit(0).cast("long"), lambda total, found: total + ended(found)))
    return entered.select(
        *_RANGE, "inside", "depth", "open_end", "last", F.coalesce(F.sum("ended").over(earlier), F.lit(0)).alias("records")
    )


def _joined(rows: DataFrame, keys: list[str], order: str, *others: Column) -> DataFrame:
    """The texts of a key's rows end to end."""
    parts = F.array_sort(F.collect_list(F.struct(order, "text")))
    text = F.array_join(F.transform(parts, lambda part: part["text"]), "")
    return rows.groupBy(*keys).agg(text.alias("text"), *others)


def _fail(why: str, file: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"MALFORMED_ARRAY: {why} in "), file)).cast("string")


def _as_array(text: Column, number: Column, ended: Column, file: Column) -> Column:
    """The items between two cuts as an array of their own; null where there are none.

    Before an object stand its comma, or the array's bracket, and any number of nulls with their commas;
    behind the last object any number of commas with their nulls, and the closing bracket.
    """
    start = F.when(number == 0, F.lit("\\[")).otherwise(F.lit(","))
    object_ = F.concat(F.lit(f"\\A{_BLANK}"), start, F.lit(f"{_BLANK}((?:null{_BLANK},{_BLANK})*+\\{{)"))
    only_nulls = f"(null{_BLANK}(?:,{_BLANK}null{_BLANK})*+)"
    end = F.concat(F.lit(f"\\A{_BLANK}"), start, F.lit(f"{_BLANK}{only_nulls}\\]{_BLANK}\\z"))
    nothing = F.when(number == 0, F.lit(f"\\A{_BLANK}(?:\\[{_BLANK}\\]{_BLANK})?\\z")).otherwise(F.lit(f"\\A{_BLANK}\\]{_BLANK}\\z"))
    return (
        F.when(ended & F.rlike(text, object_), F.concat(F.lit("["), F.regexp_replace(text, object_, F.lit("$1")), F.lit("]")))
        .when(ended, _fail("something else than commas and nulls between objects", file))
        .when(F.rlike(text, nothing), F.lit(None).cast("string"))
        .when(F.rlike(text, end), F.concat(F.lit("["), F.regexp_replace(text, end, F.lit("$1")), F.lit("]")))
        .otherwise(_fail("no single array of objects", file))
    )


def array_items(spark: SparkSession, path: str, item: str) -> DataFrame:
    """(value, source_file) per item of the JSON arrays in the files under ``path``; ``item`` is its type as DDL.

    Items are objects or null. Files are read as byte ranges of the session's partition size. Their text is
    read twice and shuffled once, by range; its records are written to shared storage when this is called.
    A record is held whole, a file never. Blank files have no items, null items are rows of null. A
    malformed item, text around the array or a second array fails the query. Files must not be
    compressed: their length says how they end.
    """
    pieces = _pieces(spark, path).withColumn("bytes", F.octet_length("value").cast("long"))
    entries = _entries(pieces)
    own = _running(pieces.select(*_RANGE, "place", "value", "quotes", "effect_0", "effect_1")).join(entries, _RANGE)
    depth = F.when(F.col("inside") == 1, F.col("depth_1")).otherwise(F.col("depth_0")) + F.col("depth")
    final = F.col("last") & (F.lead("place").over(Window.partitionBy(*_RANGE).orderBy("place")).isNull())
    own = own.withColumns({"final": final, "depth": depth})
    closed = _ends(F.col("inside"), F.col("quotes_before") + F.col("quotes"))
    own = own.withColumn("end", closed & (F.col("depth") == 1) & ~F.col("final"))
    before = Window.partitionBy(*_RANGE).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    file = F.col("source_file")
    # An array ends with a bracket, so a brace at the very end is one too many or the end of a cut file.
    last = F.when(F.col("open_end").isNull(), _fail("a compressed or changed file", file)).when(
        ~F.col("open_end"), _fail("no single array of objects", file)
    ).otherwise(F.col("value"))
    text = F.when(F.col("final"), last).otherwise(F.concat("value", F.lit("}")))
    own = own.select(
        *_RANGE, "place", "end", "records", text.alias("text"),
        F.coalesce(F.sum(F.col("end").cast("int")).over(before), F.lit(0)).alias("part"),
    )
    # Same range, same task: no further shuffle.
    cut = _joined(own, [*_RANGE, "part"], "place", F.max("end").alias("end"), F.max("records").alias("records")).withColumn(
        "number", F.col("records") + F.col("part")
    )
    # Written once: whole records and the cut off ones are read from it, and the text is not cut twice.
    cut = stored(cut.select(*_RANGE, "part", "number", "end", "text"), "array-records")
    first = (F.col("part") == 0) & (F.col("block") > 0)
    whole = cut.filter(F.col("end") & ~first).select("source_file", "number", "text", "end")
    rest = _joined(cut.filter(~F.col("end") | first), ["source_file", "number"], "block", F.max("end").alias("end"))
    found = whole.unionByName(rest).select(
        "source_file", _as_array(F.col("text"), F.col("number"), F.col("end"), F.col("source_file")).alias("array")
    )
    # Null where there are no items; the generator keeps none of these.
    parsed = F.from_json("array", f"array<{item}>", {"mode": "FAILFAST"})
    return found.select(F.explode(parsed).alias("value"), "source_file")
