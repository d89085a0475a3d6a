"""Records that go over line ends, read in as many tasks as their files have blocks.

A block alone does not tell whether it begins inside of a quoted cell, or how deep inside of an object. So a task reads its
block under every state it may begin in. One row per block is enough to tell, by running sums over a file's blocks, in
which it does begin, and only records of several parts are put together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.dedup import ORDINAL
from .shared import gathered, materialise
from .shipping import ship_package

# A line that begins outside of quotes and ends inside of a quoted cell. Quotes count only where a cell begins.
_ENDS_INSIDE = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+,)*+"[^"]*+(?:""[^"]*+)*+$'
# Strings of JSON text, also one that the text breaks off in, and what may follow a backslash.
_ESCAPE, _STRING = r"\\.", r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|$)'


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files without their headers, as text with their arrival position.

    Lines end with a line feed, or with a carriage return and a line feed if a file's first line does; inside of cells
    both become a line feed then. Quotes are escaped by doubling. Empty lines outside of cells are no records; an
    unclosed cell runs to the end of its file.
    """
    # A line without quotes ends as it begins.
    value, quoted = F.col("value"), F.contains("value", F.lit('"'))
    lines = _parts(spark, path, "\n").select(
        "*", F.when(quoted, value.rlike(_ENDS_INSIDE)).otherwise(False).alias("from_outside"),
        F.when(quoted, F.concat(F.lit('"'), value).rlike(_ENDS_INSIDE)).otherwise(True).alias("from_inside"))
    marked = gathered(materialise(lines.mapInArrow(_mark_lines, (
        "file string, block bigint, row bigint, value string, inside_0 boolean, inside_1 boolean, after_0 boolean, after_1 boolean, "
        "opened_0 bigint, opened_1 bigint"))))
    states = _line_states(marked)
    begun = lambda name: F.when(F.col("begins_inside"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    opened = F.when(begun("opened") >= 0, F.struct("block", begun("opened").alias("row"))).otherwise(F.col("carried"))
    text = F.when(F.col("returns"), F.regexp_replace("value", r"\r\z", "")).otherwise(F.col("value"))
    # One row per block, so a broadcast keeps all lines where they are.
    placed = marked.join(F.broadcast(states), ["file", "block"]).select(
        "file", "block", "row", text.alias("value"), "header", opened.alias("opened"), (begun("inside") | begun("after")).alias("several"))
    records = _joined(placed, "\n").where((F.col("value") != "") & F.coalesce(F.col("opened") != F.col("header"), F.lit(True)))
    return records.select("value", _ordinal("opened"))


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """Objects of files that hold one JSON array each, as text with their arrival position.

    Files are cut at closing braces; a part is a whole object unless braces are nested or stand in a text. What stands
    between objects stays with the next one, and an object that a file breaks off in stays as it is, so whoever parses
    the records fails on them. Commas, blanks and the brackets of the array go.
    """
    def braces(text: Column) -> Column:
        bare = F.regexp_replace(text, _STRING, "")
        return F.length(bare) - F.length(F.replace(bare, F.lit("{"), F.lit("")))

    value = F.col("value")
    bare = F.regexp_replace(value, _ESCAPE, "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    parts = _parts(spark, path, "}").select("file", "block", "value", (quotes % 2 == 1).alias("turns"),
                                            braces(value).alias("deeper_0"), braces(F.concat(F.lit('"'), value)).alias("deeper_1"))
    marked = gathered(materialise(parts.mapInArrow(_mark_braces, (
        "file string, block bigint, row bigint, value string, after_0 boolean, depth_0 bigint, depth_1 bigint, end_0 bigint, end_1 bigint"))))
    chosen = lambda name: F.when(F.col("begins_inside"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    blocks = _brace_states(marked)
    placed = marked.join(F.broadcast(blocks), ["file", "block"]).select(
        "file", "block", "row", "value", (F.col("depth") + chosen("depth")).alias("before"), (F.col("depth") + chosen("end")).alias("after"),
        ((F.col("block") == F.col("last_block")) & (F.col("row") == F.col("last_row"))).alias("last"))
    whole = (F.col("before") == 0) & (F.col("after") == 0)
    # Parts of nested records find the part that opened theirs inside their block, or in an earlier one.
    in_block = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    nested = placed.where(~whole).withColumn(
        "opened", F.last(F.when(F.col("before") == 0, F.struct("block", "row")), ignorenulls=True).over(in_block))
    lasts = placed.where(~whole & (F.col("before") == 0)).groupBy("file", "block").agg(F.max("row").alias("row"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("file", "block").join(lasts, ["file", "block"], "left").select(
        "file", "block", F.last(F.when(F.col("row").isNotNull(), F.struct("block", "row")), ignorenulls=True).over(earlier).alias("carried"))
    nested = nested.join(carried, ["file", "block"]).withColumn("opened", F.coalesce("opened", "carried", F.struct("block", "row"))).drop("carried")
    placed = placed.where(whole).withColumn("opened", F.struct("block", "row")).unionByName(nested)
    closed = placed.select("file", "block", "row", "opened", (~whole).alias("several"),
                           F.when(F.col("last"), F.col("value")).otherwise(F.concat("value", F.lit("}"))).alias("value"))
    text = F.regexp_replace("value", r"^[\s,\[\]\x{FEFF}]++", "")
    return _joined(closed, "").withColumn("value", text).where("value != ''").select("value", _ordinal("opened"))


def _parts(spark: SparkSession, path: str, end: str) -> DataFrame:
    ship_package(spark)
    return gathered(spark.read.option("lineSep", end).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))


def _ordinal(opened: str) -> Column:
    return F.struct(F.col("file").alias("file_path"), F.col(opened)["block"].alias("file_block_start"), F.col(opened)["row"].alias("row")).alias(ORDINAL)


def _joined(placed: DataFrame, glue: str) -> DataFrame:
    """Records, of which those of several parts are put together."""
    groups = placed.where("several").groupBy("file", "opened", *[c for c in placed.columns if c == "header"]).agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("parts"))
    joined = groups.select(*[c for c in groups.columns if c != "parts"], F.array_join(F.transform("parts", lambda x: x["value"]), glue).alias("value"))
    return placed.where("NOT several").select(*joined.columns).unionByName(joined)


def _line_states(marked: DataFrame) -> DataFrame:
    """Per block whether it begins inside of a cell, the line that opened that cell, and the header's line."""
    blocks = marked.groupBy("file", "block").agg(
        F.max_by(F.struct(F.col("after_0").cast("int").alias("a"), F.col("after_1").cast("int").alias("b")), "row").alias("end"),
        F.max("opened_0").alias("opened_0"), F.max("opened_1").alias("opened_1"), F.min(F.when(~F.col("value").isin("", "\r"), F.col("row"))).alias("filled"),
        F.bool_or((F.col("block") == 0) & (F.col("row") == 0) & F.col("value").endswith("\r")).alias("returns"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    earlier = upto.rowsBetween(Window.unboundedPreceding, -1)
    # A block whose end does not depend on its begin settles the state; one that turns it over counts.
    turned = blocks.withColumn("turns", F.sum((F.col("end.a") > F.col("end.b")).cast("int")).over(upto))
    settled = F.last(F.when(F.col("end.a") == F.col("end.b"), F.struct(F.col("end.a").alias("state"), "turns")), ignorenulls=True).over(earlier)
    known = turned.withColumns({"settled": settled, "turns": F.coalesce(F.lag("turns").over(Window.partitionBy("file").orderBy("block")), F.lit(0))})
    state = F.coalesce(F.col("settled.state") + F.col("turns") - F.col("settled.turns"), F.col("turns")) % 2
    known = known.withColumn("begins_inside", state == 1)
    last = F.when(F.col("begins_inside"), F.col("opened_1")).otherwise(F.col("opened_0"))
    return known.select(
        "file", "block", "begins_inside",
        F.last(F.when(last >= 0, F.struct("block", last.alias("row"))), ignorenulls=True).over(earlier).alias("carried"),
        F.bool_or("returns").over(Window.partitionBy("file")).alias("returns"),
        F.min(F.when(F.col("filled").isNotNull(), F.struct("block", F.col("filled").alias("row")))).over(Window.partitionBy("file")).alias("header"))


def _brace_states(marked: DataFrame) -> DataFrame:
    """Per block whether it begins inside of a text, the number of open braces, and the file's last part."""
    blocks = marked.groupBy("file", "block").agg(
        F.max_by(F.struct(F.col("after_0").cast("int").alias("turns"), F.col("end_0").alias("a"), F.col("end_1").alias("b")), "row").alias("end"),
        F.max("row").alias("row"))
    file, order = Window.partitionBy("file"), Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    known = blocks.withColumn("begins_inside", F.coalesce(F.sum("end.turns").over(earlier), F.lit(0)) % 2 == 1)
    deeper = F.when(F.col("begins_inside"), F.col("end.b")).otherwise(F.col("end.a"))
    return known.select("file", "block", "begins_inside", F.coalesce(F.sum(deeper).over(earlier), F.lit(0)).alias("depth"),
                        F.max("block").over(file).alias("last_block"),
                        F.max_by("row", "block").over(file).alias("last_row"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Stretches of rows of one block each, and whether the block is another than before."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column("file").dictionary_encode().indices.to_numpy()
        starts = batch.column("block").to_numpy()
        cuts = np.flatnonzero((files[1:] != files[:-1]) | (starts[1:] != starts[:-1])) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:]):
            here = batch.column("file")[begin].as_py(), int(starts[begin])
            yield here != before, batch.slice(begin, end - begin)
            before = here


def _mark_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number in the block; if it begins outside (0) or inside of a cell (1), whether they begin and end inside, and
    the line that opened their record."""
    for new, part in _runs(batches):
        if new:
            number, state, last = 0, [False, True], [-1, -1]
        outside, inside = (part.column(name).to_numpy(zero_copy_only=False) for name in ("from_outside", "from_inside"))
        rows, at = number + np.arange(part.num_rows), np.arange(part.num_rows)
        turns = np.cumsum(outside & ~inside)
        settled = np.maximum.accumulate(np.where(outside == inside, at, -1))
        found = {}
        for h in (0, 1):
            base = np.where(settled >= 0, outside[settled], state[h])
            after = base ^ ((turns - np.where(settled >= 0, turns[settled], 0)) % 2 == 1)
            begins = np.concatenate([[state[h]], after[:-1]])
            opened = np.maximum(np.maximum.accumulate(np.where(begins, -1, rows)), last[h])
            state[h], last[h] = bool(after[-1]), int(opened[-1])
            found |= {f"inside_{h}": begins, f"after_{h}": after, f"opened_{h}": opened}
        number += part.num_rows
        names = ["inside_0", "inside_1", "after_0", "after_1", "opened_0", "opened_1"]
        yield pa.RecordBatch.from_arrays([part.column("file"), part.column("block"), pa.array(rows), part.column("value"),
                                          *[pa.array(found[n]) for n in names]], ["file", "block", "row", "value", *names])


def _mark_braces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts with their number in the block; the open braces before and after them, counted from the block's begin, if it
    begins outside (0) or inside of a text (1); and whether they end inside of a text in the first case."""
    for new, part in _runs(batches):
        if new:
            number, state, depth = 0, False, [0, 0]
        turns = np.cumsum(part.column("turns").to_numpy(zero_copy_only=False)) % 2 == 1
        after = turns ^ state
        before = np.concatenate([[state], after[:-1]])
        deeper = [part.column(f"deeper_{h}").to_numpy().astype(np.int64) for h in (0, 1)]
        found = {}
        for h in (0, 1):
            begins, ends = before ^ bool(h), after ^ bool(h)
            # The brace that the part was cut at closes an object unless it stands in a text.
            step = np.where(begins, deeper[1], deeper[0]) - ~ends
            end = depth[h] + np.cumsum(step)
            found |= {f"depth_{h}": np.concatenate([[depth[h]], end[:-1]]), f"end_{h}": end}
            depth[h] = int(end[-1])
        rows = number + np.arange(part.num_rows)
        state, number = bool(after[-1]), number + part.num_rows
        found["after_0"] = after
        names = ["after_0", "depth_0", "depth_1", "end_0", "end_1"]
        yield pa.RecordBatch.from_arrays([part.column("file"), part.column("block"), pa.array(rows), part.column("value"),
                                          *[pa.array(found[n]) for n in names]], ["file", "block", "row", "value", *names])
