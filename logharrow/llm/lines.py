"""Line dedup: a suffix array over line-id sequences by distributed prefix doubling. DataFrame operations only.

The corpus is one sequence of lines, in the order of document id and line number, cut at document ends. A line that
occurs once differs from every other, so no repeated run holds it and its suffixes need no further sorting. Doubling
ranks the suffixes by their first 1, 2, 4, ... lines; the numbers are order-preserving, so a level is the suffix array to
that depth, and the rows of one rank are an interval of it with a common prefix of at least that many lines. Rows leave
as they become unique, and doubling ends when no rank has two rows.

The longest common prefix of each suffix with an earlier one follows from the levels. A suffix that is no first of its
interval at depth d, but the first at 2d, has a match of d to 2d - 1 lines; the depths below d are then tried in
turn. All suffixes of an interval are refined together: they are dealt by the rank of their next lines, and the first of
each new interval stands for it in the old one. A maximal run is a match that can't be extended to the left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logharrow.llm.columns import let
from logharrow.llm.scratch import materialise


def _at() -> Column:
    """A place in the corpus."""
    return F.struct("doc", "pos")


def line_table(rows: DataFrame) -> DataFrame:
    """From doc and text: doc, pos (over lines that aren't blank), at (over all lines), size (characters) and two hashes of each such line."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("line"))), lambda s: F.trim(s["line"]) != "")
    cut = rows.select("doc", F.posexplode(lines).alias("pos", "s"))
    return cut.select("doc", F.col("pos").cast("long").alias("pos"), F.col("s.at").alias("at"), F.char_length("s.line").alias("size"), F.xxhash64("s.line").alias("x"), F.xxhash64(F.lit(1), "s.line").alias("y"))


def _rank(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Replace the pair (x, y) by an order-preserving number and the first place of it; pairs that occur once drop out.

    The number is the pair's place in the sorted table of repeated pairs: the partition and the row in it. The table
    is written, so that the numbers stay the same whatever is lost later and a very common pair can be split in the join.
    """
    repeated = rows.groupBy(x, y).agg(F.count("*").alias("n"), F.min(_at()).alias("first")).where("n > 1").drop("n")
    ordered = repeated.repartitionByRange(x, y).sortWithinPartitions(x, y).withColumn("rank", F.monotonically_increasing_id())
    return rows.join(materialise(ordered, "ranks"), [x, y]).drop(x, y)


def _ahead(step: int) -> Column:
    """The rank `step` lines further in the same document, null if that line is no part of a repeated run."""
    return F.max("rank").over(Window.partitionBy("doc").orderBy("pos").rangeBetween(step, step))


def suffix_levels(lines: DataFrame) -> list[DataFrame]:
    """doc, pos, at, size, rank, first for the depths 1, 2, 4, ...: repeated suffixes ranked by so many lines."""
    # rows that are equal in id and text are one document
    levels = [materialise(_rank(lines, "x", "y").dropDuplicates(["doc", "pos"]), "suffixes")]
    while True:
        pairs = levels[-1].withColumn("x", F.col("rank")).withColumn("y", _ahead(1 << (len(levels) - 1))).where("y is not null").drop("rank", "first")
        deeper = materialise(_rank(pairs, "x", "y"), "suffixes")
        if deeper.isEmpty():
            return levels
        levels.append(deeper)


def _matched(level: DataFrame) -> DataFrame:
    return level.where(_at() != F.col("first"))


def longest_matches(levels: list[DataFrame]) -> DataFrame:
    """doc, pos, length, source: the longest run that starts here and at an earlier place, and the first such place.

    State: a place with its interval, which is named by its first place (source) and its depth (length). The first place
    itself has a row in which it is its own source.
    """
    state = None
    for k in range(len(levels) - 1, -1, -1):
        mine = _matched(levels[k])
        if k + 1 < len(levels):
            mine = mine.join(_matched(levels[k + 1]).select("doc", "pos"), ["doc", "pos"], "left_anti")
        mine = mine.select("doc", "pos", F.col("first").alias("source"), F.lit(1 << k).cast("long").alias("length"))
        if k:  # at depth 1 nothing is left to refine
            mine = mine.unionByName(mine.select("source.doc", "source.pos", "source", "length").distinct())
        if state is not None:
            ahead = levels[k].select("doc", F.col("pos").alias("next"), "rank")
            keyed = state.withColumn("next", F.col("pos") + F.col("length")).join(ahead, ["doc", "next"], "left").drop("next")
            keyed = materialise(keyed, "extensions")
            # written, as any number of places may share an interval
            together = keyed.where("rank is not null").groupBy("source", "length", "rank").agg(F.min(_at()).alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
            together = materialise(together, "intervals")
            found = keyed.join(together, ["source", "length", "rank"], "left")
            moves = F.col("least").isNotNull() & (F.col("least") != _at())
            moved = found.select("doc", "pos", F.when(moves, F.col("least")).otherwise(F.col("source")).alias("source"), (F.col("length") + F.when(moves, 1 << k).otherwise(0)).alias("length"))
            firsts = together.select("least.doc", "least.pos", F.col("least").alias("source"), (F.col("length") + (1 << k)).alias("length"))
            mine = mine.unionByName(moved).unionByName(firsts)
        state = mine
    return state.where(_at() != F.col("source"))


def repeated_runs(lines: DataFrame, min_lines: int, min_chars: int | None) -> tuple[DataFrame, DataFrame]:
    """Maximal runs that are later copies (doc, start, length, source), and the table of all repeated lines.

    A run counts if it has min_lines lines or more, or min_chars characters or more (None: no such rule).
    """
    levels = suffix_levels(lines)
    matches = materialise(longest_matches(levels), "matches")
    by = Window.partitionBy("doc").orderBy("pos")
    extended = (F.lag("pos").over(by) == F.col("pos") - 1) & (F.lag("length").over(by) == F.col("length") + 1)
    runs = matches.withColumn("extended", F.coalesce(extended, F.lit(False))).where("not extended").select("doc", F.col("pos").alias("start"), "length", "source")
    enough = runs.where(F.col("length") >= min_lines)
    if min_chars is not None:
        short = runs.where(F.col("length") < min_lines)
        own = short.withColumn("pos", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1))).join(levels[0].select("doc", "pos", "size"), ["doc", "pos"])
        own = own.groupBy("doc", "start", "length", "source").agg(F.sum("size").alias("size")).where(F.col("size") >= min_chars)
        enough = enough.unionByName(own.drop("size"))
    return materialise(enough, "runs"), levels[0]


def _stretches(runs: DataFrame) -> DataFrame:
    """Runs of a document that overlap or touch, as one: doc, start, end (exclusive)."""
    by = Window.partitionBy("doc").orderBy("start", "length")
    ends = runs.withColumn("end", F.col("start") + F.col("length"))
    before = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    numbered = ends.withColumn("new", F.coalesce((F.col("start") > before).cast("int"), F.lit(1))).withColumn("stretch", F.sum("new").over(by))
    return numbered.groupBy("doc", "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("stretch")


def remove_repeated_lines(df: DataFrame, min_lines: int = 2, min_chars: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of df with later copies of repeated line runs deleted from the text.

    A line goes if it lies in a run that occurs earlier, in the order of id and line, and that has min_lines lines or
    more, or min_chars characters or more without line ends; runs are judged on the input. Blank lines are no part of the
    sequences and always stay. Lines end at "\\n". Adds n_lines and n_removed (long), replacing columns of these names. A
    null text stays null and has no lines; an empty one has one blank line. A null id comes before all others. Rows that
    repeat an id are told apart by a hash of their text; rows that are equal in both are copies of no earlier row and keep
    the same lines. An empty table gives an empty result.
    """
    text = F.col(f"row.`{text_col}`")
    rows = df.select(F.struct("*").alias("row"), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text")).alias("doc"))
    lines = materialise(line_table(rows.select("doc", text.alias("text"))), "lines")
    runs, repeated = repeated_runs(lines, min_lines, min_chars)
    gone = _stretches(runs).select("doc", F.explode(F.sequence("start", F.col("end") - 1)).alias("pos")).join(repeated.select("doc", "pos", "at"), ["doc", "pos"])
    gone = gone.groupBy("doc").agg(F.collect_set("at").alias("gone"))
    cut = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col("gone"))
    whole = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(let(cut, lambda c: F.transform(kept, lambda i: F.get(c, i))), "\n"))
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(cut)).cast("long")
    n_removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
    others = [F.col(f"row.`{c}`") for c in df.columns if c not in (text_col, "n_lines", "n_removed")]
    return rows.join(gone, "doc", "left").select(*others, whole.alias(text_col), n_lines.alias("n_lines"), n_removed.alias("n_removed"))
