"""Benchmark decontamination by template canonicalisation. DataFrame operations only.

A text's template has typed placeholders for its numbers, units and names, so that a question with other parameters has
the same template. Windows of WINDOW template words are hashed and joined to the benchmark's; a document that holds at
least SHARE of an item's distinct windows holds the item, if the values in the slots go over from the item consistently:
each value of the item becomes one value of the document, within one occurrence of the item (one shift between their
places) or over all together. Only values that the item has twice or more can go over inconsistently. A template window
needs OWN_WORDS words of its own, and an item is looked for by its template only if half of its windows have them: a title or
a row of numbers is found word by word only. Windows of the plain words, in lower case, are joined beside them: a document that holds
SHARE of those repeats the item word by word and needs no such check.

A document with SHARE of an item's n windows holds at least one of any n - ceil(SHARE * n) + 1 of them, so only the
windows that the fewest documents have make candidates, and the others are looked at for candidates alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logharrow.llm.columns import let
from logharrow.llm.scratch import materialise

WINDOW, SHARE, CONSISTENT, OWN_WORDS = 5, 0.8, 0.8, 2
#: Benchmark windows up to this number are broadcast (16 bytes a row); more are joined by a shuffle.
BROADCAST_WINDOWS = 500_000
#: Units and number words with placeholders of their own. Fixed values.
UNITS = "mm cm dm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds oz ounce ounces ml cl l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hour hours day days week weeks month months year years cent cents dollar dollars euro euros usd eur percent degree degrees mph kmh watt watts volt volts joule joules".split()
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
#: Words that are no names, whether a sentence or a title gives them a capital. Fixed values.
NO_NAMES = "The An And Or But If Of In On At To From For With By As Is Are Was Were Be Been Do Does Did Has Have Had How What When Where Who Whom Whose Which Why Can Could Will Would Shall Should May Might Must Not No Yes This That These Those There Here It Its He She They We You His Her Their Our Your My Then Than So After Before While During Because Since Until Each Every All Both Some Any Many Much More Most Let Find Give Given Write Choose About Into Over Under Between".split()
#: A capital and a small letter at the start of another word make a name, wherever it stands in a sentence.
NAME = r"(?=\p{Lu})(?!(?:" + "|".join(NO_NAMES) + r")(?![\p{L}\p{N}'\-]))\p{Lu}(?<![\p{L}\p{N}'\-].)\p{Ll}"
#: Punctuation at the ends of words.
EDGES = r"[\p{P}\p{S}]+(?=\s|$)|(?<=\s)[\p{P}\p{S}]+|^[\p{P}\p{S}]+"
#: Placeholders as single control characters, which no text has after cleaning; PERSON also marks names in words().
NUM, UNIT, PERSON = "\u0001", "\u0002", "\u0003"


def words(text: Column) -> Column:
    """Words in lower case without punctuation at their ends; PERSON stands before a name."""
    clean = F.regexp_replace(text, r"[\u0001-\u0003]", " ")
    marked = F.lower(F.regexp_replace(clean, NAME, PERSON + "$0"))
    return F.filter(F.split(F.regexp_replace(marked, EDGES, ""), r"[\s|]+"), lambda w: w != "")


def plain(word: Column) -> Column:
    """A word of words() without its mark."""
    return F.when(word.startswith(PERSON), F.substring(word, F.lit(2), F.length(word))).otherwise(word)


def _is_number(word: Column) -> Column:
    return F.substring(word, 1, 1).between("0", "9") | word.isin(NUMBERS)


def slot(word: Column, i: Column, all_words: Column, value=F.lit) -> Column:
    """The placeholder that a word has in the template, null if it stays itself. A unit is one only after a number."""
    unit = word.isin(UNITS) & F.coalesce(_is_number(F.get(all_words, i - 1)), F.lit(False))
    return F.when(word.startswith(PERSON), value(PERSON)).when(_is_number(word), value(NUM)).when(unit, value(UNIT))


def word_hashes(of: Column) -> Column:
    """Struct of two arrays over words(): p, hashes of the plain words, and t, of their places in the template."""
    code = lambda placeholder: F.xxhash64(F.lit(placeholder))
    template = lambda ws, ps: F.transform(ws, lambda w, i: F.coalesce(slot(w, i, ws, code), F.get(ps, i)))
    return let(of, lambda ws: let(F.transform(ws, lambda w: F.xxhash64(plain(w))), lambda ps: F.struct(ps.alias("p"), template(ws, ps).alias("t"))))


def window_hash(hashes: Column, i: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[F.get(hashes, i + k) for k in range(n)])


def _starts(hashes: Column, n: int) -> Column:
    return F.when(F.size(hashes) >= n, F.sequence(F.lit(0), F.size(hashes) - n)).otherwise(F.array().cast("array<int>"))


def windows(df: DataFrame, key: str, text_col: str = "text", short: tuple[int, ...] = ()) -> DataFrame:
    """key, pos, h: the template windows of every row, and the plain ones where these differ; and plain windows of `short` words."""
    entry = lambda pos, h: F.struct(pos.alias("pos"), h.alias("h"))

    def found(of: Column) -> Column:
        both = F.transform(_starts(of["p"], WINDOW), lambda i: F.struct(i.alias("pos"), window_hash(of["t"], i, WINDOW).alias("t"), window_hash(of["p"], i, WINDOW).alias("p")))
        long = let(both, lambda ws: F.concat(F.transform(ws, lambda w: entry(w["pos"], w["t"])), F.transform(F.filter(ws, lambda w: w["t"] != w["p"]), lambda w: entry(w["pos"], w["p"]))))
        of_length = lambda n: F.transform(_starts(of["p"], n), lambda i: entry(i, window_hash(of["p"], i, n)))
        return F.concat(long, *map(of_length, short))

    cut = df.select(F.col(key), words(F.col(text_col)).alias("words"))
    return cut.select(key, F.explode(let(word_hashes(F.col("words")), found)).alias("w")).select(key, "w.pos", "w.h")


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, pos, h, variant, n_words. Variant 0: template windows with words of their own, of items where half of them have these; 1: plain windows, of items with slots; 2: all words of an item of under WINDOW words."""
    cut = items.select("item_id", words(F.col("text")).alias("words")).select("item_id", F.size("words").alias("n_words"), word_hashes(F.col("words")).alias("hs"))
    part = lambda kind: F.transform(_starts(F.col("hs.p"), WINDOW), lambda i: F.struct(i.alias("pos"), window_hash(F.col(f"hs.{kind}"), i, WINDOW).alias("h")))
    own = lambda i: F.aggregate(F.array(*[(F.get("hs.t", i + k) == F.get("hs.p", i + k)).cast("int") for k in range(WINDOW)]), F.lit(0), lambda a, b: a + b) >= OWN_WORDS
    worded = F.transform(_starts(F.col("hs.p"), WINDOW), own)
    by_template = cut.withColumn("worded", worded).where(2 * F.size(F.filter("worded", lambda w: w)) >= F.size("worded"))
    kept = lambda: F.filter(part("t"), lambda w: F.get("worded", w["pos"]))
    template_rows = by_template.select("item_id", "n_words", F.explode(kept()).alias("w"))
    out = [template_rows.select("item_id", "w.pos", "w.h", F.lit(0).alias("variant"), "n_words")]
    for variant, kind, rows in ( (1, "p", cut.where(F.col("hs.t") != F.col("hs.p"))),):
        out.append(rows.select("item_id", "n_words", F.explode(part(kind)).alias("w")).select("item_id", "w.pos", "w.h", F.lit(variant).alias("variant"), "n_words"))
    for n in range(1, WINDOW):
        out.append(cut.where(F.col("n_words") == n).select("item_id", F.lit(0).alias("pos"), window_hash(F.col("hs.p"), F.lit(0), n).alias("h"), F.lit(2).alias("variant"), "n_words"))
    return reduce(DataFrame.unionByName, out)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row a leak: doc (struct of id and text hash), item_id, share, consistency, n_slots; leaks only.

    An item of under WINDOW words is one window: a document holds it if it holds all its words in a row. Null and blank
    texts and items are never leaks. An empty side gives an empty result. Equal items are found each.
    """
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text")).alias("doc"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text"))
    wanted = materialise(item_windows(items), "benchmark-windows")
    short = tuple(sorted(r.n_words for r in wanted.where("variant = 2").select("n_words").distinct().collect()))  # four at most
    known = wanted.select("h").distinct()
    small = wanted.count() <= BROADCAST_WINDOWS
    fit = F.broadcast if small else lambda df: df
    # whichever windows of the documents the benchmark knows
    met = materialise(windows(keyed, "doc", short=short).join(fit(known), "h", "left_semi"), "met")
    held = met.select("doc", "h").distinct()

    # candidates by the rarest windows of each item; verified over all its windows
    parts = ["item_id", "variant"]
    own = wanted.select(*parts, "h").distinct()
    spread = materialise(met.groupBy("h").agg(F.count("*").alias("places")), "window-counts")  # at most one row a benchmark window
    ranked = own.join(fit(spread), "h").withColumn("turn", F.row_number().over(Window.partitionBy(*parts).orderBy("places", "h")))
    absent = own.groupBy(*parts).agg(F.count("*").alias("total")).join(own.join(fit(spread), "h", "left_anti").groupBy(*parts).agg(F.count("*").alias("absent")), parts, "left")
    # windows that no document has are the rarest of all and make no candidates
    chosen = F.col("total") - F.ceil(SHARE * F.col("total") - 1e-9) + 1 - F.coalesce("absent", F.lit(0))
    probes = materialise(ranked.join(fit(absent), parts).where(F.col("turn") <= chosen).select(*parts, "h", "total"), "probes")
    candidates = held.join(fit(probes), "h").select("doc", *parts, "total").distinct()
    shared = candidates.join(fit(own), parts).join(held, ["doc", "h"]).groupBy("doc", *parts, "total").agg(F.count("*").alias("shared"))
    shared = shared.withColumn("share", F.col("shared") / F.col("total")).where(F.col("shared") >= SHARE * F.col("total") - 1e-9)
    shared = materialise(shared.select("doc", *parts, "share", "total"), "pairs")
    pairs = shared.groupBy("doc", "item_id").agg(F.max("share").alias("share"), F.max(F.when(F.col("variant") > 0, 1.0)).alias("verbatim"))

    # slots: values at the same place of a shared window, only for pairs that aren't word by word and whose item has slots
    slotted = items.select("item_id", words(F.col("text")).alias("w")).withColumn("t", template(F.col("w"))).withColumn("again", repeated(F.col("w"), F.col("t"))).where(F.size("again") > 0)
    check = shared.where("variant = 0").join(pairs.where("verbatim is null").select("doc", "item_id"), ["doc", "item_id"]).select("doc", "item_id", "total").join(fit(slotted), "item_id")
    check = materialise(check, "slot-pairs")
    texts = keyed.join(check.select("doc").distinct(), "doc", "left_semi").select("doc", words(F.col("text")).alias("dw")).distinct()
    places = wanted.where("variant = 0").select("item_id", "h", F.col("pos").alias("q"))
    hits = met.join(check.select("doc", "item_id"), "doc").join(fit(places), ["item_id", "h"]).join(check, ["doc", "item_id"]).join(texts, "doc")
    part = lambda of, at: F.slice(of, F.col(at).cast("int") + 1, WINDOW)
    hits = hits.select("doc", "item_id", "total", "h", "pos", "q", part("w", "q").alias("a"), part("dw", "pos").alias("b"), part("t", "q").alias("t"), "again")
    hits = materialise(hits.withColumn("shift", F.col("pos") - F.col("q")), "slot-windows")
    # every shift is an occurrence of its own; null stands for all of them together, for copies with words put in or left out
    at = F.explode(F.array(*[F.struct((F.col("pos") + k).alias("p"), (F.col("q") + k).alias("q"), plain(F.get("a", F.lit(k))).alias("a"), plain(F.get("b", F.lit(k))).alias("b"), F.get("t", F.lit(k)).alias("t")) for k in range(WINDOW)]))
    values = hits.select("doc", "item_id", "shift", "again", at.alias("at")).where("at.t is not null").where(F.array_contains("again", F.col("at.a"))).select("doc", "item_id", "shift", "at").distinct()
    values = values.select("doc", "item_id", F.explode(F.array("shift", F.lit(None).cast("int"))).alias("shift"), "at.a", "at.b")
    counts = values.groupBy("doc", "item_id", "shift", "a", "b").agg(F.count("*").alias("n"))
    by_value = counts.groupBy("doc", "item_id", "shift", "a").agg(F.max("n").alias("most"), F.sum("n").alias("all"))
    slots = by_value.groupBy("doc", "item_id", "shift").agg((F.sum("most") / F.sum("all")).alias("consistency"), F.sum("all").alias("n_slots"))
    # an occurrence counts alone if it holds enough of the item
    whole = hits.groupBy("doc", "item_id", "shift", "total").agg(F.count_distinct("h").alias("held")).where(F.col("held") >= SHARE * F.col("total") - 1e-9).select("doc", "item_id", "shift")
    alone = slots.join(whole, ["doc", "item_id", "shift"], "left_semi").unionByName(slots.where("shift is null"))
    best = alone.groupBy("doc", "item_id").agg(F.max("consistency").alias("consistency"), F.max("n_slots").alias("n_slots"))
    judged = pairs.join(best, ["doc", "item_id"], "left")
    judged = judged.select("doc", "item_id", "share", F.coalesce("verbatim", "consistency", F.lit(1.0)).alias("consistency"), F.coalesce("n_slots", F.lit(0)).alias("n_slots"))
    return judged.where(F.col("consistency") >= CONSISTENT)


def repeated(of: Column, placeholders: Column) -> Column:
    """The values in the slots of words() that stand there twice or more."""
    values = F.transform(F.filter(F.arrays_zip(of.alias("w"), placeholders.alias("t")), lambda x: x["t"].isNotNull()), lambda x: plain(x["w"]))
    return let(values, lambda vs: F.filter(F.array_distinct(vs), lambda v: F.size(F.filter(vs, lambda x: x == v)) > 1))


def template(of: Column) -> Column:
    """The placeholders of words(); null where a word stays itself."""
    return let(of, lambda ws: F.transform(ws, lambda w, i: slot(w, i, ws)))


def mark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs and n_items (long), item_ids (array, ascending), best_share; replacing columns of these names.

    Rows that repeat an id are told apart by a hash of their text; null and blank texts hold no item. Very long texts are
    windowed whole. Extra columns stay as they are.
    """
    leaks = contaminated(docs, benchmark, id_col, text_col)
    found = leaks.groupBy("doc").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("item_id")).alias("items"), F.max("share").alias("share"))
    rows = docs.select(F.struct("*").alias("row"), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text")).alias("doc"))
    others = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("n_items", "item_ids", "best_share")]
    joined = rows.join(found, "doc", "left")
    return joined.select(*others, F.coalesce("n", F.lit(0)).alias("n_items"), F.coalesce("items", F.array().cast("array<long>")).alias("item_ids"), F.col("share").alias("best_share"))
