"""PII: keyed surrogates for detected entities. DataFrame operations only.

Each distinct entity gets one surrogate for the whole corpus, derived from a secret key by SHA-256, with the entity's
type, script, letter case and format. Surrogates are checked against each other and against all real entities, and
drawn again on a collision, so different entities stay different and each entity stays the same everywhere.

A person's given name and surname have surrogates of their own, so that "Mr Ivan Petrov" and "Mr Petrov" stay one person.
Within a text that introduces a name by a title or a known given name, its other mentions are replaced as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logharrow.llm.columns import let
from logharrow.llm.scratch import materialise

#: Titles by gender (n: either), and given names that make a person with a capitalised word after them. Fixed values.
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "Don"],
    "f": ["Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Signora", "Doña"],
    "n": ["Dr", "Doctor", "Prof", "Professor"],
}
KNOWN = {
    "m": "Adam Alan Albert Alexander Andreas Andrew Anthony Antonio Arthur Benjamin Bernard Brian Carlos Charles Christian Christopher Daniel David Diego Dmitri Edward Emil Eric Felix Francisco Frank François Frederick Gabriel George Giovanni Hans Harold Heinrich Henry Hugo Ivan Jack Jacob Jacques James Javier Jean Jeffrey John Jonathan Jorge Joseph José Joshua Juan Jürgen Karl Kenneth Kevin Klaus Lars Laurent Lewis Louis Luis Manuel Marco Mark Martin Matthew Michael Michel Miguel Mohammed Nicholas Olivier Oscar Pablo Patrick Paul Pedro Peter Philip Pierre Ralph Raymond Richard Robert Roger Ronald Samuel Sergei Simon Stefan Stephen Steven Thomas Timothy Vladimir Walter Werner William Wolfgang".split(),
    "f": "Alice Amanda Amy Andrea Angela Anita Anna Anne Antonia Barbara Beatrice Berta Carmen Carol Caroline Catherine Charlotte Christina Christine Claire Claudia Cynthia Deborah Diana Dolores Dorothy Eleanor Elena Elisabeth Elizabeth Emily Emma Eva Fatima Florence Françoise Gabriele Gloria Grace Hannah Heidi Helen Helga Ingrid Irina Isabel Isabelle Jacqueline Janet Jennifer Jessica Joan Joanna Josephine Judith Julia Juliette Karen Katharina Kathleen Laura Linda Lisa Lucia Lucy Margaret Maria Marie Martha Mary María Melissa Michelle Monica Monika Nancy Natalia Nathalie Nicole Olga Patricia Paula Rachel Rebecca Renate Rosa Ruth Sabine Sandra Sarah Sharon Sofia Sophie Stephanie Susan Susanne Svetlana Teresa Ursula Valentina Victoria Virginia Yolanda".split(),
}
_TITLE = "(?:" + "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True)) + r")\.? (?:(?:Dr|Prof)\.? )?"
_KNOWN = "(?:" + "|".join(n for ns in KNOWN.values() for n in ns) + ")"
_WORD = r"\p{Lu}(?:\p{L}+(?:['\-]\p{L}{2,})*|['\-]\p{L}{2,})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Detection patterns, tried in this order at each place of a text.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}](?:[\p{L}\p{N}\-]*\.)+\p{L}{2,24}",
    "secret": r"(?<![\p{L}\p{N}])(?=[a-fA-F]*\d)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\p{L}\p{N}])",
    "key": r"(?<![\p{L}\p{N}])(?:A[KS]IA[0-9A-Z]{16}|gh[opsru]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z\-]{20,64})(?![\p{L}\p{N}])",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![\p{{L}}\p{{N}}:])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\d])(?:(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}|(?:\+\d{1,3}[ .\-]?\d{2,4}|0\d{2,4})[ .\-/]\d{5,8})(?!\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "card": r"(?<!\d)(?:\d{4}[ \-]?){3}\d{4}(?!\d)",
    "person": rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{_TITLE}{_WORD}(?: {_WORD})?|{_KNOWN} {_WORD})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these cannot match.
MAYBE = rf"[0-9@]|::|(?<!\p{{L}})(?=\p{{Lu}})(?:{_TITLE}|{_KNOWN} )\p{{Lu}}"
#: Where a capitalised word starts or a word ends (before a possessive, too).
WORD_EDGES = r"(?<![\p{L}'\-])(?=\p{Lu})|(?<=\p{L})(?![\p{L}'\-])|(?<=\p{L})(?=['\-](?:s\b|\P{L}|$))"
#: Letters of each script that stand for each other, and names by gender. Fixed values.
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя"}
GIVEN = {"m": ["Adam", "Boris", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Marco", "Nico", "Oscar", "Paul"], "f": ["Anna", "Berta", "Clara", "Diana", "Elena", "Frida", "Greta", "Helena", "Irene", "Julia", "Karin", "Laura", "Maria", "Nina", "Olga", "Paula"]}
GIVEN["n"] = GIVEN["m"] + GIVEN["f"]
#: Draws in one format; after each so many the surrogate gets one character more, so that a free one is always found.
ROUNDS = 20


def _bound(stream: Column, value: Column, f) -> Column:
    """Map each character by its number in the string and the stream, and join again."""
    return let(stream, lambda s: F.array_join(F.transform(F.split(value, ""), lambda c, i: f(c, i, s)), ""))


def _draw(stream: Column, i: Column, n: int) -> Column:
    """Number below n from the i-th four hex digits of the stream, which starts anew at its end."""
    at = (i * 4) % (F.length(stream) - 3) + 1
    return (F.conv(F.substring(stream, at, 4), 16, 10).cast("int") % n).cast("int")


def _pick(alphabet: str, stream: Column, i: Column) -> Column:
    return F.substring(F.lit(alphabet), _draw(stream, i, len(alphabet)) + 1, F.lit(1))


def _letters(value: Column, stream: Column) -> Column:
    """Letters for letters of the same script and case, digits for digits, all else as it is."""

    def one(c, i, stream):
        out = F.when(c.rlike(r"^\p{IsGreek}$"), _pick(ALPHABETS["greek"], stream, i)).when(c.rlike(r"^\p{IsCyrillic}$"), _pick(ALPHABETS["cyrillic"], stream, i))
        out = out.when(c.rlike(r"^\p{L}$"), _pick(ALPHABETS["latin"], stream, i)).when(c.rlike(r"^\d$"), _pick("0123456789", stream, i)).otherwise(c)
        return F.when(c.rlike(r"^\p{Lu}$"), F.upper(out)).otherwise(out)

    return _bound(stream, value, one)


def _hex(value: Column, stream: Column) -> Column:
    return _bound(stream, value, lambda c, i, s: F.when(c == ":", c).otherwise(_pick("0123456789abcdef", s, i)))


def _digits(value: Column, stream: Column, keep: int) -> Column:
    return _bound(stream, value, lambda c, i, s: F.when(i < keep, c).otherwise(_draw(s, i, 10).cast("string")))


def _luhn(digits: Column) -> Column:
    """Luhn sum of digits, modulo 10, as if one more digit followed."""
    spread = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(spread, F.lit(0), lambda a, x: a + x) % 10


def _card(value: Column, stream: Column, extra: int) -> Column:
    """Digits with a right check digit where the real number has one, and a wrong one where not."""
    body = lambda v: F.substring(v, F.lit(1), F.length(v) - 1)
    check = lambda v: (10 - _luhn(v)) % 10
    wrong = F.when(check(body(value)) == F.substring(value, -1, 1).cast("int"), 0).otherwise(1)
    return let(_digits(F.concat(body(value), F.lit("0" * extra)), stream, 0), lambda b: F.concat(b, ((check(b) + wrong) % 10).cast("string")))


def _iban(value: Column, stream: Column, extra: int) -> Column:
    """The country, right check digits, and characters of the same classes."""
    rest = F.concat(F.substring(value, F.lit(5), F.length(value)), F.lit("0" * extra))
    number = lambda c: F.when(c.rlike(r"^\d$"), c.cast("int")).otherwise(F.ascii(c) - 55)
    mod = lambda text: F.aggregate(F.split(text, ""), F.lit(0), lambda r, c: ((r * F.when(c.rlike(r"^\d$"), 10).otherwise(100) + number(c)) % 97).cast("int"))
    country = F.substring(value, 1, 2)
    return let(_letters(rest, stream), lambda b: F.concat(country, F.lpad((98 - mod(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))


def _sha(key: str, *parts: Column) -> Column:
    """Two blocks of keyed hex digits; the parts are told apart by their lengths."""
    text = F.concat_ws("|", F.lit(key), *[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])
    return F.concat(*[F.sha2(F.concat(F.lit(n), text).cast("binary"), 256) for n in "01"])


def kind_of(raw: Column) -> Column:
    return F.coalesce(*[F.when(raw.rlike(f"^(?:{p})$"), kind) for kind, p in PATTERNS.items()])


def parts_of(kind: Column, raw: Column) -> Column:
    """Array of (kind, value, token): what stays the same in all spellings of an entity, and the words of a person.

    Numbers are digits alone; a person has the parts "given" (with the gender before it: m, f or n) and "surname".
    """
    bare = F.regexp_replace(raw, f"^{_TITLE}", "")
    title = F.regexp_extract(raw, r"^(\p{L}+)", 1)
    first, last = F.substring_index(bare, " ", 1), F.substring_index(bare, " ", -1)
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").when(first.isin(KNOWN["m"]), "m").when(first.isin(KNOWN["f"]), "f").otherwise("n")
    part = lambda k, v, token: F.struct(F.lit(k).alias("kind") if isinstance(k, str) else k.alias("kind"), v.alias("value"), token.alias("token"))
    surname = part("surname", F.lower(last), last)
    person = F.when(bare.contains(" "), F.array(part("given", F.concat(gender, F.lit(":"), F.lower(first)), first), surname)).otherwise(F.array(surname))
    value = F.when(kind.isin("phone", "ssn", "card"), F.regexp_replace(raw, r"\D", "")).when(kind == "iban", F.regexp_replace(raw, " ", "")).when(kind == "key", raw).otherwise(F.lower(raw))
    return F.when(kind == "person", person).otherwise(F.array(part(kind, value, raw)))


def surrogate(key: str, kind: Column, value: Column, attempt: int) -> Column:
    """Surrogate in canonical form of a canonical value; the attempt is part of the key."""
    number, extra = F.lit(str(attempt)), attempt // ROUNDS
    stream = _sha(key, kind, value, number)
    host, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    top = F.substring_index(domain, ".", -1)
    inner = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    email = F.concat(_letters(F.concat(host, F.lit("x" * extra)), stream), F.lit("@"), _letters(inner, _sha(key, F.lit("domain"), inner, number)), top)  # one domain keeps one surrogate
    ip = F.concat_ws(".", *[_draw(stream, F.lit(i), 256 if i else 223).cast("string") for i in range(4 + extra)])
    keyed = F.concat(F.substring(value, 1, 4), _letters(F.concat(F.substring(value, F.lit(5), F.length(value)), F.lit("x" * extra)), stream))
    # a given name of the list at first, then letters with an ending of the gender
    gender, name = F.substring(value, 1, 1), F.substring(value, F.lit(3), F.length(value))
    listed = reduce(lambda c, g: c.when(gender == g, F.get(F.array(*map(F.lit, GIVEN[g])), _draw(stream, F.lit(60), len(GIVEN[g])))), "fn", F.when(gender == "m", F.get(F.array(*map(F.lit, GIVEN["m"])), _draw(stream, F.lit(60), len(GIVEN["m"])))))
    latin = name.rlike(r"^[\p{IsLatin}'\-]+$")
    spelt = _letters(F.concat(name, F.lit("x" * extra)), stream)
    ended = F.when(latin & (gender != "n"), F.concat(F.substring(spelt, F.lit(1), F.length(spelt) - 1), F.when(gender == "f", "a").otherwise("o"))).otherwise(spelt)
    given = F.when(latin, F.lower(listed)).otherwise(spelt) if attempt == 0 else ended
    surname = _letters(F.concat(value, F.lit("x" * extra)), stream)
    longer = F.concat(value, F.lit("0" * extra))
    out = F.when(kind == "email", email).when(kind.isin("secret", "ipv6"), _hex(longer, stream)).when(kind == "key", keyed).when(kind == "ip", ip).when(kind == "iban", _iban(value, stream, extra))
    return out.when(kind == "given", given).when(kind == "surname", surname).when(kind == "phone", _digits(longer, stream, 1)).when(kind == "card", _card(value, stream, extra)).otherwise(_digits(longer, stream, 0))


def render(kind: Column, raw: Column, stand_in: Column) -> Column:
    """Put a surrogate into the spelling of an occurrence: its separators and its letter case."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    put = lambda a, c: F.struct(F.concat(a["out"], F.substring(stand_in, a["k"], F.lit(1))).alias("out"), (a["k"] + 1).alias("k"))
    keep = lambda a, c: F.struct(F.concat(a["out"], c).alias("out"), a["k"].alias("k"))
    lay = F.aggregate(
        F.split(raw, ""), start,
        lambda a, c: F.when(c.rlike(r"^\d$") | ((kind == "iban") & c.rlike(r"^\p{L}$")), put(a, c)).otherwise(keep(a, c)),
        lambda a: F.concat(a["out"], F.substring(stand_in, a["k"], F.length(stand_in))),
    )
    all_capitals = (raw == F.upper(raw)) & (raw != F.lower(raw))
    alike = F.array_join(F.zip_with(F.split(raw, ""), F.split(stand_in, ""), lambda c, x: F.when((c == F.upper(c)) & (c != F.lower(c)), F.upper(x)).otherwise(x)), "")
    name = F.when(all_capitals, F.upper(stand_in)).when(F.length(raw) == F.length(stand_in), alike).otherwise(F.initcap(stand_in))
    cased = F.when(kind == "key", stand_in).when(all_capitals, F.upper(stand_in)).otherwise(stand_in)
    return F.when(kind.isin("phone", "ssn", "card", "iban"), lay).when(kind.isin("given", "surname"), name).otherwise(cased)


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """kind, value, stand_in of each distinct entity; no two entities of a kind share a stand-in, and none is a real value.

    Given names are only kept apart from each other: with a surname that nobody has, no real person can come out. A round
    draws for all that are open, then gives each stand-in to the least value that drew it, unless it is real or given
    already; the others draw again. Rounds are written; the driver sees counts only.
    """
    real = materialise(entities.select("kind", "value").distinct(), "entities")
    done, rest, attempt = None, real, 0
    while True:
        drawn = rest.withColumn("stand_in", surrogate(key, F.col("kind"), F.col("value"), attempt))
        order = Window.partitionBy("kind", F.lower("stand_in")).orderBy("value")
        drawn = drawn.withColumn("turn", F.row_number().over(order))
        taken = real.where("kind != 'given'").select("kind", F.lower("value").alias("used"))
        if done is not None:
            taken = taken.union(done.select("kind", F.lower("stand_in")))
        taken = taken.distinct().withColumn("is_taken", F.lit(True))
        tried = drawn.join(taken, (drawn.kind == taken.kind) & (F.lower("stand_in") == F.col("used")), "left").select(drawn.kind, "value", "stand_in", (F.col("is_taken").isNull() & (F.col("turn") == 1)).alias("good"))
        tried = materialise(tried, "stand-ins")
        good = tried.where("good").drop("good")
        done = good if done is None else done.unionByName(good)
        if tried.where(~F.col("good")).isEmpty():
            return done
        rest, attempt = tried.where(~F.col("good")).select("kind", "value"), attempt + 1


def resolve_genders(parts: DataFrame) -> DataFrame:
    """Given names without a gender take the one that they mostly have elsewhere in the corpus."""
    name = F.substring("value", F.lit(3), F.length("value"))
    given = parts.where("kind = 'given'").select(name.alias("name"), F.substring("value", 1, 1).alias("gender"))
    known = given.groupBy("name").agg(F.count_if(F.col("gender") == "m").alias("m"), F.count_if(F.col("gender") == "f").alias("f")).where("m + f > 0")
    known = materialise(known.select("name", F.when(F.col("m") >= F.col("f"), "m").otherwise("f").alias("as")), "genders")
    open_name = F.when((F.col("kind") == "given") & F.col("value").startswith("n:"), name)
    joined = parts.withColumn("name", open_name).join(known, "name", "left")
    return joined.withColumn("value", F.when(F.col("as").isNotNull(), F.concat("as", F.lit(":"), "name")).otherwise(F.col("value"))).drop("name", "as")


def replace_entities(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of df, with every detected entity in the text replaced, and n_entities (long) and kinds (array).

    n_entities counts entities and further mentions of the persons among them. Columns named n_entities or kinds are
    replaced. A null text stays null, a text without entities stays as it is. Rows are told apart by id and a hash of their
    text; rows equal in both get the same text. An empty table gives an empty result. Texts are scanned once and written
    with what was found; only rows with an entity are shuffled.
    """
    text = F.col(f"row.`{text_col}`")
    rows = df.select(F.struct("*").alias("row"), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text")).alias("doc"))
    found = materialise(rows.withColumn("raws", F.when(text.rlike(MAYBE), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))), "scanned")
    some = F.coalesce(F.size("raws") > 0, F.lit(False))
    each = found.where(some).select("doc", F.posexplode("raws").alias("i", "raw")).distinct().withColumn("whole", kind_of(F.col("raw")))
    parts = each.select("doc", "i", "raw", "whole", F.posexplode(parts_of(F.col("whole"), F.col("raw"))).alias("k", "p")).select("doc", "i", "raw", "whole", "k", "p.kind", "p.value", "p.token")
    parts = materialise(resolve_genders(materialise(parts, "parts")), "occurrences")
    put = parts.join(mapping(parts, key), ["kind", "value"])
    put = put.withColumn("new", render(F.col("kind"), F.col("token"), F.col("stand_in")))
    put = materialise(put.select("doc", "i", "raw", "whole", "k", "token", "new"), "replacements")

    before = F.regexp_extract(F.col("raw"), f"^({_TITLE})", 1)
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "new"))), lambda x: x["new"]), " ")
    whole = put.groupBy("doc", "i", "raw", F.col("whole").alias("kind")).agg(words.alias("new"))
    whole = whole.select("doc", F.struct("i", F.when(F.col("kind") == "person", F.concat(before, "new")).otherwise(F.col("new")).alias("new"), "kind").alias("e"))
    whole = whole.groupBy("doc").agg(F.array_sort(F.collect_list("e")).alias("es"))
    names = put.where("whole = 'person'").groupBy("doc", "token").agg(F.min("new").alias("new")).groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("token", "new"))).alias("names"))

    tokens = lambda piece: F.split(piece, WORD_EDGES)
    named = lambda piece: F.array_join(F.transform(tokens(piece), lambda t: F.coalesce(F.col("names")[t], t)), "")
    pieces = F.when(F.col("names").isNull(), F.col("pieces")).otherwise(F.transform("pieces", named))
    mentions = F.when(F.col("names").isNull(), 0).otherwise(F.aggregate("pieces", F.lit(0), lambda a, p: a + F.size(F.filter(tokens(p), lambda t: F.map_contains_key("names", t)))))
    new = F.array_join(F.zip_with(pieces, F.col("es"), lambda a, e: F.concat(a, F.coalesce(e["new"], F.lit("")))), "")
    others = [F.col(f"row.`{c}`") for c in df.columns if c not in (text_col, "n_entities", "kinds")]
    changed = found.where(some).drop("raws").withColumn("pieces", F.split(text, ANY, -1)).join(whole, "doc").join(names, "doc", "left")
    changed = changed.select(*others, new.alias(text_col), (F.size("es") + mentions).cast("long").alias("n_entities"), F.array_sort(F.array_distinct("es.kind")).alias("kinds"))
    same = found.where(~some).select(*others, text.alias(text_col), F.lit(0).cast("long").alias("n_entities"), F.array().cast("array<string>").alias("kinds"))
    return same.unionByName(changed)
