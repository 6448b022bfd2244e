"""Decontamination against brute force, and re-parameterised questions."""

import random
from collections import Counter, defaultdict

import regex

from logharrow.llm import decontamination as D

ITEMS = [
    (1, "A train covers 120 km in 3 hours while Anna waits for 20 minutes at the old station. How fast was it?"),
    (2, "The quick brown fox jumps over the lazy dog and then runs home through the dark wood again"),
    (3, "too short here"),
    (4, None),
]


def found(spark, docs, rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return {r.doc_id: list(r.item_ids) for r in D.mark(docs(rows), items).collect()}


def test_leaks(spark, docs, prose):
    pad = prose(40, 1)
    rows = [
        (1, f"{pad} {ITEMS[0][1]} {pad}"),
        (2, f"{pad} A train covers 95 miles in seven hours while Berta waits for 45 minutes at the old station. How fast was it? {pad}"),
        (3, f"{pad} the QUICK brown fox, jumps over the lazy dog; and then runs home through the dark wood again {pad}"),
        (4, f"{pad} the quick brown fox jumps over a cat {pad}"),
        (5, pad), (6, ""), (7, None), (8, f"{pad} is Too short, here {pad}"), (9, f"{ITEMS[1][1]} {ITEMS[0][1]}"),
        (10, "A train covers 120 km in 3 hours while Anna waits for 20 minutes at the"),
    ]
    got = found(spark, docs, rows)
    assert {i for i, x in got.items() if x} == {1, 2, 3, 8, 9} and got[9] == [1, 2] and got[2] == [1] and got[8] == [3] and len(got) == 10


def test_inconsistent_slots(spark, docs):
    text = "Take 5 apples and 5 pears then give 5 plums to 5 boys and keep 5 figs for 5 girls at noon"
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    swap = lambda values: "".join(next(values) if c == "5" else c for c in text)
    same, mixed = swap(iter("777777")), swap(iter("713942"))
    got = {r.doc_id: r.n_items for r in D.mark(docs([same, mixed]), items).collect()}
    assert got == {0: 1, 1: 0}


def brute_words(text):
    """(plain word, placeholder or None) by the rules of the operator's docstrings."""
    text = regex.sub("[\x01-\x03]", " ", text or "")
    marked = regex.sub(D.NAME, lambda m: D.PERSON + m[0], text).lower()
    ws = [w for w in regex.split(r"[\s|]+", regex.sub(D.EDGES, "", marked)) if w]
    number = lambda w: "0" <= w[0] <= "9" or w in D.NUMBERS
    return [(w.removeprefix(D.PERSON), D.PERSON if w[0] == D.PERSON else D.NUM if number(w) else D.UNIT if w in D.UNITS and k and number(ws[k - 1]) else None) for k, w in enumerate(ws)]


def brute_leaks(doc, item):
    """The whole rule for one document and one item, over all pairs of windows."""
    d, i = brute_words(doc), brute_words(item)
    if not i:
        return False
    p, q = [w for w, _ in d], [w for w, _ in i]
    if len(i) < 5:
        return any(p[k : k + len(q)] == q for k in range(len(p) - len(q) + 1))
    grams = lambda ws: [tuple(ws[k : k + 5]) for k in range(len(ws) - 4)]
    tp, tq = grams([s or w for w, s in d]), grams([s or w for w, s in i])
    enough = lambda found, all_of: len(set(found)) >= 0.8 * len(set(all_of)) - 1e-9
    if enough(set(grams(p)) & set(grams(q)), grams(q)):
        return True
    worded = [sum(s is None for _, s in i[k : k + 5]) >= 2 for k in range(len(tq))]
    if 2 * sum(worded) < len(worded):
        return False
    hits = [(a, b) for a, x in enumerate(tp) for b, y in enumerate(tq) if x == y and worded[b]]
    if not enough([tq[b] for _, b in hits], [w for w, good in zip(tq, worded) if good]):
        return False
    slots = Counter(w for w, s in i if s)
    judged = False
    for shift in {None} | {a - b for a, b in hits}:
        mine = [(a, b) for a, b in hits if shift is None or a - b == shift]
        if shift is not None and not enough([tq[b] for _, b in mine], [w for w, good in zip(tq, worded) if good]):
            continue
        # a place counts once in each shift, so over all of them together once a shift
        seen = {(a - b, a + k, b + k) for a, b in mine for k in range(5) if i[b + k][1] and slots[q[b + k]] > 1}
        counts = defaultdict(Counter)
        for _, a, b in seen:
            counts[q[b]][p[a]] += 1
        judged = judged or bool(counts)
        if counts and sum(max(c.values()) for c in counts.values()) >= 0.8 * sum(sum(c.values()) for c in counts.values()):
            return True
    return not judged


#: Items whose template says nothing, and one with a name twice.
BARE = [
    (1, "The Rise And Fall Of The Roman Empire In Europe"), (2, "1 2 3 4 5 6 7 8"), (3, "If Tom has 3 apples and buys 4 more at the shop, how many apples does Tom have now?"),
    (4, "Paris London Berlin Madrid Rome Vienna Lisbon"), (5, "Anna met Paul and Rita saw Carl with Olga"),
]


def test_templates_need_words_and_consistent_names(spark, docs, prose):
    """Titles, tables of numbers and lists of names match word by word only; a name that becomes two names is another question."""
    pad = prose(20, 3)
    rows = [
        (1, f"{pad} Breaking News From New York City Today About The Local Football Team In Town"), (2, f"{pad} 9 8 7 6 5 4 3 2 1 14 15 16 17"), (3, f"{pad} If Ann has 7 apples and buys 9 more at the shop, how many apples does Bob have now?"),
        (4, f"{pad} Moscow Tokyo Oslo Athens Dublin Prague Warsaw Sofia"), (5, f"{pad} When Will The Long Road To The Far Country Of The North End"),
        (11, f"{pad} the rise and fall of the Roman empire in Europe"), (12, f"{pad} 0 1 2 3 4 5 6 7 8 9"), (13, f"{pad} If Ann has 7 apples and buys 9 more at the shop, how many apples does Ann have now?"), (14, BARE[3][1]), (15, BARE[4][1]),
    ]
    items = spark.createDataFrame(BARE, "item_id long, text string")
    got = {x.doc_id: list(x.item_ids) for x in D.mark(docs(rows), items).collect()}
    assert got == {1: [], 2: [], 3: [], 4: [], 5: [], 11: [1], 12: [2], 13: [3], 14: [4], 15: [5]}
    assert got == {i: [k for k, t in BARE if brute_leaks(d, t)] for i, d in rows}


def test_brute_force_with_slots(spark, docs, prose):
    """Random re-parameterised, cut, shuffled, upper- and lower-cased copies of items with slots, against the whole rule."""
    r = random.Random(21)
    names, pieces = ["Tom", "Mia", "Ravi", "Zoe", "Lee"], ["{n} has {x} marbles", "{n} gives {y} kg to {m}", "then {m} waits {x} minutes", "what is left after {y} days", "a {x} km walk home", "the old station"]
    make = lambda parts, v: ". ".join(s.format(**v) for s in parts)
    value = lambda: {"n": r.choice(names), "m": r.choice(names), "x": r.choice([3, 7, "seven", 12]), "y": r.randint(1, 99)}
    shapes = [r.sample(pieces, r.randint(2, 5)) for _ in range(12)]
    items = [(k, make(s, value())) for k, s in enumerate(shapes)] + [(50, "Who wrote Hamlet?"), (51, "Yes"), (52, ""), (53, None), (54, "...")]
    rows = []
    for k in range(90):
        shape = list(r.choice(shapes))
        if k % 5 == 0:
            r.shuffle(shape)
        text = make(shape, value()) if k % 3 else dict(items)[r.randrange(12)]
        if k % 7 == 0:
            text = " ".join(text.split()[2:])
        text = text.lower() if k % 11 == 0 else text.upper() if k % 13 == 0 else text
        rows.append((k, f"{prose(8, k)} {text}, {prose(8, k + 500)}" + (f" {make(shape, value())}" if k % 4 == 0 else "")))
    rows += [(100, prose(9, 1) + " who WROTE hamlet " + prose(9, 2)), (101, "say yes."), (102, None), (103, "")]
    got = {x.doc_id: list(x.item_ids) for x in D.mark(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {i: [k for k, t in items if brute_leaks(d, t)] for i, d in rows}
    assert got == want and sum(map(bool, want.values())) > 30 and not all(want.values())


def test_random_windows(spark, docs):
    """Without slots, contamination is the share of an item's distinct five-word windows."""
    r = random.Random(4)
    vocabulary = [a + b for a in "bdfgk" for b in ("ab", "el", "im", "or")]
    texts = [" ".join(r.choice(vocabulary) for _ in range(12)) for _ in range(8)]
    rows = []
    for i in range(60):
        item = texts[r.randrange(8)].split()
        cut = r.randint(0, 6)
        rows.append((i, " ".join([r.choice(vocabulary) for _ in range(5)] + item[cut:] + [r.choice(vocabulary) for _ in range(5)])))
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    grams = lambda t: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)}
    want = {i: [k for k, t in enumerate(texts) if len(grams(t) & grams(d)) >= 0.8 * len(grams(t))] for i, d in rows}
    assert {r.doc_id: list(r.item_ids) for r in D.mark(docs(rows), items).collect()} == want


def test_edges(spark, docs, awkward):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = D.mark(docs(awkward), items)
    assert got.count() == len(awkward) and got.where("n_items > 0").count() == 0 and set(docs([]).columns) < set(got.columns)
    assert D.mark(docs([]), items).count() == 0 and D.mark(docs(awkward), items.limit(0)).where("n_items > 0").count() == 0


def test_aligned_occurrences(spark, docs, prose):
    """Repeated windows in an item and a second instance in a document don't make a copy inconsistent."""
    item = "3 red apples and 4 green pears, then Mary buys 5 red apples and 6 green pears, then Mary buys 7 red apples and 8 green pears"
    swap = item.translate(str.maketrans("345678", "914526"))
    items = spark.createDataFrame([(1, item), (2, ITEMS[0][1])], "item_id long, text string")
    other = ITEMS[0][1].replace("120", "95").replace("3 ", "7 ").replace("20 ", "45 ").replace("Anna", "Berta")
    pad = prose(30, 2)
    rows = [item, f"{pad} {item} {pad}", f"{pad} {swap}", f"{ITEMS[0][1]} {pad} {other}", f"{other} {pad} {ITEMS[0][1]} {other}", pad]
    got = {r.doc_id: list(r.item_ids) for r in D.mark(docs(rows), items).collect()}
    assert got == {0: [1], 1: [1], 2: [1], 3: [2], 4: [2], 5: []}
