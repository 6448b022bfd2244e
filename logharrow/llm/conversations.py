"""Conversation structure repair: cheapest edits by a parallel Viterbi with rank convergence.

The roles of a repaired conversation read (s?(ua)+)? by their initials. Costs to go are vectors over the four states of that
grammar. Rows are ordered once by a range sort over all conversations, so that a long conversation spreads over many tasks,
and are cut into chunks there. A conversation that lies within one task is repaired where it is. The others go this way:

1. Each chunk computes its costs backward from a speculative end vector, that of a conversation's end.
2. Fix-up passes: a chunk whose follower starts with another vector runs again with that one, beside its old run, until the
   two differ only by a constant; what lies before then stays as it is. Passes are rerun until no chunk changes.
3. Each chunk traces the least audit from each of the four states; the exits, taken one after the other, give every chunk its
   entry state, and the chunks are traced and repaired side by side. Only the running hash of a conversation's text is taken
   chunk after chunk.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logharrow.llm.scratch import materialise

WHITE = " \t\n\x0b\x0c\r"
#: Costs of the edits; an undeleted truncated row adds one. Fixed values.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after s, after u, after a. Where an inserted or reroled row leads from each, and a kept one by its initial.
NEXT = (2, 2, 3, 2)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLES = {2: "user", 3: "assistant"}
#: Costs to go at a conversation's end.
END = (0, 2 * INSERT, INSERT, 0)
#: A chunk holds so many rows, or characters of text, at most (and one row more).
CHUNK_ROWS, CHUNK_CHARS = 1 << 16, 1 << 22


def code_of(required: bool, initial: str, truncated: bool) -> int:
    """A row as a byte: 0 must be deleted; else its initial's place in "sua", 3 for others, twice, and whether it is truncated."""
    return 0 if required else 1 + 2 * ("sua".find(initial) if initial and initial in "sua" else 3) + truncated


def _base(state: int, code: int, after: tuple[int, ...]) -> list[tuple[str, int, int]]:
    """Edits of a row in a state: letter, cost to go, next state."""
    out = [("D", DELETE + after[state], state)]
    if code:
        kind, cut = divmod(code - 1, 2)
        to = KEPT.get((state, "sua "[kind]))
        if to is not None:
            out.append(("K", TRUNCATED * cut + after[to], to))
        out.append(("R", REROLE + TRUNCATED * cut + after[NEXT[state]], NEXT[state]))
    return out


@lru_cache(1 << 16)
def step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int]:
    """Costs before a row from those after it, less their least, and that least."""
    v = [min(cost for _, cost, _ in _base(s, code, after)) for s in range(4)]
    v[2], v[3] = min(v[2], INSERT + v[3]), min(v[3], INSERT + v[2])
    v[0], v[1] = min(v[0], INSERT + v[2]), min(v[1], INSERT + v[2])
    least = min(v)
    return tuple(x - least for x in v), least


@lru_cache(1 << 16)
def move(state: int, code: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The ASCII-least cheapest edits from a state over one row, inserts before it included, and the state after it."""
    vector, least = step(after, code)
    letters = ""
    while True:
        options = [(letter, to) for letter, cost, to in _base(state, code, after) if cost == vector[state] + least]
        if INSERT + vector[NEXT[state]] == vector[state]:
            options.append(("I", NEXT[state]))
        letter, state = min(options)
        letters += letter
        if letter != "I":
            return letters, state


def backward(codes: bytes, end: tuple[int, ...]) -> tuple[tuple[int, ...], int, list[tuple[int, ...]]]:
    """Start vector, what was taken off in all, and the vector after each row."""
    vector, total, after = end, 0, [end] * len(codes)
    for i in range(len(codes) - 1, -1, -1):
        after[i] = vector
        vector, least = step(vector, codes[i])
        total += least
    return vector, total, after


def rerun(codes: bytes, old_end: tuple[int, ...], end: tuple[int, ...], old_start: tuple[int, ...], old_total: int) -> tuple[tuple[int, ...], int]:
    """Start vector and total from another end vector, run beside the old one until both differ by a constant only."""
    a, b, gain = old_end, end, 0
    for i in range(len(codes) - 1, -1, -1):
        if a == b:
            return old_start, old_total + gain
        (a, x), (b, y) = step(a, codes[i]), step(b, codes[i])
        gain += y - x
    return b, old_total + gain


def trace(codes: bytes, after: list[tuple[int, ...]], state: int) -> tuple[list[str], int]:
    """The edits at each row, inserts before it first, and the state at the end."""
    out = []
    for code, vector in zip(codes, after):
        letters, state = move(state, code, vector)
        out.append(letters)
    return out, state


def tail(state: int) -> str:
    """Inserts that close a conversation."""
    return {0: "", 1: "II", 2: "I", 3: ""}[state]


def repaired(letters: list[str], state: int, roles: list[str], texts: list[str], last: bool) -> tuple[list[tuple[str, str]], int]:
    """Rows of role and text after the edits, and the state."""
    out = []
    for k, edits in enumerate(letters):
        for e in edits:
            if e == "K":
                state = KEPT[state, roles[k][:1]]
                out.append((roles[k], texts[k]))
            elif e != "D":
                state = NEXT[state]
                out.append((ROLES[state], texts[k] if e == "R" else ""))
    if last:
        for _ in tail(state):
            state = NEXT[state]
            out.append((ROLES[state], ""))
    return out, state


class Piece:
    """Rows of one conversation that follow each other in a task, with their faults."""

    def __init__(self, conv, at: int):
        self.conv, self.at, self.codes, self.roles, self.texts, self.chars = conv, at, bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, first: bool) -> None:
        seen = text.rstrip(WHITE)
        blank, cut = not seen, seen[-1:] not in ".!?"
        duplicate, truncated = not blank and not first, not blank and first and cut
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        if self.roles:
            self.illegal += self.roles[-1][:1] + role[:1] not in ("su", "ua", "au")
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        self.codes.append(code_of(blank or duplicate, role[:1], truncated))
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.codes) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS


COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn"]
PIECE = "at long, whole boolean, blank long, duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, cost long, audit string, sha string, out array<struct<role: string, text: string>>, codes binary, roles array<string>, texts array<string>"


def _order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "head", "h1", "h2", "place")]


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", times_col: str | None = None, texts: bool = True) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, and with `texts` repaired.

    Rows are taken by turn (whole numbers; nulls first); rows of one turn by role, then text (its first 64 characters, then its
    hash). times_col says how often a row stands there, one after the other (null: once); a conversation whose rows all stand
    there no time has zeros, an empty audit and an empty text. Each row's first fault counts: blank (nothing but white space),
    duplicate (role and text stood earlier in the conversation), truncated (the last character that isn't white space is none
    of .!?). gaps is the number of turns missing between the least and the greatest, 0 without turns, at most 2^63 - 1. Null
    roles and texts are one space, and so faulty. Rows with a null conversation are one conversation. Equal rows each count.
    audit has the initials of the cheapest Keep, Rerole, Delete and Insert in order, of all cheapest the least in ASCII;
    repaired is an array of role and text, and its hash that of the lines role:text. With `texts` a conversation's rows are
    one cell; without, a task holds one chunk of a conversation. Further columns are ignored, whatever their names. An empty
    table gives an empty result.
    """
    times = F.coalesce(F.col(times_col), F.lit(1)).cast("int") if times_col else F.lit(1)
    rows = df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        times.alias("times"), F.monotonically_increasing_id().alias("place"),
    ).withColumns({"head": F.left("text", F.lit(64)), "h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("second"), "text")})
    # a mark goes right before the first row of its role and text: it has the same place in the order
    firsts = rows.where("times > 0").groupBy("conv", "role", "head", "h1", "h2").agg(F.min(F.struct("turn", "place")).alias("f"))
    marks = firsts.select("conv", "f.turn", "role", F.lit(None).cast("string").alias("text"), F.lit(-1).alias("times"), "f.place", "head", "h1", "h2")
    ordered = rows.unionByName(marks).repartitionByRange(*_order()).sortWithinPartitions(*_order(), F.col("times") >= 0)
    kind = df.schema[conv_col].dataType.simpleString()
    pieces = materialise(ordered.select("conv", "turn", "role", "text", "times", "h1", "h2").mapInArrow(_cutter(texts), f"conv {kind}, {PIECE}"), "conversation-pieces")
    names = ["conv", "gaps", *COUNTS[:4], "cost", "audit", "sha", "out"]
    gaps = _gaps(F.col("first_turn"), F.col("last_turn"), F.col("turns"))
    whole = pieces.where("whole").withColumn("gaps", gaps).select(*names)
    split = pieces.where("NOT whole")
    found = whole.unionByName(_split(split, kind, texts).withColumn("gaps", gaps).select(*names))
    found = found.select(F.col("conv").alias("conv_id"), "gaps", *COUNTS[:4], "cost", "audit", F.col("sha").alias("repaired_sha256"), F.col("out").alias("repaired"))
    return found if texts else found.drop("repaired")


def _gaps(first: Column, last: Column, turns: Column) -> Column:
    wide = last.cast("decimal(20,0)") - first.cast("decimal(20,0)") + 1 - turns
    return F.when(first.isNull(), 0).otherwise(F.least(wide, F.lit((1 << 63) - 1).cast("decimal(20,0)"))).cast("long")


def _arrow(conv_type):
    import pyarrow as pa

    long, text = pa.int64(), pa.string()
    pair = pa.list_(pa.struct([("role", text), ("text", text)]))
    return pa.schema([("conv", conv_type), ("at", long), ("whole", pa.bool_()), *[(c, long) for c in COUNTS], ("cost", long), ("audit", text), ("sha", text), ("out", pair), ("codes", pa.binary()), ("roles", pa.list_(text)), ("texts", pa.list_(text))])


def _digest(sha, lines: list[tuple[str, str]], begun: bool) -> bool:
    """Feed lines to a running hash; tells whether it has any."""
    if lines:
        sha.update((("\n" if begun else "") + "\n".join(f"{r}:{t}" for r, t in lines)).encode())
    return begun or bool(lines)


def _cutter(keep_texts: bool):
    """Ordered rows of a task as pieces of conversations; those that surely begin and end here are repaired at once."""

    def close(piece: Piece, whole: bool) -> dict:
        row = {"conv": piece.conv, "at": piece.at, "whole": whole} | {c: getattr(piece, c) for c in COUNTS}
        codes = bytes(piece.codes)
        if not whole:
            return row | {"codes": codes, "roles": piece.roles, "texts": piece.texts}
        start, total, after = backward(codes, END)
        letters, state = trace(codes, after, 0)
        lines, _ = repaired(letters, 0, piece.roles, piece.texts, True)
        sha = hashlib.sha256()
        _digest(sha, lines, False)
        return row | {"cost": total + start[0], "audit": "".join(letters) + tail(state), "sha": sha.hexdigest(), "out": [{"role": r, "text": t} for r, t in lines] if keep_texts else None}

    def cut(batches):
        import pyarrow as pa

        part, count, piece, inner, mark, schema = TaskContext.get().partitionId(), 0, None, False, None, None
        done, held = [], 0
        for batch in batches:
            schema = schema or _arrow(batch.schema.field("conv").type)
            columns = [batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "times", "h1", "h2")]
            for conv, turn, role, text, times, h1, h2 in zip(*columns):
                if piece is None or conv != piece.conv:
                    if piece is not None:
                        done.append(close(piece, inner))
                        held += len(piece.codes) + piece.chars
                    inner = piece is not None  # a task's first conversation may begin before it
                    piece, count, mark = Piece(conv, part << 33 | count), count + 1, None
                if times < 0:
                    mark = (turn, role, h1, h2)
                    continue
                first = mark == (turn, role, h1, h2)
                for _ in range(times):
                    piece.add(turn, role, text, first)
                    first, mark = False, None
                if piece.full():
                    done.append(close(piece, False))
                    held += len(piece.codes) + piece.chars
                    inner = False
                    piece, count = Piece(conv, part << 33 | count), count + 1
                if held > CHUNK_CHARS or len(done) > 5_000:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done, held = [], 0
        if piece is not None:
            yield pa.RecordBatch.from_pylist([*done, close(piece, False)], schema)

    return cut


def _split(split: DataFrame, kind: str, texts: bool) -> DataFrame:
    """Conversations of several pieces, or at the edges of tasks."""
    by = Window.partitionBy("conv").orderBy("at")
    vector = lambda v: F.array(*[F.lit(x).cast("long") for x in v])

    def run(batches):
        """Backward costs of chunks: from the wanted end vector, beside the old run if there is one."""
        import pyarrow as pa

        for b in batches:
            rows = []
            for r in b.to_pylist():
                want = tuple(r["want"])
                if r["end"] is None:
                    start, total, _ = backward(r["codes"], want)
                else:
                    start, total = rerun(r["codes"], tuple(r["end"]), want, tuple(r["start"]), r["total"])
                rows.append({"conv": r["conv"], "at": r["at"], "end": list(want), "start": list(start), "total": total})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("conv", b.schema.field("conv").type), ("at", pa.int64()), ("end", pa.list_(pa.int64())), ("start", pa.list_(pa.int64())), ("total", pa.int64())]))

    costs = f"conv {kind}, at long, end array<long>, start array<long>, total long"
    none = F.lit(None).cast("array<long>")
    fresh = split.select("conv", "at", "codes", vector(END).alias("want"), none.alias("end"), none.alias("start"), F.lit(None).cast("long").alias("total"))
    known = materialise(fresh.mapInArrow(run, costs), "chunk-costs")
    while True:
        wanted = known.withColumn("want", F.coalesce(F.lead("start").over(by), vector(END)))
        stale = materialise(wanted.where(F.col("want") != F.col("end")), "stale-chunks")
        if stale.isEmpty():
            break
        again = stale.join(split.select("at", "codes"), "at").mapInArrow(run, costs)
        known = materialise(known.join(stale.select("at"), "at", "left_anti").unionByName(again), "chunk-costs")

    def exits(batches):
        """Where a chunk leads to from each state."""
        import pyarrow as pa

        for b in batches:
            rows = []
            for r in b.to_pylist():
                _, _, after = backward(r["codes"], tuple(r["end"]))
                rows.append({"conv": r["conv"], "at": r["at"], "exits": [trace(r["codes"], after, s)[1] for s in range(4)]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("conv", b.schema.field("conv").type), ("at", pa.int64()), ("exits", pa.list_(pa.int32()))]))

    def entries(batches):
        import pyarrow as pa

        conv, state, begun = None, 0, False
        for b in batches:
            states = []
            for c, e in zip(b.column("conv").to_pylist(), b.column("exits").to_pylist()):
                if not begun or c != conv:
                    conv, state, begun = c, 0, True
                states.append(state)
                state = e[state]
            yield pa.RecordBatch.from_arrays([b.column("at"), pa.array(states, pa.int32())], ["at", "entry"])

    leads = split.select("conv", "at", "codes").join(known.select("at", "end"), "at").select("conv", "at", "codes", "end").mapInArrow(exits, f"conv {kind}, at long, exits array<int>")
    entry = leads.repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(entries, "at long, entry int")
    last = F.lead("at").over(by).isNull().alias("last")
    placed = known.select("at", "end", "start", "total", last).join(materialise(entry, "chunk-entries"), "at")
    chunks = split.select("conv", "at", *COUNTS, "codes", "roles", "texts").join(placed, "at")

    def mend(batches):
        """Each chunk's audit and repaired rows."""
        import pyarrow as pa

        text, long = pa.string(), pa.int64()
        for b in batches:
            kept = b.select(["conv", "at", *COUNTS, "total", "last"])
            columns = [b.column(c).to_pylist() for c in ("codes", "end", "entry", "last", "start", "roles", "texts")]
            audits, ends, firsts, lines = [], [], [], []
            for codes, end, state, is_last, start, roles, said in zip(*columns):
                _, _, after = backward(codes, tuple(end))
                letters, left = trace(codes, after, state)
                audits.append("".join(letters) + (tail(left) if is_last else ""))
                got, _ = repaired(letters, state, roles, said, is_last)
                lines.append([{"role": r, "text": t} for r, t in got])
                firsts.append(start[0])
                ends.append((roles[0][:1], roles[-1][:1]) if roles else (None, None))
            more = [pa.array(audits, text), pa.array(firsts, long), pa.array([e[0] for e in ends], text), pa.array([e[1] for e in ends], text), pa.array(lines, pa.list_(pa.struct([("role", text), ("text", text)])))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *more], [*kept.schema.names, "audit", "ahead", "i0", "i1", "lines"])

    counts = ", ".join(f"{c} long" for c in COUNTS)
    order = ["conv", "at", *COUNTS, "total", "last", "audit", "ahead", "i0", "i1", "lines"]
    mended = chunks.select("conv", "at", *COUNTS, "total", "last", "codes", "end", "entry", "start", "roles", "texts").mapInArrow(mend, f"conv {kind}, at long, {counts}, total long, last boolean, audit string, ahead long, i0 string, i1 string, lines array<struct<role: string, text: string>>")

    def join(batches):
        """Chunks of a conversation, one after the other: sums, the faults at their edges, the audit and the running hash."""
        import pyarrow as pa

        row = sha = begun = initial = audits = out = schema = None
        for b in batches:
            schema = schema or _arrow(b.schema.field("conv").type)
            done = []
            for r in b.to_pylist():
                if row is None:
                    row, sha, begun, initial, audits, out = {c: 0 for c in [*COUNTS[:5], "cost"]} | {"conv": r["conv"], "at": r["at"], "whole": True, "first_turn": None, "last_turn": None, "cost": r["ahead"]}, hashlib.sha256(), False, None, [], []
                for c in COUNTS[:5]:
                    row[c] += r[c]
                row["cost"] += r["total"]
                if r["first_turn"] is not None:
                    row["turns"] -= row["last_turn"] == r["first_turn"]
                    row["first_turn"] = r["first_turn"] if row["first_turn"] is None else row["first_turn"]
                    row["last_turn"] = r["last_turn"]
                if r["i0"] is not None:
                    row["illegal"] += initial is not None and initial + r["i0"] not in ("su", "ua", "au")
                    initial = r["i1"]
                lines = [(x["role"], x["text"]) for x in r["lines"]]
                begun = _digest(sha, lines, begun)
                audits.append(r["audit"])
                out += r["lines"] if texts else []
                if r["last"]:
                    done.append(row | {"audit": "".join(audits), "sha": sha.hexdigest(), "out": out if texts else None})
                    row = None
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)

    joined = mended.select(*order).repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(join, f"conv {kind}, {PIECE}")
    return joined.drop("codes", "roles", "texts")
