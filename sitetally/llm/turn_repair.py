"""Repair of conversations: the cheapest edits after which a conversation is an optional system turn, then user and assistant
in turns, found by a Viterbi search that is run in chunks.

Each row of a conversation is kept (0), given another role (2) or deleted (3); empty user and assistant turns may be inserted
anywhere (2). Blank rows and rows that repeat an earlier role and text must go; a truncated row that stays costs 1 more. Among
the cheapest ways the one whose edits' initials (D, I, K, R) are least in ASCII order is taken.

*Search.* Rows without their texts are put into global order by ranges and cut into chunks. Every chunk runs backward from a
speculative vector of costs, one for each role that may stand before a row, as if the conversation ended there. A fix-up pass
gives each chunk the vector that the next one found; the chunk runs again only if that differs from the one it used by more
than a constant. When none does, the constants are added up over the chunks (the stitched costs), one pass over the chunks
tells where each is entered, and every chunk traces its own part. Only then the texts move, once, to be hashed in order.

Order within a conversation: turn (NULL first), role, digest of the text; equal rows are handled as one row with a count.
NULL role or text: read as one space. NULL conversation: one conversation of its own. Roles are told by their first letter. An
empty table gives no rows. Extra columns are not read, so their names do not matter. The text hash of one conversation is
sequential by definition: its rows pass through one task, which keeps none of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, saved

CHUNK = 4096
#: Chunks that a task holds at once.
AT_ONCE = 16
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What stands before a row: nothing, the system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Role that an inserted or rewritten row has, and where it leads.
FOLLOWS = (USER, USER, ASSISTANT, USER)
KEEPS = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
#: Costs to come at the end of a conversation.
END = (0, 2 * INSERT, INSERT, 0)
NOT_SPACE = r"[^\x20\x09-\x0D]"


def before(initial: str, truncated: bool, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs to come before a row, for each state, from those after it."""
    extra = TRUNCATED if truncated else 0
    base = []
    for state in range(4):
        cost = min(DELETE + after[state], REROLE + extra + after[FOLLOWS[state]])
        if (to := KEEPS.get((initial, state))) is not None:
            cost = min(cost, extra + after[to])
        base.append(cost)
    user, assistant = min(base[USER], INSERT + base[ASSISTANT]), min(base[ASSISTANT], INSERT + base[USER])
    return min(base[START], INSERT + user), min(base[SYSTEM], INSERT + user), user, assistant


def run_back(rows: list[tuple], vector: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs before each row of a chunk and, last, the given ones after it. Rows: (initial, must go, truncated, copies)."""
    costs = [vector]
    for initial, must_go, truncated, copies in reversed(rows):
        gone = DELETE * (copies if must_go else copies - 1)
        after = tuple(c + gone for c in costs[-1]) if gone else costs[-1]
        costs.append(after if must_go else before(initial, truncated, after))
    costs.reverse()
    return costs


def trace(rows: list[tuple], costs: list[tuple[int, ...]], state: int) -> Iterator[tuple[str, str, int]]:
    """Per row: the inserted turns before it as letters, its edit, and the state after it."""
    for i, (initial, must_go, truncated, copies) in enumerate(rows):
        if must_go:
            yield "", "D", state
            continue
        gone, extra, inserted = DELETE * (copies - 1), TRUNCATED if truncated else 0, ""
        now, after = costs[i], costs[i + 1]
        while True:
            left = now[state] - gone
            keep = KEEPS.get((initial, state))
            if left == DELETE + after[state]:
                edit = "D"
            elif now[state] == INSERT + now[FOLLOWS[state]]:
                state = FOLLOWS[state]
                inserted += NAMES[state][0]
                continue
            elif keep is not None and left == extra + after[keep]:
                edit, state = "K", keep
            else:
                edit, state = "R", FOLLOWS[state]
            break
        yield inserted, edit, state


def prepared(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``c, t, r, x``, digest ``h`` of the text, whether it is blank and whether it ends without a full stop."""
    rows = turns.select(F.col(conv).alias("c"), F.col(turn).cast("long").alias("t"), F.coalesce(F.col(role), F.lit(" ")).alias("r"),
                        F.coalesce(F.col(text), F.lit(" ")).alias("x"))
    return rows.select("*", F.unhex(F.md5("x")).alias("h"), (~F.col("x").rlike(NOT_SPACE)).alias("blank"),
                       (~F.col("x").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))


def _same(left: str, right: str, names: Iterable[str]) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return test


def judged(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number ``n``; ``again``: an earlier turn has its role and text."""
    one = rows.groupBy("c", "t", "r", "h").agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    first = one.groupBy("c", "r", "h").agg(F.count("*").alias("rows"), F.max(F.col("t").isNull()).alias("some_null"), F.min("t").alias("first_t"))
    first = first.where("rows > 1").drop("rows")
    later = F.col("t").isNotNull() & (F.col("some_null") | (F.col("t") > F.col("first_t")))
    return one.alias("o").join(first.alias("f"), _same("o", "f", ("c", "r", "h")), "left").select(
        "o.*", F.coalesce(later, F.lit(False)).alias("again"))


KEYS = ("c", "t", "r", "h", "n", "blank", "again", "cut")


def in_order() -> list[Column]:
    return [F.col("c").asc_nulls_first(), F.col("t").asc_nulls_first(), F.col("r").asc(), F.col("h").asc()]


def chunks(rows: DataFrame, size: int) -> DataFrame:
    """Chunks of rows of a conversation in order: ``c``, place (``part``, ``k``), and the rows."""
    data = rows.select(*KEYS).repartitionByRange(*in_order()).sortWithinPartitions(*in_order())
    kind = data.schema["c"].dataType.simpleString()

    def make():
        part, held, counter = TaskContext.get().partitionId(), [], [0]

        def flush():
            counter[0] += 1
            out = (held[0][0], part, counter[0], [dict(zip(KEYS[1:], r[1:], strict=True)) for r in held])
            held.clear()
            return out

        def each(c, t, r, h, n, blank, again, cut):
            c = c.decode() if isinstance(c, bytes) else c
            out = [flush()] if held and (held[0][0] != c or len(held) >= size) else []
            held.append((c, t, r.decode(), h, n, blank, again, cut))
            return out

        each.close = lambda: [flush()] if held else []
        return each

    return saved(map_rows(data, make, f"c {kind}, part int, k int, rows array<struct<t: long, r: string, h: binary, n: long, "
                                      "blank: boolean, again: boolean, cut: boolean>>", AT_ONCE), "turns")


def symbols(rows: list[dict]) -> list[tuple]:
    return [(r["r"][:1], r["blank"] or r["again"], r["cut"], r["n"]) for r in rows]


def _run(data: DataFrame) -> DataFrame:
    """Runs chunks (``c, part, k, rows``) backward from the vectors ``used``."""
    kind = data.schema["c"].dataType.simpleString()

    def make():
        def each(c, part, k, rows, used):
            yield c.decode() if isinstance(c, bytes) else c, part, k, used, list(run_back(symbols(rows), tuple(used))[0])
        return each
    return map_rows(data.select("c", "part", "k", "rows", "used"), make, f"c {kind}, part int, k int, used array<long>, found array<long>", AT_ONCE)


def settled(parts: DataFrame) -> DataFrame:
    """``c, part, k, o, used, found, exact``: every chunk's vector after it, right but for a constant, the costs found before
    it, and the stitched constant to be added to both."""
    end = F.array(*[F.lit(x).cast("long") for x in END])
    by = Window.partitionBy("c").orderBy("part", "k")
    runs = saved(_run(parts.withColumn("used", end)), "costs")
    places = runs.select("c", "part", "k", F.row_number().over(by).alias("o"), F.lead("part").over(by).isNull().alias("last"))
    places = saved(places, "places")
    while True:
        state = runs.alias("s").join(places.alias("p"), _same("s", "p", ("c", "part", "k"))).select("s.*", "p.o", "p.last")
        state = state.withColumn("after", F.coalesce(F.lead("found").over(Window.partitionBy("c").orderBy("o")), end))
        state = saved(state, "fix-up")
        moved = F.lit(False)
        for i in range(1, 4):
            moved = moved | (F.col("after")[i] - F.col("after")[0] != F.col("used")[i] - F.col("used")[0])
        wrong = state.where(moved)
        if wrong.isEmpty():
            break
        again = parts.alias("a").join(wrong.alias("w"), _same("a", "w", ("c", "part", "k"))).select("a.*", F.col("w.after").alias("used"))
        runs = saved(_run(again).unionByName(state.where(~moved).select("c", "part", "k", "used", "found")), "costs")
    step = F.col("after")[0] - F.col("used")[0]
    return state.withColumn("exact", F.sum(step).over(Window.partitionBy("c").orderBy(F.desc("o"))))


def entered(parts: DataFrame, state: DataFrame) -> DataFrame:
    """``c, part, k``, the state in which each chunk is ``entered``; one pass over the chunks of a conversation in order."""
    kind = parts.schema["c"].dataType.simpleString()
    single = state.where("o = 1 and last").select("c", "part", "k", F.lit(START).alias("entry"))
    several = parts.alias("a").join(state.where("not (o = 1 and last)").alias("s"), _same("a", "s", ("c", "part", "k"))).select(
        "a.c", "a.part", "a.k", "s.o", "a.rows", "s.used")

    def make_exits():
        def each(c, part, k, o, rows, used):
            kinds = symbols(rows)
            costs = run_back(kinds, tuple(used))
            exits = []
            for entry in range(4):
                out = entry
                for _, _, out in trace(kinds, costs, entry):
                    pass
                exits.append(out)
            yield c.decode() if isinstance(c, bytes) else c, part, k, o, exits
        return each

    def make_chain():
        now = [None, START]

        def each(c, part, k, o, exits):
            entry = START if o == 1 else now[1]
            now[1] = exits[entry]
            yield c.decode() if isinstance(c, bytes) else c, part, k, entry
        return each

    exits = map_rows(several, make_exits, f"c {kind}, part int, k int, o int, exits array<int>", AT_ONCE)
    chain = map_rows(exits.repartition("c").sortWithinPartitions("c", "o"), make_chain, f"c {kind}, part int, k int, entry int")
    return single.unionByName(chain)


def decided(parts: DataFrame, state: DataFrame, entry: DataFrame) -> DataFrame:
    """One row per distinct row of a conversation with its edit, and a last one with the turns inserted at the end and the cost."""
    kind = parts.schema["c"].dataType.simpleString()
    total = F.col("s.exact") + F.col("s.found")[0]
    data = parts.alias("a").join(state.alias("s"), _same("a", "s", ("c", "part", "k"))).join(
        entry.alias("e"), _same("a", "e", ("c", "part", "k"))).select(
        "a.c", "a.rows", "s.used", "s.last", "e.entry", F.when(F.col("s.o") == 1, total).alias("cost"))

    def make():
        def each(c, rows, used, last, state, cost):
            c = c.decode() if isinstance(c, bytes) else c
            kinds = symbols(rows)
            for r, (inserted, edit, state) in zip(rows, trace(kinds, run_back(kinds, tuple(used)), state), strict=True):
                fault = "b" if r["blank"] else "d" if r["again"] else "t" if r["cut"] else ""
                yield c, False, r["t"], r["r"], r["h"], 0, inserted, edit + (NAMES[state] if edit == "R" else ""), fault, r["n"], cost
                cost = None
            if last:
                inserted = ""
                while state not in (START, ASSISTANT):
                    state = FOLLOWS[state]
                    inserted += NAMES[state][0]
                yield c, True, None, "", b"", 0, inserted, "", "", 0, None
        return each

    return map_rows(data, make, f"c {kind}, tail boolean, t long, r string, h binary, step int, inserted string, edit string, "
                                "fault string, n long, cost long", AT_ONCE)


class Repair:
    """Figures, audit and text hash of the conversation whose rows are passing by."""

    def __init__(self, conv):
        self.conv, self.hash, self.audit, self.lines = conv, sha256(), [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = 0
        self.least = self.greatest = self.initial = self.role = None

    def line(self, role: str, text: bytes) -> None:
        self.hash.update((b"\n" if self.lines else b"") + role.encode() + b":")
        self.hash.update(text)
        self.lines += 1

    def row(self, tail, turn, role, inserted, edit, fault, copies, cost) -> None:
        for letter in inserted:
            self.line("user" if letter == "u" else "assistant", b"")
        self.audit.append("I" * len(inserted) + edit[:1] + "D" * (copies - 1))
        self.cost += cost or 0
        self.role = None if edit in ("", "D") else edit[1:] or role
        if tail:
            return
        self.blank += copies if fault == "b" else 0
        self.duplicate += 0 if fault == "b" else copies if fault == "d" else copies - 1
        self.truncated += fault == "t"
        self.illegal += copies - 1 + (self.initial is not None and self.initial + role[:1] not in LEGAL)
        self.initial = role[:1]
        if turn is not None:
            if turn != self.greatest:
                self.turns += 1
            self.least, self.greatest = turn if self.least is None else self.least, turn

    def text(self, text: bytes) -> None:
        """Text of the row just decided; only its first copy counts."""
        if self.role is not None:
            self.line(self.role, text)
            self.role = None

    def result(self) -> tuple:
        gaps = 0 if self.least is None else self.greatest - self.least + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             size: int = CHUNK) -> DataFrame:
    """Per conversation: ``conv``, ``gaps`` in its turns, rows ``blank``, ``duplicate`` and ``truncated`` (the first that
    holds), ``illegal`` neighbours, ``cost`` and ``audit`` of the repair, and the digest of the repaired conversation."""
    rows = prepared(turns, conv, turn, role, text)
    parts = chunks(judged(rows), size)
    state = saved(settled(parts), "settled")
    plan = decided(parts, state, entered(parts, state))
    names = ("inserted", "edit", "fault", "n", "cost")
    texts = rows.where(~F.col("blank")).select(
        "c", F.lit(False).alias("tail"), "t", "r", "h", F.lit(1).alias("step"), *(F.lit(None).cast(plan.schema[x].dataType).alias(x) for x in names), "x")
    both = plan.withColumn("x", F.lit(None).cast("string")).unionByName(texts)
    both = both.repartition("c").sortWithinPartitions(
        F.col("c").asc_nulls_first(), "tail", F.col("t").asc_nulls_first(), "r", "h", "step")
    kind = rows.schema["c"].dataType.simpleString()

    def make():
        now: list[Repair] = []

        def each(c, tail, t, r, h, step, inserted, edit, fault, n, cost, x):
            c, out = c.decode() if isinstance(c, bytes) else c, []
            if not now or now[0].conv != c:
                out = each.close()
                now.append(Repair(c))
            if step:
                now[0].text(x)
            else:
                now[0].row(tail, t, r.decode(), inserted.decode(), edit.decode(), fault.decode(), n, cost)
            return out

        each.close = lambda: [now.pop().result()] if now else []
        return each

    return map_rows(both, make, f"c {kind}, {RESULT}").withColumnRenamed("c", conv)
