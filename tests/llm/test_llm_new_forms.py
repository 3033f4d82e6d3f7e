"""Turn repair against a search over whole edit scripts, fill-in-middle against slices, fingerprints of copies and edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from sitetally.llm import fill_middle, imatch, queries, turn_repair

STEPS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}


def repair(rows):
    """Figures, cost, audit and digest of one conversation: rows (turn, role, text) in order."""
    seen, kinds = set(), []
    for _, role, text in rows:
        body = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            break
        if (i, last) in done:
            continue
        done.add((i, last))

        def put(extra, letter, j, role, text):
            if (last, role[:1]) in STEPS:
                heapq.heappush(heap, (cost + extra, audit + letter, j, role[:1], (*out, f"{role}:{text}")))

        for name in ("user", "assistant"):
            put(2, "I", i, name, "")
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
            if kinds[i] not in ("blank", "duplicate"):
                cut = int(kinds[i] == "truncated")
                put(cut, "K", i + 1, role, text)
                for name in ("user", "assistant"):
                    if name != role:
                        put(2 + cut, "R", i + 1, name, text)
    turns = [t for t, _, _ in rows if t is not None]
    first = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def ordered(rows):
    """Conversations with their rows in the operator's order; NULL role or text is a space."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for all_rows in out.values():
        all_rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    return out


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        dice = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if dice == 1 else re.sub("[.!?]", "", text) if dice == 2 else text
        for _ in range(0 if dice == 0 else 2 if dice == 3 else 1):
            yield conv, turn, "user" if dice == 4 else role, text


def test_repair_of_the_test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {r[0]: repair([]) for r in rows} | {c: repair(x) for c, x in ordered(damaged(rows)).items()}
    found = queries.QUERIES["op12_turn_repair"](spark, SF_DIR).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == want and len(found) == len(want)


CASES = [
    (None, None, None, None), (None, 2, "user", "lost id."), (None, 2, "user", "lost id."), (0, None, "user", "no turn"), (0, 5, "tool", "x."),
    (0, 5, "tool", "x."), (0, 9, "", "no role."), (1, 1, "assistant", ""), (1, 2, "system", "late."), (2, 1, "user", "long " * 50_000 + "."),
    (2, 1, "assistant", "same turn."), (3, -7, "user", "é😀!"), (3, 7, "assistant", "é😀!  \n\t"), (4, 1, "system", "only."), (5, 1, "user", "\x0b\x0c\r"),
]


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_repair_in_chunks(spark, size):
    """Long runs of one role keep the vectors of chunks apart for many passes; equal rows count as often as they occur."""
    dice = random.Random(5)
    rows = list(CASES)
    for conv in range(10, 40):
        roles = dice.choice(["ua", "u", "uaas", "a", "sua", "uuat"])
        for turn in range(dice.choice([2, 7, 40])):
            text = dice.choice(["yes.", "no", "", f"text {turn}.", f"cut {turn}", f"text {turn}."])
            rows += [(conv, turn if dice.random() < 0.95 else None, {"u": "user", "a": "assistant", "s": "system", "t": "tool"}[dice.choice(roles)], text)
                     ] * dice.choice([1, 1, 1, 2])
    rows += [(50, t, "user", f"all by one {t}.") for t in range(61)] + [(51, t, "user", "") for t in range(61)]
    want = {c: repair(x) for c, x in ordered(rows).items()}
    data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain = data.select(F.lit("x").alias("c"), F.lit(1).alias("h"), "*", F.lit(2).alias("rows"), F.lit(3).alias("cost"))  # clashing names
    found = turn_repair.repaired(plain, size=size).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == want and len(found) == len(want)


def test_repair_of_nothing(spark):
    assert turn_repair.repaired(spark.createDataFrame([], "conv_id string, turn long, role string, text string")).collect() == []


def test_chunks_settle_by_constants():
    """Vectors from a speculative start become those of the true one, up to a constant, within few legal rows."""
    rows = [("u" if i % 2 == 0 else "a", False, i % 3 == 0, 1) for i in range(40)]
    true = turn_repair.run_back(rows, turn_repair.END)
    guess = turn_repair.run_back(rows[:20], turn_repair.END)
    assert [x - true[0][0] for x in true[0]] == [x - guess[0][0] for x in guess[0]] and true[0] != guess[0]


TEXTS = ["a\nb\nc", None, "", "x<P>y", "\n\n\n", "é😀\n$1 \\ <\n<S\nM>z", "l\n" * 30_000 + "end", "q" * 300_000, "one\n", "one\n", "a<S", ">b\n<", "\r\n\x0b"]


def test_fill_middle(spark):
    rows = [(i % 40 if i else None, TEXTS[i % len(TEXTS)]) for i in range(130)]
    data = spark.createDataFrame([(*r, "x", 9) for r in rows], "doc_id long, text string, form string, n int")
    out = fill_middle.transformed(data).withColumn("again", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(rows) and {r.form for r in out} == {"plain", "psm", "spm"}
    for r in out:
        text = r.text
        digest = hashlib.sha256(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        a, b = sorted(x % (len(units) + 1) for x in h[:2])
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        plain = not text or any(m in text for m in ("<P>", "<S>", "<M>"))
        form = "plain" if plain else "spm" if h[3] % 100 < 50 else "psm"
        whole = {"plain": text, "psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[form]
        assert (r.n, r.form, r.output, r.again) == (len(units), form, whole, text)
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if plain else (len(prefix), len(middle)))


def test_fill_middle_shares_and_nothing(spark):
    data = spark.range(400).selectExpr("id AS doc_id", "concat('a\\nb\\n', id) AS text")
    forms = {r.form: r["count"] for r in fill_middle.transformed(data, changed_percent=50, spm_percent=0).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm"} and 150 < forms["psm"] < 250
    assert fill_middle.transformed(data.limit(0)).collect() == []


def words(seed: int, n: int) -> str:
    dice = random.Random(seed)
    return " ".join(f"w{dice.randrange(9000)}" for _ in range(n))


def likeness(a: str, b: str) -> float:
    """From the fingerprints alone, as a reader of the table would."""
    def weight(entries):
        return sum(1 / int(e.split(":")[1]) for e in entries)
    a, b = set(a.split(" ")), set(b.split(" "))
    return round(2 * weight(a & b) / (weight(a) + weight(b)), 6)


def test_fingerprints(spark):
    """Copies agree wholly, near copies mostly, unrelated texts hardly; every case has a result, repeated rows and NULLs too."""
    body = words(1, 400)
    rows = [(i, words(100 + i, 200)) for i in range(300)]
    rows += [(1000, body), (1001, body), (1002, body.split(" ", 9)[9]), (1003, None), (1004, ""), (1005, "!! ??"), (1006, " \n"),
             (1007, "é" * 70_000), (1008, "Zwei"), (1009, "zwei."), (1009, "zwei."), (None, body), (None, None), (None, words(3, 50))]
    data = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, bucket int, tie string")
    out = imatch.fingerprints(data, imatch.lexicon(data)).collect()
    assert len(out) == len(rows)
    falling = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()))
    following = {(r[0], r[1] or ""): falling[(i + 1) % len(falling)][1] or "" for i, r in enumerate(falling) if r != (1009, "zwei.")}
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    for (doc, text), after in following.items():
        half = len(text) // 2
        digest = hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()
        assert any(r.edited_sha256 == digest and r.n_chars == len(text) for r in by[doc])
    one = {d: r[0] for d, r in by.items() if len(r) == 1}
    assert abs(one[1002].near_next - likeness(one[1002].fingerprint, one[1001].fingerprint)) < 2e-6
    assert one[1000].fingerprint == one[1001].fingerprint and one[1001].near_next == 1
    assert 0.3 < one[1002].near_next < 1 and one[1003].fingerprint == one[1004].fingerprint != one[1005].fingerprint
    assert one[1008].fingerprint == by[1009][0].fingerprint and len(by[1009]) == 2
    plain = [one[i] for i in range(1, 300)]
    assert sum(r.near_edited > r.near_next for r in plain) > 0.95 * len(plain)
    assert sum(r.near_next for r in plain) < 0.05 * len(plain) < 0.1 * len(plain) < sum(r.near_edited for r in plain)


def test_fingerprints_in_many_buckets(spark):
    """One id, and NULL, with a third of the rows each are split; the order is the same as in one bucket."""
    rows = [(7, f"seven {i} {words(i, 8)}") for i in range(300)] + [(None, f"none {i} {words(i, 8)}") for i in range(300)]
    rows += [(i * 3, words(5000 + i, 8)) for i in range(300)]
    data = spark.createDataFrame(rows, "id long, text string")
    placed = imatch.in_order(data).collect()
    own = sorted((r for r in placed if not r.guest), key=lambda r: (r.bucket, r.pos))
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    assert [(r.id, r.text) for r in own] == want
    assert [r.next for r in own] == [r[1] for r in want[1:] + want[:1]]
    sizes = defaultdict(int)
    for r in own:
        sizes[r.bucket] += 1
    assert len(sizes) > 20 and max(sizes.values()) < 120


def test_fingerprints_of_nothing(spark):
    data = spark.createDataFrame([], "doc_id long, text string")
    assert imatch.fingerprints(data, imatch.lexicon(data)).collect() == []


def test_fingerprints_are_native_and_move_texts_once(spark):
    df = queries.QUERIES["op11_imatch"](spark, SF_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "Arrow" not in plan and "Python" not in plan
    assert sum("Exchange hashpartitioning" in x for x in final.splitlines()) == 1


def test_a_lexicon_too_large_to_broadcast_is_joined(spark, monkeypatch):
    data = spark.createDataFrame([(i, words(i, 30)) for i in range(150)], "doc_id long, text string")
    lexicon = imatch.lexicon(data)
    want = sorted(map(tuple, imatch.fingerprints(data, lexicon).collect()))
    monkeypatch.setattr(imatch, "MOST_BROADCAST", 0)
    got = sorted(map(tuple, imatch.fingerprints(data, lexicon).collect()))
    assert got == want


def test_quotes_in_unquoted_values_lose_no_text():
    from sitetally.llm.html_tree import attributes, parsed
    page = "<article><p class=it's>One two. </p><p>Second. </p><p>Don't stop.</p><a href=/it's>One</a> mid <a href=\"/book\">x</a></article>"
    assert " ".join(t for _, t in parsed(page)[1]) == "One two. Second. Don't stop. One mid x"
    assert attributes(" class=it's id='a\"b'data-x=\"c'd\" class=no checked x==y z=a/b/ e=") == {
        "class": "it's", "id": 'a"b', "data-x": "c'd", "checked": "", "x": "y", "z": "a/b/", "e": ""}


def test_step_groups_are_full_over_all_tasks(spark):
    """However many tasks pack, each size has one group at most that is not full."""
    from sitetally.llm import packing
    docs = spark.range(900).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), cast(1 + id % 97 AS int)) AS text").repartition(24)
    rows = packing.packed(docs, queries.vocabulary("byte_bpe_50k.json"), step_tokens=8192).collect()
    tokens, sizes = defaultdict(int), defaultdict(set)
    for r in rows:
        tokens[r.step_group] += r.length
        sizes[r.step_group].add(r.tier)
    assert all(len(s) == 1 for s in sizes.values()) and len({r.sequence_id >> 40 for r in rows}) > 8
    for size in {s for own in sizes.values() for s in own}:
        groups = [tokens[g] for g in sorted(tokens) if sizes[g] == {size}]
        assert groups[:-1] == [8192] * (len(groups) - 1) and groups[-1] <= 8192


def test_words_that_tie_are_clustered_up_to_the_bound(spark):
    from sitetally.llm import brown
    words_ = spark.range(4000).selectExpr("concat('w', id) AS word", "cast(1 AS long) AS n")
    some = words_.unionByName(spark.createDataFrame([("often", 9), ("", 50)], "word string, n long"))
    for data in (words_, some):
        items = brown.chosen_items(data)
        assert len(items.words) == brown.ITEMS and (data is words_ or b"often" in items.words)
    assert len(brown._frequent(words_.limit(7), 100).collect()) == 7
