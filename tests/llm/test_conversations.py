"""Repair of roles, and reply trees."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evalloom.llm import chat, ordering, repair

GOOD = re.compile(r"(s?(ua)+)?")
TURNS = "conv_id long, turn long, role string, text string, at long, tree string, position long, cell string, `first` int"


def brute_repair(rows):
    """(initial, fault) rows -> the least (cost, audit), from all ways with at most two insertions in a place."""
    best = None

    def walk(i, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for extra in ("", "u", "a", "ua", "au"):
            so_far, paid, done = out + extra, cost + 5 * len(extra), audit + "I" * len(extra)
            if i == len(rows):
                if GOOD.fullmatch(so_far) and (best is None or (paid, done) < best):
                    best = paid, done
                continue
            initial, fault = rows[i]
            walk(i + 1, paid + 2, done + "D", so_far)
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if initial in ("s", "u", "a"):
                    walk(i + 1, paid + more, done + "K", so_far + initial)
                for role in "ua":
                    walk(i + 1, paid + more + 1, done + "R", so_far + role)

    walk(0, 0, "", "")
    return best


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "", "blank", "duplicate", "truncated"])), min_size=1, max_size=4))
def test_cells_are_the_cheapest(rows):
    assert repair.cheapest(repair.parse(rows)) == brute_repair(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("sua"), st.sampled_from(["", "truncated", "blank"])), min_size=2, max_size=40), st.data())
def test_a_sequence_may_be_cut_anywhere(rows, data):
    cut = data.draw(st.integers(1, len(rows) - 1))
    cost, audit = repair.cheapest(repair.parse(rows))
    assert repair.cheapest(repair._joined([repair.parse(rows[:cut]), repair.parse(rows[cut:])])) == (cost, audit)
    done = list(repair.steps(audit, "".join(x for x, _ in rows)))
    assert len(done) == len(rows) and "".join(x for x, _ in done) == audit
    assert GOOD.fullmatch("".join("-sua"[x] for _, states in done for x in states))


def brute_damage(turns):
    out = []
    for conv, turn, role, text in turns:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def brute_report(turns):
    report = {}
    for conv in {x[0] for x in turns}:
        rows = [x for x in brute_damage(turns) if x[0] == conv]
        rows.sort(key=lambda x: (x[1] is not None, x[1] or 0))
        seen, faults = set(), []
        for _, _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [x[2][:1] for x in rows]
        cost, audit = brute_long(list(zip(initials, faults, strict=True)))
        lines, state, k = [], "", 0
        for edit in audit:
            if edit != "D":
                state = initials[k] if edit == "K" else "a" if state == "u" else "u"
                role = rows[k][2] if edit == "K" else {"u": "user", "a": "assistant"}[state]
                lines.append(f"{role}:{'' if edit == 'I' else rows[k][3]}")
            k += edit != "I"
        known = [x[1] for x in rows if x[1] is not None]
        report[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in repair.FAULTS),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return report


def brute_long(rows):
    """The same as `brute_repair` for longer sequences: the best way to each state, row by row."""
    follows = {"s": ["-"], "u": ["-", "s", "a"], "a": ["u"]}

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit) in list(ways.items()):
                to = "a" if state == "u" else "u"
                ways[to] = min(ways.get(to, (10**9, "")), (cost + 5, audit + "I"))
        return ways

    ways = {"-": (0, "")}
    for initial, fault in rows:
        after = {}
        for state, (cost, audit) in inserted(ways).items():
            options = [(state, cost + 2, audit + "D")]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                options += [(initial, cost + more, audit + "K")] if state in follows.get(initial, ()) else []
                options += [(x, cost + more + 1, audit + "R") for x in "ua" if state in follows[x]]
            for to, c, a in options:
                after[to] = min(after.get(to, (10**9, "")), (c, a))
        ways = after
    return min(v for k, v in inserted(ways).items() if k in "-a")


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    texts = ["Yes.", "No", "  \t\n", "", "Why? ", "Über!", "\u0085", "long. " * 20_000, "a<turn b>", "x\\", "é. \n"]
    roles = ["user", "assistant", "system", "tool", "", "User"]
    rows = []
    for conv in [*range(1, 40), None]:
        turn = 0
        for _ in range(rng.randrange(1, 12)):
            turn += rng.choice([1, 1, 1, 2])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    rows += [(90, None, "user", "Hi."), (91, 1, None, None), (92, 0, "user", "Same."), (92, 0, "user", "Same."), (-5, -3, "assistant", "a.")]
    rows += [(93, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(300)]
    return rows


@pytest.fixture(scope="module")
def table(spark, turns, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("turns") / "t")
    spark.createDataFrame([(*x, 7, "x", 7, "x", 7) for x in turns], TURNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_repair_gives_the_brute_force_rows(table, turns):
    columns = "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    found = {r.conv_id: tuple(r[c] for c in columns) for r in repair.damage_and_repair(table).collect()}
    assert found == brute_report(turns)


def test_a_conversation_over_many_tasks(spark):
    rng = random.Random(8)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"{i}.", " "])) for i in range(2000)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").repartition(7)
    fix = repair.Repair(df, most=64)
    assert fix.solved.count() > 2000 // 64
    texts, faults = set(), []
    for _, _, role, text in rows:
        faults.append("blank" if not text.strip() else "duplicate" if (role, text) in texts else "" if text.endswith(".") else "truncated")
        texts.add((role, text))
    cost, audit = brute_long(list(zip([x[2][0] for x in rows], faults, strict=True)))
    assert fix.audits().select("cost", "audit").first() == (cost, audit)
    left = fix.repaired().orderBy("at", "part").collect()
    assert GOOD.fullmatch("".join(r.role[0] for r in left)) and len(left) == len(audit) - audit.count("D")


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repair.damage_and_repair(empty).collect() == []
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair.damage_and_repair(spark.createDataFrame([(dropped, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")).first()
    assert (row.conv_id, row.cost, row.audit, row.repaired_sha256) == (dropped, 0, "", hashlib.sha256().hexdigest())


# --- Reply trees ----------------------------------------------------------------------------------


@pytest.mark.parametrize("text", [
    "", "plain", "</turn>", "<turn user>\n", "<\\turn", "<\\\\/turn", "<<turn", "\n</turn>\n", "a\n", "\n\n", "<", "</tur", "😀<turn",
    "\\### Assistant: </turn> ok", "$1 \\1", "&lt;",
])
def test_texts_come_back(one, text):
    written = chat.escape(one.F.col("a"))
    kept = one(written, row=(text,))
    assert "<turn" not in kept and "</turn" not in kept
    assert one(chat.unescape(written), row=(text,)) == text


def test_chains_come_back(table, turns):
    formatted = chat.format_trees(chat.chain(table))
    read = formatted.select("tree", "n_turns", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("turns"),
                            chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(read) == len({x[0] for x in turns})
    for r in read:
        own = sorted((x for x in turns if x[0] == r.tree), key=lambda x: (x[1] is not None, x[1] or 0))
        expected = [(x[2] or "", x[3] or "") for x in own]
        assert [tuple(t) for t in r.turns] == expected and r.n_turns == len(expected)
        assert r.loss == "".join(t for role, t in expected if role == "assistant")
        raw = r.formatted.encode()
        for s in r.loss_spans:
            part = r.formatted[s.start : s.start + s.length]
            assert part.encode() == raw[s.byte_start : s.byte_start + s.byte_length]
            assert r.formatted[: s.start].endswith("<turn assistant>\n") and r.formatted[s.start + s.length :].startswith("\n</turn>\n")
    by_conv = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for r in read:
        plain = "".join(f"{t.role}\n{t.text}\n" for t in r.turns)
        assert by_conv[r.tree].turns_sha256 == hashlib.sha256(plain.encode()).hexdigest()
        assert by_conv[r.tree].loss_chars == len(r.loss)


def brute_branches(rows, keep):
    """(tree, message, parent, score) -> {(tree, rank): messages from the root on}."""
    out = {}
    for tree in {x[0] for x in rows}:
        own = {x[1]: x for x in rows if x[0] == tree}
        parents = {x[2] for x in own.values()}
        ways = []
        for place, x in enumerate(own.values()):
            if x[1] not in parents:
                way = [x]
                while way[-1][2] in own:
                    way.append(own[way[-1][2]])
                ways.append((-sum(y[3] or 0 for y in way) / len(way), place, [y[1] for y in way[::-1]]))
        for rank, (_, _, way) in enumerate(sorted(ways)[:keep], 1):
            out[tree, rank] = way
    return out


def test_branches_of_trees(spark):
    rng = random.Random(4)
    rows = []
    for tree in (1, 2, 3, None):
        for m in range(60):
            parent = None if m == 0 else 999 if m == 7 else rng.choice([m - 1, rng.randrange(m)])
            rows.append((tree, m, parent, rng.choice([None, 0.0, 1.0, 2.0]), rng.choice(["user", "assistant"]), f"{tree}/{m}"))
    rows += [(9, 0, None, 0.0, "user", "9/0")] + [(9, i, 0, float(i % 5), "assistant", f"9/{i}") for i in range(1, 400)]
    df = spark.createDataFrame(rows, "tree int, message int, parent int, score double, role string, text string").coalesce(1)
    for keep in (2, None):
        read = chat.format_trees(df, keep=keep).select("tree", "rank", chat.read_turns(F.col("formatted")).alias("turns")).collect()
        found = {(r.tree, r["rank"]): [int(t.text.split("/")[1]) for t in r.turns] for r in read}
        assert found == brute_branches([x[:4] for x in rows], keep)


def test_circles_and_nothing(spark):
    kind = "tree int, message int, parent int, score double, role string, text string"
    with pytest.raises(ValueError, match="circle"):
        chat.format_trees(spark.createDataFrame([(1, 1, 2, 0.0, "u", "a"), (1, 2, 1, 0.0, "u", "b")], kind))
    assert chat.digests(chat.format_trees(spark.createDataFrame([], kind))).collect() == []
    row = chat.format_trees(spark.createDataFrame([(None, None, None, None, None, None)], kind)).first()
    assert (row.n_turns, row.formatted) == (1, "<turn >\n\n</turn>\n")


def test_order_without_gaps(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id").repartition(5)
    rows = ordering.dense(ordering.in_order(df, "k", "id")).collect()
    assert sorted(r.position for r in rows) == list(range(1000))
    assert [r.id for r in sorted(rows, key=lambda r: r.position)] == sorted(range(1000), key=lambda i: (i % 7, i))


def test_chat_runs_no_python(table, capsys):
    chat.digests(chat.format_trees(chat.chain(table))).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
