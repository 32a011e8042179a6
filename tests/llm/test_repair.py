"""Conversation repair against a plain search over all edits' costs and audits."""
import hashlib
import random
import zlib

import pytest

from lociq.llm import queries, repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, `at` int, n int, place int, key int, block int"
EMPTY = hashlib.sha256().hexdigest()


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        some = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if f == 1:
            text = ""
        if f == 2:
            text = "".join(c for c in text if c not in ".!?")
        if f == 4:
            role = "user"
        if f:
            some += [(turn, role, text)] * (2 if f == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1][:1], digest(r))) for c, x in out.items()}


def plain(rows):
    out = {}
    for conv, some in damaged(rows).items():
        kinds, seen = [], set()
        for _, role, text in some:
            bare = text.strip(SPACE)
            kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, *_ in some if t is not None]
        initials = [r[:1] for _, r, _ in some]
        # (cost, audit, messages) of the best way on from each state behind the rows that are left; states: nothing, s, u, a.
        nexts, names = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}

        def inserted(best):
            for _ in range(4):
                for s in best:
                    c, a, m = best[nexts[s]]
                    best[s] = min(best[s], (c + 3, "I" + a, ((names[nexts[s]], ""), *m)), key=lambda x: x[:2])
            return best

        best = inserted({"": (0, "", ()), "s": (9**9, "", ()), "u": (9**9, "", ()), "a": (0, "", ())})
        for (_, role, text), kind in zip(some[::-1], kinds[::-1]):
            now = {}
            for s in best:
                c, a, m = best[s]
                ways = [(c + 4, "D" + a, m)]
                if kind in ("", "truncated"):
                    more = 3 * (kind == "truncated")
                    if role[:1] == "s" and s == "" or role[:1] in ("u", "a") and role[:1] == nexts[s]:
                        c, a, m = best[role[:1]]
                        ways.append((c + more, "K" + a, ((role, text), *m)))
                    c, a, m = best[nexts[s]]
                    ways.append((c + 3 + more, "R" + a, ((names[nexts[s]], text), *m)))
                now[s] = min(ways, key=lambda x: x[:2])
            best = inserted(now)
        cost, audit, messages = best[""]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest())
    return out


def drawn(n, seed, longest=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "  \t", "", None, "Long text. With more", "é ok.", "end.\n"]
    out = []
    for conv in [*range(n), None]:
        for turn in range(rng.randrange(1, longest)):
            out.append((conv, rng.choice([turn, turn, turn, turn + 2, None]) if rng.random() < 0.3 else turn, rng.choice(["user", "assistant"] * 4 + ["system", "tool", None, "", "ux"]), rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randrange(40)}."))
    return out


def got(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], SCHEMA).repartition(3)
    return {r[0]: tuple(r)[1:] for r in repair.repair(frame, **more).collect()}


@pytest.mark.parametrize("rows,block", [(drawn(150, 1), 256), (drawn(60, 2), 2), (drawn(4, 3, 90), 4)])
def test_as_a_plain_search(spark, rows, block):
    assert got(spark, rows, block=block) == plain(rows)


def test_awkward_rows(spark):
    rows = [(1, None, None, None), (2, 0, "user", "one."), (2, 0, "user", "one."), (2, 1, "user", "one."), (3, -(2**63), "user", "x."), (3, 2**63 - 1, "assistant", "y."), (None, None, "user", "Hello."), (4, 0, "system", "s" * 200000 + "."), (4, 1, "user", "\x0b"), (5, 3, "assistant", "no end"), (6, 0, "user", None), (7, None, "a", "."), (7, None, "u", ".")]
    want, out = plain(rows), got(spark, rows)
    assert out.pop(3)[1:] == want.pop(3)[1:]
    assert out == want


def test_empty(spark):
    out = repair.repair(spark.createDataFrame([], SCHEMA))
    assert out.collect() == [] and out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    gone = [(c, t, "user", "x.") for c in range(40) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone and set(got(spark, gone).values()) == {(0, 0, 0, 0, 0, 0, "", EMPTY)}


def test_one_long_conversation_is_many_blocks(spark):
    """Rows of a hot conversation, many of them alike, keep to blocks of bounded size; the result is the plain one."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["again.", f"no {t}.", "cut"])) for t in range(6000)] + drawn(20, 6)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    some = repair.blocks(repair.faults(repair.rows_of(frame)), 64)
    sizes = [r[0] for r in some.selectExpr("size(rows)").collect()]
    assert max(sizes) <= 64 and len(sizes) > 6000 * 0.8 // 64
    assert {r[0]: tuple(r)[1:] for r in repair.repair(frame, 64).collect()} == plain(rows)


def test_query(spark):
    import pyarrow.parquet as pq

    rows = [tuple(r.values()) for r in pq.read_table("/root/testdata/sf0.01/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    assert {r[0]: tuple(r)[1:] for r in queries.op13_repair(spark, "/root/testdata/sf0.01").collect()} == plain(rows)
