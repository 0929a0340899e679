"""Repair of conversations against every sequence of edits, plain recomputation, and SQL."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from beatline.llm import conversations as cv

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


def brute_audit(rows):
    """(cost, audit, lines) by trying all edits: rows are (role, text, must_go, cut)."""
    found = []

    def fits(initials):
        return re.fullmatch(r"(s?(ua)+)?", "".join(initials))

    def go(k, cost, audit, out):
        if cost > 4 * len(rows) + 6:
            return
        if k == len(rows):
            if fits([r[:1] or "?" for r, _ in out]):
                found.append((cost, audit, out))
        else:
            role, text, must_go, cut = rows[k]
            go(k + 1, cost + 4, audit + "D", out)
            if not must_go:
                go(k + 1, cost + 3 * cut, audit + "K", out + [(role, text)])
                for r in ("user", "assistant"):
                    go(k + 1, cost + 3 + 3 * cut, audit + "R", out + [(r, text)])
        if audit[-2:] != "II":
            for r in ("user", "assistant"):
                go(k, cost + 3, audit + "I", out + [(r, "")])

    go(0, 0, "", [])
    return min(found, key=lambda f: (f[0], f[1]))


def letter(role, must_go, cut):
    i = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return "x" if must_go else i.upper() if cut else i


def test_audits_equal_every_sequence_of_edits():
    cases = [(), *itertools.product("suaoSUAOx", repeat=1), *itertools.product("suaoSUAOx", repeat=2)]
    rng = random.Random(2)
    cases += [tuple(rng.choice("suaoUAx") for _ in range(3)) for _ in range(60)]
    words = sorted({"".join(c)[::-1] for c in cases})
    got = {w: (cost, audit) for w, cost, audit in cv.audits(words)}
    role = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}
    for w, (cost, audit) in got.items():
        rows = [(role[c.lower()], f"t{k}", c == "x", c.isupper()) for k, c in enumerate(w)]
        want = brute_audit(rows)
        assert (cost, audit) == want[:2], w
        assert [(r, t) for _, r, t, _ in cv.edited(audit, [(k, r, t, 1) for k, (r, t, _, _) in enumerate(rows)])] == want[2]


def test_nodes_of_a_common_end_are_shared(monkeypatch):
    made = []
    monkeypatch.setattr(cv, "node", lambda letter, after, f=cv.node: (made.append(letter), f(letter, after))[1])
    words = ["".join(c) + "uaUAxua" for c in itertools.product("suax", repeat=3)]
    assert len(list(cv.audits(sorted(w[::-1] for w in words)))) == 64
    assert len(made) == 7 + 4 + 16 + 64            # one for every distinct suffix
    assert len({cv.shared("abcabc", "abcabd"), cv.shared("", "a"), cv.shared("ab", "ab")}) == 3


def plain(rows):
    """The digest of each conversation by plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        conv_rows = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        conv_rows += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {t for t, _, _ in own if t is not None}
        n = {"blank": 0, "duplicate": 0, "truncated": 0}
        seen, faulty = set(), []
        for _, role, text in own:
            fault = ("blank" if not text.strip(BLANK) else "duplicate" if (role, text) in seen else
                     "truncated" if text.rstrip(BLANK)[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                n[fault] += 1
            faulty.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        word = "".join(letter(r, d, c) for r, _, d, c in faulty)
        cost, audit = next((c, a) for _, c, a in cv.audits([word[::-1]]))
        if len(own) <= 3:
            assert (cost, audit) == brute_audit(faulty)[:2]
        lines = "\n".join(f"{r}:{t}" for _, r, t, _ in cv.edited(audit, [(t, r, x, 1) for t, r, x in own]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *n.values(), illegal, cost, audit,
                     hashlib.sha256(lines.encode()).hexdigest())
    return out


def odd_rows():
    rng = random.Random(7)
    rows = [(None, None, None, None), (None, 3, "user", "no id."), (None, None, "user", "no turn"), (None, None, "user", "a tie."),
            (1, None, None, None), (2, 5, "", ""), (2, 5, "", "x."), (3, 1, "tool", "called.\n\n"), (3, 2, "úser", "é!"),
            (4, 9, "user", "long " * 100_000 + "."), (4, 9, "user", "long " * 100_000 + "."), (5, -4, "assistant", "\x0b\t"),
            (6, 1, "User", "upper."), (7, 1 << 62, "user", "far."), (7, -(1 << 62), "assistant", "far.")]
    for conv in range(10, 90):
        for turn in range(rng.randrange(12)):
            rows.append((conv, rng.choice([turn, turn, turn, 2 * turn, None]), rng.choice(["user", "assistant", "system", "tool"]),
                         rng.choice(["yes.", "no!", "cut", " ", "long one?", f"own {turn}."])))
    return rows


def test_digest_equals_plain_python(spark):
    rows = odd_rows()
    made = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, kind int, audit string")
    want = plain(rows)
    for parts in (1, 9):
        got = cv.digest(cv.damaged(made.repartition(parts)))
        assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    assert got.count() == len(want)


def test_sql_gives_the_same(spark):
    for source in (spark.createDataFrame(odd_rows(), "conv_id long, turn long, role string, text string"),
                   spark.read.parquet(f"{SF}/conversations.parquet")):
        con = duckdb.connect()
        con.register("conversations", source.toArrow())
        want = con.sql(cv.ORACLE).fetchall()
        got = cv.digest(cv.damaged(source)).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_one_long_conversation_is_read_in_parts(spark):
    rng = random.Random(1)
    rows = [(1, k // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["same.", f"{k}.", f"{k}", ""])) for k in range(6000)]
    made = spark.createDataFrame([r for r in rows] + [(2, 0, "user", "hi.")], "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r[0]: tuple(r[1:]) for r in cv.digest(cv.damaged(made)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == plain(rows + [(2, 0, "user", "hi.")])


def test_repaired_rows_and_empty_table(spark):
    made = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Again?"), (1, 2, "assistant", "cut of"), (2, 0, "x", " ")],
                                 "conv_id long, turn long, role string, text string")
    got = cv.repaired(cv.turns(made)).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, "user", "Hi.", "K"), (1, 1, None, "assistant", "", "I"),
                                       (1, 2, 1, "user", "Again?", "K"), (1, 3, 2, "assistant", "cut of", "K")]
    assert cv.digest(cv.damaged(made.limit(0))).count() == 0 == cv.repaired(cv.turns(made.limit(0))).count()


@pytest.mark.parametrize("a,b,n", [("", "", 0), ("abc", "abd", 2), ("abc", "abcd", 3), ("x", "y", 0)])
def test_common_beginning(a, b, n):
    assert cv.shared(a, b) == n
