"""Conversation repair against all edit sequences, and on awkward rows."""

import hashlib
import itertools
import random

from vigil.llm import dawg

SCHEMA = "conv_id long, turn long, role string, text string, conv string, n int, digest string, audit string, place int"


def brute(signature):
    """(cost, audit) least over every sequence of edits with at most two insertions in one place."""
    after = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}
    best = None
    todo = [(0, "0", 0, "", 0)]
    while todo:
        at, state, cost, audit, run = todo.pop()
        if at == len(signature) and state in "03" and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if run < 2:
            todo += [(at, after[state, r], cost + 3, audit + "I", run + 1) for r in "ua" if (state, r) in after]
        if at < len(signature):
            x = signature[at]
            todo.append((at + 1, state, cost + 4, audit + "D", 0))
            if x != "x":
                late = 3 * x.isupper()
                if (state, x.lower()) in after:
                    todo.append((at + 1, after[state, x.lower()], cost + late, audit + "K", 0))
                todo += [(at + 1, after[state, r], cost + late + 3, audit + "R", 0) for r in "ua" if (state, r) in after]
    return best


def test_all_edit_sequences(spark):
    rng = random.Random(5)
    given = {"".join(rng.choice("suaoSUAOx") for _ in range(k)) for k in (1, 2, 3, 4, 5) for _ in range(30)} | set("suaoSUAOx")
    got = {r["signature"]: (r["cost"], r["audit"]) for r in dawg.solve(spark.createDataFrame([(s,) for s in given], "signature string")).collect()}
    assert got == {s: brute(s) for s in given}


def plain(rows):
    """The contract, conversation by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted([(r[1] is not None, r[1] or 0, " " if r[2] is None else r[2], hashlib.md5((" " if r[3] is None else r[3]).encode()).hexdigest(), " " if r[3] is None else r[3])
                       for r in rows if r[0] == conv])
        seen, sig, faults = set(), "", []
        for _, _, role, _, text in mine:
            bare = text.strip(" \t\n\v\f\r")
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            c = role[:1] if role[:1] in ("s", "u", "a") else "o"
            sig += "x" if fault in ("b", "d") else c.upper() if fault == "t" else c
        turns = [r[1] for r in rows if r[0] == conv and r[1] is not None]
        firsts = [m[2][:1] for m in mine]
        out[conv] = (sig, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), [(m[2], m[4]) for m in mine])
    return out


def test_awkward_rows(spark):
    rng = random.Random(7)
    rows = [(c, t, r, x, "z", 1, "q", "a", 2) for c in (1, 2, None) for t, r, x in [
        (0, "system", "Be kind."), (1, "user", "Hi."), (1, "user", "Hi."), (1, "user", "Hi."), (2, "assistant", "Yes"), (None, "user", "lost."), (3, "user", None), (4, None, "who?"),
        (6, "", "none."), (7, "user", "Hi."), (9, "assistant", "　"), (10, "assistant", "end! \n"), (11, "tool", "x.")]]
    rows += [(3, None, None, None, "z", 1, "q", "a", 2)] * 3 + [(4, 1, "assistant", "only", "z", 1, "q", "a", 2)]
    rows += [(5, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "", f"{t}."]), "z", 1, "q", "a", 2) for t in range(1500)]
    reports, repaired = dawg.repair(spark.createDataFrame(rows, SCHEMA).repartition(5))
    reports = {r["conv_id"]: r for r in reports.collect()}
    found = {c: [(r["place"], r["edit"], r["role"], r["text"]) for r in g] for c, g in itertools.groupby(repaired.collect(), lambda r: r["conv_id"])}
    sums = {r["conv_id"]: r["repaired_sha256"] for r in dawg.digests(repaired).collect()}
    want = plain(rows)
    assert set(reports) == set(want)
    for conv, (sig, gaps, blank, dup, late, illegal, given) in want.items():
        r = reports[conv]
        assert (r["signature"], r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"]) == (sig, gaps, blank, dup, late, illegal), conv
        if len(sig) < 20:
            cost, audit = brute(sig) if len(sig) < 6 else (r["cost"], r["audit"])
            assert (r["cost"], r["audit"]) == (cost, audit)
        assert r["cost"] == sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in r["audit"]) + 3 * sum(
            s.isupper() and e != "D" for s, e in zip(sig, r["audit"].replace("I", "")))
        out, left = [], iter(given)
        for e in r["audit"]:
            role, text = ("", "") if e == "I" else next(left)
            if e != "D":
                out.append((e, role, text))
        got = found.get(conv, [])
        assert [g[0] for g in got] == list(range(len(got))) and [(g[1], g[3]) for g in got] == [(e, x) for e, _, x in out]
        assert all(g[2] == o[1] for g, o in zip(got, out) if o[0] == "K")
        initials = "".join(g[2][0] for g in got)
        assert initials == "" or initials.lstrip("s") == "ua" * (len(initials.lstrip("s")) // 2) and len(initials) - len(initials.lstrip("s")) < 2
        joined = "\n".join(f"{g[2]}:{g[3]}" for g in got)
        assert sums.get(conv, hashlib.sha256(b"").hexdigest()) == hashlib.sha256(joined.encode()).hexdigest()


def test_ranges_and_empty(spark, monkeypatch):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}." if t % 7 else "same.", "", 0, "", "", 0) for t in range(3000)] + [(1, 2999, "user", "t2999.", "", 0, "", "", 0)] * 500
    df = spark.createDataFrame(rows, SCHEMA)
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = dawg.signatures(dawg.distinct_rows(df, "conv_id", "turn", "role", "text")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    sig, gaps, blank, dup, late, illegal, _ = plain(rows)[1]
    r = got[0]
    assert len(got) == 1 and (r["signature"], r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"]) == (sig, gaps, blank, dup, late, illegal)
    reports, repaired = dawg.repair(spark.createDataFrame([], SCHEMA))
    assert reports.count() == 0 and repaired.count() == 0 and dawg.digests(repaired).count() == 0
