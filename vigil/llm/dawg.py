"""Conversation structure repair: the cheapest edits that turn each conversation into ``(system? (user assistant)+)?``.

Each row becomes one symbol (its role's initial and its fault), each conversation a signature of one symbol a row.
The distinct signatures of all conversations form an acyclic automaton that shares their ends: a node is a distinct
suffix. Cost-to-go and the best edit are settled once for each node and grammar state, from the end; a signature's audit
is read off its path. Signatures are dealt in ranges of their reversed text and sorted, so all that share an end stand
together, a task holds one path at a time, and only the path at a range's border is built by two tasks.

A row's first fault counts: blank (no character but ASCII white space), duplicate (role and text stood earlier in the
conversation), truncated (the last such character is not one of ``.!?``). Edits: Keep 0, Rerole to user or assistant 3,
Delete 4 (the only edit of blank and duplicate rows), Insert an empty user or assistant row 3; a truncated row that is not
deleted adds 3. Of equal costs the audit (the edits' initials) least in ASCII order holds.

Rows go by turn (nulls first), then role, then MD5 of the text; a null role or text counts as one space, a null
conversation as one of its own. Rows equal in all columns are counted before they are moved, so many copies of one are one
row with a number. A very long conversation is cut into ranges of turns for its signature (a byte a row, like its audit);
its text passes through one task in order, as a stream. A table without rows gives no rows. Columns other than the four
are left out, so their names never clash.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import written

BLANK = "[^\\x20\\x09-\\x0D]"
ENDS = "[.!?][\\x20\\x09-\\x0D]*$"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Grammar states: 0 start, 1 after system, 2 after user, 3 after assistant; 0 and 3 may end.
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The role that an inserted or reroled row must have in each state, and the state after it.
NEXT = [("user", 2), ("user", 2), ("assistant", 3), ("user", 2)]
LEGAL = {"su", "ua", "au"}
#: Conversations with one signature are dealt over so many groups when its result is handed back to them.
SPREAD = 64
KEY = ["conv", "has_turn", "turn", "role", "digest"]


def _key() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in KEY]


def distinct_rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row (conv, has_turn, turn, role, digest, text, n) for each distinct row; written once."""
    x = df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                  F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    x = x.withColumn("digest", F.md5(F.col("text").cast("binary"))).withColumn("has_turn", F.col("turn").isNotNull())
    return written(x.groupBy(*KEY).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n")))


def symbols(rows: DataFrame) -> DataFrame:
    """The distinct rows without texts, with ``initial`` of the role, ``fault`` (b, d, t or empty) of the first copy, and ``n``."""
    place = F.struct("has_turn", "turn")
    many = rows.groupBy("conv", "role", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).filter("turns > 1")
    many = many.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("g"), "first")
    own = F.when(~F.col("text").rlike(BLANK), "b").when(~F.col("text").rlike(ENDS), "t").otherwise("")
    x = rows.select(*KEY, "n", F.substring("role", 1, 1).alias("initial"), own.alias("own"))
    x = x.join(many, x.conv.eqNullSafe(many.c) & (x.role == many.r) & (x.digest == many.g), "left")
    again = F.col("first").isNotNull() & ~place.eqNullSafe(F.col("first"))
    fault = F.when(F.col("own") == "b", "b").when(again, "d").otherwise(F.col("own"))
    return x.select(*KEY, "n", "initial", fault.alias("fault"))


def symbol(initial: str, fault: str) -> str:
    """x: must go; s, u, a, o: by the role; upper case: truncated."""
    if fault in ("b", "d"):
        return "x"
    s = initial if initial in ("s", "u", "a") else "o"
    return s.upper() if fault == "t" else s


def signatures(rows: DataFrame) -> DataFrame:
    """One row for each conversation: signature, gaps, blank, duplicate, truncated, illegal; from pieces of its range of turns."""
    small = written(symbols(rows))
    part = T.StructType([small.schema["conv"]] + [T.StructField(n, t) for n, t in (
        ("part", T.IntegerType()), ("signature", T.StringType()), ("blank", T.LongType()), ("duplicate", T.LongType()), ("truncated", T.LongType()),
        ("illegal", T.LongType()), ("first", T.StringType()), ("last", T.StringType()), ("low", T.LongType()), ("high", T.LongType()), ("turns", T.LongType()))])

    def run(batches):
        pid, now, out = TaskContext.get().partitionId(), None, []

        def row():
            return (now["conv"], pid, "".join(now["sig"]), now["b"], now["d"], now["t"], now["illegal"], now["first"], now["last"], now["low"], now["high"], now["turns"])

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv", "turn", "initial", "fault", "n")]
            for conv, turn, initial, fault, n in zip(*cols):
                if now is None or conv != now["conv"]:
                    if now is not None:
                        out.append(row())
                    now = {"conv": conv, "sig": [], "b": 0, "d": 0, "t": 0, "illegal": 0, "first": initial, "last": None, "low": None, "high": None, "turns": 0}
                now["illegal"] += (now["last"] is not None and now["last"] + initial not in LEGAL) + n - 1
                now["last"] = initial
                if turn is not None:
                    now["turns"] += turn != now["high"]
                    now["low"], now["high"] = turn if now["low"] is None else now["low"], turn
                now["sig"].append(symbol(initial, fault) + "x" * (n - 1))
                if fault:
                    now[fault] += 1
                now["b" if fault == "b" else "d"] += n - 1
            if out:
                yield _batch(out, part)
                out = []
        if now is not None:
            yield _batch([row()], part)

    pieces = small.repartitionByRange(*_key()).sortWithinPartitions(*_key()).mapInArrow(run, part)
    x = pieces.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*part.fieldNames()[1:]))).alias("p"))
    joints = "filter(sequence(1, size(p)), i -> i > 1 AND {})"
    broken = F.expr("size(" + joints.format("NOT concat(p[i - 2].last, p[i - 1].first) IN ('su', 'ua', 'au')") + ")")
    shared = F.expr("size(" + joints.format("coalesce(p[i - 2].high = p[i - 1].low, false)") + ")")
    total = {c: F.expr(f"aggregate(p, 0L, (z, e) -> z + e.{c})") for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
    gaps = F.array_max("p.high") - F.array_min("p.low") + 1 - (total["turns"] - shared)
    return x.select("conv", F.concat_ws("", "p.signature").alias("signature"), F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), total["blank"].alias("blank"),
                    total["duplicate"].alias("duplicate"), total["truncated"].alias("truncated"), (total["illegal"] + broken).cast("long").alias("illegal"))


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


#: A node: the cost-to-go and the best edit in each grammar state. The end: nothing to do where the grammar may stop.
END = ((0, 2 * INSERT, INSERT, 0), (".", "I", "I", "."))


@lru_cache(maxsize=100_000)
def node(sym: str, child: tuple) -> tuple:
    """Costs and edits of ``sym`` + the suffix with costs ``child`` (less their least, so that few different ones are met)."""
    late = TRUNCATED if sym.isupper() else 0
    plain = []
    for state in range(4):
        ways = [(DELETE + child[state], "D")]
        if sym != "x":
            after = AFTER.get((state, sym.lower()))
            if after is not None:
                ways.append((late + child[after], "K"))
            ways.append((late + REROLE + child[NEXT[state][1]], "R"))
        plain.append(ways)
    cost = [min(w)[0] for w in plain]
    for _ in range(2):  # no best way inserts more than two rows in one place
        cost = [min(c, INSERT + cost[NEXT[s][1]]) for s, c in enumerate(cost)]
    edits = [min(op for c, op in [*plain[s], (INSERT + cost[NEXT[s][1]], "I")] if c == cost[s]) for s in range(4)]
    return tuple(cost), "".join(edits)


def path_edits(path: list, signature: str) -> str:
    """The audit along a path: ``path[k]`` is the node of the last k symbols."""
    out, state, left = [], 0, len(signature)
    while True:
        op = path[left][1][state]
        if op == ".":
            return "".join(out)
        out.append(op)
        if op == "I":
            state = NEXT[state][1]
            continue
        if op != "D":
            state = AFTER[state, signature[len(signature) - left].lower()] if op == "K" else NEXT[state][1]
        left -= 1


def solve(signatures: DataFrame) -> DataFrame:
    """``signature``, ``cost`` and ``audit`` of the distinct signatures, along the automaton that shares their ends."""
    schema = T.StructType([T.StructField("signature", T.StringType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])

    def run(batches):
        path, last = [(*END, 0)], ""
        for batch in batches:
            out = []
            for back in batch.column(0).to_pylist():
                shared = 0
                while shared < min(len(back), len(last)) and back[shared] == last[shared]:
                    shared += 1
                del path[shared + 1:]
                for s in back[shared:]:
                    cost, edits, base = path[-1]
                    low = min(cost)
                    cost, edits = node(s, tuple(c - low for c in cost))
                    path.append((cost, edits, base + low))
                last, signature = back, back[::-1]
                out.append((signature, path[-1][0][0] + path[-1][2], path_edits(path, signature)))
            if out:
                yield _batch(out, schema)

    back = signatures.select(F.reverse("signature").alias("back")).distinct()
    return written(back).repartitionByRange("back").sortWithinPartitions("back").mapInArrow(run, schema)


def _reports(rows: DataFrame) -> DataFrame:
    group = F.pmod(F.xxhash64("conv"), F.lit(SPREAD))
    convs = written(signatures(rows).withColumn("part", group))
    pairs = convs.select("signature", "part").distinct()
    solved = written(solve(convs.select("signature")))
    # a signature has at most SPREAD pairs, so one that many conversations share is no hot key
    return written(convs.join(pairs.join(solved, "signature"), ["signature", "part"]).drop("part"))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(reports, repaired): one report a conversation (``conv``, signature, gaps, blank, duplicate, truncated, illegal, cost, audit),
    and the repaired rows (``conv``, place from 0, edit, role, text), which lie in their order within the partitions."""
    rows = distinct_rows(df, conv, turn, role, text)
    reports = _reports(rows)
    return reports.withColumnRenamed("conv", conv), _repaired(rows, reports).withColumnRenamed("conv", conv)


def _repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    schema = T.StructType([rows.schema["conv"]] + [T.StructField(n, t) for n, t in (
        ("place", T.LongType()), ("edit", T.StringType()), ("role", T.StringType()), ("text", T.StringType()))])
    # first a conversation's audit, then its rows in order
    head = reports.select("conv", F.lit(0).alias("kind"), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in KEY[1:]],
                          F.lit(None).cast("string").alias("text"), F.lit(1).cast("long").alias("n"), "audit")
    body = rows.select("conv", F.lit(1).alias("kind"), *KEY[1:], "text", "n", F.lit(None).cast("string").alias("audit"))

    def run(batches):
        conv, edits, at, end, state, place = None, "", 0, 0, 0, 0
        for batch in batches:
            out = []
            for c, kind, role, text, n, audit in zip(*[batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("conv", "kind", "role", "text", "n", "audit")]):
                if kind == 0:
                    conv, edits, at, end, state, place = c, audit, 0, len(audit.rstrip("I")), 0, 0
                    continue
                for _ in range(n):
                    op = "I"
                    while op == "I":
                        op, at = edits[at], at + 1
                        if op in "IR":
                            role_now, state = NEXT[state]
                        elif op == "K":
                            role_now, state = role, AFTER[state, role[0]]
                        if op != "D":
                            out.append((conv, place, op, role_now, "" if op == "I" else text))
                            place += 1
                if at == end:  # the last row is through: what is left are insertions
                    for at in range(end, len(edits)):
                        role_now, state = NEXT[state]
                        out.append((conv, place, "I", role_now, ""))
                        place += 1
            if out:
                yield _batch(out, schema)

    order = [F.col(c).asc_nulls_first() for c in ["conv", "kind", *KEY[1:]]]
    return head.unionByName(body).repartition("conv").sortWithinPartitions(*order).mapInArrow(run, schema)


def digests(repaired: DataFrame, conv: str = "conv_id") -> DataFrame:
    """SHA-256 of each conversation's repaired rows (``role:text``, joined by line ends), read as a stream in their order."""
    schema = T.StructType([repaired.schema[conv], T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        now, h = None, None
        for batch in batches:
            out = []
            for c, role, text in zip(*[batch.column(batch.schema.get_field_index(x)).to_pylist() for x in (conv, "role", "text")]):
                if h is None or c != now:
                    if h is not None:
                        out.append((now, h.hexdigest()))
                    now, h = c, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    h.update(f"\n{role}:{text}".encode())
            if out:
                yield _batch(out, schema)
        if h is not None:
            yield _batch([(now, h.hexdigest())], schema)

    return repaired.mapInArrow(run, schema)


def damaged(df: DataFrame) -> DataFrame:
    """The given rows with repeatable faults, by crc32 of ``conv_id:turn`` modulo 20: 0 dropped, 1 emptied, 2 without end marks, 3 twice, 4 as user."""
    space = F.lit(" ")
    x = df.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    x = x.withColumn("f", F.crc32(key.cast("binary")) % 20).filter("f != 0")
    text = F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    x = x.select("conv_id", "turn", F.when(F.col("f") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                 F.explode(F.array_repeat(F.lit(0), F.when(F.col("f") == 3, 2).otherwise(1))).alias("copy"))
    return x.drop("copy")
