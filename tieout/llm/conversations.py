"""Operator 11: conversation structure repair with the auction algorithm for shortest paths.

A conversation of n rows is a lattice of nodes (row i, state s); s says what the kept roles spell so
far (nothing, a system turn, up to a user, up to an assistant). Arcs are the edits with their
integer costs: Delete, Keep and Rerole go to the next row, Insert stays at its row. Node prices start
at the lowest of the next row, below any converged price. From an origin, a path is extended along
its cheapest arc (cost plus price of the far node); where a node's price is below that, the price
rises to it and the path is contracted by one node. A path that meets a node with a converged price
(at the far end: the sink) ends, and all its nodes have converged.
Origins are the nodes from the last row backwards, so all prices converge in time linear in the rows.
An arc is tight if its cost is the difference of the prices; the walk along tight arcs that always
takes the ASCII-least edit is the audit. No arc leads from a node by two ways with one initial.

Spark deals the damaged rows by range of (conv_id, turn, role, hash of the text), one exchange. A task
reads them as a stream and repairs each conversation that lies inside its range. What may go on in a
neighbouring range, or is too long to hold, is cut into segments of bounded rows and bytes: the cost
of every way through a segment (4 x 4 states), prices at the cuts, tight walks inside each segment,
and the states at the cuts. A conversation with a third of all rows is so shared by all tasks; only
its audit and its hash, a chain over all of its text by definition, are put together by one task, the
hash as a stream.

Defined cases: null conv_id, turn, role and text count as one space in the damage key and the texts;
a null conv_id is a conversation of its own, null turns come first. Rows of one turn stand by role,
then by a 64-bit hash of the text; equal rows are duplicates. A role that is empty or begins with
another letter than s, u, a can't be kept. Of a conversation without a row left: zeros, an empty audit
and the hash of the empty string. An empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written

#: Fixed values of the contract.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLANK = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}

#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant (0 and 3 may end).
KEPT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
NEXT = [2, 2, 3, 2]
ROLE = {2: "user", 3: "assistant"}
FAR = 1 << 60

#: A conversation beyond these is cut, a segment has no more (but for a single longer row).
HELD_ROWS, HELD_BYTES = 2_000, 4_000_000
_KNOWN: dict[str, tuple[int, str]] = {}


def arcs(code: str, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of the edits of one row, ASCII order; see ``row_code``."""
    out = [("D", DELETE, state)]
    if code != "D":
        extra = TRUNCATED if code.isupper() or code == "_" else 0
        kept = KEPT[state].get(code.lower())
        if kept:
            out.append(("K", extra, kept))
        out.append(("R", REROLE + extra, NEXT[state]))
    return out


def row_code(initial: str, must_go: bool, truncated: bool) -> str:
    """One letter for what the lattice knows of a row: D must go; else the initial (- for others), upper case (_) if truncated."""
    if must_go:
        return "D"
    code = initial if initial and initial in "sua" else "-"
    return (code.upper() if code != "-" else "_") if truncated else code


def converge(codes: str, ends: list[int], states: range = range(4)) -> list[list[int]]:
    """Converged prices of all nodes; ``ends`` are those behind the last row (FAR: not to be reached).

    Where ``states`` leaves out 2 and 3, there are no Insert arcs and some nodes reach nothing: FAR.
    """
    price = [[] for _ in codes] + [list(ends)]
    inserts = len(states) == 4
    for i in range(len(codes) - 1, -1, -1):
        far = price[i + 1]
        now = price[i] = [min(far)] * 4  # no arc lowers a price, so this start is below every converged one
        ahead = [[(cost, to) for _, cost, to in arcs(codes[i], s) if to in states] for s in range(4)]
        settled = [False] * 4
        for origin in states:
            path = [origin]
            while not settled[origin]:
                s = path[-1]
                best, to = min(min((cost + far[t] for cost, t in ahead[s]), default=FAR), FAR), -1
                if inserts and INSERT + now[NEXT[s]] < best:
                    best, to = INSERT + now[NEXT[s]], NEXT[s]
                if now[s] < best:
                    now[s] = best  # raise the price and contract
                    if len(path) > 1:
                        path.pop()
                elif to < 0 or settled[to]:  # the path ends at a converged node
                    for node in path:
                        settled[node] = True
                else:
                    path.append(to)  # extend
    return price


def closing() -> tuple[list[int], list[str]]:
    """Prices and edits behind the last row: what is open is closed by Inserts."""
    price, edits = [], []
    for s in range(4):
        text = ""
        while s in (1, 2):
            s, text = NEXT[s], text + "I"
        price.append(INSERT * len(text))
        edits.append(text)
    return price, edits


ENDS, TAILS = closing()


def trace(codes: str, price: list[list[int]], state: int) -> tuple[str, int]:
    """The ASCII-least walk along tight arcs from (0, state), and the state it ends in."""
    out = []
    for i, code in enumerate(codes):
        while True:
            here = price[i][state]
            options = [(edit, to, i + 1) for edit, cost, to in arcs(code, state) if here == cost + price[i + 1][to]]
            if here == INSERT + price[i][NEXT[state]]:
                options.append(("I", NEXT[state], i))
            edit, state, row = min(options)
            out.append(edit)
            if row > i:
                break
    return "".join(out), state


def repair(codes: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    found = _KNOWN.get(codes)
    if found is None:
        price = converge(codes, ENDS)
        audit, state = trace(codes, price, 0)
        found = (price[0][0], audit + TAILS[state])
        if len(codes) <= 64 and len(_KNOWN) < 100_000:
            _KNOWN[codes] = found
    return found


def through(codes: str) -> list[int]:
    """The cost of every way through a segment: entry state times 4 plus state at its end."""
    out = [0] * 16
    for end in range(4):
        ends = [0 if s == end else FAR for s in range(4)]
        states = range(end + 1) if end < 2 else range(4)
        price = converge(codes, ends, states)[0]
        for s in range(4):
            out[4 * s + end] = price[s] if s in states else FAR
    return out


def lines(rows: list[tuple[str, str]], audit: str, state: int) -> Iterator[str]:
    """``role:text`` of the repaired rows."""
    at = 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        state = KEPT[state][role[:1]] if edit == "K" else NEXT[state]
        yield f"{role if edit == 'K' else ROLE[state]}:{text}"


def damaged(chats: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after the stated damage; ``chats`` may have other columns."""
    rows = chats.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    rows = rows.withColumn("fate", F.crc32(key.cast("binary")) % 20).where("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    twice = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), twice.alias("copy")).drop("copy")


DONE = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROW = "part int, seg int, pos long, turn long, role string, text string, initial string, code string"
_STREAM = f"is_open boolean, conv_id long, {DONE}, {ROW}"
_FIELDS = [(name, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}[kind]) for name, kind in (f.split() for f in _STREAM.split(", "))]


def _looks(text: str) -> tuple[bool, bool]:
    """(blank, truncated)"""
    end = text.rstrip(BLANK)[-1:]
    return not end, end not in ".!?"


def _whole(rows: list[tuple]) -> tuple:
    """The result of a conversation, of its rows (turn, role, text) in order."""
    blank = duplicate = truncated = 0
    seen: set[tuple[str, str]] = set()
    codes, initials = [], []
    for _, role, text in rows:
        is_blank, is_cut = _looks(text)
        again = (role, text) in seen
        seen.add((role, text))
        blank += is_blank
        duplicate += again and not is_blank
        truncated += is_cut and not again and not is_blank
        initials.append(role[:1])
        codes.append(row_code(role[:1], is_blank or again, is_cut))
    cost, audit = repair("".join(codes))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    text = "\n".join(lines([(role, text) for _, role, text in rows], audit, 0))
    return min(gaps, 2**63 - 1), blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs the conversations inside a sorted range; passes on the rows of the others."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    out_bytes = 0
    held: list[tuple] = []
    held_bytes = seg = seg_rows = seg_bytes = pos = 0
    conv, is_first, is_open = None, True, True
    begun = False

    def flush() -> pa.RecordBatch:
        nonlocal out, out_bytes
        columns = list(zip(*out, strict=True))
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], names=[n for n, _ in _FIELDS])
        out, out_bytes = [], 0
        return batch

    def pass_on() -> None:
        nonlocal held, held_bytes, seg, seg_rows, seg_bytes, pos, out_bytes
        for turn, role, text in held:
            size = len(role) + len(text)
            if seg_rows and (seg_rows >= HELD_ROWS or seg_bytes + size > HELD_BYTES):
                seg, seg_rows, seg_bytes = seg + 1, 0, 0
            is_blank, is_cut = _looks(text)
            out.append((True, conv, *[None] * 8, part, seg, pos, turn, role, text, role[:1] or "-", "D" if is_blank else row_code(role[:1], False, is_cut)))
            pos, seg_rows, seg_bytes = pos + 1, seg_rows + 1, seg_bytes + size
            out_bytes += size
        held, held_bytes = [], 0

    for batch in batches:
        for now, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
            if not begun or now != conv:
                if begun and not is_open and not is_first:
                    out.append((False, conv, *_whole(held), *[None] * 8))
                    out_bytes += 2 * len(held) + 200
                    held, held_bytes = [], 0
                elif begun:
                    pass_on()
                    seg, seg_rows, seg_bytes = seg + 1, 0, 0
                is_first = not begun  # the first of a range may go on from the one before
                conv, begun, is_open = now, True, is_first
            held.append((turn, role, text))
            held_bytes += len(text) + len(role)
            if is_open or len(held) >= HELD_ROWS or held_bytes > HELD_BYTES:
                is_open = True
                pass_on()
            if len(out) >= 5_000 or out_bytes > HELD_BYTES:
                yield flush()
    if begun:
        pass_on()  # the last may go on in the next range
    if out:
        yield flush()


@F.pandas_udf(T.ArrayType(T.LongType()))
def _through(codes: pd.Series) -> pd.Series:
    return codes.map(through)


@F.pandas_udf(T.StructType([T.StructField("audits", T.ArrayType(T.StringType())), T.StructField("ends", T.ArrayType(T.IntegerType()))]))
def _traces(codes: pd.Series, exits: pd.Series) -> pd.DataFrame:
    audits, ends = [], []
    for code, price in zip(codes, exits, strict=True):
        prices = converge(code, [int(p) for p in price])
        walks = [trace(code, prices, s) for s in range(4)]
        audits.append([a for a, _ in walks])
        ends.append([e for _, e in walks])
    return pd.DataFrame({"audits": audits, "ends": ends})


def _cut_prices(pdf: pd.DataFrame) -> pd.DataFrame:
    """The converged prices behind each segment of one conversation, from the last to the first."""
    pdf = pdf.sort_values(["part", "seg"])
    price, exits = ENDS, []
    for way in reversed(pdf["ways"].tolist()):
        exits.append(price)
        price = [min(min(int(way[4 * s + e]) + price[e], FAR) for e in range(4)) for s in range(4)]
    return pd.DataFrame({"conv": pdf["conv"], "part": pdf["part"], "seg": pdf["seg"], "exits": exits[::-1], "cost": price[0]})


def _entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state each segment of one conversation is entered in, its audit, and illegal pairs at the cuts."""
    pdf = pdf.sort_values(["part", "seg"])
    state, last, out = 0, "", []
    for audits, ends, initials in zip(pdf["audits"], pdf["ends"], pdf["initials"], strict=True):
        row = last + initials
        out.append((state, audits[state], sum(row[k : k + 2] not in LEGAL for k in range(len(row) - 1))))
        state, last = int(ends[state]), initials[-1]
    out[-1] = (out[-1][0], out[-1][1] + TAILS[state], out[-1][2])
    return pd.DataFrame({"conv": pdf["conv"], "part": pdf["part"], "seg": pdf["seg"], "entry": [o[0] for o in out], "audit": [o[1] for o in out], "illegal": [o[2] for o in out]})


def _chunk(rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
    rows, way = rows.sort_values("pos"), chosen.iloc[0]
    kept = list(lines(list(zip(rows["role"], rows["text"], strict=True)), way["audit"], int(way["entry"])))
    return pd.DataFrame({"conv": [way["conv"]], "part": [way["part"]], "seg": [way["seg"]], "chunk": ["\n".join(kept)], "n": [len(kept)]})


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, begun = None, None, False
    for batch in batches:
        names, sums = [], []
        for now, chunk, n in zip(*(batch.column(c) for c in ("conv", "chunk", "n")), strict=True):
            now = now.as_py()
            if now != conv:
                if digest:
                    names.append(conv)
                    sums.append(digest.hexdigest())
                conv, digest, begun = now, hashlib.sha256(), False
            if n.as_py():
                digest.update(b"\n" * begun + chunk.as_py().encode())
                begun = True
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sums, pa.string())], names=["conv", "repaired_sha256"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])


def _cut_conversations(rows: DataFrame) -> DataFrame:
    """Results (conv, then those of ``DONE``) of conversations given as segments of rows."""
    at, cut = ["conv", "part", "pos"], ["conv", "part", "seg"]
    fresh = rows.groupBy("conv", "role", F.sha2("text", 256)).agg(F.min(F.struct("part", "pos")).alias("first")).select("conv", "first.part", "first.pos", F.lit(True).alias("fresh"))
    again = F.col("fresh").isNull()
    blank = F.col("code") == "D"
    coded = rows.select(*at, "seg", "initial", "code").join(fresh, at, "left").select(
        *at, "seg", "initial", F.when(again, "D").otherwise(F.col("code")).alias("code"),
        blank.alias("blank"), (~blank & again).alias("duplicate"), (~blank & ~again & F.col("code").isin(*"SUA_")).alias("truncated"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "code", "initial")))
    segments = (
        coded.groupBy(*cut)
        .agg(ordered.alias("rows"), *(F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")))
        .select(*cut, "blank", "duplicate", "truncated", F.array_join("rows.code", "").alias("codes"), F.array_join("rows.initial", "").alias("initials"))
    )
    segments = written(segments.withColumn("ways", _through("codes")), "segments")
    prices = segments.select(*cut, "ways").groupBy("conv").applyInPandas(_cut_prices, "conv string, part int, seg int, exits array<long>, cost long")
    walked = segments.join(prices, cut).select(*cut, "blank", "duplicate", "truncated", "initials", "cost", _traces("codes", "exits").alias("walk"))
    walked = written(walked.select("*", "walk.*").drop("walk"), "walks")
    entries = walked.select(*cut, "audits", "ends", "initials").groupBy("conv").applyInPandas(_entries, "conv string, part int, seg int, entry int, audit string, illegal long")
    entries = written(entries, "entries")

    chunks = (
        rows.select(*cut, "pos", "role", "text").groupBy(*cut)
        .cogroup(entries.select(*cut, "entry", "audit").groupBy(*cut))
        .applyInPandas(_chunk, "conv string, part int, seg int, chunk string, n long")
    )
    hashes = chunks.repartition("conv").sortWithinPartitions(*cut).select("conv", "chunk", "n").mapInArrow(_hashes, "conv string, repaired_sha256 string")
    audits = entries.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "seg", "audit"))).alias("a"), F.sum("illegal").alias("illegal"))
    audits = audits.select("conv", F.array_join("a.audit", "").alias("audit"), "illegal")
    counts = walked.groupBy("conv").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.min_by("cost", F.struct("part", "seg")).alias("cost"))
    turns = rows.groupBy("conv").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"))
    span = F.col("high").cast("decimal(20,0)") - F.col("low") + 1 - F.col("turns")
    gaps = turns.select("conv", F.coalesce(F.least(span, F.lit(2**63 - 1)).cast("long"), F.lit(0).cast("long")).alias("gaps"))
    return gaps.join(counts, "conv").join(audits, "conv").join(hashes, "conv")


def repaired(chats: DataFrame) -> DataFrame:
    """One row per conversation of ``chats`` (conv_id, turn, role, text): its faults, cheapest repair and hash."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))
    rows = damaged(chats).withColumn("mark", F.xxhash64("text")).withColumn("salt", salt)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "mark", "salt")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")
    streamed = written(dealt.mapInArrow(_stream, _STREAM), "conversations")

    names = [f.split()[0] for f in DONE.split(", ")]
    done = streamed.where("not is_open").select("conv_id", *names)
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    cut = streamed.where("is_open").select(conv.alias("conv"), *(f.split()[0] for f in ROW.split(", ")))
    found = done.unionByName(_cut_conversations(cut).withColumn("conv_id", F.nullif("conv", F.lit("")).cast("long")).select("conv_id", *names))

    every = chats.select(F.col("conv_id").cast("long").alias("id")).distinct()
    empty = hashlib.sha256(b"").hexdigest()
    value = lambda c: F.coalesce(c, F.lit("") if c == "audit" else F.lit(empty) if c == "repaired_sha256" else F.lit(0).cast("long")).alias(c)
    return every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(F.col("id").alias("conv_id"), *map(value, names))


def op11_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))


def _oracle() -> str:
    """DuckDB SQL: per conversation the cheapest (cost, audit, lines) of each state, row by row."""
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: unicode(x)::BIGINT)), lambda c, b: "
        "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295::BIGINT)"
    )

    def go(s: int, cost: str, letter: str, line: str = "''") -> str:
        return f"{{'c': s{s}.c + {cost}, 'a': s{s}.a || '{letter}', 't': s{s}.t || {line}}}"

    far = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"
    cut = "5 * (fault = 'truncated')::INT"
    into: dict[int, list[str]] = {s: [go(s, "2", "D")] for s in range(4)}
    for s in range(4):
        may = "fault NOT IN ('blank', 'duplicate')"
        line = lambda role: f"chr(10) || {role} || ':' || text"
        into[NEXT[s]].append(f"CASE WHEN {may} THEN {go(s, '1 + ' + cut, 'R', line(repr(ROLE[NEXT[s]])))} ELSE {far} END")
        for initial, t in KEPT[s].items():
            into[t].append(f"CASE WHEN {may} AND left(role, 1) = '{initial}' THEN {go(s, cut, 'K', line('role'))} ELSE {far} END")
    rows = [f"least({', '.join(x)})" if len(x) > 1 else x[0] for x in into.values()]
    add = lambda s, role: go(s, "5", "I", f"chr(10) || '{role}:'")
    ins = f"s0, s1, least(s2, {add(0, 'user')}, {add(1, 'user')}, {add(3, 'user')}) AS s2, s3"
    ins2 = f"s0, s1, s2, least(s3, {add(2, 'assistant')}) AS s3"
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
fated AS (SELECT *, ({crc}) % 20 AS fate FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM fated WHERE fate <> 0),
placed AS (
  SELECT *, row_number() OVER w AS n, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body,
         left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faulty AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows
  FROM faulty GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, {far} AS s1,
         {{'c': 5::BIGINT, 'a': 'I', 't': chr(10) || 'user:'}} AS s2,
         {{'c': 10::BIGINT, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3 FROM counted
  UNION ALL
  SELECT conv_id, n, s0, s1, least(s2, {add(3, 'user')}) AS s2, s3 FROM (
    SELECT conv_id, n, {ins2} FROM (SELECT conv_id, n, {ins} FROM (
      SELECT conv_id, f.n, {", ".join(f"{e} AS s{s}" for s, e in enumerate(rows))}
      FROM walk JOIN faulty f USING (conv_id) WHERE f.n = walk.n + 1)))),
best AS (SELECT c.conv_id, least(s0, s3) AS b FROM walk JOIN counted c ON walk.conv_id = c.conv_id AND walk.n = c.rows)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted USING (conv_id) LEFT JOIN best USING (conv_id)
"""


ORACLE_SQL = _oracle()
