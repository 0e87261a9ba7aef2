"""Conversation structure repair: generalised LR parsing of roles with weighted edits.

The role grammar's LR automaton reads the turns of a conversation. A level of the
graph-structured stack holds the stacks that are alive after a turn; keeping, reroling or
deleting the turn and inserting turns before it make the next level, on which equal stack tops
are merged into the one of least (cost, audit). Costs on a level are relative and audits are
ranked against each other, so levels repeat and their successors are remembered.

Turns are sorted over range partitions. A conversation inside a partition is parsed there.
Where one crosses partitions or is long, each of its parts is first summed up as the least
(cost, audit rank) from every stack top to every other; the sums are composed part by part,
which fixes the top at which each part starts and ends, and the parts are parsed apart.
"""

from __future__ import annotations

import functools
import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, salts, skew_join

#: Initials of roles: (s?(ua)+)?
ROLE_GRAMMAR = (("C", ()), ("C", ("P", "T")), ("P", ()), ("P", ("s",)), ("T", ("u", "a")), ("T", ("T", "u", "a")))
#: Edits of a turn; a truncated turn that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Roles that may be given or inserted.
GIVEN = {"u": "user", "a": "assistant"}
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}
#: Conversations beyond these are parsed in parts; bytes of a piece of repaired text.
LONG_ROWS, LONG_CHARS, PIECE = 10_000, 2_000_000, 1_000_000


class Grammar:
    """LR(0) automaton of a grammar whose parse stacks are finitely many (left recursion only)."""

    def __init__(self, rules=ROLE_GRAMMAR, limit: int = 64):
        self.rules = (("^", (rules[0][0],)), *rules)
        heads = {h for h, _ in rules}
        self.states: list[frozenset] = []
        self.goto: list[dict] = []
        ids: dict[frozenset, int] = {}

        def state(kernel):
            items, todo = set(kernel), list(kernel)
            while todo:
                r, dot = todo.pop()
                body = self.rules[r][1]
                if dot < len(body) and body[dot] in heads:
                    new = {(k, 0) for k, (h, _) in enumerate(self.rules) if h == body[dot]} - items
                    items |= new
                    todo += new
            key = frozenset(items)
            if key not in ids:
                ids[key] = len(self.states)
                self.states.append(key)
                self.goto.append({})
                for x in sorted({self.rules[r][1][dot] for r, dot in key if dot < len(self.rules[r][1])}):
                    self.goto[ids[key]][x] = state({(r, dot + 1) for r, dot in key if dot < len(self.rules[r][1]) and self.rules[r][1][dot] == x})
            return ids[key]

        state({(0, 0)})
        terminals = sorted({x for _, body in rules for x in body} - heads)
        # All stacks behind a shift, found from the empty one; a state that can only reduce is reduced at once.
        self.stacks, self.shift, k = [(0,)], [], 0
        while k < len(self.stacks):
            row = {}
            for t in terminals:
                after = {self._forced((*s, self.goto[s[-1]][t])) for s in self._reductions(self.stacks[k]) if t in self.goto[s[-1]]}
                for s in after:
                    if s not in self.stacks:
                        self.stacks.append(s)
                row[t] = tuple(sorted(self.stacks.index(s) for s in after))
            self.shift.append(row)
            k += 1
            if len(self.stacks) > limit:
                raise ValueError("the grammar's stacks are not finitely many")
        if len({s[-1] for s in self.stacks}) < len(self.stacks):
            raise ValueError("different stacks share a top")
        done = frozenset({(0, 1)})
        self.accepts = [any(self.states[s[-1]] == done for s in self._reductions(x)) for x in self.stacks]

    def _reduce(self, stack, r):
        head, body = self.rules[r]
        base = stack[:len(stack) - len(body)]
        return (*base, self.goto[base[-1]][head])

    def _complete(self, state):
        return [r for r, dot in self.states[state] if r and dot == len(self.rules[r][1])]

    def _reductions(self, stack):
        """The stack and all that reductions make of it."""
        seen, todo = {stack}, [stack]
        while todo:
            s = todo.pop()
            new = {self._reduce(s, r) for r in self._complete(s[-1])} - seen
            seen |= new
            todo += new
        return seen

    def _forced(self, stack):
        while len(self.states[stack[-1]]) == 1 and self._complete(stack[-1]):
            stack = self._reduce(stack, self._complete(stack[-1])[0])
        return stack


class Repair:
    """Levels of the graph-structured stack: tuples of (stack, relative cost, audit rank)."""

    def __init__(self, rules=ROLE_GRAMMAR):
        self.grammar = Grammar(rules)
        n = len(self.grammar.stacks)
        # Insertions from each stack: (inserted initials, stack), fewest first.
        self.inserts = []
        for k in range(n):
            found, edge = [("", k)], [("", k)]
            for _ in range(n):
                edge = [(w + t, s) for w, q in edge for t in GIVEN for s in self.grammar.shift[q].get(t, ())]
                found += edge
            self.inserts.append(found)
        self.step = functools.lru_cache(maxsize=1 << 16)(self._step)

    def _step(self, level, kind: int):
        """Next level, the cost that all its entries share, and per stack the entry it comes from
        with the inserted initials, the edit and the turn's initial. `kind`: see `kinds`."""
        initial, must_go, truncated = kind >> 2, kind & 2, TRUNCATED * (kind & 1)
        best: dict = {}
        for q, cost, rank in level:
            for word, s in self.inserts[q]:
                paid = cost + INSERT * len(word)
                moves = [(s, paid + DELETE, "D", "")]
                if not must_go:
                    if initial < len(INITIALS):
                        moves += [(x, paid + truncated, "K", INITIALS[initial]) for x in self.grammar.shift[s].get(INITIALS[initial], ())]
                    moves += [(x, paid + REROLE + truncated, "R", t) for t in GIVEN for x in self.grammar.shift[s].get(t, ())]
                for x, c, edit, t in moves:
                    # Audits on a level end with an edit of the same turn: none is the beginning of another.
                    new = (c, rank, "I" * len(word) + edit)
                    if x not in best or new < best[x][0]:
                        best[x] = (new, (q, word, edit, t))
        least = min(v[0][0] for v in best.values())
        order = {x: k for k, (_, x) in enumerate(sorted(((v[0][1], v[0][2]), x) for x, v in best.items()))}
        return tuple((x, best[x][0][0] - least, order[x]) for x in sorted(best)), least, {x: v[1] for x, v in best.items()}

    def finish(self, level):
        """(Cost, stack, initials inserted at the end) of the best accepted end."""
        ends = [(cost + INSERT * len(w), rank, "I" * len(w), q, w) for q, cost, rank in level for w, s in self.inserts[q] if self.grammar.accepts[s]]
        cost, _, _, q, word = min(ends)
        return cost, q, word

    def forward(self, kinds, start: int = 0):
        level, total, backs = ((start, 0, 0),), 0, []
        for k in kinds:
            level, paid, back = self.step(level, k)
            total += paid
            backs.append(back)
        return level, total, backs

    @staticmethod
    def backward(backs, stack: int):
        out = []
        for back in reversed(backs):
            stack, word, edit, t = back[stack]
            out.append((word, edit, t))
        return out[::-1]


@functools.lru_cache(maxsize=1)
def _repair() -> Repair:
    return Repair()


def repair_lines(edits, last: str, roles, texts):
    """Audit and lines (role:text) of edited turns and the initials inserted at the end."""
    audit, lines = [], []
    for (word, edit, t), role, text in zip(edits, roles, texts):
        audit.append("I" * len(word) + edit)
        lines += [GIVEN[w] + ":" for w in word]
        if edit != "D":
            lines.append((role if edit == "K" else GIVEN[t]) + ":" + text)
    audit.append("I" * len(last))
    return "".join(audit), lines + [GIVEN[w] + ":" for w in last]


def kinds(initials, blank, duplicate, truncated):
    return [i << 2 | 2 * (b or d) | t for i, b, d, t in zip(initials, blank, duplicate, truncated)]


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text, and alive (false for dropped rows).
    Nulls of role and text are a space, as are those of conv_id and turn in the key."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    c = c.withColumn("fault", (F.crc32(key.cast("binary")) % 20).cast("int"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    c = c.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                 (F.col("fault") != 0).alias("alive"), F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return c.drop("copy")


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_ROW = "pid int, pos bigint, conv_id bigint, turn bigint, role string, text string, alive boolean, is_blank boolean, cut boolean, initial int, first string"
_DONE = ", ".join(f"{c} bigint" for c in RESULT) + ", audit string, repaired_sha256 string"
_PIECE = "conv_id bigint, pos bigint, low bigint, high bigint, turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, piece string"
_END = f"conv_id bigint, {_DONE}"


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _counts(rows, dup, before):
    """Faults and illegal neighbours of rows in order; `before`: first character of the role ahead of them, if any."""
    b = d = t = ill = 0
    for r, is_dup in zip(rows, dup):
        if r["is_blank"]:
            b += 1
        elif is_dup:
            d += 1
        elif r["cut"]:
            t += 1
        ill += before is not None and before + r["first"] not in LEGAL
        before = r["first"]
    return b, d, t, ill


def _turns(rows):
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    return (turns[0], turns[-1], 1 + sum(x != y for x, y in zip(turns, turns[1:]))) if turns else (None, None, 0)


def _whole(rows) -> dict:
    """Result of a conversation whose rows are all here."""
    rows = [r for r in rows if r["alive"]]
    seen: set = set()
    dup = []
    for r in rows:
        key = (r["role"], r["text"])
        dup.append(key in seen)
        seen.add(key)
    rep = _repair()
    level, total, backs = rep.forward(kinds((r["initial"] for r in rows), (r["is_blank"] for r in rows), dup, (r["cut"] for r in rows)))
    cost, stack, last = rep.finish(level)
    audit, lines = repair_lines(rep.backward(backs, stack), last, [r["role"] for r in rows], [r["text"] for r in rows])
    low, high, n = _turns(rows)
    out = dict(zip(RESULT, (high - low + 1 - n if n else 0, *_counts(rows, dup, None), total + cost)))
    return out | {"audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def _parse_whole(batches):
    """Conversations that begin and end inside this partition and are not long give their result;
    the rows of the others are handed on."""
    schema = _arrow(f"{_ROW}, {_DONE}")
    held, chars, raw, key, out = [], 0, True, None, []

    def pack():
        rows, out[:] = list(out), []
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    for b in batches:
        for r in b.to_pylist():
            if key is None or r["conv_id"] != key[0]:
                if held:
                    out.append({"conv_id": key[0]} | _whole(held))
                raw, held, chars = key is None, [], 0  # the partition's first may have begun before it
                key = (r["conv_id"],)
            if raw:
                out.append(r)
                continue
            held.append(r)
            chars += len(r["text"])
            if chars > LONG_CHARS or len(held) > LONG_ROWS:
                out += held
                raw, held = True, []
        if out:
            yield pack()
    out += held  # the last may go on in the next partition
    if out:
        yield pack()


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Least cost and audit rank of a part from each stack to each other."""
    pdf = pdf.sort_values("pos")
    rep, live = _repair(), pdf[pdf["alive"]]
    n = len(rep.grammar.stacks)
    ks = kinds(live["initial"].astype(int), live["is_blank"], live["dup"], live["cut"])
    cost, rank = [-1] * (n * n), [-1] * (n * n)
    for start in range(n):
        level, total, _ = rep.forward(ks, start)
        for q, c, r in level:
            cost[start * n + q], rank[start * n + q] = c + total, r
    turns = live["turn"].dropna()
    return pd.DataFrame({"pid": [pdf["pid"].iloc[0]], "conv_id": [pdf["conv_id"].iloc[0]], "rows": [len(live)], "cost": [cost], "rank": [rank],
                         "last_first": [live["first"].iloc[-1] if len(live) else None], "last_turn": pd.array([turns.iloc[-1] if len(turns) else None], "Int64")})


def _composed(parts: list) -> dict:
    """Per part (pid, conv_id): its first and last stack, initials inserted at its end, the first
    character of the role and the turn before it. `parts`: summaries by conversation and partition."""
    rep = _repair()
    n = len(rep.grammar.stacks)
    out: dict = {}

    def close(run):
        vectors, comes = [{0: (0, 0)}], []
        for p in run:
            best = {}
            for q, (c, r) in vectors[-1].items():
                for x in range(n):
                    if p["cost"][q * n + x] >= 0:
                        new = (c + p["cost"][q * n + x], r, p["rank"][q * n + x], q)
                        best[x] = min(best.get(x, new), new)
            order = {x: k for k, x in enumerate(sorted(best, key=lambda x: best[x][1:3]))}
            vectors.append({x: (v[0], order[x]) for x, v in best.items()})
            comes.append({x: v[3] for x, v in best.items()})
        _, stack, word = rep.finish(tuple((q, c, r) for q, (c, r) in vectors[-1].items()))
        ends = [stack]
        for back in reversed(comes):
            ends.append(back[ends[-1]])
        ends.reverse()
        role = turn = None
        for k, p in enumerate(run):
            out[p["pid"], p["conv_id"]] = (ends[k], ends[k + 1], word if k == len(run) - 1 else "", role, turn)
            role, turn = (p["last_first"], p["last_turn"] if p["last_turn"] is not None else turn) if p["rows"] else (role, turn)

    run: list = []
    for p in parts:
        if run and run[-1]["conv_id"] != p["conv_id"]:
            close(run)
            run = []
        run.append(p)
    if run:
        close(run)
    return out


def _parse_part(ends):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rep = _repair()
        conv = pdf["conv_id"].iloc[0]
        pid, conv = int(pdf["pid"].iloc[0]), None if pd.isna(conv) else int(conv)
        start, end, last, before, turn = ends.value[pid, conv]
        pdf = pdf.sort_values("pos")
        pos = int(pdf["pos"].iloc[0])
        live = pdf[pdf["alive"]]
        rows = [dict(zip(("is_blank", "cut", "first", "turn"), r)) for r in zip(live["is_blank"], live["cut"], live["first"], (None if pd.isna(t) else int(t) for t in live["turn"]))]
        ks = kinds(live["initial"].astype(int), live["is_blank"], live["dup"], live["cut"])
        level, total, backs = rep.forward(ks, start)
        cost = total + next(c for q, c, _ in level if q == end) + INSERT * len(last)
        audit, lines = repair_lines(rep.backward(backs, end), last, live["role"], live["text"])
        low, high, n = _turns(rows)
        b, d, t, ill = _counts(rows, live["dup"], before)
        out, text, size = [], [], 0
        for line in lines:
            text.append("\n" + line)
            size += len(line)
            if size > PIECE:
                out.append("".join(text))
                text, size = [], 0
        out.append("".join(text))
        first = [(conv, pos, low, high, n - (n > 0 and low == turn), b, d, t, ill, cost, audit, out[0])]
        rest = [(conv, pos + k, None, None, 0, 0, 0, 0, 0, 0, "", x) for k, x in enumerate(out[1:], 1)]
        return pd.DataFrame(first + rest, columns=_names(_PIECE)).astype({c: "Int64" for c in ("conv_id", "low", "high")})
    return run


def _fold_pieces(batches):
    """One row per conversation from its pieces in order; a digest is the only thing that must see them all."""
    names = _names(_END)
    key, sha, sums, audit, fresh, low, high = None, None, None, [], True, None, None

    def row():
        gaps = high - low + 1 - sums[0] if low is not None else 0
        return dict(zip(names, (key[0], gaps, *sums[1:], "".join(audit), sha.hexdigest())))

    def pack(rows):
        return pa.RecordBatch.from_pylist(rows, schema=_arrow(_END))

    for b in batches:
        done = []
        for r in b.to_pylist():
            if key is None or key[0] != r["conv_id"]:
                if key is not None:
                    done.append(row())
                key, sha, sums, audit, fresh, low, high = (r["conv_id"],), hashlib.sha256(), [0] * 6, [], True, None, None
            low, high = r["low"] if low is None else low, high if r["high"] is None else r["high"]
            sums = [x + r[c] for x, c in zip(sums, ("turns", "blank", "duplicate", "truncated", "illegal", "cost"))]
            audit.append(r["audit"])
            if r["piece"]:
                sha.update(r["piece"][1 if fresh else 0:].encode())
                fresh = False
        if done:
            yield pack(done)
    if key is not None:
        yield pack([row()])


def repair_conversations(damaged: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `damaged`: conv_id, turn, role, text without nulls in role and text, and alive; rows that are
    not alive only name their conversation. Turns are read by turn, nulls first; ties by role and
    text. A role's initial decides; an empty role has none and cannot be kept. A null conv_id is
    one conversation. An empty table gives no rows."""
    spark = damaged.sparkSession
    end = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    first = F.substring("role", 1, 1)
    rows = damaged.select("conv_id", "turn", "role", "text", "alive", (end == "").alias("is_blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"),
                          (F.when(first == "", 3).when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)).cast("int").alias("initial"), first.alias("first"))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    placed = rows.withColumn("_n", F.monotonically_increasing_id())  # parts equal rows
    placed = placed.repartitionByRange(salts(spark), *order, F.asc("_n")).sortWithinPartitions(*order, F.asc("_n")).drop("_n")
    placed = placed.select(F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("pos"), *rows.columns)
    parsed = materialise(placed.select(*_names(_ROW)).mapInArrow(_parse_whole, f"{_ROW}, {_DONE}"), "parsed")
    whole = parsed.where("repaired_sha256 is not null").select(*_names(_END))
    loose = parsed.where("repaired_sha256 is null").select(*_names(_ROW))

    # Repeated turns of conversations in parts: those behind the first of their kind.
    same = F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)
    thin = materialise(loose.select("pid", "pos", F.coalesce("conv_id", F.lit(0)).alias("_c"), F.col("conv_id").isNull().alias("_null"), "alive", same.alias("same")), "thin")
    keys = ["_c", "_null", "same"]
    firsts = materialise(thin.where("alive").groupBy(*keys).agg(F.min("pos").alias("low"), F.count(F.lit(1)).alias("_w")), "firsts")
    dups = skew_join(thin.where("alive"), firsts, keys, "_w", "pos", thin.count()).where("pos > low").select("pos", F.lit(True).alias("dup"))
    parts = materialise(loose.join(dups, "pos", "left").withColumn("dup", F.coalesce("dup", F.lit(False))), "parts")

    sums = parts.select("pid", "pos", "conv_id", "turn", "alive", "is_blank", "cut", "initial", "first", "dup").groupBy("pid", "conv_id").applyInPandas(
        _summed, "pid int, conv_id bigint, rows bigint, cost array<bigint>, rank array<bigint>, last_first string, last_turn bigint")
    # Two summaries per range partition, and one per long conversation in it: as many as there are partitions, not rows.
    rows_ = sorted((r.asDict() for r in sums.collect()), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["pid"]))
    ends = spark.sparkContext.broadcast(_composed(rows_))
    pieces = parts.groupBy("pid", "conv_id").applyInPandas(_parse_part(ends), _PIECE)
    pieces = pieces.repartition(salts(spark), "conv_id").sortWithinPartitions("conv_id", "pos")
    return whole.unionByName(pieces.mapInArrow(_fold_pieces, _END))


def op13_chat_repair(spark, sf_dir):
    """Every conversation after damage, repaired; edge cases as in `repair_conversations`."""
    from .common import table

    return repair_conversations(damage(table(spark, sf_dir, "conversations")))
