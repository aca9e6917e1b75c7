"""Conversation structure repair: the cheapest edits that make a well-formed dialogue, with a least audit.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles.  Rows are kept (free), given another role
(``Rerole``, 2) or deleted (3; blank and duplicate rows must be); rows without text are inserted (2); a truncated row
that stays costs 1.  An audit has one letter an edit, K, R, D or I, in order; among the cheapest, the ASCII-least
is taken.  With the rows, it determines the repaired text.

**Persistent audits.**  The dynamic program keeps, for each state (nothing yet, after s, after u, after a), its
cost and the last edit of its audit: a node linked to the audit's prefix, which all audits that begin alike
share.  A node holds its length, its letter, its ancestors 1, 2, 4, .. edits before (binary lifting) and a rolling
hash of the whole audit.  Equal costs are settled by a search for the longest common prefix: cut both to one length,
then skip back together while the hashes differ, and compare the letters that follow.  Where hashes are equal but
nodes are not, the letters are compared back to the node that both share, so a collision changes no result.

**Long conversations** are cut into chunks of ``CHUNK`` rows.  A chunk is solved from each of the states it may be
entered in.  Their costs and audits are then chained, one row a chunk, in a pass that holds only the chunks on
which the states' best ways still differ; ways that cannot win are dropped (:func:`_viable`).  Audits of equal
cost over the same rows are never prefixes of each other, so the least of a whole is made of the least of its parts.
Rows are numbered and duplicates found by shuffles of their own, not per conversation in one task.  Only the digest
of the repaired text reads a conversation in order in one task, row by row, as SHA-256 must.

Defined cases: nulls count as one space (a null text is blank, a null role has no place in a dialogue, a null
conversation is one of its own); rows of one turn are ordered by role and text; a conversation without rows has zero
counts, an empty audit and the digest of nothing; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ticklake.llm.common import by_batch, written
from ticklake.llm.manifest import numbered

CHUNK = 1024
START, SYSTEM, USER, ASSISTANT = range(4)
FREE, BLANK, DUPLICATE, TRUNCATED = range(4)
MODULUS, BASE = (1 << 61) - 1, 1_000_003
# White space, and the marks that end a sentence.
SPACE, ENDS = r"[\x20\x09-\x0D]", "[.!?]"


class Audits:
    """Audits as linked nodes; node ``root()`` is an empty audit."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus
        self.letter, self.length, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]

    def root(self) -> int:
        return 0

    def add(self, node: int, letter: str) -> int:
        new, up, k = len(self.letter), [node], 0
        while k < len(self.up[up[k]]):  # the ancestor 2 ** (k + 1) before is 2 ** k before the one 2 ** k before
            up.append(self.up[up[k]][k])
            k += 1
        self.letter.append(letter)
        self.length.append(self.length[node] + 1)
        self.hash.append((self.hash[node] * BASE + ord(letter)) % self.modulus)
        self.up.append(up)
        return new

    def prefix(self, node: int, length: int) -> int:
        """The node of the audit's first ``length`` letters."""
        while self.length[node] > length:
            up = self.up[node]
            node = up[min((self.length[node] - length).bit_length(), len(up)) - 1]
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are equal: by hash, then letter by letter to the node that both share."""
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def before(self, a: int, b: int) -> bool:
        """Whether audit a is ASCII-less than audit b."""
        short = min(self.length[a], self.length[b])
        x, y = self.prefix(a, short), self.prefix(b, short)
        if self._same(x, y):
            return self.length[a] < self.length[b]
        while True:  # back to the first place where they differ
            for k in reversed(range(len(self.up[x]))):
                if not self._same(self.up[x][k], self.up[y][k]):
                    x, y = self.up[x][k], self.up[y][k]
                    break
            else:
                return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        out = []
        while self.length[node]:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


#: States that a row with a given initial (or any row given the role) leads to.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}


def solve(rows: list[tuple[str, int]], entry: int, modulus: int = MODULUS) -> list[tuple[int, str] | None]:
    """For each state at the end: the cost and the least audit of (initial, fault) rows entered in ``entry``."""
    audits = Audits(modulus)
    best: list[tuple[int, int] | None] = [None] * 4

    def offer(states, state: int, cost: int, node: int, letter: str) -> None:
        held = states[state]
        if held is None or cost < held[0]:
            states[state] = cost, audits.add(node, letter)
        elif cost == held[0]:
            new = audits.add(node, letter)
            if audits.before(new, held[1]):
                states[state] = cost, new

    def inserted(states) -> None:
        # u, a, u once more: a round of inserts returns to its state at a greater cost
        for source in (START, SYSTEM, ASSISTANT, USER, ASSISTANT):
            if states[source] is not None:
                for target in NEXT[source].values():
                    if target != SYSTEM:
                        offer(states, target, states[source][0] + 2, states[source][1], "I")

    best[entry] = 0, audits.root()
    inserted(best)
    for initial, fault in rows:
        after: list[tuple[int, int] | None] = [None] * 4
        for state, held in enumerate(best):
            if held is None:
                continue
            cost, node = held
            offer(after, state, cost + 3, node, "D")
            if fault in (BLANK, DUPLICATE):
                continue
            more = int(fault == TRUNCATED)
            for role, target in NEXT[state].items():
                if role == initial:
                    offer(after, target, cost + more, node, "K")
                if role != "s":
                    offer(after, target, cost + 2 + more, node, "R")
        inserted(after)
        best = after
    return [held and (held[0], audits.text(held[1])) for held in best]


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) after the damage that each row's hash asks for; nulls of role and text are one space."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn)).cast("binary")) % 20
    told = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), shown(role).alias("role"), shown(text).alias("text"), kind.alias("kind"))
    changed = told.where("kind <> 0").select(
        "conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"))
    return changed.select("conv", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def faulted(rows: DataFrame) -> DataFrame:
    """Add ``idx`` (place in the conversation), ``initial`` and ``fault`` (the first that counts); writes the rows."""
    placed = numbered(rows, "conv", ["turn", "role", "text"], "conversation-rows").withColumn("same", F.sha2(F.concat("role", F.lit("\0"), "text"), 256))
    first = placed.groupBy("conv", "same").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    first = written(first.select(F.col("conv").alias("_conv"), F.col("same").alias("_same"), "first"), "conversation-repeats")
    joined = placed.join(first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same")), "left")
    inside = F.regexp_replace("text", f"{SPACE}+\\z", "")
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(BLANK)).when(F.col("idx") > F.col("first"), F.lit(DUPLICATE)) \
        .when(~F.substring(inside, -1, 1).rlike(ENDS), F.lit(TRUNCATED)).otherwise(F.lit(FREE))
    return written(joined.select("conv", "idx", "n", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")),
                   "conversation-faults")


WAY = "array<struct<entry:int,exit:int,cost:bigint,audit:string>>"
KINDS = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def solved(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv, chunk, last, ways): of each chunk, the cost and the audit from every entry to every state after it."""
    cut = rows.withColumn("chunk", F.expr(f"idx div {chunk}")).groupBy("conv", "chunk", F.expr(f"(n - 1) div {chunk}").alias("last")) \
        .agg(F.array_sort(F.collect_list(F.struct("idx", "initial", "fault"))).alias("rows"))

    def make():
        def step(columns):
            ways = []
            for number, cell in zip(columns[1].to_pylist(), columns[3]):
                rows_ = [(r["initial"], r["fault"]) for r in cell.as_py()]
                entries = (START, SYSTEM, USER, ASSISTANT) if number else (START,)
                ways.append([{"entry": e, "exit": s, "cost": held[0], "audit": held[1]}
                             for e in entries for s, held in enumerate(solve(rows_, e)) if held])
            return {"conv": columns[0], "chunk": columns[1], "last": columns[2], "ways": pa.array(ways, type=KINDS)}

        return step

    kind = dict(cut.dtypes)["conv"]
    return by_batch(cut.select("conv", "chunk", "last", "rows"), make, f"conv {kind}, chunk bigint, last bigint, ways {WAY}")


def _viable(states: dict[int, tuple]) -> dict[int, tuple]:
    """Without the states from which no continuation can be the best any more.

    After a, one can go on as after s; and as from the start, deleting the s row that the start may keep (3 at most).
    """
    if ASSISTANT in states:
        least = states[ASSISTANT][0]
        for state, more in ((SYSTEM, 0), (START, 3)):
            if state in states and states[state][0] > least + more:
                states = {s: v for s, v in states.items() if s != state}
    return states


class Chain:
    """Chains the chunks of one conversation in order; gives (chunk, entry, audit) as soon as it is certain.

    ``states``: cost of each state's best way.  ``pending``: of each chunk not given yet, its entry state and audit by
    the state after it.  Ties compare the audits from the first pending chunk on, before which all ways are one.
    """

    def __init__(self):
        self.states: dict[int, tuple] = {START: (0,)}
        self.pending: list[tuple[int, dict[int, tuple[int, str]]]] = []
        self.cost = 0

    def _way(self, state: int) -> list[str]:
        out = []
        for _, ways in reversed(self.pending):
            state, audit = ways[state]
            out.append(audit)
        return out[::-1]

    def _less(self, a: tuple[int, str], b: tuple[int, str]) -> bool:
        return "".join([*self._way(a[0]), a[1]]) < "".join([*self._way(b[0]), b[1]])

    def add(self, chunk: int, ways: list[dict]):
        after, came = {}, {}
        for way in ways:
            if way["entry"] not in self.states:
                continue
            cost, end, step = self.states[way["entry"]][0] + way["cost"], way["exit"], (way["entry"], way["audit"])
            if end not in after or cost < after[end][0] or cost == after[end][0] and self._less(step, came[end]):
                after[end], came[end] = (cost,), step
        self.states = _viable(after)
        self.pending.append((chunk, {s: came[s] for s in self.states}))
        # ways that all come through one state of an earlier chunk are one up to there
        alive, certain = set(self.states), None
        for k in reversed(range(len(self.pending))):
            if len(alive) == 1:
                certain = k, alive
                break
            alive = {self.pending[k][1][s][0] for s in alive}
        if certain is not None and certain[0] < len(self.pending) - 1:
            yield from self._given(certain[0] + 1, next(iter(certain[1])))

    def _given(self, count: int, state: int):
        out = []
        for chunk, ways in reversed(self.pending[:count]):
            entry, audit = ways[state]
            out.append((chunk, entry, audit))
            state = entry
        del self.pending[:count]
        yield from reversed(out)

    def end(self):
        """The rest, through the better of the two states in which a conversation may end."""
        final = min((s for s in (START, ASSISTANT) if s in self.states),
                    key=lambda s: (self.states[s][0], "".join(self._way(s))))
        self.cost = self.states[final][0]
        yield from self._given(len(self.pending), final)


def chained(ways: DataFrame) -> DataFrame:
    """(conv, chunk, entry, audit, cost): every chunk's part of its conversation's audit; the last one has the cost."""
    kind = dict(ways.dtypes)["conv"]

    def make():
        state = {"chain": None}

        def step(columns):
            out = []
            for conv, chunk, last, ways_ in zip(*(c.to_pylist() for c in columns)):
                if chunk == 0:
                    state["chain"] = Chain()
                out += [(conv, *given, None) for given in state["chain"].add(chunk, ways_)]
                if chunk == last:
                    out += [(conv, *given, None) for given in state["chain"].end()]
                    out[-1] = (*out[-1][:4], state["chain"].cost)
            if out:
                conv, chunk, entry, audit, cost = zip(*out)
                return {"conv": pa.array(conv, type=columns[0].type), "chunk": pa.array(chunk, type=pa.int64()), "entry": pa.array(entry, type=pa.int32()),
                        "audit": pa.array(audit, type=pa.string()), "cost": pa.array(cost, type=pa.int64())}

        return step

    return by_batch(ways.repartition("conv").sortWithinPartitions("conv", "chunk").select("conv", "chunk", "last", "ways"), make,
                    f"conv {kind}, chunk bigint, entry int, audit string, cost bigint")


class Editor:
    """Applies the audits of chunks to their rows as they go by."""

    def __init__(self):
        self.audit, self.at, self.state, self.left = "", 0, START, 0

    def begin(self, audit: str, state: int) -> None:
        self.audit, self.at, self.state, self.left = audit, 0, state, len(audit) - audit.count("I")

    def _out(self, role: str, text: str) -> tuple[str, str]:
        self.state = NEXT[self.state][role[:1]]
        return role, text

    def _wanted(self) -> str:
        return "assistant" if self.state == USER else "user"

    def _inserted(self):
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._out(self._wanted(), "")

    def row(self, role: str, text: str):
        """What comes out for a row: rows inserted before it, itself if it stays, and after a chunk's last row the inserted rest."""
        yield from self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        self.left -= 1
        if letter != "D":
            yield self._out(role if letter == "K" else self._wanted(), text)
        if not self.left:
            yield from self._inserted()


def repaired(rows: DataFrame, audits: DataFrame, chunk: int = CHUNK, by: tuple[str, ...] = ("conv", "chunk")) -> DataFrame:
    """(conv, chunk, role, text): the repaired rows, in order of conversation, chunk and place within each partition.

    The rows are shuffled once, by ``by``; each chunk's audit goes before its rows, which are edited one after the other.
    """
    kind = dict(rows.dtypes)["conv"]
    lines = rows.select("conv", F.expr(f"idx div {chunk}").alias("chunk"), F.col("idx").alias("at"), F.lit(None).cast("int").alias("entry"),
                        F.lit(None).cast("string").alias("audit"), "role", "text")
    heads = audits.select("conv", "chunk", F.lit(-1).cast("bigint").alias("at"), "entry", "audit", F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("string").alias("text"))
    both = lines.unionByName(heads).repartition(*by).sortWithinPartitions("conv", "chunk", "at")

    def make():
        editor = Editor()

        def step(columns):
            out = []
            for conv, number, at, entry, audit, role, text in zip(*(c.to_pylist() for c in columns)):
                if at < 0:
                    editor.begin(audit, entry)
                else:
                    out += [(conv, number, *x) for x in editor.row(role, text)]
            if out:
                convs, numbers, roles, texts = zip(*out)
                return {"conv": pa.array(convs, type=columns[0].type), "chunk": pa.array(numbers, type=pa.int64()),
                        "role": pa.array(roles, type=pa.string()), "text": pa.array(texts, type=pa.string())}

        return step

    return by_batch(both, make, f"conv {kind}, chunk bigint, role string, text string")


def digests(rows: DataFrame) -> DataFrame:
    """(conv, sha256) of ``role:text`` lines of repaired rows, whose partitions hold whole conversations in order; a
    conversation goes by row by row."""
    kind = dict(rows.dtypes)["conv"]

    def make():
        state = {"conv": None, "hash": None}

        def step(columns):
            out = []
            if columns is not None:
                convs, roles, texts = (c.to_pylist() for c in columns)
                for conv, role, text in zip(convs, roles, texts):
                    if state["hash"] is None or conv != state["conv"]:
                        if state["hash"] is not None:
                            out.append((state["conv"], state["hash"].hexdigest()))
                        state.update(conv=conv, hash=hashlib.sha256(f"{role}:{text}".encode()), kind=columns[0].type)
                    else:
                        state["hash"].update(f"\n{role}:{text}".encode())
            elif state["hash"] is not None:
                out.append((state["conv"], state["hash"].hexdigest()))
            if out:
                return {"conv": pa.array([c for c, _ in out], type=state["kind"]), "sha256": pa.array([x for _, x in out], type=pa.string())}

        return step

    return by_batch(rows.select("conv", "role", "text"), make,
                    f"conv {kind}, sha256 string", finish=True)


def counts(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal) of the numbered rows of each conversation."""
    inside = Window.partitionBy("conv", F.expr(f"idx div {chunk}")).orderBy("idx")
    pairs = rows.select("conv", "idx", "fault", "turn", "initial", F.lag("initial").over(inside).alias("_before"))
    # a chunk's first row meets the last one of the chunk before
    ends = rows.where(f"idx % {chunk} = {chunk - 1}").select(F.col("conv").alias("_conv"), (F.col("idx") + 1).alias("_next"), F.col("initial").alias("_end"))
    pairs = pairs.join(ends, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("idx") == F.col("_next")), "left")
    pair = F.concat(F.coalesce("_before", "_end"), F.col("initial"))
    legal = pair.isin("su", "ua", "au")
    summed = pairs.groupBy("conv", "turn").agg(
        *(F.sum((F.col("fault") == k).cast("bigint")).alias(name) for k, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))),
        F.sum((pair.isNotNull() & ~legal).cast("bigint")).alias("illegal"))
    return summed.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = True,
           chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """What was found and done in every conversation (conv_id, gaps .. illegal, cost, audit, repaired_sha256), and the
    repaired rows (conv, chunk, role, text), in order within each partition."""
    plain = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                                 F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    rows = faulted(damaged(conversations, conv, turn, role, text) if damage else plain)
    parts = written(chained(written(solved(rows, chunk), "conversation-ways")), "conversation-audits")
    fixed = repaired(rows, parts, chunk, by=("conv",))
    whole = parts.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda p: p["audit"]), "").alias("audit"),
                                      F.max("cost").alias("cost"))
    ids = conversations.select(F.col(conv).alias("conv_id")).distinct()
    for found, name in ((counts(rows, chunk), "_counts"), (whole, "_audits"), (digests(fixed), "_digests")):
        ids = ids.join(found.withColumnRenamed("conv", name), F.col("conv_id").eqNullSafe(F.col(name)), "left").drop(name)
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")), fixed
