"""Cheapest repair of a conversation's turn structure: min-plus matrices over a grammar of role and fault sequences.

After the optional ``system`` turn, turns have to alternate user, assistant, to an assistant's end. A row's role initial and
first fault make one symbol; a conversation is a string of symbols. Re-Pair rounds over the distinct strings of
the whole table name frequent pairs; every symbol and rule has one 4 x 4 matrix: the cheapest cost from each state to
each other, and the rope of edit initials that reaches it. A rule's matrix is the product of its two parts, its
ropes point into theirs. A conversation is the product of the few matrices of its compressed string, remembered for
all conversations with that string.

Among equal costs the ASCII-least audit is kept. That is safe part by part: two audits of the same rows and the same cost
are never one the other's beginning, since a further insertion would cost more.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import cell, map_batches, materialise
from zoneflow.operators.places import with_places

# Rows whose symbols make one string; a longer conversation is several, one after the other.
CHUNK_ROWS = 4096
# Bounds of the grammar: what it does not name is multiplied out symbol by symbol, with the same result.
ROUNDS, RULES_PER_ROUND = 8, 32
# Compressed strings whose matrices a worker process remembers.
REMEMBERED = 50_000
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# A symbol is the letter at 4 * role + fault.
SYMBOLS = "ABCDEFGHIJKLMNOP"
ROLES, FAULTS = "sua-", ("none", "blank", "duplicate", "truncated")
FIRST_RULE = 0xE000

# A rope is a text or a pair of ropes; an entry of a matrix is (cost, rope) or None.
Rope = str | tuple
Matrix = tuple


def _leaves(rope: Rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        r = stack.pop()
        if isinstance(r, str):
            yield r
        else:
            stack += (r[1], r[0])


def flat(rope: Rope) -> str:
    return "".join(_leaves(rope))


def less(a: Rope, b: Rope) -> bool:
    """Order of the texts of two ropes; parts that both share are skipped, not read."""
    x, y, s, t = [a], [b], "", ""
    while True:
        while not s and x:
            if not t and y and x[-1] is y[-1]:
                x.pop(), y.pop()
                continue
            r = x.pop()
            if isinstance(r, str):
                s = r
            else:
                x += (r[1], r[0])
        while not t and y:
            r = y.pop()
            if isinstance(r, str):
                t = r
            else:
                y += (r[1], r[0])
        if not s or not t:
            return not s and bool(t)
        n = min(len(s), len(t))
        if s[:n] != t[:n]:
            return s[:n] < t[:n]
        s, t = s[n:], t[n:]


def better(new, old):
    if old is None or new is None:
        return new if old is None else old
    return new if new[0] < old[0] or (new[0] == old[0] and less(new[1], old[1])) else old


def join(a, b):
    """One entry after the other."""
    if a is None or b is None:
        return None
    left, right = a[1], b[1]
    return a[0] + b[0], left if right == "" else right if left == "" else (left, right)


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(reduce(better, (join(a[i][k], b[k][j]) for k in STATES)) for j in STATES) for i in STATES)


def _matrix(entries: dict) -> Matrix:
    return tuple(tuple(entries.get((i, j)) for j in STATES) for i in STATES)


def _after(state: int) -> int:
    """The state that the next user or assistant turn makes."""
    return ASSISTANT if state == USER else USER


def insertions() -> Matrix:
    """No, one or more inserted turns; a way that comes back to a state is never cheapest."""
    out = {}
    for i in STATES:
        state, n = i, 0
        while (i, state) not in out:
            out[i, state] = (INSERT * n, "I" * n)
            state, n = _after(state), n + 1
    return _matrix(out)


def row_matrix(role: str, fault: str) -> Matrix:
    """One row: kept if its role fits, given the role that fits, or deleted."""
    out = {(i, i): (DELETE, "D") for i in STATES}
    extra = TRUNCATED if fault == "truncated" else 0
    if fault in ("none", "truncated"):
        for i in STATES:
            j = _after(i)
            ways = [(REROLE + extra, "R")] + [(KEEP + extra, "K")] * (role == "-sua"[j])
            out[i, j] = reduce(better, ways)
        if role == "s":
            out[START, SYSTEM] = (KEEP + extra, "K")
    return _matrix(out)


def symbol_matrices() -> dict[str, Matrix]:
    """The matrix of every symbol: insertions, then the row."""
    free = insertions()
    return {SYMBOLS[4 * r + f]: product(free, row_matrix(role, fault)) for r, role in enumerate(ROLES) for f, fault in enumerate(FAULTS)}


def rule_matrices(rules: list[tuple[str, str]]) -> dict[str, Matrix]:
    """Matrices of all symbols and rules, bottom up: a rule's is the product of its two parts, made once."""
    out = symbol_matrices()
    for new, pair in rules:
        out[new] = product(out[pair[0]], out[pair[1]])
    return out


def compress(text: str, rules: list[tuple[str, str]]) -> str:
    for new, pair in rules:
        if pair in text:
            text = text.replace(pair, new)
    return text


def evaluate(text: str, rules: list[tuple[str, str]], matrices: dict[str, Matrix]) -> Matrix:
    """The matrix of a string of symbols, multiplied as a balanced tree so that ropes stay shallow."""
    parts = [matrices[c] for c in compress(text, rules)]
    while len(parts) > 1:
        parts = [product(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def learn_rules(strings: DataFrame, rounds: int = ROUNDS, per_round: int = RULES_PER_ROUND) -> list[tuple[str, str]]:
    """Re-Pair over all distinct ``seq``: each round names the most frequent pairs of neighbours and puts the names in.

    Pairs are counted in the tasks and added up by one grouped sum; at most ``per_round`` pairs reach the driver. Ends when
    no pair occurs twice. Equal counts go by the pair itself, so the grammar does not depend on partitions.
    """
    rules: list[tuple[str, str]] = []
    current = materialise(strings.select("seq").distinct())
    for _ in range(rounds):

        def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for b in batches:
                for s in b.column(0).to_pylist():
                    seen.update(map("".join, zip(s, s[1:])))
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["pair", "n"])

        sums = map_batches(current, pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        top = sums.orderBy(F.desc("n"), "pair").limit(per_round).collect()
        if not top:
            break
        fresh = [(chr(FIRST_RULE + len(rules) + i), r["pair"]) for i, r in enumerate(top)]
        rules += fresh

        def renamed(batches: Iterator[pa.RecordBatch], fresh=fresh) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([compress(s, fresh) for s in b.column(0).to_pylist()], pa.string())], ["seq"])

        current = materialise(map_batches(current, renamed, "seq string"))
    return rules


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, tie, copy, role, text``: rows dropped, emptied, stripped of ends, repeated or given to the user.

    Which, is ``crc32("conv_id:turn") % 20``; null turn, role or text counts as one space. ``tie`` orders rows with the
    same turn: it is the digest of the row before damage.
    """
    blank = lambda name: F.coalesce(cell(name).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(cell(conv).cast("string"), F.lit(":"), blank(turn)).cast("binary")) % 20
    rows = conversations.filter(cell(conv).isNotNull()).select(
        cell(conv).cast("long").alias("conv_id"), cell(turn).cast("long").alias("turn"), what.alias("what"),
        F.sha2(F.concat(F.length(blank(role)).cast("string"), F.lit(":"), blank(role), blank(text)).cast("binary"), 256).alias("tie"),
        blank(role).alias("role"), blank(text).alias("text"),
    ).filter("what <> 0")
    w, t = F.col("what"), F.col("text")
    return rows.select(
        "conv_id", "turn", "tie",
        F.explode(F.when(w == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        F.when(w == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(w == 1, "").when(w == 2, F.regexp_replace(t, r"[.!?]", "")).otherwise(t).alias("text"),
    )


def symbol_strings(rows: DataFrame) -> DataFrame:
    """``conv_id, chunk, seq``: the rows of each conversation, in order, as strings of symbols without their texts.

    A duplicate is told by the digest of role and text against the smallest place with it, so neither a long conversation
    nor a text that fills one meets in one task.
    """
    t, role = F.col("text"), F.col("role")
    fault = F.when(~t.rlike(r"[^\x20\x09-\x0D]"), 1).when(~t.rlike(r"[.!?][\x20\x09-\x0D]*\z"), 3).otherwise(0)
    initial = F.substring(role, 1, 1)
    narrow = rows.select(
        "conv_id", "turn", "tie", "copy", F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, t).cast("binary"), 256)).alias("said"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("who"), fault.alias("fault"),
    )
    placed = with_places(narrow, ["conv_id"], [F.col("turn").asc_nulls_first(), "tie", "copy"], "pos")
    first = placed.groupBy("conv_id", "said").agg(F.min("pos").alias("pos")).select("conv_id", "pos", F.lit(True).alias("new"))
    fault = F.when(F.col("fault") == 1, 1).when(F.col("new").isNull(), 2).otherwise(F.col("fault"))
    code = F.substring(F.lit(SYMBOLS), F.col("who") * 4 + fault + 1, F.lit(1))
    marked = placed.join(first, ["conv_id", "pos"], "left").select("conv_id", F.floor(F.col("pos") / CHUNK_ROWS).alias("chunk"), "pos", code.alias("code"))
    found = marked.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("l"))
    return found.select("conv_id", "chunk", F.array_join(F.transform("l", lambda x: x["code"]), "").alias("seq"))


def faults_of(seq: str) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours whose roles cannot follow one another."""
    codes = [SYMBOLS.index(c) for c in seq]
    kinds, who = Counter(c % 4 for c in codes), "".join(ROLES[c // 4] for c in codes)
    return kinds[1], kinds[2], kinds[3], sum(who[i : i + 2] not in ("su", "ua", "au") for i in range(len(who) - 1))


def repairs(strings: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``conv_id, blank, duplicate, truncated, illegal, cost, audit`` per conversation.

    The chunks of a conversation come in order; what goes from one to the next is four costs and ropes.
    """
    matrices = rule_matrices(rules)
    names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    free = insertions()

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}

        def of(seq: str):
            if seq not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[seq] = (faults_of(seq), evaluate(seq, rules, matrices), {})
            return known[seq]

        def after(vector, m):
            return tuple(reduce(better, (join(vector[k], m[k][j]) for k in STATES)) for j in STATES)

        def end(vector):
            last = after(vector, free)
            cost, rope = better(last[START], last[ASSISTANT])
            return cost, flat(rope)

        begin = ((0, ""), None, None, None)
        conv, sums, vector, last, out = None, None, None, None, []

        def close() -> None:
            if isinstance(vector, str):  # one chunk: shared with all conversations of this string
                shared = of(vector)[2]
                if not shared:
                    shared["end"] = end(of(vector)[1][START])
                out.append((conv, *sums, *shared["end"]))
            else:
                out.append((conv, *sums, *end(vector)))

        for b in batches:
            for c, seq in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                faults, matrix, _ = of(seq)
                if c != conv:
                    if conv is not None:
                        close()
                    conv, sums, vector, last = c, faults, seq, seq[-1]
                    continue
                if isinstance(vector, str):
                    vector = after(begin, of(vector)[1])
                vector = after(vector, matrix)
                seam = faults_of(last + seq[0])[3]
                sums, last = tuple(x + y for x, y in zip(sums, faults[:3] + (faults[3] + seam,))), seq[-1]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names)
                out = []
        if conv is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names)

    ordered = strings.select("conv_id", "chunk", "seq").repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return map_batches(ordered, solved, "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def repaired_turns(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: each conversation's audit is carried out on its rows, which stream by in order.

    The digest of one conversation is sequential by nature; a task holds its audit and one batch of rows.
    """
    no_text = [F.lit(None).cast(t).alias(n) for n, t in [("turn", "long"), ("tie", "string"), ("copy", "int"), ("role", "string")]]
    plan = audits.select("conv_id", F.lit(0).alias("kind"), *no_text, F.col("audit").alias("text"))
    told = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "tie", "copy", "role", "text")
    order = ["conv_id", "kind", F.col("turn").asc_nulls_first(), "tie", "copy"]
    stream = plan.unionByName(told).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, sha, empty, out = None, "", 0, START, None, True, []

        def say(role: str, text: str) -> None:
            nonlocal state, empty
            sha.update((f"{role}:{text}" if empty else f"\n{role}:{text}").encode("utf-8", "surrogatepass"))
            empty = False
            state = SYSTEM if state == START and role[:1] == "s" else _after(state)

        def insert() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                say("assistant" if state == USER else "user", "")
                at += 1

        def close() -> None:
            insert()
            out.append((conv, sha.hexdigest()))

        for b in batches:
            for c, kind, role, text in zip(*(x.to_pylist() for x in b.columns)):
                if not kind:
                    if conv is not None:
                        close()
                    conv, audit, at, state, sha, empty = c, text, 0, START, hashlib.sha256(), True
                    continue
                insert()
                edit, at = audit[at], at + 1
                if edit == "K":
                    say(role, text)
                elif edit == "R":
                    say("assistant" if state == USER else "user", text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["conv_id", "repaired_sha256"])
                out = []
        if conv is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["conv_id", "repaired_sha256"])

    return map_batches(stream, hashed, "conv_id long, repaired_sha256 string")


def repair_conversations(rows: DataFrame, everyone: DataFrame, rounds: int = ROUNDS, per_round: int = RULES_PER_ROUND) -> DataFrame:
    """Faults, cheapest cost, audit and digest of the repaired turns for every ``conv_id`` of ``everyone``.

    ``rows``: ``conv_id, turn, tie, copy, role, text`` (as from ``damage``). A row's first fault counts: blank, duplicate of an
    earlier role and text, truncated (does not end in one of ``.!?``). Keeping costs 0, another role 2, deleting 3
    (required for blank and duplicate rows), inserting an empty turn 2; a truncated row that stays adds 1. A role that
    begins with none of s, u, a, and an empty role, cannot be kept. ``gaps`` counts whole turn numbers that no row has
    between the least and the greatest (null turns aside). A conversation without rows has zeros and empty results; no
    conversations give no rows.
    """
    numbers = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    strings = materialise(symbol_strings(rows))
    found = materialise(repairs(strings, learn_rules(strings, rounds, per_round)))
    told = repaired_turns(rows, found.select("conv_id", "audit"))
    out = everyone.select("conv_id").distinct().join(numbers, "conv_id", "left").join(found, "conv_id", "left").join(told, "conv_id", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"),
    )


def damage_and_repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``repair_conversations`` of what ``damage`` leaves of a table; rows without a conversation id are left out."""
    everyone = conversations.filter(cell(conv).isNotNull()).select(cell(conv).cast("long").alias("conv_id"))
    return repair_conversations(damage(conversations, conv, turn, role, text), everyone)
