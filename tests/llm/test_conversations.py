"""Prefix trie and turn repair against slow, obvious versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from zoneflow.llm import prefix_trie, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
WORDS = r"[^\x20\x09-\x0D]+"


def by_turn(rows, null):
    """{conv: [(turn, role, text)]} in the operators' order."""
    out = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = null if r is None else r, null if x is None else x
            tie = hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
            out[c].append((t is not None, t or 0, tie, r, x, t))
    return {c: [(v[5], v[3], v[4], v[2]) for v in sorted(l, key=lambda v: v[:3])] for c, l in out.items()}


def plain_trie(rows):
    turns = {c: [(r, x) for _, r, x, _ in l] for c, l in by_turn([(c, t, r or "", x or "") for c, t, r, x in rows], "").items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    below = defaultdict(list)
    for p in members:
        for d in range(len(p) + 1):
            below[p[:d]].append(p)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    saved = {p: (len(m) - 1) * (len(re.findall(WORDS, p[-1][1])) if p else 0) for p, m in members.items()}
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(built[c]) == len(p))
        out.add((
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], sum(not children[q] for q in below[p]),
            sum(saved[q] for q in below[p]), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = [tuple(r) for r in df.select(*names).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def odd_rows(seed):
    """Short and long conversations, shared beginnings of all lengths, copies, nulls, ties and repeated rows."""
    rng = random.Random(seed)
    said = ["", "one two", "three", "a  b\tc", None, "x\r\ny"]
    rows = []
    for c in range(60):
        n = rng.choice([0, 1, 2, 3, 5, 9])
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(said)) for t in range(n)]
    for c in range(100, 112):  # a trunk that branches off at several depths, beyond several blocks
        cut = rng.choice([7, 8, 9, 23, 24, 25, 40, 57])
        trunk = [(c, t, "user", f"trunk {t}") for t in range(min(cut, 56))]
        rows += trunk + [(c, t, "user", f"own {c if c % 3 else 0}") for t in range(56, 56 + rng.randrange(6))]
    rows += [(-7, None, "user", "null turn"), (-7, None, "user", "null turn"), (-7, 3, None, None), (None, 1, "user", "nobody's")]
    rows += [(200, 5, "user", "tie b"), (200, 5, "user", "tie a"), (200, 5, "system", "tie")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_odd_conversations(spark, seed):
    rows = odd_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(0).alias("pos"), F.lit("x").alias("id"), F.lit(1).alias("up"), F.lit(1).alias("level"))
    assert trie_rows(prefix_trie.prefix_trie(df, widths=(4, 8, 8) if seed == 2 else prefix_trie.WIDTHS)) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0


def test_members_of_a_hot_node_are_digested_in_pieces(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("-id as member", "cast(id % 3 = 0 as long) as conv_id", "2L as depth")
    monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 50)
    got = {(r.conv_id, r.depth): r.sha for r in prefix_trie.end_digests(rows).collect()}
    want = {(k, 2): hashlib.sha256(",".join(str(-i) for i in range(2999, -1, -1) if (i % 3 == 0) == k).encode()).hexdigest() for k in (0, 1)}
    assert got == want


def test_trie_of_the_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert trie_rows(prefix_trie.prefix_trie(table)) == plain_trie([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def damaged(rows):
    out = defaultdict(list)
    for c, l in by_turn(rows, " ").items():
        out[c] = []
        for t, r, x, tie in l:
            what = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
            if what == 0:
                continue
            x = "" if what == 1 else re.sub(r"[.!?]", "", x) if what == 2 else x
            out[c] += [(t, "user" if what == 4 else r, x)] * (2 if what == 3 else 1)
    return out


FIT = re.compile(r"\A(s?(ua)+)?\Z")


def cheapest(symbols):
    """Least (cost, audit) by trying every way, shortest cost first; at most one insertion beyond each row and two at the end."""
    best = {(): (0, "")}

    def put(table, made, way):
        if made not in table or way < table[made]:
            table[made] = way

    def grown(table):
        # what was made so far matters only through its last role and whether it fits so far
        for _ in range(3):
            for made, (c, a) in list(table.items()):
                for role in "ua":
                    if FIT.match("".join(made) + role) or FIT.match("".join(made) + role + "a"):
                        put(table, reduced(made + (role,)), (c + 2, a + "I"))
        return table

    def reduced(made):
        return made if len(made) < 3 else ("u", "a") if made[-1] == "a" else ("u",)

    def fits(made):
        return FIT.match("".join(made)) or FIT.match("".join(made) + "a") or FIT.match("".join(made) + "ua")

    for role, fault in symbols:
        fresh = {}
        for made, (c, a) in grown(best).items():
            put(fresh, made, (c + 3, a + "D"))
            if fault in ("none", "truncated"):
                extra = fault == "truncated"
                for r, cost, letter in [(role, 0, "K"), ("u", 2, "R"), ("a", 2, "R")]:
                    if r in "sua" and r and fits(made + (r,)):
                        put(fresh, reduced(made + (r,)), (c + cost + extra, a + letter))
        best = fresh
    return min(v for made, v in grown(best).items() if FIT.match("".join(made)))


def plain_repair(rows):
    out = set()
    for c, l in damaged(rows).items():
        seen, symbols = set(), []
        for t, r, x in l:
            text = x.rstrip(" \t\n\v\f\r")
            fault = "blank" if not text.strip(" \t\n\v\f\r") else "duplicate" if (r, x) in seen else "truncated" if text[-1] not in ".!?" else "none"
            seen.add((r, x))
            symbols.append((r[:1], fault))
        who = [s[0] for s in symbols]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(who, who[1:]))
        cost, audit = cheapest(symbols)
        told, at, last = [], iter(l), None
        for letter in audit:
            fit = "assistant" if last == "u" else "user"
            if letter == "I":
                told.append(f"{fit}:")
                last = fit[0]
                continue
            _, r, x = next(at)
            if letter == "K":
                told.append(f"{r}:{x}")
                last = r[0]
            elif letter == "R":
                told.append(f"{fit}:{x}")
                last = fit[0]
        kinds = [s[1] for s in symbols]
        known = [t for t, _, _ in l if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        sha = hashlib.sha256("\n".join(told).encode()).hexdigest()
        out.add((c, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, audit, sha))
    return out


def repair_rows(df):
    rows = [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    assert len(rows) == len({r[0] for r in rows})
    return set(rows)


def broken_rows(seed):
    rng = random.Random(seed)
    said = ["Yes.", "No", "  ", "", None, "A longer text! \n", "what?", "so it goes"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    rows = [(c, rng.choice([t, t, t, 2 * t, None]), rng.choice(roles), rng.choice(said)) for c in range(150) for t in range(rng.choice([1, 2, 3, 5, 8]))]
    rows += [(500, t, rng.choice(roles[:4]), f"{t % 40}{rng.choice(['.', '', '!'])}") for t in range(300)]
    return [*rows, (None, 1, "user", "nobody's")]


@pytest.mark.parametrize("chunk", [4096, 7])
def test_repair_of_broken_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(turn_repair, "CHUNK_ROWS", chunk)
    rows = broken_rows(chunk)
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(0).alias("pos"), F.lit("x").alias("tie"), F.lit(1).alias("kind"), F.lit(1).alias("seq"))
    assert repair_rows(turn_repair.damage_and_repair(df)) == plain_repair(rows)


def test_repair_of_nothing(spark):
    assert turn_repair.damage_and_repair(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = [(c, 0, "user", "x.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = repair_rows(turn_repair.damage_and_repair(spark.createDataFrame(gone, SCHEMA)))
    assert got == {(c, 0, 0, 0, 0, 0, 0, "", turn_repair.EMPTY_SHA) for c, *_ in gone} and gone


def test_grammar_changes_no_result_and_ropes_compare_as_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ABDEFHIJLM") for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    rules = [(chr(turn_repair.FIRST_RULE), "EI"), (chr(turn_repair.FIRST_RULE + 1), chr(turn_repair.FIRST_RULE) + "E")]
    flat = lambda m: [[e and (e[0], turn_repair.flat(e[1])) for e in row] for row in m]
    with_rules, without = turn_repair.rule_matrices(rules), turn_repair.symbol_matrices()
    assert any(len(turn_repair.compress(t, rules)) < len(t) for t in texts)
    for t in texts:
        assert flat(turn_repair.evaluate(t, rules, with_rules)) == flat(turn_repair.evaluate(t, [], without))
    shared = ("ab", ("", "c"))
    ropes = [shared, (shared, "a"), (shared, shared), ("a", ("b", "cd")), "", ("", ""), "abcab", ("abc", "abd")]
    for a, b in itertools.product(ropes, ropes):
        assert turn_repair.less(a, b) == (turn_repair.flat(a) < turn_repair.flat(b))


def test_rules_of_a_table(spark):
    strings = spark.createDataFrame([("EIEIEI",), ("EIEI",), ("EIEI",), ("P",), ("",)], "seq string")
    rules = turn_repair.learn_rules(strings, rounds=3, per_round=1)
    assert rules[0][1] == "EI" and len(rules) == 2
    assert turn_repair.learn_rules(strings.limit(0)) == []


def test_repair_of_the_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    assert repair_rows(turn_repair.damage_and_repair(table)) == plain_repair([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
