"""Toxicity of texts: a lexicon learnt from labels, matched through misspellings, weighed by its context.

The lexicon is what labelled toxic texts hold and clean ones do not: words, and stems that many words begin with. It is kept as
a trie. A word of a text runs through the Levenshtein automaton of the whole trie at once: the states are pairs of a
trie node and the edits made so far (insert, delete, replace, swap two neighbours); the sets of states that words reach are
made once and remembered, so most words cost a few look-ups and leave after some letters. What a misspelling is
worth depends on how often clean texts hold such forms: a form that clean texts use is a word of its own.

Each hit is judged in a window of text around it: inside quotation marks, or after a word of report, it counts
as quotation, else as abuse. A logistic model over these sums gives the score.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import cell, latest_per_process, map_batches, materialise, text_or_empty
from zoneflow.sources.workdir import broadcast_if_small

# Labelled rows of each class that the model is fitted on, chosen by a hash of their id.
TRAIN_ROWS = 6_000
# Terms of the lexicon and known clean look-alikes that the model keeps, the most telling and the most frequent.
MAX_TERMS, MAX_KNOWN = 2_000, 20_000
# A term needs this much evidence (likelihood ratio; 20 is about one in 100,000 by chance) and share of toxic use.
MIN_EVIDENCE, MIN_PURITY = 20.0, 0.9
# Letters of a stem, and of terms that may hold one edit or two.
STEM = range(4, 13)
ONE_EDIT, ONE_EDIT_STEM, TWO_EDITS = 5, 6, 9
LONGEST_WORD = 40
# Letters on each side of a hit that decide whether it is quoted.
WINDOW = 120
# Distinct words, and transitions of the automaton, that a worker process remembers.
REMEMBERED = 400_000

WORD = re.compile(r"[^\W_]+(?:[*@$!'’][^\W_]+)*")
# Characters that stand for letters in disguised words.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
# Quotation marks by what they do, and words that report somebody's speech.
OPENING, CLOSING, EITHER = "“«„‹", "”»“›", '"'
REPORTS = re.compile(
    r"\b(?:said|says|called|calls|wrote|writes|quoted?|quoting|dit|écrit|cité|appelé|sagte|sagt|schrieb|nannte|zitat|dijo|dice|escribió|llamó|cita)\b"
)

FEATURES = ("abuse", "abuse_misspelt", "quoted", "quoted_misspelt", "density")
# Prior of the logistic model: intercept and the weight of each feature, and how firmly they are held.
PRIOR = np.array([-4.0, 1.0, 0.8, 0.2, 0.1, 0.5])
FIRMNESS = np.array([0.05, 1.0, 1.0, 4.0, 4.0, 1.0])


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def edits_allowed(term: str) -> int:
    """Edits a term may hold; a stem (``lowe*``) fits any ending, so it has to be longer for its one edit."""
    if term.endswith("*"):
        return int(len(term) > ONE_EDIT_STEM)
    return (len(term) >= ONE_EDIT) + (len(term) >= TWO_EDITS)


def build_trie(terms: Sequence[str]) -> tuple[list[dict[str, int]], list[int], list[int], list[int]]:
    """Children, whole term and stem that end (-1: none), and the edits that some term below allows, per node."""
    children, whole, stem, most = [{}], [-1], [-1], [0]
    for i, term in enumerate(terms):
        node, letters, most_here = 0, term.rstrip("*"), edits_allowed(term)
        most[0] = max(most[0], most_here)
        for c in letters:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                whole.append(-1)
                stem.append(-1)
                most.append(0)
            node = children[node][c]
            most[node] = max(most[node], most_here)
        (stem if term.endswith("*") else whole)[node] = i
    return children, whole, stem, most


def make_matcher(terms: Sequence[str]):
    """``match(word)``: (term, edits) of the nearest term that the word is a form of, or None.

    A state of the automaton is (node, edits, owed): ``owed`` is the letter still to come of two that are swapped.
    """
    children, whole, stem, most = build_trie(terms)
    limits = [edits_allowed(t) for t in terms]

    def closed(states: set) -> frozenset:
        """With letters of the trie left out; a node is kept with its fewest edits only."""
        best: dict = {}
        stack = list(states)
        while stack:
            node, e, owed = stack.pop()
            if e > most[node] or best.get((node, owed), 99) <= e:
                continue
            best[node, owed] = e
            if not owed:
                stack += ((k, e + 1, "") for k in children[node].values())
        return frozenset((n, e, o) for (n, o), e in best.items())

    def follow(states: frozenset, c: str) -> frozenset:
        out = set()
        for node, e, owed in states:
            if owed:
                if owed == c:
                    out.add((node, e, ""))
                continue
            if stem[node] >= 0 and e <= limits[stem[node]]:
                out.add((node, e, ""))
            here = children[node]
            if c in here:
                out.add((here[c], e, ""))
            if e < most[node]:
                out.add((node, e + 1, ""))
                for x, k in here.items():
                    if x != c:
                        out.add((k, e + 1, ""))
                        if c in children[k]:
                            out.add((children[k][c], e + 1, x))
        return closed(out)

    start = closed({(0, 0, "")})
    step: dict = {}

    def match(word: str) -> tuple[int, int] | None:
        states = start
        for c in word[:LONGEST_WORD]:
            key = (states, c)
            nxt = step.get(key)
            if nxt is None:
                if len(step) >= REMEMBERED:
                    step.clear()
                nxt = step[key] = follow(states, c)
            if not nxt:
                return None
            states = nxt
        found = [(e, t) for node, e, owed in states if not owed for t in (whole[node], stem[node]) if t >= 0 and e <= limits[t]]
        if not found or len(word) > LONGEST_WORD and not any(terms[t].endswith("*") for _, t in found):
            return None
        e, t = min(found)
        return t, e

    def matched(word: str) -> tuple[int, int] | None:
        """As it is, else with its disguised letters put back, which counts as one edit."""
        found = match(word)
        plain = word.translate(DISGUISE)
        if (found is None or found[1]) and plain != word and any(c.isalpha() for c in word):
            again = match(plain)
            if again is not None and (found is None or again[1] + 1 < found[1] + 1):
                found = (again[0], max(1, again[1]))
        return found

    return matched


def is_quoted(text: str, start: int, end: int) -> bool:
    """Whether the letters around a hit make it somebody else's words."""
    left, right = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    line = left[left.rfind("\n") + 1 :]
    opened = max((line.rfind(c) for c in OPENING), default=-1)
    if opened >= 0 and not any(c in line[opened + 1 :] for c in CLOSING) and any(c in right for c in CLOSING):
        return True
    if line.count(EITHER) % 2 and EITHER in right:
        return True
    return bool(REPORTS.search(line[-WINDOW // 3 :].lower())) and right.lstrip(".,!?").startswith((EITHER, *CLOSING))


def make_features(model: dict):
    """``features(text)`` by a model's lexicon: summed evidence of abuse and of quotation, exact and misspelt."""
    matcher, weights, known = make_matcher(model["terms"]), model["weights"], set(model["known"])
    seen: set = set()
    hits: dict = {}

    def look_up(words: set) -> None:
        for w in words:
            found = matcher(w)
            if found is not None:
                t, e = found
                value = weights[t][min(e, 2)]
                if value > 0 and not (e and w in known):
                    hits[w] = (t, e, value)

    def features(text: str) -> list[float]:
        words = words_of(text)
        distinct = set(words)
        fresh = distinct - seen
        if fresh:
            if len(seen) >= REMEMBERED:
                seen.clear()
                hits.clear()
                fresh = distinct
            look_up(fresh)
            seen.update(fresh)
        mine = hits.keys() & distinct
        if not mine:
            return [0.0] * len(FEATURES)
        abuse: dict = {}
        quoted: dict = {}
        low, n = text.lower(), 0
        for m in WORD.finditer(low):
            if m.group() in mine:
                t, e, value = hits[m.group()]
                n += 1
                into = quoted if is_quoted(low, m.start(), m.end()) else abuse
                if value > into.get(t, (0, 0.0))[1]:
                    into[t] = (e, value)
        sums = [sum(v for e, v in d.values() if bool(e) == fuzzy) for d in (abuse, quoted) for fuzzy in (False, True)]
        return [*(min(12.0, s) for s in sums), math.log1p(100 * n / len(words)) if abuse else 0.0]

    return features


def _held_out(id_col: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, max_rows: int) -> DataFrame:
    """``id, t, y`` of at most about ``max_rows`` labelled rows of each class that are not held out."""
    key = cell(id_col)
    usable = labels.select(key.alias("id"), cell(label_col).cast("int").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~_held_out(F.col("id"), folds)
    )
    sizes = {r["y"]: r["n"] for r in usable.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # a share of the hash range of 2^62 steps per class; all rows of a class that is not above the bound
    share = {y: 1.0 if n <= max_rows else 0.95 * max_rows / n for y, n in sizes.items()}
    mix = F.shiftrightunsigned(F.xxhash64(F.lit("toxic"), F.col("id")), 2)
    within = lambda y: (F.col("y") == y) & (mix < int(share.get(y, 1.0) * 2**62))
    chosen = usable.filter(within(0) | within(1))
    return docs.select(key.alias("id"), text_or_empty(text_col).alias("t")).join(broadcast_if_small(chosen), "id").select("id", "t", "y")


def _uses(rows: DataFrame) -> DataFrame:
    """``term, toxic, clean``: labelled texts that hold each word or stem; counted in the tasks, then added up."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: dict = {}
            for t, y in zip(b.column(1), b.column(2).to_pylist()):
                words = {w for w in words_of(t.as_py()) if len(w) <= LONGEST_WORD}
                for term in words | {w[:k] + "*" for w in words for k in STEM if k < len(w)}:
                    counts.setdefault(term, [0, 0])[1 - y] += 1
            if counts:
                n = np.array(list(counts.values()), "i8")
                yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(n[:, 0]), pa.array(n[:, 1])], ["term", "toxic", "clean"])

    return map_batches(rows, counted, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evidence(n_toxic: int, n_clean: int) -> Column:
    """Likelihood ratio of a term's own share of toxic texts against that of all texts."""
    base = F.lit(math.log(n_toxic / (n_toxic + n_clean))), F.lit(math.log(n_clean / (n_toxic + n_clean)))
    n = F.col("toxic") + F.col("clean")
    part = lambda k, b: F.when(k > 0, k * (F.log(k / n) - b)).otherwise(0.0)
    return 2 * (part(F.col("toxic"), base[0]) + part(F.col("clean"), base[1]))


def choose_terms(candidates: Sequence[tuple[str, int, float]], limit: int = MAX_TERMS) -> list[str]:
    """Words and stems from ``(term, toxic texts, evidence)``.

    A stem gives way to a longer one, or to a word, that nearly all its texts hold; what an accepted stem begins, and a
    stem whose texts accepted terms already explain, is left out.
    """
    toxic = {t: n for t, n, _ in candidates}
    longer: dict = {}
    for t in toxic:
        body = t.rstrip("*")
        for parent in ([body + "*"] if not t.endswith("*") else []) + [body[:-1] + "*"]:
            if parent in toxic and parent != t:
                longer.setdefault(parent, []).append(t)

    def closed(t: str) -> str:
        while t in longer:
            best = max(longer[t], key=lambda x: (toxic[x], not x.endswith("*"), x))
            if toxic[best] < 0.95 * toxic[t]:
                break
            t = best
        return t

    order = sorted(candidates, key=lambda x: (-x[2], -len(x[0]), x[0]))
    taken: dict = {}
    explained: dict = {}
    for t in dict.fromkeys(closed(t) for t, _, _ in order):
        body = t.rstrip("*")
        if len(taken) >= limit:
            break
        if any(body[:k] + "*" in taken for k in STEM if k <= len(body)) or (t.endswith("*") and explained.get(t, 0) >= 0.8 * toxic[t]):
            continue
        taken[t] = True
        for k in STEM:
            if k <= len(body):
                explained[body[:k] + "*"] = explained.get(body[:k] + "*", 0) + toxic[t]
    return sorted(taken)


def _forms(uses: DataFrame, terms: list[str]) -> DataFrame:
    """``word, term, edits, toxic, clean`` of the labelled texts' words that the automaton takes for a misspelling."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = make_matcher(terms)
        for b in batches:
            out = [(w, *hit, x, y) for w, x, y in zip(*(c.to_pylist() for c in b.columns)) if (hit := matcher(w)) is not None and hit[1]]
            cols = zip(*out) if out else [[]] * 5
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["word", "term", "edits", "toxic", "clean"])

    words = uses.filter(~F.col("term").endswith("*")).select("term", "toxic", "clean")
    return map_batches(words, found, "word string, term int, edits int, toxic long, clean long")


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Intercept and weights: the most likely ones under the prior, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (p - y) + FIRMNESS * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(FIRMNESS)
        move = np.linalg.solve(curve, slope)
        w = w - move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-9:
            break
    return w


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    folds: int = 5, max_rows: int = TRAIN_ROWS, seeds: Sequence[str] = (),
) -> dict:
    """Lexicon, weights and logistic model from labelled documents whose id is not held out; a plain dict.

    At most about ``max_rows`` rows of each class are used. Texts are read in the tasks; what reaches the driver is
    bounded: terms with enough evidence, known look-alikes, and five numbers per chosen row. ``seeds``: further terms of
    the lexicon (``word`` or ``stem*``). Rows with a null id or a label other than 0 and 1 are not used. Without toxic or
    without clean rows there is no lexicon but ``seeds``, and the prior scores.
    """
    rows = materialise(_labelled(docs, labels, id_col, text_col, label_col, folds, max_rows))
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        terms = sorted(set(seeds))
        return {"terms": terms, "weights": [(3.0, 1.0, 0.5)] * len(terms), "known": [], "w": PRIOR.tolist()}
    uses = materialise(_uses(rows))
    purity = (F.col("toxic") / n1) / (F.col("toxic") / n1 + F.col("clean") / n0)
    strong = uses.filter(purity >= MIN_PURITY).withColumn("evidence", _evidence(n1, n0)).filter(F.col("evidence") >= MIN_EVIDENCE)
    top = strong.orderBy(F.desc("evidence"), "term").limit(10 * MAX_TERMS).collect()
    terms = sorted({*choose_terms([(r["term"], r["toxic"], r["evidence"]) for r in top]), *seeds})
    counts = {r["term"]: (r["toxic"], r["clean"]) for r in uses.join(F.broadcast(_names(docs, terms)), "term").collect()} if terms else {}
    odds = lambda a, b, less: max(0.0, math.log((a + 1) / (n1 + 2)) - math.log((b + less) / (n0 + 2)))
    forms = materialise(_forms(uses, terms))
    clean_forms = forms.filter("clean > 0").orderBy(F.desc("clean"), "word").limit(MAX_KNOWN).select("word").collect()
    # forms seen in one clean text only tell how often a clean text has a new one
    novel = {
        (r["term"], r["edits"]): (r["toxic"], r["once"])
        for r in forms.groupBy("term", "edits").agg(
            F.sum(F.when(F.col("clean") == 0, F.col("toxic")).otherwise(0)).alias("toxic"), F.count_if(F.col("clean") == 1).alias("once")
        ).collect()
    }
    weights = []
    for i, t in enumerate(terms):
        exact = odds(*counts[t], 0.5) if t in counts else 3.0
        weights.append((exact, *(min(exact, 0.75**e * odds(*novel.get((i, e), (0, 0)), 0.5)) for e in (1, 2))))
    model = {"terms": terms, "weights": weights, "known": sorted(r["word"] for r in clean_forms)}

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = make_features(model)
        for b in batches:
            x = [features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(2), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    got = sorted((r["y"], tuple(r["x"])) for r in map_batches(rows, measured, "y int, x array<double>").toLocalIterator())
    x, y = np.array([x for _, x in got], "f8").reshape(-1, len(FEATURES)), np.array([y for y, _ in got], "f8")
    return model | {"w": fit_logistic(x, y).tolist()}


def _names(docs: DataFrame, terms: list[str]) -> DataFrame:
    return docs.sparkSession.createDataFrame([(t,) for t in terms], "term string")


def make_scorer(model: dict):
    """``score(text)`` in [0, 1] by a model that ``train`` returned."""
    features, w = make_features(model), model["w"]

    def score(text: str) -> float:
        z = w[0] + sum(a * b for a, b in zip(w[1:], features(text)))
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, z))))

    return score


def score_documents(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, folds: int = 5) -> DataFrame:
    """Per row ``(id, held_out, score, predicted)``; nothing but the whole text enters the score.

    Null counts as empty; a text without any hit has the model's lowest score. A null id is never held out. Equal texts get equal
    scores. No rows give no rows. One pass, no shuffle; the model (plain lists, bounded) is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(cell(id_col).alias("id"), _held_out(cell(id_col), folds).alias("held_out"), text_or_empty(text_col).alias("t"))
    key = uuid.uuid4().hex

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = latest_per_process("toxicity", key, lambda: make_scorer(sent.value))
        for b in batches:
            s = [score(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64())], ["id", "held_out", "score"])

    schema = T.StructType([rows.schema["id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])
    return map_batches(rows, scored, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
