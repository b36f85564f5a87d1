"""Near duplicates by MinHash with tensored banding, verified on full shingle sets."""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import cell, give_back, latest_per_process, map_batches, materialise, text_or_empty
from zoneflow.llm.graph import components
from zoneflow.llm.hashing import LOWER, WordHashes, mix, shingle_hashes
from zoneflow.sources.workdir import broadcast_if_small

# Twenty small collections of up to three minhashes each. A table key is a pair of collections, so 60 minhashes give
# 190 tables of six hashes that plain banding would need 1,140 for. A pair of documents is a candidate when two
# collections agree: it is missed with a chance of 1.3e-5 at a similarity of 0.8 and of 2e-7 at 0.85.
COLLECTIONS, MOST_HASHES, MOST_MISSED = 20, 3, 2e-5
# Documents that one comparison task takes from each side of a large cluster.
BLOCK_DOCS, BLOCK_SHINGLES = 512, 500_000


def hashes_per_collection(percent: int) -> int:
    """The most minhashes a collection can have if a pair at the threshold is to be missed at most twice in 100,000."""
    for n in range(MOST_HASHES, 0, -1):
        agree = (percent / 100) ** n
        if (1 - agree) ** COLLECTIONS + COLLECTIONS * agree * (1 - agree) ** (COLLECTIONS - 1) <= MOST_MISSED:
            return n
    raise ValueError(f"a similarity of {percent} % is too low for {COLLECTIONS} collections")


def _seeds(hashes: int) -> np.ndarray:
    return mix(np.arange(1, COLLECTIONS * hashes + 1, dtype="u8") * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingle_set(text: str, k: int, words: WordHashes) -> np.ndarray:
    """Sorted hashes of a text's distinct ``k``-word shingles, A-Z lower-cased."""
    return np.unique(shingle_hashes(words.of(text.encode("utf-8", "surrogatepass").translate(LOWER)), k))


def collections_of(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One value per collection: its minhashes, mixed with its number."""
    low = np.full(len(seeds), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 4096):  # small blocks stay in the cache
        part = shingles[at : at + 4096]
        for i, s in enumerate(seeds):
            low[i] = min(low[i], ((part ^ (s >> np.uint64(7))) * s).min())
    low = low.reshape(COLLECTIONS, -1)
    out = np.arange(1, COLLECTIONS + 1, dtype="u8")
    for j in range(low.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + low[:, j])
    return out


def _text_key(text) -> list:
    """128 bits that name a text, computed by the engine on either pass."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, hashes: int, secret: bytes) -> DataFrame:
    """Per row ``(id, row_no, t1, t2, n_shingles, s1, s2, subs)``; ``s1, s2`` name the shingle set."""
    text = text_or_empty(text_col)
    rows = docs.select(cell(id_col).alias("id"), F.monotonically_increasing_id().alias("row_no"), *_text_key(text), text.alias("t"))
    more = T.StructType.fromDDL("n_shingles long, s1 long, s2 long, subs array<bigint>").fields
    schema = T.StructType([rows.schema[c] for c in ("id", "row_no", "t1", "t2")] + more)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seeds = latest_per_process("words", secret, lambda: WordHashes(secret)), _seeds(hashes)
        for b in batches:
            n, s1, s2, subs = [], [], [], []
            for t in b.column(4):
                s = shingle_set(t.as_py(), k, words)
                n.append(len(s))
                both = (mix(s).sum(dtype="u8"), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype="u8"))
                s1.append(int(both[0].astype("i8")))
                s2.append(int(both[1].astype("i8")))
                subs.append(collections_of(s, seeds).astype("i8").tolist() if len(s) else None)
            cols = [*b.columns[:4], pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(subs, pa.list_(pa.int64()))], schema.names)

    return map_batches(rows, sign, schema)


def candidate_edges(sets: DataFrame) -> DataFrame:
    """Edges ``(node, rep)``: every document of a table key with the smallest one of that key.

    A value that only one document has cannot make a shared key, so such values go first; the keys are
    pairs of what is left. Counts and minima are combined before they are shuffled.
    """
    each = sets.select("node", F.explode("subs").alias("h"))
    shared = each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    left = each.join(shared, "h").groupBy("node").agg(F.sort_array(F.collect_list("h")).alias("hs")).filter("size(hs) > 1")
    pair_keys = F.expr(
        "flatten(transform(sequence(1, size(hs) - 1), i -> transform(slice(hs, i + 1, size(hs) - i), y -> xxhash64(hs[i - 1], y))))"
    )
    keyed = materialise(left.select("node", pair_keys.alias("keys")))
    keyed = keyed.select("node", F.explode("keys").alias("key"))
    tables = keyed.groupBy("key").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "rep")
    return keyed.join(tables, "key").filter("node <> rep").select("node", "rep").distinct()


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _full_sets(docs: DataFrame, text_col: str, wanted: DataFrame, k: int, secret: bytes) -> DataFrame:
    """``(node, s)`` with the shingle set of each wanted node ``(node, t1, t2)``, from a second pass over the texts."""
    text = text_or_empty(text_col)
    rows = docs.select(*_text_key(text), text.alias("t")).join(broadcast_if_small(wanted), ["t1", "t2"]).select("node", "t")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = latest_per_process("words", secret, lambda: WordHashes(secret)), set()
        for b in batches:
            nodes, out = [], []
            for node, t in zip(b.column(0).to_pylist(), b.column(1)):
                if node not in seen:  # copies of a text bring it again
                    seen.add(node)
                    nodes.append(node)
                    out.append(shingle_set(t.as_py(), k, words).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(out, pa.binary())], ["node", "s"])

    return map_batches(rows, sets, "node long, s binary").dropDuplicates(["node"])


def _verified(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a, b = sets.select("node", F.col("s").alias("a")), sets.select(F.col("node").alias("rep"), F.col("s").alias("b"))
    pairs = edges.join(a, "node").join(b, "rep").select("node", "rep", "a", "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = zip(batch.column(2), batch.column(3))
            keep = [_linked(np.frombuffer(x.as_py(), "u8"), np.frombuffer(y.as_py(), "u8"), percent) for x, y in cols]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["node", "rep"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(pairs, check, "node long, rep long")


def join_components(
    left: list[tuple[int, int, np.ndarray]], right: list[tuple[int, int, np.ndarray]], percent: int
) -> list[tuple[int, int]]:
    """Links that join different components of ``(node, component, set)`` lists, at most one fewer than there are.

    One inverted index over the right side gives a document's overlap with all of it at once.
    """
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    sizes = np.array([len(s) for _, _, s in right])
    owner = np.repeat(np.arange(len(right)), sizes)
    values = np.concatenate([s for _, _, s in right])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    links = []
    for node, comp, s in left:
        lo, hi = np.searchsorted(values, s, "left"), np.searchsorted(values, s, "right")
        n = hi - lo
        hit = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(owner[hit], minlength=len(right))
        for j in np.flatnonzero(100 * common >= percent * (sizes + len(s) - common)):
            a, b = find(comp), find(right[j][1])
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((node, right[j][0]))
    return links


def _remaining_links(edges: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links between components that candidates connect but verified links so far do not.

    Within a cluster of candidates, every document outside the cluster's largest component is compared with
    every document of another component, in blocks of bounded size: no pair of documents becomes a row, and a
    block returns only links that join components. Clusters of two were compared already.
    """
    cluster = components(edges, "node", "rep").withColumnRenamed("component", "cluster")
    member = cluster.join(components(links, "node", "rep"), "node", "left").select(
        "node", "cluster", F.coalesce("component", "node").alias("comp")
    )
    member = materialise(member.join(sets.select("node", F.length("s").alias("bytes")), "node"))
    by_comp = member.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    main = F.max(F.struct("n", F.col("comp"), "bytes")).alias("main")
    shape = by_comp.groupBy("cluster").agg(main, F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).filter("main.n < n AND n > 2")
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK_DOCS), F.ceil(size / (8 * BLOCK_SHINGLES)), F.lit(1)).cast("int")
    shape = materialise(
        shape.select(
            "cluster",
            F.col("main.comp").alias("main"),
            blocks(F.col("n"), F.col("bytes")).alias("nb"),
            blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("na"),
        )
    )
    if not shape.take(1):
        return None
    open_ = member.join(shape, "cluster").withColumn("spread", F.xxhash64("node"))
    place = lambda of, many: F.pmod(F.col("spread"), F.col(many)).cast("int").alias(of)
    minor = open_.filter("comp <> main").select(
        "node", "cluster", "comp", F.lit(True).alias("asks"), place("i", "na"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("j")
    )
    every = open_.select(
        "node", "cluster", "comp", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("i"), place("j", "nb")
    )
    rows = minor.unionByName(every).join(sets, "node")

    def compare(table: pa.Table) -> pa.Table:
        sides: dict[bool, list] = {True: [], False: []}
        for node, comp, asks, s in zip(*(table.column(c).to_pylist() for c in ("node", "comp", "asks", "s"))):
            sides[asks].append((node, comp, np.frombuffer(s, "u8")))
        links = join_components(sides[True], sides[False], percent) if sides[True] and sides[False] else []
        give_back()
        return pa.table({"node": pa.array([a for a, _ in links], pa.int64()), "rep": pa.array([b for _, b in links], pa.int64())})

    return rows.groupBy("cluster", "i", "j").applyInArrow(compare, "node long, rep long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """Per row ``(id, row_no, t1, t2, n_shingles, component_id, kept)``.

    Words are what ASCII white space separates, with A-Z lower-cased. Two rows are linked when
    ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct ``shingle``-word runs; a text with fewer
    words has them all as its one run; a null, empty or blank text has an empty set and no links. Classes are
    connected components; ``component_id`` is the smallest id of the class (null only if all are null) and exactly
    one row of a class is ``kept``: one with that id. No rows give no rows.

    Rows with equal sets are one node. Candidates are found by tensored MinHash and every link rests on full
    sets. Of a table key only edges to its smallest document are tried at first; where this leaves candidates
    of one cluster unconnected, the rest of the cluster is compared in blocks, so no link between candidates
    is lost and a large class costs as much as its size. Only sets of candidates move, never all texts.
    Words are hashed under a key drawn for the call, so no text can be written to collide with another.
    """
    secret = secrets.token_bytes(16)
    signed = materialise(signatures(docs, id_col, text_col, shingle, hashes_per_collection(percent), secret))
    nonempty = signed.filter("n_shingles > 0")
    copies = nonempty.groupBy("s1", "s2").agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = broadcast_if_small(materialise(copies.select("s1", "s2", "first")))
    rows = materialise(
        signed.join(copies, ["s1", "s2"], "left")
        .withColumn("node", F.when((F.col("n_shingles") > 0) & F.col("first").isNotNull(), F.col("first")).otherwise(F.col("row_no")))
        .select("id", "row_no", "t1", "t2", "n_shingles", "subs", "node")
    )
    nodes = rows.filter("node = row_no AND n_shingles > 0")
    edges = materialise(candidate_edges(nodes.select("node", "subs")))
    members = edges.select("node").unionAll(edges.select(F.col("rep").alias("node"))).distinct()
    wanted = materialise(nodes.select("node", "t1", "t2").join(members, "node"))
    sets = materialise(_full_sets(docs, text_col, wanted, shingle, secret))
    links = materialise(_verified(edges, sets, percent))
    more = _remaining_links(edges, links, sets, percent)
    if more is not None:
        links = materialise(links.unionAll(more))
    found = broadcast_if_small(materialise(components(links, "node", "rep")))
    classed = rows.join(found, "node", "left").withColumn("class", F.coalesce("component", "node"))
    classed = materialise(classed.select("id", "row_no", "t1", "t2", "n_shingles", "class"))
    # a class of one row needs no lookup; larger ones are few
    first = F.min(F.struct(F.isnull("id").alias("no_id"), F.col("id"), F.col("row_no"))).alias("first")
    classes = classed.groupBy("class").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1")
    classes = broadcast_if_small(materialise(classes.select("class", "first")))
    return classed.join(classes, "class", "left").select(
        "id",
        "row_no",
        "t1",
        "t2",
        "n_shingles",
        F.when(F.col("first").isNotNull(), F.col("first.id")).otherwise(F.col("id")).alias("component_id"),
        (F.col("first").isNull() | (F.col("first.row_no") == F.col("row_no"))).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns.

    Rows are recognised on the second pass by their id and the 128-bit name of their text; of rows that share
    both, one stays if the row that stays is among them.
    """
    found = materialise(near_duplicates(docs, id_col, text_col, shingle, percent))
    gone = found.filter("NOT kept").select("id", "t1", "t2").distinct()
    stay = found.filter("kept").select("id", "t1", "t2", F.lit(True).alias("stay"))
    # only names with a dropped row need care: all their rows go, but one where a kept row has the same name
    same = F.col("x.id").eqNullSafe(F.col("y.id")) & (F.col("x.t1") == F.col("y.t1")) & (F.col("x.t2") == F.col("y.t2"))
    gone = gone.alias("x").join(stay.alias("y"), same, "left").select("x.id", "x.t1", "x.t2", F.coalesce("y.stay", F.lit(False)).alias("stay"))
    gone = broadcast_if_small(materialise(gone.distinct()))
    names, text = docs.columns, text_or_empty(text_col)
    rows = docs.select(F.struct(*(cell(c) for c in names)).alias("row"), cell(id_col).alias("id"), *_text_key(text)).alias("x")
    same = F.col("x.t1").eqNullSafe(F.col("y.t1")) & (F.col("x.t2") == F.col("y.t2")) & F.col("x.id").eqNullSafe(F.col("y.id"))
    tested = rows.join(gone.alias("y"), same, "left").select("x.row", "x.id", "x.t1", "x.t2", "y.stay")
    untouched = tested.filter("stay IS NULL").select("row.*")
    return untouched.unionAll(tested.filter("stay").dropDuplicates(["id", "t1", "t2"]).select("row.*"))
