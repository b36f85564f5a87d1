"""Run logs and event logs as tables."""

from __future__ import annotations

import gzip
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions.formats import BLOCK_END, BLOCK_MARK
from zoneflow.sources.workdir import broadcast_if_small, materialise, session_conf

# Characters of an open block that one row holds.
PIECE_CHARS = 1 << 16
# Bytes of a gzip file up to which it goes to a task's Python as it is, and text that is unpacked of it at once.
WHOLE_BYTES, UNPACKED_BYTES = 4 << 20, 1 << 20

_PIECES = "path string, start long, seq long, piece long, text string, ends boolean, opens long, early boolean"
_BOUNDS, _HEAD = -2, -1  # in place of a section's number


def read_log_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, line``: every line of every log; large files are split over tasks."""
    raw = spark.read.text(paths)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def _goes_whole() -> Column:
    """Small gzip files, known before any is opened. No two tasks can share one, so their lines need not come one by one."""
    return F.col("_metadata.file_path").endswith(".gz") & (F.col("_metadata.file_size") <= WHOLE_BYTES)


def _whole_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, content``: the bytes of the files that go whole."""
    raw = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).filter(_goes_whole())
    return raw.select(F.col("_metadata.file_path").alias("path"), "content")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """``(path, 0), text``: whole lines of whole files, a bounded text at a time."""
    for b in batches:
        for path, content in zip(b.column(0), b.column(1)):
            here, parts = (path.as_py(), 0), []
            with gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer())) as file:
                while text := file.read(UNPACKED_BYTES):
                    cut = text.rfind(b"\n") + 1
                    if cut:
                        yield here, b"".join([*parts, text[:cut]])
                        parts = []
                    parts.append(text[cut:])
            if rest := b"".join(parts):
                yield here, rest + b"\n"


def _split_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, start, line``: lines of the other files in the order of the file, those of a split next to one another."""
    raw = spark.read.option("lineSep", "\n").text(paths).filter(~_goes_whole())
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """``(path, start), text``: batches of lines cut where another split begins, every line with its end."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        codes, start = b.column(0).dictionary_encode().indices.to_numpy(), b.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(start) != 0)) + 1).tolist(), n]
        for lo, hi in zip(cuts, cuts[1:]):
            lines = pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), b.column(2).slice(lo, hi - lo))
            text = pc.binary_join(lines, "\n")[0].as_buffer().to_pybytes()
            yield (b.column(0)[lo].as_py(), int(start[lo])), text + b"\n"


def _lines_of(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """Lines of a text, each with its end, as an array over the bytes, and where each begins."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == ord("\n")) + 1
    at = np.concatenate(([0], ends)).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(at), pa.py_buffer(text)), at


def _where(told: pa.Array) -> np.ndarray:
    return np.flatnonzero(told.to_numpy(zero_copy_only=False))


class _Section:
    """Text of one section in pieces of bounded size. Runs of lines without a pair become one line, which parses the same."""

    def __init__(self, split: tuple, seq: int):
        self.split, self.seq, self.piece, self.lines, self.size, self.run = split, seq, 0, [], 0, None

    def add(self, text: str, pairs: bool = False) -> Iterator[tuple]:
        """Take lines and give the pieces that are full. ``pairs``: all lines hold a pair."""
        if pairs and self.size + len(text) <= PIECE_CHARS:
            self._take(text)
            return
        for line in text.split("\n"):
            if "=" in line:
                self._take(line)
                if self.size > PIECE_CHARS:
                    yield self.row(False)
            else:
                self.run = "." if self.run == "." or line.strip() else ""

    def _take(self, text: str) -> None:
        if self.run is not None:
            self.lines.append(self.run)
        self.lines.append(text)
        self.size, self.run = self.size + len(text), None

    def row(self, ends: bool) -> tuple:
        lines = self.lines if self.run is None else [*self.lines, self.run]
        out = (*self.split, self.seq, self.piece, "\n".join(lines) if lines else None, ends, None, None)
        self.piece, self.lines, self.size, self.run = self.piece + 1, [], 0, None
        return out


def _scan(parts: Iterator[tuple[tuple, bytes]]) -> Iterator[tuple]:
    """Pieces of the sections of each split, as if no section were open where it begins, and how the split ends.

    A section begins at the first block mark after an end mark, or after the split's begin, and is closed by the next line
    that starts with the end mark. Its last piece ``ends`` it, unless it is open at the split's end. One row with
    ``seq = _BOUNDS`` says whether the split has an end mark (``ends``), which section it leaves open (``opens``), and whether
    section 0 began before the first end mark (``early``): if another section is open already, that one is none.
    """
    split, section, seq, ended, early = None, None, 0, False, False

    def finish() -> Iterator[tuple]:
        if split is not None:
            if section is not None:
                yield section.row(False)
            yield (*split, _BOUNDS, 0, None, ended, section.seq if section is not None else None, early)

    for here, text in parts:
        if here != split:
            yield from finish()
            split, section, seq, ended, early = here, None, 0, False, False
        lines, at = _lines_of(text)
        # outside of sections only lines with a mark matter
        marks = _where(pc.or_(pc.starts_with(lines, BLOCK_END), pc.match_substring(lines, BLOCK_MARK)))
        if section is None and not len(marks):
            continue
        plain = _where(pc.invert(pc.match_substring(lines, "=")))
        # whether a line without a pair lies between a mark and the one before
        runs = np.diff(np.searchsorted(plain, [0, *marks, len(lines)])) > 0
        behind = 0
        for mark, till, run in zip([*at[marks].tolist(), len(text)], [*at[marks + 1].tolist(), None], runs.tolist()):
            if section is not None and mark > behind:
                yield from section.add(text[behind : mark - 1].decode(), not run)
            if till is None:
                break
            line, behind = text[mark : till - 1].decode(), till
            if line.startswith(BLOCK_END):
                if section is not None:
                    yield section.row(True)
                section, ended, line = None, True, line[len(BLOCK_END) :]
            if section is not None:
                yield from section.add(line)
            elif BLOCK_MARK in line:
                section, seq, early = _Section(split, seq), seq + 1, early or not ended
                # a section's first line is never a piece of its own
                section._take(line[line.index(BLOCK_MARK) :])
    yield from finish()


def _scan_heads(parts: Iterator[tuple[tuple, bytes]]) -> Iterator[tuple]:
    """What each split holds of a section that is open where it begins: its lines up to the first end mark."""
    split, section = None, None
    for here, text in parts:
        if here != split:
            if section is not None:
                yield section.row(False)
            split, section = here, _Section(here, _HEAD)
        if section is None:
            continue
        lines, at = _lines_of(text)
        closes = _where(pc.starts_with(lines, BLOCK_END))
        till = int(at[closes[0]]) if len(closes) else len(text)
        if till:
            yield from section.add(text[: till - 1].decode())
        if len(closes):
            yield section.row(True)
            section = None
    if section is not None:
        yield section.row(False)


def _pieces(lines: DataFrame, scan, parts=_by_split) -> DataFrame:
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.bool_()]
        names, rows, size = [c.split()[0] for c in _PIECES.split(", ")], [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        for r in scan(parts(batches)):
            rows.append(r)
            size += len(r[4] or "")
            if size > 16 * PIECE_CHARS or len(rows) > 10_000:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()

    return lines.mapInArrow(mapped, _PIECES)


def _open_at_begin(bounds: DataFrame) -> DataFrame:
    """``path, start, from_start, from_seq, ends``: splits that begin inside a section, and which section it is.

    One small row per split streams by in the order of the file; what goes from one to the next is the open section.
    """

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, inside = None, None
        names = ["path", "start", "from_start", "from_seq", "ends"]
        for b in batches:
            out = []
            for p, start, ends, opens in zip(*(c.to_pylist() for c in b.columns)):
                path, inside = p, inside if p == path else None
                if inside is not None:
                    out.append((p, start, *inside, ends))
                if ends or inside is None:
                    inside = None if opens is None else (start, opens)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    rows = bounds.select("path", "start", "ends", "opens").repartition("path").sortWithinPartitions("path", "start")
    return rows.mapInArrow(folded, "path string, start long, from_start long, from_seq long, ends boolean")


def read_log_sections(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, start, seq, text``: what every log holds from a block mark to the next end mark, which closes it.

    Logs are read line by line, so neither a log without an end mark nor the lines between blocks are ever one
    record; the rows of a task are pieces of bounded size. Each split is scanned by itself, one small row per split tells how
    it begins and ends, and these rows, in the order of the file, tell which splits begin inside a section. Only if such a
    section is closed later are the logs read again, for the lines that were taken for plain text at first.
    An unclosed section is no section. Of the lines after the mark only those with a ``=`` are kept, and one line for each
    run of others. (``start``, ``seq``) orders a file's sections.
    """
    scanned = _pieces(_whole_files(spark, paths), _scan, _unpacked).unionAll(_pieces(_split_lines(spark, paths), _scan))
    # the text of all sections, which zstd brings to a third of what Spark's usual codec does
    with session_conf(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": f"{WHOLE_BYTES}b"}):
        found = materialise(scanned, compression="zstd")
    bounds = found.filter(F.col("seq") == _BOUNDS)
    inside = materialise(_open_at_begin(bounds))
    names = ["path", "from_start", "from_seq"]
    closed = inside.filter("ends").select(*names).distinct()
    goes_on = materialise(inside.join(closed, names))
    pieces = found.filter(F.col("seq") >= 0).select("path", F.col("start").alias("from_start"), F.col("seq").alias("from_seq"), "start", "piece", "text", "ends")
    if inside.take(1):
        wrong = bounds.filter("early").join(inside.select("path", "start"), ["path", "start"], "left_semi")
        wrong = wrong.select("path", "start", F.lit(0).cast("long").alias("from_seq"))
        pieces = pieces.join(broadcast_if_small(materialise(wrong)), ["path", "start", "from_seq"], "left_anti").select(*pieces.columns)
    if goes_on.take(1):
        # the same paths again, since a file's splits depend on all that is read; one small row per split is broadcast,
        # which leaves the lines in their order
        wanted = F.broadcast(goes_on.select("path", "start"))
        lines = _split_lines(spark, paths).join(wanted, ["path", "start"], "left_semi")
        # stored, since more than one step reads them and each would read the logs again
        heads = materialise(_pieces(lines, _scan_heads), compression="zstd")
        heads = heads.join(broadcast_if_small(goes_on.drop("ends")), ["path", "start"])
        pieces = pieces.unionByName(heads.select(*pieces.columns))
    # nearly all sections are one closed piece; only those in several are put together, and never an unclosed one
    short = F.col("ends") & (F.col("piece") == 0) & (F.col("start") == F.col("from_start"))
    parts = pieces.filter(~short)
    parts = parts.join(parts.filter("ends").select(*names), names, "left_semi")
    order = F.sort_array(F.collect_list(F.struct("start", "piece", "text")))
    joined = parts.filter("text IS NOT NULL").groupBy(*names).agg(F.array_join(F.transform(order, lambda x: x["text"]), "\n").alias("text"))
    whole = pieces.filter(short).select(*names, "text").unionByName(joined)
    return whole.select("path", F.col("from_start").alias("start"), F.col("from_seq").alias("seq"), F.concat("text", F.lit("\n" + BLOCK_END)).alias("text"))


# The event-log fields the stage rollup needs; a given schema saves the inference pass.
EVENT_SCHEMA = """
    `Event` string, `App ID` string, `App Attempt ID` string, `Executor ID` string, `Executor Info` struct<`Host`: string>,
    `Job ID` long, `Stage IDs` array<long>, `Submission Time` long,
    `Completion Time` long, `Properties` map<string, string>,
    `Stage ID` long, `Stage Attempt ID` long,
    `Stage Info` struct<`Stage ID`: long, `Stage Attempt ID`: long, `Number of Tasks`: long,
        `Submission Time`: long, `Completion Time`: long, `Failure Reason`: string>,
    `Task Info` struct<`Task ID`: long, `Failed`: boolean, `Killed`: boolean>,
    `Task End Reason` struct<`Reason`: string>,
    `Task Metrics` struct<`Executor Run Time`: long,
        `Shuffle Read Metrics`: struct<`Remote Bytes Read`: long, `Local Bytes Read`: long>,
        `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: long>>
"""

# How a rolled log is laid out. A folder per application attempt holds numbered parts; a compacted part
# stands for itself and all parts up to its number. Status files hold no events.
ROLLED_FOLDER = r"^(.*[/=]eventlog_v2_[^/]+)/"
ROLLED_PART = r"[/=]events_(\d+)_([^/]*)"
COMPACTED = r"\.compact(?:/|$)"
STATUS_FILE = r"/appstatus_[^/]*$"


def part_of(path: Column | str) -> dict[str, Column]:
    """``run``, ``part`` and ``compacted`` of an event file, from its path.

    The parts in an ``eventlog_v2_...`` folder (also one that a column partitions by) are one run, named by it; loose parts with the same name but for their
    number are one run; any other file is a run of its own, with one part.
    """
    path = F.col(path) if isinstance(path, str) else path
    rolled, number = F.regexp_extract(path, ROLLED_FOLDER, 1), F.regexp_extract(path, ROLLED_PART, 1)
    loose = F.concat(F.regexp_extract(path, r"^(.*)[/=]events_\d+_", 1), F.lit("/"), F.regexp_replace(F.regexp_extract(path, ROLLED_PART, 2), r"\..*", ""))
    run = F.when(rolled != "", rolled).when(number != "", loose).otherwise(path)
    part = F.when(number != "", number.cast("long")).otherwise(F.lit(1).cast("long"))
    return {"run": run, "part": part, "compacted": path.rlike(COMPACTED)}


def with_runs(events: DataFrame, path: str = "path") -> DataFrame:
    """Add ``run, part, app_id, attempt`` to events that carry the path of their file, and leave out what was compacted.

    A job, its stages and its tasks may lie in different parts, so everything downstream goes by ``run``. The application's id
    stands in one event of one part; it is carried to all rows of the run (null: no part names it). Parts up to the
    latest compacted one are told again by that one and are left out.
    """
    # all but the application's id follows from the files' paths, of which there are few
    files = materialise(events.select(F.col(path).alias("__path")).distinct().withColumns(part_of("__path")).filter(~F.col("__path").rlike(STATUS_FILE)))
    latest = files.filter("compacted").groupBy("run").agg(F.max("part").alias("__from"))
    begun = events.filter(F.col("Event") == "SparkListenerApplicationStart").select(F.col(path).alias("__path"), F.struct(F.col("App ID").alias("app_id"), F.col("App Attempt ID").alias("attempt")).alias("__app"))
    started = begun.join(files, "__path").groupBy("run").agg(F.max_by("__app", "part").alias("__app"))
    # most logs are not compacted
    kept = F.col("__from").isNull() | (F.col("part") > F.col("__from")) | ((F.col("part") == F.col("__from")) & F.col("compacted"))
    told = files.join(latest, "run", "left").filter(kept).join(started, "run", "left")
    told = told.select("__path", "run", "part", F.col("__app.app_id").alias("app_id"), F.col("__app.attempt").alias("attempt"))
    out = events.withColumnRenamed(path, "__path").join(broadcast_if_small(materialise(told)), "__path").withColumnRenamed("__path", path)
    return out.select("run", "part", "app_id", "attempt", *events.columns)


def read_event_log(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Events of one or many applications, from single files, folders of them, and rolled logs with any number of parts.

    ``run`` is the file, or the folder of a rolled log; ``part`` orders its files; ``app_id`` and ``attempt`` are carried to
    all events of a run. Files are read compressed as Spark's own readers can (their names say how). The events are stored
    once, since compressed text can be read by one task a file only.
    """
    events = spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").json(paths)
    return with_runs(materialise(events.select(F.col("_metadata.file_path").alias("path"), "*"))).drop("path")


def parse_events(lines: DataFrame, line: str = "line", keep: Sequence[str] = ("run",), names: Sequence[str] = ()) -> DataFrame:
    """Events from JSON text already in a column. ``names``: only these events, so that other lines need no parsing."""
    if names:
        # a name may be written with escapes, so such lines are parsed as well
        told = F.col(line).contains("\\")
        for n in names:
            told = told | F.col(line).contains(n)
        return parse_events(lines.filter(told), line, keep).filter(F.col("Event").isin(*names))
    return lines.select(*keep, F.from_json(line, EVENT_SCHEMA).alias("e")).select(*keep, "e.*")
