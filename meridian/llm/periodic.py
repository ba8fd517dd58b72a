"""Periodic runs of words: stretches that repeat with a period, found by a dictionary of basic factors.

A factor is 2**k consecutive words of one text. Names of the factors of a length come from pairs of names of half the length; factors that
occur once drop out, so that later levels are short. At each level a place has a successor, the next place with the same name; successors
within twice the length, at equal steps, form arithmetic progressions, and a progression of three places or more proposes its step as a
period. A step above the factor's length is proposed again a level higher, and taken there, where its progression is unbroken. The stretch of
a progression is extended by words to both sides, and stretches that several levels propose are kept once.
A run with period q is at least 4 * q long, so that at the level with q <= 2**k < 2 * q, its first three places are such a progression,
and the successor of a place cannot be nearer than the smallest period: no run is missed, and no period is a multiple of a smaller one.

Defined results: a null text is the empty one, without words and runs; equal rows are separate rows; texts of any length are worked on whole,
short ones together; an empty table gives an empty result; further columns are carried along, and columns named as new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.batches import word_spans
from meridian.llm.common import WORD, documents, slices, text_bytes

SLICE = 1 << 20
#: A run has at least so many words and so many periods.
LEAST, TIMES = 6, 4
#: New columns; columns of these names are replaced.
NEW = ("n_words", "runs", "collapsed")
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _names(keys: np.ndarray) -> np.ndarray:
    """0 .. for the values that occur more than once, -1 for the others."""
    found, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    names = np.full(len(found), -1, np.int64)
    names[count > 1] = np.arange(int((count > 1).sum()))
    return names[inverse]


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    """Different rows of some columns, in order."""
    order = np.lexsort(columns[::-1])
    rows = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([np.diff(c) != 0 for c in rows])
    return [c[new] for c in rows]


def _proposals(places: np.ndarray, names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last place and step of the progressions of equal factors of ``size`` words; those at neighbouring places are joined."""
    order = np.argsort(names, kind="stable")  # places ascend within a name
    at, name = places[order], names[order]
    gap = np.where(name[1:] == name[:-1], at[1:] - at[:-1], 0)
    near = (gap > 0) & (gap <= 2 * size)
    twice = near[1:] & (gap[1:] == gap[:-1]) & (gap[1:] <= size)  # larger steps: at the next level
    begin, step = at[:-2][twice], gap[:-1][twice]
    step, begin = _distinct(step, begin)
    if not len(begin):
        return begin, begin, step
    new = np.concatenate([[True], (np.diff(begin) > 1) | (np.diff(step) > 0)])
    last = np.concatenate([new[1:], [True]])
    return begin[new], begin[last] + 2 * step[last] + size - 1, step[new]


def find_runs(words: np.ndarray, text: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of at least ``least`` words and ``times`` periods, by start and period.

    ``words``: a number for each word, for texts end to end; ``text``: the number of each word's text, ascending.
    """
    if times < 4:
        raise ValueError("runs have at least four periods here")
    n = len(words)
    top = int(words.max()) + 1 if n else 1
    names = _names(text.astype(np.int64) * top + words)
    places = np.flatnonzero(names >= 0)
    names, size, parts = names[places], 1, []
    while len(places):
        parts.append(_proposals(places, names, size))
        # The factor twice as long at a place: the names of its halves, both of which occur more than once.
        whole = np.full(n + size, -1, np.int64)
        whole[places] = names
        after = whole[places + size]
        ok = after >= 0
        places, keys = places[ok], names[ok] * (int(names.max()) + 1) + after[ok]
        names = _names(keys)
        places, names = places[names >= 0], names[names >= 0]
        size *= 2
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    start, last, period = (np.concatenate(x) for x in zip(*parts, strict=True))
    start, period, last = _distinct(start, period, last)
    ends = np.append(np.flatnonzero(np.diff(text)) + 1, n)
    of = np.searchsorted(ends, start, "right")
    low, high = np.append(0, ends)[of], ends[of]
    # Extend word by word, all stretches at once, until the word a period away differs or the text ends.
    open_ = np.flatnonzero(start > low)
    while len(open_):
        s = start[open_] - 1
        open_ = open_[words[s] == words[s + period[open_]]]
        start[open_] -= 1
        open_ = open_[start[open_] > low[open_]]
    open_ = np.flatnonzero(last + 1 < high)
    while len(open_):
        e = last[open_] + 1
        open_ = open_[words[e] == words[e - period[open_]]]
        last[open_] += 1
        open_ = open_[last[open_] + 1 < high[open_]]
    length = last + 1 - start
    enough = length >= np.maximum(least, times * period)
    start, period, length = _distinct(start[enough], period[enough], length[enough])
    return start, length, period


def _collapse(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [c for c in batch.schema.names if c != "__text"]
        for part in slices(batch, "__text", SLICE):
            raw, at = text_bytes(part.column(part.schema.get_field_index("__text")))
            begin, end, text = word_spans(raw, at)
            data, known = raw.tobytes(), {}
            spelt = [data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            words = np.fromiter((known.setdefault(w, len(known)) for w in spelt), np.int64, len(spelt))
            first = np.searchsorted(text, np.arange(part.num_rows + 1))
            start, length, period = find_runs(words, text, least, times)
            # A word goes if a run has it after the run's first period.
            steps = np.zeros(len(words) + 1, np.int64)
            np.add.at(steps, start + period, 1)
            np.add.at(steps, start + length, -1)
            gone = np.cumsum(steps[:-1]) > 0
            kept = [w for w, g in zip(spelt, gone.tolist(), strict=True) if not g] if gone.any() else spelt
            left = (first - np.concatenate([[0], np.cumsum(gone)])[first]).tolist()
            collapsed = pa.array([b" ".join(kept[a:b]) for a, b in zip(left, left[1:], strict=False)], pa.binary()).cast(pa.string())
            of = text[start] if len(start) else start
            runs = pa.StructArray.from_arrays([pa.array(start - first[of]), pa.array(length), pa.array(period)], fields=list(RUN))
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)), pa.int32()), runs)
            yield pa.record_batch([*[part.column(c) for c in rest], pa.array(np.diff(first)), lists, collapsed], [*rest, *NEW])


def collapse_runs(df: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The columns of ``df`` but its text, with n_words, runs (start, length, period; by start, then period) and collapsed: the words of the text
    but those that a run repeats, joined by one space."""
    rest = [c for c in df.columns if c not in (*NEW, text)]
    rows = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias("__text"))
    kinds = "".join(f"`{c}` {kind}, " for c, kind in rows.dtypes if c != "__text")
    schema = f"{kinds}n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(lambda it: _collapse(it, least, times), schema)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of one text in ten repeat from some word on with some period, both of which doc_id gives (null: none)."""
    words = F.filter(F.split("text", WORD.replace("[^", "[")), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("__h"))
    rows = rows.withColumn("__words", F.when(F.col("__h") % 10 == 0, words)).withColumn("__n", F.size("__words").cast("long")).withColumn("__g", F.expr("__h div 10"))
    rows = rows.withColumn("__a", F.expr("if(__n > 0, __g % __n, null)")).withColumn("__p", F.expr("1 + (__n - __a) div (3 + __g % 8)"))
    again = F.expr("slice(flatten(array_repeat(slice(__words, int(__a + 1), int(__p)), int((__n - __a) div __p + 1))), 1, int(__n - __a))")
    text = F.when(F.col("__a").isNotNull(), F.concat_ws(" ", F.slice("__words", F.lit(1), F.col("__a").cast("int")), again)).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each text, after the planting of repeats that the query fixes."""
    found = collapse_runs(planted(documents(spark, sf_dir)))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    # The longest; of equal ones the first start, then the least period: the least of negated lengths.
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("__best"), lines.alias("__lines"), "collapsed")
    length, period = -F.col("__best.l"), F.col("__best.p")
    return found.select(
        "doc_id", "n_runs", F.col("__best.s").alias("start"), length.alias("length"), period.alias("period"), F.expr("(-1000 * __best.l) div __best.p").alias("exponent_milli"),
        F.sha2(F.col("__lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op12_periodic": op12_periodic}
ORACLE: dict[str, str] = {}
