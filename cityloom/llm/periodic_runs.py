"""Periodic runs of words, found with a dictionary of basic factors.

Level ``k`` of the dictionary names every stretch of ``2**k`` words that occurs more than once in its document:
equal stretches of a document, and no others, have the same name. Occurrences of one name that follow each other
within ``2 * 2**k`` words form arithmetic progressions, and their differences, and the distances from one progression
to the next, are proposed as periods. A proposal is extended to both sides by comparing names from the top level
down, and proposals that grow to the same stretch are one run, whose period is the smallest of them.

All documents of a portion are worked on at once, as one array of words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .common import ship

# Bytes of text that are worked on at once; a longer document is a portion by itself.
PORTION_BYTES = 4_000_000
RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
Rewrite = Callable[[list, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _names(keys: np.ndarray) -> np.ndarray:
    """A number for each distinct key; -1 for keys that occur once."""
    order = np.argsort(keys, kind="stable")
    at = keys[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = at[1:] != at[:-1]
    group = np.cumsum(fresh) - 1
    group = np.where(np.bincount(group, minlength=1)[group] > 1, group, -1)
    names = np.empty(len(keys), np.int32)
    names[order] = group
    return names


def basic_factors(words: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """The levels of the dictionary: per position the name of the stretch of ``2**k`` words that begins there, or -1
    where it occurs once in its document or leaves it. ``words`` are numbers from 0, ``doc`` the document of each."""
    if not len(words):
        return []
    levels = [_names(doc.astype(np.int64) * (int(words.max()) + 1) + words)]
    size = 1
    while True:
        below = levels[-1]
        # Names belong to one document, so a stretch whose halves both have one could only leave it at its seam.
        begins = np.flatnonzero((below[:-size] >= 0) & (below[size:] >= 0) & (doc[:-size] == doc[size:])) if size < len(doc) else np.empty(0, np.int64)
        made = np.full(len(words), -1, np.int32)
        if len(begins):
            pairs = below[begins].astype(np.int64) * (int(below.max()) + 1) + below[begins + size]
            made[begins] = _names(pairs)
        if not (made >= 0).any():
            return levels
        levels.append(made)
        size *= 2


def _proposals(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods, at most ``2 * size``, such that the stretches of ``size`` words at a position and a
    period after it are equal.

    Occurrences at most half their size apart make up a progression, whose difference is their own period. A run with a
    longer period leads from one progression to one after it, from its last occurrence or to the other's last one: if
    neither, both go on and the next occurrences tell of the same run. No more than four lie within twice the size.
    """
    at = np.flatnonzero(names >= 0)
    if not len(at):
        return at, at
    at = at[np.argsort(names[at], kind="stable")]  # by name, then position
    name = names[at]
    gap = np.diff(at)
    linked = (name[1:] == name[:-1]) & (gap <= size // 2)
    of = np.concatenate(([0], np.cumsum(~linked)))
    last = at[np.concatenate((~linked, [True]))]
    whose = names[last]
    places, periods = [at[:-1][linked]], [gap[linked]]
    for step in range(1, 5):
        t = np.flatnonzero(of >= step)
        end = of[t] - step
        t, end = t[whose[end] == name[t]], end[whose[end] == name[t]]
        places.append(last[end])
        periods.append(at[t] - last[end])
        t = np.flatnonzero(of + step < len(last))
        end = of[t] + step
        t, end = t[whose[end] == name[t]], end[whose[end] == name[t]]
        places.append(at[t])
        periods.append(last[end] - at[t])
    place, period = np.concatenate(places), np.concatenate(periods)
    near = period <= 2 * size
    # One position after the other with the same period is one run: the first is enough.
    keys = np.unique(period[near] * (len(names) + 1) + place[near])
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1] + 1))] if len(keys) else keys
    return keys % (len(names) + 1), keys // (len(names) + 1)


def runs_of(words: np.ndarray, doc: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, length, period`` of all runs, by start and period; positions count through all documents."""
    levels = basic_factors(words, doc)
    found: list[tuple[np.ndarray, ...]] = []
    for k, names in enumerate(levels):
        size = 1 << k
        left, period = _proposals(names, size)
        right = left + size
        left = left.copy()
        for j in range(len(levels) - 1, -1, -1):
            step, of = 1 << j, levels[j]
            a, b = right, right + period
            fits = np.flatnonzero(b < len(of))
            fits = fits[(of[a[fits]] >= 0) & (of[a[fits]] == of[b[fits]])]
            right[fits] += step
            a = left - step
            fits = np.flatnonzero(a >= 0)
            a = a[fits]
            left[fits[(of[a] >= 0) & (of[a] == of[a + period[fits]])]] -= step
        length = right + period - left
        enough = np.flatnonzero(length >= np.maximum(least, 2 * period))
        found.append((left[enough], length[enough], period[enough]))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[fresh], length[fresh], period[fresh]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _portion(ids: pa.Array, texts: pa.Array, least: int, rewrite: Rewrite | None) -> pa.RecordBatch:
    lists = pc.split_pattern_regex(pc.fill_null(texts.cast(pa.string()), ""), "[\\x20\\x09-\\x0D]+")
    words, doc = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    some = pc.not_equal(words, "")
    words, doc = words.filter(some), doc[some.to_numpy(zero_copy_only=False)]
    n = np.bincount(doc, minlength=len(ids)) if len(ids) else np.empty(0, np.int64)
    before = np.concatenate(([0], np.cumsum(n)))
    if rewrite is not None and len(words):
        begin, period = rewrite(ids.to_pylist(), n)
        i = np.arange(len(words)) - before[doc]
        a, p = begin[doc], period[doc]
        again = (p > 0) & (i >= a)
        words = words.take(pa.array(before[doc] + np.where(again, a + (i - a) % np.maximum(p, 1), i)))
    codes = words.dictionary_encode().indices.to_numpy() if len(words) else np.empty(0, np.int64)
    start, length, period = runs_of(codes, doc, least)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
    kept_before = np.concatenate(([0], np.cumsum(np.bincount(doc[kept], minlength=len(ids)))))
    kept_words = pa.ListArray.from_arrays(pa.array(kept_before, pa.int32()), words.take(pa.array(kept)))
    of = doc[start] if len(start) else np.empty(0, np.int64)
    runs_before = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(ids)))))
    runs = pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (start - before[of], length, period)],
        fields=[pa.field(f.name, pa.int64(), False) for f in RUN.fields],
    )
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(runs_before, pa.int32()), runs),
         pc.binary_join(kept_words, " ")],
        ["id", "n_words", "runs", "collapsed"],
    )


def find_runs(
    docs: DataFrame, *, least: int = 12, rewrite: Rewrite | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col, n_words, runs, collapsed``: one row per row of ``docs``.

    Words are what ASCII white space parts. ``runs`` has every run (``start``, the number of its first word from 0,
    ``length`` in words, ``period``) by start and period: a stretch of at least ``least`` words and twice its smallest
    period that can't be made longer with that period. ``collapsed`` is the text without the words that any run holds
    after its first period, the others parted by one blank.

    ``rewrite`` may repeat words first: from the ids and numbers of words of some documents it makes two arrays, the
    word from which on the text repeats and the period (0: left as it is).

    Null and empty texts have no words, no runs and an empty ``collapsed``. Each row is worked on by itself, so
    repeated rows and null ids give repeated rows and null ids; other columns are dropped whatever their names. A text
    is worked on as a whole, in one task, in memory of about 4 bytes a word and level that has repeats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            i = 0
            while i < len(ids):
                past = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, past + PORTION_BYTES, side="right")))
                yield _portion(ids[i:j], texts[i:j], least, rewrite)
                i = j

    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    made = T.StructType([rows.schema["id"]]).add("n_words", "long").add("runs", T.ArrayType(RUN, False)).add("collapsed", "string")
    return rows.mapInArrow(run, made).withColumnRenamed("id", id_col)
