"""Periodic stretches of words: runs whose period repeats at least four times.

A run is a stretch of consecutive words with smallest period q (words q apart are the same) of at least
max(``shortest``, ``turns`` * q) words that no neighbouring word extends keeping q.

* Periods up to ``direct`` are looked for by comparing all words with those q further on.
* Longer ones come from minimizers at scales P = direct, 2 * direct, 4 * direct and so on, each for periods from P + 1 to
  2 * P. A scale hashes every 2 * P consecutive words and takes the least hash of every P consecutive places. Inside
  a run, a chosen place is chosen again q words on, and as 2 * P words hold a whole period, their hash doesn't come back
  before that. So neighbouring places of one hash that are P + 1 to 2 * P apart include every run; such pairs are
  extended word by word, and what is too short, or has a smaller period, is dropped.

All documents of some megabytes are worked on together, a scale by those that are long enough for it. Words are
told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm import textbytes as T
from panelwright.llm import wordspans as S

U64 = np.uint64
CHUNK = 1 << 21
SPACES = S.table((9, 10, 11, 12, 13, 32))
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` consecutive values, width a power of two."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def minimizer_pairs(words: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance): neighbouring minimizers of equal hash, scale + 1 to 2 * scale apart."""
    length = 2 * scale
    with np.errstate(over="ignore"):
        power = T._table("power", T._BASE, len(words) + 1)[:len(words) + 1]
        inverse = T._table("inverse", T._INVERSE, len(words) + 1)
        total = np.append(U64(0), np.cumsum(words * power[:-1], dtype=U64))
        value = T.mix((total[length:] - total[:-length]) * inverse[:len(words) - length + 1])
    if len(value) < scale:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = sliding(value, scale, np.minimum)
    # A place is chosen if some window around it has its hash for the least one.
    edge = np.zeros(scale - 1, U64)
    chosen = np.flatnonzero(sliding(np.concatenate((edge, least, edge)), scale, np.maximum) == value)
    own = value[chosen]
    order = np.argsort(own, kind="stable")
    own, at = own[order], chosen[order]
    apart = at[1:] - at[:-1]
    good = (own[1:] == own[:-1]) & (apart > scale) & (apart <= length)
    return at[:-1][good], apart[good]


def first_difference(a: np.ndarray, b: np.ndarray) -> int:
    """How many words agree from the start."""
    done, step = 0, 64
    while done < len(a):
        differ = a[done:done + step] != b[done:done + step]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + step, step * 4
    return len(a)


def primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of at least two periods has no smaller one."""
    two, rest, prime = words[start:start + 2 * period], period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            smaller = period // prime
            if np.array_equal(two[smaller:], two[:-smaller]):
                return False
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return True


def find_runs(words: np.ndarray, doc: np.ndarray, bound: np.ndarray, shortest: int, turns: int,
              direct: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, ordered by start, then period.

    ``words`` are those of several documents in a row, ``doc`` says whose, and document i has the places from
    bound[i] to bound[i + 1].
    """
    found = []
    size = np.diff(bound)
    for period in range(1, direct + 1):
        if len(words) <= period or size.max(initial=0) < turns * period:
            break
        same = (words[period:] == words[:-period]) & (doc[period:] == doc[:-period])
        stops = np.concatenate(([-1], np.flatnonzero(~same), [len(same)]))
        length = np.diff(stops) - 1
        for k in np.flatnonzero(length >= max(shortest, turns * period) - period).tolist():
            start = int(stops[k]) + 1
            if primitive(words, start, period):
                found.append((start, int(length[k]) + period, period))
    scale = direct
    while size.max(initial=0) >= turns * (scale + 1):
        long = np.flatnonzero(size >= turns * (scale + 1))
        place = S.ranges(bound[long], size[long])
        at, apart = minimizer_pairs(words[place], scale)
        at = place[at]
        order = np.lexsort((at, apart))
        beyond, period_now = -1, 0
        for start, period in zip(at[order].tolist(), apart[order].tolist()):
            if period != period_now:
                beyond, period_now = -1, period
            low, high = int(bound[doc[start]]), int(bound[doc[start] + 1])
            if start < beyond or start + period >= high:
                continue
            ahead = first_difference(words[start:high - period], words[start + period:high])
            back = first_difference(words[low:start][::-1], words[low + period:start + period][::-1])
            beyond = start + ahead
            length = ahead + back + period
            if length >= max(shortest, turns * period) and primitive(words, start - back, period):
                found.append((start - back, length, period))
        scale *= 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def periodic_runs(docs: DataFrame, shortest: int = 6, turns: int = 4, direct: int = 32) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, runs, collapsed.

    ``runs`` are (start, length, period) in words, by start, then period. ``collapsed`` are the words joined by one blank,
    without those that lie in a run behind its first period. Words are ``[^\\x20\\x09-\\x0D]+``, upper and
    lower case differ. A null, empty or blank text has no word and an empty ``collapsed``. Null or repeated doc_ids
    are kept as they are; other columns are ignored; an empty table gives no rows. ``turns`` must be 4 or more.
    """
    if turns < 4:
        raise ValueError("minimizers of these scales meet in stretches of four periods or more")

    def run(batches):
        for batch in batches:
            data, offsets = T.buffers(batch["text"])
            for first, last in T.chunks(offsets, CHUNK):
                part, own = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
                start, end, doc = S.bounds(part, own, SPACES)
                bound = np.searchsorted(doc, np.arange(last - first + 1))
                runs = np.array(find_runs(S.hashes(part, start, end), doc, bound, shortest, turns, direct),
                                np.int64).reshape(-1, 3)
                inside = np.zeros(len(start) + 1, np.int64)
                np.add.at(inside, runs[:, 0] + runs[:, 2], 1)
                np.add.at(inside, runs[:, 0] + runs[:, 1], -1)
                kept = np.flatnonzero(np.cumsum(inside[:-1]) == 0)
                owner = doc[kept]
                text, ends = S.joined(part, start[kept], end[kept], np.append(owner[1:] != owner[:-1], True)[:len(kept)])
                ends = np.append(0, ends)[np.searchsorted(owner, np.arange(last - first + 1))]
                whose = doc[runs[:, 0]] if len(runs) else runs[:, 0]
                parts = [runs[:, 0] - bound[whose], runs[:, 1], runs[:, 2]]
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"][first:last], pa.array(np.diff(bound).astype(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(whose, np.arange(last - first + 1)), pa.int32()),
                        pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in parts], ["start", "length", "period"])),
                    pa.LargeBinaryArray.from_buffers(pa.large_binary(), last - first, [
                        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text)]).cast(pa.large_string()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def with_repetitions(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where every tenth document, by the checksum h of its doc_id, gets a periodic end.

    Its words from a = floor(h / 10) % n on become the first p of them over and over, p = 1 + floor((n - a) / (3 + floor(h / 10) % 8)).
    Documents without words or doc_id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    marked = docs.withColumn("_words", words).withColumn("_n", F.size("_words")).withColumn("_g", F.floor(h / 10))
    marked = marked.withColumn("_a", F.when(F.col("_n") > 0, (F.col("_g") % F.col("_n")).cast("int")))
    marked = marked.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)).cast("int"))
    again = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.get("_words", F.when(
        i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))))
    return marked.select("doc_id", F.when(F.col("_n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period; nulls if there is none) and checksums."""
    def largest(of: Column) -> Column:
        best = F.array_min(F.transform(of, lambda r: F.struct(
            (-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
        return F.when(F.size(of) > 0, best)

    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("_best", largest(F.col("runs")))
    length, period = -F.col("_best")["length"], F.col("_best")["period"]
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best")["start"].alias("start"),
        length.alias("length"), period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
