"""Toxicity by class-conditional Kneser-Ney models of how words are spelt.

Every word, with a boundary on either side, is a run of bytes. Two models, of toxic and of ordinary training
texts, give each byte a probability after up to ``ORDER - 1`` bytes of its word. The longest context has counts
of its class; shorter ones are shared by both classes and count in how many ways an expression continues others
(Kneser-Ney continuation counts). So a rare expression gets nearly the same probability from both, and one that
is common in toxic texts stands out, also by its stem alone.

A text's length-normalised log-likelihood ratio, and the same over its strongest window of words, go through a
logistic calibration fitted on training texts that the counts don't include.

Counts are exact and nowhere gathered as a whole. A run of up to ``ORDER`` bytes and its length are one 64-bit
number. Texts go in packs; a pack asks once for each of its distinct runs. All that the probability of a run
needs is counted from runs with the same two bytes before the last, so runs and counts meet in ``SHARDS`` groups by
these bytes, and only the shared probabilities after at most one byte, 2**16 values, are the same for all. The
answers go back to the pack. Groups that many packs ask are split, so none holds more than ``ASKERS`` packs' runs.
The runs of a pack are formed and sorted for about ``BLOCK`` bytes of its distinct words at a time.

Packs are by far the most of what is stored. They lie in buckets by their number, so labels and answers come to them
and they are never dealt out again, and a task holds one at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm import textbytes as T
from panelwright.session import store, store_dealt

U64 = np.uint64
ORDER = 7
DISCOUNT = 0.75
WINDOWS = (1, 4, 16)
PACK, SHARDS, ASKERS = 1 << 23, 256, 256
BLOCK = 1 << 18


def remainder(doc_id: Column, by: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def _distinct(data: np.ndarray, words: T.Words):
    """Distinct words, each in boundary bytes: (hashes, bytes, offsets, index of each word among them)."""
    value, first, index = np.unique(words.hash, return_index=True, return_inverse=True)
    start, end = words.start[first], words.end[first]
    size = end - start + 2
    offsets = np.concatenate(([0], np.cumsum(size)))
    source = np.repeat(start - 1 - offsets[:-1], size) + np.arange(offsets[-1])
    out = T._LOWER[data[np.clip(source, 0, max(len(data) - 1, 0))]] if len(first) else np.zeros(0, np.uint8)
    out[offsets[:-1]] = 32
    out[offsets[1:] - 1] = 32
    return value, out, offsets, index


def _pressed(values: np.ndarray, level: int = 3) -> bytes:
    """Numbers as differences, byte by byte, compressed."""
    values = np.diff(values, prepend=values.dtype.type(0)) if values.dtype.kind == "i" else values
    raw = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + (pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True) if raw else b"")


def _restored(data: bytes, dtype) -> np.ndarray:
    dtype, size = np.dtype(dtype), int.from_bytes(data[:8], "little")
    if not size:
        return np.zeros(0, dtype)
    raw = np.frombuffer(pa.decompress(data[8:], size, codec="zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(raw.reshape(dtype.itemsize, -1).T).view(dtype)[:, 0]
    return np.cumsum(values, dtype=dtype) if dtype.kind == "i" else values


def _runs(data: np.ndarray, offsets: np.ndarray):
    """The longest run that ends at each place but a word's first, and the word of each place."""
    size = np.diff(offsets)
    depth = np.minimum(np.arange(len(data)) - np.repeat(offsets[:-1], size), ORDER).astype(np.int8)
    run = np.minimum(depth + 1, ORDER).astype(np.int64)
    run <<= 56
    run |= data
    for n in range(1, min(ORDER, len(data))):
        part = data[:-n].astype(np.int64)
        part <<= 8 * n
        part[depth[n:] < n] = 0
        run[n:] |= part
    inner = depth > 0
    return run[inner], np.repeat(np.arange(len(size), dtype=np.int32), size)[inner]


def _cut(run: np.ndarray, length: int) -> np.ndarray:
    return run & ((1 << 8 * length) - 1)


def _blocks(data: np.ndarray, offsets: np.ndarray):
    """Of some distinct words at a time: (distinct runs, index of each run among them, its word, range of the words)."""
    for first, last in T.chunks(offsets, BLOCK):
        run, word = _runs(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        value, index = np.unique(run, return_inverse=True)
        yield value, index.astype(np.int32), word, slice(first, last)


def _by_shard(value: np.ndarray):
    """(order of distinct runs by shard and value, bounds of the shards); ``value`` is sorted."""
    shard = (T.mix(_cut(value >> 8, 2).astype(U64)) % U64(SHARDS)).astype(np.int16)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(SHARDS + 1))


def _all_runs(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.int64), *parts]))


PACKS = "doc_ids array<long>, sizes binary, spelt binary, index binary, rare binary"
COMMON = 255


def _begins(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first eight bytes of each word, as a number that sorts like them."""
    out = np.zeros(len(start), U64)
    for k in range(8):
        out <<= U64(8)
        inside = np.flatnonzero(length > k)
        out[inside] |= data[start[inside] + k]
    return out


def packs(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text), about ``PACK`` bytes of text in each pack.

    A pack has the number of words of each row, its distinct words, and the number of each word among them: common
    words come first, so one byte tells most of them, and others, by their spelling, are told by ``rare``.
    """

    def pack(parts):
        ids, sizes, values, spelt, lengths, index = zip(*parts)
        base = np.cumsum([0, *map(len, values)])
        _, first, among = np.unique(np.concatenate(values), return_index=True, return_inverse=True)
        length, data = np.concatenate(lengths), np.concatenate(spelt)
        start = np.cumsum(length) - length
        index = np.concatenate([among[i + b] for i, b in zip(index, base)])
        begin, length = start[first], length[first]
        order = np.lexsort((_begins(data, begin, length), -np.bincount(index, minlength=len(first))))
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        index = rank[index]
        # Each word without its first boundary byte.
        begin, length = begin[order] + 1, length[order] - 1
        places = np.concatenate(([0], np.cumsum(length)))
        data = data[np.repeat(begin - places[:-1], length) + np.arange(places[-1])]
        ids = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            *(pa.array([_pressed(x, 9)], pa.binary()) for x in (
                np.concatenate(sizes), data, np.minimum(index, COMMON).astype(np.uint8), index[index >= COMMON]))],
            ["doc_ids", "sizes", "spelt", "index", "rare"])

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            data, offsets = T.buffers(batch["text"])
            for first, last in T.chunks(offsets, 1 << 20):
                part, own = data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
                found = T.words(part, own)
                value, spelt, places, index = _distinct(part, found)
                bounds = np.searchsorted(found.text, np.arange(last - first + 1))
                parts.append((batch["doc_id"][first:last], np.diff(bounds), value, spelt, np.diff(places), index))
                size += len(part)
                if size >= PACK or sum(len(p[0]) for p in parts) >= 1 << 20:
                    yield pack(parts)
                    parts, size = [], 0
        if parts:
            yield pack(parts)

    return docs.select("doc_id", "text").mapInArrow(run, PACKS).withColumn("owner", F.monotonically_increasing_id())


def _unpacked(pack: pa.Table):
    """Of a pack's one row: (words of each row, bytes of the distinct words, their offsets, index)."""
    row, = pack.select(["sizes", "spelt", "index", "rare"]).to_pylist()
    data = _restored(row["spelt"], np.uint8)
    size = np.diff(np.flatnonzero(data == 32), prepend=-1) + 1
    offsets = np.concatenate(([0], np.cumsum(size)))
    inner = np.ones(offsets[-1], dtype=bool)
    inner[offsets[:-1]] = False
    spelt = np.full(offsets[-1], 32, np.uint8)
    spelt[inner] = data
    index = _restored(row["index"], np.uint8).astype(np.int64)
    index[index == COMMON] = _restored(row["rare"], np.uint32)
    return _restored(row["sizes"], np.int64), spelt, offsets, index


def run_counts(packed: DataFrame, labels: DataFrame) -> DataFrame:
    """(shard, runs, toxic, ordinary): counts of the runs in rows that ``labels`` (doc_id, toxic) has; a row per shard."""

    def parts(pack: pa.Table, marks: pa.Table) -> pa.Table:
        if not len(pack) or not len(marks):
            return pa.table([pa.array([], t) for t in (pa.int32(), *[pa.binary()] * 3)], names)
        sizes, spelt, offsets, index = _unpacked(pack)
        label = np.full(len(sizes), -1, np.int8)
        label[marks["row"].to_numpy()] = marks["toxic"].to_numpy()
        label = np.repeat(label, sizes)
        by_word = [np.bincount(index[label == k], minlength=len(offsets) - 1) for k in (1, 0)]
        del label, index
        found = []
        for value, at, word, part in _blocks(spelt, offsets):
            count = [np.bincount(at, b[part][word], len(value)).astype(np.int64) for b in by_word]
            seen = count[0] + count[1] > 0
            found.append([x[seen] for x in (value, *count)])
        value, *count = _summed(found)
        order, bounds = _by_shard(value)
        value, count = value[order], [x[order] for x in count]
        full = np.flatnonzero(np.diff(bounds)).tolist()
        return pa.table([pa.array(full, pa.int32()), *(pa.array(
            [_pressed(x[bounds[k]:bounds[k + 1]]) for k in full], pa.binary()) for x in (value, *count))], names)

    def total(table: pa.Table) -> pa.Table:
        value, toxic, ordinary = _counts(table)
        return pa.table([table["shard"].slice(0, 1), *(pa.array([_pressed(x)], pa.binary()) for x in (value, toxic, ordinary))],
                        names)

    names, schema = ["shard", "runs", "toxic", "ordinary"], "shard int, runs binary, toxic binary, ordinary binary"
    # Only ids meet the labels, not texts.
    marks = packed.select(F.col("owner").alias("owner"), F.posexplode("doc_ids").alias("row", "doc_id")).join(labels, "doc_id").select("owner", "row", "toxic")
    return packed.drop("doc_ids").groupBy("owner").cogroup(marks.groupBy("owner")).applyInArrow(parts, schema).groupBy(
        "shard").applyInArrow(total, schema)


def _counts(table: pa.Table):
    """Distinct runs of all rows and the sums of their counts."""
    if not len(table):
        return (np.zeros(0, np.int64),) * 3
    return _summed(list(zip(*([_restored(x, np.int64) for x in table[c].to_pylist()] for c in ("runs", "toxic", "ordinary")))))


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    every = [np.concatenate(x) for x in zip(*parts)]
    value, at = np.unique(every[0], return_inverse=True)
    return value, *(np.bincount(at, x, len(value)).astype(np.int64) for x in every[1:])


def short_runs(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shared probabilities of a byte alone, and after each byte: 2**8 and 2**16 values."""

    def run(batches):
        for batch in batches:
            for x in batch["runs"].to_pylist():
                runs = _restored(x, np.int64)
                long = _cut(np.unique(_cut(runs[runs >> 56 >= 3], 3)), 2)
                pair, at = np.unique(np.concatenate((long, _cut(runs[runs >> 56 == 2], 2))), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(np.bincount(at[:len(long)], minlength=len(pair)))],
                                                 ["pair", "n"])

    rows = counts.select("runs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pair, n = rows["pair"].to_numpy(), rows["n"].to_numpy()
    one = np.bincount(pair & 255, minlength=256)
    two = np.zeros(1 << 16, np.int64)
    two[pair] = n
    alone = np.full(256, 1 / 257)
    if one.sum():
        alone = (np.maximum(one - DISCOUNT, 0) + DISCOUNT * (one > 0).sum() / 257) / one.sum()
    grid = two.reshape(256, 256)
    total, kinds = grid.sum(axis=1, keepdims=True), (grid > 0).sum(axis=1, keepdims=True)
    after = (np.maximum(grid - DISCOUNT, 0) + DISCOUNT * kinds * alone) / np.maximum(total, 1)
    return alone, np.where(total > 0, after, alone).reshape(-1)


def _found(known: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Values of the wanted among the known ones, which are sorted; 0 for others."""
    if not len(known):
        return [np.zeros(len(wanted), np.int64)] * len(values)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return [np.where(known[at] == wanted, v[at], 0) for v in values]


def ratios(wanted: np.ndarray, runs: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, alone: np.ndarray,
           after: np.ndarray) -> np.ndarray:
    """Log of the toxic over the ordinary probability of the last byte of each wanted run.

    ``runs`` are distinct and hold all that share their last context of two bytes with a wanted one.
    """
    size = wanted >> 56
    shared = np.where(size == 2, alone[_cut(wanted, 1)], after[_cut(wanted, 2)])
    for n in range(3, ORDER):
        longer = np.unique(_cut(runs[runs >> 56 > n], n + 1))
        gram, ways = np.unique(_cut(longer, n), return_counts=True)
        context, first = np.unique(gram >> 8, return_index=True)
        totals = np.add.reduceat(ways, first) if len(first) else ways
        kinds = np.diff(np.append(first, len(gram)))
        here = np.flatnonzero(size > n)
        key = _cut(wanted[here], n)
        own, = _found(gram, key, ways)
        total, kind = _found(context, key >> 8, totals, kinds)
        value = (np.maximum(own - DISCOUNT, 0) + DISCOUNT * kind * shared[here]) / np.maximum(total, 1)
        shared[here] = np.where(total > 0, value, shared[here])
    outer = lambda x: (x >> 56 << 56) | (_cut(x, ORDER) >> 8)
    context, at = np.unique(outer(runs), return_inverse=True)
    p = []
    for count in (toxic, ordinary):
        total, kind = _found(context, outer(wanted), np.bincount(at, count, len(context)),
                             np.bincount(at, count > 0, len(context)))
        own, = _found(runs, wanted, count)
        value = (np.maximum(own - DISCOUNT, 0) + DISCOUNT * kind * shared) / np.maximum(total, 1)
        p.append(np.where(total > 0, value, shared))
    return np.log(np.maximum(p[0], 1e-12)) - np.log(np.maximum(p[1], 1e-12))


FEATURES = ["words", "mean", *(f"peak_{w}" for w in WINDOWS)]


def answers(packed: DataFrame, counts: DataFrame) -> DataFrame:
    """(owner, shard, ratios): for each pack, the ratios of its distinct runs by shard, in the order of ``_by_shard``."""
    split = -(-packed.count() // ASKERS)
    small = packed.sparkSession.sparkContext.broadcast(short_runs(counts))

    def ask(pack: pa.Table) -> pa.Table:
        _, spelt, offsets, _ = _unpacked(pack)
        value = _all_runs([value for value, *_ in _blocks(spelt, offsets)])
        order, bounds = _by_shard(value)
        value, full = value[order], np.flatnonzero(np.diff(bounds))
        return pa.table([
            pa.array(np.full(len(full), pack["owner"][0].as_py())), pa.array(full, pa.int32()),
            pa.array([_pressed(value[bounds[k]:bounds[k + 1]]) for k in full.tolist()], pa.binary())],
            ["owner", "shard", "asked"])

    def answer(asks: pa.Table, known: pa.Table) -> pa.Table:
        asked = [_restored(x, np.int64) for x in asks["asked"].to_pylist()]
        if not asked:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.binary())], ["owner", "shard", "ratios"])
        wanted, at = np.unique(np.concatenate(asked), return_inverse=True)
        found = ratios(wanted, *_counts(known), *small.value).astype(np.float32)
        bounds = np.cumsum([0, *map(len, asked)])
        return pa.table([asks["owner"], asks["shard"], pa.array(
            [_pressed(found[at[a:b]]) for a, b in zip(bounds, bounds[1:])], pa.binary())], ["owner", "shard", "ratios"])

    asks = packed.drop("doc_ids").groupBy("owner").applyInArrow(
        ask, "owner long, shard int, asked binary").withColumn("part", F.pmod(F.xxhash64("owner"), F.lit(max(split, 1))))
    known = counts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(split, 1) - 1).cast("long"))))
    return asks.groupBy("shard", "part").cogroup(known.groupBy("shard", "part")).applyInArrow(
        answer, "owner long, shard int, ratios binary")


def features(packed: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, words, mean, peak_w...): ratio per word over the text and over its strongest window of w words."""
    counts = store(run_counts(packed, labels), "run_counts")
    names = ["doc_id", *FEATURES]

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        count, spelt, offsets, index = _unpacked(own)
        blocks = list(_blocks(spelt, offsets))
        runs = _all_runs([value for value, *_ in blocks])
        order, _ = _by_shard(runs)
        by_run = np.empty(len(runs), np.float32)
        by_run[order] = np.concatenate([np.zeros(0, np.float32), *(
            _restored(x, np.float32) for x in found.sort_by("shard")["ratios"].to_pylist())])
        by_word = np.zeros(len(offsets) - 1)
        for value, at, word, part in blocks:
            by_word[part] = np.bincount(word, by_run[np.searchsorted(runs, value)][at], part.stop - part.start)
        del blocks, spelt
        ratio = by_word[index]
        stop_of = np.cumsum(count)
        text = np.repeat(np.arange(len(count)), count)
        total = np.concatenate(([0.0], np.cumsum(ratio)))
        columns = [count, (total[stop_of] - total[stop_of - count]) / np.maximum(count, 1)]
        full = np.flatnonzero(count > 0)
        for w in WINDOWS:
            stop = np.minimum(np.arange(len(ratio)) + w, stop_of[text])
            sums = (total[stop] - total[:-1]) / w
            peak = np.zeros(len(count))
            if len(full):
                peak[full] = np.maximum.reduceat(sums, (stop_of - count)[full])
            columns.append(peak)
        ids = own["doc_ids"].combine_chunks()
        return pa.table([ids.flatten() if isinstance(ids, pa.Array) else ids.chunk(0).flatten(),
                         *(pa.array(c.astype(np.float64)) for c in columns)], names)

    return packed.groupBy("owner").cogroup(answers(packed, counts).groupBy("owner")).applyInArrow(
        run, "doc_id long, " + ", ".join(f"{c} double" for c in FEATURES))


def _design(x: np.ndarray) -> np.ndarray:
    words, rest = x[:, 0], x[:, 1:]
    long = np.log1p(words)
    return np.column_stack([np.ones(len(x)), long, rest, rest[:, 1] * long, rest[:, 0] * np.sqrt(words)])


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps on scaled features: (weights, centres, scales)."""
    design = _design(x)
    centre, scale = design.mean(axis=0), design.std(axis=0)
    centre[0], scale = 0, np.where(scale > 1e-9, scale, 1)
    z = (design - centre) / scale
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w, centre, scale


def scores(docs: DataFrame, labels: DataFrame, sample: int = 50_000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    ``labels`` (doc_id, toxic) counts only where crc32(doc_id) mod 5 is not 0; a label that repeats counts once,
    as the largest, a null one not at all. Of a quarter of the training rows, at most ``sample``, chosen by hash, give
    the calibration; all others give the counts. Without labels of both kinds there, every score is the share
    of toxic ones (one of either added). A null or empty text scores as one without words; rows with null doc_id
    are scored and not held out; repeated rows are scored alike; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    labels = labels.where("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    labels = labels.where(remainder(F.col("doc_id"), 5) != 0)
    order = F.struct(F.xxhash64("doc_id", F.lit(7)).alias("hash"), "doc_id")
    apart = remainder(F.col("doc_id"), 20) < 5
    first = docs.where(apart).select("doc_id").join(labels.where(apart), "doc_id").select(order.alias("order"))
    # The rows before the one after the sample: whole documents, and no more rows than the sample has.
    n, last = first.orderBy("order").limit(sample + 1).agg(F.count("*"), F.max("order")).first()
    if n > sample:
        apart = apart & (order < F.struct(F.lit(last["hash"]).cast("long").alias("hash"), F.lit(last["doc_id"]).cast("long").alias("doc_id")))
    packed = store_dealt(packs(docs), "packs", "owner")
    found = store(features(packed, labels.where(~apart)), "features")
    rows = found.join(labels.where(apart), "doc_id").select("doc_id", *FEATURES, "toxic").toArrow()
    x = np.column_stack([rows[c].to_numpy() for c in FEATURES])
    y = rows["toxic"].to_numpy()
    if 0 < y.sum() < len(y):
        weights, centre, scale = calibrate(x, y)
        long = F.log1p("words")
        rest = [F.col(c) for c in FEATURES[1:]]
        terms = [F.lit(1.0), long, *rest, rest[1] * long, rest[0] * F.sqrt("words")]
        total = sum(((t - F.lit(float(c))) * F.lit(float(w / s)) for t, c, w, s in zip(
            terms, centre, weights, scale)), F.lit(0.0))
        score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))
    else:
        score = F.lit((float(y.sum()) + 1) / (len(y) + 2))
    out = found.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
                       score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
