"""Removal of byte strings that repeat across documents, by sharded suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts in a document of smaller doc_id. Texts that are
equal as a whole are settled by their digest. For the others:

1. Every window of ``length`` bytes has a minimizer, the smallest hash of its runs of ``GRAM`` bytes; equal
   windows have equal minimizers. Those that occur in one document only are dropped.
2. The rest is cut into segments, maximal runs of windows of one minimizer, and dealt to shards by it. Equal
   segments of one pack of documents travel once.
3. Each shard sorts the suffixes of its segments by induced sorting (``suffixes``). Neighbours whose permuted
   common prefix is ``length`` or more hold one string; its smallest doc_id keeps it.
4. Windows that go are sent back to their documents, where the bytes that they cover are cut out.

Packs hold about ``pack_bytes`` of text. What packs and shards exchange are arrays in binary columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import suffixes as S
from panelwright.llm import textbytes as T
from panelwright.session import store

U64 = np.uint64
GRAM = 16
RUN = 4096
EMPTY = hashlib.sha256(b"").hexdigest()
# What a segment is: the number of its document in the pack, doc_id, first window, bytes; then windows of equal
# segments: the number of the segment, document, doc_id, first window.
SEGMENT = np.dtype([("row", "<i4"), ("doc", "<i8"), ("start", "<i8"), ("size", "<i4")])
ALIAS = np.dtype([("segment", "<i4"), ("row", "<i4"), ("doc", "<i8"), ("start", "<i8")])
SPAN = np.dtype([("row", "<i4"), ("start", "<i8"), ("end", "<i8")])


def runs(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text, start, windows, minimizer) of maximal runs of windows with one minimizer, at most RUN windows each."""
    n, grams = len(data), length - GRAM + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),)
    eight = S.words8(data)
    with np.errstate(over="ignore"):
        low = T.mix(T.mix(eight[:n - GRAM + 1]) + eight[8:n - GRAM + 9] * U64(0x9E3779B97F4A7C15))
    width = 1
    while width * 2 <= grams:
        low = np.minimum(low[:len(low) - width], low[width:])
        width *= 2
    if width < grams:
        low = np.minimum(low[:len(low) - (grams - width)], low[grams - width:])
    # low[i] is the minimizer of the window at i; windows across texts don't count.
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = offsets[text] + inner
    value = low[place]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(place)))
    if (many > RUN).any():
        parts = -(-many // RUN)
        first = np.repeat(first, parts) + RUN * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        many = np.diff(np.append(first, len(place)))
    return text[first], inner[first], many, value[first]


def _shared_minimizers(docs: DataFrame, packs: int, length: int) -> DataFrame:
    """(pack, minimizers binary): those of a pack's documents that occur in more than one document."""

    def collect(batches):
        for batch in batches:
            data, offsets = T.buffers(batch["text"])
            pack = batch["pack"].to_numpy()
            parts = []
            for first, last in T.chunks(offsets, 1 << 20):
                text, _, _, value = runs(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], length)
                # Once per document.
                order = np.lexsort((value, text))
                text, value = text[order], value[order]
                new = np.ones(len(text), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
                if len(text):
                    parts.append((pack[first + text[new]], value[new]))
            if not parts:
                continue
            pack_of, value = (np.concatenate(x) for x in zip(*parts))
            bucket = ((value >> U64(32)) * U64(packs) >> U64(32)).astype(np.int64)
            order = np.lexsort((value, bucket, pack_of))
            pack_of, bucket, value = pack_of[order], bucket[order], value[order]
            new = np.ones(len(value), dtype=bool)
            new[1:] = (pack_of[1:] != pack_of[:-1]) | (value[1:] != value[:-1])
            first = np.flatnonzero(new)
            twice = np.diff(np.append(first, len(value))) > 1
            pack_of, bucket, value = pack_of[first], bucket[first], value[first]
            edge = np.flatnonzero(np.concatenate(([True], (pack_of[1:] != pack_of[:-1]) | (bucket[1:] != bucket[:-1]))))
            stop = np.append(edge[1:], len(value))
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[edge]), pa.array(pack_of[edge].astype(np.int64)),
                pa.array([value[a:b].tobytes() for a, b in zip(edge, stop)], pa.binary()),
                pa.array([np.packbits(twice[a:b]).tobytes() for a, b in zip(edge, stop)], pa.binary())],
                ["bucket", "pack", "minimizers", "twice"])

    def shared(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, U64) for x in table["minimizers"].to_pylist()]
        twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(s)).astype(bool)
                 for x, s in zip(table["twice"].to_pylist(), sets)]
        every = np.sort(np.concatenate([*sets, *(s[t] for s, t in zip(sets, twice))]))
        several = np.unique(every[1:][every[1:] == every[:-1]])
        joined = np.concatenate(sets)
        spot = np.searchsorted(several, joined)
        there = np.append(several, U64(0))[spot] == joined
        there &= spot < len(several)
        bounds = np.cumsum([0, *map(len, sets)])
        found = [s[there[a:b]] for s, a, b in zip(sets, bounds, bounds[1:])]
        kept = [i for i, x in enumerate(found) if len(x)]
        return pa.table({"pack": table["pack"].take(pa.array(kept, pa.int64())),
                         "minimizers": pa.array([found[i].tobytes() for i in kept], pa.binary())})

    return docs.mapInArrow(collect, "bucket long, pack long, minimizers binary, twice binary").groupBy("bucket").applyInArrow(
        shared, "pack long, minimizers binary")


def _ordered(table: pa.Table, chosen: pa.Table) -> pa.Table:
    """A pack's documents in their order: by doc_id and text, each once, those that ``chosen`` names in ``ids``."""
    ids = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for x in chosen["ids"].to_pylist() if x)]))
    table = table.filter(pa.array(np.isin(table["doc_id"].to_numpy(), ids)))
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    if len(table) > 1:
        ids = table["doc_id"].to_numpy()
        again = np.zeros(len(ids), dtype=bool)
        for i in np.flatnonzero(ids[1:] == ids[:-1]).tolist():
            again[i + 1] = table["text"][i + 1] == table["text"][i]
        table = table.filter(pa.array(~again))
    return table


def _segments(shards: int, length: int):
    def run(table: pa.Table, chosen: pa.Table) -> pa.Table:
        table = _ordered(table, chosen)
        known = np.unique(np.concatenate([np.zeros(0, U64), *(np.frombuffer(x, U64) for x in chosen["minimizers"].to_pylist() if x)]))
        out: dict[int, list] = {}
        if len(table) and len(known):
            data, offsets = T.buffers(table["text"])
            doc = table["doc_id"].to_numpy()
            parts = []
            for first, last in T.chunks(offsets, 1 << 20):
                text, start, many, value = runs(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], length)
                keep = known[np.minimum(np.searchsorted(known, value), len(known) - 1)] == value
                parts.append((text[keep] + first, start[keep], many[keep], value[keep]))
            row, start, many, value = (np.concatenate(x) for x in zip(*parts))
            low = offsets[row] + start
            size = many + length - 1
            mark = T.mix(T.hashes(data, low, low + size) ^ value) if len(low) else value
            # The first of equal segments stands for all; documents come by doc_id, so its own is the smallest.
            _, own, same = np.unique(mark, return_index=True, return_inverse=True)
            lead = own[same]
            shard = ((T.mix(value) >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)
            for s, part in _split(shard):
                leads = part[lead[part] == part]
                rest = part[lead[part] != part]
                segments = np.zeros(len(leads), SEGMENT)
                segments["row"], segments["doc"] = row[leads], doc[row[leads]]
                segments["start"], segments["size"] = start[leads], size[leads]
                aliases = np.zeros(len(rest), ALIAS)
                aliases["segment"] = np.searchsorted(leads, lead[rest])
                aliases["row"], aliases["doc"], aliases["start"] = row[rest], doc[row[rest]], start[rest]
                taken = np.repeat(low[leads] - (np.cumsum(size[leads]) - size[leads]), size[leads]) + np.arange(size[leads].sum())
                out[s] = [data[taken].tobytes(), segments.tobytes(), aliases.tobytes()]
        pack = chosen["pack"][0].as_py() if len(chosen) else 0
        return pa.table({"shard": pa.array(list(out), pa.int64()), "pack": pa.array([pack] * len(out), pa.int64()),
                         **{n: pa.array([x[k] for x in out.values()], pa.binary())
                            for k, n in enumerate(("bytes", "segments", "aliases"))}})
    return run


def _split(key: np.ndarray):
    """(value, places in order) for each value of an array."""
    order = np.argsort(key, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1]))) if len(key) else []
    for a, b in zip(edges, np.append(edges[1:], len(key)) if len(key) else []):
        yield int(key[order[a]]), order[a:b]


def _settle(length: int):
    """For one shard: the windows that go, by pack."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pack")
        segments = [np.frombuffer(x, SEGMENT) for x in table["segments"].to_pylist()]
        aliases = [np.frombuffer(x, ALIAS).copy() for x in table["aliases"].to_pylist()]
        source = np.repeat(np.arange(len(segments)), [len(x) for x in segments])
        alias_source = np.repeat(np.arange(len(aliases)), [len(x) for x in aliases])
        before = np.cumsum([0, *(len(x) for x in segments)])
        for a, n in zip(aliases, before):
            a["segment"] += n
        segment, alias = np.concatenate(segments), np.concatenate(aliases)
        size = segment["size"].astype(np.int64)
        # One text with a zero byte after every segment; windows never reach it.
        start = np.cumsum(size + 1) - (size + 1)
        joined = np.zeros(int((size + 1).sum()), np.uint8)
        raw = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8)
        joined[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())] = raw
        order = S.suffix_array(joined, length)
        many = size - length + 1
        inside = np.arange(len(joined)) - np.repeat(start, size + 1)
        owner = np.repeat(np.arange(len(segment)), size + 1)
        order = order[(inside < np.repeat(many, size + 1))[order]]
        plcp = S.common_prefixes(joined, order, length)
        new = np.concatenate(([True], plcp[order[1:]] < length))
        doc = np.repeat(segment["doc"], size + 1)[order]
        least = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1]
        goes = np.zeros(len(joined), dtype=bool)
        goes[order] = least < doc
        spans, packs = [], []
        # Windows of the segments themselves, and of equal segments of the same document.
        edge = np.diff(np.concatenate(([0], goes.astype(np.int8), [0])))
        low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        own = owner[low]
        spans.append((segment["row"][own], segment["start"][own] + inside[low], segment["start"][own] + inside[high - 1] + length))
        packs.append(source[own])
        twin = alias["doc"] == segment["doc"][alias["segment"]]
        other = alias[~twin]
        spans.append((other["row"], other["start"], other["start"] + size[other["segment"]]))
        packs.append(alias_source[~twin])
        first, last = np.searchsorted(own, alias["segment"], "left"), np.searchsorted(own, alias["segment"], "right")
        for k in np.flatnonzero(twin & (last > first)).tolist():
            a, part = alias[k], slice(first[k], last[k])
            spans.append((np.full(last[k] - first[k], a["row"]), a["start"] + inside[low[part]], a["start"] + inside[high[part] - 1] + length))
            packs.append(np.full(last[k] - first[k], alias_source[k]))
        every = np.zeros(sum(len(x[0]) for x in spans), SPAN)
        for n, name in enumerate(("row", "start", "end")):
            every[name] = np.concatenate([x[n] for x in spans])
        number = table["pack"].to_numpy()[np.concatenate(packs)]
        parts = list(_split(number))
        return pa.table({"pack": pa.array([p for p, _ in parts], pa.int64()),
                         "spans": pa.array([every[i].tobytes() for _, i in parts], pa.binary())})
    return run


def _cut(table: pa.Table, chosen: pa.Table) -> pa.Table:
    """Documents of a pack that lose bytes: what is left of them."""
    table = _ordered(table, chosen)
    spans = np.concatenate([np.zeros(0, SPAN), *(np.frombuffer(x, SPAN) for x in chosen["spans"].to_pylist() if x)])
    data, offsets = T.buffers(table["text"])
    doc = table["doc_id"].to_numpy()
    out: dict[str, list] = {"doc_id": [], "whole_sha256": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
    for row, part in _split(spans["row"]):
        text = data[offsets[row]:offsets[row + 1]]
        depth = np.zeros(len(text) + 1, np.int64)
        np.add.at(depth, spans["start"][part], 1)
        np.add.at(depth, spans["end"][part], -1)
        gone = np.cumsum(depth[:-1]) > 0
        left = text[~gone].tobytes()
        out["doc_id"].append(int(doc[row]))
        out["whole_sha256"].append(hashlib.sha256(text.tobytes()).hexdigest())
        out["n_removed"].append(int(gone.sum()))
        out["n_spans"].append(int((gone & ~np.concatenate(([False], gone[:-1]))).sum()))
        out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
        out["kept"].append(left)
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})


def without_repeats(docs: DataFrame, length: int = 50, pack_bytes: int = 8 << 20, texts: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with
    ``texts``, kept (binary), the bytes that are left.

    A null text is empty. Rows of null doc_id take no part and keep all. Rows that repeat a doc_id are separate
    documents that take nothing from each other. Other columns are ignored; an empty table gives no rows.
    ``length`` is at least 24.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    docs = docs.select(F.col("doc_id").cast("long"), text)
    base = store(docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                             F.sha2("text", 256).alias("whole_sha256")), "digests")
    total = base.agg(F.sum("n_bytes")).first()[0] or 0
    packs = max(1, -(-total // pack_bytes))
    classes = base.where("doc_id is not null").groupBy("whole_sha256").agg(
        F.min("doc_id").alias("first"), F.first("n_bytes").alias("n"))
    pack = lambda c: F.pmod(F.xxhash64(c), F.lit(packs)).alias("pack")
    ids = classes.where(F.col("n") >= length).select(pack("first"), F.col("first")).groupBy("pack").agg(
        F.collect_set("first").alias("ids"))
    ids = store(ids, "packs")
    long = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length)).select(
        "doc_id", "text", pack("doc_id"))
    minimizers = _shared_minimizers(long, packs, length)
    chosen = minimizers.select("pack", "minimizers", F.lit(None).cast("array<long>").alias("ids")).unionByName(
        ids.select("pack", F.lit(None).cast("binary").alias("minimizers"), "ids"))
    segments = long.groupBy("pack").cogroup(chosen.groupBy("pack")).applyInArrow(
        _segments(packs * 4, length), "shard long, pack long, bytes binary, segments binary, aliases binary")
    spans = segments.groupBy("shard").applyInArrow(_settle(length), "pack long, spans binary")
    spans = store(spans, "spans")
    chosen = spans.select("pack", "spans", F.lit(None).cast("array<long>").alias("ids")).unionByName(
        ids.select("pack", F.lit(None).cast("binary").alias("spans"), "ids"))
    cut = long.groupBy("pack").cogroup(chosen.groupBy("pack")).applyInArrow(
        _cut, "doc_id long, whole_sha256 string, n_removed long, n_spans long, kept_sha256 string, kept binary")
    if not texts:
        cut = cut.drop("kept")
    cut = cut.select("doc_id", "whole_sha256", *(F.col(c).alias(f"c_{c}") for c in cut.columns[2:]))
    rows = base
    if texts:
        rows = docs.withColumn("whole_sha256", F.sha2("text", 256)).withColumn("n_bytes", F.octet_length("text").cast("long"))
    joined = rows.join(classes.select("whole_sha256", "first"), "whole_sha256", "left").join(
        cut, ["doc_id", "whole_sha256"], "left")
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= length)
    result = [F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("c_n_removed", F.lit(0))).cast("long").alias("n_removed"),
              F.when(copy, F.lit(1)).otherwise(F.coalesce("c_n_spans", F.lit(0))).cast("long").alias("n_spans"),
              F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("c_kept_sha256", "whole_sha256")).alias("kept_sha256")]
    if texts:
        result.append(F.when(copy, F.lit(b"")).otherwise(F.coalesce("c_kept", F.col("text").cast("binary"))).alias("kept"))
    return joined.select("doc_id", "n_bytes", *result)
