"""Hierarchical multi-length packing of tokenised documents.

A document is its token ids and an end id. Its full windows of ``length`` ids are sequences of their own; the
rest, shorter than a window, is routed to a tier: the context size, a power of two, that it needs. Windows of a
tier's own size are opened for the longest tier first. Gaps are filled, best fit first, from the same tier and then
from shorter ones, so short documents pad long windows. A short window is closed only where it is exactly full;
what is in the others is merged into windows of ``length``, the only ones with padding.

Sequences of one shard and tier are dealt to step groups of ``group`` sequences by falling token count, to and
fro, so the steps of a tier carry nearly the same number of ids.

Documents go to shards at random, about ``per_shard`` in each. Only (length, checksum) of the pieces is
shuffled; ids stay where they were made.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import textbytes as T
from panelwright.llm.tokens import encoder
from panelwright.session import store

U64 = np.uint64
END = 1


def pieces(docs: DataFrame, tokenizer: str, length: int, end: int = END) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, deal): full windows and rests of every document.

    ``deal`` is a random number for the whole document, stable once the table is stored.
    """

    def run(batches):
        count = 0
        for batch in batches:
            data, offsets = T.buffers(batch["text"])
            for first, last in T.chunks(offsets, 1 << 21):
                own = offsets[first:last + 1] - offsets[first]
                ids, bounds = encoder(tokenizer).encode(data[offsets[first]:offsets[last]], own)
                sizes = np.diff(bounds) + 1
                cuts = -(-sizes // length)
                row = np.repeat(np.arange(last - first), cuts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * length
                size = np.minimum(sizes[row] - start, length)
                crc = np.empty(len(row), np.int64)
                tail = np.array([end], "<u4").tobytes()
                view = memoryview(ids.astype("<u4", copy=False).tobytes())
                for k, (d, s, n) in enumerate(zip(row.tolist(), start.tolist(), size.tolist())):
                    low = int(bounds[d]) + s
                    stop = min(low + n, int(bounds[d + 1]))
                    value = zlib.crc32(view[4 * low:4 * stop])
                    crc[k] = zlib.crc32(tail, value) if s + n == sizes[d] else value
                with np.errstate(over="ignore"):
                    serial = T.mix(T.mix(np.arange(count, count + last - first, dtype=U64)) + crc[np.cumsum(cuts) - 1].astype(U64))
                count += last - first
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"][first:last].take(pa.array(row)), pa.array(start), pa.array(size), pa.array(crc),
                    pa.array(sizes[row]), pa.array(serial.view(np.int64)[row])],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "deal"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, deal long")


def pack(sizes: np.ndarray, length: int, tiers: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each rest in windows of ``length``; sequences are numbered from 0.

    Works by falling size: windows are opened for the longest rest that is left, and each is filled with the
    largest rest that still fits until none does.
    """
    order = np.argsort(-sizes, kind="stable")
    stacks: dict[int, list[int]] = {}
    for i in order[::-1].tolist():
        stacks.setdefault(int(sizes[i]), []).append(i)
    there = sorted(stacks)
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)

    def take(at: int) -> int:
        size = there[at]
        item = stacks[size].pop()
        if not stacks[size]:
            del there[at]
        return item

    number = 0
    for tier in sorted(tiers, reverse=True):
        floor = tier // 2 if tier > min(tiers) else 0
        while there and there[-1] > floor:
            item, used = take(len(there) - 1), 0
            while True:
                sequence[item], offset[item] = number, used
                used += int(sizes[item])
                at = bisect_left(there, length - used + 1) - 1
                if used == length or at < 0:
                    break
                item = take(at)
            number += 1
    return sequence, offset


def tiered(sizes: np.ndarray, length: int, tiers: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of each rest and the window size of each sequence."""
    order = np.argsort(-sizes, kind="stable")
    stacks: dict[int, list[int]] = {}
    for i in order[::-1].tolist():
        stacks.setdefault(int(sizes[i]), []).append(i)
    there = sorted(stacks)
    sequence, offset, window, loose = np.full(len(sizes), -1), np.zeros(len(sizes), np.int64), [], []

    def take(at: int) -> int:
        size = there[at]
        item = stacks[size].pop()
        if not stacks[size]:
            del there[at]
        return item

    own = sorted({t for t in tiers if t < length}, reverse=True)
    for tier, floor in zip([length, *own], [*own, 0]):
        while there and there[-1] > floor:
            items, used = [], 0
            while used < tier and (at := bisect_left(there, tier - used + 1) - 1) >= 0:
                items.append(take(at))
                used += int(sizes[items[-1]])
            if used < tier:
                loose += items
                continue
            sequence[items] = len(window)
            offset[items] = np.cumsum([0, *sizes[items[:-1]]])
            window.append(tier)
    if loose:
        more, offset[loose] = pack(sizes[loose], length, tiers)
        sequence[loose] = len(window) + more
        window += [length] * (int(more.max()) + 1)
    return sequence, offset, np.array(window, np.int64)


def packed(docs: DataFrame, tokenizer: str, length: int = 2048, tiers: tuple[int, ...] = (256, 512, 1024, 2048),
           group: int = 64, per_shard: int = 50_000, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group.

    ``docs`` has doc_id and text. A null or empty text is the end id alone. Rows with null or repeated doc_id are
    documents like others. An empty table gives no rows; other columns are ignored.
    """
    cut = store(pieces(docs, tokenizer, length, end), "pieces")
    total = cut.where("start = 0").count()
    shards = max(1, -(-total // per_shard))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("deal", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        size = table["length"].to_numpy()
        full = size == length
        sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        sequence[~full], offset[~full], tier = tiered(size[~full], length, tiers)
        sequence[full] = len(tier) + np.arange(full.sum())
        tier = np.concatenate((tier, np.full(full.sum(), length)))
        used = np.bincount(sequence, size).astype(np.int64)
        step = np.zeros(len(used), np.int64)
        for t in np.unique(tier):
            own = np.flatnonzero(tier == t)
            steps = max(1, len(own) // group)
            turn = np.arange(len(own))
            lap, seat = turn // steps, turn % steps
            step[own[np.argsort(-used[own], kind="stable")]] = np.where(lap % 2, steps - 1 - seat, seat)
        shard = table["shard"].to_numpy()[0]
        return pa.table({
            **{c: table[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")},
            "sequence_id": pa.array(shard * (1 << 40) + sequence), "offset": pa.array(offset),
            "tier": pa.array(tier[sequence]), "step_group": pa.array(shard * (1 << 40) + step[sequence])})

    return cut.withColumn("shard", F.pmod(F.col("deal"), F.lit(shards))).groupBy("shard").applyInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
             "offset long, tier long, step_group long")
