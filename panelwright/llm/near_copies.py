"""Near-duplicate groups: SuperMinHash signatures, banding, checks on full sets, union of links.

A text's set is its distinct shingles of ``size`` words (a shorter text: all its words as one; none: empty).
Two texts are linked if 100 * |intersection| >= percent * |union|; groups are the connected components.

* Texts of equal sets count as one from the start, so copies by the thousand cost one row each.
* Signatures come from SuperMinHash: each element deals ranks 0, 1, 2, ... to the slots of its own random
  permutation, and a document stops as soon as no later rank can lower a slot.
* Bands are chosen so that a pair right at the threshold is missed with probability ``miss``. Sharing a band key
  only says which texts are compared: a chain of shared keys makes a candidate group.
* Within a candidate group every text's intersections with all others are counted on the full sets through an
  inverted list, so no pairs are written out. Groups of more than ``block`` shingles are cut into blocks, and
  pairs of blocks are compared in separate tasks.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import textbytes as T
from panelwright.llm.graph import components
from panelwright.session import store

U64 = np.uint64
ROWS = 6
BLOCK = 2_000_000


def bands_for(percent: int, miss: float = 1e-6, rows: int = ROWS) -> int:
    return max(1, math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows) + 1e-12)))


def superminhash(elements: np.ndarray, offsets: np.ndarray, slots: int) -> np.ndarray:
    """Signatures, one row of ``slots`` values per text; a text without elements has infinities only."""
    count = len(offsets) - 1
    owner = np.repeat(np.arange(count), np.diff(offsets))
    signature = np.full((count, slots), np.inf)
    flat = signature.reshape(-1)
    perm = None
    with np.errstate(over="ignore"):
        for level in range(slots):
            x = T.mix(elements + U64((level + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
            rank = level + (x >> U64(11)).astype(np.float64) * 2.0 ** -53
            pick = level + ((T.mix(x) >> U64(32)) * U64(slots - level) >> U64(32)).astype(np.int64)
            if level == 0:
                slot, first_pick = pick, pick
            else:
                rows = np.arange(len(elements))
                slot = perm[rows, pick].astype(np.int64)
                perm[rows, pick] = perm[:, level]
                perm[:, level] = slot
            np.minimum.at(flat, owner * slots + slot, rank)
            open_ = signature.max(axis=1) >= level + 1
            open_ &= np.diff(offsets) > 0
            if not open_.any():
                break
            keep = open_[owner]
            elements, owner = elements[keep], owner[keep]
            if level == 0:
                perm = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
                rows, pick = np.arange(len(elements)), first_pick[keep]
                perm[rows, pick], perm[:, 0] = 0, pick
            else:
                perm = perm[keep]
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = np.ascontiguousarray(signature).view(U64).reshape(len(signature), bands, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(bands, dtype=U64), bits.shape[:2])
        for i in range(rows):
            key = T.mix(key * U64(3) + bits[:, :, i])
    return key.view(np.int64)


def _sets(texts: pa.Array, size: int, limit: int = 1 << 18):
    """(first, last, shingles, offsets) for chunks of the texts."""
    data, offsets = T.buffers(texts)
    for first, last in T.chunks(offsets, limit):
        own = offsets[first:last + 1] - offsets[first]
        found = T.words(data[offsets[first]:offsets[last]], own)
        yield first, last, *T.shingles(found, last - first, size)


def signatures(docs: DataFrame, size: int, bands: int, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, digest, keys); an empty set has neither digest nor keys."""

    def run(batches):
        for batch in batches:
            for first, last, found, offsets in _sets(batch["text"], size):
                keys = band_keys(superminhash(found, offsets, bands * rows), bands, rows)
                full = np.diff(offsets) > 0
                digest = [hashlib.blake2b(found[a:b].tobytes(), digest_size=16).digest() if b > a else None
                          for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"][first:last], pa.array(np.diff(offsets)), pa.array(digest, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], np.cumsum(np.where(full, bands, 0)))), pa.int32()),
                        pa.array(keys[full].reshape(-1)))], ["doc_id", "n_shingles", "digest", "keys"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, keys array<long>")


def linked(elements: np.ndarray, offsets: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the texts of each component, found by walking from text to text."""
    count = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(count), size)
    _, word = np.unique(elements, return_inverse=True)
    order = np.argsort(word, kind="stable")
    posting, start = owner[order], np.searchsorted(word[order], np.arange(word.max() + 2 if len(word) else 1))
    fresh, links = np.ones(count, dtype=bool), []
    for root in range(count):
        if not fresh[root]:
            continue
        fresh[root] = False
        walk = [root]
        while walk:
            here = walk.pop()
            own = word[offsets[here]:offsets[here + 1]]
            own = own[start[own + 1] - start[own] > 1]
            if not len(own):
                continue
            lengths = start[own + 1] - start[own]
            places = np.repeat(start[own] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
            others = posting[places + np.arange(lengths.sum())]
            common = np.bincount(others[fresh[others]], minlength=count)
            near = np.flatnonzero((100 * common >= percent * (size + size[here] - common)) & (common > 0))
            fresh[near] = False
            links += [(here, int(x)) for x in near]
            walk += near.tolist()
    return links


def confirmed_links(docs: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links on full sets within each candidate group of ``groups`` (doc_id, part)."""

    def run(table: pa.Table) -> pa.Table:
        ids = table["doc_id"].to_numpy()
        parts = list(_sets(table["text"], size))
        found = np.concatenate([x[2] for x in parts])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[3]) for x in parts]))])
        links = linked(found, offsets, percent)
        return pa.table({"a": pa.array([ids[x] for x, _ in links], pa.int64()),
                         "b": pa.array([ids[y] for _, y in links], pa.int64())})

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(groups, "doc_id")
    return texts.groupBy("part").applyInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, size: int = 3, percent: int = 85, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id of the group, ``kept`` whether it is the row's own. Empty sets are
    groups of their own. Rows that repeat a doc_id with other texts are one node, which has the links of all
    its texts; a row with null doc_id links nothing, has null component_id and is kept. Other columns are
    ignored, and an empty table gives no rows.
    """
    bands = bands_for(percent, rows=rows)
    signed = store(signatures(docs, size, bands, rows), "signatures")
    usable = signed.where("doc_id is not null and digest is not null")
    classes = usable.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    classes = store(classes, "classes")
    banded = classes.select("rep", F.explode("keys").alias("key"))
    lows = banded.groupBy("key").agg(F.min("rep").alias("low"), F.count("*").alias("members")).where("members > 1")
    stars = banded.join(lows, "key").where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    groups = components(stars).join(classes.select(F.col("rep").alias("id"), "n"), "id")
    weights = groups.groupBy("component").agg(F.ceil(F.sum("n") / F.lit(block)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda x: F.struct(F.least(x, F.col("own")).alias("i"), F.greatest(x, F.col("own")).alias("j")))
    groups = groups.join(weights, "component").withColumn("own", own).select(
        F.col("id").alias("doc_id"), "component", F.explode(pairs).alias("pair")).select(
        "doc_id", F.struct("component", "pair.i", "pair.j").alias("part"))
    texts = docs.where("doc_id is not null")
    found = components(confirmed_links(texts, groups, size, percent))
    answer = classes.select("digest", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "digest").join(answer, "digest", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
