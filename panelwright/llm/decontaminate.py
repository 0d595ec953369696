"""Benchmark passages in documents: BM25 over the test items, searched with block-max WAND.

Every document is read as overlapping passages of words, twice as long as the longest item and half a passage
apart, so an item lies whole in one of them. Each passage is a query against an inverted index of the items.
An item's BM25 score counts as a share of the score it gives itself, and all items above ``threshold`` are
retrieved. A hit stands if the passage also holds at least ``overlap`` of the shingles of the item's question and
of its answer.

The index has blocks of ``BLOCK`` items and, by term and block, the highest weight. Their sums over a passage's rarer terms, and what
the most frequent terms may add in a block, bound the scores of its items; only blocks that may hold a hit are
searched, item by item with cursors that skip to the next pivot.

Words are lower-cased, and ASCII punctuation parts them. The index covers a block of items of bounded size; more
items are searched block by block, with document frequencies over all of them.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import textbytes as T
from panelwright.session import store

U64 = np.uint64
K1, B = 1.2, 0.75
BLOCK = 4
SHINGLE = 5


def _words(texts: pa.Array):
    data, offsets = T.buffers(texts)
    return T.words(T.without_punctuation(data), offsets), len(offsets) - 1


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item that comes as one text: its last sentence, or last quarter, is the answer."""
    parts = [p for p in text.replace("\n", " ").split(". ") if p.strip()]
    if len(parts) > 1:
        return ". ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = len(words) - max(1, len(words) // 4)
    return " ".join(words[:cut]), " ".join(words[cut:])


@dataclass
class Index:
    """Postings by term (items, weights as shares of the item's own score) and block maxima of the rarer terms."""

    item_ids: np.ndarray
    terms: np.ndarray
    items: list[list[int]]
    weights: list[list[float]]
    top: list[float]
    first: np.ndarray
    blocks: np.ndarray
    maxima: np.ndarray
    common: np.ndarray
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    sizes: list[tuple[int, int]]
    longest: int


def build(rows: list, frequency: dict[int, int], total: int, average: float, longest: int, threshold: float) -> Index:
    """The index of (item_id, question, answer) rows, given what holds over all items: document frequencies of
    their terms, the number of items, and their average and longest length in words."""
    both, _ = _words(pa.array([f"{r.question} {r.answer}" for r in rows], pa.string()))
    parts = [_words(pa.array([r[c] for r in rows], pa.string()))[0] for c in ("question", "answer")]
    postings: dict[int, list[tuple[int, float]]] = {}
    for i in range(len(rows)):
        own = both.hash[both.text == i]
        if not len(own):
            continue
        terms, counts = np.unique(own, return_counts=True)
        n = np.array([frequency[t] for t in terms.tolist()])
        weight = np.log1p((total - n + 0.5) / (n + 0.5)) * counts * (K1 + 1) / (
            counts + K1 * (1 - B + B * len(own) / average))
        for t, w in zip(terms.tolist(), (weight / weight.sum()).tolist()):
            postings.setdefault(t, []).append((i, w))
    terms = np.array(sorted(postings), dtype=U64)
    items = [[i for i, _ in postings[t]] for t in terms.tolist()]
    weights = [[w for _, w in postings[t]] for t in terms.tolist()]
    # The most frequent terms, as many as leave every item below half of the threshold, count as a sum by block.
    share, common = np.zeros(len(rows)), np.zeros(len(terms), dtype=bool)
    for t in sorted(range(len(terms)), key=lambda t: -len(items[t])):
        grown = share[items[t]] + weights[t]
        if (grown > threshold / 2).any():
            break
        share[items[t]] = grown
        common[t] = True
    first, blocks, maxima = [0], [], []
    for t in range(len(terms)):
        if not common[t]:
            best: dict[int, float] = {}
            for i, w in zip(items[t], weights[t]):
                best[i // BLOCK] = max(best.get(i // BLOCK, 0.0), w)
            blocks += best.keys()
            maxima += best.values()
        first.append(len(blocks))
    padded = np.append(share, np.zeros(-len(share) % BLOCK)).reshape(-1, BLOCK)
    grams = [[_shingles(p.hash[p.text == i]) for i in range(len(rows))] for p in parts]
    sizes = [(int((parts[0].text == i).sum()), int((parts[1].text == i).sum())) for i in range(len(rows))]
    return Index(np.array([r.item_id for r in rows]), terms, items, weights, [max(w) for w in weights],
                 np.array(first), np.array(blocks, np.int64), np.array(maxima), padded.max(axis=1), *grams, sizes, longest)


def _shingles(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingles; of fewer words, the whole as one."""
    size = min(size, len(h))
    if not size:
        return h
    value = h[:len(h) - size + 1].copy()
    with np.errstate(over="ignore"):
        for i in range(1, size):
            value = T.mix(value * U64(3)) + h[i:len(h) - size + 1 + i]
    return np.unique(value)


def wand(index: Index, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
    """All (item, score) of a block of items of at least ``threshold``, for a passage's distinct terms."""
    found, least, end = [], threshold - 1e-12, (block + 1) * BLOCK
    cursors = []  # item under the cursor, its place in the postings, term
    for t in terms:
        place = bisect_left(index.items[t], block * BLOCK)
        if place < len(index.items[t]) and index.items[t][place] < end:
            cursors.append((index.items[t][place], place, t))
    while cursors:
        cursors.sort()
        total, pivot = 0.0, None
        for item, _, t in cursors:
            total += index.top[t]
            if total >= least:
                pivot = item
                break
        if pivot is None:
            break
        if cursors[0][0] == pivot:
            score = sum(index.weights[t][place] for item, place, t in cursors if item == pivot)
            if score >= least:
                found.append((pivot, score))
            pivot += 1
        moved = []
        for item, place, t in cursors:
            if item < pivot:
                place = bisect_left(index.items[t], pivot, place)
                if place == len(index.items[t]) or index.items[t][place] >= end:
                    continue
                item = index.items[t][place]
            moved.append((item, place, t))
        cursors = moved
    return found


def candidates(index: Index, cell: np.ndarray, term: np.ndarray, last: np.ndarray, threshold: float):
    """(passage, block) whose bound reaches ``threshold``; passage k is cells k and k + 1 unless ``last[k]``.

    ``cell`` and ``term`` are the words found in the index; a term counts once in a cell.
    """
    pair = np.unique(cell * len(index.terms) + term)
    cell, term = pair // len(index.terms), pair % len(index.terms)
    many = index.first[term + 1] - index.first[term]
    at = np.repeat(index.first[term] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    cell, block, weight = np.repeat(cell, many), index.blocks[at], index.maxima[at]
    # A cell belongs to the passage it begins, and to the one before in the same text.
    before = (cell > 0) & ~last[cell - 1]
    key = np.concatenate((cell, cell[before] - 1)) * len(index.common) + np.concatenate((block, block[before]))
    key, index_of = np.unique(key, return_inverse=True)
    bound = np.bincount(index_of, np.concatenate((weight, weight[before])), len(key))
    passage, block = key // len(index.common), key % len(index.common)
    fit = bound + index.common[block] >= threshold - 1e-9
    return passage[fit], block[fit]


def search(docs: DataFrame, index: Index, threshold: float, overlap: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        ix = shared.value
        mark = np.zeros(1 << 16, dtype=bool)
        mark[(ix.terms >> U64(48)).astype(np.int64)] = True
        stride = ix.longest
        asked = [set(x.tolist()) for x in ix.questions]
        told = [set(x.tolist()) for x in ix.answers]
        for batch in batches:
            data, offsets = T.buffers(batch["text"])
            ids = batch["doc_id"].to_pylist()
            out = []
            for first, last in T.chunks(offsets, 1 << 21):
                own = offsets[first:last + 1] - offsets[first]
                found = T.words(T.without_punctuation(data[offsets[first]:offsets[last]]), own)
                bounds = np.searchsorted(found.text, np.arange(last - first + 1))
                maybe = np.flatnonzero(mark[(found.hash >> U64(48)).astype(np.int64)])
                term = np.searchsorted(ix.terms, found.hash[maybe])
                hit = np.append(ix.terms, U64(0))[term] == found.hash[maybe]
                place, term = maybe[hit], term[hit]
                # Cells of one stride; texts' cells are numbered on.
                cells = np.maximum(1, -(-np.diff(bounds) // stride))
                before = np.cumsum(cells) - cells
                text = found.text[place]
                cell = before[text] + (place - bounds[text]) // stride
                final = np.zeros(int(cells.sum()), dtype=bool)
                final[before + cells - 1] = True
                for k, block in zip(*(x.tolist() for x in candidates(ix, cell, term, final, threshold))):
                    row = int(np.searchsorted(before, k, "right")) - 1
                    start = int(bounds[row]) + (k - int(before[row])) * stride
                    stop = min(start + 2 * stride, int(bounds[row + 1]))
                    a, b = np.searchsorted(place, (start, stop))
                    for item, score in wand(ix, list(dict.fromkeys(term[a:b].tolist())), block, threshold):
                        h = found.hash[start:stop]
                        shares = []
                        for wanted, size in ((asked[item], ix.sizes[item][0]), (told[item], ix.sizes[item][1])):
                            have = wanted.intersection(_shingles(h, min(SHINGLE, size)).tolist()) if size else wanted
                            shares.append(len(have) / len(wanted) if wanted else 1.0)
                        if min(shares) >= overlap:
                            out.append((ids[first + row], int(ix.item_ids[item]), score, *shares,
                                        start - int(bounds[row]), stop - start))
            columns = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), *[pa.float64()] * 3, *[pa.int64()] * 2])],
                ["doc_id", "item_id", "score", "question", "answer", "at", "length"])

    return docs.mapInArrow(run, "doc_id long, item_id long, score double, question double, answer double, "
                                "at long, length long")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.7, overlap: float = 0.8,
                 block_bytes: int = 16 << 20) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, score, question_overlap, answer_overlap,
    first_word, n_passages.

    ``docs`` has doc_id and text; ``items`` item_id and either text or question and answer. Score and overlaps
    are those of the best passage (the first of equals). Items without words or with null item_id, and texts
    without words, match nothing; items that repeat an item_id count as one row with the best match. A question or answer of
    fewer than five words is one shingle; an empty one counts as found. Rows with null doc_id are searched and
    come out under null; rows that repeat a doc_id come out once per item. Empty tables give no rows.
    """
    if "question" in items.columns and "answer" in items.columns:
        parts = items.select(F.col("item_id").cast("long"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                                                              for c in ("question", "answer")))
    else:
        split = F.udf(split_item, "question string, answer string")
        parts = items.select(F.col("item_id").cast("long"), split(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("x"))
        parts = parts.select("item_id", "x.question", "x.answer")

    def term_sets(batches):
        for batch in batches:
            both = pa.array([f"{q} {a}" for q, a in zip(batch["question"].to_pylist(), batch["answer"].to_pylist())],
                            pa.string())
            found, count = _words(both)
            own = [found.hash[found.text == i] for i in range(count)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.unique(x).view(np.int64) for x in own], pa.list_(pa.int64())),
                 pa.array([len(x) for x in own], pa.int64())], ["terms", "words"])

    parts = store(parts.where("item_id is not null"), "items")
    sets = parts.mapInArrow(term_sets, "terms array<long>, words long").where("words > 0")
    total, average, longest, size = sets.select(F.count("*"), F.avg("words"), F.max("words")).first() + parts.select(
        F.sum(F.length("question") * 4 + F.length("answer") * 4)).first()
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    blocks = max(1, -(-(size or 0) // block_bytes))
    frequency = store(sets.select(F.explode("terms").alias("term")).groupBy("term").count(), "frequencies")
    hits = None
    for block in range(blocks):
        own = parts.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        terms = own.mapInArrow(term_sets, "terms array<long>, words long").select(F.explode("terms").alias("term")).distinct()
        # Both hold one block of items at most.
        counts = {r.term & (1 << 64) - 1: r["count"] for r in frequency.join(terms, "term", "left_semi").collect()}
        index = build(own.orderBy("item_id").collect(), counts, total, average or 1.0, longest or 1, threshold)
        found = search(docs, index, threshold, overlap)
        hits = found if hits is None else hits.union(found)
    best = F.max_by(F.struct("score", "question", "answer", "at"), F.struct("score", -F.col("at"))).alias("best")
    return hits.groupBy("doc_id", "item_id").agg(best, F.count("*").alias("n_passages")).select(
        "doc_id", "item_id", F.round("best.score", 9).alias("score"), F.col("best.question").alias("question_overlap"),
        F.col("best.answer").alias("answer_overlap"), F.col("best.at").alias("first_word"), "n_passages")
