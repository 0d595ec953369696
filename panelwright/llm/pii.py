"""Personal data in texts: fixed patterns, and a character tagger trained on what they find.

Base spans come from patterns for e-mail, IP and card numbers and phone numbers; they stay whatever the tagger
says. The tagger (``tagger.Tagger``) learns from base spans of a bounded sample and of altered copies: phones
without country code, cards in groups, spelt-out e-mail signs. Every form it is trained on has a digit, an at
sign, "(at)" or " dot ", so it reads each place within ``REACH`` characters of one, or of an " at " before a
" dot ", in overlapping windows. Windows are decoded separately; a span that a window's edge cuts, and no other
window has whole, is read again in wider ones. Spans are reconciled over the whole text: of those that
overlap, the set with the highest total weight stays, without any that touches a base span.

Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm import tagger as G
from panelwright.llm import textbytes as T
from panelwright.session import store

KINDS = ("email", "ip", "card", "phone")
# An at sign with a domain after it, each number or chain of digits as a whole: the same matches as the plain
# patterns give from left to right, but in time proportional to the text.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPELT = re.compile(r" ([aA][tT])(?= )| ([dD][oO][tT])(?= )|\(([aA][tT])\)")
SPELT_BYTES = re.compile(rb" [dD][oO][tT] |\([aA][tT]\)")
REACH, WINDOW, LONGEST = 32, 64, 512
TRIGGER = np.zeros(256, dtype=bool)
TRIGGER[[*range(48, 58), 64]] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind), ordered by start, then kind."""
    out, stop = [], 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > stop and LOCAL.match(text, start - 1):
            start -= 1
        if start < m.start():
            out.append((start, m.end(), 0))
            stop = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), 2))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def triggers(text: str, points: np.ndarray) -> np.ndarray:
    """Places that a span of some trained form holds: digits, at signs and their spelt-out forms."""
    dots, ats, marks = [], [], np.flatnonzero(TRIGGER[np.minimum(points, 255)])
    for m in SPELT.finditer(text):
        (ats if m[1] else dots).append(m.start() + 1)
    if not dots:
        return marks
    ats, dots = np.array(ats, np.int64), np.array(dots, np.int64)
    after = np.searchsorted(dots, ats)
    near = dots[np.minimum(after, len(dots) - 1)] - ats
    return np.unique(np.concatenate((marks, dots, ats[(near > 0) & (near <= LONGEST // 2)])))


def regions(triggers: np.ndarray, length: int, reach: int = REACH) -> list[tuple[int, int]]:
    """Stretches of the text within ``reach`` of a trigger."""
    if not len(triggers):
        return []
    cut = np.flatnonzero(np.diff(triggers) > 2 * reach)
    first = triggers[np.concatenate(([0], cut + 1))]
    last = triggers[np.concatenate((cut, [len(triggers) - 1]))]
    return list(zip(np.maximum(first - reach, 0).tolist(), np.minimum(last + reach + 1, length).tolist()))


def windows(found: list[tuple[int, int]], size: int = WINDOW) -> list[int]:
    """Starts of windows over the regions, half a window apart."""
    return [start for low, high in found
            for start in range(low, max(low + 1, high - size // 2), size // 2)]


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """The set of spans (start, end, kind, weight) without overlaps that has the highest total weight."""
    spans = sorted(set(spans), key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in spans]
    best, take = [0.0], []
    for i, (start, _, _, weight) in enumerate(spans):
        before = bisect_right(ends, start, 0, i)
        take.append((best[before] + weight > best[i], before))
        best.append(max(best[i], best[before] + weight))
    out, i = [], len(spans)
    while i:
        chosen, before = take[i - 1]
        if chosen:
            out.append(spans[i - 1][:3])
        i = before if chosen else i - 1
    return out[::-1]


def altered(text: str, kind: int, turn: int) -> str:
    """Another way to write a span."""
    if kind == 0:
        return (text.replace("@", " at ").replace(".", " dot "), text.replace("@", "(at)"), text.upper())[turn % 3]
    if kind == 1:
        return (text, text.replace(".", "-"), text)[turn % 3]
    if kind == 2:
        groups = [text[i:i + 4] for i in range(0, len(text), 4)]
        return (" ".join(groups), "-".join(groups), text)[turn % 3]
    bare = re.sub(r"^\+[0-9]{1,3}[ -]?", "", text)
    return (bare, bare.replace("(", "").replace(")", "").replace(" ", "-"), text.replace(" ", ""))[turn % 3]


def examples(texts: list[str], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags around the triggers of the texts, as they are and with each span altered."""
    chars, tags = [], []

    def add(text: str, spans: list[tuple[int, int, int]]) -> None:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        symbol, tag = G.symbols(points), np.zeros(len(points), np.int64)
        for start, end, kind in reversed(spans):
            tag[start:end] = 2 + 2 * kind
            tag[start] = 1 + 2 * kind
        marked = np.union1d(triggers(text, points), np.flatnonzero(tag))
        for at in windows(regions(marked, len(points))):
            row, own = np.zeros(size, np.int64), np.zeros(size, np.int64)
            part = symbol[at:at + size]
            row[:len(part)], own[:len(part)] = part, tag[at:at + size]
            chars.append(row)
            tags.append(own)

    for n, text in enumerate(texts):
        spans, stop = [], 0
        for s in base_spans(text):
            if s[0] >= stop:
                spans.append(s)
                stop = s[1]
        add(text, spans)
        pieces, moved, at, shift = [], [], 0, 0
        for k, (start, end, kind) in enumerate(spans):
            new = altered(text[start:end], kind, n + k)
            pieces += [text[at:start], new]
            moved.append((start + shift, start + shift + len(new), kind))
            shift += len(new) - (end - start)
            at = end
        add("".join([*pieces, text[at:]]), moved)
    if not chars:
        return np.zeros((0, size), np.int64), np.zeros((0, size), np.int64)
    return np.array(chars), np.array(tags)


def train(docs: DataFrame, sample: int = 600, reach: int = 300, most: int = 1600) -> G.Tagger:
    """A tagger from at most ``sample`` documents with base spans, chosen by hash.

    Of each, only the ``reach`` characters around each of its first spans are used, and ``most`` windows of all.
    """

    def run(batches):
        for batch in batches:
            kept = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                spans = base_spans(text)
                if spans:
                    middle = spans[doc_id % len(spans)][0] if doc_id is not None else spans[0][0]
                    kept.append(text[max(0, middle - reach):middle + reach])
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string())], ["text"])

    digits = F.col("text").rlike("[0-9@]")
    found = docs.where(digits).mapInArrow(run, "text string")
    rows = found.dropDuplicates(["text"]).orderBy(F.xxhash64("text"), "text").limit(sample).collect()
    chars, tags = examples([r.text for r in rows])
    model = G.Tagger(len(KINDS))
    if len(chars):
        keep = np.random.default_rng(5).permutation(len(chars))[:most]
        model.train(chars[keep], tags[keep])
    return model


def tagged(model: G.Tagger, texts: list[tuple[np.ndarray, np.ndarray]], least: float) -> list[list[tuple[int, int, int]]]:
    """Reconciled spans of texts given as (code points, places of triggers)."""
    found: list[list] = [[] for _ in texts]
    todo = [(n, at) for n, (points, own) in enumerate(texts) for at in windows(regions(own, len(points)))]
    width = WINDOW
    while todo:
        cut = []
        size = max(1, 2048 * WINDOW // width)
        for low in range(0, len(todo), size):
            part = todo[low:low + size]
            rows = np.zeros((len(part), width), np.int64)
            for row, (n, at) in zip(rows, part):
                piece = G.symbols(texts[n][0][at:at + width])
                row[:len(piece)] = piece
            tags, share = model.decode(rows)
            begins = tags % 2 == 1
            begins[:, 0] |= tags[:, 0] > 0
            for r, c in zip(*np.nonzero(begins)):
                kind, stop = int(tags[r, c] - 1) // 2, c + 1
                while stop < width and tags[r, stop] == 2 + 2 * kind:
                    stop += 1
                n, at = part[r]
                points, own = texts[n]
                a, b = at + int(c), at + int(stop)
                if (c == 0 and at > 0) or (stop == width and b < len(points)):
                    cut.append((n, a, b))
                    continue
                score = float(share[r, c:stop].mean())
                held = np.searchsorted(own, a) < np.searchsorted(own, b)
                if tags[r, c] % 2 and score >= least and held:
                    found[n].append((a, b, kind, (b - a) * float(np.exp(score))))
        width *= 2
        if width > LONGEST:
            break
        whole = {n: np.zeros(len(texts[n][0]), bool) for n, _, _ in cut}
        for n, taken in whole.items():
            for a, b, _, _ in found[n]:
                taken[a:b] = True
        todo = sorted({(n, max(0, (a + b - width) // 2)) for n, a, b in cut if not whole[n][a:b].any()})
    return [reconcile(x) for x in found]


def spans(docs: DataFrame, model: G.Tagger, least: float = -0.3) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end, base>>) for every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            data, offsets = T.buffers(batch["text"])
            for first, last in T.chunks(offsets, 1 << 22):
                part = data[offsets[first]:offsets[last]]
                own = offsets[first:last + 1] - offsets[first]
                marks = [np.flatnonzero(TRIGGER[part]), np.array([m.start() for m in SPELT_BYTES.finditer(part)], np.int64)]
                busy = np.unique(np.searchsorted(own, np.concatenate(marks), "right") - 1)
                out = [[] for _ in range(last - first)]
                texts = []
                for i in busy.tolist():
                    text = part[own[i]:own[i + 1]].tobytes().decode("utf-8", "replace")
                    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                    texts.append((points, triggers(text, points)))
                    out[i] = [(a, b, k, True) for a, b, k in base_spans(text)]
                for i, more in zip(busy.tolist(), tagged(shared.value, texts, least)):
                    taken = sorted((a, b) for a, b, _, _ in out[i])
                    for a, b, k in more:
                        if not any(x < b and a < y for x, y in taken):
                            out[i].append((a, b, k, False))
                    out[i].sort(key=lambda s: (s[0], s[2]))
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([batch["doc_id"][first:last], pa.array(
                    [[{"kind": KINDS[k], "start": a, "end": b, "base": z} for a, b, k, z in x] for x in out], kind)],
                    ["doc_id", "spans"])

    return docs.mapInArrow(run, "doc_id long, spans array<struct<kind string, start long, end long, base boolean>>")


def personal_data(docs: DataFrame, sample: int = 600) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and ``spans``, base ones and the tagger's.

    A null or empty text has none. Without any base span in the sample the tagger adds none. Rows with null or
    repeated doc_id are answered like others; other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return spans(docs, train(docs, sample))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``personal_data``: base spans by kind, their SHA-256, and all spans as text."""
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(written(base), 256).alias("base_sha256"),
                        written("spans").alias("spans"),
                        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))
