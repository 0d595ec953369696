"""The training-data operators against plain versions, and on awkward tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelwright import session
from panelwright.llm import decontaminate, licences, lines, near_copies, packing, pii, repeats, suffixes, tagger, textbytes
from panelwright.llm import tokens, topk, toxicity, warc

SF = "/root/testdata/sf0.001"
CLASHING = "doc_id long, text string, key string, pack long, part string, word string, id long, lines string, shard int"
WORDS = ["aa", "Bb", "cc.", "dé", "e", "ff", "gg", "hh", "ii", "jj", "kk", "ll"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


def awkward(spark, rows=()):
    """Nulls, empty and very long texts, repeated rows and ids, and columns whose names operators use themselves."""
    rng = random.Random(1)
    long = sentence(rng, 30_000)
    base = [(0, "one two three four five six seven"), (1, None), (2, ""), (3, " \t\n "), (None, "one two three four five six"),
            (None, None), (4, "word"), (5, "word"), (6, "two words"), (7, long), (8, long), (9, long[:-5]),
            (0, "one two three four five six seven"), (4, "other text of the same id"), (10, "é" * 5000), (11, "x" * 70_000)]
    return spark.createDataFrame([(i, t, "k", 1, "p", "w", 2, "l", 3) for i, t in [*base, *rows]], CLASHING)


def empty(spark):
    return spark.createDataFrame([], CLASHING)


def lower(text):
    return text.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))


def upper(text):
    return text.translate(str.maketrans({chr(c): chr(c - 32) for c in range(97, 123)}))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


# --- words ---------------------------------------------------------------------------------------

def test_words_and_hashes_follow_the_text():
    rng = random.Random(4)
    texts = ["".join(rng.choice("aAbé \t\n") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["", None]
    data, offsets = textbytes.buffers(pa.array(texts))
    found = textbytes.words(data, offsets, step=64)
    want = [(i, w) for i, t in enumerate(texts) for w in split(t)]
    assert found.text.tolist() == [i for i, _ in want]
    by_hash = collections.defaultdict(set)
    for h, (_, w) in zip(found.hash.tolist(), want):
        by_hash[h].add(w)
    assert all(len(x) == 1 for x in by_hash.values()) and len(by_hash) == len({w for _, w in want})


# --- near copies ---------------------------------------------------------------------------------

def plain_groups(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = split(t)
        own = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        sets.setdefault(i, []).append(own)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in sets}


def plain_superminhash(elements, slots):
    """One element after another, one rank after another."""
    h = np.full(slots, np.inf)
    with np.errstate(over="ignore"):
        for e in elements:
            order = list(range(slots))
            for level in range(slots):
                x = textbytes.mix(np.array([e], np.uint64) + np.uint64((level + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
                rank = level + float(x[0] >> np.uint64(11)) * 2.0 ** -53
                pick = level + int((int(textbytes.mix(x)[0]) >> 32) * (slots - level) >> 32)
                order[level], order[pick] = order[pick], order[level]
                h[order[level]] = min(h[order[level]], rank)
    return h


def test_superminhash_with_early_stop_equals_the_full_one():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (1, 3, 40, 700, 0)]
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    got = near_copies.superminhash(np.concatenate(sets), offsets, 24)
    for row, own in zip(got, sets):
        assert np.array_equal(row, plain_superminhash(own, 24))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (600, 200, 200))
    got = near_copies.superminhash(np.concatenate([common, a, common, b]), np.array([0, 800, 1600]), 400)
    assert abs((got[0] == got[1]).mean() - 0.6) < 0.08


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
@pytest.mark.parametrize("block", [near_copies.BLOCK, 400])
def test_near_copies_find_every_link(spark, size, percent, block):
    rng = random.Random(size)
    rows = []
    for g in range(6):
        base = sentence(rng, 60).split()
        for k in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(60)] = f"new{rng.randint(0, 9)}"
            rows.append((20 + 25 * g + k, " ".join(copy)))
    rows += [(500 + i, sentence(rng, rng.randint(0, 9))) for i in range(60)]
    df = awkward(spark, rows)
    got = near_copies.near_copies(df, size, percent, block=block).collect()
    want = plain_groups([(r.doc_id, r.text) for r in df.collect() if r.doc_id is not None], size, percent)
    assert len(got) == df.count()
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == set(want.items())
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert near_copies.near_copies(empty(spark)).count() == 0


# --- line dedup ----------------------------------------------------------------------------------

def plain_lines(rows, percent=80):
    """Removed (doc_id, line number) of distinct (doc_id, text) rows."""
    seen, gone = [], set()
    for i, text in sorted({(i, t) for i, t in rows if i is not None and t is not None}):
        for n, line in enumerate(text.split("\n")):
            own = frozenset(split(line))
            if not own:
                continue
            if any(100 * len(own & s) >= percent * len(own | s) for s in seen):
                gone.add((i, n))
            seen.append(own)
    return gone


def test_line_dedup_equals_the_plain_one(spark):
    rng = random.Random(9)
    base = [sentence(rng, rng.randint(1, 14)) for _ in range(40)]
    rows = []
    for i in range(100, 220):
        own = []
        for _ in range(rng.randint(0, 6)):
            words = rng.choice(base).split()
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 30)}"
            own.append(" ".join(words) if rng.random() < 0.9 else "")
        rows.append((i, "\n".join(own)))
    df = awkward(spark, rows).where("not (doc_id = 4 and text like 'other%')")
    got = lines.report(df).collect()
    assert len(got) == df.count()
    removed = {(r.doc_id, int(n)) for r in got for n in r.removed_lines.split(",") if n}
    assert removed == plain_lines([(r.doc_id, r.text) for r in df.collect()])
    assert all(r.n_removed == len([n for n in r.removed_lines.split(",") if n]) for r in got)
    assert lines.report(empty(spark)).count() == 0


def test_line_dedup_is_exact_for_sets_beyond_the_packed_sizes(spark, monkeypatch):
    monkeypatch.setattr(lines, "AT", 2)
    monkeypatch.setattr(lines, "MOST", 15)
    rng = random.Random(10)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(8, 60))] for _ in range(12)]
    rows = []
    for i in range(90):
        own = list(rng.choice(base))
        for _ in range(rng.randint(0, len(own) // 5)):
            own[rng.randrange(len(own))] = f"w{rng.randint(0, 400)}"
        rows.append((i, " ".join(own)))
    got = lines.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, 0) for r in got if r.n_removed} == plain_lines(rows)


def test_line_dedup_of_a_group_of_near_copies_with_own_rare_words(spark):
    base = [f"b{i}" for i in range(30)]
    rows = [(i, " ".join(base[:i % 30] + [f"own{i}", f"mine{i}"][:1 + i % 2] + base[i % 30 + 1:])) for i in range(300)]
    got = lines.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, 0) for r in got if r.n_removed} == plain_lines(rows)


def test_line_dedup_rewrites_texts(spark):
    same = "the same long line of words"
    df = spark.createDataFrame([(1, f"{same}\nown", "a"), (2, f"x\n{same.upper()}\n\ny", "b"), (3, same, "c"), (4, None, "d"),
                                (None, same, "e")], "doc_id long, text string, line_no string")
    got = {r.line_no: (r.text, r.removed_lines) for r in lines.without_repeats(df).collect()}
    assert got == {"a": (f"{same}\nown", []), "b": ("x\n\ny", [1]), "c": ("", [0]), "d": (None, []), "e": (same, [])}
    assert {r.line_no for r in lines.without_repeats(df, drop_emptied=True).collect()} == {"a", "b", "d", "e"}


def test_a_very_common_line_costs_one_set(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "concat('a line that is everywhere it goes\n', id, ' its own words ', id * 7) as text")
    got = lines.report(df)
    assert got.where("n_removed = 1").count() == 2999 and got.where("n_removed > 1").count() == 0


def test_line_dedup_parts_lines_once(spark, monkeypatch):
    texts, own = [], lines.words
    monkeypatch.setattr(lines, "words", lambda text: texts.append(text) or own(text))
    rows = [(1, "a b c"), (2, "A  b\tc"), (3, "d e"), (4, " a b c"), (5, "d f")]
    got = lines.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.n_removed} == {2, 4} and len(texts) == 1


def test_words_of_lines(spark):
    rows = ["one", " One  two", "one two ", " one\ttwo", "a\x0bB\x0cc\r", "", " ", "  ", "É ß\u00a0x 日", None]
    got = spark.createDataFrame([(t,) for t in rows], "t string").select("t", lines.words(F.col("t")).alias("w")).collect()
    assert all(r.w == (None if r.t is None else re.split(r"[\x20\x09-\x0D]+", r.t.lower().strip(" \t\n\x0b\x0c\r"))) for r in got)


def test_line_dedup_leaves_no_texts_of_lines_on_disk(spark):
    def left():
        folders = [Path(d) for d in spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()]
        return {f: f.stat().st_size for d in folders for f in d.rglob("shuffle_*.data")}

    rng = random.Random(11)
    rows = [(i, "\n".join(" ".join(f"{rng.getrandbits(400):x}" for _ in range(12)) for _ in range(4))) for i in range(4000)]
    rows.append((4000, rows[7][1]))
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = left(), spark.conf.get(cleanup)
    got = lines.report(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()
    assert [(r.doc_id, r.n_removed) for r in got] == [(4000, 4)] and spark.conf.get(cleanup) == setting
    assert sum(size for f, size in left().items() if f not in before) < 0.4 * sum(len(t) for _, t in rows)


def test_line_dedup_plan_has_no_python(spark):
    plan = lines.report(awkward(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- repeated strings ----------------------------------------------------------------------------

def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(150):
        s = rng.integers(97, 97 + int(rng.integers(1, 5)), int(rng.integers(1, 150))).astype(np.uint8)
        s = np.tile(s[:max(1, len(s) // 4)], 4) if trial % 3 == 0 else s
        raw = s.tobytes()
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        order = suffixes.suffix_array(s, 1000)
        assert order.tolist() == want
        shared = suffixes.common_prefixes(s, order, 50)
        for a, b in zip(want[1:], want):
            n = next((k for k, (x, y) in enumerate(zip(raw[a:], raw[b:])) if x != y), min(len(raw) - a, len(raw) - b))
            assert shared[a] == min(n, 50)


def test_common_prefixes_end_with_the_text_and_count_any_byte():
    rng = np.random.default_rng(1)
    for trial in range(150):
        s = rng.choice(np.array([0, 1, 128, 255], np.uint8)[:int(rng.integers(1, 5))], int(rng.integers(1, 120)))
        s = np.tile(s[:max(1, len(s) // 3)], 3) if trial % 2 else s
        raw = s.tobytes()
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        assert suffixes._smaller(s).tolist() == [raw[i:] < raw[i + 1:] for i in range(len(raw) - 1)] + [False]
        assert suffixes.suffix_array(s, 1000).tolist() == want
        shared = suffixes.common_prefixes(s, np.array(want), 50)
        for a, b in zip(want[1:], want):
            n = next((k for k, (x, y) in enumerate(zip(raw[a:], raw[b:])) if x != y), min(len(raw) - a, len(raw) - b))
            assert shared[a] == min(n, 50)


def plain_repeats(rows, length=50):
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        if i is not None:
            for k in range(len(raw) - length + 1):
                first[raw[k:k + length]] = min(first.get(raw[k:k + length], i), i)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        if i is not None:
            for k in range(len(raw) - length + 1):
                if first[raw[k:k + length]] < i:
                    gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        out.append((i, len(raw), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("pack_bytes", [8 << 20, 20_000])
def test_repeated_strings_equal_the_plain_ones(spark, pack_bytes):
    rng = random.Random(5)
    passages = [sentence(rng, 20) for _ in range(8)]
    rows = [(100 + i, " ".join(rng.choice(passages) if rng.random() < 0.4 else sentence(rng, 12) for _ in range(rng.randint(0, 4))))
            for i in range(120)]
    rows += [(300, "a" * 900), (301, "b" + "a" * 300), (302, "ab" * 200), (303, "ab" * 100), (304, "q" * 49), (305, "q" * 49)]
    df = awkward(spark, rows)
    got = sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                  for r in repeats.without_repeats(df, pack_bytes=pack_bytes, texts=True).collect()), key=repr)
    assert got == plain_repeats([(r.doc_id, r.text) for r in df.collect()])


def test_repeated_strings_of_an_empty_table(spark):
    assert repeats.without_repeats(empty(spark)).count() == 0


# --- toxicity ------------------------------------------------------------------------------------

def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_toxicity_learns_words_and_stems(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(100, 1500):
        toxic = i % 4 == 0
        words = sentence(rng, rng.randint(20, 80)).split()
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vilest", "grimq" + rng.choice("abcdefgh") * 3]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (100, None), (101, 0), (101, 0), (999_999, 1)]
    df = awkward(spark, rows)
    got = toxicity.scores(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == df.count() and all(r.held_out == held_out(r.doc_id) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    own = [r for r in got if r.held_out and r.doc_id >= 100]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in own) / len(own) > 0.97


def test_toxicity_ignores_held_out_labels(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, sentence(rng, 20) + (" vile" if i % 3 == 0 else "")) for i in range(300)], "doc_id long, text string")
    labels = [(i, int(i % 3 == 0)) for i in range(300)]
    flipped = [(i, 1 - y if held_out(i) else y) for i, y in labels]
    a, b = (sorted(toxicity.scores(df, spark.createDataFrame(x, "doc_id long, toxic int")).collect()) for x in (labels, flipped))
    assert a == b


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.scores(awkward(spark), none).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.5, 1)}
    assert toxicity.scores(empty(spark), none).count() == 0


def plain_ratios(rows):
    """Word -> log ratio, from dictionaries of all runs of the labelled words; ``rows`` are (words, label or None)."""
    order, cut = toxicity.ORDER, toxicity.DISCOUNT
    def spelt(w):
        return b" " + lower(w).encode() + b" "
    def places(b):
        return [b[max(0, i + 1 - order):i + 1] for i in range(1, len(b))]
    top = [collections.Counter(), collections.Counter()]
    for own, label in rows:
        for w in own if label is not None else ():
            top[1 - label].update(places(spelt(w)))
    runs = {r[-n:] for c in top for r in c for n in range(1, len(r) + 1)}
    shared = collections.Counter(r[1:] for r in runs if len(r) > 1)
    def by_context(counts):
        total, kinds = collections.Counter(), collections.Counter()
        for r, n in counts.items():
            total[len(r), r[:-1]] += n
            kinds[len(r), r[:-1]] += 1
        return counts, total, kinds
    top, shared = list(map(by_context, top)), by_context(shared)
    def step(table, run, back):
        counts, total, kinds = table
        at = len(run), run[:-1]
        return (max(counts[run] - cut, 0) + cut * kinds[at] * back) / total[at] if total[at] else back
    def ratio(w):
        out = 0.0
        for run in places(spelt(w)):
            back = 1 / 257
            for n in range(1, len(run)):
                back = step(shared, run[-n:], back)
            out += math.log(step(top[0], run, back)) - math.log(step(top[1], run, back))
        return out
    return {w: ratio(w) for own, _ in rows for w in own}


def test_toxicity_counts_are_exact(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "ASKERS", 1)
    rng = random.Random(6)
    rows = [([("".join(rng.choice("abcdeé\0zñ日") for _ in range(rng.randint(1, 11)))) for _ in range(rng.randint(0, 60))],
             rng.choice([0, 1, None])) for _ in range(400)]
    want = plain_ratios(rows)
    df = spark.createDataFrame([(i, " ".join(own), label) for i, (own, label) in enumerate(rows)],
                               "doc_id long, text string, toxic int").repartition(3)
    packed = spark.createDataFrame(toxicity.packs(df).collect(), toxicity.PACKS + ", owner long")
    got = {r.doc_id: r for r in toxicity.features(packed, df.where("toxic is not null").select("doc_id", "toxic")).collect()}
    assert len(got) == len(rows)
    for i, (own, _) in enumerate(rows):
        ratio = [want[w] for w in own]
        assert got[i].words == len(own)
        assert got[i].mean == pytest.approx(sum(ratio) / len(ratio) if own else 0, abs=1e-4)
        assert got[i].peak_1 == pytest.approx(max(ratio, default=0), abs=1e-4)
        assert got[i].peak_4 == pytest.approx(max((sum(ratio[k:k + 4]) / 4 for k in range(len(ratio))), default=0), abs=1e-4)


def test_toxicity_packs_are_not_dealt_out_again(spark):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 400))) for _ in range(120)]
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate([*texts, None, " "])], "doc_id long, text string, toxic int").repartition(3)
    labels = df.select("doc_id", "toxic")
    plain = toxicity.packs(df).localCheckpoint()
    packed = session.store_dealt(plain, "packs", "owner")
    for found in (toxicity.run_counts(packed, labels), toxicity.features(packed, labels)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        dealt = re.findall(r"Exchange hashpartitioning\(owner.*\n.*", plan)
        assert "Bucketed: true" in plan and all("spelt" not in x for x in dealt)
    assert sorted(toxicity.features(packed, labels).collect()) == sorted(toxicity.features(plain, labels).collect())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("packs")]


def test_toxicity_packs_hold_every_word_in_order(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéZ\0ñ日") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    rows = [[words[min(int(rng.expovariate(1 / 500)), 2999)] for _ in range(rng.randint(0, 90))] for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(map(" ".join, rows))), "doc_id long, text string").coalesce(1)
    pack = toxicity.packs(df).toArrow()
    sizes, spelt, offsets, index = toxicity._unpacked(pack)
    assert len(offsets) - 1 > toxicity.COMMON and sizes.tolist() == list(map(len, rows))
    found = [spelt[offsets[i]:offsets[i + 1]].tobytes() for i in index.tolist()]
    assert found == [b" " + lower(w).encode() + b" " for own in rows for w in own]
    # Common words come first, and one byte tells them.
    assert len(toxicity._restored(pack["rare"][0].as_py(), "u4")) == (index >= toxicity.COMMON).sum() < len(index)
    assert (np.diff(np.bincount(index)) <= 0).all()


def test_toxicity_forms_runs_of_a_pack_block_by_block(monkeypatch):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 12))).encode() for _ in range(30_000)})
    spelt = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(w) + 2 for w in words])))
    run, word = toxicity._runs(spelt, offsets)
    monkeypatch.setattr(toxicity, "BLOCK", 1 << 12)
    blocks = list(toxicity._blocks(spelt, offsets))
    assert len(blocks) >= len(spelt) // toxicity.BLOCK > 50 and max(len(at) for _, at, *_ in blocks) < toxicity.BLOCK
    assert np.array_equal(np.concatenate([value[at] for value, at, *_ in blocks]), run)
    assert np.array_equal(np.concatenate([own + part.start for _, _, own, part in blocks]), word)
    assert np.array_equal(toxicity._all_runs([value for value, *_ in blocks]), np.unique(run))
    assert not list(toxicity._blocks(spelt[:0], offsets[:1]))
    del blocks, run, word
    tracemalloc.start()
    for _ in toxicity._blocks(spelt, offsets):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * len(spelt)


def test_toxicity_counts_all_but_the_calibration_rows(spark):
    rng = random.Random(9)
    apart = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 20 in (1, 2, 3, 4)]
    rows = [(i, sentence(rng, 20) + (" vile" if i % 3 == 0 else "")) for i in range(3000)]
    labels = [(i, int(i % 3 == 0)) for i in range(3000)]
    # A word that only rows of the calibration's quarter hold.
    rows = [(i, t.replace("vile", "zorgblat") if i in set(apart) else t) for i, t in rows]
    probes = [i for i in range(5000, 5100) if held_out(i)]
    rows += [(i, sentence(rng, 20) + (" zorgblat" if i % 2 else "")) for i in probes]
    df, known = (spark.createDataFrame(x, s) for x, s in ((rows, "doc_id long, text string"), (labels, "doc_id long, toxic int")))
    score = {r.doc_id: r.score for r in toxicity.scores(df, known, sample=100).collect()}
    assert min(score[i] for i in probes if i % 2) > 0.9 > 0.1 > max(score[i] for i in probes if not i % 2)


# --- tokens and packing --------------------------------------------------------------------------

def test_ids_are_those_of_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab'sstrevmld  \n\t\r  é日1２²—😀.,!  ") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["", "don't we're I'll 's x's ''s 'st", "a<|endoftext|>b", "  ", "\n\n x", "A'S it's'll", "<|endoftext|>"]
    want = [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    for own in (tokens.Encoder(path), tokens.Encoder(path, most=300)):
        for first in range(0, len(texts), 50):
            data, offsets = textbytes.buffers(pa.array(texts[first:first + 50]))
            ids, bounds = own.encode(data, offsets)
            assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want[first:first + 50]


@pytest.mark.parametrize("per_shard", [50_000, 6])
def test_packed_pieces_hold_every_id_once(spark, per_shard):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(3)
    df = awkward(spark, [(100 + i, sentence(rng, rng.randint(0, 900))) for i in range(40)])
    got = packing.packed(df, path, per_shard=per_shard).collect()
    library = Tokenizer.from_file(path)
    want = collections.Counter()
    for r in df.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        want[r.doc_id, len(ids)] += 1
        for p in [p for p in got if p.doc_id == r.doc_id and p.doc_tokens == len(ids)]:
            part = ids[p.start:p.start + p.length]
            assert len(part) == p.length and p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    have = collections.Counter()
    for p in got:
        have[p.doc_id, p.doc_tokens] += p.length
    assert have == {k: k[1] * n for k, n in want.items()}
    sequences = collections.defaultdict(list)
    for p in got:
        sequences[p.sequence_id].append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert sum(p.length for p in own) <= 2048
    assert packing.packed(empty(spark), path).count() == 0


def test_packing_leaves_little_padding():
    rng = np.random.default_rng(1)
    sizes = np.minimum(rng.lognormal(5.5, 1.2, 20_000).astype(int) + 1, 2047)
    sequence, offset = packing.pack(sizes, 2048, (256, 512, 1024, 2048))
    used = np.bincount(sequence, sizes)
    assert used.max() <= 2048 and used.sum() / (2048 * len(used)) > 0.99


@pytest.mark.parametrize("most", [120, 2047])
def test_tiers_have_windows_of_their_own(most):
    rng = np.random.default_rng(2)
    sizes = np.minimum(rng.lognormal(4.5, 1.2, 5000).astype(int) + 1, most)
    sequence, offset, window = packing.tiered(sizes, 2048, (256, 512, 1024, 2048))
    used = np.bincount(sequence, sizes)
    assert len(used) == len(window) and (used <= window).all()
    assert (used[window < 2048] == window[window < 2048]).all() and (window < 2048).any()
    assert sum((window - used)[window == 2048]) < 0.02 * used.sum()
    for k in range(len(window)):
        own = np.flatnonzero(sequence == k)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == np.cumsum([0, *sizes[own]])[:-1].tolist()
    one = packing.tiered(sizes, 2048, (2048,))
    assert set(one[2]) == {2048} and one[0].tolist() != sequence.tolist()


# --- exact top-k ---------------------------------------------------------------------------------

@pytest.mark.parametrize("per_shard", [100_000, 150])
def test_top_k_equals_brute_force(spark, per_shard):
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 0.4, (600, 8))
    vectors[300:420] = vectors[300]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    rows += [(1000, None, 0), (1020, [None] * 8, 0), (1040, [float("nan")] * 8, 0), (1060, [float("inf")] + [0.0] * 7, 0),
             (1080, [], 0), (None, [1.0] * 8, 0), (1100, [1.0, 2.0], 0), (1101, [3.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part int")
    got = collections.defaultdict(list)
    for r in topk.top_k(df, per_shard=per_shard).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    usable = {i: [math.floor(64 * x) for x in v] for i, v, _ in rows if i is not None and v and all(
        x is not None and math.isfinite(x) for x in v)}
    for q in (i for i in usable if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))
        assert got[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(scores[:20])]
    assert set(got) == {i for i in usable if i % 20 == 0}
    assert topk.top_k(df.limit(0)).count() == 0


# --- benchmark passages --------------------------------------------------------------------------

def test_wand_finds_what_full_scoring_finds():
    rng = random.Random(6)
    rows = [collections.namedtuple("Row", "item_id question answer")(i, sentence(rng, rng.randint(5, 30)), sentence(rng, 4)) for i in range(90)]
    rows = [type("Row", (), {**r._asdict(), "__getitem__": lambda self, k: getattr(self, k)})() for r in rows]
    both, _ = decontaminate._words(pa.array([f"{r.question} {r.answer}" for r in rows]))
    frequency = collections.Counter(t for i in range(len(rows)) for t in set(both.hash[both.text == i].tolist()))
    index = decontaminate.build(rows, frequency, len(rows), len(both.hash) / len(rows), 34, 0.5)
    for _ in range(60):
        terms = rng.sample(range(len(index.terms)), rng.randint(1, 90))
        full = collections.Counter()
        for t in terms:
            for i, w in zip(index.items[t], index.weights[t]):
                full[i] += w
        want = {i for i, s in full.items() if s >= 0.2}
        blocks = range(-(-len(rows) // decontaminate.BLOCK))
        assert {i for b in blocks for i, _ in decontaminate.wand(index, terms, b, 0.2)} == want
        passages, found = decontaminate.candidates(index, np.zeros(len(terms), np.int64), np.array(terms), np.array([True]), 0.5)
        assert {i // decontaminate.BLOCK for i, s in full.items() if s >= 0.5} <= set(found.tolist())


def test_benchmark_passages_are_found(spark):
    rng = random.Random(7)
    items = [(i, ". ".join(sentence(rng, rng.randint(6, 25)) for _ in range(2))) for i in range(50)]
    rows = [(100 + i, sentence(rng, rng.randint(0, 400))) for i in range(60)]
    rows += [(200 + i, f"{sentence(rng, rng.randint(0, 300))} {upper(t)}!\n{sentence(rng, rng.randint(0, 300))}") for i, t in items]
    rows += [(300 + i, sentence(rng, 50) + " " + t.split(". ")[0]) for i, t in items]  # a question without its answer
    table = spark.createDataFrame([*items, (None, "x y z"), (90, None), (91, ""), (3, items[3][1])], "item_id long, text string")
    got = decontaminate.contaminated(awkward(spark, rows), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(200 + i, i) for i, _ in items}
    again = decontaminate.contaminated(awkward(spark, rows), table, block_bytes=2000).collect()
    assert sorted(got) == sorted(again)
    assert decontaminate.contaminated(empty(spark), table).count() == 0
    assert decontaminate.contaminated(awkward(spark), table.limit(0)).count() == 0


# --- personal data -------------------------------------------------------------------------------

PLAIN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if ((kind == 0) or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                    or (kind == 2 and 12 <= len(digits) <= 19 and pii.luhn(digits)) or (kind == 3 and 9 <= len(digits) <= 15)):
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_are_those_of_the_plain_patterns():
    rng = random.Random(3)
    for n in range(20_000):
        text = "".join(rng.choice("01259.@-+ ()ab%é") for _ in range(rng.randint(0, 40)))
        text = "".join(rng.choice("0123456789") for _ in range(rng.randint(11, 20))) + text if n % 4 == 0 else text
        assert pii.base_spans(text) == plain_spans(text)
    for text in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "+" * 200_000, "@" * 200_000, "a@" * 100_000):
        pii.base_spans(text)


def test_tagger_gradients():
    rng = np.random.default_rng(1)
    chars = rng.integers(1, 120, (4, 12))
    tags = np.zeros((4, 12), np.int64)
    tags[:, 3], tags[:, 4:7] = 1, 2
    model = tagger.Tagger(2, hidden=4)
    _, grads = model._gradients(chars, tags)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        own, e = model.weights[name], 1e-2
        middle = own[at]
        own[at] = middle + e
        high = model._gradients(chars, tags)[0]
        own[at] = middle - e
        low = model._gradients(chars, tags)[0]
        own[at] = middle
        assert abs((high - low) / (2 * e) - g[at]) < 0.05 * max(1, abs(g[at]))


def test_reconciling_takes_the_heaviest_set():
    rng = random.Random(2)
    for _ in range(200):
        spans = [(a, a + rng.randint(1, 9), rng.randint(0, 3), rng.random()) for a in (rng.randint(0, 20) for _ in range(rng.randint(0, 8)))]
        best = max((sum(s[3] for s in own) for n in range(1 << len(spans)) for own in [[s for k, s in enumerate(spans) if n >> k & 1]]
                    if all(x[1] <= y[0] or y[1] <= x[0] for i, x in enumerate(own) for y in own[i + 1:])), default=0)
        weights = {s[:3]: s[3] for s in sorted(spans, key=lambda s: s[3])}
        assert abs(sum(weights[s] for s in pii.reconcile(spans)) - best) < 1e-9


def test_personal_data(spark):
    rng = random.Random(4)

    def card():
        body = "".join(rng.choice("0123456789") for _ in range(15))
        return next(body + c for c in "0123456789" if pii.luhn(body + c))
    kinds = [lambda: f"x{rng.randint(1, 99)}.b@mail{rng.randint(1, 9)}.example.com", lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
             card, lambda: f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"]
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
    rows = [(100 + i, " ".join([*(word() for _ in range(rng.randint(3, 30))), rng.choice(kinds)(), *(word() for _ in range(12))]))
            for i in range(500)]
    bare = " ".join(word() for _ in range(20)) + " 9767488341077692 " + " ".join(word() for _ in range(20))
    df = awkward(spark, [*rows, (1000, bare)])
    got = pii.digest(pii.personal_data(df, sample=300)).collect()
    texts = collections.defaultdict(set)
    for r in df.collect():
        texts[r.doc_id].add(r.text or "")
    assert len(got) == df.count()
    for r in got:
        wanted = set()
        for t in texts[r.doc_id]:
            base = plain_spans(t)
            written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, b, k in base)
            counts = tuple(sum(k == n for _, _, k in base) for n in range(4))
            wanted.add((hashlib.sha256(written.encode()).hexdigest(), counts))
            if not r.n_added and (hashlib.sha256(written.encode()).hexdigest() == r.base_sha256):
                assert r.spans == written
        assert (r.base_sha256, (r.n_email, r.n_ip, r.n_card, r.n_phone)) in wanted
    added = sum(r.n_added for r in got if r.doc_id != 1000 and r.doc_id is not None and r.doc_id >= 100)
    assert added <= 25
    model = pii.train(df.selectExpr("doc_id", "coalesce(text, '') as text"), sample=300)
    hit = total = 0
    for _, t in rows[:200]:
        points = np.frombuffer(t.encode("utf-32-le"), np.uint32)
        mine = set(pii.tagged(model, [(points, np.flatnonzero(pii.TRIGGER[np.minimum(points, 255)]))], -0.3)[0])
        base = set(pii.base_spans(t))
        hit, total = hit + len(mine & base), total + len(base)
    assert hit / total > 0.9


def added(model, text):
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return pii.tagged(model, [(points, pii.triggers(text, points))], -0.3)[0]


def test_each_altered_address_is_added():
    rng = random.Random(12)

    def name(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, n)))
    texts = [" ".join(["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(1, 8))) for _ in range(9)]
                      + [f"{name(9)}.{name(9)}@{name(9)}.{rng.choice(['com', 'org', 'net'])}", "at home to the dot and rest"])
             for _ in range(250)]
    model = tagger.Tagger(len(pii.KINDS))
    model.train(*(x[:900] for x in pii.examples(texts)))
    for address in ("jane.doe@example.com", "maria.hernandez@northwind.org", "benedict.applewood@granthamsmith.net"):
        for turn, sign in enumerate((" at ", "(at)", "@")):
            text = f"please write some lines to {pii.altered(address, 0, turn)} and then wait for the rest of them"
            at = text.index(sign, text.index("to") + 3)
            assert any(k == 0 and a < at < b for a, b, k in added(model, text)), text


def test_spans_longer_than_a_window_are_added():
    class Model:
        def decode(self, rows):
            inside = (rows == ord("x")) | (rows == ord("7"))
            tags = np.where(inside, 2, 0)
            tags[:, 1:][inside[:, 1:] & ~inside[:, :-1]] = 1
            return tags, np.zeros(rows.shape)
    for n in (10, 25, 50, 200):
        text = "a " * 60 + "x" * n + "7" + "x" * n + " a" * 60
        assert added(Model(), text) == [(120, 121 + 2 * n, 0)]


def test_personal_data_of_an_empty_table(spark):
    assert pii.personal_data(empty(spark)).count() == 0


# --- WARC and licences ---------------------------------------------------------------------------

def test_warc_records_of_awkward_responses(spark, tmp_path):
    df = spark.createDataFrame([
        ("<urn:uuid:1>", "http://a/", "2020-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nContent-Type: text/html", "<p>a &amp;lt; b</p><script>x", "p"),
        ("<urn:uuid:2>", "http://b/", "2020-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\ncontent-type: text/plain", "as it <is>", "p"),
        ("<urn:uuid:3>", None, None, "HTTP/1.1 200 OK\r\nContent-Type: image/png", "....", "p"),
        (None, "http://d/", None, None, None, None)], "record_id string, target_uri string, date string, http_headers string, payload string, block string")
    rows = {(r.refers_to, r.record_type): r for r in warc.derivatives(df).collect()}
    assert len(rows) == 8
    assert rows["<urn:uuid:1>", "conversion"].block == "a &lt; b"
    assert rows["<urn:uuid:2>", "conversion"].block == "as it <is>"
    assert rows["<urn:uuid:3>", "conversion"].block == ""
    assert "source-header: Content-Type: text/html\r\n" in rows["<urn:uuid:1>", "metadata"].block
    for r in rows.values():
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert f"WARC-Refers-To: {r.refers_to}\r\n" in r.header and r.content_length == len(r.block.encode())
    assert len({r.record_id for r in rows.values()}) == 8
    warc.write_records(warc.derivatives(df), str(tmp_path / "out"))
    text = "".join(r.value for r in spark.read.option("lineSep", "\0").text(str(tmp_path / "out")).collect())
    assert text.count("WARC/1.1\r\n") == 8
    assert warc.derivatives(df.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, None, None), (None, "http://x y\n/", "<html lang='de'><title>T\n t</title><a href='q'>z</a>")],
                                  "page_id long, url string, html string")
    got = {r.target_uri: r.block for r in warc.derivatives(warc.responses(pages)).where("record_type = 'metadata'").collect()}
    assert got["http://xy/"].startswith("title: T t\r\nlanguage: de\r\noutlink: q\r\n")


def test_licence_scan(spark):
    mit = dict((t[:20], t) for _, t in licences.TEMPLATES)["Permission is hereby"]
    wrapped = re.sub(r"((?:\S+ ){9})", r"\1\n", mit).lower()
    df = awkward(spark, [(100, "Text\nLICENSED under the Apache-License, version 2.0\nmore"), (101, wrapped), (102, f"intro here\n\n{wrapped}\n\nend"),
                         (103, mit[:len(mit) // 2]), (104, "Licensed under CC BY-SA 4.0."), (104, "Licensed under CC BY-SA 4.0.")])
    got = sorted((r.doc_id, r.unit, r.position, r.licence, r.dice) for r in licences.scan(df).collect())
    assert got == [(100, "line", 1, "Apache-2.0", 1.0), (101, "paragraph", 0, "MIT", 1.0), (101, "text", 0, "MIT", 1.0),
                   (102, "paragraph", 1, "MIT", 1.0), (102, "text", 0, "MIT", pytest.approx(0.97, abs=0.02)),
                   (104, "line", 0, "CC-BY-SA-4.0", 1.0), (104, "line", 0, "CC-BY-SA-4.0", 1.0)]
    assert licences.scan(empty(spark)).count() == 0
