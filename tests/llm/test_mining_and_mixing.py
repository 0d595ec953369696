"""Collocations, periodic runs and source mixes against plain versions, and on awkward tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from panelwright.llm import collocations, mixing, periodic, topk

CLASHING = "doc_id long, text string, lang string, source string, word string, bucket long, part string, size int, f long"


def awkward(spark, rows):
    """Rows (doc_id, text, lang, source) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "w", 1, "p", 2, 3) for r in rows], CLASHING)


def texts(seed, count, vocabulary, longest):
    rng = random.Random(seed)
    words = [rng.choice("abcdefgHé") * rng.randint(1, 3) + str(i) for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    out = []
    for i in range(count):
        text = "".join(w + rng.choice([" "] * 9 + [". ", "\n", "\t", "  ", ",", "\x1f "])
                       for w in rng.choices(words, weights, k=rng.randint(0, longest)))
        out.append((i, text, rng.choice(["en", "de", None, "und", ""]), rng.choice(["a", "b", None, ""])))
    return out


# --- collocations --------------------------------------------------------------------------------

def plain_collocations(rows, least, contained, scale, top):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3, 4):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    cover = collections.Counter()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                key = lang, words[i:i + k]
                cover[key] = max(cover[key], a)
    out = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * cover[lang, words] >= contained * a and cover[lang, words]:
            continue
        score, _, left, right = min(
            (scale * a // (f[lang, words[:k]] + f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
            for k in range(1, len(words)))
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return {(lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score)
            for lang, found in out.items() for i, (score, a, phrase, left, right) in enumerate(sorted(found)[:top])}


@pytest.mark.parametrize("per_bucket, most_common, top", [(400_000, 1 << 20, 2000), (300, 1 << 20, 2000), (2000, 4, 25)])
def test_collocations_agree_with_plain_counts(spark, per_bucket, most_common, top):
    rows = texts(1, 400, 60, 80)
    rows += [rows[5]] * 40 + [(None, None, "en", "a"), (1, "", None, None), (2, " \t.,", "en", "a"), (3, "x" * 70_000, "en", "a"),
                             (4, "one two three four five six. " * 50, "fr", "b"), (5, "a b c " * 3000, "fr", "b")]
    got = collocations.collocations(awkward(spark, rows), 5, top=top, per_bucket=per_bucket, most_common=most_common)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain_collocations(rows, 5, 80, 2_000_000, top)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 50


def test_a_common_pair_with_many_neighbours(spark):
    """Both words of the pair are common ones, so the pair meets in several buckets and is added up."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"x{rng.randint(0, 500)} of the y{rng.randint(0, 500)}" for _ in range(40)), "en", "a") for i in range(60)]
    got = collocations.collocations(awkward(spark, rows), 30, per_bucket=400)
    assert {tuple(r) for r in got.collect()} == plain_collocations(rows, 30, 80, 2_000_000, 2000)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(awkward(spark, [(1, "a b", "en", "s")]).limit(0)).collect() == []
    assert collocations.collocations(awkward(spark, [(1, None, None, "s")])).collect() == []


def test_scores_beyond_64_bits(spark):
    """floor(scale * a / (l + r)) is taken in decimals; with this scale the products pass 64 bits."""
    rows = [(i, "p q", "en", "s") for i in range(1000)]
    got = collocations.collocations(awkward(spark, rows), 30, scale=10**17).collect()
    assert [(r.phrase, r.a, r.score) for r in got] == [("p q", 1000, 10**17 // 2)]


# --- periodic runs -------------------------------------------------------------------------------

def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            stretch = words[i:j + q]
            if len(stretch) >= max(6, 4 * q) and not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                out.append((i, len(stretch), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else [None] * 4),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def stretches(seed, count):
    rng = random.Random(seed)

    def piece():
        k, letters = rng.choice([1, 1, 2, 3, 5, 8, 20, 33, 40, 64, 65, 100, 130]), rng.choice([2, 2, 3, 50])
        root = [str(rng.randrange(letters)) for _ in range(k)]
        return [root[i % k] for i in range(rng.randint(1, 7 * k))]

    return [(i, rng.choice([" ", "\n", " \t"]).join(itertools.chain(*(piece() for _ in range(rng.randint(0, 5))))), None, None)
            for i in range(count)]


@pytest.mark.parametrize("direct", [1, 4, 32])
def test_runs_agree_with_comparing_all_lags(spark, direct):
    rows = stretches(5, 250)
    rows += [rows[3]] * 3 + [(None, "a a a a a a a", "en", "s"), (None, None, None, None), (900, None, "en", "s"), (901, "", "en", "s"),
                             (902, " \n", "en", "s"), (3, "x " * 10, "en", "s"), (904, "A a " * 5, "en", "s"), (905, "é" * 9000, "en", "s")]
    found = periodic.digest(periodic.periodic_runs(periodic.with_repetitions(awkward(spark, rows)), direct=direct))
    got = collections.Counter(tuple(r) for r in found.collect())
    assert got == collections.Counter(plain_digest(*r[:2]) for r in rows)


def test_a_very_long_text(spark):
    """Periods of thousands of words, over the bound of a chunk and with a run inside the root."""
    rng = random.Random(8)
    root = [str(rng.randrange(10**6)) for _ in range(60_000)]
    root[100:140] = ["z"] * 40
    words = ["start"] * 3 + root * 4 + root[:777]
    got = periodic.periodic_runs(awkward(spark, [(1, " ".join(words), None, None), (2, "b", None, None)])).where("doc_id = 1").first()
    assert got.n_words == len(words)
    want = [(3, 4 * 60_000 + 777, 60_000)] + [(3 + 100 + k * 60_000, 40, 1) for k in range(5)]
    assert [tuple(r) for r in got.runs] == sorted(want)
    assert got.collapsed == " ".join(words[:3 + 101] + words[3 + 140:3 + 60_000])


def test_runs_of_nothing(spark):
    none = awkward(spark, [(1, "a", "en", "s")]).limit(0)
    assert periodic.digest(periodic.periodic_runs(periodic.with_repetitions(none))).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(none, turns=3)


# --- mixes ---------------------------------------------------------------------------------------

def plain_targets(sizes, weights, most):
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        weight = sum(w for s, w in weights.items() if s not in capped)
        over = {s for s in sizes if s not in capped and weights[s] * left >= most * sizes[s] * weight}
        if not over:
            return {s: most * sizes[s] if s in capped else weights[s] * left / weight for s in sizes}
        capped |= over


def test_one_source_each(spark):
    rows = texts(2, 300, 40, 30)
    rows += [rows[7]] * 20 + [(None, "a b c", "en", "c"), (9000, None, "en", "empty"), (9001, "", "en", "empty"), (9002, "a " * 5000, "en", "d")]
    docs = awkward(spark, rows)
    got = mixing.by_source(docs).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").replace("\x1f", "x").split())
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = plain_targets(sizes, {s: 1 + i % 3 for i, s in enumerate(ordered)}, 3)
    taken, source_of = collections.Counter(), dict((r[0], r[3]) for r in rows)
    for r in got:
        assert r.size <= 3 * r.size and 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[source_of[r.doc_id]] and r.target == pytest.approx(want[source_of[r.doc_id]])
        taken[source_of[r.doc_id]] += r.taken
    for s in sizes:
        assert want[s] - 21 <= taken[s] <= want[s]
    assert sorted(map(str, mixing.by_source(docs).collect())) == sorted(map(str, got))


def test_the_mix_depends_on_the_seed_alone(spark):
    docs = awkward(spark, texts(4, 200, 40, 30))
    one = F.array("source")
    weight = lambda _, n: n
    mixes = [{(r.doc_id, r.taken) for r in mixing.mixture(d, one, weight, 3, seed)[0].collect()}
             for d, seed in ((docs, "x"), (docs.repartition(7), "x"), (docs, "y"))]
    assert mixes[0] == mixes[1] != mixes[2]


def cost(words, taken):
    return sum(max(t - w, 0) + max(t - 2 * w, 0) for w, t in zip(words, taken))


def reachable(words, members, quota, taken):
    """Whether taken words can be dealt to the sources so that each gets its quota."""
    for subset in itertools.chain.from_iterable(itertools.combinations(quota, k) for k in range(1, len(quota) + 1)):
        if sum(t for t, m in zip(taken, members) if set(m) & set(subset)) < sum(quota[s] for s in subset):
            return False
    return True


def test_the_flow_is_the_cheapest():
    rng = random.Random(6)
    tried = 0
    for _ in range(400):
        members = [m for k in (1, 2, 3) for m in itertools.combinations(range(3), k) if rng.random() < 0.5][:4]
        words = [rng.randint(0, 3) for _ in members]
        quota = {s: rng.randint(0, 5) for s in range(3)}
        options = [t for t in itertools.product(*(range(3 * w + 1) for w in words))
                   if sum(t) == sum(quota.values()) and reachable(words, members, quota, t)]
        if not options:
            continue
        tried += 1
        got = mixing.route(words, [list(m) for m in members], quota, 3)
        assert tuple(got) in options and cost(words, got) == min(cost(words, t) for t in options)
    assert tried > 30


def test_shared_documents_fill_several_sources(spark):
    """Documents of two sources serve the one that lacks words; every source gets its target."""
    rows = [(i, "w " * 10, "en", None) for i in range(90)]
    docs = awkward(spark, rows)
    belongs = F.when(F.col("doc_id") < 30, F.array(F.lit("a"))).when(
        F.col("doc_id") < 60, F.array(F.lit("b"), F.lit("a"), F.lit("b"))).when(
        F.col("doc_id") < 80, F.array(F.lit("c"), F.lit(None).cast("string")))
    taken, listed = mixing.mixture(docs, belongs, lambda name, n: F.when(name == "b", 3).otherwise(1), 3)
    sources = {r.source: r for r in listed.collect()}
    assert {s: r.number for s, r in sources.items()} == {"a": 1, "b": 2, "c": 3, None: 4}
    assert sources["a"].source_size == 600 and sources["b"].source_size == 300 and sources[None].source_size == 200
    assert sum(r.target for r in sources.values()) == pytest.approx(900)
    by_pattern = collections.Counter()
    for r in taken.collect():
        assert r.taken <= 3 * r.size and (r.sources or r.taken == 0)
        by_pattern[tuple(r.sources)] += r.taken
    assert by_pattern["a", "b"] >= sources["b"].quota
    assert by_pattern["a",] + by_pattern["a", "b"] == sources["a"].quota + sources["b"].quota
    assert by_pattern[None, "c"] + by_pattern["c", None] == sources["c"].quota + sources[None].quota


def test_a_mix_of_nothing(spark):
    assert mixing.by_source(awkward(spark, [(1, "a", "en", "s")]).limit(0)).collect() == []
    only = mixing.by_source(awkward(spark, [(1, None, "en", "s")])).collect()
    assert [tuple(r) for r in only] == [(1, 0, 0, 0.0, 0)]


# --- top k of large components -------------------------------------------------------------------

@pytest.mark.parametrize("size", [1e6, 1.5e7])
def test_components_of_any_size(spark, size):
    """Beyond 2**53 sums of doubles are not exact; scores are, and ties of their roundings are told apart."""
    rng = random.Random(int(size))
    rows = [(i, [rng.choice([1, -1]) * rng.choice([size, size + rng.randint(0, 2) / 64, rng.random()]) for _ in range(6)])
            for i in range(240)] + [(500, [20000.0] * 6)]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>"), per_shard=70).collect()}
    whole = {i: [math.floor(64 * x) for x in v] for i, v in rows}
    for q in whole:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
            assert [got[q, k + 1] for k in range(20)] == [(i, -s) for s, i in scores[:20]]
