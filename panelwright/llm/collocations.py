"""Collocations of two to four words from a weighted de Bruijn graph of the corpus.

Nodes are runs of three words, edges runs of four that lead from a node to the one it overlaps. A word's edge starts
with it; near the end of a piece it is the shorter run that is left, the correction for what flows out of no further
edge. So each word gives one edge, and a shorter phrase's count is the sum of the edges that start with it.

* Within some megabytes of text equal edges are added up. Unary paths, edges that follow each other with one weight,
  travel as one run of words; a path is cut where its edges belong to different buckets.
* An edge's bucket depends on its first two words only: on the one that comes first in the order of hashes. So all
  edges of a pair meet in one bucket and the flow is summed there. Words with more than a fixed share of all
  occurrences choose no bucket: if both are such words, the pair does. What the rarer one's count says may be too much for a
  bucket is dealt to several by the third word, and the pair's partial sums are added up afterwards. At most
  ``most_common`` words can have that share; they and their counts are what is broadcast.
* Buckets give phrases that are frequent enough and nothing else. Scores and containment are joins of these phrases.

Words are told apart by 64-bit hashes within a bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm import textbytes as T
from panelwright.llm import wordspans as S
from panelwright.session import store

U64 = np.uint64
CUTS = b".,;:!?\n\x0b\x0c\r"
LONGEST = 4
CHUNK = 1 << 22
PER_BUCKET = 300_000
_CUT = S.table(CUTS)
_BREAK = S.table([*CUTS, *S.BLANKS])


SQL = r"""
with d as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
e as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
g as (select lang, k as size, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f
      from e, (select unnest([1, 2, 3, 4]) as k) where i + k - 1 <= len(w) group by all),
n as (select lang, cast(sum(f) as bigint) as n from g where size = 1 group by lang),
c as (select *, string_split(phrase, ' ') as w from g where size > 1 and f >= 30),
inside as (select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, max(f) as cover
           from c, (select unnest([2, 3]) as k), (select unnest([1, 2, 3]) as i)
           where k < size and i + k - 1 <= size group by all),
kept as (select c.* from c left join inside using (lang, phrase) where cover is null or 100 * cover < 80 * f),
cut as (select lang, phrase, w, f as a, size, k from kept, (select unnest([1, 2, 3]) as k) where k < size),
s as (select cut.lang, cut.phrase, cut.a, cut.k, x.f as l, y.f as r,
             cast((2000000::hugeint * cut.a) // (x.f::hugeint + y.f) as bigint) as score
      from cut join g x on x.lang = cut.lang and x.phrase = array_to_string(w[1:k], ' ')
               join g y on y.lang = cut.lang and y.phrase = array_to_string(w[k + 1:], ' ')),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
r as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b)
select lang, rank, phrase, a, l, r, n, score from r join n using (lang) where rank <= 2000"""


class Edges:
    """The words of a chunk of texts, each the start of one edge, as arrays."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray):
        self.data = T._LOWER[data]
        self.start, self.end, text = S.bounds(self.data, offsets, _BREAK)
        self.lang = lang[text]
        piece = np.cumsum(_CUT[self.data], dtype=np.int32)[self.start] if len(self.start) else self.start
        self.follows = np.zeros(len(self.start) + 1, dtype=bool)
        self.follows[1:-1] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
        self.hash = S.hashes(self.data, self.start, self.end)
        with np.errstate(over="ignore"):
            own = T.mix(self.hash + U64(0x51ED270B) * (self.lang.astype(U64) + U64(1)))
        _, self.first, self.word = np.unique(own, return_index=True, return_inverse=True)
        # How many words an edge has: four, or what is left of its piece.
        size = np.ones(len(self.start), np.int64)
        more = np.ones(len(self.start), dtype=bool)
        for step in range(1, LONGEST):
            more &= np.append(self.follows[step:-1], np.zeros(min(step, len(more)), dtype=bool))[:len(more)]
            size += more
        self.size = size

    def ahead(self, values: np.ndarray, step: int) -> np.ndarray:
        """The value ``step`` words on, plus one; 0 beyond the edge."""
        out = np.zeros(len(values), np.int64)
        if step < len(values):
            out[:len(values) - step] = values[step:].astype(np.int64) + 1
        out[self.size <= step] = 0
        return out


def chunks(batch: pa.RecordBatch, limit: int = CHUNK):
    """(langs, Edges) for chunks of a batch with text and lang."""
    data, offsets = T.buffers(batch["text"])
    for first, last in T.chunks(offsets, limit):
        names = batch["lang"][first:last].dictionary_encode()
        own = offsets[first:last + 1] - offsets[first]
        yield names.dictionary.to_pylist(), Edges(
            data[offsets[first]:offsets[last]], own, names.indices.to_numpy(zero_copy_only=False).astype(np.int64))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f); the row with null for a word has the number of all words of its lang."""

    def run(batches):
        for batch in batches:
            for names, edges in chunks(batch):
                found = np.bincount(edges.word, minlength=len(edges.first))
                a, b, lang = (x[edges.first] for x in (edges.start, edges.end, edges.lang))
                out, ends = S.joined(edges.data, a, b, np.ones(len(a), dtype=bool))
                words = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(a), [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(out)])
                totals = np.bincount(edges.lang, minlength=len(names))
                yield pa.RecordBatch.from_arrays([
                    pa.array(names).take(pa.array(np.append(lang, np.arange(len(names))))),
                    pa.concat_arrays([words.cast(pa.large_string()), pa.nulls(len(names), pa.large_string())]).cast(pa.string()),
                    pa.array(np.append(found, totals).astype(np.int64))], ["lang", "word", "f"])

    counted = texts.mapInArrow(run, "lang string, word string, f long")
    return counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def paths(texts: DataFrame, common: list[tuple[str, str, int]], buckets: int, per_bucket: int) -> DataFrame:
    """(bucket, langs, words, marks): unary paths of every chunk, packed per bucket.

    ``words`` are the paths, one a line; ``marks`` has four numbers for each: edges, weight, place of its lang in
    ``langs``, and whether its pairs are dealt to several buckets. ``common`` are words with their lang and count.
    """
    apart: dict[str, list[tuple[bytes, int]]] = {}
    for lang, word, f in common:
        apart.setdefault(lang, []).append((word.encode(), f))
    # Hashes and counts of the common words per lang.
    heavy = {}
    for lang, found in apart.items():
        data = np.frombuffer(b" ".join(w for w, _ in found), np.uint8)
        size = np.array([len(w) for w, _ in found])
        ends = np.cumsum(size + 1) - 1
        own = S.hashes(data, ends - size, ends)
        order = np.argsort(own)
        heavy[lang] = own[order], np.array([f for _, f in found])[order]
    shared = texts.sparkSession.sparkContext.broadcast(heavy)

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for names, e in chunks(batch):
                if not len(e.start):
                    continue
                code = S.codes(*(e.ahead(e.word, step) for step in range(LONGEST)))
                _, first, group = np.unique(code, return_index=True, return_inverse=True)
                weight = np.bincount(group)[group]
                # A word alone is counted already.
                chosen = np.zeros(len(code), dtype=bool)
                chosen[first] = e.size[first] > 1
                often = np.zeros(len(code), np.int64)
                for i, name in enumerate(names):
                    if name in shared.value:
                        known, f = shared.value[name]
                        at = np.minimum(np.searchsorted(known, e.hash), len(known) - 1)
                        often[(e.lang == i) & (known[at] == e.hash)] = f[at][(e.lang == i) & (known[at] == e.hash)]
                rarer = np.minimum(often, np.append(often[1:], 0))
                parts = -(-rarer // max(per_bucket // 2, 1))
                nothing = U64((1 << 64) - 1)
                with np.errstate(over="ignore"):
                    seed = np.array([T.hashes(np.frombuffer(x.encode() or b" ", np.uint8), np.array([0]),
                                              np.array([max(len(x.encode()), 1)]))[0] for x in names], U64)[e.lang]
                    own = T.mix(e.hash ^ seed)
                    key = np.where(often > 0, nothing, own)
                    low = np.minimum(key, np.append(key[1:], nothing))
                    after = np.append(own[1:], U64(0))
                    third = np.append(own[2:], np.zeros(min(2, len(own)), U64))
                    third[e.size < 3] = 0
                    pair = T.mix(T.mix(own * U64(3) + after) + third % np.maximum(parts, 1).astype(U64))
                both = parts > 1
                bucket = (np.where(rarer > 0, pair, low) % U64(buckets)).astype(np.int64)
                keep = np.zeros(len(code), dtype=bool)
                keep[1:] = (chosen[1:] & chosen[:-1] & e.follows[1:-1] & (weight[1:] == weight[:-1])
                            & (bucket[1:] == bucket[:-1]) & (both[1:] == both[:-1]))
                head = np.flatnonzero(chosen & ~keep)
                if not len(head):
                    continue
                until = np.append(keep[1:], False)
                tail = np.flatnonzero(chosen & ~until)
                order = np.argsort(bucket[head], kind="stable")
                head, tail = head[order], tail[order]
                edges_ = tail - head + 1
                count = edges_ - 1 + e.size[tail]
                word = S.ranges(head, count)
                last = np.zeros(len(word), dtype=bool)
                last[np.cumsum(count) - 1] = True
                out, ends = S.joined(e.data, e.start[word], e.end[word], last, 32, 10)
                lines = ends[np.cumsum(count) - 1]
                marks = np.stack([edges_, weight[head], e.lang[head], both[head]], 1).astype("<i4")
                there, at = np.unique(bucket[head], return_index=True)
                stop = np.append(at[1:], len(head))
                text = memoryview(out)
                yield pa.RecordBatch.from_arrays([
                    pa.array(there), pa.array([names] * len(there), pa.list_(pa.string())),
                    pa.array([pack.compress(text[lines[a - 1] if a else 0:lines[b - 1]]) for a, b in zip(at, stop)], pa.binary()),
                    pa.array([pack.compress(marks[a:b].tobytes()) for a, b in zip(at, stop)], pa.binary())],
                    ["bucket", "langs", "words", "marks"])

    return texts.mapInArrow(run, "bucket long, langs array<string>, words binary, marks binary")


def sums(order: np.ndarray, weight: np.ndarray, *parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place in ``order`` and weight of every run of equal parts."""
    fresh = np.zeros(len(order), dtype=bool)
    fresh[0] = True
    for part in parts:
        there = part[order]
        fresh[1:] |= there[1:] != there[:-1]
    first = np.flatnonzero(fresh)
    return first, np.add.reduceat(weight[order], first)


def flows(packed: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, f, partial): phrases of two to four words that occur ``least`` times or more.

    ``partial`` are sums of pairs of common words, of any size; they have to be added up.
    """

    def run(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        langs: dict[str, int] = {}
        texts, marks = [], []
        for names, words, mark in zip(*(table[c].to_pylist() for c in ("langs", "words", "marks"))):
            own = np.frombuffer(unpack.decompress(mark), "<i4").reshape(-1, 4).astype(np.int64)
            own[:, 2] = np.array([langs.setdefault(x, len(langs)) for x in names])[own[:, 2]]
            texts.append(unpack.decompress(words))
            marks.append(own)
        data, mark = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(marks)
        ends = np.flatnonzero(data == 10)
        start, end, line = S.bounds(data, np.append(0, ends + 1), S.table((10, 32)))
        with np.errstate(over="ignore"):
            lang = mark[line, 2]
            own = T.mix(S.hashes(data, start, end) + U64(0x51ED270B) * (lang.astype(U64) + U64(1)))
        word = np.unique(own, return_inverse=True)[1] + 1
        del own
        length = np.bincount(line, minlength=len(mark))
        head = np.cumsum(length) - length
        at = S.ranges(head, mark[:, 0])
        edge = np.repeat(np.arange(len(mark)), mark[:, 0])
        size = np.minimum(LONGEST, head[edge] + length[edge] - at)
        weight, both = mark[edge, 1], mark[edge, 3].astype(bool)
        word = np.append(word, np.zeros(LONGEST, word.dtype))
        parts = [np.where(size > k, word[at + k], 0) for k in range(LONGEST)]
        two = S.codes(parts[0], parts[1])
        order = np.lexsort((parts[3], parts[2], two))
        out = []
        for n in range(2, LONGEST + 1):
            first, f = sums(order, weight, *[two, *parts[2:n]])
            place = order[first]
            part = both[place] & (n == 2)
            good = (size[place] >= n) & ((f >= least) | part)
            out.append((place[good], np.full(good.sum(), n), f[good], part[good]))
        place, n, f, part = (np.concatenate(x) for x in zip(*out))
        shown = S.ranges(at[place], n)
        last = np.zeros(len(shown), dtype=bool)
        last[np.cumsum(n) - 1] = True
        text, stops = S.joined(data, start[shown], end[shown], last)
        stops = np.append(0, stops[np.cumsum(n) - 1]) if len(n) else np.zeros(1, np.int64)
        phrases = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(n), [None, pa.py_buffer(stops), pa.py_buffer(text)])
        return pa.table({
            "lang": pa.array(list(langs)).take(pa.array(mark[edge[place], 2])), "phrase": phrases.cast(pa.large_string()).cast(pa.string()),
            "size": pa.array(n, pa.int32()), "f": pa.array(f, pa.int64()), "partial": pa.array(part)})

    return packed.groupBy("bucket").applyInArrow(run, "lang string, phrase string, size int, f long, partial boolean")


def phrase_counts(docs: DataFrame, least: int = 30, most_common: int = 1 << 20,
                  per_bucket: int = PER_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of one to four words that occur ``least`` times in their lang, and
    (lang, n), the number of all its words. ``docs`` has text and lang; see ``collocations`` for the words."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("string").alias("text"))
    counts = word_counts(texts)
    counts = store(counts.where(F.col("word").isNull() | (F.col("f") >= least)), "word_counts")
    n = counts.where("word is null").select("lang", F.col("f").alias("n"))
    words = counts.where("word is not null").select(
        "lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "f")
    total = n.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // per_bucket))
    # A word with this share or more of all occurrences; there can't be more than ``most_common`` of them.
    share = max(-(-total // most_common), per_bucket // 8, 1)
    common = [tuple(r) for r in words.where(F.col("f") >= share).select("lang", "phrase", "f").collect()]
    found = store(flows(paths(texts, common, buckets, per_bucket), least), "phrases")
    pairs = found.where("partial").groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    longer = found.where("not partial").drop("partial").unionByName(pairs.where(F.col("f") >= least))
    return words.unionByName(longer), n


def part_of(size: int, first: int, last: int) -> Column:
    return F.array_join(F.slice("_words", first, last - first + 1), " ")


def collocations(docs: DataFrame, least: int = 30, contained: int = 80, scale: int = 2_000_000, top: int = 2000,
                 most_common: int = 1 << 20, per_bucket: int = PER_BUCKET) -> DataFrame:
    """The ``top`` collocations of every lang: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has text and lang (null: ``und``); other columns are ignored. A-Z count as a-z. Texts are split at
    ``.,;:!?`` and line ends into pieces, these at blanks and tabs into words; a null or empty text has none, and an
    empty table gives no rows. Repeated rows count as often as they are there. A candidate is a phrase of two
    to four words that occurs ``least`` times (``a``). Of its cuts into a first part (``l`` times) and a rest (``r`` times) the one with the
    lowest floor(scale * a / (l + r)) counts, the earliest of equal ones. Candidates inside a longer one with at
    least ``contained`` percent of their count are left out. Ties of score go to the higher count, then to the phrase.
    """
    phrases, n = phrase_counts(docs, least, most_common, per_bucket)
    phrases = store(phrases, "phrase_counts")
    longer = phrases.where("size > 1").withColumn("_words", F.split("phrase", " "))

    def subs(size: int) -> Column:
        return F.array(*[part_of(size, i, i + k - 1) for k in range(2, size) for i in range(1, size - k + 2)])

    inner = longer.where("size > 2").select(
        "lang", "f", F.explode(F.when(F.col("size") == 3, subs(3)).otherwise(subs(4))).alias("phrase"))
    cover = inner.groupBy("lang", "phrase").agg(F.max("f").alias("_cover"))
    kept = longer.join(cover, ["lang", "phrase"], "left").where(
        F.col("_cover").isNull() | (F.col("_cover") * 100 < F.col("f") * contained)).drop("_cover")

    def cuts(size: int) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("cut"), F.lit(side).alias("side"), part_of(size, a, b).alias("part"))
                         for k in range(1, size) for side, a, b in (("l", 1, k), ("r", k + 1, size))])

    sides = kept.select("lang", "phrase", F.col("f").alias("a"), F.inline(
        F.when(F.col("size") == 2, cuts(2)).when(F.col("size") == 3, cuts(3)).otherwise(cuts(4))))
    known = phrases.select("lang", F.col("phrase").alias("part"), "f")
    sides = sides.join(known, ["lang", "part"])
    whole = "decimal(38,0)"
    at = [F.max(F.when((F.col("cut") == k) & (F.col("side") == side), F.col("f"))).alias(f"{side}{k}")
          for k in range(1, LONGEST) for side in "lr"]
    scored = sides.groupBy("lang", "phrase", "a").agg(*at)
    best = F.array_min(F.filter(F.array(*[F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.expr(f"(cast({scale} as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l{k} as {whole}) + r{k})").alias("score"),
        F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, LONGEST)]),
        lambda x: x.isNotNull()))
    scored = store(scored.select("lang", "phrase", "a", F.inline(F.array(best))), "scored")
    # The best of every share of the phrases first, so no task sees all of a lang.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    shares = max(1, -(-scored.count() // 100_000))
    dealt = scored.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    some = dealt.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).where(
        F.col("_at") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(
        F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
