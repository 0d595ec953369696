"""Near-duplicate lines by an exact set-similarity join, in column functions only.

A line is the set of its words (white space parts them, case doesn't count). It goes if an earlier line - by doc_id, then
place in the text - has the same set or one of Jaccard similarity of at least ``percent``. Lines are judged on the
input, not on what is left; lines without words stay.

1. Lines are parted into words and these hashed to codes; 32 bits of each are kept where the text was read, in memory or on
   the executors' disks; what is lost is made again. Neither texts nor whole sets are dealt out.
2. The codes are counted over all lines in 2**22 hashed buckets, one byte each: a table of fixed size. A line's
   words are ordered by rarity: by the bucket's count, then by hash. Any one order for all lines gives the right result;
   rare words first makes it fast. A line now sends its hashes, sketch and prefix, words as 32-bit hashes; lines of equal
   text are one from here on, whose place is its earliest one.
3. Prefix filter: two similar sets share a word among the first n - ceil(t n) + 1 of each. Lines meet at these
   words; the length filter, the positional filter (what can still be shared after the meeting word) and a 96-bit
   sketch thin the pairs out. A bit of the sketch is the parity of the words that hash to it, so every bit in which two
   sketches differ is a word that one set lacks, and long lines don't fill it. The rest is checked on the whole sets.
   Words of one line only meet none and are left out. Words that share a 32-bit hash let more lines meet, no fewer.
4. Only lines that met one they may be similar to go on, most often few; now their codes are made again, in full, thinned out
   by a table of 2**24 bits of their ids. A line needs one earlier match only. So, in
   three rounds, lines first meet the earliest unsettled line of each word, and the one with the nearest sketch is
   checked. Those that match are settled, and no more pairs are formed for a settled line as the later one: a large
   group of near copies costs a few pairs for each.

Words of a pair are compared by 56-bit hashes, lines told apart by two 64-bit hashes. Lines whose first hash
collides are kept rather than removed. What a step dealt out goes from the disks once its rows are stored.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.session import store, store_dealt

BITS, CHUNK = 22, 1024
FLAGS = 18
LEVELS = 4.2
ONCE = 0
AT, MOST = 12, (1 << 20) - 1
BLANK = r"[\x20\x09-\x0D]+"
ROUNDS, WIDE = 3, 4


def words(text: Column) -> Column:
    """Its words, in lower case; one empty word if it has none."""
    lower, blanks = F.lower(text), F.lit(" \t\n\x0b\x0c\r")
    odd = reduce(Column.__or__, (F.contains(text, F.lit(x)) for x in ("  ", "\t", "\n", "\x0b", "\x0c", "\r")))
    # Most texts have single spaces only, and are parted much faster without a pattern.
    return F.when(odd, F.split(F.btrim(lower, blanks), BLANK)).otherwise(F.split(F.btrim(lower, F.lit(" ")), " "))


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit((1 << BITS) - 1))


def _dense(found: DataFrame, bits: int, kind: str) -> Column:
    """An array of 2**``bits`` values of a numeric ``kind``, the ``value`` of each ``id`` and 0 where there is none; one value for a query."""
    zeros = lambda n: F.array_repeat(F.lit(0).cast(kind), n)
    sparse = found.groupBy(F.floor(F.col("id") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list(F.struct(
        (F.col("id") % CHUNK).cast("int").alias("at"), F.col("value").cast(kind).alias("value")))).alias("x"))

    def filled(x: Column, i: Column) -> Column:
        after = F.coalesce(F.get("x", i + 1)["at"], F.lit(CHUNK))
        return F.concat(F.array(x["value"]), zeros(after - x["at"] - 1))
    dense = sparse.select("chunk", F.concat(zeros(F.get("x", F.lit(0))["at"]), F.flatten(F.transform("x", filled))).alias("part"))
    full = found.sparkSession.range((1 << bits) // CHUNK).join(dense, F.col("id") == F.col("chunk"), "left")
    return full.agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("part", zeros(F.lit(CHUNK))).alias("r")))),
                                          lambda x: x["r"]))).scalar()


def rarity(sets: DataFrame) -> Column:
    """An array of a rank by bucket of codes, rising with how many of the ``sets`` have them; one value for a query.

    A rank is a byte. ``ONCE`` is the rank of buckets with one code of one set, and of no others with any.
    """
    found = sets.select(F.explode("codes").alias("code")).groupBy(_bucket(F.col("code")).alias("id")).count().where("count > 1")
    return _dense(found.select("id", F.least(F.floor(F.log1p("count") * LEVELS), F.lit(127)).alias("value")), BITS, "byte")


def _bit(h: Column, value: Column | None = None) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long") if value is None else value, h.bitwiseAND(F.lit(63)).cast("int"))


def flagged(ids: DataFrame, h: Column) -> Column:
    """Whether ``h`` is among the column ``id`` of ``ids``, 64-bit hashes; true for some others as well."""
    slot = lambda x: F.shiftright(x, 6).bitwiseAND(F.lit((1 << FLAGS) - 1))
    found = ids.groupBy(slot(F.col("id")).alias("slot")).agg(F.bit_or(_bit(F.col("id"))).alias("value"))
    flags = _dense(found.withColumnRenamed("slot", "id"), FLAGS, "long")
    return F.get(flags, slot(h).cast("int")).bitwiseAND(_bit(h)) != 0


def numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, line) of every line of texts that aren't null, lines numbered from 0."""
    parts = docs.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("parts"))
    # An inner explode would bring filters that split the text again; no text has no lines.
    return parts.select("doc_id", "text_hash", F.posexplode_outer("parts").alias("line_no", "line")).where(
        F.btrim("line", F.lit(" \t\x0b\x0c\r")) != "").withColumn("id", F.xxhash64("line"))


def parity(codes: str, part: int, parts: int) -> Column:
    """64 bits, each the parity of the words that hash to it, of one of ``parts`` parts of the words."""
    return F.aggregate(codes, F.lit(0).cast("long"), lambda x, c: F.when(
        F.shiftright(c, 6).bitwiseAND(F.lit(parts - 1)) == part, x.bitwiseXOR(_bit(c))).otherwise(x))


def coded(lines: DataFrame) -> DataFrame:
    """(id, place, check, codes) of every line; ``codes`` are its distinct words' hashes, of 56 bits."""
    codes = F.array_distinct(F.transform(words(F.col("line")), lambda w: F.shiftrightunsigned(F.xxhash64(w), 8)))
    return lines.select("id", F.struct("doc_id", "text_hash", "line_no").alias("place"), F.xxhash64(F.lit(1), "line").alias("check"),
                        codes.alias("codes"))


def distinct_lines(sets: DataFrame, ranks: Column, percent: int) -> DataFrame:
    """(id, place, sure, n, every, odd, prefix) of every distinct line; ``sets`` are the coded ones, with codes of 32 bits.

    ``every`` holds the parities of all its words in 64 bits, ``odd`` those of the words of ``parity``'s second part of two.
    ``prefix`` holds 32-bit hashes of its first words by rarity, null where a word is in no other line.
    """
    # Codes and ranks are never null, so that Spark sorts them as plain numbers.
    ranked = F.sort_array(F.transform("codes", lambda c: F.shiftleft(F.coalesce(
        F.get("ranks", _bucket(c)), F.lit(0).cast("byte")).cast("long"), 32).bitwiseOR(c.cast("long").bitwiseAND(F.lit((1 << 32) - 1)))))
    n = F.size("codes")
    first = F.slice(ranked, F.lit(1), n - F.ceil(n * percent / 100).cast("int") + 1)
    prefix = F.transform(first, lambda c: F.when(F.shiftright(c, 32) != ONCE, F.hash(c)))
    every = F.aggregate("codes", F.lit(0).cast("long"), lambda x, c: x.bitwiseXOR(_bit(c)))
    odd = F.aggregate("codes", F.lit(0).cast("long"), lambda x, c: x.bitwiseXOR(_bit(c, F.shiftright(c, 6).bitwiseAND(F.lit(1)).cast("long"))))
    # The one value of ranks is merged into the expression that uses it; as a column it would be copied per line.
    own = sets.withColumn("ranks", ranks).select("id", "place", "check", F.struct(
        n.alias("n"), every.alias("every"), odd.alias("odd"), prefix.alias("prefix")).alias("x"))
    found = own.groupBy("id").agg(F.min("place").alias("place"), F.min("check").alias("low"), F.max("check").alias("high"), F.first("x").alias("x"))
    return found.select("id", "place", (F.col("low") == F.col("high")).alias("sure"), "x.*")


def removed_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, lines): numbers of the lines that go, in order, of documents that lose any."""
    spark = docs.sparkSession
    settings = {
        # Joins on the line's id find the distinct lines where they are, if nobody merges their partitions.
        "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "false",
        # A step's shuffle files go with the step, not when the driver happens to collect garbage.
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        whole = coded(numbered(docs))
        # Few lines need their codes in full; kept, they would take twice the memory.
        lines = whole.withColumn("codes", F.transform("codes", lambda c: F.hash(c))).persist(StorageLevel.MEMORY_AND_DISK)
        sets = distinct_lines(lines, rarity(lines), percent).persist(StorageLevel.MEMORY_AND_DISK)
        gone = _similar_to_earlier(sets.where("sure"), whole, percent).withColumn("gone", F.lit(True))
        verdict = sets.join(gone, "id", "left").select("id", F.col("place").alias("first"), "sure", F.coalesce("gone", F.lit(False)).alias("gone"))
        out = store(lines.select("id", "place").join(verdict, "id").where(
            F.col("gone") | (F.col("sure") & (F.col("place") > F.col("first")))).groupBy("place.doc_id", "place.text_hash").agg(
            F.sort_array(F.collect_set("place.line_no")).alias("lines")), "removed_lines")
        sets.unpersist()
        lines.unpersist()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return out


def _similar_to_earlier(sets: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """(id) of the distinct lines that are similar to one of an earlier place; ``whole`` are all lines, with codes in full."""

    def alike(a: str, b: str) -> Column:
        """Whether lines with notes and sketches of suffixes ``a`` and ``b`` can be similar, as far as these tell."""
        n, m = (F.shiftright(f"note{s}", AT).bitwiseAND(F.lit(MOST)) for s in (a, b))
        left = F.least(*(k - F.col(f"note{s}").bitwiseAND(F.lit((1 << AT) - 1)) for k, s in ((n, a), (m, b))))
        bits = F.bit_count(F.col(f"sketch{a}").bitwiseXOR(F.col(f"sketch{b}"))) + F.bit_count(
            F.shiftrightunsigned(F.col(f"note{a}").bitwiseXOR(F.col(f"note{b}")), 32))
        # Sets that are similar differ in few words for their size and share enough from the meeting word on.
        fits = ((100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * bits <= (100 - percent) * (n + m))
                & ((100 + percent) * left >= percent * (n + m)))
        return fits | (F.greatest(n, m) == MOST)

    def named(rows: DataFrame, s: str, *columns: str) -> DataFrame:
        return rows.select("word", *(F.col(c).alias(c + s) for c in columns))

    # Half a sketch, the set's size and the word's place in one number. A place beyond its bits counts as an earlier one.
    note = F.shiftleft("odd", 32).bitwiseOR(F.shiftleft(F.least(F.col("n"), F.lit(MOST)).cast("long"), AT)).bitwiseOR(
        F.least(F.col("at"), F.lit((1 << AT) - 1)).cast("long"))
    meeting = sets.select("id", "n", "every", "odd", F.posexplode("prefix").alias("at", "word")).where("word is not null").select(
        "word", "id", F.col("every").bitwiseXOR(F.col("odd")).alias("sketch"), note.alias("note"))
    # Dealt once and kept, as Spark would deal the same rows out for either side of the join.
    partitions = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    meeting = meeting.repartition(partitions, "word").sortWithinPartitions("word").persist(StorageLevel.MEMORY_AND_DISK)
    meeting.count()  # else either side of the join would set out to make it
    columns = ("id", "sketch", "note")
    a, b = named(meeting, "_a", *columns), named(meeting, "_b", *columns)
    # Most lines are like no other. From here on there are only rows that met one they may be similar to.
    rows = store(a.join(b.withColumnRenamed("word", "other"), (F.col("word") == F.col("other")) & (F.col("id_a") != F.col("id_b"))
                        & alike("_a", "_b"), "left_semi"), "met")
    meeting.unpersist()
    ids = rows.select(F.col("id_a").alias("id")).distinct()
    codes = whole.where(flagged(ids, F.col("id"))).groupBy("id").agg(F.first("codes").alias("codes"))
    # In buckets by id, so that the joins below leave it where it is.
    known = store_dealt(sets.join(ids, "id", "left_semi").join(codes, "id").select(
        "id", "place", "codes", *(parity("codes", i, WIDE).alias(f"wide{i}") for i in range(WIDE))), "known", "id")
    met = rows.join(known.drop("codes").withColumnRenamed("id", "id_a"), "id_a")

    def later(pairs: DataFrame) -> DataFrame:
        """Of each pair (a, b) of lines that is similar, the line of the later place."""
        a = known.select(F.col("id").alias("a"), F.col("place").alias("place_a"), F.col("codes").alias("codes_a"))
        b = known.select(F.col("id").alias("b"), F.col("place").alias("place_b"), F.col("codes").alias("codes_b"))
        both = pairs.join(a, "a").join(b, "b")
        common = F.size(F.array_intersect("codes_a", "codes_b"))
        size = F.size("codes_a") + F.size("codes_b")
        return both.where(100 * common >= percent * (size - common)).select(
            F.when(F.col("place_a") > F.col("place_b"), F.col("a")).otherwise(F.col("b")).alias("id")).distinct()

    # Few lines are left, so wider sketches cost little now.
    wide = [f"wide{i}" for i in range(WIDE)]
    bits = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_b"))) for c in wide), F.lit(0))
    n, m = (F.shiftright(f"note{s}", AT).bitwiseAND(F.lit(MOST)) for s in ("_a", "_b"))
    near = alike("_a", "_b") & (((100 + percent) * bits <= (100 - percent) * (n + m)) | (F.greatest(n, m) == MOST))
    open_rows, found = met, []
    for _ in range(ROUNDS):
        lead = open_rows.groupBy("word").agg(F.min(F.struct("place", "id_a", "sketch_a", "note_a", *wide)).alias("x")).select(
            "word", *(F.col(f"x.{c}_a").alias(f"{c}_b") for c in columns), *(F.col(f"x.{c}").alias(f"{c}_b") for c in wide))
        nearest = open_rows.join(lead, "word").where((F.col("id_a") != F.col("id_b")) & near).groupBy("id_a").agg(
            F.min(F.struct(bits.alias("bits"), "id_b")).alias("x")).select(
            F.col("id_a").alias("b"), F.col("x.id_b").alias("a"))
        found.append(store(later(nearest), "settled"))
        open_rows = store(open_rows.join(found[-1].withColumnRenamed("id", "id_a"), "id_a", "left_anti"), "open")
    earlier = named(met.withColumnsRenamed({f"{c}_a": c for c in columns}), "_b", *columns, "place", *wide)
    pairs = open_rows.join(earlier, "word").where((F.col("place_b") < F.col("place")) & near).select(
        F.col("id_b").alias("a"), F.col("id_a").alias("b")).distinct()
    return store(reduce(DataFrame.union, [*found, later(pairs)]).distinct(), "similar")


def without_repeats(docs: DataFrame, percent: int = 80, drop_emptied: bool = False) -> DataFrame:
    """The rows of ``docs`` with the text's later matches removed, and ``removed_lines`` (array of line numbers).

    Null texts and rows of null doc_id stay as they are and take no part; empty texts have no words. Rows that repeat doc_id and
    text are one document and are all answered alike; other texts of one doc_id are ordered by a hash. Columns besides
    doc_id and text are passed on, whatever their names but removed_lines. With ``drop_emptied``, documents that lose every line with
    words are left out. An empty table gives no rows.
    """
    gone = removed_lines(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), percent)
    gone = gone.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("lines").alias("__lines"))
    both = docs.join(gone, (docs["doc_id"].cast("long") == gone["__doc"]) & (F.xxhash64(docs["text"].cast("string")) == gone["__hash"]), "left")
    parts = F.filter(F.split(docs["text"], "\n"), lambda x, i: ~F.array_contains("__lines", i))
    text = F.when(F.col("__lines").isNull(), docs["text"]).otherwise(F.array_join(parts, "\n"))
    if drop_emptied:
        both = both.where(F.col("__lines").isNull() | F.exists(parts, lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != ""))
    columns = [text.alias(c) if c == "text" else docs[c] for c in docs.columns]
    return both.select(*columns, F.coalesce("__lines", F.array().cast("array<int>")).alias("removed_lines"))


def report(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, removed_lines (numbers, comma-joined).

    As ``without_repeats``, without sending texts about; a null text has no lines.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    gone = removed_lines(docs, percent)
    counts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                         F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))
    return counts.join(gone, ["doc_id", "text_hash"], "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("lines").cast("array<string>"), ","), F.lit("")).alias("removed_lines"))


SQL = r"""
with l as (
  select doc_id, line_no, [w for w in string_split_regex(lower(line), '[\x20\x09-\x0D]+') if w <> ''] as w
  from (select doc_id, unnest(string_split(text, chr(10))) as line,
               unnest(range(len(string_split(text, chr(10))))) as line_no
        from documents where doc_id is not null and text is not null)),
s as (select doc_id, line_no, list_sort(list_distinct(w)) as w from l where len(w) > 0),
u as (select w, min((doc_id, line_no)) as place, row_number() over () as id, len(w) as n from s group by w),
t as (select id, n, place, unnest(w) as x from u where n >= 4),
rare as (select x, count(*) as f from t group by x),
o as (select id, n, place, t.x, row_number() over (partition by id order by f, t.x) as r from t join rare on t.x = rare.x),
p as (select * from o where r <= n - ceil(n * 0.8) + 1),
c as (select distinct a.id as a, b.id as b from p a join p b on a.x = b.x and a.place < b.place
      and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
j as (select distinct b.id from c join u a on c.a = a.id join u b on c.b = b.id
      where 180 * len(list_intersect(a.w, b.w)) >= 80 * (a.n + b.n)),
g as (select s.doc_id, s.line_no from s join u on s.w = u.w left join j on j.id = u.id
      where j.id is not null or (s.doc_id, s.line_no) <> u.place),
k as (select doc_id, count(*) as n, string_agg(line_no::varchar, ',' order by line_no) as r from g group by 1)
select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines, coalesce(k.n, 0)::bigint as n_removed,
       coalesce(k.r, '') as removed_lines from documents d left join k on d.doc_id = k.doc_id"""
