"""The registered queries of the training-data operators; each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import near_copies as copies
from panelwright.llm import collocations, decontaminate, licences, lines, mixing, packing, periodic, pii, repeats, topk, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op10_near_copies(spark, sf_dir):
    return copies.near_copies(read(spark, sf_dir, "documents"), size=3, percent=85)


@query()
def op7_toxicity(spark, sf_dir):
    return toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op8_packing(spark, sf_dir):
    return packing.packed(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("""
with v as (
  select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as p from embeddings
  where vec_id is not null and len(embedding) > 0
    and len([1 for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum([q.p[i] * c.p[i] for i in range(1, len(q.p) + 1)]) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(c.p) = len(q.p)),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
             vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 20""")
def op9_top_k(spark, sf_dir):
    return topk.top_k(read(spark, sf_dir, "embeddings"))


@query()
def op3_decontamination(spark, sf_dir):
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query()
def op2_personal_data(spark, sf_dir):
    return pii.digest(pii.personal_data(read(spark, sf_dir, "documents")))


@query(warc.sql())
def op5_warc_derivatives(spark, sf_dir):
    return warc.derivatives(warc.responses(read(spark, sf_dir, "pages")))


@query(licences.sql())
def op6_licence_scan(spark, sf_dir):
    return licences.scan(read(spark, sf_dir, "documents"))


@query()
def op4_repeated_strings(spark, sf_dir):
    return repeats.without_repeats(read(spark, sf_dir, "documents"))


@query(lines.SQL)
def op1_line_dedup(spark, sf_dir):
    return lines.report(read(spark, sf_dir, "documents"))


@query(collocations.SQL)
def op11_collocations(spark, sf_dir):
    return collocations.collocations(read(spark, sf_dir, "documents"))


@query()
def op12_periodic_runs(spark, sf_dir):
    docs = periodic.with_repetitions(read(spark, sf_dir, "documents"))
    return periodic.digest(periodic.periodic_runs(docs))


@query(mixing.SQL)
def op13_source_mix(spark, sf_dir):
    return mixing.by_source(read(spark, sf_dir, "documents"))
