"""Price report pages (HTML tables, wide by date) to long price rows, page by page inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.joins import canonical_names
from panelwright.operators.quality import check_records
from panelwright.spec import CHILI, PanelSpec

# The word that marks a header row, and the shortest header and data rows in cells.
HEADER_WORD = "Komoditas"
HEADER_CELLS = 5
ROW_CELLS = 3

# HTML's named characters; the no-break space counts as a blank.
ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"nbsp": " ", "apos": "'"}

NAMES = "table|thead|tbody|tfoot|tr|td|th"
REST = r"""(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
# What isn't shown, tags that make no table, and those that do.
UNSEEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
OTHER = rf"(?i)<(?!/?(?:{NAMES})[\s/>])/?[a-z!?][^\s/>]*+{REST}"
TAG = rf"(?i)</?({NAMES}){REST}"
CELLS, ROWS, SECTIONS = ("td", "th"), ("tr", "td", "th"), ("thead", "tbody", "tfoot", "tr", "td", "th")


def decode_entities(c: Column) -> Column:
    """Named and numeric character references to characters, each decoded once.

    The text is cut at its references; what one decodes to is not looked at again.
    """
    def char(ref: Column) -> Column:
        hexed = F.lower(F.substr(ref, F.lit(2), F.lit(1))) == "x"
        code = F.when(hexed, F.substr(ref, F.lit(3))).otherwise(F.conv(F.substr(ref, F.lit(2)), 10, 16))
        numeric = F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")
        named = F.coalesce(F.try_element_at(names, ref), F.concat(F.lit("&"), ref, F.lit(";")))
        return F.when(F.startswith(ref, F.lit("#")), numeric).otherwise(named)

    names = F.map_from_arrays(F.split(F.lit(" ".join(ENTITIES)), " "),
                              F.split(F.lit("\n".join(ENTITIES.values())), "\n"))
    reference = r"&(#[0-9]{1,6}|#[xX][0-9a-fA-F]{1,5}|[A-Za-z][A-Za-z0-9]{1,7});"
    between = F.split(c, reference)
    found = F.regexp_extract_all(c, F.lit(reference), F.lit(1))
    return F.array_join(F.transform(between, lambda text, i: F.concat(
        text, F.coalesce(char(F.get(found, i)), F.lit("")))), "")


def _spans(tags: Column, end: Column) -> Column:
    """(tag, first, last, start, stop) of every row and cell: the places of its tags among the tags, and of its text in the page's.

    ``tags`` are (at, tag, closing, gap), gap being the length of the text before it, folded with a stack of open elements;
    ``end`` is that of the text behind the last one. A cell ends with the next cell or row of its table and a row with the next
    row, whether their end tags are there or not; a table inside a cell has rows of its own, and its tags end nothing outside it.
    """
    open_ = "array<struct<tag:string,at:int,start:int>>"
    done = "array<struct<tag:string,first:int,last:int,start:int,stop:int>>"
    begin = F.struct(F.lit(0).alias("pos"), F.array().cast(open_).alias("open"), F.array().cast(done).alias("done"))
    names = lambda tags_: F.array(*[F.lit(t) for t in tags_])

    def closed(elements: Column, at: Column, pos: Column) -> Column:
        kept = F.filter(elements, lambda x: x["tag"].isin(*ROWS))
        return F.transform(kept, lambda x: F.struct(x["tag"].alias("tag"), x["at"].alias("first"), at.alias("last"),
                                                    x["start"].alias("start"), pos.alias("stop")))

    def step(state: Column, token: Column) -> Column:
        stack, tag, pos = state["open"], token["tag"], state["pos"] + token["gap"]
        table = F.coalesce(F.array_max(F.transform(stack, lambda x, k: F.when(x["tag"] == "table", k))), F.lit(-1))
        ended = (F.when(tag.isin(*CELLS) & token["closing"], F.array(tag)).when(tag.isin(*CELLS), names(CELLS))
                 .when(tag == "tr", names(ROWS)).otherwise(names(SECTIONS)))
        inner = F.array_min(F.transform(stack, lambda x, k: F.when((k > table) & F.array_contains(ended, x["tag"]), k)))
        whole = F.when(tag == "table", F.when(token["closing"] & (table >= 0), table)).otherwise(inner)
        keep = F.coalesce(whole, F.size(stack))
        pushed = F.when(token["closing"], F.array().cast(open_)).otherwise(
            F.array(F.struct(tag.alias("tag"), token["at"].alias("at"), pos.alias("start"))))
        popped = F.slice(stack, keep + 1, F.size(stack))
        return F.struct(pos.alias("pos"), F.concat(F.slice(stack, F.lit(1), keep), pushed).alias("open"),
                        F.concat(state["done"], closed(popped, token["at"], pos)).alias("done"))

    return F.aggregate(tags, begin, step, lambda state: F.concat(
        state["done"], closed(state["open"], F.size(tags), state["pos"] + end)))


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is worked out once: the optimiser doesn't copy a generator into what refers to it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def page_cells(pages: DataFrame, html: str, out: str) -> DataFrame:
    """Adds all table rows of a page, each an array of cell texts. A row has the cells of tables inside it as well, a cell their text."""
    pages = _held(pages, "_page", F.regexp_replace(F.regexp_replace(html, UNSEEN, ""), OTHER, ""))
    pages = _held(pages, "_texts", F.transform(F.split("_page", TAG), decode_entities))
    tags = F.transform(F.regexp_extract_all("_page", F.lit(TAG), F.lit(0)), lambda t, i: F.struct(
        i.alias("at"), F.lower(F.regexp_extract(t, TAG, 1)).alias("tag"), F.startswith(t, F.lit("</")).alias("closing"),
        F.length(F.get("_texts", i)).alias("gap")))
    pages = _held(pages, "_tags", tags)
    pages = _held(pages, "_spans", F.array_sort(F.transform(
        _spans(F.col("_tags"), F.length(F.element_at("_texts", -1))),
        lambda x: F.struct(x["first"], x["last"], x["start"], x["stop"], x["tag"]))))
    pages = _held(pages, "_shown", F.array_join("_texts", ""))
    cell = lambda x: F.struct(x["first"].alias("first"), S.strip(F.substr(
        F.col("_shown"), x["start"] + 1, x["stop"] - x["start"])).alias("text"))
    pages = _held(pages, "_cell", F.transform(F.filter("_spans", lambda x: x["tag"] != "tr"), cell))
    cells = F.transform(F.filter("_spans", lambda x: x["tag"] == "tr"), lambda row: F.transform(
        F.filter("_cell", lambda c: (c["first"] > row["first"]) & (c["first"] < row["last"])), lambda c: c["text"]))
    return _held(pages, out, cells).drop("_page", "_texts", "_tags", "_spans", "_shown", "_cell")


def report_rows(pages: DataFrame, names: DataFrame, spec: PanelSpec = CHILI, html: str = "html",
                column: str = "name", keep: Sequence[str] = ()) -> DataFrame:
    """Long rows of report pages with a ``reason`` for rejects.

    ``pages`` has the item column and the page. The first row with the header word gives the dates from
    its third cell on; a page without one yields nothing. Provinces are matched by normalised name
    against ``names``; rows of unknown provinces and cells without a date are not data. Columns of the
    pages named in ``keep`` stay with their rows.
    """
    province, item = spec.keys
    long = page_cells(pages.select(item, *keep, F.col(html).alias("_html")), "_html", "_cells").drop("_html")
    heads = F.filter("_cells", lambda row: (F.size(row) >= HEADER_CELLS) & (
        F.contains(F.get(row, F.lit(0)), F.lit(HEADER_WORD))
        | F.contains(F.get(row, F.lit(1)), F.lit(HEADER_WORD))))
    rest = lambda row: F.slice(row, 3, F.greatest(F.size(row) - 2, F.lit(0)))
    long = long.withColumn("_head", F.get(heads, F.lit(0))).filter(F.col("_head").isNotNull())
    long = long.select(item, *keep, F.transform(rest(F.col("_head")), S.header_date).alias("_dates"),
                       F.explode(F.filter("_cells", lambda row: F.size(row) >= ROW_CELLS)).alias("_row"))
    long = long.select(item, *keep, F.get("_row", F.lit(1)).alias("_province"), F.explode(F.arrays_zip(
        F.col("_dates").alias("date"), rest(F.col("_row")).alias("price"))).alias("_pair"))
    long = long.select(item, *keep, "_province", F.col("_pair.date").alias(spec.time),
                       F.col("_pair.price").alias("harga_raw"))
    long = long.filter(F.col(spec.time).isNotNull() & F.col("harga_raw").isNotNull())
    long = canonical_names(long, names, "_province", province, column).drop("_province")
    return check_records(long, spec)
