"""Main text of web pages by removal of site templates.

Pages are read once, in tasks (`html_tree`): blocks of text, and a digest for every element's subtree (tag, class, id,
role, text with numbers masked, subtrees below). Spark counts per host under how many different headings a subtree
occurs, which copies of one article do not raise, and a subtree that recurs under many is the site's: it is deleted from every
page of that host. What differs from page to page within a template (menus of links, adverts, sidebars, forms, comments)
has no recurring subtree and is left out by its element, role, or class. Text in an article or main element is
preferred where a page has such an element; its paragraphs are never taken for templates, even if many pages share one.

Null html and html without text give an empty text. Null and unreadable addresses share one nameless host. Rows are told apart
by their place in the stored pages, so repeated ids and rows each give one row. Kept columns may have any names.
White space is what Unicode says it is, no-break spaces included. A page is read whole; memory is bounded by the longest page.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tripmart.llm.common import slices, stored
from tripmart.llm.html_tree import read_page

MIN_PAGES = 5
MIN_SHARE = 0.02
BLOCK = pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64()))])
HOST = r"^[a-z][a-z0-9+.-]*:/*(?:[^/?#@]*@)?([^/?#:]*)"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices([batch], "html"):
            headings, blocks, every = [], [], []
            for html in texts:
                heading, found, digests = read_page(html)
                headings.append(xxhash.xxh3_64_intdigest(heading.encode("utf-8", "surrogatepass")) - (1 << 63))
                blocks.append([{"text": _valid(t), "around": around} for t, around in found])
                every.append(digests)
            columns = [part.column(i) for i, f in enumerate(part.schema) if f.name != "html"]
            names = [f.name for f in part.schema if f.name != "html"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(headings, pa.int64()), pa.array(blocks, pa.list_(BLOCK)), pa.array(every, pa.list_(pa.int64()))],
                names=[*names, "heading", "blocks", "every"],
            )


def _valid(text: str) -> str:
    """Lone surrogates, as ``&#xD800;`` might make them, cannot be stored as UTF-8."""
    return text.encode("utf-8", "replace").decode() if not text.isascii() else text


def site_templates(read: DataFrame, min_pages: int, min_share: float) -> DataFrame:
    """``host, digest``: subtrees that occur under at least ``min_pages`` different headings of their host,
    and under at least that share of all its headings. A digest that very many pages share leaves each task once per heading."""
    under = read.select("host", "heading", F.explode("every").alias("digest")).distinct()
    counts = under.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    hosts = read.select("host", "heading").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("headings"))
    return counts.join(hosts, "host").filter(F.col("n") >= min_share * F.col("headings")).select("host", "digest")


def main_text(
    pages: DataFrame,
    keep: Sequence[str] = ("page_id", "url"),
    html: str = "html",
    url: str = "url",
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """The kept columns, ``text`` (blocks joined by a line break) and ``n_removed`` (blocks that went with a
    template of the site)."""
    spark = pages.sparkSession
    kept = [f"keep{i}" for i in range(len(keep))]
    rows = pages.select(
        *[F.col(c).alias(k) for c, k in zip(keep, kept)],
        F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), HOST, 1).alias("host"),
        F.monotonically_increasing_id().alias("row"),
        F.col(html).alias("html"),
    )
    schema = StructType([
        *[StructField(k, pages.schema[c].dataType) for c, k in zip(keep, kept)],
        StructField("host", StringType()), StructField("row", LongType()), StructField("heading", LongType()),
        *StructType.fromDDL("blocks array<struct<text:string,around:array<bigint>>>, every array<bigint>"),
    ])
    read = stored(spark, rows.mapInArrow(_read, schema), "pages")
    templates = stored(spark, site_templates(read, min_pages, min_share), "templates")
    boxed = F.exists("blocks", lambda b: F.size(b["around"]) > 0)
    around = F.flatten(F.transform("blocks", lambda b: b["around"]))
    on_pages = read.filter(boxed).select("row", "host", F.explode(F.array_distinct(around)).alias("digest"))
    # At most as many digests as the page has elements.
    removed = stored(
        spark,
        on_pages.join(templates, ["host", "digest"]).groupBy("row").agg(F.collect_set("digest").alias("gone")),
        "removed",
    )
    # Only pages with a box around some candidate meet the join; the texts of the others are not moved.
    joined = read.filter(boxed).join(removed.withColumnRenamed("row", "of"), F.col("row") == F.col("of"), "left")
    whole = read.filter(~boxed).withColumn("of", F.lit(None).cast("long")).withColumn("gone", F.lit(None).cast("array<bigint>"))
    left = F.filter("blocks", lambda b: ~F.coalesce(F.arrays_overlap(b["around"], F.col("gone")), F.lit(False)))
    return (
        joined.union(whole)
        .select(*kept, F.size("blocks").alias("all"), left.alias("left"))
        .select(
            *[F.col(k).alias(c) for c, k in zip(keep, kept)],
            F.array_join(F.transform("left", lambda b: b["text"]), "\n").alias("text"),
            (F.col("all") - F.size("left")).alias("n_removed"),
        )
    )
