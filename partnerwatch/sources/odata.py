"""Land OData JSON pages into bronze rows, and check a captured chain of pages.

A captured page is ``{"d": {"results": [record, ...], "__next": url}}``. The
HTTP client that fetches pages is not part of this library; pages are read
from files (or any text column) and flattened with ``from_json`` +
``explode``, one page per row, so landing is parallel over pages. The ``__next``
links, which a client follows one by one, are followed by pointer doubling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partnerwatch.session import cut_lineage
from partnerwatch.sources.odata_filter import filter_column


def page_schema(record_schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("d", T.StructType([
            T.StructField("results", T.ArrayType(record_schema)),
            T.StructField("__next", T.StringType()),
        ])),
    ])


def _flatten(pages: DataFrame, page_col: str, filter_expr: str | None, top: int | None,
             odata_filter: str | None = None) -> DataFrame:
    rows = pages.select(F.explode(F.col(f"{page_col}.d.results")).alias("_r")).select("_r.*")
    rows = rows.drop(*[c for c in ("__metadata",) if c in rows.columns])
    if filter_expr:
        rows = rows.filter(filter_expr)
    if odata_filter:
        rows = rows.filter(filter_column(odata_filter, rows.columns))
    if top:
        rows = rows.limit(top)
    return rows


def read_pages(spark: SparkSession, path: str, record_schema: T.StructType,
               filter_expr: str | None = None, top: int | None = None, odata_filter: str | None = None) -> DataFrame:
    """Page files (one JSON document per file) -> flat records, ``__metadata`` dropped.
    ``odata_filter`` is the service's ``$filter`` text, ``filter_expr`` a Spark SQL
    condition, ``top`` its ``$top``."""
    pages = spark.read.schema(page_schema(record_schema)).option("multiLine", True).json(path)
    return _flatten(pages.select(F.struct("d").alias("_page")), "_page", filter_expr, top, odata_filter)


def parse_pages(pages: DataFrame, text_col: str, record_schema: T.StructType,
                filter_expr: str | None = None, top: int | None = None, odata_filter: str | None = None) -> DataFrame:
    """Same as ``read_pages`` for pages held in a text column."""
    parsed = pages.select(F.from_json(F.col(text_col), page_schema(record_schema)).alias("_page"))
    return _flatten(parsed, "_page", filter_expr, top, odata_filter)


def next_links(pages: DataFrame, text_col: str, record_schema: T.StructType) -> DataFrame:
    """The ``__next`` continuation link of every page (NULL on the last page)."""
    parsed = pages.select(F.from_json(F.col(text_col), page_schema(record_schema)).alias("_page"))
    return parsed.select(F.col("_page.d.__next").alias("next_link"))


def page_links(pages: DataFrame, url_col: str, text_col: str) -> DataFrame:
    """(url, next, records) of every captured page; ``next`` is NULL on a last page,
    ``records`` is NULL where the text is no page."""
    schema = T.StructType([T.StructField("d", T.StructType([
        T.StructField("results", T.ArrayType(T.StringType())), T.StructField("__next", T.StringType())]))])
    parsed = pages.select(F.col(url_col).alias("url"), F.from_json(F.col(text_col), schema).alias("_p"))
    return parsed.select("url", F.col("_p.d.__next").alias("next"), F.size("_p.d.results").alias("records"))


def check_chains(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(url, chain, position, status) of every captured or linked page.

    ``links`` has (url, next), ``starts`` the first ``url`` of each chain, which
    names the chain. Status: ``ok``; ``doubled`` (captured more than once);
    ``missing`` (a chain leads to it, but it was not captured); ``unreachable``
    (captured, but no chain leads to it). A page that two chains reach is in both.
    Where copies of a page link to different pages, all are followed.

    Round k knows every page within 2^k - 1 links of a start and the links of 2^k
    steps, and joins the two; so a chain of n pages takes about log2 n rounds of
    joins by url, each written to the shared folder. A chain that runs in a circle
    ends there, each page at its first position.
    """
    pages = links.groupBy("url").agg(F.count(F.lit(1)).alias("copies"))
    jump = cut_lineage(links.filter("next is not null").select("url", F.col("next").alias("to")).distinct(), "odata-jumps")
    reached = starts.select(F.col("url").alias("chain"), "url", F.lit(0).cast("bigint").alias("position")).distinct()
    reached, known, step = cut_lineage(reached, "odata-reached"), -1, 1
    while True:
        ahead = reached.join(jump, "url").select("chain", F.col("to").alias("url"), (F.col("position") + step).alias("position"))
        both = reached.unionByName(ahead).groupBy("chain", "url").agg(F.min("position").alias("position"))
        reached = cut_lineage(both, "odata-reached")
        now = reached.count()
        if now == known:
            break
        known, step = now, step * 2
        further = jump.select("url", F.col("to").alias("via")).join(jump.select(F.col("url").alias("via"), "to"), "via")
        jump = cut_lineage(further.select("url", "to").distinct(), "odata-jumps")
    judged = reached.join(pages, "url", "full")
    status = (F.when(F.col("copies").isNull(), "missing").when(F.col("chain").isNull(), "unreachable")
              .when(F.col("copies") > 1, "doubled").otherwise("ok"))
    return judged.select("url", "chain", "position", status.alias("status"))
