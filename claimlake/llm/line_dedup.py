"""Removal of lines that are frequent within a site.

The share of a line is the number of the site's pages that contain it over the
number of the site's pages. A line is boilerplate if that share exceeds
``max_ratio`` and at least ``min_pages`` pages contain it; it is removed from
every page of the site. Lines are compared without the white space around them,
by a 128-bit digest; blank lines are neither counted nor removed.

A page counts a line once, however often it repeats it. Counting combines in
the map tasks first, so neither a site nor a line with a third of all rows makes
a large task. The lines removed from a site number at most its mean distinct
lines a page over ``max_ratio``; they are joined to the pages as one row a site,
broadcast if the counted rows are small and by a shuffle otherwise.

A null text stays null and has no lines; an empty one stays empty. Rows with a
null site are one site. Null ids are carried, repeated rows count as pages of
their own, a share equal to the ratio keeps the line, an empty table gives none.

With ``copies_once`` a group of copies does not make its own lines boilerplate. Each
distinct text of a site counts once, as a page and for its lines. Texts that would
keep less than ``min_left`` of the characters of their distinct lines are taken for
near copies: they are left out of a second count, and only lines that are frequent
in both counts go. A menu that other pages have too still goes from every copy; a
site of nothing but near copies keeps its lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import broadcast_if_small, checkpointed, text_key

BLANK = " \t\r"


@dataclass(frozen=True)
class LineDedupParams:
    max_ratio: float = 0.1
    min_pages: int = 3
    #: Count each distinct text of a site once, and leave texts uncounted
    copies_once: bool = False
    #: that would lose so much that less than this share of them is left.
    min_left: float = 1 / 3


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def _digest(line: Column) -> Column:
    return F.md5(_trimmed(line))


def _frequent(counts: DataFrame, sizes: DataFrame, params: LineDedupParams) -> DataFrame:
    """(site, digest) of the lines whose number of pages, ``n``, is enough for their site."""
    over = F.col("c.n") > F.lit(params.max_ratio) * F.col("s.n_pages")
    joined = counts.where(F.col("n") >= params.min_pages).alias("c").join(
        sizes.alias("s"), F.col("c.site").eqNullSafe(F.col("s.site")) & over
    )
    return joined.select("s.site", "c.digest")


def _same_line(a: str, b: str) -> Column:
    return F.col(f"{a}.site").eqNullSafe(F.col(f"{b}.site")) & (F.col(f"{a}.digest") == F.col(f"{b}.digest"))


def _per_line(lines: DataFrame) -> DataFrame:
    return lines.groupBy("site", "digest").agg(F.count(F.lit(1)).alias("n"))


def _page_lines(pages: DataFrame, site: str, text: str) -> DataFrame:
    """(site, digest): the distinct lines of every page."""
    lines = F.array_distinct(
        F.transform(
            F.filter(F.split(F.col(text).cast("string"), "\n", -1), lambda x: _trimmed(x) != ""),
            lambda x: F.unhex(_digest(x)),
        )
    )
    return pages.select(F.col(site).alias("site"), text).select("site", F.explode(lines).alias("digest"))


def _lines_beyond_copies(pages: DataFrame, params: LineDedupParams, site: str, text: str) -> DataFrame:
    """(site, digest) of the boilerplate lines, copies counted once and near copies not at all."""
    source = pages.select(F.col(site).alias("site"), F.col(text).cast("string").alias("page_text"))
    source = source.select("site", *text_key(F.col("page_text")), "page_text")
    texts = source.select("site", "k1", "k2").distinct()
    sizes = checkpointed(texts.groupBy("site").agg(F.count(F.lit(1)).alias("n_pages")))
    # counts of rows are no less than counts of texts, so no line is missed; few lines need the keys of texts
    candidates = checkpointed(_frequent(_per_line(_page_lines(pages, site, text)), sizes, params))
    lines = F.array_distinct(
        F.filter(F.transform(F.split("page_text", "\n", -1), _trimmed), lambda x: x != "")
    )
    listed = source.select("site", "k1", "k2", lines.alias("lines"))
    listed = listed.withColumn("page_chars", F.char_length(F.array_join("lines", "")))
    listed = listed.select("site", "k1", "k2", "page_chars", F.explode("lines").alias("line"))
    listed = listed.select(
        "site", "k1", "k2", "page_chars", F.char_length("line").alias("chars"), F.unhex(F.md5("line")).alias("digest")
    )
    hits = listed.alias("l").join(broadcast_if_small(candidates, 64).alias("r"), _same_line("l", "r"), "left_semi")
    hits = hits.groupBy("site", "k1", "k2", "digest").agg(F.max("chars").alias("chars"), F.max("page_chars").alias("page_chars"))
    hits = checkpointed(hits)
    first = checkpointed(_frequent(_per_line(hits), sizes, params))
    gone = hits.alias("l").join(first.alias("r"), _same_line("l", "r"), "left_semi")
    gone = gone.groupBy("site", "k1", "k2").agg(F.sum("chars").alias("lost"), F.max("page_chars").alias("page_chars"))
    left = F.col("page_chars") - F.col("lost")
    near = checkpointed(gone.where(left < F.lit(params.min_left) * F.col("page_chars")).select("site", "k1", "k2"))
    same_text = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in ("site", "k1", "k2")]
    others = hits.alias("l").join(near.alias("r"), same_text, "left_anti")
    aside = near.groupBy("site").agg(F.count(F.lit(1)).alias("n_near"))
    sizes = sizes.alias("l").join(aside.alias("r"), F.col("l.site").eqNullSafe(F.col("r.site")), "left")
    sizes = sizes.select("l.site", (F.col("n_pages") - F.coalesce("n_near", F.lit(0))).alias("n_pages"))
    again = _frequent(_per_line(others), sizes, params)
    return again.alias("l").join(first.alias("r"), _same_line("l", "r"), "left_semi")


def boilerplate_lines(pages: DataFrame, params: LineDedupParams, site: str, text: str) -> DataFrame:
    """One row per site with lines to remove: its name and their digests."""
    if params.copies_once:
        frequent = _lines_beyond_copies(pages, params, site, text)
    else:
        sizes = pages.groupBy(F.col(site).alias("site")).agg(F.count(F.lit(1)).alias("n_pages"))
        frequent = _frequent(_per_line(_page_lines(pages, site, text)), sizes, params)
    return frequent.groupBy(F.col("site").alias("line_site")).agg(
        F.collect_list(F.lower(F.hex("digest"))).alias("line_digests")
    )


def without_boilerplate(
    pages: DataFrame,
    params: LineDedupParams = LineDedupParams(),
    id_column: str = "doc_id",
    site: str = "source",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The id, the site, carried columns, ``text`` without boilerplate, ``n_lines``, ``n_dropped``.

    ``n_lines`` are the lines of a page that are not blank, ``n_dropped`` those removed.
    """
    found = checkpointed(boilerplate_lines(pages, params, site, text))
    digests = found.agg(F.coalesce(F.sum(F.size("line_digests")), F.lit(0))).first()[0]
    found = broadcast_if_small(found, 64 + 40 * digests // max(1, found.count()))
    wanted = list(dict.fromkeys((id_column, site, *carry)))
    source = pages.select(*wanted, F.col(text).cast("string").alias("page_text"))
    joined = source.join(found, F.col(site).eqNullSafe(F.col("line_site")), "left")
    lines = F.split("page_text", "\n", -1)
    # digests are computed only for pages of sites that have lines to remove
    hits = F.when(
        F.col("line_digests").isNotNull() & F.col("page_text").isNotNull(),
        F.array_intersect(F.transform(lines, _digest), "line_digests"),
    )
    hit = F.coalesce(F.size("hits"), F.lit(0)) > 0
    kept = F.filter(lines, lambda x: ~F.array_contains("hits", _digest(x)))
    marked = joined.withColumn("hits", hits).withColumn("kept_lines", F.when(hit, kept).otherwise(lines))
    return marked.select(
        *wanted,
        F.array_join("kept_lines", "\n").alias("text"),
        F.coalesce(F.size(F.filter(lines, lambda x: _trimmed(x) != "")), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size("kept_lines"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
