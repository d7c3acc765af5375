"""Line dedup by site-relative frequency. Built-in functions only.

A page's lines are the texts between its block elements. A line is boilerplate of a host if more than ``ratio`` of the
host's pages have it, and at least ``min_pages`` do, by default two: what one page alone has isn't repeated, however few
pages its host has. Such lines are dropped from all of the host's pages. Lines are
counted once a page, by 128-bit hashes that are summed before the shuffle, so a host with a large share of all pages is
spread by its lines. A host has at most (mean lines of its pages) / ``ratio`` boilerplate lines, as their shares
add up to its mean number of lines: this bounds the list that meets its pages.

Defined cases: null html has no lines; a null url, or one without a host, is the host of the empty name; rows with one
page_id are pages of their own; a very long page is read whole, its lines as one value of a task; an empty table gives an empty result; extra columns are kept by :func:`deduped`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natspark.llm.common import free_name, stored

RATIO, MIN_PAGES = 0.3, 2
#: Unseen parts, and elements that end a line.
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|"
    "section|table|tbody|td|tfoot|th|thead|title|tr|ul"
)
BREAK = rf"(?i)</?(?:{BLOCKS})(?:[ \t\r\n][^>]*)?/?>|[\r\n]+"
TAG, SPACES = r"<[^>]*>", r"[ \t\x0B\x0C]+"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def page_lines(html: Column) -> Column:
    """The lines of a page, without tags and blank ones."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    text = F.regexp_replace(F.regexp_replace(text, BREAK, "\n"), TAG, "")
    plain = F.transform(F.split(F.regexp_replace(text, SPACES, " "), "\n"), lambda x: F.btrim(x))
    return F.filter(plain, lambda x: x != "")


def line_id(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, pages, drop``: the identifiers of each host's boilerplate lines."""
    read = pages.select(host(F.col("url")).alias("host"), F.array_distinct(F.transform(page_lines(F.col("html")), line_id)).alias("ids"))
    totals = read.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    # The outer form, as for the other Spark tests the list before it is exploded, and so makes it twice.
    each = read.select("host", F.explode_outer("ids").alias("id")).where("id is not null")
    counted = each.groupBy("host", "id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    common = stored(counted, "common-lines").join(stored(totals, "hosts"), "host").where(F.col("n") > ratio * F.col("pages"))
    return stored(common.groupBy("host").agg(F.collect_list("id").alias("drop")), "boilerplate")


def deduped(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with ``host``, ``lines`` and ``kept_lines`` (under other names if ``pages`` has them)."""
    names = [free_name(pages, n) for n in ("host", "lines", "kept_lines", "drop", "of")]
    at, lines, kept, drop, of = names
    found = boilerplate(pages.select("url", "html"), ratio, min_pages).select(F.col("host").alias(of), F.col("drop").alias(drop))
    joined = pages.withColumn(at, host(F.col("url"))).join(found, F.col(at) == F.col(of), "left").withColumn(lines, page_lines(F.col("html")))
    stays = F.when(F.col(drop).isNull(), F.col(lines)).otherwise(F.filter(lines, lambda x: ~F.array_contains(F.col(drop), line_id(x))))
    return joined.withColumn(kept, stays).select(*pages.columns, at, lines, kept)


def digests(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``page_id, host, n_lines, n_removed, kept_sha256`` (of the kept lines, joined by line ends) of every page."""
    made = deduped(pages.select("page_id", "url", "html"), ratio, min_pages)
    removed = (F.size("lines") - F.size("kept_lines")).cast("long")
    return made.select("page_id", "host", F.size("lines").cast("long").alias("n_lines"), removed.alias("n_removed"), F.sha2(F.array_join("kept_lines", "\n"), 256).alias("kept_sha256"))


ORACLE = rf"""
WITH texts AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)) AS host,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '{HIDDEN}', ' ', 'g'), '{BREAK}', chr(10), 'g'), '{TAG}', '', 'g'), '{SPACES}', ' ', 'g') AS text
  FROM pages
), lines AS (
  SELECT *, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines FROM texts
), counted AS (
  SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM lines) t GROUP BY ALL
), totals AS (SELECT host, count(*) AS pages FROM lines GROUP BY ALL), bad AS (
  SELECT host, list(line) AS bad FROM counted JOIN totals USING (host) WHERE n >= {MIN_PAGES} AND n > {RATIO} * pages GROUP BY ALL
), kept AS (
  SELECT page_id, host, lines, CASE WHEN bad IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(bad, x)) END AS kept FROM lines LEFT JOIN bad USING (host)
)
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256 FROM kept
"""
