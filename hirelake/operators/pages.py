"""Listing and detail pages.

HTML is read as token arrays (:mod:`..functions.html`), one row per page,
with built-in expressions; no HTML parser runs on the driver or in a Python
worker, and a page may hold any number of tags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as h
from ..functions.text import clean_tags, extract_id

# --- FIXED VALUES: posting id inside a listing link -------------------------
POSTING_LINK_ID = r"/positions/(\d+)"
# -----------------------------------------------------------------------------
URL_NUMERIC_ID = r"/(\d+)"


def page_tokens(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id and the tokens of each page, for the functions below."""
    return pages.select("page_id", h.tokens(html).alias("_t"))


def page_links(pages: DataFrame, id_pattern: str = POSTING_LINK_ID, only_ids: bool = True) -> DataFrame:
    """Href of the first anchor inside each list item, in page order,
    with the id the pattern captures; ``only_ids`` keeps links that hold an
    id. An item ends where the next one starts or a list item closes."""
    t = page_tokens(pages)
    items = t.select("page_id", "_t", h.spans(F.col("_t"), h.named("li")).alias("_items"))

    def href(item):
        inside = F.slice(F.col("_t"), item["at"], item["n"])
        anchors = F.filter(inside, lambda x: (x["name"] == "a") & ~x["close"])
        opens = ~F.get(inside, F.lit(0))["close"]
        return F.when(opens, F.nullif(h.attribute(F.get(anchors, F.lit(0))["head"], "href"), F.lit("")))

    hrefs = F.filter(F.transform("_items", href), lambda x: x.isNotNull())
    links = items.select("page_id", F.posexplode(hrefs).alias("pos", "href"))
    out = links.withColumns({"pos": F.col("pos").cast("bigint"), "posting_id": extract_id("href", id_pattern)})
    return out.where(F.col("posting_id").isNotNull()) if only_ids else out


def url_id(pages: DataFrame, pattern: str = URL_NUMERIC_ID) -> DataFrame:
    """Numeric id captured from the page URL."""
    return pages.select("page_id", extract_id("url", pattern).alias("url_id"))


def first_paragraphs(pages: DataFrame) -> DataFrame:
    """First paragraph of each page, stripped."""
    return page_tokens(pages).select("page_id", h.first_paragraph(F.col("_t")).alias("first_paragraph"))


# --- FIXED VALUES: class names of a detail page -------------------------------
HEADING_CLASS = "css-17ueevk"
CONTAINER_CLASS = "css-1vbiael"
BLOCK_CLASS = "css-15i1vgz"
TAG_LIST_CLASS = "css-104fbyc"
TAG_CLASS = "css-kgsirb"
# -----------------------------------------------------------------------------
BLOCK_NAMES = ["main_work", "require", "preference", "welfare"]


def page_sections(pages: DataFrame) -> DataFrame:
    """I16: the heading, and from the page's text container the first
    paragraph of the intro (its first section) and the first paragraph of each
    of the four blocks of its second section; all found by their class, so
    banners and site headings do not count. NULL where one is missing (an
    empty heading is one)."""
    t = F.col("_t")
    p = page_tokens(pages).select(
        "page_id", F.nullif(h.text_of(h.first_element(t, h.of_class(HEADING_CLASS))), F.lit("")).alias("position_name"),
        h.first_element(t, h.of_class(CONTAINER_CLASS)).alias("_c"))
    section = lambda n: h.first_element(F.col("_c"), h.named("section"), n)
    p = p.select("page_id", "position_name", section(1).alias("_i"), section(2).alias("_s"))
    p = p.select("page_id", "position_name", h.first_paragraph(F.col("_i")).alias("intro"), "_s")
    p = p.select("page_id", "position_name", "intro", "_s", h.starts(F.col("_s"), h.of_class(BLOCK_CLASS)).alias("_b"))
    block = lambda i: h.element(F.col("_s"), F.get("_b", F.lit(i)))
    p = p.select("page_id", "position_name", "intro", *[block(i).alias(f"_b{i}") for i in range(len(BLOCK_NAMES))])
    return p.select("page_id", "position_name", "intro",
                    *[h.first_paragraph(F.col(f"_b{i}")).alias(n) for i, n in enumerate(BLOCK_NAMES)])


def skill_tags(pages: DataFrame) -> DataFrame:
    """The skill tags in the tag list of each detail page, cleaned; none
    on a page without such a list. A tag ends where the next one starts."""
    listed = page_tokens(pages).select("page_id", h.first_element(F.col("_t"), h.of_class(TAG_LIST_CLASS)).alias("_l"))
    found = listed.select("page_id", "_l", h.opening_spans(F.col("_l"), h.of_class(TAG_CLASS)).alias("_at"))
    one = lambda s: h.text_of(h.element(F.slice(F.col("_l"), s["at"], s["n"]), F.lit(1)))
    texts = found.select("page_id", F.transform("_at", one).alias("_x"))
    return texts.select("page_id", F.coalesce(clean_tags("_x"), F.array().cast("array<string>")).alias("tags"))


def distinct_ids(listings: DataFrame, payload: str = "payload") -> DataFrame:
    """Distinct ids over listing payloads ({"data": [{"id": ...}, ...]}):
    pages repeat ids, the last one is empty."""
    parsed = F.from_json(payload, "data array<struct<id: bigint>>")["data"]
    return (listings.select(F.explode(parsed).alias("_job")).select(F.col("_job.id").alias("posting_id"))
            .where(F.col("posting_id").isNotNull()).distinct())
