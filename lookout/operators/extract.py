"""HTML page -> place record, as one Arrow-batched Spark job (section 2.2).

Pages are not well-formed XML (unclosed ``<p>``/``<b>``, ``"</p>"`` inside
scripts), so Spark's ``xpath`` functions cannot read them. Each executor
parses its partition's pages with the standard library's tolerant
``html.parser`` inside ``mapInPandas`` (Arrow batches, no per-row
serialisation), returning only the raw blocks. Everything after that --
splitting the location, the price band, the cuisine label, card names from
image paths -- is ordinary Catalyst expressions on the result.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_library
from . import places as PL

# FIXED VALUES -- the page blocks a place record is read from.
TITLE_TAG = "h1"
BLOCK_CLASS = "data-sheet__block--text"      # 1st: location, 2nd: attributes
DESCRIPTION_CLASS = "data-sheet__description"
SERVICES_CLASS = "col col-12 col-lg-6"        # services list or card images
PHONE_EVENT = "CTA_tel"
WEBSITE_EVENT = "CTA_website"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Opening one of these closes an open element of the same kind (HTML's
# implied end tags for the elements that matter here).
SELF_CLOSING_SIBLINGS = frozenset(["p", "li", "option"])

RAW_SCHEMA = ("page_id bigint, name string, location string, attributes string, "
              "description string, facilities array<string>, card_srcs array<string>, "
              "phone string, website string")


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def text(self) -> str:
        out = []
        stack = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                stack.extend(reversed(node.children))
        return "".join(out)

    def find_all(self, tag, pred=lambda n: True):
        found, stack = [], list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                continue
            if node.tag == tag and pred(node):
                found.append(node)
            stack.extend(reversed(node.children))
        return found


class _TreeBuilder(HTMLParser):
    """Tolerant element tree: unknown end tags are ignored, an end tag
    closes the nearest open element of that name, void elements never open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        if tag in SELF_CLOSING_SIBLINGS and self.cur.tag == tag:
            self.cur = self.cur.parent
        node = _Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(_Node(tag, {k: (v or "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        node = self.cur
        while node is not self.root and node.tag != tag:
            node = node.parent
        if node is not self.root:
            self.cur = node.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def _has_class(name):
    def pred(node):
        cls = node.attrs.get("class", "")
        return cls == name or name in cls.split()
    return pred


def parse_page(html: str) -> dict:
    """Raw blocks of one page (a small per-row helper of the job)."""
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    root = b.root
    h1 = root.find_all(TITLE_TAG)
    blocks = root.find_all("div", _has_class(BLOCK_CLASS))
    desc = root.find_all("div", _has_class(DESCRIPTION_CLASS))
    facilities, cards = [], []
    for block in root.find_all("div", lambda n: n.attrs.get("class", "") == SERVICES_CLASS):
        if not block.find_all("div"):
            facilities = [li.text().strip() for li in block.find_all("li")]
        else:
            cards = [img.attrs.get("data-src", "") for img in block.find_all("img")]
    phone = root.find_all("a", lambda n: n.attrs.get("data-event") == PHONE_EVENT)
    site = root.find_all("a", lambda n: n.attrs.get("data-event") == WEBSITE_EVENT)
    return {
        "name": h1[0].text().strip() if h1 else "",
        "location": blocks[0].text().strip() if len(blocks) > 0 else "",
        "attributes": blocks[1].text().strip() if len(blocks) > 1 else "",
        "description": desc[0].text().strip() if desc else "",
        "facilities": facilities,
        "card_srcs": cards,
        "phone": phone[0].attrs.get("href", "").replace("tel:", "") if phone else "",
        "website": site[0].attrs.get("href", "") if site else "",
    }


def _parse_batches(batches):
    for pdf in batches:
        rows = [parse_page(h) for h in pdf["html"]]
        out = pd.DataFrame(rows, columns=["name", "location", "attributes", "description",
                                          "facilities", "card_srcs", "phone", "website"])
        out.insert(0, "page_id", pdf["page_id"].to_numpy())
        yield out


def raw_blocks(pages: DataFrame) -> DataFrame:
    """The Python part: ``pages(page_id, html)`` -> raw blocks per page."""
    ship_library(pages.sparkSession)
    return pages.select("page_id", "html").mapInPandas(_parse_batches, RAW_SCHEMA)


def extract_places(pages: DataFrame, strict: bool = False) -> DataFrame:
    """H3..H10 + H12: typed place records from raw pages.

    Each record stands alone: a page without a services block gets empty
    lists (the original carried the previous page's lists over)."""
    raw = raw_blocks(pages)
    return raw.select(
        "page_id",
        F.col("name").alias("restaurantName"),
        *PL.split_location(F.col("location"), strict=strict),
        PL.price_band(F.col("attributes")).alias("priceRange"),
        PL.cuisine_label(F.col("attributes")).alias("cuisineType"),
        "description",
        F.col("facilities").alias("facilitiesServices"),
        F.transform("card_srcs", PL.path_token).alias("creditCards"),
        F.col("phone").alias("phoneNumber"),
        "website",
    )
