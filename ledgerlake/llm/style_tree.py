"""The main text of web pages, by a style tree of the pages of each site."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import collect_bitmap, in_bitmap
from ledgerlake.llm.html_blocks import Block, blocks
from ledgerlake.llm.tables import stored

#: What has less importance (0 to 1) is removed, where at least so many pages of a site tell it.
IMPORTANCE, PAGES = 0.3, 5
#: What a page's mark of its article adds to the importance of what is in it.
MARKED = 0.1
#: The part that the tags within a node have in its importance; its contents have the rest.
PRESENTATION = 0.3

_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_COUNTED = 200_000


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts)) - (1 << 63)


def style_of(host: str, block: Block) -> int:
    """A text that a node of a site's style tree shows."""
    return _hash(host, block.path, block.text)


def _nodes(found: list[Block]) -> dict[str, list[Block]]:
    """The blocks of a page by their places in its tree."""
    nodes: dict[str, list[Block]] = {}
    for block in found:
        nodes.setdefault(block.path, []).append(block)
    return nodes


def shown_by(host: str, path: str, held: list[Block]) -> int:
    """All that a page shows at a place, as one style of the node."""
    return _hash(host, path, "", *[b.text for b in held])


def _page(host: str, found: list[Block]) -> int:
    """Equal for pages of a site that say the same: in their article, if one is marked, else in all."""
    seen = [b for b in found if not b.noise]
    return _hash(host, *[f"{b.path}\0{b.text}" for b in [b for b in seen if b.article] or seen or found])


def _pages_of(batches):
    """Batches of url and html as (site, page, url, html, blocks) of the pages with a host."""
    for batch in batches:
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html"), strict=True):
            if (host := host_of(url)) and html.is_valid:
                text = html.as_py()
                found = blocks(text)
                yield host, _page(host, found), url, text, found


def _distinct(pages: DataFrame) -> tuple[DataFrame, object]:
    """url and html of one page of each group of pages that may say the same; and a broadcast bitmap
    of what these say: a page that is not in it has no copy."""

    def said(batches):
        for batch in batches:
            found = pa.array([page for _, page, *_ in _pages_of([batch])], pa.int64())
            yield pa.record_batch([found], names=["page"])

    often = pages.mapInArrow(said, "page long").groupBy("page").count().where("count > 1")
    bitmap = collect_bitmap(stored(often, "style-pages"), "page")
    bitmap = pages.sparkSession.sparkContext.broadcast(bitmap)

    def copied(batches):
        for batch in batches:
            rows = [(page, url, html) for _, page, url, html, _ in _pages_of([batch])]
            known = in_bitmap(bitmap.value, np.array([r[0] for r in rows], np.int64).view(np.uint64))
            rows = [r for r, k in zip(rows, known, strict=True) if k]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.record_batch(columns, names=["page", "url", "html"])

    rows = pages.mapInArrow(copied, "page long, url string, html string")
    one = rows.groupBy("page").agg(F.min(F.struct("url", "html")).alias("one"))
    return one.select("one.url", "one.html"), bitmap


def _styles(pages: DataFrame) -> DataFrame:
    """node, host, marked, kind, style, times, shown: on how many pages of a site a node has this style,
    counted in the tasks first.

    Of each page and node, kind 0: the tags in it; 1: all its texts; 2: that it is there; 3: each text,
    by how many times the node shows it. Pages without a host are no site; pages of a site that say
    the same count once.
    """
    copies, bitmap = _distinct(pages)

    def counted(alone: bool):
        def run(batches):
            counts: Counter[tuple[int, ...]] = Counter()
            for host, page, _, _, found in _pages_of(batches):
                if alone and in_bitmap(bitmap.value, np.array([page], np.int64).view(np.uint64))[0]:
                    continue
                site = _hash(host)
                for path, held in _nodes(found).items():
                    key = (_hash(host, path), site, int(held[0].article))
                    counts[(*key, 0, _hash(*[b.tags for b in held]), 0)] += 1
                    counts[(*key, 1, shown_by(host, path, held), 0)] += 1
                    counts[(*key, 2, 0, 0)] += 1
                    for style, times in Counter(style_of(host, b) for b in held).items():
                        counts[(*key, 3, style, times)] += 1
                if len(counts) >= _COUNTED:
                    yield _counted(counts)
                    counts = Counter()
            yield _counted(counts)

        return run

    schema = ", ".join(f"{name} long" for name in (*_STYLE, "shown"))
    rows = pages.mapInArrow(counted(True), schema).unionByName(copies.mapInArrow(counted(False), schema))
    return rows.groupBy(*_STYLE).agg(F.sum("shown").alias("shown"))


_STYLE = ("node", "host", "marked", "kind", "style", "times")


def _counted(counts: Counter[tuple[int, ...]]) -> pa.RecordBatch:
    rows = np.array([(*key, n) for key, n in counts.items()], np.int64).reshape(-1, len(_STYLE) + 1)
    return pa.record_batch(list(map(pa.array, rows.T.copy())), names=[*_STYLE, "shown"])


def _evenness(repeats: Column, pages: Column, kinds: Column) -> Column:
    """The entropy of how pages divide into kinds, of the largest possible for so many kinds.

    repeats: the sum of n log n of the kinds' pages. The same at any number of pages: 0 where all
    are alike, 1 where all kinds are as frequent, be it two or as many as there are pages.
    """
    entropy = F.greatest(F.log(pages) - repeats / pages, F.lit(0.0))
    return entropy / F.log(F.greatest(kinds, F.lit(2)))


def low_styles(pages: DataFrame, importance: float, least: int, presentation: float) -> DataFrame:
    """host, styles: what each site shows alike on nearly all pages, of the sites that have any.

    Importance is the entropy, over the pages that show a node, of what they show there, as a share of
    the largest possible for so many different things: of a node that of its tags and that of all its
    texts, weighted; of a text that of how many times the node shows it on a page. A low node loses
    what most of its pages show; a low text goes if most pages of its node have it. So it does not
    matter how many pages a site has, nor whether a place takes few different values. What is in a
    marked article has `MARKED` more.
    """
    styles = stored(_styles(pages), "styles")
    shift = F.col("marked") * MARKED
    shown = F.col("shown")
    sizes = styles.where("kind = 2").select("node", shown.alias("pages"))
    sizes = sizes.where(F.col("pages") >= least)
    by_kind = (
        styles.where("kind < 2")
        .groupBy("node", "host", "marked", "kind")
        .agg(
            F.sum(shown * F.log(shown)).alias("repeats"),
            F.count("*").alias("kinds"),
            F.max_by("style", "shown").alias("most"),
        )
        .join(sizes, "node")
        .withColumn("even", _evenness(F.col("repeats"), F.col("pages"), F.col("kinds")))
    )
    weight = F.when(F.col("kind") == 0, F.lit(presentation)).otherwise(F.lit(1 - presentation))
    nodes = by_kind.groupBy("node", "host", "marked").agg(
        F.sum(weight * F.col("even")).alias("importance"),
        F.max(F.when(F.col("kind") == 1, F.col("even"))).alias("texts"),
        F.max(F.when(F.col("kind") == 1, F.col("most"))).alias("style"),
    )
    low = nodes.where(F.greatest("importance", "texts") + shift < importance).select("host", "style")
    texts = (
        styles.where("kind = 3")
        .groupBy("node", "host", "marked", "style")
        .agg(
            F.sum(shown * F.log(shown)).alias("repeats"),
            F.count("*").alias("kinds"),
            F.sum(shown).alias("present"),
            F.max(shown).alias("most"),
        )
        .where(F.col("present") >= least)  # before the join: most texts are on one page
        .join(sizes, "node")
        .withColumn("absent", F.col("pages") - F.col("present"))
        .where("most > absent")
    )
    without = F.when(F.col("absent") > 0, F.col("absent") * F.log("absent")).otherwise(0.0)
    kinds = F.col("kinds") + (F.col("absent") > 0).cast("int")
    even = _evenness(F.col("repeats") + without, F.col("pages"), kinds)
    alike = texts.where(even + shift < importance).select("host", "style")
    return low.unionByName(alike).groupBy("host").agg(F.collect_set("style").alias("styles"))


def main_text(url: str | None, html: str | None, low: frozenset[int]) -> str:
    """The blocks of a page's article, joined by one space.

    Of the blocks that are not of small importance on the page's site: those that the page marks as
    its article, if it marks any, else all; without what names tell to be noise.
    """
    whole = blocks(html or "")
    found = [b for b in whole if not b.noise]
    found = [b for b in found if b.article] or found
    if not low:
        return " ".join(b.text for b in found)
    host = host_of(url)
    alike = {path for path, held in _nodes(whole).items() if shown_by(host, path, held) in low}
    return " ".join(b.text for b in found if b.path not in alike and style_of(host, b) not in low)


def extract_text(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    importance: float = IMPORTANCE,
    least: int = PAGES,
    presentation: float = PRESENTATION,
) -> DataFrame:
    """`page_id`, `url` and text: the main text of every page's whole html; one row per input row.

    The pages of a host make a style tree of all their blocks: the nodes are the places of blocks in
    their trees, with the tags and texts that they show. What a node shows alike on nearly all its
    pages is taken out (`low_styles`), also in what a page marks as its article, which only counts as
    somewhat more important (`MARKED`); from fewer than `least` pages nothing can be told. A place
    that takes few values, such as a cell of yes and no, keeps them. Pages of a host that say the
    same count once, so that copies of a page don't remove each other. Checked afterwards: elements
    that by name are no article (menus, headers, footers, sidebars, notices, adverts, forms,
    comments) go, and what is outside a marked article. Character references are decoded, white
    space in a block becomes one space, blocks are joined by one space.

    Null and empty html give an empty text; pages without a host (null or odd urls) have no tree;
    repeated rows are extracted each. The tree is counted in the tasks first, so a host
    with very many pages is no hot key; only pages of hosts that have something to remove are shuffled,
    with no more than what one page of the host may show alike.
    """
    sc = pages.sparkSession.sparkContext
    rows = pages.select(
        F.col(page_id).alias("key"),
        F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
    )
    low = stored(low_styles(rows.select("url", "html"), importance, least, presentation), "style-tree")
    hosts = sc.broadcast(collect_bitmap(low, "host"))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, url string, html string, host long"

    def split(wanted: bool):
        def run(batches):
            for batch in batches:
                host = np.array([_hash(host_of(u)) for u in batch.column(1).to_pylist()], np.int64)
                keep = pa.array(in_bitmap(hosts.value, host.view(np.uint64)) == wanted)
                columns = [*batch.columns, pa.array(host)]
                yield pa.record_batch(columns, names=["key", "url", "html", "host"]).filter(keep)

        return run

    def texts(batches):
        for batch in batches:
            styles = batch.column(3).to_pylist()
            found = [
                main_text(u, h.as_py(), frozenset(low or ()))
                for u, h, low in zip(batch.column(1).to_pylist(), batch.column(2), styles, strict=True)
            ]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.string())]
            yield pa.record_batch(columns, names=["key", "url", "text"])

    out = f"key {kind}, url string, text string"
    none = F.lit(None).cast("array<long>").alias("styles")
    plain = rows.mapInArrow(split(False), schema).select("key", "url", "html", none)
    judged = rows.mapInArrow(split(True), schema).join(low, "host", "left")
    judged = judged.select("key", "url", "html", "styles")
    done = plain.mapInArrow(texts, out).unionByName(judged.mapInArrow(texts, out))
    return done.select(F.col("key").alias(page_id), F.col("url").alias(url), "text")
