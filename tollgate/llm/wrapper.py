"""Main text of web pages by wrapper induction.

Pages of a host are aligned by simple tree matching (dynamic programming over the children of equal nodes, top down). Their
folded trees merge into one wrapper per host: groups of about FAN trees first, then the groups' wrappers, in a reduction
tree whose rounds grow with the logarithm of the host's different trees. Aligned nodes are the wrapper's slots. A block of
text that stands in its slot on most of the host's pages (not only of those that have such a slot) is template; blocks that
vary from page to page are content. A block must stand on MIN_PAGES different pages to be template, so hosts with few pages lose
nothing. Copies and near copies count as one page: pages are told apart by the least digest of their blocks, which pages
with nearly the same blocks nearly always share and pages that share only a template mostly don't. Parts that say what
they are (menus, sidebars, adverts, forms, comments; see `dom`) are no content either.

Only digests of blocks and different trees are shuffled; pages meet the list of their template blocks, which is broadcast
only if Spark's size limit allows. Null html is empty. Pages without a host in their url are aligned among themselves. Repeated
rows are treated alike. An empty table gives an empty result. Pages whose blocks would all go keep them: a page is no
template as a whole.
"""

from __future__ import annotations

import sys
from itertools import groupby

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import map_rows, stored
from tollgate.llm.dom import Page

FAN = 64  # trees merged in one group
MIN_PAGES, SHARE = 3, 0.8
KEYS = "page_id long, html_hash long"


class Tree:
    """Keys and children of a folded tree; node 0 is its root."""

    def __init__(self, parents: list[int], keys: list[str]):
        self.keys, self.children = list(keys), [[] for _ in keys]
        for node, parent in enumerate(parents):
            if parent >= 0:
                self.children[parent].append(node)

    def flat(self) -> tuple[list[int], list[str]]:
        """Parents and keys in page order."""
        parents, keys, todo = [], [], [(0, -1)]
        while todo:
            node, parent = todo.pop()
            todo += [(child, len(keys)) for child in reversed(self.children[node])]
            parents.append(parent)
            keys.append(self.keys[node])
        return parents, keys


def align(a: Tree, b: Tree) -> dict[int, int]:
    """Simple tree matching: nodes of b by the nodes of a they are matched with, roots first."""
    sizes: dict[tuple[int, int], int] = {}

    def table(x: int, y: int) -> list[list[int]]:
        xs, ys = a.children[x], b.children[y]
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, c in enumerate(xs, 1):
            for j, d in enumerate(ys, 1):
                both = best[i - 1][j - 1] + size(c, d) if a.keys[c] == b.keys[d] else 0
                best[i][j] = max(best[i - 1][j], best[i][j - 1], both)
        return best

    def size(x: int, y: int) -> int:
        if (x, y) not in sizes:
            sizes[x, y] = 1 + (table(x, y)[-1][-1] if a.children[x] and b.children[y] else 0)
        return sizes[x, y]

    matched, todo = {0: 0}, [(0, 0)]
    while todo:
        x, y = todo.pop()
        xs, ys = a.children[x], b.children[y]
        if not xs or not ys:
            continue
        best = table(x, y)
        i, j = len(xs), len(ys)
        while i and j:
            c, d = xs[i - 1], ys[j - 1]
            if a.keys[c] == b.keys[d] and best[i][j] == best[i - 1][j - 1] + size(c, d):
                matched[d] = c
                todo.append((c, d))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return matched


def merge(a: Tree, b: Tree) -> None:
    """Add to the wrapper a what b has beyond it, next to what is matched."""
    matched = align(a, b)
    todo = [0]
    while todo:
        parent = todo.pop()
        place = 0
        siblings = a.children[matched[parent]]
        for child in b.children[parent]:
            if child in matched:
                place = siblings.index(matched[child]) + 1
            else:
                matched[child] = len(a.keys)
                siblings.insert(place, matched[child])
                a.keys.append(b.keys[child])
                a.children.append([])
                place += 1
            todo.append(child)


def host_of(url: str | None) -> str:
    rest = (url or "").partition("://")[2] or (url or "").removeprefix("//")
    return rest.partition("/")[0].partition("?")[0].partition("#")[0].rpartition("@")[2].partition(":")[0].lower()


def skeletons(rows):
    """Of each page: host, its folded tree, and its article's blocks as (node, digest)."""
    for page_id, html_hash, url, html in rows:
        page = Page(html or "")
        blocks = page.article()
        yield (
            page_id, html_hash, host_of(url), page.parents, page.keys,
            [node for node, _ in blocks], [xxhash.xxh64_intdigest(text) - (1 << 63) for _, text in blocks],
        )


def merge_groups(rows):
    """One wrapper for each run of rows with equal (host, bucket)."""
    sys.setrecursionlimit(1_000_000)
    for (host, _), group in groupby(rows, key=lambda r: r[:2]):
        wrapper = None
        for *_, parents, keys in group:
            tree = Tree(parents, keys)
            if wrapper is None:
                wrapper = tree
            else:
                merge(wrapper, tree)
        yield host, *wrapper.flat()


def wrappers(trees: DataFrame) -> DataFrame:
    """(host, parents, keys): one wrapper per host from a table (host, parents, keys) of different trees."""
    while True:
        counted = trees.groupBy("host").agg(F.count("*").alias("n"))
        most = counted.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return trees
        dealt = trees.join(counted, "host").withColumn("order", F.xxhash64("parents", "keys")).select(
            "host", F.pmod("order", F.ceil(F.col("n") * 2 / FAN)).alias("bucket"), F.size("keys").alias("size"), "order", "parents", "keys"
        )
        ordered = dealt.repartition("host", "bucket").sortWithinPartitions("host", "bucket", F.desc("size"), "order")
        trees = stored(map_rows(ordered.select("host", "bucket", "parents", "keys"), merge_groups, "host string, parents array<int>, keys array<string>"), "wrappers")


def slots(rows):
    """Slot of each node of a tree in its host's wrapper; -1 where the wrapper has none."""
    sys.setrecursionlimit(1_000_000)
    for host, tree, parents, keys, wrapper_parents, wrapper_keys in rows:
        matched = align(Tree(wrapper_parents, wrapper_keys), Tree(parents, keys))
        yield host, tree, [matched.get(node, -1) for node in range(len(keys))]


def template_blocks(parsed: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(page_id, html_hash, drop): places of the template blocks of pages that have some."""
    trees = stored(parsed.groupBy("host", "tree").agg(F.first("parents").alias("parents"), F.first("keys").alias("keys")), "trees")
    induced = wrappers(trees.select("host", "parents", "keys")).withColumnsRenamed({"parents": "wp", "keys": "wk"})
    aligned = map_rows(trees.join(induced, "host").select("host", "tree", "parents", "keys", "wp", "wk"), slots, "host string, tree long, slots array<int>")
    blocks = (
        parsed.select("page_id", "html_hash", "host", "tree", F.array_min("digests").alias("sign"), F.posexplode(F.arrays_zip("nodes", "digests")).alias("place", "block"))
        .join(aligned, ["host", "tree"])
        .select("page_id", "html_hash", "host", F.get("slots", F.col("block.nodes")).alias("slot"), F.col("block.digests").alias("digest"), "place", "sign")
        .filter("slot >= 0")
    )
    # copies and near copies of a page count once
    signs = parsed.select("page_id", "html_hash", "host", F.array_min("digests").alias("sign")).filter("sign is not null")
    pages = signs.select("host", "sign").distinct().groupBy("host").agg(F.count("*").alias("n_pages"))
    standing = blocks.select("host", "slot", "digest", "sign").distinct()
    constant = (
        standing.groupBy("host", "slot", "digest").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
        .join(pages, "host").filter(F.col("n") >= share * F.col("n_pages")).select("host", "slot", "digest")
    )
    return blocks.join(constant, ["host", "slot", "digest"]).groupBy("page_id", "html_hash").agg(F.collect_set("place").alias("drop"))


def texts(rows):
    for page_id, url, html, drop in rows:
        blocks = [text for _, text in Page(html or "").article()]
        gone = set(drop or ())
        kept = [text for place, text in enumerate(blocks) if place not in gone]
        yield page_id, url, "\n".join(kept or blocks), len(blocks) - len(kept) if kept else 0


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_template (blocks left out as the host's template)."""
    keyed = pages.select(F.col(page_id).alias("page_id"), F.xxhash64(html).alias("html_hash"), F.col(url).alias("url"), F.col(html).alias("html"))
    found = map_rows(keyed, skeletons, f"{KEYS}, host string, parents array<int>, keys array<string>, nodes array<int>, digests array<long>")
    parsed = stored(found.withColumn("tree", F.xxhash64("parents", "keys")), "skeletons")
    drops = stored(template_blocks(parsed), "template-blocks").withColumnsRenamed({"page_id": "p", "html_hash": "h"})
    joined = keyed.join(drops, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("html_hash") == F.col("h")), "left")
    return map_rows(joined.select("page_id", "url", "html", "drop"), texts, "page_id long, url string, text string, n_template int")
