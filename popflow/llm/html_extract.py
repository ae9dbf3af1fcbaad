"""Main text of pages by a site style tree.

The element trees of a host's pages are merged: elements with one path of tags
and classes are one node. A node's presentation is important where its child
sequences vary between pages, its content where texts and links vary; both are
entropies over the host's distinct pages, combined from the leaves up. Branches
of low importance in which no texts vary go from every page, besides those that
their own tag, role or class names as furniture; prose inside an article or main
element stays.
"""

from __future__ import annotations

import html as entities
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popflow.llm.common import small, staged
from popflow.llm.html_tree import HEADINGS, INLINE, NOISE_TAGS, PROSE, Page, parse

#: Damping of the presentation of nodes with few alternatives; one alternative says nothing and damps nothing.
GAMMA = 0.9
#: Importance up to which a branch goes, and pages of a node needed to judge it.
MAX_NOISE = 0.35
MIN_PAGES = 8
#: Counters a map task holds before it hands them on.
FLUSH_KEYS = 300_000

COUNTS = pa.schema([("host", pa.string()), ("path", pa.int64()), ("above", pa.int64()), ("kind", pa.string()),
                    ("value", pa.int64()), ("pages", pa.float64()), ("chain", pa.list_(pa.int64()))])
COUNTS_DDL = "host string, path long, above long, kind string, value long, pages double, chain array<long>"
OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
OUT_DDL = "page_id long, url string, text string, n_chars long"


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def page_counts(page: Page) -> set[tuple[int, int, str, int]]:
    """(path, path above, kind, value) of a page: nodes, child sequences, texts and links."""
    out, children, texts = set(), {}, {}
    for i in range(1, len(page.tag)):
        up = page.parent[i]
        above = page.path[up]
        if page.path[i] == above:  # inline, or below the last level
            continue
        out.add((page.path[i], above, "node", 0))
        row = children.setdefault(above, [])
        if not row or row[-1] != page.sig[i]:
            row.append(page.sig[i])
    above_of = {path: above for path, above, _, _ in out}
    for path, row in children.items():
        if path in above_of:
            out.add((path, above_of[path], "style", _hash("\n".join(row))))
    for node, _, raw in page.runs:
        if not raw.isspace():
            texts.setdefault(page.path[node], []).append(raw)
    for path, parts in texts.items():
        if path in above_of:
            out.add((path, above_of[path], "text", _hash(" ".join("".join(parts).split()))))
    for node, href in page.links:
        if page.path[node] in above_of:
            out.add((page.path[node], above_of[page.path[node]], "text", _hash(href)))
    return out


def chains(above_of: dict[int, int]) -> dict[int, list[int]]:
    """The paths from the top down to each path, itself included."""
    out: dict[int, list[int]] = {}
    for path in above_of:
        way = []
        while path in above_of and path not in out:
            way.append(path)
            path = above_of[path]
        for p in reversed(way):
            out[p] = [*out.get(above_of[p], ()), p]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    chain_of: dict[tuple[str, int], list[int]] = {}

    def flush():
        keys = list(zip(*counts)) or [()] * 5
        known = [chain_of[host, path] if kind == "node" else None for host, path, _, kind, _ in counts]
        return pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(keys, COUNTS)),
                                           pa.array(list(counts.values()), pa.float64()),
                                           pa.array(known, COUNTS.field("chain").type)], schema=COUNTS)

    for batch in batches:
        copies = batch["copies"].to_pylist() if "copies" in batch.schema.names else [1] * batch.num_rows
        for host, text, n in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), copies):
            found = page_counts(parse(text))
            for key in found:
                counts[host, *key] += 1 / n
            for path, chain in chains({path: above for path, above, kind, _ in found if kind == "node"}).items():
                chain_of.setdefault((host, path), chain)
        if len(counts) > FLUSH_KEYS:
            yield flush()
            counts.clear()
            chain_of.clear()
    yield flush()


def with_copies(pages: DataFrame) -> DataFrame:
    """``pages`` (host, html) with ``copies``: the host's rows of the same html. Only content hashes are shuffled."""
    keyed = pages.select("host", "html", F.xxhash64("html").alias("key"), F.length("html").alias("length"))
    many = staged(keyed.groupBy("host", "key", "length").agg(F.count("*").alias("copies")).where("copies > 1"), "page-copies")
    return (keyed.join(small(many, many.count()), ["host", "key", "length"], "left")
            .select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies")))


def node_statistics(counts: DataFrame) -> DataFrame:
    """One row per host and path: chain from the top, pages, styles, presentation and content importance
    (entropies to base pages).

    The copies of a page hold the same keys and count 1 / copies each, so sums are whole numbers of distinct pages.
    """
    chain = counts.where("kind = 'node'").groupBy("host", "path").agg(F.max("chain").alias("chain"))
    counts = counts.groupBy("host", "path", "above", "kind", "value").agg(F.round(F.sum("pages")).alias("n"))
    n = F.col("n")

    def total(kind, value):
        return F.sum(F.when(F.col("kind") == kind, value).otherwise(0.0))

    rows = counts.groupBy("host", "path", "above").agg(
        total("node", n).alias("pages"), total("style", n).alias("s"), total("style", n * F.log(n)).alias("s_log"),
        total("style", F.lit(1.0)).alias("styles"), total("text", n).alias("t"), total("text", n * F.log(n)).alias("t_log"))
    base = F.log(F.greatest("pages", F.lit(2.0)))
    return rows.join(chain, ["host", "path"]).select(
        "host", "path", "above", "chain", "pages", "styles", F.col("t").alias("texts"),
        F.when(F.col("pages") < 2, 1.0).when(F.col("s") > 0, (F.log("s") - F.col("s_log") / F.col("s")) / base)
        .otherwise(0.0).alias("presentation"),
        F.when(F.col("t") <= 0, 0.0).when(F.col("pages") < 2, 1.0)
        .otherwise(1 - F.col("t_log") / F.col("t") / base).alias("content"))


def composite(stats: DataFrame) -> DataFrame:
    """(host, path, pages, score, varied): a node's importance with all that is below it.

    A node's score is (1 - keep) * presentation + keep * the mean of its own
    content and its children's scores, weighted by pages. Multiplied out, that is
    the sum over the node and all below it of what each has of its own, times the
    factors on the way up. A node knows its chain from the top, so the logarithms
    of the factors add up along the chain, and one sum per node gives all scores:
    no loop over levels, no host in one task.
    """
    below = stats.groupBy("host", F.col("above").alias("path")).agg(F.sum("pages").alias("below"))
    weight = F.coalesce("below", F.lit(0.0)) + F.when(F.col("texts") > 0, F.col("pages")).otherwise(0.0)
    facts = stats.join(below, ["host", "path"], "left").withColumn("weight", weight)
    facts = facts.withColumn("keep", F.when((F.col("weight") > 0) & (F.col("styles") > 1), F.pow(
        F.lit(GAMMA), F.col("styles"))).otherwise(1.0))
    inner = F.when((F.col("weight") > 0) & (F.col("texts") > 0), F.col("pages") * F.col("content") / F.col("weight")).otherwise(0.0)
    facts = facts.withColumns({"own": (1 - F.col("keep")) * F.col("presentation") + F.col("keep") * inner,
                               "varies": (F.col("texts") > 0) & (F.col("content") > MAX_NOISE)})
    upper = facts.select("host", F.col("path").alias("above"), F.try_divide("keep", "weight").alias("part"))
    facts = staged(facts.join(upper, ["host", "above"], "left").select(
        "host", "path", "chain", "pages", "own", "varies", F.coalesce(F.log(F.col("part") * F.col("pages")), F.lit(0.0)).alias("factor")),
        "style-factors")
    ways = facts.select("host", "path", F.explode("chain").alias("on"))
    factors = facts.select("host", F.col("path").alias("on"), "factor")
    way = staged(ways.join(factors, ["host", "on"]).groupBy("host", "path").agg(F.sum("factor").alias("way")), "style-ways")
    known = facts.join(way, ["host", "path"])
    sums = (known.select("host", F.explode("chain").alias("path"), (F.col("own") * F.exp("way")).alias("part"), "varies")
            .groupBy("host", "path").agg(F.sum("part").alias("sum"), F.max("varies").alias("varied")))
    return known.select("host", "path", "pages", "way").join(sums, ["host", "path"]).select(
        "host", "path", "pages", (F.col("sum") / F.exp("way")).alias("score"), "varied")


def noisy_paths(pages: DataFrame) -> DataFrame:
    """(host, paths): the nodes of low composite importance of every host's style tree in which no text varies."""
    stats = staged(node_statistics(with_copies(pages).mapInArrow(_count, COUNTS_DDL)), "style-tree")
    low = composite(stats).where((F.col("score") <= MAX_NOISE) & (F.col("pages") >= MIN_PAGES) & ~F.col("varied"))
    return low.groupBy("host").agg(F.collect_set("path").alias("paths"))


def main_text(page: Page, low: frozenset[int] | set[int]) -> str:
    """Kept blocks of a page, joined by an empty line."""
    for strict in (2, 1, 0):  # a page that would lose everything is judged by less
        text = _blocks(page, low if strict == 2 else frozenset(), strict)
        if text:
            return text
    return ""


def _blocks(page: Page, low, strict: int) -> str:
    n = len(page.tag)
    dropped, inside = [False] * n, [False] * n
    for sure in (1, 2):  # articles outside all furniture, else those in wrappers of doubtful name
        holds, marked = [False] * n, [False] * n
        for i in range(1, n):
            marked[i] = marked[page.parent[i]] or page.noise[i] >= sure
        for i in range(n - 1, 0, -1):
            if page.landmark[i] and not marked[i] or holds[i]:
                holds[page.parent[i]] = True
        roots = {i for i in range(1, n) if page.landmark[i] and not holds[i] and not marked[i]} if strict else set()
        if roots:
            break
    head = [False] * n
    for i in range(1, n):
        up = page.parent[i]
        inside[i] = inside[up] or i in roots
        head[i] = head[up] or inside[up] and page.tag[i] == "header"
        if dropped[up]:
            dropped[i] = True
        elif holds[i] or i in roots:
            dropped[i] = False
        elif page.noise[i]:
            named = page.tag[i] not in NOISE_TAGS and page.tag[i] != "header"
            dropped[i] = not (inside[i] and page.tag[i] == "header") and (strict > 0 or not named)
        elif page.path[i] in low and page.tag[i] not in INLINE and not (inside[i] and page.tag[i] in PROSE) and page.tag[i] not in (
                "html", "body"):
            dropped[i] = True
    out, now, parts = [], None, []

    def close():
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append(text)

    heading = [False] * n
    for i in range(1, n):
        heading[i] = heading[page.parent[i]] or page.tag[i] in HEADINGS
    for node, block, raw in page.runs:
        keep = not dropped[node] and (inside[node] or not roots) and (not head[node] or heading[node])
        if block != now:
            close()
            now, parts = block, []
        if keep:
            parts.append(raw)
    close()
    return "\n\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(parse(html), set(low or ())) for html, low in zip(batch["html"].to_pylist(), batch["paths"].to_pylist())]
        yield pa.RecordBatch.from_arrays([batch["page_id"].cast(pa.int64()), batch["url"], pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], schema=OUT)


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null and empty pages have an empty text, a null url counts as a host of its
    own; repeated rows get equal texts. A host with fewer than MIN_PAGES pages
    is judged by tags and names alone. Empty tables give no rows; other columns
    are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    low = staged(noisy_paths(rows), "noisy-paths")
    size = low.agg(F.coalesce(F.sum(F.size("paths")), F.lit(0))).first()[0]
    return rows.join(small(low, size), "host", "left").select("page_id", "url", "html", "paths").mapInArrow(_extract, OUT_DDL)
