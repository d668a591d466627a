"""URL filter: rules, and trust spread over the host graph.

Rules decide where they fit. Elsewhere the host decides: hosts of allowed pages
spread trust along links, hosts that a host-wide rule blocks spread distrust
against links (who links to a blocked host is suspect), both by personalised
PageRank over host edges, and a host whose distrust outweighs its trust and a
floor is blocked. A host that neither reaches is allowed. Hosts are those of
pages and those that pages link to, with or without pages of their own. Each
seed spreads a mass of 1, so a host's masses, and its verdict, depend on the
links that lead to it alone and not on the rest of the graph or its size.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import pick, stored, stored_at
from gridmix.sources.sinks import remove

#: (verdict, rule): a host and the path that a url's path has to start with.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING = 0.85
#: Distrust, in shares of the mass that one seed spreads, from which a host can be blocked.
FLOOR = 0.01
#: Mass that further rounds could still move, in shares of the floor, below which spreading ends.
REST = 0.01
#: Every so many rounds it is summed up what they moved.
LOOK = 4

#: Target of a link with a host; without a scheme it has the page's own.
LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without a ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without a ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: str, host: Column, path: Column) -> Column:
    name, _, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)


def judged(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    longest = sorted(rules, key=lambda r: -len(r[1]))
    name = F.coalesce(*[F.when(fits(r, host, path), F.lit(r)) for _, r in longest], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(fits(r, host, path), F.lit(v)) for v, r in longest], F.lit(None).cast("string"))
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts; ``pages`` has host and html."""
    links = pages.select(F.col("host").alias("src"), F.explode(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("url"))
    # Any scheme will do: only the host counts.
    target = F.when(F.col("url").startswith("//"), F.concat(F.lit("http:"), F.col("url"))).otherwise(F.col("url"))
    return links.select("src", host_of(target).alias("dst")).where("src <> dst and src <> '' and dst <> ''").groupBy(
        "src", "dst").agg(F.count("*").alias("links"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None,
           rest: float = 1e-9) -> DataFrame:
    """(host, mass): personalised PageRank along (src, dst, links) from seeds (host, share).

    Mass of hosts without links is not passed on, and without any links each
    seed keeps what the formula gives it. Each round is one join and one sum
    with partial sums, written to the shared folder; the round before the last
    one is removed from there. Without a number of rounds it ends when all that
    later rounds can move is at most ``rest``: a round moves at most ``damping``
    times what the one before it moved.
    """
    spark = edges.sparkSession
    out = edges.groupBy("src").agg(F.sum("links").alias("all_links"))
    steps = stored(edges.join(out, "src").select("src", "dst", (F.col("links") / F.col("all_links")).alias("part")), "steps")
    now = seeds.select("host", F.col("share").alias("mass"))
    later = damping / (1 - damping)
    if rounds is None:
        whole = seeds.agg(F.sum("share")).first()[0] or 0.0
        most = max(math.ceil(math.log(rest / (2 * later * max(whole, rest))) / math.log(damping)), 1)
    else:
        most = rounds
    paths: list[str] = []
    for turn in range(1, most + 1):
        none = F.lit(0.0)
        moved = steps.join(now, steps["src"] == now["host"]).select(
            F.col("dst").alias("host"), (F.col("mass") * F.col("part") * damping).alias("mass"), none.alias("was"))
        given = seeds.select("host", (F.col("share") * (1 - damping)).alias("mass"), none.alias("was"))
        both = moved.union(given).union(now.select("host", none.alias("mass"), F.col("mass").alias("was")))
        sums, path = stored_at(both.groupBy("host").agg(F.sum("mass").alias("mass"), F.sum("was").alias("was")), "mass")
        now = sums.select("host", "mass")
        paths.append(path)
        if len(paths) > 2:
            remove(spark, paths.pop(0))
        if rounds is None and (turn <= 2 or turn % LOOK == 0) and (
                sums.agg(F.sum(F.abs(F.col("mass") - F.col("was")))).first()[0] or 0.0) * later <= rest:
            break
    return now


def units(hosts: DataFrame) -> DataFrame:
    """Seeds of a mass of 1 each."""
    return hosts.select("host", F.lit(1.0).alias("share"))


def verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, floor: float = FLOOR, id_col: str = "page_id",
             url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every row.

    A null url, or one without ://, has an empty host and path, fits no rule
    and is allowed. A null or empty html has no links; the whole of a long one is
    read. Equal rows give equal rows, though each of them counts for the links of
    its host. Extra columns are left out, an empty table gives no rows.
    """
    url = F.col("url")
    source = pick(pages, id_col, url_col, html_col).select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html")).withColumns({"host": host_of(url), "path": path_of(url)})
    rule, verdict = judged(rules, F.col("host"), F.col("path"))
    marked = source.withColumns({"rule": rule, "ruled": verdict})
    edges = stored(host_edges(marked), "host-edges")
    own = marked.where("host <> ''").select("host", F.coalesce(F.col("ruled") == "allow", F.lit(False)).alias("trusted"))
    linked = [edges.select(F.col(end).alias("host"), F.lit(False).alias("trusted")) for end in ("src", "dst")]
    hosts = stored(reduce(DataFrame.union, linked, own).groupBy("host").agg(F.max("trusted").alias("trusted")), "hosts")
    wide = [F.lit(False)] + [fits(r, F.col("host"), F.lit("/")) for v, r in rules if v == "block" and r.endswith("/") and r.count("/") == 1]
    blocked = hosts.where(reduce(lambda x, y: x | y, wide))
    judged_pages = marked.select("page_id", "host", "path", "rule", "ruled")
    rest = REST * (floor or FLOOR)
    trust = spread(edges, units(hosts.where("trusted").select("host")), rest=rest)
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    distrust = spread(against, units(blocked.select("host")), rest=rest)
    known = hosts.select("host").join(trust.withColumnRenamed("mass", "trust"), "host", "left").join(
        distrust.withColumnRenamed("mass", "distrust"), "host", "left").fillna(0.0)
    bad = (F.col("distrust") >= floor) & (F.col("distrust") > F.col("trust"))
    return judged_pages.join(known, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(bad, F.lit("block")), F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
