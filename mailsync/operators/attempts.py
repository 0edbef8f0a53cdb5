"""Which landed pages of a chain count: the newest complete attempt, decided on links, before bodies.

A chain may have been asked for several times (a rerun after a failure loads it again from its start), and
the pages of two attempts can be cut differently, so pages of different attempts never add up. One rule
holds for tokens, records, plain scans and attachments:

* an attempt is complete when its last page (the one without a next page) and every page before it have
  landed; of a page landed twice in one attempt the later landing counts;
* of several complete attempts of a chain the one whose last page landed last counts (ties: the greater
  attempt id); its pages are the chain's pages;
* a chain without a complete attempt has all pages that are there, equal ones (number and body) once.

Plan: the links of the chains in question are parsed once and written without bodies. Pages are counted per
block of ``BLOCK`` page numbers, then per attempt and chain, each level where the one before has put its rows: the
links move twice, however the pages of a chain are spread. The decision is one row per chain (``decided``).
Bodies are joined with it last, and only if some landed page does not count; pages of runs that count nowhere
are left at the scan. Chains that the attempt alone does not decide (a page landed again within its attempt, or
several attempts and none complete) are decided page by page.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsync.operators.joins import join_null_safe, sized
from mailsync.session import written
from mailsync.sources.pages import with_links

BLOCK = 1_000     # page numbers of a chain that are counted in one task
MOST_RUNS = 1_000  # names of runs that a filter may hold


def with_attempt(pages: DataFrame) -> DataFrame:
    """``pages`` with ``attempt`` ('' where the run is not known) and ``at``, the landing time in microseconds."""
    for name, kind in (("attempt_id", "string"), ("fetched_at", "timestamp")):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(None).cast(kind))
    return (pages.withColumn("attempt", F.coalesce("attempt_id", F.lit("")))
            .withColumn("at", F.coalesce(F.unix_micros("fetched_at"), F.lit(0))))


def page_links(pages: DataFrame, chain: list[str], digest: bool = False) -> DataFrame:
    """One row per readable page: chain, attempt, number, landing time and links, with ``digest`` that of the body; no body."""
    p = with_links(with_attempt(pages).select(*chain, "attempt", "at", "page_no", "body")).filter("page_ok")
    more = [F.unhex(F.sha2("body", 256)).alias("digest")] if digest else []
    return p.select(*chain, "attempt", "at", "page_no", F.col("next_link").isNull().alias("ends"), "delta_link", *more)


def _attempts(links: DataFrame, chain: list[str]) -> DataFrame:
    """``chain, attempt, pages, rows, last_no, newest`` per attempt, all attempts of a chain in one partition.

    ``rows`` counts landed pages, ``pages`` different ones; ``newest`` is twice the landing time of the last
    page plus one (the flag that it ends), ``last_no`` its number, both null where no page ends."""
    place = [*chain, "block", "attempt", "page_no"]
    page = (links.withColumn("block", F.expr(f"page_no div {BLOCK}")).repartition(*chain, "block").groupBy(*place)
            .agg(F.max(F.col("at") * 2 + F.col("ends").cast("int")).alias("newest"), F.count(F.lit(1)).alias("rows")))
    ending = F.when(F.col("newest") % 2 != 0, F.col("page_no"))
    block = page.groupBy(*chain, "block", "attempt").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("rows").alias("rows"), F.max(ending).alias("last_no"), F.max_by("newest", ending).alias("newest"))
    return block.repartition(*chain).groupBy(*chain, "attempt").agg(
        F.sum("pages").alias("pages"), F.sum("rows").alias("rows"), F.max("last_no").alias("last_no"),
        F.max_by("newest", "last_no").alias("newest"))


def decided(links: DataFrame, chain: list[str]) -> DataFrame:
    """One row per chain: ``attempt, last_no, newest`` of the complete attempt that counts (null without one) and
    ``rows_in`` it, ``rows`` that landed, and ``whole``: whether the attempt alone says which pages count."""
    done = F.col("pages") == F.col("last_no") + 1
    best = F.max(F.when(done, F.struct("newest", "attempt", "last_no", F.col("rows").alias("rows_in"), "pages")))
    chains = _attempts(links, chain).groupBy(*chain).agg(
        best.alias("best"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("attempts"), F.sum("pages").alias("pages"))
    alone = (F.col("attempts") == 1) & (F.col("rows") == F.col("pages"))
    whole = F.when(F.col("best").isNull(), alone).otherwise(F.col("best.rows_in") == F.col("best.pages"))
    return chains.select(*chain, "best.attempt", "best.last_no", "best.newest", "best.rows_in", "rows", whole.alias("whole"))


def newest_attempts(links: DataFrame, chain: list[str]) -> DataFrame:
    """``chain, attempt, last_no, newest`` of the complete attempt that counts, one row per chain that has one."""
    return decided(links, chain).filter("attempt is not null").select(*chain, "attempt", "last_no", "newest")


def tokens_of_links(links: DataFrame, chain: list[str]) -> DataFrame:
    """``chain`` columns and ``new_delta`` of each chain with a complete attempt (null: it ends without a link)."""
    last = newest_attempts(links, chain).withColumnRenamed("last_no", "page_no").withColumn("at", F.expr("newest div 2")).drop("newest")
    ends = join_null_safe(links.filter("ends"), last, [*chain, "attempt", "page_no", "at"])
    return ends.groupBy(*chain).agg(F.max("delta_link").alias("new_delta"))


def counting_pages(links: DataFrame, chosen: DataFrame, chain: list[str]) -> DataFrame:
    """``chain, attempt, page_no, at, copies`` of the pages that count, of ``links`` with digests; ``chosen`` has ``chain, chosen``."""
    marked = join_null_safe(links, chosen, chain, "left")
    whole = (marked.filter("attempt = chosen").groupBy(*chain, "attempt", "page_no")
             .agg(F.max("at").alias("at")))
    page = [*chain, "page_no", "digest"]
    unfinished = marked.filter("chosen is null")
    latest = join_null_safe(unfinished, unfinished.groupBy(*page).agg(F.max("at").alias("latest")), page).filter("at = latest")
    there = latest.groupBy(*page, "at").agg(F.max("attempt").alias("attempt")).select(*chain, "attempt", "page_no", "at").distinct()
    place = [*chain, "attempt", "page_no", "at"]
    copies = links.groupBy(*place).agg(F.count(F.lit(1)).alias("copies"))
    return join_null_safe(copies, whole.select(place).union(there.select(place)), place)


class Counting(NamedTuple):
    """Which pages of some chains count: ``decided``, written, and its totals."""
    by_chain: DataFrame
    chain: list[str]
    all_count: bool         # each landed page counts, once
    all_whole: bool         # no chain is decided page by page
    runs: list[str] | None  # the attempts that count somewhere; null: too many to name, or some chain has none

    def of_runs(self, pages: DataFrame) -> DataFrame:
        """``pages`` with ``attempt`` and ``at``, without the runs that count nowhere."""
        p = with_attempt(pages)
        return p if self.runs is None else p.filter(F.col("attempt").isin(self.runs))

    def pages_of(self, pages: DataFrame) -> DataFrame:
        """``pages`` without the ones that do not count."""
        if self.all_count:
            return pages
        chain, own = self.chain, self.by_chain.select(*self.chain, F.col("attempt").alias("chosen"), "whole")
        p = self.of_runs(pages)
        kept = join_null_safe(p, own.filter("whole"), chain).filter("chosen is null or attempt = chosen").drop("chosen", "whole")
        if not self.all_whole:
            odd = own.filter("not whole").drop("whole")
            of_odd = join_null_safe(p, sized(odd.select(*chain)), chain, "left_semi")
            found = written(counting_pages(written(page_links(of_odd, chain, digest=True), "odd-links"), odd, chain), "odd-pages")
            one = join_null_safe(of_odd, found.drop("copies"), [*chain, "attempt", "page_no", "at"])
            most = found.agg(F.max("copies")).first()[0] or 0
            kept = kept.unionByName(one.distinct() if most > 1 else one)  # equal rows of one landing
        return kept.drop("attempt", "at")


def decide(links: DataFrame, chain: list[str]) -> Counting:
    """Decides all chains of ``links`` and writes the decision."""
    by_chain = written(decided(links, chain), "attempts")
    no = lambda c: F.count_if(~c)
    t = by_chain.agg(F.count(F.lit(1)).alias("n"), no(F.col("whole")).alias("odd"), F.count("attempt").alias("complete"),
                     no(F.col("whole") & (F.col("rows") == F.coalesce("rows_in", "rows"))).alias("some_do_not")).first()
    runs = None
    if t.some_do_not and t.complete == t.n:
        names = by_chain.select("attempt").distinct().limit(MOST_RUNS + 1).collect()  # bounded
        runs = [r.attempt for r in names] if len(names) <= MOST_RUNS else None
    return Counting(by_chain, chain, t.some_do_not == 0, t.odd == 0, runs)


def counting(pages: DataFrame, links: DataFrame, chain: list[str]) -> DataFrame:
    """``pages`` (those of ``links``, with their bodies) without the ones that do not count."""
    return decide(links, chain).pages_of(pages)


def links_of(pages: DataFrame, chain: list[str]) -> DataFrame:
    """``page_links`` parsed once and written."""
    return written(page_links(pages, chain), "links")


def counting_chains(pages: DataFrame, chain: list[str]) -> DataFrame:
    """The pages that count, of all chains in ``pages``."""
    return counting(pages, links_of(pages, chain), chain)
