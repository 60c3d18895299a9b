"""A whole search: query strings in, result pages out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsift.operators import highlight, match, queryterms, rank, results
from runsift.operators.match import QuerySize
from runsift.schemas import KEY, PAGE_SIZE
from runsift.session import BROADCAST_LIMIT_BYTES, written
from runsift.sources.index_tables import SearchIndex


@dataclass(frozen=True)
class Searcher:
    """Answers tables of queries (qid, q) from an index and the stored documents.

    Each query table is counted before anything derived from it is broadcast.
    """

    index: SearchIndex
    docs: DataFrame
    doc_parts: int | None = None
    broadcast_limit: int = BROADCAST_LIMIT_BYTES

    def is_small(self, queries: DataFrame) -> bool:
        return self._terms_small(QuerySize.of(queries))

    def _terms_small(self, size: QuerySize) -> bool:
        return size.small(len(self.index.default_keys), self.broadcast_limit)

    def _hits_small(self, size: QuerySize, last_page: int) -> bool:
        """Whether all hits of these pages, each with its query's terms, fit a broadcast."""
        per_hit = size.n_queries * 256 + size.n_bytes * 4
        return per_hit * last_page * PAGE_SIZE <= self.broadcast_limit

    def _analyse(self, queries: DataFrame, job_mode: bool, size: QuerySize) -> DataFrame:
        jobs = self.index.jobs if job_mode else None
        small = self._terms_small(size)
        return queryterms.analyse(queries, jobs, self.index.tokenizer, small, size.n_bytes)

    def _score(self, analysed: DataFrame, small: bool) -> DataFrame:
        terms = queryterms.clause_terms(analysed, self.index.default_keys)
        return match.match(terms, self.index, small)

    def analyse(self, queries: DataFrame, job_mode: bool = True) -> DataFrame:
        """Parsed queries: validity, job mode, clauses, show_console."""
        return self._analyse(queries, job_mode, QuerySize.of(queries))

    def scored(self, queries: DataFrame, job_mode: bool = True) -> DataFrame:
        """(qid, project, number, score) of every match."""
        size = QuerySize.of(queries)
        return self._score(self._analyse(queries, job_mode, size), self._terms_small(size))

    def ranked(self, queries: DataFrame, k: int = PAGE_SIZE, job_mode: bool = True) -> DataFrame:
        return rank.top_hits(self.scored(queries, job_mode), k)

    def pages(
        self, queries: DataFrame, last_page: int | None = 1, job_mode: bool = True
    ) -> DataFrame:
        """Result pages 1..last_page, or all of them: de-duplicated by name, then name order."""
        size = QuerySize.of(queries)
        small = self._terms_small(size)
        scored = self._score(self._analyse(queries, job_mode, size), small)
        if last_page is None:
            ranked = rank.rank_all(scored)
            tasks = rank.slices_of(ranked.count())
            # All hits of all queries: spread by their number for the names, then once by page for both windows.
            paged = rank.with_page(ranked).repartition(tasks, *KEY)
            named = results.with_names(paged, self.docs, False, self.doc_parts).repartition(tasks, "qid", "page")
        else:
            ranked, few = rank.top_hits(scored, last_page * PAGE_SIZE), self._hits_small(size, last_page)
            named = results.with_names(rank.with_page(ranked), self.docs, few, self.doc_parts)
        return results.order_page(results.dedupe_page(named))

    def fragments(self, queries: DataFrame, job_mode: bool = True, page: int = 1) -> DataFrame:
        """(qid, project, number, fragments) of one page's hits."""
        size = QuerySize.of(queries)
        small = self._terms_small(size)
        analysed = self._analyse(queries, job_mode, size)
        ranked = rank.top_hits(self._score(analysed, small), page * PAGE_SIZE)
        hits = written(ranked.where(F.col("rank") > (page - 1) * PAGE_SIZE).select("qid", *KEY), "hits")
        terms = highlight.highlight_terms(analysed)
        return highlight.best_fragments(
            hits, self.docs, terms, small and self._hits_small(size, 1), self.doc_parts
        )

    def search(
        self,
        queries: DataFrame,
        runs: DataFrame,
        root_url: str,
        last_page: int = 1,
        visible: DataFrame | None = None,
        filter_first: bool = False,
    ) -> DataFrame:
        """The result rows: page, place, name, URL and, if the query asks for it, console fragments.

        Hidden projects are dropped after paging, so pages may be short; ``filter_first`` drops
        them before.
        """
        size = QuerySize.of(queries)
        small = self._terms_small(size)
        few = small and self._hits_small(size, last_page)
        analysed = self._analyse(queries, True, size)
        scored = self._score(analysed, small)
        if visible is not None and filter_first:
            scored = results.visible_hits(scored, visible)
        ranked = rank.with_page(rank.top_hits(scored, last_page * PAGE_SIZE))
        # A bounded number of hits per query: written once, then named, located and highlighted.
        hits = written(ranked, "hits")
        named = results.with_names(hits, self.docs, few, self.doc_parts)
        located = results.with_urls(
            results.order_page(results.dedupe_page(named)), runs, root_url, few
        )
        if visible is not None and not filter_first:
            located = results.visible_hits(located, visible)
        # Consoles are cut only for hits that are shown.
        located = written(located, "located")
        flags = analysed.select("qid", "show_console")
        flags = F.broadcast(flags) if small else flags
        fragments = highlight.best_fragments(
            located.select("qid", *KEY).join(flags, "qid").where("show_console"),
            self.docs,
            highlight.highlight_terms(analysed),
            few,
            self.doc_parts,
        )
        return (
            located.join(flags, "qid")
            .join(fragments, ["qid", *KEY], "left")
            .withColumn(
                "fragments",
                F.when(F.col("show_console"), highlight.display_fragments(F.col("fragments"))),
            )
        )
