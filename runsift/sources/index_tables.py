"""The stored search tables: postings and their statistics.

Postings are partitioned by a hash of the term, so a search reads only the term partitions of its
words, and bucketed by document, so everything computed per document needs no shuffle. In each file
they are sorted by term in small pages whose first and last term Parquet keeps: the sparse directory
by which a scan for listed words skips the pages that hold none of them. Positions stand beside each
count, delta-coded by the file format; scans that do not ask for them do not read them.
"""

from __future__ import annotations

import functools
import hashlib
import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runsift.fields import FieldRegistry
from runsift.functions.text import Tokenizer, tokens
from runsift.operators import postings as P
from runsift.schemas import KEY
from runsift.session import fits_broadcast, source_bytes, written


# Stored input bytes that a task of a build tokenises, or postings that a task of a merge writes; a task sorts
# some thirty times these bytes.
TASK_BYTES = 8 * 1024 * 1024
TASK_ROWS = 1_000_000
# Stored input bytes by which parts and buckets are counted.
FILE_BYTES = 32 * 1024 * 1024
# So many listed words are looked up in the directory of pages; Parquet compares them one by one.
DIRECTORY_WORDS = 400
# Rows of a page, bytes of a row group; positions as differences instead of a dictionary.
_LAYOUT = {
    "parquet.page.row.count.limit": "4000",
    "parquet.block.size": str(32 * 1024 * 1024),
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary#pos.list.element": "false",
}
_POSTINGS = (
    "project string, number bigint, field string, term string, tf bigint, dl bigint, pos array<bigint>, tp int"
)
# With more term parts than this a build brings each part together before it writes.
_PARTS_A_TASK = 64
# Terms whose grams stand in one file at most, and fewer of them where cores would be idle otherwise.
_TERMS_A_FILE = 150_000
_TERMS_A_SMALL_FILE = 20_000
# An update that replaces a document in so many or more reads what goes from the index instead of tokenising it again.
_READ_SHARE = 3
# Length of the keys under which the terms of the vocabulary are found by their parts.
GRAM = 3
BEGIN, END = "\x02", "\x03"


def grams(term: Column) -> Column:
    """The distinct substrings of GRAM characters of a framed term: one begins at each of its characters."""
    text = framed(term)
    starts = F.sequence(F.lit(1), F.length(text) - GRAM + 1)
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(GRAM))))


def framed(term: Column) -> Column:
    """A term between marks that no term holds, so that its beginning and end have grams of their own."""
    return F.concat(F.lit(BEGIN), term, F.lit(END * (GRAM - 1)))


def holding(rows: DataFrame, column: str, words: list[str] | None) -> DataFrame:
    """Rows with one of the listed words; without a list, all."""
    if words is None:
        return rows
    return rows.where(F.col(column).isin(*words) if words else F.lit(False))


@functools.lru_cache(maxsize=8)
def _reading_session(spark: SparkSession, app_id: str) -> SparkSession:
    """A session of the same application whose scans hand listed words down to Parquet, up to DIRECTORY_WORDS.

    The setting belongs to the session that opens a table; the caller's session keeps its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(DIRECTORY_WORDS))
    return own


def term_part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


@dataclass(frozen=True)
class SearchIndex:
    """A built index, or an update on top of another one.

    ``jobs`` lists each project that has documents, with its name tokens. An update holds the
    postings of changed documents, the keys it takes out of its base, and signed counts; so every
    statistic of the whole is a sum, and a search sees exactly the documents of that moment.
    """

    spark: SparkSession
    path: str
    term_parts: int
    doc_buckets: int
    default_keys: tuple[str, ...]
    all_keys: tuple[str, ...]
    exact_keys: tuple[str, ...]
    tokenizer: Tokenizer = tokens
    base: SearchIndex | None = None
    piece_keys: tuple[str, ...] = ()
    has_stop_words: bool = False

    @classmethod
    def build(
        cls,
        docs: DataFrame,
        path: str,
        registry: FieldRegistry | None = None,
        term_parts: int | None = None,
        doc_buckets: int | None = None,
        tokenizer: Tokenizer = tokens,
        stop_words: DataFrame | None = None,
        pieces: DataFrame | None = None,
    ) -> SearchIndex:
        """Index documents. ``pieces`` (project, number, field, text) adds text of further fields
        that comes in many rows per run and is not part of ``docs``."""
        registry = registry or FieldRegistry()
        spark = docs.sparkSession
        # Files in all; parts and buckets grow alike, so that a word's files are their square root.
        files = source_bytes(docs) // FILE_BYTES
        if doc_buckets is None:
            most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
            doc_buckets = min(most, max(8, math.isqrt(files)))
        index = cls(
            spark,
            path,
            term_parts or max(4, math.isqrt(files)),
            doc_buckets,
            tuple(k for k in registry.default_keys if pieces is not None or k in docs.columns),
            tuple(k for k in registry.all_keys if k in docs.columns),
            tuple(sorted(registry.exact_keys)),
            tokenizer,
            None,
            () if pieces is None else tuple(k for k in registry.all_keys if k not in docs.columns),
            stop_words is not None,
        )
        if stop_words is not None:
            stop_words.select("term").distinct().write.parquet(f"{path}/stop_words")
        rows = index._postings_of(docs)
        if pieces is not None:
            extra = P.piece_postings(pieces, index.exact_keys, tokenizer)
            rows = rows.unionByName(extra.repartition(index._tasks(source_bytes(pieces) / TASK_BYTES), *KEY))
        index._store_postings(rows)
        own = index._own_postings
        index._store_counts(own, None, index._job_counts(docs))
        index._store_facts()
        return index

    def update(
        self, old: DataFrame, new: DataFrame, path: str, pieces: DataFrame | None = None
    ) -> SearchIndex:
        """An index on top of this one in which the documents ``old`` are replaced by ``new``.

        ``old`` are the stored documents that changed or were deleted, as they were indexed. Only
        changed documents are tokenised; nothing of this index is rewritten. ``pieces`` is the text
        that comes in many rows, for the runs in ``new``; without it those runs keep what they have.
        The index's stop words and tokenizer hold for updates too.
        """
        updated = self._like(path, self)
        old_keys = written(old.select(*KEY).distinct(), "old-keys")
        rows, gone = updated._postings_of(new), self._gone(old, old_keys)
        if self.piece_keys:
            if pieces is None:
                stored = self._stored_of(old_keys).where(F.col("field").isin(*self.piece_keys)).drop("tp")
                kept = stored.join(new.select(*KEY).distinct(), KEY, "left_semi")
                tasks = self._tasks(kept.count() / TASK_ROWS)
            else:
                kept = P.piece_postings(pieces, self.exact_keys, self.tokenizer)
                tasks = self._tasks(source_bytes(pieces) / TASK_BYTES)
            # The postings of the documents stand spread by key already.
            rows = rows.unionByName(kept.repartition(tasks, *KEY))
        updated._store_postings(rows)
        old_keys.write.parquet(f"{path}/removed")
        jobs = self._job_counts(new).unionByName(
            self._job_counts(old).withColumn("n_docs", -F.col("n_docs"))
        )
        updated._store_counts(updated._own_postings, gone, jobs)
        updated._store_facts()
        return updated

    def update_levelled(
        self, old: DataFrame, new: DataFrame, path: str, pieces: DataFrame | None = None
    ) -> SearchIndex:
        """As `update`, and layers of like size are merged, so that there are no more than about the
        logarithm of the number of updates above the first index. Layers that are merged are written once,
        to ``path`` with a word behind it."""
        top = self.update(old, new, path, pieces)
        lowest, n_layers, rows = top, 1, top.layer_rows()
        while lowest.base.base is not None and 2 * rows >= (below := lowest.base.layer_rows()):
            lowest, n_layers, rows = lowest.base, n_layers + 1, rows + below
        return top if n_layers == 1 else top.merged(f"{path}-merged", n_layers)

    def merged(self, path: str, n_layers: int = 2) -> SearchIndex:
        """This layer and those under it, so many in all, as one layer; nothing is tokenised, nothing below is read."""
        layers = [self]
        while len(layers) < n_layers and layers[-1].base is not None:
            layers.append(layers[-1].base)
        if len(layers) < n_layers or layers[-1].base is None:
            raise ValueError("only a layer above another layer can be merged with it")
        layer = self._like(path, layers[-1].base)
        gone = [above._beside_postings(above._removed())[0] for above in layers[:-1]]
        kept = [
            reduce(lambda rows, keys: rows.join(keys, KEY, "left_anti"), gone[:i], own._own_postings)
            for i, own in enumerate(layers)
        ]
        rows = reduce(DataFrame.unionByName, kept).drop("tp")
        n_rows = sum(own._own_postings.count() for own in layers)
        layer._store_postings(rows.repartition(self._tasks(n_rows / TASK_ROWS), *KEY))
        removed = reduce(DataFrame.unionByName, [own._removed() for own in layers])
        removed.distinct().write.parquet(f"{path}/removed")
        layer._store_summed(*layers)
        layer._store_facts()
        return layer

    def layer_rows(self) -> int:
        """Postings and removed keys that this layer holds itself."""
        removed = 0 if self.base is None else self._removed().count()
        return self._own_postings.count() + removed

    def n_layers(self) -> int:
        return 1 if self.base is None else 1 + self.base.n_layers()

    def compact(self, path: str) -> SearchIndex:
        """One plain index with the content of this one and its bases; nothing is tokenised."""
        whole = self._like(path, None)
        if self.has_stop_words:
            self._stop_words().write.parquet(f"{path}/stop_words")
        rows = self.postings.drop("tp")
        whole._store_postings(rows.repartition(self._tasks(rows.count() / TASK_ROWS), *KEY))
        whole._store_counts(whole._own_postings, None, self._job_rows())
        whole._store_facts()
        return whole

    def _like(self, path: str, base: SearchIndex | None) -> SearchIndex:
        """An index elsewhere with the settings of this one."""
        return replace(self, path=path, base=base)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SearchIndex:
        """A stored index, with the tokenizer it was built with."""
        facts = spark.read.parquet(f"{path}/facts").first()
        index = cls(
            spark,
            path,
            facts.term_parts,
            facts.doc_buckets,
            tuple(facts.default_keys),
            tuple(facts.all_keys),
            tuple(facts.exact_keys),
            Tokenizer(facts.token_pattern, facts.line_safe),
            cls.open(spark, facts.base) if facts.base else None,
            tuple(facts.piece_keys),
            facts.has_stop_words,
        )
        if not spark.catalog.tableExists(index._table):
            spark.sql(
                f"CREATE TABLE {index._table} (project STRING, number BIGINT, field STRING,"
                " term STRING, tf BIGINT, dl BIGINT, pos ARRAY<BIGINT>, tp INT) USING parquet"
                " PARTITIONED BY (tp) CLUSTERED BY (project, number) SORTED BY (term, field)"
                f" INTO {facts.doc_buckets} BUCKETS LOCATION '{path}/postings'"
            )
            spark.sql(f"ALTER TABLE {index._table} RECOVER PARTITIONS")
        return index

    # -- what searches read ---------------------------------------------------------------------

    def posting_parts(self, bucketed: bool = True) -> list[DataFrame]:
        """The postings of this index and its bases, each (project, number, field, term, tf, dl, pos, tp).

        Searches join each part by itself, so that each keeps its partitions and buckets. Who spreads the
        postings anyway reads them without buckets, in as many tasks as their files take; buckets remain
        where removed keys are too many for a broadcast.
        """
        own = self._own_postings if bucketed else self._read("postings", _POSTINGS)
        if self.base is None:
            return [own]
        removed, small = self._beside_postings(self._removed())
        below = self.base.posting_parts(bucketed or not small)
        return [*[p.join(removed, KEY, "left_anti") for p in below], own]

    def term_stat_parts(self) -> list[DataFrame]:
        """(field, term, df, tp) parts; df is signed, the sum over the parts is the document count."""
        own = self._own_term_stats()
        return [own] if self.base is None else [*self.base.term_stat_parts(), own]

    @property
    def postings(self) -> DataFrame:
        """(project, number, field, term, tf, dl, pos, tp)"""
        return reduce(DataFrame.unionByName, self.posting_parts())

    @property
    def term_stats(self) -> DataFrame:
        """(tp, field, term, df)"""
        parts = self.term_stat_parts()
        if len(parts) == 1:
            return parts[0].select("tp", "field", "term", "df")
        both = reduce(DataFrame.unionByName, parts)
        return both.groupBy("tp", "field", "term").agg(F.sum("df").alias("df")).where("df > 0")

    @property
    def field_stats(self) -> DataFrame:
        """(field, n_docs, avg_len): one row per field."""
        return self._length_sums().where("n_docs > 0").select(
            "field", "n_docs", (F.col("sum_len") / F.col("n_docs")).alias("avg_len")
        )

    @property
    def jobs(self) -> DataFrame:
        """(project, terms)"""
        return self._job_rows().select("project", "terms")

    # -- stored parts -----------------------------------------------------------------------------

    def _beside_postings(self, keys: DataFrame) -> tuple[DataFrame, bool]:
        """Stored keys (project, number) for a join with postings, and whether they are broadcast.

        Too many for that, they are spread like the buckets and held as a hash table for each, so that bucketed
        postings are neither shuffled nor sorted.
        """
        if fits_broadcast(keys):
            return F.broadcast(keys), True
        return keys.repartition(self.doc_buckets, *KEY).hint("shuffle_hash"), False

    def _stored_of(self, keys: DataFrame) -> DataFrame:
        """The postings of the documents with these stored keys."""
        beside, _ = self._beside_postings(keys)
        return reduce(DataFrame.unionByName, [p.join(beside, KEY, "left_semi") for p in self.posting_parts()])

    def _gone(self, old: DataFrame, old_keys: DataFrame) -> DataFrame:
        """(project, number, field, term, dl) of documents as they were indexed, with their text in pieces.

        Few are tokenised again. A large part of the index is read where it stands, unless a key is null, which
        no join finds.
        """
        counted = [*KEY, "field", "term", "dl"]
        unkeyed = old_keys.where(reduce(Column.__or__, [F.col(k).isNull() for k in KEY]))
        n_docs = self._job_rows().agg(F.sum("n_docs")).first()[0] or 0
        if _READ_SHARE * old_keys.count() >= n_docs and unkeyed.isEmpty():
            return self._stored_of(old_keys).select(*counted)
        gone = self._postings_of(old, places=False).select(*counted)
        if self.piece_keys:
            stored = self._stored_of(old_keys).where(F.col("field").isin(*self.piece_keys))
            gone = gone.unionByName(stored.select(*counted))
        # Counted twice, tokenised once.
        return written(gone, "gone")

    @property
    def _table(self) -> str:
        return "runsift_postings_" + hashlib.md5(self.path.encode()).hexdigest()[:16]

    @property
    def _own_postings(self) -> DataFrame:
        return self._reader.table(self._table)

    @property
    def _reader(self) -> SparkSession:
        return _reading_session(self.spark, self.spark.sparkContext.applicationId)

    def _read(self, part: str, schema: str) -> DataFrame:
        return self._reader.read.schema(schema).parquet(f"{self.path}/{part}")

    def _removed(self) -> DataFrame:
        return self._read("removed", "project string, number bigint")

    def _own_term_stats(self) -> DataFrame:
        return self._read("term_stats", "field string, term string, df bigint, tp int")

    def _own_length_sums(self) -> DataFrame:
        return self._read("field_stats", "field string, n_docs bigint, sum_len bigint")

    def _own_job_rows(self) -> DataFrame:
        return self._read("jobs", "project string, terms array<string>, n_docs bigint")

    def _length_sums(self) -> DataFrame:
        own = self._own_length_sums()
        if self.base is None:
            return own
        both = self.base._length_sums().unionByName(own)
        return both.groupBy("field").agg(
            F.sum("n_docs").alias("n_docs"), F.sum("sum_len").alias("sum_len")
        )

    def _job_rows(self) -> DataFrame:
        own = self._own_job_rows()
        if self.base is None:
            return own
        both = self.base._job_rows().unionByName(own)
        return (
            both.groupBy("project")
            .agg(F.first("terms").alias("terms"), F.sum("n_docs").alias("n_docs"))
            .where("n_docs > 0")
        )

    def _job_counts(self, docs: DataFrame) -> DataFrame:
        counts = docs.groupBy("project").agg(F.count(F.lit(1)).alias("n_docs"))
        return counts.select(
            "project", F.array_distinct(self.tokenizer(F.col("project"))).alias("terms"), "n_docs"
        )

    def _stop_words(self) -> DataFrame | None:
        """(term), as stored with the first index of this line."""
        if not self.has_stop_words:
            return None
        return self.base._stop_words() if self.base else self._read("stop_words", "term string")

    def _postings_of(self, docs: DataFrame, places: bool = True) -> DataFrame:
        """Documents are tokenised in tasks of TASK_BYTES."""
        tasks = self._tasks(source_bytes(docs) / TASK_BYTES)
        part = (lambda term: term_part(term, self.term_parts)) if places else None
        return P.postings(docs, self.all_keys, self.exact_keys, self.tokenizer, self._stop_words(), tasks, places, part)

    def _tasks(self, wanted: float) -> int:
        """At least so many tasks, a multiple of the buckets, so that a task has one bucket."""
        return self.doc_buckets * max(1, math.ceil(wanted / self.doc_buckets))

    def _store_postings(self, rows: DataFrame) -> None:
        placed = rows.withColumn("tp", term_part(F.col("term"), self.term_parts))
        if self.term_parts > _PARTS_A_TASK:
            # Many parts: a part's rows of one bucket meet in one task and become one file.
            bucket = F.pmod(F.hash(*KEY), F.lit(self.doc_buckets))
            placed = placed.repartition(self.term_parts * self.doc_buckets, "tp", bucket)
        (
            placed.select(*KEY, "field", "term", "tf", "dl", "pos", "tp")
            .write.partitionBy("tp")
            .bucketBy(self.doc_buckets, *KEY)
            .sortBy("term", "field")
            .options(**_LAYOUT)
            .option("path", f"{self.path}/postings")
            .saveAsTable(self._table)
        )

    def _store_counts(self, plus: DataFrame, minus: DataFrame | None, jobs: DataFrame) -> None:
        """Term and field statistics of some postings, less those of others, and job counts."""
        rows = plus.select(*KEY, "field", "term", "dl", F.lit(1).alias("sign"))
        if minus is not None:
            rows = rows.unionByName(minus.withColumn("sign", F.lit(-1)))
        self._store_term_stats(rows.groupBy("field", "term").agg(F.sum("sign").cast("bigint").alias("df")))
        (
            rows.groupBy(*KEY, "field", "sign")
            .agg(F.max("dl").alias("dl"))
            .groupBy("field")
            .agg(
                F.sum("sign").cast("bigint").alias("n_docs"),
                F.sum(F.col("sign") * F.col("dl")).alias("sum_len"),
            )
            .write.parquet(f"{self.path}/field_stats")
        )
        jobs.write.parquet(f"{self.path}/jobs")

    def _store_summed(self, *layers: SearchIndex) -> None:
        """Counts of several layers as one's: all of them are signed sums."""
        stats = reduce(DataFrame.unionByName, [layer._own_term_stats() for layer in layers])
        self._store_term_stats(stats.groupBy("field", "term").agg(F.sum("df").alias("df")))
        sums = reduce(DataFrame.unionByName, [layer._own_length_sums() for layer in layers])
        sums = sums.groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("sum_len").alias("sum_len"))
        sums.write.parquet(f"{self.path}/field_stats")
        jobs = reduce(DataFrame.unionByName, [layer._own_job_rows() for layer in layers])
        jobs.groupBy("project").agg(
            F.first("terms").alias("terms"), F.sum("n_docs").alias("n_docs")
        ).write.parquet(f"{self.path}/jobs")

    def _store_term_stats(self, counts: DataFrame) -> None:
        """(field, term, df), df signed; and the grams of the terms. A term's counts were summed in one task."""
        placed = counts.where("df != 0").withColumn("tp", term_part(F.col("term"), self.term_parts))
        if self.term_parts > _PARTS_A_TASK:
            placed = placed.repartition("tp", F.pmod(F.xxhash64("field", "term"), F.lit(16)))
        (
            placed.sortWithinPartitions("tp", "term", "field")
            .write.partitionBy("tp")
            .options(**_LAYOUT)
            .parquet(f"{self.path}/term_stats")
        )
        self._store_grams()

    def _store_grams(self) -> None:
        """(gram, term, field): the vocabulary under its parts, sorted so that a gram's terms stand in few pages of a file.

        An update stores those of its own terms; who reads adds up the layers and asks the statistics
        whether a term still has documents.
        """
        terms = self._own_term_stats().where("df > 0").select("term", "field")
        n_terms, cores = terms.count(), self.spark.sparkContext.defaultParallelism
        files = max(min(cores, math.ceil(n_terms / _TERMS_A_SMALL_FILE)), math.ceil(n_terms / _TERMS_A_FILE), 1)
        # Only the terms are spread, some to each file, so a gram of very many terms stands in all of them.
        spread = terms.repartition(files, "term")
        (
            spread.select(F.explode(grams(F.col("term"))).alias("gram"), "term", "field")
            .sortWithinPartitions("gram", "term")
            .write.options(**_LAYOUT)
            .parquet(f"{self.path}/grams")
        )

    @property
    def grams(self) -> DataFrame:
        """(gram, term, field) of this index and its bases; a term may stand in several."""
        own = self._read("grams", "gram string, term string, field string")
        return own if self.base is None else self.base.grams.unionByName(own)

    def _store_facts(self) -> None:
        def listed(keys: tuple[str, ...]) -> Column:
            return F.array(*[F.lit(k) for k in keys]).cast("array<string>")

        self.spark.range(1, numPartitions=1).select(
            F.lit(self.term_parts).alias("term_parts"),
            F.lit(self.doc_buckets).alias("doc_buckets"),
            listed(self.default_keys).alias("default_keys"),
            listed(self.all_keys).alias("all_keys"),
            listed(self.exact_keys).alias("exact_keys"),
            listed(self.piece_keys).alias("piece_keys"),
            F.lit(self.has_stop_words).alias("has_stop_words"),
            F.lit(self.tokenizer.pattern).alias("token_pattern"),
            F.lit(self.tokenizer.line_safe).alias("line_safe"),
            F.lit(self.base.path if self.base else None).cast("string").alias("base"),
        ).write.parquet(f"{self.path}/facts")
