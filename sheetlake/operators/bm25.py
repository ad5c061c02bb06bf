"""Keyword index and BM25 ranking as DataFrame jobs.

The index is three tables: ``postings(parent_id, id, dl, term, tf)``, ``terms(term, df)`` and the
one-row ``corpus(n_docs, avg_dl)``; a stored one has its postings in blocks (one term in chunks of similar
length) and a fourth table, ``blocks(term, block, n, max_tf, min_dl)``.  A lazy index has its postings spread by ``parent_id``, so the scores of
one document are added up where it lies.  A stored index has them in folders by a hash bucket of the
term: a search reads the buckets of its terms only, and adds scores up after a shuffle of the matches.

A search for the k best first scores the documents of each query's rarest terms.  The k-th of these
scores is a threshold.  Within each length class, terms whose largest contributions together stay below it can't bring a
document among the k best on their own: their blocks are left unread at first, and only documents that
can still reach the threshold with them look them up.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sheetlake.functions import fixed, tokens
from sheetlake.functions.text import parent_id
from sheetlake.operators.sizes import is_small, spread_texts
from sheetlake.operators.topn import first_n
from sheetlake.session import written

Tokenizer = Callable[[Column], Column]

# Scores are added up as whole numbers of this unit, so that equal documents
# get equal scores in whatever order their terms are added.
SCORE_UNIT = 1e-12


# Folders of a stored index; also the most values a search collects to pick its folders.
BUCKETS = 256


# Length classes per doubling of a chunk's length.
CLASSES = 4

# Per result wanted: postings of rare terms read for the threshold, and documents scored in full for it.
SEED_POSTINGS = 128
SEED_DOCUMENTS = 8
# The share of the threshold that blocks left for the end may reach together.  The less it is, the
# more blocks are read at once, and the fewer documents look up the others.
LATE = 0.65

# Matches of queries and postings that one task adds up.
TASK_MATCHES = 2_000_000
# One document in so many is scored first, for a score that the k best reach.
FIRST = 64


@dataclass(frozen=True)
class KeywordIndex:
    postings: DataFrame
    terms: DataFrame
    corpus: DataFrame
    buckets: int = 0
    blocks: DataFrame | None = None

    def save(self, path: str, buckets: int = BUCKETS) -> None:
        """Write the tables below a folder, postings in term buckets and sorted by term and block.

        Rows are rebalanced by bucket: a bucket with a hot term becomes several files.
        """
        placed = self.postings.withColumn("bucket", bucket_of(F.col("term"), buckets)).withColumn("block", length_class())
        placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block", "id").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{path}/postings"
        )
        self.postings.sparkSession.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(
            f"{path}/layout"
        )
        saved = self.postings.sparkSession.read.parquet(f"{path}/postings")
        blocks = saved.groupBy("term", "block").agg(
            F.count("*").alias("n"), F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl")
        )
        blocks.write.mode("overwrite").parquet(f"{path}/blocks")
        blocks = self.postings.sparkSession.read.parquet(f"{path}/blocks")
        blocks.groupBy("term").agg(F.sum("n").alias("df")).write.mode("overwrite").parquet(f"{path}/terms")
        self.corpus.write.mode("overwrite").parquet(f"{path}/corpus")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KeywordIndex:
        tables = [spark.read.parquet(f"{path}/{part}") for part in ("postings", "terms", "corpus")]
        return cls(*tables, spark.read.parquet(f"{path}/layout").head().buckets, spark.read.parquet(f"{path}/blocks"))

    def postings_of(self, terms: DataFrame) -> DataFrame:
        """Postings that can hold any of the terms: of a stored index the folders of their buckets."""
        if not self.buckets:
            return self.postings
        wanted = terms.select(bucket_of(F.col("term"), self.buckets).alias("b")).distinct().collect()
        return self.postings.filter(F.col("bucket").isin([r.b for r in wanted])).drop("bucket")


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def length_class() -> Column:
    """The class of a chunk's length: a block holds the postings of one term and class."""
    return F.floor(F.log2("dl") * CLASSES).cast("int")


def impact(tf: Column, dl: Column, avg_dl: Column, k1: float = fixed.BM25_K1, b: float = fixed.BM25_B) -> Column:
    """The part of a score that a term's count and the chunk's length decide; it grows with ``tf`` and falls with ``dl``."""
    return tf / (tf + k1 * (1 - b + b * (dl / avg_dl)))


def corpus_stats(chunks: DataFrame, tokenizer: Tokenizer = tokens.words) -> DataFrame:
    """Number of documents with any token and their average length."""
    lengths = chunks.select("id", F.size(tokenizer(F.col("contents"))).alias("dl")).filter(F.col("dl") > 0)
    # Counting ids instead of rows keeps the columns of the postings' shuffle,
    # so that shuffle is shared.
    return lengths.agg(
        F.count("id").alias("n_docs"), (F.sum("dl") / F.count("id")).alias("avg_dl")
    )


def _only(found: DataFrame, vocabulary: DataFrame | None, small: bool | None) -> DataFrame:
    """Rows whose term is in the vocabulary; all rows without one."""
    if vocabulary is None:
        return found
    few = is_small(vocabulary) if small is None else small
    wanted = vocabulary.select("term").distinct()
    return found.join(F.broadcast(wanted) if few else wanted, "term", "left_semi")


def make_postings(
    chunks: DataFrame,
    tokenizer: Tokenizer = tokens.words,
    vocabulary: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Term counts per chunk, for all terms or those of a vocabulary.

    The chunks must be spread by ``parent_id``, as ``spread`` does: then the
    counts here and the sums of the search need no further shuffle.  ``small``
    tells what is known about the vocabulary; it is counted if nothing is.
    """
    # The outer form keeps the optimiser from cutting every text twice, once
    # only to see whether it has any token.
    found = (
        chunks.select("parent_id", "id", tokenizer(F.col("contents")).alias("found"))
        .select("parent_id", "id", F.size("found").alias("dl"), F.explode_outer("found").alias("term"))
        .filter(F.col("term").isNotNull())
    )
    return _only(found, vocabulary, small).groupBy("parent_id", "id", "dl", "term").agg(F.count("*").alias("tf"))


def term_stats(postings: DataFrame) -> DataFrame:
    """In how many chunks each term occurs, from stored postings."""
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def document_frequencies(
    chunks: DataFrame,
    tokenizer: Tokenizer = tokens.words,
    vocabulary: DataFrame | None = None,
    small: bool | None = None,
) -> DataFrame:
    """The same from the chunks: distinct terms of a text need no grouping by text."""
    distinct = F.array_distinct(tokenizer(F.col("contents")))
    found = chunks.select("id", distinct.alias("found")).select(
        "id", F.explode_outer("found").alias("term")
    ).filter(F.col("term").isNotNull())
    # Ids are counted for the same reason as in corpus_stats.
    return _only(found, vocabulary, small).groupBy("term").agg(F.count("id").alias("df"))


def spread(chunks: DataFrame) -> DataFrame:
    """Chunks ``(id, contents)`` placed by id, each its own parent.

    Whole texts are shuffled once, before they are cut into tokens: they are
    much smaller than their postings.
    """
    return spread_texts(chunks.select("id", "contents"), "id", "contents").select(
        F.col("id").alias("parent_id"), "id", "contents"
    )


def build_index(
    chunks: DataFrame,
    tokenizer: Tokenizer = tokens.words,
    vocabulary: DataFrame | None = None,
    small: bool | None = None,
) -> KeywordIndex:
    """Index of chunks ``(id, contents)``; lazy until searched or saved.

    Chunks that carry a ``parent_id`` must already be spread by it.  With a
    vocabulary only its terms are kept: enough, and much less, when the index
    serves one batch of queries.
    """
    placed = chunks if "parent_id" in chunks.columns else spread(chunks)
    if vocabulary is not None and small is None:
        small = is_small(vocabulary)
    return KeywordIndex(
        make_postings(placed, tokenizer, vocabulary, small),
        document_frequencies(placed, tokenizer, vocabulary, small),
        corpus_stats(placed, tokenizer),
    )


def build_query_index(
    chunks: DataFrame, vocabulary: DataFrame, tokenizer: Tokenizer = tokens.words, small: bool | None = None
) -> KeywordIndex:
    """Index of chunks ``(parent_id, id, contents)`` for the terms of one batch of queries.

    Every text is cut into tokens once, where it is read.  What leaves its place is one row per
    chunk and known term, with all other tokens of the chunk counted in one more; these rows are
    written, and postings, frequencies and corpus figures all come from them.
    """
    small = is_small(vocabulary) if small is None else small
    wanted = vocabulary.select("term").distinct().withColumn("_known", F.lit(True))
    found = chunks.select("parent_id", "id", tokenizer(F.col("contents")).alias("found")).select(
        "parent_id", "id", F.size("found").alias("dl"), F.explode("found").alias("term")
    )
    marked = found.join(F.broadcast(wanted) if small else wanted, "term", "left").withColumn(
        "term", F.when(F.col("_known"), F.col("term"))
    )
    counted = written(marked.groupBy("parent_id", "id", "dl", "term").agg(F.count("*").alias("tf")), "query-terms")
    postings = counted.filter(F.col("term").isNotNull())
    stats = written(term_stats(postings), "term-stats")
    matches = vocabulary.join(stats, "term").agg(F.sum("df")).head()[0] or 0
    least = chunks.sparkSession.sparkContext.defaultParallelism
    lengths = counted.groupBy("id").agg(F.max("dl").alias("dl"))
    corpus = lengths.agg(F.count("*").alias("n_docs"), (F.sum("dl") / F.count("*")).alias("avg_dl"))
    # Placed by document again: the scores of a document are added up in one task, of bounded size.
    placed = postings.repartition(max(least, math.ceil(matches / TASK_MATCHES)), "parent_id")
    return KeywordIndex(placed, stats, corpus)


def query_terms(queries: DataFrame, tokenizer: Tokenizer = tokens.words) -> DataFrame:
    """``(query_id, term, qtf)`` of queries ``(query_id, text)``."""
    return (
        queries.select("query_id", F.explode(tokenizer(F.col("text"))).alias("term"))
        .groupBy("query_id", "term")
        .agg(F.count("*").alias("qtf"))
    )


def weigh_terms(terms: DataFrame, index: KeywordIndex) -> DataFrame:
    """Query terms with their idf; terms outside the corpus drop out."""
    n, df = index.corpus.select("n_docs").scalar(), F.col("df")
    idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
    return terms.join(index.terms, "term").select("query_id", "term", "qtf", idf.alias("idf"), "df")


def term_units(avg_dl: Column, k1: float, b: float) -> Column:
    """What one term adds to a score, in whole units."""
    tf, relative = F.col("tf"), F.col("dl") / avg_dl
    part = F.col("qtf") * F.col("idf") * tf / (tf + k1 * (1 - b + b * relative))
    return F.floor(part / SCORE_UNIT + 0.5)


def score_documents(
    index: KeywordIndex,
    terms: DataFrame,
    k1: float = fixed.BM25_K1,
    b: float = fixed.BM25_B,
    small: bool | None = None,
) -> DataFrame:
    """BM25 score of every document that shares a term with a query.

    Few query terms go to every task; many are joined by shuffling on the term,
    where adaptive execution splits the hot ones.
    """
    small = is_small(terms) if small is None else small
    weighted = weigh_terms(terms, index)
    units = term_units(index.corpus.select("avg_dl").scalar(), k1, b)
    return (
        index.postings_of(terms).join(F.broadcast(weighted) if small else weighted, "term")
        .groupBy("parent_id", "query_id", "id")
        .agg(F.sum(units).alias("units"))
        .select("query_id", "id", (F.col("units") * SCORE_UNIT).alias("score"), "units")
    )


@dataclass(frozen=True)
class Pruned:
    """A search for the k best.  All but ``units`` are written tables."""

    matched: DataFrame  # postings of the batch's terms
    plan: DataFrame  # (query_id, term, block, late, ...): which blocks are left for the end
    viable: DataFrame  # documents that are scored in full, with what the other blocks gave
    units: DataFrame  # (query_id, id, units)


def _summed(rows: DataFrame, units: Column) -> DataFrame:
    return rows.groupBy("query_id", "id").agg(F.sum(units).alias("units"))


def pruned_units(
    index: KeywordIndex,
    terms: DataFrame,
    k: int = fixed.TOP_K,
    k1: float = fixed.BM25_K1,
    b: float = fixed.BM25_B,
    small: bool | None = None,
) -> Pruned:
    """Units of every document that can be among the k best of a query; exact for those.

    Bounds have a unit of slack per term, as each term's share of a score is rounded.
    """
    small = is_small(terms) if small is None else small
    avg_dl = index.corpus.select("avg_dl").scalar()
    units = term_units(avg_dl, k1, b)
    known = terms.select("term").distinct()
    known = F.broadcast(known) if small else known
    matched = index.postings_of(terms).join(known, "term", "left_semi")
    matched = written(matched.select("term", "id", "dl", "tf", length_class().alias("block")), "matched")
    if index.blocks is None:
        most = F.max(impact(F.col("tf"), F.col("dl"), avg_dl, k1, b))
        blocks = matched.groupBy("term", "block").agg(most.alias("most"))
    else:
        most = impact(F.col("max_tf"), F.col("min_dl"), avg_dl, k1, b)
        blocks = index.blocks.join(known, "term", "left_semi").select("term", "block", most.alias("most"))
    weighted = written(weigh_terms(terms, index), "weighted")

    # The rarest terms of each query; a window here holds the terms of one query.
    met = F.sum("df").over(Window.partitionBy("query_id").orderBy("df", "term"))
    seeds = weighted.withColumn("met", met).where((F.col("met") <= SEED_POSTINGS * k) | (F.col("met") == F.col("df")))
    first = _summed(matched.join(F.broadcast(seeds) if small else seeds, "term"), units)
    best = [F.desc("units"), F.asc("id")]
    first = written(first_n(first, ["query_id"], best, SEED_DOCUMENTS * k).select("query_id", "id"), "seeds")
    finished = _summed(first.join(weighted, "query_id").join(matched, ["term", "id"]), units)
    least = first_n(finished, ["query_id"], best, k).where(F.col("rank") == k).select("query_id", F.col("units").alias("least"))

    # Blocks of a query and class by rising bound: those that together stay below the threshold come late.
    bound = F.col("qtf") * F.col("idf") * F.col("most") / SCORE_UNIT + 1
    bounded = weighted.join(blocks, "term").join(least, "query_id", "left").select(
        "query_id", "term", "block", "qtf", "idf", bound.alias("bound"), F.coalesce("least", F.lit(0)).alias("least")
    )
    one = Window.partitionBy("query_id", "block")
    late = F.sum("bound").over(one.orderBy("bound", "term")) < F.col("least") * LATE
    rest = F.sum(F.when(F.col("late"), F.col("bound")).otherwise(0.0)).over(one)
    plan = written(bounded.withColumn("late", late).withColumn("rest", rest), "plan")
    early = plan.where("not late").select("query_id", "term", "block", "qtf", "idf", "least", "rest")
    found = matched.join(F.broadcast(early) if small and is_small(early) else early, ["term", "block"])
    partial = found.groupBy("query_id", "id").agg(
        F.sum(units).alias("units"), F.max("block").alias("block"), F.max("least").alias("least"), F.max("rest").alias("rest")
    )
    viable = written(
        partial.where(F.col("units") + F.col("rest") >= F.col("least")).select("query_id", "id", "block", "units"), "viable"
    )
    others = plan.where("late").select("query_id", "term", "block", "qtf", "idf")
    more = _summed(viable.drop("units").join(others, ["query_id", "block"]).join(matched.drop("block"), ["term", "id"]), units)
    scored = viable.select("query_id", "id", "units").unionByName(more).groupBy("query_id", "id").agg(F.sum("units").alias("units"))
    return Pruned(matched, plan, viable, scored)


def reaching(scored: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Scores that can be among the k best: not below the k-th best of some of the documents.

    The others leave no task.  For very many queries all scores are kept.
    """
    if not is_small(queries.select("query_id")):
        return scored
    some = scored.where(F.pmod(F.xxhash64("id"), F.lit(FIRST)) == 0)
    kth = first_n(some, ["query_id"], [F.desc("units"), F.asc("id")], k).where(F.col("rank") == k)
    least = written(kth.select("query_id", F.col("units").alias("least")), "least")
    return scored.join(F.broadcast(least), "query_id", "left").where(F.col("units") >= F.coalesce("least", "units")).drop("least")


def bm25_search(
    index: KeywordIndex,
    queries: DataFrame,
    k: int = fixed.TOP_K,
    k1: float = fixed.BM25_K1,
    b: float = fixed.BM25_B,
    tokenizer: Tokenizer = tokens.words,
    small: bool | None = None,
) -> DataFrame:
    """The k best chunks per query; ties go to the lower id.

    ``id`` is the parent document of the chunk.  Several chunks of one parent
    may appear, as ranks are taken before the parent is looked up.  With a stored index, documents that can't be among the k best
    are not scored (``pruned_units``); an index made for one batch is
    scored whole, and only scores that can be among the k best leave their task (``reaching``).
    """
    terms = query_terms(queries, tokenizer)
    if index.blocks is None:
        scored = reaching(score_documents(index, terms, k1, b, small), queries, k)
    else:
        scored = pruned_units(index, written(terms, "terms"), k, k1, b, small).units.withColumn("score", F.col("units") * SCORE_UNIT)
    best = first_n(scored, ["query_id"], [F.desc("units"), F.asc("id")], k)
    return best.select(
        "query_id", "rank", parent_id(F.col("id")).alias("id"), F.col("id").alias("chunk_id"), "score"
    )
