r"""Operator 11: how far the sources of a language differ in their words.

Terms are runs of A-Z, a-z and code points over 127, A-Z lower-cased. A language keeps the terms
of at least ``min_docs`` of its documents. Tasks count the terms of whole texts by language and source; one
shuffle by language and term then brings a term's counts together, which are pivoted into
one array indexed by the language's sources in order. From those wide vectors, built-in higher-order functions emit each
pair of sources' contribution, which is summed before it is shuffled, so what is moved grows with the pairs and the tasks, not with
the terms.

A term's smoothed share in a source is ``1 + floor(10^9 * (count + 5) / (N + 5 V))``, N being the sum of its counts over
the V kept terms; all sums are in decimals and long integers, exact.

Cases: null text, language and source are empty strings; a (language, source) without any term is a source like others; a language
without kept terms gives values of zero; rows that repeat count each; very long texts are counted in pieces of their
own words, with at most ``FLUSH`` terms held; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkwharf.llm.common import staged

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: Terms that a task holds, counted in each text anew, before it sends them on.
FLUSH = 1 << 19
#: Sources of all languages together up to which their names and sums are broadcast; beyond, they are joined by language.
MAX_SOURCES = 1 << 17


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, d``: occurrences and documents, in part sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in held.items():
                terms = pa.array(n.keys(), pa.binary()).cast(pa.string())
                same = [pa.array([x], pa.string()).take(pa.nulls(len(n), pa.int32()).fill_null(0)) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*same, terms, pa.array(n.values(), pa.int64()), pa.array([d[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "d"])
            held.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                words = TERM.findall(text.as_py().lower())  # of bytes: only A-Z change
                n, d = held.get((lang, source)) or held.setdefault((lang, source), (Counter(), Counter()))
                met = set(words)
                n.update(words)
                d.update(met)
                size += len(met)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return rows.mapInArrow(run, "lang string, source string, term string, n long, d long")


def sources_of(docs: DataFrame) -> DataFrame:
    """``lang, sources``: the sources of each language in order, also those without terms."""
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")])
    return groups.groupBy("lang").agg(F.array_sort(F.collect_set("source")).alias("sources"))


def _small(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= MAX_SOURCES else rows


def wide_vectors(docs: DataFrame, langs: DataFrame, n_sources: int, min_docs: int) -> DataFrame:
    """``lang, term, counts``: kept terms with a count for each of the language's sources."""
    parts = term_counts(docs).repartition("lang", "term")  # serves both aggregations
    per = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    terms = per.groupBy("lang", "term").agg(F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("by"), F.sum("d").alias("d")).filter(F.col("d") >= min_docs)
    counts = F.transform("sources", lambda s: F.coalesce(F.try_element_at("by", s), F.lit(0).cast("long")))
    return terms.join(_small(langs, n_sources), "lang").select("lang", "term", counts.alias("counts"))


def share(count: str, whole: str) -> str:
    """SQL of a smoothed share in parts of 10^9; decimals, as the product passes 64 bits."""
    return f"1 + CAST(CAST({count} + 5 AS DECIMAL(20, 0)) * 1000000000 AS DECIMAL(38, 0)) DIV CAST({whole} AS DECIMAL(20, 0))"


def divergence(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: each other source of the language, by the sum of absolute differences of shares over all kept terms.
    Part ``term``: the ``top`` terms that the source uses more than the language as a whole, by difference.
    """
    langs = staged(sources_of(docs), "sources")
    n_sources = langs.agg(F.sum(F.size("sources"))).first()[0] or 0
    wide = staged(wide_vectors(docs, langs, n_sources, min_docs), "wide_vectors")
    sums = wide.select("lang", F.posexplode("counts").alias("i", "n")).groupBy("lang", "i").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    totals = sums.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "n"))), lambda x: x["n"]).alias("totals"), F.first("v").alias("v"))
    laws = staged(langs.join(totals, "lang", "left"), "source_totals")

    shares = wide.join(_small(laws, n_sources), "lang").select(
        "lang", "term", "sources", "counts",
        F.expr(f"transform(counts, (c, i) -> {share('c', 'totals[i] + 5 * v')})").alias("p"),
        F.expr(share("aggregate(counts, 0L, (a, c) -> a + c)", "aggregate(totals, 0L, (a, c) -> a + c) + 5 * v")).alias("q"),
    )
    # each source's share against those of the sources after it: an array no longer than there are sources
    one = shares.select("lang", F.posexplode("p").alias("i", "pi"), "p")
    later = F.transform(F.slice("p", F.col("i") + 2, F.size("p")), lambda x: F.abs(x - F.col("pi")))
    met = one.select("lang", "i", F.posexplode(later).alias("k", "f"))
    apart = met.groupBy("lang", "i", (F.col("i") + 1 + F.col("k")).alias("j")).agg(F.sum("f").alias("f"))

    every = laws.select("lang", "sources", F.posexplode("sources").alias("a", "source")).select("lang", "source", "a", F.posexplode("sources").alias("b", "item")).filter("a <> b")
    every = every.select("lang", "source", "item", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j"))
    pairs = every.join(apart, ["lang", "i", "j"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("f", F.lit(0).cast("long")).alias("value"))

    each = shares.select("lang", F.col("term").alias("item"), "q", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"), F.col("p").alias("p"))))
    over = each.filter((F.col("n") > 0) & (F.col("p") > F.col("q"))).select("lang", "source", F.lit("term").alias("part"), "item", (F.col("p") - F.col("q")).alias("value"))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(over.withColumn("rank", rank).filter(F.col("rank") <= top))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source")
    return divergence(docs)


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS (SELECT rid, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT rid) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT DISTINCT lang, source FROM d),
gc AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0)::HUGEINT AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
gp AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p FROM gc WINDOW w AS (PARTITION BY lang, source)),
lc AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM gc GROUP BY 1, 2),
lp AS (SELECT lang, term, 1 + (1000000000 * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS q FROM lc WINDOW w AS (PARTITION BY lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q
), k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM k WHERE part = 'pair' OR rank <= 50
"""
