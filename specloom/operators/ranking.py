"""Ranking matches and shaping the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from specloom.operators.keys import lookup_join

DEFAULT_N_BEST = 10

# Ids of at most this many matches, some tens of MB, are sent to the library.
FEW_MATCHES = 1_000_000


def drop_nan_scores(scored: DataFrame) -> DataFrame:
    """Undefined scores out: Spark sorts NaN above every number."""
    return scored.filter(F.col("score").isNotNull() & ~F.isnan("score"))


def best_per_query(scored: DataFrame, n_best: int) -> DataFrame:
    """Rank by score, then reference id. Spark cuts to n per query before the shuffle too."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("ref_id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_best)


def top_n_matches(scored: DataFrame, n_best_spectra: int | None = DEFAULT_N_BEST) -> DataFrame:
    """The best matches of each query; 0 or None mean the default of 10."""
    return scored.transform(drop_nan_scores).transform(
        best_per_query, n_best_spectra or DEFAULT_N_BEST
    )


def query_label(spectrum_id: Column, position: Column) -> Column:
    """The query's own id if it has one, else its position in the request."""
    own = F.nullif(F.trim(spectrum_id), F.lit(""))
    return F.coalesce(own, F.concat(F.lit("spectrum-"), position.cast("string")))


def attach_metadata(
    matches: DataFrame, spectra: DataFrame, include_metadata: list[str] | None = None
) -> DataFrame:
    """Add the matched reference's metadata, all of it or the named keys.

    A reference matched by very many queries is a hot key of the lookup. Where the matches are few,
    the spectra that none of them names are dropped before the library is shuffled. Hand in
    stored matches.
    """
    if matches.limit(FEW_MATCHES + 1).count() <= FEW_MATCHES:
        matched = matches.select(F.col("ref_id").alias("spectrum_id")).distinct()
        spectra = spectra.join(F.broadcast(matched), "spectrum_id", "left_semi")
    wanted = F.col("metadata")
    if include_metadata is not None:
        wanted = F.map_filter("metadata", lambda k, _: k.isin(include_metadata))
    table = spectra.select(F.col("spectrum_id").alias("ref_id"), wanted.alias("metadata"))
    return lookup_join(matches, table, ["ref_id"], ["query_id"], "left")


def nest_matches(matches: DataFrame) -> DataFrame:
    """One row per query: reference id to score. At most n_best entries each."""
    return matches.groupBy("query_id").agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "ref_id", "score"))),
                lambda m: F.struct(m["ref_id"], m["score"]),
            )
        ).alias("matches")
    )
