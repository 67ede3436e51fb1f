"""One query per operator."""

from __future__ import annotations

from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, functions as F

from checks import tables as t
from specloom.functions import vectors as V
from specloom.functions.text import inchikey_block
from specloom.operators import binning, candidates, chunks, cleaning, documents, models, ranking, similarity, structures
from specloom.plans import ms2ds, spec2vec
from specloom.plans.library import prepare_library
from specloom.session import materialise, new_path, ship_package
from specloom.sources import clustered, datasets, library, store
from specloom.sources.keyed import KeyedTable

REGISTRY = {}


def query(fn):
    @wraps(fn)
    def run(spark, sf) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf)

    REGISTRY[fn.__name__.rstrip("_")] = run
    return fn


def r6(column):
    return V.rounded(column)


def _peak_sums(df: DataFrame, *more) -> DataFrame:
    total = lambda f: F.aggregate("peaks", F.lit(0.0), lambda s, p: s + p[f])
    return df.select(
        "spectrum_id",
        *more,
        F.size("peaks").alias("n_peaks"),
        r6(total("mz")).alias("sum_mz"),
        r6(total("intensity")).alias("sum_intensity"),
    )


def _peak_rows(df: DataFrame) -> DataFrame:
    return df.select("spectrum_id", F.inline("peaks")).select(
        "spectrum_id", "mz", r6(F.col("intensity")).alias("intensity")
    )


def _parsed(spark, sf):
    return t.raw_once(spark, sf).transform(cleaning.parse_spectrum)


# Sources and sinks


@query
def read_library_json(spark, sf):
    path = new_path(spark, "library-json")
    library.write_library_json(t.raw(spark, sf), path)
    return library.read_library_json(spark, path).select(
        "spectrum_id",
        "Precursor_MZ",
        "Ion_Mode",
        "scan",
        "scan_no",
        F.octet_length("peaks_json").cast("bigint").alias("n_bytes"),
    )


@query
def read_library_json_arrays(spark, sf):
    """The library as published: arrays over many lines, read in byte ranges."""
    path = new_path(spark, "library-arrays")
    library.write_library_json(t.raw_once(spark, sf), path, layout="array")
    return library.read_library_json(spark, path, layout="any").select(
        "spectrum_id",
        "Precursor_MZ",
        "Ion_Mode",
        "scan",
        "scan_no",
        F.octet_length("peaks_json").cast("bigint").alias("n_bytes"),
    )


@query
def read_library_mgf(spark, sf):
    path = new_path(spark, "library-mgf")
    library.write_library_mgf(t.peak_spectra_once(spark, sf), path)
    read = library.read_library_mgf(spark, path)
    return _peak_sums(read, "precursor_mz", r6(F.col("parent_mass")).alias("parent_mass"), "charge", "inchi")


@query
def library_ids(spark, sf):
    return library.library_ids(t.raw(spark, sf))


@query
def read_by_ids(spark, sf):
    return library.read_by_ids(t.raw(spark, sf), t.embedding_ids(spark, sf)).select(
        "SpectrumID", "Precursor_MZ"
    )


@query
def read_many_paths(spark, sf):
    lib = t.library(spark, sf)
    paths = []
    for mode in ("positive", "negative"):
        paths.append(new_path(spark, f"chunk-{mode}"))
        lib.filter(F.col("ion_mode") == mode).write.parquet(paths[-1])
    return datasets.read_many_paths(spark, paths).select("spectrum_id", "precursor_mz", "ion_mode")


def _written(spark, sf):
    path = new_path(spark, "dataset")
    datasets.write_dataset(t.library(spark, sf), path)
    return datasets.read_dataset(spark, path)


@query
def write_dataset(spark, sf):
    return _written(spark, sf).groupBy("ion_mode").agg(F.count("*").alias("n_rows"))


@query
def read_dataset(spark, sf):
    return _written(spark, sf).filter(F.col("ion_mode") == "negative").select("spectrum_id", "precursor_mz")


def _negative(spark, sf):
    return t.library(spark, sf).filter(F.col("ion_mode") == "negative")


@query
def upsert_spectra(spark, sf):
    table = _keyed(spark, "store", _negative(spark, sf))
    table.upsert(t.remeasured(spark, sf), ["measured_at", "pos", "precursor_mz"])
    return table.read()


def _keyed(spark, name, first, *partition_by) -> KeyedTable:
    """A keyed table that holds ``first``."""
    table = KeyedTable.create(spark, new_path(spark, name), first.schema, partition_by, n_buckets=8)
    table.upsert(first, ["spectrum_id"])
    return table


@query
def cache_new_spectra(spark, sf):
    ids = t.library(spark, sf).select("spectrum_id")
    new = _keyed(spark, "cache", _negative(spark, sf)).only_new(t.library(spark, sf))
    marked = new.select("spectrum_id", F.lit(True).alias("new"))
    return ids.join(marked, "spectrum_id", "left").select(
        "spectrum_id", F.coalesce("new", F.lit(False)).cast("int").alias("is_new")
    )


@query
def stored_ids(spark, sf):
    return store.stored_ids(t.remeasured(spark, sf))


@query
def existing_ids(spark, sf):
    return store.existing_ids(t.listed_ids(spark, sf), _negative(spark, sf))


@query
def missing_ids(spark, sf):
    return store.missing_ids(t.listed_ids(spark, sf), _negative(spark, sf))


@query
def fetch_spectra(spark, sf):
    return store.fetch_spectra(t.library(spark, sf), t.embedding_ids(spark, sf))


def _embedding_table(spark, sf, project="spec2vec"):
    return t.embeddings(spark, sf).select("spectrum_id", "vector", F.lit(project).alias("project"), "ion_mode")


def _first(df):
    return df.select("project", "ion_mode", "spectrum_id", r6(F.get("vector", F.lit(0))).alias("first"))


@query
def fetch_embeddings(spark, sf):
    return _first(
        store.fetch_embeddings(_embedding_table(spark, sf), "spec2vec", "positive", t.listed_ids(spark, sf))
    )


def _bin_rows(df, *more):
    return df.select("spectrum_id", *more, F.inline("bins")).select(
        "spectrum_id", *more, "bin", r6(F.col("value")).alias("value")
    )


@query
def fetch_binned(spark, sf):
    binned = t.binned(spark, sf, 100)
    return _bin_rows(store.fetch_binned(binned, "positive", t.embedding_ids(spark, sf)))


@query
def write_embeddings(spark, sf):
    table = _embedding_table(spark, sf)
    negated = table.withColumn("vector", F.transform("vector", lambda v: -v)).filter(
        F.col("ion_mode") == "negative"
    )
    batch = negated.unionByName(_embedding_table(spark, sf, "ms2deepscore")).withColumn("pos", F.lit(0))
    keyed = _keyed(spark, "embeddings", table, "project", "ion_mode")
    keyed.upsert(batch, ["pos"])
    return _first(keyed.read())


@query
def write_binned(spark, sf):
    table = t.binned(spark, sf, 100)
    unpowered = t.processed(spark, sf).filter(F.col("ion_mode") == "negative").transform(binning.bin_peaks, 100, 1.0)
    batch = unpowered.select(*table.columns, F.lit(0).alias("pos"))
    keyed = _keyed(spark, "binned-store", table, "ion_mode")
    keyed.upsert(batch, ["pos"])
    return _bin_rows(keyed.read(), "ion_mode")


@query
def delete_spectra(spark, sf):
    return store.delete_spectra(t.library(spark, sf), t.embedding_ids(spark, sf))


@query
def delete_embeddings(spark, sf):
    path = new_path(spark, "embeddings")
    datasets.write_dataset(_embedding_table(spark, sf), path, ("project", "ion_mode"))
    datasets.drop_partition(spark, path, project="spec2vec", ion_mode="positive")
    datasets.drop_partition(spark, path, project="spec2vec", ion_mode="positive")
    return _first(datasets.read_dataset(spark, path))


# Projections, filters, cleaning


@query
def filter_ion_mode(spark, sf):
    return cleaning.filter_ion_mode(t.raw(spark, sf), "positive").select("spectrum_id", "Ion_Mode")


@query
def parse_spectrum(spark, sf):
    return _peak_sums(_parsed(spark, sf), "precursor_mz", "charge", "inchikey")


@query
def parse_query_payload(spark, sf):
    parsed = library.parse_query_payload(t.requests(spark, sf))
    return parsed.select(
        "request_id", "query_pos", "n_best_spectra", "precursor_mz", F.size("peaks").alias("n_peaks")
    )


@query
def drop_negative_intensity(spark, sf):
    return _peak_sums(cleaning.drop_negative_intensity(_parsed(spark, sf)))


@query
def drop_empty_spectra(spark, sf):
    return _peak_sums(cleaning.drop_empty_spectra(_parsed(spark, sf)))


@query
def normalise_metadata(spark, sf):
    return cleaning.normalise_metadata(_parsed(spark, sf)).select("spectrum_id", "charge", "ion_mode", "adduct")


@query
def derive_parent_mass(spark, sf):
    df = _parsed(spark, sf).transform(cleaning.normalise_metadata).transform(cleaning.derive_parent_mass)
    return df.select("spectrum_id", r6(F.col("parent_mass")).alias("parent_mass"))


@query
def harmonise_undefined(spark, sf):
    return cleaning.harmonise_undefined(_parsed(spark, sf)).select("spectrum_id", "inchi", "inchikey", "smiles")


@query
def repair_identifiers(spark, sf):
    df = _parsed(spark, sf).transform(cleaning.harmonise_undefined).transform(cleaning.repair_identifiers)
    return df.select("spectrum_id", "inchi", "inchikey", "smiles")


def _clean_columns(df):
    return _peak_sums(
        df, "charge", "ion_mode", r6(F.col("parent_mass")).alias("parent_mass"), "inchi", "inchikey", "smiles"
    )


@query
def clean_spectra(spark, sf):
    return _clean_columns(cleaning.clean_spectra(_parsed(spark, sf)))


@query
def normalise_intensities(spark, sf):
    return _peak_rows(t.spectra(spark, sf).transform(cleaning.normalise_intensities))


@query
def select_by_mz(spark, sf):
    return _peak_rows(t.spectra(spark, sf).transform(cleaning.select_by_mz))


@query
def require_min_peaks(spark, sf):
    kept = t.spectra(spark, sf).transform(cleaning.select_by_mz).transform(cleaning.require_min_peaks)
    return _peak_sums(kept)


@query
def require_more_than_n_peaks(spark, sf):
    return _peak_sums(t.spectra(spark, sf).transform(cleaning.require_more_than_n_peaks, 3))


@query
def require_structure(spark, sf):
    return t.spectra(spark, sf).transform(cleaning.require_structure).select("spectrum_id", "inchikey", "inchi")


@query
def clean_compound_name(spark, sf):
    return cleaning.clean_compound_name(_parsed(spark, sf)).select("spectrum_id", "compound_name")


@query
def process_spectra(spark, sf):
    return _peak_sums(t.processed(spark, sf), "inchi")


@query
def precursor_completeness(spark, sf):
    records = t.raw(spark, sf).withColumn(
        "Precursor_MZ",
        F.when(F.col("Charge") == "", F.lit("")).when(F.col("Charge") == "0", None).otherwise(F.col("Precursor_MZ")),
    )
    report = cleaning.precursor_completeness(records)
    return report.select(
        "n_records", r6(F.col("present_percentage")).alias("present_percentage"), r6(F.col("filled_percentage")).alias("filled_percentage")
    )


# Peak words and bins


@query
def peak_words(spark, sf):
    rows = documents.word_rows(t.documents(spark, sf), 1.0)
    return rows.select("spectrum_id", "word", r6(F.col("weight")).alias("weight"))


@query
def create_documents(spark, sf):
    docs = documents.create_documents(t.spectra(spark, sf), 2, 1)
    return docs.select(
        "spectrum_id",
        "n_decimals",
        F.size("words").alias("n_words"),
        r6(F.aggregate("weights", F.lit(0.0), lambda s, w: s + w)).alias("sum_weights"),
    )


@query
def check_n_decimals(spark, sf):
    coarse = documents.create_documents(t.spectra(spark, sf, "negative"), 1).select("n_decimals")
    both = t.documents(spark, sf, "positive").select("n_decimals").unionByName(coarse)
    return documents.decimals_report(both, 2).withColumn("accepted", F.col("accepted").cast("int"))


@query
def power_weights(spark, sf):
    docs = t.documents(spark, sf).transform(documents.power_weights, 0.5)
    return documents.word_rows(docs, 1.0).select("spectrum_id", "word", r6(F.col("weight")).alias("weight"))


@query
def bin_peaks(spark, sf):
    return _bin_rows(t.processed(spark, sf).transform(binning.bin_peaks, 100))


@query
def inchikey_block_(spark, sf):
    blocks = t.spectra(spark, sf).withColumn("key", inchikey_block(F.col("inchikey")))
    return blocks.groupBy("key").agg(F.count("*").alias("n_spectra"))


@query
def densify_binned(spark, sf):
    binned = t.binned(spark, sf, 100)
    dense = binning.densify_binned(binned, binning.fit_bin_vocabulary(binned), 100)
    weighted = F.aggregate(
        F.transform("vector", lambda v, i: v * i), F.lit(0.0), lambda s, x: s + x
    )
    return dense.select(
        "spectrum_id",
        F.size("vector").alias("dim"),
        r6(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x)).alias("total"),
        r6(weighted).alias("weighted_total"),
    )


@query
def fit_bin_vocabulary(spark, sf):
    return binning.fit_bin_vocabulary(t.binned(spark, sf, 10_000))


def _fitted_on_negative(spark, sf, n_bins):
    all_binned = t.binned(spark, sf, n_bins)
    return all_binned, binning.fit_bin_vocabulary(all_binned.filter(F.col("ion_mode") == "negative"))


@query
def transform_to_vocabulary(spark, sf):
    binned, vocabulary = _fitted_on_negative(spark, sf, 10_000)
    rows = binning.transform_to_vocabulary(binned, vocabulary)
    return rows.select("spectrum_id", "position", r6(F.col("value")).alias("value"))


@query
def unseen_bin_share(spark, sf):
    binned, vocabulary = _fitted_on_negative(spark, sf, 10_000)
    share = binning.unseen_bin_share(binned, vocabulary)
    return share.select("spectrum_id", r6(F.col("unseen_share")).alias("unseen_share"))


@query
def word_vocabulary(spark, sf):
    return documents.word_vocabulary(t.documents(spark, sf))


@query
def modal_inchi(spark, sf):
    return structures.modal_inchi(t.part_structures(spark, sf))


@query
def document_coverage(spark, sf):
    vocabulary = documents.word_vocabulary(t.documents(spark, sf, "negative"))
    covered = documents.document_coverage(t.documents(spark, sf), vocabulary)
    return covered.select("spectrum_id", r6(F.col("missing_percentage")).alias("missing_percentage"), "status")


@query
def batch_row_counts(spark, sf):
    parsed = t.raw(spark, sf).transform(cleaning.parse_spectrum)
    cleaned = parsed.transform(cleaning.clean_spectra)
    return cleaning.batch_row_counts(
        {
            "raw": t.raw(spark, sf),
            "parsed": parsed,
            "cleaned": cleaned,
            "processed": cleaned.transform(cleaning.process_spectra),
        }
    )


# Joins


@query
def precursor_range(spark, sf):
    return candidates.precursor_range(t.library(spark, sf), 200.0, 300.0)


@query
def precursor_range_clustered(spark, sf):
    """The same window in a library laid out by m/z: only the files that it touches are read."""
    path = new_path(spark, "clustered")
    clustered.write_clustered(t.library(spark, sf), path, n_files=32)
    return clustered.clustered_range(spark, path, 200, 300).select("spectrum_id", "precursor_mz")


@query
def precursor_candidates(spark, sf):
    queries = t.query_side(t.embeddings(spark, sf))
    refs = t.library(spark, sf).select(
        F.col("spectrum_id").alias("ref_id"), F.col("precursor_mz").alias("ref_mz"), "ion_mode"
    )
    return candidates.precursor_candidates(queries, refs, 1.0, "keep")


@query
def candidate_embeddings(spark, sf):
    vectors = t.embeddings(spark, sf)
    attached = candidates.window_embeddings(
        t.query_side(vectors), t.ref_side(vectors), _embedding_table(spark, sf), "spec2vec", "positive", 5.0
    )
    return attached.select("query_id", "ref_id", r6(F.get("ref_vector", F.lit(0))).alias("first"))


@query
def union_candidates(spark, sf):
    queries = t.query_side(t.embeddings(spark, sf))
    refs = t.library(spark, sf).select(
        F.col("spectrum_id").alias("ref_id"), F.col("precursor_mz").alias("ref_mz"), "ion_mode"
    )
    return candidates.union_candidates(queries, refs, 1.0)


def _embedding_search(spark, sf, **options):
    vectors = t.embeddings(spark, sf)
    return spec2vec.spec2vec_search(t.query_side(vectors), t.ref_side(vectors), 5.0, **options)


@query
def attach_metadata(spark, sf):
    keys = ["compound_name", "adduct", "exactmass"]
    matches = _embedding_search(spark, sf, metadata=t.spectra_once(spark, sf), include_metadata=keys)
    return matches.select(
        "query_id",
        "ref_id",
        "rank",
        *[F.col("metadata")[k].alias(k) for k in keys],
        F.size("metadata").alias("n_keys"),
    )


@query
def spectra_for_keys(spark, sf):
    keyed = structures.with_structure_key(t.spectra(spark, sf).select("spectrum_id", "inchikey"))
    split = structures.group_split(keyed)
    chosen = structures.spectra_for_keys(keyed, split.filter(F.col("split") == "validation"))
    return chosen.select("spectrum_id", "key")


@query
def labelled_pairs(spark, sf):
    fingerprints = materialise(structures.fingerprint_bitmap(t.part_features(spark, sf)), "fingerprints")
    partners, members = structures.sampled_partners(fingerprints), structures.copy_members(fingerprints)
    return structures.labelled_pairs(t.part_structures(spark, sf), partners, members)


# Similarity


@query
def cosine_pair(spark, sf):
    vectors = t.with_zero_vectors(t.embeddings(spark, sf))
    return candidates.score_candidates(t.query_side(vectors), t.ref_side(vectors), 5.0, undefined=0.0)


@query
def cosine_matrix(spark, sf):
    vectors = t.with_zero_vectors(t.embeddings(spark, sf))
    refs = vectors.filter(F.col("ion_mode") == "positive")
    return similarity.cosine_matrix(similarity.as_queries(vectors), similarity.as_refs(refs), 10)


@query
def self_similarity(spark, sf):
    return similarity.self_similarity(t.embeddings(spark, sf), 10)


@query
def tanimoto_pair(spark, sf):
    """Each supplier against all parts of its nation."""
    suppliers = t.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("key"), F.col("s_nationkey").cast("string").alias("nation")
    )
    features = t.supplier_features(spark, sf)
    own = structures.fingerprint_bitmap(features)
    of_nation = structures.fingerprint_bitmap(
        features.join(suppliers, "key").select(F.col("nation").alias("key"), "feature")
    ).select(F.col("key").alias("nation"), F.col("bitmap").alias("nation_bitmap"))
    score = V.tanimoto_pair(F.col("bitmap"), F.col("nation_bitmap"))
    return own.join(suppliers, "key").join(of_nation, "nation").select("key", "nation", r6(score).alias("score"))


@query
def tanimoto_matrix(spark, sf):
    fingerprints = materialise(structures.fingerprint_bitmap(t.supplier_features(spark, sf)), "fingerprints")
    scores = structures.tanimoto_matrix(fingerprints, 0.15)
    return structures.with_copies(scores, structures.copy_members(fingerprints))


@query
def similar_structures(spark, sf):
    """Orders whose parts are alike, found by an index over the rarest parts."""
    lines = t.table(spark, sf, "lineitem")
    features = lines.select(F.col("l_orderkey").cast("string").alias("key"), F.col("l_partkey").alias("feature"))
    return structures.tanimoto_matrix(structures.fingerprint_bitmap(features), 0.5)


@query
def fingerprint_bitmap(spark, sf):
    bitmaps = structures.fingerprint_bitmap(t.supplier_features(spark, sf))
    rows = bitmaps.select("key", F.posexplode("bitmap").alias("word", "bits"))
    return rows.select(
        "key",
        "word",
        F.bit_count("bits").cast("bigint").alias("n_bits"),
        F.col("bits").bitwiseAND(F.lit((1 << 32) - 1)).alias("low_bits"),
    )


def _vector_rows(df, *more):
    return df.select("spectrum_id", *more, F.posexplode("vector").alias("dim", "v")).select(
        "spectrum_id", *more, "dim", r6(F.col("v")).alias("value")
    )


@query
def weighted_document_vector(spark, sf):
    vocabulary = documents.word_vocabulary(t.documents(spark, sf, "negative"))
    vectors = documents.weighted_document_vector(
        t.documents(spark, sf), t.word_vectors(vocabulary), 0.5, t.WORD_DIM
    )
    return _vector_rows(vectors)


# Ranking


def _scored(spark, sf, n_best=None):
    vectors = t.with_zero_vectors(t.embeddings(spark, sf))
    return candidates.score_candidates(t.query_side(vectors), t.ref_side(vectors), 5.0, n_best=n_best)


@query
def drop_nan_scores(spark, sf):
    return ranking.drop_nan_scores(_scored(spark, sf))


@query
def top_n_matches(spark, sf):
    return ranking.top_n_matches(_scored(spark, sf, 5), 5)


@query
def query_labels(spark, sf):
    return library.parse_query_payload(t.requests(spark, sf)).select("request_id", "query_pos", "query_label")


@query
def nest_matches(spark, sf):
    nested = ranking.nest_matches(_embedding_search(spark, sf))
    return nested.select("query_id", F.explode("matches").alias("ref_id", "score"))


# Chunks and splits


@query
def chunk_by_bytes(spark, sf):
    return chunks.chunk_by_bytes(t.raw(spark, sf), 150_000, rule="offset")


@query
def chunk_by_bytes_greedy(spark, sf):
    """Each chunk closed by the record that fills it."""
    return chunks.chunk_by_bytes(t.raw(spark, sf), 150_000)


@query
def chunk_ids(spark, sf):
    return chunks.chunk_ids(t.library(spark, sf).select("spectrum_id"), 1_000)


@query
def group_split(spark, sf):
    return structures.group_split(structures.with_structure_key(t.spectra(spark, sf)))


@query
def flatten_batches(spark, sf):
    lib = t.library(spark, sf)
    batches = [lib.filter(F.col("ion_mode") == m) for m in ("positive", "negative")]
    return chunks.flatten_batches(batches)


@query
def id_difference(spark, sf):
    return chunks.id_difference(t.listed_ids(spark, sf), t.embedding_ids(spark, sf))


@query
def id_union(spark, sf):
    return chunks.id_union([t.listed_ids(spark, sf), t.embedding_ids(spark, sf)])


@query
def id_intersection(spark, sf):
    return chunks.id_intersection(t.listed_ids(spark, sf), t.embedding_ids(spark, sf))


# Models


@query
def train_word_vectors(spark, sf):
    coarse = documents.create_documents(t.spectra(spark, sf), 0).select("words")
    trained = models.train_word_vectors(coarse, vector_size=16, epochs=5)
    return trained.select("word", F.size("vector").alias("n_dims"))


@query
def embed_documents(spark, sf):
    vocabulary = documents.word_vocabulary(t.documents(spark, sf, "negative"))
    embedded = documents.embed_documents(
        t.documents(spark, sf), t.word_vectors(vocabulary), 0.5, 5.0, t.WORD_DIM
    )
    return embedded.select(
        "spectrum_id",
        r6(F.col("missing_percentage")).alias("missing_percentage"),
        "status",
        *[r6(F.get("vector", F.lit(i))).alias(f"v{i}") for i in (0, 15)],
    )


def network(n_inputs: int) -> list[models.DenseLayer]:
    """A small network with weights given by a formula, so that SQL can repeat it."""

    def layer(rows, columns, activation):
        i, j = np.meshgrid(np.arange(rows), np.arange(columns), indexing="ij")
        return models.DenseLayer(
            ((i * 7 + j * 13) % 11 - 5) / 10.0, (np.arange(columns) % 3) / 10.0, activation
        )

    return [layer(n_inputs, 6, "relu"), layer(6, 4, "linear")]


def _network_vectors(spark, sf):
    binned = t.binned(spark, sf, 100)
    return models.embed_binned(binned, binning.fit_bin_vocabulary(binned), network(100), 100)


@query
def embed_binned(spark, sf):
    return _vector_rows(_network_vectors(spark, sf))


# End to end


@query
def prepare_library_(spark, sf):
    path = new_path(spark, "prepared")
    return _clean_columns(prepare_library(t.raw_once(spark, sf), "positive", path))


@query
def spec2vec_train(spark, sf):
    trained = spec2vec.spec2vec_train(t.raw(spark, sf), "negative", 0, vector_size=16, epochs=2)
    return trained.select("word", F.size("vector").alias("n_dims"))


def _library_word_vectors(spark, sf):
    """A vector for every word of the library, stored as a model is."""
    return t.stored(
        spark,
        sf,
        "word-vectors",
        lambda: t.word_vectors(documents.word_vocabulary(t.documents(spark, sf))),
    )


@query
def spec2vec_index(spark, sf):
    """Indexed twice, with an empty run in between; the library's ids are counted."""
    paths = new_path(spark, "library"), new_path(spark, "embeddings")
    vectors, spectra = _library_word_vectors(spark, sf), t.spectra(spark, sf)
    for batch in (spectra, spectra.limit(0), spectra):
        indexed = spec2vec.spec2vec_index(spark, batch, vectors, "positive", *paths, 8, dim=t.WORD_DIM)
    stored = KeyedTable(spark, paths[0]).read().groupBy("spectrum_id").agg(F.count("*").alias("n_stored"))
    return _first(indexed).join(stored, "spectrum_id", "left")


@query
def spec2vec_search(spark, sf):
    """Every library spectrum embedded and searched in the whole library."""
    spectra = t.peak_spectra(spark, sf)
    embedded = spec2vec.embed_spectra(spectra, _library_word_vectors(spark, sf), dim=t.WORD_DIM)
    vectors = materialise(
        embedded.join(spectra.select("spectrum_id", "precursor_mz", "ion_mode"), "spectrum_id"), "embeddings"
    )
    return spec2vec.spec2vec_search(t.query_side(vectors), t.ref_side(vectors), 1.0)


@query
def embedding_search(spark, sf):
    """The given vectors against each other, and the match's metadata key."""
    return _embedding_search(spark, sf)


@query
def ms2ds_prepare(spark, sf):
    """The training tables, as one report."""
    spectra = t.peak_spectra(spark, sf)
    lines = t.table(spark, sf, "lineitem").select(t.spectrum_id("l_orderkey").alias("spectrum_id"), F.col("l_suppkey").alias("feature"))
    keyed = structures.with_structure_key(spectra).select("spectrum_id", "key")
    features = lines.join(keyed, "spectrum_id").select("key", "feature")
    tables = ms2ds.ms2ds_prepare(spectra, structures.fingerprint_bitmap(features), 100, min_score=0.2)
    parts = [
        tables.binned.agg(F.lit("binned").alias("part"), F.count("*").alias("n_rows")),
        tables.vocabulary.agg(F.lit("vocabulary").alias("part"), F.count("*").alias("n_rows")),
        tables.split.groupBy(F.col("split").alias("part")).agg(F.count("*").alias("n_rows")),
        tables.spectra("training").agg(F.lit("training spectra").alias("part"), F.count("*").alias("n_rows")),
    ]
    return chunks.flatten_batches(parts)


@query
def ms2ds_index(spark, sf):
    binned = t.binned(spark, sf, 100)
    vocabulary, path = binning.fit_bin_vocabulary(binned), new_path(spark, "embeddings")
    for batch in (binned, binned.limit(0), binned):
        indexed = ms2ds.ms2ds_index(spark, batch, vocabulary, network(100), "negative", path, 100, 8)
    return _vector_rows(indexed, "project", "ion_mode")


@query
def ms2ds_search(spark, sf):
    vectors = t.embeddings(spark, sf)
    return ms2ds.ms2ds_search(t.query_side(vectors), t.ref_side(vectors), 5.0)
