"""The SQL each query must equal, over the same tables.

Written from the definitions in long form (one row per peak, word or bin), not
from the Spark plans.
"""

from __future__ import annotations

from checks.tables import LIBRARY_FIELDS, PEAK_FIELDS, RAW_FIELDS, fields, id_text

ORACLES: dict[str, str] = {}

# Fixed value: mass of a proton in Dalton.
PROTON = "cast(1.00727645199076 as double)"


def r6(text: str) -> str:
    return f"round({text}, 6) + 0"


def defined(c: str) -> str:
    return (
        f"case when {c} is null or lower(trim({c})) in ('', 'n/a', 'na', 'nan', 'none', 'null', 'no data')"
        f" then '' else {c} end"
    )


def is_inchi(c: str) -> str:
    return f"regexp_matches({c}, '^\\s*\"?InChI=')"


def is_key(c: str) -> str:
    return f"regexp_matches({c}, '^\\s*[A-Z]{{14}}-[A-Z]{{10}}-[A-Z]\\s*$')"


def word(mz: str, n: int) -> str:
    scaled = f"cast(floor({mz} * cast({10**n} as double) + 0.5) as bigint)"
    if n == 0:
        return f"'peak@' || {scaled}"
    return f"'peak@' || ({scaled} // {10**n}) || '.' || lpad(cast({scaled} % {10**n} as varchar), {n}, '0')"


def bins(n: int) -> str:
    return f"cast(floor((mz - cast(10 as double)) / cast({990.0 / n!r} as double)) as int)"


LIBRARY = {
    **{name: text for name, text in RAW_FIELDS.items() if name not in ("SpectrumID", "Precursor_MZ", "Ion_Mode")},
    **LIBRARY_FIELDS,
    "mz_text": RAW_FIELDS["Precursor_MZ"],
    "mode_text": RAW_FIELDS["Ion_Mode"],
}

BASE = f"""
lib as (select o_orderkey as k, {', '.join(fields(LIBRARY))}, o_orderpriority from orders),
pk as (select {', '.join(fields(PEAK_FIELDS))} from lineitem),
sums as (select k, cast(count(*) as int) as n_peaks, {r6('sum(mz)')} as sum_mz, {r6('sum(intensity)')} as sum_intensity
    from pk group by k),
parsed as (select lib.*, nullif(coalesce(nullif({defined('InChIKey_inchi')}, ''), nullif({defined('InChIKey_smiles')}, '')), '') as inchikey
    from lib where k in (select k from pk)),
usable as (select k from pk group by k having min(intensity) >= 0 and max(intensity) > 0),
charges as (select k, coalesce(try_cast(nullif(regexp_extract(Charge, '(\\d+)', 1), '') as int), 0) as c from parsed),
meta as (select k, cast(case ion_mode when 'negative' then -greatest(abs(c), 1) else greatest(abs(c), 1) end as int) as charge_no
    from charges join parsed using (k)),
masses as (select k, coalesce(case when try_cast(ExactMass as double) > 0 then try_cast(ExactMass as double) end,
      (precursor_mz - sign(charge_no) * {PROTON}) * abs(charge_no)) as parent_mass
    from parsed join meta using (k)),
harm as (select k, {defined('INCHI')} as i, {defined('inchikey')} as y, {defined('Smiles')} as s from parsed),
repaired as (select k,
      case when {is_inchi('i')} then trim(i) when {is_inchi('s')} then trim(s) when {is_inchi('y')} then trim(y)
        when {is_key('i')} then '' else i end as inchi,
      case when {is_key('y')} then trim(y) when {is_key('i')} then trim(i) when {is_key('s')} then trim(s)
        when {is_inchi('y')} then '' else y end as inchikey,
      case when {is_inchi('s')} or {is_key('s')} then '' else s end as smiles
    from harm),
clean as (select p.k, p.spectrum_id, p.precursor_mz, p.ion_mode, charge_no as charge, parent_mass, r.inchi, r.inchikey, r.smiles
    from parsed p join usable using (k) join meta using (k) join masses using (k) join repaired r using (k)),
normed as (select k, spectrum_id, ion_mode, mz, intensity / max(intensity) over (partition by k) as intensity
    from pk join clean using (k)),
structured as (select * replace (translate(inchi, '" ', '') as inchi) from clean where length(inchikey) > 13 and inchi <> ''),
enough as (select k from normed where mz between 10 and 1000 and intensity > 0 group by k having count(*) >= 5),
processed as (select * from structured join enough using (k)),
procpk as (select normed.* from normed join processed using (k) where mz between 10 and 1000),
bin100 as (select k, spectrum_id, ion_mode, {bins(100)} as bin, max(pow(intensity, 0.5)) as value from procpk where mz < 1000 group by all),
bin10k as (select k, spectrum_id, ion_mode, {bins(10000)} as bin, max(pow(intensity, 0.5)) as value from procpk where mz < 1000 group by all),
words as (select k, spectrum_id, ion_mode, {word('mz', 2)} as word, intensity as weight from normed),
emb as (select {id_text('vec_id')} as spectrum_id, label, cast(embedding as double[]) as v, precursor_mz, ion_mode
    from embeddings join lib on lib.k = vec_id),
"""


def oracle(key: str, select: str, **ctes: str) -> None:
    more = "".join(f"{name} as ({text}),\n" for name, text in ctes.items())
    ORACLES[key] = f"with {BASE}{more}done as (select 1)\n{select}"


SUMS = "n_peaks, sum_mz, sum_intensity"

# Sources and sinks
PEAK_TEXT = """select k, '[' || coalesce(string_agg('[' || mz || ',' || intensity || ']', ',' order by mz, intensity), '') || ']' as t
    from lib left join pk using (k) group by k"""
oracle(
    "read_library_json",
    "select spectrum_id, mz_text as Precursor_MZ, mode_text as Ion_Mode, scan, scan_no, cast(strlen(t) as bigint) as n_bytes from lib join texts using (k)",
    texts=PEAK_TEXT,
)
ORACLES["read_library_json_arrays"] = ORACLES["read_library_json"]
oracle(
    "read_library_mgf",
    f"select spectrum_id, precursor_mz, {r6('parent_mass')} as parent_mass, cast(charge as varchar) as charge, inchi, {SUMS} from clean join sums using (k)",
)
oracle("library_ids", "select spectrum_id from lib")
oracle(
    "read_by_ids",
    "select spectrum_id as SpectrumID, mz_text as Precursor_MZ from lib where k in (select vec_id from embeddings)",
)
oracle("read_many_paths", "select spectrum_id, precursor_mz, ion_mode from lib")
oracle("write_dataset", "select ion_mode, count(*) as n_rows from lib group by ion_mode")
oracle("read_dataset", "select spectrum_id, precursor_mz from lib where ion_mode = 'negative'")
oracle(
    "upsert_spectra",
    """select spectrum_id, precursor_mz, 'negative' as ion_mode from ranked where n = 1
    union all select spectrum_id, precursor_mz, ion_mode from lib
    where ion_mode = 'negative' and k not in (select l_orderkey from lineitem)""",
    ranked=f"""select {id_text('l_orderkey')} as spectrum_id, round(100 + l_extendedprice / 1000, 5) as precursor_mz,
      row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, round(100 + l_extendedprice / 1000, 5) desc) as n
      from lineitem""",
)
oracle("cache_new_spectra", "select spectrum_id, cast(ion_mode <> 'negative' as int) as is_new from lib")
oracle("stored_ids", f"select distinct {id_text('l_orderkey')} as spectrum_id from lineitem")
oracle("existing_ids", "select spectrum_id from lib where ion_mode = 'negative' and k in (select l_orderkey from lineitem)")
oracle(
    "missing_ids",
    f"select {id_text('l_orderkey')} as spectrum_id from lineitem where l_orderkey not in (select k from lib where ion_mode = 'negative')",
)
oracle("fetch_spectra", "select spectrum_id, precursor_mz, ion_mode from lib where k in (select vec_id from embeddings)")
oracle(
    "fetch_embeddings",
    f"""select 'spec2vec' as project, ion_mode, spectrum_id, {r6('v[1]')} as first from emb
    where ion_mode = 'positive' and spectrum_id in (select {id_text('l_orderkey')} from lineitem)""",
)
oracle(
    "fetch_binned",
    f"select spectrum_id, bin, {r6('value')} as value from bin100 where ion_mode = 'positive' and k in (select vec_id from embeddings)",
)
oracle(
    "write_embeddings",
    f"""select 'spec2vec' as project, ion_mode, spectrum_id, {r6("case ion_mode when 'negative' then -v[1] else v[1] end")} as first from emb
    union all select 'ms2deepscore', ion_mode, spectrum_id, {r6('v[1]')} from emb""",
)
oracle(
    "write_binned",
    f"""select spectrum_id, ion_mode, bin, {r6("case ion_mode when 'negative' then value * value else value end")} as value from bin100""",
)
oracle("delete_spectra", "select spectrum_id, precursor_mz, ion_mode from lib where k not in (select vec_id from embeddings)")
oracle(
    "delete_embeddings",
    f"select 'spec2vec' as project, ion_mode, spectrum_id, {r6('v[1]')} as first from emb where ion_mode = 'negative'",
)

# Projections, filters, cleaning
oracle("filter_ion_mode", "select spectrum_id, mode_text as Ion_Mode from lib where ion_mode = 'positive'")
oracle("parse_spectrum", f"select spectrum_id, precursor_mz, Charge as charge, inchikey, {SUMS} from parsed join sums using (k)")
oracle(
    "parse_query_payload",
    """select spectrum_id as request_id, cast(p as int) as query_pos, cast(2 as int) as n_best_spectra, precursor_mz, n_peaks
    from parsed join sums using (k), (values (1), (2)) as positions(p)""",
)
oracle(
    "drop_negative_intensity",
    f"select spectrum_id, {SUMS} from parsed join sums using (k) where k in (select k from pk group by k having min(intensity) >= 0)",
)
oracle(
    "drop_empty_spectra",
    f"select spectrum_id, {SUMS} from parsed join sums using (k) where k in (select k from pk group by k having max(intensity) > 0)",
)
oracle(
    "normalise_metadata",
    "select spectrum_id, charge_no as charge, ion_mode, replace(replace(Adduct, '[', ''), ']', '') as adduct from parsed join meta using (k)",
)
oracle("derive_parent_mass", f"select spectrum_id, {r6('parent_mass')} as parent_mass from parsed join masses using (k)")
oracle("harmonise_undefined", "select spectrum_id, i as inchi, y as inchikey, s as smiles from parsed join harm using (k)")
oracle(
    "repair_identifiers",
    "select spectrum_id, r.inchi, r.inchikey, r.smiles from parsed p join repaired r using (k)",
)
CLEAN = f"select spectrum_id, charge, ion_mode, {r6('parent_mass')} as parent_mass, inchi, inchikey, smiles, {SUMS} from clean join sums using (k)"
oracle("clean_spectra", CLEAN)
oracle("normalise_intensities", f"select spectrum_id, mz, {r6('intensity')} as intensity from normed")
oracle(
    "select_by_mz",
    f"select spectrum_id, mz, {r6('intensity')} as intensity from pk join clean using (k) where mz between 10 and 1000",
)
oracle(
    "require_min_peaks",
    f"""select spectrum_id, cast(count(*) as int) as n_peaks, {r6('sum(mz)')} as sum_mz, {r6('sum(intensity)')} as sum_intensity
    from pk join clean using (k) join enough using (k) where mz between 10 and 1000 group by spectrum_id""",
)
oracle("require_more_than_n_peaks", f"select spectrum_id, {SUMS} from clean join sums using (k) where n_peaks > 3")
oracle("require_structure", "select spectrum_id, inchikey, inchi from structured")
oracle(
    "clean_compound_name",
    """select spectrum_id, case o_orderpriority when '4-NOT SPECIFIED' then Compound_Name
      when '2-HIGH' then replace(Compound_Name, 'F dial M', '')
      else array_to_string(string_split(Compound_Name, ' ')[1:2], ' ') end as compound_name from parsed""",
)
oracle(
    "process_spectra",
    f"""select spectrum_id, inchi, cast(count(*) as int) as n_peaks, {r6('sum(mz)')} as sum_mz, {r6('sum(intensity)')} as sum_intensity
    from (select procpk.*, processed.inchi from procpk join processed using (k)) group by spectrum_id, inchi""",
)
oracle(
    "precursor_completeness",
    f"""select count(*) as n_records, {r6("100 * avg(case when o_orderpriority = '5-LOW' then 0.0 else 1.0 end)")} as present_percentage,
    {r6("100 * avg(case when o_orderpriority in ('5-LOW', '3-MEDIUM') then 0.0 else 1.0 end)")} as filled_percentage from lib""",
)

# Peak words and bins
oracle("peak_words", f"select spectrum_id, word, {r6('weight')} as weight from words")
oracle(
    "create_documents",
    f"select spectrum_id, cast(2 as int) as n_decimals, cast(count(*) as int) as n_words, {r6('sum(weight)')} as sum_weights from words group by spectrum_id having count(*) > 1",
)
oracle(
    "check_n_decimals",
    """select cast(case ion_mode when 'positive' then 2 else 1 end as int) as n_decimals, count(*) as n_documents,
    cast(ion_mode = 'positive' as int) as accepted from clean group by ion_mode""",
)
oracle("power_weights", f"select spectrum_id, word, {r6('pow(weight, 0.5)')} as weight from words")
oracle("bin_peaks", f"select spectrum_id, bin, {r6('value')} as value from bin100")
oracle("inchikey_block", "select substring(inchikey, 1, 14) as key, count(*) as n_spectra from clean group by all")
VOCABULARY = "select bin, cast(row_number() over (order by bin) - 1 as int) as position from (select distinct bin from {})"
oracle(
    "densify_binned",
    f"select spectrum_id, cast((select count(*) from voc) as int) as dim, {r6('sum(value)')} as total, {r6('sum(value * position)')} as weighted_total from bin100 join voc using (bin) group by spectrum_id",
    voc=VOCABULARY.format("bin100"),
)
oracle("fit_bin_vocabulary", "select * from voc", voc=VOCABULARY.format("bin10k"))
NEGATIVE_VOCABULARY = VOCABULARY.format("bin10k where ion_mode = 'negative'")
oracle(
    "transform_to_vocabulary",
    f"select spectrum_id, position, {r6('value')} as value from bin10k join voc using (bin)",
    voc=NEGATIVE_VOCABULARY,
)
oracle(
    "unseen_bin_share",
    f"select spectrum_id, {r6('sum(case when position is null then value else 0 end) / sum(value)')} as unseen_share from bin10k left join voc using (bin) group by spectrum_id",
    voc=NEGATIVE_VOCABULARY,
)
oracle("word_vocabulary", "select word, count(*) as n_occurrences from words group by word")
MODAL = """select key, inchi from (select key, inchi, row_number() over (partition by key order by n desc, inchi) as r
    from (select substring(md5(p_brand || p_type), 1, 14) as key, 'InChI=1S/' || p_size as inchi, count(*) as n from part group by all)) where r = 1"""
oracle("modal_inchi", MODAL)
KNOWN = "select distinct word from words where ion_mode = 'negative'"
MISSING = "100 * sum(case when known.word is null then pow(weight, 0.5) else 0 end) / sum(pow(weight, 0.5))"
oracle(
    "document_coverage",
    "select spectrum_id, round(m, 6) + 0 as missing_percentage, case when m > 5 then 'too_many_missing' else 'ok' end as status from c",
    known=KNOWN,
    c=f"select spectrum_id, {MISSING} as m from words left join known on words.word = known.word group by spectrum_id",
)
oracle(
    "batch_row_counts",
    """select 'raw' as stage, count(*) as n_rows from lib union all select 'parsed', count(*) from parsed
    union all select 'cleaned', count(*) from clean union all select 'processed', count(*) from processed""",
)

# Joins
oracle("precursor_range", "select spectrum_id, precursor_mz from lib where precursor_mz between 200 and 300")
ORACLES["precursor_range_clustered"] = ORACLES["precursor_range"]
oracle(
    "precursor_candidates",
    """select emb.spectrum_id as query_id, lib.spectrum_id as ref_id from emb left join lib
    on lib.ion_mode = emb.ion_mode and lib.precursor_mz between emb.precursor_mz - 1 and emb.precursor_mz + 1""",
)
CANDIDATES = """select q.spectrum_id as query_id, r.spectrum_id as ref_id, q.label as request_id, q.v as qv, r.v as rv, q.label as ql, r.label as rl,
    q.ion_mode from emb q join emb r on q.ion_mode = r.ion_mode and r.precursor_mz between q.precursor_mz - 5 and q.precursor_mz + 5"""
COSINE = "list_dot_product(qv, rv) / (sqrt(list_dot_product(qv, qv)) * sqrt(list_dot_product(rv, rv)))"
oracle(
    "candidate_embeddings",
    f"select query_id, ref_id, {r6('rv[1]')} as first from cand where ion_mode = 'positive'",
    cand=CANDIDATES,
)
oracle(
    "union_candidates",
    """select distinct label as request_id, lib.spectrum_id as ref_id from emb join lib
    on lib.ion_mode = emb.ion_mode and lib.precursor_mz between emb.precursor_mz - 1 and emb.precursor_mz + 1""",
)
SEARCH = {
    "cand": CANDIDATES,
    "scored": f"select query_id, ref_id, {r6(COSINE)} as score from cand",
    "best": "select *, cast(row_number() over (partition by query_id order by score desc, ref_id) as int) as rank from scored",
}
oracle(
    "attach_metadata",
    """select query_id, ref_id, rank, Compound_Name as compound_name, Adduct as adduct, ExactMass as exactmass,
    cast(case when stored.k is null then null else 3 end as int) as n_keys
    from best left join stored on ref_id = stored.spectrum_id where rank <= 10""",
    stored="select * from parsed where k in (select k from clean)",
    **SEARCH,
)


def split(keys: str) -> dict[str, str]:
    return {
        "hashed": f"select key, row_number() over (order by md5('100|' || key), key) - 1 as r, count(*) over () as n from ({keys})",
        "split": """select key, case when r < floor(cast(0.9 as double) * n) then 'training'
          when r < floor(cast(0.9 as double) * n) + floor(cast(0.05 as double) * n) then 'validation' else 'testing' end as split from hashed""",
    }


CLEAN_KEYS = "select distinct substring(inchikey, 1, 14) as key from clean"
oracle(
    "spectra_for_keys",
    "select spectrum_id, key from clean join split on key = substring(inchikey, 1, 14) where split = 'validation'",
    **split(CLEAN_KEYS),
)


def tanimoto(features: str, min_score: float) -> dict[str, str]:
    """Scores of distinct feature sets, each under its smallest key."""
    return {
        "f": f"select distinct key, cast(feature % 2048 as int) as feature from ({features})",
        "sets": "select key, count(*) as n, string_agg(feature, ',' order by feature) as t from f group by key",
        "reps": "select t, min(key) as key, min(n) as n from sets group by t",
        "members": "select sets.key, reps.key as rep from sets join reps using (t)",
        "shared": """select a.key as key_a, b.key as key_b, count(*) as s from f a join f b using (feature)
          where a.key in (select key from reps) and b.key in (select key from reps) group by all""",
        "scores": f"""select * from (select a.key as key_a, b.key as key_b,
          round(coalesce(s, 0) / cast(a.n + b.n - coalesce(s, 0) as double), 5) as score
          from reps a cross join reps b left join shared on key_a = a.key and key_b = b.key) where score >= {min_score}""",
    }


def first_digits(text: str) -> str:
    return f"cast('0x' || substring({text}, 1, 8) as bigint)"


PART_KEY = "substring(md5(p_brand || p_type), 1, 14)"
SUPPLIER_FEATURES = "select cast(l_suppkey as varchar) as key, l_partkey as feature from lineitem"
oracle(
    "labelled_pairs",
    f"""select a.spectrum_id as spectrum_a, s.spectrum_id as spectrum_b, score_bin, score from named a join drawn on a.rep = key_a
      join speakers s on s.rep = key_b and s.turn = {first_digits("md5('100|' || a.spectrum_id || '|' || key_b)")} % s.n""",
    **tanimoto(f"select {PART_KEY} as key, l_suppkey as feature from lineitem join part on l_partkey = p_partkey", 0),
    named=f"""select 'PT' || lpad(cast(p_partkey as varchar), 9, '0') as spectrum_id, rep from part join members on key = {PART_KEY}""",
    numbers=f"""select key, {first_digits("md5('100|' || key)")} % 2147483647 as number from sets""",
    ordered="""select *, (x * x) % 2147483647 as pair_order from (select scores.*, cast(least(floor(score * 10), 9) as int) as score_bin,
      (a.number * 1103515245 + b.number * 69621 + 12345) % 2147483647 as x
      from scores join numbers a on a.key = key_a join numbers b on b.key = key_b)""",
    drawn="""select key_a, key_b, score, score_bin from (select *, row_number() over (partition by key_a, score_bin
      order by pair_order, key_b) as r from ordered) where r = 1""",
    speakers="""select *, count(*) over (partition by rep) as n, row_number() over (partition by rep
      order by md5('100|' || spectrum_id), spectrum_id) - 1 as turn from named""",
)

# Similarity
UNDEFINED = "ql = 0 or rl = 0"
oracle(
    "cosine_pair",
    f"select query_id, ref_id, case when {UNDEFINED} then 0.0 else {r6(COSINE)} end as score from cand",
    cand=CANDIDATES,
)
BEST_OF_ALL = """select query_id, ref_id, score, cast(rank as int) as rank from (select *,
    row_number() over (partition by query_id order by score desc, ref_id) as rank from all_scores) where rank <= 10"""
oracle(
    "cosine_matrix",
    BEST_OF_ALL,
    p="select q.spectrum_id as query_id, r.spectrum_id as ref_id, q.v as qv, r.v as rv from emb q cross join emb r where r.ion_mode = 'positive' and q.label <> 0 and r.label <> 0",
    all_scores=f"select query_id, ref_id, {r6(COSINE)} as score from p",
)
oracle(
    "self_similarity",
    BEST_OF_ALL,
    p="select q.spectrum_id as query_id, r.spectrum_id as ref_id, q.v as qv, r.v as rv from emb q cross join emb r",
    all_scores=f"select query_id, ref_id, {r6(COSINE)} as score from p",
)
oracle(
    "tanimoto_pair",
    f"""select own.key, own.nation, {r6('count(*) / cast(min(n) as double)')} as score from own join sizes using (nation) group by own.key, own.nation""",
    own="""select distinct cast(l_suppkey as varchar) as key, cast(s_nationkey as varchar) as nation, l_partkey % 2048 as feature
      from lineitem join supplier on l_suppkey = s_suppkey""",
    sizes="select nation, count(distinct feature) as n from own group by nation",
)
oracle(
    "tanimoto_matrix",
    """select key_a, key_b, score from scores union all select key, rep, 1 from members where key <> rep
      union all select rep, key, 1 from members where key <> rep""",
    **tanimoto(SUPPLIER_FEATURES, 0.15),
)
oracle(
    "similar_structures",
    """select key_a, key_b, score from (select a.key as key_a, b.key as key_b, round(s / cast(a.n + b.n - s as double), 5) as score
      from shared join reps a on a.key = key_a join reps b on b.key = key_b) where score >= 0.5""",
    **tanimoto("select cast(l_orderkey as varchar) as key, l_partkey as feature from lineitem", 0.5),
)
oracle(
    "fingerprint_bitmap",
    """select w.key, cast(word as int) as word, count(feature) as n_bits,
    cast(coalesce(sum(case when feature % 64 < 32 then pow(2, feature % 64) else 0 end), 0) as bigint) as low_bits
    from (select distinct key, word from f cross join range(32) as r(word)) w
    left join f on f.key = w.key and f.feature // 64 = word group by w.key, word""",
    f=f"select distinct key, cast(feature % 2048 as int) as feature from ({SUPPLIER_FEATURES})",
)
DIGITS = "cast(cast('0x' || substring(md5(word), 2 * cast(d as int) + 1, 2) as int) as double) / 255 - 0.5"
WORD_VECTORS = f"select word, cast(d as int) as dim, {DIGITS} as x from known cross join range(16) as dims(d)"
oracle(
    "weighted_document_vector",
    f"select spectrum_id, dim, {r6('sum(pow(weight, 0.5) * x)')} as value from words join wv using (word) group by spectrum_id, dim",
    known=KNOWN,
    wv=WORD_VECTORS,
)

# Ranking
SCORED = {"cand": CANDIDATES, "scored": f"select query_id, ref_id, {r6(COSINE)} as score from cand where not ({UNDEFINED})"}
oracle("drop_nan_scores", "select query_id, ref_id, score from scored", **SCORED)
oracle(
    "top_n_matches",
    """select query_id, ref_id, score, rank from (select *, cast(row_number() over (partition by query_id order by score desc, ref_id) as int) as rank
    from scored) where rank <= 5""",
    **SCORED,
)
oracle(
    "query_labels",
    """select spectrum_id as request_id, cast(p as int) as query_pos, case p when 1 then 'spectrum-1' else spectrum_id end as query_label
    from parsed, (values (1), (2)) as positions(p)""",
)
oracle("nest_matches", "select query_id, ref_id, score from best where rank <= 10", **SEARCH)

# Chunks and splits
oracle(
    "chunk_by_bytes",
    """select spectrum_id, n_bytes, cast(floor((sum(n_bytes) over (order by spectrum_id rows unbounded preceding) - n_bytes) / 150000) as bigint) as chunk
    from (select spectrum_id, cast(strlen(t) + 1184 as bigint) as n_bytes from lib join texts using (k))""",
    texts=PEAK_TEXT,
)
oracle(
    "chunk_by_bytes_greedy",
    """select spectrum_id, n_bytes, chunk from run join begun on i between first and last""",
    texts=PEAK_TEXT,
    run="""select spectrum_id, n_bytes, row_number() over (order by spectrum_id) as i, sum(n_bytes) over (order by spectrum_id rows unbounded preceding) as upto
      from (select spectrum_id, cast(strlen(t) + 1184 as bigint) as n_bytes from lib join texts using (k))""",
    total="select max(i) as n from run",
    begun="""with recursive r as (
        select cast(0 as bigint) as chunk, cast(1 as bigint) as first, (select coalesce(min(i), max(n)) from total left join run on upto >= 150000) as last
        union all select r.chunk + 1, r.last + 1, coalesce((select min(i) from run where upto >= 150000 + (select upto from run where i = r.last)), (select n from total))
        from r where r.last < (select n from total))
      select * from r""",
)
oracle(
    "chunk_ids",
    "select spectrum_id, cast(floor((row_number() over (order by spectrum_id) - 1) / 1000) as bigint) as chunk from lib",
)
oracle("group_split", "select key, split from split", **split(CLEAN_KEYS))
oracle("flatten_batches", "select spectrum_id, precursor_mz, ion_mode from lib")
LISTED, EMBEDDED = f"select {id_text('l_orderkey')} as spectrum_id from lineitem", f"select {id_text('vec_id')} as spectrum_id from embeddings"
oracle("id_difference", f"{LISTED} except {EMBEDDED}")
oracle("id_union", f"{LISTED} union {EMBEDDED}")
oracle("id_intersection", f"{LISTED} intersect {EMBEDDED}")

# Models: the words and the size of trained vectors; their values depend on the training
oracle("train_word_vectors", f"select distinct {word('mz', 0)} as word, cast(16 as int) as n_dims from normed")
oracle(
    "spec2vec_train",
    f"select distinct {word('mz', 0)} as word, cast(16 as int) as n_dims from normed where ion_mode = 'negative'",
)
oracle(
    "embed_documents",
    f"""select spectrum_id, round(m, 6) + 0 as missing_percentage, case when m > 5 then 'too_many_missing' else 'ok' end as status,
    {r6('coalesce(a, 0)')} as v0, {r6('coalesce(b, 0)')} as v15 from c left join v using (spectrum_id)""",
    known=KNOWN,
    c=f"select spectrum_id, {MISSING} as m from words left join known on words.word = known.word group by spectrum_id",
    wv=WORD_VECTORS,
    v="""select spectrum_id, sum(case dim when 0 then pow(weight, 0.5) * x else 0 end) as a,
      sum(case dim when 15 then pow(weight, 0.5) * x else 0 end) as b from words join wv using (word) group by spectrum_id""",
)


def weight(i: str, j: str) -> str:
    return f"((({i} * 7 + {j} * 13) % 11 - 5) / cast(10 as double))"


NETWORK = {
    "voc": VOCABULARY.format("bin100"),
    "hidden": f"""select spectrum_id, ion_mode, j, greatest(sum(value * {weight('position', 'j')}) + (j % 3) / cast(10 as double), 0) as h
      from bin100 join voc using (bin) cross join range(6) as units(j) group by spectrum_id, ion_mode, j""",
    "out": f"""select spectrum_id, ion_mode, cast(d as int) as dim, {r6(f"sum(h * {weight('j', 'd')}) + (d % 3) / cast(10 as double)")} as value
      from hidden cross join range(4) as dims(d) group by spectrum_id, ion_mode, d""",
}
oracle("embed_binned", "select spectrum_id, dim, value from out", **NETWORK)

# End to end
oracle("prepare_library", CLEAN + " where ion_mode = 'positive'")
ALL_VECTORS = {
    "known": "select distinct word from words",
    "wv": WORD_VECTORS,
    "dims": "select spectrum_id, dim, sum(pow(weight, 0.5) * x) as x from words join wv using (word) group by spectrum_id, dim",
    "docs": "select spectrum_id, list(x order by dim) as v from dims group by spectrum_id",
}
oracle(
    "spec2vec_index",
    f"select 'spec2vec' as project, ion_mode, spectrum_id, {r6('v[1]')} as first, cast(1 as bigint) as n_stored from docs join clean using (spectrum_id) where ion_mode = 'positive'",
    **ALL_VECTORS,
)
oracle(
    "spec2vec_search",
    BEST_OF_ALL,
    **ALL_VECTORS,
    side="select spectrum_id, precursor_mz, ion_mode, v from docs join clean using (spectrum_id)",
    p="""select q.spectrum_id as query_id, r.spectrum_id as ref_id, q.v as qv, r.v as rv from side q join side r
      on q.ion_mode = r.ion_mode and r.precursor_mz between q.precursor_mz - 1 and q.precursor_mz + 1""",
    all_scores=f"select query_id, ref_id, {r6(COSINE)} as score from p",
)
oracle("embedding_search", "select query_id, ref_id, score, rank from best where rank <= 10", **SEARCH)
oracle(
    "ms2ds_prepare",
    """select 'binned' as part, count(*) as n_rows from processed
    union all select 'vocabulary', count(distinct bin) from bin100
    union all select split, count(*) from split group by split
    union all select 'training spectra', count(*) from processed join split on key = substring(inchikey, 1, 14) where split = 'training'""",
    **split("select distinct substring(inchikey, 1, 14) as key from processed"),
)
oracle(
    "ms2ds_index",
    "select 'ms2deepscore' as project, ion_mode, spectrum_id, dim, value from out where ion_mode = 'negative'",
    **NETWORK,
)
oracle(
    "ms2ds_search",
    BEST_OF_ALL,
    wanted="select distinct q.label as request_id, r.spectrum_id from emb q join emb r on q.ion_mode = r.ion_mode and r.precursor_mz between q.precursor_mz - 5 and q.precursor_mz + 5",
    p="""select q.spectrum_id as query_id, r.spectrum_id as ref_id, q.v as qv, r.v as rv from emb q join wanted on q.label = request_id
      join emb r on r.spectrum_id = wanted.spectrum_id and r.ion_mode = q.ion_mode""",
    all_scores=f"select query_id, ref_id, {r6(COSINE)} as score from p",
)
