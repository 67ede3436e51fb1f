"""One query per operator of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from specloom.llm.chat_format import END, PROBE, START, TRAINED_ROLE, format_digest, with_probe
from specloom.llm.decontaminate import benchmark_copies
from specloom.llm.jaccard_join import jaccard_classes
from specloom.llm.language_id import identify_languages
from specloom.llm.line_dedup import line_digest
from specloom.llm.merge_dropout import encode
from specloom.llm.nn_descent import nearest_neighbours
from specloom.llm.pii import pseudonymise
from specloom.llm.runtime import prepared
from specloom.llm.shared_search import shared_search
from specloom.llm.substring_dedup import substring_digest
from specloom.llm.toxicity import toxicity
from specloom.llm.url_trust import url_verdicts
from specloom.llm.whitening import whiten

QUERIES = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn):
    def run(spark, sf_dir) -> DataFrame:
        return fn(prepared(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_line_dedup(spark, sf_dir):
    return line_digest(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("features")


@query
def op3_sentencepiece_merge_dropout(spark, sf_dir):
    return encode(table(spark, sf_dir, "documents"), check=True)


@query
def op4_nn_descent(spark, sf_dir):
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), "id % 50 = 0")


@query
def op5_substring_dedup(spark, sf_dir):
    return substring_digest(table(spark, sf_dir, "documents"))


@query
def op6_url_trust(spark, sf_dir):
    return url_verdicts(table(spark, sf_dir, "pages")).drop("trust", "distrust")


@query
def op7_benchmark_decontamination(spark, sf_dir):
    return benchmark_copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_ngram_jaccard_join(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark, sf_dir):
    return identify_languages(table(spark, sf_dir, "documents"))


@query
def op10_pii_pseudonyms(spark, sf_dir):
    return pseudonymise(table(spark, sf_dir, "documents"), key="specloom")


@query
def op11_shared_search(spark, sf_dir):
    return shared_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_chat_format(spark, sf_dir):
    return format_digest(with_probe(table(spark, sf_dir, "conversations")))


@query
def op13_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))


WORDS = "list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

# {items}: a list of each text's items; {n}: items of a window; {later}: that a window starts earlier; {join}: what joins items.
REPEATS = """
WITH items AS (SELECT doc_id, coalesce(text, '') AS text, {items} AS w FROM documents
), places AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS item FROM items
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - {n} + 2)) AS p, unnest(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n} - 1], chr(10)))) AS s
  FROM items WHERE len(w) >= {n}
), marked AS (SELECT doc_id, p FROM (SELECT doc_id, p, {first} AS f FROM windows) WHERE {later}
), gone AS (SELECT DISTINCT doc_id, p + k AS p FROM marked, range({n}) r(k)
), kept AS (
  SELECT doc_id, string_agg(item, '{join}' ORDER BY p) AS text, count(*) AS n FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
"""

TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
# A text, or a role whose backslashes and line ends are escaped, without control strings.
ESCAPED = "regexp_replace({text}, '<(\\\\*)\\|', '<\\1\\\\|', 'g')"

ORACLES = {
    "op11_shared_search": f"""
WITH texts AS (SELECT row_number() OVER () AS d, doc_id, {TERMS} AS w FROM documents
), docs AS (SELECT d, doc_id, w, len(w) AS n FROM texts WHERE len(w) > 0
), size AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs
), tf AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM docs) GROUP BY d, t
), df AS (SELECT t, count(*) AS df FROM tf GROUP BY t
), items AS (SELECT row_number() OVER () AS i, item_id, unnest({TERMS}) AS t FROM benchmark
), parts AS (
  SELECT i, item_id, d, doc_id, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS s
  FROM items JOIN tf USING (t) JOIN df USING (t) JOIN docs USING (d), size
), scores AS (SELECT i, item_id, d, doc_id, CAST(sum(s) AS BIGINT) AS score FROM parts GROUP BY ALL HAVING sum(s) > 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
    "op12_chat_format": f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, '{TRAINED_ROLE}', '{PROBE}'
), cut AS (
  SELECT conv_id, turn, role, text, {ESCAPED.format(text="text")} AS content,
    {ESCAPED.format(text="replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')")} AS head FROM given
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, content) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, content) FILTER (role = '{TRAINED_ROLE}'), '') AS loss,
    sum(length(head) + length(content) + {len(START) + 1 + len(END)}) AS formatted_chars
  FROM cut GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars FROM whole
""",
    "op1_line_dedup": REPEATS.format(
        items="string_split(coalesce(text, ''), chr(10))",
        n=3,
        first="min((doc_id, p)) OVER (PARTITION BY s)",
        later="f < (doc_id, p)",
        join="' || chr(10) || '",
    )
    + """SELECT i.doc_id, CAST(CASE WHEN i.text = '' THEN 0 ELSE len(i.w) END AS BIGINT) AS n_lines,
  CAST(CASE WHEN i.text = '' THEN 0 ELSE len(i.w) END - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM items i LEFT JOIN kept k ON k.doc_id = i.doc_id""",
    "op5_substring_dedup": REPEATS.format(
        items=WORDS.format(text="coalesce(text, '')"), n=13, first="min(doc_id) OVER (PARTITION BY s)", later="f < doc_id", join=" "
    )
    + """SELECT i.doc_id, CAST(len(i.w) AS BIGINT) AS n_words, CAST(len(i.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256 FROM items i LEFT JOIN kept k ON k.doc_id = i.doc_id""",
    "op8_ngram_jaccard_join": f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM words
), items AS (SELECT doc_id, unnest(s) AS item, len(s) AS n FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), smallest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id FROM sets s JOIN smallest m ON m.a = s.doc_id
""",
}
