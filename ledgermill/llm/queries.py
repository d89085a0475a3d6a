"""The registered queries of the text operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, licenses, lines, minhash, packing, pages, ranked, sharding, spelling, topk, toxicity, vectors
from ..sources.shipping import ship_package

SHARDS = [f"shard-{i:02d}" for i in range(64)]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Component of each document under 80 % shared four-word shingles."""
    return minhash.near_duplicates(_table(spark, folder, "documents"), width=4, percent=80)


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each document without later copies of runs of lines."""
    left = lines.without_repeated_runs(_table(spark, folder, "documents"))
    return left.select("doc_id", "lines_before", "lines_removed", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars"),
                       F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard of each document among 64."""
    return sharding.assign_shards(_table(spark, folder, "documents").select("doc_id"), SHARDS)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of each document, learned from labelled rows that are not held out."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    learn = labels.where(_remainder("doc_id", 4) != 2).select("doc_id", "toxic").where("toxic IN (0, 1)").orderBy(
        F.xxhash64(F.col("doc_id").cast("string")), "toxic").limit(toxicity.FIT_ROWS)
    model = toxicity.fit(docs.select("doc_id", "text").join(F.broadcast(learn), "doc_id"))
    return toxicity.score(docs, model).select(
        "doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_near_duplicate_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of vectors of one label with a cosine of 0.93 or more."""
    return vectors.near_duplicate_vectors(_table(spark, folder, "embeddings"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of each document, learned from rows that are not held out."""
    docs = _table(spark, folder, "documents")
    model = language.fit(docs.where(_remainder("doc_id", 5) != 0).select("doc_id", "text", "lang"))
    return language.predict(docs, model).select(
        "doc_id", (_remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents hold benchmark items, exactly or with other parameters."""
    return decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Bin and place of each piece of each document."""
    return packing.pack(_table(spark, folder, "documents"))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices of each document."""
    return licenses.license_scan(_table(spark, folder, "documents"))


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    table = _table(spark, folder, "pages")
    return pages.main_text(table, pages.fit(table))


def op11_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 vectors of highest inner product with each vector whose id is divisible by 100."""
    table = _table(spark, folder, "embeddings")
    return topk.top_neighbours(table, table.where("vec_id % 100 = 0"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Usual spelling of each word of the documents."""
    return spelling.spelling_variants(_table(spark, folder, "documents"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of each benchmark item by their weighted terms."""
    return ranked.ranked_search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def _remainder(column: str, n: int) -> Column:
    """crc32 of an id as text, modulo `n`; 0 if the id is null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0))


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _ready(query) for name, query in _QUERIES.items()}


_QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_line_dedup": op2_line_dedup,
    "op3_sharding": op3_sharding,
    "op4_toxicity": op4_toxicity,
    "op5_near_duplicate_vectors": op5_near_duplicate_vectors,
    "op6_language": op6_language,
    "op7_decontamination": op7_decontamination,
    "op8_packing": op8_packing,
    "op9_licenses": op9_licenses,
    "op10_main_text": op10_main_text,
    "op11_topk_search": op11_topk_search,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_ranked_search": op13_ranked_search,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_duplicates": _OP1,
        "op2_line_dedup": _OP2,
        "op5_near_duplicate_vectors": _OP5,
        "op7_decontamination": _OP7,
        "op9_licenses": _OP9,
        "op11_topk_search": _OP11,
        "op12_spelling_variants": _OP12,
        "op13_ranked_search": _OP13,
    }


_OP1 = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM texts
), entries AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM entries x JOIN entries y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * c >= 80 * (len(x.s) + len(y.s) - c)
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM sets JOIN reach ON id = doc_id GROUP BY doc_id, s
"""

_OP5 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.93
), reach(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, min(other) AS component_id,
  e.vec_id = min(other) AS kept
FROM embeddings e JOIN reach ON id = e.vec_id GROUP BY e.vec_id
"""

# A line lies in a repeated run of 50 words exactly if it lies in a repeated shortest run from a line on, or up to a line,
# or in a repeated pair of lines that have 50 words each.
_OP2 = f"""
WITH lines AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
    regexp_replace(unnest(string_split(text, chr(10))), '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS line
  FROM documents
), counted AS (
  SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM lines WHERE line <> ''
), running AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS nth
  FROM counted
), ends AS (
  SELECT b.doc_id, b.nth AS first_nth, min(e.nth) AS last_nth
  FROM running b JOIN running e ON e.doc_id = b.doc_id AND e.nth >= b.nth AND e.upto - b.upto + b.words >= {lines.RUN_WORDS}
  GROUP BY b.doc_id, b.nth
  UNION SELECT e.doc_id, max(b.nth), e.nth
  FROM running b JOIN running e ON e.doc_id = b.doc_id AND e.nth >= b.nth AND e.upto - b.upto + b.words >= {lines.RUN_WORDS}
  GROUP BY e.doc_id, e.nth
  UNION SELECT b.doc_id, b.nth, e.nth
  FROM running b JOIN running e ON e.doc_id = b.doc_id AND e.nth = b.nth + 1 AND least(b.words, e.words) >= {lines.RUN_WORDS}
), runs AS (
  SELECT e.doc_id, min(r.pos) AS start, max(r.pos) AS stop, string_agg(r.line, chr(10) ORDER BY r.pos) AS run
  FROM ends e JOIN running r ON r.doc_id = e.doc_id AND r.nth BETWEEN first_nth AND last_nth GROUP BY e.doc_id, first_nth, last_nth
), firsts AS (SELECT run, min({{'d': doc_id, 's': start, 'e': stop}}) AS f FROM runs GROUP BY run HAVING count(*) > 1),
later AS (
  SELECT doc_id, start, stop FROM runs JOIN firsts USING (run) WHERE doc_id <> f.d OR start > f.e
), gone AS (
  SELECT DISTINCT l.doc_id, l.pos FROM lines l JOIN later r ON r.doc_id = l.doc_id AND l.pos BETWEEN r.start AND r.stop
), lost AS (SELECT doc_id, list(pos) AS g FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0) AS lines_before, coalesce(len(g), 0) AS lines_removed,
    coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(coalesce(g, []), i - 1)),
      chr(10)), '') AS left_over
  FROM documents d LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, CAST(lines_before AS BIGINT) AS lines_before, CAST(lines_removed AS BIGINT) AS lines_removed, length(left_over) AS chars, md5(left_over) AS text_md5
FROM kept
"""


def _sql_marked(text: str) -> str:
    for pattern, into in decontaminate.marks("*"):
        text = f"regexp_replace({text}, '{pattern}', '{into.replace('$1', chr(92) + '1').replace('$2', chr(92) + '2')}', 'g')"
    return text


_PATTERN, _INTO = decontaminate.TYPES
_TEMPLATE = (f"list_filter(regexp_split_to_array(lower(regexp_replace(marked, '{_PATTERN}', "
             f"'{_INTO.replace('$1', chr(92) + '1')}', 'g')), '{decontaminate.NOT_WORDS}'), lambda x: x <> '')")
_AS_WORD = f"CASE WHEN starts_with(x, '{decontaminate.START}') THEN x[2:] ELSE x END"
_AS_NAME = f"CASE WHEN starts_with(x, '{decontaminate.START}') THEN '{decontaminate.OPEN}p' ELSE x END"
_PLAIN = f"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{decontaminate.NOT_PLAIN}'), lambda x: x <> '') AS t"
_OP7 = f"""
WITH docs AS (
  SELECT doc_id, {_sql_marked("coalesce(text, '')")} AS marked, {_PLAIN} FROM documents
), items AS (
  SELECT DISTINCT item_id, {_sql_marked("coalesce(text, '')")} AS marked, {_PLAIN} FROM benchmark
), doc_windows AS (
  SELECT DISTINCT doc_id, i AS pos, array_to_string(t[i + 1:i + {decontaminate.WINDOW}], ' ') AS w
  FROM (SELECT doc_id, t, unnest(range(len(t) - {decontaminate.WINDOW} + 1)) AS i FROM (SELECT doc_id, list_transform({_TEMPLATE}, lambda x: {_AS_NAME}) AS t FROM docs))
), item_windows AS (
  SELECT DISTINCT item_id, named, i AS pos, array_to_string(t[i + 1:i + {decontaminate.WINDOW}], ' ') AS w
  FROM (SELECT item_id, named, t, unnest(range(len(t) - {decontaminate.WINDOW} + 1)) AS i FROM (
    SELECT item_id, true AS named, list_transform({_TEMPLATE}, lambda x: {_AS_NAME}) AS t FROM items
    UNION ALL SELECT item_id, false, list_transform({_TEMPLATE}, lambda x: {_AS_WORD}) FROM items))
  WHERE len(list_filter(t[i + 1:i + {decontaminate.WINDOW}], lambda x: NOT starts_with(x, '{decontaminate.OPEN}'))) >= {decontaminate.LITERAL_WORDS}
), sizes AS (SELECT item_id, count(DISTINCT pos) AS windows FROM item_windows WHERE named GROUP BY item_id),
runs AS (
  SELECT doc_id, i.item_id, d.pos - i.pos AS off, list(DISTINCT i.pos) AS ats
  FROM doc_windows d JOIN item_windows i USING (w) GROUP BY doc_id, i.item_id, d.pos - i.pos
), long_runs AS (
  SELECT r.* FROM runs r JOIN sizes s USING (item_id) WHERE len(ats) >= least({decontaminate.HIT_WINDOWS}, s.windows)
), places AS (
  SELECT DISTINCT doc_id, item_id, off, a + k AS p
  FROM (SELECT doc_id, item_id, off, unnest(ats) AS a FROM long_runs), range({decontaminate.WINDOW}) AS r(k)
), pairs AS (
  SELECT p.doc_id, p.item_id, off, regexp_extract_all(i.marked, '{decontaminate.VALUES}')[p + 1] AS own,
    regexp_extract_all(d.marked, '{decontaminate.VALUES}')[p + off + 1] AS found
  FROM places p JOIN items i USING (item_id) JOIN docs d ON d.doc_id = p.doc_id
), slots AS (
  SELECT doc_id, item_id, off, count(*) AS n, count(DISTINCT own) AS a, count(DISTINCT found) AS b FROM (
    SELECT DISTINCT doc_id, item_id, off, lower(regexp_replace(own, '{decontaminate.BARE}', '', 'g')) AS own,
      lower(regexp_replace(found, '{decontaminate.BARE}', '', 'g')) AS found
    FROM pairs WHERE regexp_matches(own, '^[{decontaminate.OPEN}{decontaminate.START}]'))
  GROUP BY doc_id, item_id, off
), hits AS (
  SELECT r.doc_id, r.item_id, len(ats) AS n FROM long_runs r LEFT JOIN slots s USING (doc_id, item_id, off)
  WHERE s.n IS NULL OR (s.n = s.a AND s.n = s.b)
  UNION ALL
  SELECT d.doc_id, i.item_id, greatest(len(i.t) - {decontaminate.WINDOW} + 1, 1)
  FROM docs d JOIN items i ON len(i.t) > 0 AND i.item_id NOT IN (SELECT item_id FROM sizes)
    AND contains(' ' || array_to_string(d.t, ' ') || ' ', ' ' || array_to_string(i.t, ' ') || ' ')
    AND (len(i.t) >= {decontaminate.ANYWHERE_WORDS} OR len(i.t) = len(d.t))
), best AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, min({{'fewer': -n, 'item_id': item_id}}) AS b FROM hits GROUP BY doc_id
)
SELECT d.doc_id, b IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, b.item_id AS item_id,
  CAST(coalesce(-b.fewer, 0) AS BIGINT) AS n_windows
FROM documents d LEFT JOIN best USING (doc_id)
"""

_WORDS = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"


def _sql_places(phrase: str) -> str:
    test = " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(phrase.split()))
    return f"list_filter(range(len(w)), lambda i: {test})"


_SPAN = licenses.line_span(licenses.TEMPLATES)
# Blocks are lines, and the words before and after each line end.
_OP9 = f"""
WITH notices(label, n, w) AS (
  VALUES {", ".join(f"('{label}', {n}, list_distinct(string_split('{text}', ' ')))" for n, (label, text) in enumerate(licenses.TEMPLATES))}
), low AS (SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
texts AS (SELECT doc_id, r, t, regexp_extract_all(t, {_WORDS}) AS w FROM low),
base AS (
  SELECT doc_id, r, len(w) AS n_words, {", ".join(f"{_sql_places(p)} AS p{i}" for i, p in enumerate(licenses.PHRASES))} FROM texts
), marked AS (
  SELECT r, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+|\n') AS m FROM low
), single AS (SELECT r, list_filter(m, lambda x, i: x <> chr(10) OR i = 1 OR m[i - 1] <> chr(10)) AS m FROM marked),
around AS (SELECT r, m, unnest(list_filter(range(1, len(m) + 1), lambda i: m[i] = chr(10))) AS i FROM single),
blocks AS (
  SELECT r, 'line ' || pos AS block, list_distinct(regexp_extract_all(line, {_WORDS})) AS w
  FROM (SELECT r, generate_subscripts(string_split(t, chr(10)), 1) AS pos, unnest(string_split(t, chr(10))) AS line FROM low)
  UNION ALL
  SELECT r, 'end ' || i, list_distinct(list_filter(list_concat(m[greatest(i - {_SPAN}, 1):i - 1],
    list_filter(m[i + 1:i + {2 * _SPAN}], lambda x: x <> chr(10))[1:{_SPAN}]), lambda x: x <> chr(10))) FROM around
), alike AS (
  SELECT r, block, n, label, list_intersect(b.w, s.w) AS hits, len(list_intersect(b.w, s.w)) / len(s.w) AS share
  FROM blocks b, notices s WHERE len(list_intersect(b.w, s.w)) >= greatest(1, ceil(len(s.w) * {licenses.THRESHOLD} - 1e-9))
), close AS (
  SELECT r, list(DISTINCT label) AS labels FROM alike a WHERE NOT EXISTS (
    SELECT 1 FROM alike b WHERE b.r = a.r AND b.block = a.block AND b.share > a.share AND list_has_all(b.hits, a.hits)) GROUP BY r
), more AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS share FROM alike GROUP BY r),
own AS (
  SELECT *, list_concat({", ".join(f"p{i}" for i in range(len(licenses.PHRASES)))}) AS p,
    list_filter([{", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, label in enumerate(licenses.PHRASES.values()))}],
      lambda x: x IS NOT NULL) AS labels
  FROM base
)
SELECT o.doc_id, n_words, CAST(len(p) AS BIGINT) AS n_base, list_min(p) AS first_word, list_max(p) AS last_word,
  array_to_string(list_sort(o.labels), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(o.labels, coalesce(m.labels, [])))), ',') AS labels,
  CASE WHEN len(p) > 0 THEN 1.0 ELSE coalesce(m.share, 0.0) END::DOUBLE AS score,
  coalesce(array_to_string(list_sort(c.labels), ','), '') AS closest
FROM own o LEFT JOIN more m USING (r) LEFT JOIN close c USING (r)
"""

_OP13 = f"""
WITH found AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents
), docs AS (SELECT *, len(t) AS n FROM found WHERE len(t) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM docs),
items AS (
  SELECT DISTINCT item_id, unnest(list_distinct(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))) AS term FROM benchmark
), held AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals
), scored AS (
  SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
  FROM items JOIN held USING (term) JOIN weights USING (term) JOIN docs USING (r), totals GROUP BY item_id, doc_id, r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {ranked.TOP}
"""

_OP11 = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor({topk.SCALE} * x) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {topk.TOP}
"""

# The hash is computed byte by byte with a table that is itself made by its rule; near words are those that share a
# word less one letter at the same place, or of which one is the other less a letter.
_OP12 = f"""
WITH RECURSIVE steps AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS step
), runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
  ) WHERE length(run) >= {spelling.LEAST_LETTERS} GROUP BY doc_id, run
), bytes AS (
  SELECT doc_id, run, times, list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'),
    lambda x: CAST(CAST('0x' || x AS INTEGER) AS BIGINT)) AS b FROM runs
), hashed AS (
  SELECT doc_id, run, times, xor(list_reduce(b, lambda c, x: xor(step[xor(c, x) % 256 + 1], c >> 8), 4294967295), 4294967295) AS h
  FROM bytes, steps
), words AS (
  SELECT w AS word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {spelling.DAMAGED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS w, times
    FROM hashed
  ) WHERE length(w) >= {spelling.LEAST_LETTERS} GROUP BY w HAVING sum(times) >= {spelling.LEAST_COUNT}
), less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, min({{'fewer': -near_n, 'near': near}}) AS b FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.fewer >= {spelling.FORM_FACTOR} * w.n THEN b.near END AS form,
    CASE WHEN -b.fewer >= {spelling.FORM_FACTOR} * w.n THEN -b.fewer END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain(word, here, further) AS (
  SELECT word, word, form FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.further
)
SELECT f.word, f.form, c.here AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.further IS NULL
"""
