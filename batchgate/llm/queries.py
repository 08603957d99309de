"""Registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.llm import (
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    parity_join,
    periodic_runs,
    records,
    token_counts,
    toxicity,
    whitening,
    winnowing,
)
from batchgate.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(ship(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


LINE_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no
  FROM documents WHERE text IS NOT NULL
), cut_lines AS (SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w FROM lines),
words AS (SELECT doc_id, no, unnest(w) AS word, unnest(range(len(w))) AS i FROM cut_lines WHERE len(w) > {line_dedup.LONG}),
ranked AS (SELECT *, lpad(length(word)::VARCHAR, 9, '0') || word AS r FROM words),
best AS (
  SELECT doc_id, no, i, word,
    r > coalesce(max(r) OVER (l ROWS BETWEEN {line_dedup.REACH} PRECEDING AND 1 PRECEDING), '')
    AND r >= coalesce(max(r) OVER (l ROWS BETWEEN 1 FOLLOWING AND {line_dedup.REACH} FOLLOWING), '') AS ends
  FROM ranked WINDOW l AS (PARTITION BY doc_id, no ORDER BY i)
), placed AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id, no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part
  FROM best
), parts AS (
  SELECT doc_id, no, part, string_agg(word, ' ' ORDER BY i) AS said, true AS long FROM placed GROUP BY doc_id, no, part
  UNION ALL SELECT doc_id, no, 0, line, false FROM cut_lines WHERE len(w) <= {line_dedup.LONG}
), numbered AS (
  SELECT *, long || ' ' || said AS name, row_number() OVER (PARTITION BY doc_id ORDER BY no, part) AS pos FROM parts
), windows AS (
  SELECT doc_id, pos, name AS a, lead(name) OVER d AS b, lead(name, 2) OVER d AS c
  FROM numbered WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos FROM windows WHERE c IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) > 1
), covered AS (
  SELECT DISTINCT doc_id, pos + step AS pos FROM later, (VALUES (0), (1), (2)) AS s (step)
), told AS (
  SELECT n.doc_id, n.no, count(*) AS n_parts, count(c.pos) AS n_gone,
    string_agg(said, ' ' ORDER BY n.pos) FILTER (WHERE c.pos IS NULL) AS rest
  FROM numbered n LEFT JOIN covered c ON n.doc_id = c.doc_id AND n.pos = c.pos GROUP BY n.doc_id, n.no
), cut AS (
  SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE n_gone = n_parts) AS removed_lines,
    coalesce(string_agg(CASE WHEN n_gone = 0 THEN line ELSE rest END, chr(10) ORDER BY l.no)
      FILTER (WHERE n_gone < n_parts), '') AS text
  FROM lines l JOIN told t ON l.doc_id = t.doc_id AND l.no = t.no GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(removed_lines, 0) AS removed_lines, cut.text
FROM documents d LEFT JOIN cut ON d.doc_id = cut.doc_id
"""


@query("op1_line_dedup", LINE_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "removed_lines", "text")


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model)


@query("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(table(spark, sf_dir, "documents"), model, special_tokens=True)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.flag(docs, labels)


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("contaminated", F.size("item_ids") > 0)


_NOTICES = ", ".join(
    "({}, '{}', '{}')".format(i, name, notice.replace("'", "''")) for i, (name, notice) in enumerate(licenses.TEMPLATES)
)
_TERMS = f"regexp_extract_all(lower(%s), '{licenses.TERM}')"
_UNKNOWN = f"ln(1 + {len(licenses.TEMPLATES)}) + 1"
LICENSE_SQL = f"""
WITH notices (template, license, notice) AS (VALUES {_NOTICES}),
known AS (
  SELECT template, license, term, count(*) AS n
  FROM (SELECT template, license, unnest({_TERMS % "notice"}) AS term FROM notices) GROUP BY template, license, term
),
weights AS (SELECT term, ln((1 + {len(licenses.TEMPLATES)})::DOUBLE / (1 + count(*))) + 1 AS w FROM known GROUP BY term),
templates AS (SELECT template, sqrt(sum(n * w * w)) AS norm FROM known JOIN weights USING (term) GROUP BY template),
cuts AS (
  SELECT doc_id, 'line' AS kind, string_split(text, chr(10)) AS parts FROM documents
  UNION ALL SELECT doc_id, 'block', string_split_regex(text, '{licenses.BLOCK}') FROM documents
  UNION ALL SELECT doc_id, 'paragraph', string_split_regex(text, '{licenses.PARAGRAPH}') FROM documents
  UNION ALL SELECT doc_id, 'whole', [text] FROM documents
),
units AS (SELECT doc_id, kind, unnest(parts) AS said, unnest(range(len(parts))) AS place FROM cuts),
words AS (
  SELECT doc_id, kind, place, term, count(*) AS n
  FROM (SELECT doc_id, kind, place, unnest({_TERMS % "said"}) AS term FROM units) GROUP BY ALL
),
sizes AS (
  SELECT doc_id, kind, place, sqrt(sum(words.n * coalesce(w * w, pow({_UNKNOWN}, 2)))) AS size
  FROM words LEFT JOIN weights USING (term) GROUP BY doc_id, kind, place
),
dots AS (
  SELECT doc_id, kind, place, template, license, sum(sqrt(words.n) * sqrt(known.n) * w * w) AS dot
  FROM words JOIN known USING (term) JOIN weights USING (term)
  GROUP BY doc_id, kind, place, template, license HAVING count(*) > 1
),
near AS (
  SELECT doc_id, place, license, round(dot / (size * norm), 6) AS cosine
  FROM dots JOIN sizes USING (doc_id, kind, place) JOIN templates USING (template)
),
own AS (
  SELECT doc_id, license, cosine, min(place) OVER (PARTITION BY doc_id) = 0 AS declares
  FROM near WHERE cosine >= 0.7
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) = 1
),
files AS (
  SELECT doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS folder FROM (
    SELECT doc_id, CASE
      WHEN doc_id % 16 = 0 THEN concat_ws('/', source, doc_id || '.txt')
      WHEN doc_id % 4 = 0 THEN concat_ws('/', source, lang, doc_id || '.txt')
      ELSE concat_ws('/', source, lang, doc_id // 256, doc_id || '.txt') END AS path
    FROM documents)
),
said AS (
  SELECT folder AS above, license AS given FROM files JOIN own USING (doc_id) WHERE declares
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY cosine DESC, license, path) = 1
),
up AS (
  SELECT folder, n, array_to_string(string_split(folder, '/')[1:n], '/') AS above
  FROM (SELECT folder, unnest(range(len(string_split(folder, '/')) + 1)) AS n FROM (SELECT DISTINCT folder FROM files))
),
nearest AS (
  SELECT folder, above, given FROM up JOIN said USING (above)
  QUALIFY row_number() OVER (PARTITION BY folder ORDER BY n DESC) = 1
)
SELECT f.doc_id, f.path, coalesce(o.license, n.given) AS license, o.cosine,
  CASE WHEN o.license IS NOT NULL THEN 'own' WHEN n.given IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN o.license IS NULL THEN n.above END AS license_dir
FROM files f LEFT JOIN own o ON f.doc_id = o.doc_id LEFT JOIN nearest n ON f.folder = n.folder
"""


@query("op7_licenses", LICENSE_SQL)
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree of sources, languages and shelves of 256; some lie higher up in it."""
    docs = table(spark, sf_dir, "documents")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    shelf = F.floor(F.col("doc_id") / 256).cast("string")
    path = (
        F.when(F.col("doc_id") % 16 == 0, F.concat_ws("/", "source", name))
        .when(F.col("doc_id") % 4 == 0, F.concat_ws("/", "source", "lang", name))
        .otherwise(F.concat_ws("/", "source", "lang", shelf, name))
    )
    return licenses.scan(docs.withColumn("path", path)).withColumnRenamed("id", "doc_id")


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints as text, and likenesses of the edited text and of the next document; an empty table gives no rows."""
    found = winnowing.compared(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        winnowing.as_string(F.col("prints")).alias("fingerprint"),
        winnowing.as_string(F.col("edited_prints")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    learned = language_id.prototypes(docs.where(~held_out).select("text", "lang"))
    found = language_id.identify(docs.select("doc_id", "text"), learned)
    return found.withColumn("held_out", held_out)


@query("op10_binary_records")
def op10_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("word_bpe_49k.json")
    manifest = records.write_records(table(spark, sf_dir, "documents"), model, special_tokens=True)
    return records.read_records(manifest).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


_CRC32 = """
  SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS bytes"""
RUN_SQL = f"""
WITH crc AS ({_CRC32}),
texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda c, b: xor(c >> 8, crc.bytes[1 + (xor(c, b) & 255)])), 4294967295) AS h
  FROM documents, crc
), sized AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM texts),
parts AS (
  SELECT doc_id, w, n, h, CASE WHEN n > 0 THEN g % n END AS a, CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p
  FROM sized
), words AS (
  SELECT doc_id, n, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM parts)
), equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS p FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), stretches AS (
  SELECT doc_id, p, min(i) AS start, count(*) + p AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM equal)
  GROUP BY doc_id, p, island HAVING count(*) + p >= greatest(6, 4 * p)
), runs AS (SELECT doc_id, start, length, min(p) AS period FROM stretches GROUP BY doc_id, start, length),
best AS (
  SELECT doc_id, start, length, period FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
), listed AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said
  FROM runs GROUP BY doc_id
), dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.i) FILTER (WHERE d.i IS NULL) AS text
  FROM words w LEFT JOIN dropped d ON w.doc_id = d.doc_id AND w.i = d.i GROUP BY w.doc_id
)
SELECT s.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM sized s LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _with_periods(docs: DataFrame) -> DataFrame:
    """Documents, a tenth of which, by their ids, repeat some of their words up to the end."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")
    rows = docs.select("doc_id", "text", words.alias("w"), F.crc32(F.col("doc_id").cast("string")).alias("h"))
    rows = rows.withColumn("g", F.floor(F.col("h") / 10)).withColumn("n", F.size("w"))
    rows = rows.withColumn("a", F.expr("cast(g % nullif(n, 0) as int)"))
    rows = rows.withColumn("p", F.expr("cast(1 + floor((n - a) / (3 + g % 8)) as int)"))
    turned = "concat(slice(w, 1, a), transform(sequence(a, n - 1), i -> w[a + (i - a) % p]))"
    turned = F.expr(f"case when h % 10 = 0 and n > 0 then array_join({turned}, ' ') else text end")
    return rows.select("doc_id", turned.alias("text"))


@query("op11_periodic_runs", RUN_SQL)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(_with_periods(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))
    said = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    said = F.concat(F.array_join(said, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    found = found.withColumn("best", longest["run"])
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}") for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(said, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


LINK_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words
), elements AS (SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM elements a JOIN elements b
  ON a.e = b.e AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS root FROM sets UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.root < l.b
)
SELECT s.doc_id, len(s) AS n_shingles, r.root AS component_id
FROM sets s JOIN (SELECT doc_id, min(root) AS root FROM reach GROUP BY doc_id) r ON r.doc_id = s.doc_id
"""


@query("op12_similar_sets", LINK_SQL)
def op12_similar_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.linked(table(spark, sf_dir, "documents"))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), 32, whitening.Grid(64.0, 1_000_000))
    rows = found.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )
