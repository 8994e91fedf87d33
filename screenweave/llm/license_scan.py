"""Licence scan by canonical digests, in DataFrame functions only.

A text's canonical form is lower case; every run of characters that are neither letters nor digits is one blank (line
ends stay line ends); lines that are copyright statements ("Copyright (c) 2019 ...", "(c) 2020 ...", "Copyright (c) Some
One", "Copyright The Authors", "© Some One", "All rights reserved.") are empty; equivalent spellings are made equal. The SHA-256 of the canonical text, line ends as blanks, is
looked up in a table of known licence texts by a hash join. So is that of every line by itself: a one-line notice
within other text is found too.

The table of known texts is part of the code: short texts and notices as they are, long ones as digests of their
canonical forms. It is a constant of the plan, broadcast as long as it has at most SENT rows. Up to INLINE known digests
lines are looked up within their row, in one scan without a shuffle; beyond, line digests are written, joined with the
known ones and aggregated by document. Both ways give the same rows.

Defined results: a null text has null digest, no licence and no notice. An empty text, or one of copyright lines only,
has the digest of the empty text and no licence. Repeated rows and copies each give their row; other columns are not
looked at. `notices` lists each licence once, in alphabetic order, separated by commas; empty if there are none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenweave.llm.common import table, written
from screenweave.llm.license_texts import DIGESTS, NOTICES, SPELLINGS, TEXTS

#: Known digests that are looked up within a row, and those that are broadcast.
INLINE, SENT = 2_000, 100_000

_OTHER = r"[^\p{L}\p{N}\n]+"
_COPYRIGHT = r"(?m)^ ?(?:portions )?(?:copyright(?: c)?|c) (?:\d{4}|yyyy|year)\b[^\n]*$|^ ?all rights reserved ?$"
# Statements that need signs or capitals to be known: with the sign, or a name after "Copyright" that isn't the running text of a licence.
_SIGNED = (
    r"(?md)^[^\p{L}\p{N}\n]*(?:©"
    r"|(?:(?i:portions)[^\p{L}\p{N}\n]+)?(?:[Cc]opyright|COPYRIGHT)(?:[^\p{L}\p{N}\n]*(?:\([cC]\)|©)"
    r"|[^\p{L}\p{N}\n]+(?:(?i:by)[^\p{L}\p{N}\n]+)?(?!(?i:notices?|holders?|owners?|ownership|laws?|licen[cs]e[sd]?|statements?|interests?|permissions?|protection|disclaimers?|infringements?|acts?|and|or|in|is|of|to|for)\b)\p{Lu}))[^\n]*$"
)
_SPELLED = r"\b(?:" + "|".join(a for a, _ in SPELLINGS) + r")\b"


def _lined(text: Column) -> Column:
    """Canonical but for line ends."""
    unsigned = F.when(text.rlike("[Cc]opyright|COPYRIGHT|©"), F.regexp_replace(text, _SIGNED, "")).otherwise(text)
    plain = F.regexp_replace(F.regexp_replace(F.lower(unsigned), _OTHER, " "), _COPYRIGHT, "")
    spelled = reduce(lambda c, ab: F.regexp_replace(c, rf"\b{ab[0]}\b", ab[1]), SPELLINGS, plain)
    return F.when(plain.rlike(_SPELLED), spelled).otherwise(plain)


def canonical(text: Column) -> Column:
    return F.trim(F.regexp_replace(_lined(text), r"[ \n]+", " "))


def known(spark: SparkSession, texts=None) -> DataFrame:
    """(digest, license): one row for each canonical form; of several licences with one form, the alphabetically first."""
    pairs = lambda rows, *names: F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows]))
    given = [*TEXTS, *NOTICES] if texts is None else list(texts)
    one = spark.range(1)
    rows = one.select(pairs(given or [("", None)], "license", "text")).select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "license")
    if texts is None and DIGESTS:
        rows = rows.unionByName(one.select(pairs(DIGESTS, "license", "digest")))
    return rows.dropna().groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), texts=None, inline: int = INLINE) -> DataFrame:
    """The columns `keep`, then text_digest, license (of the whole text) and notices (licences of single lines)."""
    table_ = known(docs.sparkSession, texts)
    n = len(TEXTS) + len(NOTICES) + len(DIGESTS) if texts is None else len(texts)
    small = (lambda t: F.broadcast(t)) if n <= SENT else (lambda t: t)
    lines = F.transform(F.split(F.col("_lined"), "\n"), lambda x: F.sha2(F.trim(x), 256))
    # the columns in between keep Spark from evaluating the regular expressions twice
    lined = docs.select(*keep, _lined(F.col(text)).alias("_lined"))
    digest = F.sha2(F.trim(F.regexp_replace("_lined", r"[ \n]+", " ")), 256).alias("text_digest")
    if n <= inline:
        by = {r["digest"]: r["license"] for r in table_.collect()}
        names = F.create_map(*[F.lit(x) for kv in sorted(by.items()) for x in kv])
        hits = F.transform(F.filter(lines, lambda d: d.isin(sorted(by))), lambda d: F.element_at(names, d))
        found = lined.select(*keep, digest, F.coalesce(F.array_join(F.sort_array(F.array_distinct(hits)), ","), F.lit("")).alias("notices"))
    else:
        slim = written(lined.select(*keep, digest, F.array_distinct(lines).alias("_lines"), F.monotonically_increasing_id().alias("_row")), "lines")
        hits = slim.select("_row", F.explode("_lines").alias("digest")).join(small(table_), "digest")
        hits = hits.groupBy("_row").agg(F.array_join(F.array_sort(F.collect_set("license")), ",").alias("notices"))
        found = slim.drop("_lines").join(hits, "_row", "left").select(*keep, "text_digest", F.coalesce("notices", F.lit("")).alias("notices"))
    whole = small(table_.select(F.col("digest").alias("text_digest"), "license"))
    return found.join(whole, "text_digest", "left").select(*keep, "text_digest", "license", "notices")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The same in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(a)}, {quote(t)})" for a, t in [*TEXTS, *NOTICES])
    longer = ", ".join(f"({quote(d)}, {quote(a)})" for a, d in DIGESTS)
    plain = f"regexp_replace(regexp_replace(lower(text), {quote(_OTHER.replace(chr(92) + 'n', chr(10)))}, ' ', 'g'), {quote(_COPYRIGHT)}, '', 'g')"
    spelled = reduce(lambda c, ab: f"regexp_replace({c}, {quote(rf'\b{ab[0]}\b')}, {quote(ab[1])}, 'g')", SPELLINGS, "plain")
    return f"""
WITH given AS (SELECT 0 AS known, license, text, NULL::BIGINT AS doc_id, 0 AS row FROM (VALUES {values}) v(license, text)
  UNION ALL SELECT 1, NULL, text, doc_id, row_number() OVER () FROM documents),
plains AS (SELECT known, license, doc_id, row, {plain} AS plain FROM given),
lined AS (SELECT known, license, doc_id, row, CASE WHEN regexp_matches(plain, {quote(_SPELLED)}) THEN {spelled} ELSE plain END AS lined FROM plains),
digests AS (SELECT *, sha256(trim(regexp_replace(lined, '[ \\n]+', ' ', 'g'))) AS digest FROM lined),
known AS (SELECT digest, min(license) AS license FROM (SELECT digest, license FROM digests WHERE known = 0 UNION ALL SELECT * FROM (VALUES {longer}) v(digest, license)) GROUP BY digest),
lines AS (SELECT row, sha256(trim(unnest(string_split(lined, chr(10))))) AS digest FROM lined WHERE known = 1),
notices AS (SELECT row, string_agg(DISTINCT license, ',' ORDER BY license) AS notices FROM lines JOIN known USING (digest) GROUP BY row)
SELECT doc_id, d.digest AS text_digest, k.license, coalesce(n.notices, '') AS notices
FROM digests d LEFT JOIN known k ON k.digest = d.digest LEFT JOIN notices n ON n.row = d.row WHERE d.known = 1"""
