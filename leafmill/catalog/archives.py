"""Queries for archive rules and the merge.  A conversation stands for an archive, its turns for members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.catalog.registry import query, table
from leafmill.functions.export import number_blocks
from leafmill.functions.markup import block
from leafmill.limits import Limits
from leafmill.operators import archives as rules
from leafmill.operators.admission import route, with_suffix
from leafmill.operators.blocks import element_rows

# Conversations have at most eight turns, so the bounds are tightened to meet.
_LIMITS = Limits(max_archive_members=6, max_archive_bytes=3000)

# One conversation in each few has a bad member.
_MEMBERS_SQL = """
WITH members AS (
  SELECT conv_id::VARCHAR AS archive_id, CASE WHEN conv_id % 2 = 0 THEN 'zip' ELSE 'tar' END AS format, turn AS ordinal,
    CASE WHEN conv_id % 7 = 1 AND turn = 2 THEN '../' || role WHEN conv_id % 11 = 3 AND turn = 1 THEN '/etc/' || role
      WHEN conv_id % 13 = 5 AND turn = 3 THEN '' ELSE role || '/' || turn || CASE WHEN conv_id % 17 = 4 THEN '.pdf' ELSE '.txt' END END AS name,
    CASE WHEN conv_id % 5 = 2 AND turn = 3 THEN 'symlink' WHEN conv_id % 19 = 7 AND turn = 1 THEN 'hardlink'
      WHEN conv_id % 23 = 8 AND turn = 0 THEN 'special' WHEN turn % 4 = 1 AND conv_id % 3 = 0 THEN 'directory' ELSE 'file' END AS kind,
    strlen(text) AS declared_size, strlen(text) AS content_length, text
  FROM conversations
), running AS (
  SELECT *, sum(CASE WHEN kind = 'directory' THEN 0 ELSE declared_size END) OVER (PARTITION BY archive_id ORDER BY ordinal) AS expanded,
    count(*) OVER (PARTITION BY archive_id) AS member_count
  FROM members
)
"""


def _members(spark: SparkSession, sf: str) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")

    def rare(modulus: int, rest: int, at: int) -> Column:
        return (conv % modulus == rest) & (turn == at)

    ending = F.when(conv % 17 == 4, ".pdf").otherwise(".txt")
    return table(spark, sf, "conversations").select(
        conv.cast("string").alias("archive_id"),
        F.when(conv % 2 == 0, "zip").otherwise("tar").alias("format"),
        turn.cast("int").alias("ordinal"),
        F.when(rare(7, 1, 2), F.concat(F.lit("../"), "role")).when(rare(11, 3, 1), F.concat(F.lit("/etc/"), "role"))
        .when(rare(13, 5, 3), "").otherwise(F.concat("role", F.lit("/"), turn.cast("string"), ending)).alias("name"),
        F.when(rare(5, 2, 3), "symlink").when(rare(19, 7, 1), "hardlink").when(rare(23, 8, 0), "special")
        .when((turn % 4 == 1) & (conv % 3 == 0), "directory").otherwise("file").alias("kind"),
        F.octet_length("text").cast("long").alias("declared_size"),
        F.octet_length("text").alias("content_length"),
        "text",
    )


@query(_MEMBERS_SQL + """
SELECT archive_id, ordinal::INT AS ordinal, CASE WHEN kind = 'symlink' AND format = 'zip' THEN 'archive member `' || name || '` is a symlink'
  WHEN kind IN ('symlink', 'hardlink') THEN 'archive member `' || name || '` is a link'
  WHEN kind = 'special' THEN 'archive member `' || name || '` is no regular file' END AS refusal FROM members
""")
def member_kinds(spark: SparkSession, sf: str) -> DataFrame:
    refusal = rules.member_kind_refusal(F.col("name"), F.col("kind"), F.col("format"))
    return _members(spark, sf).select("archive_id", "ordinal", refusal.alias("refusal"))


@query(_MEMBERS_SQL + """
SELECT archive_id, CASE WHEN member_count <= 6 THEN NULL WHEN format = 'zip' THEN 'archive holds ' || member_count || ' members, 6 are allowed'
  ELSE 'archive holds more than 6 members' END AS refusal
FROM running GROUP BY archive_id, format, member_count
""")
def archive_member_bound(spark: SparkSession, sf: str) -> DataFrame:
    members = _members(spark, sf).select("archive_id", "format", "ordinal")
    near = rules.decisive_members(members, _LIMITS).join(rules.member_counts(members), "archive_id")
    return near.groupBy("archive_id").agg(F.min(rules.member_count_refusal(_LIMITS)).alias("refusal"))


@query(_MEMBERS_SQL + """
SELECT archive_id, ordinal::INT AS ordinal, expanded::BIGINT AS expanded_bytes,
  CASE WHEN expanded > 3000 THEN 'archive grows beyond the 3000-byte limit' END AS refusal
FROM running
""")
def archive_byte_bound(spark: SparkSession, sf: str) -> DataFrame:
    near = _members(spark, sf).withColumn("expanded_bytes", rules.expanded_bytes())
    refusal = rules.expanded_bytes_refusal(F.col("expanded_bytes"), _LIMITS)
    return near.select("archive_id", "ordinal", "expanded_bytes", refusal.alias("refusal"))


@query(_MEMBERS_SQL + """
SELECT archive_id, ordinal::INT AS ordinal, CASE WHEN content_length > 1000 THEN 'archive member holds more bytes than it declares' END AS refusal
FROM members
""")
def archive_actual_bound(spark: SparkSession, sf: str) -> DataFrame:
    refusal = rules.actual_bytes_refusal(F.col("content_length"), Limits(max_archive_bytes=1000))
    return _members(spark, sf).select("archive_id", "ordinal", refusal.alias("refusal"))


_VERDICT_SQL = _MEMBERS_SQL + """
, refusals AS (
  SELECT archive_id, -1 AS place, 1 AS chk, 'archive holds ' || member_count || ' members, 6 are allowed' AS reason
  FROM running WHERE format = 'zip' AND member_count > 6
  UNION ALL SELECT archive_id, ordinal, 1, 'archive holds more than 6 members' FROM running WHERE format = 'tar' AND ordinal >= 6
  UNION ALL SELECT archive_id, ordinal, 2, CASE WHEN name = '' THEN 'archive member has an empty name'
    WHEN name LIKE '/%' THEN 'archive member `' || name || '` has an absolute path'
    ELSE 'archive member `' || name || '` takes a parent-directory step' END FROM running WHERE name = '' OR name LIKE '/%' OR name LIKE '../%'
  UNION ALL SELECT archive_id, ordinal, 3, 'archive member `' || name || '` is ' || CASE WHEN kind = 'special' THEN 'no regular file'
    WHEN kind = 'symlink' AND format = 'zip' THEN 'a symlink' ELSE 'a link' END FROM running WHERE kind NOT IN ('file', 'directory')
  UNION ALL SELECT archive_id, ordinal, 4, 'archive grows beyond the 3000-byte limit' FROM running WHERE kind <> 'directory' AND expanded > 3000
  UNION ALL SELECT archive_id, ordinal, 6, 'archive member holds more bytes than it declares' FROM running WHERE content_length > 3000
), verdict AS (
  SELECT a.archive_id, arg_min(reason, (place, chk)) AS error
  FROM (SELECT DISTINCT archive_id FROM members) a LEFT JOIN refusals r ON a.archive_id = r.archive_id GROUP BY a.archive_id
)
"""


@query(_VERDICT_SQL + "SELECT archive_id, CASE WHEN error IS NOT NULL THEN 'input_rejected' END AS error_code, error FROM verdict")
def archive_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return rules.archive_verdict(_members(spark, sf).drop("text"), _LIMITS)


@query(_MEMBERS_SQL + """
SELECT archive_id, ordinal::INT AS ordinal, name,
  (row_number() OVER (PARTITION BY archive_id ORDER BY string_split(name, '/'), ordinal) - 1)::INT AS position
FROM members
""")
def member_order(spark: SparkSession, sf: str) -> DataFrame:
    return rules.order_members(_members(spark, sf)).select("archive_id", "ordinal", "name", "position")


_MERGE_LIMITS = Limits(max_elements=5)
_CONVERTED_SQL = _MEMBERS_SQL + """
, converted AS (
  SELECT archive_id, ordinal, role || CASE WHEN turn % 2 = 0 THEN '/' ELSE '-' END || CASE WHEN conv_id % 6 = 1 THEN 'same' ELSE turn::VARCHAR END AS name,
    CASE WHEN turn % 5 = 4 THEN chr(160) || chr(10) ELSE text END AS markdown, text, turn % 3 AS page_count,
    CASE WHEN turn = 3 THEN 'no conversion is available' END AS error, CASE WHEN turn = 0 THEN 'first turn' END AS warning
  FROM (SELECT conv_id::VARCHAR AS archive_id, turn AS ordinal, * FROM conversations)
), latest AS (
  SELECT * FROM converted QUALIFY row_number() OVER (PARTITION BY archive_id, name ORDER BY ordinal DESC) = 1
), kept AS (
  SELECT *, row_number() OVER (PARTITION BY archive_id ORDER BY string_split(name, '/')) AS k
  FROM latest WHERE error IS NULL AND trim(markdown, chr(160) || chr(10)) <> ''
)
"""


def _converted(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as converted members: some fail, some are blank, some share a name."""
    turn = F.col("turn")
    name = F.concat(
        "role", F.when(turn % 2 == 0, "/").otherwise("-"), F.when(F.col("conv_id") % 6 == 1, "same").otherwise(turn.cast("string"))
    )
    blocks = F.array(block("Title", F.col("role"), F.lit(1)), block("Text", F.col("text")))
    return table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("archive_id"),
        turn.cast("int").alias("ordinal"),
        name.alias("name"),
        F.when(turn % 5 == 4, "\xa0\n").otherwise(F.col("text")).alias("markdown"),
        "text",
        number_blocks(blocks).alias("elements"),
        F.when(turn == 0, F.array(F.lit("first turn"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
        (turn % 3).cast("int").alias("page_count"),
        F.when(turn == 3, "no conversion is available").alias("error"),
    )


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict first: only archives within the member and byte limits are merged."""
    members = _converted(spark, sf).select(
        "*", F.lit("tar").alias("format"), F.lit("file").alias("kind"),
        F.octet_length("text").cast("long").alias("declared_size"), F.octet_length("text").alias("content_length"),
    )
    good = rules.judge_members(members, _MERGE_LIMITS).filter(F.col("refusal").isNull())
    return rules.merge_archive(good, _MERGE_LIMITS)


@query(_CONVERTED_SQL + """
SELECT a.archive_id, coalesce(string_agg('# ' || name || chr(10) || chr(10) || markdown, chr(10) || chr(10) ORDER BY k), '') AS markdown,
  coalesce(string_agg(name || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY k), '') AS text, nullif(sum(page_count), 0)::INT AS page_count
FROM (SELECT DISTINCT archive_id FROM converted) a LEFT JOIN kept USING (archive_id) GROUP BY a.archive_id
""")
def archive_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select("archive_id", "markdown", "text", "page_count")


@query(_CONVERTED_SQL + """
SELECT archive_id, coalesce(string_agg(name || ': ' || CASE WHEN error IS NOT NULL THEN error ELSE warning END, ';' ORDER BY string_split(name, '/'))
  FILTER (WHERE error IS NOT NULL OR (warning IS NOT NULL AND trim(markdown, chr(160) || chr(10)) <> '')), '') AS warnings
FROM latest GROUP BY archive_id
""")
def member_isolation(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select("archive_id", F.array_join("warnings", ";").alias("warnings"))


@query(_CONVERTED_SQL + """
SELECT a.archive_id, coalesce(string_agg(name, ';' ORDER BY k), '') AS sources
FROM (SELECT DISTINCT archive_id FROM converted) a LEFT JOIN kept USING (archive_id) GROUP BY a.archive_id
""")
def blank_members(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select("archive_id", F.array_join("sources", ";").alias("sources"))


@query(_CONVERTED_SQL + """
, elements AS (
  SELECT k.archive_id, k.name AS source, k.k, e.n, '#/blocks/' || e.n AS id, CASE e.n WHEN 0 THEN 'Title' ELSE 'Text' END AS category,
    CASE e.n WHEN 0 THEN c.role ELSE k.text END AS text, CASE e.n WHEN 0 THEN 1 END AS level
  FROM kept k JOIN conversations c ON k.archive_id = c.conv_id::VARCHAR AND k.ordinal = c.turn, (VALUES (0), (1)) e(n)
), placed AS (
  SELECT *, (row_number() OVER (PARTITION BY archive_id ORDER BY k, n) - 1)::INT AS seq FROM elements
)
SELECT archive_id, seq, id, category, text, NULL::INT AS page_number, level, source FROM placed WHERE seq < 5
""")
def archive_elements(spark: SparkSession, sf: str) -> DataFrame:
    return element_rows(_merged(spark, sf), "archive_id")


@query(_CONVERTED_SQL + """
, weighed AS (
  SELECT l.archive_id, l.ordinal, l.name, l.text, l.markdown, l.page_count, k.k IS NOT NULL AS kept,
    CASE WHEN k.k IS NULL THEN 0 ELSE strlen(l.markdown) + strlen(l.text) + 2 * strlen(l.name) + 8 + strlen(c.role) + strlen(l.text) + 120 END AS weight
  FROM latest l LEFT JOIN kept k ON k.archive_id = l.archive_id AND k.ordinal = l.ordinal
    JOIN conversations c ON l.archive_id = c.conv_id::VARCHAR AND l.ordinal = c.turn
), summed AS (
  SELECT *, coalesce(sum(weight) OVER before, 0) AS start, coalesce(sum(CASE WHEN kept THEN 2 ELSE 0 END) OVER before, 0) AS n
  FROM weighed WINDOW before AS (PARTITION BY archive_id ORDER BY string_split(name, '/') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), numbered AS (
  SELECT *, dense_rank() OVER (PARTITION BY archive_id ORDER BY start // 1500) - 1 AS part FROM summed
)
SELECT archive_id, part::INT AS part, min(n)::BIGINT AS first_element,
  coalesce(string_agg('# ' || name || chr(10) || chr(10) || markdown, chr(10) || chr(10) ORDER BY string_split(name, '/')) FILTER (kept), '') AS markdown,
  coalesce(string_agg(name, ';' ORDER BY string_split(name, '/')) FILTER (kept), '') AS sources,
  nullif(sum(page_count) FILTER (kept), 0)::INT AS page_count, (2 * count(*) FILTER (kept))::INT AS n_elements
FROM numbered GROUP BY archive_id, part
""")
def archive_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The merge in numbered parts of about 1,500 bytes."""
    parts = rules.merge_parts(_converted(spark, sf), Limits(), part_bytes=1500)
    return parts.select("archive_id", "part", "first_element", "markdown", F.array_join("sources", ";").alias("sources"), "page_count",
                        F.size("elements").alias("n_elements"))


@query(_VERDICT_SQL + """
SELECT m.archive_id, ordinal::INT AS ordinal, name, CASE WHEN name LIKE '%.pdf' THEN 'no conversion is available for `.pdf`' END AS format_error
FROM members m JOIN verdict v ON m.archive_id = v.archive_id WHERE v.error IS NULL AND kind = 'file'
""")
def admitted_members(spark: SparkSession, sf: str) -> DataFrame:
    """Members of good archives, routed: verdict and route in one pass."""
    judged = rules.judge_members(_members(spark, sf), _LIMITS)
    good = judged.filter(F.col("refusal").isNull() & (F.col("kind") == "file"))
    return route(with_suffix(good, "name")).select("archive_id", "ordinal", "name", "format_error")
