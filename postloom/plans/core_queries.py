"""Queries of the general data-quality operators, each over its whole tables, with independent SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators.failed_rows import rejected_rows, valid_rows
from postloom.operators.hierarchy import message_descendants, message_hierarchy, message_paths
from postloom.operators.keyed_totals import heavy_keys, keyed_totals
from postloom.operators.timestamps import normalise_dates
from postloom.runtime import table

HEAVY_SHARE = 0.02


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    mails = table(spark, folder, "emails").select("pos", "date_raw", "from_email")
    out = normalise_dates(mails, table(spark, folder, "sites"), table(spark, folder, "zone_names"))
    return out.filter("utc_ms is not null").select("pos", "utc_ms")


def p3_status(spark: SparkSession, folder: str) -> DataFrame:
    """How each header was settled, or why not."""
    mails = table(spark, folder, "emails").select("pos", "date_raw", "from_email")
    out = normalise_dates(mails, table(spark, folder, "sites"), table(spark, folder, "zone_names"))
    return out.select("pos", "date_status", F.coalesce(F.col("utc_ms").cast("string"), F.lit("")).alias("utc_ms"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_rows(table(spark, folder, "review_rows")).select("row_id", "reason")


def p4_valid(spark: SparkSession, folder: str) -> DataFrame:
    out = valid_rows(table(spark, folder, "review_rows"))
    return out.withColumn("n_flags", F.size("flags").cast("bigint")).withColumn("flags", F.array_join("flags", "\n")).withColumn("beyond_type", F.array_join("beyond_type", " "))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return heavy_keys(table(spark, folder, "emails"), ["from_email", "normalized_subject"], HEAVY_SHARE).select("field_name", "key_value")


def p6_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Mails, characters, and first and last place of every sender and every subject."""
    measures = {"n_chars": ("body_length", "sum"), "first_pos": ("pos", "min"), "last_pos": ("pos", "max")}
    return keyed_totals(table(spark, folder, "emails"), ["from_email", "normalized_subject"], measures)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return message_hierarchy(table(spark, folder, "emails"))


def p7_paths(spark: SparkSession, folder: str) -> DataFrame:
    return message_paths(table(spark, folder, "emails"))


def p7_descendants(spark: SparkSession, folder: str) -> DataFrame:
    return message_descendants(table(spark, folder, "emails"))


QUERIES = {f.__name__: f for f in (p3_found, p3_status, p4_found, p4_valid, p6_found, p6_totals, p7_found, p7_paths, p7_descendants)}

_LINKS = """
WITH RECURSIVE ids AS (SELECT DISTINCT message_id FROM emails WHERE message_id <> ''),
claims AS (
  SELECT message_id AS child, parent_id AS above FROM emails WHERE message_id <> '' AND parent_id <> ''
  UNION
  SELECT c AS child, message_id AS above FROM (SELECT unnest(children_ids) AS c, message_id FROM emails WHERE message_id <> '') WHERE c <> ''),
links AS (SELECT child, min(above) AS above FROM claims WHERE above IN (FROM ids) AND child IN (FROM ids) GROUP BY child),
walk AS (
  SELECT message_id, message_id AS root_id, CAST(0 AS BIGINT) AS node_depth, message_id AS path FROM ids WHERE message_id NOT IN (SELECT child FROM links)
  UNION ALL
  SELECT l.child, w.root_id, w.node_depth + 1, w.path || ' ' || l.child FROM walk w JOIN links l ON l.above = w.message_id)
"""

_FIELD = r'(?:"(?:[^"]|"")*"|[^",\n\r]*)'
_CELL = f"regexp_extract(record_text, '^{'' .join(f'({_FIELD}),' for _ in range(6))}({_FIELD})$', {{}})"


def _cell(i: int) -> str:
    text = _CELL.format(i)
    return f"(CASE WHEN {text} LIKE '\"%' THEN replace(substr({text}, 2, length({text}) - 2), '\"\"', '\"') ELSE {text} END)"


_CELLS = ", ".join(f"{_cell(i + 1)} AS {n}" for i, n in enumerate(("id", "year", "file", "line", "subject", "from_raw", "flags")))
_FLAG = r'"(?:NO_EMAIL_FOUND|OBFUSCATED_EMAIL|MISSING_HEADER|CORRUPTED_DATE|UNPARSEABLE_DATE|EMPTY_BODY): (?:[^"\\]|\\.)+"'
_REVIEW = rf"""
WITH parts AS (
  SELECT row_id, record_text,
    regexp_full_match(record_text, '{_FIELD}(?:,{_FIELD})*') AS quoted,
    regexp_full_match(record_text, '{_FIELD}(?:,{_FIELD}){{6}}') AS seven
  FROM review_rows),
cells AS (SELECT row_id, {_CELLS} FROM parts WHERE quoted AND seven),
judged AS (
  SELECT *, regexp_full_match(id, '[0-9a-f]{{16}}') AND regexp_full_match(year, '[0-9]{{4}}') AND file = 'cyp-' || year || '.txt'
    AND regexp_full_match(line, '0*[1-9][0-9]*') AND NOT regexp_matches(from_raw, '[\x00-\x1f\x7f-\x9f\x{{FFFD}}]')
    AND regexp_full_match(flags, '\s*\[\s*(?:{_FLAG}\s*(?:,\s*{_FLAG}\s*)*)?\]\s*') AS sound
  FROM cells)
"""

# The notations of the Date header, written out for DuckDB (RE2) on their own: pattern and year|month|day|hour|minute|second|fraction|half|zone.
_CLOCK = r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?"
_NOTATIONS = (
    (rf"^by [^ ]+ \([^()]*\) id [^;]+; ?(?:\pL+[.]?,? )?([0-9]{{1,2}}) (\pL+)[.]? ([0-9]{{4}}|[0-9]{{2}}) {_CLOCK}(?: ([-+][0-9]{{4}}|[-+][0-9]{{2}}:[0-9]{{2}}|[A-Za-z]{{1,5}}))?(?: ?\([^()]*\))?$", r"\3|\2|\1|\4|\5|\6|\7||\8"),
    (rf"^(?:\pL+[.]?,? )?([0-9]{{1,2}})[ -](\pL{{3,10}})[.]?[ -]([0-9]{{4}}|[0-9]{{2}}) {_CLOCK}(?: ?([-+][0-9]{{4}}|[-+][0-9]{{2}}:[0-9]{{2}}|[A-Za-z]{{1,5}}))?(?: ?\([^()]*\))?(?: id [^ ]+(?: for [^ ]+)?)?$", r"\3|\2|\1|\4|\5|\6|\7||\8"),
    (rf"^\pL+,? (\pL{{3,10}})[.]? ([0-9]{{1,2}}) {_CLOCK}(?: ([-+][0-9]{{4}}|[-+][0-9]{{2}}:[0-9]{{2}}|[A-Za-z]{{1,5}}))? ([0-9]{{4}})$", r"\8|\1|\2|\3|\4|\5|\6||\7"),
    (r"^([0-9]{4})-([0-9]{2})-([0-9]{2})[T ]([0-9]{2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)? ?(Z|[-+][0-9]{2}:?[0-9]{2}|[A-Za-z]{2,5})?$", r"\1|\2|\3|\4|\5|\6|\7||\8"),
    (r"^([0-9]{4})([0-9]{2})([0-9]{2})T?([0-9]{2})([0-9]{2})([0-9]{2})(Z|[-+][0-9]{2}:?[0-9]{2})?$", r"\1|\2|\3|\4|\5|\6|||\7"),
    (rf"^([0-9]{{1,2}})[.]([0-9]{{1,2}})[.]([0-9]{{4}}|[0-9]{{2}}) {_CLOCK}(?: ([-+][0-9]{{4}}|[-+][0-9]{{2}}:[0-9]{{2}}|[A-Za-z]{{1,5}}))?$", r"\3|\2|\1|\4|\5|\6|\7||\8"),
    (rf"^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}}|[0-9]{{2}}) {_CLOCK} ?([AaPp][Mm])?(?: ([-+][0-9]{{4}}|[-+][0-9]{{2}}:[0-9]{{2}}|[A-Za-z]{{1,5}}))?$", r"\3|\1|\2|\4|\5|\6|\7|\8|\9"),
    (rf"^(?:\pL+[.]?,? )?(\pL{{3,10}})[.]? ([0-9]{{1,2}}), ([0-9]{{4}}),? {_CLOCK} ?([AaPp][Mm])?(?: ([-+][0-9]{{4}}|[-+][0-9]{{2}}:[0-9]{{2}}|[A-Za-z]{{1,5}}))?$", r"\3|\1|\2|\4|\5|\6|\7|\8|\9"),
    (r"^(?:\pL+[.]?,? )?([0-9]{1,2})[ .-]+(\pL{3,10})[.]?[ .-]+([0-9]{4}|[0-9]{2})$", r"\3|\2|\1||||||"),
)
_MONTH_WORDS = "1:jan,january,januar,janvier,enero,gennaio,januari 2:feb,february,februar,février,fevrier,febrero,febbraio,februari,fév 3:mar,march,mär,märz,maerz,mrz,mars,marzo,maart 4:apr,april,avril,abril,aprile,avr 5:may,mai,mayo,maggio,mei 6:jun,june,juni,juin,junio,giugno 7:jul,july,juli,juillet,julio,luglio 8:aug,august,août,aout,agosto,augustus 9:sep,sept,september,septembre,septiembre,settembre 10:oct,october,okt,oktober,octobre,octubre,ottobre,out 11:nov,november,novembre,noviembre 12:dec,december,dez,dezember,décembre,decembre,diciembre,dicembre,déc"
_DATES = f"""
WITH months(word, m) AS (VALUES {', '.join(f"('{w}', {g.split(':')[0]})" for g in _MONTH_WORDS.split() for w in g.split(':')[1].split(','))}),
t AS (SELECT pos, trim(regexp_replace(coalesce(date_raw, ''), '\\s+', ' ', 'g')) AS t, lower(regexp_extract(coalesce(from_email, ''), '@([^@]+)$', 1)) AS host FROM emails),
c AS (SELECT *, string_split(CASE {' '.join(f"WHEN regexp_matches(t, '{p}') THEN regexp_replace(t, '{p}', '{put}')" for p, put in _NOTATIONS)} END, '|') AS p FROM t),
n AS (SELECT pos, t, host, coalesce(TRY_CAST(p[2] AS INTEGER), m.m) AS mo, CASE WHEN length(p[1]) = 2 THEN 1900 ELSE 0 END + CAST(p[1] AS INTEGER) AS y, CAST(p[3] AS INTEGER) AS d,
    TRY_CAST(p[4] AS INTEGER) AS h0, TRY_CAST(p[5] AS INTEGER) AS mi, coalesce(TRY_CAST(p[6] AS INTEGER), 0) AS s, coalesce(TRY_CAST(rpad(substr(p[7], 1, 3), 3, '0') AS INTEGER), 0) AS ms, upper(p[8]) AS half, upper(p[9]) AS zone
  FROM c LEFT JOIN months m ON m.word = lower(p[2])),
w AS (SELECT *, CASE WHEN half = '' THEN h0 WHEN h0 BETWEEN 1 AND 12 THEN h0 % 12 + CASE WHEN half = 'PM' THEN 12 ELSE 0 END END AS h FROM n),
v AS (SELECT *, TRY_CAST(printf('%04d-%02d-%02d %02d:%02d:%02d', y, mo, d, h, mi, s) AS TIMESTAMP) AS wall FROM w WHERE h < 24 AND mi < 60 AND s < 60),
u AS (SELECT v.*, z.offset_min, s.tz_name AS tz, regexp_matches(zone, '^[-+]') AS numeric, TRY_CAST(substr(regexp_replace(zone, '[^0-9]', '', 'g'), 1, 2) AS INTEGER) AS oh, TRY_CAST(substr(regexp_replace(zone, '[^0-9]', '', 'g'), 3, 2) AS INTEGER) AS om
  FROM v LEFT JOIN zone_names z ON z.abbr = zone LEFT JOIN sites s ON s.site_host = host WHERE wall IS NOT NULL),
i AS (SELECT *, timezone(tz, wall) AS inst FROM u)
"""
_EPOCH_MS = "CAST(CASE WHEN length(t) > 11 THEN CAST(t AS BIGINT) ELSE CAST(t AS BIGINT) * 1000 END AS BIGINT)"
_IS_EPOCH = "regexp_matches(t, '^([0-9]{9,10}|[0-9]{12,13})$')"
_ONCE = "timezone(tz, inst) = wall AND timezone(tz, inst + INTERVAL 1 HOUR) <> wall AND timezone(tz, inst - INTERVAL 1 HOUR) <> wall"
_UTC = "CAST(CASE WHEN numeric THEN epoch_ms(wall) - CASE WHEN zone LIKE '-%' THEN -1 ELSE 1 END * (oh * 60 + om) * 60000 WHEN zone <> '' THEN epoch_ms(wall) - offset_min * 60000 ELSE epoch_ms(inst) END + ms AS BIGINT)"
_SETTLED = f"CASE WHEN numeric THEN oh <= 14 AND om < 60 WHEN zone <> '' THEN offset_min IS NOT NULL ELSE tz IS NOT NULL AND {_ONCE} END"

SQL = {
    "p3_found": f"{_DATES} SELECT pos, {_EPOCH_MS} AS utc_ms FROM t WHERE {_IS_EPOCH} UNION ALL SELECT pos, {_UTC} AS utc_ms FROM i WHERE {_SETTLED}",
    "p3_status": f"""{_DATES}, a AS (SELECT t.pos, t.t, c.p, v.y IS NOT NULL AND TRY_CAST(printf('%04d-%02d-%02d', v.y, v.mo, v.d) AS DATE) IS NOT NULL AS day_ok, i.wall IS NOT NULL AS wall_ok, i.* EXCLUDE (pos, t) FROM t JOIN c USING (pos) LEFT JOIN w v USING (pos) LEFT JOIN i USING (pos)),
b AS (SELECT *, CASE WHEN t = '' THEN 'empty' WHEN {_IS_EPOCH} THEN 'epoch' WHEN p IS NULL THEN 'unparsed' WHEN NOT day_ok THEN 'invalid' WHEN p[4] = '' THEN 'no_time' WHEN NOT wall_ok THEN 'invalid'
  WHEN numeric THEN CASE WHEN oh <= 14 AND om < 60 THEN 'offset' ELSE 'invalid' END WHEN zone <> '' THEN CASE WHEN offset_min IS NOT NULL THEN 'zone' ELSE 'unknown_zone' END
  WHEN tz IS NULL THEN 'no_site' WHEN timezone(tz, inst) <> wall THEN 'nonexistent' WHEN {_ONCE} THEN 'site' ELSE 'ambiguous' END AS date_status FROM a)
SELECT pos, date_status, coalesce(CAST(CASE WHEN date_status = 'epoch' THEN {_EPOCH_MS} WHEN date_status IN ('offset', 'zone', 'site') THEN {_UTC} END AS VARCHAR), '') AS utc_ms FROM b""",
    "p4_found": _REVIEW
    + """SELECT row_id, CASE WHEN NOT quoted THEN 'quoting' WHEN NOT seven THEN 'column_count' ELSE 'bad_value' END AS reason
FROM parts WHERE NOT quoted OR NOT seven OR row_id IN (SELECT row_id FROM judged WHERE NOT sound)""",
    "p4_valid": _REVIEW
    + """SELECT row_id, id, CAST(year AS INTEGER) AS year, file, TRY_CAST(line AS BIGINT) AS line, CASE WHEN TRY_CAST(line AS BIGINT) IS NULL THEN 'line' ELSE '' END AS beyond_type, subject, from_raw,
  coalesce(array_to_string(CAST(from_json(flags, '["VARCHAR"]') AS VARCHAR[]), chr(10)), '') AS flags, CAST(json_array_length(flags) AS BIGINT) AS n_flags
FROM judged WHERE sound""",
    "p6_found": f"""
SELECT 'from_email' AS field_name, from_email AS key_value FROM emails WHERE from_email <> '' GROUP BY from_email HAVING count(*) >= {HEAVY_SHARE} * (SELECT count(*) FROM emails)
UNION ALL
SELECT 'normalized_subject', normalized_subject FROM emails WHERE normalized_subject <> '' GROUP BY normalized_subject HAVING count(*) >= {HEAVY_SHARE} * (SELECT count(*) FROM emails)""",
    "p6_totals": " UNION ALL ".join(
        f"SELECT '{f}' AS field_name, {f} AS key_value, count(*) AS n, CAST(coalesce(sum(body_length), 0) AS BIGINT) AS n_chars, min(pos) AS first_pos, max(pos) AS last_pos FROM emails WHERE {f} <> '' GROUP BY {f}" for f in ("from_email", "normalized_subject")
    ),
    "p7_found": _LINKS + "SELECT i.message_id, coalesce(w.root_id, '') AS root_id, coalesce(w.node_depth, -1) AS node_depth FROM ids i LEFT JOIN walk w USING (message_id)",
    "p7_paths": _LINKS
    + """SELECT i.message_id, coalesce(w.root_id, '') AS root_id, coalesce(w.node_depth, -1) AS node_depth, coalesce(w.path, '') AS path, coalesce(b.n, 0) AS n_descendants
FROM ids i LEFT JOIN walk w USING (message_id)
LEFT JOIN (SELECT a AS message_id, count(*) - 1 AS n FROM (SELECT unnest(string_split(path, ' ')) AS a FROM walk) GROUP BY a) b USING (message_id)""",
    "p7_descendants": _LINKS
    + """SELECT a AS ancestor_id, message_id, CAST(node_depth + 1 - place AS BIGINT) AS distance
FROM (SELECT message_id, node_depth, unnest(string_split(path, ' ')) AS a, unnest(range(1, node_depth + 2)) AS place FROM walk) WHERE node_depth + 1 - place > 0""",
}
