"""Queries over snapshots and references (problems 3 and 4) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktally.operators.references import Parent, Referring, member_kind, orphan_references, orphan_report
from worktally.operators.snapshot_changes import PUBLIC_WORKS, DatasetSpec, snapshot_changes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Added, removed and changed records of each dataset between consecutive snapshots."""
    return snapshot_changes(_table(spark, sf_dir, "records")).select("dataset", "snapshot_no", "identity", "change_kind")


def p3_changed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each content field changed, by dataset and snapshot."""
    changes = snapshot_changes(_table(spark, sf_dir, "records")).filter("change_kind = 'changed'")
    exploded = changes.select("dataset", "snapshot_no", F.explode("changed_fields").alias("field_name"))
    return exploded.groupBy("dataset", "snapshot_no", "field_name").agg(F.count("*").alias("n_records"))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[list[Referring], list[Parent]]:
    t = lambda name: _table(spark, sf_dir, name)
    key = "work_recommendation_dtl_id"
    referring = [
        Referring("works_sanctioned", t("works_sanctioned"), "sno", key, "loaded_at", F.lit("work")),
        Referring("expenditure", t("expenditure"), "sno", key, "loaded_at", F.lit("work")),
        Referring("work_analysis", t("work_analysis"), "work_id", "member_id", "last_calculated", member_kind(F.col("member_type"))),
    ]
    parents = [Parent("work", t("works_recommended"), key), Parent("mp", t("mps"), "mp_id"), Parent("mla", t("mlas"), "mla_id")]
    return referring, parents


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to missing, withdrawn or later-arriving rows."""
    return orphan_references(*_sides(spark, sf_dir))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references counted per table and month."""
    return orphan_report(*_sides(spark, sf_dir))


QUERIES = {"p3_found": p3_found, "p3_changed_fields": p3_changed_fields, "p4_found": p4_found, "p4_report": p4_report}

_DIGITS = "translate({0}, '०१२३४५६७८९', '0123456789')"


def _whole(x: str) -> str:
    s = f"regexp_replace({_DIGITS.format(f'CAST({x} AS VARCHAR)')}, '[\\s\\x{{A0}}]+', '', 'g')"
    digits = f"replace(replace(regexp_replace({s}, '\\.0*$', ''), ',', ''), '+', '')"
    return f"CASE WHEN regexp_full_match({s}, '[+-]?([0-9]+|[0-9]{{1,3}}(,[0-9]{{2,3}})+)(\\.0*)?') THEN TRY_CAST({digits} AS DECIMAL(38,0)) END"


_P4_CASES = f"""
WITH refs_raw AS (
  SELECT 'works_sanctioned' AS table_name, sno AS row_id, 'work' AS kind, work_recommendation_dtl_id AS k, loaded_at FROM works_sanctioned
  UNION ALL SELECT 'expenditure', sno, 'work', work_recommendation_dtl_id, loaded_at FROM expenditure
  UNION ALL SELECT 'work_analysis', work_id, CASE upper(replace(member_type, ' ', '')) WHEN 'MP' THEN 'mp' WHEN 'MLA' THEN 'mla' END, CAST(member_id AS VARCHAR), last_calculated FROM work_analysis),
refs AS (
  SELECT table_name, row_id, kind, {_whole("k")} AS key, min(loaded_at) AS first_load FROM refs_raw
  WHERE k IS NOT NULL AND regexp_replace(k, '[\\s\\x{{A0}}]+', '', 'g') <> '' GROUP BY ALL),
parents_raw AS (
  SELECT 'work' AS kind, {_whole("work_recommendation_dtl_id")} AS key, loaded_at, removed_at FROM works_recommended
  UNION ALL SELECT 'mp', CAST(mp_id AS DECIMAL(38,0)), loaded_at, removed_at FROM mps
  UNION ALL SELECT 'mla', CAST(mla_id AS DECIMAL(38,0)), loaded_at, removed_at FROM mlas),
parents AS (
  SELECT kind, key, min(loaded_at) AS valid_from, max(CASE WHEN removed_at IS NULL THEN 1 ELSE 0 END) AS there FROM parents_raw WHERE key IS NOT NULL GROUP BY kind, key),
judged AS (
  SELECT table_name, row_id, strftime(first_load, '%Y-%m') AS load_month,
    CASE WHEN there IS NULL THEN 'missing' WHEN there = 0 THEN 'deleted' WHEN valid_from > first_load THEN 'late' END AS reason_code
  FROM refs LEFT JOIN parents USING (kind, key)),
found AS (SELECT * FROM judged WHERE reason_code IS NOT NULL)
"""

_BLANK = "[\\s\\x{A0}\\x{2000}-\\x{200B}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}]+"


def _field(name: str) -> str:
    return f"NULLIF(trim(regexp_replace(json_extract_string(j, '$.{name}'), '{_BLANK}', ' ', 'g')), '')"


def _key(name: str) -> str:
    x = _field(name)
    return f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+\\.0*') THEN regexp_replace({x}, '\\.0*$', '') ELSE {x} END"


def _parts(one: DatasetSpec) -> list[str]:
    numbers = [f"COALESCE(CAST(TRY_CAST(replace({_field(f)}, ',', '') AS DECIMAL(38,10)) AS VARCHAR), {_field(f)})" for f in one.numbers]
    forms = ("%Y-%m-%d", "%d-%b-%Y", "%d-%m-%Y", "%b %d, %Y %I:%M:%S %p", "%b %d, %Y")
    dates = ["COALESCE(CAST(CAST(COALESCE(" + ", ".join(f"try_strptime({_field(f)}, '{x}')" for x in forms) + f") AS DATE) AS VARCHAR), {_field(f)})" for f in one.dates]
    return [*numbers, *dates, *[_field(f) for f in one.texts]]


def _content(one: DatasetSpec) -> str:
    return "concat_ws('|', " + ", ".join(f"COALESCE({c}, '<NULL>')" for c in _parts(one)) + ")"


_P3_LINES = " UNION ALL ".join(
    f"SELECT dataset, snapshot_no, line_no, CAST(to_json([{', '.join(_key(f) for f in one.identity)}]) AS VARCHAR) AS identity, {_content(one)} AS content FROM objects WHERE dataset = '{name}'" + "".join(f" AND {_key(f)} IS NOT NULL" for f in one.identity)
    for name, one in PUBLIC_WORKS.datasets.items()
)
_P3 = f"""
WITH objects AS (SELECT dataset, snapshot_no, line_no, CAST(raw_json AS JSON) AS j FROM records WHERE raw_json IS NOT NULL AND json_valid(raw_json) AND json_type(raw_json) = 'OBJECT'),
lines AS ({_P3_LINES}),
kept AS (SELECT dataset, snapshot_no, identity, arg_max(content, line_no) AS content FROM lines GROUP BY ALL),
steps AS (SELECT dataset, snapshot_no, lag(snapshot_no) OVER (PARTITION BY dataset ORDER BY snapshot_no) AS before FROM (SELECT DISTINCT dataset, snapshot_no FROM records)),
new_ AS (SELECT s.dataset, s.snapshot_no, k.identity, k.content FROM steps s JOIN kept k ON k.dataset = s.dataset AND k.snapshot_no = s.snapshot_no WHERE before IS NOT NULL),
old_ AS (SELECT s.dataset, s.snapshot_no, k.identity, k.content FROM steps s JOIN kept k ON k.dataset = s.dataset AND k.snapshot_no = s.before)
SELECT COALESCE(n.dataset, o.dataset) AS dataset, COALESCE(n.snapshot_no, o.snapshot_no) AS snapshot_no, COALESCE(n.identity, o.identity) AS identity,
  CASE WHEN o.identity IS NULL THEN 'added' WHEN n.identity IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM new_ n FULL JOIN old_ o ON n.dataset = o.dataset AND n.snapshot_no = o.snapshot_no AND n.identity = o.identity
WHERE o.identity IS NULL OR n.identity IS NULL OR n.content <> o.content
"""

_P3_LISTS = " UNION ALL ".join(
    f"SELECT dataset, snapshot_no, line_no, CAST(to_json([{', '.join(_key(f) for f in one.identity)}]) AS VARCHAR) AS identity, [{', '.join(_parts(one))}] AS content, [{', '.join(repr(f) for f in one.content)}] AS names FROM objects WHERE dataset = '{name}'" + "".join(f" AND {_key(f)} IS NOT NULL" for f in one.identity)
    for name, one in PUBLIC_WORKS.datasets.items()
)
_P3_FIELDS = f"""
WITH objects AS (SELECT dataset, snapshot_no, line_no, CAST(raw_json AS JSON) AS j FROM records WHERE raw_json IS NOT NULL AND json_valid(raw_json) AND json_type(raw_json) = 'OBJECT'),
lines AS ({_P3_LISTS}),
kept AS (SELECT dataset, snapshot_no, identity, arg_max(content, line_no) AS content, arg_max(names, line_no) AS names FROM lines GROUP BY ALL),
steps AS (SELECT dataset, snapshot_no, lag(snapshot_no) OVER (PARTITION BY dataset ORDER BY snapshot_no) AS before FROM (SELECT DISTINCT dataset, snapshot_no FROM records)),
both_ AS (SELECT s.dataset, s.snapshot_no, n.content AS a, o.content AS b, n.names AS names FROM steps s JOIN kept n ON n.dataset = s.dataset AND n.snapshot_no = s.snapshot_no JOIN kept o ON o.dataset = s.dataset AND o.snapshot_no = s.before AND o.identity = n.identity),
cells AS (SELECT dataset, snapshot_no, unnest(names) AS field_name, unnest(a) AS a, unnest(b) AS b FROM both_)
SELECT dataset, snapshot_no, field_name, count(*) AS n_records FROM cells WHERE a IS DISTINCT FROM b GROUP BY ALL
"""

ORACLES = {
    "p3_found": _P3,
    "p3_changed_fields": _P3_FIELDS,
    "p4_found": _P4_CASES + "SELECT table_name, row_id, load_month, reason_code FROM found",
    "p4_report": _P4_CASES + "SELECT table_name, load_month, reason_code, count(*) AS n_references FROM found GROUP BY ALL",
}
