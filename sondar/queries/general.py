"""Queries of the general training-data operators (problems 1, 2 and 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.functions.urls import strip_ws, url_key
from sondar.operators.copydiff import copy_differences
from sondar.operators.packed import explode_packed
from sondar.operators.snapdiff import snapshot_changes, squeezed
from sondar.plans.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Each address packed in the two extra fields of the truth table."""
    return explode_packed(table(spark, d, "golden_set_v1"), "golden_id", ["urls_concursos_extra", "urls_processos_extra"])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Resources added, removed or changed between consecutive deliveries."""
    compared = [squeezed(F.col("content")), F.coalesce("final_url", F.lit(""))]
    return snapshot_changes(table(spark, d, "evidence_snapshot"), "snapshot_id", "resource_id", "retrieved_at", compared)


def _decision(c):
    return F.lower(strip_ws(F.coalesce(c, F.lit(""))))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Cases missing in a replay copy, and differing decisions and urls."""
    v1, v2 = table(spark, d, "replay_v1"), table(spark, d, "replay_v2")
    one = {"decision": _decision(F.col("decision")), "url": url_key(F.col("url"))}
    two = {"decision": _decision(F.col("candidate.decision")), "url": url_key(F.col("candidate.url"))}
    return copy_differences(v1, v2, "case_id", "exported_at", one, two, ("v1", "v2"))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p5_found": p5_found}

_SQL_WS = r"[\s\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _sql_key(x: str) -> str:
    s = f"regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '^{_SQL_WS}+|{_SQL_WS}+$', '', 'g'), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.\\-]*://|^//', '')"
    host = f"regexp_replace(lower(regexp_extract({s}, '^([^/?]*)', 1)), '^www\\.', '')"
    path = f"regexp_replace(regexp_extract({s}, '^[^/?]*([^?]*)', 1), '/+$', '')"
    query = f"array_to_string(list_sort(list_filter(string_split(regexp_extract({s}, '\\?(.*)$', 1), '&'), lambda p: p <> '')), '&')"
    return f"{host} || {path} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END"


ORACLES = {
    "p2_found": f"""
        WITH cur AS (SELECT snapshot_id, resource_id, retrieved_at,
               trim(regexp_replace(coalesce(content, ''), '{_SQL_WS}+', ' ', 'g')) AS c, coalesce(final_url, '') AS u FROM evidence_snapshot
          WHERE snapshot_id IS NOT NULL AND resource_id IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY snapshot_id, resource_id ORDER BY retrieved_at DESC NULLS LAST, c, u) = 1),
        ids AS (SELECT snapshot_id, row_number() OVER (ORDER BY snapshot_id) AS o FROM (SELECT DISTINCT snapshot_id FROM cur)),
        x AS (SELECT o, resource_id, c, u FROM cur JOIN ids USING (snapshot_id)),
        d AS (SELECT coalesce(n.o, p.o + 1) AS o, coalesce(n.resource_id, p.resource_id) AS resource_id,
               CASE WHEN p.o IS NULL THEN 'added' WHEN n.o IS NULL THEN 'removed' WHEN n.c <> p.c OR n.u <> p.u THEN 'changed' END AS change_kind
          FROM x n FULL JOIN x p ON n.resource_id = p.resource_id AND n.o = p.o + 1)
        SELECT ids.snapshot_id, resource_id, change_kind FROM d JOIN ids USING (o) WHERE change_kind IS NOT NULL AND o > 1""",
    "p5_found": f"""
        WITH a AS (SELECT case_id, lower(trim(coalesce(decision, ''))) AS decision, {_sql_key("url")} AS url FROM replay_v1 WHERE case_id IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY exported_at DESC NULLS LAST, decision DESC, url DESC) = 1),
        b AS (SELECT case_id, lower(trim(coalesce(candidate.decision, ''))) AS decision, {_sql_key("candidate.url")} AS url FROM replay_v2 WHERE case_id IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY exported_at DESC NULLS LAST, decision DESC, url DESC) = 1),
        j AS (SELECT coalesce(a.case_id, b.case_id) AS case_id, a.case_id IS NULL AS na, b.case_id IS NULL AS nb, a.decision AS d1, b.decision AS d2, a.url AS u1, b.url AS u2 FROM a FULL JOIN b ON a.case_id = b.case_id)
        SELECT case_id, 'missing_in_v1' AS diff FROM j WHERE na UNION ALL SELECT case_id, 'missing_in_v2' FROM j WHERE nb
        UNION ALL SELECT case_id, 'decision' FROM j WHERE NOT na AND NOT nb AND d1 <> d2 UNION ALL SELECT case_id, 'url' FROM j WHERE NOT na AND NOT nb AND u1 <> u2""",
}
