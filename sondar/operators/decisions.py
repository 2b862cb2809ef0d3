"""Decision tables over candidates, systems and truth; the order of the rules is their meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.functions import urls as U
from sondar.operators.relational import first_rule

#: Closed vocabularies (fixed values).
SOURCES = ("dominio_oficial_prefeitura", "portal_externo_delegado", "banca", "diario", "desconocido")
STATES = ("confirmada", "rechazada", "desconocida")
ROLES = ("indice_listado", "indice_combinado", "detalle_individual", "noticia", "menu_sin_listado", "incompleto_antibot", "desconocido")
EVIDENCE = ("completa", "incompleta_antibot", "renderizada", "error_fetch")
BUCKETS = ("concurso_publico", "processo_seletivo", "combinado")
CONFIRMING = ("indice_oficial", "indice_oficial_combinado", "portal_externo_oficial")


def closed(c: Column, vocabulary: tuple[str, ...], fallback: str) -> Column:
    """c if the vocabulary has it, else the fallback; null is the fallback."""
    return F.when(c.isin(*vocabulary), c).otherwise(fallback)


def derived_decision(source: Column, authority: Column, identity: Column, role: Column, bucket: Column, evidence: Column, accessible: Column, procurement: Column, cultural: Column) -> Column:
    """One of eight decisions from a candidate's adjudicated attributes; the first rule that holds decides."""
    source, authority, identity = closed(source, SOURCES, "desconocido"), closed(authority, STATES, "desconocida"), closed(identity, STATES, "desconocida")
    role, bucket, evidence = closed(role, ROLES, "desconocido"), closed(bucket, BUCKETS, "combinado"), closed(evidence, EVIDENCE, "error_fetch")
    delegated = source == "portal_externo_delegado"
    rules = [
        ("revisar", ~accessible | (evidence == "error_fetch")),
        ("licitacao_rechazada", procurement),
        ("concurso_cultural_rechazado", cultural),
        ("revisar", (role == "incompleto_antibot") | (evidence == "incompleta_antibot")),
        ("detalle_individual_rechazado", role == "detalle_individual"),
        ("nao_encontrado", role == "noticia"),
        ("revisar", role == "menu_sin_listado"),
        ("nao_encontrado", ~role.isin("indice_listado", "indice_combinado")),
        ("revisar", identity != "confirmada"),
        ("revisar", authority != "confirmada"),
        ("portal_externo_oficial", delegated),
        ("indice_oficial_combinado", (role == "indice_combinado") | (bucket == "combinado")),
    ]
    return first_rule(rules, "indice_oficial")


def decision_kind(c: Column) -> Column:
    """confirm, review or negative; null for a decision that no system gives."""
    return F.when(c.isin(*CONFIRMING), "confirm").when(c == "revisar", "review").when((c == "nao_encontrado") | c.rlike("_rechazad[oa]$"), "negative")


def flip_class(d1: Column, u1: Column, d2: Column, u2: Column) -> Column:
    """How a decision moved from the first system to the second, in ten classes; null if one of them is unknown."""
    k1, k2 = decision_kind(d1), decision_kind(d2)
    same = F.when(k1 == "review", "both_review").when(k1 == "negative", "both_negative").when(U.metric_key(u1) == U.metric_key(u2), "both_confirm_same_resource").otherwise("both_confirm_distinct_resource")
    strength = lambda k: F.when(k == "confirm", 2).when(k == "review", 1).otherwise(0)
    named = F.when(strength(k2) > strength(k1), F.concat(F.lit("v2_"), k2, F.lit("_v1_"), k1)).otherwise(F.concat(F.lit("v1_"), k1, F.lit("_v2_"), k2))
    return F.when(k1.isNotNull() & k2.isNotNull(), F.when(k1 == k2, same).otherwise(named))


def truth_verdict(main: Column, extra: Column, url: Column) -> Column:
    """HIT, HOST, WRNG or MISS where truth has addresses; T-NEG or F-POS where it says there is none; SKIP where it is silent."""
    said = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    keys = F.filter(F.array(U.metric_key(main), U.metric_key(extra)), lambda k: k != "")
    none = (said(main) == "no_existe") | (said(extra) == "no_existe")
    key = U.metric_key(url)
    has = F.size(keys) > 0
    hosts = F.transform(keys, U.key_host)
    rules = [("MISS", has & (key == "")), ("HIT", has & F.array_contains(keys, key)), ("HOST", has & F.array_contains(hosts, U.key_host(key))), ("WRNG", has), ("T-NEG", none & (key == "")), ("F-POS", none)]
    return first_rule(rules, "SKIP")


def truth_expectation(main: Column, extra: Column) -> Column:
    """confirm if truth names an address, negative if it says there is none, golden_na if it is silent."""
    values = F.filter(F.transform(F.array(main, extra), lambda v: F.lower(F.trim(F.coalesce(v, F.lit(""))))), lambda v: v != "")
    return F.when(F.exists(values, lambda v: v != "no_existe"), "confirm").when(F.size(values) > 0, "negative").otherwise("golden_na")


def compared_to_truth(decision: Column, url: Column, main: Column, extra: Column) -> Column:
    """match, differ, or golden_na where truth is silent."""
    v, k = truth_verdict(main, extra, url), decision_kind(decision)
    good = ((v == "HIT") & (k == "confirm")) | ((v == "T-NEG") & (k == "negative"))
    return F.when(v == "SKIP", "golden_na").when(F.coalesce(good, F.lit(False)), "match").otherwise("differ")


def discrepancy(has_first: Column, has_second: Column, cause: Column, code: Column, flip: Column) -> Column:
    """The eight classes of why two systems differ: what kept the second from deciding comes before what it decided."""
    cause, code, flip = (F.coalesce(c, F.lit("")) for c in (cause, code, flip))
    rules = [
        ("no_computable", ~has_second),
        ("adquisicion", cause == "access_failure"),
        ("infra_modelo", cause.isin("model_failure", "configuration_failure", "internal_failure")),
        ("citas_gate", (cause == "evidence_failure") & code.isin("consensus_failed_final_gate", "agreement_review")),
        ("desacuerdo_abc", cause == "disagreement_unresolved"),
        ("ausencia_legitima", cause == "legitimate_absence"),
        ("no_computable", ~has_first),
        ("sin_discrepancia", flip.isin("both_confirm_same_resource", "both_review", "both_negative")),
    ]
    return first_rule(rules, "semantico_real")


def bucket_state(confidence: Column, url: Column, notes: Column, bucket: str) -> Column:
    """CONF, PEND, VAC_VERIF or VAC_RAW of one bucket of a municipality."""
    http = U.has_http(url)
    seen = F.contains(F.lower(F.coalesce(notes, F.lit(""))), F.lit(f"[sin_indice_oficial_chrome:{bucket}]"))
    return first_rule([("CONF", (F.trim(F.coalesce(confidence, F.lit(""))) == "confirmado") & http), ("PEND", http), ("VAC_VERIF", seen)], "VAC_RAW")


def municipality_state(a: Column, b: Column) -> Column:
    """green, amber, closed or red from the states of both buckets."""
    return first_rule([("green", (a == "CONF") & (b == "CONF")), ("amber", (a == "PEND") | (b == "PEND")), ("closed", (a == "CONF") | (b == "CONF"))], "red")


def prior_state(a: Column, b: Column) -> Column:
    """State of an earlier output from its two columns: review prevails, equal ones stay, others are mixed; null where one is unknown."""
    name = lambda c: F.when(c == "boa", "confirmado").when(c == "nao_encontrada", "nao_encontrado").when(c == "revisar", "revisar")
    a, b = (F.coalesce(F.trim(c), F.lit("")) for c in (a, b))
    x, y = name(a), name(b)
    known = ((a == "") | x.isNotNull()) & ((b == "") | y.isNotNull())
    rules = F.when((a == "") & (b == ""), "sem_saida_previa").when((a == "revisar") | (b == "revisar"), "revisar").when((a == "") | (b == "") | (a == b), F.coalesce(x, y)).otherwise("misto")
    return F.when(known, rules)


def gate_blockers(authority: Column, identity: Column, accessible: Column, evidence: Column, decision: Column, record_bucket: Column, bucket: Column) -> Column:
    """What keeps a selected candidate from being confirmed, in order; empty if nothing does."""
    supports = (record_bucket == bucket) | (record_bucket == "combinado")
    off = lambda c, good: ~F.coalesce(good, F.lit(False))
    said = lambda name, c: F.concat(F.lit(f"{name}="), F.coalesce(c, F.lit("")))
    names = F.array(
        F.when(off(authority, authority == "confirmada"), said("authority", authority)),
        F.when(off(identity, identity == "confirmada"), said("identity", identity)),
        F.when(off(evidence, accessible & evidence.isin("completa", "renderizada")), said("evidence_state", evidence)),
        F.when(off(decision, decision.isin(*CONFIRMING)), said("decision", decision)),
        F.when(off(record_bucket, supports), said("bucket_incompatible", record_bucket)),
    )
    return F.array_compact(names)


def resolved_picks(records: DataFrame, unit: list[str], bucket: str, record_id: str, record_bucket: str, decision: str) -> DataFrame:
    """unit, record_id, outcome: the record selected for each unit without a model, or why there is none.

    Only confirming records that serve the unit's bucket count; records of the bucket itself hide
    combined ones. One distinct record is selected, several are a tie. One aggregation by unit,
    with map-side combine; the records themselves are never gathered.
    """
    ok = F.col(decision).isin(*CONFIRMING)
    own, both = ok & (F.col(record_bucket) == F.col(bucket)), ok & (F.col(record_bucket) == "combinado")
    one = lambda cond: [F.min(F.when(cond, F.col(record_id))), F.max(F.when(cond, F.col(record_id))), F.count_if(cond)]
    lo1, hi1, n1 = one(own)
    lo2, hi2, n2 = one(both)
    g = records.groupBy(*unit).agg(lo1.alias("lo1"), hi1.alias("hi1"), n1.alias("n1"), lo2.alias("lo2"), hi2.alias("hi2"), n2.alias("n2"))
    lo, hi, n = (F.when(F.col("n1") > 0, F.col(f"{x}1")).otherwise(F.col(f"{x}2")) for x in ("lo", "hi", "n"))
    outcome = F.when(F.coalesce(n, F.lit(0)) == 0, "none_eligible").when(lo != hi, "tie").when(n > 1, "selected_duplicate").otherwise("selected")
    return g.select(*unit, F.when(lo == hi, lo).alias(record_id), outcome.alias("outcome"))

