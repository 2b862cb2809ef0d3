"""Authority, identity and consensus of candidates, from what their evidence shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondar.functions import text as T
from sondar.functions import urls as U
from sondar.operators.decisions import CONFIRMING
from sondar.operators.relational import first_rule

#: Kinds of provenance that confirm an official chain (fixed values).
CONFIRMING_KINDS = ("official_navigation", "official_referrer", "official_brand")


def official_host(url: Column, municipality: Column, suffix: str) -> Column:
    """Whether an address lies under the official suffix with the municipality's name as one of its labels."""
    h = U.host(url)
    labels = F.split(F.substring(h, F.lit(1), F.length(h) - len(suffix)), r"\.")
    return F.coalesce(h.endswith(suffix) & F.array_contains(labels, T.slug_plain(municipality)), F.lit(False))


def redirect_confirms(requested: Column, final: Column, municipality: Column, suffix: str) -> Column:
    """Whether a redirect leaves an official host for another one that isn't listed as never official. It proves authority, not identity."""
    a, b = U.host(requested), U.host(final)
    return (a != "") & (b != "") & (a != b) & ~U.listed_host(final) & official_host(requested, municipality, suffix)


def redirect_provenance(requested: Column, final: Column, municipality: Column, suffix: str) -> Column:
    """One map of provenance where a redirect confirms an official origin, else an empty array."""
    item = F.create_map(F.lit("kind"), F.lit("official_referrer"), F.lit("municipio"), municipality, F.lit("referrer"), requested, F.lit("label"), F.lit("http_redirect_official_origin"), F.lit("evidence"), F.concat(U.host(requested), F.lit(" -> "), U.host(final)))
    return F.when(redirect_confirms(requested, final, municipality, suffix), F.array(item)).otherwise(F.array().cast("array<map<string,string>>"))


def registered(df: DataFrame, registry: DataFrame, key: str, municipality: str, url: str) -> DataFrame:
    """(key, registered_host, evidence) of the rows whose host is a registered one of their municipality, or below one.

    Municipalities are compared folded; of several entries the first by host counts. An equi-join
    on the municipality, whose entries are few; the host is tested after it.
    """
    a = df.select(key, T.fold(F.col(municipality)).alias("__m"), U.bare_host(F.col(url)).alias("__h")).where("__m != '' and __h != ''")
    b = registry.select(T.fold(F.col("municipio")).alias("__m"), U.bare_host(F.col("host")).alias("__r"), F.coalesce("evidencia", F.lit("")).alias("__e")).where("__r != ''")
    j = a.join(b, "__m").where((F.col("__h") == F.col("__r")) | F.endswith(F.col("__h"), F.concat(F.lit("."), F.col("__r"))))
    return j.groupBy(key).agg(F.min(F.struct("__r", "__e")).alias("x")).select(key, F.col("x.__r").alias("registered_host"), F.col("x.__e").alias("evidence"))


def provenance_confirms(provenance: Column, municipality: Column) -> Column:
    """Whether some item of provenance is of a confirming kind and of the same municipality; null and empty confirm nothing."""
    m = T.fold(municipality)
    return F.coalesce(F.exists(provenance, lambda p: p["kind"].isin(*CONFIRMING_KINDS) & (T.fold(p["municipio"]) == m)), F.lit(False))


def identity_state(usable: Column, url: Column, named: Column, chain: Column, municipality: Column, suffix: str) -> Column:
    """rechazada, confirmada or desconocida. usable: the page is neither missing nor parked; named: it names the municipality; chain: provenance confirms it."""
    foreign = U.host(url).endswith(suffix) & ~official_host(url, municipality, suffix)
    rules = [("rechazada", ~usable | F.coalesce(foreign, F.lit(False))), ("confirmada", F.coalesce(named | chain, F.lit(False)))]
    return first_rule(rules, "desconocida")


def source_and_authority(url: Column, branded: Column, chain: Column, identity: Column, external: Column, suffix: str) -> Column:
    """(source_kind, authority), never from the name in an address."""
    official = U.host(url).endswith(suffix)
    kind = first_rule([("portal_externo_delegado", ~official & (chain | external)), ("dominio_oficial_prefeitura", official)], "desconocido")
    sure = F.when(official, (identity == "confirmada") & branded).otherwise(chain)
    return F.struct(kind.alias("source_kind"), F.when(F.coalesce(sure, F.lit(False)), "confirmada").otherwise("desconocida").alias("authority"))


def agree(d1: Column, b1: Column, u1: Column, d2: Column, b2: Column, u2: Column) -> Column:
    """Whether two proposals mean the same: both ask for review, or decision, bucket and resource are equal."""
    same = (d1 == d2) & (b1 == b2) & (U.metric_key(u1) == U.metric_key(u2))
    return F.coalesce(((d1 == "revisar") & (d2 == "revisar")) | same, F.lit(False))


def consensus_code(requested: Column, d1: Column, b1: Column, agreed: Column, d2: Column, prosecutor: Column, gate_open: Column) -> Column:
    """What two proposals come to without a judge; `judge` where only one could tell. The order of the rules is their meaning."""
    affirmative = d1.isin(*CONFIRMING)
    verdict = F.coalesce(prosecutor, F.lit(""))
    rules = [
        ("bucket_mismatch", requested.isNotNull() & affirmative & (b1 != requested)),
        ("agreement_review", d1 == "revisar"),
        ("proposal_a_not_affirmative", ~F.coalesce(affirmative, F.lit(False))),
        ("prosecutor_invalid", ~verdict.isin("", "sustain", "block", "review")),
        ("prosecutor_review", verdict == "review"),
        ("prosecutor_invalid", (verdict == "sustain") & ~agreed),
        ("prosecutor_invalid", (verdict == "block") & (d2 != "revisar")),
        ("consensus", agreed & gate_open),
        ("consensus_failed_final_gate", agreed),
        ("prosecutor_review", (verdict != "") & (verdict != "block")),
    ]
    return first_rule(rules, "judge")


def prosecutor_result(outcomes: Column) -> Column:
    """block if an accusation is proved, review if one is unresolved, else sustain."""
    return F.when(F.array_contains(outcomes, "proved"), "block").when(F.array_contains(outcomes, "unresolved"), "review").otherwise("sustain")


def missing_dimensions(dimensions: Column, required: tuple[str, ...]) -> Column:
    """Required citation dimensions that aren't there, sorted."""
    return F.array_sort(F.array_except(F.array(*map(F.lit, required)), dimensions))


def find_all(text: Column, needle: Column, most: int | None = 20) -> Column:
    """(offsets, has_more) of the occurrences of a needle that don't overlap, at most `most` offsets; an empty needle has none."""
    parts = F.split(text, F.concat(F.lit("\\Q"), needle, F.lit("\\E")), -1)
    zero = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<int>").alias("found"))
    step = F.aggregate(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), zero, lambda s, p: F.struct((s["at"] + F.length(p) + F.length(needle)).cast("int").alias("at"), F.concat(s["found"], F.array((s["at"] + F.length(p)).cast("int"))).alias("found")))
    found = F.when(F.length(needle) > 0, step["found"]).otherwise(F.array().cast("array<int>"))
    return F.struct((found if most is None else F.slice(found, 1, most)).alias("offsets"), (F.lit(False) if most is None else F.size(found) > most).alias("has_more"))


def paged(text: Column, start: int, length: int) -> Column:
    """(content, next_start, has_more) of a slice of a text; next_start is null at its end."""
    n = F.length(text)
    more = F.lit(start + length) < n
    return F.struct(F.substring(text, start + 1, length).alias("content"), F.when(more, F.lit(start + length)).alias("next_start"), more.alias("has_more"))


def json_row(*cols: Column) -> Column:
    """A JSON array of strings, as text."""
    return F.to_json(F.array(*cols))


def record_id(*cols: Column) -> Column:
    """`v1:` and the SHA-1 of a JSON array of the given values; null counts as empty."""
    return F.concat(F.lit("v1:"), F.sha1(json_row(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])))


def drawn(seed: int, municipality: Column, bucket: Column, of: int = 10) -> Column:
    """A stable share of 1 in `of` units, by the first 8 bytes of the SHA-256 of seed, municipality and bucket between zero bytes."""
    h = F.sha2(F.concat_ws("\0", F.lit(str(seed)), municipality, bucket), 256)
    return F.conv(F.substring(h, 1, 16), 16, 10).cast("decimal(20,0)") % of == 0


def select_sample(df: DataFrame, identity: str, family: str, state: str, borderline: Column, size: int, reserve: int, seed: str) -> DataFrame:
    """(identity, family, state, phase) of `size` rows: first a reserve of borderline ones, then the rest, each in turns.

    Families take turns, and within a family its states do; within a stratum the order is a stable
    random one. Fewer rows than `size` give all of them. What is carried from phase to phase
    is at most `size` rows; strata are cut to it before the shuffle.
    """
    from pyspark.sql import Window as W

    def turns(x: DataFrame, n: int, phase: str) -> DataFrame:
        own = F.sha2(F.concat(F.lit(f"{seed}|"), F.col(identity)), 256)
        x = x.withColumn("__r", F.row_number().over(W.partitionBy(family, state).orderBy(own, identity))).where(F.col("__r") <= n)
        x = x.withColumn("__t", F.row_number().over(W.partitionBy(family).orderBy("__r", state))).where(F.col("__t") <= n)
        return x.orderBy("__t", family).limit(n).select(identity, family, state, F.lit(phase).alias("phase"), "__t")

    rows = df.select(identity, family, state, borderline.alias("__b"))
    first = turns(rows.where("__b"), min(reserve, size), "borderline_reserve")
    rest = turns(rows.join(first.select(identity), identity, "left_anti"), size, "family_fill")
    # the reserve comes first; the rest fills up to size
    both = first.withColumn("__p", F.lit(0)).unionByName(rest.withColumn("__p", F.lit(1)))
    return both.orderBy("__p", "__t", family).limit(size).drop("__p", "__t")
