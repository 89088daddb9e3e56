"""Account takeover: failed sign-in bursts, new origins and follow-on persistence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.clock import bucket_start, minute_boundaries
from sieveline.functions.scores import flag, points_if
from sieveline.operators.firsts import first_seen
from sieveline.operators.intervals import first_match_among, interval_join, lookback_join
from sieveline.operators.spread import first_non_null

ENTITY = ["org_id", "account_id"]
# Event names and columns of the sign-in history.
SIGNIN, MFA_ADD = "auth.signin", "auth.mfa.add"
MAILBOX_RULE, OAUTH_GRANT = "mailbox.rule.create", "oauth.consent.grant"
EVENT_COLUMNS = [
    "ts", "org_id", "account_id", "ip", "asn", "device_fingerprint", "user_agent", "campaign_id", "is_attack",
]


def _is_event(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _is_signin(outcome: str) -> Column:
    return _is_event(SIGNIN) & (F.col("outcome") == outcome)


def failure_buckets(identity: DataFrame, width: str, min_failures: int) -> DataFrame:
    """Tumbling buckets in which an account failed to sign in at least ``min_failures`` times."""
    failed = identity.where(_is_signin("failure")).withColumn("bucket_start", bucket_start("ts", width))
    return (
        failed.groupBy(*ENTITY, "bucket_start")
        .agg(
            F.count(F.lit(1)).alias("failures_in_10m"),
            F.min("ts").alias("first_fail_ts"),
            F.max("ts").alias("last_fail_ts"),
            first_non_null("ip", ["ts"]).alias("sample_fail_ip"),
            first_non_null("asn", ["ts"]).alias("sample_fail_asn"),
        )
        .where(F.col("failures_in_10m") >= min_failures)
    )


def failed_login_bursts(
    identity: DataFrame, enrichment: DataFrame, width: str = "10 minutes", min_failures: int = 6
) -> DataFrame:
    """Failed sign-in bursts with the provider of a sample address (addresses may repeat there)."""
    bursts = failure_buckets(identity, width, min_failures).withColumnsRenamed(
        {
            "first_fail_ts": "first_ts", "last_fail_ts": "last_ts",
            "sample_fail_ip": "sample_ip", "sample_fail_asn": "sample_asn",
        }
    )
    about = enrichment.select(F.col("ip").alias("__ip"), "asn_type", "provider_category", "provider_brand_bucket")
    return bursts.join(about, F.col("__ip") == F.col("sample_ip"), "left").drop("__ip")


def new_origin_successes(
    identity: DataFrame, width: str = "10 minutes", min_failures: int = 6, within: str = "60 minutes"
) -> DataFrame:
    """Bursts followed, within ``within``, by the account's first success from an ASN.

    First successes are aggregated and paired with the few bursts before their rows are
    fetched, so the full sign-in history is joined only on (entity, ASN, instant).
    """
    success = identity.where(_is_signin("success"))
    firsts = first_seen(success, [*ENTITY, "asn"], "ts", "success_ts").withColumnRenamed("asn", "success_asn")
    bursts = failure_buckets(identity, width, min_failures)
    pairs = interval_join(bursts, firsts, "last_fail_ts", "success_ts", within, keys=ENTITY)
    rows = success.select(
        *ENTITY,
        F.col("asn").alias("success_asn"),
        F.col("ts").alias("success_ts"),
        F.col("ip").alias("success_ip"),
        "device_fingerprint", "user_agent", "campaign_id", "is_attack",
    )
    return pairs.join(rows, [*ENTITY, "success_asn", "success_ts"]).select(
        *ENTITY, "bucket_start", "failures_in_10m", "first_fail_ts", "last_fail_ts",
        "sample_fail_ip", "sample_fail_asn", "success_ts", "success_ip", "success_asn",
        "device_fingerprint", "user_agent", "campaign_id", "is_attack",
    )


def mfa_devices_added(identity: DataFrame) -> DataFrame:
    return identity.where(_is_event(MFA_ADD)).select(*EVENT_COLUMNS)


def mailbox_rules_created(identity: DataFrame) -> DataFrame:
    return identity.where(_is_event(MAILBOX_RULE)).select(*EVENT_COLUMNS)


def success_after_mfa(identity: DataFrame, within: str = "4 hours") -> DataFrame:
    """First successful sign-in after each second-factor enrolment."""
    paired = first_match_among(
        identity, "ts", _is_event(MFA_ADD), _is_signin("success"), "mfa_ts", "success_ts", within, ENTITY,
        {
            "mfa_ip": F.col("ip"), "mfa_asn": F.col("asn"), "mfa_device": F.col("device_fingerprint"),
            "campaign_id": F.col("campaign_id"), "is_attack": F.col("is_attack"),
        },
        {
            "success_ip": F.col("ip"), "success_asn": F.col("asn"), "success_device": F.col("device_fingerprint"),
        },
    )
    return paired.select(
        *ENTITY, "mfa_ts", "success_ts",
        minute_boundaries(F.col("mfa_ts"), F.col("success_ts")).alias("minutes_after_mfa"),
        "mfa_ip", "mfa_asn", "mfa_device", "success_ip", "success_asn", "success_device",
        "campaign_id", "is_attack",
    )


def oauth_grants_with_context(identity: DataFrame, lookback: str = "30 minutes") -> DataFrame:
    """Consent grants with every successful sign-in of the look-back window; none keeps the grant."""
    grants = identity.where(_is_event(OAUTH_GRANT)).select(
        *ENTITY, F.col("ts").alias("grant_ts"), F.col("ip").alias("grant_ip"), F.col("asn").alias("grant_asn"),
        "device_fingerprint", "user_agent", "campaign_id", "is_attack",
    )
    success = identity.where(_is_signin("success")).select(
        *ENTITY, F.col("ts").alias("success_ts"), F.col("ip").alias("success_ip"),
        F.col("asn").alias("success_asn"),
    )
    return lookback_join(grants, success, "grant_ts", "success_ts", lookback, ENTITY).select(
        *ENTITY, "grant_ts", "grant_ip", "grant_asn", "device_fingerprint", "user_agent",
        "success_ts", "success_ip", "success_asn", "campaign_id", "is_attack",
    )


def takeover_chains(
    identity: DataFrame,
    width: str = "10 minutes",
    min_failures: int = 6,
    within: str = "60 minutes",
    ordered: bool = False,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """One scored row per account: burst, new origin, then persistence steps.

    The three follow-on steps come from one conditional aggregate.  ``ordered`` counts a
    step only when it happens at or after the new-origin success.  ``pairs`` may hand over a
    stored result of :func:`new_origin_successes` for the same parameters.
    """
    if pairs is None:
        pairs = new_origin_successes(identity, width, min_failures, within)

    def sample(name: str, out: str) -> Column:
        return first_non_null(name, ["success_ts"]).alias(out)

    accounts = pairs.groupBy(*ENTITY).agg(
        F.max("failures_in_10m").alias("failures_in_10m"),
        F.min("first_fail_ts").alias("first_fail_ts"),
        F.max("last_fail_ts").alias("last_fail_ts"),
        F.min("success_ts").alias("new_asn_success_ts"),
        sample("success_ip", "new_asn_success_ip"),
        sample("success_asn", "new_asn_success_asn"),
        sample("device_fingerprint", "device_fingerprint"),
        sample("user_agent", "user_agent"),
        F.max(F.coalesce("is_attack", F.lit(False))).alias("is_attack"),
        sample("campaign_id", "campaign_id"),
    )
    steps = {"mfa_add": MFA_ADD, "mailbox_rule": MAILBOX_RULE, "oauth_grant": OAUTH_GRANT}
    follow_on = identity.where(F.col("event_type").isin(*steps.values()))
    if ordered:
        follow_on = follow_on.join(accounts.select(*ENTITY, "new_asn_success_ts"), ENTITY).where(
            F.col("ts") >= F.col("new_asn_success_ts")
        )
    firsts = follow_on.groupBy(*ENTITY).agg(
        *[F.min(F.when(_is_event(kind), F.col("ts"))).alias(f"{name}_ts") for name, kind in steps.items()]
    )
    joined = accounts.join(firsts, ENTITY, "left")
    # 30 for the new origin, 30, 30 and 25 for the steps.
    has = {name: F.col(f"{name}_ts").isNotNull() for name in steps}
    score = (
        F.lit(30)
        + points_if(has["mfa_add"], 30)
        + points_if(has["mailbox_rule"], 30)
        + points_if(has["oauth_grant"], 25)
    )
    return joined.select(
        "*", *[has[name].cast("int").alias(f"has_{name}") for name in steps], score.alias("risk_score")
    )


def takeover_rollup(identity: DataFrame) -> DataFrame:
    """Which chain steps each account shows at all, with their additive score."""
    # The weight of each step.
    steps = {
        "has_failures": (_is_signin("failure"), 10),
        "has_success": (_is_signin("success"), 5),
        "has_mfa_add": (_is_event(MFA_ADD), 30),
        "has_mailbox_rule": (_is_event(MAILBOX_RULE), 25),
        "has_oauth_grant": (_is_event(OAUTH_GRANT), 20),
    }
    seen = identity.groupBy(*ENTITY).agg(*[F.max(flag(cond)).alias(name) for name, (cond, _) in steps.items()])
    score = sum((F.col(name) * weight for name, (_, weight) in steps.items()), F.lit(0))
    return seen.withColumn("risk_score", score)
