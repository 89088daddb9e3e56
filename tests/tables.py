"""Small literal tables in the declared schemas."""

from datetime import datetime, timedelta

from sieveline.sources.schemas import SCHEMAS

T0 = datetime(2024, 3, 1, 12, 0, 0)


def at(minutes=0.0, **parts):
    return T0 + timedelta(minutes=minutes, **parts)


def table(spark, name, rows):
    """Rows given as dicts; absent columns are NULL."""
    schema = SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)


def identity(spark, rows):
    """Rows given as (ts, account, event_type, outcome, asn, extra columns...)."""
    full = []
    for ts, account, event_type, outcome, asn, *extra in rows:
        row = {
            "ts": ts, "org_id": "o1", "account_id": account, "ip": f"10.0.0.{asn}", "asn": asn,
            "device_fingerprint": "d", "user_agent": "ua", "event_type": event_type, "outcome": outcome,
            "campaign_id": "", "is_attack": False,
        }
        row.update(extra[0] if extra else {})
        full.append(row)
    return table(spark, "identity_events", full)


FAIL = ("auth.signin", "failure")
OK = ("auth.signin", "success")


def planted_chain(account="victim", start=0.0):
    """Nine failures, success, enrolment, second success, mailbox rule and consent grant."""
    attack = {"is_attack": True, "campaign_id": "c"}
    rows = [(at(start - m), account, *FAIL, 7, attack) for m in range(1, 10)]
    rows.append((at(start), account, *OK, 7, attack))
    rows.append((at(start + 2), account, "auth.mfa.add", "", 7, attack))
    rows.append((at(start + 10), account, *OK, 7, attack))
    rows.append((at(start + 18), account, "mailbox.rule.create", "", 7, attack))
    rows.append((at(start + 25), account, "oauth.consent.grant", "", 7, attack))
    return rows
