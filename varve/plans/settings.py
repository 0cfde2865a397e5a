"""Settings of the tables the known sources deliver, as data."""

from __future__ import annotations

from varve.spec import TableSpec

# The key of every table, and how its files are written.
ASSET_TABLES = [
    TableSpec(name, "id")
    for name in (
        "channels",
        "email_templates",
        "emails",
        "form_fields",
        "forms",
        "landing_pages",
        "programs",
        "smart_campaigns",
        "smart_lists",
        "snippets",
        "static_lists",
    )
]
BULK_TABLES = [
    TableSpec("activities", "marketoguid", quote_escape='"', multiline=True),
    TableSpec("leads", "id", quote_escape='"', multiline=True, where="try_cast(id AS integer) IS NOT NULL"),
]
CAMPAIGN_TABLES = [
    TableSpec("campaigns", "campaign_id"),
    TableSpec("leads", "external_system_id"),
    TableSpec("lead_status", "external_system_id"),
    TableSpec("message_attempt", "external_system_id"),
    TableSpec("message_log", "external_system_id"),
]
SNAPSHOT_TABLES = [
    TableSpec("Declines", "PaymentEffectiveDate"),
    TableSpec("Transactions", "PaymentEffectiveDate"),
]

# The array of a response body that holds the rows of each detail table.
DETAIL_ROWS = {
    "message_log": "message_logs",
    "lead_status": "lead_details",
    "message_attempt": "lead_details",
}
