"""Known feeds of public APIs. None could be called where this was written: only their reading is tested.

Addresses in braces are filled from the settings, ``{since}``, ``{until}`` and the
members of records aside. A service that takes no upper bound, or none, is read
in one slice, and what is outside the range is dropped. Feeds without an id of
an event's own have none: the content's hash tells their records apart.
"""

from __future__ import annotations

import urllib.parse
from collections.abc import Callable
from dataclasses import fields, replace
from typing import Any

from .cursors import CursorRequest
from .http import Request, filled

# The services' addresses and names.
FEEDS: dict[str, dict[str, Request]] = {
    "bitwarden": {"events": Request("https://api.bitwarden.com/public/events", "data", (), ("date",), "start", "end", paging="cursor", position="continuationToken", following="continuationToken")},
    "box": {"events": Request("https://api.box.com/2.0/events", "entries", ("event_id",), ("created_at",), "created_after", "created_before", paging="cursor", position="stream_position", following="next_stream_position", fixed={"stream_type": "admin_logs"})},
    "cato": {
        "events": Request(
            "https://api.catonetworks.com/api/v1/graphql2", "data/eventsFeed/accounts/*/records", (), ("time",), paging="cursor", position="variables/marker", following="data/eventsFeed/marker", ends_empty=True,
            body={"query": "query events($account: ID!, $marker: String) { eventsFeed(accountIDs: [$account], marker: $marker) { marker fetchedCount accounts { id records { time fieldsMap } } } }", "variables": {"account": "{account}", "marker": ""}},
        )
    },
    "cylance": {
        "detections": Request("https://protectapi.cylance.com/detections/v2", "page_items", ("Id",), ("ReceivedTime",), "start", "end", paging="page", position="page", size=("page_size", 200), detail="https://protectapi.cylance.com/detections/v2/{Id}/details", listed=("ReceivedTime",)),
        "threats": Request("https://protectapi.cylance.com/threats/v2", "page_items", ("sha256",), ("last_found",), "start_time", "end_time", paging="page", position="page", size=("page_size", 200), detail="https://protectapi.cylance.com/threats/v2/{sha256}", listed=("last_found",)),
        "memory": Request("https://protectapi.cylance.com/memoryprotection/v2", "page_items", ("device_image_file_event_id",), ("created",), "start_time", "end_time", paging="page", position="page", size=("page_size", 200), detail="https://protectapi.cylance.com/memoryprotection/v2/{device_image_file_event_id}", listed=("created",)),
    },
    "defender": {"alerts": Request("https://graph.microsoft.com/v1.0/security/alerts_v2", "value", ("id",), ("createdDateTime",), paging="url", following="@odata.nextLink", filter=("$filter", "createdDateTime ge {since} and createdDateTime lt {until}"), conditions=("odata", "$filter"))},
    "duo": {
        "auth": Request("https://{host}/admin/v2/logs/authentication", "response/authlogs", ("txid",), ("isotimestamp",), "mintime", "maxtime", "ms", "cursor", "next_offset", "response/metadata/next_offset"),
        "admin": Request("https://{host}/admin/v1/logs/administrator", "response", (), ("timestamp",), "mintime", None, "s"),
    },
    "entraid": {"risks": Request("https://graph.microsoft.com/v1.0/identityProtection/riskDetections", "value", ("id",), ("activityDateTime",), paging="url", following="@odata.nextLink", filter=("$filter", "activityDateTime ge {since} and activityDateTime lt {until}"), conditions=("odata", "$filter"))},
    "gmail": {"messages": Request("https://gmail.googleapis.com/gmail/v1/users/{user}/messages", "messages", ("id",), ("internalDate",), bound="s", paging="cursor", position="pageToken", following="nextPageToken", size=("maxResults", 500), filter=("q", "{query} after:{since} before:{until}"), detail="https://gmail.googleapis.com/gmail/v1/users/{user}/messages/{id}?format=full", open_below=True)},
    "harmony": {
        "entities": Request(
            "https://{host}/app/hec-api/v1.0/search/query", "responseData", ("entityInfo/entityId",), ("entityInfo/entityCreated",), "requestData/entityFilter/startDate", "requestData/entityFilter/endDate", paging="cursor", position="requestData/scrollId", following="responseEnvelope/scrollId", ends_empty=True,
            body={"requestData": {"entityFilter": {"saas": "{saas}", "saasEntity": "{entity}"}, "entityExtendedFilter": [], "scrollId": ""}},
            conditions=("extended", "requestData/entityExtendedFilter"),
        )
    },
    "hubspot": {"audit": Request("https://api.hubapi.com/account-info/v3/activity/audit-logs", "results", ("id",), ("occurredAt",), "occurredAfter", "occurredBefore", paging="cursor", position="after", following="paging/next/after")},
    "itglue": {"logs": Request("https://api.itglue.com/logs", "data", ("id",), ("attributes/created-at",), "filter[created_at]", paging="url", following="links/next")},
    "mimecast": {"audit": Request("https://api.services.mimecast.com/api/audit/get-audit-events", "data", ("id",), ("eventTime",), "data/[0]/startDateTime", "data/[0]/endDateTime", paging="cursor", position="meta/pagination/pageToken", following="meta/pagination/next", size=("meta/pagination/pageSize", 100), body={})},
    "ms_graph": {"any": Request("https://graph.microsoft.com/v1.0/{resource}", "value", ("id",), ("createdDateTime",), paging="url", following="@odata.nextLink", filter=("$filter", "createdDateTime ge {since} and createdDateTime lt {until}"), conditions=("odata", "$filter"))},
    "office365": {"content": Request("https://manage.office.com/api/v1.0/{tenant}/activity/feed/subscriptions/content", "", ("Id",), ("CreationTime",), "startTime", "endTime", paging="link", fixed={"contentType": "{content_type}"}, detail="{contentUri}", listed=("contentCreated",))},
    "okta": {"log": Request("https://{host}/api/v1/logs", "", ("uuid",), ("published",), "since", "until", paging="link", fixed={"sortOrder": "ASCENDING"}, size=("limit", 1000))},
    "onepassword": {
        "auditevents": Request("https://events.1password.com/api/v2/auditevents", "items", ("uuid",), ("timestamp",), "start_time", "end_time", paging="cursor", position="cursor", following="cursor", size=("limit", 1000), body={}),
        "itemusages": Request("https://events.1password.com/api/v2/itemusages", "items", ("uuid",), ("timestamp",), "start_time", "end_time", paging="cursor", position="cursor", following="cursor", size=("limit", 1000), body={}),
        "signinattempts": Request("https://events.1password.com/api/v2/signinattempts", "items", ("uuid",), ("timestamp",), "start_time", "end_time", paging="cursor", position="cursor", following="cursor", size=("limit", 1000), body={}),
    },
    "pandadoc": {"logs": Request("https://api.pandadoc.com/public/v2/logs", "results", ("id",), ("request_time",), "since", "to", paging="page", position="page", size=("count", 100))},
    "proofpoint": {
        name: Request("https://tap-api-v2.proofpoint.com/v2/siem/all", key, ("GUID", "id"), ("messageTime", "clickTime"), "sinceTime", fixed={"format": "json"})
        for name, key in {"messages_delivered": "messagesDelivered", "messages_blocked": "messagesBlocked", "clicks_permitted": "clicksPermitted", "clicks_blocked": "clicksBlocked"}.items()
    },
    "sentinel_one": {
        name: Request("https://{host}/web/api/v2.1/" + path, "data", ("id",), ("createdAt",), "createdAt__gte", "createdAt__lt", paging="cursor", position="cursor", following="pagination/nextCursor", size=("limit", 1000))
        for name, path in {"activities": "activities", "alerts": "cloud-detection/alerts", "threats": "threats"}.items()
    },
    "servicenow": {"table": Request("https://{instance}.service-now.com/api/now/table/{table}", "result", ("sys_id",), ("sys_created_on",), bound="sql", paging="offset", position="sysparm_offset", size=("sysparm_limit", 1000), fixed={"sysparm_display_value": "false", "sysparm_exclude_reference_link": "true"}, filter=("sysparm_query", "{query}^sys_created_on>={since}^sys_created_on<{until}^ORDERBYsys_created_on^ORDERBYsys_id"), conditions=("encoded", "sysparm_query"))},
    "slack": {"audit": Request("https://api.slack.com/audit/v1/logs", "entries", ("id",), ("date_create",), "oldest", "latest", "s", "cursor", "cursor", "response_metadata/next_cursor", newest_first=True)},
    "sophos": {"events": Request("https://{host}/siem/v1/events", "items", ("id",), ("created_at",), "from_date", None, "s", "cursor", "cursor", "next_cursor")},
    "sublime": {"audit": Request("https://platform.sublime.security/v0/audit-log/events", "events", ("id",), ("created_at",), "created_at[gte]", "created_at[lt]", paging="offset", position="offset", size=("limit", 500))},
    "threatlocker": {"audit": Request("https://portalapi.{instance}.threatlocker.com/portalapi/{path}", "", ("actionId", "approvalRequestId", "id"), ("dateTime",), "startDate", "endDate", paging="page", position="pageNumber", size=("pageSize", 100), body={"orderBy": "dateTime", "isAscending": True}, conditions=("members", ""))},
    "trendmicro": {"alerts": Request("https://api.xdr.trendmicro.com/v3.0/workbench/alerts", "items", ("id",), ("createdDateTime",), "startDateTime", "endDateTime", paging="url", following="nextLink")},
    "wiz": {
        "any": Request("{url}", "{connection}/nodes", ("id",), ("{time_field}",), "variables/filterBy/{time_field}/after", paging="cursor", position="variables/after", following="{connection}/pageInfo/endCursor", body={"query": "{query}", "variables": {}}, open_below=True, ends_empty=True)
    },
    "zendesk": {"audit": Request("https://{host}/api/v2/audit_logs.json", "audit_logs", ("id",), ("created_at",), "filter[created_at][]", "filter[created_at][]", paging="url", following="links/next", size=("page[size]", 100))},
}


def _filled(value: Any, settings: dict[str, str]) -> Any:
    if isinstance(value, str):
        return filled(value, settings).removeprefix("{query}^").removeprefix("{query} ")
    if isinstance(value, (tuple, list)):
        return type(value)(_filled(v, settings) for v in value)
    return {k: _filled(v, settings) for k, v in value.items()} if isinstance(value, dict) else value


def requests(service: str, **settings: str) -> dict[str, Request]:
    """A service's requests with the settings filled in, wherever their names stand in braces."""
    return {name: replace(r, **{f.name: _filled(getattr(r, f.name), settings) for f in fields(r)}) for name, r in FEEDS[service].items()}


# The addresses and names of services that give a cursor to go on from.
CURSORS: dict[str, CursorRequest] = {
    "box": CursorRequest("https://api.box.com/2.0/events", "entries", "stream_position", "next_stream_position", "0", "now", fixed={"stream_type": "admin_logs_streaming", "limit": 500}),
    "cato": CursorRequest(FEEDS["cato"]["events"].url, FEEDS["cato"]["events"].items, "variables/marker", "data/eventsFeed/marker", "", body=FEEDS["cato"]["events"].body),
    "gmail_history": CursorRequest(
        "https://gmail.googleapis.com/gmail/v1/users/{member}/history", "history", "startHistoryId", "historyId", profile=("https://gmail.googleapis.com/gmail/v1/users/{member}/profile", "historyId"), page=("pageToken", "nextPageToken"),
        fixed={"maxResults": 500, "historyTypes": ["messageDeleted", "labelAdded", "labelRemoved"]},
    ),
} | {
    f"onepassword_{name}": CursorRequest(f"https://events.1password.com/api/v2/{name}", "items", "cursor", "cursor", more="has_more", body={"limit": 1000})
    for name in ("auditevents", "itemusages", "signinattempts")
}

#: Settings of a mailbox by kind: its path below the mailbox, and where the records are; changes show by ``dedupe.first_contents``.
MAILBOX_SETTINGS = {"filters": "filter", "forwardingAddresses": "forwardingAddresses", "autoForwarding": "", "sendAs": "sendAs", "delegates": "delegates", "imap": "", "pop": "", "vacation": ""}
FEEDS["gmail"] |= {kind: Request(f"https://gmail.googleapis.com/gmail/v1/users/{{user}}/settings/{kind}", items, (), ()) for kind, items in MAILBOX_SETTINGS.items()}


def cursor_request(service: str, **settings: str) -> CursorRequest:
    """A service's request with the settings filled in; ``{member}`` stays."""
    return replace(CURSORS[service], **{f.name: _filled(getattr(CURSORS[service], f.name), settings) for f in fields(CursorRequest)})


def mailboxes(get: Callable[[str], Any], customer: str = "my_customer", domain: str | None = None, query: str | None = None, suspended: bool = False, most_pages: int = 100, url: str = "https://admin.googleapis.com/admin/directory/v1/users") -> tuple[list[str], bool]:
    """The mailboxes of a domain, and whether the listing is complete; ``get`` gives an address' JSON. For ``cursor_source``'s members."""
    found, token = {}, None
    for _ in range(most_pages):
        own = {"maxResults": 500, **({"domain": domain} if domain else {"customer": customer}), "query": query, "pageToken": token}
        answer = get(url + "?" + urllib.parse.urlencode({k: v for k, v in own.items() if v}))
        for user in answer.get("users") or []:
            mailbox = str(user.get("primaryEmail") or "").strip().lower()
            if mailbox and (suspended or not user.get("suspended")):
                found[mailbox] = True
        token = answer.get("nextPageToken")
        if not token:
            return list(found), True
    return list(found), False
