"""DDL strings for the landed envelope, the entity views, records and state tables."""

# One row per landed page. `page_no` is the only order to trust; `request_token` is the token the
# chain was asked with ('' = full load); `attempt_id` names the run that asked (null: not known).
ENVELOPE_DDL = (
    "resource STRING, user_id STRING, folder_id STRING, message_id STRING, "
    "request_token STRING, page_no INT, fetched_at TIMESTAMP, body STRING, attempt_id STRING"
)

ENVELOPE_DDL_COLS = ["resource", "user_id", "folder_id", "message_id", "request_token", "page_no",
                     "fetched_at", "body", "attempt_id"]

# What a page body holds. Items stay raw JSON text (ARRAY<STRING> keeps each element's text).
PAGE_BODY_DDL = "value ARRAY<STRING>, `@odata.nextLink` STRING, `@odata.deltaLink` STRING"

EMAIL_DDL = "STRUCT<emailAddress: STRUCT<name: STRING, address: STRING>>"

USER_DDL = (
    "id STRING, displayName STRING, givenName STRING, surname STRING, jobTitle STRING, mail STRING, "
    "mobilePhone STRING, officeLocation STRING, preferredLanguage STRING, userPrincipalName STRING, "
    "businessPhones ARRAY<STRING>"
)

MESSAGE_DDL = (
    "id STRING, createdDateTime TIMESTAMP_NTZ, lastModifiedDateTime TIMESTAMP_NTZ, changeKey STRING, "
    "categories ARRAY<STRING>, receivedDateTime TIMESTAMP_NTZ, sentDateTime TIMESTAMP_NTZ, "
    "hasAttachments BOOLEAN, internetMessageId STRING, subject STRING, bodyPreview STRING, "
    "importance STRING, parentFolderId STRING, conversationId STRING, "
    "isDeliveryReceiptRequested BOOLEAN, isReadReceiptRequested BOOLEAN, isRead BOOLEAN, "
    "isDraft BOOLEAN, webLink STRING, inferenceClassification STRING, "
    "body STRUCT<contentType: STRING, content: STRING>, "
    f"sender {EMAIL_DDL}, `from` {EMAIL_DDL}, "
    f"toRecipients ARRAY<{EMAIL_DDL}>, ccRecipients ARRAY<{EMAIL_DDL}>, "
    f"bccRecipients ARRAY<{EMAIL_DDL}>, replyTo ARRAY<{EMAIL_DDL}>, "
    "flag STRUCT<flagStatus: STRING>, `@removed` STRUCT<reason: STRING>"
)

ATTACHMENT_DDL = (
    "id STRING, name STRING, contentType STRING, size INT, isInline BOOLEAN, contentBytes STRING"
)

RECORD_DDL = "route STRING, attributes MAP<STRING, STRING>, content STRING, emit_seq BIGINT"

CHECKPOINT_DDL = "key STRING, delta STRING, version BIGINT"

RECIPIENT_DDL = "ARRAY<STRUCT<emailAddress: STRUCT<address: STRING>>>"

# Timestamps inside item JSON keep microseconds (to_json would otherwise cut NTZ to millis).
JSON_TS_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
