"""Fixed values that must equal the mail API / processor contract for right results.

Everything below is a fixed value (names, key formats, routes, default field lists),
stated plainly and in natural order.
"""

# --- fixed values: record attribute names -------------------------------------------------
ATTR_USER_ID = "office365_user_id"
ATTR_FOLDER_ID = "office365_folder_id"
ATTR_MESSAGE_ID = "office365_message_id"
ATTR_DELTA = "office365_delta"
ATTR_DELTA_KEY = "office365_delta_key"
ATTR_CACHE_KEY = "office365_cache_key"

# attachment attributes (cache variant)
ATTR_CONTENT_TYPE = "content-type"
ATTR_MIME_TYPE = "mime.type"
ATTR_ATTACHMENT_FILE_NAME = "attachment_file_name"

# error attributes
ATTR_ERROR = "Office365.Error"
ATTR_STACK = "Office365.StackTrace"
ATTR_MSG_ERROR = "Office365.MessageProcessor.Error"
ATTR_MSG_STACK = "Office365.MessageProcessor.StackTrace"
ATTR_FOLDER_ERROR = "Office365.MessageFolderProcessor.Error"
ATTR_FOLDER_STACK = "Office365.MessageFolderProcessor.StackTrace"

# --- fixed values: checkpoint key grammar ----------------------------------------------------
KEY_MESSAGES_PREFIX = "O365_messages"
KEY_USERS = "O365_users_delta"
KEY_FOLDERS_PREFIX = "O365_folders"
KEY_SEP = "|"

# default key patterns (full match)
REGEX_MESSAGES_DEFAULT = "O365_messages.*"
REGEX_USERS_DEFAULT = "O365_users_delta"
REGEX_FOLDERS_DEFAULT = "O365_folders.*"

# --- fixed values: routes ----------------------------------------------------------------------
ROUTE_SUCCESS = "Success"
ROUTE_FAILURE = "Failure"
ROUTE_ORIGINAL = "Original"
ROUTE_DELTA = "Delta"
ROUTE_SUCCESS_MESSAGES = "success_messages"
ROUTE_SUCCESS_ATTACHMENTS = "success_attachments"

# emit order inside one message: attachments, then the message, then the token
EMIT_ATTACHMENT = 0
EMIT_ITEM = 1
EMIT_TOKEN = 2

# --- fixed values: page envelope (OData) -------------------------------------------------------
NEXT_LINK = "@odata.nextLink"
DELTA_LINK = "@odata.deltaLink"
REMOVED = "@removed"

# page size asked for message scans
MESSAGE_PAGE_SIZE = 10

# --- fixed values: default field lists -------------------------------------------------------
USER_FIELDS_DEFAULT = (
    "businessPhones,displayName,givenName,jobTitle,mail,mobilePhone,officeLocation,"
    "preferredLanguage,surname,userPrincipalName,id"
)
MESSAGE_FIELDS_DEFAULT = (
    "id,createdDateTime,lastModifiedDateTime,changeKey,categories,receivedDateTime,sentDateTime,"
    "hasAttachments,internetMessageId,subject,bodyPreview,importance,parentFolderId,conversationId,"
    "isDeliveryReceiptRequested,isReadReceiptRequested,isRead,isDraft,webLink,inferenceClassification,"
    "body,sender,from,toRecipients,ccRecipients,bccRecipients,replyTo,flag"
)

# --- fixed values: outgoing mail and generic requests -------------------------------------------
MAIL_SUBJECT_DEFAULT = "Email Subject"
MAIL_BODY_TYPE_DEFAULT = "HTML"
MAIL_BODY_DEFAULT = ""
MAIL_USER_DEFAULT = "me"
MAIL_SAVE_TO_SENT_DEFAULT = "true"
MAIL_IMPORTANCE_DEFAULT = "Normal"
MAIL_BODY_TYPES = ("HTML", "TEXT")
MAIL_IMPORTANCES = ("LOW", "NORMAL", "HIGH")

REQUEST_METHODS = ("GET", "PUT", "POST", "DELETE", "PATCH")
REQUEST_METHODS_WITH_BODY = ("POST", "PUT", "PATCH")
REQUEST_METHOD_DEFAULT = "GET"
