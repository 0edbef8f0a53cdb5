"""Outgoing tables (K1, K2): mail to send and API requests to make, one per record.

Delivery itself is a network side effect and is not done here; these tables are what a delivery
job consumes. Every property is a template rendered per record (P8). Records that cannot form a
valid mail or request go to ``Failure`` with an error message and class (R2).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsync import constants as C
from mailsync.functions import checks as K
from mailsync.functions import fields as P


@dataclass(frozen=True)
class MailParams:
    subject: str = C.MAIL_SUBJECT_DEFAULT
    body_type: str = C.MAIL_BODY_TYPE_DEFAULT
    body: str = C.MAIL_BODY_DEFAULT
    user_id: str = C.MAIL_USER_DEFAULT
    save_to_sent: str = C.MAIL_SAVE_TO_SENT_DEFAULT
    to_recipients: str = ""
    cc_recipients: str = ""
    bcc_recipients: str = ""
    importance: str = C.MAIL_IMPORTANCE_DEFAULT


def outbox_mail(records: DataFrame, params: MailParams = MailParams()) -> DataFrame:
    """K1: P8 + P10 + P11 + P12 + P14 per record.

    Columns: the outbox row (``sender_path, subject, body, body_type, importance, save_to_sent,
    to_recipients, cc_recipients, bcc_recipients``), plus ``route`` (``success`` carries the
    original record, ``Failure`` an error) and the error columns.
    """
    a = "attributes"
    enums = P.mail_enums(P.render(params.body_type, a), P.render(params.importance, a),
                         P.render(params.save_to_sent, a))
    body = P.mail_body(P.render(params.body, a), F.col("content"))
    err = (F.when(enums["body_type"].isNull() | ~enums["body_type"].isin(*C.MAIL_BODY_TYPES),
                  F.lit("no enum constant for body type"))
           .when(enums["importance"].isNull() | ~enums["importance"].isin(*C.MAIL_IMPORTANCES),
                 F.lit("no enum constant for importance"))
           .when(~enums["ok"], F.lit("save-to-sent is not set")))
    err_class = F.when(err.isNotNull(), F.lit("IllegalArgumentException"))
    return records.select(
        "*",
        P.mailbox_path(P.render(params.user_id, a)).alias("sender_path"),
        P.render(params.subject, a).alias("subject"),
        body.alias("body"),
        enums["body_type"].alias("body_type"),
        enums["importance"].alias("mail_importance"),
        enums["save_to_sent"].alias("save_to_sent"),
        P.recipients(P.render(params.to_recipients, a)).alias("to_recipients"),
        P.recipients(P.render(params.cc_recipients, a)).alias("cc_recipients"),
        P.recipients(P.render(params.bcc_recipients, a)).alias("bcc_recipients"),
        F.when(err.isNull(), F.lit("success")).otherwise(F.lit(C.ROUTE_FAILURE)).alias("out_route"),
        err.alias("error"), err_class.alias("error_class"),
    )


@dataclass(frozen=True)
class RequestParams:
    url: str = ""
    method: str = C.REQUEST_METHOD_DEFAULT
    data: str = ""
    select_fields: str = ""
    function_options: str = ""
    query_options: str = ""
    headers: str = ""


def request_table(records: DataFrame, params: RequestParams = RequestParams()) -> DataFrame:
    """K2: P1 + P8 + P9 + F6 per record -> the request row and its route.

    ``route`` is ``requests`` for a request to make and ``Failure`` for one that cannot be made
    (unknown method, empty URL, options that are not a JSON object of scalars, or a POST/PUT/PATCH
    body that is not a JSON object). Blank data falls back to the record content (P11).
    """
    a = "attributes"
    url = P.render(params.url, a)
    method = P.render(params.method, a)
    data = P.request_data(P.render(params.data, a), F.col("content"))
    fo = P.json_options(P.render(params.function_options, a))
    qo = P.json_options(P.render(params.query_options, a))
    hd = P.json_options(P.render(params.headers, a))
    sel = P.render(params.select_fields, a)
    m = F.upper(method)
    err = (F.when(~F.coalesce(K.valid_method(method), F.lit(False)), F.concat(F.lit("unsupported method: "), F.coalesce(method, F.lit("null"))))
           .when(F.coalesce(F.length(url), F.lit(0)) == 0, F.lit("empty URL"))
           .when(~fo["ok"], F.lit("function options are not a JSON object of scalars"))
           .when(~qo["ok"], F.lit("query options are not a JSON object of scalars"))
           .when(~hd["ok"], F.lit("headers are not a JSON object of scalars"))
           .when(~K.valid_request(method, url, data), F.lit("request body is not a JSON object")))
    err_class = (F.when(err.startswith("unsupported") | err.startswith("empty"), F.lit("IllegalArgumentException"))
                 .when(err.isNotNull(), F.lit("IllegalStateException")))
    return records.select(
        "*",
        url.alias("url"), m.alias("method"),
        F.when(~K.is_blank(sel), sel).alias("select_fields"),
        fo["options"].alias("function_options"), qo["options"].alias("query_options"),
        hd["options"].alias("headers"),
        F.when(m.isin(*C.REQUEST_METHODS_WITH_BODY), data).alias("request_body"),
        F.when(err.isNull(), F.lit("requests")).otherwise(F.lit(C.ROUTE_FAILURE)).alias("out_route"),
        err.alias("error"), err_class.alias("error_class"),
    )
