"""DuckDB oracles: for each query, the same result computed straight from the base tables.

The Spark side packs the tables into API pages and parses them back through the operators; these
statements never see pages, so they are an independent check. Column names match the queries.
"""

from __future__ import annotations

CUTOFF = "TIMESTAMP '2024-01-15 00:00:00'"

# Shared CTEs over the base tables.
TOK = f"""tok AS (SELECT user_id, event_type, max(event_id) AS tok FROM events
                 WHERE ts < {CUTOFF} GROUP BY user_id, event_type)"""
FOLD = """fold AS (SELECT user_id, event_type, max(event_id) AS last_id FROM events
                  GROUP BY user_id, event_type)"""
CHG = f"""{TOK}, {FOLD},
chg AS (SELECT e.event_id, e.ts, e.user_id, e.event_type, e.props, t.tok,
               coalesce(CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 10 = 0, false) AS removed
        FROM events e LEFT JOIN tok t ON t.user_id = e.user_id AND t.event_type = e.event_type
        WHERE t.tok IS NULL OR e.event_id > t.tok)"""
CKPT = f"""ckpt AS (
  SELECT 'O365_messages|' || CAST(user_id AS VARCHAR) || '|' || event_type AS key,
         CAST(max(event_id) AS VARCHAR) AS delta, CAST(1 AS BIGINT) AS version
  FROM events WHERE ts < {CUTOFF} GROUP BY user_id, event_type
  UNION ALL
  SELECT DISTINCT 'O365_folders|' || CAST(user_id AS VARCHAR), '', CAST(1 AS BIGINT) FROM events
  UNION ALL
  SELECT 'O365_users_delta', CAST(max(user_id) AS VARCHAR), CAST(1 AS BIGINT) FROM events)"""
EDGES = """edges AS (SELECT * FROM (VALUES ('O365_messages|7', ''), ('O365_messages|7|', ''),
                                       ('O365_folders|', ''), ('O365_folders|tab', chr(9)),
                                       ('O365_folders|line', ' ' || chr(10))) v(key, delta))"""
MKEY = "'O365_messages|' || CAST({u} AS VARCHAR) || '|' || {t}"
# the chain each folder is asked with: its checkpoint token, or '' for new work
CHAINS = """chains AS (SELECT f.user_id, f.event_type, f.last_id,
                       coalesce(CAST(t.tok AS VARCHAR), '') AS request_token,
                       CAST(t.tok AS VARCHAR) AS old_delta
                FROM fold f LEFT JOIN tok t ON t.user_id = f.user_id AND t.event_type = f.event_type)"""
RANKED = f"""{CHG}, {CHAINS},
ranked AS (SELECT c.*, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS r0
           FROM chg c)"""
TOKENS = f"""{TOK}, {FOLD}, {CHAINS},
tokens AS (SELECT {MKEY.format(u='user_id', t='event_type')} AS key,
                  coalesce(old_delta, '') AS old_delta, CAST(last_id AS VARCHAR) AS new_delta
           FROM chains)"""
# records of the messages sync: messages, then changed tokens
RECORDS = f"""{CHG}, {CHAINS},
recs AS (
  SELECT 'success_messages' AS route, CAST(1 AS BIGINT) AS emit_seq, CAST(user_id AS VARCHAR) AS user_id,
         event_type AS folder_id, 'c' || CAST(event_id AS VARCHAR) AS message_id, CAST(NULL AS VARCHAR) AS cache_key,
         CAST(NULL AS VARCHAR) AS delta_key, CAST(NULL AS VARCHAR) AS delta
  FROM chg
  UNION ALL
  SELECT 'success_messages', CAST(2 AS BIGINT), NULL, NULL, NULL, NULL,
         {MKEY.format(u='user_id', t='event_type')}, CAST(last_id AS VARCHAR)
  FROM chains WHERE old_delta IS NULL OR CAST(last_id AS VARCHAR) <> old_delta)"""
# record-driven delta: inputs are the checkpoint rows
INPUTS = f"""{CKPT},
inputs AS (SELECT key, delta,
                  CASE WHEN key LIKE 'O365_%|%' THEN split_part(key, '|', 2) END AS user_id,
                  CASE WHEN key LIKE 'O365_messages|%' THEN split_part(key, '|', 3) END AS folder_id
           FROM ckpt)"""
USERS_TOKEN = "(SELECT max(user_id) FROM events)"
TEAMS = """teams AS (
  SELECT CAST(floor(c.c_custkey / 10) AS BIGINT) AS team,
         string_agg(lower(replace(c.c_name, '#', '.')) || '@' || lower(n.n_name) || '.example', ','
                    ORDER BY lower(replace(c.c_name, '#', '.')) || '@' || lower(n.n_name) || '.example') AS csv
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1)"""
MAIL = f"""{TEAMS},
mail AS (
  SELECT c.conv_id, c.turn, c.role, c.text AS content, t.csv,
         CASE WHEN c.role = 'system' THEN ' ' WHEN c.turn = 0 THEN '' END AS note,
         CASE c.role WHEN 'user' THEN 'TEXT' WHEN 'assistant' THEN 'HTML' ELSE 'MARKDOWN' END AS body_type,
         CASE WHEN c.turn = 0 THEN 'HIGH' WHEN c.turn <= 3 THEN 'NORMAL' ELSE 'LOW' END AS importance,
         CASE c.role WHEN 'user' THEN true WHEN 'assistant' THEN false ELSE false END AS save_to_sent,
         CASE c.role WHEN 'user' THEN 'TRUE' WHEN 'assistant' THEN 'yes' END AS save_raw,
         CASE WHEN c.role = 'user' THEN '/me' ELSE '/users/agent-' || CAST(c.conv_id AS VARCHAR) END AS sender_path
  FROM conversations c LEFT JOIN teams t ON c.conv_id = t.team)"""
REQ = """req AS (
  SELECT event_id, user_id, event_type, props,
         json_extract_string(props, '$.k') AS k,
         CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'POST' WHEN 'purchase' THEN 'PUT'
                         WHEN 'signup' THEN 'PATCH' ELSE 'HEAD' END AS method
  FROM events)"""

# the cache-driven tenant sync: users from their token, folders of known and new users, messages
# of stored message keys (the changes feed) and of every new folder, attachments of those messages
TENANT = f"""{RECORDS},
utok AS (SELECT {USERS_TOKEN} AS utok_old,
                coalesce((SELECT max(c_custkey) FROM customer WHERE c_custkey > {USERS_TOKEN}), {USERS_TOKEN}) AS utok_new),
new_users AS (SELECT c_custkey FROM customer WHERE c_custkey > {USERS_TOKEN}),
fusers AS (SELECT DISTINCT user_id AS u FROM events UNION SELECT c_custkey FROM new_users),
tfold AS (SELECT o_custkey, o_orderstatus, max(o_orderkey) AS mx FROM orders
          WHERE o_custkey IN (SELECT u FROM fusers) GROUP BY 1, 2)"""

ORACLES: dict[str, str] = {
    "messages_delta": f"""WITH {CHG}
SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS folder_id, 'c' || CAST(event_id AS VARCHAR) AS message_id,
       removed, CASE WHEN removed THEN NULL ELSE props END AS subject,
       CASE WHEN removed THEN NULL ELSE ts END AS received_at
FROM chg""",

    "flatten_pages": f"""WITH {RANKED}
SELECT CAST(r.user_id AS VARCHAR) AS user_id, r.event_type AS folder_id,
       coalesce(CAST(r.tok AS VARCHAR), '') AS request_token,
       CAST(r.r0 // 10 AS INTEGER) AS page_no, CAST(r.r0 % 10 AS INTEGER) AS item_pos,
       'c' || CAST(r.event_id AS VARCHAR) AS message_id
FROM ranked r""",

    "assign_pages": f"""WITH {RANKED},
pages AS (SELECT user_id, event_type, r0 // 10 AS page_no, count(*) AS n FROM ranked GROUP BY 1, 2, 3),
sizes AS (SELECT c.user_id, c.event_type, c.request_token, c.last_id, count(r.event_id) AS n_all
          FROM chains c LEFT JOIN ranked r ON r.user_id = c.user_id AND r.event_type = c.event_type
          GROUP BY 1, 2, 3, 4),
allp AS (SELECT s.user_id, s.event_type, s.request_token, s.last_id,
                greatest(CAST(ceil(s.n_all / 10.0) AS BIGINT) - 1, 0) AS last_page,
                coalesce(p.page_no, 0) AS page_no, coalesce(p.n, 0) AS n
         FROM sizes s LEFT JOIN pages p ON p.user_id = s.user_id AND p.event_type = s.event_type)
SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS folder_id, request_token,
       CAST(page_no AS INTEGER) AS page_no, CAST(n AS INTEGER) AS n_items,
       CASE WHEN page_no < last_page THEN 'next:' || CAST(page_no + 1 AS VARCHAR) END AS next_link,
       CASE WHEN page_no = last_page THEN CAST(last_id AS VARCHAR) END AS delta_link
FROM allp""",

    "last_token": f"""WITH {TOKENS}
SELECT key, old_delta, new_delta FROM tokens""",

    "token_changed": f"""WITH {TOKENS}
SELECT key, old_delta, new_delta, new_delta IS NOT NULL AND new_delta IS DISTINCT FROM old_delta AS changed
FROM tokens""",

    "token_records": f"""WITH {TOKENS}
SELECT 'success_messages' AS route, key AS delta_key, new_delta AS delta, new_delta AS content
FROM tokens WHERE new_delta <> old_delta""",

    "success_union": f"""WITH {RECORDS} SELECT * FROM recs""",

    "upsert_checkpoints": f"""WITH {CKPT}, {TOK}, {FOLD}
SELECT key, delta, version FROM ckpt WHERE key NOT LIKE 'O365_messages|%'
UNION ALL
SELECT {MKEY.format(u='f.user_id', t='f.event_type')} AS key,
       CAST(f.last_id AS VARCHAR) AS delta,
       CAST(CASE WHEN t.tok IS NOT NULL AND t.tok = f.last_id THEN 1 ELSE 2 END AS BIGINT) AS version
FROM fold f LEFT JOIN tok t ON t.user_id = f.user_id AND t.event_type = f.event_type""",

    "dedupe_replay": f"""WITH {RECORDS} SELECT DISTINCT * FROM recs""",

    "delta_route": f"""WITH {TOK}, {FOLD}
SELECT 'Delta' AS route, CAST(f.user_id AS VARCHAR) AS user_id, f.event_type AS folder_id,
       2 AS n_attrs, CAST(f.last_id AS VARCHAR) AS delta
FROM fold f JOIN tok t ON t.user_id = f.user_id AND t.event_type = f.event_type""",

    "require_attrs": f"""WITH {INPUTS}
SELECT CASE WHEN user_id IS NOT NULL AND folder_id IS NOT NULL THEN 'pass' ELSE 'Failure' END AS route,
       user_id, folder_id, delta,
       (CASE WHEN user_id IS NULL THEN 0 ELSE 1 END) + (CASE WHEN folder_id IS NULL THEN 0 ELSE 1 END)
         + (CASE WHEN delta IS NULL THEN 0 ELSE 1 END) AS n_attrs
FROM inputs""",

    "route_counts": f"""WITH {INPUTS}, {TOK}, {FOLD},
delta_msgs AS (SELECT e.event_id FROM events e JOIN tok t ON t.user_id = e.user_id
               AND t.event_type = e.event_type WHERE e.event_id > t.tok)
SELECT 'success_messages' AS route, (SELECT count(*) FROM delta_msgs) AS n_records
UNION ALL SELECT 'Delta', (SELECT count(*) FROM tok)
UNION ALL SELECT 'Failure', (SELECT count(*) FROM inputs WHERE folder_id IS NULL)""",

    "original_route": f"""WITH {INPUTS}
SELECT 'Original' AS route, user_id, folder_id, delta FROM inputs
WHERE user_id IS NOT NULL AND folder_id IS NOT NULL""",

    "inherit_attrs": f"""WITH {TOK},
m AS (SELECT e.user_id, e.event_type, e.event_id, t.tok FROM events e JOIN tok t
      ON t.user_id = e.user_id AND t.event_type = e.event_type WHERE e.event_id > t.tok)
SELECT 'c' || CAST(event_id AS VARCHAR) AS message_id, 'office365_user_id' AS attr_key, CAST(user_id AS VARCHAR) AS attr_value FROM m
UNION ALL SELECT 'c' || CAST(event_id AS VARCHAR), 'office365_folder_id', event_type FROM m
UNION ALL SELECT 'c' || CAST(event_id AS VARCHAR), 'office365_delta', CAST(tok AS VARCHAR) FROM m
UNION ALL SELECT 'c' || CAST(event_id AS VARCHAR), 'office365_message_id', 'c' || CAST(event_id AS VARCHAR) FROM m""",

    "folders_delta_records": """WITH eu AS (SELECT DISTINCT user_id FROM events),
f AS (SELECT o_custkey, o_orderstatus, max(o_orderkey) AS mx FROM orders
      WHERE o_custkey IN (SELECT user_id FROM eu) GROUP BY 1, 2)
SELECT 'Success' AS route, CAST(1 AS BIGINT) AS emit_seq, CAST(o_custkey AS VARCHAR) AS user_id,
       o_orderstatus AS folder_id, CAST(NULL AS VARCHAR) AS token, 3 AS n_attrs FROM f
UNION ALL SELECT 'Delta', 2, CAST(o_custkey AS VARCHAR), NULL, CAST(max(mx) AS VARCHAR), 1 FROM f GROUP BY o_custkey
UNION ALL SELECT 'Failure', 1, NULL, NULL, NULL, 1""",

    "users_delta_records": f"""SELECT 'Success' AS route, CAST(1 AS BIGINT) AS emit_seq, CAST(c_custkey AS VARCHAR) AS user_id,
       CAST(NULL AS VARCHAR) AS token, 2 AS n_attrs
FROM customer WHERE c_custkey > {USERS_TOKEN}
UNION ALL
SELECT 'Delta', 2, NULL, CAST(max(c_custkey) AS VARCHAR), 1 FROM customer WHERE c_custkey > {USERS_TOKEN}
HAVING max(c_custkey) IS NOT NULL
UNION ALL SELECT 'Original', 1, NULL, NULL, 1""",

    "users_scan": """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS displayName, c_mktsegment AS jobTitle,
       CAST(c_nationkey AS VARCHAR) AS officeLocation FROM customer""",

    "users_delta": f"""SELECT 'Success' AS route, CAST(1 AS BIGINT) AS emit_seq, CAST(c_custkey AS VARCHAR) AS user_id,
       'O365_folders|' || CAST(c_custkey AS VARCHAR) AS cache_key, CAST(NULL AS VARCHAR) AS delta_key,
       CAST(NULL AS VARCHAR) AS delta, c_name AS display_name
FROM customer WHERE c_custkey > {USERS_TOKEN}
UNION ALL
SELECT 'Success', CAST(2 AS BIGINT), NULL, NULL, 'O365_users_delta',
       CAST(coalesce((SELECT max(c_custkey) FROM customer WHERE c_custkey > {USERS_TOKEN}), {USERS_TOKEN}) AS VARCHAR), NULL
WHERE coalesce((SELECT max(c_custkey) FROM customer WHERE c_custkey > {USERS_TOKEN}), {USERS_TOKEN}) <> {USERS_TOKEN}""",

    "bootstrap_users": """SELECT 'Success' AS route, CAST(1 AS BIGINT) AS emit_seq, CAST(c_custkey AS VARCHAR) AS user_id,
       'O365_folders|' || CAST(c_custkey AS VARCHAR) AS cache_key, CAST(NULL AS VARCHAR) AS delta_key,
       CAST(NULL AS VARCHAR) AS delta, c_name AS display_name
FROM customer
UNION ALL
SELECT 'Success', CAST(2 AS BIGINT), NULL, NULL, 'O365_users_delta', CAST(max(c_custkey) AS VARCHAR), NULL
FROM customer""",

    "folders_delta": """WITH eu AS (SELECT DISTINCT user_id FROM events),
f AS (SELECT o_custkey, o_orderstatus, count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS u,
             max(o_orderkey) AS mx
      FROM orders WHERE o_custkey IN (SELECT user_id FROM eu) GROUP BY 1, 2)
SELECT 'Success' AS route, CAST(1 AS BIGINT) AS emit_seq, CAST(o_custkey AS VARCHAR) AS user_id,
       o_orderstatus AS folder_id, 'O365_messages|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus AS cache_key,
       CAST(NULL AS VARCHAR) AS delta_key, CAST(NULL AS VARCHAR) AS delta,
       CAST(n AS INTEGER) AS total_items, CAST(u AS INTEGER) AS unread_items
FROM f
UNION ALL
SELECT 'Success', CAST(2 AS BIGINT), NULL, NULL, NULL, 'O365_folders|' || CAST(o_custkey AS VARCHAR),
       CAST(max(mx) AS VARCHAR), NULL, NULL
FROM f GROUP BY o_custkey""",

    "seed_folder_work": """SELECT 'O365_folders|' || CAST(c_custkey AS VARCHAR) AS key, '' AS delta FROM customer
WHERE c_custkey NOT IN (SELECT DISTINCT user_id FROM events)""",

    "seed_message_work": f"""WITH {CKPT}
SELECT DISTINCT 'O365_messages|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus AS key, '' AS delta
FROM orders
WHERE 'O365_messages|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus NOT IN (SELECT key FROM ckpt)""",

    "user_folder_tree": """SELECT CAST(c.c_custkey AS VARCHAR) AS user_id, c.c_name AS display_name, o.o_orderstatus AS folder_id,
       CAST(count(*) AS INTEGER) AS total_items,
       CAST(count(*) FILTER (WHERE o.o_orderpriority = '1-URGENT') AS INTEGER) AS unread_items
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey, c.c_name, o.o_orderstatus""",

    "messages_scan": """SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS VARCHAR) AS message_id,
       o_orderstatus AS folder_id, o_orderdate AS received_at,
       CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'high'
            WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'normal'
            WHEN substr(o_orderpriority, 1, 1) = '5' THEN 'low' END AS importance,
       o_orderpriority AS subject
FROM orders""",

    "attachments_scan": """SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_orderkey AS VARCHAR) AS message_id,
       p.p_name AS name, p.p_type AS content_type, CAST(l.l_quantity AS INTEGER) AS size
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey""",

    "message_attachments": """SELECT 'success_attachments' AS route, CAST(0 AS BIGINT) AS emit_seq,
       CAST(o.o_custkey AS VARCHAR) AS user_id, o.o_orderstatus AS folder_id,
       CAST(l.l_orderkey AS VARCHAR) AS message_id, p.p_type AS content_type, p.p_type AS mime_type,
       p.p_name AS file_name
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey""",

    "attachment_attrs": """WITH a AS (SELECT CAST(l.l_orderkey AS VARCHAR) AS message_id, p.p_type, p.p_name
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT message_id, 'content-type' AS attr_key, p_type AS attr_value FROM a
UNION ALL SELECT message_id, 'mime.type', p_type FROM a
UNION ALL SELECT message_id, 'attachment_file_name', p_name FROM a""",

    "select_fields": """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS subject,
       CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'high'
            WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'normal'
            WHEN substr(o_orderpriority, 1, 1) = '5' THEN 'low' END AS importance, CAST(NULL AS VARCHAR) AS raw
FROM orders
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, '{"id":"' || o_orderkey || '","extra":{"a":[1,"x"]}}' FROM orders""",

    "filter_keys": f"""WITH {CKPT}, {EDGES}, k AS (SELECT key, delta FROM ckpt UNION ALL SELECT key, delta FROM edges)
SELECT key, delta, 'messages' AS pattern FROM k WHERE regexp_full_match(key, 'O365_messages.*')
UNION ALL SELECT key, delta, 'folders_1x' FROM k WHERE regexp_full_match(key, 'O365_folders\\|1\\d')
UNION ALL SELECT key, delta, 'users' FROM k WHERE regexp_full_match(key, 'O365_users_delta')""",

    "parse_keys": f"""WITH {CKPT}, {EDGES}, k AS (SELECT key FROM ckpt UNION ALL SELECT key FROM edges),
p AS (SELECT key, string_split(key, '|') AS parts, key LIKE 'O365_messages%' AS is_msg FROM k
      WHERE key LIKE 'O365_messages%' OR key LIKE 'O365_folders%')
SELECT key, parts[2] AS user_id, CASE WHEN is_msg THEN parts[3] END AS folder_id,
       coalesce(parts[2], '') <> '' AND (NOT is_msg OR coalesce(parts[3], '') <> '') AS key_ok
FROM p""",

    "format_keys": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, event_type AS folder_id,
       'O365_messages|' || CAST(user_id AS VARCHAR) || '|' || event_type AS messages_key,
       'O365_folders|' || CAST(user_id AS VARCHAR) AS folders_key, 'O365_users_delta' AS users_key
FROM events""",

    "full_load_flag": f"""WITH {CKPT}, {EDGES}, k AS (SELECT key, delta FROM ckpt UNION ALL SELECT key, delta FROM edges)
SELECT key, delta, regexp_full_match(coalesce(delta, ''), '\\s*') AS full_load,
       CASE WHEN regexp_full_match(coalesce(delta, ''), '\\s*') THEN '' ELSE delta END AS request_token
FROM k""",

    "lookup_token": f"""WITH {TOK}, {FOLD}
SELECT {MKEY.format(u='f.user_id', t='f.event_type')} AS key, CAST(t.tok AS VARCHAR) AS delta
FROM fold f LEFT JOIN tok t ON t.user_id = f.user_id AND t.event_type = f.event_type""",

    "checkpoint_scan": f"""WITH {CKPT}, {TOK}, {FOLD}
SELECT key, delta, version FROM ckpt WHERE key NOT LIKE 'O365_messages|%'
UNION ALL
SELECT {MKEY.format(u='f.user_id', t='f.event_type')} AS key,
       CAST(f.last_id AS VARCHAR) AS delta,
       CAST(CASE WHEN t.tok IS NOT NULL AND t.tok = f.last_id THEN 1 ELSE 2 END AS BIGINT) AS version
FROM fold f LEFT JOIN tok t ON t.user_id = f.user_id AND t.event_type = f.event_type""",

    "ckpt_get": f"""WITH {CKPT}
SELECT * FROM ckpt WHERE key IN (SELECT 'O365_folders|' || CAST(c_custkey AS VARCHAR) FROM customer)""",

    "ckpt_put": f"""WITH {CKPT},
puts AS (SELECT 'O365_folders|' || CAST(o_custkey AS VARCHAR) AS key, CAST(max(o_orderkey) AS VARCHAR) AS delta
         FROM orders GROUP BY o_custkey)
SELECT key, delta, version FROM ckpt WHERE key NOT IN (SELECT key FROM puts)
UNION ALL SELECT key, delta, CAST(2 AS BIGINT) FROM puts""",

    "ckpt_remove": f"""WITH {CKPT}
SELECT * FROM ckpt WHERE key NOT IN (SELECT 'O365_folders|' || CAST(c_custkey AS VARCHAR) FROM customer)
                     AND key <> 'O365_users_delta'""",

    "ckpt_keys": f"""WITH {CKPT} SELECT key FROM ckpt""",

    "write_read_records": f"""WITH {RECORDS} SELECT * FROM recs""",

    "literal_attrs": f"""WITH {RECORDS} SELECT route, emit_seq, user_id, message_id, 'r1' AS batch, 'changes' AS source FROM recs""",

    "render_template": f"""WITH {CHG}
SELECT 'c' || CAST(event_id AS VARCHAR) AS message_id,
       '/users/' || CAST(user_id AS VARCHAR) || '/mailFolders/' || event_type || '/messages/'
         || 'c' || CAST(event_id AS VARCHAR) || '?x=' AS url
FROM chg""",

    "outbox_mail": f"""WITH {MAIL},
m AS (SELECT *, CASE WHEN csv IS NULL OR length(csv) <= 3 OR regexp_replace(csv, ',+$', '') = '' THEN []
                     ELSE string_split(regexp_replace(csv, ',+$', ''), ',') END AS tos FROM mail)
SELECT conv_id, turn, role,
       CASE WHEN body_type IN ('HTML', 'TEXT') THEN 'success' ELSE 'Failure' END AS route,
       sender_path, 'Re: conversation ' || CAST(conv_id AS VARCHAR) AS subject,
       CASE WHEN note IS NULL OR length(note) = 0 THEN content ELSE note END AS body,
       body_type, importance, save_to_sent,
       CAST(len(tos) AS INTEGER) AS n_to, 0 AS n_cc, 0 AS n_bcc, tos[1] AS first_to
FROM m""",

    "mail_enums": f"""WITH {MAIL}
SELECT conv_id, turn, role, body_type, importance,
       CASE WHEN save_raw IS NULL THEN NULL ELSE lower(trim(save_raw)) = 'true' END AS save_to_sent,
       body_type IN ('HTML', 'TEXT') AND save_raw IS NOT NULL AS ok
FROM mail""",

    "body_fallback": f"""WITH {MAIL}
SELECT conv_id, turn, role,
       CASE WHEN note IS NULL OR length(note) = 0 THEN content ELSE note END AS mail_body,
       CASE WHEN note IS NULL OR trim(note) = '' THEN content ELSE note END AS request_body,
       coalesce(note, '') AS rendered_note
FROM mail""",

    "recipients": f"""WITH {TEAMS},
lists AS (SELECT CAST(team AS VARCHAR) AS list_id, csv FROM teams
          UNION ALL SELECT * FROM (VALUES ('edge-null', NULL), ('edge-empty', ''), ('edge-short', 'a,b'),
                                          ('edge-inner', 'a@b,,c@d,,'), ('edge-blank', ' a@b , c@d'),
                                          ('edge-commas', ',,,,')) v(list_id, csv)),
parts AS (SELECT list_id, CASE WHEN csv IS NULL OR length(csv) <= 3 OR regexp_replace(csv, ',+$', '') = '' THEN []
                               ELSE string_split(regexp_replace(csv, ',+$', ''), ',') END AS arr FROM lists)
SELECT list_id, CAST(generate_subscripts(arr, 1) - 1 AS INTEGER) AS pos, unnest(arr) AS address
FROM parts WHERE len(arr) > 0
UNION ALL
SELECT list_id, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR) FROM parts WHERE len(arr) = 0""",

    "request_table": f"""WITH {REQ}
SELECT event_id,
       CASE WHEN method IN ('GET', 'POST') THEN 'requests' ELSE 'Failure' END AS route,
       '/users/' || CAST(user_id AS VARCHAR) || '/events/' || CAST(event_id AS VARCHAR) AS url,
       method, 'id,subject' AS select_fields, 2 AS n_query_options, k AS top, event_type AS filter,
       1 AS n_headers, CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS n_function_options,
       CASE WHEN method IN ('POST', 'PUT') THEN props WHEN method = 'PATCH' THEN '[1, 2]' END AS request_body,
       CASE event_type WHEN 'error' THEN 'unsupported method: HEAD'
                       WHEN 'purchase' THEN 'function options are not a JSON object of scalars'
                       WHEN 'signup' THEN 'request body is not a JSON object' END AS error
FROM req""",

    "valid_requests": f"""WITH {REQ}
SELECT event_id, CASE event_type WHEN 'view' THEN 'GET' WHEN 'click' THEN 'post' WHEN 'purchase' THEN 'PUT'
                                 WHEN 'signup' THEN 'patch' ELSE 'HEAD' END AS method,
       event_type IN ('view', 'click', 'purchase') AS ok
FROM req""",

    "json_options": f"""WITH {REQ}
SELECT event_id, 0 AS pos, '$top' AS opt_key, k AS opt_value FROM req
UNION ALL SELECT event_id, 1, '$filter', event_type FROM req""",

    "valid_json": """SELECT 'events' AS source, event_id AS id, json_valid(props) AS ok FROM events
UNION ALL
SELECT 'conversations', conv_id * 100 + turn, json_valid(text) OR trim(text) = '' OR contains(text, '${') FROM conversations""",

    "error_records": f"""WITH {REQ}
SELECT 'Failure' AS route, event_id,
       CASE event_type WHEN 'error' THEN 'unsupported method: HEAD'
                       WHEN 'purchase' THEN 'function options are not a JSON object of scalars'
                       WHEN 'signup' THEN 'request body is not a JSON object' END AS error,
       CASE event_type WHEN 'error' THEN 'IllegalArgumentException' ELSE 'IllegalStateException' END AS error_class
FROM req WHERE event_type IN ('error', 'purchase', 'signup')""",

    "tenant_sync": f"""WITH {TENANT}
SELECT 'Success' AS route, CAST(1 AS BIGINT) AS emit_seq, CAST(c_custkey AS VARCHAR) AS user_id,
       CAST(NULL AS VARCHAR) AS folder_id, CAST(NULL AS VARCHAR) AS message_id,
       'O365_folders|' || CAST(c_custkey AS VARCHAR) AS cache_key, CAST(NULL AS VARCHAR) AS delta_key,
       CAST(NULL AS VARCHAR) AS delta
FROM new_users
UNION ALL SELECT 'Success', 2, NULL, NULL, NULL, NULL, 'O365_users_delta', CAST(utok_new AS VARCHAR)
FROM utok WHERE utok_new <> utok_old
UNION ALL SELECT 'Success', 1, CAST(o_custkey AS VARCHAR), o_orderstatus, NULL,
       'O365_messages|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus, NULL, NULL FROM tfold
UNION ALL SELECT 'Success', 2, NULL, NULL, NULL, NULL, 'O365_folders|' || CAST(o_custkey AS VARCHAR),
       CAST(max(mx) AS VARCHAR) FROM tfold GROUP BY o_custkey
UNION ALL SELECT route, emit_seq, user_id, folder_id, message_id, cache_key, delta_key, delta FROM recs
UNION ALL SELECT 'success_messages', 1, CAST(o.o_custkey AS VARCHAR), o.o_orderstatus,
       CAST(o.o_orderkey AS VARCHAR), NULL, NULL, NULL
FROM orders o JOIN tfold f ON f.o_custkey = o.o_custkey AND f.o_orderstatus = o.o_orderstatus
UNION ALL SELECT 'success_messages', 2, NULL, NULL, NULL, NULL,
       'O365_messages|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus, CAST(mx AS VARCHAR) FROM tfold
UNION ALL SELECT 'success_attachments', 0, CAST(o.o_custkey AS VARCHAR), o.o_orderstatus,
       CAST(o.o_orderkey AS VARCHAR), NULL, NULL, NULL
FROM orders o JOIN tfold f ON f.o_custkey = o.o_custkey AND f.o_orderstatus = o.o_orderstatus
JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey""",

    "tenant_tokens": f"""WITH {TENANT}
SELECT 'O365_users_delta' AS key, CAST(utok_new AS VARCHAR) AS delta FROM utok WHERE utok_new <> utok_old
UNION ALL SELECT 'O365_folders|' || CAST(o_custkey AS VARCHAR), CAST(max(mx) AS VARCHAR) FROM tfold GROUP BY o_custkey
UNION ALL SELECT 'O365_messages|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus, CAST(mx AS VARCHAR) FROM tfold
UNION ALL SELECT delta_key, delta FROM recs WHERE emit_seq = 2""",

    "stream_sync": f"""WITH {RECORDS} SELECT * FROM recs""",

    "stream_dedupe": f"""WITH {RECORDS} SELECT * FROM recs""",

    "attachments_replay": """SELECT 'success_attachments' AS route, CAST(0 AS BIGINT) AS emit_seq,
       CAST(o.o_custkey AS VARCHAR) AS user_id, o.o_orderstatus AS folder_id,
       CAST(l.l_orderkey AS VARCHAR) AS message_id, p.p_type AS content_type, p.p_type AS mime_type,
       p.p_name AS file_name
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey""",
    "stream_late_pages": f"""WITH {RECORDS} SELECT * FROM recs""",

    "stream_new_folders": f"""WITH {RECORDS} SELECT * FROM recs""",

    "stream_chained_tokens": f"""WITH {TOK}, {FOLD}
SELECT 'success_messages' AS route, CAST(1 AS BIGINT) AS emit_seq, CAST(user_id AS VARCHAR) AS user_id,
       event_type AS folder_id, 'c' || CAST(event_id AS VARCHAR) AS message_id, CAST(NULL AS VARCHAR) AS cache_key,
       CAST(NULL AS VARCHAR) AS delta_key, CAST(NULL AS VARCHAR) AS delta
FROM events e
UNION ALL
SELECT 'success_messages', 2, NULL, NULL, NULL, NULL, {MKEY.format(u='user_id', t='event_type')}, CAST(tok AS VARCHAR) FROM tok
UNION ALL
SELECT 'success_messages', 2, NULL, NULL, NULL, NULL, {MKEY.format(u='user_id', t='event_type')}, CAST(last_id AS VARCHAR)
FROM fold LEFT JOIN tok USING (user_id, event_type) WHERE tok IS NULL OR tok <> last_id""",

    "delta_failures": f"""WITH {INPUTS}
SELECT 'Failure' AS route, user_id, folder_id, delta, CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS error_class
FROM inputs WHERE user_id IS NULL OR folder_id IS NULL
UNION ALL
SELECT 'Failure', user_id, folder_id, delta, 'page body is not JSON', 'JsonParseException'
FROM inputs WHERE folder_id IS NOT NULL AND CAST(user_id AS BIGINT) % 3 = 0""",

    "generic_records": """SELECT 'Success' AS route, CAST(1 AS BIGINT) AS emit_seq, url AS asked_url, 2 AS n_attrs, page_id FROM pages""",

    "cache_original": f"""WITH {CKPT},
new_users AS (SELECT count(*) AS n FROM customer WHERE c_custkey > {USERS_TOKEN}),
mine AS (SELECT DISTINCT user_id AS u FROM events),
found AS (SELECT o_custkey, o_orderstatus FROM orders JOIN mine ON u = o_custkey GROUP BY 1, 2)
SELECT 'users/Success' AS route, CAST(n + CASE WHEN n > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_records FROM new_users WHERE n > 0
UNION ALL SELECT 'users/Original', count(*) FROM mine
UNION ALL SELECT 'folders/Original', count(*) FROM mine
UNION ALL SELECT 'folders/Success', CAST((SELECT count(*) FROM found) + (SELECT count(DISTINCT o_custkey) FROM found) AS BIGINT)""",

    "mixed_attempts": f"""WITH {RANKED},
pages AS (SELECT user_id, event_type, greatest(0, (count(*) - 1) // 10) AS last FROM ranked GROUP BY 1, 2)
SELECT {MKEY.format(u='c.user_id', t='c.event_type')} AS key, coalesce(old_delta, '') AS old_delta, CAST(last_id AS VARCHAR) AS new_delta
FROM chains c LEFT JOIN pages p ON p.user_id = c.user_id AND p.event_type = c.event_type WHERE coalesce(last, 0) = 0""",

    "replay_new_link": f"""WITH {TOKENS} SELECT key, old_delta, new_delta || '-again' AS new_delta FROM tokens""",

    "ckpt_remove_stored": f"""WITH {CKPT}
SELECT * FROM ckpt WHERE key <> 'O365_users_delta'
  AND key NOT IN (SELECT 'O365_folders|' || CAST(c_custkey AS VARCHAR) FROM customer)""",

    "generic_scan": """SELECT page_id AS request_id, page_id AS id, url AS web_url, CAST(length(html) AS INTEGER) AS n_chars FROM pages""",
}

# the same rows whatever was landed twice, in another order, or by other pages
ORACLES["messages_recut"] = ORACLES["stream_recut"] = ORACLES["stream_sync"]
ORACLES["attachments_unfinished_rerun"] = ORACLES["attachments_replay"]
ORACLES["messages_catch_up"] = ORACLES["stream_chained_tokens"]
ORACLES["stream_tenant"] = ORACLES["tenant_sync"]
ORACLES["scans_landed_twice"] = """SELECT 'users' AS entity, count(*) AS n_rows FROM customer
UNION ALL SELECT 'messages', count(*) FROM orders
UNION ALL SELECT 'attachments', count(*) FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey"""
ORACLES["pruned_tokens"] = f"""WITH {TOKENS} SELECT key, old_delta, new_delta FROM tokens WHERE regexp_matches(key, '^O365_messages\\|[0-9]\\|')"""
