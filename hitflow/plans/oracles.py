"""The queries of ``queries.py`` as SQL for DuckDB, over the same tables.

Written from the rules, not from the Spark code: addresses, parameters and attribution take other routes
here (list functions, range joins with a ranking, a recursive query).
"""

from __future__ import annotations

from hitflow.plans.workload import LINES_SELECT

LINES = (
    LINES_SELECT.replace("{stamp}", "strftime(ts, '%Y-%m-%dT%H:%M:%S')")
    .replace("{day}", "strftime(ts, '%Y%m%d')")
    .replace("{events}", "events")
)

OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
SAVED = "TIMESTAMP '2024-01-15 00:00:00'"
NOON = "TIMESTAMP '2024-01-15 12:00:00'"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def _path(url: str) -> str:
    bare = rf"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    return f"regexp_replace({bare}, ';[^/]*$', '')"


def _value(name: str, query: str = "query_string") -> str:
    """First non-blank value of a parameter."""
    match = (
        f"list_filter(string_split({query}, '&'), lambda p: strpos(p, '=') > 0 "
        f"AND length(p) > strpos(p, '=') AND url_decode(split_part(p, '=', 1)) = '{name}')[1]"
    )
    return f"url_decode(replace(substr({match}, strpos({match}, '=') + 1), '+', ' '))"


def _digits(value: str) -> str:
    return f"nullif(regexp_extract({value}, '^[0-9]+'), '')"


def _first(*names: str) -> str:
    return f"coalesce({', '.join(_digits(_value(n)) for n in names)})"


FIELDS = f"""
lines AS ({LINES}),
split AS (SELECT *, string_split(trim(raw, concat(' ', chr(9))), chr(9)) AS p FROM lines),
parsed AS (
  SELECT id, host, file, line_num, ingest_time, raw,
         CASE WHEN len(p) >= 9 THEN p[1] END AS "timestamp", CASE WHEN len(p) >= 9 THEN p[2] END AS edge_ip,
         CASE WHEN len(p) >= 9 THEN p[3] END AS "method",
         CASE WHEN len(p) >= 9 THEN {_path("p[4]")} END AS path,
         CASE WHEN len(p) >= 9 THEN p[5] END AS query_string, CASE WHEN len(p) >= 9 THEN p[6] END AS status,
         CASE WHEN len(p) >= 9 THEN p[7] END AS user_agent, CASE WHEN len(p) >= 9 THEN p[8] END AS referer,
         CASE WHEN len(p) >= 9 THEN p[9] END AS client_ip
  FROM split)"""

PARAMETERS = f"""{FIELDS},
params AS (
  SELECT *, {_first("client", "c")} AS client, {_first("booking", "campaign", "b")} AS booking,
         {_first("creative", "r")} AS creative, {_first("site", "s")} AS site,
         trim(split_part(client_ip, ',', 1)) AS hop,
         CASE WHEN path IN ('/impression', '/viewer') THEN 'impression'
              WHEN path IN ('/client', '/response') THEN 'webhit' END AS category
  FROM parsed)"""

ADDRESS = f"""CASE WHEN regexp_full_match(hop, '{OCTET}\\.{OCTET}\\.{OCTET}\\.{OCTET}') THEN concat('::ffff:', hop)
       WHEN contains(hop, ':') THEN lower(regexp_replace(hop, '(:0)+:', '::')) END"""

TOUCHES = f"""{PARAMETERS},
typed AS (
  SELECT id, host, line_num, raw, ingest_time, category, user_agent,
         TRY_CAST(client AS INTEGER) AS client_id, TRY_CAST(booking AS INTEGER) AS booking_id,
         TRY_CAST(creative AS INTEGER) AS creative_id, TRY_CAST(site AS INTEGER) AS site_id,
         {ADDRESS} AS ip, path,
         coalesce(CASE WHEN regexp_matches("timestamp", '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T')
                       THEN CAST(substr("timestamp", 1, 19) AS TIMESTAMP)
                       WHEN regexp_matches("timestamp", '^[0-9]{{8}}$') THEN strptime("timestamp", '%Y%m%d') END,
                  CASE WHEN category = 'webhit' THEN ingest_time END) AS event_time,
         CASE category WHEN 'impression' THEN client IS NOT NULL AND booking IS NOT NULL AND creative IS NOT NULL
                       WHEN 'webhit' THEN client IS NOT NULL AND site IS NOT NULL ELSE FALSE END AS is_valid
  FROM params),
touches AS (
  SELECT *, CASE WHEN path IS NULL THEN 'malformed' WHEN category IS NULL THEN 'unrouted'
                 WHEN NOT is_valid THEN 'missing_key'
                 WHEN client_id IS NULL OR (category = 'impression' AND (booking_id IS NULL OR creative_id IS NULL))
                   THEN 'bad_id'
                 WHEN category = 'webhit' AND site_id IS NULL THEN 'bad_site'
                 WHEN ip IS NULL THEN 'bad_ip' WHEN event_time IS NULL THEN 'bad_timestamp' END AS reject_reason
  FROM typed),
imps AS MATERIALIZED (
  SELECT id, event_time, client_id, booking_id, creative_id, ip, user_agent FROM touches
  WHERE category = 'impression' AND reject_reason IS NULL),
hits AS MATERIALIZED (
  SELECT id, event_time, client_id, site_id, ip FROM touches WHERE category = 'webhit' AND reject_reason IS NULL)"""

HIT_COLUMNS = "h.id, h.event_time, h.client_id, h.site_id, h.ip"


def _newest(imps: str, upper: str = "") -> str:
    """Newest matching impression per hit by range join and ranking."""
    return f"""
  SELECT h.id AS hit_id, i.id AS impression_id, i.event_time AS impression_time
  FROM hits h JOIN {imps} i ON i.client_id = h.client_id AND i.ip = h.ip
   AND i.event_time > h.event_time - INTERVAL 7 DAY {upper}
  QUALIFY row_number() OVER (PARTITION BY h.id ORDER BY i.event_time DESC, i.id DESC) = 1"""


BEFORE = "AND i.event_time <= h.event_time"
MATCHED = f"""
  SELECT {HIT_COLUMNS}, m.impression_id, m.impression_time FROM hits h JOIN ({{newest}}) m ON m.hit_id = h.id"""

CAUSAL = f"{TOUCHES},\nattributed AS MATERIALIZED ({MATCHED.format(newest=_newest('imps', BEFORE))})"
UNBOUNDED = f"{TOUCHES},\nattributed AS MATERIALIZED ({MATCHED.format(newest=_newest('imps'))})"
FIRST = "row_number() OVER (PARTITION BY impression_id, site_id ORDER BY event_time, id) = 1"
ACCEPTED = f"{CAUSAL},\naccepted AS (SELECT * FROM attributed QUALIFY {FIRST})"
TIERS = """
hot AS (SELECT * FROM imps WHERE booking_id % 3 <> 0), archive AS (SELECT * FROM imps WHERE booking_id % 3 = 0)"""


def _tiered(upper: str) -> str:
    return f"""WITH {TOUCHES}, {TIERS},
a AS ({_newest('hot', upper)}), b AS ({_newest('archive', upper)})
SELECT {HIT_COLUMNS}, coalesce(a.impression_id, b.impression_id) AS impression_id,
       coalesce(a.impression_time, b.impression_time) AS impression_time
FROM hits h LEFT JOIN a ON a.hit_id = h.id LEFT JOIN b ON b.hit_id = h.id
WHERE a.hit_id IS NOT NULL OR b.hit_id IS NOT NULL"""


STATE = f"(SELECT 'impression' AS entity_type, max(event_id) AS last_id FROM events WHERE ts < {SAVED})"
MAXIMA = """(SELECT 'impression' AS entity_type, max(id) AS max_id FROM imps
   UNION ALL SELECT 'webhit', max(id) FROM hits)"""
CURSORS = f"""(SELECT m.entity_type, coalesce(s.last_id, 0) AS last_id FROM {MAXIMA} m
   LEFT JOIN {STATE} s ON s.entity_type = m.entity_type)"""

DAILY_SITE = """SELECT CAST(event_time AS DATE) AS "date", client_id, site_id AS sitetag_id, count(*) AS hits
FROM {source} GROUP BY ALL"""

FIRST_LINES = "(SELECT host, file, sha256(arg_min(raw, line_num)) AS first_line_hash FROM lines GROUP BY host, file)"


def _tail_state(source: str) -> str:
    return f"""(SELECT l.host, l.file, l.line_num AS last_line_num, f.first_line_hash
   FROM {source} l JOIN {FIRST_LINES} f ON f.host = l.host AND f.file = l.file
   QUALIFY row_number() OVER (PARTITION BY l.host ORDER BY l.file DESC, l.line_num DESC) = 1)"""


READ = f"(SELECT * FROM lines WHERE ingest_time < {NOON} AND host <> 'edge8')"


def _strict(name: str) -> str:
    return _value(name)


ORACLES: dict[str, str] = {
    "parse_lines": f"""WITH {FIELDS}
SELECT id, "timestamp", edge_ip, "method", path, query_string, status, user_agent, referer, client_ip FROM parsed""",
    "url_paths": f"""WITH lines AS ({LINES})
SELECT 'log' AS source, id, {_path("split_part(raw, chr(9), 4)")} AS path FROM lines
UNION ALL SELECT 'page', page_id, {_path("url")} FROM pages""",
    "query_params": f"""WITH {FIELDS},
q AS (SELECT 'log' AS source, id, query_string AS q FROM parsed WHERE query_string IS NOT NULL
      UNION ALL SELECT 'page', page_id, regexp_extract(url, '\\?([^#]*)', 1) FROM pages),
n AS (SELECT source, id, string_split(q, '&') AS parts, unnest(range(1, len(string_split(q, '&')) + 1)) AS i FROM q),
pair AS (SELECT source, id, i, url_decode(split_part(parts[i], '=', 1)) AS name,
                replace(substr(parts[i], strpos(parts[i], '=') + 1), '+', ' ') AS v
         FROM n WHERE strpos(parts[i], '=') > 0 AND length(parts[i]) > strpos(parts[i], '='))
SELECT source, id, name, url_decode(v) AS value FROM pair
QUALIFY row_number() OVER (PARTITION BY source, id, name ORDER BY i) = 1""",
    "leading_ints": f"""WITH {FIELDS}
SELECT id, {_digits(_value("site"))} AS site_digits, TRY_CAST({_digits(_value("site"))} AS INTEGER) AS site_int,
       {_digits(_value("c"))} AS c_digits, TRY_CAST({_digits(_value("c"))} AS INTEGER) AS c_int FROM parsed""",
    "alias_normalise": f"WITH {PARAMETERS} SELECT id, client, booking, creative, site FROM params",
    "client_ip_norm": f"WITH {PARAMETERS} SELECT id, hop, {ADDRESS} AS ip FROM params",
    "ip_binary": f"""WITH {PARAMETERS},
a AS (SELECT id, hop, {ADDRESS} AS ip FROM params)
SELECT id, ip, CASE WHEN starts_with(ip, '::ffff:') THEN concat('00000000000000000000ffff',
    printf('%02x%02x%02x%02x', CAST(split_part(hop, '.', 1) AS INTEGER), CAST(split_part(hop, '.', 2) AS INTEGER),
           CAST(split_part(hop, '.', 3) AS INTEGER), CAST(split_part(hop, '.', 4) AS INTEGER)))
  WHEN ip IS NOT NULL THEN concat('20010db8', repeat('0', 16), lpad(lower(split_part(hop, ':', 7)), 4, '0'), '0001')
  END AS packed_hex FROM a""",
    "event_times": f"""WITH {FIELDS},
t AS (SELECT id, ingest_time, CASE WHEN regexp_matches("timestamp", '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T')
             THEN CAST(substr("timestamp", 1, 19) AS TIMESTAMP)
             WHEN regexp_matches("timestamp", '^[0-9]{{8}}$') THEN strptime("timestamp", '%Y%m%d') END AS wall_clock,
             CASE WHEN length("timestamp") > 8 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS shift FROM parsed)
SELECT id, wall_clock, wall_clock - shift AS utc_instant, coalesce(wall_clock, ingest_time) AS event_time,
       coalesce(wall_clock, ingest_time) - INTERVAL 7 DAY AS lookback_start FROM t""",
    "message_json": f"""WITH {TOUCHES}
SELECT id, concat('{{"id":', id, ',"timestmp":"', strftime(event_time, '%Y-%m-%dT%H:%M:%S'), '","client_id":', client_id,
  ',"booking_id":', booking_id, ',"creative_id":', creative_id, ',"ipaddress":"', ip, '","useragent":"', user_agent,
  '"}}') AS message FROM imps""",
    "envelope_json": f"""WITH lines AS ({LINES})
SELECT id, CASE WHEN id % 5 <> 0 THEN host END AS host, CASE WHEN id % 5 <> 0 THEN line_num END AS line_num,
       CASE WHEN id % 5 <> 0 THEN CAST(length(raw) AS INTEGER) END AS raw_length FROM lines""",
    "line_hash": f"WITH lines AS ({LINES}) SELECT id, sha256(raw) AS line_hash FROM lines",
    "classify_lenient": f"""WITH {TOUCHES}
SELECT p.id, p.category, t.is_valid, client, booking, creative, site FROM params p JOIN typed t ON t.id = p.id
WHERE p.category IS NOT NULL""",
    "classify_strict": f"""WITH {PARAMETERS},
s AS (SELECT id, category, {_strict("client")} AS client, {_strict("booking")} AS booking,
             {_strict("creative")} AS creative, {_strict("site")} AS site FROM params)
SELECT id, category, TRUE AS is_valid, client, booking, creative, site FROM s
WHERE client IS NOT NULL AND ((category = 'impression' AND booking IS NOT NULL AND creative IS NOT NULL)
   OR (category = 'webhit' AND site IS NOT NULL))""",
    "valid_impressions": f"WITH {TOUCHES} SELECT * FROM imps",
    "valid_webhits": f"WITH {TOUCHES} SELECT * FROM hits",
    "rejects": f"""WITH {TOUCHES}
SELECT host, line_num, raw, reject_reason AS reason FROM touches WHERE reject_reason IS NOT NULL""",
    "rejects_by_reason": f"WITH {TOUCHES} SELECT reject_reason, count(*) AS lines FROM touches GROUP BY reject_reason",
    "route_counts": f"""WITH {TOUCHES}
SELECT category, count(*) AS lines, count(*) FILTER (WHERE reject_reason IS NULL) AS accepted,
       count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected FROM touches GROUP BY category""",
    "queue_backlog": f"""WITH {PARAMETERS}
SELECT category, count(*) AS waiting FROM params
WHERE category IS NOT NULL AND id > (SELECT max(event_id) FROM events WHERE ts < {SAVED}) GROUP BY category""",
    "peek": f"WITH lines AS ({LINES}) SELECT id, host, line_num, raw FROM lines ORDER BY id LIMIT 10",
    "attribute_causal": f"WITH {CAUSAL} SELECT * FROM attributed",
    "attribute_unbounded": f"WITH {UNBOUNDED} SELECT * FROM attributed",
    "attribute_tiered": _tiered(""),
    "attribute_tiered_causal": _tiered(BEFORE),
    "attribute_arrival": f"""WITH {TOUCHES}, {TIERS},
last AS (SELECT client_id, ip, id, event_time FROM hot
         QUALIFY row_number() OVER (PARTITION BY client_id, ip ORDER BY id DESC) = 1),
a AS ({_newest('hot')}), b AS ({_newest('archive')})
SELECT {HIT_COLUMNS},
       CASE WHEN l.event_time > h.event_time - INTERVAL 7 DAY THEN l.id
            ELSE coalesce(a.impression_id, b.impression_id) END AS impression_id,
       CASE WHEN l.event_time > h.event_time - INTERVAL 7 DAY THEN l.event_time
            ELSE coalesce(a.impression_time, b.impression_time) END AS impression_time
FROM hits h LEFT JOIN last l ON l.client_id = h.client_id AND l.ip = h.ip
LEFT JOIN a ON a.hit_id = h.id LEFT JOIN b ON b.hit_id = h.id
WHERE l.event_time > h.event_time - INTERVAL 7 DAY OR a.hit_id IS NOT NULL OR b.hit_id IS NOT NULL""",
    "unattributed_hits": f"WITH {CAUSAL} SELECT * FROM hits WHERE id NOT IN (SELECT id FROM attributed)",
    "latest_impression_per_key": f"""WITH {TOUCHES}
SELECT client_id, ip, id AS impression_id, event_time AS impression_time FROM imps
QUALIFY row_number() OVER (PARTITION BY client_id, ip ORDER BY event_time DESC, id DESC) = 1""",
    "latest_impression_30d": f"""WITH {TOUCHES},
k AS (SELECT client_id, ip FROM imps ORDER BY event_time DESC, id DESC LIMIT 1)
SELECT i.id AS impression_id, i.event_time AS impression_time
FROM imps i JOIN k ON k.client_id = i.client_id AND k.ip = i.ip
WHERE i.event_time > {AS_OF} - INTERVAL 30 DAY ORDER BY i.event_time DESC, i.id DESC LIMIT 1""",
    "accepted_webhits": f"WITH {ACCEPTED} SELECT * FROM accepted",
    "dedupe_first": f"WITH {UNBOUNDED} SELECT * FROM attributed QUALIFY {FIRST}",
    "dedupe_against_store": f"""WITH {CAUSAL},
stored AS (SELECT * FROM attributed WHERE event_time < {SAVED} QUALIFY {FIRST})
SELECT * FROM attributed a WHERE event_time >= {SAVED} AND NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.impression_id = a.impression_id AND s.site_id = a.site_id
     AND s.event_time > a.event_time - INTERVAL 7 DAY)""",
    "dedupe_greedy": f"""WITH RECURSIVE {UNBOUNDED},
kept AS (
  SELECT * FROM (SELECT * FROM attributed QUALIFY {FIRST})
  UNION ALL
  SELECT * FROM (
    SELECT a.* FROM attributed a JOIN kept k ON k.impression_id = a.impression_id AND k.site_id = a.site_id
       AND a.event_time >= k.event_time + INTERVAL 7 DAY
    QUALIFY row_number() OVER (PARTITION BY a.impression_id, a.site_id ORDER BY a.event_time, a.id) = 1))
SELECT * FROM kept""",
    "seen_sites": f"""WITH {ACCEPTED}
SELECT client_id, ip, string_agg(DISTINCT CAST(site_id AS VARCHAR), ',' ORDER BY CAST(site_id AS VARCHAR)) AS sites
FROM accepted GROUP BY client_id, ip""",
    "drop_seen_sites": f"""WITH {TOUCHES}
SELECT * FROM hits h WHERE event_time >= {SAVED} AND NOT EXISTS (
  SELECT 1 FROM hits o WHERE o.event_time < {SAVED} AND o.client_id = h.client_id AND o.ip = h.ip
     AND o.site_id = h.site_id)""",
    "numbered_impressions": f"""WITH {TOUCHES}
SELECT 1000 + row_number() OVER (ORDER BY event_time, id) AS id, id AS event_id, event_time, client_id FROM imps""",
    "cursor_bootstrap": f"""WITH {TOUCHES}
SELECT entity_type, CAST(greatest(0, max_id - 1000) AS BIGINT) AS last_id FROM {MAXIMA}""",
    "cursor_resume": f"WITH {TOUCHES} SELECT entity_type, last_id FROM {CURSORS}",
    "incremental_by_id": f"""WITH {TOUCHES}, c AS {CURSORS}
SELECT 'impression' AS entity_type, id, event_time, client_id, ip FROM imps
WHERE id > (SELECT last_id FROM c WHERE entity_type = 'impression')
UNION ALL SELECT 'webhit', id, event_time, client_id, ip FROM hits
WHERE id > (SELECT last_id FROM c WHERE entity_type = 'webhit')""",
    "incremental_by_date": f"""WITH {TOUCHES}
SELECT * FROM ({DAILY_SITE.format(source="hits")}) WHERE "date" >= DATE '2024-01-21'""",
    "keyset_page": """SELECT event_id, ts, user_id, event_type FROM events WHERE event_id > 99
ORDER BY event_id LIMIT 500""",
    "high_water_marks": f"""WITH {TOUCHES}
SELECT c.entity_type, c.last_id, greatest(m.max_id, c.last_id) AS new_last_id
FROM {CURSORS} c JOIN {MAXIMA} m ON m.entity_type = c.entity_type""",
    "extract_marks": f"""WITH {TOUCHES}, x AS (
  SELECT 'impression' AS entity_type, id FROM imps UNION ALL SELECT 'webhit', id FROM hits)
SELECT c.entity_type, c.last_id, count(x.id) AS new_rows, greatest(coalesce(max(x.id), c.last_id), c.last_id) AS new_last_id
FROM {CURSORS} c LEFT JOIN x ON x.entity_type = c.entity_type AND x.id > c.last_id
GROUP BY c.entity_type, c.last_id""",
    "cursor_upsert": f"""WITH {TOUCHES}
SELECT entity_type, max_id AS last_id, {AS_OF} AS updated_at FROM {MAXIMA}""",
    "daily_site_hits": f"WITH {TOUCHES} {DAILY_SITE.format(source='hits')}",
    "daily_impression_hits": f"""WITH {TOUCHES}
SELECT CAST(event_time AS DATE) AS "date", client_id, booking_id, creative_id, count(*) AS hits FROM imps GROUP BY ALL""",
    "daily_upsert": f"""WITH {TOUCHES},
stored AS ({DAILY_SITE.format(source=f"(SELECT * FROM hits WHERE event_time < {NOON})")}),
fresh AS ({DAILY_SITE.format(source=f"(SELECT * FROM hits WHERE event_time >= {SAVED})")})
SELECT * FROM fresh UNION ALL SELECT * FROM stored s WHERE NOT EXISTS (
  SELECT 1 FROM fresh f WHERE f."date" = s."date" AND f.client_id = s.client_id AND f.sitetag_id = s.sitetag_id)""",
    "tail_state": f"WITH lines AS ({LINES}) SELECT * FROM {_tail_state(READ)}",
    "resume_tail": f"""WITH lines AS ({LINES}), s AS {_tail_state(READ)}
SELECT l.host, l.file, l.line_num, l.raw FROM lines l LEFT JOIN s ON s.host = l.host
WHERE s.host IS NULL OR l.file > s.file OR (l.file = s.file AND l.line_num > s.last_line_num)""",
    "tail_state_upsert": f"WITH lines AS ({LINES}) SELECT * FROM {_tail_state('lines')}",
    "fetch_lines": f"""WITH lines AS ({LINES})
SELECT host, file, line_num, raw FROM lines WHERE host = 'edge3' AND file = 'access.log-20240115' AND line_num >= 1""",
    "first_line_hashes": f"WITH lines AS ({LINES}) SELECT * FROM {FIRST_LINES}",
    "rotation_events": f"""WITH lines AS ({LINES}),
polls AS (SELECT DISTINCT l.host, date_trunc('hour', ingest_time) AS poll_ts, first_line_hash
          FROM lines l JOIN {FIRST_LINES} f ON f.host = l.host AND f.file = l.file),
o AS (SELECT *, lag(first_line_hash) OVER (PARTITION BY host ORDER BY poll_ts) AS previous_hash FROM polls)
SELECT host, CAST(poll_ts AS TIMESTAMP) AS poll_ts, previous_hash, first_line_hash FROM o
WHERE previous_hash <> first_line_hash""",
    "latest_rotated_file": f"""WITH lines AS ({LINES})
SELECT host, concat('/var/log/edge/', file) AS path, max(ingest_time) AS mtime FROM lines GROUP BY host, file
QUALIFY row_number() OVER (PARTITION BY host ORDER BY max(ingest_time) DESC) = 1""",
}
# The stream of accepted hits must equal the batch result.
ORACLES["attribute_causal_split"] = ORACLES["attribute_causal"]
ORACLES["attribute_unbounded_split"] = ORACLES["attribute_unbounded"]
ORACLES["stream_rejects"] = ORACLES["rejects"]
ORACLES["stream_accepted_webhits"] = ORACLES["accepted_webhits"]
ORACLES["stream_interval"] = ORACLES["accepted_webhits"]
ORACLES["stream_unattributed"] = ORACLES["unattributed_hits"]
ORACLES["stream_consume_queues"] = ORACLES["accepted_webhits"]
ORACLES["stream_consume_rejects"] = f"""WITH {TOUCHES}
SELECT CASE category WHEN 'impression' THEN 'impressions_queue' ELSE 'webhits_queue' END AS queue, id, reject_reason AS reason
FROM touches WHERE category IS NOT NULL AND reject_reason IS NOT NULL
UNION ALL SELECT 'webhits_queue', NULL, 'bad_json' FROM touches WHERE category = 'webhit' AND id % 5 = 0"""
ORACLES["stream_replayed_lines"] = f"""WITH {TOUCHES}
SELECT id, event_time, client_id, booking_id, creative_id, ip FROM imps"""
ORACLES["stream_route"] = f"""WITH {PARAMETERS}
SELECT CASE category WHEN 'impression' THEN 'impressions_queue' ELSE 'webhits_queue' END AS queue, host, line_num, path,
       "timestamp", client_ip, client, booking, creative, site FROM params WHERE category IS NOT NULL"""
ORACLES["stream_bridge"] = f"""WITH lines AS ({LINES}),
e AS (SELECT id, concat('{{"host":"', host, '","line_num":', line_num, ',"raw":"', replace(raw, chr(9), '\\t'), '"}}') AS value
      FROM lines)
SELECT CASE WHEN id % 5 = 0 THEN 'rejects' ELSE 'messages' END AS queue, count(*) AS messages,
       CAST(sum(CASE WHEN id % 5 = 0 THEN 20 ELSE length(value) END) AS BIGINT) AS characters FROM e GROUP BY 1"""
# No look-back bound here: state expires in processing time, and a single run takes no time.
ORACLES["stream_stateful_attribution"] = f"""WITH {TOUCHES},
attributed AS (
  SELECT {HIT_COLUMNS}, i.id AS impression_id, i.event_time AS impression_time
  FROM hits h JOIN imps i ON i.client_id = h.client_id AND i.ip = h.ip {BEFORE}
  QUALIFY row_number() OVER (PARTITION BY h.id ORDER BY i.event_time DESC, i.id DESC) = 1)
SELECT * FROM attributed QUALIFY {FIRST}"""

PHASES = f"""{TOUCHES},
arrived AS (SELECT id, CASE WHEN ingest_time < TIMESTAMP '2024-01-11' THEN 0
                            WHEN ingest_time < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS period FROM touches),
attributed AS (
  SELECT {HIT_COLUMNS}, i.id AS impression_id, i.event_time AS impression_time, a.period
  FROM hits h JOIN arrived a ON a.id = h.id
  JOIN imps i ON i.client_id = h.client_id AND i.ip = h.ip JOIN arrived b ON b.id = i.id AND b.period <= a.period
  QUALIFY row_number() OVER (PARTITION BY h.id ORDER BY b.period DESC, i.event_time DESC, i.id DESC) = 1),
accepted AS (SELECT * FROM attributed
  QUALIFY row_number() OVER (PARTITION BY impression_id, site_id ORDER BY period, event_time, id) = 1)"""
ORACLES["stream_stateful_phases"] = f"""WITH {PHASES}
SELECT id, event_time, client_id, site_id, ip, impression_id, impression_time FROM accepted"""
ORACLES["stream_state_table"] = f"""WITH {PHASES},
last AS (SELECT i.client_id, i.ip, i.id AS impression_id, i.event_time AS impression_time
  FROM imps i JOIN arrived b ON b.id = i.id
  QUALIFY row_number() OVER (PARTITION BY i.client_id, i.ip ORDER BY b.period DESC, i.event_time DESC, i.id DESC) = 1)
SELECT l.*, coalesce(s.sites, '') AS sites FROM last l LEFT JOIN (
  SELECT impression_id, string_agg(CAST(site_id AS VARCHAR), ',' ORDER BY site_id) AS sites
  FROM accepted GROUP BY impression_id) s ON s.impression_id = l.impression_id"""
ORACLES["numbered_lines"] = f"""WITH lines AS ({LINES})
SELECT host, file, row_number() OVER (PARTITION BY host, file ORDER BY line_num) AS line_num, raw FROM lines"""
ORACLES["stream_tail_rotation"] = f"""WITH lines AS ({LINES})
SELECT host, row_number() OVER (PARTITION BY host, file ORDER BY line_num) AS line_num, raw,
       CASE WHEN ingest_time < TIMESTAMP '2024-01-10 12:00:00' THEN 0
            WHEN ingest_time < TIMESTAMP '2024-01-20 12:00:00' THEN 1 ELSE 2 END AS poll FROM lines"""
ORACLES["daily_upsert_table"] = ORACLES["daily_upsert"]
