"""SQL text of the derived tables, for checking query results with another engine."""

from __future__ import annotations

VIEWS = {
    "v_cities": """
SELECT n_nationkey AS city_id, n_name AS city_name,
       CAST((n_nationkey*37)%140-70 AS DOUBLE) AS latitude,
       CAST((n_nationkey*73)%360-180 AS DOUBLE) AS longitude
FROM nation""",
    "v_routes": """
SELECT CASE WHEN l.l_linestatus = 'O' THEN 'drive-now' ELSE 'deutsche-bahn' END AS service_provider,
       l.l_orderkey*10 + l.l_linenumber AS route_id,
       MIN(s.s_nationkey) AS origin, MIN(c.c_nationkey) AS destination,
       MIN(l.l_shipdate) AS traveldate, MIN(p.p_brand) AS partner,
       CAST(FLOOR(MIN(l.l_extendedprice)/100) AS INT) AS cost
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY l.l_linestatus, l.l_orderkey, l.l_linenumber""",
    "v_trip_requests": """
SELECT c_custkey AS request_id, c_nationkey AS origin,
       CAST(CASE WHEN c_custkey % 40 = 0 THEN 99 ELSE (c_custkey*7) % 25 END AS INT) AS destination
FROM customer""",
    "v_booking_requests": """
SELECT o_orderkey AS request_id,
       CASE WHEN o_orderpriority LIKE '1%' THEN 'drive-now'
            WHEN o_orderpriority LIKE '2%' THEN 'deutsche-bahn' ELSE 'other' END AS service,
       o_orderkey*10 + 1 AS route_id
FROM orders""",
    "v_spans": """
SELECT CAST(0 AS BIGINT) AS trace_id_high, user_id AS trace_id, event_id AS id, event_type AS name,
       LAG(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS parent_id,
       epoch_us(ts) AS start_ts, CAST(FLOOR(value*1000) AS BIGINT) AS duration, (event_id % 3 = 0) AS scanned
FROM events""",
    "v_annotations": """
SELECT CAST(0 AS BIGINT) AS trace_id_high, user_id AS trace_id, event_id AS span_id, 'k' AS a_key,
       json_extract_string(props,'$.k') AS a_value, 6 AS a_type, epoch_us(ts) AS a_timestamp,
       CAST(NULL AS INT) AS endpoint_ipv4, CAST(NULL AS VARCHAR) AS endpoint_ipv6, CAST(NULL AS INT) AS endpoint_port,
       CONCAT('svc-', CAST(event_id % 7 AS VARCHAR(5)),
              CASE WHEN event_id % 7 < 4 THEN '-mobility-service' ELSE '-core-service' END) AS endpoint_service_name
FROM events WHERE event_id % 10 <> 0""",
    "v_users": """
SELECT c_name AS username, (c_acctbal >= 0) AS enabled FROM customer""",
    "v_user_roles": """
SELECT c_name AS username, CONCAT('ROLE_', c_mktsegment) AS role FROM customer WHERE c_custkey % 10 <> 0
UNION ALL
SELECT c_name AS username, 'ROLE_ADMIN' AS role FROM customer WHERE c_nationkey < 5""",
    "v_varied_spans": """
SELECT CAST(user_id % 2 AS BIGINT) AS trace_id_high, user_id AS trace_id, event_id AS id, event_type AS name,
       CAST(NULL AS BIGINT) AS parent_id, CASE WHEN event_id % 13 <> 0 THEN epoch_us(ts) END AS start_ts,
       CAST(FLOOR(value*1000) AS BIGINT) AS duration, (event_id % 3 = 0) AS scanned
FROM events""",
    "v_varied_annotations": """
SELECT CAST(user_id % 2 AS BIGINT) AS trace_id_high, user_id AS trace_id, event_id AS span_id,
       ['http', 'k', 'sr'][i + 1] AS a_key, event_type || '-' || i AS a_value,
       CASE WHEN i = 2 THEN -1 ELSE 6 END AS a_type,
       CASE WHEN NOT (i = 1 AND event_id % 11 = 0) THEN epoch_us(date_trunc('minute', ts)) END AS a_timestamp,
       CAST(event_id % 1000 AS INT) AS endpoint_ipv4, CAST(NULL AS VARCHAR) AS endpoint_ipv6,
       CASE WHEN i = 0 THEN 50000 ELSE 8080 END AS endpoint_port,
       'svc-' || (event_id % 7) AS endpoint_service_name, (event_id % 4 = 0) AS scanned
FROM (SELECT *, UNNEST(range(0, event_id % 3 + 1)) AS i FROM events)""",
    # Tables of answers, each built from the ones above.
    "v_varied_joined": """
SELECT t1.trace_id, COALESCE(t2.span_id, t1.id) AS span_id, t1.parent_id, t1.name, t2.endpoint_service_name,
       t2.endpoint_port, t2.a_key, t2.a_value, t2.a_type, t2.endpoint_ipv4, t2.endpoint_ipv6, t1.start_ts,
       t2.a_timestamp, t1.duration
FROM v_varied_spans t1 LEFT JOIN v_varied_annotations t2
  ON t1.trace_id_high = t2.trace_id_high AND t1.trace_id = t2.trace_id AND t1.id = t2.span_id
WHERE NOT t1.scanned""",
    "v_varied_points": """
SELECT COALESCE(a_timestamp, start_ts) AS time_us, make_timestamp(COALESCE(a_timestamp, start_ts)) AS time, trace_id,
       span_id, COALESCE(parent_id, 0) AS parent_id, name, COALESCE(endpoint_service_name, '') AS endpoint_service_name,
       COALESCE(endpoint_port, 0) AS endpoint_port, COALESCE(a_key, '') AS a_key, COALESCE(a_value, '') AS a_value,
       COALESCE(a_type, 0) AS a_type, COALESCE(endpoint_ipv4, 0) AS endpoint_ipv4, '' AS endpoint_ipv6,
       COALESCE(start_ts, 0) AS start_ts, COALESCE(duration, 0) AS duration, 1 AS a_number
FROM v_varied_joined WHERE COALESCE(a_timestamp, start_ts) IS NOT NULL""",
    "v_named": """
SELECT origin, destination FROM v_trip_requests
UNION SELECT LEAST(origin, destination), GREATEST(origin, destination) FROM v_trip_requests
UNION SELECT LEAST(origin, destination), GREATEST(origin, destination) FROM v_routes""",
    "v_distances": """
SELECT origin, destination, 2 * 6371 * ATAN2(SQRT(h), SQRT(1 - h)) AS km
FROM (SELECT p.origin, p.destination,
             POWER(SIN(RADIANS(b.latitude - a.latitude) / 2), 2)
             + COS(RADIANS(a.latitude)) * COS(RADIANS(b.latitude))
             * POWER(SIN(RADIANS(b.longitude - a.longitude) / 2), 2) AS h
      FROM v_named p JOIN v_cities a ON p.origin = a.city_id JOIN v_cities b ON p.destination = b.city_id
      WHERE p.origin <> p.destination)""",
    "v_trips": """
SELECT r.request_id, r.origin, r.destination, d.km, ROUND(d.km, 2) AS distance,
       CASE WHEN d.km IS NULL THEN 'error' ELSE 'ok' END AS status
FROM v_trip_requests r LEFT JOIN v_distances d ON r.origin = d.origin AND r.destination = d.destination""",
    "v_pairs": """
SELECT origin, destination, status, ANY_VALUE(distance) AS distance, COUNT(*) AS requests
FROM v_trips GROUP BY origin, destination, status""",
    "v_rows": """
SELECT p.origin, p.destination, p.distance,
       ROW_NUMBER() OVER (PARTITION BY p.origin, p.destination
           ORDER BY CASE WHEN r.service_provider = 'drive-now' THEN 0 ELSE 1 END, r.route_id) - 1 AS row_no,
       r.service_provider, r.route_id, CAST(r.traveldate AS DATE) AS date,
       strftime(r.traveldate, '%Y-%m-%dT%H:%M:%SUTC') AS date_text, r.partner, r.cost
FROM v_pairs p JOIN v_routes r ON p.origin = r.origin AND p.destination = r.destination
WHERE p.status = 'ok'""",
    "v_results": """
SELECT q.request_id, q.service, q.route_id,
       CASE WHEN q.service NOT IN ('drive-now', 'deutsche-bahn') THEN 'invalid'
            WHEN k.route_id IS NULL THEN 'missing' ELSE 'booked' END AS status,
       CASE WHEN q.service NOT IN ('drive-now', 'deutsche-bahn') THEN 'invalid_request'
            WHEN k.route_id IS NULL THEN 'route now found' ELSE 'booking success' END AS result,
       CASE WHEN k.route_id IS NOT NULL THEN REPLACE(q.service, '-', '') END AS service_provider,
       CASE WHEN k.route_id IS NOT NULL THEN TIMESTAMP '2024-02-01 12:00:00' END AS booking_time
FROM v_booking_requests q
LEFT JOIN (SELECT DISTINCT service_provider, route_id FROM v_routes) k
  ON q.service = k.service_provider AND q.route_id = k.route_id""",
    "v_services": """
SELECT trace_id_high, trace_id, span_id AS id, endpoint_service_name AS service
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY trace_id_high, trace_id, span_id
             ORDER BY a_timestamp NULLS LAST, endpoint_service_name) AS place FROM v_annotations)
WHERE place = 1""",
    "v_joined": """
SELECT t1.trace_id, t2.span_id, t1.id, t1.parent_id, t1.name, t2.endpoint_service_name, t2.endpoint_port, t2.a_key,
       t2.a_value, t2.a_type, t2.endpoint_ipv4, t2.endpoint_ipv6, t1.start_ts, t2.a_timestamp, t1.duration
FROM v_spans t1 LEFT JOIN v_annotations t2 ON t1.trace_id = t2.trace_id AND t1.id = t2.span_id
WHERE t1.scanned = FALSE""",
    "v_points": """
SELECT COALESCE(a_timestamp, start_ts) AS time_us, make_timestamp(COALESCE(a_timestamp, start_ts)) AS time,
       trace_id, COALESCE(span_id, id) AS span_id, COALESCE(parent_id, 0) AS parent_id, COALESCE(name, '') AS name,
       COALESCE(endpoint_service_name, '') AS endpoint_service_name, COALESCE(endpoint_port, 0) AS endpoint_port,
       COALESCE(a_key, '') AS a_key, COALESCE(a_value, '') AS a_value, COALESCE(a_type, 0) AS a_type,
       COALESCE(endpoint_ipv4, 0) AS endpoint_ipv4, COALESCE(endpoint_ipv6, '') AS endpoint_ipv6, start_ts,
       COALESCE(duration, 0) AS duration, 1 AS a_number
FROM v_joined""",
    "v_links": """
SELECT CAST(make_timestamp(c.start_ts) AS DATE) AS day, ps.service AS parent, cs.service AS child
FROM v_spans c
JOIN v_spans p ON c.trace_id_high = p.trace_id_high AND c.trace_id = p.trace_id AND c.parent_id = p.id
JOIN v_services cs ON cs.trace_id = c.trace_id AND cs.id = c.id
JOIN v_services ps ON ps.trace_id = p.trace_id AND ps.id = p.id
WHERE cs.service <> ps.service""",
}


def with_views(select: str) -> str:
    """The statement with the views it needs, directly or through other views."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name, body in VIEWS.items():
            if name in text.replace(",", " ").replace(")", " ").split() and name not in needed:
                add(body)
                needed.append(name)

    add(select)
    if not needed:
        return select.strip()
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed) + "\n" + select.strip()
