"""For each query the SQL that gives the same rows on the same tables (DuckDB dialect)."""

from __future__ import annotations

from rillflow.functions.text import STOP_WORDS
from rillflow.plans.views import BATCHES, FRIENDLY_ORDERS
from rillflow.sources.logs import CLF_PATTERN, FIELDS

LENGTH, CONTEXT, RATE = 4, 2, "CAST('0.05' AS DOUBLE)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _with(*parts: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


# Access logs

_LOG = """access_log AS (
  SELECT event_id, CASE WHEN value < 1 THEN 'bad line ' || event_id ELSE
    'user' || user_id || '.example.com - - [' || CASE event_id % 100 WHEN 8 THEN '01/Xyz/2024:10:00:00' WHEN 9 THEN '31/Feb/2024:10:00:00'
      ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END
    || ' -0400] "GET /' || event_type || '/' || regexp_extract(props, '[0-9]+') || ' HTTP/1.0" '
    || CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN '302' WHEN 'click' THEN '304' ELSE '200' END
    || ' ' || CASE WHEN event_id % 100 = 7 THEN '12kB' WHEN event_type = 'signup' THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END
  END AS line FROM events)"""

_GROUPS = ", ".join(
    f"regexp_extract(line, {_text(CLF_PATTERN)}, {i}) AS f_{name}" for i, name in enumerate(FIELDS, 1)
)
_PARSED = f"""matched AS (SELECT event_id, line, regexp_matches(line, {_text(CLF_PATTERN)}) AS ok, {_GROUPS} FROM access_log),
split AS (SELECT * REPLACE (ok AND try_strptime(substr(f_date_time, 1, 20), '%d/%b/%Y:%H:%M:%S') IS NOT NULL
    AND (f_size = '-' OR TRY_CAST(f_size AS BIGINT) IS NOT NULL) AS ok) FROM matched),
logs AS (
  SELECT event_id, f_host AS host, f_client_id AS client_id, f_user_id AS user_id,
    try_strptime(substr(f_date_time, 1, 20), '%d/%b/%Y:%H:%M:%S') AS date_time,
    f_method AS method, f_endpoint AS endpoint, f_protocol AS protocol, f_status::INTEGER AS status,
    CASE WHEN f_size = '-' THEN 0 ELSE f_size::BIGINT END AS size
  FROM split WHERE ok)"""


def _log(select: str) -> str:
    return _with(_LOG, _PARSED, select=select)


# Relational queries

_BALLOTS = """ballots AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ballot_id, o_orderpriority AS candidate_name,
    substr(o_orderpriority, 1, 1) AS candidate_ballot_order,
    CASE WHEN o_orderstatus = 'P' THEN '##PROV' ELSE CAST(o_custkey AS VARCHAR) END AS precinct_code,
    'Precinct ' || o_custkey AS precinct_name,
    CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) AS total_votes
  FROM orders)"""
_FRIENDLY = "friendly_orders(candidate_ballot_order, friendly_name) AS (VALUES " + ", ".join(
    f"({_text(a)}, {_text(b)})" for a, b in FRIENDLY_ORDERS
) + ")"
_SUM_VOTES = "CAST(sum(TRY_CAST(total_votes AS INTEGER)) AS BIGINT)"
_TOP_PRECINCT = f"""SELECT precinct_name, {_SUM_VOTES} AS sum_column FROM ballots
  WHERE TRY_CAST(precinct_code AS INTEGER) IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"""


def _ballots(select: str) -> str:
    return _with(_BALLOTS, _FRIENDLY, select=select)


# Graphs

_GRAPH = """edges AS (
  SELECT DISTINCT a.o_custkey AS src, b.o_custkey AS dst,
    CAST((a.o_custkey * 7 + b.o_custkey) % 9 + 1 AS INTEGER) AS attr
  FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1
  WHERE a.o_custkey <> b.o_custkey),
people AS (SELECT c_custkey AS id, c_name AS name, CAST(c_custkey % 60 + 18 AS INTEGER) AS age
  FROM customer),
vertices AS (SELECT * FROM people UNION ALL
  SELECT id, 'John Doe', -1 FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges)
  WHERE id NOT IN (SELECT id FROM people))"""
_TRIPLETS = """triplets AS (
  SELECT src, dst, attr, s.name AS src_name, d.name AS dst_name, s.age AS src_age, d.age AS dst_age
  FROM edges JOIN vertices s ON s.id = src JOIN vertices d ON d.id = dst)"""
_OLDEST = """oldest AS (
  SELECT dst AS id, first(src_name ORDER BY src_age DESC, src) AS follower FROM triplets GROUP BY dst)"""
_NOBODY = "name || ' does not have any followers.'"


def _graph(select: str, *parts: str) -> str:
    return _with(_GRAPH, _TRIPLETS, *parts, select=select)


# Tags

_TAGS = """tagged AS (
  SELECT doc_id AS id, text AS title, lang AS artist,
    list_distinct(regexp_extract_all(lower(text), '[a-z]+')) AS tags FROM documents),
rows AS (SELECT id, unnest(tags) AS tag FROM tagged),
common AS (SELECT a.id AS src, b.id AS dst, count(*) AS n FROM rows a JOIN rows b ON a.tag = b.tag AND a.id <> b.id
  GROUP BY 1, 2),
pairs AS (
  SELECT src, dst, n::DOUBLE / (len(a.tags) + len(b.tags) - n)::DOUBLE AS score,
    CAST(len(a.tags) AS INTEGER) AS src_tags, CAST(len(b.tags) AS INTEGER) AS dst_tags
  FROM common JOIN tagged a ON a.id = src JOIN tagged b ON b.id = dst
  WHERE (a.title <> b.title OR a.artist <> b.artist)
    AND n::DOUBLE > (len(a.tags) + len(b.tags) - n)::DOUBLE * CAST('0.7' AS DOUBLE))"""

_SETS = (
    "sets AS (SELECT min(id) AS set_id, list_sort(tags) AS tags FROM tagged WHERE len(tags) > 0 GROUP BY 2)",
    "words AS (SELECT set_id, len(tags) AS size, unnest(tags) AS tag FROM sets)",
    "met AS (SELECT a.set_id AS a, b.set_id AS b, count(*) AS n, any_value(a.size + b.size) AS size FROM words a"
    " JOIN words b ON a.tag = b.tag AND a.set_id < b.set_id GROUP BY 1, 2)",
)
_ALIKE = "n::DOUBLE > (size - n)::DOUBLE * CAST('0.7' AS DOUBLE)"

_STRETCHED = (
    "coalesce((v - min(v) OVER ()) * 1125899906842624 // nullif(max(v) OVER () - min(v) OVER (), 0), 0)"
)

_ENRICHED = """ids AS (
  SELECT p_partkey AS id, unnest([CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER), CAST(p_size + 100 AS INTEGER),
    CAST(length(p_type) + 1000 AS INTEGER)]) AS tag_id FROM part WHERE p_type <> 'SMALL'),
names AS (SELECT DISTINCT CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS tag_id, p_brand AS tag FROM part
  UNION SELECT p_size + 100, 'size ' || p_size FROM part),
found AS (SELECT DISTINCT id, tag FROM ids JOIN names USING (tag_id))"""

# Vectors

_VECTORS = """vectors AS (SELECT vec_id AS word, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings)"""


def _distance(a: str, b: str) -> str:
    return (
        f"sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"
    )


# Texts

_PURGED = "regexp_replace(lower(text), '[^a-z`'' \t]', '', 'g')"
_TEXTS = f"""short_texts AS (
  SELECT d.doc_id, d.text || ' http://t.example/' || d.doc_id AS text, d.lang, o.text AS retweet_text, d.doc_id % {BATCHES} AS batch
  FROM documents d LEFT JOIN documents o ON o.doc_id * 5 = d.doc_id),
kept AS (SELECT doc_id, batch, coalesce(retweet_text, text) AS text FROM short_texts WHERE lang = 'en'),
lists AS (SELECT doc_id, batch,
  list_filter(string_split_regex({_PURGED}, '[ \t]+'), lambda t: t <> '') AS words FROM kept),
tokens AS (SELECT doc_id, batch, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS position FROM lists)"""
_STOP = ", ".join(_text(w) for w in STOP_WORDS)
_MAY = f"word <> '' AND NOT contains(word, 'http') AND word NOT IN ({_STOP})"
_CONTENDERS = f"""contenders AS (
  SELECT word, count(DISTINCT batch) AS n FROM tokens WHERE {_MAY} GROUP BY word)"""


def _seeded(purpose: str) -> str:
    parts = [
        f"('0x' || substr(md5(word || '|{purpose}|{i}'), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE * 2 - 1"
        for i in range(LENGTH)
    ]
    return "[" + ", ".join(parts) + "]"


_VOCAB = f"""vocab AS (
  SELECT word, CAST(row_number() OVER (ORDER BY word) - 1 AS INTEGER) AS id,
    {_seeded("word")} AS x, {_seeded("weight")} AS w
  FROM contenders WHERE n > 10)"""
_CONTEXTS = f"""known AS (
  SELECT doc_id, id, row_number() OVER (PARTITION BY doc_id ORDER BY position) AS place
  FROM tokens JOIN vocab USING (word)),
around AS (
  SELECT a.doc_id, a.place, a.id, b.id AS context_id FROM known a JOIN known b
  ON a.doc_id = b.doc_id AND a.place <> b.place AND abs(a.place - b.place) <= {CONTEXT}),
targets AS (
  SELECT DISTINCT doc_id, place, id, context_id,
    1::DOUBLE / count(*) OVER (PARTITION BY doc_id, place) AS value FROM around),
totals AS (SELECT id, context_id, sum(value) AS weight FROM targets GROUP BY 1, 2),
counts AS (SELECT id, count(*) AS n FROM known GROUP BY id)"""
_SOFTMAX = """logits AS MATERIALIZED (SELECT a.id, b.id AS r, list_dot_product(a.x, b.w) AS l FROM vocab a, vocab b),
log_sums AS (SELECT id, max(l) + ln(sum(exp(l - m))) AS log_sum
  FROM (SELECT *, max(l) OVER (PARTITION BY id) AS m FROM logits) GROUP BY id)"""
_GRADIENTS = f"""p AS MATERIALIZED (
  SELECT logits.id, r, exp(l - log_sum) AS p, n, a.x, b.w FROM logits JOIN log_sums USING (id)
  JOIN counts USING (id) JOIN vocab a ON a.id = logits.id JOIN vocab b ON b.id = r),
dense_w AS (SELECT r AS id, {", ".join(f"sum(p * n * x[{i}]) AS g{i}" for i in range(1, LENGTH + 1))} FROM p GROUP BY r),
dense_x AS (SELECT id, {", ".join(f"sum(p * w[{i}]) AS g{i}" for i in range(1, LENGTH + 1))} FROM p GROUP BY id),
sparse_w AS (SELECT context_id AS id, {", ".join(f"sum(weight * x[{i}]) AS s{i}" for i in range(1, LENGTH + 1))}
  FROM totals JOIN vocab USING (id) GROUP BY context_id),
sparse_x AS (SELECT totals.id, {", ".join(f"sum(weight * w[{i}]) AS s{i}" for i in range(1, LENGTH + 1))}
  FROM totals JOIN vocab ON vocab.id = context_id GROUP BY totals.id),
grads AS (
  SELECT 'w' AS side, dense_w.id, unnest(range(0, {LENGTH})) AS dim,
    unnest([{", ".join(f"g{i} - coalesce(s{i}, 0)" for i in range(1, LENGTH + 1))}]) AS value
  FROM dense_w LEFT JOIN sparse_w ON sparse_w.id = dense_w.id
  UNION ALL
  SELECT 'x', dense_x.id, unnest(range(0, {LENGTH})),
    unnest([{", ".join(f"g{i} - coalesce(s{i}, 0) / n" for i in range(1, LENGTH + 1))}])
  FROM dense_x JOIN counts ON counts.id = dense_x.id LEFT JOIN sparse_x ON sparse_x.id = dense_x.id)"""


def _texts(select: str, *parts: str) -> str:
    return _with(_TEXTS, *parts, select=select)


def _vocabulary(select: str, *parts: str) -> str:
    return _texts(select, _CONTENDERS, _VOCAB, *parts)


def _unnested(columns: str, vector: str) -> str:
    return f"SELECT {columns}, unnest(range(0, {LENGTH})) AS dim, unnest({vector}) AS value FROM vocab"


_LAST = BATCHES - 1
# Words of all batches but the last are known to the last one, which alone trains;
# those that the last batch brings to eleven come after them.
_STREAMED = (
    f"""contenders AS (
  SELECT word, count(DISTINCT batch) AS n FROM tokens WHERE {_MAY} AND batch < {_LAST} GROUP BY word)""",
    _VOCAB,
    _CONTEXTS.replace("FROM tokens JOIN vocab USING (word)", f"FROM tokens JOIN vocab USING (word) WHERE batch = {_LAST}"),
    _SOFTMAX,
    _GRADIENTS,
    f"""late AS (
  SELECT word, CAST((SELECT count(*) FROM vocab) + row_number() OVER (ORDER BY word) - 1 AS INTEGER) AS id,
    {_seeded("word")} AS x, {_seeded("weight")} AS w
  FROM (SELECT word FROM tokens WHERE {_MAY} AND word NOT IN (SELECT word FROM vocab)
    GROUP BY word HAVING count(DISTINCT batch) > 10)),
old AS (
  SELECT word, id, 'x' AS side, unnest(range(0, {LENGTH})) AS dim, unnest(x) AS value FROM vocab
  UNION ALL SELECT word, id, 'w', unnest(range(0, {LENGTH})), unnest(w) FROM vocab),
final AS (
  SELECT o.word, o.id, o.side, o.dim, o.value - {RATE} * coalesce(grads.value, 0)
    / CASE o.side WHEN 'w' THEN (SELECT count(*) FROM kept WHERE batch = {_LAST}) ELSE 1 END AS value
  FROM old o LEFT JOIN grads ON grads.side = o.side AND grads.id = o.id AND grads.dim = o.dim
  UNION ALL SELECT word, id, 'x', unnest(range(0, {LENGTH})), unnest(x) FROM late
  UNION ALL SELECT word, id, 'w', unnest(range(0, {LENGTH})), unnest(w) FROM late)""",
)

_COUNT_ENDPOINTS = "SELECT endpoint, count(*) AS n FROM logs {where} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"

_NEAREST_BATCH = _with(
    _VECTORS,
    f"distances AS (SELECT q.word AS query, v.word, {_distance('v.vector', 'q.vector')} AS distance"
    " FROM vectors v, vectors q WHERE q.word % 50 = 0)",
    "ranked AS (SELECT *, max(distance) OVER (PARTITION BY query) AS farthest,"
    " row_number() OVER (PARTITION BY query ORDER BY word = query, distance, word) AS rank FROM distances)",
    select="SELECT query, CAST(rank AS INTEGER) AS rank, word, round(distance, 6) AS distance,"
    " CAST(floor(100 * (1 - distance / farthest)) AS BIGINT) AS percent FROM ranked WHERE rank <= 5",
)

ORACLES: dict[str, str] = {
    "log_parse": _log("SELECT * FROM logs"),
    "log_bad_lines": _log("SELECT event_id, line FROM split WHERE NOT ok ORDER BY event_id LIMIT 20"),
    "log_parse_report": _log(
        "SELECT count(*) AS n_lines, count(*) FILTER (ok) AS n_parsed, count(*) FILTER (NOT ok) AS n_failed FROM split"
    ),
    "log_text_scan": _log(
        "SELECT true AS ok, status, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes FROM logs GROUP BY status"
        " UNION ALL SELECT false, NULL, count(*), NULL FROM split WHERE NOT ok"
    ),
    "log_size_stats": _log(
        "SELECT round(avg(size), 6) AS avg_size, min(size) AS min_size, max(size) AS max_size FROM logs"
    ),
    "log_status_counts": _log("SELECT status, count(*) AS n FROM logs GROUP BY status"),
    "log_busy_hosts": _log("SELECT host FROM logs GROUP BY host HAVING count(*) > 10"),
    "log_busy_hosts_20": _log("SELECT host FROM logs GROUP BY host HAVING count(*) > 10 ORDER BY host LIMIT 20"),
    "log_top_endpoints": _log(_COUNT_ENDPOINTS.format(where="")),
    "log_top_failed_endpoints": _log(_COUNT_ENDPOINTS.format(where="WHERE status <> 200")),
    "log_unique_hosts": _log("SELECT count(DISTINCT host) AS n_hosts FROM logs"),
    "log_daily_hosts": _log(
        "SELECT CAST(day(date_time) AS INTEGER) AS day, count(DISTINCT host) AS n_hosts FROM logs GROUP BY 1 ORDER BY 1"
    ),
    "log_weekly_sketches": _log(
        "SELECT CAST((day(date_time) - 1) // 7 AS INTEGER) AS week, count(DISTINCT host) AS n_hosts, true AS close"
        " FROM logs GROUP BY 1"
    ),
    "log_daily_avg_requests": _log(
        "SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) // count(DISTINCT host) AS avg_requests"
        " FROM logs GROUP BY 1 ORDER BY 1"
    ),
    "log_404_count": _log("SELECT count(*) AS n FROM logs WHERE status = 404"),
    "log_404_endpoints": _log("SELECT DISTINCT endpoint FROM logs WHERE status = 404 ORDER BY 1 LIMIT 10"),
    "log_404_top_endpoints": _log(_COUNT_ENDPOINTS.format(where="WHERE status = 404")),
    "log_404_top_hosts": _log(
        "SELECT host, count(*) AS n FROM logs WHERE status = 404 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
    ),
    "log_404_by_day": _log(
        "SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS n FROM logs WHERE status = 404 GROUP BY 1 ORDER BY 1"
    ),
    "log_404_top_days": _log(
        "SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS n FROM logs WHERE status = 404"
        " GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"
    ),
    "log_404_by_hour": _log(
        "SELECT CAST(hour(date_time) AS INTEGER) AS hour, count(*) AS n FROM logs WHERE status = 404 GROUP BY 1 ORDER BY 1"
    ),
    "rel_distinct": _ballots("SELECT DISTINCT candidate_name FROM ballots"),
    "rel_ballot_order": _ballots(
        "SELECT DISTINCT candidate_name, candidate_ballot_order FROM ballots ORDER BY candidate_ballot_order"
    ),
    "rel_lookup_join": _ballots(
        "SELECT DISTINCT candidate_name, friendly_name FROM ballots JOIN friendly_orders USING (candidate_ballot_order)"
    ),
    "rel_total_sum": _ballots(f"SELECT {_SUM_VOTES} AS total_votes FROM ballots"),
    "rel_sum_all": "SELECT CAST(sum(o_orderkey) AS BIGINT) AS sum_key, CAST(sum(o_custkey) AS BIGINT) AS sum_customer,"
    " round(sum(o_totalprice), 2) AS sum_price, CAST(sum(CAST(o_orderpriority[1] AS INTEGER)) AS BIGINT) AS sum_priority"
    " FROM orders",
    "rel_json_head": _ballots("SELECT * FROM ballots ORDER BY ballot_id LIMIT 2"),
    "rel_sum_by_key": _ballots(
        f"SELECT candidate_name, {_SUM_VOTES} AS sum_column FROM ballots GROUP BY 1 ORDER BY 2 DESC, 1"
    ),
    "rel_top_valid_group": _ballots(_TOP_PRECINCT),
    "rel_json_roundtrip": _ballots(
        f"SELECT candidate_name, sum_column FROM (SELECT candidate_name, {_SUM_VOTES} AS sum_column"
        " FROM ballots GROUP BY 1), range(2)"
    ),
    "rel_json_scan": _ballots(_TOP_PRECINCT),
    "rel_json_variant": _ballots(
        f"SELECT candidate_name, {_SUM_VOTES} AS sum_column FROM ballots"
        " WHERE CAST(ballot_id AS BIGINT) % 50 <> 3 GROUP BY 1"
        " UNION ALL SELECT NULL, count(*) FROM ballots WHERE CAST(ballot_id AS BIGINT) % 50 = 3"
    ),
    "graph_default_vertices": _graph("SELECT id, name, age FROM vertices").replace(
        "FROM customer)", "FROM customer WHERE c_acctbal >= 0)"
    ),
    "graph_vertex_filter": _graph("SELECT name, age FROM vertices WHERE age >= 30"),
    "graph_triplets": _graph("SELECT src, dst, attr, src_name, dst_name FROM triplets"),
    "graph_strong_edges": _graph("SELECT src, dst, attr, src_name, dst_name FROM triplets WHERE attr > 5"),
    "graph_in_degrees": _graph("SELECT dst AS id, count(*) AS in_degree FROM edges GROUP BY 1"),
    "graph_out_degrees": _graph("SELECT src AS id, count(*) AS out_degree FROM edges GROUP BY 1"),
    "graph_degrees": _graph(
        "SELECT id, name, age, (SELECT count(*) FROM edges WHERE dst = id) AS in_degree,"
        " (SELECT count(*) FROM edges WHERE src = id) AS out_degree FROM vertices"
    ),
    "graph_equal_degree": _graph(
        "SELECT id, name FROM vertices WHERE (SELECT count(*) FROM edges WHERE dst = id)"
        " = (SELECT count(*) FROM edges WHERE src = id)"
    ),
    "graph_oldest_follower": _graph(
        f"SELECT id, CASE WHEN follower IS NULL THEN {_NOBODY}"
        " ELSE follower || ' is the oldest follower of ' || name || '.' END AS text"
        " FROM vertices LEFT JOIN oldest USING (id)",
        _OLDEST,
    ),
    "graph_two_rounds": _graph(
        "SELECT id, CAST(sum(s) AS BIGINT) AS total FROM"
        " (SELECT dst AS id, s FROM edges JOIN sums ON sums.id = src"
        " UNION ALL SELECT src, s FROM edges JOIN sums ON sums.id = dst) GROUP BY id",
        "sums AS (SELECT v.id, coalesce(sum(t.src_age), 0) AS s"
        " FROM vertices v LEFT JOIN triplets t ON t.dst = v.id GROUP BY v.id)",
    ),
    "graph_avg_follower_age": _graph(
        "SELECT id, name, round(avg(src_age), 6) AS avg_age FROM vertices LEFT JOIN triplets ON dst = id GROUP BY 1, 2"
    ),
    "graph_messages_both_ways": _graph(
        "SELECT id, count(*) AS n, CAST(sum(age) AS BIGINT) AS age_sum FROM"
        " (SELECT dst AS id, src_age AS age FROM triplets UNION ALL SELECT src, dst_age FROM triplets) GROUP BY id"
    ),
    "graph_map_and_join": _graph(
        "SELECT id, CASE WHEN follower IS NULL THEN name ELSE name || '<' || follower END AS name,"
        " age + 1 AS age FROM vertices LEFT JOIN oldest USING (id)",
        _OLDEST,
    ),
    "graph_subgraph": _graph(
        "SELECT src, dst, attr FROM triplets WHERE src_age >= 30 AND dst_age >= 30 AND attr > 2"
    ),
    "graph_components": _graph(
        "SELECT id, min(reached) AS component FROM reach GROUP BY id",
        "links AS (SELECT src AS a, dst AS b FROM triplets WHERE src_age >= 30 AND dst_age >= 30"
        " UNION SELECT dst, src FROM triplets WHERE src_age >= 30 AND dst_age >= 30)",
        "reach(id, reached) AS (SELECT id, id FROM vertices WHERE age >= 30"
        " UNION SELECT reach.id, b FROM reach JOIN links ON a = reached)",
    ),
    "graph_without_edges": _graph("SELECT id, id AS component FROM people"),
    "tags_enrich": _with(
        _ENRICHED,
        select="SELECT p_partkey AS id, p_name AS title, p_brand AS artist,"
        " coalesce(string_agg(tag, '|' ORDER BY tag), '') AS tags"
        " FROM part LEFT JOIN found ON found.id = p_partkey GROUP BY 1, 2, 3",
    ),
    "tags_similar_pairs": _with(_TAGS, select="SELECT src, dst, round(score, 9) AS score FROM pairs"),
    "tags_similar_sets": _with(
        _TAGS,
        *_SETS,
        select="SELECT a, b, round(n::DOUBLE / (size - n)::DOUBLE, 9) AS score FROM met"
        f" WHERE {_ALIKE}",
    ),
    "tags_link_counts": _with(
        _TAGS,
        select="SELECT id, min(id) OVER (PARTITION BY list_sort(tags)) AS set_id, coalesce(n, 0) AS n_links"
        " FROM tagged LEFT JOIN (SELECT src, count(*) AS n FROM pairs GROUP BY src) ON src = id WHERE len(tags) > 0",
    ),
    "tags_set_graph": _with(
        _TAGS,
        *_SETS,
        f"alike AS (SELECT a, b FROM met WHERE {_ALIKE} UNION ALL SELECT b, a FROM met WHERE {_ALIKE})",
        select="SELECT set_id AS id, n_members, coalesce(n, 0) AS in_degree, coalesce(n, 0) AS out_degree FROM"
        " (SELECT min(id) AS set_id, count(*) AS n_members FROM tagged WHERE len(tags) > 0 GROUP BY list_sort(tags))"
        " LEFT JOIN (SELECT a, count(*) AS n FROM alike GROUP BY a) ON a = set_id",
    ),
    "tags_set_members": _with(
        _TAGS,
        select="SELECT id, min(id) OVER (PARTITION BY list_sort(tags)) AS set_id FROM tagged WHERE len(tags) > 0",
    ),
    "graph_hops": _graph(
        "SELECT id, min(n) AS hops FROM reach GROUP BY id",
        "reach(id, n) AS (SELECT min(src), CAST(0 AS BIGINT) FROM edges"
        " UNION SELECT dst, n + 1 FROM reach JOIN edges ON src = id WHERE n < 40)",
    ),
    "graph_cheapest": _graph(
        "SELECT id, min(n) AS cost FROM reach GROUP BY id",
        "reach(id, n) AS (SELECT min(src), CAST(0 AS BIGINT) FROM edges"
        " UNION SELECT dst, n + attr FROM reach JOIN edges ON src = id WHERE n < 60)",
    ),
    "graph_pic": _with(
        _TAGS,
        "links AS (SELECT src, dst, CAST(round(score * 1000000) AS HUGEINT) AS a FROM pairs)",
        "degrees AS (SELECT src AS id, sum(a) AS d FROM links GROUP BY 1)",
        "around AS (SELECT src, dst, a, d FROM links JOIN degrees ON id = dst UNION ALL SELECT id, id, d, d FROM degrees)",
        "seeds AS (SELECT id, CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 12)) AS HUGEINT) AS v FROM degrees)",
        f"steps(t, id, v) AS (SELECT 0, id, {_STRETCHED} FROM seeds UNION ALL"
        f" SELECT t, id, {_STRETCHED} FROM (SELECT t + 1 AS t, dst AS id, CAST(sum(a * v) AS HUGEINT) // (2 * any_value(d)) AS v"
        " FROM steps JOIN around ON src = id WHERE t < 20 GROUP BY t, dst))",
        "places AS (SELECT id, v // 1073741824 AS u FROM steps WHERE t = 20)",
        "points AS (SELECT u, row_number() OVER (ORDER BY u) AS i, CAST(sum(count(*)) OVER (ORDER BY u) AS HUGEINT) AS n,"
        " CAST(sum(sum(u)) OVER (ORDER BY u) AS HUGEINT) AS s FROM places GROUP BY u)",
        "best(j, i, total, cut) AS (SELECT 1, i, (s * s) // n, CAST(0 AS BIGINT) FROM points UNION ALL"
        " SELECT j, i, max(total), CAST(arg_max(cut, (total, -cut)) AS BIGINT) FROM (SELECT best.j + 1 AS j, q.i,"
        " best.total + ((q.s - p.s) * (q.s - p.s)) // (q.n - p.n) AS total, best.i AS cut"
        " FROM best JOIN points p ON p.i = best.i JOIN points q ON q.i > best.i WHERE best.j < 4) GROUP BY j, i)",
        "chain(j, i) AS (SELECT least(4, max(i)), max(i) FROM points UNION ALL"
        " SELECT chain.j - 1, best.cut FROM chain JOIN best ON best.j = chain.j AND best.i = chain.i WHERE chain.j > 1)",
        "parts AS (SELECT id, (SELECT min(chain.i) FROM chain WHERE chain.i >= points.i) AS part"
        " FROM places JOIN points USING (u))",
        select="SELECT id, min(id) OVER (PARTITION BY part) AS cluster FROM parts",
    ),
    "graph_pic_ids": _with(_TAGS, select="SELECT DISTINCT src AS id FROM pairs"),
    "tags_similar_graph": _with(
        _TAGS,
        select="SELECT src, dst, src_tags, dst_tags, round(score, 9) AS score FROM pairs"
        " WHERE src_tags > 5 AND dst_tags > 5",
    ),
    "vec_nearest": _with(
        _VECTORS,
        f"distances AS (SELECT v.word, {_distance('v.vector', 'q.vector')} AS distance FROM vectors v,"
        " (SELECT vector FROM vectors WHERE word = 0) q)",
        select="SELECT word, round(distance, 6) AS distance, CAST(floor(100 * (1 - distance /"
        " (SELECT max(distance) FROM distances))) AS BIGINT) AS percent"
        " FROM distances WHERE word <> 0 ORDER BY distances.distance, word LIMIT 10",
    ),
    "vec_nearest_batch": _NEAREST_BATCH,
    "vec_nearest_indexed": _NEAREST_BATCH,
    "vec_requests": _vocabulary(
        "SELECT word AS query, CAST(least(n, 3) AS INTEGER) AS n, false AS known, CAST(NULL AS INTEGER) AS rank,"
        " CAST(NULL AS VARCHAR) AS word, CAST(NULL AS DOUBLE) AS distance FROM contenders"
        " WHERE word NOT IN (SELECT word FROM vocab) UNION ALL"
        " SELECT query, 3, true, CAST(rank AS INTEGER), word, round(distance, 6) FROM ranked WHERE rank <= 3",
        f"distances AS (SELECT q.word AS query, v.word, {_distance('v.x', 'q.x')} AS distance"
        " FROM vocab v JOIN vocab q ON v.word <> q.word)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, word) AS rank FROM distances)",
    ),
    "stream_running_avg": "SELECT event_type AS word, round(CAST(CAST(avg(value) AS FLOAT) AS DOUBLE), 3) AS mean"
    " FROM events GROUP BY 1",
    "stream_running_avg_trace": "SELECT event_id, event_type AS word, round(avg(value) OVER (PARTITION BY event_type"
    " ORDER BY event_id ROWS UNBOUNDED PRECEDING) + CAST('1e-9' AS DOUBLE), 6) AS mean FROM events",
    "stream_feed_means": "SELECT event_type AS word, round(CAST(CAST(avg(value) AS FLOAT) AS DOUBLE), 3) AS mean"
    " FROM events GROUP BY 1",
    "keyed_lookup": "SELECT user_id, max(event_id) AS last_event, max_by(value, event_id) AS value"
    " FROM events WHERE user_id % 50 = 0 GROUP BY user_id",
    "keyed_upsert": "SELECT user_id, max(event_id) AS last_event, max_by(value, event_id) AS value"
    " FROM events GROUP BY user_id",
    "stream_train_metrics": _texts(
        "SELECT CAST(b AS BIGINT) AS batch,"
        " (SELECT count(*) FROM words WHERE admitted <= b) AS n_words,"
        " (SELECT count(*) FROM words WHERE first_seen <= b AND (admitted IS NULL OR admitted > b)) AS n_contenders,"
        " (SELECT count(*) FROM kept WHERE kept.batch = b) AS n_texts"
        f" FROM (SELECT unnest(range(0, {BATCHES})) AS b)",
        f"seen AS (SELECT DISTINCT batch, word FROM tokens WHERE {_MAY})",
        "counted AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY batch) AS times FROM seen)",
        "words AS (SELECT word, min(batch) AS first_seen, min(batch) FILTER (times = 11) AS admitted"
        " FROM counted GROUP BY word)",
    ),
    "stream_train_vocab": _texts(
        "SELECT id, word, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value FROM final WHERE side = 'x'",
        *_STREAMED,
    ),
    "stream_train_weights": _texts(
        "SELECT id, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value FROM final WHERE side = 'w'",
        *_STREAMED,
    ),
    "text_tokens": _texts(
        "SELECT doc_id, CAST(position AS INTEGER) AS position, word, regexp_matches(word, '[0-9]') AS has_digit FROM tokens"
    ),
    "text_digits": _texts(
        "SELECT doc_id, CAST(len(list_filter(string_split_regex(text, '[ \t\r\n]+'),"
        " lambda w: regexp_matches(w, '[0-9]'))) AS INTEGER) AS n FROM kept"
    ),
    "stream_train_restored": _with(
        _TEXTS, _STREAMED[0], _VOCAB,
        select="SELECT id, word, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value FROM ("
        + _unnested("id, word", "x") + ")",
    ),
    "text_new_words": _vocabulary(
        f"SELECT DISTINCT doc_id, word FROM tokens WHERE {_MAY} AND word NOT IN (SELECT word FROM vocab)"
    ),
    "text_new_words_filtered": _vocabulary(
        f"SELECT DISTINCT doc_id, word FROM tokens WHERE {_MAY} AND word NOT IN (SELECT word FROM vocab)"
    ),
    "contender_counts": _texts("SELECT word, n FROM contenders", _CONTENDERS),
    "contender_decay": _texts("SELECT word, n - 1 AS n FROM contenders WHERE n > 1", _CONTENDERS),
    "vocab_admission": _vocabulary(
        "SELECT id, word, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value, kind FROM ("
        + _unnested("id, word, 'word' AS kind", "x") + " UNION ALL "
        + _unnested("id, word, 'weight'", "w") + ")"
    ),
    "emb_context": _vocabulary(
        "SELECT id, context_id, round(weight, 6) AS weight FROM totals"
        " UNION ALL SELECT id, NULL, CAST(n AS DOUBLE) FROM counts",
        _CONTEXTS,
    ),
    "emb_softmax": _vocabulary("SELECT id, round(log_sum, 6) AS log_sum FROM log_sums", _SOFTMAX),
    "emb_gradients": _vocabulary(
        "SELECT side, id, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value FROM grads",
        _CONTEXTS, _SOFTMAX, _GRADIENTS,
    ),
    "emb_train_step": _vocabulary(
        f"SELECT o.id, o.side, CAST(o.dim AS INTEGER) AS dim, round(o.value - {RATE} * coalesce(grads.value, 0)"
        " / CASE o.side WHEN 'w' THEN (SELECT count(*) FROM kept) ELSE 1 END, 6) AS value"
        " FROM old o LEFT JOIN grads ON grads.side = o.side AND grads.id = o.id AND grads.dim = o.dim",
        _CONTEXTS, _SOFTMAX, _GRADIENTS,
        "old AS (" + _unnested("id, 'x' AS side", "x") + " UNION ALL " + _unnested("id, 'w'", "w") + ")",
    ),
}
