"""Query of operator 9: all conversations without quotes, each message after what it replies to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import chat
from quern.llm.common import table


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.threads(table(spark, sf_dir, "conversations"))


QUERIES = {"op9_chat": op9_chat}
ORACLE_SQL = {
    "op9_chat": r"""
WITH RECURSIVE m AS (
  SELECT coalesce(conv_id, -1) AS conv, coalesce(turn, -1) AS turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text, count(*) AS times
  FROM conversations GROUP BY ALL),
n AS (
  SELECT *, (sum(times) OVER w - times + 1)::BIGINT AS position, lag(turn) OVER (PARTITION BY conv ORDER BY turn, role, sha256(text)) AS before
  FROM m WINDOW w AS (PARTITION BY conv ORDER BY turn, role, sha256(text) ROWS UNBOUNDED PRECEDING)),
s AS (SELECT conv, position, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM n),
l AS (SELECT *, length(replace(replace(regexp_extract(line, '^([ \t]*>)+', 0), ' ', ''), chr(9), '')) AS level FROM s),
o AS (
  SELECT *, level = 0 AND NOT (regexp_matches(trim(line), '(?i)^(on|am|el|le)\b.*(wrote|schrieb|escribió|a écrit)\s*:$')
    AND coalesce(lead(level) OVER (PARTITION BY conv, position ORDER BY pos), 0) > 0) AS own,
    lower(trim(regexp_replace(regexp_replace(line, '^([ \t]*>)+', ''), '[ \t\r]+', ' ', 'g'))) AS words
  FROM l),
t AS (
  SELECT *, own OR level > 0 AS told, coalesce((own OR level > 0) = lag(own OR level > 0) OVER v AND level = lag(level) OVER v AND words <> '' AND lag(words) OVER v <> '', FALSE) AS goes_on
  FROM o WINDOW v AS (PARTITION BY conv, position ORDER BY pos)),
g AS (SELECT *, sum((NOT goes_on)::INT) OVER (PARTITION BY conv, position ORDER BY pos ROWS UNBOUNDED PRECEDING) AS passage FROM t),
p AS (
  SELECT conv, position, turn, level, passage, string_agg(words, ' ' ORDER BY pos) AS whole
  FROM g WHERE told AND words <> '' GROUP BY ALL),
pieces AS (
  SELECT conv, position, turn, level, whole AS words FROM p
  UNION SELECT conv, position, turn, level, words FROM g WHERE told AND length(words) >= 8
  UNION SELECT * FROM (
    SELECT conv, position, turn, level, unnest(string_split(regexp_replace(whole, '([.!?]) ', '\1' || chr(10), 'g'), chr(10))) AS words FROM p) WHERE length(words) >= 8),
body AS (
  SELECT conv, position, regexp_replace(regexp_replace(string_agg(line, chr(10) ORDER BY pos), '^\s+', ''), '\s+$', '') AS body
  FROM o WHERE own GROUP BY ALL),
here AS (SELECT conv, words, min((position, turn)) AS h FROM pieces WHERE level = 0 GROUP BY conv, words),
first AS (SELECT words, min((conv, h[1], h[2])) AS f FROM here GROUP BY words),
q AS (SELECT conv, position, words, min(level) AS level FROM pieces WHERE level > 0 GROUP BY ALL),
linked AS (
  SELECT q.conv, q.position, level, length(q.words) AS size,
    CASE WHEN h[1] < q.position THEN (q.conv, h[2], h[1]) WHEN f[1] <> q.conv AND length(q.words) >= 8 THEN (f[1], f[3], f[2]) END AS t
  FROM q LEFT JOIN here ON here.conv = q.conv AND here.words = q.words LEFT JOIN first ON first.words = q.words),
sums AS (SELECT conv, position, level, t[1] AS to_conv, t[2] AS to_turn, t[3] AS place, sum(size) AS size FROM linked WHERE t IS NOT NULL GROUP BY ALL),
r AS (
  SELECT conv, position, to_conv, to_turn, place FROM sums
  QUALIFY row_number() OVER (PARTITION BY conv, position ORDER BY level, size DESC, to_conv = conv DESC, to_turn DESC, place DESC, to_conv) = 1),
c AS (
  SELECT n.conv, n.turn, n.role, n.position + copy AS position, CASE WHEN copy > 0 THEN n.turn ELSE before END AS before, to_conv, to_turn, coalesce(body, '') AS body,
    CASE WHEN to_conv = conv THEN place WHEN to_conv IS NULL THEN n.position + copy - 1 ELSE 0 END AS parent
  FROM (SELECT *, unnest(range(times)) AS copy FROM n) n LEFT JOIN r USING (conv, position) LEFT JOIN body USING (conv, position)),
tree AS (
  SELECT conv, position, [position] AS path FROM c WHERE parent = 0
  UNION ALL SELECT c.conv, c.position, list_append(path, c.position) FROM c JOIN tree ON tree.conv = c.conv AND tree.position = c.parent),
walk AS (SELECT conv, position, row_number() OVER (PARTITION BY conv ORDER BY path) AS reply_position FROM tree)
SELECT conv AS conv_id, turn, role, position, reply_position, CASE WHEN to_turn IS NOT NULL THEN to_conv WHEN before IS NOT NULL THEN conv END AS reply_conv_id,
  coalesce(to_turn, before) AS reply_turn, to_turn IS NOT NULL AS quoted, body AS text, '<|' || role || '|>' || chr(10) || body AS formatted
FROM c JOIN walk USING (conv, position)"""
}
