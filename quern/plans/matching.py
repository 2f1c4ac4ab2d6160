"""Queries of name matching over the shop's clients, parts and vendors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import matching as M
from ..sources.tables import table
from .catalogue import query

FOLD = "lower(replace(translate(lower(name), '{0}', '{1}'), 'æ', 'ae'))".format(T.ACCENTS, T.PLAIN)
WORDS = f"list_sort(list_distinct([x for x in regexp_extract_all({FOLD}, '[a-z0-9]{{2,}}') if NOT list_contains({list(T.LEGAL_WORDS)}, x)]))"
SIMILAR = "len(list_intersect(t.w, c.w)) / (len(t.w) + len(c.w) - len(list_intersect(t.w, c.w)))"


def _oracle(targets: str, candidates: str, key: str, marks: str) -> str:
    """Every pair is scored; the statement of the operator without classes or index."""
    return f"""WITH t AS (SELECT {key} AS k, *, {WORDS} AS w FROM ({targets})), c AS (SELECT {key} AS k, *, {WORDS} AS w FROM ({candidates})),
 pairs AS (SELECT t.k AS t, c.k AS c, round(4.0 * {SIMILAR} + {marks}, 4) AS score FROM t, c WHERE len(t.w) > 0 AND len(c.w) > 0 AND {SIMILAR} >= 0.5),
 mine AS (SELECT t, max(score) AS score, count(*) AS n, min(c) AS c FROM (SELECT * FROM pairs QUALIFY score = max(score) OVER (PARTITION BY t)) GROUP BY t),
 theirs AS (SELECT c, count(*) AS n, min(t) AS t FROM (SELECT * FROM pairs QUALIFY score = max(score) OVER (PARTITION BY c)) GROUP BY c),
 o AS (SELECT t.k AS target, CASE WHEN mine.t IS NULL THEN 'no_match' WHEN mine.n > 1 THEN 'ambiguous' WHEN theirs.n = 1 AND theirs.t = t.k THEN 'assigned' ELSE 'contested' END AS status, mine.c, mine.score
  FROM t LEFT JOIN mine ON mine.t = t.k LEFT JOIN theirs ON theirs.c = mine.c)
 SELECT target, status, CASE WHEN status = 'assigned' THEN c END AS candidate, score FROM o"""


@query("name_assignment", _oracle("SELECT * FROM clients WHERE source = 'crm'", "SELECT * FROM clients WHERE source <> 'crm'", "client_id", "CASE WHEN t.city = c.city THEN 3.0 ELSE 0.0 END + CASE WHEN t.nation_id = c.nation_id THEN 2.0 ELSE 0.0 END"))
def name_assignment(spark, d):
    """Clients of other sources to the clients of the master system."""
    c = table(spark, d, "clients")
    return M.assign(c.where("source = 'crm'"), c.where("source <> 'crm'"), "client_id", "name", {"city": 3.0, "nation_id": 2.0})


@query("part_assignment", _oracle("SELECT p_partkey AS k0, p_name AS name, p_size AS size FROM part", "SELECT item_id AS k0, name, size FROM items", "k0", "CASE WHEN t.size = c.size THEN 3.0 ELSE 0.0 END"))
def part_assignment(spark, d):
    """The shop's items to parts by name and size; most share their names, which are classes."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return M.assign(parts, table(spark, d, "items").select(F.col("item_id").alias("key"), "name", "size"), "key", "name", {"size": 3.0})
